"""Scans: raw CSV text, layered tables and the file manifest."""
