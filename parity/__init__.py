"""Test-side code: staffing-shaped tables over the driver's tables, and their SQL twins."""
