"""rosterlake: daily care-facility staffing analytics as plain Spark DataFrames."""

from rosterlake.config import Settings, TablePaths

__all__ = ["Settings", "TablePaths"]
