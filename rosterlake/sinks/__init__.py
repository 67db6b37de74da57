"""Writers: partitioned tables, merges, audit log and CSV export."""
