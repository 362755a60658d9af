"""End-to-end jobs, derived tables, and the query catalogue."""
