"""Bronze -> Silver -> Gold tables for drifting operational extracts, on Spark."""
