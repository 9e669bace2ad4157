"""File scans and versioned Parquet tables."""
