"""Configuration-driven incremental loads, data quality and audit on Spark DataFrames."""
