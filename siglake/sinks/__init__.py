"""Writers: partitioned parquet, catalog tables, landing zone, history tables."""
