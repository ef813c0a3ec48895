"""Readers: file directories (batch and stream), Kafka decoding, catalog
tables, and adapters from the driver's parquet tables."""
