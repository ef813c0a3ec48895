"""siglake: a telemetry lakehouse built on PySpark DataFrames.

Raw alarm, ticket, network, security and performance events are decoded,
validated, routed, normalised, de-duplicated and stored in date-partitioned
tables; dashboard questions are answered as ordinary DataFrame plans.

Sub-packages:
  functions  column expressions (severity, time, payload, routing, files)
  operators  DataFrame -> DataFrame transforms (normalise, dedup, validate, aggregate)
  sources    readers (file directories, Kafka decode, catalog, driver-table adapters)
  sinks      writers (partitioned parquet, tables, landing zone, history tables)
  plans      serving tables and the named dashboard queries
  streaming  Structured Streaming jobs built from the same transforms
"""

__version__ = "0.1.0"
