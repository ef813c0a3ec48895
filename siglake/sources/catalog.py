"""Catalog browsing (A10): catalogs, namespaces, tables, a bounded sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def list_catalogs(spark: SparkSession) -> list[str]:
    return [c.name for c in spark.catalog.listCatalogs()]


def list_namespaces(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def list_tables(spark: SparkSession, namespace: str | None = None) -> list[str]:
    return [t.name for t in spark.catalog.listTables(namespace)]


def sample(spark: SparkSession, table: str, n: int = 10) -> DataFrame:
    """``SELECT * FROM table LIMIT n`` (a bounded peek, the feature itself)."""
    return spark.table(table).limit(n)
