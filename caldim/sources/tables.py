"""Readers for the fact tables the jobs run on (one parquet dataset each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str, *columns: str) -> DataFrame:
    """Read one table, projected to ``columns`` right at the scan, so the
    parquet reader decodes only those columns."""
    df = spark.read.parquet(table_path(base, name))
    return df.select(*columns) if columns else df
