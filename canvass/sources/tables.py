"""SRC-6 table scans of the driver tables (parquet, one file or folder each).

Projection and filters are left to Catalyst: callers select the columns they
need and the scan's ReadSchema / PushedFilters follow.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


def task_count(df: DataFrame, rows: int) -> int:
    """Tasks for ``df`` at about ``rows`` rows each, no fewer than the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-df.count() // rows))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Expose every driver table as a temp view (for ``spark.sql``)."""
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            spark.read.parquet(p).createOrReplaceTempView(t)
