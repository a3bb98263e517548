"""Parquet tables of a data directory."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, data_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read ``<data_dir>/<name>.parquet``; selecting ``columns`` early keeps
    the scan's ReadSchema to what the query needs (Catalyst would prune
    anyway; this documents it)."""
    path = os.path.join(data_dir, f"{name}.parquet")
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
