"""Locate and read the driver's tables: one Parquet file (or directory) per table.

Reading is lazy: ``read_table`` returns a DataFrame over the Parquet source,
so Catalyst prunes columns and pushes filters into the scan of whatever
query is built on top of it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The table names the driver provides in every sf directory.
TABLES = (
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
)


def table_path(sf_dir: str | os.PathLike[str], name: str) -> str:
    """Path of table ``name`` under ``sf_dir`` (``<sf_dir>/<name>.parquet``)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; expected one of {TABLES}")
    return os.path.join(os.fspath(sf_dir).rstrip("/"), f"{name}.parquet")


def read_table(
    spark: SparkSession,
    sf_dir: str | os.PathLike[str],
    name: str,
    schema: str | StructType | None = None,
) -> DataFrame:
    """Lazily read table ``name`` from ``sf_dir``.

    With ``schema`` (a DDL string or ``StructType``, possibly a subset of the
    table's columns) Spark reads just those columns with those types and
    skips the footer-reading job it would otherwise run to infer a schema;
    a file whose types differ fails the scan instead of changing the plan.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table_path(sf_dir, name))
