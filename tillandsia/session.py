"""SparkSession construction with scale-aware defaults.

On a cluster, ``spark-submit --conf`` and ``spark-defaults.conf`` decide the
configuration; ``apply_defaults`` only fills in keys nobody set explicitly,
so it never overrides the cluster's own choices.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Defaults chosen for multi-terabyte scans with small aggregate outputs:
# - AQE re-plans at stage boundaries: it coalesces the near-empty shuffle
#   partitions that follow a map-side (partial) aggregate and splits skewed
#   partitions if a later join meets a hot key.
# - 256 MB splits: Spark sizes scan splits by file bytes, but column pruning
#   means a task reads only the projected columns of its split, so the
#   default 128 MB split leaves most tasks under-filled. Task memory does not
#   grow with the split size because the vectorized reader streams batches.
# - 1000 rows to an Arrow batch: a batch of Spark's default 10,000 long texts
#   would not fit a Python worker.
SCALE_DEFAULTS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def apply_defaults(spark: SparkSession, defaults: Mapping[str, str] = SCALE_DEFAULTS) -> None:
    """Set each runtime SQL conf in ``defaults`` that nobody set, on the session or its context."""
    explicit = spark.conf.getAll
    for key, value in defaults.items():
        if key not in explicit:
            spark.conf.set(key, value)


def build_session(
    master: str | None = None,
    app_name: str = "tillandsia",
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Get or create a session; ``conf`` entries win over ``SCALE_DEFAULTS``.

    Pass ``master`` only for local runs (tests, bench); on a cluster the
    master comes from ``spark-submit``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark
