"""Helpers shared by the operators: scratch tables, words, connected components."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Edges from which on components deal out hot nodes, and how many nodes can count as hot.
SALT_EDGES, HOT_NODES = 1 << 17, 4096


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where it is unset, a session on one machine (a ``local`` master) gets a
    folder of its own there; on any other master, whose executors could not
    read each other's files, this raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master is {master})")
    return worker_cache(
        ("shared root", spark.sparkContext.applicationId), lambda: "file://" + tempfile.mkdtemp(prefix="llm-shared-")
    )


class Scratch:
    """Tables written to the shared folder, to cut lineage.

    A written table survives lost executors and gives every later step the
    same rows and ids; ``drop`` removes one that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/{name}")
        return self.read(df, name)

    def read(self, df: DataFrame, name: str) -> DataFrame:
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(conf).delete(path, True)


def worker_cache(key: Any, make: Callable[[], Any]) -> Any:
    """A value kept for the life of a Python process, such as a loaded tokenizer."""
    cache = sys.__dict__.setdefault("_llm_worker_cache", {})
    if key not in cache:
        cache[key] = make()
    return cache[key]


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, made longer until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply), element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: list[bytes], n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n``-word shingles of ``words``.

    Fewer than ``n`` words: the whole sequence is the one shingle; no words:
    empty. Equal shingles hash alike; different ones collide with a chance of
    about 2**-64 a pair.
    """
    import xxhash

    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(n, len(h))
    acc = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - width + 1 + i])
    return np.unique(acc)


def _with_least(rows: DataFrame, most: int | None) -> DataFrame:
    """``rows(u, v)`` with ``m``, the least ``v`` of their ``u``.

    Where ``most`` is given, the rows of a ``u`` with more than that are dealt
    to several tasks. Which nodes those are is broadcast, so the caller bounds
    how many there can be.
    """
    least = rows.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("d"))
    if most is None:
        return rows.join(least.select("u", "m"), "u")
    ways = F.ceil(F.col("d") / most).cast("int")
    hot = least.where(F.col("d") > most).select("u", ways.alias("ways"))
    salt = F.coalesce(F.pmod(F.xxhash64("v"), F.col("ways")), F.lit(0)).cast("int")
    dealt = rows.join(F.broadcast(hot), "u", "left").select("u", "v", salt.alias("salt"))
    least = least.select("u", "m", F.explode(F.sequence(F.lit(0), ways - 1)).alias("salt"))
    return dealt.join(least, ["u", "salt"]).select("u", "v", "m")


def connected_components(
    edges: DataFrame, scratch: Scratch, name: str, salt_edges: int = SALT_EDGES, hot_nodes: int = HOT_NODES
) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the smallest reachable node.

    Alternates large-star and small-star steps: each node links its larger
    neighbours, then its smaller ones, to the smallest it knows, until the
    edges form stars. Each minimum is aggregated map-side and joined back;
    from ``salt_edges`` edges on, at most ``hot_nodes`` nodes with the most
    edges have theirs dealt to several tasks in that join. Each round is
    written to the shared folder. An empty edge table gives no rows.
    """
    u, v = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    stars = scratch.save(
        edges.where(F.col("a") != F.col("b")).select(u, v).distinct(), f"{name}-0"
    )
    before, i = None, 0
    while True:
        fingerprint = stars.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
        ).first()
        if fingerprint["n"] == 0 or fingerprint == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before, i = fingerprint, i + 1
        # both steps join at most 2n rows, so at most hot_nodes nodes have over 2n / hot_nodes of them
        most = -(-2 * fingerprint["n"] // hot_nodes) if fingerprint["n"] >= salt_edges else None
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _with_least(both, most)
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        small = _with_least(large, most)
        small = (
            small.select("u", F.col("m").alias("v"))
            .unionByName(small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct()
        )
        stars = scratch.save(small, f"{name}-{i}")
        if i > 1:
            scratch.drop(f"{name}-{i - 2}")
