"""Sharding by balanced label propagation, in DataFrame functions only.

Documents with equal texts are linked. Each starts in a shard that its row's
key hashes to; then, round by round, the documents of a group that sit in one
shard move to the shard where most of their neighbours are, if that shard has
room under its quota (generous at first, then exact), which cuts fewer links. Rows of a group in one shard
move as one record with a count, so a round handles at most
groups x shards records, and a text that makes up a third of all rows is at
most one record per shard. When a shard is full, groups turn to the best one
that is not, so a group larger than a shard fills several.

Documents without links fill the shards up to exactly equal counts at the
end, together with what a shard holds beyond its quota: its smallest groups,
which move whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillandsia.llm._common import Scratch

#: Rows that one step of a ranking sorts together, on average.
RANK_ROWS = 512
#: Share of its quota by which a shard may be overfull at first; it falls to none
#: in three quarters of the rounds. Without it, full shards could not exchange groups.
SLACK = 1.0
#: Parts by hash of each size class, whose counts the driver sees when ranking all pooled rows.
POOL_PARTS = 64


def _ranked(
    rows: DataFrame, part: str, order: str, tie: str, n_rows: int, n_parts: int, bits: str | None = None
) -> DataFrame:
    """Adds ``rank``, gapless from 0 within ``part``, roughly along ``order`` (a hash).

    Each part is cut into buckets by the high bits of ``order``; the counts of
    the buckets give where each begins, so no part is sorted in one task.
    ``bits`` is about the logarithm of how many rows share a row's ``order``:
    larger ones come first, and the many rows of one value are dealt to
    buckets of their own by the hash of ``tie``.
    """
    high = min(24, max(1, (max(1, n_rows // (n_parts * RANK_ROWS)) - 1).bit_length()))
    bucket = F.shiftrightunsigned(F.col(order), 64 - high) * (1 << 24)
    if bits is not None:
        ways = F.expr(f"shiftleft(1L, CAST(least(24, greatest(0, {bits} - {RANK_ROWS.bit_length() - 2})) AS int))")
        bucket = bucket + (64 - F.col(bits)) * (1 << 48) + F.pmod(F.xxhash64(tie), ways)
    bucketed = rows.withColumn("__b", bucket)
    counts = bucketed.groupBy(part, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(part).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(part, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy(part, "__b").orderBy(order, tie)
    return (
        bucketed.withColumn("__i", F.row_number().over(inside))
        .join(firsts, [part, "__b"])
        .withColumn("rank", F.col("__first") + F.col("__i") - 1)
        .drop("__b", "__i", "__first")
    )


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(int(v)).cast("bigint") for v in values])


def shard_documents(
    docs: DataFrame,
    n_shards: int = 40,
    rounds: int = 12,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every row of ``docs``.

    ``size``: UTF-8 bytes of the text (null: none) plus 16. The law is
    ``rows``: the shards' counts are at most one apart. ``slot`` counts from 0
    without gaps in each shard; ``grown_shard`` is null under this law. Groups
    are rows with equal texts, null and empty alike; a group stays in one
    shard as far as quotas allow after ``rounds`` rounds. Null ids and
    repeated rows are rows of their own; an empty table gives an empty table.
    Other columns are ignored, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "sharding")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = scratch.save(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 16).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text, F.octet_length(text), F.crc32(text.cast("binary"))).alias("gid"),
            F.monotonically_increasing_id().alias("rid"),
        ).withColumn("home", F.pmod(F.xxhash64("rid"), F.lit(n_shards)).cast("int")),
        "base",
    )
    n = base.count()
    quota = [n // n_shards + (s < n % n_shards) for s in range(n_shards)]

    cells = base.groupBy("gid", "home").agg(F.count(F.lit(1)).alias("n"))
    linked = cells.groupBy("gid").agg(F.sum("n").alias("total")).where("total > 1").select("gid")
    cells = scratch.save(cells.join(linked, "gid").withColumn("shard", F.col("home")), "cells-0")

    def loads(state: DataFrame) -> list[int]:
        found = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        return [found.get(s, 0) for s in range(n_shards)]

    load = loads(cells)
    for i in range(rounds):
        room = 1 + SLACK * max(0.0, 1 - i / (0.75 * rounds))
        free = [max(0, int(q * room) - x) for q, x in zip(quota, load)]
        votes = cells.groupBy("gid", "shard").agg(F.sum("n").alias("w"))
        votes = votes.withColumn("vote", F.struct("w", F.xxhash64("gid", "shard").alias("tie"), "shard"))
        best = votes.where(F.get(_longs(free), F.col("shard")) > 0).groupBy("gid").agg(F.max("vote").alias("best"))
        wish = (
            cells.join(votes.select("gid", "shard", "vote"), ["gid", "shard"])
            .join(best, "gid", "left")
            .select(
                "gid",
                "home",
                "n",
                "shard",
                F.when(F.col("best") > F.col("vote"), F.col("best.shard")).alias("target"),
            )
        )
        wish = scratch.save(wish, f"wish-{i}")
        # at most n_shards rows
        asked = wish.where("target IS NOT NULL").groupBy("target").agg(F.sum("n").alias("n")).collect()
        if not asked:
            break
        share = [1.0] * n_shards
        for r in asked:
            share[r["target"]] = min(1.0, free[r["target"]] / r["n"])
        lot = F.pmod(F.xxhash64("gid", "home", F.lit(i)), F.lit(1 << 20)) / F.lit(float(1 << 20))
        granted = F.get(F.array(*[F.lit(x) for x in share]), F.col("target")) > lot
        moved = wish.withColumn("shard", F.when(granted, F.col("target")).otherwise(F.col("shard")))
        cells = moved.drop("target")
        load = loads(cells)

    together = cells.groupBy("gid", "shard").agg(F.ceil(F.log2(F.sum("n") + 1)).alias("bits"))
    cells = cells.join(together, ["gid", "shard"]).select("gid", "home", "shard", "bits")
    placed = scratch.save(base.join(cells, ["gid", "home"], "left"), "placed")
    # a shard keeps the groups it holds most of
    in_shard = _ranked(placed.where("shard IS NOT NULL"), "shard", "gid", "rid", n, n_shards, "bits")
    in_shard = in_shard.withColumn(
        "shard", F.when(F.col("rank") < F.get(_longs(quota), F.col("shard")), F.col("shard"))
    ).drop("rank")
    settled = scratch.save(in_shard.unionByName(placed.where("shard IS NULL")), "settled")

    held = {
        r["shard"]: r["n"]
        for r in settled.where("shard IS NOT NULL").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    # the largest parts of groups are placed first, the most room is filled first; in the order
    # of the group's hash, so what is left of a group stays together
    rooms = sorted(((quota[s] - held.get(s, 0), s) for s in range(n_shards)), reverse=True)
    upto = [sum(r for r, _ in rooms[: i + 1]) for i in range(n_shards)]
    hash_bits = (POOL_PARTS - 1).bit_length()
    pool = settled.where("shard IS NULL").drop("shard").withColumn("bits", F.coalesce("bits", F.lit(0)))
    pool = pool.withColumn(
        "part",
        ((64 - F.col("bits")) * POOL_PARTS + F.shiftrightunsigned("gid", 64 - hash_bits)).cast("int"),
    )
    # at most 65 x POOL_PARTS rows, which one task sums and all may hold
    counts = pool.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    pool = _ranked(pool.withColumn("order", F.shiftleft("gid", hash_bits)), "part", "order", "rid", n, POOL_PARTS, "bits")
    place = F.col("first") + F.col("rank")
    filled = pool.join(F.broadcast(firsts), "part").withColumn(
        "shard",
        F.get(F.array(*[F.lit(s) for _, s in rooms]), F.size(F.filter(_longs(upto), lambda x: x <= place))),
    )
    columns = ["rid", "doc_id", "size", "text_crc32", "shard"]
    final = scratch.save(
        settled.where("shard IS NOT NULL").select(*columns).unionByName(filled.select(*columns)), "final"
    )
    slots = _ranked(final.withColumn("order", F.xxhash64("rid")), "shard", "order", "rid", n, n_shards)
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("rank").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
