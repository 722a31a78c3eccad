"""Exact integer k-means by shallot search.

Vectors are whole numbers, and a centroid is the floor of its vectors' mean,
so a run has one right answer. Rounds read and write a table of blocks of
vectors; each vector remembers its nearest centroid, an upper bound of the
distance to it, its second-nearest centroid, and a lower bound of the distance
to every other one. After the centroids have moved, a vector whose bounds
still separate it is skipped. For any other the search starts at the closer of
its two remembered centroids and goes through that one's neighbours, nearest
first. Only centroids within the ball of radius (distance to the start +
distance to the second-best so far) can be among the two nearest; the ball
shrinks with every better find and the search of a vector ends at its edge.
What is met inside is compared in integers; ties go to the smaller number.

Bounds are doubles with a margin far above their rounding, so that they never
skip what integers would decide otherwise.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillandsia.llm._common import Scratch

#: Vectors of a block.
BLOCK_ROWS = 4096
#: Largest component, in absolute value, that keeps all distances and sums in 64 bits.
LARGEST = 1 << 26
#: Relative margin of the bounds.
MARGIN = 1e-9

_STATE = "ids binary, nulls binary, x binary, wide int, near binary, second binary, upper binary, lower binary, sums array<bigint>"


def squared(x: np.ndarray, centroids: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Squared distances of rows of ``x`` to the centroids numbered ``which``, as integers."""
    d = x.astype(np.int64) - centroids[which]
    return np.einsum("nd,nd->n", d, d)


def neighbours(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid all by distance, itself first, and those distances."""
    apart = np.stack([np.sqrt(((centroids - c) ** 2).sum(axis=1).astype(np.float64)) for c in centroids])
    apart[np.arange(len(apart)), np.arange(len(apart))] = -1  # before any that is equal
    order = np.argsort(apart, axis=1, kind="stable")
    return order, np.maximum(np.take_along_axis(apart, order, axis=1), 0)


def shallot(
    x: np.ndarray, centroids: np.ndarray, order: np.ndarray, apart: np.ndarray, near: np.ndarray, second: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest and second-nearest centroids, their squared distances, and how many distances that took.

    ``near`` and ``second`` are where to look first; ``order`` and ``apart``
    are those of ``neighbours``. With one centroid the second is itself.
    """
    d1, d2 = squared(x, centroids, near), squared(x, centroids, second)
    swap = (d2 < d1) | (d2 == d1) & (second < near)
    start = np.where(swap, second, near)
    best, other = start.copy(), np.where(swap, near, second)
    d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
    from_start = np.sqrt(d1.astype(np.float64))
    ball = (from_start + np.sqrt(d2.astype(np.float64))) * (1 + MARGIN)
    first_other, live, work = other.copy(), np.arange(len(x)), 2 * len(x)
    for step in range(1, len(centroids)):
        live = live[apart[start[live], step] <= ball[live]]
        if not len(live):
            break
        tried = order[start[live], step]
        fresh = tried != first_other[live]
        at, tried = live[fresh], tried[fresh]
        if not len(at):
            continue
        d = squared(x[at], centroids, tried)
        work += len(at)
        first = (d < d1[at]) | (d == d1[at]) & (tried < best[at])
        # nearer than the nearest: that one becomes the second
        a = at[first]
        other[a], d2[a] = best[a], d1[a]
        best[a], d1[a] = tried[first], d[first]
        among = ~first & ((d < d2[at]) | (d == d2[at]) & (tried < other[at]))
        b = at[among]
        other[b], d2[b] = tried[among], d[among]
        moved = np.concatenate([a, b])
        ball[moved] = (from_start[moved] + np.sqrt(d2[moved].astype(np.float64))) * (1 + MARGIN)
    return best, other, d1, d2, work


def assign(
    x: np.ndarray,
    centroids: np.ndarray,
    order: np.ndarray,
    apart: np.ndarray,
    drift: np.ndarray,
    near: np.ndarray,
    second: np.ndarray,
    upper: np.ndarray,
    lower: np.ndarray,
) -> int:
    """One round over a block: updates the vectors' state in place; returns the distances computed.

    ``drift`` is how far each centroid has moved since the state was right.
    """
    if len(centroids) == 1:
        return 0
    upper += drift[near]
    top = np.argsort(drift)[-2:]
    lower -= np.where(near == top[1], drift[top[0]], drift[top[1]])
    half = apart[:, 1] / 2
    bound = np.maximum(half[near], lower) * (1 - MARGIN)
    open_ = np.flatnonzero(upper * (1 + MARGIN) >= bound)
    if len(open_):  # the true distance may still be under the bound
        upper[open_] = np.sqrt(squared(x[open_], centroids, near[open_]).astype(np.float64))
    work = len(open_)
    open_ = open_[upper[open_] * (1 + MARGIN) >= bound[open_]]
    if len(open_):
        a, b, d1, d2, more = shallot(x[open_], centroids, order, apart, near[open_], second[open_])
        near[open_], second[open_] = a, b
        upper[open_], lower[open_] = np.sqrt(d1.astype(np.float64)), np.sqrt(d2.astype(np.float64))
        work += more
    return work


def _sums(x: np.ndarray, near: np.ndarray, k: int) -> np.ndarray:
    """For each centroid its vectors' count and component sums."""
    out = np.zeros((k, 1 + x.shape[1]), np.int64)
    out[:, 0] = np.bincount(near, minlength=k)
    order = np.argsort(near, kind="stable")
    begin = np.flatnonzero(np.r_[True, np.diff(near[order]) > 0])
    out[near[order[begin]], 1:] = np.add.reduceat(x[order].astype(np.int64), begin)
    return out


def centroid_clusters(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    salt: str = "2:",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance)`` of every kept row of ``vectors``, and the final centroids.

    Kept are vectors of exactly ``dims`` components, none null or non-finite;
    a component ``x`` counts as the integer ``floor(scale * x)``, ``x`` in
    double precision. The first centroids are the ``k`` kept vectors whose
    ids, in decimal after ``salt``, have the smallest SHA-256, in that order;
    ids that repeat are taken in the order of their vectors, null ids last.
    With fewer kept vectors all are centroids. Each of ``rounds`` rounds
    assigns every vector to the nearest centroid (squared Euclidean distance,
    ties: the smaller number) and moves each centroid that has vectors to the
    floor of their mean; then vectors are assigned once more. ``distance`` is
    the squared distance to the own centroid. Ids are ``bigint``; null ids and
    rows that repeat an id pass through, one output row each. An integer of
    ``LARGEST`` or more (less from 1024 dimensions on) raises, as distances might not fit 64 bits. No kept vector
    gives an empty table and no centroids. Other columns are ignored, whatever
    their names.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "centroids")
    v = F.col(vector_col)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    scaled = F.transform(v.cast("array<double>"), lambda c: c * F.lit(float(scale)))
    largest = min(LARGEST, math.isqrt((1 << 62) // dims) // 2)
    kept = (
        vectors.where((F.size(v) == dims) & finite)
        .select(F.col(id_col).cast("bigint").alias("vec_id"), scaled.alias("x"))
        .select(
            "vec_id",
            F.when(F.forall("x", lambda c: F.abs(c) < largest), F.transform("x", lambda c: F.floor(c)))
            .otherwise(F.raise_error(F.lit(f"a component is over {largest} after scaling")).cast("array<bigint>"))
            .alias("x"),
        )
    )

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, block_rows):
                part = batch.slice(begin, block_rows)
                n = part.num_rows
                x = part.column(1).flatten().to_numpy().reshape(n, dims)
                wide = next(w for w in (2, 4) if w == 4 or np.abs(x).max(initial=0) < 1 << 15)
                ids, null = part.column(0).fill_null(0).to_numpy(), part.column(0).is_null().to_numpy(zero_copy_only=False)
                state = [np.zeros(n, "<i4"), np.ones(n, "<i4"), np.full(n, np.inf), np.full(n, -np.inf)]
                columns = [ids.astype("<i8"), null.astype(np.uint8), x.astype(f"<i{wide}")]
                yield _row([*columns, *state], wide, None)

    def _row(columns: list[np.ndarray], wide: int, sums: np.ndarray | None) -> pa.RecordBatch:
        ids, null, x, *state = columns
        values = [[ids.tobytes()], [null.tobytes()], [x.tobytes()], [wide], *([s.tobytes()] for s in state)]
        names = ["ids", "nulls", "x", "wide", "near", "second", "upper", "lower"]
        types = [pa.binary()] * 3 + [pa.int32()] + [pa.binary()] * 4
        arrays = [pa.array(v, t) for v, t in zip(values, types)]
        arrays.append(pa.array([None if sums is None else sums.ravel()], pa.list_(pa.int64())))
        return pa.RecordBatch.from_arrays(arrays, names=[*names, "sums"])

    def state_of(row: dict) -> tuple[list[np.ndarray], int]:
        wide = row["wide"]
        kinds = ["<i8", np.uint8, f"<i{wide}", "<i4", "<i4", "<f8", "<f8"]
        names = ["ids", "nulls", "x", "near", "second", "upper", "lower"]
        columns = [np.frombuffer(row[c], t).copy() for c, t in zip(names, kinds)]
        columns[2] = columns[2].reshape(-1, dims)
        return columns, wide

    blocks = scratch.save(kept.mapInArrow(block, _STATE), "state-0")

    hashed = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(hashed.asc_nulls_last(), "x").limit(k).select("x").collect()
    centroids = np.array([r["x"] for r in first], np.int64).reshape(-1, dims)
    n_centroids = len(centroids)
    empty = spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint")
    if not n_centroids:
        return empty, centroids

    moved = np.zeros(n_centroids)

    def round_of(centroids: np.ndarray, moved: np.ndarray):
        order, apart = neighbours(centroids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, held = np.zeros((n_centroids, 1 + dims), np.int64), None
            for batch in batches:
                for row in batch.to_pylist():
                    columns, wide = state_of(row)
                    x, near, second, upper, lower = columns[2:]
                    assign(x, centroids, order, apart, moved, near, second, upper, lower)
                    total += _sums(x, near, n_centroids)
                    if held is not None:
                        yield _row(*held, None)
                    held = columns, wide
            if held is not None:  # the task's sums go with its last block
                yield _row(*held, total)

        return run

    for i in range(1, rounds + 1):
        blocks = scratch.save(blocks.mapInArrow(round_of(centroids, moved), _STATE), f"state-{i}")
        scratch.drop(f"state-{i - 1}")
        # k * (1 + dims) rows
        added = blocks.where("sums IS NOT NULL").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")).collect()
        sums = np.zeros(n_centroids * (1 + dims), np.int64)
        for r in added:
            sums[r["pos"]] = r["s"]
        count, parts = np.split(sums.reshape(n_centroids, 1 + dims), [1], axis=1)
        after = np.where(count > 0, parts // np.maximum(count, 1), centroids)
        moved = np.sqrt(((after - centroids) ** 2).sum(axis=1).astype(np.float64)) * (1 + MARGIN)
        centroids = after
    order, apart = neighbours(centroids)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                (ids, null, x, near, second, upper, lower), _ = state_of(row)
                assign(x, centroids, order, apart, moved, near, second, upper, lower)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, mask=null.astype(bool)), pa.array(near), pa.array(squared(x, centroids, near))],
                    names=["vec_id", "cluster", "distance"],
                )

    return blocks.mapInArrow(last, "vec_id bigint, cluster int, distance bigint"), centroids


def centroid_digest(centroid: np.ndarray) -> str:
    """Lowercase hex SHA-256 of the components in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def with_inertia(clusters: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``clusters`` with ``cluster_inertia``, ``inertia`` (distances summed over the cluster and all) and ``centroid_sha256``.

    Sums are exact; one that does not fit 64 bits raises.
    """
    spark = clusters.sparkSession
    rows = Scratch(spark, "clusters").save(clusters, "assigned")
    per = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    sums = {r["cluster"]: int(r["s"]) for r in per}
    if sum(sums.values()) >= 1 << 63:
        raise OverflowError("inertia does not fit 64 bits")
    table = [(c, s, sum(sums.values()), centroid_digest(centroids[c])) for c, s in sorted(sums.items())]
    known = spark.createDataFrame(table, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # a row for each of k centroids
    return rows.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
