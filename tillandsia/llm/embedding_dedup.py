"""Embedding near-deduplication: spherical k-means cells and blocked cosine products.

Centres are fitted on a bounded sample. Every vector has a home cell, that of
its nearest centre, and also visits each other cell in which a vector within
the threshold's angle could be at home (of two cells, only the first one's
vectors visit the other, so that a pair meets once): if ``y`` is nearer to centre ``c`` than
to ``c0``, and the angle of ``x`` and ``y`` is at most ``t``, then
``<x, c0 - c> <= sin(t) |c0 - c|``. Comparing residents with residents and
visitors inside each cell therefore finds every link, whatever the centres
are; they only decide how much is compared. Cells are cut into blocks, and a
task compares one block of residents with one of those who come: first the
products of their leading directions plus the most that the rest could add,
then in full what these leave.

No pairs leave a task: of the links it finds it returns each vector's count
and a forest that connects the same vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillandsia.llm._common import Scratch, connected_components

#: Vectors of a cell on average while there are fewer than MAX_CELLS, and the most in a block.
CELL_ROWS, BLOCK_ROWS = 8192, 32768
#: Bounds of what is fitted and broadcast: sampled vectors, cells, and bytes of either.
SAMPLE_ROWS, MAX_CELLS, FIT_BYTES = 20_000, 4096, 16 << 20
#: Rounds of k-means.
ROUNDS = 8
#: What a row is in a block: at home there, or come to be compared from there or another cell.
RESIDENT, NEIGHBOUR, VISITOR = 0, 1, 2
#: Rows of a tile inside a block's product, and the share of a vector's directions that lead.
TILE, LEADING = 512, 4
#: Places that a batch of vectors may be dealt to before it is sent on.
DEALT_ROWS = 16384


def unit_rows(vectors: pa.Array, dims: int) -> np.ndarray:
    """The first ``dims`` components of a list column's rows at length 1, in double precision; shorter ones end in zeros."""
    length = vectors.value_lengths().to_numpy()
    out = np.zeros((len(vectors), dims))
    if not len(length):
        return out
    begin, flat = np.cumsum(length) - length, vectors.flatten().to_numpy().astype(np.float64, copy=False)
    flat = flat / np.repeat(np.maximum.reduceat(np.abs(flat), begin), length)
    flat /= np.repeat(np.sqrt(np.add.reduceat(flat * flat, begin)), length)
    row = np.repeat(np.arange(len(vectors)), length)
    place = np.arange(len(row)) - begin[row]
    kept = place < dims
    out[row[kept], place[kept]] = flat[kept]
    return out


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """``k`` unit centres for unit rows; a centre without members stays where it is."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
    return centres


def cells_of(x: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit row, and the cells it visits: where its possible neighbours live.

    Of two cells, vectors of the one with the smaller number visit the other,
    so that a pair meets once; all come to their home too.
    """
    near = x @ centres.T
    home = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
    # an angle over 90 degrees bounds nothing
    sine = math.sqrt(max(0.0, 1 - threshold * threshold)) if threshold > 0 else 2.0
    visits = near[np.arange(len(x)), home][:, None] - near <= sine * apart[home] + 1e-9
    return home, visits & (np.arange(len(centres)) >= home[:, None])


def leading_directions(x: np.ndarray) -> np.ndarray:
    """Orthonormal columns that hold much of the rows' squares, by one power iteration from random ones.

    A ``LEADING``-th of the dimensions, or as many as fit into ``FIT_BYTES``.
    Whatever they are, the bound by them holds; they decide how much it leaves.
    """
    dims = x.shape[1]
    m = max(1, min(dims // LEADING, FIT_BYTES // (8 * dims)))
    return np.linalg.qr(x.T @ (x @ np.random.default_rng(0).normal(size=(dims, m))))[0]


def _led(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Rows whose products bound those of unit rows from above: the led parts, and the length of what is left."""
    led = x @ axes
    left = np.sqrt(np.maximum(0, 1 - np.einsum("nd,nd->n", led, led)))
    return np.concatenate([led, left[:, None]], axis=1).astype(np.float32)


def linked_pairs(
    a: np.ndarray, b: np.ndarray, threshold: float, axes: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with ``a[i] . b[j] >= threshold`` in double precision, tile by tile.

    Single-precision products, exact to 1e-4 here, pick what is computed in
    double. With ``axes``, orthonormal columns, the shorter products of what
    lies along them, plus those of the lengths of the rest (Cauchy-Schwarz),
    pick first; tiles in which that leaves many pairs go on with whole rows.
    """
    a32, b32 = a.astype(np.float32), b.astype(np.float32)
    if axes is not None:
        la, lb = _led(a, axes), _led(b, axes)
    for s in range(0, len(a), TILE):
        for t in range(0, len(b), TILE):
            i = None
            if axes is not None:
                i, j = np.divmod(np.flatnonzero(la[s : s + TILE] @ lb[t : t + TILE].T >= threshold - 1e-4), len(b[t : t + TILE]))
            if i is None or len(i) > 4 * TILE:
                i, j = np.divmod(np.flatnonzero(a32[s : s + TILE] @ b32[t : t + TILE].T >= threshold - 1e-4), len(b[t : t + TILE]))
            if not len(i):
                continue
            if len(i) <= 4 * TILE:
                exact = np.einsum("nd,nd->n", a[s + i], b[t + j])
            else:
                exact = (a[s : s + TILE] @ b[t : t + TILE].T)[i, j]
            keep = exact >= threshold
            yield s + i[keep], t + j[keep]


def places_of(
    home: np.ndarray, visits: np.ndarray, lot: np.ndarray, blocks: np.ndarray, first_block: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which row goes to which block pair in which role: residents to all pairs of their block, comers too.

    ``blocks`` has each cell's numbers of blocks of residents and of comers,
    ``lot`` says in which of them a row is.
    """

    def each(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        which = np.repeat(np.arange(len(n)), n)
        return which, np.arange(len(which)) - (np.cumsum(n) - n)[which]

    stay, nth = each(blocks[home, 1])
    at = home[stay]
    stays = first_block[at] + lot[stay] % blocks[at, 0] * blocks[at, 1] + nth
    comer, cell = np.nonzero(visits)
    which, nth = each(blocks[cell, 0])
    come, at = comer[which], cell[which]
    comes = first_block[at] + nth * blocks[at, 1] + lot[come] % blocks[at, 1]
    role = np.concatenate([np.full(len(stay), RESIDENT), np.where(at == home[come], NEIGHBOUR, VISITOR)])
    return np.concatenate([stay, come]), np.concatenate([stays, comes]), role.astype(np.int32)


def merge_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``labels`` (each at most its index) after joining ``i`` and ``j`` element by element."""
    while True:
        a, b = labels[i], labels[j]
        differ = a != b
        if not differ.any():
            return labels
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while (labels[labels] != labels).any():
            labels = labels[labels]


def embedding_components(
    vectors: DataFrame,
    threshold: float = 0.95,
    block_rows: int = BLOCK_ROWS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``.

    Vectors link when their cosine in double precision is at least
    ``threshold``. ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable by links, itself included,
    and ``kept`` says that it is the row's own: one representative per group.
    Vectors that are null, empty, all zero or hold null or non-finite
    components link with nothing, and vectors link only with those of their
    own length. A null id counts as larger than any other; rows that repeat an
    id are vectors of their own. An empty table gives an empty table. Other
    columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embedding")
    # floats are moved as they are, which is half the bytes, and widened where they are compared
    given = vectors.select(vector_col).schema[0].dataType.simpleString()
    vector_type = given if given == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast(vector_type).alias("v")).withColumn(
        "usable",
        F.coalesce(
            (F.size("v") > 0)
            & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
            & F.exists("v", lambda x: x != 0),
            F.lit(False),
        ),
    )
    usable = rows.where("usable").select("vec_id", "v")
    # equal vectors are one class; its number follows the order of the smallest ids
    classes = usable.groupBy("v").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    classes = scratch.save(
        classes.orderBy(F.col("first_id").asc_nulls_last()).withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    n, mean = classes.agg(F.count(F.lit(1)), F.avg(F.size("v"))).first()
    alone = rows.where("NOT usable").select(
        "vec_id",
        F.lit(0).cast("bigint").alias("n_links"),
        F.col("vec_id").alias("component_id"),
        F.lit(True).alias("kept"),
    )
    if not n:
        return alone
    # as many rows in a block as its bytes allow, but at small sizes some pairs of blocks for each core
    cell_rows = max(64, min(CELL_ROWS, block_rows, int(FIT_BYTES // (8 * mean))))
    spread = n // (2 * math.isqrt(spark.sparkContext.defaultParallelism) + 1)
    block_rows = max(64, min(block_rows, int(FIT_BYTES // (8 * mean)), max(cell_rows, spread)))
    # centres have the sample's most common length; of longer vectors they see the first components
    common = classes.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE_ROWS).groupBy(F.size("v").alias("s")).count()
    dims = common.orderBy(F.col("count").desc(), "s").first()["s"]
    most = max(1, min(SAMPLE_ROWS, FIT_BYTES // (8 * dims)))
    sample = classes.where(F.size("v") == int(dims)).orderBy(F.xxhash64("cid"), "cid").limit(most).select("v").collect()
    k = max(1, min(MAX_CELLS, len(sample) // 4, -(-n // cell_rows)))
    fitted = unit_rows(pa.array([r["v"] for r in sample], pa.list_(pa.float64())), dims)
    centres, axes = spherical_kmeans(fitted, k), leading_directions(fitted)
    # rows of a batch whose products with all centres are held at once
    step = max(16, min(2048, (1 << 20) // k))

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, step):
                yield batch.slice(begin, step)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        homes, comers = np.zeros(k, np.int64), np.zeros(k, np.int64)
        for batch in slices(batches):
            home, visits = cells_of(unit_rows(batch.column(0), dims), centres, threshold)
            homes += np.bincount(home, minlength=k)
            comers += visits.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"cell": np.arange(k), "homes": homes, "comers": comers})

    per_cell = (
        classes.select("v").mapInArrow(count, "cell bigint, homes bigint, comers bigint")
        .groupBy("cell").agg(F.sum("homes").alias("homes"), F.sum("comers").alias("comers")).collect()
    )
    blocks = np.ones((k, 2), np.int64)
    for r in per_cell:
        blocks[r["cell"]] = [max(1, -(-r["homes"] // block_rows)), max(1, -(-r["comers"] // block_rows))]
    first_block = np.r_[0, np.cumsum(blocks[:, 0] * blocks[:, 1])]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            home, visits = cells_of(unit_rows(batch.column(2), dims), centres, threshold)
            lot = batch.column(0).to_numpy() * np.int64(0x9E3779B1) >> 7 & 0x7FFFFFFF
            row, block, role = places_of(home, visits, lot, blocks, first_block)
            for a in range(0, len(row), DEALT_ROWS):
                taken = batch.take(pa.array(row[a : a + DEALT_ROWS]))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(block[a : a + DEALT_ROWS]), pa.array(role[a : a + DEALT_ROWS])],
                    names=["cid", "copies", "v", "block", "role"],
                )

    dealt = classes.select("cid", "copies", "v").mapInArrow(
        deal, f"cid bigint, copies bigint, v {vector_type}, block bigint, role int"
    )

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        cid, copies, role = (table.column(c).to_numpy() for c in ("cid", "copies", "role"))
        vectors = pa.concat_arrays(table.column("v").chunks)
        length = vectors.value_lengths().to_numpy()
        # labels run over distinct classes in the order of their numbers
        order, place = np.unique(cid, return_inverse=True)
        labels, links = np.arange(len(order)), np.zeros(len(order), np.int64)
        # vectors link with those of their own length only, so a long one lengthens no other
        for size in np.unique(length[role == RESIDENT]):
            home, come = (np.flatnonzero((length == size) & at) for at in (role == RESIDENT, role != RESIDENT))
            x, y = (unit_rows(vectors.take(pa.array(at)), int(size)) for at in (come, home))
            for i, j in linked_pairs(x, y, threshold, axes if size == dims else None):
                i, j = come[i], home[j]
                # residents of one cell meet twice, and themselves
                ok = (role[i] == VISITOR) | (cid[i] < cid[j])
                i, j = i[ok], j[ok]
                np.add.at(links, place[i], copies[j])
                np.add.at(links, place[j], copies[i])
                labels = merge_labels(labels, place[i], place[j])
        some = np.flatnonzero((links > 0) | (labels != np.arange(len(order))))
        return pa.table({"cid": order[some], "links": links[some], "root": order[labels[some]]})

    found = scratch.save(
        dealt.groupBy("block").applyInArrow(compare, "cid bigint, links bigint, root bigint"), "found"
    )
    roots = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")), scratch, "edges")
    heads = classes.select(F.col("cid").alias("root"), F.col("first_id").alias("component_id"))
    linked = found.groupBy("cid").agg(F.sum("links").alias("links"))
    reached = roots.join(heads, "root").select(F.col("node").alias("cid"), "component_id")
    known = (
        classes.join(linked, "cid", "left")
        .join(reached.withColumn("reached", F.lit(True)), "cid", "left")
        .select(
            "v",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.when(F.col("reached"), F.col("component_id")).otherwise(F.col("first_id")).alias("component_id"),
        )
    )
    return usable.join(known, "v").select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    ).unionByName(alone)
