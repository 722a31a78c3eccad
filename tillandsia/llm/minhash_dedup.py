"""MinHash near-deduplication with sequential Bayesian verification.

Each document's shingle set gets a signature of minimum hashes. Documents with
equal sets form one class. Bands of the signature put classes into buckets;
pairs from buckets are compared batch by batch of the signature and dropped as
soon as the posterior chance that they are similar enough falls under the
miss probability; what survives is verified on the full shingle sets.

Buckets are not expanded into all pairs. In each of a few rounds, every bucket
compares its members with one centre, verified links join components, and
buckets whose members are all in one component are done. Members of what is
left are compared block by block inside tasks, only across components: first
signatures alone, in wide blocks; then the full sets of the members with a
partner that survives, in tasks that return the components they join and no
pairs. So a thousand copies of one page cost a few thousand comparisons, a
member without such a partner never moves its set, and every pair that shares
a bucket and could join two components is compared (banding and pruning miss a
similar pair with the chances ``BAND_MISS`` and ``MISS``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillandsia.llm._common import Scratch, connected_components, free_name, shingle_hashes

#: Hashes of a signature, and how many are compared at a time.
HASHES, BATCH = 144, 16
#: Chance to miss a pair that is just similar enough: in banding, and in verification.
BAND_MISS, MISS = 1e-4, 1e-6
#: Rounds in which buckets compare their members with one centre.
STAR_ROUNDS = 4
#: Members of a block whose full sets meet in a task, and how many such blocks' signatures do.
BLOCK_ROWS, WIDE = 128, 8
#: Multipliers of the signature's hash functions.
_RNG = np.random.default_rng(20240229)
MULTIPLIERS = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Orders that pick the first round's centres: few, so that a group's buckets share theirs.
FIRST_ORDERS = 4


def band_rows(similarity: float, hashes: int = HASHES, miss: float = BAND_MISS) -> int:
    """The longest bands with which a pair at ``similarity`` shares none with a chance under ``miss``."""
    fits = [r for r in range(1, hashes + 1) if (1 - similarity**r) ** (hashes // r) <= miss]
    return max(fits, default=1)


@lru_cache
def least_matches(similarity: float, miss: float, hashes: int = HASHES, batch: int = BATCH) -> tuple[tuple[int, int], ...]:
    """For each number of hashes compared, the matches below which a pair is dropped.

    With a uniform prior, the posterior chance of at least ``similarity`` after
    ``m`` matches of ``n`` is that of at most ``m`` successes in ``n + 1``
    trials with that chance each.
    """
    out = []
    for n in [*range(batch, hashes, batch), hashes]:
        total, m = 0.0, 0
        while True:
            total += comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
            if total >= miss:
                break
            m += 1
        out.append((n, m))
    return tuple(out)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row per set (none empty): the minimum of each hash function, as 32-bit integers."""
    out = np.empty((len(sets), HASHES), "<u4")
    begin, size = 0, 0
    for i, hashes in enumerate(sets):
        size += len(hashes)
        if size < 1 << 15 and i < len(sets) - 1:
            continue
        # a few sets at a time, so that the work fits into the CPU's cache
        joined = np.concatenate(sets[begin : i + 1])
        starts = np.r_[0, np.cumsum([len(h) for h in sets[begin:i]])].astype(np.int64)
        hashed = np.empty_like(joined)
        for k in range(HASHES):
            np.multiply(joined, MULTIPLIERS[k], out=hashed)
            out[begin : i + 1, k] = np.minimum.reduceat(hashed, starts) >> np.uint64(32)
        begin, size = i + 1, 0
    return out


def survivors(
    a: np.ndarray, b: np.ndarray, similarity: float, miss: float, rows: np.ndarray | None = None
) -> np.ndarray:
    """Indices of the rows of ``a`` whose signatures stay likely enough to be similar to those of ``b``.

    ``b`` has a row for each of ``a``, or is one signature for all. ``rows``:
    the only ones compared, all if not given.
    """
    left = np.arange(len(a)) if rows is None else rows
    matches, done = np.zeros(len(left), np.int64), 0
    for n, least in least_matches(similarity, miss):
        other = b[left, done:n] if b.ndim == 2 else b[done:n]
        matches = matches + (a[left, done:n] == other).sum(axis=1)
        keep = matches >= least
        left, matches, done = left[keep], matches[keep], n
    return left


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, HASHES)


def minhash_components(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    miss: float = MISS,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, component_id, kept)`` for every row of ``docs``.

    A-Z is lower-cased and words are runs of other characters than ASCII white
    space. A document's set holds its distinct shingles of ``words`` words;
    with fewer, the whole sequence as one; without words, or for a null text,
    it is empty and links with nothing. Documents link when ``100 * |A & B| >=
    percent * |A | B|``. ``component_id`` is the smallest id reachable by
    links, itself included; ``kept``: it is the row's own. A null id counts as
    larger than any other and is no component's id unless it has no other;
    rows that repeat an id are documents of their own. ``text_hash`` is
    Spark's ``xxhash64`` of the text, to find the row again. Ids are cast to
    ``bigint``. An empty table
    gives an empty table. Other columns are ignored, whatever their names.
    """
    spark, similarity = docs.sparkSession, percent / 100
    scratch = Scratch(spark, "minhash")
    rows_per_band = band_rows(similarity)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 1024):
                batch = whole.slice(begin, 1024)
                sets = [shingle_hashes((t or b"").lower().split(), words) for t in batch.column(2).to_pylist()]
                count = [len(s) for s in sets]
                digest = [hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in sets]
                minima = iter(signatures([s for s in sets if len(s)]))
                signed = [next(minima).tobytes() if n else None for n in count]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(count, pa.int64()),
                        pa.array(digest, pa.binary()),
                        pa.array(signed, pa.binary()),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "digest", "sig"],
                )

    signed = scratch.save(
        rows.select("doc_id", "text_hash", F.col("text").cast("binary")).mapInArrow(
            sign, "doc_id bigint, text_hash bigint, n_shingles bigint, digest binary, sig binary"
        ),
        "signed",
    )

    # equal sets are one class; its number follows the order of the smallest ids
    row_key = F.xxhash64("doc_id", "text_hash")
    classes = (
        signed.where("n_shingles > 0")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.min(row_key).alias("row_key"), F.first("sig").alias("sig"))
        .orderBy(F.col("first_id").asc_nulls_last())
    )
    classes = scratch.save(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    sig_of = classes.select("cid", "sig")

    bands = HASHES // rows_per_band
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda i: F.xxhash64(i, F.substring("sig", i * (4 * rows_per_band) + 1, F.lit(4 * rows_per_band))),
    )
    banded = classes.select("cid", F.posexplode(keys).alias("band", "key"))
    # a number xor a mask orders the classes in a way of its own for each mask
    mask = F.shiftrightunsigned(F.xxhash64(F.pmod("key", F.lit(FIRST_ORDERS)), F.lit(0)), 2)
    buckets = (
        banded.groupBy("key")
        .agg(F.min(F.col("cid").bitwiseXOR(mask)).alias("low"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("key", "n", F.col("low").bitwiseXOR(mask).alias("centre"))
    )
    # written, so that the join has a stage of its own, in which a very full bucket can be split
    buckets = scratch.save(buckets, "buckets-0")
    active = banded.join(buckets, "key").select(
        "key", "band", "cid", "n", "centre", F.col("cid").alias("root"), F.col("centre").alias("centre_root")
    )
    active = scratch.save(active, "active-0")

    # the full sets of what is in buckets, from one row of each class
    wanted = active.select("cid").distinct().join(classes.select("cid", "row_key", "digest"), "cid")
    texts = (
        rows.withColumn("row_key", F.xxhash64("doc_id", "text_hash"))
        .select("row_key", "text")
        .join(wanted, "row_key")
        .groupBy("row_key", "cid", "digest")
        .agg(F.first("text").cast("binary").alias("text"))
    )

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 512):
                batch = whole.slice(begin, 512)
                cid, sets = [], []
                for c, digest, text in zip(*(x.to_pylist() for x in batch.columns)):
                    found = shingle_hashes((text or b"").lower().split(), words)
                    if hashlib.blake2b(found, digest_size=16).digest() == digest:
                        cid.append(c)
                        sets.append(found.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cid, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["cid", "shingles"]
                )

    sets = scratch.save(
        texts.select("cid", "digest", "text").mapInArrow(full, "cid bigint, shingles array<bigint>"), "sets"
    )

    def verified(pairs: DataFrame) -> DataFrame:
        """The roots ``(a, b)`` of pairs ``(x, y)`` that link, by their full sets."""
        x = sets.select(F.col("cid").alias("x"), F.col("shingles").alias("set_x"))
        y = sets.select(F.col("cid").alias("y"), F.col("shingles").alias("set_y"))
        shared = F.size(F.array_intersect("set_x", "set_y"))
        either = F.size("set_x") + F.size("set_y") - shared
        return pairs.join(x, "x").join(y, "y").where(100 * shared >= percent * either).select("a", "b").distinct()

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = survivors(_signatures(batch.column(4)), _signatures(batch.column(5)), similarity, miss)
                yield batch.select([0, 1, 2, 3]).take(pa.array(keep))

    roots = scratch.save(active.select("cid", "root").distinct(), "roots-0")

    def joined(links: DataFrame, i: int) -> DataFrame:
        """``roots`` after joining components by ``links(a, b)`` between their roots."""
        merged = connected_components(links, scratch, f"merged-{i}")
        merged = merged.where("node <> root").select(F.col("node").alias("root"), F.col("root").alias("new"))
        out = roots.join(merged, "root", "left").select("cid", F.coalesce("new", "root").alias("root"))
        out = scratch.save(out, f"roots-{i}")
        scratch.drop(f"links-{i}", f"roots-{i - 1}")
        return out

    def mixed(i: int) -> DataFrame:
        """The buckets of ``active`` that still hold several components, with a new centre each."""
        members = scratch.save(active.select("key", "band", "cid").join(roots, "cid"), f"members-{i}")
        mask = F.shiftrightunsigned(F.xxhash64("key", F.lit(i)), 2)
        left = (
            members.groupBy("key")
            .agg(
                F.min("root").alias("lo"),
                F.max("root").alias("hi"),
                F.count(F.lit(1)).alias("n"),
                F.min(F.struct(F.col("cid").bitwiseXOR(mask).alias("o"), "cid", "root")).alias("c"),
            )
            .where("lo < hi")
            .select("key", "n", F.col("c.cid").alias("centre"), F.col("c.root").alias("centre_root"))
        )
        left = scratch.save(left, f"buckets-{i}")
        out = scratch.save(members.join(left, "key"), f"active-{i}")
        scratch.drop(f"members-{i}", f"active-{i - 1}", f"buckets-{i}")
        return out

    for i in range(1, STAR_ROUNDS + 1):
        stars = (
            active.where("root <> centre_root")
            .select(
                F.least("cid", "centre").alias("x"),
                F.greatest("cid", "centre").alias("y"),
                F.least("root", "centre_root").alias("a"),
                F.greatest("root", "centre_root").alias("b"),
            )
            .distinct()
            .join(sig_of.select(F.col("cid").alias("x"), F.col("sig").alias("sig_x")), "x")
            .join(sig_of.select(F.col("cid").alias("y"), F.col("sig").alias("sig_y")), "y")
            .select("x", "y", "a", "b", "sig_x", "sig_y")
        )
        candidates = stars.mapInArrow(likely, "x bigint, y bigint, a bigint, b bigint")
        links = scratch.save(verified(candidates), f"links-{i}")
        if links.isEmpty():
            break
        roots = joined(links, i)
        active = mixed(i)
        if active.isEmpty():
            break

    # what is left: block against block, only across components; first signatures alone, in wide blocks
    ways = F.ceil(F.col("n") / block_rows).cast("int")
    wide = F.floor(F.col("block") / WIDE).cast("int")
    dealt = (
        active.join(sig_of, "cid")
        .withColumn("block", F.pmod(F.xxhash64("cid"), ways).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.floor((ways - 1) / WIDE).cast("int"))))
        .select(
            "key",
            F.least(wide, "other").alias("i"),
            F.greatest(wide, "other").alias("j"),
            "band",
            "block",
            "cid",
            "root",
            "sig",
        )
    )

    def partners(
        left: np.ndarray, right: np.ndarray, root: np.ndarray, sig: np.ndarray, band: int
    ) -> Iterator[tuple[int, np.ndarray]]:
        """Each row of ``left`` with those of ``right`` that survive beside it, every pair once."""
        begin, both_ways = band * rows_per_band, left is not right
        for p in left:
            q = right[(root[right] != root[p]) & ((right > p) | both_ways)]
            q = survivors(sig, sig[p], similarity, miss, q)
            # a pair that meets in several buckets is compared in that of its first common band
            same = sig[q, :begin].reshape(len(q), band, rows_per_band) == sig[p, :begin].reshape(band, rows_per_band)
            q = q[~same.all(axis=2).any(axis=1)]
            if len(q):
                yield p, q

    def likely_members(table: pa.Table) -> pa.Table:
        """The members with a partner that survives, once for each pair of narrow blocks in which they have one."""
        table = table.combine_chunks()
        i, j, band = (table.column(c)[0].as_py() for c in ("i", "j", "band"))
        block, root = table.column("block").to_numpy(), table.column("root").to_numpy()
        left = np.flatnonzero(block // WIDE == i)
        right = left if i == j else np.flatnonzero(block // WIDE == j)
        wanted = np.zeros((len(block), WIDE * WIDE), bool)
        for p, q in partners(left, right, root, _signatures(table.column("sig")), band):
            at = (np.minimum(block[p], block[q]) - i * WIDE) * WIDE + np.maximum(block[p], block[q]) - j * WIDE
            wanted[p, at] = wanted[q, at] = True
        row, at = np.nonzero(wanted)
        out = table.take(pa.array(row))
        for name, column in (("i", at // WIDE + i * WIDE), ("j", at % WIDE + j * WIDE)):
            place = out.schema.get_field_index(name)
            out = out.set_column(place, name, pa.array(column, pa.int32()))
        return out

    # written, so that the sets' join sees how little is left
    met = scratch.save(dealt.groupBy("key", "i", "j").applyInArrow(likely_members, dealt.schema), "met")
    dealt = met.join(sets, "cid").select(*met.columns, "shingles")

    def across(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        i, j, band = (table.column(c)[0].as_py() for c in ("i", "j", "band"))
        block, root = table.column("block").to_numpy(), table.column("root").to_numpy()
        lists = pa.concat_arrays(table.column("shingles").chunks)
        # sorted as they were hashed, without signs
        flat, ends = lists.flatten().to_numpy().view(np.uint64), np.cumsum(lists.value_lengths().to_numpy())
        full = np.split(flat, ends[:-1])
        joins: dict[int, int] = {}

        def find(x: int) -> int:
            while joins.get(x, x) != x:
                x = joins[x]
            return x

        left = np.flatnonzero(block == i)
        right = left if i == j else np.flatnonzero(block == j)
        for p, q in partners(left, right, root, _signatures(table.column("sig")), band):
            for k in q:
                a, b = find(int(root[p])), find(int(root[k]))
                if a == b:
                    continue
                x, y = (full[p], full[k]) if len(full[p]) < len(full[k]) else (full[k], full[p])
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                shared = int((y[at] == x).sum())
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    joins[max(a, b)] = min(a, b)
        return pa.table({"a": pa.array(list(joins), pa.int64()), "b": pa.array(list(joins.values()), pa.int64())})

    found = dealt.groupBy("key", "i", "j").applyInArrow(across, "a bigint, b bigint")
    last = STAR_ROUNDS + 1
    roots = joined(scratch.save(found.distinct(), f"links-{last}"), last)
    scratch.drop("sets", "met")

    heads = classes.select(F.col("cid").alias("root"), F.col("first_id").alias("component_id"))
    reached = roots.join(heads, "root").select("cid", "component_id", F.lit(True).alias("reached"))
    known = (
        classes.select("cid", "digest", "first_id")
        .join(reached, "cid", "left")
        .select("digest", F.when(F.col("reached"), F.col("component_id")).otherwise(F.col("first_id")).alias("component_id"))
    )
    some = signed.where("n_shingles > 0").select("doc_id", "text_hash", "n_shingles", "digest").join(known, "digest")
    none = signed.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "text_hash", "n_shingles", "component_id"]
    return (
        some.select(*columns)
        .unionByName(none.select(*columns))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def near_dedup(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group the smallest id.

    Groups are the components of ``minhash_components``; ids are integers, or
    strings of digits, compared as ``bigint`` (others raise). Rows that repeat
    the id that stays, in one group, all stay; exact deduplication before
    removes those with equal texts. Null and empty texts, and those without
    words, link with nothing and stay; rows with a null id stay if no row of
    their group has one. An empty table gives an empty table. Columns may have
    any names.
    """
    found = minhash_components(docs, words, percent, id_col=id_col, text_col=text_col)
    id_name, hash_name = free_name(docs, "id_that_stays"), free_name(docs, "hash_that_stays")
    stay = found.where("kept").select(F.col("doc_id").alias(id_name), F.col("text_hash").alias(hash_name)).distinct()
    same = F.col(f"`{id_col}`").cast("bigint").eqNullSafe(F.col(id_name)) & F.xxhash64(
        F.col(f"`{text_col}`").cast("string")
    ).eqNullSafe(F.col(hash_name))
    return docs.join(stay, same, "left_semi")
