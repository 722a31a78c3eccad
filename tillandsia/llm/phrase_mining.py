"""Phrase collocations by vertical partitioning of a suffix tree over words.

The counts of all phrases of up to ``depth`` words come from suffix trees cut
off at that depth, built apart from each other:

1. Words are counted, then pairs of neighbours, those by hash into a table of
   fixed size. A phrase wanted has no word and no pair below the least count,
   so these only end suffixes.
2. Suffixes are divided by their first word; a word that begins more of them
   than one group may hold is extended by the second word, and so on. The
   prefixes so extended are counted on the way, level by level.
3. Prefixes are dealt to groups that fit the memory budget. A map task sorts
   the suffixes of a batch of text, merges equal ones and sends each group its
   part, with a small dictionary.
4. A group grows its subtree level by level from its leaves, the distinct
   suffixes with their totals. A node's count is the sum of its leaves'; what
   is below the least count is not grown further.

Scores, absorbed phrases and ranks are joins and windows over the nodes.
Which words are frequent, and which prefixes extended, tasks look up in
bitmaps of fixed size: a wrong hit there costs a longer suffix or prefix and
changes no count, however full they get.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillandsia.llm._common import Scratch, mix64

#: Suffixes of a group (a soft bound: prefixes are dealt by hash), and of a prefix that is not extended.
GROUP_SUFFIXES = 1 << 20
#: Bits of a bitmap, and cells in which pairs are counted, as powers of two; parts of those cells, and how many
#: tables of a part are added at a time.
BITMAP_BITS, PAIR_BITS, PAIR_PARTS, FAN_IN = 26, 27, 10, 128
#: Words of a batch in a map task, different words whose counts it holds, and bytes of text it splits at a time.
BATCH_WORDS, COUNT_WORDS, SPLIT_BYTES = 1 << 18, 150_000, 1 << 20
#: Rows of a batch that are Python objects at a time, and hashes of groups' dictionaries held before they are merged.
SLICE_ROWS, HELD_HASHES = 256, 1 << 19
#: Parts in which each language's best phrases are found first.
RANK_PARTS = 64

#: A-Z lower-cased, every character that ends a piece as a full stop.
_CLEAN = bytes(
    ord(".") if chr(b) in ".,;:!?" or 0x0A <= b <= 0x0D else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_BREAK = re.compile(rb"[ \t.,;:!?\n-\r]")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_chunks(text: bytes) -> Iterator[list[bytes]]:
    """The words of ``text``, with ``.`` between pieces, in lists of bounded length."""
    begin = 0
    while begin < len(text):
        found = _BREAK.search(text, begin + SPLIT_BYTES)
        end = found.start() if found else len(text)
        yield text[begin:end].translate(_CLEAN).replace(b".", b" . ").split()
        begin = end


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Languages and texts, a slice of a batch at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, SLICE_ROWS):
            yield from zip(*(c.to_pylist() for c in batch.slice(a, SLICE_ROWS).columns))


def word_hashes(words: list[bytes], seed: int) -> np.ndarray:
    """Signed 64-bit hashes."""
    return np.array([xxhash.xxh3_64_intdigest(w, seed) for w in words], np.uint64).view(np.int64)


def _counts(seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``(lang, h, word, n)`` of a task's words, and the number of all words with null ``h``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counter in held.items():
                counter.pop(b".", None)
                words, n = list(counter), np.fromiter(counter.values(), np.int64, len(counter))
                hashes = word_hashes(words, seed)
                for a in range(0, len(words), 50_000):
                    part = words[a : a + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(part), pa.string()),
                            pa.array(hashes[a : a + 50_000]),
                            pa.array(part, pa.binary()).cast(pa.string()),
                            pa.array(n[a : a + 50_000]),
                        ],
                        names=["lang", "h", "word", "n"],
                    )
                total = [pa.array([lang], pa.string()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.array([int(n.sum())])]
                yield pa.RecordBatch.from_arrays(total, names=["lang", "h", "word", "n"])
            held.clear()

        for lang, text in _rows(batches):
            for words in word_chunks(text):
                held.setdefault(lang, Counter()).update(words)
                if sum(map(len, held.values())) > COUNT_WORDS:
                    yield from flush()
        yield from flush()

    return run


class Bitmap:
    """A set of prefixes by one hash; never misses a member, may have others."""

    def __init__(self, data: np.ndarray, bits: int) -> None:
        self.data, self.bits = data, bits

    def __reduce__(self) -> tuple:
        # tasks get it compressed, which is short while few bits are set
        import zstandard

        return _bitmap_from, (zstandard.compress(self.data.tobytes(), 1), self.bits)

    def has(self, key: np.ndarray) -> np.ndarray:
        cell = _cells(key, self.bits)
        return (self.data[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)


def _bitmap_from(packed: bytes, bits: int) -> Bitmap:
    import zstandard

    return Bitmap(np.frombuffer(zstandard.decompress(packed), np.uint8), bits)


def _cells(key: np.ndarray, bits: int) -> np.ndarray:
    return (key >> np.uint64(64 - bits)).astype(np.int64)


def _begin(lang: np.ndarray) -> np.ndarray:
    """Keys of the empty prefix by the languages' hashes."""
    return lang.view(np.uint64)


def _extend(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keys of prefixes made longer by a word's hash."""
    return mix64((key ^ word.view(np.uint64)) * _MIX + word.view(np.uint64))


def _lang_hashes(langs: list[str]) -> np.ndarray:
    return word_hashes([lang.encode() for lang in langs], 1)


def bitmap_of(prefixes: DataFrame, bits: int = BITMAP_BITS) -> Bitmap:
    """The bitmap of ``prefixes(lang, words)``, ``words`` their words' hashes; at most ``2**bits`` bits reach the driver."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            size = lists.value_lengths().to_numpy()
            flat, begin = lists.flatten().to_numpy(), np.cumsum(size) - size
            key = _begin(_lang_hashes(batch.column(0).to_pylist()))
            for d in range(int(size.max(initial=0))):
                some = size > d
                key[some] = _extend(key[some], flat[begin[some] + d])
            yield pa.RecordBatch.from_pydict({"cell": _cells(key, bits) + 1})

    found = prefixes.select("lang", "words").mapInArrow(cells, "cell bigint")
    rows = (
        found.groupBy(F.bitmap_bucket_number("cell").alias("k"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
        .collect()
    )
    data = np.zeros(max(1, 1 << bits >> 3), np.uint8)
    for r in rows:
        part = data[(r["k"] - 1) * 4096 :][:4096]
        part[:] = np.frombuffer(r["bits"], np.uint8)[: len(part)]
    return Bitmap(data, bits)


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for; the end of a piece is 0."""

    def __init__(self) -> None:
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Suffixes:
    """The suffixes of a batch of text: up to ``depth`` local word numbers each, 0 after the end."""

    def __init__(
        self, ids: np.ndarray, words: list[bytes], lang: np.ndarray, langs: list[str], seed: int, filters: list[Bitmap], depth: int, skip: int
    ) -> None:
        self.hashes = np.concatenate([[0], word_hashes(words[1:], seed)]).astype(np.int64)
        self.langs = langs
        start = _begin(_lang_hashes(langs)) if langs else np.empty(0, np.uint64)
        key = _extend(start[lang], self.hashes[ids])
        ids[~filters[0].has(key)] = 0
        after = np.concatenate([ids[1:], [0]]).astype(np.int32)
        goes_on = (ids > 0) & (after > 0)
        if len(filters) > 1:
            pairs = np.flatnonzero(goes_on)
            goes_on[pairs] = filters[1].has(_extend(key[pairs], self.hashes[after[pairs]]))
        columns = [ids]
        for _ in range(1, depth):
            columns.append(np.where(goes_on, np.concatenate([columns[-1][1:], [0]]), 0).astype(np.int32))
        kept = np.flatnonzero(goes_on[: max(0, len(ids) - skip)])
        self.columns = [c[kept] for c in columns]
        self.lang = lang[kept]
        self.key = key[kept]

    def extend(self, key: np.ndarray, d: int, rows: np.ndarray) -> np.ndarray:
        return _extend(key, self.hashes[self.columns[d][rows]])

    def merged(self, rows: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first row of each different combination of ``columns``, in their order, and how many there are."""
        order = np.lexsort(columns[::-1])
        new = np.zeros(len(order), bool)
        new[:1] = True
        for c in columns:
            new[1:] |= c[order][1:] != c[order][:-1]
        at = np.flatnonzero(new)
        return rows[order[at]], np.diff(np.r_[at, len(order)])


def _suffix_batches(
    batches: Iterator[pa.RecordBatch], seed: int, filters: list[Bitmap], depth: int
) -> Iterator[_Suffixes]:
    numbers = _Numbers()
    ids: list[np.ndarray] = []
    runs: list[tuple[int, int]] = []
    langs: dict[str, int] = {}
    size = 0

    def made(skip: int) -> tuple[np.ndarray, list[bytes], np.ndarray, _Suffixes]:
        joined, words = np.concatenate(ids), list(numbers)
        lang = np.repeat(*np.array(runs, np.int32).reshape(-1, 2).T)
        return joined, words, lang, _Suffixes(joined.copy(), words, lang, list(langs), seed, filters, depth, skip)

    for lang, text in _rows(batches):
        number = langs.setdefault(lang, len(langs))
        for chunk in word_chunks(text):
            ids.append(np.fromiter(map(numbers.__getitem__, chunk), np.int32, len(chunk)))
            runs.append((number, len(chunk)))
            size += len(chunk)
            if size >= BATCH_WORDS:
                # the last words' suffixes may go on: they come again with the next ones
                joined, words, owner, found = made(depth - 1)
                yield found
                numbers, again = _Numbers(), [words[i] for i in joined[1 - depth :]]
                ids, runs = [np.array([numbers[w] for w in again], np.int32)], [(i, 1) for i in owner[1 - depth :].tolist()]
                size = len(again)
        ids.append(np.zeros(1, np.int32))
        runs.append((number, 1))
        size += 1
    if ids:
        yield made(0)[3]


def _packed_cells(cells: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending cells and their counts, compressed."""
    import zstandard

    wide = "<i8" if len(counts) and counts.max() >= 1 << 31 else "<i4"
    body = np.diff(cells, prepend=0).astype("<i4").tobytes() + counts.astype(wide).tobytes()
    return len(cells).to_bytes(8, "little") + zstandard.compress(body, 1)


def _add_cells(total: np.ndarray, blob: bytes) -> None:
    import zstandard

    n, body = int.from_bytes(blob[:8], "little"), zstandard.decompress(blob[8:])
    counts = np.frombuffer(body[4 * n :], "<i8" if len(body) == 12 * n else "<i4")
    total[np.cumsum(np.frombuffer(body[: 4 * n], "<i4"))] += counts


def _pair_cells(seed: int, filters: list[Bitmap], bits: int):
    """``(part, cells)``: how many pairs of neighbours fall into each cell, for each part of the cells."""
    low = max(3, bits - PAIR_PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _suffix_batches(batches, seed, filters, 2):
            cells, counts = np.unique(_cells(s.extend(s.key, 1, np.arange(len(s.key))), bits), return_counts=True)
            cuts = np.searchsorted(cells, np.arange((1 << bits - low) + 1) << low)
            parts = np.flatnonzero(np.diff(cuts))
            blobs = [_packed_cells(cells[a:b] - (p << low), counts[a:b]) for p, a, b in zip(parts, cuts[parts], cuts[parts + 1])]
            yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array(blobs, pa.binary())], names=["part", "cells"])

    return run


def frequent_pairs(docs: DataFrame, seed: int, frequent: Bitmap, least: int, bits: int = PAIR_BITS, fan_in: int = FAN_IN) -> Bitmap:
    """Pairs of neighbours whose cell holds at least ``least`` pairs; ``2**bits`` bits reach the driver.

    Tasks' counts are added in three levels, at most those of ``fan_in`` tasks
    at a time (up to ``fan_in ** 3`` tasks), which bounds what a task holds.
    """
    low = max(3, bits - PAIR_PARTS)

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(1 << low, np.int64)
        for blob in table.column("cells"):
            _add_cells(total, blob.as_py())
        at = np.flatnonzero(total)
        piece = table.column("piece")[0].as_py() // fan_in
        return pa.table({"part": [table.column("part")[0].as_py()], "piece": [piece], "cells": [_packed_cells(at, total[at])]})

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, blob in zip(*(c.to_pylist() for c in batch.columns)):
                total = np.zeros(1 << low, np.int64)
                _add_cells(total, blob)
                bit = np.packbits(total >= least, bitorder="little").tobytes()
                yield pa.RecordBatch.from_pydict({"part": [part], "bits": [bit]})

    found = docs.mapInArrow(_pair_cells(seed, [frequent], bits), "part bigint, cells binary")
    found = found.withColumn("piece", F.floor(F.spark_partition_id() / fan_in))
    for keys in (["part", "piece"], ["part", "piece"], ["part"]):
        found = found.groupBy(*keys).applyInArrow(add, "part bigint, piece bigint, cells binary")
    rows = found.select("part", "cells").mapInArrow(often, "part bigint, bits binary").collect()
    data = np.zeros(max(1, 1 << bits >> 3), np.uint8)
    for r in rows:
        begin = (r["part"] << low) >> 3
        data[begin : begin + (1 << low >> 3)] = np.frombuffer(r["bits"], np.uint8)
    return Bitmap(data, bits)


def _prefix_counts(seed: int, filters: list[Bitmap], heavy: list[Bitmap], depth: int):
    """``(lang, words, n)``: prefixes one word longer than those in all of ``heavy``, counted in a task."""
    level = len(heavy) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _suffix_batches(batches, seed, filters, depth):
            rows, key = np.arange(len(s.lang)), s.key
            for d, bitmap in enumerate(heavy, 1):
                keep = bitmap.has(key) & (s.columns[d][rows] > 0)
                rows, key = rows[keep], key[keep]
                key = s.extend(key, d, rows)
            first, n = s.merged(rows, s.lang[rows], *(c[rows] for c in s.columns[:level]))
            for a in range(0, len(first), 50_000):
                at = first[a : a + 50_000]
                words = np.stack([s.hashes[c[at]] for c in s.columns[:level]], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(s.langs, pa.string()).take(pa.array(s.lang[at])),
                        pa.ListArray.from_arrays(np.arange(0, words.size + 1, level, dtype=np.int32), words.ravel()),
                        pa.array(n[a : a + 50_000]),
                    ],
                    names=["lang", "words", "n"],
                )

    return run


def _pack(columns: list[np.ndarray], counts: np.ndarray, prefix: np.ndarray, hashes: np.ndarray) -> bytes:
    import zstandard

    used, local = np.unique(np.concatenate(columns), return_inverse=True)
    local = local.reshape(len(columns), -1) if len(used) and used[0] == 0 else local.reshape(len(columns), -1) + 1
    used = used[used > 0]
    head = np.array([len(counts), len(used), len(columns)], "<i8").tobytes()
    body = [hashes[used].astype("<i8"), local.astype("<i4"), counts.astype("<i8"), prefix.astype(np.uint8)]
    return zstandard.compress(head + b"".join(c.tobytes() for c in body), 1)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    import zstandard

    data = memoryview(zstandard.decompress(blob))
    n, used, depth = np.frombuffer(data[:24], "<i8").tolist()
    sizes = [8 * used, 4 * n * depth, 8 * n, n]
    ends = np.cumsum([24, *sizes])
    parts = [data[a:b] for a, b in zip(ends, ends[1:])]
    return (
        np.frombuffer(parts[0], "<i8"),
        np.frombuffer(parts[1], "<i4").reshape(depth, n),
        np.frombuffer(parts[2], "<i8"),
        np.frombuffer(parts[3], np.uint8),
    )


def _deal(seed: int, filters: list[Bitmap], heavy: list[Bitmap], groups: int, depth: int):
    """``(lang, grp, blob)``: a task's merged suffixes for each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _suffix_batches(batches, seed, filters, depth):
            n = len(s.lang)
            key, prefix, ended = s.key.copy(), np.ones(n, np.int64), np.zeros(n, bool)
            live = np.arange(n)
            for d, bitmap in enumerate(heavy, 1):
                live = live[bitmap.has(key[live])]
                more = s.columns[d][live] > 0
                ended[live[~more]] = True  # all of its nodes have been counted as prefixes
                live = live[more]
                key[live] = s.extend(key[live], d, live)
                prefix[live] = d + 1
            rows = np.flatnonzero(~ended)
            group = (key[rows] % np.uint64(groups)).astype(np.int64)
            first, count = s.merged(
                np.arange(len(rows)), s.lang[rows], group, *(c[rows] for c in s.columns)
            )
            group, rows = group[first], rows[first]
            lang = s.lang[rows]
            cuts = np.flatnonzero(np.r_[True, (np.diff(group) != 0) | (np.diff(lang) != 0)]) if len(rows) else []
            for a, b in zip(cuts, [*cuts[1:], len(rows)]):
                at = rows[a:b]
                blob = _pack([c[at] for c in s.columns], count[a:b], prefix[at], s.hashes)
                yield pa.RecordBatch.from_pydict({"lang": [s.langs[lang[a]]], "grp": [int(group[a])], "blob": [blob]})

    return run


def subtree_nodes(
    words: np.ndarray, counts: np.ndarray, prefix: np.ndarray, least: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Nodes deeper than their suffixes' ``prefix`` with a count of at least ``least``, level by level.

    ``words`` has a row for each depth and a column for each leaf, 0 after a
    suffix's end; yields the nodes' words, one line each, and counts. A node
    no deeper than the prefix may have leaves in other groups, so its count
    here decides nothing.
    """
    leaf, node = np.flatnonzero(words[0] > 0), words[0][words[0] > 0].astype(np.int64)
    for d in range(1, len(words)):
        more = words[d][leaf] > 0
        leaf, node = leaf[more], node[more]
        if not len(leaf):
            return
        key = node << 32 | words[d][leaf]
        order = np.argsort(key, kind="stable")
        begin = np.flatnonzero(np.r_[True, np.diff(key[order]) > 0])
        total = np.add.reduceat(counts[leaf[order]], begin)
        size = np.diff(np.r_[begin, len(order)])
        leaf, node = leaf[order], np.repeat(np.arange(len(begin)), size)
        top = leaf[begin]
        whole = prefix[top] <= d + 1
        out = (total >= least) & (prefix[top] < d + 1)
        yield words[: d + 1, top[out]].T, total[out]
        grown = np.repeat((total >= least) | ~whole, size)
        leaf, node = leaf[grown], node[grown]


def _grow(least: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        # one part is unpacked at a time: first for its dictionary, then to be placed
        blobs = table.column("blob")
        held, hashes, ends, depth = [], 0, [0], 0
        for blob in blobs:
            used, local, _, _ = _unpack(blob.as_py())
            held.append(used.copy())
            hashes += len(used)
            if hashes > HELD_HASHES:
                held, hashes = [np.unique(np.concatenate(held))], 0
            depth = len(local)
            ends.append(ends[-1] + local.shape[1])
        known = np.unique(np.concatenate(held))
        words, counts, prefix = np.empty((depth, ends[-1]), np.int32), np.empty(ends[-1], np.int64), np.empty(ends[-1], np.uint8)
        for blob, a, e in zip(blobs, ends, ends[1:]):
            used, local, counts[a:e], prefix[a:e] = _unpack(blob.as_py())
            words[:, a:e] = np.concatenate([[0], np.searchsorted(known, used) + 1]).astype(np.int32)[local]
        lists, totals = [pa.array([], pa.list_(pa.int64()))], [np.empty(0, np.int64)]
        for found, total in subtree_nodes(words, counts, prefix, least):
            offsets = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
            lists.append(pa.ListArray.from_arrays(offsets, known[found.ravel() - 1]))
            totals.append(total)
        n = np.concatenate(totals)
        lang = pa.array([table.column("lang")[0].as_py()] * len(n), pa.string())
        return pa.table({"lang": lang, "words": pa.chunked_array(lists), "f": n})

    return run


def phrase_counts(
    docs: DataFrame,
    least: int,
    depth: int,
    scratch: Scratch,
    group_suffixes: int = GROUP_SUFFIXES,
    bits: int = BITMAP_BITS,
    pair_bits: int = PAIR_BITS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts of ``docs(lang, text binary)``: nodes, words and totals.

    ``nodes(lang, words, f)`` are all phrases of up to ``depth`` words that
    occur at least ``least`` times, by the hashes of their words;
    ``(lang, h, word)`` are those hashes' words; ``(lang, n)`` the languages'
    numbers of words. Hashes of different words of a language that collide
    are found and replaced by another seed's.
    """
    seed = 2
    while True:
        counted = docs.mapInArrow(_counts(seed), "lang string, h bigint, word string, n bigint")
        counted = counted.groupBy("lang", "h").agg(F.sum("n").alias("f"), F.min("word").alias("word"), F.max("word").alias("other"))
        counted = scratch.save(counted.where(F.col("h").isNull() | (F.col("f") >= least)), f"words-{seed}")
        if counted.where("word <> other").isEmpty():
            break
        seed += 1
    totals = counted.where("h IS NULL").select("lang", F.col("f").alias("n"))
    words = counted.where("h IS NOT NULL").select("lang", "h", "word", "f")
    nodes = words.select("lang", F.array("h").alias("words"), "f")
    frequent = bitmap_of(nodes, bits)
    filters = [frequent, frequent_pairs(docs, seed, frequent, least, pair_bits)]
    n = totals.agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-n // group_suffixes))

    # prefixes with more suffixes than a group should hold are extended
    heavy: list[Bitmap] = []
    last = nodes
    for level in range(1, depth):
        over = last.where(F.col("f") > group_suffixes)
        if over.isEmpty():
            break
        heavy.append(bitmap_of(over, bits))
        longer = docs.mapInArrow(_prefix_counts(seed, filters, heavy, depth), "lang string, words array<bigint>, n bigint")
        longer = longer.groupBy("lang", "words").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
        last = scratch.save(longer, f"prefixes-{level}")
        nodes = nodes.unionByName(last)

    blobs = docs.mapInArrow(_deal(seed, filters, heavy, int(groups), depth), "lang string, grp bigint, blob binary")
    grown = blobs.groupBy("lang", "grp").applyInArrow(_grow(least), "lang string, words array<bigint>, f bigint")
    nodes = nodes.unionByName(scratch.save(grown, "nodes"))
    return nodes, words.drop("f"), totals


def phrases(
    docs: DataFrame,
    least: int = 100,
    longest: int = 5,
    top: int = 2000,
    absorb_percent: int = 100,
    lang_col: str = "lang",
    text_col: str = "text",
    group_suffixes: int = GROUP_SUFFIXES,
    bitmap_bits: int = BITMAP_BITS,
    pair_bits: int = PAIR_BITS,
) -> DataFrame:
    """Each language's ``top`` collocations: ``(lang, rank, phrase, a, l, r, n, score)``.

    A-Z is lower-cased; texts are split into pieces at ``.,;:!?`` and the line
    breaks 0x0A to 0x0D, pieces into words at spaces and tabs. Null languages
    count as ``und``, null texts as empty. ``n`` counts a language's words, and
    a phrase's count its occurrences within pieces, overlapping ones too.
    Phrases of 2 to ``longest`` words that occur ``a >= least`` times are
    candidates; dropped are those that lie inside a longer candidate which
    occurs at least ``absorb_percent`` percent as often. Cut after ``k`` words,
    the parts occur ``l`` and ``r`` times and the score is ``floor(1000 * a * n
    / (l * r))``; the lowest cut counts, the first of equal ones. Ranked by
    score, then ``a``, both descending, then phrase in the order of its bytes.
    Arithmetic is exact, or raises beyond 38 digits. An empty table, and one
    without candidates, give an empty table. Rows that repeat all count; other
    columns are ignored, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    nodes, words, totals = phrase_counts(texts, least, longest, scratch, group_suffixes, bitmap_bits, pair_bits)

    # what lies inside a longer phrase lies inside one that is longer by a word and occurs no less often
    size = F.size("words")
    inner = (
        nodes.where(size > 2)
        .select("lang", "f", F.explode(F.array(F.slice("words", 1, size - 1), F.slice("words", 2, size - 1))).alias("words"))
        .groupBy("lang", "words")
        .agg(F.max("f").alias("longer"))
    )
    candidates = (
        nodes.where(size > 1)
        .join(inner, ["lang", "words"], "left")
        .where(F.col("longer").isNull() | (100 * F.col("longer") < absorb_percent * F.col("f")))
        .select("lang", "words", F.col("f").alias("a"))
    )
    candidates = scratch.save(candidates, "candidates")
    left = nodes.select("lang", F.col("words").alias("left"), F.col("f").alias("l"))
    right = nodes.select("lang", F.col("words").alias("right"), F.col("f").alias("r"))
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    over, under = F.lit(1000).cast("decimal(4,0)") * (wide["a"] * wide["n"]).cast("decimal(34,0)"), wide["l"] * wide["r"]
    exact = F.call_function("div", over, under)
    cuts = (
        candidates.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
        .withColumn("left", F.slice("words", F.lit(1), F.col("k")))
        .withColumn("right", F.expr("slice(words, k + 1, size(words) - k)"))
        .join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .join(totals, "lang")
        .withColumn("score", F.coalesce(exact, F.raise_error(F.lit("a score has over 38 digits")).cast("bigint")))
    )
    scored = (
        cuts.groupBy("lang", "words", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "words", "a", "n", "cut.l", "cut.r", "cut.score")
    )
    # first by parts of each language, all that tie at the end of a part included, as ties need the words
    part = F.pmod(F.xxhash64("words"), F.lit(RANK_PARTS))
    best = [F.col("score").desc(), F.col("a").desc()]
    scored = (
        scored.withColumn("part", part)
        .withColumn("place", F.rank().over(Window.partitionBy("lang", "part").orderBy(*best)))
        .where(F.col("place") <= top)
        .drop("place")
    )
    scored = scratch.save(scored, "scored")
    spelled = (
        scored.select("lang", "words", F.posexplode("words").alias("at", "h"))
        .join(words, ["lang", "h"])
        .groupBy("lang", "words")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("found"))
        .select("lang", "words", F.array_join(F.transform("found", lambda x: x["word"]), " ").alias("phrase"))
    )
    best.append(F.col("phrase").asc())
    ranked = (
        scored.join(spelled, ["lang", "words"])
        .withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best)))
        .where(F.col("place") <= top)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint"))
        .where(F.col("rank") <= top)
    )
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
