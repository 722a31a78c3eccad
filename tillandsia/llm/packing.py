"""Sequence packing: shortest-pack-first over the histogram of lengths.

Documents are tokenised, cut where they exceed a sequence, and counted by
length; that histogram has at most ``length`` bins, whatever the input. The
driver places whole bins, longest first, each into the packs with the most
room left, keeping only counts of equal packs. The patterns found are joined
back to the pieces by their rank among the pieces of their length, which
comes from counts per task and length, without sorting the pieces.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillandsia.llm._common import Scratch
from tillandsia.llm.bpe_codec import BATCH_CHARS, CHUNK_CHARS, batches_of, load_encoding, safe_parts

#: Tokens of a sequence.
SEQUENCE = 2048


def pack_histogram(histogram: dict[int, int], length: int = SEQUENCE) -> list[tuple[int, tuple[int, ...]]]:
    """Packs ``histogram`` (count by length) into ``(count, lengths)`` patterns.

    Lengths go longest first; each bin's pieces go to the packs that are
    shortest so far, as many as there are of each, and to new packs when they
    fit into none. Every piece is in exactly one pack, none is over ``length``.
    """
    # packs by tokens they hold; equal patterns share an entry
    packs: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    shortest: list[int] = []

    def put(pattern: tuple[int, ...], used: int, count: int) -> None:
        if used not in packs or not packs[used]:
            heapq.heappush(shortest, used)
        packs[used][pattern] += count

    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            while shortest and not packs[shortest[0]]:
                heapq.heappop(shortest)
            if shortest and shortest[0] + size <= length:
                used = shortest[0]
                pattern, there = next(iter(packs[used].items()))
                taken = min(left, there)
                if taken == there:
                    del packs[used][pattern]
                else:
                    packs[used][pattern] -= taken
                put((*pattern, size), used + size, taken)
                left -= taken
            else:
                # the rest of the bin makes packs of as many of its pieces as fit
                each = max(1, length // size)
                if left >= each:
                    put((size,) * each, each * size, left // each)
                    left %= each
                if left:
                    put((size,) * left, left * size, 1)
                    left = 0
    return [(n, p) for by in packs.values() for p, n in by.items() if n]


def _slots(patterns: list[tuple[int, tuple[int, ...]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interval starts ``length << 40 | rank``, their first sequence, and the offset in it."""
    next_rank: dict[int, int] = defaultdict(int)
    starts, sequences, offsets, sequence = [], [], [], 0
    for count, pattern in patterns:
        offset = 0
        for size in pattern:
            starts.append(size << 40 | next_rank[size])
            sequences.append(sequence)
            offsets.append(offset)
            next_rank[size] += count
            offset += size
        sequence += count
    order = np.argsort(np.array(starts, np.int64), kind="stable")
    return tuple(np.array(x, np.int64)[order] for x in (starts, sequences, offsets))


def pack_documents(
    docs: DataFrame,
    rank_path: str,
    pattern: str,
    special: dict[str, int],
    end_id: int = 1,
    length: int = SEQUENCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    A document is the ids of its whole text (byte-level BPE by the ranks at
    ``rank_path``, readable on every executor; strings in ``special`` count as
    their one id) and then ``end_id``; null text counts as empty. It is cut
    every ``length`` ids; ``start`` ids of it come before the piece, which
    lies at ``offset`` of sequence ``sequence_id``; ``ids_crc32`` is of its
    ids as little-endian 32-bit integers. Pieces fill a sequence from 0
    without gaps. ``with_ids`` adds those bytes as ``ids``. Null ids and
    repeated rows are documents of their own; an empty table gives an empty
    table. Other columns are ignored, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    specials = tuple(special.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        encoding = load_encoding(rank_path, pattern, specials)
        cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        task, ranks = TaskContext.get().partitionId(), defaultdict(int)

        def encode(text: str) -> np.ndarray:
            if len(text) <= CHUNK_CHARS:
                parts = [encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=())]
            else:
                parts = []
                for plain in cut.split(text) if cut else [text]:
                    if plain in special:
                        parts.append([special[plain]])
                    else:
                        parts += [encoding.encode_to_numpy(p, disallowed_special=()) for p in safe_parts(plain, pattern)]
            return np.concatenate([*(np.asarray(p, np.uint32) for p in parts), np.array([end_id], np.uint32)])

        for batch in batches:
            doc_ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in batches_of(texts, BATCH_CHARS):
                row, start, size, crc, total, rank, raw = [], [], [], [], [], [], []
                for i in range(a, b):
                    ids = encode(texts[i])
                    for at in range(0, len(ids), length):
                        piece = ids[at : at + length].astype("<u4").tobytes()
                        n = len(piece) // 4
                        row.append(i)
                        start.append(at)
                        size.append(n)
                        crc.append(zlib.crc32(piece))
                        total.append(len(ids))
                        rank.append(ranks[n])
                        ranks[n] += 1
                        raw.append(piece)
                columns = [doc_ids.take(pa.array(row, pa.int64()))]
                columns += [pa.array(x, pa.int64()) for x in (start, size, crc, total)]
                columns += [pa.array([task] * len(row), pa.int32()), pa.array(rank, pa.int64())]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "rank"]
                if with_ids:
                    columns.append(pa.array(raw, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, task int, rank bigint"
        + ", ids binary" * with_ids
    )
    pieces = scratch.save(rows.mapInArrow(run, schema), "pieces")

    counts = scratch.save(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "counts")
    # at most `length` rows
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    starts, sequences, offsets = _slots(pack_histogram(histogram, length))
    # one slot per place in a distinct pattern: bounded by the bins, not by the pieces
    slots = docs.sparkSession.sparkContext.broadcast((starts, sequences, offsets))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, sequences, offsets = slots.value
        for batch in batches:
            first, rank = (batch.column(i).to_numpy() for i in (0, 1))
            size = batch.column(2).to_numpy()
            key = size << 40 | (first + rank)
            at = np.searchsorted(starts, key, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[3:],
                    batch.column(2),
                    pa.array(sequences[at] + (key - starts[at])),
                    pa.array(offsets[at]),
                ],
                names=[*batch.schema.names[3:], "length", "sequence_id", "offset"],
            )

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rest = ["doc_id", "start", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    # grows with the tasks, so it is never broadcast
    ranked = pieces.join(first.hint("merge"), ["length", "task"]).select("first", "rank", "length", *rest)
    out_schema = (
        f"doc_id {kind}, start bigint, ids_crc32 bigint, doc_tokens bigint"
        + ", ids binary" * with_ids
        + ", length bigint, sequence_id bigint, offset bigint"
    )
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return ranked.mapInArrow(place, out_schema).select(*columns, *["ids"] * with_ids)
