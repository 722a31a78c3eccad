"""Exact deduplication by Grace hashing.

Map tasks first remove the copies they see themselves, so that a text which
makes up a third of all rows leaves each task at most once per buffer. The
remaining records are dealt out by a hash of their content; a reducing task
puts them into an open-addressing table that compares complete contents, and
when the table outgrows its budget, spills it and the rest of its input to
files by the next bits of the hash and goes on with each file in turn, until
each bucket fits. Spill files live in the task's own temporary folder and go
with it; everything that outlives a task is a Spark shuffle or table.
"""

from __future__ import annotations

import pickle
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tillandsia.llm._common import Scratch, free_name

#: Bytes of contents that a task's table holds before it is flushed or spilled.
TABLE_BYTES = 96 << 20
#: Sub-buckets a spill makes, as a power of two, and the bits of the hash.
SPILL_BITS, HASH_BITS = 4, 64

Record = tuple[int, bytes, Any]  # hash, content, state


def normalised(text: bytes | None) -> bytes:
    """The content that is compared: A-Z lower-cased (bytes of other letters stay), null as empty."""
    return (text or b"").lower()


def content_hash(content: bytes) -> int:
    return xxhash.xxh3_64_intdigest(content)


class ContentTable:
    """Open addressing with linear probing; equal means equal in every byte."""

    def __init__(self) -> None:
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.states: list[Any] = []
        self.bytes = 0
        self.slots = [-1] * 1024

    def find(self, h: int, content: bytes) -> int:
        """Where the content is, or the complement of the free slot for it."""
        mask = len(self.slots) - 1
        at = h & mask
        while (i := self.slots[at]) >= 0:
            if self.hashes[i] == h and self.contents[i] == content:
                return i
            at = (at + 1) & mask
        return ~at

    def add(self, slot: int, h: int, content: bytes, state: Any) -> None:
        self.slots[~slot] = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        self.states.append(state)
        self.bytes += len(content) + 256
        if 2 * len(self.hashes) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            mask = len(self.slots) - 1
            for i, g in enumerate(self.hashes):
                at = g & mask
                while self.slots[at] >= 0:
                    at = (at + 1) & mask
                self.slots[at] = i

    def records(self) -> Iterator[Record]:
        return zip(self.hashes, self.contents, self.states)


def grace(
    records: Iterable[Record],
    merge: Callable[[Any, Any], Any],
    budget: int = TABLE_BYTES,
    used_bits: int = 0,
    folder: str | None = None,
) -> Iterator[Record]:
    """One record per distinct content, its state merged from those of all copies.

    Holds about ``budget`` bytes of contents at a time. The hash's low bits
    address the table, its high bits pick the spill file. Records whose
    hashes are equal in all bits stay together, whatever their size.
    """
    table, records = ContentTable(), iter(records)
    for h, content, state in records:
        at = table.find(h, content)
        if at >= 0:
            table.states[at] = merge(table.states[at], state)
            continue
        table.add(at, h, content, state)
        if table.bytes > budget and used_bits + SPILL_BITS <= HASH_BITS and len(table.hashes) > 1:
            break
    else:
        yield from table.records()
        return
    own = tempfile.mkdtemp(prefix="grace-", dir=folder)
    try:
        shift = HASH_BITS - SPILL_BITS - used_bits
        names = [f"{own}/{i:02d}" for i in range(1 << SPILL_BITS)]
        files = [open(name, "wb") for name in names]
        try:
            for source in (table.records(), records):
                for record in source:
                    pickle.dump(record, files[record[0] >> shift & (1 << SPILL_BITS) - 1], -1)
        finally:
            for file in files:
                file.close()
        del table

        def spilled(name: str) -> Iterator[Record]:
            with open(name, "rb") as f:
                while True:
                    try:
                        yield pickle.load(f)
                    except EOFError:
                        return

        for name in names:
            yield from grace(spilled(name), merge, budget, used_bits + SPILL_BITS, own)
    finally:
        shutil.rmtree(own, ignore_errors=True)


def combine(
    records: Iterable[Record], merge: Callable[[Any, Any], Any], budget: int = TABLE_BYTES
) -> Iterator[Record]:
    """Map-side: like ``grace``, but flushes a full table instead of spilling it, so contents may repeat."""
    table = ContentTable()
    for h, content, state in records:
        at = table.find(h, content)
        if at >= 0:
            table.states[at] = merge(table.states[at], state)
        else:
            table.add(at, h, content, state)
            if table.bytes > budget:
                yield from table.records()
                table = ContentTable()
    yield from table.records()


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _buffered(rows: Iterable[tuple[int, Any]], most: int = 8 << 20) -> Iterator[list]:
    """Rows in lists of about ``most`` bytes; each comes with its size."""
    out, held = [], 0
    for size, row in rows:
        out.append(row)
        held += size + 64
        if held >= most:
            yield out
            out, held = [], 0
    if out:
        yield out


def _larger(a: tuple, b: tuple) -> tuple:
    """Of (id, ...) states the one with the larger id; nulls are smallest, the first of equals stays."""
    return b if b[0] is not None and (a[0] is None or b[0] > a[0]) else a


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = TABLE_BYTES
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of equal texts the largest id.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty, and a null id as smaller than any other. Of rows that repeat the
    largest id one stays. An empty table gives an empty table. Columns may
    have any names.
    """
    schema = docs.schema
    hash_name, content_name = free_name(docs, "hash_of_text"), free_name(docs, "content_of_text")
    held = StructType(
        [*schema.fields, StructField(hash_name, LongType()), StructField(content_name, BinaryType())]
    )
    names = schema.names
    id_at = names.index(id_col)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Record]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                content = normalised(row[-1])
                yield content_hash(content), content, (row[id_at], row[:-1])

    def out(records: Iterable[Record], to: pa.Schema, keep_hash: bool) -> Iterator[pa.RecordBatch]:
        sized = (
            (2 * len(content), (*row, *((_signed(h), content) if keep_hash else ())))
            for h, content, (_, row) in records
        )
        for rows in _buffered(sized):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), to)], schema=to
            )

    from pyspark.sql.pandas.types import to_arrow_schema

    held_arrow, out_arrow = to_arrow_schema(held), to_arrow_schema(schema)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from out(combine(rows_of(batches), _larger, budget), held_arrow, True)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (
            (row[-2] & (1 << 64) - 1, row[-1], (row[id_at], row[:-2]))
            for batch in batches
            for row in zip(*(c.to_pylist() for c in batch.columns))
        )
        yield from out(grace(records, _larger, budget), out_arrow, False)

    with_bytes = docs.withColumn(content_name, F.col(f"`{text_col}`").cast("string").cast("binary"))
    return (
        with_bytes.mapInArrow(local, held)
        .repartition(hash_name)
        .mapInArrow(final, schema)
    )


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = TABLE_BYTES
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row of ``docs``.

    ``keep_id`` is the largest id among the rows with an equal text (see
    ``exact_dedup``), null if none of them has one; ``kept``: the row's id is
    ``keep_id`` (rows repeating that id all say so; ``exact_dedup`` keeps one).
    ``text_sha256``: lower-case hex digest of the normalised text. An empty
    table gives an empty table. Other columns are ignored, whatever their
    names; ids are whole numbers.

    The map side writes two tables to the shared folder: each row's id with
    the key of the copy that stands for it in its task, and those copies with
    their contents. Only the second is dealt out by content; the decisions
    come back by key, of which a task's rows have no more than the task read.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    member, rep = 0, 1

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        ids: list[tuple[Any, int]] = []
        key = first

        def rows() -> Iterator[Record]:
            for batch in batches:
                for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                    content = normalised(text)
                    yield content_hash(content), content, doc_id

        def members() -> Iterator[pa.RecordBatch]:
            if ids:
                n = len(ids)
                doc_ids, keys = zip(*ids)
                ids.clear()
                yield batch_of([member] * n, doc_ids, keys, [None] * n, [None] * n, [None] * n)

        def batch_of(*columns) -> pa.RecordBatch:
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=fields)

        table, states = ContentTable(), []

        def flush() -> Iterator[pa.RecordBatch]:
            records = (
                (len(content), (rep, state[1], state[0], state[2], _signed(h), content))
                for h, content, state in table.records()
            )
            for rows_ in _buffered(records):
                yield batch_of(*zip(*rows_))

        for h, content, doc_id in rows():
            at = table.find(h, content)
            if at >= 0:
                state = table.states[at]
                state[2] += 1
                if doc_id is not None and (state[1] is None or doc_id > state[1]):
                    state[1] = doc_id
            else:
                if table.bytes > budget:
                    yield from flush()
                    table = ContentTable()
                    at = table.find(h, content)
                state = [key, doc_id, 1]
                key += 1
                table.add(at, h, content, state)
            ids.append((doc_id, state[0]))
            if len(ids) >= 65536:
                yield from members()
        yield from members()
        yield from flush()

    fields = ["kind", "doc_id", "rep", "n", "hash", "content"]
    schema = "kind int, doc_id bigint, rep bigint, n bigint, hash bigint, content binary"
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")
    )
    local_rows = scratch.save(rows.mapInArrow(local, schema), "local", "kind")

    def merge(a: tuple, b: tuple) -> tuple:
        best = a[0] if b[0] is None or (a[0] is not None and a[0] >= b[0]) else b[0]
        return best, a[1] + b[1], a[2] + b[2]

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        records = (
            (h & (1 << 64) - 1, content, (doc_id, n, [key]))
            for batch in batches
            for doc_id, key, n, h, content in zip(*(c.to_pylist() for c in batch.columns))
        )
        sized = (
            (120, (key, keep, size, sha))
            for _, content, (keep, size, keys) in grace(records, merge, budget)
            for sha in [hashlib.sha256(content).hexdigest()]
            for key in keys
        )
        for rows_ in _buffered(sized):
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows_), types)],
                names=["rep", "keep_id", "group_size", "text_sha256"],
            )

    reps = local_rows.where(F.col("kind") == rep).select("doc_id", "rep", "n", "hash", "content")
    decided = reps.repartition("hash").mapInArrow(
        decide, "rep bigint, keep_id bigint, group_size bigint, text_sha256 string"
    )
    members = local_rows.where(F.col("kind") == member).select("doc_id", "rep")
    return members.join(decided, "rep").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
