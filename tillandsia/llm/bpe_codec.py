"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Texts longer than ``chunk_chars`` are split at safe boundaries first: places
where the pre-splitting pattern always starts a new match, so encoding the
parts and joining the ids gives exactly the ids of the whole text. Decoding
joins the raw bytes of the ids, so ids that cut through a character lose
nothing.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillandsia.llm._common import worker_cache

#: Longest text, in characters, handed to the library in one call.
CHUNK_CHARS = 1 << 16
#: Characters of text per output batch, which bounds a worker's memory.
BATCH_CHARS = 1 << 21


def load_encoding(rank_path: str, pattern: str, special: tuple[tuple[str, int], ...] = ()):
    """The library's encoder for a file of base64 tokens and ranks, kept per worker."""

    def make():
        import tiktoken

        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding(
            "local", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special)
        )

    return worker_cache(("tiktoken", rank_path, pattern, special), make)


def safe_parts(text: str, pattern: str, chunk_chars: int = CHUNK_CHARS) -> Iterator[str]:
    """``text`` in parts of about ``chunk_chars``, cut only where a new match of ``pattern`` starts.

    No match of the pattern holds a white-space character after another one
    that is not, so a place between the two is a boundary, and looking ahead
    from the left part never reaches it. A long run without such a place is
    cut at the ends of the pattern's own matches, but not between white space
    and what follows it, where the left part alone would end in another match;
    a single longer match stays whole.
    """
    import regex

    boundary = worker_cache("boundary", lambda: regex.compile(r"(?<=\S)(?=\s)"))
    unsafe = worker_cache("unsafe end", lambda: regex.compile(r"(?<=\s)(?=\S)"))
    begin = 0
    while len(text) - begin > chunk_chars:
        found = boundary.search(text, begin + chunk_chars // 2, begin + chunk_chars)
        if found:
            cut = found.start()
        else:
            matches = worker_cache(("pattern", pattern), lambda: regex.compile(pattern))
            cut = next(
                (
                    m.end()
                    for m in matches.finditer(text, begin)
                    if m.end() - begin >= chunk_chars and not unsafe.match(text, m.end())
                ),
                len(text),
            )
        yield text[begin:cut]
        begin = cut
    if begin < len(text):
        yield text[begin:]


def encode_text(encoding, text: str, pattern: str, chunk_chars: int = CHUNK_CHARS) -> np.ndarray:
    """The ids of one text as unsigned 32-bit integers, special strings taken as plain text."""
    if len(text) <= chunk_chars:
        return np.array(encoding.encode_ordinary(text), np.uint32)
    parts = [encoding.encode_ordinary(p) for p in safe_parts(text, pattern, chunk_chars)]
    return np.concatenate([np.array(p, np.uint32) for p in parts])


def batches_of(texts: list[str], most: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of at most ``most`` characters each, or one longer text."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > most:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def bpe_round_trip(
    docs: DataFrame,
    rank_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """``(doc_id, ids array<int>, decoded binary)`` for every row of ``docs``.

    ``ids`` encode the whole text without special tokens; ``decoded`` are the
    bytes that the ids stand for. A null text counts as empty and gives no
    ids; a null id and repeated rows pass through, one output row each; an
    empty table gives an empty table. Other columns are ignored, whatever
    their names. ``rank_path`` must be readable on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(rank_path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in batches_of(texts):
                ids = [encode_text(encoding, t, pattern, chunk_chars) for t in texts[a:b]]
                ends = np.cumsum([0] + [len(x) for x in ids]).astype(np.int32)
                flat = np.concatenate(ids).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                        pa.array([encoding.decode_bytes(x.tolist()) for x in ids], pa.binary()),
                    ],
                    names=["doc_id", "ids", "decoded"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def bpe_decode(
    rows: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """``(doc_id, decoded binary)``: the raw bytes of each row's ids; null ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(rank_path, pattern)
        for batch in batches:
            out = [encoding.decode_bytes(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "decoded"]
            )

    picked = rows.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, decoded binary")
