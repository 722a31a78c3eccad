"""Token ids in files compressed by Re-Pair grammars, with random access.

A file holds the ids of many documents in ascending order of their ids, in
blocks of a bounded number of tokens. Each block has a grammar of its own: in
rounds, the most frequent pairs of neighbouring symbols become nonterminals,
never across the end of a document, until no pair is frequent. What is stored
are the rules, how many tokens each nonterminal stands for, and the symbols
that are left, all in fixed width; a range of tokens is found from the lengths
and only the symbols it touches are expanded.

File format, all integers little-endian: blocks, then a block table (place in
the file, first token; 8 bytes each), a document table (id, 1 if it is null,
first token, tokens; 8 bytes each) and a tail (blocks, documents, tokens, 8
bytes each, then ``MAGIC``). A block: tokens, symbols, rules, first
nonterminal, bytes of a symbol (8 bytes each); rules (two symbols each);
tokens of each nonterminal (8 bytes); symbols.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillandsia.llm._common import Scratch, worker_cache
from tillandsia.llm.bpe_codec import BATCH_CHARS, CHUNK_CHARS, batches_of, safe_parts
from tillandsia.llm.token_counts import byte_alphabet

#: Tokens of a block, and tokens after which a task begins a new file.
BLOCK_TOKENS, FILE_TOKENS = 1 << 21, 1 << 26
#: Rounds of a grammar, nonterminals made in one, and how often a pair must occur.
ROUNDS, RULES, FREQUENT = 6, 1 << 12, 16
#: A grammar is done when a round replaces less than this share of the symbols.
LEAST_GAIN = 0.01
#: Characters of segments whose ids a worker remembers before it starts afresh.
CACHE_CHARS = 16 << 20
#: Files of a group in which first tokens are added up.
GROUP_FILES = 1024
MAGIC = b"REPAIR01"

#: White space as the tokenizer's pattern has it (not the same as Python's).
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SEGMENTS = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+").findall
_SLOT_BITS, _MIX = 17, np.uint64(0x9E3779B97F4A7C15)
#: The key of neighbours that lie in two documents; symbols stay below 32 bits.
_APART = np.uint64(0xFFFFFFFFFFFFFFFF)


class _Numbers(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class Encoder:
    """Ids of whole texts by a tokenizer file, each different segment encoded by the library once.

    A segment is a run of white space and the run of other characters after
    it. No match of the tokenizer's pre-splitting pattern goes on from other
    characters into white space (the library's byte-level pre-tokenizer, the
    only one accepted here), so a text's ids are those of its segments one
    after another.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        splitter = self.library.pre_tokenizer
        if not isinstance(splitter, pre_tokenizers.ByteLevel) or not splitter.use_regex or splitter.add_prefix_space:
            raise ValueError("only byte-level tokenizers that split by their own pattern and add no space")
        if self.library.normalizer is not None:
            raise ValueError("only tokenizers that do not normalise")
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items() if t.content}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._forget()

    def _forget(self) -> None:
        self.index = _Numbers()
        self.bytes = 0
        self.ids, self.begins = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, segments: list[str]) -> None:
        found = [e.ids for e in self.library.encode_batch_fast(segments, add_special_tokens=False)]
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) + self.begins[-1]
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.uint32, ends[-1] - self.begins[-1])])
        self.begins = np.concatenate([self.begins, ends])
        self.bytes += sum(map(len, segments))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin (one place more than texts)."""
        segments: list[str] = []
        ends = [0]
        for text in texts:
            for part in self.cut.split(text) if self.cut else [text]:
                if part in self.special:
                    segments.append(part)
                else:
                    segments += _SEGMENTS(part)
            ends.append(len(segments))
        if self.bytes > CACHE_CHARS:
            self._forget()
        known = len(self.index)
        at = np.fromiter(map(self.index.__getitem__, segments), np.int64, len(segments))
        if len(self.index) > known:
            self._learn(list(islice(self.index, known, None)))
        begin = self.begins[at]
        size = self.begins[at + 1] - begin
        places = np.concatenate([[0], np.cumsum(size)])
        out = self.ids[np.repeat(begin - places[:-1], size) + np.arange(places[-1])]
        return out, places[ends]


class RankEncoder:
    """The same ids by the tiktoken library, with the vocabulary of the tokenizer file.

    Its merges must be in the order of the ids they make, which is what ranks
    are; other files are refused. Long texts are cut at safe boundaries.
    """

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken

        plain = Encoder(path)
        with open(path, encoding="utf-8") as f:
            merges = json.load(f)["model"]["merges"]
        vocab, alphabet = plain.library.get_vocab(with_added_tokens=False), byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items() if token not in plain.special}
        made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in merges]
        if sorted(set(made)) != made or len(made) + 256 != len(ranks):
            raise ValueError("merges are not in the order of their ids")
        self.special, self.cut, self.pattern = plain.special, plain.cut, pattern
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens=plain.special)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin (one place more than texts)."""
        out, places = [np.empty(0, np.uint32)], [0]
        for text in texts:
            if len(text) <= CHUNK_CHARS:
                parts = [self.encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=())]
            else:
                parts = []
                for plain in self.cut.split(text) if self.cut else [text]:
                    if plain in self.special:
                        parts.append(np.array([self.special[plain]], np.uint32))
                    else:
                        parts += [self.encoding.encode_to_numpy(p, disallowed_special=()) for p in safe_parts(plain, self.pattern)]
            out += parts
            places.append(places[-1] + sum(map(len, parts)))
        return np.concatenate(out), np.array(places)


@dataclass
class Grammar:
    """``symbols`` from ``first`` on are nonterminals: ``rules[s - first]``, standing for ``lengths[s - first]`` tokens."""

    first: int
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray

    def sizes(self) -> np.ndarray:
        """Tokens that each symbol stands for."""
        out = np.ones(len(self.symbols), np.int64)
        inner = self.symbols >= self.first
        out[inner] = self.lengths[self.symbols[inner] - self.first]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The tokens that ``symbols`` stand for, copied from those of each different nonterminal."""
        # each different nonterminal one level of rules at a time, then all symbols from one table
        inner = symbols >= self.first
        rule, plain = symbols[inner] - self.first, symbols[~inner]
        used = np.flatnonzero(np.bincount(rule, minlength=1))
        level = used + self.first
        while (more := level >= self.first).any():
            place = np.arange(len(level)) + np.cumsum(more) - more
            longer = np.empty(len(level) + int(more.sum()), np.int64)
            longer[place] = level
            pairs = self.rules[level[more] - self.first]
            longer[place[more]], longer[place[more] + 1] = pairs[:, 0], pairs[:, 1]
            level = longer
        start = np.zeros(len(self.lengths), np.int64)
        start[used] = np.cumsum(self.lengths[used]) - self.lengths[used]
        begin, size = np.empty(len(symbols), np.int64), np.ones(len(symbols), np.int64)
        begin[inner], size[inner] = start[rule], self.lengths[rule]
        begin[~inner] = len(level) + np.arange(len(plain))
        ends = np.cumsum(size)
        table = np.concatenate([level, plain]).astype(np.uint32)
        return table[np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]

    def tokens(self, begin: int, end: int) -> np.ndarray:
        """Tokens ``begin`` to ``end``, expanding only the symbols that hold them."""
        ends = np.cumsum(self.sizes())
        a, b = np.searchsorted(ends, begin, side="right"), np.searchsorted(ends, end, side="left") + 1
        skip = begin - (ends[a - 1] if a else 0)
        return self.expand(self.symbols[a:b])[skip : skip + end - begin]


def _chosen_pairs(key: np.ndarray, inside: np.ndarray, frequent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which pairs of neighbours one round replaces: their places, rule numbers, and the rules' keys.

    Of overlapping frequent pairs the more frequent one is taken, of equal
    ones (a a a) every other from the left.
    """
    none = np.empty(0, np.int64)
    key = np.where(inside, key, _APART)
    ordered = np.sort(key)
    ordered = ordered[: np.searchsorted(ordered, _APART)]
    begin = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else none
    count = np.diff(np.r_[begin, len(ordered)])
    often = np.flatnonzero(count >= frequent)
    best = often[np.argsort(-count[often], kind="stable")[:RULES]]
    pairs = ordered[begin[best]]
    n = len(pairs)
    if not n:
        return none, none, pairs
    # a table of slots finds a pair's rank; of pairs that share a slot the most frequent one has it
    ranks = np.full(1 << _SLOT_BITS, n, np.int32)
    slots = (pairs * _MIX >> np.uint64(64 - _SLOT_BITS)).view(np.int64)
    ranks[slots[::-1]] = np.arange(n, dtype=np.int32)[::-1]
    # a pair of no rank, before the first place and after the last one too
    rank = np.full(len(key) + 2, n, np.int32)
    here, before, after = rank[1:-1], rank[:-2], rank[2:]
    here[:] = ranks[(key * _MIX >> np.uint64(64 - _SLOT_BITS)).view(np.int64)]
    here[np.append(pairs, _APART)[here] != key] = n
    at = np.flatnonzero((here < before) & (here < after))
    same = np.flatnonzero((here == after) & (here < n))
    if len(same):
        opens = np.r_[True, np.diff(same) > 1]
        run, size = same[opens], np.diff(np.r_[np.flatnonzero(opens), len(same)]) + 1
        least = (before[run] > here[run]) & (after[run + size - 1] > here[run])
        run, taken = run[least], (size[least] + 1) // 2
        more = np.repeat(run, taken) + 2 * (np.arange(taken.sum()) - np.repeat(np.cumsum(taken) - taken, taken))
        at = np.sort(np.concatenate([at, more]))
    return at, here[at].astype(np.int64), pairs


def compress(ids: np.ndarray, ends: np.ndarray) -> Grammar:
    """The grammar of ``ids``; no nonterminal holds tokens on both sides of a place in ``ends`` (after the end)."""
    first = int(ids.max()) + 1 if len(ids) else 0
    symbols = ids.astype(np.uint64)
    last = ends[ends > 0] - 1
    rules, lengths = [np.empty((0, 2), np.int64)], [np.empty(0, np.int64)]
    made = 0
    for _ in range(ROUNDS):
        if len(symbols) < 2:
            break
        inside = np.ones(len(symbols), bool)
        inside[last] = False
        at, rule, pairs = _chosen_pairs(symbols[:-1] << np.uint64(32) | symbols[1:], inside[:-1], FREQUENT)
        # a rule that overlaps left with few uses is not worth its place
        uses = np.bincount(rule, minlength=len(pairs))
        worth = uses >= 4
        if not worth.all():
            at, rule = at[worth[rule]], rule[worth[rule]]
        if not len(at):
            break
        number = np.cumsum(worth) - 1
        pairs = pairs[worth]
        sides = np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], axis=1).astype(np.int64)
        known = np.concatenate(lengths)
        lengths.append(sum(np.where(s < first, 1, known[np.maximum(s - first, 0)] if made else 1) for s in sides.T))
        rules.append(sides)
        symbols[at] = (first + made + number[rule]).astype(np.uint64)
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        gain = len(at) / len(symbols)
        symbols, last = symbols[keep], last - np.searchsorted(at + 1, last, side="right")
        made += len(pairs)
        if gain < LEAST_GAIN:
            break
    return Grammar(first, np.concatenate(rules), np.concatenate(lengths), symbols.astype(np.int64))


def _packed(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").reshape(-1, 1).view(np.uint8)[:, :width]).tobytes()


def _unpacked(data: memoryview, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<i8").ravel()


def block_bytes(grammar: Grammar) -> bytes:
    """A block of the file format."""
    top = max(grammar.first + len(grammar.rules), 1)
    width = max(1, -(-(int(top - 1).bit_length()) // 8))
    tokens = int(grammar.sizes().sum())
    head = np.array([tokens, len(grammar.symbols), len(grammar.rules), grammar.first, width], "<i8").tobytes()
    return head + _packed(grammar.rules.ravel(), width) + grammar.lengths.astype("<i8").tobytes() + _packed(grammar.symbols, width)


def read_block(data: bytes) -> Grammar:
    """What ``block_bytes`` wrote; bytes that don't fit the header raise."""
    view = memoryview(data)
    _, symbols, rules, first, width = np.frombuffer(view[:40], "<i8").tolist()
    a = 40 + 2 * rules * width
    b = a + 8 * rules
    if len(data) != b + symbols * width:
        raise ValueError("block is damaged")
    return Grammar(
        first, _unpacked(view[40:a], width).reshape(-1, 2), np.frombuffer(view[a:b], "<i8"), _unpacked(view[b:], width)
    )


class FileWriter:
    """Writes one file to an output stream; documents come in pieces, in order."""

    def __init__(self, out) -> None:
        self.out, self.size, self.tokens = out, 0, 0
        self.blocks: list[tuple[int, int]] = []
        self.docs: list[tuple[int, int, int, int]] = []
        self.held: list[np.ndarray] = []
        self.ends: list[int] = []
        self.waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, int(doc_id is None), self.tokens, len(ids)))
        self.tokens += len(ids)
        while len(ids):
            part, ids = ids[: BLOCK_TOKENS - self.waiting], ids[BLOCK_TOKENS - self.waiting :]
            self.held.append(part)
            self.waiting += len(part)
            if not len(ids):
                self.ends.append(self.waiting)
            if self.waiting == BLOCK_TOKENS:
                self._block()

    def _block(self) -> None:
        if self.waiting:
            data = block_bytes(compress(np.concatenate(self.held), np.array(self.ends, np.int64)))
            first = self.blocks[-1][2] if self.blocks else 0
            self.blocks.append((self.size, first, first + self.waiting))
            self.out.write(data)
            self.size += len(data)
        self.held, self.ends, self.waiting = [], [], 0

    def close(self) -> int:
        """Writes the tables and the tail; returns the file's size."""
        self._block()
        tables = [np.array([b[:2] for b in self.blocks], "<i8").tobytes(), np.array(self.docs, "<i8").tobytes()]
        tail = np.array([len(self.blocks), len(self.docs), self.tokens], "<i8").tobytes() + MAGIC
        for data in (*tables, tail):
            self.out.write(data)
            self.size += len(data)
        self.out.close()
        return self.size


class FileReader:
    """Reads a file's documents, all in order or any range of tokens."""

    def __init__(self, file) -> None:
        self.file, size = file, file.size()
        tail = file.read_at(32, size - 32) if size >= 32 else b""
        if tail[-8:] != MAGIC:
            raise ValueError("not a file of token grammars, or cut off")
        blocks, docs, self.tokens = np.frombuffer(tail[:24], "<i8").tolist()
        tables = size - 32 - 16 * blocks - 32 * docs
        table = np.frombuffer(file.read_at(16 * blocks, tables), "<i8").reshape(-1, 2)
        self.places = np.r_[table[:, 0], tables]
        self.firsts = np.r_[table[:, 1], self.tokens]
        self.docs = np.frombuffer(file.read_at(32 * docs, tables + 16 * blocks), "<i8").reshape(-1, 4)

    def block(self, k: int) -> Grammar:
        return read_block(self.file.read_at(int(self.places[k + 1] - self.places[k]), int(self.places[k])))

    def range(self, start: int, length: int) -> np.ndarray:
        """Tokens ``start`` to ``start + length``, by the blocks and symbols that hold them."""
        out, end = [np.empty(0, np.uint32)], start + length
        for k in range(int(np.searchsorted(self.firsts, start, side="right")) - 1, len(self.places) - 1):
            first, stop = int(self.firsts[k]), int(self.firsts[k + 1])
            if first >= end:
                break
            out.append(self.block(k).tokens(max(start, first) - first, min(end, stop) - first))
        return np.concatenate(out)

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """Id, first token and the tokens, in pieces, of each document; take all pieces before the next."""
        k, first, tokens = -1, 0, np.empty(0, np.uint32)

        def parts(start: int, end: int) -> Iterator[np.ndarray]:
            nonlocal k, first, tokens
            while start < end:
                if start >= first + len(tokens):
                    k += 1
                    grammar = self.block(k)
                    first, tokens = int(self.firsts[k]), grammar.expand(grammar.symbols)
                stop = min(end, first + len(tokens))
                yield tokens[start - first : stop - first]
                start = stop

        for doc_id, null, start, n in self.docs.tolist():
            yield None if null else doc_id, start, parts(start, start + n)


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocab_path: str,
    pattern: str | None = None,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Write the ids of every text of ``docs``, each with ``end_id``, to files in ``folder`` (a URI).

    Returns ``(path, part, number, size, docs, tokens)``, one row per file;
    running it writes them. Documents lie in the files in ascending order of
    their ids (``bigint``), files in that of part and number. Ids are those
    of the tokenizer file at ``vocab_path`` (byte-level BPE, readable on every
    executor) for the whole text, special strings inside it as their one
    id. With ``pattern``, that by which the tokenizer splits, the same ids come
    from the tiktoken library, which is faster. A null text counts as empty and has
    only ``end_id``; null ids come last; rows that repeat an id all stay, next
    to each other in no stated order. An empty table writes nothing. Other
    columns are ignored, whatever their names.

    A file's name holds the task's attempt, and the table returned names the
    files of the attempts that counted; others are never read.
    """
    scratch = Scratch(docs.sparkSession, "tokens")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def load() -> Encoder | RankEncoder:
            return RankEncoder(vocab_path, pattern) if pattern else Encoder(vocab_path)

        encoder = worker_cache(("encoder", vocab_path, pattern), load)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in batches_of(texts, BATCH_CHARS):
                ids, places = encoder.encode(texts[a:b])
                parts = [np.append(ids[s:e], np.uint32(end_id)) for s, e in zip(places, places[1:])]
                wide = [bool(p.max() > 0xFFFF) for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([p.astype("<u4" if w else "<u2").tobytes() for p, w in zip(parts, wide)], pa.binary()),
                        pa.array(wide),
                        pa.array([len(p) for p in parts], pa.int64()),
                    ],
                    names=["doc_id", "ids", "wide", "n"],
                )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tokens = scratch.save(
        rows.mapInArrow(encode, "doc_id bigint, ids binary, wide boolean, n bigint").withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "ids",
    )
    total = tokens.agg(F.sum("n")).first()[0] or 0
    # as many parts as files, but at small sizes one for each core
    cores = docs.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-total // file_tokens), min(4 * cores, -(-total // BLOCK_TOKENS)))
    order = [F.col("doc_id").asc_nulls_last(), F.col("row").asc()]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        store, base = pafs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        writer, name, number = None, "", 0

        def closed() -> pa.RecordBatch:
            row = (f"{folder}/{name}", task.partitionId(), number, writer.close(), len(writer.docs), writer.tokens)
            return pa.RecordBatch.from_pydict(
                {k: [v] for k, v in zip(("path", "part", "number", "size", "docs", "tokens"), row)}
            )

        for batch in batches:
            for doc_id, ids, wide in zip(*(c.to_pylist() for c in batch.columns[:3])):
                if writer is None:
                    store.create_dir(base, recursive=True)
                    name = f"part-{task.partitionId():06d}-{number:04d}-{task.taskAttemptId()}.rpg"
                    writer = FileWriter(store.open_output_stream(f"{base}/{name}", compression=None))
                writer.add(doc_id, np.frombuffer(ids, "<u4" if wide else "<u2"))
                if writer.tokens >= file_tokens:
                    yield closed()
                    writer, number = None, number + 1
        if writer is not None:
            yield closed()

    return (
        tokens.select("doc_id", "ids", "wide", "row")
        .repartitionByRange(int(parts), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(write, "path string, part bigint, number bigint, size bigint, docs bigint, tokens bigint")
    )


def read_token_files(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in ``files``, the table that the writer returned.

    ``start`` tokens of all documents come before it; ``ids_crc32`` is of its
    ids as little-endian 32-bit integers. ``with_ids`` adds those bytes as
    ``ids``. All tokens are decoded from the files; damaged ones raise. An
    empty table gives no rows.
    """
    # first tokens: within groups of parts, then over the groups
    files = files.withColumn("files", F.floor(F.col("part") / GROUP_FILES))
    inside = Window.partitionBy("files").orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    groups = files.groupBy("files").agg(F.sum("tokens").alias("n"))
    across = Window.orderBy("files").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("files", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("before"))
    placed = files.join(groups, "files").select(
        "path", (F.coalesce(F.sum("tokens").over(inside), F.lit(0)) + F.col("before")).alias("first")
    )
    n = files.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
        types = [pa.int64()] * 4 + [pa.binary()]
        k = len(names) if with_ids else 4

        def to_batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types[:k])], names=names[:k])

        for batch in batches:
            for path, first in zip(*(c.to_pylist() for c in batch.columns)):
                store, place = pafs.FileSystem.from_uri(path)
                with store.open_input_file(place) as file:
                    rows, held = [], 0
                    for doc_id, start, parts in FileReader(file).documents():
                        size, crc, kept = 0, 0, []
                        for part in parts:
                            raw = part.astype("<u4").tobytes()
                            size, crc = size + len(part), zlib.crc32(raw, crc)
                            if with_ids:
                                kept.append(raw)
                        rows.append((doc_id, first + start, size, crc, b"".join(kept)))
                        held += 4 * size if with_ids else 0
                        if len(rows) >= 4096 or held >= 8 << 20:
                            yield to_batch([r[:k] for r in rows])
                            rows, held = [], 0
                    if rows:
                        yield to_batch([r[:k] for r in rows])

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return placed.repartition(max(1, int(n))).mapInArrow(read, schema)
