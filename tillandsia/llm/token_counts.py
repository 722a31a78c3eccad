"""Token counts by rank-synchronous merging over arrays.

Pre-tokens that are new to a worker are held as one ragged numpy array of
byte symbols. In each round every pre-token merges all places of its own
lowest-ranked pair at once, until none has a mergeable pair left; the
surviving symbols are its tokens. Long pre-tokens go through the same rounds
with their places kept by rank, so that a round touches only what it merges.
Counts of pre-tokens seen before are looked up, so a word is merged once per
worker, not once per place.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillandsia.llm._common import worker_cache

#: Pre-tokens whose counts a worker remembers, and their characters, before it starts afresh.
CACHE_WORDS, CACHE_CHARS = 400_000, 8 << 20
#: Characters of text counted at a time, which bounds a worker's memory.
BATCH_CHARS = 1 << 21
#: Bytes of pre-tokens merged at a time, and of one from which on its places are kept by rank.
MERGE_BYTES, LONG_BYTES = 1 << 20, 256


def byte_alphabet() -> dict[str, int]:
    """The byte for each character that byte-level vocabulary files write bytes with."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class MergeTable:
    """Pairs of token ids that merge, in the order of their ranks."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        self.byte_ids = np.zeros(256, np.int64)
        for char, byte in alphabet.items():
            self.byte_ids[byte] = vocab[char]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)  # by rank
        self.none = len(merges)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or ``none``."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def count(self, words: list[bytes]) -> np.ndarray:
        """How many symbols each of ``words`` (not empty) keeps after all merges."""
        long = np.fromiter((len(w) >= LONG_BYTES for w in words), bool, len(words))
        if not long.any():
            return self.count_short(words)
        counts = np.empty(len(words), np.int64)
        counts[long] = self.count_long([w for w in words if len(w) >= LONG_BYTES])
        counts[~long] = self.count_short([w for w in words if len(w) < LONG_BYTES])
        return counts

    def count_short(self, words: list[bytes]) -> np.ndarray:
        """``count`` by rounds that each go over all symbols left."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        counts = lengths.copy()
        # rank[i]: of the pair of symbols i and i + 1; none across words and at the end
        rank = np.full(len(symbols), self.none, np.int64)
        rank[:-1] = self.rank(symbols[:-1], symbols[1:])
        rank[:-1][owner[:-1] != owner[1:]] = self.none
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(symbols)])
            lowest = np.minimum.reduceat(rank, starts)
            counts[owner[starts]] = sizes
            live = lowest < self.none
            if not live.all():  # words without a mergeable pair are done
                keep = np.repeat(live, sizes)
                symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
                if not len(symbols):
                    break
                lowest, sizes = lowest[live], sizes[live]
            at = np.flatnonzero(rank == np.repeat(lowest, sizes))
            # of overlapping places (a a a) every other one merges, from the left
            run = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]])])
            nth = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at = at[nth % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            changed = place[at]
            changed = np.unique(np.r_[changed, changed[changed > 0] - 1])
            changed = changed[changed < len(symbols) - 1]
            fresh = self.rank(symbols[changed], symbols[changed + 1])
            rank[changed] = np.where(owner[changed] == owner[changed + 1], fresh, self.none)
            rank[-1] = self.none
        return counts

    def count_long(self, words: list[bytes]) -> np.ndarray:
        """``count`` by rounds that each touch only the places of one rank.

        A symbol stays where it begins, linked to those beside it; places wait
        under their rank, and those that changed meanwhile are passed over.
        Words whose lowest rank is higher than a round's hold none of its
        places, so one round serves all words.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner, size = np.repeat(np.arange(len(words)), lengths), len(symbols)
        before, after = np.arange(-1, size - 1), np.arange(1, size + 1)
        alive, rank = np.ones(size, bool), np.full(size, self.none, np.int64)
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def refresh(places: np.ndarray) -> None:
            """Ranks of the pairs that begin at ``places``, and the places under them."""
            right = np.minimum(after[places], size - 1)
            fresh = self.rank(symbols[places], symbols[right])
            fresh[(after[places] == size) | (owner[places] != owner[right])] = self.none
            rank[places] = fresh
            places, fresh = places[fresh < self.none], fresh[fresh < self.none]
            order = np.argsort(fresh, kind="stable")
            places, fresh = places[order], fresh[order]
            begin = np.flatnonzero(np.r_[True, fresh[1:] != fresh[:-1]]) if len(fresh) else fresh
            for r, a, b in zip(fresh[begin].tolist(), begin, [*begin[1:], len(fresh)]):
                if r not in waiting:
                    waiting[r] = []
                    heappush(queue, r)
                waiting[r].append(places[a:b])

        refresh(np.arange(size))
        while queue:
            lowest = heappop(queue)
            at = np.unique(np.concatenate(waiting.pop(lowest)))
            at = at[rank[at] == lowest]
            if not len(at):
                continue
            # of overlapping places (a a a) every other one merges, from the left
            run = np.flatnonzero(np.r_[True, after[at[:-1]] != at[1:]])
            nth = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at = at[nth % 2 == 0]
            gone = after[at]
            symbols[at], alive[gone], rank[gone] = self.merged[lowest], False, self.none
            after[at] = after[gone]
            inner = at[after[at] < size]
            before[after[inner]] = inner
            left = before[at]
            refresh(np.unique(np.r_[at, left[left >= 0]]))
        return np.bincount(owner[alive], minlength=len(words))


def token_counts(
    docs: DataFrame,
    vocab_path: str,
    pattern: str,
    limit: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``.

    ``n_tokens`` is what the tokenizer file at ``vocab_path`` (byte-level BPE,
    readable on every executor) gives for the whole text without begin or end
    tokens; a special token's string inside a text counts as that one token,
    the tokenizer library's default. ``over_limit``: more than ``limit``. A
    null text counts as empty (0 bytes, 0 tokens); null ids and repeated rows
    pass through; an empty table gives an empty table. Other columns are
    ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        table = worker_cache(("merges", vocab_path), lambda: MergeTable(vocab_path))
        split = worker_cache(("pattern", pattern), lambda: regex.compile(pattern)).findall
        special = [s for s in table.special if s]
        cut = regex.compile("|".join(regex.escape(s) for s in special)) if special else None
        known: dict[str, int] = worker_cache(("counts", vocab_path, pattern), dict)
        held: dict[str, int] = worker_cache(("characters", vocab_path, pattern), lambda: {"n": 0})

        def learn(words: list[str]) -> None:
            held["n"] += sum(map(len, words))
            raw = [w.encode() for w in words]
            begin, size = 0, 0
            for i, word in enumerate(raw):
                size += len(word)
                if size >= MERGE_BYTES or i == len(raw) - 1:
                    known.update(zip(words[begin : i + 1], table.count(raw[begin : i + 1]).tolist()))
                    begin, size = i + 1, 0

        def counted(texts: list[str]) -> list[int]:
            rows, extra = [], []
            for text in texts:
                parts = cut.split(text) if cut else [text]
                extra.append(len(parts) - 1)
                rows.append(split(text) if len(parts) == 1 else [w for p in parts for w in split(p)])
            seen = set().union(*rows)
            new = [w for w in seen if w not in known]
            if len(known) + len(new) > CACHE_WORDS or held["n"] + sum(map(len, new)) > CACHE_CHARS:
                known.clear()
                held["n"], new = 0, list(seen)
            if new:
                learn(new)
            get = known.__getitem__
            return [sum(map(get, row)) + n for row, n in zip(rows, extra)]

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens: list[int] = []
            begin, size = 0, 0
            for i, text in enumerate(texts):
                size += len(text)
                if size >= BATCH_CHARS or i == len(texts) - 1:
                    tokens += counted(texts[begin : i + 1])
                    begin, size = i + 1, 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
