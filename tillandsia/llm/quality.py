"""Quality classifier: random indexing, pooled per document, and a small network.

Every feature of a word (the word, its shape, its ending) has a fixed sparse
random index vector. Its word vector is the sum of the index vectors of the
words around it in all documents, labelled or not, summed as whole numbers by
tasks, so that the order of rows changes nothing. A document is the mean of its
words' vectors with a few figures of the pooling itself: how much its words
repeat, and how alike those are that stand close together. A two-layer network
in numpy, fitted on a bounded sample of labelled documents, scores it; a
temperature fitted on documents it did not learn from calibrates the score.

Words are found and hashed in arrays of bytes, many texts at a time, and all
sums are of whole numbers that fit their type, so neither the length of a text
or word nor how texts are put together changes a figure.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillandsia.llm._common import Scratch, free_name, mix64, worker_cache

#: Rows of the vector table (features share them by hash), dimensions, and signs in an index vector.
ROW_BITS, DIMS, SIGNS = 15, 48, 6
ROWS = 1 << ROW_BITS
#: Distances at which the likeness of words is pooled.
LAGS = 4
#: Words to either side that count as a word's context.
WINDOW = 2
#: At most so many labelled documents are learned from.
TRAIN_ROWS = 8000
#: Pieces in which the table of word sums is added up, and how many of one piece are added at a time.
SUM_CHUNKS, FAN_IN = 32, 128
#: Share of them that only fits the temperature.
CALIBRATION = 0.2
#: Hidden units, rounds over the sample, weight decay, and the score from which a document is good.
HIDDEN, EPOCHS, DECAY, THRESHOLD = 32, 60, 1e-3, 0.7
#: Bytes of text whose words are found at a time, and words whose contexts are added at a time.
PIECE_BYTES, BATCH_WORDS = 1 << 18, 1 << 19
#: A word vector's components are multiples of 1 / UNIT; sums of so many words are whole in single precision.
UNIT, EXACT_WORDS = 1 << 10, 1 << 12

_WHITE = b" \t\n\r\x0b\x0c"
_SPACE = re.compile(rb"\s")
_IS_WORD = np.array([b not in _WHITE for b in range(256)])
_SHAPE = np.array(
    [
        ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b
        for b in range(256)
    ],
    np.uint8,
)
#: Fixed value: base of the words' polynomial hash, modulo 2**64.
_BASE = 0x9E3779B97F4A7C15


def index_vectors() -> np.ndarray:
    """The fixed index vectors: ``SIGNS`` entries of 1 or -1 in each row."""
    rng = np.random.default_rng(7)
    places = np.argsort(rng.random((ROWS, DIMS)), axis=1)[:, :SIGNS]
    out = np.zeros((ROWS, DIMS), np.int8)
    np.put_along_axis(out, places, rng.choice(np.array([-1, 1], np.int8), (ROWS, SIGNS)), axis=1)
    return out


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """``_BASE`` to the powers of the places in a piece, and to their negatives."""

    def up(base: int) -> np.ndarray:
        return np.cumprod(np.r_[np.ones(1, np.uint64), np.full(2 * PIECE_BYTES, base, np.uint64)])

    return up(_BASE), up(pow(_BASE, -1, 1 << 64))


def _hashes(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of ``values[i] * _BASE**(i - start)`` of each run of ``values`` that begins at ``starts``."""
    up, down = worker_cache("powers", _powers)
    return np.add.reduceat(values * up[: len(values)], starts) * down[starts]


def _rows_of_hashes(*hashes: np.ndarray) -> np.ndarray:
    return np.stack([(mix64(h + np.uint64(k)) >> np.uint64(64 - ROW_BITS)).astype(np.int32) for k, h in enumerate(hashes)], axis=1)


def word_rows(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the vector table for each word's spelling, shape and ending, and where the words start.

    Words are what white space (the six ASCII ones) leaves. A shape has one
    sign for each kind of letter, without repeats; an ending is the last three
    bytes. More than ``2 * PIECE_BYTES`` must be one word.
    """
    if len(data) > 2 * PIECE_BYTES:
        return _long_word(data), np.zeros(1, np.int64)
    byte = np.frombuffer(data, np.uint8)
    word = _IS_WORD[byte]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    if not len(starts):
        return np.empty((0, 3), np.int32), starts
    spelling = _hashes(np.where(word, byte.astype(np.uint64) + np.uint64(1), np.uint64(0)), starts)
    shape = _SHAPE[byte]
    kept = word.copy()
    kept[1:] &= (shape[1:] != shape[:-1]) | first[1:]
    shapes = _hashes(shape[kept].astype(np.uint64) + np.uint64(1), (np.cumsum(kept) - 1)[starts])
    ending = np.zeros(len(starts), np.uint64)
    for back in range(3):
        at = ends - back
        ending = ending << np.uint64(9) | np.where(at >= starts, byte[np.maximum(at, 0)].astype(np.uint64) + np.uint64(1), 0)
    return _rows_of_hashes(spelling, shapes, ending), starts


def _long_word(word: bytes) -> np.ndarray:
    """``word_rows`` of one word of any length, read piece by piece."""
    spelling, shapes, n, last = 0, 0, 0, -1
    for begin in range(0, len(word), PIECE_BYTES):
        byte = np.frombuffer(word, np.uint8, min(PIECE_BYTES, len(word) - begin), begin)
        spelling += pow(_BASE, begin, 1 << 64) * int(_hashes(byte.astype(np.uint64) + np.uint64(1), np.zeros(1, np.int64))[0])
        shape = _SHAPE[byte]
        shape = shape[np.r_[shape[0] != last, shape[1:] != shape[:-1]]]
        if len(shape):
            shapes += pow(_BASE, n, 1 << 64) * int(_hashes(shape.astype(np.uint64) + np.uint64(1), np.zeros(1, np.int64))[0])
            n, last = n + len(shape), shape[-1]
    ending = 0
    for b in word[-3:][::-1]:
        ending = ending << 9 | b + 1
    return _rows_of_hashes(*(np.array([h % (1 << 64)], np.uint64) for h in (spelling, shapes, ending)))


def pieces(text: bytes) -> Iterator[bytes]:
    """``text`` in parts of at most ``2 * PIECE_BYTES``, cut at white space only; a longer word is one part."""
    begin = 0
    while len(text) - begin > 2 * PIECE_BYTES:
        found = _SPACE.search(text, begin + PIECE_BYTES)
        end = found.start() if found else len(text)
        if end - begin > 2 * PIECE_BYTES:
            gap = max(text.rfind(c, begin, begin + PIECE_BYTES) for c in map(bytes, zip(_WHITE)))
            if gap >= 0:
                yield text[begin:gap]
                begin = gap + 1
        yield text[begin:end]
        begin = end
    yield text[begin:]


def word_batches(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``word_rows`` of all words of ``texts`` in order, and the number of each word's text."""
    held: list[bytes] = []
    owners: list[int] = []
    size = 0

    def batch() -> tuple[np.ndarray, np.ndarray]:
        rows, starts = word_rows(b" ".join(held))
        begins = np.cumsum([0] + [len(p) + 1 for p in held[:-1]])
        return rows, np.array(owners)[np.searchsorted(begins, starts, side="right") - 1]

    for i, text in enumerate(texts):
        for piece in pieces(text):
            if held and size + len(piece) >= 2 * PIECE_BYTES:
                yield batch()
                held, owners, size = [], [], 0
            held.append(piece)
            owners.append(i)
            size += len(piece) + 1
    if held:
        yield batch()


def _runs(sorted_rows: np.ndarray, most: int) -> np.ndarray:
    """Where runs of one value begin, none longer than ``most``."""
    begin = np.flatnonzero(np.r_[True, sorted_rows[1:] != sorted_rows[:-1]])
    nth = np.arange(len(sorted_rows)) - np.repeat(begin, np.diff(np.r_[begin, len(sorted_rows)]))
    return np.flatnonzero(nth % most == 0)


def _add_by_row(sums: np.ndarray, rows: np.ndarray, packed: np.ndarray) -> None:
    """Adds to ``sums[rows]`` the bytes (0 to 24) of the 64-bit words in ``packed``, one line a row.

    Eight bytes are added at a time; at most 10 lines, then 256 such sums, so
    that no byte and no 16-bit sum overflows.
    """
    key = np.sort(rows.astype(np.int64) << 32 | np.arange(len(rows)))
    row, order = key >> 32, key & 0xFFFFFFFF
    at = _runs(row, 10)
    part, row = np.add.reduceat(packed[order], at).view(np.uint8).astype(np.uint16), row[at]
    at = _runs(row, 256)
    part, row = np.add.reduceat(part.view(np.uint64), at).view(np.uint16), row[at]
    while len(row):
        first = np.r_[True, row[1:] != row[:-1]]
        sums[row[first]] += part[first]
        row, part = row[~first], part[~first]


def context_sums(texts: Iterable[bytes]) -> np.ndarray:
    """For each row of the vector table, the sum of the index vectors around its words."""
    # the last row is the gap between texts, without a vector
    signs = np.concatenate([worker_cache("index vectors", index_vectors), np.zeros((1, DIMS), np.int8)])
    sums, seen = np.zeros((ROWS + 1, DIMS), np.int64), np.zeros(ROWS + 1, np.int64)
    gap = np.full((WINDOW, 3), ROWS, np.int32)

    def add(rows: np.ndarray, old: int) -> None:
        """The first ``old`` words have been added; they get, and are, new words' context only."""
        own = signs[rows[:, 0]] + signs[rows[:, 1]] + signs[rows[:, 2]]
        around = np.full_like(own, 6 * WINDOW)  # keeps the sums of up to 2 * WINDOW words positive
        for d in range(1, WINDOW + 1):
            begin = max(0, old - d)
            around[begin + d :] += own[begin:-d]
            around[begin:-d] += own[begin + d :]
        packed = around.view(np.uint64)
        for column in rows.T:
            _add_by_row(sums, column, packed)
            seen[:] += np.bincount(column, minlength=ROWS + 1)

    held, size, old, last = [], 0, 0, -1
    for rows, owner in word_batches(texts):
        cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else []
        for begin, end in zip(cuts, [*cuts[1:], len(owner)]):
            if owner[begin] != last:
                held.append(gap)
                size, last = size + WINDOW, owner[begin]
            held.append(rows[begin:end])
            size += end - begin
        if size >= BATCH_WORDS:
            joined = np.concatenate(held)
            add(joined, old)
            held, size, old = [joined[-WINDOW:]], WINDOW, WINDOW
    if size > old:
        add(np.concatenate(held), old)
    return (sums - 6 * WINDOW * seen[:, None])[:ROWS]


def pack_sums(chunk: int, sums: np.ndarray) -> tuple[int, bytes, bytes]:
    """A piece of the table of sums without the rows that are all zero."""
    at = np.flatnonzero(sums.any(axis=1))
    return chunk, at.astype("<i4").tobytes(), sums[at].astype("<i8").tobytes()


def add_packed(total: np.ndarray, at: bytes, sums: bytes) -> None:
    """Adds what ``pack_sums`` made to a piece of the table."""
    total[np.frombuffer(at, "<i4")] += np.frombuffer(sums, "<i8").reshape(-1, DIMS)


def corpus_sums(texts: DataFrame, fan_in: int = FAN_IN) -> np.ndarray:
    """``context_sums`` of the binary column ``text`` over all rows of ``texts``.

    Each task sums its rows and hands on one table of fixed size in pieces.
    They are added in three levels, at most ``fan_in`` tables at a time (up to
    ``fan_in ** 3`` tasks), which bounds what a task holds.
    """

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = context_sums(t or b"" for batch in batches for t in batch.column(0).to_pylist())
        packed = [pack_sums(i, c) for i, c in enumerate(np.split(sums, SUM_CHUNKS)) if c.any()]
        if packed:
            yield pa.RecordBatch.from_pydict(dict(zip(("chunk", "at", "sums"), zip(*packed))))

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros((ROWS // SUM_CHUNKS, DIMS), np.int64)
        for at, sums in zip(table.column("at"), table.column("sums")):
            add_packed(total, at.as_py(), sums.as_py())
        chunk, at, sums = pack_sums(table.column("chunk")[0].as_py(), total)
        return pa.table({"piece": [table.column("piece")[0].as_py() // fan_in], "chunk": [chunk], "at": [at], "sums": [sums]})

    parts = texts.select("text").mapInArrow(contexts, "chunk bigint, at binary, sums binary")
    parts = parts.withColumn("piece", F.floor(F.spark_partition_id() / fan_in))
    for _ in range(3):
        parts = parts.groupBy("chunk", "piece").applyInArrow(add, "piece bigint, chunk bigint, at binary, sums binary")
    sums = np.zeros((ROWS, DIMS), np.int64)
    for row in parts.collect():  # one row a chunk, unless there are more than fan_in ** 3 tasks
        add_packed(np.split(sums, SUM_CHUNKS)[row["chunk"]], row["at"], row["sums"])
    return sums


def word_table(sums: np.ndarray) -> np.ndarray:
    """Unit vectors from the sums, in multiples of 1 / UNIT; a row never met keeps its index vector."""
    table = np.where(np.any(sums, axis=1, keepdims=True), sums, index_vectors()).astype(np.float64)
    return np.rint(UNIT * table / np.linalg.norm(table, axis=1, keepdims=True)).astype(np.int16)


class Pooler:
    """Turns texts into document vectors."""

    def __init__(self, table: np.ndarray) -> None:
        self.table, self.signs = table, worker_cache("index vectors", index_vectors)

    def features(self, texts: list[bytes]) -> np.ndarray:
        """One row per text; a text without words is all zero.

        All sums are exact: single precision holds those of EXACT_WORDS words,
        which are added up in double.
        """
        total, raw_total = np.zeros((len(texts), DIMS)), np.zeros((len(texts), DIMS))
        own, near, n = np.zeros(len(texts)), np.zeros((len(texts), LAGS)), np.zeros(len(texts))
        ones, before, last = np.ones(EXACT_WORDS, np.float32), np.empty((0, DIMS), np.float32), -1
        for rows, owner in word_batches(texts):
            if not len(rows):
                continue
            a, b, c = rows.T
            vectors = (self.table[a] + self.table[b] + self.table[c]).astype(np.float32)
            raw = (self.signs[a] + self.signs[b] + self.signs[c]).astype(np.float32)
            cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            for begin, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(owner)]):
                i = owner[begin]
                n[i] += end - begin
                for s in range(begin, end, EXACT_WORDS):
                    e = min(end, s + EXACT_WORDS)
                    total[i] += ones[: e - s] @ vectors[s:e]
                    raw_total[i] += ones[: e - s] @ raw[s:e]
                    flat = raw[s:e].ravel()
                    own[i] += flat @ flat
                    for lag in range(1, LAGS + 1):
                        at = max(s, begin + lag)
                        if at < e:
                            near[i, lag - 1] += raw[at:e].ravel() @ raw[at - lag : e - lag].ravel()
                if i == last:  # the text began in an earlier batch, whose last words are these words' neighbours
                    both, old = np.concatenate([before, raw[begin : min(end, begin + LAGS)]]), len(before)
                    for lag in range(1, LAGS + 1):
                        at = np.arange(max(old, lag), min(len(both), old + lag))
                        near[i, lag - 1] += float((both[at] * both[at - lag]).sum())
                else:
                    before = before[:0]
                before, last = np.concatenate([before, raw[max(begin, end - LAGS) : end]])[-LAGS:], i
        out = np.zeros((len(texts), DIMS + 4 + LAGS))
        some = n > 0
        count = n[some]
        mean, whole = total[some] / UNIT / count[:, None], own[some]
        whole = np.where(whole > 0, whole, 1)
        # near 1 if one word makes up the text, near 1 / n if all words differ
        repeats = (raw_total[some] ** 2).sum(axis=1) / count / whole
        figures = [repeats, np.log(repeats + 1e-4) / 9, np.linalg.norm(mean, axis=1), np.log1p(count) / 10]
        # last, how alike a word and the ones shortly before it are
        out[some] = np.concatenate([mean, np.stack(figures, axis=1), near[some] / whole[:, None]], axis=1)
        return out


@dataclass
class Model:
    """What scoring needs; ``fitted`` is false if there was nothing to learn from."""

    table: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float
    fitted: bool = True

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of a good document; 0.5 if nothing was learned."""
        if not self.fitted:
            return np.full(len(x), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def loss_and_gradients(params: list[np.ndarray], z: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean log loss of ``w1, b1, w2, b2`` with weight decay, and its gradients."""
    hidden = np.tanh(z @ params[0] + params[1])
    logit = hidden @ params[2] + params[3]
    p = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
    loss = np.mean(np.logaddexp(0, logit) - y * logit) + DECAY / 2 * ((params[0] ** 2).sum() + (params[2] ** 2).sum())
    d = (p - y) / len(y)
    dh = np.outer(d, params[2]) * (1 - hidden * hidden)
    grads = [z.T @ dh + DECAY * params[0], dh.sum(axis=0), hidden.T @ d + DECAY * params[2], np.array([d.sum()])]
    return float(loss), grads


def best_temperature(logit: np.ndarray, y: np.ndarray) -> float:
    """Of 61 temperatures from 0.5 to 8 the one with the least mean log loss."""

    def loss(temperature: float) -> float:
        return float(np.mean(np.logaddexp(0, logit / temperature) - y * logit / temperature))

    return float(min(np.geomspace(0.5, 8, 61), key=loss))


def train_network(x: np.ndarray, y: np.ndarray, table: np.ndarray, seed: int = 11) -> Model:
    """Fits the network by Adam on most rows, and the temperature on the rest."""
    n, width = x.shape
    rng = np.random.default_rng(seed)
    held = rng.permutation(n) < int(n * CALIBRATION)
    tx, ty = (x[~held], y[~held]) if (~held).any() else (x, y)
    centre, scale = tx.mean(axis=0), tx.std(axis=0) + 1e-6
    z = (tx - centre) / scale
    params = [rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(EPOCHS):
        order, rate = rng.permutation(len(z)), 0.01 * (1 - epoch / EPOCHS) + 1e-4
        for at in range(0, len(order), 128):
            rows = order[at : at + 128]
            step += 1
            for i, g in enumerate(loss_and_gradients(params, z[rows], ty[rows])[1]):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                m, v = first[i] / (1 - 0.9**step), second[i] / (1 - 0.999**step)
                params[i] = params[i] - rate * m / (np.sqrt(v) + 1e-8)
    model = Model(table, centre, scale, *params[:3], float(params[3][0]), 1.0)
    if held.any():
        model.temperature = best_temperature(model.logits(x[held]), y[held])
    return model


def held_out(id_col: Column) -> Column:
    """Rows never learned from: the id's CRC-32, as text, leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: int = TRAIN_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """A model of ``label_col`` from at most ``train_rows`` labelled documents.

    They are the first by the hash of their id, held-out rows excluded; a
    label is the mean of its document's, at least 0.5 counting as 1; null ids
    and labels are left out, and of rows repeating an id one text is used. The
    word vectors need no labels and come from the texts of all rows of ``docs``.
    Labels of one class only, or none, give a model that scores all 0.5.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    chosen = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.avg("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(train_rows)
    )
    # at most train_rows ids are broadcast
    sample = (
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.max("text").cast("binary").alias("text"), F.max("label").alias("label"))
    )
    sample = scratch.save(sample.repartition(8, "doc_id"), "sample")

    table = word_table(corpus_sums(docs.select(F.col(text_col).cast("string").cast("binary").alias("text"))))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pooler = Pooler(shared.value)
        for batch in batches:
            x = pooler.features([t or b"" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))],
                names=["doc_id", "label", "x"],
            )

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.select("doc_id", "text", "label").mapInArrow(pooled, f"doc_id {kind}, label double, x array<double>").collect()
    rows.sort(key=lambda r: r["doc_id"])
    y = np.array([r["label"] >= 0.5 for r in rows], np.float64)
    if len(set(y.tolist())) < 2:
        zero = np.zeros(1)
        return Model(table, zero, zero, zero, zero, zero, 0.0, 1.0, fitted=False)
    return train_network(np.array([r["x"] for r in rows]), y, table)


def with_score(docs: DataFrame, model: Model, score_col: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the score (0 to 1, higher: better) of each whole text as ``score_col``.

    A null text scores as an empty one. All other columns stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        pooler = Pooler(model.table)
        for texts in batches:
            yield pd.Series(model.scores(pooler.features([bytes(t) if t is not None else b"" for t in texts])), dtype="float64")

    return docs.withColumn(score_col, score(F.col(f"`{text_col}`").cast("string").cast("binary")))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: int = TRAIN_ROWS,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Only the text goes into a score; empty and null texts have one too.
    ``predicted`` is 1 if the score is at least ``threshold``. Null ids are
    not held out; repeated rows pass through; an empty table gives an empty
    table. Other columns are ignored, whatever their names.
    """
    model = fit_quality(docs, labels, train_rows, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_score(rows, model, "score").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``threshold``, all columns as they are.

    Without labels of both classes there is nothing to judge by: all rows stay.
    Columns may have any names.
    """
    model = fit_quality(docs, labels, id_col=id_col, text_col=text_col)
    if not model.fitted:
        return docs
    name = free_name(docs, "score_of_text")
    return with_score(docs, model, name, text_col).where(F.col(name) >= threshold).drop(name)
