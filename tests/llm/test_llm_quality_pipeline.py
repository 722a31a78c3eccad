"""The quality classifier, and the pipeline against its stages done by brute force."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_ORACLE, SF_SMALL
from llm_fixtures import nothing, tricky  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from tillandsia.llm import quality as Q
from tillandsia.llm.quality import context_sums, fit_quality, keep_good, quality_scores, with_score, word_table
from tillandsia.llm.queries import op7_quality


def test_held_out_accuracy_on_the_whole_table(spark):
    rows = op7_quality(spark, SF_ORACLE).collect()
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.select("doc_id").collect())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 60
    assert np.mean([y == p for _, y, p in held]) > 0.9
    good, bad = ([s for s, y, _ in held if y == k] for k in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95


def test_scores_depend_on_nothing_but_the_text_and_what_may_be_learned(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    before = {r.doc_id: r.score for r in quality_scores(docs, labels).collect()}
    # other held-out labels, and other inputs, change nothing
    flipped = labels.withColumn(
        "quality", F.expr("if(crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2, 1 - quality, quality)")
    )
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy")).repartition(7)
    after = {r.doc_id: r.score for r in quality_scores(other, flipped).collect()}
    assert before.keys() == after.keys()
    assert max(abs(before[i] - after[i]) for i in before) < 1e-9
    model = fit_quality(docs, labels)
    again = with_score(docs.withColumn("doc_id", -F.col("doc_id")), model, "s").collect()
    assert max(abs(before[-r.doc_id] - r.s) for r in again) < 1e-9


def test_word_vectors_come_from_all_documents(spark):
    rows = [(i, f"good plain words number {i % 7} again") for i in range(40)] + [(50, None), (None, "without id")]
    rows += [(100 + i, f"never labelled text {i} of its own") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    want = word_table(context_sums((t or "").encode() for _, t in rows))
    for train_rows in (4, 8000):
        assert np.array_equal(fit_quality(docs, labels, train_rows).table, want)


# an independent, plain version of word rows, contexts and pooling


def plain_rows(word: bytes) -> list[int]:
    def mixed(h, k):
        h = (h + k) % 2**64
        h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) % 2**64
        h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) % 2**64
        return (h ^ (h >> 31)) >> 49

    def poly(values):
        h, power = 0, 1
        for v in values:
            h, power = (h + (v + 1) * power) % 2**64, power * 0x9E3779B97F4A7C15 % 2**64
        return h

    kinds = [ord("A") if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else ord("a") if chr(b) in "abcdefghijklmnopqrstuvwxyz" or b > 127
             else ord("0") if chr(b) in "0123456789" else b for b in word]
    shape = [b for i, b in enumerate(kinds) if i == 0 or b != kinds[i - 1]]
    ending = 0
    for i in (1, 2, 3):
        ending = ending * 512 + (word[-i] + 1 if i <= len(word) else 0)
    return [mixed(poly(word), 0), mixed(poly(shape), 1), mixed(ending, 2)]


def plain_vectors(words, table, known={}):
    """A row a word: the sum of the table's rows of its three features."""
    for w in words:
        if w not in known:
            known[w] = plain_rows(w)
    rows = np.array([known[w] for w in words], np.int64).reshape(-1, 3)
    return sum(table.astype(np.int64)[rows[:, k]] for k in range(3)), rows


def plain_sums(texts):
    sums, signs = np.zeros((Q.ROWS, Q.DIMS), np.int64), Q.index_vectors()
    for text in texts:
        own, rows = plain_vectors(text.split(), signs)
        around = np.zeros_like(own)
        for d in (1, 2):
            around[d:] += own[: len(own) - d]
            around[: len(own) - d] += own[d:]
        for k in range(3):
            np.add.at(sums, rows[:, k], around)
    return sums


def plain_features(text, table):
    words = text.split()
    if not words:
        return np.zeros(Q.DIMS + 4 + Q.LAGS)
    vectors, raw = plain_vectors(words, table)[0], plain_vectors(words, Q.index_vectors())[0]
    own, mean = float((raw * raw).sum()), vectors.sum(axis=0) / 1024 / len(words)
    total = raw.sum(axis=0).astype(float)
    repeats = total @ total / len(words) / max(own, 1)
    near = [float((raw[lag:] * raw[: max(0, len(raw) - lag)]).sum()) / max(own, 1) for lag in range(1, Q.LAGS + 1)]
    return np.r_[mean, repeats, np.log(repeats + 1e-4) / 9, np.linalg.norm(mean), np.log1p(len(words)) / 10, near]


def long_texts():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcXY019.,é", k=rng.randint(1, 30))) for _ in range(400)] + ["A1" * 50, "q" * 200]
    whole = " ".join(rng.choices(vocabulary, k=330_000)).encode()
    assert len(whole) > 4 << 20
    word = ("Zz9" * 200_000 + "aé").encode()  # longer than a piece
    return [b"", whole, b" \t", word, b"a " + word + b" \nend of it " + word, b"x\x00y\x1f \x85 \xc2\xa0", b"one", b"a b", whole[:1000] * 3]


def test_contexts_and_pooling_of_long_texts_equal_a_plain_version():
    texts = long_texts()
    for text in texts:
        assert b" ".join(Q.pieces(text)).split() == text.split()
    sums = context_sums(texts)
    assert np.array_equal(sums, plain_sums(texts))
    table = word_table(sums)
    got = Q.Pooler(table).features(texts)
    want = np.array([plain_features(t, table) for t in texts])
    assert np.allclose(got, want, rtol=1e-12, atol=1e-12)
    alone = np.concatenate([Q.Pooler(table).features([t]) for t in texts])
    assert np.array_equal(got, alone)  # to the bit, whatever a text is scored with


@pytest.mark.parametrize("piece,batch", [(16, 5), (64, 40), (1000, 100_000)])
def test_piece_sizes_change_nothing(monkeypatch, piece, batch):
    rng = random.Random(piece)
    texts = [" ".join("".join(rng.choices("abé ", k=rng.randint(1, 60))) for _ in range(n)).encode() for n in (0, 1, 2, 3, 7, 40, 300)]
    sums = context_sums(texts)
    want = Q.Pooler(word_table(sums)).features(texts)
    monkeypatch.setattr(Q, "PIECE_BYTES", piece)
    monkeypatch.setattr(Q, "BATCH_WORDS", batch)
    monkeypatch.setattr(Q, "EXACT_WORDS", 16)
    assert np.array_equal(context_sums(texts), sums)
    assert np.array_equal(Q.Pooler(word_table(sums)).features(texts), want)


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    z, y = rng.normal(size=(20, 6)), (rng.random(20) > 0.4).astype(float)
    params = [rng.normal(size=s) for s in ((6, 4), (4,), (4,), (1,))]
    grads = Q.loss_and_gradients(params, z, y)[1]
    for p, g in zip(params, grads):
        for at in np.ndindex(p.shape):
            keep, losses = p[at], []
            for step in (1e-5, -1e-5):
                p[at] = keep + step
                losses.append(Q.loss_and_gradients(params, z, y)[0])
            p[at] = keep
            assert abs((losses[0] - losses[1]) / 2e-5 - g[at]) < 1e-7


def test_temperature_calibrates():
    rng = np.random.default_rng(2)
    logit = rng.normal(0, 2, 20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-logit))).astype(float)
    for factor in (0.6, 1.0, 3.0, 7.0):  # over- and under-confident by a known factor
        assert abs(Q.best_temperature(logit * factor, y) / factor - 1) < 0.08


def test_sums_are_added_in_levels(spark):
    texts = [(f"some words {i % 3} of task {i}",) for i in range(30)] + [(None,)]
    df = spark.createDataFrame(texts, "text string").select(F.col("text").cast("binary").alias("text")).repartition(23)
    want = context_sums((t or "").encode() for (t,) in texts)
    for fan_in in (2, 4, 128):  # 23 tasks are more than 2 ** 3 and more than one level of 4
        assert np.array_equal(Q.corpus_sums(df, fan_in), want)


def test_tricky_rows_have_scores(spark, tricky, nothing):
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(9)] + [(None, 1, 0), (5, None, 0), (4, 1, 0), (4, 0, 0)], "doc_id bigint, quality int, toxic int"
    )
    rows = quality_scores(tricky, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in tricky.collect())
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (20, 21, 22)}) == 1
    assert quality_scores(nothing, labels).count() == 0


@pytest.mark.parametrize("kept", ["doc_id < 0", "quality = 1"])
def test_without_labels_of_both_classes_all_score_the_same_and_all_stay(spark, tricky, kept):
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id bigint, quality int").where(kept)
    assert {r.score for r in quality_scores(tricky, labels).collect()} == {0.5}
    assert Counter(keep_good(tricky, labels).collect()) == Counter(tricky.collect())


def test_filter_keeps_whole_rows(spark, tricky):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    scores = {r.doc_id: r.score for r in quality_scores(docs, labels).collect()}
    kept = keep_good(docs, labels)
    assert kept.schema == docs.schema
    assert Counter(kept.collect()) == Counter(r for r in docs.collect() if scores[r.doc_id] >= 0.7)


# pipeline


def shingles(text, n=5):
    words = (text or "").encode().lower().split()
    n = min(n, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def test_pipeline_equals_its_stages_by_brute_force(spark):
    from tillandsia.llm._common import Scratch

    scratch, sf_dir = Scratch(spark, "stages"), SF_ORACLE
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs, texts = documents, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if i < 3:
            assert docs.columns == documents.columns
            texts.append({r.doc_id: r.text for r in docs.collect()})
    scores = {r.doc_id: r.score for r in op7_quality(spark, sf_dir).collect()}
    all_texts = {r.doc_id: r.text for r in documents.collect()}
    assert set(texts[0]) == {i for i in all_texts if scores[i] >= 0.7}
    last = {}
    for i, t in texts[0].items():
        key = t.encode().lower()
        last[key] = max(i, last.get(key, i))
    assert set(texts[1]) == set(last.values())
    sets = {i: shingles(t) for i, t in texts[1].items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = Counter()
    for ids in holders.values():
        shared.update((a, b) for a in ids for b in ids if a < b)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert set(texts[2]) == {i for i in sets if find(i) == i}
    packed = {tuple(r) for r in docs.collect()}
    assert {r.doc_id for r in docs.collect()} == set(texts[2])
    assert {tuple(r)[:5] for r in corpus_pipeline.run(spark, sf_dir).collect()} == {r[:5] for r in packed}


def test_entry_registers_the_queries():
    import __spark_entry__ as contract

    names = list(contract.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {x.split("_")[0] + "_" for x in names} and "pipeline" in names
    assert len(corpus_pipeline.STAGES) == 4
