"""Exact, near and embedding deduplication against brute force."""

from __future__ import annotations

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL
from llm_fixtures import nothing, tricky  # noqa: F401
from pyspark.sql import functions as F

from tillandsia.llm import embedding_dedup as E
from tillandsia.llm._common import Scratch, connected_components
from tillandsia.llm.embedding_dedup import embedding_components
from tillandsia.llm.exact_dedup import content_hash, exact_dedup, exact_groups, grace
from tillandsia.llm.minhash_dedup import band_rows, least_matches, minhash_components, near_dedup
from tillandsia.llm.queries import op4_embedding_dedup, op5_minhash_dedup, op8_exact_dedup


def components(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def smallest(ids):
    known = [i for i in ids if i is not None]
    return min(known) if known else None


# exact


def exact_truth(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").encode().lower()].append(i)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        for i in ids:
            out[(i, keep, len(ids), i == keep, hashlib.sha256(text).hexdigest())] += 1
    return out


@pytest.mark.parametrize("budget", [96 << 20, 3000])
def test_exact_groups_of_tricky_rows(tricky, nothing, budget):
    rows = [(r.doc_id, r.text) for r in tricky.collect()]
    assert Counter(map(tuple, exact_groups(tricky, budget=budget).collect())) == exact_truth(rows)
    assert exact_groups(nothing).count() == 0


def test_exact_query_on_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert Counter(map(tuple, op8_exact_dedup(spark, SF_SMALL).collect())) == exact_truth(rows)


@pytest.mark.parametrize("budget", [96 << 20, 3000])
def test_exact_dedup_keeps_one_whole_row_of_each_text(tricky, nothing, budget):
    kept = exact_dedup(tricky, budget=budget)
    assert kept.schema == tricky.schema
    rows = Counter(map(tuple, tricky.collect()))
    got = [tuple(r) for r in kept.collect()]
    assert not Counter(got) - rows
    groups = defaultdict(list)
    for r in rows.elements():
        groups[(r[1] or "").encode().lower()].append(r[0])
    assert len(got) == len(groups)
    for r in got:
        ids = [i for i in groups[(r[1] or "").encode().lower()] if i is not None]
        assert r[0] == (max(ids) if ids else None)
    assert exact_dedup(nothing).count() == 0


def test_grace_spills_until_buckets_fit_and_cleans_up(tmp_path):
    rng = random.Random(1)
    texts = [str(rng.randrange(400)).encode() * rng.randint(1, 50) for _ in range(5000)]
    records = ((content_hash(t), t, 1) for t in texts)
    seen, deepest = Counter(), 0
    for _, t, n in grace(records, lambda a, b: a + b, budget=4000, folder=str(tmp_path)):
        assert t not in seen
        seen[t] = n
        deepest = max(deepest, max((p.count("grace-") for p, _, _ in os.walk(tmp_path)), default=0))
    assert seen == Counter(texts)
    assert deepest >= 2 and not os.listdir(tmp_path)


def test_grace_keeps_contents_with_one_hash_apart(tmp_path):
    texts = [b"a" * 900, b"b" * 900, b"a" * 900, b"c" * 900]
    out = list(grace(((7, t, 1) for t in texts), lambda a, b: a + b, budget=1000, folder=str(tmp_path)))
    assert {(t[:1], n) for _, t, n in out} == {(b"a", 2), (b"b", 1), (b"c", 1)} and len(out) == 3


# near


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    n = min(n, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def near_truth(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    links = []
    for j, b in enumerate(sets):
        for i, a in enumerate(sets[:j]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links.append((i, j))
    roots = components(len(rows), links)
    members = defaultdict(list)
    for (i, _), root in zip(rows, roots):
        members[root].append(i)
    out = Counter()
    for (i, _), s, root in zip(rows, sets, roots):
        head = smallest(members[root])
        out[(i, len(s), head, i == head)] += 1
    return out


@pytest.mark.parametrize("n, percent", [(3, 85), (5, 80)])
def test_near_components_of_tricky_rows(tricky, nothing, n, percent):
    rows = [(r.doc_id, r.text) for r in tricky.collect()]
    got = minhash_components(tricky, n, percent, block_rows=4).drop("text_hash").collect()
    assert Counter(map(tuple, got)) == near_truth(rows, n, percent)
    assert minhash_components(nothing, n, percent).count() == 0


def test_near_query_on_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert Counter(map(tuple, op5_minhash_dedup(spark, SF_SMALL).collect())) == near_truth(rows, 3, 85)


def test_a_large_group_of_near_copies_and_a_chain(spark):
    """Copies that differ from each other more than from their model, and links only by way of others."""
    rng = random.Random(8)
    model = [f"{rng.randrange(5000)}x" for _ in range(150)]
    rows = [(0, " ".join(model))]
    for i in range(1, 150):
        words = list(model)
        for at in rng.sample(range(150), 4):
            words[at] = f"{i}y{at}"
        rows.append((i, " ".join(words)))
    chain = [f"c{k}" for k in range(120)]
    for i in range(40):
        rows.append((1000 + i, " ".join(chain)))
        chain = chain[5:] + [f"d{i}e{k}" for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    got = minhash_components(docs, 3, 85, block_rows=16).drop("text_hash").collect()
    assert Counter(map(tuple, got)) == near_truth(rows, 3, 85)


def test_documents_that_share_buckets_without_linking(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(4000)]
    base = rng.sample(words, 120)
    rows = [(i, " ".join(rng.sample(words, 40))) for i in range(60)]
    # alike enough to meet in a bucket, but under the threshold: no round verifies a link
    rows += [(100 + i, " ".join(base[:100] + rng.sample(words, 30))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = minhash_components(docs, 3, 85, block_rows=4).drop("text_hash").collect()
    assert Counter(map(tuple, got)) == near_truth(rows, 3, 85)
    assert all(r.kept for r in got)
    assert near_dedup(docs).count() == len(rows)


def test_a_bucket_of_very_many_documents_that_do_not_link(spark):
    """Thousands share bands without linking; of a few planted pairs none is lost among them."""
    rng = random.Random(12)
    common = [f"c{i}" for i in range(80)]
    rows = [(i, " ".join(common + [f"u{i}x{k}" for k in range(22)])) for i in range(3000)]
    twins = rng.sample(range(3000), 40)
    # the last word changed: 1 of 100 shingles differs
    rows += [(5000 + i, rows[i][1].rsplit(" ", 1)[0] + " other") for i in twins]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_components(docs, 3, 85, block_rows=32).collect()}
    # any two of the others share 78 of 122 shingles
    assert got == {i: (100, i - 5000 if i >= 5000 else i) for i, _ in rows}


def test_near_dedup_keeps_the_smallest_id_with_all_columns(tricky, nothing):
    rows = [(r.doc_id, r.text) for r in exact_dedup(tricky).collect()]
    docs = exact_dedup(tricky).cache()
    kept = near_dedup(docs)
    assert kept.schema == tricky.schema
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = Counter(i for (i, _, _, keep), n in near_truth(rows, 5, 80).items() if keep for _ in range(n))
    assert Counter(r.doc_id for r in kept.collect()) == want
    docs.unpersist()
    assert near_dedup(nothing).count() == 0


def test_band_and_prune_bounds():
    assert (1 - 0.85 ** band_rows(0.85)) ** (144 // band_rows(0.85)) <= 1e-4
    for n, m in least_matches(0.85, 1e-6):
        assert 0 < m < 0.85 * n


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(500, 600 + i) for i in range(100)] + [(7, 700)]
    links += [(rng.randrange(800, 900), rng.randrange(800, 900)) for _ in range(60)]
    df = spark.createDataFrame([rng.choice([(a, b), (b, a)]) for a, b in links], "a bigint, b bigint")
    got = {(r.node, r.root) for r in connected_components(df, Scratch(spark, "test"), "cc").collect()}
    roots = components(1000, links)
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {(i, roots[i]) for i in nodes}
    none = connected_components(df.where("a < 0"), Scratch(spark, "test"), "cc")
    assert none.count() == 0


# embeddings


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def embedding_truth(rows, threshold):
    n, links, degree = len(rows), [], Counter()
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if usable(v) else None for _, v in rows]
    for j in range(n):
        for i in range(j):
            a, b = unit[i], unit[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= threshold:
                links.append((i, j))
                degree[i] += 1
                degree[j] += 1
    roots = components(n, links)
    members = defaultdict(list)
    for (i, _), root in zip(rows, roots):
        members[root].append(i)
    return Counter(
        (i, degree[k], smallest(members[roots[k]]), i == smallest(members[roots[k]])) for k, (i, _) in enumerate(rows)
    )


def test_embedding_query_on_the_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert Counter(map(tuple, op4_embedding_dedup(spark, SF_SMALL).collect())) == embedding_truth(rows, 0.95)


def test_embeddings_of_tricky_rows(spark):
    """Clusters across cells and blocks, a large group, nulls, zeros, other lengths, repeated rows."""
    rng = np.random.default_rng(4)
    rows, at = [], 0
    for size in (1, 1, 1, 2, 2, 3, 40, 150):
        centre = rng.normal(size=16)
        for _ in range(size):
            rows.append((at, (centre + rng.normal(size=16) * 0.09).tolist()))
            at += 1
    rows += [(1000 + i, rng.normal(size=16).tolist()) for i in range(120)]
    rows += [(2000, rows[5][1]), (2001, rows[5][1]), (None, rows[5][1]), (2000, rows[5][1]), (None, rows[1100 - 1000][1])]
    rows += [(2002, [2 * x for x in rows[5][1]]), (2003, rows[5][1][:8]), (2004, rows[5][1] + [0.0])]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [None] + [1.0] * 15), (3004, [float("nan")] * 16)]
    rows += [(3005, [float("inf")] * 16), (3006, [1e-200] * 16), (3007, [1e-200] * 16), (None, None)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    for name in ("cid", "kept", "v", "block", "copies"):
        df = df.withColumn(name, F.lit("clash"))
    want = embedding_truth([(i, [x * 1e200 for x in v] if v and v[0] == 1e-200 else v) for i, v in rows], 0.95)
    assert Counter(map(tuple, embedding_components(df, 0.95, block_rows=64).collect())) == want
    assert embedding_components(df.where("vec_id < 0")).count() == 0


def test_near_dedup_of_string_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [("10", text), ("9", text + " more"), ("7", "other words than these are kept too"), (None, None), ("8", "")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    kept = near_dedup(docs)
    assert kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["7", "8", "9", "None"]


def test_vectors_of_many_lengths(spark):
    rng = np.random.default_rng(5)
    rows = []
    for size, n in ((8, 200), (3, 40), (1, 12), (500, 6), (300_000, 2)):
        heads = rng.normal(size=(max(1, n // 4), size))
        rows += [(heads[k % len(heads)] + rng.normal(0, 0.08, size)).tolist() for k in range(n)]
    rows = [(int(i), v) for i, v in zip(rng.permutation(len(rows)), rows)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_components(df, 0.95, block_rows=64).collect()}
    links, root = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    units = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    for i, u in units.items():
        for j, w in units.items():
            if i < j and len(u) == len(w) and u @ w >= 0.95:
                links[i], links[j] = links[i] + 1, links[j] + 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert got == {i: (links[i], find(i)) for i in links} and sum(links.values()) > 200


@pytest.mark.parametrize("dims, spread", [(1, 0.5), (3, 0.2), (64, 0.02), (64, 0.05), (65, 1.0), (200, 0.3)])
def test_leading_directions_leave_every_link(monkeypatch, dims, spread):
    """Tight and loose clusters: few pairs of a tile left, all of them, and some."""
    monkeypatch.setattr(E, "TILE", 70)
    rng = np.random.default_rng(dims)
    heads = rng.normal(size=(6, dims))
    x = np.concatenate([heads[rng.integers(0, 6, 300)] + rng.normal(size=(300, dims)) * spread, rng.normal(size=(99, dims))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b = x[::2], x[1::2]
    want = set(zip(*(at.tolist() for at in np.nonzero(a @ b.T >= 0.95))))
    # any orthonormal columns will do, however few vectors they were made from
    for axes in (None, E.leading_directions(x), E.leading_directions(x[:2]), np.eye(dims)[:, :1]):
        got = [(int(i), int(j)) for left, right in E.linked_pairs(a, b, 0.95, axes) for i, j in zip(left, right)]
        assert len(got) == len(set(got)) and set(got) == want


def test_places_bring_each_pair_of_rows_together():
    rng = np.random.default_rng(6)
    home = rng.integers(0, 4, 120)
    visits = (rng.random((120, 4)) < 0.5) & (np.arange(4) > home[:, None])
    visits[np.arange(120), home] = True
    blocks = np.array([[1, 1], [2, 3], [1, 4], [3, 1]])
    first = np.r_[0, np.cumsum(blocks[:, 0] * blocks[:, 1])]
    row, block, role = E.places_of(home, visits, rng.integers(0, 1 << 20, 120), blocks, first)
    met = Counter()
    for k in range(first[-1]):
        here = [(i, r) for i, r in zip(row[block == k].tolist(), role[block == k].tolist())]
        met.update((i, j) for i, r in here if r != E.RESIDENT for j, q in here if q == E.RESIDENT)
    assert met == Counter((i, j) for i in range(120) for j in range(120) if visits[i, home[j]])


def test_embeddings_held_as_floats(spark):
    """Floats are moved as floats and compared in double precision, links at the threshold's edge included."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(40, 24))
    x = np.concatenate([x + rng.normal(size=x.shape) * s for s in (0.0, 0.15, 0.2, 0.25, 0.3)]).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(500, [0.0] * 24), (501, None), (502, [-0.0] * 23 + [1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    got = Counter(map(tuple, embedding_components(df, 0.95, block_rows=64).collect()))
    assert got == embedding_truth(rows, 0.95)
    assert sum(n * c for (_, n, _, _), c in got.items()) > 100
