"""Phrases against counting by definition."""

from __future__ import annotations

import pickle
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_ORACLE, duckdb_with_views
from llm_fixtures import tricky_texts

from tillandsia.llm import phrase_mining as M
from tillandsia.llm.phrase_mining import phrases
from tillandsia.llm.queries import ORACLES, op11_phrases


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def pieces_of(text):
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n-\r]", lowered(text))]


def counted(rows, longest):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        for words in pieces_of(text):
            totals[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    counts[lang or "und", tuple(words[i : i + m])] += 1
    return counts, totals


def plain(rows, least, longest, top, percent):
    counts, totals = counted([(l if l is not None else "und", t) for l, t in rows], longest)
    candidates = {k: a for k, a in counts.items() if a >= least and len(k[1]) > 1}
    dropped = set()
    for (lang, p), f in candidates.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                if 100 * f >= percent * counts[lang, p[i : i + m]]:
                    dropped.add((lang, p[i : i + m]))
    best = defaultdict(list)
    for (lang, p), a in candidates.items():
        if (lang, p) in dropped:
            continue
        cuts = [(counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p))]
        scores = [1000 * a * totals[lang] // (l * r) for l, r in cuts]
        k = scores.index(min(scores))
        best[lang].append((-scores[k], -a, " ".join(p).encode(), *cuts[k]))
    out = set()
    for lang, found in best.items():
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, p.decode(), -a, l, r, totals[lang], -s))
    return out


def sample_rows(seed=2):
    rng = random.Random(seed)
    words = ["a", "b", "A", "c\x01", "c", "é", "É", "漢", "x" * 300, "the", "of"]
    rows = []
    for i in range(60):
        text = "".join(rng.choices(words, k=1)[0] + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ! "]) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "de", None, "und"]), text))
    rows += [("en", "of the a b c of the a b c " * 40), ("en", "the " * 300), ("fr", None), (None, ""), ("fr", "one two"), ("x", " . ")]
    rows += [("zz", t) for _, t in tricky_texts()[:30]] + [("zz", "é a"), ("yy", "\x00 \x1f\x85 \x00 \x1f\x85 " * 3)]
    return rows


@pytest.fixture(scope="module")
def sample(spark):
    rows = [(i, lang, text, "clash", 1, 2) for i, (lang, text) in enumerate(sample_rows())]
    return spark.createDataFrame(rows, "doc_id bigint, lang string, text string, phrase string, a int, score int").repartition(5)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize(
    "least,longest,top,percent,group,bits,pairs",
    [(3, 5, 2000, 100, 1 << 20, 26, 20), (2, 5, 7, 100, 8, 4, 5), (3, 4, 50, 60, 40, 26, 27), (5, 2, 2000, 100, 1, 12, 14)],
)
def test_phrases_equal_counting_by_definition(spark, sample, least, longest, top, percent, group, bits, pairs):
    got = phrases(sample, least, longest, top, percent, group_suffixes=group, bitmap_bits=bits, pair_bits=pairs)
    assert got.columns == list(COLUMNS)
    rows = [tuple(r) for r in got.collect()]
    want = plain([(lang, t) for lang, t in sample_rows()], least, longest, top, percent)
    assert len(rows) == len(set(rows)) and set(rows) == want and len(want) > 5


def test_without_candidates(spark, sample):
    assert phrases(sample.limit(0), 2).collect() == []
    assert phrases(sample, 10_000).collect() == []


def test_whole_table_equals_sql(spark):
    con = duckdb_with_views(SF_ORACLE)
    want = con.execute(ORACLES["op11_phrases"])
    names = [d[0] for d in want.description]
    rows = op11_phrases(spark, SF_ORACLE).collect()
    assert sorted(tuple(r[n] for n in names) for r in rows) == sorted(want.fetchall()) and len(rows) > 20


# the tasks' functions themselves, with small batches


def batch(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[0] or "und" for r in rows]), pa.array([(r[1] or "").encode() for r in rows])], names=["lang", "text"])


def everything(bits=10):
    return M.Bitmap(np.full(max(1, 1 << bits >> 3), 255, np.uint8), bits)


def members(keys, bits=20):
    """A bitmap of the prefixes in ``keys``, made as the tasks make it."""
    cells = [int(M._cells(k, bits)[0]) for k in keys]
    m = M.Bitmap(np.zeros(1 << bits >> 3, np.uint8), bits)
    for c in cells:
        m.data[c >> 3] |= 1 << (c & 7)
    return m


def key_of(lang, *words):
    key = M._begin(M._lang_hashes([lang]))
    for w in words:
        key = M._extend(key, M.word_hashes([w.encode()], 2))
    return key


@pytest.mark.parametrize("batch_words,split", [(1 << 21, 4 << 20), (50, 30), (7, 1)])
def test_groups_hold_every_suffix_once(monkeypatch, batch_words, split):
    monkeypatch.setattr(M, "BATCH_WORDS", batch_words)
    monkeypatch.setattr(M, "SPLIT_BYTES", split)
    monkeypatch.setattr(M, "COUNT_WORDS", 10 if batch_words < 100 else 1 << 20)
    rows = sample_rows()
    want, totals = counted([(l if l is not None else "und", t) for l, t in rows], 5)
    word_of = {int(M.word_hashes([w.encode()], 2)[0]): w for (_, p) in want for w in p}
    # words
    got, n = Counter(), Counter()
    for out in M._counts(2)(iter([batch(rows)])):
        for lang, h, word, k in zip(*(c.to_pylist() for c in out.columns)):
            if h is None:
                n[lang] += k
            else:
                got[lang, (word,)] += k
                assert word_of[h] == word
    assert got == {k: v for k, v in want.items() if len(k[1]) == 1} and +n == +totals
    # prefixes "the" and "the the" of "en" are extended
    heavy = [members([key_of("en", "the")]), members([key_of("en", "the", "the")])]
    for level, prefix in ((1, ("the",)), (2, ("the", "the"))):
        got = Counter()
        for out in M._prefix_counts(2, [everything(), everything(7)], heavy[:level], 5)(iter([batch(rows)])):
            for lang, words, k in zip(*(c.to_pylist() for c in out.columns)):
                got[lang, tuple(word_of[h] for h in words)] += k
        assert got == {k: v for k, v in want.items() if k[0] == "en" and k[1][:level] == prefix and len(k[1]) == level + 1}
    tables = defaultdict(list)
    for out in M._deal(2, [everything(), everything(7)], heavy, 6, 5)(iter([batch(rows)])):
        for lang, grp, blob in zip(*(c.to_pylist() for c in out.columns)):
            tables[lang, grp].append(blob)
    got = Counter()
    for (lang, grp), blobs in tables.items():
        out = M._grow(2)(pa.table({"lang": [lang] * len(blobs), "grp": [grp] * len(blobs), "blob": blobs}))
        for lang, words, f in zip(*(c.to_pylist() for c in out.columns)):
            key = lang, tuple(word_of[h] for h in words)
            assert key not in got
            got[key] = f
    counted_before = {("en", p) for lang, p in want if lang == "en" and (p[:1] == ("the",) and len(p) == 2 or p[:2] == ("the", "the") and len(p) == 3)}
    assert got == {k: v for k, v in want.items() if len(k[1]) > 1 and v >= 2 and k not in counted_before}


@pytest.mark.parametrize("bits,fan_in,least", [(20, 2, 3), (12, 128, 3), (9, 3, 1), (5, 2, 40)])
def test_frequent_pairs_are_all_kept(spark, bits, fan_in, least):
    rows = [(l if l is not None else "und", (t or "").encode()) for l, t in sample_rows()]
    docs = spark.createDataFrame(rows, "lang string, text binary").repartition(11)
    bitmap = M.frequent_pairs(docs, 2, everything(), least, bits, fan_in)
    counts = counted([(l, t.decode()) for l, t in rows], 2)[0]
    pairs = {k: v for k, v in counts.items() if len(k[1]) == 2}
    cells = Counter()
    for (lang, words), n in pairs.items():
        cells[int(M._cells(key_of(lang, *words), bits)[0])] += n
    for (lang, words), n in pairs.items():
        key = key_of(lang, *words)
        assert bitmap.has(key)[0] == (cells[int(M._cells(key, bits)[0])] >= least)


def test_bitmaps_never_miss(spark):
    rng = np.random.default_rng(1)
    rows = [("en" if i % 2 else "de", rng.integers(-(2**63), 2**63 - 1, int(rng.integers(1, 5))).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "lang string, words array<bigint>").repartition(4)
    for bits in (2, 16, 22):
        bitmap = M.bitmap_of(df, bits)
        hits = 0
        for lang, words in rows:
            key, other = M._begin(M._lang_hashes([lang])), M._begin(M._lang_hashes(["fr"]))
            for w in words:
                key, other = (M._extend(k, np.array([w])) for k in (key, other))
            assert bitmap.has(key)[0]
            hits += bool(bitmap.has(other)[0])
        assert bits < 22 or hits < 30
    assert not M.bitmap_of(df.limit(0), 8).has(key_of("en", "a")).any()


def test_subtrees_from_many_small_parts(monkeypatch):
    """Bitmaps arrive in tasks as they left; parts with dictionaries of their own give the counts of all texts."""
    for name, value in (("HELD_HASHES", 3), ("BATCH_WORDS", 40), ("SLICE_ROWS", 2)):
        monkeypatch.setattr(M, name, value)
    rng = np.random.default_rng(8)
    texts = [" ".join("w%d" % w for w in rng.integers(0, 6, n)) for n in (0, 1, 90, 7, 300, 2, 33)]
    data = rng.integers(0, 256, 1 << 10).astype(np.uint8)
    some = pickle.loads(pickle.dumps(M.Bitmap(data, 13)))
    assert some.bits == 13 and np.array_equal(some.data, data)
    full = pickle.loads(pickle.dumps(M.Bitmap(np.full(1 << 10, 255, np.uint8), 13)))
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": [t.encode() for t in texts]})
    parts = pa.Table.from_batches(list(M._deal(2, [full, full], [], 1, 3)(iter([batch]))))
    assert parts.num_rows > 2
    grown = M._grow(4)(parts)
    want = Counter()
    for t in texts:
        words = t.encode().split()
        for n in (2, 3):
            want.update(tuple(M.word_hashes(words[i : i + n], 2).tolist()) for i in range(len(words) - n + 1))
    got = {tuple(r["words"]): r["f"] for r in grown.to_pylist()}
    assert got == {k: n for k, n in want.items() if n >= 4} and got
