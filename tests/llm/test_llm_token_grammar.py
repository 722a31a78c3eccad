"""Token files: grammars round-trip, ids equal the library's, ranges equal slices."""

from __future__ import annotations

import json
import os
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import nothing, tricky  # noqa: F401
from tokenizers import Tokenizer

from tillandsia.llm import token_grammar as T
from tillandsia.llm.queries import op13_token_grammar
from tillandsia.llm.token_grammar import read_token_files, write_token_files

JSON = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


def expected(rows, library):
    """``(doc_id, n_tokens, ids_crc32)`` of each row, by the library alone."""
    out = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


def check_order(rows, want):
    """Rows are gapless in ascending order of ids, nulls last, and hold what ``want`` says."""
    rows = sorted(map(tuple, rows), key=lambda r: r[1])
    at, ids = 0, []
    for doc_id, start, n, _ in rows:
        assert start == at
        at += n
        ids.append((doc_id is None, doc_id or 0))
    assert ids == sorted(ids)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r[0], r[2], r[3]) for r in rows), key=key) == sorted(want, key=key)


def test_whole_table_equals_the_library(spark, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check_order(op13_token_grammar(spark, SF_SMALL).collect(), expected(docs, library))


@pytest.mark.parametrize("file_tokens,pattern", [(1000, None), (1 << 26, P.PATTERN)])
def test_tricky_rows(spark, tricky, nothing, library, tmp_path, file_tokens, pattern):
    files = write_token_files(tricky, f"file://{tmp_path}/x", JSON, pattern, file_tokens=file_tokens)
    manifest = spark.createDataFrame(files.collect(), files.schema)
    rows = read_token_files(manifest, with_ids=True).collect()
    docs = [(r.doc_id, r.text) for r in tricky.select("doc_id", "text").collect()]
    check_order([r[:4] for r in rows], expected(docs, library))
    for r in rows:
        assert len(r.ids) == 4 * r.n_tokens and zlib.crc32(r.ids) == r.ids_crc32
    assert (manifest.count() > 1) == (file_tokens == 1000)
    # other files in the folder, such as those of failed attempts, are not read
    (tmp_path / "x" / "part-000000-0000-999.rpg").write_bytes(b"half a file")
    assert read_token_files(manifest).count() == len(docs)
    empty = write_token_files(nothing, f"file://{tmp_path}/y", JSON)
    assert read_token_files(spark.createDataFrame(empty.collect(), empty.schema)).count() == 0


def test_first_tokens_over_several_groups_of_files(spark, tricky, library, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "GROUP_FILES", 3)
    monkeypatch.setattr(T, "BLOCK_TOKENS", 500)
    files = write_token_files(tricky, f"file://{tmp_path}/x", JSON, file_tokens=800)
    manifest = spark.createDataFrame(files.collect(), files.schema)
    assert manifest.select("part").distinct().count() > 6
    docs = [(r.doc_id, r.text) for r in tricky.select("doc_id", "text").collect()]
    check_order(read_token_files(manifest).collect(), expected(docs, library))


# one segment each at the places where the pre-splitting pattern is delicate
ALPHABET = st.sampled_from("aab1 '.!\n\t\x0b\x1c\x1d\x85\xa0 　é漢🙂st<|")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), max_size=6))
def test_segments_give_the_ids_of_whole_texts(texts):
    texts = [*texts, "x<|endoftext|> <|endoftext|>\n y", "a \n  b", "\x1c!\x1c a"]
    *encoders, library = _cached()
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for encoder in encoders:
        ids, places = encoder.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(places, places[1:])] == want


def test_special_strings_in_long_texts():
    *encoders, library = _cached()
    rng = random.Random(8)
    texts = []
    for n in (70_000, 140_000):
        words = ["".join(rng.choices("abc ", k=7)) for _ in range(n // 8)]
        for at in (0, len(words) // 2, len(words) - 1):
            words[at] = rng.choice(["<|endoftext|>", "x<|endoftext|>", " <|endoftext|> ", "<|endoftext|"])
        texts.append("\n".join(words))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for encoder in encoders:
        ids, places = encoder.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(places, places[1:])] == want


_CACHE: list = []


def _cached():
    if not _CACHE:
        _CACHE.extend([T.Encoder(JSON), T.RankEncoder(JSON, P.PATTERN), Tokenizer.from_file(JSON)])
    return _CACHE


def test_encoder_forgets_when_its_cache_is_full(monkeypatch, library):
    monkeypatch.setattr(T, "CACHE_CHARS", 300)
    encoder, rng = T.Encoder(JSON), random.Random(1)
    for _ in range(20):
        texts = [" ".join("".join(rng.choices("abc", k=6)) for _ in range(30)) for _ in range(4)]
        ids, places = encoder.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(places, places[1:])] == [
            e.ids for e in library.encode_batch(texts, add_special_tokens=False)
        ]
        assert encoder.bytes <= 300 + 4 * 30 * 8


def test_other_kinds_of_tokenizers_are_refused(tmp_path, library):
    from tokenizers import normalizers, pre_tokenizers

    for change in ("pre_tokenizer", "normalizer"):
        other = Tokenizer.from_file(JSON)
        if change == "pre_tokenizer":
            other.pre_tokenizer = pre_tokenizers.Whitespace()
        else:
            other.normalizer = normalizers.Lowercase()
        other.save(str(tmp_path / "t.json"))
        with pytest.raises(ValueError):
            T.Encoder(str(tmp_path / "t.json"))
    spec = json.load(open(JSON))
    spec["model"]["merges"][300:302] = spec["model"]["merges"][300:302][::-1]
    (tmp_path / "t.json").write_text(json.dumps(spec))
    T.Encoder(str(tmp_path / "t.json"))
    with pytest.raises(ValueError):
        T.RankEncoder(str(tmp_path / "t.json"), P.PATTERN)


# grammars


def repetitive(rng, n, kinds=12):
    words = [rng.integers(0, kinds, rng.integers(1, 9)) for _ in range(6)]
    out = np.concatenate([np.empty(0), *(words[rng.integers(0, 6)] for _ in range(n))])
    return out.astype(np.uint32)


@pytest.mark.parametrize("seed", range(8))
def test_grammars_round_trip(seed):
    rng = np.random.default_rng(seed)
    ids = [repetitive(rng, 2000), np.full(999, 7, np.uint32), rng.integers(0, 2**32 - 5000, 500).astype(np.uint32)][seed % 3]
    ends = np.unique(rng.integers(1, len(ids) + 1, 5 if seed % 2 else 60))
    g = T.compress(ids, ends)
    assert np.array_equal(g.expand(g.symbols), ids)
    again = T.read_block(T.block_bytes(g))
    for name in ("rules", "lengths", "symbols"):
        assert np.array_equal(getattr(again, name), getattr(g, name))
    # lengths are those of the rules' expansions
    for k, n in enumerate(g.lengths.tolist()):
        assert len(g.expand(np.array([g.first + k]))) == n
    # documents begin and end between symbols
    assert set(ends.tolist()) <= set(np.cumsum(g.sizes()).tolist()) | {0}
    for _ in range(50):
        a, b = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
        assert np.array_equal(again.tokens(a, b), ids[a:b])
    if seed % 3 < 2:
        assert len(g.symbols) + 2 * len(g.rules) < 0.6 * len(ids) and len(g.rules)
    else:
        assert not len(g.rules)  # no pair is frequent


def test_first_round_replaces_the_most_frequent_pair():
    ids = np.tile(np.array([1, 2, 3], np.uint32), 40)
    ids = np.concatenate([ids, np.tile(np.array([2, 3, 9], np.uint32), 30)])
    at, rule, pairs = T._chosen_pairs(ids[:-1].astype(np.uint64) << np.uint64(32) | ids[1:], np.ones(len(ids) - 1, bool), 16)
    assert pairs[0] == 2 << 32 | 3  # 70 times
    assert set(at[rule == 0].tolist()) == {i for i in range(len(ids) - 1) if ids[i] == 2 and ids[i + 1] == 3}
    assert (np.diff(np.sort(at)) >= 2).all()  # none overlap


@pytest.mark.parametrize("ids", [[], [5], [2], [0, 0], list(range(40))])
def test_small_grammars(ids):
    ids = np.array(ids, np.uint32)
    g = T.read_block(T.block_bytes(T.compress(ids, np.array([len(ids)]))))
    assert np.array_equal(g.expand(g.symbols), ids)


def test_files_hold_documents_across_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_TOKENS", 1000)
    rng, path = np.random.default_rng(3), str(tmp_path / "f")
    docs = [(i if i % 5 else None, repetitive(rng, int(n))) for i, n in enumerate([1, 300, 0, 2000, 5, 0, 1, 400])]
    docs = [(i, d if k != 2 else d[:0]) for k, (i, d) in enumerate(docs)]
    store = pafs.LocalFileSystem()
    writer = T.FileWriter(store.open_output_stream(path))
    for i, ids in docs:
        writer.add(i, ids)
    assert writer.close() == os.path.getsize(path)
    with store.open_input_file(path) as f:
        reader = T.FileReader(f)
        assert len(reader.places) - 1 > 5
        got = [(i, start, np.concatenate([np.empty(0, np.uint32), *parts])) for i, start, parts in reader.documents()]
        whole = np.concatenate([d for _, d in docs])
        assert [(i, ids.tolist()) for i, _, ids in got] == [(i, d.tolist()) for i, d in docs]
        for i, start, ids in got:
            assert np.array_equal(reader.range(start, len(ids)), ids)
        for _ in range(40):
            a, b = sorted(rng.integers(0, len(whole) + 1, 2).tolist())
            assert np.array_equal(reader.range(a, b - a), whole[a:b])
    data = open(path, "rb").read()
    for bad in (b"", data[:-1]):
        with pytest.raises(ValueError):
            T.FileReader(pa.BufferReader(bad))
    with pytest.raises(ValueError):
        T.read_block(data[:100])
