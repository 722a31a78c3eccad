"""Token counts, encoding and packing against the tokenizer libraries."""

from __future__ import annotations

import base64
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import nothing, tricky  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillandsia.llm.bpe_codec import bpe_decode, bpe_round_trip, load_encoding, safe_parts
from tillandsia.llm.packing import pack_documents, pack_histogram
from tillandsia.llm.queries import SPECIAL, op2_token_counts, op9_bpe_codec, op10_packing
from tillandsia.llm.token_counts import MergeTable, token_counts

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("test", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def table(spark, name="documents"):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/{name}.parquet").collect()]


def test_counts_equal_the_library_on_the_whole_table(spark, library):
    docs = table(spark)
    want = [(i, len(t.encode()), len(x), len(x) > 1024) for (i, t), x in zip(docs, ids_of(library, [t for _, t in docs]))]
    assert sorted(map(tuple, op2_token_counts(spark, SF_SMALL).collect())) == sorted(want)


def test_counts_of_tricky_rows(spark, tricky, nothing, library):
    docs = [(r.doc_id, r.text) for r in tricky.collect()]
    want = Counter(
        (i, len((t or "").encode()), len(x), len(x) > 50) for (i, t), x in zip(docs, ids_of(library, [t for _, t in docs]))
    )
    assert Counter(map(tuple, token_counts(tricky, JSON, P.PATTERN, limit=50).collect())) == want
    assert token_counts(nothing, JSON, P.PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aabehnt 'sé\n漢🙂1²́\x1c\x85"), max_size=60), min_size=1, max_size=8))
def test_merging_equals_the_library_for_any_texts(texts):
    import regex

    merges, library = _cached()
    words = [regex.findall(P.PATTERN, t) for t in texts]
    flat = [w.encode() for ws in words for w in ws]
    counts = iter(merges.count(flat).tolist() if flat else [])
    assert [sum(next(counts) for _ in ws) for ws in words] == [len(x) for x in ids_of(library, texts)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abent", min_size=1, max_size=300), min_size=1, max_size=6))
def test_merging_long_words_equals_merging_short_ones(words):
    merges, _ = _cached()
    raw = [w.encode() for w in words] + [b"a" * 257, b"ab" * 200]
    assert merges.count_long(raw).tolist() == merges.count_short(raw).tolist() == merges.count(raw).tolist()


@pytest.mark.parametrize("alphabet", ["abcdefghijklmnopqrstuvwxyz", "ab", "a", "é漢x"])
def test_one_unbroken_run_of_a_megabyte(spark, library, alphabet):
    rng = random.Random(3)
    text = "".join(rng.choices(alphabet, k=1_000_000 // len(alphabet[0].encode())))
    docs = spark.createDataFrame([(1, text), (2, text[:70_000] + " " + text[:300])], "doc_id bigint, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts(docs, JSON, P.PATTERN).collect()}
    assert got == {r.doc_id: len(ids_of(library, [r.text])[0]) for r in docs.collect()}


_CACHE: list = []


def _cached():
    if not _CACHE:
        _CACHE.extend([MergeTable(JSON), Tokenizer.from_file(JSON)])
    return _CACHE


def test_merging_a_long_run_of_letters():
    merges, library = _cached()
    rng = random.Random(3)
    for text in ("a" * 5001, "ab" * 2500, "".join(rng.choices("abcdefgh", k=20_000))):
        assert merges.count([text.encode()]).tolist() == [len(library.encode(text).ids)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab  \n\t'sé1!漢\x85　"), max_size=200))
def test_splitting_long_texts_keeps_their_ids(text):
    encoding = load_encoding(RANKS, P.PATTERN)
    parts = list(safe_parts(text, P.PATTERN, 8))
    assert "".join(parts) == text
    assert [i for p in parts for i in encoding.encode_ordinary(p)] == encoding.encode_ordinary(text)


def test_a_long_run_without_white_space_is_split_at_matches():
    parts = list(safe_parts("ab1!" * 5000, P.PATTERN, 1000))
    assert len(parts) > 15 and max(map(len, parts)) < 1100
    assert list(safe_parts("a" * 5000, P.PATTERN, 1000)) == ["a" * 5000]


@pytest.mark.parametrize("chunk_chars", [8, 1 << 16])
@pytest.mark.parametrize("space", ["\n", "\t", " \n"])
def test_a_run_of_white_space_that_ends_with_the_window_keeps_its_ids(encoding, chunk_chars, space):
    for n in range(chunk_chars - 2, chunk_chars + 3):
        text = (space * n)[:n] + "x tail"
        parts = list(safe_parts(text, P.PATTERN, chunk_chars))
        assert "".join(parts) == text
        assert [i for p in parts for i in encoding.encode_ordinary(p)] == encoding.encode_ordinary(text)


def test_round_trip_of_the_whole_table(spark, encoding):
    import hashlib

    want = []
    for i, t in table(spark):
        ids = encoding.encode_ordinary(t)
        text = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((i, len(ids), text, hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, op9_bpe_codec(spark, SF_SMALL).collect())) == sorted(want)


def test_round_trip_of_tricky_rows(spark, tricky, nothing, encoding):
    out = bpe_round_trip(tricky, RANKS, P.PATTERN, chunk_chars=64)
    got = Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in out.collect())
    want = Counter(
        (r.doc_id, tuple(encoding.encode_ordinary(r.text or "")), (r.text or "").encode()) for r in tricky.collect()
    )
    assert got == want
    again = bpe_decode(out.select("doc_id", "ids"), RANKS, P.PATTERN).collect()
    assert Counter((r.doc_id, bytes(r.decoded)) for r in again) == Counter((i, d) for i, _, d in want.elements())
    assert bpe_round_trip(nothing, RANKS, P.PATTERN).count() == 0


def test_decoding_ids_that_cut_through_a_character(spark, encoding):
    ids = encoding.encode_ordinary("漢字🙂")[:1]
    df = spark.createDataFrame([(1, ids), (2, None)], "doc_id bigint, ids array<int>")
    got = {r.doc_id: bytes(r.decoded) for r in bpe_decode(df, RANKS, P.PATTERN).collect()}
    assert got == {1: encoding.decode_bytes(ids), 2: b""}


def check_pieces(pieces, ids_by_row, length):
    """Each id in one piece, pieces gapless in their documents and sequences; returns the fill."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for spans in by_sequence.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= length
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for doc, ids in ids_by_row.items():
        at = 0
        for p in sorted(by_doc.pop(doc), key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    assert not by_doc
    return sum(map(len, ids_by_row.values())) / length / len(by_sequence)


def test_packing_the_whole_table(spark, library):
    docs = table(spark)
    ids = {i: x + [1] for (i, _), x in zip(docs, ids_of(library, [t for _, t in docs]))}
    assert check_pieces(op10_packing(spark, SF_SMALL).collect(), ids, 2048) > 0.95


def test_packing_tricky_rows(spark, tricky, nothing, library):
    numbered = tricky.withColumn("doc_id", F.monotonically_increasing_id()).cache()
    docs = [(r.doc_id, r.text) for r in numbered.collect()]
    ids = {i: x + [1] for (i, _), x in zip(docs, ids_of(library, [t for _, t in docs]))}
    out = pack_documents(numbered, RANKS, P.PATTERN, SPECIAL, length=256, with_ids=True).collect()
    assert check_pieces(out, ids, 256) > 0.95
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in out)
    numbered.unpersist()
    # null and repeated ids are documents of their own
    total = pack_documents(tricky, RANKS, P.PATTERN, SPECIAL).agg(F.sum("length")).first()[0]
    assert total == sum(map(len, ids.values()))
    assert pack_documents(nothing, RANKS, P.PATTERN, SPECIAL).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=20))
def test_packs_hold_every_piece_once(histogram):
    packs = pack_histogram(histogram, 64)
    used = Counter()
    for count, lengths in packs:
        assert count > 0 and sum(lengths) <= 64
        for n in lengths:
            used[n] += count
    assert used == Counter(histogram)
