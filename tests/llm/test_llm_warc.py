"""WARC writing and the splittable reader."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os
import random
import zlib
from collections import Counter
from urllib.parse import unquote

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tillandsia.llm.queries import op1_warc
from tillandsia.llm.warc import archives_in, read_warc, record_member, scan_range, write_warc


def digest(text: str | None) -> str:
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def truth(rows):
    first = {}
    for i, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = Counter()
    for i, html in rows:
        head = first.get(html or "")
        again = head is not None and i != head
        out[(i, len((html or "").encode()), digest(html), "revisit" if again else "response", head if again else None)] += 1
    return out


TRICKY = [
    (5, "http://a.example/é?q=1 2%", "<p>one</p>"),
    (3, None, "<p>one</p>"),
    (3, "http://b", "<p>one</p>"),
    (None, "http://c", "<p>one</p>"),
    (7, "http://d\r\nX: y", None),
    (8, "", ""),
    (9, "http://e", "long é " * 100_000),
    (10, "http://f", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (None, "http://g", "only without id"),
    (None, None, "only without id"),
] + [(100 + i, f"http://h/{i}", f"page {i % 150} " * (i % 7)) for i in range(400)]


@pytest.fixture
def pages(spark):
    df = spark.createDataFrame(TRICKY, "page_id bigint, url string, html string").repartition(4)
    for name in ("digest", "payload", "n", "path", "refers_to"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def picked(df):
    return Counter(
        map(
            tuple,
            df.select(F.col("page_id").cast("bigint"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint")).collect(),
        )
    )


@pytest.mark.parametrize("split_bytes", [64, 1000, 1 << 25])
def test_every_split_size_reads_each_record_once(spark, pages, tmp_path, split_bytes):
    folder = f"file://{tmp_path}/warc"
    manifest = write_warc(pages, folder, roll_bytes=2000).cache()
    assert manifest.agg(F.sum("records")).first()[0] == len(TRICKY)
    archives = archives_in(spark, folder)
    assert sorted(r["size"] for r in manifest.collect()) == sorted(r["size"] for r in archives.collect())
    assert archives.count() > 8
    back = read_warc(archives, split_bytes)
    assert picked(back) == truth([(i, h) for i, _, h in TRICKY])
    payloads = {r.page_id: r.payload for r in back.where("record_type = 'response'").collect()}
    assert bytes(payloads["9"]).decode() == TRICKY[6][2] and bytes(payloads["7"]) == b""
    urls = Counter((int(r.page_id) if r.page_id else None, r.url) for r in back.collect())
    assert urls == Counter((i, u) for i, u, _ in TRICKY)
    manifest.unpersist()


def test_archives_are_plain_gzip_of_warc_records(spark, pages, tmp_path):
    write_warc(pages, f"file://{tmp_path}/warc").collect()
    files = sorted(p for p in os.listdir(tmp_path / "warc") if p.endswith(".warc.gz"))
    text = b"".join(gzip.open(tmp_path / "warc" / p).read() for p in files)
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(TRICKY) + 1  # one payload holds such a header
    assert b"X: y\r\n" not in text


def test_query_on_the_whole_table(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    assert Counter(map(tuple, op1_warc(spark, SF_SMALL).collect())) == truth(rows)


def test_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    archives = write_warc(empty, f"file://{tmp_path}/warc")
    assert read_warc(archives).count() == 0


class File(io.BytesIO):
    def read_at(self, n, at):
        return self.getvalue()[at : at + n]


def scanned(data: bytes, start: int, end: int):
    return [(f["x-page-id"], at) for f, _, at in scan_range(File(data), len(data), start, end)]


def test_false_magic_is_passed_over():
    member = record_member("1", "u", b"x" * 50, None)
    other = zlib.compressobj(6, zlib.DEFLATED, 31)
    other = other.compress(b"not a record") + other.flush()
    noise = b"\x1f\x8b\x08" + b"\x1f\x8b\x08\x00 noise"
    data = noise + other + member + noise + member
    found = scanned(data, 0, len(data))
    assert [at for _, at in found] == [len(noise + other), len(noise + other + member + noise)]
    # every cut point gives each record to exactly one side
    for cut in range(0, len(data), 7):
        assert scanned(data, 0, cut) + scanned(data, cut, len(data)) == found


def test_damaged_records_raise():
    member = record_member("1", "u", bytes(range(256)) * 400, None)
    with pytest.raises(ValueError, match="cut off"):
        scanned(member[: len(member) // 2], 0, len(member) // 2)
    broken = bytearray(member)
    broken[-6] ^= 255
    with pytest.raises(ValueError, match="damaged"):
        scanned(bytes(broken), 0, len(broken))


def test_headers_of_any_length_are_read():
    rng = random.Random(4)
    url = "http://x/" + "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(350_000))
    data = record_member("1", url, b"one", None) + record_member("2", "u", b"two", None)
    (fields, block, _), (other, _, _) = scan_range(File(data), len(data), 0, len(data))
    assert unquote(fields["warc-target-uri"]) == url and block.endswith(b"one")
    assert other["x-page-id"] == "2"


@pytest.mark.parametrize(
    "header, match", [(b"WARC/1.1\r\nWARC-Type: response\r\n\r\n", "Content-Length"), (b"WARC/1.1\r\nWARC-Type: resp", "does not end")]
)
def test_records_without_a_whole_header_raise(header, match):
    data = gzip.compress(header)
    with pytest.raises(ValueError, match=match):
        scanned(data, 0, len(data))


def test_record_ids_are_unique_and_referred_to(spark, tmp_path):
    rows = [(3, "u", "same"), (3, "u", "same"), (3, "v", "same"), (3, "u", "other"), (9, "u", "same"), (9, "u", "same")]
    rows += [(None, "u", "same"), (None, "u", "same"), (None, None, None), (None, None, None), (4, "x:y", ""), (5, "z", None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    found = write_warc(df, f"file://{tmp_path}/w").collect()
    ids, refers = [], []
    for r in found:
        data = open(r.path.removeprefix("file://"), "rb").read()
        for fields, _, _ in scan_range(BytesFile(data), len(data), 0, len(data)):
            ids.append(fields["warc-record-id"])
            refers.append(fields.get("warc-refers-to"))
    assert len(ids) == len(set(ids)) == len(rows)
    assert {r for r in refers if r} <= set(ids) and sum(r is not None for r in refers) == 7


class BytesFile:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at : at + n]
