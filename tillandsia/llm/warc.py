"""WARC archives: a writer, and a splittable reader of gzip-compressed archives.

The writer gives every record its own gzip member. The reader cuts archives
into byte ranges, one row each, that tasks scan on their own: a task looks for
the gzip magic in its range, decodes what follows, takes it for a record only
if a WARC header comes out, and owns the records that start inside its range,
reading past the end of the range to finish the last one. Nothing needs an
index or a whole archive in memory.

Archives are opened by URI with ``pyarrow.fs`` in the tasks, so the folder may
be any store that it knows (file, hdfs, s3, gs); Spark itself reads the pages.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the formats.
GZIP_MAGIC = b"\x1f\x8b\x08"
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Date of the records, unless the caller gives one: archives of equal pages are equal.
DATE = "1970-01-01T00:00:00Z"
#: Compressed bytes after which a task begins a new archive.
ROLL_BYTES = 256 << 20
#: Compressed bytes a reading task scans.
SPLIT_BYTES = 32 << 20
#: Bytes read from a store at a time, and bytes given to the decoder at a time.
WINDOW, STEP = 1 << 20, 1 << 13

READ_SCHEMA = (
    "page_id string, url string, record_type string, payload_bytes bigint, "
    "payload_digest string, refers_to string, payload binary"
)


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: str | None, digest: str, nth: int = 0) -> str:
    name = "null" if page_id is None else "page:" + quote(page_id, safe="")
    return f"<urn:x-{name}:{digest}{f':{nth}' if nth else ''}>"


def record_member(
    page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str = DATE, nth: int = 0
) -> bytes:
    """One record as one gzip member; ``refers_to`` (a page id) makes it a revisit.

    A record's id is made of the page's id, the payload's digest and, for
    rows that repeat both, ``nth``.
    """
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    revisit = refers_to is not None
    digest = payload_digest(payload)
    block = http if revisit else http + payload
    head = [
        WARC_VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest, nth)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {quote(page_id, safe='')}")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=~-._')}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    data = ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Write one record per row of ``pages`` to ``.warc.gz`` files in ``folder`` (a URI).

    Returns ``(path, size, records)``, one row per archive; running it writes
    them. Of rows with equal payloads the smallest id is a response and the
    others revisit it; rows that repeat that smallest id are responses too.
    A null payload counts as empty; a null id is larger than any other, and
    is never referred to: equal payloads without any id are all responses. An empty
    table writes nothing. Other columns are ignored, whatever their names.

    Rows are sorted within a partition, so every attempt of a task writes the
    same archives byte for byte. It writes them under a name of its own and
    renames them to one that follows from the partition: a task that ran
    twice, or failed half-way, leaves nothing else. Records of one id and
    payload are numbered within their task.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    firsts = (
        rows.groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .drop("n")
    )
    plan = rows.join(firsts, "digest", "left").select(
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        "payload",
        F.when(
            F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")),
            F.col("first_id").cast("string"),
        ).alias("refers_to"),
        "digest",
    ).sortWithinPartitions("digest", "page_id", "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        store, base = pafs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        out, size, records, k = None, 0, 0, 0
        last, nth = None, 0

        def names() -> tuple[str, str]:
            final = f"{base}/part-{task.partitionId():06d}-{k:04d}.warc.gz"
            return f"{base}/_attempts/{task.taskAttemptId()}-{k:04d}", final

        def close() -> pa.RecordBatch:
            out.close()
            store.move(*names())
            path = f"{folder}/{names()[1].rpartition('/')[2]}"
            return pa.RecordBatch.from_pydict({"path": [path], "size": [size], "records": [records]})

        for batch in batches:
            for page_id, url, payload, refers, digest in zip(*(c.to_pylist() for c in batch.columns)):
                nth = nth + 1 if (page_id, digest) == last else 0
                last = page_id, digest
                if out is None:
                    store.create_dir(f"{base}/_attempts", recursive=True)
                    out, size, records = store.open_output_stream(names()[0], compression=None), 0, 0
                member = record_member(page_id, url, payload, refers, nth=nth)
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= roll_bytes:
                    yield close()
                    out, k = None, k + 1
        if out is not None:
            yield close()

    return plan.mapInArrow(write, "path string, size bigint, records bigint")


class _Window:
    """A file read in windows."""

    def __init__(self, file, size: int) -> None:
        self.file, self.size, self.base, self.data = file, size, 0, b""

    def get(self, at: int, n: int) -> memoryview:
        """At most ``n`` bytes from ``at``; none at the end of the file."""
        if not self.base <= at < self.base + len(self.data):
            self.base = at
            self.data = self.file.read_at(min(max(WINDOW, n), self.size - at), at) if at < self.size else b""
        return memoryview(self.data)[at - self.base : at - self.base + n]


def _magic(window: _Window, at: int, end: int) -> int | None:
    """The first place of the gzip magic that is in ``[at, end)``."""
    while at < end:
        if not len(window.get(at, 1)):
            return None
        if window.base + len(window.data) - at < len(GZIP_MAGIC):
            window.base, window.data = at, window.file.read_at(min(WINDOW, window.size - at), at)
            if len(window.data) < len(GZIP_MAGIC):
                return None
        found = window.data.find(GZIP_MAGIC, at - window.base)
        if found >= 0:
            return window.base + found if window.base + found < end else None
        at = window.base + len(window.data) - len(GZIP_MAGIC) + 1
    return None


def _begins_record(piece: memoryview) -> bool:
    """Whether what can be inflated of a damaged member starts like a record."""
    try:
        return zlib.decompressobj(31).decompress(piece, 7) == b"WARC/1."
    except zlib.error:
        return False


def _member(window: _Window, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """The record at ``at``: header fields, block and where it ends; None if there is none.

    What inflates to the beginning of a WARC header but not to a whole record
    is damaged, and raises; a header may be of any length.
    """
    inflate = zlib.decompressobj(31)
    data, head, searched, here = bytearray(), -1, 0, at
    while not inflate.eof:
        piece = window.get(here, STEP)
        try:
            data += inflate.decompress(piece) if len(piece) else inflate.flush()
        except zlib.error:
            if head >= 0 or _begins_record(window.get(at, STEP)):
                raise ValueError(f"damaged record at byte {at}") from None
            return None
        here += len(piece)
        if head < 0:
            if not bytes(data[:7]) == b"WARC/1."[: len(data[:7])]:
                return None
            head = data.find(b"\r\n\r\n", max(0, searched - 3))
            searched = len(data)
        if not len(piece) and not inflate.eof:
            if len(data) >= 7:
                raise ValueError(f"record at byte {at} is cut off")
            return None
    if len(data) < 7:
        return None
    if head < 0:
        raise ValueError(f"header of the record at byte {at} does not end")
    fields = {}
    for line in data[:head].decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    if not fields.get("content-length", "").isdigit():
        raise ValueError(f"record at byte {at} states no Content-Length")
    length = int(fields["content-length"])
    block = bytes(data[head + 4 : head + 4 + length])
    if len(block) < length:
        raise ValueError(f"record at byte {at} is shorter than its Content-Length")
    return fields, block, here - len(inflate.unused_data)


def scan_range(file, size: int, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """Header fields, block and place of every record that starts in ``[start, end)``."""
    window, at = _Window(file, size), start
    while (found := _magic(window, at, end)) is not None:
        record = _member(window, found)
        if record is None:
            at = found + 1
        else:
            yield record[0], record[1], found
            at = record[2]


def _page(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    """A row of ``READ_SCHEMA``; the digest of a payload is checked against its header."""
    head, _, body = block.partition(b"\r\n\r\n")
    stated = fields.get("warc-payload-digest", "").rpartition(":")[2] or None
    kind = fields.get("warc-type")
    if kind == "revisit":
        sizes = [
            int(line.partition(b":")[2])
            for line in head.split(b"\r\n")
            if line.lower().startswith(b"content-length:")
        ]
        n_bytes, digest, payload = (sizes[0] if sizes else None), stated, None
    else:
        payload = body if fields.get("content-type", "").startswith("application/http") else block
        n_bytes, digest = len(payload), payload_digest(payload)
        if stated is not None and stated != digest:
            raise ValueError(f"payload digest {digest} differs from the header's {stated}")
    page, refers = fields.get("x-page-id"), fields.get("warc-refers-to")
    return (
        unquote(page) if page is not None else None,
        unquote(fields["warc-target-uri"]) if "warc-target-uri" in fields else None,
        kind,
        n_bytes,
        digest,
        unquote(refers.removeprefix("<urn:x-page:").removesuffix(">").partition(":")[0]) if refers else None,
        payload if with_payload else None,
    )


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, size)`` of the ``.warc.gz`` files in a folder; Spark lists it, reading no content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return files.select("path", F.col("length").alias("size"))


def read_warc(archives: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """One row of ``READ_SCHEMA`` for every record of ``archives(path, size)``.

    ``payload_bytes`` and ``payload_digest`` are of the full payload, for a
    revisit too, whose own ``payload`` is null. ``with_payload=False`` leaves
    that column null. Damaged records raise. Archives of 0 bytes, and an
    empty table, give no rows.
    """
    ranges = archives.where("size > 0").select(
        "path",
        "size",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(split_bytes).cast("bigint"))).alias("start"),
    )
    # a number of partitions, so that adaptive execution does not join the small rows into one task
    n = archives.select(F.sum(F.ceil(F.col("size") / split_bytes))).first()[0] or 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        names = [part.split(" ")[0] for part in READ_SCHEMA.split(", ")]
        types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

        def to_batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names
            )

        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                store, place = pafs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_file(place) as file:
                    for fields, block, _ in scan_range(file, size, start, min(size, start + split_bytes)):
                        if fields.get("warc-type") not in ("response", "revisit"):
                            continue
                        rows.append(_page(fields, block, with_payload))
                        held += len(block)
                        if held >= 8 << 20 or len(rows) >= 4096:
                            yield to_batch(rows)
                            rows, held = [], 0
                if rows:
                    yield to_batch(rows)

    return ranges.repartition(int(min(n, 200_000))).mapInArrow(read, READ_SCHEMA)
