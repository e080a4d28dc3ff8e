"""WARC archives as seekable Zstandard bundles.

A bundle is a ``.warc.zst`` file: records are gathered into independent frames, and a
skippable frame at the end holds the seek table (sizes of every frame, in the layout of
the public Zstandard seekable format), so any reader of Zstandard reads the bundle and
a reader of the table decompresses one frame only.  Beside the bundle stands an index
from record to frame and offset within the decompressed frame.

A bundle and its index are one row of a Parquet table in the shared folder, written by
Spark's committer: a lost executor leaves no half bundle, and any store works.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the
smallest page_id is a ``response``, the others are ``revisit`` records that refer to it
and carry no payload.  Pages stay in the tasks that read them, unless the list of
revisits is too large to be broadcast.

Defined results: a null html is an empty payload; texts of any length are whole records
(a frame of their own if need be); rows equal in page_id and payload are records of the
same type; a null page_id can't be referred to, so payloads held by null ids alone are
all responses; a null or odd url is replaced or percent-encoded in its header; an empty
table gives no bundle; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge.storage import materialize

REVISIT_BYTES = 100
FRAME_BYTES = 512 << 10  # of records; a frame ends after the record that reaches it
BUNDLE_BYTES = 8 << 20  # of frames
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"  # the tables hold no time of capture

# Fixed values of the public formats.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def record_id(page_id: int | None) -> str:
    """A name-based id: the same page has the same record id in every run."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page_id}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is None:
        block = HTTP_HEAD + payload
    else:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}", f"WARC-Profile: {REVISIT_PROFILE}"]
        block = HTTP_HEAD
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int) -> tuple[dict[str, str], bytes]:
    """Headers and payload of the record that starts at ``at``; ValueError if it is damaged."""
    end = data.index(b"\r\n\r\n", at)
    first, *rest = data[at:end].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in rest)
    size = int(headers["Content-Length"])
    block = data[end + 4 : end + 4 + size]
    if len(block) != size or data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
        raise ValueError("WARC record is cut")
    payload = block.partition(b"\r\n\r\n")[2]
    if headers["WARC-Type"] == "response" and f"sha256:{hashlib.sha256(payload).hexdigest()}" != headers["WARC-Payload-Digest"]:
        raise ValueError("payload digest differs")
    return headers, payload


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame: (compressed, decompressed) size of every frame."""
    body = b"".join(struct.pack("<II", *x) for x in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def frame_sizes(bundle: bytes) -> list[tuple[int, int]]:
    n, kind, magic = struct.unpack_from("<IBI", bundle, len(bundle) - 9)
    if magic != SEEKABLE_MAGIC or kind & 0x80:
        raise ValueError("no seek table")
    return [struct.unpack_from("<II", bundle, len(bundle) - 9 - 8 * (n - i)) for i in range(n)]


_BUNDLES = "bundle string, page_ids array<long>, frames array<int>, offsets array<int>, content binary"


class _Writer:
    def __init__(self):
        import zstandard

        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self.clear()

    def clear(self) -> None:
        self.frames, self.sizes, self.index, self.open, self.open_size, self.size = [], [], [], [], 0, 0

    def add(self, page_id: int | None, data: bytes) -> None:
        self.index.append((page_id, len(self.frames), self.open_size))
        self.open.append(data)
        self.open_size += len(data)
        if self.open_size >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            raw = b"".join(self.open)
            self.frames.append(self.compress(raw))
            self.sizes.append((len(self.frames[-1]), len(raw)))
            self.size += len(self.frames[-1])
            self.open, self.open_size = [], 0

    def bundle(self, name: str) -> pa.RecordBatch:
        self.close_frame()
        columns = list(zip(*self.index))
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([name]),
                pa.array([columns[0]], pa.list_(pa.int64())),
                pa.array([columns[1]], pa.list_(pa.int32())),
                pa.array([columns[2]], pa.list_(pa.int32())),
                pa.array([b"".join(self.frames) + seek_table(self.sizes)], pa.binary()),
            ],
            names=["bundle", "page_ids", "frames", "offsets", "content"],
        )
        self.clear()
        return out


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    writer, task, n = _Writer(), None, 0
    for batch in batches:
        for i in range(batch.num_rows):
            page_id, url, html, refers_to, task = (batch.column(c)[i].as_py() for c in range(5))
            writer.add(page_id, record(page_id, url, (html or "").encode(), refers_to))
            if writer.size >= BUNDLE_BYTES:
                yield writer.bundle(f"part-{task:06d}-{n:04d}.warc.zst")
                n += 1
    if writer.index:
        yield writer.bundle(f"part-{task:06d}-{n:04d}.warc.zst")


def write(pages: DataFrame) -> DataFrame:
    """Write all pages (page_id, url, html); returns the bundles: bundle, page_ids, frames, offsets, content."""
    plain = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.when(F.octet_length("html") >= REVISIT_BYTES, F.sha2("html", 256)))
    named = plain.where("digest IS NOT NULL").select("page_id", "digest")
    firsts = named.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    revisits = materialize(
        named.join(firsts, "digest").where(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull())
        .select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), F.col("first").alias("refers_to"))
        .distinct(),
        "revisits",
    )
    same = F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest"))
    rows = plain.join(revisits, same, "left").select("page_id", "url", "html", "refers_to", F.spark_partition_id().alias("task"))
    return materialize(rows.mapInArrow(_write, _BUNDLES), "warc")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    decompress = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for row in batch.select(["frames", "offsets", "content"]).to_pylist():
            sizes = frame_sizes(row["content"])
            found, current, data, lead = [], -1, b"", 0
            for frame, offset in zip(row["frames"], row["offsets"]):
                if frame != current:
                    lead, current = sum(s for s, _ in sizes[:frame]), frame
                    data = decompress(row["content"][lead : lead + sizes[frame][0]], max_output_size=sizes[frame][1])
                headers, _ = parse(data, offset)
                found.append(
                    (
                        int(headers["X-Page-ID"]) if headers["X-Page-ID"] else None,
                        int(headers["X-Payload-Length"]),
                        headers["WARC-Payload-Digest"].removeprefix("sha256:"),
                        headers["WARC-Type"],
                        int(headers["X-Refers-To-Page"]) if "X-Refers-To-Page" in headers else None,
                    )
                )
            columns = list(zip(*found))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
            )


def read(bundles: DataFrame) -> DataFrame:
    """Every record, read back through index and seek table; damaged records fail the task."""
    return bundles.select("frames", "offsets", "content").mapInArrow(
        _read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= {REVISIT_BYTES} THEN min(page_id) OVER (PARTITION BY payload_digest)
  ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to FROM f"""
