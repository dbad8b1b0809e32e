"""WARC archives through a table of chunks.

Writing: each record becomes rows (record, chunk number, data); a payload beyond ``chunk_chars`` is many rows, each with
the digest carried on to its end, and in the archive a chain of segments (a first record and continuations), so no block
is longer than a chunk. Equal payloads of at least ``min_revisit`` bytes are stored once: the record of the largest page
id is the response, the others are revisits without a payload. Archives are gzip files that Spark writes to the shared
folder: the end of a header, and of a block, is an empty line, so header and block are written as lines of a text file
whose line end is the empty line itself.

Reading: the files come back through Spark as bytes cut at empty lines. A small machine puts the stream together again,
takes blocks by Content-Length and updates size and SHA-1 of a payload chunk by chunk over all its segments; a payload
may hold empty lines, nothing depends on them. It holds one block at a time.

Cases: null payload counts as empty, null url leaves the target out; a null page id is kept as such, is never the
largest, and equal payloads of null ids only are all responses. Rows that share id and payload share their part.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import partial
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END = "\r\n\r\n"
CHUNK_CHARS = 1 << 20
BROADCAST_PAYLOADS = 200_000
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def plan_records(pages: DataFrame, min_revisit: int = 1000, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(record, page_id, url, payload, sha1, bytes, refers_to): refers_to is null for responses."""
    text = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), text.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1(F.col("payload").cast("binary"))).withColumn("bytes", F.octet_length("payload").cast("long"))
    shared = rows.where(F.col("bytes") >= min_revisit).groupBy(F.col("sha1").alias("s"), F.col("bytes").alias("b"))
    shared = shared.agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n")
    few = F.broadcast(shared) if shared.limit(BROADCAST_PAYLOADS + 1).count() <= BROADCAST_PAYLOADS else shared
    joined = rows.join(few, (F.col("sha1") == F.col("s")) & (F.col("bytes") == F.col("b")), "left").drop("s", "b")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = joined.withColumn("refers_to", F.when(other, F.col("first"))).drop("first").withColumn("record", F.monotonically_increasing_id())
    return joined.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(""))


CHUNKS = "record long, chunk int, last boolean, page_id long, url string, sha1 string, bytes long, refers_to long, data string, so_far string"


def _chunk(part: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in CHUNKS.split(", ")]
    types = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    at = {n: i for i, n in enumerate(["record", "page_id", "url", "payload", "sha1", "bytes", "refers_to"])}

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for batch in part:
        columns = {n: batch.column(i) for n, i in at.items()}
        rows, held = [], 0
        for i in range(batch.num_rows):
            value = {n: c[i].as_py() for n, c in columns.items()}
            payload, digest = value["payload"], hashlib.sha1()
            for number, start in enumerate(range(0, max(1, len(payload)), size)):
                data = payload[start : start + size]
                digest.update(data.encode())
                last = start + size >= len(payload)
                if last and value["refers_to"] is None and digest.hexdigest() != value["sha1"]:
                    raise ValueError("the chunks of a payload do not add up to it")
                rows.append((value["record"], number, last, value["page_id"], value["url"], value["sha1"], value["bytes"], value["refers_to"], data, digest.hexdigest()))
                held += len(data)
                if held >= 4 * size:
                    yield made(rows)
                    rows, held = [], 0
        if rows:
            yield made(rows)


def chunk_table(records: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row for each chunk of a record, in order; so_far is the digest of the payload up to the chunk's end."""
    return records.select("record", "page_id", "url", "payload", "sha1", "bytes", "refers_to").mapInArrow(partial(_chunk, size=chunk_chars), CHUNKS)


def _header(row: dict) -> tuple[str, str]:
    """Header and block of the record that holds a chunk."""
    first, name = row["chunk"] == 0, f"<urn:x-record:{row['record']}:{row['chunk']}>"
    revisit, digest = row["refers_to"] is not None, base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    block = row["data"] if revisit or not first else HTTP.format(row["bytes"]) + row["data"]
    kind = "revisit" if revisit else "response" if first else "continuation"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", "1970-01-01T00:00:00Z")]
    if first:
        fields += [("WARC-Target-URI", quote(row["url"] or "", safe="%/:=&?~#+!$,;'@()*[]"))] * (row["url"] is not None)
        fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", row["bytes"])]
        fields += [("X-Page-ID", row["page_id"])] * (row["page_id"] is not None)
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page", row["refers_to"])] * revisit
    if not first or not row["last"]:
        fields += [("WARC-Segment-Number", row["chunk"] + 1)]
        fields += [("WARC-Segment-Origin-ID", f"<urn:x-record:{row['record']}:0>")] * (not first)
        fields += [("WARC-Segment-Total-Length", row["bytes"] + len(HTTP.format(row["bytes"])))] * row["last"]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block.encode()))]
    return "WARC/1.1\r\n" + "\r\n".join(f"{k}: {v}" for k, v in fields), block


def _lines(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in part:
        lines = [line for row in batch.to_pylist() for line in _header(row)]
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])


def write_archives(chunks: DataFrame, path: str) -> None:
    """gzip WARC files, one for each task."""
    chunks.mapInArrow(_lines, "value string").write.option("lineSep", END).option("compression", "gzip").text(path)


class _Reader:
    """Records from a stream of bytes that was cut at empty lines; yields a page's row when its payload is complete.

    A payload that ends in a line end makes its own empty line with the one behind it, so a cut may fall up to two bytes
    early, and the rest of the end then stands before the next header, or alone as the last line of a file."""

    def __init__(self):
        self.left, self.fields, self.page = None, {}, None

    def feed(self, line: bytes) -> Iterator[tuple]:
        """One line without its end, which is given back to the stream."""
        end = END.encode()
        data = line + end
        if self.left is not None:
            use, data = data[: self.left], data[self.left :]
            self._update(use[: max(0, self.left - len(end))])
            self.left -= len(use)
            if self.left:
                return
            self.left = None
            yield from self._close()
            if data == end:  # the rest of the last record's end, and the end given back that the file does not have
                return
        if data:
            self.fields = dict(x.decode().split(": ", 1) for x in data[: -len(end)].split(b"\r\n")[1:])
            self.left = int(self.fields["Content-Length"]) + len(end)
            self._open()

    def _open(self) -> None:
        f = self.fields
        if f["WARC-Type"] != "continuation":
            page = f.get("X-Page-ID")
            self.page = {"page_id": None if page is None else int(page), "sha1": hashlib.sha1(), "bytes": 0, "skip": f["WARC-Type"] == "response", "fields": f}

    def _update(self, data: bytes) -> None:
        if self.page["skip"]:  # the HTTP header is the first piece of the first segment
            self.page["skip"] = False
            return
        if data:
            self.page["sha1"].update(data)
            self.page["bytes"] += len(data)

    def _close(self) -> Iterator[tuple]:
        f, p = self.fields, self.page
        if "WARC-Segment-Number" in f and "WARC-Segment-Total-Length" not in f:
            return
        head = p["fields"]
        told = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        if head["WARC-Type"] == "revisit":
            yield p["page_id"], int(head["X-Payload-Length"]), told, "revisit", int(head["X-Refers-To-Page"])
        else:
            if p["sha1"].hexdigest() != told:
                raise ValueError(f"digest of record {head['WARC-Record-ID']} is not that of its payload")
            yield p["page_id"], p["bytes"], told, "response", None


def _read(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    reader = _Reader()
    for batch in part:
        rows = [row for line in batch.column(0).to_pylist() for row in reader.feed(line)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 5, types, strict=True)], names=names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to); size and digest of responses are counted anew."""
    lines = spark.read.option("lineSep", END).text(path)
    return lines.select(F.col("value").cast("binary")).mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
