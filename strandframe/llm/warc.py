"""WARC archives: writing captures, reading records back, and assembling transactions.

A capture is written as three records: the request, the response (or a revisit of an equal
payload), and metadata, where request and metadata name the response in ``WARC-Concurrent-To``.
Reading frames records by ``Content-Length`` while the lines of a compressed file stream by, and
assembly joins the three kinds through that identifier into one nested row per capture.

Of pages whose payloads have equal digests and at least ``LEAST_REVISIT`` bytes the one with the
smallest id (null last) is the response, the others revisit it; rows that repeat its id are responses
too. A null payload is empty. Every row is a capture of its own, also a repeated one. A capture without request or
metadata has nulls there; of several the one with the smallest record id counts. Of a field that metadata
repeats, ``fields`` has the first value and ``field_lines`` all. Other columns of ``pages`` are not read, whatever their
names. An empty table gives files without records and no captures.

Records of any version are read. Lengths are trusted, so a payload may hold whole records itself; a record
whose length runs past the end of its file is left out, and reading goes on with the next header behind its own.
A payload of any length is one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.1\r\n"
#: What every version line begins with.
MARK = "WARC/"
VERSION_LINE = re.compile(rb"\d+\.\d+\r\n")
LEAST_REVISIT = 100
RECORD = "file string, record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, payload_digest string, content_type string, block binary"


def _uuid(kind: str) -> Column:
    """A name-based identifier of a page's record."""
    h = F.md5(F.concat_ws(":", F.lit(kind), F.col("url"), F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.col("_digest")))
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("3"), F.substring(h, 14, 3)), F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(headers: list[tuple[str, Column]], content_type: str, block: Column) -> Column:
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v, F.lit("\r\n"))).otherwise("") for k, v in headers]
    length = F.octet_length(block).cast("string")
    return F.concat(*lines, F.lit(f"Content-Type: {content_type}\r\nContent-Length: "), length, F.lit("\r\n\r\n"), block, F.lit("\r\n\r\n"))


def plan_captures(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with the digest, the record ids and what each page revisits."""
    base = pages.select("page_id", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    base = base.withColumn("_digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn("_bytes", F.octet_length("html").cast("long"))
    base = base.withColumn("_id", _uuid("capture"))
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", F.col("_id").alias("id"), "url"))
    heads = base.filter(F.col("_bytes") >= LEAST_REVISIT).groupBy("_digest").agg(first.alias("_h"), F.count("*").alias("_copies")).filter("_copies > 1")
    joined = base.join(heads.select(F.col("_digest").alias("_d"), "_h"), F.col("_digest") == F.col("_d"), "left")
    revisits = F.col("_h").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_h.page_id"))
    return joined.withColumn("_head_id", F.when(revisits, F.col("_h.id"))).withColumn("_head_url", F.when(revisits, F.col("_h.url"))).drop("_d", "_h")


def write_captures(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Compressed WARC files below ``path``, one per task."""
    plan = plan_captures(pages)
    revisit = F.col("_head_id").isNotNull()
    day = F.lit(date)
    target, capture = F.col("url"), F.col("_id")
    request = _record([("WARC-Type", F.lit("request")), ("WARC-Record-ID", _uuid("request")), ("WARC-Date", day), ("WARC-Target-URI", target), ("WARC-Concurrent-To", capture)],
                      "application/http;msgtype=request", F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1\r\n\r\n")))
    head = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    digest = F.concat(F.lit("sha256:"), F.col("_digest"))
    profile = F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    response = _record([("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise("response")), ("WARC-Record-ID", capture), ("WARC-Date", day), ("WARC-Target-URI", target),
                        ("WARC-Payload-Digest", digest), ("WARC-Profile", profile), ("WARC-Refers-To", F.col("_head_id")), ("WARC-Refers-To-Target-URI", F.col("_head_url"))],
                       "application/http;msgtype=response", F.when(revisit, head).otherwise(F.concat(head, F.col("html"))))
    fields = F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\npayload-bytes: "), F.col("_bytes").cast("string"), F.lit("\r\n"))
    metadata = _record([("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _uuid("metadata")), ("WARC-Date", day), ("WARC-Target-URI", target), ("WARC-Concurrent-To", capture)],
                       "application/warc-fields", fields)
    # a line end between records is blank to readers, who look for the version line
    plan.select(F.concat(F.lit(VERSION), request, F.lit(VERSION), response, F.lit(VERSION), metadata).alias("value")).write.option("lineSep", "\n").option("compression", "gzip").text(path)


def _header(piece: bytes) -> tuple[dict[bytes, bytes], int, int] | None:
    """Fields, start of the block and end of the record; no fields where there is no record, None where the header goes on."""
    version = VERSION_LINE.match(piece)
    if not version:
        return {}, 0, 0
    end = piece.find(b"\r\n\r\n", version.end())
    if end < 0:
        return None
    lines = piece[version.end() : end].split(b"\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines) if k}
    length = fields.get(b"content-length", b"")
    return (fields, end + 4, end + 4 + int(length)) if length.isdigit() else ({}, 0, 0)


class _Reader:
    """Records of one file from the pieces between version marks; a record goes on until it is as long as it says."""

    def __init__(self, file: str) -> None:
        self.file, self.rows, self.taken = file, [], 0
        self.held: list[bytes] = []
        self.size, self.header = 0, None

    def add(self, piece: bytes) -> None:
        self.size += len(piece) + (len(MARK) if self.held else 0)
        self.held.append(piece)
        if self.header is None:
            self.header = _header(MARK.encode().join(self.held))
        if self.header is not None and self.size >= self.header[2]:
            fields, first, end = self.header
            if fields:
                get = lambda k: fields[k].decode("utf-8", "replace") if k in fields else None
                names = (b"warc-record-id", b"warc-type", b"warc-concurrent-to", b"warc-refers-to", b"warc-target-uri", b"warc-date", b"warc-payload-digest", b"content-type")
                self.rows.append((self.file, *map(get, names), MARK.encode().join(self.held)[first:end]))
                self.taken += end + 500
            self.held, self.size, self.header = [], 0, None

    def finish(self) -> None:
        """A record that is open at the end of the file is given up, those behind its header are read."""
        while self.held:
            again = self.held[1:]
            self.held, self.size, self.header = [], 0, None
            for piece in again:
                self.add(piece)

    def flush(self) -> pa.RecordBatch:
        names = [f.split(" ")[0] for f in RECORD.split(", ")]
        types = [pa.binary() if f.endswith("binary") else pa.string() for f in RECORD.split(", ")]
        out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in self.rows], t) for i, t in enumerate(types)], names=names)
        self.rows, self.taken = [], 0
        return out


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = None
    for batch in batches:
        for file, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if reader is None or file != reader.file:
                if reader:
                    reader.finish()
                    yield reader.flush()
                reader = _Reader(file)
            reader.add(piece)
            if reader.taken > 1 << 22:
                yield reader.flush()
    if reader:
        reader.finish()
        yield reader.flush()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of gzip-compressed WARC files; each file streams through one task."""
    lines = spark.read.option("lineSep", MARK).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece")).mapInArrow(_frames, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit, its request and its metadata fields."""
    concurrent = records.filter(F.col("concurrent_to").isNotNull())

    def beside(kind: str) -> DataFrame:
        return concurrent.filter(F.col("type") == kind).groupBy("concurrent_to").agg(
            F.min(F.struct("record_id", "target_uri", F.col("block").cast("string").alias("block"))).alias(kind))

    request, metadata = beside("request"), beside("metadata")
    main = records.filter(F.col("type").isin("response", "revisit"))
    cut = F.expr("substring(block, position(X'0D0A0D0A' in block) + 4)")
    main = main.select(F.col("record_id"), F.col("type"), "refers_to", "target_uri", "payload_digest", cut.alias("payload"))
    main = main.withColumn("found_digest", F.sha2("payload", 256)).withColumn("found_bytes", F.octet_length("payload").cast("long"))
    joined = main.join(request, main.record_id == request.concurrent_to, "left").drop("concurrent_to")
    joined = joined.join(metadata, joined.record_id == metadata.concurrent_to, "left").drop("concurrent_to")
    return joined.select(
        "record_id", "type", "refers_to", "target_uri", "payload_digest", "found_digest", "found_bytes", "payload", "request",
        F.col("metadata.record_id").alias("metadata_id"), field_lines(F.col("metadata.block")).alias("field_lines"),
    ).withColumn("fields", first_fields("field_lines"))


def field_lines(block: Column) -> Column:
    """(name, value) of each line of a block of fields."""
    lines = F.filter(F.split(block, "\r\n"), lambda x: x != "")
    # what stands behind the name, without the colon and blanks; nothing if there is no colon
    value = lambda x: F.ltrim(F.substr(x, F.length(F.substring_index(x, ":", 1)) + 2), F.lit(" \t"))
    return F.transform(lines, lambda x: F.struct(F.substring_index(x, ":", 1).alias("name"), value(x).alias("value")))


def first_fields(lines: str) -> Column:
    """The first value of each name; a record has a handful of them."""
    names = F.transform(lines, lambda x: x["name"])
    own = F.filter(lines, lambda x, i: F.array_position(names, x["name"]) == i + 1)
    return F.map_from_entries(own)


def resolve(captures: DataFrame) -> DataFrame:
    """Captures with the page that a revisit refers to, and the size and digest of the full payload."""
    page = F.when(F.col("fields")["page-id"] != "", F.col("fields")["page-id"].cast("long"))
    mine = captures.withColumn("page_id", page)
    heads = mine.filter(F.col("type") == "response").groupBy(F.col("record_id").alias("_h")).agg(
        F.min("page_id").alias("_head_page"), F.min("found_bytes").alias("_head_bytes"), F.min("found_digest").alias("_head_digest"))
    # a capture that refers to nothing has a key of its own, or all of them would be dealt to one task
    looks_for = F.coalesce("refers_to", F.concat(F.lit(":"), "record_id"))
    joined = mine.withColumn("_key", looks_for).join(heads, F.col("_key") == F.col("_h"), "left")
    revisit = F.col("type") == "revisit"
    return joined.select(
        *mine.columns, F.when(revisit, F.col("_head_page")).alias("refers_to_page"), F.when(revisit, F.col("_head_bytes")).otherwise(F.col("found_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("_head_digest")).otherwise(F.col("found_digest")).alias("digest"))
