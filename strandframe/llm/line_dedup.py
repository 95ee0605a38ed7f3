"""Lines that many documents share, dropped everywhere but in one document.

Every distinct long line is a 128-bit hash. A shard of the hashes is a minimal perfect hash (a cascade
of bit arrays, each holding the hashes that meet no other in it) over two arrays: fingerprints and
numbers of documents. Lines travel as hashes to the shard that knows them and probe its arrays, a batch
at a time; only lines that go come back, per document. No line meets another line in a join.

* A line's key is the line without blanks (space, tab to carriage return) at both ends, A-Z in lower case.
* Null and empty texts are one empty line. Null ids count together as one document before all others.
* Rows that repeat an id are one document; each keeps or loses the same lines.
* Columns ``n_lines``, ``n_dropped`` and ``kept_text`` of the input are replaced, all others are kept.
* An empty table gives an empty one; a text of any length is handled line by line in its own row.

A line in a third of all documents is counted map-side, and its shard is probed in parts of ``PART``
hashes, each next to a copy of the arrays, so no task holds a line's documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .text import mix, replace_names

BLANKS = b" \t\n\v\f\r"
#: Distinct lines of a shard, on average, and hashes that probe one copy of it.
SHARD, PART = 1 << 14, 1 << 18
LINE = "h long, f long, doc long, t long"
INDEX = "shard long, levels array<long>, bits binary, marks binary, counts binary, lasts binary"
GONE = "doc long, t long, line binary"


def line_key(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[bytes | None]:
    return (x.as_buffer().to_pybytes() if x.is_valid else None for x in batch.column(batch.schema.get_field_index(name)))


def line_hashes(docs: DataFrame, key: str, least: int) -> DataFrame:
    """The distinct long lines of each row: both halves of the hash, the id, the hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts = [], np.zeros(len(batch), np.int64)
            for i, text in enumerate(_texts(batch, "text")):
                if text and len(text) >= least:
                    own = {digest(k) for line in text.split(b"\n") if long_enough(k := line_key(line), least)}
                    counts[i] = len(own)
                    found.extend(own)
            both = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            rows = pa.array(np.repeat(np.arange(len(batch)), counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]), batch.column(0).take(rows), batch.column(1).take(rows)], names=["h", "f", "doc", "t"])
            pa.default_memory_pool().release_unused()

    return docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.xxhash64("text").alias("t"), "text").mapInArrow(run, LINE)


class LineIndex:
    """Minimal perfect hash over pairs of 64-bit numbers, with a fingerprint and a count in each slot."""

    def __init__(self, levels: list[int], bits: np.ndarray, marks: np.ndarray, counts: np.ndarray, lasts: np.ndarray, min_docs: int):
        self.levels, self.bits, self.marks, self.counts, self.lasts = levels, bits, marks, counts, lasts
        self.rank = np.zeros(len(bits) + 1, np.int64)
        np.cumsum(np.bitwise_count(bits), out=self.rank[1:])
        self.often = counts >= min_docs
        self.place = np.cumsum(self.often) - 1

    @staticmethod
    def spots(h: np.ndarray, f: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(mix(h ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))) + f) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, h: np.ndarray, f: np.ndarray, counts: np.ndarray, lasts: np.ndarray, min_docs: int) -> LineIndex:
        """``h`` and ``f`` are distinct as pairs."""
        left, levels, parts = np.arange(len(h)), [], []
        while len(left):
            size = 64 * (len(left) * 3 // 128 + 1)
            at = cls.spots(h[left], f[left], len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            parts.append(np.packbits(alone, bitorder="little").view("<u8"))
            levels.append(size)
            left = left[~alone[at]]
        bits = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        bare = cls(levels, bits, np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64), min_docs)
        order = np.argsort(bare.slots(h, f))
        held = counts[order]
        width = np.min_scalar_type(int(held.max(initial=0)))
        return cls(levels, bits, (f[order] >> np.uint64(32)).astype(np.uint32), held.astype(width), lasts[order][held >= min_docs], min_docs)

    def slots(self, h: np.ndarray, f: np.ndarray) -> np.ndarray:
        """The slot of each member; -1 for most others."""
        out, left, base = np.full(len(h), -1, np.int64), np.arange(len(h)), 0
        for level, size in enumerate(self.levels):
            at = self.spots(h[left], f[left], level, size)
            word, inside = base + (at >> 6), (at & 63).astype(np.uint64)
            on = (self.bits[word] >> inside) & np.uint64(1) == 1
            below = np.bitwise_count(self.bits[word] & ((np.uint64(1) << inside) - np.uint64(1)))
            out[left[on]] = (self.rank[word] + below)[on]
            left, base = left[~on], base + (size >> 6)
        return out

    def goes(self, h: np.ndarray, f: np.ndarray, doc: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Whether a line leaves a document. A line that the index never saw passes for one it holds with chance 2^-32."""
        slot = self.slots(h, f)
        out = np.zeros(len(h), bool)
        at = np.flatnonzero(slot >= 0)
        at = at[self.often[slot[at]] & (self.marks[slot[at]] == (f[at] >> np.uint64(32)).astype(np.uint32))]
        out[at] = ~known[at] | (self.lasts[self.place[slot[at]]] != doc[at])
        return out

    def row(self, shard: int) -> list:
        width = self.counts.dtype.newbyteorder("<")
        head = width.str.encode().ljust(4)
        return [shard, self.levels, self.bits.tobytes(), self.marks.astype("<u4").tobytes(), head + self.counts.astype(width).tobytes(), self.lasts.astype("<i8").tobytes()]

    @classmethod
    def of_row(cls, row: dict, min_docs: int) -> LineIndex:
        width = np.dtype(row["counts"][:4].decode().strip())
        return cls(row["levels"], np.frombuffer(row["bits"], "<u8"), np.frombuffer(row["marks"], "<u4"), np.frombuffer(row["counts"], width, offset=4),
                   np.frombuffer(row["lasts"], "<i8"), min_docs)


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def build_index(lines: DataFrame, min_docs: int) -> DataFrame:
    """One row per shard: bit arrays, fingerprints, numbers of documents, and the last document of frequent lines."""
    spark = lines.sparkSession
    docs = F.count_distinct("doc") + F.max(F.col("doc").isNull().cast("long"))
    path = scratch_path(spark, "line-counts")
    lines.groupBy("h", "f").agg(docs.alias("n"), F.coalesce(F.max("doc"), F.lit(0)).alias("last")).write.parquet(path)
    counted = spark.read.parquet(path)
    shards = counted.count() // SHARD + 1
    names = T._parse_datatype_string(INDEX).names

    def run(table: pa.Table) -> pa.Table:
        made = LineIndex.build(_unsigned(table["h"].combine_chunks()), _unsigned(table["f"].combine_chunks()), table["n"].to_numpy(), table["last"].to_numpy(), min_docs)
        kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4]
        return pa.table([pa.array([x], k) for x, k in zip(made.row(table["shard"][0].as_py()), kinds)], names=names)

    return counted.withColumn("shard", F.pmod("h", F.lit(shards))).groupBy("shard").applyInArrow(run, INDEX), shards


def _probe(stream: DataFrame, min_docs: int) -> DataFrame:
    """Lines that go, from partitions in which the arrays of a shard come before the lines that probe them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            starts = np.flatnonzero(col["bits"].is_valid().to_numpy(zero_copy_only=False)).tolist()
            cuts = sorted({0, *starts, len(batch)})
            for a, b in zip(cuts, cuts[1:]):
                if a in starts:
                    index = LineIndex.of_row({n: col[n][a].as_py() for n in ("levels", "bits", "marks", "counts", "lasts")}, min_docs)
                    a += 1
                if a == b:
                    continue
                h, f = _unsigned(col["h"].slice(a, b - a)), _unsigned(col["f"].slice(a, b - a))
                doc = col["doc"].slice(a, b - a)
                known = doc.is_valid().to_numpy(zero_copy_only=False)
                gone = np.flatnonzero(index.goes(h, f, doc.fill_null(0).to_numpy(), known))
                both = np.stack([h[gone], f[gone]], 1).astype("<u8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [doc.take(pa.array(gone)), col["t"].slice(a, b - a).take(pa.array(gone)), pa.array([both[i : i + 16] for i in range(0, len(both), 16)], pa.binary())], names=["doc", "t", "line"])

    return stream.mapInArrow(run, GONE)


def shared_lines(docs: DataFrame, key: str = "doc_id", least: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc, t, line): the hashes of the lines that the document with this id and this hash of its text loses."""
    if min_docs < 2:
        raise ValueError("min_docs must be 2 or more")
    spark = docs.sparkSession
    path = scratch_path(spark, "lines")
    line_hashes(docs, key, least).write.parquet(path)
    lines = spark.read.parquet(path)
    index, shards = build_index(lines, min_docs)
    lines = lines.withColumn("shard", F.pmod("h", F.lit(shards)))
    # one row per shard
    parts = lines.groupBy("shard").agg(F.floor(F.count("*") / PART + 1).alias("parts"))
    held = index.join(parts, "shard").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    asked = lines.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("doc", "t"), F.col("parts")))
    stream = held.drop("parts").unionByName(asked.drop("parts"), allowMissingColumns=True)
    stream = stream.repartition("shard", "part").sortWithinPartitions("shard", "part", F.col("bits").isNull())
    return _probe(stream.select("shard", "part", "levels", "bits", "marks", "counts", "lasts", "h", "f", "doc", "t"), min_docs)


def dedup_lines(docs: DataFrame, key: str = "doc_id", least: int = 40, min_docs: int = 5) -> DataFrame:
    """Adds ``n_lines``, ``n_dropped`` and ``kept_text``.

    A key of at least ``least`` code points in at least ``min_docs`` documents loses all its lines
    except those in the largest id that holds it.
    """
    rows = replace_names(docs, ["n_lines", "n_dropped", "kept_text"])
    lost = shared_lines(docs, key, least, min_docs).groupBy(F.col("doc").alias("_gone_doc"), F.col("t").alias("_gone_text")).agg(F.collect_list("line").alias("_gone"))
    kept = rows.schema.fields
    same = F.col(f"`{key}`").cast("long").eqNullSafe(F.col("_gone_doc")) & (F.xxhash64("text") == F.col("_gone_text"))
    joined = rows.join(lost, same, "left").drop("_gone_doc", "_gone_text")
    added = T._parse_datatype_string("n_lines long, n_dropped long, kept_text string")
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, dropped, out = [], [], []
            for text, lines in zip(_texts(batch, "text"), batch.column(len(names))):
                text = text or b""
                total.append(text.count(b"\n") + 1)
                if lines.is_valid:
                    leave = set(lines.as_py())
                    stay = [line for line in text.split(b"\n") if digest(line_key(line)) not in leave]
                    dropped.append(total[-1] - len(stay))
                    text = b"\n".join(stay)
                else:
                    dropped.append(0)
                out.append(text)
            new = [pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(names))], *new], names=[*names, *added.names])
            pa.default_memory_pool().release_unused()

    return joined.mapInArrow(run, T.StructType([*kept, *added.fields]))
