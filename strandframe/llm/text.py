"""Whole texts as byte arrays inside a task: words, hashes and windows without a loop per row.

A batch of documents is one UTF-8 buffer with offsets. All steps work on slices of a few
megabytes, so memory does not grow with the batch; a document above that size is a slice alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def byte_class(ranges: str) -> np.ndarray:
    """Truth per byte; ``ranges`` are pairs of characters, first and last."""
    out = np.zeros(256, bool)
    for a, b in zip(ranges[::2], ranges[1::2]):
        out[ord(a) : ord(b) + 1] = True
    return out


#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing
ALNUM = byte_class("09az")
ALNUM[128:] = True


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
            steps[0] = 1
            have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
        if n > 4 * SLICE_BYTES:
            _powers.pop(base)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit hashes."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(33))
        x = x * np.uint64(0xFF51AFD7ED558CCD)
        x = x ^ (x >> np.uint64(33))
        x = x * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


@dataclass
class Texts:
    """Some documents: ``data[offsets[i]:offsets[i + 1]]`` is document i."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode("utf-8", "replace")

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of bytes in a class: starts, ends and the number per document."""
        n = len(self.data)
        if n == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(self), np.int64)
        on = inside[self.data]
        before = np.empty(n, bool)
        before[0] = False
        before[1:] = on[:-1]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        before[edges] = False
        first = np.flatnonzero(on & ~before)
        after = np.empty(n, bool)
        after[-1] = False
        after[:-1] = on[1:]
        after[edges - 1] = False
        last = np.flatnonzero(on & ~after) + 1
        return first, last, np.diff(np.searchsorted(first, self.offsets))

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each span, from one prefix sum over the bytes."""
        with np.errstate(over="ignore"):
            total = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_BYTE_VALUES[self.data] * _power(_BASE, len(self.data)), out=total[1:])
            return mix((total[ends] - total[starts]) * _power(_INVERSE, len(self.data) + 1)[starts] + (ends - starts).astype(np.uint64))

    def code_points(self) -> np.ndarray:
        """Number of code points before each byte, and in all."""
        out = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=out[1:])
        return out


def windows(hashes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``n`` consecutive words of a document: index of the first word, hash."""
    if len(hashes) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends = np.cumsum(counts)
    left = np.repeat(ends, counts) - np.arange(len(hashes))
    at = np.flatnonzero(left >= n)
    with np.errstate(over="ignore"):
        total = np.zeros(len(hashes) - n + 1, np.uint64)
        for j in range(n):
            total += hashes[j : len(hashes) - n + 1 + j] * np.uint64(pow(_BASE, j + 1, 1 << 64))
    return at, mix(total[at])


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs more than once."""
    order = np.sort(keys)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def member(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in a sorted array, and whether the key is there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return at, sorted_keys[at] == keys


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum per document of values that lie in document order."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "bui" else np.float64)
    np.cumsum(values, out=total[1:])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, end row, texts) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return
    _, offset_buffer, data_buffer = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offset_buffer, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, Texts(data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


def replace_names(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop input columns that an operator is about to add."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def annotate(df: DataFrame, fields: str, kernel: Callable[[], Callable[[Texts], list]], column: str = "text", drop: bool = False) -> DataFrame:
    """Add columns computed from whole texts, row by row, without a shuffle.

    ``kernel()`` is called once in each task and returns a function from ``Texts`` to one list or
    array per field. Input columns of the same name are replaced; ``drop`` leaves the text out.
    """
    added = T._parse_datatype_string(fields)
    if column.lower() not in {f.name.lower() for f in added.fields}:
        df = replace_names(df, [f.name for f in added.fields])
    kept = [f for f in df.schema.fields if f.name.lower() not in {x.name.lower() for x in added.fields} and not (drop and f.name == column)]
    schema = T.StructType([*kept, *added.fields])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in added.fields]
        work = kernel()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(column))
            for first, end, part in slices(texts):
                rest = [batch.column(batch.schema.get_field_index(n)).slice(first, end - first) for n in names]
                new = [x if isinstance(x, pa.Array) else pa.array(x, type=t) for x, t in zip(work(part), types)]
                yield pa.RecordBatch.from_arrays([*rest, *new], names=[*names, *[f.name for f in added.fields]])
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
