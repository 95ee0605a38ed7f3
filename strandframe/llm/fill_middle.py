"""Fill-in-the-middle examples: a text cut at two unit borders and put in another order.

A unit is a run of ASCII letters or one other code point. The borders are found on 64-bit words of
the UTF-8 bytes: arithmetic on a word marks the last byte of each unit with its high bit, a population
count gives the units per word, a search in the running counts finds the word of a border, and a
multiplication finds the byte inside the word. Nothing is decoded, and nothing is shuffled.

Null counts as an empty text, which is always ``plain``; a null key is hashed as an empty one.
Repeated rows are cut alike, as the cut depends on the key and the text alone. Input columns whose
names clash with an added one are replaced. A text of any length is one slice of its own, and takes
about eight times its size while it is cut. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import Texts, replace_names, slices

#: Marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)

HIGH = np.uint64(0x8080808080808080)
ONES = np.uint64(0x0101010101010101)
LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)


def _letters(x: np.ndarray) -> np.ndarray:
    """High bit of each byte that is an ASCII letter."""
    folded = (x | (ONES * np.uint64(0x20))) & LOW7
    from_a = folded + ONES * np.uint64(0x80 - ord("a"))
    past_z = folded + ONES * np.uint64(0x80 - ord("z") - 1)
    return from_a & ~past_z & ~x & HIGH


def _continued(x: np.ndarray) -> np.ndarray:
    """High bit of each byte 10xxxxxx, which goes on with a code point."""
    return x & ~(x << np.uint64(1)) & HIGH


def _next_bytes(mark: np.ndarray) -> np.ndarray:
    """The marks of the byte after each byte, across words."""
    out = mark >> np.uint64(8)
    out[:-1] |= mark[1:] << np.uint64(56)
    return out


class Units:
    """The unit ends of some texts, one bit per byte, with running counts per word."""

    def __init__(self, texts: Texts):
        n = len(texts.data)
        padded = np.zeros(n // 8 * 8 + 16, np.uint8)
        padded[:n] = texts.data
        x = padded.view("<u8")
        letter = _letters(x)
        ends = ~_next_bytes(_continued(x)) & ~(letter & _next_bytes(letter)) & HIGH
        marks = ends.view(np.uint8)
        marks[n:] = 0
        last = texts.offsets[1:][np.diff(texts.offsets) > 0] - 1
        marks[last] = 0x80  # the next byte is another text's
        self.ends = ends
        self.before = np.zeros(len(ends) + 1, np.int64)
        np.cumsum(np.bitwise_count(ends), out=self.before[1:])

    def up_to(self, byte: np.ndarray) -> np.ndarray:
        """Number of unit ends before a byte."""
        word, inside = byte >> 3, (byte & 7).astype(np.uint64)
        mask = (np.uint64(1) << (inside * np.uint64(8))) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.ends[word] & mask).astype(np.int64)

    def after(self, rank: np.ndarray) -> np.ndarray:
        """The byte behind the ``rank``-th unit end, counted from 1."""
        word = np.searchsorted(self.before, rank, "left") - 1
        left = (rank - self.before[word]).astype(np.uint64)
        # byte j of ``counts`` holds the unit ends in bytes 0 to j of the word
        counts = (self.ends[word] >> np.uint64(7)) * ONES
        reached = np.bitwise_count(((counts | HIGH) - left * ONES) & HIGH).astype(np.int64)
        return word * 8 + 9 - reached


def _borders(texts: Texts, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units per text, and the bytes where prefix and middle end, from two draws per text."""
    units = Units(texts)
    start = texts.offsets[:-1]
    base = units.up_to(start)
    n = units.up_to(texts.offsets[1:]) - base
    a, b = first % (n + 1), second % (n + 1)
    cuts = []
    for k in (np.minimum(a, b), np.maximum(a, b)):
        cut = start.copy()
        some = k > 0
        cut[some] = units.after((base + k)[some])
        cuts.append(cut)
    return n, *cuts


def draws(key: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the hash of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


ADDED = "n_units long, prefix string, middle string, suffix string"
DRAWS = "_fill_middle_draws"


def _cut(rows: DataFrame) -> DataFrame:
    """The units of each text and its three parts; the draws are used up."""
    added = T._parse_datatype_string(ADDED)
    kept = [f for f in rows.schema.fields if f.name != DRAWS]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column(batch.schema.get_field_index(DRAWS)).flatten().to_numpy().reshape(-1, 2)
            for row, end, texts in slices(batch.column(batch.schema.get_field_index("text"))):
                n, a, b = _borders(texts, *both[row:end].T)
                whole, at = texts.data.tobytes(), texts.offsets
                parts = [[whole[i:j] for i, j in zip(x, y)] for x, y in ((at[:-1], a), (a, b), (b, at[1:]))]
                new = [pa.array(n, pa.int64()), *[pa.array(p, pa.binary()).cast(pa.string()) for p in parts]]
                rest = [batch.column(batch.schema.get_field_index(c)).slice(row, end - row) for c in names]
                yield pa.RecordBatch.from_arrays([*rest, *new], names=[*names, *added.names])
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, T.StructType([*kept, *added.fields]))


def fill_middle(docs: DataFrame, key: str = "doc_id", seed: int = 1, plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """Adds ``n_units``, ``form`` (plain, psm or spm), ``prefix``, ``middle``, ``suffix`` and ``output``.

    The three parts are null in plain rows. A text that holds a mark stays plain, so that ``restore`` is exact.
    """
    rows = replace_names(docs, ["n_units", "form", "prefix", "middle", "suffix", "output"])
    names = [f"`{c}`" for c in rows.columns]
    h = draws(F.col(f"`{key}`"), seed)
    cut = _cut(rows.withColumns({"text": F.coalesce("text", F.lit("")), DRAWS: F.array(h[0], h[1])}))
    marked = F.lit(False)
    for m in MARKS:
        marked = marked | F.contains("text", F.lit(m))
    plain = (F.col("text") == "") | marked | (h[2] % 100 >= 100 - plain_percent)
    cut = cut.withColumn("form", F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm"))
    order = {"psm": ((PREFIX, "prefix"), (SUFFIX, "suffix")), "spm": ((SUFFIX, "suffix"), (PREFIX, "prefix"))}
    output = F.when(F.col("form") == "plain", F.col("text"))
    for form, parts in order.items():
        output = output.when(F.col("form") == form, F.concat(*[x for m, c in (*parts, (MIDDLE, "middle")) for x in (F.lit(m), F.col(c))]))
    given = [F.when(F.col("form") != "plain", F.col(c)).alias(c) for c in ("prefix", "middle", "suffix")]
    return cut.select(*names, "n_units", "form", *given, output.alias("output"))


def restore(output, form) -> Column:
    """The text that ``fill_middle`` was given. Marks never occur inside a part, so they split exactly."""
    parts = F.split(output, "|".join(MARKS))
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
