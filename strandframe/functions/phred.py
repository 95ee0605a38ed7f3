"""Base qualities as Column expressions.

Quality strings stay strings where a string function can answer the question:
``ltrim``/``rtrim`` with the set of low characters run inside generated code,
while a lambda over ``split(qual, '')`` does not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import as_col, chars


def phred(qual, offset: int = 33) -> Column:
    """Quality characters -> array of integers."""
    return F.transform(chars(qual), lambda c: F.ascii(c) - F.lit(offset))


def encode_phred(values, offset: int = 33) -> Column:
    """Array of integers -> quality string."""
    return F.array_join(F.transform(as_col(values), lambda q: F.char(q + F.lit(offset))), "")


def numeric_quality(values) -> Column:
    """Array of integers -> blank separated text, as in a quality side file."""
    return F.array_join(F.transform(as_col(values), lambda q: q.cast("string")), " ")


def parse_numeric_quality(text) -> Column:
    """Blank separated numbers -> array of integers."""
    return F.transform(F.split(F.trim(as_col(text)), r"\s+"), lambda q: q.cast("int"))


def quality_sum(qual, offset: int = 33) -> Column:
    q = as_col(qual)
    total = F.aggregate(chars(q), F.lit(0).cast("bigint"), lambda acc, c: acc + F.ascii(c))
    return F.when(F.length(q) > 0, total - F.length(q) * F.lit(offset)).otherwise(F.lit(0).cast("bigint"))


def mean_quality(qual, offset: int = 33) -> Column:
    q = as_col(qual)
    return F.when(F.length(q) > 0, quality_sum(q, offset) / F.length(q)).otherwise(F.lit(0.0))


def low_characters(min_quality: float, offset: int = 33) -> str:
    """Every printable quality character that stands for less than ``min_quality``."""
    top = offset + math.ceil(min_quality)
    return "".join(chr(c) for c in range(33, min(top, 127)))


def mask_bases(seq) -> Column:
    """Dots and lower-case n become N; other bases keep their case."""
    return F.translate(as_col(seq), ".n", "NN")


def mask_qualities(seq, qual, offset: int = 33) -> Column:
    """Quality zero wherever the base is ambiguous."""
    s, q = as_col(seq), as_col(qual)
    zero = chr(offset)
    masked = F.array_join(
        F.zip_with(chars(s), chars(q), lambda b, c: F.when(b.isin(".", "N", "n"), F.lit(zero)).otherwise(c)), ""
    )
    return F.when(s.rlike("[.Nn]"), masked).otherwise(q)


def low_ends(qual, min_quality: float, bases_to_trim: int, offset: int = 33) -> tuple[Column, Column]:
    """How many leading and trailing bases lie below the threshold, at most ``bases_to_trim``."""
    q = as_col(qual)
    low = F.lit(low_characters(min_quality, offset))
    head = F.substring(q, 1, bases_to_trim)
    tail = F.right(q, F.lit(bases_to_trim))
    n5 = F.length(head) - F.length(F.ltrim(head, low))
    n3 = F.length(tail) - F.length(F.rtrim(tail, low))
    return n5, n3


def expanding_low(values, min_quality: float, bases_to_trim: int, patience: int = 5) -> Column:
    """Count the prefixes whose mean is low, among the first ``bases_to_trim``.

    A prefix that passes ends the count only past index ``patience``; one that
    passes earlier is skipped and later failures still count. Positions past the
    end of the read weigh zero.
    """
    # the prefix is cut out once and folded: a lambda that reads ``values`` by index works them out anew at each step
    head = F.slice(F.concat(as_col(values), F.array_repeat(F.lit(0), bases_to_trim)), 1, bases_to_trim)
    start = F.struct(
        F.lit(0).cast("bigint").alias("total"), F.lit(0).alias("i"), F.lit(0).alias("bad"), F.lit(False).alias("done")
    )

    def step(acc, q):
        total = acc["total"] + F.coalesce(q, F.lit(0))
        low = total / (acc["i"] + 1) < F.lit(min_quality)
        return F.struct(
            total.cast("bigint").alias("total"),
            (acc["i"] + 1).alias("i"),
            F.when(~acc["done"] & low, acc["bad"] + 1).otherwise(acc["bad"]).alias("bad"),
            (acc["done"] | (~low & (acc["i"] > F.lit(patience)))).alias("done"),
        )

    zeros = F.array_repeat(F.lit(0), bases_to_trim)
    return F.aggregate(F.coalesce(head, zeros), start, step, lambda acc: acc["bad"])


def solexa_to_phred(values, cap: int = 93) -> Column:
    """Log-odds qualities -> Phred, rounded to nearest, capped."""

    def one(q):
        x = F.lit(10.0) * F.log10(F.lit(1.0) + F.pow(F.lit(10.0), q / F.lit(10.0)))
        return F.least(F.floor(x + F.lit(0.499)), F.lit(cap)).cast("int")

    return F.transform(as_col(values), one)


def shift_offset(qual, from_offset: int, to_offset: int) -> Column:
    return encode_phred(phred(qual, from_offset), to_offset)


def constant_quality(seq, error_rate: float, offset: int = 33) -> Column:
    """One quality for every base from a fixed error rate (natural logarithm)."""
    return F.repeat(F.lit(chr(int(-10 * math.log(error_rate)) + offset)), F.length(as_col(seq)))
