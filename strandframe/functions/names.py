"""Read and hit names, headers and descriptions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import as_col


def field(parts: Column, i: int) -> Column:
    return F.coalesce(F.get(parts, F.lit(i)), F.lit(""))


def sra_mates(id1, id2) -> Column:
    """Three blank-separated words, equal coordinates in the second one."""
    a, b = F.split(as_col(id1), r"\s+"), F.split(as_col(id2), r"\s+")
    u, v = F.split(field(a, 1), ":"), F.split(field(b, 1), ":")
    same = F.lit(True)
    for i in range(7):
        same = same & (field(u, i) == field(v, i))
    return (field(a, 2) != "") & same


def _member(parts: Column) -> Column:
    return field(F.split(field(parts, 6), r"\s+"), 1)


def casava18_mates(id1, id2) -> Column:
    """Colon fields with the mate number after the last coordinate."""
    u, v = F.split(as_col(id1), ":"), F.split(as_col(id2), ":")
    m1, m2 = _member(u), _member(v)
    same = F.lit(True)
    for i in (0, 1, 2, 4):
        same = same & (field(u, i) == field(v, i))

    def number(m):
        return F.coalesce(m.try_cast("int"), F.lit(-1))

    return ((m1 != "") | (m2 != "")) & same & (number(m1) < number(m2))


def trailing_digit_mates(id1, id2) -> Column:
    """Both names end in digits, the first lower than the second, neither above 9."""
    def last(x):
        return F.regexp_extract(as_col(x), r"(\d+)$", 1)

    a, b = last(id1), last(id2)
    na, nb = a.try_cast("bigint"), b.try_cast("bigint")
    return (a != "") & (b != "") & F.coalesce((na < nb) & (na <= 9) & (nb <= 9), F.lit(False))


def lane_of(name) -> Column:
    """The number between the first two colons, 0 when there is none."""
    text = F.regexp_extract(as_col(name), r"^[^:]*:\s*(\d+)[^:]*:", 1)
    return F.coalesce(text.try_cast("int"), F.lit(0))


def strip_mate_suffix(name) -> Column:
    """Drop a last digit and the non-digit before it."""
    n = as_col(name)
    return F.when(F.length(n) < 3, n).otherwise(F.regexp_replace(n, r"\D\d$", ""))


def keep_share(key, share: float) -> Column:
    """Repeatable sampling: true for about ``share`` of the keys, by their md5."""
    number = F.conv(F.substring(F.md5(as_col(key).cast("string")), 1, 7), 16, 10).cast("bigint")
    return number < F.lit(int(share * 16**7))


def keep_below(key, share: Column) -> Column:
    """As ``keep_share`` with the share taken from the data."""
    number = F.conv(F.substring(F.md5(as_col(key).cast("string")), 1, 7), 16, 10).cast("bigint")
    return number < F.floor(share * F.lit(float(16**7)))


def gene_and_product(description) -> tuple[Column, Column]:
    """``GN=`` with 3 to 8 word characters, and the text before the first ``key=``."""
    d = as_col(description)
    gene = F.regexp_extract(d, r"GN=(\w{3,8})\b", 1)
    product = F.trim(F.regexp_extract(d, r"^(.*?)(?:\s+\w+=|$)", 1))
    return F.nullif(gene, F.lit("")), F.nullif(product, F.lit(""))


def resistance_parts(name) -> Column:
    """``(class)gene:hit:coords:len`` -> struct."""
    n = as_col(name)
    pattern = r"^\(([^)]*)\)([^:]+):([^:]*):([^:]*):(.*)$"
    names = ("drug_class", "gene", "hit", "coords", "length")
    return F.struct(*[F.nullif(F.regexp_extract(n, pattern, i + 1), F.lit("")).alias(c) for i, c in enumerate(names)])


def natural_key(name) -> Column:
    """Sort key in which runs of digits compare as numbers: their length, then the digits."""
    pieces = F.regexp_extract_all(as_col(name), F.lit(r"\d+|\D+"), F.lit(0))

    def pad(p):
        bare = F.regexp_replace(p, "^0+(?=.)", "")
        return F.when(p.rlike(r"^\d"), F.concat(F.lpad(F.length(bare).cast("string"), 10, "0"), bare)).otherwise(p)

    return F.array_join(F.transform(pieces, pad), "")
