"""Small helpers shared by the expression modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def chars(x) -> Column:
    """String -> array of one-character strings."""
    return F.split(as_col(x), "")


def floor2(x) -> Column:
    """Cut to two decimals; all inputs are non-negative."""
    return F.floor(as_col(x) * 100) / 100


def percent_text(x, digits: int = 3) -> Column:
    """Share rounded to ``digits`` decimals, shown as a percentage."""
    return F.concat(F.format_number(F.round(as_col(x), digits) * 100, max(digits - 2, 0)), F.lit("%"))


def join_sorted(pairs) -> Column:
    """Array of ``struct(pos, txt)`` -> the texts joined in order of position."""
    return F.array_join(F.transform(F.array_sort(as_col(pairs)), lambda p: p["txt"]), "")


def intersect_length(s1, e1, s2, e2) -> Column:
    """Shared length of two closed intervals."""
    return F.greatest(F.lit(0), F.least(as_col(e1), as_col(e2)) - F.greatest(as_col(s1), as_col(s2)) + 1)


def compact(arr) -> Column:
    return F.array_compact(as_col(arr))


def compact_nonzero(arr) -> Column:
    return F.filter(as_col(arr), lambda x: x.isNotNull() & (x != 0))


def first_of_key(entries) -> Column:
    """Map of structs (k, v); of a repeated key the first value counts, a null key is left out."""
    kept = F.filter(as_col(entries), lambda e: e["k"].isNotNull())
    keys = F.transform(kept, lambda e: e["k"])
    return F.map_from_entries(F.filter(kept, lambda e, i: F.array_position(keys, e["k"]) == i + 1))


def keyed(text, outer: str, inner: str) -> Column:
    """``a=1;b=2`` -> map, the first value of a key; a part without ``inner`` has a null value."""
    parts = F.split(as_col(text), outer)
    return first_of_key(F.transform(parts, lambda x: F.struct(
        F.substring_index(x, inner, 1).alias("k"), F.when(x.contains(inner), F.substring(x, F.position(F.lit(inner), x) + len(inner), F.length(x))).alias("v"))))
