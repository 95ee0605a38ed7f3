"""Intervals in bins of several widths.

A feature lies in the smallest bin that holds it, its own bin. A region is covered by the largest bins that fit
between the finest bins of its two ends, so an interval of any length is a few dozen rows. A feature meets a region
either in a covering bin, which holds its own bin, or in a bin that holds an end of the region, which then
is its own bin. Never both, and never twice: nothing has to be made distinct afterwards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the bin widths; each bin holds 32 of the next finer ones.
BITS = tuple(range(12, 43, 5))
STEP = 5
FURTHEST = (1 << (BITS[-1] + STEP)) - 1
NODE = "array<struct<level:int,bin:bigint,covers:boolean>>"


def _node(level: int, bin: Column, covers: bool) -> Column:
    return F.struct(F.lit(level).alias("level"), bin.cast("bigint").alias("bin"), F.lit(covers).alias("covers"))


def _range(level: int, lo: Column, hi: Column) -> Column:
    """Covering bins ``lo`` to ``hi`` - 1 of a level."""
    return F.when(lo < hi, F.transform(F.sequence(lo, hi - 1), lambda x: _node(level, x, True))).otherwise(F.array().cast(NODE))


def region_nodes(beg: Column, end: Column) -> Column:
    """Bins over both ends of [beg, end], and those that cover what lies between."""
    beg, end = (F.least(x.cast("bigint"), F.lit(FURTHEST)) for x in (beg, F.greatest(end, beg)))
    ends = [_node(k, F.shiftright(x, b), False) for k, b in enumerate(BITS) for x in (beg, end)]
    ends.append(_node(len(BITS), F.lit(0), False))
    first, last = F.shiftright(beg, BITS[0]) + 1, F.shiftright(end, BITS[0])

    def inside(k: int) -> tuple[Column, Column]:
        """The bins of level ``k`` that lie between the ends: from, and up to but without."""
        return F.shiftright(first + ((1 << STEP * k) - 1), STEP * k), F.shiftright(last, STEP * k)

    parts = []
    for k in range(len(BITS)):
        lo, hi = inside(k)
        if k == len(BITS) - 1:
            parts.append(_range(k, lo, hi))
            break
        # without those that a bin of the next level holds
        up, down = inside(k + 1)
        whole = up < down
        parts += [_range(k, lo, F.when(whole, F.shiftleft(up, STEP)).otherwise(hi)), _range(k, F.when(whole, F.shiftleft(down, STEP)).otherwise(hi), hi)]
    return F.concat(F.array_distinct(F.array(*ends)), *parts)


def feature_nodes(beg: Column, end: Column, used: Column) -> Column:
    """The feature's own bin, and those around it of the levels in ``used``."""
    beg, end = (F.least(x.cast("bigint"), F.lit(FURTHEST)) for x in (beg, F.greatest(end, beg)))
    lower, upper = ([F.shiftright(x, b) for b in BITS] for x in (beg, end))
    own = reduce(lambda rest, k: F.when(lower[k] == upper[k], k).otherwise(rest), reversed(range(len(BITS))), F.lit(len(BITS)))
    every = F.array(*[_node(k, x, False) for k, x in enumerate(lower)], _node(len(BITS), F.lit(0), False))
    kept = F.filter(every, lambda x: (x["level"] == own) | ((x["level"] > own) & F.array_contains(used, x["level"])))
    return F.transform(kept, lambda x: F.struct(x["level"].alias("level"), x["bin"].alias("bin"), (x["level"] == own).alias("own")))


def couples(features: DataFrame, regions: DataFrame, place: tuple[str, str, str]) -> DataFrame:
    """Features with the closed regions (_name, r_beg, r_end) that share a base with them."""
    name, beg, end = place
    spread = regions.withColumn("_r", F.explode(region_nodes(F.col("r_beg"), F.col("r_end")))).select("_name", "r_beg", "r_end", "_r.*")
    used = spread.filter("covers").agg(F.collect_set("level")).scalar()
    left = features.withColumn("_used", used)
    left = left.withColumn("_f", F.explode(feature_nodes(F.col(beg), F.col(end), F.col("_used"))))
    on = (
        (F.col(name) == F.col("_name")) & (F.col("_f.level") == F.col("level")) & (F.col("_f.bin") == F.col("bin"))
        & (F.col("covers") | F.col("_f.own")) & (F.col(beg) <= F.col("r_end")) & (F.col(end) >= F.col("r_beg"))
    )
    return left.join(spread, on).select(*[left[f"`{c}`"] for c in features.columns], "r_beg", "r_end")


def touched(rows: DataFrame, place: tuple[str, str, str], bits: int) -> DataFrame:
    """(name, bin): the bins of one width that a closed interval touches."""
    name, beg, end = place
    bins = F.sequence(F.shiftright(F.col(beg).cast("bigint"), bits), F.shiftright(F.col(end).cast("bigint"), bits))
    return rows.select(F.col(name).alias("_name"), F.explode(bins).alias("_bin")).distinct()
