"""Statistics over a column, with fixed rules for ties and ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scale import cumulative


def describe(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Population sd, median (mean of the middle two), mean, min and max; nulls are skipped."""
    sums = df.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("sd"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    middle = at_ranks(df, by, value, {"_low": lambda n: F.floor((n - 1) / 2), "_high": lambda n: F.floor(n / 2)})
    middle = middle.select(*[F.col(g).alias(f"_m{i}") for i, g in enumerate(by)], ((F.col("_low") + F.col("_high")) / 2).cast("double").alias("median"))
    on = F.lit(True)
    for i, g in enumerate(by):
        on = on & F.col(g).eqNullSafe(F.col(f"_m{i}"))
    return sums.join(middle, on, "left").select(*by, "n", "mean", "sd", "median", "min", "max")


def argmax(df: DataFrame, by: Sequence[str], label: str, value: str) -> DataFrame:
    """The label with the highest value, the lowest label on a tie."""
    best = F.min(F.struct((-F.col(value)).alias("v"), F.col(label).alias("l")))
    return df.filter(F.col(value).isNotNull()).groupBy(*by).agg(best.alias("b")).select(
        *by, F.col("b.l").alias(label), (-F.col("b.v")).alias(value)
    )


def at_ranks(df: DataFrame, by: Sequence[str], value: str, ranks: dict) -> DataFrame:
    """The values at 0-based ranks per group, each given as a function of the group's size; nulls are skipped.

    Values are counted first; the counts are cut by rank into ranges and summed up to each range, so a group of
    any size and spread is sorted in many tasks.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
    placed = cumulative(counts, [F.col(value)], by, "_c", "_before")
    totals = placed.groupBy(*by).agg(F.sum("_c").alias("_n")).select(*[F.col(g).alias(f"_t{i}") for i, g in enumerate(by)], "_n")
    on = F.lit(True)
    for i, g in enumerate(by):
        on = on & F.col(g).eqNullSafe(F.col(f"_t{i}"))
    # without groups the total is a single row
    joined = placed.join(totals, on) if by else placed.withColumn("_n", totals.scalar())

    def pick(rank) -> Column:
        here = rank(F.col("_n"))
        return F.min(F.when((F.col("_before") <= here) & (here < F.col("_before") + F.col("_c")), F.col(value)))

    return joined.groupBy(*by).agg(*[pick(r).alias(n) for n, r in ranks.items()])


def nearest_rank(df: DataFrame, by: Sequence[str], value: str, percents: dict[str, float]) -> DataFrame:
    """``sorted[min(int(n * p / 100), n - 1)]`` per group."""

    def rank(p: float):
        return lambda n: F.least(F.floor(n * F.lit(p) / 100), n - 1)

    return at_ranks(df, by, value, {name: rank(p) for name, p in percents.items()})


def insert_size_window(q25, q50, q75) -> tuple[Column, Column]:
    """Median -/+ three times the distance to the quartile, at least 1."""
    low = F.greatest(F.lit(1), q50 - 3 * (q50 - q25))
    high = q50 + 3 * (q75 - q50)
    return low, high


def parameter_grid(df: DataFrame, choices: dict[str, Sequence]) -> DataFrame:
    """Every combination of the given values for every row: the lists are literals."""
    out = df
    for name, values in choices.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


def combinations(items: Column, size: int) -> Column:
    """All ``size``-element combinations of a short array, in order, as array of arrays."""
    seed = F.array(F.struct(F.lit(-1).alias("last"), F.array().cast("array<string>").alias("picked")))
    level = seed
    for _ in range(size):
        def extend(state):
            candidates = F.filter(
                F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0))),
                lambda i: (i > state["last"]) & (i < F.size(items)),
            )
            return F.transform(
                candidates,
                lambda i: F.struct(
                    i.alias("last"),
                    F.concat(state["picked"], F.array(F.get(items, i))).alias("picked"),
                ),
            )

        level = F.flatten(F.transform(level, extend))
    return F.transform(level, lambda s: s["picked"])


def permutations(items: Column, size: int) -> Column:
    """All orderings of ``size`` different positions of a short array."""
    level = F.array(F.struct(F.array().cast("array<int>").alias("at"), F.array().cast("array<string>").alias("picked")))
    for _ in range(size):
        def extend(state):
            free = F.filter(
                F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0))),
                lambda i: ~F.array_contains(state["at"], i) & (i < F.size(items)),
            )
            return F.transform(
                free,
                lambda i: F.struct(
                    F.concat(state["at"], F.array(i)).alias("at"),
                    F.concat(state["picked"], F.array(F.get(items, i))).alias("picked"),
                ),
            )

        level = F.flatten(F.transform(level, extend))
    return F.transform(level, lambda s: s["picked"])
