"""Numbering and running totals that never put one group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

Order = Sequence[Column | tuple[Column, bool]]


def _sorted(columns: Sequence[str], rising: Sequence[bool]) -> list[Column]:
    return [F.col(c).asc() if up else F.col(c).desc() for c, up in zip(columns, rising)]


def cumulative(counts: DataFrame, order: Sequence[Column], within: Sequence[str], amount: str, name: str) -> DataFrame:
    """Adds the sum of ``amount`` over the rows before, per ``within`` group; one row per (within, order).

    The order may be of any kind and spread: range partitioning cuts it by rank, so a group of any size is spread over
    tasks and no task sorts more than one partition. Only these narrow rows are checkpointed, to keep the partition
    ids that the totals refer to when an executor is lost.
    """
    keys = [F.col(g) for g in within]
    laid_out = counts.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    laid_out = cut_lineage(laid_out.withColumn("_part", F.spark_partition_id()))
    totals = laid_out.groupBy("_part", *within).agg(F.sum(amount).alias("_t"))
    # one row per partition, or per partition and group
    earlier = (Window.partitionBy(*within) if within else Window).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(within)], F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_off"))
    on = F.col("_part") == F.col("_p")
    for i, g in enumerate(within):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    inside = Window.partitionBy("_part", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = laid_out.join(offsets, on).withColumn(name, F.col("_off") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return sums.select(*counts.columns, name)


def number_rows(df: DataFrame, order_by: Order, within: Sequence[str] = (), name: str = "n", first: int = 1) -> DataFrame:
    """Running number in the given order, restarting per ``within`` group; (column, False) stands for falling order.

    Only the distinct values of the order columns are laid out and counted; whole rows meet their number in one
    join. Rows that tie on all of them are numbered by a hash of the row.
    """
    pairs = [o if isinstance(o, tuple) else (o, True) for o in order_by]
    rising, marks = [up for _, up in pairs], [f"_o{i}" for i in range(len(pairs))]
    keyed = df.withColumns({m: o for m, (o, _) in zip(marks, pairs)})
    counts = keyed.groupBy(*within, *marks).agg(F.count("*").alias("_c"))
    starts = cumulative(counts, _sorted(marks, rising), within, "_c", "_before")
    both = [*within, *marks]
    starts = starts.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(both)], "_before")
    on = F.lit(True)
    for i, c in enumerate(both):
        on = on & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    hashed = F.xxhash64(*[f"`{f.name}`" for f in df.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"])
    ties = F.row_number().over(Window.partitionBy(*both).orderBy(hashed))
    return keyed.join(starts, on).select(*df.columns, (F.col("_before") + ties + F.lit(first - 1)).cast("bigint").alias(name))


def running_sum(
    df: DataFrame,
    group: Sequence[str],
    position: str,
    values: dict[str, str],
    width: int = 1 << 14,
    descending: bool = False,
) -> DataFrame:
    """Cumulative sums along ``position`` in two levels.

    ``values`` maps output name -> input column. ``df`` holds one row per
    (group, position). Totals of ``width`` wide buckets are summed first, so a
    task sorts at most ``width`` rows of a group, however long the group is.
    """
    bucketed = df.withColumn("_bucket", F.floor(F.col(position) / F.lit(width)))
    totals = bucketed.groupBy(*group, "_bucket").agg(*[F.sum(v).alias(f"_t_{o}") for o, v in values.items()])
    order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    earlier = (
        Window.partitionBy(*group).orderBy(order) if group else Window.orderBy(order)
    ).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *group, "_bucket", *[F.coalesce(F.sum(f"_t_{o}").over(earlier), F.lit(0)).alias(f"_b_{o}") for o in values]
    )
    pos = F.col(position).desc() if descending else F.col(position).asc()
    inside = Window.partitionBy(*group, "_bucket").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    joined = bucketed.join(totals, [*group, "_bucket"])
    return joined.select(
        *df.columns, *[(F.col(f"_b_{o}") + F.sum(v).over(inside)).alias(o) for o, v in values.items()]
    )


def number_records(df: DataFrame, key: Sequence[str], order: Sequence[Column], name: str = "n", most: int = 1 << 16) -> DataFrame:
    """``number_within`` for keys of a few rows each: their rows are moved once and numbered where they meet.

    Keys of more than ``most`` rows, found by a count, are numbered by ranges.
    """
    large = df.groupBy(*key).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > most).select(*[F.col(c).alias(f"_l{i}") for i, c in enumerate(key)])
    hashed = F.xxhash64(*[f"`{f.name}`" for f in df.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"])
    one = F.row_number().over(Window.partitionBy(*key).orderBy(*order, hashed)).cast("bigint").alias(name)
    if large.isEmpty():
        return df.select("*", one)
    on = F.lit(True)
    for i, c in enumerate(key):
        on = on & F.col(c).eqNullSafe(F.col(f"_l{i}"))
    few, many = df.join(F.broadcast(large), on, "left_anti"), df.join(F.broadcast(large), on, "left_semi")
    return few.select("*", one).unionByName(number_within(many, key, order, name))


def number_within(df: DataFrame, key: Sequence[str], order: Sequence[Column], name: str = "n") -> DataFrame:
    """``row_number`` per key by range partitioning, so a key of any size is spread over tasks."""
    return number_rows(df, order, within=key, name=name)


def concat_in_parts(
    df: DataFrame, key: Sequence[str], order: Sequence[Column], value: str, sep: str, name: str, part_size: int = 10_000
) -> DataFrame:
    """Values of a key joined in order; after ``part_size`` values a further row (``part`` 1, 2, ...) goes on."""
    numbered = number_within(df, key, order, name="_n").withColumn("part", F.floor((F.col("_n") - 1) / part_size).cast("int"))
    packed = F.array_sort(F.collect_list(F.struct("_n", F.col(value).alias("v"))))
    return numbered.groupBy(*key, "part").agg(F.array_join(F.transform(packed, lambda x: x["v"]), sep).alias(name))


def carry_forward(df: DataFrame, group: Sequence[str], order: str, column: str, width: int = 1 << 14) -> DataFrame:
    """The last non-null ``column`` at or before each row, in two levels as ``running_sum``."""
    bucketed = df.withColumn("_bucket", F.floor(F.col(order) / F.lit(width)))
    known = F.when(F.col(column).isNotNull(), F.col(order))
    per = bucketed.groupBy(*group, "_bucket").agg(F.max_by(column, known).alias("_last"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*group, "_bucket", F.last("_last", ignorenulls=True).over(before).alias("_before"))
    inside = Window.partitionBy(*group, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = bucketed.join(per, [*group, "_bucket"])
    filled = F.coalesce(F.last(column, ignorenulls=True).over(inside), F.col("_before"))
    return joined.withColumn(column, filled).select(*df.columns)


def even_parts(df: DataFrame) -> DataFrame:
    """Rows dealt into parts of the size that adaptive execution advises, however long the splits of the input are.

    An aggregate sorts or hashes its part before the shuffle, so this is what bounds the memory of a task.
    """
    return df.hint("rebalance")


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key as a partial aggregate (``min`` of a struct), no sort."""
    rest = [c for c in df.columns if c not in key]
    # a column that is part of the order as it is travels once
    held = {c: f"__ord{i}" for i, o in enumerate(order) for c in rest if str(o) == str(F.col(c))}
    packed = F.min(F.struct(*[o.alias(f"__ord{i}") for i, o in enumerate(order)], *[c for c in rest if c not in held])).alias("_row")
    return df.groupBy(*key).agg(packed).select(*key, *[F.col(f"_row.{held.get(c, c)}").alias(c) for c in rest]).select(*df.columns)
