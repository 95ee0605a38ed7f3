"""Shards by vector bin packing: bytes, tokens and rows are balanced together.

Rows with equal texts form a group. Groups are hashed into lots, of which there are
``shards * LOTS_PER_SHARD``, a bound that the data cannot move; a group with more than a lot's
share of any dimension is a lot of its own, and one with more than half a shard is dealt in
slices of at most ``1 / SLICES`` of a shard. The lots, largest first, go to the shard where the dot product
of their vector with the residual capacity is highest. Slots number the rows of a shard without
gaps: the lots of a shard one behind the other, and within a lot by row.

A null text has no bytes and no tokens and forms one group with other nulls. Repeated rows get a
slot each. A null id is dealt like any other. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .text import replace_names

LOTS_PER_SHARD = 512
SLICES = 16
ADDED = ["size", "tokens", "text_crc32", "shard", "slot"]


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each lot; ``vectors`` has one row per lot (at most a few ten thousand) and a column per dimension."""
    total = vectors.sum(0)
    need = vectors / np.where(total > 0, total, 1) * shards
    residual = np.ones((shards, vectors.shape[1]))
    out = np.zeros(len(vectors), np.int64)
    for lot in np.lexsort((np.arange(len(need)), -need.max(1))):
        score = residual @ need[lot]
        fits = (residual >= need[lot] - 1e-12).all(1)
        score[~fits] -= 1e6 if fits.any() else 0
        out[lot] = best = int(np.argmax(score))
        residual[best] -= need[lot]
    return out


def shard(docs: DataFrame, shards: int, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """Adds ``size``, ``tokens``, ``text_crc32``, ``shard`` (from 0) and ``slot`` (from 0, gapless).

    The text stays out of every shuffle: the result has the id and the added columns.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(column), F.lit(""))
    rows = replace_names(docs.select(id_column, column), ADDED).select(
        F.col(id_column).alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.regexp_count(text, F.lit(r"[^ \t-\r]+")).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.when(F.col(column).isNull(), F.lit(-1).cast("long")).otherwise(F.xxhash64(column)).alias("group"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = cut_lineage(rows)  # row numbers must stay the same when a task runs again
    totals = rows.agg(F.sum("size"), F.sum("tokens"), F.count("*")).first()
    whole = np.array([float(x or 0) for x in totals])
    lots = shards * LOTS_PER_SHARD
    groups = rows.groupBy("group", "crc", "size").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("n"))
    share = F.greatest(*[F.col(c) / F.lit(w if w else 1.0) for c, w in zip("btn", whole)])
    large = groups.filter(share * lots > 1).withColumn("slices", F.when(share * shards > 0.5, F.ceil(share * shards * SLICES)).otherwise(1).cast("int"))
    # at most three groups per lot's share: a bounded table
    own = large.select(*[F.col(c).alias(f"_{c}") for c in ("group", "crc", "size", "slices")])
    match = [F.col("group") == F.col("_group"), F.col("crc") == F.col("_crc"), F.col("size") == F.col("_size")]
    dealt = rows.join(F.broadcast(own), match, "left").select(
        "id", "size", "tokens", "crc", "row",
        F.when(F.col("_group").isNull(), F.concat(F.lit("h"), F.pmod(F.xxhash64("group", "crc"), F.lit(lots)).cast("string")))
        .otherwise(F.concat_ws(":", F.lit("g"), F.col("group").cast("string"), F.col("crc").cast("string"), F.col("size").cast("string"),
                               F.pmod(F.xxhash64("id", "row"), F.col("_slices").cast("long")).cast("string"))).alias("lot"),
    )
    # at most 4 * lots + 3 * shards * SLICES rows, whatever the data
    table = dealt.groupBy("lot").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("n")).orderBy("lot").toArrow()
    vectors = np.column_stack([table.column(c).to_numpy().astype(float) for c in "btn"]) if len(table) else np.zeros((0, 3))
    target = place(vectors, shards)
    counts = table.column("n").to_numpy()
    offset = np.zeros(len(target), np.int64)
    for s in range(shards):
        own_lots = np.flatnonzero(target == s)
        offset[own_lots] = np.cumsum(counts[own_lots]) - counts[own_lots]
    placed = spark.createDataFrame(
        list(zip(table.column("lot").to_pylist(), target.tolist(), offset.tolist())), "lot string, shard int, _first long"
    )
    within = Window.partitionBy("lot").orderBy(F.col("id").asc_nulls_first(), "row")
    return dealt.withColumn("_n", F.row_number().over(within)).join(F.broadcast(placed), "lot").select(
        F.col("id").alias(id_column), "size", "tokens", F.col("crc").alias("text_crc32"), "shard", (F.col("_first") + F.col("_n") - 1).cast("long").alias("slot")
    )
