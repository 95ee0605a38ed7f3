"""Sequences as ordered pieces, addressed by place.

A piece table has a row per (name, piece): letters ``piece * width + 1`` to ``(piece + 1) * width`` of
the sequence ``name`` (unique), and ``size``, the length of the whole. What is asked of a sequence is asked of the
pieces it touches, so no row and no join ever holds a whole chromosome beside a gene or a read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dna

#: Letters of a piece; divisible by three, so frames keep their phase from piece to piece.
WIDTH = 3 << 12


def cut(contigs: DataFrame, name: str = "name", columns: Sequence[str] = ("seq",), width: int = WIDTH, edge: int = 0) -> DataFrame:
    """(name, size, piece, the texts of ``columns``); all columns of a row are of one length.

    With ``edge``, also ``before`` and ``after``: that many letters around the piece, of the first column.
    An empty sequence has no pieces.
    """
    texts = contigs.select(name, F.length(columns[0]).cast("bigint").alias("size"), *[dna.pieces(c, width).alias(c) for c in columns])
    fields = [F.col(c) for c in columns]
    if edge:
        first = F.col(columns[0])
        behind = F.transform(first, lambda x: F.right(x, F.lit(edge)))
        ahead = F.transform(first, lambda x: F.left(x, F.lit(edge)))
        fields += [F.concat(F.array(F.lit("")), behind).alias("before"), F.slice(ahead, 2, F.greatest(F.size(ahead), F.lit(1))).alias("after")]
    rows = texts.select(name, "size", F.posexplode(F.arrays_zip(*fields)).alias("piece", "_x")).filter("piece * {} < size".format(width))
    out = [F.col(f"_x.{c}").alias(c) for c in columns]
    out += [F.coalesce(F.col(f"_x.{c}"), F.lit("")).alias(c) for c in ("before", "after") if edge]
    return rows.select(name, "size", F.col("piece").cast("bigint").alias("piece"), *out)


def join_pieces(pieces: DataFrame, name: str = "name", columns: Sequence[str] = ("seq",)) -> DataFrame:
    """One row per sequence, for callers that need it whole."""
    packed = F.array_sort(F.collect_list(F.struct("piece", *columns)))
    return pieces.groupBy(name).agg(packed.alias("_p")).select(name, *[F.array_join(F.col(f"_p.{c}"), "").alias(c) for c in columns])


def fetch(requests: DataFrame, pieces: DataFrame, place: tuple[str, str, str], outputs: Sequence[str] = ("seq",),
          columns: Sequence[str] = ("seq",), name: str = "name", width: int = WIDTH) -> DataFrame:
    """Adds the text of the closed, 1-based range (name, beg, end) of each request as ``outputs``.

    A range is cut to its sequence; one that lies outside, or of an unknown sequence, is empty. Requests are
    folded to distinct ranges first, a range is exploded over the pieces that it touches, and its parts are put
    together in order, so what a task holds is as long as the longest range.
    """
    who, beg, end = place
    asked = requests.select(F.col(who).alias("_name"), F.col(beg).cast("bigint").alias("_beg"), F.col(end).cast("bigint").alias("_end")).distinct()
    sizes = pieces.filter("piece = 0").select(F.col(name).alias("_n"), "size")
    inside = asked.join(sizes, F.col("_name") == F.col("_n")).select(
        "_name", "_beg", "_end", F.greatest("_beg", F.lit(1)).alias("_lo"), F.least("_end", "size").alias("_hi")).filter("_lo <= _hi")

    def at(c):
        return F.floor((F.col(c) - 1) / width)

    each = inside.withColumn("_piece", F.explode(F.sequence(at("_lo"), at("_hi"))))
    held = pieces.select(F.col(name).alias("_n"), F.col("piece").alias("_p"), *[F.col(c).alias(f"_t{i}") for i, c in enumerate(columns)])
    met = each.join(held, (F.col("_name") == F.col("_n")) & (F.col("_piece") == F.col("_p")))
    lo = F.greatest(F.col("_lo") - F.col("_piece") * width, F.lit(1))
    size = F.least(F.col("_hi") - F.col("_piece") * width, F.lit(width)) - lo + 1
    parts = [F.substr(f"_t{i}", lo.cast("int"), size.cast("int")).alias(f"x{i}") for i in range(len(columns))]
    # dealt before they are put together, else the aggregate would sort rows that hold whole pieces
    met = met.select("_name", "_beg", "_end", "_piece", *parts).repartition("_name", "_beg", "_end")
    packed = F.array_sort(F.collect_list(F.struct("_piece", *[f"x{i}" for i in range(len(columns))])))
    texts = met.groupBy("_name", "_beg", "_end").agg(packed.alias("_x")).select(
        F.col("_name").alias("__who"), F.col("_beg").alias("__from"), F.col("_end").alias("__to"), *[F.array_join(F.col(f"_x.x{i}"), "").alias(f"__t{i}") for i in range(len(columns))])
    on = (F.col(who) == F.col("__who")) & (F.col(beg) == F.col("__from")) & (F.col(end) == F.col("__to"))
    kept = [c for c in requests.columns if c not in outputs]
    return requests.join(texts, on, "left").select(*[requests[f"`{c}`"] for c in kept], *[F.coalesce(f"__t{i}", F.lit("")).alias(o) for i, o in enumerate(outputs)])


def splice(features: DataFrame, pieces: DataFrame, places: str = "places", who: str = "seqname", strand: str = "strand",
           out: str = "nt", name: str = "name") -> DataFrame:
    """Adds the joined text of each feature's intervals (array of (lo, hi)), reverse-complemented as a whole on '-'.

    Intervals are joined in the order given, which is ascending on both strands.
    """
    spans = features.select(F.col(who).alias("_w"), F.col(places).alias("_all")).distinct()
    each = spans.select("_w", "_all", F.posexplode("_all").alias("_i", "_x")).select("_w", "_all", "_i", "_x.lo", "_x.hi")
    cutouts = fetch(each, pieces, ("_w", "lo", "hi"), ["_s"], name=name)
    packed = F.array_sort(F.collect_list(F.struct("_i", "_s")))
    texts = cutouts.groupBy("_w", "_all").agg(packed.alias("_p")).select("_w", "_all", F.array_join("_p._s", "").alias("_t"))
    met = features.join(texts, (F.col(who) == F.col("_w")) & (F.col(places) == F.col("_all")), "left")
    text = F.coalesce("_t", F.lit(""))
    return met.withColumn(out, F.when(F.col(strand) == "-", dna.reverse_complement(text)).otherwise(text)).drop("_w", "_all", "_t")


def lay_end_to_end(parts: DataFrame, name: str, start: str, text: str, width: int = WIDTH) -> DataFrame:
    """Pieces of sequences that are given as parts with their 1-based ``start``, one after the other.

    Each part is cut where the pieces of the whole are cut; a piece is joined from the parts in it, which are no
    more than it has letters.
    """
    skip = F.pmod(F.col(start) - 1, F.lit(width)).cast("int")
    moved = dna.pieces(F.concat(F.repeat(F.lit(" "), skip), F.col(text)), width)
    rows = parts.filter(F.length(text) > 0).select(name, F.col(start).alias("_start"), F.posexplode(moved).alias("_i", "_t"))
    rows = rows.select(name, (F.floor((F.col("_start") - 1) / width) + F.col("_i")).alias("piece"), "_start", "_i", F.ltrim("_t").alias("_t"))
    packed = F.array_sort(F.collect_list(F.struct("_start", "_i", "_t")))
    return rows.groupBy(name, "piece").agg(packed.alias("_p")).select(name, "piece", F.array_join("_p._t", "").alias("seq"))


# --- scans that go on from piece to piece ---------------------------------------------------------


def linked(rows: DataFrame, group: Sequence[str], goes_on: Column, name: str = "run") -> DataFrame:
    """Numbers runs of rows in order of ``at``; ``goes_on`` (with ``lag``) says that a row belongs to the one before.

    The rows are what pieces report about themselves, a few for each piece.
    """
    order = Window.partitionBy(*group).orderBy("at")
    marked = rows.withColumn("_lag_end", F.lag(F.col("at") + F.col("len")).over(order))
    if "closed" in rows.columns:
        marked = marked.withColumn("_lag_closed", F.lag("closed").over(order))
    marked = marked.withColumn("_new", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    return marked.withColumn(name, F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))


def kept_matches(text: Column, pattern: str, wanted, fields: dict) -> Column:
    """The matches of ``pattern``, which cover the text, that ``wanted(match, at)`` keeps, with their 0-based place.

    ``fields`` maps further names of the structs to functions of (match, at) and a type.
    """
    kind = "array<struct<at:int,len:int" + "".join(f",{n}:{t}" for n, (_, t) in fields.items()) + ">>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("kept"))

    def step(acc, x):
        own = F.array(F.struct(acc["at"].alias("at"), F.length(x).alias("len"), *[f(x, acc["at"]).alias(n) for n, (f, _) in fields.items()]))
        return F.struct((acc["at"] + F.length(x)).alias("at"), F.when(wanted(x, acc["at"]), F.concat(acc["kept"], own)).otherwise(acc["kept"]).alias("kept"))

    found = F.filter(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.length(x) > 0)
    return F.aggregate(found, zero, step, lambda acc: acc["kept"])


def split_at_runs(pieces: DataFrame, letters: str, min_len: int, key: str, columns: Sequence[str] = ("seq",), width: int = WIDTH) -> DataFrame:
    """(key, i, start, end and the texts) of what runs of at least ``min_len`` ``letters`` leave.

    A run at the start goes whatever its length. ``i`` counts the cuts before a part. A piece reports its long
    runs and those at its edges; runs that meet at an edge are joined.
    """
    n = F.length(columns[0])
    runs = kept_matches(
        F.col(columns[0]), f"[{letters}]+|[^{letters}]+",
        lambda x, at: x.rlike(f"^[{letters}]") & ((F.length(x) >= min_len) | (at == 0) | (at + F.length(x) == n)), {})
    rows = pieces.select(key, "piece", F.explode(runs).alias("o")).select(key, (F.col("piece") * width + F.col("o.at")).alias("at"), F.col("o.len").cast("bigint").alias("len"))
    joined = linked(rows, [key], F.col("_lag_end") == F.col("at")).groupBy(key, "run").agg(F.min("at").alias("beg"), F.max(F.col("at") + F.col("len")).alias("end"))
    gaps = joined.filter((F.col("end") - F.col("beg") >= min_len) | (F.col("beg") == 0)).select(key, "beg", "end")
    ends = pieces.filter("piece = 0").select(key, F.col("size").alias("beg"), F.col("size").alias("end"))
    order = Window.partitionBy(key).orderBy("beg", "end")
    cuts = F.count_if(F.col("beg") > 0).over(order.rowsBetween(Window.unboundedPreceding, -1))
    parts = gaps.unionByName(ends).select(
        key, F.coalesce(cuts, F.lit(0)).alias("i"), (F.coalesce(F.lag("end").over(order), F.lit(0)) + 1).alias("start"), F.col("beg").alias("end")).filter("start <= end")
    return fetch(parts, pieces, (key, "start", "end"), list(columns), columns, key, width)
