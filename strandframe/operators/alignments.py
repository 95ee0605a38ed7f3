"""Alignment tables: filter, mate, de-duplicate, count, compare and convert.

Alignments are rows of (qname, flag, rname, pos, mapq, cigar, rnext, pnext, tlen,
seq, qual, rg, tags ...), positions 1-based; an operator uses the columns it needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cigar as cg
from ..functions import dna, names, phred as ph
from ..functions.common import intersect_length
from ..session import cut_lineage
from . import bins
from .scale import even_parts, first_per_key, number_records, running_sum

BIN_BITS = 14
#: A library of up to so many read groups is broadcast; beyond it the join shuffles.
GROUPS_TO_BROADCAST = 10_000
#: Heads of one place that one task judges.
PLACE_HEADS = 1 << 16


def view(df: DataFrame, min_mapq: int = 0, required: int = 0, excluded: int = 0,
         groups: Sequence[str] | None = None, library: str | None = None,
         read_groups: DataFrame | None = None) -> DataFrame:
    """Filter by mapping quality, flag bits, read groups and library.

    Records without a read group pass the group filter.
    """
    out = df.filter((F.col("mapq") >= min_mapq) & cg.has("flag", required) & cg.lacks("flag", excluded))
    if groups is not None:
        out = out.filter(F.col("rg").isNull() | F.col("rg").isin(*groups))
    if library is not None:
        members = cut_lineage(read_groups.filter(F.col("library") == library).select("rg").distinct())
        # a few read groups hold all records, so a shuffle by read group would put them into a few tasks
        few = members.limit(GROUPS_TO_BROADCAST + 1).count() <= GROUPS_TO_BROADCAST
        out = out.join(F.broadcast(members) if few else members, "rg", "left_semi")
    return out


def with_library(df: DataFrame, read_groups: DataFrame) -> DataFrame:
    """Library of each record from the header's read groups; records are not moved to meet a few of these."""
    groups = cut_lineage(read_groups.select("rg", "library"))
    few = groups.limit(GROUPS_TO_BROADCAST + 1).count() <= GROUPS_TO_BROADCAST
    return df.join(F.broadcast(groups) if few else groups, "rg", "left")


def tag_values(df: DataFrame, tag: str) -> DataFrame:
    return df.select("qname", F.col("tags")[tag].alias("value")).filter(F.col("value").isNotNull())


def alignment_end(pos="pos", cigar="cigar") -> Column:
    return F.col(pos) + cg.reference_span(cigar) - 1


def to_bed(df: DataFrame) -> DataFrame:
    """0-based half-open rows of mapped records."""
    return df.filter(cg.lacks("flag", cg.UNMAPPED)).select(
        F.col("rname").alias("chrom"),
        (F.col("pos") - 1).alias("beg"),
        alignment_end().alias("end"),
        F.col("qname").alias("name"),
        F.col("mapq").alias("score"),
        F.when(cg.has("flag", cg.REVERSE), F.lit("-")).otherwise(F.lit("+")).alias("strand"),
    )


def unmapped_reads(df: DataFrame) -> DataFrame:
    return df.filter(cg.has("flag", cg.UNMAPPED))


def stripe(df: DataFrame, n: int) -> DataFrame:
    """Rows dealt round robin over ``n`` outputs."""
    return df.repartition(n)


def sam_to_reads(df: DataFrame, aligned: bool = True, unaligned: bool = True, filtered: bool = True,
                 strict: bool = False) -> DataFrame:
    """Original reads; mates come as one row each, reads without their mate are left out."""
    kept = df
    if not aligned:
        kept = kept.filter(cg.has("flag", cg.UNMAPPED))
    if not unaligned:
        kept = kept.filter(cg.lacks("flag", cg.UNMAPPED))
    if not filtered:
        kept = kept.filter(cg.lacks("flag", cg.QC_FAIL))
    back = cg.has("flag", cg.REVERSE)
    mate = F.when(cg.lacks("flag", cg.PAIRED), 0).when(cg.has("flag", cg.FIRST), 1).otherwise(2)
    reads = kept.select(
        (F.col("qname") if strict else names.strip_mate_suffix("qname")).alias("pair"),
        mate.alias("mate"),
        F.when(mate == 0, F.col("qname")).otherwise(F.concat("qname", F.lit("/"), mate)).alias("id"),
        F.when(back, dna.reverse_complement("seq")).otherwise(F.col("seq")).alias("seq"),
        F.when(back, F.reverse("qual")).otherwise(F.col("qual")).alias("qual"),
    )
    single = reads.filter("mate = 0").select("pair", "mate", "id", "seq", "qual")
    packed = [F.min(F.when(F.col("mate") == m, F.struct(F.lit(m).alias("mate"), "id", "seq", "qual"))).alias(f"m{m}")
              for m in (1, 2)]
    pairs = reads.filter("mate > 0").groupBy("pair").agg(*packed).filter("m1 IS NOT NULL AND m2 IS NOT NULL")
    return single.unionByName(pairs.select("pair", F.inline(F.array("m1", "m2"))))


def orphans(df: DataFrame, strict: bool = False) -> DataFrame:
    """How many paired records have no mate."""
    name = F.col("qname") if strict else names.strip_mate_suffix("qname")
    sides = df.filter(cg.has("flag", cg.PAIRED)).groupBy(name.alias("pair")).agg(
        F.count_if(cg.has("flag", cg.FIRST)).alias("a"), F.count_if(cg.lacks("flag", cg.FIRST)).alias("b"))
    return sides.agg(F.sum(F.when((F.col("a") == 0) | (F.col("b") == 0), F.col("a") + F.col("b")).otherwise(0)).alias("orphans"))


def fix_mates(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Fill the mate columns of consecutive records of one name; lone records are cleaned.

    ``order`` gives the order of the records of a name.
    """
    numbered = number_records(df, ["qname"], [F.col(c) for c in order], name="_n")
    numbered = numbered.withColumn("_pair", F.floor((F.col("_n") - 1) / 2))
    # a group is two records at most
    w = Window.partitionBy("qname", "_pair").orderBy("_n")
    end = alignment_end()
    five = F.when(cg.has("flag", cg.REVERSE), end).otherwise(F.col("pos") - 1)
    me = numbered.withColumn("_five", five)

    def other(c):
        return F.coalesce(F.lead(c).over(w), F.lag(c).over(w))

    me = me.withColumns({f"_o_{c}": other(c) for c in ("rname", "pos", "flag", "_five")})
    paired = F.col("_o_flag").isNotNull()
    both_mapped = (
        (F.col("rname") == F.col("_o_rname"))
        & cg.lacks("flag", cg.UNMAPPED | cg.MATE_UNMAPPED)
        & cg.lacks("_o_flag", cg.UNMAPPED | cg.MATE_UNMAPPED)
    )

    def switch(flag: Column, bits: int, on: Column) -> Column:
        off = flag.bitwiseAND(F.lit(~bits))
        return F.when(on, flag.bitwiseOR(F.lit(bits))).otherwise(off)

    flag = switch(F.col("flag"), cg.MATE_REVERSE, cg.has("_o_flag", cg.REVERSE))
    lost = cg.has("_o_flag", cg.UNMAPPED)
    flag = F.when(lost, flag.bitwiseOR(F.lit(cg.MATE_UNMAPPED)).bitwiseAND(F.lit(~cg.PROPER))).otherwise(flag)
    alone = F.when(
        cg.has("flag", cg.PAIRED),
        F.col("flag").bitwiseOR(F.lit(cg.MATE_UNMAPPED)).bitwiseAND(F.lit(~(cg.MATE_REVERSE | cg.PROPER))),
    ).otherwise(F.col("flag"))
    out = me.withColumns(
        {
            "rnext": F.when(paired, F.col("_o_rname")).otherwise(F.lit("*")),
            "pnext": F.when(paired, F.col("_o_pos")).otherwise(F.lit(0)),
            "tlen": F.when(paired & both_mapped, F.col("_o__five") - F.col("_five")).otherwise(F.lit(0)),
            "_flag": F.when(paired, flag).otherwise(alone),
        }
    ).withColumn("flag", F.col("_flag"))
    kept = list(dict.fromkeys([*df.columns, "rnext", "pnext", "tlen"]))
    return out.select(*kept)


def rmdup_pe(df: DataFrame, order: Sequence[str], library: str = "library", most: int | None = None) -> DataFrame:
    """One head per (library, reference, position, insert), its mate with it.

    The head with the highest total quality stays, the first in ``order`` on a
    tie. Unpaired, unmapped and cross-reference records pass through. The heads of a place are judged by one task
    unless they are more than ``most``.
    """
    marked = _pair_roles(df, library)
    place = ["_lib", "rname", "pos", "tlen"]
    heads, by = marked.filter("_role = 'head'").select(*df.columns, "_lib", "_q"), [-F.col("_q"), *[F.col(c) for c in order]]
    large = heads.groupBy(*place).agg(F.count("*").alias("_n")).filter(F.col("_n") > (most or PLACE_HEADS)).select(*[F.col(c).alias(f"_l{i}") for i, c in enumerate(place)])
    crowded = not large.isEmpty()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_l{i}")) for i, c in enumerate(place)])
    usual = heads.join(F.broadcast(large), same, "left_anti") if crowded else heads
    # moved by place at once, in parts of bounded size, and judged there
    rest = [F.col(c) for c in df.columns if c not in (*order, *place)]
    first = F.row_number().over(Window.partitionBy(*place).orderBy(*by, *rest)) == 1
    judged = usual.hint("rebalance", *place).withColumn("_first", first)
    kept_heads, names = judged.filter("_first").select(df.columns), judged.select("rname", "qname", "_first")
    if crowded:
        # the heads of a crowded place are looked through in several tasks
        many = even_parts(heads.join(F.broadcast(large), same, "left_semi"))
        best = first_per_key(many, place, by).select(df.columns)
        kept_heads = kept_heads.unionByName(best)
        names = names.unionByName(best.select("rname", "qname", F.lit(True).alias("_first"))).unionByName(many.select("rname", "qname", F.lit(False).alias("_first")))
    removed = names.groupBy("rname", "qname").agg(F.bool_or("_first").alias("_kept")).filter("NOT _kept").select("rname", "qname")
    single = marked.filter("_role = 'free'")
    tails = marked.filter("_role = 'tail'").join(removed, ["rname", "qname"], "left_anti")
    columns = df.columns
    return single.select(columns).unionByName(kept_heads.select(columns)).unionByName(tails.select(columns))


def _pair_roles(df: DataFrame, library: str) -> DataFrame:
    cross = F.col("rnext").isNotNull() & ~F.col("rnext").isin("=", "*") & (F.col("rnext") != F.col("rname"))
    free = cg.lacks("flag", cg.PAIRED) | ~cg.lacks("flag", cg.UNMAPPED | cg.MATE_UNMAPPED) | cross
    role = F.when(free, F.lit("free")).when(F.col("tlen") > 0, F.lit("head")).otherwise(F.lit("tail"))
    return df.withColumns(
        {"_role": role, "_lib": F.coalesce(F.col(library), F.lit("\t")), "_q": ph.quality_sum("qual")}
    )


def duplicate_rates_pe(df: DataFrame, library: str = "library") -> DataFrame:
    """Heads checked and removed per library."""
    heads = _pair_roles(df, library).filter("_role = 'head'")
    keys = even_parts(heads.select("_lib", "rname", "pos", "tlen")).groupBy("_lib", "rname", "pos", "tlen").agg(F.count("*").alias("c"))
    return _rates(keys)


def _rates(keys: DataFrame) -> DataFrame:
    return keys.groupBy(F.col("_lib").alias("library")).agg(
        F.sum("c").alias("checked"), F.sum(F.col("c") - 1).alias("removed"),
        F.round(F.sum(F.col("c") - 1) / F.sum("c"), 4).alias("rate"))


def _single_keys(df: DataFrame, library: str, force: bool) -> DataFrame:
    free = cg.has("flag", cg.UNMAPPED) | (F.lit(False) if force else cg.has("flag", cg.PAIRED))
    back = cg.has("flag", cg.REVERSE)
    return df.withColumns(
        {
            "_free": free,
            "_lib": F.coalesce(F.col(library), F.lit("\t")),
            "_back": back,
            "_at": F.when(back, alignment_end()).otherwise(F.col("pos")),
            "_q": ph.quality_sum("qual"),
        }
    )


SE_KEY = ["_lib", "rname", "_back", "_at"]


def rmdup_se(df: DataFrame, order: Sequence[str], force: bool = False, library: str = "library") -> DataFrame:
    """One record per (library, reference, strand, 5' coordinate)."""
    marked = _single_keys(df, library, force)
    needed = marked.filter("NOT _free").select(*SE_KEY, "_q", *[c for c in df.columns if c not in SE_KEY])
    kept = first_per_key(even_parts(needed), SE_KEY, [-F.col("_q"), *[F.col(c) for c in order]])
    return marked.filter("_free").select(df.columns).unionByName(kept.select(df.columns))


def duplicate_rates_se(df: DataFrame, force: bool = False, library: str = "library") -> DataFrame:
    keyed = _single_keys(df, library, force).filter("NOT _free").select(*SE_KEY)
    return _rates(even_parts(keyed).groupBy(*SE_KEY).agg(F.count("*").alias("c")))


def flagstat(df: DataFrame) -> DataFrame:
    """Twelve counts and three percentages in one aggregate."""
    paired = cg.has("flag", cg.PAIRED)
    mapped = cg.lacks("flag", cg.UNMAPPED)
    both = paired & mapped & cg.lacks("flag", cg.MATE_UNMAPPED)
    away = both & ~F.col("rnext").isin("=") & (F.col("rnext") != F.col("rname"))
    counts = df.agg(
        F.count("*").alias("total"),
        F.count_if(cg.has("flag", cg.QC_FAIL)).alias("qc_failure"),
        F.count_if(cg.has("flag", cg.DUPLICATE)).alias("duplicates"),
        F.count_if(mapped).alias("mapped"),
        F.count_if(paired).alias("paired"),
        F.count_if(paired & cg.has("flag", cg.FIRST)).alias("read1"),
        F.count_if(paired & cg.has("flag", cg.SECOND)).alias("read2"),
        F.count_if(paired & cg.has("flag", cg.PROPER)).alias("properly_paired"),
        F.count_if(both).alias("both_mapped"),
        F.count_if(paired & mapped & cg.has("flag", cg.MATE_UNMAPPED)).alias("singletons"),
        F.count_if(away).alias("mate_elsewhere"),
        F.count_if(away & (F.col("mapq") >= 5)).alias("mate_elsewhere_q5"),
    )

    def percent(a, b):
        return F.round(F.when(F.col(b) > 0, F.col(a) / F.col(b) * 100), 2)

    return counts.withColumns(
        {
            "mapped_percent": percent("mapped", "total"),
            "proper_percent": percent("properly_paired", "paired"),
            "singleton_percent": percent("singletons", "paired"),
        }
    )


def idxstats(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Mapped and unmapped per reference of the dictionary, plus the records without one (``*``)."""
    counts = df.groupBy("rname").agg(
        F.count_if(cg.lacks("flag", cg.UNMAPPED)).alias("mapped"), F.count_if(cg.has("flag", cg.UNMAPPED)).alias("unmapped"))
    known = dictionary.select(F.col("name").alias("rname"), "length").join(counts, "rname", "left").na.fill(0, ["mapped", "unmapped"])
    nowhere = df.agg(F.count_if(F.col("rname") == "*").alias("unmapped")).select(
        F.lit("*").alias("rname"), F.lit(0).cast("bigint").alias("length"), F.lit(0).cast("bigint").alias("mapped"), "unmapped")
    return known.select("rname", F.col("length").cast("bigint").alias("length"), "mapped", "unmapped").unionByName(nowhere)


def depth_runs(df: DataFrame, mask: int = cg.PILEUP_MASK, min_mapq: int = 0, bits: int = BIN_BITS,
               regions: DataFrame | None = None) -> DataFrame:
    """Stretches of equal depth (rname, beg, end, depth), depth > 0.

    Blocks are cut at bucket edges first, so every bucket is complete in itself;
    starts and ends are counted per position before the shuffle, so a bucket never
    holds more than two rows per base however deep it is. With closed ``regions`` only the
    buckets that they touch are swept.
    """
    width = 1 << bits
    kept = df.filter(cg.lacks("flag", mask) & (F.col("mapq") >= min_mapq))
    block = F.explode(F.filter(cg.blocks("cigar"), lambda b: b["op"].isin("M", "D"))).alias("b")
    spans = kept.select("rname", "pos", block).select(
        "rname", (F.col("pos") + F.col("b.ref")).alias("s"), (F.col("pos") + F.col("b.ref") + F.col("b.len") - 1).alias("e"))
    buckets = F.sequence(F.floor(F.col("s") / width), F.floor(F.col("e") / width))
    cut = spans.select("rname", "s", "e", F.explode(buckets).alias("bin"))
    if regions is not None:
        wanted = bins.touched(regions, ("_name", "r_beg", "r_end"), bits).select(F.col("_name").alias("rname"), F.col("_bin").alias("bin"))
        cut = cut.join(wanted, ["rname", "bin"], "left_semi")
    cut = cut.select("rname", "bin", F.greatest("s", F.col("bin") * width).alias("s"),
                     F.least("e", (F.col("bin") + 1) * width - 1).alias("e"))
    events = cut.select("rname", "bin", F.inline(F.array(
        F.struct(F.col("s").alias("at"), F.lit(1).alias("d")), F.struct((F.col("e") + 1).alias("at"), F.lit(-1).alias("d")))))
    deltas = events.groupBy("rname", "bin", "at").agg(F.sum("d").alias("d"))
    w = Window.partitionBy("rname", "bin").orderBy("at")
    runs = deltas.select("rname", F.col("at").alias("beg"), (F.lead("at").over(w) - 1).alias("end"),
                         F.sum("d").over(w).alias("depth"))
    return runs.filter("depth > 0")


def depth(df: DataFrame, mask: int = cg.PILEUP_MASK, min_mapq: int = 0, regions: DataFrame | None = None,
          lengths: DataFrame | None = None) -> DataFrame:
    """One row per covered base, or per couple of such a base and a region."""
    if regions is None:
        runs = depth_runs(df, mask, min_mapq)
    else:
        closed = closed_regions(regions, lengths)
        runs = bins.couples(depth_runs(df, mask, min_mapq, regions=closed), closed, ("rname", "beg", "end")).select(
            "rname", F.greatest("beg", "r_beg").alias("beg"), F.least("end", "r_end").alias("end"), "depth")
    return runs.select("rname", F.explode(F.sequence("beg", "end")).alias("pos"), "depth")


def depth_bounds(df: DataFrame, k: float = 3, minimum: int = 5) -> DataFrame:
    """Mean -/+ k sample standard deviations over the covered bases.

    Sums over the runs, weighted by their length; no base is exploded.
    """
    runs = depth_runs(df)
    n = (F.col("end") - F.col("beg") + 1).cast("double")
    sums = runs.agg(F.sum(n).alias("n"), F.sum(n * F.col("depth")).alias("s"),
                    F.sum(n * F.col("depth") * F.col("depth")).alias("ss"))
    mean = F.col("s") / F.col("n")
    sd = F.sqrt((F.col("ss") - F.col("n") * mean * mean) / (F.col("n") - 1))
    low = F.floor(F.greatest(mean - k * sd, F.lit(float(minimum))))
    return sums.select(low.alias("min_depth"), F.ceil(mean + k * sd).alias("max_depth"))


def fragment_coverage(df: DataFrame, dictionary: DataFrame, bits: int = BIN_BITS) -> DataFrame:
    """Open fragments per base over the whole of each reference.

    A proper pair opens at the forward read and closes after the reverse read; any
    other read covers just itself.
    """
    width = 1 << bits
    proper = cg.has("flag", cg.PAIRED | cg.PROPER)
    closes = proper & cg.has("flag", cg.REVERSE) & ~cg.lacks("flag", cg.FIRST | cg.SECOND)
    after = F.col("pos") + cg.op_total("cigar", "MD")
    opening = F.when(~closes, F.struct(F.col("pos").cast("bigint").alias("at"), F.lit(1).alias("d")))
    closing = F.when(closes | ~proper, F.struct(after.cast("bigint").alias("at"), F.lit(-1).alias("d")))
    events = df.select("rname", F.inline(F.array_compact(F.array(opening, closing))))
    # An empty event at each bucket edge lets every bucket be filled on its own.
    edges = dictionary.select(
        F.col("name").alias("rname"),
        F.explode(F.sequence(F.lit(0), F.floor(F.col("length") / width))).alias("b"),
    ).select("rname", F.greatest(F.col("b") * width, F.lit(1)).cast("bigint").alias("at"), F.lit(0).alias("d"))
    deltas = events.unionByName(edges).groupBy("rname", "at").agg(F.sum("d").alias("d"))
    totals = running_sum(deltas, ["rname"], "at", {"open": "d"}, width=width)
    totals = totals.withColumn("_bin", F.floor(F.col("at") / width))
    nxt = F.lead("at").over(Window.partitionBy("rname", "_bin").orderBy("at"))
    sized = totals.withColumn("_end", F.coalesce(nxt, (F.col("_bin") + 1) * width) - 1)
    lengths = dictionary.select(F.col("name").alias("rname"), F.col("length").alias("_len"))
    runs = sized.join(lengths, "rname").select(
        "rname", F.col("at").alias("beg"), F.least("_end", "_len").alias("end"), "open").filter("end >= beg")
    return runs.select("rname", F.explode(F.sequence("beg", "end")).alias("pos"), "open")


def closed_regions(regions: DataFrame, lengths: DataFrame | None = None) -> DataFrame:
    """(_name, r_beg, r_end): an open region (null end) ends with its sequence in ``lengths`` (name, length), else it is an error."""
    if lengths is not None:
        sizes = lengths.select("name", F.col("length").alias("_length"))
        regions = regions.join(sizes, "name", "left").withColumn("end", F.coalesce("end", "_length")).drop("_length")
    closed = F.coalesce(F.col("end").cast("bigint"), F.raise_error(F.lit("an open region needs lengths")).cast("bigint"))
    return regions.select(F.col("name").alias("_name"), F.col("beg").cast("bigint").alias("r_beg"), closed.alias("r_end"))


def overlap(features: DataFrame, regions: DataFrame, columns: tuple[str, str, str] = ("rname", "beg", "end"),
            lengths: DataFrame | None = None) -> DataFrame:
    """Features that share a base with a region (name, beg, end), one row per couple; open regions as in ``closed_regions``."""
    return bins.couples(features, closed_regions(regions, lengths), columns)


def shared_bases(features: DataFrame, regions: DataFrame, columns=("rname", "beg", "end")) -> DataFrame:
    joined = overlap(features, regions, columns)
    return joined.withColumn("shared", intersect_length(columns[1], columns[2], "r_beg", "r_end"))


def compare_alignments(first: DataFrame, second: DataFrame, order: Sequence[str], q: int = 10, s: int = 100) -> DataFrame:
    """Ten counts: consistent, inconsistent and missing by mapping quality.

    The last record of a name (in ``order``) stands for it.
    """
    def side(df, tag):
        place = F.struct(cg.has("flag", cg.REVERSE).alias("back"), "rname", "pos", "mapq")
        return df.groupBy("qname").agg(F.max(F.struct(*[F.col(c) for c in order], place.alias("_p"))).alias("m")).select(
            "qname", F.col("m._p").alias(tag))

    both = side(first, "a").join(side(second, "b"), "qname", "full")
    here = F.col("a").isNotNull() & F.col("b").isNotNull()
    same = (
        (F.col("a.back") == F.col("b.back")) & (F.col("a.rname") == F.col("b.rname"))
        & (F.abs(F.col("a.pos") - F.col("b.pos")) < s)
    )
    ha, hb = F.col("a.mapq") >= q, F.col("b.mapq") >= q
    no_a, no_b = F.col("a").isNull(), F.col("b").isNull()
    cases = {
        "consistent_hh": here & same & ha & hb, "consistent_hl": here & same & ha & ~hb,
        "consistent_lh": here & same & ~ha & hb, "inconsistent_hh": here & ~same & ha & hb,
        "inconsistent_hl": here & ~same & ha & ~hb, "inconsistent_lh": here & ~same & ~ha & hb,
        "second_missing_high": no_b & ha, "second_missing_low": no_b & ~ha,
        "first_missing_high": no_a & hb, "first_missing_low": no_a & ~hb,
    }
    return both.agg(*[F.count_if(c).alias(n) for n, c in cases.items()])


def unique_alignments(df: DataFrame, order: Sequence[str], factor: float = 250.0, match: int = 1, gap_open: int = 5,
                      gap_extend: int = 2) -> DataFrame:
    """Best record per name with a mapping quality from the best and second-best score.

    ``row_number() <= 2`` is limited in every map task before the shuffle, so a name
    with very many hits does not gather in one place.
    """
    gaps = F.size(F.regexp_extract_all("cigar", F.lit(r"(\d+)[ID]"), F.lit(1)))
    own = cg.op_total("cigar", "M") * match - gaps * gap_open - cg.op_total("cigar", "ID") * gap_extend
    scored = df.withColumn("_score", F.greatest(F.coalesce(F.col("score"), own) if "score" in df.columns else own, F.lit(1)))
    w = Window.partitionBy("qname").orderBy(F.col("_score").desc(), *[F.col(c) for c in order])
    top = scored.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= 2)
    second = F.coalesce(F.lead("_score").over(Window.partitionBy("qname").orderBy("_rn")), F.lit(0))
    best = top.withColumn("_second", second).filter("_rn = 1")
    mapq = F.floor(F.lit(factor) * (F.col("_score") - F.col("_second")) / F.col("_score") + F.lit(0.499))
    return best.withColumn("mapq", F.least(mapq, F.lit(250)).cast("int")).select(*df.columns)


def sort_by_coordinate(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Reference order of the dictionary (column ``idx``), position, strand; unplaced last."""
    indexed = df.join(dictionary.select(F.col("name").alias("rname"), F.col("idx").alias("_idx")), "rname", "left")
    return indexed.orderBy(F.col("_idx").asc_nulls_last(), "pos", cg.has("flag", cg.REVERSE)).drop("_idx")


def sort_natural(df: DataFrame, column: str = "qname") -> DataFrame:
    return df.withColumn("_k", names.natural_key(column)).orderBy("_k", column).drop("_k")


def agreeing_dictionary(*dictionaries: DataFrame) -> DataFrame:
    """The one dictionary (name, length, idx) that all inputs have; names, lengths or places that differ are an error.

    The error is raised when the result is read.
    """
    each = [d.select("name", F.col("length").cast("bigint").alias("length"), F.col("idx").cast("bigint").alias("idx"), F.lit(i).alias("_d")) for i, d in enumerate(dictionaries)]
    rows = each[0]
    for d in each[1:]:
        rows = rows.unionByName(d)
    per = rows.groupBy("name").agg(
        F.min("length").alias("length"), F.max("length").alias("_l"), F.min("idx").alias("idx"), F.max("idx").alias("_i"), F.count_distinct("_d").alias("_n"), F.count("*").alias("_c"))
    same = (F.col("length") == F.col("_l")) & (F.col("idx") == F.col("_i")) & (F.col("_n") == len(each)) & (F.col("_c") == len(each))
    clash = F.raise_error(F.concat(F.lit("sequence dictionaries disagree on "), "name")).cast("bigint")
    return per.select("name", F.when(same, F.col("length")).otherwise(clash).alias("length"), F.when(same, F.col("idx")).otherwise(clash).alias("idx"))


def merge_alignments(*sets: DataFrame, groups: Sequence[str] | None = None, dictionaries: Sequence[DataFrame] | None = None) -> DataFrame:
    """Union of alignment sets, each with its own read group when ``groups`` is given.

    With ``dictionaries`` (name, length, idx; one for each set) they have to agree, and the result is in
    coordinate order by them.
    """
    tagged = [s.withColumn("rg", F.lit(g)) for s, g in zip(sets, groups)] if groups else list(sets)
    out = tagged[0]
    for s in tagged[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out if dictionaries is None else sort_by_coordinate(out, agreeing_dictionary(*dictionaries))


def same_dictionary(a: DataFrame, b: DataFrame) -> bool:
    return not tables_differ(a.select("name", "length"), b.select("name", "length"))


def tables_differ(a: DataFrame, b: DataFrame) -> bool:
    """True when some row occurs more often in one table than in the other."""
    return not a.exceptAll(b).unionAll(b.exceptAll(a)).isEmpty()


def difference_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """How many rows only one side has: one shuffle over both tables."""
    columns = a.columns
    both = a.select(*columns, F.lit(1).alias("_s")).unionByName(b.select(*columns, F.lit(-1).alias("_s")))
    net = both.groupBy(*columns).agg(F.sum("_s").alias("d"))
    return net.agg(
        F.coalesce(F.sum(F.when(F.col("d") > 0, F.col("d"))), F.lit(0)).alias("only_first"),
        F.coalesce(F.sum(F.when(F.col("d") < 0, -F.col("d"))), F.lit(0)).alias("only_second"))


def merge_dictionaries(lines: DataFrame) -> DataFrame:
    """Header lines (kind, key, tags map): equal tags are kept once, a tag with two values is a conflict."""
    each = lines.select("kind", "key", F.explode("tags").alias("tag", "value")).distinct()
    # a line has a handful of tags
    per_tag = each.groupBy("kind", "key", "tag").agg(F.min("value").alias("value"), F.count("*").alias("n"))
    merged = F.map_from_entries(F.array_sort(F.collect_list(F.struct("tag", "value"))))
    return per_tag.groupBy("kind", "key").agg(merged.alias("tags"), F.bool_or(F.col("n") > 1).alias("conflict"))


def calc_md(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """Adds ``md``, ``nm`` and ``masked`` (matches shown as ``=``) from the reference.

    The reference is cut into overlapping pieces, so a record meets a piece of
    bounded size, not a whole chromosome.
    """
    from .pileup import reference_for

    placed = reference_for(df, contigs).withColumn("_b", cg.blocks("cigar"))

    def query_text(b):
        return F.when(b["op"] == "D", F.repeat(F.lit("-"), b["len"])).when(
            b["op"].isin("M", "I", "S"), F.substr(F.col("seq"), b["qry"] + 1, b["len"])).otherwise(F.lit(""))

    def reference_text(b):
        there = F.rpad(F.substr(F.col("refseq"), b["ref"] + 1, b["len"]), b["len"], F.lit("~"))
        return F.when(b["op"].isin("M", "D"), there).when(b["op"] == "I", F.repeat(F.lit("+"), b["len"])).when(
            b["op"] == "S", F.repeat(F.lit("."), b["len"])).otherwise(F.lit(""))

    def mark(q, r):
        # '=' match, upper case mismatch, lower case deletion, '+' insertion, '.' clip, '~' past the contig
        match = ((q == r) & (q != "N")) | (q == "=")
        return F.when(r.isin("~", "+", "."), r).when(q == "-", F.lower(r)).when(match, F.lit("=")).otherwise(r)

    lines = placed.withColumns({
        "_q": F.array_join(F.transform("_b", query_text), ""),
        "_r": F.upper(F.array_join(F.transform("_b", reference_text), ""))})
    lines = lines.withColumn("_m", F.array_join(F.zip_with(
        F.split(F.upper("_q"), ""), F.split("_r", ""), mark), ""))
    inside = F.substring_index("_m", "~", 1)
    plain = F.translate(inside, "+.", "")
    # '^' opens a deletion, '0' stands wherever no match separates two marks
    opened = F.regexp_replace(plain, "(?<![a-z])(?=[a-z])", "^")
    spaced = F.regexp_replace(opened, "(?<=^|[A-Za-z])(?=[A-Z^]|$)", "0")
    runs = F.regexp_extract_all(spaced, F.lit("=+|[^=]+"), F.lit(0))
    md = F.upper(F.array_join(F.transform(runs, lambda x: F.when(x.startswith("="), F.length(x).cast("string")).otherwise(x)), ""))
    masked = F.array_join(F.zip_with(F.split("_q", ""), F.split("_m", ""), lambda q, m: F.when(m == "=", m).when(q == "-", F.lit("")).otherwise(q)), "")
    return lines.select(*df.columns, md.alias("md"), F.length(F.translate(inside, "=.", "")).alias("nm"), masked.alias("masked"))


def alignment_accuracy(df: DataFrame, gap: int = 5) -> DataFrame:
    """Wrong and total per tens of mapping quality, from names ``chrom_left_right_...``."""
    truth = [F.regexp_extract("qname", r"^(\S+)_(\d+)_(\d+)_", i) for i in (1, 2, 3)]
    head = F.coalesce(F.regexp_extract("cigar", r"^(\d+)[SH]", 1).try_cast("int"), F.lit(0))
    tail = F.coalesce(F.regexp_extract("cigar", r"(\d+)[SH]$", 1).try_cast("int"), F.lit(0))
    end = alignment_end()
    left, left0 = F.col("pos") - head, F.col("pos") - tail
    right, right0 = end + tail, end + head
    t_left, t_right = truth[1].try_cast("bigint"), truth[2].try_cast("bigint")
    off = F.when(
        cg.has("flag", cg.REVERSE), (F.abs(t_right - right) > gap) & (F.abs(t_right - right0) > gap)
    ).otherwise((F.abs(t_left - left) > gap) & (F.abs(t_left - left0) > gap))
    usable = cg.lacks("flag", cg.UNMAPPED) & (F.col("rname") != "*") & (truth[0] != "")
    counted = df.filter(usable).groupBy(F.floor(F.col("mapq") / 10).alias("tens")).agg(
        F.count_if((truth[0] != F.col("rname")) | off).alias("wrong"), F.count("*").alias("total"))
    # one row per ten of mapping quality: at most 26
    down = Window.orderBy(F.col("tens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return counted.select("tens", "wrong", "total", F.sum("total").over(down).alias("cum_total"),
                          (F.sum("wrong").over(down) / F.sum("total").over(down)).alias("cum_error"))
