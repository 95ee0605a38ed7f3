"""Read sets: trim, filter, pair, de-duplicate, sample and measure.

Reads are rows of (rid, pair_id, mate, file, id, seq, qual).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names, phred as ph
from ..functions.common import chars, floor2
from .scale import number_rows

PRINTABLE = "".join(chr(c) for c in range(33, 127))


def _low_set(min_quality, offset: int) -> Column:
    if isinstance(min_quality, Column):
        count = F.lit(offset - 33) + F.ceil(min_quality).cast("int")
        return F.substr(F.lit(PRINTABLE), F.lit(1), count)
    return F.lit(ph.low_characters(min_quality, offset))


def mask_ambiguous(reads: DataFrame, offset: int = 33) -> DataFrame:
    return reads.withColumns(
        {"seq": ph.mask_bases("seq"), "qual": ph.mask_qualities("seq", "qual", offset)}
    )


def trim_counts(reads: DataFrame, min_quality=30, bases_to_trim: int = 20, mode: str = "first", offset: int = 33):
    """Adds ``n5`` and ``n3``: how many bases each end loses."""
    q = F.col("qual")
    if mode == "average":
        values = ph.phred(q, offset)
        n5 = ph.expanding_low(values, min_quality, bases_to_trim)
        n3 = ph.expanding_low(F.reverse(values), min_quality, bases_to_trim)
    else:
        low = _low_set(min_quality, offset)
        head, tail = F.substring(q, 1, bases_to_trim), F.right(q, F.lit(bases_to_trim))
        n5 = F.length(head) - F.length(F.ltrim(head, low))
        n3 = F.length(tail) - F.length(F.rtrim(tail, low))
    return reads.withColumns({"n5": n5, "n3": n3})


def trim_ends(reads: DataFrame, min_quality=30, bases_to_trim: int = 20, mode: str = "first", offset: int = 33):
    """Keeps [n5, length - n3) of sequence and quality."""
    counted = trim_counts(reads, min_quality, bases_to_trim, mode, offset)
    start = F.col("n5") + 1
    keep = F.greatest(F.length("seq") - F.col("n5") - F.col("n3"), F.lit(0))
    return counted.withColumns({"seq": F.substr("seq", start, keep), "qual": F.substr("qual", start, keep)}).drop(
        "n5", "n3"
    )


def read_is_good(min_length=62, min_avg_quality=10, offset: int = 33) -> Column:
    long_enough = F.length("seq") >= min_length
    return long_enough & (ph.mean_quality("qual", offset) >= min_avg_quality)


def route_pairs(reads: DataFrame, good: Column) -> DataFrame:
    """Adds ``route``: pair (all mates good), singleton (this one is), or drop."""
    marked = reads.withColumn("good", good)
    pair = Window.partitionBy("pair_id")
    return marked.withColumn(
        "route",
        F.when(F.bool_and("good").over(pair), F.lit("pair"))
        .when(F.col("good"), F.lit("singleton"))
        .otherwise(F.lit("drop")),
    )


def clean(
    reads: DataFrame,
    min_quality=30,
    bases_to_trim: int = 20,
    min_avg_quality=10,
    min_length=62,
    mode: str = "first",
    trim: bool = True,
    mask: bool = True,
    singletons: bool = True,
    offset: int = 33,
) -> DataFrame:
    """Mask, trim and route; rows to drop are gone, ``route`` tells the output."""
    out = mask_ambiguous(reads, offset) if mask else reads
    out = trim_ends(out, min_quality, bases_to_trim, mode, offset) if trim else out
    routed = route_pairs(out, read_is_good(min_length, min_avg_quality, offset)).drop("good")
    kept = ("pair", "singleton") if singletons else ("pair",)
    return routed.filter(F.col("route").isin(*kept))


def pass_rate(routed: DataFrame) -> DataFrame:
    passed = F.count_if(F.col("route") != "drop")
    return routed.agg(floor2(passed / F.count("*")).alias("pass_rate"))


def auto_params(reads: DataFrame, bases_to_trim: int = 20, offset: int = 33) -> DataFrame:
    """One row of thresholds taken from the data."""
    bases = F.sum(F.length("seq"))
    mean_q = floor2(F.sum(ph.quality_sum("qual", offset)) / bases)
    return reads.agg(
        (floor2(bases / F.count("*")) - bases_to_trim).alias("min_length"),
        (mean_q - 5).alias("min_avg_quality"),
        (mean_q - 5).alias("min_quality"),
    )


def clean_auto(reads: DataFrame, bases_to_trim: int = 20, **options) -> DataFrame:
    """``clean`` with thresholds from ``auto_params`` as scalar subqueries."""
    params = auto_params(reads, bases_to_trim)
    chosen = {c: params.select(c).scalar() for c in ("min_length", "min_avg_quality", "min_quality")}
    return clean(reads, bases_to_trim=bases_to_trim, **chosen, **options)


def composition_profile(reads: DataFrame, offset: int = 33) -> DataFrame:
    """Percentage of each base and mean quality per position (0-based).

    Counting per (position, base) is combined before the shuffle, so what moves
    is a few rows per task, not one row per base.
    """
    each = reads.select(
        F.posexplode(F.arrays_zip(chars("seq").alias("b"), chars("qual").alias("q"))).alias("pos", "x")
    )
    each = each.select("pos", F.upper("x.b").alias("b"), (F.ascii("x.q") - offset).alias("q"))
    share = {b: (F.count_if(F.col("b") == b) * 100 / F.count("*")).alias(b.lower()) for b in "ACGT"}
    return each.groupBy("pos").agg(*share.values(), F.avg("q").alias("q"))


def composition_cuts(profile: DataFrame, bad_slope: float = 0.5, run: int = 2) -> DataFrame:
    """One row (start, length) to keep. The profile has one row per read position."""

    def trim(order):
        # The profile is as long as the longest read, whatever the number of reads.
        w = Window.orderBy(order)
        steps = [F.round(F.abs(F.lead(b).over(w) - F.col(b)), 2) for b in "acgt"]
        slope = F.round((steps[0] + steps[1] + steps[2] + steps[3]) / 4, 2)
        stepped = profile.withColumns({"i": F.row_number().over(w) - 1, "slope": slope}).filter(
            F.col("slope").isNotNull()
        )
        ok = (F.col("slope") <= bad_slope) & (F.col("q") != 0)
        runs = stepped.withColumn("ok", ok).withColumn(
            "streak", F.min(F.col("ok").cast("int")).over(Window.orderBy("i").rowsBetween(1 - run, 0))
        )
        hit = (F.col("streak") == 1) & (F.col("i") >= run - 1)
        return runs.agg(F.greatest(F.coalesce(F.min(F.when(hit, F.col("i"))) - run, F.lit(0)), F.lit(0)).alias("n"))

    start = trim(F.col("pos").asc()).scalar()
    end = trim(F.col("pos").desc()).scalar()
    return profile.agg(F.count("*").cast("int").alias("positions")).select(
        start.cast("int").alias("start"), (F.col("positions") - start - end).cast("int").alias("length")
    )


def trim_by_composition(reads: DataFrame, bad_slope: float = 0.5) -> DataFrame:
    cuts = composition_cuts(composition_profile(reads), bad_slope)
    start, length = cuts.select("start").scalar(), cuts.select("length").scalar()
    return reads.withColumns(
        {"seq": F.substr("seq", start + 1, length), "qual": F.substr("qual", start + 1, length)}
    )


def pair_up(reads: DataFrame) -> DataFrame:
    """One row per pair; a single read has null mate columns."""

    def pick(mate, column):
        return F.max(F.when(F.col("mate") == mate, F.col(column))).alias(f"{column}{mate}")

    return reads.groupBy("pair_id").agg(
        F.min("rid").alias("rid"), *[pick(m, c) for m in (1, 2) for c in ("id", "seq", "qual")]
    )


def unpair(pairs: DataFrame) -> DataFrame:
    """Back to one row per read."""
    mates = F.array(
        *[
            F.struct(F.lit(m).alias("mate"), *[F.col(f"{c}{m}").alias(c) for c in ("id", "seq", "qual")])
            for m in (1, 2)
        ]
    )
    carried = [c for c in pairs.columns if c not in {f"{c}{m}" for m in (1, 2) for c in ("id", "seq", "qual")}]
    return pairs.select(*carried, F.inline(mates)).filter(F.col("seq").isNotNull())


def dedup_pairs(pairs: DataFrame, prefix: int = 0, cap: int = 40, bin: bool = True, offset: int = 33) -> DataFrame:
    """Identical pairs (or reads) become one row with combined qualities and ``n`` copies.

    The survivor is the copy with the lowest ``rid``. Only copies of a repeated
    sequence are exploded by position, and the sums per (survivor, position) are
    combined before the shuffle, so a sequence that makes up a third of the reads
    sends no more rows per task than it has positions.
    """

    def key(c):
        text = F.coalesce(F.col(c), F.lit(""))
        return F.substring(text, 1, prefix) if prefix else text

    keyed = pairs.withColumns({"_k1": key("seq1"), "_k2": key("seq2")})
    if not bin:
        return pairs.withColumn("n", F.lit(1).cast("bigint"))
    columns = ["pair_id", "id1", "seq1", "qual1", "id2", "seq2", "qual2"]
    first = F.min(F.struct("rid", *columns))
    groups = keyed.groupBy("_k1", "_k2").agg(first.alias("s"), F.count("*").alias("n"))
    groups = groups.select("_k1", "_k2", "n", "s.*")
    repeated = groups.filter("n > 1").select("_k1", "_k2", F.col("rid").alias("_rid"))
    copies = keyed.select("_k1", "_k2", "qual1", "qual2").join(repeated, ["_k1", "_k2"])
    # Equal quality strings of one group are counted, not exploded again and again.
    copies = copies.groupBy("_rid", "qual1", "qual2").agg(F.count("*").alias("w"))
    side = F.explode(F.array(F.struct(F.lit(1).alias("mate"), F.col("qual1").alias("q")),
                             F.struct(F.lit(2).alias("mate"), F.col("qual2").alias("q"))))
    sides = copies.select("_rid", "w", side.alias("m")).filter(F.length("m.q") > 0)
    each = sides.select("_rid", "w", "m.mate", F.posexplode(chars("m.q")).alias("pos", "c"))
    total = F.least(F.lit(cap).cast("bigint"), F.sum((F.ascii("c") - offset) * F.col("w")))
    sums = each.groupBy("_rid", "mate", "pos").agg(F.char(total + offset).alias("txt"))

    def joined(mate):
        here = F.collect_list(F.when(F.col("mate") == mate, F.struct("pos", "txt")))
        return F.array_join(F.transform(F.array_sort(here), lambda p: p["txt"]), "").alias(f"_q{mate}")

    combined = sums.groupBy("_rid").agg(joined(1), joined(2))
    out = groups.join(combined, F.col("rid") == F.col("_rid"), "left")

    def quality(m):
        # A longer copy of the same prefix does not lengthen the survivor.
        return F.when(F.col("_rid").isNull() | F.col(f"qual{m}").isNull(), F.col(f"qual{m}")).otherwise(
            F.substr(f"_q{m}", F.lit(1), F.length(f"qual{m}"))
        )

    def name(m):
        return F.when(F.col("n") > 1, F.concat(F.col(f"id{m}"), F.lit(" combinedReads="), F.col("n"))).otherwise(
            F.col(f"id{m}")
        )

    return out.select(
        "pair_id", "rid", "n", *[e.alias(f"{c}{m}") for m in (1, 2)
                                 for c, e in (("id", name(m)), ("seq", F.col(f"seq{m}")), ("qual", quality(m)))]
    )


def dedup_reads(reads: DataFrame, **options) -> DataFrame:
    return unpair(dedup_pairs(pair_up(reads), **options))


def downsample(reads: DataFrame, p: float | None = None, bases: int | None = None,
               coverage: float | None = None, genome_size: int | None = None, key: str = "pair_id") -> DataFrame:
    """Keeps whole pairs with a fixed probability, or down to a number of bases or a coverage."""
    if p is not None:
        return reads.filter(names.keep_share(key, p))
    target = bases if bases is not None else coverage * genome_size
    share = reads.agg(F.least(F.lit(1.0), F.lit(float(target)) / F.sum(F.length("seq"))).alias("p")).scalar()
    return reads.filter(names.keep_below(key, share))


def paired_names(reads: DataFrame, check_first: int | None = None) -> DataFrame:
    """Per file: does every consecutive couple of names look like mates, and in which style."""
    source = reads if check_first is None else reads.filter(F.col("rid") < check_first)

    def pick(mate):
        return F.max(F.when(F.col("mate") == mate, F.col("id"))).alias(f"id{mate}")

    pairs = source.groupBy("file", "pair_id").agg(pick(1), pick(2)).filter("id1 IS NOT NULL AND id2 IS NOT NULL")
    styles = pairs.groupBy("file").agg(
        F.bool_and(names.sra_mates("id1", "id2")).alias("sra"),
        F.bool_and(names.casava18_mates("id1", "id2")).alias("casava18"),
        F.bool_and(names.trailing_digit_mates("id1", "id2")).alias("casava17"),
    )
    return styles.select(
        "file",
        (F.col("sra") | F.col("casava18") | F.col("casava17")).alias("is_paired"),
        F.when(F.col("sra"), "SRA").when(F.col("casava18"), "Casava1.8").when(F.col("casava17"), "Casava1.7")
        .otherwise("NotPE").alias("format"),
    )


def read_metrics(reads: DataFrame, min_length: int = 1, genome_size: int | None = None,
                 sample: float = 1.0, offset: int = 33) -> DataFrame:
    """Per file metrics; with ``sample`` < 1 sums are scaled up by reads seen / reads present."""
    counted = reads.withColumn("seen", names.keep_share("id", sample) if sample < 1 else F.lit(True))
    used = F.col("seen") & (F.length("seq") >= min_length)
    length = F.when(used, F.length("seq"))
    sums = counted.groupBy("file").agg(
        F.count("*").alias("numReads"),
        F.greatest(F.count_if(used), F.lit(1)).alias("sampled"),
        F.greatest(F.coalesce(F.sum(length), F.lit(0)), F.lit(1)).alias("bases"),
        F.min(length).alias("minReadLength"),
        F.max(length).alias("maxReadLength"),
        F.sum(F.when(used, ph.quality_sum("qual", offset))).alias("quals"),
    )
    all_bases = F.floor(F.col("bases") * F.col("numReads") / F.col("sampled"))
    coverage = floor2(all_bases / F.lit(genome_size)) if genome_size else F.lit(None).cast("double")
    return sums.select(
        "file",
        floor2(F.col("bases") / F.col("sampled")).alias("avgReadLength"),
        all_bases.alias("totalBases"),
        "minReadLength",
        "maxReadLength",
        floor2(F.col("quals") / F.col("bases")).alias("avgQuality"),
        "numReads",
        coverage.alias("coverage"),
    )


def read_report(reads: DataFrame, **options) -> DataFrame:
    """``read_metrics`` with the paired-end column from the names."""
    paired = paired_names(reads).select(F.col("file"), "is_paired")
    joined = read_metrics(reads, **options).join(paired, "file", "left")
    return joined.withColumn("pe", F.when(F.col("is_paired"), "yes").otherwise("no")).drop("is_paired")


def fragment_lengths(alignments: DataFrame, by: str) -> DataFrame:
    """Quartiles of the positive insert sizes by nearest rank, from counts per size."""
    from .stats import nearest_rank

    positive = alignments.filter("tlen > 0")
    return nearest_rank(positive, [by], "tlen", {"q25": 25, "q50": 50, "q75": 75})


def histogram(reads: DataFrame, value: Column) -> DataFrame:
    """Rounded value, count and share cut to two decimals, plus a total row (null value)."""
    counts = reads.select(F.round(value).cast("bigint").alias("value")).rollup("value").agg(
        F.count("*").alias("n"), F.grouping("value").alias("is_total")
    )
    total = reads.agg(F.count("*")).scalar()
    share = F.when(F.col("is_total") == 0, floor2(F.col("n") / total))
    return counts.select("value", "n", share.alias("freq"), (F.col("is_total") == 1).alias("is_total"))


def length_histogram(reads: DataFrame) -> DataFrame:
    return histogram(reads, F.length("seq"))


def quality_histogram(reads: DataFrame) -> DataFrame:
    return histogram(reads, ph.quality_sum("qual"))


def length_cutoff(reads: DataFrame, genome_size: int, target: float = 100) -> DataFrame:
    """Smallest length bucket (about 1 kb wide) whose reads cover the genome less than ``target`` times."""
    bucket = F.floor((F.length("seq") + 449) / 1000) * 1000
    counts = reads.groupBy(bucket.alias("cutoff")).agg(F.count("*").alias("n"))
    # One row per kilobase of the longest read.
    up = Window.orderBy(F.col("cutoff").desc()).rowsBetween(Window.unboundedPreceding, 0)
    covered = counts.withColumn("coverage", F.sum(F.col("cutoff") * F.col("n")).over(up) / genome_size)
    under = covered.filter(F.col("coverage") < target)
    return under.agg(F.min(F.struct("cutoff", "coverage")).alias("s")).select("s.*")


def interleave(first: DataFrame, second: DataFrame) -> DataFrame:
    """Zip two read sets by ordinal ``rid``; stops at the shorter."""
    def side(df, mate):
        return df.select("rid", F.struct(F.lit(mate).alias("mate"), "id", "seq", "qual").alias(f"m{mate}"))

    both = side(first, 1).join(side(second, 2), "rid")
    rows = both.select(F.col("rid").alias("pair_id"), F.inline(F.array("m1", "m2")))
    return rows.select((F.col("pair_id") * 2 + F.col("mate") - 1).alias("rid"), *rows.columns)


def unmatched_ordinals(first: DataFrame, second: DataFrame) -> DataFrame:
    """How many entries of each file have no partner."""
    full = first.select("rid", F.lit(1).alias("a")).join(second.select("rid", F.lit(1).alias("b")), "rid", "full")
    return full.agg(F.count_if(F.col("b").isNull()).alias("only_first"),
                    F.count_if(F.col("a").isNull()).alias("only_second"))


def deinterleave(reads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Alternate entries as mate 1 and mate 2, each with its own ordinal."""
    def side(parity):
        half = reads.filter(F.col("rid") % 2 == parity)
        return half.withColumn("rid", F.floor(F.col("rid") / 2))

    return side(0), side(1)


def keep_ids(df: DataFrame, ids: DataFrame, on: str = "id") -> DataFrame:
    return df.join(ids.select(on).distinct(), on, "left_semi")


def drop_ids(df: DataFrame, ids: DataFrame, on: str = "id") -> DataFrame:
    return df.join(ids.select(on).distinct(), on, "left_anti")


def join_quality(reads: DataFrame, qualities: DataFrame) -> DataFrame:
    return reads.drop("qual").join(qualities.select("id", "qual"), "id")


def remap_names(df: DataFrame, column: str, prefix: str = "s") -> tuple[DataFrame, DataFrame]:
    """Short running names and the table that maps them back."""
    mapping = number_rows(df.select(column).distinct(), [F.col(column)], name="k").select(
        column, F.concat(F.lit(prefix), F.col("k")).alias("short")
    )
    return df.join(mapping, column).drop(column).withColumnRenamed("short", column), mapping


def restore_names(df: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    back = mapping.select(F.col("short"), F.col(column).alias("_full"))
    joined = df.join(back, F.col(column) == F.col("short"))
    return joined.withColumn(column, F.col("_full")).drop("short", "_full")


def head(reads: DataFrame, n: int) -> DataFrame:
    """The first n entries by ordinal."""
    return reads.filter(F.col("rid") < n)


def short_entries(reads: DataFrame, n: int, min_length: int) -> DataFrame:
    """Which of the first n entries are below the minimum length."""
    return head(reads, n).filter(F.length("seq") < min_length)


def sample_n(df: DataFrame, n: int, key: str = "id", seed: int = 0) -> DataFrame:
    """Fixed-size sample without replacement, repeatable by hash of the key."""
    order = [F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), F.col(key)]
    order += [F.col(c) for c in df.columns if c != key and dict(df.dtypes)[c] != "variant" and not dict(df.dtypes)[c].startswith("map")]
    return df.orderBy(*order).limit(n)


def fastq_to_fasta_qual(reads: DataFrame, min_length: int = 50) -> tuple[DataFrame, DataFrame]:
    kept = reads.filter(F.length("seq") >= min_length)
    return kept.select("id", "seq"), kept.select("id", ph.numeric_quality(ph.phred("qual")).alias("qual"))


def with_quality(reads: DataFrame, error_rate: float) -> DataFrame:
    return reads.withColumn("qual", ph.constant_quality("seq", error_rate))


def normalize(reads: DataFrame, min_length: int = 1) -> DataFrame:
    """Four-line records of at least ``min_length`` bases with equal sequence and quality length."""
    return reads.filter((F.length("seq") >= min_length) & (F.length("seq") == F.length("qual")))


def clean_reads(reads: DataFrame, bad_slope: float = 0.5, **options) -> DataFrame:
    """Composition trim, then duplicates, then end trim and routing."""
    trimmed = trim_by_composition(reads, bad_slope)
    return clean(dedup_reads(trimmed), **options)


def prepare_reads(reads: DataFrame, genome_size: int, coverage: float = 100, **options) -> DataFrame:
    """Down to a coverage, then cleaned with thresholds from the data."""
    return clean_auto(downsample(reads, coverage=coverage, genome_size=genome_size), **options)


def filter_long_reads(reads: DataFrame, consensus_ids: DataFrame, genome_size: int,
                      min_avg_quality=10, target: float = 100) -> DataFrame:
    """Equal-length records, mean quality, length cutoff for coverage, minus consensus reads."""
    good = normalize(reads).filter(ph.mean_quality("qual") >= min_avg_quality)
    cutoff = length_cutoff(good, genome_size, target).select("cutoff").scalar()
    return drop_ids(good.filter(F.length("seq") >= cutoff), consensus_ids)
