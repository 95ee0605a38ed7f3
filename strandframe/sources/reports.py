"""Reports of gene, RNA, repeat and protein-feature predictors, and ortholog groups.

Headers apply to the lines below them; ``carry_forward`` brings them down without
putting a file into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scale import carry_forward
from .reads import numbered_lines

PREDICTION = ["seqname", "lo", "hi", "start", "stop", "strand", "type", "predictor"]


def _headed(spark: SparkSession, path, header: Column) -> DataFrame:
    lines = numbered_lines(spark, path).withColumn("seqname", header)
    return carry_forward(lines, ["file"], "n", "seqname")


def _words(column="value") -> Column:
    return F.split(F.trim(F.col(column)), r"\s+")


def _ends(start: Column, stop: Column) -> dict[str, Column]:
    return {"lo": F.least(start, stop), "hi": F.greatest(start, stop), "start": start, "stop": stop}


def read_glimmer(spark: SparkSession, path, lengths: DataFrame) -> DataFrame:
    """Ends beyond the sequence are moved in by one codon and marked; ``lengths``: name, length."""
    title = F.when(F.col("value").startswith(">"), F.trim(F.expr("substring(value, 2)")))
    rows = _headed(spark, path, title).filter(~F.col("value").startswith(">") & (F.trim("value") != ""))
    w = _words()
    rows = rows.select("seqname", w[1].cast("bigint").alias("a"), w[2].cast("bigint").alias("b"), w[3].alias("frame"), w[4].cast("double").alias("score"))
    rows = rows.join(lengths.select(F.col("name").alias("seqname"), F.col("length").alias("n")), "seqname", "left")

    def clamp(x):
        return F.when(F.col(x) < 1, F.col(x) + 3).when(F.col(x) > F.col("n"), F.col(x) - 3).otherwise(F.col(x))

    ends = _ends(clamp("a"), clamp("b"))
    return rows.select(
        "seqname", *[e.alias(k) for k, e in ends.items()], F.when(F.col("frame").contains("+"), "+").otherwise("-").alias("strand"),
        F.lit("CDS").alias("type"), F.lit("Glimmer3").alias("predictor"), "score",
        (F.least("a", "b") < 1).alias("extended_lo"), (F.greatest("a", "b") > F.col("n")).alias("extended_hi"))


def read_genemark(spark: SparkSession, path) -> DataFrame:
    title = F.when(F.col("value").startswith(">"), F.trim(F.expr("substring(value, 2)")))
    rows = _headed(spark, path, title).withColumn("w", _words()).filter((F.size("w") > 5) & F.col("w")[0].rlike(r"^\d+$"))
    left, right = F.replace(F.col("w")[2], F.lit("<"), F.lit("")).cast("bigint"), F.replace(F.col("w")[3], F.lit(">"), F.lit("")).cast("bigint")
    forward = F.col("w")[1] == "+"
    return rows.select(
        "seqname", left.alias("lo"), right.alias("hi"), F.when(forward, left).otherwise(right).alias("start"),
        F.when(forward, right).otherwise(left).alias("stop"), F.col("w")[1].alias("strand"), F.lit("CDS").alias("type"), F.lit("gmhmmp").alias("predictor"),
        F.get("w", F.lit(7)).try_cast("double").alias("score"), F.col("w")[2].contains("<").alias("extended_lo"), F.col("w")[3].contains(">").alias("extended_hi"))


def read_prodigal(spark: SparkSession, path) -> DataFrame:
    from .tables import read_gff3

    g = read_gff3(spark, path)
    forward = F.col("strand") == "+"
    return g.select(
        F.col("seqid").alias("seqname"), F.col("start").alias("lo"), F.col("end").alias("hi"), F.when(forward, F.col("start")).otherwise(F.col("end")).alias("start"),
        F.when(forward, F.col("end")).otherwise(F.col("start")).alias("stop"), "strand", "type", F.col("source").alias("predictor"), "score")


def read_trna(spark: SparkSession, path) -> DataFrame:
    """tRNA table with three title lines; the strand follows from the order of the ends."""
    rows = numbered_lines(spark, path).filter("n >= 3").select(F.transform(F.split("value", "\t"), lambda x: F.trim(x)).alias("w")).filter(F.size("w") >= 9)
    a, b = F.col("w")[2].cast("bigint"), F.col("w")[3].cast("bigint")
    anticodon = F.col("w")[5]
    return rows.select(
        F.col("w")[0].alias("seqname"), *[e.alias(k) for k, e in _ends(a, b).items()], F.when(a < b, "+").otherwise("-").alias("strand"),
        F.lit("tRNA").alias("type"), F.lit("tRNAscanSE").alias("predictor"), F.col("w")[8].cast("double").alias("score"),
        F.col("w")[4].alias("trna_type"), anticodon.alias("anticodon"), F.reverse(F.translate(anticodon, "ATGC", "TACG")).alias("codon"))


def read_rrna(spark: SparkSession, path) -> DataFrame:
    lines = spark.read.text(path).filter(~F.trim("value").startswith("#") & F.col("value").contains("\t"))
    w = F.split("value", "\t")
    a, b = w[3].cast("bigint"), w[4].cast("bigint")
    return lines.select(
        w[0].alias("seqname"), *[e.alias(k) for k, e in _ends(a, b).items()], w[6].alias("strand"), F.lit("rRNA").alias("type"),
        w[1].alias("predictor"), w[5].try_cast("double").alias("score"), F.nullif(F.upper(F.regexp_extract(w[8], r"(\d+[sS])", 1)), F.lit("")).alias("rrna_type"))


def _repeat_regions(repeats: DataFrame, predictor: str) -> DataFrame:
    regions = repeats.groupBy("file", "seqname", "crispr").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.avg("score").alias("score"), F.count("*").alias("repeats"))
    return regions.select("seqname", "crispr", "lo", "hi", F.col("lo").alias("start"), F.col("hi").alias("stop"), F.lit("+").alias("strand"),
                          F.lit("repeat_region").alias("type"), F.lit(predictor).alias("predictor"), "score", "repeats")


def read_crt(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """Direct repeats and repeat regions of the recognition-tool report."""
    v = F.col("value")
    lines = numbered_lines(spark, path)
    organism = F.nullif(F.trim(F.regexp_extract(v, r"ORGANISM:\s+(.+)", 1)), F.lit(""))
    lines = carry_forward(lines.withColumn("seqname", organism), ["file"], "n", "seqname")
    array = F.when(v.rlike(r"CRISPR \d+"), F.regexp_extract(v, r"CRISPR (\d+)", 1)).when(v.startswith("Repeats"), F.lit("none"))
    lines = carry_forward(lines.withColumn("crispr", array), ["file"], "n", "crispr")
    w = F.split(v, "\t+")
    rows = lines.filter(F.col("crispr").isNotNull() & (F.col("crispr") != "none") & v.rlike(r"^\d+\t"))
    repeats = rows.select("file", "seqname", "crispr", w[0].cast("bigint").alias("lo"), (w[0].cast("bigint") + F.length(w[1]) - 1).alias("hi"),
                          F.lit(None).cast("double").alias("score"))
    return repeats.drop("file"), _repeat_regions(repeats, "CrisprRecognitionTool")


def read_pilercr(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """Direct repeats and repeat regions of the detail part of the report."""
    v = F.col("value")
    lines = numbered_lines(spark, path)
    stage = F.when(v.contains("DETAIL REPORT"), "detail").when(v.contains("SUMMARY BY SIMILARITY"), "similarity").when(v.contains("SUMMARY BY POSITION"), "position")
    lines = carry_forward(lines.withColumn("stage", stage), ["file"], "n", "stage").filter("stage = 'detail'")
    array = F.nullif(F.regexp_extract(v, r"^Array\s+(\d+)", 1), F.lit(""))
    lines = carry_forward(lines.withColumn("crispr", array), ["file"], "n", "crispr")
    title = F.when(v.startswith(">"), F.regexp_extract(v, r"^>(\S*)", 1))
    lines = carry_forward(lines.withColumn("seqname", title), ["file"], "n", "seqname")
    # after the second rule of an array comes its total, not a repeat
    rules = F.when(v.startswith("="), F.lit(1)).otherwise(0)
    from ..operators.scale import running_sum

    lines = running_sum(lines.withColumn("_r", rules), ["file"], "n", {"rules": "_r"})
    w = _words()
    rows = lines.filter((F.col("rules") % 2 == 1) & v.rlike(r"^\s*\d+\s+\d+\s"))
    repeats = rows.select("file", "seqname", "crispr", w[0].cast("bigint").alias("lo"), (w[0].cast("bigint") + w[1].cast("bigint") - 1).alias("hi"), w[2].cast("double").alias("score"))
    return repeats.drop("file"), _repeat_regions(repeats, "Piler-CR")


def read_predictions(spark: SparkSession, path, kind: str, **options) -> DataFrame:
    """Any of the gene, RNA and repeat reports as prediction rows."""
    readers = {
        "glimmer": read_glimmer, "genemark": read_genemark, "prodigal": read_prodigal, "trna": read_trna, "rrna": read_rrna,
        "crt": lambda s, p: read_crt(s, p)[1], "pilercr": lambda s, p: read_pilercr(s, p)[1],
    }
    return readers[kind](spark, path, **options).select(*PREDICTION)


def read_signal_peptides(spark: SparkSession, path) -> DataFrame:
    """Measures of the network part: C, Y, S, mean S and D with position, value, cutoff, decision."""
    v = F.col("value")
    lines = numbered_lines(spark, path)
    name = F.coalesce(F.nullif(F.regexp_extract(v, r"Name=(\S+)", 1), F.lit("")), F.when(v.startswith(">"), F.regexp_extract(v, r"^>(\S+)", 1)))
    lines = carry_forward(lines.withColumn("name", name), ["file"], "n", "name")
    pattern = r"^\s*(max\. [CYS]|mean S|D)\s+(\d+(?:-\d+)?)\s+([\d.]+)(?:\s+([\d.]+))?(?:\s+(YES|NO))?"
    g = [F.nullif(F.regexp_extract(v, pattern, i), F.lit("")) for i in range(1, 6)]
    span = F.split(g[1], "-")
    return lines.filter(v.rlike(pattern)).select(
        "name", g[0].alias("measure"), span[0].cast("int").alias("start"), F.coalesce(F.get(span, F.lit(1)), span[0]).cast("int").alias("end"),
        g[2].cast("double").alias("value"), g[3].cast("double").alias("cutoff"), g[4].alias("decision"))


def read_signal_hmm(spark: SparkSession, path) -> DataFrame:
    """Model part: decision, probability and cleavage site per protein."""
    v = F.col("value")
    lines = carry_forward(numbered_lines(spark, path).withColumn("name", F.when(v.startswith(">"), F.regexp_extract(v, r"^>(\S+)", 1))), ["file"], "n", "name")
    site = r"^Max cleavage site probability:\s+(\S+)\s+between pos.\s+(\S+)\s+and\s+(\S+)"

    def found(pattern, group=1):
        return F.max(F.nullif(F.regexp_extract(v, pattern, group), F.lit("")))

    # three lines of a block match; the others vanish before the shuffle
    kept = lines.filter(v.rlike("^(Prediction:|Signal peptide probability:|Max cleavage site probability:)"))
    return kept.groupBy("name").agg(
        found(r"^Prediction: (.+)$").alias("decision"), found(r"^Signal peptide probability: (\S+)").cast("double").alias("probability"),
        found(site).cast("double").alias("cleavage"), found(site, 2).cast("int").alias("start"), found(site, 3).cast("int").alias("end"))


def read_transmembrane(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """Segments (name, location, start, end) and one row of measures per protein."""
    lines = spark.read.text(path)
    v = F.col("value")
    pattern = r"^(\S+)\s+(\S+)\s+(\w+)\s+(\d+)\s+(\d+)$"
    g = [F.regexp_extract(v, pattern, i) for i in range(1, 6)]
    segments = lines.filter(v.rlike(pattern) & ~v.startswith("#")).select(
        g[0].alias("name"), g[2].alias("location"), g[3].cast("int").alias("start"), g[4].cast("int").alias("end"))
    measures = {
        "length": r"Length: ", "predicted_number": r"Number of predicted TMHs: ", "expected_number_aa": r"Exp number of AAs in TMHs: ",
        "expected_number_aa_60": r"Exp number, first 60 AAs: ", "total_prob_n_in": r"Total prob of N-in: "}
    name = F.regexp_extract(v, r"^#\s*(\S+)\s", 1)
    stats = lines.filter(v.startswith("#")).groupBy(name.alias("name")).agg(
        *[F.max(F.nullif(F.regexp_extract(v, f"{p}\\s*(\\S+)", 1), F.lit(""))).cast("double").alias(k) for k, p in measures.items()])
    return segments, stats


def read_lipoproteins(spark: SparkSession, path) -> DataFrame:
    w = F.split(F.trim(F.regexp_replace("value", "^#", "")), r"\s+")
    rows = spark.read.text(path).select(w.alias("w")).filter(F.size("w") > 3)
    strip = lambda i, key: F.regexp_replace(F.get("w", F.lit(i)), f"^{key}=", "")
    site = F.split(strip(4, "cleavage"), "-")
    return rows.select(
        F.col("w")[0].alias("name"), F.col("w")[1].alias("location"), strip(2, "score").cast("double").alias("score"),
        strip(3, "margin").cast("double").alias("margin"), F.get(site, F.lit(0)).cast("int").alias("start"), F.get(site, F.lit(1)).cast("int").alias("end"))


def read_cog_groups(spark: SparkSession, path) -> DataFrame:
    """Gene -> group rows. A bracketed line opens a group, a line of underscores closes it."""
    v = F.trim("value")
    opened = F.when(v.rlike(r"^\[[^\]]+\]"), F.split(v, r"\s+")[1]).when(v.rlike("^_+$"), F.lit("NONE"))
    lines = carry_forward(numbered_lines(spark, path).withColumn("group_id", opened), ["file"], "n", "group_id")
    rows = lines.filter(~v.rlike(r"^\[[^\]]+\]") & ~v.rlike("^_*$"))
    genes = F.split(F.regexp_replace(v, r"^(?:\S*:\s+)+", ""), r"\s+")
    return rows.select(F.coalesce("group_id", F.lit("NONE")).alias("group_id"), F.explode(genes).alias("gene")).filter("gene <> ''")


def read_cog_descriptions(spark: SparkSession, path) -> DataFrame:
    v = F.col("value")
    rows = spark.read.text(path).filter(~v.rlike(r"^\s") & ~v.contains("___") & (v != ""))
    return rows.select(F.split(v, r"\s+")[1].alias("group_id"), F.regexp_replace(v, r"^\S+\s+\S+\s*", "").alias("description"))
