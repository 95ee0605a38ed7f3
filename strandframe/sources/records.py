"""Multi-line records: flat-file genomes and assembly (ACE) files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import as_col
from ..operators import pieces


def _genome_records(spark: SparkSession, path) -> DataFrame:
    rows = spark.read.text(path, lineSep="//\n").select(F.col("_metadata.file_path").alias("file"), F.ltrim("value", F.lit("\n ")).alias("r"))
    return rows.filter(F.col("r").startswith("LOCUS")).withColumn("seqid", F.regexp_extract("r", r"^LOCUS\s+(\S+)", 1))


def genome_sequences(spark: SparkSession, path) -> DataFrame:
    origin = F.regexp_replace(F.substring_index("r", "\nORIGIN", -1), r"^[^\n]*\n", "")
    text = F.when(F.col("r").contains("\nORIGIN"), F.upper(F.regexp_replace(origin, r"[\s\d]", ""))).otherwise(F.lit(""))
    description = F.regexp_replace(F.regexp_extract("r", r"\nDEFINITION\s+([^\n]*(?:\n {12}[^\n]*)*)", 1), r"\s+", " ")
    return _genome_records(spark, path).select("file", "seqid", description.alias("description"), text.alias("seq"))


def genome_features(spark: SparkSession, path) -> DataFrame:
    """One row per feature with its ends, strand and qualifiers (``quals``: array of tag and value).

    ``places`` are the spans of a joined place in rising order, as ``genes.gene_sequences`` cuts them.
    """
    table = F.substring_index(F.substring_index("r", "\nFEATURES", -1), "\nORIGIN", 1)
    parts = F.split(F.regexp_replace(table, r"^[^\n]*\n", "\n"), r"\n {5}(?=\S)")
    rows = _genome_records(spark, path).filter(F.col("r").contains("\nFEATURES")).select("file", "seqid", F.posexplode(parts).alias("ord", "f"))
    rows = rows.filter(F.trim("f") != "")
    fields = F.split("f", r"\n {21}/")
    place = F.regexp_replace(F.regexp_replace(fields[0], r"^\S+\s+", ""), r"\s", "")
    # a joined place has several spans; a single number is a span of one base
    spans = F.regexp_extract_all(place, F.lit(r"\d+(?:\.\.[<>]?\d+)?"), F.lit(0))
    ends = F.transform(spans, lambda x: F.transform(F.regexp_extract_all(x, F.lit(r"\d+"), F.lit(0)), lambda n: n.cast("bigint")))
    places = F.array_sort(F.transform(ends, lambda x: F.struct(F.array_min(x).alias("lo"), F.array_max(x).alias("hi"))))

    def qualifier(q):
        flat = F.regexp_replace(q, r"\n {21}", " ")
        value = F.regexp_replace(F.regexp_replace(flat, r"^[^=]*=?", ""), r'^"|"\s*$', "")
        tag = F.substring_index(flat, "=", 1)
        return F.struct(F.trim(tag).alias("tag"), F.when(F.trim(tag) == "translation", F.replace(value, F.lit(" "), F.lit(""))).otherwise(value).alias("value"))

    return rows.select(
        "file", "seqid", "ord", F.regexp_extract(fields[0], r"^(\S+)", 1).alias("type"), F.array_min(F.transform(places, lambda x: x["lo"])).alias("lo"), F.array_max(F.transform(places, lambda x: x["hi"])).alias("hi"), places.alias("places"),
        F.when(place.contains("complement"), "-").otherwise("+").alias("strand"), place.rlike("[<>]").alias("truncated"),
        F.transform(F.slice(fields, F.lit(2), F.greatest(F.size(fields) - 1, F.lit(0))), qualifier).alias("quals"))


def feature_qualifiers(features: DataFrame) -> DataFrame:
    return features.select("file", "seqid", "ord", "type", F.posexplode("quals").alias("k", "q")).select("file", "seqid", "ord", "type", "k", "q.tag", "q.value")


def qualifier(tag: str) -> Column:
    """First value of a tag of a feature row."""
    return F.get(F.filter("quals", lambda q: q["tag"] == tag), F.lit(0))["value"]


def duplicate_locus_tags(features: DataFrame) -> DataFrame:
    """(type, locus tag) pairs that occur more than once; a reader treats any as an error."""
    tagged = features.withColumn("locus_tag", qualifier("locus_tag")).filter(F.col("locus_tag").isNotNull())
    return tagged.groupBy("type", "locus_tag").agg(F.count("*").alias("n")).filter("n > 1")


def read_genbank(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """Sequences and features; a locus tag that two features of one type share is an error."""
    features = genome_features(spark, path)
    twice = duplicate_locus_tags(features).first()
    if twice is not None:
        raise ValueError(f"duplicate locus tag {twice['locus_tag']} ({twice['type']})")
    return genome_sequences(spark, path), features


def _origin(seq, piece) -> Column:
    """Sixty bases a line in groups of ten, each line with its first position."""
    lines = F.regexp_extract_all(F.lower(as_col(seq)), F.lit(".{1,60}"), F.lit(0))
    return F.array_join(
        F.transform(lines, lambda t, i: F.concat(F.lpad((as_col(piece) * ORIGIN_WIDTH + i * 60 + 1).cast("string"), 9, " "), F.lit(" "), F.rtrim(F.regexp_replace(t, "(.{10})", "$1 ")))),
        "\n")


#: Bases of a piece of the sequence part: whole lines.
ORIGIN_WIDTH = 60 * 200


def genome_lines(sequences: DataFrame, features: DataFrame, division: str = "BCT") -> DataFrame:
    """Flat-file records as rows (seqid, section, at, value) that are written in this order.

    ``features``: seqid, lo, hi, strand, type, quals and, for joined places, ``places``. A row is a header, a
    feature or a piece of the sequence, so no row is as long as a record.
    """
    size = F.length("seq").cast("string")
    head = sequences.select("seqid", F.lit(0).alias("section"), F.concat_ws(
        "\n", F.concat(F.lit("LOCUS       "), F.rpad("seqid", 16, " "), F.lit(" "), size, F.lit(f" bp    DNA     linear   {division}")),
        F.concat(F.lit("DEFINITION  "), F.coalesce("description", F.lit("."))), F.lit("FEATURES             Location/Qualifiers"),
        F.concat(F.lit("     source          1.."), size)).alias("value"))
    ends = sequences.select("seqid", F.explode(F.array(F.struct(F.lit(2).alias("s"), F.lit("ORIGIN").alias("v")), F.struct(F.lit(4).alias("s"), F.lit("//").alias("v")))).alias("x"))
    ends = ends.select("seqid", F.col("x.s").alias("section"), F.col("x.v").alias("value"))

    def span(lo, hi):
        return F.concat(lo.cast("string"), F.lit(".."), hi.cast("string"))

    place = span(F.col("lo"), F.col("hi"))
    if "places" in features.columns:
        joined = F.concat(F.lit("join("), F.array_join(F.transform("places", lambda x: span(x["lo"], x["hi"])), ","), F.lit(")"))
        place = F.when(F.size("places") > 1, joined).otherwise(place)
    place = F.when(F.col("strand") == "-", F.concat(F.lit("complement("), place, F.lit(")"))).otherwise(place)
    quals = F.array_join(F.transform("quals", lambda q: F.concat(F.lit("\n" + " " * 21 + "/"), q["tag"], F.lit('="'), q["value"], F.lit('"'))), "")
    known = features.join(sequences.select("seqid").distinct(), "seqid", "left_semi")
    own = known.select(
        "seqid", F.lit(1).alias("section"), F.struct(F.col("lo").cast("bigint").alias("a"), F.col("hi").cast("bigint").alias("b"), F.col("type").alias("c")).alias("at"),
        F.concat(F.lit("     "), F.rpad("type", 16, " "), place, quals).alias("value"))
    nowhere = F.lit(None).cast("struct<a:bigint,b:bigint,c:string>").alias("at")
    text = pieces.cut(sequences, "seqid", width=ORIGIN_WIDTH).select(
        "seqid", F.lit(3).alias("section"), F.struct(F.col("piece").alias("a"), F.lit(0).cast("bigint").alias("b"), F.lit("").alias("c")).alias("at"), _origin("seq", "piece").alias("value"))
    return head.select("seqid", "section", nowhere, "value").unionByName(own).unionByName(ends.select("seqid", "section", nowhere, "value")).unionByName(text)


def write_genbank(sequences: DataFrame, features: DataFrame, path: str, **options) -> None:
    """Records in order of ``seqid``, each whole in one file; the rows of a record are sorted, never held together."""
    lines = genome_lines(sequences, features, **options)
    lines.repartitionByRange("seqid").sortWithinPartitions("seqid", "section", "at", "value").select("value").write.text(path)


def read_ace(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """Contigs without pad characters, and the names of the reads placed in each."""
    rows = spark.read.text(path, lineSep="\nCO ").select(F.regexp_replace("value", "^CO ", "").alias("r")).filter(~F.col("r").startswith("AS "))
    name = F.regexp_extract("r", r"^(\S+)", 1)
    body = F.regexp_replace(F.substring_index("r", "\n\n", 1), r"^[^\n]*\n?", "")
    contigs = rows.select(name.alias("name"), F.regexp_replace(body, r"[\s*]", "").alias("seq"))
    reads = rows.select(name.alias("contig"), F.explode(F.regexp_extract_all("r", F.lit(r"(?m)^AF (\S+)"), F.lit(1))).alias("id"))
    return contigs, reads


def gff3_to_genbank(spark: SparkSession, gff: str, fasta: str, out: str) -> None:
    """Feature and sequence files -> flat-file records."""
    from .reads import read_fasta
    from .tables import read_gff3

    sequences = read_fasta(spark, fasta, first_word_only=True).select(F.col("name").alias("seqid"), "seq", F.lit(None).cast("string").alias("description"))
    rows = read_gff3(spark, gff).select(
        "seqid", F.col("start").alias("lo"), F.col("end").alias("hi"), "strand", "type",
        F.transform(F.array_sort(F.map_entries("attrs")), lambda e: F.struct(F.lower(e["key"]).alias("tag"), e["value"].alias("value"))).alias("quals"))
    write_genbank(sequences, rows, out)
