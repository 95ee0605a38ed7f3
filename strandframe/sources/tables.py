"""Line-oriented tables: SAM, GFF3, PSL, hits, pipe tables, VCF, pileup, status files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import first_of_key, keyed

# Column names of the formats.
HIT_COLUMNS = ("name1 string, name2 string, percent_id double, al_len long, mismatch_bp long, gap_openings long, "
               "start1 long, end1 long, start2 long, end2 long, evalue double, bitscore double")
PIPE_HITS = ("locus_tag target_id evalue coverage db_name identity length description rank score bits "
             "percent_conserved hit_accession hit_name").split()
SIDE_TABLES = {
    "blast": [c if c != "target_id" else "uniprot_id" for c in PIPE_HITS],
    "vfdb_hits": PIPE_HITS, "cogs_hits": PIPE_HITS, "is_hits": PIPE_HITS, "pdb_hits": PIPE_HITS,
    "card_hits": PIPE_HITS, "argannot_hits": PIPE_HITS,
    "ipr_matches": "locus_tag accession_num product database_name start end evalue status evidence".split(),
    "signalp_hmm": "locus_tag prediction signal_peptide_probability max_cleavage_site_probability start end".split(),
    "signalp_nn": "locus_tag measure_type start end value cutoff is_signal_peptide".split(),
    "tmhmm": "locus_tag length predicted_number expected_number_aa expected_number_aa_60 total_prob_n_in".split(),
    "tmhmm_location": "locus_tag location start end".split(),
    "uniprot": "ac ac2 source product pro_type gene_type gene_name gene_id".split(),
    "uniprot_evidence": "ac dbId db name".split(),
}
PSL_COLUMNS = ("match long, mismatch long, repmatch long, ncount long, qgapcount long, qgapbases long, tgapcount long, "
               "tgapbases long, strand string, qname string, qsize long, qstart long, qend long, tname string, tsize long, "
               "tstart long, tend long, blockcount int, blocksizes string, qstarts string, tstarts string")


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path)


def _tab(i: int) -> Column:
    return F.get(F.col("_f"), F.lit(i))


def read_sam(spark: SparkSession, path) -> DataFrame:
    """Alignment rows with typed columns; tags as a map from name to value, types beside it."""
    body = _lines(spark, path).filter(~F.col("value").rlike("^@[A-Z]{2}\t") & (F.col("value") != ""))
    split = body.select(F.split("value", "\t").alias("_f")).filter(F.size("_f") >= 11)
    extra = F.transform(F.slice("_f", F.lit(12), F.greatest(F.size("_f") - 11, F.lit(0))), lambda t: F.split(t, ":", 3))
    names = "qname flag rname pos mapq cigar rnext pnext tlen seq qual".split()
    kinds = {"flag": "int", "mapq": "int", "pos": "bigint", "pnext": "bigint", "tlen": "bigint"}
    return split.select(
        *[_tab(i).cast(kinds.get(n, "string")).alias(n) for i, n in enumerate(names)],
        first_of_key(F.transform(extra, lambda t: F.struct(t[0].alias("k"), t[2].alias("v")))).alias("tags"),
        first_of_key(F.transform(extra, lambda t: F.struct(t[0].alias("k"), t[1].alias("v")))).alias("tag_types"),
    ).withColumn("rg", F.try_element_at("tags", F.lit("RG")))


def sam_header(spark: SparkSession, path) -> DataFrame:
    """Header lines as (kind, key, tags)."""
    lines = _lines(spark, path).filter(F.col("value").rlike("^@[A-Z]{2}\t"))
    tags = first_of_key(F.transform(
        F.filter(F.slice(F.split("value", "\t"), F.lit(2), F.greatest(F.size(F.split("value", "\t")) - 1, F.lit(0))), lambda t: t.contains(":")),
        lambda t: F.struct(F.split(t, ":", 2)[0].alias("k"), F.split(t, ":", 2)[1].alias("v"))))
    out = lines.select(F.substring("value", 2, 2).alias("kind"), tags.alias("tags"))
    return out.withColumn("key", F.coalesce(F.try_element_at("tags", F.lit("SN")), F.try_element_at("tags", F.lit("ID")), F.lit("")))


def sequence_dictionary(header: DataFrame) -> DataFrame:
    return header.filter("kind = 'SQ'").select(F.col("key").alias("name"), F.col("tags")["LN"].cast("bigint").alias("length"))


def read_group_table(header: DataFrame) -> DataFrame:
    return header.filter("kind = 'RG'").select(F.col("key").alias("rg"), F.try_element_at("tags", F.lit("LB")).alias("library"))


def sam_line() -> Column:
    """One alignment row as text; ``tags`` is an array of ready ``XX:i:1`` texts when present."""
    return F.concat_ws("\t", *[F.col(c).cast("string") for c in "qname flag rname pos mapq cigar rnext pnext tlen seq qual".split()])


def write_sam(df: DataFrame, path: str, header: Sequence[str] = ()) -> None:
    """Rows in their present order; ``header`` lines come first, in a part of their own."""
    text = F.concat_ws("\t", sam_line(), F.array_join("tag_text", "\t")) if "tag_text" in df.columns else sam_line()
    rows = df.select(text.alias("value"))
    if header:
        top = df.sparkSession.createDataFrame([(h,) for h in header], "value string").coalesce(1)
        rows = top.unionByName(rows)
    rows.write.text(path)


def read_gff3(spark: SparkSession, path) -> DataFrame:
    """Nine columns, '.' as null, attributes as a map."""
    rows = _lines(spark, path).filter(~F.col("value").startswith("#") & F.col("value").contains("\t"))
    split = rows.select(F.split("value", "\t").alias("_f")).filter(F.size("_f") >= 9)

    def col(i):
        return F.nullif(_tab(i), F.lit("."))

    return split.select(
        col(0).alias("seqid"), col(1).alias("source"), col(2).alias("type"), col(3).cast("bigint").alias("start"),
        col(4).cast("bigint").alias("end"), col(5).try_cast("double").alias("score"), col(6).alias("strand"), col(7).alias("phase"),
        keyed(col(8), ";", "=").alias("attrs"))


GFF_KNOWN = "ID Name Alias Parent Target Gap Derives_from Note Dbxref Ontology_term".split()


def known_attributes(gff: DataFrame) -> DataFrame:
    return gff.select("*", *[F.try_element_at("attrs", F.lit(a)).alias(a) for a in GFF_KNOWN])


def write_gff3(features: DataFrame, path: str, source: str) -> None:
    """Sorted by sequence, start and falling end. Columns: seqname, type, lo, hi, score, strand, attributes."""
    dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    line = F.concat_ws("\t", dot("seqname"), F.lit(source), dot("type"), dot("lo"), dot("hi"), dot("score"), dot("strand"), F.lit("."), dot("attributes"))
    keys = [F.col("seqname"), F.col("lo"), F.col("hi").desc()]
    features.repartitionByRange(*keys).sortWithinPartitions(*keys).select(line.alias("value")).write.text(path)


def _longs(text: str) -> Column:
    parts = F.filter(F.split(text, ","), lambda x: x != "")
    return F.transform(parts, lambda x: x.cast("bigint"))


def read_psl(spark: SparkSession, path) -> DataFrame:
    """Block alignments; the three comma lists become arrays."""
    rows = _lines(spark, path).filter(F.col("value").rlike("^[0-9]"))
    split = rows.select(F.split("value", "\t").alias("_f"))
    typed = split.select(*[_tab(i).cast(c.split()[1].replace("long", "bigint")).alias(c.split()[0]) for i, c in enumerate(PSL_COLUMNS.split(", "))])
    return typed.withColumns({c: _longs(c) for c in ("blocksizes", "qstarts", "tstarts")})


def psl_blocks(psl: DataFrame, keys: Sequence[str]) -> DataFrame:
    zipped = F.arrays_zip("blocksizes", "qstarts", "tstarts")
    return psl.select(*keys, F.posexplode(zipped).alias("block", "b")).select(
        *keys, "block", F.col("b.blocksizes").alias("size"), F.col("b.qstarts").alias("qstart"), F.col("b.tstarts").alias("tstart"))


def psl_clusters(psl: DataFrame, reach: int = 0, width: int = 1 << 14) -> DataFrame:
    """Numbers alignments of a target that overlap (or lie within ``reach``) with the same cluster.

    A cluster begins where no earlier alignment reaches: the running maximum of the
    ends, in two levels over distinct starts.
    """
    from pyspark.sql import Window

    from ..operators.scale import running_sum

    ends = psl.groupBy("tname", "tstart").agg(F.max("tend").alias("e")).withColumn("_b", F.floor(F.col("tstart") / width))
    tops = ends.groupBy("tname", "_b").agg(F.max("e").alias("_m"))
    prior = Window.partitionBy("tname").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("tname", "_b", F.max("_m").over(prior).alias("_before"))
    inside = Window.partitionBy("tname", "_b").orderBy("tstart").rowsBetween(Window.unboundedPreceding, -1)
    joined = ends.join(tops, ["tname", "_b"])
    seen = F.greatest(F.max("e").over(inside), F.col("_before"))
    marked = joined.withColumn("new", F.when(seen.isNull() | (F.col("tstart") > seen + reach), 1).otherwise(0))
    numbered = running_sum(marked.select("tname", "tstart", "new"), ["tname"], "tstart", {"cluster": "new"}, width)
    return psl.join(numbered.drop("new"), ["tname", "tstart"])


def read_hits(spark: SparkSession, path) -> DataFrame:
    return spark.read.csv(path, schema=HIT_COLUMNS, sep="\t", comment="#")


def escape_pipes(c) -> Column:
    return F.replace(F.col(c).cast("string") if isinstance(c, str) else c, F.lit("|"), F.lit("\\|"))


def write_pipe(df: DataFrame, path: str) -> None:
    """Columns joined by pipes, pipes inside a value escaped; null is empty."""
    cells = [F.coalesce(escape_pipes(c), F.lit("")) for c in df.columns]
    df.select(F.concat_ws("|", *cells).alias("value")).write.text(path)


def read_pipe(spark: SparkSession, path, columns: Sequence[str]) -> DataFrame:
    cells = F.transform(F.split("value", r"(?<!\\)\|"), lambda x: F.replace(x, F.lit("\\|"), F.lit("|")))
    rows = _lines(spark, path).filter(F.trim("value") != "").select(cells.alias("_f"))
    return rows.select(*[_tab(i).alias(c) for i, c in enumerate(columns)])


def read_side_table(spark: SparkSession, path, name: str) -> DataFrame:
    return read_pipe(spark, path, SIDE_TABLES[name]).distinct()


def read_vcf(spark: SparkSession, path) -> DataFrame:
    """Variant rows; INFO also as a map, alternates and samples as arrays."""
    rows = _lines(spark, path).filter(~F.col("value").startswith("#") & (F.col("value") != ""))
    split = rows.select(F.split("value", "\t").alias("_f"))
    return split.select(
        _tab(0).alias("chrom"), _tab(1).cast("bigint").alias("pos"), _tab(2).alias("id"), _tab(3).alias("ref"), _tab(4).alias("alt"),
        _tab(5).try_cast("double").alias("qual"), _tab(6).alias("filter"), _tab(7).alias("info"), _tab(8).alias("format"),
        F.slice("_f", F.lit(10), F.greatest(F.size("_f") - 9, F.lit(0))).alias("samples"),
        keyed(_tab(7), ";", "=").alias("info_map"), F.split(_tab(4), ",").alias("alts"))


def vcf_header(spark: SparkSession, path) -> DataFrame:
    return _lines(spark, path).filter(F.col("value").startswith("#")).select(F.col("value").alias("line"))


def write_vcf(variants: DataFrame, path: str, header: DataFrame | None = None, fileformat: str = "VCFv4.0", samples: Sequence[str] = ()) -> None:
    """Header lines are kept; rows are written in order of chromosome and position."""
    spark = variants.sparkSession
    fixed = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO" + ("\tFORMAT\t" + "\t".join(samples) if samples else "")
    top = header.select(F.col("line").alias("value")) if header is not None else spark.createDataFrame(
        [(f"##fileformat={fileformat}",), (fixed,)], "value string").coalesce(1)
    cells = [F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in "chrom pos id ref alt qual filter info".split()]
    if samples:
        cells += [F.col("format"), F.array_join("samples", "\t")]
    body = variants.repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos").select(F.concat_ws("\t", *cells).alias("value"))
    top.unionByName(body).write.text(path)


def read_keyed_csv(spark: SparkSession, path, key: str) -> DataFrame:
    """CSV with a header; the last row of a key wins. The header must be unique and not empty."""
    raw = spark.read.csv(path, header=True)
    first = spark.read.text(path).first()
    names = [c.strip() for c in first[0].split(",")] if first else []
    if not names or "" in names or len(set(names)) != len(names):
        raise ValueError("the header must name every column once")
    # the reader numbers rows by file split, so ids grow along a file
    rows = raw.select("*", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i"))
    rest = [c for c in raw.columns if c != key]
    return rows.groupBy(key).agg(F.max(F.struct("_f", "_b", "_i", *rest)).alias("s")).select(key, *[F.col(f"s.{c}").alias(c) for c in rest])


def read_pileup(spark: SparkSession, path) -> DataFrame:
    """Consensus-pileup rows; indel rows have alleles and counts, base rows have bases and qualities."""
    split = _lines(spark, path).select(F.split("value", "\t").alias("_f")).filter(F.size("_f") >= 8)
    indel = _tab(2) == "*"
    return split.select(
        _tab(0).alias("rname"), _tab(1).cast("bigint").alias("pos"), _tab(2).alias("ref"), _tab(3).alias("consensus"),
        _tab(4).cast("int").alias("quality"), _tab(5).cast("int").alias("snp_quality"), _tab(6).cast("int").alias("rms_mapq"),
        _tab(7).cast("bigint").alias("depth"), F.when(~indel, _tab(8)).alias("bases"), F.when(~indel, _tab(9)).alias("quals"),
        F.when(indel, _tab(8)).alias("allele1"), F.when(indel, _tab(9)).alias("allele2"),
        F.when(indel, _tab(10).try_cast("int")).alias("count1"), F.when(indel, _tab(11).try_cast("int")).alias("count2"),
        F.when(indel, F.lit("indel")).otherwise(F.lit("snp")).alias("kind"))


def tbl_lines(features: DataFrame) -> DataFrame:
    """Feature-table lines in order: (seqid, start, end, type, k, line).

    ``features`` has one row per tag: seqid, lo, hi, strand, type, tag, value. Equal
    places share one feature line.
    """
    back = F.col("strand") == "-"
    placed = features.withColumns({"start": F.when(back, F.col("hi")).otherwise(F.col("lo")), "end": F.when(back, F.col("lo")).otherwise(F.col("hi"))})
    titles = placed.select("seqid").distinct().select(
        "seqid", F.lit(None).cast("bigint").alias("start"), F.lit(None).cast("bigint").alias("end"), F.lit(None).cast("string").alias("type"),
        F.lit(0).alias("k"), F.concat(F.lit(">Feature "), "seqid").alias("line"))
    place = placed.select("seqid", "start", "end", "type").distinct().select(
        "*", F.lit(1).alias("k"), F.concat_ws("\t", "start", "end", "type").alias("line"))
    tags = placed.select("seqid", "start", "end", "type", F.lit(2).alias("k"), F.concat(F.lit("\t\t\t"), "tag", F.lit("\t"), "value").alias("line"))
    return titles.unionByName(place).unionByName(tags)


def write_tbl(features: DataFrame, path: str) -> None:
    keys = ["seqid", "start", "end", "type", "k", "line"]
    tbl_lines(features).repartitionByRange(*keys).sortWithinPartitions(*keys).select(F.col("line").alias("value")).write.text(path)


def read_status(spark: SparkSession, status, trim) -> DataFrame:
    """Assembler read status joined with trim points; ``placed`` tells assembled reads."""
    s = spark.read.csv(status, sep="\t", header=True, schema=(
        "name string, status string, contig5 string, pos5 long, strand5 string, contig3 string, pos3 long, strand3 string"))
    t = spark.read.csv(trim, sep="\t", header=True, schema=(
        "name string, trim_points string, trimmed_length long, orig_trim_points string, orig_length long, raw_length long"))
    joined = s.join(t, "name", "full")
    return joined.select(
        "name", "status", F.split("trim_points", "-")[0].cast("bigint").alias("trim_start"), "trimmed_length",
        F.when(F.col("strand5") == "-", 1).otherwise(0).alias("orientation"), "contig5", "pos5",
        F.coalesce(F.lower("status").contains("assembl"), F.lit(False)).alias("placed"))


def unplaced(status: DataFrame) -> DataFrame:
    return status.filter(F.col("status").isNotNull() & ~F.lower("status").rlike("assembled|full|partial")).select("name", "status")


def write_by_status(status: DataFrame, path: str) -> None:
    """Read names in one folder per status."""
    status.select("name", "status").write.partitionBy("status").text(path)

