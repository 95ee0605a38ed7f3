"""Read and contig files: FASTQ, FASTA and quality side files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dna, phred as ph
from ..operators.proximity import visited, written
from ..operators.scale import carry_forward, cumulative, number_rows


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their 0-based number within their file (``file``, ``n``, ``value``).

    A first pass counts the lines of every input split, which gives the number of
    the first line of each; that table has one row per split, no more than the
    driver's own list of tasks, and is broadcast. No line is moved.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"))
    counts = lines.groupBy("file", "_block").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    order = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "_block", (F.coalesce(F.sum("_n").over(order), F.lit(0)) - F.col("_first")).alias("_shift"))
    joined = lines.join(F.broadcast(starts), ["file", "_block"])
    return joined.select("file", (F.col("_id") + F.col("_shift")).alias("n"), "value")


def read_fastq(spark: SparkSession, path: str | list[str], poly: int = 2) -> DataFrame:
    """Four-line records, plain or gz, single (``poly=1``) or interleaved.

    ``rid`` counts over all files in order of their names. Rows leave hash
    partitioned by ``pair_id``, so a following pair window needs no shuffle.
    """
    lines = numbered_lines(spark, path)
    # Records begin at multiples of four; a file's records start after those of the files before.
    sizes = lines.groupBy("file").agg((F.ceil((F.max("n") + 1) / (4 * poly)) * poly).alias("_records"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file", F.coalesce(F.sum("_records").over(before), F.lit(0)).alias("_base"))
    placed = lines.join(F.broadcast(bases), "file").withColumns(
        {"rid": F.col("_base") + F.floor(F.col("n") / 4), "k": F.col("n") % 4})
    placed = placed.withColumn("pair_id", F.floor(F.col("rid") / poly)).repartition("pair_id")

    def line(k):
        return F.max(F.when(F.col("k") == k, F.col("value")))

    records = placed.groupBy("pair_id", "rid", "file").agg(
        line(0).alias("h"), F.coalesce(line(1), F.lit("")).alias("seq"), F.coalesce(line(3), F.lit("")).alias("qual"))
    return records.filter(F.col("h").startswith("@")).select(
        "rid", "pair_id", (F.col("rid") % poly + 1).cast("int").alias("mate"), "file",
        F.expr("substring(h, 2)").alias("id"), "seq", "qual")


def write_fastq(reads: DataFrame, path: str, compression: str | None = None) -> None:
    """Mates stay together and in order; the part files follow each other."""
    entry = F.concat(F.lit("@"), "id", F.lit("\n"), "seq", F.lit("\n+\n"), "qual")
    ordered = reads.repartitionByRange("pair_id").sortWithinPartitions("pair_id", "mate")
    ordered.select(entry.alias("value")).write.text(path, compression=compression)


def record_spans(lines: DataFrame, width: int = 1 << 14) -> DataFrame:
    """(file, head, plus, last) of wrapped records, from the lines (file, n, mark, raw, own) of all files.

    ``mark`` is the first character of a line, ``raw`` its length and ``own`` that without blanks around it. Any
    line that begins with '@' may be a header or part of a quality. Each such line says where a record from there on
    would end, by running sums of lengths, and so which header would follow; the true headers are those that these
    pointers reach from the first one. Nothing is read in order by one task.
    """
    # sums and the next "+" within buckets of lines, which are moved once; a row per bucket has what lies around it
    forth = Window.partitionBy("file", "_bucket").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("file", "_bucket").orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = lines.withColumn("_bucket", F.floor(F.col("n") / width)).withColumns({"to_raw": F.sum("raw").over(forth), "to_own": F.sum("own").over(forth)})
    plus = F.when(F.col("mark") == "+", F.struct(F.col("n").alias("plus"), "to_raw", (F.col("to_own") - F.col("own")).alias("to_own")))
    summed = summed.withColumn("_first", plus).withColumn("_plus", F.when(F.col("mark") == "@", F.last("_first", ignorenulls=True).over(back)))
    summed = written(summed.select("file", "_bucket", "n", (F.col("mark") == "@").alias("_head"), "to_raw", "to_own", "_first", "_plus"), "fastq-lines")
    per = summed.groupBy("file", "_bucket").agg(F.max("n").alias("_n"), F.max("to_raw").alias("_r"), F.max("to_own").alias("_o"), F.min("_first").alias("_f"))
    before, after = (Window.partitionBy("file").orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col("_bucket"), F.col("_bucket").desc()))
    per = per.withColumns({"_raw": F.coalesce(F.sum("_r").over(before), F.lit(0)), "_own": F.coalesce(F.sum("_o").over(before), F.lit(0))})

    def moved(p):
        return F.when(p.isNotNull(), F.struct(p["plus"].alias("plus"), (p["to_raw"] + F.col("_raw")).alias("to_raw"), (p["to_own"] + F.col("_own")).alias("to_own")))

    per = per.withColumn("_later", F.last(moved(F.col("_f")), ignorenulls=True).over(after))
    per = per.withColumn("_last", F.max("_n").over(Window.partitionBy("file")))
    per = written(per.select("file", "_bucket", "_raw", "_own", "_later", "_last", (F.col("_raw") + F.col("_r")).alias("_top")), "fastq-buckets")
    heads = summed.filter("_head").join(F.broadcast(per), ["file", "_bucket"]).withColumn("_plus", F.coalesce(moved(F.col("_plus")), F.col("_later")))
    heads = heads.select(
        "file", "_bucket", F.col("n").alias("head"), "_last", "_top", F.coalesce("_plus.plus", F.col("_last") + 1).alias("plus"),
        # where the quality is as long as the sequence
        (F.col("_plus.to_raw") + F.col("_plus.to_own") - F.col("to_own") - F.col("_own")).alias("x"))
    heads = written(heads, "fastq-heads")
    # the bucket in which that place is, mostly the head's own
    near, far = heads.filter("x <= _top"), heads.filter("x IS NULL OR x > _top").drop("_bucket")
    tops = per.select("file", F.col("_top").alias("x"), F.col("_bucket").alias("_to")).unionByName(far.filter("x IS NOT NULL").select("file", "x", F.lit(None).cast("bigint").alias("_to")))
    tops = tops.groupBy("file", "x").agg(F.min("_to").alias("_to")).withColumn("_m", -F.col("x"))
    far = far.join(carry_forward(tops, ["file"], "_m", "_to").select("file", "x", F.col("_to").alias("_bucket")), ["file", "x"], "left")
    far = written(far.select(*heads.columns), "fastq-far")
    asked = near.unionByName(far.filter("_bucket IS NOT NULL"))
    asked = asked.join(F.broadcast(per.select("file", "_bucket", "_raw")), ["file", "_bucket"]).select(
        "file", "_bucket", (F.col("x") - F.col("_raw")).alias("x"), F.lit(None).cast("bigint").alias("n"), "head", "plus")
    known = summed.select("file", "_bucket", F.col("to_raw").alias("x"), "n")
    reach = Window.partitionBy("file", "_bucket").orderBy(F.col("x").desc()).rangeBetween(Window.unboundedPreceding, 0)
    found = asked.unionByName(known, allowMissingColumns=True).withColumn("last", F.min("n").over(reach)).filter(F.col("head").isNotNull())
    spans = found.select("file", "head", "plus", "last").unionByName(far.filter("_bucket IS NULL").select("file", "head", "plus", F.col("_last").alias("last")))
    spans = written(spans, "fastq-spans")

    order = cumulative(spans.select("file", "head").withColumn("_one", F.lit(1)), [F.col("head")], ["file"], "_one", "_before")
    numbered = order.select("file", "head", (F.col("_before") + 1).alias("idx"))
    marks = numbered.select("file", F.col("head").alias("at"), "idx").unionByName(spans.select("file", (F.col("last") + 1).alias("at"), F.lit(None).cast("bigint").alias("idx")))
    marks = marks.groupBy("file", "at").agg(F.max("idx").alias("succ")).withColumn("_m", -F.col("at"))
    following = carry_forward(marks, ["file"], "_m", "succ").select("file", F.col("at").alias("_at"), "succ")
    jumps = spans.withColumn("_at", F.col("last") + 1).join(following, ["file", "_at"]).join(numbered, ["file", "head"])
    jumps = written(jumps.select(F.col("file").alias("name"), "idx", "succ", "head", "plus", "last"), "fastq-jumps")
    true = visited(jumps).join(jumps, ["name", "idx"])
    return true.select(F.col("name").alias("file"), "head", "plus", "last")


def normalize_fastq(spark: SparkSession, path: str, min_length: int = 1, width: int = 1 << 14) -> DataFrame:
    """Records whose sequence and quality run over several lines: (file, rid, id, seq, qual), ``rid`` per file from 0.

    A record without a quality line, or cut off by the end of its file, has what is there.
    """
    lines = numbered_lines(spark, path)
    # a number stands for the path of a file, one row per file: rows that are sorted and moved are short
    files = lines.groupBy("file").agg(F.count("*").alias("_lines"))
    files = written(files.select("file", F.row_number().over(Window.orderBy("file")).alias("_file")), "fastq-files")
    lines = lines.join(F.broadcast(files), "file").select(F.col("_file").alias("file"), "n", "value")
    spans = record_spans(lines.select(
        "file", "n", F.left("value", F.lit(1)).alias("mark"), F.length("value").cast("bigint").alias("raw"), F.length(F.trim("value")).cast("bigint").alias("own")), width)
    spans = number_rows(spans, [F.col("head")], within=["file"], name="rid", first=0)
    # lines and records meet in buckets of lines; a record is sent to each one that it touches
    first, end = F.floor(F.col("head") / width), F.floor(F.col("last") / width)
    sent = spans.withColumn("_bucket", F.explode(F.sequence(first, end))).select(
        "file", "_bucket", F.greatest("head", F.col("_bucket") * width).alias("n"), F.lit(None).cast("string").alias("value"), F.struct("rid", "head", "plus", "last").alias("_of"))
    met = sent.unionByName(lines.withColumn("_bucket", F.floor(F.col("n") / width)), allowMissingColumns=True)
    inside = Window.partitionBy("file", "_bucket").orderBy("n", F.col("value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    held = met.withColumn("_of", F.last("_of", ignorenulls=True).over(inside)).filter(F.col("value").isNotNull() & (F.col("n") <= F.col("_of.last")))

    def text(wanted, order, value):
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(wanted, F.struct(order, value.alias("v"))))), lambda x: x["v"]), "")

    n, of, always = F.col("n"), F.col("_of"), F.lit(True)
    parts = held.groupBy("file", "_bucket", of["rid"].alias("rid"), (F.floor(of["head"] / width) == F.floor(of["last"] / width)).alias("_whole")).agg(
        F.max(F.when(n == of["head"], F.expr("substring(value, 2)"))).alias("id"),
        text((n > of["head"]) & (n < of["plus"]), "n", F.trim("value")).alias("seq"), text(n > of["plus"], "n", F.col("value")).alias("qual"))
    parts = written(parts, "fastq-parts")
    # only records across an edge of buckets are moved again
    whole = parts.filter("_whole").select("file", "rid", "id", "seq", "qual")
    cut = parts.filter("NOT _whole").groupBy("file", "rid").agg(
        F.max("id").alias("id"), text(always, "_bucket", F.col("seq")).alias("seq"), text(always, "_bucket", F.col("qual")).alias("qual"))
    records = whole.unionByName(cut).join(F.broadcast(files.select(F.col("_file").alias("file"), F.col("file").alias("_path"))), "file")
    return records.select(F.col("_path").alias("file"), "rid", "id", "seq", "qual").filter(F.length("seq") >= min_length)


def read_fasta(spark: SparkSession, path: str | list[str], first_word_only: bool = False, clean: bool = True) -> DataFrame:
    """One row per record (file, name, seq); the record separator is the line break before ``>``."""
    records = spark.read.text(path, lineSep="\n>").select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "^>", "").alias("v"))
    name = F.trim(F.substring_index("v", "\n", 1))
    body = F.regexp_replace("v", r"^[^\n]*\n?", "")
    out = records.select(
        "file", (F.regexp_extract(name, r"^(\S*)", 1) if first_word_only else name).alias("name"),
        (dna.clean_sequence(body) if clean else F.trim(F.regexp_replace(body, r"\s+", " "))).alias("seq"))
    return out.filter(F.col("name") != "")


def write_fasta(sequences: DataFrame, path: str, width: int = 80, order: str = "name", description: str | None = None) -> None:
    """Wrapped records in order of ``name`` or falling ``length``."""
    keys = [F.length("seq").desc(), F.col("name")] if order == "length" else [F.col("name")]
    title = F.concat_ws(" ", "name", description) if description else F.col("name")
    entry = F.concat(F.lit(">"), title, F.lit("\n"), dna.wrap("seq", width))
    sequences.repartitionByRange(*keys).sortWithinPartitions(*keys).select(entry.alias("value")).write.text(path)


def write_qual(sequences: DataFrame, path: str, per_line: int = 60) -> None:
    """Numbers separated by blanks, ``per_line`` of them on a line (column ``qual``: quality text)."""
    numbers = ph.numeric_quality(ph.phred("qual"))
    wrapped = F.rtrim(F.regexp_replace(numbers, rf"((?:\d+ ){{{per_line}}})", "$1\n"), F.lit("\n "))
    entry = F.concat(F.lit(">"), "name", F.lit("\n"), wrapped)
    sequences.repartitionByRange("name").sortWithinPartitions("name").select(entry.alias("value")).write.text(path)


def read_fasta_qual(spark: SparkSession, fasta: str, qual: str) -> DataFrame:
    """Sequences with their numeric qualities, joined by name."""
    seqs = read_fasta(spark, fasta, first_word_only=True).select("name", "seq")
    numbers = read_fasta(spark, qual, first_word_only=True, clean=False).select("name", ph.parse_numeric_quality("seq").alias("qual"))
    return seqs.join(numbers, "name")


def deduplicate_names(sequences: DataFrame, names: Sequence[str] = ("name",)) -> DataFrame:
    """One row per name; of equal names the last file's stays."""
    return sequences.groupBy(*names).agg(F.max(F.struct("file", "seq")).alias("s")).select(*names, "s.*")
