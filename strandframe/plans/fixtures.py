"""Genome-shaped views over the driver's tables.

Each view is one SELECT that Spark SQL and the oracle engine evaluate alike.
``dna`` and ``quality`` turn the md5 of an expression into 32 bases or 32
quality characters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scale import number_rows
from ..session import scratch_path

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def dna(x: str) -> str:
    return f"translate(md5({x}),'0123456789abcdef','ACGTACGTACGTACGT')"


def quality(x: str) -> str:
    return f"translate(md5({x}),'0123456789abcdef','#%(+.147:=@BDFHI')"


FX = {
    "fx_reads": f"""
SELECT event_id AS rid,
       CAST(floor(event_id / 2) AS BIGINT) AS pair_id,
       CAST(event_id % 2 + 1 AS INT) AS mate,
       concat('f', CAST(floor(event_id / 2) AS BIGINT) % 5) AS file,
       concat('r', CAST(floor(event_id / 2) AS BIGINT), '/', event_id % 2 + 1) AS id,
       replace(substr(concat({dna("concat('s', user_id % 40)")}, {dna("concat('t', event_id % 2)")}), 1, CAST(40 + user_id % 25 AS INT)), 'GTA', 'N.N') AS seq,
       substr(concat({quality("concat('q', event_id)")}, {quality("concat('p', event_id)")}), 1, CAST(40 + user_id % 25 AS INT)) AS qual
FROM events
""",
    "fx_contigs": f"""
SELECT * FROM (
  SELECT source AS file, concat('c', doc_id) AS name,
         translate(upper(regexp_replace(text, '[^A-Za-z]', '')), 'BDEFHIJKLMNOPQRSUVWXYZ', 'ACGTACGTACGTACGTACGTAC') AS seq
  FROM documents) t
WHERE length(seq) > 0
""",
    "fx_alignments": f"""
SELECT concat('q', l_orderkey, '_', l_linenumber) AS qname,
       CAST(1 + CASE WHEN l_linenumber % 2 = 1 THEN 64 ELSE 128 END
              + CASE WHEN l_linestatus = 'O' THEN 16 ELSE 0 END
              + CASE WHEN l_quantity >= 48 THEN 4 ELSE 0 END
              + CASE WHEN l_quantity <= 2 THEN 8 ELSE 0 END
              + CASE WHEN l_returnflag = 'R' THEN 1024 ELSE 2 END AS INT) AS flag,
       concat('chr', l_suppkey % 10) AS rname,
       l_partkey + 1 AS pos,
       CAST(floor(l_quantity) AS INT) AS mapq,
       CASE l_linenumber WHEN 1 THEN '32M' WHEN 2 THEN '10M2I20M' WHEN 3 THEN '5S27M' WHEN 4 THEN '16M3D16M'
            WHEN 5 THEN '8M100N24M' WHEN 6 THEN '30M2S' ELSE '12M1D10M2I8M' END AS cigar,
       CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE -1 END * CAST(floor(l_extendedprice / 100) AS BIGINT) AS tlen,
       concat('rg', l_suppkey % 3) AS rg,
       {dna("concat('a', l_partkey % 50)")} AS seq,
       {quality("concat('b', l_orderkey)")} AS qual
FROM lineitem
""",
    "fx_predictions": f"""
SELECT seqname, CASE WHEN strand = '+' THEN stop - len + 1 ELSE stop END AS lo,
       CASE WHEN strand = '+' THEN stop ELSE stop + len - 1 END AS hi,
       CASE WHEN strand = '+' THEN stop - len + 1 ELSE stop + len - 1 END AS start,
       stop, strand, predictor
FROM (
  SELECT concat('chr', l_suppkey % 10) AS seqname,
         CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand,
         CASE WHEN l_linestatus = 'O' THEN l_partkey * 3 + 900 ELSE l_partkey * 3 + 1 END AS stop,
         15 * CAST(floor(l_quantity) AS BIGINT) AS len,
         CASE WHEN l_returnflag = 'R' THEN 'BLAST' WHEN l_returnflag = 'A' THEN 'Glimmer3'
              WHEN l_linenumber % 2 = 0 THEN 'gmhmmp' ELSE 'Prodigal' END AS predictor
  FROM lineitem) t
""",
    "fx_hits": f"""
SELECT concat('g', l_orderkey) AS query_id, concat('t', l_partkey) AS target_id,
       CAST(1 AS DOUBLE) / (1 + l_extendedprice) AS evalue, l_discount * 1000 AS coverage,
       l_quantity * 2 AS identity, 40 + l_quantity AS similarity, l_extendedprice AS bits
FROM lineitem
""",
    "fx_genes": f"""
SELECT concat('g', o_orderkey) AS locus_tag, concat('chr', o_custkey % 10) AS seqname,
       CASE o_orderstatus WHEN 'O' THEN 'CDS' WHEN 'F' THEN 'gene' ELSE 'tRNA' END AS type,
       concat(CASE WHEN o_orderkey % 3 = 0 THEN 'hypothetical ' WHEN o_orderkey % 3 = 1 THEN 'putative ' ELSE '' END, o_orderpriority) AS product,
       o_orderkey * 3 + 1 AS lo, o_orderkey * 3 + 300 AS hi
FROM orders
""",
    "fx_variants": f"""
SELECT concat('chr', l_suppkey % 10) AS chrom, l_partkey + 1 AS pos,
       CASE WHEN l_linenumber = 6 THEN 'ACC' ELSE substr('ACGT', CAST(l_orderkey % 4 + 1 AS INT), 1) END AS ref,
       CASE WHEN l_linenumber = 6 THEN 'A' WHEN l_linenumber = 7 THEN concat(substr('ACGT', CAST(l_orderkey % 4 + 1 AS INT), 1), 'TG')
            WHEN l_linenumber = 5 THEN '.' ELSE substr('GTAC', CAST((l_orderkey + l_linenumber % 2) % 4 + 1 AS INT), 1) END AS alt,
       l_quantity AS qual,
       concat('DP=', CAST(floor(l_quantity) AS INT), ';MQ=', l_suppkey % 60) AS info,
       CASE l_returnflag WHEN 'R' THEN '0/1' WHEN 'A' THEN '1/1' ELSE '0/0' END AS gt
FROM lineitem
""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan that would leave slots of the cluster idle is dealt out first.

    A row group is read by one task whole, so a table may have many splits of which a few hold all rows, and all that
    is computed from it would run in these. A scan whose fullest split has more than twice a slot's share is dealt
    out; the rows of the splits are counted from the footers. An even one is left alone.
    """
    slots, splits = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    if splits >= slots:
        counts = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
        top, rows = counts.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if top * slots <= 2 * rows:
            return df
    return df.repartition(max(slots, splits))


def fx(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view ``fx_<name>`` as a DataFrame, its base table bound by name."""
    text = FX[f"fx_{name}"]
    base = next(t for t in TABLES if f"FROM {t}" in text)
    bound = text.replace("{", "{{").replace("}", "}}").replace(f"FROM {base}", f"FROM {{{base}}}")
    return spark.sql(bound, **{base: spread(table(spark, sf_dir, base))})


def in_order(df: DataFrame, name: str = "place") -> DataFrame:
    """The rows of a sorted result with the place that each one has in it: written, and numbered by file and line."""
    path = scratch_path(df.sparkSession, "ordered")
    df.write.parquet(path)
    return numbered_files(df.sparkSession.read.parquet(path), df.columns, F.col("_metadata.row_index"), name)


def lines_in_order(spark: SparkSession, path: str, name: str = "place") -> DataFrame:
    """The lines of written text files with their place in the whole."""
    rows = spark.read.text(path).withColumn("_line", F.monotonically_increasing_id())
    return numbered_files(rows, ["value"], F.col("_line"), name)


def numbered_files(rows: DataFrame, columns: list[str], line, name: str) -> DataFrame:
    # part files are named in the order of the partitions that wrote them
    placed = rows.select(*columns, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), line.alias("_at"))
    return number_rows(placed, [F.col("_file"), F.col("_block"), F.col("_at")], name=name).select(*columns, name)
