"""Queries that write a format from the tables and read it back, each with its oracle.

Files go to the shared scratch folder. A text entry carries its own header line, so
the order in which entries are written does not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import converters as K
from ..sources import reads as SR
from ..sources import records as REC
from ..sources import reports as RP
from ..sources import tables as T
from ..sources import xml as X
from .fixtures import fx, lines_in_order, spread, table
from .pileup import _CP, consensus_rows
from .registry import query


#: Elements of an XML file that a query writes.
XML_ROWS = 50_000


def put(spark: SparkSession, df: DataFrame, text: str, label: str) -> str:
    """Writes one text entry per row and returns the folder."""
    path = scratch_path(spark, label)
    df.select(F.expr(text).alias("value")).write.text(path)
    return path


def put_titled(spark: SparkSession, df: DataFrame, text: str, title: str, label: str) -> str:
    """As ``put``, every part file beginning with ``title``."""
    path = scratch_path(spark, label)
    rows = df.select(F.spark_partition_id().alias("p"), F.lit(1).alias("k"), F.expr(text).alias("value"))
    titles = rows.select("p").distinct().select("p", F.lit(0).alias("k"), F.lit(title).alias("value"))
    rows.unionByName(titles).repartition("p").sortWithinPartitions("p", "k").select("value").write.text(path)
    return path


def put_xml(spark: SparkSession, df: DataFrame, text: str, schema: str, row_tag: str) -> str:
    """Well-formed documents with one element per row."""
    path = scratch_path(spark, "xml")
    rows = spread(df).select(F.from_xml(F.expr(text), schema).alias("x")).select("x.*")
    # an XML file is read by one task
    rows.write.format("xml").option("rootTag", "set").option("rowTag", row_tag).option("maxRecordsPerFile", XML_ROWS).save(path)
    return path


def place(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, label)


@query("S1_read_fastq", "SELECT rid, pair_id, mate, id, seq, qual FROM fx_reads")
def s1(spark, sf):
    path = place(spark, "fastq")
    SR.write_fastq(fx(spark, sf, "reads"), path)
    return SR.read_fastq(spark, path).select("rid", "pair_id", "mate", "id", "seq", "qual")


@query("S1_read_fastq_gz", "SELECT rid, id, seq, qual FROM fx_reads")
def s1gz(spark, sf):
    path = place(spark, "fastq")
    SR.write_fastq(fx(spark, sf, "reads"), path, "gzip")
    return SR.read_fastq(spark, path, poly=1).select("rid", "id", "seq", "qual")


@query("S2_normalize_fastq", "SELECT id, seq, qual FROM fx_reads WHERE length(seq) >= 50")
def s2(spark, sf):
    text = r"concat('@', id, '\n', regexp_replace(seq, '(.{20})', '$1\n'), '\n+', id, '\n', regexp_replace(qual, '(.{25})', '$1\n'))"
    path = put(spark, fx(spark, sf, "reads"), text, "wrapped")
    return SR.normalize_fastq(spark, path, 50).select("id", "seq", "qual")


@query("S3_read_fasta", "SELECT name, seq FROM fx_contigs")
def s3(spark, sf):
    path = place(spark, "fasta")
    SR.write_fasta(fx(spark, sf, "contigs").withColumn("d", F.lit("some words")), path, description="d")
    return SR.read_fasta(spark, path, first_word_only=True).select("name", "seq")


@query("S4_read_fasta_qual", "SELECT id AS name, seq, array_to_string(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33), ' ') AS qual FROM fx_reads")
def s4(spark, sf):
    a, b = place(spark, "fasta"), place(spark, "qual")
    r = fx(spark, sf, "reads").withColumnRenamed("id", "name")
    SR.write_fasta(r, a, 30)
    SR.write_qual(r, b, 17)
    return SR.read_fasta_qual(spark, a, b).select("name", "seq", F.array_join("qual", " ").alias("qual"))


@query("S5_read_sam", "SELECT qname, flag, rname, pos, mapq, cigar, '=' AS rnext, pos + 1 AS pnext, tlen, seq, qual, rg, CAST(mapq AS VARCHAR) AS nm, 'i' AS nm_type FROM fx_alignments")
def s5(spark, sf):
    path = place(spark, "sam")
    a = fx(spark, sf, "alignments").withColumns({
        "rnext": F.lit("="), "pnext": F.col("pos") + 1, "tag_text": F.array(F.concat(F.lit("RG:Z:"), "rg"), F.concat(F.lit("NM:i:"), "mapq"), F.lit("CO:Z:a:b"))})
    T.write_sam(a, path, ["@HD\tVN:1.0", "@SQ\tSN:chr0\tLN:5000", "@RG\tID:rg0\tLB:libA"])
    return T.read_sam(spark, path).select(
        *"qname flag rname pos mapq cigar rnext pnext tlen seq qual rg".split(), F.col("tags")["NM"].alias("nm"), F.col("tag_types")["NM"].alias("nm_type"))


@query("S5_sam_dictionary", "SELECT rname AS name, max(pos) + 200 AS length FROM fx_alignments GROUP BY rname")
def s5d(spark, sf):
    d = fx(spark, sf, "alignments").groupBy("rname").agg((F.max("pos") + 200).alias("n"))
    path = put(spark, d, r"concat('@SQ\tSN:', rname, '\tLN:', n, '\n', 'q\t0\t', rname, '\t1\t9\t1M\t*\t0\t0\tA\tI')", "header")
    return T.sequence_dictionary(T.sam_header(spark, path))


@query("S6_read_gff3", "SELECT seqname AS seqid, type, lo AS start, hi AS \"end\", '+' AS strand, locus_tag AS \"ID\", product FROM fx_genes")
def s6(spark, sf):
    path = place(spark, "gff")
    g = fx(spark, sf, "genes").withColumns({"score": F.lit(None).cast("double"), "strand": F.lit("+"), "attributes": F.concat(F.lit("ID="), "locus_tag", F.lit(";product="), "product")})
    T.write_gff3(g, path, "test")
    return T.known_attributes(T.read_gff3(spark, path)).select("seqid", "type", "start", "end", "strand", "ID", F.col("attrs")["product"].alias("product"))


@query("S7_write_gff3", "SELECT concat_ws(chr(9), seqname, 'test', type, lo, hi, '.', '+', '.', concat('ID=', locus_tag)) AS value FROM fx_genes")
def s7(spark, sf):
    path = place(spark, "gff")
    g = fx(spark, sf, "genes").withColumns({"score": F.lit(None).cast("double"), "strand": F.lit("+"), "attributes": F.concat(F.lit("ID="), "locus_tag")})
    T.write_gff3(g, path, "test")
    return spark.read.text(path)


@query("S8_write_fasta", """
SELECT unnest(string_split(concat('>', name, chr(10), rtrim(regexp_replace(seq, '(.{60})', concat('\\1', chr(10)), 'g'), chr(10))), chr(10))) AS value FROM fx_contigs""")
def s8(spark, sf):
    path = place(spark, "fasta")
    SR.write_fasta(fx(spark, sf, "contigs"), path, 60, order="length")
    return spark.read.text(path)


@query("S7_order", "SELECT row_number() OVER (ORDER BY seqname, lo, hi DESC) AS place, seqname, lo, hi FROM fx_genes")
def s7o(spark, sf):
    path = place(spark, "gff")
    g = fx(spark, sf, "genes").withColumns({"score": F.lit(None).cast("double"), "strand": F.lit("+"), "attributes": F.concat(F.lit("ID="), "locus_tag")})
    T.write_gff3(g, path, "test")
    f = F.split("value", "\t")
    return lines_in_order(spark, path).select("place", f[0].alias("seqname"), f[3].cast("bigint").alias("lo"), f[4].cast("bigint").alias("hi"))


@query("S8_order", """
WITH l AS (SELECT name, length(seq) AS n, 1 + CAST(ceil(length(seq) / 60.0) AS BIGINT) AS lines FROM fx_contigs)
SELECT CAST(1 + coalesce(sum(lines) OVER (ORDER BY n DESC, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place, name FROM l""")
def s8o(spark, sf):
    path = place(spark, "fasta")
    SR.write_fasta(fx(spark, sf, "contigs"), path, 60, order="length")
    return lines_in_order(spark, path).filter(F.col("value").startswith(">")).select("place", F.expr("substr(value, 2)").alias("name"))


# Two blocks with a gap on either side, from the columns of a line.
_PSL = """concat_ws('\\t', l_linenumber + 20, l_linenumber % 3, 0, 0, 1, 2, 1, 3, if(l_linestatus = 'O', '+', '-'), concat('q', l_orderkey, '_', l_linenumber), 100, 5, 75 + l_linenumber,
 concat('chr', l_suppkey % 10), 90000, l_partkey, l_partkey + 80, 3, '20,15,30,', if(l_linestatus = 'O', '5,27,45,', concat(25 - l_linenumber, ',', 47 - l_linenumber, ',', 65 - l_linenumber, ',')), concat(l_partkey, ',', l_partkey + 22, ',', l_partkey + 43, ','))"""


@query("S9_read_psl", """
SELECT concat('q', l_orderkey, '_', l_linenumber) AS qname, concat('chr', l_suppkey % 10) AS tname, l_partkey AS tstart, b.i AS block, b.s AS size, l_partkey + b.t AS "tpos" FROM lineitem,
 (VALUES (0, 20::BIGINT, 0), (1, 15::BIGINT, 22), (2, 30::BIGINT, 43)) b(i, s, t)""")
def s9(spark, sf):
    psl = T.read_psl(spark, put(spark, table(spark, sf, "lineitem"), _PSL, "psl"))
    return T.psl_blocks(psl.withColumn("t0", F.col("tstart")), ["qname", "tname", "t0"]).select(
        "qname", "tname", F.col("t0").alias("tstart"), "block", "size", F.col("tstart").alias("tpos"))


@query("S9_psl_clusters", """
WITH p AS (SELECT concat('q', l_orderkey, '_', l_linenumber) AS qname, concat('chr', l_suppkey % 10) AS tname, l_partkey * 60 AS s, l_partkey * 60 + 80 - (l_linenumber % 2) * 40 AS e FROM lineitem),
d AS (SELECT tname, s, max(e) AS e FROM p GROUP BY tname, s), m AS (SELECT *, max(e) OVER (PARTITION BY tname ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM d),
c AS (SELECT tname, s, CAST(sum(CASE WHEN seen IS NULL OR s > seen THEN 1 ELSE 0 END) OVER (PARTITION BY tname ORDER BY s) AS BIGINT) AS cluster FROM m)
SELECT qname, tname, s AS tstart, cluster FROM p JOIN c USING (tname, s)""")
def s9c(spark, sf):
    text = _PSL.replace("l_partkey, l_partkey + 80,", "l_partkey * 60, l_partkey * 60 + 80 - (l_linenumber % 2) * 40,")
    psl = T.read_psl(spark, put(spark, table(spark, sf, "lineitem"), text, "psl"))
    return T.psl_clusters(psl).select("qname", "tname", "tstart", "cluster")


@query("S10_read_hits", "SELECT query_id AS name1, target_id AS name2, identity AS percent_id, 60::BIGINT AS al_len, evalue, bits AS bitscore FROM fx_hits")
def s10(spark, sf):
    text = r"concat('# a comment\n', concat_ws('\t', query_id, target_id, identity, 60, 1, 0, 1, 60, 5, 64, evalue, bits))"
    return T.read_hits(spark, put(spark, fx(spark, sf, "hits"), text, "hits")).select("name1", "name2", "percent_id", "al_len", "evalue", "bitscore")


@query("S11_pipe_table", "SELECT CAST(p_partkey AS VARCHAR) AS id, concat(p_name, '|x') AS name, '' AS nothing, p_type AS kind FROM part")
def s11(spark, sf):
    path = place(spark, "pipe")
    T.write_pipe(table(spark, sf, "part").select("p_partkey", F.concat("p_name", F.lit("|x")).alias("n"), F.lit(None).cast("string").alias("z"), "p_type"), path)
    return T.read_pipe(spark, path, ["id", "name", "nothing", "kind"])


@query("S11_side_table", "SELECT DISTINCT concat('g', l_orderkey) AS locus_tag, 'inside' AS location, CAST(l_linenumber AS VARCHAR) AS start, CAST(l_linenumber + 20 AS VARCHAR) AS \"end\" FROM lineitem")
def s11s(spark, sf):
    path = put(spark, table(spark, sf, "lineitem"), "concat('g', l_orderkey, '|inside|', l_linenumber, '|', l_linenumber + 20)", "side")
    return T.read_side_table(spark, path, "tmhmm_location")


@query("S12_vcf", "SELECT chrom, pos, ref, alt, qual, info, CAST(CAST(floor(qual) AS INT) AS VARCHAR) AS dp, gt AS s1 FROM fx_variants")
def s12(spark, sf):
    path = place(spark, "vcf")
    v = fx(spark, sf, "variants").withColumns({"id": F.lit("."), "filter": F.lit("."), "format": F.lit("GT"), "samples": F.array("gt", F.lit("0/0"))})
    T.write_vcf(v, path, samples=["a", "b"])
    return T.read_vcf(spark, path).select("chrom", "pos", "ref", "alt", "qual", "info", F.regexp_replace(F.col("info_map")["DP"], r"\.0$", "").alias("dp"), F.get("samples", F.lit(0)).alias("s1"))


@query("P34_vcf_samples", "SELECT CAST(s_suppkey AS INT) AS idx, s_name AS sample FROM supplier")
def p34s(spark, sf):
    from ..operators.variants import vcf_samples

    # One column header; a sample per supplier.
    names = table(spark, sf, "supplier").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name"))), lambda x: x["s_name"]), "\t").alias("n"))
    path = put(spark, names, r"concat('##fileformat=VCFv4.0\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t', n)", "vcf")
    return vcf_samples(T.vcf_header(spark, path))


def _genome(spark, sf):
    from .genes import features

    f = features(spark, sf)
    seqs = fx(spark, sf, "contigs").select(F.col("name").alias("seqid"), "seq", F.lit("a contig").alias("description"))
    quals = F.array(F.struct(F.lit("locus_tag").alias("tag"), F.col("locus_tag").alias("value")), F.struct(F.lit("product").alias("tag"), F.coalesce("product", F.lit("none")).alias("value")))
    path = place(spark, "genbank")
    REC.write_genbank(seqs, f.select(F.col("seqname").alias("seqid"), "lo", "hi", "strand", "type", quals.alias("quals")), path)
    return path


@query("S13_genbank_features", """
SELECT name AS seqid, 'CDS' AS type, doc_id % 40 + 1 AS lo, least(doc_id % 40 + 3 * (20 + doc_id % 700), length(seq)) AS hi, CASE WHEN quality = 1 THEN '+' ELSE '-' END AS strand, concat('ST_', doc_id) AS locus_tag,
  CASE WHEN doc_id % 2 = 0 THEN 'some protein' ELSE 'none' END AS product FROM labels JOIN fx_contigs ON name = concat('c', doc_id) WHERE length(seq) >= doc_id % 40 + 1""")
def s13(spark, sf):
    _, f = REC.read_genbank(spark, _genome(spark, sf))
    return f.filter("type <> 'source'").select("seqid", "type", "lo", "hi", "strand", REC.qualifier("locus_tag").alias("locus_tag"), REC.qualifier("product").alias("product"))


@query("S13_joined_places", """
SELECT name AS seqid, concat(lo, '..', lo + 29, ',', lo + 40, '..', lo + 60, ',', lo + 82, '..', lo + 90) AS places, strand FROM (
  SELECT name, doc_id % 40 + 1 AS lo, CASE WHEN quality = 1 THEN '+' ELSE '-' END AS strand FROM labels JOIN fx_contigs ON name = concat('c', doc_id) WHERE length(seq) >= doc_id % 40 + 1)""")
def s13j(spark, sf):
    from .genes import exons

    path = place(spark, "genbank")
    seqs = fx(spark, sf, "contigs").select(F.col("name").alias("seqid"), "seq", F.lit(None).cast("string").alias("description"))
    quals = F.array(F.struct(F.lit("locus_tag").alias("tag"), F.col("locus_tag").alias("value")))
    REC.write_genbank(seqs, exons(spark, sf).select(F.col("seqname").alias("seqid"), "lo", "hi", "strand", "type", "places", quals.alias("quals")), path)
    shown = F.array_join(F.transform("places", lambda x: F.concat(x["lo"].cast("string"), F.lit(".."), x["hi"].cast("string"))), ",")
    return REC.genome_features(spark, path).filter("type <> 'source'").select("seqid", shown.alias("places"), "strand")


@query("S14_genbank_sequences", "SELECT name AS seqid, 'a contig' AS description, seq FROM fx_contigs")
def s14(spark, sf):
    return REC.genome_sequences(spark, _genome(spark, sf)).select("seqid", "description", "seq")


@query("C8_gff3_to_genbank", "SELECT g.seqname AS seqid, g.type, g.lo, g.hi, g.locus_tag FROM fx_genes g WHERE seqname IN (SELECT replace(name, 'c', 'chr') FROM fx_contigs)")
def c8g(spark, sf):
    gff, fasta, out = place(spark, "gff"), place(spark, "fasta"), place(spark, "genbank")
    g = fx(spark, sf, "genes").withColumns({"score": F.lit(None).cast("double"), "strand": F.lit("+"), "attributes": F.concat(F.lit("locus_tag="), "locus_tag")})
    T.write_gff3(g, gff, "test")
    SR.write_fasta(fx(spark, sf, "contigs").withColumn("name", F.replace("name", F.lit("c"), F.lit("chr"))), fasta)
    REC.gff3_to_genbank(spark, gff, fasta, out)
    return REC.genome_features(spark, out).filter("type <> 'source'").select("seqid", "type", "lo", "hi", REC.qualifier("locus_tag").alias("locus_tag"))


_UNIPROT = r"""concat('<entry dataset="Swiss-Prot">\n<accession>P', p_partkey, '</accession><accession>Q1</accession><name>N', p_size, '</name>\n<protein>\n<', if(p_size % 2 = 0, 'recommendedName', 'submittedName'),
 '>\n<fullName>', p_name, '</fullName></', if(p_size % 2 = 0, 'recommendedName', 'submittedName'), '></protein>\n', if(p_size % 3 = 0, '', concat('<gene><name type="primary">gen', p_size, '</name><name type="ORF">z</name></gene>')),
 '<dbReference type="GeneId" id="', p_size, '"/><dbReference type="PDB" id="D', p_partkey, '"><property type="entry name" value="V', p_size, '"/></dbReference><dbReference type="EMBL" id="E"><property type="x" value="y"/></dbReference>',
 '<proteinExistence type="predicted"/></entry>')"""


@query("S15_uniprot_entries", """
SELECT concat('P', p_partkey) AS accession, concat('N', p_size) AS name, 'Swiss-Prot' AS dataset, p_name AS "proteinName", 'predicted' AS "proteinType", CASE WHEN p_size % 3 <> 0 THEN 'primary' END AS "geneType",
  CASE WHEN p_size % 3 <> 0 THEN concat('gen', p_size) END AS "geneName", CAST(p_size AS VARCHAR) AS "dbRefId" FROM part""")
def s15(spark, sf):
    return X.read_uniprot_xml(spark, put_xml(spark, table(spark, sf, "part"), _UNIPROT, X.PROTEIN_ENTRY, "entry"))[0]


@query("S15_uniprot_refs", "SELECT concat('P', p_partkey) AS accession, concat('D', p_partkey) AS \"dbRefId\", 'PDB' AS \"dbRefType\", concat('V', p_size) AS \"dbRefName\" FROM part")
def s15r(spark, sf):
    return X.read_uniprot_xml(spark, put_xml(spark, table(spark, sf, "part"), _UNIPROT, X.PROTEIN_ENTRY, "entry"))[1]


_INTERPRO = r"""concat('<protein id="g', p_partkey, '" length="', p_size + 100, '"><interpro id="I', p_size, '" name="', p_name, '" type="Domain">', if(p_size % 2 = 0, '<child_list><rel_ref ipr_ref="R1"/><rel_ref ipr_ref="R2"/></child_list>', ''),
 '<match id="M1" name="m" dbname="PFAM"><location start="1" end="', p_size, '" score="0.1" status="T" evidence="HMM"/><location start="5" end="9" score="0.2" status="T" evidence="HMM"/></match>',
 if(p_size % 3 = 0, '<classification id="GO:1" class_type="GO"><category>Function</category><description>binding</description></classification>', ''), '</interpro></protein>')"""


@query("S16_interpro_matches", """
SELECT concat('g', p_partkey) AS protein_id, 'M1' AS match_id, 'm' AS match_name, 'PFAM' AS match_db_name, s AS start, CASE WHEN s = 1 THEN p_size ELSE 9 END AS "end", CASE WHEN s = 1 THEN '0.1' ELSE '0.2' END AS score, 'T' AS status, 'HMM' AS evidence
FROM part, (VALUES (1), (5)) t(s)""")
def s16(spark, sf):
    return X.read_interpro_xml(spark, put_xml(spark, table(spark, sf, "part"), _INTERPRO, X.DOMAIN_PROTEIN, "protein"))["matches"]


@query("S16_interpro_hits", "SELECT concat('g', p_partkey) AS protein_id, p_size + 100 AS protein_length, concat('I', p_size) AS interpro_id, p_name AS interpro_name, 'Domain' AS interpro_type FROM part")
def s16h(spark, sf):
    return X.read_interpro_xml(spark, put_xml(spark, table(spark, sf, "part"), _INTERPRO, X.DOMAIN_PROTEIN, "protein"))["hits"]


@query("S16_interpro_children", "SELECT concat('g', p_partkey) AS protein_id, concat('I', p_size) AS interpro_id, r AS child_reference FROM part, (VALUES ('R1'), ('R2')) t(r) WHERE p_size % 2 = 0")
def s16c(spark, sf):
    return X.read_interpro_xml(spark, put_xml(spark, table(spark, sf, "part"), _INTERPRO, X.DOMAIN_PROTEIN, "protein"))["children"]


@query("S16_interpro_classifications", "SELECT concat('g', p_partkey) AS protein_id, 'GO:1' AS id, 'GO' AS class_type, 'Function' AS category, 'binding' AS description FROM part WHERE p_size % 3 = 0")
def s16k(spark, sf):
    return X.read_interpro_xml(spark, put_xml(spark, table(spark, sf, "part"), _INTERPRO, X.DOMAIN_PROTEIN, "protein"))["classifications"]


_DOMAINS = r"""concat('<interpro id="I', p_partkey, '" type="Family"><name>', p_name, '</name><abstract>about   ', p_type, '\n it</abstract>', if(p_size % 2 = 0, '<class_list><classification id="GO:7" class_type="GO"><category>C</category><description>d</description></classification><classification id="X" class_type="EC"><category>C</category><description>e</description></classification></class_list>', ''),
 '<pub_list><publication><db_xref db="PUBMED" dbkey="', p_size, '"/></publication><publication><title>t</title></publication></pub_list></interpro>')"""


def domains(spark, sf, part):
    return X.read_interpro_entries(spark, put_xml(spark, table(spark, sf, "part"), _DOMAINS, X.DOMAIN_ENTRY, "interpro"))[part]


@query("S17_domains", "SELECT concat('I', p_partkey) AS id, p_name AS name, 'Family' AS type, concat('about ', p_type, ' it') AS abstract FROM part")
def s17(spark, sf):
    return domains(spark, sf, "domains")


@query("S17_go_links", "SELECT concat('I', p_partkey) AS domain_id, 'GO:7' AS go_id FROM part WHERE p_size % 2 = 0")
def s17g(spark, sf):
    return domains(spark, sf, "go_links")


@query("S17_go_terms", "SELECT 'GO:7' AS id, 'C' AS category, 'd' AS description FROM part WHERE p_size % 2 = 0")
def s17t(spark, sf):
    return domains(spark, sf, "go")


@query("S17_publications", "SELECT concat('I', p_partkey) AS domain_id, CAST(p_size AS VARCHAR) AS pubmed_id FROM part")
def s17p(spark, sf):
    return domains(spark, sf, "publications")


@query("S18_glimmer", """
WITH g AS (SELECT concat('c', l_suppkey) AS seqname, CASE WHEN l_linenumber = 1 THEN -1 ELSE l_partkey * 3 + 2 END AS a, CASE WHEN l_linenumber = 1 THEN 301 WHEN l_linenumber = 2 THEN n_chars * 3 + 1 ELSE l_partkey * 3 + 301 END AS b,
  n_chars * 3 AS n, l_linestatus FROM lineitem JOIN documents ON doc_id = l_suppkey),
c AS (SELECT *, CASE WHEN a < 1 THEN a + 3 WHEN a > n THEN a - 3 ELSE a END AS s, CASE WHEN b < 1 THEN b + 3 WHEN b > n THEN b - 3 ELSE b END AS e FROM g)
SELECT seqname, least(s, e) AS lo, greatest(s, e) AS hi, s AS start, e AS stop, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, least(a, b) < 1 AS extended_lo, greatest(a, b) > n AS extended_hi FROM c""")
def s18(spark, sf):
    d = table(spark, sf, "documents")
    li = table(spark, sf, "lineitem").join(d.select("doc_id", "n_chars"), F.col("doc_id") == F.col("l_suppkey"))
    text = r"""concat('>c', l_suppkey, '\norf001  ', if(l_linenumber = 1, -1, l_partkey * 3 + 2), ' ', case l_linenumber when 1 then 301 when 2 then n_chars * 3 + 1 else l_partkey * 3 + 301 end, ' ', if(l_linestatus = 'O', '+1', '-2'), ' 9.5')"""
    lengths = d.select(F.concat(F.lit("c"), "doc_id").alias("name"), (F.col("n_chars") * 3).alias("length"))
    return RP.read_glimmer(spark, put(spark, li, text, "glimmer"), lengths).select("seqname", "lo", "hi", "start", "stop", "strand", "extended_lo", "extended_hi")


@query("S18_genemark", """
SELECT concat('c', l_suppkey) AS seqname, l_partkey * 3 AS lo, l_partkey * 3 + 299 AS hi, CASE WHEN l_linestatus = 'O' THEN l_partkey * 3 ELSE l_partkey * 3 + 299 END AS start, CASE WHEN l_linestatus = 'O' THEN l_partkey * 3 + 299 ELSE l_partkey * 3 END AS stop,
  CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, l_linenumber = 1 AS extended_lo, l_linenumber = 2 AS extended_hi FROM lineitem""")
def s18g(spark, sf):
    text = r"""concat('>c', l_suppkey, ' \nGene Strand LeftEnd RightEnd\n   1   ', if(l_linestatus = 'O', '+', '-'), '  ', if(l_linenumber = 1, '<', ''), l_partkey * 3, '  ', if(l_linenumber = 2, '>', ''), l_partkey * 3 + 299, '   300  1  6  0.5')"""
    return RP.read_genemark(spark, put(spark, table(spark, sf, "lineitem"), text, "genemark")).select("seqname", "lo", "hi", "start", "stop", "strand", "extended_lo", "extended_hi")


@query("S18_prodigal", """
SELECT concat('c', l_suppkey) AS seqname, l_partkey AS lo, l_partkey + 299 AS hi, CASE WHEN l_linestatus = 'O' THEN l_partkey ELSE l_partkey + 299 END AS start, CASE WHEN l_linestatus = 'O' THEN l_partkey + 299 ELSE l_partkey END AS stop, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, 'CDS' AS type, 'Prodigal' AS predictor FROM lineitem""")
def s18p(spark, sf):
    text = r"concat('##gff-version 3\n', concat_ws('\t', concat('c', l_suppkey), 'Prodigal', 'CDS', l_partkey, l_partkey + 299, l_discount, if(l_linestatus = 'O', '+', '-'), '0', 'ID=1;partial=00'))"
    return RP.read_predictions(spark, put(spark, table(spark, sf, "lineitem"), text, "prodigal"), "prodigal")


@query("S19_trna", """
SELECT concat('c', l_suppkey) AS seqname, l_partkey AS lo, l_partkey + 72 AS hi, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, CASE WHEN l_linestatus = 'O' THEN l_partkey ELSE l_partkey + 72 END AS start, 'Leu' AS trna_type, 'TTG' AS codon, l_tax AS score FROM lineitem""")
def s19(spark, sf):
    text = r"""concat_ws('\t', concat('c', l_suppkey, ' '), '1', if(l_linestatus = 'O', concat(l_partkey, ' ', '\t', l_partkey + 72), concat(l_partkey + 72, '\t', l_partkey)), 'Leu', 'CAA', '0', '0', l_tax)"""
    path = put_titled(spark, table(spark, sf, "lineitem"), text, "Sequence\ttRNA\nName\tnum\n----\t----", "trna")
    return RP.read_trna(spark, path).select("seqname", "lo", "hi", "strand", "start", "trna_type", "codon", "score")


@query("S19_rrna", "SELECT concat('c', l_suppkey) AS seqname, l_partkey AS lo, l_partkey + 1500 AS hi, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, CASE WHEN l_linenumber = 1 THEN NULL ELSE '16S' END AS rrna_type FROM lineitem")
def s19r(spark, sf):
    text = r"concat('##gff-version2\n', concat_ws('\t', concat('c', l_suppkey), 'RNAmmer', 'rRNA', l_partkey, l_partkey + 1500, '99.5', if(l_linestatus = 'O', '+', '-'), '.', if(l_linenumber = 1, 'none', '16s_rRNA')))"
    return RP.read_rrna(spark, put(spark, table(spark, sf, "lineitem"), text, "rrna")).select("seqname", "lo", "hi", "strand", "rrna_type")


@query("S19_crispr_crt", "SELECT concat('c', p_partkey) AS seqname, CAST(p_size AS VARCHAR) AS crispr, CAST(p_size * 100 AS BIGINT) AS lo, CAST(p_size * 100 + 58 + 5 - 1 AS BIGINT) AS hi, 3::BIGINT AS repeats FROM part")
def s19c(spark, sf):
    text = r"""concat('ORGANISM:  c', p_partkey, '\nBases: 9\n\nCRISPR ', p_size, '   Range: 1 - 9\nPOSITION\tREPEAT\tSPACER\n--------\t----\t----\n', p_size * 100, '\t\tACGTA\tTTTT\t[ 5, 4 ]\n', p_size * 100 + 29, '\t\tACGTA\tTTTT\t[ 5, 4 ]\n', p_size * 100 + 58, '\t\tACGTA\t\n--------\t----\t----\nRepeats: 3\tAverage Length: 5')"""
    return RP.read_crt(spark, put(spark, table(spark, sf, "part"), text, "crt"))[1].select("seqname", "crispr", "lo", "hi", "repeats")


@query("S19_crispr_pilercr", "SELECT concat('c', p_partkey) AS seqname, CAST(p_size AS VARCHAR) AS crispr, CAST(p_size * 100 AS BIGINT) AS lo, CAST(p_size * 100 + 61 + 28 AS BIGINT) AS hi, 97.5 AS score, 2::BIGINT AS repeats FROM part".replace("97.5", "97.5::DOUBLE"))
def s19p(spark, sf):
    text = r"""concat('DETAIL REPORT\n\nArray ', p_size, '\n>c', p_partkey, ' some words\n\n   Pos  Repeat  %id\n==========\n  ', p_size * 100, '   29   100.0  32  ACC  ...  TTT\n  ', p_size * 100 + 61, '   29   95.0  ACC ...\n==========\n   2   29   32  AACC\n\nSUMMARY BY SIMILARITY\n 1  2  3')"""
    return RP.read_pilercr(spark, put(spark, table(spark, sf, "part"), text, "pilercr"))[1].select("seqname", "crispr", "lo", "hi", "score", "repeats")


_SIGNAL = r"""concat('>g', p_partkey, '\n\nSignalP-NN result:\n# data\n  max. C    ', p_size, '  0.9  0.32  YES\n  mean S   1-', p_size, '   0.5  0.48   NO\n       D   1-', p_size, '   0.25  0.43   YES\n\nSignalP-HMM result:\nPrediction: Signal peptide\nSignal peptide probability: 0.75\nMax cleavage site probability: 0.5 between pos. ', p_size, ' and ', p_size + 1)"""


@query("S20_signal_peptides", """
SELECT concat('g', p_partkey) AS name, m.m AS measure, CASE WHEN m.m = 'max. C' THEN p_size ELSE 1 END AS start, p_size AS "end", m.v AS value, m.c AS cutoff, m.d AS decision FROM part, (VALUES ('max. C', 0.9::DOUBLE, 0.32::DOUBLE, 'YES'), ('mean S', 0.5::DOUBLE, 0.48::DOUBLE, 'NO'), ('D', 0.25::DOUBLE, 0.43::DOUBLE, 'YES')) m(m, v, c, d)""")
def s20(spark, sf):
    return RP.read_signal_peptides(spark, put(spark, table(spark, sf, "part"), _SIGNAL, "signal"))


@query("S20_signal_hmm", "SELECT concat('g', p_partkey) AS name, 'Signal peptide' AS decision, 0.75::DOUBLE AS probability, 0.5::DOUBLE AS cleavage, p_size AS start, p_size + 1 AS \"end\" FROM part")
def s20h(spark, sf):
    return RP.read_signal_hmm(spark, put(spark, table(spark, sf, "part"), _SIGNAL, "signal"))


_TM = r"""concat('# g', p_partkey, ' Length: ', p_size + 100, '\n# g', p_partkey, ' Number of predicted TMHs:  1\n# g', p_partkey, ' Total prob of N-in:        0.5\ng', p_partkey, '\tTMHMM2.0\tinside\t     1    ', p_size, '\ng', p_partkey, '\tTMHMM2.0\tTMhelix\t    ', p_size + 1, '    ', p_size + 23)"""


@query("S20_transmembrane", "SELECT concat('g', p_partkey) AS name, l AS location, CASE l WHEN 'inside' THEN 1 ELSE p_size + 1 END AS start, CASE l WHEN 'inside' THEN p_size ELSE p_size + 23 END AS \"end\" FROM part, (VALUES ('inside'), ('TMhelix')) t(l)")
def s20t(spark, sf):
    return RP.read_transmembrane(spark, put(spark, table(spark, sf, "part"), _TM, "tm"))[0]


@query("S20_transmembrane_stats", "SELECT concat('g', p_partkey) AS name, CAST(p_size + 100 AS DOUBLE) AS length, 1.0::DOUBLE AS predicted_number, 0.5::DOUBLE AS total_prob_n_in FROM part")
def s20s(spark, sf):
    return RP.read_transmembrane(spark, put(spark, table(spark, sf, "part"), _TM, "tm"))[1].select("name", "length", "predicted_number", "total_prob_n_in")


@query("S20_lipoproteins", "SELECT concat('g', p_partkey) AS name, 'SpII' AS location, 12.5::DOUBLE AS score, 3.25::DOUBLE AS margin, p_size AS start, p_size + 1 AS \"end\" FROM part")
def s20l(spark, sf):
    return RP.read_lipoproteins(spark, put(spark, table(spark, sf, "part"), "concat('# g', p_partkey, ' SpII score=12.5 margin=3.25 cleavage=', p_size, '-', p_size + 1, ' Pos+2=A')", "lipo"))


@query("S21_keyed_csv", "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, CAST(p_size + 1 AS VARCHAR) AS size FROM part")
def s21(spark, sf):
    # both rows of a key lie in one entry, so the later one follows the earlier one in its file
    text = r"concat(p_partkey, ',old,0\n', p_partkey, ',', p_name, ',', p_size + 1)"
    path = put_titled(spark, table(spark, sf, "part"), text, "id,name,size", "csv")
    return T.read_keyed_csv(spark, path, "id")


@query("S22_cog_groups", "SELECT concat('COG', p_partkey) AS group_id, concat(o, p_size) AS gene FROM part, (VALUES ('a'), ('b'), ('c')) t(o)")
def s22(spark, sf):
    text = r"""concat('[J] COG', p_partkey, ' a protein\n  Aae:  a', p_size, ' b', p_size, '\n  Bsu:  c', p_size, '\n\n_______')"""
    return RP.read_cog_groups(spark, put(spark, table(spark, sf, "part"), text, "cogs"))


@query("S22_cog_descriptions", "SELECT concat('COG', p_partkey) AS group_id, concat(p_name, ' protein') AS description FROM part")
def s22d(spark, sf):
    return RP.read_cog_descriptions(spark, put(spark, table(spark, sf, "part"), r"concat('[J] COG', p_partkey, ' ', p_name, ' protein\n  Aae:  a\n_______')", "cogs"))


@query("S23_read_pileup", f"WITH {_CP} SELECT rname, pos, ref, consensus, quality, snp_quality, rms_mapq, depth, CASE WHEN ref <> '*' THEN bases END AS bases, allele1, allele2, CASE WHEN ref = '*' THEN 4 END AS count1, CASE WHEN ref = '*' THEN 'indel' ELSE 'snp' END AS kind FROM cp")
def s23(spark, sf):
    text = r"concat_ws('\t', rname, pos, ref, consensus, quality, snp_quality, rms_mapq, depth, if(ref = '*', concat_ws('\t', allele1, allele2, '4', '1', '0'), concat(bases, '\tIII')))"
    return T.read_pileup(spark, put(spark, consensus_rows(spark, sf), text, "pileup")).select(
        "rname", "pos", "ref", "consensus", "quality", "snp_quality", "rms_mapq", "depth", "bases", "allele1", "allele2", "count1", "kind")


@query("S24_write_tbl", """
WITH f AS (SELECT seqname, CASE WHEN type = 'tRNA' THEN hi ELSE lo END AS s, CASE WHEN type = 'tRNA' THEN lo ELSE hi END AS e, type, locus_tag, product FROM fx_genes)
SELECT DISTINCT concat('>Feature ', seqname) AS value FROM f UNION ALL SELECT DISTINCT concat_ws(chr(9), s, e, type) FROM (SELECT DISTINCT seqname, s, e, type FROM f)
UNION ALL SELECT concat(chr(9), chr(9), chr(9), 'locus_tag', chr(9), locus_tag) FROM f UNION ALL SELECT concat(chr(9), chr(9), chr(9), 'product', chr(9), product) FROM f""")
def s24(spark, sf):
    path = place(spark, "tbl")
    tags = F.explode(F.array(F.struct(F.lit("locus_tag").alias("tag"), F.col("locus_tag").alias("value")), F.struct(F.lit("product").alias("tag"), F.col("product").alias("value"))))
    f = fx(spark, sf, "genes").select(F.col("seqname").alias("seqid"), "lo", "hi", F.when(F.col("type") == "tRNA", F.lit("-")).otherwise(F.lit("+")).alias("strand"), "type", tags.alias("x")).select("*", "x.*").drop("x")
    T.write_tbl(f, path)
    return spark.read.text(path)


_ACE = r"""concat('CO ', name, ' 9 2 1 U\n', regexp_replace(seq, '(.{50})', '*$1\n'), '\n\nBQ\n20 20\n\nAF read', name, '_1 U 1\nAF read', name, '_2 C 5\nBS 1 9 x\n')"""


@query("S25_ace_contigs", "SELECT name, seq FROM fx_contigs")
def s25(spark, sf):
    return REC.read_ace(spark, put(spark, fx(spark, sf, "contigs"), _ACE, "ace"))[0]


@query("S25_ace_reads", "SELECT name AS contig, concat('read', name, '_', k) AS id FROM fx_contigs, (VALUES (1), (2)) t(k)")
def s25r(spark, sf):
    return REC.read_ace(spark, put(spark, fx(spark, sf, "contigs"), _ACE, "ace"))[1]


_STATUS = "CASE o_orderstatus WHEN 'O' THEN 'Assembled' WHEN 'F' THEN 'PartiallyAssembled' ELSE 'Repeat' END"


def status_rows(spark, sf):
    o = table(spark, sf, "orders").selectExpr("concat('r', o_orderkey) AS name", f"{_STATUS} AS status", "concat('contig', o_custkey % 9) AS c5", "o_custkey AS p5", "if(o_custkey % 2 = 0, '-', '+') AS s5")
    t = table(spark, sf, "orders").selectExpr("concat('r', o_orderkey) AS name", "concat(o_custkey % 20 + 1, '-300') AS tp", "300 - o_custkey % 20 AS tl", "'1-300' AS op", "300 AS ol", "310 AS rl")
    a, b = place(spark, "status"), place(spark, "trim")
    o.select("name", "status", "c5", "p5", "s5", F.col("c5").alias("c3"), F.col("p5").alias("p3"), F.col("s5").alias("s3")).write.csv(a, sep="\t", header=True)
    t.write.csv(b, sep="\t", header=True)
    return T.read_status(spark, a, b)


@query("S26_read_status", f"""
SELECT concat('r', o_orderkey) AS name, {_STATUS} AS status, o_custkey % 20 + 1 AS trim_start, 300 - o_custkey % 20 AS trimmed_length, CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE 0 END AS orientation, concat('contig', o_custkey % 9) AS contig5, o_custkey AS pos5, o_orderstatus IN ('O','F') AS placed FROM orders""")
def s26(spark, sf):
    return status_rows(spark, sf)


@query("S26_unplaced", "SELECT concat('r', o_orderkey) AS name, 'Repeat' AS status FROM orders WHERE o_orderstatus NOT IN ('O','F')")
def s26u(spark, sf):
    return T.unplaced(status_rows(spark, sf))


@query("S26_write_by_status", f"SELECT concat('r', o_orderkey) AS name, {_STATUS} AS status FROM orders")
def s26w(spark, sf):
    path = place(spark, "bystatus")
    T.write_by_status(status_rows(spark, sf), path)
    return spark.read.text(path).select(F.col("value").alias("name"), "status")


# Blocks of 20, 15 and 30 bases: both gaps are 2 wide first, then the reference gap is 3 wider.
_PSL_GAPS = """concat_ws('\\t', l_linenumber + 20, l_linenumber % 3, 0, 0, 1, 2, 1, 3, if(l_linestatus = 'O', '+', '-'), concat('q', l_orderkey, '_', l_linenumber), 100, 5, 75,
 concat('chr', l_suppkey % 10), 90000, l_partkey, l_partkey + 75, 3, '20,15,30,', if(l_linestatus = 'O', '5,27,45,', '25,47,65,'), concat(l_partkey, ',', l_partkey + 22, ',', l_partkey + 43, ','))"""


@query("S27_psl_to_sam", """
SELECT concat('q', l_orderkey, '_', l_linenumber) AS qname, CASE WHEN l_linestatus = 'O' THEN 0 ELSE 16 END AS flag, concat('chr', l_suppkey % 10) AS rname, l_partkey + 1 AS pos,
  CASE WHEN l_linestatus = 'O' THEN '5H40M3D30M25H' ELSE '25H40M3D30M5H' END AS cigar, concat('AS:i:', l_linenumber + 20 - 3 * (l_linenumber % 3) - 5 - 6) AS tags FROM lineitem""")
def s27(spark, sf):
    psl = T.read_psl(spark, put(spark, table(spark, sf, "lineitem"), _PSL_GAPS, "psl"))
    return K.psl_to_sam(psl).select("qname", "flag", "rname", "pos", "cigar", F.array_join("tag_text", " ").alias("tags"))


_SEQ = "substr(translate(md5(concat('a', l_partkey)),'0123456789abcdef','ACGTACGTACGTACGT'), 1, 30)"


@query("S28_bowtie_to_sam", f"""
WITH h AS (SELECT l_orderkey, l_partkey, l_linenumber, l_linestatus, l_suppkey, l_linenumber % 3 AS nm, {_SEQ} AS seq FROM lineitem),
k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY nm) AS k, lead(nm) OVER (PARTITION BY l_orderkey ORDER BY nm) AS nx FROM h)
SELECT concat('q', l_orderkey) AS qname, nm, CASE WHEN coalesce(nx, 1000) = nm THEN 0 WHEN coalesce(nx, 1000) - nm = 1 THEN 15 ELSE 25 END AS mapq, CASE nm WHEN 0 THEN '30' WHEN 1 THEN '4G25' ELSE '4G4A20' END AS md FROM k WHERE k = 1""")
def s28(spark, sf):
    text = rf"""concat_ws('\t', concat('q', l_orderkey, '/1'), if(l_linestatus = 'O', '-', '+'), concat('chr', l_suppkey % 10), l_partkey, {_SEQ}, repeat('I', 30), '0', case l_linenumber % 3 when 0 then '' when 1 then '4:A>G' else '4:A>G,9:C>A' end)"""
    sam = K.bowtie_to_sam(spark, put(spark, table(spark, sf, "lineitem"), text, "bowtie"))
    return sam.select("qname", F.substring(F.get("tag_text", F.lit(0)), 6, 9).cast("int").alias("nm"), "mapq", F.substring(F.get("tag_text", F.lit(2)), 6, 50).alias("md"))


# Both mates of a read in one entry, so they follow each other in the file.
_MATES = """m AS (SELECT o_orderkey AS k, o_custkey AS p, o_orderstatus = 'O' AS far, concat('chr', o_custkey % 10) AS c FROM orders)"""


@query("S29_soap_to_sam", f"""
WITH {_MATES} SELECT concat('q', k) AS qname, CASE WHEN e = 1 THEN 1 + 2 + 64 + 32 ELSE 1 + 2 + 128 + 16 END AS flag, CASE WHEN e = 1 OR NOT far THEN c ELSE 'chrZ' END AS rname, CASE WHEN e = 1 THEN p + 1 ELSE p + 101 END AS pos, CASE WHEN e = 1 THEN 30 ELSE 0 END AS mapq,
 CASE WHEN NOT far THEN '=' WHEN e = 1 THEN 'chrZ' ELSE c END AS rnext, CASE WHEN e = 1 THEN p + 101 ELSE p + 1 END AS pnext, CAST(CASE WHEN far THEN 0 WHEN e = 1 THEN 110 ELSE -110 END AS BIGINT) AS tlen, CASE WHEN e = 1 THEN '3C6' ELSE '10' END AS md FROM m, (VALUES (1), (2)) t(e)""")
def s29s(spark, sf):
    text = r"""concat('q', o_orderkey, '/1 ACGTACGTAC IIIIIIIIII 1 a 10 + chr', o_custkey % 10, ' ', o_custkey + 1, ' 1 C->3A30\nq', o_orderkey, '/2 ACGTACGTAC IIIIIIIIIIII 2 b 10 - ', if(o_orderstatus = 'O', 'chrZ', concat('chr', o_custkey % 10)), ' ', o_custkey + 101, ' 0')"""
    sam = K.soap_to_sam(spark, put(spark, table(spark, sf, "orders"), text, "soap"), paired=True)
    return sam.select("qname", "flag", "rname", "pos", "mapq", "rnext", "pnext", "tlen", F.substring(F.get("tag_text", F.lit(1)), 6, 50).alias("md"))


@query("S29_zoom_to_sam", f"""
WITH {_MATES} SELECT concat('q', k) AS qname, CASE WHEN e = 1 THEN 1 + 64 + CASE WHEN far THEN 16 ELSE 0 END ELSE 1 + 128 + 16 - 16 + CASE WHEN far THEN 32 ELSE 0 END END AS flag, c AS rname, CASE WHEN e = 1 THEN p + 1 ELSE p + 201 END AS pos, '36M' AS cigar, '=' AS rnext,
 CAST(CASE WHEN e = 1 THEN 200 ELSE -200 END - CASE WHEN far THEN CASE WHEN e = 1 THEN 1 ELSE -1 END ELSE 0 END AS BIGINT) AS tlen FROM m, (VALUES (1), (2)) t(e)""")
def s29z(spark, sf):
    text = r"""concat('q', o_orderkey, '_F\tchr', o_custkey % 10, ' x:', o_custkey, '\t', if(o_orderstatus = 'O', '-', '+'), '\t1\nq', o_orderkey, '_R\tchr', o_custkey % 10, ' x:', o_custkey + 200, '\t-\t0')"""
    return K.zoom_to_sam(spark, put(spark, table(spark, sf, "orders"), text, "zoom"), 36).select("qname", "flag", "rname", "pos", "cigar", "rnext", "tlen")


@query("S29_novo_to_sam", f"""
WITH {_MATES} SELECT concat('q', k) AS qname, CASE WHEN e = 1 THEN 1 + 64 + 2 + 32 ELSE 1 + 128 + 2 + 16 END AS flag, c AS rname, CASE WHEN e = 1 THEN p + 1 ELSE p + 101 END AS pos, CASE WHEN e = 1 THEN 60 ELSE 40 END AS mapq, CASE WHEN e = 1 THEN '4M2I2M2D2M' ELSE '10M' END AS cigar,
  CASE WHEN e = 1 THEN 'ACGTACGTAC' ELSE 'GTACGTACGT' END AS seq, CASE WHEN e = 1 THEN '2A3^CG2' ELSE '10' END AS md FROM m, (VALUES (1), (2)) t(e)""")
def s29n(spark, sf):
    text = r"""concat('# a comment\n@q', o_orderkey, '/1\tL\tACGTACGTAC\tIIIIIIIIII\tU\t60\t50\t>chr', o_custkey % 10, '\t', o_custkey + 1, '\tF\t.\t1\tR\t3A>T 5+TT 7-C 8-G\n@q', o_orderkey, '/2\tR\tACGTACGTAC\tIIIIIIIIII\tU\t30\t40\t>chr', o_custkey % 10, '\t', o_custkey + 101, '\tR\t.\t1\tF')"""
    sam = K.novo_to_sam(spark, put(spark, table(spark, sf, "orders"), text, "novo"))
    return sam.select("qname", "flag", "rname", "pos", "mapq", "cigar", "seq", F.substring(F.get("tag_text", F.lit(1)), 6, 50).alias("md"))


_EXPORT = r"""concat_ws('\t', 'M', '1', o_orderkey, '2', '3', '4', 'ACG', '{r}', 'ACGTACGTAC', 'hhhhhhhhhh', if(o_orderstatus = 'P', 'NM', concat('chr', o_custkey % 10)), '', if(o_orderstatus = 'P', '', string(o_custkey + {at})), '{s}', if(o_orderstatus = 'P', '', '{d}'), '{se}', '{pe}', '', '', '', '', if(o_orderkey % 7 = 0, 'N', 'Y'))"""


def exports(spark, sf):
    # a total order over one column of unique numbers keeps the two files in step
    o = table(spark, sf, "orders").repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey")
    a = put(spark, o, _EXPORT.format(r=1, at=1, s="F", d="5^AC$5", se=50, pe=90), "export")
    b = put(spark, o, _EXPORT.format(r=2, at=101, s="R", d="A2^3$4", se=70, pe=0), "export")
    return a, b


@query("S30_export_to_sam", """
WITH m AS (SELECT o_orderkey AS k, o_custkey AS p, o_orderstatus <> 'P' AS has, concat('chr', o_custkey % 10) AS c FROM orders WHERE o_orderkey % 7 <> 0)
SELECT concat('M_1:', k, ':2:3:4') AS qname, CASE WHEN e = 1 THEN 65 + CASE WHEN has THEN 2 + 32 ELSE 4 + 8 END ELSE 129 + CASE WHEN has THEN 16 ELSE 4 + 8 END END AS flag, CASE WHEN has THEN c ELSE '*' END AS rname, CASE WHEN NOT has THEN 0 WHEN e = 1 THEN p + 1 ELSE p + 101 END AS pos,
  CASE WHEN NOT has THEN 0 WHEN e = 1 THEN 90 ELSE 70 END AS mapq, CASE WHEN NOT has THEN '*' WHEN e = 1 THEN '5M2D5M' ELSE '4M3I3M' END AS cigar, CASE WHEN has THEN '=' ELSE '*' END AS rnext, CAST(CASE WHEN NOT has THEN 0 WHEN e = 1 THEN 110 ELSE -110 END AS BIGINT) AS tlen,
  CASE WHEN e = 1 THEN 'ACGTACGTAC' ELSE 'GTACGTACGT' END AS seq, repeat('I', 10) AS qual, concat('BC:Z:ACG', CASE WHEN has THEN CASE WHEN e = 1 THEN ' XD:Z:5^AC$5 SM:i:50 AS:i:90' ELSE ' XD:Z:4^3$2T SM:i:70 AS:i:0' END ELSE '' END) AS tags FROM m, (VALUES (1), (2)) t(e)""")
def s30(spark, sf):
    a, b = exports(spark, sf)
    return K.export_to_sam(spark, a, b).select("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "tlen", "seq", "qual", F.array_join("tag_text", " ").alias("tags"))


@query("S30_export_mismatches", """
WITH n AS (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) - 1 AS n, count(*) OVER () AS total FROM orders)
SELECT n FROM n WHERE k % 7 = 3 UNION ALL SELECT total FROM n WHERE n = 0""")
def s30m(spark, sf):
    # every seventh name differs, and the second file has one line more
    o = table(spark, sf, "orders").repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey")
    first = put(spark, o, _EXPORT.format(r=1, at=1, s="F", d="5^AC$5", se=50, pe=90), "export")
    last = o.orderBy(F.desc("o_orderkey")).limit(1).withColumn("o_orderkey", F.col("o_orderkey") + 8)
    renamed = o.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 7 == 3, F.col("o_orderkey") + 10_000_000).otherwise(F.col("o_orderkey")))
    both = renamed.select("*", F.lit(0).alias("_late")).unionByName(last.withColumn("_late", F.lit(1)))
    key = F.when(F.col("o_orderkey") > 10_000_000, F.col("o_orderkey") - 10_000_000).otherwise(F.col("o_orderkey"))
    both = both.withColumn("_at", key).repartitionByRange("_late", "_at").sortWithinPartitions("_late", "_at")
    second = put(spark, both, _EXPORT.format(r=2, at=101, s="R", d="A2^3$4", se=70, pe=0), "export")
    return K.export_mismatches(spark, first, second).select("n")


@query("S31_blast_to_sam", """
SELECT concat('q', p_partkey) AS qname, CASE WHEN e = 1 THEN 0 ELSE 16 END AS flag, concat('s', p_size) AS rname, CASE WHEN e = 1 THEN 101::BIGINT ELSE 1::BIGINT END AS pos, CASE WHEN e = 1 THEN '4H5M1D3M1I4M3H' ELSE '12H4M4H' END AS cigar,
  CASE WHEN e = 1 THEN 'ACGTACGTTACGT' ELSE 'GGGT' END AS seq, concat('AS:i:', CASE WHEN e = 1 THEN 21 ELSE 8 END, ' EV:Z:', CASE WHEN e = 1 THEN '1e-10' ELSE '0.5' END) AS tags FROM part, (VALUES (1), (2)) t(e)""")
def s31(spark, sf):
    text = r"""concat('Query= q', p_partkey, ' words\n         (20 letters)\n\n>s', p_size, ' subject\n          Length = 500\n\n Score = 20.8 bits (10), Expect = e-10\n Strand = Plus / Plus\n\nQuery: 5   ACGTA-CGT 12\n           ||||| |||\nSbjct: 101 ACGTAGCGT 109\n\nQuery: 13 TACGT 17\nSbjct: 110 -ACGT 113\n\n Score = 7.6 bits (4), Expect = 0.5\n Strand = Plus / Minus\n\nQuery: 5 ACCC 8\nSbjct: 4 ACCC 1\n')"""
    sam = K.blast_to_sam(spark, put(spark, table(spark, sf, "part"), text, "blast"))
    return sam.select("qname", "flag", "rname", "pos", "cigar", "seq", F.array_join("tag_text", " ").alias("tags"))


@query("S34_sra_read_groups", "SELECT concat('SRR', p_partkey) AS run, 'strainA' AS sample, CASE WHEN p_size % 5 = 0 THEN NULL ELSE concat('lib', p_size % 50) END AS library FROM part")
def s34(spark, sf):
    p = table(spark, sf, "part")
    sample = put_xml(spark, p.select("p_size").distinct(), "'<SAMPLE alias=\"strainA\" accession=\"SRS1\"></SAMPLE>'", X.SAMPLE, "SAMPLE")
    exp = put_xml(spark, p.filter("p_size % 5 <> 0"), "concat('<EXPERIMENT accession=\"SRX', p_partkey, '\"><DESIGN><LIBRARY_DESCRIPTOR><LIBRARY_NAME> lib', p_size % 50, ' </LIBRARY_NAME></LIBRARY_DESCRIPTOR></DESIGN></EXPERIMENT>')", X.EXPERIMENT, "EXPERIMENT")
    run = put_xml(spark, p, "concat('<RUN accession=\"SRR', p_partkey, '\"><EXPERIMENT_REF accession=\"SRX', p_partkey, '\"/><DATA_BLOCK><FILES><FILE filename=\"a\"/><FILE filename=\"b\"/></FILES></DATA_BLOCK></RUN>')", X.RUN, "RUN")
    return X.sra_read_groups(spark, sample, exp, run).select("run", "sample", "library")


@query("S35_read_map_alignments", """
SELECT concat('c', p_partkey) AS contig, CAST(1 + (p_size % 2 = 0)::INT AS BIGINT) AS n FROM part""")
def s35(spark, sf):
    text = r"""concat('<A><RESTRICTION_MAP ID="m"><SEQUENCE_ANNOTATION IDENTIFIER="c', p_partkey, ' in silico" INSILICO="true"/></RESTRICTION_MAP>', if(p_size % 2 = 0, concat('<MAP_ALIGNMENT MAP1="optical" MAP2="c', p_partkey, ' in silico"/>'), ''), '</A>')"""
    schema = f"RESTRICTION_MAP struct<{X.RESTRICTION_MAP}>, MAP_ALIGNMENT struct<{X.MAP_ALIGNMENT}>"
    m = X.read_map_alignments(spark, put_xml(spark, table(spark, sf, "part"), text, schema, "A"))
    return m.groupBy("contig").agg(F.count("*").alias("n"))
