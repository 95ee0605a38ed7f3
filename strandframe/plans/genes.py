"""Queries over predictions and features, each with its oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contigs as C
from ..operators import genes as G
from .contigs import contigs
from .fixtures import fx, table
from .registry import query

_AA = ("substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', CAST(16 * (instr('TCAG', substr({c}, 1, 1)) - 1) + "
       "4 * (instr('TCAG', substr({c}, 2, 1)) - 1) + instr('TCAG', substr({c}, 3, 1)) AS INT), 1)")


def protein(nt: str) -> str:
    c = f"substr({nt}, CAST(i AS INT), 3)"
    return (f"array_to_string(list_transform(range(1, length({nt}) + 1, 3), lambda i: CASE WHEN length({c}) = 3 AND regexp_full_match({c}, '[ACGT]*') "
            f"THEN {_AA.format(c=c)} ELSE 'X' END), '')")


def _orfs(min_len: int, truncated: bool) -> str:
    keep = "" if truncated else "AND closed"
    return f"""
fr AS (SELECT name, length(seq) AS n, s.strand, f, CASE WHEN s.strand = '-' THEN (length(seq) - f) % 3 ELSE f END AS shift,
         CASE WHEN s.strand = '-' THEN reverse(translate(seq, 'ATGC', 'TACG')) ELSE seq END AS rd FROM fx_contigs, (VALUES ('+'), ('-')) s(strand), (VALUES (0), (1), (2)) t(f)),
cd AS (SELECT name, n, strand, f, shift, i, substr(rd, CAST(shift + 3 * i + 1 AS INT), 3) AS c, i = (n - shift) // 3 - 1 AS last FROM (SELECT *, unnest(range(0, (n - shift) // 3)) AS i FROM fr)),
sg AS (SELECT *, coalesce(sum(CASE WHEN c IN ('TAA','TAG','TGA') THEN 1 ELSE 0 END) OVER (PARTITION BY name, strand, f ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM cd),
og AS (SELECT name, n, strand, f, shift, seg, min(i) AS a, max(i) AS b, bool_or(c IN ('TAA','TAG','TGA')) AS closed, min(CASE WHEN c IN ('ATG','GTG') THEN i END) AS st FROM sg GROUP BY ALL),
orfs AS (SELECT name, concat(f, CASE WHEN strand = '-' THEN 'R' ELSE '' END) AS frame, strand,
   CASE WHEN strand = '-' THEN n - shift - 3 * a ELSE shift + 3 * a + 1 END AS ustop, CASE WHEN strand = '-' THEN n - shift - 3 * st ELSE shift + 3 * st + 1 END AS start,
   CASE WHEN strand = '-' THEN n - shift - 3 * (b + 1) + 1 ELSE shift + 3 * (b + 1) END AS stop, (b - a + 1) * 3 AS length, a = 0 AS truncated_upstream, NOT closed AS truncated_downstream
   FROM og WHERE (b - a + 1) * 3 >= {min_len} AND st IS NOT NULL AND (b - st + 1) * 3 >= {min_len} {keep})"""


_ORF_OUT = """SELECT name, frame, strand, CAST(ustop AS BIGINT) AS ustop, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop, CAST(length AS BIGINT) AS length,
  truncated_upstream, truncated_downstream, CAST(least(start, stop) AS BIGINT) AS lo, CAST(greatest(start, stop) AS BIGINT) AS hi FROM orfs"""


@query("W12_find_orfs", f"WITH {_orfs(90, False)} {_ORF_OUT}")
def w12(spark, sf):
    return G.find_orfs(contigs(spark, sf))


@query("W12_find_orfs_truncated", f"WITH {_orfs(30, True)} {_ORF_OUT}")
def w12t(spark, sf):
    return G.find_orfs(contigs(spark, sf), min_len=30, truncated=True)


@query("W12_orf_sequences", f"""
WITH {_orfs(60, False)}, t AS (SELECT o.*, CASE WHEN strand = '-' THEN reverse(translate(substr(seq, CAST(stop AS INT), CAST(start - stop + 1 AS INT)), 'ATGC', 'TACG'))
   ELSE substr(seq, CAST(start AS INT), CAST(stop - start + 1 AS INT)) END AS nt FROM orfs o JOIN fx_contigs c ON c.name = o.name)
SELECT name, frame, CAST(stop AS BIGINT) AS stop, nt AS seq, {protein('nt')} AS aa_seq FROM t""")
def w12s(spark, sf):
    return G.find_orfs(contigs(spark, sf), min_len=60, start2stop=True, with_seq=True).select("name", "frame", "stop", "seq", "aa_seq")


@query("W15_snap_to_start", """
WITH r AS (SELECT name, CAST(substr(name, 2) AS BIGINT) % 3 + 1 AS lo, CASE WHEN CAST(substr(name, 2) AS BIGINT) % 2 = 0 THEN '+' ELSE '-' END AS strand, seq FROM fx_contigs),
h AS (SELECT *, lo + 3 * ((length(seq) - lo + 1) // 3) - 1 AS hi, lo + (length(seq) - lo + 1) // 3 AS pos FROM r WHERE length(seq) > 10),
b AS (SELECT *, pos - 1 - ((pos - 1 - (lo - 1)) % 3) AS here FROM h),
i AS (SELECT *, unnest(range(0, length(seq) // 3 + 1)) AS i FROM b),
c AS (SELECT name, lo - 1 + 3 * i AS low, here, pos, lo FROM i WHERE lo + 3 * i + 2 <= hi AND CASE WHEN strand = '-' THEN substr(seq, CAST(lo + 3 * i AS INT), 3) IN ('CAT','CAC') ELSE substr(seq, CAST(lo + 3 * i AS INT), 3) IN ('ATG','GTG') END),
m AS (SELECT name, min(low) FILTER (WHERE low >= here) AS nx, max(low) FILTER (WHERE low < here AND low > lo - 1) AS pv FROM c GROUP BY name)
SELECT b.name, CASE WHEN nx IS NULL THEN pv WHEN pv IS NULL THEN nx WHEN pos - 1 - pv < nx - (pos - 1) THEN pv ELSE nx END + CASE WHEN strand = '-' THEN 3 ELSE 1 END AS snapped FROM b LEFT JOIN m USING (name)""")
def w15(spark, sf):
    k = F.regexp_extract("name", r"(\d+)", 1).cast("bigint")
    rows = contigs(spark, sf).filter(F.length("seq") > 10).withColumn("lo", k % 3 + 1)
    room = F.length("seq") - F.col("lo") + 1
    rows = rows.withColumns({"hi": F.col("lo") + 3 * F.floor(room / 3) - 1, "pos": F.col("lo") + F.floor(room / 3),
                             "strand": F.when(k % 2 == 0, F.lit("+")).otherwise(F.lit("-"))})
    rows = rows.withColumn("seq", F.substr("seq", F.col("lo").cast("int"), (F.col("hi") - F.col("lo") + 1).cast("int")))
    return G.snap_to_start(rows).select("name", "snapped")


_REC = """
rc AS (SELECT seqname, strand, stop, count(*) AS contributors, string_agg(DISTINCT predictor, ',' ORDER BY predictor) AS predictors,
   CASE WHEN strand = '+' THEN max(start) FILTER (WHERE predictor <> 'BLAST') ELSE min(start) FILTER (WHERE predictor <> 'BLAST') END AS start FROM fx_predictions GROUP BY seqname, strand, stop)"""


@query("A27_reconcile_predictions", f"""
WITH {_REC} SELECT seqname, strand, stop, start, least(start, stop) AS lo, greatest(start, stop) AS hi, predictors, CAST(contributors AS BIGINT) AS contributors FROM rc WHERE contributors >= 3 AND start IS NOT NULL""")
def a27(spark, sf):
    return G.reconcile_predictions(fx(spark, sf, "predictions"), 3)[0]


@query("A27_minority", f"""
WITH {_REC} SELECT p.seqname, p.strand, p.stop, p.start, p.predictor FROM fx_predictions p JOIN rc USING (seqname, strand, stop) WHERE contributors < 3 OR rc.start IS NULL""")
def a27m(spark, sf):
    return G.reconcile_predictions(fx(spark, sf, "predictions"), 3)[1].select("seqname", "strand", "stop", "start", "predictor")


_RNA = """rna AS (SELECT concat('chr', o_custkey % 10) AS seqname, CASE o_orderstatus WHEN 'O' THEN '+' ELSE '-' END AS strand, CASE o_orderstatus WHEN 'O' THEN (o_orderkey % 2000) * 3 + 900 ELSE (o_orderkey % 2000) * 3 + 1 END AS stop,
   max(CASE o_orderstatus WHEN 'O' THEN (o_orderkey % 2000) * 3 + 830 ELSE (o_orderkey % 2000) * 3 + 75 END) AS start, CASE o_orderstatus WHEN 'P' THEN 'rRNA' ELSE 'tRNA' END AS type FROM orders GROUP BY ALL),
rn AS (SELECT seqname, strand, stop, min({'a': start, 'b': type}) AS s FROM rna GROUP BY seqname, strand, stop)"""


def rna(spark, sf):
    o, base = table(spark, sf, "orders"), (F.col("o_orderkey") % 2000) * 3
    fwd = F.col("o_orderstatus") == "O"
    rows = o.select(
        F.concat(F.lit("chr"), F.col("o_custkey") % 10).alias("seqname"), F.when(fwd, F.lit("+")).otherwise(F.lit("-")).alias("strand"),
        F.when(fwd, base + 900).otherwise(base + 1).alias("stop"), F.when(fwd, base + 830).otherwise(base + 75).alias("start"),
        F.when(F.col("o_orderstatus") == "P", F.lit("rRNA")).otherwise(F.lit("tRNA")).alias("type"))
    one = rows.groupBy("seqname", "strand", "stop").agg(F.min(F.struct("start", "type")).alias("s")).select("seqname", "strand", "stop", "s.*")
    return one.withColumns({"lo": F.least("start", "stop"), "hi": F.greatest("start", "stop")})


_OVER = """
cds AS (SELECT seqname, strand, stop, start, 'CDS' AS type FROM rc WHERE contributors >= 3 AND start IS NOT NULL),
ov AS (SELECT seqname, strand, stop, s.a AS start, s.b AS type FROM rn UNION ALL SELECT * FROM cds ANTI JOIN rn USING (seqname, strand, stop))"""


@query("A28_overlay_features", f"WITH {_REC}, {_RNA}, {_OVER} SELECT seqname, strand, stop, start, least(start, stop) AS lo, greatest(start, stop) AS hi, type FROM ov")
def a28(spark, sf):
    genes = G.reconcile_predictions(fx(spark, sf, "predictions"), 3)[0].withColumn("type", F.lit("CDS"))
    columns = ["seqname", "strand", "stop", "start", "lo", "hi", "type"]
    return G.overlay_features(genes.select(columns), rna(spark, sf).select(columns))


_TAGGED = """SELECT seqname, strand, stop, start, type, concat('ST_', CASE type WHEN 'tRNA' THEN 't' WHEN 'rRNA' THEN 'r' ELSE '' END,
  printf('%04d', row_number() OVER (PARTITION BY type ORDER BY seqname, stop, strand, start))) AS locus_tag FROM ov"""


@query("W7_assign_locus_tags", """
WITH f AS (SELECT locus_tag AS old, seqname, lo, hi, CASE type WHEN 'gene' THEN 'rRNA' ELSE type END AS type FROM fx_genes)
SELECT old, concat('ST_', CASE type WHEN 'tRNA' THEN 't' WHEN 'rRNA' THEN 'r' ELSE '' END, printf('%04d', row_number() OVER (PARTITION BY type ORDER BY seqname, hi))) AS locus_tag FROM f""")
def w7(spark, sf):
    f = fx(spark, sf, "genes").select(
        F.col("locus_tag").alias("old"), "seqname", F.col("lo").alias("start"), F.col("hi").alias("stop"), F.lit("+").alias("strand"),
        F.when(F.col("type") == "gene", F.lit("rRNA")).otherwise(F.col("type")).alias("type"))
    return G.assign_locus_tags(f, "ST").select("old", "locus_tag")


@query("C5_predict", f"WITH {_REC}, {_RNA}, {_OVER} {_TAGGED}")
def c5(spark, sf):
    return G.predict(fx(spark, sf, "predictions"), [rna(spark, sf)], "ST", 3).select("seqname", "strand", "stop", "start", "type", "locus_tag")


_ORFHITS = """
h AS (SELECT CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, concat('chr_', l_suppkey % 10) AS seqname, CASE WHEN l_linestatus = 'O' THEN l_partkey * 3 + 1 ELSE l_partkey * 3 + 900 END AS os,
  CASE WHEN l_linestatus = 'O' THEN l_partkey * 3 + 300 ELSE l_partkey * 3 + 601 END AS oe, concat('t', l_orderkey) AS name2, CAST(floor(l_quantity) AS BIGINT) * 2 AS al, l_discount * 1000 AS pid, l_linenumber AS s1, l_extendedprice AS bits FROM lineitem),
g AS (SELECT * FROM h WHERE al * 3 / 300.0 >= 0.5 AND pid >= 40),
b AS (SELECT *, row_number() OVER (PARTITION BY seqname, os, oe, strand ORDER BY bits DESC, name2, s1) AS k FROM g),
p AS (SELECT seqname, strand, oe AS stop, CASE WHEN strand = '+' THEN os + (s1 - 1) * 3 ELSE os - (s1 - 1) * 3 END AS start, bits FROM b WHERE k = 1)"""


@query("A29_orf_hits_to_genes", f"""
WITH {_ORFHITS} SELECT seqname, strand, stop, start, least(start, stop) AS lo, greatest(start, stop) AS hi, 'CDS' AS type, 'BLAST' AS predictor, max(bits) AS score FROM p GROUP BY seqname, strand, stop, start""")
def a29(spark, sf):
    li = table(spark, sf, "lineitem")
    fwd = F.col("l_linestatus") == "O"
    base = F.col("l_partkey") * 3
    os_, oe = F.when(fwd, base + 1).otherwise(base + 900), F.when(fwd, base + 300).otherwise(base + 601)
    al = F.floor("l_quantity") * 2
    hits = li.select(
        F.concat_ws("_", F.concat(F.lit("chr---"), F.col("l_suppkey") % 10), os_, oe, F.when(fwd, F.lit("+")).otherwise(F.lit("-")), os_, F.lit("300"), base, base).alias("name1"),
        F.concat(F.lit("t"), "l_orderkey").alias("name2"), al.alias("al_len"), (F.col("l_discount") * 1000).alias("percent_id"),
        F.col("l_linenumber").cast("bigint").alias("start1"), (F.col("l_linenumber") + al - 1).alias("end1"), F.col("l_extendedprice").alias("bitscore"))
    return G.orf_hits_to_genes(hits, 0.5, 0.4)


_FEAT = """
ft AS (SELECT concat('ST_', doc_id) AS tag, name AS seqname, doc_id % 40 + 1 AS lo, least(doc_id % 40 + 3 * (20 + doc_id % 700), length(seq)) AS hi, CASE WHEN quality = 1 THEN '+' ELSE '-' END AS strand,
  CASE WHEN toxic = 1 THEN concat('gen', doc_id % 10) END AS gene, CASE WHEN doc_id % 2 = 0 THEN 'some protein' END AS product, seq FROM labels JOIN fx_contigs ON name = concat('c', doc_id) WHERE length(seq) >= doc_id % 40 + 1),
nt AS (SELECT *, CASE WHEN strand = '-' THEN reverse(translate(substr(seq, CAST(lo AS INT), CAST(hi - lo + 1 AS INT)), 'ATGC', 'TACG')) ELSE substr(seq, CAST(lo AS INT), CAST(hi - lo + 1 AS INT)) END AS nt FROM ft)"""


def features(spark, sf):
    d = F.col("doc_id")
    sized = contigs(spark, sf).select("name", F.length("seq").alias("n"))
    # a gene begins inside its contig
    rows = table(spark, sf, "labels").withColumn("name", F.concat(F.lit("c"), d)).join(sized, "name").filter(F.col("n") >= d % 40 + 1)
    return rows.select(
        F.concat(F.lit("ST_"), d).alias("locus_tag"), F.col("name").alias("seqname"), (d % 40 + 1).alias("lo"),
        F.least(d % 40 + 3 * (20 + d % 700), F.col("n")).alias("hi"), F.when(F.col("quality") == 1, F.lit("+")).otherwise(F.lit("-")).alias("strand"),
        F.lit("CDS").alias("type"), F.when(F.col("toxic") == 1, F.concat(F.lit("gen"), d % 10)).alias("gene"),
        F.when(d % 2 == 0, F.lit("some protein")).alias("product"))


@query("J15_extract_features", f"WITH {_FEAT} SELECT concat_ws('|', 'lcl', tag, 'CDS', lo, hi) AS name, coalesce(gene, product, 'predicted cds') AS description, nt AS seq FROM nt")
def j15(spark, sf):
    return G.extract_features(features(spark, sf), contigs(spark, sf))


@query("C8_feature_proteins", f"WITH {_FEAT} SELECT concat_ws('|', 'lcl', tag, 'CDS', lo, hi) AS name, coalesce(gene, product, 'predicted cds') AS description, {protein('nt')} AS seq FROM nt")
def c8(spark, sf):
    return G.extract_features(features(spark, sf), contigs(spark, sf), protein=True)


# Three exons of a gene, with introns of 10 and 21 bases.
_EXONS = f"""{_FEAT},
ex AS (SELECT tag, strand, seq, lo AS a, lo + 29 AS b, lo + 40 AS c, lo + 60 AS d, lo + 82 AS e, lo + 90 AS g FROM ft),
sp AS (SELECT tag, strand, concat(substr(seq, CAST(a AS INT), CAST(b - a + 1 AS INT)), substr(seq, CAST(c AS INT), CAST(d - c + 1 AS INT)), substr(seq, CAST(e AS INT), CAST(g - e + 1 AS INT))) AS t FROM ex)"""


def exons(spark, sf):
    def span(a, b):
        return F.struct((F.col("lo") + a).alias("lo"), (F.col("lo") + b).alias("hi"))

    return features(spark, sf).withColumn("places", F.array(span(0, 29), span(40, 60), span(82, 90)))


@query("J15_joined_places", f"WITH {_EXONS} SELECT tag AS locus_tag, CASE WHEN strand = '-' THEN reverse(translate(t, 'ATGC', 'TACG')) ELSE t END AS nt FROM sp")
def j15j(spark, sf):
    return G.gene_sequences(exons(spark, sf), contigs(spark, sf)).select("locus_tag", "nt")


@query("P30_flag_abnormal", f"""
WITH {_FEAT}, a AS (SELECT tag, {protein('nt')} AS aa FROM nt) SELECT tag AS locus_tag, length(aa) < 30 OR length(aa) > 2000 OR NOT regexp_matches(aa, 'M.+\\*$') AS abnormal FROM a""")
def p30(spark, sf):
    return G.flag_abnormal(G.gene_sequences(features(spark, sf), contigs(spark, sf))).select("locus_tag", "abnormal")


@query("P31_clip_proteins", f"""
WITH a AS (SELECT name, {protein('seq')} AS aa FROM fx_contigs) SELECT name, substr(aa, 1, 2000) AS seq FROM a WHERE length(aa) >= 20""")
def p31(spark, sf):
    from ..functions.dna import translate_dna

    return G.clip_proteins(contigs(spark, sf).select("name", translate_dna("seq").alias("seq")))


@query("F15_codon_of_anticodon", """
SELECT name, array_to_string(list_transform(range(1, length(seq) + 1, 3), lambda i: reverse(translate(substr(seq, CAST(i AS INT), 3), 'ATGC', 'TACG'))), ' ') AS codons FROM fx_contigs""")
def f15(spark, sf):
    from ..functions.dna import codons

    return contigs(spark, sf).select("name", F.array_join(F.transform(codons("seq"), G.codon_of_anticodon), " ").alias("codons"))


_TYPES = ["CDS", "gene", "tRNA", "CRISPR"]
_COUNTS = """
sq AS (SELECT source AS file, concat('s', doc_id % 300) AS seqid, min(doc_id) AS seq_no FROM documents GROUP BY 1, 2),
fe AS (SELECT d.source AS file, concat('s', d.doc_id % 300) AS seqid, d.doc_id AS seq_no, CASE l_returnflag WHEN 'R' THEN 'CDS' WHEN 'A' THEN 'gene' ELSE 'tRNA' END AS type FROM lineitem JOIN documents d ON d.doc_id = l_partkey),
gl AS (SELECT sq.file, CAST(sum(n_chars) AS BIGINT) AS g FROM sq JOIN documents d ON d.doc_id = seq_no GROUP BY sq.file),
fc AS (SELECT file, count(*) FILTER (WHERE type = 'CDS') AS a, count(*) FILTER (WHERE type = 'gene') AS b, count(*) FILTER (WHERE type = 'tRNA') AS c FROM fe JOIN sq USING (file, seqid, seq_no) GROUP BY file)"""
_COUNTS_OUT = """SELECT file, g AS "genomeLength", coalesce(CAST(nullif(a, 0) AS VARCHAR), '.') AS "CDS", coalesce(CAST(nullif(b, 0) AS VARCHAR), '.') AS gene, coalesce(CAST(nullif(c, 0) AS VARCHAR), '.') AS "tRNA", '.' AS "CRISPR" FROM gl LEFT JOIN fc USING (file)"""


def counted(spark, sf):
    d = table(spark, sf, "documents").select(
        F.col("source").alias("file"), F.concat(F.lit("s"), F.col("doc_id") % 300).alias("seqid"), F.col("doc_id").alias("seq_no"), F.col("n_chars").alias("length"))
    kind = F.when(F.col("l_returnflag") == "R", F.lit("CDS")).when(F.col("l_returnflag") == "A", F.lit("gene")).otherwise(F.lit("tRNA"))
    f = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("seq_no"), kind.alias("type")).join(d.drop("length"), "seq_no")
    return G.feature_counts(d, f, _TYPES)


@query("A9_feature_counts", f"WITH {_COUNTS} {_COUNTS_OUT}")
def a9(spark, sf):
    return counted(spark, sf)


_ANN = """
an AS (SELECT concat('f', o_custkey % 5) AS file, concat('chr', o_custkey % 10) AS seqname, o_orderkey AS ord, CASE o_orderstatus WHEN 'O' THEN 'gene' WHEN 'F' THEN 'CDS' ELSE 'misc_feature' END AS type,
  CASE WHEN o_orderkey % 4 = 0 THEN 'abcD' END AS gene, CASE o_orderkey % 6 WHEN 0 THEN 'putative kinase' WHEN 1 THEN 'hypothetical protein' WHEN 2 THEN 'kinase' END AS product,
  CASE WHEN o_orderkey % 5 = 0 THEN 'Transmembrane helix, predicted' END AS note, CASE WHEN o_orderkey % 7 = 0 THEN 'VF1' END AS vf FROM orders),
sg AS (SELECT file, product, sum(CASE WHEN type = 'gene' THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY seqname, ord) AS seg FROM an),
gp AS (SELECT file, count(*) AS n FROM (SELECT file, seg FROM sg GROUP BY file, seg HAVING bool_or(product IS NOT NULL)) GROUP BY file)"""


def annotated(spark, sf):
    k = F.col("o_orderkey")
    s = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("f"), F.col("o_custkey") % 5).alias("file"), F.concat(F.lit("chr"), F.col("o_custkey") % 10).alias("seqname"), k.alias("ord"),
        F.when(s == "O", "gene").when(s == "F", "CDS").otherwise("misc_feature").alias("type"), F.when(k % 4 == 0, "abcD").alias("gene"),
        F.when(k % 6 == 0, "putative kinase").when(k % 6 == 1, "hypothetical protein").when(k % 6 == 2, "kinase").alias("product"),
        F.when(k % 5 == 0, "Transmembrane helix, predicted").alias("note"), F.when(k % 7 == 0, "VF1").alias("vfdb_id"))


@query("A10_annotation_metrics", f"""
WITH {_ANN} SELECT file, count(*) FILTER (WHERE type = 'gene') AS gene, count(*) FILTER (WHERE type = 'CDS') AS "CDS", 0::BIGINT AS "tRNA", 0::BIGINT AS "rRNA", count(vf) AS vfdb_id,
  count(*) FILTER (WHERE type = 'misc_feature' AND note IS NOT NULL) AS "transmembraneHelix", count(*) FILTER (WHERE type = 'gene' AND an.gene IS NOT NULL) AS characterized, count(*) FILTER (WHERE type = 'CDS' AND an.gene IS NOT NULL) AS "CDS_gene",
  count(*) FILTER (WHERE type = 'CDS' AND product LIKE 'putative%') AS "CDS_putative", count(*) FILTER (WHERE type = 'CDS' AND product LIKE 'hypo%') AS "CDS_hypothetical", any_value(gp.n) AS "genesAnnotated" FROM an JOIN gp USING (file) GROUP BY file""")
def a10(spark, sf):
    return G.annotation_metrics(annotated(spark, sf))


@query("W11_genes_with_product", f"""WITH {_ANN} SELECT file, n AS "genesAnnotated" FROM gp""")
def w11(spark, sf):
    return G.genes_with_product(annotated(spark, sf))


@query("C7_project_metrics", f"""
WITH {_COUNTS}, c AS (SELECT file, count(*) AS n, CAST(sum(length(seq)) AS BIGINT) AS bases FROM fx_contigs WHERE length(seq) >= 500 GROUP BY file), o AS ({_COUNTS_OUT})
SELECT o.*, c.n AS "numContigs", c.bases AS assembled FROM o JOIN c USING (file)""")
def c7(spark, sf):
    m = C.assembly_metrics(contigs(spark, sf), stats=["numContigs", "genomeLength"])
    return counted(spark, sf).join(m.withColumnRenamed("genomeLength", "assembled"), "file")
