"""Queries over hits and annotation, each with its oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import annotation as N
from .fixtures import fx, in_order, table
from .registry import query


def hits(spark, sf):
    return fx(spark, sf, "hits")


_PH = """ph AS (SELECT p_partkey, concat('sp|P', p_partkey, '|X', p_size, '_ECO ', p_name, ' protein OS=', replace(p_brand, '#', 'ella'), CASE WHEN p_size % 3 = 0 THEN '' ELSE concat(' GN=gen', p_size) END,
   CASE WHEN p_size % 2 = 0 THEN concat(' (EC 1.2.', p_size, '.4)') ELSE '' END, ' PE=1') AS header FROM part)"""


def headers(spark, sf):
    s = F.col("p_size")
    return table(spark, sf, "part").select("p_partkey", F.concat(
        F.lit("sp|P"), "p_partkey", F.lit("|X"), s, F.lit("_ECO "), "p_name", F.lit(" protein OS="), F.replace("p_brand", F.lit("#"), F.lit("ella")),
        F.when(s % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(" GN=gen"), s)),
        F.when(s % 2 == 0, F.concat(F.lit(" (EC 1.2."), s, F.lit(".4)"))).otherwise(F.lit("")), F.lit(" PE=1")).alias("header"))


@query("P25_parse_protein_header", f"""
WITH {_PH} SELECT p.p_partkey, split_part(header, ' ', 1) AS id, concat('X', p_size, '_ECO~~~', CASE WHEN p_size % 2 = 0 THEN concat('1.2.', p_size, '.4') ELSE '' END, '~~~gen', p_size, '~~~', p_name, ' protein') AS description
FROM ph JOIN part p USING (p_partkey) WHERE p_size % 3 <> 0 AND p_brand IN ('Brand#1', 'Brand#2')""")
def p25(spark, sf):
    return N.parse_protein_header(headers(spark, sf), genera=["Brandella1 ", "Brandella2 "], need_genes=True).select("p_partkey", "id", "description")


@query("P26_phage_header", """
SELECT p_partkey, concat('PHAGE_', p_size, '-gi') AS id, concat('~~~', p_partkey, '~~~', p_name, ' [x y]') AS description FROM part""")
def p26(spark, sf):
    h = F.concat(F.lit("PHAGE_"), "p_size", F.lit("-gi|"), "p_partkey", F.lit("|ref|NP_1| "), "p_name", F.lit(" [x y]"))
    return N.parse_protein_header(table(spark, sf, "part").withColumn("header", h), kind="phage").select("p_partkey", "id", "description")


@query("P26_virulence_header", """
SELECT p_partkey, concat('R', p_partkey, '~~~', CASE WHEN p_size % 2 = 0 THEN '3.4.1.19' ELSE '' END, '~~~', CASE WHEN p_size % 3 = 0 THEN '' ELSE 'inlA' END, '~~~', p_name, CASE WHEN p_size % 2 = 0 THEN ' EC 3.4.1.19' ELSE '' END) AS id FROM part""")
def p26v(spark, sf):
    s = F.col("p_size")
    h = F.concat(F.lit("R"), "p_partkey", F.lit(" (gi:3026) "), F.when(s % 3 == 0, F.lit("BA05")).otherwise(F.lit("inlA (BA05)")), F.lit(" - "), "p_name",
                 F.when(s % 2 == 0, F.lit(" EC 3.4.1.19")).otherwise(F.lit("")))
    return N.parse_protein_header(table(spark, sf, "part").withColumn("header", h), kind="virulence").select("p_partkey", "id")


@query("P27_split_tilde", """
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN concat('X', p_size) END AS xref, CASE WHEN p_size % 2 = 0 THEN '1.2.3.4' END AS "EC", CASE WHEN p_size % 2 = 0 THEN 'genA' END AS gene, CASE WHEN p_size % 2 = 0 THEN concat('alpha ', p_name) END AS product,
  CASE WHEN p_size % 2 = 0 THEN concat('alpha ', p_name) ELSE p_name END AS description FROM part""")
def p27(spark, sf):
    s = F.col("p_size")
    t = F.when(s % 2 == 0, F.concat(F.lit("X"), s, F.lit("~~~1.2.3.4~~~genA~~~alpha"))).otherwise(F.lit("plain"))
    rows = table(spark, sf, "part").select("p_partkey", t.alias("target_id"), F.col("p_name").alias("description"))
    return N.split_tilde(rows).select("p_partkey", "xref", "EC", "gene", "product", "description")


@query("P28_filter_hits", "SELECT query_id, target_id, bits FROM fx_hits WHERE coverage BETWEEN 30 AND 100 AND similarity >= 50 AND identity >= 40 AND query_id <> target_id")
def p28(spark, sf):
    return N.filter_hits(hits(spark, sf), 30, 50, 40).select("query_id", "target_id", "bits")


@query("P28_query_coverage", """
SELECT concat('g', l_orderkey) AS query_id, concat('t', l_partkey) AS target_id, round(floor(l_quantity) / (50 + o_custkey % 10) * 100, 2) AS coverage
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def p28c(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.concat(F.lit("g"), "l_orderkey").alias("query_id"), F.concat(F.lit("t"), "l_partkey").alias("target_id"),
        F.concat(F.repeat(F.lit("M"), F.floor("l_quantity").cast("int")), F.lit("-- -")).alias("query_string"))
    proteins = table(spark, sf, "orders").select(F.concat(F.lit("g"), "o_orderkey").alias("name"), F.repeat(F.lit("M"), (50 + F.col("o_custkey") % 10).cast("int")).alias("seq"))
    return N.query_coverage(li, proteins).select("query_id", "target_id", "coverage")


def _preset(step: str, scale: str = "") -> str:
    p = N.PRESETS[step]
    e = f"AND evalue{scale} <= {p.evalue}::DOUBLE" if p.evalue else ""
    return f"""SELECT query_id, target_id, bits, evalue, coverage, identity FROM fx_hits WHERE coverage BETWEEN {p.cov} AND 100 AND identity >= {p.identity} AND similarity >= {p.sim} {e}
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY evalue, target_id, coverage, identity) <= {p.top}"""


def _register(step: str) -> None:
    @query(f"P29_annotate_{step}", _preset(step, " * 1e-7::DOUBLE").replace("bits, evalue,", "bits,"))
    def run(spark, sf):
        h = hits(spark, sf).withColumn("evalue", F.col("evalue") * 1e-7)
        return N.annotate_hits(h, step, ("target_id", "coverage", "identity")).select("query_id", "target_id", "bits", "coverage", "identity")


for _step in N.PRESETS:
    _register(_step)


@query("O3_sort_hits", "SELECT query_id, target_id, evalue FROM fx_hits")
def o3(spark, sf):
    return N.sort_hits(hits(spark, sf)).select("query_id", "target_id", "evalue")


@query("O4_top_hits", "SELECT query_id, target_id, evalue FROM fx_hits QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY evalue, target_id) <= 2")
def o4(spark, sf):
    return N.top_hits(hits(spark, sf), 2).select("query_id", "target_id", "evalue")


@query("O5_best_hit", "SELECT query_id, target_id, bits FROM fx_hits QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY bits DESC, evalue, target_id) = 1")
def o5(spark, sf):
    return N.best_hit(hits(spark, sf)).select("query_id", "target_id", "bits")


@query("O8_order_genes", "SELECT locus_tag, CAST(substr(locus_tag, 2) AS BIGINT) AS number FROM fx_genes")
def o8(spark, sf):
    return N.order_genes(fx(spark, sf, "genes")).select("locus_tag", N.gene_number().alias("number"))


@query("O7_order_features", "SELECT seqname, lo, hi, locus_tag FROM fx_genes")
def o7(spark, sf):
    return N.order_features(fx(spark, sf, "genes")).select("seqname", "lo", "hi", "locus_tag")


@query("O3_order", "SELECT row_number() OVER (ORDER BY query_id, evalue) AS place, query_id, evalue FROM fx_hits")
def o3o(spark, sf):
    return in_order(N.sort_hits(hits(spark, sf)).select("query_id", "evalue"))


@query("O7_order", "SELECT row_number() OVER (ORDER BY seqname, lo, hi DESC) AS place, seqname, lo, hi FROM fx_genes")
def o7o(spark, sf):
    return in_order(N.order_features(fx(spark, sf, "genes")).select("seqname", "lo", "hi"))


@query("O8_order", "SELECT row_number() OVER (ORDER BY CAST(substr(locus_tag, 2) AS BIGINT), locus_tag) AS place, locus_tag FROM fx_genes")
def o8o(spark, sf):
    return in_order(N.order_genes(fx(spark, sf, "genes")).select("locus_tag"))


@query("U3_distinct", "SELECT DISTINCT query_id, target_id, coverage FROM fx_hits")
def u3(spark, sf):
    return hits(spark, sf).select("query_id", "target_id", "coverage").distinct()


_TOP2 = "t2 AS (SELECT query_id, target_id, bits FROM fx_hits QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY evalue, target_id, coverage) <= 2)"


@query("J1_combine_annotations", f"""
WITH {_TOP2}, l AS (SELECT query_id, string_agg(concat(target_id, '=', bits), ',' ORDER BY target_id, bits) AS hits, count(*) AS n FROM t2 GROUP BY query_id)
SELECT locus_tag, product, coalesce(hits, '') AS hits, CAST(coalesce(n, 0) AS INT) AS n FROM fx_genes LEFT JOIN l ON query_id = locus_tag""")
def j1(spark, sf):
    top = N.top_hits(hits(spark, sf), 2, ("target_id", "coverage")).select(F.col("query_id").alias("locus_tag"), "target_id", "bits")
    both = N.combine_annotations(fx(spark, sf, "genes"), {"hits": top})
    text = F.array_join(F.transform("hits", lambda h: F.concat(h["target_id"], F.lit("="), h["bits"])), ",")
    return both.select("locus_tag", "product", text.alias("hits"), F.size("hits").alias("n"))


@query("J1_gene_rows", "SELECT g.locus_tag, type, target_id FROM fx_genes g LEFT JOIN fx_hits ON query_id = g.locus_tag")
def j1r(spark, sf):
    t = hits(spark, sf).select(F.col("query_id").alias("locus_tag"), "target_id")
    return N.gene_rows(fx(spark, sf, "genes"), t).select("locus_tag", "type", "target_id")


@query("J2_hits_with_entries", "SELECT query_id, target_id, p_name AS entry FROM fx_hits JOIN part ON target_id = concat('t', p_partkey) WHERE p_size < 40")
def j2(spark, sf):
    e = table(spark, sf, "part").filter("p_size < 40").select(F.concat(F.lit("t"), "p_partkey").alias("target_id"), F.col("p_name").alias("entry"))
    return N.hits_with_entries(hits(spark, sf), e, "target_id").select("query_id", "target_id", "entry")


@query("J2_hits_without_entry", "SELECT query_id, target_id FROM fx_hits WHERE target_id NOT IN (SELECT concat('t', p_partkey) FROM part WHERE p_size < 40)")
def j2m(spark, sf):
    e = table(spark, sf, "part").filter("p_size < 40").select(F.concat(F.lit("t"), "p_partkey").alias("target_id"))
    return N.hits_without_entry(hits(spark, sf), e, "target_id").select("query_id", "target_id")


@query("J3_hits_with_cogs", """
SELECT query_id, target_id, CASE WHEN p_size % 3 <> 0 THEN concat('COG', p_size) END AS group_id, CASE WHEN p_size % 3 <> 0 AND p_size <= 24 THEN concat('group of nation ', n_name) END AS description
FROM fx_hits JOIN part ON target_id = concat('t', p_partkey) LEFT JOIN nation ON n_nationkey = p_size""")
def j3(spark, sf):
    m = table(spark, sf, "part").filter("p_size % 3 <> 0").select(F.concat(F.lit("t"), "p_partkey").alias("target_id"), F.concat(F.lit("COG"), "p_size").alias("group_id"))
    d = table(spark, sf, "nation").select(F.concat(F.lit("COG"), "n_nationkey").alias("group_id"), F.concat(F.lit("group of nation "), "n_name").alias("description"))
    return N.hits_with_cogs(hits(spark, sf), m, d).select("query_id", "target_id", "group_id", "description")


_TAGS = "tg AS (SELECT l_orderkey, CASE WHEN l_linenumber % 2 = 0 THEN 'product' ELSE 'note' END AS tag, concat('v', l_partkey) AS value, l_linenumber FROM lineitem)"


@query("A30_consolidate_tags", f"WITH {_TAGS} SELECT l_orderkey, tag, 0 AS part, string_agg(value, ';' ORDER BY l_linenumber, value) AS value FROM tg GROUP BY l_orderkey, tag")
def a30(spark, sf):
    t = table(spark, sf, "lineitem").select(
        "l_orderkey", F.when(F.col("l_linenumber") % 2 == 0, F.lit("product")).otherwise(F.lit("note")).alias("tag"), F.concat(F.lit("v"), "l_partkey").alias("value"), "l_linenumber")
    return N.consolidate_tags(t, ["l_orderkey"], ["l_linenumber", "value"])


@query("P37_notes_to_tags", """
SELECT DISTINCT o_orderkey, t.tag, t.value FROM (SELECT o_orderkey, unnest([{'tag': 'priority', 'value': o_orderpriority}, {'tag': 'status', 'value': o_orderstatus}, {'tag': 'cust', 'value': CAST(o_custkey AS VARCHAR)}]) AS t FROM orders)""")
def p37(spark, sf):
    note = F.concat(F.lit(" priority : "), "o_orderpriority", F.lit("; status:"), "o_orderstatus", F.lit(";empty:;novalue; status:"), "o_orderstatus", F.lit(" ;cust: "), "o_custkey")
    return N.notes_to_tags(table(spark, sf, "orders").withColumn("note", note), ["o_orderkey"])


@query("F7_aa_to_genome", """
WITH m AS (SELECT concat('g', l_orderkey) AS locus_tag, l_linenumber AS s, l_linenumber + CAST(floor(l_quantity) AS INT) AS e FROM lineitem)
SELECT g.locus_tag, s, e, CASE WHEN type = 'CDS' THEN lo + (s - 1) * 3 ELSE hi - e * 3 + 1 END AS g_start, CASE WHEN type = 'CDS' THEN lo + e * 3 - 1 ELSE hi - (s - 1) * 3 END AS g_end FROM m JOIN fx_genes g USING (locus_tag)""")
def f7(spark, sf):
    m = table(spark, sf, "lineitem").select(F.concat(F.lit("g"), "l_orderkey").alias("locus_tag"), F.col("l_linenumber").alias("start"),
                                            (F.col("l_linenumber") + F.floor("l_quantity").cast("int")).alias("end"))
    g = fx(spark, sf, "genes").withColumn("strand", F.when(F.col("type") == "CDS", F.lit("+")).otherwise(F.lit("-")))
    return N.domains_on_genome(m, g).select("locus_tag", F.col("start").alias("s"), F.col("end").alias("e"), "g_start", "g_end")


@query("F13_gene_and_product", """
SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN concat('gen', p_size) END AS gene, concat(p_name, ' protein') AS product FROM part""")
def f13(spark, sf):
    s = F.col("p_size")
    d = F.concat("p_name", F.lit(" protein OS=E coli"), F.when(s % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(" GN=gen"), s)), F.lit(" PE=1"))
    return N.describe_hits(table(spark, sf, "part").withColumn("description", d)).select("p_partkey", "gene", "product")


@query("F14_resistance_parts", """
SELECT p_partkey, 'Bla' AS drug_class, concat('AMP', p_size) AS gene, concat('AP', p_partkey) AS hit, '10-90' AS coords, '81' AS length FROM part""")
def f14(spark, sf):
    n = F.concat(F.lit("(Bla)AMP"), "p_size", F.lit(":AP"), "p_partkey", F.lit(":10-90:81"))
    return table(spark, sf, "part").select("p_partkey", names.resistance_parts(n).alias("r")).select("p_partkey", "r.*")


@query("C6_annotate", f"""
WITH a AS ({_preset('UNIPROT')}), b AS ({_preset('VFDB')}),
x AS (SELECT query_id, target_id FROM a QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY bits DESC, evalue, target_id) = 1),
y AS (SELECT query_id, target_id FROM b QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY bits DESC, evalue, target_id) = 1)
SELECT locus_tag, product, nullif(concat_ws(';', 'UNIPROT:' || x.target_id, 'VFDB:' || y.target_id), '') AS found FROM fx_genes LEFT JOIN x ON x.query_id = locus_tag LEFT JOIN y ON y.query_id = locus_tag""")
def c6(spark, sf):
    h = hits(spark, sf)
    return N.annotate(fx(spark, sf, "genes"), {"UNIPROT": h, "VFDB": h}).select("locus_tag", "product", "found")
