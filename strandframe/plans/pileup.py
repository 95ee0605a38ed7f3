"""Queries over per-site views, each with its oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import pileup as P
from .alignments import BLK, MASK, REFS, al, references
from .fixtures import fx
from .registry import query

ORDER = ["qname", "flag"]

BASES = f"""
{BLK}, ba AS (SELECT f.qname, f.rname, CAST(f.pos + ro AS BIGINT) AS pos, f.pos AS st, CASE WHEN op = 'D' THEN '*' ELSE substr(f.seq, qo + 1, 1) END AS base,
   ascii(substr(f.qual, qo + 1, 1)) - 33 AS q, f.mapq, f.flag & 16 <> 0 AS back, CASE WHEN last AND op = 'M' THEN nxt ELSE 0 END AS indel,
   CASE WHEN last AND op = 'M' AND nxt > 0 THEN substr(f.seq, nq + 1, CAST(nxt AS INT)) ELSE '' END AS ins, head, tail, f.flag, f.cigar, f.seq, f.qual, f.rg
   FROM fx_alignments f JOIN pb USING (cigar) JOIN tot USING (cigar) WHERE f.flag & {MASK} = 0)"""
COUNTS = """
ct AS (SELECT rname, pos, count(*) AS depth, count(*) FILTER (WHERE base = 'A') AS a, count(*) FILTER (WHERE base = 'C') AS c, count(*) FILTER (WHERE base = 'G') AS g, count(*) FILTER (WHERE base = 'T') AS t,
  count(*) FILTER (WHERE base = '*') AS deleted, count(*) FILTER (WHERE indel > 0) AS insertions, count(*) FILTER (WHERE indel < 0) AS deletions, count(*) FILTER (WHERE head) AS starts, count(*) FILTER (WHERE tail) AS ends,
  CAST(floor(sqrt(sum(least(mapq, 60) * least(mapq, 60)) / CAST(count(*) AS DOUBLE)) + 0.499) AS INT) AS rms_mapq FROM ba GROUP BY rname, pos)"""


@query("A21_site_counts", f"""
WITH {BASES}, {COUNTS} SELECT rname, pos, depth, a AS "A", c AS "C", g AS "G", t AS "T", deleted, insertions, deletions, starts, ends, rms_mapq FROM ct""")
def a21c(spark, sf):
    return P.site_counts(P.read_bases(al(spark, sf))).drop("other")


_LINES = f"""{BASES}, {REFS},
rf AS (SELECT ba.*, CASE WHEN coalesce(substr(ref, CAST(pos AS INT), 1), '') = '' THEN 'N' ELSE substr(ref, CAST(pos AS INT), 1) END AS rb,
   rpad(coalesce(substr(ref, CAST(pos + 1 AS INT), CAST(greatest(-indel, 0) AS INT)), ''), CAST(greatest(-indel, 0) AS INT), 'N') AS lost FROM ba LEFT JOIN refs ON name = rname),
tx AS (SELECT *, concat(CASE WHEN head THEN concat('^', chr(least(mapq + 33, 126))) ELSE '' END,
   CASE WHEN base = '*' THEN '*' WHEN base = rb THEN CASE WHEN back THEN ',' ELSE '.' END WHEN back THEN lower(base) ELSE base END,
   CASE WHEN indel > 0 THEN concat('+', indel, CASE WHEN back THEN lower(ins) ELSE ins END) WHEN indel < 0 THEN concat(indel, CASE WHEN back THEN lower(lost) ELSE lost END) ELSE '' END,
   CASE WHEN tail THEN '$' ELSE '' END) AS t, chr(least(q + 33, 126)) AS qc, chr(least(mapq + 33, 126)) AS mc FROM rf)"""
_ORD = "st, qname, flag, t, qc, mc"


@query("A21_pileup", f"""
WITH {_LINES}
SELECT rname, pos, 0 AS part, any_value(rb) AS ref, count(*) AS depth, string_agg(t, '' ORDER BY {_ORD}) AS bases, string_agg(qc, '' ORDER BY {_ORD}) AS quals, string_agg(mc, '' ORDER BY {_ORD}) AS mapqs FROM tx GROUP BY rname, pos""")
def a21(spark, sf):
    return P.pileup(al(spark, sf), ORDER, references(spark, sf))


@query("J12_pileup_sites", f"""
WITH {BASES}, s AS (SELECT DISTINCT concat('chr', s_suppkey % 10) AS rname, s_suppkey * 7 AS pos FROM supplier)
SELECT ba.rname, ba.pos, count(*) AS depth, string_agg(chr(least(q + 33, 126)), '' ORDER BY st, qname, flag, base, indel, q, mapq) AS quals FROM ba JOIN s USING (rname, pos) GROUP BY ba.rname, ba.pos""")
def j12(spark, sf):
    s = spark.read.parquet(f"{sf}/supplier.parquet").select(
        F.concat(F.lit("chr"), F.col("s_suppkey") % 10).alias("rname"), (F.col("s_suppkey") * 7).alias("pos"))
    return P.pileup(al(spark, sf), ORDER, sites=s).select("rname", "pos", "depth", "quals")


@query("A22_mpileup", f"""
WITH {_LINES}, g AS (SELECT rname, pos, rg, count(*) AS d, string_agg(t, '' ORDER BY {_ORD}) AS b, string_agg(qc, '' ORDER BY {_ORD}) AS q FROM tx GROUP BY rname, pos, rg)
SELECT rname, pos, 0 AS part, """ + ", ".join(
    f"coalesce(max(CASE WHEN rg = '{r}' THEN d END), 0) AS depth_{r}, coalesce(max(CASE WHEN rg = '{r}' THEN b END), '*') AS bases_{r}, coalesce(max(CASE WHEN rg = '{r}' THEN q END), '*') AS quals_{r}"
    for r in ("rg0", "rg1", "rg2")) + " FROM g GROUP BY rname, pos")
def a22(spark, sf):
    return P.mpileup(al(spark, sf), "rg", ["rg0", "rg1", "rg2"], ORDER, contigs=references(spark, sf))


_TOP = """tp AS (SELECT *, greatest(a, c, g, t) AS top, CASE greatest(a, c, g, t) WHEN a THEN 'A' WHEN c THEN 'C' WHEN g THEN 'G' ELSE 'T' END AS b FROM ct)"""


@query("A23_call_consensus", f"""
WITH {BASES}, {COUNTS}, {_TOP} SELECT rname, pos, depth, CASE WHEN depth BETWEEN 5 AND 200 AND top / CAST(depth AS DOUBLE) > 0.4 THEN b ELSE 'N' END AS base FROM tp""")
def a23(spark, sf):
    return P.call_consensus(P.read_bases(al(spark, sf)), 0.4, 5, 200)


@query("A23_call_consensus_quality", f"""
WITH {BASES.replace(f'f.flag & {MASK} = 0)', f'f.flag & {MASK} = 0 AND ascii(substr(f.qual, qo + 1, 1)) - 33 > 30)')}, {COUNTS}, {_TOP}
SELECT rname, pos, depth, CASE WHEN depth >= 2 AND top / CAST(depth AS DOUBLE) >= 0.5 THEN b ELSE 'N' END AS base FROM tp""")
def a23q(spark, sf):
    return P.call_consensus(P.read_bases(al(spark, sf)), 0.5, 2, inclusive=True, min_quality=30)


def _costs() -> str:
    out = []
    for i, a in enumerate("ACGT"):
        for b in "ACGT"[i:]:
            rest = [x for x in "ACGT" if x not in (a, b)]
            cost = " + ".join(f"e{x}" for x in rest)
            if a != b:
                cost = f"{cost} + 4.343::DOUBLE * ln(2.0::DOUBLE) * (c{a} + c{b})"
            out.append((len(out), P.AMBIGUITY[a + b], cost, 0 if a == b else 27))
    return " UNION ALL ".join(f"SELECT rname, pos, {i} AS i, '{g}' AS g, {c} AS cost, {h} AS het FROM st" for i, g, c, h in out)


# The damped sum row by row, unlike the operator, which sums runs of equal quality.
GENO = f"""
{BASES}, {COUNTS},
rk AS (SELECT rname, pos, base, back, least(q, mapq) AS cq, q <> 0 AS nz FROM ba WHERE base IN ('A','C','G','T') AND (least(q, mapq) > 0 OR q <> 0)),
wt AS (SELECT rname, pos, base, CASE WHEN cq < 4 AND nz THEN 4 ELSE cq END AS eq, row_number() OVER (PARTITION BY rname, pos, base, back ORDER BY cq DESC, nz DESC) - 1 AS w FROM rk),
es AS (SELECT rname, pos, base, sum(eq * (pow(0.85::DOUBLE, w) * 0.97::DOUBLE + 0.03::DOUBLE)) AS e, count(*) AS c FROM wt GROUP BY ALL),
s0 AS (SELECT rname, pos, {", ".join(f"coalesce(sum(e) FILTER (WHERE base = '{b}'), 0.0::DOUBLE) AS e{b}, coalesce(sum(c) FILTER (WHERE base = '{b}'), 0) AS c{b}0" for b in "ACGT")}, sum(c) AS n FROM es GROUP BY rname, pos),
st AS (SELECT *, {", ".join(f"CASE WHEN n > 255 THEN floor(254.0::DOUBLE * c{b}0 / n + 0.5) ELSE c{b}0 END AS c{b}" for b in "ACGT")} FROM s0),
co AS ({_costs()}),
vl AS (SELECT rname, pos, i, g, least(floor(cost - min(cost) OVER (PARTITION BY rname, pos) + 0.5), 255) + het AS v FROM co),
rn AS (SELECT *, row_number() OVER (PARTITION BY rname, pos ORDER BY v, i) AS k FROM vl),
gt AS (SELECT rname, pos, max(CASE WHEN k = 1 THEN g END) AS consensus, max(CASE WHEN k = 2 THEN g END) AS second,
   CAST(least(max(CASE WHEN k = 2 THEN v END) - max(CASE WHEN k = 1 THEN v END), 255) AS INT) AS quality,
   CAST(least(max(CASE WHEN k = 3 THEN v END) - max(CASE WHEN k = 2 THEN v END), 255) AS INT) AS second_quality FROM rn GROUP BY rname, pos),
nd AS (SELECT rname, pos, count(*) AS depth, CAST(floor(sqrt(sum(least(mapq, 60) * least(mapq, 60)) / CAST(count(*) AS DOUBLE)) + 0.499) AS INT) AS rms_mapq FROM ba WHERE base <> '*' GROUP BY rname, pos)"""


@query("A24_call_genotypes", f"WITH {GENO} SELECT gt.*, nd.depth, nd.rms_mapq FROM gt JOIN nd USING (rname, pos)")
def a24(spark, sf):
    return P.call_genotypes(P.read_bases(al(spark, sf)))


# A consensus-pileup table from the variant view: SNP rows and indel rows.
CP = """
cp AS (SELECT chrom AS rname, pos, CASE WHEN length(ref) > 1 OR length(alt) > 1 THEN '*' ELSE ref END AS ref,
  CASE WHEN length(ref) > 1 THEN concat('-', substr(ref, 2), '/*') WHEN length(alt) > 1 THEN concat('+', substr(alt, 2), '/*') WHEN alt = '.' THEN ref ELSE alt END AS consensus,
  CAST(floor(qual) AS INT) AS quality, CAST(floor(qual * 2) AS INT) AS snp_quality, CAST(floor(qual / 2 + 10) AS INT) AS rms_mapq, CAST(floor(qual) + 5 AS BIGINT) AS depth,
  CASE WHEN length(ref) > 1 THEN '*' WHEN length(alt) > 1 THEN concat('+', substr(alt, 2)) WHEN gt = '1/1' THEN repeat(alt, CAST(floor(qual) + 5 AS INT)) WHEN gt = '0/1' THEN concat(repeat(lower(alt), CAST(floor(qual) AS INT)), '.,...') ELSE repeat('.', CAST(floor(qual) + 5 AS INT)) END AS bases,
  CASE WHEN length(ref) > 1 THEN '*' WHEN length(alt) > 1 THEN concat('+', substr(alt, 2)) END AS allele1, CASE WHEN length(ref) > 1 THEN concat('-', substr(ref, 2)) WHEN length(alt) > 1 THEN '*' END AS allele2 FROM {v})"""


def consensus_rows(spark, sf):
    v = fx(spark, sf, "variants")
    q = F.col("qual")
    n = F.floor(q).cast("int")
    lost, more = F.length("ref") > 1, F.length("alt") > 1
    minus, plus = F.concat(F.lit("-"), F.expr("substr(ref, 2)")), F.concat(F.lit("+"), F.expr("substr(alt, 2)"))
    return v.select(
        F.col("chrom").alias("rname"), "pos", F.when(lost | more, F.lit("*")).otherwise(F.col("ref")).alias("ref"),
        F.when(lost, F.concat(minus, F.lit("/*"))).when(more, F.concat(plus, F.lit("/*"))).when(F.col("alt") == ".", F.col("ref"))
        .otherwise(F.col("alt")).alias("consensus"),
        n.alias("quality"), F.floor(q * 2).cast("int").alias("snp_quality"), F.floor(q / 2 + 10).cast("int").alias("rms_mapq"),
        (F.floor(q) + 5).alias("depth"),
        F.when(lost, F.lit("*")).when(more, plus).when(F.col("gt") == "1/1", F.repeat("alt", n + 5))
        .when(F.col("gt") == "0/1", F.concat(F.repeat(F.lower("alt"), n), F.lit(".,..."))).otherwise(F.repeat(F.lit("."), n + 5)).alias("bases"),
        F.when(lost, F.lit("*")).when(more, plus).alias("allele1"), F.when(lost, minus).when(more, F.lit("*")).alias("allele2"))


_CP = CP.format(v="fx_variants")


@query("P33_filter_pileup", f"WITH {_CP} SELECT rname, pos, ref, consensus, snp_quality, depth FROM cp WHERE CASE WHEN ref = '*' THEN snp_quality >= 50 ELSE snp_quality >= 20 END AND depth >= 20")
def p33(spark, sf):
    return P.filter_pileup(consensus_rows(spark, sf)).select("rname", "pos", "ref", "consensus", "snp_quality", "depth")


_CHANGES = f"""{_CP}, ch AS (SELECT rname, pos, CASE WHEN ref = '*' THEN CASE WHEN allele1 = '*' THEN allele2 ELSE allele1 END
   WHEN length(bases) - length(replace(lower(bases), lower(consensus), '')) > 0.9::DOUBLE * depth THEN consensus END AS change FROM cp WHERE depth >= 20)"""


@query("A25_basecall_changes", f"WITH {_CHANGES} SELECT * FROM ch WHERE change IS NOT NULL")
def a25(spark, sf):
    return P.basecall_changes(consensus_rows(spark, sf))


# Edits base by base: every contig position, its replacement and what goes before it.
@query("A26_apply_alternates", f"""
WITH {REFS}, e AS (SELECT chrom, pos, max(CASE WHEN split_part(alt, ',', 1) IN ('', '.') THEN 'N' ELSE split_part(alt, ',', 1) END) AS txt FROM fx_variants GROUP BY chrom, pos),
b AS (SELECT name, i AS pos, substr(ref, CAST(i AS INT), 1) AS base FROM (SELECT name, ref, unnest(range(1, length(ref) + 1)) AS i FROM refs))
SELECT name, md5(string_agg(coalesce(txt, base), '' ORDER BY b.pos)) AS digest FROM b LEFT JOIN e ON chrom = name AND e.pos = b.pos GROUP BY name""")
def a26(spark, sf):
    v = fx(spark, sf, "variants")
    return P.apply_alternates(references(spark, sf), v).select("name", F.md5("seq").alias("digest"))


@query("A26_edited_pieces", f"""
WITH {REFS}, e AS (SELECT chrom, pos, max(CASE WHEN split_part(alt, ',', 1) IN ('', '.') THEN 'N' ELSE split_part(alt, ',', 1) END) AS txt FROM fx_variants GROUP BY chrom, pos),
b AS (SELECT name, i AS pos, substr(ref, CAST(i AS INT), 1) AS base FROM (SELECT name, ref, unnest(range(1, length(ref) + 1)) AS i FROM refs))
SELECT name, CAST((b.pos - 1) // 100 AS BIGINT) AS piece, string_agg(coalesce(txt, base), '' ORDER BY b.pos) AS seq FROM b LEFT JOIN e ON chrom = name AND e.pos = b.pos GROUP BY ALL""")
def a26p(spark, sf):
    return P.edited_pieces(references(spark, sf), P.alternates_as_edits(fx(spark, sf, "variants")), chunk=100)


@query("A26_apply_changes", f"""
WITH {REFS}, v AS (SELECT concat('chr', o_custkey % 40) AS chrom, o_orderkey * 5 + 2 AS pos, CASE o_orderstatus WHEN 'O' THEN 'G' WHEN 'F' THEN '+TTC' ELSE '-AC' END AS change FROM orders),
k AS (SELECT chrom, pos, min(change) AS change FROM v GROUP BY chrom, pos),
b AS (SELECT name, i AS pos, substr(ref, CAST(i AS INT), 1) AS base FROM (SELECT name, ref, unnest(range(1, length(ref) + 1)) AS i FROM refs)),
j AS (SELECT b.name, b.pos, CASE WHEN s.change IS NOT NULL THEN s.change WHEN d1.change IS NOT NULL OR d2.change IS NOT NULL THEN '' ELSE base END AS base, coalesce(substr(n.change, 2), '') AS after
  FROM b LEFT JOIN k s ON s.chrom = b.name AND s.pos = b.pos AND s.change = 'G'
  LEFT JOIN k d1 ON d1.chrom = b.name AND d1.pos = b.pos - 1 AND d1.change = '-AC' LEFT JOIN k d2 ON d2.chrom = b.name AND d2.pos = b.pos - 2 AND d2.change = '-AC'
  LEFT JOIN k n ON n.chrom = b.name AND n.pos = b.pos AND n.change = '+TTC')
SELECT name, md5(string_agg(concat(base, after), '' ORDER BY pos)) AS digest FROM j GROUP BY name""")
def a26c(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    change = F.when(F.col("o_orderstatus") == "O", F.lit("G")).when(F.col("o_orderstatus") == "F", F.lit("+TTC")).otherwise(F.lit("-AC"))
    v = o.select(F.concat(F.lit("chr"), F.col("o_custkey") % 40).alias("rname"), (F.col("o_orderkey") * 5 + 2).alias("pos"), change.alias("change"))
    k = v.groupBy("rname", "pos").agg(F.min("change").alias("change"))
    return P.apply_variants(references(spark, sf), k).select("name", F.md5("seq").alias("digest"))


@query("W14_consensus_from_pileup", f"""
WITH {_CP}, s AS (SELECT rname, pos, min({{'b': CASE WHEN rms_mapq >= 25 AND depth BETWEEN 3 AND 255 THEN upper(consensus) ELSE lower(consensus) END, 'q': chr(least(quality + 33, 126))}}) AS s FROM cp WHERE ref <> '*' GROUP BY rname, pos),
gp AS (SELECT DISTINCT rname, greatest(pos - 2, 0) AS x FROM cp WHERE ref = '*' AND snp_quality >= 96),
lw AS (SELECT DISTINCT rname, x + i AS pos FROM gp, range(1, 5) t(i)),
g AS (SELECT rname, unnest(range(1, max(pos) + 1)) AS pos FROM s GROUP BY rname)
SELECT g.rname, string_agg(CASE WHEN lw.pos IS NOT NULL THEN lower(coalesce(s.b, 'n')) ELSE coalesce(s.b, 'n') END, '' ORDER BY g.pos) AS seq, string_agg(coalesce(s.q, '!'), '' ORDER BY g.pos) AS qual
FROM g LEFT JOIN s ON s.rname = g.rname AND s.pos = g.pos LEFT JOIN lw ON lw.rname = g.rname AND lw.pos = g.pos GROUP BY g.rname""")
def w14p(spark, sf):
    rows = consensus_rows(spark, sf).groupBy("rname", "pos", "ref", "consensus", "quality", "snp_quality", "rms_mapq", "depth").agg(
        F.count("*").alias("_n")).drop("_n")
    sure = (F.col("rms_mapq") >= 25) & F.col("depth").between(3, 255)
    shown = F.when(sure, F.upper("consensus")).otherwise(F.lower("consensus"))
    one = rows.filter("ref <> '*'").groupBy("rname", "pos").agg(F.min(F.struct(
        shown.alias("b"), F.char(F.least(F.col("quality") + 33, F.lit(126))).alias("c"), "ref", "consensus", "quality", "snp_quality", "rms_mapq", "depth")).alias("s"))
    one = one.select("rname", "pos", *[F.col(f"s.{c}").alias(c) for c in ("ref", "consensus", "quality", "snp_quality", "rms_mapq", "depth")])
    sites = one.unionByName(rows.filter("ref = '*'"))
    return P.consensus_from_pileup(sites, min_indel_score=96, indel_window=2)


@query("W14_consensus_from_variants", """
WITH v AS (SELECT chrom, pos, ref, alt, concat(info, ';AF1=', CASE WHEN gt = '1/1' THEN '1' ELSE '0.2' END, ';FQ=', CASE WHEN qual > 25 THEN '-' ELSE '' END, CAST(floor(qual) AS INT)) AS info, qual, gt FROM fx_variants WHERE gt <> '0/1'),
p AS (SELECT *, CAST(regexp_extract(info, 'DP=(\\d+)', 1) AS INT) AS dp, CAST(regexp_extract(info, 'MQ=(\\d+)', 1) AS INT) AS mq,
   CASE WHEN qual > 25 THEN CASE WHEN gt = '0/0' OR alt = '.' THEN ref ELSE alt END ELSE CASE concat(least(ref, alt), greatest(ref, alt)) WHEN 'AC' THEN 'M' WHEN 'AG' THEN 'R' WHEN 'AT' THEN 'W' WHEN 'CG' THEN 'S' WHEN 'CT' THEN 'Y' WHEN 'GT' THEN 'K' ELSE 'N' END END AS b FROM v),
s AS (SELECT chrom, pos, min({'b': CASE WHEN mq >= 10 AND dp >= 3 THEN upper(b) ELSE lower(b) END, 'q': chr(CAST(33 + floor(qual) AS INT))}) AS s FROM p WHERE length(ref) = 1 AND length(alt) = 1 GROUP BY chrom, pos),
gp AS (SELECT DISTINCT chrom, greatest(pos - 1, 0) + 1 AS x, pos + length(ref) + 1 AS y FROM v WHERE length(ref) > 1 OR length(alt) > 1),
lw AS (SELECT DISTINCT chrom, unnest(range(x, y + 1)) AS pos FROM gp),
g AS (SELECT chrom, unnest(range(1, max(pos) + 1)) AS pos FROM s GROUP BY chrom)
SELECT g.chrom, string_agg(CASE WHEN lw.pos IS NOT NULL THEN lower(coalesce(s.b, 'n')) ELSE coalesce(s.b, 'n') END, '' ORDER BY g.pos) AS seq, string_agg(coalesce(s.q, '!'), '' ORDER BY g.pos) AS qual
FROM g LEFT JOIN s ON s.chrom = g.chrom AND s.pos = g.pos LEFT JOIN lw ON lw.chrom = g.chrom AND lw.pos = g.pos GROUP BY g.chrom""")
def w14v(spark, sf):
    v = fx(spark, sf, "variants")
    af = F.when(F.col("gt") == "1/1", F.lit("1")).otherwise(F.lit("0.2"))
    fq = F.concat(F.when(F.col("qual") > 25, F.lit("-")).otherwise(F.lit("")), F.floor("qual").cast("string"))
    v = v.withColumn("info", F.concat("info", F.lit(";AF1="), af, F.lit(";FQ="), fq))
    return P.consensus_from_variants(v, indel_window=1)


@query("C4_alignments_to_consensus", f"""
WITH {BASES}, {COUNTS}, {_TOP},
bd AS (SELECT floor(greatest(avg(depth) - 3 * stddev_samp(depth), 5)) AS lo, ceil(avg(depth) + 3 * stddev_samp(depth)) AS hi FROM ct),
cs AS (SELECT rname, pos, CASE WHEN depth BETWEEN lo AND hi AND top / CAST(depth AS DOUBLE) > 0.4 THEN b ELSE 'N' END AS base, chr(CAST(least(depth + 33, 126) AS INT)) AS qc FROM tp, bd),
gr AS (SELECT rname, unnest(range(1, max(pos) + 1)) AS pos FROM cs GROUP BY rname),
sq AS (SELECT gr.rname AS name, string_agg(coalesce(base, 'N'), '' ORDER BY gr.pos) AS seq, string_agg(coalesce(qc, '!'), '' ORDER BY gr.pos) AS qual FROM gr LEFT JOIN cs ON cs.rname = gr.rname AND cs.pos = gr.pos GROUP BY gr.rname),
r AS (SELECT name, regexp_replace(seq, '^N+', '') AS s, length(seq) - length(regexp_replace(seq, '^N+', '')) AS lead, qual FROM sq),
p AS (SELECT name, lead, qual, regexp_split_to_array(s, 'N{{3,}}') AS parts, regexp_extract_all(s, 'N{{3,}}') AS runs FROM r),
e AS (SELECT name, lead, qual, parts, runs, unnest(range(1, len(parts) + 1)) AS i FROM p),
o AS (SELECT name, lead, qual, i, parts[i] AS seq, coalesce(list_sum(list_transform(parts[1:i - 1], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(runs[1:i - 1], lambda x: length(x))), 0) AS off FROM e)
SELECT concat(name, '_subcontig', i - 1) AS name, CAST(off + lead + 1 AS INT) AS start, seq, substr(qual, CAST(off + lead + 1 AS INT), CAST(length(seq) AS INT)) AS qual FROM o WHERE length(seq) > 0""")
def c4(spark, sf):
    return P.alignments_to_consensus(al(spark, sf), min_share=0.4)
