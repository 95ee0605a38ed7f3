"""Queries over the read view, each with its oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dna, names, phred as ph
from ..functions.common import chars, compact, compact_nonzero, floor2
from ..operators import reads as R
from ..operators import stats as S
from .fixtures import fx
from .registry import query

GENOME = 5000

# Oracle building blocks: lists where the operators use strings.
_PH = "list_transform(string_split(qual,''), lambda c: ascii(c) - 33)"
MASKED = """
masked AS (
  SELECT rid, pair_id, mate, file, id,
         regexp_replace(seq, '[.Nn]', 'N', 'g') AS seq,
         list_transform(range(1, length(seq) + 1),
           lambda i: CASE WHEN substr(seq, i, 1) IN ('.','N','n') THEN 0 ELSE ascii(substr(qual, i, 1)) - 33 END) AS q
  FROM fx_reads)"""


def _trim(src: str, out: str, minq: str, k: int = 20) -> str:
    return f"""
{out}_n AS (
  SELECT *, coalesce(list_position(list_transform(q[1:{k}], lambda x: x >= {minq}), true) - 1, least({k}, len(q))) AS n5,
         coalesce(list_position(list_transform(list_reverse(q)[1:{k}], lambda x: x >= {minq}), true) - 1, least({k}, len(q))) AS n3
  FROM {src}),
{out} AS (
  SELECT rid, pair_id, mate, file, id, n5, n3,
         CASE WHEN len(q) - n5 - n3 > 0 THEN substr(seq, n5 + 1, len(q) - n5 - n3) ELSE '' END AS seq,
         CASE WHEN len(q) - n5 - n3 > 0 THEN q[n5 + 1 : len(q) - n3] ELSE [] END AS q
  FROM {out}_n)"""


def _text(q: str = "q") -> str:
    return f"coalesce(array_to_string(list_transform({q}, lambda x: chr(CAST(x + 33 AS INT))), ''), '')"


def _routed(src: str, min_len: str = "62", min_avg: str = "10") -> str:
    return f"""
scored AS (SELECT *, length(seq) >= {min_len} AND coalesce(list_sum(q), 0) / greatest(length(seq), 1) >= {min_avg} AS good FROM {src}),
routed AS (SELECT *, CASE WHEN bool_and(good) OVER (PARTITION BY pair_id) THEN 'pair' WHEN good THEN 'singleton' ELSE 'drop' END AS route FROM scored)"""


@query("P1_phred", f"""
SELECT rid, array_to_string({_PH}, ' ') AS numbers, CAST(list_sum({_PH}) AS BIGINT) AS total,
       {_text(_PH)} AS again FROM fx_reads""")
def p1(spark, sf):
    values = ph.phred("qual")
    return fx(spark, sf, "reads").select(
        "rid", ph.numeric_quality(values).alias("numbers"), ph.quality_sum("qual").alias("total"),
        ph.encode_phred(values).alias("again"))


@query("P2_mask_ambiguous", f"WITH {MASKED} SELECT rid, seq, {_text()} AS qual FROM masked")
def p2(spark, sf):
    return R.mask_ambiguous(fx(spark, sf, "reads")).select("rid", "seq", "qual")


@query("P3_trim_ends", f"WITH {MASKED}, {_trim('masked', 'trimmed', '30')} SELECT rid, seq, {_text()} AS qual FROM trimmed")
def p3(spark, sf):
    return R.trim_ends(R.mask_ambiguous(fx(spark, sf, "reads"))).select("rid", "seq", "qual")


@query("P4_trim_average", f"""
WITH {MASKED},
p AS (SELECT m.*, i, list_sum(q[1:i + 1]) / (i + 1.0) < 24 AS low5, list_sum(list_reverse(q)[1:i + 1]) / (i + 1.0) < 24 AS low3
      FROM masked m, range(0, 20) t(i)),
stops AS (SELECT rid, coalesce(min(CASE WHEN NOT low5 AND i > 5 THEN i END), 20) AS s5,
                 coalesce(min(CASE WHEN NOT low3 AND i > 5 THEN i END), 20) AS s3 FROM p GROUP BY rid)
SELECT p.rid, count(*) FILTER (WHERE low5 AND i < s5) AS n5, count(*) FILTER (WHERE low3 AND i < s3) AS n3
FROM p JOIN stops USING (rid) GROUP BY p.rid""")
def p4(spark, sf):
    counted = R.trim_counts(R.mask_ambiguous(fx(spark, sf, "reads")), 24, 20, mode="average")
    return counted.select("rid", F.col("n5").cast("bigint").alias("n5"), F.col("n3").cast("bigint").alias("n3"))


@query("P5_read_is_good", f"""
SELECT rid, length(seq) >= 50 AND list_sum({_PH}) / length(qual) >= 20 AS good FROM fx_reads""")
def p5(spark, sf):
    return fx(spark, sf, "reads").select("rid", R.read_is_good(50, 20).alias("good"))


@query("P6_route_pairs", f"""
WITH {MASKED}, {_trim('masked', 'trimmed', '30')}, {_routed('trimmed', '45', '10')}
SELECT rid, route, seq, {_text()} AS qual FROM routed WHERE route <> 'drop'""")
def p6(spark, sf):
    return R.clean(fx(spark, sf, "reads"), min_length=45).select("rid", "route", "seq", "qual")


@query("P7_pass_rate", f"""
WITH {MASKED}, {_trim('masked', 'trimmed', '30')}, {_routed('trimmed', '45', '10')}
SELECT floor(100.0 * count(*) FILTER (WHERE route <> 'drop') / count(*)) / 100 AS pass_rate FROM routed""")
def p7(spark, sf):
    masked = R.trim_ends(R.mask_ambiguous(fx(spark, sf, "reads")))
    return R.pass_rate(R.route_pairs(masked, R.read_is_good(45, 10)))


_AUTO = f"""
auto AS (SELECT floor(100.0 * sum(length(seq)) / count(*)) / 100 - 20 AS min_length,
                floor(100.0 * sum(list_sum({_PH})) / sum(length(seq))) / 100 - 5 AS min_avg_quality FROM fx_reads)"""


@query("P8_auto_params", f"WITH {_AUTO} SELECT min_length, min_avg_quality, min_avg_quality AS min_quality FROM auto")
def p8(spark, sf):
    return R.auto_params(fx(spark, sf, "reads"))


def _cuts(slope: str) -> str:
    return f"""
bases AS (SELECT i AS pos, upper(substr(seq, CAST(i + 1 AS INT), 1)) AS b, ascii(substr(qual, CAST(i + 1 AS INT), 1)) - 33 AS q
          FROM (SELECT *, unnest(range(0, length(seq))) AS i FROM fx_reads)),
prof AS (SELECT pos, count(*) FILTER (WHERE b='A') * 100.0 / count(*) AS a, count(*) FILTER (WHERE b='C') * 100.0 / count(*) AS c,
                count(*) FILTER (WHERE b='G') * 100.0 / count(*) AS g, count(*) FILTER (WHERE b='T') * 100.0 / count(*) AS t, avg(q) AS q
         FROM bases GROUP BY pos),
prof2 AS (SELECT *, max(pos) OVER () - pos AS back FROM prof),
st5 AS (SELECT x.pos AS i, round((round(abs(y.a-x.a),2)+round(abs(y.c-x.c),2)+round(abs(y.g-x.g),2)+round(abs(y.t-x.t),2))/4,2) <= {slope} AND x.q <> 0 AS ok
        FROM prof2 x JOIN prof2 y ON y.pos = x.pos + 1),
st3 AS (SELECT x.back AS i, round((round(abs(y.a-x.a),2)+round(abs(y.c-x.c),2)+round(abs(y.g-x.g),2)+round(abs(y.t-x.t),2))/4,2) <= {slope} AND x.q <> 0 AS ok
        FROM prof2 x JOIN prof2 y ON y.back = x.back + 1),
cuts AS (SELECT greatest(coalesce((SELECT min(p.i) - 2 FROM st5 p JOIN st5 o ON o.i = p.i - 1 WHERE p.ok AND o.ok), 0), 0) AS s,
                greatest(coalesce((SELECT min(p.i) - 2 FROM st3 p JOIN st3 o ON o.i = p.i - 1 WHERE p.ok AND o.ok), 0), 0) AS e,
                (SELECT count(*) FROM prof) AS n)"""


@query("P9_composition_profile", f"""
WITH {_cuts('1.0')} SELECT CAST(pos AS INT) AS pos, round(a,6) AS a, round(c,6) AS c, round(g,6) AS g, round(t,6) AS t, round(q,6) AS q FROM prof""")
def p9_profile(spark, sf):
    prof = R.composition_profile(fx(spark, sf, "reads"))
    return prof.select("pos", *[F.round(c, 6).alias(c) for c in "acgtq"])


@query("P9_trim_by_composition", f"""
WITH {_cuts('7.0')}
SELECT rid, substr(seq, CAST(s + 1 AS INT), CAST(n - s - e AS INT)) AS seq,
       substr(qual, CAST(s + 1 AS INT), CAST(n - s - e AS INT)) AS qual FROM fx_reads, cuts""")
def p9(spark, sf):
    return R.trim_by_composition(fx(spark, sf, "reads"), 7.0).select("rid", "seq", "qual")


@query("P19_solexa_to_phred", f"""
SELECT rid, array_to_string(list_transform({_PH},
   lambda q: CAST(least(floor(10.0 * log10(1.0 + pow(10.0, (q - 10) / 10.0)) + 0.499), 93) AS INT)), ' ') AS qual FROM fx_reads""")
def p19(spark, sf):
    shifted = F.transform(ph.phred("qual"), lambda q: q - 10)
    return fx(spark, sf, "reads").select("rid", ph.numeric_quality(ph.solexa_to_phred(shifted)).alias("qual"))


@query("P20_with_quality", f"""
SELECT rid, repeat(chr(CAST(33 + floor(-10 * ln(0.15)) AS INT)), CAST(length(seq) AS INT)) AS qual,
       array_to_string(list_transform({_PH}, lambda q: chr(CAST(q + 64 AS INT))), '') AS shifted FROM fx_reads""")
def p20(spark, sf):
    r = fx(spark, sf, "reads").withColumn("shifted", ph.shift_offset("qual", 33, 64))
    return R.with_quality(r, 0.15).select("rid", "qual", "shifted")


@query("P21_fastq_to_fasta_qual", f"""
SELECT id, seq, array_to_string({_PH}, ' ') AS qual FROM fx_reads WHERE length(seq) >= 50""")
def p21(spark, sf):
    seqs, quals = R.fastq_to_fasta_qual(fx(spark, sf, "reads"))
    return R.join_quality(seqs, quals)


_METRICS = f"""
m AS (SELECT file, count(*) AS "numReads", sum(length(seq)) AS bases, min(length(seq)) AS mn, max(length(seq)) AS mx,
             sum(list_sum({_PH})) AS quals FROM fx_reads GROUP BY file)"""


@query("A1_read_metrics", f"""
WITH {_METRICS}
SELECT file, floor(100.0 * bases / "numReads") / 100 AS "avgReadLength", CAST(bases AS BIGINT) AS "totalBases", CAST(mn AS INT) AS "minReadLength",
       CAST(mx AS INT) AS "maxReadLength", floor(100.0 * quals / bases) / 100 AS "avgQuality", "numReads",
       floor(100.0 * bases / {GENOME}) / 100 AS coverage, 'yes' AS pe FROM m""")
def a1(spark, sf):
    return R.read_report(fx(spark, sf, "reads"), genome_size=GENOME)


@query("A2_sampled_metrics", f"""
WITH s AS (SELECT *, CAST('0x' || substr(md5(id), 1, 7) AS BIGINT) < CAST(floor(0.1 * 268435456) AS BIGINT) AS seen FROM fx_reads),
m AS (SELECT file, count(*) AS n, count(*) FILTER (WHERE seen) AS k, sum(length(seq)) FILTER (WHERE seen) AS bases,
             min(length(seq)) FILTER (WHERE seen) AS mn, max(length(seq)) FILTER (WHERE seen) AS mx,
             sum(list_sum({_PH})) FILTER (WHERE seen) AS quals FROM s GROUP BY file)
SELECT file, floor(100.0 * bases / k) / 100 AS "avgReadLength", CAST(floor(CAST(bases * n AS DOUBLE) / k) AS BIGINT) AS "totalBases", CAST(mn AS INT) AS "minReadLength",
       CAST(mx AS INT) AS "maxReadLength", floor(100.0 * quals / bases) / 100 AS "avgQuality", n AS "numReads" FROM m""")
def a2(spark, sf):
    return R.read_metrics(fx(spark, sf, "reads"), sample=0.1).drop("coverage")


@query("A3_length_histogram", """
SELECT CAST(length(seq) AS BIGINT) AS value, count(*) AS n, floor(100.0 * count(*) / (SELECT count(*) FROM fx_reads)) / 100 AS freq, false AS is_total
FROM fx_reads GROUP BY length(seq) UNION ALL SELECT NULL, count(*), NULL, true FROM fx_reads""")
def a3(spark, sf):
    return R.length_histogram(fx(spark, sf, "reads"))


@query("A3_quality_histogram", f"""
WITH v AS (SELECT CAST(list_sum({_PH}) AS BIGINT) AS value FROM fx_reads)
SELECT value, count(*) AS n, floor(100.0 * count(*) / (SELECT count(*) FROM v)) / 100 AS freq, false AS is_total FROM v GROUP BY value
UNION ALL SELECT NULL, count(*), NULL, true FROM v""")
def a3q(spark, sf):
    return R.quality_histogram(fx(spark, sf, "reads"))


@query("A4_fragment_lengths", """
WITH t AS (SELECT rg, list_sort(list(tlen)) AS s, count(*) AS n FROM fx_alignments WHERE tlen > 0 GROUP BY rg)
SELECT rg, s[least(n * 25 // 100, n - 1) + 1] AS q25, s[least(n * 50 // 100, n - 1) + 1] AS q50, s[least(n * 75 // 100, n - 1) + 1] AS q75 FROM t""")
def a4(spark, sf):
    return R.fragment_lengths(fx(spark, sf, "alignments"), "rg")


@query("A20_describe", """
WITH t AS (SELECT rname, list_sort(list(tlen)) AS s, count(*) AS n, avg(tlen) AS mean, stddev_pop(tlen) AS sd, median(tlen) AS med,
                  min(tlen) AS mn, max(tlen) AS mx FROM fx_alignments GROUP BY rname)
SELECT rname, n, round(mean, 6) AS mean, round(sd, 6) AS sd, med AS median, mn AS min, mx AS max, s[least(n * 90 // 100, n - 1) + 1] AS p90 FROM t""")
def a20(spark, sf):
    a = fx(spark, sf, "alignments")
    d = S.describe(a, ["rname"], "tlen").join(S.nearest_rank(a, ["rname"], "tlen", {"p90": 90}), "rname")
    return d.withColumns({"mean": F.round("mean", 6), "sd": F.round("sd", 6)})


@query("A20_argmax", """
SELECT DISTINCT ON (rname) rname, qname, tlen FROM fx_alignments ORDER BY rname, tlen DESC, qname""")
def a20_argmax(spark, sf):
    return S.argmax(fx(spark, sf, "alignments"), ["rname"], "qname", "tlen").select("rname", "qname", "tlen")


_PAIRS = """
prs AS (SELECT pair_id, min(rid) AS rid, max(CASE WHEN mate=1 THEN seq END) AS s1, max(CASE WHEN mate=2 THEN seq END) AS s2,
               max(CASE WHEN mate=1 THEN qual END) AS q1, max(CASE WHEN mate=2 THEN qual END) AS q2,
               max(CASE WHEN mate=1 THEN id END) AS i1, max(CASE WHEN mate=2 THEN id END) AS i2 FROM fx_reads GROUP BY pair_id)"""


def _dedup(key1: str, key2: str) -> str:
    return f"""
WITH {_PAIRS},
k AS (SELECT *, {key1} AS k1, coalesce({key2}, '') AS k2 FROM prs),
g AS (SELECT k1, k2, count(*) AS n, min(rid) AS rid FROM k GROUP BY k1, k2),
e AS (SELECT k1, k2, 1 AS m, i, ascii(substr(q1, CAST(i AS INT), 1)) - 33 AS q FROM (SELECT *, unnest(range(1, length(q1) + 1)) AS i FROM k)
      UNION ALL
      SELECT k1, k2, 2, i, ascii(substr(q2, CAST(i AS INT), 1)) - 33 FROM (SELECT *, unnest(range(1, length(q2) + 1)) AS i FROM k)),
s AS (SELECT k1, k2, m, i, least(40, sum(q)) AS q FROM e GROUP BY ALL),
j AS (SELECT k1, k2, string_agg(chr(CAST(q + 33 AS INT)), '' ORDER BY i) FILTER (WHERE m = 1) AS c1,
             string_agg(chr(CAST(q + 33 AS INT)), '' ORDER BY i) FILTER (WHERE m = 2) AS c2 FROM s GROUP BY k1, k2)
SELECT g.rid, g.n, CASE WHEN g.n > 1 THEN concat(i1, ' combinedReads=', g.n) ELSE i1 END AS id1, s1 AS seq1, s2 AS seq2,
       CASE WHEN g.n > 1 THEN substr(c1, 1, length(q1)) ELSE q1 END AS qual1,
       CASE WHEN g.n > 1 THEN substr(c2, 1, length(q2)) ELSE q2 END AS qual2
FROM g JOIN prs USING (rid) JOIN j USING (k1, k2)"""


_DEDUP_COLUMNS = ["rid", "n", "id1", "seq1", "seq2", "qual1", "qual2"]


@query("A11_dedup_reads", _dedup("s1", "s2"))
def a11(spark, sf):
    return R.dedup_pairs(R.pair_up(fx(spark, sf, "reads"))).select(_DEDUP_COLUMNS)


@query("A11_dedup_prefix", _dedup("substr(s1,1,10)", "substr(s2,1,10)"))
def a11p(spark, sf):
    return R.dedup_pairs(R.pair_up(fx(spark, sf, "reads")), prefix=10).select(_DEDUP_COLUMNS)


@query("A12_downsample_share", """
SELECT rid, id FROM fx_reads WHERE CAST('0x' || substr(md5(CAST(pair_id AS VARCHAR)), 1, 7) AS BIGINT) < CAST(floor(0.25 * 268435456) AS BIGINT)""")
def a12(spark, sf):
    return R.downsample(fx(spark, sf, "reads"), p=0.25).select("rid", "id")


@query("A12_downsample_bases", """
SELECT rid, id FROM fx_reads, (SELECT least(1.0, 100000.0::DOUBLE / sum(length(seq))) AS p FROM fx_reads)
WHERE CAST('0x' || substr(md5(CAST(pair_id AS VARCHAR)), 1, 7) AS BIGINT) < CAST(floor(p * 268435456.0::DOUBLE) AS BIGINT)""")
def a12b(spark, sf):
    return R.downsample(fx(spark, sf, "reads"), coverage=20, genome_size=GENOME).select("rid", "id")


@query("J4_keep_ids", """
SELECT rid, id FROM fx_reads WHERE id IN (SELECT concat('r', o_custkey, '/1') FROM orders WHERE o_orderstatus = 'F')""")
def j4(spark, sf):
    ids = spark.read.parquet(f"{sf}/orders.parquet").filter("o_orderstatus = 'F'").select(
        F.concat(F.lit("r"), "o_custkey", F.lit("/1")).alias("id"))
    return R.keep_ids(fx(spark, sf, "reads"), ids).select("rid", "id")


@query("J5_drop_ids", """
SELECT rid, id FROM fx_reads WHERE id NOT IN (SELECT concat('r', o_custkey, '/1') FROM orders)""")
def j5(spark, sf):
    ids = spark.read.parquet(f"{sf}/orders.parquet").select(F.concat(F.lit("r"), "o_custkey", F.lit("/1")).alias("id"))
    return R.drop_ids(fx(spark, sf, "reads"), ids).select("rid", "id")


@query("J6_join_quality", "SELECT id, seq, qual FROM fx_reads")
def j6(spark, sf):
    r = fx(spark, sf, "reads")
    return R.join_quality(r.select("id", "seq"), r.select("id", "qual")).select("id", "seq", "qual")


@query("J8_interleave", """
WITH a AS (SELECT rid // 2 AS k, id, seq, qual FROM fx_reads WHERE rid % 2 = 0),
b AS (SELECT rid // 2 AS k, id, seq, qual FROM fx_reads WHERE rid % 2 = 1)
SELECT CAST(k * 2 AS BIGINT) AS rid, CAST(k AS BIGINT) AS pair_id, 1 AS mate, a.id, a.seq, a.qual FROM a JOIN b USING (k)
UNION ALL SELECT CAST(k * 2 + 1 AS BIGINT), CAST(k AS BIGINT), 2, b.id, b.seq, b.qual FROM a JOIN b USING (k)""")
def j8(spark, sf):
    first, second = R.deinterleave(fx(spark, sf, "reads"))
    return R.interleave(first, second)


@query("J8_unmatched_ordinals", """
SELECT (SELECT count(*) FROM fx_reads WHERE rid NOT IN (SELECT o_orderkey FROM orders)) AS only_first,
       (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT rid FROM fx_reads)) AS only_second""")
def j8u(spark, sf):
    other = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("rid"))
    return R.unmatched_ordinals(fx(spark, sf, "reads"), other)


@query("J9_deinterleave", "SELECT CAST(rid // 2 AS BIGINT) AS rid, CAST(rid % 2 + 1 AS INT) AS out, id FROM fx_reads")
def j9(spark, sf):
    first, second = R.deinterleave(fx(spark, sf, "reads"))
    return first.select("rid", F.lit(1).alias("out"), "id").union(second.select("rid", F.lit(2).alias("out"), "id"))


@query("J18_remap_names", """
WITH m AS (SELECT id, concat('s', row_number() OVER (ORDER BY id COLLATE "C")) AS short FROM (SELECT DISTINCT id FROM fx_reads))
SELECT r.rid, short, id AS full FROM fx_reads r JOIN m USING (id)""")
def j18(spark, sf):
    renamed, mapping = R.remap_names(fx(spark, sf, "reads").select("rid", "id"), "id")
    return R.restore_names(renamed.withColumn("short_id", F.col("id")), mapping, "id").select(
        "rid", F.col("short_id").alias("short"), F.col("id").alias("full"))


@query("O9_short_entries_in_head", "SELECT rid, id FROM fx_reads WHERE rid < 1000 AND length(seq) < 62")
def o9(spark, sf):
    return R.short_entries(fx(spark, sf, "reads"), 1000, 62).select("rid", "id")


@query("O10_sample_n", "SELECT rid, id FROM fx_reads ORDER BY md5(concat('0:', id)), id LIMIT 500")
def o10(spark, sf):
    return R.sample_n(fx(spark, sf, "reads"), 500).select("rid", "id")


@query("F12_is_paired", """
SELECT file, true AS is_paired, 'Casava1.7' AS format FROM fx_reads GROUP BY file""")
def f12(spark, sf):
    return R.paired_names(fx(spark, sf, "reads"))


_STYLED = """
styled AS (SELECT pair_id, mate, CASE file WHEN 'f0' THEN concat('SRR1.', pair_id, ' HW:fc:', pair_id % 8, ':3:4 length=30')
   WHEN 'f1' THEN concat('HW:7:fc:2:', pair_id % 9, ':10:20 ', mate, ':N:0:ACGT') WHEN 'f2' THEN concat('x', pair_id, '/', mate)
   WHEN 'f3' THEN concat('x', pair_id, '_', mate + 8) ELSE concat('x', pair_id, 'z') END AS id, file, rid FROM fx_reads)"""


@query("F12_name_styles", f"""
WITH {_STYLED} SELECT file, file IN ('f0','f1','f2') AS is_paired,
   CASE file WHEN 'f0' THEN 'SRA' WHEN 'f1' THEN 'Casava1.8' WHEN 'f2' THEN 'Casava1.7' ELSE 'NotPE' END AS format FROM styled GROUP BY file""")
def f12s(spark, sf):
    r = fx(spark, sf, "reads")
    p, m = F.col("pair_id"), F.col("mate")
    styled = (
        F.when(F.col("file") == "f0", F.concat(F.lit("SRR1."), p, F.lit(" HW:fc:"), p % 8, F.lit(":3:4 length=30")))
        .when(F.col("file") == "f1", F.concat(F.lit("HW:7:fc:2:"), p % 9, F.lit(":10:20 "), m, F.lit(":N:0:ACGT")))
        .when(F.col("file") == "f2", F.concat(F.lit("x"), p, F.lit("/"), m))
        .when(F.col("file") == "f3", F.concat(F.lit("x"), p, F.lit("_"), m + 8))
        .otherwise(F.concat(F.lit("x"), p, F.lit("z")))
    )
    return R.paired_names(r.withColumn("id", styled))


@query("W2_length_cutoff", """
WITH b AS (SELECT floor((length(seq) + 449) / 1000.0) * 1000 AS cutoff, count(*) AS n FROM fx_contigs GROUP BY 1),
c AS (SELECT cutoff, sum(cutoff * n) OVER (ORDER BY cutoff DESC) / 20000.0 AS coverage FROM b)
SELECT CAST(cutoff AS BIGINT) AS cutoff, round(coverage, 6) AS coverage FROM c WHERE coverage < 60 ORDER BY cutoff LIMIT 1""")
def w2(spark, sf):
    cut = R.length_cutoff(fx(spark, sf, "contigs"), 20000, 60)
    return cut.withColumn("coverage", F.round("coverage", 6))


@query("F1_md5", "SELECT rid, md5(concat(seq, qual)) AS digest FROM fx_reads")
def f1(spark, sf):
    return fx(spark, sf, "reads").select("rid", F.md5(F.concat("seq", "qual")).alias("digest"))


@query("F2_all_indexes", """
SELECT rid, array_to_string(list_filter(range(1, length(seq)), lambda i: substr(seq, i, 2) = 'AA'), ',') AS hits FROM fx_reads""")
def f2(spark, sf):
    return fx(spark, sf, "reads").select("rid", F.array_join(dna.all_indexes("seq", F.lit("AA")), ",").alias("hits"))


@query("F4_cut_decimals", "SELECT l_orderkey, l_linenumber, l_extendedprice, floor(l_extendedprice / 7 * 100) / 100 AS cut FROM lineitem")
def f4(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return li.select("l_orderkey", "l_linenumber", "l_extendedprice", floor2(F.col("l_extendedprice") / 7).alias("cut"))


@query("F5_reverse_complement", "SELECT rid, reverse(translate(seq, 'ATGC', 'TACG')) AS rc, seq AS twice FROM fx_reads")
def f5(spark, sf):
    rc = dna.reverse_complement("seq")
    return fx(spark, sf, "reads").select("rid", rc.alias("rc"), dna.reverse_complement(rc).alias("twice"))


@query("F8_compact", f"""
SELECT rid, CAST(len(list_filter({_PH}, lambda q: q <> 2)) AS INT) AS kept,
       CAST(list_sum(list_filter({_PH}, lambda q: q > 10)) AS BIGINT) AS high FROM fx_reads""")
def f8(spark, sf):
    r = fx(spark, sf, "reads")
    q = ph.phred("qual")
    gone = F.transform(q, lambda x: F.when(x != 2, x))
    zeroed = F.transform(q, lambda x: F.when(x > 10, x).otherwise(0))
    total = F.aggregate(compact_nonzero(zeroed), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return r.select("rid", F.size(compact(gone)).alias("kept"), F.when(total > 0, total).alias("high"))


@query("F9_combinations", """
WITH t AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS e FROM events GROUP BY user_id),
p AS (SELECT user_id, e, i, j FROM t, range(1, 20) a(i), range(1, 20) b(j) WHERE i <= len(e) AND j <= len(e))
SELECT user_id, 'combination' AS kind, concat(e[i], '+', e[j]) AS pick FROM p WHERE i < j
UNION ALL SELECT user_id, 'permutation', concat(e[i], '+', e[j]) FROM p WHERE i <> j""")
def f9(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    # The set of event types per user is as small as the vocabulary.
    sets = ev.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("e"))

    def rows(kind, arrays):
        return sets.select("user_id", F.lit(kind).alias("kind"), F.explode(arrays).alias("p")).select(
            "user_id", "kind", F.array_join("p", "+").alias("pick"))

    return rows("combination", S.combinations(F.col("e"), 2)).union(rows("permutation", S.permutations(F.col("e"), 2)))


@query("F9_parameter_grid", """
SELECT rid, q, k, length(seq) >= q + k AS fits FROM fx_reads, (VALUES (20), (30)) a(q), (VALUES (10), (25)) b(k)""")
def f9g(spark, sf):
    grid = S.parameter_grid(fx(spark, sf, "reads"), {"q": [20, 30], "k": [10, 25]})
    return grid.select("rid", "q", "k", (F.length("seq") >= F.col("q") + F.col("k")).alias("fits"))


@query("F16_lane_and_suffix", """
SELECT rid, CAST(pair_id % 8 AS INT) AS lane, concat('m:', pair_id % 8, ':x', pair_id) AS stem FROM fx_reads""")
def f16(spark, sf):
    name = F.concat(F.lit("m:"), F.col("pair_id") % 8, F.lit(":x"), "pair_id", F.lit("/"), "mate")
    return fx(spark, sf, "reads").select("rid", names.lane_of(name).alias("lane"), names.strip_mate_suffix(name).alias("stem"))


@query("F18_insert_size_window", """
WITH t AS (SELECT rg, list_sort(list(tlen)) AS s, count(*) AS n FROM fx_alignments WHERE tlen > 0 GROUP BY rg),
q AS (SELECT rg, s[least(n * 25 // 100, n - 1) + 1] AS q25, s[least(n * 50 // 100, n - 1) + 1] AS q50, s[least(n * 75 // 100, n - 1) + 1] AS q75 FROM t)
SELECT rg, greatest(1, q50 - 3 * (q50 - q25)) AS low, q50 + 3 * (q75 - q50) AS high FROM q""")
def f18(spark, sf):
    q = R.fragment_lengths(fx(spark, sf, "alignments"), "rg")
    low, high = S.insert_size_window(F.col("q25"), F.col("q50"), F.col("q75"))
    return q.select("rg", low.alias("low"), high.alias("high"))


def _clean_reads() -> str:
    """Composition trim, then duplicates, then mask, trim and route."""
    steps = _dedup("s1", "s2").replace("FROM fx_reads", "FROM cut").strip().removeprefix("WITH").split("\nSELECT g.rid")[0]

    def mate(m: int) -> str:
        return f"""SELECT 0 AS rid, prs.pair_id, {m} AS mate, '' AS file, CASE WHEN g.n > 1 THEN concat(i{m}, ' combinedReads=', g.n) ELSE i{m} END AS id, s{m} AS seq,
          CASE WHEN g.n > 1 THEN substr(c{m}, 1, length(q{m})) ELSE q{m} END AS qual FROM g JOIN prs USING (rid) JOIN j USING (k1, k2)"""

    return f"""
WITH {_cuts('7.0')},
cut AS (SELECT rid, pair_id, mate, file, id, substr(seq, CAST(s + 1 AS INT), CAST(n - s - e AS INT)) AS seq, substr(qual, CAST(s + 1 AS INT), CAST(n - s - e AS INT)) AS qual FROM fx_reads, cuts),
{steps}, single AS ({mate(1)} UNION ALL {mate(2)}),
{MASKED.replace('FROM fx_reads', 'FROM single')}, {_trim('masked', 'trimmed', '30')}, {_routed('trimmed', '30', '10')}
SELECT pair_id, mate, route, id, seq, {_text()} AS qual FROM routed WHERE route <> 'drop'"""


@query("C1_clean_reads", _clean_reads())
def c1(spark, sf):
    return R.clean_reads(fx(spark, sf, "reads"), bad_slope=7.0, min_length=30).select("pair_id", "mate", "route", "id", "seq", "qual")


@query("C2_prepare_reads", f"""
WITH ds AS (SELECT * FROM fx_reads, (SELECT least(1.0, 250000.0::DOUBLE / sum(length(seq))) AS p FROM fx_reads)
  WHERE CAST('0x' || substr(md5(CAST(pair_id AS VARCHAR)), 1, 7) AS BIGINT) < CAST(floor(p * 268435456.0::DOUBLE) AS BIGINT)),
auto AS (SELECT floor(100.0 * sum(length(seq)) / count(*)) / 100 - 20 AS ml,
                floor(100.0 * sum(list_sum({_PH})) / sum(length(seq))) / 100 - 5 AS mq FROM ds),
{MASKED.replace('FROM fx_reads', 'FROM ds').replace('masked AS', 'masked0 AS')},
masked AS (SELECT * FROM masked0, auto),
{_trim('masked', 'trimmed', 'mq')},
{_routed('(SELECT * FROM trimmed, auto)', 'ml', 'mq')}
SELECT rid, route, seq, {_text()} AS qual FROM routed WHERE route <> 'drop'""")
def c2(spark, sf):
    return R.prepare_reads(fx(spark, sf, "reads"), GENOME, coverage=50).select("rid", "route", "seq", "qual")


@query("C3_filter_long_reads", """
WITH l AS (SELECT name AS id, seq, repeat(chr(CAST(33 + length(seq) % 20 AS INT)), CAST(length(seq) AS INT)) AS qual FROM fx_contigs),
g AS (SELECT * FROM l WHERE length(seq) % 20 >= 10),
b AS (SELECT floor((length(seq) + 449) / 1000.0) * 1000 AS cutoff, count(*) AS n FROM g GROUP BY 1),
c AS (SELECT cutoff, sum(cutoff * n) OVER (ORDER BY cutoff DESC) / 20000.0 AS coverage FROM b)
SELECT id, seq FROM g WHERE length(seq) >= (SELECT min(cutoff) FROM c WHERE coverage < 40)
  AND id NOT IN (SELECT concat('c', doc_id) FROM labels)""")
def c3(spark, sf):
    n = F.length("seq")
    long = fx(spark, sf, "contigs").select(
        F.col("name").alias("id"), "seq", F.repeat(F.char(F.lit(33) + n % 20), n).alias("qual"))
    ids = spark.read.parquet(f"{sf}/labels.parquet").select(F.concat(F.lit("c"), "doc_id").alias("id"))
    return R.filter_long_reads(long, ids, 20000, target=40).select("id", "seq")


@query("entry_clean_and_measure", f"""
WITH {MASKED}, {_trim('masked', 'trimmed', '30')}, {_routed('trimmed', '40', '10')}
SELECT file, floor(100.0 * sum(length(seq)) / count(*)) / 100 AS "avgReadLength", CAST(sum(length(seq)) AS BIGINT) AS "totalBases",
       CAST(min(length(seq)) AS INT) AS "minReadLength", CAST(max(length(seq)) AS INT) AS "maxReadLength",
       floor(100.0 * sum(list_sum(q)) / sum(length(seq))) / 100 AS "avgQuality", count(*) AS "numReads",
       floor(100.0 * sum(length(seq)) / {GENOME}) / 100 AS coverage
FROM routed WHERE route <> 'drop' GROUP BY file""")
def entry(spark, sf):
    return R.read_metrics(R.clean(fx(spark, sf, "reads"), min_length=40), genome_size=GENOME)
