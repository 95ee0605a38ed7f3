"""Queries over the alignment view, each with its oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cigar as cg
from ..operators import alignments as A
from .fixtures import fx, in_order, table
from .registry import query

ALL = ["qname", "flag", "rname", "pos", "mapq", "cigar", "tlen", "rg", "seq", "qual"]
MASK = 1796

# Oracle building blocks: every distinct CIGAR as blocks with offsets.
BLK = """
cg AS (SELECT DISTINCT cigar, regexp_extract_all(cigar, '(\\d+)([MIDNSHP])', 1) AS lens, regexp_extract_all(cigar, '(\\d+)([MIDNSHP])', 2) AS ops FROM fx_alignments),
blk AS (SELECT cigar, i, CAST(lens[i] AS INT) AS len, ops[i] AS op,
  coalesce(list_sum(list_transform(range(1, i), lambda j: CASE WHEN ops[j] IN ('M','D','N') THEN CAST(lens[j] AS INT) ELSE 0 END)), 0) AS ref,
  coalesce(list_sum(list_transform(range(1, i), lambda j: CASE WHEN ops[j] IN ('M','I','S') THEN CAST(lens[j] AS INT) ELSE 0 END)), 0) AS qry,
  ops[i + 1] AS nop, ops[i - 1] AS pop,
  coalesce(CASE ops[i + 1] WHEN 'I' THEN CAST(lens[i + 1] AS INT) WHEN 'D' THEN -CAST(lens[i + 1] AS INT) END, 0) AS nxt
  FROM (SELECT *, unnest(range(1, len(ops) + 1)) AS i FROM cg)),
tot AS (SELECT cigar, CAST(sum(CASE WHEN op IN ('M','D','N') THEN len ELSE 0 END) AS INT) AS span, CAST(sum(CASE WHEN op IN ('M','I') THEN len ELSE 0 END) AS INT) AS mi,
               CAST(sum(CASE WHEN op IN ('M','I','S') THEN len ELSE 0 END) AS INT) AS mis, CAST(sum(CASE WHEN op IN ('M','D') THEN len ELSE 0 END) AS INT) AS md,
               string_agg(repeat(op, CAST(len AS INT)), '' ORDER BY i) AS expanded FROM blk GROUP BY cigar),
pb AS (SELECT cigar, op, ref + j AS ro, CAST(qry + j AS INT) AS qo, j = len - 1 AS last, op = 'M' AND j = 0 AND coalesce(pop, 'S') IN ('N','S','H') AS head, op = 'M' AND j = len - 1 AND coalesce(nop, 'S') IN ('N','S','H') AS tail, nxt, CAST(qry + len AS INT) AS nq
       FROM (SELECT *, unnest(range(0, len)) AS j FROM blk WHERE op IN ('M','D')))"""
QSUM = "list_sum(list_transform(string_split(qual,''), lambda c: ascii(c) - 33))"
QSUMS = f"qs AS (SELECT qual, CAST({QSUM} AS BIGINT) AS q FROM (SELECT DISTINCT qual FROM fx_alignments))"
GROUPS = "groups AS (SELECT 'rg0' AS rg, 'libA' AS library UNION ALL SELECT 'rg1', 'libB' UNION ALL SELECT 'rg2', 'libA')"


def al(spark, sf):
    return fx(spark, sf, "alignments")


def groups(spark, sf):
    """Read groups and libraries of the view, taken from its rows."""
    lib = F.when(F.col("rg") == "rg1", F.lit("libB")).otherwise(F.lit("libA"))
    return al(spark, sf).select("rg").distinct().select("rg", lib.alias("library"))


def with_lib(spark, sf):
    return A.with_library(al(spark, sf), groups(spark, sf))


def dictionary(spark, sf):
    """Reference names with a length beyond the last alignment."""
    return al(spark, sf).groupBy(F.col("rname").alias("name")).agg((F.max("pos") + 200).cast("bigint").alias("length"))


DICT = 'dict AS (SELECT rname AS name, max(pos) + 200 AS length FROM fx_alignments GROUP BY rname)'
DIGEST = "md5(concat(qname, flag, rname, pos, mapq, cigar, tlen, rg, seq, qual))"


def digest():
    return F.md5(F.concat(*ALL)).alias("digest")


@query("P14_view", f"""
WITH {GROUPS} SELECT {DIGEST} AS digest FROM fx_alignments WHERE mapq >= 10 AND flag & 2 = 2 AND flag & 1028 = 0 AND rg IN ('rg0','rg1')
 AND rg IN (SELECT rg FROM groups WHERE library = 'libA')""")
def p14(spark, sf):
    return A.view(al(spark, sf), 10, 2, 1028, ["rg0", "rg1"], "libA", groups(spark, sf)).select(digest())


@query("P15_decode_flag", "SELECT flag, count(*) AS n, concat('0x', printf('%x', flag)) AS hex, concat(" + ", ".join(
    f"CASE WHEN flag & {1 << i} <> 0 THEN '{c}' ELSE '' END" for i, c in enumerate("pPuUrR12sfd")) +
    ") AS letters, flag & 16 = 16 AS reverse FROM fx_alignments GROUP BY flag")
def p15(spark, sf):
    return al(spark, sf).groupBy("flag").agg(F.count("*").alias("n")).select(
        "flag", "n", cg.flag_hex("flag").alias("hex"), cg.flag_letters("flag").alias("letters"),
        cg.flag_struct("flag")["reverse"].alias("reverse"))


@query("P16_tag_values", "SELECT qname, rg AS value FROM fx_alignments WHERE mapq % 2 = 0")
def p16(spark, sf):
    tagged = al(spark, sf).withColumn("tags", F.when(F.col("mapq") % 2 == 0, F.create_map(F.lit("RG"), "rg")).otherwise(
        F.create_map(F.lit("NM"), F.col("mapq").cast("string"))))
    return A.tag_values(tagged, "RG")


@query("P17_to_bed", f"""
WITH {BLK} SELECT rname AS chrom, pos - 1 AS beg, pos + span - 1 AS "end", qname AS name, mapq AS score, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand
FROM fx_alignments JOIN tot USING (cigar) WHERE flag & 4 = 0""")
def p17(spark, sf):
    return A.to_bed(al(spark, sf))


@query("P18_cigar_lengths", f"WITH {BLK} SELECT qname, mi AS aligned, mis AS query FROM fx_alignments JOIN tot USING (cigar)")
def p18(spark, sf):
    return al(spark, sf).select("qname", cg.aligned_length("cigar").alias("aligned"), cg.query_length("cigar").alias("query"))


@query("F10_expand_cigar", f"WITH {BLK} SELECT qname, expanded, CAST(len(lens) AS INT) AS ops FROM fx_alignments JOIN tot USING (cigar) JOIN cg USING (cigar)")
def f10(spark, sf):
    return al(spark, sf).select("qname", cg.expand_cigar("cigar").alias("expanded"), F.size(cg.parse_cigar("cigar")).alias("ops"))


@query("P23_unmapped_reads", f"SELECT {DIGEST} AS digest FROM fx_alignments WHERE flag & 4 <> 0")
def p23(spark, sf):
    return A.stripe(A.unmapped_reads(al(spark, sf)), 4).select(digest())


@query("P22_sam_to_reads", """
WITH k AS (SELECT regexp_replace(qname, '_\\d+$', '') AS pair, CASE WHEN flag & 64 <> 0 THEN 1 ELSE 2 END AS mate,
   CASE WHEN flag & 16 <> 0 THEN reverse(translate(seq, 'ATGC', 'TACG')) ELSE seq END AS seq, CASE WHEN flag & 16 <> 0 THEN reverse(qual) ELSE qual END AS qual
   FROM fx_alignments WHERE flag & 512 = 0),
m AS (SELECT pair, mate, min({'a': seq, 'b': qual}) AS s FROM k GROUP BY pair, mate)
SELECT pair, mate, concat(pair, '/', mate) AS id, s.a AS seq, s.b AS qual FROM m WHERE pair IN (SELECT pair FROM m GROUP BY pair HAVING count(*) = 2)""")
def p22(spark, sf):
    shared = al(spark, sf).withColumn("qname", F.regexp_replace("qname", r"_\d+$", ""))
    return A.sam_to_reads(shared, filtered=False, strict=True)


@query("P22_orphans", """
WITH k AS (SELECT regexp_replace(qname, '_\\d+$', '') AS pair, count(*) FILTER (WHERE flag & 64 <> 0) AS a, count(*) FILTER (WHERE flag & 64 = 0) AS b FROM fx_alignments GROUP BY 1)
SELECT CAST(sum(a + b) AS BIGINT) AS orphans FROM k WHERE a = 0 OR b = 0""")
def p22o(spark, sf):
    return A.orphans(al(spark, sf).withColumn("qname", F.regexp_replace("qname", r"_\d+$", "")), strict=True)


@query("J17_library_join", f"WITH {GROUPS} SELECT library, count(*) AS n FROM fx_alignments JOIN groups USING (rg) GROUP BY library")
def j17(spark, sf):
    return with_lib(spark, sf).groupBy("library").agg(F.count("*").alias("n"))


@query("J7_fix_mates", f"""
WITH {BLK}, n AS (SELECT regexp_replace(qname, '_\\d+$', '') AS name, flag, rname, pos, mapq, seq, qual, rg, cigar, span FROM fx_alignments JOIN tot USING (cigar)),
k AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY rname, pos, flag, mapq, cigar, rg, seq, qual) AS k FROM n),
m AS (SELECT *, CASE WHEN flag & 16 <> 0 THEN pos + span - 1 ELSE pos - 1 END AS five FROM k),
o AS (SELECT *, CASE WHEN k % 2 = 1 THEN lead({'{'}'f': flag, 'r': rname, 'p': pos, 'v': five{'}'}) OVER w ELSE lag({'{'}'f': flag, 'r': rname, 'p': pos, 'v': five{'}'}) OVER w END AS b FROM m WINDOW w AS (PARTITION BY name ORDER BY k)),
p AS (SELECT *, b.f AS oflag, b.r AS orname, b.p AS opos, b.v AS ofive FROM o)
SELECT name AS qname, pos, mapq, CAST(CASE WHEN oflag IS NULL THEN (flag | 8) & ~34
    ELSE CASE WHEN oflag & 4 <> 0 THEN ((flag & ~32 | CASE WHEN oflag & 16 <> 0 THEN 32 ELSE 0 END) | 8) & ~2 ELSE (flag & ~32) | CASE WHEN oflag & 16 <> 0 THEN 32 ELSE 0 END END END AS INT) AS flag,
  coalesce(orname, '*') AS rnext, coalesce(opos, 0) AS pnext, CASE WHEN oflag IS NOT NULL AND rname = orname AND flag & 12 = 0 AND oflag & 12 = 0 THEN ofive - five ELSE 0 END AS tlen FROM p""")
def j7(spark, sf):
    named = al(spark, sf).withColumn("qname", F.regexp_replace("qname", r"_\d+$", ""))
    fixed = A.fix_mates(named, ["rname", "pos", "flag", "mapq", "cigar", "rg", "seq", "qual"])
    return fixed.select("qname", "pos", "mapq", "flag", "rnext", "pnext", "tlen")


_PE = f"""
{GROUPS}, {QSUMS}, m AS (SELECT f.*, library, q, CASE WHEN flag & 12 <> 0 THEN 'free' WHEN tlen > 0 THEN 'head' ELSE 'tail' END AS role
   FROM fx_alignments f JOIN groups USING (rg) JOIN qs USING (qual))"""


@query("A13_rmdup_pe", f"""
WITH {_PE}, r AS (SELECT *, row_number() OVER (PARTITION BY library, rname, pos, tlen ORDER BY q DESC, qname, flag, mapq, cigar, rg, seq, qual) AS rn FROM m WHERE role = 'head'),
keep AS (SELECT rname, qname FROM r WHERE rn = 1), gone AS (SELECT DISTINCT rname, qname FROM r WHERE (rname, qname) NOT IN (SELECT rname, qname FROM keep))
SELECT {DIGEST} AS digest FROM (SELECT * EXCLUDE (rn) FROM r WHERE rn = 1 UNION ALL SELECT * FROM m WHERE role = 'free'
  UNION ALL SELECT m.* FROM m ANTI JOIN gone USING (rname, qname) WHERE role = 'tail')""")
def a13(spark, sf):
    df = with_lib(spark, sf).withColumn("rnext", F.lit("="))
    return A.rmdup_pe(df, ["qname", "flag", "mapq", "cigar", "rg", "seq", "qual"]).select(digest())


@query("A15_duplicate_rates_pe", f"""
WITH {_PE}, k AS (SELECT library, count(*) AS c FROM m WHERE role = 'head' GROUP BY library, rname, pos, tlen)
SELECT library, CAST(sum(c) AS BIGINT) AS checked, CAST(sum(c - 1) AS BIGINT) AS removed, round(sum(c - 1) / CAST(sum(c) AS DOUBLE), 4) AS rate FROM k GROUP BY library""")
def a15(spark, sf):
    return A.duplicate_rates_pe(with_lib(spark, sf).withColumn("rnext", F.lit("=")))


_SE = f"""
{GROUPS}, {BLK}, {QSUMS}, m AS (SELECT f.*, library, q, flag & 16 <> 0 AS back, CASE WHEN flag & 16 <> 0 THEN pos + span - 1 ELSE pos END AS at
   FROM fx_alignments f JOIN groups USING (rg) JOIN tot USING (cigar) JOIN qs USING (qual))"""


@query("A14_rmdup_se", f"""
WITH {_SE.replace(' AS at', ' AS spot')}, r AS (SELECT *, row_number() OVER (PARTITION BY library, rname, back, spot ORDER BY q DESC, qname, flag, pos, mapq, cigar, tlen, rg, seq) AS rn FROM m WHERE flag & 4 = 0)
SELECT {DIGEST} AS digest FROM (SELECT * EXCLUDE (rn) FROM r WHERE rn = 1 UNION ALL SELECT * FROM m WHERE flag & 4 <> 0)""")
def a14(spark, sf):
    return A.rmdup_se(with_lib(spark, sf), ["qname", "flag", "pos", "mapq", "cigar", "tlen", "rg", "seq"], force=True).select(digest())


@query("A15_duplicate_rates_se", f"""
WITH {_SE.replace(' AS at', ' AS spot')}, k AS (SELECT library, count(*) AS c FROM m WHERE flag & 4 = 0 GROUP BY library, rname, back, spot)
SELECT library, CAST(sum(c) AS BIGINT) AS checked, CAST(sum(c - 1) AS BIGINT) AS removed, round(sum(c - 1) / CAST(sum(c) AS DOUBLE), 4) AS rate FROM k GROUP BY library""")
def a15s(spark, sf):
    return A.duplicate_rates_se(with_lib(spark, sf), force=True)


_FS = """s AS (SELECT *, concat('chr', pos % 10) AS rnext FROM fx_alignments),
c AS (SELECT count(*) AS total, count(*) FILTER (WHERE flag & 512 <> 0) AS qc_failure, count(*) FILTER (WHERE flag & 1024 <> 0) AS duplicates, count(*) FILTER (WHERE flag & 4 = 0) AS mapped,
 count(*) FILTER (WHERE flag & 1 <> 0) AS paired, count(*) FILTER (WHERE flag & 65 = 65) AS read1, count(*) FILTER (WHERE flag & 129 = 129) AS read2,
 count(*) FILTER (WHERE flag & 3 = 3) AS properly_paired, count(*) FILTER (WHERE flag & 13 = 1) AS both_mapped, count(*) FILTER (WHERE flag & 13 = 9) AS singletons,
 count(*) FILTER (WHERE flag & 13 = 1 AND rnext <> rname) AS mate_elsewhere, count(*) FILTER (WHERE flag & 13 = 1 AND rnext <> rname AND mapq >= 5) AS mate_elsewhere_q5 FROM s)"""


@query("A16_flagstat", f"""
WITH {_FS} SELECT *, round(mapped * 100.0::DOUBLE / total, 2) AS mapped_percent, round(properly_paired * 100.0::DOUBLE / paired, 2) AS proper_percent, round(singletons * 100.0::DOUBLE / paired, 2) AS singleton_percent FROM c""")
def a16(spark, sf):
    return A.flagstat(al(spark, sf).withColumn("rnext", F.concat(F.lit("chr"), F.col("pos") % 10)))


@query("A17_idxstats", f"""
WITH {DICT} SELECT name AS rname, length, count(*) FILTER (WHERE flag & 4 = 0) AS mapped, count(*) FILTER (WHERE flag & 4 <> 0) AS unmapped
FROM dict JOIN fx_alignments ON rname = name GROUP BY name, length UNION ALL SELECT '*', 0, 0, 0 UNION ALL SELECT 'chrX', 5000, 0, 0""")
def a17(spark, sf):
    d = dictionary(spark, sf)
    empty = d.agg(F.lit("chrX").alias("name"), F.lit(5000).cast("bigint").alias("length"), F.count("*").alias("_")).drop("_")
    return A.idxstats(al(spark, sf), d.unionByName(empty))


_DEPTH = f"""{BLK}, d AS (SELECT rname, CAST(pos + ro AS BIGINT) AS pos, count(*) AS depth FROM fx_alignments JOIN pb USING (cigar) WHERE flag & {MASK} = 0 GROUP BY 1, 2)"""


@query("A18_depth", f"WITH {_DEPTH} SELECT rname, pos, depth FROM d")
def a18(spark, sf):
    return A.depth(al(spark, sf))


@query("A18_depth_regions", f"""
WITH {_DEPTH}, r AS (SELECT concat('chr', s_suppkey % 10) AS name, s_suppkey * 20 AS beg, s_suppkey * 20 + 9 AS fin FROM supplier)
SELECT rname, pos, depth FROM d JOIN r ON name = rname AND pos BETWEEN beg AND fin""")
def a18r(spark, sf):
    r = table(spark, sf, "supplier").select(F.concat(F.lit("chr"), F.col("s_suppkey") % 10).alias("name"),
                                            (F.col("s_suppkey") * 20).alias("beg"), (F.col("s_suppkey") * 20 + 9).alias("end"))
    return A.depth(al(spark, sf), regions=r)


@query("A19_depth_bounds", f"""
WITH {_DEPTH} SELECT CAST(floor(greatest(avg(depth) - 3 * stddev_samp(depth), 5)) AS BIGINT) AS min_depth, CAST(ceil(avg(depth) + 3 * stddev_samp(depth)) AS BIGINT) AS max_depth FROM d""")
def a19(spark, sf):
    return A.depth_bounds(al(spark, sf))


@query("W9_fragment_coverage", f"""
WITH {BLK}, {DICT}, e AS (SELECT rname, pos AS p, 1 AS d FROM fx_alignments WHERE NOT (flag & 3 = 3 AND flag & 16 <> 0)
  UNION ALL SELECT rname, pos + md, -1 FROM fx_alignments JOIN tot USING (cigar) WHERE (flag & 3 = 3 AND flag & 16 <> 0) OR flag & 3 <> 3),
x AS (SELECT rname, p, sum(d) AS d FROM e GROUP BY 1, 2),
g AS (SELECT name AS rname, unnest(range(1, length + 1)) AS pos FROM dict)
SELECT g.rname, g.pos, CAST(sum(coalesce(d, 0)) OVER (PARTITION BY g.rname ORDER BY g.pos) AS BIGINT) AS open FROM g LEFT JOIN x ON x.rname = g.rname AND x.p = g.pos""")
def w9(spark, sf):
    return A.fragment_coverage(al(spark, sf), dictionary(spark, sf))


_REGIONS = "r AS (SELECT concat('chr', s_suppkey % 10) AS name, s_suppkey * 15 + 1 AS beg, s_suppkey * 15 + 1 + s_suppkey % 40 AS fin FROM supplier)"


def regions(spark, sf):
    s = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(F.concat(F.lit("chr"), s % 10).alias("name"), (s * 15 + 1).alias("beg"),
                                               (s * 15 + 1 + s % 40).alias("end"))


@query("J10_overlap", f"""
WITH {BLK}, {_REGIONS} SELECT qname, pos, pos + span - 1 AS "end", beg AS r_beg, fin AS r_end FROM fx_alignments f JOIN tot USING (cigar) JOIN r ON rname = name AND pos <= fin AND pos + span - 1 >= beg""")
def j10(spark, sf):
    a = al(spark, sf).withColumn("end", A.alignment_end())
    return A.overlap(a, regions(spark, sf), ("rname", "pos", "end")).select("qname", "pos", "end", "r_beg", "r_end")


@query("J11_intersect_length", f"""
WITH {BLK}, {_REGIONS} SELECT beg AS r_beg, count(*) AS n, CAST(sum(least(fin, pos + span - 1) - greatest(beg, pos) + 1) AS BIGINT) AS shared
FROM fx_alignments f JOIN tot USING (cigar) JOIN r ON rname = name AND pos <= fin AND pos + span - 1 >= beg GROUP BY beg""")
def j11(spark, sf):
    a = al(spark, sf).withColumn("end", A.alignment_end())
    return A.shared_bases(a, regions(spark, sf), ("rname", "pos", "end")).groupBy("r_beg").agg(
        F.count("*").alias("n"), F.sum("shared").alias("shared"))


@query("J13_compare_alignments", """
WITH a AS (SELECT qname, max({'p': pos, 'm': mapq, 'f': flag, 'r': rname}) AS s FROM fx_alignments GROUP BY qname),
b AS (SELECT qname, max({'p': pos + mapq * 3, 'm': (mapq * 7) % 50, 'f': flag, 'r': rname}) AS s FROM fx_alignments WHERE tlen > 100 OR tlen < -300 GROUP BY qname),
j AS (SELECT a.s AS a, b.s AS b FROM a FULL JOIN b USING (qname)),
k AS (SELECT a, b, coalesce(a.f & 16 = b.f & 16 AND a.r = b.r AND abs(a.p - b.p) < 100, false) AS same, a.m >= 10 AS ha, b.m >= 10 AS hb FROM j)
SELECT count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL AND same AND ha AND hb) AS consistent_hh,
 count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL AND same AND ha AND NOT hb) AS consistent_hl,
 count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL AND same AND NOT ha AND hb) AS consistent_lh,
 count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL AND NOT same AND ha AND hb) AS inconsistent_hh,
 count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL AND NOT same AND ha AND NOT hb) AS inconsistent_hl,
 count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL AND NOT same AND NOT ha AND hb) AS inconsistent_lh,
 count(*) FILTER (WHERE b IS NULL AND ha) AS second_missing_high, count(*) FILTER (WHERE b IS NULL AND NOT ha) AS second_missing_low,
 count(*) FILTER (WHERE a IS NULL AND hb) AS first_missing_high, count(*) FILTER (WHERE a IS NULL AND NOT hb) AS first_missing_low FROM k""")
def j13(spark, sf):
    a = al(spark, sf)
    b = a.filter("tlen > 100 OR tlen < -300").withColumns(
        {"pos": F.col("pos") + F.col("mapq") * 3, "mapq": (F.col("mapq") * 7) % 50})
    return A.compare_alignments(a, b, ["pos", "mapq", "flag", "rname"])


@query("W10_unique_alignments", f"""
WITH {BLK}, sc AS (SELECT cigar, greatest(sum(CASE WHEN op = 'M' THEN len ELSE 0 END) - 5 * count(*) FILTER (WHERE op IN ('I','D')) - 2 * sum(CASE WHEN op IN ('I','D') THEN len ELSE 0 END), 1) AS s FROM blk GROUP BY cigar),
n AS (SELECT regexp_replace(qname, '_\\d+$', '') AS name, pos, rname, flag, mapq, cigar, s FROM fx_alignments JOIN sc USING (cigar)),
k AS (SELECT *, row_number() OVER w AS rn, coalesce(lead(s) OVER w, 0) AS s2 FROM n WINDOW w AS (PARTITION BY name ORDER BY s DESC, rname, pos, flag, mapq, cigar))
SELECT name AS qname, rname, pos, flag, cigar, CAST(least(floor(250.0::DOUBLE * (s - s2) / s + 0.499), 250) AS INT) AS mapq FROM k WHERE rn = 1""")
def w10(spark, sf):
    named = al(spark, sf).withColumn("qname", F.regexp_replace("qname", r"_\d+$", ""))
    return A.unique_alignments(named, ["rname", "pos", "flag", "mapq", "cigar"]).select("qname", "rname", "pos", "flag", "cigar", "mapq")


@query("O1_sort_by_coordinate", f"SELECT {DIGEST} AS digest FROM fx_alignments")
def o1(spark, sf):
    d = dictionary(spark, sf).withColumn("idx", F.regexp_extract("name", r"(\d+)", 1).cast("int"))
    return A.sort_by_coordinate(al(spark, sf), d).select(digest())


@query("O2_natural_key", """
WITH p AS (SELECT qname, split_part(substr(qname, 2), '_', 1) AS a, split_part(qname, '_', 2) AS b FROM fx_alignments)
SELECT qname, concat('q', lpad(CAST(length(a) AS VARCHAR), 10, '0'), a, '_', lpad(CAST(length(b) AS VARCHAR), 10, '0'), b) AS k FROM p""")
def o2(spark, sf):
    from ..functions.names import natural_key

    return A.sort_natural(al(spark, sf).select("qname")).select("qname", natural_key("qname").alias("k"))


def indexed(spark, sf):
    return dictionary(spark, sf).withColumn("idx", F.regexp_extract("name", r"(\d+)", 1).cast("int"))


_SORTED = "row_number() OVER (ORDER BY CAST(regexp_extract(rname, '\\d+') AS INT), pos, flag & 16) AS place, rname, pos, flag & 16 > 0 AS back"


def place_of_coordinates(df):
    return in_order(df.select("rname", "pos", (F.col("flag").bitwiseAND(16) > 0).alias("back")))


@query("O1_order", f"SELECT {_SORTED} FROM fx_alignments")
def o1o(spark, sf):
    return place_of_coordinates(A.sort_by_coordinate(al(spark, sf), indexed(spark, sf)))


@query("O2_order", """
WITH p AS (SELECT qname, split_part(substr(qname, 2), '_', 1) AS a, split_part(qname, '_', 2) AS b FROM fx_alignments)
SELECT row_number() OVER (ORDER BY CAST(a AS BIGINT), CAST(b AS BIGINT)) AS place, qname FROM p""")
def o2o(spark, sf):
    return in_order(A.sort_natural(al(spark, sf).select("qname")))


@query("U1_merge_sorted", f"SELECT {_SORTED} FROM fx_alignments")
def u1s(spark, sf):
    a, d = al(spark, sf), indexed(spark, sf)
    return place_of_coordinates(A.merge_alignments(a.filter("rg = 'rg0'"), a.filter("rg <> 'rg0'"), groups=["a", "b"], dictionaries=[d, d]))


@query("U1_merge_alignments", """
SELECT rg, count(*) AS n, CAST(sum(pos) AS BIGINT) AS s FROM (SELECT 'a' AS rg, pos FROM fx_alignments WHERE rg = 'rg0' UNION ALL SELECT 'b', pos FROM fx_alignments WHERE rg <> 'rg0') GROUP BY rg""")
def u1(spark, sf):
    a = al(spark, sf)
    merged = A.merge_alignments(a.filter("rg = 'rg0'"), a.filter("rg <> 'rg0'"), groups=["a", "b"])
    return merged.groupBy("rg").agg(F.count("*").alias("n"), F.sum("pos").alias("s"))


@query("U6_merge_dictionaries", """
WITH l AS (SELECT DISTINCT rname AS k, 'SN' AS tag, rname AS v FROM fx_alignments UNION SELECT DISTINCT rname, 'LN', CASE WHEN rname = 'chr3' THEN CAST(mapq % 2 AS VARCHAR) ELSE '5000' END FROM fx_alignments),
p AS (SELECT k, tag, min(v) AS v, count(*) AS n FROM l GROUP BY k, tag)
SELECT k AS key, string_agg(concat(tag, ':', v), ' ' ORDER BY tag) AS line, bool_or(n > 1) AS conflict FROM p GROUP BY k""")
def u6(spark, sf):
    a = al(spark, sf)
    length = F.when(F.col("rname") == "chr3", (F.col("mapq") % 2).cast("string")).otherwise(F.lit("5000"))
    lines = a.select(F.lit("SQ").alias("kind"), F.col("rname").alias("key"), F.create_map(F.lit("SN"), "rname", F.lit("LN"), length).alias("tags"))
    merged = A.merge_dictionaries(lines)
    text = F.array_join(F.transform(F.array_sort(F.map_entries("tags")), lambda e: F.concat(e["key"], F.lit(":"), e["value"])), " ")
    return merged.select("key", text.alias("line"), "conflict")


@query("U7_tables_differ", """
WITH a AS (SELECT qname, pos FROM fx_alignments), b AS (SELECT qname, CASE WHEN mapq = 7 THEN pos + 1 ELSE pos END AS pos FROM fx_alignments)
SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_first, (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_second""")
def u7(spark, sf):
    a = al(spark, sf)
    b = a.withColumn("pos", F.when(F.col("mapq") == 7, F.col("pos") + 1).otherwise(F.col("pos")))
    return A.difference_counts(a.select("qname", "pos"), b.select("qname", "pos"))


REFS = "refs AS (SELECT replace(name, 'c', 'chr') AS name, seq AS ref FROM fx_contigs)"


def references(spark, sf):
    """Contigs under the names that the alignments use."""
    return fx(spark, sf, "contigs").select(F.replace("name", F.lit("c"), F.lit("chr")).alias("name"), "seq")


@query("F11_calc_md", f"""
WITH {BLK}, {REFS}, {GROUPS},
d AS (SELECT DISTINCT rname, pos, cigar, seq FROM fx_alignments),
w AS (SELECT d.*, coalesce(substr(ref, CAST(pos AS INT), CAST(span AS INT)), '') AS under FROM d JOIN tot USING (cigar) LEFT JOIN refs ON name = rname),
c AS (SELECT rname, pos, cigar, seq, under, row_number() OVER (PARTITION BY rname, pos, cigar, seq ORDER BY i, j) AS k, op,
             CASE WHEN op = 'D' THEN '' ELSE substr(seq, CAST(qry + j + 1 AS INT), 1) END AS q, CASE WHEN op IN ('M','D') THEN substr(under, CAST(ref + j + 1 AS INT), 1) ELSE '' END AS r
      FROM (SELECT *, unnest(range(0, len)) AS j FROM w JOIN blk USING (cigar) WHERE op IN ('M','D','I','S'))),
cut AS (SELECT rname, pos, cigar, seq, coalesce(min(CASE WHEN op IN ('M','D') AND r = '' THEN k END), 100000) AS stop FROM c GROUP BY ALL),
u AS (SELECT c.*, k < stop AS live, op = 'M' AND q = r AND k < stop AS hit FROM c JOIN cut USING (rname, pos, cigar, seq)),
g AS (SELECT *, sum(CASE WHEN live AND op IN ('M','D') AND NOT hit THEN 1 ELSE 0 END) OVER (PARTITION BY rname, pos, cigar, seq ORDER BY k) AS seg,
             lag(op) OVER (PARTITION BY rname, pos, cigar, seq ORDER BY k) AS prev FROM u),
h AS (SELECT rname, pos, cigar, seq, seg, count(*) FILTER (WHERE hit) AS run,
             max(CASE WHEN live AND op IN ('M','D') AND NOT hit THEN CASE WHEN op = 'D' THEN CASE WHEN prev = 'D' THEN concat('d', r) ELSE concat('^', r) END ELSE r END END) AS mark FROM g GROUP BY ALL),
t AS (SELECT *, lag(run) OVER (PARTITION BY rname, pos, cigar, seq ORDER BY seg) AS before FROM h),
md AS (SELECT rname, pos, cigar, seq, concat(string_agg(CASE WHEN mark IS NULL THEN '' WHEN mark[1] = 'd' THEN mark[2:] ELSE concat(coalesce(before, 0), mark) END, '' ORDER BY seg), max_by(run, seg)) AS md FROM t GROUP BY ALL),
nm AS (SELECT rname, pos, cigar, seq, CAST(count(*) FILTER (WHERE live AND (op = 'I' OR (op IN ('M','D') AND NOT hit))) AS INT) AS nm, string_agg(CASE WHEN hit THEN '=' ELSE q END, '' ORDER BY k) AS masked FROM g GROUP BY ALL)
SELECT f.qname, f.pos, f.cigar, md.md, nm.nm, nm.masked FROM fx_alignments f JOIN md USING (rname, pos, cigar, seq) JOIN nm USING (rname, pos, cigar, seq)""")
def f11(spark, sf):
    return A.calc_md(al(spark, sf), references(spark, sf)).select("qname", "pos", "cigar", "md", "nm", "masked")


@query("A34_alignment_accuracy", f"""
WITH {BLK}, t AS (SELECT CASE WHEN mapq % 11 = 0 THEN 'chrZ' ELSE rname END AS tchr, pos + (mapq * 3) % 13 AS tl, pos + span - 1 + (mapq * 5) % 17 AS tr, f.*, span,
   CASE cigar WHEN '5S27M' THEN 5 ELSE 0 END AS hs, CASE cigar WHEN '30M2S' THEN 2 ELSE 0 END AS ts FROM fx_alignments f JOIN tot USING (cigar) WHERE flag & 4 = 0),
c AS (SELECT mapq // 10 AS tens, count(*) FILTER (WHERE tchr <> rname OR CASE WHEN flag & 16 <> 0 THEN abs(tr - (pos + span - 1 + ts)) > 5 AND abs(tr - (pos + span - 1 + hs)) > 5
   ELSE abs(tl - (pos - hs)) > 5 AND abs(tl - (pos - ts)) > 5 END) AS wrong, count(*) AS total FROM t GROUP BY 1)
SELECT CAST(tens AS BIGINT) AS tens, wrong, total, CAST(sum(total) OVER (ORDER BY tens DESC) AS BIGINT) AS cum_total, round(sum(wrong) OVER (ORDER BY tens DESC) / CAST(sum(total) OVER (ORDER BY tens DESC) AS DOUBLE), 9) AS cum_error FROM c""")
def a34(spark, sf):
    a = al(spark, sf).withColumn("_e", A.alignment_end())
    chrom = F.when(F.col("mapq") % 11 == 0, F.lit("chrZ")).otherwise(F.col("rname"))
    named = a.withColumn("qname", F.concat_ws("_", chrom, F.col("pos") + (F.col("mapq") * 3) % 13, F.col("_e") + (F.col("mapq") * 5) % 17, F.lit("x")))
    return A.alignment_accuracy(named).withColumn("cum_error", F.round("cum_error", 9))
