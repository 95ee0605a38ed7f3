"""Queries over the contig view, each with its oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dna
from ..operators import contigs as C
from .fixtures import fx, table
from .registry import query

EXPECTED = 150000


def contigs(spark, sf):
    return fx(spark, sf, "contigs")


@query("P10_filter_contigs", "SELECT file, name FROM fx_contigs WHERE length(seq) >= 500")
def p10(spark, sf):
    return C.filter_contigs(contigs(spark, sf)).select("file", "name")


_COV = """n AS (SELECT file, CASE WHEN length(seq) % 3 = 0 THEN name ELSE concat(name, '_cov_', length(seq) % 50, '.5_x') END AS name, seq, length(seq) % 3 AS r, length(seq) % 50 + 0.5 AS cov FROM fx_contigs)"""


@query("P11_filter_coverage", f"WITH {_COV} SELECT file, name FROM n WHERE length(seq) >= 300 AND (r = 0 OR cov >= 20)")
def p11(spark, sf):
    n = F.length("seq")
    named = contigs(spark, sf).withColumn(
        "name", F.when(n % 3 == 0, F.col("name")).otherwise(F.concat("name", F.lit("_cov_"), n % 50, F.lit(".5_x"))))
    return C.filter_contigs(named, 300, 20).select("file", "name")


@query("P12_is_uncomplex", """
WITH s AS (SELECT name, seq FROM fx_contigs UNION ALL SELECT concat(name, '_twice'), concat(repeat(substr(seq, 1, CAST(length(seq) % 25 + 1 AS INT)), 5), substr(seq, 1, 7)) FROM fx_contigs),
k AS (SELECT name, seq, k, length(seq) // k - CASE WHEN length(seq) % k = 0 AND length(seq) // k > 1 THEN 1 ELSE 0 END AS m FROM s, range(1, 20) t(k))
SELECT name, bool_or(m >= 1 AND substr(seq, 1, CAST(m * k AS INT)) = repeat(substr(seq, 1, CAST(k AS INT)), CAST(m AS INT))) AS uncomplex FROM k GROUP BY name""")
def p12(spark, sf):
    n = F.length("seq")
    made = F.concat(F.repeat(F.substr("seq", F.lit(1), n % 25 + 1), F.lit(5)), F.substring("seq", 1, 7))
    c = contigs(spark, sf).select("name", "seq")
    repeats = c.select(F.concat("name", F.lit("_twice")).alias("name"), made.alias("seq"))
    return c.unionByName(repeats).select("name", dna.is_uncomplex("seq").alias("uncomplex"))


@query("P13_filter_min_reads", """
SELECT name FROM fx_contigs WHERE length(seq) % 5 = 0 OR length(seq) % 100 >= 40""")
def p13(spark, sf):
    n = F.length("seq")
    described = contigs(spark, sf).withColumn(
        "description", F.when(n % 5 == 0, F.lit("no count")).otherwise(F.concat(F.lit("length=9 numreads="), n % 100)))
    return C.filter_min_reads(described, 40, "description").select("name")


@query("P24_mask_lowercase", """
SELECT name, translate(replace(seq, 'GT', 'gt'), 'atcgn', 'NNNNN') AS seq FROM fx_contigs""")
def p24(spark, sf):
    lowered = contigs(spark, sf).withColumn("seq", F.replace("seq", F.lit("GT"), F.lit("gt")))
    return C.mask_lowercase(lowered).select("name", "seq")


_N50 = """
srt AS (SELECT file, length(seq) AS len, sum(length(seq)) OVER (PARTITION BY file ORDER BY length(seq), name ROWS UNBOUNDED PRECEDING) AS upto,
               sum(length(seq)) OVER (PARTITION BY file) AS total FROM big),
n50 AS (SELECT file, coalesce(CAST(min(CASE WHEN upto > {half} THEN len END) AS DOUBLE), 0.01) AS n FROM srt GROUP BY file)"""
_BIG = "big AS (SELECT * FROM fx_contigs WHERE length(seq) >= {m})"


@query("W1_n50", f"WITH {_BIG.format(m=1)}, {_N50.format(half='total / 2.0')} SELECT file, n AS \"N50\" FROM n50")
def w1(spark, sf):
    return C.n50(contigs(spark, sf))


@query("W1_n50_expected", f"WITH {_BIG.format(m=1)}, {_N50.format(half='150000 / 2.0')} SELECT file, n AS \"N50\" FROM n50")
def w1e(spark, sf):
    return C.n50(contigs(spark, sf), genome_length=EXPECTED)


def _kmers(src: str, by: str, last: int = 1) -> str:
    return f"""
km AS (SELECT {by}, substr(seq, CAST(i AS INT), 21) AS k FROM (SELECT *, unnest(range(1, length(seq) - 20 + {last})) AS i FROM {src})),
kc AS (SELECT {by}, k, count(*) AS n FROM km GROUP BY ALL),
kf AS (SELECT {by}, round(count(*) FILTER (WHERE n > 1) / CAST(sum(n) AS DOUBLE), 4) AS kmer21 FROM kc GROUP BY ALL)"""


@query("A5_assembly_metrics", f"""
WITH {_BIG.format(m=500)}, {_N50.format(half='150000 / 2.0')}, {_kmers('big', 'file')},
b AS (SELECT file, sum(length(seq)) AS len, count(*) AS n, max(length(seq)) AS mx, avg(length(seq)) AS av,
             sum(length(regexp_replace(seq, '[^GCgc]', '', 'g'))) AS gc FROM big GROUP BY file)
SELECT b.file, CAST(len AS BIGINT) AS "genomeLength", b.n AS "numContigs", CAST(mx AS INT) AS "longestContig", CAST(floor(av) AS BIGINT) AS "avgContigLength",
       round(gc / CAST(len AS DOUBLE), 3) * 100 AS "GC", n50.n AS "N50", coalesce(kmer21, 0.0) AS kmer21,
       round(ln(n50.n / b.n * CASE WHEN 1 - abs(1 - len / 150000.0::DOUBLE) <= 0 THEN 1 / 9999999999.0::DOUBLE ELSE 1 - abs(1 - len / 150000.0::DOUBLE) END), 3) AS "assemblyScore"
FROM b JOIN n50 USING (file) LEFT JOIN kf USING (file)""")
def a5(spark, sf):
    return C.assembly_metrics(contigs(spark, sf), genome_length=EXPECTED)


@query("A6_assembly_score", f"""
WITH {_BIG.format(m=500)}, {_N50.format(half='total / 2.0')}
SELECT file, round(ln(any_value(n50.n) / count(*)), 3) AS "assemblyScore" FROM big JOIN n50 USING (file) GROUP BY file""")
def a6(spark, sf):
    return C.assembly_metrics(contigs(spark, sf), stats=["assemblyScore"])


@query("A7_kmer_repeat_fraction", f"WITH {_kmers('fx_contigs', 'file')} SELECT file, kmer21 FROM kf")
def a7(spark, sf):
    return C.kmer_repeat_fraction(contigs(spark, sf))


@query("A7_kmer_legacy_last", f"WITH {_kmers('fx_contigs', 'file', 0)} SELECT file, kmer21 FROM kf")
def a7l(spark, sf):
    return C.kmer_repeat_fraction(contigs(spark, sf), legacy_last=True)


@query("A8_contig_details", f"""
WITH {_kmers('fx_contigs', 'file, name')}
SELECT c.file, c.name, CAST(length(seq) AS INT) AS length, round(length(regexp_replace(seq, '[^GCgc]', '', 'g')) / CAST(length(seq) AS DOUBLE), 3) * 100 AS "GC",
       coalesce(kmer21, 0.0) AS kmer21 FROM fx_contigs c LEFT JOIN kf ON kf.file = c.file AND kf.name = c.name""")
def a8(spark, sf):
    return C.contig_details(contigs(spark, sf))


@query("A35_sequence_md5", "SELECT file, name, md5(upper(regexp_replace(seq, '[^A-Za-z]', '', 'g'))) AS md5 FROM fx_contigs")
def a35(spark, sf):
    return C.sequence_md5(contigs(spark, sf))


@query("A35_set_md5", """
WITH d AS (SELECT file, md5(seq) AS m FROM fx_contigs)
SELECT file, concat(""" + ", ".join(
    f"lpad(printf('%x', bit_xor(CAST('0x' || substr(m, {1 + 8 * i}, 8) AS BIGINT))), 8, '0')" for i in range(4)) + """) AS md5 FROM d GROUP BY file""")
def a35s(spark, sf):
    return C.set_md5(contigs(spark, sf))


@query("A36_gc_content", """
SELECT file, round(sum(length(regexp_replace(seq, '[^GCgc]', '', 'g'))) / CAST(sum(length(seq)) AS DOUBLE), 9) AS gc FROM fx_contigs GROUP BY file""")
def a36(spark, sf):
    return C.gc_content(contigs(spark, sf), ["file"]).withColumn("gc", F.round("gc", 9))


@query("A37_has_enough_sequence", """
SELECT CAST(sum(length(seq)) AS BIGINT) AS bases, sum(length(seq)) > 1000000 AS enough FROM fx_contigs WHERE length(seq) >= 500""")
def a37(spark, sf):
    return C.has_enough_sequence(contigs(spark, sf))


_SCORE = f"""
{_BIG.format(m=500)}, {_N50.format(half='total / 2.0')},
sc AS (SELECT file, round(ln(any_value(n50.n) / count(*)), 3) AS score FROM big JOIN n50 USING (file) GROUP BY file)"""


@query("O6_choose_best", f"WITH {_SCORE} SELECT file, score AS \"assemblyScore\" FROM sc ORDER BY score DESC, file LIMIT 1")
def o6(spark, sf):
    return C.choose_best(C.assembly_metrics(contigs(spark, sf), stats=["assemblyScore"]))


@query("O6_rank_assemblies", f"WITH {_SCORE} SELECT file, score AS \"assemblyScore\", row_number() OVER (ORDER BY score DESC, file) AS rank FROM sc")
def o6r(spark, sf):
    return C.rank_assemblies(C.assembly_metrics(contigs(spark, sf), stats=["assemblyScore"]))


@query("A38_best_of_metrics", f"""
WITH {_SCORE}, m AS (SELECT file, count(*) AS n FROM big GROUP BY file)
SELECT file, score AS "assemblyScore", m.n AS "numContigs" FROM sc JOIN m USING (file) WHERE score = (SELECT max(score) FROM sc)""")
def a38(spark, sf):
    m = C.assembly_metrics(contigs(spark, sf), stats=["assemblyScore", "numContigs"])
    return m.filter(F.col("assemblyScore") == m.agg(F.max("assemblyScore")).scalar())


@query("U2_concat_contigs", """
SELECT file, concat(file, '_', name) AS name, length(seq) AS n FROM fx_contigs
UNION ALL SELECT 'extra', concat('extra_', name), length(seq) FROM fx_contigs WHERE length(seq) > 1000""")
def u2(spark, sf):
    c = contigs(spark, sf)
    extra = c.filter(F.length("seq") > 1000).withColumn("file", F.lit("extra"))
    return C.concat_contigs(c, extra).select("file", "name", F.length("seq").cast("bigint").alias("n"))


@query("U4_overlay", """
SELECT name, CASE WHEN l.doc_id IS NULL THEN md5(seq) ELSE concat('label', quality, toxic) END AS body
FROM fx_contigs LEFT JOIN labels l ON name = concat('c', l.doc_id)
UNION ALL SELECT concat('c', doc_id), concat('label', quality, toxic) FROM labels WHERE concat('c', doc_id) NOT IN (SELECT name FROM fx_contigs)""")
def u4(spark, sf):
    base = contigs(spark, sf).select("name", F.md5("seq").alias("body"))
    later = table(spark, sf, "labels").select(
        F.concat(F.lit("c"), "doc_id").alias("name"), F.concat(F.lit("label"), "quality", "toxic").alias("body"))
    return C.overlay(base, later, ["name"])


@query("U5_concatenate_with", """
SELECT file, name, row_number() OVER w AS k,
       CAST(sum(length(seq) + 6) OVER (w ROWS UNBOUNDED PRECEDING) - length(seq) - 6 + 1 AS BIGINT) AS start
FROM fx_contigs WINDOW w AS (PARTITION BY file ORDER BY name, seq)""")
def u5(spark, sf):
    return C.concatenate_with(contigs(spark, sf), "NNNNNN").select("file", "name", "k", "start")


# The whole text of a group, cut anew by position.
_PIECE = 12288


@query("U5_concatenated", f"""
WITH t AS (SELECT file, string_agg(seq, 'NNNNNN' ORDER BY name) AS whole FROM fx_contigs GROUP BY file),
p AS (SELECT file, whole, unnest(range(0, CAST(ceil(length(whole) / {_PIECE}.0) AS BIGINT))) AS piece FROM t)
SELECT file, piece, md5(substr(whole, CAST(piece * {_PIECE} + 1 AS BIGINT), {_PIECE})) AS digest FROM p""")
def u5c(spark, sf):
    return C.concatenated(contigs(spark, sf), "NNNNNN").select("file", "piece", F.md5("seq").alias("digest"))


@query("W8_rename_contigs", """
SELECT file, printf('contig%06d', row_number() OVER (ORDER BY file, name, seq)) AS name, md5(seq) AS digest FROM fx_contigs""")
def w8(spark, sf):
    return C.rename_contigs(contigs(spark, sf)).select("file", "name", F.md5("seq").alias("digest"))


_GAPPED = """g AS (SELECT name, replace(replace(seq, 'GGG', 'NNN'), 'TTT', 'nn') AS seq, reverse(seq) AS qual FROM fx_contigs)"""


@query("W13_split_at_gaps", f"""
WITH {_GAPPED},
b AS (SELECT name, seq, qual, length(seq) - length(regexp_replace(seq, '^[Nn]+', '')) AS lead FROM g),
r AS (SELECT name, substr(seq, CAST(lead + 1 AS INT)) AS s, lead, qual FROM b),
p AS (SELECT name, lead, qual, regexp_split_to_array(s, '[Nn]{{3,}}') AS parts, regexp_extract_all(s, '[Nn]{{3,}}') AS runs FROM r),
e AS (SELECT name, lead, qual, parts, runs, unnest(range(1, len(parts) + 1)) AS i FROM p),
o AS (SELECT name, lead, qual, i, parts[i] AS seq,
             coalesce(list_sum(list_transform(parts[1:i - 1], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(runs[1:i - 1], lambda x: length(x))), 0) AS off FROM e)
SELECT concat(name, '_subcontig', i - 1) AS name, seq, substr(qual, CAST(off + lead + 1 AS INT), CAST(length(seq) AS INT)) AS qual, CAST(off + lead + 1 AS INT) AS start
FROM o WHERE length(seq) > 0""")
def w13(spark, sf):
    gapped = contigs(spark, sf).select(
        "name", F.replace(F.replace("seq", F.lit("GGG"), F.lit("NNN")), F.lit("TTT"), F.lit("nn")).alias("seq"),
        F.reverse("seq").alias("qual"))
    return C.split_at_gaps(gapped, 3, "qual").select("name", "seq", "qual", "start")


@query("P35_tile", """
WITH RECURSIVE c AS (SELECT file, name, length(seq) AS n FROM fx_contigs),
t AS (SELECT file, name, n, 0 AS beg, CASE WHEN n / 700.0 < 1.1 THEN n ELSE 700 END AS fin FROM c
      UNION ALL SELECT file, name, n, fin, CASE WHEN (n - fin) / 700.0 < 1.1 THEN n ELSE fin + 700 END FROM t WHERE fin < n)
SELECT file, name, CAST(beg + 1 AS BIGINT) AS beg, CAST(fin AS BIGINT) AS end FROM t""".replace(" AS end", ' AS "end"'))
def p35(spark, sf):
    return C.tile(contigs(spark, sf), 700)


@query("P36_well_placed", """
SELECT concat('c', l_orderkey) AS contig, count(*) AS mentions FROM lineitem GROUP BY 1 HAVING count(*) < 3""")
def p36(spark, sf):
    mentions = table(spark, sf, "lineitem").select(F.concat(F.lit("c"), "l_orderkey").alias("contig"))
    return C.well_placed(mentions)


@query("J16_subseq", """
WITH r AS (SELECT concat('c', doc_id) AS name, doc_id % 900 + 1 AS beg, doc_id % 900 + 1 + n_chars % 200 AS e FROM documents)
SELECT r.name, r.beg, r.e AS "end", substr(seq, CAST(least(r.beg, length(seq)) AS INT),
   CAST(least(greatest(r.e, least(r.beg, length(seq))), length(seq)) - least(r.beg, length(seq)) + 1 AS INT)) AS seq
FROM r JOIN fx_contigs c ON c.name = r.name""")
def j16(spark, sf):
    d = table(spark, sf, "documents")
    beg = F.col("doc_id") % 900 + 1
    regions = d.select(F.concat(F.lit("c"), "doc_id").alias("name"), beg.alias("beg"), (beg + F.col("n_chars") % 200).alias("end"))
    return C.subseq(contigs(spark, sf), regions)


@query("J10_parse_regions", """
SELECT concat('chr', l_suppkey % 10) AS name, CASE WHEN l_linenumber IN (1, 2) THEN 1 ELSE l_partkey * 1000 + 1000 END AS beg,
       CASE WHEN l_linenumber IN (1, 3) THEN NULL ELSE l_partkey * 1000 + 5000 END AS "end" FROM lineitem""")
def j10p(spark, sf):
    n, chrom = F.col("l_linenumber"), F.concat(F.lit("chr"), F.col("l_suppkey") % 10)
    lo, hi = F.format_number(F.col("l_partkey") * 1000 + 1000, 0), F.format_number(F.col("l_partkey") * 1000 + 5000, 0)
    text = (F.when(n == 1, chrom).when(n == 2, F.concat(chrom, F.lit(":-"), hi)).when(n == 3, F.concat(chrom, F.lit(":"), lo))
            .otherwise(F.concat(chrom, F.lit(":"), lo, F.lit("-"), hi)))
    return C.parse_regions(table(spark, sf, "lineitem").select(text.alias("region"))).select("name", "beg", "end")


@query("J19_build_scaffolds", """
WITH m AS (SELECT doc_id // 3 AS sc, doc_id, quality, toxic, row_number() OVER (PARTITION BY doc_id // 3 ORDER BY doc_id) - 1 AS idx,
                  count(*) OVER (PARTITION BY doc_id // 3) AS n FROM labels WHERE concat('c', doc_id) IN (SELECT name FROM fx_contigs)),
p AS (SELECT sc, idx, concat(CASE WHEN quality = 0 THEN '-' ELSE '+' END, name) AS id,
             concat(CASE WHEN quality = 0 THEN reverse(translate(seq, 'ATGC', 'TACG')) ELSE seq END,
                    CASE WHEN idx < n - 1 THEN repeat('N', CASE WHEN toxic = 1 THEN 20 ELSE 10 END) ELSE '' END) AS txt
      FROM m JOIN fx_contigs ON name = concat('c', doc_id))
SELECT concat('Scaffold', sc, '_', string_agg(id, '_' ORDER BY idx)) AS name, md5(string_agg(txt, '' ORDER BY idx)) AS digest FROM p GROUP BY sc
UNION ALL SELECT name, md5(seq) FROM fx_contigs WHERE name NOT IN (SELECT concat('c', doc_id) FROM labels)""")
def j19(spark, sf):
    c = contigs(spark, sf)
    labels = table(spark, sf, "labels").withColumn("name", F.concat(F.lit("c"), "doc_id")).join(c.select("name"), "name", "left_semi")
    sign = F.when(F.col("quality") == 0, F.lit("-")).otherwise(F.when(F.col("toxic") == 1, F.lit("+")).otherwise(F.lit("")))
    # at most three labelled documents share a scaffold
    text = F.concat(sign, "name", F.lit(":"), F.when(F.col("toxic") == 1, F.lit("20")).otherwise(F.lit("")))
    specs = labels.groupBy(F.floor(F.col("doc_id") / 3).alias("scaffold")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", text.alias("t")))), lambda x: x["t"]), ":").alias("spec"))
    specs = specs.withColumn("spec", F.regexp_replace("spec", ":[0-9]*$", ""))
    return C.build_scaffolds(c, C.parse_scaffold_spec(specs)).select("name", F.md5("seq").alias("digest"))


@query("F3_wrap", """
SELECT name, upper(regexp_replace(concat(substr(lower(seq), 1, 5), ' ', chr(10), seq), '\\s', '', 'g')) AS clean,
       rtrim(regexp_replace(seq, '(.{60})', concat('\\1', chr(10)), 'g'), chr(10)) AS wrapped FROM fx_contigs""")
def f3(spark, sf):
    messy = F.concat(F.substring(F.lower("seq"), 1, 5), F.lit(" \n"), "seq")
    return contigs(spark, sf).select("name", dna.clean_sequence(messy).alias("clean"), dna.wrap("seq", 60).alias("wrapped"))


@query("F4_percent_text", """
SELECT name, printf('%.1f%%', round(length(regexp_replace(seq, '[^GCgc]', '', 'g')) / CAST(length(seq) AS DOUBLE), 3) * 100) AS gc FROM fx_contigs""")
def f4p(spark, sf):
    from ..functions.common import percent_text

    return contigs(spark, sf).select("name", percent_text(dna.gc_count("seq") / F.length("seq")).alias("gc"))


_AA = ("substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', CAST(16 * (instr('TCAG', substr({c}, 1, 1)) - 1) + "
       "4 * (instr('TCAG', substr({c}, 2, 1)) - 1) + instr('TCAG', substr({c}, 3, 1)) AS INT), 1)")


@query("F6_translate_dna", f"""
SELECT name, array_to_string(list_transform(range(1, length(seq) + 1, 3), lambda i:
   CASE WHEN length(substr(seq, CAST(i AS INT), 3)) = 3 AND NOT contains(substr(seq, CAST(i AS INT), 3), 'N')
        THEN {_AA.format(c="substr(seq, CAST(i AS INT), 3)")} ELSE 'X' END), '') AS protein
FROM (SELECT name, replace(seq, 'GGC', 'NGC') AS seq FROM fx_contigs)""")
def f6(spark, sf):
    s = contigs(spark, sf).withColumn("seq", F.replace("seq", F.lit("GGC"), F.lit("NGC")))
    return s.select("name", dna.translate_dna("seq").alias("protein"))


@query("F17_linker", """
SELECT name, concat('ACGTTT', seq, 'ACGTTT') AS linked, regexp_replace(regexp_replace(concat('ACGTTT', seq, 'ACGTTT'), '^(ACGTTT)+', ''), '(ACGTTT)+$', '') AS seq,
       greatest(doc_id % 12 - 6, 1) AS lo, least(doc_id % 12 + 90 - 6, length(regexp_replace(regexp_replace(concat('ACGTTT', seq, 'ACGTTT'), '^(ACGTTT)+', ''), '(ACGTTT)+$', ''))) AS hi
FROM fx_contigs JOIN documents ON name = concat('c', doc_id)""")
def f17(spark, sf):
    linked = C.add_linker(contigs(spark, sf), "ACGTTT")
    d = table(spark, sf, "documents")
    features = d.select(F.concat(F.lit("c"), "doc_id").alias("seqname"), (F.col("doc_id") % 12).alias("lo"),
                        (F.col("doc_id") % 12 + 90).alias("hi"))
    clean, moved = C.remove_linker(linked, features, "ACGTTT")
    return linked.select("name", F.col("seq").alias("linked")).join(clean.select("name", "seq"), "name").join(
        moved.withColumnRenamed("seqname", "name"), "name").select("name", "linked", "seq", "lo", "hi")
