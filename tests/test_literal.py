"""Hand-worked answers and properties on tiny inputs."""

import random

from pyspark.sql import functions as F

from strandframe.functions import cigar as cg
from strandframe.functions import dna, names, phred as ph
from strandframe.operators import alignments as A
from strandframe.operators import contigs as C
from strandframe.operators import genes as G
from strandframe.operators import pileup as P
from strandframe.operators import reads as R
from strandframe.operators import scale as S
from strandframe.operators import stats as ST
from strandframe.operators import variants as V
from strandframe.sources import reads as SR


def q(values):
    return "".join(chr(v + 33) for v in values)


def reads(spark, rows):
    return spark.createDataFrame(
        [(i, i // 2, i % 2 + 1, "f", f"r{i // 2}/{i % 2 + 1}", s, t) for i, (s, t) in enumerate(rows)],
        "rid bigint, pair_id bigint, mate int, file string, id string, seq string, qual string")


def one(df):
    return df.first()


def test_trim_first_good_base(spark):
    cases = [
        ([40] * 30, (0, 0)), ([2] + [40] * 29, (1, 0)), ([40] * 29 + [2], (0, 1)), ([2] * 3 + [40] * 25 + [2] * 2, (3, 2)),
        ([2] * 25 + [40] * 10, (20, 0)), ([2] * 10, (10, 10)),
    ]
    got = R.trim_counts(reads(spark, [("A" * len(v), q(v)) for v, _ in cases])).orderBy("rid").collect()
    assert [(r.n5, r.n3) for r in got] == [e for _, e in cases]
    kept = R.trim_ends(reads(spark, [("ACGT" * 5, q([2] * 2 + [40] * 17 + [2]))]))
    assert one(kept).seq == ("ACGT" * 5)[2:19]
    assert one(R.trim_ends(reads(spark, [("A" * 10, q([2] * 10))]))).seq == ""


def test_trim_on_average(spark):
    late = [10, 10, 40, 40, 40, 40, 40, 40] + [40] * 20  # prefixes recover at index 4, before the patience ends
    early = [40] * 3 + [0] * 20
    def count(v):
        n5 = bad = 0
        for i in range(20):
            if sum(v[: i + 1]) / (i + 1) < 30:
                bad += 1
            elif i > 5:
                break
        return bad
    got = R.trim_counts(reads(spark, [("A" * len(v), q(v)) for v in (late, early)]), 30, 20, mode="average").orderBy("rid").collect()
    assert [r.n5 for r in got] == [count(late), count(early)]


def test_mask_and_route(spark):
    df = R.mask_ambiguous(reads(spark, [("A.nG", "IIII"), ("ACGT", "IIII")]))
    assert [tuple(r) for r in df.orderBy("rid").select("seq", "qual").collect()] == [("ANNG", "I!!I"), ("ACGT", "IIII")]
    routed = R.route_pairs(reads(spark, [("A" * 70, "I" * 70), ("A" * 10, "I" * 10), ("A" * 70, "I" * 70), ("A" * 70, "I" * 70)]), R.read_is_good())
    assert [r.route for r in routed.orderBy("rid").collect()] == ["singleton", "drop", "pair", "pair"]


def test_dedup(spark):
    rows = [("ACGT", q([10, 20, 30, 2])), ("TTTT", q([1] * 4))] * 2 + [("ACGT", q([15, 15, 15, 3])), ("TTTT", q([1] * 4))] + [("ACGT", q([9] * 4)), ("GGGG", q([9] * 4))]
    df = reads(spark, rows)
    pairs = R.dedup_pairs(R.pair_up(df)).orderBy("rid").collect()
    assert len(pairs) == 2 and pairs[0].n == 3
    assert pairs[0].qual1 == q([35, 40, 40, 7]) and pairs[0].qual2 == q([3] * 4)
    assert pairs[0].id1 == "r0/1 combinedReads=3" and pairs[1].id1 == "r3/1"
    again = R.dedup_reads(R.dedup_reads(df))
    assert again.count() == 4


def test_interleave_round_trip(spark):
    df = reads(spark, [("A" * (i + 1), "I" * (i + 1)) for i in range(10)])
    back = R.interleave(*R.deinterleave(df))
    assert back.select("rid", "id", "seq").exceptAll(df.select("rid", "id", "seq")).isEmpty() and back.count() == 10


def test_n50(spark):
    c = spark.createDataFrame([("f", f"c{i}", "A" * i) for i in range(1, 6)], "file string, name string, seq string")
    assert one(C.n50(c)).N50 == 4.0  # 1+2+3 = 6 <= 7.5 < 10
    assert one(C.n50(c, genome_length=4)).N50 == 2.0
    assert one(C.n50(c, genome_length=1000)).N50 == 0.01


def test_kmers_with_other_letters(spark):
    c = spark.createDataFrame([("f", "a", "ACGTNACGT"), ("f", "b", "ACGT")], "file string, name string, seq string")
    got = {(r.code, r.text): r.n for r in C.kmer_counts(c, ["file"], 4).collect()}
    assert sum(got.values()) == 7 and max(got.values()) == 3
    assert {t for _, t in got if t} == {"CGTN", "GTNA", "TNAC", "NACG"}


def orf_sequence():
    return "TAA" + "ATG" + "GCA" * 30 + "TAG" + "CC"


def test_orfs(spark):
    fwd = orf_sequence()
    rev = one(spark.createDataFrame([(fwd,)], "s string").select(dna.reverse_complement("s").alias("r"))).r
    c = spark.createDataFrame([("f", fwd), ("r", rev), ("t", "CC" + "ATG" + "GCA" * 40), ("s", "TAA" + "ATG" + "GCA" * 5 + "TAG")], "name string, seq string")
    got = {(r.name, r.frame): (r.ustop, r.start, r.stop, r.length) for r in G.find_orfs(c).collect()}
    assert got[("f", "0")] == (4, 4, 99, 96)
    n = len(rev)
    strand = [v for (name, frame), v in got.items() if name == "r" and frame.endswith("R")]
    assert (n - 3, n - 3, n - 98, 96) in strand
    assert not [k for k in got if k[0] == "s"]
    cut = [r for r in G.find_orfs(c, truncated=True).collect() if r.name == "t" and r.strand == "+" and r.frame == "2"]
    assert cut and cut[0].truncated_downstream and cut[0].truncated_upstream


def test_translate(spark):
    got = one(spark.createDataFrame([("TAATAGTGAATGNNNAANAC",)], "s string").select(dna.translate_dna("s").alias("p"))).p
    assert got == "***MXXX"


def test_reverse_complement_twice(spark):
    df = spark.createDataFrame([("ACGTNacgtn",)], "s string")
    assert one(df.select(dna.reverse_complement(dna.reverse_complement("s")).alias("x"))).x == "ACGTNacgtn"


TOY_REF = "AGCATGTTAGATAAGATAGCTGTGCTAGTAGGCAGTCAGCGCCAT"
TOY = [
    ("r001", 163, 7, 30, "8M4I4M1D3M", "TTAGATAAAGAGGATACTG"),
    ("r002", 0, 9, 30, "1S2I6M1P1I1P1I4M2I", "AAAAGATAAGGGATAAA"),
    ("r003", 0, 9, 30, "5H6M", "AGCTAA"),
    ("r004", 0, 16, 30, "6M14N1I5M", "ATAGCTCTCAGC"),
    ("r003", 16, 29, 30, "6H5M", "TAGGC"),
    ("r001", 83, 37, 30, "9M", "CAGCGCCAT"),
]


def toy(spark):
    return spark.createDataFrame(
        [(n, f, "ref", p, m, c, s, "I" * len(s)) for n, f, p, m, c, s in TOY],
        "qname string, flag int, rname string, pos bigint, mapq int, cigar string, seq string, qual string")


def toy_ref(spark):
    return spark.createDataFrame([("ref", TOY_REF)], "name string, seq string")


def test_md_of_toy_alignments(spark):
    got = {(r.qname, r.pos): (r.md, r.nm) for r in A.calc_md(toy(spark), toy_ref(spark)).collect()}

    def expect(pos, cigar, seq):
        import re

        x, y, u, nm, md = pos - 1, 0, 0, 0, ""
        for n, op in re.findall(r"(\d+)([MIDNSHP])", cigar):
            n = int(n)
            if op == "M":
                for j in range(n):
                    if seq[y + j] == TOY_REF[x + j]:
                        u += 1
                    else:
                        md, u, nm = f"{md}{u}{TOY_REF[x + j]}", 0, nm + 1
                x, y = x + n, y + n
            elif op == "D":
                md, u, x, nm = f"{md}{u}^{TOY_REF[x:x + n]}", 0, x + n, nm + n
            elif op in "IS":
                y, nm = y + n, nm + (n if op == "I" else 0)
            elif op == "N":
                x += n
        return f"{md}{u}", nm

    for n, f, p, m, c, s in TOY:
        assert got[(n, p)] == expect(p, c, s)


def test_pileup_of_toy_alignments(spark):
    lines = {r.pos: r for r in P.pileup(toy(spark), ["qname", "flag"], toy_ref(spark)).collect()}
    assert lines[7].bases.startswith("^") and lines[7].ref == "T" and lines[7].depth == 1
    assert lines[14].bases.count("+") == 2  # both reads insert after 14
    assert sum(r.depth for r in lines.values()) == sum(
        one(spark.createDataFrame([(c,)], "c string").select(cg.op_total("c", "MD").alias("n"))).n for *_, c, _ in TOY)
    split = P.pileup(toy(spark), ["qname", "flag"], toy_ref(spark), part_size=1)
    assert split.groupBy("pos").agg(F.sum("depth").alias("d")).filter("pos = 9").first().d == lines[9].depth
    assert split.filter("pos = 9").count() == lines[9].depth


def test_depth_matches_bases(spark):
    d = A.depth(toy(spark))
    assert d.agg(F.sum("depth")).first()[0] == P.read_bases(toy(spark)).count()


def test_reconcile(spark):
    rows = [
        ("c", "+", 99, 10, "Glimmer3"), ("c", "+", 99, 22, "gmhmmp"), ("c", "+", 99, 4, "BLAST"), ("c", "-", 5, 80, "Glimmer3"), ("c", "-", 5, 71, "Prodigal"),
        ("c", "+", 300, 200, "Prodigal"), ("c", "-", 400, 500, "BLAST"), ("c", "-", 400, 520, "BLAST"),
    ]
    p = spark.createDataFrame(rows, "seqname string, strand string, stop bigint, start bigint, predictor string")
    genes, minority = G.reconcile_predictions(p, 2)
    assert {(r.strand, r.stop): (r.start, r.lo, r.hi, r.contributors) for r in genes.collect()} == {("+", 99): (22, 22, 99, 3), ("-", 5): (71, 5, 71, 2)}
    assert sorted(r.stop for r in minority.collect()) == [300, 400, 400]


def variants(spark, rows):
    return spark.createDataFrame([("c", p, r, a, float(qu), f"DP=20;MQ={m}", "1/1") for p, r, a, qu, m in rows],
                                 "chrom string, pos bigint, ref string, alt string, qual double, info string, gt string")


ORDER = ["ref", "alt", "qual", "info"]


def test_variant_filter_trace(spark):
    rows = [
        (100, "A", "G", 50, 60),      # next to the indel at 102
        (102, "ACC", "A", 40, 60),    # beaten by the better indel at 110
        (110, "A", "ATT", 90, 60),
        (200, "AC", "GT", 20, 60), (201, "C", "T", 80, 60),  # overlap: the better one stays
        (300, "A", "C", 50, 5),       # low mapping quality
    ]
    got = {(r.pos, r.alt): r.letter for r in V.filter_variants(variants(spark, rows), ORDER).collect()}
    assert got == {(100, "G"): "G", (102, "A"): "g", (110, "ATT"): "U", (200, "GT"): "M", (201, "T"): "U", (300, "C"): "Q"}


def test_partitions_do_not_matter(spark):
    rnd = random.Random(7)
    rows = []
    for p in range(1, 400):
        for _ in range(rnd.randint(0, 2)):
            r, a = rnd.choice([("A", "G"), ("A", "C"), ("ACC", "A"), ("A", "ATG"), ("AC", "GT")])
            rows.append((p, r, a, rnd.randint(1, 99), rnd.choice([5, 60, 60])))
    df = variants(spark, rows)
    key = ["pos", "ref", "alt", "qual", "info", "code"]
    whole = sorted(map(tuple, V.filter_variants(df.repartition(1), ORDER).select(key).collect()))
    parts = sorted(map(tuple, V.filter_variants(df.repartition(7, "qual"), ORDER).select(key).collect()))
    assert whole == parts and len(whole) == len(rows)


def test_pileup_variant_partitions(spark):
    rnd = random.Random(3)
    rows = []
    for p in range(1, 300):
        if rnd.random() < 0.4:
            indel = rnd.random() < 0.3
            rows.append(("c", p, "*" if indel else "A", "-AC/*" if indel else "G", 30, rnd.randint(10, 90), rnd.randint(5, 60), rnd.randint(1, 120),
                         "G", "-AC" if indel else None, "*" if indel else None, 2, 1))
    df = spark.createDataFrame(rows, "rname string, pos bigint, ref string, consensus string, quality int, snp_quality int, rms_mapq int, depth bigint, bases string, allele1 string, allele2 string, count1 int, count2 int")
    key = ["pos", "ref", "snp_quality", "code"]
    a = sorted(map(tuple, V.filter_pileup_variants(df.repartition(1), ["ref"]).select(key).collect()))
    b = sorted(map(tuple, V.filter_pileup_variants(df.repartition(7, "snp_quality"), ["ref"]).select(key).collect()))
    assert a == b and {c for *_, c in a} >= {0, 4, 5}


def test_rmdup_keeps_one_per_key(spark):
    rows = [("a", 99, "c", 5, 30, "4M", "=", 100, "IIII", "L"), ("b", 99, "c", 5, 30, "4M", "=", 100, "HHHH", "L"), ("a", 147, "c", 100, 30, "4M", "=", -100, "IIII", "L"), ("b", 147, "c", 100, 30, "4M", "=", -100, "HHHH", "L")]
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos bigint, mapq int, cigar string, rnext string, tlen bigint, qual string, library string")
    assert sorted((r.qname, r.tlen) for r in A.rmdup_pe(df, ["qname"]).collect()) == [("a", -100), ("a", 100)]


def test_scale_helpers(spark):
    n = 5000
    df = spark.range(n).select((F.col("id") % 7 == 0).alias("hot"), F.col("id"), (F.col("id") * 37 % n).alias("k"))
    numbered = S.number_rows(df, [F.col("k")], within=["hot"])
    assert numbered.groupBy("hot").agg((F.max("n") == F.count("*")).alias("ok"), (F.countDistinct("n") == F.count("*")).alias("u")).filter("ok AND u").count() == 2
    w = S.number_within(df, ["hot"], [F.col("k")])
    assert w.join(numbered.select("id", F.col("n").alias("m")), "id").filter("n <> m").isEmpty()
    total = S.running_sum(df.withColumn("g", F.lit(1)), ["g"], "id", {"upto": "k"}, width=64)
    assert one(total.filter(F.col("id") == n - 1)).upto == n * (n - 1) // 2
    filled = S.carry_forward(df.select("id", F.lit(1).alias("g"), F.when(F.col("id") % 500 == 3, F.col("id")).alias("h")), ["g"], "id", "h", width=64)
    assert one(filled.filter("id = 502")).h == 3 and one(filled.filter("id = 2")).h is None
    ranks = one(ST.nearest_rank(df, [], "id", {"p0": 0, "p50": 50, "p100": 100}))
    assert (ranks.p0, ranks.p50, ranks.p100) == (0, n // 2, n - 1)


def test_names(spark):
    df = spark.createDataFrame([("chr10",), ("chr9",), ("chr010a",)], "v string")
    assert [r.v for r in df.orderBy(names.natural_key("v")).collect()] == ["chr9", "chr10", "chr010a"]


def test_solexa(spark):
    got = one(spark.createDataFrame([([-5, 0, 10, 40],)], "v array<int>").select(ph.solexa_to_phred("v").alias("p"))).p
    assert got == [1, 3, 10, 40]


def test_fastq_with_at_in_quality(spark, tmp_path):
    path = str(tmp_path / "a.fastq")
    with open(path, "w") as f:
        f.write("@r1/1\nACGT\n+\n@@@@\n@r1/2\nAC\n+r1/2\n+@\n")
    got = SR.read_fastq(spark, path).orderBy("rid").collect()
    assert [(r.id, r.seq, r.qual, r.mate, r.pair_id) for r in got] == [("r1/1", "ACGT", "@@@@", 1, 0), ("r1/2", "AC", "+@", 2, 0)]


def test_scaffolds(spark):
    c = spark.createDataFrame([("f", "a", "AACC"), ("f", "b-1", "GT"), ("f", "x", "TTTT")], "file string, name string, seq string")
    spec = spark.createDataFrame([(1, "a:3:-b-1")], "scaffold int, spec string")
    got = {r.name: r.seq for r in C.build_scaffolds(c, C.parse_scaffold_spec(spec)).collect()}
    assert got == {"Scaffold1_+a_-b-1": "AACCNNNAC", "x": "TTTT"}


def test_edits(spark):
    c = spark.createDataFrame([("c", "ACGTACGTAC")], "name string, seq string")
    e = spark.createDataFrame([("c", 2, "T"), ("c", 4, "+GG"), ("c", 6, "-GT"), ("c", 50, "A")], "rname string, pos bigint, change string")
    assert one(P.apply_variants(c, e)).seq == "ATGTGGACAC"
    tiny = P.apply_edits(c, P.as_edits(e), chunk=3)
    assert one(tiny).seq == "ATGTGGACAC"


def test_long_regions_names_and_descriptions(spark, tmp_path):
    from strandframe.operators import contigs
    from strandframe.sources import records

    got = contigs.parse_regions(spark.createDataFrame([("c:600,000,000",), ("c",), ("c:5-700000000",)], "region string")).collect()
    assert [(r.beg, r.end) for r in got] == [(600_000_000, None), (1, None), (5, 700_000_000)]
    df = spark.createDataFrame([("c" + "1" * 24,), ("c" + "1" * 23 + "2",), ("c" + "9" * 20,)], "v string")
    assert [r.v[-1] + str(len(r.v)) for r in df.orderBy(names.natural_key("v")).collect()] == ["921", "125", "225"]
    lines = "\n".join(f"            w{i}" for i in range(1, 30))
    (tmp_path / "g.gbk").write_text(f"LOCUS       s1 10 bp\nDEFINITION  w0\n{lines}\nORIGIN\n        1 acgt\n//\n")
    assert records.genome_sequences(spark, str(tmp_path)).first().description.split() == [f"w{i}" for i in range(30)]


def test_repeated_keys_and_all_places(spark):
    from strandframe.functions import common, dna

    df = spark.createDataFrame([("DP=1;DP=2;FLAG;X=a=b", "ATATATA", "ATA"), (None, "", "A"), ("", "A.A.", ".A")], "info string, s string, p string")
    got = df.select(common.keyed("info", ";", "=").alias("m"), dna.all_indexes("s", "p").alias("i")).collect()
    assert got[0].m == {"DP": "1", "FLAG": None, "X": "a=b"} and [r.i for r in got] == [[1, 3, 5], [], [2]]


def test_basecall_support_is_literal(spark):
    """A consensus of "." is counted as itself, not as any character."""
    rows = [("c", 1, "A", ".", "ACGTACGTACGTACGTACGT", 20), ("c", 2, "A", ".", "." * 20, 20), ("c", 3, "A", "G", "gG" * 10, 20), ("c", 4, "A", "G", "gA" * 10, 20)]
    sites = spark.createDataFrame(rows, "rname string, pos int, ref string, consensus string, bases string, depth int")
    sites = sites.withColumns({"allele1": F.lit("*"), "allele2": F.lit("*")})
    assert sorted(tuple(r) for r in P.basecall_changes(sites).collect()) == [("c", 2, "."), ("c", 3, "G")]
