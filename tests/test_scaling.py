"""What is moved and held by steps that met too much of their input at once."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandframe.functions import phred as ph
from strandframe.operators import alignments as A
from strandframe.operators import contigs as C
from strandframe.operators import pileup as P
from strandframe.operators import scale
from strandframe.plans import sources as S

ROWS = [
    ("a", 1, "chr1", 250, 30, "6M1I4M2D5M", "ACGTACGACGTACGTA", "IIIIIIIIIHHHHHHH", "rg0"),
    ("b", 17, "chr1", 252, 40, "12M", "GTACGTACGTAC", "ABCDEFGHIJKL", "rg1"),
    ("b", 17, "chr1", 252, 40, "12M", "GTACGTACGTAC", "ABCDEFGHIJKL", "rg1"),
    ("c", 1, "chr1", 255, 50, "3S4M20N4M", "TTTACGTACGT", "IIIIIIIIIII", "rg0"),
    ("d", 1, "chr2", 4, 20, "8M", "ACGTACGT", "IIII####", "rg0"),
]


@pytest.fixture
def reads(spark):
    return spark.createDataFrame(ROWS, "qname string, flag int, rname string, pos bigint, mapq int, cigar string, seq string, qual string, rg string")


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


def test_bases_are_counted_where_their_blocks_are(reads):
    for out in (P.site_counts(P.read_bases(reads)), P.call_consensus(P.read_bases(reads)), P.call_genotypes(P.read_bases(reads))):
        text = out._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange ") == 1 and text.index("Exchange ") > text.index("Generate explode(sequence(0")


@pytest.mark.parametrize("make", [P.site_counts, P.call_consensus, P.call_genotypes])
def test_a_bin_of_many_blocks_is_dealt_to_several_tasks(reads, monkeypatch, make):
    want = rows(make(P.read_bases(reads)))
    monkeypatch.setattr(P, "BIN_BLOCKS", 2)
    bases = P.read_bases(reads)
    assert bases.filter("_salt > 1").count() > 0
    assert rows(make(bases)) == want


def test_pileup_moves_blocks_and_keeps_its_lines(reads, spark):
    contigs = spark.createDataFrame([("chr1", "ACGT" * 100), ("chr2", "ACGTACGTAC")], "name string, seq string")
    lines = P.pileup(reads, ["qname", "flag"], contigs)
    assert "_j#" not in plan(lines)
    shown = {(r.rname, r.pos): r for r in lines.collect()}
    assert shown["chr1", 252].bases == "G^Ig^Ig"
    assert shown["chr1", 255].depth == 4 and shown["chr1", 255].part == 0
    # the bins of deep sites go base by base, to the same lines but for the parts of the deep ones
    cut = {(r.rname, r.pos, r.part): r for r in P.pileup(reads, ["qname", "flag"], contigs, part_size=2).collect()}
    assert max(part for *_, part in cut) == 1
    for (name, pos), r in shown.items():
        parts = [cut[name, pos, i] for i in range((r.depth + 1) // 2)]
        for c in ("bases", "quals", "mapqs"):
            assert "".join(getattr(x, c) for x in parts) == getattr(r, c)
    wide = P.mpileup(reads, "rg", ["rg0", "rg1"], ["qname", "flag"], contigs=contigs)
    assert {(r.rname, r.pos): r.depth_rg0 + r.depth_rg1 for r in wide.collect()} == {k: r.depth for k, r in shown.items()}


def test_kmer_counts_leave_in_bounded_batches():
    text = "ACGTTGCAAC" * 37
    pieces = [text[i % 7:] + "GATTACA" * (i % 11) + "N" * (i % 3) for i in range(2_000)]
    batch = pa.RecordBatch.from_pydict({"file": ["f"] * len(pieces), "_piece": pieces})
    out = list(C._count_codes(["file"], 21)(iter([batch])))
    widest = max(map(len, pieces))
    old = C.BATCH_ROWS
    C.BATCH_ROWS = 1_000
    try:
        small = list(C._count_codes(["file"], 21)(iter([batch])))
    finally:
        C.BATCH_ROWS = old
    assert max(b.num_rows for b in small) < 1_000 + widest
    assert pa.Table.from_batches(small).to_pylist() == pa.Table.from_batches(out).to_pylist()


def test_mates_are_moved_once(reads, monkeypatch):
    out = A.fix_mates(reads, ["pos", "flag"])
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange ") <= 2
    numbered = scale.number_records(reads, ["qname"], [F.col("pos")], most=1)
    assert sorted((r.qname, r.n) for r in numbered.collect()) == [("a", 1), ("b", 1), ("b", 2), ("c", 1), ("d", 1)]


def test_duplicates_are_looked_for_in_even_parts(reads):
    marked = reads.withColumns({"library": F.col("rg"), "rnext": F.lit("="), "tlen": F.lit(5)})
    for out in (A.rmdup_se(marked, ["qname"]), A.rmdup_pe(marked, ["qname"]), A.duplicate_rates_se(marked), A.duplicate_rates_pe(marked)):
        assert "RebalancePartitions" in plan(out)


def test_low_prefixes_are_folded_not_indexed(spark):
    quals = spark.createDataFrame([("#####IIII",), ("II",), ("",), (None,)], "q string")
    out = quals.select(ph.expanding_low(ph.phred("q"), 24, 8).alias("n"))
    assert "get(" not in plan(out)
    assert [r.n for r in out.collect()] == [8, 5, 8, 8]


def test_reads_without_a_place_stay_one_site(reads, monkeypatch):
    lost = reads.withColumn("pos", F.when(F.col("qname") != "b", F.col("pos")))
    counts = {(r.rname, r.pos): r.depth for r in P.site_counts(P.read_bases(lost)).collect()}
    assert counts["chr1", None] == 24 and counts["chr2", 4] == 1 and counts["chr1", 252] == 1
    lines = {(r.rname, r.pos): r for r in P.pileup(lost, ["qname", "flag"]).collect()}
    assert lines["chr1", None].depth == 24 and lines["chr1", None].quals == "AACCGGKKDDHHLLEEIIBBFFJJ"
    monkeypatch.setattr(P, "BIN_BLOCKS", 2)
    assert {(r.rname, r.pos): r.depth for r in P.site_counts(P.read_bases(lost)).collect()} == counts


def test_xml_input_comes_in_files_of_bounded_size(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(S, "XML_ROWS", 10)
    df = spark.range(95).coalesce(1).select(F.col("id").alias("p"))
    path = S.put_xml(spark, df, """concat('<protein id="g', p, '" length="7"></protein>')""", S.X.DOMAIN_PROTEIN, "protein")
    read = S.X._xml(spark, path, "protein", S.X.DOMAIN_PROTEIN)
    per_file = read.groupBy(F.col("_metadata.file_path")).count().collect()
    assert sum(r[1] for r in per_file) == 95 and max(r[1] for r in per_file) <= 12


def test_a_scan_with_all_rows_in_one_split_is_dealt_out(spark, tmp_path, monkeypatch):
    from strandframe.plans import fixtures

    path = str(tmp_path / "one.parquet")
    spark.range(100_000).selectExpr("id", "sha2(cast(id as string), 256) as text").coalesce(1).write.parquet(path)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in old:
            spark.conf.set(k, "65536")
        scan = spark.read.parquet(path)
        assert scan.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        dealt = fixtures.spread(scan)
        sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) * spark.sparkContext.defaultParallelism <= 2 * sum(sizes)
        assert sorted(r.id for r in dealt.select("id").collect()) == list(range(100_000))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_parts_between_gaps_are_not_moved(spark):
    held = spark.createDataFrame([("x", "NACNNNGTNA", "0123456789"), ("x", "NACNNNGTNA", "0123456789"), ("n", "NNNN", "0123"), (None, "ANNNN", "01234")], "name string, seq string, qual string")
    out = C.split_at_gaps(held, 3, "qual")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    want = [("x_subcontig0", "AC", "12", 2), ("x_subcontig1", "GTNA", "6789", 7)] * 2 + [(None, "A", "0", 1)]
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, want))


def test_only_frames_at_the_edges_of_pieces_meet_in_a_window(spark):
    from strandframe.operators import genes as G

    text = "TAA" + "ATG" + "GCC" * 40 + "TAA" + "CC"
    held = spark.createDataFrame([("x", text)], "name string, seq string")
    [row] = G.find_orfs(held, with_seq=True).filter("strand = '+'").collect()
    assert (row.ustop, row.start, row.stop, row.length, row.seq, row.aa_seq) == (4, 4, 129, 126, text[3:129], "M" + "A" * 40 + "*")
    batch = pa.RecordBatch.from_pylist([{"_key": {"name": "x"}, "size": len(text), "piece": 0, "seq": text, "before": "", "after": ""}])
    [edges] = G._frames(True, 90, False, False, 12288)([batch])
    assert all(o or not c for o, c in zip(edges.column("opens").to_pylist(), edges.column("closed").to_pylist()))
    assert edges.num_rows <= 12


def test_proteins_are_translated_once_by_arrays(spark):
    from strandframe.operators import genes as G
    from strandframe.functions import dna

    held = spark.createDataFrame([("a", "ATGGCCTAAAC"), ("b", "é" * 3 + "NACatg😀TTTT"), ("c", ""), ("d", None)], "name string, seq string")
    got = {r.name: r.p for r in held.select("name", dna.translate_dna("seq").alias("p")).collect()}
    assert got == {"a": "MA*X", "b": "XXXXX", "c": "", "d": None}
    out = G.clip_proteins(held.select("name", dna.translate_dna("seq").alias("seq")), 2)
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted(r.name for r in out.collect()) == ["a", "b"]


def test_records_of_a_library_are_not_dealt_by_read_group(reads, spark):
    groups = spark.createDataFrame([("rg0", "L"), ("rg0", "L"), ("rg1", "M"), (None, "L")], "rg string, library string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = A.view(reads, library="L", read_groups=groups)
        assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.qname for r in out.collect()) == ["a", "c", "d"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
