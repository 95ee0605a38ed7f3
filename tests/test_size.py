"""Steps that took too long, or moved too much, on tables of the largest size."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strandframe.functions import cigar as cg
from strandframe.operators import pileup as P

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


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_equal_cigars_are_read_once(spark):
    texts = ["10M", "3S4M2I1P3M", "4M1P2I3D2M", "2M3D1I4M5N6M2H", "5M2D", "4=3M", "", "*", None, "3D", "2I3M1P4D1M"]
    df = spark.createDataFrame([(t,) for t in texts], "cigar string")
    out = {r.cigar: r for r in df.select("cigar", cg.aligned("cigar").alias("a"), cg.blocks("cigar").alias("b")).collect()}
    for t in texts:
        want = [(x.op, x.ref, x.qry, x.len) for x in out[t].b or [] if x.op in "MD"]
        assert [(x.op, x.ref, x.qry, x.len) for x in out[t].a or []] == want
    shown = lambda t: [(x.op, x.after, x.nxt if x.after > 0 else None, x.opens, x.closes) for x in out[t].a]
    assert shown("3S4M2I1P3M") == [("M", 2, 7, True, False), ("M", 0, None, False, True)]
    assert shown("4M1P2I3D2M") == [("M", 2, 4, True, False), ("D", 0, None, False, False), ("M", 0, None, False, True)]
    assert shown("5M2D") == [("M", 0, None, True, True), ("D", 0, None, False, False)]


def test_a_task_of_bases_takes_a_bounded_number_of_blocks(reads, monkeypatch):
    want = sorted(map(repr, P.call_genotypes(P.read_bases(reads)).collect()))
    monkeypatch.setattr(P, "PART_BLOCKS", 1)
    bases = P.read_bases(reads)
    assert bases.rdd.getNumPartitions() > 8
    out = P.call_genotypes(bases)
    # sorted once for the damping; no table of counts is built
    assert physical(out).count("HashAggregate") == 2 and physical(out).count("Sort [") == 1
    assert sorted(map(repr, out.collect())) == want


def test_edits_are_read_once_a_row_and_mates_moved_once(spark, tmp_path):
    from strandframe.sources import converters as K

    lines = ["# note"]
    for i in range(6):
        lines += [f"@q{i}/1\tL\tACGTACGTAC\tIIIIIIIIII\tU\t60\t50\t>chr1\t{i + 1}\tF\t.\t1\tR\t3A>T 5+TT 7-C 8-G", f"@q{i}/2\tR\tACGTACGTAC\tIIIIIIIIII\tU\t30\t40\t>chr1\t{i + 101}\tR\t.\t1\tF"]
    lines += ["@q0/1\tL\tACGTACGTAC\tIIIIIIIIII\tU\t9\t9\t>chr2\t7\tF\t.\t1\tR\t1-A 2G>T", "@x/1\tL\tAC\tII\tU\t9\t9\t>chr2\t7\tF\t.\t1\tR", "@y/1\tL\tAC\tII\tNM"]
    path = tmp_path / "novo.txt"
    path.write_text("\n".join(lines) + "\n")
    out = K.novo_to_sam(spark, str(path))
    text = physical(out)
    assert text.count("Exchange hashpartitioning(qname") == 1 and "rangepartitioning" not in text
    rows = {(r.qname, r.pos): r for r in out.collect()}
    assert len(rows) == 14
    assert (rows["q3", 4].cigar, rows["q3", 4].tag_text[1], rows["q3", 4].pnext, rows["q3", 4].tlen) == ("4M2I2M2D2M", "MD:Z:2A3^CG2", 104, 110)
    assert (rows["q0", 7].cigar, rows["q0", 7].tag_text[1], rows["q0", 7].rnext) == ("1D10M", "MD:Z:^A0G9", "*")
    assert (rows["x", 7].cigar, rows["x", 7].tag_text[1], rows["x", 7].flag) == ("2M", "MD:Z:2", 67)


def test_heads_are_moved_once_by_place(spark):
    from strandframe.operators import alignments as A

    rows = [(f"n{i}", 67, "chr1", 1 + i % 3, 40, "4M", "ACGT", "I" * (1 + i % 4), "rg0", 50 if i % 5 else -50) for i in range(40)]
    rows += [("n7", 131, "chr1", 9, 40, "4M", "ACGT", "IIII", "rg0", -50), ("n11", 131, "chr1", 9, 40, "4M", "ACGT", "IIII", "rg1", -50), (None, 131, None, 9, 40, "4M", "ACGT", "IIII", None, -5),
             ("z", 67, None, None, 40, "4M", "ACGT", "II", None, 5), (None, 67, None, None, 40, "4M", "ACGT", "II", None, 5), ("f", 4, "chr1", 1, 40, "4M", "ACGT", "II", "rg0", 5)]
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos bigint, mapq int, cigar string, seq string, qual string, rg string, tlen int")
    groups = spark.createDataFrame([("rg0", "L"), ("rg1", "M")], "rg string, library string")
    marked = A.with_library(df, groups).withColumn("rnext", F.lit("="))
    assert "BroadcastHashJoin" in physical(marked)
    out = A.rmdup_pe(marked, ["qname", "flag"])
    # the kept heads, the names of all heads, the tails and the names that are gone
    text = physical(out)
    assert text.count("Exchange hashpartitioning(_lib") == 2 and text.count("SortAggregate") == 0
    heads = [r for r in rows if r[9] > 0 and r[1] != 4]
    best = {}
    for r in sorted(heads, key=lambda r: (-sum(ord(c) - 33 for c in r[7]), r[0] or "")):
        best.setdefault((r[8], r[2], r[3], r[9]), r)
    kept = {r[0] for r in best.values()}
    gone = {r[0] for r in heads} - kept - {None}
    want = sorted(map(repr, [*best.values(), *[r for r in rows if r[9] <= 0 and r[0] not in gone], *[r for r in rows if r[1] == 4]]))
    shown = lambda d: sorted(map(repr, (tuple(r) for r in d.select(df.columns).collect())))
    assert shown(out) == want
    assert shown(A.rmdup_pe(marked, ["qname", "flag"], most=3)) == want


def test_lines_of_a_bin_are_put_together_in_arrays(reads, spark):
    odd = [("b", 17, "chr1", 252, 40, "12M", "gtacgtacgtaé", "éBCDEFGHIJKL", "rg1"), ("n", 1, "chr1", 253, 0, "4M", None, "IIII", "rg0"), ("m", 1, "chr1", 253, 93, "4M", "ACGT", None, None),
           ("s", 16, "chr1", 254, 9, "6M", "AC", "II", "rg0"), (None, 0, "chr1", 254, 9, "3M1P2I3D2M", "ACGTACG", "IIIIIII", "rg0"), ("e", 0, None, 9, 9, "3M", "ACG", "III", "rg0"),
           ("x", 0, "chr2", 9, 9, "4M", "ACGT", "IIII", "rg2"), ("far", 16, "chr3", 1023, 9, "2M300D2M", "ACGT", "IIII", "rg2")]
    held = reads.unionByName(spark.createDataFrame(odd, reads.schema))
    contigs = spark.createDataFrame([("chr1", "ACGt" * 100), ("chr2", "ACGTACGTAC"), ("chr3", "ACCA" * 400)], "name string, seq string")
    lines = P.pileup(held, ["qname", "flag"], contigs)
    assert "FlatMapGroupsInArrow" in physical(lines) and "collect_list" not in physical(lines).split("FlatMapGroupsInArrow")[0]
    got = {(r.rname, r.pos): r for r in lines.collect()}
    everywhere = held.sparkSession.createDataFrame([(n, p) for n, p in got if n], "rname string, pos bigint")
    singly = P.pileup(held, ["qname", "flag"], contigs, sites=everywhere).collect()
    assert len(singly) == len([k for k in got if k[0]])
    assert [got[r.rname, r.pos] for r in singly] == singly
    assert got[None, 10].bases == "C" and got["chr3", 1024].bases == "c-300" + ("acca" * 75) and got["chr3", 1100].bases == "*"
    wide = {(r.rname, r.pos): r for r in P.mpileup(held, "rg", ["rg0", "rg1"], ["qname", "flag"], contigs=contigs).collect()}
    assert set(wide) == set(got) and (wide["chr3", 1100].depth_rg0, wide["chr3", 1100].bases_rg1) == (0, "*")


@pytest.mark.parametrize("k", [3, 21, 31])
def test_kmers_travel_in_sorted_blocks(spark, monkeypatch, k):
    from collections import Counter

    from strandframe.operators import contigs as C

    text = "".join("ACGT"[i * i * 7 % 11 % 4] for i in range(900))
    rows = [("f", "a", text), ("f", "b", text[100:400] + "N" * 60 + text[:90]), ("g", "c", "ACGTé x" * 20), (None, "d", text[:200] * 2), ("h", "e", "AC"), ("h", "n", None), ("i", "z", "")]
    held = spark.createDataFrame(rows, "file string, name string, seq string")

    def want(last):
        out, seen = {}, {}
        for f, _, s in rows:
            s = (s or "")[: len(s or "") - last]
            seen.setdefault(f, Counter()).update(s[i : i + k] for i in range(len(s) - k + 1))
        for f, c in seen.items():
            if c:
                out[f] = round(sum(n > 1 for n in c.values()) / c.total(), 4)
        return out

    shown = lambda last: {r.file: r.kmer21 for r in C.kmer_repeat_fraction(held, k=k, legacy_last=last).collect()}
    assert shown(False) == want(0) and shown(True) == want(1)
    # pieces, blocks and parts of small size give the same
    for name, value in (("PIECE", 50), ("CODED_LETTERS", 40), ("BLOCK_LETTERS", 100), ("PART_LETTERS", 64)):
        monkeypatch.setattr(C, name, value)
    assert shown(False) == want(0)
    assert "code#" not in physical(C.kmer_repeat_fraction(held, k=k))
