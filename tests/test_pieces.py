"""Sequences in pieces against plain slices and a plain walk, across piece edges."""

import random
import re

import pytest
from pyspark.sql import functions as F

from strandframe.operators import contigs as C
from strandframe.operators import genes as G
from strandframe.operators import pieces as P

W = P.WIDTH


def rc(s):
    return s[::-1].translate(str.maketrans("ATGCatgc", "TACGtacg"))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(4)
    free = "GCC" * (W * 2 // 3)  # no stop for more than two pieces
    out = {"a": "".join(rnd.choices("ACGT", k=3 * W + 7)), "b": "ATG", "d": "".join(rnd.choices("ACGTN", k=W)), "e": "TAAG" + free + "ATG" + free + "TAA" + "ACG" * 50, "f": rc("CTAAG" + "ATG" + free + "TGA")}
    out["g"] = "".join(rnd.choices("ACGT", k=2 * W - 1)) + "T"
    return out


@pytest.fixture(scope="module")
def held(spark, texts):
    return spark.createDataFrame([*texts.items(), ("none", "")], "name string, seq string")


def test_cut_and_join(held, texts):
    cut = P.cut(held, edge=2).collect()
    for name, s in texts.items():
        own = sorted((r for r in cut if r["name"] == name), key=lambda r: r["piece"])
        assert "".join(r["seq"] for r in own) == s and all(r["size"] == len(s) for r in own)
        for r in own:
            a = r["piece"] * W
            assert (r["before"], r["after"]) == (s[max(a - 2, 0) : a], s[a + W : a + W + 2])
    assert {r["name"]: r["seq"] for r in P.join_pieces(P.cut(held)).collect()} == texts


def test_fetch(spark, held, texts):
    rnd = random.Random(9)
    rows = [(n, b, b + rnd.choice([0, 1, 50, W, 2 * W])) for n, s in texts.items() for b in [1, W - 1, W, W + 1, 2 * W, *rnd.sample(range(1, 4 * W), 5)]]
    rows += [("a", -5, 3), ("a", 0, 10**12), ("missing", 1, 2), ("none", 1, 2), ("a", 7, 6)] + [("a", 5, 90)] * 3
    asked = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "who string, x bigint, y bigint, i int")
    got = {r["i"]: r["seq"] for r in P.fetch(asked, P.cut(held), ("who", "x", "y")).collect()}
    assert got == {i: texts.get(n, "")[max(x, 1) - 1 : max(y, 0)] for i, (n, x, y) in enumerate(rows)}


def test_splice(spark, held, texts):
    rows = [("a", "+", [(1, 3), (7, 9)]), ("a", "-", [(1, 3), (7, 9)]), ("a", "-", [(W - 1, W + 4), (2 * W, 2 * W + 1)]), ("b", "+", [(1, 3)]), ("a", "+", [(1, 3), (7, 9)])]
    genes = spark.createDataFrame(rows, "seqname string, strand string, places array<struct<lo:bigint,hi:bigint>>")
    got = sorted((r["seqname"], r["strand"], [tuple(p) for p in r["places"]], r["nt"]) for r in G.gene_sequences(genes, held).collect())

    def want(name, strand, places):
        joined = "".join(texts[name][lo - 1 : hi] for lo, hi in places)
        return rc(joined) if strand == "-" else joined

    assert got == sorted((*r, want(*r)) for r in rows)


def walk(s, truncated, min_len):
    """Frames codon by codon."""
    out, n = [], len(s)
    for strand, read in (("+", s), ("-", rc(s))):
        for shift in range(3):
            begin, first = shift, None
            for at in range(shift, n - 2, 3):
                codon = read[at : at + 3]
                if first is None and codon in ("ATG", "GTG"):
                    first = at
                stop = codon in ("TAA", "TAG", "TGA")
                if stop or at + 6 > n:
                    end = at + 3
                    if end - begin >= min_len and first is not None and end - first >= min_len and (stop or truncated):
                        f = shift if strand == "+" else (n - shift) % 3
                        place = (begin + 1, first + 1, end) if strand == "+" else (n - begin, n - first, n - end + 1)
                        out.append((f"{f}{'R' if strand == '-' else ''}", strand, *place, end - begin, begin < 3, not stop, read[begin:end]))
                    begin, first = end, None
    return out


@pytest.mark.parametrize("truncated", [False, True])
def test_frames_across_pieces(held, texts, truncated):
    got = G.find_orfs(held, truncated=truncated, with_seq=True).collect()
    columns = ("frame", "strand", "ustop", "start", "stop", "length", "truncated_upstream", "truncated_downstream", "seq")
    for name, s in texts.items():
        assert sorted(tuple(r[c] for c in columns) for r in got if r["name"] == name) == sorted(walk(s, truncated, 90)), name
    longest = {n: max([r["length"] for r in got if r["name"] == n], default=0) for n in texts}
    assert longest["e"] > 4 * W and longest["f"] > 2 * W


def test_gaps_across_pieces(spark):
    rnd = random.Random(6)
    rows = {"x": "ACGT" * 10 + "N" * (3 * W) + "AC" + "n" * 5 + "G", "y": "N" * W + "A" * W + "NN" + "C" * W + "NNNN", "z": "A" * W + "N" * 4 + "C" * (W - 2) + "N" * 4 + "A", "n": "N" * (W + 5), "p": "ACG"}
    rows["r"] = "".join(rnd.choices("ACN", weights=[2, 2, 3], k=2 * W + 9))
    frame = spark.createDataFrame([(n, s, s.lower()[::-1]) for n, s in rows.items()], "name string, seq string, qual string")
    got = sorted((r["name"], r["start"], r["seq"], r["qual"]) for r in C.split_at_gaps(frame, 4, "qual").collect())
    want = []
    for n, s in rows.items():
        lead = len(s) - len(s.lstrip("Nn"))
        at, k = lead, 0
        for part in re.split("([Nn]{4,})", s[lead:]):
            if part and not re.fullmatch("[Nn]{4,}", part):
                want.append((f"{n}_subcontig{k}", at + 1, part, s.lower()[::-1][at : at + len(part)]))
            k += bool(re.fullmatch("[Nn]{4,}", part))
            at += len(part)
    assert got == sorted(want)


def test_nearest_start_in_a_long_frame(spark):
    s = "CCC" * 50_000 + "ATG" + "CCC" * 20_000 + "GTG" + "CCC"
    rows = spark.createDataFrame([("+", 1, len(s), p, s) for p in (1, 150_001, 150_010, 200_000, 215_000, 210_010)], "strand string, lo bigint, hi bigint, pos bigint, seq string")
    got = {r["pos"]: r["snapped"] for r in G.snap_to_start(rows).collect()}
    assert got == {1: 150_001, 150_001: 150_001, 150_010: 150_001, 200_000: 210_004, 215_000: 210_004, 210_010: 210_004}


def test_fetch_sorts_parts_not_pieces(spark):
    """What is put together are the cut parts: a row with a whole piece in it would be sorted for each request."""
    contigs = spark.createDataFrame([("c", "ACGTTGCA" * 4000)], "name string, seq string")
    asked = spark.createDataFrame([("c", 12280, 12300), ("c", 5, 9), ("c", 5, 9)], "name string, beg long, end long")
    found = P.fetch(asked, P.cut(contigs), ("name", "beg", "end"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    gathered = [line for line in plan.splitlines() if "collect_list" in line]
    assert gathered and not any(re.search(r"(?<!_)_t0", line) for line in gathered)
    text = "ACGTTGCA" * 4000
    assert sorted((r["beg"], r["seq"]) for r in found.collect()) == [(5, text[4:9]), (5, text[4:9]), (12280, text[12279:12300])]
