"""Dictionaries that disagree, ranks over any spread, numbers without whole rows, places of a text."""

import random

import pytest
from pyspark.sql import functions as F

from strandframe.functions import dna
from strandframe.operators import alignments as A
from strandframe.operators import scale as S
from strandframe.operators import stats
from strandframe.operators import variants as V


@pytest.mark.parametrize("other,fits", [([("a", 10, 0), ("b", 20, 1)], True), ([("a", 10, 1), ("b", 20, 0)], False), ([("a", 10, 0), ("b", 21, 1)], False), ([("a", 10, 0)], False), ([("a", 10, 0), ("b", 20, 1), ("c", 5, 2)], False)])
def test_merge(spark, other, fits):
    own = spark.createDataFrame([("a", 10, 0), ("b", 20, 1)], "name string, length bigint, idx int")
    theirs = spark.createDataFrame(other, own.schema)
    x = spark.createDataFrame([("b", 3, 0), ("a", 7, 16)], "rname string, pos bigint, flag int")
    y = spark.createDataFrame([("a", 7, 0), ("*", 0, 4), ("b", 1, 0)], x.schema)
    merged = A.merge_alignments(x, y, groups=["x", "y"], dictionaries=[own, theirs])
    if fits:
        assert [tuple(r) for r in merged.select("rname", "pos", "flag", "rg").collect()] == [("a", 7, 0, "y"), ("a", 7, 16, "x"), ("b", 1, 0, "y"), ("b", 3, 0, "x"), ("*", 0, 4, "y")]
    else:
        with pytest.raises(Exception, match="disagree on"):
            merged.collect()


def test_ranks(spark):
    rnd = random.Random(1)
    groups = {"x": [rnd.random() for _ in range(501)], "y": [rnd.choice([0.5, 0.25, 1e18]) for _ in range(40)], None: [3.0], "z": [-5.0, 7.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("x", None), ("none", None)], "g string, v double")
    got = {r["g"]: (r["p"], r["q"]) for r in stats.nearest_rank(df, ["g"], "v", {"p": 90, "q": 100}).collect()}
    assert got == {g: (sorted(v)[min(len(v) * 90 // 100, len(v) - 1)], max(v)) for g, v in groups.items()}
    whole = stats.nearest_rank(df, [], "v", {"p": 50}).collect()
    every = sorted(v for vs in groups.values() for v in vs)
    assert [r["p"] for r in whole] == [every[len(every) // 2]]
    medians = {r["g"]: r["median"] for r in stats.describe(df, ["g"], "v").collect()}
    assert medians == {g: (sorted(v)[(len(v) - 1) // 2] + sorted(v)[len(v) // 2]) / 2 for g, v in groups.items()} | {"none": None}


def test_numbers(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["p", "q", None]), rnd.choice([None, 1, 2, 3]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, k int, payload int")
    got = S.number_rows(df, [(F.col("k"), False), F.col("payload")], within=["g"]).collect()
    for g in ("p", "q", None):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-(r[1] if r[1] is not None else -1), r[2]))
        assert [r["payload"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["n"])] == [r[2] for r in own]
    tied = S.number_rows(df.withColumn("payload", F.lit(1)), [F.col("k")], within=["g"]).collect()
    assert all(sorted(r["n"] for r in tied if r["g"] == g) == list(range(1, 1 + sum(x[0] == g for x in rows))) for g in ("p", "q", None))


def test_ladder(spark):
    rnd = random.Random(4)
    counts = [rnd.choice([1, 1, 2, 9, 400]) for _ in range(300)]
    sums = [sum(counts[: i + 1]) for i in range(len(counts))]
    want, need = [], 0.05 * (sums[-1] + 1)
    for k in sums:
        if k > need or k == sums[-1]:
            want.append(k)
            need = k + 0.05 * (sums[-1] + 1)
    got = V.ladder_steps(spark.createDataFrame([(k,) for k in sums], "k0 bigint"), 0.05).collect()
    assert sorted(r["k0"] for r in got) == want
    assert V.ladder_steps(spark.createDataFrame([], "k0 bigint"), 0.05).count() == 0


def test_places_of_a_pattern(spark):
    rnd = random.Random(6)
    long = "A" * 200_000
    rows = [("".join(rnd.choices("AC", k=rnd.randint(0, 900))), "".join(rnd.choices("AC", k=rnd.randint(0, 12)))) for _ in range(60)] + [("ACA", "ACAA"), ("", ""), ("é漢é漢é", "é漢é"), ("A.C\\EA.C", ".C\\E"), ("A" * 700, "A" * 600)]
    got = spark.createDataFrame(rows, "s string, p string").select("s", "p", dna.all_indexes("s", "p").alias("at")).collect()
    for r in got:
        assert r["at"] == [i + 1 for i in range(len(r["s"]) + 1) if r["s"].startswith(r["p"], i)], (r["s"][:40], r["p"])
    one = spark.createDataFrame([(long, "AAA")], "s string, p string").select(F.size(dna.all_indexes("s", "p")).alias("n")).first()
    assert one["n"] == len(long) - 2
