"""Intervals in bins of several widths against a plain comparison of all couples."""

import random

import pytest
from pyspark.sql import functions as F

from strandframe.operators import alignments as A
from strandframe.operators import bins as B


def test_couples(spark):
    rnd = random.Random(5)

    def interval():
        beg = rnd.choice([rnd.randint(0, 300_000), rnd.randint(0, 1 << 33), 4096 * rnd.randint(0, 70), 131072 * rnd.randint(0, 3)])
        return beg, beg + rnd.choice([0, 1, 40, 4095, 4096, 200_000, 1 << 20, 1 << 34])

    features = [(rnd.choice("ab"), *interval(), i) for i in range(400)]
    regions = [(rnd.choice("abc"), *interval()) for _ in range(150)] + [("a", 1, 1 << 60), ("b", 1, 1 << 42), ("a", 7, 7), ("a", 7, 7)]
    left = spark.createDataFrame(features, "rname string, beg bigint, end bigint, i int")
    right = spark.createDataFrame(regions, "name string, beg bigint, end bigint")
    got = sorted((r["i"], r["r_beg"], r["r_end"]) for r in A.overlap(left, right).collect())
    assert got == sorted((i, b, e) for n, x, y, i in features for m, b, e in regions if n == m and x <= e and y >= b)


def test_rows_are_bounded(spark):
    sizes = spark.range(1).select(*[F.size(B.region_nodes(F.lit(7).cast("bigint"), F.lit(e).cast("bigint"))).alias(str(e)) for e in (7, 5000, 1 << 28, 1 << 40)]).first()
    assert sizes[0] <= 8 and sizes[1] <= 16 and sizes[2] < 250 and sizes[3] < 450


def test_open_region(spark):
    left = spark.createDataFrame([("a", 5, 9), ("a", 50, 60)], "rname string, beg bigint, end bigint")
    right = spark.createDataFrame([("a", 10, None)], "name string, beg bigint, end bigint")
    sizes = spark.createDataFrame([("a", 100)], "name string, length bigint")
    assert [tuple(r) for r in A.overlap(left, right, lengths=sizes).collect()] == [("a", 50, 60, 10, 100)]
    with pytest.raises(Exception, match="open region"):
        A.overlap(left, right).collect()
