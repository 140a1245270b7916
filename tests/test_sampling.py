"""Samples and splits against brute force."""

import math

import pytest
from conftest import plan_of, same_rows
from pyspark.sql import functions as F

from wxspark.functions.draws import draw_bits
from wxspark.operators import sampling


def smallest(df, salt, k):
    drawn = df.select("id", draw_bits(F.col("id"), salt).alias("bits")).collect()
    return {r.id for r in sorted(drawn, key=lambda r: (r.bits, r.id))[:k]}


@pytest.mark.parametrize("rows, size", [(5_000, 1), (5_000, 777), (5_000, 4_999), (5_000, 5_000), (5_000, 9_999), (3, 2), (0, 2)])
def test_sample_exact(spark, rows, size):
    df = spark.range(rows)
    got = [r.id for r in sampling.sample_exact(df, size).collect()]
    assert len(got) == min(rows, size)
    assert set(got) == smallest(df, sampling.SAMPLE_SALT, size)


def test_sample_does_not_gather_rows(spark):
    plan = plan_of(sampling.sample_exact(spark.range(1_000), 10))
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan


@pytest.mark.parametrize("rows", [1, 4, 5, 6, 1_001])
def test_split_exact(spark, rows):
    df = spark.range(rows)
    flagged = sampling.split_exact(df).collect()
    test = {r.id for r in flagged if r.is_test}
    assert len(flagged) == rows
    assert len(test) == math.ceil(0.2 * rows)
    assert test == smallest(df, sampling.SPLIT_SALT, len(test))


def test_split_exact_of_a_sample(spark):
    sample = sampling.sample_exact(spark.range(25_000), 10_000)
    counts = {r.is_test: r["count"] for r in sampling.split_exact(sample).groupBy("is_test").count().collect()}
    assert counts == {True: 2_000, False: 8_000}


def test_split_bucket_is_narrow_and_layout_free(spark):
    def split(p):
        return sampling.split_bucket(spark.range(0, 20_000, 1, p))

    assert "Exchange" not in plan_of(split(3))
    assert same_rows(split(1), split(7))
    assert abs(split(2).where("is_test").count() / 20_000 - 0.2) < 0.01


def test_head(spark):
    df = spark.range(0, 100, 1, 9).repartition(9)
    assert [r.id for r in sampling.head(df).collect()] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("size", [0, 1, 99, 100, 101])
def test_sample_edges(spark, size):
    df = spark.range(100)
    assert sampling.sample_exact(df, size).count() == min(size, 100)


@pytest.mark.parametrize("fraction", [0, 1])
def test_split_edges(spark, fraction):
    assert sampling.split_exact(spark.range(50), fraction=fraction).where("is_test").count() == 50 * fraction
    assert sampling.split_exact(spark.range(0), fraction=fraction).count() == 0


def test_impossible_sizes_fail(spark):
    with pytest.raises(ValueError, match="negative"):
        sampling.sample_exact(spark.range(5), -1)
    with pytest.raises(ValueError, match="between 0 and 1"):
        sampling.split_exact(spark.range(5), fraction=1.5)


def test_a_repeated_key_at_the_cut_fails(spark):
    doubled = spark.range(500).union(spark.range(500))
    with pytest.raises(ValueError, match="repeats"):
        sampling.sample_exact(doubled, 501)
    assert sampling.sample_exact(doubled, 500).count() == 500  # the cut lies between two keys


def test_the_cut_is_a_literal(spark):
    """Later passes read the source once, without a search for the cut."""
    plan = plan_of(sampling.split_exact(spark.range(1_000)))
    assert plan.count("Range (") == 1 and "Exchange" not in plan and "ubquery" not in plan
