"""Exact quantiles by radix selection, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonara.operators import quantiles as q
from zonara.operators import stats

SHARES = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 1.0, "f": 0.137}
INF, NAN = float("inf"), float("nan")


def of(spark, groups):
    return spark.createDataFrame([(k, None if x is None else float(x), "x") for k, own in groups.items() for x in own], "k string, v double, rank string").repartition(5)


def test_order_key_has_the_order_of_the_numbers(spark):
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 1 << 64, 4000, dtype=np.uint64).view(np.float64)
    edge = [0.0, 5e-324, 2.0**-1074 * 7, 2.0**-1022, np.nextafter(2.0**-1022, 0), 1.0, np.nextafter(1, 0), np.nextafter(1, 2), 8.0, np.nextafter(8, 0), 1.7976931348623157e308, INF, 0.1, 1e-300]
    v = np.unique(np.concatenate([bits[~np.isnan(bits)], edge, [-x for x in edge]]))
    got = spark.createDataFrame([(float(x),) for x in v], "v double").select("v", q.order_key(F.col("v")).alias("k")).collect()
    by = sorted(got, key=lambda r: r.v)
    keys = [r.k for r in by]
    assert all(a < b for a, b in zip(keys, keys[1:]))
    assert spark.sql("select -0.0D as v").select(q.order_key(F.col("v"))).head()[0] == 0


@pytest.mark.parametrize("settled", [1, 8, 1 << 16])
def test_quantiles_as_numpy(spark, settled):
    rng = np.random.default_rng(1)
    groups = {
        "normal": rng.normal(size=700), "ties": rng.integers(0, 4, 300), "one": [3.5], "two": [-1.0, 4.0], "equal": [7.25] * 200, "wide": np.exp(rng.normal(size=200) * 120), "near": 1 + rng.integers(0, 9, 100) * 2.0**-52,
        "signs": [-0.0, 0.0, -5e-324, 5e-324, -2.5, 2.5], "nulls": [None, 1.0, None, 2.0], "ends": [-INF, 1.0, 2.0, 3.0, 4.0, 5.0, INF],
    }
    df = of(spark, groups | {"nan": [1.0, NAN, 2.0], "none": [None, None]})
    got = {r.k: r for r in q.quantiles(df, SHARES, "k", settled=settled).collect()}
    assert set(got) == set(groups) | {"nan"} and all(np.isnan(getattr(got["nan"], c)) for c in SHARES)
    for k, own in groups.items():
        own = np.array([x for x in own if x is not None], float)
        for c, p in SHARES.items():
            if k != "ends" or c in "bcd":  # numpy has a NaN where it goes from an infinite value on
                assert getattr(got[k], c) == np.percentile(own, 100 * p), (k, c)


def test_quantiles_without_keys_of_null_keys_and_of_nothing(spark):
    df = of(spark, {"a": range(50), None: range(100, 131)})
    got = {r.k: r.m for r in q.quantiles(df, {"m": 0.5}, "k", settled=4).collect()}
    assert got == {"a": 24.5, None: 115.0}
    assert q.quantiles(df, {"m": 0.5}, settled=4).head().m == np.median([*range(50), *range(100, 131)])
    assert q.quantiles(df, {"m": 0.5}, "rank", settled=4).columns == ["rank", "m"]  # a key named like a column of its own
    assert q.quantiles(df.limit(0), {"m": 0.5}, "k").count() == 0 and q.quantiles(df.limit(0), {"m": 0.5}).head().m is None


def test_no_task_holds_a_group(spark):
    # a constant and a dense group of 200000 values: what is ordered together stays below the bound plus one row a digit
    df = spark.range(200_000, numPartitions=8).select((F.col("id") % 2).alias("k"), F.when(F.col("id") % 2 == 0, F.lit(1.5)).otherwise(F.col("id") / 7).alias("v"))
    seen = []
    kept, q.checkpointed = q.checkpointed, lambda d: seen.append(d) or kept(d)
    try:
        got = {r.k: (r.m, r.p) for r in q.quantiles(df, {"m": 0.5, "p": 0.9}, "k", settled=100).collect()}
    finally:
        q.checkpointed = kept
    odd = np.arange(1, 200_000, 2) / 7
    assert got == {0: (1.5, 1.5), 1: (np.percentile(odd, 50), np.percentile(odd, 90))}
    assert len(seen) >= 4  # sizes, ranks, and a round or more


def test_summary_counts_no_nulls(spark):
    df = of(spark, {"a": [1.0, None, -3.0], "none": [None], "nan": [NAN, 1.0]})
    got = {r.k: r for r in stats.summary(df, "k").collect()}
    assert tuple(got["a"])[1:] == (2, -1.0, 2.0, 1.0, -3.0, -2.0, -1.0, 0.0)
    assert tuple(got["none"])[1:] == (0, *[None] * 7)
    assert got["nan"].n == 2 and all(np.isnan(x) for x in tuple(got["nan"])[2:])
    assert stats.summary(df).head().n == 4
