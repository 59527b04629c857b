"""Statistics and histograms of a value by group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonara.operators import checkpointed, unused
from zonara.operators.quantiles import quantiles

BINS = 50
SHARES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def same(keys: list[str] | tuple[str, ...]):
    """l and r have equal keys, null ones included."""
    return reduce(lambda c, k: c & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")), keys, F.lit(True))


def summary(values: DataFrame, *keys: str, weight: str | None = None) -> DataFrame:
    """n, mean, std (of the population), max, min and exact linear percentiles; a NaN makes all but n NaN. Nulls are not counted: a
    group of nulls has n = 0 and nulls. weight: a column that says how often a row's value counts. The values are written once (the
    keys, one double and the weight a row) and then read for each round."""
    own = checkpointed(values.select(*keys, "v", *([weight] if weight else [])))
    nan = F.max(F.isnan("v").cast("int")) == 1
    if weight is None:
        n, each = F.count("v"), {"mean": F.avg("v"), "std": F.stddev_pop("v")}
        moments = own
    else:
        own = own.filter(F.col("v").isNull() | (F.col(weight) > 0))
        n, w = F.sum(F.when(F.col("v").isNotNull(), F.col(weight)).otherwise(F.lit(0))), F.col(weight)
        means = own.groupBy(*keys).agg((F.sum(F.col("v") * w) / F.sum(F.when(F.col("v").isNotNull(), w))).alias("mean_"))
        moments = own.alias("l").join(means.alias("r"), same(keys)).select("l.*", "r.mean_")
        each = {"mean": F.max("mean_"), "std": F.sqrt(F.sum(F.pow(F.col("v") - F.col("mean_"), 2) * w) / F.sum(F.when(F.col("v").isNotNull(), w)))}
    each |= {"max": F.max("v"), "min": F.min("v")}
    moments = moments.groupBy(*keys).agg(n.cast("long").alias("n"), *(F.when(nan, F.lit(float("nan"))).otherwise(e).alias(k) for k, e in each.items()))
    parts = quantiles(own, SHARES, *keys, weight=weight)
    return moments.alias("l").join(parts.alias("r"), same(keys), "left").select("l.*", *(f"r.{c}" for c in SHARES))


def histogram(values: DataFrame, *keys: str, bins: int = BINS) -> DataFrame:
    """bin, lo, hi, n for every bin between a group's least and largest value, the last closed; one value alone lies in the
    middle of a range one wide. Nulls are not counted; a NaN or an infinite value is an error. Other columns are ignored, and
    counts are summed by bin before they meet the edges. Values are written once (the keys and one double a row), so that what makes
    them runs once, and read twice: for the edges and for the counts."""
    return binned(values.select(*keys, "v", F.lit(1).cast("long").alias(unused(keys, "weight"))), *keys, bins=bins)


def binned(values: DataFrame, *keys: str, bins: int = BINS) -> DataFrame:
    """The histogram of values whose last column says how often each counts."""
    v, weight, edge, at = (unused([*keys, "bin", "lo", "hi", "n"], c) for c in ("v", "weight", "edge", "at"))
    odd = F.isnan("v") | (F.abs("v") == F.lit(float("inf")))
    finite = F.when(odd, F.raise_error(F.lit("a histogram needs finite values")).cast("double")).otherwise(F.col("v"))
    clean = checkpointed(values.filter("v is not null").select(*keys, finite.alias(v), F.col(values.columns[-1]).alias(weight)))
    a, b = F.min(v), F.max(v)
    half = F.when(a == b, F.lit(0.5)).otherwise(F.lit(0.0))
    edges = clean.groupBy(*keys).agg(F.struct((a - half).alias("a"), (b + half).alias("b")).alias(edge)).filter(F.col(f"{edge}.a").isNotNull())
    both = clean.join(edges, list(keys)) if keys else clean.crossJoin(F.broadcast(edges))  # without keys one row
    lo, hi = F.col(f"{edge}.a"), F.col(f"{edge}.b")
    counts = both.groupBy(*keys, F.least(F.floor((F.col(v) - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.sum(weight).alias(at))
    every = edges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (hi - lo) / bins
    return every.join(counts, [*keys, "bin"], "left").select(*keys, "bin", (lo + F.col("bin") * width).alias("lo"), (lo + (F.col("bin") + 1) * width).alias("hi"), F.coalesce(at, F.lit(0)).alias("n"))


def gather(zone_cells: DataFrame, packed: DataFrame) -> DataFrame:
    """zone, y, x, v: the values of each zone's pixels. packed: raster lines (y, row), which are never exploded; the zones' pixels
    meet them by line."""
    return zone_cells.join(packed.select("y", "row"), "y").select("zone", "y", "x", F.element_at("row", F.col("x") + 1).cast("double").alias("v"))


def gather_weighted(weights: DataFrame, windows: DataFrame) -> DataFrame:
    """zone, y, x, v, weight of source pixels. weights: zone, y, x, weight, how many of a source pixel's upscaled pixels belong to the
    zone (`fill.flood_fill` with a factor); windows: zone, y, x, v. No row stands for an upscaled pixel."""
    return weights.join(windows, ["zone", "y", "x"]).select("zone", "y", "x", "v", "weight")


def gather_upscaled(zone_cells: DataFrame, windows: DataFrame, factor: int) -> DataFrame:
    """zone, y, x, v of pixels in upscaled coordinates. windows: zone, y, x, v in source pixels of the zone's crop; a value stands
    for factor x factor pixels and is not repeated before the join."""
    at = zone_cells.select("zone", "y", "x", F.expr(f"y div {factor}").cast("int").alias("sy"), F.expr(f"x div {factor}").cast("int").alias("sx"))
    return at.join(windows.select("zone", F.col("y").alias("sy"), F.col("x").alias("sx"), "v"), ["zone", "sy", "sx"]).select("zone", "y", "x", "v")
