"""Exact quantiles of groups of any size, by radix selection.

A double's bits, read so that their order is that of the numbers, are cut into digits of 16 bits. A round counts values by group and
digit, finds the digit that holds each wanted rank, and goes on with the values that have it. Counts are summed before they are
shuffled, so no task holds a group, and a round ends with at most 65536 counts of a group and rank in one place. As soon as no rank
has more than SETTLED values left (or after four rounds, when all values left of a rank are equal) the rest is ordered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonara.operators import checkpointed, unused

BITS, ROUNDS = 16, 4
#: So many values of a group and rank may be ordered in one task.
SETTLED = 1 << 16


def order_key(v: Column) -> Column:
    """A long for each double but NaN, in the order of the numbers; both zeros are 0, infinities are the ends."""
    a = F.abs(v)
    near = F.floor(F.log2(a))  # can be off by one
    part = a / F.pow(F.lit(2.0), near)
    e = near + F.when(part >= 2, 1).when(part < 1, -1).otherwise(0)
    normal = (e + 1023) * F.lit(1 << 52) + ((a / F.pow(F.lit(2.0), e) - 1) * F.lit(2.0**52)).cast("long")
    small = (a / F.lit(2.0**-1074)).cast("long")
    key = F.when(a == float("inf"), F.lit(2047 << 52)).when(a < 2.0**-1022, small).otherwise(normal)
    return F.when(v < 0, -key).otherwise(key)


def digit(key: Column, n: int) -> Column:
    """The n-th digit; the first one is signed."""
    cut = F.shiftright(key, 64 - BITS * (n + 1))
    return (cut if n == 0 else cut.bitwiseAND((1 << BITS) - 1)).cast("int")


def ranked(values: DataFrame, keys: list[str], wanted: DataFrame, most: int, settled: int = SETTLED) -> DataFrame:
    """keys, rank, v: the value at each wanted rank (keys, rank from 0) of its group. values: keys, v, weight (how often v counts), neither
    null nor NaN, cheap to read again. wanted: no rank beyond its group. most: the size of the largest group."""
    on = list(keys)
    same = lambda cols: reduce(lambda c, k: c & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")), cols, F.lit(True))
    left = values.select(*on, F.lit(0).alias("one"), "v", "weight", order_key(F.col("v")).alias("key"))
    todo = checkpointed(wanted.select(*on, "rank", F.col("rank").alias("rest"), F.lit(0).alias("one"), *(F.lit(None).cast("int").alias(f"d{n}") for n in range(ROUNDS))))
    done = 0
    while most > settled and done < ROUNDS:
        known = [f"d{n}" for n in range(done)]
        at = left.select("*", *(digit(F.col("key"), n).alias(f"d{n}") for n in range(done + 1)))
        counts = at.groupBy(*on, "one", *known, f"d{done}").agg(F.sum("weight").alias("n"))
        w = Window.partitionBy(*(f"r.{c}" for c in [*on, "rank"])).orderBy(f"l.d{done}")
        match = counts.alias("l").join(todo.alias("r"), same([*on, "one", *known]))
        summed = match.select("r.*", F.col(f"l.d{done}").alias("digit"), F.col("l.n").alias("n"), (F.sum("l.n").over(w) - F.col("l.n")).alias("before"))
        hit = summed.filter((F.col("rest") >= F.col("before")) & (F.col("rest") < F.col("before") + F.col("n")))
        todo = checkpointed(hit.select(*on, "rank", (F.col("rest") - F.col("before")).alias("rest"), "one", *(F.col("digit").alias(f"d{n}") if n == done else F.col(f"d{n}") for n in range(ROUNDS)), "n"))
        most = todo.agg(F.max("n")).first()[0] or 0
        todo, done = todo.drop("n"), done + 1
        # values that no rank wants any more stay out of the next rounds
        prefix = [f"d{n}" for n in range(done)]
        cut = left.select("*", *(digit(F.col("key"), n).alias(f"d{n}") for n in range(done)))
        left = cut.alias("l").join(todo.select(*on, "one", *prefix).distinct().alias("r"), same([*on, "one", *prefix]), "left_semi").select(*on, "one", "v", "weight", "key")
    prefix = [f"d{n}" for n in range(done)]
    rest = left.select("*", *(digit(F.col("key"), n).alias(f"d{n}") for n in range(done))).groupBy(*on, "one", *prefix, "key").agg(F.min("v").alias("v"), F.sum("weight").alias("n"))
    w = Window.partitionBy(*(f"r.{c}" for c in [*on, "rank"])).orderBy("l.key")
    ends = rest.alias("l").join(todo.alias("r"), same([*on, "one", *prefix])).select(*(f"r.{c}" for c in [*on, "rank", "rest"]), "l.v", "l.n", F.sum("l.n").over(w).alias("upto"))
    return ends.filter((F.col("rest") < F.col("upto")) & (F.col("rest") >= F.col("upto") - F.col("n"))).select(*on, "rank", "v")


def quantiles(values: DataFrame, shares: dict[str, float], *keys: str, weight: str | None = None, settled: int = SETTLED) -> DataFrame:
    """keys and a column for each share (name: share from 0 to 1) with the linear quantile of v. A null is no value; a group without
    values gives no row (without keys there is always one row, of nulls if nothing has a value); a NaN makes its group's quantiles NaN;
    between an infinite and a finite value lies the infinite one. Equal values count each. Other columns and null keys are fine. weight: a column that says how often
    a row's value counts, 0 or more. values is read several times: checkpoint what is costly to make."""
    on = [unused(["one", "weight", "rank", "rest", "v", "key", "n", "digit", "before", "upto", "share", "count", *(f"d{n}" for n in range(ROUNDS))], f"k{k}_") for k in range(len(keys))]
    own = values.filter("v is not null").select(*(F.col(k).alias(o) for k, o in zip(keys, on)), F.col("v").cast("double").alias("v"), (F.col(weight) if weight else F.lit(1)).cast("long").alias("weight")).filter("weight > 0")
    sizes = checkpointed(own.groupBy(*on).agg(F.sum("weight").alias("n"), F.max(F.isnan("v").cast("int")).alias("nan")).filter("n > 0"))
    share = F.array(*(F.struct(F.lit(c).alias("name"), F.lit(float(p)).alias("p")) for c, p in shares.items()))
    at = sizes.select(*on, "nan", "n", F.explode(share).alias("s")).select(*on, "nan", "s.name", ((F.col("n") - 1) * F.col("s.p")).alias("h"))
    at = at.select("*", F.floor("h").alias("lo"), F.ceil("h").alias("hi"))
    wanted = at.filter("nan = 0").select(*on, F.explode(F.array("lo", "hi")).alias("rank")).distinct()
    most = sizes.filter("nan = 0").agg(F.max("n")).first()[0] or 0
    found = checkpointed(ranked(own.filter(~F.isnan("v")), on, wanted, most, settled))
    with_rank = lambda df, name: df.alias("l").join(found.select(*on, F.col("rank").alias(name), F.col("v").alias(f"v_{name}")).alias("r"), reduce(lambda c, k: c & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")), [*on, name], F.lit(True)), "left").select("l.*", f"r.v_{name}")
    both = with_rank(with_rank(at, "lo"), "hi")
    t, a, b = F.col("h") - F.col("lo"), F.col("v_lo"), F.col("v_hi")
    line = F.when(a == b, a).when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (1 - t))
    value = F.when(F.col("nan") == 1, F.lit(float("nan"))).otherwise(line)
    rows = both.groupBy(*on).agg(*(F.max(F.when(F.col("name") == c, value)).alias(c) for c in shares))
    return rows.select(*(F.col(o).alias(k) for k, o in zip(keys, on)), *shares)
