"""Uniform random shards of exact sizes: a drawn matrix says how many rows of each partition go to each shard.

Any columns and types stay as they are and are never compared, so nulls, repeated rows and empty texts are rows like others; columns
named `shard` and `slot` are replaced. An empty table has no rows; with fewer rows than shards some shards are empty. Ties of random
numbers are settled by the place of the row.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonara.llm.common import checkpointed

SHARDS, SEED = 24, 20
#: Partitions whose counts stand in one row, and about how many rows of a shard are ordered together.
BLOCK, BUCKET = 256, 4096


def let(value: Column, use) -> Column:
    """use(value), with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that the parts decide."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 12).cast("double") + 0.5) / F.lit(2.0**52)


def hypergeometric(total: Column, good: Column, n: Column, *key: Column) -> Column:
    """How many of n rows drawn from `total` are among `good` ones. The support is walked from the mode up, then down, as far as double
    precision sees a probability (9 deviations and 30 more); each value replaces the one held with its share of the weight so far."""
    t, g, m = (c.cast("double") for c in (total, good, n))
    spread = F.sqrt(m * (g / t) * (1 - g / t) * (t - m) / F.greatest(t - 1, F.lit(1.0)))
    lo, hi = F.greatest(F.lit(0.0), m - (t - g)), F.least(m, g)
    start = F.struct(F.least(F.greatest(F.floor((m + 1) * (g + 1) / (t + 2)).cast("double"), lo), hi).alias("mode"), F.ceil(9 * spread + 30).alias("reach"), t.alias("t"), g.alias("g"), m.alias("m"))

    def walk(s: Column, up: bool, acc: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            k = s["mode"] + i if up else s["mode"] - i
            ratio = (s["g"] - k) * (s["m"] - k) / ((k + 1) * (s["t"] - s["g"] - s["m"] + k + 1)) if up else k * (s["t"] - s["g"] - s["m"] + k) / ((s["g"] - k + 1) * (s["m"] - k + 1))
            w = a["w"] * ratio  # 0 from the end of the support on
            u = uniform(*key, F.lit(up), i)
            return let(w, lambda w: F.struct(w.alias("w"), (a["sum"] + w).alias("sum"), F.when(u * (a["sum"] + w) < w, k + (1 if up else -1)).otherwise(a["pick"]).alias("pick")))

        return F.aggregate(F.sequence(F.lit(0).cast("long"), s["reach"]), F.struct(F.lit(1.0).alias("w"), acc["sum"].alias("sum"), acc["pick"].alias("pick")), step)

    def drawn(s: Column) -> Column:
        first = F.struct(F.lit(1.0).alias("sum"), s["mode"].alias("pick"))
        return let(walk(s, True, first), lambda a: walk(s, False, a)["pick"]).cast("long")

    return F.when(total <= 0, F.lit(0).cast("long")).when((good == 0) | (n == 0), F.lit(0).cast("long")).when(good == total, n).when(n == total, good).otherwise(let(start, drawn))


def deal(take: Column, total: Column, n: Column, *key: Column) -> Column:
    """How many of n rows, drawn from `total`, each shard gets of what it takes of all: an array like `take`."""
    each = F.transform(take, lambda m, j: F.struct(m.alias("m"), j.alias("j")))
    zero = F.struct(n.alias("n"), total.alias("total"), F.array().cast("array<bigint>").alias("got"))

    def step(a: Column, x: Column) -> Column:
        return let(hypergeometric(a["total"], x["m"], a["n"], *key, x["j"]), lambda k: F.struct((a["n"] - k).alias("n"), (a["total"] - x["m"]).alias("total"), F.concat(a["got"], F.array(k)).alias("got")))

    return F.aggregate(each, zero, step)["got"]


def summed(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda a, x: a + x["n"])


def divided(nodes: DataFrame, levels: int, *key: int) -> DataFrame:
    """id, take: of nodes (items, an array of id and n; take, what each shard takes of them all) the take of each item, by halving
    the items again and again. Halves of one node are independent of other nodes."""
    for _ in range(levels):
        half = F.expr("size(items) div 2")
        cut = nodes.select("items", "take", (F.size("items") > 1).alias("many"), F.slice("items", 1, F.greatest(half, F.lit(1))).alias("left_"), F.slice("items", half + 1, F.size("items")).alias("right_"))
        cut = cut.withColumn("got", F.when(F.col("many"), deal(F.col("take"), summed(F.col("items")), summed(F.col("left_")), *map(F.lit, key), F.col("items")[0]["id"], F.size("items"))))
        rest = F.zip_with("take", "got", lambda a, b: a - b)
        two = F.array(F.struct(F.col("left_").alias("items"), F.col("got").alias("take")), F.struct(F.col("right_").alias("items"), rest.alias("take")))
        nodes = cut.select(F.explode(F.when(F.col("many"), two).otherwise(F.array(F.struct("items", "take")))).alias("x")).select("x.*")
    return nodes.select(F.col("items")[0]["id"].alias("id"), "take")


def matrix(counts: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """part, take: how many rows of each partition (part, n) go to each shard, drawn as a uniform shuffle would deal them. Row sums are
    the partitions' counts; column sums, the shards' sizes, are equal or one apart. First blocks of partitions are dealt, then
    the partitions of each block side by side."""
    items = lambda c: F.sort_array(F.collect_list(F.struct(F.col(c).alias("id"), "n"))).alias("items")
    blocks = counts.groupBy(F.expr(f"part div {BLOCK}").alias("block")).agg(items("part"), F.sum("n").alias("n"))
    sizes = F.expr(f"transform(sequence(0, {shards - 1}), j -> n div {shards} + if(j < n % {shards}, 1L, 0L))")
    root = blocks.agg(items("block"), F.sum("n").alias("n")).filter("n is not null").select("items", sizes.alias("take"))
    n_blocks, largest = blocks.agg(F.count(F.lit(1)), F.max(F.size("items"))).first()
    levels = lambda n: ceil(log2(max(n or 1, 1)))
    of_block = divided(root, levels(n_blocks), seed, 0).withColumnRenamed("id", "block")
    return divided(blocks.join(of_block, "block").select("items", "take"), levels(largest), seed, 1).withColumnRenamed("id", "part")


def shuffled(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All rows with their shard and their slot there, gapless from 0.

    Each partition is put into a random order where it is and written once, with each row's place. From the partitions' sizes the
    matrix is drawn; the row's place in its partition then names its shard. In its shard a row gets a second random number; rows whose
    numbers are near are ordered together, and the counts of those before are added, so no task orders a whole shard. Partitions are
    those that Spark reads; a seed and the same partitions give the same shards, and written rows survive lost executors.
    """
    mixed = docs.drop("shard", "slot").select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at"))
    mixed = mixed.withColumn("ticket", F.xxhash64(F.lit(seed), "at")).sortWithinPartitions("ticket", "at")
    rows = checkpointed(mixed.select("row", F.monotonically_increasing_id().alias("at")))
    rows = rows.select("row", "at", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("place"))
    counts = checkpointed(rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")))
    buckets = max(1, (counts.agg(F.sum("n")).first()[0] or 0) // shards // BUCKET)

    ends = F.expr("transform(take, (x, j) -> aggregate(slice(take, 1, j + 1), 0L, (a, y) -> a + y))")
    dealt = rows.join(checkpointed(matrix(counts, shards, seed).select("part", ends.alias("ends"))), "part")
    number = F.xxhash64(F.lit(seed + 1), "at")
    dealt = dealt.select("row", "at", F.size(F.filter("ends", lambda e: e <= F.col("place"))).alias("shard"), number.alias("number"))
    dealt = dealt.withColumn("bucket", F.shiftright(F.shiftrightunsigned("number", 33) * F.lit(buckets).cast("long"), 31))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n")).select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    order = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("number", "at"))
    return dealt.withColumn("order", order).join(starts, ["shard", "bucket"]).select("row.*", "shard", (F.col("start") + F.col("order") - 1).alias("slot"))


def write(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """The shards as folders of Parquet files, each file a run of slots in order."""
    shuffled(docs, shards, seed).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and where each row lies; texts are not moved. A null text has size 8 and the checksum of no bytes."""
    data = F.coalesce("text", F.lit("")).cast("binary")
    slim = docs.select("doc_id", (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    return shuffled(slim).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
