"""Flood fill of each zone from its centroid: a window in a task, or windows of any size over many."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonara.operators import checkpointed


def mask(width: int, height: int, seed: tuple[int, int], xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """The filled pixels [height, width], 4-connected from the seed, which is always in; walls (xs, ys) and the edge stop it. Runs of
    a line are filled at once."""
    if not (0 <= seed[0] < width and 0 <= seed[1] < height):
        raise ValueError(f"the seed {seed} is outside the {width} x {height} window")
    open_ = np.ones((height, width), bool)
    inside = (xs >= 0) & (xs < width) & (ys >= 0) & (ys < height)
    open_[ys[inside], xs[inside]] = False
    open_[seed[1], seed[0]] = True
    out, stack = np.zeros_like(open_), [seed]
    while stack:
        x, y = stack.pop()
        if not open_[y, x]:
            continue
        walls = np.flatnonzero(~open_[y])
        k = int(np.searchsorted(walls, x))
        lo, hi = (int(walls[k - 1]) + 1 if k else 0), (int(walls[k]) if k < len(walls) else width)
        out[y, lo:hi], open_[y, lo:hi] = True, False
        for line in (y - 1, y + 1):
            if 0 <= line < height:
                part = open_[line, lo:hi]
                stack += [(lo + int(a), line) for a in np.flatnonzero(part & ~np.concatenate([[False], part[:-1]]))]
    return out


def filled(width: int, height: int, seed: tuple[int, int], walls: set[tuple[int, int]]) -> list[tuple[int, int]]:
    xs, ys = (np.array([w[k] for w in walls], np.int64) for k in (0, 1))
    return sorted((int(x), int(y)) for y, x in zip(*mask(width, height, seed, xs, ys).nonzero()))


def blocks(filled: np.ndarray, factor: int) -> np.ndarray:
    """How many pixels of each block of factor x factor are filled."""
    h, w = (-(-n // factor) * factor for n in filled.shape)
    whole = np.zeros((h, w), np.int64)
    whole[: filled.shape[0], : filled.shape[1]] = filled
    return whole.reshape(h // factor, factor, w // factor, factor).sum((1, 3))


def flood_fill(border: DataFrame, seeds: DataFrame, factor: int | None = None) -> DataFrame:
    """zone, x, y. seeds: zone, x, y, width, height. Zones run side by side; a task holds one zone's window, no raster values.
    A zone without border is an error, not a zone less. A caller may give other seeds than the centroids. With a factor the pixels are
    those of an upscaled window, and what comes back are source pixels and their weight: how many of the factor x factor pixels of
    each are filled. Windows beyond a task: `flood_fill_runs`."""

    def one(walls: pd.DataFrame, seed: pd.DataFrame) -> pd.DataFrame:
        if seed.empty or walls.empty:
            raise ValueError(f"empty border or no seed: {(seed if len(seed) else walls).zone.iloc[0]}")
        s = seed.iloc[0]
        found = mask(int(s.width), int(s.height), (int(s.x), int(s.y)), walls.x.to_numpy(), walls.y.to_numpy())
        found = blocks(found, factor) if factor else found
        ys, xs = found.nonzero()
        weight = {"weight": found[ys, xs]} if factor else {}
        return pd.DataFrame({"zone": [s.zone] * len(xs), "x": xs.astype("int32"), "y": ys.astype("int32"), **weight})

    kind = dict(border.dtypes)["zone"]
    own = seeds.select(F.col("zone").alias("zone"), "x", "y", "width", "height")  # both sides can come from one table
    return border.select("zone", "x", "y").distinct().groupBy("zone").cogroup(own.groupBy("zone")).applyInPandas(one, f"zone {kind}, x int, y int" + ", weight long" * bool(factor))


def open_runs(border: DataFrame, seeds: DataFrame) -> DataFrame:
    """zone, y, lo, hi, seeded, whole: the runs of open pixels of each line of each zone's window, hi exclusive; whole is a line without
    a wall. Rows grow with the border and the lines, not with the window's area. A seed's pixel is open even where a border runs over it, as in `mask`."""
    outside = (F.col("x") < 0) | (F.col("x") >= F.col("width")) | (F.col("y") < 0) | (F.col("y") >= F.col("height"))
    seed = F.when(outside, F.raise_error(F.concat(F.lit("the seed is outside the window: zone "), F.col("zone").cast("string"))).cast("int")).otherwise(F.col("x"))
    own = seeds.select("zone", seed.alias("sx"), F.col("y").alias("sy"), "width", "height")
    walls = border.select("zone", "x", "y").distinct().join(own, "zone").filter("x >= 0 and x < width and y >= 0 and y < height and not (x = sx and y = sy)").select("zone", "y", "x")
    lines = own.select("zone", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("y"), "width", F.when(F.col("y") == F.col("sy"), F.col("sx")).alias("seed"))
    ends = walls.unionByName(lines.select("zone", "y", F.explode(F.array(F.lit(-1), F.col("width"))).alias("x")))
    w = Window.partitionBy("zone", "y").orderBy("x")
    gaps = ends.select("zone", "y", (F.col("x") + 1).alias("lo"), F.lead("x").over(w).alias("hi")).filter("hi > lo")
    inside = (F.col("seed") >= F.col("lo")) & (F.col("seed") < F.col("hi"))
    whole = (F.col("lo") == 0) & (F.col("hi") == F.col("width"))
    return gaps.join(lines.select("zone", "y", "seed", "width"), ["zone", "y"]).select("zone", "y", "lo", "hi", F.coalesce(inside, F.lit(False)).alias("seeded"), whole.alias("whole"))


def numbered(runs: DataFrame) -> DataFrame:
    """Runs with an id; neighbouring lines without a wall are one node and share theirs, so the graph grows with the border alone."""
    first = runs.withColumn("id", F.monotonically_increasing_id()).withColumn("isle", F.col("y") - F.row_number().over(Window.partitionBy("zone", "whole").orderBy("y", "lo")))
    shared = F.min("id").over(Window.partitionBy("zone", "whole", "isle"))
    return first.withColumn("id", F.when(F.col("whole"), shared).otherwise(F.col("id"))).drop("isle")


def touching(runs: DataFrame) -> DataFrame:
    """zone, a, b: ids of runs of neighbouring lines with a column in common. Of two such runs one begins inside the other, so one pass
    over the runs of two lines in order of their starts finds all pairs; no run is held against all others of a line."""
    both = runs.select("zone", "id", "lo", "hi", F.explode(F.array(F.struct(F.col("y").alias("line"), F.lit(True).alias("upper")), F.struct((F.col("y") - 1).alias("line"), F.lit(False).alias("upper")))).alias("at")).select("zone", "id", "lo", "hi", "at.*")
    w = Window.partitionBy("zone", "line").orderBy("lo").rangeBetween(Window.unboundedPreceding, 0)
    last = lambda upper: F.last(F.when(F.col("upper") == upper, F.struct("id", "hi")), ignorenulls=True).over(w)
    met = both.withColumns({"up": last(True), "down": last(False)}).withColumn("other", F.when(F.col("upper"), F.col("down")).otherwise(F.col("up")))
    return met.filter("other.hi > lo and other.id <> id").select("zone", F.least("id", "other.id").alias("a"), F.greatest("id", "other.id").alias("b")).distinct()


def contracted(edges: DataFrame) -> DataFrame:
    """zone, id, root: the smallest id of the component of each id that has an edge (zone, a < b), by contraction in turns: every node
    takes its larger neighbours to the smallest node it knows, then its smaller ones, until all are tied to their root (few rounds
    more than the logarithm of the nodes). Each round is written; a node's neighbours are aggregated, and never joined in pairs."""
    now, sign = checkpointed(edges.select("zone", "a", "b")), None
    while True:
        # large turn: b's above the node go to its least neighbour or itself
        ways = now.select("zone", F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("zone", F.col("b").alias("u"), F.col("a").alias("v")))
        least = ways.groupBy("zone", "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = ways.filter("v > u").join(least, ["zone", "u"]).select("zone", F.col("m").alias("a"), F.col("v").alias("b"))
        # small turn: a node and its smaller neighbours go to the least of them
        large = checkpointed(large.filter("a <> b").distinct())
        least = large.groupBy("zone", F.col("b").alias("u")).agg(F.min("a").alias("m"))
        small = large.withColumnRenamed("b", "u").join(least, ["zone", "u"]).select("zone", F.col("m").alias("a"), F.explode(F.array("u", "a")).alias("b"))
        now = checkpointed(small.filter("a <> b").distinct())
        new = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("zone", "a", "b").cast("decimal(38, 0)"))).first())
        if new == sign:
            return now.select("zone", F.col("b").alias("id"), F.col("a").alias("root"))
        sign = new


def flood_fill_runs(border: DataFrame, seeds: DataFrame) -> DataFrame:
    """The same pixels as `flood_fill`, for windows of any size: no task holds a window. Lines are cut into runs of open pixels, runs of
    neighbouring lines that touch are edges, components are found by contraction, and the runs of the seed's component are spread
    to pixels at the end. Rows: a run for each wall pixel and line at most, and no more edges than twice that.
    Without zones there are no rows; a seed outside its window, or a zone without border or without seed, is an error."""
    sides = border.select("zone", F.lit(1).alias("b")).unionByName(seeds.select("zone", F.lit(0).alias("b"))).groupBy("zone").agg(F.min("b").alias("lo"), F.max("b").alias("hi"))
    if missing := sides.filter("lo = hi").first():
        raise ValueError(f"empty border or no seed: {missing.zone}")
    runs = checkpointed(numbered(checkpointed(open_runs(border, seeds))))
    root = contracted(touching(runs))
    tied = runs.join(root, ["zone", "id"], "left").withColumn("root", F.coalesce("root", "id"))
    own = tied.filter("seeded").select("zone", "root")
    return tied.join(own, ["zone", "root"]).select("zone", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("x"), "y")
