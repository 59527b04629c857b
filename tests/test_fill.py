"""The fill over many tasks, against the fill in one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonara.operators import fill


def frames(spark, windows):
    """windows: zone -> (width, height, seed, walls)"""
    walls = [(z, 0, k, int(x), int(y)) for z, (_, _, _, own) in windows.items() for k, (x, y) in enumerate(sorted(own))]
    seeds = [(z, int(s[0]), int(s[1]), w, h) for z, (w, h, s, _) in windows.items()]
    return spark.createDataFrame(walls, "zone string, seq int, k int, x int, y int"), spark.createDataFrame(seeds, "zone string, x int, y int, width int, height int")


def spiral(n):
    """Walls that leave one path into the middle."""
    walls, lo, hi = set(), 1, n - 2
    while hi - lo > 2:
        walls |= {(x, lo) for x in range(lo - 1 if lo > 1 else 0, hi + 1)} | {(hi, y) for y in range(lo, hi + 1)} | {(x, hi) for x in range(lo, hi + 1)} | {(lo, y) for y in range(lo + 2, hi + 1)}
        lo, hi = lo + 2, hi - 2
    return walls


def test_fill_over_tasks_equals_fill_in_a_task(spark):
    rng = np.random.default_rng(7)
    windows = {}
    for k in range(40):
        w, h = (int(x) for x in rng.integers(1, 16, 2))
        n = max(1, int(w * h * rng.choice([0.1, 0.35, 0.6])))
        windows[f"z{k}"] = w, h, (int(rng.integers(w)), int(rng.integers(h))), {(int(x), int(y)) for x, y in zip(rng.integers(-2, w + 2, n), rng.integers(-2, h + 2, n))}
    windows["spiral"] = 40, 40, (0, 0), spiral(40)
    windows["comb"] = 30, 9, (29, 8), {(x, y) for x in range(1, 30, 2) for y in range(8)}
    windows["far walls"] = 5, 4, (2, 2), {(100, 100), (-1, 0)}
    windows["seed on a wall"] = 6, 6, (3, 3), {(x, y) for x in range(6) for y in range(6)}
    border, seeds = frames(spark, windows)
    got = {}
    for r in fill.flood_fill_runs(border, seeds).collect():
        got.setdefault(r.zone, []).append((r.x, r.y))
    assert {z: sorted(own) for z, own in got.items()} == {z: fill.filled(w, h, s, own) for z, (w, h, s, own) in windows.items()}
    assert got["seed on a wall"] == [(3, 3)] and len(got["far walls"]) == 20


def test_fill_over_tasks_rows_grow_with_the_border(spark):
    n = 400
    ring = {(x, y) for x in range(50, 351) for y in (50, 350)} | {(x, y) for x in (50, 350) for y in range(50, 351)}
    border, seeds = frames(spark, {"a": (n, n, (100, 100), ring)})
    runs = fill.numbered(fill.open_runs(border, seeds)).cache()
    assert runs.count() <= len(ring) + n and fill.touching(runs).count() <= 2 * runs.count()
    assert runs.select("id").distinct().count() <= len(ring) + 2  # lines above and below the ring are two nodes
    assert fill.flood_fill_runs(border, seeds).count() == 299 * 299


def test_fill_over_tasks_names_what_is_missing(spark):
    border, seeds = frames(spark, {"a": (4, 4, (1, 1), {(0, 0)}), "b": (4, 4, (1, 1), {(0, 0)})})
    for b, s in ((border.filter("zone = 'a'"), seeds), (border, seeds.filter("zone = 'a'"))):
        with pytest.raises(Exception, match="empty border or no seed: b"):
            fill.flood_fill_runs(b, s).collect()
    with pytest.raises(Exception, match="outside the window: zone a"):
        fill.flood_fill_runs(border.filter("zone = 'a'"), seeds.filter("zone = 'a'").withColumn("x", F.lit(4))).collect()
    assert fill.flood_fill_runs(border.limit(0), seeds.limit(0)).count() == 0
