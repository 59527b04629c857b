import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from zonara import sources
from zonara.operators import fill, geometry, raster, series, stats
from zonara.plans import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def cells(spark, rows):
    return spark.createDataFrame([(y, x, float(v)) for y, r in enumerate(rows) for x, v in enumerate(r)], "y int, x int, v double")


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(SQL) == set(QUERIES) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for f in os.listdir(SF):
        con.sql(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    want = con.sql(SQL[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    c = sorted(want.columns)
    assert sorted(got.columns) == c
    got, want = (d[c].sort_values(c).reset_index(drop=True) for d in (got, want))
    assert len(got) == len(want) and all(got[k].equals(want[k].astype(got[k].dtype)) for k in c)


def test_upscale_and_clip(spark):
    up = raster.upscale(cells(spark, [[1, 2], [3, 4]])).collect()
    assert {(r.y, r.x): r.v for r in up} == {(y, x): float(1 + 2 * (y // 2) + x // 2) for y in range(4) for x in range(4)}
    assert {r.v for r in raster.clip(cells(spark, [[-3, -1]])).collect()} == {-1.0}
    assert all(np.isnan(r.v) for r in raster.clip(cells(spark, [[1, float("nan")]])).collect())
    with pytest.raises(ValueError):
        raster.crop(cells(spark, [[1]]), -1, 1, 0, 1)


def test_clip_and_upscale_take_the_whole_raster(spark):
    every = {(r.y, r.x) for r in QUERIES["raster_cells"](spark, SF).collect()}
    assert {(r.y, r.x) for r in QUERIES["raster_clip_all"](spark, SF).collect()} == every
    assert {(r.y // 2, r.x // 2) for r in QUERIES["raster_upscale_all"](spark, SF).collect()} == every and QUERIES["raster_upscale_all"](spark, SF).count() == 4 * len(every)


def test_summary_and_histogram_as_numpy(spark):
    v = np.random.default_rng(1).normal(size=500)
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    got = stats.summary(df).head()
    assert np.allclose([got.mean, got.std, got.p25, got.p50, got.p75], [v.mean(), v.std(), *np.percentile(v, [25, 50, 75])])
    assert [r.n for r in stats.histogram(df).orderBy("bin").collect()] == np.histogram(v, 50)[0].tolist()
    flat = stats.histogram(spark.createDataFrame([(2.0,)] * 3, "v double")).filter("n > 0").head()
    assert (flat.bin, flat.n) == (25, 3)


def test_square_centroid_and_fill(spark):
    square = [(0, 0), (4, 0), (4, 4), (0, 4)]
    border = spark.createDataFrame([("a", 0, k, x, y) for k, (x, y) in enumerate(square)], "zone string, seq int, k int, x int, y int")
    c = geometry.centroid(border).head()
    assert (c.cx, c.cy) == (2.0, 2.0)
    wall = {(x, y) for x in range(5) for y in range(5) if x in (0, 4) or y in (0, 4)}
    assert fill.filled(8, 8, (2, 2), wall) == [(x, y) for x in range(1, 4) for y in range(1, 4)]
    assert (0, 0) in fill.filled(8, 8, (0, 0), wall)
    with pytest.raises(ValueError):
        fill.filled(8, 8, (9, 0), wall)


def test_vertical_segment_is_an_error(spark):
    v = spark.createDataFrame([("a", 0, 1.0, 1.0), ("a", 1, 1.0, 5.0)], "zone string, seq int, x double, y double")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        geometry.densify(v).collect()


def test_vertical_segments_by_choice(spark):
    v = spark.createDataFrame([("a", 0, 1.0, 1.0), ("a", 1, 1.0, 5.0), ("a", 2, 9.0, 5.0)], "zone string, seq int, x double, y double")
    straight = geometry.densify(v, vertical="straight").orderBy("seq", "k").collect()
    assert [(r.x, r.y) for r in straight[:100]] == [(1, int(y)) for y in np.linspace(1, 5, 100)] and len(straight) == 200
    assert {r.seq for r in geometry.densify(v, vertical="skip").collect()} == {1}
    with pytest.raises(ValueError):
        geometry.densify(v, vertical="no")


def test_physical_values(spark):
    df = spark.createDataFrame([(0, 0, 10.0), (0, 1, -999.0), (0, 2, None)], "y int, x int, v double")
    assert [r.v for r in raster.physical(df, 0.5, -999.0).orderBy("x").collect()] == [5.0, None, None]
    assert [r.v for r in raster.physical(df).orderBy("x").collect()] == [10.0, -999.0, None]


def test_statement_equals_the_dataframe_chain(spark):
    from zonara.plans import queries, statements

    every = {r.zone: r for r in QUERIES["zonal_stats_upscaled"](spark, SF).collect()}
    for zone, factor in ((3, 2), (11, 3)):
        got = statements.zone_statistics(queries.pixels(spark, SF), queries.packed(spark, SF), zone, factor).collect()
        want = every[zone] if factor == 2 else stats.summary(queries.upscaled_values(spark, SF, 3), "zone", weight="weight").filter(F.col("zone") == zone).head()
        assert len(got) == 1 and got[0].zone == zone and got[0].n == want.n and np.allclose(got[0][2:], want[2:], atol=1e-6)
    none = statements.zone_statistics(queries.pixels(spark, SF), queries.packed(spark, SF), 99)
    with pytest.raises(Exception, match="no outline"):
        none.collect()


def test_folder_of_tables_as_a_grid(spark, tmp_path):
    lines(spark, np.arange(60.0).reshape(30, 2)).repartition(1).sortWithinPartitions("y").write.option("parquet.block.size", 64).parquet(str(tmp_path / "r.parquet"))
    spark.range(3).write.parquet(str(tmp_path / "n.parquet"))
    folder = sources.ParquetFolder(str(tmp_path))
    assert list(sources.tree(folder)) == [(0, "n", True), (1, "id", False), (0, "r", True), (1, "y", False), (1, "row", False)]
    column = folder["r/row"]
    assert column.shape == (30,) and column[4:17].tolist() == [[2.0 * y, 2.0 * y + 1] for y in range(4, 17)]
    rows = sources.grid(spark, str(tmp_path), opener="parquet", dataset="r/row", lines="8")
    assert [tuple(r) for r in rows.orderBy("y").collect()] == [(y, [2.0 * y, 2.0 * y + 1]) for y in range(30)] and rows.rdd.getNumPartitions() >= 4
    assert rows.filter("y >= 10 and y < 13").rdd.getNumPartitions() <= 2 and rows.filter("y = 29").head().row == [58.0, 59.0]
    assert "row" in sources.grid(spark, str(tmp_path), opener="parquet", dataset="r", mode="metadata").head().text


def test_series_of_the_shipped_form(spark, tmp_path):
    periods = [*map(str, range(2003, 2022)), "2022 R", "2023 P"]
    rows = {"Estados Unidos": [f"{k + 1}.5" if k == 0 else f"{k + 1}E+15" if k % 3 else str(1000 + k) for k in range(21)], "Ciudad de México": [str(k + 1) for k in range(21)]}
    (tmp_path / "p.csv").write_bytes(("\ufeffConcepto;" + ";".join(periods) + "\r\n" + "".join(f"{k};" + ";".join(v) + "\r\n" for k, v in rows.items())).encode())
    wide = sources.series_csv(spark, str(tmp_path / "p.csv"), "Concepto", periods)
    got = series.log_series(wide, "Concepto", "Ciudad de México", periods).orderBy("pos").collect()
    assert [(r["index"], r.valor) for r in got] == [(p, float(k + 1)) for k, p in enumerate(periods)] and np.allclose([r.log for r in got], np.log(np.arange(1, 22)))
    assert [r.valor for r in series.unpivot(wide, "Concepto", periods).filter("Concepto = 'Estados Unidos'").orderBy("pos").collect()] == [float(x) for x in rows["Estados Unidos"]]


def test_series(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_bytes("﻿Concepto;2003;2022 R\r\nMéxico;1.5;2E+16\r\nx;0;-1\r\n".encode())
    wide = sources.series_csv(spark, str(path), "Concepto", ["2003", "2022 R"])
    rows = series.log_series(wide, "Concepto", "x", ["2003", "2022 R"]).orderBy("pos").collect()
    assert rows[0].log == float("-inf") and np.isnan(rows[1].log) and rows[1]["index"] == "2022 R"
    assert series.unpivot(wide, "Concepto", ["2003", "2022 R"]).filter("valor = 2e16").head().Concepto == "México"
    for bad in ("none", "y"):
        with pytest.raises(Exception, match="rows with Concepto"):
            series.only(wide.union(wide.limit(0)).union(spark.createDataFrame([("y", 1.0, 1.0)] * 2, wide.schema)), "Concepto", bad).collect()


def test_features(spark, tmp_path):
    path = tmp_path / "f.json"
    ring = "[[[0.0, 1.0], [2.0, 3.0]]]"
    one = lambda n, k: '{"properties": {"NOMGEO": "%s"}, "geometry": {"type": "%s", "coordinates": %s}}' % (n, k, ring)
    path.write_text('{"features": [%s, %s]}' % (one("Tláhuac", "Polygon"), one("b", "Point")), "utf-8")
    found = sources.features(spark, str(path))
    got = geometry.outlines(found, sources.zones(spark, ["Tláhuac"])).orderBy("seq").collect()
    assert [(r.seq, r.x, r.y) for r in got] == [(0, 0.0, 1.0), (1, 2.0, 3.0)]
    for bad in ("b", "nowhere"):
        with pytest.raises(Exception):
            geometry.outlines(found, sources.zones(spark, [bad])).collect()


def test_histogram_of_nulls_odd_values_and_clashing_names(spark):
    df = lambda v: spark.createDataFrame([(x, 7.0, 8.0, "e", 1) for x in v], "v double, a double, b double, edge string, bin int")
    got = stats.histogram(df([1.0, 2.0, None])).orderBy("bin").collect()
    assert [r.n for r in got] == np.histogram([1.0, 2.0], 50)[0].tolist()
    for bad in (float("nan"), float("inf")):
        with pytest.raises(Exception, match="finite"):
            stats.histogram(df([1.0, bad])).collect()
    assert stats.histogram(df([])).count() == 0 and stats.histogram(df([None]), "a").count() == 0
    assert stats.histogram(df([1.0, 2.0, 2.0]), "edge").filter("n > 0").count() == 2


def test_raster_operators_keep_clashing_names(spark):
    df = spark.createDataFrame([(0, 0, 3.0, 1, 2, 3.0, True)], "y int, x int, v double, dy int, dx int, top double, hit boolean")
    assert raster.upscale(df).columns == df.columns and raster.upscale(df).filter("dy = 1 and dx = 2").count() == 4
    assert raster.clip(df).columns == df.columns and raster.burn(df, df).head().v == 2500.0
    empty = df.limit(0)
    assert raster.upscale(empty).count() == raster.clip(empty).count() == raster.without(empty, df).count() == 0


def test_crop_of_a_zone_by_numpy(spark):
    image = np.random.default_rng(3).normal(size=(12, 9))
    packed = spark.createDataFrame([(y, r.tolist()) for y, r in enumerate(image)], "y int, row array<double>")
    ring = [(2.5, 3.2), (7.1, 4.0), (5.3, 10.4), (2.5, 3.2)]
    pixels = spark.createDataFrame([("z", k, x, y) for k, (x, y) in enumerate(ring)], "zone string, seq int, px double, py double")
    windows, local, sizes = raster.crop_images(packed, pixels, 2)
    xs, ys = np.array(ring).T
    (xlo, xhi), (ylo, yhi) = ((int(np.ceil(v.min())) - 1, int(np.ceil(v.max())) + 1) for v in (xs, ys))
    cut = np.kron(image[ylo:yhi, xlo:xhi], np.ones((2, 2)))
    got = np.full(cut.shape, np.nan)
    for r in raster.upscale(windows).collect():
        got[r.y, r.x] = r.v
    assert np.array_equal(got, np.clip(cut, 0, cut.max())) and sizes.head()[1:] == cut.shape[::-1]
    assert np.allclose([(r.x, r.y) for r in local.orderBy("seq").collect()], np.column_stack([(xs - xlo) * 2, (ys - ylo) * 2]))
    with pytest.raises(Exception, match="outside the raster"):
        raster.crop_zones(packed, geometry.crop_bounds(pixels.withColumn("px", F.col("px") - 3))).collect()


def test_clip_of_nulls_and_burn_keeps_columns(spark):
    df = spark.createDataFrame([(0, 0, 1.0, "t"), (0, 1, None, "t"), (0, 2, -3.0, "t")], "y int, x int, v double, tile string")
    assert {r.x: r.v for r in raster.clip(df).collect()} == {0: 1.0, 1: None, 2: 0.0}
    assert {r.x: r.v for r in raster.clip(df.withColumn("zone", F.lit(1)), "zone").collect()} == {0: 1.0, 1: None, 2: 0.0}
    burnt = raster.burn(df, spark.createDataFrame([(1, 0)], "x int, y int"))
    assert burnt.columns == df.columns and {(r.x, r.v, r.tile) for r in burnt.collect()} == {(0, 1.0, "t"), (1, 2500.0, "t"), (2, -3.0, "t")}


def lines(spark, image):
    return spark.createDataFrame([(y, r.tolist()) for y, r in enumerate(image)], "y long, row array<double>")


def test_a_zone_past_the_far_edge_is_an_error(spark):
    packed = lines(spark, np.ones((6, 5)))
    at = lambda x, y: spark.createDataFrame([("in", k, 1.5 + k, 1.5 + k) for k in range(2)] + [("out", k, x + k, y + k) for k in range(2)], "zone string, seq int, px double, py double")
    for x, y in ((40.0, 2.0), (2.0, 40.0), (6.5, 2.0)):
        for part in raster.crop_images(packed, at(1.5, 1.5))[0:3]:
            assert part.filter("zone = 'out'").count()
        with pytest.raises(Exception, match="past the raster: zone out"):
            [part.collect() for part in raster.crop_images(packed, at(x, y))]


def test_shape_of_a_raster(spark):
    assert tuple(raster.shape(lines(spark, np.ones((6, 5)))).head()) == (6, 5)
    assert tuple(raster.shape(lines(spark, np.ones((6, 5))).limit(0)).head()) == (None, None)


def test_window_reaches_the_scan(spark, tmp_path):
    image = np.random.default_rng(5).normal(size=(40, 9))
    lines(spark, image).withColumn("t", F.lit("a")).write.parquet(str(tmp_path / "r"))
    stored = sources.raster_parquet(spark, str(tmp_path / "r"), "y", "row")
    got = raster.window(stored, 10, 50, 3, 7)
    plan = got._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(y,10)" in plan and "LessThan(y,50)" in plan
    assert {(r.y, r.x): r.v for r in got.collect()} == {(y, x): image[y, x] for y in range(10, 40) for x in range(3, 7)}
    assert raster.window(spark.read.parquet(str(tmp_path / "r")), 0, 1, 0, 1, "t").head().t == "a"
    assert raster.window(stored, 0, 5, 20, 30).count() == raster.window(stored, 5, 5, 0, 3).count() == raster.window(stored, 0, 5, 3, 3).count() == 0
    with pytest.raises(ValueError):
        raster.window(stored, -1, 5, 0, 3)


def test_tiles_by_brute_force(spark):
    rng = np.random.default_rng(6)
    boxes = [(f"t{k}", float(x), float(y), x + 10.0, y - 10.0, 20, 40) for k, (x, y) in enumerate((a, b) for a in range(-30, 10, 10) for b in range(-10, 30, 10))] + [("overlap", -27.0, 7.0, -17.0, -3.0, 5, 8)]
    vertices = [(int(k % 3), k, float(x), float(y)) for k, (x, y) in enumerate(zip(rng.uniform(-30, 10, 300), rng.uniform(-19.9, 20, 300)))] + [(9, 0, -20.0, 10.0), (9, 1, -30.0, 20.0)]
    tiles = spark.createDataFrame(boxes, "tile string, ul_x double, ul_y double, lr_x double, lr_y double, height int, width int")
    df = spark.createDataFrame(vertices, "zone int, seq int, x double, y double")
    want = sorted((z, s, t, (x - ux) / (10.0 / w), (uy - y) / (10.0 / h)) for z, s, x, y in vertices for t, ux, uy, lx, ly, h, w in boxes if ux <= x < lx and ly < y <= uy)
    got = geometry.to_tile_pixels(df, tiles)
    assert sorted(map(tuple, got.collect())) == want and len({t for z, _, t, *_ in want if z == 0}) > 5
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    for bad in ((4, 0, 50.0, 0.0), (4, 0, None, 0.0)):
        with pytest.raises(Exception, match="no tile: zone 4"):
            geometry.to_tile_pixels(df.union(spark.createDataFrame([bad], df.schema)), tiles).collect()
    assert geometry.to_tile_pixels(df.limit(0), tiles).count() == 0


@pytest.mark.parametrize("factor", [1, 2, 3])
def test_weights_stand_for_upscaled_pixels(spark, factor):
    image = np.random.default_rng(8).normal(size=(30, 25)).round(1)
    ring = [(3.5, 4.2), (12.1, 3.1), (17.3, 14.4), (9.2, 21.7), (3.5, 4.2)]
    pixels = spark.createDataFrame([("z", k, x, y) for k, (x, y) in enumerate(ring)] + [("w", k, x + 2.25, y + 1.5) for k, (x, y) in enumerate(ring)], "zone string, seq int, px double, py double")
    windows, local, sizes = raster.crop_images(lines(spark, image), pixels, factor)
    edge = geometry.densify(local)
    seeds = geometry.centroid(edge).join(sizes, "zone").select("zone", F.col("cx").cast("int").alias("x"), F.col("cy").cast("int").alias("y"), "width", "height")
    weighted = stats.gather_weighted(fill.flood_fill(edge, seeds, factor), windows)
    each = stats.gather_upscaled(fill.flood_fill(edge, seeds), windows, factor)
    assert weighted.agg(F.sum("weight")).head()[0] == each.count() and weighted.count() <= each.count() // max(1, factor * factor // 2)
    for a, b in zip(*(df.orderBy("zone").collect() for df in (stats.summary(weighted, "zone", weight="weight"), stats.summary(each, "zone")))):
        assert a.zone == b.zone and a.n == b.n and np.allclose(a[2:], b[2:], rtol=1e-12)
    bins = lambda df: sorted(map(tuple, df.collect()))
    assert bins(stats.binned(weighted.select("zone", "v", "weight"), "zone")) == bins(stats.histogram(each, "zone"))


def test_weights_of_nothing_and_of_nulls(spark):
    df = spark.createDataFrame([(1.0, 2), (None, 5), (4.0, 1), (9.0, 0)], "v double, w int")
    got = stats.summary(df, weight="w").head()
    assert (got.n, got["mean"], got.max, got.p50) == (3, 2.0, 4.0, 1.0) and np.isclose(got.std, np.std([1, 1, 4]))
    assert stats.summary(df.limit(0), weight="w").head().n in (0, None)


def test_one_fill_makes_the_histogram(spark):
    plan = QUERIES["zonal_histogram"](spark, SF)._jdf.queryExecution().toString()
    assert "CoGroup" not in plan and plan.count("ExistingRDD") + plan.count("LogicalRDD")  # values were written by one run before


def test_fill_by_breadth_first_search():
    rng = np.random.default_rng(4)
    for _ in range(50):
        w, h = (int(x) for x in rng.integers(1, 15, 2))
        walls = {(int(x), int(y)) for x, y in zip(rng.integers(-2, w + 2, w * h // 2), rng.integers(-2, h + 2, w * h // 2))}
        seed = int(rng.integers(w)), int(rng.integers(h))
        seen, queue = {seed}, [seed]
        for x, y in queue:
            for p in ((x - 1, y), (x + 1, y), (x, y - 1), (x, y + 1)):
                if 0 <= p[0] < w and 0 <= p[1] < h and p not in seen and p not in walls:
                    seen.add(p)
                    queue.append(p)
        assert fill.filled(w, h, seed, walls) == sorted(seen)


def stand_in(folder):
    """A stand-in for the module that reads grid files."""
    (folder / "h5py.py").write_text("""
import numpy as np
def File(path, mode):
    d, t = np.arange(10.0).reshape(5, 2), np.array(b"UpperLeftPointMtrs=(1,2)")
    return {"d": np.arange(100.0).reshape(50, 2)} if path == "p2" else {"G": {"d": d}, "t": t, "G/d": d}
""")
    return str(folder / "h5py.py")


def test_grid_source_by_its_format(spark, tmp_path):
    spark.sparkContext.addPyFile(stand_in(tmp_path))
    rows = sources.grid(spark, "p", dataset="G/d", lines="2")
    assert rows.rdd.getNumPartitions() == 3 and [tuple(r) for r in rows.orderBy("y").collect()] == [(y, [2.0 * y, 2.0 * y + 1]) for y in range(5)]
    assert sources.grid(spark, "p", dataset="t", mode="metadata").head().text == "UpperLeftPointMtrs=(1,2)"
    assert [r.line for r in sources.listing(sources.grid(spark, "p", mode="catalog")).collect()] == ["- G", "  - d", "- t", "- G/d"]


def test_bounds_of_y_skip_lines_of_a_grid(spark, tmp_path):
    flat = {"d": np.arange(100.0).reshape(50, 2)}
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, IsNotNull, LessThan, Not

    def read(*filters):
        r = sources.GridReader({"path": "p", "dataset": "d", "lines": "8"}, lambda p: flat)
        rest = list(r.pushFilters(list(filters)))
        return rest, [(p.lo, p.hi) for p in r.partitions()], [y for p in r.partitions() for b in r.read(p) for y in b.column("y").to_pylist()]

    other = Not(EqualTo(("y",), 12))
    assert read(GreaterThanOrEqual(("y",), 10), LessThan(("y",), 21), IsNotNull(("y",)), other) == ([other], [(10, 18), (18, 21)], list(range(10, 21)))
    assert read(EqualTo(("y",), 49), LessThan(("row",), 3))[0:2] == ([LessThan(("row",), 3)], [(49, 50)])
    assert read(GreaterThanOrEqual(("y",), 60)) == ([], [(0, 0)], []) and len(read()[1]) == 7
    spark.sparkContext.addPyFile(stand_in(tmp_path))
    rows = sources.grid(spark, "p2", dataset="d", lines="8")
    got = raster.window(rows, 10, 21, 1, 2)
    assert [(r.y, r.x, r.v) for r in got.orderBy("y").collect()] == [(y, 1, 2.0 * y + 1) for y in range(10, 21)] and got.rdd.getNumPartitions() == 2


def test_grid_source_over_a_stub():
    class Data(np.ndarray):
        pass

    grid = {"G": {"d": np.arange(6.0).reshape(3, 2)}, "t": np.frombuffer(b"UpperLeftPointMtrs=(1,2)", "S24")[0:1]}
    assert list(sources.tree(grid)) == [(0, "G", True), (1, "d", False), (0, "t", False)]
    flat = {"G/d": grid["G"]["d"]}
    r = sources.GridReader({"path": "p", "dataset": "G/d", "lines": "2"}, lambda p: flat)
    assert [tuple(row.values()) for p in r.partitions() for b in r.read(p) for row in b.to_pylist()] == [(0, [0.0, 1.0]), (1, [2.0, 3.0]), (2, [4.0, 5.0])]


def test_georef_without_a_corner(spark):
    df = spark.createDataFrame([("UpperLeftPointMtrs=(-100000000.0,2)",)], "s string")
    assert df.select(*geometry.georef(F.col("s")).values()).head()[0] is None
