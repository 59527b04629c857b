"""A query for each operator over the driver's tables: `embeddings` is the raster, each nation is a zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonara import sources
from zonara.operators import fill, geometry, raster, series, stats, work_folder
from zonara.plans import statements

RING = ((-8, 1), (-3, -7), (4, -8), (9, -2), (6, 6), (-2, 8), (-8, 1))
WIDTH, HEIGHT, UL_X, UL_Y, DIGITS = 64, 500, -100.0, 30.0, 6
YEARS = [str(y) for y in range(1992, 1999)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, kind in df.dtypes if kind == "double"})


def rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = F.array(*(F.struct(F.lit(float(x)).alias("dx"), F.lit(float(y)).alias("dy")) for x, y in RING))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("zone"), F.posexplode(points).alias("seq", "p"))
    return nation.select("zone", "seq", (F.lit(32.0) + F.col("p.dx")).alias("x"), (F.lit(10.0) + 20 * F.col("zone") + F.col("p.dy")).alias("y"))


def world(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rings(spark, sf_dir).select("zone", "seq", (F.lit(UL_X) + F.col("x") * F.lit(0.15)).alias("x"), (F.lit(UL_Y) - F.col("y") * F.lit(0.02)).alias("y"))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.to_pixel(world(spark, sf_dir), UL_X, UL_Y, HEIGHT, WIDTH)


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.raster_parquet(spark, f"{sf_dir}/embeddings.parquet", "vec_id", "embedding")


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir).withColumn("y", F.col("y").cast("int"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.explode_rows(stored(spark, sf_dir))


def border(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.densify(rings(spark, sf_dir))


def zone_seeds(edge: DataFrame) -> DataFrame:
    return geometry.centroid(edge).select("zone", F.col("cx").cast("int").alias("x"), F.col("cy").cast("int").alias("y"), F.lit(WIDTH).alias("width"), F.lit(HEIGHT).alias("height"))


def zone_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge = border(spark, sf_dir)
    return fill.flood_fill(edge, zone_seeds(edge))


def zone_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.gather(zone_cells(spark, sf_dir), packed(spark, sf_dir))


def upscaled_values(spark: SparkSession, sf_dir: str, factor: int = 2) -> DataFrame:
    """The whole chain for every zone: crop, clip, local coordinates of the upscaled window, border, centroid, fill, values. A value
    comes once with the number of upscaled pixels (weight) that it stands for."""
    windows, ring, sizes = raster.crop_images(packed(spark, sf_dir), pixels(spark, sf_dir), factor)
    edge = geometry.densify(ring)
    seeds = geometry.centroid(edge).join(sizes, "zone").select("zone", F.col("cx").cast("int").alias("x"), F.col("cy").cast("int").alias("y"), "width", "height")
    return stats.gather_weighted(fill.flood_fill(edge, seeds, factor), windows)


def tile_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines that span tiles of ten degrees."""
    points = F.array(*(F.struct(F.lit(float(x)).alias("dx"), F.lit(float(y)).alias("dy")) for x, y in RING))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("zone"), F.posexplode(points).alias("seq", "p"))
    return nation.select("zone", "seq", (F.lit(-112.0) + F.lit(1.4) * F.col("zone") + F.lit(0.8) * F.col("p.dx")).alias("x"), (F.lit(32.0) - F.lit(1.3) * F.col("zone") + F.lit(0.8) * F.col("p.dy")).alias("y"))


def tile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raster's lines dealt out to 25 tiles."""
    lines = table(spark, sf_dir, "embeddings")
    return lines.select((F.col("vec_id") % 25).cast("int").alias("tile"), F.expr("vec_id div 25").alias("y"), F.col("embedding").alias("row"))


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tile, its corners as read from its metadata text, height, width."""
    column, line = F.col("n_nationkey") % 5, F.expr("n_nationkey div 5")
    at = lambda x, y: F.concat((F.lit(-120) + 10 * (column + x)) * 1000000, F.lit(".0,"), (F.lit(40) - 10 * (line + y)) * 1000000, F.lit(".0)"))
    text = F.concat(F.lit("GridName=\"g\" UpperLeftPointMtrs=("), at(0, 0), F.lit(" LowerRightMtrs=("), at(1, 1))
    heights = tile_lines(spark, sf_dir).groupBy("tile").agg((F.max("y") + 1).cast("int").alias("height"))
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("tile"), *(c.alias(n) for n, c in geometry.georef(text).items())).join(heights, "tile").withColumn("width", F.lit(WIDTH))


def wide_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", F.year("o_orderdate").cast("string").alias("year"), "o_totalprice")
    wide = orders.groupBy("o_orderpriority").pivot("year", YEARS).agg(F.round(F.sum("o_totalprice"), 2))
    return wide.na.fill(0.0, YEARS)


def series_log(spark, sf_dir):
    return rounded(series.log_series(wide_orders(spark, sf_dir), "o_orderpriority", "1-URGENT", YEARS))


def series_unpivot(spark, sf_dir):
    return rounded(series.unpivot(wide_orders(spark, sf_dir), "o_orderpriority", YEARS))


def raster_cells(spark, sf_dir):
    return rounded(cells(spark, sf_dir))


def raster_crop(spark, sf_dir):
    return rounded(raster.window(stored(spark, sf_dir), 0, 250, 0, 255))


def raster_clip(spark, sf_dir):
    return rounded(raster.crop_images(packed(spark, sf_dir), pixels(spark, sf_dir))[0])


def raster_upscale(spark, sf_dir):
    return rounded(raster.upscale(raster.crop_images(packed(spark, sf_dir), pixels(spark, sf_dir))[0]))


def raster_clip_all(spark, sf_dir):
    return rounded(raster.clip(cells(spark, sf_dir)))


def raster_upscale_all(spark, sf_dir):
    return rounded(raster.upscale(cells(spark, sf_dir)))


def raster_burn(spark, sf_dir):
    return rounded(raster.burn(cells(spark, sf_dir), border(spark, sf_dir)))


def georef_parse(spark, sf_dir):
    k = F.col("n_nationkey")
    text = F.concat(F.lit("GridName=\"g\" UpperLeftPointMtrs=(-"), 100000000 + k * 1000000, F.lit(".5,"), 30000000 - k, F.lit(") LowerRightMtrs=("), k * 250000, F.lit(",-"), k * 125000, F.lit(".25)"))
    return rounded(table(spark, sf_dir, "nation").select("n_nationkey", *(c.alias(n) for n, c in geometry.georef(text).items())))


def feature_lookup(spark, sf_dir):
    point = F.array(F.col("event_id").cast("double"), "value")
    features = table(spark, sf_dir, "events").select(F.col("event_id").alias("ord"), F.get_json_object("props", "$.k").alias("name"), F.lit("Polygon").alias("kind"), F.array(F.array(point)).alias("coordinates"))
    found = geometry.outlines(features, sources.zones(spark, [str(k) for k in range(16)]))
    return rounded(found.select(F.col("zone").cast("int").alias("k"), F.col("x").cast("long").alias("event_id"), F.col("y").alias("value")))


def world_to_pixel(spark, sf_dir):
    return rounded(pixels(spark, sf_dir).select("zone", "seq", "px", "py"))


def crop_bounds(spark, sf_dir):
    return geometry.crop_bounds(rings(spark, sf_dir).withColumnsRenamed({"x": "px", "y": "py"}))


def edge_densify(spark, sf_dir):
    return border(spark, sf_dir)


def polygon_centroid(spark, sf_dir):
    return rounded(geometry.centroid(border(spark, sf_dir)))


def border_antijoin(spark, sf_dir):
    return rounded(raster.without(cells(spark, sf_dir), border(spark, sf_dir)))


def flood_fill(spark, sf_dir):
    return zone_cells(spark, sf_dir)


def zonal_stats(spark, sf_dir):
    return rounded(stats.summary(zone_values(spark, sf_dir), "zone"))


def zonal_histogram(spark, sf_dir):
    return rounded(stats.histogram(zone_values(spark, sf_dir), "zone"))


def zonal_stats_upscaled(spark, sf_dir):
    return rounded(stats.summary(upscaled_values(spark, sf_dir), "zone", weight="weight"))


def zonal_histogram_upscaled(spark, sf_dir):
    return rounded(stats.binned(upscaled_values(spark, sf_dir).select("zone", "v", "weight"), "zone"))


def zone_window_histogram(spark, sf_dir):
    return rounded(stats.histogram(raster.crop_images(packed(spark, sf_dir), pixels(spark, sf_dir), 1)[0], "zone"))


def zone_outline_local(spark, sf_dir):
    return rounded(raster.crop_images(packed(spark, sf_dir), pixels(spark, sf_dir))[1])


def raster_shape(spark, sf_dir):
    return raster.shape(packed(spark, sf_dir))


def raster_preview(spark, sf_dir):
    return rounded(raster.preview(cells(spark, sf_dir), 250).select("y", F.size("row").alias("samples"), F.element_at("row", 1).alias("first"), F.element_at("row", -1).alias("last")))


def window_histogram(spark, sf_dir):
    return rounded(stats.histogram(raster.window(stored(spark, sf_dir), 10, 40, 5, 50)))


def zone_overlay(spark, sf_dir):
    names = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("zone"), "n_name")
    return rounded(pixels(spark, sf_dir).join(names, "zone").select("n_name", "seq", "px", "py"))


def flood_fill_runs(spark, sf_dir):
    edge = border(spark, sf_dir)
    return fill.flood_fill_runs(edge, zone_seeds(edge))


def tile_pixels(spark, sf_dir):
    return rounded(geometry.to_tile_pixels(tile_rings(spark, sf_dir), tiles(spark, sf_dir)))


def tile_overlay(spark, sf_dir):
    """Every tile's window as an image, and the outlines over it in the tile's pixels."""
    image = raster.window(tile_lines(spark, sf_dir), 0, 250, 0, 255, "tile").select(F.lit("image").alias("layer"), "tile", F.lit(None).cast("int").alias("zone"), F.lit(None).cast("int").alias("seq"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "v")
    outline = geometry.to_tile_pixels(tile_rings(spark, sf_dir), tiles(spark, sf_dir)).select(F.lit("outline").alias("layer"), "tile", "zone", "seq", F.col("px").alias("x"), F.col("py").alias("y"), F.lit(None).cast("double").alias("v"))
    return rounded(image.unionByName(outline))


def catalog_names(spark, sf_dir):
    """The names of a boundary file's features, in its order: a feature a line, written in order and read in parts."""
    path = f"{work_folder(spark)}/names"
    shape = F.struct(F.lit("Polygon").alias("type"), F.array().cast("array<array<array<double>>>").alias("coordinates"))
    region = table(spark, sf_dir, "region").orderBy("r_regionkey").select(F.struct(F.struct(F.col("r_name").alias("NOMGEO")).alias("properties"), shape.alias("geometry")).alias("f"))
    region.select(F.concat(F.to_json("f"), F.lit(","))).write.text(path)
    return sources.features_by_line(spark, path).select("ord", "name")


def catalog_tree(spark, sf_dir):
    """The given folder as the grid source lists it: three of its tables, and their columns."""
    tree = sources.grid(spark, sf_dir, mode="catalog", opener="parquet")
    table_of = F.last(F.when(F.col("depth") == 0, F.col("name")), ignorenulls=True).over(Window.orderBy("ord"))  # a row for each column of each table
    some = tree.withColumn("table", table_of).filter(F.col("table").isin("embeddings", "nation", "region"))
    return sources.listing(some.withColumn("ord", (F.row_number().over(Window.orderBy("ord")) - 1).cast("int")))


def grid_lines(spark, sf_dir):
    lines = sources.grid(spark, sf_dir, opener="parquet", dataset="embeddings/embedding", lines="200")
    return rounded(lines.filter("y >= 100 and y < 400").select("y", F.size("row").alias("samples"), F.element_at("row", 1).alias("first"), F.element_at("row", -1).alias("last")))


def series_file(spark, sf_dir):
    """The series from a file of the form that it comes in: written and read back."""
    path = f"{work_folder(spark)}/series"
    wide_orders(spark, sf_dir).write.option("sep", ";").option("header", True).csv(path)
    return rounded(series.log_series(sources.series_csv(spark, path, "o_orderpriority", YEARS), "o_orderpriority", "1-URGENT", YEARS))


def boundary_features(spark, sf_dir):
    names = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("zone"), F.struct(F.col("n_name").alias("NOMGEO")).alias("properties"))
    ring = F.transform(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))), lambda p: F.array(p["x"], p["y"]))  # a ring of seven points
    shapes = rings(spark, sf_dir).groupBy("zone").agg(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    return names.join(shapes, "zone").select(F.struct("properties", "geometry").alias("feature"))


def boundary_file(spark, sf_dir):
    """The outlines from files of features, a document a line: written and read back, looked up by name."""
    path = f"{work_folder(spark)}/boundaries"
    boundary_features(spark, sf_dir).select(F.array("feature").alias("features")).write.json(path)
    found = sources.features(spark, path, multi_line=False)
    return rounded(geometry.outlines(found, table(spark, sf_dir, "nation").select(F.col("n_name").alias("zone"))))


def boundary_lines(spark, sf_dir):
    """The same from the lines of a collection, a feature a line."""
    path = f"{work_folder(spark)}/lines"
    boundary_features(spark, sf_dir).select(F.concat(F.to_json("feature"), F.lit(","))).write.text(path)
    found = sources.features_by_line(spark, path)
    return rounded(geometry.outlines(found, table(spark, sf_dir, "nation").select(F.col("n_name").alias("zone"))))


def zone_by_statement(spark, sf_dir):
    return rounded(statements.zone_statistics(pixels(spark, sf_dir), packed(spark, sf_dir), 7))


QUERIES = {f.__name__: f for f in (zonal_stats, zonal_stats_upscaled, zonal_histogram_upscaled, zone_window_histogram, zone_outline_local, raster_shape, raster_preview, series_log, series_unpivot, raster_cells, raster_crop, raster_clip, raster_upscale, raster_clip_all, raster_upscale_all, raster_burn, georef_parse, feature_lookup, world_to_pixel, crop_bounds, edge_densify, polygon_centroid, border_antijoin, flood_fill, zonal_histogram, window_histogram, zone_overlay, catalog_names, catalog_tree, flood_fill_runs, tile_pixels, tile_overlay, grid_lines, series_file, boundary_file, boundary_lines, zone_by_statement)}
