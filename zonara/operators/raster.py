"""Rasters as cells (y, x, v) or packed rows (y, row)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonara.operators import checkpointed, geometry, unused


def explode_rows(packed: DataFrame, *keys: str) -> DataFrame:
    """Packed rows (y, row array) to cells."""
    return packed.select(*keys, F.col("y").cast("int").alias("y"), F.posexplode("row").alias("x", "v")).withColumn("v", F.col("v").cast("double"))


def physical(cells: DataFrame, scale: float = 1.0, fill: float | None = None) -> DataFrame:
    """Stored numbers as values: those equal to `fill` are nulls, the others are multiplied by `scale`."""
    v = F.col("v") * F.lit(scale)
    return cells.withColumn("v", v if fill is None else F.when(F.col("v") != F.lit(fill), v))


def pack_rows(cells: DataFrame, *keys: str) -> DataFrame:
    """Cells to packed rows in x order; a row is one raster line, whose width is fixed by the grid."""
    return cells.groupBy(*keys, "y").agg(F.sort_array(F.collect_list(F.struct("x", "v"))).alias("r")).select(*keys, "y", F.col("r.v").alias("row"))


def crop(cells: DataFrame, ylo: int, yhi: int, xlo: int, xhi: int) -> DataFrame:
    """The half-open window; a negative lower limit is an error, the far edge clamps by itself."""
    if ylo < 0 or xlo < 0:
        raise ValueError(f"the window starts outside the raster: y {ylo}, x {xlo}")
    return cells.filter((F.col("y") >= ylo) & (F.col("y") < yhi) & (F.col("x") >= xlo) & (F.col("x") < xhi))


def window(packed: DataFrame, ylo: int, yhi: int, xlo: int, xhi: int, *keys: str) -> DataFrame:
    """The half-open window of packed lines, as cells: `crop` for a raster that is not exploded yet. The bounds of y meet the column as it
    is stored, so they reach the scan, and only the window's part of a line is exploded. keys: further columns to keep."""
    if ylo < 0 or xlo < 0:
        raise ValueError(f"the window starts outside the raster: y {ylo}, x {xlo}")
    lines = packed.filter((F.col("y") >= ylo) & (F.col("y") < yhi)).withColumn("row", F.slice("row", xlo + 1, max(0, xhi - xlo)))
    return explode_rows(lines, *keys).withColumn("x", F.col("x") + xlo)


def shape(packed: DataFrame) -> DataFrame:
    """height and width of a raster of packed lines, as one row (nulls if it has no lines). Lines of a grid are equally long, so one of
    them gives the width, and the others' values are not read."""
    return packed.agg((F.max("y") + 1).cast("int").alias("height")).join(packed.select(F.size("row").alias("width")).limit(1), F.lit(True), "left")


def crop_zones(packed: DataFrame, bounds: DataFrame) -> DataFrame:
    """zone, y, x, v: the cells of each zone's window (zone, ylo, yhi, xlo, xhi), in coordinates of the window. Windows are small
    next to the raster; each is spread over its lines, so the join is by line, and only the window's part of a line is
    exploded. A window that starts outside the raster is an error; the far edge clamps."""
    inside = F.when((F.col("ylo") < 0) | (F.col("xlo") < 0), F.raise_error(F.concat(F.lit("the window starts outside the raster: zone "), F.col("zone").cast("string"))).cast("int")).otherwise(F.col("ylo"))
    lines = bounds.select("zone", "ylo", "xlo", "xhi", F.explode(F.sequence(inside, F.col("yhi") - 1)).alias("y"))
    part = F.slice("row", F.col("xlo") + 1, F.greatest(F.least("xhi", F.size("row")) - F.col("xlo"), F.lit(0)))
    cut = packed.select("y", "row").join(lines, "y").select("zone", (F.col("y") - F.col("ylo")).cast("int").alias("y"), F.posexplode(part).alias("x", "v"))
    return cut.withColumn("v", F.col("v").cast("double"))


def clip(cells: DataFrame, *keys: str) -> DataFrame:
    """v between 0 and the largest of the window, lower bound first; a null stays null and bounds nothing, a NaN makes the window NaN."""
    top = unused(cells.columns, "top")
    most = cells.groupBy(*keys).agg(F.max("v").alias(top))
    with_top = cells.join(most, list(keys)) if keys else cells.crossJoin(F.broadcast(most))
    clipped = F.when(F.col("v").isNull(), F.col("v")).when(F.isnan(top), F.lit(float("nan"))).otherwise(F.least(F.greatest("v", F.lit(0.0)), top))
    return with_top.withColumn("v", clipped).select(*cells.columns)


def upscale(cells: DataFrame, factor: int = 2) -> DataFrame:
    """Each cell as a block of factor x factor."""
    d, dy = F.sequence(F.lit(0), F.lit(factor - 1)), unused(cells.columns, "dy")
    dx = unused([*cells.columns, dy], "dx")
    out = cells.withColumn(dy, F.explode(d)).withColumn(dx, F.explode(d))
    return out.withColumns({"y": F.col("y") * factor + F.col(dy), "x": F.col("x") * factor + F.col(dx)}).select(*cells.columns)


def crop_images(packed: DataFrame, pixels: DataFrame, factor: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For every zone at once: its window, clipped, in source pixels (zone, y, x, v; `upscale` repeats them); its ring in the window's
    coordinates times factor (zone, seq, x, y); and the size of its upscaled window (zone, width, height). The windows are written once, since clipping reads them twice.
    A zone past the far edge, whose window would be empty, is an error."""
    whole = F.broadcast(shape(packed).withColumnsRenamed({"height": "all_lines", "width": "all_samples"}))  # one row
    bounds = geometry.crop_bounds(pixels).crossJoin(whole)
    past = F.raise_error(F.concat(F.lit("the window lies past the raster: zone "), F.col("zone").cast("string"))).cast("int")
    bounds = bounds.withColumn("ylo", F.when((F.col("xlo") >= F.col("all_samples")) | (F.col("ylo") >= F.col("all_lines")), past).otherwise(F.col("ylo")))
    sizes = bounds.select("zone", ((F.least("xhi", "all_samples") - F.col("xlo")) * factor).alias("width"), ((F.least("yhi", "all_lines") - F.col("ylo")) * factor).alias("height"))
    return clip(checkpointed(crop_zones(packed, bounds)), "zone"), geometry.localised(pixels, bounds, factor), sizes


def burn(cells: DataFrame, border: DataFrame, value: float = 2500.0) -> DataFrame:
    """The value at every border pixel; other columns stay as they are."""
    hit = unused(cells.columns, "hit")
    marks = border.select("x", "y").distinct().withColumn(hit, F.lit(True))
    return cells.join(marks, ["x", "y"], "left").withColumn("v", F.when(F.col(hit), F.lit(value)).otherwise(F.col("v"))).select(*cells.columns)


def without(cells: DataFrame, border: DataFrame) -> DataFrame:
    """The cells that are no border pixels."""
    return cells.join(border.select("x", "y").distinct(), ["x", "y"], "left_anti").select(*cells.columns)


def preview(cells: DataFrame, lines: int) -> DataFrame:
    """The first lines as packed rows, for a plotter."""
    return pack_rows(cells.filter(F.col("y") < lines)).orderBy("y")
