"""Geo-reference, feature lookup, pixel coordinates, border densification and centroid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The two corner keys of the metadata text.
CORNERS = {"ul": r"UpperLeftPointMtrs=\(([-\d.]+),([-\d.]+)\)", "lr": r"LowerRightMtrs=\(([-\d.]+),([-\d.]+)\)"}
UNIT, SPAN_DEG, SAMPLES = 1_000_000, 10.0, 100


def georef(text: Column) -> dict[str, Column]:
    """ul_x, ul_y, lr_x, lr_y in degrees; all null unless both corners are found."""
    found = text.rlike(CORNERS["ul"]) & text.rlike(CORNERS["lr"])
    return {f"{c}_{axis}": F.when(found, F.regexp_extract(text, p, n).cast("double") / F.lit(float(UNIT))) for c, p in CORNERS.items() for n, axis in ((1, "x"), (2, "y"))}


def outlines(features: DataFrame, zones: DataFrame) -> DataFrame:
    """zone, seq, x, y of the outer ring of the first feature with each zone's name. features: ord, name, kind, coordinates.
    Zones are looked up by name; a kind other than Polygon, or a zone without a feature, is an error."""
    first = features.groupBy(F.col("name").alias("zone")).agg(F.min_by(F.struct("kind", "coordinates"), "ord").alias("f"))
    hit = zones.select("zone").join(first, "zone", "left")
    ring = F.when(F.col("f").isNull(), F.raise_error(F.concat(F.lit("no feature is named "), "zone"))).when(F.col("f.kind") != "Polygon", F.raise_error(F.concat(F.lit("not a Polygon: "), "zone"))).otherwise(F.col("f.coordinates")[0])
    return hit.select("zone", F.posexplode(ring).alias("seq", "p")).select("zone", "seq", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


def to_pixel(vertices: DataFrame, ul_x: float, ul_y: float, height: int, width: int, span_deg: float = SPAN_DEG) -> DataFrame:
    """px, py in whole-tile pixels, not truncated."""
    return vertices.withColumns({"px": (F.col("x") - F.lit(ul_x)) / F.lit(span_deg / width), "py": (F.lit(ul_y) - F.col("y")) / F.lit(span_deg / height)})


def to_tile_pixels(vertices: DataFrame, tiles: DataFrame, span_deg: float = SPAN_DEG) -> DataFrame:
    """zone, seq, tile, px, py: each vertex (zone, seq, x, y) in the pixels of the tile that it lies on; a zone may span tiles.
    tiles: tile, ul_x, ul_y, lr_x, lr_y, height, width. The left and upper edges belong to a tile; where tiles overlap a vertex has a
    row for each, and a vertex on no tile, or a null coordinate, is an error. Both sides meet in cells of span_deg degrees, so a
    vertex is held against the few tiles of its cell only; a cell that has many vertices is split by adaptive execution."""
    cell = lambda c: F.floor(F.col(c) / F.lit(span_deg)).cast("int")
    spread = tiles.select("*", F.explode(F.sequence(cell("ul_x"), cell("lr_x"))).alias("cx")).select("*", F.explode(F.sequence(cell("lr_y"), cell("ul_y"))).alias("cy"))
    at = vertices.select("zone", "seq", "x", "y", cell("x").alias("cx"), cell("y").alias("cy"))
    inside = (F.col("x") >= F.col("ul_x")) & (F.col("x") < F.col("lr_x")) & (F.col("y") > F.col("lr_y")) & (F.col("y") <= F.col("ul_y"))
    met = at.join(spread, (at.cx == spread.cx) & (at.cy == spread.cy) & inside, "left")
    tile = F.when(F.col("ul_x").isNull(), F.raise_error(F.concat(F.lit("a vertex lies on no tile: zone "), F.col("zone").cast("string"))).cast(dict(tiles.dtypes)["tile"])).otherwise(F.col("tile"))
    px, py = (F.col("x") - F.col("ul_x")) / (F.lit(span_deg) / F.col("width")), (F.col("ul_y") - F.col("y")) / (F.lit(span_deg) / F.col("height"))
    return met.select("zone", "seq", tile.alias("tile"), px.alias("px"), py.alias("py"))


def crop_bounds(pixels: DataFrame) -> DataFrame:
    """xlo, xhi, ylo, yhi of each zone: ceil(min) - 1 and ceil(max) + 1."""
    edge = lambda f, c, d: (F.ceil(f(c)) + d).cast("int")
    return pixels.groupBy("zone").agg(edge(F.min, "px", -1).alias("xlo"), edge(F.max, "px", 1).alias("xhi"), edge(F.min, "py", -1).alias("ylo"), edge(F.max, "py", 1).alias("yhi"))


def localised(pixels: DataFrame, bounds: DataFrame, factor: int = 2) -> DataFrame:
    """Vertices relative to their zone's crop, scaled: zone, seq, x, y."""
    return pixels.join(bounds, "zone").select("zone", "seq", ((F.col("px") - F.col("xlo")) * factor).alias("x"), ((F.col("py") - F.col("ylo")) * factor).alias("y"))


def densify(vertices: DataFrame, samples: int = SAMPLES, keep_short: bool = False, vertical: str = "error") -> DataFrame:
    """zone, seq, k, x, y: `samples` truncated points on each segment longer than 1; shorter ones give nothing unless keep_short.
    A vertical segment has no slope: it divides by zero, which is an error; with vertical="straight" its points go evenly from end to
    end, and with vertical="skip" it gives nothing."""
    if vertical not in ("error", "straight", "skip"):
        raise ValueError(f"vertical is error, straight or skip, not {vertical}")
    w = Window.partitionBy("zone").orderBy("seq")
    s = vertices.select("zone", "seq", F.col("x").alias("x0"), F.col("y").alias("y0"), F.lead("x").over(w).alias("x1"), F.lead("y").over(w).alias("y1")).filter("x1 is not null")
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    s = s if keep_short else s.filter(F.sqrt(dx * dx + dy * dy) > 1)
    s = s.filter(dx != 0) if vertical == "skip" else s
    s = s.select("*", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("k"))
    even = lambda a, b, d: F.when(F.col("k") == samples - 1, F.col(b)).otherwise(F.col("k") * (d / F.lit(samples - 1)) + F.col(a))
    s = s.withColumn("px", even("x0", "x1", dx))
    y = dy / dx * (F.col("px") - F.col("x0")) + F.col("y0")
    y = F.when(dx == 0, even("y0", "y1", dy)).otherwise(y) if vertical == "straight" else y
    return s.select("zone", "seq", "k", F.col("px").cast("int").alias("x"), y.cast("int").alias("y"))


def centroid(border: DataFrame) -> DataFrame:
    """zone, cx, cy by the shoelace sums over the closed border; an empty border is an error of the caller's (no row)."""
    w = Window.partitionBy("zone").orderBy("seq", "k")
    after = lambda c: F.coalesce(F.lead(c).over(w), F.first(c).over(w)).cast("long")
    p = border.select("zone", F.col("x").cast("long").alias("x0"), F.col("y").cast("long").alias("y0"), after("x").alias("x1"), after("y").alias("y1"))
    cross = F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0")
    sums = p.groupBy("zone").agg(F.sum(cross).alias("a"), F.sum((F.col("x0") + F.col("x1")) * cross).alias("sx"), F.sum((F.col("y0") + F.col("y1")) * cross).alias("sy"))
    six = F.lit(6.0) * (F.col("a") * 0.5)
    return sums.select("zone", (F.col("sx") / six).alias("cx"), (F.col("sy") / six).alias("cy"))
