"""The whole chain for one named zone as one SQL statement, for callers who have views and not DataFrames.

`register` adds two table functions: `densified(x0, y0, x1, y1)`, the border pixels of a segment, and `zone_fill(width, height, x, y, walls_x,
walls_y, factor)`, the source pixels of a filled window with their weights. Both are used with LATERAL, one call a segment or a zone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf

from zonara.operators import fill
from zonara.operators.geometry import SAMPLES


class Densified:
    """The points of one segment, as `geometry.densify` has them; a vertical segment is an error, a null end has no points."""

    def eval(self, x0: float, y0: float, x1: float, y1: float):
        if None in (x0, y0, x1, y1):
            return
        if x0 == x1:
            raise ZeroDivisionError("a vertical segment has no slope")
        for k in range(SAMPLES):
            x = x1 if k == SAMPLES - 1 else k * ((x1 - x0) / (SAMPLES - 1)) + x0
            yield k, int(x), int((y1 - y0) / (x1 - x0) * (x - x0) + y0)


class ZoneFill:
    """`fill.flood_fill` of one zone; a zone without walls is an error."""

    def eval(self, width: int, height: int, x: int, y: int, walls_x: list, walls_y: list, factor: int):
        if not walls_x:
            raise ValueError("empty border")
        found = fill.blocks(fill.mask(width, height, (x, y), np.array(walls_x), np.array(walls_y)), factor)
        for line, column in zip(*(a.tolist() for a in found.nonzero())):
            yield column, line, int(found[line, column])


#: bound, centre, walls and total have one row each. Views: outlines (zone, seq, px, py), raster_lines (y, row). Parameters: zone, factor.
ZONE_STATISTICS = """
WITH ring AS (SELECT seq, px, py FROM outlines WHERE zone = :zone),
bound AS (SELECT CAST(ceil(min(px)) - 1 AS INT) AS xlo, CAST(ceil(max(px)) + 1 AS INT) AS xhi, CAST(ceil(min(py)) - 1 AS INT) AS ylo, CAST(ceil(max(py)) + 1 AS INT) AS yhi FROM ring),
local AS (SELECT seq, (px - xlo) * :factor AS x, (py - ylo) * :factor AS y FROM ring, bound),
segment AS (SELECT seq, x AS x0, y AS y0, lead(x) OVER (ORDER BY seq) AS x1, lead(y) OVER (ORDER BY seq) AS y1 FROM local),
border AS (SELECT seq, d.k, d.x, d.y FROM (SELECT * FROM segment WHERE sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) > 1), LATERAL densified(x0, y0, x1, y1) d),
pair AS (SELECT x, y, coalesce(lead(x) OVER w, first(x) OVER w) AS x1, coalesce(lead(y) OVER w, first(y) OVER w) AS y1 FROM border WINDOW w AS (ORDER BY seq, k)),
crossed AS (SELECT x, y, x1, y1, CAST(x AS BIGINT) * y1 - CAST(x1 AS BIGINT) * y AS c FROM pair),
centre AS (SELECT CAST(sum((x + x1) * c) / (6D * (sum(c) * 0.5D)) AS INT) AS x, CAST(sum((y + y1) * c) / (6D * (sum(c) * 0.5D)) AS INT) AS y FROM crossed),
walls AS (SELECT collect_list(x) AS xs, collect_list(y) AS ys FROM (SELECT DISTINCT x, y FROM border)),
cut AS (
  SELECT CAST(y - ylo AS INT) AS y, slice(row, xlo + 1, xhi - xlo) AS row FROM raster_lines, bound WHERE y >= ylo AND y < yhi),
cell AS (SELECT y, x, CAST(v AS DOUBLE) AS v FROM cut LATERAL VIEW posexplode(row) AS x, v),
image AS (SELECT y, x, CASE WHEN v IS NULL THEN v WHEN isnan(top) THEN double('NaN') ELSE least(greatest(v, 0D), top) END AS v FROM cell, (SELECT max(v) AS top FROM cell)),
filled AS (
  SELECT f.x, f.y, f.weight FROM (
    SELECT samples * :factor AS width, lines * :factor AS height, x, y, xs, ys FROM walls, centre, (SELECT max(size(row)) AS samples, max(y) + 1 AS lines FROM cut)) z,
  LATERAL zone_fill(z.width, z.height, z.x, z.y, z.xs, z.ys, :factor) f),
hit AS (SELECT v, weight FROM image JOIN filled USING (y, x)),
total AS (SELECT sum(CASE WHEN v IS NOT NULL THEN weight END) AS n, sum(v * weight) / sum(CASE WHEN v IS NOT NULL THEN weight END) AS mean FROM hit)
SELECT :zone AS zone, coalesce(max(n), CAST(raise_error('the zone has no outline, or no pixel with a value') AS BIGINT)) AS n, max(mean) AS mean, sqrt(sum(weight * pow(v - mean, 2)) / max(n)) AS std,
  max(v) AS max, min(v) AS min, percentile(v, 0.25D, weight) AS p25, percentile(v, 0.5D, weight) AS p50, percentile(v, 0.75D, weight) AS p75 FROM hit, total"""


def register(spark: SparkSession) -> None:
    spark.udtf.register("densified", udtf(Densified, returnType="k int, x int, y int").asDeterministic())
    spark.udtf.register("zone_fill", udtf(ZoneFill, returnType="x int, y int, weight bigint").asDeterministic())


def zone_statistics(outlines: DataFrame, lines: DataFrame, zone, factor: int = 2) -> DataFrame:
    """The statistics of one zone of outlines (zone, seq, px, py) over a raster of packed lines (y, row), by ZONE_STATISTICS. The
    percentiles hold the distinct values of one zone; `stats.summary` is for zones beyond that."""
    spark = outlines.sparkSession
    register(spark)
    outlines.createOrReplaceTempView("outlines")
    lines.createOrReplaceTempView("raster_lines")
    return spark.sql(ZONE_STATISTICS, args={"zone": zone, "factor": factor})
