"""The same queries for DuckDB."""

from zonara.operators.geometry import CORNERS

_CELLS = "cell AS (SELECT CAST(vec_id AS INT) AS y, CAST(unnest(range(len(embedding))) AS INT) AS x, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"
_RING = """ring AS (SELECT n_nationkey AS zone, seq, CAST(32.0 + dx AS DOUBLE) AS x, CAST(10.0 + 20 * n_nationkey + dy AS DOUBLE) AS y
  FROM nation, (VALUES (0, -8, 1), (1, -3, -7), (2, 4, -8), (3, 9, -2), (4, 6, 6), (5, -2, 8), (6, -8, 1)) o(seq, dx, dy))"""


def _border(ring: str) -> str:
    return f"""seg AS (SELECT zone, seq, x AS x0, y AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM {ring} WINDOW w AS (PARTITION BY zone ORDER BY seq)),
sample AS (SELECT *, CASE WHEN k = 99 THEN x1 ELSE k * ((x1 - x0) / 99) + x0 END AS px FROM seg, range(100) r(k)
  WHERE x1 IS NOT NULL AND sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) > 1),
border AS (SELECT zone, seq, CAST(k AS INT) AS k, CAST(trunc(px) AS INT) AS x, CAST(trunc((y1 - y0) / (x1 - x0) * (px - x0) + y0) AS INT) AS y FROM sample),
wall AS (SELECT DISTINCT zone, x, y FROM border)"""


_CENTROID = """pair AS (SELECT zone, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x1, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y1 FROM border WINDOW w AS (PARTITION BY zone ORDER BY seq, k)),
crossed AS (SELECT *, CAST(x AS BIGINT) * y1 - CAST(x1 AS BIGINT) * y AS c FROM pair),
centre AS (SELECT zone, CAST(sum((x + x1) * c) AS DOUBLE) / (6 * (CAST(sum(c) AS DOUBLE) * 0.5)) AS cx, CAST(sum((y + y1) * c) AS DOUBLE) / (6 * (CAST(sum(c) AS DOUBLE) * 0.5)) AS cy FROM crossed GROUP BY zone)"""
_BORDER = f"{_RING}, {_border('ring')}"
_CENTRE = f"{_BORDER}, {_CENTROID}"
_FILL = f"""{_CENTRE},
fill AS (SELECT zone, CAST(trunc(cx) AS INT) AS x, CAST(trunc(cy) AS INT) AS y FROM centre
  UNION
  SELECT f.zone, f.x + dx, f.y + dy FROM fill f, (VALUES (-1, 0), (1, 0), (0, -1), (0, 1)) d(dx, dy)
  WHERE f.x + dx BETWEEN 0 AND 63 AND f.y + dy BETWEEN 0 AND 499 AND NOT EXISTS (SELECT 1 FROM wall b WHERE b.zone = f.zone AND b.x = f.x + dx AND b.y = f.y + dy))"""
_VALUES = f"{_FILL}, {_CELLS}, val AS (SELECT zone, v FROM fill JOIN cell USING (x, y))"
_WIDE = "wide AS (SELECT o_orderpriority, " + ", ".join(f"""coalesce(round(sum(CASE WHEN year(o_orderdate) = {y} THEN o_totalprice END), 2), 0) AS "{y}\"""" for y in range(1992, 1999)) + " FROM orders GROUP BY o_orderpriority)"
_LONG = """long AS (SELECT o_orderpriority, CAST(CAST("index" AS INT) - 1992 AS INT) AS pos, "index", valor FROM wide UNPIVOT (valor FOR "index" IN ("1992", "1993", "1994", "1995", "1996", "1997", "1998")))"""
_PIXEL = f"{_RING}, pixel AS (SELECT zone, seq, ((-100.0::DOUBLE + x * 0.15::DOUBLE) - -100.0::DOUBLE) / (10.0::DOUBLE / 64) AS px, (30.0::DOUBLE - (30.0::DOUBLE - y * 0.02::DOUBLE)) / (10.0::DOUBLE / 500) AS py FROM ring)"
_WINDOW = "win AS (SELECT * FROM cell WHERE y >= 10 AND y < 40 AND x >= 5 AND x < 50)"
_CROP = f"""{_PIXEL}, {_CELLS},
size AS (SELECT max(y) + 1 AS height, max(x) + 1 AS width FROM cell),
bound AS (SELECT zone, CAST(ceil(min(px)) - 1 AS INT) AS xlo, CAST(ceil(max(px)) + 1 AS INT) AS xhi, CAST(ceil(min(py)) - 1 AS INT) AS ylo, CAST(ceil(max(py)) + 1 AS INT) AS yhi FROM pixel GROUP BY zone),
cut AS (SELECT zone, CAST(y - ylo AS INT) AS y, CAST(x - xlo AS INT) AS x, v FROM bound, cell WHERE y >= ylo AND y < yhi AND x >= xlo AND x < xhi),
image AS (SELECT zone, y, x, least(greatest(v, 0), max(v) OVER (PARTITION BY zone)) AS v FROM cut),
local AS (SELECT zone, seq, (px - xlo) * 2 AS x, (py - ylo) * 2 AS y FROM pixel JOIN bound USING (zone))"""
_UPSCALED = f"""{_CROP}, {_border('local')}, {_CENTROID},
fill AS (SELECT zone, CAST(trunc(cx) AS INT) AS x, CAST(trunc(cy) AS INT) AS y FROM centre
  UNION
  SELECT f.zone, f.x + dx, f.y + dy FROM fill f JOIN bound ON bound.zone = f.zone, size, (VALUES (-1, 0), (1, 0), (0, -1), (0, 1)) d(dx, dy)
  WHERE f.x + dx >= 0 AND f.x + dx < 2 * (least(xhi, width) - xlo) AND f.y + dy >= 0 AND f.y + dy < 2 * (least(yhi, height) - ylo)
    AND NOT EXISTS (SELECT 1 FROM wall b WHERE b.zone = f.zone AND b.x = f.x + dx AND b.y = f.y + dy)),
val AS (SELECT f.zone, v FROM fill f JOIN image i ON i.zone = f.zone AND i.y = f.y // 2 AND i.x = f.x // 2)"""


def _histogram(keys: str) -> str:
    on = "USING (zone)" if keys else "ON true"
    k = "zone, " if keys else ""
    group = "GROUP BY zone" if keys else ""
    return f"""
raw AS (SELECT {k}min(v) AS a, max(v) AS b FROM val {group}),
edge AS (SELECT {k}CASE WHEN a = b THEN a - 0.5 ELSE a END AS a, CASE WHEN a = b THEN b + 0.5 ELSE b END AS b FROM raw),
num AS (SELECT {k}CAST(least(floor((v - a) * 50 / (b - a)), 49) AS INT) AS bin, count(*) AS n FROM val JOIN edge {on} GROUP BY ALL)
SELECT {k}bin, round(a + bin * ((b - a) / 50), 6) AS lo, round(a + (bin + 1) * ((b - a) / 50), 6) AS hi, coalesce(n, 0) AS n
FROM (SELECT edge.*, CAST(r.bin AS INT) AS bin FROM edge, range(50) r(bin)) LEFT JOIN num USING ({k}bin)"""


_SUMMARY = """SELECT zone, count(*) AS n, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(max(v), 6) AS max, round(min(v), 6) AS min,
round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75 FROM val GROUP BY zone"""

# The corner patterns are those of the geometry operators.
_CORNER = f"corner AS (SELECT {{key}}, regexp_extract(s, '{CORNERS['ul']}', ['x', 'y']) AS ul, regexp_extract(s, '{CORNERS['lr']}', ['x', 'y']) AS lr FROM {{table}})"
_TILES = f"""meta AS (SELECT n_nationkey AS tile, 'GridName="g" UpperLeftPointMtrs=(' || ((-120 + 10 * (n_nationkey % 5)) * 1000000) || '.0,' || ((40 - 10 * (n_nationkey // 5)) * 1000000) || '.0) LowerRightMtrs=('
  || ((-120 + 10 * (n_nationkey % 5 + 1)) * 1000000) || '.0,' || ((40 - 10 * (n_nationkey // 5 + 1)) * 1000000) || '.0)' AS s FROM nation),
{_CORNER.format(key="tile", table="meta")},
line AS (SELECT CAST(vec_id % 25 AS INT) AS tile, vec_id // 25 AS y, embedding FROM embeddings),
box AS (SELECT tile, CAST(ul.x AS DOUBLE) / 1000000 AS ul_x, CAST(ul.y AS DOUBLE) / 1000000 AS ul_y, CAST(lr.x AS DOUBLE) / 1000000 AS lr_x, CAST(lr.y AS DOUBLE) / 1000000 AS lr_y, height FROM corner JOIN (SELECT tile, max(y) + 1 AS height FROM line GROUP BY tile) USING (tile)),
wide AS (SELECT n_nationkey AS zone, seq, -112.0::DOUBLE + 1.4::DOUBLE * n_nationkey + 0.8::DOUBLE * dx AS x, 32.0::DOUBLE - 1.3::DOUBLE * n_nationkey + 0.8::DOUBLE * dy AS y
  FROM nation, (VALUES (0, -8, 1), (1, -3, -7), (2, 4, -8), (3, 9, -2), (4, 6, 6), (5, -2, 8), (6, -8, 1)) o(seq, dx, dy)),
placed AS (SELECT zone, seq, tile, round((x - ul_x) / (10.0::DOUBLE / 64), 6) AS px, round((ul_y - y) / (10.0::DOUBLE / height), 6) AS py FROM wide JOIN box ON x >= ul_x AND x < lr_x AND y > lr_y AND y <= ul_y)"""

SQL = {
    "zonal_stats": f"WITH RECURSIVE {_VALUES} {_SUMMARY}",
    "zonal_stats_upscaled": f"WITH RECURSIVE {_UPSCALED} {_SUMMARY}",
    "zone_by_statement": f"WITH RECURSIVE {_UPSCALED} SELECT * FROM ({_SUMMARY}) WHERE zone = 7",
    "zonal_histogram_upscaled": f"WITH RECURSIVE {_UPSCALED}, {_histogram('zone')}",
    "zone_window_histogram": f"WITH {_CROP}, val AS (SELECT zone, v FROM image), {_histogram('zone')}",
    "zone_outline_local": f"WITH {_CROP} SELECT zone, seq, round(x, 6) AS x, round(y, 6) AS y FROM local",
    "raster_shape": f"WITH {_CELLS} SELECT CAST(max(y) + 1 AS INT) AS height, CAST(max(x) + 1 AS INT) AS width FROM cell",
    "raster_preview": "SELECT CAST(vec_id AS INT) AS y, CAST(len(embedding) AS INT) AS samples, round(CAST(embedding[1] AS DOUBLE), 6) AS first, round(CAST(embedding[-1] AS DOUBLE), 6) AS last FROM embeddings WHERE vec_id < 250",
    "series_log": f"WITH {_WIDE}, {_LONG} SELECT o_orderpriority, pos, \"index\", round(valor, 6) AS valor, round(CASE WHEN valor < 0 THEN 'nan'::DOUBLE WHEN valor = 0 THEN '-inf'::DOUBLE ELSE ln(valor) END, 6) AS log FROM long WHERE o_orderpriority = '1-URGENT'",
    "series_unpivot": f"WITH {_WIDE}, {_LONG} SELECT o_orderpriority, pos, \"index\", round(valor, 6) AS valor FROM long",
    "raster_cells": f"WITH {_CELLS} SELECT y, x, round(v, 6) AS v FROM cell",
    "raster_crop": f"WITH {_CELLS} SELECT y, x, round(v, 6) AS v FROM cell WHERE y BETWEEN 0 AND 249 AND x BETWEEN 0 AND 254",
    "raster_clip": f"WITH {_CROP} SELECT zone, y, x, round(v, 6) AS v FROM image",
    "raster_upscale": f"WITH {_CROP} SELECT zone, CAST(y * 2 + dy AS INT) AS y, CAST(x * 2 + dx AS INT) AS x, round(v, 6) AS v FROM image, (VALUES (0), (1)) a(dy), (VALUES (0), (1)) b(dx)",
    "raster_clip_all": f"WITH {_CELLS} SELECT y, x, round(least(greatest(v, 0), max(v) OVER ()), 6) AS v FROM cell",
    "raster_upscale_all": f"WITH {_CELLS} SELECT CAST(y * 2 + dy AS INT) AS y, CAST(x * 2 + dx AS INT) AS x, round(v, 6) AS v FROM cell, (VALUES (0), (1)) a(dy), (VALUES (0), (1)) b(dx)",
    "raster_burn": f"WITH {_CELLS}, {_BORDER}, mark AS (SELECT DISTINCT x, y FROM border) SELECT cell.y, cell.x, round(CASE WHEN mark.x IS NULL THEN v ELSE 2500 END, 6) AS v FROM cell LEFT JOIN mark USING (x, y)",
    "georef_parse": f"""WITH t AS (SELECT n_nationkey, 'GridName="g" UpperLeftPointMtrs=(-' || (100000000 + n_nationkey * 1000000) || '.5,' || (30000000 - n_nationkey) || ') LowerRightMtrs=(' || (n_nationkey * 250000) || ',-' || (n_nationkey * 125000) || '.25)' AS s FROM nation),
{_CORNER.format(key="n_nationkey", table="t")} SELECT n_nationkey, {", ".join(f"round(CAST({c}.{axis} AS DOUBLE) / 1000000, 6) AS {c}_{axis}" for c in ("ul", "lr") for axis in "xy")} FROM corner""",
    "feature_lookup": "SELECT k, min(event_id) AS event_id, round(arg_min(value, event_id), 6) AS value FROM (SELECT CAST(json_extract_string(props, '$.k') AS INT) AS k, event_id, value FROM events) WHERE k BETWEEN 0 AND 15 GROUP BY k",
    "world_to_pixel": f"WITH {_PIXEL} SELECT zone, seq, round(px, 6) AS px, round(py, 6) AS py FROM pixel",
    "crop_bounds": f"WITH {_RING} SELECT zone, CAST(ceil(min(x)) - 1 AS INT) AS xlo, CAST(ceil(max(x)) + 1 AS INT) AS xhi, CAST(ceil(min(y)) - 1 AS INT) AS ylo, CAST(ceil(max(y)) + 1 AS INT) AS yhi FROM ring GROUP BY zone",
    "edge_densify": f"WITH {_BORDER} SELECT zone, seq, k, x, y FROM border",
    "polygon_centroid": f"WITH {_CENTRE} SELECT zone, round(cx, 6) AS cx, round(cy, 6) AS cy FROM centre",
    "border_antijoin": f"WITH {_CELLS}, {_BORDER} SELECT y, x, round(v, 6) AS v FROM cell WHERE NOT EXISTS (SELECT 1 FROM border WHERE border.x = cell.x AND border.y = cell.y)",
    "flood_fill": f"WITH RECURSIVE {_FILL} SELECT zone, x, y FROM fill",
    "zonal_histogram": f"WITH RECURSIVE {_VALUES}, {_histogram('zone')}",
    "window_histogram": f"WITH {_CELLS}, {_WINDOW}, val AS (SELECT v FROM win), {_histogram('')}",
    "zone_overlay": f"WITH {_PIXEL} SELECT n_name, seq, round(px, 6) AS px, round(py, 6) AS py FROM pixel JOIN nation ON n_nationkey = zone",
    "catalog_tree": """WITH node AS (SELECT 'embeddings' AS part, * FROM (SELECT column_name, row_number() OVER () AS pos FROM (DESCRIBE embeddings)) UNION ALL SELECT 'nation', * FROM (SELECT column_name, row_number() OVER () FROM (DESCRIBE nation))
  UNION ALL SELECT 'region', * FROM (SELECT column_name, row_number() OVER () FROM (DESCRIBE region))),
part AS (SELECT part, 0 AS pos, '- ' || part AS line FROM node GROUP BY part UNION ALL SELECT part, pos, '  - ' || column_name FROM node)
SELECT CAST(row_number() OVER (ORDER BY part, pos) - 1 AS INT) AS ord, line FROM part""",
    "grid_lines": "SELECT CAST(vec_id AS INT) AS y, CAST(len(embedding) AS INT) AS samples, round(CAST(embedding[1] AS DOUBLE), 6) AS first, round(CAST(embedding[-1] AS DOUBLE), 6) AS last FROM embeddings WHERE vec_id >= 100 AND vec_id < 400",
    "boundary_file": f"WITH {_RING} SELECT n_name AS zone, CAST(seq AS INT) AS seq, round(x, 6) AS x, round(y, 6) AS y FROM ring JOIN nation ON n_nationkey = zone",
    "flood_fill_runs": f"WITH RECURSIVE {_FILL} SELECT zone, x, y FROM fill",
    "tile_pixels": f"WITH {_TILES} SELECT zone, seq, tile, px, py FROM placed",
    "tile_overlay": f"""WITH {_TILES} SELECT 'image' AS layer, tile, CAST(NULL AS INT) AS zone, CAST(NULL AS INT) AS seq, CAST(unnest(range(least(len(embedding), 255))) AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, round(CAST(unnest(embedding[1:255]) AS DOUBLE), 6) AS v FROM line WHERE y < 250
UNION ALL SELECT 'outline', tile, zone, seq, px, py, NULL FROM placed""",
    "catalog_names": "SELECT r_regionkey AS ord, r_name AS name FROM region",
}
SQL |= {"series_file": SQL["series_log"], "boundary_lines": SQL["boundary_file"]}
