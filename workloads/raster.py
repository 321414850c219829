"""Raster and cube queries."""

import math

from pyspark.sql import functions as F

from cellsheaf import aoi as aoi_mod
from cellsheaf import registry
from cellsheaf.operators import cells as cell_ops
from cellsheaf.operators import clip, resample
from cellsheaf.sources import tables
from cellsheaf.sources.scratch import shared_folder
from workloads.case import case
from workloads.fixtures import AREAS, areas, view


def hi(spark, sf):
    return view(spark, sf, "fx_grid_hi").select("raster_id", "band", "r", "c", "v")


def lo(spark, sf):
    return view(spark, sf, "fx_grid_lo")


def meta_hi(spark, sf):
    return view(spark, sf, "fx_meta_hi")


def meta_lo(spark, sf):
    return view(spark, sf, "fx_meta_lo")


@case(
    "r1_normalise_coords",
    "SELECT i, round(lon, 6) AS x, round(lat, 6) AS y, var FROM {fx_swath}",
)
def normalise_coords(spark, sf):
    df = view(spark, sf, "fx_swath").select("i", F.col("lon").alias("Longitude"), F.col("lat").alias("LATITUDE"), "var")
    return cell_ops.normalise_coords(df).select("i", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "var")


@case(
    "r2_rename_vars",
    """
SELECT l_orderkey, l_linenumber, CASE var WHEN '2m_temperature' THEN 't2m' WHEN 'total_precipitation' THEN 'tp' ELSE 'ssrd' END AS var, v FROM {fx_cube}""",
)
def rename_vars(spark, sf):
    return cell_ops.rename_vars(view(spark, sf, "fx_cube")).select("l_orderkey", "l_linenumber", "var", "v")


@case("r3_unify_time", "SELECT var, t AS time, sum(v) AS total FROM {fx_cube} GROUP BY 1, 2")
def unify_time(spark, sf):
    df = cell_ops.unify_time(view(spark, sf, "fx_cube").withColumnRenamed("t", "valid_time"))
    return df.groupBy("var", "time").agg(F.sum("v").alias("total"))


@case("r4_decode_packed", "SELECT r, c, round(nullif(v, -9999e0) * 1e-4 + 25e-2, 6) AS v FROM {fx_grid_hi}")
def decode_packed(spark, sf):
    out = cell_ops.decode_packed(hi(spark, sf), scale=1e-4, offset=0.25, fill=-9999.0)
    return out.select("r", "c", F.round("v", 6).alias("v"))


@case("r5_apply_cells", "SELECT r, c, round(v * 1e-4, 6) AS v FROM {fx_grid_hi}")
def apply_cells(spark, sf):
    out = cell_ops.apply_cells(hi(spark, sf), lambda v: v * F.lit(registry.REFLECTANCE_SCALE))
    return out.select("r", "c", F.round("v", 6).alias("v"))


@case("r6_nodata_to_null", "SELECT r, c, nullif(v, -9999e0) AS v FROM {fx_grid_hi}")
def nodata_to_null(spark, sf):
    return cell_ops.nodata_to_null(hi(spark, sf), meta_hi(spark, sf)).select("r", "c", "v")


_X, _Y = "(-124e0 + (c + 5e-1) * 8e-2)", "(42e0 + (r + 5e-1) * -8e-2)"


@case("r7_pixel_centres", f"SELECT r, c, round({_X}, 6) AS x, round({_Y}, 6) AS y, v FROM {{fx_grid_hi}}")
def pixel_centres(spark, sf):
    out = cell_ops.pixel_centres(hi(spark, sf), meta_hi(spark, sf))
    return out.select("r", "c", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "v")


# Brute force: every pixel of the raster against every edge of every area.
_INSIDE = f"""
WITH ctr AS (SELECT r, c, v, {_X} AS x, {_Y} AS y, -124e0 + c * 8e-2 AS xl, -124e0 + (c + 1) * 8e-2 AS xr,
             42e0 + r * -8e-2 AS yh, 42e0 + (r + 1) * -8e-2 AS yl FROM {{fx_grid_hi}}),
ctr_in AS (SELECT aoi_id, r, c, v FROM ctr JOIN {{area_edge}} e ON ((e.y1 > y) <> (e.y2 > y))
   AND x < e.x1 + (y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) GROUP BY ALL HAVING count(*) % 2 = 1)"""
_TOUCH = (
    _INSIDE
    + """,
near AS (SELECT aoi_id, r, c, v, xl, xr, e.*, greatest(yl, least(y1, y2)) AS lo, least(yh, greatest(y1, y2)) AS hi FROM ctr JOIN {area_edge} e
   ON yl <= greatest(y1, y2) AND yh >= least(y1, y2)),
band AS (SELECT *, CASE WHEN y1 = y2 THEN x1 ELSE x1 + (lo - y1) * (x2 - x1) / (y2 - y1) END AS xa,
   CASE WHEN y1 = y2 THEN x2 ELSE x1 + (hi - y1) * (x2 - x1) / (y2 - y1) END AS xb FROM near),
touch AS (SELECT aoi_id, r, c, v FROM ctr_in UNION SELECT aoi_id, r, c, v FROM band WHERE xl <= greatest(xa, xb) AND xr >= least(xa, xb))"""
)


@case("r8_clip_centre", _INSIDE + " SELECT aoi_id, r, c, v FROM ctr_in WHERE aoi_id <> 'A1'")
def clip_centre(spark, sf):
    return clip.clip(hi(spark, sf), meta_hi(spark, sf), areas("A2", "A3", "A4", "A5"), "centre").select("aoi_id", "r", "c", "v")


@case("r9_clip_touched", _TOUCH + " SELECT aoi_id, r, c, v FROM touch WHERE aoi_id IN ('A4', 'A5')")
def clip_touched(spark, sf):
    return clip.clip(hi(spark, sf), meta_hi(spark, sf), areas("A4", "A5"), "touched").select("aoi_id", "r", "c", "v")


_COS, _SIN = ([f(math.radians(d)) for d in range(361)] for f in (math.cos, math.sin))


# Irregular outlines with few enough edges for the expression plan, and with more.
def _outline(n):
    turn = [(i * 7 % n) for i in range(n)]
    pts = [(-119.013 + (3.1 + 0.37 * (k % 4)) * _COS[round(i * 360 / n)], 39.517 + (1.9 + 0.23 * (k % 3)) * _SIN[round(i * 360 / n)]) for i, k in enumerate(turn)]
    pts = [(round(x, 6), round(y, 6)) for x, y in pts]
    return aoi_mod.from_geojson(f"P{n}", {"type": "Polygon", "coordinates": [[*pts, pts[0]]]})


_OUTLINED = [areas("A5")[0], _outline(13), _outline(27), _outline(29), _outline(40)]
_OUTLINED_EDGES = ", ".join(f"('{a.aoi_id}', {', '.join(f'{v!r}e0' for v in e)})" for a in _OUTLINED for e in a.edges)


def _many_rasters(spark, sf):
    """The fine raster as it is, mirrored (dx < 0) and upside down (dy > 0), each with cells off its frame; and their grids."""
    h = F.col("height")
    meta = meta_hi(spark, sf)
    kinds = F.explode(F.array(F.lit("plain"), F.lit("mirrored"), F.lit("flipped")))
    x0, dx = F.when(F.col("k") == "mirrored", -114.0).otherwise(-124.0), F.when(F.col("k") == "mirrored", -0.08).otherwise(0.08)
    y0, dy = F.when(F.col("k") == "flipped", 42.0 - h * 0.08).otherwise(42.0), F.when(F.col("k") == "flipped", 0.08).otherwise(-0.08)
    grids = meta.withColumn("k", kinds).select(
        F.col("k").alias("raster_id"), "epsg", x0.alias("x0"), y0.alias("y0"), dx.alias("dx"), dy.alias("dy"), "width", "height", "nodata"
    )
    cells = hi(spark, sf).join(F.broadcast(meta.select("height"))).withColumn("k", kinds)
    c = F.when(F.col("k") == "mirrored", 124 - F.col("c")).otherwise(F.col("c"))
    r = F.when(F.col("k") == "flipped", h - 1 - F.col("r")).otherwise(F.col("r"))
    inside = cells.select(F.col("k").alias("raster_id"), r.alias("r"), c.alias("c"), "v")
    off = inside.where("r = 2").select("raster_id", F.lit(-1).alias("r"), "c", "v").unionByName(inside.where("c = 3").select("raster_id", "r", F.lit(130).alias("c"), "v"))
    return inside.unionByName(off), grids


_MANY = f"""
WITH e AS (SELECT * FROM (VALUES {_OUTLINED_EDGES}) AS t(aoi_id, x1, y1, x2, y2)),
ctr AS (SELECT r, c, v, {_X} AS x, {_Y} AS y, -124e0 + c * 8e-2 AS xl, -124e0 + (c + 1) * 8e-2 AS xr, 42e0 + r * -8e-2 AS yh, 42e0 + (r + 1) * -8e-2 AS yl FROM {{fx_grid_hi}}),
ctr_in AS (SELECT aoi_id, r, c, v FROM ctr JOIN e ON ((e.y1 > y) <> (e.y2 > y))
   AND x < e.x1 + (y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) GROUP BY ALL HAVING count(*) % 2 = 1),
near AS (SELECT aoi_id, r, c, v, xl, xr, e.*, greatest(yl, least(y1, y2)) AS lo, least(yh, greatest(y1, y2)) AS hi FROM ctr JOIN e ON yl <= greatest(y1, y2) AND yh >= least(y1, y2)),
band AS (SELECT *, CASE WHEN y1 = y2 THEN x1 ELSE x1 + (lo - y1) * (x2 - x1) / (y2 - y1) END AS xa, CASE WHEN y1 = y2 THEN x2 ELSE x1 + (hi - y1) * (x2 - x1) / (y2 - y1) END AS xb FROM near),
touch AS (SELECT aoi_id, r, c, v FROM ctr_in UNION SELECT aoi_id, r, c, v FROM band WHERE xl <= greatest(xa, xb) AND xr >= least(xa, xb)),
k AS (SELECT * FROM (VALUES ('plain'), ('mirrored'), ('flipped')) AS t(raster_id))
SELECT raster_id, aoi_id, cast(CASE raster_id WHEN 'flipped' THEN (SELECT height FROM {{fx_meta_hi}}) - 1 - r ELSE r END AS int) AS r,
   cast(CASE raster_id WHEN 'mirrored' THEN 124 - c ELSE c END AS int) AS c, v FROM """


def _clipped_both_ways(spark, sf, rule):
    cells, grids = _many_rasters(spark, sf)
    each = [clip.clip(cells, grids, [a], rule) for a in _OUTLINED[:2]]
    rest = clip.clip(cells, grids, _OUTLINED[2:], rule)
    out = each[0].unionByName(each[1]).unionByName(rest)
    return out.select("raster_id", "aoi_id", F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), "v")


@case("r8_clip_centre_many_rasters", _MANY + "ctr_in CROSS JOIN k")
def clip_centre_many_rasters(spark, sf):
    return _clipped_both_ways(spark, sf, "centre")


@case("r9_clip_touched_many_rasters", _MANY + "touch CROSS JOIN k")
def clip_touched_many_rasters(spark, sf):
    return _clipped_both_ways(spark, sf, "touched")


def _area_table(spark):
    from cellsheaf.aoi import frame

    return frame(spark, AREAS)


@case("r8_clip_centre_spans", _INSIDE + " SELECT aoi_id, r, c, v FROM ctr_in")
def clip_centre_spans(spark, sf):
    out = clip.clip(hi(spark, sf), meta_hi(spark, sf), _area_table(spark), "centre")
    return out.select("aoi_id", "r", "c", "v")


@case("r9_clip_touched_spans", _TOUCH + " SELECT aoi_id, r, c, v FROM touch")
def clip_touched_spans(spark, sf):
    out = clip.clip(hi(spark, sf), meta_hi(spark, sf), _area_table(spark), "touched")
    return out.select("aoi_id", "r", "c", "v")


_WINDOW = """, win AS (SELECT aoi_id, greatest(floor((minx + 124e0) / 8e-2), 0) AS c0, least(ceil((maxx + 124e0) / 8e-2), 125) AS c1,
   greatest(floor((maxy - 42e0) / -8e-2), 0) AS r0, least(ceil((miny - 42e0) / -8e-2), (SELECT height FROM {fx_meta_hi})) AS r1 FROM {area_box})"""


@case(
    "r10_crop_window",
    _INSIDE
    + _WINDOW
    + " SELECT aoi_id, cast(r - r0 AS int) AS r, cast(c - c0 AS int) AS c, v FROM ctr JOIN win ON r >= r0 AND r < r1 AND c >= c0 AND c < c1",
)
def crop_window(spark, sf):
    out = clip.crop_window(hi(spark, sf), meta_hi(spark, sf), AREAS)
    return out.select("aoi_id", "r", "c", "v")


@case(
    "r10_crop_grids",
    _INSIDE
    + _WINDOW
    + """ SELECT aoi_id, round(-124e0 + c0 * 8e-2, 6) AS x0, round(42e0 + r0 * -8e-2, 6) AS y0, cast(c1 - c0 AS int) AS width,
   cast(r1 - r0 AS int) AS height, (SELECT nodata FROM {fx_meta_hi}) AS nodata FROM win WHERE c0 < c1 AND r0 < r1""",
)
def crop_grids(spark, sf):
    out = clip.crop_grids(meta_hi(spark, sf), AREAS)
    return out.select("aoi_id", F.round("x0", 6).alias("x0"), F.round("y0", 6).alias("y0"), "width", "height", "nodata")


_OUTSIDE = """
   SELECT w.aoi_id, cast(ctr.r - r0 AS int) AS r, cast(ctr.c - c0 AS int) AS c, CASE WHEN i.aoi_id IS NULL THEN {out} ELSE ctr.v END AS v
   FROM ctr JOIN win w ON ctr.r >= r0 AND ctr.r < r1 AND ctr.c >= c0 AND ctr.c < c1
   LEFT JOIN {hits} i ON i.aoi_id = w.aoi_id AND i.r = ctr.r AND i.c = ctr.c"""


@case("r11_outside_null", _TOUCH + _WINDOW + _OUTSIDE.replace("{out}", "NULL").replace("{hits}", "touch"))
def outside_null(spark, sf):
    out = clip.crop_window(hi(spark, sf), meta_hi(spark, sf), AREAS, "touched", outside="null")
    return out.select("aoi_id", "r", "c", "v")


@case("r11_outside_fill", _INSIDE + _WINDOW + _OUTSIDE.replace("{out}", "-9999e0").replace("{hits}", "ctr_in"))
def outside_fill(spark, sf):
    out = clip.crop_window(hi(spark, sf), meta_hi(spark, sf), _area_table(spark), "centre", outside="fill", fill=-9999.0)
    return out.select("aoi_id", "r", "c", "v")


def _band_grids(spark, sf):
    """Both rasters as bands of one scene per sensor day: every scene shares the two shapes."""
    hi_g = meta_hi(spark, sf).select(F.lit("B4").alias("band"), F.lit(0).alias("pos"), "dx", "dy", "width", "height")
    lo_g = meta_lo(spark, sf).select(F.lit("B11").alias("band"), F.lit(1).alias("pos"), "dx", "dy", "width", "height")
    return hi_g.unionByName(lo_g).withColumn("scene_id", F.lit("s"))


@case(
    "r12_master_grid",
    """
WITH a AS (SELECT scene_id, asset_key AS band, strpos('nir,red,green,blue,swir16', asset_key) AS pos,
   CASE asset_key WHEN 'swir16' THEN 50 WHEN 'nir' THEN 120 ELSE 125 END AS width,
   CASE asset_key WHEN 'swir16' THEN 40 ELSE 120 END AS height FROM {fx_asset})
SELECT scene_id, band, width, height FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY width * height DESC, pos) AS k FROM a) WHERE k = 1""",
)
def master_grid(spark, sf):
    key = F.col("asset_key")
    grids = view(spark, sf, "fx_asset").select(
        "scene_id",
        key.alias("band"),
        F.instr(F.lit("nir,red,green,blue,swir16"), key).alias("pos"),
        F.when(key == "swir16", 50).when(key == "nir", 120).otherwise(125).alias("width"),
        F.when(key == "swir16", 40).otherwise(120).alias("height"),
    )
    return resample.master_grid(grids).select("scene_id", "band", "width", "height")


# Gather form of bilinear interpolation: four neighbours per target pixel, clamped at the edges.
_BILINEAR = """
WITH sz AS (SELECT 125 AS wt, (SELECT height FROM {fx_meta_hi}) AS ht, 50 AS ws, (SELECT height FROM {fx_meta_lo}) AS hs),
tgt AS (SELECT r, c, least(greatest((r + 5e-1) * hs / ht - 5e-1, 0e0), hs - 1e0) AS sr, least(greatest((c + 5e-1) * ws / wt - 5e-1, 0e0), ws - 1e0) AS sc, ws, hs
   FROM sz, (SELECT unnest(range((SELECT max(height) FROM {fx_meta_hi}))) AS r), (SELECT unnest(range(125)) AS c)),
nb AS (SELECT r, c, least(floor(sr) + i, hs - 1) AS qr, least(floor(sc) + j, ws - 1) AS qc,
   (CASE i WHEN 0 THEN 1e0 - (sr - floor(sr)) ELSE sr - floor(sr) END) * (CASE j WHEN 0 THEN 1e0 - (sc - floor(sc)) ELSE sc - floor(sc) END) AS w
   FROM tgt, (VALUES (0), (1)) AS a(i), (VALUES (0), (1)) AS b(j)),
up AS (SELECT nb.r, nb.c, sum(w * v) / sum(w) AS v FROM nb JOIN {fx_grid_lo} l ON l.r = qr AND l.c = qc WHERE w > 0 GROUP BY 1, 2)
"""


@case("r13_upsample_bilinear", _BILINEAR + "SELECT r, c, round(v, 6) AS v FROM up")
def upsample_bilinear(spark, sf):
    target = meta_hi(spark, sf).withColumn("raster_id", F.lit("lo"))
    out = resample.upsample_bilinear(lo(spark, sf), meta_lo(spark, sf), target)
    return out.select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), F.round("v", 6).alias("v"))


@case(
    "r14_stack_bands",
    """
SELECT r, c, max(v) FILTER (band = 'B4') AS "B4", max(v) FILTER (band = 'B11') AS "B11" FROM
 (SELECT r, c, band, v FROM {fx_grid_hi} UNION ALL SELECT r, c, band, v FROM {fx_grid_lo}) GROUP BY r, c""",
)
def stack_bands(spark, sf):
    both = hi(spark, sf).unionByName(lo(spark, sf)).withColumn("scene_id", F.lit("s"))
    return resample.stack_bands(both, ["B4", "B11"], ["scene_id"]).drop("scene_id")


@case(
    "r14_align_and_stack",
    _BILINEAR + 'SELECT up.r, up.c, round(h.v, 6) AS "B4", round(up.v, 6) AS "B11" FROM up LEFT JOIN {fx_grid_hi} h USING (r, c)',
)
def align_and_stack(spark, sf):
    both = hi(spark, sf).unionByName(lo(spark, sf)).withColumn("scene_id", F.lit("s"))
    out = resample.align_and_stack(both, _band_grids(spark, sf), ["B4", "B11"])
    return out.select(
        F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"),
        F.round("B4", 6).alias("B4"), F.round("B11", 6).alias("B11"),
    )


@case(
    "r15_target_grid",
    """
WITH g AS (SELECT raster_id, width * abs(dx) AS w, height * abs(dy) AS h, dx, dy FROM (SELECT * FROM {fx_meta_hi} UNION ALL SELECT * FROM {fx_meta_lo})),
n AS (SELECT *, greatest(floor(w / 3e-1), 1) AS nw, greatest(floor(h / 3e-1), 1) AS nh FROM g)
SELECT raster_id, cast(nw AS int) AS width, cast(nh AS int) AS height, round(sign(dx) * w / nw, 6) AS dx, round(sign(dy) * h / nh, 6) AS dy FROM n""",
)
def target_grid(spark, sf):
    out = resample.target_grid(meta_hi(spark, sf).unionByName(meta_lo(spark, sf)), 0.3)
    return out.select("raster_id", "width", "height", F.round("dx", 6).alias("dx"), F.round("dy", 6).alias("dy"))


# Overlap-weighted average of a raster of WS x HS pixels given as cells(r, c, v).
def average_sql(cells, ws, hs, wt, ht):
    return f"""
az AS (SELECT {ws}::double / {wt} AS sx, {hs}::double / {ht} AS sy, {wt} AS wt, {ht} AS ht),
rw AS (SELECT r, k, least(r + 1e0, (k + 1) * sy) - greatest(r * 1e0, k * sy) AS w FROM az, (SELECT unnest(range({hs})) AS r) JOIN (SELECT unnest(range({ht})) AS k) ON true
   WHERE least(r + 1e0, (k + 1) * sy) - greatest(r * 1e0, k * sy) > 1e-9),
cw AS (SELECT c, k, least(c + 1e0, (k + 1) * sx) - greatest(c * 1e0, k * sx) AS w FROM az, (SELECT unnest(range({ws})) AS c) JOIN (SELECT unnest(range({wt})) AS k) ON true
   WHERE least(c + 1e0, (k + 1) * sx) - greatest(c * 1e0, k * sx) > 1e-9),
avg_ AS (SELECT rw.k AS r, cw.k AS c, sum(rw.w * cw.w * v) / nullif(sum(CASE WHEN v IS NOT NULL THEN rw.w * cw.w END), 0e0) AS v
   FROM {cells} s JOIN rw ON rw.r = s.r JOIN cw ON cw.c = s.c GROUP BY 1, 2)"""


_H = "(SELECT max(height) FROM {fx_meta_hi})"


@case(
    "r16_downsample_average",
    "WITH src AS (SELECT r, c, nullif(v, -9999e0) AS v FROM {fx_grid_hi}), "
    + average_sql("src", "125", _H, "33", f"greatest(cast(floor({_H} * 8e-2 / 3e-1) AS int), 1)")
    + " SELECT r, c, round(v, 4) AS v FROM avg_",
)
def downsample_average(spark, sf):
    grids = meta_hi(spark, sf)
    cells = cell_ops.nodata_to_null(hi(spark, sf), grids)
    out = resample.downsample_average(cells, grids, resample.target_grid(grids, 0.3))
    return out.select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), F.round("v", 4).alias("v"))


@case(
    "r17_clip_all",
    """
WITH cells AS (SELECT var, t, r, c, v, l_orderkey, l_linenumber, -124e0 + (c + 5e-1) * 2e-1 AS x, 42e0 + (r + 5e-1) * -1e0 AS y,
   -124e0 + c * 2e-1 AS xl, -124e0 + (c + 1) * 2e-1 AS xr, 42e0 + r * -1e0 AS yh, 42e0 + (r + 1) * -1e0 AS yl FROM {fx_cube}),
px AS (SELECT DISTINCT r, c, x, y, xl, xr, yh, yl FROM cells),
a5 AS (SELECT * FROM {area_edge} WHERE aoi_id = 'A5'),
cin AS (SELECT r, c FROM px JOIN a5 e ON (e.y1 > y) <> (e.y2 > y) AND x < e.x1 + (y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) GROUP BY r, c HAVING count(*) % 2 = 1),
near AS (SELECT r, c, xl, xr, e.*, greatest(yl, least(y1, y2)) AS lo, least(yh, greatest(y1, y2)) AS hi FROM px JOIN a5 e ON yl <= greatest(y1, y2) AND yh >= least(y1, y2)),
band AS (SELECT *, x1 + (lo - y1) * (x2 - x1) / (y2 - y1) AS xa, x1 + (hi - y1) * (x2 - x1) / (y2 - y1) AS xb FROM near),
hit AS (SELECT r, c FROM cin UNION SELECT r, c FROM band WHERE xl <= greatest(xa, xb) AND xr >= least(xa, xb))
SELECT var, t, r, c, v, l_orderkey, l_linenumber FROM cells JOIN hit USING (r, c)""",
)
def clip_all(spark, sf):
    cube = view(spark, sf, "fx_cube").withColumn("raster_id", F.col("source")).drop("source", "l_extendedprice")
    return clip.clip(cube, cube_grid(cube), areas("A5"), "touched").drop("raster_id", "aoi_id")


def cube_grid(cube):
    """The cube's grid: 50 x 10 pixels over the test area."""
    return cube.groupBy("raster_id").agg(F.lit(4326).alias("epsg")).select(
        "raster_id", "epsg", F.lit(-124.0).alias("x0"), F.lit(42.0).alias("y0"), F.lit(0.2).alias("dx"),
        F.lit(-1.0).alias("dy"), F.lit(50).alias("width"), F.lit(10).alias("height"), F.lit(None).cast("double").alias("nodata"),
    )


@case(
    "r18_default_crs",
    """
SELECT raster_id, coalesce(epsg, 4326) AS epsg, n FROM (SELECT * FROM {fx_meta_hi} UNION ALL SELECT * FROM {fx_meta_lo})
JOIN (SELECT raster_id, count(*) AS n FROM {fx_grid_hi} GROUP BY 1 UNION ALL SELECT raster_id, count(*) FROM {fx_grid_lo} GROUP BY 1) USING (raster_id)""",
)
def default_crs(spark, sf):
    grids = cell_ops.default_crs(meta_hi(spark, sf).unionByName(meta_lo(spark, sf)))
    counts = hi(spark, sf).unionByName(lo(spark, sf)).groupBy("raster_id").agg(F.count(F.lit(1)).alias("n"))
    return grids.join(counts, "raster_id").select("raster_id", "epsg", "n")


@case(
    "r19_coord_range",
    "SELECT scene_id, min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max FROM {fx_swath} GROUP BY 1",
)
def coord_range(spark, sf):
    return cell_ops.coord_range(view(spark, sf, "fx_swath"), ["scene_id"], "lon", "lat")


@case(
    "s4_read_cells",
    """
SELECT var, t, x, y, v FROM (SELECT var, t, v, -124e0 + (c + 5e-1) * 2e-1 AS x, 42e0 + (r + 5e-1) * -1e0 AS y FROM {fx_cube})
WHERE var IN ('2m_temperature', 'total_precipitation') AND x BETWEEN -122e0 AND -117e0 AND y BETWEEN 34e0 AND 4e1
  AND t >= TIMESTAMP '1996-01-01' AND t < TIMESTAMP '1998-01-01'""",
)
def read_cells(spark, sf):
    cube = view(spark, sf, "fx_cube").withColumn("raster_id", F.col("source"))
    placed = cell_ops.pixel_centres(cube, cube_grid(cube))
    path = shared_folder(spark)
    placed.select("var", "t", "r", "c", "x", "y", "v").repartition("var", "r").sortWithinPartitions(
        "var", "r", "c"
    ).write.partitionBy("var").parquet(path)
    out = tables.read_cells(
        spark, path, ["2m_temperature", "total_precipitation"], (-122, 34, -117, 40), ("1996-01-01", "1998-01-01")
    )
    return out.select("var", "t", "x", "y", "v")


def _outputs(spark, sf):
    slot = F.substring(F.col("t").cast("string"), 1, 7)
    two = F.explode(F.array(F.lit("A1"), F.lit("A2"))).alias("aoi_id")
    out = view(spark, sf, "fx_grid_hi").select(two, F.lit("s2").alias("source"), F.col("band").alias("var"), slot.alias("slot"), "r", "c", "v")
    return out.where("aoi_id = 'A1' OR c < 60")


_TWO = "(SELECT a.aoi_id, g.* FROM {fx_grid_hi} g CROSS JOIN (VALUES ('A1'), ('A2')) AS a(aoi_id) WHERE a.aoi_id = 'A1' OR c < 60)"
_WRITTEN = "r int, c int, v double, aoi_id string, source string, var string, slot string"


@case("s6_write_raster", "SELECT aoi_id, 's2' AS source, band AS var, strftime(t, '%Y-%m') AS slot, r, c, v FROM " + _TWO)
def write_raster(spark, sf):
    path = shared_folder(spark)
    tables.write_raster(_outputs(spark, sf), path)
    return spark.read.schema(_WRITTEN).parquet(path)


@case(
    "s8_overwrite_slot",
    """
SELECT aoi_id, 's2' AS source, band AS var, strftime(t, '%Y-%m') AS slot, r, c, CASE WHEN year(t) = 1997 AND aoi_id = 'A2' THEN v * 2e0 ELSE v END AS v
FROM """
    + _TWO
    + " WHERE year(t) <> 1997 OR v > 0 OR aoi_id = 'A1'",
)
def overwrite_slot(spark, sf):
    path = shared_folder(spark)
    out = _outputs(spark, sf)
    tables.write_raster(out, path)
    again = out.where((F.col("aoi_id") == "A2") & F.startswith(F.col("slot"), F.lit("1997")) & (F.col("v") > 0)).withColumn("v", F.col("v") * 2.0)
    tables.overwrite_slot(again, path)
    return spark.read.schema(_WRITTEN).parquet(path)


@case(
    "s5_list_rasters",
    "SELECT DISTINCT concat('aoi_id=', aoi_id, '/source=s2/var=', band, '/slot=', strftime(t, '%Y-%m')) AS folder, true AS filled FROM " + _TWO,
)
def list_rasters(spark, sf):
    from cellsheaf.sources import files

    path = shared_folder(spark)
    tables.write_raster(_outputs(spark, sf), path)
    found = files.list_rasters(spark, path, ("parquet", "tif"))
    folder = F.regexp_extract("path", r"(aoi_id=.*)/[^/]*$", 1)
    return found.groupBy(folder.alias("folder")).agg((F.min("length") > 0).alias("filled"))


@case(
    "minimum_slice",
    "WITH ctr AS (SELECT r, c, nullif(v, -9999e0) AS v, "
    + f"{_X} AS x, {_Y} AS y FROM {{fx_grid_hi}}), "
    + """win AS (SELECT least(ceil((32e0 - 42e0) / -8e-2), (SELECT height FROM {fx_meta_hi})) AS h),
src AS (SELECT r, c, CASE WHEN x >= -124e0 AND x < -114e0 AND y >= 32e0 AND y < 42e0 THEN v END AS v FROM ctr, win WHERE r < h), """
    + average_sql("src", "125", "(SELECT max(h)::int FROM win)", "25", "(SELECT greatest(floor(max(h) * 8e-2 / 39e-2), 1)::int FROM win)")
    + " SELECT r, c, round(v, 6) AS v FROM avg_",
)
def minimum_slice(spark, sf):
    """Clip to one area, drop nodata, crop, and average to five times coarser pixels."""
    grids, area = meta_hi(spark, sf), areas("A1")
    cells = cell_ops.nodata_to_null(hi(spark, sf), grids)
    window = clip.crop_window(cells, grids, area, "centre", outside="null").drop("aoi_id")
    cropped = clip.crop_grids(grids, area).drop("aoi_id")
    out = resample.downsample_average(window, cropped, resample.target_grid(cropped, 0.39))
    return out.select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), F.round("v", 6).alias("v"))
