"""Swath queries."""

from pyspark.sql import functions as F

from cellsheaf.functions import rings
from cellsheaf.operators import swath
from workloads.case import case
from workloads.fixtures import customer_areas, view

PIXEL = 500.0
VARIABLES = ["WQSF", "click", "purchase", "signup", "view"]


def grids(spark, sf):
    """One grid per scene over the box of its samples."""
    s = view(spark, sf, "fx_swath").groupBy("scene_id").agg(
        F.struct(
            F.min("lon").alias("minx"), F.min("lat").alias("miny"), F.max("lon").alias("maxx"), F.max("lat").alias("maxy")
        ).alias("bbox")
    )
    return swath.make_grids(s, "scene_id", PIXEL)


def grid_sql(box, key, metres):
    return f"""
res AS (SELECT *, {metres} / (11132e1 * cos(radians((miny + maxy) / 2e0))) AS rx, {metres} / 11132e1 AS ry FROM {box}),
grid AS (SELECT {key}, minx, miny, maxx, maxy, cast(floor((maxx - minx) / rx) AS int) AS width,
   cast(floor((maxy - miny) / ry) AS int) AS height FROM res)"""


_GRID = (
    "WITH box AS (SELECT scene_id, min(lon) AS minx, min(lat) AS miny, max(lon) AS maxx, max(lat) AS maxy FROM {fx_swath} GROUP BY 1),"
    + grid_sql("box", "scene_id", "5e2")
)
_CELL = (
    _GRID
    + """,
rw AS (SELECT scene_id, minx, miny, maxx, maxy, width, height, cast(unnest(range(height)) AS int) AS r FROM grid),
cell AS (SELECT *, cast(unnest(range(width)) AS int) AS c FROM rw),
pos AS (SELECT *, minx + (c + 5e-1) * ((maxx - minx) / width) AS glon, maxy - (r + 5e-1) * ((maxy - miny) / height) AS glat FROM cell)"""
)
# Nearest sample within 1500 m: candidates by a latitude and longitude bucket of 0.02 degrees (over 1700 m).
_NEAREST = (
    _CELL
    + """,
smp AS (SELECT *, floor(lat / 2e-2) AS by_, floor(lon / 2e-2) AS bx FROM {fx_swath}),
tgt AS (SELECT *, floor(glat / 2e-2) + dy AS by_, floor(glon / 2e-2) + dx AS bx FROM pos,
   (VALUES (-1), (0), (1)) AS a(dy), (VALUES (-1), (0), (1)) AS b(dx)),
d AS (SELECT t.scene_id, s.var, t.r, t.c, s.i, s.v,
   ((cos(radians(lat)) * cos(radians(lon)) - cos(radians(glat)) * cos(radians(glon))) ** 2
  + (cos(radians(lat)) * sin(radians(lon)) - cos(radians(glat)) * sin(radians(glon))) ** 2
  + (sin(radians(lat)) - sin(radians(glat))) ** 2) * 6370997e0 * 6370997e0 AS d2
  FROM tgt t JOIN smp s ON s.scene_id = t.scene_id AND s.bx = t.bx AND s.by_ = t.by_),
hit AS (SELECT scene_id, var, r, c, arg_min(v, (d2, i)) AS v, arg_min(i, (d2, i)) AS i FROM d WHERE d2 <= 15e2 * 15e2 GROUP BY ALL)"""
)


@case(
    "w1_degree_resolution",
    """
SELECT aoi_id, round(3e2 / (11132e1 * cos(radians((miny + maxy) / 2e0))), 9) AS res_x, round(3e2 / 11132e1, 9) AS res_y FROM {customer_box} WHERE minx IS NOT NULL""",
)
def degree_resolution(spark, sf):
    b = customer_areas(spark, sf).where("rings is not null").select("aoi_id", rings.bounds(F.col("rings")).alias("b"))
    rx, ry = swath.degree_resolution(F.col("b"))
    return b.select("aoi_id", F.round(rx, 9).alias("res_x"), F.round(ry, 9).alias("res_y"))


@case(
    "w2_make_grid",
    "WITH "
    + grid_sql("{customer_box}", "aoi_id", "3e3")
    + """, rw AS (SELECT aoi_id, width, height, cast(unnest(range(height)) AS int) AS r FROM grid WHERE width > 0 AND height > 0)
SELECT aoi_id, width, height, r, cast(unnest(range(width)) AS int) AS c FROM rw""",
)
def make_grid(spark, sf):
    areas = customer_areas(spark, sf).where("rings is not null").select("aoi_id", rings.bounds(F.col("rings")).alias("bbox"))
    g = swath.make_grids(areas, "aoi_id", 3000.0)
    return swath.grid_cells(g).select("aoi_id", "width", "height", "r", "c")


@case("w3_regrid_nearest", _NEAREST + " SELECT scene_id, var, r, c, v FROM hit")
def regrid_nearest(spark, sf):
    return swath.regrid_nearest(view(spark, sf, "fx_swath"), grids(spark, sf), ["scene_id", "var"])


@case(
    "w3_regrid_variables",
    _NEAREST.replace("s.var, t.r", "'all' AS var, t.r")
    + """ SELECT h.scene_id, k.var, h.r, h.c, CASE k.var WHEN 'a' THEN s.v ELSE s.v * 2e0 END AS v
FROM hit h JOIN {fx_swath} s USING (scene_id, i) CROSS JOIN (VALUES ('a'), ('b')) AS k(var)""",
)
def regrid_variables(spark, sf):
    s = view(spark, sf, "fx_swath")
    values = s.select("scene_id", "i", F.explode(F.create_map(F.lit("a"), F.col("v"), F.lit("b"), F.col("v") * 2.0)).alias("var", "v"))
    return swath.regrid_variables(s.select("scene_id", "i", "lon", "lat"), values, grids(spark, sf), "scene_id")


@case(
    "w4_fill_missing",
    _NEAREST
    + """ SELECT g.scene_id, k.var, g.r, g.c, CASE WHEN h.r IS NOT NULL THEN h.v WHEN k.var = 'WQSF' THEN 0e0 END AS v
FROM cell g CROSS JOIN (VALUES ('WQSF'), ('click'), ('purchase'), ('signup'), ('view')) AS k(var)
LEFT JOIN hit h ON h.scene_id = g.scene_id AND h.var = k.var AND h.r = g.r AND h.c = g.c""",
)
def fill_missing(spark, sf):
    g = grids(spark, sf)
    found = swath.regrid_nearest(view(spark, sf, "fx_swath"), g, ["scene_id", "var"])
    return swath.fill_missing(found, g, VARIABLES, "scene_id")


@case(
    "w5_axis_labels",
    _CELL
    + """ SELECT scene_id, r, c, round(minx + c * coalesce((maxx - minx) / nullif(width - 1, 0), 0e0), 9) AS x,
   round(maxy + r * coalesce((miny - maxy) / nullif(height - 1, 0), 0e0), 9) AS y FROM cell""",
)
def axis_labels(spark, sf):
    out = swath.axis_labels(swath.grid_cells(grids(spark, sf)))
    return out.select("scene_id", "r", "c", F.round("x", 9).alias("x"), F.round("y", 9).alias("y"))


_FILE_NAME = """CASE scene_id % 4 WHEN 0 THEN concat('Oa', lpad(cast(scene_id % 30 AS string), 2, '0'), '_reflectance.nc')
   WHEN 1 THEN concat('Oa', lpad(cast(scene_id % 22 AS string), 2, '0'), '_reflectance_unc.nc')
   WHEN 2 THEN CASE scene_id % 3 WHEN 0 THEN 'wqsf.nc' WHEN 1 THEN 'iop_nn.nc' ELSE 'par.nc' END ELSE 'geo_coordinates.nc' END"""


@case(
    "w6_wanted_files",
    f"""
WITH f AS (SELECT scene_id, {_FILE_NAME} AS file_name FROM {{fx_scene}})
SELECT scene_id, file_name FROM f WHERE file_name IN ('chl_nn.nc','chl_oc4me.nc','tsm_nn.nc','iop_nn.nc','w_aer.nc','iwv.nc','wqsf.nc','lqsf.nc')
   OR (regexp_matches(file_name, '^Oa[0-9][0-9]_reflectance.nc$') AND cast(file_name[3:4] AS int) BETWEEN 1 AND 21)""",
)
def wanted_files(spark, sf):
    inv = view(spark, sf, "fx_scene").select("scene_id", F.expr(_FILE_NAME).alias("file_name"))
    return swath.wanted_files(inv)


@case(
    "w7_wanted_vars",
    """
SELECT event_id, var FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_type || '_UNC' ELSE event_type END AS var FROM {events})
WHERE event_id % 5 IN (0, 1) AND event_id % 3 <> 0""",
)
def wanted_vars(spark, sf):
    dims = F.when(F.col("event_id") % 5 == 0, F.array(F.lit("rows"), F.lit("columns"))).when(
        F.col("event_id") % 5 == 1, F.array(F.lit("columns"), F.lit("bands"), F.lit("rows"))
    ).when(F.col("event_id") % 5 == 2, F.array(F.lit("rows"))).otherwise(F.array(F.lit("tie_columns")))
    var = F.when(F.col("event_id") % 3 == 0, F.concat("event_type", F.lit("_UNC"))).otherwise(F.col("event_type"))
    meta = view(spark, sf, "events").select("event_id", var.alias("var"), dims.alias("dims"))
    return swath.wanted_vars(meta).select("event_id", "var")
