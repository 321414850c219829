"""Geometry queries."""

from pyspark.sql import functions as F

from cellsheaf import registry
from cellsheaf.functions import projections, rings
from cellsheaf.operators import manifest, spatial
from workloads.case import case
from workloads.fixtures import AREAS, areas_180, customer_areas, scenes, scenes_180, supplier_areas, view


@case(
    "g1_check_geometry",
    """
SELECT aoi_id, geom_type, geom_type <> 'Point' AS ok,
       CASE WHEN geom_type = 'Point' THEN 'polygon must be a GeoJSON geometry of type Polygon or MultiPolygon in EPSG:4326' END AS error
FROM {customer_box}""",
)
def check_geometry(spark, sf):
    return manifest.check_geometry(customer_areas(spark, sf)).select("aoi_id", "geom_type", "ok", "error")


@case("g2_ring_bbox", "SELECT aoi_id, rminx AS minx, rminy AS miny, rmaxx AS maxx, rmaxy AS maxy FROM {customer_box}")
def ring_bbox(spark, sf):
    return customer_areas(spark, sf).select("aoi_id", rings.ring_bbox(F.col("rings")).alias("b")).select("aoi_id", "b.*")


@case("g3_bounds", "SELECT aoi_id, minx, miny, maxx, maxy FROM {customer_box}")
def bounds(spark, sf):
    return customer_areas(spark, sf).select("aoi_id", rings.bounds(F.col("rings")).alias("b")).select("aoi_id", "b.*")


@case(
    "g4_extent_struct",
    """
SELECT aoi_id, maxy AS n, minx AS w, miny AS s, maxx AS e, minx AS west, miny AS south, maxx AS east, maxy AS north,
       (minx + maxx) / 2e0 AS lon, (miny + maxy) / 2e0 AS lat FROM {customer_box}""",
)
def extent_struct(spark, sf):
    b = customer_areas(spark, sf).select("aoi_id", rings.bounds(F.col("rings")).alias("b"))
    area, lonlat = rings.nwse(F.col("b")), rings.centre(F.col("b"))
    return b.select(
        "aoi_id",
        *[F.get(area, F.lit(i)).alias(n) for i, n in enumerate("nwse")],
        rings.compass(F.col("b")).alias("c"),
        lonlat[0].alias("lon"),
        lonlat[1].alias("lat"),
    ).select("*", "c.*").drop("c")


# Text of a coordinate: the shortest that reads back as the same number, a bare ".0" cut, an exponent written out in digits.
def _num(x):
    t = f"cast({x} AS string)"
    digits, power = f"replace(regexp_extract({t}, '([0-9.]+)e', 1), '.', '')", f"cast(regexp_extract({t}, 'e[+]?(-?[0-9]+)$', 1) AS int)"
    small = f"repeat('0', -{power} - 1) || {digits}"
    large = f"left({digits}, {power} + 1) || repeat('0', {power} + 1 - length({digits})) || rtrim('.' || substr({digits}, {power} + 2), '.')"
    plain = f"CASE WHEN {power} < 0 THEN '0.' || {small} ELSE {large} END"
    return f"CASE WHEN contains({t}, 'e') THEN CASE WHEN {x} < 0 THEN '-' ELSE '' END || {plain} ELSE regexp_replace({t}, '\\.0$', '') END"


_TEXT = """
WITH ring AS (SELECT aoi_id, geom_type, part, hole, '{o}' || string_agg({pt}, '{sep}' ORDER BY seq) || '{c}' AS t
              FROM {{customer_pt}} GROUP BY ALL),
part AS (SELECT aoi_id, geom_type, part, '{o}' || string_agg(t, '{sep}' ORDER BY hole) || '{c}' AS t FROM ring GROUP BY ALL),
whole AS (SELECT aoi_id, geom_type, string_agg(t, '{sep}' ORDER BY part) AS t FROM part GROUP BY ALL)
"""
_WKT = _TEXT.format(o="(", c=")", sep=", ", pt=f"{_num('x')} || ' ' || {_num('y')}")
_JSON = _TEXT.format(o="[", c="]", sep=",", pt=f"'[' || {_num('x')} || ',' || {_num('y')} || ']'")
JSON_TEXT = """'{"type":"' || geom_type || '","coordinates":' || CASE geom_type WHEN 'Polygon' THEN t ELSE '[' || t || ']' END || '}'"""


@case(
    "g5_to_wkt",
    _WKT
    + """SELECT aoi_id, CASE geom_type WHEN 'Polygon' THEN 'POLYGON ' || t WHEN 'MultiPolygon' THEN 'MULTIPOLYGON (' || t || ')' END AS wkt FROM whole""",
)
def to_wkt(spark, sf):
    return customer_areas(spark, sf).select("aoi_id", rings.to_wkt(F.col("geom_type"), F.col("rings")).alias("wkt"))


@case(
    "g13_geometry_id",
    _JSON
    + f""", txt AS (SELECT aoi_id, {JSON_TEXT} AS j FROM whole),
h AS (SELECT aoi_id, j, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(j)) AS h FROM txt)
SELECT aoi_id, j AS geojson, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' ||
       CASE WHEN h[17:17] IN ('0','4','8','c') THEN '8' WHEN h[17:17] IN ('1','5','9','d') THEN '9'
            WHEN h[17:17] IN ('2','6','a','e') THEN 'a' WHEN h[17:17] IN ('3','7','b','f') THEN 'b' END || h[18:20] || '-' || h[21:32] AS geometry_id
FROM h""",
)
def geometry_id(spark, sf):
    text = rings.to_geojson(F.col("geom_type"), F.col("rings"))
    return (
        customer_areas(spark, sf)
        .select("aoi_id", text.alias("geojson"))
        .withColumn("geometry_id", rings.geometry_id(F.col("geojson")))
    )


# Closed test of two edges a and b: boxes meet and neither lies strictly on one side of the other.
def _turn(p, q):
    return f"(({p}.x2 - {p}.x1) * ({q}.y1 - {p}.y1) - ({p}.y2 - {p}.y1) * ({q}.x1 - {p}.x1))", (
        f"(({p}.x2 - {p}.x1) * ({q}.y2 - {p}.y1) - ({p}.y2 - {p}.y1) * ({q}.x2 - {p}.x1))"
    )


_D12, _D34 = _turn("a", "b"), _turn("b", "a")
_BOXES = " AND ".join(
    f"least({p}.{k}1, {p}.{k}2) <= greatest({q}.{k}1, {q}.{k}2)" for k in "xy" for p, q in (("a", "b"), ("b", "a"))
)
_ODD = "count(*) FILTER ((e.y1 > p.y) <> (e.y2 > p.y) AND p.x < e.x1 + (p.y - e.y1) * (e.x2 - e.x1) / nullif(e.y2 - e.y1, 0e0)) % 2 = 1"
_ON = """count(*) FILTER ((e.x2 - e.x1) * (p.y - e.y1) - (e.y2 - e.y1) * (p.x - e.x1) = 0e0
    AND p.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) AND p.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)) > 0"""

_MEETING = f"""
WITH cand AS (SELECT s.scene_id, b.aoi_id FROM {{fx_scene}} s JOIN {{supplier_box}} b
   ON s.minx <= b.maxx AND s.minx + 2e0 >= b.minx AND s.miny <= b.maxy AND s.miny + 2e0 >= b.miny),
meet AS (SELECT DISTINCT scene_id, aoi_id FROM cand JOIN {{scene_edge}} a USING (scene_id) JOIN {{supplier_edge}} b USING (aoi_id)
   WHERE {_BOXES} AND {_D12[0]} * {_D12[1]} <= 0e0 AND {_D34[0]} * {_D34[1]} <= 0e0),
s_in_a AS (SELECT scene_id, aoi_id FROM cand JOIN {{scene_pt}} p USING (scene_id) JOIN {{supplier_edge}} e USING (aoi_id)
   WHERE p.seq = 0 GROUP BY scene_id, aoi_id HAVING {_ODD}),
a_in_s AS (SELECT scene_id, aoi_id FROM cand JOIN {{supplier_pt}} p USING (aoi_id) JOIN {{scene_edge}} e USING (scene_id)
   WHERE p.seq = 0 AND p.hole = 0 GROUP BY scene_id, aoi_id, p.part HAVING {_ODD}),
hit AS (SELECT * FROM meet UNION SELECT * FROM s_in_a UNION SELECT * FROM a_in_s)
"""


_CONTAINED = f""", mid AS (SELECT scene_id, x1 AS x, y1 AS y FROM {{scene_edge}} UNION ALL
   SELECT scene_id, (x1 + x2) / 2e0, (y1 + y2) / 2e0 FROM {{scene_edge}}),
amid AS (SELECT aoi_id, x1 AS x, y1 AS y FROM {{supplier_edge}} UNION ALL
   SELECT aoi_id, (x1 + x2) / 2e0, (y1 + y2) / 2e0 FROM {{supplier_edge}}),
out_pt AS (SELECT DISTINCT scene_id, aoi_id FROM (SELECT scene_id, aoi_id, p.x, p.y FROM hit JOIN mid p USING (scene_id)
   JOIN {{supplier_edge}} e USING (aoi_id) GROUP BY ALL HAVING NOT ({_ODD} OR {_ON}))),
pierce AS (SELECT DISTINCT scene_id, aoi_id FROM (SELECT scene_id, aoi_id, p.x, p.y FROM hit JOIN amid p USING (aoi_id)
   JOIN {{scene_edge}} e USING (scene_id) GROUP BY ALL HAVING {_ODD} AND NOT {_ON})),
cross_ AS (SELECT DISTINCT scene_id, aoi_id FROM hit JOIN {{scene_edge}} a USING (scene_id) JOIN {{supplier_edge}} b USING (aoi_id)
   WHERE {_D12[0]} * {_D12[1]} < 0e0 AND {_D34[0]} * {_D34[1]} < 0e0)
SELECT scene_id, aoi_id, (scene_id, aoi_id) NOT IN (SELECT (scene_id, aoi_id) FROM out_pt)
   AND (scene_id, aoi_id) NOT IN (SELECT (scene_id, aoi_id) FROM pierce)
   AND (scene_id, aoi_id) NOT IN (SELECT (scene_id, aoi_id) FROM cross_) AS contained FROM hit"""


@case("g6_intersects", _MEETING + "SELECT scene_id, aoi_id FROM hit")
def intersects(spark, sf):
    return spatial.intersects(scenes(spark, sf), supplier_areas(spark, sf))


@case(
    "g7_bbox_intersects",
    "SELECT scene_id, minx, miny FROM {fx_scene} WHERE minx <= -114e0 AND minx + 2e0 >= -124e0 AND miny <= 42e0 AND miny + 2e0 >= 32e0",
)
def bbox_intersects(spark, sf):
    return spatial.bbox_intersects(scenes(spark, sf), -124.0, 32.0, -114.0, 42.0).select("scene_id", "minx", "miny")


@case(
    "g8_aoi_contains_footprint",
    _MEETING
    + _CONTAINED,
)
def aoi_contains_footprint(spark, sf):
    return spatial.contained_footprints(scenes(spark, sf), supplier_areas(spark, sf))


# Published for WGS 84: rectifying radius times 0.9996, first eccentricity, and the first four coefficients of the series.
_SCALE, _ECC = "(6367449.145823415e0 * 9996e-4)", "0.0818191908426215e0"
_ALPHA = ("8.377318206244698e-4", "7.608527773572307e-7", "1.197645503329453e-9", "2.429170607201359e-12")
_LAM = "radians(lon - (zone * 6e0 - 183e0))"


def _utm_sql(source, keep):
    """Zone, easting and northing of rows with lon, lat; `keep` lists columns to pass on."""
    east = "eta" + "".join(f" + {a} * cos({2 * j}e0 * xi) * sinh({2 * j}e0 * eta)" for j, a in enumerate(_ALPHA, 1))
    north = "xi" + "".join(f" + {a} * sin({2 * j}e0 * xi) * cosh({2 * j}e0 * eta)" for j, a in enumerate(_ALPHA, 1))
    scale, k = _SCALE, _ECC
    return f"""
z AS (SELECT {keep}, lon, lat, least(cast(floor((lon + 180e0) / 6e0) AS int) + 1, 60) AS zone FROM {source}),
t AS (SELECT *, sinh(atanh(sin(radians(lat))) - {k} * atanh({k} * sin(radians(lat)))) AS t FROM z),
x AS (SELECT *, atan2(t, cos({_LAM})) AS xi, atanh(sin({_LAM}) / sqrt(1e0 + t * t)) AS eta FROM t),
utm AS (SELECT {keep}, lon, lat, CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + zone AS epsg,
   5e5 + {scale} * ({east}) AS ux, {scale} * ({north}) + CASE WHEN lat >= 0 THEN 0e0 ELSE 1e7 END AS uy FROM x)"""


@case(
    "g9_project_utm",
    f"WITH p AS (SELECT i, lon, lat FROM {{fx_swath}}), {_utm_sql('p', 'i')} SELECT i, epsg, round(ux, 3) AS x, round(uy, 3) AS y FROM utm",
)
def project_utm(spark, sf):
    lon, lat = F.col("lon"), F.col("lat")
    df = view(spark, sf, "fx_swath").select("i", "lon", "lat", projections.utm_epsg(lon, lat).alias("epsg"))
    x, y = projections.utm(lon, lat, F.col("epsg"))
    return df.select("i", "epsg", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


# The projection's constants from GRS 80 and its origin 52 N 10 E, by the published formulas.
_Q = "(1e0 - e * e) * ({s} / (1e0 - e * e * {s} * {s}) - 1e0 / (2e0 * e) * ln((1e0 - e * {s}) / (1e0 + e * {s})))"


@case(
    "g10_project_laea_europe",
    f"""
WITH el AS (SELECT 6378137e0 AS a, sqrt(2e0 / 298.257222101e0 - 1e0 / (298.257222101e0 * 298.257222101e0)) AS e, sin(radians(52e0)) AS s0),
qs AS (SELECT *, {_Q.format(s="1e0")} AS qp, {_Q.format(s="s0")} AS q0 FROM el),
bs AS (SELECT *, asin(q0 / qp) AS b0, a * sqrt(qp / 2e0) AS rq FROM qs),
cs AS (SELECT *, a * cos(radians(52e0)) / sqrt(1e0 - e * e * s0 * s0) / (rq * cos(b0)) AS d FROM bs),
p AS (SELECT i, radians(lon + 13e1 - 1e1) AS lam, sin(radians(lat + 15e0)) AS s FROM {{fx_swath}}),
b AS (SELECT *, asin({_Q.format(s="s")} / qp) AS beta FROM p, cs),
k AS (SELECT *, rq * sqrt(2e0 / (1e0 + sin(b0) * sin(beta) + cos(b0) * cos(beta) * cos(lam))) AS k FROM b)
SELECT i, round(4321e3 + k * d * cos(beta) * sin(lam), 3) AS x,
   round(321e4 + k / d * (cos(b0) * sin(beta) - sin(b0) * cos(beta) * cos(lam)), 3) AS y FROM k""",
)
def project_laea_europe(spark, sf):
    x, y = projections.laea_europe(F.col("lon") + 130.0, F.col("lat") + 15.0)
    return view(spark, sf, "fx_swath").select("i", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@case(
    "g11_utm_epsg",
    """
SELECT aoi_id, CASE WHEN (rminy + rmaxy) / 2e0 >= 0 THEN 32600 ELSE 32700 END
   + least(cast(floor(((rminx + rmaxx) / 2e0 + 180e0) / 6e0) AS int) + 1, 60) AS epsg FROM {customer_box}""",
)
def utm_epsg(spark, sf):
    b = customer_areas(spark, sf).select("aoi_id", rings.ring_bbox(F.col("rings")).alias("b"))
    return b.select("aoi_id", projections.utm_epsg(*rings.centre(F.col("b"))).alias("epsg"))


@case(
    "g12_metric_square",
    f"""
WITH p AS (SELECT aoi_id, (rminx + rmaxx) / 2e0 AS lon, (rminy + rmaxy) / 2e0 AS lat FROM {{customer_box}}), {_utm_sql('p', 'aoi_id')}
SELECT aoi_id, epsg, round(ux - 512e1, 3) AS west, round(uy - 512e1, 3) AS south, round(ux + 512e1, 3) AS east, round(uy + 512e1, 3) AS north FROM utm""",
)
def metric_square(spark, sf):
    b = customer_areas(spark, sf).select("aoi_id", rings.ring_bbox(F.col("rings")).alias("b"))
    epsg, square = projections.metric_square(F.col("b"), registry.PATCH_METRES)
    out = b.select("aoi_id", epsg.alias("epsg"), square.alias("q"))
    return out.select("aoi_id", "epsg", *[F.round(F.col(f"q.{s}"), 3).alias(s) for s in ("west", "south", "east", "north")])


@case(
    "g6_intersects_given_areas",
    f"""
WITH meet AS (SELECT DISTINCT scene_id, aoi_id FROM {{scene_edge}} a JOIN {{area_edge}} b
   ON {_BOXES} WHERE {_D12[0]} * {_D12[1]} <= 0e0 AND {_D34[0]} * {_D34[1]} <= 0e0),
s_in_a AS (SELECT scene_id, aoi_id FROM {{scene_pt}} p CROSS JOIN {{area_edge}} e WHERE p.seq = 0 GROUP BY scene_id, aoi_id HAVING {_ODD})
SELECT * FROM meet UNION SELECT * FROM s_in_a""",
)
def intersects_given_areas(spark, sf):
    return spatial.intersects(scenes(spark, sf), AREAS)


def _around(sql):
    """The same text on scenes and areas around longitude 180, which the oracle keeps in longitudes that run on."""
    names = {"fx_scene": "fx_scene_180", "scene_pt": "scene_180_pt", "scene_edge": "scene_180_edge", "supplier_pt": "area_180_pt", "supplier_edge": "area_180_edge", "supplier_box": "area_180_box"}
    for old, new in names.items():
        sql = sql.replace("{" + old + "}", "{" + new + "}")
    return sql


@case("g6_intersects_across_180", _around(_MEETING) + "SELECT scene_id, aoi_id FROM hit")
def intersects_across_180(spark, sf):
    """Footprints and areas on both sides of the antimeridian and across it, boxes from east to west as catalogues give them."""
    return spatial.intersects(scenes_180(spark, sf), areas_180(spark, sf))


@case("g8_contains_across_180", _around(_MEETING + _CONTAINED))
def contains_across_180(spark, sf):
    return spatial.contained_footprints(scenes_180(spark, sf), areas_180(spark, sf))
