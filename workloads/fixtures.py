"""Derived Earth-observation views on the given tables.

Each view is one SQL text that runs unchanged in Spark and in DuckDB, so a query and its
oracle start from the same rows. Doubles are written with an exponent because a plain
decimal literal is DECIMAL in Spark.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsheaf import aoi as aoi_mod

TABLES = ("customer", "events", "lineitem", "orders", "part", "supplier")

# Unit outlines around (0, 0), scaled and moved to make areas: rectangle, concave L, two boxes,
# rectangle with hole, triangle, and a type that is no polygon.
OUTLINES = {
    0: ("Polygon", [(0, 0, [(-5, -5), (5, -5), (5, 5), (-5, 5), (-5, -5)])]),
    1: ("Polygon", [(0, 0, [(-5, -5), (5, -5), (5, -1), (0, -1), (0, 5), (-5, 5), (-5, -5)])]),
    2: (
        "MultiPolygon",
        [
            (0, 0, [(-4, -4), (-2, -4), (-2, -2), (-4, -2), (-4, -4)]),
            (1, 0, [(2, 1), (4, 1), (4, 3), (2, 3), (2, 1)]),
        ],
    ),
    3: (
        "Polygon",
        [
            (0, 0, [(-5, -5), (5, -5), (5, 5), (-5, 5), (-5, -5)]),
            (0, 1, [(-2, -2), (-2, 2), (2, 2), (2, -2), (-2, -2)]),
        ],
    ),
    4: ("Polygon", [(0, 0, [(-1.3, -1.9), (2.8, -0.3), (0.1, 3.4), (-1.3, -1.9)])]),
    5: ("Point", []),
}

_OUTLINE_ROWS = ", ".join(
    f"({k}, {p}, {h}, {i}, {float(x)!r}e0, {float(y)!r}e0)"
    for k, (_, rs) in OUTLINES.items()
    for p, h, pts in rs
    for i, (x, y) in enumerate(pts)
)

# The fixed areas a single request may name.
AREAS = [
    aoi_mod.from_geojson("A1", {"type": "Polygon", "coordinates": [
        [[-124, 32], [-114, 32], [-114, 42], [-124, 42], [-124, 32]]]}),
    aoi_mod.from_geojson("A2", {"type": "Polygon", "coordinates": [
        [[-124, 32], [-114, 32], [-114, 36], [-119, 36], [-119, 42], [-124, 42], [-124, 32]]]}),
    aoi_mod.from_geojson("A3", {"type": "MultiPolygon", "coordinates": [
        [[[-123, 33], [-121, 33], [-121, 35], [-123, 35], [-123, 33]]],
        [[[-117, 38], [-115, 38], [-115, 40], [-117, 40], [-117, 38]]]]}),
    aoi_mod.from_geojson("A4", {"type": "Polygon", "coordinates": [
        [[-124, 32], [-114, 32], [-114, 42], [-124, 42], [-124, 32]],
        [[-121, 35], [-121, 39], [-117, 39], [-117, 35], [-121, 35]]]}),
    aoi_mod.from_geojson("A5", {"type": "Polygon", "coordinates": [
        [[-120.3, 35.1], [-116.2, 36.7], [-118.9, 40.4], [-120.3, 35.1]]]}),
]


def areas(*ids: str) -> list:
    return [a for a in AREAS if a.aoi_id in ids] if ids else AREAS


_AREA_EDGES = ", ".join(
    "('%s', %re0, %re0, %re0, %re0)" % (a.aoi_id, *e) for a in AREAS for e in a.edges
)

VIEWS = {
    "fx_scene": """
SELECT o_orderkey AS scene_id,
       CASE o_orderkey % 3 WHEN 0 THEN 'sentinel-2-l2a' WHEN 1 THEN 'sentinel-2-l1c'
            ELSE 'SENTINEL-3' END AS collection,
       concat('S3A_', CASE WHEN o_orderkey % 2 = 0 THEN 'OL_2_WFR' ELSE 'OL_2_LFR' END,
              '____', CASE WHEN o_custkey % 4 = 0 THEN '_NR_' ELSE '_NT_' END, '003.SEN3') AS name,
       o_orderdate + INTERVAL '1' SECOND * (o_orderkey * 7919 % 86400) AS acq_start,
       o_orderdate + INTERVAL '1' SECOND * (o_orderkey * 7919 % 86400 + 180) AS acq_end,
       o_totalprice / 5e3 AS cloud_cover,
       -130e0 + (o_custkey * 7919 % 300) / 1e1 AS minx,
       25e0 + (o_orderkey * 104729 % 250) / 1e1 AS miny,
       CASE WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 13 = 1 THEN '31UFT' ELSE NULL END AS tile,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL
            WHEN o_orderkey % 7 = 1 THEN concat('WRS-', cast(o_custkey % 60 AS string))
            ELSE concat('MGRS-', lpad(cast(1 + o_custkey % 60 AS string), 2, '0'), 'TUP') END AS grid_code
FROM {orders}""",
    "fx_asset": """
SELECT s.o_orderkey AS scene_id, a.asset_key,
       concat('s3://b/', cast(s.o_orderkey AS string), '/', a.asset_key, '.tif') AS href
FROM {orders} s CROSS JOIN (VALUES (0,'red'),(1,'green'),(2,'blue'),(3,'nir'),(4,'swir16')) AS a(ord, asset_key)
WHERE (s.o_orderkey + a.ord) % 11 <> 0""",
    "fx_grid_hi": """
SELECT 'hi' AS raster_id, 'B4' AS band, cast(floor(o_orderkey / 125e0) AS int) AS r, cast(o_orderkey % 125 AS int) AS c,
       CASE WHEN o_orderstatus = 'P' THEN -9999e0 ELSE o_totalprice END AS v, o_orderdate AS t
FROM {orders}""",
    "fx_grid_lo": """
SELECT 'lo' AS raster_id, 'B11' AS band, cast(floor(p_partkey / 5e1) AS int) AS r, cast(p_partkey % 50 AS int) AS c,
       p_retailprice AS v
FROM {part}""",
    "fx_meta_hi": """
SELECT 'hi' AS raster_id, 4326 AS epsg, -124e0 AS x0, 42e0 AS y0, 8e-2 AS dx, -8e-2 AS dy, 125 AS width,
       cast(max(r) + 1 AS int) AS height, -9999e0 AS nodata
FROM {fx_grid_hi}""",
    "fx_meta_lo": """
SELECT 'lo' AS raster_id, cast(NULL AS int) AS epsg, -124e0 AS x0, 42e0 AS y0, 2e-1 AS dx, -24e-2 AS dy, 50 AS width,
       cast(max(r) + 1 AS int) AS height, -9999e0 AS nodata
FROM {fx_grid_lo}""",
    "fx_cube": """
SELECT 'era5' AS source,
       CASE l_returnflag WHEN 'A' THEN '2m_temperature' WHEN 'N' THEN 'total_precipitation'
            ELSE 'surface_solar_radiation_downwards' END AS var,
       cast(l_partkey % 50 AS int) AS c, cast(l_suppkey % 10 AS int) AS r, l_shipdate AS t,
       l_quantity AS v, l_orderkey, l_linenumber, l_extendedprice
FROM {lineitem}""",
    "fx_swath": """
SELECT cast(floor(event_id / 1e4) AS bigint) AS scene_id, event_id AS i,
       -124e0 + (event_id * 7919 % 10000) / 1e4 AS lon,
       32e0 + (event_id * 104729 % 10000) / 1e4 AS lat,
       CASE event_type WHEN 'error' THEN 'WQSF' ELSE event_type END AS var, value AS v
FROM {events}""",
    "fx_link": """
SELECT cast(floor(event_id / 5e1) AS bigint) AS job_id, event_id AS pos,
       CASE WHEN event_id % 5 = 0 THEN 'self' ELSE 'derived_from' END AS rel,
       CASE WHEN event_id % 17 = 0 THEN 'S2A_orbit' ELSE
       concat('S2A_MSIL2A_', cast(year(ts) AS string), lpad(cast(month(ts) AS string), 2, '0'),
              lpad(cast(day(ts) AS string), 2, '0'), 'T', lpad(cast(hour(ts) AS string), 2, '0'),
              lpad(cast(minute(ts) AS string), 2, '0'), '00_N0512_R022_T32UPU') END AS href
FROM {events}""",
    "fx_result": """
SELECT cast(floor(event_id / 5e1) AS bigint) AS job_id, event_id,
       CASE WHEN event_id % 7 = 0 THEN 'job-results.json'
            WHEN event_id % 7 = 1 THEN 'openEO_20310105T101112Z.tif'
            WHEN event_id % 7 = 2 THEN 'openEO_2031-01-05.tif'
            WHEN event_id % 7 = 3 THEN 'openEO_no_date.tif'
            WHEN event_id % 7 = 4 THEN 'openEO_2031-02-06x.tif'
            ELSE concat('openEO_', cast(year(ts) AS string), '-', lpad(cast(month(ts) AS string), 2, '0'), '-',
                        lpad(cast(day(ts) AS string), 2, '0'), 'Z.tif') END AS filename,
       concat('https://h/', cast(event_id AS string)) AS href
FROM {events}""",
    "fx_frame": """
SELECT o_orderkey AS request_id, o_orderdate AS start,
       o_orderdate + INTERVAL '1' DAY * (o_orderkey % 400 - 20) AS end
FROM {orders}""",
    "fx_raster_path": """
SELECT concat('a', cast(o_custkey % 20 AS string)) AS archive,
       concat('/data/a', cast(o_custkey % 20 AS string),
              CASE o_orderkey % 4 WHEN 0 THEN '/' WHEN 1 THEN '/v2/' WHEN 2 THEN concat('/', cast(year(o_orderdate) AS string), '/')
                   ELSE '/maize/' END,
              CASE WHEN o_orderkey % 4 = 2 THEN concat('irrigated_', cast(o_orderkey AS string), 'm')
                   ELSE concat('ir', cast(year(o_orderdate) AS string), '_', cast(o_orderkey AS string), 'm') END,
              CASE o_orderkey % 5 WHEN 0 THEN '.tiff' WHEN 1 THEN '.txt' ELSE '.tif' END) AS path,
       o_orderkey % 9 AS length
FROM {orders}""",
    "fx_file": """
SELECT concat('cache/', cast(scene_id AS string), '_', asset_key, '.tif') AS path,
       (scene_id * 31 + length(asset_key)) % 8 * 25000000 AS length,
       CASE (scene_id + length(asset_key)) % 6 WHEN 0 THEN '504B0304' WHEN 1 THEN '43444601' WHEN 2 THEN '89484446'
            WHEN 3 THEN '49492A00' WHEN 4 THEN '4D4D002A' ELSE '3C68746D6C3E' END AS head_hex
FROM {fx_asset} WHERE scene_id % 5 <> 0""",
    "fx_customer_area": """
SELECT concat('c', cast(c_custkey AS string)) AS aoi_id, c_custkey % 6 AS kind,
       -129e0 + (c_custkey * 7919 % 290) / 1e1 AS cx, -4e1 + (c_custkey * 104729 % 900) / 1e1 AS cy, 5e-2 AS s
FROM {customer}""",
    "fx_supplier_area": """
SELECT concat('s', cast(s_suppkey AS string)) AS aoi_id, s_suppkey % 6 AS kind,
       -129e0 + (s_suppkey * 7919 % 290) / 1e1 AS cx, 26e0 + (s_suppkey * 104729 % 230) / 1e1 AS cy,
       CASE WHEN s_suppkey % 10 = 0 THEN 1e0 ELSE 5e-2 END AS s
FROM {supplier}""",
}

# Around the antimeridian, in fractions that all sums are exact for.
VIEWS |= {
    "fx_scene_180": """
SELECT o_orderkey AS scene_id, 165e0 + (o_custkey * 7919 % 1920) / 64e0 AS minx, 25e0 + (o_orderkey * 104729 % 1600) / 64e0 AS miny
FROM {orders}""",
    "fx_area_180": """
SELECT concat('s', cast(s_suppkey AS string)) AS aoi_id, s_suppkey % 4 AS kind,
       165e0 + (s_suppkey * 7919 % 1920) / 64e0 AS cx, 26e0 + (s_suppkey * 104729 % 1472) / 64e0 AS cy,
       CASE WHEN s_suppkey % 10 = 0 THEN 1e0 ELSE 625e-4 END AS s
FROM {supplier}""",
}

# Views only the oracle needs: vertices and edges as rows.
ORACLE_VIEWS = {
    "outline": f"SELECT * FROM (VALUES {_OUTLINE_ROWS}) AS o(kind, part, hole, seq, ux, uy)",
    "area_edge": f"SELECT * FROM (VALUES {_AREA_EDGES}) AS e(aoi_id, x1, y1, x2, y2)",
    "area_box": "SELECT aoi_id, min(x1) AS minx, min(y1) AS miny, max(x1) AS maxx, max(y1) AS maxy FROM {area_edge} GROUP BY aoi_id",
    "customer_pt": """
SELECT a.aoi_id, a.kind, CASE a.kind WHEN 2 THEN 'MultiPolygon' WHEN 5 THEN 'Point' ELSE 'Polygon' END AS geom_type,
       o.part, o.hole, o.seq, a.cx + a.s * o.ux AS x, a.cy + a.s * o.uy AS y
FROM {fx_customer_area} a LEFT JOIN {outline} o ON o.kind = a.kind""",
    "supplier_pt": """
SELECT a.aoi_id, a.kind, CASE a.kind WHEN 2 THEN 'MultiPolygon' WHEN 5 THEN 'Point' ELSE 'Polygon' END AS geom_type,
       o.part, o.hole, o.seq, a.cx + a.s * o.ux AS x, a.cy + a.s * o.uy AS y
FROM {fx_supplier_area} a LEFT JOIN {outline} o ON o.kind = a.kind""",
    "supplier_edge": """
SELECT aoi_id, x AS x1, y AS y1, nx AS x2, ny AS y2 FROM (
  SELECT aoi_id, x, y, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM {supplier_pt} WHERE kind <> 5
  WINDOW w AS (PARTITION BY aoi_id, part, hole ORDER BY seq)) WHERE nx IS NOT NULL""",
    "supplier_box": """
SELECT aoi_id, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy FROM {supplier_pt} WHERE kind <> 5 GROUP BY aoi_id""",
    "customer_box": """
SELECT aoi_id, any_value(geom_type) AS geom_type, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy,
       min(x) FILTER (part = 0 AND hole = 0) AS rminx, min(y) FILTER (part = 0 AND hole = 0) AS rminy,
       max(x) FILTER (part = 0 AND hole = 0) AS rmaxx, max(y) FILTER (part = 0 AND hole = 0) AS rmaxy
FROM {customer_pt} GROUP BY aoi_id""",
    "scene_pt": """
SELECT scene_id, k.seq, minx + k.ax AS x, miny + k.ay AS y
FROM {fx_scene} CROSS JOIN (VALUES (0,0e0,0e0),(1,18e-1,2e-1),(2,2e0,2e0),(3,2e-1,18e-1),(4,0e0,0e0)) AS k(seq, ax, ay)""",
    "scene_edge": """
SELECT a.scene_id, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
FROM {scene_pt} a JOIN {scene_pt} b ON a.scene_id = b.scene_id AND b.seq = a.seq + 1""",
}

ORACLE_VIEWS |= {
    "scene_180_pt": """
SELECT scene_id, k.seq, minx + k.ax AS x, miny + k.ay AS y
FROM {fx_scene_180} CROSS JOIN (VALUES (0,0e0,0e0),(1,175e-2,25e-2),(2,2e0,2e0),(3,25e-2,175e-2),(4,0e0,0e0)) AS k(seq, ax, ay)""",
    "scene_180_edge": ORACLE_VIEWS["scene_edge"].replace("scene_pt", "scene_180_pt"),
    "area_180_pt": """
SELECT a.aoi_id, a.kind, o.part, o.hole, o.seq, a.cx + a.s * o.ux AS x, a.cy + a.s * o.uy AS y FROM {fx_area_180} a JOIN {outline} o ON o.kind = a.kind""",
    "area_180_edge": ORACLE_VIEWS["supplier_edge"].replace("supplier_pt", "area_180_pt"),
    "area_180_box": ORACLE_VIEWS["supplier_box"].replace("supplier_pt", "area_180_pt"),
}


def _needs(text: str) -> list[str]:
    names = [*TABLES, *VIEWS, *ORACLE_VIEWS]
    return [n for n in names if "{" + n + "}" in text]


def oracle(body: str) -> str:
    """DuckDB text: the views a body names in braces become CTEs in front of it."""
    order: list[str] = []

    def visit(text):
        for n in _needs(text):
            if n in TABLES or n in order:
                continue
            visit(VIEWS.get(n) or ORACLE_VIEWS[n])
            order.append(n)

    visit(body)

    def plain(text):
        for n in _needs(text):
            text = text.replace("{" + n + "}", n)
        return text

    ctes = ",\n".join(f"{n} AS ({plain(VIEWS.get(n) or ORACLE_VIEWS[n])})" for n in order)
    if not ctes:
        return plain(body)
    body = plain(body).lstrip()
    return f"WITH {ctes}" + (",\n" + body[5:] if body.startswith("WITH ") else "\n" + body)


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table or a derived view of it as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf}/{name}.parquet")
    text = VIEWS[name]
    return spark.sql(text, **{n: view(spark, sf, n) for n in _needs(text)})


def area_frame(areas_df: DataFrame) -> DataFrame:
    """Areas (aoi_id, kind, cx, cy, s) with geometry type and rings."""

    def rings_of(outline):
        return F.array(
            *[
                F.struct(
                    F.lit(p).alias("part"),
                    F.lit(bool(h)).alias("hole"),
                    F.array(
                        *[
                            F.struct(
                                (F.col("cx") + F.col("s") * F.lit(float(x))).alias("x"),
                                (F.col("cy") + F.col("s") * F.lit(float(y))).alias("y"),
                            )
                            for x, y in pts
                        ]
                    ).alias("pts"),
                )
                for p, h, pts in outline
            ]
        )

    kind, shape = F.lit("Point"), F.lit(None)
    for k, (name, outline) in OUTLINES.items():
        if outline:
            kind = F.when(F.col("kind") == k, F.lit(name)).otherwise(kind)
            shape = F.when(F.col("kind") == k, rings_of(outline)).otherwise(shape)
    return areas_df.select("aoi_id", kind.alias("geom_type"), shape.alias("rings"))


def supplier_areas(spark, sf):
    return area_frame(view(spark, sf, "fx_supplier_area"))


def customer_areas(spark, sf):
    return area_frame(view(spark, sf, "fx_customer_area"))


def scenes(spark: SparkSession, sf: str) -> DataFrame:
    """fx_scene with skewed quadrilateral footprints, box and asset map."""
    corners = [(0.0, 0.0), (1.8, 0.2), (2.0, 2.0), (0.2, 1.8), (0.0, 0.0)]
    pts = F.array(
        *[F.struct((F.col("minx") + F.lit(a)).alias("x"), (F.col("miny") + F.lit(b)).alias("y")) for a, b in corners]
    )
    keys = ("red", "green", "blue", "nir", "swir16")
    assets = F.map_filter(
        F.create_map(
            *[
                x
                for i, k in enumerate(keys)
                for x in (
                    F.lit(k),
                    F.when(
                        (F.col("scene_id") + i) % 11 != 0,
                        F.struct(
                            F.concat(F.lit("s3://b/"), F.col("scene_id").cast("string"), F.lit(f"/{k}.tif")).alias("href")
                        ),
                    ),
                )
            ]
        ),
        lambda _, a: a.isNotNull(),
    )
    return (
        view(spark, sf, "fx_scene")
        .withColumn(
            "rings", F.array(F.struct(F.lit(0).alias("part"), F.lit(False).alias("hole"), pts.alias("pts")))
        )
        .withColumn(
            "bbox",
            F.struct(
                F.col("minx"), F.col("miny"), (F.col("minx") + 2.0).alias("maxx"), (F.col("miny") + 2.0).alias("maxy")
            ),
        )
        .withColumn("assets", assets)
    )


def _within_180(x):
    return F.when(x > 180.0, x - 360.0).otherwise(x)


def _wrapped(rings_column):
    """Rings with longitudes between -180 and 180, so that edges jump where a shape goes across."""
    point = lambda p: F.struct(_within_180(p["x"]).alias("x"), p["y"].alias("y"))
    return F.transform(rings_column, lambda g: F.struct(g["part"].alias("part"), g["hole"].alias("hole"), F.transform(g["pts"], point).alias("pts")))


def areas_180(spark, sf):
    return area_frame(view(spark, sf, "fx_area_180")).withColumn("rings", _wrapped(F.col("rings")))


def scenes_180(spark, sf):
    corners = [(0.0, 0.0), (1.75, 0.25), (2.0, 2.0), (0.25, 1.75), (0.0, 0.0)]
    pts = F.array(*[F.struct((F.col("minx") + a).alias("x"), (F.col("miny") + b).alias("y")) for a, b in corners])
    ring = F.array(F.struct(F.lit(0).alias("part"), F.lit(False).alias("hole"), pts.alias("pts")))
    box = F.struct(_within_180(F.col("minx")).alias("minx"), F.col("miny"), _within_180(F.col("minx") + 2.0).alias("maxx"), (F.col("miny") + 2.0).alias("maxy"))
    return view(spark, sf, "fx_scene_180").select("scene_id", _wrapped(ring).alias("rings"), box.alias("bbox"))
