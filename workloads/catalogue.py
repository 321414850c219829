"""Catalogue and metadata queries."""

from pyspark.sql import functions as F

from cellsheaf import registry
from cellsheaf.functions import instants, names
from cellsheaf.operators import catalog
from cellsheaf.sources import catalogues
from cellsheaf.sources.scratch import shared_folder
from workloads.case import case
from workloads.fixtures import scenes, supplier_areas, view
from workloads.geometry import _MEETING


def _iso(t):
    return F.concat(F.translate(F.substring(t.cast("string"), 1, 19), " ", "T"), F.lit("Z"))


def _footprint_json():
    pts = F.transform(F.get("rings", F.lit(0))["pts"], lambda q: F.array(q["x"], q["y"]))
    return F.struct(F.lit("Polygon").alias("type"), F.array(pts).alias("coordinates"))


@case(
    "s1_read_scenes",
    """
SELECT cast(s.scene_id AS string) AS scene_id, s.collection, s.acq_start, s.cloud_cover, s.tile, s.grid_code, s.minx, s.miny,
       s.minx + 2e0 AS maxx, s.miny + 2e0 AS maxy, 'Polygon' AS geom_type, s.minx + 18e-1 AS second_x, 5 AS n_points,
       (SELECT count(*) FROM {fx_asset} a WHERE a.scene_id = s.scene_id) AS n_assets,
       (SELECT max(href) FROM {fx_asset} a WHERE a.scene_id = s.scene_id AND asset_key = 'nir') AS nir
FROM {fx_scene} s""",
)
def read_scenes(spark, sf):
    b = F.col("bbox")
    properties = F.struct(
        _iso(F.col("acq_start")).alias("datetime"),
        F.col("cloud_cover").alias("eo:cloud_cover"),
        F.col("tile").alias("s2:mgrs_tile"),
        F.col("grid_code").alias("grid:code"),
    )
    path = shared_folder(spark)
    scenes(spark, sf).select(
        F.col("scene_id").cast("string").alias("id"),
        "collection",
        _footprint_json().alias("geometry"),
        F.array(b["minx"], b["miny"], b["maxx"], b["maxy"]).alias("bbox"),
        "assets",
        properties.alias("properties"),
    ).write.json(path)
    pts = F.get("rings", F.lit(0))["pts"]
    return catalogues.read_scenes(spark, path).select(
        "scene_id", "collection", "acq_start", "cloud_cover", "tile", "grid_code", "bbox.*", "geom_type",
        F.get(pts, F.lit(1))["x"].alias("second_x"),
        F.size(pts).alias("n_points"),
        F.size("assets").cast("long").alias("n_assets"),
        F.try_element_at("assets", F.lit("nir"))["href"].alias("nir"),
    )


@case(
    "s2_read_products",
    """
SELECT cast(scene_id AS string) AS scene_id, name, acq_start, acq_end, minx, miny, minx + 2e0 AS maxx, miny + 2e0 AS maxy FROM {fx_scene}""",
)
def read_products(spark, sf):
    product = F.struct(
        F.col("scene_id").cast("string").alias("Id"),
        F.col("name").alias("Name"),
        F.struct(_iso(F.col("acq_start")).alias("Start"), _iso(F.col("acq_end")).alias("End")).alias("ContentDate"),
        _footprint_json().alias("GeoFootprint"),
    )
    path = shared_folder(spark)
    # A listing page holds 100 products, so each group is bounded.
    pages = scenes(spark, sf).groupBy(F.floor(F.col("scene_id") / 100)).agg(F.collect_list(product).alias("value"))
    pages.select("value").write.json(path)
    return catalogues.read_products(spark, path).select("scene_id", "name", "acq_start", "acq_end", "bbox.*")


def _job_results(spark, sf):
    links = view(spark, sf, "fx_link")
    day = F.regexp_extract("href", r"_(\d{8})T", 1)
    asset = F.struct(
        F.concat(F.lit("openEO_"), day, F.lit("_"), F.col("pos").cast("string"), F.lit(".tif")).alias("key"),
        F.struct(F.concat(F.lit("https://h/"), F.col("pos").cast("string")).alias("href")).alias("value"),
    )
    link = F.struct("pos", "rel", "href")
    # A document holds the 50 links and assets of its job.
    docs = links.groupBy("job_id").agg(
        F.sort_array(F.collect_list(link)).alias("links"), F.map_from_entries(F.collect_list(asset)).alias("assets")
    )
    path = shared_folder(spark)
    docs.select(
        F.col("job_id").cast("string").alias("id"),
        F.transform("links", lambda p: F.struct(p["rel"].alias("rel"), p["href"].alias("href"))).alias("links"),
        "assets",
    ).write.json(path)
    return catalogues.read_job_result(spark, path)


@case(
    "s3_read_job_links",
    "SELECT cast(job_id AS string) AS job_id, cast(pos - 50 * job_id AS int) AS pos, rel, href FROM {fx_link}",
)
def read_job_links(spark, sf):
    return _job_results(spark, sf)[0]


@case(
    "s3_read_job_assets",
    """
SELECT cast(job_id AS string) AS job_id, concat('openEO_', regexp_extract(href, '_(\\d{8})T', 1), '_', pos, '.tif') AS filename,
       concat('https://h/', pos) AS href FROM {fx_link}""",
)
def read_job_assets(spark, sf):
    return _job_results(spark, sf)[1]


@case("c1_in_collection", "SELECT scene_id, collection FROM {fx_scene} WHERE collection = 'sentinel-2-l2a'")
def in_collection(spark, sf):
    return catalog.in_collection(view(spark, sf, "fx_scene"), "l2a").select("scene_id", "collection")


@case(
    "c2_name_contains",
    "SELECT scene_id, name FROM {fx_scene} WHERE strpos(name, 'OL_2_WFR') > 0 AND strpos(name, '_NT_') > 0",
)
def name_contains(spark, sf):
    return catalog.name_contains(view(spark, sf, "fx_scene"), "OL_2_WFR", "_NT_").select("scene_id", "name")


@case("c3_max_cloud", "SELECT scene_id, cloud_cover FROM {fx_scene} WHERE cloud_cover <= 3e1")
def max_cloud(spark, sf):
    return catalog.max_cloud(view(spark, sf, "fx_scene")).select("scene_id", "cloud_cover")


# Fixed values, written out so that the oracle does not lean on the registry.
_ALIASES = (
    "('B1', 'coastal'), ('B2', 'blue'), ('B3', 'green'), ('B4', 'red'), ('B5', 'rededge1'), ('B6', 'rededge2'), ('B7', 'rededge3'), ('B8', 'nir'), "
    "('B8A', 'nir08'), ('B9', 'nir09'), ('B10', 'cirrus'), ('B11', 'swir16'), ('B12', 'swir22'), ('AOT', 'aot'), ('WVP', 'wvp'), ('SCL', 'scl'), ('VISUAL', 'visual')"
)
_LAND = "['B01', 'B02', 'B03', 'B04', 'B05', 'B06', 'B07', 'B08', 'B8A', 'B09', 'B11', 'B12']"
_WATER = (
    "['B01', 'B02', 'B03', 'B04', 'B05', 'B06', 'B07', 'B08', 'B09', 'B10', 'B11', 'B12', 'B13', 'B14', 'B15', 'B16', 'B17', 'B18', 'B19', 'B20', 'B21', "
    "'FLAGS', 'IWV', 'CHL_OC4ME', 'TSM_NN', 'PAR', 'KD490_M07', 'A865', 'T865', 'CHL_NN', 'ADG443_NN']"
)
_REQUESTED = [*registry.BAND_ASSETS, "b8a", "visual", "Nir", "THERMAL", "B99"]


@case(
    "c4_map_bands",
    f"""
WITH r AS (SELECT scene_id, [{', '.join(repr(b) for b in _REQUESTED)}][1 + scene_id % {len(_REQUESTED)}] AS band FROM {{fx_scene}})
SELECT scene_id, band, coalesce(m.k, lower(band)) AS asset_key FROM r LEFT JOIN (VALUES {_ALIASES}) AS m(b, k) ON m.b = upper(band)""",
)
def map_bands(spark, sf):
    band = F.get(F.array(*[F.lit(b) for b in _REQUESTED]), (F.col("scene_id") % len(_REQUESTED)).cast("int"))
    df = view(spark, sf, "fx_scene").select("scene_id", band.alias("band"))
    return df.withColumn("asset_key", names.asset_key(F.col("band")))


_WANT = "(VALUES (0, 'B4', 'red'), (1, 'b11', 'swir16'), (2, 'NIR', 'nir'))"
_PICK = f"""
WITH p AS (SELECT s.scene_id, w.pos, w.band, w.k, a.href FROM {{fx_scene}} s CROSS JOIN {_WANT} AS w(pos, band, k)
           LEFT JOIN {{fx_asset}} a ON a.scene_id = s.scene_id AND a.asset_key = w.k),
f AS (SELECT scene_id, bool_and(href IS NOT NULL) AS complete, arg_min(band, pos) FILTER (href IS NULL) AS mb,
      arg_min(k, pos) FILTER (href IS NULL) AS mk FROM p GROUP BY scene_id)
"""
_MISS = "CASE WHEN NOT complete THEN concat('Band ', mb, ' (mapped to ''', mk, ''') not found in STAC assets.') END AS error"


@case(
    "c5_select_assets",
    _PICK + f"SELECT scene_id, cast(pos AS int) AS pos, band, k AS asset_key, href, complete, {_MISS} FROM p JOIN f USING (scene_id)",
)
def select_assets(spark, sf):
    return catalog.band_assets(catalog.select_assets(scenes(spark, sf), ["B4", "b11", "NIR"]))


@case(
    "c6_default_bands",
    f"""
WITH r AS (SELECT scene_id, CASE scene_id % 3 WHEN 0 THEN ['B08', 'B04'] WHEN 1 THEN {_LAND} ELSE {_WATER} END AS b FROM {{fx_scene}})
SELECT scene_id, len(b) AS n_bands, array_to_string(b, ', ') AS variable_name FROM r""",
)
def default_bands(spark, sf):
    asked = F.when(F.col("scene_id") % 3 == 0, F.array(F.lit("B08"), F.lit("B04")))
    df = view(spark, sf, "fx_scene").select("scene_id", asked.alias("asked"))
    bands = F.when(F.col("scene_id") % 3 == 2, names.bands_or_default(F.col("asked"), registry.S3_BANDS)).otherwise(
        names.bands_or_default(F.col("asked"), registry.S2_BANDS)
    )
    return df.select(
        "scene_id", F.size(bands).cast("long").alias("n_bands"), names.band_label(bands).alias("variable_name")
    )


_TILE = """coalesce(nullif(tile, ''), CASE WHEN grid_code IS NULL THEN 'UNKNOWN_GRID'
   WHEN starts_with(grid_code, 'MGRS-') THEN grid_code[6:] ELSE grid_code END)"""


@case("c7_mgrs_tile", f"SELECT scene_id, {_TILE} AS mgrs_tile FROM {{fx_scene}}")
def mgrs_tile(spark, sf):
    return view(spark, sf, "fx_scene").select(
        "scene_id", names.mgrs_tile(F.col("tile"), F.col("grid_code")).alias("mgrs_tile")
    )


@case(
    "c8_output_name",
    f"""
SELECT scene_id, concat('S2_', {_TILE}, '_', strftime(acq_start, '%Y%m%dT%H%M%S'), '_A1') AS scene,
       concat('S2_L2A_', strftime(acq_start, '%Y%m%dT%H%M%S')) AS s2, concat('S3_WATER_', strftime(acq_start, '%Y%m%dT%H%M%S')) AS s3,
       concat('era5_', strftime(acq_start, '%Y%m'), '_tp') AS era5, concat('SPEI_', strftime(acq_start, '%Y%m')) AS spei,
       concat('modis_ndvi_', strftime(acq_start, '%Y%m')) AS modis, concat('ESACCI_LC_', year(acq_start)) AS lc,
       concat('ECIRA_', year(acq_start)) AS ecira FROM {{fx_scene}}""",
)
def output_name(spark, sf):
    t = F.col("acq_start")

    def name(key):
        return names.fill_template(registry.SOURCES[key].basename, t, F.lit("tp"))

    tile = names.mgrs_tile(F.col("tile"), F.col("grid_code"))
    return view(spark, sf, "fx_scene").select(
        "scene_id",
        names.scene_name(tile, t, F.lit("A1")).alias("scene"),
        names.datacube_name("sen2_openeo", t).alias("s2"),
        names.datacube_name("sen3_openeo", t).alias("s3"),
        name("era5").alias("era5"),
        name("spei").alias("spei"),
        name("modis_ndvi").alias("modis"),
        name("esacci_landcover").alias("lc"),
        name("ecira").alias("ecira"),
    )


@case(
    "c9_s2_acq_from_link",
    "SELECT pos, split_part(href, '_', 3) AS acq FROM {fx_link} WHERE rel = 'derived_from' AND href <> 'S2A_orbit'",
)
def s2_acq_from_link(spark, sf):
    return catalog.derived_links(view(spark, sf, "fx_link"), names.third_token_time(F.col("href"))).select("pos", "acq")


@case(
    "c10_s3_acq_from_link",
    """
SELECT pos, list_filter(string_split(href, '_'), lambda p: length(p) = 15 AND contains(p, 'T'))[1] AS acq
FROM {fx_link} WHERE rel = 'derived_from' AND href <> 'S2A_orbit'""",
)
def s3_acq_from_link(spark, sf):
    return catalog.derived_links(view(spark, sf, "fx_link"), names.first_stamp_token(F.col("href"))).select("pos", "acq")


_LAST = """
WITH l AS (SELECT job_id, pos, split_part(href, '_', 3) AS acq FROM {fx_link} WHERE rel = 'derived_from' AND href <> 'S2A_orbit'),
d AS (SELECT job_id, acq[1:8] AS date_key, arg_max(acq, pos) AS acq FROM l GROUP BY 1, 2)
"""


def _dates(spark, sf):
    links = catalog.derived_links(view(spark, sf, "fx_link"), names.third_token_time(F.col("href")))
    return catalog.last_per_date(links, ["job_id"])


@case("c11_last_per_date", _LAST + "SELECT job_id, date_key, acq FROM d")
def last_per_date(spark, sf):
    return _dates(spark, sf)


@case(
    "c12_asset_time",
    _LAST
    + """, a AS (SELECT *, replace(replace(replace(replace(filename, 'openEO_', ''), 'Z.tif', ''), '.tif', ''), '-', '') AS clean FROM {fx_result} WHERE filename LIKE '%.tif')
SELECT event_id, filename, coalesce(try_strptime(d.acq, '%Y%m%dT%H%M%S'), try_strptime(clean, '%Y%m%dT%H%M%S'),
       try_strptime(clean, '%Y%m%d'), try_strptime(clean[1:8], '%Y%m%d')) AS acquired
FROM a LEFT JOIN d ON d.job_id = a.job_id AND d.date_key = clean[1:8]""",
)
def asset_time(spark, sf):
    assets = catalog.only_tif(view(spark, sf, "fx_result"))
    return catalog.asset_time(assets, _dates(spark, sf), "openEO_", ["job_id"]).select("event_id", "filename", "acquired")


@case("c13_only_tif", "SELECT event_id, filename FROM {fx_result} WHERE filename LIKE '%.tif'")
def only_tif(spark, sf):
    return catalog.only_tif(view(spark, sf, "fx_result")).select("event_id", "filename")


@case(
    "c14_band_label",
    _PICK + "SELECT scene_id, string_agg(band, ', ' ORDER BY pos) AS variable_name, complete FROM p JOIN f USING (scene_id) GROUP BY ALL",
)
def band_label(spark, sf):
    df = catalog.select_assets(scenes(spark, sf), ["B4", "b11", "NIR"])
    return df.select(
        "scene_id", names.band_label(F.transform("picked", lambda p: p["band"])).alias("variable_name"), "complete"
    )


@case(
    "c15_metadata_map",
    """
SELECT scene_id, 'original_stac_href' AS key, concat('s3://b/', scene_id) AS value FROM {fx_scene}
UNION ALL SELECT scene_id, 'cloud_cover_max', '30.0' FROM {fx_scene}
UNION ALL SELECT scene_id, 'year', cast(year(acq_start) AS string) FROM {fx_scene}""",
)
def metadata_map(spark, sf):
    m = catalog.provenance(
        original_stac_href=F.concat(F.lit("s3://b/"), F.col("scene_id").cast("string")),
        cloud_cover_max=F.lit(registry.MAX_CLOUD),
        year=F.year("acq_start"),
    )
    return view(spark, sf, "fx_scene").select("scene_id", F.explode(m))


@case(
    "c16_match_count",
    _MEETING
    + """, n AS (SELECT aoi_id, count(*) AS n FROM hit GROUP BY aoi_id)
SELECT a.aoi_id, coalesce(n.n, 0) AS n_scenes FROM {fx_supplier_area} a LEFT JOIN n USING (aoi_id)""",
)
def match_count(spark, sf):
    return catalog.match_count(supplier_areas(spark, sf), scenes(spark, sf)).select("aoi_id", "n_scenes")
