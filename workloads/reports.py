"""File decisions and manifest queries."""

from pyspark.sql import functions as F

from cellsheaf.functions import names, rings
from cellsheaf.operators import catalog, files, manifest, slots, spatial
from cellsheaf.operators import cells as cell_ops
from cellsheaf.sources import files as file_source
from cellsheaf.sources import tables
from cellsheaf.sources.scratch import shared_folder
from workloads.case import case
from workloads.fixtures import scenes, supplier_areas, view
from workloads.geometry import _MEETING
from workloads.catalogue import _MISS, _PICK, _TILE


def inventory(spark, sf):
    return view(spark, sf, "fx_file").select("path", "length", F.unhex("head_hex").alias("head"))


@case(
    "p1_classify_files",
    """
SELECT path, CASE WHEN starts_with(head_hex, '504B0304') THEN 'zip' WHEN starts_with(head_hex, '434446') THEN 'netcdf3'
   WHEN starts_with(head_hex, '89484446') THEN 'hdf5' ELSE 'unexpected' END AS kind,
   CASE WHEN NOT (starts_with(head_hex, '504B0304') OR starts_with(head_hex, '434446') OR starts_with(head_hex, '89484446'))
   THEN concat('unexpected file type; header bytes: ', head_hex[1:8], '; first 200 bytes: ', head_hex) END AS error FROM {fx_file}""",
)
def classify_files(spark, sf):
    return files.classify_files(inventory(spark, sf)).select("path", "kind", "error")


_EXPECTED = "SELECT scene_id, k.asset_key, concat('cache/', scene_id, '_', k.asset_key, '.tif') AS path FROM {fx_scene} CROSS JOIN (VALUES ('red'), ('nir')) AS k(asset_key)"


def _requests(spark, sf):
    keys = F.explode(F.array(F.lit("red"), F.lit("nir")))
    return view(spark, sf, "fx_scene").select("scene_id", keys.alias("asset_key")).withColumn(
        "path", F.concat(F.lit("cache/"), F.col("scene_id").cast("string"), F.lit("_"), F.col("asset_key"), F.lit(".tif"))
    )


@case(
    "p3_validate_outputs",
    f"""
WITH e AS ({_EXPECTED})
SELECT scene_id, asset_key, coalesce(f.length > 0 AND left(head_hex, 8) IN ('49492A00','4D4D002A'), false) AS valid
FROM e LEFT JOIN {{fx_file}} f USING (path)""",
)
def validate_outputs(spark, sf):
    out = files.validate_outputs(_requests(spark, sf), inventory(spark, sf))
    return out.select("scene_id", "asset_key", "valid")


@case(
    "p3_validate_written_files",
    """
SELECT DISTINCT concat('aoi_id=A1/var=', band, '/slot=', strftime(t, '%Y-%m')) AS folder, true AS valid, 'unexpected' AS kind, '50415231' AS header FROM {fx_grid_hi}
UNION ALL SELECT 'absent', false, NULL, NULL FROM {fx_meta_hi}""",
)
def validate_written_files(spark, sf):
    """Real files: written, listed, their ends read by tasks, told apart and validated; one path that is not there."""
    path = shared_folder(spark)
    slot = F.date_format("t", "yyyy-MM")
    out = view(spark, sf, "fx_grid_hi").select(F.lit("A1").alias("aoi_id"), F.col("band").alias("var"), slot.alias("slot"), "r", "c", "v")
    tables.write_raster(out, path, ("aoi_id", "var", "slot"))
    heads = file_source.with_ends(file_source.list_files(spark, path, "*.parquet"))
    told = files.classify_files(heads).withColumn("folder", F.regexp_extract("path", r"(aoi_id=.*)/[^/]*$", 1))
    expected = told.select("folder", "path").unionByName(view(spark, sf, "fx_meta_hi").select(F.lit("absent").alias("folder"), F.lit("absent").alias("path")))
    checked = files.validate_outputs(expected, heads).join(told.select("path", "kind", "error"), "path", "left")
    header = F.regexp_extract("error", "header bytes: ([0-9A-F]*);", 1)
    return checked.groupBy("folder").agg(F.bool_and("valid").alias("valid"), F.max("kind").alias("kind"), F.max(header).alias("header"))


@case(
    "p3_validate_cut_files",
    """
SELECT strftime(t, '%Y-%m') AS slot, year(any_value(t)) % 2 = 1 AS valid, count(*) AS pixels FROM {fx_grid_hi} GROUP BY ALL""",
)
def validate_cut_files(spark, sf):
    """Table files of which those of even years lose their last bytes: only whole ones are valid. Pixels are counted before."""
    path = shared_folder(spark)
    rows = view(spark, sf, "fx_grid_hi").select(F.date_format("t", "yyyy-MM").alias("slot"), "r", "c", "v", "t")
    rows.repartition("slot").write.partitionBy("slot").parquet(path)
    content = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    slot = F.regexp_extract("path", "slot=([^/]+)/", 1)
    shorter = F.when(F.substring(slot, 1, 4).cast("int") % 2 == 0, 3).otherwise(0)
    told = content.withColumns({"slot": slot, "cut": shorter}).withColumns({"tail": F.expr("substring(left(content, length(content) - cut), -22, 22)"), "head": F.expr("left(content, 200)")})
    checked = files.validate_outputs(told.select("path", "slot"), told.select("path", "length", "head", "tail"))
    n = rows.groupBy("slot").agg(F.count("*").alias("pixels"))
    return checked.groupBy("slot").agg(F.bool_and("valid").alias("valid")).join(n, "slot")


@case(
    "p4_cache_plan",
    f"""
WITH e AS ({_EXPECTED})
SELECT scene_id, asset_key, coalesce(f.length >= 0, false) AS any_file, coalesce(f.length > 0, false) AS non_empty,
   coalesce(f.length > 100000000, false) AS big FROM e LEFT JOIN {{fx_file}} f USING (path)""",
)
def cache_plan(spark, sf):
    inv = inventory(spark, sf)
    out = _requests(spark, sf)
    for name, limit in (("any_file", -1), ("non_empty", 0), ("big", 100_000_000)):
        out = files.cache_plan(out, inv, limit).withColumnRenamed("cached", name)
    return out.select("scene_id", "asset_key", "any_file", "non_empty", "big")


_BY_SOURCE = ("era5", "modis_ndvi", "sen3_cdse", "ecira", "nowhere")


@case(
    "p4_cache_plan_by_source",
    f"""
WITH e AS (SELECT *, CASE scene_id % 5 WHEN 0 THEN 'era5' WHEN 1 THEN 'modis_ndvi' WHEN 2 THEN 'sen3_cdse' WHEN 3 THEN 'ecira' ELSE 'nowhere' END AS source FROM ({_EXPECTED}))
SELECT scene_id, asset_key, source, coalesce(CASE source WHEN 'era5' THEN f.length > 0 WHEN 'modis_ndvi' THEN f.length IS NOT NULL WHEN 'sen3_cdse' THEN f.length > 100000000
   WHEN 'ecira' THEN f.length > 0 AND left(head_hex, 8) IN ('49492A00','4D4D002A') END, false) AS cached FROM e LEFT JOIN {{fx_file}} f USING (path)""",
)
def cache_plan_by_source(spark, sf):
    """Each request is judged by its own source's rule; listings repeated do not repeat requests."""
    key = F.element_at(F.array(*[F.lit(k) for k in _BY_SOURCE]), (F.col("scene_id") % 5 + 1).cast("int"))
    inv = inventory(spark, sf)
    out = files.cache_plan_by_source(_requests(spark, sf).withColumn("source", key), inv.unionByName(inv))
    return out.select("scene_id", "asset_key", "source", "cached")


@case(
    "p5_plan_products",
    """SELECT scene_id, concat(name, '.zip') AS request, concat('https://download.dataspace.copernicus.eu/odata/v1/Products(', scene_id, ')/$value') AS address
FROM {fx_scene} WHERE collection = 'SENTINEL-3'""",
)
def plan_products(spark, sf):
    found = view(spark, sf, "fx_scene").where("collection = 'SENTINEL-3'")
    return slots.plan_products(found).select("scene_id", "request", "address")


@case(
    "p4_to_fetch",
    f"WITH e AS ({_EXPECTED}) SELECT path FROM e WHERE path NOT IN (SELECT path FROM {{fx_file}} WHERE length > 0)",
)
def to_fetch(spark, sf):
    return files.to_fetch(_requests(spark, sf), inventory(spark, sf)).select("path")


@case(
    "p6_pick_raster",
    """
WITH req AS (SELECT DISTINCT archive, y.year FROM {fx_raster_path} CROSS JOIN (SELECT unnest(range(1994, 2004)) AS year) y),
tif AS (SELECT archive, path, split_part(path, '/', -1) AS name FROM {fx_raster_path} WHERE path LIKE '%.tif' OR path LIKE '%.tiff'),
m AS (SELECT q.archive, q.year, t.path, row_number() OVER (PARTITION BY q.archive, q.year ORDER BY
   CASE WHEN contains(t.name, cast(q.year AS string)) THEN 0 ELSE 1 END, CASE WHEN contains(lower(t.path), 'maize') THEN 0 ELSE 1 END,
   len(string_split(t.path, '/')), length(t.name), CASE WHEN t.path LIKE '%.tiff' THEN 1 ELSE 0 END, t.path) AS k
   FROM req q JOIN tif t ON t.archive = q.archive AND contains(t.path, cast(q.year AS string)))
SELECT q.archive, q.year, m.path, CASE WHEN m.path IS NULL THEN concat('No GeoTIFF found for year=', q.year) END AS error
FROM req q LEFT JOIN m ON m.archive = q.archive AND m.year = q.year AND m.k = 1""",
)
def pick_raster(spark, sf):
    inv = view(spark, sf, "fx_raster_path")
    years = F.explode(F.sequence(F.lit(1994), F.lit(2003)))
    req = inv.select("archive").distinct().select("archive", years.alias("year"))
    return files.pick_raster(inv, req, "Maize").select("archive", F.col("year").cast("long").alias("year"), "path", "error")


# Rows of the manifest as plain columns; the bbox array becomes text.
def _flat(m):
    box = F.array_join(F.transform("bbox", rings.number_text), ",")
    return m.withColumn("bbox", box).withColumn("metadata", F.array_join(F.map_values("metadata"), "|"))


_BOX_TEXT = " || ',' || ".join(
    f"regexp_replace(cast({x} AS string), '\\.0$', '')" for x in ("minx", "miny", "minx + 2e0", "miny + 2e0")
)
_XY = [("minx", "miny"), ("minx + 18e-1", "miny + 2e-1"), ("minx + 2e0", "miny + 2e0"), ("minx + 2e-1", "miny + 18e-1"), ("minx", "miny")]
_POLY = (
    "'{\"type\":\"Polygon\",\"coordinates\":[[' || "
    + " || ',' || ".join(
        "'[' || " + " || ',' || ".join(f"regexp_replace(cast({v} AS string), '\\.0$', '')" for v in p) + " || ']'"
        for p in _XY
    )
    + " || ']]}'"
)


@case(
    "m1_to_manifest",
    _PICK
    + f"""SELECT 'S2' AS data_source, collection AS variable_name, acq_start AS acquisition_time, {_POLY} AS polygon, {_BOX_TEXT} AS bbox,
   concat('S2_', {_TILE}, '_', strftime(acq_start, '%Y%m%dT%H%M%S'), '.tif') AS path, complete AS download_successful, {_MISS}, name AS metadata
FROM {{fx_scene}} s JOIN f USING (scene_id)""",
)
def to_manifest(spark, sf):
    df = catalog.select_assets(scenes(spark, sf), ["B4", "b11", "NIR"])
    tile = names.mgrs_tile(F.col("tile"), F.col("grid_code"))
    m = manifest.to_manifest(
        df,
        data_source=F.lit("S2"),
        variable_name=F.col("collection"),
        acquisition_time=F.col("acq_start"),
        polygon=rings.to_geojson(F.lit("Polygon"), F.col("rings")),
        bbox=rings.bbox_list(F.col("bbox")),
        path=F.concat(names.scene_name(tile, F.col("acq_start")), F.lit(".tif")),
        download_successful=F.col("complete"),
        metadata=catalog.provenance(name=F.col("name")),
    )
    return _flat(m)


@case(
    "m2_pending",
    _MEETING
    + """, ok AS (SELECT scene_id, name, acq_start FROM {fx_scene} WHERE strpos(name, 'OL_2_WFR') > 0 AND strpos(name, '_NT_') > 0)
SELECT 'CDSE OData API' AS data_source, 'OL_2_WFR' AS variable_name, acq_start AS acquisition_time, aoi_id, '' AS path,
   false AS download_successful, cast(scene_id AS string) AS scene FROM hit JOIN ok USING (scene_id)""",
)
def pending(spark, sf):
    found = catalog.name_contains(scenes(spark, sf), "OL_2_WFR", "_NT_")
    aois = supplier_areas(spark, sf)
    rows = found.select("scene_id", "name", "acq_start").withColumn(
        "metadata", catalog.provenance(Id=F.col("scene_id"), Name=F.col("name"))
    )
    pairs = spatial.found_scenes(found, aois, rows)
    pairs = pairs.withColumn("metadata", F.map_concat("metadata", catalog.provenance(Area=F.col("aoi_id"))))
    m = manifest.pending(rows, "OL_2_WFR", pairs, aois).withColumn("aoi_id", F.try_element_at("metadata", F.lit("Area")))
    # The area is identified again by its id and its own text, which other areas may share.
    ids = aois.select("aoi_id", rings.to_geojson(F.col("geom_type"), F.col("rings")).alias("polygon"))
    return m.join(ids, ["aoi_id", "polygon"]).select(
        "data_source", "variable_name", "acquisition_time", "aoi_id", "path", "download_successful",
        F.try_element_at("metadata", F.lit("Id")).alias("scene"),
    )


@case(
    "m3_with_failures",
    """
WITH e AS (SELECT scene_id, k.asset_key FROM {fx_scene} CROSS JOIN (VALUES ('red'), ('nir'), ('swir16')) AS k(asset_key))
SELECT scene_id, asset_key, a.href AS path, a.href IS NOT NULL AS download_successful,
   CASE WHEN a.href IS NULL THEN concat('Band ', asset_key, ' not found') END AS error FROM e LEFT JOIN {fx_asset} a USING (scene_id, asset_key)""",
)
def with_failures(spark, sf):
    keys = F.explode(F.array(*[F.lit(k) for k in ("red", "nir", "swir16")]))
    expected = view(spark, sf, "fx_scene").select("scene_id", keys.alias("asset_key"))
    done = view(spark, sf, "fx_asset").withColumnRenamed("href", "path")
    text = F.concat(F.lit("Band "), F.col("asset_key"), F.lit(" not found"))
    return manifest.with_failures(expected, done, ["scene_id", "asset_key"], text)


@case(
    "m4_scene_to_bands",
    _PICK
    + """, n AS (SELECT scene_id, count(href) AS n FROM p WHERE scene_id % 7 <> 0 GROUP BY 1),
x AS (SELECT s.scene_id, s.name, f.complete, mb, CASE WHEN s.scene_id % 7 = 0 THEN false ELSE true END AS has_vars FROM {fx_scene} s JOIN f USING (scene_id))
SELECT scene_id, band AS variable_name, true AS download_successful, CAST(NULL AS string) AS error FROM x JOIN p USING (scene_id) WHERE complete AND has_vars
UNION ALL SELECT scene_id, 'OL_2_WFR', false, CASE WHEN NOT complete THEN concat('Failed processing ', name, ': no ', mb)
   ELSE concat('Failed processing ', name, ': no variables') END FROM x WHERE NOT (complete AND has_vars)""",
)
def scene_to_bands(spark, sf):
    df = catalog.select_assets(scenes(spark, sf), ["B4", "b11", "NIR"])
    miss = F.get(F.filter("picked", lambda p: p["href"].isNull()), F.lit(0))["band"]
    bands = F.transform("picked", lambda p: p["band"])
    df = df.withColumn("error", F.concat(F.lit("no "), miss)).withColumn(
        "variables", F.when(F.col("scene_id") % 7 != 0, bands).otherwise(F.array().cast("array<string>"))
    )
    return manifest.scene_to_bands(df, "OL_2_WFR").select("scene_id", "variable_name", "download_successful", "error")


@case(
    "m5_verdict",
    """
WITH have AS (SELECT DISTINCT date_trunc('month', t) AS slot, CASE var WHEN '2m_temperature' THEN 't2m' WHEN 'total_precipitation' THEN 'tp' ELSE 'ssrd' END AS var FROM {fx_cube}),
slot AS (SELECT DISTINCT slot FROM have), e AS (SELECT slot, v.var FROM slot CROSS JOIN (VALUES ('t2m'),('ssrd'),('tp'),('swvl1')) AS v(var)),
x AS (SELECT e.slot, e.var, h.var IS NULL AS missing, month(e.slot) % 4 <> 0 AS valid FROM e LEFT JOIN have h ON h.slot = e.slot AND h.var = e.var)
SELECT cast(slot AS timestamp) AS slot, var, NOT missing AND valid AS download_successful, CASE WHEN missing THEN concat('Variable ''', var, ''' missing in downloaded file.')
   WHEN NOT valid THEN 'Validation failed' END AS error FROM x""",
)
def verdict(spark, sf):
    cube = cell_ops.rename_vars(slots.with_slot(view(spark, sf, "fx_cube")))
    expected = slots.expected_outputs(cube.select("slot").distinct(), ["t2m", "ssrd", "tp", "swvl1"])
    rows = slots.completeness(expected, cube, ["slot", "var"])
    out = manifest.verdict(
        rows.withColumnRenamed("error", "missing_text"), ~F.col("present"), F.month("slot") % 4 != 0, F.col("missing_text"), "Validation failed"
    )
    return out.select("slot", "var", "download_successful", "error")


@case(
    "m6_absent_assets",
    """
WITH a AS (SELECT scene_id, concat(scene_id, '_', k.asset_key) AS filename FROM {fx_scene} CROSS JOIN (VALUES ('red'), ('nir')) AS k(asset_key)),
h AS (SELECT concat(scene_id, '_', asset_key) AS filename FROM {fx_asset})
SELECT 'report' AS policy, filename, filename IN (SELECT filename FROM h) AS download_successful,
   CASE WHEN filename NOT IN (SELECT filename FROM h) THEN 'File missing from download stream' END AS error FROM a
UNION ALL SELECT 'skip', filename, true, NULL FROM a WHERE filename IN (SELECT filename FROM h)""",
)
def absent_assets(spark, sf):
    name = F.concat(F.col("scene_id").cast("string"), F.lit("_"), F.col("asset_key"))
    assets = _requests(spark, sf).select(name.alias("filename"))
    held = view(spark, sf, "fx_asset").select(name.alias("filename"))
    both = [manifest.absent_assets(assets, held, p).withColumn("policy", F.lit(p)) for p in ("report", "skip")]
    return both[0].unionByName(both[1])


@case(
    "m7_all_ok",
    _PICK
    + """SELECT collection AS data_source, bool_and(complete) AS all_ok, count(*) AS n_outputs, count(*) FILTER (complete) AS n_ok
FROM {fx_scene} JOIN f USING (scene_id) GROUP BY 1""",
)
def all_ok(spark, sf):
    df = catalog.select_assets(scenes(spark, sf), ["B4", "b11", "NIR"])
    m = manifest.to_manifest(df, data_source=F.col("collection"), download_successful=F.col("complete"))
    return manifest.all_ok(m)


@case(
    "s7_write_manifest",
    "SELECT collection AS data_source, name AS variable_name, acq_start AS acquisition_time, k.round FROM {fx_scene} CROSS JOIN (VALUES (1), (2)) AS k(round)",
)
def write_manifest(spark, sf):
    path = shared_folder(spark)
    df = view(spark, sf, "fx_scene")
    for i in (1, 2):
        m = manifest.to_manifest(
            df,
            data_source=F.col("collection"),
            variable_name=F.col("name"),
            acquisition_time=F.col("acq_start"),
            download_successful=F.lit(True),
            metadata=catalog.provenance(round=F.lit(i)),
        )
        tables.write_manifest(m, path)
    return spark.read.parquet(path).select(
        "data_source", "variable_name", "acquisition_time", F.try_element_at("metadata", F.lit("round")).cast("int").alias("round")
    )


@case(
    "s7_upsert_manifest",
    """
WITH s AS (SELECT *, scene_id % 3 = 0 AS late, scene_id % 6 = 0 AS never FROM {fx_scene})
SELECT cast(scene_id AS string) AS scene, name AS variable_name, true AS download_successful, cast(1 AS bigint) AS version FROM s WHERE NOT late
UNION ALL SELECT cast(scene_id AS string), b.band, true, 3 FROM s CROSS JOIN (VALUES ('B4'), ('B11')) AS b(band) WHERE late AND NOT never
UNION ALL SELECT cast(scene_id AS string), name, false, 3 FROM s WHERE never""",
)
def upsert_manifest(spark, sf):
    """A request in which a third of the scenes fail, then two attempts at those: half of them give their bands. The second changes nothing."""
    path, df = shared_folder(spark), view(spark, sf, "fx_scene")

    def attempt(rows, ok):
        m = manifest.to_manifest(
            rows,
            data_source=F.col("collection"),
            acquisition_time=F.col("acq_start"),
            download_successful=ok,
            metadata=catalog.provenance(scene_id=F.col("scene_id")),
        )
        tables.upsert_manifest(m, path)

    attempt(df.withColumn("variable_name", F.col("name")), F.col("scene_id") % 3 != 0)
    late, never = df.where("scene_id % 3 = 0"), F.col("scene_id") % 6 == 0
    names_of = F.when(never, F.array("name")).otherwise(F.array(F.lit("B4"), F.lit("B11")))
    for _ in range(2):
        attempt(late.withColumn("variable_name", F.explode(names_of)), ~never)
    back = tables.read_manifest(spark, path)
    return back.select(F.col("metadata")["scene_id"].alias("scene"), "variable_name", "download_successful", "version")
