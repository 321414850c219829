"""Scene catalogues and result metadata."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsheaf import registry
from cellsheaf.functions import instants, names
from cellsheaf.operators.skew import lookup
from cellsheaf.operators.spatial import scenes_met


def in_collection(scenes: DataFrame, kind: str) -> DataFrame:
    return scenes.where(F.col("collection") == f"sentinel-2-{kind}")


def name_contains(scenes: DataFrame, *parts: str) -> DataFrame:
    for part in parts:
        scenes = scenes.where(F.contains(F.col("name"), F.lit(part)))
    return scenes


def max_cloud(scenes: DataFrame, percent: float = registry.MAX_CLOUD) -> DataFrame:
    return scenes.where(F.col("cloud_cover") <= float(percent))


def select_assets(scenes: DataFrame, bands: list[str] | Column) -> DataFrame:
    """Resolve the requested bands of each scene inside its own asset map; no join, no shuffle.

    Adds `picked` (array of band, asset_key, href in request order), `complete` and `error`,
    which names the first band the scene lacks.
    """

    def one(band, key):
        return F.struct(
            band.alias("band"), key.alias("asset_key"), F.try_element_at("assets", key)["href"].alias("href")
        )

    if isinstance(bands, Column):
        picked = F.transform(bands, lambda b: one(b, names.asset_key(b)))
    else:
        # Names are known here, so the keys are constants and the whole array is generated code.
        keys = [registry.BAND_ASSETS.get(b.upper(), b.lower()) for b in bands]
        picked = F.array(*[one(F.lit(b), F.lit(k)) for b, k in zip(bands, keys)])
    miss = F.get(F.filter("picked", lambda p: p["href"].isNull()), F.lit(0))
    text = F.concat(
        F.lit("Band "), miss["band"], F.lit(" (mapped to '"), miss["asset_key"], F.lit("') not found in STAC assets.")
    )
    return (
        scenes.withColumn("picked", picked)
        .withColumn("complete", miss.isNull())
        .withColumn("error", F.when(miss.isNotNull(), text))
    )


def band_assets(selected: DataFrame) -> DataFrame:
    """One row per scene and requested band, with its place in the request."""
    return selected.select("scene_id", "complete", "error", F.posexplode("picked").alias("pos", "_p")).select(
        "scene_id", "pos", "_p.band", "_p.asset_key", "_p.href", "complete", "error"
    )


def derived_links(links: DataFrame, acquired: Column) -> DataFrame:
    """Provenance links with an acquisition stamp."""
    return links.where(F.col("rel") == "derived_from").withColumn("acq", acquired).where(F.col("acq").isNotNull())


def last_per_date(links: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Date to acquisition stamp; of several links on a date the last one counts."""
    keys = by or []
    return (
        links.withColumn("date_key", F.substring("acq", 1, 8))
        .groupBy(*keys, "date_key")
        .agg(F.max_by("acq", "pos").alias("acq"))
    )


def only_tif(assets: DataFrame) -> DataFrame:
    return assets.where(F.endswith(F.col("filename"), F.lit(".tif")))


def asset_time(assets: DataFrame, dates: DataFrame, prefix: str, by: list[str] | None = None) -> DataFrame:
    """Acquisition time of result files: by provenance date, else from the file's own name.

    The name is tried as time stamp, as date, and by its first eight characters. A name that
    holds none of these gets a NULL time, which the manifest reports as a failure.
    """
    keys = by or []
    text = F.replace(F.col("filename"), F.lit(prefix), F.lit(""))
    for cut in ("Z.tif", ".tif", "-"):
        text = F.replace(text, F.lit(cut), F.lit(""))
    keyed = assets.withColumn("clean", text).withColumn("date_key", F.substring("clean", 1, 8))
    joined = lookup(keyed, dates.select(*keys, "date_key", "acq"), [*keys, "date_key"], ["filename"], "left")
    return joined.withColumn(
        "acquired",
        F.coalesce(
            instants.parse_stamp(F.col("acq")),
            instants.parse_stamp(F.col("clean")),
            instants.parse_day(F.col("clean")),
            instants.parse_day(F.col("date_key")),
        ),
    ).drop("clean", "date_key")


def provenance(**fields: Column) -> Column:
    """Key-value provenance of one output."""
    return F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v.cast("string"))])


def match_count(requests: DataFrame, scenes: DataFrame) -> DataFrame:
    """Scenes found per request; a request without any keeps its row with 0."""
    found = scenes_met(scenes, requests).withColumnRenamed("n", "_n")
    return requests.join(found, "aoi_id", "left").withColumn("n_scenes", F.coalesce("_n", F.lit(0).cast("long"))).drop("_n")
