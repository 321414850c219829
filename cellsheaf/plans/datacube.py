"""Datacube sources: the filtered, rescaled cube, and the manifest of a job's result files."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsheaf import registry
from cellsheaf.aoi import Aoi
from cellsheaf.aoi import frame as aoi_frame
from cellsheaf.functions import instants, names
from cellsheaf.operators import catalog, cells, clip, manifest, spatial


DEFAULT = object()


def load(
    scenes: DataFrame,
    pixels: DataFrame,
    grids: DataFrame,
    aoi: Aoi,
    start: datetime,
    end: datetime,
    bands: list[str] | None = DEFAULT,
    max_cloud: float | None = DEFAULT,
    scale: float | None = DEFAULT,
    source: str = "sen2_openeo",
) -> DataFrame:
    """Pixels (scene_id, band, r, c, v) of scenes in the days and cloud limit, cut to the box of the area and rescaled.

    Bands, limit and scale default to what the source is registered with; bands=None asks for every band,
    a limit or scale of None for none. grids(scene_id, band, affine columns) places the pixels; r and c
    count from the corner of the box's window. An area that is no polygon has no pixels.
    """
    spec = registry.SOURCES[source]
    bands = spec.variables if bands is DEFAULT else spec.every_band if bands is None else bands
    max_cloud = spec.max_cloud if max_cloud is DEFAULT else max_cloud
    scale = spec.scale if scale is DEFAULT else scale
    if not aoi.rings:
        return pixels.where(F.lit(False))
    days = instants.in_extent(F.col("acq_start"), instants.ntz(start.isoformat(" ")), instants.ntz(end.isoformat(" ")))
    found = spatial.bbox_intersects(scenes.where(days), *aoi.bounds)
    if max_cloud is not None:
        found = catalog.max_cloud(found, max_cloud)
    raster = F.concat_ws("/", "scene_id", "band").alias("raster_id")
    placed = grids.where(F.col("band").isin(*bands)).join(found.select("scene_id"), "scene_id", "left_semi")
    placed = placed.select(raster, *clip.AFFINE)
    # Only rasters of scenes that were found have a grid, so the crop drops all other pixels.
    kept = clip.crop_window(pixels.where(F.col("band").isin(*bands)).select("*", raster), placed, [aoi.box()], "centre")
    kept = kept.drop("raster_id", "aoi_id")
    return kept if scale is None else cells.apply_cells(kept, lambda v: v * F.lit(float(scale)))


def report(
    links: DataFrame,
    assets: DataFrame,
    held: DataFrame,
    aoi: Aoi,
    source: str,
    prefix: str,
    bands: Column,
    policy: str,
    max_cloud: float | None = DEFAULT,
) -> DataFrame:
    """Manifest of result files: time from provenance links, absent files by policy, no time means failed.

    `held` has the filename of each file in the download stream and, where it has been validated, `valid`. The
    metadata holds the cloud limit of sources that have one. An area that is no polygon fails every row.
    """
    token = {"sen2_openeo": names.third_token_time, "sen3_openeo": names.first_stamp_token}[source]
    dates = catalog.last_per_date(catalog.derived_links(links, token(F.col("href"))), ["job_id"])
    timed = catalog.asset_time(catalog.only_tif(assets), dates, prefix, ["job_id"])
    there = manifest.absent_assets(timed, held, policy)
    invalid = F.lit(False)
    if "valid" in held.columns:
        checks = held.groupBy("filename").agg(F.bool_and(F.coalesce("valid", F.lit(False))).alias("_valid"))
        there = there.join(checks, "filename", "left")
        invalid = ~F.col("_valid")
    error = F.coalesce(
        F.lit(aoi.error),
        F.when(F.col("acquired").isNull(), F.lit("No acquisition time in file name")),
        F.col("error"),
        F.when(invalid, F.lit(registry.FILE_INVALID)),
    )
    limit = registry.SOURCES[source].max_cloud if max_cloud is DEFAULT else max_cloud
    extra = {} if limit is None else {"cloud_cover_max": F.lit(float(limit)).cast("string")}
    rows = there.withColumn("error", error).withColumn("aoi_id", F.lit(aoi.aoi_id)).withColumn(
        "path", F.concat(names.datacube_name(source, F.col("acquired")), F.lit(".tif"))
    )
    with_area = manifest.with_aoi(rows, aoi_frame(assets.sparkSession, [aoi]))
    return manifest.to_manifest(
        with_area,
        data_source=F.lit(registry.SOURCES[source].data_source),
        variable_name=names.band_label(bands),
        acquisition_time=F.col("acquired"),
        download_successful=F.col("error").isNull(),
        metadata=catalog.provenance(original_stac_href=F.coalesce("href", F.lit("")), **extra),
    )
