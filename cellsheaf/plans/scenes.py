"""Scene source: catalogue to stacked, cropped and averaged pixels, and the manifest."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsheaf import registry
from cellsheaf.aoi import Aoi
from cellsheaf.functions import instants, names, rings
from cellsheaf.operators import catalog, clip, manifest, resample, spatial
from cellsheaf.operators import cells as cell_ops
from cellsheaf.operators.skew import lookup


def find(scenes: DataFrame, aoi: Aoi, start: datetime, end: datetime, data_type: str, bands: list[str]) -> DataFrame:
    """Scenes of the collection that meet area and days, with their resolved bands and `contained`."""
    days = instants.in_days(F.col("acq_start"), instants.ntz(start.isoformat(" ")), instants.ntz(end.isoformat(" ")))
    found = catalog.in_collection(scenes, data_type).where(days)
    met = spatial.contained_footprints(found, [aoi])
    return catalog.select_assets(found.join(met, "scene_id"), bands)


def pixels(
    found: DataFrame,
    cells: DataFrame,
    band_grids: DataFrame,
    aoi: Aoi,
    bands: list[str],
    resolution: float | None = None,
    lonlat: bool = True,
) -> DataFrame:
    """One row per pixel and scene with a column per band (named by asset key).

    Bands are brought to the master shape and stacked in one shuffle. Scenes the area covers
    wholly skip the crop; both branches read the same shuffle. Where grids name a `nodata` value, pixels of that
    value are no data before anything is averaged.
    """
    keys = [registry.BAND_ASSETS.get(b.upper(), b.lower()) for b in bands]
    ready = found.where("complete").select("scene_id", "contained")
    position = F.array_position(F.array(*[F.lit(k) for k in keys]), F.col("band")).cast("int")
    grids = band_grids.where(F.col("band").isin(*keys)).withColumn("pos", position).join(ready, "scene_id")
    mine = lookup(cells.where(F.col("band").isin(*keys)), ready.select("scene_id"), ["scene_id"], ["r", "c"])
    if "nodata" in band_grids.columns:
        raster = F.concat_ws("/", "scene_id", "band")
        named = grids.select(raster.alias("raster_id"), "nodata")
        mine = cell_ops.nodata_to_null(mine.withColumn("raster_id", raster), named).drop("raster_id")
        grids = grids.drop("nodata")
    stacked = resample.align_and_stack(mine, grids.drop("contained"), keys)
    master = resample.master_grid(grids).withColumn("raster_id", F.col("scene_id"))
    flagged = lookup(stacked, ready, ["scene_id"], ["r", "c"]).withColumn("raster_id", F.col("scene_id"))
    partly, wholly = flagged.where(~F.col("contained")).drop("contained"), flagged.where("contained").drop("contained")
    cut_grids = master.where(~F.col("contained"))
    cropped = clip.crop_window(partly, cut_grids, [aoi], "centre", outside="null", values=tuple(keys), lonlat=lonlat)
    out = cropped.drop("aoi_id").unionByName(wholly)
    if resolution is None:
        return out.drop("raster_id")
    shape = ["raster_id", "x0", "y0", "dx", "dy", "width", "height"]
    final = clip.crop_grids(cut_grids, [aoi], lonlat).select(*shape).unionByName(master.where("contained").select(*shape))
    target = resample.target_grid(final, resolution)
    return resample.downsample_average(out, final, target, by=["raster_id", "scene_id"], values=tuple(keys)).drop("raster_id")


def report(found: DataFrame, aoi: Aoi) -> DataFrame:
    """One row per scene found; a scene that lacks a band is a failed row with the reason, and so is an area that is no polygon."""
    if aoi.error:
        return manifest.failed_request(found.sparkSession, registry.SOURCES["sen2_aws"].data_source, aoi)
    tile = names.mgrs_tile(F.col("tile"), F.col("grid_code"))
    name = names.scene_name(tile, F.col("acq_start"), F.lit(aoi.aoi_id))
    return manifest.to_manifest(
        found,
        data_source=F.lit(registry.SOURCES["sen2_aws"].data_source),
        variable_name=F.col("collection"),
        acquisition_time=F.col("acq_start"),
        polygon=rings.to_geojson(F.lit("Polygon") if "geom_type" not in found.columns else F.col("geom_type"), F.col("rings")),
        path=F.concat(name, F.lit(".tif")),
        download_successful=F.col("complete"),
        metadata=catalog.provenance(scene_id=F.col("scene_id"), grid_code=F.col("grid_code")),
    )
