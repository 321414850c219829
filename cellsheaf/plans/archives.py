"""Yearly sources that come as one archive of rasters: from its members to clipped years and their manifest."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsheaf import registry
from cellsheaf.aoi import Aoi
from cellsheaf.aoi import frame as aoi_frame
from cellsheaf.functions import instants
from cellsheaf.operators import catalog, cells, clip, files, manifest, slots
from cellsheaf.operators.skew import lookup


def archive_held(inventory: DataFrame, source: str = "ecira") -> DataFrame:
    """One row: whether the source's archive is listed and will do by the source's own rule (for a ZIP, whole by both its ends)."""
    name = registry.SOURCES[source].archive
    request = inventory.sparkSession.range(1).select(F.lit(source).alias("source"), F.lit(name).alias("path"))
    named = inventory.withColumn("path", F.element_at(F.split("path", "/"), -1)).where(F.col("path") == name)
    return files.cache_plan_by_source(request, named).select("source", "cached")


def pick(members: DataFrame, start: datetime, end: datetime, source: str = "ecira", crop_code: str | None = None) -> DataFrame:
    """The member raster of every year the frame touches: year, slot, raster_id and, where there is none, an error."""
    frame = members.sparkSession.range(1).select(
        instants.ntz(start.isoformat(sep=" ")).alias("start"), instants.ntz(end.isoformat(sep=" ")).alias("end")
    )
    years = slots.year_slots(frame).select(F.lit(source).alias("archive"), "year", F.col("slot_start").alias("slot"))
    picked = files.pick_raster(members.withColumn("archive", F.lit(source)), years, crop_code)
    return picked.select("year", "slot", F.col("path").alias("raster_id"), "error")


def outputs(picked: DataFrame, pixels: DataFrame, grids: DataFrame, aoi: Aoi, source: str = "ecira") -> DataFrame:
    """Clipped pixels of the picked rasters, with their year. Only cells of those rasters go on, before anything is clipped.

    Grids keep their own CRS (EPSG:4326 if they name none) and the area is projected to each. A raster may serve several years. An area
    that is no polygon has no pixels.
    """
    chosen = picked.where(F.col("raster_id").isNotNull()).select("raster_id").distinct()
    own = lookup(pixels, chosen, ["raster_id"], ["r", "c"])
    frames = cells.default_crs(grids.join(chosen, "raster_id", "left_semi"))
    clean = cells.nodata_to_null(own, frames)
    if aoi.error:
        clipped = clean.where(F.lit(False)).withColumn("aoi_id", F.lit(aoi.aoi_id))
    else:
        clipped = clip.clip(clean, frames, [aoi], registry.SOURCES[source].clip_rule, lonlat=False)
    served = picked.where(F.col("raster_id").isNotNull()).select("raster_id", "year", "slot")
    out = lookup(clipped, served, ["raster_id"], ["r", "c"])
    return out.withColumns({"source": F.lit(source), "var": F.lit(registry.SOURCES[source].variables[0])})


def report(
    picked: DataFrame, pixels: DataFrame, grids: DataFrame, aoi: Aoi, source: str = "ecira", crop_code: str | None = None, held: DataFrame | None = None
) -> DataFrame:
    """One manifest row for each year: why it failed, or the member, year, archive, record, crop code and CRS its pixels come from.

    `pixels` are the outputs or the table of them read back. The reasons rank: an area that is no polygon, an archive that is of no
    use (`held`, see archive_held), no raster for the year, a raster the area does not meet. Failed rows carry no provenance.
    """
    spec, spark = registry.SOURCES[source], picked.sparkSession
    met = pixels.select("year").distinct().withColumn("_met", F.lit(True))
    crs = cells.default_crs(grids.join(picked.select("raster_id"), "raster_id", "left_semi")).select("raster_id", "epsg")
    rows = picked.join(crs.groupBy("raster_id").agg(F.min("epsg").alias("epsg")), "raster_id", "left").join(met, "year", "left")
    # One row, so the join makes no more rows than there are years.
    usable = F.lit(True) if held is None else F.col("_usable")
    if held is not None:
        rows = rows.join(F.broadcast(held.agg(F.coalesce(F.bool_or("cached"), F.lit(False)).alias("_usable"))))
    error = F.coalesce(
        F.lit(aoi.error),
        F.when(~usable, F.lit(registry.ARCHIVE_UNUSABLE)),
        F.col("error"),
        F.when(F.col("_met").isNull(), F.lit(registry.NO_OVERLAP)),
    )
    name = F.concat(F.lit(f"{aoi.aoi_id}/"), slots.output_path(source, F.col("slot"), F.lit(spec.variables[0])))
    judged = rows.withColumns({"error": error, "path": name, "aoi_id": F.lit(aoi.aoi_id)}).withColumn("download_successful", F.col("error").isNull())
    origin = catalog.provenance(
        source_file=F.col("raster_id"),
        year=F.col("year"),
        zip_name=F.lit(spec.archive),
        record_id=F.lit(spec.record),
        crop_code=F.lit(crop_code or ""),
        crs=F.concat(F.lit("EPSG:"), F.col("epsg").cast("string")),
    )
    return manifest.to_manifest(
        manifest.with_aoi(judged, aoi_frame(spark, [aoi])),
        data_source=F.lit(spec.data_source),
        variable_name=F.lit(spec.variables[0]),
        acquisition_time=F.col("slot"),
        metadata=F.when(F.col("download_successful"), origin),
    )
