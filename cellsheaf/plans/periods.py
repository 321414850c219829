"""Monthly and yearly sources: from cells to clipped outputs and a complete manifest."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsheaf import registry
from cellsheaf.aoi import Aoi
from cellsheaf.aoi import frame as aoi_frame
from cellsheaf.functions import instants
from cellsheaf.operators import cells as cell_ops
from cellsheaf.operators import catalog, clip, files, manifest, slots
from cellsheaf.operators.skew import lookup
from cellsheaf.sources import files as files_source
from cellsheaf.sources import tables


def _frame(cells: DataFrame, start: datetime, end: datetime) -> DataFrame:
    s, e = instants.ntz(start.isoformat(sep=" ")), instants.ntz(end.isoformat(sep=" "))
    return cells.sparkSession.range(1).select(s.alias("start"), e.alias("end"))


def _months(spec: registry.Source, start: datetime, end: datetime) -> tuple[datetime, datetime]:
    """First instant of the first period the frame touches, and of the one after the last."""
    first = datetime(start.year, 1 if spec.cadence == "yearly" else start.month, 1)
    next_year = spec.cadence == "yearly" or end.month == 12
    return first, datetime(end.year + 1, 1, 1) if next_year else datetime(end.year, end.month + 1, 1)


def outputs(
    source: str, cells: DataFrame, grids: DataFrame, aoi: Aoi, start: datetime, end: datetime, lonlat: bool = True
) -> DataFrame:
    """Clipped pixels of the first time step of every period and variable the frame touches.

    The time filter is two plain comparisons. The first step is that of the whole raster, wherever its
    pixels lie: it is a pre-aggregated minimum over all its cells, which the clipped ones alone are joined
    to, so only pixels of the area and frame move. An area that is no polygon has no pixels.
    """
    spec = registry.SOURCES[source]
    first, after = _months(spec, start, end)
    t, by = F.col("t"), ["raster_id", "var", "slot"]
    inside = cells.where((t >= instants.ntz(first.isoformat(" "))) & (t < instants.ntz(after.isoformat(" "))))
    slotted = cell_ops.rename_vars(inside).withColumn("slot", instants.slot_of(t, F.lit(spec.cadence)))
    clean = cell_ops.nodata_to_null(slotted, grids)
    if aoi.error:
        clipped = clean.where(F.lit(False)).withColumn("aoi_id", F.lit(aoi.aoi_id))
    else:
        clipped = clip.clip(clean, grids, [aoi], spec.clip_rule, lonlat)
    steps = slotted.groupBy(*by).agg(F.min("t").alias("_first"))
    out = lookup(clipped, steps, by, ["r", "c"]).where(t == F.col("_first")).drop("_first")
    return out.withColumn("source", F.lit(source))


def report(
    source: str, pixels: DataFrame, aoi: Aoi, start: datetime, end: datetime, inventory: DataFrame | None = None
) -> DataFrame:
    """One manifest row per period and variable. With an inventory of written files each is also validated.

    `pixels` may be the table of outputs read back; only its slots and variables are looked at. An area that is
    no polygon fails every row. Yearly rows carry the year in their metadata, monthly ones year and month.
    """
    spec = registry.SOURCES[source]
    frame = _frame(pixels, start, end)
    every = slots.month_slots(frame) if spec.cadence == "monthly" else slots.year_slots(frame)
    path = F.concat(F.lit(f"{aoi.aoi_id}/"), slots.output_path(source, F.col("slot"), F.col("var")))
    expected = slots.expected_outputs(
        every.select(F.col("slot_start").alias("slot")), list(spec.variables), path
    )
    rows = slots.completeness(expected, pixels, ["slot", "var"]).withColumnRenamed("error", "missing_text")
    rows = rows.withColumn("valid", F.lit(True)) if inventory is None else files.validate_outputs(rows, inventory)
    judged = manifest.verdict(rows, ~F.col("present"), F.col("valid"), F.col("missing_text"), "Validation failed")
    error = F.coalesce(F.lit(aoi.error), F.col("error"))
    judged = judged.withColumn("error", error).withColumn("download_successful", error.isNull())
    with_area = manifest.with_aoi(judged.withColumn("aoi_id", F.lit(aoi.aoi_id)), aoi_frame(pixels.sparkSession, [aoi]))
    period = {"year": F.year("slot")} | ({"month": F.month("slot")} if spec.cadence == "monthly" else {})
    return manifest.to_manifest(
        with_area,
        data_source=F.lit(spec.data_source),
        variable_name=F.col("var"),
        acquisition_time=F.col("slot"),
        metadata=catalog.provenance(**period),
    )


def written(spark: SparkSession, root: str, source: str, aoi: Aoi) -> DataFrame:
    """Outputs of a source and area below a folder, with what fetch() needs to trust them: var, slot, path, length, readable.

    An output counts as one file: the length is the sum over its part files, and it is readable if all of them are
    whole table files by their first and last bytes.
    """
    part = lambda key: F.url_decode(F.regexp_extract("path", f"/{key}=([^/]+)/", 1))
    # The listing is cut to the area's own files before any of them is opened.
    own = files_source.list_files(spark, root, "*.parquet").where((part("source") == source) & (part("aoi_id") == aoi.aoi_id))
    held = files_source.with_ends(own)
    told = files.readable(F.col("path"), F.col("head"), F.col("tail")).alias("readable")
    rows = held.select(part("var").alias("var"), part("slot").cast("timestamp_ntz").alias("slot"), "length", told)
    out = rows.groupBy("var", "slot").agg(F.sum("length").alias("length"), F.bool_and("readable").alias("readable"))
    name = F.concat(F.lit(f"{aoi.aoi_id}/"), slots.output_path(source, F.col("slot"), F.col("var")))
    return out.withColumn("path", name)


def fetch(
    source: str, cells: DataFrame, grids: DataFrame, aoi: Aoi, start: datetime, end: datetime, root: str, lonlat: bool = True
) -> DataFrame:
    """Write the outputs that are not there yet below `root` and return the manifest of what then lies there.

    An output is there if it is larger than the source's least size and its files are readable. New outputs
    are written by area, source, variable and slot, and replace nothing else; the manifest is judged on the
    files and rows read back, not on what was computed.
    """
    spark, spec = cells.sparkSession, registry.SOURCES[source]
    new = outputs(source, cells, grids, aoi, start, end, lonlat)
    exists = files_source.has_files(spark, root)
    if exists:
        held = written(spark, root, source, aoi).where((F.col("length") > spec.least_bytes) & F.col("readable"))
        new = new.join(F.broadcast(held.select("var", "slot")), ["var", "slot"], "left_anti")
    if not aoi.error:
        tables.overwrite_slot(new, root)
    if aoi.error or not files_source.has_files(spark, root):
        return report(source, new.where(F.lit(False)), aoi, start, end)
    back = spark.read.schema(new.schema).parquet(root).where((F.col("aoi_id") == aoi.aoi_id) & (F.col("source") == source))
    return report(source, back, aoi, start, end, written(spark, root, source, aoi))
