"""The report table: one row per attempted output, failures included."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsheaf import registry, schemas
from cellsheaf.aoi import Aoi
from cellsheaf.functions import rings
from cellsheaf.operators.skew import lookup


def to_manifest(outputs: DataFrame, **columns: Column) -> DataFrame:
    """Project onto the fixed nine fields; keyword columns override or supply fields."""
    have = set(outputs.columns)

    def field(f):
        if f.name in columns:
            col = columns[f.name]
        elif f.name in have:
            col = F.col(f.name)
            if f.name == "bbox" and isinstance(outputs.schema["bbox"].dataType, T.StructType):
                col = rings.bbox_list(col)
        else:
            col = F.lit(None)
        return col.cast(f.dataType).alias(f.name)

    return outputs.select(*[field(f) for f in schemas.MANIFEST])


def with_aoi(rows: DataFrame, aois: DataFrame) -> DataFrame:
    """Attach polygon text and bbox of the area to every row."""
    text = aois.select(
        "aoi_id",
        rings.to_geojson(F.col("geom_type"), F.col("rings")).alias("polygon"),
        rings.bbox_list(rings.bounds(F.col("rings"))).alias("bbox"),
    )
    spread = [c for c in rows.columns if c.endswith("_id") and c != "aoi_id"] or ["path"]
    return lookup(rows, text, ["aoi_id"], spread)


def check_geometry(aois: DataFrame) -> DataFrame:
    """Add `ok` and the error text for areas that are no polygons."""
    ok = rings.valid_type(F.col("geom_type"))
    return aois.withColumn("ok", ok).withColumn("error", F.when(~ok, F.lit(registry.NOT_A_POLYGON)))


def failed_request(spark: SparkSession, data_source: str, aoi: Aoi) -> DataFrame:
    """The one row of a request whose area is no polygon."""
    return to_manifest(
        spark.range(1),
        data_source=F.lit(data_source),
        path=F.lit(""),
        download_successful=F.lit(False),
        error=F.lit(aoi.error),
    )


def pending(scenes: DataFrame, product_type: str, aoi_pairs: DataFrame, aois: DataFrame) -> DataFrame:
    """One not yet successful row per scene found for an area; pairs that carry the scenes' columns are taken as they are."""
    found = aoi_pairs if set(scenes.columns) <= set(aoi_pairs.columns) else scenes.join(aoi_pairs, "scene_id")
    return to_manifest(
        with_aoi(found, aois),
        data_source=F.lit("CDSE OData API"),
        variable_name=F.lit(product_type),
        acquisition_time=F.col("acq_start"),
        path=F.lit(""),
        download_successful=F.lit(False),
    )


def with_failures(expected: DataFrame, done: DataFrame, on: list[str], error: Column | str) -> DataFrame:
    """Every expected row: a done one keeps its result, any other becomes a failed row with the error."""
    text = F.lit(error) if isinstance(error, str) else error
    kept = done.select(*on, "path", F.lit(True).alias("_done"))
    ok = F.coalesce("_done", F.lit(False))
    return (
        expected.join(kept, on, "left")
        .withColumn("download_successful", ok)
        .withColumn("error", F.when(~ok, text))
        .drop("_done")
    )


def scene_to_bands(scenes: DataFrame, product_type: str) -> DataFrame:
    """Rows per exported variable of a good scene; one row with the product type for a failed one.

    Expects `variables` (array) and `error`. A scene without variables counts as failed.
    """
    none = F.coalesce(F.size("variables"), F.lit(0)) <= 0
    error = F.coalesce(
        F.when(F.col("error").isNotNull(), F.concat(F.lit("Failed processing "), F.col("name"), F.lit(": "), F.col("error"))),
        F.when(none, F.concat(F.lit("Failed processing "), F.col("name"), F.lit(": no variables"))),
    )
    return (
        scenes.withColumn("error", error)
        .withColumn("download_successful", F.col("error").isNull())
        .withColumn(
            "variable_name",
            F.explode(F.when(F.col("error").isNull(), F.col("variables")).otherwise(F.array(F.lit(product_type)))),
        )
    )


def verdict(rows: DataFrame, missing: Column, valid: Column, missing_text: Column, invalid_text: str) -> DataFrame:
    """Success and error of each output: a missing input outranks a failed validation."""
    error = F.when(missing, missing_text).when(~F.coalesce(valid, F.lit(False)), F.lit(invalid_text))
    return rows.withColumn("error", error).withColumn("download_successful", F.col("error").isNull())


def absent_assets(assets: DataFrame, inventory: DataFrame, policy: str) -> DataFrame:
    """Result files the download stream lacks: `report` keeps them as failed rows, `skip` drops them."""
    held = inventory.select("filename", F.lit(True).alias("_held")).distinct()
    how = {"report": "left", "skip": "inner"}[policy]
    ok = F.coalesce("_held", F.lit(False))
    return (
        assets.join(held, "filename", how)
        .withColumn("download_successful", ok)
        .withColumn("error", F.when(~ok, F.lit(registry.FILE_MISSING)))
        .drop("_held")
    )


def all_ok(manifest: DataFrame) -> DataFrame:
    """Per source: whether every output succeeded, and the counts that must agree."""
    return manifest.groupBy("data_source").agg(
        F.bool_and("download_successful").alias("all_ok"),
        F.count(F.lit(1)).alias("n_outputs"),
        F.count_if(F.col("download_successful")).alias("n_ok"),
    )
