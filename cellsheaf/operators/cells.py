"""Pixel columns: names, packing, nodata and coordinates."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsheaf.functions import names
from cellsheaf.operators.skew import lookup


def normalise_coords(df: DataFrame) -> DataFrame:
    """Rename the first column starting with lat to y and the first starting with lon to x."""
    renames = {}
    for prefix, name in (("lat", "y"), ("lon", "x")):
        found = next((c for c in df.columns if c.lower().startswith(prefix)), None)
        if found is None:
            raise ValueError(f"no coordinate column starts with {prefix!r}: {df.columns}")
        renames[found] = name
    return df.withColumnsRenamed(renames)


def unify_time(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("valid_time", "time") if "valid_time" in df.columns else df


def rename_vars(cells: DataFrame, var: str = "var") -> DataFrame:
    """Long variable names become their short names; unknown names stay."""
    return cells.withColumn(var, names.short_name(F.col(var)))


def decode_packed(cells: DataFrame, scale: float, offset: float = 0.0, fill: float | None = None) -> DataFrame:
    raw = F.col("v") if fill is None else F.nullif(F.col("v"), F.lit(float(fill)))
    return cells.withColumn("v", raw * F.lit(float(scale)) + F.lit(float(offset)))


def apply_cells(cells: DataFrame, fn: Callable[[Column], Column]) -> DataFrame:
    """Apply a column function to every pixel value."""
    return cells.withColumn("v", fn(F.col("v")))


def default_crs(grids: DataFrame) -> DataFrame:
    return grids.withColumn("epsg", F.coalesce("epsg", F.lit(4326)))


def with_grid(cells: DataFrame, grids: DataFrame, columns: list[str]) -> DataFrame:
    return lookup(cells, grids.select("raster_id", *columns), ["raster_id"], ["r", "c"])


def nodata_to_null(cells: DataFrame, grids: DataFrame) -> DataFrame:
    return (
        with_grid(cells, grids, ["nodata"])
        .withColumn("v", F.when(F.col("nodata").isNull() | (F.col("v") != F.col("nodata")), F.col("v")))
        .drop("nodata")
    )


def centre_x(c: Column) -> Column:
    return F.col("x0") + (c + F.lit(0.5)) * F.col("dx")


def centre_y(r: Column) -> Column:
    return F.col("y0") + (r + F.lit(0.5)) * F.col("dy")


def pixel_centres(cells: DataFrame, grids: DataFrame) -> DataFrame:
    affine = ["x0", "y0", "dx", "dy"]
    return (
        with_grid(cells, grids, affine)
        .withColumn("x", centre_x(F.col("c")))
        .withColumn("y", centre_y(F.col("r")))
        .drop(*affine)
    )


def coord_range(cells: DataFrame, by: list[str], x: str = "x", y: str = "y") -> DataFrame:
    return cells.groupBy(*by).agg(
        F.min(y).alias("lat_min"), F.max(y).alias("lat_max"), F.min(x).alias("lon_min"), F.max(x).alias("lon_max")
    )
