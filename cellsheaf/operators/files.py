"""Decisions about files: kind, validity, reuse and choice."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsheaf import registry

# Leading bytes (hex) of the file kinds that are told apart.
SIGNATURES = {"zip": "504B0304", "netcdf3": "434446", "hdf5": "89484446"}
RASTER_SIGNATURES = {"tiff_le": "49492A00", "tiff_be": "4D4D002A", "bigtiff_le": "49492B00", "bigtiff_be": "4D4D002B", "parquet": "50415231"}
# Fixed value: the end record of a ZIP archive.
ZIP_END = "504B0506"
_TIFF = ("tiff_le", "tiff_be", "bigtiff_le", "bigtiff_be")
#: The kinds that a file of an extension may be of.
EXTENSIONS = {"tif": _TIFF, "tiff": _TIFF, "parquet": ("parquet",), "zip": ("zip",), "nc": ("netcdf3", "hdf5"), "h5": ("hdf5",)}


def file_kind(head: Column) -> Column:
    """zip, netcdf3, hdf5 or unexpected, from the leading bytes."""
    text = F.hex(head)
    kind = F.lit("unexpected")
    for name, magic in SIGNATURES.items():
        kind = F.when(F.startswith(text, F.lit(magic)), F.lit(name)).otherwise(kind)
    return kind


def classify_files(inventory: DataFrame) -> DataFrame:
    """Add `kind` and, for an unexpected file, an error with its header and first 200 bytes (hex)."""
    kind = file_kind(F.col("head"))
    text = F.when(
        F.col("head").isNotNull(),
        F.concat(
            F.lit("unexpected file type; header bytes: "),
            F.hex(F.substring("head", 1, 4)),
            F.lit("; first 200 bytes: "),
            F.hex(F.substring("head", 1, 200)),
        ),
    ).otherwise("file is absent")
    return inventory.withColumn("kind", kind).withColumn("error", F.when(F.col("kind") == "unexpected", text))


def readable(path: Column, head: Column, tail: Column | None = None) -> Column:
    """Whether a file can be of the kind its name promises: that kind's signature in front and, if the tail is given, its end mark behind.

    A name without a known extension promises any kind that is told apart. An absent file is not readable.
    """
    front = F.hex(head)
    starts = {name: F.startswith(front, F.lit(magic)) for name, magic in {**SIGNATURES, **RASTER_SIGNATURES}.items()}
    if tail is not None:
        back = F.hex(tail)
        starts["parquet"] &= F.endswith(back, F.lit(RASTER_SIGNATURES["parquet"])) & (F.length(tail) > 8)
        # Archives are written without a comment, so the end record is the tail.
        starts["zip"] &= F.startswith(back, F.lit(ZIP_END))
    extension = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    any_kind = F.lit(False)
    for ok in starts.values():
        any_kind = any_kind | ok
    told = any_kind
    for name, kinds in EXTENSIONS.items():
        own = F.lit(False)
        for kind in kinds:
            own = own | starts[kind]
        told = F.when(extension == name, own).otherwise(told)
    return F.coalesce(told, F.lit(False))


def validate_outputs(expected: DataFrame, inventory: DataFrame) -> DataFrame:
    """Every expected path with `valid`: listed, not empty and of the kind its name promises. Missing means false.

    An inventory whose rows are already judged says so in a column `readable`.
    """
    columns = inventory.columns
    told = F.col("readable") if "readable" in columns else readable(F.col("path"), F.col("head"), F.col("tail") if "tail" in columns else None)
    seen = inventory.select("path", ((F.col("length") > 0) & told).alias("_ok"))
    return expected.join(seen, "path", "left").withColumn("valid", F.coalesce("_ok", F.lit(False))).drop("_ok")


def cache_plan(requests: DataFrame, inventory: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Requests with `cached`: a listed file larger than min_bytes makes a fetch needless.

    min_bytes = -1 accepts any existing file, 0 any non-empty one.
    """
    held = inventory.where(F.col("length") > min_bytes).select("path").distinct().withColumn("_held", F.lit(True))
    return requests.join(held, "path", "left").withColumn("cached", F.coalesce("_held", F.lit(False))).drop("_held")


def reusable(source: Column, length: Column, opens: Column) -> Column:
    """Whether a file that is there makes a fetch needless, by the rule its source is registered with: least size, and whether it must open."""
    specs = registry.SOURCES.values()
    least = F.create_map(*[F.lit(x) for s in specs for x in (s.key, s.least_bytes)])
    opened = F.create_map(*[F.lit(x) for s in specs for x in (s.key, s.must_open)])
    ok = (length > F.try_element_at(least, source)) & (~F.try_element_at(opened, source) | F.coalesce(opens, F.lit(False)))
    return F.coalesce(ok, F.lit(False))


def cache_plan_by_source(requests: DataFrame, inventory: DataFrame) -> DataFrame:
    """Requests (source, path, ...) with `cached`, each by its own source's rule. An unknown source holds nothing.

    The inventory has path, length, head and perhaps tail. A path listed twice counts once: one listing that will do is enough.
    """
    tail = F.col("tail") if "tail" in inventory.columns else None
    held = inventory.select("path", "length", readable(F.col("path"), F.col("head"), tail).alias("_opens"))
    # Of repeated listings the one that opens, then the largest: it meets every rule that any of them meets, as a file has one content.
    best = held.groupBy("path").agg(F.max(F.struct("_opens", "length")).alias("_f"))
    out = requests.join(best, "path", "left")
    return out.withColumn("cached", reusable(F.col("source"), F.col("_f")["length"], F.col("_f")["_opens"])).drop("_f")


def to_fetch(requests: DataFrame, inventory: DataFrame, min_bytes: int = 0) -> DataFrame:
    return requests.join(inventory.where(F.col("length") > min_bytes), "path", "left_anti")


def pick_raster(inventory: DataFrame, requests: DataFrame, crop_code: str | None = None) -> DataFrame:
    """For each requested (key, year) the best file; without any, a row with an error.

    A year in the file name beats a year elsewhere in the path; a crop code match beats none;
    then fewest path parts, the shortest name, `.tif` before `.tiff`, and the path as last order.
    Each file is keyed by every four-digit run its path holds, so years meet by equi-join,
    and the best file is a pre-aggregated minimum, not a sort of all candidates.
    """
    key = "archive"
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    runs = F.array_distinct(
        F.filter(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.length("path") - 3, F.lit(1))),
                lambda i: F.substr(F.col("path"), i, F.lit(4)),
            ),
            lambda s: s.rlike("^[0-9]{4}$"),
        )
    )
    rasters = inventory.where(F.col("path").rlike(r"\.tiff?$")).withColumn("_y", F.explode(runs))
    code = F.lit((crop_code or "").lower())
    order = F.struct(
        (~F.contains(name, F.col("_y"))).cast("int").alias("tier"),
        (~F.contains(F.lower("path"), code)).cast("int").alias("crop_miss"),
        F.size(parts).alias("parts"),
        F.length(name).alias("name_len"),
        F.endswith(F.col("path"), F.lit(".tiff")).cast("int").alias("tiff"),
        F.col("path").alias("path"),
    )
    best = rasters.select(key, F.col("_y").cast("int").alias("year"), order.alias("_o")).groupBy(key, "year").agg(
        F.min("_o")["path"].alias("path")
    )
    text = F.concat(F.lit("No GeoTIFF found for year="), F.col("year").cast("string"))
    return requests.join(best, [key, "year"], "left").withColumn("error", F.when(F.col("path").isNull(), text))
