"""Cell tables and manifests in Parquet."""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsheaf import schemas

BLOCK_ROWS = 256
#: Units of more rows than this meet their last attempt by broadcast; there are fewer of them than rows / HOT_ROWS.
HOT_ROWS = 100_000
#: Folders of an output. The area comes first: two areas share no output.
KEYS = ("aoi_id", "source", "var", "slot")


def read_cells(
    spark: SparkSession,
    path: str,
    variables: list[str] | None = None,
    extent: tuple[float, float, float, float] | None = None,
    period: tuple[str, str] | None = None,
) -> DataFrame:
    """Gridded cells with the subset pushed into the scan: variables prune folders when written by
    write_raster; extent (west, south, east, north) and period [first, after) skip row groups."""
    df = spark.read.parquet(path)
    if variables is not None:
        df = df.where(F.col("var").isin(*variables))
    if extent is not None:
        west, south, east, north = map(float, extent)
        df = df.where(F.col("x").between(west, east) & F.col("y").between(south, north))
    if period is not None:
        first, after = (F.lit(p).cast("timestamp_ntz") for p in period)
        df = df.where((F.col("t") >= first) & (F.col("t") < after))
    return df


def _laid_out(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of one output go to tasks by blocks of raster rows, so a huge output is many tasks' work."""
    absent = [k for k in keys if k not in cells.columns]
    if absent:
        raise ValueError(f"cells have no column {', '.join(absent)}, which names their output")
    block = F.floor(F.col("r") / BLOCK_ROWS)
    return cells.repartition(*keys, block).sortWithinPartitions(*keys, "r", "c")


def write_raster(cells: DataFrame, path: str, keys: tuple[str, ...] = KEYS) -> None:
    """One folder per output; files inside are sorted by row and column."""
    _laid_out(cells, list(keys)).write.partitionBy(*keys).option("compression", "zstd").parquet(path)


def overwrite_slot(cells: DataFrame, path: str, keys: tuple[str, ...] = KEYS) -> None:
    """Replace exactly the outputs that `cells` holds. The commit makes a half-written one invisible."""
    (
        _laid_out(cells, list(keys))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*keys)
        .parquet(path)
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.write.mode("append").partitionBy("data_source").parquet(path)


def work_unit() -> Column:
    """What one attempt answers as a whole, as text: a scene of an area, or else a variable and time of an area.

    All rows of a unit go together, so the bands of a scene take the place of the one failed row it had before.
    """
    scene = F.coalesce(F.try_element_at("metadata", F.lit("scene_id")), F.try_element_at("metadata", F.lit("Id")))
    slot = F.struct("variable_name", "acquisition_time", "path")
    return F.to_json(F.struct("data_source", "polygon", scene.alias("scene"), F.when(scene.isNull(), slot).alias("slot")))


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _versions(spark: SparkSession, path: str) -> dict[int, str]:
    """Folders of the attempts begun below a path, by number."""
    system, place = _folder(spark, path)
    names = [str(s.getPath().toString()) for s in system.listStatus(place)] if system.exists(place) else []
    found = {re.search(r"/version=(\d+)$", name): name for name in names}
    return {int(m[1]): name for m, name in found.items() if m}


def upsert_manifest(manifest: DataFrame, path: str) -> int:
    """Add the manifest of one attempt and return its number. Readers see the whole attempt or nothing of it.

    Nothing is rewritten: each attempt is a folder version=N. Its number is taken by creating version N's claim file, which
    fails if another writer has it; the job's commit marks the folder as whole, and read_manifest looks at no other. An attempt that is
    lost on the way leaves a number that never counts.
    """
    spark = manifest.sparkSession
    n = max(_versions(spark, path), default=0) + 1
    while True:
        system, claim = _folder(spark, f"{path}/_claims/{n}")
        system.mkdirs(claim.getParent())
        if system.createNewFile(claim):
            break
        n += 1
    manifest.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.MANIFEST]).write.mode("error").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "true"
    ).parquet(f"{path}/version={n}")
    return n


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the last whole attempt at each unit of work, with its `version`; a path without any gives an empty table.

    The last attempt of a unit is a pre-aggregated maximum; rows meet it by the unit's text, which is never NULL. There are about as
    many units as rows, so they are shuffled once and never repeated; only the few units of very many rows are broadcast.
    """
    whole = []
    for name in _versions(spark, path).values():
        system, mark = _folder(spark, f"{name}/_SUCCESS")
        whole += [name] if system.exists(mark) else []
    if not whole:
        return spark.createDataFrame([], schemas.MANIFEST).withColumn("version", F.lit(0).cast("long"))
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/version=(\d+)/[^/]*$", 1).cast("long")
    rows = spark.read.schema(schemas.MANIFEST).parquet(*whole).withColumn("version", number).withColumn("_unit", work_unit())
    last = rows.groupBy("_unit").agg(F.max("version").alias("_last"), F.count("*").alias("_n"))
    hot = F.broadcast(last.where(F.col("_n") > HOT_ROWS).select("_unit", F.col("_last").alias("_hot")))
    cold = last.where(F.col("_n") <= HOT_ROWS).select("_unit", "_last")
    known = rows.join(hot, "_unit", "left")
    few = known.where("_hot IS NULL").join(cold.hint("merge"), "_unit").where("version = _last").drop("_last")
    return few.unionByName(known.where("version = _hot")).drop("_unit", "_hot")
