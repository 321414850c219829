"""Change pixel size: area average down, bilinear up, and stacking of bands.

Both resamplings scatter: a source pixel knows from the two grid shapes alone which target
pixels it feeds and with what weight. So one narrow step and one groupBy suffice, partially aggregated on the way
down and behind the shuffle of the source on the way up; neither needs a join between pixels.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsheaf.operators.skew import lookup


def target_grid(grids: DataFrame, res: float) -> DataFrame:
    """Grid at resolution `res`: sizes rounded down, at least 1.

    The pixel size is extent / size, the one the averages are really taken over, so it may
    exceed `res` when the extent is no multiple of it.
    """
    wide, high = F.col("width") * F.abs("dx"), F.col("height") * F.abs("dy")
    return (
        grids.withColumn("_w", F.greatest(F.floor(wide / F.lit(float(res))), F.lit(1).cast("long")).cast("int"))
        .withColumn("_h", F.greatest(F.floor(high / F.lit(float(res))), F.lit(1).cast("long")).cast("int"))
        .withColumn("dx", F.signum("dx") * wide / F.col("_w"))
        .withColumn("dy", F.signum("dy") * high / F.col("_h"))
        .withColumn("width", F.col("_w"))
        .withColumn("height", F.col("_h"))
        .drop("_w", "_h")
    )


def _sizes(source: DataFrame, target: DataFrame, on: list[str]) -> DataFrame:
    s = source.select(*on, F.col("width").alias("_ws"), F.col("height").alias("_hs"))
    t = target.select(*on, F.col("width").alias("_wt"), F.col("height").alias("_ht"))
    return s.join(t, on)


def _area_targets(i: Column, n_source: Column, n_target: Column) -> Column:
    """Targets a source pixel overlaps along one axis, as array<struct<i,w>>."""
    step = n_source / n_target
    lo = F.floor(i / step)
    hi = F.least(F.floor((i + 1) / step), (n_target - 1).cast("long"))
    every = F.transform(
        F.sequence(lo, hi),
        lambda k: F.struct(
            k.cast("int").alias("i"), (F.least(i + 1.0, (k + 1) * step) - F.greatest(i * 1.0, k * step)).alias("w")
        ),
    )
    return F.filter(every, lambda p: p["w"] > 1e-9)


def _bilinear_targets(i: Column, n_source: Column, n_target: Column) -> Column:
    """Targets a source pixel contributes to along one axis, as array<struct<i,w>>."""
    lo = F.greatest(F.floor((i - 0.5) * n_target / n_source - 0.5), F.lit(0).cast("long"))
    hi = F.least(F.ceil((i + 1.5) * n_target / n_source - 0.5), (n_target - 1).cast("long"))

    def weight(k):
        s = (k + F.lit(0.5)) * n_source / n_target - F.lit(0.5)
        s = F.least(F.greatest(s, F.lit(0.0)), (n_source - 1).cast("double"))
        return F.greatest(F.lit(1.0) - F.abs(s - i), F.lit(0.0))

    every = F.transform(F.sequence(lo, hi), lambda k: F.struct(k.cast("int").alias("i"), weight(k).alias("w")))
    return F.filter(every, lambda p: p["w"] > 0)


def _scatter(cells: DataFrame, sizes: DataFrame, on: list[str], targets) -> DataFrame:
    rest = [c for c in cells.columns if c not in ("r", "c")]
    return (
        lookup(cells, sizes, on, ["r", "c"])
        .withColumn("_row", F.explode(targets(F.col("r"), F.col("_hs"), F.col("_ht"))))
        .withColumn("_col", F.explode(targets(F.col("c"), F.col("_ws"), F.col("_wt"))))
        .select(
            *rest, F.col("_row.i").alias("r"), F.col("_col.i").alias("c"), (F.col("_row.w") * F.col("_col.w")).alias("_w")
        )
    )


#: Target pixels of a block of target rows, and of all blocks that are dealt to one task, about.
BLOCK_PIXELS, TASK_PIXELS = 1 << 16, 1 << 20


def _dealt_up(cells: DataFrame, sizes: DataFrame, on: list[str], targets, by: list[str]) -> DataFrame:
    """As _scatter(), but made in the task of a block of target rows (`_blk`), where they are to be grouped.

    Upsampling makes many target pixels of a source pixel, so source pixels are dealt, once for each block that they feed, and
    to as many tasks as the target shapes have pixels for: Spark knows only the size of the source.
    """
    rest = [c for c in cells.columns if c not in ("r", "c")]
    total = sizes.agg(F.sum(F.col("_wt").cast("double") * F.col("_ht"))).first()[0] or 0.0
    tasks = max(cells.sparkSession.sparkContext.defaultParallelism, int(total // TASK_PIXELS) + 1)
    high = F.greatest(F.lit(1), F.floor(F.lit(BLOCK_PIXELS) / F.greatest("_wt", F.lit(1))).cast("int"))
    rows = lookup(cells, sizes, on, ["r", "c"]).withColumn("_rows", F.explode(F.array(targets(F.col("r"), F.col("_hs"), F.col("_ht")))))
    blocks = F.array_distinct(F.transform("_rows", lambda p: F.floor(p["i"] / high)))
    dealt = rows.withColumn("_blk", F.explode(blocks)).withColumn("_rows", F.filter("_rows", lambda p: F.floor(p["i"] / high) == F.col("_blk")))
    dealt = dealt.repartition(tasks, *by, "_blk")
    return (
        dealt.withColumn("_row", F.explode("_rows"))
        .withColumn("_col", F.explode(targets(F.col("c"), F.col("_ws"), F.col("_wt"))))
        .select(
            *rest, "_blk", F.col("_row.i").alias("r"), F.col("_col.i").alias("c"), (F.col("_row.w") * F.col("_col.w")).alias("_w")
        )
    )


def weighted_mean(v: Column, w: Column) -> Column:
    """NULL pixels carry no weight; a target that only has NULL sources is NULL."""
    known = F.when(v.isNotNull(), w)
    return F.sum(w * v) / F.nullif(F.sum(known), F.lit(0.0))


def downsample_average(
    cells: DataFrame,
    source: DataFrame,
    target: DataFrame,
    on: list[str] | None = None,
    by: list[str] | None = None,
    values: tuple[str, ...] = ("v",),
) -> DataFrame:
    """Mean of the source area under each target pixel, for all bands (rows or value columns) at once."""
    on = on or ["raster_id"]
    by = by or [*on, "band"]
    parts = _scatter(cells, _sizes(source, target, on), on, _area_targets)
    return parts.groupBy(*by, "r", "c").agg(*[weighted_mean(F.col(v), F.col("_w")).alias(v) for v in values])


def upsample_bilinear(
    cells: DataFrame, source: DataFrame, target: DataFrame, on: list[str] | None = None, by: list[str] | None = None
) -> DataFrame:
    """Bilinear interpolation of a coarser raster onto the shape of `target`."""
    on = on or ["raster_id"]
    by = by or [*on, "band"]
    parts = _dealt_up(cells, _sizes(source, target, on), on, _bilinear_targets, by)
    return parts.groupBy(*by, "_blk", "r", "c").agg(weighted_mean(F.col("v"), F.col("_w")).alias("v")).drop("_blk")


def master_grid(band_grids: DataFrame, by: str = "scene_id") -> DataFrame:
    """Grid of the band with most pixels; on a tie the band requested first (lowest `pos`)."""
    cols = [c for c in band_grids.columns if c != by]
    pixels = F.col("width").cast("long") * F.col("height")
    best = F.max_by(F.struct(*cols), F.struct(pixels, -F.col("pos")))
    return band_grids.groupBy(by).agg(best.alias("_g")).select(by, "_g.*")


def stack_bands(cells: DataFrame, bands: list[str], by: list[str]) -> DataFrame:
    """One row per pixel with one column per band, in request order."""
    return cells.groupBy(*by, "r", "c").agg(*[F.max(F.when(F.col("band") == b, F.col("v"))).alias(b) for b in bands])


def align_and_stack(cells: DataFrame, band_grids: DataFrame, bands: list[str], by: str = "scene_id") -> DataFrame:
    """Bring every band of a scene to its master shape and stack them, in one shuffle of pixels.

    A band already on the master shape passes with weight 1 at its own place.
    """
    master = master_grid(band_grids, by).select(by, F.col("width").alias("_wt"), F.col("height").alias("_ht"))
    sizes = band_grids.select(by, "band", F.col("width").alias("_ws"), F.col("height").alias("_hs")).join(master, by)
    parts = _dealt_up(cells, sizes, [by, "band"], _bilinear_targets, [by])

    def one(b):
        mine = F.col("band") == b
        return weighted_mean(F.when(mine, F.col("v")), F.when(mine, F.col("_w"))).alias(b)

    return parts.groupBy(by, "_blk", "r", "c").agg(*[one(b) for b in bands]).drop("_blk")
