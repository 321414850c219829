"""Calendar slots: which periods a request touches, and which of them the data covers."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsheaf import registry
from cellsheaf.functions import instants, names
from cellsheaf.operators.skew import lookup


def _slots(df: DataFrame, start: str, end: str, unit: str, step: str) -> DataFrame:
    s, e = F.trunc(start, unit), F.trunc(end, unit)
    days = F.when(s <= e, F.sequence(s, e, F.expr(f"interval {step}")))
    return (
        df.withColumn("_day", F.explode(days))
        .withColumn("slot_start", F.col("_day").cast("timestamp_ntz"))
        .withColumn("slot_end", (F.col("_day") + F.expr(f"interval {step}")).cast("timestamp_ntz"))
        .drop("_day")
    )


def month_slots(df: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per month the frame touches, both end months included; an inverted frame gives none."""
    return (
        _slots(df, start, end, "MM", "1 month")
        .withColumn("year", F.year("slot_start"))
        .withColumn("month", F.month("slot_start"))
    )


def year_slots(df: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    return _slots(df, start, end, "YYYY", "1 year").withColumn("year", F.year("slot_start"))


def with_slot(df: DataFrame, source: str = "source", t: str = "t") -> DataFrame:
    """Add the first instant of the period of t, by the cadence the source is registered with."""
    cadence = F.create_map(*[F.lit(x) for s in registry.SOURCES.values() for x in (s.key, s.cadence)])
    return df.withColumn("slot", instants.slot_of(F.col(t), F.try_element_at(cadence, F.col(source))))


def first_step(cells: DataFrame, by: list[str], t: str = "t") -> DataFrame:
    """Keep the earliest time step of each group: one time for the whole raster, not one per pixel.

    The minimum is pre-aggregated on the map side; the join back is cut by pixel hash,
    so a raster that holds most rows is not sent to one task.
    """
    first = cells.groupBy(*by).agg(F.min(t).alias("_first"))
    return lookup(cells, first, by, ["r", "c"]).where(F.col(t) == F.col("_first")).drop("_first")


def first_step_in_month(cells: DataFrame, by: list[str], t: str = "t") -> DataFrame:
    """First time step inside every month, with the month as `slot`."""
    return first_step(cells.withColumn("slot", instants.month_start(F.col(t))), [*by, "slot"], t)


def one_value_per_pixel(cells: DataFrame, by: list[str], order: list[str], value: str = "v") -> DataFrame:
    """Resolve duplicate records of one pixel by a total order."""
    return cells.groupBy(*by).agg(F.min_by(value, F.struct(*order)).alias(value))


def expected_outputs(slots: DataFrame, variables: Column | list[str], path: Column | None = None) -> DataFrame:
    """One row per slot and variable. Variables are exploded from an array, never cross joined."""
    array = variables if isinstance(variables, Column) else F.array(*[F.lit(v) for v in variables])
    out = slots.withColumn("var", F.explode(array))
    return out if path is None else out.withColumn("path", path)


def output_path(source: str, slot: Column, var: Column) -> Column:
    return F.concat(names.fill_template(registry.SOURCES[source].basename, slot, var), F.lit(".tif"))


def plan_requests(slots: DataFrame, source: str, slot: str = "slot_start") -> DataFrame:
    """Request name of every slot, from the template of the source."""
    return slots.withColumn("request", names.fill_template(registry.REQUEST_TEMPLATES[source], F.col(slot)))


def plan_products(scenes: DataFrame, source: str = "sen3_cdse", product_id: str = "scene_id") -> DataFrame:
    """Request of every product found: the name it is kept under and the address it comes from. A scene without name or id has neither."""
    fill = {"name": F.col("name"), "id": F.col(product_id).cast("string")}
    return scenes.withColumns(
        {
            "request": names.fill_template(registry.REQUEST_TEMPLATES[source], **fill),
            "address": names.fill_template(registry.PRODUCT_ADDRESS, **fill),
        }
    )


def completeness(expected: DataFrame, cells: DataFrame, on: list[str]) -> DataFrame:
    """Every expected row, with whether the cells hold anything for it and the error text if not."""
    present = cells.select(*on).distinct().withColumn("_here", F.lit(True))
    here = F.coalesce("_here", F.lit(False))
    text = F.concat(F.lit("Variable '"), F.col("var"), F.lit("' missing in downloaded file."))
    return (
        expected.join(present, on, "left")
        .withColumn("present", here)
        .withColumn("error", F.when(~here, text))
        .drop("_here")
    )
