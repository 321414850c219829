"""Names, labels and provenance text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellsheaf import registry
from cellsheaf.functions import instants


def asset_key(band: Column) -> Column:
    """Asset key of a requested band; an unknown band is its own key in lower case."""
    table = F.create_map(*[F.lit(x) for kv in registry.BAND_ASSETS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.upper(band)), F.lower(band))


def short_name(var: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in registry.SHORT_NAMES.items() for x in kv])
    return F.coalesce(F.try_element_at(table, var), var)


def bands_or_default(bands: Column, default: tuple[str, ...]) -> Column:
    return F.coalesce(bands, F.array(*[F.lit(b) for b in default]))


def band_label(bands: Column) -> Column:
    return F.array_join(bands, ", ")


def mgrs_tile(tile: Column, grid_code: Column) -> Column:
    code = F.coalesce(grid_code, F.lit("UNKNOWN_GRID"))
    return F.coalesce(F.nullif(tile, F.lit("")), F.regexp_replace(code, "^MGRS-", ""))


def scene_name(tile: Column, acquired: Column, aoi_id: Column | None = None) -> Column:
    parts = [F.lit("S2"), tile, instants.stamp(acquired)]
    return F.concat_ws("_", *parts, *([] if aoi_id is None else [aoi_id]))


def datacube_name(source: str, acquired: Column) -> Column:
    prefix = {"sen2_openeo": "S2_L2A_", "sen3_openeo": "S3_WATER_"}[source]
    return F.concat(F.lit(prefix), instants.stamp(acquired))


def fill_template(template: str, slot: Column | None = None, var: Column | None = None, **more: Column) -> Column:
    """Replace {y}, {ym}, {var} and any further named key in a name template by columns."""
    times = {} if slot is None else {"{y}": instants.year_text(slot), "{ym}": instants.month_text(slot)}
    values = times | {"{var}": var} | {f"{{{k}}}": v for k, v in more.items()}
    pieces, rest = [], template
    while rest:
        at = min((rest.find(k) for k in values if k in rest), default=-1)
        if at < 0:
            pieces.append(F.lit(rest))
            break
        if at:
            pieces.append(F.lit(rest[:at]))
        key = rest[at : rest.index("}", at) + 1]
        pieces.append(values[key])
        rest = rest[at + len(key) :]
    return F.concat(*pieces)


def third_token_time(href: Column) -> Column:
    """Acquisition stamp as the third underscore token; NULL with fewer than three."""
    return F.try_element_at(F.split(href, "_"), F.lit(3))


def first_stamp_token(href: Column) -> Column:
    """First underscore token of 15 characters that contains a T."""
    tokens = F.filter(F.split(href, "_"), lambda p: (F.length(p) == 15) & F.contains(p, F.lit("T")))
    return F.try_element_at(tokens, F.lit(1))
