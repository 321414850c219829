"""Clip and crop rasters to areas of interest.

Rules: `centre` keeps a pixel whose centre lies inside (half-open even-odd), `touched`
also keeps a pixel whose closed square any edge meets. Cells off the frame of their raster are no pixels.

Two plans give the same pixels. A list of a few simple areas becomes an unrolled column
expression: a map-only job inside whole-stage code. Anything larger is turned into column
spans per raster row, which costs rows x edges instead of pixels x edges, and joined on
(raster, row, block of columns), so that no wide row or crowded raster lands in one task.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsheaf.aoi import Aoi
from cellsheaf.aoi import column as aoi_column
from cellsheaf.functions import projections, rings
from cellsheaf.operators.cells import centre_x, centre_y, with_grid
from cellsheaf.operators.pairing import overlap as bbox_overlap
from cellsheaf.operators.pairing import pair_by_bbox

# Keeps the generated method under the 8000 bytecodes the JIT compiles (measured: 7700 at the limit).
INLINE_TESTS = 28
BLOCK = 256
AFFINE = ["x0", "y0", "dx", "dy", "width", "height"]


def _span_in_band(y1, y2, x1, x2, lo, hi):
    """x-range of an edge inside the closed band [lo, hi] that it is known to meet."""
    height = F.nullif(y2 - y1, F.lit(0.0))
    xa = F.coalesce(x1 + (lo - y1) * (x2 - x1) / height, x1)
    xb = F.coalesce(x1 + (hi - y1) * (x2 - x1) / height, x2)
    return F.least(xa, xb), F.greatest(xa, xb)


def _row_band(r: Column) -> tuple[Column, Column]:
    a, b = F.col("y0") + r * F.col("dy"), F.col("y0") + (r + F.lit(1)) * F.col("dy")
    return F.least(a, b), F.greatest(a, b)


def _column_band(c: Column) -> tuple[Column, Column]:
    a, b = F.col("x0") + c * F.col("dx"), F.col("x0") + (c + F.lit(1)) * F.col("dx")
    return F.least(a, b), F.greatest(a, b)


# ---------------------------------------------------------------- few simple areas: expression plan


def _at(e, y: Column) -> Column:
    x1, y1, x2, y2 = e
    return F.lit(x1) + (y - F.lit(y1)) * F.lit(x2 - x1) / F.lit(y2 - y1)


def _inline_inside(aoi: Aoi) -> Column:
    x, y = F.col("_x"), F.col("_y")
    odd = F.lit(False)
    for e in aoi.edges:
        lo, hi = min(e[1], e[3]), max(e[1], e[3])
        if lo < hi:
            odd = odd != ((y >= F.lit(lo)) & (y < F.lit(hi)) & (x < _at(e, y)))
    return odd


def _inline_touched(aoi: Aoi) -> Column:
    """Square against edge; an axis-parallel edge needs four comparisons, a sloped one two crossings."""
    left, right, low, high = (F.col(k) for k in ("_left", "_right", "_low", "_high"))
    tests = []
    for x1, y1, x2, y2 in aoi.edges:
        lo, hi = min(y1, y2), max(y1, y2)
        if x1 == x2 or y1 == y2:
            xl, xr = F.lit(min(x1, x2)), F.lit(max(x1, x2))
        else:
            ends = [_at((x1, y1, x2, y2), y) for y in (F.greatest(low, F.lit(lo)), F.least(high, F.lit(hi)))]
            xl, xr = ends if (x2 > x1) == (y2 > y1) else reversed(ends)
        tests.append((low <= F.lit(hi)) & (high >= F.lit(lo)) & (left <= xr) & (right >= xl))
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _window(minx, miny, maxx, maxy) -> list[Column]:
    """Half-open pixel window c0, c1, r0, r1 that encloses a box, cut to the raster."""
    ca, cb = (minx - F.col("x0")) / F.col("dx"), (maxx - F.col("x0")) / F.col("dx")
    ra, rb = (miny - F.col("y0")) / F.col("dy"), (maxy - F.col("y0")) / F.col("dy")

    def cut(v, size):
        return F.least(F.greatest(v, F.lit(0)), F.col(size)).cast("int")

    return [
        cut(F.floor(F.least(ca, cb)), "width").alias("c0"),
        cut(F.ceil(F.greatest(ca, cb)), "width").alias("c1"),
        cut(F.floor(F.least(ra, rb)), "height").alias("r0"),
        cut(F.ceil(F.greatest(ra, rb)), "height").alias("r1"),
    ]


def _inline_marks(cells: DataFrame, grids: DataFrame, aois: list[Aoi], rule: str) -> DataFrame:
    r, c = F.col("r"), F.col("c")

    def mark(a: Aoi) -> Column:
        inside = _inline_inside(a)
        if rule == "touched":
            inside = inside | _inline_touched(a)
        return F.struct(F.lit(a.aoi_id).alias("aoi_id"), *_window(*map(F.lit, a.bounds)), inside.alias("inside"))

    low, high = _row_band(r)
    left, right = _column_band(c)
    # Known non-null inputs keep the generated code short.
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in ("r", "c", *AFFINE)])
    placed = (
        with_grid(cells, grids, AFFINE)
        .where(known & (r >= 0) & (r < F.col("height")) & (c >= 0) & (c < F.col("width")))
        .withColumns(
            {
                "_x": centre_x(c),
                "_y": centre_y(r),
                "_left": left,
                "_right": right,
                "_low": low,
                "_high": high,
            }
        )
    )
    marked = placed.withColumn("_m", F.explode(F.array(*[mark(a) for a in aois if a.rings])))
    m = F.col("_m")
    seen = m["inside"] | ((c >= m["c0"]) & (c < m["c1"]) & (r >= m["r0"]) & (r < m["r1"]))
    return marked.where(seen).select(*cells.columns, "_m.*")


# ---------------------------------------------------------------- any number of areas: span plan


def _eastward(j: Column) -> Column:
    """Column number of the j-th column from the west, and the other way round. Spans are worked out from west to east."""
    return F.when(F.col("dx") < 0, F.col("width") - 1 - j).otherwise(j)


def _first_column(limit: Column, position) -> Column:
    """Smallest k with position(k) >= limit, k counting from the west, robust to rounding of the first guess."""
    k = F.ceil((limit - position(F.lit(0.0))) / F.abs("dx"))
    return F.when(position(k - 1) >= limit, k - 1).when(position(k) >= limit, k).otherwise(k + 1)


def _edge_rows(areas: DataFrame) -> DataFrame:
    """Every edge with every raster row it comes near."""
    e = areas.withColumn("_e", F.explode("edges")).drop("edges").select("*", "_e.*").drop("_e")
    ra, rb = (F.col("y1") - F.col("y0")) / F.col("dy"), (F.col("y2") - F.col("y0")) / F.col("dy")
    lo = F.greatest(F.floor(F.least(ra, rb)) - 1, F.lit(0))
    hi = F.least(F.ceil(F.greatest(ra, rb)) + 1, F.col("height") - 1)
    return e.withColumn("r", F.explode(F.when(lo <= hi, F.sequence(lo, hi))))


SPANS = "array<struct<c_from:bigint,c_to:bigint>>"


def _span(first: Column, last: Column) -> Column:
    return F.struct(first.cast("long").alias("c_from"), last.cast("long").alias("c_to"))


def _crossing_column() -> Column:
    """First column whose centre lies right of where the edge crosses the row; NULL if it does not."""
    y = centre_y(F.col("r"))
    e = {k: F.col(k) for k in ("x1", "y1", "x2", "y2")}
    return F.when((F.col("y1") > y) != (F.col("y2") > y), _first_column(rings.crossing(e, y), lambda j: centre_x(_eastward(j))))


def _touched_span() -> Column:
    """Columns whose closed squares in this row the edge meets; NULL if it misses the row."""
    band_lo, band_hi = _row_band(F.col("r"))
    x1, y1, x2, y2 = (F.col(k) for k in ("x1", "y1", "x2", "y2"))
    lo, hi = F.greatest(band_lo, F.least(y1, y2)), F.least(band_hi, F.greatest(y1, y2))
    xl, xr = _span_in_band(y1, y2, x1, x2, lo, hi)

    def side(j, east: bool):
        west, far = _column_band(_eastward(j))
        return far if east else west

    first = _first_column(xl, lambda j: side(j, True))
    k = F.floor((xr - side(F.lit(0), False)) / F.abs("dx"))
    last = F.when(side(k + 1, False) <= xr, k + 1).when(side(k, False) <= xr, k).otherwise(k - 1)
    return F.when(lo <= hi, _span(first, last))


def _merged(spans: Column) -> Column:
    """Join overlapping or adjacent spans, so that no pixel comes twice."""
    last = lambda acc: F.try_element_at(acc, F.lit(-1))
    return F.aggregate(
        F.sort_array(spans),
        F.expr(f"cast(array() as {SPANS})"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["c_from"] <= last(acc)["c_to"] + 1),
            F.concat(
                F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(_span(last(acc)["c_from"], F.greatest(last(acc)["c_to"], s["c_to"]))),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )


def covered_spans(areas: DataFrame, rule: str) -> DataFrame:
    """Column spans of each (aoi_id, raster_id, r) that an area covers, in one pass over edges and rows.

    `areas` has aoi_id, raster_id, edges and the affine columns of the raster. One list holds
    what one area's edges do in one row; the area itself arrives as one value.
    """
    keys = ["aoi_id", "raster_id", "r"]
    touched = _touched_span() if rule == "touched" else F.lit(None).cast("struct<c_from:bigint,c_to:bigint>")
    near = _edge_rows(areas).select(*keys, "width", "dx", _crossing_column().alias("_k"), touched.alias("_t"))
    rows = (
        near.where("_k is not null or _t is not null")
        .groupBy(*keys, "width", "dx")
        .agg(F.sort_array(F.collect_list("_k")).alias("_ks"), F.collect_list("_t").alias("_ts"))
    )
    pairs = F.transform(
        F.when(F.size("_ks") > 0, F.sequence(F.lit(0), (F.size("_ks") / 2).cast("int") - 1)).otherwise(
            F.array().cast("array<int>")
        ),
        lambda i: _span(F.get("_ks", i * 2), F.get("_ks", i * 2 + 1) - 1),
    )
    inside = F.filter(
        F.transform(
            F.concat(pairs, F.col("_ts")),
            lambda s: _span(F.greatest(s["c_from"], F.lit(0)), F.least(s["c_to"], F.col("width") - 1)),
        ),
        lambda s: s["c_from"] <= s["c_to"],
    )
    spans = _merged(inside) if rule == "touched" else inside
    ends = F.array(_eastward(F.col("_s.c_from")), _eastward(F.col("_s.c_to")))
    out = rows.select(*keys, "width", "dx", F.explode(spans).alias("_s"))
    return out.select(*keys, F.array_min(ends).alias("c_from"), F.array_max(ends).alias("c_to"))


def areas_on_grids(grids: DataFrame, aois: "list[Aoi] | DataFrame", lonlat: bool = False) -> DataFrame:
    """Rasters paired with the areas they overlap, with edges in raster coordinates and pixel window.

    A list is placed on every grid row as a constant. A table that names its rasters
    (column raster_id, as scene matching yields it) joins on that. Both are projected to the
    CRS of the grid (`epsg`, NULL meaning 4326) unless all grids are known to be `lonlat`. A table without raster_id is paired by
    boxes, which needs grids in longitude and latitude.
    """
    epsg = F.coalesce("epsg", F.lit(4326)) if "epsg" in grids.columns else F.lit(4326)
    g = grids.select("raster_id", *AFFINE, epsg.alias("epsg"))
    far_x, far_y = F.col("x0") + F.col("width") * F.col("dx"), F.col("y0") + F.col("height") * F.col("dy")
    frame = F.struct(
        F.least("x0", far_x).alias("minx"),
        F.least("y0", far_y).alias("miny"),
        F.greatest("x0", far_x).alias("maxx"),
        F.greatest("y0", far_y).alias("maxy"),
    )
    if isinstance(aois, list):
        p = g.withColumn("_a", F.explode(aoi_column(aois))).select(*g.columns, "_a.aoi_id", "_a.rings")
    elif "raster_id" in aois.columns:
        p = aois.select("raster_id", "aoi_id", "rings").join(g, "raster_id")
    else:
        left = g.select(F.col("raster_id").alias("id"), frame.alias("bbox"), *AFFINE, "epsg")
        right = aois.select(F.col("aoi_id").alias("id"), rings.bounds(F.col("rings")).alias("bbox"), "rings")
        pairs = pair_by_bbox(left, right)
        p = pairs.select(
            F.col("l_id").alias("raster_id"),
            *[F.col(f"l_{k}").alias(k) for k in (*AFFINE, "epsg")],
            F.col("r_id").alias("aoi_id"),
            F.col("r_rings").alias("rings"),
        )
    if not lonlat:
        projected = projections.project_rings(F.col("rings"), F.col("epsg"))
        p = p.withColumn("rings", F.when(F.col("epsg") == 4326, F.col("rings")).otherwise(projected))
    p = p.withColumn("bbox", rings.bounds(F.col("rings")))
    b = F.col("bbox")
    return p.where(bbox_overlap(b, frame)).select(
        "raster_id",
        "aoi_id",
        rings.edges(F.col("rings")).alias("edges"),
        *AFFINE,
        *_window(b["minx"], b["miny"], b["maxx"], b["maxy"]),
    )


def _blocks(lo: Column, hi: Column) -> Column:
    return F.explode(F.when(lo <= hi, F.sequence(F.floor(lo / BLOCK), F.floor(hi / BLOCK))))


def _join_spans(cells: DataFrame, areas: DataFrame, rule: str) -> DataFrame:
    spans = covered_spans(areas, rule).withColumn("_cb", _blocks(F.col("c_from"), F.col("c_to")))
    keyed = cells.withColumn("_cb", F.floor(F.col("c") / BLOCK))
    return (
        keyed.join(spans, ["raster_id", "r", "_cb"])
        .where(F.col("c").between(F.col("c_from"), F.col("c_to")))
        .select(*cells.columns, "aoi_id")
    )


def _span_marks(cells: DataFrame, areas: DataFrame, rule: str) -> DataFrame:
    spans = covered_spans(areas, rule).withColumn("_cb", _blocks(F.col("c_from"), F.col("c_to")))
    window = (
        areas.select("aoi_id", "raster_id", "c0", "c1", "r0", "r1")
        .withColumn("_cb", _blocks(F.col("c0"), F.col("c1") - 1))
        .withColumn("r", F.explode(F.when(F.col("r0") < F.col("r1"), F.sequence("r0", F.col("r1") - 1))))
    )
    on = ["raster_id", "r", "_cb"]
    inside = (
        window.join(
            spans.groupBy("aoi_id", *on).agg(F.collect_list(F.struct("c_from", "c_to")).alias("_spans")),
            ["aoi_id", *on],
            "left",
        )
    )
    c = F.col("c")
    return (
        cells.withColumn("_cb", F.floor(c / BLOCK))
        .join(inside, on)
        .where((c >= F.col("c0")) & (c < F.col("c1")))
        .withColumn(
            "inside",
            F.coalesce(F.exists("_spans", lambda s: c.between(s["c_from"], s["c_to"])), F.lit(False)),
        )
        .select(*cells.columns, "aoi_id", "c0", "c1", "r0", "r1", "inside")
    )


# ---------------------------------------------------------------- operators


def _few(aois, rule: str, lonlat: bool) -> bool:
    per_edge = {"centre": 1, "touched": 2}[rule]
    return lonlat and isinstance(aois, list) and per_edge * sum(len(a.edges) for a in aois) <= INLINE_TESTS


def clip(
    cells: DataFrame, grids: DataFrame, aois: "list[Aoi] | DataFrame", rule: str = "centre", lonlat: bool = True
) -> DataFrame:
    """Cells inside each area, with `aoi_id`. All variables and time steps go through in one pass.

    `lonlat=False` says that grids may have other CRSs: areas are then projected per grid.
    """
    if _few(aois, rule, lonlat):
        return _inline_marks(cells, grids, aois, rule).where("inside").select(*cells.columns, "aoi_id")
    return _join_spans(cells, areas_on_grids(grids, aois, lonlat), rule)


def crop_grids(grids: DataFrame, aois: "list[Aoi] | DataFrame", lonlat: bool = True) -> DataFrame:
    """Grid of each raster shrunk to the window of each area it overlaps."""
    areas = areas_on_grids(grids, aois, lonlat).where("c0 < c1 and r0 < r1")
    rest = grids.select("raster_id", *[c for c in grids.columns if c not in (*AFFINE, "raster_id", "aoi_id")])
    return areas.join(rest, "raster_id").select(
        "aoi_id",
        "raster_id",
        (F.col("x0") + F.col("c0") * F.col("dx")).alias("x0"),
        (F.col("y0") + F.col("r0") * F.col("dy")).alias("y0"),
        "dx",
        "dy",
        (F.col("c1") - F.col("c0")).alias("width"),
        (F.col("r1") - F.col("r0")).alias("height"),
        *[c for c in rest.columns if c != "raster_id"],
    )


def crop_window(
    cells: DataFrame,
    grids: DataFrame,
    aois: "list[Aoi] | DataFrame",
    rule: str = "centre",
    outside: str | None = None,
    fill: float | None = None,
    values: tuple[str, ...] = ("v",),
    lonlat: bool = True,
) -> DataFrame:
    """Cells in the window of each area, renumbered from the window's corner.

    `outside` decides about window cells the area does not cover: None leaves their values,
    "null" clears them, "fill" writes `fill` (a nodata number).
    """
    if _few(aois, rule, lonlat):
        marks = _inline_marks(cells, grids, aois, rule)
    else:
        marks = _span_marks(cells, areas_on_grids(grids, aois, lonlat), rule)

    def value(name):
        if outside is None:
            return F.col(name)
        kept = F.when(F.col("inside"), F.col(name))
        return kept if outside == "null" else kept.otherwise(F.lit(fill))

    r, c = F.col("r"), F.col("c")
    in_window = (c >= F.col("c0")) & (c < F.col("c1")) & (r >= F.col("r0")) & (r < F.col("r1"))
    return (
        marks.where(in_window)
        .withColumns({name: value(name) for name in values})
        .withColumn("r", (r - F.col("r0")).cast("int"))
        .withColumn("c", (c - F.col("c0")).cast("int"))
        .select(*cells.columns, "aoi_id")
    )
