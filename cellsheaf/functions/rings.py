"""Column expressions on ring arrays: bounds, text forms, point and edge tests."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def edges(rings: Column) -> Column:
    """All edges of all rings, as array<struct<x1,y1,x2,y2>>."""

    def of_ring(ring):
        pts = ring["pts"]
        return F.transform(
            F.slice(pts, F.lit(1), F.size(pts) - 1),
            lambda p, i: F.struct(
                p["x"].alias("x1"),
                p["y"].alias("y1"),
                F.get(pts, i + 1)["x"].alias("x2"),
                F.get(pts, i + 1)["y"].alias("y2"),
            ),
        )

    return F.flatten(F.transform(rings, of_ring))


def points(rings: Column) -> Column:
    return F.flatten(F.transform(rings, lambda g: g["pts"]))


def _bbox(pts: Column) -> Column:
    xs = F.transform(pts, lambda p: p["x"])
    ys = F.transform(pts, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("minx"),
        F.array_min(ys).alias("miny"),
        F.array_max(xs).alias("maxx"),
        F.array_max(ys).alias("maxy"),
    )


def bounds(rings: Column) -> Column:
    """Bounding box over every part."""
    return _bbox(points(rings))


def _jumps(edge_array: Column) -> Column:
    """Whether an edge goes the short way around the antimeridian; one of a whole turn goes around the globe."""
    return F.exists(edge_array, lambda e: (F.abs(e["x2"] - e["x1"]) > 180.0) & (F.abs(e["x2"] - e["x1"]) < 360.0))


def across(rings: Column) -> Column:
    """Whether a shape goes across the antimeridian: an edge jumps there, or parts are cut at both sides of it."""
    all_edges = edges(rings)
    cut = F.exists(all_edges, lambda e: e["x1"] == 180.0) & F.exists(all_edges, lambda e: e["x1"] == -180.0)
    around = F.exists(all_edges, lambda e: F.abs(e["x2"] - e["x1"]) > 180.0)
    # A planar box tells most shapes apart without a look at their edges.
    box = bounds(rings)
    return F.coalesce(F.when(box["maxx"] - box["minx"] > 180.0, _jumps(all_edges) | (cut & ~around)), F.lit(False))


def unwrapped(rings: Column) -> Column:
    """A shape across the antimeridian in longitudes that run on: western vertices move a turn east, but for parts that lie across longitude 0."""

    def stays(g):
        xs = F.transform(g["pts"], lambda p: p["x"])
        return (F.array_min(xs) < 0) & (F.array_max(xs) > 0) & ~_jumps(edges(F.array(g)))

    def moved(g):
        kept = F.exists(rings, lambda h: (h["part"] == g["part"]) & stays(h))
        pts = F.transform(g["pts"], lambda p: F.struct(F.when((p["x"] < 0) & ~kept, p["x"] + 360.0).otherwise(p["x"]).alias("x"), p["y"].alias("y")))
        return F.struct(g["part"].alias("part"), g["hole"].alias("hole"), pts.alias("pts"))

    return F.transform(rings, moved)


def ring_bbox(rings: Column) -> Column:
    """Bounding box of the exterior ring of the first part only."""
    return _bbox(F.get(F.filter(rings, lambda g: (g["part"] == 0) & ~g["hole"]), F.lit(0))["pts"])


def centre(bbox: Column) -> tuple[Column, Column]:
    return (bbox["minx"] + bbox["maxx"]) / F.lit(2.0), (bbox["miny"] + bbox["maxy"]) / F.lit(2.0)


def nwse(bbox: Column) -> Column:
    """North, west, south, east list, the order an area request uses."""
    return F.array(bbox["maxy"], bbox["minx"], bbox["miny"], bbox["maxx"])


def compass(bbox: Column) -> Column:
    return F.struct(
        bbox["minx"].alias("west"), bbox["miny"].alias("south"), bbox["maxx"].alias("east"), bbox["maxy"].alias("north")
    )


def bbox_list(bbox: Column) -> Column:
    return F.array(bbox["minx"], bbox["miny"], bbox["maxx"], bbox["maxy"])


def valid_type(geom_type: Column) -> Column:
    return F.coalesce(geom_type.isin("Polygon", "MultiPolygon"), F.lit(False))


def number_text(x: Column) -> Column:
    """Decimal text of a number as Spark casts it, with an exponent written out in digits and without trailing zeros; it reads back as the same number."""
    text = x.cast("string")
    # Casting writes an exponent below 1e-3 and from 1e7 on; such numbers are written out digit by digit.
    sign, mantissa, power = (F.regexp_extract(text, r"^(-?)([0-9.]+)E(-?[0-9]+)$", i) for i in (1, 2, 3))
    whole, part = F.substring_index(mantissa, ".", 1), F.substring_index(mantissa, ".", -1)
    n = power.cast("int")
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -n - 1), whole, part)
    large = F.concat(sign, whole, F.rpad(F.substring(part, F.lit(1), n), n, F.lit("0")), F.lit("."), F.substring(part, n + 1, F.length(part)))
    plain = F.when(F.contains(text, F.lit("E")), F.when(n < 0, small).otherwise(large)).otherwise(text)
    return F.regexp_replace(plain, r"\.?0*$", "")


def _nested_text(rings, open_, close, sep, point):
    n_parts = F.array_max(F.transform(rings, lambda g: g["part"]))

    def ring_text(ring):
        return F.concat(F.lit(open_), F.array_join(F.transform(ring["pts"], point), sep), F.lit(close))

    def part_text(p):
        own = F.filter(rings, lambda g: g["part"] == p)
        return F.concat(F.lit(open_), F.array_join(F.transform(own, ring_text), sep), F.lit(close))

    return F.transform(F.sequence(F.lit(0), n_parts), part_text)


def to_wkt(geom_type: Column, rings: Column) -> Column:
    parts = _nested_text(
        rings, "(", ")", ", ", lambda p: F.concat(number_text(p["x"]), F.lit(" "), number_text(p["y"]))
    )
    return F.when(geom_type == "Polygon", F.concat(F.lit("POLYGON "), F.get(parts, F.lit(0)))).when(
        geom_type == "MultiPolygon", F.concat(F.lit("MULTIPOLYGON ("), F.array_join(parts, ", "), F.lit(")"))
    )


def to_geojson(geom_type: Column, rings: Column) -> Column:
    """Canonical GeoJSON text: fixed key order, no spaces. Equal geometries give equal text."""
    parts = _nested_text(
        rings,
        "[",
        "]",
        ",",
        lambda p: F.concat(F.lit("["), number_text(p["x"]), F.lit(","), number_text(p["y"]), F.lit("]")),
    )
    coords = F.when(geom_type == "Polygon", F.get(parts, F.lit(0))).otherwise(
        F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]"))
    )
    return F.concat(F.lit('{"type":"'), geom_type, F.lit('","coordinates":'), coords, F.lit("}"))


def geometry_id(text: Column) -> Column:
    """Name-based UUID (version 5, URL namespace) of a geometry's text."""
    url_namespace = "6ba7b8119dad11d180b400c04fd430c8"  # fixed value of RFC 4122
    h = F.sha1(F.concat(F.unhex(F.lit(url_namespace)), F.encode(text, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    groups = [
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    ]
    return F.when(text.isNotNull(), F.concat_ws("-", *groups))


def crossing(e, y: Column) -> Column:
    """x where the line of edge e meets height y (NULL for a horizontal edge)."""
    return e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))


def point_inside(x: Column, y: Column, edge_array: Column) -> Column:
    """Half-open even-odd rule over all edges; holes and parts need no special case."""
    odd = F.aggregate(
        F.filter(edge_array, lambda e: (e["y1"] > y) != (e["y2"] > y)),
        F.lit(False),
        lambda acc, e: acc != F.coalesce(x < crossing(e, y), F.lit(False)),
    )
    return odd


def _turn(ax, ay, bx, by, cx, cy):
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def point_on_edge(x: Column, y: Column, edge_array: Column) -> Column:
    return F.exists(
        edge_array,
        lambda e: (_turn(e["x1"], e["y1"], e["x2"], e["y2"], x, y) == 0)
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])),
    )


def edges_in_box(edge_array: Column, bbox: Column) -> Column:
    """Edges whose own box meets bbox: the only ones that can touch something inside it."""
    return F.filter(
        edge_array,
        lambda e: (F.least(e["x1"], e["x2"]) <= bbox["maxx"])
        & (F.greatest(e["x1"], e["x2"]) >= bbox["minx"])
        & (F.least(e["y1"], e["y2"]) <= bbox["maxy"])
        & (F.greatest(e["y1"], e["y2"]) >= bbox["miny"]),
    )


def _straddle(e, f):
    d1 = _turn(e["x1"], e["y1"], e["x2"], e["y2"], f["x1"], f["y1"])
    d2 = _turn(e["x1"], e["y1"], e["x2"], e["y2"], f["x2"], f["y2"])
    d3 = _turn(f["x1"], f["y1"], f["x2"], f["y2"], e["x1"], e["y1"])
    d4 = _turn(f["x1"], f["y1"], f["x2"], f["y2"], e["x2"], e["y2"])
    return d1, d2, d3, d4


def edges_meet(a: Column, b: Column) -> Column:
    """True when some edge of a and some edge of b share a point (touching counts)."""

    def meet(e, f):
        d1, d2, d3, d4 = _straddle(e, f)
        boxes = (
            (F.least(e["x1"], e["x2"]) <= F.greatest(f["x1"], f["x2"]))
            & (F.least(f["x1"], f["x2"]) <= F.greatest(e["x1"], e["x2"]))
            & (F.least(e["y1"], e["y2"]) <= F.greatest(f["y1"], f["y2"]))
            & (F.least(f["y1"], f["y2"]) <= F.greatest(e["y1"], e["y2"]))
        )
        return boxes & (d1 * d2 <= 0) & (d3 * d4 <= 0)

    return F.exists(a, lambda e: F.exists(b, lambda f: meet(e, f)))


def edges_cross(a: Column, b: Column) -> Column:
    """True when some edge of a passes properly through some edge of b."""

    def cross(e, f):
        d1, d2, d3, d4 = _straddle(e, f)
        return (d1 * d2 < 0) & (d3 * d4 < 0)

    return F.exists(a, lambda e: F.exists(b, lambda f: cross(e, f)))


def outer_starts(rings: Column) -> Column:
    """First vertex of every exterior ring."""
    return F.transform(F.filter(rings, lambda g: ~g["hole"]), lambda g: F.get(g["pts"], F.lit(0)))
