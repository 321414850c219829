"""Which scenes, rasters and areas of interest meet each other."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsheaf.aoi import Aoi
from cellsheaf.aoi import frame as aoi_frame
from cellsheaf.functions import rings
from cellsheaf.functions.outlines import Outlines, Pairs, _spread
from cellsheaf.operators import pairing

def bbox_intersects(df: DataFrame, west: float, south: float, east: float, north: float, bbox: str = "bbox"):
    """Four plain comparisons on bbox fields, which reach the parquet scan."""
    b = F.col(bbox)
    return df.where((b["minx"] <= east) & (b["maxx"] >= west) & (b["miny"] <= north) & (b["maxy"] >= south))


def rejected(df: DataFrame, key: str) -> DataFrame:
    """Rows (key, error) whose box cannot be placed; one across the antimeridian can. Pairing leaves them out, so a request reports them from here."""
    box = F.col("bbox") if "bbox" in df.columns else rings.bounds(F.col("rings"))
    text = F.lit("bounding box is absent, not finite or upside down")
    upright = F.struct(F.least(box["minx"], box["maxx"]).alias("minx"), box["miny"], F.greatest(box["minx"], box["maxx"]).alias("maxx"), box["maxy"])
    return df.where((box["minx"] + box["maxx"]).isNull() | ~pairing.ordered(upright)).select(key, text.alias("error"))


def _prepared(df: DataFrame, key: str) -> DataFrame:
    """Id, box and rings, in longitudes that run on beyond 180 degrees where a shape goes across the antimeridian."""
    shape = df.select(F.col(key).alias("id"), (F.col("bbox") if "bbox" in df.columns else rings.bounds(F.col("rings"))).alias("bbox"), "rings")
    across = F.coalesce(F.col("bbox")["minx"] > F.col("bbox")["maxx"], F.lit(False)) | rings.across(F.col("rings"))
    # Exploding single values keeps what is computed once from being written out again wherever it is used.
    shape = shape.withColumn("across", F.explode(F.array(across)))
    shape = shape.withColumn("rings", F.explode(F.array(F.when(F.col("across"), rings.unwrapped(F.col("rings"))).otherwise(F.col("rings")))))
    box = F.when(F.col("across"), rings.bounds(F.col("rings"))).otherwise(F.col("bbox"))
    return shape.select("id", box.alias("bbox"), "rings")


#: Sub-keys that an area's scenes are dealt to, so that an area that owns a third of all pairs does not land in one task.
COPIES = 32


def _exact(pairs: DataFrame, areas: DataFrame, contained: bool) -> DataFrame:
    """Pairs (scene_id, aoi_id, contained) that really meet, of pairs (l_id, l_bbox, l_rings, r_id, r_bbox) of boxes.

    An area's outline comes once before its pairs, not with each of them, and is prepared once there.
    """
    kinds = dict(pairs.dtypes)
    tested = pairs.select(
        F.col("r_id"), F.pmod(F.xxhash64("l_id"), F.lit(COPIES)).alias("sub"), F.lit(1).alias("kind"), F.col("l_id"), F.col("l_rings").alias("rings"),
        F.array(*[pairing.overlap(F.col("l_bbox"), F.col("r_bbox"), t * pairing.TURN) for t in (-1.0, 0.0, 1.0)]).alias("turns"),
    )
    outline = areas.select(
        F.col("id").alias("r_id"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(COPIES - 1).cast("long"))).alias("sub"), F.lit(0).alias("kind"),
        F.lit(None).cast(kinds["l_id"]).alias("l_id"), "rings", F.array(F.lit(False)).alias("turns"),
    )
    dealt = outline.unionByName(tested).repartition("r_id", "sub").sortWithinPartitions("r_id", "sub", "kind")

    def test(batches):
        area = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if area is not None:
                rows = pa.concat_tables([area, rows])
            rows = rows.combine_chunks()
            kind = rows.column("kind").to_numpy()
            latest = np.maximum.accumulate(np.where(kind == 0, np.arange(len(kind)), -1))
            i = np.flatnonzero(kind == 1)
            area = rows.slice(int(latest[-1]), 1)
            shapes = Outlines(rows.column("rings"))
            asked = np.array(rows.column("turns").take(pa.array(i)).to_pylist(), bool).reshape(-1, 3)
            met, inside = np.zeros(len(i), bool), np.zeros(len(i), bool)
            for k, turn in enumerate((-pairing.TURN, 0.0, pairing.TURN)):
                own = np.flatnonzero(asked[:, k])
                pair = Pairs(shapes, i[own], shapes, latest[i[own]], np.full(len(own), turn))
                hit = pair.meet()
                met[own[hit]] = True
                if contained:
                    own = own[hit]
                    inside[own[Pairs(shapes, i[own], shapes, latest[i[own]], np.full(len(own), turn)).covered()]] = True
            keep = pa.array(i[met])
            yield pa.RecordBatch.from_arrays(
                [rows.column("l_id").take(keep).combine_chunks(), rows.column("r_id").take(keep).combine_chunks(), pa.array(inside[met])], names=["scene_id", "aoi_id", "contained"]
            )

    return dealt.mapInArrow(test, f"scene_id {kinds['l_id']}, aoi_id {kinds['r_id']}, contained boolean")


#: Homes and visitors of a cell that meet in one part of it, pairs that are looked at together, and homes of a cell beside which each visitor is looked at alone.
MOST, AT_ONCE, CROWDED = 20_000, 16_000, 1500


def _met(shapes: Outlines, x0: np.ndarray, x1: np.ndarray, a: np.ndarray, b, t, contained: bool):
    """Homes a, visitor or visitors b and whether b covers a, of pairs whose boxes meet at turn t and whose outlines meet at any; a pair counts at its smallest turn only."""
    T = pairing.TURN

    def beside(turn):
        return (x0[a] <= x1[b] + turn) & (x1[a] >= x0[b] + turn)

    around = (np.maximum(x1[a], x1[b]) > 180.0) | (np.minimum(x0[a], x0[b]) < -180.0)
    if np.any(t) or around.any():
        keep = np.flatnonzero(((t == 0) | around) & ~((t > -T) & around & beside(-T)) & ~((t > 0) & beside(0.0)))
        a, b, t = a[keep], b[keep] if np.ndim(b) else b, t[keep] if np.ndim(t) else t
    met, inside = np.zeros(len(a), bool), np.zeros(len(a), bool)
    if len(a):
        west, east, first, last = x0[a].min(), x1[a].max(), np.min(x0[b]), np.max(x1[b])
        for turn in (-T, 0.0, T):
            if west > last + turn or east < first + turn:
                continue
            own = np.flatnonzero(beside(turn))
            pairs = Pairs(shapes, a[own], shapes, b[own] if np.ndim(b) else b, turn)
            if contained:
                hit, covered = pairs.meet(True)
                met[own] |= hit
                inside[own] |= covered
            else:
                met[own] |= pairs.meet()
    return a[met], b[met] if np.ndim(b) else np.full(np.count_nonzero(met), b), inside[met]


def _exact_in_cells(left: DataFrame, right: DataFrame, contained: bool, count: bool = False) -> DataFrame:
    """Pairs (scene_id, aoi_id, contained, and left's further columns) that really meet, of rows (id, bbox, rings); or with `count` scenes met (aoi_id, n), in parts.

    The conditions are those of pairing.pair_by_bbox() and then of _exact(), but boxes and outlines are tested where both rows meet in
    a cell: what is shuffled are scenes, once each, and areas, once for each cell they reach; a pair only leaves the task as a result,
    in a list of its area, or of its scene where that has further columns.
    """
    dealt = pairing.met_in_cells(left, right.where(F.col("rings").isNotNull()), MOST)
    carried = [c for c in left.columns if c not in ("id", "bbox", "rings")]
    key = [*pairing.CELL, "i", "j"]
    names = ["aoi_id", "n"] if count else ["scene_id", "aois", *carried] if carried else ["aoi_id", "contained", "scenes"]

    def lists(by, of):
        """Groups of pairs: the first of each, their members, and where they begin."""
        by = by.astype(np.uint16) if len(by) and by.max() < 1 << 16 else by
        order = np.argsort(by, kind="stable")
        by = by[order]
        starts = np.flatnonzero(np.append(True, by[1:] != by[:-1])) if len(by) else np.zeros(0, np.int64)
        return order[starts], of[order], pa.array(np.append(starts, len(by)).astype(np.int32))

    def result(rows, a, b, inside):
        take = lambda c, at: rows.column(c).take(pa.array(at)).combine_chunks()
        if count:
            named = rows.column("l_id").is_valid().to_numpy()
            n = np.bincount(b[named[a]], minlength=len(rows))
            own = np.flatnonzero(n)
            out = [take("r_id", own), pa.array(n[own])]
        elif carried:
            head, of, offsets = lists(a, b)
            out = [take("l_id", a[head]), pa.ListArray.from_arrays(offsets, take("r_id", of)), *[take(c, a[head]) for c in carried]]
        else:
            head, of, offsets = lists(b * 2 + inside, a)
            out = [take("r_id", b[head]), pa.array(inside[head]), pa.ListArray.from_arrays(offsets, take("l_id", of))]
        return pa.RecordBatch.from_arrays(out, names=names)

    def met_pairs(shapes, n, start, end, visitors):
        """Homes, visitors and whether these cover them, part by part."""
        x0, y0, x1, y1, turns = n
        homes = end - start - visitors
        alone = np.flatnonzero((homes >= CROWDED) & (visitors > 0))
        for cell in alone:
            first = start[cell] + visitors[cell]
            own = slice(first, end[cell])
            for b in range(start[cell], first):
                t = turns[b]
                a = np.flatnonzero((y0[own] <= y1[b]) & (y1[own] >= y0[b]) & (x0[own] <= x1[b] + t) & (x1[own] >= x0[b] + t)) + first
                if len(a):
                    yield _met(shapes, x0, x1, a, b, t, contained)
        visited = np.where(homes < CROWDED, visitors, 0)
        cell, home = _spread(start + visitors, np.where(visited > 0, homes, 0))
        cells = np.flatnonzero(visited)
        cell = np.repeat(cells, homes[cells])
        each = visited[cell]
        for part in np.split(np.arange(len(home)), np.flatnonzero(np.diff(np.cumsum(each) // AT_ONCE)) + 1):
            row, b = _spread(start[cell[part]], each[part])
            a = home[part][row]
            high = np.flatnonzero((y0[a] <= y1[b]) & (y1[a] >= y0[b]))
            a, b = a[high], b[high]
            t = turns[b]
            beside = np.flatnonzero((x0[a] <= x1[b] + t) & (x1[a] >= x0[b] + t))
            if len(beside):
                yield _met(shapes, x0, x1, a[beside], b[beside], t[beside], contained)

    def test(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = (rows if held is None else pa.concat_tables([held, rows])).combine_chunks()
            kind = rows.column("kind").to_numpy()
            if not len(kind):
                continue
            new = np.append(True, np.zeros(len(kind) - 1, bool))
            for c in key:
                k = rows.column(c).to_numpy()
                new[1:] |= k[1:] != k[:-1]
            start = np.flatnonzero(new)
            visitors = np.bincount((np.cumsum(new) - 1)[kind == 0], minlength=len(start))
            held = rows.slice(int(start[-1]), int(visitors[-1]))
            end = np.append(start[1:], len(kind))
            if not ((visitors > 0) & (end - start > visitors)).any():
                continue
            n = [rows.column(c).to_numpy() for c in ("minx", "miny", "maxx", "maxy", "turn")]
            found, many = [], 0
            for more in met_pairs(Outlines(rows.column("rings")), n, start, end, visitors):
                found.append(more)
                many += len(more[0])
                if many >= AT_ONCE:
                    yield result(rows, *map(np.concatenate, zip(*found)))
                    found, many = [], 0
            if many:
                yield result(rows, *map(np.concatenate, zip(*found)))

    kinds = dict(dealt.dtypes)
    if count:
        return dealt.mapInArrow(test, f"aoi_id {kinds['r_id']}, n long")
    if carried:
        out = dealt.mapInArrow(test, ", ".join([f"scene_id {kinds['l_id']}, aois array<{kinds['r_id']}>", *[f"`{c}` {kinds[c]}" for c in carried]]))
        return out.select("scene_id", F.explode("aois").alias("aoi_id"), *carried)
    out = dealt.mapInArrow(test, f"aoi_id {kinds['r_id']}, contained boolean, scenes array<{kinds['l_id']}>")
    return out.select(F.explode("scenes").alias("scene_id"), "aoi_id", "contained")


def _beside_given(left: DataFrame, right: DataFrame) -> DataFrame:
    """As pairing.pair_by_bbox() for the few areas that a request names: each scene's box is held against all of their boxes."""
    l = left.select(F.col("id").alias("l_id"), F.explode(F.array("bbox")).alias("l_bbox"), F.col("rings").alias("l_rings"))
    r = right.select(F.col("id").alias("r_id"), F.explode(F.array("bbox")).alias("r_bbox"))
    lb, rb = F.col("l_bbox"), F.col("r_bbox")
    around = F.greatest(lb["maxx"], rb["maxx"]) > 180.0
    meet = pairing.overlap(lb, rb) | (around & (pairing.overlap(lb, rb, -pairing.TURN) | pairing.overlap(lb, rb, pairing.TURN)))
    return l.where(pairing.ordered(lb)).join(F.broadcast(r.where(pairing.ordered(rb))), meet)


def _meeting(scenes: DataFrame, aois: "DataFrame | list[Aoi]", contained: bool, carry: DataFrame | None = None, count: bool = False) -> DataFrame:
    given = None
    if not isinstance(aois, DataFrame):
        # Heights of the few given areas reach the scan; longitudes may run on beyond 180 degrees.
        given = [a for a in aois if a.rings]
        if given:
            south, north = min(a.bounds[1] for a in given), max(a.bounds[3] for a in given)
            west, east = min(a.bounds[0] for a in given), max(a.bounds[2] for a in given)
            box = F.col("bbox") if "bbox" in scenes.columns else rings.bounds(F.col("rings"))
            beside = (box["minx"] <= east) & (box["maxx"] >= west)
            around = (box["minx"] > box["maxx"]) | (box["maxx"] > 180.0) | (box["maxx"] - box["minx"] > 180.0)
            scenes = scenes.where((box["miny"] <= north) & (box["maxy"] >= south))
            scenes = scenes if west <= -180.0 or east >= 180.0 else scenes.where(beside | around)
        aois = aoi_frame(scenes.sparkSession, given)
    left, right = _prepared(scenes, "scene_id"), _prepared(aois, "aoi_id")
    if carry is not None:
        own = F.struct(*[c for c in carry.columns if c != "scene_id"])
        left = left.join(carry.groupBy(F.col("scene_id").alias("id")).agg(F.collect_list(own).alias("_own")), "id").select("id", "bbox", "rings", "_own")
    if given is None:
        return _exact_in_cells(left, right, contained, count)
    return _exact(_beside_given(left, right), right.where(F.col("rings").isNotNull()), contained)


def intersects(scenes: DataFrame, aois: "DataFrame | list[Aoi]") -> DataFrame:
    """Pairs (scene_id, aoi_id) whose polygons share at least one point, also across the antimeridian; each pair once."""
    return _meeting(scenes, aois, False).select("scene_id", "aoi_id")


def scenes_met(scenes: DataFrame, aois: DataFrame) -> DataFrame:
    """Number (aoi_id, n) of scenes with an id that each area meets, of areas that meet any; pairs are counted where they meet."""
    return _meeting(scenes, aois, False, count=True).groupBy("aoi_id").agg(F.sum("n").alias("n"))


def found_scenes(scenes: DataFrame, aois: DataFrame, carry: DataFrame) -> DataFrame:
    """As intersects() joined with `carry` (scene_id and more) by scene_id, but its columns travel with the scenes, so no pair is shuffled."""
    met = _meeting(scenes, aois, False, carry).select("scene_id", "aoi_id", F.explode("_own").alias("_own"))
    return met.select("scene_id", "aoi_id", "_own.*")


def contained_footprints(scenes: DataFrame, aois: "DataFrame | list[Aoi]") -> DataFrame:
    """Intersecting pairs with `contained`: the area covers the whole footprint, so clipping can be skipped.

    An area that is cut at 180 degrees keeps its seam as an outline: a footprint across the seam counts as not contained and is clipped.
    """
    return _meeting(scenes, aois, True)
