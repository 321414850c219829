"""Pairs of overlapping boxes by cells whose depth follows the density of the boxes.

Of every pair the left box stays at home, in the one cell that holds its lower left corner, and the right one visits all cells
that can be home to a box that overlaps it. So a pair meets in exactly one cell, whatever the sizes are, and no
`distinct` is needed. Homes are sorted by extent into classes of powers of two; a visitor reaches as far left and down as
a box of the class can be large.

Depths come from counts: homes are counted once by class and finest cell, and each root cell of a class takes the
shallowest depth at which a home shares its cell with CROWD others at most, or the finest one. There are fewer roots than
ROOTS a class, so their depths are broadcast; dense regions get small cells and sparse ones few.

Longitudes run on beyond 180 for boxes across the antimeridian, and visitors come again a turn to either side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Degrees of a root cell; boxes from -540 to 900 degrees by -90 to 90, visitors' turns included, meet fewer than ROOTS of them.
ROOT, ROOTS = 8.0, 200 * 25
#: Homes that share a cell, in the mean over homes, before it is cut.
CROWD = 8
#: The finest cells are so much smaller than the extent of their class, and at most so many halvings of a root.
FINEST, DEEPEST = 8, 14
#: Extents of class k are at most LARGEST / 2^k degrees.
LARGEST, CLASSES = 1024.0, 20
TURN = 360.0


def overlap(a: Column, b: Column, turn: "Column | float" = 0.0) -> Column:
    """Whether box b, moved east by `turn` degrees, meets box a; touching counts."""
    turn = F.lit(turn) if isinstance(turn, float) else turn
    return (a["minx"] <= b["maxx"] + turn) & (a["maxx"] >= b["minx"] + turn) & (a["miny"] <= b["maxy"]) & (a["maxy"] >= b["miny"])


def ordered(bbox: Column) -> Column:
    """Whether a box has finite corners, the lower left one below and left of the upper right one."""
    finite = F.lit(True)
    for c in ("minx", "miny", "maxx", "maxy"):
        finite = finite & (F.abs(bbox[c]) <= 540.0)
    return F.coalesce(finite & (bbox["minx"] <= bbox["maxx"]) & (bbox["miny"] <= bbox["maxy"]), F.lit(False))


def _class(bbox: Column) -> Column:
    extent = F.greatest(bbox["maxx"] - bbox["minx"], bbox["maxy"] - bbox["miny"])
    return F.greatest(F.least(F.floor(F.log2(F.lit(LARGEST) / F.greatest(extent, F.lit(1e-9)))), F.lit(CLASSES)), F.lit(0)).cast("int")


def _extent(k: Column) -> Column:
    """The largest extent in a class; the last class has all smaller ones. A little more, for rounded logarithms."""
    return F.lit(LARGEST * (1 + 1e-9)) / F.pow(F.lit(2.0), k)


def _finest(k: Column, finest: int = FINEST) -> Column:
    """Depth of the cells of a class that are not cut any more."""
    halvings = F.ceil(F.log2(F.lit(ROOT * finest) / _extent(k)))
    return F.greatest(F.lit(0), F.least(F.lit(DEEPEST), halvings)).cast("int")


def _cell(x: Column, depth: "Column | int") -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.floor(x / F.lit(ROOT) * F.pow(F.lit(2.0), depth))


def depths(homes: DataFrame, finest: int = FINEST) -> DataFrame:
    """Depth of the cells of each root (class, rx, ry) that is home to a box (class, bbox)."""
    finest = _finest(F.col("class"), finest)
    fine = homes.select("class", finest.alias("finest"), _cell(F.col("bbox")["minx"], finest).alias("cx"), _cell(F.col("bbox")["miny"], finest).alias("cy"))
    fine = fine.groupBy("class", "finest", "cx", "cy").agg(F.count("*").alias("n"))
    at = fine.withColumn("depth", F.explode(F.sequence(F.lit(0), F.col("finest"))))
    up = lambda c, to: F.expr(f"shiftright({c}, finest - {to})")
    cells = at.groupBy("class", "finest", "depth", up("cx", 0).alias("rx"), up("cy", 0).alias("ry"), up("cx", "depth").alias("x"), up("cy", "depth").alias("y"))
    crowds = cells.agg(F.sum("n").alias("n")).groupBy("class", "finest", "depth", "rx", "ry").agg((F.sum(F.col("n").cast("double") * F.col("n")) / F.sum("n")).alias("crowd"))
    enough = F.min(F.when(F.col("crowd") <= CROWD, F.col("depth")))
    return crowds.groupBy("class", "rx", "ry").agg(F.coalesce(enough, F.max("finest")).alias("depth"))


def _visits(visitors: DataFrame, roots: DataFrame) -> DataFrame:
    """Visitors (columns kept, bbox) once for each cell (class, depth, cx, cy) that they ask, with the turn they have taken."""
    box = F.col("bbox")
    known = F.broadcast(roots.select("class").distinct())
    turned = visitors.withColumn("turn", F.explode(F.array(*[F.lit(t * TURN) for t in (-1, 0, 1)]))).join(known)
    reach = {"x0": box["minx"] + F.col("turn") - _extent(F.col("class")), "x1": box["maxx"] + F.col("turn"), "y0": box["miny"] - _extent(F.col("class")), "y1": box["maxy"]}
    asked = turned.withColumns(reach).withColumns({"x0": F.greatest("x0", F.lit(-540.0)), "y0": F.greatest("y0", F.lit(-540.0))}).where("x0 <= x1 AND y0 <= y1")
    asked = asked.withColumn("rx", F.explode(F.sequence(_cell(F.col("x0"), 0), _cell(F.col("x1"), 0))))
    asked = asked.withColumn("ry", F.explode(F.sequence(_cell(F.col("y0"), 0), _cell(F.col("y1"), 0))))
    met = asked.join(F.broadcast(roots), ["class", "rx", "ry"])
    for c, r in (("x", "rx"), ("y", "ry")):
        first, count = F.expr(f"shiftleft({r}, depth)"), F.expr("shiftleft(1L, depth)")
        low, high = F.greatest(first, _cell(F.col(f"{c}0"), F.col("depth"))), F.least(first + count - 1, _cell(F.col(f"{c}1"), F.col("depth")))
        met = met.withColumns({"low": low, "high": high}).where("low <= high").withColumn(f"c{c}", F.explode(F.sequence("low", "high"))).drop("low", "high")
    return met.drop("rx", "ry", "x0", "x1", "y0", "y1")


#: Columns that name a cell.
CELL = ["class", "depth", "cx", "cy"]


def in_cells(left: DataFrame, right: DataFrame, finest: int = FINEST) -> tuple[DataFrame, DataFrame]:
    """Left rows in the one cell (CELL) each is at home in, and right rows in all cells they visit, with the turn they have taken."""
    # Exploding a single value keeps a computed box from being written out again wherever a cell needs it.
    l, r = (df.withColumn("bbox", F.explode(F.array("bbox"))).where(ordered(F.col("bbox"))) for df in (left, right))
    homes = l.withColumn("class", _class(F.col("bbox")))
    roots = depths(homes, finest)
    at_home = homes.withColumns({"rx": _cell(F.col("bbox")["minx"], 0), "ry": _cell(F.col("bbox")["miny"], 0)}).join(F.broadcast(roots), ["class", "rx", "ry"])
    at_home = at_home.withColumns({"cx": _cell(F.col("bbox")["minx"], F.col("depth")), "cy": _cell(F.col("bbox")["miny"], F.col("depth"))})
    return at_home.select(*CELL, *left.columns), _visits(r, roots).select(*CELL, "turn", *right.columns)


def candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left and right rows (columns with l_ and r_ before their names) and the turn of the right one, of pairs that share a cell."""
    at_home, visits = in_cells(left, right)
    homes = at_home.select(*CELL, *[F.col(c).alias(f"l_{c}") for c in left.columns])
    visits = visits.select(*CELL, "turn", *[F.col(c).alias(f"r_{c}") for c in right.columns])
    # Spark does not count the cells when it estimates a side, so it is told to shuffle and sort; AQE splits crowded cells.
    return homes.join(visits.hint("merge"), CELL).drop(*CELL)


def met_in_cells(left: DataFrame, right: DataFrame, most: int, finest: int = 2) -> DataFrame:
    """Both inputs (id, bbox, then equal columns of right and the first ones of left) as one table, in partitions sorted by cell, visitors before homes.

    For tests that hold the visitors of a cell while its homes come by, so that no pair is ever shuffled. A cell of more than `most`
    homes or visitors is cut into a grid of parts (i, j): each home is in the parts of its i and each visitor in those of its j, so
    each pair still meets once. There are fewer crowded cells than rows / most; they are broadcast. Columns: CELL, i, j, kind (0 for a
    visitor), l_id, r_id, the box, turn and the other columns.
    """
    homes, visits = in_cells(left, right, finest)
    cut = {}
    for n, df in (("a", homes), ("b", visits)):
        cut[n] = F.broadcast(df.groupBy(*CELL).agg(F.count("*").alias("n")).where(F.col("n") > most).select(*CELL, F.ceil(F.col("n") / most).alias(n)))

    def parted(df, own, other, names):
        for n in "ab":
            df = df.join(cut[n], CELL, "left")
        many = lambda n: F.coalesce(F.col(n), F.lit(1).cast("long"))
        df = df.withColumn(names[0], F.pmod(F.xxhash64("id"), many(own))).withColumn(names[1], F.explode(F.sequence(F.lit(0).cast("long"), many(other) - 1)))
        return df.drop("a", "b")

    ids = {"l_id": left.schema["id"].dataType, "r_id": right.schema["id"].dataType}
    rest = [c for c in left.columns if c not in ("id", "bbox")]

    def side(df, kind, mine):
        id_of = [(F.col("id") if n == mine else F.lit(None)).cast(t).alias(n) for n, t in ids.items()]
        box = [F.col("bbox")[c].alias(c) for c in ("minx", "miny", "maxx", "maxy")]
        have = [F.col(c) if c in df.columns else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in rest]
        turn = F.col("turn") if "turn" in df.columns else F.lit(0.0)
        return df.select(*CELL, "i", "j", F.lit(kind).alias("kind"), *id_of, *box, turn.alias("turn"), *have)

    both = side(parted(visits, "b", "a", "ji"), 0, "r_id").unionByName(side(parted(homes, "a", "b", "ij"), 1, "l_id"))
    return both.repartition(*CELL, "i", "j").sortWithinPartitions(*CELL, "i", "j", "kind")


def pair_by_bbox(left: DataFrame, right: DataFrame) -> DataFrame:
    """All pairs with overlapping boxes, with their columns (l_*, r_*); every input needs a unique `id` and a lon/lat `bbox`.

    The left input stays at home and may be the wide one; rows of the right one are multiplied by the cells that they visit.
    A box that runs on beyond 180 degrees also meets others a turn away; a pair comes once, at the smallest turn. A box
    that is not `ordered` meets nothing here: callers report it.
    """
    lb, rb, turn = F.col("l_bbox"), F.col("r_bbox"), F.col("turn")
    around = (F.greatest(lb["maxx"], rb["maxx"]) > 180.0) | (F.least(lb["minx"], rb["minx"]) < -180.0)
    met = candidates(left, right).where(overlap(lb, rb, turn) & ((turn == 0) | around))
    # Boxes that meet at two turns are together wider than the globe.
    before = ((turn > -TURN) & around & overlap(lb, rb, -TURN)) | ((turn > 0) & overlap(lb, rb))
    return met.where(~before).drop("turn")
