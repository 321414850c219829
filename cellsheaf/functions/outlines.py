"""Exact tests of polygon outlines on Arrow batches, by numpy over the edges of all shapes of a batch.

The edges of a shape lie in their order along the rings, so runs of FAN edges are close together. Boxes of runs, and of
FAN runs, are prepared once a shape; a test looks at the edges of those runs only that its own box meets. An outline of
many vertices so costs little more than its runs.

Shapes of at most FEW edges need no search: the k-th edges of all of them are a row of a table, and all pairs of such
shapes are tested against one row after the other. Both ways use the same formulas in the same order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

FAN = 32
#: Edges up to which a shape is tested edge by edge.
FEW = 16
#: What boxes are widened by where a box alone decides, so that rounding in a test of edges cannot matter.
MARGIN = 1e-9
#: Queries that are followed at a time.
AT_ONCE = 50_000
_EVERYWHERE = np.inf


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and member of each member of the ranges that begin at `first`."""
    row = np.repeat(np.arange(len(first)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]


def _boxes(low: np.ndarray, high: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Boxes of every FAN members of each shape, and where each shape's begin."""
    count = -(-np.diff(first) // FAN)
    row, k = _spread(np.zeros(len(count), np.int64), count)
    if not len(row):
        return np.zeros((0, 2)), np.zeros((0, 2)), np.zeros(len(first), np.int64)
    starts = first[row] + k * FAN
    return np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), np.append(0, np.cumsum(count))


def _places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of what is true in a mask of few rows."""
    flat = np.flatnonzero(mask)
    rows, width = mask.shape
    k = np.repeat(np.arange(rows), np.diff(np.searchsorted(flat, np.arange(rows + 1) * width)))
    return k, flat - k * width


class _Table:
    """The k-th edges of all shapes of few edges, k by k, NaN where a shape has fewer: no comparison with these holds."""

    def __init__(self, shapes: "Outlines", few: np.ndarray):
        self.count = np.where(few, np.diff(shapes.first), 0)
        self.starts_count = np.where(few, np.diff(shapes.start_first), 0)

        def rows(values, first, count):
            table = np.full((int(count.max(initial=0)), len(count)), np.nan)
            shape, member = _spread(first[:-1], count)
            table[member - first[shape], shape] = values[member]
            return table

        e = shapes.edges
        edge = lambda values: rows(values, shapes.first, self.count)
        self.x1, self.y1, self.x2, self.y2 = (edge(e[:, c]) for c in range(4))
        self.dx, self.dy = self.x2 - self.x1, self.y2 - self.y1
        self.low_x, self.low_y, self.high_x, self.high_y = (edge(v) for v in (*shapes.low.T, *shapes.high.T))
        self.start_x, self.start_y = (rows(v, shapes.start_first, self.starts_count) for v in shapes.starts.T)
        least = lambda v: np.fmin.reduce(v, axis=0, initial=np.inf)
        most = lambda v: np.fmax.reduce(v, axis=0, initial=-np.inf)
        self.box = least(self.low_x), least(self.low_y), most(self.high_x), most(self.high_y)

    def many(self, s) -> int:
        """Edges of a shape, or the most of several."""
        return int(self.count[s].max(initial=0)) if np.ndim(s) else int(self.count[s])

    def many_starts(self, s) -> int:
        return int(self.starts_count[s].max(initial=0)) if np.ndim(s) else int(self.starts_count[s])

    def of(self, s, *names: str) -> list[np.ndarray]:
        """Tables of the edges of one or several shapes, an edge a row."""
        n = self.many(s)
        return [getattr(self, c)[:n].take(s, 1) if np.ndim(s) else getattr(self, c)[:n, s, None] for c in names]

    def inside(self, s, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """As Outlines.inside(): a point for each shape, or many for one."""
        y1, y2 = self.of(s, "y1", "y2")
        k, p = _places((y1 > y) != (y2 > y))
        own, x, y, n = (k, _of(s, p)), x[p], y[p], len(x)
        hit = (self.high_x[own] >= x) & (x < self.x1[own] + (y - self.y1[own]) * self.dx[own] / self.dy[own])
        return np.bincount(p[hit], minlength=n) % 2 == 1

    def on_edge(self, s, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        k, p = _places(self.beside(s, x, y, x, y))
        own = (k, _of(s, p))
        on = self.dx[own] * (y[p] - self.y1[own]) - self.dy[own] * (x[p] - self.x1[own]) == 0
        return np.bincount(p[on], minlength=len(x)) > 0

    def beside(self, s, x0, y0, x1, y1) -> np.ndarray:
        """Whether the box of each edge meets another box."""
        low_x, low_y, high_x, high_y = self.of(s, "low_x", "low_y", "high_x", "high_y")
        return (low_x <= x1) & (high_x >= x0) & (low_y <= y1) & (high_y >= y0)


class Outlines:
    """Edges (x1, y1, x2, y2) of a column of shapes, array<struct<part, hole, pts>>, and the first vertex of each outer ring."""

    def __init__(self, rings: pa.ListArray):
        rings = rings.combine_chunks() if isinstance(rings, pa.ChunkedArray) else rings
        shape = np.append(0, np.cumsum(rings.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))).astype(np.int64)
        ring = rings.flatten()
        points = ring.field("pts")
        size = points.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = points.flatten()
        xy = np.stack([flat.field(c).to_numpy(zero_copy_only=False) for c in "xy"], axis=1).astype(np.float64).reshape(-1, 2)
        at = np.append(0, np.cumsum(size))
        _, start = _spread(at[:-1], np.maximum(size - 1, 0))
        self.edges = np.concatenate([xy[start], xy[start + 1]], axis=1) if len(start) else np.zeros((0, 4))
        self.first = np.append(0, np.cumsum(np.maximum(size - 1, 0)))[shape]
        outer = ~ring.field("hole").fill_null(False).to_numpy(zero_copy_only=False) & (size > 0)
        self.starts = xy[at[:-1][outer]]
        self.start_first = np.append(0, np.cumsum(outer))[shape]
        self.low, self.high = np.minimum(self.edges[:, :2], self.edges[:, 2:]), np.maximum(self.edges[:, :2], self.edges[:, 2:])
        self.run_low, self.run_high, self.run_first = _boxes(self.low, self.high, self.first)
        self.top_low, self.top_high, self.top_first = _boxes(self.run_low, self.run_high, self.run_first)
        # Few edges, all of closed rings without gaps.
        count = np.diff(self.first)
        whole = size >= 2
        whole[whole] = (xy[at[:-1][whole]] == xy[at[1:][whole] - 1]).all(1)
        odd = np.append(0, np.cumsum(~whole))[shape]
        broken = np.append(0, np.cumsum(~np.isfinite(self.edges).all(1)))[self.first]
        self.few = (count > 0) & (count <= FEW) & (np.diff(odd) == 0) & (np.diff(broken) == 0)
        self.table = _Table(self, self.few)

    def edges_of(self, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in `shape` and edge, for all edges of these shapes."""
        return _spread(self.first[shape], self.first[shape + 1] - self.first[shape])

    def starts_of(self, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _spread(self.start_first[shape], self.start_first[shape + 1] - self.start_first[shape])

    def near(self, shape: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Query and edge, part by part, for the edges of each query's shape whose box meets the query's."""
        for at in range(0, len(shape), AT_ONCE):
            s, a, b = shape[at : at + AT_ONCE], low[at : at + AT_ONCE], high[at : at + AT_ONCE]
            query, member = _spread(self.top_first[s], self.top_first[s + 1] - self.top_first[s])
            for lows, highs, first, below in (
                (self.top_low, self.top_high, self.top_first, self.run_first),
                (self.run_low, self.run_high, self.run_first, self.first),
            ):
                meets = (lows[member] <= b[query]).all(1) & (highs[member] >= a[query]).all(1)
                query, member = query[meets], member[meets]
                own = s[query]
                begin = below[own] + (member - first[own]) * FAN
                row, member = _spread(begin, np.minimum(begin + FAN, below[own + 1]) - begin)
                query = query[row]
            meets = (self.low[member] <= b[query]).all(1) & (self.high[member] >= a[query]).all(1)
            yield query[meets] + at, member[meets]

    def inside(self, shape: np.ndarray, xy: np.ndarray) -> np.ndarray:
        """Half-open even-odd rule, as rings.point_inside: whether each point lies in its shape."""
        odd = np.zeros(len(shape), bool)
        for query, edge in self.near(shape, xy, np.stack([np.full(len(xy), _EVERYWHERE), xy[:, 1]], axis=1)):
            x1, y1, x2, y2 = self.edges[edge].T
            x, y = xy[query].T
            over = (y1 > y) != (y2 > y)
            query, x1, y1, x2, y2, x, y = (v[over] for v in (query, x1, y1, x2, y2, x, y))
            hit = x < x1 + (y - y1) * (x2 - x1) / (y2 - y1)
            odd ^= np.bincount(query[hit], minlength=len(shape)) % 2 == 1
        return odd

    def on_edge(self, shape: np.ndarray, xy: np.ndarray) -> np.ndarray:
        on = np.zeros(len(shape), bool)
        for query, edge in self.near(shape, xy, xy):
            x1, y1, x2, y2 = self.edges[edge].T
            x, y = xy[query].T
            on[query[(x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) == 0]] = True
        return on


def _turns(e: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """On which sides of edge e the ends of f lie, and the other way round, as products."""

    def side(a, x, y):
        return (a[2] - a[0]) * (y - a[1]) - (a[3] - a[1]) * (x - a[0])

    return side(e, f[0], f[1]) * side(e, f[2], f[3]), side(f, e[0], e[1]) * side(f, e[2], e[3])


def _of(s, rows: np.ndarray):
    """Shapes, or turns, of some rows: all rows may share one."""
    return s[rows] if np.ndim(s) else s


class _FewEdges:
    """Pairs of shapes of few edges: tables a and b, shapes i of a, shape or shapes j of b, and turns."""

    def __init__(self, a: _Table, i: np.ndarray, b: _Table, j, turn):
        self.a, self.i, self.b, self.j, self.turn = a, i, b, j, turn

    def some(self, rows: np.ndarray) -> "_FewEdges":
        return _FewEdges(self.a, self.i[rows], self.b, _of(self.j, rows), _of(self.turn, rows))

    def box(self, margin: float = 0.0):
        """Boxes of the shapes of a as b sees them, widened."""
        x0, y0, x1, y1 = (v[self.i] for v in self.a.box)
        return x0 - self.turn - margin, y0 - margin, x1 - self.turn + margin, y1 + margin

    def _edge_pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows and the two products of turns, of pairs of edges whose boxes meet."""
        a, b = self.a, self.b
        k, row = _places(b.beside(self.j, *self.box(MARGIN)))
        i, j, turn = self.i[row], _of(self.j, row), _of(self.turn, row)
        # The shape of more edges keeps its place.
        moves_a = a.count[i] <= b.count[j]
        shift_a, shift_b = np.where(moves_a, -turn, 0.0), np.where(moves_a, 0.0, turn)
        x1, y1, x2, y2 = b.x1[k, j] + shift_b, b.y1[k, j], b.x2[k, j] + shift_b, b.y2[k, j]
        low, high = np.minimum(x1, x2), np.maximum(x1, x2)
        m, near = _places(a.beside(i, low - shift_a - MARGIN, b.low_y[k, j], high - shift_a + MARGIN, b.high_y[k, j]))
        own, shift = (m, i[near]), shift_a[near]
        u1, v1, u2, v2 = a.x1[own] + shift, a.y1[own], a.x2[own] + shift, a.y2[own]
        meets = (np.minimum(u1, u2) <= high[near]) & (np.maximum(u1, u2) >= low[near])
        e, f = np.stack([u1, v1, u2, v2])[:, meets], np.stack([x1, y1, x2, y2])[:, near[meets]]
        return (row[near[meets]], *_turns(e, f))

    def meet(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether two shapes share a point, and whether no edge of b comes near the box of a: then b covers a, or has nothing of it."""
        near = self.b.beside(self.j, *self.box(MARGIN)).any(0)
        found = np.zeros(len(self.i), bool)
        for k in range(min(self.a.many_starts(self.i), 1)):
            found = self.b.inside(self.j, self.a.start_x[k][self.i] - self.turn, self.a.start_y[k][self.i])
        rows = np.flatnonzero(near & ~found)
        rest = self.some(rows)
        for k in range(1, rest.a.many_starts(rest.i)):
            found[rows] |= rest.b.inside(rest.j, rest.a.start_x[k][rest.i] - rest.turn, rest.a.start_y[k][rest.i])
        for k in range(rest.b.many_starts(rest.j)):
            x = np.broadcast_to(rest.b.start_x[k][rest.j] + rest.turn, len(rows))
            found[rows] |= rest.a.inside(rest.i, x, np.broadcast_to(rest.b.start_y[k][rest.j], len(rows)))
        rows = rows[~found[rows]]
        own, one, two = self.some(rows)._edge_pairs()
        found[rows[own[(one <= 0) & (two <= 0)]]] = True
        return found, ~near

    def covered(self) -> np.ndarray:
        """Whether shape b covers the whole of shape a."""
        x0, y0, x1, y1 = self.box()
        u0, v0, u1, v1 = (v[self.j] for v in self.b.box)
        ok = (x0 >= u0 - MARGIN) & (y0 >= v0 - MARGIN) & (x1 <= u1 + MARGIN) & (y1 <= v1 + MARGIN)
        for k in range(self.a.many(self.i)):
            for middle in (False, True):
                rows = np.flatnonzero(ok)
                part = self.some(rows)
                x, y = part.a.x1[k][part.i], part.a.y1[k][part.i]
                if middle:
                    x, y = (x + part.a.x2[k][part.i]) / 2.0, (y + part.a.y2[k][part.i]) / 2.0
                x = x - part.turn
                out = ~part.b.inside(part.j, x, y) & ~np.isnan(x)
                at = np.flatnonzero(out)
                out[at] = ~part.b.on_edge(_of(part.j, at), x[at], y[at])
                ok[rows[out]] = False
        rows = np.flatnonzero(ok)
        own, one, two = self.some(rows)._edge_pairs()
        ok[rows[own[(one < 0) & (two < 0)]]] = False
        # No point of b's outline lies strictly in a.
        rows = np.flatnonzero(ok)
        part = self.some(rows)
        k, own = _places(part.b.beside(part.j, *part.box()))
        one = part.some(own)
        for middle in (False, True):
            x, y = one.b.x1[k, one.j], one.b.y1[k, one.j]
            if middle:
                x, y = (x + one.b.x2[k, one.j]) / 2.0, (y + one.b.y2[k, one.j]) / 2.0
            x = x + one.turn
            within = one.a.inside(one.i, x, y)
            at = np.flatnonzero(within)
            within[at] = ~one.a.on_edge(one.i[at], x[at], y[at])
            ok[rows[own[within]]] = False
        return ok


class Pairs:
    """Shapes a[i] against shapes b[j]; the shapes of b are moved east by `turn` degrees a pair. All pairs may share one j and one turn."""

    def __init__(self, a: Outlines, i: np.ndarray, b: Outlines, j: "np.ndarray | int", turn: "np.ndarray | float"):
        few = a.few[i] & b.few[j]
        self.few, self.rest = np.flatnonzero(few), np.flatnonzero(~few)
        self.few_edges = _FewEdges(a.table, i[self.few], b.table, _of(j, self.few), _of(turn, self.few))
        many = [np.broadcast_to(v, len(i))[self.rest] for v in (j, turn)]
        self.many_edges = _ManyEdges(a, i[self.rest], b, *many)

    @np.errstate(divide="ignore", invalid="ignore")
    def meet(self, covered: bool = False) -> "np.ndarray | tuple[np.ndarray, np.ndarray]":
        """Whether two shapes share a point, touching counts; with `covered` also whether they do and b covers the whole of a."""
        found = np.zeros(len(self.few) + len(self.rest), bool)
        found[self.few], alone = self.few_edges.meet()
        if len(self.rest):
            found[self.rest] = self.many_edges.meet()
        if not covered:
            return found
        inside = np.zeros(len(found), bool)
        inside[self.few] = found[self.few] & alone
        rows = np.flatnonzero(found[self.few] & ~alone)
        inside[self.few[rows]] = self.few_edges.some(rows).covered()
        if len(self.rest):
            rows = np.flatnonzero(found[self.rest])
            inside[self.rest[rows]] = self.many_edges.some(rows).covered()
        return found, inside

    @np.errstate(divide="ignore", invalid="ignore")
    def covered(self) -> np.ndarray:
        """Whether shape b covers the whole of shape a."""
        ok = np.zeros(len(self.few) + len(self.rest), bool)
        ok[self.few] = self.few_edges.covered()
        if len(self.rest):
            ok[self.rest] = self.many_edges.covered()
        return ok


class _ManyEdges:
    """Pairs of shapes of any number of edges, by the boxes of their runs."""

    def __init__(self, a: Outlines, i: np.ndarray, b: Outlines, j: np.ndarray, turn: np.ndarray):
        self.a, self.i, self.b, self.j, self.turn = a, i, b, j, turn

    def some(self, rows: np.ndarray) -> "_ManyEdges":
        return _ManyEdges(self.a, self.i[rows], self.b, self.j[rows], self.turn[rows])

    def _seen_from_b(self, row: np.ndarray, xy: np.ndarray) -> np.ndarray:
        return xy - np.stack([self.turn[row], np.zeros(len(row))], axis=1)

    def _edge_tests(self, rows: np.ndarray):
        """Row and the two products of turns, for pairs of edges whose boxes meet."""
        # The shape of fewer edges asks the other one.
        few = np.diff(self.a.first)[self.i[rows]] <= np.diff(self.b.first)[self.j[rows]]
        for own, asks, i, tells, j, sign in ((rows[few], self.a, self.i, self.b, self.j, -1.0), (rows[~few], self.b, self.j, self.a, self.i, 1.0)):
            k, edge = asks.edges_of(i[own])
            shift = sign * self.turn[own][k]
            move = np.stack([shift, np.zeros(len(k)), shift, np.zeros(len(k))], axis=1)
            e = asks.edges[edge] + move
            for query, other in tells.near(j[own][k], asks.low[edge] + move[:, :2], asks.high[edge] + move[:, :2]):
                yield (own[k[query]], *_turns(e[query].T, tells.edges[other].T))

    def meet(self) -> np.ndarray:
        """Whether two shapes share a point; touching counts."""
        found = np.zeros(len(self.i), bool)
        row, start = self.a.starts_of(self.i)
        inside = self.b.inside(self.j[row], self._seen_from_b(row, self.a.starts[start]))
        found[row[inside]] = True
        rest = np.flatnonzero(~found)
        row, start = self.b.starts_of(self.j[rest])
        row = rest[row]
        xy = self.b.starts[start] + np.stack([self.turn[row], np.zeros(len(row))], axis=1)
        found[row[self.a.inside(self.i[row], xy)]] = True
        for row, one, two in self._edge_tests(np.flatnonzero(~found)):
            found[row[(one <= 0) & (two <= 0)]] = True
        return found

    def covered(self) -> np.ndarray:
        """Whether shape b covers the whole of shape a."""
        ok = np.ones(len(self.i), bool)
        row, edge = self.a.edges_of(self.i)
        e = self.a.edges[edge]
        for xy in (e[:, :2], (e[:, :2] + e[:, 2:]) / 2.0):
            at = self._seen_from_b(row, xy)
            out = ~self.b.inside(self.j[row], at)
            out[out] = ~self.b.on_edge(self.j[row][out], at[out])
            ok[row[out]] = False
        for row, one, two in self._edge_tests(np.flatnonzero(ok)):
            ok[row[(one < 0) & (two < 0)]] = False
        # No point of b's outline lies strictly in a.
        left = np.flatnonzero(ok & (np.diff(self.a.first)[self.i] > 0))
        tops = self.a.first[self.i[left]]
        low = np.array([self.a.low[s : s + n].min(0) for s, n in zip(tops, np.diff(self.a.first)[self.i[left]])]).reshape(-1, 2)
        high = np.array([self.a.high[s : s + n].max(0) for s, n in zip(tops, np.diff(self.a.first)[self.i[left]])]).reshape(-1, 2)
        for query, other in self.b.near(self.j[left], self._seen_from_b(left, low), self._seen_from_b(left, high)):
            row = left[query]
            f = self.b.edges[other]
            for xy in (f[:, :2], (f[:, :2] + f[:, 2:]) / 2.0):
                xy = xy + np.stack([self.turn[row], np.zeros(len(row))], axis=1)
                within = self.a.inside(self.i[row], xy)
                within[within] = ~self.a.on_edge(self.i[row][within], xy[within])
                ok[row[within]] = False
        return ok
