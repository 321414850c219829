"""Areas of interest: GeoJSON geometries as ring arrays."""

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsheaf import registry, schemas


@dataclass(frozen=True)
class Aoi:
    aoi_id: str
    geom_type: str
    rings: tuple  # of (part, hole, ((x, y), ...))

    @property
    def edges(self) -> list[tuple[float, float, float, float]]:
        return [(*a, *b) for _, _, pts in self.rings for a, b in zip(pts, pts[1:])]

    @property
    def bounds(self) -> tuple[float, float, float, float]:
        xs = [x for _, _, pts in self.rings for x, _ in pts]
        ys = [y for _, _, pts in self.rings for _, y in pts]
        return min(xs), min(ys), max(xs), max(ys)

    @property
    def error(self) -> str | None:
        """Why every row of a request for this area fails; None for a polygon."""
        return None if self.rings and self.geom_type in ("Polygon", "MultiPolygon") else registry.NOT_A_POLYGON

    def box(self) -> "Aoi":
        """The bounding box as an area of the same id."""
        w, s, e, n = self.bounds
        return Aoi(self.aoi_id, "Polygon", ((0, False, ((w, s), (e, s), (e, n), (w, n), (w, s))),))


def from_geojson(aoi_id: str, geometry: dict) -> Aoi:
    """Read a GeoJSON geometry; a type other than (Multi)Polygon keeps no rings and fails G1's check."""
    kind, coords = geometry["type"], geometry.get("coordinates", [])
    parts = {"Polygon": [coords], "MultiPolygon": coords}.get(kind, [])
    rings = []
    for p, part in enumerate(parts):
        for h, ring in enumerate(part):
            pts = [(float(pt[0]), float(pt[1])) for pt in ring]
            if pts[0] != pts[-1]:
                pts.append(pts[0])
            rings.append((p, h > 0, tuple(pts)))
    return Aoi(aoi_id, kind, tuple(rings))


def frame(spark: SparkSession, aois: list[Aoi]) -> DataFrame:
    return spark.createDataFrame([(a.aoi_id, a.geom_type, list(a.rings)) for a in aois], schemas.AOI)


def column(aois: list[Aoi]) -> Column:
    """The areas as one array<struct<aoi_id,geom_type,rings>> constant, whatever their vertex count."""
    rows = [
        {
            "aoi_id": a.aoi_id,
            "geom_type": a.geom_type,
            "rings": [
                {"part": p, "hole": h, "pts": [{"x": x, "y": y} for x, y in pts]} for p, h, pts in a.rings
            ],
        }
        for a in aois
    ]
    return F.from_json(F.lit(json.dumps(rows)), f"array<{schemas.AOI.simpleString()}>")
