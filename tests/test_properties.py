"""Properties, published check points and edge cases."""

import math
import random
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cellsheaf import aoi as aoi_mod
from cellsheaf import registry
from cellsheaf.functions import instants, names, projections, rings
from cellsheaf.operators import catalog, cells, clip, files, manifest, pairing, resample, skew, slots, spatial, swath
from cellsheaf.plans import archives
from cellsheaf.sources import files as file_source
from cellsheaf.sources import catalogues, tables

SQUARE = {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]}


def grid(spark, w=8, h=6, dx=0.5, dy=-0.5, x0=0.0, y0=3.0, epsg=4326, nodata=-1.0):
    return spark.createDataFrame(
        [("g", epsg, x0, y0, dx, dy, w, h, nodata)],
        "raster_id string, epsg int, x0 double, y0 double, dx double, dy double, width int, height int, nodata double",
    )


def raster(spark, w=8, h=6, value="r * 100.0 + c"):
    return spark.range(w * h).selectExpr("'g' raster_id", "'b' band", f"cast(id div {w} as int) r", f"cast(id % {w} as int) c").withColumn(
        "v", F.expr(f"cast({value} as double)")
    )


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_projection_check_points(spark):
    one = spark.range(1)
    x, y = projections.laea_europe(F.lit(5.0), F.lit(50.0))
    r = one.select(x, y).first()
    assert r[0] == pytest.approx(3962799.45, abs=0.01) and r[1] == pytest.approx(2999718.85, abs=0.01)
    clarke = (6378206.4, 294.978698214)
    x, y = projections.transverse_mercator(F.lit(-73.5), F.lit(40.5), F.lit(-75.0), clarke)
    r = one.select(x, y).first()
    assert r[0] == pytest.approx(627106.5, abs=0.1) and r[1] == pytest.approx(4484124.4, abs=0.1)
    x, y = projections.utm(F.lit(9.5), F.lit(48.5), F.lit(32632))
    r = one.select(x, y).first()
    assert r[0] == pytest.approx(536935.869, abs=1e-3) and r[1] == pytest.approx(5371996.282, abs=1e-3)
    assert one.select(projections.utm_epsg(F.lit(180.0), F.lit(-1.0))).first()[0] == 32760


def test_geometry_id_is_uuid5(spark):
    text = '{"type":"Polygon","coordinates":[]}'
    got = spark.range(1).select(rings.geometry_id(F.lit(text))).first()[0]
    assert got == str(uuid.uuid5(uuid.NAMESPACE_URL, text))


def test_month_count_and_inverted_frame(spark):
    df = spark.createDataFrame(
        [(1, datetime(2020, 11, 30), datetime(2021, 2, 1)), (2, datetime(2021, 5, 1), datetime(2021, 4, 1))],
        "id int, start timestamp_ntz, end timestamp_ntz",
    )
    got = rows(slots.month_slots(df), "id", "year", "month")
    assert got == [(1, 2020, 11), (1, 2020, 12), (1, 2021, 1), (1, 2021, 2)]
    stamps = slots.month_slots(df).where(instants.slot_stamp(F.col("year"), F.col("month")) == F.col("slot_start"))
    assert stamps.count() == 4
    years = slots.year_slots(df).where(instants.slot_stamp(F.col("year")) == F.col("slot_start"))
    assert rows(years, "id", "year") == [(1, 2020), (1, 2021), (2, 2021)]


def test_parse_iso_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2021-03-14T02:30:00Z",), ("2021-03-14T02:30:00",), ("nope",)], "s string")
        got = [r[0] for r in df.select(instants.stamp(instants.parse_iso(F.col("s")))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["20210314T023000", "20210314T023000", None]


@pytest.mark.parametrize("rule", ["centre", "touched"])
def test_both_clip_plans_agree(spark, rule):
    tri = aoi_mod.from_geojson("t", {"type": "Polygon", "coordinates": [[[0.3, 0.2], [3.7, 0.9], [1.1, 2.8], [0.3, 0.2]]]})
    inline = clip.clip(raster(spark), grid(spark), [tri], rule)
    spans = clip.clip(raster(spark), grid(spark), aoi_mod.frame(spark, [tri]), rule)
    assert rows(inline, "r", "c") == rows(spans, "r", "c") != []


def test_touched_covers_centre_and_tiny_area(spark):
    tiny = aoi_mod.from_geojson("t", {"type": "Polygon", "coordinates": [[[0.6, 0.6], [0.7, 0.6], [0.7, 0.7], [0.6, 0.6]]]})
    assert rows(clip.clip(raster(spark), grid(spark), [tiny], "centre"), "r", "c") == []
    assert rows(clip.clip(raster(spark), grid(spark), [tiny], "touched"), "r", "c") == [(4, 1)]
    table = aoi_mod.frame(spark, [tiny])
    assert rows(clip.clip(raster(spark), grid(spark), table, "touched"), "r", "c") == [(4, 1)]


def test_covering_area_keeps_every_pixel(spark):
    big = aoi_mod.from_geojson("b", {"type": "Polygon", "coordinates": [[[-9, -9], [9, -9], [9, 9], [-9, 9], [-9, -9]]]})
    for aois in ([big], aoi_mod.frame(spark, [big])):
        assert clip.clip(raster(spark), grid(spark), aois).count() == 48


def test_clip_projects_area_to_raster_crs(spark):
    """An area around 10 E 52 N on a metric raster centred there."""
    g = grid(spark, 10, 10, 1000.0, -1000.0, 4316000.0, 3215000.0, 3035)
    area = aoi_mod.from_geojson("e", {"type": "Polygon", "coordinates": [[[9.99, 51.99], [10.01, 51.99], [10.01, 52.01], [9.99, 52.01], [9.99, 51.99]]]})
    kept = rows(clip.clip(raster(spark, 10, 10), g, [area], "touched", lonlat=False), "r", "c")
    assert kept == [(r, c) for r in (3, 4, 5, 6) for c in (4, 5)]


def test_average_keeps_mass_and_identity(spark):
    g = grid(spark)
    same = resample.downsample_average(raster(spark), g, g)
    assert rows(same, "r", "c", "v") == rows(raster(spark), "r", "c", "v")
    target = resample.target_grid(g, 0.8)
    t = target.first()
    assert (t["width"], t["height"]) == (5, 3)
    total = resample.downsample_average(raster(spark), g, target).agg(F.sum("v")).first()[0]
    assert total * 48 / 15 == pytest.approx(raster(spark).agg(F.sum("v")).first()[0])


def test_average_ignores_null(spark):
    g = grid(spark)
    holes = raster(spark).withColumn("v", F.when(F.col("c") % 2 == 0, F.lit(3.0)))
    out = resample.downsample_average(holes, g, resample.target_grid(g, 1.0))
    assert {r["v"] for r in out.collect()} == {3.0}


def test_bilinear_of_constant_is_constant(spark):
    up = resample.upsample_bilinear(raster(spark, value="7"), grid(spark), grid(spark, 20, 13))
    values = [r["v"] for r in up.collect()]
    assert len(values) == 260 and values == pytest.approx([7.0] * 260, abs=1e-12)


def test_intersects_is_symmetric(spark):
    shapes = [
        aoi_mod.from_geojson(str(i), {"type": "Polygon", "coordinates": [[[x, y], [x + w, y], [x + w, y + w], [x, y + w], [x, y]]]})
        for i, (x, y, w) in enumerate([(0, 0, 4), (1, 1, 1), (4, 4, 1), (5.1, 0, 2), (-60, -60, 100), (30, 30, 0.5)])
    ]
    df = aoi_mod.frame(spark, shapes)
    got = spatial.intersects(df.withColumnRenamed("aoi_id", "scene_id"), df)
    pairs = set(rows(got, "scene_id", "aoi_id"))
    assert pairs == {(b, a) for a, b in pairs}
    assert ("0", "2") in pairs and ("0", "1") in pairs and ("0", "3") not in pairs and ("4", "5") in pairs
    inside = spatial.contained_footprints(df.withColumnRenamed("aoi_id", "scene_id"), df).where("contained")
    assert {("1", "0"), ("0", "4"), ("5", "4"), ("0", "0")} <= set(rows(inside, "scene_id", "aoi_id"))
    assert ("0", "1") not in set(rows(inside, "scene_id", "aoi_id"))


def test_hole_is_not_contained(spark):
    ring = aoi_mod.from_geojson("h", {"type": "Polygon", "coordinates": [
        [[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]], [[4, 4], [4, 5], [5, 5], [5, 4], [4, 4]]]})
    scenes = aoi_mod.frame(spark, [
        aoi_mod.from_geojson("around", {"type": "Polygon", "coordinates": [[[3, 3], [6, 3], [6, 6], [3, 6], [3, 3]]]}),
        aoi_mod.from_geojson("beside", {"type": "Polygon", "coordinates": [[[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]]}),
        aoi_mod.from_geojson("inhole", {"type": "Polygon", "coordinates": [[[4.2, 4.2], [4.8, 4.2], [4.8, 4.8], [4.2, 4.2]]]}),
    ]).withColumnRenamed("aoi_id", "scene_id")
    got = spatial.contained_footprints(scenes, [ring])
    assert rows(got, "scene_id", "contained") == [("around", False), ("beside", True)]


def test_first_step_is_one_time_for_the_raster(spark):
    df = spark.createDataFrame([("s", "a", 1, 0, 0, 1.0), ("s", "a", 2, 0, 0, 2.0), ("s", "a", 2, 0, 1, 3.0)], "source string, var string, t int, r int, c int, v double")
    assert rows(slots.first_step(df, ["source", "var"]), "r", "c", "v") == [(0, 0, 1.0)]


def test_lookup_keeps_one_hot_key_whole(spark):
    hot = spark.range(1000).selectExpr("'k' k", "id")
    table = spark.createDataFrame([("k", 1), ("z", 2)], "k string, x int")
    assert skew.lookup(hot, table, ["k"], ["id"]).count() == 1000


def test_files_and_validity(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.tif").write_bytes(b"II*\x00rest")
    (tmp_path / "sub" / "b.tif").write_bytes(b"PK\x03\x04x")
    (tmp_path / "empty.tif").write_bytes(b"")
    (tmp_path / "c.nc").write_bytes(b"CDF\x01" + b"0" * 500)
    listed = file_source.list_rasters(spark, str(tmp_path))
    assert listed.count() == 2
    heads = file_source.file_name(file_source.with_ends(file_source.list_files(spark, str(tmp_path))))
    kinds = rows(files.classify_files(heads), "file_name", "kind")
    assert kinds == [("a.tif", "unexpected"), ("b.tif", "zip"), ("c.nc", "netcdf3")]
    assert heads.where(F.length("head") > 200).count() == 0
    expected = heads.select("path").union(spark.createDataFrame([("gone.tif",)], "path string"))
    valid = files.validate_outputs(expected, heads).where("valid")
    assert sorted(r["path"].rsplit("/", 1)[1] for r in valid.collect()) == ["a.tif", "c.nc"]


def test_files_are_whole_by_their_ends(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "t"))
    whole = next((tmp_path / "t").glob("*.parquet")).read_bytes()
    kept = {"whole.parquet": whole, "cut.parquet": whole[:-5], "head.parquet": whole[:4], "big.tif": b"II+\x00rest", "page.tif": b"<html>", "z.zip": b"PK\x03\x04" + b"x" * 30 + b"PK\x05\x06" + bytes(18), "z cut 100%.zip": b"PK\x03\x04" + b"x" * 30, "n.bin": b"CDF\x01"}
    folder = tmp_path / "f"
    folder.mkdir()
    for name, data in kept.items():
        (folder / name).write_bytes(data)
    (folder / "gone.tif").write_bytes(b"II*\x00")
    listed = spark.createDataFrame(file_source.list_files(spark, str(folder)).collect())
    (folder / "gone.tif").unlink()
    ends = file_source.with_ends(listed)
    assert ends.where(F.length("head") > 200).count() == 0 and ends.where(F.length("tail") > 22).count() == 0
    judged = files.validate_outputs(ends.select("path"), ends)
    assert sorted(r["path"].rsplit("/", 1)[1] for r in judged.where("valid").collect()) == ["big.tif", "n.bin", "whole.parquet", "z.zip"]
    with pytest.raises(Exception, match="no range reads of ftp"):
        file_source.with_ends(spark.createDataFrame([("ftp://h/x.tif", 1)], "path string, length long")).collect()


def test_read_pretty_product_page(spark, tmp_path):
    page = '{\n "value": [\n  {"Id": "1", "Name": "N", "ContentDate": {"Start": "2020-01-01T00:00:00.000Z", "End": "2020-01-01T00:03:00.000Z"},\n   "GeoFootprint": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]]]}}\n ]\n}'
    (tmp_path / "p.json").write_text(page)
    r = catalogues.read_products(spark, str(tmp_path), pretty=True).first()
    assert r["acq_end"] == datetime(2020, 1, 1, 0, 3) and r["bbox"]["maxx"] == 1.0 and r["rings"][0]["part"] == 0


def test_geometry_check_and_text(spark):
    point = aoi_mod.from_geojson("p", {"type": "Point", "coordinates": [0, 0]})
    square = aoi_mod.from_geojson("q", SQUARE)
    df = manifest.check_geometry(aoi_mod.frame(spark, [point, square]))
    assert rows(df, "aoi_id", "ok") == [("p", False), ("q", True)]
    wkt = df.where("ok").select(rings.to_wkt(F.col("geom_type"), F.col("rings"))).first()[0]
    assert wkt == "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"


def test_regrid_ties_and_radius(spark):
    g = spark.createDataFrame([("s", 0.0, 0.0, 0.02, 0.02, 2, 2)], "scene_id string, minx double, miny double, maxx double, maxy double, width int, height int")
    samples = spark.createDataFrame(
        [("s", "a", 7, 0.005, 0.015, 1.0), ("s", "a", 3, 0.005, 0.015, 2.0), ("s", "a", 9, 200.0, 0.0, 9.0)],
        "scene_id string, var string, i long, lon double, lat double, v double",
    )
    near = swath.regrid_nearest(samples, g, ["scene_id", "var"], 500.0)
    assert rows(near, "r", "c", "v") == [(0, 0, 2.0)]
    full = swath.fill_missing(near, g, ["a", "WQSF"], "scene_id")
    got = {(r["var"], r["r"], r["c"]): r["v"] for r in full.collect()}
    assert len(got) == 8 and got[("a", 0, 0)] == 2.0 and got[("a", 1, 1)] is None and got[("WQSF", 1, 1)] == 0.0


def test_overwrite_leaves_other_slots(spark, tmp_path):
    df = raster(spark).selectExpr("'A1' aoi_id", "'s' source", "'v' var", "concat('m', r % 2) slot", "r", "c", "v")
    path = str(tmp_path / "out")
    tables.write_raster(df, path)
    tables.overwrite_slot(df.where("slot = 'm1'").limit(1), path)
    assert rows(spark.read.parquet(path).groupBy("slot").count(), "slot", "count") == [("m0", 24), ("m1", 1)]


def test_pick_raster_falls_back(spark):
    inv = spark.createDataFrame([("z", "/r/z/2001/x.tif"), ("z", "/r/z/y2000.tif"), ("z", "/r/z/deep/y2000.tif")], "archive string, path string")
    req = spark.createDataFrame([("z", 2000), ("z", 2001), ("z", 2002)], "archive string, year int")
    got = {r["year"]: (r["path"], r["error"]) for r in files.pick_raster(inv, req, "rice").collect()}
    assert got[2000][0] == "/r/z/y2000.tif" and got[2001][0] == "/r/z/2001/x.tif" and got[2002][1] is not None


def test_masked_pixels_stay_null_with_nodata(spark):
    area = aoi_mod.from_geojson("t", {"type": "Polygon", "coordinates": [[[0.3, 0.2], [3.7, 0.9], [1.1, 2.8], [0.3, 0.2]]]})
    df = cells.nodata_to_null(raster(spark, value="case when r = 2 then -1 else 5 end"), grid(spark))
    out = clip.crop_window(df, grid(spark), [area], "centre", outside="null")
    kept = clip.clip(df, grid(spark), [area], "centre").where("v is not null").count()
    assert out.where("v is not null").count() == kept > 0


def test_band_names(spark):
    df = spark.createDataFrame([("b8a",), ("Thermal",)], "b string")
    assert [r[0] for r in df.select(names.asset_key(F.col("b"))).collect()] == ["nir08", "thermal"]


def test_selected_assets_report_first_missing(spark):
    df = spark.createDataFrame([("1", {"red": ("h",)})], "scene_id string, assets map<string,struct<href:string>>")
    r = catalog.select_assets(df, ["B4", "B3", "B2"]).first()
    assert not r["complete"] and "B3" in r["error"]


def _boxes(spark, boxes):
    return spark.createDataFrame([(i, tuple(map(float, b))) for i, b in enumerate(boxes)], "id long, bbox struct<minx:double,miny:double,maxx:double,maxy:double>")


def test_pairs_meet_once_whatever_their_sizes_and_density(spark):
    rng = random.Random(180)
    some = lambda n, size: [(x, y, x + rng.random() * size, y + rng.random() * size) for x, y in ((rng.uniform(-180, 120), rng.uniform(-90, 60)) for _ in range(n))]
    dense = [(10 + rng.random(), 20 + rng.random()) for _ in range(400)]
    left = some(60, 0.3) + some(40, 8) + some(6, 50) + [(x, y, x + 0.2, y + 0.2) for x, y in dense] + [(-180, -90, 180, 90), (1, 1, 1, 1)]
    right = some(50, 1.5) + some(5, 60) + [(x, y, x + 0.05, y + 0.05) for x, y in dense[:150]] + [(-180, -90, 180, 90), (1, 1, 1, 1), (1, 1, 2, 0)]
    want = sorted((i, j) for i, a in enumerate(left) for j, b in enumerate(right[:-1]) if a[0] <= b[2] and a[2] >= b[0] and a[1] <= b[3] and a[3] >= b[1])
    l, r = _boxes(spark, left), _boxes(spark, right)
    assert rows(pairing.pair_by_bbox(l, r), "l_id", "r_id") == want
    assert pairing.candidates(l, r).where("turn = 0").count() < 2.5 * len(want)


def test_boxes_a_turn_away_meet_once(spark):
    left = _boxes(spark, [(179, 0, 181, 1), (-180, 0, -179, 1), (179, 0, 180, 1), (170, 0, 190, 1)])
    right = _boxes(spark, [(-179.5, 0, -178, 1), (178, 0, 179.5, 1), (179.5, 0, 180.5, 1), (-180, -90, 180, 90)])
    got = rows(pairing.pair_by_bbox(left, right), "l_id", "r_id")
    assert got == [(0, 0), (0, 1), (0, 2), (0, 3), (1, 0), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (3, 0), (3, 1), (3, 2), (3, 3)]


def test_shapes_across_the_antimeridian(spark):
    square = lambda w, e: [[w, 0], [e, 0], [e, 2], [w, 2], [w, 0]]
    shape = lambda name, *outer: aoi_mod.from_geojson(name, {"type": "MultiPolygon", "coordinates": [[o] for o in outer]})
    df = aoi_mod.frame(spark, [
        shape("jump", square(179, -179)), shape("cut", square(178, 180), square(-180, -178)), shape("east", square(176, 178.5)), shape("west", square(-178.5, -176)),
        shape("globe", square(-180, 180)), shape("on", square(179, 181)), shape("zero", square(-1, 1)), shape("cut and zero", square(179.5, 180), square(-180, -179.5), square(-1, 1)),
    ])
    got = spatial.contained_footprints(df.withColumnRenamed("aoi_id", "scene_id"), df)
    pairs = set(rows(got, "scene_id", "aoi_id"))
    assert got.count() == len(pairs) and pairs == {(b, a) for a, b in pairs}
    near = {"jump", "cut", "on", "globe", "cut and zero"}
    assert {b for a, b in pairs if a == "jump"} == near
    assert {b for a, b in pairs if a == "east"} == {"east", "cut", "globe"} and {b for a, b in pairs if a == "west"} == {"west", "cut", "globe"}
    assert {b for a, b in pairs if a == "zero"} == {"zero", "globe", "cut and zero"}
    inside = set(rows(got.where("contained"), "scene_id", "aoi_id"))
    assert {("jump", "on"), ("on", "jump"), ("jump", "jump"), ("zero", "cut and zero"), ("zero", "globe")} <= inside
    # A cut shape keeps its seam as an outline, so what lies across it is cropped to be safe.
    assert not {("cut", "jump"), ("jump", "cut"), ("on", "cut")} & inside
    found = spatial.intersects(df.withColumnRenamed("aoi_id", "scene_id"), [shape("jump", square(179, -179))])
    assert {a for a, _ in rows(found, "scene_id", "aoi_id")} == near


def test_outlines_of_many_vertices(spark):
    """A fringed disc of 100,000 edges gives the answers of plain numpy, and takes at most three times as long as one of 1000."""
    import time

    import numpy as np
    import pyarrow as pa

    from cellsheaf.functions.outlines import Outlines, Pairs

    kind = pa.list_(pa.struct([("part", pa.int32()), ("hole", pa.bool_()), ("pts", pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))]))
    rng = np.random.default_rng(5)

    def disc(n):
        turn = np.linspace(0, 2 * np.pi, n, endpoint=False)
        radius = 10 + rng.random(n) * 0.05
        xy = np.stack([radius * np.cos(turn), radius * np.sin(turn)], 1)
        return np.concatenate([xy, xy[:1]])

    boxes = [np.array([(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)]) for x, y in rng.uniform(-12, 11, (300, 2))]
    took = {}
    for n in (1000, 100_000):
        outline = disc(n)
        shapes = Outlines(pa.array([[{"part": 0, "hole": False, "pts": [{"x": x, "y": y} for x, y in pts]}] for pts in [outline, *boxes]], kind))
        i, j = np.arange(1, len(boxes) + 1), np.zeros(len(boxes), np.int64)
        took[n] = []
        for _ in range(3):
            began = time.perf_counter()
            pair = Pairs(shapes, i, shapes, j, np.zeros(len(i)))
            met, covered = pair.meet(), pair.covered()
            took[n].append(time.perf_counter() - began)
        far, near = np.array([np.hypot(*b.T).max() for b in boxes]), np.array([np.hypot(*(b - np.clip(b, b.min(0), b.max(0))).T).min() for b in boxes])
        assert near.max() == 0 and covered[far < 9.99].all() and not covered[far > 10.05].any() and (covered <= met).all()
        x1, y1, x2, y2 = shapes.edges[: n].T
        for k, b in enumerate(boxes[:60]):
            inside = lambda x, y: np.sum(((y1 > y) != (y2 > y)) & (x < x1 + (y - y1) * (x2 - x1) / (y2 - y1))) % 2 == 1
            corner = any(inside(*p) for p in b)
            within = ((outline >= b.min(0)) & (outline <= b.max(0))).all(1).any()
            assert met[k] == (corner or within)
    assert min(took[100_000]) < 3 * min(took[1000]) + 0.05, took


def test_boxes_that_cannot_be_placed_are_reported(spark):
    box = F.struct(*[F.col(k) for k in ("minx", "miny", "maxx", "maxy")]).alias("bbox")
    values = [(1, 179.0, 0.0, -179.0, 1.0), (2, 1.0, 0.0, 2.0, 1.0), (3, 1.0, 2.0, 2.0, 1.0), (4, float("nan"), 0.0, 1.0, 1.0), (5, None, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(values, "scene_id long, minx double, miny double, maxx double, maxy double").select("scene_id", box)
    assert sorted(r["scene_id"] for r in spatial.rejected(df, "scene_id").collect()) == [3, 4, 5]


def test_lookup_never_broadcasts_what_it_multiplies(spark):
    many, table = spark.range(1000).selectExpr("id % 3 AS k", "id AS r"), spark.range(3).selectExpr("id AS k", "id * 10 AS w")
    large = skew.lookup(many, table, ["k"], ["r"], small=0)
    assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
    assert rows(large, "k", "r", "w") == rows(skew.lookup(many, table, ["k"], ["r"]), "k", "r", "w")


def test_coordinates_keep_all_their_digits(spark):
    values = [-123.123456789, 1e-5, -2.5e-7, -1.4155343563970746e-15, -9.9e9, 1e-4, -0.00025, 15.0, 100.0, 12345678.9, 1.25e10, 0.1 + 0.2, 0.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(rings.number_text(F.col("x"))).collect()]
    assert [float(t) for t in got] == values and not any("E" in t or t.endswith(".0") for t in got)


def test_outputs_need_their_keys(spark, tmp_path):
    with pytest.raises(ValueError, match="aoi_id"):
        tables.write_raster(raster(spark), str(tmp_path / "out"))


def _attempt(spark, rows, path):
    m = spark.createDataFrame(rows, "variable_name string, path string, download_successful boolean, metadata map<string,string>")
    return tables.upsert_manifest(manifest.to_manifest(m, data_source=F.lit("s")), path)


def test_manifest_keeps_the_last_whole_attempt(spark, tmp_path):
    path = str(tmp_path / "m")
    assert tables.read_manifest(spark, path).count() == 0
    request = [("a", "x/a.tif", False, None), ("b", "x/b.tif", True, None), ("W", "", False, {"Id": "p1"}), ("W", "", False, {"Id": None}), (None, None, False, None)]
    assert _attempt(spark, request, path) == 1
    # The product that failed as one row gives its bands; a row without scene is its own unit.
    again = [("a", "x/a.tif", True, {}), ("B1", "u1", True, {"Id": "p1"}), ("B2", "u2", True, {"Id": "p1"}), (None, None, False, None)]
    for n in (2, 3):
        assert _attempt(spark, again, path) == n
    want = {("a", True, 3), ("b", True, 1), ("B1", True, 3), ("B2", True, 3), ("W", False, 1), (None, False, 3)}
    got = lambda: tables.read_manifest(spark, path).select("variable_name", "download_successful", "version").collect()
    assert len(got()) == len(want) and {tuple(r) for r in got()} == want
    # An attempt that another writer holds the number of, and one whose job never committed, count for nothing.
    (tmp_path / "m" / "_claims" / "4").touch()
    assert _attempt(spark, [("b", "x/b.tif", False, None)], path) == 5
    (tmp_path / "m" / "version=5" / "_SUCCESS").unlink()
    assert {tuple(r) for r in got()} == want
    assert _attempt(spark, [("b", "x/b.tif", False, None)], path) == 6
    assert {tuple(r) for r in got()} == want - {("b", True, 1)} | {("b", False, 6)}


def test_cache_rules_by_source(spark):
    tiff, zipped, end = b"II*\0", b"PK\3\4", b"PK\5\6" + bytes(18)
    inv = [("e.tif", 1, tiff, b""), ("empty.tif", 0, tiff, b""), ("big.zip", 200_000_000, b"no", b"no"), ("small.zip", 5, zipped, end), ("cut.zip", 9, zipped, b"x" * 22)]
    inv += [("cut.zip", None, None, None)]
    held = spark.createDataFrame(inv, "path string, length long, head binary, tail binary")
    ask = [("era5", "e.tif", True), ("era5", "empty.tif", False), ("modis_ndvi", "empty.tif", True), ("modis_ndvi", "absent", False), ("sen3_cdse", "big.zip", True)]
    ask += [("sen3_cdse", "small.zip", False), ("ecira", "small.zip", True), ("ecira", "cut.zip", False), ("ecira", "big.zip", False), ("unknown", "e.tif", False), (None, "e.tif", False)]
    out = files.cache_plan_by_source(spark.createDataFrame(ask, "source string, path string, want boolean"), held)
    assert out.count() == len(ask) and out.where("cached <> want OR cached IS NULL").collect() == []
    assert files.cache_plan_by_source(out.drop("cached"), held.limit(0)).where("cached").count() == 0


def test_products_are_asked_for_by_name_and_id(spark):
    found = spark.createDataFrame([("p1", "S3A.SEN3"), ("p2", None)], "scene_id string, name string")
    got = {r["scene_id"]: (r["request"], r["address"]) for r in slots.plan_products(found).collect()}
    assert got["p1"][0] == "S3A.SEN3.zip" and "/Products(p1)/$value" in got["p1"][1] and got["p2"][0] is None


def test_yearly_archive(spark):
    """Rasters of two CRSs; a year without one, one the area misses, an unusable archive and an area that is no polygon."""
    members = spark.createDataFrame([("/z/deg_2000.tif",), ("/z/laea_2001.tif",), ("/z/far_2003.tif",), ("/z/notes_2002.txt",)], "path string")
    frames = [("/z/deg_2000.tif", None, 0.0, 3.0, 0.5, -0.5), ("/z/laea_2001.tif", 3035, 4_000_000.0, 3_000_000.0, 1000.0, -1000.0), ("/z/far_2003.tif", 4326, 50.0, 3.0, 0.5, -0.5)]
    grids = spark.createDataFrame([(*f, 8, 6, -1.0) for f in frames], "raster_id string, epsg int, x0 double, y0 double, dx double, dy double, width int, height int, nodata double")
    numbered = spark.range(48).select((F.col("id") / 8).cast("int").alias("r"), (F.col("id") % 8).cast("int").alias("c"))
    pixels = grids.select("raster_id").join(numbered).withColumn("v", F.when(F.col("r") == 0, -1.0).otherwise(F.col("c") * 1.0))
    # The second part lies about the projected raster's corner.
    shape = [[[[0.1, 0.1], [1.9, 0.1], [1.9, 2.9], [0.1, 2.9], [0.1, 0.1]]], [[[7, 48], [12, 48], [12, 52], [7, 52], [7, 48]]]]
    area = aoi_mod.from_geojson("q", {"type": "MultiPolygon", "coordinates": shape})
    picked = archives.pick(members, datetime(2000, 6, 1), datetime(2003, 1, 1)).cache()
    out = archives.outputs(picked, pixels, grids, area).cache()
    assert rows(out.where("year = 2000").groupBy("r").agg(F.count("*").alias("n"), F.count("v").alias("k")), "r", "n", "k") == [(r, 4, 4 if r else 0) for r in range(6)]
    assert {r["year"] for r in out.select("year").distinct().collect()} <= {2000, 2001}
    told = {r["acquisition_time"].year: r for r in archives.report(picked, out, grids, area).collect()}
    assert told[2000]["download_successful"] and told[2000]["metadata"]["crs"] == "EPSG:4326" and told[2000]["metadata"]["source_file"] == "/z/deg_2000.tif"
    assert told[2002]["error"] == "No GeoTIFF found for year=2002" and told[2002]["metadata"] is None and told[2003]["error"] == registry.NO_OVERLAP
    assert (told[2001]["metadata"] or {}).get("crs") == "EPSG:3035" and told[2001]["path"] == "q/ECIRA_2001.tif"
    whole = spark.createDataFrame([("/dl/Total_IR.zip", 9, b"PK\3\4", b"PK\5\6" + bytes(18))], "path string, length long, head binary, tail binary")
    for held, ok in ((whole, True), (whole.withColumn("tail", F.lit(b"cut")), False), (whole.limit(0), False)):
        judged = archives.report(picked, out, grids, area, held=archives.archive_held(held)).where("download_successful").count()
        assert (judged > 0) == ok
    point = aoi_mod.from_geojson("p", {"type": "Point", "coordinates": [1, 2]})
    none = archives.outputs(picked, pixels, grids, point)
    assert none.count() == 0 and archives.report(picked, none, grids, point).where(F.col("error") == registry.NOT_A_POLYGON).count() == 4


def _squares(spark, rows, key):
    shape = "array(struct(0 AS part, false AS hole, transform(array(array(0, 0), array(1, 0), array(1, 1), array(0, 1), array(0, 0)), p -> struct(x + p[0] * s AS x, y + p[1] * s AS y)) AS pts)) AS rings"
    return spark.createDataFrame(rows, f"{key} long, x double, y double, s double").selectExpr(key, shape)


def test_outlines_meet_in_their_cell_without_shuffling_pairs(spark, monkeypatch):
    rng = random.Random(5)
    scenes = [(i, round(rng.uniform(-9, 9), 2), round(rng.uniform(-9, 9), 2), 2.0) for i in range(300)] + [(7, 0.0, 0.0, 2.0), (None, 1.0, 1.0, 2.0)]
    areas = [(i, round(rng.uniform(-9, 9), 2), round(rng.uniform(-9, 9), 2), rng.choice([0.5, 10.0])) for i in range(60)] + [(3, 1.0, 1.0, 0.5)]
    want = sorted(str((a[0], b[0])) for a in scenes for b in areas if a[1] <= b[1] + b[3] and a[1] + a[3] >= b[1] and a[2] <= b[2] + b[3] and a[2] + a[3] >= b[2])
    for most in (20_000, 4):
        monkeypatch.setattr(spatial, "MOST", most, raising=False)
        monkeypatch.setattr(spatial, "AT_ONCE", 50 * most, raising=False)
        got = spatial.intersects(_squares(spark, scenes, "scene_id"), _squares(spark, areas, "aoi_id"))
        assert sorted(str((r["scene_id"], r["aoi_id"])) for r in got.collect()) == want
    assert "SortMergeJoin" not in got._jdf.queryExecution().toString()


def test_scenes_bring_their_columns_to_their_areas(spark):
    scenes = _squares(spark, [(1, 0.0, 0.0, 2.0), (1, 1.0, 0.0, 2.0), (2, 50.0, 0.0, 2.0), (None, 0.0, 0.0, 2.0)], "scene_id")
    areas = _squares(spark, [(5, 0.5, 0.5, 9.0), (6, 2.5, 0.5, 9.0)], "aoi_id")
    carry = spark.createDataFrame([(1, "a"), (1, None), (2, "c"), (3, "d")], "scene_id long, name string")
    got = sorted(map(str, map(tuple, spatial.found_scenes(scenes, areas, carry).select("scene_id", "aoi_id", "name").collect())))
    want = spatial.intersects(scenes, areas).join(carry, "scene_id").select("scene_id", "aoi_id", "name")
    assert got == sorted(map(str, map(tuple, want.collect()))) and len(got) == 6


def test_samples_meet_their_pixels_without_joins_and_doubles_count(spark):
    g = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0, 100, 100)], "scene_id long, minx double, miny double, maxx double, maxy double, width int, height int")
    rows = [(1, "a", 5, 0.505, 0.505, 1.0), (1, "a", 5, 0.505, 0.505, 2.0), (1, "a", 4, 0.505, 0.515, 3.0), (1, "a", None, 0.105, 0.105, 4.0), (1, None, 6, 0.5, 0.5, 5.0)]
    samples = spark.createDataFrame(rows, "scene_id long, var string, i long, lon double, lat double, v double")
    near = swath.regrid_nearest(samples, g, ["scene_id", "var"], 500.0)
    assert sorted((r["r"], r["c"], r["v"]) for r in near.collect()) == [(48, 50, 3.0), (49, 50, 1.0), (49, 50, 2.0)]
    # Only the grid is joined.
    assert near._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1
    full = swath.fill_missing(near, g, ["a", "WQSF"], "scene_id")
    assert full.count() == 20_000 and [r["v"] for r in full.where("r = 49 AND c = 50 AND var = 'a'").collect()] == [2.0]


def test_upsampling_is_dealt_by_target_blocks(spark):
    kind = "raster_id string, width int, height int"
    cells = spark.createDataFrame([("x", "b", r, 0, float(r)) for r in range(4)], "raster_id string, band string, r int, c int, v double")
    out = resample.upsample_bilinear(cells, spark.createDataFrame([("x", 1, 4)], kind), spark.createDataFrame([("x", 70, 4000)], kind))
    assert "_blk" in out._jdf.queryExecution().toString()
    got = out.where("c = 3").select("r", "v").orderBy("r").collect()
    want = [min(max((r + 0.5) * 4 / 4000 - 0.5, 0), 3) for r in range(4000)]
    assert [r["v"] for r in got] == pytest.approx(want)


def test_units_of_a_manifest_are_not_repeated(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("s", str(k % 3), k < 6) for k in range(9)], "data_source string, variable_name string, download_successful boolean")
    for n, part in enumerate((rows, rows.where("variable_name = '1'"))):
        tables.upsert_manifest(manifest.to_manifest(part), str(tmp_path / "m"))
    for hot in (100_000, 2):
        monkeypatch.setattr(tables, "HOT_ROWS", hot, raising=False)
        monkeypatch.setattr(skew, "estimated_bytes", lambda table: 1 << 40)
        got = tables.read_manifest(spark, str(tmp_path / "m"))
        assert sorted((r["variable_name"], r["version"]) for r in got.collect()) == [("0", 1)] * 3 + [("1", 2)] * 3 + [("2", 1)] * 3
        assert "_sub" not in got._jdf.queryExecution().toString()


def test_shapes_of_few_edges_meet_and_cover_as_those_of_many():
    import numpy as np
    import pyarrow as pa

    from cellsheaf.functions.outlines import Outlines, Pairs
    from workloads.fixtures import OUTLINES

    kind = pa.list_(pa.struct([("part", pa.int32()), ("hole", pa.bool_()), ("pts", pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))]))
    rng = np.random.default_rng(3)
    shapes = [None, [], [{"part": 0, "hole": False, "pts": [{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 1.0, "y": 1.0}]}]]
    for _ in range(150):
        # Coordinates of few values, so that outlines touch and share corners; some lie a turn away.
        s, x, y, east = rng.choice([0.25, 0.5, 1.0]), *rng.integers(-6, 7, 2), rng.choice([0.0, 360.0])
        outline = OUTLINES[int(rng.integers(0, 5))][1]
        shapes.append([{"part": p, "hole": bool(h), "pts": [{"x": float(east + x + s * u), "y": float(y + s * v)} for u, v in pts]} for p, h, pts in outline])
    shapes = Outlines(pa.array(shapes, kind))
    n = len(shapes.few)
    assert shapes.few.sum() == n - 3
    i, j = np.divmod(np.arange(n * n), n)
    for turn in (0.0, 360.0, np.repeat([-360.0, 0.0], n * n)[np.arange(n * n) * 2]):
        few = Pairs(shapes, i, shapes, j, turn)
        met, inside = few.meet(True)
        shapes.few, kept = np.zeros(n, bool), shapes.few
        many = Pairs(shapes, i, shapes, j, turn)
        shapes.few = kept
        assert (many.meet() == met).all() and (many.covered() == few.covered()).all() and (inside == met & few.covered()).all() and met.any()
        for b in range(0, n, 29):
            own = np.flatnonzero(j == b)
            if np.ndim(turn) == 0:
                alone = Pairs(shapes, i[own], shapes, b, turn).meet(True)
                assert (alone[0] == met[own]).all() and (alone[1] == inside[own]).all()


def test_matches_are_counted_where_they_meet(spark, monkeypatch):

    rng = random.Random(8)
    scenes = [(i, round(rng.uniform(-5, 5), 1), round(rng.uniform(-5, 5), 1), 2.0) for i in range(200)] + [(7, 0.0, 0.0, 2.0), (None, 1.0, 1.0, 2.0)]
    areas = [(i, round(rng.uniform(-5, 5), 1), round(rng.uniform(-5, 5), 1), rng.choice([0.5, 10.0])) for i in range(20)] + [(3, 1.0, 1.0, 0.5), (30, 80.0, 80.0, 1.0)]
    meets = lambda a, b: a[1] <= b[1] + b[3] and a[1] + a[3] >= b[1] and a[2] <= b[2] + b[3] and a[2] + a[3] >= b[2]
    want = sorted((b[0], sum(meets(a, c) for a in scenes for c in areas if c[0] == b[0] and a[0] is not None)) for b in areas)
    for crowded in (1500, 1):
        monkeypatch.setattr(spatial, "CROWDED", crowded, raising=False)
        out = catalog.match_count(_squares(spark, areas, "aoi_id"), _squares(spark, scenes, "scene_id")).select("aoi_id", "n_scenes")
        assert sorted(map(tuple, out.collect())) == want
    pairs = spatial.intersects(_squares(spark, scenes, "scene_id"), _squares(spark, areas, "aoi_id"))
    assert sorted(map(str, map(tuple, pairs.collect()))) == sorted(str((a[0], b[0])) for a in scenes for b in areas if meets(a, b))
    # No row of a pair leaves the test of outlines.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "scene_id" not in plan.split("MapInArrow")[0]


def test_areas_that_share_an_outline_stay_apart_in_a_report(spark, tmp_path):
    import __spark_entry__ as entry

    orders = spark.range(40).selectExpr("id AS o_orderkey", "275 + 300 * (id % 3) AS o_custkey", "TIMESTAMP_NTZ '1996-01-01 00:00:00' AS o_orderdate", "1e0 AS o_totalprice", "'O' AS o_orderstatus")
    # The fixture gives both areas the same outline.
    spark.createDataFrame([(10,), (20020,)], "s_suppkey long").write.parquet(str(tmp_path / "supplier.parquet"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    got = entry.queries()["m2_pending"](spark, str(tmp_path)).groupBy("aoi_id", "scene").count().collect()
    found = spatial.intersects(_orders_found(spark, tmp_path), entry.workloads.fixtures.supplier_areas(spark, str(tmp_path))).collect()
    assert sorted((r["aoi_id"], int(r["scene"])) for r in got) == sorted((r["aoi_id"], r["scene_id"]) for r in found) and len(got) > 2
    assert {r["count"] for r in got} == {1} and {r["aoi_id"] for r in got} == {"s10", "s20020"}


def _orders_found(spark, path):
    from workloads import fixtures

    return catalog.name_contains(fixtures.scenes(spark, str(path)), "OL_2_WFR", "_NT_")


def test_whole_grids_are_made_of_runs(spark):
    kind = "scene_id long, minx double, miny double, maxx double, maxy double, width int, height int"
    shape = (10.0, 50.0, 11.0, 50.5, 150, 140)
    # The second scene's grid comes twice, the third has no samples, the fourth no grid.
    g = spark.createDataFrame([(k, *shape) for k in (1, 2, 2, 3)] + [(4, 0.0, 0.0, 1.0, 1.0, 1, 1)], kind)
    rng = random.Random(4)
    geometry = [(k, i, round(rng.uniform(9.9, 11.1), 3), round(rng.uniform(49.9, 50.6), 3)) for k in (1, 2, 5) for i in range(120)]
    geometry += [(1, None, 10.5, 50.25), (1, 200, 10.7, 50.25), (1, 199, 10.7, 50.25), (1, 203, 10.2, 50.1), (2, 0, 400.0, 0.0)]
    values = [(k, i, v, float(i + 1000 * (v == "b"))) for k, i, _, _ in geometry if i is not None and i % 7 for v in ("a", "b") if (v == "a" or i % 3)]
    values += [(1, 203, "WQSF", None), (1, 199, "a", 5000.0), (1, 5, "c", 1.0)]
    samples, held = spark.createDataFrame(geometry, "scene_id long, i int, lon double, lat double"), spark.createDataFrame(values, "scene_id long, i long, var string, v double")
    names = F.when(F.col("scene_id") == 4, F.lit(None)).otherwise(F.array(F.lit("a"), F.lit("b"), F.lit("WQSF")))

    def made():
        return swath.regrid_filled(samples, held, g, names, "scene_id")

    near = {}
    for r in swath.nearest_samples(samples, g.distinct(), ["scene_id"]).collect():
        near[r["scene_id"], r["r"], r["c"]] = r["i"]
    best = {}
    for k, i, var, v in values:
        best[k, i, var] = max((x for x in (v, best.get((k, i, var))) if x is not None), default=None)
    fill = {"WQSF": 0.0}
    want = sorted(
        str((k, var, r, c, best.get((k, near.get((k, r, c)), var), fill.get(var))))
        for k in (1, 2, 2, 3) for var in ("a", "b", "WQSF") for r in range(140) for c in range(150)
    )
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for most in (batch, "7"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
            assert sorted(str((r["scene_id"], r["var"], r["r"], r["c"], r["v"])) for r in made().collect()) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert len(near) > 1000
    # No pixel is sorted or grouped: what aggregates are values of samples, grids, and grids of samples.
    plan = made()._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.split("MapInArrow")[0]


def test_the_wide_swath_grid_has_the_pixels_of_its_source(spark, tmp_path):
    import __spark_entry__ as entry

    spark.createDataFrame([(2, 1, datetime(1996, 1, 1), 1.0)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    events = [(i, "view" if i else "click", 2.5) for i in range(3)]
    spark.createDataFrame(events, "event_id long, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    (row,) = entry.queries()["fetch_swath_grid"](spark, str(tmp_path)).collect()
    metres = 111_320.0 / registry.SWATH_PIXEL_METRES
    assert row["pixels"] == math.floor(34 * metres * math.cos(math.radians(38.5))) * math.floor(29 * metres)
    # About the disc of the search radius, in pixels of 300 m.
    assert 60 < row["filled"] < 110 and row["total"] == row["filled"] * 2.5
