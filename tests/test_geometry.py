"""Rings, clipping, validity, covers, nearest edges and overlaps against brute force."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import geo
from tidemark.operators import cells, cover, spatial, validate
from tidemark.sources import files

KIND = f"polygon long, rings {spatial.RINGS}"


def square(w, e, s, n):
    return [(w, s), (e, s), (e, n), (w, n), (w, s)]


def star(rng, n, x=0.0, y=0.0, r=10.0):
    """A ring that is seen whole from its middle, of uneven radius."""
    out = [(x + math.cos(2 * math.pi * i / n) * (d := r * rng.uniform(0.3, 1)), y + math.sin(2 * math.pi * i / n) * d) for i in range(n)]
    return [*out, out[0]]


def polygons(spark, rows):
    """Rows of (polygon, [(part, ring, points)])."""
    return spark.createDataFrame([(k, floats(rings)) for k, rings in rows], KIND)


def floats(rings):
    return [(part, ring, [(float(x), float(y)) for x, y in points]) for part, ring, points in rings]


def odd(rings, px, py):
    """(inside by the even-odd rule, on an edge) by brute force."""
    inside = on = False
    for points in rings:
        for (x, y), (x2, y2) in zip(points, points[1:]):
            if (y > py) != (y2 > py) and px < x + (py - y) / (y2 - y) * (x2 - x):
                inside = not inside
            if abs((x2 - x) * (py - y) - (y2 - y) * (px - x)) < 1e-12 and min(x, x2) <= px <= max(x, x2) and min(y, y2) <= py <= max(y, y2):
                on = True
    return inside, on


def test_holes_and_parts(spark):
    df = polygons(spark, [(1, [(0, 0, square(0, 4, 0, 4)), (0, 1, square(1, 2, 1, 2)), (1, 0, square(6, 8, 0, 1))]), (2, [(0, 0, square(3, 7, 3, 5))])])
    at = [(0.5, 0.5), (1.5, 1.5), (1.0, 1.5), (7.0, 0.5), (5.0, 0.5), (3.5, 3.5), (0.0, 0.0), (None, 1.0)]
    points = spark.createDataFrame(at, "lon double, lat double")
    got = sorted((r.lon, r.lat, r.polygon) for r in spatial.assign(points, spatial.edges(df)).collect() if r.polygon)
    assert got == [(0.5, 0.5, 1), (3.5, 3.5, 1), (3.5, 3.5, 2), (7.0, 0.5, 1)]
    assert spatial.assign(points, spatial.edges(df)).count() == 9
    assert {r.polygon: r.area for r in spatial.areas(spatial.edges(df), metres=False).collect()} == {1: 17.0, 2: 8.0}


def test_cover_equals_all_edges_and_tests_few(spark, monkeypatch):
    monkeypatch.setattr(cover, "MOST", 4)
    rng = random.Random(3)
    shapes = {1: [star(rng, 300), star(rng, 40, r=2)], 2: [star(rng, 7, 5, 5, 3)], 3: [square(0, 8, 0, 8), square(2, 4, 2, 4)], 4: [[(0, 0), (16, 0), (16, 0.001), (0, 0.001), (0, 0)]]}
    e = spatial.edges(polygons(spark, [(k, [(0, i, r) for i, r in enumerate(rings)]) for k, rings in shapes.items()]))
    places = [(rng.uniform(-11, 17), rng.uniform(-11, 11)) for _ in range(1500)]
    places += [p for rings in shapes.values() for r in rings for p in r[:40]]  # corners of rings
    places += [(i / 2, j / 2) for i in range(-8, 20) for j in range(-8, 20)]  # corners of cells
    places += [(p[0], q[1]) for p, q in zip(shapes[1][0][:60], shapes[1][0][7:67])]
    places = list(dict.fromkeys((float(x), float(y)) for x, y in places))
    df = spark.createDataFrame(places, "_px double, _py double")
    made = cover.cells(e)
    got = {(r._px, r._py, r.polygon): (r._odd and not r._on, r._on) for r in cover.tested(df, made).collect()}
    for k, rings in shapes.items():
        for p in places:
            inside, on = odd(rings, *p)
            assert got.get((*p, k), (False, False)) == (inside and not on, on), (k, p)
    sizes = [r[0] for r in made.filter("edges is not null").select(F.size("edges")).collect()]
    assert max(sizes) <= 4 and len(sizes) < 3000
    none = cover.tested(df.limit(0), made)
    assert none.count() == 0 and cover.tested(df, cover.cells(e.limit(0))).count() == 0


def area_inside(rings, w, e, s, n):
    """Area of a polygon in a box: in strips between all y where an edge ends or meets a side, widths at half height."""
    segments = [(p, q) for r in rings for p, q in zip(r, r[1:]) if p[1] != q[1]]
    cuts = {s, n, *(p[1] for r in rings for p in r)}
    for (x, y), (x2, y2) in segments:
        cuts |= {y + (c - x) / (x2 - x) * (y2 - y) for c in (w, e) if x != x2 and min(x, x2) < c < max(x, x2)}
    cuts = sorted(c for c in cuts if s <= c <= n)
    total = 0.0
    for a, b in zip(cuts, cuts[1:]):
        m = (a + b) / 2
        xs = sorted(min(max(x + (m - y) / (y2 - y) * (x2 - x), w), e) for (x, y), (x2, y2) in segments if min(y, y2) <= m < max(y, y2))
        total += (b - a) * sum(q - p for p, q in zip(xs[::2], xs[1::2]))
    return total


def test_clip_areas(spark):
    rng = random.Random(5)
    shapes = {k: [star(rng, rng.randint(5, 30), rng.uniform(-8, 8), rng.uniform(-8, 8))] for k in range(25)}
    shapes[90] = [square(-9, 9, -9, 9), square(-1, 6, -1, 1)]
    shapes[91], shapes[92] = [square(20, 30, 0, 1)], [square(-3, -2, 3, 4)]
    box = (-4.0, 5.0, -3.0, 6.0)
    cut = spatial.clip(polygons(spark, [(k, [(0, i, r) for i, r in enumerate(v)]) for k, v in shapes.items()]), *box)
    got = {r.polygon: r.area for r in spatial.areas(spatial.edges(cut), metres=False).collect()}
    want = {k: area_inside(v, *box) for k, v in shapes.items()}
    assert got.keys() == {k for k, v in want.items() if v > 0} and 91 not in got and got[92] == pytest.approx(1)
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in got)
    with pytest.raises(ValueError, match="extent is empty"):
        spatial.clip(cut, 1, 1, 0, 2)


def test_clipped_edges_have_no_seams(spark):
    """A ring that leaves the extent and comes back: no edge lies between its two parts."""
    u = [(170.0, -44.0), (171.0, -44.0), (171.0, -40.0), (173.0, -40.0), (173.0, -44.0), (174.0, -44.0), (174.0, -39.0), (170.0, -39.0), (170.0, -44.0)]
    box = (165.0, 180.0, -46.0, -41.0)
    e = spatial.clipped_edges(spatial.clip(polygons(spark, [(1, [(0, 0, u)])]), *box), *box)
    top = sorted((min(r.x, r.x2), max(r.x, r.x2)) for r in e.filter("y = -41 and y2 = -41").collect())
    assert top == [(170.0, 171.0), (173.0, 174.0)]
    c = spark.createDataFrame([("gap", 172.0, -41.0), ("land", 170.5, -42.0)], "cell_id string, longitude double, latitude double")
    got = {r.cell_id: r for r in spatial.distances(c, e, 75.0).collect()}
    assert got["land"].is_land and not got["gap"].is_land and 80 < got["gap"].distance_to_land_km < 90


def test_nearest_squares(spark):
    rng = random.Random(2)
    rows = [(1, x := rng.uniform(160, 180), y := rng.uniform(-50, -33), x + rng.uniform(-0.3, 0.3), y + rng.uniform(-0.3, 0.3)) for _ in range(400)] + [(1, 150.0, -60.0, 185.0, -58.0)]
    e = spatial.projected(spark.createDataFrame(rows, "polygon int, x double, y double, x2 double, y2 double"), [("x", "y"), ("x2", "y2")])
    at = spark.createDataFrame([(rng.uniform(-1e6, 4e6), rng.uniform(2e6, 9e6)) for _ in range(200)] + [(9e6, -5e6)], "_px double, _py double")
    squares = spatial.squares_of_edges(e)
    near = spatial.nearest_squares(at, squares)
    d = F.min(spatial.segment_distance(F.col("_px"), F.col("_py")))
    got = {(r._px, r._py): r.d for r in near.join(squares, ["gx", "gy"]).groupBy("_px", "_py").agg(d.alias("d")).collect()}
    want = {(r._px, r._py): r.d for r in at.crossJoin(e).groupBy("_px", "_py").agg(d.alias("d")).collect()}
    assert len(want) == 201 and all(math.isclose(got[k], v, rel_tol=1e-12) for k, v in want.items())
    candidates = [r["count"] for r in near.groupBy("_px", "_py").count().collect()]
    assert max(candidates) < 200 and sum(candidates) / len(candidates) < 12


def test_overlap_areas(spark):
    box = lambda k, *b: (k, [(0, 0, square(*b))])
    rows = [box(1, 0, 4, 0, 4), box(2, 3, 6, 1, 3), box(3, 4, 5, 0, 4), (4, [(0, 0, [(0, 0), (4, 0), (0, 4), (0, 0)])]), (5, [(0, 0, square(10, 16, 10, 16)), (0, 1, square(12, 14, 12, 14))]), box(6, 11, 13, 11, 13)]
    got = {(r.polygon, r.other): r.area for r in spatial.overlap_areas(spatial.edges(polygons(spark, rows)), metres=False, least=1e-9).collect()}
    assert {k: round(v, 9) for k, v in got.items()} == {(1, 2): 2.0, (2, 3): 2.0, (1, 4): 8.0, (5, 6): 3.0}
    rng = random.Random(4)
    a, b = star(rng, 40), star(rng, 30, 3, 2)
    both = spatial.overlap_areas(spatial.edges(polygons(spark, [(1, [(0, 0, a)]), (2, [(0, 0, b)])])), metres=False, least=0).first().area
    n, hits = 400, 0
    for i in range(n):
        for j in range(n):
            p = (-10 + 20 * (i + 0.5) / n, -10 + 20 * (j + 0.5) / n)
            hits += odd([a], *p)[0] and odd([b], *p)[0]
    assert abs(both - hits * (20 / n) ** 2) < 0.01 * both
    # in metres: a degree of longitude is cos(latitude) of one of latitude
    one = polygons(spark, [box(1, 172.0, 173.0, -42.0, -41.0), box(2, 172.5, 173.5, -42.5, -41.5), box(3, 173.0, 174.0, -42.0, -41.0)])
    got = {(r.polygon, r.other): r.area / 1e6 for r in spatial.overlap_areas(spatial.edges(one)).collect()}
    want = (0.5 * 111.06) * (0.5 * 111.32 * math.cos(math.radians(41.75)))
    assert got.keys() == {(1, 2), (2, 3)} and all(math.isclose(v, want, rel_tol=0.01) for v in got.values())


def test_problems(spark):
    ok = [(1, [(0, 0, square(0, 4, 0, 4)), (0, 1, [(0, 2), (1, 1), (1, 3), (0, 2)]), (1, 0, square(4, 6, 4, 6))]), (2, [(0, 0, [(0, 0), (0, 0), (1, 0), (1, 1), (1, 1), (0, 0)])])]
    bad = {
        3: ([(0, 0, [(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)])], {"edges cross"}),
        4: ([(0, 0, [(0, 0), (2, 0), (1, 1), (2, 2), (0, 2), (1, 1), (0, 0)])], {"ring touches itself"}),
        5: ([(0, 0, [(0, 0), (4, 0), (4, 2), (3, 2), (3, 0), (1, 0), (1, 2), (0, 2), (0, 0)])], {"edges overlap", "ring touches itself"}),
        6: ([(0, 0, [(0, 0), (1, 0), (1, 1)])], {"unclosed ring"}),
        7: ([(0, 0, [(0, 0), (1, 0), (0, 0)])], {"ring of fewer than three places"}),
        8: ([(0, 0, square(0, 4, 0, 4)), (0, 1, square(5, 6, 5, 6))], {"hole outside its shell"}),
        9: ([(0, 0, square(0, 4, 0, 4)), (0, 1, square(3, 6, 1, 2))], {"edges cross", "hole outside its shell"}),
        10: ([], {"no shell"}),
    }
    df = polygons(spark, ok + [(k, r) for k, (r, _) in bad.items()])
    got = {}
    for r in spatial.problems(df).collect():
        got.setdefault(r.polygon, set()).add(r.problem)
    assert got == {k: p for k, (_, p) in bad.items()}
    rows = {r.polygon: (r.crossings, r.overlaps > 0, r.touches > 0) for r in spatial.invalid(spatial.edges(df)).collect()}
    assert rows[3] == (1, False, False) and rows[4] == (0, False, True) and rows[5][1] and 1 not in rows and 2 not in rows


def test_geojson_of_many_rings(spark, tmp_path):
    many = {"type": "MultiPolygon", "coordinates": [[square(0, 4, 0, 4), square(1, 2, 1, 2)], [square(6, 8, 0, 1)]]}
    one = {"type": "Polygon", "coordinates": [square(0, 1, 0, 1)]}
    shapes = [{"type": "Feature", "properties": {"polygon": i}, "geometry": g} for i, g in enumerate((many, one, None))]
    path = str(tmp_path / "a.geojson")
    write = lambda **more: (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", **more, "features": shapes}))
    write(crs={"type": "name", "properties": {"name": "urn:ogc:def:crs:OGC:1.3:CRS84"}})
    df = files.read_geojson(spark, path, "polygon int", require_crs=True)
    assert {r.polygon: [(x.part, x.ring, len(x.points)) for x in r.rings] for r in df.collect()} == {0: [(0, 0, 5), (0, 1, 5), (1, 0, 5)], 1: [(0, 0, 5)], 2: []}
    files.write_geojson(df.filter("polygon < 2"), str(tmp_path / "b"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "b")).collect()]
    assert {x["properties"]["polygon"]: x["geometry"]["type"] for x in lines} == {0: "MultiPolygon", 1: "Polygon"}
    again = files.read_geojson(spark, str(tmp_path / "b"), "polygon int", collection=False)
    assert sorted(map(str, again.collect())) == sorted(map(str, df.filter("polygon < 2").collect()))
    write()
    with pytest.raises(ValueError, match="no coordinate system"):
        files.read_geojson(spark, path, "polygon int", require_crs=True)
    with pytest.raises(ValueError, match="properties name"):
        files.read_geojson(spark, path, "polygon int, name string")
    write(crs={"type": "name", "properties": {"name": "EPSG:2193"}})
    with pytest.raises(ValueError, match="2193"):
        files.read_geojson(spark, path, "polygon int")


def test_land(spark, tmp_path):
    kind = f"polygon long, name string, rings {spatial.RINGS}"
    land = [
        (1, "North", [(0, 0, square(172, 174, -43, -41)), (0, 1, square(172.5, 173, -42.5, -42))]), (2, "South", [(0, 0, square(158, 163, -46, -45))]), (3, "East", [(0, 0, square(174.2, 175, -42, -41))]),
        (4, "Near islet", [(0, 0, square(174.0, 174.1, -41, -40.9))]), (5, "Far islet", [(0, 0, square(178, 178.2, -44, -43.9))]), (6, "Snares rock", [(0, 0, square(173.9, 174, -40.95, -40.9))]),
    ]
    extent = (160.0, 180.0, -50.0, -30.0)
    out = spatial.split_land(spark.createDataFrame([(k, n, floats(r)) for k, n, r in land], kind), extent, ["name"], ["snares"])
    got = {r.polygon: r for r in out.collect()}
    assert {k: r.exclusion_reason for k, r in got.items()} == {1: None, 2: None, 3: None, 4: None, 5: "outside_mainland_proximity", 6: "named_remote_group"}
    assert min(p.x for p in got[2].rings[0].points) == 160.0 and len(got[1].rings) == 2  # cut to the extent
    paths = files.write_land_previews(out, str(tmp_path / "p"))
    assert {k: spark.read.text(v).count() for k, v in paths.items()} == {"retained_land_geojson": 4, "excluded_remote_land_geojson": 2}
    assert list(files.write_land_previews(out.filter("exclusion_reason is null"), str(tmp_path / "q"))) == ["retained_land_geojson"]
    crossed = [*land, (7, "Knot", [(0, 0, [(170, -40), (171, -39), (171, -40), (170, -39), (170, -40)])])]
    with pytest.raises(ValueError, match="1 polygons in the extent are not valid .*7: edges cross"):
        spatial.split_land(spark.createDataFrame([(k, n, floats(r)) for k, n, r in crossed], kind), extent, ["name"], ["snares"])


def test_domain_files(spark, tmp_path):
    assert files.distance_label(75.0) == "75" and files.distance_label(62.5) == "62p5"
    c = spark.createDataFrame([("a", 170.125, -40.125, False, 12.0, True), ("b", 170.375, -40.125, True, 0.0, False)], "cell_id string, longitude double, latitude double, is_land boolean, distance_to_land_km double, included_in_coastal_domain boolean")
    paths = files.write_domain(c, str(tmp_path), 62.5)
    assert paths["included_cells_geojson"].endswith("candidate_coastal_cells_62p5km.geojson")
    assert spark.read.text(paths["all_points_geojson"]).count() == 2 and spark.read.option("header", True).csv(paths["audit_csv"]).count() == 2
    ring = json.loads(spark.read.text(paths["included_cells_geojson"]).first().value)["geometry"]["coordinates"][0]
    assert ring[0] == [170.25, -40.25] and len(ring) == 5


def test_absent_cells_are_an_error(spark):
    grid = spark.createDataFrame([("2020-01-01", 170.125, -40.125, 12.0)], "time string, lon double, lat double, sst double")
    domain = spark.createDataFrame([("a", 170.125, -40.125), ("b", 170.375, -40.125)], "cell_id string, longitude double, latitude double")
    assert cells.extract(grid, domain.limit(1)).count() == 1
    with pytest.raises(ValueError, match="1 domain coordinates are absent.*'b'"):
        cells.extract(grid, domain)


def test_rows_of_another_year(spark):
    days = spark.sql("SELECT date, 'a' AS cell_id, 1.0D AS longitude, 2.0D AS latitude, 10.0D AS sst_c FROM (SELECT explode(sequence(date'2019-01-01', date'2019-12-31')) AS date)")
    late = spark.sql("SELECT date'2031-05-05' AS date, 'a' AS cell_id, 1.0D AS longitude, 2.0D AS latitude, 10.0D AS sst_c")
    domain = days.select("cell_id", "longitude", "latitude").distinct()
    failing = lambda report: {r.check_name: r.failing_rows for r in report.collect() if not r.ok}
    assert failing(validate.cell_year(days, domain, 2019)) == {} == failing(validate.trend_input(days, 2019))
    assert failing(validate.cell_year(days.union(late), domain, 2019)) == {"other_year": 1} == failing(validate.trend_input(days.union(late), 2019))


def test_places_are_projected_once(spark):
    """A filter on projected coordinates is asked of each place, not of each row that repeats it."""
    rows = spark.range(1000).selectExpr("170 + id % 4 AS lon", "-40 - id % 2 AS lat")
    at = geo.with_nztm(spatial.once(rows, "lon", "lat"), "lon", "lat", "_px", "_py").filter("_px is not null and _py is not null")
    plan = at._jdf.queryExecution().optimizedPlan().toString().lower()
    assert at.count() == 4 and "atanh" not in plan[plan.rindex("aggregate") :]
    c = rows.selectExpr("concat(lon, ' ', lat) AS cell_id", "double(lon) AS longitude", "double(lat) AS latitude")
    land = spatial.edges(polygons(spark, [(1, [(0, 0, square(171.5, 172.5, -41.5, -40.5))])]))
    out = spatial.distances(c, land, 75.0)
    plan = out._jdf.queryExecution().optimizedPlan().toString().lower().split("\n")
    scans = [i for i, line in enumerate(plan) if "range (" in line]
    assert scans and not any("filter" in line and "atanh" in line for i in scans for line in plan[max(0, i - 2) : i])
    assert out.count() == 1000 and out.filter("is_land").count() == 0


def test_narrow_polygons_meet_few_places(spark):
    """Cells of a cover follow the polygon's box: a long narrow one is not tested against places far beside it."""
    rings = [(k, [(0, 0, square(160, 182, k - 0.05, k + 0.05))]) for k in range(8)] + [(9, [(0, 0, square(161, 161.1, -20, 20))])]
    places = spark.createDataFrame([(160.5 + i / 2, j / 4) for i in range(43) for j in range(-8, 40)], "_px double, _py double")
    e = spatial.edges(polygons(spark, rings))
    met = cover.tested(places, cover.cells(e)).collect()
    inside = {(r._px, r._py, r.polygon) for r in met if r._odd and not r._on}
    assert inside == {(160.5 + i / 2, float(k), k) for i in range(43) for k in range(8)} and len(met) < 3 * len(inside)


def test_overlaps_of_boxes_and_others(spark):
    """Boxes of many sizes, and polygons that are no boxes, against brute force; no pair of boxes is shuffled."""
    rng = random.Random(8)
    boxes = {k: (x := rng.uniform(-20, 20), x + 4 ** rng.uniform(-3, 2), y := rng.uniform(-20, 20), y + 4 ** rng.uniform(-3, 2)) for k in range(60)}
    boxes |= {60: (0.0, 4.0, 0.0, 4.0), 61: (4.0, 8.0, 0.0, 4.0), 62: (0.0, 4.0, 0.0, 4.0)}
    rows = [(k, [(0, 0, square(*b))]) for k, b in boxes.items()] + [(70, [(0, 0, [(0, 0), (4, 0), (0, 4), (0, 0)])])]
    got = {(r.polygon, r.other): r.area for r in spatial.overlap_areas(spatial.edges(polygons(spark, rows)), metres=False, least=0).collect()}
    share = lambda a, b: max(0.0, min(a[1], b[1]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[2], b[2]))
    want = {(a, b): share(boxes[a], boxes[b]) for a in boxes for b in boxes if a < b}
    assert {k: v for k, v in got.items() if k[1] < 70} == {k: v for k, v in want.items() if v > 0} and got[(60, 62)] == 16.0
    assert got[(60, 70)] == pytest.approx(8.0) and got[(62, 70)] == pytest.approx(8.0)
    e = spatial.edges(polygons(spark, rows))
    kinds = spatial._boxes(e, "polygon").filter("polygon in (60, 70)").collect()
    assert {r.polygon: r._plain for r in kinds} == {60: True, 70: False}


def test_ties_at_a_limit_do_not_fail(spark):
    """A value that is at the limit but for the last bits of a sum is at the limit."""
    rows = spark.createDataFrame([(1, 2.0), (2, 2.0000000000000004), (3, 1.9999999999999998), (4, 2.25)], "k int, anomaly_c double")
    got = validate.with_examples(validate.settled(rows, "anomaly_c"), {"warm": F.expr("anomaly_c > 2")}, ["k"]).first()
    assert (got.failing_rows, got.examples) == (1, ["4"])
