"""Grids, polygons and distances as joins over tables of edges.

Polygons are rows (polygon, part, ring, n, x, y, x2, y2): an edge each of closed
rings. Ring 0 of a part is its shell, the others are holes; without `part` and
`ring` all edges of a polygon are one shell. By the even-odd rule over all
edges, holes and further parts need no case of their own.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from . import cover

STEP, OFFSET = 0.25, 0.125


def centres(low: Column, high: Column) -> Column:
    """Cell centres OFFSET + STEP * i from low to high, as an array; a high on a centre counts."""
    first = F.ceil((low - OFFSET) / STEP)
    last = F.floor((high - OFFSET) / STEP)
    return F.when(last >= first, F.transform(F.sequence(first, last), lambda i: OFFSET + STEP * i)).otherwise(F.array().cast("array<double>"))


def build_grid(extent: DataFrame) -> DataFrame:
    """Cells of one-row extents (west, east, south, north)."""
    out = extent.select(F.explode(centres(F.col("west"), F.col("east"))).alias("longitude"), "south", "north")
    out = out.select("longitude", F.explode(centres(F.col("south"), F.col("north"))).alias("latitude"))
    return out.select(F.format_string("oisst_%.3f_%.3f", "longitude", "latitude").alias("cell_id"), "longitude", "latitude")


#: Type of a polygon's rings: part, ring (0: shell, others: holes) and points, the last of which is the first.
RINGS = "array<struct<part:int,ring:int,points:array<struct<x:double,y:double>>>>"


def with_rings(polygons: DataFrame, ring: str = "ring", rings: str = "rings") -> DataFrame:
    """Polygons of one shell in `ring` as polygons with `rings`; those that have `rings` already stay."""
    if rings in polygons.columns:
        return polygons.drop(ring)
    one = F.struct(F.lit(0).alias("part"), F.lit(0).alias("ring"), F.col(ring).alias("points"))
    return polygons.withColumn(rings, F.array(one)).drop(ring)


def ring_rows(polygons: DataFrame, key: str = "polygon", ring: str = "ring") -> DataFrame:
    """A row for each ring: key, part, ring, points without points that repeat the one before."""
    rows = with_rings(polygons, ring).select(key, F.explode("rings").alias("r")).select(key, "r.*")
    same = lambda i: (F.get("points", i)["x"] == F.get("points", i - 1)["x"]) & (F.get("points", i)["y"] == F.get("points", i - 1)["y"])
    return rows.withColumn("points", F.filter("points", lambda p, i: ~F.coalesce((i > 0) & same(i), F.lit(False))))


def edges(polygons: DataFrame, key: str = "polygon", ring: str = "ring") -> DataFrame:
    """Edges of closed rings (`ring`: array of struct<x, y>, or `rings`), numbered in each ring."""
    pairs = F.transform(F.sequence(F.lit(0), F.size("points") - 2), lambda i: F.struct(
        i.alias("n"), F.get("points", i)["x"].alias("x"), F.get("points", i)["y"].alias("y"), F.get("points", i + 1)["x"].alias("x2"), F.get("points", i + 1)["y"].alias("y2")
    ))
    rows = ring_rows(polygons, key, ring).filter(F.size("points") > 1)
    return rows.select(key, "part", "ring", F.explode(pairs).alias("e")).select(key, "part", "ring", "e.*")


def _ringed(edge_rows: DataFrame) -> DataFrame:
    return edge_rows.withColumns({c: F.lit(0) for c in ("part", "ring", "n") if c not in edge_rows.columns})


def _crosses(px: Column, py: Column) -> Column:
    """Does a ray to the east cross the edge; half-open in y, so that a vertex counts once."""
    spans = (F.col("y") > py) != (F.col("y2") > py)
    return spans & (px < F.col("x") + (py - F.col("y")) / F.when(spans, F.col("y2") - F.col("y")) * (F.col("x2") - F.col("x")))


def _tested(places: DataFrame, edge_rows: DataFrame, key: str) -> DataFrame:
    """Places (_px, _py) and polygons whose cover has their cell: _odd (the even-odd rule) and _on (a place on an edge)."""
    return cover.tested(places, cover.cells(edge_rows, key), key)


def assign(points: DataFrame, edge_rows: DataFrame, key: str = "polygon", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Left join of points to the polygons that hold them, strictly inside by the even-odd rule.

    A point in two polygons gives two rows, in none or in a hole one with null.
    Each place is tested once, however many rows it has, and only against the
    edges of its cell of each polygon's cover.
    """
    places = points.select(F.col(lon).alias("_px"), F.col(lat).alias("_py")).distinct().filter("_px is not null and _py is not null")
    hits = _tested(places, edge_rows, key).filter("_odd and not _on").select("_px", "_py", key)
    return points.join(hits, (F.col(lon) == F.col("_px")) & (F.col(lat) == F.col("_py")), "left").drop("_px", "_py")


def multiple(points: DataFrame, edge_rows: DataFrame, key: str = "polygon", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Places in more than one polygon, with how many."""
    places = points.select(lon, lat).distinct()
    return assign(places, edge_rows, key, lon, lat).groupBy(lon, lat).agg(F.count(key).alias("polygon_count")).filter("polygon_count > 1")


def overlap(points: DataFrame, edge_rows: DataFrame, key: str = "polygon", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Pairs of polygons that share cells, with their number."""
    inside = assign(points.select(lon, lat).distinct(), edge_rows, key, lon, lat).filter(F.col(key).isNotNull())
    other = inside.select(lon, lat, F.col(key).alias("other"))
    return inside.join(other, [lon, lat]).filter(F.col(key) < F.col("other")).groupBy(key, "other").agg(F.count(F.lit(1)).alias("shared_cells"))


def once(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct keys. What is asked of them afterwards, such as that a projected key is not null, is asked of these
    rows only: Spark moves filters below distinct(), to each row of df, but not below values of an aggregate."""
    return df.groupBy(*[F.col(c).alias(f"_{c}") for c in keys]).agg(*[F.max(c).alias(c) for c in keys]).select(*keys)


def projected(rows: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Coordinates in metres in place of degrees."""
    for x, y in pairs:
        rows = geo.with_nztm(rows, x, y, x, y)
    return rows


def segment_distance(px: Column, py: Column) -> Column:
    """From a point to the edge x, y, x2, y2."""
    dx, dy = F.col("x2") - F.col("x"), F.col("y2") - F.col("y")
    length = dx * dx + dy * dy
    t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - F.col("x")) * dx + (py - F.col("y")) * dy) / F.when(length > 0, length)))).otherwise(0.0)
    return F.sqrt(F.pow(px - F.col("x") - t * dx, 2) + F.pow(py - F.col("y") - t * dy, 2))


#: Sides of the squares that edges lie in, as powers of two metres: the largest are 25 at most over the plane, each holds 64 of the next.
LARGEST, SMALLEST, FACTOR = 23, 14, 3


def squares_of_edges(edge_rows: DataFrame) -> DataFrame:
    """Edges in metres, once for each smallest square (gx, gy) that they meet; from larger squares down, so that long edges make no boxes of squares."""
    span = lambda a, b, side: F.sequence(F.floor(F.least(a, b) / side).cast("long"), F.floor(F.greatest(a, b) / side).cast("long"))
    top = float(1 << LARGEST)
    rows = edge_rows.select("x", "y", "x2", "y2").withColumn("gx", F.explode(span("x", "x2", top))).withColumn("gy", F.explode(span("y", "y2", top)))
    for power in range(LARGEST - FACTOR, SMALLEST - 1, -FACTOR):
        side = F.lit(float(1 << power))
        inner = F.array(*[F.lit(i) for i in range(1 << FACTOR)])
        child = F.transform(inner, lambda i: F.col("gx") * (1 << FACTOR) + i)
        rows = rows.select("x", "y", "x2", "y2", F.explode(child).alias("cx"), "gy")
        rows = rows.select("x", "y", "x2", "y2", F.col("cx").alias("gx"), F.explode(F.transform(inner, lambda i: F.col("gy") * (1 << FACTOR) + i)).alias("gy"))
        rows = rows.filter(cover.meets(tuple(F.col(c) for c in ("x", "y", "x2", "y2")), F.col("gx") * side, F.col("gy") * side, side))
    return rows


def nearest_squares(places: DataFrame, squares: DataFrame) -> DataFrame:
    """Places (_px, _py in metres) and the smallest squares (gx, gy) that may hold their nearest edge.

    From the largest squares down: a square that holds an edge puts an upper
    bound on a place's distance, its farthest corner; of the squares inside
    those that are left, only those nearer than the least bound stay.
    """
    of = lambda power: squares.select(*[F.shiftright(c, power - SMALLEST).alias(c) for c in ("gx", "gy")]).distinct()
    every = of(LARGEST).agg(F.collect_list(F.struct("gx", "gy")).alias("top"))  # one row of 25 squares at most
    met = places.crossJoin(F.broadcast(every)).select("_px", "_py", F.explode("top").alias("t")).select("_px", "_py", "t.*")
    for power in range(LARGEST, SMALLEST - 1, -FACTOR):
        side = float(1 << power)
        if power < LARGEST:
            inside = of(power).select(*[F.shiftright(c, FACTOR).alias(f"_{c}") for c in ("gx", "gy")], "gx", "gy")
            met = met.select("_px", "_py", F.col("gx").alias("_gx"), F.col("gy").alias("_gy")).join(inside, ["_gx", "_gy"]).drop("_gx", "_gy")
        near, far = [], []
        for p, g in (("_px", "gx"), ("_py", "gy")):
            low = F.col(p) - F.col(g) * side
            near.append(F.greatest(-low, low - side, F.lit(0.0)))
            far.append(F.greatest(F.abs(low), F.abs(low - side)))
        least = F.min(F.col("_far")).over(Window.partitionBy("_px", "_py"))
        met = met.withColumns({"_near": F.hypot(*near), "_far": F.hypot(*far)}).withColumn("_most", least)
        met = met.filter(F.col("_near") <= F.col("_most") * (1 + 1e-12)).select("_px", "_py", "gx", "gy")
    return met


def distances(cells: DataFrame, land: DataFrame, max_km: float, *, beyond: bool = True) -> DataFrame:
    """Each cell with is_land and its distance to the land in km; null beyond max_km if not `beyond`.

    Distances are in the projected plane, to edges in squares that may hold the
    nearest one.
    """
    e = squares_of_edges(projected(land.select("x", "y", "x2", "y2"), [("x", "y"), ("x2", "y2")])).persist()
    e.count()  # each level of squares reads it; by its size Spark chooses how to join
    at = geo.with_nztm(once(cells, "longitude", "latitude"), "longitude", "latitude", "_px", "_py")
    near = nearest_squares(at.select("_px", "_py").distinct(), e)
    met = near.join(e, ["gx", "gy"]).groupBy("_px", "_py").agg((F.min(segment_distance(F.col("_px"), F.col("_py"))) / 1000).alias("_km"))
    found = at.join(met, ["_px", "_py"]).select("longitude", "latitude", (F.col("_km") if beyond else F.when(F.col("_km") <= max_km, F.col("_km"))).alias("_km"))
    places = once(cells, "longitude", "latitude").select(F.col("longitude").alias("_px"), F.col("latitude").alias("_py"))
    inside = _tested(places, land, "polygon").groupBy("_px", "_py").agg(F.max(F.col("_odd") | F.col("_on")).alias("is_land"))
    inside = inside.withColumnsRenamed({"_px": "longitude", "_py": "latitude"})
    out = cells.join(inside, ["longitude", "latitude"], "left").join(found, ["longitude", "latitude"], "left").withColumn("is_land", F.coalesce("is_land", F.lit(False)))  # an edge is land
    out = out.withColumn("distance_to_land_km", F.when(F.col("is_land"), 0.0).otherwise(F.col("_km")))
    return out.select(*cells.columns, "is_land", "distance_to_land_km")


def classify(cells: DataFrame, land: DataFrame, max_km: float = 75.0, *, beyond: bool = False) -> DataFrame:
    """is_land, distance (of every cell if `beyond`) and whether the cell is in the coastal domain: sea within max_km of land."""
    if max_km <= 0:
        raise ValueError("max_km must be positive")
    out = distances(cells, land, max_km, beyond=beyond)
    return out.withColumn("included_in_coastal_domain", ~F.col("is_land") & F.coalesce(F.col("distance_to_land_km") <= max_km, F.lit(False)))


def areas(edge_rows: DataFrame, key: str = "polygon", *, metres: bool = True) -> DataFrame:
    """Area of polygons, shells less holes: area_m2 in the projected plane, or `area` in the edges' own if not `metres`."""
    e = projected(_ringed(edge_rows), [("x", "y"), ("x2", "y2")]) if metres else _ringed(edge_rows)
    rings = e.groupBy(key, "part", "ring").agg((F.abs(F.sum(F.col("x") * F.col("y2") - F.col("x2") * F.col("y"))) / 2).alias("_a"))
    return rings.groupBy(key).agg(F.sum(F.when(F.col("ring") == 0, F.col("_a")).otherwise(-F.col("_a"))).alias("area_m2" if metres else "area"))


def mainland(edge_rows: DataFrame, max_km: float = 80.0, anchors: int = 3, key: str = "polygon", *, size: DataFrame | None = None) -> DataFrame:
    """Polygons with area, distance to the largest `anchors` ones and whether they are kept; `size` gives areas where edges stand in no order.

    Edges of a polygon meet the anchors' edges in squares of a coarse grid of
    side max_km; beyond reach the distance is null. Edges that cross are at 0.
    """
    if max_km <= 0 or anchors <= 0:
        raise ValueError("distance and number of anchors must be positive")
    size = areas(edge_rows, key) if size is None else size
    top = size.orderBy(F.col("area_m2").desc(), key).limit(anchors).select(key)
    side = max_km * 1000
    e = projected(edge_rows.select(key, "x", "y", "x2", "y2"), [("x", "y"), ("x2", "y2")])
    reach = lambda a, b, m: F.sequence(F.floor(F.least(a, b) / side).cast("long") - m, F.floor(F.greatest(a, b) / side).cast("long") + m)
    put = lambda df, m: df.withColumn("_gx", F.explode(reach(F.col("x"), F.col("x2"), m))).withColumn("_gy", F.explode(reach(F.col("y"), F.col("y2"), m)))
    far = put(e.join(top, key, "left_semi"), 1).drop(key)
    own = put(e, 0).select(key, F.col("x").alias("a"), F.col("y").alias("b"), F.col("x2").alias("c"), F.col("y2").alias("d"), "_gx", "_gy")
    side_of = lambda px, py, qx, qy, rx, ry: (qx - px) * (ry - py) - (qy - py) * (rx - px)
    a, b, c, d, x, y, x2, y2 = (F.col(n) for n in ("a", "b", "c", "d", "x", "y", "x2", "y2"))
    cross = (side_of(a, b, c, d, x, y) * side_of(a, b, c, d, x2, y2) < 0) & (side_of(x, y, x2, y2, a, b) * side_of(x, y, x2, y2, c, d) < 0)

    def to_segment(px, py, qx, qy, rx, ry):
        dx, dy = rx - qx, ry - qy
        length = dx * dx + dy * dy
        t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - qx) * dx + (py - qy) * dy) / F.when(length > 0, length)))).otherwise(0.0)
        return F.sqrt(F.pow(px - qx - t * dx, 2) + F.pow(py - qy - t * dy, 2))

    gap = F.when(cross, 0.0).otherwise(F.least(to_segment(a, b, x, y, x2, y2), to_segment(c, d, x, y, x2, y2), to_segment(x, y, a, b, c, d), to_segment(x2, y2, a, b, c, d)))
    near = own.join(far, ["_gx", "_gy"]).groupBy(key).agg((F.min(gap) / 1000).alias("distance_km"))
    out = size.join(near, key, "left")
    return out.withColumn("distance_km", F.when(F.col("distance_km") <= max_km, F.col("distance_km"))).withColumn("kept", F.col("distance_km").isNotNull())


def _turn(p: str, q: str, r: str, s: str, t: str, u: str) -> Column:
    """On which side of the line from (p, q) to (r, s) is (t, u)."""
    return (F.col(r) - F.col(p)) * (F.col(u) - F.col(q)) - (F.col(s) - F.col(q)) * (F.col(t) - F.col(p))


def meeting_edges(edge_rows: DataFrame, key: str = "polygon") -> DataFrame:
    """Pairs of edges of one key, once each, whose boxes share a square; the second as a, b, c, d with _part, _ring, m.

    Squares are so wide that a key's box has about as many of them as it has edges.
    """
    e = _ringed(edge_rows).filter("x <> x2 or y <> y2")
    low = [F.min(F.least(a, b)).alias(f"_{a}0") for a, b in (("x", "x2"), ("y", "y2"))]
    wide = F.greatest(F.max(F.greatest("x", "x2")) - F.min(F.least("x", "x2")), F.max(F.greatest("y", "y2")) - F.min(F.least("y", "y2")))
    boxes = e.groupBy(key).agg(*low, F.greatest(wide / F.sqrt(F.count(F.lit(1))), F.lit(1e-9)).alias("_side"))
    cell = lambda v, a: F.floor((v - F.col(f"_{a}0")) / F.col("_side")).cast("long")
    span = lambda a, b: F.sequence(cell(F.least(a, b), a), cell(F.greatest(a, b), a))
    put = e.join(boxes, key).withColumn("_gx", F.explode(span("x", "x2"))).withColumn("_gy", F.explode(span("y", "y2")))
    first = put.select(key, "_gx", "_gy", "_x0", "_y0", "_side", "part", "ring", "n", "x", "y", "x2", "y2")
    other = put.select(key, "_gx", "_gy", F.col("part").alias("_part"), F.col("ring").alias("_ring"), F.col("n").alias("m"), F.col("x").alias("a"), F.col("y").alias("b"), F.col("x2").alias("c"), F.col("y2").alias("d"))
    pairs = first.join(other, [key, "_gx", "_gy"]).filter(F.struct("part", "ring", "n") < F.struct(F.col("_part").alias("part"), F.col("_ring").alias("ring"), F.col("m").alias("n")))
    # of the squares that both boxes share, the first one counts
    home = (F.col("_gx") == cell(F.greatest(F.least("x", "x2"), F.least("a", "c")), "x")) & (F.col("_gy") == cell(F.greatest(F.least("y", "y2"), F.least("b", "d")), "y"))
    return pairs.filter(home).drop("_gx", "_gy", "_x0", "_y0", "_side")


def _faults(edge_rows: DataFrame, key: str) -> DataFrame:
    """Pairs of edges with how they meet: cross, overlap, touch (of one ring, other than neighbours at their common end)."""
    t = [_turn("x", "y", "x2", "y2", "a", "b"), _turn("x", "y", "x2", "y2", "c", "d"), _turn("a", "b", "c", "d", "x", "y"), _turn("a", "b", "c", "d", "x2", "y2")]
    last = Window.partitionBy(key, "part", "ring")
    numbered = _ringed(edge_rows).filter("x <> x2 or y <> y2").withColumn("_last", F.max("n").over(last))
    pairs = meeting_edges(numbered.drop("_last"), key).join(numbered.groupBy(key, "part", "ring").agg(F.max("n").alias("_last")), [key, "part", "ring"])
    pairs = pairs.withColumns({f"_t{i}": v for i, v in enumerate(t)})
    one = (F.col("part") == F.col("_part")) & (F.col("ring") == F.col("_ring"))
    after = one & ((F.col("m") == F.col("n") + 1) | (F.col("n") == 0) & (F.col("m") == F.col("_last")))
    length = lambda p, q, r, s: F.least(F.greatest(p, q), F.greatest(r, s)) - F.greatest(F.least(p, q), F.least(r, s))
    line = (F.col("_t0") == 0) & (F.col("_t1") == 0)
    shared = F.greatest(length("x", "x2", "a", "c"), length("y", "y2", "b", "d"))
    together = (length("x", "x2", "a", "c") >= 0) & (length("y", "y2", "b", "d") >= 0)
    on = F.lit(False)
    for i, (px, py, (p, q, r, s)) in enumerate((("a", "b", ("x", "y", "x2", "y2")), ("c", "d", ("x", "y", "x2", "y2")), ("x", "y", ("a", "b", "c", "d")), ("x2", "y2", ("a", "b", "c", "d")))):
        on = on | (F.col(f"_t{i}") == 0) & F.col(px).between(F.least(p, r), F.greatest(p, r)) & F.col(py).between(F.least(q, s), F.greatest(q, s))
    how = F.when((F.col("_t0") * F.col("_t1") < 0) & (F.col("_t2") * F.col("_t3") < 0), "cross").when(line & together & (shared > 0), "overlap").when(~after & one & on, "touch")
    return pairs.withColumn("how", how).filter("how is not null")


def invalid(edge_rows: DataFrame, key: str = "polygon") -> DataFrame:
    """Polygons whose edges cross, overlap or touch where they should not, with the number of such pairs of edges.

    Rings of one polygon may touch at points; a ring may not touch itself.
    """
    of = lambda how: F.count(F.when(F.col("how") == how, 1))
    return _faults(edge_rows, key).groupBy(key).agg(of("cross").alias("crossings"), of("overlap").alias("overlaps"), of("touch").alias("touches"))


def problems(polygons: DataFrame, key: str = "polygon", ring: str = "ring") -> DataFrame:
    """Why polygons are not valid: key, problem, n (how often). Polygons without a problem give no row.

    unclosed ring, ring of fewer than three places, edges cross, edges overlap
    (as those of a flat ring do), ring touches itself, hole outside its shell,
    no shell. A point that repeats the one before it is none.
    """
    rows = with_rings(polygons, ring)
    rings = ring_rows(rows, key, ring)
    ends = lambda c: F.get("points", 0)[c] == F.element_at("points", -1)[c]
    closed = F.coalesce((F.size("points") > 0) & ends("x") & ends("y"), F.lit(False))
    few = F.size(F.array_distinct("points")) < 3  # such a ring has no other problem
    kinds = [
        rings.filter(~closed & ~few).select(key, F.lit("unclosed ring").alias("problem")),
        rings.filter(few).select(key, F.lit("ring of fewer than three places").alias("problem")),
        rows.filter(~F.coalesce(F.exists("rings", lambda r: r["ring"] == 0), F.lit(False))).select(key, F.lit("no shell").alias("problem")),
    ]
    e = edges(rows, key).join(rings.filter(few).select(key, "part", "ring"), [key, "part", "ring"], "left_anti")
    names = {"cross": "edges cross", "overlap": "edges overlap", "touch": "ring touches itself"}
    text = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    kinds.append(_faults(e, key).select(key, text[F.col("how")].alias("problem")))
    part = F.struct(key, "part").alias("_part")
    shells = e.filter("ring = 0").select(part, "x", "y", "x2", "y2")
    holes = e.filter("ring > 0").select(part, "ring", F.col("x").alias("_px"), F.col("y").alias("_py"))
    inside = _tested(holes.select("_px", "_py").distinct(), shells, "_part")
    out = holes.join(inside, ["_px", "_py", "_part"], "left").groupBy("_part", "ring").agg(F.max(~F.coalesce(F.col("_odd") | F.col("_on"), F.lit(False))).alias("_out"))
    kinds.append(out.filter("_out").select(F.col("_part")[key].alias(key), F.lit("hole outside its shell").alias("problem")))
    found = kinds[0]
    for k in kinds[1:]:
        found = found.unionByName(k)
    return found.groupBy(key, "problem").agg(F.count(F.lit(1)).alias("n"))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), 0)


def _half(points: Column, axis: str, at: float, above: bool) -> Column:
    """A closed ring cut at the line axis = at: the points on the kept side, and where edges pass the line; closed again."""
    other = "y" if axis == "x" else "x"
    kept = lambda p: (p[axis] >= at) if above else (p[axis] <= at)

    def edge(p: Column, q: Column) -> Column:
        cut = p[other] + (F.lit(at) - p[axis]) / (q[axis] - p[axis]) * (q[other] - p[other])
        between = F.struct(*[(F.lit(at) if c == axis else cut).alias(c) for c in ("x", "y")])
        passes = F.when(kept(p) != kept(q), F.array(between)).otherwise(F.array().cast("array<struct<x:double,y:double>>"))
        return F.when(kept(q), F.concat(passes, F.array(q))).otherwise(passes)

    n = F.greatest(F.size(points) - 1, F.lit(0))
    cut = F.flatten(F.zip_with(F.slice(points, F.lit(1), n), F.slice(points, F.lit(2), n), edge))
    return _let(cut, lambda p: F.when(F.size(p) > 0, F.concat(p, F.slice(p, 1, 1))).otherwise(p))


def clip(polygons: DataFrame, west: float, east: float, south: float, north: float, ring: str = "ring") -> DataFrame:
    """Polygons with their `rings` cut to the extent; those of which no area is left go.

    Each ring is cut by the four sides in turn. A ring that leaves the extent
    and comes back stays one ring, whose parts are joined along the side; see
    `clipped_edges`.
    """
    if west >= east or south >= north:
        raise ValueError("the extent is empty")
    rows = with_rings(polygons, ring)
    name = "_points"
    key = [c for c in rows.columns if c != "rings"]
    rows = rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("_r", F.explode("rings")).select(*key, "_row", F.col("_r.part").alias("part"), F.col("_r.ring").alias("ring_"), F.col("_r.points").alias(name))
    cut = F.col(name)
    for axis, at, above in (("x", west, True), ("x", east, False), ("y", south, True), ("y", north, False)):
        cut = _let(cut, partial(_half, axis=axis, at=float(at), above=above))
    rows = rows.withColumn(name, cut)
    twice = F.aggregate(F.sequence(F.lit(0), F.greatest(F.size(name) - 2, F.lit(0))), F.lit(0.0), lambda a, i: a + F.get(name, i)["x"] * F.get(name, i + 1)["y"] - F.get(name, i + 1)["x"] * F.get(name, i)["y"])
    rows = rows.withColumn("_area", F.when(F.size(name) > 3, twice)).filter("_area <> 0")
    packed = F.sort_array(F.collect_list(F.struct("part", F.col("ring_").alias("ring"), F.col(name).alias("points")))).cast(RINGS).alias("rings")
    out = rows.groupBy("_row").agg(*[F.first(c).alias(c) for c in key], packed).select(*key, "rings")
    return out.filter(F.exists("rings", lambda r: r["ring"] == 0))


def clipped_edges(polygons: DataFrame, west: float, east: float, south: float, north: float, key: str = "polygon") -> DataFrame:
    """Edges of polygons that `clip` made, without seams: of a side of the extent, stretches that an odd number of edges cover stay.

    These edges stand in no order; areas come from the rings.
    """
    e = edges(polygons, key).select(key, "x", "y", "x2", "y2")
    side = F.when((F.col("x") == F.col("x2")) & F.col("x").isin(float(west), float(east)), F.lit("x")).when((F.col("y") == F.col("y2")) & F.col("y").isin(float(south), float(north)), F.lit("y"))
    e = e.withColumn("_side", side)
    border = e.filter("_side is not null").withColumn("_at", F.when(F.col("_side") == "x", F.col("x")).otherwise(F.col("y")))
    ends = border.select(key, "_side", "_at", F.explode(F.when(F.col("_side") == "x", F.array("y", "y2")).otherwise(F.array("x", "x2"))).alias("_p"))
    by = Window.partitionBy(key, "_side", "_at").orderBy("_p")
    ends = ends.withColumns({"_odd": F.row_number().over(by) % 2 == 1, "_q": F.lead("_p").over(by)}).filter("_odd and _q > _p")
    flat = F.col("_side") == "x"
    back = ends.select(key, *[F.when(flat, F.col(v)).otherwise(F.col(h)).alias(c) for c, v, h in (("x", "_at", "_p"), ("y", "_p", "_at"), ("x2", "_at", "_q"), ("y2", "_q", "_at"))])
    return e.filter("_side is null").drop("_side").unionByName(back)


#: Overlaps of less are contacts of borders and slivers, in square metres.
LEAST_OVERLAP = 1_000_000.0


#: Tasks that share the boxes of a crowded rectangle.
SHARES = 8


def _boxes(e: DataFrame, key: str) -> DataFrame:
    """Polygons with their boxes (w, e, s, t), the least p and q so that 4**p and 4**q are no less than the sides, and _plain: the polygon is all of its box."""
    x, y, x2, y2 = (F.col(c) for c in ("x", "y", "x2", "y2"))
    up, flat = (x == x2) & (y != y2), (y == y2) & (x != x2)
    box = e.groupBy(key).agg(
        F.min(F.least(x, x2)).alias("w"), F.max(F.greatest(x, x2)).alias("e"), F.min(F.least(y, y2)).alias("s"), F.max(F.greatest(y, y2)).alias("t"),
        F.count(F.when((x != x2) | (y != y2), 1)).alias("_n"), F.count(F.when(up, 1)).alias("_ups"), F.count(F.when(flat, 1)).alias("_flats"),
        F.min(F.when(up, x)).alias("_up0"), F.max(F.when(up, x)).alias("_up1"), F.max(F.when(up, F.least(y, y2))).alias("_from"), F.min(F.when(up, F.greatest(y, y2))).alias("_to"),
        F.min(F.when(flat, y)).alias("_flat0"), F.max(F.when(flat, y)).alias("_flat1"), F.max(F.when(flat, F.least(x, x2))).alias("_left"), F.min(F.when(flat, F.greatest(x, x2))).alias("_right"),
    )
    sides = F.expr("_n = 4 and _ups = 2 and _flats = 2 and w < e and s < t and _up0 = w and _up1 = e and _from = s and _to = t and _flat0 = s and _flat1 = t and _left = w and _right = e")
    power = lambda a, b: F.ceil(F.log2(F.greatest(F.col(a) - F.col(b), F.lit(1e-9))) / 2).cast("int")
    return box.select(key, "w", "e", "s", "t", power("e", "w").alias("p"), power("t", "s").alias("q"), F.coalesce(sides, F.lit(False)).alias("_plain"))


def _meeting_boxes(left: DataFrame, right: DataFrame, kinds: list[tuple[int, int]], key: str) -> DataFrame:
    """Pairs of boxes of different keys that share an area, once in each order that left and right give; right's columns as other, w_, e_, s_, t_ and _plain.

    `kinds` are the (p, q) that occur. Boxes of two kinds meet in rectangles as
    wide and high as the larger of the two, of which a box has 2 * 2 at most;
    the one that holds the corner of what they share counts.
    """
    sizes = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p, q in kinds]).cast("array<struct<p:int,q:int>>")
    wide, high = (F.pow(F.lit(4.0), F.greatest(a, f"_k.{a}")) for a in ("p", "q"))
    at = lambda c, side: F.floor(F.col(c) / side).cast("long")
    put = lambda df: (
        df.withColumn("_k", F.explode(sizes)).withColumns({"_wide": wide, "_high": high})
        .withColumn("_gx", F.explode(F.sequence(at("w", F.col("_wide")), at("e", F.col("_wide"))))).withColumn("_gy", F.explode(F.sequence(at("s", F.col("_high")), at("t", F.col("_high")))))
    )
    by = ["_own", "_k", "_gx", "_gy", "_share"]
    parts = 4 * left.sparkSession.sparkContext.defaultParallelism  # few bytes of boxes make many pairs: Spark would put them in one task
    one = put(left).select(F.struct("p", "q").alias("_own"), "_k", "_gx", "_gy", F.pmod(F.xxhash64(key), F.lit(SHARES)).alias("_share"), "_wide", "_high", key, *"west").repartition(parts, *by)
    two = put(right).select(F.col("_k").alias("_own"), F.struct("p", "q").alias("_k"), "_gx", "_gy", F.col(key).alias("other"), *[F.col(c).alias(f"{c}_") for c in "west"], "_plain")
    two = two.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)).cast("array<bigint>"))).repartition(parts, *by)
    met = one.join(two, by).filter((F.col(key) != F.col("other")) & (F.col("w") < F.col("e_")) & (F.col("w_") < F.col("e")) & (F.col("s") < F.col("t_")) & (F.col("s_") < F.col("t")))
    return met.filter((F.col("_gx") == F.floor(F.greatest("w", "w_") / F.col("_wide"))) & (F.col("_gy") == F.floor(F.greatest("s", "s_") / F.col("_high"))))


def overlap_areas(edge_rows: DataFrame, key: str = "polygon", *, metres: bool = True, least: float = LEAST_OVERLAP) -> DataFrame:
    """Pairs of polygons (key, other) with the area they share, if it is more than `least`; in the projected plane, or in the edges' own if not `metres`.

    Two polygons that fill their boxes share what these share, and nothing of a
    pair is shuffled. Others: slabs. The edges of both are cut at every y of an end or of a crossing.
    Between two such y no edges cross, so that what is inside both at half
    height, times the height, is the slab's share.
    """
    e = _ringed(edge_rows).select(key, "part", "ring", "n", "x", "y", "x2", "y2")
    e = projected(e, [("x", "y"), ("x2", "y2")]) if metres else e
    boxes = _boxes(e, key)
    plain, others = boxes.filter("_plain"), boxes.filter("not _plain")
    kinds = [(r["p"], r["q"]) for r in boxes.select("p", "q").distinct().collect()]  # sizes of boxes, as powers of four
    shared = (F.least("e", "e_") - F.greatest("w", "w_")) * (F.least("t", "t_") - F.greatest("s", "s_"))
    of_boxes = _meeting_boxes(plain, plain, kinds, key).filter(F.col(key) < F.col("other")).select(key, "other", shared.alias("area")).filter(F.col("area") > least)
    # the others: each meets all, a pair of two of them once
    two = _meeting_boxes(others, boxes, kinds, key).filter(F.col("_plain") | (F.col(key) < F.col("other")))
    first = F.col(key) < F.col("other")
    pair = F.struct(F.when(first, F.col(key)).otherwise(F.col("other")).alias("a"), F.when(first, F.col("other")).otherwise(F.col(key)).alias("b"))
    two = two.select(pair.alias("_pair"), F.greatest("s", "s_").alias("_low"), F.least("t", "t_").alias("_high"), F.greatest("w", "w_").alias("_west"), F.least("e", "e_").alias("_east"))
    own = two.withColumn("_of", F.explode(F.array("_pair.a", "_pair.b"))).join(e.withColumnRenamed(key, "_of"), "_of").withColumn("_first", F.col("_of") == F.col("_pair.a"))
    own = own.filter((F.least("y", "y2") < F.col("_high")) & (F.greatest("y", "y2") > F.col("_low")))
    # edges of the two polygons get part numbers apart, so that they are edges of one key
    numbered = own.withColumn("part", F.when(F.col("_first"), F.col("part") * 2).otherwise(F.col("part") * 2 + 1))
    t0, t1, t2, t3 = _turn("x", "y", "x2", "y2", "a", "b"), _turn("x", "y", "x2", "y2", "c", "d"), _turn("a", "b", "c", "d", "x", "y"), _turn("a", "b", "c", "d", "x2", "y2")
    crossing = meeting_edges(numbered.select("_pair", "part", "ring", "n", "x", "y", "x2", "y2"), "_pair").withColumns({"_t0": t0, "_t1": t1, "_t2": t2, "_t3": t3}).filter("_t0 * _t1 < 0 and _t2 * _t3 < 0")
    crossing = crossing.select("_pair", (F.col("b") + F.try_divide("_t0", F.col("_t0") - F.col("_t1")) * (F.col("d") - F.col("b"))).alias("_y"))
    inside = lambda c: F.least(F.greatest(F.col(c), F.col("_low")), F.col("_high"))
    cuts = own.select("_pair", F.explode(F.array(inside("y"), inside("y2"))).alias("_y"), "_low", "_high").select("_pair", "_y")
    cuts = cuts.unionByName(crossing.join(two.select("_pair", "_low", "_high"), "_pair").filter("_y > _low and _y < _high").select("_pair", "_y")).distinct()
    by = Window.partitionBy("_pair").orderBy("_y")
    slabs = cuts.withColumns({"_slab": F.row_number().over(by), "_next": F.lead("_y").over(by)})
    rank = lambda name: slabs.select("_pair", F.col("_y").alias(f"_{name}"), F.col("_slab").alias(f"_{name}_slab"))
    spans = own.filter("y <> y2").withColumns({"_from": inside("y"), "_to": inside("y2")})
    spans = spans.withColumns({"_from": F.least("_from", "_to"), "_to": F.greatest("_from", "_to")}).filter("_from < _to")
    spans = spans.join(rank("from"), ["_pair", "_from"]).join(rank("to"), ["_pair", "_to"])
    spans = spans.select("_pair", "_first", "x", "y", "x2", "y2", F.explode(F.sequence(F.col("_from_slab"), F.col("_to_slab") - 1)).alias("_slab"))
    spans = spans.join(slabs.filter("_next is not null").select("_pair", "_slab", "_y", "_next"), ["_pair", "_slab"])
    middle = (F.col("_y") + F.col("_next")) / 2
    spans = spans.withColumn("_x", F.col("x") + (middle - F.col("y")) / (F.col("y2") - F.col("y")) * (F.col("x2") - F.col("x")))
    along = Window.partitionBy("_pair", "_slab").orderBy("_x", "_first")
    odd = lambda first: F.count(F.when(F.col("_first") == first, 1)).over(along.rowsBetween(Window.unboundedPreceding, 0)) % 2 == 1
    spans = spans.withColumns({"_a": odd(True), "_b": odd(False), "_until": F.lead("_x").over(along)})
    share = F.sum(F.when(F.col("_a") & F.col("_b"), (F.col("_until") - F.col("_x")) * (F.col("_next") - F.col("_y"))).otherwise(0.0))
    out = spans.groupBy("_pair").agg(share.alias("area")).filter(F.col("area") > least)
    return of_boxes.unionByName(out.select(F.col("_pair.a").alias(key), F.col("_pair.b").alias("other"), "area"))


def in_extent(edge_rows: DataFrame, west: float, east: float, south: float, north: float, key: str = "polygon", *, least: int = 0) -> DataFrame:
    """Polygons that meet the extent: an edge does, or the polygon holds a corner of it. Fewer than `least` of them are an error."""
    if west >= east or south >= north:
        raise ValueError("the extent is empty")
    x, y, x2, y2 = (F.col(c) for c in ("x", "y", "x2", "y2"))
    boxes_meet = (F.least(x, x2) <= east) & (F.greatest(x, x2) >= west) & (F.least(y, y2) <= north) & (F.greatest(y, y2) >= south)
    side = [(x2 - x) * (F.lit(b) - y) - (y2 - y) * (F.lit(a) - x) for a in (west, east) for b in (south, north)]  # of the corners to the edge's line
    touches = boxes_meet & ~((F.greatest(*side) < 0) | (F.least(*side) > 0))
    holds = F.count(F.when(_crosses(F.lit(west), F.lit(south)), 1)) % 2 == 1
    out = edge_rows.groupBy(key).agg(F.max(touches).alias("_t"), holds.alias("_h")).filter("_t or _h").select(key)
    if least and out.limit(least).count() < least:
        raise ValueError(f"fewer than {least} polygons meet the extent")
    return out


def split_land(polygons: DataFrame, extent: tuple[float, float, float, float], names: list[str], terms: list[str], *, max_km: float = 80.0, anchors: int = 3, key: str = "polygon") -> DataFrame:
    """Polygons that meet the extent, cut to it, with exclusion_reason: a term in their names, or far from the largest ones; null for those that are kept.

    No polygon in the extent, polygons in it that are not valid, fewer than
    `anchors` after the names, and none kept are errors.
    """
    polygons = with_rings(polygons)
    near = in_extent(edges(polygons, key), *extent, key=key, least=1)
    land = polygons.join(near, key)
    bad = problems(land, key)
    examples = [f"{r[0]}: {r[1]}" for r in bad.orderBy(key, "problem").limit(10).select(key, "problem").collect()]
    if examples:
        raise ValueError(f"{bad.select(key).distinct().count()} polygons in the extent are not valid ({'; '.join(examples)}); repair the source first")
    land = text_exclusion(clip(land, *extent), names, terms, "named_remote_group")
    named = land.filter("exclusion_reason is null").drop("exclusion_reason")
    if named.limit(anchors).count() < anchors:
        raise ValueError(f"fewer than {anchors} polygons are left")
    kept = mainland(clipped_edges(named, *extent, key=key), max_km, anchors, key, size=areas(edges(named, key), key)).filter("kept").select(key, F.lit(True).alias("_kept"))
    if kept.isEmpty():
        raise ValueError("no polygon is kept")
    land = land.join(kept, key, "left")
    far = F.when(F.col("exclusion_reason").isNull() & F.col("_kept").isNull(), "outside_mainland_proximity").otherwise(F.col("exclusion_reason"))
    return land.withColumn("exclusion_reason", far).drop("_kept")


def load_mainland(polygons: DataFrame, extent: tuple[float, float, float, float], names: list[str], terms: list[str], *, max_km: float = 80.0, anchors: int = 3, key: str = "polygon") -> DataFrame:
    """What `split_land` keeps."""
    return split_land(polygons, extent, names, terms, max_km=max_km, anchors=anchors, key=key).filter("exclusion_reason is null").drop("exclusion_reason")


def ocean_mask(cells: DataFrame, mask: DataFrame) -> DataFrame:
    """Look each cell up in (lon, lat, sst): coordinates known on each axis, value there; the latter limits the domain."""
    m = mask.select(geo.axis_key(F.col("lon")).alias("_x"), F.round("lat", 3).alias("_y"), (F.col("sst").isNotNull() & ~F.isnan("sst")).alias("_v"))
    value = m.groupBy("_x", "_y").agg(F.max("_v").alias("_v"))
    out = cells.withColumns({"_x": geo.axis_key(F.col("longitude")), "_y": F.round("latitude", 3)})
    out = out.join(m.select("_x", F.lit(True).alias("_hx")).distinct(), "_x", "left").join(m.select("_y", F.lit(True).alias("_hy")).distinct(), "_y", "left").join(value, ["_x", "_y"], "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    out = out.withColumns({"oisst_coordinate_exists": flag("_hx") & flag("_hy"), "oisst_ocean_cell": flag("_v")})
    if "included_in_coastal_domain" in cells.columns:
        out = out.withColumn("included_in_coastal_domain", F.col("included_in_coastal_domain") & F.col("oisst_ocean_cell"))
    return out.drop("_x", "_y", "_hx", "_hy", "_v")


def text_exclusion(df: DataFrame, columns: list[str], terms: list[str], reason: str) -> DataFrame:
    """All rows with exclusion_reason, where the names joined by " | " hold a term in either case; the others null."""
    names = F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    found = F.rlike(F.lower(names), F.lit("|".join("\\Q" + t.lower() + "\\E" for t in terms)))
    return df.withColumn("exclusion_reason", F.when(found, F.lit(reason)))

