"""Polygons as covers of cells, for places to meet by an equi-join.

A cell of sides 2**p and 2**q, which follow the polygon's box, so that a long
narrow polygon has long narrow cells and meets no places far beside it, has its
corner at (cx, cy) times its sides. It lies inside a
polygon, or it holds stretches of its border: then it has the edges that meet
it, MOST at most, and says whether its south-east corner is inside. Cells with
more edges are split into 16, so that a place is tested against a few edges
however many the polygon has.

Whether a place is inside follows from the edges that the way from it to the
corner crosses: east along its y to the cell's side, then south. Corners and
turns count as moved east, and less far north, by less than any number: an edge
through one of them lies on one side of it in every cell alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Edges of a cell, but for the smallest, and how often a cell is split at most.
MOST, ROUNDS = 16, 16
_SPLIT = 4
#: A side is 2**WIDEST times the other at most, and not under 2**THINNEST for the other's sake.
WIDEST, THINNEST = 8, -18


def _side(x: Column, y: Column, x2: Column, y2: Column, px: Column, py: Column) -> Column:
    """1: the place is to the left of the edge, -1: to the right."""
    turn = F.signum((x2 - x) * (py - y) - (y2 - y) * (px - x))
    return F.when(turn != 0, turn).when(y != y2, -F.signum(y2 - y)).otherwise(F.signum(x2 - x))


def _west(e: tuple, px: Column, py: Column) -> Column:
    """Of an edge that spans the place's y: does it pass west of the place?"""
    return _side(*e, px, py) * F.signum(e[3] - e[1]) < 0


def _below(e: tuple, px: Column, py: Column) -> Column:
    """Of an edge that spans the place's x: does it pass below the place?"""
    return _side(*e, px, py) * F.signum(e[2] - e[0]) > 0


def _way(e: tuple, starts_west: Column, py: Column, east: Column, south: Column) -> Column:
    """Does the edge cross the way east along py to `east` and down to `south` an odd number of times? `starts_west`: it passes west of the start."""
    x, y, x2, y2 = e
    along = ((y > py) != (y2 > py)) & ~starts_west & _west(e, east, py)
    down = ((x > east) != (x2 > east)) & _below(e, east, py) & ~_below(e, east, south)
    return along != down


def meets(e: tuple, west: Column, south: Column, side: Column, height: Column | None = None) -> Column:
    """Does the edge meet the closed square, or the rectangle of that height: boxes overlap, and the corners are not all on one side of the edge."""
    x, y, x2, y2 = e
    height = side if height is None else height
    boxes = (F.least(x, x2) <= west + side) & (F.greatest(x, x2) >= west) & (F.least(y, y2) <= south + height) & (F.greatest(y, y2) >= south)
    sides = [(x2 - x) * (b - y) - (y2 - y) * (a - x) for a in (west, west + side) for b in (south, south + height)]
    return boxes & ~((F.greatest(*sides) < 0) | (F.least(*sides) > 0))


def cells(edge_rows: DataFrame, key: str = "polygon") -> DataFrame:
    """key, p, q, cx, cy, odd (is the south-east corner inside) and edges (null: all of the cell is inside)."""
    e = tuple(F.col(c) for c in ("x", "y", "x2", "y2"))
    box = edge_rows.groupBy(key).agg(F.min(F.least("x", "x2")).alias("w"), F.max(F.greatest("x", "x2")).alias("e"), F.min(F.least("y", "y2")).alias("s"), F.max(F.greatest("y", "y2")).alias("n"))
    # the polygon lies in 4 x 4 cells, the south-east corner of which is outside
    power = lambda a, b: F.ceil(F.log2(F.greatest(F.col(a) - F.col(b), F.lit(1e-9)) / 3)).cast("int")
    least = lambda a, b: F.greatest(F.col(a), F.col(b) - WIDEST, F.least(F.col(b), F.lit(THINNEST)))
    box = box.withColumns({"_p": power("e", "w"), "_q": power("n", "s")}).withColumns({"p": least("_p", "_q"), "q": least("_q", "_p")})
    at = lambda c, p: F.floor(F.col(c) / F.pow(F.lit(2.0), p)).cast("long")
    rows = edge_rows.select(key, "x", "y", "x2", "y2").join(box.select(key, "p", "q", at("w", "p").alias("i0"), at("s", "q").alias("j0"), F.lit(False).alias("odd0")), key)
    cell = [key, "p", "q", "cx", "cy"]
    side, height = F.pow(F.lit(2.0), F.col("p")), F.pow(F.lit(2.0), F.col("q"))
    done: DataFrame | None = None
    for i in range(ROUNDS):
        inner = rows.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(_SPLIT * _SPLIT - 1))))
        inner = inner.withColumns({"cx": F.col("i0") + F.floor(F.col("_k") / _SPLIT), "cy": F.col("j0") + F.col("_k") % _SPLIT})
        east, south = (F.col("i0") + _SPLIT) * side, F.col("j0") * height
        corner_x, corner_y = (F.col("cx") + 1) * side, F.col("cy") * height
        crossed = _way(e, _west(e, corner_x, corner_y), corner_y, east, south)
        inside = meets(e, F.col("cx") * side, F.col("cy") * height, side, height)
        found = inner.groupBy(*cell, "odd0").agg((F.sum(crossed.cast("int")) % 2 == 1).alias("_odd"), F.count(F.when(inside, 1)).alias("_n"))
        found = found.select(*cell, (F.col("odd0") != F.col("_odd")).alias("odd"), "_n")
        put = inner.filter(inside).select(*cell, "x", "y", "x2", "y2")
        many = F.col("_n") > (MOST if i < ROUNDS - 1 else 1 << 60)
        border = put.join(found.filter((F.col("_n") > 0) & ~many), cell).groupBy(*cell, "odd").agg(F.collect_list(F.struct("x", "y", "x2", "y2")).alias("edges"))
        whole = found.filter("_n = 0 and odd").select(*cell, "odd").withColumn("edges", F.lit(None).cast(border.schema["edges"].dataType))
        made = border.unionByName(whole)
        done = made if done is None else done.unionByName(made)
        crowded = put.join(found.filter(many), cell)
        if crowded.isEmpty():
            break
        rows = crowded.select(key, "x", "y", "x2", "y2", (F.col("p") - 2).alias("p"), (F.col("q") - 2).alias("q"), (F.col("cx") * _SPLIT).alias("i0"), (F.col("cy") * _SPLIT).alias("j0"), F.col("odd").alias("odd0")).persist()  # a round reads what the last one left
    return done.persist()


def tested(places: DataFrame, cover: DataFrame, key: str = "polygon") -> DataFrame:
    """Places (_px, _py) with each polygon whose cover has their cell: _odd (inside by the even-odd rule) and _on (on an edge); a place meets one cell of a polygon at most."""
    powers = sorted((r["p"], r["q"]) for r in cover.select("p", "q").distinct().collect())  # a few: cells of one size
    if not powers:
        return places.select("_px", "_py").limit(0).join(cover.select(key, F.lit(False).alias("_odd"), F.lit(False).alias("_on")).limit(0), F.lit(True))
    side, height = F.pow(F.lit(2.0), F.col("p")), F.pow(F.lit(2.0), F.col("q"))
    sizes = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p, q in powers])
    at = places.select("_px", "_py", F.explode(sizes).alias("_size")).select("_px", "_py", "_size.p", "_size.q")
    at = at.withColumns({"cx": F.floor(F.col("_px") / side).cast("long"), "cy": F.floor(F.col("_py") / height).cast("long")})
    met = at.join(cover, ["p", "q", "cx", "cy"]).withColumns({"_e": (F.col("cx") + 1) * side, "_s": F.col("cy") * height})
    px, py = F.col("_px"), F.col("_py")

    def crossed(r: Column) -> Column:
        e = tuple(r[c] for c in ("x", "y", "x2", "y2"))
        spans = (e[1] > py) != (e[3] > py)
        at_west = ~(px < e[0] + (py - e[1]) / F.when(spans, e[3] - e[1]) * (e[2] - e[0]))
        return _way(e, F.coalesce(at_west, F.lit(False)), py, F.col("_e"), F.col("_s"))

    def on(r: Column) -> Column:
        cross = (r["x2"] - r["x"]) * (py - r["y"]) - (r["y2"] - r["y"]) * (px - r["x"])
        return (F.abs(cross) < 1e-12) & px.between(F.least(r["x"], r["x2"]), F.greatest(r["x"], r["x2"])) & py.between(F.least(r["y"], r["y2"]), F.greatest(r["y"], r["y2"]))

    flips = F.coalesce(F.size(F.filter("edges", crossed)), F.lit(0)) % 2 == 1
    flips = F.when(F.col("edges").isNull(), F.lit(False)).otherwise(flips)
    return met.select("_px", "_py", key, (F.col("odd") != flips).alias("_odd"), F.coalesce(F.exists("edges", on), F.lit(False)).alias("_on"))
