"""Points in polygons, as equi-joins on grid cells, and valid outlines.

Polygons come as vertex rows ``polygon_id, landuse, vertex_no, lat, lon`` and, if they
have holes, ``ring_no`` (0 is the outer ring); points as ``lat, lon`` DOUBLE columns. A
ring may repeat its first vertex as its last. A point is inside when an eastward ray from
it crosses the rings an odd number of times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .spread import spread_join

LANDUSE = ("commercial", "industrial", "residential")
#: Runs of cells inside an outline are cut into pieces of 1, 2, 4, ... up to so many cells.
_LONGEST = 20
#: Of a cell: far above what rounding moves a crossing by.
_MARGIN = 1e-6


def _finite(column: str) -> Column:
    """Neither NULL nor infinite nor NaN, which orders above infinity."""
    return F.abs(column) < F.lit(float("inf"))


def _rings(vertices: DataFrame) -> DataFrame:
    return vertices if "ring_no" in vertices.columns else vertices.withColumn("ring_no", F.lit(0))


def _outlines(vertices: DataFrame) -> DataFrame:
    """One row per ring: its vertices, first and last, and whether it and all rings of its
    polygon are usable; with the western limit of the polygon and its own width."""
    vertex = F.struct("lat", "lon")
    found = _rings(vertices).groupBy("polygon_id", "ring_no").agg(
        F.count("*").alias("n"),
        F.count_if(_finite("lat") & _finite("lon")).alias("n_finite"),
        F.min("vertex_no").alias("low"), F.max("vertex_no").alias("high"),
        F.min_by(vertex, "vertex_no").alias("first"), F.max_by(vertex, "vertex_no").alias("last"),
        F.min("lon").alias("west"), F.max("lon").alias("east"))
    closed = F.coalesce((F.col("n") > 1) & (F.col("first") == F.col("last")), F.lit(False))
    found = found.withColumn("closed", closed).withColumn("edges", F.col("n") - closed.cast("int"))
    formed = ((F.col("edges") >= 3) & (F.col("n_finite") == F.col("n")) & F.col("ring_no").isNotNull()
              & (F.col("high").cast("bigint") - F.col("low") + 1 == F.col("n")))
    polygon = Window.partitionBy("polygon_id")
    return (found.withColumn("width", F.col("east") - F.col("west"))
            .withColumn("usable", F.every(F.coalesce(formed, F.lit(False))).over(polygon))
            .withColumn("west", F.min("west").over(polygon)))


def valid_polygons(vertices: DataFrame, salts: int = 1) -> DataFrame:
    """Vertices of polygons whose rings have at least three of them, all at finite
    positions and numbered without gaps."""
    usable = _outlines(vertices).where("usable").select("polygon_id").distinct()
    return (spread_join(vertices, usable, ["polygon_id"], ["vertex_no"], salts)
            .select(*vertices.columns))


def polygon_edges(vertices: DataFrame, salts: int = 1) -> DataFrame:
    """``polygon_id, ring_no, edge_no, edges, lat1, lon1, lat2, lon2, west`` for every side
    of every polygon whose rings are all usable; ``edges`` is the number of sides of its ring,
    ``west`` the polygon's western limit.

    Neighbours are found by vertex number, so that a polygon with very many vertices is
    never sorted as one group. Adaptive execution splits its joins; ``salts`` does where
    that is switched off.
    """
    keys = ["polygon_id", "ring_no"]
    outlines = _outlines(vertices).where("usable")
    rings = _rings(vertices)
    here = rings.select(*keys, "vertex_no", F.col("lat").alias("lat1"), F.col("lon").alias("lon1"))
    following = rings.select(*keys, (F.col("vertex_no") - 1).alias("vertex_no"),
                             F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    sides = here.join(following, [*keys, "vertex_no"])
    sides = spread_join(sides, outlines.select(*keys, "low", "edges", "west"), keys, ["vertex_no"], salts)
    sides = sides.withColumn("edge_no", F.col("vertex_no").cast("bigint") - F.col("low"))
    closing = outlines.where(~F.col("closed")).select(
        *keys, (F.col("n") - 1).alias("edge_no"), "edges", F.col("last.lat").alias("lat1"),
        F.col("last.lon").alias("lon1"), F.col("first.lat").alias("lat2"), F.col("first.lon").alias("lon2"),
        "west")
    return sides.select(*closing.columns).unionByName(closing)


def _cell(column: Column, size: Column | float) -> Column:
    return F.floor(column / (size if isinstance(size, Column) else F.lit(size)))


def _meets(level: Column, along: str = "lon", across: str = "lat") -> Column:
    """Where the line of an edge has ``across`` = ``level``."""
    a1, a2, c1, c2 = (F.col(f"{c}{n}") for c in (along, across) for n in (1, 2))
    return (a2 - a1) * (level - c1) / F.nullif(c2 - c1, F.lit(0.0)) + a1


def _straddles(level: Column, across: str = "lat") -> Column:
    return (F.col(f"{across}1") > level) != (F.col(f"{across}2") > level)


def _touched_cells(edges: DataFrame, size: float) -> DataFrame:
    """Edges copied to the cells they touch: in each row of cells, those between where
    they enter and leave it. An edge has about as many copies as cells it passes."""
    low, high = F.least("lat1", "lat2"), F.greatest("lat1", "lat2")
    rows = edges.withColumn("cell_y", F.explode(F.sequence(_cell(low, size), _cell(high, size))))
    inside = [F.greatest(low, F.col("cell_y") * size), F.least(high, (F.col("cell_y") + 1) * size)]
    ends = [F.coalesce(_meets(lat), F.col(f"lon{n}")) for n, lat in enumerate(inside, 1)]
    # What lies on the side of two cells touches both.
    first, last = F.least(*ends) - _MARGIN * size, F.greatest(*ends) + _MARGIN * size
    return rows.withColumn("cell_x", F.explode(F.sequence(_cell(first, size), _cell(last, size))))


def _crosses_below(size: float) -> Column:
    """Whether an edge crosses the lower side of a cell; at a corner, of the cell to the west."""
    bottom, at = F.col("cell_y") * size, _meets(F.col("cell_y") * size)
    return _straddles(bottom) & (at > F.col("cell_x") * size) & (at <= (F.col("cell_x") + 1) * size)


def polygon_cells(edges: DataFrame, cell_degrees: float, keys: Sequence[str] = ("polygon_id",)) -> DataFrame:
    """An index of outlines by cell: ``keys, level, cell_y, cell_x`` and what counts for
    points there.

    A cell that the outline touches (level 0) has a row for the parity of its lower
    eastern corner, if that is inside, and one for each edge that touches it. Cells between
    them hold no edge; a run of them that is inside is cut into aligned pieces of 2^level
    cells, with a row each. So the index grows with the length of outlines, not with their area.
    """
    keys = list(keys)
    touched = _touched_cells(edges, cell_degrees).withColumn("crosses", _crosses_below(cell_degrees).cast("int"))
    # Crossings of the row's lower line to the east of a cell say whether its corner is inside.
    row = Window.partitionBy(*keys, "cell_y").orderBy(-F.col("cell_x"))
    east = row.rangeBetween(Window.unboundedPreceding, -1)
    cells = touched.select(
        "*", (F.coalesce(F.sum("crosses").over(east), F.lit(0)) % 2 == 1).alias("inside"),
        F.min("cell_x").over(east).alias("next"), F.lag("cell_x").over(row).alias("same"))
    # The first row of a cell stands for its corner (-1) and for the run to its east (0 and more).
    run = F.col("next") - F.col("cell_x") - 1
    most = F.when(run > 0, F.least(F.floor(F.log2(run)).cast("int"), F.lit(_LONGEST))).otherwise(F.lit(-1))
    first = F.col("inside") & F.coalesce(F.col("same") != F.col("cell_x"), F.lit(True))
    parts = cells.withColumn("level", F.explode(F.sequence(F.lit(-2), F.when(first, most).otherwise(F.lit(-2)))))
    pieces = parts.withColumn("cell_x", F.explode(F.when(F.col("level") < 0, F.array("cell_x")).otherwise(
        _aligned(F.col("cell_x") + 1, F.col("next"), F.col("level")))))
    sides = [F.when(F.col("level") == -2, F.col(c)).alias(c) for c in ("lat1", "lon1", "lat2", "lon2")]
    return pieces.select(*keys, F.greatest("level", F.lit(0)).alias("level"), "cell_y", "cell_x", *sides)


def _aligned(low: Column, end: Column, level: Column) -> Column:
    """Of the cells from ``low`` to before ``end``, cut into pieces of 2^level cells at
    multiples of that, the numbers of those of one level: two at most but for the longest."""
    width = F.pow(F.lit(2.0), level)
    # What is left after the levels below have squared the ends off.
    low, end = F.ceil(low / width), F.floor(end / width)
    odd = F.array_compact(F.array(
        F.when((low < end) & (low % 2 != 0), low),
        F.when((low < end) & (end % 2 != 0) & ((low % 2 == 0) | (low < end - 1)), end - 1)))
    return F.when(level < _LONGEST, odd).when(low < end, F.sequence(low, end - 1))


def _counts(size: float) -> Column:
    """Whether a row of the index turns a point of its cell over: a corner or piece that is
    inside does; an edge does where it crosses the way from the point east to the cell's side
    and on down to its corner."""
    lat, lon = F.col("lat"), F.col("lon")
    side, bottom = (F.col("cell_x") + 1) * size, F.col("cell_y") * size
    splits = _straddles(side, "lon")
    height = _meets(side, "lat", "lon")
    # An edge through the corner itself lies on the side that the corner's parity says.
    rising = (F.col("lat2") > F.col("lat1")) == (F.col("lon2") > F.col("lon1"))
    above = F.when(_straddles(bottom), (_meets(bottom) <= side) == rising).otherwise(F.col("lat1") > bottom)
    down = splits & ((height > lat) != above)
    west = F.when(F.col("lon1") > side, F.col("lat2")).otherwise(F.col("lat1"))
    part = F.when(splits, (height > lat) != (west > lat)).otherwise(_straddles(lat) & (F.col("lon1") <= side))
    across = part & F.coalesce(lon < _meets(lat), F.lit(False))
    return F.when(F.col("lat1").isNull(), F.lit(True)).otherwise(across != down)


def points_inside(points: DataFrame, vertices: DataFrame, cell_degrees: float = 0.01,
                  salts: int = 1) -> DataFrame:
    """Distinct ``lat, lon, polygon_id`` with the position inside the polygon.

    A point meets what the index has for its cell, and for the aligned runs of cells that
    hold it. Smaller cells make more of them, larger ones hold more edges: take one with a
    few edges. Hot cells are left to adaptive execution, which splits them.
    """
    return _inside(points, polygon_edges(vertices, salts), _used_levels(vertices, cell_degrees), cell_degrees,
                   ["polygon_id"])


def _used_levels(vertices: DataFrame, cell_degrees: float) -> DataFrame:
    """``_level`` of pieces that a run across the widest ring can have: few rows."""
    most = F.floor(F.log2(F.greatest(F.max("width") / cell_degrees, F.lit(1.0)))) + 1
    most = F.coalesce(F.least(most, F.lit(_LONGEST)), F.lit(0)).cast("int")
    return (_outlines(vertices).where("usable").agg(most.alias("most"))
            .select(F.explode(F.sequence(F.lit(0), F.col("most"))).alias("_level")))


def _inside(points: DataFrame, edges: DataFrame, used: DataFrame, cell_degrees: float, keys: list[str],
            also: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """``lat, lon, also, keys`` of points inside outlines that fulfil ``where``."""
    index = polygon_cells(edges, cell_degrees, keys)
    positions = (points.select("lat", "lon", *also).where(_finite("lat") & _finite("lon")).distinct()
                 .withColumn("y", _cell(F.col("lat"), cell_degrees))
                 .withColumn("x", _cell(F.col("lon"), cell_degrees)))
    levels = F.explode(F.transform(F.sequence(F.lit(0), F.lit(_LONGEST)), lambda n: F.struct(
        n.alias("level"), F.call_function("shiftright", F.col("x"), n).alias("x"))))
    seen = positions.select("lat", "lon", *also, "y", levels.alias("_at")).select(
        "lat", "lon", *also, "y", "_at.level", "_at.x")
    seen = seen.join(F.broadcast(used), F.col("level") == F.col("_level"), "left_semi").withColumnRenamed(
        "level", "_level")
    met = seen.join(index, (F.col("level") == F.col("_level")) & (F.col("cell_y") == F.col("y"))
                    & (F.col("cell_x") == F.col("x")))
    met = met.where(_counts(cell_degrees)) if where is None else met.where(where & _counts(cell_degrees))
    group = ["lat", "lon", *also, *keys]
    return met.groupBy(*group).agg(F.count("*").alias("_n")).where(F.col("_n") % 2 == 1).drop("_n")


def covered_positions(points: DataFrame, land: DataFrame, city: DataFrame,
                      landuse: tuple[str, ...] = LANDUSE, cell_degrees: float = 0.01,
                      salts: int = 1) -> DataFrame:
    """Points inside at least one land polygon of a listed use and inside the city."""
    used = land.where(F.col("landuse").isin(*landuse))
    positions = points.select("lat", "lon")
    for area in (used, city):
        positions = points_inside(positions, area, cell_degrees, salts).select("lat", "lon").distinct()
    return points.join(positions, ["lat", "lon"], "left_semi")


# Validity -------------------------------------------------------------------------

def _turn(a: str, b: str, p: tuple[str, str]) -> Column:
    """Sign of the turn from an edge to a point."""
    (ax, ay), (bx, by) = ((F.col(f"{n}.lon{i}"), F.col(f"{n}.lat{i}")) for n, i in ((a[:-1], a[-1]), (b[:-1], b[-1])))
    px, py = (F.col(c) for c in p)
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def crossing_edges(edges: DataFrame) -> DataFrame:
    """``polygon_id`` of polygons with two sides that may not meet as they do.

    Two sides of a ring that are not neighbours share a point, two neighbours lie on one
    another, or sides of different rings cross or lie on one another; different rings may
    touch at a point. Every edge is posted in a grid with cells as large as itself, of which
    it touches four at most, and looks for longer ones in the coarser grids of its polygon.
    So the work does not depend on how fine the outline is, and only edges that lie close
    together for their length are compared.
    """
    length = F.greatest(F.abs(F.col("lat1") - F.col("lat2")), F.abs(F.col("lon1") - F.col("lon2")))
    sized = edges.where(length > 0).withColumn("level", F.ceil(F.log2(length)).cast("int"))
    levels = sized.groupBy("polygon_id").agg(F.collect_set("level").alias("levels"))  # of doubles: 2,100 at most
    cells = [F.sequence(_cell(F.least(f"{c}1", f"{c}2"), F.pow(F.lit(2.0), F.col("grid"))),
                        _cell(F.greatest(f"{c}1", f"{c}2"), F.pow(F.lit(2.0), F.col("grid")))) for c in ("lat", "lon")]

    def in_cells(rows: DataFrame) -> DataFrame:
        return rows.withColumn("cell_y", F.explode(cells[0])).withColumn("cell_x", F.explode(cells[1]))

    posted = in_cells(sized.withColumn("grid", F.col("level"))).alias("a")
    asking = in_cells(sized.join(levels, "polygon_id").withColumn("grid", F.explode("levels"))
                      .where("grid >= level").drop("levels")).alias("b")
    order = [F.struct(F.col(f"{n}.ring_no"), F.col(f"{n}.edge_no")) for n in "ab"]
    pairs = posted.join(asking, ["polygon_id", "grid", "cell_y", "cell_x"]).where(
        (F.col("b.level") < F.col("a.level")) | (order[0] < order[1]))
    ends = {n: [(f"{n}.lon{i}", f"{n}.lat{i}") for i in (1, 2)] for n in "ab"}
    turns = [_turn(f"{n}1", f"{n}2", end) for n, m in ("ab", "ba") for end in ends[m]]
    t1, t2, t3, t4 = turns
    proper = (t1 * t2 < 0) & (t3 * t4 < 0)

    def on(n: str, end: tuple[str, str], turn: Column) -> Column:
        x, y = (F.col(c) for c in end)
        return ((turn == 0) & x.between(F.least(f"{n}.lon1", f"{n}.lon2"), F.greatest(f"{n}.lon1", f"{n}.lon2"))
                & y.between(F.least(f"{n}.lat1", f"{n}.lat2"), F.greatest(f"{n}.lat1", f"{n}.lat2")))

    touch = (on("a", ends["b"][0], t1) | on("a", ends["b"][1], t2) | on("b", ends["a"][0], t3)
             | on("b", ends["a"][1], t4))
    level = (t1 == 0) & (t2 == 0) & (t3 == 0) & (t4 == 0)
    # On one line: they overlap in more than a point if their spans do.
    spans = [F.least(F.greatest(f"a.{c}1", f"a.{c}2"), F.greatest(f"b.{c}1", f"b.{c}2"))
             - F.greatest(F.least(f"a.{c}1", f"a.{c}2"), F.least(f"b.{c}1", f"b.{c}2")) for c in ("lat", "lon")]
    overlap = level & touch & (F.greatest(*spans) > 0)
    same = F.col("a.ring_no") == F.col("b.ring_no")
    apart = F.abs(F.col("a.edge_no") - F.col("b.edge_no"))
    neighbours = same & ((apart == 1) | (apart == F.col("a.edges") - 1))
    wrong = F.when(neighbours, overlap).when(same, proper | touch).otherwise(proper | overlap)
    return pairs.where(wrong).select("polygon_id").distinct()


def invalid_polygons(vertices: DataFrame, cell_degrees: float = 0.01,
                     salts: int = 1) -> DataFrame:
    """``polygon_id, reason`` of polygons that are not valid, with the first reason of:

    - ``vertices``: a ring has fewer than three corners, gaps in its numbers or a position
      that is not finite, or there is no ring 0;
    - ``repeated``: a corner has the position of the one before it;
    - ``crossing``: see ``crossing_edges``;
    - ``hole``: most vertices of a hole are outside the outer ring, or inside another hole;
      without a crossing, the others lie on an outline.

    That two rings touch in several points, which can cut a polygon in two, is not looked for.
    """
    whole = F.every("usable") & F.coalesce(F.bool_or(F.col("ring_no") == 0), F.lit(False))
    shapes = _outlines(vertices).groupBy("polygon_id").agg((~whole).alias("bad"))
    edges = polygon_edges(vertices, salts)
    repeated = edges.where("lat1 = lat2 AND lon1 = lon2").select("polygon_id").distinct()
    keys = ["_polygon", "_ring"]
    named = edges.withColumnsRenamed({"polygon_id": "_polygon", "ring_no": "_ring"})
    corners = edges.where("ring_no != 0").select("polygon_id", "ring_no", F.col("lat1").alias("lat"),
                                                 F.col("lon1").alias("lon"))
    held = _inside(corners, named, _used_levels(vertices, cell_degrees), cell_degrees, keys, ["polygon_id", "ring_no"],
                   (F.col("polygon_id") == F.col("_polygon")) & (F.col("ring_no") != F.col("_ring")))
    count, other = F.count("*").alias("n"), F.col("_ring") != 0
    places = (held.groupBy("polygon_id", "ring_no", "_ring").agg(count).groupBy("polygon_id", "ring_no")
              .agg(F.max(F.when(~other, F.col("n"))).alias("inside"), F.max(F.when(other, F.col("n"))).alias("nested")))
    holes = corners.distinct().groupBy("polygon_id", "ring_no").agg(count).join(places, ["polygon_id", "ring_no"], "left")
    misplaced = holes.where((F.coalesce("inside", F.lit(0)) * 2 <= F.col("n"))
                            | (F.coalesce("nested", F.lit(0)) * 2 > F.col("n")))
    found = (shapes.where("bad").select("polygon_id", F.lit(0).alias("_order"))
             .unionByName(repeated.withColumn("_order", F.lit(1)))
             .unionByName(crossing_edges(edges).withColumn("_order", F.lit(2)))
             .unionByName(misplaced.select("polygon_id").distinct().withColumn("_order", F.lit(3))))
    names = F.array(*[F.lit(n) for n in ("vertices", "repeated", "crossing", "hole")])
    return found.groupBy("polygon_id").agg(F.min("_order").alias("_order")).select(
        "polygon_id", F.element_at(names, F.col("_order") + 1).alias("reason"))
