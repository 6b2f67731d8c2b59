import random

import pytest
from pyspark.sql import functions as F

from fleetlens import operators as op, schemas

SQUARE = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0)]


def polygons(spark, shapes, use="residential"):
    rows = [(pid, use, no, float(lat), float(lon)) for pid, ring in shapes.items()
            for no, (lat, lon) in enumerate(ring)]
    return spark.createDataFrame(rows, schemas.POLYGONS)


def points(spark, pairs):
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pairs)],
                                 "id INT, lat DOUBLE, lon DOUBLE")


def crosses(point, ring):
    lat, lon = point
    odd = False
    for (lat1, lon1), (lat2, lon2) in zip(ring, ring[1:] + ring[:1]):
        if (lat1 > lat) != (lat2 > lat) and lon < (lon2 - lon1) * (lat - lat1) / (lat2 - lat1) + lon1:
            odd = not odd
    return odd


@pytest.mark.parametrize("cell", [0.5, 1.0, 3.7, 100.0])
def test_square(spark, cell):
    spots = [(1, 1), (3, 2), (5, 1), (-1, -1), (1, 1), (2, -0.5), (2, 4.5)]
    got = op.points_inside(points(spark, spots), polygons(spark, {7: SQUARE}), cell_degrees=cell)
    assert sorted(tuple(r) for r in got.collect()) == [(1.0, 1.0, 7), (3.0, 2.0, 7)]


@pytest.mark.parametrize("cell", [0.3, 2.0])
def test_many_shapes_against_brute_force(spark, cell):
    rng = random.Random(5)
    shapes = {n: [(rng.uniform(-5, 5), rng.uniform(-5, 5)) for _ in range(rng.randint(3, 9))]
              for n in range(12)}
    spots = [(rng.uniform(-6, 6), rng.uniform(-6, 6)) for _ in range(120)]
    got = op.points_inside(points(spark, spots), polygons(spark, shapes), cell_degrees=cell)
    want = {(*p, n) for p in spots for n, ring in shapes.items() if crosses(p, ring)}
    assert {tuple(r) for r in got.collect()} == want


def test_unusable_polygons_hold_nothing(spark):
    shapes = {1: SQUARE[:2], 2: [*SQUARE[:3], (float("nan"), 0.0)], 3: SQUARE}
    vertices = polygons(spark, shapes)
    gap = polygons(spark, {4: SQUARE + [(2.0, -1.0)]}).where("vertex_no <> 2")
    everything = vertices.unionByName(gap)
    assert {r["polygon_id"] for r in op.valid_polygons(everything).collect()} == {3}
    got = op.points_inside(points(spark, [(1, 1)]), everything, cell_degrees=1.0)
    assert [r["polygon_id"] for r in got.collect()] == [3]


def test_points_without_a_position_are_outside(spark):
    spots = spark.createDataFrame([(None, 1.0), (1.0, float("nan"))], "lat DOUBLE, lon DOUBLE")
    assert op.points_inside(spots, polygons(spark, {1: SQUARE})).count() == 0


def test_edges_close_the_ring(spark):
    edges = op.polygon_edges(polygons(spark, {1: SQUARE})).collect()
    assert {((e["lat1"], e["lon1"]), (e["lat2"], e["lon2"])) for e in edges} == set(
        zip(SQUARE, SQUARE[1:] + SQUARE[:1]))


def test_covered_positions_are_on_land_and_in_the_city(spark):
    land = polygons(spark, {1: SQUARE}, "industrial").unionByName(
        polygons(spark, {2: [(4, 4), (4, 8), (8, 8), (8, 4)]}, "forest"))
    land = land.unionByName(polygons(spark, {3: SQUARE}, "commercial"))     # the same again
    city = polygons(spark, {9: [(-1, -1), (-1, 2), (9, 2), (9, -1)]}, "city")
    spots = [(1, 1), (1, 3), (5, 5), (1, 1), (8, 1)]
    got = op.covered_positions(points(spark, spots), land, city, cell_degrees=1.0)
    assert sorted(r["id"] for r in got.collect()) == [0, 3]


def test_no_cross_join(spark):
    plan = op.points_inside(points(spark, [(1, 1)]), polygons(spark, {1: SQUARE}), cell_degrees=1.0)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text


# Cells, holes and validity -----------------------------------------------------------

def rings(spark, shapes):
    rows = [(pid, no, i, float(lat), float(lon)) for pid, found in shapes.items() for no, ring in enumerate(found)
            for i, (lat, lon) in enumerate(ring)]
    return spark.createDataFrame(rows, "polygon_id LONG, ring_no INT, vertex_no INT, lat DOUBLE, lon DOUBLE")


def star(n, r=5.0, at=(0.0, 0.0)):
    import math
    return [(at[0] + (r if i % 2 else r / 2) * math.sin(2 * math.pi * i / n),
             at[1] + (r if i % 2 else r / 2) * math.cos(2 * math.pi * i / n)) for i in range(n)]


@pytest.mark.parametrize("cell", [0.25, 4.0])
def test_points_on_the_grid_and_on_vertices(spark, cell):
    """Shapes and points on multiples of the cell, where corners, sides and edges meet."""
    rng = random.Random(7)
    spot = lambda: (rng.randint(-8, 8) / 2, rng.randint(-8, 8) / 2)
    shapes = {n: [spot() for _ in range(rng.randint(3, 8))] for n in range(30)}
    shapes = {n: ring for n, ring in shapes.items() if ring[0] != ring[-1]}
    spots = [spot() for _ in range(80)] + [(a / 3, b / 7) for a, b in (spot() for _ in range(80))]
    got = op.points_inside(points(spark, spots), polygons(spark, shapes), cell_degrees=cell)
    want = {(*p, n) for p in spots for n, ring in shapes.items() if crosses(p, ring)}
    assert {tuple(r) for r in got.collect()} == want


def test_holes_and_closed_rings(spark):
    hole = [(1.0, 1.0), (1.0, 3.0), (3.0, 3.0), (3.0, 1.0), (1.0, 1.0)]
    vertices = rings(spark, {1: [SQUARE + SQUARE[:1], hole], 2: [SQUARE]})
    got = op.points_inside(points(spark, [(0.5, 0.5), (2, 2), (2, 3.5)]), vertices, cell_degrees=0.7)
    assert sorted(map(tuple, got.collect())) == [(0.5, 0.5, 1), (0.5, 0.5, 2), (2.0, 2.0, 2), (2.0, 3.5, 1), (2.0, 3.5, 2)]


def test_the_index_grows_with_the_outline(spark):
    shapes = polygons(spark, {1: star(40), 2: SQUARE})
    sizes = [op.polygon_cells(op.polygon_edges(shapes), cell).count() for cell in (0.1, 0.05, 0.025)]
    # Twice the resolution: twice the cells along the outline, not four times.
    assert sizes[1] < 2.4 * sizes[0] and sizes[2] < 2.4 * sizes[1]
    wide = polygons(spark, {1: [(0.0, 0.0), (0.0, 1000.0), (1000.0, 1000.0), (1000.0, 0.0)]})
    index = op.polygon_cells(op.polygon_edges(wide), 1.0)
    inner = index.where("lat1 IS NULL AND level > 0").count()
    assert 0 < inner < 25 * 1000
    spots = [(500.5, 500.5), (999.5, 0.5), (500.5, 1000.5)]
    assert op.points_inside(points(spark, spots), wide, cell_degrees=1.0).count() == 2


def test_invalid_polygons(spark):
    inner = [(1, 1), (1, 2), (2, 2), (2, 1)]
    spike = [(0, 0), (0, 4), (4, 4), (4, 2), (4, 3), (4, 0)]
    shapes = {
        1: [SQUARE], 2: [SQUARE, inner], 3: [SQUARE + SQUARE[:1], inner + inner[:1]],
        4: [[(0, 0), (4, 4), (0, 4), (4, 0)]],                             # a bow tie
        5: [SQUARE, [(1, 3), (1, 6), (2, 6), (2, 3)]],                     # a hole across the outline
        6: [SQUARE, [(5, 5), (5, 6), (6, 6)]], 7: [SQUARE, [(-1, -1), (-1, 9), (9, 9), (9, -1)]],
        8: [[(-9, -9), (-9, 9), (9, 9), (9, -9)], [(-5, -5), (-5, 5), (5, 5), (5, -5)], inner],   # nested holes
        9: [[(0, 0), (0, 0), (0, 4), (4, 4)]], 10: [SQUARE[:2]], 11: [spike],
        12: [SQUARE, [(0, 2), (1, 1), (1, 3)]],                            # touches the outline at a point
        13: [[(0, 0), (2, 2), (0, 4), (4, 4), (2, 2), (4, 0)]],            # touches itself
        14: [star(300)], 15: [[(0, 0), (0, 0.001), (0.002, 900), (-900, 0.0005)]],  # long and short sides
        16: [SQUARE, [(0, 1), (0, 3), (1, 2)]],                            # shares a side with the outline
        17: [SQUARE, inner, [(2, 2), (2, 3), (3, 3)]],                     # holes that touch
    }
    got = {r["polygon_id"]: r["reason"] for r in op.invalid_polygons(rings(spark, shapes), 0.7).collect()}
    want = {4: "crossing", 5: "crossing", 6: "hole", 7: "hole", 8: "hole", 9: "repeated", 10: "vertices",
            11: "crossing", 13: "crossing", 16: "crossing"}
    assert got == want
    assert op.invalid_polygons(rings(spark, {1: [SQUARE]}).where("lat > 99")).count() == 0


def test_crossing_edges_against_brute_force(spark):
    rng = random.Random(3)
    shapes = {n: [[(rng.uniform(0, 1), rng.uniform(0, 1)) for _ in range(rng.randint(3, 7))]] for n in range(150)}

    def turn(a, b, p):
        return (b[1] - a[1]) * (p[0] - a[0]) - (b[0] - a[0]) * (p[1] - a[1])

    def crossed(ring):
        sides = list(zip(ring, ring[1:] + ring[:1]))
        return any(turn(*s, t[0]) * turn(*s, t[1]) < 0 and turn(*t, s[0]) * turn(*t, s[1]) < 0
                   for i, s in enumerate(sides) for t in sides[i + 1:])

    got = {r["polygon_id"] for r in op.crossing_edges(op.polygon_edges(rings(spark, shapes))).collect()}
    want = {n for n, (ring,) in shapes.items() if crossed(ring)}
    assert got == want and 20 < len(want) < 140
