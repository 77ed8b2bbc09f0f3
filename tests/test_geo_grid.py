"""The grid index against plain ray casts and distances to all edges."""

import math

import numpy as np
import pytest
from pyspark.sql import Row

from annoflow.operators import geo

SCHEMA = "iso_a2 string, ord int, rings array<array<struct<lon:double,lat:double>>>"


def star(rng, n, x, y, size):
    """A jagged ring around (x, y)."""
    angle = np.sort(rng.uniform(0, 2 * math.pi, n))
    r = size * rng.uniform(0.4, 1.0, n)
    return np.stack([x + r * np.cos(angle), y + r * np.sin(angle)], axis=1)


def brute(shapes, points):
    """Code of each point: the first shape it is in, else the nearest, the first of equals."""
    best = np.full(len(points), -1)
    distance = np.full((len(shapes), len(points)), np.inf)
    for i, (_, rings) in enumerate(shapes):
        odd = np.zeros(len(points), dtype=int)
        for ring in rings:
            a, b = ring, np.roll(ring, 1, axis=0)
            for lo in range(0, len(points), 200):
                p = points[lo:lo + 200]
                px, py = p[:, :1], p[:, 1:]
                with np.errstate(all="ignore"):
                    cross = (b[:, 0] - a[:, 0]) * (py - a[:, 1]) / (b[:, 1] - a[:, 1]) + a[:, 0]
                odd[lo:lo + 200] += (((a[:, 1] > py) != (b[:, 1] > py)) & (px < cross)).sum(axis=1)
                d = b - a
                len2 = (d * d).sum(axis=1)
                t = np.clip(((px - a[:, 0]) * d[:, 0] + (py - a[:, 1]) * d[:, 1]) / np.where(len2 == 0, 1, len2), 0, 1)
                dist = np.hypot(px - a[:, 0] - t * d[:, 0], py - a[:, 1] - t * d[:, 1]).min(axis=1)
                distance[i, lo:lo + 200] = np.minimum(distance[i, lo:lo + 200], dist)
        inside = (odd % 2 == 1) & (distance[i] > 0)
        best[inside & (best < 0)] = i
    return [shapes[i if i >= 0 else int(np.argmin(distance[:, k]))][0] for k, i in enumerate(best)]


def check(spark, shapes, points, cell=1.0):
    countries = spark.createDataFrame([Row(iso_a2=c, ord=i, rings=[[{"lon": float(x), "lat": float(y)} for x, y in r] for r in rings])
                                       for i, (c, rings) in enumerate(shapes)], SCHEMA)
    pts = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id int, longitude double, latitude double")
    got = {r.id: r.country_code for r in geo.country_of_points(pts, countries, cell=cell).collect()}
    want = brute(shapes, points)
    assert [i for i in range(len(points)) if got[i] != want[i]] == []


@pytest.mark.parametrize("cell", [0.5, 1.0, 8.0])
def test_random_shapes(spark, cell):
    """Overlapping jagged shapes, one with a hole and one of two parts; points in, near and far from them."""
    rng = np.random.default_rng(3)
    shapes = [("AA", [star(rng, 900, 0, 0, 12)]), ("BB", [star(rng, 60, 8, 3, 6), star(rng, 20, 40, -30, 2)]),
              ("CC", [star(rng, 400, -20, 10, 7), star(rng, 50, -20, 10, 1.5)]), ("DD", [star(rng, 3, 0.3, 0.7, 0.1)])]
    points = np.concatenate([rng.uniform(-30, 30, (10_000 if cell == 1.0 else 600, 2)), rng.uniform(-170, 170, (60, 2)),
                             np.round(rng.uniform(-14, 14, (300, 2)))])
    check(spark, shapes, points, cell)


def test_borders_on_cell_borders(spark):
    """Rectangles and diagonals whose edges and corners lie on cell borders; points on all of them."""
    box = lambda x, y, w, h: np.array([[x, y], [x + w, y], [x + w, y + h], [x, y + h]], dtype=float)
    shapes = [("AA", [box(0, 0, 3, 2)]), ("BB", [box(3, 0, 2, 2)]), ("CC", [np.array([[0, 2], [2, 4], [4, 2], [2, 3]], dtype=float)]),
              ("DD", [box(-4, -4, 12, 12), box(-3, -3, 10, 10)])]
    x, y = np.meshgrid(np.arange(-5, 9, 0.25), np.arange(-5, 9, 0.25))
    check(spark, shapes, np.stack([x.ravel(), y.ravel()], axis=1))


def test_a_hundred_thousand_vertices(spark):
    rng = np.random.default_rng(5)
    shapes = [("AA", [star(rng, 100_000, 0, 0, 20)]), ("BB", [star(rng, 1000, 50, 0, 20)])]
    check(spark, shapes, rng.uniform(-40, 70, (600, 2)) * [1, 0.5])


def test_points_meet_cells_and_nothing_else(spark):
    countries = spark.createDataFrame([Row(iso_a2="AA", ord=0, rings=[[]]), Row(iso_a2="BB", ord=1, rings=[])], SCHEMA)
    assert geo.country_grid(countries).count() == 0
    square = [[{"lon": x, "lat": y} for x, y in ((0.0, 0.0), (9.5, 0.0), (9.5, 9.5), (0.0, 9.5))]]
    grid = geo.country_grid(spark.createDataFrame([Row(iso_a2="AA", ord=0, rings=square)], SCHEMA)).collect()
    assert sum(not r.edges for r in grid) == 64 and max(len(r.edges) for r in grid) == 2  # cells 1 to 8 lie wholly inside
