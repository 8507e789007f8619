"""Runs against every pixel tested on its own."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.operators import layout
from skein.sources import files

SHAPE = "image_id int, z long, role int, kind string, ax double, ay double, bx double, by double, half double"


def covered(shape, h, w):
    """Pixels of a shape, one by one."""
    _, _, _, kind, ax, ay, bx, by, half = shape
    y, x = np.mgrid[0:h, 0:w].astype(float)
    if kind == "disc":
        return (x - ax) ** 2 + (y - ay) ** 2 <= half**2
    dx, dy = bx - ax, by - ay
    length = math.hypot(dx, dy)
    if not length:
        return np.zeros((h, w), bool)
    along, across = (x - ax) * dx + (y - ay) * dy, (x - ax) * dy - (y - ay) * dx
    return (along >= 0) & (along <= dx * dx + dy * dy) & (across >= -half * length) & (across < half * length)


def painted(shapes, h, w, floor=0):
    out = np.full((h, w), floor)
    for shape in sorted(shapes, key=lambda s: (s[1], s[2])):
        out[covered(shape, h, w)] = shape[2]
    return out


def as_array(rows, h, w):
    out = np.full((h, w), -1)
    for r in rows:
        assert (out[r.y, r.x0 : r.x1] == -1).all() and r.x0 < r.x1
        out[r.y, r.x0 : r.x1] = r.role
    assert (out >= 0).all()
    return out


@pytest.mark.parametrize("seed", range(4))
def test_lines_and_discs_are_those_of_a_pixel_test(spark, seed):
    r = random.Random(seed)
    h, w = 37, 53
    n = lambda a, b: float(r.randrange(a, b)) if seed % 2 else r.uniform(a, b)
    shapes = []
    for z in range(25):
        p = (n(-10, 60), n(-10, 50))
        kind = r.choice(["line", "disc", "level", "upright", "dot"])
        q = {"level": (n(-10, 60), p[1]), "upright": (p[0], n(-10, 50)), "line": (n(-10, 60), n(-10, 50))}.get(kind, p)
        shapes.append((0, z, r.randrange(1, 6), "disc" if kind == "disc" else "line", *p, *q, r.choice([0.5, 1.0, 2.0, 3.5, 7.0])))
    canvas = spark.createDataFrame([(0, w, h)], "image_id int, width int, height int")
    runs = layout.scanned(spark.createDataFrame(shapes, SHAPE), canvas)
    final = layout.painted_runs(canvas, runs, 0).collect()
    assert (as_array(final, h, w) == painted(shapes, h, w)).all()
    rows = sorted((x.y, x.x0, x.role) for x in final)
    assert all(a[2] != b[2] for a, b in zip(rows, rows[1:]) if a[0] == b[0])  # neighbouring runs differ


def test_straight_lines_are_as_wide_as_they_say(spark):
    for half, want in ((0.5, 1), (1.0, 2), (1.5, 3), (4.0, 8)):
        for ends in ((5.0, 20.0, 30.0, 20.0), (30.0, 20.0, 5.0, 20.0), (20.0, 5.0, 20.0, 30.0)):
            mask = covered((0, 0, 1, "line", *ends, half), 40, 40)
            assert {int(mask.sum(axis=i).max()) for i in (0, 1)} == {want, 26}


def doc(walls, portals="[]", lights="[]", grid=10):
    return f'{{"resolution": {{"map_size": {{"x": 6, "y": 4}}, "map_origin": {{"x": 1, "y": 0}}, "pixels_per_grid": {grid}}}, "line_of_sight": {walls}, "portals": {portals}, "lights": {lights}}}'


ROLES = {"floor": 1, "wall": 2, "light": 3, "door": 4}


def test_a_map_from_its_text(spark):
    walls = '[[{"x": 2, "y": 1}, {"x": 6, "y": 1}, {"x": 6, "y": 3}], [{"x": 3, "y": 3}]]'
    portals = '[{"position": {"x": 4, "y": 1}, "bounds": [{"x": 3.5, "y": 1}, {"x": 4.5, "y": 1}]}, {"position": {"x": 6, "y": 2}}, {"bounds": [{"x": 1, "y": 1}]}]'
    lights = '[{"position": {"x": 3, "y": 2}}, {"range": 3}]'
    maps = spark.createDataFrame([(7, doc(walls, portals, lights)), (8, doc("[]"))], "image_id int, t string").select("image_id", files.vector_map(F.col("t")).alias("m"))
    canvas = layout.canvases(maps)
    shapes = layout.map_shapes(maps, 0.4, 0.3, ROLES)
    runs = layout.painted_runs(canvas, layout.scanned(shapes, canvas), ROLES["floor"])
    got = as_array(runs.where("image_id = 7").collect(), 40, 60)
    wall, carve = 4, 6
    want = [(7, 1, 2, "line", 10, 10, 50, 10, wall / 2), (7, 1, 2, "line", 50, 10, 50, 30, wall / 2)]
    want += [(7, 1, 2, "disc", x, y, x, y, wall // 2) for x, y in ((10, 10), (50, 10), (50, 30), (20, 30))]
    want += [(7, 2, 3, "disc", 20, 20, 20, 20, 3), (7, 3, 4, "line", 25, 10, 35, 10, carve / 2), (7, 3, 4, "disc", 50, 20, 50, 20, carve // 2)]
    assert (got == painted(want, 40, 60, 1)).all()
    assert (as_array(runs.where("image_id = 8").collect(), 40, 60) == 1).all()
    assert {(r.image_id, r.role): r.pixels for r in layout.role_areas(runs).collect()} == {(7, int(k)): int((got == k).sum()) for k in np.unique(got)} | {(8, 1): 2400}
    assert layout.stray_roles(runs, [1, 2, 3, 4]).count() == 0
    assert [tuple(r) for r in layout.stray_roles(runs, [1, 2, 3]).collect()] == [(7, 4, int((got == 4).sum()))]
    assert layout.as_pixels(runs).where("image_id = 7 and role = 2").count() == (got == 2).sum()


def test_no_maps_and_maps_without_pixels(spark):
    maps = spark.createDataFrame([(1, doc("[]", grid=0))], "image_id int, t string").select("image_id", files.vector_map(F.col("t")).alias("m"))
    with pytest.raises(Exception, match="without pixels"):
        layout.canvases(maps).collect()
    none = maps.where("image_id > 1")
    canvas = layout.canvases(none)
    assert layout.painted_runs(canvas, layout.scanned(layout.map_shapes(none, 0.4, 0.3, ROLES), canvas), 1).count() == 0
