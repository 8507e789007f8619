"""Plans painted by runs against plans painted pixel by pixel."""

import random

import numpy as np
import pytest

from skein.operators import raster
from skein.plans import floor_plans
from tests.test_layout import as_array

ROLES = {"outside": 0, "wall": 1, "floor": 2, "light": 3, "windscreen": 4, "ramp": 5}
RECTS = "array<struct<x:int,y:int,w:int,h:int>>"
SCHEMA = f"image_id int, width int, height int, thickness int, rooms {RECTS}, corridors {RECTS}, extra_walls {RECTS}, doors {RECTS}, windscreen struct<side:string,thickness:int,frac:double>, ramp struct<side:string,x_frac:double,width_frac:double>, lights_room int, lights_corridor int"


def fill(a, x0, y0, x1, y1, v):
    a[max(y0, 0) : max(y1, 0), max(x0, 0) : max(x1, 0)] = v


def plain(width, height, t, rooms=(), corridors=(), extra_walls=(), doors=(), windscreen=None, ramp=None, lights_room=0, lights_corridor=0):
    a = np.zeros((height, width), int)
    for x, y, w, h in [*(rooms or ()), *(corridors or ()), *(extra_walls or ())]:
        fill(a, x, y, x + w, y + h, 1)
        fill(a, x + t, y + t, x + w - t, y + h - t, 2)
    for x, y, w, h in doors or ():
        fill(a, x, y, x + w, y + h, 2)
    if rooms and windscreen:
        side, thick, frac = windscreen
        x, y, w, h = rooms[0]
        thick = t if thick is None else thick
        n = int((w if side in ("north", "south") else h) * (0.5 if frac is None else frac))
        bx, by = x + (w - n) // 2, y + (h - n) // 2
        fill(a, *{"north": (bx, y, bx + n, y + thick), "south": (bx, y + h - thick, bx + n, y + h), "west": (x, by, x + thick, by + n), "east": (x + w - thick, by, x + w, by + n)}[side], 4)
    if rooms and ramp:
        side, at, share = ramp
        x, y, w, h = rooms[0]
        start, length = (x, w) if side in ("north", "south") else (y, h)
        n = int(length * share)
        p = max(start, start + int(length * at) - n // 2)
        q = min(start + length, p + n)
        fill(a, *{"north": (p, 0, q, y + t), "south": (p, y + h - t, q, height), "west": (0, p, x + t, q), "east": (x + w - t, p, width, q)}[side], 5)
    yy, xx = np.mgrid[0:height, 0:width]
    for rects, count in ((rooms, lights_room), (corridors, lights_corridor)):
        inset, n = max(8, t // 2), max(1, (count or 0) // 4)
        for x, y, w, h in rects or () if count else ():
            for i in range(1, n + 1):
                px, py = x + int(w * i / (n + 1)), y + int(h * i / (n + 1))
                for cx, cy in ((px, y + inset), (px, y + h - inset), (x + inset, py), (x + w - inset, py)):
                    a[(xx - cx) ** 2 + (yy - cy) ** 2 <= inset * inset] = 3
    return a


def test_plans_are_painted_as_pixel_by_pixel(spark):
    r = random.Random(4)
    rect = lambda: (r.randrange(90), r.randrange(60), r.randrange(20, 70), r.randrange(20, 60))
    plans = []
    for i in range(24):
        rects = lambda k: [rect() for _ in range(r.randrange(k))] or r.choice([[], None])  # noqa: E731, B023
        rooms = [rect() for _ in range(r.randrange(1, 4))] if i else None
        ws = r.choice([None, (r.choice(["north", "south", "east", "west"]), r.choice([None, 6]), r.choice([None, 0.37]))])
        rp = r.choice([None, (r.choice(["north", "south", "east", "west"]), r.choice([0.1, 0.5, 0.93]), r.choice([0.25, 0.6]))])
        plans.append((i, r.randrange(120, 170), r.randrange(90, 130), r.choice([3, 8, 20]), rooms, rects(3), rects(2), rects(3), ws, rp, r.choice([0, 4, 9]), r.choice([None, 0, 6])))
    runs = floor_plans.painted(spark.createDataFrame(plans, SCHEMA), ROLES).collect()
    for i, w, h, *how in plans:
        assert (as_array([x for x in runs if x.image_id == i], h, w) == plain(w, h, *how)).all(), (i, how)


def test_presets_are_plans_with_connected_floors(spark):
    wanted = spark.createDataFrame([(i, k) for i, k in enumerate(floor_plans.PRESETS)], "image_id int, preset string")
    plans = floor_plans.preset_plans(wanted)
    rows = {r.image_id: r for r in plans.collect()}
    runs = floor_plans.painted(plans, ROLES).collect()
    for i, (name, preset) in enumerate(floor_plans.PRESETS.items()):
        p = rows[i]
        assert (p.width, p.height, p.thickness) == preset["canvas"] and len(p.rooms) == len(preset["rooms"]) and len(p.doors) == len(preset["doors"])
        got = as_array([x for x in runs if x.image_id == i], p.height, p.width)
        tuples = lambda v: [tuple(e) for e in v]
        assert (got == plain(p.width, p.height, p.thickness, tuples(p.rooms), tuples(p.corridors), (), tuples(p.doors), None, None, p.lights_room, p.lights_corridor)).all(), name
        walkable = raster.label((got[::8, ::8] == 2) | (got[::8, ::8] == 3))
        assert np.bincount(walkable.ravel())[1:].max() > 0.9 * (walkable > 0).sum(), name  # doors join the rooms
    assert rows[0].rooms[0].asDict() == {"x": 0, "y": 0, "w": 640, "h": 640} and rows[0].doors[0].asDict() == {"x": 608, "y": 272, "w": 32, "h": 96}
    with pytest.raises(Exception, match="unknown preset"):
        floor_plans.preset_plans(spark.createDataFrame([(1, "igloo")], "image_id int, preset string")).collect()


def test_deck_variants_keep_the_hull(spark):
    plan = spark.createDataFrame([("s", 300, 200, 10, [(30, 20, 240, 150)])], f"image_id string, width int, height int, thickness int, rooms {RECTS}")
    base = floor_plans.painted(plan, ROLES)
    assert floor_plans.hulls(base, 0).first().hull.asDict() == {"x": 30, "y": 20, "w": 240, "h": 150}
    openings = [(1, "ramp", "south"), (1, "windscreen", "north"), (3, "ramp", "west"), (3, "windscreen", "east")]
    got = floor_plans.deck_variants(base, openings, 3, ROLES, depth=30).collect()
    a = as_array(base.collect(), 200, 300)
    for deck, cuts in ((1, [(30 + (240 - 79) // 2, 140, 79, 30, 5), (30 + (240 - 79) // 2, 20, 79, 30, 4)]), (2, []), (3, [(30, 20 + (150 - 64) // 2, 30, 64, 5), (240, 20 + (150 - 64) // 2, 30, 64, 4)])):
        want = a.copy()
        for x, y, w, h, v in cuts:
            fill(want, x, y, x + w, y + h, v)
        assert (as_array([r for r in got if r.image_id == f"s_deck{deck}"], 200, 300) == want).all(), deck
    with pytest.raises(ValueError, match="beyond 1"):
        floor_plans.deck_variants(base, openings, 1, ROLES)
    with pytest.raises(Exception, match="no hull"):
        floor_plans.deck_variants(base.where("y < 5"), openings, 3, ROLES).collect()


def rgba(spark, images):
    rows = [(i, y, x, *map(int, v)) for i, a in images.items() for y, line in enumerate(a) for x, v in enumerate(line)]
    return spark.createDataFrame(rows, "image_id int, y int, x int, r int, g int, b int, a int")


def test_turned_and_trimmed(spark):
    r = np.random.default_rng(3)
    images = {0: r.integers(0, 256, (7, 9, 4)), 1: r.integers(0, 256, (4, 4, 4)), 2: np.zeros((3, 5, 4), int)}
    images[0][:2, :, 3] = 0
    images[0][:, 7:, 3] = 0
    images[1][..., 3] = 0
    images[1][2, 1, 3] = 9
    px = rgba(spark, images)
    size = spark.createDataFrame([(i, a.shape[1], a.shape[0]) for i, a in images.items()], "image_id int, w int, h int")
    for side, quarters in raster.TURNS.items():
        rows = raster.facing(px, size, side).collect()
        for i, a in images.items():
            want = np.rot90(a, quarters)
            ys, xs = np.nonzero(want[..., 3])
            want = want[ys.min() : ys.max() + 1, xs.min() : xs.max() + 1] if len(ys) else want
            got = {(p.y, p.x): (p.r, p.g, p.b, p.a) for p in rows if p.image_id == i}
            assert got == {(y, x): tuple(want[y, x]) for y in range(want.shape[0]) for x in range(want.shape[1])}, (side, i)


def test_rims(spark):
    from pyspark.sql import functions as F

    grid = spark.range(40 * 60).selectExpr("id div 60 y", "id % 60 x")
    got = {(r.y, r.x) for r in grid.where(raster.in_rim(F.col("y"), F.col("x"), F.lit(40), F.lit(60), 6, 3)).collect()}
    m = np.zeros((40, 60), bool)
    m[6:9, 6:54] = m[31:34, 6:54] = m[6:34, 6:9] = m[6:34, 51:54] = True
    assert got == {(int(y), int(x)) for y, x in zip(*np.nonzero(m))}
    mask = np.zeros((12, 12), bool)
    mask[3:9, 3:9] = True
    rim = raster.gradient(mask)
    assert rim.sum() == 8 * 8 - 4 * 4 and not rim[5:7, 5:7].any() and rim[2:10, 2].all()


def test_guides(spark):
    r = np.random.default_rng(5)
    alpha = {"a": r.integers(0, 256, (5, 6)), "b": r.choice([0, 255], (4, 4))}
    symbols = spark.createDataFrame([(k, y, x, int(v)) for k, a in alpha.items() for y, line in enumerate(a) for x, v in enumerate(line)], "symbol string, y int, x int, a int")
    places = [(0, 0, "a", 2, 1), (0, 1, "b", 5, 3), (0, 2, "a", -3, 7), (1, 0, "b", 10, 10)]
    canvas = spark.createDataFrame([(i, y, x) for i in (0, 1, 2) for y in range(11) for x in range(12)], "image_id int, y int, x int")
    rows = raster.guides(canvas, symbols, spark.createDataFrame(places, "image_id int, z int, symbol string, x int, y int")).collect()
    want = np.full((3, 11, 12), 255)
    for i, _, s, x, y in places:
        for (dy, dx), v in np.ndenumerate(alpha[s]):
            if 0 <= y + dy < 11 and 0 <= x + dx < 12:
                want[i, y + dy, x + dx] = 255 - v
    assert {(p.image_id, p.y, p.x): p.v for p in rows} == {k: int(v) for k, v in np.ndenumerate(want)}
