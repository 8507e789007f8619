"""Vector maps as row runs: thick lines, discs and carved door spans, scan-converted by columns and painted in order.

A shape covers at most one run of pixels in a row, whose ends follow from its coordinates, so shapes become runs without a
canvas, and what is painted last is settled by row. Pixels lie at whole coordinates. A disc has the pixels within its
radius; a line of a width has those beside its stretch at a signed distance of at least minus half the width and under half
the width, so a straight one is as many pixels wide as it says, with flat ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
#: Painting order: later layers cover earlier ones; a layer has so many places.
WALLS, LIGHTS, DOORS, LAYER = 1, 2, 3, 1 << 40


def thickness(per_grid: Column, share: float) -> Column:
    """Pixels of a share of a grid square, rounded half to even, two at least."""
    return F.greatest(F.lit(2), F.bround(per_grid * F.lit(share)).cast("int"))


def strokes(lines: DataFrame, joints: str) -> DataFrame:
    """Lines and discs of lines(image_id, z, role, width, radius, points): a line between neighbouring points, and discs at
    `all` points or at the `inner` ones."""
    ends = F.zip_with(F.slice("points", 1, F.size("points") - 1), F.slice("points", 2, F.size("points") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    line = lines.where(F.size("points") > 1).select("image_id", "z", "role", F.lit("line").alias("kind"), (F.col("width") / 2.0).alias("half"), F.explode(ends).alias("e"))
    line = line.select("image_id", "z", "role", "kind", F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"), F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by"), "half")
    kept = F.col("points") if joints == "all" else F.slice("points", 2, F.greatest(F.size("points") - 2, F.lit(0)))
    disc = lines.select("image_id", "z", "role", F.col("radius").cast("double").alias("half"), F.explode(kept).alias("p"))
    return line.unionByName(discs(disc))


def discs(rows: DataFrame) -> DataFrame:
    """Discs of rows(image_id, z, role, half, p)."""
    x, y = F.col("p.x"), F.col("p.y")
    return rows.select("image_id", "z", "role", F.lit("disc").alias("kind"), x.alias("ax"), y.alias("ay"), x.alias("bx"), y.alias("by"), "half")


def map_shapes(maps: DataFrame, wall_share: float, light_share: float, roles: dict[str, int]) -> DataFrame:
    """image_id, z, role, kind, ax, ay, bx, by, half of maps(image_id, m: see sources.files.vector_map), in pixels.

    Walls are thick lines with discs at all their points, lights are discs, doors are carved half as wide again as walls along
    their span or, without one, as a disc. roles: of wall, light and door (the floor's, where a door is a gap).
    """
    ppg = F.col("m.per_grid")
    to_px = lambda p: F.struct(((p["x"] - F.col("m.origin.x")) * ppg).alias("x"), ((p["y"] - F.col("m.origin.y")) * ppg).alias("y"))
    wall = thickness(ppg, wall_share)
    carve = F.bround(wall * F.lit(1.5)).cast("int")
    z = lambda layer: (F.lit(layer * LAYER) + F.col("at")).alias("z")
    walls = maps.select("image_id", "m", F.posexplode("m.walls").alias("at", "line"))
    walls = walls.select("image_id", z(WALLS), F.lit(roles["wall"]).alias("role"), wall.alias("width"), F.floor(wall / 2).alias("radius"), F.transform("line", to_px).alias("points"))
    lights = maps.select("image_id", "m", F.posexplode("m.lights").alias("at", "l")).where("l.position.x is not null and l.position.y is not null")
    lights = lights.select("image_id", z(LIGHTS), F.lit(roles["light"]).alias("role"), thickness(ppg, light_share).cast("double").alias("half"), to_px(F.col("l.position")).alias("p"))
    doors = maps.select("image_id", "m", F.posexplode("m.portals").alias("at", "d"))
    doors = doors.select("image_id", z(DOORS), F.lit(roles["door"]).alias("role"), carve.alias("width"), (carve / 2.0).alias("radius"), F.transform("d.bounds", to_px).alias("points"), to_px(F.col("d.position")).alias("p"))
    spans = doors.where("size(points) >= 2")
    spots = doors.where("coalesce(size(points), 0) < 2 and p.x is not null and p.y is not null").select("image_id", "z", "role", F.floor(F.col("width") / 2).cast("double").alias("half"), "p")
    return strokes(walls, "all").unionByName(discs(lights)).unionByName(strokes(spans.drop("p"), "inner")).unionByName(discs(spots))


def canvases(maps: DataFrame) -> DataFrame:
    """image_id, width, height in pixels; a map without any is an error."""
    side = lambda c: F.bround(F.col(f"m.size.{c}") * F.col("m.per_grid")).cast("int")
    some = lambda c: F.when(c > 0, c).otherwise(F.raise_error(F.lit("a map without pixels")).cast("int"))
    return maps.select("image_id", some(side("x")).alias("width"), some(side("y")).alias("height"))


def scanned(shapes: DataFrame, canvas: DataFrame) -> DataFrame:
    """image_id, y, x0, x1 (exclusive), z, role: the run of each shape in each row of canvas(image_id, width, height) it reaches."""
    rows = shapes.join(canvas, "image_id")
    top = F.greatest(F.floor(F.least("ay", "by") - F.col("half")).cast("int"), F.lit(0))
    bottom = F.least(F.ceil(F.greatest("ay", "by") + F.col("half")).cast("int"), F.col("height") - 1)
    rows = rows.withColumns({"top": top, "bottom": bottom}).where("top <= bottom").withColumn("y", F.explode(F.sequence("top", "bottom")))
    far = F.lit(1 << 40).cast("double")
    dx, dy, down = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"), F.col("y") - F.col("ay")
    length2 = dx * dx + dy * dy
    reach = F.col("half") * F.sqrt(length2)
    # along the line: 0 <= (x - ax) dx + down dy <= length^2; a side that doesn't depend on x holds everywhere or nowhere
    along0, along1 = (-down * dy) / dx + F.col("ax"), (length2 - down * dy) / dx + F.col("ax")
    flat = (down * dy >= 0) & (down * dy <= length2)
    low_a = F.when(dx > 0, F.ceil(along0)).when(dx < 0, F.ceil(along1)).when(flat, -far).otherwise(far)
    high_a = F.when(dx > 0, F.floor(along1)).when(dx < 0, F.floor(along0)).when(flat, far).otherwise(-far)
    # across it: -reach <= (x - ax) dy - down dx < reach
    across0, across1 = (down * dx - reach) / dy + F.col("ax"), (down * dx + reach) / dy + F.col("ax")
    level = (-down * dx >= -reach) & (-down * dx < reach)
    low_c = F.when(dy > 0, F.ceil(across0)).when(dy < 0, F.floor(across1) + 1).when(level, -far).otherwise(far)
    high_c = F.when(dy > 0, F.ceil(across1) - 1).when(dy < 0, F.floor(across0)).when(level, far).otherwise(-far)
    rest = F.col("half") * F.col("half") - down * down
    wide = F.sqrt(rest)
    disc = F.col("kind") == "disc"
    x0 = F.when(disc, F.ceil(F.col("ax") - wide)).otherwise(F.greatest(low_a, low_c))
    x1 = F.when(disc, F.floor(F.col("ax") + wide)).otherwise(F.least(high_a, high_c))
    runs = rows.where((disc & (rest >= 0)) | (~disc & (length2 > 0))).select("image_id", "y", F.greatest(x0.cast("long"), F.lit(0)).alias("x0"), F.least(x1.cast("long") + 1, F.col("width")).alias("x1"), "z", "role", "width")
    return runs.where("x0 < x1").select("image_id", F.col("y").cast("long").alias("y"), "x0", "x1", "z", "role")


def rect_runs(shapes: DataFrame, canvas: DataFrame) -> DataFrame:
    """image_id, y, x0, x1, z, role: the rows of rectangles shapes(image_id, z, role, x0, y0, x1, y1), ends exclusive, inside canvas."""
    rows = shapes.join(canvas, "image_id")
    cut = rows.select("image_id", "z", "role", *[F.greatest(F.lit(0), F.least(F.col(c), F.col(side))).cast("long").alias(c) for c, side in (("x0", "width"), ("x1", "width"), ("y0", "height"), ("y1", "height"))])
    cut = cut.where("x0 < x1 and y0 < y1").withColumn("y", F.explode(F.sequence("y0", F.col("y1") - 1)))
    return cut.select("image_id", "y", "x0", "x1", "z", "role")


def painted_runs(canvas: DataFrame, runs: DataFrame, floor: int) -> DataFrame:
    """image_id, y, x0, x1, role: every row of every canvas as neighbouring runs of different roles, the floor's where nothing is.

    The runs of one row are cut at all their ends; each part has the role of the last run that covers it.
    """
    base = canvas.select("image_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("height").cast("long") - 1)).alias("y"), F.lit(0).cast("long").alias("x0"), F.col("width").cast("long").alias("x1"), F.lit(-1).cast("long").alias("z"), F.lit(floor).alias("role"))
    # rows of an image with the same runs, as those through the middle of a room, are cut once
    every = base.unionByName(runs).repartition("image_id").groupBy("image_id", "y").agg(F.sort_array(F.collect_set(F.struct("z", "role", "x0", "x1"))).alias("r"))
    row = every.groupBy("image_id", "r").agg(F.collect_list("y").alias("ys"))
    row = row.withColumn("cuts", F.array_sort(F.array_union("r.x0", "r.x1")))
    last = lambda at: F.array_max(F.transform(F.filter("r", lambda s: (s["x0"] <= at) & (at < s["x1"])), lambda s: F.struct(s["z"], s["role"])))["role"]
    row = row.withColumn("roles", F.transform(F.slice("cuts", 1, F.size("cuts") - 1), last))
    changes = F.filter(F.sequence(F.lit(0), F.size("roles") - 1), lambda i: (i == 0) | (F.get("roles", i) != F.get("roles", i - 1)))
    row = row.withColumn("at", changes)
    part = F.transform("at", lambda i, n: F.struct(F.get("cuts", i).alias("x0"), F.coalesce(F.get("cuts", F.get("at", n + 1)), F.array_max("cuts")).alias("x1"), F.get("roles", i).alias("role")))
    return row.select("image_id", "ys", F.inline(part)).select("image_id", F.explode("ys").alias("y"), "x0", "x1", "role")


def role_areas(runs: DataFrame) -> DataFrame:
    return runs.groupBy("image_id", "role").agg(F.sum(F.col("x1") - F.col("x0")).alias("pixels"))


def stray_roles(runs: DataFrame, allowed: Sequence[int]) -> DataFrame:
    """image_id, role, pixels of what is painted in a role that no palette entry stands for."""
    return role_areas(runs.where(~F.col("role").isin(*allowed)))


def as_pixels(runs: DataFrame) -> DataFrame:
    """image_id, y, x, role of every pixel."""
    return runs.select("image_id", "y", F.explode(F.sequence("x0", F.col("x1") - 1)).alias("x"), "role")
