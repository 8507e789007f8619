"""Floor plans: rooms, corridors, raised walls, doors, a windscreen, a ramp and lights as painted runs; presets as a table.

A plan is a row of rectangles and of what is placed relative to an edge of its hull, the first room; variants of a plan get
openings relative to the hull that an aggregate finds in what is painted. Everything becomes runs of operators.layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.operators import layout
from skein.operators.tables import written

RECT = "struct<x:int,y:int,w:int,h:int>"
#: Painting order.
ROOMS, CORRIDORS, RAISED, DOORS, WINDSCREEN, RAMP, LIGHTS = range(1, 8)
#: Least inset and radius of a light, least width of an opening (fixed values).
LEAST_LIGHT, LEAST_OPENING = 8, 64

#: Plans over a canvas of w x h with walls of t pixels: size, walls and lights by default, and x, y, width, height of each part
#: (fixed values; `div` cuts fractions off).
PRESETS = {
    "hab-2room": {
        "canvas": (1280, 640, 32), "lights": (4, 4),
        "rooms": [("0", "0", "(w - t) div 2 + t div 2", "h"), ("(w - t) div 2 - t div 2", "0", "w - ((w - t) div 2 - t div 2)", "h")],
        "doors": [("(w - t) div 2 - t div 2", "(h - 96) div 2", "t", "96")],
    },
    "hab-3room-corridor": {
        "canvas": (1792, 1024, 32), "lights": (4, 6),
        "rooms": [("0", "0", "(w - t * 3) div 3", "(h - 224) div 2 + t"), ("w - (w - t * 3) div 3", "0", "(w - t * 3) div 3", "(h - 224) div 2 + t"), ("(w - w div 2) div 2", "(h - 224) div 2 + 224 - t", "w div 2", "h - ((h - 224) div 2 + 224) + t")],
        "corridors": [("0", "(h - 224) div 2", "w", "224")],
        "doors": [("((w - t * 3) div 3 - 96) div 2", "(h - 224) div 2", "96", "t"), ("w - (w - t * 3) div 3 + ((w - t * 3) div 3 - 96) div 2", "(h - 224) div 2", "96", "t"), ("(w - w div 2) div 2 + (w div 2 - 96) div 2", "(h - 224) div 2 + 224 - t", "96", "t")],
    },
    "tunnel-junction": {
        "canvas": (1536, 1536, 32), "lights": (4, 6),
        "rooms": [("w div 2 - 160", "h div 2 - 160", "320", "320")],
        "corridors": [("0", "h div 2 - 112", "w div 2", "224"), ("w div 2", "h div 2 - 112", "w - w div 2", "224"), ("w div 2 - 112", "0", "224", "h div 2")],
        "doors": [("w div 2 - 160", "h div 2 - 48", "t", "96"), ("w div 2 + 160 - t", "h div 2 - 48", "t", "96"), ("w div 2 - 48", "h div 2 - 160", "96", "t")],
    },
    "chapel-nave-with-apse": {
        "canvas": (1280, 1792, 32), "lights": (6, 4),
        "rooms": [("(w - w * 3 div 4) div 2", "0", "w * 3 div 4", "h div 4"), ("0", "h div 4 - t", "w", "h - (h div 4 - t)")],
        "doors": [("(w - w * 3 div 4) div 2 + (w * 3 div 4 - 128) div 2", "h div 4 - t", "128", "t"), ("(w - 128) div 2", "h - t", "128", "t")],
    },
    "industrial-bay": {
        "canvas": (2048, 1024, 48), "lights": (8, 4),
        "rooms": [("0", "0", "w * 3 div 4 + t", "h"), ("w * 3 div 4", "(h - h div 2) div 2", "w - w * 3 div 4", "h div 2")],
        "doors": [("w * 3 div 4", "(h - h div 2) div 2 + (h div 2 - 128) div 2", "t", "128")],
    },
}


def preset_plans(wanted: DataFrame) -> DataFrame:
    """A plan for each row of wanted(image_id, preset, and perhaps width, height, thickness); an unknown preset is an error."""
    name = F.col("preset")
    known = wanted.sparkSession.createDataFrame([(k, *v["canvas"], *v["lights"]) for k, v in PRESETS.items()], "known string, w_ int, h_ int, t_ int, lights_room int, lights_corridor int")
    rows = wanted.join(F.broadcast(known), name == F.col("known"), "left").where(F.when(F.col("known").isNull(), F.raise_error(F.lit("unknown preset")).cast("boolean")).otherwise(True))
    given = lambda c, default: F.coalesce(F.col(c).cast("int"), default) if c in wanted.columns else F.col(default)
    sized = rows.select("image_id", "preset", given("width", "w_").alias("w"), given("height", "h_").alias("h"), given("thickness", "t_").alias("t"), "lights_room", "lights_corridor")

    def part(field: str) -> Column:
        out = F.array().cast(f"array<{RECT}>")
        for k, v in PRESETS.items():
            if field in v:
                rects = [F.struct(*[F.expr(e).cast("int").alias(c) for e, c in zip(r, "xywh")]) for r in v[field]]
                out = F.when(name == k, F.array(*rects)).otherwise(out)
        return out.alias(field)

    none = F.array().cast(f"array<{RECT}>")
    plans = sized.select("image_id", F.col("w").alias("width"), F.col("h").alias("height"), F.col("t").alias("thickness"), part("rooms"), part("corridors"), none.alias("extra_walls"), part("doors"), "lights_room", "lights_corridor")
    return written(plans)  # every kind of part reads it; without a table each would evaluate all presets' formulas anew


def along_edge(hull: Column, side: Column, start: Column, length: Column, near: Column, far: Column) -> Column:
    """x0, y0, x1, y1 of a band along a side of a hull: from `start` so long, and from `near` to `far` inwards of the edge
    (negative: outwards)."""
    level, first = side.isin("north", "south"), side.isin("north", "west")
    edge = F.when(first, F.when(level, hull["y"]).otherwise(hull["x"])).otherwise(F.when(level, hull["y"] + hull["h"]).otherwise(hull["x"] + hull["w"]))
    low, high = F.when(first, edge + near).otherwise(edge - far), F.when(first, edge + far).otherwise(edge - near)
    pick = lambda a, b: F.when(level, a).otherwise(b)
    return F.struct(pick(start, low).alias("x0"), pick(low, start).alias("y0"), pick(start + length, high).alias("x1"), pick(high, start + length).alias("y1"))


def span(hull: Column, side: Column) -> tuple[Column, Column]:
    """Start and length of a side of a hull."""
    level = side.isin("north", "south")
    return F.when(level, hull["x"]).otherwise(hull["y"]), F.when(level, hull["w"]).otherwise(hull["h"])


def half(x: Column) -> Column:
    return F.floor(x / 2).cast("int")


def z(layer: int, at: Column | None = None, part: int = 0) -> Column:
    """Place in painting order: layer, then member of a list, then wall before floor."""
    return (F.lit(layer * layout.LAYER + part) + (F.lit(0) if at is None else at) * 2).alias("z")


def rectangles(plans: DataFrame, roles: dict[str, int]) -> DataFrame:
    """image_id, z, role, x0, y0, x1, y1 of everything of plans but the lights."""
    t, out = F.col("thickness"), []
    box = lambda e, inset: F.struct((e["x"] + inset).alias("x0"), (e["y"] + inset).alias("y0"), (e["x"] + e["w"] - inset).alias("x1"), (e["y"] + e["h"] - inset).alias("y1"))
    for layer, field in ((ROOMS, "rooms"), (CORRIDORS, "corridors"), (RAISED, "extra_walls"), (DOORS, "doors")):
        if field not in plans.columns:
            continue
        each = plans.select("image_id", "thickness", F.posexplode(field).alias("at", "e"))
        kinds = [("floor", F.lit(0))] if layer == DOORS else [("wall", F.lit(0)), ("floor", t)]
        out += [each.select("image_id", z(layer, F.col("at"), i), F.lit(roles[role]).alias("role"), box(F.col("e"), inset).alias("b")) for i, (role, inset) in enumerate(kinds)]
    hull = F.get("rooms", F.lit(0))
    if "windscreen" in plans.columns:
        w = F.col("windscreen")
        start, length = span(hull, w["side"])
        wide = (length * F.coalesce(w["frac"], F.lit(0.5))).cast("int")
        band = along_edge(hull, w["side"], start + half(length - wide), wide, F.lit(0), F.coalesce(w["thickness"], t))
        out.append(plans.where(w["side"].isNotNull() & hull.isNotNull()).select("image_id", z(WINDSCREEN), F.lit(roles["windscreen"]).alias("role"), band.alias("b")))
    if "ramp" in plans.columns:
        r = F.col("ramp")
        start, length = span(hull, r["side"])
        wide = (length * F.coalesce(r["width_frac"], F.lit(0.25))).cast("int")
        first = F.greatest(start, start + (length * F.coalesce(r["x_frac"], F.lit(0.5))).cast("int") - half(wide))
        whole = F.greatest("width", "height")  # from the hull out to the canvas's edge, where it is cut
        band = along_edge(hull, r["side"], first, F.least(start + length, first + wide) - first, -whole, t)
        out.append(plans.where(r["side"].isNotNull() & hull.isNotNull()).select("image_id", z(RAMP), F.lit(roles["ramp"]).alias("role"), band.alias("b")))
    every = out[0]
    for o in out[1:]:
        every = every.unionByName(o)
    return every.select("image_id", "z", "role", "b.*")


def lights(plans: DataFrame, role: int) -> DataFrame:
    """Discs evenly along the four sides of rooms and corridors: a quarter of a count on each side, one at least, none for 0."""
    inset = F.greatest(F.lit(LEAST_LIGHT), half(F.col("thickness")))
    out = []
    for field, count in (("rooms", "lights_room"), ("corridors", "lights_corridor")):
        if field in plans.columns and count in plans.columns:
            each = plans.where(F.col(count) > 0).select("image_id", inset.alias("inset"), F.greatest(F.lit(1), F.floor(F.col(count) / 4).cast("int")).alias("n"), F.explode(field).alias("e"))
            each = each.select("*", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"))
            at = lambda a, b: (F.col(f"e.{a}") + (F.col(f"e.{b}") * F.col("i") / (F.col("n") + 1)).cast("int")).cast("double")
            low, high = (lambda a: (F.col(f"e.{a}") + F.col("inset")).cast("double")), (lambda a, b: (F.col(f"e.{a}") + F.col(f"e.{b}") - F.col("inset")).cast("double"))
            points = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((at("x", "w"), low("y")), (at("x", "w"), high("y", "h")), (low("x"), at("y", "h")), (high("x", "w"), at("y", "h")))])
            out.append(each.select("image_id", z(LIGHTS), F.lit(role).alias("role"), F.col("inset").cast("double").alias("half"), F.explode(points).alias("p")))
    every = out[0]
    for o in out[1:]:
        every = every.unionByName(o)
    return layout.discs(every)


#: Plans of a part.
PART = 512


def spread(plans: DataFrame) -> DataFrame:
    """plans in parts by image_id whose number follows theirs: a few bytes of a plan become thousands of runs, which a file of
    plans would leave to one task."""
    return plans.repartition(-(-plans.count() // PART) or 1, "image_id")


def painted(plans: DataFrame, roles: dict[str, int]) -> DataFrame:
    """image_id, y, x0, x1, role of plans(image_id, width, height, thickness, rooms, and perhaps corridors, extra_walls, doors,
    windscreen(side, thickness, frac), ramp(side, x_frac, width_frac), lights_room, lights_corridor).

    roles: of outside, wall, floor, light, and of windscreen and ramp where there are any. Without rooms there is no hull, and so
    neither windscreen nor ramp; null lists are empty; a plan of nothing is all outside.
    """
    plans = spread(plans)
    canvas = plans.select("image_id", "width", "height")
    runs = layout.rect_runs(rectangles(plans, roles), canvas)
    if {"lights_room", "lights_corridor"} & {*plans.columns}:
        runs = runs.unionByName(layout.scanned(lights(plans, roles["light"]), canvas))
    return layout.painted_runs(canvas, runs, roles["outside"])


def hulls(runs: DataFrame, outside: int) -> DataFrame:
    """image_id and hull: the box around everything of runs that is not outside."""
    some = runs.where(F.col("role") != outside).groupBy("image_id").agg(F.min("x0").alias("x"), F.min("y").alias("y"), F.max("x1").alias("x1"), (F.max("y") + 1).alias("y1"))
    return some.select("image_id", F.struct(F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"), (F.col("x1") - F.col("x")).cast("int").alias("w"), (F.col("y1") - F.col("y")).cast("int").alias("h")).alias("hull"))


def deck_variants(runs: DataFrame, openings: Sequence[tuple[int, str, str]], decks: int, roles: dict[str, int], width_frac: float = 0.33, depth: int = 96) -> DataFrame:
    """image_id (`<base>_deck<n>`), y, x0, x1, role: so many copies of each base of runs, with the deck's openings (deck, role,
    side; see functions.text.side_spec) carved into the hull, in order; a base that is all outside is an error."""
    if any(not 1 <= deck <= decks for deck, _, _ in openings):
        raise ValueError(f"an opening of a deck beyond {decks}")
    named = F.concat(F.col("image_id").cast("string"), F.lit("_deck"), F.col("deck"))
    base = runs.select("*", F.explode(F.sequence(F.lit(1), F.lit(decks))).alias("deck")).select(named.alias("image_id"), "y", "x0", "x1", F.lit(0).cast("long").alias("z"), "role")
    canvas = base.groupBy("image_id").agg(F.max("x1").cast("int").alias("width"), (F.max("y") + 1).cast("int").alias("height"))
    box = runs.select("image_id").distinct().join(hulls(runs, roles["outside"]), "image_id", "left")
    box = box.withColumn("hull", F.when(F.col("hull").isNull(), F.raise_error(F.lit("no hull found")).cast(RECT)).otherwise(F.col("hull")))
    asked = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(deck).alias("deck"), F.lit(roles[role]).alias("role"), F.lit(side).alias("side")) for i, (deck, role, side) in enumerate(openings)])
    carved = box.select("image_id", "hull", F.inline(asked.cast("array<struct<ord:int,deck:int,role:int,side:string>>")))
    start, length = span(F.col("hull"), F.col("side"))
    wide = F.greatest(F.lit(LEAST_OPENING), (length * F.lit(width_frac)).cast("int"))
    band = along_edge(F.col("hull"), F.col("side"), start + half(length - wide), wide, F.lit(0), F.lit(depth))
    carved = carved.select(named.alias("image_id"), z(1, F.col("ord")), "role", band.alias("b")).select("image_id", "z", "role", "b.*")
    return layout.painted_runs(canvas, base.unionByName(layout.rect_runs(carved, canvas)), roles["outside"])
