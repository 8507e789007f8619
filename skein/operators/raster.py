"""Images as pixel tables (image_id, y, x, channels): pointwise and aggregate work in SQL; stencils and fills by image.

The per-image functions hold one image at a time, in numpy; everything else is columns and aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RGB = ("r", "g", "b")
#: Pixels of a part, about.
PART = 1 << 19


def dealt(images: DataFrame, pixels: int) -> DataFrame:
    """images, of about so many pixels each, in parts by image_id whose number follows the number of pixels: what is made of
    them needs no further exchange by image, and no task more memory as images become more."""
    return images.repartition(-(-images.count() * pixels // PART) or 1, "image_id")


def per_image(pixels: DataFrame, images: DataFrame, how: str = "inner") -> DataFrame:
    """pixels joined with a row of each image by image_id. Pixels that a generator makes seem to Spark as few as the rows they
    come from, so neither side is broadcast on such a guess: a task holds the images of its part, never pixels."""
    return pixels.join(images.hint("shuffle_hash"), "image_id", how)


def area_histogram(pixels: DataFrame, label: str) -> DataFrame:
    return pixels.groupBy("image_id", label).agg(F.count(F.lit(1)).alias("area"))


def boxes(pixels: DataFrame, label: str) -> DataFrame:
    """Area and bounding box of each label; ends are exclusive."""
    return pixels.groupBy("image_id", label).agg(
        F.count(F.lit(1)).alias("area"), F.min("x").alias("x0"), F.min("y").alias("y0"), (F.max("x") + 1).alias("x1"), (F.max("y") + 1).alias("y1")
    )


def bounding_box(pixels: DataFrame, inside: Column) -> DataFrame:
    return boxes(pixels.where(inside).withColumn("label", F.lit(1)), "label").drop("label")


def border_median(pixels: DataFrame, frame: int) -> DataFrame:
    """Median of each channel over four strips of so many pixels along the edges, fractions cut off; what lies in two strips
    (the corners) counts twice."""
    size = pixels.groupBy("image_id").agg(F.max("x").alias("mx"), F.max("y").alias("my"))
    strips = [F.col("x") < frame, F.col("y") < frame, F.col("x") > F.col("mx") - frame, F.col("y") > F.col("my") - frame]
    often = sum((s.cast("int") for s in strips[1:]), strips[0].cast("int"))
    edge = per_image(pixels, size).withColumn("often", often).where("often > 0")
    return edge.groupBy("image_id").agg(*[F.floor(F.percentile(c, 0.5, F.col("often"))).cast("int").alias(c) for c in RGB])


def modal_colour(pixels: DataFrame, step: int = 16) -> DataFrame:
    """The middle of the commonest colour bin of each image; of equally common ones the smallest bin."""
    bins = [F.floor(F.col(c) / step).cast("int").alias(c) for c in RGB]
    counts = pixels.select("image_id", *bins).groupBy("image_id", *RGB).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("image_id").agg(F.min(F.struct(-F.col("n"), *RGB)).alias("m"), F.max("n").alias("n"))
    return best.select("image_id", *[(F.col(f"m.{c}") * step + step // 2).alias(c) for c in RGB], "n")


def quantized(pixels: DataFrame, background: DataFrame, palette: Sequence[tuple[int, int, int]], tolerance: int = 25) -> DataFrame:
    """role of each pixel: -1 for what is near the image's background, else the nearest palette colour's number."""
    d = lambda p: F.greatest(*[F.abs(F.col(c) - v) for c, v in zip(RGB, p)])
    nearest = F.array_min(F.array(*[F.struct(d(p).alias("d"), F.lit(i).alias("k")) for i, p in enumerate(palette)]))["k"]
    bg = background.select("image_id", *[F.col(c).alias(f"bg_{c}") for c in RGB])
    near = F.greatest(*[F.abs(F.col(c) - F.col(f"bg_{c}")) for c in RGB]) <= tolerance
    return per_image(pixels, bg).select(*pixels.columns, F.when(near, -1).otherwise(nearest).alias("role"))


def outside_palette(pixels: DataFrame, channels: Sequence[str], palette: DataFrame) -> DataFrame:
    """image_id and channels of the distinct colours that are not in a palette's table."""
    return pixels.select("image_id", *channels).distinct().join(F.broadcast(palette), list(channels), "left_anti").select("image_id", *channels)


def coverage(pixels: DataFrame, inside: Column) -> DataFrame:
    return pixels.groupBy("image_id").agg(F.avg(inside.cast("int")).alias("share"))


#: Bits of a word and words of a block of a packed mask.
WORD, WORDS = 64, 64


def packed_masks(masks: DataFrame, width: int, keys: Sequence[str] = ("image_id",)) -> DataFrame:
    """keys, block and words of masks(keys, y, x): the pixels of images of so many columns as bits, a row for each block of
    WORD * WORDS pixels that has any. A pixel that comes twice is one bit."""
    at = F.col("y").cast("long") * width + F.col("x")
    bits = masks.select(*keys, F.floor(at / WORD).alias("word"), F.expr(f"shiftleft(1L, cast((y * {width}L + x) % {WORD} as int))").alias("bit"))
    words = bits.groupBy(*keys, "word").agg(F.bit_or("bit").alias("bits"))
    rows = words.groupBy(*keys, F.floor(F.col("word") / WORDS).alias("block")).agg(F.map_from_entries(F.collect_list(F.struct((F.col("word") % WORDS).cast("int").alias("w"), "bits"))).alias("m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long")))
    return rows.select(*keys, "block", dense.alias("words"))


def bits_in(words: Column) -> Column:
    return F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.bit_count(w))


def mask_iou(masks: DataFrame, images: DataFrame, width: int, stack: str = "stack") -> DataFrame:
    """stack, a, b, iou: intersection over union of each two images (a < b) of a stack of images(stack, image_id), whose
    masks(image_id, y, x) may be empty: 0 for disjoint ones and for two empty ones.

    Only blocks of bits meet, and only those at the same place of two images of a stack.
    """
    # packed before they meet anything: bits are few, and Spark doesn't know of any table here how many rows it has
    packed = packed_masks(masks, width).join(images.hint("merge"), "image_id").select(stack, "image_id", "block", "words")
    size = packed.groupBy(stack, "image_id").agg(F.sum(bits_in(F.col("words"))).alias("n"))
    sized = images.select(stack, "image_id").distinct().join(size.hint("merge"), [stack, "image_id"], "left").na.fill(0, ["n"])
    side = lambda df, c, k: df.select(F.col(stack), F.col("image_id").alias(k), *[F.col(x).alias(f"{x}_{k}") if x in ("words", "n") else F.col(x) for x in c])
    pairs = side(sized, ["n"], "a").join(side(sized, ["n"], "b").hint("merge"), stack).where("a < b")
    met = side(packed, ["block", "words"], "a").join(side(packed, ["block", "words"], "b").hint("merge"), [stack, "block"]).where("a < b")
    both = met.groupBy(stack, "a", "b").agg(F.sum(bits_in(F.zip_with("words_a", "words_b", lambda x, y: x.bitwiseAND(y)))).alias("both"))
    joined = pairs.join(both.hint("merge"), [stack, "a", "b"], "left").na.fill(0, ["both"])
    union = F.col("n_a") + F.col("n_b") - F.col("both")
    return joined.select(stack, "a", "b", F.when(union == 0, 0.0).otherwise(F.col("both") / union).alias("iou"))


def painted(canvas: DataFrame, shapes: DataFrame) -> DataFrame:
    """canvas(image_id, y, x) with the role of the last of shapes(image_id, z, role, x0, y0, x1, y1) that covers a pixel."""
    rows = shapes.select("image_id", "z", "role", F.explode(F.sequence("y0", F.col("y1") - 1)).alias("y"), "x0", "x1").where("x1 > x0")
    rows = rows.select("image_id", "z", "role", "y", F.explode(F.sequence("x0", F.col("x1") - 1)).alias("x"))
    top = rows.groupBy("image_id", "y", "x").agg(F.max_by("role", "z").alias("role"))
    return canvas.join(top.hint("merge"), ["image_id", "y", "x"], "left")


def masked(pixels: DataFrame, roles: DataFrame, role: int) -> DataFrame:
    """pixels with alpha 255 where roles(image_id, y, x, role) has the role, else 0."""
    return pixels.join(roles.select("image_id", "y", "x", "role").hint("merge"), ["image_id", "y", "x"]).withColumn("a", F.when(F.col("role") == role, 255).otherwise(0)).drop("role")


def composited(under: DataFrame, over: DataFrame) -> DataFrame:
    """over(image_id, y, x, r, g, b, a) upon under, by alpha, rounded."""
    o = over.select("image_id", "y", "x", *[F.col(c).alias(f"o_{c}") for c in (*RGB, "a")])
    mix = lambda c: F.coalesce(F.floor((F.col(f"o_{c}") * F.col("o_a") + F.col(c) * (255 - F.col("o_a"))) / 255 + 0.5).cast("int"), F.col(c)).alias(c)
    return under.join(o.hint("merge"), ["image_id", "y", "x"], "left").select("image_id", "y", "x", *[mix(c) for c in RGB])


def resized(pixels: DataFrame, size: DataFrame, width: int, height: int) -> DataFrame:
    """Nearest-neighbour resize; size(image_id, w, h) is the old size."""
    grid = size.select("image_id", "w", "h", F.explode(F.sequence(F.lit(0), F.lit(height - 1))).alias("ny")).select("*", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("nx"))
    grid = grid.select("image_id", "ny", "nx", F.floor((F.col("ny") + 0.5) * F.col("h") / height).cast("int").alias("y"), F.floor((F.col("nx") + 0.5) * F.col("w") / width).cast("int").alias("x"))
    return grid.join(pixels.hint("merge"), ["image_id", "y", "x"]).drop("y", "x").withColumnsRenamed({"ny": "y", "nx": "x"})


def turned(pixels: DataFrame, size: DataFrame, quarters: int) -> DataFrame:
    """Rotated counter-clockwise by quarter turns."""
    x, y, w, h = (F.col(c) for c in ("x", "y", "w", "h"))
    to = [(x, y), (y, w - 1 - x), (w - 1 - x, h - 1 - y), (h - 1 - y, x)][quarters % 4]
    return per_image(pixels, size).withColumns({"x": to[0], "y": to[1]}).drop("w", "h")


def trimmed(pixels: DataFrame, inside: Column) -> DataFrame:
    """pixels within the box around those that are inside, at the box's origin; an image without any is as it was."""
    box = bounding_box(pixels, inside)
    both = per_image(pixels, box.drop("area"), "left")
    kept = both.where(F.col("x0").isNull() | ((F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1")) & (F.col("y") >= F.col("y0")) & (F.col("y") < F.col("y1"))))
    return kept.withColumns({"x": F.col("x") - F.coalesce("x0", F.lit(0)), "y": F.col("y") - F.coalesce("y0", F.lit(0))}).select(*pixels.columns)


#: Quarter turns, counter-clockwise, of an image that faces north (fixed values).
TURNS = {"north": 0, "south": 2, "east": 3, "west": 1}


def facing(pixels: DataFrame, size: DataFrame, side: str) -> DataFrame:
    """pixels(..., a) turned to face a side and trimmed to what is not transparent."""
    return trimmed(turned(pixels, size, TURNS[side]), F.col("a") > 0)


def in_rim(y: Column, x: Column, height: Column, width: Column, inset: int = 96, wall: int = 36) -> Column:
    """Whether a pixel lies in the ring of a hull's outer wall, which begins so far from the edges."""
    inner = (y >= inset) & (y < height - inset) & (x >= inset) & (x < width - inset)
    deep = (y >= inset + wall) & (y < height - inset - wall) & (x >= inset + wall) & (x < width - inset - wall)
    return inner & ~deep


def guides(canvas: DataFrame, symbols: DataFrame, placements: DataFrame) -> DataFrame:
    """canvas(image_id, y, x) with v: white, and on it the silhouettes of symbols(symbol, y, x, a), black where they are opaque, at
    placements(image_id, z, symbol, x, y): each covers its whole rectangle, later ones cover earlier ones, and the canvas cuts."""
    at = placements.select("image_id", "z", "symbol", F.col("x").alias("left"), F.col("y").alias("top")).join(symbols, "symbol")
    ink = at.groupBy("image_id", (F.col("top") + F.col("y")).alias("y"), (F.col("left") + F.col("x")).alias("x")).agg(F.max_by("a", "z").alias("a"))
    return canvas.join(ink.hint("merge"), ["image_id", "y", "x"], "left").select("image_id", "y", "x", (F.lit(255) - F.coalesce("a", F.lit(0))).alias("v"))


# ---- one image at a time -------------------------------------------------------------------------------------------


def shifted(a: np.ndarray, dy: int, dx: int) -> np.ndarray:
    out = np.zeros_like(a)
    h, w = a.shape
    out[max(dy, 0) : h + min(dy, 0), max(dx, 0) : w + min(dx, 0)] = a[max(-dy, 0) : h + min(-dy, 0), max(-dx, 0) : w + min(-dx, 0)]
    return out


def neighbours(eight: bool) -> list[tuple[int, int]]:
    return [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (dy or dx) and (eight or not (dy and dx))]


def dilate(mask: np.ndarray, times: int = 1) -> np.ndarray:
    for _ in range(times):
        mask = np.logical_or.reduce([mask, *[shifted(mask, dy, dx) for dy, dx in neighbours(True)]])
    return mask


def erode(mask: np.ndarray, times: int = 1) -> np.ndarray:
    """What is left where the background grows; the image's border doesn't eat into the mask."""
    return ~dilate(~mask, times)


def gradient(mask: np.ndarray, times: int = 1) -> np.ndarray:
    """The rim of a mask: what growing adds and shrinking takes."""
    return dilate(mask, times) & ~erode(mask, times)


def label(mask: np.ndarray, eight: bool = False) -> np.ndarray:
    """Components numbered from 1 in raster order of their first pixels, by least labels that spread and jump."""
    h, w = mask.shape
    own = np.where(mask, np.arange(h * w).reshape(h, w), h * w)
    while True:
        new = own
        for dy, dx in neighbours(eight):
            moved = np.full_like(own, h * w)
            moved[max(dy, 0) : h + min(dy, 0), max(dx, 0) : w + min(dx, 0)] = own[max(-dy, 0) : h + min(-dy, 0), max(-dx, 0) : w + min(-dx, 0)]
            new = np.where(mask, np.minimum(new, moved), h * w)
        flat = np.append(new.ravel(), h * w)
        new = np.where(mask, flat[np.minimum(new, h * w)], h * w)
        if (new == own).all():
            break
        own = new
    seen, number = np.unique(own[mask], return_inverse=True)
    out = np.zeros((h, w), np.int64)
    out[mask] = number + 1
    return out


#: Channel from which a pixel is near white, alpha under which it is transparent, pixels of an interior blob,
#: share of an image beyond which clearing is refused, pixels of the largest hole to fill.
WHITE, CLEAR_ALPHA, BLOB, MOST_CLEARED, HOLE = 235, 16, 9, 0.35, 800


def edge_labels(found: np.ndarray) -> np.ndarray:
    return np.unique(np.concatenate([found[0], found[-1], found[:, 0], found[:, -1]]))


def fill_holes(mask: np.ndarray, most: int = HOLE) -> np.ndarray:
    """Fills background components (of eight neighbours) that don't touch the border and have so many pixels at most."""
    found = label(~mask, eight=True)
    fill = np.bincount(found.ravel()) <= most
    fill[edge_labels(found)] = False
    fill[0] = False
    return mask | fill[found]


def background(rgb: np.ndarray, alpha: np.ndarray, white: int = WHITE, pure: int = 255, least: int = BLOB) -> np.ndarray:
    """Which opaque pixels are background: near white and connected (by eight neighbours) to the border or beside a
    transparent pixel, and blobs of pure white of so many pixels elsewhere."""
    clear = alpha < CLEAR_ALPHA
    darkest = rgb.min(axis=2)
    pale = (darkest >= white) & ~clear
    found = label(pale, eight=True)
    beside = np.logical_or.reduce([shifted(clear, dy, dx) for dy, dx in neighbours(False)])
    flooded = np.zeros(found.max() + 1, bool)
    flooded[edge_labels(found)] = True
    flooded[found[beside]] = True
    flooded[0] = False
    edge = flooded[found]
    inner = label((darkest >= pure) & ~clear & ~edge)
    big = np.bincount(inner.ravel()) >= least
    big[0] = False
    return edge | big[inner]


def cleared(rgb: np.ndarray, alpha: np.ndarray, white: int = WHITE, pure: int = 255, least: int = BLOB, most_share: float = MOST_CLEARED) -> np.ndarray:
    """Alpha with the background transparent; as it was if that is too large a share of the image."""
    gone = background(rgb, alpha, white, pure, least)
    return alpha if gone.sum() > most_share * gone.size else np.where(gone, 0, alpha)


def foreground(ink: np.ndarray, closing: int, hole: int = HOLE) -> np.ndarray:
    """The mask closed by so many pixels, its holes filled."""
    return fill_holes(erode(dilate(ink, closing), closing) if closing else ink, hole)


def by_image(pixels: DataFrame, columns: Sequence[str], f: Callable[..., np.ndarray], result: str, kind: str = "long") -> DataFrame:
    """pixels with a column that f makes of each image's columns as arrays (height, width)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        y, x = rows["y"].to_numpy(), rows["x"].to_numpy()
        shape = (int(y.max()) + 1, int(x.max()) + 1)
        arrays = []
        for c in columns:
            a = np.zeros(shape, rows[c].to_numpy().dtype)
            a[y, x] = rows[c].to_numpy()
            arrays.append(a)
        return rows.assign(**{result: f(*arrays)[y, x]})

    fields = ", ".join(f"`{n}` {t}" for n, t in pixels.dtypes if n != result)
    return pixels.drop(result).groupBy("image_id").applyInPandas(run, f"{fields}, `{result}` {kind}")


def best_tolerance(pixels: DataFrame, background: DataFrame, tolerances: Sequence[int], least_area: int, parts: int = 4, closing: int = 0, hole: int = HOLE) -> DataFrame:
    """Tries each tolerance: foreground is what differs from the background by more, closed and without holes; the score is
    the number of its components of at least `least_area` pixels and at most one of so many parts of the image. image_id,
    tolerance, score; ties to the first tolerance."""
    bg = background.select("image_id", *[F.col(c).alias(f"bg_{c}") for c in RGB])
    far = F.greatest(*[F.abs(F.col(c) - F.col(f"bg_{c}")) for c in RGB])
    rows = per_image(pixels, bg).withColumn("t", F.explode(F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(t).alias("tolerance")) for i, t in enumerate(tolerances)])))
    rows = rows.select(F.col("image_id").alias("of"), F.concat_ws(":", "image_id", "t.ord").alias("image_id"), "t.ord", "t.tolerance", "y", "x", (far > F.col("t.tolerance")).alias("ink"))
    area = by_image(rows, ["ink"], lambda ink: label(foreground(ink, closing, hole)), "label").groupBy("of", "ord", "tolerance", "label").agg(F.count(F.lit(1)).alias("area"))
    whole = area.groupBy("of", "ord", "tolerance").agg(F.sum("area").alias("all"), F.collect_list(F.when(F.col("label") > 0, F.col("area"))).alias("areas"))
    score = F.size(F.filter("areas", lambda a: (a >= least_area) & (a <= F.floor(F.col("all") / parts))))
    best = whole.withColumn("score", score.cast("long")).groupBy("of").agg(F.max(F.struct("score", (-F.col("ord")).alias("first"), "tolerance")).alias("s"))
    return best.select(F.col("of").alias("image_id"), "s.tolerance", "s.score")
