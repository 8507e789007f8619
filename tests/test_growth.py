"""What grows with images: nothing that a generator makes is broadcast, and parts follow the number of pixels."""

import contextlib
import io

import pytest

from skein.operators import raster
from skein.plans import catalogue


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_border_medians_broadcast_no_pixels(spark, sf):
    """Spark took 1,600 pixels of each image for as small as the images' rows and broadcast them."""
    assert "Broadcast" not in plan(catalogue.border_medians(spark, sf))


def test_parts_follow_pixels(spark, sf, monkeypatch):
    monkeypatch.setattr(raster, "PART", 4000)
    rows = catalogue.pixels(spark, sf)
    n = rows.count()
    assert rows.rdd.getNumPartitions() == -(-n // 4000) == 4
    assert plan(raster.coverage(rows, rows.r > 200)).count("Exchange") == 1  # that of the images


def test_mask_ious_broadcast_no_pixels(spark, sf):
    assert "Broadcast" not in plan(catalogue.mask_ious(spark, sf))


@pytest.mark.parametrize("name", ["palette_quantize", "painted_regions", "turned_icons"])
def test_pixel_joins_broadcast_no_pixels(spark, sf, name):
    assert "Broadcast" not in plan(catalogue.QUERIES[name](spark, sf))


def test_images_are_one_task_no_longer(spark, sf, monkeypatch):
    """A task sorted as many images as there were for a partition: parts are now of the images dealt, with no exchange of pixels."""
    monkeypatch.setattr(raster, "PART", 4000)
    ink = catalogue.pixels(spark, sf).selectExpr("image_id", "y", "x", "r > 200 as ink")
    filled = raster.by_image(ink, ["ink"], raster.fill_holes, "filled", "boolean")
    assert plan(filled).count("Exchange") == 1 and filled.rdd.getNumPartitions() == 4


def test_plans_are_spread(spark, sf, monkeypatch):
    """A small file of plans left all their runs to one task, and each row of an image was cut on its own."""
    from skein.operators import layout
    from skein.plans import floor_plans

    monkeypatch.setattr(floor_plans, "PART", 3)
    plans = floor_plans.preset_plans(spark.range(10).selectExpr("id as image_id", "'hab-2room' as preset", "60 as width", "50 as height", "4 as thickness"))
    assert floor_plans.spread(plans).rdd.getNumPartitions() == 4
    canvas = spark.createDataFrame([(1, 9, 40)], "image_id long, width int, height int")
    runs = spark.range(40).selectExpr("1L as image_id", "id as y", "2L as x0", "5L as x1", "1L as z", "7 as role").where("y < 30")
    painted = layout.painted_runs(canvas, runs, 0)
    assert painted.count() == 30 * 3 + 10 and "collect_list(y" in plan(painted)
