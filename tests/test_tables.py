import random
import re
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.functions import geometry
from skein.operators import graph, raster
from skein.operators import relations as R
from skein.plans import generators
from skein.sinks import records
from skein.sources import files
from skein.streaming import incremental

BED = """# header
name: "Tank #4"
description: A bed
  name: ignored
bogus: 1
tags: [a, "b, c"]
state: NULL
orientation:
source_index: 7
"""


def test_readers_of_records(spark, tmp_path):
    (tmp_path / "bed_0.yaml").write_text(BED)
    (tmp_path / "bad.yaml").write_text("name: [unclosed\n")
    rows = files.texts(spark, str(tmp_path), "*.yaml")
    got = files.line_records(rows).where("stem = 'bed_0'").first()
    assert (got.name, got.tags, got.state, got.orientation, got.source_index) == ("Tank", ["a", "b", "c"], None, None, 7)
    full = {r.stem: r for r in files.yaml_records(files.texts(spark, str(tmp_path), "bed*.yaml").select("stem", F.regexp_replace("value", "  name: ignored\n", "").alias("value"))).collect()}
    assert (full["bed_0"].name, full["bed_0"].tags, full["bed_0"].state, full["bed_0"].parsed) == ("Tank #4", ["a", "b, c"], None, True)
    assert not files.yaml_records(rows.where("stem = 'bad'")).first().parsed


def test_folders(spark, tmp_path):
    for p in ("a.PNG", "sub/b.jpg", "sub/c.txt", "_skip/d.png", "outputs/e.png"):
        (tmp_path / p).parent.mkdir(exist_ok=True)
        (tmp_path / p).write_bytes(b"x")
    got = files.images(spark, str(tmp_path), exclude=["/outputs/"])
    assert sorted(r.file for r in got.collect()) == ["a.PNG", "b.jpg"]
    (tmp_path / "sub/s.json").write_text("{}")
    (tmp_path / "_skip/t.json").write_text("{}")
    assert [r.symbol for r in files.symbol_folders(spark, str(tmp_path)).collect()] == ["sub"]


def test_line_files(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("sha\tdest\nabc\tx\nonly\n")
    (tmp_path / "h.txt").write_text("m1  a/b\nm1  c\nm2  d  e\nbad\n")
    (tmp_path / "l.txt").write_text("# no\n\n yes \n")
    assert [tuple(r) for r in files.tsv(spark, str(tmp_path / "t.tsv"), "sha string, dest string").collect()] == [("abc", "x")]
    assert {tuple(r) for r in files.hash_list(spark, str(tmp_path / "h.txt")).collect()} == {("m1", "a/b"), ("m2", "d  e"), ("bad", "")}
    assert [r.value for r in files.list_lines(spark, str(tmp_path / "l.txt")).collect()] == ["yes"]
    c = spark.range(1).select(files.caption_line(F.lit("tok, A Bed, top, old, red")).alias("c")).first().c
    assert (c.trigger, c.subject, c.tags) == ("tok", "A Bed", ["top", "old", "red"])
    m = spark.range(1).select(files.labelled_lines(F.lit("verdict: reject\nwhy: a: b\nno label")).alias("m")).first().m
    assert m == {"verdict": "reject", "why": "a: b"}


@pytest.mark.parametrize("split", ["64", "1000", "128m"])
def test_first_lines_win_across_files_and_splits(spark, tmp_path, split):
    """Whatever splits files are read in and however these are dealt out, the first file's first line wins."""
    r, want = random.Random(3), {}
    for name in ("a.txt", "b.txt", "c.txt"):
        lines = [f"{r.randrange(90):02d}  {name}/{i}" for i in range(r.choice([10, 200]))]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        for line in lines:
            want.setdefault(*line.split("  "))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert {x.md5: x.path for x in files.hash_list(spark, str(tmp_path)).collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_png_and_zip(spark, tmp_path):
    image = records.png(3, 2, bytes(range(24)))
    (tmp_path / "i.png").write_bytes(image)
    got = files.folder(spark, str(tmp_path), "*.png").select(geometry.png_size(F.col("content")).alias("s")).first().s
    assert (got.width, got.height) == (3, 2)
    back = spark.read.format("image").load(str(tmp_path / "i.png")).first().image
    assert (back.width, back.height, back.nChannels) == (3, 2, 4) and bytes(back.data)[:4] == bytes([2, 1, 0, 3])
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x_normal.jpg", b"n")
        z.writestr("x_color.jpg", b"c")
    row = files.zip_member(files.folder(spark, str(tmp_path), "*.zip").select("stem", "content"), r"_color.*\.jpg$").first()
    assert (row.stem, row.member, bytes(row.bytes)) == ("a", "x_color.jpg", b"c")


def test_vector_map(spark):
    doc = '{"resolution": {"map_size": {"x": 6, "y": 4}, "pixels_per_grid": 100}, "line_of_sight": [[{"x": 0, "y": 0}, {"x": 6, "y": 0}]], "objects_line_of_sight": [[{"x": 1, "y": 1}]], "lights": [{"position": {"x": 3, "y": 2}, "range": 4, "color": "ffffd9a0"}], "image": "aGk="}'
    m = spark.range(1).select(files.vector_map(F.lit(doc)).alias("m")).first().m
    assert (m.size.x, m.per_grid, len(m.walls), m.portals, m.lights[0].color, bytes(m.image), m.origin.x) == (6.0, 100, 2, [], "ffffd9a0", b"hi", 0.0)
    old = '{"resolution": {"map_size": {"x": 1, "y": 1}}, "line_of_sight": [{"x": 0, "y": 0}, {"x": 1, "y": 0}], "objects_line_of_sight": [[], [{"x": 1, "y": 1}]]}'
    m = spark.range(1).select(files.vector_map(F.lit(old)).alias("m")).first().m
    assert (m.per_grid, [[tuple(p) for p in w] for w in m.walls]) == (100, [[(0.0, 0.0), (1.0, 0.0)], [(1.0, 1.0)]])
    with pytest.raises(Exception, match="map_size"):
        spark.range(1).select(files.vector_map(F.lit("{}")).alias("m")).first()


def test_updates(spark):
    df = spark.createDataFrame([("a", "x", "north"), ("b", "y", None)], "stem string, name string, orientation string")
    up = records.updated(df, {"name": F.lit("new"), "unknown": F.lit(1)}, F.col("stem") == "a")
    assert sorted(map(tuple, up.collect()), key=str) == [("a", "new", "north"), ("b", "y", None)]
    added = records.upserted(df, "stem", spark.createDataFrame([("b", "g1")], "stem string, group_id string"), "group_id")
    assert {r.stem: r.group_id for r in added.collect()} == {"a": None, "b": "g1"}
    line = spark.range(1).select(records.replaced_line(F.lit("a: 1\nstate: old\n"), "state", F.lit("new")).alias("r"), records.replaced_line(F.lit("a: 1"), "state", F.lit("new")).alias("n")).first()
    assert (line.r.text, line.r.changed, line.n.changed) == ("a: 1\nstate: new\n", True, False)
    text = df.select(records.rendered(["stem", "orientation"])).collect()
    assert sorted(r[0] for r in text) == ["stem: a\norientation: north", "stem: b\norientation: null"]
    assert records.json_array(df, F.struct("stem"), "stem").first()[0] == '[{"stem":"a"},{"stem":"b"}]'
    assert records.sorted_map(df, "stem", F.struct("name")).first()[0] == '{"a":{"name":"x"},"b":{"name":"y"}}'


def rewrite(text, fields):
    """The rule for records, line by line."""
    out = []
    for line in text.splitlines(keepends=True):
        body, found = line.rstrip("\n"), None
        if line.strip() and not line.lstrip().startswith("#"):
            found = re.match(r"^([A-Za-z_][A-Za-z0-9_]*)\s*:\s*(.*?)(\s*#.*)?$", body)
        if found and found.group(1) in fields:
            line = f"{found.group(1)}: {fields[found.group(1)]}{found.group(3) or ''}" + ("\n" if line.endswith("\n") else "")
        out.append(line)
    return "".join(out)


RECORDS = [
    "# head\nname: Old   # by hand\n\ntags: [a, b]\nother:  kept \n", "name:\nstate:x#y\n  name: inner\n- name: item\nname : spaced\n", "state: 'a # b'\n#name: no\nname2: z", "", "\n\n", "name: a\r\nstate: b\r\n# c\r\n", "name: a\x0bstate: b\x85tags: [x]\u2028end",
    "no colon\nname: last", "name: a\nname: twice # too\n",
]


@pytest.mark.parametrize("text", RECORDS)
def test_rewriting_keeps_everything_else_byte_for_byte(spark, text):
    fields = {"name": F.lit("New: one"), "state": F.lit(None).cast("string"), "tags": F.array(F.lit("x"), F.lit("y, z"))}
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(records.rewritten(F.col("t"), fields).alias("v")).first().v
    assert got == rewrite(text, {"name": '"New: one"', "state": "null", "tags": '[x, "y, z"]'})
    assert df.select(records.rewritten(F.col("t"), {}).alias("v")).first().v == text


@pytest.mark.parametrize("text", ["a: 1\nstate: old # c\nstate: b\n", "state:x", "states: 1\n state: 2\n", "state: $1 \\1\n", "", "a\rb\nstate: q\r\nz"])
def test_first_line_is_replaced(spark, text):
    new, n = re.subn(r"^state:.*$", lambda _: "state: $2 \\n", text, count=1, flags=re.MULTILINE)
    got = spark.createDataFrame([(text,)], "t string").select(records.replaced_line(F.col("t"), "state", F.lit("$2 \\n")).alias("r")).first().r
    assert (got.text, got.changed) == (new, n > 0 and new != text)


def test_sinks_write(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    records.documents(df, F.struct("k", "v"), str(tmp_path / "docs"))
    records.documents(df.where("v = 1"), F.struct("k", "v"), str(tmp_path / "docs"))
    assert [r.value for r in spark.read.text(str(tmp_path / "docs")).collect()] == ['{"k":"a","v":1}']
    for _ in range(2):
        records.appended_tsv(df, str(tmp_path / "t"))
    assert spark.read.csv(str(tmp_path / "t"), sep="\t").count() == 4


def test_components_and_refinement(spark):
    nodes = spark.range(12).withColumnRenamed("id", "node")
    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 3), (3, 4), (6, 5), (7, 6)], "a long, b long")
    got = {r.node: r.component for r in graph.components(nodes, edges).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 5, 6: 5, 7: 5, 8: 8, 9: 9, 10: 10, 11: 11}
    v = [(0, "A", [1.0, 0.0, 0.0]), (1, "A", [0.9, 0.435, 0.0]), (2, "A", [0.0, 0.0, 1.0]), (3, "B", [0.97, 0.24, 0.0]), (4, "B", None)]
    rows = graph.refined(spark.createDataFrame(v, "id long, name string, e array<double>"), "id", "name", "e", 0.78, 0.92)
    assert {r.id: r.final for r in rows.collect()} == {0: 0, 1: 0, 2: 2, 3: 0}


def test_masks_that_are_equal_disjoint_or_empty(spark):
    r = np.random.default_rng(1)
    shapes = {0: r.random((70, 90)) < 0.3, 1: r.random((70, 90)) < 0.5, 2: np.zeros((70, 90), bool), 3: np.zeros((70, 90), bool)}
    shapes |= {4: shapes[0].copy(), 5: np.zeros((70, 90), bool), 6: ~shapes[1]}
    shapes[5][3, 4] = True
    masks = spark.createDataFrame([(i, int(y), int(x)) for i, m in shapes.items() for y, x in zip(*np.nonzero(m))] + [(5, 3, 4)], "image_id int, y int, x int")
    images = spark.createDataFrame([("s", i) for i in shapes] + [("t", 0), ("t", 2), ("u", 1)], "stack string, image_id int")
    got = {(x.stack, x.a, x.b): x.iou for x in raster.mask_iou(masks, images, 90).collect()}
    iou = lambda a, b: (shapes[a] & shapes[b]).sum() / max(1, (shapes[a] | shapes[b]).sum())
    assert got == {("s", a, b): iou(a, b) for a in shapes for b in shapes if a < b} | {("t", 0, 2): 0.0}
    assert got["s", 2, 3] == 0.0 and got["s", 0, 4] == 1.0 and got["s", 1, 6] == 0.0


def test_labels_and_holes():
    two = np.array([[1, 1, 0, 0], [1, 0, 0, 0], [0, 0, 1, 1], [0, 1, 1, 0]], bool)
    assert raster.label(two).max() == 2 and raster.label(two, eight=True).max() == 2
    corner = np.array([[1, 0], [0, 1]], bool)
    assert raster.label(corner).max() == 2 and raster.label(corner, eight=True).max() == 1
    ring = np.ones((5, 5), bool)
    ring[2, 2] = ring[1, 2] = False
    assert raster.fill_holes(ring).all() and not raster.fill_holes(ring, most=1).all()
    snake = np.zeros((20, 20), bool)
    snake[::2] = True
    snake[1::4, -1] = snake[3::4, 0] = True
    assert raster.label(snake).max() == 1
    dot = np.zeros((5, 5), bool)
    dot[2, 2] = True
    assert raster.dilate(dot).sum() == 9 and (raster.erode(raster.dilate(dot)) == dot).all()
    rgb = np.full((6, 6, 3), 255)
    rgb[1:5, 1:5] = 10
    rgb[2:4, 2:4] = 255
    assert not raster.fill_holes(np.array([[1, 1, 0], [1, 0, 1], [1, 1, 1]], bool))[1, 1]  # open by a corner
    assert raster.erode(np.ones((3, 3), bool)).all()
    opaque = np.full((6, 6), 255)
    assert (raster.cleared(rgb, opaque) == opaque).all()  # 20 of 36 pixels are too many
    alpha = raster.cleared(rgb, opaque, most_share=0.6)
    assert alpha[0, 0] == 0 and alpha[2, 2] == 255
    both = raster.cleared(rgb, opaque, least=4, most_share=0.7)
    assert both[2, 2] == 0 and both[0, 0] == 0 and both[1, 1] == 255


def test_pixel_tables(spark):
    px = spark.range(36).selectExpr("0L image_id", "id div 6 y", "id % 6 x", "cast(case when id % 6 in (1,2) and id div 6 in (1,2) then 0 else 250 end as int) r").selectExpr("*", "r g", "r b")
    bg = raster.border_median(px, 1)
    assert tuple(bg.first())[1:] == (250, 250, 250)
    r = np.random.default_rng(5).integers(0, 256, (7, 9))
    strips = np.concatenate([x.ravel() for x in (r[:2], r[-2:], r[:, :2], r[:, -2:])])
    rows = spark.createDataFrame([(0, y, x, *[int(r[y, x])] * 3) for y in range(7) for x in range(9)], "image_id long, y long, x long, r int, g int, b int")
    assert raster.border_median(rows, 2).first().r == int(np.median(strips))
    best = raster.best_tolerance(px, bg, [10, 100, 300], least_area=2).first()
    assert (best.tolerance, best.score) == (10, 1)
    size = spark.createDataFrame([(0, 6, 6)], "image_id long, w int, h int")
    assert raster.resized(px, size, 3, 3).count() == 9
    turned = {(r.y, r.x): r.r for r in raster.turned(px.withColumn("r", F.expr("cast(y * 6 + x as int)")), size, 1).collect()}
    want = np.rot90(np.arange(36).reshape(6, 6))
    assert all(turned[y, x] == want[y, x] for y in range(6) for x in range(6))
    over = px.limit(1).selectExpr("image_id", "y", "x", "10 r", "10 g", "10 b", "128 a")
    assert raster.composited(px, over).where("x = 0 and y = 0").first().r == 130


def test_jobs(spark):
    six = spark.createDataFrame([(i, f"class {i}", 6) for i in range(6)], "ord int, folder string, variants int")
    axes = {"state": list("abcdef"), "angle": list("xyz")}
    rows = generators.jobs("interleaved", six, axes=axes).collect()
    assert len(rows) == 36 and len({(r.folder, r.state, r.angle) for r in rows}) == 6  # axes in step: one pair for each class
    some = generators.jobs("interleaved", six, axes=axes, part="class 3").collect()
    assert [r.state for r in sorted(some, key=lambda r: r.seq)] == list("abcdef")
    with pytest.raises(ValueError, match="unknown generator"):
        generators.jobs("nothing", six)
    assets = spark.createDataFrame([("s", "Old Bed", None, None, ["wood"], "soft"), ("t", "Lamp", "north", "lit", [], None), ("u", " ", "north", "lit", [], None), ("v", "Box", "north", "", ["WOOD"], None)], "stem string, name string, orientation string, state string, tags array<string>, description string")
    labels = generators.jobs("assets", assets.withColumn("description", F.lit("  far  ")), trigger="tok", categories=[], orientations=["north"], part="t.png").collect()
    assert [(r.label, r.caption, r.prompt) for r in labels] == [("stamp/north/misc/t", "tok, Lamp, north view, lit, far", "")]
    symbols = spark.createDataFrame([(0, "sun", ["a"], ["b", "c"], None, ["d"]), (1, "moon", ["a"], None, ["e"], None)], "ord int, folder string, common array<string>, extra array<string>, extended array<string>, new array<string>")
    made = generators.jobs("treatments", symbols, axes={"angle": ["n", "s"]}).collect()
    assert sorted((r.folder, r.seq, r.treatment, r.version, r.angle) for r in made) == [("moon", 0, "a", "v1", "n"), ("moon", 1, "e", "v1", "s"), ("sun", 0, "a", "v1", "n"), ("sun", 1, "b", "v1", "s"), ("sun", 2, "c", "v1", "n"), ("sun", 3, "d", "v2", "s")]
    got = {r.stem: (r.path, r.caption) for r in generators.jobs("assets", assets, trigger="tok", categories=[("beds", ["bed"]), ("wooden", ["wood"])], orientations=["north"]).collect()}
    assert got == {"s": ("review/unknown/beds/s", "tok, Old Bed, unknown view, intact, wood, soft"), "t": ("train/misc/t", "tok, Lamp, north view, lit"), "v": ("train/wooden/v", "tok, Box, north view, intact, WOOD")}
    assert generators.stages(["a", "b", "c"], skip=["b"]) == ["a", "c"]
    ran = generators.run_stages({"a": lambda: 1, "b": lambda: 1 / 0, "c": lambda: 1})
    assert list(ran) == ["a", "b"] and ran["b"].startswith("ZeroDivisionError")


def test_prefixes_and_bands(spark):
    rows = spark.createDataFrame([("a_b_1",), ("a_2",), ("ab_3",), ("none",)], "name string")
    got = R.longest_prefix(rows, "name", spark.createDataFrame([("a",), ("a_b",)], "p string"), "p")
    assert {r.name: r.p for r in got.collect()} == {"a_b_1": "a_b", "a_2": "a"}
    plan = R.longest_prefix(rows, "name", spark.createDataFrame([("a",), ("a_b",)], "p string"), "p")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan
    boxes = spark.createDataFrame([(1, 0.0, 10.0, 50.0), (1, 2.0, 12.0, 5.0), (1, 20.0, 30.0, 7.0)], "sheet int, t double, b double, l double")
    got = sorted((r.band, r.place, r.l) for r in R.row_bands(boxes, "sheet", "t", "b", "l").collect())
    assert got == [(0, 0, 5.0), (0, 1, 50.0), (1, 2, 7.0)]
    near = R.nearest(spark.createDataFrame([(10, 0, 0)], "r int, g int, b int"), ["r", "g", "b"], spark.createDataFrame([(0, 0, 0, 0), (1, 20, 0, 0)], "k int, pr int, pg int, pb int"), "k", ["pr", "pg", "pb"])
    assert near.first().nearest.k == 0


def test_stream_of_new_files(spark, tmp_path):
    src, schema = str(tmp_path / "in"), "k long, t timestamp"
    rows = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k long").withColumn("t", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    run = lambda: incremental.processed(incremental.arrivals(spark, src, schema, "k", "t"), lambda df: df.select("k"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    rows(1, 2, 2).write.mode("append").parquet(src)
    run()
    rows(2, 3).write.mode("append").parquet(src)
    run()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]
