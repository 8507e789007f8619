"""The library's pipeline as one chain of tables: assets, enriched, grouped, packed, checked, reported."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import hashing as H
from skein.functions import text as T
from skein.operators import graph
from skein.operators import relations as R
from skein.operators import verdicts
from skein.operators.sequences import numbered
from skein.operators.tables import written


def selected(rows: DataFrame, name: str, prefix: str | None = None, part: str | None = None, blank: str | None = None, force: bool = False, most: int | None = None) -> DataFrame:
    """Rows whose name has the prefix and the part, and whose field `blank` is missing (all with force); the first by name."""
    if prefix is not None:
        rows = rows.where(F.col(name).startswith(prefix))
    if part is not None:
        rows = rows.where(F.col(name).contains(part))
    if blank is not None and not force:
        rows = rows.where(F.coalesce(F.btrim(F.col(blank).cast("string")), F.lit("")) == "")
    return rows if most is None else rows.orderBy(name).limit(most)


def enriched(rows: DataFrame, caption: Column, prefixes: Sequence[str], phrase: str, rejects: Sequence[str], orientations: Sequence[tuple[str, str]], states: Sequence[tuple[str, str]], severity: Sequence[str], rules: Sequence[tuple[str, Sequence[str]]], stopwords: Sequence[str]) -> DataFrame:
    """rows with name, description, orientation, state and tags from a caption."""
    found = rows.withColumn("caption", caption)
    c = F.col("caption")
    return found.withColumns({
        "name": T.name_from_caption(c, prefixes, phrase, rejects), "description": T.stripped(c, prefixes), "orientation": T.first_keyword(c, orientations),
        "state": T.worst_keyword(c, states, severity), "tags": T.caption_tags(T.stripped(c, prefixes), F.array().cast("array<string>"), stopwords, T.categories(c, rules)),
    })


def captioned(passes: Sequence[tuple[str, Column]]) -> Column:
    """text and by: the first pass that gave a caption."""
    tries = [F.when(F.length(F.btrim(c)) > 0, F.struct(c.alias("text"), F.lit(n).alias("by"))) for n, c in passes]
    return F.coalesce(*tries)


def caption_from_path(path: Column, triggers: Sequence[tuple[str, str]], subjects: Sequence[tuple[str, str]], default: str) -> Column:
    """`trigger, subject, description`: rules on the file name, else on the folders, else the default; no part twice."""
    file = F.element_at(F.split(path, "/"), -1)
    low = F.lower(path)
    trigger = F.coalesce(T.first_match(F.lower(file), triggers), T.first_match(low, triggers), F.lit(default))
    subject = F.coalesce(T.first_match(F.lower(file), subjects), T.first_match(low, subjects))
    return F.array_join(T.distinct_ignoring_case(F.array_compact(F.array(trigger, subject, T.file_description(file)))), ", ")


def assigned_groups(rows: DataFrame, key: str, name: str, vector: str | None, stopwords: Sequence[str], namespace: str, split: float, merge: float) -> DataFrame:
    """key and group_id: by canonical name, refined by vectors where there are any; the id is of the commonest name
    (the first seen of equally common ones) and the members."""
    named = rows.withColumn("canonical", T.canonical_name(F.col(name), stopwords))
    named = named.withColumn("canonical", F.coalesce(F.nullif("canonical", F.lit("")), F.concat(F.lit("__unclassified:"), F.col(key))))
    if vector is None:
        members = named.select(key, "canonical", F.col("canonical").alias("final"))
    else:
        members = graph.refined(named, key, "canonical", vector, split, merge).select(key, "canonical", F.col("final").cast("string").alias("final"))
    members = written(members)
    commonest = R.mode_first_seen(members, "final", "canonical", key).select("final", F.col("canonical").alias("mode"))
    digests = members.groupBy("final").agg(H.member_digest(F.collect_list(F.col(key).cast("string"))).alias("digest"))
    ids = commonest.join(digests, "final").select("final", H.uuid5(namespace, F.concat_ws(":", "mode", "digest")).alias("group_id"))
    return members.join(ids, "final").select(key, "group_id")


def presets(assets: DataFrame, records: DataFrame, grid: int, folder: str) -> DataFrame:
    """A nested preset for each asset with a record; assets(stem, width, height)."""
    r = assets.join(records, "stem")
    side = lambda c: F.coalesce(F.col(c), F.lit(grid))
    image = F.concat(F.lit(f"{folder}/"), F.col("stem"), F.lit(".png"))
    data = F.struct(F.struct(image.alias("src"), F.lit(1.0).alias("scaleX"), F.lit(1.0).alias("scaleY")).alias("texture"), F.lit(0).alias("x"), F.lit(0).alias("y"), side("width").alias("width"), side("height").alias("height"), F.lit(0).alias("rotation"))
    return r.select(
        H.short_id(F.col("stem")).alias("id"), T.display_name(F.col("name"), F.col("stem"), F.col("state"), F.col("orientation")).alias("name"), F.lit("Tile").alias("documentName"), image.alias("img"),
        T.preset_tags(F.col("tags"), F.col("orientation"), F.col("state"), F.col("group_id")).alias("tags"), F.lit(grid).alias("gridSize"), F.array(data).alias("data"),
    )


#: Identifier and name of a pack's index document, and the module whose flags hold presets and index (fixed values).
INDEX_ID, INDEX_NAME, MODULE = "MassEditMetaData", "!!! METADATA: DO NOT DELETE !!!", "multi-token-edit"


def pack_documents(packed: DataFrame) -> DataFrame:
    """id and value: a JSON document for each preset of a pack, and one with the index of all."""
    shell = lambda id_, name, flag: F.to_json(F.struct(id_.alias("_id"), name.alias("name"), F.lit(0).alias("sort"), F.lit(None).cast("string").alias("folder"), F.struct(F.lit(0).alias("default")).alias("ownership"), F.struct(F.struct(flag).alias(MODULE)).alias("flags")), {"ignoreNullFields": "false"})
    preset = F.struct("id", "name", "documentName", "img", "tags", "gridSize", "data").alias("preset")
    rows = packed.select("id", shell(F.col("id"), F.col("name"), preset).alias("value"))
    index = pack_index(packed).select(F.lit(INDEX_ID).alias("id"), shell(F.lit(INDEX_ID), F.lit(INDEX_NAME), F.col("index")).alias("value"))
    return rows.unionByName(index)


def pack_index(packed: DataFrame) -> DataFrame:
    """One row: the map of a pack's ids to image, kind and tags."""
    entry = F.struct("img", "documentName", "tags")
    return packed.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("id").alias("key"), entry.alias("value"))))).alias("index"))


#: Fields of a preset and numbers of a placement that a pack must have (fixed values).
PRESET_FIELDS, PLACE_NUMBERS = ("id", "name", "documentName", "img", "gridSize"), ("x", "y", "width", "height", "rotation")


def pack_errors(packed: DataFrame, order: Sequence[Column | str] = ("id", "img")) -> DataFrame:
    """id, level, path, message: a row for everything in a pack that breaks its contract, at the place where it is.

    Paths number presets in order and placements and tags as they lie, from 0. An id that several presets have is one row,
    without a path; a missing one is missing, not repeated.
    """
    rows = numbered(packed, order, "nth")
    at = F.concat(F.lit("preset["), F.col("nth"), F.lit("]"))
    blank = lambda c: F.coalesce(T.trimmed(c), F.lit("")) == ""
    fault = lambda bad, level, path, message: F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(level).alias("level"), path.alias("path"), F.lit(message).alias("message")))
    field = lambda c, bad, level="error", message=None: fault(bad, level, F.concat(at, F.lit(f".{c}")), message or f"{c} is missing")
    whole = [field(c, F.col(c).isNull() if c in ("img", "gridSize") else blank(F.col(c))) for c in PRESET_FIELDS]
    whole += [field("img", blank(F.col("img")), "warning", "img is empty"), field("data", F.coalesce(F.size("data"), F.lit(0)) <= 0, message="data is empty")]

    def placed(d: Column, j: Column) -> Column:
        here = F.concat(at, F.lit(".data["), j, F.lit("]"))
        src = d["texture"]["src"]
        there = lambda c: F.concat(here, F.lit(f".{c}"))
        found = [fault(blank(src), "error", there("texture.src"), "texture is missing"), fault(~blank(src) & ~blank(F.col("img")) & (src != F.col("img")), "warning", there("texture.src"), "src is not img")]
        found += [fault(d[c].isNull(), "error", there(c), "a placement's number is missing") for c in PLACE_NUMBERS]
        found += [fault(d[c] == 0, "warning", there(c), "no extent") for c in ("width", "height")]
        return F.array(*found)

    fault_type = "struct<level:string,path:string,message:string>"
    no_fault, no_places = F.array().cast(f"array<{fault_type}>"), F.array().cast(f"array<array<{fault_type}>>")
    tags = F.transform("tags", lambda t, j: fault(t.isNull(), "error", F.concat(at, F.lit(".tags["), j, F.lit("]")), "a tag is missing"))
    every = F.concat(F.array(*whole), F.coalesce(tags, no_fault), F.flatten(F.coalesce(F.transform("data", placed), no_places)))
    found = rows.select("id", F.explode(F.array_compact(every)).alias("e")).select("id", "e.level", "e.path", "e.message")
    twice = verdicts.duplicate_keys(packed.where(F.col("id") != ""), "id")
    return found.unionByName(twice.select("id", F.lit("error").alias("level"), F.lit(None).cast("string").alias("path"), F.lit("id is not unique").alias("message")))


def pack_violations(packed: DataFrame) -> DataFrame:
    """id, level, message of everything in a pack that breaks its contract; a row for each faulty place."""
    return pack_errors(packed).select("id", "level", "message")


def status(assets: DataFrame, records: DataFrame, sheets: DataFrame) -> DataFrame:
    """Coverage by sheet of assets(stem): with record, name, orientation, state, group."""
    placed = R.longest_prefix(assets.select("stem"), "stem", sheets, "sheet")
    rows = placed.join(records.withColumn("there", F.lit(1)), "stem", "left")
    return R.coverage(rows, "sheet", {"record": F.col("there").isNotNull(), "named": F.col("name").isNotNull(), "oriented": F.col("orientation").isNotNull(), "stated": F.col("state").isNotNull(), "grouped": F.col("group_id").isNotNull()})


def report_lines(report: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Lines of fixed width of a report."""
    return report.select(F.concat_ws(" ", *[F.rpad(F.coalesce(F.col(c).cast("string"), F.lit("-")), w, " ") for c, w in widths.items()]).alias("line"))


def placements(maps: DataFrame) -> DataFrame:
    """image_size, doors and lights in pixels, of maps(image_id, m: see sources.files.vector_map)."""
    ppg = F.col("m.per_grid")
    px = lambda v, axis: F.round((v - F.col(f"m.origin.{axis}")) * ppg, 2)
    point = lambda p: F.array(px(p["x"], "x"), px(p["y"], "y"))
    door = lambda d: F.struct(px(d["position"]["x"], "x").alias("x"), px(d["position"]["y"], "y").alias("y"), F.round(F.coalesce(d["rotation"], F.lit(0.0)), 2).alias("rotation_deg"), F.coalesce(d["closed"], F.lit(True)).alias("closed"), F.coalesce(d["freestanding"], F.lit(False)).alias("freestanding"), F.transform(d["bounds"], point).alias("span_px"))
    light = lambda x: F.struct(px(x["position"]["x"], "x").alias("x"), px(x["position"]["y"], "y").alias("y"), F.round(F.coalesce(x["range"], F.lit(0.0)) * ppg, 2).alias("range_px"), F.coalesce(x["intensity"], F.lit(1.0)).alias("intensity"), F.right(F.coalesce(x["color"], F.lit("ffffffff")), F.lit(6)).alias("color"))
    size = F.array(*[F.bround(F.col(f"m.size.{c}") * ppg).cast("int") for c in "xy"])
    placed = F.filter("m.lights", lambda x: x["position"]["x"].isNotNull() & x["position"]["y"].isNotNull())
    return maps.select("image_id", size.alias("image_size"), ppg.alias("pixels_per_grid"), F.transform("m.portals", door).alias("doors"), F.transform(placed, light).alias("lights"))


def placements_json(maps: DataFrame) -> DataFrame:
    """image_id and value: placements as a JSON object, missing coordinates as null."""
    fields = F.struct("image_size", "pixels_per_grid", "doors", "lights")
    return placements(maps).select("image_id", F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def collapsed(packed: DataFrame, by: Column) -> DataFrame:
    """One preset for all that share a value of `by`: that of the smallest id, with every one's data, in order of id."""
    rows = packed.withColumn("by", by)
    all_ = rows.groupBy("by").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("id", "data"))), lambda x: x["data"])).alias("every"), F.min("id").alias("id"))
    return rows.join(all_, ["by", "id"]).withColumn("data", F.col("every")).drop("by", "every")


def variant_cycle(rows: DataFrame) -> DataFrame:
    """group_id, orientation and the images of each, one for each state, where there are two or more."""
    one = rows.where(F.col("group_id").isNotNull()).groupBy("group_id", "orientation", "state").agg(F.min("img").alias("img"))
    out = one.groupBy("group_id", "orientation").agg(F.array_sort(F.collect_list(F.struct("state", "img"))).alias("cycle"))
    return out.where(F.size("cycle") >= 2)
