"""Tables from folders of files. Paths are whatever Spark reads; nothing is opened on the driver."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Suffixes taken for images (fixed values).
IMAGES = ("png", "jpg", "jpeg", "webp", "bmp", "gif", "tif", "tiff")
FIELDS = ("name", "description", "tags", "orientation", "state", "group_id", "source", "source_index")


def with_path(df: DataFrame) -> DataFrame:
    """Adds path, file and stem."""
    path = F.col("_metadata.file_path") if "path" not in df.columns else F.col("path")
    out = df.select("*", path.alias("p")) if "path" in df.columns else df.select("*", path.alias("path"), path.alias("p"))
    file = F.element_at(F.split("p", "/"), -1)
    return out.withColumn("file", file).withColumn("stem", F.regexp_replace("file", r"\.[^.]*$", "")).drop("p")


def folder(spark: SparkSession, path: str, glob: str = "*", deep: bool = False, exclude: Sequence[str] = ()) -> DataFrame:
    """path, length, modificationTime, content, file, stem of each file; content is read only if it is used.

    Spark itself passes over files and folders whose names begin with an underscore or a dot.
    """
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(deep).lower()).load(path)
    for part in exclude:
        df = df.where(~F.col("path").contains(part))
    return with_path(df)


def images(spark: SparkSession, path: str, exclude: Sequence[str] = ()) -> DataFrame:
    df = folder(spark, path, deep=True, exclude=exclude)
    return df.where(F.lower(F.regexp_extract("file", r"\.([^.]*)$", 1)).isin(*IMAGES))


def symbol_folders(spark: SparkSession, path: str) -> DataFrame:
    """JSON files of the sub-folders whose name doesn't begin with an underscore."""
    df = folder(spark, path, "*.json", deep=True)
    parent = F.element_at(F.split("path", "/"), -2)
    return df.withColumn("symbol", parent).where(~parent.startswith("_"))


def texts(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """value (a whole file), path, file, stem."""
    return with_path(spark.read.option("pathGlobFilter", glob).text(path, wholetext=True))


def line_field(text: Column, key: str) -> Column:
    """A top-level scalar of a YAML file read line by line: cut at the first #, unquoted; empty and null are null."""
    raw = F.regexp_extract(text, rf"(?m)^{key}[ \t]*:[ \t]*([^#\r\n]*)", 1)
    bare = F.btrim(F.btrim(raw), F.lit("\"'"))
    return F.when((bare != "") & (F.lower(bare) != "null"), bare)


def line_records(df: DataFrame, text: str = "value") -> DataFrame:
    """df with the record's fields from its text; indented lines and unknown keys are ignored."""
    t = F.col(text)
    raw = F.regexp_extract(t, r"(?m)^tags[ \t]*:[ \t]*\[([^#\r\n]*?)\][ \t]*(?:#.*)?$", 1)
    tags = F.filter(F.transform(F.split(raw, ","), lambda x: F.btrim(F.btrim(x), F.lit("\"'"))), lambda x: x != "")
    plain = {k: line_field(t, k) for k in FIELDS if k not in ("tags", "source_index")}
    index = line_field(t, "source_index")
    return df.select("*", *[v.alias(k) for k, v in plain.items()], tags.alias("tags"), F.when(index.rlike(r"^\d+$"), index.cast("int")).alias("source_index"))


def yaml_records(df: DataFrame, text: str = "value") -> DataFrame:
    """df with the record's fields by a full YAML parser, and `parsed`: false for files that don't parse to a mapping."""
    schema = "name string, description string, tags array<string>, orientation string, state string, group_id string, source string, source_index int, parsed boolean"

    @F.pandas_udf(schema)
    def parse(values: pd.Series) -> pd.DataFrame:
        import yaml

        out = []
        for v in values:
            try:
                got = yaml.safe_load(v or "") or {}
                ok = isinstance(got, dict)
            except yaml.YAMLError:
                got, ok = {}, False
            got = got if ok else {}
            text_of = lambda k: None if got.get(k) is None else str(got[k])  # noqa: E731, B023
            tags = got.get("tags")
            index = got.get("source_index")
            out.append([*[text_of(k) if k not in ("tags", "source_index") else None for k in FIELDS], ok])
            out[-1][2] = [str(t) for t in tags] if isinstance(tags, list) else None
            out[-1][7] = index if isinstance(index, int) else None
        return pd.DataFrame(out, columns=[*FIELDS, "parsed"])

    return df.withColumn("record", parse(text)).select(*df.columns, "record.*")


def tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated rows after a header line, those of two columns or more."""
    names = [c.split()[0] for c in schema.split(",")]
    return spark.read.schema(schema).csv(path, sep="\t", header=True).where(F.col(names[1]).isNotNull())


def lines(spark: SparkSession, path: str) -> DataFrame:
    """value and at: the lines of text files and a position that orders them by file, then as they lie in it.

    A split of a file is read by one task from its start to its end, so file, start of the split and the task's own count
    order lines however splits are dealt to tasks.
    """
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("nth"))
    return spark.read.text(path).select("value", at.alias("at"))


def hash_list(spark: SparkSession, path: str) -> DataFrame:
    """md5 and path of lines `md5  path`; of lines with one md5 the first (files in order of their paths) wins. A line without
    the two blanks is an md5 without a path; one that begins with them is left out."""
    parts = lines(spark, path).select(F.split_part("value", F.lit("  "), F.lit(1)).alias("md5"), F.regexp_extract("value", r"^.*?  (.*)$", 1).alias("path"), "at")
    return parts.where("md5 <> ''").groupBy("md5").agg(F.min_by("path", "at").alias("path"))


def stem_and_index(file: Column, suffix: str = "png") -> Column:
    """stem, idx and source (the sheet's file) of `<stem>_<number>.<suffix>`, null for other names."""
    pattern = rf"^(.+)_(\d+)\.{suffix}$"
    stem = F.regexp_extract(file, pattern, 1)
    return F.when(file.rlike(pattern), F.struct(stem.alias("stem"), F.regexp_extract(file, pattern, 2).cast("int").alias("idx"), F.concat(stem, F.lit(f".{suffix}")).alias("source")))


def list_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are neither blank nor comments."""
    return spark.read.text(path).select(F.btrim("value").alias("value")).where((F.col("value") != "") & ~F.col("value").startswith("#"))


def caption_line(line: Column) -> Column:
    """trigger, subject and tags of a comma-separated caption."""
    parts = F.transform(F.split(line, ","), lambda x: F.btrim(x))
    return F.struct(F.get(parts, F.lit(0)).alias("trigger"), F.get(parts, F.lit(1)).alias("subject"), F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0))).alias("tags"))


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return with_path(spark.read.schema(schema).option("multiLine", True).json(path))


def labelled_lines(text: Column) -> Column:
    """A map of `label: value` lines."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.contains(":"))
    return F.map_from_entries(F.transform(lines, lambda x: F.struct(F.btrim(F.split_part(x, F.lit(":"), F.lit(1))), F.btrim(F.regexp_extract(x, r"^[^:]*:(.*)$", 1)))))


VECTOR_MAP = (
    "resolution struct<map_origin:struct<x:double,y:double>,map_size:struct<x:double,y:double>,pixels_per_grid:double>, "
    "line_of_sight array<array<struct<x:double,y:double>>>, objects_line_of_sight array<array<struct<x:double,y:double>>>, "
    "portals array<struct<position:struct<x:double,y:double>,bounds:array<struct<x:double,y:double>>,rotation:double,closed:boolean,freestanding:boolean>>, "
    "lights array<struct<position:struct<x:double,y:double>,range:double,intensity:double,color:string>>, image string"
)


def polylines(text: Column, parsed: Column, field: str) -> Column:
    """The field's lines; older exports have one line as a flat list of points. Empty lines are left out."""
    none = F.array().cast("array<array<struct<x:double,y:double>>>")
    flat = F.from_json(F.get_json_object(text, f"$.{field}"), "array<struct<x:double,y:double>>")
    one = F.get_json_object(text, f"$.{field}[0].x").isNotNull()
    return F.filter(F.coalesce(F.when(one, F.array(flat)).otherwise(parsed[field]), none), lambda p: p.isNotNull() & (F.size(p) > 0))


def vector_map(text: Column) -> Column:
    """A vector map with all its lists; one without a size is an error, one without a grid has 100 pixels a square."""
    v = F.from_json(text, VECTOR_MAP)
    size = F.when(v["resolution"]["map_size"].isNull(), F.raise_error(F.lit("map_size is missing")).cast("struct<x:double,y:double>")).otherwise(v["resolution"]["map_size"])
    zero = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    both = F.concat(polylines(text, v, "line_of_sight"), polylines(text, v, "objects_line_of_sight"))
    return F.struct(
        F.coalesce(v["resolution"]["map_origin"], zero).alias("origin"), size.alias("size"), F.coalesce(F.bround(v["resolution"]["pixels_per_grid"]), F.lit(100.0)).cast("int").alias("per_grid"), both.alias("walls"),
        F.coalesce(v["portals"], F.from_json(F.lit("[]"), VECTOR_MAP.split("portals ")[1].split(", lights")[0])).alias("portals"),
        F.coalesce(v["lights"], F.from_json(F.lit("[]"), VECTOR_MAP.split("lights ")[1].split(", image")[0])).alias("lights"),
        F.unbase64(v["image"]).alias("image"),
    )


def zip_member(df: DataFrame, pattern: str, content: str = "content") -> DataFrame:
    """df with member and bytes: the first file, by name, of each archive whose name matches; null if none does."""

    def pick(of: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re
        import zipfile

        for batch in of:
            found = []
            for raw in batch[content]:
                try:
                    with zipfile.ZipFile(io.BytesIO(raw)) as z:
                        name = next((n for n in sorted(z.namelist()) if re.search(pattern, n)), None)
                        found.append((name, z.read(name) if name else None))
                except (zipfile.BadZipFile, TypeError):
                    found.append((None, None))
            yield batch.drop(columns=[content]).assign(member=[f[0] for f in found], bytes=[f[1] for f in found])

    kept = [f for f in df.schema.fields if f.name != content]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", member string, bytes binary"
    return df.select(*[f.name for f in kept], content).mapInPandas(pick, schema)


def pooled_vectors(raw: DataFrame) -> DataFrame:
    """stem and the mean vector over tokens, by position, of raw(stem, tokens: array of arrays)."""
    each = raw.select("stem", F.explode("tokens").alias("token")).select("stem", F.posexplode("token").alias("at", "x"))
    mean = each.groupBy("stem", "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return mean.groupBy("stem").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v")).select("stem", F.col("v.x").alias("embedding"))


def resolved_manifest(requested: Column, by_name: Column, override: Column, default: str) -> Column:
    """Explicit path, else the artifact folder's, else the table's, else the default."""
    return F.coalesce(requested, override, by_name, F.lit(default))


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """ord, pattern, value: an inline table of ordered rules, small enough for any join."""
    return spark.createDataFrame([(i, p, v) for i, (p, v) in enumerate(rules)], "ord int, pattern string, value string")
