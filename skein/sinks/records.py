"""Updates of record tables, rendered exports, and mirror plans. Updates are new versions of a table, never in place."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import text as T


def updated(df: DataFrame, changes: dict[str, Column], when: Column | None = None) -> DataFrame:
    """Only columns that df has are changed, and only where `when` holds."""
    known = {k: v for k, v in changes.items() if k in df.columns}
    return df.withColumns({k: v if when is None else F.when(when, v).otherwise(F.col(k)) for k, v in known.items()})


def upserted(df: DataFrame, key: str, new: DataFrame, field: str) -> DataFrame:
    """field from new(key, field) where it has one, else as it is; added if df lacks it."""
    got = new.select(F.col(key), F.col(field).alias("new_value"))
    old = F.col(field) if field in df.columns else F.lit(None)
    return df.join(got, key, "left").withColumn(field, F.coalesce("new_value", old)).drop("new_value")


def replaced_line(text: Column, key: str, value: Column) -> Column:
    """text and changed: the text with the first line `key:` set to the value (null as null), and whether that changed it."""
    line = rf"(?dsm)\A(.*?)^{key}:[^\n]*$(.*)\z"
    new = F.concat(F.regexp_extract(text, line, 1), F.lit(f"{key}: "), F.coalesce(value, F.lit("null")), F.regexp_extract(text, line, 2))
    new = F.when(text.rlike(line), new).otherwise(text)
    return F.struct(new.alias("text"), (new != text).alias("changed"))


#: Where a text's lines end, and a line of a key (key, value, comment), with Unicode's white space (fixed values).
LINE_ENDS = r"(?<=[\n\x0B\x0C\x1C\x1D\x1E\x85\u2028\u2029])|(?<=\r)(?!\n)"
KEY_LINE = r"(?dU)^([A-Za-z_][A-Za-z0-9_]*)\s*:\s*(.*?)(\s*#.*)?$"


def rewritten(text: Column, fields: dict[str, Column], lists: Sequence[str] = ("tags",)) -> Column:
    """A record's text with the values of top-level keys replaced, everything else byte for byte as it was.

    Lines keep their order and their trailing comments, and comments, blank lines, other keys and lines that are none stay.
    A key that the text lacks isn't added; a null value becomes null (of a list: an empty one). A # begins a comment.
    """

    def one(line: Column) -> Column:
        body = F.rtrim(line, F.lit("\n"))
        key, comment = F.regexp_extract(body, KEY_LINE, 1), F.regexp_extract(body, KEY_LINE, 3)
        end = F.when(line.endswith("\n"), "\n").otherwise("")
        plain = (T.trimmed(line) == "") | T.trimmed(line).startswith("#") | ~body.rlike(KEY_LINE)
        out = F.when(plain, line)
        for name, value in fields.items():
            value = T.quoted_list(value) if name in lists else T.quoted(value)
            out = out.when(key == name, F.concat(F.lit(f"{name}: "), value, comment, end))
        return out.otherwise(line)

    return F.array_join(F.transform(F.split(text, LINE_ENDS), one), "")


def nullified(df: DataFrame, field: str, failing: Column) -> DataFrame:
    return df.withColumn(field, F.when(~F.coalesce(failing, F.lit(False)), F.col(field)))


def recoded(df: DataFrame, field: str, old: Sequence[str], new: str) -> DataFrame:
    return df.withColumn(field, F.when(F.col(field).isin(*old), F.lit(new)).otherwise(F.col(field)))


def inserted_if_absent(assets: DataFrame, records: DataFrame, key: str, template: dict[str, Column], force: bool = False) -> DataFrame:
    """Records with a templated row for each asset without one (for every asset with force)."""
    new = (assets if force else assets.join(records, key, "left_anti")).select(key, *[v.alias(k) for k, v in template.items()])
    old = records.join(assets, key, "left_anti") if force else records
    return old.unionByName(new, allowMissingColumns=True)


def rendered(fields: Sequence[str], lists: Sequence[str] = ("tags",)) -> Column:
    """A record as YAML lines, in the order of fields."""
    return F.concat_ws("\n", *[F.concat(F.lit(f"{k}: "), T.quoted_list(F.col(k)) if k in lists else T.quoted(F.col(k).cast("string"))) for k in fields])


def json_array(df: DataFrame, row: Column, order: str) -> DataFrame:
    """One row: all rows as a JSON array in order (an export of a report or pack, not for large tables)."""
    return df.agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), row.alias("v")))), lambda x: x["v"])).alias("value"))


def documents(df: DataFrame, row: Column, path: str) -> None:
    """A JSON line for each row, replacing what was there."""
    df.select(F.to_json(row).alias("value")).write.mode("overwrite").text(path)


def key_values(df: DataFrame, key: str, row: Column, prefix: str) -> DataFrame:
    """key and JSON value of each row that has a key."""
    return df.where(F.col(key).isNotNull()).select(F.concat(F.lit(prefix), F.col(key)).alias("key"), F.to_json(row).alias("value"))


def appended_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("append").csv(path, sep="\t", header=False)


def sorted_map(df: DataFrame, key: str, value: Column) -> DataFrame:
    """One row: a JSON object with sorted keys (an index of a pack)."""
    return df.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key).alias("key"), value.alias("value")))))).alias("value"))


def mirror_plan(source: DataFrame, target: DataFrame, key: str, digest: str) -> DataFrame:
    """key and action: link what is new, replace what differs, skip what is alike, prune what the source lacks."""
    s, t = source.select(key, F.col(digest).alias("s"), F.lit(1).alias("in_s")), target.select(key, F.col(digest).alias("t"), F.lit(1).alias("in_t"))
    action = F.when(F.col("in_t").isNull(), "link").when(F.col("in_s").isNull(), "prune").when(F.col("s").eqNullSafe(F.col("t")), "skip").otherwise("replace")
    return s.join(t, key, "full_outer").select(key, action.alias("action"))


def png(width: int, height: int, rgba: bytes) -> bytes:
    """A PNG of RGBA pixels."""
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    lines = b"".join(b"\0" + rgba[y * width * 4 : (y + 1) * width * 4] for y in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")
