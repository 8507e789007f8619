"""Pixels of image files as tables, and image bytes from pixel tables; landed JSON of image catalogues."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.sinks.records import png


def pixels(spark: SparkSession, path: str) -> DataFrame:
    """image_id (the file), y, x, r, g, b, a of every pixel of a folder's images; alpha is 255 where there is none."""
    image = spark.read.format("image").load(path).select("image.*")
    byte = lambda i: F.conv(F.hex(F.substring("data", i + 1, 1)), 16, 10).cast("int")
    rows = image.select(F.element_at(F.split("origin", "/"), -1).alias("image_id"), "width", "nChannels", "data", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("y"))
    rows = rows.select("image_id", "nChannels", "y", F.substring("data", F.col("y") * F.col("width") * F.col("nChannels") + 1, F.col("width") * F.col("nChannels")).alias("data"), F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("x"))
    at = F.col("x") * F.col("nChannels")
    grey = F.col("nChannels") == 1
    pick = lambda i: F.when(grey, byte(at)).otherwise(byte(at + i))
    return rows.select("image_id", "y", "x", pick(2).alias("r"), pick(1).alias("g"), pick(0).alias("b"), F.when(F.col("nChannels") == 4, byte(at + 3)).otherwise(255).alias("a"))


def encoded(rgba: DataFrame) -> DataFrame:
    """image_id and PNG bytes of each image of a pixel table; one image at a time."""

    def encode(rows: pd.DataFrame) -> pd.DataFrame:
        h, w = int(rows["y"].max()) + 1, int(rows["x"].max()) + 1
        out = np.zeros((h, w, 4), np.uint8)
        out[rows["y"], rows["x"]] = rows[["r", "g", "b", "a"]].to_numpy(np.uint8)
        return pd.DataFrame({"image_id": rows["image_id"].iloc[:1], "content": [png(w, h, out.tobytes())]})

    return rgba.groupBy("image_id").applyInPandas(encode, f"image_id {dict(rgba.dtypes)['image_id']}, content binary")


def crops(rgba: DataFrame, found: DataFrame, padding: int) -> DataFrame:
    """Pixels inside each label's padded box of found(image_id, label, x0, y0, x1, y1), at the box's origin; what has
    another label in rgba(..., label) is transparent."""
    box = found.select("image_id", F.col("label").alias("own"), (F.col("x0") - padding).alias("left"), (F.col("y0") - padding).alias("top"), (F.col("x1") + padding).alias("right"), (F.col("y1") + padding).alias("bottom"))
    both = rgba.join(box, "image_id").where((F.col("x") >= F.col("left")) & (F.col("x") < F.col("right")) & (F.col("y") >= F.col("top")) & (F.col("y") < F.col("bottom")))
    x, y = F.col("x") - F.greatest("left", F.lit(0)), F.col("y") - F.greatest("top", F.lit(0))
    return both.select("image_id", "own", y.alias("y"), x.alias("x"), "r", "g", "b", F.when(F.col("label") == F.col("own"), F.col("a")).otherwise(0).alias("a"))


def media_files(landed: DataFrame) -> DataFrame:
    """title, url, width, height, mime, license of a media catalogue's pages, landed as JSON text in `value`."""
    schema = "query struct<pages:map<string,struct<title:string,imageinfo:array<struct<url:string,width:int,height:int,mime:string,extmetadata:map<string,struct<value:string>>>>>>>"
    pages = landed.select(F.explode(F.from_json("value", schema)["query"]["pages"]).alias("id", "page")).where(F.size("page.imageinfo") > 0)
    info = F.get("page.imageinfo", F.lit(0))
    return pages.select("page.title", info["url"].alias("url"), info["width"].alias("width"), info["height"].alias("height"), info["mime"].alias("mime"), info["extmetadata"]["LicenseShortName"]["value"].alias("license"))


def texture_assets(landed: DataFrame) -> DataFrame:
    """asset_id, category, downloads and tags of a texture catalogue, landed as a JSON object by asset in `value`."""
    schema = "map<string,struct<categories:array<string>,tags:array<string>,download_count:long>>"
    return landed.select(F.explode(F.from_json("value", schema)).alias("asset_id", "a")).select("asset_id", F.get("a.categories", F.lit(0)).alias("category"), F.col("a.download_count").alias("downloads"), "a.tags")


def material_assets(landed: DataFrame, site: str) -> DataFrame:
    """asset_id, place (from 0, as listed: by popularity), tags and link of a material catalogue, landed as a JSON object with a list of
    assets in `value`; the link is the site's for the identifier where there is none."""
    schema = "foundAssets array<struct<assetId:string,tags:array<string>,shortLink:string>>"
    rows = landed.select(F.posexplode(F.from_json("value", schema)["foundAssets"]).alias("place", "a")).where("a.assetId is not null")
    link = F.coalesce(F.col("a.shortLink"), F.concat(F.lit(site), F.col("a.assetId")))
    return rows.select(F.col("a.assetId").alias("asset_id"), "place", F.coalesce(F.col("a.tags"), F.array().cast("array<string>")).alias("tags"), link.alias("link"))
