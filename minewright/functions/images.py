"""Image names, sizes and inline images."""

from __future__ import annotations

import hashlib
import os
import struct
import unicodedata
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def safe_name(url: str | None, longest: int = 100) -> str | None:
    """A file name for an image URL: plain letters of the path's end, or a digest where none are left."""
    if url is None:
        return None
    digest = hashlib.md5(url.encode()).hexdigest()
    base = os.path.basename(unquote(urlparse(url).path))
    plain = unicodedata.normalize("NFKD", base).encode("ascii", "ignore").decode()
    plain = "".join(c for c in plain if c.isalnum() or c in "._-")
    stem, ext = os.path.splitext(plain)
    if not stem.strip("._-"):
        return f"img_{digest[:16]}{ext or '.unknown'}"
    return plain if len(plain) <= longest else f"{stem[:32]}_{digest[:8]}{ext}"


def image_name(url: Column) -> Column:
    @F.pandas_udf("string")
    def name(u: pd.Series) -> pd.Series:
        return u.map(safe_name)

    return name(url)


def image_size(data: bytes | None) -> tuple[int, int, bool] | None:
    """Width, height and whether there are several frames, from the header of a PNG, GIF, JPEG or BMP file."""
    if not data:
        return None
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return (*struct.unpack(">II", data[16:24]), b"acTL" in data[:4096])
    if data[:6] in (b"GIF87a", b"GIF89a") and len(data) >= 10:
        return (*struct.unpack("<HH", data[6:10]), data.count(b"\x21\xf9\x04") > 1)
    if data[:2] == b"BM" and len(data) >= 26:
        w, h = struct.unpack("<ii", data[18:26])
        return w, abs(h), False
    if data[:2] == b"\xff\xd8":
        i = 2
        while i + 9 < len(data) and data[i] == 0xFF:
            n = struct.unpack(">H", data[i + 2 : i + 4])[0]
            if 0xC0 <= data[i + 1] <= 0xCF and data[i + 1] not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", data[i + 5 : i + 9])
                return w, h, False
            i += 2 + n
    return None


def image_header(data: Column) -> Column:
    """``width, height, animated`` of image bytes; nulls for what is no known image."""

    @F.pandas_udf("struct<width:int,height:int,animated:boolean>")
    def header(d: pd.Series) -> pd.DataFrame:
        found = [image_size(bytes(x) if x is not None else None) or (None, None, None) for x in d]
        return pd.DataFrame(found, columns=["width", "height", "animated"]).astype({"width": "Int32", "height": "Int32", "animated": "boolean"})

    return header(data)


def file_large_enough(width: Column, height: Column, name: Column, least: int = 100) -> Column:
    """A file passes with either side long enough, an SVG always."""
    return F.lower(name).endswith(".svg") | (width >= least) | (height >= least)


def inline_large_enough(width: Column, height: Column, n_bytes: Column, least: int = 100) -> Column:
    """An inline image needs both sides and a hundred bytes."""
    return (width >= least) & (height >= least) & (n_bytes >= 100)


def decode_inline(uri: Column) -> Column:
    """``format, data`` of a data URI; the format is png unless named, missing padding is added."""
    kind = F.regexp_extract(uri, r"^data:image/([a-zA-Z+.-]+)", 1)
    body = F.regexp_replace(F.substring_index(uri, ",", -1), r"\s+", "")
    padded = F.rpad(body, (F.ceil(F.length(body) / 4) * 4).cast("int"), F.lit("="))
    known = F.create_map(*[F.lit(x) for kv in {"jpeg": "jpg", "jpg": "jpg", "png": "png", "gif": "gif", "svg+xml": "svg", "webp": "webp", "bmp": "bmp", "x-icon": "ico"}.items() for x in kv])
    return F.struct(F.coalesce(F.try_element_at(known, F.lower(kind)), F.lit("png")).alias("format"), F.unbase64(padded).alias("data"))


def unique_names(files: DataFrame, folder: str, name: str, digest: str) -> DataFrame:
    """``saved_as``: the same content under one name is one file; another content of the name gets ``_1``, ``_2``."""
    w = Window.partitionBy(folder, name)
    firsts = files.groupBy(folder, name, digest).agg(F.min("seq").alias("_first"))
    numbered = firsts.withColumn("_k", F.row_number().over(w.orderBy("_first")) - 1)
    stem, ext = F.regexp_replace(F.col(name), r"\.[^.]*$", ""), F.regexp_extract(F.col(name), r"(\.[^.]*)$", 1)
    saved = F.when(F.col("_k") == 0, F.col(name)).otherwise(F.concat(stem, F.lit("_"), F.col("_k").cast("string"), ext))
    return files.join(numbered.withColumn("saved_as", saved).drop("_first", "_k"), [folder, name, digest])


def best_prefix(cut: DataFrame, whole: DataFrame, key: str) -> DataFrame:
    """For each ``cut_id, head`` the ``whole_id`` of its key that shares the longest beginning, by share of the shorter; none if nothing is shared."""
    pairs = cut.join(whole, key)
    n = F.least(F.length("head"), F.length("body"))
    agree = F.size(F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(F.col("head"), F.lit(1), i) == F.substring(F.col("body"), F.lit(1), i)))
    scored = pairs.withColumn("score", F.when(n > 0, agree / n).otherwise(0.0)).where("score > 0")
    return scored.groupBy("cut_id").agg(F.max(F.struct("score", (-F.col("whole_id")).alias("m"), "whole_id")).alias("b")).select("cut_id", "b.whole_id", "b.score")
