"""[H10, X6] Images: type and size from the header bytes, the gate, and names by content."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_BYTES, LEAST_SIDE = 5 * 1024 * 1024, 80


def measure(data: bytes | None) -> tuple[str, int, int] | None:
    """(extension, width, height) of a PNG, JPEG, GIF or WebP body, else nothing."""
    d = data or b""
    try:
        if d[:8] == b"\x89PNG\r\n\x1a\n":
            return (".png", *struct.unpack(">II", d[16:24]))
        if d[:6] in (b"GIF87a", b"GIF89a"):
            return (".gif", *struct.unpack("<HH", d[6:10]))
        if d[:2] == b"\xff\xd8":
            at = 2
            while at + 9 < len(d):
                if d[at] != 0xFF:
                    at += 1
                    continue
                mark = d[at + 1]
                if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", d[at + 5 : at + 9])
                    return ".jpg", w, h
                at += 2 if mark in (0xFF, 0x01) or 0xD0 <= mark <= 0xD9 else 2 + struct.unpack(">H", d[at + 2 : at + 4])[0]
        if d[:4] == b"RIFF" and d[8:12] == b"WEBP":
            kind = d[12:16]
            if kind == b"VP8X":
                return ".webp", 1 + int.from_bytes(d[24:27], "little"), 1 + int.from_bytes(d[27:30], "little")
            if kind == b"VP8L":
                bits = int.from_bytes(d[21:25], "little")
                return ".webp", 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
            if kind == b"VP8 ":
                w, h = struct.unpack("<HH", d[26:30])
                return ".webp", w & 0x3FFF, h & 0x3FFF
    except struct.error:
        pass
    return None


@F.pandas_udf(T.StructType([T.StructField("extension", T.StringType()), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))
def measured(data: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(d) or (None, None, None) for d in data], columns=["extension", "width", "height"])


def hosted(images: DataFrame) -> DataFrame:
    """images(url, status, content_type, data) -> (url, file_name) of those let through: http(s), status 2xx, an image by its type
    and header, not too large or small. Equal contents share the first one's name."""
    ok = F.rlike("url", F.lit("(?i)^https?://")) & F.col("status").between(200, 299) & F.startswith(F.lower("content_type"), F.lit("image/")) & (F.length("data") <= MOST_BYTES)
    m = images.filter(ok).withColumn("m", measured("data")).filter((F.col("m.width") >= LEAST_SIDE) & (F.col("m.height") >= LEAST_SIDE))
    m = m.select("url", F.sha2("data", 256).alias("hash"), "m.extension")
    same = Window.partitionBy("hash").orderBy("url").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return m.select("url", F.concat(F.substring("hash", 1, 16), F.first("extension").over(same)).alias("file_name"))
