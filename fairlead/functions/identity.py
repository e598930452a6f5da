"""Keys and hashes of records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, normalize_title

CONTENT = ("title", "description", "location", "cost", "registration_url", "image_url", "url", "categories", "tags", "start")


def identity_key(source: Column | str = "source_id", external: Column | str = "external_id", title: Column | str = "title", start: Column | str = "start") -> Column:
    """[M1, M2] What makes two records the same: source and external id, or source, normalised title and day; as text."""
    day = F.coalesce(F.date_format(col(start), "yyyy-MM-dd"), F.lit("None"))
    named = F.concat_ws("|", col(source), col(external))
    return F.when(F.coalesce(col(external), F.lit("")) != "", named).otherwise(F.concat_ws("|", col(source), normalize_title(title), day))


def identity_hash(**columns: Column | str) -> Column:
    """[M2]"""
    return F.sha2(identity_key(**columns), 256)


def content_hash(columns: tuple[str, ...] = CONTENT) -> Column:
    """[M3] Of the fields that enrichment reads, in a canonical JSON; nulls are written, so that null and missing agree."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"}), 256)


def url_key(url: Column | str) -> Column:
    """[M9]"""
    return F.sha2(col(url), 256)


def mirror_path(url: Column | str) -> Column:
    """[A40] Where a page lies in a mirror: path segments of at most 200 characters, "_index" for none, a hash of the query."""
    path = F.regexp_replace(F.coalesce(F.try_parse_url(col(url), F.lit("PATH")), F.lit("")), "^/+|/+$", "")
    path = F.when(path == "", "_index").otherwise(F.array_join(F.transform(F.split(path, "/+"), lambda s: F.substring(s, 1, 200)), "/"))
    query = F.try_parse_url(col(url), F.lit("QUERY"))
    return F.when(F.coalesce(query, F.lit("")) != "", F.concat(path, F.lit("_"), F.substring(F.sha2(query, 256), 1, 8))).otherwise(path)
