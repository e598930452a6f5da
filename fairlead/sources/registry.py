"""Registries: sources, hubs, ads and partners. A few small files each, read on the driver."""

from __future__ import annotations

import json
import logging
import tomllib
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_org_name
from ..schema import PARTNER, SOURCE

log = logging.getLogger(__name__)
DEFAULT_POLICY = {"max_urls": "300"}
HUB = "hub_id string, hub_name string, page_urls array<string>, config map<string,string>"
AD = "headline string, body string, link string, logo_src string"


def _text(value: Any) -> str:
    return value if isinstance(value, str) else json.dumps(value)


def _tables(folder: str, required: tuple[str, ...]) -> list[tuple[str, dict]]:
    """(stem, content) of the folder's TOML files in order of their names; unreadable or incomplete ones are logged and left out."""
    out = []
    for path in sorted(Path(folder).glob("*.toml")):
        try:
            data = tomllib.loads(path.read_text(encoding="utf-8"))
        except (OSError, UnicodeDecodeError, tomllib.TOMLDecodeError) as e:
            log.warning("%s is left out: %s", path.name, e)
            continue
        if missing := [k for k in required if not data.get(k)]:
            log.warning("%s is left out: no %s", path.name, ", ".join(missing))
            continue
        out.append((path.stem, data))
    return out


def load_sources(spark: SparkSession, folder: str) -> DataFrame:
    """[A1, A2] All valid sources; source_id is the file's stem, source_seq its place."""
    rows = []
    for n, (stem, d) in enumerate(_tables(folder, ("org_name", "adapter_type"))):
        maps = [{k: _text(v) for k, v in d.get(name, {}).items()} for name in ("config", "taxonomy_defaults", "acquisition_policy")]
        rows.append((stem, n, d["org_name"], d["adapter_type"], bool(d.get("enabled", True)), maps[0], maps[1], DEFAULT_POLICY | maps[2]))
    return spark.createDataFrame(rows, SOURCE)


def active_sources(sources: DataFrame, source_id: str | None = None, limit: int | None = None) -> DataFrame:
    """[A3, F1] Enabled ones, of them the named one, of them the first so many."""
    out = sources.filter("enabled")
    if source_id is not None:
        out = out.filter(F.col("source_id") == source_id)
    return out if limit is None else out.orderBy("source_seq").limit(limit)


def load_hubs(spark: SparkSession, folder: str) -> DataFrame:
    """[A4]"""
    rows = [(s, d["hub_name"], list(d["page_urls"]), {k: _text(v) for k, v in d.get("config", {}).items()}) for s, d in _tables(folder, ("hub_name", "page_urls"))]
    return spark.createDataFrame(rows, HUB)


def load_ads(spark: SparkSession, folder: str) -> DataFrame:
    """[A5, X13]"""
    rows = [(d["headline"], d.get("body", ""), d["link"], d.get("logo_src", "")) for _, d in _tables(folder, ("headline", "link"))]
    return spark.createDataFrame(rows, AD)


def load_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """[A34] Queued candidate stubs."""
    rows = [(s, d["org_name"], d["url"], d.get("hub_name", "")) for s, d in _tables(folder, ("org_name", "url"))]
    return spark.createDataFrame(rows, "slug string, org_name string, url string, hub_name string")


def read_partners(spark: SparkSession, path: str) -> DataFrame:
    """[A6] The partner dimension from a JSON array, with seq (place in the file) and org_norm; the first of equal names counts."""
    raw = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "array<struct<" + PARTNER.replace(", ", ",").replace(" ", ":") + ">>")).alias("seq", "p")).select("seq", "p.*")
    return first_partners(raw)


def first_partners(partners: DataFrame, order: str = "seq") -> DataFrame:
    keyed = partners.withColumn("org_norm", normalize_org_name("name"))
    first = Window.partitionBy("org_norm").orderBy(order)
    return keyed.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")


def read_partner_csv(spark: SparkSession, path: str, limit: int | None = None, done: DataFrame | None = None) -> DataFrame:
    """[A36, A41] Partners with a web address, less those already done (a frame with `website`)."""
    out = spark.read.csv(path, header=True).filter(F.rlike("website", F.lit("^https?://")))
    if done is not None:
        out = out.join(done.select("website"), "website", "left_anti")
    return out if limit is None else out.limit(limit)
