"""What is published: current and coming opportunities in order, with unique slugs; ads, reports and candidates."""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import date, datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.taxonomy import INTERNSHIP_TYPE
from ..functions.text import candidate_slug, filled
from ..schema import OPPORTUNITY_COLUMNS


def _day(c: Column) -> Column:
    return F.substring(c, 1, 10).try_cast("date")


def current(opportunities: DataFrame, today: date) -> DataFrame:
    """[X1] Those that end, or start, today or later; undated ones aren't, but internships without an end are."""
    t, end = F.lit(today), filled("date_end")
    last = _day(F.coalesce(end, filled("date_start")))
    keep = F.when(F.col("opportunity_type") == INTERNSHIP_TYPE, end.isNull() | (_day(end) >= t)).otherwise(last >= t)
    return opportunities.filter(F.coalesce(keep, F.lit(False)))


def unique_slugs(opportunities: DataFrame, *order: str) -> DataFrame:
    """[W2] The second and further rows of a slug get _2, _3 and so on, in order of date_start, then of arrival."""
    w = Window.partitionBy("slug").orderBy("date_start", *(order or ("part", "seq")))
    n = F.row_number().over(w)
    return opportunities.withColumn("__n", n).withColumn("slug", F.when(F.col("__n") > 1, F.concat_ws("_", "slug", F.col("__n").cast("string"))).otherwise(F.col("slug"))).drop("__n")


def published(opportunities: DataFrame, today: date) -> DataFrame:
    """[X1-X3, W2] In order of date_start (as text), then of arrival."""
    rows = unique_slugs(current(opportunities, today))
    return rows.orderBy("date_start", "part", "seq").select(*OPPORTUNITY_COLUMNS)


def _write_json(rows: DataFrame, columns: Iterable[str], target: Path) -> int:
    """A JSON array in a local file, read row by row, not gathered; the file is there whole or not at all."""
    target.parent.mkdir(parents=True, exist_ok=True)
    part, n = target.with_name(f"{target.name}.part"), 0
    with part.open("w", encoding="utf-8") as f:
        f.write("[")
        for r in rows.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("j")).toLocalIterator():
            f.write(("," if n else "") + "\n" + r["j"])
            n += 1
        f.write("\n]\n")
    part.replace(target)
    return n


def export_opportunities(opportunities: DataFrame, folder: str, today: date, now: datetime | None = None, dry_run: bool = False) -> dict:
    """[X4] opportunities.json and scrape-meta.json in a local folder, for a site that takes one file. Returns the meta data."""
    rows = published(opportunities, today)
    meta = {"last_updated": (now or datetime.now()).isoformat(timespec="seconds"), "count": 0}
    if dry_run:
        return meta | {"count": rows.count()}
    meta["count"] = _write_json(rows, OPPORTUNITY_COLUMNS, Path(folder) / "opportunities.json")
    (Path(folder) / "scrape-meta.json").write_text(json.dumps(meta))
    return meta


def export_older(opportunities: DataFrame, folder: str, today: date, dry_run: bool = False) -> int:
    """[2.15, S24] opportunities.json of the older chain: current ones with unique slugs, in order of date_start, then of arrival."""
    rows = unique_slugs(current(opportunities, today), "seq").orderBy("date_start", "seq")
    return rows.count() if dry_run else _write_json(rows, [c for c in rows.columns if c != "seq"], Path(folder) / "opportunities.json")


def write_opportunities(opportunities: DataFrame, path: str, today: date) -> None:
    """The same rows as Parquet, at any size."""
    published(opportunities, today).write.mode("overwrite").parquet(path)


def export_ads(ads: DataFrame, folder: str, dry_run: bool = False) -> str:
    """[X5, X13]"""
    text = json.dumps([r.asDict() for r in ads.collect()], ensure_ascii=False, indent=2)
    if not dry_run:
        Path(folder).mkdir(parents=True, exist_ok=True)
        (Path(folder) / "ads.json").write_text(text, encoding="utf-8")
    return text


def candidate_stubs(candidates: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """[X9, S5] (slug, org_name, url, hub_id, text): file names for new candidates, -2 and so on where a slug is taken, and their
    TOML text [S16]."""
    w = Window.partitionBy("base").orderBy("at", "url")
    c = candidates.withColumn("base", candidate_slug("org_name")).withColumn("n", F.row_number().over(w))
    if taken is not None:
        used = taken.select(F.regexp_replace("slug", r"-\d+$", "").alias("base")).groupBy("base").agg(F.count("*").alias("used"))
        c = c.join(used, "base", "left").withColumn("n", F.col("n") + F.coalesce("used", F.lit(0)))
    quoted = lambda x: F.concat(F.lit('"'), F.replace(F.replace(F.replace(F.col(x), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit('"'))
    text = F.concat(*[F.concat(F.lit(f"{k} = "), quoted(v), F.lit("\n")) for k, v in (("org_name", "org_name"), ("url", "url"), ("hub_name", "hub_id"))])
    slug = F.when(F.col("n") > 1, F.concat_ws("-", "base", F.col("n").cast("string"))).otherwise(F.col("base"))
    return c.select(slug.alias("slug"), "org_name", "url", "hub_id", text.alias("text"))


def write_candidates(stubs: DataFrame, folder: str) -> int:
    """[X9] A file for each stub; what exists is left alone."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    n = 0
    for r in stubs.toLocalIterator():
        path = Path(folder) / f"{r['slug']}.toml"
        if not path.exists():
            path.write_text(r["text"], encoding="utf-8")
            n += 1
    return n


def write_flat(rows: DataFrame, path: str) -> None:
    """[X11] JSON lines and CSV with a header; lists are joined by "; "."""
    rows.write.mode("overwrite").json(f"{path}.json")
    flat = [F.array_join(c, "; ").alias(c) if t.startswith("array") else F.col(c) for c, t in rows.dtypes if not t.startswith(("map", "struct"))]
    rows.select(*flat).write.mode("overwrite").csv(f"{path}.csv", header=True)


