"""Yield of each source: what was found, what came and went, and alerts."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLIFF = 0.5


class Reporter(Protocol):
    """[V3] Told what a run found for its sources, before anything is merged, and what it made of it, with the sources still named."""

    def record_sources(self, sources: DataFrame, events: DataFrame) -> None: ...

    def record_opportunities(self, opportunities: DataFrame) -> None: ...


class YieldReporter:
    """[V3] Keeps the (lazy) tables of one run and reports on them."""

    def __init__(self) -> None:
        self.sources = self.events = self.opportunities = None

    def record_sources(self, sources: DataFrame, events: DataFrame) -> None:
        self.sources, self.events = sources, events

    def record_opportunities(self, opportunities: DataFrame) -> None:
        self.opportunities = opportunities

    def report(self, previous: DataFrame | None = None) -> DataFrame:
        return source_yield(self.events, self.opportunities, self.sources, previous)


def source_yield(events: DataFrame, opportunities: DataFrame, sources: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """[Y1-Y4, J8] (source_id, found, dated, slugs, previous_found, delta, new, dropped, zero_yield, cliff), one row per source, with
    zeros for silent ones. previous: source_id, found, slugs of the last run. The first run raises no alarm."""
    counts = events.groupBy("source_id").agg(F.count("*").alias("found"), F.count("start").alias("dated"))
    slugs = opportunities.filter("slug <> ''").select(F.explode("sources").alias("source_id"), "slug").groupBy("source_id").agg(F.array_sort(F.collect_set("slug")).alias("slugs"))
    none = F.array().cast("array<string>")
    out = sources.select("source_id").join(counts, "source_id", "left").join(slugs, "source_id", "left").na.fill(0, ["found", "dated"]).withColumn("slugs", F.coalesce("slugs", none))
    if previous is None:
        out = out.withColumn("previous_found", F.lit(None).cast("long")).withColumn("previous_slugs", none)
    else:
        out = out.join(previous.select("source_id", F.col("found").alias("previous_found"), F.col("slugs").alias("previous_slugs")), "source_id", "left")
        out = out.withColumn("previous_slugs", F.coalesce("previous_slugs", none))
    was, now = F.col("previous_found"), F.col("found")
    return out.select(
        "source_id", "found", "dated", "slugs", "previous_found", (now - was).alias("delta"),
        F.size(F.array_except("slugs", "previous_slugs")).alias("new"), F.size(F.array_except("previous_slugs", "slugs")).alias("dropped"),
        F.coalesce((was > 0) & (now == 0), F.lit(False)).alias("zero_yield"), F.coalesce((was > 0) & (now > 0) & ((was - now) / was > CLIFF), F.lit(False)).alias("cliff"),
    )


def alerts(report: DataFrame) -> DataFrame:
    """[Y5]"""
    return report.filter("zero_yield or cliff")


def render_text(report: DataFrame) -> str:
    """[X8] A line per source, in order of the ids, and the alerts."""
    rows = report.orderBy("source_id").collect()
    lines = [f"{'source':<32}{'found':>8}{'dated':>8}{'new':>6}{'dropped':>9}{'delta':>8}"]
    for r in rows:
        lines.append(f"{r['source_id']:<32}{r['found']:>8}{r['dated']:>8}{r['new']:>6}{r['dropped']:>9}{'-' if r['delta'] is None else format(r['delta'], '+d'):>8}")
    told = [f"{'ZERO' if r['zero_yield'] else 'CLIFF'} {r['source_id']}: {r['previous_found']} -> {r['found']}" for r in rows if r["zero_yield"] or r["cliff"]]
    return "\n".join([*lines, *(["", "Alerts:"] + told if told else ["", "No alerts."])])
