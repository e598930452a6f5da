"""Whole runs: from landed pages to published opportunities, and from hub pages to new candidates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import enrich as enriching
from ..operators.export import candidate_stubs, published
from ..operators.normalize import as_lookup, instances_of, to_opportunities
from ..operators.observe import Reporter, source_yield
from ..sources import calendars, discovery, feeds, html

#: [A7, V1] Adapters by type: landed pages to canonical events.
ADAPTERS = feeds.ADAPTERS | {"ical": calendars.ical, "generic_html": html.ladder, "listing_html": html.ladder}


@dataclass
class Run:
    events: DataFrame
    opportunities: DataFrame
    published: DataFrame
    report: DataFrame
    cache: DataFrame | None


def acquire(pages: DataFrame, sources: DataFrame, adapters: dict[str, Callable[[DataFrame], DataFrame]] = ADAPTERS) -> DataFrame:
    """[A7, A8, O4, U1] Canonical events of all sources; an unknown adapter gives none. seq follows the order of the registry, the
    page and the record, whatever finishes first."""
    typed = pages.join(as_lookup(sources.select("source_id", "source_seq", "adapter_type", F.coalesce(F.col("acquisition_policy")["max_urls"].cast("int"), F.lit(300)).alias("max_urls"))), "source_id")
    kinds = {r[0]: r[1] for r in sources.groupBy("adapter_type").agg(F.max(F.coalesce(F.col("acquisition_policy")["max_urls"].cast("int"), F.lit(300)))).collect()}
    typed = feeds.cap_per_source(typed, F.col("max_urls"), ceiling=max(kinds.values(), default=300))
    told = sources.select("source_id", "config") if "config" in sources.columns and "config" not in pages.columns else None

    def of(kind: str) -> DataFrame:
        own = typed.filter(F.col("adapter_type") == kind).select(*pages.columns)
        return own.join(as_lookup(told), "source_id") if kind in feeds.CONFIGURED and told is not None else own

    parts = [adapters[k](of(k)) for k in sorted(kinds) if k in adapters]
    if not parts:
        return feeds.tec(pages.limit(0))
    events = reduce(DataFrame.unionByName, parts)
    order = as_lookup(sources.select("source_id", "source_seq"))
    return events.join(order, "source_id").withColumn("seq", F.col("source_seq") * 1_000_000_000_000 + F.col("seq")).drop("source_seq").select(*events.columns)


def run(
    pages: DataFrame,
    sources: DataFrame,
    partners: DataFrame,
    today: date,
    *,
    enrichers: Sequence[Callable[[DataFrame], DataFrame]] = (),
    client: Callable[[dict], str] | None = None,
    cache: DataFrame | None = None,
    previous: DataFrame | None = None,
    image_resolver: Callable | None = None,
    reporter: Reporter | None = None,
) -> Run:
    """The chain: acquire, enrich and gate (with a client or cache, or further enrichers [V2]), collapse, merge, map, publish,
    report, and tell the reporter [V3]. Everything is lazy; one `today` holds throughout."""
    events = found = acquire(pages, sources)
    if client is not None and cache is None:
        cache = pages.sparkSession.createDataFrame([], "identity string, content_hash string, reply string")
    if cache is not None:
        events, cache = enriching.enrich(events, cache, client)
    for e in enrichers:
        events = e(events)
    opportunities = to_opportunities(instances_of(events, today), partners, sources, image_resolver)
    if reporter is not None:
        reporter.record_sources(sources, found)
        reporter.record_opportunities(opportunities)
    return Run(found, opportunities, published(opportunities, today), source_yield(found, opportunities, sources, previous), cache)


def discover_candidates(hub_pages: DataFrame, sources: DataFrame, queued: DataFrame | None = None, gate: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """[A28, J4, J9, E7, X9] Stubs of organisations that hub pages name and the registry doesn't know."""
    known = sources.select("org_name", F.col("config")["site_url"].alias("site_url"))
    new = discovery.new_candidates(discovery.hub_candidates(hub_pages), known, queued)
    return candidate_stubs(gate(new) if gate else new, queued)
