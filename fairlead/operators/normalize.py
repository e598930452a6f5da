"""From events to opportunities: recurring events are collapsed, then sources merged, then rows mapped and joined to partners.

Order of arrival (`seq`) breaks every tie, as Spark keeps no order of its own."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import taxonomy
from ..functions.dates import iso_text
from ..functions.text import availability, blob, filled, normalize_org_name, normalize_title, opportunity_slug, present, unescape
from ..schema import OPPORTUNITY_COLUMNS
from ..sources.registry import first_partners

#: Dimensions with more rows than this are joined by a shuffle.
SMALL = 200_000


def as_lookup(dimension: DataFrame, limit: int = SMALL) -> DataFrame:
    """A dimension to be broadcast, if it is counted to be small; else it stays as it is, and adaptive execution sees to skew."""
    return F.broadcast(dimension) if dimension.limit(limit + 1).count() <= limit else dimension


def event_score() -> Column:
    """[N5] struct<confidence, filled>: mean confidence of the noted fields (0 without any), then how much is filled in."""
    notes = F.map_values("field_provenance")
    mean = F.when(F.size(notes) > 0, F.aggregate(notes, F.lit(0.0), lambda a, n: a + n["confidence"]) / F.size(notes)).otherwise(0.0)
    parts = [present(c).cast("int") for c in ("title", "description", "location", "cost", "registration_url", "image_url")]
    parts += [F.col(c).isNotNull().cast("int") for c in ("start", "end")] + [F.greatest(F.size(c), F.lit(0)) for c in ("categories", "tags")]
    return F.struct(mean.alias("confidence"), sum(parts[1:], parts[0]).alias("filled"))


def best_of(events: DataFrame, *keys: str, score: Column | None = None) -> DataFrame:
    """[W3] The row with the highest score in each group; of equals the first to arrive. A group's rows are compared by pairs in
    each task before the shuffle, so a hot group costs no more than others."""
    order = F.struct((event_score() if score is None else score).alias("s"), (-F.col("seq")).alias("n"))
    rest = [c for c in events.columns if c not in keys]
    return events.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("b")).select(*keys, *[f"b.{c}" for c in rest])


def collapse_recurring(events: DataFrame, today: date) -> DataFrame:
    """[N3, N4, N8] One row for each (source, normalised title): fields of the best row, the next start on or after today, the last
    end, and added repeat_count, last_seen and sources. seq becomes that of the group's first row."""
    day = F.lit(today)
    e = events.withColumn("title_norm", normalize_title("title"))
    best = e.groupBy("source_id", "title_norm").agg(
        F.max_by(F.struct(*events.columns), F.struct(event_score().alias("s"), (-F.col("seq")).alias("n"))).alias("b"),
        F.min(F.when(F.to_date("start") >= day, F.col("start"))).alias("next"),
        F.min("start").alias("first"),
        F.max(F.coalesce("end", "start")).alias("last"),
        F.count("*").alias("repeat_count"),
        F.min("seq").alias("first_seq"),
    )
    start = F.coalesce("next", F.when(F.to_date("last") >= day, day.cast("timestamp_ntz")), F.col("first"))
    end = F.when(F.col("last").isNotNull() & ~F.col("last").eqNullSafe(start), F.col("last")).otherwise(F.col("b.end"))
    new = {"start": start, "end": end, "seq": F.col("first_seq")}
    kept = [new.get(c, F.col(f"b.{c}")).alias(c) for c in events.columns]
    return best.select(*kept, "title_norm", "repeat_count", F.to_date("last").alias("last_seen"), F.array("source_id").alias("sources"))


def dedup_cross_source(instances: DataFrame) -> DataFrame:
    """[N6, U4] One row for each (normalised title, day or none, normalised place), whatever the source: the best row with its own
    count and last day, and all sources."""
    i = instances.withColumn("day", F.to_date("start")).withColumn("place", normalize_title("location"))
    rest = [c for c in instances.columns if c not in ("title_norm", "sources", "seq")]
    out = i.groupBy("title_norm", "day", "place").agg(
        F.max_by(F.struct(*rest), F.struct(event_score().alias("s"), (-F.col("seq")).alias("n"))).alias("b"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("sources")))).alias("all_sources"),
        F.min("seq").alias("seq"),
    )
    return out.select(*[f"b.{c}" for c in rest], "seq", "title_norm", F.col("all_sources").alias("sources"))


def instances_of(events: DataFrame, today: date) -> DataFrame:
    """[N3, N6, N7, U2] Collapsed and merged events, then internships one by one, in order of seq after the rest (`part`)."""
    jobs = events.filter("kind = 'internship'").withColumn("title_norm", normalize_title("title"))
    jobs = jobs.withColumn("repeat_count", F.lit(1).cast("long")).withColumn("last_seen", F.to_date(F.coalesce("end", "start"))).withColumn("sources", F.array("source_id"))
    rest = dedup_cross_source(collapse_recurring(events.filter("kind <> 'internship'"), today))
    return rest.withColumn("part", F.lit(0)).unionByName(jobs.withColumn("part", F.lit(1)))


def own_or(field: str, derived: Column) -> Column:
    """[N10] The row's own value where its origin is noted, else the derived one."""
    return F.when(F.map_contains_key("field_provenance", field), F.col(field)).otherwise(derived)


def with_org(instances: DataFrame, sources: DataFrame) -> DataFrame:
    """[J2] The organisation's name from the registry, else the source's id."""
    names = as_lookup(sources.select("source_id", F.col("org_name").alias("__org")))
    return instances.join(names, "source_id", "left").withColumn("org_name", F.coalesce("__org", "source_id")).drop("__org")


def with_partner(rows: DataFrame, partners: DataFrame) -> DataFrame:
    """[J1] Adds `partner`, the first partner of the same normalised name, or null."""
    p = partners if "org_norm" in partners.columns else first_partners(partners)
    p = as_lookup(p.select("org_norm", F.struct("id", "name", "location", "latitude", "longitude", "logo_src").alias("partner")))
    return rows.withColumn("org_norm", normalize_org_name("org_name")).join(p, "org_norm", "left").drop("org_norm")


def to_opportunities(instances: DataFrame, partners: DataFrame, sources: DataFrame, image_resolver: Callable[[Column], Column] | None = None) -> DataFrame:
    """[N9] The published columns, then sources, part and seq. Absent texts are empty, absent lists are []."""
    i = with_partner(with_org(instances, sources), partners)
    text = blob("title", "description", "categories", "tags")
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.col(f"partner.{c}").cast("string"), F.lit(""))
    job = F.col("kind") == "internship"
    image = F.when(present("image_url"), image_resolver(F.col("image_url"))) if image_resolver else F.lit("")
    none = F.array().cast("array<string>")
    columns = {
        "slug": opportunity_slug("org_name", "title", "start", "last_seen"),
        "title": unescape(F.col("title")),
        "partner_name": F.coalesce(filled("partner.name"), "org_name"),
        "partner_id": F.col("partner.id"),
        "description": F.col("description"),
        "link": F.coalesce(filled("registration_url"), "url"),
        "availability": availability("kind", "repeat_count", "last_seen", "end"),
        "date_start": iso_text("start"),
        "date_end": iso_text("end"),
        "age_grade_level": own_or("age_grade_level", taxonomy.age_grade_level(text)),
        "cost_range": own_or("cost_range", taxonomy.cost_range("cost")),
        "time_of_day": own_or("time_of_day", taxonomy.time_of_day("start", "all_day")),
        "opportunity_type": F.when(job, taxonomy.INTERNSHIP_TYPE).otherwise(taxonomy.opportunity_type("title")),
        "areas_of_interest": own_or("areas_of_interest", taxonomy.areas_of_interest(text)),
        "specific_attention": none,
        "financial_support": F.lit("No"),
        "ngss_aligned": F.lit("No"),
        "location": F.coalesce(filled("location"), F.col("partner.location"), F.lit("")),
        "latitude": number("latitude"),
        "longitude": number("longitude"),
        **{f"contact_{c}": F.lit("") for c in ("name", "email", "phone")},
        "logo_src": F.coalesce("partner.logo_src", F.lit("")),
        "image_src": F.coalesce(image, F.lit("")),
    }
    return i.select(*[columns[c].alias(c) for c in OPPORTUNITY_COLUMNS], "sources", "part", "seq")
