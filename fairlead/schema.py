"""Schemas of the canonical tables. Payloads are read with explicit schemas, so a malformed feed cannot change types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PROVENANCE = "map<string,struct<source:string,confidence:double>>"
#: name -> (type, default as SQL)
EVENT_FIELDS: dict[str, tuple[str, str]] = {
    "seq": ("bigint", "0"),
    "kind": ("string", "'event'"),
    **{n: ("string", "''") for n in ("source_id", "external_id", "url", "title", "description")},
    "trusted": ("boolean", "false"),
    "start": ("timestamp_ntz", "null"),
    "end": ("timestamp_ntz", "null"),
    "all_day": ("boolean", "false"),
    "location": ("string", "''"),
    "latitude": ("double", "null"),
    "longitude": ("double", "null"),
    **{n: ("string", "''") for n in ("cost", "registration_url", "image_url")},
    "categories": ("array<string>", "array()"),
    "tags": ("array<string>", "array()"),
    "relevant": ("boolean", "null"),
    "relevance_reason": ("string", "''"),
    "cost_range": ("string", "''"),
    "areas_of_interest": ("array<string>", "array()"),
    "age_grade_level": ("array<string>", "array()"),
    "time_of_day": ("array<string>", "array()"),
    "field_provenance": (PROVENANCE, "map()"),
}
EVENT = ", ".join(f"`{n}` {t}" for n, (t, _) in EVENT_FIELDS.items())
RAW_PAGE = "source_id string, page_seq bigint, url string, status int, body string"
SOURCE = "source_id string, source_seq bigint, org_name string, adapter_type string, enabled boolean, config map<string,string>, taxonomy_defaults map<string,string>, acquisition_policy map<string,string>"
PARTNER = "id bigint, name string, organization_type string, description string, location string, latitude double, longitude double, website string, logo_src string"
OPPORTUNITY_COLUMNS = (
    "slug", "title", "partner_name", "partner_id", "description", "link", "availability", "date_start", "date_end", "age_grade_level", "cost_range", "time_of_day",
    "opportunity_type", "areas_of_interest", "specific_attention", "financial_support", "ngss_aligned", "location", "latitude", "longitude", "contact_name",
    "contact_email", "contact_phone", "logo_src", "image_src",
)


def as_events(df: DataFrame, confidence: float | None = None, **columns: Column | str) -> DataFrame:
    """Canonical rows from expressions; fields not given get their defaults, and text fields are never null. With a confidence,
    each non-empty field is noted in field_provenance with the row's source_id."""
    picked = []
    for name, (kind, default) in EVENT_FIELDS.items():
        c = columns.get(name)
        c = F.col(c) if isinstance(c, str) else c
        value = F.expr(f"cast({default} as {kind})") if c is None else c.cast(kind)
        if c is not None and default != "null":
            value = F.coalesce(value, F.expr(f"cast({default} as {kind})"))
        picked.append(value.alias(name))
    out = df.select(*picked)
    return with_provenance(out, confidence, [n for n in columns if n in NOTED]) if confidence is not None else out


NOTED = ("title", "description", "start", "end", "location", "cost", "registration_url", "image_url", "categories", "tags", "age_grade_level", "time_of_day")


def with_provenance(events: DataFrame, confidence: float, fields: list[str]) -> DataFrame:
    """[M10] Notes source and confidence of the fields that are filled."""
    unknown = set(fields) - set(EVENT_FIELDS)
    if unknown:
        raise ValueError(f"no such field: {sorted(unknown)}")
    note = F.struct(F.col("source_id").alias("source"), F.lit(float(confidence)).alias("confidence"))
    there = [F.when(is_filled(f), F.struct(F.lit(f).alias("key"), note.alias("value"))) for f in fields]
    given = F.map_from_entries(F.array_compact(F.array(*there)))
    return events.withColumn("field_provenance", overlaid("field_provenance", given))


def is_filled(field: str) -> Column:
    kind, c = EVENT_FIELDS[field][0], F.col(field)
    return F.size(c) > 0 if kind.startswith("array") else F.coalesce(c, F.lit("")) != "" if kind == "string" else c.isNotNull()


def overlaid(base: Column | str, above: Column) -> Column:
    """Maps united; where both have a key the latter's value counts."""
    base = F.col(base) if isinstance(base, str) else base
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(above), k)), above)


def empty_events(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], EVENT)
