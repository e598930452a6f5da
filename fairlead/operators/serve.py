"""What the site asks: facets, search, maps, calendars and lists."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import has_no_time, local_day
from ..functions.text import present


def facet_filter(rows: DataFrame, chosen: dict[str, list[str]], term: str = "", title: str = "title", body: str = "description") -> DataFrame:
    """[F8, S25] Rows that have one of the chosen values in every group with any, and the term in the title or the first 300
    characters of the body, in any case."""
    kinds, tests = dict(rows.dtypes), []
    for c, values in chosen.items():
        if values:
            tests.append(F.arrays_overlap(c, F.array(*map(F.lit, values))) if kinds[c].startswith("array") else F.col(c).isin(*values))
    if term:
        t = F.lower(F.lit(term.strip()))
        tests.append(F.contains(F.lower(title), t) | F.contains(F.substring(F.lower(body), 1, 300), t))
    return rows.filter(reduce(Column.__and__, tests)) if tests else rows


def facet_counts(rows: DataFrame, *fields: str) -> DataFrame:
    """[G1] (facet, value, n) of array members and plain values; nulls and empty texts don't count. One pass over the rows."""
    kinds = dict(rows.dtypes)

    def values(f: str) -> Column:
        return F.transform(F.col(f) if kinds[f].startswith("array") else F.array(f), lambda v: F.struct(F.lit(f).alias("facet"), v.cast("string").alias("value")))

    lists = [values(f) for f in fields]
    return rows.select(F.explode(F.concat(*lists)).alias("x")).select("x.*").filter(present("value")).groupBy("facet", "value").agg(F.count("*").alias("n"))


def mappable(lat: str = "latitude", lng: str = "longitude", box: tuple[float, float, float, float] | None = None) -> Column:
    """Both are numbers, not both 0, and in the box (south, west, north, east) if one is given."""
    a, b = F.col(lat).try_cast("double"), F.col(lng).try_cast("double")
    ok = a.isNotNull() & b.isNotNull() & ~((a == 0) & (b == 0))
    return F.coalesce(ok & a.between(box[0], box[2]) & b.between(box[1], box[3]) if box else ok, F.lit(False))


def coming_week(rows: DataFrame, today: date, days: int = 7) -> DataFrame:
    """Today and the next so many days, as written."""
    return rows.filter(local_day("date_start").between(F.lit(today), F.date_add(F.lit(today), days)))


def by_date(rows: DataFrame, *ties: str) -> DataFrame:
    """[O1] Dated rows by time, undated ones last."""
    return rows.orderBy(F.asc_nulls_last(F.col("date_start").try_cast("timestamp")), *ties)


def alphabetical(partners: DataFrame, name: str = "name") -> DataFrame:
    """[O2]"""
    return partners.orderBy(F.collate(F.col(name), "UNICODE_CI"), name)


def top_partners(partners: DataFrame, active: DataFrame, pinned: int, most: int = 16) -> DataFrame:
    """[O3, G10] Partners with a logo: the pinned one, then those with opportunities, then others, as they come."""
    names = active.select(F.col("partner_name").alias("name")).distinct().withColumn("active", F.lit(True))
    p = partners.filter(present("logo_src")).join(names, "name", "left")
    rank = F.when(F.col("id") == pinned, 0).when(F.col("active"), 1).otherwise(2)
    return p.orderBy(rank, "seq").drop("active").limit(most)


def of_partner(opportunities: DataFrame, partners: DataFrame) -> DataFrame:
    """[J12] Opportunities with the partner of exactly their partner's name."""
    return opportunities.join(partners.select(F.col("name").alias("partner_name"), F.col("id").alias("site_partner_id")), "partner_name", "left")


def calendar(rows: DataFrame, first_month: date, months: int = 3) -> DataFrame:
    """[N14, N15] (month, week, weekday, day, slug, date_start, has_time): each day of the months' full weeks from Sunday on, with
    the rows of the days that belong to the month; padding days have none."""
    spark = rows.sparkSession
    m = spark.range(months).select(F.add_months(F.trunc(F.lit(first_month), "month"), F.col("id").cast("int")).alias("month"))
    lo, hi = F.date_sub("month", F.dayofweek("month") - 1), F.last_day("month")
    days = m.select("month", F.explode(F.sequence(lo, F.date_add(hi, 7 - F.dayofweek(hi)))).alias("day"))
    week = F.floor(F.datediff("day", F.date_sub("month", F.dayofweek("month") - 1)) / 7)
    days = days.withColumn("week", week).withColumn("weekday", F.dayofweek("day")).withColumn("inside", F.trunc("day", "month") == F.col("month"))
    r = rows.select("slug", "date_start", local_day("date_start").alias("day"), (~has_no_time("date_start")).alias("has_time"), F.lit(True).alias("inside"))
    return days.join(r, ["day", "inside"], "left").select("month", "week", "weekday", "day", "slug", "date_start", "has_time")


def filter_state(query: Column | str) -> Column:
    """[S22] A query string as map<string, array<string>>."""
    q = F.regexp_replace(F.col(query) if isinstance(query, str) else query, r"^\?", "")
    pairs = F.filter(F.split(q, "&"), lambda p: F.contains(p, F.lit("=")))
    return F.map_from_entries(F.transform(pairs, lambda p: F.struct(F.url_decode(F.substring_index(p, "=", 1)).alias("key"), F.split(F.url_decode(F.regexp_replace(p, "^[^=]*=", "")), ",").alias("value"))))


def query_string(chosen: dict[str, list[str]]) -> str:
    """[S22]"""
    from urllib.parse import quote

    return "&".join(f"{quote(k)}={quote(','.join(v))}" for k, v in chosen.items() if v)
