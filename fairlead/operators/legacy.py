"""Operators of the older batch pipeline that the engine itself doesn't use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, taxonomy
from ..functions.taxonomy import sitemap_kind
from ..functions.text import blob, clean_url, domain_of, filled, normalize_title, present, slugify
from .normalize import with_partner

#: Fixed values of the page predicates.
JUNK_TITLES = ("archives", "events calendar", "events from", "events for", "all events", "event list", "categories", "uncategorized", "author at", "page not found", "404")
JUNK_NAMES = ("events", "programs", "classes", "calendar")
LISTING_URLS = ("/page/", "?paged=", "/category/", "/tag/", "/author/", "/feed/")
LISTING_TITLES = ("archives", "events from ", "events for ", "all events", "event list")
NO_EVENT_URLS = ("/author/", "/category/", "/tag/")
PROCESSED_TIERS = ("1A", "1B", "1C", "2", "3")


def _holds(c: Column | str, words: tuple[str, ...]) -> Column:
    low, out = F.lower(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))), F.lit(False)
    for w in words:
        out = out | F.contains(low, F.lit(w))
    return out


def is_junk(title: str = "title", description: str = "description") -> Column:
    """[F6]"""
    return _holds(title, JUNK_TITLES) | (F.length(F.coalesce(description, F.lit(""))) < 30) | F.coalesce(F.lower(title).isin(*JUNK_NAMES), F.lit(False))


def is_listing(url: str = "url", title: str = "title") -> Column:
    """[F6]"""
    return _holds(url, LISTING_URLS) | _holds(title, LISTING_TITLES)


def is_valid(url: str = "url", title: str = "title") -> Column:
    """[F6]"""
    return (F.length(F.coalesce(title, F.lit(""))) >= 3) & ~is_listing(url, title) & ~_holds(url, NO_EVENT_URLS)


def has_real_date(start: str = "start_date", text: str = "date_text") -> Column:
    """[F7]"""
    return present(start) & ~F.startswith(F.coalesce(text, F.lit("")), F.lit("modified:"))


def processed(domains: DataFrame) -> DataFrame:
    """[F11]"""
    return domains.filter(F.col("tier").isin(*PROCESSED_TIERS))


def merge_by_url(first: DataFrame, second: DataFrame) -> DataFrame:
    """[J10, U3, S14] All of the first (source of record), then of the second what has another address; columns may differ."""
    a, b = first.withColumn("clean", clean_url("url")), second.withColumn("clean", clean_url("url"))
    rest = b.join(a.select("clean").distinct(), "clean", "left_anti")
    return a.withColumn("part", F.lit(0)).unionByName(rest.withColumn("part", F.lit(1)), allowMissingColumns=True).drop("clean")


def last_per_domain(partners: DataFrame, url: str = "website") -> DataFrame:
    """[J11, A41] The last partner of each domain."""
    w = Window.partitionBy("domain").orderBy(F.col("seq").desc())
    return partners.withColumn("domain", domain_of(url)).withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def first_per_org(records: DataFrame, *keys: str) -> DataFrame:
    """[G7] The first record of each organisation and normalised title (and further keys); its key is taken whatever becomes of it."""
    k = records.withColumn("title_norm", normalize_title("title"))
    w = Window.partitionBy("org", "title_norm", *keys).orderBy("seq")
    return k.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def collapse_titles(records: DataFrame) -> DataFrame:
    """[G8] One row for each organisation and normalised title: the longest description's row, first and last day as texts."""
    k = records.withColumn("title_norm", normalize_title("title"))
    rest = records.columns
    out = k.groupBy("org", "title_norm").agg(
        F.max_by(F.struct(*rest), F.struct(F.length("description"), -F.col("seq"))).alias("b"),
        F.min(F.nullif("start_date", F.lit(""))).alias("first_day"), F.max(F.nullif("start_date", F.lit(""))).alias("last_day"), F.count("*").alias("repeat_count"),
    )
    return out.select(*[f"b.{c}" for c in rest], "first_day", "last_day", "repeat_count")


def coverage(rows: DataFrame, **tests: Column) -> DataFrame:
    """[G2] total, and for each test how many rows pass it and the whole percents."""
    total = F.count("*")
    out = [total.alias("total")]
    for name, test in tests.items():
        n = F.count_if(test)
        out += [n.alias(name), F.floor(100 * n / F.greatest(total, F.lit(1))).alias(f"{name}_pct")]
    return rows.agg(*out)


def org_summary(dated: DataFrame, undated: DataFrame) -> DataFrame:
    """[G3] (org, n_dated, n_undated, total), most first."""
    both = dated.select("org", F.lit(1).alias("d")).unionByName(undated.select("org", F.lit(0).alias("d")))
    return both.groupBy("org").agg(F.sum("d").alias("n_dated"), F.sum(1 - F.col("d")).alias("n_undated"), F.count("*").alias("total")).orderBy(F.desc("total"), "org")


def sitemap_stats(entries: DataFrame) -> DataFrame:
    """[G4, T9] Of entries(domain, file, url, lastmod): numbers of addresses, first and last modification, event and program ones."""
    named = lambda p: F.count_if(F.rlike("url", F.lit(f"(?i){p}")))
    last = F.nullif("lastmod", F.lit(""))
    out = entries.groupBy("domain", "file").agg(
        F.count("*").alias("url_count"), F.min(last).alias("first_lastmod"), F.max(last).alias("last_lastmod"),
        named("/(events?|tribe_events|calendar)(/|$)").alias("event_url_count"), named("/(programs?|courses?|camps?|classes|workshops?|training)(/|$)").alias("program_url_count"),
    )
    return out.withColumn("category", sitemap_kind("file"))


def classify_domains(stats: DataFrame, sites: DataFrame) -> DataFrame:
    """[T10, J13] Tier and strategy of each site(domain, platform, plugin, event_dirs, program_dirs), with or without sitemaps."""
    by = stats.groupBy("domain").agg(
        F.count_if(F.col("category") == "event").alias("event_sitemaps"), F.count_if(F.col("category") == "program").alias("program_sitemaps"), F.count("*").alias("sitemaps"),
        F.sum("event_url_count").alias("event_urls"), F.sum("program_url_count").alias("program_urls"),
    )
    s = sites.join(by, "domain", "left").na.fill(0)
    t = taxonomy.tier(F.col("event_sitemaps"), F.col("program_sitemaps"), F.col("event_urls") + F.col("program_urls"), F.col("sitemaps"), F.col("event_dirs") + F.col("program_dirs"), F.col("plugin"), F.col("platform"))
    return s.withColumn("t", t).select(*s.columns, "t.tier", "t.strategy")


def site_plugins(pages: DataFrame, most: int = 10) -> DataFrame:
    """[T11] (domain, plugin) from the first so many pages of each domain: sorted, with commas between, or "none"."""
    w = Window.partitionBy("domain").orderBy("at")
    p = pages.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= most).withColumn("found", taxonomy.plugins("html"))
    return p.groupBy("domain").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))), ",").alias("p")).select("domain", F.coalesce(F.nullif("p", F.lit("")), F.lit("none")).alias("plugin"))


def histogram(rows: DataFrame, column: str) -> DataFrame:
    """[G5, O5]"""
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def sample(pages: DataFrame, sites: int = 5, files: int = 10, per_file: int = 3) -> DataFrame:
    """[G6] Of pages(group, domain, file, at): so many sites of each group, files of each site and pages of each file, in order."""
    rank = lambda *by: F.dense_rank().over(Window.partitionBy(*by[:-1]).orderBy(by[-1]))
    p = pages.withColumn("__s", rank("group", "domain")).filter(F.col("__s") <= sites).withColumn("__f", rank("group", "domain", "file")).filter(F.col("__f") <= files)
    return p.withColumn("__p", F.row_number().over(Window.partitionBy("group", "domain", "file").orderBy("at"))).filter(F.col("__p") <= per_file).drop("__s", "__f", "__p")


def flatten_tec(records: DataFrame) -> DataFrame:
    """[S23] Older records' venue and organiser structs as flat columns."""
    o = F.get("organizer", F.lit(0))
    return records.select("*", F.concat_ws(", ", *[F.nullif(F.col(f"venue.{c}"), F.lit("")) for c in ("venue", "address", "city", "state", "zip")]).alias("location"), o["organizer"].alias("organizer_name"), o["email"].alias("organizer_email"))


def build_opportunities(records: DataFrame, partners: DataFrame) -> DataFrame:
    """[S24] Opportunities from flat records(seq, org, title, description, categories, tags, start_date, end_date, start_time, end_time,
    cost, location, registration_url, page_url, all_day, repeat_count): times are texts, and nothing is known of their origin."""
    r = with_partner(records.withColumn("org_name", F.col("org")), partners)
    text = blob("title", "description", "categories", "tags")
    times = F.concat_ws(" – ", filled("start_time"), filled("end_time"))
    series = F.when(F.col("repeat_count") > 1, F.concat(F.lit("Repeats "), F.col("repeat_count").cast("string"), F.lit(" times through "), F.coalesce(filled("end_date"), "start_date")))
    hour = F.hour(dates.parse_iso(F.substring(dates.clock_to_iso("start_date", "start_time"), 1, 19)))
    part = F.when(F.col("all_day"), "All Day").when(~present("start_time"), None).when(hour < 12, "Morning").when(hour < 17, "Afternoon").otherwise("Evening")
    return r.select(
        F.concat_ws("_", F.substring(slugify("org"), 1, 40), F.substring(slugify("title"), 1, 60), F.replace("start_date", F.lit("-"), F.lit(""))).alias("slug"),
        "title", F.coalesce(filled("partner.name"), "org").alias("partner_name"), F.col("partner.id").alias("partner_id"), "description", F.coalesce(filled("registration_url"), "page_url").alias("link"),
        F.concat_ws("; ", F.nullif(times, F.lit("")), series).alias("availability"), dates.clock_to_iso("start_date", "start_time").alias("date_start"), dates.clock_to_iso("end_date", "end_time").alias("date_end"),
        taxonomy.age_grade_level(text).alias("age_grade_level"), taxonomy.cost_range("cost").alias("cost_range"), F.array_compact(F.array(part)).alias("time_of_day"),
        F.lit(taxonomy.DEFAULT_TYPE).alias("opportunity_type"), taxonomy.areas_of_interest(text).alias("areas_of_interest"), F.coalesce(filled("location"), "partner.location", F.lit("")).alias("location"),
        F.coalesce("partner.logo_src", F.lit("")).alias("logo_src"), "seq",
    )
