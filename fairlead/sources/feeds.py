"""Structured feeds. Each adapter turns landed pages (source_id, page_seq, url, status, body) into canonical events, with built-in
functions only; a page that isn't JSON of the feed's shape, and a record without a title or with an unreadable date, give no row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import taxonomy
from ..functions.dates import is_bad_date, parse_iso
from ..functions.text import filled, join_parts, present, strip_html, url_encode
from ..schema import as_events

_NAMES = "array<struct<name:string>>"
TEC = f"""struct<total:int,total_pages:int,events:array<struct<id:bigint,title:string,description:string,excerpt:string,start_date:string,end_date:string,
all_day:boolean,cost:string,url:string,website:string,image:struct<url:string>,venue:struct<venue:string,address:string,city:string,state:string>,
categories:{_NAMES},tags:{_NAMES}>>>""".replace("\n", "")
WORDPRESS = "array<struct<id:bigint,date:string,link:string,title:struct<rendered:string>,excerpt:struct<rendered:string>,content:struct<rendered:string>>>"
LOCALIST = """struct<page:struct<current:int,total:int>,events:array<struct<event:struct<id:bigint,title:string,description_text:string,first_date:string,last_date:string,
location_name:string,room_number:string,ticket_cost:string,url:string,urlname:string,localist_url:string,photo_url:string,tags:array<string>,keywords:array<string>>>>>""".replace("\n", "")
_CATALOGUE = "map<string,struct<name:string>>"
BIBLIOCOMMONS = f"""struct<events:struct<items:array<string>,pagination:struct<count:int,pages:int,page:int,`limit`:int>>,entities:struct<
events:map<string,struct<id:string,key:string,definition:struct<title:string,description:string,start:string,`end`:string,branchLocationId:string,nonBranchLocationId:string,
locationDetails:string,featuredImageId:string,audienceIds:array<string>,typeIds:array<string>,programId:string,isCancelled:boolean>>>,
locations:{_CATALOGUE},images:map<string,struct<url:string>>,eventTypes:{_CATALOGUE},eventAudiences:{_CATALOGUE},eventPrograms:{_CATALOGUE}>>""".replace("\n", "")
GREENHOUSE = "struct<jobs:array<struct<id:bigint,title:string,updated_at:string,location:struct<name:string>,absolute_url:string,content:string,departments:array<struct<name:string>>>>>"
LEVER = "array<struct<id:string,text:string,categories:struct<location:string,commitment:string,team:string,department:string>,descriptionPlain:string,description:string,hostedUrl:string,applyUrl:string,createdAt:bigint>>"
CLASSES = """array<struct<service_id:bigint,name:string,description:string,description_short:string,category_name:string,occurrence_id:bigint,start_at:string,end_at:string,
location_name:string,city:string,latitude:double,longitude:double,formatted_address:string>>""".replace("\n", "")
CLUBS = """array<struct<id:string,title:string,description:string,date_time:string,event_url:string,featured_photo_url:string,venue_name:string,address:string,city:string,
state:string,lat:double,lon:double>>""".replace("\n", "")


def _records(pages: DataFrame, schema: str, rows: str) -> DataFrame:
    """One row `r` per record of good pages [F3], with its place `at` in the page."""
    good = pages.filter("status = 200").withColumn("payload", F.from_json("body", schema))
    return good.select("source_id", "page_seq", "url", "payload", *[c for c in ("config",) if c in pages.columns], F.posexplode(rows).alias("at", "r"))


def _seq() -> Column:
    return F.col("page_seq") * 1_000_000 + F.col("at")


def _kept(df: DataFrame, title: Column, *dates: Column) -> DataFrame:
    """[F2]"""
    df = df.filter(F.coalesce(F.trim(title), F.lit("")) != "")
    for d in dates:
        df = df.filter(~is_bad_date(d))
    return df


def names_of(items: Column | str) -> Column:
    items = F.col(items) if isinstance(items, str) else items
    return F.filter(F.transform(items, lambda x: F.trim(x["name"])), lambda n: F.coalesce(n, F.lit("")) != "")


def resolve_names(ids: Column, catalogue: Column) -> Column:
    """[A18] Names of ids in order; unknown ids are passed over."""
    return F.filter(F.transform(ids, lambda i: F.try_element_at(catalogue, i)["name"]), lambda n: F.coalesce(n, F.lit("")) != "")


def first_per(df: DataFrame, key: Column, *scope: str, order: str = "at") -> DataFrame:
    """[A15, A17, W3] The first row of each key within the scope; rows without a key all stay."""
    w = Window.partitionBy(*scope, key).orderBy(order)
    return df.withColumn("__n", F.row_number().over(w)).filter((F.col("__n") == 1) | (F.coalesce(key, F.lit("")) == "")).drop("__n")


def cap_per_source(rows: DataFrame, most: Column | int = 300, order: str = "page_seq", ceiling: int | None = None) -> DataFrame:
    """[A8] The first `most` rows of each source. With a ceiling (the largest `most`) each task passes on no more than that of a
    source, so none gets all rows of a large one; a fixed `most` is its own ceiling."""
    w = Window.partitionBy("source_id").orderBy(order)
    ceiling, most = (most, F.lit(most)) if isinstance(most, int) else (ceiling, most)
    kept = rows.withColumn("__n", F.row_number().over(w))
    kept = kept if ceiling is None else kept.filter(F.col("__n") <= F.lit(ceiling))
    return kept.filter(F.col("__n") <= most).drop("__n")


def page_numbers(probes: DataFrame, total: Column | str = "total_pages", most: int = 100) -> DataFrame:
    """[A9, A14, A16] One row `page` for each page of each probed source, at most so many."""
    total = F.col(total) if isinstance(total, str) else total
    return probes.filter(total >= 1).withColumn("page", F.explode(F.sequence(F.lit(1), F.least(total, F.lit(most)))))


def tec(pages: DataFrame) -> DataFrame:
    """[A9, A10]"""
    r = _records(pages, TEC, "payload.events")
    r = _kept(r, F.col("r.title"), F.col("r.start_date"), F.col("r.end_date"))
    return as_events(
        r, 1.0, seq=_seq(), source_id="source_id", external_id=F.col("r.id").cast("string"), url=F.col("r.url"), title=strip_html("r.title"),
        description=strip_html(F.coalesce(filled("r.description"), F.col("r.excerpt"), F.lit(""))), start=parse_iso("r.start_date"), end=parse_iso("r.end_date"), all_day=F.col("r.all_day"),
        location=join_parts("r.venue.venue", "r.venue.address", "r.venue.city", "r.venue.state"), cost=F.col("r.cost"), registration_url=F.col("r.website"), image_url=F.col("r.image.url"),
        categories=names_of("r.categories"), tags=names_of("r.tags"),
    )


def wordpress(pages: DataFrame) -> DataFrame:
    """[A11] Posts: neither a start nor a place is known."""
    r = _kept(_records(pages, WORDPRESS, "payload"), F.col("r.title.rendered"))
    text = F.coalesce(filled(strip_html("r.excerpt.rendered")), strip_html("r.content.rendered"))
    return as_events(r, 1.0, seq=_seq(), source_id="source_id", external_id=F.col("r.id").cast("string"), url=F.col("r.link"), title=strip_html("r.title.rendered"), description=text)


def localist(pages: DataFrame) -> DataFrame:
    """[A14, A15] An id counts once a page, by the first of its records that can be read."""
    r = _records(pages, LOCALIST, "payload.events").withColumn("r", F.col("r.event"))
    r = first_per(_kept(r, F.col("r.title"), F.col("r.first_date"), F.col("r.last_date")), F.col("r.id").cast("string"), "source_id", "page_seq")
    return as_events(
        r, 1.0, seq=_seq(), source_id="source_id", external_id=F.col("r.id").cast("string"), url=F.trim(F.coalesce(filled("r.localist_url"), F.col("r.url"))), title=F.trim("r.title"),
        description=F.col("r.description_text"), start=parse_iso("r.first_date"), end=parse_iso("r.last_date"), location=join_parts("r.location_name", "r.room_number"), cost=F.col("r.ticket_cost"),
        image_url=F.col("r.photo_url"), tags=F.array_distinct(F.concat(F.coalesce("r.tags", F.array().cast("array<string>")), F.coalesce("r.keywords", F.array().cast("array<string>")))),
    )


def bibliocommons(pages: DataFrame, prefilter: bool = True) -> DataFrame:
    """[A16-A19, F4] Records in the order of `items`, each id once a page; audiences that are known must be young or families."""
    p = pages.filter("status = 200").withColumn("payload", F.from_json("body", BIBLIOCOMMONS))
    r = p.select("source_id", "page_seq", "payload", F.posexplode(F.array_distinct("payload.events.items")).alias("at", "id"))
    r = r.withColumn("r", F.try_element_at("payload.entities.events", F.col("id"))["definition"]).filter("r is not null")
    e = lambda ids, catalogue: resolve_names(F.col(f"r.{ids}"), F.col(f"payload.entities.{catalogue}"))
    one = lambda i, catalogue: F.try_element_at(f"payload.entities.{catalogue}", F.col(f"r.{i}"))["name"]
    r = _kept(r, F.col("r.title"), F.col("r.start"), F.col("r.end")).withColumn("audiences", F.coalesce(e("audienceIds", "eventAudiences"), F.array().cast("array<string>")))
    if prefilter:
        r = r.filter(taxonomy.is_youth_audience("audiences"))
    room = F.coalesce(one("nonBranchLocationId", "locations"), F.col("r.locationDetails"))
    return as_events(
        r, 1.0, seq=_seq(), source_id="source_id", external_id=F.col("id"), title=F.trim("r.title"), description=strip_html("r.description"), start=parse_iso("r.start"), end=parse_iso("r.end"),
        all_day=present("r.start") & ~F.contains("r.start", F.lit("T")), location=F.concat_ws(", ", filled(one("branchLocationId", "locations")), filled(room)),
        image_url=F.try_element_at("payload.entities.images", F.col("r.featuredImageId"))["url"], categories=e("typeIds", "eventTypes"),
        tags=F.array_compact(F.array(one("programId", "eventPrograms"))), age_grade_level="audiences",
    )


def _posting(r: DataFrame, verdict: Column) -> DataFrame:
    return r.withColumn("verdict", verdict).filter("verdict is not null")


def greenhouse(pages: DataFrame, words: Column | None = None) -> DataFrame:
    """[A20]"""
    r = _kept(_records(pages, GREENHOUSE, "payload.jobs"), F.col("r.title"))
    department = F.array_join(names_of("r.departments"), " ")
    r = _posting(r, taxonomy.classify_posting("r.title", F.lit(""), department, "r.location.name", words))
    return as_events(
        r, 1.0, seq=_seq(), kind=F.lit("internship"), source_id="source_id", external_id=F.col("r.id").cast("string"), url=F.col("r.absolute_url"), title=F.trim("r.title"), description=strip_html("r.content"),
        start=parse_iso("r.updated_at"), location=F.col("r.location.name"), registration_url=F.col("r.absolute_url"), age_grade_level=F.col("verdict.age_grade_level"), time_of_day=F.col("verdict.time_of_day"),
    )


def lever(pages: DataFrame, words: Column | None = None) -> DataFrame:
    """[A21] Times are milliseconds since 1970, in UTC."""
    r = _kept(_records(pages, LEVER, "payload"), F.col("r.text"))
    department = F.concat_ws(" ", "r.categories.team", "r.categories.department")
    r = _posting(r, taxonomy.classify_posting("r.text", "r.categories.commitment", department, "r.categories.location", words))
    posted = F.expr("timestamp_ntz '1970-01-01' + make_dt_interval(0, 0, 0, r.createdAt / 1000)")
    return as_events(
        r, 1.0, seq=_seq(), kind=F.lit("internship"), source_id="source_id", external_id=F.col("r.id"), url=F.col("r.hostedUrl"), title=F.trim("r.text"),
        description=F.coalesce(filled("r.descriptionPlain"), strip_html("r.description")), start=posted, location=F.col("r.categories.location"),
        registration_url=F.coalesce(filled("r.applyUrl"), F.col("r.hostedUrl")), age_grade_level=F.col("verdict.age_grade_level"), time_of_day=F.col("verdict.time_of_day"),
    )


def class_rows(pages: DataFrame) -> DataFrame:
    """[A22] Rows of the class query, as the remote database returns them. Trusted: never gated. Sign-ups go to the address that the
    source's config gives for all of them."""
    r = _kept(_records(pages, CLASSES, "payload"), F.col("r.name"), F.col("r.start_at"), F.col("r.end_at"))
    return as_events(
        r, 1.0, seq=_seq(), source_id="source_id", trusted=F.lit(True), external_id=F.col("r.service_id").cast("string"), title=F.trim("r.name"), description=strip_html(F.coalesce(filled(F.trim("r.description")), F.col("r.description_short"), F.lit(""))),
        start=parse_iso("r.start_at"), end=parse_iso("r.end_at"), location=join_parts("r.location_name", "r.city"), latitude=F.col("r.latitude"), longitude=F.col("r.longitude"),
        categories=F.array_compact(F.array(filled(F.trim("r.category_name")))), registration_url=F.col("config")["registration_url"] if "config" in pages.columns else None,
    )


def club_rows(pages: DataFrame) -> DataFrame:
    """[A22] Rows of the club query. Trusted too."""
    r = _kept(_records(pages, CLUBS, "payload"), F.col("r.title"), F.col("r.date_time"))
    return as_events(
        r, 1.0, seq=_seq(), source_id="source_id", trusted=F.lit(True), external_id=F.col("r.id"), title=F.trim("r.title"), description=F.trim("r.description"), start=parse_iso("r.date_time"),
        location=join_parts("r.venue_name", "r.city"), latitude=F.col("r.lat"), longitude=F.col("r.lon"), registration_url=F.trim("r.event_url"), image_url=F.trim("r.featured_photo_url"),
    )


#: Words in the name or category of classes that are for staff.
STAFF = ("Teacher", "Staff", "Professional Development")


def remote_queries() -> tuple[str, str]:
    """[A22] The class and the club query in the remote database's dialect: what next_occurrences and active_clubs say on tables."""
    public = " AND ".join(f"s.name NOT LIKE '%{w}%' AND coalesce(s.category_name, '') NOT LIKE '%{w}%'" for w in STAFF)
    coming = "SELECT *, row_number() OVER (PARTITION BY service_id ORDER BY start_at, id) AS place FROM event_occurrences WHERE state = 'active' AND deleted_at IS NULL AND start_at >= datetime('now')"
    classes = (
        "SELECT s.id AS service_id, s.name, s.description, s.description_short, s.category_name, s.service_type, o.id AS occurrence_id, o.start_at, o.end_at, "
        "l.id AS location_id, l.name AS location_name, l.city, l.latitude, l.longitude, l.formatted_address, l.timezone "
        f"FROM services s JOIN ({coming}) o ON o.service_id = s.id AND o.place = 1 LEFT JOIN locations l ON l.id = o.location_id "
        f"WHERE s.visitors_can_view = 1 AND s.deleted_at IS NULL AND s.service_type IN ('Course', 'GroupClass') AND {public} ORDER BY o.start_at"
    )
    clubs = (
        "SELECT m.id, m.title, m.description, m.date_time, m.event_url, m.featured_photo_url, m.venue_id, v.name AS venue_name, v.address, v.city, v.state, v.lat, v.lon "
        "FROM meetup_events m LEFT JOIN meetup_venues v ON v.id = m.venue_id WHERE m.status = 'ACTIVE' AND m.deleted_at IS NULL AND m.date_time >= datetime('now') ORDER BY m.date_time"
    )
    return classes, clubs


def remote_refs(sources: DataFrame, base: str = "", key: str = "") -> DataFrame:
    """[A22] (source_id, page_seq, url, headers): page 0 is the class query, page 1 the club query; a source's api_base goes before
    `base`. The key is sent as a bearer token and is part of no table that is written."""
    url = F.concat(F.rtrim(F.coalesce(filled(F.col("config")["api_base"]), F.lit(base)), F.lit("/")), F.lit("/query?sql="))
    pages = F.posexplode(F.array(*[url_encode(F.lit(q)) for q in remote_queries()])).alias("page_seq", "sql")
    return sources.filter("adapter_type = 'remote_sql'").select("source_id", url.alias("at"), pages).select(
        "source_id", F.col("page_seq").cast("long").alias("page_seq"), F.concat("at", "sql").alias("url"), F.create_map(F.lit("Authorization"), F.lit(f"Bearer {key}")).alias("headers")
    )


def remote_sql(pages: DataFrame) -> DataFrame:
    """[A22] Classes and clubs of landed answers to remote_refs; a column `config` may tell where classes are signed up for."""
    return class_rows(pages.filter("page_seq = 0")).unionByName(club_rows(pages.filter("page_seq = 1")))


def next_occurrences(services: DataFrame, occurrences: DataFrame, locations: DataFrame, now: Column) -> DataFrame:
    """[W1, J5] The class query on tables at hand: each visible class with its next active occurrence, and where it is, if known."""
    w = Window.partitionBy("service_id").orderBy("start_at", "id")
    coming = occurrences.filter("deleted_at is null and state = 'active'").filter(F.col("start_at") >= now).withColumn("rn", F.row_number().over(w)).filter("rn = 1")
    coming = coming.select("service_id", F.col("id").alias("occurrence_id"), "start_at", "end_at", "location_id")
    s = services.filter("service_type in ('Course', 'GroupClass') and visitors_can_view = 1 and deleted_at is null")
    for word in STAFF:
        s = s.filter(~F.contains("name", F.lit(word)) & ~F.contains(F.coalesce("category_name", F.lit("")), F.lit(word)))
    s = s.select(F.col("id").alias("service_id"), "name", "description", "description_short", "category_name", "service_type")
    places = locations.select(F.col("id").alias("location_id"), F.col("name").alias("location_name"), "city", "latitude", "longitude", "formatted_address", "timezone")
    return s.join(coming, "service_id").join(places, "location_id", "left")


def active_clubs(meetups: DataFrame, venues: DataFrame, now: Column) -> DataFrame:
    """[J6]"""
    m = meetups.filter("deleted_at is null and status = 'ACTIVE'").filter(F.col("date_time") >= now)
    v = venues.select(F.col("id").alias("venue_id"), F.col("name").alias("venue_name"), "address", "city", "state", "lat", "lon")
    return m.join(v, "venue_id", "left")


#: [A7] Adapters by type; register further ones here (V1).
ADAPTERS: dict[str, Callable[[DataFrame], DataFrame]] = {"tec_rest": tec, "wordpress_rest": wordpress, "localist": localist, "bibliocommons": bibliocommons, "greenhouse": greenhouse, "lever": lever, "remote_sql": remote_sql}
#: Adapters that read a column `config` of their pages: the source's own settings.
CONFIGURED = ("remote_sql",)
