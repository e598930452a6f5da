"""Registered queries of feeds, pages and registries: bodies are put together from the supplied tables, whole, and read back by the
adapters; the SQL says what must come out straight from the tables."""

from __future__ import annotations

import json
import tempfile
from datetime import datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, identity, taxonomy, text
from ..operators import enrich, export, legacy, normalize, serve, state
from ..schema import as_events
from ..sources import calendars, discovery, feeds, fetch, html, images, registry
from .catalogue import _HOST, TODAY, _landed, query, records, table


def pages_of(rows: DataFrame, source: Column, page: Column, record: Column, order: str, shell: str) -> DataFrame:
    """Landed pages whose bodies hold the records of each source and page in order; every fifth page was not found."""
    keyed = rows.select(source.alias("source_id"), page.cast("long").alias("page_seq"), F.struct(F.col(order).alias("o"), F.to_json(record).alias("r")).alias("x"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["r"]), ",")
    out = keyed.groupBy("source_id", "page_seq").agg(F.format_string(shell, listed).alias("body"))
    return out.select("source_id", "page_seq", F.concat(F.lit("https://"), "source_id").alias("url"), F.when(F.col("page_seq") % 5 == 4, 404).otherwise(200).alias("status"), "body")


_GOOD = "(event_id // 50) % 5 <> 4"


def _user() -> Column:
    return F.concat(F.lit("u"), "user_id")


def _page() -> Column:
    return F.floor(F.col("event_id") / 50)


def _every(n: int, value: str, other: Column) -> Column:
    return F.when(F.col("event_id") % n == 0, value).otherwise(other)


@query(f"""SELECT 'u' || user_id AS source_id, event_id::VARCHAR AS external_id, event_type || ' & more' AS title, 'n. ' || user_id AS description, ts AS start,
  CASE WHEN event_id % 3 = 0 THEN 'Hall, Town' ELSE 'Hall, Street 1, Town, CA' END AS location, 'a|b' AS tags FROM events WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 AND {_GOOD}""")
def q_feed_events(spark, d):
    """Titles with markup, blank titles, unreadable dates, pages not found."""
    e = table(spark, d, "events")
    tags = F.array(*[F.struct(F.lit(t).alias("name")) for t in ("a", "", " b ")])
    venue = F.struct(F.lit("Hall").alias("venue"), F.when(F.col("event_id") % 3 == 0, " ").otherwise("Street 1").alias("address"), F.lit("Town").alias("city"), F.when(F.col("event_id") % 3 != 0, "CA").alias("state"))
    r = F.struct(
        F.col("event_id").alias("id"), _every(11, " ", F.concat(F.lit("<b>"), "event_type", F.lit("</b> &amp;  more"))).alias("title"), F.lit("").alias("description"),
        F.concat(F.lit("<p>n.\n"), F.col("user_id").cast("string"), F.lit("</p>")).alias("excerpt"), _every(13, "soon", F.col("ts").cast("string")).alias("start_date"), F.lit("").alias("end_date"),
        venue.alias("venue"), tags.alias("tags"),
    )
    got = feeds.tec(pages_of(e, _user(), _page(), r, "event_id", '{"total":1,"events":[%s]}'))
    return got.select("source_id", "external_id", "title", "description", "start", "location", F.array_join("tags", "|").alias("tags"))


@query(f"""SELECT event_id::VARCHAR AS external_id, 'Post ' || event_id || '''s' AS title, CASE WHEN event_id % 2 = 0 THEN 'whole ' || user_id ELSE 'short ' || user_id END AS description
FROM events WHERE event_id % 7 <> 0 AND {_GOOD}""")
def q_feed_posts(spark, d):
    """An empty excerpt falls back to the content."""
    said = lambda c: F.struct(c.alias("rendered"))
    user = F.col("user_id").cast("string")
    r = F.struct(
        F.col("event_id").alias("id"), said(_every(7, "", F.concat(F.lit("Post "), F.col("event_id").cast("string"), F.lit("&#8217;s")))).alias("title"),
        said(F.when(F.col("event_id") % 2 == 0, "<p> </p>").otherwise(F.concat(F.lit("<p>short  "), user, F.lit("</p>")))).alias("excerpt"), said(F.concat(F.lit("<div>whole "), user, F.lit("</div>"))).alias("content"),
    )
    return feeds.wordpress(pages_of(table(spark, d, "events"), _user(), _page(), r, "event_id", "[%s]")).select("external_id", "title", "description")


@query(f"""WITH k AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_id // 50, event_id // 3 ORDER BY event_id) AS n FROM events WHERE event_id % 11 <> 0 AND {_GOOD})
SELECT 'u' || user_id AS source_id, (event_id // 3)::VARCHAR AS external_id, event_type AS title, ts AS start, 'http://x/' || event_id AS url, 'k' || user_id || '|t' AS tags FROM k WHERE n = 1""")
def q_feed_days(spark, d):
    """An id counts once a page, by the first record that can be read."""
    r = F.struct(F.struct(
        F.floor(F.col("event_id") / 3).alias("id"), _every(11, " ", F.concat("event_type", F.lit(" "))).alias("title"), F.col("ts").cast("string").alias("first_date"),
        F.concat(F.lit("http://x/"), F.col("event_id").cast("string"), F.lit(" ")).alias("url"), F.array(F.concat(F.lit("k"), F.col("user_id").cast("string"))).alias("tags"), F.array(F.lit("t"), F.lit("t")).alias("keywords"),
    ).alias("event"))
    got = feeds.localist(pages_of(table(spark, d, "events"), _user(), _page(), r, "event_id", '{"events":[%s]}'))
    return got.select("source_id", "external_id", "title", "start", "url", F.array_join("tags", "|").alias("tags"))


@query(f"""SELECT DISTINCT 'e' || event_id AS external_id, event_type AS title, event_id % 2 = 0 AS all_day, CASE WHEN event_id % 2 = 0 THEN date_trunc('day', ts) ELSE ts END AS start,
  CASE event_id % 3 WHEN 0 THEN 'Main' WHEN 1 THEN 'Main, Attic' ELSE 'Room 2' END AS location, CASE event_id % 4 WHEN 1 THEN 'Kids and Families' WHEN 3 THEN 'Adults|Kids and Families' ELSE '' END AS audiences
FROM events WHERE event_id % 11 <> 0 AND event_id % 4 <> 2 AND {_GOOD}""")
def q_feed_branches(spark, d):
    """Names by id, unknown ids left out; a day alone is all day; audiences that are known must be young."""
    e = table(spark, d, "events").withColumn("i", F.concat(F.lit("e"), F.col("event_id").cast("string")))
    k = F.col("event_id")
    ids = F.when(k % 4 == 0, F.array(F.lit("9"))).when(k % 4 == 1, F.array(F.lit("1"), F.lit("9"))).when(k % 4 == 2, F.array(F.lit("2"))).otherwise(F.array(F.lit("2"), F.lit("1")))
    definition = F.struct(
        _every(11, "", F.col("event_type")).alias("title"), F.when(k % 2 == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("start"),
        F.when(k % 3 != 2, "L").alias("branchLocationId"), F.when(k % 3 == 1, "A").alias("nonBranchLocationId"), F.when(k % 3 == 2, "Room 2").alias("locationDetails"), ids.alias("audienceIds"),
    )
    rows = e.select("event_id", "user_id", F.col("i"), F.to_json(F.struct(definition.alias("definition"))).alias("j"))
    by = rows.groupBy(_user().alias("source_id"), _page().alias("page_seq")).agg(F.array_sort(F.collect_list(F.struct("event_id", "i", "j"))).alias("x"))
    items = F.array_join(F.transform(F.concat("x", "x"), lambda x: F.concat(F.lit('"'), x["i"], F.lit('"'))), ",")
    entities = F.array_join(F.transform("x", lambda x: F.concat(F.lit('"'), x["i"], F.lit('":'), x["j"])), ",")
    shell = '{"events":{"items":["unknown",%s]},"entities":{"events":{%s},"locations":{"L":{"name":"Main"},"A":{"name":"Attic"}},"eventAudiences":{"1":{"name":"Kids and Families"},"2":{"name":"Adults"}}}}'
    landed = by.select("source_id", "page_seq", F.lit("").alias("url"), F.when(F.col("page_seq") % 5 == 4, 404).otherwise(200).alias("status"), F.format_string(shell, items, entities).alias("body"))
    return feeds.bibliocommons(landed).select("external_id", "title", "all_day", "start", "location", F.array_join("age_grade_level", "|").alias("audiences"))


_JOB = "CASE event_id % 5 WHEN 0 THEN 'Data Science Intern' WHEN 1 THEN 'Senior Data Scientist' WHEN 2 THEN 'Marketing Intern' WHEN 3 THEN 'Software Engineering Intern, PhD' ELSE 'Lab Lead' END"
_POSTED = f"""SELECT event_id::VARCHAR AS external_id, {_JOB} AS title, 'internship' AS kind, 'Grades 9-12|Undergraduate' || CASE WHEN event_id % 5 = 3 THEN '|Graduate' ELSE '' END AS ages, 'All Day' AS times, ts AS start
FROM events WHERE event_id % 3 = 0 AND {_GOOD} AND event_id % 5 IN """


def _job() -> tuple[Column, Column]:
    return F.expr(_JOB).alias("title"), F.when(F.col("event_id") % 3 == 0, "SAN DIEGO, CA").otherwise("Remote").alias("name")


@query(f"{_POSTED} (0, 3)")
def q_feed_board(spark, d):
    """Internships in STEM nearby."""
    title, place = _job()
    r = F.struct(F.col("event_id").alias("id"), title, F.col("ts").cast("string").alias("updated_at"), F.struct(place).alias("location"), F.array(F.struct(F.lit("").alias("name"))).alias("departments"))
    got = feeds.greenhouse(pages_of(table(spark, d, "events"), _user(), _page(), r, "event_id", '{"jobs":[%s]}'))
    return got.select("external_id", "title", "kind", F.array_join("age_grade_level", "|").alias("ages"), F.array_join("time_of_day", "|").alias("times"), "start")


@query(f"{_POSTED} (0, 1, 3)".replace("ts AS start", "date_trunc('second', ts) AS start"))
def q_feed_postings(spark, d):
    """The commitment alone may say that it is an internship; times are milliseconds since 1970."""
    title, place = _job()
    milli = (F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("long") * 1000
    kinds = F.struct(place.alias("location"), F.when(F.col("event_id") % 5 == 1, "Internship").alias("commitment"), F.lit("").alias("team"))
    r = F.struct(F.col("event_id").cast("string").alias("id"), title.alias("text"), kinds.alias("categories"), milli.alias("createdAt"))
    got = feeds.lever(pages_of(table(spark, d, "events"), _user(), _page(), r, "event_id", "[%s]"))
    return got.select("external_id", "title", "kind", F.array_join("age_grade_level", "|").alias("ages"), F.array_join("time_of_day", "|").alias("times"), "start")


@query(f"""SELECT event_id::VARCHAR AS external_id, event_type AS title, CASE WHEN event_id % 2 = 0 THEN 'Long ' || event_id ELSE 'brief' END AS description, true AS trusted, ts AS start,
  'Lab, Town' AS location, 'https://sign.up' AS registration_url, 'c' AS categories, 32.5::DOUBLE AS latitude FROM events WHERE event_id % 11 <> 0 AND {_GOOD}""")
def q_feed_classes(spark, d):
    """Rows of the class query. A description falls back to the brief one; a place is its name and city."""
    k = F.col("event_id")
    r = F.struct(
        k.alias("service_id"), (k + 1).alias("occurrence_id"), _every(11, "", F.col("event_type")).alias("name"), F.when(k % 2 == 0, F.concat(F.lit("<i>Long</i> "), k.cast("string"))).alias("description"), F.lit("brief").alias("description_short"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("start_at"), F.when(k % 3 == 0, "Main Street 1").otherwise("").alias("formatted_address"), F.lit("Lab").alias("location_name"), F.lit("Town").alias("city"),
        F.lit("c").alias("category_name"), F.lit(32.5).alias("latitude"),
    )
    landed = pages_of(table(spark, d, "events"), _user(), _page(), r, "event_id", "[%s]").withColumn("config", F.create_map(F.lit("registration_url"), F.lit("https://sign.up")))
    got = feeds.class_rows(landed)
    return got.select("external_id", "title", "description", "trusted", "start", "location", "registration_url", F.array_join("categories", "|").alias("categories"), "latitude")


@query(f"""SELECT event_id::VARCHAR AS external_id, event_type AS title, ts AS start, CASE WHEN event_id % 3 = 0 THEN 'Pub, Town' ELSE '' END AS location, '' AS cost, 'https://m/' || event_id AS registration_url
FROM events WHERE event_id % 11 <> 0 AND {_GOOD}""")
def q_feed_clubs(spark, d):
    """Rows of the club query; a club without a known venue has no place."""
    k = F.col("event_id")
    r = F.struct(k.cast("string").alias("id"), _every(11, "", F.col("event_type")).alias("title"), F.col("ts").cast("string").alias("date_time"), F.concat(F.lit("https://m/"), k.cast("string")).alias("event_url"), F.when(k % 3 == 0, "Pub").alias("venue_name"), F.lit("Road 2").alias("address"), F.when(k % 3 == 0, "Town").alias("city"))
    got = feeds.club_rows(pages_of(table(spark, d, "events"), _user(), _page(), r, "event_id", "[%s]"))
    return got.select("external_id", "title", "start", "location", "cost", "registration_url")


_FIRST = "TIMESTAMP '2024-01-01 09:30:00' + (c_custkey % 300)::INTEGER * INTERVAL 1 DAY"


@query(f"""WITH c AS (SELECT c_custkey, c_name, {_FIRST} AS s, CASE c_custkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 52 ELSE 13 END AS n, CASE c_custkey % 4 WHEN 1 THEN 7 WHEN 3 THEN 14 ELSE 1 END AS step FROM customer WHERE c_custkey % 9 <> 0),
o AS (SELECT *, unnest(range(0, n)) AS i FROM c)
SELECT 'c' || c_custkey || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '::' || strftime(CASE WHEN c_custkey % 4 = 2 THEN date_trunc('day', s) ELSE s END + (i * step)::INTEGER * INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') END AS external_id,
  c_name || ', and more' AS title, CASE WHEN c_custkey % 4 = 2 THEN date_trunc('day', s) ELSE s END + (i * step)::INTEGER * INTERVAL 1 DAY AS start, c_custkey % 4 = 2 AS all_day FROM o""")
def q_feed_calendar(spark, d):
    """Single events, three weeks, an endless daily one (52 at most) and an endless fortnightly one (180 days at most)."""
    first = F.timestamp_add("DAY", (F.col("c_custkey") % 300).cast("int"), F.lit(datetime(2024, 1, 1, 9, 30)).cast("timestamp_ntz"))
    k = F.col("c_custkey") % 4
    start = F.when(k == 2, F.concat(F.lit(";VALUE=DATE:"), F.date_format(first, "yyyyMMdd"))).otherwise(F.concat(F.lit(":"), F.date_format(first, "yyyyMMdd'T'HHmmss"), F.lit("Z")))
    rule = F.when(k == 0, "").when(k == 1, "RRULE:FREQ=WEEKLY;COUNT=3\r\n").when(k == 2, "RRULE:FREQ=DAILY\r\n").otherwise("RRULE:FREQ=WEEKLY;INTERVAL=2\r\n")
    title = F.when(F.col("c_custkey") % 9 == 0, "").otherwise(F.concat("c_name", F.lit("\\, and\r\n  more")))
    body = F.concat(F.lit("BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nUID:c"), F.col("c_custkey").cast("string"), F.lit("\r\nDTSTART"), start, F.lit("\r\n"), rule, F.lit("SUMMARY:"), title, F.lit("\r\nEND:VEVENT\r\nEND:VCALENDAR\r\n"))
    landed = table(spark, d, "customer").select(F.lit("c").alias("source_id"), F.col("c_custkey").alias("page_seq"), F.lit("").alias("url"), F.lit(200).alias("status"), body.alias("body"))
    return calendars.ical(landed).select("external_id", "title", "start", "all_day")


_RUNG = """CASE doc_id % 7 WHEN 0 THEN 'Linked ' || doc_id WHEN 1 THEN 'Meta ' || doc_id WHEN 2 THEN 'Heading ' || doc_id WHEN 3 THEN 'Title ' || doc_id WHEN 4 THEN 'Heading ' || doc_id WHEN 5 THEN 'Graph ' || doc_id END"""


@query(f"""SELECT doc_id, {_RUNG} AS title, CASE doc_id % 7 WHEN 0 THEN TIMESTAMP '2024-03-05 10:00:00' WHEN 1 THEN TIMESTAMP '2024-04-06 00:00:00' WHEN 2 THEN TIMESTAMP '2024-05-07 00:00:00' WHEN 3 THEN TIMESTAMP '2024-06-08 00:00:00' WHEN 5 THEN TIMESTAMP '2024-07-09 18:30:00' END AS start,
  CASE doc_id % 7 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.6 WHEN 5 THEN 1.0 ELSE 0.5 END AS title_confidence, CASE doc_id % 7 WHEN 0 THEN 'Hall, Road 1, Town' ELSE '' END AS location, CASE doc_id % 7 WHEN 0 THEN '12' ELSE '' END AS cost
FROM documents WHERE doc_id % 7 <> 6""")
def q_ladder_rungs(spark, d):
    """Each rung, with lower ones filling what it lacks; a page without any title gives no row."""
    n, k = F.col("doc_id").cast("string"), F.col("doc_id") % 7
    event = '{"@type":"Event","name":"Linked %s","startDate":"2024-03-05T10:00:00-07:00","location":{"name":"Hall","address":{"streetAddress":"Road 1","addressLocality":"Town"}},"offers":[{"price":12}]}'
    linked = F.format_string(f"<html><h1>Other</h1><script type='application/ld+json'>not json</script><script type=\"application/ld+json\">{event}</script>", n)
    graph = F.format_string('<script type="application/ld+json">{"@graph":[{"@type":"Place"},{"@type":"Event","name":"Graph %s","startDate":"2024-07-09T18:30:00"}]}</script><h1>No</h1>', n)
    body = (
        F.when(k == 0, linked).when(k == 1, F.format_string('<meta property="og:title" content="Meta %s"><h1>No</h1><time datetime="2024-04-06">x</time><time datetime="soon">', n))
        .when(k == 2, F.format_string("<title>No</title><h1> </h1><h1>Heading <b>%s</b></h1>", n)).when(k == 3, F.format_string("<title>Title %s</title><p>Come on Saturday, June 8th, 2024 <script>June 1, 2023</script>", n))
        .when(k == 4, F.format_string("<h1>Heading %s</h1><!-- June 1, 2023 --><p>any day", n)).when(k == 5, graph).otherwise("<p>nothing here")
    )
    landed = table(spark, d, "documents").select(F.lit("s").alias("source_id"), F.col("doc_id").alias("page_seq"), F.concat(F.lit("https://s.org/"), n, F.when(k == 2, "/2024-05-07/").otherwise("/")).alias("url"), F.lit(200).alias("status"), body.alias("body"))
    e = html.ladder(landed)
    return e.select((F.col("seq") / 1_000_000).cast("long").alias("doc_id"), "title", "start", F.element_at("field_provenance", "title")["confidence"].alias("title_confidence"), "location", "cost")


def _linked(spark, d, source: Column, url: Column, link: Column) -> DataFrame:
    """Pages with links to the supplied pages, in order."""
    p = table(spark, d, "pages").select(source.alias("source_id"), url.alias("url"), F.struct("page_id", link.alias("a")).alias("x"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["a"]), "\n")
    return p.groupBy("source_id", "url").agg(body.alias("body")).select("source_id", F.lit(0).cast("long").alias("page_seq"), "url", F.lit(200).alias("status"), "body")


@query(f"SELECT {_HOST} AS source_id, 'https://' || {_HOST} || '/' || CASE WHEN page_id % 2 = 0 THEN 'events/' ELSE 'a/camps/' END || page_id AS link FROM pages WHERE page_id % 3 <> 0")
def q_listing_events(spark, d):
    """Links resolved on the page's address, event paths only, each once."""
    n = F.col("page_id").cast("string")
    href = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("/about/"), n)).when(F.col("page_id") % 2 == 0, F.concat(F.lit("/events/"), n)).otherwise(F.concat(F.lit("camps/"), n))
    a = F.concat(F.lit("<li><a href='"), href, F.lit("'>E</a> <a href='"), href, F.lit("'>again</a></li>"))
    host = text.domain_of("url")
    return discovery.listing_links(_linked(spark, d, host, F.concat(F.lit("https://"), host, F.lit("/a/list")), a)).select("source_id", "link")


@query(f"""WITH p AS (SELECT page_id, url, {_HOST} AS host FROM pages)
SELECT 'org-' || page_id AS slug, 'Org ' || page_id AS org_name, 'https://' || host || '/p' || page_id AS url, 'hub' || page_id % 20 AS hub_id,
  'org_name = "Org ' || page_id || '"' || chr(10) || 'url = "https://' || host || '/p' || page_id || '"' || chr(10) || 'hub_name = "hub' || page_id % 20 || '"' || chr(10) AS text
FROM p WHERE page_id % 3 <> 0 AND host NOT IN (SELECT host FROM p WHERE page_id % 50 = 0)""")
def q_hub_stubs(spark, d):
    """New organisations of hub pages, less those known by domain or name."""
    n, host = F.col("page_id").cast("string"), text.domain_of("url")
    a = F.concat(F.lit("<p><a href='https://"), host, F.lit("/p"), n, F.lit("'>Org "), n, F.lit("</a> <a href='/own'>own page</a> <a href='mailto:x@y.z'>mail</a></p>"))
    hub = F.concat(F.lit("hub"), (F.col("page_id") % 20).cast("string"))
    found = discovery.hub_candidates(_linked(spark, d, hub, F.concat(F.lit("https://www."), hub, F.lit(".org/links")), a))
    p = table(spark, d, "pages")
    known = p.filter("page_id % 50 = 0").select(F.lit("x").alias("org_name"), F.col("url").alias("site_url")).unionByName(p.filter("page_id % 3 = 0").select(F.concat(F.lit("The ORG "), n).alias("org_name"), F.lit(None).cast("string").alias("site_url")))
    return export.candidate_stubs(discovery.new_candidates(found, known))


@query(f"""SELECT {_HOST} AS source_id, 'https://' || {_HOST} || '/x?a=1&b=' || page_id AS url, CASE WHEN page_id % 2 = 0 THEN '2024-01-0' || (1 + page_id % 9) ELSE '' END AS lastmod FROM pages
UNION ALL SELECT {_HOST}, 'https://' || {_HOST} || '/twice', arg_max((page_id % 7)::VARCHAR, page_id) FROM pages GROUP BY 1""")
def q_sitemap_read(spark, d):
    """Addresses of a sitemap; a later entry of an address replaces an earlier one."""
    n, host = F.col("page_id").cast("string"), text.domain_of("url")
    item = lambda loc, last: F.concat(F.lit("<url><loc> https://"), host, loc, F.lit("</loc>"), last, F.lit("</url>"))
    last = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<lastmod>2024-01-0"), (1 + F.col("page_id") % 9).cast("string"), F.lit("</lastmod>"))).otherwise("")
    a = F.concat(item(F.concat(F.lit("/x?a=1&amp;b="), n), last), item(F.lit("/twice"), F.concat(F.lit("<lastmod>"), (F.col("page_id") % 7).cast("string"), F.lit("</lastmod>"))))
    maps = _linked(spark, d, host, F.lit("u"), a)
    good = maps.withColumn("body", F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), "body", F.lit("</urlset>"))).withColumn("page_seq", F.lit(1).cast("long"))
    bad = maps.withColumn("body", F.lit("<html><body>not found")).unionByName(maps.withColumn("body", F.lit("<html><loc>x</loc></html>")))
    return discovery.sitemap_urls(discovery.first_sitemap(discovery.sitemap_entries(bad.unionByName(good))), False)


@query(f"""WITH s AS (SELECT {_HOST} AS source_id, CASE page_id % 4 WHEN 0 THEN 'events-sitemap.xml' WHEN 1 THEN 'post-sitemap.xml' WHEN 2 THEN 'course-list.xml' ELSE 'page-sitemap.xml' END AS f, page_id FROM pages),
k AS (SELECT *, page_id % 4 IN (0, 2) AS named, bool_or(page_id % 4 IN (0, 2)) OVER (PARTITION BY source_id) AS any_named FROM s)
SELECT source_id, 'https://' || source_id || '/' || page_id || '/' || f AS loc, NOT any_named AS path_filter FROM k WHERE named OR NOT any_named""")
def q_sitemap_children(spark, d):
    """Children named for events or programs, whole; without any, all of them, filtered by path."""
    n, host = F.col("page_id").cast("string"), text.domain_of("url")
    f = F.expr("CASE page_id % 4 WHEN 0 THEN 'events-sitemap.xml' WHEN 1 THEN 'post-sitemap.xml' WHEN 2 THEN 'course-list.xml' ELSE 'page-sitemap.xml' END")
    a = F.concat(F.lit("<sitemap><loc>https://"), host, F.lit("/"), n, F.lit("/"), f, F.lit("</loc></sitemap>"))
    maps = _linked(spark, d, host, F.lit("u"), a).withColumn("body", F.concat(F.lit("<sitemapindex>"), "body", F.lit("</sitemapindex>")))
    return discovery.child_sitemaps(discovery.sitemap_entries(maps)).select("source_id", "loc", "path_filter")


@query(f"SELECT DISTINCT {_HOST} AS source_id, 'https://www.' || regexp_replace({_HOST}, '^www\\.', '') || '/s' || page_id || '.xml' AS loc FROM pages WHERE page_id % 2 = 0")
def q_robots_sitemaps(spark, d):
    """Sitemap lines of the same domain, with or without www."""
    n, host = F.col("page_id").cast("string"), text.domain_of("url")
    a = F.concat(F.lit("User-agent: *\nDisallow: /x\n SiteMap: https://"), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("www."), F.regexp_replace(host, r"^www\.", ""))).otherwise("elsewhere.net"), F.lit("/s"), n, F.lit(".xml\r"))
    return discovery.robots_sitemaps(_linked(spark, d, host, F.concat(F.lit("https://"), host, F.lit("/robots.txt")), a))


@query(f"SELECT 'https://' || {_HOST} || '/n' || page_id AS url FROM pages WHERE page_id % 5 NOT IN (0, 1)")
def q_crawl_frontier(spark, d):
    """Pages of the site that weren't visited; files aren't pages."""
    n, host = F.col("page_id").cast("string"), text.domain_of("url")
    p = table(spark, d, "pages").withColumn("host", host)
    link = lambda end: F.concat(F.lit("https://"), "host", F.lit("/n"), n, F.lit(end)).alias("url")
    links = p.select("page_id", "host", link(""))
    visited = links.filter("page_id % 5 = 0").select("url")
    # Every fifth address is a picture's; the domain of the crawl is each page's own here.
    found = links.withColumn("url", F.when(F.col("page_id") % 5 == 1, F.concat("url", F.lit("/a.PNG"))).otherwise(F.col("url")))
    return found.filter(discovery.same_domain("url", F.col("host")) & discovery.is_page("url")).select("url").distinct().join(visited, "url", "left_anti")


@query("""WITH u AS (SELECT source AS domain, (doc_id // 3)::VARCHAR AS url, 1 + doc_id % 3 AS phase, doc_id AS place, CASE WHEN source IN ('src1', 'src2') THEN '3' ELSE '1A' END AS tier FROM documents),
k AS (SELECT *, count(*) FILTER (phase = 1) OVER (PARTITION BY domain) AS n1, count(*) FILTER (phase <= 2) OVER (PARTITION BY domain) AS n2 FROM u),
c AS (SELECT *, row_number() OVER (PARTITION BY domain, url ORDER BY phase, place) AS n FROM k WHERE phase = 1 OR (phase = 2 AND (n1 = 0 OR tier = '2')) OR (phase = 3 AND (tier = '3' OR (n1 = 0 AND n2 = 0))))
SELECT domain, url, phase FROM c WHERE n = 1""")
def q_choose_pages(spark, d):
    """F13 J14"""
    u = table(spark, d, "documents").select(F.col("source").alias("domain"), F.floor(F.col("doc_id") / 3).cast("string").alias("url"), (1 + F.col("doc_id") % 3).alias("phase"), F.col("doc_id").alias("at"), F.when(F.col("source").isin("src1", "src2"), "3").otherwise("1A").alias("tier"))
    return discovery.choose_pages(u).select("domain", "url", "phase")


def _folder(files: dict[str, str]) -> str:
    """A folder of small files on the driver, where registries are read."""
    folder = tempfile.mkdtemp(prefix="fairlead-registry-")
    for name, body in files.items():
        (Path(folder) / name).write_text(body, encoding="utf-8")
    return folder


def _nations(spark, d) -> list[tuple[int, str]]:
    return [(r["n_nationkey"], r["n_name"]) for r in table(spark, d, "nation").collect()]


@query("""SELECT 'n' || lpad(n_nationkey::VARCHAR, 2, '0') AS source_id, n_name AS org_name, CASE WHEN n_nationkey % 2 = 0 THEN 'tec_rest' ELSE 'ical' END AS adapter_type,
  'https://' || n_nationkey AS site_url, CASE WHEN n_nationkey % 3 = 0 THEN '7' ELSE '300' END AS max_urls FROM nation WHERE n_nationkey % 5 <> 0 AND n_nationkey % 7 <> 3 AND n_nationkey % 4 <> 1""")
def q_registry(spark, d):
    """A1 A2 A3 F1: valid and enabled sources; broken files and files without a needed key are left out."""
    files = {}
    for k, name in _nations(spark, d):
        kind = "tec_rest" if k % 2 == 0 else "ical"
        body = f'org_name = "{name}"\n' + (f'adapter_type = "{kind}"\n' if k % 5 else "") + ("enabled = false\n" if k % 4 == 1 else "") + ("org_name\n" if k % 7 == 3 else "")
        files[f"n{k:02}.toml"] = body + f'[config]\nsite_url = "https://{k}"\n' + ("[acquisition_policy]\nmax_urls = 7\n" if k % 3 == 0 else "")
    files["readme.txt"] = "no source"
    s = registry.active_sources(registry.load_sources(spark, _folder(files)))
    return s.select("source_id", "org_name", "adapter_type", F.col("config")["site_url"].alias("site_url"), F.col("acquisition_policy")["max_urls"].alias("max_urls"))


@query("SELECT 'h' || n_nationkey AS hub_id, 'Hub ' || n_name AS hub_name, 'https://a/' || n_nationkey || '|https://b' AS page_urls, CASE WHEN n_nationkey % 2 = 0 THEN 'x' END AS note FROM nation WHERE n_nationkey % 3 <> 0")
def q_hub_registry(spark, d):
    """A4"""
    files = {f"h{k}.toml": (f'hub_name = "Hub {n}"\n' if k % 3 else "") + f'page_urls = ["https://a/{k}", "https://b"]\n' + ('[config]\nnote = "x"\n' if k % 2 == 0 else "") for k, n in _nations(spark, d)}
    h = registry.load_hubs(spark, _folder(files))
    return h.select("hub_id", "hub_name", F.array_join("page_urls", "|").alias("page_urls"), F.col("config")["note"].alias("note"))


@query("SELECT 'See ' || n_name AS headline, CASE WHEN n_nationkey % 2 = 0 THEN 'body' ELSE '' END AS body, 'https://' || n_nationkey AS link, '' AS logo_src FROM nation WHERE n_nationkey % 3 <> 0")
def q_ads(spark, d):
    """The registry of ads, through the published JSON array."""
    files = {f"a{k}.toml": f'headline = "See {n}"\n' + ('body = "body"\n' if k % 2 == 0 else "") + (f'link = "https://{k}"\n' if k % 3 else "") for k, n in _nations(spark, d)}
    ads = json.loads(export.export_ads(registry.load_ads(spark, _folder(files)), "", dry_run=True))
    return spark.createDataFrame([tuple(a[c] for c in ("headline", "body", "link", "logo_src")) for a in ads], registry.AD)


@query("SELECT 'c' || n_nationkey AS slug, n_name AS org_name, 'https://' || n_nationkey AS url, CASE WHEN n_nationkey % 2 = 0 THEN 'hub' ELSE '' END AS hub_name FROM nation WHERE n_nationkey % 4 <> 0")
def q_candidate_queue(spark, d):
    """A34"""
    files = {f"c{k}.toml": f'org_name = "{n}"\n' + (f'url = "https://{k}"\n' if k % 4 else "") + ('hub_name = "hub"\n' if k % 2 == 0 else "") for k, n in _nations(spark, d)}
    return registry.load_candidates(spark, _folder(files))


@query("""SELECT trim(regexp_replace(regexp_replace(lower(CASE WHEN c_custkey % 2 = 0 THEN 'The ' ELSE '' END || c_mktsegment || ' ' || c_nationkey), '[^a-z0-9 ]', '', 'g'), '^the ', '')) AS org_norm, min(c_custkey) AS id FROM customer GROUP BY 1""")
def q_first_partners(spark, d):
    """The first of equal normalised names counts."""
    name = F.concat(F.when(F.col("c_custkey") % 2 == 0, "The ").otherwise(""), "c_mktsegment", F.lit(" "), F.col("c_nationkey").cast("string"))
    return registry.first_partners(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("seq"), name.alias("name"))).select("org_norm", "id")


@query("SELECT event_id, coalesce(c_name, 'u' || user_id) AS org_name FROM events LEFT JOIN customer ON c_custkey = user_id AND c_custkey % 3 = 0")
def q_org_names(spark, d):
    """J2"""
    sources = table(spark, d, "customer").filter("c_custkey % 3 = 0").select(F.concat(F.lit("u"), "c_custkey").alias("source_id"), F.col("c_name").alias("org_name"))
    return normalize.with_org(records(spark, d), sources).select(F.col("seq").alias("event_id"), "org_name")


@query("""SELECT event_id, event_type || ' & ' || event_id AS title, coalesce(c_name, 'u' || user_id) AS partner_name, c_custkey AS partner_id, 'https://e/' || event_id AS link, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS second,
  CASE WHEN event_id % 4 = 0 THEN 'Rolling — apply anytime' ELSE '' END AS availability, CASE WHEN event_id % 4 = 0 THEN 'Work-based Learning' ELSE 'Out-of-school Programs' END AS opportunity_type, coalesce(c_mktsegment, '') AS location,
  CASE WHEN hour(ts) < 12 THEN 'Morning' WHEN hour(ts) < 17 THEN 'Afternoon' ELSE 'Evening' END AS time_of_day, 'u' || user_id AS sources, CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS part, 'No' AS financial_support
FROM events LEFT JOIN customer ON c_custkey = user_id""")
def q_opportunities(spark, d):
    """Events with titles of their own, so that none merge, mapped to what is published."""
    e = table(spark, d, "events")
    n = F.col("event_id").cast("string")
    events = as_events(
        e, 1.0, seq="event_id", kind=F.when(F.col("event_id") % 4 == 0, "internship").otherwise("event"), source_id=_user(), external_id=n, title=F.concat("event_type", F.lit(" &amp; "), n),
        url=F.concat(F.lit("https://e/"), n), start="ts",
    )
    c = table(spark, d, "customer")
    sources = c.select(F.concat(F.lit("u"), "c_custkey").alias("source_id"), F.col("c_name").alias("org_name"))
    partners = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("location"), F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"), F.lit("").alias("logo_src"), F.col("c_custkey").alias("seq"))
    o = normalize.to_opportunities(normalize.instances_of(events, TODAY), partners, sources)
    return o.select(
        F.col("seq").alias("event_id"), "title", "partner_name", "partner_id", "link", F.substring("date_start", 1, 19).alias("second"), "availability", "opportunity_type", "location",
        F.array_join("time_of_day", "|").alias("time_of_day"), F.array_join("sources", "|").alias("sources"), "part", "financial_support",
    )


def _client(event: dict) -> str:
    """A stand-in for a model: fails, says nonsense or answers, by the number in the description."""
    k = int(event["description"])
    if k % 5 == 0:
        raise TimeoutError
    reply = {"relevant": k % 5 != 2, "relevance_reason": f"r{k % 3}", "cost_range": f"C{k % 3}", "areas_of_interest": ["A"], "age_grade_level": [], "time_of_day": ["Morning", "Evening"], "location": "Here" if k % 2 else None} | dict.fromkeys(("start", "end", "all_day", "cost", "registration_url"))
    return "{" if k % 5 == 1 else json.dumps(reply | ({"cost_range": 5} if k % 5 == 3 else {}))


@query("""WITH e AS (SELECT event_id, event_type = 'signup' AS job, event_id % 7 = 0 AS trusted, event_id % 5 IN (2, 4) AS told, event_id % 6 = 0 AND event_type <> 'signup' AS cached FROM events)
SELECT event_id, CASE WHEN job THEN '' WHEN cached THEN 'K' WHEN told THEN 'C' || event_id % 3 ELSE 'Free' END AS cost_range, CASE WHEN NOT job AND NOT cached AND told AND event_id % 2 = 1 THEN 'Here' ELSE 'There' END AS location,
  CASE WHEN job THEN NULL WHEN cached THEN true WHEN told THEN event_id % 5 <> 2 ELSE true END AS relevant, CASE WHEN job OR cached OR NOT told THEN '' ELSE 'r' || event_id % 3 END AS relevance_reason,
  CASE WHEN job THEN NULL WHEN cached OR told THEN 0.7::DOUBLE ELSE 0.3::DOUBLE END AS confidence
FROM e WHERE trusted OR job OR cached OR NOT told OR event_id % 5 <> 2""")
def q_enrich(spark, d):
    """Cached, asked and failing replies; keyword rules for the rest; the gate, which trusted events pass."""
    e = table(spark, d, "events")
    n = F.col("event_id").cast("string")
    events = as_events(
        e, None, seq="event_id", kind=F.when(F.col("event_type") == "signup", "internship").otherwise("event"), source_id=F.lit("s"), external_id=n, title="event_type", description=n, cost=F.lit("Free"),
        location=F.lit("There"), start="ts", trusted=F.col("event_id") % 7 == 0,
    )
    reply = '{"relevant": true, "relevance_reason": "", "cost_range": "K", "areas_of_interest": [], "age_grade_level": [], "time_of_day": []}'
    cache = enrich.keyed(events.filter("seq % 6 = 0 and kind <> 'internship'")).select("identity", "content_hash", F.lit(reply).alias("reply"))
    got, _ = enrich.enrich(events, cache, _client)
    return got.select(F.col("seq").alias("event_id"), "cost_range", "location", "relevant", "relevance_reason", F.try_element_at("field_provenance", F.lit("cost_range"))["confidence"].alias("confidence"))


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_id % 4 <> 0)")
def q_gate_candidates(spark, d):
    """E7 J9"""
    c = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("identity"))
    passed = enrich.gate(table(spark, d, "events").select(F.col("user_id").cast("string").alias("identity"), F.lit(False).alias("trusted"), F.when(F.col("event_id") % 4 == 0, False).alias("relevant")))
    return enrich.gate_candidates(c, passed).select("c_custkey")


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN ts WHEN 1 THEN date_trunc('day', ts) WHEN 2 THEN ts END AS start, event_id % 4 = 3 AS bad,
  CASE WHEN event_id % 4 = 3 THEN '' WHEN event_id % 4 = 1 THEN strftime(ts, '%Y-%m-%dT00:00:00-07:00') WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S-07:00') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f-07:00') END AS shown FROM events""")
def q_iso_times(spark, d):
    """Offsets are dropped, never converted."""
    k = F.col("event_id") % 4
    said = F.when(k == 0, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+05:00"))).when(k == 1, F.date_format("ts", "yyyy-MM-dd")).when(k == 2, F.col("ts").cast("string")).otherwise("next week")
    e = table(spark, d, "events").withColumn("said", said)
    return e.select("event_id", dates.parse_iso("said").alias("start"), dates.is_bad_date("said").alias("bad"), dates.iso_text(dates.parse_iso("said")).alias("shown"))


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'Ongoing' WHEN 1 THEN strftime(ts, '%a, %B %-d, %Y') ELSE strftime(ts, '%a, %B %-d, %Y') || ' – ' || strftime(ts + INTERVAL 3 DAY, '%a, %B %-d, %Y') END AS shown,
  event_id % 2 = 0 AS no_time, ts::DATE AS day FROM events""")
def q_day_ranges(spark, d):
    """N12 N13 N14"""
    k = F.col("event_id") % 3
    first = F.when(k == 0, "").otherwise(dates.iso_text("ts"))
    last = F.when(k == 1, dates.iso_text("ts")).otherwise(dates.iso_text(F.col("ts") + F.expr("interval 3 days")))
    noon = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'00:00:00-07:00")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'10:30:00Z"))
    e = table(spark, d, "events").select("event_id", first.alias("a"), last.alias("b"), noon.alias("c"))
    return e.select("event_id", dates.format_range("a", "b").alias("shown"), dates.has_no_time("c").alias("no_time"), dates.local_day("c").alias("day"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE (1 + event_id % 12) || ':05 ' || CASE WHEN event_id % 2 = 0 THEN 'pm' ELSE 'AM' END END AS clock,
  '2024-02-03T' || CASE WHEN event_id % 3 = 0 THEN '12:00' ELSE lpad((CASE WHEN event_id % 2 = 0 THEN CASE WHEN event_id % 12 = 11 THEN 12 ELSE 13 + event_id % 12 END ELSE CASE WHEN event_id % 12 = 11 THEN 0 ELSE 1 + event_id % 12 END END)::VARCHAR, 2, '0') || ':05' END || ':00-07:00' AS time FROM events""")
def q_clock_times(spark, d):
    """N18 S21"""
    said = F.when(F.col("event_id") % 3 == 0, "all day").otherwise(F.concat(F.lit("from "), (1 + F.col("event_id") % 12).cast("string"), F.when(F.col("event_id") % 2 == 0, ":05 pm to 11:00 pm").otherwise(":05 AM")))
    e = table(spark, d, "events").select("event_id", dates.clock_time(said).alias("clock"))
    return e.select("event_id", "clock", dates.clock_to_iso(F.lit("2024-02-03"), "clock").alias("time"))


@query("SELECT event_id, ts > TIMESTAMP '2024-01-20' - INTERVAL 7 DAY AS fresh FROM events")
def q_freshness(spark, d):
    """N17"""
    return table(spark, d, "events").select("event_id", dates.is_fresh("ts", F.lit(datetime(2024, 1, 20)).cast("timestamp_ntz"), 7).alias("fresh"))


@query("""SELECT p_partkey, p_name || ' & Chips' AS plain, CASE WHEN p_partkey % 2 = 0 THEN p_name || ' & Chips' ELSE p_name || ' & Chips - the rest' END AS title,
  CASE WHEN p_partkey % 3 = 0 THEN repeat('word ', 59) || 'word.' ELSE repeat('word ', 99) || 'word...' END AS short FROM part""")
def q_clean_texts(spark, d):
    """Entities, tags, navigation words, site names, and descriptions cut after a sentence or a word."""
    raw = F.concat(F.lit("Menu <b>"), "p_name", F.lit("</b>\n&amp;  Chips"))
    named = F.concat(raw, F.when(F.col("p_partkey") % 2 == 0, " | My Site").otherwise(" - the rest"))
    long = F.concat(F.repeat(F.lit("word "), 59), F.when(F.col("p_partkey") % 3 == 0, "word. ").otherwise("word "), F.repeat(F.lit("word "), 80))
    p = table(spark, d, "part")
    return p.select("p_partkey", text.clean_text(raw).alias("plain"), text.clean_title(named).alias("title"), text.truncate_description(long).alias("short"))


@query(f"""SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'camp' WHEN 1 THEN 'class' WHEN 2 THEN 'workshop' WHEN 3 THEN 'course' WHEN 4 THEN 'program' ELSE 'event' END AS kind,
  CASE page_id % 6 WHEN 0 THEN 'wordpress' WHEN 1 THEN 'wix' WHEN 2 THEN 'squarespace' WHEN 3 THEN 'drupal' WHEN 4 THEN 'google_sites' ELSE 'other' END AS platform, CASE page_id % 6 WHEN 0 THEN 'tribe_events_calendar,eventon' WHEN 1 THEN 'events_manager' ELSE '' END AS plugins,
  (CASE WHEN page_id % 2 = 0 THEN 0.2 ELSE 0 END + CASE WHEN page_id % 3 = 0 THEN 0.3 ELSE 0 END + 0.15 + CASE WHEN page_id % 5 = 0 THEN 0.1 ELSE 0 END + 0.1)::DECIMAL(9, 3) AS confidence FROM pages""")
def q_site_kinds(spark, d):
    """T8 T11 T12"""
    k = F.col("page_id") % 6
    word = F.element_at(F.array(*map(F.lit, ("Camp", "Lesson", "Workshop", "Training", "Program", "Talk"))), (k + 1).cast("int"))
    mark = F.element_at(F.array(*map(F.lit, ("<a href='/WP-Content/tribe-events.js'>EventOn", "<img src=static.wixstatic.com> events-manager", "Squarespace", "Drupal 9", "plain", "plain"))), (k + 1).cast("int"))
    domain = F.when(k == 4, "sites.google.com").otherwise("x.org")
    some = lambda n, value: F.when(F.col("page_id") % n == 0, value)
    conf = taxonomy.record_confidence(some(2, "t"), some(3, "d"), F.lit("x"), F.lit(""), some(5, "api"), F.lit("event_sitemap"))
    return table(spark, d, "pages").select("page_id", taxonomy.event_kind(F.lit("https://x.org/a"), word).alias("kind"), taxonomy.platform(mark, domain).alias("platform"), F.array_join(taxonomy.plugins(mark), ",").alias("plugins"), conf.cast("decimal(9,3)").alias("confidence"))


@query("""SELECT page_id, page_id % 2 = 1 OR page_id % 5 = 0 AS listing, NOT (page_id % 2 = 1 OR page_id % 5 = 0) AND page_id % 7 <> 0 AS valid, page_id % 3 <> 0 AS dated FROM pages""")
def q_page_rules(spark, d):
    """Listing pages, valid records, real dates."""
    k = F.col("page_id")
    url = F.when(k % 4 == 1, "https://x/page/2").when(k % 4 == 3, "https://x/author/").otherwise("https://x/e")
    title = F.when(k % 5 == 0, "Archives of May").when(k % 7 == 0, "x").otherwise("A talk")
    p = table(spark, d, "pages").select("page_id", url.alias("url"), title.alias("title"), F.when(k % 3 == 0, "").otherwise("2024-01-01").alias("start_date"), F.lit("May").alias("date_text"))
    return p.select("page_id", legacy.is_listing().alias("listing"), legacy.is_valid().alias("valid"), legacy.has_real_date().alias("dated"))


@query("SELECT page_id FROM pages WHERE page_id % 7 <> 6")
def q_processed_tiers(spark, d):
    """F11"""
    tiers = F.array(*map(F.lit, ("1A", "1B", "1C", "2", "3", "2", "4")))
    return legacy.processed(table(spark, d, "pages").select("page_id", F.element_at(tiers, (F.col("page_id") % 7 + 1).cast("int")).alias("tier"))).select("page_id")


@query(f"SELECT {_HOST} AS domain, max(page_id) AS page_id FROM pages GROUP BY 1")
def q_last_per_domain(spark, d):
    """J11 A41"""
    return legacy.last_per_domain(table(spark, d, "pages").withColumn("seq", F.col("page_id")), "url").select("domain", "page_id")


@query("SELECT o_orderkey, c_custkey AS site_partner_id FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 2 = 0")
def q_of_partner(spark, d):
    """By exact name."""
    o = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("P "), "o_custkey").alias("partner_name"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.when(F.col("c_custkey") % 2 == 0, "P ").otherwise("p "), "c_custkey").alias("name"))
    return serve.of_partner(o, c).select("o_orderkey", "site_partner_id")


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'img' || p_partkey WHEN 1 THEN 'logo' ELSE '/none.png' END AS image, replace(replace(p_name, '%', '%25'), ' ', '%20') AS encoded, p_name AS area, p_size::VARCHAR || '|x y' AS sizes FROM part""")
def q_site_links(spark, d):
    """S19 S20 S22"""
    k = F.col("p_partkey") % 3
    p = table(spark, d, "part").withColumn("q", F.concat(F.lit("?area="), text.url_encode("p_name"), F.lit("&size="), F.col("p_size").cast("string"), F.lit(",x%20y&flag")))
    s = serve.filter_state("q")
    image = text.image_path(F.when(k == 0, F.concat(F.lit("img"), F.col("p_partkey").cast("string"))).otherwise(""), F.when(k == 1, "logo"), "/none.png")
    return p.select("p_partkey", image.alias("image"), text.url_encode("p_name").alias("encoded"), F.array_join(s["area"], "|").alias("area"), F.array_join(s["size"], "|").alias("sizes"))


@query("""SELECT page_id, CASE page_id % 3 WHEN 0 THEN '_index' WHEN 1 THEN 'a/b' || page_id ELSE 'a/b' || page_id || '_' || substr(sha256('q=' || page_id), 1, 8) END AS place,
  sha256('https://x.org' || CASE page_id % 3 WHEN 0 THEN '/' WHEN 1 THEN '/a/b' || page_id || '/' ELSE '/a/b' || page_id || '?q=' || page_id END) AS key FROM pages""")
def q_mirror_paths(spark, d):
    """A40 M9"""
    n, k = F.col("page_id").cast("string"), F.col("page_id") % 3
    url = F.concat(F.lit("https://x.org"), F.when(k == 0, "/").when(k == 1, F.concat(F.lit("/a/b"), n, F.lit("/"))).otherwise(F.concat(F.lit("/a/b"), n, F.lit("?q="), n)))
    return table(spark, d, "pages").select("page_id", identity.mirror_path(url).alias("place"), identity.url_key(url).alias("key"))


@query("""SELECT event_id, sha256('{"title":"' || event_type || '","description":"' || user_id || '","location":"","cost":"","registration_url":"","image_url":"","url":"","categories":[],"tags":[],"start":null}') AS hash FROM events""")
def q_content_hash(spark, d):
    """M3"""
    e = as_events(table(spark, d, "events"), None, seq="event_id", title="event_type", description=F.col("user_id").cast("string"))
    return e.select(F.col("seq").alias("event_id"), identity.content_hash().alias("hash"))


@query("SELECT event_id, 'V' || event_id || ', Town' AS location, CASE WHEN event_id % 2 = 0 THEN 'Org' END AS organizer_name FROM events")
def q_flat_records(spark, d):
    """S23"""
    some = lambda c, name: c.cast("string").alias(name)
    venue = F.struct(some(F.concat(F.lit("V"), F.col("event_id").cast("string")), "venue"), some(F.lit(""), "address"), some(F.lit("Town"), "city"), some(F.lit(None), "state"), some(F.lit(None), "zip"))
    org = F.array(F.struct(F.lit("Org").alias("organizer"), F.lit("o@x").alias("email")))
    e = table(spark, d, "events").select("event_id", venue.alias("venue"), F.when(F.col("event_id") % 2 == 0, org).otherwise(F.filter(org, lambda x: F.lit(False))).alias("organizer"))
    return legacy.flatten_tec(e).select("event_id", "location", "organizer_name")


@query("""SELECT event_id, 'org_' || user_id || '_' || event_type || '_' || strftime(ts, '%Y%m%d') AS slug, 'Org ' || user_id AS partner_name, strftime(ts, '%Y-%m-%d') || 'T15:30:00-07:00' AS date_start,
  CASE WHEN event_id % 3 = 0 THEN '3:30 pm; Repeats 4 times through ' || strftime(ts, '%Y-%m-%d') ELSE '3:30 pm' END AS availability, 'https://x/' || event_id AS link, CASE WHEN event_id % 5 = 0 THEN 'All Day' ELSE 'Afternoon' END AS time_of_day FROM events""")
def q_legacy_build(spark, d):
    """S24"""
    k, none = F.col("event_id"), F.lit("")
    empty = F.array().cast("array<string>")
    r = table(spark, d, "events").select(
        k.alias("seq"), F.concat(F.lit("Org "), F.col("user_id").cast("string")).alias("org"), F.col("event_type").alias("title"), none.alias("description"), empty.alias("categories"), empty.alias("tags"),
        F.date_format("ts", "yyyy-MM-dd").alias("start_date"), none.alias("end_date"), F.lit("3:30 pm").alias("start_time"), none.alias("end_time"), none.alias("cost"), none.alias("location"),
        none.alias("registration_url"), F.concat(F.lit("https://x/"), k.cast("string")).alias("page_url"), (k % 5 == 0).alias("all_day"), F.when(k % 3 == 0, 4).otherwise(1).alias("repeat_count"),
    )
    partners = spark.createDataFrame([], "id long, name string, location string, latitude double, longitude double, logo_src string, seq long")
    return legacy.build_opportunities(r, partners).select(F.col("seq").alias("event_id"), "slug", "partner_name", "date_start", "availability", "link", F.array_join("time_of_day", "|").alias("time_of_day"))


@query("SELECT user_id, max(event_id) AS event_id FROM events GROUP BY 1")
def q_latest_per(spark, d):
    """K9"""
    return state.latest_per(table(spark, d, "events"), "user_id", order="event_id").select("user_id", "event_id")


@query("""WITH p AS (SELECT page_id, sha256(url) AS key FROM pages), o AS (SELECT * FROM p WHERE page_id % 2 = 0), n AS (SELECT *, CASE page_id % 3 WHEN 0 THEN 200 WHEN 1 THEN 304 ELSE 500 END AS status FROM p WHERE page_id % 5 <> 0)
SELECT coalesce(o.key, n.key) AS key, CASE WHEN status = 200 THEN 'new' ELSE 'old' END AS body, CASE WHEN status IN (200, 304) THEN 2 ELSE 1 END AS fetched_at FROM o FULL JOIN n ON o.key = n.key WHERE status = 200 OR o.key IS NOT NULL""")
def q_http_cache(spark, d):
    """200 replaces, 304 renews the time, anything else changes nothing."""
    p = table(spark, d, "pages")
    old = p.filter("page_id % 2 = 0").select(identity.url_key("url").alias("key"), "url", F.lit("old").alias("body"), F.lit("e").alias("etag"), F.lit("").alias("last_modified"), F.lit(1).alias("fetched_at"))
    status = F.expr("CASE page_id % 3 WHEN 0 THEN 200 WHEN 1 THEN 304 ELSE 500 END")
    new = p.filter("page_id % 5 <> 0").select("url", status.alias("status"), F.when(status == 200, "new").alias("body"), F.lit("f").alias("etag"), F.lit("").alias("last_modified"), F.lit(2).alias("fetched_at"))
    return fetch.resolved(new, old).select("key", "body", "fetched_at")


_GIF = "from_hex('47494638396164006400') || (doc_id % 10)::VARCHAR::BLOB"


@query(f"""WITH i AS (SELECT doc_id, 'https://x/' || lpad(doc_id::VARCHAR, 9, '0') AS url, {_GIF} AS data FROM documents WHERE doc_id % 6 NOT IN (0, 1, 2))
SELECT url, substr(sha256(data), 1, 16) || '.gif' AS file_name FROM i""")
def q_hosted_images(spark, d):
    """Images by header, size, status and type; equal contents share a name."""
    n, k = F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.col("doc_id") % 6
    data = F.concat(F.when(k == 2, F.unhex(F.lit("47494638396110001000"))).otherwise(F.unhex(F.lit("47494638396164006400"))), (F.col("doc_id") % 10).cast("string").cast("binary"))
    i = table(spark, d, "documents").select(F.concat(F.lit("https://x/"), n).alias("url"), F.when(k == 0, 404).otherwise(200).alias("status"), F.when(k == 1, "text/html").otherwise("image/gif").alias("content_type"), data.alias("data"))
    return images.hosted(i)
