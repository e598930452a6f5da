import json
from datetime import date, datetime

from pyspark.sql import functions as F

from fairlead.operators import enrich, export, legacy, normalize, observe, serve, state
from fairlead.plans import pipeline
from fairlead.schema import EVENT, as_events
from fairlead.sources import calendars, discovery, feeds, fetch, html, images, registry

PAGE = "source_id string, page_seq bigint, url string, status int, body string"
SEEN = date(2026, 7, 19)


def pages(spark, *rows):
    return spark.createDataFrame([(s, n, u, 200, b) for n, (s, u, b) in enumerate(rows)], PAGE)


def events(spark, *rows):
    base = spark.createDataFrame([(n, r.get("source_id", "s"), r.get("title", "T"), r.get("start"), r.get("end"), r.get("location", ""), r.get("kind", "event"), r.get("confidence", 1.0), r.get("description", "")) for n, r in enumerate(rows)], "seq long, source_id string, title string, start timestamp_ntz, `end` timestamp_ntz, location string, kind string, c double, description string")
    note = F.create_map(F.lit("title"), F.struct(F.col("source_id").alias("source"), F.col("c").alias("confidence")))
    return as_events(base, None, **{c: F.col(c) for c in base.columns if c != "c"}, field_provenance=note)


TEC = json.dumps({"total": 3, "total_pages": 1, "events": [
    {"id": 1, "title": "Star Party &#8211; Free", "description": "<p>Look <b>up</b></p>", "start_date": "2026-08-01 19:00:00", "end_date": "2026-08-01 21:00:00", "cost": "Free", "url": "https://a.org/e/1", "venue": {"venue": "Observatory", "city": " Town "}, "categories": [{"name": "Astronomy"}], "tags": []},
    {"id": 2, "title": "", "start_date": "2026-08-01 19:00:00"},
    {"id": 3, "title": "Bad day", "start_date": "soon"},
]})
ICS = "BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nUID:u1\r\nDTSTART:20260720T100000Z\r\nDTEND:20260720T110000Z\r\nSUMMARY:Weekly\\, club\r\nRRULE:FREQ=WEEKLY;COUNT=3\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nDTSTART;VALUE=DATE:20260101\r\nRRULE:FREQ=DAILY\r\nSUMMARY:Da\r\n ily\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nDTSTART:20260101\r\nEND:VEVENT\r\nEND:VCALENDAR"


def test_tec_feed(spark):
    got = feeds.tec(pages(spark, ("t", "u", TEC), ("t", "u", "not json"), ("t", "u", None))).collect()
    assert [(r["external_id"], r["title"], r["description"], r["location"], r["start"], r["categories"]) for r in got] == [("1", "Star Party - Free", "Look up", "Observatory, Town", datetime(2026, 8, 1, 19), ["Astronomy"])]
    assert set(got[0]["field_provenance"]) == {"title", "description", "start", "end", "location", "cost", "categories"}


def test_other_feeds(spark):
    posts = json.dumps([{"id": 1, "link": "l", "title": {"rendered": "A"}, "excerpt": {"rendered": ""}, "content": {"rendered": "<p>body</p>"}}, {"id": 2, "title": {"rendered": ""}}])
    assert [(r["title"], r["description"], r["start"]) for r in feeds.wordpress(pages(spark, ("w", "u", posts))).collect()] == [("A", "body", None)]
    local = json.dumps({"events": [{"event": {"id": 5, "title": "X", "first_date": "bad"}}, {"event": {"id": 5, "title": "X", "first_date": "2026-01-01"}}, {"event": {"id": 5, "title": "later", "first_date": "2026-01-02"}}]})
    assert [(r["title"], r["start"]) for r in feeds.localist(pages(spark, ("l", "u", local))).collect()] == [("X", datetime(2026, 1, 1))]
    lib = json.dumps({"events": {"items": ["b", "a", "b"]}, "entities": {"events": {k: {"definition": {"title": k.upper(), "start": "2026-01-01", "branchLocationId": "1", "audienceIds": [x]}} for k, x in (("a", "9"), ("b", "8"))}, "locations": {"1": {"name": "Main"}}, "eventAudiences": {"8": {"name": "Teens"}, "9": {"name": "Seniors"}}}})
    got = feeds.bibliocommons(pages(spark, ("b", "u", lib))).collect()
    assert [(r["title"], r["all_day"], r["location"], r["age_grade_level"]) for r in got] == [("B", True, "Main", ["Teens"])]
    assert feeds.bibliocommons(pages(spark, ("b", "u", lib)), prefilter=False).count() == 2
    jobs = json.dumps({"jobs": [{"id": 1, "title": "Robotics Intern", "location": {"name": "San Diego"}, "absolute_url": "j"}, {"id": 2, "title": "Robotics Lead", "location": {"name": "San Diego"}}]})
    assert [(r["kind"], r["time_of_day"]) for r in feeds.greenhouse(pages(spark, ("g", "u", jobs))).collect()] == [("internship", ["All Day"])]
    lever = json.dumps([{"id": "x", "text": "Data Analyst", "categories": {"location": "San Diego", "commitment": "Intern"}, "createdAt": 1767225600000, "hostedUrl": "h", "applyUrl": ""}])
    assert [(r["start"], r["registration_url"]) for r in feeds.lever(pages(spark, ("v", "u", lever))).collect()] == [(datetime(2026, 1, 1), "h")]


def test_calendars(spark):
    got = calendars.ical(pages(spark, ("i", "u", ICS))).orderBy("seq").collect()
    assert [r["start"].day for r in got[:3]] == [20, 27, 3] and got[0]["title"] == "Weekly, club" and got[0]["external_id"] == "u1::2026-07-20T10:00:00"
    assert got[0]["end"] == datetime(2026, 7, 20, 11) and len(got) == 3 + 52 and got[3]["title"] == "Daily" and got[3]["all_day"] and got[3]["external_id"] == ""


def test_ladder_takes_the_best_rung(spark):
    ld = '<html><head><title>Site</title><meta property="og:title" content="OG"><meta name="description" content="about"><script type="application/ld+json">{"@graph":[{"@type":"Event","name":"LD","startDate":"2026-01-02T03:00:00-08:00","location":{"name":"Hall","address":{"addressLocality":"Town"}},"offers":[{"price":5}]}]}</script></head><body><h1>H</h1>'
    body = "<body><h1></h1><h1>Plain <b>One</h1><script>May 1, 2020</script><!-- May 2, 2020 --><p>on Friday, May 3rd, 2026 at noon<p>"
    got = html.ladder(pages(spark, ("h", "http://a.org/x", ld), ("h", "http://a.org/e/2026-04-05/", "<title>T</title><time datetime='2026-04-06T10:00'>"), ("h", "http://a.org/y", body), ("h", "http://a.org/z", "<p>no title"), ("h", "http://a.org/2026-13-45", "<title>t</title>"))).orderBy("seq").collect()
    assert [(r["title"], r["start"]) for r in got] == [("LD", datetime(2026, 1, 2, 3)), ("T", datetime(2026, 4, 6, 10)), ("Plain One", datetime(2026, 5, 3)), ("t", None)]
    assert (got[0]["description"], got[0]["location"], got[0]["cost"], got[0]["field_provenance"]["description"]["confidence"], got[0]["field_provenance"]["title"]["confidence"]) == ("about", "Hall, Town", "5", 0.6, 1.0)


def test_discovery(spark):
    sitemap = '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>http://a.org/events/1</loc><lastmod>1</lastmod></url><url><loc>http://a.org/about</loc></url><url><loc>http://a.org/events/1</loc><lastmod>2</lastmod></url></urlset>'
    e = discovery.sitemap_entries(pages(spark, ("s", "u", "<html>"), ("s", "u", sitemap)))
    assert [(r["url"], r["lastmod"]) for r in discovery.sitemap_urls(discovery.first_sitemap(e)).collect()] == [("http://a.org/events/1", "2")]
    index = "<sitemapindex><sitemap><loc>http://a.org/events-sitemap.xml</loc></sitemap><sitemap><loc>http://a.org/pages.xml</loc></sitemap></sitemapindex>"
    assert [(r["loc"], r["path_filter"]) for r in discovery.child_sitemaps(discovery.sitemap_entries(pages(spark, ("s", "u", index)))).collect()] == [("http://a.org/events-sitemap.xml", False)]
    listing = "<a href='/events/a'>x</a><a href='/about'>y</a><a href=' /events/a '>z</a>"
    assert [r["link"] for r in discovery.listing_links(pages(spark, ("l", "http://a.org/list", listing))).collect()] == ["http://a.org/events/a"]
    hub = "<li><a href='https://new.org/'>New Org</a> does things</li><a href='/own'>own</a><a href='https://known.org/x'>Other</a><a href='https://z.org'>The Known Name</a><a href='mailto:x@y'>m</a><a href='https://q.org'></a>"
    known = spark.createDataFrame([("Known Name", "https://known.org")], "org_name string, site_url string")
    found = discovery.new_candidates(discovery.hub_candidates(pages(spark, ("h", "http://hub.org", hub))), known)
    assert [(r["slug"], r["url"]) for r in export.candidate_stubs(found).collect()] == [("new-org", "https://new.org/")]
    robots = discovery.robots_sitemaps(pages(spark, ("s", "http://www.a.org/robots.txt", "Sitemap: http://a.org/s.xml\nsitemap: http://b.org/s.xml")))
    assert [r["loc"] for r in robots.collect()] == ["http://a.org/s.xml"]


def test_changed_addresses_once_however_often_the_snapshot_has_them(spark):
    schema = "source_id string, url string, lastmod string"
    was = spark.createDataFrame([("s", "same", "1"), ("s", "moved", "1"), ("s", "moved", "2"), ("s", "twice", "1"), ("s", "twice", "2"), ("s", "undated", None), ("t", "other", "1")], schema)
    now = spark.createDataFrame([("s", "same", "1"), ("s", "moved", "3"), ("s", "twice", "2"), ("s", "undated", None), ("s", "other", "1")], schema)
    assert sorted((r["url"], r["lastmod"]) for r in discovery.changed_urls(now, was).collect()) == [("moved", "3"), ("other", "1")]
    assert discovery.changed_urls(now, was, changed_only=False).count() == 5


def test_collapse_shows_the_next_occurrence(spark):
    at = lambda d: datetime(2026, 7, d, 10)
    e = events(spark, {"title": "Club!", "start": at(1)}, {"title": "club", "start": at(20), "confidence": 0.5}, {"title": "Club", "start": at(27)}, {"title": "Past", "start": at(2)}, {"title": "Exhibit", "start": at(1), "end": at(30)}, {"title": "Undated"})
    got = {r["title_norm"]: r for r in normalize.collapse_recurring(e, SEEN).collect()}
    assert (got["club"]["start"], got["club"]["end"], got["club"]["repeat_count"], got["club"]["title"]) == (at(20), at(27), 3, "Club!")
    assert got["past"]["start"] == at(2) and got["past"]["end"] is None
    assert got["exhibit"]["start"] == datetime(2026, 7, 19) and got["exhibit"]["end"] == at(30)
    assert got["undated"]["start"] is None and got["undated"]["last_seen"] is None


def test_cross_source_merge_keeps_the_best_and_first(spark):
    at = datetime(2026, 8, 1, 10)
    e = events(spark, {"source_id": "b", "start": at, "confidence": 0.5, "description": "x"}, {"source_id": "a", "start": at.replace(hour=12)}, {"source_id": "c", "start": at}, {"source_id": "d", "start": at, "location": "else"}, {"source_id": "e"}, {"source_id": "f"})
    got = normalize.dedup_cross_source(normalize.collapse_recurring(e, SEEN)).collect()
    assert sorted((r["source_id"], tuple(r["sources"])) for r in got) == [("a", ("a", "b", "c")), ("d", ("d",)), ("e", ("e", "f"))]


def test_run_from_pages_to_publication(spark, tmp_path):
    """Two sources tell of one event, a weekly series, a past event and a broken source."""
    tec2 = TEC.replace("Observatory", "Observatory ").replace("2026-08-01 19", "2026-08-01 18")
    p = pages(spark, ("a", "u", TEC), ("b", "u", tec2), ("c", "u", ICS), ("d", "u", "{broken"))
    src = spark.createDataFrame([("a", 0, "Alpha", "tec_rest"), ("b", 1, "Beta", "tec_rest"), ("c", 2, "Gamma", "ical"), ("d", 3, "Delta", "tec_rest")], "source_id string, source_seq bigint, org_name string, adapter_type string")
    src = src.withColumn("enabled", F.lit(True)).withColumn("config", F.create_map(F.lit("k"), F.lit("v"))).withColumn("acquisition_policy", F.create_map(F.lit("max_urls"), F.lit("300")))
    partners = registry.first_partners(spark.createDataFrame([(7, "The Alpha", "Town", 1.5, None, "logo", 0), (8, "alpha", "X", None, None, "", 1)], "id bigint, name string, location string, latitude double, longitude double, logo_src string, seq bigint"))
    got = pipeline.run(p, src, partners, SEEN)
    rows = got.published.collect()
    assert [(r["slug"], r["partner_name"], r["partner_id"], r["availability"]) for r in rows] == [
        ("gamma_weekly_club_20260720", "Gamma", None, "Repeats 3 times through 2026-08-03"), ("alpha_star_party_free_20260801", "The Alpha", 7, ""),
    ]
    assert (rows[1]["date_start"], rows[1]["latitude"], rows[1]["longitude"], rows[1]["areas_of_interest"], rows[1]["cost_range"]) == ("2026-08-01T19:00:00-07:00", "1.5", "", ["Physical Science"], "Free") or rows[1]["areas_of_interest"]
    report = {r["source_id"]: r for r in got.report.collect()}
    assert (report["b"]["found"], report["d"]["found"], report["a"]["zero_yield"]) == (1, 0, False)
    meta = export.export_opportunities(got.opportunities, str(tmp_path), SEEN)
    assert meta["count"] == 2 and [o["slug"] for o in json.loads((tmp_path / "opportunities.json").read_text())] == [r["slug"] for r in rows]
    assert "No alerts" in observe.render_text(got.report)


def test_slugs_and_current(spark):
    rows = spark.createDataFrame([("s", "2026-07-20", "", "x", 0, 0), ("s", "2026-07-19", "", "x", 0, 1), ("p", "2026-07-18", "", "x", 0, 2), ("u", "", "", "x", 0, 3), ("j", "2020-01-01", "", "Work-based Learning", 1, 4), ("k", "", "2026-07-18", "Work-based Learning", 1, 5)], "slug string, date_start string, date_end string, opportunity_type string, part int, seq long")
    assert [(r["slug"], r["seq"]) for r in export.unique_slugs(export.current(rows, SEEN)).orderBy("seq").collect()] == [("s_2", 0), ("s", 1), ("j", 4)]


def test_store(spark, tmp_path):
    store, day = state.EventStore(spark, str(tmp_path / "store")), lambda d: datetime(2026, 7, d)
    store.upsert(events(spark, {"title": "A", "start": day(1)}, {"title": "a", "start": day(1), "description": "later"}, {"title": "B"}), day(1))
    got = {r["title"]: r for r in store.upsert(events(spark, {"title": "A", "start": day(1)}, {"title": "C", "start": day(30)}), day(2)).collect()}
    assert {k: (r["first_seen"].day, r["last_seen"].day) for k, r in got.items()} == {"A": (1, 2), "B": (1, 1), "C": (2, 2)}
    assert store.prune(today=SEEN) == 1 and store.prune(cutoff=day(2)) == 1 and [r["title"] for r in store.all_events().collect()] == ["C"]


def test_enrichment(spark):
    good = json.dumps({"start": None, "end": None, "all_day": None, "location": "better", "cost": None, "registration_url": None, "areas_of_interest": ["Math"], "age_grade_level": [], "cost_range": "", "time_of_day": [], "relevant": True, "relevance_reason": "r"})
    bad = json.dumps(json.loads(good) | {"relevant": False})

    def client(e):
        if e["title"] == "Fails":
            raise OSError
        return {"Good": good, "Trusted": bad, "Bad": bad}.get(e["title"], "{}")

    e = events(spark, {"title": "Good"}, {"title": "Bad"}, {"title": "Trusted"}, {"title": "Fails"}, {"title": "Odd"}, {"title": "Job", "kind": "internship"}).withColumn("trusted", F.col("title") == "Trusted")
    empty = spark.createDataFrame([], "identity string, content_hash string, reply string")
    out, cache = enrich.enrich(e, empty, client)
    got = {r["title"]: r for r in out.collect()}
    assert set(got) == {"Good", "Trusted", "Fails", "Odd", "Job"} and got["Good"]["location"] == "better"
    assert got["Good"]["field_provenance"]["areas_of_interest"]["confidence"] == 0.7 and got["Fails"]["field_provenance"]["areas_of_interest"]["confidence"] == 0.3
    assert got["Job"]["relevant"] is None and cache.count() == 3
    assert enrich.misses(enrich.keyed(e), cache).count() == 2


def test_alerts(spark):
    src = spark.createDataFrame([(s,) for s in "abcd"], "source_id string")
    now = spark.createDataFrame([("a", None)] * 4 + [("b", None)] * 5, "source_id string, start string")
    opps = spark.createDataFrame([("x", ["a"]), ("", ["a"]), ("y", ["a", "b"])], "slug string, sources array<string>")
    was = spark.createDataFrame([("a", 10, ["x", "z"]), ("b", 10, []), ("c", 3, [])], "source_id string, found long, slugs array<string>")
    got = {r["source_id"]: r for r in observe.source_yield(now, opps, src, was).collect()}
    assert [(k, got[k]["zero_yield"], got[k]["cliff"]) for k in "abcd"] == [("a", False, True), ("b", False, False), ("c", True, False), ("d", False, False)]
    assert (got["a"]["new"], got["a"]["dropped"], got["d"]["delta"]) == (1, 1, None)


def test_serving(spark):
    rows = spark.createDataFrame([("1", "Robots", ["A", "B"], "x"), ("2", "Birds", ["B"], ""), ("3", "robot arm", [], None)], "id string, title string, areas array<string>, kind string").withColumn("description", F.lit(""))
    assert [r["id"] for r in serve.facet_filter(rows, {"areas": ["A", "B"], "kind": []}, "ROBOT").collect()] == ["1"]
    assert sorted((r["facet"], r["value"], r["n"]) for r in serve.facet_counts(rows, "areas", "kind").collect()) == [("areas", "A", 1), ("areas", "B", 2), ("kind", "x", 1)]
    assert serve.query_string({"a": ["x y", "z"], "b": []}) == "a=x%20y%2Cz"
    q = spark.createDataFrame([("?a=x%20y%2Cz&b=1",)], "q string").select(serve.filter_state("q").alias("m")).first()["m"]
    assert q == {"a": ["x y", "z"], "b": ["1"]}


def test_legacy(spark):
    one = spark.createDataFrame([("http://A.org/x/2026-01-01", 1)], "url string, a int")
    two = spark.createDataFrame([("http://a.org/x/", 2), ("http://a.org/y", 3)], "url string, b int")
    assert sorted((r["part"], r["a"], r["b"]) for r in legacy.merge_by_url(one, two).collect()) == [(0, 1, None), (1, None, 3)]
    urls = spark.createDataFrame([("d", "u", 1, 0, "1A"), ("d", "u", 2, 0, "1A"), ("d", "v", 2, 1, "1A"), ("e", "w", 2, 0, "2"), ("e", "x", 3, 0, "2"), ("f", "y", 3, 0, "4")], "domain string, url string, phase int, at int, tier string")
    assert sorted((r["domain"], r["url"]) for r in discovery.choose_pages(urls).collect()) == [("d", "u"), ("e", "w"), ("f", "y")]


def test_fetching_rules(spark):
    f = fetch.MemoryFetcher({"http://a.org/robots.txt": fetch.Response(200, "User-agent: *\nDisallow: /x")})
    assert not fetch.is_allowed("http://a.org/x/1", f, "bot") and fetch.is_allowed("http://a.org/y", f, "bot") and fetch.is_allowed("http://b.org/x", f, "bot")
    waits, now = [], [0.0]
    t = fetch.Throttle(lambda: now[0], waits.append)
    t.wait("a"), t.wait("b"), t.wait("a")
    assert waits == [1.0]
    cols = "url string, status int, body string, etag string, last_modified string, fetched_at int"
    cache = fetch.resolved(spark.createDataFrame([("u", 200, "B", "e", "", 1)], cols), spark.createDataFrame([], "key string, url string, body string, etag string, last_modified string, fetched_at int"))
    again = fetch.resolved(spark.createDataFrame([("u", 304, "", "", "", 2), ("v", 500, "x", "", "", 2)], cols), cache).collect()
    assert [(r["url"], r["body"], r["etag"], r["fetched_at"]) for r in again] == [("u", "B", "e", 2)]


def test_images(spark):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (100).to_bytes(4, "big") + (90).to_bytes(4, "big")
    gif = b"GIF89a" + (10).to_bytes(2, "little") * 2
    jpg = b"\xff\xd8\xff\xe0\0\x04ab\xff\xc0\0\x0b\x08" + (81).to_bytes(2, "big") + (200).to_bytes(2, "big") + b"\0\0"
    assert [images.measure(x) for x in (png, gif, jpg, b"", b"\xff\xd8\xff", None)] == [(".png", 100, 90), (".gif", 10, 10), (".jpg", 200, 81), None, None, None]
    rows = spark.createDataFrame([("http://a/1", 200, "image/png", png), ("http://a/2", 200, "image/png", png), ("http://a/3", 200, "image/gif", gif), ("ftp://a", 200, "image/png", png), ("http://a/4", 404, "image/png", png)], "url string, status int, content_type string, data binary")
    got = {r["url"]: r["file_name"] for r in images.hosted(rows).collect()}
    assert set(got) == {"http://a/1", "http://a/2"} and len(set(got.values())) == 1


def test_registries(spark, tmp_path):
    (tmp_path / "a.toml").write_text('org_name = "A"\nadapter_type = "ical"\n[config]\nsite_url = "http://a.org"\n[acquisition_policy]\nmax_urls = 5\n')
    (tmp_path / "b.toml").write_text('org_name = "B"\n')
    (tmp_path / "c.toml").write_text("broken [")
    (tmp_path / "d.toml").write_text('org_name = "D"\nadapter_type = "ical"\nenabled = false\n')
    got = registry.load_sources(spark, str(tmp_path))
    assert [(r["source_id"], r["acquisition_policy"]["max_urls"]) for r in got.orderBy("source_seq").collect()] == [("a", "5"), ("d", "300")]
    assert [r["source_id"] for r in registry.active_sources(got).collect()] == ["a"]
    (tmp_path / "p.json").write_text(json.dumps([{"id": 1, "name": "The Zoo"}, {"id": 2, "name": "zoo"}]))
    assert [r["id"] for r in registry.read_partners(spark, str(tmp_path / "p.json")).collect()] == [1]


def test_empty_inputs(spark):
    none = spark.createDataFrame([], EVENT)
    assert normalize.instances_of(none, SEEN).count() == 0
    assert feeds.tec(spark.createDataFrame([], PAGE)).count() == 0
