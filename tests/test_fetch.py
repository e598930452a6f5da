import json
import sqlite3
import threading
from datetime import date, datetime, timedelta
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from fairlead.__main__ import main
from fairlead.operators import enrich, legacy, observe, state
from fairlead.plans import pipeline
from fairlead.sources import crawl, feeds, fetch, registry, site_pages
from tests.test_engine import TEC, events, pages

NO_WAIT = fetch.Limits(delay=0)
R = fetch.Response


def memory(answers):
    return lambda: fetch.MemoryFetcher(answers)


def test_http():
    class Site(BaseHTTPRequestHandler):
        def do_GET(self):
            status = 404 if "none" in self.path else 200
            body = (self.headers["User-Agent"] + "|" + (self.headers["X-A"] or "")).encode() + (b"\xff" if "bad" in self.path else b"") + b"x" * (100 if "long" in self.path else 0)
            self.send_response(status)
            self.send_header("ETag", "e1")
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{server.server_port}"
    f = fetch.UrlFetcher("me", fetch.Limits(most_bytes=50))
    got = f.get(f"{at}/bad", {"X-A": "1"})
    assert (got.status, got.body, fetch.header(got.headers, "etag")) == (200, "me|1�", "e1")
    assert f.get(f"{at}/none").status == 404 and f.get(f"{at}/long").body == ""
    server.shutdown()
    server.server_close()
    with pytest.raises(OSError):
        f.get(at)


def test_retries_and_browser():
    class Flaky:
        asked = 0

        def get(self, url, headers=None):
            self.asked += 1
            if self.asked == 1:
                raise OSError
            return R(503 if self.asked == 2 else 200, "ok")

    pauses, flaky = [], Flaky()
    assert fetch.persistent(flaky, "u", {}, NO_WAIT, lambda: pauses.append(1)).body == "ok" and len(pauses) == 3
    gone = fetch.MemoryFetcher({"u": R(404)})
    assert fetch.persistent(gone, "u", {}, NO_WAIT, lambda: None).status == 404 and gone.asked == ["u"]

    class PageTimeoutError(Exception):
        pass

    class Page:
        headers, status = {"a": "b"}, 201

        def goto(self, url):
            return self

        def wait_for_load_state(self, what, timeout):
            raise PageTimeoutError

        def content(self):
            return "<p>"

    opened = []
    browser = fetch.BrowserFetcher(lambda: opened.append(1) or Page())
    assert not opened and [browser.get("u") for _ in range(2)] == [R(201, "<p>", {"a": "b"})] * 2 and opened == [1]


def test_fetched(spark):
    answers = {"http://a.org/robots.txt": R(200, "User-agent: *\nDisallow: /no"), "http://a.org/x": R(200, "X", {"etag": "e"}), "http://a.org/no": R(200, "never"), "http://b.org/y": R(500)}
    refs = spark.createDataFrame([("s", n, u) for n, u in enumerate(("http://a.org/x", "http://a.org/no", "http://b.org/y", "http://c.org/z"))], "source_id string, page_seq long, url string")
    got = {r["url"]: (r["status"], r["body"], r["etag"]) for r in fetch.fetched(refs, memory(answers), NO_WAIT).collect()}
    assert got == {"http://a.org/x": (200, "X", "e"), "http://a.org/no": (0, "", ""), "http://b.org/y": (500, "", ""), "http://c.org/z": (404, "", "")}
    assert fetch.fetched(refs.limit(0), memory(answers), NO_WAIT).count() == 0

    class Strict:
        def get(self, url, headers=None):
            return R(304 if (headers or {}).get("If-None-Match") == "e" and headers["Authorization"] == "k" else 200)

    sent = refs.limit(1).withColumn("etag", F.lit("e")).withColumn("headers", F.create_map(F.lit("Authorization"), F.lit("k")))
    assert fetch.fetched(sent, Strict, NO_WAIT).first()["status"] == 304


SITE = {
    "https://a.org/robots.txt": R(200, "Sitemap: https://a.org/maps.xml\nSitemap: https://other.org/m.xml"),
    "https://a.org": R(200, '<a href="/p1">1</a><a href="http://b.org/">b</a><a href="/f.pdf">f</a><a href="/p1#part">1</a>'),
    "https://a.org/p1": R(200, '<a href="p2">2</a><a href="/">home</a><script>s</script>'),
    "https://a.org/p2": R(200, "<p>end</p>"),
    "https://a.org/maps.xml": R(200, '<sitemapindex xmlns="urn:x"><sitemap><loc>https://www.a.org/more.xml</loc></sitemap></sitemapindex>'),
    "https://www.a.org/more.xml": R(200, "<urlset><url><loc>https://a.org/deep</loc></url><url><loc>https://else.org/x</loc></url></urlset>"),
    "https://a.org/deep": R(200, "<p>deep</p>"),
}


def test_crawl(spark, tmp_path):
    sites = spark.createDataFrame([("a", "a.org")], "source_id string, url string")
    found = crawl.crawl(sites, str(tmp_path / "m"), memory(SITE), NO_WAIT)
    good = {r["url"]: r["level"] for r in found.filter("status = 200").collect()}
    assert good == {"https://a.org": 0, "https://a.org/robots.txt": 0, "https://a.org/p1": 1, "https://a.org/maps.xml": 1, "https://a.org/p2": 2, "https://www.a.org/more.xml": 2, "https://a.org/deep": 3}
    assert found.groupBy("url").count().filter("count > 1").isEmpty()
    # A finished crawl is read, not repeated; a fresh page is taken from an earlier one, a stale one is asked for again.
    assert crawl.crawl(sites, str(tmp_path / "m"), memory({}), NO_WAIT).filter("status = 200").count() == 7
    now = F.lit(datetime.now() + timedelta(minutes=5)).cast("timestamp")
    assert crawl.crawl(sites, str(tmp_path / "n"), memory({}), NO_WAIT, known=found, now=now).filter("status = 200").count() == 7
    assert crawl.crawl(sites, str(tmp_path / "o"), memory({}), NO_WAIT, known=found, now=now, days=0.0001).filter("status = 200").count() == 0
    assert crawl.crawl(sites, str(tmp_path / "p"), memory(SITE), fetch.Limits(delay=0, depth=1)).filter("status = 200").count() == 4
    page = crawl.mirrored(found).filter("path = 'p1'").first()
    assert page["domain"] == "a.org" and "script" not in page["html"] and json.loads(page["meta"])["url"] == "https://a.org/p1"


def test_read_mirror(spark, tmp_path):
    for place, meta in (("a.org/events/x", '{"url": "http://a.org/events/x", "headers": {"X-Tec-Api-Root": "http://a.org/api"}}'), ("a.org/Camps", None), ("a.org/about", "{}"), ("b.org/about/events", "{}")):
        at = tmp_path / place
        at.mkdir(parents=True)
        (at / "content.html").write_text(f"<h1>{place}</h1>")
        if meta:
            (at / "meta.json").write_text(meta)
    got = {(r["domain"], r["path"]): r for r in crawl.read_mirror(spark, str(tmp_path)).collect()}
    assert set(got) == {("a.org", "events/x"), ("a.org", "Camps")} and got["a.org", "Camps"]["url"] is None
    assert crawl.read_mirror(spark, str(tmp_path), events_only=False).count() == 4
    site = crawl.read_mirror(spark, str(tmp_path)).filter("url is not null").withColumns({"organization": F.lit("A"), "platform": F.lit("wordpress"), "plugin": F.lit("tribe_events"), "source_method": F.lit("dir")})
    assert site_pages.extract_pages(site).first()["api_url"] == "http://a.org/api" and site_pages.extract_pages(site.drop("headers")).first()["api_url"] == ""


def test_pages_in_turn(spark):
    body = lambda n, total: json.dumps({"events": [{"id": n, "title": f"T{n}", "description": "<b>d</b>", "venue": {"venue": "Hall", "city": "Town"}, "organizer": [{"organizer": "O", "email": "e"}], "categories": [{"name": "c"}], "image": {"url": "i"}}], "total_pages": total})
    url = lambda site, n: f"http://{site}.org/e?per_page=50&page={n}&status=publish"
    answers = {url("a", 1): R(200, body(1, 2)), url("a", 2): R(200, body(2, 2)), url("b", 1): R(200, body(3, 9)), url("b", 2): R(200, "no json"), url("b", 3): R(200, body(4, 9)), url("c", 1): R(200, '{"events": []}')}
    sites = spark.createDataFrame([(s, f"http://{s}.org/e", s.upper(), f"{s}.org") for s in "abcd"], "source_id string, api_base string, organization string, domain string")
    landed = crawl.pages_in_turn(sites, memory(answers), NO_WAIT).cache()
    assert sorted((r["source_id"], r["page_seq"]) for r in landed.collect()) == [("a", 1), ("a", 2), ("b", 1)]
    r = legacy.flatten_tec(crawl.older_records(landed, sites)).filter("api_id = '1'").first()
    assert (r["organization"], r["title"], r["description"], r["location"], r["organizer_name"], r["image_url"], r["categories"], r["all_day"]) == ("A", "T1", "d", "Hall, Town", "O", "i", ["c"], False)


def test_remote_sql(spark, tmp_path):
    db = sqlite3.connect(":memory:")
    db.executescript("""
        create table services(id, name, description, description_short, category_name, service_type, visitors_can_view, deleted_at);
        insert into services values (1, ' Robots ', '<p>Build</p>', 's', 'Code', 'Course', 1, null), (2, 'Teacher Day', '', '', '', 'Course', 1, null), (3, 'Hidden', '', '', null, 'Course', 0, null),
          (4, 'Staffed', '', 'x', 'Staff', 'GroupClass', 1, null), (5, 'Past', '', '', null, 'Course', 1, null), (6, 'Python', ' ', 'short', null, 'GroupClass', 1, null);
        create table event_occurrences(id, service_id, start_at, end_at, location_id, state, deleted_at);
        insert into event_occurrences values (10, 1, '2999-02-01T10:00:00Z', null, 7, 'active', null), (11, 1, '2999-01-01T10:00:00Z', '2999-01-01T11:00:00Z', 7, 'active', null), (12, 1, '2998-01-01T10:00:00Z', null, 7, 'canceled', null),
          (13, 2, '2999-01-01T10:00:00Z', null, 7, 'active', null), (14, 4, '2999-01-01T10:00:00Z', null, 7, 'active', null), (15, 5, '2000-01-01T10:00:00Z', null, 7, 'active', null), (16, 6, '2999-03-01T10:00:00Z', null, 99, 'active', null);
        create table locations(id, name, city, latitude, longitude, formatted_address, timezone);
        insert into locations values (7, 'Lab', 'Town', 1.5, 2.5, 'Long Street', 'z');
        create table meetup_events(id, title, description, date_time, event_url, featured_photo_url, venue_id, status, deleted_at);
        insert into meetup_events values ('m1', 'Club', ' d ', '2999-01-01T10:00:00-07:00', 'http://m', '', 5, 'ACTIVE', null), ('m2', 'Gone', '', '2999-01-01T10:00:00-07:00', '', '', 5, 'CANCELLED', null);
        create table meetup_venues(id, name, address, city, state, lat, lon);
        insert into meetup_venues values (5, 'Pub', 'Road', 'Town', 'S', 3.5, 4.5);
    """)
    db.row_factory = sqlite3.Row
    reg = tmp_path / "reg"
    reg.mkdir()
    (reg / "r.toml").write_text('org_name = "R"\nadapter_type = "remote_sql"\n[config]\napi_base = "http://db.org/"\nregistration_url = "http://sign.up"\n')
    sources = registry.load_sources(spark, str(reg))
    refs = feeds.remote_refs(sources, key="k").orderBy("page_seq").collect()
    assert [r["url"].split("sql=")[0] for r in refs] == ["http://db.org/query?"] * 2 and refs[0]["headers"] == {"Authorization": "Bearer k"}
    # The queries as they are sent, answered by a database that speaks their dialect.
    answers = {r["url"]: R(200, json.dumps([dict(x) for x in db.execute(unquote(r["url"].split("sql=")[1]))])) for r in refs}
    assert main(["fetch-remote", "--registry-dir", str(reg), "--output-dir", str(tmp_path / "pages")], make_fetcher=memory(answers)) == 0
    landed = spark.read.parquet(str(tmp_path / "pages"))
    assert "Bearer" not in str(landed.collect())
    got = {r["title"]: r for r in pipeline.acquire(landed, sources).collect()}
    assert set(got) == {"Robots", "Python", "Club"} and all(r["trusted"] for r in got.values())
    r, p, c = got["Robots"], got["Python"], got["Club"]
    assert (r["external_id"], r["description"], r["start"], r["location"], r["latitude"], r["categories"], r["registration_url"]) == ("1", "Build", datetime(2999, 1, 1, 10), "Lab, Town", 1.5, ["Code"], "http://sign.up")
    assert (p["description"], p["location"], p["latitude"]) == ("short", "", None) and "registration_url" in r["field_provenance"]
    assert (c["external_id"], c["description"], c["location"], c["registration_url"], c["cost"]) == ("m1", "d", "Pub, Town", "http://m", "")


def test_reporter_and_client(spark, tmp_path):
    (tmp_path / "a.toml").write_text('org_name = "Alpha"\nadapter_type = "tec_rest"\n[acquisition_policy]\nmax_urls = 1\n')
    sources = registry.load_sources(spark, str(tmp_path))
    partners = registry.first_partners(spark.createDataFrame([(1, "Alpha", "", "", "", None, None, "", "", 0)], "id long, name string, organization_type string, description string, location string, latitude double, longitude double, website string, logo_src string, seq long"))
    told, reporter = [], observe.YieldReporter()
    fields = enrich.reply_schema()["required"]
    reply = json.dumps(dict.fromkeys(fields) | {"areas_of_interest": ["Math"], "age_grade_level": [], "cost_range": "Free", "time_of_day": [], "relevant": True, "relevance_reason": "r", "all_day": True})

    def client(record):
        assert set(record) == set(enrich.ASKED) and record["start"] == "2026-08-01T19:00:00" and record["registration_url"] is None
        return reply

    landed = pages(spark, ("a", "u", TEC), ("a", "u", TEC))
    got = pipeline.run(landed, sources, partners, date(2026, 7, 19), client=client, reporter=reporter)
    assert got.opportunities.first()["areas_of_interest"] == ["Math"] and not told
    assert [(r["source_id"], r["found"], r["new"]) for r in reporter.report().collect()] == [("a", 1, 1)]


def test_replies():
    full = dict.fromkeys(enrich.RECOVERED) | {"areas_of_interest": [], "age_grade_level": [], "cost_range": "", "time_of_day": [], "relevant": True, "relevance_reason": ""}
    valid = lambda **k: enrich.valid_reply(json.dumps(full | k)) is not None
    assert valid() and valid(start="2026-01-01T10:00:00") and valid(all_day=False)
    assert not any((valid(start="soon"), valid(all_day="no"), valid(relevant=None), valid(areas_of_interest="Math"), valid(time_of_day=[1]), valid(cost=5)))
    assert all(enrich.valid_reply(json.dumps({k: v for k, v in full.items() if k != f})) is None for f in full) and enrich.valid_reply("[]") is None
    assert set(enrich.reply_schema()["properties"]) == set(full) and all(v in enrich.instructions() for values in enrich.VOCABULARY.values() for v in values)
    assert json.loads(enrich.question({"title": "é"})) == {"title": "é"}


def test_store_buckets(spark, tmp_path):
    store, day = state.EventStore(spark, str(tmp_path / "s"), buckets=4), lambda d: datetime(2026, 7, d)
    assert store.all_events() is None and store.count() == 0 and store.prune(today=date(2026, 7, 1)) == 0
    store.upsert(events(spark, *({"title": f"T{n}", "start": day(1)} for n in range(40))), day(1))
    first = store._places()[1]
    assert set(first) == set(range(4)) and store.count() == 40
    was = store.all_events()
    store.upsert(events(spark, {"title": "T0", "start": day(1), "description": "new"}), day(2))
    second = store._places()[1]
    assert sum(first[b] != second[b] for b in first) == 1 and store.count() == 40 and was.count() == 40
    # The number of buckets stays; a run that failed before it named its buckets leaves nothing behind that counts.
    again = state.EventStore(spark, str(tmp_path / "s"), buckets=7)
    (tmp_path / "s" / "data3").mkdir()
    (tmp_path / "s" / "data3" / "junk").write_text("x")
    again.upsert(events(spark, {"title": "new", "start": day(5)}), day(3))
    assert again.count() == 41 and set(again._places()[1]) == set(range(4))
    again.upsert(events(spark).limit(0), day(4))
    assert again.count() == 41
    assert again.prune(cutoff=day(9)) == 41 and again.count() == 0 and again.all_events().columns == was.columns
    again.upsert(events(spark, {"title": "T0", "start": day(1)}), day(9))
    assert [(r["title"], r["first_seen"].day) for r in again.all_events().collect()] == [("T0", 9)]


def test_mirror_and_older_commands(spark, tmp_path, capsys):
    (tmp_path / "p.csv").write_text("name,website\nA,https://a.org\nB,ftp://b.org\nC,https://c.org\n")
    args = ["mirror", "--csv", str(tmp_path / "p.csv"), "--output-dir", str(tmp_path / "m"), "--limit", "1"]
    fast = {k: R(200, "<p>x</p>") if k != "https://a.org/robots.txt" else R(404) for k in ("https://a.org", "https://a.org/robots.txt")}
    assert main(args, make_fetcher=memory(fast)) == 0 and main([*args, "--resume"], make_fetcher=memory({})) == 0
    assert capsys.readouterr().out == "a.org: 1 pages\n"
    with pytest.raises(SystemExit):
        main(["mirror", "--output-dir", str(tmp_path / "m")])
    rows = [(n, "Zoo", "Shark Night", "", d, "", "7:00 pm", "", "$5", "", "", "http://p", False, 1) for n, d in enumerate(("2026-08-01", "2026-08-01", "2020-01-01"))]
    r = spark.createDataFrame(rows, "seq long, org string, title string, description string, start_date string, end_date string, start_time string, end_time string, cost string, location string, registration_url string, page_url string, all_day boolean, repeat_count int")
    r.withColumn("categories", F.array().cast("array<string>")).withColumn("tags", F.array().cast("array<string>")).write.parquet(str(tmp_path / "r"))
    (tmp_path / "p.json").write_text(json.dumps([{"id": 1, "name": "Zoo"}]))
    args = ["export-older", "--records", str(tmp_path / "r"), "--partners", str(tmp_path / "p.json"), "--site-dir", str(tmp_path / "site"), "--today", "2026-07-19"]
    assert main([*args, "--dry-run"]) == 0 and not (tmp_path / "site").exists() and main(args) == 0
    assert [x["slug"] for x in json.loads((tmp_path / "site" / "opportunities.json").read_text())] == ["zoo_shark_night_20260801", "zoo_shark_night_20260801_2"]
