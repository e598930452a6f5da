import json
from datetime import date

from pyspark.sql import functions as F

from fairlead.__main__ import main
from fairlead.functions import markup
from fairlead.operators import legacy
from fairlead.sources import registry, site_pages
from tests.test_engine import ICS, TEC


def test_site_pages(spark):
    tribe = '<h1 class="entry-title">Star Night</h1><div class="tribe-events-schedule">May 13, 2026 @ 7</div><div class=tribe-venue>Hall</div><div class="entry-content">Come and see<script>x</script> the stars</div><a href="/r">Register now</a>'
    rows = [
        ("O", "a.org", "wordpress", "tribe_events_calendar", "http://a.org/event/x", tribe, "sitemap"), ("O", "b.org", "other", "none", "http://b.org/camp/2026-04-22/", "<title>Camp - Site</title>", "dir"),
        ("O", "c.org", "wix", "none", "http://c.org/x", '<meta property="og:title" content="Walk"><meta property="article:modified_time" content="2026-01-02T03:04">', "dir"), ("O", "d.org", "other", "none", "http://d.org/tag/x", "<h1>Tag page</h1>", "dir"),
    ]
    df = spark.createDataFrame(rows, "organization string, domain string, platform string, plugin string, url string, html string, source_method string")
    got = {r["domain"]: r for r in site_pages.extract_pages(df).collect()}
    assert set(got) == {"a.org", "b.org", "c.org"}
    a = got["a.org"]
    assert (a["title"], a["start_date"], a["venue"], a["description"], a["registration_url"], a["event_type"], round(a["confidence"], 2)) == ("Star Night", "2026-05-13", "Hall", "Come and see the stars", "/r", "event", 0.9)
    assert (got["b.org"]["title"], got["b.org"]["start_date"], got["b.org"]["event_type"]) == ("Camp", "2026-04-22", "camp")
    assert (got["c.org"]["start_date"], got["c.org"]["date_text"]) == ("2026-01-02", "modified:2026-01-02")


def test_descriptions(spark):
    rows = ["**Bold** and *soft* [x](http://a.org)\n\n- one\n- two", "&lt;p&gt;A &amp; B&lt;/p&gt;<script>bad()</script><a href='javascript:x'>c</a>", None]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = df.select(markup.description_html("t"), markup.description_text("t")).collect()
    assert got[0][0] == '<p><strong>Bold</strong> and <em>soft</em> <a href="http://a.org">x</a></p>\n<ul><li>one</li><li>two</li></ul>'
    assert got[0][1] == "Bold and soft x one two" and got[1][0] == "<p>A &amp; B</p><a>c</a>" and got[2][0] == ""


def test_older_opportunities(spark):
    partners = registry.first_partners(spark.createDataFrame([(7, "The Zoo", "Park", 1.0, 2.0, "l", 0)], "id bigint, name string, location string, latitude double, longitude double, logo_src string, seq bigint"))
    r = spark.createDataFrame([(1, "Zoo", "Shark Night", "", "2026-05-01", "2026-05-08", "7:00 pm", "", "$5", "", "", "http://p", False, 2)], "seq long, org string, title string, description string, start_date string, end_date string, start_time string, end_time string, cost string, location string, registration_url string, page_url string, all_day boolean, repeat_count int")
    r = r.withColumn("categories", F.array().cast("array<string>")).withColumn("tags", F.array().cast("array<string>"))
    got = legacy.build_opportunities(r, partners).first()
    assert (got["slug"], got["partner_id"], got["availability"], got["date_start"], got["time_of_day"], got["location"]) == ("zoo_shark_night_20260501", 7, "7:00 pm; Repeats 2 times through 2026-05-08", "2026-05-01T19:00:00-07:00", ["Evening"], "Park")


def test_command_line(spark, tmp_path, capsys):
    reg = tmp_path / "reg"
    reg.mkdir()
    (reg / "a.toml").write_text('org_name = "Alpha"\nadapter_type = "tec_rest"\n')
    (reg / "c.toml").write_text('org_name = "Gamma"\nadapter_type = "ical"\n')
    (tmp_path / "p.json").write_text(json.dumps([{"id": 1, "name": "Alpha"}]))
    spark.createDataFrame([("a", 0, "u", 200, TEC), ("c", 0, "u", 200, ICS)], "source_id string, page_seq bigint, url string, status int, body string").write.parquet(str(tmp_path / "pages"))
    args = ["run", "--pages", str(tmp_path / "pages"), "--registry-dir", str(reg), "--partners", str(tmp_path / "p.json"), "--site-dir", str(tmp_path / "site"), "--yield-history", str(tmp_path / "yield"), "--today", "2026-07-19"]
    assert main(args) == 0 and main(args) == 0
    assert "2 opportunities" in capsys.readouterr().out and date.today()
    assert len(json.loads((tmp_path / "site" / "opportunities.json").read_text())) == 2
