import hashlib
import html
import re
from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fairlead.functions import dates, identity, taxonomy, text


def values(spark, rows, expression, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema).select(expression).collect()]


def test_titles_and_names(spark):
    assert values(spark, ["  Star—Party!!  at\tNight_1 ", "ÉCOLE d'été", ""], text.normalize_title("x")) == ["starparty at night_1", "école dété", ""]
    assert values(spark, ["The  Fleet, Science Center!", "the zoo", "Theatre"], text.normalize_org_name("x")) == ["fleet science center", "zoo", "theatre"]
    assert values(spark, ["Ab--C d!", "!!!"], text.slugify("x")) == ["ab_c_d", ""]
    assert values(spark, ["Ab C", "!!"], text.candidate_slug("x")) == ["ab-c", "candidate"]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from(list("aÉß_ .,-!\t²½٣漢 ́")), max_size=12), min_size=1, max_size=20))
def test_titles_agree_with_a_plain_loop(spark, rows):
    def plain(t):
        kept = "".join(c for c in t.lower() if c.isspace() or c == "_" or c.isalpha() or c.isnumeric())
        return " ".join(kept.split())

    assert values(spark, rows, text.normalize_title("x")) == [plain(t) for t in rows]


def test_html(spark):
    assert values(spark, ["<p>A &amp;lt; B</p>\n<br>c&nbsp;d"], text.strip_html("x")) == ["A < B c d"]
    rows = ["Tom &amp; J&eacute;r&#244;me &#8217; &unknown;", "", None]
    assert values(spark, rows, text.unescape("x")) == [html.unescape(rows[0]), "", None]
    assert values(spark, ["Skip to content  Hi <b>you</b>"], text.clean_text("x")) == ["Hi you"]
    assert values(spark, ["Star Party | The Fleet", "a - b"], text.clean_title("x")) == ["Star Party", "a - b"]


def test_truncation(spark):
    assert values(spark, ["one two three", "one", None], text.truncate("x", 7)) == ["one…", "one", ""]
    long = "First sentence here. Second one follows and goes on"
    assert values(spark, [long], text.truncate_description("x", 30)) == ["First sentence here."]
    assert values(spark, ["word " * 30], text.truncate_description("x", 22)) == ["word word word word..."]


def test_urls(spark):
    assert values(spark, ["HTTPS://Www.A.org:8080/x", "nonsense", None], text.domain_of("x")) == ["www.a.org", "unknown", "unknown"]
    assert values(spark, [" https://A.org/Ev/2026-01-02/ "], text.clean_url("x")) == ["https://a.org/ev"]
    assert values(spark, [("http://a.org/x/", "../y?q=1")], text.url_join("x", "y"), "x string, y string") == ["http://a.org/y?q=1"]
    assert values(spark, ["a b+c"], text.url_encode("x")) == ["a%20b%2Bc"]
    assert values(spark, ["http://a.org/x/y.html?q=1", "http://a.org/"], identity.mirror_path("x")) == [f"x/y.html_{hashlib.sha256(b'q=1').hexdigest()[:8]}", "_index"]


def test_iso_times_keep_the_wall_clock(spark):
    rows = ["2026-08-15T09:00:00-07:00", "2026-08-15T17:00:00Z", "2026-08-15", "2026", "2026-8-5", "", None, "soon"]
    at = datetime(2026, 8, 15)
    assert values(spark, rows, dates.parse_iso("x")) == [at.replace(hour=9), at.replace(hour=17), at, None, None, None, None, None]
    assert values(spark, rows, dates.is_bad_date("x")) == [False, False, False, True, True, False, False, True]
    assert values(spark, [(at.replace(hour=9),), (None,)], dates.iso_text("x"), "x timestamp_ntz") == ["2026-08-15T09:00:00-07:00", ""]


def test_shown_dates(spark):
    assert values(spark, ["2026-08-15T00:00:00-07:00", "", None], dates.format_day("x")) == ["Sat, August 15, 2026", "Ongoing", "Ongoing"]
    assert values(spark, ["2026-08-15T00:00:00Z", "2026-08-14T10:00:00"], dates.is_weekend("x")) == [True, False]
    assert values(spark, ["2026-08-15T00:00:00Z", "2026-08-15T10:00:00Z", ""], dates.has_no_time("x")) == [True, False, False]
    assert values(spark, [("2026-01-02", "3:05 PM"), ("2026-01-02", ""), ("", "1:00 am")], dates.clock_to_iso("x", "y"), "x string, y string") == ["2026-01-02T15:05:00-07:00", "2026-01-02T12:00:00-07:00", ""]


def test_dates_in_prose(spark):
    rows = ["May 13, 2026", "Tuesdays, June 2 @ 4", "May 13 @ 3:00 pm", "May 9", "February 2026", "on 2026-03-04", "May 1 - June 2", "May 1 - 3", "May 40, 2026", "never"]
    assert [(r["start"], r["end"]) for r in values(spark, rows, dates.parse_date_text("x"))] == [
        ("2026-05-13", ""), ("2026-06-02", ""), ("2026-05-13", ""), ("2026-05-09", ""), ("2026-02-01", ""), ("2026-03-04", ""),
        ("2026-05-01", "2026-06-02"), ("2026-05-01", "2026-05-03"), ("", ""), ("", ""),
    ]


def test_keyword_rules(spark):
    assert values(spark, ["Robot shark camp", "nothing", "LAGOON Coding"], taxonomy.areas_of_interest("x")) == [
        ["Biology / LifeSciences", "Coding/Computer Science/Cyber Security"], ["General Science"], ["Earth Science/Ecology", "Coding/Computer Science/Cyber Security"],
    ]
    assert values(spark, ["Beach cleanup online", "Webinar", "Bird Walk at Grant Park", "érobot"], taxonomy.opportunity_type("x")) == ["Volunteering", "Online", "Out-of-school Programs", "Out-of-school Programs"]
    assert values(spark, ["Teen and family night", "adults"], taxonomy.age_grade_level("x")) == [["Family", "Grades 9-12"], []]


def test_costs(spark):
    rows = ["", "FREE!", "$0.00", "$ 24.99", "$25", "$5 or $300", "$200", "$1,200", "Included", "x" * 41, None]
    assert values(spark, rows, taxonomy.cost_range("x")) == ["", "Free", "Free", "Less than $25", "Less than $50", "Less than $25", "Greater than $200", "Less than $25", "Included", "", ""]


def test_postings(spark):
    rows = [("Software Intern, PhD", "", "R&D", "San Diego, CA"), ("International Engineer", "", "", "San Diego"), ("Data Scientist", "Internship", "", "san diego"), ("Robotics Intern", "", "", "Remote")]
    got = values(spark, rows, taxonomy.classify_posting("a", "b", "c", "d"), "a string, b string, c string, d string")
    assert [g and g["age_grade_level"] for g in got] == [["Grades 9-12", "Undergraduate", "Graduate"], None, ["Grades 9-12", "Undergraduate"], None]


def test_relevance(spark):
    rows = [("Robotics coding for kids", "", "x", ""), ("Wine gala auction", "science", "x", ""), ("", "", "in", ""), ("", "", "out", "")]
    got = values(spark, rows, taxonomy.relevance("a", "b", "c", F.lit(""), F.lit(""), "d", ["in"], ["out"]), "a string, b string, c string, d string")
    assert [(g["relevant"], round(g["score"], 2), g["reason"]) for g in got] == [(True, 0.75, "stem_strong=2,youth=1"), (False, 0.0, "stem_strong=1,noise=3"), (True, 1.0, "stem_org"), (False, 0.0, "not_relevant_org")]


def test_site_rules(spark):
    assert values(spark, ["tribe_events-1.xml", "Course.xml", "my-blog.xml", "x.xml", "sitemap_index.xml"], taxonomy.sitemap_kind("x")) == ["event", "program", "post", "other", "index"]
    assert values(spark, [("/camp/1", ""), ("", "Lesson"), ("", "x")], taxonomy.event_kind("x", "y"), "x string, y string") == ["camp", "class", "event"]
    assert values(spark, [("<link wp-content>", "a.org"), ("WIX.com", "a"), (None, "a"), ("", "sites.google.com")], taxonomy.platform("x", "y"), "x string, y string") == ["wordpress", "wix", "unknown", "google_sites"]


def test_identity(spark):
    rows = [("s", "7", "T", datetime(2026, 1, 2)), ("s", "", "A  b!", datetime(2026, 1, 2)), ("s", "", "A b", None)]
    got = values(spark, rows, identity.identity_hash(), "source_id string, external_id string, title string, start timestamp_ntz")
    assert got == [hashlib.sha256(k).hexdigest() for k in (b"s|7", b"s|a b|2026-01-02", b"s|a b|None")]


def test_time_of_day(spark):
    rows = [(datetime(2026, 1, 1, h), False) for h in (11, 12, 17)] + [(None, False), (None, True)]
    assert values(spark, rows, taxonomy.time_of_day("x", "y"), "x timestamp_ntz, y boolean") == [["Morning"], ["Afternoon"], ["Evening"], [], ["All Day"]]


def test_plain_regex_shapes():
    assert re.search(taxonomy.INTERNSHIP, "International", re.I) is None
    assert date(2026, 8, 15).isoweekday() == 6
