import datetime as dt
import json

from pyspark.sql import functions as F

from feedloom.sources import platforms
from feedloom.streaming import ingest

UTC = dt.datetime(2026, 3, 7, 3, 29, 6)


def page(spark, source, payload):
    return spark.createDataFrame([(1, source, f"{source}:x", payload if isinstance(payload, str) else json.dumps(payload))], "page_id long, source string, board_id string, payload string")


PAYLOADS = {
    "greenhouse": {"jobs": [{"id": 1, "title": " A  b ", "absolute_url": "https://x.example/1", "first_published": "2026-03-06T20:29:06-07:00", "company_name": "C", "location": {"name": "Rome"}}]},
    "lever": [{"id": "1", "text": "A b", "hostedUrl": "https://x.example/1", "createdAt": 1772854146000, "categories": {"location": "Rome"}}],
    "himalayas": {"jobs": [{"guid": "1", "title": "A b", "applicationLink": "https://x.example/1", "pubDate": 1772854146, "locationRestrictions": ["Rome", "Rome", ""]}]},
    "ashby": {"jobs": [{"id": "1", "title": "A b", "jobUrl": "https://x.example/1", "publishedAt": "2026-03-07T03:29:06Z", "location": "Rome", "secondaryLocations": [{"location": "Rome"}]}]},
    "remoteok": [{"legal": "notice"}, {"id": "1", "position": "A b", "url": "https://x.example/1", "date": "2026-03-07T03:29:06+00:00", "location": "Rome"}],
    "startupjobs": {"data": [{"id": 1, "title": "A b", "url": "https://x.example/1", "published_at": "2026-03-07T03:29:06Z", "location": {"city": "Rome", "state": "", "country": None}}]},
}


def test_one_shape_for_all(spark):
    for source, payload in PAYLOADS.items():
        (r,) = platforms.parse(page(spark, source, payload), source).collect()
        assert (r["external_id"], r["title"], r["url"], r["published_at"], r["location"], r["problem"]) == ("1", "A b", "https://x.example/1", UTC, "Rome", None), source


def test_problems_are_kept(spark):
    good = PAYLOADS["greenhouse"]["jobs"][0]
    jobs = [7, None, {**good, "id": None}, {**good, "title": " "}, {**good, "absolute_url": "/1"}, {**good, "first_published": "2026-03-06"}, {**good, "first_published": None}]
    got = [r["problem"] for r in platforms.parse(page(spark, "greenhouse", {"jobs": jobs}), "greenhouse").orderBy("pos").collect()]
    assert got == ["not an object", "not an object", "no id", "no title", "url not absolute", "unreadable date", None]
    assert platforms.parse(page(spark, "greenhouse", "{broken"), "greenhouse").count() == 0


def test_workable_day_and_alias(spark):
    boards = spark.createDataFrame([("workable:x", "Own Name")], "board_id string, employer_alias string")
    (r,) = platforms.parse(page(spark, "workable", {"jobs": [{"shortcode": "q", "title": "t", "url": "http://x.example", "published_on": "2026-03-07", "city": "Rome", "telecommuting": True}]}), "workable", boards).collect()
    assert (r["employer"], r["published_at"], r["location"], r["workplace"]) == ("Own Name", dt.datetime(2026, 3, 7), "Rome", "remote")


def test_rss_and_atom(spark):
    rss = "<rss><channel><item><title>Acme: Cook</title><link>https://x.example/j/9</link><guid>https://x.example/j/9/</guid><pubDate>Fri, 06 Mar 2026 20:29:06 -0700</pubDate><region>Anywhere</region></item><item><title>Chef</title><link>https://x.example/j/10</link></item></channel></rss>"
    a, b = platforms.parse_rss(page(spark, "weworkremotely", rss)).orderBy("pos").collect()
    assert (a["external_id"], a["employer"], a["title"], a["published_at"], a["location"]) == ("9", "Acme", "Cook", UTC, "Anywhere")
    assert (b["external_id"], b["employer"], b["title"]) == ("10", None, "Chef")
    atom = '<feed><entry><title>Cook</title><link href="https://x.example/1"/><published>2026-03-07T03:29:06Z</published><location>Rome</location></entry></feed>'
    (e,) = platforms.parse_atom(page(spark, "hasjob", atom)).collect()
    assert (e["title"], e["url"], e["published_at"], e["location"]) == ("Cook", "https://x.example/1", UTC, "Rome")


def test_thread(spark):
    thread = {"id": 1, "children": [{"id": 2, "text": "Acme | Cook | <i>Remote</i><p>More | text"}, {"id": 3, "text": None}]}
    (r,) = platforms.parse_thread(page(spark, "hackernews", thread)).collect()
    assert (r["external_id"], r["employer"], r["title"], r["workplace"]) == ("2", "Acme", "Cook", "remote")


def test_streams(spark):
    df = spark.createDataFrame([("a", dt.datetime(2026, 1, 2)), ("a", dt.datetime(2026, 1, 1)), ("b", None)], "k string, t timestamp")
    got = {r["k"]: (r["first_seen"], r["last_seen"], r["times"]) for r in ingest.seen_states(df, "k", "t").collect()}
    assert got == {"a": (dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2), 2), "b": (None, None, 1)}
    assert ingest.delta_layer(df, "k").count() == 2
    late = df.withColumn("seen", F.lit(dt.datetime(2026, 1, 9)))
    assert ingest.late_split(late, "seen", "t", 7).where("late").count() == 1
