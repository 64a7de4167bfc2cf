"""A query for each kind of feed over a small invented payload of its shape, with SQL that reads the same payload.

The given tables hold raw pages of three platforms; the other shapes come only as payloads, so theirs stand here.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import text as T
from feedloom.sources import config, platforms

_U = "https://jobs.example/"
_GOOD_DATE = "2026-03-06T20:29:06-07:00"

#: Invented payloads; each holds a whole record, one with gaps, one that repeats or is odd, and one that is no posting.
PAYLOADS: dict[str, object] = {
    "greenhouse": {"jobs": [
        {"id": 1, "title": " Cook,  Junior", "absolute_url": _U + "1", "first_published": _GOOD_DATE, "company_name": "Alba Foods", "location": {"name": "Rome"}, "application_deadline": {"date": "2026-04-01"}, "offices": [{"location": "Rome, Italy"}, {"location": None}, {"location": "Bari, Italy"}], "metadata": [{"name": "Country", "value": ["IT", "SM"]}, {"name": "Work Type", "value": "Hybrid"}, {"name": "Job type", "value": "Late"}], "content": "<p>Stir</p>"},
        {"id": 2, "title": "Chef", "absolute_url": _U + "2", "first_published": None, "company_name": None, "location": None, "application_deadline": "2026-05-01T00:00:00Z", "offices": [], "metadata": None, "content": " "},
        {"id": 3, "title": None, "absolute_url": _U + "3"}, {"id": 4, "title": "Baker", "absolute_url": "/4"}, {"id": 5, "title": "Baker", "absolute_url": _U + "5", "first_published": "2026-03-06"}]},
    "lever": [
        {"id": "a", "text": "Cook", "hostedUrl": _U + "a", "createdAt": 1772854146123, "categories": {"location": "Rome"}, "country": "it", "workplaceType": "hybrid", "description": "<p>Stir</p>", "lists": [{"text": "You", "content": "<li>cook</li>"}, {"text": "", "content": "<li>bake</li>"}], "additional": "Bye"},
        {"id": "b", "text": "Chef", "hostedUrl": _U + "b", "createdAt": 17, "categories": {}, "lists": []}, {"id": "c", "text": "Baker", "hostedUrl": _U + "c", "createdAt": None}],
    "himalayas": {"jobs": [
        {"guid": _U + "h1", "title": "Cook", "applicationLink": _U + "h1", "pubDate": 1772854146, "expiryDate": 1775000000, "companyName": "Alba Foods", "locationRestrictions": ["Italy", "Malta"], "seniority": ["Senior", "Senior"], "description": "Stir"},
        {"guid": "h2", "title": "Chef", "applicationLink": _U + "h2", "pubDate": True, "companyName": "Alba Foods", "locationRestrictions": [], "seniority": []},
        {"guid": "h3", "title": "Baker", "applicationLink": _U + "h3", "pubDate": None, "companyName": "Bolo", "locationRestrictions": None}]},
    "manatal": {"count": 3, "results": [
        {"id": 7, "position_name": "Cook", "location_display": "Rome, Italy", "city": "Rome", "country": "Italy", "description": "Stir"}, {"id": 8, "position_name": "Chef", "location_display": "", "city": "Bari", "state": "", "country": "Italy"},
        {"id": 7, "position_name": "Cook again", "location_display": "Rome"}]},
    "workable": {"name": "Alba Foods", "jobs": [
        {"shortcode": "W1", "title": "Cook", "url": _U + "w1", "published_on": "2026-03-06", "city": "Rome", "state": "Lazio", "country": "Italy", "locations": [{"countryCode": "IT"}, {"countryCode": "IT"}, {"countryCode": "SM"}], "telecommuting": True, "experience": "Mid", "description": "Stir"},
        {"shortcode": "W2", "title": "Chef", "url": _U + "w2", "published_on": "2026-3-6", "city": "", "country": "Italy", "locations": [], "telecommuting": "true", "experience": ""}]},
    "smartrecruiters": {"content": [
        {"id": "s1", "name": "Cook", "releasedDate": "2026-03-07T03:29:06.123Z", "company": {"identifier": "alba", "name": "Alba Foods"}, "location": {"fullLocation": "Rome,, Rome, Italy", "remote": True}, "experienceLevel": {"label": "Associate"}},
        {"id": "s2", "name": "Chef", "releasedDate": "2026-03-07T03:29:06", "company": {"name": "Alba Foods"}, "location": {"fullLocation": "", "city": "Bari", "hybrid": True}}, {"id": "s3", "name": "Baker", "company": {}, "location": {}}]},
    "ashby": {"jobs": [
        {"id": "y1", "title": "Cook", "jobUrl": _U + "y1", "publishedAt": "2026-03-07T03:29:06.000+00:00", "location": "Rome", "address": {"postalAddress": {"addressCountry": "Italy"}}, "secondaryLocations": [{"location": "Rome", "address": {"postalAddress": {"addressCountry": "Italy"}}}, {"location": "Lyon", "address": {"postalAddress": {"addressCountry": "France"}}}], "workplaceType": "Hybrid", "descriptionHtml": "Stir"},
        {"id": "y2", "title": "Chef", "jobUrl": _U + "y2", "publishedAt": None, "location": "Bari", "secondaryLocations": [], "workplaceType": None}]},
    "hnjobs": {"hits": [
        {"objectID": "11", "title": "Alba Foods (YC S21) is hiring cooks in Rome", "url": _U + "11", "created_at": "2026-03-07T03:29:06Z", "story_text": "Stir"}, {"objectID": "12", "title": "Bolo Hiring Bakers", "url": _U + "12", "created_at": "2026-03-07T03:29:06Z"},
        {"objectID": "13", "title": "Launch HN: Cibo", "url": _U + "13", "created_at": "2026-03-07 03:29"}]},
    "jobicy": {"jobs": [
        {"id": 21, "jobTitle": "Cook", "url": _U + "21", "pubDate": "2026-03-07T03:29:06+00:00", "companyName": "Alba Foods", "jobGeo": "Italy", "jobLevel": "Any", "jobDescription": "Stir"}, {"id": 22, "jobTitle": "Chef", "url": _U + "22", "pubDate": "2026-03-07T03:29:06+00:00", "companyName": "Bolo", "jobGeo": "", "jobLevel": "Senior"}]},
    "remoteok": [{"legal": "terms"}, {"id": "31", "position": "Cook", "url": _U + "31", "date": "2026-03-07T03:29:06+00:00", "company": "Alba Foods", "location": "Rome", "description": "Stir"}, {"id": "32", "position": "", "url": _U + "32", "date": "2026-03-07T03:29:06+00:00", "company": "Bolo"}],
    "startupjobs": {"data": [
        {"id": 41, "title": "Cook", "url": _U + "41", "published_at": "2026-03-07T03:29:06Z", "company": {"name": "Alba Foods"}, "location": {"city": "Rome", "state": "", "country": "Italy"}, "workplace_type": "remote", "description_html": "Stir"},
        {"id": 42, "title": "Chef", "url": _U + "42", "published_at": "soon", "company": {}, "location": None, "workplace_type": ""}]},
    "weworkremotely": f"<rss><channel><item><title>Alba Foods: Cook: Rome</title><link>{_U}r/alba-cook</link><guid>{_U}r/alba-cook/</guid><pubDate>Fri, 06 Mar 2026 20:29:06 -0700</pubDate><region>Anywhere</region><country>Italy, Malta</country></item><item><title>Chef</title><link>{_U}r/chef</link><pubDate>soon</pubDate><region>Europe Only</region></item></channel></rss>",
    "hasjob": f'<feed><entry><title>Cook</title><link href="{_U}h/x1"/><published>2026-03-07T03:29:06Z</published><location>Rome</location><content>&lt;p&gt;&lt;strong&gt;&lt;a href="x"&gt;Alba Foods&lt;/a&gt;&lt;/strong&gt;&lt;/p&gt;</content></entry><entry><title>Chef</title><link href="/h/x2"/><published>2026-03-07</published><location> </location><content>none</content></entry></feed>',
    "pythonorg": f"<rss><channel><item><title>Cook, Alba Foods, Inc.</title><link>{_U}jobs/51/</link><description>Rome, Italy\nStir</description></item><item><title>Chef, Senior, Bolo</title><link>{_U}jobs/52</link><description>Bari</description></item><item><title>Baker</title><link>{_U}jobs/none/</link></item></channel></rss>",
    "hackernews": {"id": 1, "title": "Ask HN: Who is hiring?", "children": [
        {"id": 61, "text": "Alba Foods (https://alba.example) | Cook | Rome | <b>Remote</b><p>More | text"}, {"id": 62, "text": "Bolo - bakers wanted, no remote, on-site"}, {"id": 63, "text": None}, {"id": 64, "text": "Cibo &amp; Co | Waiter | Hybrid<br>x"}]},
    "stories": {"hits": [{"objectID": "71", "title": "Ask HN: Who is hiring? (March)", "created_at_i": 5}, {"objectID": "72", "title": "Ask HN: Who is hiring? (April)", "created_at_i": 9}, {"objectID": "73", "title": "Ask HN: Who wants to be hired?", "created_at_i": 11}]},
}
#: Details of smartrecruiters postings.
DETAILS = [("smartrecruiters:x", "s1", {"postingUrl": _U + "s1-cook", "jobAd": {"sections": {"jobDescription": {"text": "Stir"}, "qualifications": {"text": ""}, "companyDescription": {"text": "Alba"}}}}), ("smartrecruiters:x", "s3", {"jobAd": {"sections": {}}})]
ALIASES = [("lever:x", "Alba Foods"), ("ashby:x", "Bolo")]

_Q: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        _Q[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _text(source: str) -> str:
    payload = PAYLOADS[source]
    return payload if isinstance(payload, str) else json.dumps(payload)


def page(spark: SparkSession, source: str) -> DataFrame:
    return spark.createDataFrame([(1, source, f"{source}:x", _text(source))], "page_id long, source string, board_id string, payload string")


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# ---- JSON platforms: one form of result, one form of SQL

def _x(path: str) -> str:
    return f"nullif(trim(regexp_replace(json_extract_string(p, '{path}'), '\\s+', ' ', 'g')), '')"


def _each(path: str, inner: str = "$", distinct: bool = True) -> str:
    items = f"list_filter(list_transform(CAST(json_extract(p, '{path}') AS JSON[]), lambda x: trim(json_extract_string(x, '{inner}'))), lambda x: x <> '')"
    # list_distinct keeps no order: the first place of each text does
    return f"list_filter({items}, lambda x, i: list_position({items}, x) = i)" if distinct else items


def _texts(items: str, by: str = "; ") -> str:
    return f"nullif(array_to_string({items}, '{by}'), '')"


_NONE = "CAST(NULL AS VARCHAR)"
_ISO = r"'^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})$'"


def _iso(path: str) -> str:
    return f"CASE WHEN regexp_matches(json_extract_string(p, '{path}'), {_ISO}) THEN epoch_us(CAST(json_extract_string(p, '{path}') AS TIMESTAMPTZ)) END"


def _epoch(path: str, low: int, high: int, times: int) -> str:
    return f"CASE WHEN json_type(p, '{path}') IN ('UBIGINT', 'BIGINT') AND CAST(json_extract_string(p, '{path}') AS BIGINT) BETWEEN {low} AND {high} THEN CAST(json_extract_string(p, '{path}') AS BIGINT) * {times} END"


#: source: (path of its records, columns in SQL over a record p, raw date path)
_SHAPES: dict[str, tuple[str, dict[str, str], str]] = {
    "greenhouse": ("$.jobs", {
        "title": _x("$.title"), "url": _x("$.absolute_url"), "employer": _x("$.company_name"), "published_us": _iso("$.first_published"), "location": _x("$.location.name"),
        "workplace": "list_filter(list_transform(list_filter(CAST(json_extract(p, '$.metadata') AS JSON[]), lambda x: lower(json_extract_string(x, '$.name')) IN ('work type', 'job type')), lambda x: json_extract_string(x, '$.value')), lambda x: x <> '')[1]",
        "places": f"nullif(concat_ws('; ', {_texts(_each('$.offices', '$.location'))}, (SELECT string_agg(trim(json_extract_string(v, '$')), '; ') FROM (SELECT unnest(CAST(json_extract(m, '$.value') AS JSON[])) AS v FROM (SELECT unnest(CAST(json_extract(p, '$.metadata') AS JSON[])) AS m) WHERE lower(json_extract_string(m, '$.name')) = 'country'))), '')",
        "expires_at": "CASE WHEN json_type(p, '$.application_deadline') = 'OBJECT' THEN json_extract_string(p, '$.application_deadline.date') ELSE json_extract_string(p, '$.application_deadline') END", "description": _x("$.content")}, "$.first_published"),
    "lever": ("$", {
        "title": _x("$.text"), "url": _x("$.hostedUrl"), "employer": "'Alba Foods'", "published_us": _epoch("$.createdAt", 1_000_000_000_000, 4_000_000_000_000, 1000), "location": _x("$.categories.location"), "workplace": _x("$.workplaceType"), "places": f"upper({_x('$.country')})",
        "description": "nullif(concat_ws(' / ', nullif(json_extract_string(p, '$.description'), ''), (SELECT string_agg(concat_ws(' / ', nullif(json_extract_string(l, '$.text'), ''), nullif(json_extract_string(l, '$.content'), '')), ' / ') FROM (SELECT unnest(CAST(json_extract(p, '$.lists') AS JSON[])) AS l)), nullif(json_extract_string(p, '$.additional'), '')), '')"}, "$.createdAt"),
    "himalayas": ("$.jobs", {
        "id": _x("$.guid"), "title": _x("$.title"), "url": _x("$.applicationLink"), "employer": _x("$.companyName"), "published_us": _epoch("$.pubDate", 1_000_000_000, 4_000_000_000, 1_000_000), "location": _texts(_each("$.locationRestrictions"), ", "), "workplace": "'remote'",
        "places": _texts(_each("$.locationRestrictions")), "levels": _texts(_each("$.seniority")), "expires_at": "strftime(to_timestamp(CAST(json_extract_string(p, '$.expiryDate') AS BIGINT)) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ')", "description": _x("$.description")}, "$.pubDate"),
    "manatal": ("$.results", {
        "title": _x("$.position_name"), "url": "'https://manatal.example/x/' || json_extract_string(p, '$.id')", "employer": _NONE, "location": f"coalesce({_x('$.location_display')}, nullif(concat_ws(', ', {_x('$.city')}, {_x('$.state')}, {_x('$.country')}), ''))", "description": _x("$.description")}, ""),
    "workable": ("$.jobs", {
        "id": _x("$.shortcode"), "title": _x("$.title"), "url": _x("$.url"), "employer": "json_extract_string(d, '$.name')", "published_us": "CASE WHEN regexp_matches(json_extract_string(p, '$.published_on'), '^\\d{4}-\\d{2}-\\d{2}$') THEN epoch_us(CAST(json_extract_string(p, '$.published_on') AS DATE)::TIMESTAMP) END",
        "location": f"nullif(concat_ws(', ', {_x('$.city')}, {_x('$.state')}, {_x('$.country')}), '')", "workplace": "CASE WHEN json_type(p, '$.telecommuting') = 'BOOLEAN' AND json_extract_string(p, '$.telecommuting') = 'true' THEN 'remote' END",
        "places": _texts(_each("$.locations", "$.countryCode")), "levels": _x("$.experience"), "description": _x("$.description")}, "$.published_on"),
    "smartrecruiters": ("$.content", {
        "title": _x("$.name"), "url": "'https://smartrecruiters.example/x/' || json_extract_string(p, '$.id')", "employer": _x("$.company.name"), "published_us": _iso("$.releasedDate"),
        "location": "coalesce(nullif((SELECT string_agg(v, ', ' ORDER BY i) FROM (SELECT v, min(i) AS i FROM (SELECT trim(unnest(string_split(json_extract_string(p, '$.location.fullLocation'), ','))) AS v, generate_subscripts(string_split(json_extract_string(p, '$.location.fullLocation'), ','), 1) AS i) WHERE v <> '' GROUP BY v)), ''), " + _x("$.location.city") + ")",
        "workplace": "CASE WHEN json_extract_string(p, '$.location.remote') = 'true' THEN 'remote' WHEN json_extract_string(p, '$.location.hybrid') = 'true' THEN 'hybrid' END", "levels": _x("$.experienceLevel.label")}, "$.releasedDate"),
    "ashby": ("$.jobs", {
        "title": _x("$.title"), "url": _x("$.jobUrl"), "employer": "'Bolo'", "published_us": _iso("$.publishedAt"), "location": "(SELECT string_agg(v, '; ' ORDER BY i) FROM (SELECT v, min(i) AS i FROM (SELECT json_extract_string(p, '$.location') AS v, 0 AS i UNION ALL SELECT trim(json_extract_string(s, '$.location')), n FROM (SELECT unnest(CAST(json_extract(p, '$.secondaryLocations') AS JSON[])) AS s, generate_subscripts(CAST(json_extract(p, '$.secondaryLocations') AS JSON[]), 1) AS n)) GROUP BY v))",
        "workplace": _x("$.workplaceType"), "places": "(SELECT string_agg(v, '; ' ORDER BY i) FROM (SELECT v, min(i) AS i FROM (SELECT json_extract_string(p, '$.address.postalAddress.addressCountry') AS v, 0 AS i UNION ALL SELECT json_extract_string(s, '$.address.postalAddress.addressCountry'), n FROM (SELECT unnest(CAST(json_extract(p, '$.secondaryLocations') AS JSON[])) AS s, generate_subscripts(CAST(json_extract(p, '$.secondaryLocations') AS JSON[]), 1) AS n)) WHERE v IS NOT NULL GROUP BY v))", "description": _x("$.descriptionHtml")}, "$.publishedAt"),
    "hnjobs": ("$.hits", {
        "id": _x("$.objectID"), "title": _x("$.title"), "url": _x("$.url"), "employer": "nullif(regexp_extract(regexp_replace(json_extract_string(p, '$.title'), ' \\(YC S21\\)', ''), '(?i)^(.*?)\\s+(is\\s+)?hiring', 1), '')", "published_us": _iso("$.created_at"), "description": _x("$.story_text")}, "$.created_at"),
    "jobicy": ("$.jobs", {
        "title": _x("$.jobTitle"), "url": _x("$.url"), "employer": _x("$.companyName"), "published_us": _iso("$.pubDate"), "location": _x("$.jobGeo"), "workplace": "'remote'", "levels": f"CASE WHEN lower({_x('$.jobLevel')}) <> 'any' THEN {_x('$.jobLevel')} END", "description": _x("$.jobDescription")}, "$.pubDate"),
    "remoteok": ("$", {"title": _x("$.position"), "url": _x("$.url"), "employer": _x("$.company"), "published_us": _iso("$.date"), "location": _x("$.location"), "workplace": "'remote'", "description": _x("$.description")}, "$.date"),
    "startupjobs": ("$.data", {
        "title": _x("$.title"), "url": _x("$.url"), "employer": _x("$.company.name"), "published_us": _iso("$.published_at"), "location": f"nullif(concat_ws(', ', {_x('$.location.city')}, {_x('$.location.state')}, {_x('$.location.country')}), '')", "workplace": _x("$.workplace_type"), "description": _x("$.description_html")}, "$.published_at"),
}
_COLUMNS = ("title", "url", "employer", "location", "workplace", "places", "levels", "expires_at", "description")


def _shape_sql(source: str) -> str:
    path, columns, dated = _SHAPES[source]
    told = ", ".join(f"{columns.get(c, _NONE)} AS {c}" for c in _COLUMNS)
    raw = f"json_extract_string(p, '{dated}')" if dated else _NONE
    rows = f"SELECT i AS pos, {columns.get('id', _x('$.id'))} AS external_id, {told}, CAST({columns.get('published_us', 'NULL')} AS BIGINT) AS published_us, {raw} AS raw FROM (SELECT d, unnest(CAST(json_extract(d, '{path}') AS JSON[])) AS p, generate_subscripts(CAST(json_extract(d, '{path}') AS JSON[]), 1) - 1 AS i FROM (SELECT {_sql_text(_text(source))}::JSON AS d)) WHERE json_type(p, '$.legal') IS NULL"
    one = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY external_id ORDER BY pos) AS rn FROM ({rows})) WHERE rn = 1" if source == "manatal" else rows
    return f"SELECT external_id, {', '.join(_COLUMNS)}, published_us, CASE WHEN external_id IS NULL THEN 'no id' WHEN title IS NULL THEN 'no title' WHEN NOT coalesce(regexp_matches(lower(url), '^https?://'), false) THEN 'url not absolute' WHEN raw IS NOT NULL AND published_us IS NULL THEN 'unreadable date' END AS problem FROM ({one})"


def _listed(rows: DataFrame) -> DataFrame:
    joined = lambda c, by: F.nullif(F.array_join(c, by), F.lit("")).alias(c)
    return rows.select("external_id", "title", "url", "employer", "location", "workplace", joined("places", "; "), joined("levels", "; "), "expires_at", joined("description", " / "), F.unix_micros("published_at").alias("published_us"), "problem")


def _feed(source: str) -> Callable:
    def run(spark: SparkSession, d: str) -> DataFrame:
        aliases = spark.createDataFrame(ALIASES, "board_id string, employer_alias string")
        return _listed(platforms.parse(page(spark, source), source, aliases))

    run.__name__ = f"feed_{source}"
    return run


for _source in _SHAPES:
    query(_shape_sql(_source))(_feed(_source))


# ---- details, XML, threads

def _rows_sql(columns: str, *rows: tuple) -> str:
    """The expected rows of an XML payload, which DuckDB can't parse, cut from its text by hand."""
    lit = lambda x: "NULL" if x is None else _sql_text(x) if isinstance(x, str) else str(x)
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS t({columns})"


_ITEM_SQL = "SELECT unnest(regexp_extract_all({text}, '(?s)<{tag}>(.*?)</{tag}>', 1)) AS i"


def _tag(name: str) -> str:
    return f"nullif(trim(regexp_extract(i, '(?s)<{name}>(.*?)</{name}>', 1)), '')"


@query(f"""SELECT regexp_extract(rtrim(coalesce({_tag('guid')}, {_tag('link')}), '/'), '[^/]+$') AS external_id, CASE WHEN contains({_tag('title')}, ': ') THEN split_part({_tag('title')}, ': ', 1) END AS employer,
CASE WHEN contains({_tag('title')}, ': ') THEN substr({_tag('title')}, instr({_tag('title')}, ': ') + 2) ELSE {_tag('title')} END AS title, {_tag('link')} AS url,
epoch_us(TRY_STRPTIME({_tag('pubDate')}, '%a, %d %b %Y %H:%M:%S %z')) AS published_us, coalesce(replace({_tag('country')}, ', ', '; '), {_tag('region')}) AS location FROM ({_ITEM_SQL.format(text=_sql_text(_text("weworkremotely")), tag="item")})""")
def feed_weworkremotely(spark, d):
    return platforms.parse_rss(page(spark, "weworkremotely")).select("external_id", "employer", "title", "url", F.unix_micros("published_at").alias("published_us"), "location")


@query(f"""SELECT regexp_extract(url, '[^/]+$') AS external_id, {_tag('title')} AS title, nullif(regexp_extract(i, '&lt;strong&gt;&lt;a [^&]*&gt;([^&]+)&lt;', 1), '') AS employer, url, CASE WHEN length({_tag('published')}) > 10 THEN epoch_us(CAST({_tag('published')} AS TIMESTAMPTZ)) END AS published_us,
coalesce({_tag('location')}, '') AS location, CASE WHEN NOT regexp_matches(url, '^https?://') THEN 'url not absolute' END AS problem FROM (SELECT *, regexp_extract(i, 'href="([^"]*)"', 1) AS url FROM ({_ITEM_SQL.format(text=_sql_text(_text("hasjob")), tag="entry")}))""")
def feed_hasjob(spark, d):
    rows = platforms.parse_atom(page(spark, "hasjob"))
    return rows.select("external_id", "title", "employer", "url", F.unix_micros("published_at").alias("published_us"), "location", "problem")


@query(f"""SELECT nullif(regexp_extract({_tag('link')}, '/([0-9]+)/?$', 1), '') AS external_id, CASE WHEN n < 2 THEN {_tag('title')} ELSE array_to_string(w[:n - k], ', ') END AS title, CASE WHEN n >= 2 THEN array_to_string(w[n - k + 1:], ', ') END AS employer, {_tag('link')} AS url,
split_part({_tag('description')}, chr(10), 1) AS location, CASE WHEN regexp_extract({_tag('link')}, '/([0-9]+)/?$', 1) = '' THEN 'no id' END AS problem
FROM (SELECT i, w, len(w) AS n, CASE WHEN len(w) > 2 AND lower(w[len(w)]) IN ('inc', 'inc.', 'ltd') THEN 2 ELSE 1 END AS k FROM (SELECT i, string_split({_tag('title')}, ', ') AS w FROM ({_ITEM_SQL.format(text=_sql_text(_text("pythonorg")), tag="item")})))""")
def feed_pythonorg(spark, d):
    return platforms.parse_listing(page(spark, "pythonorg")).select("external_id", "title", "employer", "url", "location", "problem")


@query(f"""WITH c AS (SELECT json_extract_string(k, '$.id') AS external_id, replace(trim(regexp_replace(regexp_replace(regexp_extract(json_extract_string(k, '$.text'), '^(.*?)(<p>|<br>|$)', 1), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')), '&amp;', '&') AS h FROM (SELECT unnest(CAST(json_extract({_sql_text(_text("hackernews"))}::JSON, '$.children') AS JSON[])) AS k)),
s AS (SELECT *, list_transform(string_split(h, '|'), lambda x: trim(x)) AS w FROM c WHERE h <> '')
SELECT external_id, CASE WHEN len(w) > 1 THEN trim(regexp_replace(w[1], '\\([^)]*\\)', '')) ELSE split_part(h, ' - ', 1) END AS employer, w[2] AS title, CASE WHEN len(w) > 1 THEN array_to_string(w[2:], ' | ') ELSE h END AS location,
CASE WHEN regexp_matches(h, '(?i)remote') AND NOT regexp_matches(h, '(?i)no remote') THEN 'remote' WHEN regexp_matches(h, '(?i)hybrid') THEN 'hybrid' WHEN regexp_matches(h, '(?i)on-site') THEN 'on site' END AS workplace FROM s""")
def feed_hackernews(spark, d):
    return platforms.parse_thread(page(spark, "hackernews")).select("external_id", "employer", "title", "location", "workplace")


@query(f"SELECT CAST(1 AS BIGINT) AS page_id, arg_max(json_extract_string(h, '$.objectID'), CAST(json_extract_string(h, '$.created_at_i') AS BIGINT)) AS thread FROM (SELECT unnest(CAST(json_extract({_sql_text(_text('stories'))}::JSON, '$.hits') AS JSON[])) AS h) WHERE regexp_matches(json_extract_string(h, '$.title'), '^Ask HN: Who is hiring')")
def feed_thread_followed(spark, d):
    """The thread to fetch next: the newest whose title asks for it."""
    return platforms.newest_thread(page(spark, "stories"))


def _details(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(b, i, json.dumps(x)) for b, i, x in DETAILS], "board_id string, external_id string, payload string")


@query(f"""WITH p AS (SELECT json_extract_string(p, '$.id') AS external_id FROM (SELECT unnest(CAST(json_extract({_sql_text(_text('smartrecruiters'))}::JSON, '$.content') AS JSON[])) AS p)),
t AS (SELECT * FROM (VALUES {', '.join(f"({_sql_text(i)}, {_sql_text(json.dumps(x))}::JSON)" for _, i, x in DETAILS)}) AS t(external_id, j))
SELECT external_id, coalesce(json_extract_string(j, '$.postingUrl'), 'https://smartrecruiters.example/x/' || external_id) AS url, j IS NOT NULL AS read, CASE WHEN j IS NOT NULL THEN concat_ws(' / ', nullif(json_extract_string(j, '$.jobAd.sections.companyDescription.text'), ''), nullif(json_extract_string(j, '$.jobAd.sections.jobDescription.text'), ''), nullif(json_extract_string(j, '$.jobAd.sections.qualifications.text'), '')) END AS description
FROM p LEFT JOIN t USING (external_id)""")
def feed_details(spark, d):
    """Postings with what their details add: null where none was read, empty where it says nothing."""
    rows = platforms.with_details(platforms.parse(page(spark, "smartrecruiters"), "smartrecruiters"), _details(spark))
    return rows.select("external_id", "url", F.col("description").isNotNull().alias("read"), F.array_join("description", " / ").alias("description"))


@query("""WITH v AS (SELECT board_id, json_extract_string(p, '$.id') AS external_id FROM (SELECT board_id, unnest(CASE WHEN json_type(payload, '$.content') = 'ARRAY' THEN CAST(json_extract(payload, '$.content') AS JSON[]) ELSE [payload::JSON] END) AS p FROM raw_pages WHERE source = 'smartrecruiters' AND json_valid(payload)) WHERE json_extract_string(p, '$.name') IS NOT NULL)
SELECT DISTINCT board_id, external_id FROM v WHERE 'smartrecruiters:' || external_id NOT IN (SELECT identity FROM seen_snapshots)""")
def details_wanted(spark, d):
    """The details to ask for: of postings the seen store doesn't know."""
    rows = platforms.parse(spark.read.parquet(f"{d}/raw_pages.parquet"), "smartrecruiters")
    return platforms.wanted_details(rows, spark.read.parquet(f"{d}/seen_snapshots.parquet"))


@query("""SELECT posting_id, CASE WHEN len(w) < 2 THEN title ELSE array_to_string(w[:len(w) - k], ', ') END AS role, CASE WHEN len(w) >= 2 THEN array_to_string(w[len(w) - k + 1:], ', ') END AS employer
FROM (SELECT *, CASE WHEN len(w) > 2 AND regexp_matches(lower(w[len(w)]), '^(inc|llc|ltd|gmbh)\\.?$') THEN 2 ELSE 1 END AS k FROM (SELECT posting_id, title, string_split(title, ', ') AS w FROM (SELECT posting_id, trim(regexp_replace(title, '\\s+', ' ', 'g')) || CASE WHEN employer IS NOT NULL THEN ', Alba, Inc.' ELSE '' END AS title FROM postings)))""")
def split_title(spark, d):
    """Titles with an employer after them, cut again."""
    told = F.concat(F.trim(F.regexp_replace("title", r"\s+", " ")), F.when(F.col("employer").isNotNull(), ", Alba, Inc.").otherwise(""))
    rows = spark.read.parquet(f"{d}/postings.parquet").select("posting_id", platforms.role_and_employer(told).alias("r"))
    return rows.select("posting_id", F.col("r.title").alias("role"), "r.employer")


@query("SELECT board_id FROM boards WHERE snapshot_no = (SELECT max(snapshot_no) FROM boards) GROUP BY board_id HAVING max(nullif(trim(employer_alias), '')) IS NULL")
def boards_without_alias(spark, d):
    boards = spark.read.parquet(f"{d}/boards.parquet")
    return config.without_alias(boards.join(boards.agg(F.max("snapshot_no").alias("snapshot_no")), "snapshot_no"))


@query(f"""SELECT row_id, CASE WHEN list_contains(n.names, 'strip_location') THEN CASE WHEN trim(location) <> '' AND suffix(title, ' - ' || trim(location)) THEN trim(title[:length(title) - length(trim(location)) - 3]) ELSE title END ELSE title END AS title
FROM (SELECT row_id, board_id, title || coalesce(' - ' || trim(location), '') AS title, location FROM job_rows) j LEFT JOIN (SELECT board_id, ['strip_location'] AS names FROM boards WHERE platform = 'lever' GROUP BY board_id) n USING (board_id)""")
def title_normalisers(spark, d):
    """Titles put through the named normalisers of their board; here lever's boards name one."""
    rows = spark.read.parquet(f"{d}/job_rows.parquet").select("row_id", "board_id", "location", F.concat("title", F.coalesce(F.concat(F.lit(" - "), F.trim("location")), F.lit(""))).alias("title"))
    names = spark.read.parquet(f"{d}/boards.parquet").where("platform = 'lever'").select("board_id", F.array(F.lit("strip_location")).alias("normalisations")).distinct()
    return rows.join(names, "board_id", "left").select("row_id", T.normalised(F.col("title"), F.col("location"), F.col("normalisations")).alias("title"))
