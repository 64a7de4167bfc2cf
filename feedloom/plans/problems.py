"""Queries of the core's operators on nested records, snapshots, timestamps and drifting schemas, with SQL where it can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import drift, shred, snapshots, timestamps


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return shred.children_found(_table(spark, d, "raw_pages"))


def p2_postings(spark: SparkSession, d: str) -> DataFrame:
    return shred.flat_tables(_table(spark, d, "raw_pages"))["postings"].select("page_id", "position", "posting_id", "title")


def p2_pages(spark: SparkSession, d: str) -> DataFrame:
    return shred.flat_tables(_table(spark, d, "raw_pages"))["pages"]


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.changes_found(_table(spark, d, "seen_snapshots"), _table(spark, d, "boards"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return timestamps.instants_found(_table(spark, d, "postings"), _table(spark, d, "boards"))


def p4_instants(spark: SparkSession, d: str) -> DataFrame:
    return timestamps.normalise(_table(spark, d, "postings"), _table(spark, d, "boards"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.changes_found(_table(spark, d, "feed_records"))


def p7_table(spark: SparkSession, d: str) -> DataFrame:
    table = drift.drift(_table(spark, d, "feed_records"))[0]
    return table.select("record_id", "feed_id", "file_no", "version", "posting", F.to_json("fields").alias("fields"))


def p7_columns(spark: SparkSession, d: str) -> DataFrame:
    """The columns of each source's table with their types."""
    return drift.drift(_table(spark, d, "feed_records")).columns


def p7_clashes(spark: SparkSession, d: str) -> DataFrame:
    """Records two of whose paths went to one field with different values."""
    return drift.drift(_table(spark, d, "feed_records")).clashes


def p7_versions(spark: SparkSession, d: str) -> DataFrame:
    """The schema version and fingerprint of every file."""
    return drift.drift(_table(spark, d, "feed_records")).versions


def p7_typed(spark: SparkSession, d: str) -> DataFrame:
    """Every record's row of its source's typed table, as JSON, since the sources' columns differ."""
    records = _table(spark, d, "feed_records")
    found = drift.drift(records)
    sources = sorted(r[0] for r in found.columns.select("source").distinct().collect())
    out = None
    for source in sources:
        wide = drift.typed(found, records, source)
        part = wide.select("record_id", F.lit(source).alias("source"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in wide.columns if c != "record_id"]), {"ignoreNullFields": "false"}).alias("row"))
        out = part if out is None else out.unionByName(part)
    return out if out is not None else records.select("record_id", "source", F.lit("").alias("row"))


def queries() -> dict:
    return {f.__name__: f for f in (p2_found, p2_postings, p2_pages, p3_found, p4_found, p4_instants, p7_found, p7_table, p7_columns, p7_clashes, p7_versions, p7_typed)}


def oracle_sql() -> dict[str, str]:
    return {"p2_found": P2_FOUND, "p2_postings": P2_POSTINGS, "p2_pages": P2_PAGES, "p3_found": P3_FOUND, "p4_found": P4_FOUND}


_POSTS = """
WITH valid AS (SELECT page_id, source, board_id, payload::JSON AS j FROM raw_pages WHERE json_valid(payload)),
lists AS (SELECT page_id, source, board_id, CASE
    WHEN json_type(j) = 'ARRAY' THEN CAST(j AS JSON[])
    WHEN json_type(j, '$.jobs') = 'ARRAY' THEN CAST(json_extract(j, '$.jobs') AS JSON[])
    WHEN json_type(j, '$.content') = 'ARRAY' THEN CAST(json_extract(j, '$.content') AS JSON[])
    ELSE [j] END AS items FROM valid),
each AS (SELECT page_id, unnest(items) AS p, CAST(unnest(range(len(items))) AS INTEGER) AS position FROM lists)
"""
P2_POSTINGS = _POSTS + """SELECT page_id, position, json_extract_string(p, '$.id') AS posting_id, coalesce(json_extract_string(p, '$.title'), json_extract_string(p, '$.text'), json_extract_string(p, '$.name')) AS title
FROM each WHERE json_type(p) = 'OBJECT'"""
P2_PAGES = _POSTS + """SELECT l.page_id, l.source, l.board_id, count(e.position) AS postings FROM lists l LEFT JOIN each e ON l.page_id = e.page_id AND json_type(e.p) = 'OBJECT' GROUP BY ALL"""
P2_FOUND = """
WITH valid AS (SELECT page_id, payload::JSON AS j FROM raw_pages WHERE json_valid(payload)),
posts AS (
  SELECT page_id, unnest(CASE
    WHEN json_type(j) = 'ARRAY' THEN CAST(j AS JSON[])
    WHEN json_type(j, '$.jobs') = 'ARRAY' THEN CAST(json_extract(j, '$.jobs') AS JSON[])
    WHEN json_type(j, '$.content') = 'ARRAY' THEN CAST(json_extract(j, '$.content') AS JSON[])
    ELSE [j] END) AS p FROM valid),
held AS (
  SELECT page_id, json_extract_string(p, '$.id') AS posting_id, k.label AS child_path, json_extract(p, '$.' || k.label) AS v
  FROM posts, (VALUES ('customField'), ('departments'), ('lists')) AS k(label) WHERE json_type(p) = 'OBJECT'),
opened AS (
  SELECT page_id, posting_id, child_path,
    CASE WHEN json_type(v) = 'VARCHAR' AND json_valid(json_extract_string(v, '$')) THEN json_extract_string(v, '$')::JSON ELSE v END AS v FROM held),
listed AS (SELECT page_id, posting_id, child_path, CAST(v AS JSON[]) AS items FROM opened WHERE json_type(v) = 'ARRAY'),
each AS (SELECT page_id, posting_id, child_path, unnest(items) AS item, unnest(range(len(items))) AS pos FROM listed)
SELECT page_id, posting_id, child_path, CAST(pos AS INTEGER) AS child_pos FROM each WHERE json_type(item) = 'OBJECT'
UNION ALL SELECT page_id, posting_id, child_path, 0 FROM opened WHERE json_type(v) = 'OBJECT'
"""

_TIDY = "coalesce(trim(regexp_replace(CAST({c} AS VARCHAR), '[\\s 　]+', ' ', 'g')), '')"
_SET = "coalesce(array_to_string(list_sort(list_distinct(list_transform({c}, lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))))), '|'), '')"


def _compared(entity: str, key: str, columns: list[str], arrays: list[str]) -> str:
    parts = [_TIDY.format(c=c) for c in columns] + [_SET.format(c=c) for c in arrays]
    return f"SELECT DISTINCT '{entity}' AS entity, snapshot_no, {key} AS record_key, concat_ws('~', {', '.join(parts)}) AS row_text FROM {entity}"


P3_FOUND = f"""
WITH rows_ AS ({_compared("seen_snapshots", "identity", ["first_seen", "published_at", "source", "board_id", "title", "location", "url"], [])}
  UNION ALL {_compared("boards", "board_id", ["platform", "slug", "employer_alias", "zone"], ["poll_slots", "deep_slots", "normalisations"])}),
one AS (SELECT entity, snapshot_no, record_key, string_agg(row_text, '^' ORDER BY row_text) AS t FROM rows_ GROUP BY ALL),
numbers AS (SELECT entity, snapshot_no, lag(snapshot_no) OVER (PARTITION BY entity ORDER BY snapshot_no) AS before FROM (SELECT DISTINCT entity, snapshot_no FROM one)),
now_ AS (SELECT o.*, n.before FROM one o JOIN numbers n USING (entity, snapshot_no) WHERE n.before IS NOT NULL),
was AS (SELECT o.entity, n.snapshot_no, o.record_key, o.t FROM one o JOIN numbers n ON o.entity = n.entity AND o.snapshot_no = n.before)
SELECT entity, snapshot_no, record_key,
  CASE WHEN w.t IS NULL THEN 'added' WHEN n.t IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM now_ n FULL JOIN was w USING (entity, snapshot_no, record_key) WHERE n.t IS DISTINCT FROM w.t
"""

_T = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,12}))?)?"
_NAMES = "['a', 'b', 'c', 'h', 'mi', 's', 'f', 'tail']"
_MONTH = "list_position(['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec'], lower(left({c}, 3)))"
_ZONES = "{'Z': 0, 'UT': 0, 'UTC': 0, 'GMT': 0, 'EST': -300, 'EDT': -240, 'CST': -360, 'CDT': -300, 'MST': -420, 'MDT': -360, 'PST': -480, 'PDT': -420}"
_DAY_US = 86_400_000_000
P4_FOUND = f"""
WITH p AS (SELECT posting_id, regexp_replace(published_raw, '^[\\s\u00a0\u3000]+|[\\s\u00a0\u3000]+$', '', 'g') AS t, z.zone FROM postings LEFT JOIN (SELECT board_id, max(zone) AS zone FROM boards GROUP BY 1) z USING (board_id) WHERE published_raw IS NOT NULL),
cut AS (
  SELECT posting_id, zone, 'ymd' AS o, regexp_extract(t, '^(\\d{{4}})-(\\d{{2}})-(\\d{{2}})[Tt ]{_T}\\s*(.*)$', {_NAMES}) AS x, '' AS half FROM p
  UNION ALL SELECT posting_id, zone, 'ymd', regexp_extract(t, '^(\\d{{4}})(\\d{{2}})(\\d{{2}})[Tt](\\d{{2}})(\\d{{2}})(\\d{{2}})(?:[.,](\\d{{1,12}}))?\\s*(.*)$', {_NAMES}), '' FROM p
  UNION ALL SELECT posting_id, zone, 'dmy', regexp_extract(t, '^(?:[A-Za-z]{{3,9}},?\\s+)?(\\d{{1,2}})[\\s-]+([A-Za-z]{{3,9}})\\.?,?[\\s-]+(\\d{{4}}),?\\s+{_T}\\s*(.*)$', {_NAMES}), '' FROM p
  UNION ALL SELECT posting_id, zone, 'mdy', regexp_extract(regexp_replace(t, '\\s*([AaPp])\\.?[Mm]\\.?(\\s|$)', ' '), '^([A-Za-z]{{3,9}})\\.?\\s+(\\d{{1,2}}),?\\s+(\\d{{4}}),?\\s+{_T}\\s*(.*)$', {_NAMES}), upper(regexp_extract(t, ':\\d{{2}}\\s*([AaPp])\\.?[Mm]\\.?(\\s|$)', 1)) FROM p),
part AS (
  SELECT posting_id, zone, half, CASE o WHEN 'ymd' THEN x.a ELSE x.c END AS y, CASE o WHEN 'ymd' THEN x.b WHEN 'dmy' THEN CAST({_MONTH.format(c="x.b")} AS VARCHAR) ELSE CAST({_MONTH.format(c="x.a")} AS VARCHAR) END AS mo, CASE o WHEN 'ymd' THEN x.c WHEN 'dmy' THEN x.a ELSE x.b END AS d, x.h AS h, x.mi AS mi, x.s AS s, x.f AS f,
    trim(regexp_replace(x.tail, '\\([^)]*\\)\\s*$', '')) AS tail FROM cut WHERE x.a <> ''),
clock AS (
  SELECT posting_id, zone, tail, epoch_us(TRY_CAST(printf('%s-%02d-%02d %02d:%s:%s.%s', y, CAST(mo AS INTEGER), CAST(d AS INTEGER), CASE half WHEN '' THEN CAST(h AS INTEGER) WHEN 'P' THEN CAST(h AS INTEGER) % 12 + 12 ELSE CAST(h AS INTEGER) % 12 END, mi, CASE WHEN s = '' THEN '00' ELSE s END, rpad(left(f, 6), 6, '0')) AS TIMESTAMP)) AS us,
    regexp_extract(tail, '^\\[?([A-Za-z]+(?:/[A-Za-z_+-]+)+)\\]?$', 1) AS named, regexp_extract(tail, '^([+-]\\d{{2}}):?(\\d{{2}})?(?:\\[[^\\]]*\\])?$', ['h', 'm']) AS off
  FROM part WHERE mo IS NOT NULL AND CAST(h AS INTEGER) < 24 AND (half = '' OR CAST(h AS INTEGER) BETWEEN 1 AND 12)),
zoned AS (SELECT posting_id, us, CASE WHEN tail = '' THEN zone ELSE nullif(named, '') END AS z, CASE WHEN off.h <> '' THEN CAST(off.h AS INTEGER) * 60 + CASE WHEN off.h LIKE '-%' THEN -1 ELSE 1 END * CAST(CASE WHEN off.m = '' THEN '0' ELSE off.m END AS INTEGER)
  ELSE map_extract_value(MAP {_ZONES}, upper(tail)) END AS minutes, tail FROM clock WHERE us IS NOT NULL),
timed AS (
  SELECT posting_id, us - CAST(minutes AS BIGINT) * 60000000 AS inst FROM zoned WHERE tail <> '' AND minutes IS NOT NULL AND abs(minutes) <= 1080
  UNION ALL SELECT posting_id, inst FROM (SELECT posting_id, us, z, unnest([epoch_us(timezone(z, make_timestamp(us - {_DAY_US}))) + {_DAY_US}, epoch_us(timezone(z, make_timestamp(us + {_DAY_US}))) - {_DAY_US}]) AS inst FROM zoned WHERE z IS NOT NULL) WHERE epoch_us(timezone(z, make_timestamptz(inst))) = us),
days AS (
  SELECT posting_id, regexp_extract(t, '^(\\d{{4}})[-/.]?(\\d{{2}})[-/.]?(\\d{{2}})$', ['y', 'm', 'd']) AS x FROM p WHERE regexp_matches(t, '^(\\d{{8}}|\\d{{4}}-\\d{{2}}-\\d{{2}}|\\d{{4}}/\\d{{2}}/\\d{{2}}|\\d{{4}}\\.\\d{{2}}\\.\\d{{2}})$')
  UNION ALL SELECT posting_id, {{'y': x.c, 'm': CAST({_MONTH.format(c="x.b")} AS VARCHAR), 'd': x.a}} FROM (SELECT posting_id, regexp_extract(t, '^(?:[A-Za-z]{{3,9}},?\\s+)?(\\d{{1,2}})[\\s-]+([A-Za-z]{{3,9}})\\.?,?[\\s-]+(\\d{{4}})$', ['a', 'b', 'c']) AS x FROM p) WHERE x.a <> ''
  UNION ALL SELECT posting_id, {{'y': x.c, 'm': CAST({_MONTH.format(c="x.a")} AS VARCHAR), 'd': x.b}} FROM (SELECT posting_id, regexp_extract(t, '^([A-Za-z]{{3,9}})\\.?\\s+(\\d{{1,2}}),?\\s+(\\d{{4}})$', ['a', 'b', 'c']) AS x FROM p) WHERE x.a <> ''
  UNION ALL SELECT posting_id, unnest([{{'y': x.c, 'm': x.b, 'd': x.a}}, {{'y': x.c, 'm': x.a, 'd': x.b}}]) FROM (SELECT posting_id, regexp_extract(t, '^(\\d{{1,2}})[/.-](\\d{{1,2}})[/.-](\\d{{4}})$', ['a', 'b', 'c']) AS x FROM p) WHERE x.a <> ''),
epochs AS (SELECT posting_id, TRY_CAST(floor(n * u) AS BIGINT) AS inst FROM (SELECT posting_id, CAST(t AS DECIMAL(27, 9)) AS n, unnest([CAST(1000000 AS DECIMAL(10, 3)), 1000, 1, 0.001]) AS u FROM p WHERE regexp_matches(t, '^\\d{{1,17}}(\\.\\d{{1,9}})?$') AND NOT regexp_matches(t, '^\\d{{8}}$'))),
every AS (
  SELECT posting_id, inst FROM timed UNION ALL SELECT posting_id, epoch_us(TRY_CAST(printf('%s-%02d-%02d', x.y, CAST(x.m AS INTEGER), CAST(x.d AS INTEGER)) AS TIMESTAMP)) FROM days WHERE x.m IS NOT NULL
  UNION ALL SELECT posting_id, inst FROM epochs WHERE inst < 4102444800000000)
SELECT posting_id, strftime(make_timestamp(min(inst)), '%Y-%m-%dT%H:%M:%S.%fZ') AS published_utc FROM every WHERE inst >= 946684800000000 GROUP BY posting_id HAVING count(DISTINCT inst) = 1
"""
