"""Queries of the feed-processing operators over the given tables, each with SQL of the same result where SQL can say it.

Policy (terms, limits, allowed names) is an argument of the operators; what stands here is sample configuration.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from feedloom.functions import descriptions as D
from feedloom.functions import text as T
from feedloom.operators import chain, drift, grouping, jsonwalk, publish, runs, shapes, shred, stores
from feedloom.session import materialize
from feedloom.sources import config, platforms
from feedloom.streaming import ingest

NOW = "2026-06-15T00:00:00Z"
TERMS = ("data", "machine learning", "engineer", "developer", "designer", "analyst", "scientist", "manager", "planner", "writer", "editor", "recruiter", "officer", "administrator")
EXCLUDED = ("trainee", "principal")
LEVELS = ("entry", "trainee")
PUBLIC = ("greenhouse", "lever", "ashby", "workable", "smartrecruiters", "manatal")

_Q: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a query of (tables) under its function's name; sql gives the same rows."""

    def add(f: Callable) -> Callable:
        _Q[f.__name__] = lambda spark, d: f(lambda name: spark.read.parquet(f"{d}/{name}.parquet"))
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def us(c: str) -> F.Column:
    return F.unix_micros(c)


# ---- SQL fragments

SQL_FOLD = "coalesce(trim(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents({c})), '[-‐-—_/]', ' ', 'g'), '[\\[\\],().:]', '', 'g'), '\\s+', ' ', 'g')), '')"
SQL_WORD = "(^|[^\\p{{L}}\\p{{N}}_]){t}(?:e?s)?([^\\p{{L}}\\p{{N}}_]|$)"


def sql_fold(c: str) -> str:
    return SQL_FOLD.format(c=c)


def sql_first(c: str, terms: tuple) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, '{SQL_WORD.format(t=t)}') THEN '{t}'" for t in terms) + " END"


# ---- strings and dates

@query(f"SELECT row_id, {sql_fold('title')} AS title_folded, {sql_fold('employer')} AS employer_folded, {sql_fold('location')} AS location_folded FROM job_rows")
def fold_titles(t):
    return t("job_rows").select("row_id", T.fold(F.col("title")).alias("title_folded"), T.fold(F.col("employer")).alias("employer_folded"), T.fold(F.col("location")).alias("location_folded"))


@query("""SELECT row_id, CASE WHEN trim(location) <> '' AND suffix(title, ' - ' || trim(location)) THEN trim(title[:length(title) - length(trim(location)) - 3]) ELSE title END AS title_bare
FROM (SELECT row_id, title || CASE WHEN workplace IS NULL AND location IS NOT NULL THEN ' - ' || trim(location) ELSE '' END AS title, location FROM job_rows)""")
def strip_location_suffix(t):
    tailed = F.concat("title", F.when(F.col("workplace").isNull() & F.col("location").isNotNull(), F.concat(F.lit(" - "), F.trim("location"))).otherwise(""))
    return t("job_rows").withColumn("title", tailed).select("row_id", T.strip_location_suffix(F.col("title"), F.col("location")).alias("title_bare"))


@query("""SELECT row_id, CASE WHEN contains(identity, ':') THEN split_part(identity, ':', 1) END AS source_of, regexp_matches(lower(url), '^https?://') AS absolute,
regexp_extract(url, '^https?://([^/]+)', 1) AS host, replace(replace(board_id, ':', '%3A'), ' ', '%20') AS board_encoded FROM job_rows""")
def url_parts(t):
    return t("job_rows").select(
        "row_id", F.when(F.contains("identity", F.lit(":")), F.substring_index("identity", ":", 1)).alias("source_of"), F.rlike(F.lower("url"), F.lit("^https?://")).alias("absolute"),
        F.parse_url("url", F.lit("HOST")).alias("host"), F.replace(F.url_encode("board_id"), F.lit("+"), F.lit("%20")).alias("board_encoded"),
    )


@query("""SELECT row_id, CASE WHEN source IN ('greenhouse','lever','ashby','workable','smartrecruiters','manatal') THEN identity ELSE 'private' END AS identity_shown,
regexp_replace(url, '[0-9]{4,}', '***', 'g') AS url_redacted FROM job_rows""")
def masked(t):
    return t("job_rows").select("row_id", F.when(F.col("source").isin(*PUBLIC), F.col("identity")).otherwise("private").alias("identity_shown"), F.regexp_replace("url", "[0-9]{4,}", "***").alias("url_redacted"))


@query("""SELECT row_id, strftime(first_seen AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S.%gZ') AS shown_ms, strftime(first_seen AT TIME ZONE 'UTC', '%Y-%m') AS month, CAST(day(first_seen AT TIME ZONE 'UTC') AS INTEGER) AS day_of_month,
(epoch_us(first_seen) - epoch_us(published_at)) / 3600000000.0 AS hours FROM job_rows""")
def date_forms(t):
    return t("job_rows").select(
        "row_id", F.date_format("first_seen", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("shown_ms"), F.date_format("first_seen", "yyyy-MM").alias("month"), F.dayofmonth("first_seen").alias("day_of_month"),
        ((us("first_seen") - us("published_at")) / 3_600_000_000.0).alias("hours"),
    )


@query("""SELECT posting_id, CASE WHEN regexp_matches(published_raw, '^[0-9]{1,18}$') AND CAST(published_raw AS BIGINT) BETWEEN 1000000000 AND 4000000000 THEN CAST(published_raw AS BIGINT) * 1000000 END AS from_seconds_us,
CASE WHEN regexp_matches(published_raw, '^[0-9]{1,18}$') AND CAST(published_raw AS BIGINT) BETWEEN 1000000000000 AND 4000000000000 THEN CAST(published_raw AS BIGINT) * 1000 END AS from_millis_us,
CASE WHEN regexp_matches(published_raw, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN epoch_us(TRY_CAST(published_raw AS DATE)::TIMESTAMP) END AS from_day_us FROM (SELECT posting_id, trim(regexp_replace(published_raw, '\\s+', ' ', 'g')) AS published_raw FROM postings)""")
def source_dates(t):
    raw = T.squeeze("published_raw")
    plain = F.when(F.rlike(raw, F.lit("^[0-9]{1,18}$")), raw)
    return t("postings").select("posting_id", F.unix_micros(platforms.epoch_date(plain, platforms.SECONDS, 1)).alias("from_seconds_us"), F.unix_micros(platforms.epoch_date(plain, platforms.MILLIS, 1000)).alias("from_millis_us"), F.unix_micros(platforms.day_date(raw)).alias("from_day_us"))


@query("""SELECT row_id, epoch_us(coalesce(published_at, first_seen)) AS ordering_us, CASE WHEN published_at IS NULL THEN 'first_seen' ELSE 'publication' END AS ordering_source FROM job_rows""")
def ordering_date(t):
    return t("job_rows").select("row_id", F.unix_micros(F.coalesce("published_at", "first_seen")).alias("ordering_us"), F.when(F.col("published_at").isNull(), "first_seen").otherwise("publication").alias("ordering_source"))


# ---- terms and the chain

@query(f"SELECT row_id, {sql_first(sql_fold('title'), TERMS)} AS first_term FROM job_rows")
def title_first_match(t):
    return t("job_rows").select("row_id", chain.first_term(T.fold(F.col("title")), TERMS).alias("first_term"))


@query("WITH m AS (SELECT row_id, f, unnest([" + ", ".join(f"CASE WHEN regexp_matches(f, '{SQL_WORD.format(t=x)}') THEN '{x}' END" for x in TERMS) + f"]) AS term, {sql_first('f', TERMS)} AS first_term FROM (SELECT row_id, {sql_fold('title')} AS f FROM job_rows)), "
       "terms AS (SELECT unnest([" + ", ".join(f"'{x}'" for x in TERMS) + "]) AS term) "
       "SELECT t.term, count(m.row_id) AS matches, count(CASE WHEN m.first_term = t.term THEN 1 END) AS credited FROM terms t LEFT JOIN m ON m.term = t.term GROUP BY t.term")
def title_census(t):
    rows = t("job_rows").select("row_id", T.fold(F.col("title")).alias("f"))
    rows = rows.select("row_id", chain.first_term(F.col("f"), TERMS).alias("first"), F.explode(chain.all_terms(F.col("f"), TERMS)).alias("term"))
    counts = rows.groupBy("term").agg(F.count("*").alias("matches"), F.count_if(F.col("first") == F.col("term")).alias("credited"))
    terms = t("job_rows").sparkSession.createDataFrame([(x,) for x in TERMS], "term string")
    return terms.join(counts, "term", "left").select("term", F.coalesce("matches", F.lit(0)).alias("matches"), F.coalesce("credited", F.lit(0)).alias("credited"))


@query("""SELECT title, CAST(total AS BIGINT) AS total, boards, CAST(place AS INTEGER) AS place FROM (
SELECT title, total, boards, row_number() OVER (ORDER BY total DESC, title) AS place FROM (SELECT title, count(*) AS total, count(DISTINCT board_id) AS boards FROM job_rows GROUP BY title)) WHERE place <= 12""")
def titles_top_k(t):
    counts = t("job_rows").groupBy("title").agg(F.count("*").alias("total"), F.count_distinct("board_id").alias("boards"))
    top = counts.orderBy(F.desc("total"), "title").limit(12)  # a top-k report
    return top.withColumn("place", F.row_number().over(W.orderBy(F.desc("total"), "title")))


def _rules() -> list[chain.Rule]:
    title = T.fold(F.col("title_normalised"))
    return [
        chain.rule("expiry", now=NOW),
        chain.rule("terms", column=title, wanted=TERMS, name="title"),
        chain.rule("excluded", column=title, words=EXCLUDED, name="seniority"),
        chain.rule("all_in", column=F.col("stated_levels"), values=LEVELS, name="level"),
        chain.rule("above", column=F.col("stated_experience"), limit=5, name="experience"),
        chain.rule("older", first=F.col("first_seen"), dated=F.col("ordering_date"), days=7, skip=F.col("published_meaning_unconfirmed"), name="age"),
    ]


SQL_CHAIN = f"""SELECT row_id, board_id, CASE
 WHEN expires_at <> '' AND expires_at < '{NOW}' THEN 'expiry'
 WHEN {sql_first(sql_fold('title_normalised'), TERMS)} IS NULL THEN 'title'
 WHEN {sql_first(sql_fold('title_normalised'), EXCLUDED)} IS NOT NULL THEN 'seniority'
 WHEN len(list_filter(stated_levels, lambda x: trim(x) <> '')) > 0 AND len(list_filter(stated_levels, lambda x: trim(x) <> '' AND lower(trim(x)) NOT IN ('entry', 'trainee'))) = 0 THEN 'level'
 WHEN list_max(stated_experience) > 5 THEN 'experience'
 WHEN epoch_us(first_seen) - epoch_us(ordering_date) > 7 * 86400000000 AND NOT coalesce(published_meaning_unconfirmed, false) THEN 'age' END AS drop_rule FROM job_rows"""


@query(f"SELECT row_id, drop_rule FROM ({SQL_CHAIN})")
def chain_first_failure(t):
    return chain.judged(t("job_rows"), _rules()).select("row_id", "drop_rule")


@query(f"SELECT r.drop_rule, count(c.row_id) AS n_dropped FROM (SELECT unnest(['expiry','title','seniority','level','experience','age']) AS drop_rule) r LEFT JOIN ({SQL_CHAIN}) c USING (drop_rule) GROUP BY r.drop_rule")
def drops_by_rule_zero_filled(t):
    rules = _rules()
    return chain.drop_counts(chain.judged(t("job_rows"), rules), rules)


@query(f"SELECT board_id, drop_rule, count(*) AS n_dropped FROM ({SQL_CHAIN}) WHERE drop_rule IS NOT NULL GROUP BY ALL")
def drops_by_board_rule(t):
    rules = _rules()
    return chain.drop_counts(chain.judged(t("job_rows"), rules), rules, "board_id")


@query(f"SELECT source, count(*) AS n_rows, count(*) FILTER (WHERE drop_rule IS NULL) AS kept, count(*) FILTER (WHERE drop_rule = 'age') AS too_old, count(*) FILTER (WHERE employer IS NULL) AS unnamed FROM ({SQL_CHAIN}) JOIN (SELECT row_id, source, employer FROM job_rows) USING (row_id) GROUP BY source")
def run_totals(t):
    rows = chain.judged(t("job_rows"), _rules())
    return rows.groupBy("source").agg(F.count("*").alias("n_rows"), F.count_if(F.col("drop_rule").isNull()).alias("kept"), F.count_if(F.col("drop_rule") == "age").alias("too_old"), F.count_if(F.col("employer").isNull()).alias("unnamed"))


# ---- layers and stores

@query("SELECT row_id, identity FROM incoming_rows WHERE identity NOT IN (SELECT identity FROM job_rows)")
def split_new_anti(t):
    return stores.split_new(t("incoming_rows"), t("job_rows"), "identity")[0].select("row_id", "identity")


@query("SELECT row_id, identity FROM incoming_rows WHERE identity IN (SELECT identity FROM job_rows)")
def split_new_semi(t):
    return stores.split_new(t("incoming_rows"), t("job_rows"), "identity")[1].select("row_id", "identity")


@query("SELECT row_id, identity, source FROM job_rows UNION ALL SELECT row_id, identity, source FROM incoming_rows i WHERE NOT EXISTS (SELECT 1 FROM job_rows j WHERE j.identity = i.identity)")
def append_delta(t):
    columns = ["row_id", "identity", "source"]
    return t("job_rows").select(*columns).unionByName(stores.delta(t("incoming_rows"), t("job_rows"), "identity").select(*columns))


def _snapshot(t, n: int) -> DataFrame:
    """A snapshot without repeats; the store's own columns."""
    rest = ("first_seen", "published_at", "source", "board_id", "last_seen", "title", "location", "url")
    one = t("seen_snapshots").where(F.col("snapshot_no") == n).groupBy("identity").agg(F.max(F.struct("last_seen", *[c for c in rest if c != "last_seen"])).alias("r"))
    return one.select("identity", *[F.col(f"r.{c}").alias(c) for c in rest])


SQL_SNAPSHOT = """SELECT identity, first_seen, published_at, source, board_id, last_seen, title, location, url FROM (SELECT *, row_number() OVER (PARTITION BY identity ORDER BY last_seen DESC NULLS LAST, first_seen DESC NULLS LAST, published_at DESC NULLS LAST,
 source DESC NULLS LAST, board_id DESC NULLS LAST, title DESC NULLS LAST, location DESC NULLS LAST, url DESC NULLS LAST) AS rn FROM seen_snapshots WHERE snapshot_no = {n}) WHERE rn = 1"""


@query(f"""WITH s AS ({SQL_SNAPSHOT.format(n=5)}), n AS (SELECT identity, max(published_at) AS published_at, max(source) AS source, max(board_id) AS board_id FROM ({SQL_SNAPSHOT.format(n=6)}) GROUP BY identity)
SELECT identity, epoch_us(coalesce(s.first_seen, TIMESTAMPTZ '2026-06-15 00:00:00+00')) AS first_seen_us, epoch_us(coalesce(s.published_at, n.published_at)) AS published_us, coalesce(n.source, s.source) AS source,
coalesce(s.board_id, n.board_id) AS board_id, epoch_us(CASE WHEN n.identity IS NOT NULL THEN TIMESTAMPTZ '2026-06-15 00:00:00+00' ELSE s.last_seen END) AS last_seen_us FROM s FULL JOIN n USING (identity)""")
def seen_merge(t):
    merged = stores.merge_seen(_snapshot(t, 5), _snapshot(t, 6), F.lit("2026-06-15 00:00:00+00:00").cast("timestamp"))
    return merged.select("identity", us("first_seen").alias("first_seen_us"), us("published_at").alias("published_us"), "source", "board_id", us("last_seen").alias("last_seen_us"))


@query("SELECT board_id, epoch_us(max(published_at) FILTER (WHERE last_seen IS NOT NULL)) AS high_water_us, count(*) FILTER (WHERE last_seen IS NOT NULL) AS n_saved FROM seen_snapshots GROUP BY board_id")
def high_water(t):
    return runs.high_water(t("seen_snapshots"), F.col("last_seen").isNotNull())


@query("""SELECT board_id, count(p) > 0 AND coalesce(bool_and(p <= TIMESTAMPTZ '2025-12-31 00:00:00+00'), true) AS stops FROM (SELECT board_id, published_at AS p FROM seen_snapshots) GROUP BY board_id""")
def walk_stop(t):
    """A board's dates stand for a page's."""
    return runs.old_pages(t("seen_snapshots"), ["board_id"], F.lit("2025-12-31 00:00:00+00:00").cast("timestamp"))


@query("""WITH f AS (SELECT identity, stated_experience, described, who_reads FROM (SELECT *, row_number() OVER (PARTITION BY identity ORDER BY row_id DESC) AS rn FROM incoming_rows) WHERE rn = 1)
SELECT j.row_id, CASE WHEN f.identity IS NOT NULL THEN f.described ELSE j.described END AS described, array_to_string(CASE WHEN f.identity IS NOT NULL THEN f.stated_experience ELSE j.stated_experience END, ',') AS experience
FROM job_rows j LEFT JOIN f USING (identity)""")
def overlay_apply(t):
    columns = ["stated_experience", "described"]
    facts = stores.latest_per_key(t("incoming_rows").select("identity", "row_id", *columns), ["identity"], [F.col("row_id")])
    out = stores.overlay(t("job_rows").select("row_id", "identity", *columns), facts, "identity", columns)
    return out.select("row_id", "described", F.array_join("stated_experience", ",").alias("experience"))


@query(f"""WITH a AS (SELECT row_id FROM ({SQL_CHAIN}) WHERE drop_rule IS NULL) SELECT j.row_id, j.identity FROM job_rows j JOIN a USING (row_id) WHERE NOT EXISTS (SELECT 1 FROM incoming_rows i WHERE i.identity = j.identity) AND j.source <> 'himalayas'""")
def backfill_gap(t):
    admitted = chain.judged(t("job_rows"), _rules()).where("drop_rule is null").where(F.col("source") != "himalayas")
    return stores.delta(admitted, t("incoming_rows"), "identity").select("row_id", "identity")


@query("SELECT identity, arg_max(batch_no, (epoch_us(arrived_at), row_id)) AS batch_no, arg_max(row_id, (epoch_us(arrived_at), row_id)) AS row_id FROM incoming_rows GROUP BY identity")
def latest_per_identity(t):
    return stores.latest_per_key(t("incoming_rows").select("identity", "batch_no", "row_id", "arrived_at"), ["identity"], [F.col("arrived_at"), F.col("row_id")]).select("identity", "batch_no", "row_id")


@query("""SELECT group_id FROM row_groups WHERE group_id NOT IN (SELECT group_id FROM (SELECT group_id, unnest(members) AS identity FROM row_groups) JOIN group_rows USING (identity) WHERE workplace = 'remote')""")
def skip_group_any_member(t):
    return stores.without_touched(t("row_groups"), "members", "group_id", t("group_rows").where("workplace = 'remote'"), "identity").select("group_id")


@query(f"""WITH a AS ({SQL_SNAPSHOT.format(n=6)}), b AS ({SQL_SNAPSHOT.format(n=5)}), x AS (SELECT identity, nullif(trim(title), '') AS t, nullif(trim(location), '') AS l, nullif(trim(url), '') AS u FROM a), y AS (SELECT identity, nullif(trim(title), '') AS t, nullif(trim(location), '') AS l, nullif(trim(url), '') AS u FROM b)
SELECT x.identity, CASE WHEN y.identity IS NULL THEN 'new' WHEN x.t IS NOT DISTINCT FROM y.t AND x.l IS NOT DISTINCT FROM y.l AND x.u IS NOT DISTINCT FROM y.u THEN 'unchanged' ELSE 'changed' END AS state FROM x LEFT JOIN y USING (identity)""")
def display_diff(t):
    return stores.differs(_snapshot(t, 6), _snapshot(t, 5), "identity", ["title", "location", "url"])


@query(f"""WITH a AS ({SQL_SNAPSHOT.format(n=5)}), b AS ({SQL_SNAPSHOT.format(n=6)}) SELECT identity, CASE WHEN b.identity IS NOT NULL THEN b.title ELSE a.title END AS title, CASE WHEN b.identity IS NOT NULL THEN b.location ELSE a.location END AS location FROM a FULL JOIN b USING (identity)""")
def as_written_merge(t):
    columns = ["identity", "title", "location"]
    return stores.as_written(_snapshot(t, 5).select(*columns), _snapshot(t, 6).select(*columns), "identity")


def _fold_sql(step: str, first: str, last: str) -> str:
    """WITH m1 from the first of the six snapshots, then each m{n} from m{b} and snapshot n{n}, polled at t{n}.now."""
    parts = [f"n{n} AS ({SQL_SNAPSHOT.format(n=n)}), t{n} AS (SELECT max(taken_at) AS now FROM seen_snapshots WHERE snapshot_no = {n})" for n in range(1, 7)]
    merged = [f"m1 AS ({first})", *(f"m{n} AS ({step.format(n=n, b=n - 1)})" for n in range(2, 7))]
    return f"WITH {', '.join([*parts, *merged])} {last}"


def _polls(t) -> list[tuple[int, DataFrame, F.Column]]:
    """Every snapshot in order: its number, its rows, the time it was taken."""
    taken = t("seen_snapshots").groupBy("snapshot_no").agg(F.unix_micros(F.max("taken_at")).alias("us")).orderBy("snapshot_no").collect()  # a row a snapshot
    return [(r["snapshot_no"], _snapshot(t, r["snapshot_no"]), F.timestamp_micros(F.lit(r["us"]))) for r in taken]


@query(_fold_sql(
    """SELECT identity, coalesce(s.first_seen, now) AS first_seen, coalesce(s.published_at, n.published_at) AS published_at, coalesce(n.source, s.source) AS source, coalesce(s.board_id, n.board_id) AS board_id,
CASE WHEN n.here THEN now ELSE s.last_seen END AS last_seen FROM m{b} s FULL JOIN (SELECT *, true AS here FROM n{n}) n USING (identity) CROSS JOIN t{n}""",
    "SELECT identity, first_seen, published_at, source, board_id, last_seen FROM n1",
    "SELECT identity, epoch_us(first_seen) AS first_seen_us, epoch_us(published_at) AS published_us, source, board_id, epoch_us(last_seen) AS last_seen_us FROM m6"))
def seen_merge_all(t):
    """seen_merge of every snapshot in order, each a poll at its own time, into the store the first one is."""
    (_, store, _), *polls = _polls(t)
    for _, polled, now in polls:
        store = stores.merge_seen(store, polled, now)
    return store.select("identity", us("first_seen").alias("first_seen_us"), us("published_at").alias("published_us"), "source", "board_id", us("last_seen").alias("last_seen_us"))


@query(f"""WITH a AS ({" UNION ALL ".join(f"SELECT {n} AS snapshot_no, identity, nullif(trim(title), '') AS t, nullif(trim(location), '') AS l, nullif(trim(url), '') AS u FROM ({SQL_SNAPSHOT.format(n=n)})" for n in range(1, 7))})
SELECT x.snapshot_no, x.identity, CASE WHEN y.identity IS NULL THEN 'new' WHEN x.t IS NOT DISTINCT FROM y.t AND x.l IS NOT DISTINCT FROM y.l AND x.u IS NOT DISTINCT FROM y.u THEN 'unchanged' ELSE 'changed' END AS state
FROM a x LEFT JOIN a y ON x.identity = y.identity AND x.snapshot_no = y.snapshot_no + 1 WHERE x.snapshot_no > 1""")
def display_diff_all(t):
    """display_diff of each snapshot against the one before it."""
    diffs = [stores.differs(new, old, "identity", ["title", "location", "url"]).withColumn("snapshot_no", F.lit(n)) for (_, old, _), (n, new, _) in pairwise(_polls(t))]
    return reduce(DataFrame.unionByName, diffs).select("snapshot_no", "identity", "state")


@query(_fold_sql(
    "SELECT identity, CASE WHEN n.here THEN n.title ELSE s.title END AS title, CASE WHEN n.here THEN n.location ELSE s.location END AS location FROM m{b} s FULL JOIN (SELECT *, true AS here FROM n{n}) n USING (identity)",
    "SELECT identity, title, location FROM n1", "SELECT identity, title, location FROM m6"))
def as_written_merge_all(t):
    """as_written_merge of every snapshot in order."""
    columns = ["identity", "title", "location"]
    return reduce(lambda held, new: stores.as_written(held, new, "identity"), [shot.select(*columns) for _, shot, _ in _polls(t)])


@query("""SELECT identity, string_agg(DISTINCT store, ',' ORDER BY store) AS stores FROM (SELECT identity, 'a_job_rows' AS store FROM job_rows UNION ALL SELECT identity, 'b_incoming' FROM incoming_rows UNION ALL SELECT identity, 'c_groups' FROM group_rows) GROUP BY identity HAVING count(DISTINCT store) > 1""")
def exclusivity(t):
    return stores.in_several({"a_job_rows": t("job_rows"), "b_incoming": t("incoming_rows"), "c_groups": t("group_rows")}, "identity")


@query("""SELECT i.row_id, i.identity FROM (SELECT *, row_number() OVER (PARTITION BY identity ORDER BY arrived_at, row_id) AS rn FROM incoming_rows WHERE arrived_at >= TIMESTAMPTZ '2026-06-05 00:00:00+00') i WHERE rn = 1 AND identity NOT IN (SELECT identity FROM job_rows)""")
def health_outbox(t):
    return stores.outbox(t("incoming_rows").select("identity", "row_id", "arrived_at"), t("job_rows"), "identity", "arrived_at", F.lit("2026-06-05 00:00:00+00:00").cast("timestamp")).select("row_id", "identity")


@query("SELECT row_id, identity IN (SELECT identity FROM job_rows) AS acted_on FROM incoming_rows WHERE workplace = 'remote'")
def clearing_bound_confirm(t):
    acted, since = stores.confirmed(t("incoming_rows").where("workplace = 'remote'"), t("job_rows"), "identity")
    return acted.select("row_id", F.lit(True).alias("acted_on")).unionByName(since.select("row_id", F.lit(False).alias("acted_on")))


@query("""WITH h AS (SELECT p.posting_id, min((epoch_us(j.first_seen), j.row_id)) AS m FROM postings p JOIN job_rows j ON p.board_id = j.board_id AND epoch_us(j.first_seen) > epoch_us(p.fetched_at) AND epoch_us(j.first_seen) <= epoch_us(p.fetched_at) + 86400000000 GROUP BY p.posting_id)
SELECT p.posting_id, h.m[2] AS first_row_id FROM postings p LEFT JOIN h USING (posting_id)""")
def range_join_first(t):
    left = t("postings").select("posting_id", "board_id", "fetched_at")
    right = t("job_rows").select("board_id", "first_seen", "row_id")
    return stores.first_in_range(left, right, ["board_id"], "first_seen", "fetched_at", 1, ["first_seen", "row_id"], "posting_id").select("posting_id", "first_row_id")


# ---- groups

SQL_KEY = f"concat_ws('|', CASE WHEN {sql_fold('employer')} <> '' THEN {sql_fold('employer')} ELSE 'board:' || coalesce(board_id, '') END, {sql_fold('title_normalised')}, coalesce(strftime(published_at AT TIME ZONE 'UTC', '%Y-%m-%d'), ''))"
SQL_GROUPS = f"""SELECT k AS group_key, arg_min(identity, (coalesce(epoch_us(published_at), -4611686018427387904), identity)) AS representative, count(*) AS size,
coalesce(string_agg(DISTINCT CASE WHEN trim(location) <> '' THEN location END, chr(10) ORDER BY CASE WHEN trim(location) <> '' THEN location END), '') AS locations FROM (SELECT *, {SQL_KEY} AS k FROM job_rows) GROUP BY k"""


@query(SQL_GROUPS)
def dedupe_groups(t):
    return grouping.groups(t("job_rows"))


@query(f"SELECT CAST(sum(size) AS BIGINT) AS postings, count(*) AS groups, CAST(sum(size) AS BIGINT) - count(*) AS collapsed, max(size) AS largest FROM ({SQL_GROUPS})")
def dedupe_counts(t):
    return grouping.counts(grouping.groups(t("job_rows")))


@query("""SELECT g.group_id, CASE WHEN count(nullif(r.expires_at, '')) = count(*) THEN max(left(r.expires_at, 10)) END AS closed_on FROM (SELECT DISTINCT group_id, unnest(members) AS identity FROM row_groups) g JOIN group_rows r USING (identity) GROUP BY g.group_id""")
def group_closed_day(t):
    members = t("row_groups").select("group_id", F.explode("members").alias("identity")).distinct().join(t("group_rows"), "identity")
    return grouping.closed_on(members, "group_id", F.substring(F.nullif("expires_at", F.lit("")), 1, 10))


@query("""WITH a AS (SELECT row_id, workplace = 'hybrid' AS ok, 'employer' AS attribute, employer AS value FROM job_rows UNION ALL SELECT row_id, workplace = 'hybrid', 'title', title FROM job_rows UNION ALL SELECT row_id, workplace = 'hybrid', 'location', location FROM job_rows),
acc AS (SELECT * FROM a WHERE value <> '' AND ok), mine AS (SELECT * FROM a WHERE value <> ''),
byv AS (SELECT attribute, value, min(row_id) AS low, count(*) AS n FROM acc GROUP BY ALL), nxt AS (SELECT acc.attribute, acc.value, min(acc.row_id) AS next FROM acc JOIN byv USING (attribute, value) WHERE acc.row_id > low GROUP BY ALL)
SELECT m.row_id AS id, m.attribute, CASE WHEN b.low = m.row_id THEN x.next ELSE b.low END AS first_id, b.n - CASE WHEN m.ok THEN 1 ELSE 0 END AS n_accepted
FROM mine m JOIN byv b USING (attribute, value) LEFT JOIN nxt x USING (attribute, value) WHERE b.n - CASE WHEN m.ok THEN 1 ELSE 0 END > 0""")
def shared_attributes(t):
    """All rows against those accepted, which a person's mark stands for in use and hybrid work here."""
    rows = t("job_rows")
    attributes = {c: F.col(c) for c in ("employer", "title", "location")}
    return grouping.shared_attributes(rows, rows.where("workplace = 'hybrid'"), attributes, "row_id")


# ---- runs

@query("""WITH l AS (SELECT identity, max(board_id) AS board_id, max(taken_at) AS last_seen FROM seen_snapshots GROUP BY identity), r AS (SELECT DISTINCT board_id, taken_at FROM seen_snapshots),
x AS (SELECT l.identity, r.taken_at, row_number() OVER (PARTITION BY l.identity ORDER BY r.taken_at) AS rn FROM l JOIN r ON l.board_id = r.board_id AND r.taken_at > l.last_seen)
SELECT l.identity, epoch_us(x.taken_at) AS closed_us FROM l LEFT JOIN x ON l.identity = x.identity AND x.rn = 2""")
def closure_nth_absence(t):
    last = t("seen_snapshots").groupBy("identity").agg(F.max("board_id").alias("board_id"), F.max("taken_at").alias("last_seen"))
    polled = t("seen_snapshots").select("board_id", F.col("taken_at").alias("run_at")).distinct()
    return runs.nth_absence(last, polled, 2).select("identity", us("closed_at").alias("closed_us"))


SQL_RUNS = "SELECT user_id, date_trunc('day', ts) AS run_day, count(*) FILTER (WHERE event_type = 'error') = 0 AS ok, count(*) AS n FROM events GROUP BY ALL"


def _event_runs(t) -> DataFrame:
    return t("events").groupBy("user_id", F.date_trunc("day", "ts").alias("run_day")).agg((F.count_if(F.col("event_type") == "error") == 0).alias("ok"), F.count("*").alias("n"))


@query(f"WITH r AS ({SQL_RUNS}), l AS (SELECT user_id, max(CASE WHEN ok THEN run_day END) AS good FROM r GROUP BY user_id) SELECT r.user_id, count(*) FILTER (WHERE good IS NULL OR run_day > good) AS streak, epoch_us(min(CASE WHEN good IS NULL OR run_day > good THEN run_day END)) AS since_us FROM r JOIN l USING (user_id) GROUP BY r.user_id")
def failing_streak(t):
    return runs.trailing_streak(_event_runs(t), "user_id", "run_day", F.col("ok")).select("user_id", "streak", us("since").alias("since_us"))


@query(f"WITH r AS ({SQL_RUNS}), i AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY run_day) AS island FROM r), s AS (SELECT user_id, island, count(*) FILTER (WHERE NOT ok) AS n FROM i GROUP BY ALL) SELECT user_id, max(n) AS longest FROM s GROUP BY user_id")
def longest_streak(t):
    return runs.longest_streaks(_event_runs(t), "user_id", "run_day", ~F.col("ok"))


@query(f"SELECT user_id, epoch_us(run_day) AS run_us, epoch_us(lag(run_day) OVER (PARTITION BY user_id ORDER BY run_day)) AS previous_us FROM ({SQL_RUNS})")
def previous_run(t):
    return runs.previous_run(_event_runs(t), "user_id", "run_day").select("user_id", us("run_day").alias("run_us"), us("previous").alias("previous_us"))


@query("""SELECT source, count(*) AS n, min(h) AS min_v, median(h) AS median_v, quantile_disc(h, 0.9) AS p90_v, max(h) AS max_v FROM (SELECT source, (epoch_us(first_seen) - epoch_us(published_at)) / 3600000000.0 AS h FROM job_rows) WHERE h IS NOT NULL GROUP BY source""")
def spread_median_p90(t):
    return runs.spread(t("job_rows"), (us("first_seen") - us("published_at")) / 3_600_000_000.0, "source")


@query("""SELECT source, bucket, count(*) AS n FROM (SELECT source, CASE WHEN published_at IS NULL THEN 'undated' WHEN epoch_us(first_seen) - epoch_us(published_at) <= 86400000000 THEN 'day' WHEN epoch_us(first_seen) - epoch_us(published_at) <= 259200000000 THEN 'three days' ELSE 'later' END AS bucket FROM job_rows) GROUP BY ALL""")
def publication_lag(t):
    gap = us("first_seen") - us("published_at")
    bucket = F.when(gap.isNull(), "undated").when(gap <= 86_400_000_000, "day").when(gap <= 259_200_000_000, "three days").otherwise("later")
    return t("job_rows").groupBy("source", bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query("""SELECT source, row_id, hours, CAST(rn AS INTEGER) AS place FROM (SELECT source, row_id, (epoch_us(first_seen) - epoch_us(published_at)) / 3600000000.0 AS hours, row_number() OVER (PARTITION BY source ORDER BY epoch_us(first_seen) - epoch_us(published_at) DESC, row_id) AS rn FROM job_rows WHERE published_at IS NOT NULL) WHERE rn <= 5""")
def lag_examples_top5(t):
    hours = (us("first_seen") - us("published_at")) / 3_600_000_000.0
    rows = t("job_rows").where("published_at is not null").select("source", "row_id", hours.alias("hours"))
    ranked = rows.withColumn("place", F.row_number().over(W.partitionBy("source").orderBy(F.desc("hours"), "row_id")))
    return ranked.where("place <= 5")  # a top-k report


@query("""WITH k AS (SELECT source, batch_no, count(*) AS n, count(*) FILTER (WHERE identity NOT IN (SELECT identity FROM job_rows)) AS fresh FROM incoming_rows GROUP BY ALL) SELECT source, count(*) AS runs, count(*) FILTER (WHERE n = fresh) AS first_contacts FROM k GROUP BY source""")
def first_contact(t):
    known = t("job_rows").select("identity").distinct().withColumn("known", F.lit(True))
    return runs.first_contacts(t("incoming_rows").join(known, "identity", "left"), "batch_no", "source", F.col("known").isNull())


@query("""SELECT strftime(ts, '%Y-%m') AS month, event_type, epoch_us(date_trunc('day', ts)) AS day_us, sum(count(*)) OVER (PARTITION BY strftime(ts, '%Y-%m'), event_type ORDER BY date_trunc('day', ts)) AS month_to_date FROM events GROUP BY strftime(ts, '%Y-%m'), event_type, date_trunc('day', ts)""")
def month_to_date(t):
    per_day = t("events").groupBy(F.date_format("ts", "yyyy-MM").alias("month"), "event_type", F.date_trunc("day", "ts").alias("day")).agg(F.count("*").alias("n"))
    w = W.partitionBy("month", "event_type").orderBy("day")
    return per_day.select("month", "event_type", us("day").alias("day_us"), F.sum("n").over(w).alias("month_to_date"))


@query("""WITH d AS (SELECT DISTINCT snapshot_no FROM boards), b AS (SELECT DISTINCT board_id FROM boards), s AS (SELECT board_id, snapshot_no, max(len(poll_slots)) AS slots FROM boards GROUP BY ALL),
f AS (SELECT b.board_id, d.snapshot_no, last_value(s.slots IGNORE NULLS) OVER (PARTITION BY b.board_id ORDER BY d.snapshot_no) AS slots FROM d CROSS JOIN b LEFT JOIN s ON s.board_id = b.board_id AND s.snapshot_no = d.snapshot_no)
SELECT snapshot_no, CAST(sum(coalesce(slots, 0)) AS BIGINT) AS slots FROM f GROUP BY snapshot_no""")
def records_carried_forward(t):
    """A board absent from a snapshot counts with its last value: each value is added where it starts and taken off where the next one starts."""
    per = t("boards").groupBy("board_id", "snapshot_no").agg(F.max(F.when(F.col("poll_slots").isNotNull(), F.size("poll_slots"))).alias("slots")).where("slots is not null")
    before = F.lag("slots").over(W.partitionBy("board_id").orderBy("snapshot_no"))
    steps = per.select("snapshot_no", (F.col("slots") - F.coalesce(before, F.lit(0))).alias("step")).groupBy("snapshot_no").agg(F.sum("step").alias("step"))
    every = t("boards").select("snapshot_no").distinct().join(steps, "snapshot_no", "left")
    return every.select("snapshot_no", F.sum(F.coalesce("step", F.lit(0))).over(W.orderBy("snapshot_no")).alias("slots"))  # one row a snapshot


@query("""WITH b AS (SELECT DISTINCT identity FROM seen_snapshots WHERE snapshot_no = 6), s AS (SELECT DISTINCT identity FROM seen_snapshots WHERE snapshot_no = 5), w AS (SELECT identity, min(first_seen) AS since FROM seen_snapshots WHERE snapshot_no = 4 AND source IN ('lever', 'ashby') GROUP BY identity),
e AS (SELECT coalesce(b.identity, s.identity, w.identity) AS identity, b.identity IS NOT NULL AS ib, s.identity IS NOT NULL AS is_, w.identity IS NOT NULL AS iw, w.since FROM b FULL JOIN s ON b.identity = s.identity FULL JOIN w ON w.identity = coalesce(b.identity, s.identity))
SELECT identity, CASE WHEN is_ AND iw THEN 'returned' WHEN ib AND is_ THEN 'agrees' WHEN ib AND NOT iw THEN 'new' WHEN ib AND since <= TIMESTAMPTZ '2026-01-01 00:00:00+00' THEN 'disagreement' WHEN ib THEN 'waiting' WHEN iw THEN 'gone' END AS state FROM e WHERE ib OR iw""")
def agreement_states(t):
    s = t("seen_snapshots")
    waiting = s.where((F.col("snapshot_no") == 4) & F.col("source").isin("lever", "ashby")).select("identity", F.col("first_seen").alias("since"))
    return runs.agreement(s.where("snapshot_no = 6"), s.where("snapshot_no = 5"), waiting, F.lit("2026-01-01 12:00:00+00:00").cast("timestamp"), 12)


@query("SELECT board_id, arg_max(snapshot_no, (snapshot_no, coalesce(len(poll_slots), -1))) AS snapshot_no, arg_max(coalesce(len(poll_slots), -1), (snapshot_no, coalesce(len(poll_slots), -1))) AS slots, count(DISTINCT snapshot_no) AS times FROM boards GROUP BY board_id")
def latest_status(t):
    slots = F.when(F.col("poll_slots").isNull(), -1).otherwise(F.size("poll_slots"))
    last = F.max(F.struct(F.col("snapshot_no"), slots.alias("slots"))).alias("last")
    return t("boards").groupBy("board_id").agg(last, F.count_distinct("snapshot_no").alias("times")).select("board_id", "last.snapshot_no", "last.slots", "times")


@query("SELECT snapshot_no, count(*) AS n_rows, count(DISTINCT identity) AS identities FROM seen_snapshots WHERE snapshot_no IN (SELECT DISTINCT snapshot_no FROM seen_snapshots ORDER BY snapshot_no DESC LIMIT 3) GROUP BY snapshot_no")
def newest_runs(t):
    """The newest three runs, oldest first: a report of the last N, read once they are known."""
    s = t("seen_snapshots")
    newest = s.select("snapshot_no").distinct().orderBy(F.desc("snapshot_no")).limit(3)  # a last-N report
    return s.join(newest, "snapshot_no", "left_semi").groupBy("snapshot_no").agg(F.count("*").alias("n_rows"), F.count_distinct("identity").alias("identities")).orderBy("snapshot_no")


@query("SELECT source, coalesce(string_agg(CAST(batch_no AS VARCHAR), ',' ORDER BY batch_no) FILTER (WHERE n > 60), '') AS over_ceiling, max(n) AS most FROM (SELECT source, batch_no, count(*) AS n FROM incoming_rows GROUP BY ALL) GROUP BY source")
def ceiling_stops(t):
    per = t("incoming_rows").groupBy("source", "batch_no").agg(F.count("*").alias("n"))
    over = F.array_sort(F.collect_list(F.when(F.col("n") > 60, F.col("batch_no"))))
    return per.groupBy("source").agg(F.array_join(over, ",").alias("over_ceiling"), F.max("n").alias("most"))


# ---- shapes of payloads

def _shapes(t, low: bool) -> DataFrame:
    records = t("feed_records")
    pick = F.min if low else F.max
    file = records.groupBy("feed_id").agg(pick("file_no").alias("file_no"))
    some = records.join(file, ["feed_id", "file_no"])
    return shapes.shape(drift.fields(some).where("path <> ''"), some, "feed_id")


SQL_TOP = """SELECT r.feed_id, r.file_no, r.record_id, k.key AS path, json_type(r.payload::JSON, '$."' || k.key || '"') AS jt FROM (SELECT *, unnest(json_keys(payload)) AS key FROM feed_records) r JOIN (SELECT DISTINCT unnest(json_keys(payload)) AS key FROM feed_records) k ON r.key = k.key"""
SQL_SHAPE = """SELECT c.feed_id, c.path, CASE WHEN count(DISTINCT c.record_id) = any_value(a.n) THEN 'all' ELSE 'some' END AS present, CASE WHEN count(*) FILTER (WHERE jt = 'NULL') = 0 THEN 'never' WHEN count(*) FILTER (WHERE jt = 'NULL') = count(*) THEN 'always' ELSE 'some' END AS nulls
FROM ({top}) c JOIN (SELECT feed_id, {pick}(file_no) AS file_no FROM feed_records GROUP BY feed_id) f USING (feed_id, file_no) JOIN (SELECT feed_id, file_no, count(DISTINCT record_id) AS n FROM feed_records GROUP BY ALL) a USING (feed_id, file_no) GROUP BY c.feed_id, c.path"""


@query(SQL_SHAPE.format(top=SQL_TOP, pick="max"))
def shape_fingerprint(t):
    return _shapes(t, False).where(~F.contains("path", F.lit("."))).select("feed_id", "path", "present", "nulls")


@query(f"""WITH o AS ({SQL_SHAPE.format(top=SQL_TOP, pick="min")}), n AS ({SQL_SHAPE.format(top=SQL_TOP, pick="max")}) SELECT feed_id, path, coalesce(o.present || '/' || o.nulls, 'absent') AS was_shape, coalesce(n.present || '/' || n.nulls, 'absent') AS is_shape
FROM o FULL JOIN n USING (feed_id, path) WHERE coalesce(o.present || '/' || o.nulls, 'absent') <> coalesce(n.present || '/' || n.nulls, 'absent')""")
def contract_compare(t):
    top = ~F.contains("path", F.lit("."))
    old, new = (_shapes(t, low).where(top).withColumn("types", F.lit(None).cast("string")) for low in (True, False))
    return shapes.compare(old, new, "feed_id")


def _fingerprints(records: DataFrame) -> DataFrame:
    """The shape of every path, with its types, in every file of a feed, over the file's readable records."""
    cells = materialize(shapes.members(records, "feed_id", "file_no"), "members")
    return shapes.shape(cells.where("path <> ''"), cells.where("path = ''"), "feed_id", "file_no")


@query()
def shape_fingerprint_all(t):
    """shape_fingerprint of every file and path, nested ones too, with types; paths into arrays are beyond its SQL."""
    return _fingerprints(t("feed_records"))


@query()
def contract_compare_all(t):
    """contract_compare over every path and types: each file against the one before it, and a feed's last against its first."""
    records = t("feed_records").select("feed_id", F.col("file_no").cast("long").alias("file_no"), "record_id", "payload")
    prints = materialize(_fingerprints(records), "fingerprints")
    order = drift.file_order(records).select("feed_id", F.col("before").cast("long").alias("before"), F.col("file_no").cast("long").alias("file_no")).where("before is not null")
    ends = records.groupBy("feed_id").agg(F.min("file_no").alias("before"), F.max("file_no").alias("file_no")).where("before < file_no")
    pairs = order.unionByName(ends).distinct()
    old, new = (prints.withColumnRenamed("file_no", side).join(pairs, ["feed_id", side]) for side in ("before", "file_no"))
    return shapes.compare(old, new, "feed_id", "before", "file_no")


@query("""WITH c AS (SELECT platform, board_id AS path FROM boards GROUP BY ALL), a AS (SELECT platform, unnest([board_id]) AS path, snapshot_no AS position, 'slots ' || len(poll_slots) AS cause FROM boards WHERE snapshot_day < DATE '2026-02-01' AND poll_slots IS NOT NULL),
f AS (SELECT platform, path, arg_min(cause, (position, cause)) AS cause FROM a GROUP BY ALL) SELECT c.platform, c.path, f.cause FROM c LEFT JOIN f USING (platform, path)""")
def rebaseline_first_match(t):
    b = t("boards")
    changes = b.select("platform", F.col("board_id").alias("path")).distinct()
    cause = F.concat(F.lit("slots "), F.size("poll_slots").cast("string"))
    accepted = b.where("poll_slots is not null").select("platform", F.array("board_id").alias("paths"), F.col("snapshot_day").alias("accepted_at"), cause.alias("cause"), F.struct(F.col("snapshot_no").alias("n"), cause.alias("c")).alias("position"))
    return shapes.explained(changes, accepted, "platform", F.lit("2026-02-01").cast("date")).select("platform", "path", "cause")


@query()
def description_leaks(t):
    """Page members that hold long or marked-up text: what a public copy must not carry."""
    return jsonwalk.text_leaks(shred.adjacency(t("raw_pages")), "page_id", ("content", "description"))


@query("""SELECT record_id, CASE WHEN json_type(payload, '$.salaryRange.min') IN ('DOUBLE', 'UBIGINT', 'BIGINT') THEN CAST(CAST(json_extract_string(payload, '$.salaryRange.min') AS BIGINT) AS VARCHAR) ELSE json_extract_string(payload, '$.salaryRange.min') END AS salary_min, json_extract_string(payload, '$.title') AS title FROM feed_records""")
def json_resolve(t):
    return t("feed_records").select("record_id", jsonwalk.resolved(F.col("payload"), "salaryRange.min").alias("salary_min"), jsonwalk.resolved(F.col("payload"), "title").alias("title"))


@query()
def json_sanitised(t):
    return t("raw_pages").select("page_id", jsonwalk.sanitise(F.col("payload"), ("content", "text")).alias("payload"))


@query("SELECT row_id, CASE WHEN source IN ('greenhouse','lever','ashby','workable','smartrecruiters','manatal') THEN 'public' ELSE 'private' END AS source_class, replace(url, 'example', '***') AS url FROM job_rows")
def routed_rows(t):
    rows = publish.routed(t("job_rows"), "source", PUBLIC)
    return rows.select("row_id", "source_class", publish.redact(F.col("url"), ["example"]).alias("url"))


@query("SELECT board_id, CASE WHEN coalesce(len(poll_slots), 0) = 0 THEN true ELSE list_contains(poll_slots, '08:00') END AS due, coalesce(list_contains(deep_slots, '08:00'), false) AS deep FROM boards WHERE snapshot_no = 6 AND (coalesce(len(poll_slots), 0) = 0 OR list_contains(poll_slots, '08:00'))")
def boards_due(t):
    return config.boards_due(t("boards").where("snapshot_no = 6"), "08:00").select("board_id", F.lit(True).alias("due"), "deep")


# ---- sources

SQL_RAW = """WITH v AS (SELECT page_id, source, board_id, payload::JSON AS j FROM raw_pages WHERE json_valid(payload) AND source = '{source}'), p AS (SELECT page_id, board_id, unnest(CASE WHEN json_type(j, '{path}') = 'ARRAY' THEN CAST(json_extract(j, '{path}') AS JSON[]) ELSE [j] END) AS p FROM v)"""


@query(SQL_RAW.format(source="greenhouse", path="$.jobs") + """ SELECT page_id, json_extract_string(p, '$.id') AS external_id, json_extract_string(p, '$.title') AS title, json_extract_string(p, '$.absolute_url') AS url, json_extract_string(p, '$.company_name') AS employer, epoch_us(TRY_CAST(json_extract_string(p, '$.first_published') AS TIMESTAMPTZ)) AS published_us, json_extract_string(p, '$.location.name') AS location FROM p WHERE json_extract_string(p, '$.title') IS NOT NULL""")
def source_greenhouse(t):
    rows = platforms.parse(t("raw_pages"), "greenhouse").where("problem is null")
    return rows.select("page_id", "external_id", "title", "url", "employer", us("published_at").alias("published_us"), "location")


@query(SQL_RAW.format(source="lever", path="$") + """ SELECT page_id, json_extract_string(p, '$.id') AS external_id, json_extract_string(p, '$.text') AS title, json_extract_string(p, '$.hostedUrl') AS url, CAST(json_extract_string(p, '$.createdAt') AS BIGINT) * 1000 AS published_us, json_extract_string(p, '$.categories.location') AS location FROM p WHERE json_extract_string(p, '$.text') IS NOT NULL""")
def source_lever(t):
    rows = platforms.parse(t("raw_pages"), "lever").where("problem is null")
    return rows.select("page_id", "external_id", "title", "url", us("published_at").alias("published_us"), "location")


@query(SQL_RAW.format(source="smartrecruiters", path="$.content") + """ SELECT page_id, json_extract_string(p, '$.id') AS external_id, json_extract_string(p, '$.name') AS title, json_extract_string(p, '$.company.name') AS employer, epoch_us(TRY_CAST(json_extract_string(p, '$.releasedDate') AS TIMESTAMPTZ)) AS published_us FROM p WHERE json_extract_string(p, '$.name') IS NOT NULL""")
def source_smartrecruiters(t):
    rows = platforms.parse(t("raw_pages"), "smartrecruiters").where("problem is null")
    return rows.select("page_id", "external_id", "title", "employer", us("published_at").alias("published_us"))


def _sql_records() -> str:
    """Every record of the three platforms' pages with what the parsers read, in SQL."""
    fields = {  # id, title, url, employer, raw date, readable date, place
        "greenhouse": ("$.jobs", "$.title", "json_extract_string(p, '$.absolute_url')", "json_extract_string(p, '$.company_name')", "json_extract_string(p, '$.first_published')", _SQL_ISO.format(c="json_extract_string(p, '$.first_published')"), "json_extract_string(p, '$.location.name')"),
        "lever": ("$", "$.text", "json_extract_string(p, '$.hostedUrl')", "CAST(NULL AS VARCHAR)", "json_extract_string(p, '$.createdAt')", "CASE WHEN TRY_CAST(json_extract_string(p, '$.createdAt') AS BIGINT) BETWEEN 1000000000000 AND 4000000000000 THEN CAST(json_extract_string(p, '$.createdAt') AS BIGINT) * 1000 END", "json_extract_string(p, '$.categories.location')"),
        "smartrecruiters": ("$.content", "$.name", "'https://' || replace(lower(board_id), ':', '.example/') || '/' || json_extract_string(p, '$.id')", "json_extract_string(p, '$.company.name')", "json_extract_string(p, '$.releasedDate')", _SQL_ISO.format(c="json_extract_string(p, '$.releasedDate')"),
                            "coalesce(nullif(array_to_string(list_filter(list_transform(string_split(json_extract_string(p, '$.location.fullLocation'), ','), lambda x: trim(x)), lambda x, i: x <> '' AND list_position(list_transform(string_split(json_extract_string(p, '$.location.fullLocation'), ','), lambda y: trim(y)), x) = i), ', '), ''), json_extract_string(p, '$.location.city'))"),
    }
    parts = []
    for source, (path, title, url, employer, raw, date, place) in fields.items():
        listed = f"CASE WHEN json_type(j, '{path}') = 'ARRAY' THEN CAST(json_extract(j, '{path}') AS JSON[]) WHEN json_type(j) = 'OBJECT' THEN [j] ELSE [] END"
        parts.append(f"SELECT page_id, source, board_id, pos, {_sql_text('$.id')} AS external_id, {_sql_text(title)} AS title, {url} AS url, {_tidy(employer)} AS employer, {raw} AS raw, {date} AS published_us, {_tidy(place)} AS location, json_type(p) AS kind FROM (SELECT page_id, source, board_id, unnest({listed}) AS p, generate_subscripts({listed}, 1) AS pos FROM (SELECT page_id, source, board_id, payload::JSON AS j FROM raw_pages WHERE json_valid(payload) AND source = '{source}'))")
    union = " UNION ALL ".join(parts)
    return f"""SELECT r.* EXCLUDE (employer), coalesce(r.employer, a.alias) AS employer, CASE WHEN kind IS DISTINCT FROM 'OBJECT' THEN 'not an object' WHEN external_id IS NULL THEN 'no id' WHEN title IS NULL THEN 'no title' WHEN NOT coalesce(regexp_matches(lower(url), '^https?://'), false) THEN 'url not absolute' WHEN raw IS NOT NULL AND published_us IS NULL THEN 'unreadable date' END AS problem
FROM ({union}) r LEFT JOIN (SELECT board_id, max(employer_alias) AS alias FROM boards GROUP BY 1) a USING (board_id)"""


_SQL_ISO = r"CASE WHEN regexp_matches({c}, '^\d{{4}}-\d{{2}}-\d{{2}}[T ]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d+)?)?\s*(Z|[+-]\d{{2}}:?\d{{2}})$') THEN epoch_us(TRY_CAST({c} AS TIMESTAMPTZ)) END"


def _tidy(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '\\s+', ' ', 'g')), '')"


def _sql_text(path: str) -> str:
    return _tidy(f"json_extract_string(p, '{path}')")


@query(f"SELECT source, coalesce(problem, 'none') AS problem, count(*) AS n FROM ({_sql_records()}) GROUP BY ALL")
def source_problems(t):
    """Every record that is no posting, with its reason, and rows for canonical output counted beside."""
    rows = platforms.parse_all(t("raw_pages"), ["greenhouse", "lever", "smartrecruiters"], t("boards"))
    return rows.groupBy("source", F.coalesce("problem", F.lit("none")).alias("problem")).agg(F.count("*").alias("n"))


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY page_id, external_id ORDER BY pos) AS rn FROM ({_sql_records()})), k AS (SELECT identity, min(first_seen) AS seen FROM seen_snapshots GROUP BY 1)
SELECT source || ':' || external_id AS identity, source, board_id, external_id, employer, title, location, published_us, epoch_us(coalesce(seen, TIMESTAMPTZ '2026-06-15 00:00:00+00')) AS first_seen_us, coalesce(published_us, epoch_us(coalesce(seen, TIMESTAMPTZ '2026-06-15 00:00:00+00'))) AS ordering_us, CASE WHEN published_us IS NULL THEN 'first_seen' ELSE 'publication' END AS ordering_date_source, url
FROM r LEFT JOIN k ON k.identity = source || ':' || external_id WHERE rn = 1 AND problem IS NULL""")
def canonical_rows(t):
    """Postings of all pages as canonical rows; first_seen is kept for identities the seen store knows."""
    rows = platforms.distinct_in_page(platforms.parse_all(t("raw_pages"), ["greenhouse", "lever", "smartrecruiters"], t("boards")))
    rows = platforms.to_rows(rows, t("seen_snapshots"), F.lit("2026-06-15 00:00:00+00:00").cast("timestamp"))
    return rows.select("identity", "source", "board_id", "external_id", "employer", "title", "location", us("published_at").alias("published_us"), us("first_seen").alias("first_seen_us"), us("ordering_date").alias("ordering_us"), "ordering_date_source", "url")


# ---- arrays, maps, sets

@query("""SELECT row_id, coalesce(list_max(stated_experience), -1) AS most, coalesce(array_to_string(list_sort(list_distinct(places)), '; '), '') AS places, len(list_filter(coalesce(stated_levels, []), lambda x: x = 'Senior')) > 0 AS any_senior,
coalesce(array_to_string(list_sort(list_distinct(list_filter(places, lambda x: NOT list_contains(coalesce(required_places, []), x)))), ','), '') AS not_required FROM job_rows""")
def array_forms(t):
    none = F.array().cast("array<string>")
    return t("job_rows").select(
        "row_id", F.coalesce(F.array_max("stated_experience"), F.lit(-1)).alias("most"), F.coalesce(F.array_join(F.array_sort(F.array_distinct("places")), "; "), F.lit("")).alias("places"),
        F.exists(F.coalesce("stated_levels", none), lambda x: x == "Senior").alias("any_senior"), F.coalesce(F.array_join(F.array_sort(F.array_except("places", F.coalesce("required_places", none))), ","), F.lit("")).alias("not_required"),
    )


@query("""SELECT board_id, string_agg(source || '=' || n, ',' ORDER BY source) AS counts FROM (SELECT board_id, source, count(*) AS n FROM (SELECT board_id, source FROM job_rows UNION ALL SELECT board_id, source FROM incoming_rows) GROUP BY ALL) GROUP BY board_id""")
def counts_map(t):
    rows = t("job_rows").select("board_id", "source").unionByName(t("incoming_rows").select("board_id", "source"))
    m = rows.groupBy("board_id", "source").agg(F.count("*").alias("n")).groupBy("board_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "n")))).alias("m"))
    return m.select("board_id", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("counts"))


@query("SELECT identity FROM job_rows UNION SELECT identity FROM seen_snapshots")
def set_union(t):
    return t("job_rows").select("identity").union(t("seen_snapshots").select("identity")).distinct()


@query("SELECT identity FROM job_rows INTERSECT SELECT identity FROM incoming_rows")
def set_intersect(t):
    return t("job_rows").select("identity").intersect(t("incoming_rows").select("identity"))


@query("SELECT board_id FROM job_rows EXCEPT SELECT board_id FROM boards")
def set_except(t):
    return t("job_rows").select("board_id").subtract(t("boards").select("board_id"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_type(props, '$.k') IS NOT NULL AS present FROM events")
def json_path(t):
    v = F.try_parse_json("props")
    return t("events").select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"), F.try_variant_get(v, "$.k", "variant").isNotNull().alias("present"))


# ---- descriptions

@query("SELECT doc_id, list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)*\\.[A-Za-z]{2,}'), lambda x: lower(x)))[1] AS first_email, len(list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)*\\.[A-Za-z]{2,}'), lambda x: lower(x)))) AS emails FROM documents WHERE regexp_matches(text, '@')")
def emails_extract(t):
    rows = t("documents").where(F.contains("text", F.lit("@"))).select("doc_id", D.emails(F.col("text")).alias("e"))
    return rows.select("doc_id", F.get("e", F.lit(0)).alias("first_email"), F.size("e").cast("long").alias("emails"))


@query()
def description_facts(t):
    """Lines, on-site and years asked of every document; offsets and entities are beyond SQL."""
    rows = t("documents").select("doc_id", "text", D.lines_of(F.col("text")).alias("lines"))
    return rows.select("doc_id", F.size("lines").alias("n_lines"), D.says_on_site(F.col("lines"), F.col("text")).alias("on_site"), D.years_asked(F.col("lines"), F.col("text")).alias("years"))


# ---- streams

@query("SELECT identity, min(row_id) IS NOT NULL AS held FROM (SELECT identity, row_id FROM incoming_rows) GROUP BY identity")
def stream_delta(t):
    """incoming_rows as a stream of files, delta-appended into a fresh layer: every identity once."""
    layer = ingest.delta_layer(t("incoming_rows").select("row_id", "identity", "source", "board_id"), "identity")
    return layer.select("identity", F.lit(True).alias("held"))


@query("SELECT identity, epoch_us(min(last_seen)) AS first_us, epoch_us(max(last_seen)) AS last_us, count(*) AS times FROM seen_snapshots GROUP BY identity")
def stream_seen_state(t):
    """The snapshots as a stream: per identity, in custom keyed state, when it was first and last seen and how often delivered."""
    out = ingest.seen_states(t("seen_snapshots").select("identity", "last_seen"), "identity", "last_seen")
    return out.select("identity", us("first_seen").alias("first_us"), us("last_seen").alias("last_us"), "times")


@query("SELECT event_type, count(*) AS n FROM (SELECT DISTINCT event_id, event_type FROM events) GROUP BY event_type")
def stream_distinct_counts(t):
    return ingest.distinct_counts(t("events").select("event_id", "event_type"), "event_id", "event_type")
