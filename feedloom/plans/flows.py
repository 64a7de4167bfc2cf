"""Queries of whole flows and their reports: polls, run logs, plan, backfill, facts, contract checks, events; each with SQL.

A run here is a snapshot of the seen store and the boards of its configuration: its run log is built, written, read back
and reported on. What no table holds (a fetch that fails, a configuration file) is a small script with its expected rows.
"""

from __future__ import annotations

import datetime
import json
import tempfile
from collections.abc import Callable, Sequence
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import descriptions as D
from feedloom.functions import text as T
from feedloom.operators import chain, drift, flow, publish, runlog, runs, shapes, stores
from feedloom.plans import reference as R
from feedloom.plans.reference import us
from feedloom.session import materialize, scratch_path
from feedloom.sources import config, fetching, platforms
from feedloom.streaming import ingest

_Q: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a query of (tables) under its function's name; sql gives the same rows."""

    def add(f: Callable) -> Callable:
        def run(spark: SparkSession, d: str) -> DataFrame:
            def table(name: str) -> DataFrame:
                return spark.read.parquet(f"{d}/{name}.parquet")

            table.spark = spark
            return f(table)

        _Q[f.__name__] = run
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def values(columns: str, rows: Sequence[tuple]) -> str:
    """SQL of given rows: what a script over invented input must give."""
    lit = lambda x: "NULL" if x is None else str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, (int, float)) else "'" + str(x).replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS t({columns})"


# ---- run logs

BUDGET = 120
SQL_POLLS = f"""c AS (SELECT DISTINCT snapshot_no, board_id, platform AS source FROM boards), r AS (SELECT snapshot_no, max(taken_at) AS run_at FROM seen_snapshots GROUP BY 1),
f AS (SELECT identity, min(snapshot_no) AS first_no FROM seen_snapshots GROUP BY 1),
s AS (SELECT snapshot_no, board_id, count(DISTINCT identity) AS fetched, count(DISTINCT CASE WHEN first_no = snapshot_no THEN identity END) AS new, min(published_at) AS mark FROM seen_snapshots JOIN f USING (identity) GROUP BY 1, 2),
polls AS (SELECT run_at, board_id, c.source, CASE WHEN s.fetched IS NOT NULL THEN 'ok' WHEN length(board_id) % 3 = 0 THEN 'failed' WHEN length(board_id) % 3 = 1 THEN 'not reached' ELSE 'ok' END AS status, 1 + coalesce(s.fetched, 0) // 10 AS requests, coalesce(s.fetched, 0) AS fetched, coalesce(s.new, 0) AS new,
CASE WHEN s.fetched < 5 THEN 'end' WHEN s.fetched IS NOT NULL THEN 'mark' END AS stopped_by, s.mark FROM c JOIN r USING (snapshot_no) LEFT JOIN s USING (snapshot_no, board_id))"""


def _polls(t) -> DataFrame:
    """A poll of each configured board in each snapshot: what it delivered, or why not (by the length of its name)."""
    seen = t("seen_snapshots")
    first = seen.groupBy("identity").agg(F.min("snapshot_no").alias("first_no"))
    got = seen.join(first, "identity").groupBy("snapshot_no", "board_id").agg(F.count_distinct("identity").alias("fetched"), F.count_distinct(F.when(F.col("first_no") == F.col("snapshot_no"), F.col("identity"))).alias("new"), F.min("published_at").alias("mark"))
    when = seen.groupBy("snapshot_no").agg(F.max("taken_at").alias("run_at"))
    boards = t("boards").select("snapshot_no", "board_id", F.col("platform").alias("source")).distinct()
    rows = boards.join(when, "snapshot_no").join(got, ["snapshot_no", "board_id"], "left")
    kind = F.length("board_id") % 3
    status = F.when(F.col("fetched").isNotNull(), "ok").when(kind == 0, "failed").when(kind == 1, "not reached").otherwise("ok")
    n = F.coalesce("fetched", F.lit(0))
    stopped = F.when(F.col("fetched") < 5, "end").when(F.col("fetched").isNotNull(), "mark")
    return rows.select("run_at", "board_id", "source", status.alias("status"), (1 + F.floor(n / 10)).alias("requests"), n.alias("fetched"), F.coalesce("new", F.lit(0)).alias("new"), stopped.alias("stopped_by"), "mark", F.lit("").alias("detail"))


def _logs(t, **how) -> DataFrame:
    """The run logs of _polls(), written as JSON and read back."""
    folder = scratch_path(t.spark, "runlogs")
    runlog.write(runlog.assemble(_polls(t), BUDGET), folder)
    return runlog.read(t.spark, folder, **how)


@query(f"""WITH {SQL_POLLS} SELECT epoch_us(run_at) AS run_us, CAST(sum(requests) AS BIGINT) AS requests_used, CAST(sum(fetched) AS BIGINT) AS fetched, CAST(sum(new) AS BIGINT) AS new, count(*) FILTER (WHERE status NOT IN ('ok', 'skipped')) AS failed, count(*) AS boards, CASE WHEN sum(requests) >= {BUDGET} THEN 'request ceiling' END AS stopped FROM polls GROUP BY run_at""")
def runlog_totals(t):
    return _logs(t).select(us("run_at").alias("run_us"), "requests.requests_used", "totals.fetched", "totals.new", "totals.failed", F.size("boards").cast("long").alias("boards"), "stopped")


@query(f"WITH {SQL_POLLS} SELECT epoch_us(run_at) AS run_us, count(*) AS boards FROM polls WHERE run_at IN (SELECT DISTINCT run_at FROM polls ORDER BY run_at DESC LIMIT 3) GROUP BY run_at")
def runlog_newest(t):
    """The newest three logs."""
    return _logs(t, last=3).select(us("run_at").alias("run_us"), F.size("boards").cast("long").alias("boards"))


@query(f"WITH {SQL_POLLS} SELECT epoch_us(run_at) AS run_us, count(*) AS boards FROM polls WHERE strftime(run_at AT TIME ZONE 'UTC', '%Y-%m') = '2026-06' GROUP BY run_at")
def runlog_month(t):
    """The logs of one month, from that month's folder alone."""
    return _logs(t, month="2026-06").select(us("run_at").alias("run_us"), F.size("boards").cast("long").alias("boards"))


@query("WITH r AS (SELECT DISTINCT taken_at FROM seen_snapshots) SELECT 'kept' AS problem, count(*) FILTER (WHERE taken_at >= TIMESTAMPTZ '2026-06-20 00:00:00+00') AS n FROM r UNION ALL SELECT 'before since', count(*) FILTER (WHERE taken_at < TIMESTAMPTZ '2026-06-20 00:00:00+00') FROM r UNION ALL SELECT 'other mode', 1 UNION ALL SELECT 'unreadable', 2")
def runlog_usable(t):
    """Logs of another mode, from before a day, and lines that are no log are counted apart."""
    folder = scratch_path(t.spark, "runlogs")
    logs = runlog.assemble(_polls(t), BUDGET)
    runlog.write(logs, folder)
    runlog.write(logs.orderBy("run_at").limit(1).withColumn("test_mode", F.lit(True)), folder)
    broken = t.spark.createDataFrame([("{broken", "2026-06"), ('{"test_mode": false}', "2026-06")], "value string, month string")
    broken.write.mode("append").partitionBy("month").text(folder)
    kept, other = runlog.usable(runlog.read(t.spark, folder), False, F.lit("2026-06-20 00:00:00+00:00").cast("timestamp"))
    return kept.agg(F.count("*").alias("n")).select(F.lit("kept").alias("problem"), "n").unionByName(other)


@query(f"""WITH {SQL_POLLS}, l AS (SELECT board_id, max(CASE WHEN status = 'ok' AND fetched > 0 THEN run_at END) AS good, max(run_at) AS newest FROM polls GROUP BY 1)
SELECT p.board_id AS board, count(*) AS runs, epoch_us(min(run_at)) AS since_us, (epoch_us(max(newest)) - epoch_us(min(run_at))) / 86400000000.0 AS days, string_agg(DISTINCT status, ',' ORDER BY status) AS statuses FROM polls p JOIN l USING (board_id) WHERE good IS NULL OR run_at > good GROUP BY p.board_id""")
def quiet_boards(t):
    """The streak back from each board's newest run."""
    quiet = runlog.quiet_boards(runlog.board_runs(_logs(t)))
    return quiet.select("board", "runs", us("since").alias("since_us"), "days", F.array_join("statuses", ",").alias("statuses"))


@query(f"""WITH {SQL_POLLS}, a AS (SELECT source, CAST(sum(requests) AS BIGINT) AS requests FROM polls GROUP BY 1), m AS (SELECT source, run_at, sum(fetched) AS f, sum(new) AS n FROM polls GROUP BY ALL)
SELECT a.source, a.requests, count(m.run_at) FILTER (WHERE f > 0) AS runs, count(*) FILTER (WHERE f > 0 AND f = n) AS first_contacts FROM a LEFT JOIN m USING (source) GROUP BY ALL""")
def sources_report(t):
    """Requests by source, and the runs on which all that a source delivered was new."""
    return runlog.per_source(_logs(t), t("boards").select(F.col("board_id").alias("board"), F.col("platform").alias("source")).distinct())


@query(f"WITH {SQL_POLLS} SELECT epoch_us(run_at) AS run_us, CASE WHEN sum(requests) >= {BUDGET} THEN 'request ceiling' END AS stopped, CAST(count(*) FILTER (WHERE status = 'not reached') AS INTEGER) AS not_reached FROM polls GROUP BY run_at HAVING sum(requests) >= {BUDGET} OR count(*) FILTER (WHERE status = 'not reached') > 0")
def runlog_stops(t):
    return runlog.stops(_logs(t)).select(us("run_at").alias("run_us"), "stopped", "not_reached")


@query(f"WITH {SQL_POLLS} SELECT epoch_us(run_at) AS run_us, printf('%d boards, %d fetched, %d new, %d requests of {BUDGET}', count(*), CAST(sum(fetched) AS BIGINT), CAST(sum(new) AS BIGINT), CAST(sum(requests) AS BIGINT)) || coalesce('; ' || string_agg(board_id || ' ' || status, ', ' ORDER BY board_id) FILTER (WHERE status NOT IN ('ok', 'skipped')), '') AS line FROM polls GROUP BY run_at")
def run_summary(t):
    return runlog.summary(_logs(t)).select(us("run_at").alias("run_us"), "line")


@query(f"WITH {SQL_POLLS}, l AS (SELECT board_id, max(CASE WHEN status = 'ok' THEN run_at END) AS good FROM polls GROUP BY 1) SELECT board_id AS board, count(*) AS streak, count(*) >= 3 OR bool_or(status = 'not reached') AS escalate FROM polls JOIN l USING (board_id) WHERE good IS NULL OR run_at > good GROUP BY board_id")
def escalations(t):
    """Boards that fail now: after three runs in a row, or at once where they were not reached."""
    return runlog.escalations(runlog.board_runs(_logs(t)), "board", F.col("status") != "ok", F.col("status") == "not reached")


@query("SELECT event_id, json_extract_string(props, '$.k') = '3' OR event_type = 'error' AS attention FROM events")
def needs_attention(t):
    """Runs any of whose parts failed: here an event's own failure, or one its properties name."""
    display = F.struct(F.when(F.col("event_type") == "error", "failed").otherwise("").alias("failure"))
    sweep = F.struct(F.when(F.get_json_object("props", "$.k") == "3", "failed").alias("failure"))
    return t("events").select("event_id", display.alias("display"), sweep.alias("sweep")).select("event_id", runlog.needs_attention("display", "sweep").alias("attention"))


@query("SELECT count(*) AS month_to_date, 5000 AS allowance, round(count(*) / 5000.0, 3) AS share, CASE WHEN count(*) > 0.5 * 5000 THEN 'calls are at ' || count(*) || ' of 5000, past 50% before day 25' END AS warning FROM events WHERE ts <= TIMESTAMP '2024-01-20 12:00:00'")
def budget_line(t):
    """Calls of the month to date against an allowance; an event stands for a call."""
    calls = t("events").select(F.col("ts").cast("timestamp").alias("at"), F.lit(1).alias("n"))
    return runlog.budget(calls, 5000, 0.5, 25, F.lit("2024-01-20 12:00:00+00:00").cast("timestamp"))


@query(f"""WITH {SQL_POLLS}, w AS (SELECT board_id, stopped_by, mark FROM polls WHERE run_at = (SELECT max(run_at) FROM polls)), p AS (SELECT identity, max(board_id) AS board_id, max(published_at) AS published_at FROM seen_snapshots GROUP BY 1)
SELECT identity, CASE WHEN stopped_by = 'end' THEN true WHEN published_at IS NULL OR mark IS NULL OR coalesce(stopped_by, '') <> 'mark' THEN false ELSE published_at > mark END AS covered FROM p JOIN w USING (board_id)""")
def walk_covered(t):
    """Whether the newest walk of its board went back far enough to meet each posting."""
    walks = runlog.board_runs(_logs(t, last=1)).select(F.col("board").alias("board_id"), F.coalesce("stopped_by", F.lit("")).alias("stopped_by"), "mark")
    posts = t("seen_snapshots").groupBy("identity").agg(F.max("board_id").alias("board_id"), F.max("published_at").alias("published_at"))
    return posts.join(walks, "board_id").select("identity", runlog.covered(F.col("stopped_by"), F.col("mark"), F.col("published_at")).alias("covered"))


@query(f"""WITH {SQL_POLLS}, p AS (SELECT s.identity, max(s.board_id) AS board_id, max(s.published_at) AS published_at, max(s.taken_at) AS last_seen FROM seen_snapshots s GROUP BY 1), e AS (SELECT identity, max(nullif(expires_at, '')) AS expires_at FROM group_rows GROUP BY 1),
x AS (SELECT p.identity, q.run_at, row_number() OVER (PARTITION BY p.identity ORDER BY q.run_at) AS rn FROM p JOIN polls q ON q.board_id = p.board_id AND q.run_at > p.last_seen AND q.status = 'ok' AND q.fetched > 0 AND (q.stopped_by = 'end' OR coalesce(p.published_at > q.mark, false)))
SELECT p.identity, CASE WHEN e.expires_at <= '2026-06-15T00:00:00Z' THEN left(e.expires_at, 10) ELSE strftime(x.run_at AT TIME ZONE 'UTC', '%Y-%m-%d') END AS closed_on FROM p LEFT JOIN e USING (identity) LEFT JOIN x ON x.identity = p.identity AND x.rn = 2""")
def closure_covered(t):
    """Closed by expiry, else by the second run that would have met the posting and didn't."""
    posts = t("seen_snapshots").groupBy("identity").agg(F.max("board_id").alias("board_id"), F.max("published_at").alias("published_at"), F.max("taken_at").alias("last_seen"))
    expiry = t("group_rows").groupBy("identity").agg(F.max(F.nullif("expires_at", F.lit(""))).alias("expires_at"))
    polled = runlog.board_runs(_logs(t)).withColumnRenamed("board", "board_id")
    return runs.closed(posts.join(expiry, "identity", "left"), polled, 2, "2026-06-15T00:00:00Z")


# ---- polling, walks and configuration by script

_ANSWERS = {"a": ["page"], "b": ValueError("no JSON"), "c": fetching.Passing("503"), "d": KeyError("x"), "e": ["page", "page"], "f": fetching.Refused("f: circuit open"), "g": fetching.Refused("budget used up"), "h": ["page"]}


@query(values("board_id, status, pages", [("a", "ok", 1), ("b", "unparseable", 0), ("c", "failed", 0), ("d", "error", 0), ("e", "ok", 2), ("f", "failed", 0), ("g", "not reached", 0), ("h", "not reached", 0), ("z", "skipped", 0)]))
def poll_statuses(t):
    """A board that fails costs no other; after the budget is used up none is reached."""
    def fetch(board: str) -> list:
        answer = _ANSWERS[board]
        if isinstance(answer, Exception):
            raise answer
        return answer

    polled = flow.poll([*_ANSWERS, "z"], fetch, skip=["z"])
    return t.spark.createDataFrame([(p.board_id, p.status, len(p.payloads)) for p in polled], "board_id string, status string, pages int")


@query(values("run, stopped_by, pages, held_cursor, held_mark", [(1, "cap", 2, 2, "2026-01"), (2, "mark", 1, 2, "2026-01"), (3, "mark", 2, 2, "2026-01"), (4, "end", 4, None, None)]))
def walk_resumed(t):
    """Walks of one feed: cut off at the cap, stopped at a mark while the tail is still held, the tail read, and read to the end."""
    feed = [["2026-05", "2026-04"], ["2026-03", None], ["2026-02"], ["2026-01"]]
    fetch = lambda cursor: (feed[cursor or 0], (cursor or 0) + 1 if (cursor or 0) + 1 < len(feed) else None)
    go = lambda mark, cap, cursor=None: fetching.walk(fetch, lambda page: page, mark, cap, cursor)
    held, rows = None, []
    for run, (mark, cap, cursor) in enumerate((("2026-01", 2, None), ("2026-05", 9, None), ("2026-01", 9, 2), (None, 9, None)), 1):
        done = go(mark, cap, cursor)
        held = fetching.resume(held, done, mark)
        rows.append((run, done.stopped_by, len(done.pages), (held or {}).get("cursor"), (held or {}).get("mark")))
    return t.spark.createDataFrame(rows, "run int, stopped_by string, pages int, held_cursor int, held_mark string")


@query(values("step, outcome, used, waited", [(1, "ok", 3, 11.0), (2, "failed", 6, 14.0), (3, "circuit open", 6, 14.0), (4, "ok", 7, 14.0), (5, "budget used up", 7, 14.0)]))
def guarded_requests(t):
    """Retries wait at least as long as asked, three failures in a row open a circuit, and every attempt counts against the budget."""
    waits: list[float] = []
    guard = fetching.Guard(budget=7, sleep=waits.append)
    script = [fetching.Passing("x", after=9), fetching.Passing("x"), "ok", *[fetching.Passing("x")] * 3, "never", "ok", "never"]
    answers, rows = iter(script), []

    def fetch():
        answer = next(answers)
        if isinstance(answer, Exception):
            raise answer
        return answer

    for step, label in enumerate(("a", "a", "a", "b", "b"), 1):
        try:
            guard.call(label, fetch)
            outcome = "ok"
        except fetching.Passing:
            outcome = "failed"
        except fetching.Refused as error:
            outcome = "budget used up" if "budget" in str(error) else "circuit open"
        if outcome == "circuit open":
            next(answers)
        rows.append((step, outcome, guard.used, float(sum(waits))))
    return t.spark.createDataFrame(rows, "step int, outcome string, used int, waited double")


@query(values("board_id, platform, slug, employer_alias, slots", [("lever:alba", "lever", "alba", "Alba Foods", 2), ("ashby:bolo", "ashby", "bolo", None, 0)]))
def boards_loaded(t):
    """A boards file as a table."""
    entries = [{"platform": "lever", "slug": "alba", "employer_alias": "Alba Foods", "poll_slots": ["08:00", "20:00"], "deep_slots": ["08:00"]}, {"platform": "ashby", "slug": "bolo"}]
    return _from_file(t, json.dumps(entries), lambda p: config.load_boards(t.spark, p, ["lever", "ashby"])).select("board_id", "platform", "slug", "employer_alias", F.size("poll_slots").alias("slots"))


def _from_file(t, text: str, load: Callable) -> DataFrame:
    """What load makes of a configuration file: it is read on the driver, whose own disk holds it."""
    with tempfile.TemporaryDirectory() as folder:
        path = Path(folder, "file")
        path.write_text(text)
        return load(str(path))


@query(values("fault", [("entry 0: 'noon' is no time of day",), ("entry 0: a deep slot that is not polled",), ("entry 1: lever:alba is listed twice",), ("entry 2: unknown platform 'x'",), ("entry 2: no slug",), ("entry 3: no object",)]))
def board_faults(t):
    """All that is wrong with a boards file; one fault refuses it."""
    entries = [{"platform": "lever", "slug": "alba", "poll_slots": ["noon"], "deep_slots": ["08:00"]}, {"platform": "lever", "slug": "alba"}, {"platform": "x", "slug": " "}, 5]
    return t.spark.createDataFrame([(x,) for x in config.board_faults(entries, ["lever", "ashby"])[1]], "fault string")


@query(values("position, term, family", [(0, "data analyst", "Data"), (1, "machine learning", "Data"), (2, "designer", "Design")]))
def terms_loaded(t):
    """A term list of Markdown: headings are families."""
    load = lambda p: t.spark.createDataFrame(config.load_terms(p, exempt=["designer"]), "position int, term string, family string")
    return _from_file(t, "# Data\n\n* Data  Analyst\n- machine learning\n\n## Design\n- Designer\n", load)


@query("SELECT row_id, CASE first_term WHEN 'data' THEN 'Data' WHEN 'machine learning' THEN 'Data' WHEN 'engineer' THEN 'Building' WHEN 'developer' THEN 'Building' WHEN 'designer' THEN 'Design' END AS family FROM (" + R._SQL["title_first_match"] + ")")
def term_families(t):
    """The family of the first term a title holds."""
    families = {"data": "Data", "machine learning": "Data", "engineer": "Building", "developer": "Building", "designer": "Design"}
    return t("job_rows").select("row_id", chain.family_of(chain.first_term(T.fold(F.col("title")), R.TERMS), families).alias("family"))


@query(values("name, value", [("KEY", "a b"), ("URL", "https://x.example/?a=1"), ("missing", "TOKEN")]))
def env_loaded(t):
    read = lambda p: t.spark.createDataFrame([*config.load_env(p).items(), *[("missing", n) for n in config.missing_names(config.load_env(p), ["KEY", "TOKEN"])]], "name string, value string")
    return _from_file(t, "# c\n\nexport KEY='a b'\nURL=https://x.example/?a=1\n", read)


# ---- plan, backfill, facts

HELD = ("remoteok",)
SQL_STAGES = f"""a AS (SELECT j.*, CASE WHEN source IN ('remoteok') THEN 'held' WHEN source IN ('jobicy') THEN 'withheld' END AS gone, c.drop_rule, {R.SQL_KEY} AS k FROM job_rows j JOIN (SELECT row_id, drop_rule FROM ({R.SQL_CHAIN})) c USING (row_id)),
ok AS (SELECT * FROM a WHERE gone IS NULL AND drop_rule IS NULL), g AS (SELECT k, arg_min(identity, (coalesce(epoch_us(published_at), -4611686018427387904), identity)) AS representative FROM ok GROUP BY k),
st AS (SELECT DISTINCT k FROM ok WHERE identity IN (SELECT identity FROM incoming_rows)), cl AS (SELECT DISTINCT k FROM ok WHERE board_id LIKE 'ashby%'),
sh AS (SELECT identity, count(*) AS n, max(nullif(trim(title), '')) AS t, max(nullif(trim(location), '')) AS l FROM (SELECT DISTINCT identity, title, location FROM seen_snapshots WHERE snapshot_no = 6) GROUP BY identity),
told AS (SELECT g.k AS group_key, representative, CASE WHEN st.k IS NOT NULL THEN 'skipped by store' WHEN cl.k IS NOT NULL THEN 'retired' WHEN sh.identity IS NULL THEN 'new' WHEN sh.n = 1 AND nullif(trim(j.title), '') IS NOT DISTINCT FROM sh.t AND nullif(trim(j.location), '') IS NOT DISTINCT FROM sh.l THEN 'unchanged' ELSE 'changed' END AS state
FROM g JOIN job_rows j ON j.identity = g.representative LEFT JOIN st USING (k) LEFT JOIN cl USING (k) LEFT JOIN sh ON sh.identity = g.representative)"""


def _plan(t) -> tuple[DataFrame, DataFrame]:
    rows = t("job_rows")
    admitted = chain.judged(rows, R._rules()).where(F.col("drop_rule").isNull() & F.startswith("board_id", F.lit("ashby")) & ~F.col("source").isin(*HELD, "jobicy"))
    closed = admitted.select(flow.group_key().alias("group_key")).distinct()
    shown = t("seen_snapshots").where("snapshot_no = 6").select("identity", "title", "location").distinct()
    return flow.plan(rows, R._rules(), HELD, t("incoming_rows"), closed, shown, ("title", "location"), withhold=("jobicy",))


@query(f"""WITH {SQL_STAGES} SELECT 'rows' AS stage, count(*) AS n FROM a UNION ALL SELECT 'rows held', count(*) FROM a WHERE gone = 'held' UNION ALL SELECT 'rows withheld', count(*) FROM a WHERE gone = 'withheld' UNION ALL SELECT 'rows admitted', count(*) FROM ok UNION ALL SELECT 'groups', count(*) FROM told
UNION ALL SELECT 'groups ' || s, (SELECT count(*) FROM told WHERE state = s) FROM (VALUES ('skipped by store'), ('retired'), ('new'), ('changed'), ('unchanged')) AS v(s)""")
def plan_stages(t):
    """What each stage of the plan left: rows held and withheld, admitted, groups, skipped, retired, new, changed, unchanged."""
    return _plan(t)[1]


@query(f"WITH {SQL_STAGES} SELECT group_key, representative, state FROM told WHERE state IN ('new', 'changed')")
def plan_sent(t):
    return _plan(t)[0]


SQL_FACTS = "WITH f AS (SELECT identity, stated_experience FROM (SELECT *, row_number() OVER (PARTITION BY identity ORDER BY row_id DESC) AS rn FROM incoming_rows) WHERE rn = 1), job_rows AS (SELECT j.* REPLACE (CASE WHEN f.identity IS NOT NULL THEN f.stated_experience ELSE j.stated_experience END AS stated_experience) FROM main.job_rows j LEFT JOIN f USING (identity))"


def _backfill(t) -> tuple[DataFrame, DataFrame]:
    facts = stores.latest_per_key(t("incoming_rows").select("identity", "row_id", "stated_experience"), ["identity"], [F.col("row_id")])
    return flow.backfill(t("job_rows"), facts, ["stated_experience"], R._rules(), t("group_rows"), F.col("source").isin(*R.PUBLIC))


_SQL_GAP = "identity NOT IN (SELECT identity FROM group_rows)"
_SQL_ADMITTED = f"SELECT identity FROM ({R.SQL_CHAIN}) JOIN (SELECT row_id, identity, source FROM job_rows) USING (row_id) WHERE drop_rule IS NULL AND source IN ('greenhouse','lever','ashby','workable','smartrecruiters','manatal')"


@query(f"{SQL_FACTS} SELECT 'read' AS step, count(*) AS n FROM job_rows UNION ALL SELECT 'admitted', count(*) FROM ({_SQL_ADMITTED}) UNION ALL SELECT 'to append', count(*) FROM ({_SQL_ADMITTED}) WHERE {_SQL_GAP}")
def backfill_steps(t):
    """A layer judged anew with its facts laid over it: read, admitted, and lacking in the filtered layer."""
    return _backfill(t)[1]


@query(f"{SQL_FACTS} SELECT identity FROM ({_SQL_ADMITTED}) WHERE {_SQL_GAP}")
def backfill_rows(t):
    return _backfill(t)[0].select("identity")


@query("""WITH s AS (SELECT identity, arg_min(row_id, row_id) AS first_row, CASE WHEN min(row_id) % 2 = 0 THEN 'now' ELSE 'then' END AS fingerprint FROM job_rows GROUP BY identity),
r AS (SELECT identity, min(row_id) AS first_row FROM incoming_rows GROUP BY identity)
SELECT identity, 'now' AS fingerprint, r.first_row FROM r WHERE identity NOT IN (SELECT identity FROM s WHERE fingerprint = 'now') UNION ALL SELECT identity, fingerprint, first_row FROM s WHERE fingerprint = 'now' OR identity NOT IN (SELECT identity FROM r)""")
def facts_reread(t):
    """Facts read anew where their fingerprint is another; an identity's first raw row counts."""
    stored = t("job_rows").groupBy("identity").agg(F.min("row_id").alias("first_row")).withColumn("fingerprint", F.when(F.col("first_row") % 2 == 0, "now").otherwise("then"))
    derive = lambda rows: rows.select("identity", F.col("row_id").alias("first_row"))
    return flow.reread(t("incoming_rows"), derive, stored, "now")


@query("WITH s AS (SELECT DISTINCT identity, snapshot_no, title FROM seen_snapshots) SELECT identity, max(snapshot_no) AS part, arg_max(title, (snapshot_no, title)) AS title FROM (SELECT identity, snapshot_no, max(title) AS title FROM s GROUP BY ALL) GROUP BY identity")
def seen_parts(t):
    """Six files of a store loaded as one: the later file wins where a key is in several."""
    one = t("seen_snapshots").groupBy("snapshot_no", "identity").agg(F.max("title").alias("title"))
    parts = [one.where(F.col("snapshot_no") == n).select("identity", F.col("snapshot_no").alias("part"), "title") for n in range(1, 7)]
    return flow.merged_parts(parts, "identity")


@query("""WITH b AS (SELECT identity, max(title) AS title FROM job_rows GROUP BY 1), s AS (SELECT DISTINCT identity FROM seen_snapshots) SELECT identity, identity IN (SELECT identity FROM b WHERE length(title) % 5 <> 0) AS saved FROM s""")
def saved_marks(t):
    """Only what reads back as it was written is marked as saved; here every fifth title comes back altered."""
    written = t("job_rows").groupBy("identity").agg(F.max("title").alias("title"))
    back = written.withColumn("title", F.when(F.length("title") % 5 == 0, F.concat("title", F.lit("!"))).otherwise(F.col("title")))
    seen = t("seen_snapshots").select("identity").distinct().withColumn("full_saved_at", F.lit(None).cast("timestamp"))
    marked = flow.mark_saved(seen, flow.verified(written, back, "identity"), F.lit("2026-06-15 00:00:00+00:00").cast("timestamp"))
    return marked.select("identity", F.col("full_saved_at").isNotNull().alias("saved"))


@query("SELECT row_id, coalesce(first_seen <= TIMESTAMPTZ '2026-06-01 00:00:00+00' - INTERVAL 30 DAY, false) AS old, CASE WHEN NOT coalesce(published_meaning_unconfirmed, false) THEN epoch_us(published_at) < epoch_us(TIMESTAMPTZ '2026-06-01 00:00:00+00') - 30 * 86400000000 - 1000000 END AS below_floor FROM job_rows")
def age_bounds(t):
    """Rows older than a span, and those below the floor of what is read; dates not to be trusted have no floor."""
    now = F.lit("2026-06-01 00:00:00+00:00").cast("timestamp")
    floor = flow.age_floor(now, 30, F.col("published_meaning_unconfirmed"))
    return t("job_rows").select("row_id", flow.older_than(F.col("first_seen"), 30, now).alias("old"), (F.col("published_at") < floor).alias("below_floor"))


@query("""SELECT source, batch_no, CAST(n AS BIGINT) AS n FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY seen_at DESC) AS rn FROM (SELECT source, batch_no, max(arrived_at) AS seen_at, count(*) AS n FROM incoming_rows GROUP BY ALL) WHERE n > 2 AND seen_at <= TIMESTAMPTZ '2026-06-20 00:00:00+00' AND seen_at >= TIMESTAMPTZ '2026-06-20 00:00:00+00' - INTERVAL 720 HOUR) WHERE rn = 1""")
def latest_dry_run(t):
    """The newest run of each source that counts and is not too old: what a confirmation binds to."""
    dry = t("incoming_rows").groupBy("source", "batch_no").agg(F.max("arrived_at").alias("at"), F.count("*").alias("n"))
    found = runlog.latest_in_window(dry, ["source"], "at", 720, F.lit("2026-06-20 00:00:00+00:00").cast("timestamp"), F.col("n") > 2)
    return found.select("source", "batch_no", "n")


@query("SELECT hours, fresh FROM (VALUES (22, true), (1, false)) AS v(hours, fresh) UNION ALL SELECT -1, false")
def view_fresh(t):
    """A cached state of a target serves while its newest row is young enough and it has the fields asked for (-1: it hasn't)."""
    views = t("seen_snapshots").select("identity", "taken_at", "title")
    now = F.lit("2026-07-13 20:00:00+00:00").cast("timestamp")
    told = [(h, runlog.fresh_view(views, "taken_at", abs(h) if h > 0 else 22, now, ["title"] if h > 0 else ["salary"]) is not None) for h in (22, 1, -1)]
    return t.spark.createDataFrame(told, "hours int, fresh boolean")


# ---- contracts

@query("""SELECT board_id, epoch_us(strict) AS strict_us, epoch_us(accepted) AS accepted_us FROM (SELECT board_id, s, CASE WHEN length(s) = 20 THEN TRY_CAST(s AS TIMESTAMPTZ) END AS strict, CASE WHEN length(s) = 10 THEN TRY_CAST(s || 'T23:59:59Z' AS TIMESTAMPTZ) ELSE TRY_CAST(s AS TIMESTAMPTZ) END AS accepted
FROM (SELECT DISTINCT board_id, CASE length(board_id) % 4 WHEN 0 THEN '2026-03-05T06:07:08Z' WHEN 1 THEN '2026-03-05' WHEN 2 THEN '2026-19-26T06:07:08Z' ELSE '2026-03-05T06:07:08.5+00:00' END AS s FROM boards))""")
def strict_times(t):
    """Times of one strict form, and when a shape was accepted: a bare day means its last second."""
    s = F.when(F.length("board_id") % 4 == 0, "2026-03-05T06:07:08Z").when(F.length("board_id") % 4 == 1, "2026-03-05").when(F.length("board_id") % 4 == 2, "2026-19-26T06:07:08Z").otherwise("2026-03-05T06:07:08.5+00:00")
    return t("boards").select("board_id", s.alias("s")).distinct().select("board_id", us(shapes.strict_time(F.col("s"))).alias("strict_us"), us(shapes.accepted_at(F.col("s"))).alias("accepted_us"))


_CONTRACT = """p AS (SELECT platform, max(snapshot_no) AS newest FROM boards GROUP BY 1), sec AS (SELECT platform, snapshot_no, 'posting' AS section, board_id AS path, CAST(max(coalesce(len(poll_slots), 0)) AS VARCHAR) AS shape FROM boards GROUP BY ALL),
old AS (SELECT * FROM sec WHERE snapshot_no = 5 AND platform <> 'ashby'), new AS (SELECT * FROM sec WHERE snapshot_no = 6 AND platform NOT IN ('lever', 'workable')),
ch AS (SELECT coalesce(o.platform, n.platform) AS platform, coalesce(o.path, n.path) AS path FROM old o FULL JOIN new n USING (platform, section, path) WHERE o.shape IS DISTINCT FROM n.shape AND coalesce(o.platform, n.platform) NOT IN ('lever', 'workable', 'ashby'))"""


@query(f"""WITH {_CONTRACT} SELECT p.platform, CASE WHEN p.platform = 'lever' THEN 'unreachable' WHEN p.platform = 'workable' THEN 'check failed' WHEN p.platform = 'ashby' THEN 'baseline' WHEN count(ch.path) = 0 THEN 'unchanged' WHEN p.platform = 'greenhouse' THEN 're-baselined' ELSE 'changed' END AS status, count(ch.path) AS changes FROM p LEFT JOIN ch USING (platform) GROUP BY p.platform""")
def contract_statuses(t):
    """The status of each platform's check: baseline, unchanged, changed, re-baselined, unreachable, check failed."""
    sec = t("boards").groupBy("platform", "snapshot_no", F.lit("posting").alias("section"), F.col("board_id").alias("path")).agg(F.max(F.coalesce(F.size("poll_slots"), F.lit(0))).cast("string").alias("shape"))
    old = sec.where("snapshot_no = 5 and platform <> 'ashby'").drop("snapshot_no")
    new = sec.where("snapshot_no = 6 and platform not in ('lever', 'workable')").drop("snapshot_no")
    failures = t.spark.createDataFrame([("lever", "unreachable"), ("workable", "check failed")], "platform string, status string")
    accepted = sec.where("platform = 'greenhouse'").select("platform", "section", "path").distinct()
    return shapes.statuses(t("boards").select("platform").distinct(), old, new, failures, accepted)


@query(f"""WITH {_CONTRACT} SELECT platform, section, path, shape FROM sec WHERE (snapshot_no = 6 AND platform <> 'lever') OR (snapshot_no = 5 AND platform = 'lever')""")
def contract_kept(t):
    """A section about which a check learnt nothing (no postings, no detail) keeps its stored shape."""
    sec = t("boards").groupBy("platform", "snapshot_no", F.lit("posting").alias("section"), F.col("board_id").alias("path")).agg(F.max(F.coalesce(F.size("poll_slots"), F.lit(0))).cast("string").alias("shape"))
    old, new = sec.where("snapshot_no = 5").drop("snapshot_no"), sec.where("snapshot_no = 6 and platform <> 'lever'").drop("snapshot_no")
    return shapes.kept_sections(old, new, t("boards").select("platform").distinct())


_CONTRACT_KEYS = ("board_id", "employer", "guid", "id", "title")


@query("""WITH k AS (SELECT feed_id, record_id, unnest(json_keys(payload)) AS key FROM feed_records WHERE json_valid(payload)), r AS (SELECT feed_id, record_id, array_agg(DISTINCT key) AS keys FROM k GROUP BY ALL)
SELECT record_id, len(list_filter(keys, lambda x: x NOT IN ('board_id', 'employer', 'guid', 'id', 'title'))) AS extra, len(list_filter(['board_id', 'employer', 'guid', 'id', 'title'], lambda x: NOT list_contains(keys, x))) AS missing FROM r""")
def field_sets(t):
    """Fields a record has beyond those expected, and expected ones it lacks."""
    keys = F.json_object_keys("payload")
    wanted = F.array(*[F.lit(k) for k in _CONTRACT_KEYS])
    return t("feed_records").select("record_id", F.size(F.array_except(keys, wanted)).cast("long").alias("extra"), F.size(F.array_except(wanted, keys)).cast("long").alias("missing")).where("extra >= 0")


# ---- events, reports, small columns

@query("""SELECT 'new ' || identity AS key, epoch_us(arrived_at) AS at_us, source, identity AS subject, 'new' AS status, title AS detail FROM incoming_rows WHERE identity NOT IN (SELECT identity FROM job_rows)
UNION ALL SELECT 'page ' || page_id, epoch_us(fetched_at), source, board_id, 'unparseable', '' FROM raw_pages WHERE NOT coalesce(json_valid(payload), false)
UNION ALL SELECT 'late ' || row_id, epoch_us(first_seen), source, identity, 'late', '' FROM job_rows WHERE epoch_us(first_seen) - epoch_us(published_at) > 20 * 86400000000""")
def health_events(t):
    """Events of three kinds in one form."""
    fresh = stores.delta(t("incoming_rows"), t("job_rows"), "identity")
    broken = t("raw_pages").where(F.try_parse_json("payload").isNull())
    late = t("job_rows").where(us("first_seen") - us("published_at") > 20 * 86_400_000_000)
    key = lambda kind, c: F.concat(F.lit(f"{kind} "), F.col(c).cast("string"))
    told = flow.events(
        (fresh, key("new", "identity"), F.col("arrived_at"), F.col("source"), F.col("identity"), F.lit("new"), F.col("title")),
        (broken, key("page", "page_id"), F.col("fetched_at"), F.col("source"), F.col("board_id"), F.lit("unparseable"), F.lit("")),
        (late, key("late", "row_id"), F.col("first_seen"), F.col("source"), F.col("identity"), F.lit("late"), F.lit("")),
    )
    return told.select("key", us("at").alias("at_us"), "source", "subject", "status", "detail")


@query("SELECT board_id, string_agg(DISTINCT identity, ',' ORDER BY identity) AS identities FROM seen_snapshots GROUP BY board_id")
def board_identities(t):
    """The set of identities of each board. A board lists at most what its pages hold; sets of any size go by (board, identity) rows instead."""
    return t("seen_snapshots").groupBy("board_id").agg(F.array_join(F.array_sort(F.collect_set("identity")), ",").alias("identities"))


@query("SELECT j.row_id, coalesce(nullif(trim(j.employer), ''), b.alias) AS employer FROM job_rows j LEFT JOIN (SELECT board_id, max(employer_alias) AS alias FROM boards GROUP BY 1) b USING (board_id)")
def alias_lookup(t):
    """Rows that name no employer have their board's."""
    names = t("boards").groupBy("board_id").agg(F.max("employer_alias").alias("alias"))
    return t("job_rows").select("row_id", "board_id", "employer").join(names, "board_id", "left").select("row_id", F.coalesce(F.nullif(F.trim("employer"), F.lit("")), "alias").alias("employer"))


@query(f"""SELECT row_id, CASE drop_rule WHEN 'expiry' THEN 'expired on ' || expires_at WHEN 'age' THEN 'dated ' || strftime(ordering_date AT TIME ZONE 'UTC', '%Y-%m-%d') || ', more than 7 days before it was first seen' WHEN 'experience' THEN 'asks for ' || list_max(stated_experience) || ' years' WHEN 'level' THEN 'stated level ' || array_to_string(stated_levels, ', ') WHEN 'seniority' THEN 'title holds ' || {R.sql_first(R.sql_fold('title_normalised'), R.EXCLUDED)} WHEN 'title' THEN 'no wanted term in ' || title_normalised END AS reason
FROM ({R.SQL_CHAIN}) JOIN (SELECT row_id, expires_at, ordering_date, stated_experience, stated_levels, title_normalised FROM job_rows) USING (row_id) WHERE drop_rule IS NOT NULL""")
def drop_reasons(t):
    """Every drop in words."""
    dropped = chain.judged(t("job_rows"), R._rules()).where("drop_rule is not null")
    words = {"expiry": "expired on %s", "age": "dated %s, more than 7 days before it was first seen", "experience": "asks for %s years", "level": "stated level %s", "seniority": "title holds %s", "title": "no wanted term in %s"}
    detail = F.when(F.col("drop_rule") == "title", F.col("title_normalised")).otherwise(F.col("drop_detail"))
    return dropped.select("row_id", chain.reason(F.col("drop_rule"), detail, words).alias("reason"))


@query("""SELECT row_id, coalesce(array_to_string(list_filter(['Germany', 'United States'], lambda x: list_contains(v, x)), '; '), '') AS required FROM (SELECT row_id, list_transform(coalesce(required_places, []), lambda x: CASE lower(trim(x)) WHEN 'germany' THEN 'Germany' WHEN 'deutschland' THEN 'Germany' WHEN 'us' THEN 'United States' WHEN 'united states' THEN 'United States' END) AS v FROM job_rows)""")
def required_places(t):
    """Phrases of required places as configured names, each once, in the order of configuration."""
    names = {"germany": "Germany", "deutschland": "Germany", "us": "United States", "united states": "United States"}
    return t("job_rows").select("row_id", F.coalesce(F.array_join(chain.named_places(F.col("required_places"), names), "; "), F.lit("")).alias("required"))


@query("SELECT board_id, n, CAST(newest AS INTEGER) AS newest FROM (SELECT board_id, count(DISTINCT snapshot_no) AS n, max(snapshot_no) AS newest FROM boards GROUP BY board_id)")
def map_last_wins(t):
    """Maps of snapshots merged, the later value of a key winning."""
    per = t("boards").groupBy("board_id").agg(F.array_sort(F.collect_set("snapshot_no")).alias("s"))
    maps = F.transform("s", lambda n: F.create_map(F.lit("newest"), n, F.concat(F.lit("s"), n.cast("string")), n))
    merged = F.aggregate(maps, F.create_map().cast("map<string,int>"), stores.map_merge)
    return per.select("board_id", (F.size(merged) - 1).cast("long").alias("n"), F.element_at(merged, "newest").alias("newest"))


@query("SELECT row_id, CASE WHEN source IN ('greenhouse','lever','ashby','workable','smartrecruiters','manatal') THEN 'public' ELSE 'private' END || '/raw/' || source || '/' || replace(board_id, ':', '%3A') AS path FROM job_rows")
def layer_paths(t):
    """Where a row's layer file lies: by class, layer, source and board; unknown sources are private."""
    return publish.routed(t("job_rows"), "source", R.PUBLIC).select("row_id", publish.layer_path(F.col("source_class"), "raw", F.col("source"), F.col("board_id")).alias("path"))


@query("SELECT row_id, replace(replace(employer || ' ' || to_base64(encode('k3y')) || ' k3y', to_base64(encode('k3y')), '***'), 'k3y', '***') AS text FROM job_rows")
def secrets_redacted(t):
    """Known secrets leave no trace, plain or in base64."""
    import base64

    told = F.concat_ws(" ", "employer", F.lit(base64.b64encode(b"k3y").decode()), F.lit("k3y"))
    return t("job_rows").select("row_id", F.when(F.col("employer").isNotNull(), publish.redact(told, ["k3y"])).alias("text"))


@query("SELECT row_id, to_json({'board_id': board_id, 'employer': employer, 'row_id': row_id, 'title': title}) AS line FROM job_rows")
def canonical_lines(t):
    """Rows as text that is the same for equal rows: members in name order, nulls written."""
    return t("job_rows").select("title", "row_id", "employer", "board_id").select("row_id", publish.canonical_json(t("job_rows").select("title", "row_id", "employer", "board_id")).alias("line"))


@query("SELECT 'refused' AS all_sources, (SELECT count(*) FROM job_rows WHERE source IN ('greenhouse','lever','ashby','workable','smartrecruiters','manatal')) AS public_rows")
def publish_guard(t):
    """Nothing of an unlisted source is published: the whole is refused, the listed part passes."""
    rows = t("job_rows")
    try:
        stores.refuse_unlisted(rows, "source", R.PUBLIC)
        told = "passed"
    except ValueError:
        told = "refused"
    passed = stores.refuse_unlisted(rows.where(F.col("source").isin(*R.PUBLIC)), "source", R.PUBLIC)
    return passed.agg(F.count("*").alias("public_rows")).select(F.lit(told).alias("all_sources"), "public_rows")


@query("SELECT v.version, (SELECT count(*) FROM job_rows) + (v.version - 1) * (SELECT count(*) FROM incoming_rows) AS n_rows FROM (VALUES (1), (2)) AS v(version)")
def published_versions(t):
    """A version is written for new content only: the same rows again, in another order, write nothing."""
    path = scratch_path(t.spark, "published")
    rows = t("job_rows").select("identity", "title")
    publish.publish(rows, path)
    publish.publish(rows.repartition(3), path)
    first = publish.newest(t.spark, path).agg(F.count("*").alias("n_rows"))
    number = publish.publish(rows.unionByName(t("incoming_rows").select("identity", "title")), path)["version"]
    then = publish.newest(t.spark, path).agg(F.count("*").alias("n_rows"))
    return first.select(F.lit(1).alias("version"), "n_rows").unionByName(then.select(F.lit(number).alias("version"), "n_rows"))


@query(f"WITH j AS (SELECT {R.sql_fold('title')} AS f FROM job_rows) SELECT 'credited now' AS what, count(*) FILTER (WHERE {R.sql_first('f', R.TERMS)} IS NOT NULL) AS n FROM j UNION ALL SELECT 'with the new terms', count(*) FILTER (WHERE {R.sql_first('f', (*R.TERMS, 'supervisor', 'buyer'))} IS NOT NULL) FROM j")
def terms_what_if(t):
    """How many titles more terms would admit."""
    title = T.fold(F.col("title"))
    counted = t("job_rows").agg(*[F.count_if(chain.first_term(title, terms).isNotNull()).alias(name) for name, terms in (("credited now", R.TERMS), ("with the new terms", (*R.TERMS, "supervisor", "buyer")))])
    return counted.unpivot([], counted.columns, "what", "n")


@query("""WITH r AS (SELECT source, batch_no, max(arrived_at) AS run_at FROM incoming_rows GROUP BY ALL), l AS (SELECT *, lag(run_at) OVER (PARTITION BY source ORDER BY run_at, batch_no) AS previous FROM r)
SELECT i.row_id, CASE WHEN published_at IS NULL THEN 'undated' WHEN previous IS NULL THEN 'first run' WHEN published_at > previous THEN 'since the run before' ELSE 'missed by it' END AS bucket FROM incoming_rows i JOIN l USING (source, batch_no)""")
def lag_against_previous_run(t):
    """Whether a posting was out before the run before the one that met it."""
    met = t("incoming_rows").groupBy("source", "batch_no").agg(F.max("arrived_at").alias("run_at"))
    told = runs.previous_run(met.withColumn("at", F.struct("run_at", "batch_no")), "source", "at").select("source", "batch_no", F.col("previous.run_at").alias("previous"))
    bucket = F.when(F.col("published_at").isNull(), "undated").when(F.col("previous").isNull(), "first run").when(F.col("published_at") > F.col("previous"), "since the run before").otherwise("missed by it")
    return t("incoming_rows").join(told, ["source", "batch_no"]).select("row_id", bucket.alias("bucket"))


LABELS = (("recruiter", r"(?i)\b(recruiter|talent)\b"), ("manager", r"(?i)\bhiring manager\b"), ("team", r"(?i)\bteam\b"))


@query("SELECT doc_id, CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in LABELS) + " END AS who_reads FROM documents")
def who_reads(t):
    """The first label, in order of priority, whose pattern a description holds."""
    return t("documents").select("doc_id", D.first_label(F.col("text"), LABELS).alias("who_reads"))


_REQUIRED = {"degree": r"(?i)\bdegree\b", "travel": r"(?i)\btravel", "visa": r"(?i)\bvisa\b"}


@query("SELECT doc_id, concat_ws(',', CASE WHEN regexp_matches(text, '(?i)\\bdegree\\b') AND NOT regexp_matches(text, '(?i)\\bno degree\\b') THEN 'degree' END, CASE WHEN regexp_matches(text, '(?i)\\btravel') AND NOT regexp_matches(text, '(?i)\\bno travel') THEN 'travel' END, CASE WHEN regexp_matches(text, '(?i)\\bvisa\\b') AND NOT regexp_matches(text, '(?i)\\bno visa\\b') THEN 'visa' END) AS named FROM documents WHERE text IS NOT NULL")
def requirements_named(t):
    """Requirements a description names and does not deny."""
    named = D.named_requirements(F.col("text"), _REQUIRED, {k: p.replace(r"(?i)\b", r"(?i)\bno ", 1) for k, p in _REQUIRED.items()})
    return t("documents").where("text is not null").select("doc_id", F.array_join(named, ",").alias("named"))


@query("WITH s AS (SELECT DISTINCT identity, snapshot_no FROM seen_snapshots), n AS (SELECT max(snapshot_no) AS last FROM s) SELECT identity, max(snapshot_no) AS last_seen_run, (SELECT last FROM n) - max(snapshot_no) AS absences FROM s GROUP BY identity")
def stream_absences(t):
    """Runs as a stream: for each identity the runs since it was last delivered."""
    runs_ = t("seen_snapshots").select("identity", F.col("snapshot_no").alias("run")).distinct()
    return ingest.absences(runs_, "identity", "run")


@query("SELECT identity, count(DISTINCT CASE WHEN batch_no <= 8 THEN identity END) AS sent FROM incoming_rows GROUP BY identity")
def stream_outbox(t):
    """Events as a stream, sent once each however often they come and though every batch is sent twice."""
    return ingest.sent_once(t("incoming_rows").select("identity", "batch_no", "row_id"), "identity").groupBy("identity").agg(F.count("*").alias("sent"))


@query("SELECT row_id, coalesce(epoch_us(first_seen) - epoch_us(published_at) > 7 * 86400000000, false) AS late FROM incoming_rows")
def stream_late(t):
    """Late rows of a stream are marked, never dropped."""
    rows = t("incoming_rows").select("row_id", "first_seen", "published_at")
    return ingest.through(ingest.late_split(ingest.as_stream(rows, "late"), "first_seen", "published_at", 7)).select("row_id", "late")
