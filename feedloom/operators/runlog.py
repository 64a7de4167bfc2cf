"""Run logs: one nested record a run, written as JSON, read back by newest, month or folder, and reported on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

BOARD = "struct<board:string,status:string,fetched:bigint,new:bigint,stopped_by:string,mark:timestamp,detail:string>"
SCHEMA = f"run_at timestamp, test_mode boolean, stopped string, requests struct<requests_used:bigint,budget:bigint,by_source:map<string,bigint>>, boards array<{BOARD}>, totals struct<fetched:bigint,new:bigint,failed:bigint>"


#: Times keep their microseconds, which the default form of JSON cuts off.
TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def assemble(polls: DataFrame, budget: int, test_mode: bool = False) -> DataFrame:
    """One log a run (SCHEMA) from polls: run_at, board_id, source, status, requests, fetched, new, stopped_by, mark, detail.

    A run's boards are those of the configuration, some hundreds, so its record stays small at any number of postings.
    stopped says that the requests used up the budget. Requests of no source count in the whole alone.
    """
    board = F.struct(F.col("board_id").alias("board"), "status", "fetched", "new", "stopped_by", "mark", "detail")
    per_source = polls.where("source is not null").groupBy("run_at", "source").agg(F.sum("requests").alias("n"))
    by_source = per_source.groupBy("run_at").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "n")))).alias("by_source"))
    runs = polls.groupBy("run_at").agg(
        F.array_sort(F.collect_list(board)).alias("boards"), F.sum("requests").alias("used"),
        F.struct(F.sum("fetched").alias("fetched"), F.sum("new").alias("new"), F.count_if(~F.col("status").isin("ok", "skipped")).alias("failed")).alias("totals"),
    )
    requests = F.struct(F.col("used").alias("requests_used"), F.lit(budget).cast("long").alias("budget"), "by_source")
    stopped = F.when(F.col("used") >= budget, "request ceiling")
    return runs.join(by_source, "run_at", "left").select("run_at", F.lit(test_mode).alias("test_mode"), stopped.alias("stopped"), requests.alias("requests"), "boards", "totals")


def write(logs: DataFrame, folder: str) -> None:
    """Append logs as JSON lines under month=yyyy-MM folders, so that a month is read without the others."""
    logs.withColumn("month", F.date_format("run_at", "yyyy-MM")).write.mode("append").option("timestampFormat", TIME).partitionBy("month").json(folder)


def read(spark: SparkSession, folder: str, month: str | None = None, last: int | None = None) -> DataFrame:
    """The logs of folder, of one month or all; with last only the newest so many. Lines that are no log have a null run_at and stay in _corrupt."""
    logs = spark.read.schema(f"{SCHEMA}, _corrupt string, month string").option("timestampFormat", TIME).option("columnNameOfCorruptRecord", "_corrupt").json(folder)
    if month:
        logs = logs.where(F.col("month") == month)
    return logs.orderBy(F.desc_nulls_last("run_at")).limit(last) if last else logs


def usable(logs: DataFrame, test_mode: bool = False, since: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(the logs a report reads, (problem, n) of the others): unreadable, of the other mode, or from before since."""
    problem = F.when(F.col("run_at").isNull() | F.col("requests").isNull() | F.col("boards").isNull(), "unreadable").when(F.coalesce("test_mode", F.lit(False)) != test_mode, "other mode")
    if since is not None:
        problem = problem.when(F.col("run_at") < since, "before since")
    told = logs.withColumn("problem", problem)
    return told.where("problem is null").drop("problem"), told.where("problem is not null").groupBy("problem").agg(F.count("*").alias("n"))


def board_runs(logs: DataFrame) -> DataFrame:
    """(run_at, board, status, fetched, new, stopped_by, mark, detail) of every board of every run."""
    return logs.select("run_at", F.inline("boards"))


def quiet_boards(runs: DataFrame) -> DataFrame:
    """(board, runs, since, days, statuses): boards that fetched nothing or failed in their newest runs, and for how long.

    The streak goes back from the newest run until one that was ok and fetched something; a board that fetched in its
    newest run has no row. days lie between the streak's first and the board's newest run.
    """
    good = (F.col("status") == "ok") & (F.coalesce("fetched", F.lit(0)) > 0)
    last = runs.groupBy("board").agg(F.max(F.when(good, F.col("run_at"))).alias("_good"), F.max("run_at").alias("_newest"))
    quiet = runs.join(last, "board").where(F.col("_good").isNull() | (F.col("run_at") > F.col("_good")))
    days = (F.unix_micros(F.max("_newest")) - F.unix_micros(F.min("run_at"))) / 86_400_000_000.0
    return quiet.groupBy("board").agg(F.count("*").alias("runs"), F.min("run_at").alias("since"), days.alias("days"), F.array_sort(F.collect_set("status")).alias("statuses"))


def per_source(logs: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, requests, runs, first_contacts): requests over all runs, runs that fetched, those in which all that was fetched was new. sources: board, source."""
    asked = logs.select(F.explode("requests.by_source").alias("source", "n")).groupBy("source").agg(F.sum("n").alias("requests"))
    run = board_runs(logs).join(sources, "board").groupBy("run_at", "source").agg(F.sum("fetched").alias("fetched"), F.sum("new").alias("new")).where("fetched > 0")
    met = run.groupBy("source").agg(F.count("*").alias("runs"), F.count_if(F.col("fetched") == F.col("new")).alias("first_contacts"))
    return asked.join(met, "source", "left").select("source", "requests", F.coalesce("runs", F.lit(0)).alias("runs"), F.coalesce("first_contacts", F.lit(0)).alias("first_contacts"))


def stops(logs: DataFrame) -> DataFrame:
    """(run_at, stopped, not_reached): runs that stopped early, or that left boards unread, with how many."""
    left = F.size(F.filter("boards", lambda b: b["status"] == "not reached"))
    return logs.select("run_at", "stopped", left.alias("not_reached")).where(F.col("stopped").isNotNull() | (F.col("not_reached") > 0))


def needs_attention(*blocks: str) -> Column:
    """Whether any of the named nested blocks of a log has a failure."""
    return F.greatest(*[F.coalesce(F.nullif(F.col(f"{b}.failure"), F.lit("")).isNotNull(), F.lit(False)) for b in blocks])


def escalations(runs: DataFrame, key: str, failed: Column, at_once: Column | None = None, after: int = 3) -> DataFrame:
    """(key, streak, escalate) of those failing now: after so many failures in a row counted back from the newest, or at once."""
    now = F.lit(False) if at_once is None else at_once
    last = runs.groupBy(key).agg(F.max(F.when(~failed, F.col("run_at"))).alias("_ok"))
    trailing = runs.join(last, key).where(F.col("_ok").isNull() | (F.col("run_at") > F.col("_ok")))
    return trailing.groupBy(key).agg(F.count("*").alias("streak"), (F.coalesce(F.max(now), F.lit(False)) | (F.count("*") >= after)).alias("escalate"))


def budget(calls: DataFrame, allowance: int, share: float, before_day: int, now: Column) -> DataFrame:
    """(month_to_date, allowance, share, warning) of now's month. calls: at, n. The warning comes past share of the allowance before the given day."""
    month = calls.where((F.date_format("at", "yyyy-MM") == F.date_format(now, "yyyy-MM")) & (F.col("at") <= now))
    spent = month.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("month_to_date"))
    over = (F.col("month_to_date") > share * allowance) & (F.dayofmonth(now) < before_day)
    text = F.format_string(f"calls are at %d of {allowance}, past {round(share * 100)}%% before day {before_day}", "month_to_date")
    return spent.select("month_to_date", F.lit(allowance).alias("allowance"), F.round(F.col("month_to_date").cast("double") / allowance, 3).alias("share"), F.when(over, text).alias("warning"))


def summary(logs: DataFrame) -> DataFrame:
    """(run_at, line): what a run did, in one line."""
    failed = F.array_join(F.transform(F.filter("boards", lambda b: ~b["status"].isin("ok", "skipped")), lambda b: F.concat(b["board"], F.lit(" "), b["status"])), ", ")
    line = F.format_string("%d boards, %d fetched, %d new, %d requests of %d", F.size("boards"), "totals.fetched", "totals.new", "requests.requests_used", "requests.budget")
    return logs.select("run_at", F.concat(line, F.when(failed != "", F.concat(F.lit("; "), failed)).otherwise("")).alias("line"))


def covered(stopped_by: Column, mark: Column, published: Column) -> Column:
    """Whether a walk read back far enough that a posting of that date would have been met: it reached the end, or stopped at a mark before it."""
    return F.when(stopped_by == "end", True).when(published.isNull() | mark.isNull() | (stopped_by != "mark"), False).otherwise(F.coalesce(published > mark, F.lit(False)))


def latest_in_window(runs: DataFrame, keys: Sequence[str], at: str, hours: int, now: Column, ok: Column) -> DataFrame:
    """The newest run of each keys that is ok and at most hours old: what a confirmation binds to."""
    recent = runs.where(ok & (F.col(at) <= now) & (F.col(at) >= now - F.make_dt_interval(hours=F.lit(hours))))
    order = W.partitionBy(*keys).orderBy(F.desc(at))
    return recent.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def fresh_view(views: DataFrame, at: str, hours: int, now: Column, fields: Sequence[str]) -> DataFrame | None:
    """views if they hold every one of fields and their newest is at most hours old, else None: a cached state of a target that is too old is none."""
    if set(fields) - set(views.columns):
        return None
    newest = views.agg(F.max(at).alias("at")).where(F.col("at") >= now - F.make_dt_interval(hours=F.lit(hours)))
    return None if newest.isEmpty() else views
