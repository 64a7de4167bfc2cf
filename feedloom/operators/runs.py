"""Operators over runs: high-water marks, absences, streaks, lags, spreads, first contacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from feedloom.operators.ranks import running
from feedloom.operators.runlog import covered


def high_water(seen: DataFrame, saved: Column) -> DataFrame:
    """(board_id, high_water_us, n_saved): the latest publication among the saved entries of each board."""
    return seen.groupBy("board_id").agg(F.max(F.when(saved, F.unix_micros("published_at"))).alias("high_water_us"), F.count_if(saved).alias("n_saved"))


def page_is_old(published: Column, mark: Column) -> Column:
    """Of a page's dates: whether there are any and all of them are at or before mark, so that a walk may stop."""
    dated = F.filter(published, lambda p: p.isNotNull())
    return (F.size(dated) > 0) & F.forall(dated, lambda p: p <= mark)


def old_pages(entries: DataFrame, page: list[str], mark: Column) -> DataFrame:
    """(page.., stops): page_is_old() of pages given as rows with published_at, by one aggregation."""
    told = entries.groupBy(*page).agg(F.count("published_at").alias("_n"), F.bool_and(F.col("published_at") <= mark).alias("_old"))
    return told.select(*page, ((F.col("_n") > 0) & F.coalesce("_old", F.lit(True))).alias("stops"))


def nth_absence(last_seen: DataFrame, runs: DataFrame, n: int) -> DataFrame:
    """(identity, closed_at): the time of the n-th run of the posting's board after it was last seen; null before that.

    last_seen: identity, board_id, last_seen; runs: board_id, run_at, only qualifying ones. A board's run times are one
    sorted array, so each posting reads one row instead of every later run.
    """
    times = runs.groupBy("board_id").agg(F.array_sort(F.collect_set("run_at")).alias("runs"))
    later = F.filter("runs", lambda t: t > F.col("last_seen"))
    # each board's times meet each distinct last_seen once, not every posting
    ends = last_seen.select("board_id", "last_seen").distinct().join(times, "board_id").select("board_id", "last_seen", F.get(later, F.lit(n - 1)).alias("closed_at"))
    return last_seen.join(ends, ["board_id", "last_seen"], "left").select("identity", "closed_at")


def closed(postings: DataFrame, polled: DataFrame, n: int, now: str) -> DataFrame:
    """(identity, closed_on): the day a posting closed; null while it is open.

    By expiry where expires_at, as text, is at or before now; else by the n-th run after last_seen that would have met
    it: ok, with anything fetched, and walked to the end or past its date. Runs that don't qualify are passed over.
    postings: identity, board_id, published_at, last_seen, expires_at; polled: run_at, board_id, status, fetched,
    stopped_by, mark. A board's qualifying runs are one array, so a posting reads one row.
    """
    good = polled.where("status = 'ok' and fetched > 0")
    per_board = good.groupBy("board_id").agg(F.array_sort(F.collect_list(F.struct("run_at", "stopped_by", "mark"))).alias("runs"))
    met = F.filter("runs", lambda r: (r["run_at"] > F.col("last_seen")) & covered(r["stopped_by"], r["mark"], F.col("published_at")))
    absent = F.get(met, F.lit(n - 1))["run_at"]
    day = F.when(F.col("expires_at") <= now, F.substring("expires_at", 1, 10)).otherwise(F.date_format(absent, "yyyy-MM-dd"))
    return postings.join(per_board, "board_id", "left").select("identity", day.alias("closed_on"))


def trailing_streak(runs: DataFrame, key: str, when: str, ok: Column) -> DataFrame:
    """(key, streak, since): runs since the last that was ok, counted back from the newest; since is the first of them."""
    last_ok = runs.groupBy(key).agg(F.max(F.when(ok, F.col(when))).alias("_ok"))
    after = F.col("_ok").isNull() | (F.col(when) > F.col("_ok"))
    return runs.join(last_ok, key).groupBy(key).agg(F.count_if(after).alias("streak"), F.min(F.when(after, F.col(when))).alias("since"))


def longest_streaks(runs: DataFrame, key: str, when: str, bad: Column) -> DataFrame:
    """(key, longest): the most consecutive bad runs (gaps and islands)."""
    w = W.partitionBy(key).orderBy(when)
    marked = runs.withColumn("_bad", bad).withColumn("_island", F.sum(F.when(F.col("_bad"), 0).otherwise(1)).over(w))
    return marked.groupBy(key, "_island").agg(F.count_if("_bad").alias("n")).groupBy(key).agg(F.max("n").alias("longest"))


def previous_run(runs: DataFrame, key: str, when: str) -> DataFrame:
    """runs with previous: the time of the run before it."""
    return runs.withColumn("previous", F.lag(when).over(W.partitionBy(key).orderBy(when)))


BINS = 1024


def spread(df: DataFrame, value: Column, *by: str) -> DataFrame:
    """(by.., n, min, median, p90, max), exact; the median is interpolated, p90 is the nearest rank. Null values don't count; a group of nulls has no row.

    Equal values are counted first. Values are cut into BINS ranges between a group's least and greatest, so that a group's
    order is found in two levels, range by range, and no group is the work of one task.
    """
    keys = [*by, "_one"]
    counted = df.select(*by, F.lit(1).alias("_one"), value.alias("_v")).where("_v is not null").groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
    ends = counted.groupBy(*keys).agg(F.sum("_n").alias("n"), F.min("_v").alias("min_v"), F.max("_v").alias("max_v"))
    a, b = counted.alias("a"), ends.alias("b")
    told = a.join(b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]).select("a.*", "b.n", "b.min_v", "b.max_v")
    part = F.coalesce(F.floor(F.try_divide(F.col("_v") - F.col("min_v"), F.col("max_v") - F.col("min_v")) * BINS), F.lit(0))
    ranked = running(told, keys, part, ["_v"], F.col("_n"), "_before")
    holds = lambda place: (F.col("_before") <= place) & (place < F.col("_before") + F.col("_n"))
    pick = lambda place: F.max(F.when(holds(place), F.col("_v")))
    low, high = F.floor((F.col("n") - 1) / 2), F.ceil((F.col("n") - 1) / 2)
    per = ranked.groupBy(*keys).agg(F.max("n").alias("n"), F.max("min_v").alias("min_v"), (0.5 * pick(low) + 0.5 * pick(high)).alias("median_v"), pick(F.ceil(F.lit(0.9) * F.col("n")) - 1).alias("p90_v"), F.max("max_v").alias("max_v"))
    return per.drop("_one")


def first_contacts(fetched: DataFrame, run: str, source: str, is_new: Column) -> DataFrame:
    """(source, runs, first_contacts): runs that fetched, and those of them in which all that was fetched was new."""
    per_run = fetched.groupBy(source, run).agg(F.count("*").alias("n"), F.count_if(is_new).alias("new"))
    return per_run.groupBy(source).agg(F.count("*").alias("runs"), F.count_if(F.col("n") == F.col("new")).alias("first_contacts"))


def agreement(browse: DataFrame, search: DataFrame, waiting: DataFrame, now: Column, hours: int) -> DataFrame:
    """(identity, state) of what two ways of listing a source disagree on.

    browse, search: identity; waiting: identity, since. In both: 'agrees', or 'returned' if it waited; in browse only:
    'new' where it doesn't wait yet, 'disagreement' after hours, else 'waiting'; waiting and in neither: 'gone'.
    """
    b = browse.select("identity").distinct().withColumn("_b", F.lit(True))
    s = search.select("identity").distinct().withColumn("_s", F.lit(True))
    w = waiting.groupBy("identity").agg(F.min("since").alias("since"))
    every = b.join(s, "identity", "full").join(w, "identity", "full")
    in_b, in_s, waits = (F.col(c).isNotNull() for c in ("_b", "_s", "since"))
    state = (
        F.when(in_s & waits, "returned").when(in_b & in_s, "agrees")
        .when(in_b & ~waits, "new").when(in_b & (F.col("since") <= now - F.make_dt_interval(hours=F.lit(hours))), "disagreement")
        .when(in_b, "waiting").when(waits, "gone")
    )
    return every.select("identity", state.alias("state")).where("state is not null")
