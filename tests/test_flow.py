"""Flows, run logs and contracts on empty tables, nulls, ties and repeats."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedloom import session
from feedloom.functions import descriptions as D
from feedloom.functions import text as T
from feedloom.operators import chain, flow, publish, runlog, runs, shapes
from feedloom.sources import config, fetching, platforms
from feedloom.streaming import ingest

DAY = dt.datetime(2026, 1, 1)
POLL = "run_at timestamp, board_id string, source string, status string, requests long, fetched long, new long, stopped_by string, mark timestamp, detail string"


def test_run_logs(spark, tmp_path):
    later = DAY + dt.timedelta(days=1)
    polls = spark.createDataFrame([(DAY, "a", "s", "ok", 1, 2, 2, "end", None, ""), (DAY, "b", "s", "failed", 1, 0, 0, None, None, "x"), (later, "a", "s", "ok", 1, 0, 0, None, None, None), (later, "b", None, "ok", 1, 3, 1, "mark", DAY, "")], POLL)
    folder = str(tmp_path / "logs")
    runlog.write(runlog.assemble(polls, 2), folder)
    logs = runlog.read(spark, folder)
    assert [(r["run_at"], r["stopped"], r["totals"]["fetched"]) for r in logs.orderBy("run_at").collect()] == [(DAY, "request ceiling", 2), (later, "request ceiling", 3)]
    quiet = {r["board"]: (r["runs"], r["since"], r["days"], r["statuses"]) for r in runlog.quiet_boards(runlog.board_runs(logs)).collect()}
    assert quiet == {"a": (1, later, 0.0, ["ok"])}
    empty = runlog.assemble(polls.limit(0), 2)
    assert empty.count() == runlog.quiet_boards(runlog.board_runs(empty)).count() == runlog.stops(empty).count() == runlog.summary(empty).count() == 0
    assert runlog.read(spark, folder, last=1).count() == 1 and runlog.read(spark, folder, month="2025-01").count() == 0


def test_polls_are_isolated():
    def fetch(board):
        raise {"x": fetching.Passing("later"), "y": fetching.Refused("budget used up")}.get(board) or OSError("gone")

    assert [(p.board_id, p.status) for p in flow.poll(["o", "x", "y", "z"], fetch)] == [("o", "error"), ("x", "failed"), ("y", "not reached"), ("z", "not reached")]
    assert flow.poll([], fetch) == []


ROW = "identity string, source string, board_id string, employer string, title string, title_normalised string, location string, url string, published_at timestamp, n int"


def test_plan_and_backfill(spark):
    rows = spark.createDataFrame([("s:1", "s", "b", "E", "Cook", "Cook", "Rome", "u", DAY, 1), ("s:2", "s", "b", "E", "Cook", "Cook", "Bari", "u", DAY, 1), ("s:3", "s", "b", None, "Chef", "Chef", None, None, None, 1), ("h:1", "h", "b", "E", "Cook", "Cook", "Rome", "u", DAY, 1), ("s:4", None, None, None, None, None, None, None, None, 9)], ROW)
    rules = [chain.rule("above", column=F.array("n"), limit=5)]
    shown = spark.createDataFrame([("s:3", "Chef", "", None)], "identity string, title string, location string, url string")
    sent, stages = flow.plan(rows, rules, held=["h"], shown=shown)
    told = {r["stage"]: r["n"] for r in stages.collect()}
    assert (told["rows"], told["rows held"], told["rows admitted"], told["groups"], told["groups new"], told["groups unchanged"]) == (5, 1, 3, 2, 1, 1)
    assert [r["representative"] for r in sent.collect()] == ["s:1"]
    stored = spark.createDataFrame([("s:2",)], "identity string")
    assert flow.plan(rows, rules, held=["h"], stored=stored, shown=shown)[0].count() == 0
    assert flow.plan(rows.limit(0), rules)[0].count() == 0
    gap, steps = flow.backfill(rows, None, [], rules, stored)
    assert sorted(r["identity"] for r in gap.collect()) == ["h:1", "s:1", "s:3"] and {r["step"]: r["n"] for r in steps.collect()} == {"read": 5, "admitted": 4, "to append": 3}
    assert flow.backfill(rows, None, [], rules, rows)[0].count() == 0  # a second pass appends nothing


def test_facts_and_marks(spark):
    raw = spark.createDataFrame([("a", 2, "new"), ("a", 1, "first"), ("b", 3, "x")], "identity string, row_id int, text string")
    stored = spark.createDataFrame([("a", "old", "f0"), ("b", "kept", "f1"), ("gone", "old", "f0")], "identity string, fact string, fingerprint string")
    got = {tuple(r) for r in flow.reread(raw, lambda df: df.select("identity", F.col("text").alias("fact")), stored, "f1").collect()}
    assert got == {("a", "first", "f1"), ("b", "kept", "f1"), ("gone", "old", "f0")}
    assert flow.fingerprint_of(1, "a") == flow.fingerprint_of(1, "a") != flow.fingerprint_of(1, "b")
    parts = [spark.createDataFrame(x, "k string, v string") for x in ([("a", "1"), ("b", "1")], [("a", None)])]
    assert {tuple(r) for r in flow.merged_parts(parts, "k").collect()} == {("a", None), ("b", "1")}


def test_closing(spark):
    posts = spark.createDataFrame([("a", "b", DAY, DAY, None), ("e", "b", DAY, DAY, "2026-01-01"), ("n", "x", None, DAY, None), ("u", "b", None, None, None)], "identity string, board_id string, published_at timestamp, last_seen timestamp, expires_at string")
    polled = spark.createDataFrame([(DAY + dt.timedelta(days=d), "b", status, 1, "mark", mark) for d, status, mark in ((1, "ok", DAY - dt.timedelta(days=9)), (2, "failed", DAY), (3, "ok", DAY), (4, "ok", DAY - dt.timedelta(days=9)))], "run_at timestamp, board_id string, status string, fetched long, stopped_by string, mark timestamp")
    got = {r["identity"]: r["closed_on"] for r in runs.closed(posts, polled, 2, "2026-01-02").collect()}
    assert got == {"a": "2026-01-05", "e": "2026-01-01", "n": None, "u": None}


def test_spread_is_exact_for_hot_and_tied_groups(spark):
    df = spark.createDataFrame([("hot", float(i % 7)) for i in range(2000)] + [("tied", 5.0)] * 9 + [("four", x) for x in (1.0, 2.0, 4.0, None, 9.0)] + [("none", None), (None, 3.0)], "k string, v double")
    got = {r["k"]: tuple(r)[1:] for r in runs.spread(df, F.col("v"), "k").collect()}
    values = sorted(float(i % 7) for i in range(2000))
    assert got == {"hot": (2000, 0.0, (values[999] + values[1000]) / 2, values[1799], 6.0), "tied": (9, 5.0, 5.0, 5.0, 5.0), "four": (4, 1.0, 3.0, 9.0, 9.0), None: (1, 3.0, 3.0, 3.0, 3.0)}
    eleven = spark.createDataFrame([(float(x),) for x in (11, 36, 12, 12)], "v double")
    assert tuple(runs.spread(eleven, F.col("v")).first()) == (4, 11.0, 12.0, 36.0, 36.0)


def test_contract_statuses(spark):
    shape = "platform string, section string, path string, shape string"
    old, new = spark.createDataFrame([("a", "p", "x", "1"), ("b", "p", "x", "1")], shape), spark.createDataFrame([("a", "p", "x", "2"), ("n", "p", "x", "1")], shape)
    failures = spark.createDataFrame([("b", "unreachable")], "platform string, status string")
    names = spark.createDataFrame([("a",), ("b",), ("n",)], "platform string")
    assert {tuple(r) for r in shapes.statuses(names, old, new, failures, old.limit(0)).collect()} == {("a", "changed", 1), ("b", "unreachable", 0), ("n", "baseline", 0)}
    assert {tuple(r) for r in shapes.kept_sections(old, new, names).collect()} == {("a", "p", "x", "2"), ("n", "p", "x", "1"), ("b", "p", "x", "1")}


def test_small_functions(spark, tmp_path):
    env = tmp_path / "env"
    env.write_text("A=1\nbad line\n")
    with pytest.raises(config.ConfigError, match="line 2"):
        config.load_env(str(env))
    assert config.missing_names({"A": " "}, ["A", "B"]) == ["A", "B"]
    with pytest.raises(ValueError):
        T.register_normaliser("strip_location", None)
    titles = spark.createDataFrame([("Cook - Rome", "Rome", ["strip_location"]), ("Cook - Rome", "Rome", None)], "t string, l string, n array<string>")
    assert [r[0] for r in titles.select(T.normalised(F.col("t"), F.col("l"), F.col("n"))).collect()] == ["Cook", "Cook - Rome"]
    assert D.role_pattern(["head  chef", "chef", " "]) == r"(?i)\b(?:head\s+chefs?|chefs?)\b" and D.role_pattern([]) == "(?!)"
    import base64

    secrets = [base64.b64encode(b"x" * k + b"long-secret-key").decode() for k in range(3)]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in secrets], "s string").select(publish.redact(F.col("s"), ["long-secret-key"])).collect()]
    assert all("***" in s for s in got)
    heads = spark.createDataFrame([("Cook, Alba, Inc.",), ("Cook",), ("",), (None,)], "t string").select(platforms.role_and_employer(F.col("t")).alias("r")).collect()
    assert [tuple(r["r"]) if r["r"] else None for r in heads][:3] == [("Cook", "Alba, Inc."), ("Cook", None), ("", None)]


def test_streams_of_nothing_and_repeats(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 3)], "k string, run int")
    assert {tuple(r) for r in ingest.absences(df, "k", "run").collect()} == {("a", 1, 2), ("b", 3, 0)}
    assert ingest.sent_once(df, "k").count() == 2 and ingest.sent_once(df.limit(0), "k").count() == 0


def test_a_cluster_needs_a_shared_folder(spark):
    class Conf(dict):
        def get(self, name, default=None):
            return dict.get(self, name, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.scratch_dir(Session())
    assert session.scratch_dir(spark).split("/")[-1].startswith("feedloom-")
