import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedloom.operators import chain, grouping, runs, shapes, stores

DAY = dt.datetime(2026, 1, 1)


def ids(df, c="id"):
    return sorted(r[c] for r in df.collect())


def test_split_and_append(spark, tmp_path):
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, id int")
    known = spark.createDataFrame([("b",), (None,)], "k string")
    new, old = stores.split_new(batch, known, "k")
    assert ids(new) == [1, 2, 4] and ids(old) == [3]
    path = str(tmp_path / "layer")
    assert stores.append_delta(batch, path, "k") == 4  # an absent layer is empty; repeats within a batch stay
    assert stores.append_delta(batch.where("k is not null"), path, "k") == 0  # a second run adds nothing
    assert spark.read.parquet(path).count() == 4


def test_overlay_sets_null_too(spark):
    base = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    facts = spark.createDataFrame([(1, None)], "id int, v string")
    assert {tuple(r) for r in stores.overlay(base, facts, "id", ["v"]).collect()} == {(1, None), (2, "y")}


def test_differs_and_duplicates(spark):
    rows = spark.createDataFrame([(1, "a"), (2, ""), (3, "c"), (4, "d")], "id int, v string")
    target = spark.createDataFrame([(1, "a "), (2, None), (3, "c"), (3, "c")], "id int, v string")
    assert dict(map(tuple, stores.differs(rows, target, "id", ["v"]).collect())) == {1: "unchanged", 2: "unchanged", 3: "changed", 4: "new"}


def test_seen_merge_keeps_first(spark):
    seen = spark.createDataFrame([("a", DAY, None, "s", "b", DAY)], "identity string, first_seen timestamp, published_at timestamp, source string, board_id string, last_seen timestamp")
    polled = spark.createDataFrame([("a", DAY, "t", "b"), ("n", None, "t", "c")], "identity string, published_at timestamp, source string, board_id string")
    now = dt.datetime(2026, 2, 1)
    got = {r["identity"]: r for r in stores.merge_seen(seen, polled, F.lit(now)).collect()}
    assert got["a"]["first_seen"] == DAY and got["a"]["last_seen"] == now and got["a"]["source"] == "t" and got["a"]["published_at"] == DAY
    assert got["n"]["first_seen"] == now


def test_refuse(spark):
    with pytest.raises(ValueError):
        stores.refuse_unlisted(spark.createDataFrame([("a",), (None,)], "s string"), "s", ["a"])


def test_rules_in_order(spark):
    rows = spark.createDataFrame([("cook", 9, 1), ("cook", 1, 2), ("chef", 9, 3), (None, None, 4)], "title string, n int, id int")
    rules = [chain.rule("terms", column=F.col("title"), wanted=["cook"]), chain.rule("above", column=F.array("n"), limit=5, name="years")]
    judged = chain.judged(rows, rules)
    assert {r["id"]: r["drop_rule"] for r in judged.collect()} == {1: "years", 2: None, 3: "terms", 4: "terms"}
    assert {tuple(r) for r in chain.drop_counts(judged, [*rules, chain.rule("expiry", now="x")]).collect()} == {("terms", 2), ("years", 1), ("expiry", 0)}
    with pytest.raises(ValueError):
        chain.register_rule("above")(lambda: None)


def test_whole_words(spark):
    df = spark.createDataFrame([("storage",), ("rags",), ("rag_x",), ("ärag",), ("rag, x",)], "t string")
    assert [r[0] for r in df.select(chain.first_term(F.col("t"), ["rag"])).collect()] == [None, "rag", None, None, "rag"]


def test_age_is_inclusive(spark):
    df = spark.createDataFrame([(DAY + dt.timedelta(days=7), DAY), (DAY + dt.timedelta(days=7, seconds=1), DAY), (DAY, None)], "f timestamp, d timestamp")
    judged = chain.judged(df, [chain.rule("older", first=F.col("f"), dated=F.col("d"), days=7)])
    assert [r["drop_rule"] for r in judged.collect()] == [None, "older", None]


def test_groups(spark):
    rows = spark.createDataFrame([("b", "E", "x:1", "T.", DAY, "Rome"), ("a", "e", "x:1", "t", DAY, None), ("c", None, "x:1", "t", DAY, "")], "identity string, employer string, board_id string, title_normalised string, published_at timestamp, location string")
    got = {r["group_key"]: (r["representative"], r["size"], r["locations"]) for r in grouping.groups(rows).collect()}
    assert got == {"e|t|2026-01-01": ("a", 2, "Rome"), "board:x:1|t|2026-01-01": ("c", 1, "")}
    assert tuple(grouping.counts(grouping.groups(rows.limit(0))).first()) == (0, 0, 0, 0)


def test_absences_and_streaks(spark):
    last = spark.createDataFrame([("p", "b", DAY), ("q", "none", DAY)], "identity string, board_id string, last_seen timestamp")
    polled = spark.createDataFrame([("b", DAY + dt.timedelta(days=i)) for i in range(4)], "board_id string, run_at timestamp")
    closed = {r["identity"]: r["closed_at"] for r in runs.nth_absence(last, polled, 3).collect()}
    assert closed == {"p": DAY + dt.timedelta(days=3), "q": None}
    ok = spark.createDataFrame([("u", 1, True), ("u", 2, False), ("u", 3, False), ("v", 1, False)], "k string, t int, ok boolean")
    assert {tuple(r) for r in runs.trailing_streak(ok, "k", "t", F.col("ok")).collect()} == {("u", 2, 2), ("v", 1, 1)}


def test_spread_known_answer(spark):
    df = spark.createDataFrame([(x,) for x in (11, 36, 12, 12)], "v int")
    assert tuple(runs.spread(df, F.col("v")).first()) == (4, 11, 12.0, 36, 36)


def test_shapes(spark):
    cells = spark.createDataFrame([("s", 1, "a", "string"), ("s", 2, "a", "null"), ("s", 1, "b", "number")], "s string, record_id long, path string, type string")
    records = spark.createDataFrame([("s", 1), ("s", 2)], "s string, record_id long")
    now = shapes.shape(cells, records, "s")
    assert {tuple(r) for r in now.collect()} == {("s", "a", "all", "some", "string"), ("s", "b", "some", "never", "number")}
    assert {tuple(r) for r in shapes.compare(now.where("path = 'a'"), now, "s").collect()} == {("s", "b", "absent", "some/never/number")}


def test_first_in_range_equals_nested_loop(spark):
    import random

    random.seed(1)
    left = [(i, random.choice("ab"), DAY + dt.timedelta(hours=random.randint(0, 100))) for i in range(40)]
    right = [(100 + i, random.choice("abc"), DAY + dt.timedelta(hours=random.randint(0, 100))) for i in range(60)]
    got = stores.first_in_range(spark.createDataFrame(left, "id int, k string, t timestamp"), spark.createDataFrame(right, "rid int, k string, at timestamp"), ["k"], "at", "t", 1, ["at", "rid"], "id")
    for r in got.collect():
        hits = [(at, rid) for rid, k, at in right if k == r["k"] and r["t"] < at <= r["t"] + dt.timedelta(days=1)]
        assert r["first_rid"] == (min(hits)[1] if hits else None)


def test_every_snapshot_takes_part(spark, tmp_path):
    """first_seen and published_at known from early snapshots alone reach the store; each step has its differences."""
    from feedloom.plans import reference

    day = lambda n: dt.datetime(2026, 1, n)
    shot = lambda n, identity, first, published, title: (n, day(10 + n), identity, first, published, "s", "b", day(n), title, "l", "u")
    rows = [shot(1, "a", day(1), day(2), "t"), shot(1, "gone", day(1), None, "t"), shot(2, "a", day(5), None, "t2"), shot(3, "a", day(6), day(7), "t2"), shot(3, "c", day(8), None, "x")]
    schema = "snapshot_no int, taken_at timestamp, identity string, first_seen timestamp, published_at timestamp, source string, board_id string, last_seen timestamp, title string, location string, url string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/seen_snapshots.parquet")
    run = lambda name: reference.queries()[name](spark, str(tmp_path)).collect()
    us = {n: r[0] for n in (1, 2, 11, 13) for r in spark.createDataFrame([(day(n),)], "d timestamp").selectExpr("unix_micros(d)").collect()}
    got = {r["identity"]: (r["first_seen_us"], r["published_us"], r["last_seen_us"]) for r in run("seen_merge_all")}
    assert got == {"a": (us[1], us[2], us[13]), "gone": (us[1], None, us[1]), "c": (us[13], None, us[13])}
    assert {tuple(r) for r in run("display_diff_all")} == {(2, "a", "changed"), (3, "a", "unchanged"), (3, "c", "new")}
    assert {r["identity"]: r["title"] for r in run("as_written_merge_all")} == {"a": "t2", "gone": "t", "c": "x"}
