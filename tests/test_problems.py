"""Nested records, snapshots, timestamps and drifting schemas against brute force, and their edge cases."""

import datetime as dt
import itertools
import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.operators import drift, ranks, shred, snapshots, timestamps

PAGES = "page_id long, source string, board_id string, payload string, extra string"


def pages(spark, *payloads):
    return spark.createDataFrame([(i, "lever", "lever:x", p if p is None or isinstance(p, str) else json.dumps(p), "e") for i, p in enumerate(payloads)], PAGES)


# ---- nested records

def rebuild(nodes, root=0):
    """The value whose nodes these are."""
    node, _, _, _, kind, scalar = nodes[root]
    under = [n for n in nodes if n[1] == node]
    if kind == "object":
        return {n[2]: rebuild(nodes, n[0]) for n in under}
    if kind == "array":
        return [rebuild(nodes, n[0]) for n in sorted(under, key=lambda n: n[3])]
    return None if kind == "null" else scalar if kind == "string" else json.loads(scalar)


JSON = st.recursive(st.none() | st.booleans() | st.integers(-5, 5) | st.text("ab[{", max_size=3), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text("kl", max_size=2), x, max_size=3), max_leaves=12)


@settings(max_examples=200, deadline=None, database=None)
@given(JSON)
def test_shredding_round_trip(value):
    assert rebuild(shred.shred_text(json.dumps(value))) == value


def test_children(spark):
    d = [{"id": 1, "lists": [None, {"text": "a"}, 3, {}]}, {"id": "2", "lists": {"text": "b"}}, {"id": 3, "lists": json.dumps([{"text": "c"}])}, {"id": 4, "lists": None}, {"id": 5, "lists": "[broken"}, {"x": {"lists": [{}]}}, 7]
    df = pages(spark, d, {"jobs": [{"id": 6, "departments": [{"name": "n"}]}]}, {"id": 8, "customField": [{}]}, "{broken", None, "", "[NaN]", [], {"jobs": []})
    got = {tuple(r) for r in shred.children_found(df).collect()}
    assert got == {(0, "1", "lists", 1), (0, "1", "lists", 3), (0, "2", "lists", 0), (0, "3", "lists", 0), (1, "6", "departments", 0), (2, "8", "customField", 0)}
    tables = shred.flat_tables(df)
    assert {r["page_id"]: r["postings"] for r in tables["pages"].collect()} == {0: 6, 1: 1, 2: 1, 7: 0, 8: 0}
    assert shred.children_found(df.limit(0)).count() == 0
    assert sorted(r[0] for r in shred.invalid_pages(df.where("payload is not null")).collect()) == [3, 5, 6]


def test_deep_and_long(spark):
    deep = "[" * 400 + "]" * 400
    df = pages(spark, deep, [{"id": 1, "lists": [{"text": "x" * 200_000}]}])
    assert {tuple(r) for r in shred.children_found(df).collect()} == {(1, "1", "lists", 0)}


# ---- snapshots

def test_changes_equal_full_comparison(spark):
    random.seed(4)
    snaps = {1: {f"k{i:03}": random.choice("xyz") for i in range(300)}}
    for n in (2, 4, 5):
        last = dict(snaps[max(snaps)])
        for k in random.sample(sorted(last), 12):
            last.pop(k)
        for k in random.sample(sorted(last), 15):
            last[k] = random.choice("xyzw")
        last |= {f"n{n}{i}": "x" for i in range(9)}
        snaps[n] = last
    rows = [(n, k, v, dt.datetime(2026, 1, n)) for n, s in snaps.items() for k, v in s.items()]
    rows += rows[::7]  # delivered twice
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "snapshot_no int, k string, v string, taken_at timestamp")
    expected = set()
    for a, b in itertools.pairwise(sorted(snaps)):
        for k in snaps[a].keys() | snaps[b].keys():
            if snaps[a].get(k) != snaps[b].get(k):
                expected.add((b, k, "added" if k not in snaps[a] else "removed" if k not in snaps[b] else "changed"))
    for chunk in (1, 8, 10_000):
        assert {tuple(r) for r in snapshots.changes(df, "k", ignore=["taken_at"], chunk=chunk).collect()} == expected


def test_what_is_no_change(spark):
    rows = [(1, "a", " x  y ", ["1", "2"], None), (2, "a", "x y", ["2", "1", "1"], ""), (1, None, "q", None, None), (2, None, "r", None, None), (1, "b", "x", None, None), (2, "b", "x", [], None)]
    df = spark.createDataFrame(rows, "snapshot_no int, k string, v string, s array<string>, d string")
    assert snapshots.changes(df, "k").count() == 0
    assert snapshots.changes(df.where("snapshot_no = 1"), "k").count() == 0
    assert snapshots.changes(df.limit(0), "k").count() == 0


def test_equal_chunks_are_left_out(spark):
    """A chunk's boundaries depend on its keys alone, so a row put in elsewhere leaves its digest as it was."""
    keys = [(1, f"k{i:04}", i) for i in range(2000)]
    df = spark.createDataFrame([*keys, (1, "k0500x", 1)], "snapshot_no int, record_key string, digest long")
    with_, without = (dict(snapshots.chunked(x, 16, buckets=1).groupBy("chunk").agg(F.bit_xor("digest")).collect()) for x in (df, df.where("record_key <> 'k0500x'")))
    assert sum(with_.get(c) != x for c, x in without.items()) <= 1 and len(without) > 60


# ---- timestamps

BOARDS = [("b:ny", "America/New_York"), ("b:none", None), ("b:bad", "Mars/Olympus"), ("b:ny", "America/New_York")]
READ = {
    "2025-06-23T09:22:29Z": "2025-06-23T09:22:29.000000Z", "2025-06-23 09:22:29,5+05:45": "2025-06-23T03:37:29.500000Z", "2025-06-23T09:22:29.123456789-07": "2025-06-23T16:22:29.123456Z",
    " Fri, 06 Mar 2026 20:29:06 -0700 (PDT)\n": "2026-03-07T03:29:06.000000Z", "WED,  5 FEB 2025 14:17:46 EST": "2025-02-05T19:17:46.000000Z", "1743675736968": "2025-04-03T10:22:16.968000Z", "1744206363.0": "2025-04-09T13:46:03.000000Z",
    "1770006313055000": "2026-02-02T04:25:13.055000Z", "2026-04-19": "2026-04-19T00:00:00.000000Z", "20250418": "2025-04-18T00:00:00.000000Z", "05/28/2025": "2025-05-28T00:00:00.000000Z", "14/06/2025": "2025-06-14T00:00:00.000000Z", "05/05/2025": "2025-05-05T00:00:00.000000Z",
    "Mar 31, 2025 12:25:29 AM": "2025-03-31T04:25:29.000000Z", "2025-07-01T12:00:00": "2025-07-01T16:00:00.000000Z", "2025-09-09 00:23:33[Europe/Berlin]": "2025-09-08T22:23:33.000000Z", "20251117T131707+0200": "2025-11-17T11:17:07.000000Z", "30 Mar 2025": "2025-03-30T00:00:00.000000Z",
}
UNREAD = ["", "  ", None, "null", "3 days ago", "-1", "0", "99999999999999999999", "1970-01-01T00:00:00Z", "2025-13-01", "2026-02-30T10:00:00Z", "2026-05-05T25:61:00Z", "Mon, 32 Mar 2026 10:00:00 +0000", "0000-00-00", "2025-03-09T02:30:00", "2025-01-01 10:00:00 Mars/Olympus", "2025-01-01T10:00:00 +99:00", "13:00", "x" * 100_000]


def postings(spark, values, board="b:ny"):
    rows = [(i, v, "s", board, dt.datetime(2025, 1, 1) + dt.timedelta(hours=i), "clash") for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "posting_id long, published_raw string, source string, board_id string, fetched_at timestamp, readings string")


@pytest.fixture(scope="module")
def boards(spark):
    return spark.createDataFrame(BOARDS, "board_id string, zone string")


def test_readings(spark, boards):
    got = dict(map(tuple, timestamps.instants_found(postings(spark, list(READ)), boards).collect()))
    assert [got.get(i) for i in range(len(READ))] == list(READ.values())
    assert timestamps.instants_found(postings(spark, UNREAD), boards).count() == 0
    fold = timestamps.normalise(postings(spark, ["2025-11-02T01:30:00", "03/04/2025"]), boards).collect()
    assert all(r["interpretations"] == 2 and r["published_at"] is not None for r in fold)
    for board in ("b:none", "b:bad", "b:unlisted", None):
        assert timestamps.instants_found(postings(spark, ["2025-07-01T12:00:00"], board), boards).count() == 0
    assert timestamps.normalise(postings(spark, ["x"]).limit(0), boards).count() == 0


def test_context_decides(spark, boards):
    """Between day-first neighbours an ambiguous date is day-first, whatever the block size."""
    values = ["13/02/2025", "03/04/2025", "14/05/2025", "05/06/2025", "06/07/2025", "20/07/2025"]
    for block in (1, 2, 3, 100):
        got = {r["posting_id"]: r["published_at"] for r in timestamps.normalise(postings(spark, values), boards, block).collect()}
        assert [got[i].month for i in range(6)] == [2, 4, 5, 6, 7, 7]


def test_blocks_compose_to_the_best_path():
    random.seed(2)
    for _ in range(60):
        steps = [([random.choice("ab") for _ in range(k)], [random.randint(0, 9) for _ in range(k)]) for k in (random.randint(1, 3) for _ in range(6))]

        def cost(path, steps=steps):
            return sum(timestamps._transition(a, b)[i, j] for (a, b), (i, j) in zip(itertools.pairwise(steps), itertools.pairwise(path)))

        least = min(cost(p) for p in itertools.product(*[range(len(s[0])) for s in steps]))
        a, b = timestamps.block_costs(steps[:3]), timestamps.block_costs(steps[2:])
        assert np.isclose(np.min(a[:, :, None] + b[None]), least)
        entry, leave = divmod(int(timestamps.block_costs(steps).argmin()), len(steps[-1][0]))
        assert np.isclose(cost(timestamps.best_path(steps, entry, leave)), least)


def test_two_level_positions(spark):
    rows = [(random.Random(i).choice("aab"), i) for i in range(200)]
    got = ranks.positions(spark.createDataFrame(rows, "k string, i int"), ["k"], F.floor(F.col("i") / 16), ["i"], "pos")
    for key in "ab":
        assert [r["pos"] for r in sorted(got.where(F.col("k") == key).collect(), key=lambda r: r["i"])] == list(range(sum(k == key for k, _ in rows)))


# ---- drifting schemas

def records(spark, *files):
    rows = [(100 * n + i, 1, n, r if r is None or isinstance(r, str) else json.dumps(r), "x") for n, file in files for i, r in enumerate(file)]
    return spark.createDataFrame(rows, "record_id long, feed_id long, file_no int, payload string, type string")


def test_steps(spark):
    one = [{"id": i, "a": str(i), "b": {"c": i, "d": 1}, "e": [], "n": None} for i in range(5)]
    two = [{"id": i, "A": str(i), "b": {"k": i, "d": 1}, "e": [1], "n": 1, "new": {"x": 1}} for i in range(5)]
    five = [{"id": i, "A": i, "e": ["s"], "n": None if i else 2, "new": {"x": 1}} for i in range(5)]
    table, steps, *_ = drift.drift(records(spark, (1, one), (5, [*five, *five]), (2, two)))
    got = {(r["file_no"], r["path"], r["change"]) for r in steps.collect()}
    assert got == {(2, "a", "renamed"), (2, "b.c", "renamed"), (2, "e", "retyped"), (2, "n", "retyped"), (2, "new", "added"), (5, "A", "retyped"), (5, "b", "removed"), (5, "e", "retyped")}
    fields = {r["record_id"]: r["fields"] for r in table.collect()}
    assert fields[503]["a"] == "3" and fields[203]["b.c"] == "3" and fields[103]["a"] == "3"
    assert len(fields) == 20


def test_unreadable_records(spark):
    table, steps, *_ = drift.drift(records(spark, (1, [None, "", "{broken", "[1]", {"id": 1}]), (2, [{"id": 1}, {}])))
    assert steps.count() == 0 and table.count() == 7
    assert drift.drift(records(spark, (1, [None])).limit(0))[1].count() == 0


def test_casts_and_chained_levels(spark):
    """Fields that turn from scalars into objects stay one column; renames chain across levels; absent fields are null."""
    one = [{"id": i, "day": f"d{i}", "place": f"p{i}", "pay": {"currency": f"c{i}", "min": i}, "bare": {}} for i in range(5)]
    two = [{"id": i, "day": {"value": f"d{i}"}, "place": {"city": f"p{i}", "zip": i}, "pay": {"ccy": f"c{i}", "min": i}, "bare": {}} for i in range(5)]
    three = [{"id": i, "day": {"value": None} if i else {}, "place": None, "salary": {"ccy": f"c{i}", "min": i}} for i in range(5)]
    four = [{"id": i, "day": f"d{i}", "salary": {"cur": f"c{i}", "min": i}, "note": i} for i in range(5)] + [{}]
    table, steps, *_ = drift.drift(records(spark, (1, one), (2, two), (3, three), (4, four)))
    got = {(r["file_no"], r["path"], r["change"], r["new_path"]) for r in steps.where("change = 'renamed'").collect()}
    assert got == {(2, "pay.currency", "renamed", "pay.ccy"), (3, "pay", "renamed", "salary"), (4, "salary.ccy", "renamed", "salary.cur")}
    rows = {r["record_id"]: r["fields"] for r in table.collect()}
    every = {"id", "day", "place", "pay.currency", "pay.min", "bare", "note"}
    assert all(set(f) == every for f in rows.values())
    assert [rows[n]["day"] for n in (102, 202, 302, 300, 402)] == ["d2", "d2", None, "{}", "d2"]
    assert [rows[n]["place"] for n in (102, 202, 302)] == ["p2", '{"city": "p2", "zip": 2}', None]
    assert [rows[n]["pay.currency"] for n in (102, 202, 302, 402)] == ["c2"] * 4 and [rows[n]["pay.min"] for n in (102, 202, 302, 402)] == ["2"] * 4
    assert [rows[n]["bare"] for n in (102, 202, 302)] == ["{}", "{}", None] and rows[402]["note"] == "2" and set(rows[405].values()) == {None}


def test_one_name_for_a_source(spark):
    """A feed that starts after a rename shares the field of one that saw it; a feed that holds both names keeps two."""
    old, new = [{"id": i, "pay": {"currency": f"c{i}"}, "n": i} for i in range(5)], [{"id": i, "pay": {"ccy": f"c{i}"}, "n": i / 2} for i in range(5)]
    rows = [(1000 * feed + 100 * n + i, feed, n, json.dumps(r), source) for feed, n, file, source in ((1, 1, old, "s"), (1, 2, new, "s"), (2, 5, new, "s"), (3, 1, new, "t"), (4, 1, [{"id": 1, "a": "x", "b": "x"}], "s")) for i, r in enumerate(file)]
    found = drift.drift(spark.createDataFrame(rows, "record_id long, feed_id long, file_no int, payload string, source string"))
    fields = {r["record_id"]: r["fields"] for r in found.table.collect()}
    assert fields[2503]["pay.currency"] == "c3" == fields[1203]["pay.currency"] and "pay.ccy" not in fields[2503] and fields[3103]["pay.ccy"] == "c3"
    assert {(r["source"], r["field"]): r["type"] for r in found.columns.collect()} == {("s", "id"): "bigint", ("s", "n"): "double", ("s", "pay.currency"): "string", ("s", "a"): "string", ("s", "b"): "string", ("t", "id"): "bigint", ("t", "n"): "double", ("t", "pay.ccy"): "string"}
    assert found.clashes.count() == 0
    prints = {(r["feed_id"], r["file_no"]): (r["version"], r["fingerprint"]) for r in found.versions.collect()}
    assert prints[1, 2][0] == 2 and prints[2, 5][1] == prints[1, 2][1] != prints[1, 1][1]
    wide = drift.typed(found, spark.createDataFrame(rows, "record_id long, feed_id long, file_no int, payload string, source string"), "s")
    got = {r["record_id"]: r["n"] for r in wide.collect()}
    assert dict(wide.dtypes)["n"] == "double" and got[1203] == 1.5 and got[1103] == 3.0


def test_clashes_are_reported(spark):
    """A wrapped member and the bare value of one record may not silently become one."""
    one = [{"id": i, "a": f"v{i}"} for i in range(5)]
    two = [{"id": i, "b": f"v{i}"} for i in range(5)]
    three = [{"id": i, "b": f"v{i}", "a": f"w{i}"} for i in range(5)]
    found = drift.drift(records(spark, (1, one), (2, two), (3, three)))
    clashing = {(r["record_id"], r["field"], r["n_values"]) for r in found.clashes.collect()}
    fields = {r["record_id"]: r["fields"] for r in found.table.collect()}
    assert clashing in ({(300 + i, "a", 2) for i in range(5)}, set()) and all(set(f) >= {"id", "a"} for f in fields.values())


def test_only_child_lists_are_unwrapped(spark):
    """Texts that look like JSON stay texts, but for those under the labels asked for."""
    nodes = shred.adjacency(pages(spark, {"title": "[1]", "text": "{}", "lists": '[{"a": "[2]"}]'}), unwrap=("lists",))
    got = {(r["label"], r["kind"], r["scalar"]) for r in nodes.collect() if r["label"]}
    assert got == {("title", "string", "[1]"), ("text", "string", "{}"), ("lists", "array", None), ("a", "string", "[2]")}


def test_a_bulk_load_is_many_shards(spark, boards):
    """All rows fetched at one moment: the order within it goes by id, over ranges of rows."""
    values = ["13/02/2025", "03/04/2025", "14/05/2025", "05/06/2025", "06/07/2025", "20/07/2025"] * 50
    one = postings(spark, values).withColumn("fetched_at", F.lit("2025-01-01").cast("timestamp"))
    got = {r["posting_id"]: r["published_at"].month for r in timestamps.normalise(one, boards, 7).collect()}
    assert len(got) == 300 and [got[i] for i in range(6)] == [2, 4, 5, 6, 7, 7]
