import json

import pytest

from feedloom.operators import jsonwalk, publish
from feedloom.sources import config, fetching


def test_guard():
    waits, answers = [], [fetching.Passing("x", after=9), fetching.Passing("x"), "ok"]

    def fetch():
        x = answers.pop(0)
        if isinstance(x, Exception):
            raise x
        return x

    guard = fetching.Guard(budget=5, sleep=waits.append, breaks=5)
    assert guard.call("a", fetch) == "ok" and waits == [9, 2.0] and (guard.used, guard.retried) == (3, 2)

    def fail():
        raise fetching.Passing("no")

    broken = fetching.Guard(budget=9, breaks=2)
    with pytest.raises(fetching.Refused, match="circuit"):
        broken.call("a", fail)
    assert broken.open_circuits() == ["a"] and broken.call("b", lambda: 1) == 1
    with pytest.raises(fetching.Refused, match="budget"):
        fetching.Guard(budget=0).call("a", fail)


def test_walk_and_resume():
    feed = [["2026-05", "2026-04"], ["2026-03", None], ["2026-02"], ["2026-01"]]

    def fetch(cursor):
        i = cursor or 0
        return feed[i], i + 1 if i + 1 < len(feed) else None

    go = lambda mark, cap, cursor=None: fetching.walk(fetch, lambda page: page, mark, cap, cursor)
    assert (go("2026-03", 9).stopped_by, len(go("2026-03", 9).pages)) == ("mark", 2)
    assert (go(None, 9).stopped_by, len(go(None, 9).pages)) == ("end", 4)
    cut = go("2026-01", 2)
    held = fetching.resume(None, cut, "2026-01")
    assert (cut.stopped_by, held) == ("cap", {"cursor": 2, "mark": "2026-01"})
    assert fetching.resume(held, go("2026-04", 1), "2026-04") == {"cursor": 1, "mark": "2026-01"}
    assert len(go(held["mark"], 9, held["cursor"]).pages) == 2
    assert fetching.resume(held, go("2026-03", 9), "2026-03") == held and fetching.resume(held, go(None, 9), None) is None


def test_landed_pages(spark, tmp_path):
    spark.dataSource.register(fetching.LandedPages)
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(json.dumps({"source": "lever", "board_id": "lever:x", "payload": [{"id": i}]}))
    (tmp_path / "3.json").write_text("{broken")
    got = spark.read.format("landed_pages").load(str(tmp_path)).orderBy("page").collect()
    assert [r["source"] for r in got] == ["lever"] * 3 + [None] and got[3]["payload"] == "{broken"
    stream = spark.readStream.format("landed_pages").load(str(tmp_path))
    query = stream.writeStream.format("memory").queryName("landed").option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("landed").count() == 4


def test_config(spark, tmp_path):
    path = tmp_path / "boards.json"
    path.write_text(json.dumps([{"platform": "lever", "slug": "x", "poll_slots": ["08:00"], "deep_slots": ["08:00"]}, {"platform": "lever", "slug": "y"}]))
    boards = config.load_boards(spark, str(path), ["lever"])
    assert {(r["board_id"], r["deep"]) for r in config.boards_due(boards, "08:00").collect()} == {("lever:x", True), ("lever:y", False)}
    path.write_text(json.dumps([{"platform": "z", "slug": ""}, 3, {"platform": "lever", "slug": "x", "poll_slots": ["8"]}, {"platform": "lever", "slug": "x", "deep_slots": ["09:00"]}]))
    with pytest.raises(config.ConfigError) as error:
        config.load_boards(spark, str(path), ["lever"])
    assert len(str(error.value).splitlines()) == 6
    terms = tmp_path / "terms.md"
    terms.write_text("# Kitchen\n- Head  Cook\n- cook\n## Hall\n* night porter\n")
    assert config.load_terms(str(terms), ["cook"]) == [(0, "head cook", "Kitchen"), (1, "cook", "Kitchen"), (2, "night porter", "Hall")]
    with pytest.raises(config.ConfigError):
        config.load_terms(str(terms))


def test_publish(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "s"), (2, None, "t"), (2, None, "t")], "id int, v string, source string")
    path = str(tmp_path / "table")
    first = publish.publish(df, path)
    assert publish.publish(df.repartition(3), path) == first  # the same content is no new version
    assert publish.publish(df.distinct(), path, ["source"])["version"] == 2
    assert publish.newest(spark, path).count() == 2
    assert {r["source_class"] for r in publish.routed(df, "source", ["s"]).collect()} == {"public", "private"}


def test_json(spark):
    value = {"a": [{"c": 1}, {"b": None}, {"b": 2}], "m": "x@y.example", "t": "secret", "d": {"t": "s", "n": 1}}
    assert jsonwalk.first_at(value, "a.b") == [None] and jsonwalk.first_at(value, "a.z") == []
    df = spark.createDataFrame([(json.dumps(value),), ("{",), (None,)], "p string")
    from pyspark.sql import functions as F

    assert [r[0] for r in df.select(jsonwalk.resolved(F.col("p"), "d.n")).collect()] == ["1", None, None]
    clean = json.loads(df.select(jsonwalk.sanitise(F.col("p"), ["t"])).first()[0])
    assert clean["m"] == "someone@example.org" and clean["t"] == clean["d"]["t"] == "removed"
    assert df.select(jsonwalk.trimmed(F.col("p"), "m string")).first()[0] == '{"m":"x@y.example"}'
