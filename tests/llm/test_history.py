import datetime
import random
from collections import Counter

from feedloom.llm import history_dedup as H
from tests.llm.test_places import REF, SCHEMA
from tests.test_text import edits

ROW = "row_id long, identity string, external_id string, first_seen timestamp, employer string, board_id string, title string, location string, batch_no int, place string, name string, bucket string"
NAMES = ("Amber", "Birchwood", "Cobalt", "Dune", "Ember", "Fjord", "Glacier", "Harbor", "Island", "Jungle")
DAY = datetime.datetime(2026, 1, 1)


def rows(spark, *values, batch=1):
    return spark.createDataFrame([(i, f"s:{i}", str(i), DAY, *rest, batch, "clash", "clash", "clash") for i, *rest in values], ROW)


def pairs(df):
    return {tuple(r) for r in df.collect()}


HISTORY = [
    (1, "Zanlodcor Labs", "x:1", "Senior Data Analyst, Payments Growth", "Lomméeira, Germany"), (2, "Zanlodcor Labs", "x:1", "Junior Data Analyst, Payments Growth", "Lomméeira, Germany"),
    (3, None, "x:1", "Lead Recruiter, Billing", "Yaslobia, United Arab Emirates"), (4, "Bolvorado Health", "x:2", None, None), (5, "Zanlodcor Labs", "x:1", "Senior Recruiter, Billing", "Lomméeira"),
]
INCOMING = [
    (101, "ZANLODCOR LABS GmbH", "y:9", "Payments Growth: Sr. Data Analyst (m/f/d) [REF-12]", "Remote - LOMMEEIRA, DE"),  # 1
    (102, "Zanlodocr Labs", "y:9", "Se​nior Data Analyst - Payments Growth", "Germany / Ostridge / Lomméeira"),  # 1, slip in the employer
    (103, "Zanlodcor Labs", "x:1", "Staff Data Analyst, Payments Growth", "Lomméeira, Germany"),  # another level
    (104, "Zanlodcor Labs", "x:1", "Senior Data Analyst, Billing Growth", "Lomméeira, Germany"),  # another area
    (105, "Zanlodcor Labs", "x:1", "Senior Data Analyst, Payments Growth", "Yaslobia"),  # another place
    (106, "Zanlodcor Labs", "z:3", "Recruiter, Lead (Billing) - Yaslobia", "Yaslobia"),  # 3, whose board has one employer
    (107, "Bolvorado Health", "x:2", "", ""),  # 4
    (108, "The Zanlodcor Labs", "x:1", "Staff Data Analyst, Payments Growth", "Lommeeira"),  # 103
    (109, "Zanlodcor Labs", "x:1", "URGENT: staff data analyst - payments growth", "Lomméeira (Hybrid)"),  # 103
    (110, None, None, None, None),
]
EXPECTED = {(1, 101), (1, 102), (3, 106), (4, 107), (103, 108), (103, 109)}


def test_repeats(spark):
    ref = spark.createDataFrame(REF, SCHEMA)
    history, incoming = rows(spark, *HISTORY), rows(spark, *INCOMING)
    assert pairs(H.find_repeats(history, incoming, ref)) == EXPECTED
    assert pairs(H.in_one_pass(history, incoming, ref)) == EXPECTED
    assert pairs(H.find_repeats(history.limit(0), incoming, ref)) >= {(103, 108), (103, 109), (101, 102)}
    assert H.find_repeats(history, incoming.limit(0), ref).count() == 0


def test_batches_over_many_partitions_give_the_same(spark, tmp_path):
    ref = spark.createDataFrame(REF, SCHEMA)
    parts = [rows(spark, *INCOMING[a:b], batch=n) for n, (a, b) in enumerate(((0, 3), (3, 8), (8, None)))]
    incoming = parts[0].unionByName(parts[1]).unionByName(parts[2])
    kept, found = H.by_batch(rows(spark, *HISTORY), incoming, ref, path=str(tmp_path / "h"), per_bucket=1)
    assert kept.buckets == len(HISTORY) and set().union(*(pairs(f) for _, f in found)) == EXPECTED
    again = rows(spark, *[(i + 1000, *rest) for i, *rest in INCOMING])
    opened = H.History.open(spark, str(tmp_path / "h"))
    assert opened.batch == 3
    from feedloom.session import materialize

    assert opened.check(materialize(H.read_rows(again, ref))).count() == len(INCOMING)  # all are known by now


def test_many_copies_are_one_class(spark):
    ref = spark.createDataFrame(REF, SCHEMA)
    copies = rows(spark, *[(1000 + i, "Zanlodcor Labs", "x:1", "Senior Data Analyst, Payments Growth", "Lomméeira") for i in range(3000)])
    got = H.find_repeats(rows(spark, *HISTORY), copies, ref)
    assert got.count() == 3000 and got.where("accepted_row_id <> 1").count() == 0


def test_links_equal_brute_force(spark):
    """Cells and pivots lose no pair that the words and names make one."""
    random.seed(3)
    words = ["".join(random.choices("abcde", k=random.randint(4, 9))) for _ in range(40)]
    slip = lambda w, i: w[:i] + random.choice("abcde") + w[i + random.randint(0, 1) :]
    points = set()
    for _ in range(60):
        title, name = random.sample(words, 3), random.choice(words)
        points |= {(" ".join(title), name), (" ".join(reversed(title)), slip(name, 1)), (" ".join([slip(title[0], 2), *title[1:]]), name), (f"{title[0][:2]} {title[0][2:]} {title[1]} {title[2]}", name)}
    points = sorted(points)
    table = H.pivot_table(spark.createDataFrame([("p", t, n, i) for i, (t, n) in enumerate(points)], "place string, title string, name string, first long")).withColumn("stored", H.F.lit(False))
    got = {(r["target"], r["item"]) for r in H.links(H.asked(table.drop("stored"), 7), table).collect()}

    def alike(a, b):
        (t, n), (u, m) = a, b
        ours, theirs = ("".join(dict.fromkeys(w for w in x.split() if w not in y.split())) for x, y in ((t, u), (u, t)))
        bags = Counter(t.replace(" ", "")), Counter(u.replace(" ", ""))
        if sum(((bags[0] - bags[1]) + (bags[1] - bags[0])).values()) > 2 or edits(n, m) > 1:
            return False
        return ours == theirs == "" or (min(len(ours), len(theirs)) >= 3 and max(len(ours), len(theirs)) > 3 and edits(ours, theirs) <= 1)

    assert got == {(i, j) for j in range(len(points)) for i in range(j) if alike(points[i], points[j])}
    assert len(got) > 100


def test_common_words_one_letter_apart_stay_two(spark):
    ref = spark.createDataFrame(REF, SCHEMA)
    history = [(i, name, f"h:{i}", ("Staff", "Stuff")[i % 2] + " Planner", "Yaslobia") for i, name in enumerate(NAMES)]
    incoming = [(101, "Birchwood", "h:1", "Staff Planner", "Yaslobia"), (102, "Birchwood", "h:1", "Stuff Planer", "Yaslobia")]
    assert pairs(H.find_repeats(rows(spark, *history), rows(spark, *incoming), ref)) == {(1, 102)}


def test_boards_stand_for_unknown_employers(spark):
    """Two boards one letter apart are two employers; a board's employer that becomes known claims its nameless openings."""
    ref = spark.createDataFrame(REF, SCHEMA)
    history = [(11, None, "lever:acme1", "Query Writer", "Yaslobia"), (12, None, "n:1", "Editor", "Yaslobia")]
    first = rows(spark, (101, None, "lever:acme2", "Query Writer", "Yaslobia"), (102, None, "lever:acme1", "Query Writer", "Yaslobia"), (103, "Boardly", "n:1", "Writer", "Yaslobia"), batch=1)
    then = rows(spark, (201, "Boardly", "n:2", "Editor", "Yaslobia"), (202, None, "n:1", "Editor", "Yaslobia"), batch=2)
    assert pairs(H.find_repeats(rows(spark, *history), first.unionByName(then), ref)) == {(11, 102), (12, 201), (12, 202)}


def test_slips_are_judged_by_all_counts(spark):
    """'content' is frequent in history alone; a batch of one row can't know it. A blank too many costs nothing."""
    ref = spark.createDataFrame(REF, SCHEMA)
    history = [(i, name, f"h:{i}", "Content Planner", "Yaslobia") for i, name in enumerate(NAMES)]
    incoming = rows(spark, (101, "Cobalt", "y:1", "Cotent Planner", "Yaslobia"), (102, "Dune", "y:1", "Con tent Planner", "Yaslobia"))
    assert pairs(H.find_repeats(rows(spark, *history), incoming, ref)) == {(2, 101), (3, 102)}


def test_report(spark):
    """Identities accepted before come out beside the openings, whatever they say now."""
    ref = spark.createDataFrame(REF, SCHEMA)
    incoming = rows(spark, *INCOMING[:3]).withColumn("identity", H.F.expr("CASE row_id WHEN 101 THEN 's:1' WHEN 103 THEN 's:2' END"))
    got = {(r["link"], r["accepted_row_id"], r["incoming_row_id"], r["same_identity"], r["accepted_first_seen"]) for r in H.check_report(rows(spark, *HISTORY), incoming, ref).collect()}
    assert got == {("opening", 1, 101, True, DAY), ("opening", 1, 102, False, DAY), ("identity", 2, 103, True, DAY)}


def test_a_batch_is_few_jobs(spark, monkeypatch):
    """What a batch leaves in the driver's memory goes with its jobs: of all that is written only links, cases and accepted classes are a batch's own."""
    from pyspark.sql.readwriter import DataFrameWriter

    ref, write, done = spark.createDataFrame(REF, SCHEMA), DataFrameWriter.parquet, []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *args, **kwargs: done.append(args) or write(self, *args, **kwargs))
    counted = []
    for size in (5, 2):  # two batches, five batches
        incoming = rows(spark, *INCOMING).withColumn("batch_no", H.F.expr(f"int((row_id - 101) / {size})"))
        done.clear()
        assert pairs(H.find_repeats(rows(spark, *HISTORY), incoming, ref)) == EXPECTED
        counted.append(len(done))
    assert counted[1] - counted[0] == 3 * 3


def test_waiting_batches_equal_one_at_a_time(spark, tmp_path):
    """Counts and employers come from the batches before alone, and what is stored in the end is the same."""
    from feedloom.session import materialize

    ref = spark.createDataFrame(REF, SCHEMA)
    history = [(i, name, f"h:{i}", "Content Planner", "Yaslobia") for i, name in enumerate(NAMES[:4], 1)] + [(11, None, "lever:acme1", "Query Writer", "Yaslobia"), (12, None, "n:1", "Editor", "Yaslobia")]
    batches = [
        [(101, "Cobalt", "y:1", "Cotent Planner", "Yaslobia"), (102, None, "n:1", "Editor", "Yaslobia"), (103, "Boardly", "n:2", "Editor", "Yaslobia")],  # the slip isn't known as one yet
        [(201 + i, name, f"h:{i}", "Content Planner", "Yaslobia") for i, name in enumerate(NAMES[4:])] + [(211, "Boardly", "n:1", "Writer", "Yaslobia")],
        [(301, "Dune", "y:1", "Cotent Planner", "Yaslobia"), (302, "Boardly", "n:2", "Editor", "Yaslobia"), (304, "Fjord", "z:1", "Content Planer", "Yaslobia")],
    ]
    points = [materialize(H.read_rows(rows(spark, *b), ref)) for b in batches]
    old = materialize(H.read_rows(rows(spark, *history), ref))
    one, all_ = (H.History.build(old, str(tmp_path / name), per_bucket=3) for name in ("one", "all"))
    apart = [pairs(one.check(b)) for b in points]
    whole = H.reduce(H.DataFrame.unionByName, [b.withColumn("batch", H.F.lit(n)) for n, b in enumerate(points, 1)])
    together = pairs(all_.check_each(whole, len(points)))
    assert together == {(n, *pair) for n, found in enumerate(apart, 1) for pair in found}
    assert {(1, 12, 102), (3, 4, 301)} <= together and 101 not in {b for _, _, b in together}
    assert one.batch == all_.batch == 3 and one.buckets > 1
    assert pairs(one._read("pivots")) == pairs(all_._read("pivots")) and pairs(one._read("accepted")) == pairs(all_._read("accepted"))
    total = lambda h: pairs(h._read("counts").groupBy("kind", "key", "value").agg(H.F.sum("n")))
    assert total(one) == total(all_)
    assert one.check(points[0].limit(0)).count() == 0 and pairs(one._read("accepted")) == pairs(all_._read("accepted"))


def test_chains_are_settled_as_row_after_row(spark):
    random.seed(5)
    links = {(j, i, False) for j in range(200, 260) for i in random.sample(range(200, j), min(j - 200, random.choice((0, 1, 1, 2))))}
    links |= {(j, j - 1, False) for j in range(301, 312)} | {(j, random.randint(1, 9), True) for j in random.sample(range(200, 260), 6)}
    repeats = set()
    for j in sorted({x[0] for x in links}):
        if any(stored or target not in repeats for item, target, stored in links if item == j):
            repeats.add(j)
    got = dict(pairs(H.settle(spark.createDataFrame(sorted(links), "item long, target long, stored boolean"))))
    assert set(got) == repeats and not repeats & set(got.values()) and all({(j, to, False), (j, to, True)} & links for j, to in got.items())
    assert H.settle(spark.createDataFrame([], "item long, target long, stored boolean")).count() == 0
