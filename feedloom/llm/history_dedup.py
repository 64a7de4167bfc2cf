"""New batches checked for repeats against all accepted history (problem 1).

An opening is a point (place, title, name): the canonical place, the title's words and the employer's compacted name.

    d(x, y) = BIG * [place(x) <> place(y)] + letters(title(x), title(y)) + levenshtein(name(x), name(y))

letters() is the L1 distance of letter counts: the order of words and a blank too many cost nothing, two swapped letters
nothing, a letter more or less 1, another letter 2. Each part is a (pseudo)metric, so d is one, and the distances of a
point to fixed pivots differ from those of any point within r by at most r.

What is accepted lies in a folder as a pivot-distance table: one row a way of writing an opening, with its pivot
distances, partitioned by a hash of the place and the ranges some distances fall into. A batch reads the partitions its own
ranges lie in, meets only points of the same ranges in one equi-join, is pruned by the triangle inequality on every pivot,
and verified by the true distance and by the words that differ. Accepted rows are appended; nothing stored is worked on again.

Only which openings are accepted depends on the batch before. Counts depend on what came, accepted or not, so what batches
that wait say, their counts and pivots are worked out in one pass; then each is joined, settled and appended in its turn.
"""

from __future__ import annotations

import gc
import itertools
import math
import string
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import text as T
from feedloom.llm.canonical import map_places, segments
from feedloom.session import materialize, scratch_dir, scratch_path

#: Pivots of names: any strings are valid, spread in length and letters so that distances to them differ.
NAME_PIVOTS = ("", "aeiourstln", "systemsnetworksanalytics")
#: Pivots of titles: the long word of no letter, and those of the letters whose number in the alphabet has a given bit.
TITLE_PIVOTS = ("", *("".join(chr(97 + i) for i in range(26) if i >> bit & 1) for bit in range(4)))
#: Greatest distance of titles and of names.
RADIUS = 2
#: Pivots whose ranges are part of the join's key (the others prune what meets).
KEYED = ("t1", "t2", "t3", "n1")
#: Characters of a plan's text that the driver keeps.
PLAN_TEXT = "20000"
#: Stored rows to a partition folder.
PER_BUCKET, MOST_BUCKETS = 200_000, 4096

# Legal forms and articles that don't tell employers apart.
LEGAL = ("the", "ltd", "limited", "inc", "incorporated", "gmbh", "llc", "plc", "corp", "corporation", "co", "sa", "ag", "bv", "srl", "spa", "kg", "se", "oy", "ab")
# Common short forms of title words.
SHORT = {"sr": "senior", "snr": "senior", "jr": "junior", "jnr": "junior", "eng": "engineer", "engr": "engineer", "mgr": "manager", "mngr": "manager", "dev": "developer", "princ": "principal", "prin": "principal", "rep": "representative", "spec": "specialist", "assoc": "associate", "asst": "assistant", "admin": "administrator", "dir": "director", "exec": "executive", "coord": "coordinator", "ops": "operations", "ml": "machine learning", "intl": "international"}
# What advertisements add to a title without naming another opening.
NOISE = ("urgent", "urgently", "new", "hiring", "now", "we", "re", "are", "were", "apply", "remote", "hybrid", "onsite", "full", "part", "time", "fulltime", "in", "at", "the", "a", "an", "and", "of", "for", "m", "f", "d", "x", "w", "h", "mfd", "fmd", "ref", "job", "id", "req", "hot", "immediate", "start", "permanent", "home", "office", "based", "all", "genders")


@dataclass(frozen=True)
class Wording:
    """Which differences in writing don't matter: an argument of every entry point. ratio: how many times as frequent as a slip its right word is."""

    legal: Sequence[str] = LEGAL
    short: dict[str, str] = field(default_factory=lambda: SHORT)
    noise: Sequence[str] = NOISE
    ratio: int = 5


WORDING = Wording()


# ---- points

def employer_name(employer: Column, wording: Wording = WORDING) -> Column:
    """The employer without legal form, case, marks, blanks; '' for none."""
    plain = T.plain(employer)
    dotted = F.when(F.contains(plain, F.lit(".")), F.regexp_replace(plain, r"(?<=\b\p{L})\.(?=\p{L}\b|$|\s)", "")).otherwise(plain)
    joined = F.when(F.contains(dotted, F.lit("s a")), F.regexp_replace(dotted, r"\bs a\b", "sa")).otherwise(dotted)
    kept = F.filter(F.split(joined, r"[^\p{L}\p{N}]+"), lambda w: (w != "") & ~w.isin(*wording.legal))
    return F.coalesce(F.array_join(kept, ""), F.lit(""))


def title_words(title: Column, wording: Wording = WORDING) -> Column:
    """The title's words in order, short forms written out, without numbers, references and what advertisements add."""
    plain = T.plain(title)
    site = F.contains(plain, F.lit("on-site")) | F.contains(plain, F.lit("on site"))
    bare = F.when(site, F.regexp_replace(plain, r"\bon[- ]site\b", " ")).otherwise(plain)
    parts = F.filter(F.split(bare, r"[^\p{L}\p{N}]+"), lambda w: (w != "") & ~w.isin(*wording.noise) & ~F.rlike(w, F.lit(r"\d")))
    table = F.create_map(*[F.lit(x) for kv in wording.short.items() for x in kv])
    return F.split(F.array_join(F.transform(parts, lambda w: F.coalesce(F.try_element_at(table, w), w)), " "), " ")


def _places(located: DataFrame, ref: DataFrame) -> DataFrame:
    """(value, place, own): each distinct location with its place and the words of that place's names."""
    own = F.array(*[F.coalesce(T.plain(F.col(c)), F.lit("")) for c in ("city", "alt_name", "region", "country")])
    ref_words = ref.select("place_id", F.array_distinct(F.flatten(F.transform(own, lambda x: F.split(x, r"[^\p{L}\p{N}]+")))).alias("own"))
    values = located.distinct().join(map_places(located, "value", ref), "value", "left").join(ref_words, "place_id", "left")
    place = F.when(F.coalesce("place_id", F.lit(0)) > 0, F.col("place_id").cast("string")).otherwise(F.concat(F.lit("="), F.array_join(F.array_sort(segments(F.col("value"))), ",")))
    return values.select("value", place.alias("place"), F.coalesce("own", F.array().cast("array<string>")).alias("own"))


def points(rows: DataFrame, ref: DataFrame, wording: Wording = WORDING, keep: Sequence[str] = ()) -> DataFrame:
    """(row_id, identity, external_id, first_seen, keep.., place, title, name, board_id): what each row says, whatever else is known.

    rows: row_id, identity, external_id, first_seen, employer, board_id, title, location; other columns are ignored. A row
    without an employer has name '' and its board_id ('' for none); others have no board_id. A place that is no entry of ref
    counts as it is written, a null place as ''. Null or blank titles have no words; title words that name the row's own
    place are left out. Each distinct place is mapped once.
    """
    name = employer_name(F.col("employer"), wording)
    held = ["row_id", "identity", "external_id", "first_seen", *keep]
    base = rows.select(*held, F.coalesce("location", F.lit("")).alias("value"), F.coalesce(title_words(F.col("title"), wording), F.array().cast("array<string>")).alias("words"), name.alias("name"), F.when(name == "", F.coalesce("board_id", F.lit(""))).alias("board_id"))
    located = rows.select(F.coalesce("location", F.lit("")).alias("value"))  # read anew: a pruned scan costs less than a copy of the rows
    out = base.join(_places(located, ref), "value", "left")
    title = F.array_join(F.filter("words", lambda w: ~F.array_contains("own", w)), " ")
    return out.select(*held, "place", title.alias("title"), "name", "board_id")


def unnamed(board: Column) -> Column:
    """The name of a row whose employer nobody knows: its board. It equals itself and is near to nothing."""
    return F.concat(F.lit("\u0001"), board)


def named(rows: DataFrame, employers: DataFrame, *by: str) -> DataFrame:
    """points() with name filled in: a row without one has its board's employer, else the board stands for it. by: columns of both, such as the batch."""
    told = rows.join(employers.select(*by, "board_id", "board_name"), [*by, "board_id"], "left")
    return told.withColumn("name", F.when(F.col("name") != "", F.col("name")).otherwise(F.coalesce("board_name", unnamed(F.col("board_id"))))).drop("board_name")


def leading_employers(counts: DataFrame, *by: str, share: float = 0.9) -> DataFrame:
    """(by.., board_id, board_name, nameless) of boards on which one employer has at least share of the rows that name one.

    counts: (by.., board_id, name, n), '' counting the board's rows that name none.
    """
    some = F.col("name") != ""
    top = counts.groupBy(*by, "board_id").agg(F.max_by("name", F.when(some, F.struct("n", "name"))).alias("board_name"), F.max(F.when(some, F.col("n"))).alias("most"), F.sum(F.when(some, F.col("n"))).alias("total"), F.sum(F.when(~some, F.col("n")).otherwise(0)).alias("nameless"))
    return top.where(F.col("most") >= share * F.col("total")).select(*by, "board_id", "board_name", "nameless")


def classes(rows: DataFrame, *keep: str) -> DataFrame:
    """One row a way of writing an opening, with its first row. Copies, however many, meet here under partial aggregation, before any join."""
    return rows.groupBy("place", "title", "name", *keep).agg(F.min("row_id").alias("first"))


# ---- the metric

def letters(a: str, b: str) -> Column:
    """The L1 distance of the letter counts of two text columns; blanks don't count, signs other than a to z count as one letter."""
    signs = ", ".join(f"'{chr(97 + i)}'" for i in range(26))
    count = lambda c: f"(length({c}) - length(replace({c}, x, '')))"
    rest = lambda c: f"length(translate({c}, ' {string.ascii_lowercase}', ''))"
    return F.expr(f"aggregate(transform(array({signs}), x -> abs({count(a)} - {count(b)})), 0, (s, n) -> s + n) + abs({rest(a)} - {rest(b)})")


def pivot_distances() -> dict[str, Column]:
    """t0.. of title and n0.. of name.

    The distance of a title to the word that holds each letter of a pivot m times is m * (letters of the pivot) + (signs
    not in the pivot) - (signs in it) for any m that no title reaches; the constant is left out.
    """
    length = "length(replace(title, ' ', ''))"
    titles = {f"t{i}": F.expr(f"2 * length(translate(title, '{p} ', '')) - {length}" if p else length) for i, p in enumerate(TITLE_PIVOTS)}
    return titles | {f"n{i}": F.expr(f"levenshtein(name, '{p}')") for i, p in enumerate(NAME_PIVOTS)}


PIVOTS = (*(f"t{i}" for i in range(len(TITLE_PIVOTS))), *(f"n{i}" for i in range(len(NAME_PIVOTS))))


WIDE = 2 * RADIUS + 1


def own_cell() -> Column:
    """The ranges of the keyed pivots a point lies in, as one number."""
    out = "0L"
    for p in KEYED:
        out = f"({out} * 1024 + pmod(floor({p} / {WIDE}), 1024))"
    return F.expr(out)


def near_cells() -> Column:
    """The cells in which points within RADIUS may lie: every combination of neighbouring ranges."""
    out = "array(0L)"
    for i, p in enumerate(KEYED):
        spans = f"sequence(floor(({p} - {RADIUS}) / {WIDE}), floor(({p} + {RADIUS}) / {WIDE}))"
        out = f"flatten(transform({out}, c{i} -> transform({spans}, x{i} -> c{i} * 1024 + pmod(x{i}, 1024))))"
    return F.explode(F.expr(out))


def pivot_table(found: DataFrame) -> DataFrame:
    """classes() with their pivot distances and the cell they lie in."""
    return found.withColumns(pivot_distances()).withColumn("cell", own_cell())


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("place", "cell"), F.lit(buckets)).cast("int")


def probes(new: DataFrame, employers: DataFrame, *by: str) -> DataFrame:
    """pivot_table() rows to ask for: new ones themselves (own), and further names of theirs.

    An employer that leads boards with nameless rows (employers: leading_employers()) is also asked for under these boards'
    own names, since it may have become known after such a row was stored.
    """
    boards = employers.where("nameless > 0").select(*by, F.col("board_name").alias("name"), unnamed(F.col("board_id")).alias("other"))
    others = pivot_table(new.join(boards, [*by, "name"]).select(*by, "place", "title", F.col("other").alias("name"), "first"))
    return new.withColumn("own", F.lit(True)).unionByName(others.withColumn("own", F.lit(False)))


def asked(new: DataFrame, buckets: int) -> DataFrame:
    """pivot_table() rows, one for each cell in which something within RADIUS may lie, with the partition of that cell."""
    return new.drop("cell").withColumn("cell", near_cells()).withColumn("bucket", _bucket(buckets))


def links(new: DataFrame, stored: DataFrame, wording: Wording = WORDING, counts: DataFrame | None = None) -> DataFrame:
    """(item, target, stored): for new classes, the stored or earlier new ones that write the same opening.

    new: asked(); stored: pivot_table() rows with stored (true: accepted before; false: new ones themselves). Place and
    cell are the join's keys; the triangle inequality on every pivot prunes; the true distance decides; then the words that
    differ, taken together, must be one edit apart, and with counts (word, n) one side must be rare beside the other, as a
    slip is, so that two common words one letter apart stay two. Words under four letters are no slips of each other.
    """
    a, b = new.alias("a"), stored.alias("b")
    pruned = [F.col("b.stored") | (F.col("b.first") < F.col("a.first")), *[F.abs(F.col(f"a.{p}") - F.col(f"b.{p}")) <= RADIUS for p in PIVOTS]]
    x, y = F.col("a.name"), F.col("b.name")
    both = ~F.startswith(x, F.lit("\u0001")) & ~F.startswith(y, F.lit("\u0001"))
    names = (x == y) | (both & (F.levenshtein(x, y, RADIUS) >= 0) & T.near(x, y))
    titles = (F.col("a.title") == F.col("b.title")) | (letters("a.title", "b.title") <= RADIUS)
    words = [F.split(F.col(f"{s}.title"), " ") for s in "ab"]
    ours, theirs = F.array_except(*words), F.array_except(*reversed(words))

    def slip(p: Column) -> Column:
        u, v = p["u"], p["v"]
        short, long = F.least(F.length(u), F.length(v)), F.greatest(F.length(u), F.length(v))
        return ((u == "") & (v == "")) | ((short >= 3) & (long > 3) & T.near(u, v))

    texts = F.array(F.struct(F.array_join(ours, "").alias("u"), F.array_join(theirs, "").alias("v")))  # a lambda's argument is worked out once
    # one CASE, not several conjuncts: the cheap comparison of pivots stays the first, whatever the optimizer moves into the join
    true = F.when(reduce(Column.__and__, pruned), F.when(names, F.when(titles, F.exists(texts, slip))))
    met = a.join(b, (F.col("a.place") == F.col("b.place")) & (F.col("a.cell") == F.col("b.cell")) & true)
    met = met.select(F.col("a.first").alias("item"), F.col("b.first").alias("target"), "b.stored", ours.alias("ours"), theirs.alias("theirs"))
    if counts is None:
        return met.select("item", "target", "stored")
    each = met.select("item", "target", "stored", F.explode_outer(F.concat(*[F.transform(side, lambda w: F.struct(F.lit(i).alias("side"), w.alias("word"))) for i, side in enumerate(("ours", "theirs"))])).alias("w"))
    each = each.select("item", "target", "stored", "w.side", "w.word").join(counts, "word", "left")
    rare = each.groupBy("item", "target", "stored").agg(*[F.min(F.when(F.col("side") == i, F.coalesce("n", F.lit(0)))).alias(f"n{i}") for i in (0, 1)])
    told_apart = (F.col("n0") < wording.ratio * F.col("n1")) & (F.col("n1") < wording.ratio * F.col("n0"))
    return rare.where(~F.coalesce(told_apart, F.lit(False))).select("item", "target", "stored")


def settle(pairs: DataFrame, folder: str | None = None) -> DataFrame:
    """(item, accepted): the items of links() that repeat an accepted one, with the first of those. pairs: written already.

    What lies near a stored class is a case; what lies near an earlier new one is a case unless that one is a case itself.
    Links among new classes are settled in rounds, each deciding all items that have an accepted neighbour or whose earlier
    neighbours are decided: as many as the longest chain of near spellings within one batch, of which almost all batches
    have none or one. A round is written to folder as it is decided.
    """
    spark, folder = pairs.sparkSession, folder or scratch_path(pairs.sparkSession, "cases")

    def written(step: DataFrame, number: int) -> DataFrame:
        return materialize(step.select("item", "accepted", F.coalesce(F.col("accepted").isNull() & F.col("waits"), F.lit(False)).alias("waits")), path=f"{folder}/round={number}")

    def decided(open_: DataFrame, known: DataFrame) -> DataFrame:
        """known: (target, repeats), false for those that wait themselves; others are accepted."""
        near = open_.join(known, "target", "left").groupBy("item")
        return near.agg(F.min(F.when(F.col("repeats").isNull(), F.col("target"))).alias("accepted"), F.max(~F.col("repeats")).alias("waits"))

    each = pairs.groupBy("item").agg(F.min(F.when(F.col("stored"), F.col("target"))).alias("accepted"), F.collect_list(F.when(~F.col("stored"), F.col("target"))).alias("near"))
    known = each.select(F.col("item").alias("target"), F.col("accepted").isNotNull().alias("repeats"))
    open_ = decided(each.where("accepted IS NULL").select("item", F.explode("near").alias("target")), known)
    last = written(each.where("accepted IS NOT NULL").select("item", "accepted", F.lit(False).alias("waits")).unionByName(open_), 1)
    for number in itertools.count(2):
        every = spark.read.schema("item long, accepted long, waits boolean, round int").parquet(folder)
        cases, waiting = every.where("accepted IS NOT NULL"), last.where("waits")
        if waiting.isEmpty():
            return cases.select("item", "accepted")
        known = cases.select(F.col("item").alias("target"), F.lit(True).alias("repeats")).unionByName(waiting.select(F.col("item").alias("target"), F.lit(False).alias("repeats")))
        open_ = pairs.where("NOT stored").select("item", "target").join(waiting.select("item"), "item", "left_semi")
        last = written(decided(open_, known), number)
    raise AssertionError


def answered(rows: DataFrame, new: DataFrame, cases: DataFrame, *by: str) -> DataFrame:
    """(by.., accepted_row_id, incoming_row_id) of each row that repeats a stored opening or an earlier row. rows: named points; new: their classes."""
    target = new.join(cases.withColumnRenamed("item", "first"), [*by, "first"], "left").select(*by, "place", "title", "name", F.coalesce("accepted", "first").alias("to"))
    out = rows.select(*by, "row_id", "place", "title", "name").join(target, [*by, "place", "title", "name"]).where(F.col("to") != F.col("row_id"))
    return out.select(*by, F.col("to").alias("accepted_row_id"), F.col("row_id").alias("incoming_row_id")).distinct()


# ---- stored history

def word_counts(found: DataFrame, *by: str) -> DataFrame:
    """(by.., word, n): in how many classes() each title word stands; copies count once."""
    return found.select(*by, F.explode(F.array_distinct(F.split("title", " "))).alias("word")).where("word <> ''").groupBy(*by, "word").agg(F.count("*").alias("n"))


def employer_counts(rows: DataFrame, *by: str) -> DataFrame:
    """(by.., board_id, name, n): the rows of each board by employer, '' counting those that name none. rows: by.., board_of, name."""
    return rows.where("board_of is not null").groupBy(*by, F.col("board_of").alias("board_id"), "name").agg(F.count("*").alias("n"))


_SCHEMAS = {
    "pivots": "place string, title string, name string, first long, " + ", ".join(f"{p} int" for p in PIVOTS) + ", cell long, bucket int",
    "counts": "kind string, key string, value string, n long",
    "accepted": "row_id long, identity string, external_id string, first_seen timestamp, batch int",
}


def _release(spark: SparkSession) -> None:
    """Let the driver free what finished batches held: plans, broadcast blocks and shuffle files go when their handles are collected, which small jobs alone don't bring about."""
    gc.collect()
    try:
        spark._jvm.System.gc()
    except (AttributeError, TypeError):  # no JVM on this side
        pass


class History:
    """All that is accepted, in a folder the executors share; batch after batch is checked against it and appended.

    pivots: pivot_table() rows by bucket. counts: title words in classes, and boards' rows by employer, a part a batch.
    accepted: identity, external_id and first_seen of accepted rows.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int, batch: int = 0, wording: Wording = WORDING) -> None:
        self.spark, self.path, self.buckets, self.batch, self.wording = spark, path, buckets, batch, wording

    @classmethod
    def open(cls, spark: SparkSession, path: str, wording: Wording = WORDING) -> History:
        """A stored history as the last batch left it."""
        about = spark.read.parquet(f"{path}/about").first()
        last = spark.read.schema(_SCHEMAS["accepted"]).parquet(f"{path}/accepted").agg(F.max("batch")).first()[0]
        return cls(spark, path, about["buckets"], last or 0, wording)

    @classmethod
    def build(cls, history: DataFrame, path: str, wording: Wording = WORDING, per_bucket: int = PER_BUCKET) -> History:
        """Store history, written points() with board_of, as accepted. Copies within it are one opening, with the least row_id."""
        spark = history.sparkSession
        employers = employer_counts(history)
        new = materialize(pivot_table(classes(named(history, leading_employers(employers)))), "classes")
        buckets = min(MOST_BUCKETS, max(1, math.ceil(new.count() / per_bucket)))
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{path}/about")
        self = cls(spark, path, buckets, 0, wording)
        self._store(new)
        self._tell(history.withColumn("batch", F.lit(0)), employers, word_counts(new))
        return self

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(_SCHEMAS[name]).parquet(f"{self.path}/{name}")

    def _store(self, new: DataFrame) -> None:
        """Append accepted classes."""
        held = new.withColumn("bucket", _bucket(self.buckets)).repartition("bucket").sortWithinPartitions("place", "cell")
        held.write.mode("append").partitionBy("bucket").parquet(f"{self.path}/pivots")

    def _tell(self, accepted: DataFrame, employers: DataFrame, words: DataFrame) -> None:
        """Append accepted rows (with batch), and the counts of all that came."""
        told = words.select(F.lit("word").alias("kind"), F.col("word").alias("key"), F.lit("").alias("value"), "n")
        told = told.unionByName(employers.select(F.lit("employer").alias("kind"), F.col("board_id").alias("key"), F.col("name").alias("value"), "n"))
        told.write.mode("append").parquet(f"{self.path}/counts")
        accepted.select("row_id", "identity", "external_id", "first_seen", "batch").write.mode("append").parquet(f"{self.path}/accepted")

    def check(self, batch: DataFrame) -> DataFrame:
        """check_each() of a single batch, written points() with board_of: (accepted_row_id, incoming_row_id)."""
        return self.check_each(batch.withColumn("batch", F.lit(self.batch + 1)), 1).drop("batch")

    def check_each(self, rows: DataFrame, waiting: int) -> DataFrame:
        """(batch, accepted_row_id, incoming_row_id): each batch's repeats of what is accepted or of its own earlier rows; the rest is appended before the next.

        rows: written points() with board_of, and the number of their batch, from self.batch + 1 on, of which there are
        waiting. Slips and boards' employers are judged by the counts up to each batch; what was accepted before stays
        accepted. Of the stored table a batch reads only partitions in which its own ranges lie. A batch without rows
        changes nothing.
        """
        first, last = self.batch + 1, self.batch + waiting
        employers, held = employer_counts(rows, "batch"), self._read("counts")
        known = held.where("kind = 'employer'").select(F.lit(first).alias("batch"), F.col("key").alias("board_id"), F.col("value").alias("name"), "n").unionByName(employers)
        known = known.withColumn("batch", F.explode(F.sequence("batch", F.lit(last)))).groupBy("batch", "board_id", "name").agg(F.sum("n").alias("n"))
        leading = materialize(leading_employers(known, "batch"), "leading")
        told = named(rows, leading, "batch")
        looked = materialize(probes(pivot_table(classes(told, "batch")), leading, "batch"), "probes", by=("batch",))
        new = looked.where("own").drop("own")
        words = word_counts(new, "batch")
        parts = held.where("kind = 'word'").select(F.lit(self.batch).alias("batch"), F.col("key").alias("word"), "n").unionByName(words)
        parts = materialize(parts.groupBy("word").agg(F.collect_list(F.struct("batch", "n")).alias("parts")), "words")
        buckets = {}
        if self.buckets > 1:  # at most MOST_BUCKETS numbers a batch
            buckets = dict(asked(looked, self.buckets).groupBy("batch").agg(F.collect_set("bucket")).collect())
        folder = scratch_path(self.spark, "cases")
        for number in range(first, last + 1):
            own, stored = new.where(F.col("batch") == number).drop("batch"), self._read("pivots")
            if self.buckets > 1:
                stored = stored.where(F.col("bucket").isin(buckets.get(number, [])))
            kept = stored.drop("bucket").withColumn("stored", F.lit(True)).unionByName(own.withColumn("stored", F.lit(False)))
            counts = parts.select("word", F.expr(f"aggregate(filter(parts, p -> p.batch <= {number}), 0L, (n, p) -> n + p.n)").alias("n"))
            pairs = links(asked(looked.where(F.col("batch") == number), self.buckets), kept, self.wording, counts)
            cases = settle(materialize(pairs, "pairs"), f"{folder}/batch={number}")
            self._store(own.join(cases, F.col("first") == F.col("item"), "left_anti"))
            _release(self.spark)
        cases = self.spark.read.schema("item long, accepted long, batch int").parquet(folder).where("accepted IS NOT NULL")
        out = materialize(answered(told, new, cases, "batch"), "repeats")
        took = rows.join(out.select("batch", F.col("incoming_row_id").alias("row_id")), ["batch", "row_id"], "left_anti")
        self._tell(took, employers, words)
        self.batch = last
        return out

    def identified(self, batch: DataFrame) -> DataFrame:
        """(accepted_row_id, incoming_row_id, accepted_first_seen): rows of a checked batch under an identity accepted before, whatever they say now.

        Of several accepted rows of one identity the first counts. Null identities are no identity.
        """
        held = self._read("accepted").where((F.col("batch") < self.batch) & F.col("identity").isNotNull())
        first = held.groupBy("identity").agg(F.min(F.struct("batch", "row_id", "first_seen")).alias("a"))
        return batch.join(first, "identity").select(F.col("a.row_id").alias("accepted_row_id"), F.col("row_id").alias("incoming_row_id"), F.col("a.first_seen").alias("accepted_first_seen"))

    def described(self, pairs: DataFrame, batch: DataFrame) -> DataFrame:
        """pairs with accepted_first_seen, and whether identity and external_id are the accepted row's."""
        a = self._read("accepted").select(F.col("row_id").alias("accepted_row_id"), F.col("identity").alias("_i"), F.col("external_id").alias("_x"), F.col("first_seen").alias("accepted_first_seen"))
        b = batch.select(F.col("row_id").alias("incoming_row_id"), "identity", "external_id")
        same = lambda x, y: F.coalesce(F.col(x) == F.col(y), F.lit(False))
        return pairs.join(a, "accepted_row_id").join(b, "incoming_row_id").select("accepted_row_id", "incoming_row_id", "accepted_first_seen", same("identity", "_i").alias("same_identity"), same("external_id", "_x").alias("same_external_id"))


def read_rows(rows: DataFrame, ref: DataFrame, wording: Wording = WORDING, keep: Sequence[str] = ()) -> DataFrame:
    """points() with board_of, the row's board whether it names an employer or not."""
    return points(rows.withColumn("board_of", F.col("board_id")), ref, wording, (*keep, "board_of"))


def _in_turn(history: DataFrame, incoming: DataFrame, ref: DataFrame, wording: Wording, path: str | None = None, per_bucket: int = PER_BUCKET) -> tuple[History, DataFrame, DataFrame, int]:
    """by_batch() in whole tables: (the history, points of incoming with batch, check_each() of them, the number of batches)."""
    spark = history.sparkSession
    spark.conf.set("spark.sql.maxPlanStringLength", PLAN_TEXT)  # the driver keeps the plan's text of each of its many small jobs
    path = path or f"{scratch_dir(spark)}/history-{uuid.uuid4().hex}"
    kept = History.build(materialize(read_rows(history, ref, wording), "points"), path, wording, per_bucket)
    rows = materialize(read_rows(incoming, ref, wording, ("batch_no",)), "points")
    numbers = sorted((r[0] for r in rows.select("batch_no").distinct().collect()), key=lambda n: (n is None, n))  # one a batch
    given = [F.lit(n) for n in numbers if n is not None]
    place = F.array_position(F.array(*given), F.col("batch_no")) if given else F.lit(None)
    rows = rows.withColumn("batch", F.coalesce(place, F.lit(len(numbers))).cast("int"))
    found = kept.check_each(rows, len(numbers)) if numbers else spark.createDataFrame([], "batch int, accepted_row_id long, incoming_row_id long")
    return kept, rows, found, len(numbers)


def by_batch(history: DataFrame, incoming: DataFrame, ref: DataFrame, wording: Wording = WORDING, path: str | None = None, per_bucket: int = PER_BUCKET) -> tuple[History, list[tuple[DataFrame, DataFrame]]]:
    """history stored once, then batch after batch (batch_no, null last) checked and appended: (the history, [(batch, repeats)]).

    What a row says does not depend on what is accepted, so the rows of all batches are read in one pass beforehand.
    """
    kept, rows, found, last = _in_turn(history, incoming, ref, wording, path, per_bucket)
    return kept, [(rows.where(F.col("batch") == n).drop("batch"), found.where(F.col("batch") == n).drop("batch")) for n in range(1, last + 1)]


def find_repeats(history: DataFrame, incoming: DataFrame, ref: DataFrame, wording: Wording = WORDING) -> DataFrame:
    """(accepted_row_id, incoming_row_id) of every incoming row that repeats an accepted opening, batch after batch.

    Rows with null in any column take part (see points()); repeated row_ids count once; an empty side gives no rows.
    """
    return _in_turn(history, incoming, ref, wording)[2].drop("batch")


def check_report(history: DataFrame, incoming: DataFrame, ref: DataFrame, wording: Wording = WORDING) -> DataFrame:
    """(batch_no, link, accepted_row_id, incoming_row_id, accepted_first_seen, same_identity, same_external_id).

    link: 'opening' for find_repeats(); 'identity' for rows under an accepted identity that say another opening.
    """
    spark = history.sparkSession
    path = f"{scratch_dir(spark)}/history-{uuid.uuid4().hex}"
    kept, found = by_batch(history, incoming, ref, wording, path)
    out = []
    for n, (batch, pairs) in enumerate(found, 1):
        told = kept.described(pairs, batch).select(F.lit("opening").alias("link"), "*")
        other = History(spark, path, kept.buckets, n, wording).identified(batch).join(pairs.select("incoming_row_id"), "incoming_row_id", "left_anti")
        told = told.unionByName(other.select(F.lit("identity").alias("link"), "accepted_row_id", "incoming_row_id", "accepted_first_seen", F.lit(True).alias("same_identity"), F.lit(True).alias("same_external_id")))
        out.append(told.join(batch.select(F.col("row_id").alias("incoming_row_id"), "batch_no"), "incoming_row_id"))
    return reduce(DataFrame.unionByName, out).select("batch_no", "link", "accepted_row_id", "incoming_row_id", "accepted_first_seen", "same_identity", "same_external_id")


def in_one_pass(history: DataFrame, incoming: DataFrame, ref: DataFrame, wording: Wording = WORDING) -> DataFrame:
    """find_repeats() with all incoming rows as one batch and nothing stored: every slip and board is judged by the counts of all rows."""
    sides = [read_rows(side, ref, wording) for side in (history, incoming)]
    employers = leading_employers(employer_counts(sides[0].unionByName(sides[1])))
    old, rows = (named(side, employers) for side in sides)
    rows = materialize(rows, "rows")
    stored, new = materialize(pivot_table(classes(old)), "stored"), materialize(pivot_table(classes(rows)), "classes")
    counts = word_counts(stored.select("title").unionByName(new.select("title")))
    kept = stored.withColumn("stored", F.lit(True)).unionByName(new.withColumn("stored", F.lit(False)))
    return answered(rows, new, settle(materialize(links(asked(probes(new, employers), 1), kept, wording, counts), "pairs")))
