"""Layers and stores: what is new, what is appended, how state is merged, what differs from a target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def split_new(batch: DataFrame, known: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key known doesn't hold, the others); a null key is new. Repeats within the batch stay."""
    keys = known.select(key).distinct()
    return batch.join(keys, key, "left_anti"), batch.join(keys, key, "left_semi")


def delta(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The rows to append: those whose key target lacks."""
    return split_new(batch, target, key)[0]


def append_delta(batch: DataFrame, path: str, key: str, partition_by: Sequence[str] = ()) -> int:
    """Append to the Parquet layer at path what it lacks; writes nothing for nothing. Gives the number of rows."""
    spark = batch.sparkSession
    target = read_layer(spark, path, batch)
    new = delta(batch, target, key).persist()
    try:
        if count := new.count():
            new.write.mode("append").partitionBy(*partition_by).parquet(path)
        return count
    finally:
        new.unpersist()


def read_layer(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The layer at path with the columns of like; an absent layer is empty, columns newer than a file are null in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return like.limit(0)
    return spark.read.schema(like.schema).parquet(path)


def refuse_unlisted(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """df, or ValueError if any row's column is null or not allowed: nothing unknown is published."""
    if not df.where(F.col(column).isNull() | ~F.col(column).isin(*allowed)).limit(1).isEmpty():
        raise ValueError(f"{column} holds values that are not allowed here")
    return df


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row a key, the last in order, by one aggregation that is combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.`{c}`").alias(c) for c in rest])


def merge_seen(seen: DataFrame, polled: DataFrame, now: Column) -> DataFrame:
    """The seen store after a poll.

    seen: identity, first_seen, published_at, source, board_id, last_seen; polled: identity, published_at, source,
    board_id (repeats of an identity count once, its greatest row). first_seen never moves; published_at is the first
    known; source is the newest; last_seen becomes now for what was polled.
    """
    one = polled.groupBy("identity").agg(F.max(F.struct("published_at", "source", "board_id")).alias("p"))
    both = seen.alias("s").join(one.alias("n"), "identity", "full")
    here = F.col("n.p").isNotNull()
    return both.select(
        "identity",
        F.coalesce("s.first_seen", now).alias("first_seen"),
        F.coalesce("s.published_at", "n.p.published_at").alias("published_at"),
        F.coalesce("n.p.source", "s.source").alias("source"),
        F.coalesce("s.board_id", "n.p.board_id").alias("board_id"),
        F.when(here, now).otherwise(F.col("s.last_seen")).alias("last_seen"),
    )


def overlay(base: DataFrame, facts: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """base with columns replaced, by null too, wherever facts holds the key; other rows are untouched."""
    matched = facts.select(key, *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_has"))
    joined = base.join(matched, key, "left")
    return joined.select(*[F.when(F.col("_has"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns])


def shown(c: Column) -> Column:
    """The form in which a stored and a displayed value are compared: '' and false are null, line ends are one character."""
    return F.nullif(F.nullif(F.trim(F.replace(c.cast("string"), F.lit("\r\n"), F.lit("\n"))), F.lit("")), F.lit("false"))


def differs(rows: DataFrame, target: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, state) of each row: new, changed, or unchanged against target; a key target holds twice is changed."""
    held = target.groupBy(key).agg(F.count("*").alias("_n"), F.max(F.struct(*[shown(F.col(c)).alias(c) for c in columns])).alias("_t"))
    same = F.lit(True)
    for c in columns:
        same = same & shown(F.col(c)).eqNullSafe(F.col(f"_t.{c}"))
    state = F.when(F.col("_n").isNull(), "new").when((F.col("_n") == 1) & same, "unchanged").otherwise("changed")
    return rows.join(held, key, "left").select(key, state.alias("state"))


def as_written(target: DataFrame, upserts: DataFrame, key: str) -> DataFrame:
    """target after upserts: their rows win, rows on one side only stay. Keys must be unique on each side."""
    columns = [c for c in target.columns if c != key]
    a, b = target.alias("a"), upserts.withColumn("_new", F.lit(True)).alias("b")
    return a.join(b, key, "full").select(key, *[F.when(F.col("b._new"), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in columns])


def without_touched(groups: DataFrame, members: str, group_key: str, stored: DataFrame, key: str) -> DataFrame:
    """Groups none of whose members is stored; null and empty member lists stay."""
    touched = groups.select(group_key, F.explode(members).alias(key)).join(stored.select(key).distinct(), key, "left_semi").select(group_key).distinct()
    return groups.join(touched, group_key, "left_anti")


def in_several(stores: dict[str, DataFrame], key: str) -> DataFrame:
    """(key, stores) of keys that more than one store holds."""
    every = None
    for name, df in sorted(stores.items()):
        part = df.select(key, F.lit(name).alias("store"))
        every = part if every is None else every.unionByName(part)
    return every.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("store")), ",").alias("stores")).where(F.contains("stores", F.lit(",")))


def map_merge(older: Column, newer: Column) -> Column:
    """Both maps as one; newer's value wins where a key is in both."""
    kept = F.map_filter(older, lambda k, v: ~F.map_contains_key(newer, k))
    return F.map_concat(kept, newer)


def outbox(events: DataFrame, sent: DataFrame, key: str, when: str, since: Column) -> DataFrame:
    """Events to send: not sent, from since on or of unreadable time, one a key (the first in time)."""
    fresh = events.where(F.coalesce(F.col(when) >= since, F.lit(True))).join(sent.select(key).distinct(), key, "left_anti")
    rest = [c for c in events.columns if c != key]
    first = fresh.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(when, *[c for c in rest if c != when])).alias("_e"))
    return first.select(key, *[F.col(f"_e.`{c}`").alias(c) for c in rest])


def confirmed(selected_now: DataFrame, listed_then: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows a confirmed dry run may act on, rows selected only since): intersection and rest."""
    return split_new(selected_now, listed_then, key)[::-1]


def first_in_range(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, low: str, days: int, order: Sequence[str], id_col: str) -> DataFrame:
    """left with the columns order of the first right row with equal keys and low < at <= low + days; null for none.

    at is right's time, low is left's. The range is cut into buckets of days, so left meets the two buckets it can reach
    and no key's rows are all compared with each other.
    """
    span = days * 86_400_000_000
    bucket = lambda c: F.floor(F.unix_micros(c) / span)
    a = left.withColumn("_b", F.explode(F.sequence(bucket(F.col(low)), bucket(F.col(low)) + 1)))
    b = right.select(*keys, F.col(at).alias("_at"), F.struct(*order).alias("_o")).withColumn("_b", bucket(F.col("_at")))
    gap = F.unix_micros("_at") - F.unix_micros(low)
    hits = a.join(b, [*keys, "_b"]).where((gap > 0) & (gap <= span)).groupBy(id_col).agg(F.min("_o").alias("_o"))
    return left.join(hits, id_col, "left").select(*left.columns, *[F.col(f"_o.`{c}`").alias(f"first_{c}") for c in order])
