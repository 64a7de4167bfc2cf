"""What changed between consecutive full snapshots (problem 3).

Method: content-defined chunks of key-sorted snapshots. Keys are spread over buckets and sorted in each; a chunk starts
at every key whose hash is a multiple of the mean chunk length, so an inserted row moves no other boundary. Chunks whose
digests agree with the snapshot before are discarded; only the rows of the others are joined and classified.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from feedloom.functions import text as T
from feedloom.session import materialize

#: Mean rows of a chunk; least buckets of keys for each shuffle partition of the session; rows of a bucket, which is what one window sorts.
CHUNK, SPREAD, BUCKET = 64, 4, 50_000


def canonical(df: DataFrame, column: str) -> Column:
    """The column as text in which equal values are equal: blanks squeezed, null as '', arrays as sets. """
    kind = dict(df.dtypes)[column]
    c = F.col(f"`{column}`")
    if kind.startswith("array<"):
        items = F.array_sort(F.array_distinct(F.filter(F.transform(c, lambda x: T.squeeze(x.cast("string"))), lambda x: x != "")))
        return F.coalesce(F.array_join(items, "\u001f"), F.lit(""))
    if kind.startswith(("struct", "map")):
        return F.coalesce(F.to_json(c), F.lit(""))
    return F.coalesce(T.squeeze(c.cast("string")), F.lit(""))


def digests(df: DataFrame, key: str, snapshot: str, ignore: Sequence[str]) -> DataFrame:
    """(snapshot_no, record_key, digest), one row a record and snapshot. Rows delivered twice are one; rows without key are left out.

    Where rows of one key differ within a snapshot, the digest is of the set of them, so their order doesn't matter.
    """
    compared = sorted(c for c in df.columns if c not in (key, snapshot, *ignore))
    text = F.concat_ws("\u001e", *[canonical(df, c) for c in compared]) if compared else F.lit("")
    rows = df.where(F.col(key).isNotNull() & F.col(snapshot).isNotNull()).select(F.col(snapshot).cast("int").alias("snapshot_no"), F.col(key).cast("string").alias("record_key"), F.xxhash64(text).alias("a"), F.hash(text).alias("b"))
    rows = rows.distinct()
    one = rows.groupBy("snapshot_no", "record_key").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("d"))
    return one.select("snapshot_no", "record_key", F.xxhash64("d").alias("digest"))


def chunked(rows: DataFrame, chunk: int = CHUNK, buckets: int | None = None) -> DataFrame:
    """rows with bucket and chunk: the first key of the row's chunk ('' before a bucket's first boundary).

    Whatever the number of buckets, equal snapshots have equal chunks; it only bounds what one task sorts.
    """
    buckets = buckets or SPREAD * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mark = F.xxhash64(F.lit("chunk"), "record_key")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("record_key"), F.lit(buckets)))
    order = W.partitionBy("snapshot_no", "bucket").orderBy("record_key").rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn("chunk", F.coalesce(F.last(F.when(F.pmod(mark, F.lit(chunk)) == 0, F.col("record_key")), True).over(order), F.lit("")))


def changes(df: DataFrame, key: str, snapshot: str = "snapshot_no", ignore: Sequence[str] = (), chunk: int = CHUNK) -> DataFrame:
    """(snapshot_no, record_key, change): added, removed or changed against the snapshot before.

    Snapshots are consecutive among those delivered, whatever their numbers; the first has no changes. Blanks at the ends
    or repeated and null against '' are no change, arrays are sets. Empty input, or one snapshot, gives no rows.
    """
    least = SPREAD * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, math.ceil(df.count() / BUCKET))  # of a Parquet table the footers tell it
    rows = materialize(chunked(digests(df, key, snapshot, ignore), chunk, buckets), "snapshots")
    order = W.orderBy("snapshot_no")  # one row a snapshot: a handful
    numbers = rows.select("snapshot_no").distinct().withColumn("before", F.lag("snapshot_no").over(order)).where("before is not null")
    both = F.struct(F.count("*").alias("n"), F.bit_xor("digest").alias("x"), F.sum(F.xxhash64("record_key", "digest").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64("digest", "record_key")).alias("k"))
    chunks = rows.groupBy("snapshot_no", "bucket", "chunk").agg(both.alias("sum"))
    new = chunks.join(numbers, "snapshot_no").select("snapshot_no", "bucket", "chunk", "sum")
    old = chunks.withColumnRenamed("snapshot_no", "before").join(numbers, "before").select("snapshot_no", "bucket", "chunk", "sum")
    # a chunk on both sides with one digest is left out; what is on one side only, or differs, stays
    differing = new.withColumn("side", F.lit(1)).unionByName(old.withColumn("side", F.lit(0))).groupBy("snapshot_no", "bucket", "chunk").agg(F.count("*").alias("sides"), F.count_distinct("sum").alias("sums"))
    differing = differing.where("sides = 1 or sums > 1").select("snapshot_no", "bucket", "chunk")
    after = rows.join(differing, ["snapshot_no", "bucket", "chunk"], "left_semi").select("snapshot_no", "record_key", "digest")
    earlier = rows.withColumnRenamed("snapshot_no", "before").join(numbers, "before").join(differing, ["snapshot_no", "bucket", "chunk"], "left_semi").select("snapshot_no", "record_key", "digest")
    a, b = after.withColumnRenamed("digest", "now"), earlier.withColumnRenamed("digest", "was")
    told = a.join(b, ["snapshot_no", "record_key"], "full")
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "changed")
    return told.select("snapshot_no", "record_key", change.alias("change")).where("change is not null")


def changes_found(seen: DataFrame, boards: DataFrame) -> DataFrame:
    """(entity, snapshot_no, record_key, change) of both snapshot tables."""
    ignored = ("taken_at", "snapshot_day", "last_seen")
    parts = [changes(df, key, "snapshot_no", ignored).select(F.lit(name).alias("entity"), "snapshot_no", "record_key", "change") for name, df, key in (("seen_snapshots", seen, "identity"), ("boards", boards, "board_id"))]
    return parts[0].unionByName(parts[1])
