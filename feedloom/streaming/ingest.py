"""Feeds as streams: files land, each micro-batch is delta-appended, and a keyed state keeps when each row was first and last seen."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, types
from pyspark.sql import functions as F

from feedloom.operators.stores import append_delta
from feedloom.session import scratch_dir


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """The Parquet files that arrive under path; offsets live in the query's checkpoint."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def start_delta_append(stream: DataFrame, target: str, key: str, checkpoint: str):
    """Append what target lacks, micro-batch by micro-batch, until the input is used up. Repeating a batch adds nothing, so a restart is safe."""

    def write(batch: DataFrame, _: int) -> None:
        append_delta(batch.dropDuplicates([key]), target, key)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_and_last_seen(stream: DataFrame, key: str, at: str) -> DataFrame:
    """(key, first_seen, last_seen, times) after each micro-batch that holds the key: keyed state, first_seen never moves. All of it stays in the JVM."""
    return stream.groupBy(key).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.count("*").alias("times"))


def absence_state(stream: DataFrame, key: str, run: str) -> DataFrame:
    """(key, last_seen_run) after each micro-batch that holds the key; with the newest run of all, its absences."""
    return stream.groupBy(key).agg(F.max(run).alias("last_seen_run"))


def late_split(stream: DataFrame, first: str, dated: str, days: int) -> DataFrame:
    """The stream with late: rows first seen more than days after their date are marked, never silently discarded by a watermark."""
    return stream.withColumn("late", F.coalesce(F.unix_micros(first) - F.unix_micros(dated) > days * 86_400_000_000, F.lit(False)))


def as_stream(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read as a stream of its files."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 100).parquet(path)


def _folder(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def delta_layer(df: DataFrame, key: str) -> DataFrame:
    """A layer made from df as a stream by delta appends."""
    spark = df.sparkSession
    target = _folder(spark, "layer")
    start_delta_append(as_stream(df, "stream"), target, key, _folder(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(df.schema).parquet(target) if not df.isEmpty() else df


def _collected(stream: DataFrame, mode: str) -> DataFrame:
    """All updates of a stream, written batch by batch, with their batch number."""
    spark = stream.sparkSession
    target = _folder(spark, "updates")

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{target}/{number}")

    schema = stream.schema
    query = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", _folder(spark, "checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(schema.add("batch", types.IntegerType())).option("recursiveFileLookup", "true").parquet(f"{target}/*")


def seen_states(df: DataFrame, key: str, at: str) -> DataFrame:
    """The last state of each key after df has run as a stream through first_and_last_seen()."""
    updates = _collected(first_and_last_seen(as_stream(df, "stream"), key, at), "update")
    last = updates.groupBy(key).agg(F.max_by(F.struct("first_seen", "last_seen", "times"), "batch").alias("s"))
    return last.select(key, "s.*")


def distinct_counts(df: DataFrame, key: str, by: str) -> DataFrame:
    """(by, n) of df as a stream, each key counted once however often it is delivered."""
    updates = _collected(as_stream(df, "stream").dropDuplicates([key, by]).groupBy(by).agg(F.count("*").alias("n")), "update")
    return updates.groupBy(by).agg(F.max_by("n", "batch").alias("n"))


def absences(df: DataFrame, key: str, run: str) -> DataFrame:
    """(key, last_seen_run, absences) after df has run as a stream: the runs since the key was last delivered. Runs are numbered without gaps."""
    updates = _collected(absence_state(as_stream(df, "stream"), key, run), "update")
    last = updates.groupBy(key).agg(F.max("last_seen_run").alias("last_seen_run"))
    newest = df.agg(F.max(run)).first()[0]  # one number
    return last.select(key, "last_seen_run", (F.lit(newest) - F.col("last_seen_run")).alias("absences"))


def sent_once(df: DataFrame, key: str) -> DataFrame:
    """What a sink holds after df has come as a stream of events, each batch delivered twice: every key once.

    A batch is checked against the sink before it is appended, and what it appends is its own: a batch that is delivered
    again, after a failure between write and commit, finds its keys there and adds nothing.
    """
    spark = df.sparkSession
    target = _folder(spark, "outbox")

    def send(batch: DataFrame, _: int) -> None:
        for _ in range(2):
            append_delta(batch.dropDuplicates([key]), target, key)

    stream = as_stream(df, "stream")
    stream.writeStream.foreachBatch(send).option("checkpointLocation", _folder(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(target) if not df.isEmpty() else df


def through(stream: DataFrame) -> DataFrame:
    """All rows of a stream, as its batches wrote them."""
    return _collected(stream, "append").drop("batch")
