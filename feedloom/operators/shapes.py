"""The shape of payloads by path, compared over time, with changes that are known and accepted."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _type(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    return {dict: "object", list: "array", str: "string"}.get(type(value), "number")


def types_of(value: object) -> dict[str, str]:
    """The type at every dotted path of a value; a step into an array takes its first item that has the rest of the path."""
    out: dict[str, str] = {}
    if isinstance(value, list):
        for x in value:
            out = types_of(x) | out
    elif isinstance(value, dict):
        for key, x in value.items():
            out.setdefault(key, _type(x))
            for rest, kind in types_of(x).items():
                out.setdefault(f"{key}.{rest}", kind)
    return out


def members(records: DataFrame, *by: str) -> DataFrame:
    """(by.., record_id, path, type) for every path of a record, through objects and arrays, and one row, path '', for itself.

    records: by.., record_id (all bigint), payload. A payload that is null, no valid JSON or no object gives no row.
    """
    ids = [*by, "record_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, paths, kinds = [], [], []
            for i, payload in enumerate(batch.column("payload").to_pylist()):
                try:
                    record = json.loads(payload)
                    found = {"": "object"} | types_of(record) if isinstance(record, dict) else {}
                except (ValueError, TypeError, RecursionError):
                    continue
                at += [i] * len(found)
                paths += found.keys()
                kinds += found.values()
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in ids), pa.array(paths, pa.string()), pa.array(kinds, pa.string())], names=[*ids, "path", "type"])

    schema = ", ".join(f"`{c}` long" for c in ids)
    return records.select(*[F.col(c).cast("long") for c in ids], "payload").mapInArrow(run, f"{schema}, path string, type string")


def shape(cells: DataFrame, records: DataFrame, *by: str) -> DataFrame:
    """(by.., path, present, nulls, types) of members: whether some or all records have the path, whether its values are null never, sometimes or always.

    cells: by.., record_id, path, type, one row a member; records: by.., record_id. Paths no record has give no row. At
    least one column by is needed.
    """
    totals = records.groupBy(*by).agg(F.count_distinct("record_id").alias("_all"))
    per = cells.groupBy(*by, "path").agg(
        F.count_distinct("record_id").alias("_n"), F.count("*").alias("_cells"), F.count_if(F.col("type") == "null").alias("_null"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("type") != "null", F.col("type")))), ",").alias("types"),
    )
    joined = per.join(totals, [*by])
    present = F.when(F.col("_n") == F.col("_all"), "all").otherwise("some")
    nulls = F.when(F.col("_null") == 0, "never").when(F.col("_null") == F.col("_cells"), "always").otherwise("some")
    return joined.select(*by, "path", present.alias("present"), nulls.alias("nulls"), "types")


def compare(old: DataFrame, new: DataFrame, *by: str) -> DataFrame:
    """(by.., path, was, is): paths whose shape differs; 'absent' stands for none."""
    text = F.concat_ws("/", "present", "nulls", "types")
    a, b = (df.select(*by, "path", text.alias(name)) for df, name in ((old, "was_shape"), (new, "is_shape")))
    both = a.join(b, [*by, "path"], "full")
    was, is_ = F.coalesce("was_shape", F.lit("absent")), F.coalesce("is_shape", F.lit("absent"))
    return both.where(was != is_).select(*by, "path", was.alias("was_shape"), is_.alias("is_shape"))


def strict_time(c: Column) -> Column:
    """A UTC time written in twenty characters as 2026-01-31T23:59:59Z; null for any other text or a time that doesn't exist."""
    return F.when(F.rlike(c, F.lit(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$")), F.try_to_timestamp(c))


def accepted_at(c: Column) -> Column:
    """When a stored shape was accepted: a bare day means its last second, so that nothing of that day comes after it."""
    return F.when(F.rlike(c, F.lit(r"^\d{4}-\d{2}-\d{2}$")), F.try_to_timestamp(F.concat(c, F.lit("T23:59:59Z")))).otherwise(F.try_to_timestamp(c))


def statuses(platforms: DataFrame, old: DataFrame, new: DataFrame, failures: DataFrame, accepted: DataFrame) -> DataFrame:
    """(platform, status, changes) of a check, each platform on its own.

    A status of failures (platform, status: unreachable, check failed) stands, and its stored shapes with it; without
    stored shapes it is 'baseline'; without differences 'unchanged'; 're-baselined' where accepted (platform, section,
    path) holds every one of them; else 'changed'. old, new: platform, section, path, shape.
    """
    where = ["platform", "section", "path"]
    both = old.withColumnRenamed("shape", "was").join(new.withColumnRenamed("shape", "now"), where, "full").where(~F.col("was").eqNullSafe(F.col("now")))
    ours = accepted.select(*where).distinct().withColumn("ours", F.lit(True))
    counted = both.join(ours, where, "left").groupBy("platform").agg(F.count("*").alias("n"), F.count("ours").alias("ours"))
    known = old.select("platform").distinct().withColumn("known", F.lit(True))
    told = platforms.join(failures.withColumnRenamed("status", "failed"), "platform", "left").join(known, "platform", "left").join(counted, "platform", "left")
    status = F.when(F.col("failed").isNotNull(), F.col("failed")).when(F.col("known").isNull(), "baseline").when(F.col("n").isNull(), "unchanged").when(F.col("n") == F.col("ours"), "re-baselined").otherwise("changed")
    compared = F.col("failed").isNull() & F.col("known").isNotNull()
    return told.select("platform", status.alias("status"), F.when(compared, F.coalesce("n", F.lit(0))).otherwise(0).alias("changes"))


def kept_sections(old: DataFrame, new: DataFrame, checked: DataFrame) -> DataFrame:
    """The shapes to store: new ones, and for each checked platform the old ones of sections of which the check saw nothing."""
    seen = new.select("platform", "section").distinct()
    return new.unionByName(old.join(checked.select("platform"), "platform", "left_semi").join(seen, ["platform", "section"], "left_anti").select(*new.columns))


def explained(changes: DataFrame, accepted: DataFrame, key: str, at: Column) -> DataFrame:
    """changes with cause: of the first accepted change (by position) of the key and path that was made before at; null for none.

    changes: key, path; accepted: key, paths (array), accepted_at, cause, position.
    """
    listed = accepted.where(F.col("accepted_at") < at).select(key, F.explode("paths").alias("path"), "position", "cause")
    first = listed.groupBy(key, "path").agg(F.min_by("cause", "position").alias("cause"))
    return changes.join(first, [key, "path"], "left")
