"""Schemas that drift between the files of a feed (problem 7).

Method: every file has a schema fingerprint (its paths with their JSON types). Fingerprints of consecutive files are
compared, the differences are explicit migration steps (rename, default, cast), and the steps of all files before it
route each record to one consistent set of paths.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from feedloom.session import materialize

#: Share of the postings with a value on both sides that must keep it for a removed and an added path to be one, renamed.
KEPT = 0.7


def _type(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, list):
        return "array<" + ",".join(sorted({_type(x) for x in value if x is not None})) + ">"
    return {dict: "object", str: "string"}.get(type(value), "number")


def _text(value: object) -> str | None:
    """A value as text that doesn't depend on key order or on being quoted."""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, float) and value.is_integer():
        value = int(value)
    return json.dumps(value, sort_keys=True, ensure_ascii=False)


def paths_of(record: object) -> list[tuple[str, str, str | None]]:
    """(dotted path, type, text) of every member, through objects, not into arrays; the record itself first, under ''."""
    out, stack = [("", "object", None)], [("", record)]
    while stack:
        prefix, value = stack.pop()
        for key, x in value.items() if isinstance(value, dict) else ():
            out.append((prefix + key, _type(x), _text(x)))
            if isinstance(x, dict):
                stack.append((f"{prefix}{key}.", x))
    return out


def fields(records: DataFrame, keys: Sequence[str] = ("guid", "id")) -> DataFrame:
    """(record_id, feed_id, file_no, posting, path, type, value), one row a member of each record's object and one, '', for itself.

    posting is the record's first key that has a value. A payload that is null, no valid JSON or no object has no members.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, postings, repeats = [], [], []
            for payload in batch.column("payload").to_pylist():
                try:
                    record = json.loads(payload)
                except (ValueError, TypeError, RecursionError):
                    record = None
                found = paths_of(record) if isinstance(record, dict) else []
                cells += found
                repeats.append(len(found))
                if found:
                    postings += [next((_text(record[k]) for k in keys if record.get(k) is not None), None)] * len(found)
            if not cells:
                continue
            at = pa.array(np.repeat(np.arange(batch.num_rows), repeats))
            ids = [batch.column(c).take(at) for c in ("record_id", "feed_id", "file_no")]
            columns = [pa.array(c, pa.string()) for c in (postings, *zip(*cells))]
            yield pa.RecordBatch.from_arrays([*ids, *columns], names=["record_id", "feed_id", "file_no", "posting", "path", "type", "value"])

    rows = records.select(F.col("record_id").cast("long"), F.col("feed_id").cast("long"), F.col("file_no").cast("int"), "payload")
    return rows.mapInArrow(run, "record_id long, feed_id long, file_no int, posting string, path string, type string, value string")


def fingerprints(cells: DataFrame) -> DataFrame:
    """(feed_id, file_no, path, types): the set of JSON types among the non-null values; an empty array has none."""
    typed = F.when(~F.col("type").isin("null", "array<>"), F.col("type"))
    return cells.where("path <> ''").groupBy("feed_id", "file_no", "path").agg(F.array_sort(F.collect_set(typed)).alias("types"))


def file_order(records: DataFrame) -> DataFrame:
    """(feed_id, file_no, before): each file of a feed with the number of the one before it; late delivery doesn't matter."""
    files = records.select("feed_id", F.col("file_no").cast("int")).distinct()
    return files.withColumn("before", F.lag("file_no").over(W.partitionBy("feed_id").orderBy("file_no")))


def ancestors(path: Column) -> Column:
    """The paths above a dotted path."""
    parts = F.split(path, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))


def _topmost(steps: DataFrame) -> DataFrame:
    """steps without those below a path that has a step of its own in the same file."""
    inner = steps.where(F.contains("path", F.lit("."))).select("feed_id", "file_no", "path", F.explode(ancestors(F.col("path"))).alias("above")).where("above <> path")
    below = inner.join(steps.select("feed_id", "file_no", F.col("path").alias("above")), ["feed_id", "file_no", "above"], "left_semi").select("feed_id", "file_no", "path").distinct()
    return steps.join(below, ["feed_id", "file_no", "path"], "left_anti")


def differences(cells: DataFrame, prints: DataFrame, order: DataFrame, kept: float = KEPT) -> DataFrame:
    """(feed_id, file_no, path, change, new_path, old_types, new_types): the steps from each file's predecessor to it. prints: fingerprints() of cells."""
    pairs = order.where("before is not null")
    new = prints.join(pairs, ["feed_id", "file_no"]).select("feed_id", "file_no", "path", F.col("types").alias("new_types"))
    old = prints.withColumnRenamed("file_no", "before").join(pairs, ["feed_id", "before"]).select("feed_id", "file_no", "path", F.col("types").alias("old_types"))
    told = new.join(old, ["feed_id", "file_no", "path"], "full")
    change = F.when(F.col("old_types").isNull(), "added").when(F.col("new_types").isNull(), "removed").when(F.col("old_types") != F.col("new_types"), "retyped")
    steps = _topmost(materialize(told.withColumn("change", change).where("change is not null"), "steps"))
    steps = materialize(steps, "steps")

    gone, come = (steps.where(F.col("change") == x).select("feed_id", "file_no", "path") for x in ("removed", "added"))
    moving = gone.select("feed_id", "file_no").intersect(come.select("feed_id", "file_no"))
    pairs = pairs.join(moving, ["feed_id", "file_no"], "left_semi")
    valued = cells.where("value is not null and posting is not null")
    was = valued.withColumnRenamed("file_no", "before").join(pairs, ["feed_id", "before"]).join(gone, ["feed_id", "file_no", "path"], "left_semi").select("feed_id", "file_no", "posting", F.col("path").alias("old_path"), "value").distinct()
    now = valued.join(pairs, ["feed_id", "file_no"]).join(come, ["feed_id", "file_no", "path"], "left_semi").select("feed_id", "file_no", "posting", F.col("path").alias("new_path"), "value").distinct()
    was, now = materialize(was, "was"), materialize(now, "now")
    at = ["feed_id", "file_no"]
    same = was.join(now, [*at, "posting", "value"]).groupBy(*at, "old_path", "new_path").agg(F.count_distinct("posting").alias("same"))
    # postings that could agree: those with a value of the one path, and in the other file at all
    whole = cells.where("path = ''").select(*at, "posting").distinct()
    in_old = whole.withColumnRenamed("file_no", "before").join(pairs, ["feed_id", "before"]).select(*at, "posting")
    in_new = whole.join(pairs, at).select(*at, "posting")
    of_old = was.join(in_new, [*at, "posting"], "left_semi").groupBy(*at, "old_path").agg(F.count_distinct("posting").alias("of_old"))
    of_new = now.join(in_old, [*at, "posting"], "left_semi").groupBy(*at, "new_path").agg(F.count_distinct("posting").alias("of_new"))
    rated = same.join(of_old, [*at, "old_path"]).join(of_new, [*at, "new_path"]).withColumn("share", F.col("same") / F.greatest("of_old", "of_new")).where(F.col("share") >= kept)
    # ties: the same parent, then the more alike name
    parent = lambda c: F.regexp_replace(c, r"\.?[^.]*$", "")
    rated = rated.withColumn("sibling", parent("old_path") == parent("new_path")).withColumn("apart", F.levenshtein(F.lower("old_path"), F.lower("new_path")))
    by = lambda side, other: W.partitionBy(*at, side).orderBy(F.desc("share"), F.desc("same"), F.desc("sibling"), "apart", other)
    mutual = rated.withColumn("r1", F.row_number().over(by("old_path", "new_path"))).withColumn("r2", F.row_number().over(by("new_path", "old_path"))).where("r1 = 1 and r2 = 1")
    renames = mutual.select(*at, F.col("old_path").alias("path"), "new_path")
    taken = renames.select(*at, F.col("new_path").alias("path"), F.lit("added").alias("change"))
    left = steps.join(taken, [*at, "path", "change"], "left_anti").join(renames, [*at, "path"], "left")
    renamed = (F.col("change") == "removed") & F.col("new_path").isNotNull()
    return left.select(*at, "path", F.when(renamed, "renamed").otherwise(F.col("change")).alias("change"), F.when(renamed, F.col("new_path")).alias("new_path"), "old_types", "new_types")


def schema_versions(steps: DataFrame, order: DataFrame) -> DataFrame:
    """(feed_id, file_no, version, renames): the feed's schema version at each file and its chained renames.

    renames maps a path's name in the file to its first name. A version is one more than the number of earlier files
    with a step. Input of a group is one feed's list of steps and files, never its records.
    """

    def chain(files: pd.DataFrame) -> pd.DataFrame:
        rows, names, version = [], {}, 1

        def first(path: str) -> str:
            """path under its longest renamed prefix's first name"""
            ends = [len(path), *(i for i in range(len(path) - 1, 0, -1) if path[i] == ".")]
            end = next((i for i in ends if path[:i] in names), None)
            return path if end is None else names[path[:end]] + path[end:]

        for file in files.sort_values("file_no").itertuples():
            moved, gone = {}, [s["path"] for s in file.steps if s["change"] in ("renamed", "removed")]
            for s in file.steps:
                if s["new_path"] is not None:
                    moved[s["new_path"]] = first(s["path"])
                    # what was renamed below the path goes with it
                    moved.update({s["new_path"] + k[len(s["path"]) :]: v for k, v in names.items() if k.startswith(s["path"] + ".")})
            names = {k: v for k, v in names.items() if not any(k == g or k.startswith(g + ".") for g in gone)}
            for k in sorted(moved):
                names.pop(k, None)
                if first(k) != moved[k]:
                    names[k] = moved[k]
            version += bool(len(file.steps))
            rows.append((file.feed_id, file.file_no, version, dict(names)))
        return pd.DataFrame(rows, columns=["feed_id", "file_no", "version", "renames"])

    listed = steps.groupBy("feed_id", "file_no").agg(F.collect_list(F.struct("path", "change", "new_path")).alias("steps"))
    files = order.select("feed_id", "file_no").join(listed, ["feed_id", "file_no"], "left").withColumn("steps", F.coalesce("steps", F.array().cast("array<struct<path:string,change:string,new_path:string>>")))
    return files.groupBy("feed_id").applyInPandas(chain, "feed_id long, file_no int, version int, renames map<string,string>")


def source_names(versions: DataFrame, prints: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, name, field): names that feeds of one source renamed into each other, and the one they all go under.

    A feed that starts after a rename knows only the new name, so its first names are not another feed's. Names linked by
    a rename in any feed of the source are one field, unless some file of the source holds both; the field has the name
    of the lowest file number, then feed, then the smaller. The groups are lists of names: as large as schemas, not data.
    """
    edges = versions.join(sources, "feed_id").select("source", F.explode("renames").alias("name", "first")).distinct()
    present = prints.join(sources, "feed_id").select("source", "feed_id", "file_no", "path")
    first_at = lambda c: present.groupBy("source", F.col("path").alias(c)).agg(F.min(F.struct("file_no", "feed_id")).alias(f"{c}_at"))
    a, b = (present.withColumnRenamed("path", c) for c in ("name", "first"))
    both = a.join(edges, ["source", "name"]).join(b, ["source", "feed_id", "file_no", "first"]).select("source", "name", "first").distinct()
    dated = edges.join(both, ["source", "name", "first"], "left_anti").join(first_at("name"), ["source", "name"], "left").join(first_at("first"), ["source", "first"], "left")
    flat = [F.coalesce(F.col(f"{c}_at.{k}"), F.lit(2**31 - 1)).cast("long").alias(f"{c}_{k}") for c in ("name", "first") for k in ("file_no", "feed_id")]

    def unite(part: pd.DataFrame) -> pd.DataFrame:
        root: dict[str, str] = {}
        rank = {}

        def top(x: str) -> str:
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for e in part.sort_values(["name", "first"]).itertuples():
            rank[e.name], rank[e.first] = (e.name_file_no, e.name_feed_id, e.name), (e.first_file_no, e.first_feed_id, e.first)
            low, high = sorted((top(e.name), top(e.first)), key=rank.get)
            root[high] = low
        return pd.DataFrame([(part["source"].iloc[0], x, top(x)) for x in rank if top(x) != x], columns=["source", "name", "field"])

    return dated.select("source", "name", "first", *flat).groupBy("source").applyInPandas(unite, "source string, name string, field string")


def _renamed(path: Column, names: str) -> Column:
    """path with its longest prefix that the map names holds replaced."""
    prefix = F.get(F.filter(F.reverse(ancestors(path)), lambda a: F.map_contains_key(names, a)), F.lit(0))
    return F.when(prefix.isNotNull(), F.concat(F.try_element_at(names, prefix), F.substring(path, F.length(prefix) + 1, F.length(path)))).otherwise(path)


def routes(cells: DataFrame, versions: DataFrame) -> DataFrame:
    """(source, feed_id, file_no, path, field, cast, emits, kind): where a path of a file goes, one small row a path.

    field is the path's first name in its feed, put under its source's name. Cast rules: a field that holds objects and
    other values anywhere in the source is one column. If its objects only wrap one member that is no object itself, that
    member's value goes to the field (cast is its name), else the objects are kept as JSON (cast is '') and what is below
    them goes nowhere else. emits: whether the path's cells give values: all but objects whose members stand for them.
    kind: the set of types of the values, whole numbers as 'integer'. versions: schema_versions() with source and aliases.
    """
    is_object = F.col("type") == "object"
    keys = F.json_object_keys("value")
    wraps = F.when((F.size(keys) == 1) & ~F.rlike("value", F.lit(r'^\{"(?:[^"\\]|\\.)*": \{')), F.get(keys, F.lit(0))).otherwise("")
    kind = F.when(is_object | (F.col("type") == "null"), None).when((F.col("type") == "number") & F.rlike("value", F.lit(r"^-?\d{1,18}$")), "integer").otherwise(F.col("type"))
    per = cells.where("path <> ''").groupBy("feed_id", "file_no", "path").agg(
        F.max(is_object).alias("object"), F.max(~is_object).alias("plain"), F.max(~is_object & (F.col("type") != "null")).alias("other"), F.collect_set(kind).alias("kind"),
        F.max(is_object & (F.col("value") == "{}")).alias("empty"), F.collect_set(F.when(is_object & (F.col("value") != "{}"), wraps)).alias("wraps"),
    )
    first = lambda path: _renamed(_renamed(_renamed(path, "renames"), "aliases"), "aliases")  # noqa: E731 the second time for what is below a renamed parent
    above = F.transform(F.filter(ancestors(F.col("path")), lambda a: a != F.col("path")), lambda a: F.struct(a.alias("path"), first(a).alias("field")))
    named = per.join(versions, ["feed_id", "file_no"]).withColumn("field", first(F.col("path"))).withColumn("above", above)
    met = named.groupBy("source", "field").agg(F.max("object").alias("object"), F.max("other").alias("other"), F.array_distinct(F.flatten(F.collect_set("wraps"))).alias("wraps"))
    cast = F.when(F.size("wraps") == 1, F.get("wraps", F.lit(0))).otherwise("")
    casts = met.where("object and other").groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("field", cast.alias("cast")))).alias("casts"))
    told = named.join(casts, "source", "left").withColumn("casts", F.coalesce("casts", F.create_map().cast("map<string,string>")))
    held = F.filter("above", lambda a: F.map_contains_key("casts", a["field"]) & F.startswith("field", F.concat(a["field"], F.lit("."))))
    told = told.withColumn("held", held).withColumn("cast", F.try_element_at("casts", "field"))
    inside = F.exists("held", lambda a: F.try_element_at("casts", a["field"]) == "")
    member = F.get(F.filter("held", lambda a: F.concat(a["path"], F.lit("."), F.try_element_at("casts", a["field"])) == F.col("path")), F.lit(0))
    emits = ~inside & (F.col("plain") | F.col("empty") | F.coalesce(F.col("object") & (F.col("cast") == ""), F.lit(False)))
    return told.select("source", "feed_id", "file_no", "path", F.coalesce(member["field"], "field").alias("field"), "cast", emits.alias("emits"), "kind")


def columns_of(ways: DataFrame) -> DataFrame:
    """(source, field, type, files): the columns of each source's table and the type all their values can be cast to.

    bigint for whole numbers, double for numbers, boolean; string for texts, arrays (as JSON), objects kept as JSON and any
    mixture. A field without any value is a string. files: in how many files the field is.
    """
    per = ways.groupBy("source", "field").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("kind")))).alias("kinds"), F.max(F.coalesce(F.col("cast") == "", F.lit(False))).alias("json"), F.count_distinct("feed_id", "file_no").alias("files"))
    only = lambda *kinds: (F.size("kinds") > 0) & ~F.col("json") & (F.size(F.array_except("kinds", F.array(*[F.lit(k) for k in kinds]))) == 0)
    kind = F.when(only("integer"), "bigint").when(only("integer", "number"), "double").when(only("boolean"), "boolean").otherwise("string")
    return per.select("source", "field", kind.alias("type"), "files")


def compared(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(cells, order of files, fingerprints, steps) of records."""
    cells, order = materialize(fields(records), "cells"), file_order(records)
    prints = materialize(fingerprints(cells), "fingerprints")
    return cells, order, prints, materialize(differences(cells, prints, order), "steps")


class Drift(NamedTuple):
    """table, steps: see drift(). columns: columns_of(). clashes: (record_id, field, n_values) where two paths of a record went to one field and differ; versions: (feed_id, file_no, version, fingerprint)."""

    table: DataFrame
    steps: DataFrame
    columns: DataFrame
    clashes: DataFrame
    versions: DataFrame


def drift(records: DataFrame) -> Drift:
    """The consistent table, the steps, the table's columns, clashes, and the schema version and fingerprint of every file.

    The table: record_id, feed_id, file_no, version, posting, fields (map of first path names to text), of every record.
    Default rule: every field of the source is in the map, null where the record has none. Cast rules: numbers and booleans
    are cast to text, arrays to JSON, and a field that is an object in some records and none in others is unwrapped or
    kept as JSON (see routes()); an empty object is '{}'; typed() gives the columns' own types. Where two paths of a record
    go to one field with different values the greater text is kept and the case is in clashes. Records without a readable
    object have null fields. Steps: see differences(). Repeated records stay rows of their own. records without a source
    column count each feed as a source.
    """
    source = F.col("source") if "source" in records.columns else F.col("feed_id").cast("string")
    sources = records.groupBy(F.col("feed_id").cast("long").alias("feed_id")).agg(F.coalesce(F.max(source), F.lit("")).alias("source"))
    cells, order, prints, steps = compared(records)
    versions = materialize(schema_versions(steps, order), "versions")
    shared = source_names(versions, prints, sources).groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("name", "field"))).alias("aliases"))
    told = versions.join(sources, "feed_id").join(shared, "source", "left").withColumn("aliases", F.coalesce("aliases", F.create_map().cast("map<string,string>")))
    every = materialize(routes(cells, told), "routes")
    ways = every.where("emits")
    defaults = ways.groupBy("source").agg(F.array_sort(F.collect_set("field")).alias("every"))
    stands = (F.col("type") != "object") | (F.col("value") == "{}") | F.coalesce(F.col("cast") == "", F.lit(False))
    routed = cells.join(ways.select("feed_id", "file_no", "path", "field", "cast"), ["feed_id", "file_no", "path"]).where(stands).select("record_id", "field", "path", "value")
    # keys shuffled or not, one field once
    one = routed.groupBy("record_id", "field").agg(F.max("value").alias("value"))
    clashes = routed.groupBy("record_id", "field").agg(F.count_distinct("value").alias("n_values"), F.count_distinct("path").alias("_paths")).where("n_values > 1 and _paths > 1").drop("_paths")
    maps = one.groupBy("record_id").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("held"))
    roots = cells.where("path = ''").join(told.select("feed_id", "file_no", "version", "source"), ["feed_id", "file_no"]).join(defaults, "source", "left").join(maps, "record_id", "left")
    filled = F.map_from_entries(F.transform(F.coalesce("every", F.array().cast("array<string>")), lambda f: F.struct(f.alias("field"), F.try_element_at("held", f).alias("value"))))
    head = records.select("record_id", "feed_id", F.col("file_no").cast("int"))
    table = head.join(roots.select("record_id", "version", "posting", filled.alias("fields")), "record_id", "left")
    digest = prints.groupBy("feed_id", "file_no").agg(F.lower(F.hex(F.xxhash64(F.array_sort(F.collect_list(F.struct("path", "types")))))).alias("fingerprint"))
    return Drift(table, steps, columns_of(ways), clashes, versions.select("feed_id", "file_no", "version").join(digest, ["feed_id", "file_no"], "left"))


def typed(found: Drift, records: DataFrame, source: str) -> DataFrame:
    """record_id and one column a field of the source, of the field's own type; a value that can't be cast is null.

    The list of columns, as long as a schema, is read to the driver.
    """
    wanted = found.columns.where(F.col("source") == source).orderBy("field").collect()
    rows = found.table.join(records.where(F.col("source") == source).select("record_id"), "record_id", "left_semi")
    return rows.select("record_id", *[F.try_element_at("fields", F.lit(r["field"])).try_cast(r["type"]).alias(r["field"]) for r in wanted])


def changes_found(records: DataFrame) -> DataFrame:
    """(feed_id, file_no, field_path, change) of every step."""
    return compared(records)[3].select("feed_id", "file_no", F.col("path").alias("field_path"), "change")
