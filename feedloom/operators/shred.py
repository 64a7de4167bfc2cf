"""Nested JSON as an adjacency table, and flat related tables made from it (problem 2).

Method: each document becomes rows (node, parent, label, ordinal, kind, scalar); object nodes are then joined with their
scalar children and pivoted into entity tables. Parsing to any depth has no built-in expression, so the shredder is one
Arrow-batched pass; everything after it is relational.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import materialize

NODES = "node int, parent int, label string, ordinal int, kind string, scalar string"
ARROW = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string())


def _reject(text: str) -> None:
    raise ValueError(text)


def _parse(text: str | None):
    """The value of strict JSON text; raises ValueError otherwise (NaN and Infinity are no JSON)."""
    return json.loads(text, parse_constant=_reject)


_KINDS = {type(None): "null", bool: "boolean", dict: "object", list: "array", str: "string", int: "number", float: "number"}


def shred_text(text: str | None, unwrap: Sequence[str] = ()) -> list[tuple] | None:
    """The nodes of a JSON text in document order, or None if it is no valid JSON.

    Members of an object have a label, elements of an array an ordinal from 0. A string under one of the labels unwrap
    that is itself the JSON text of an array or object is taken for that array or object; other strings stay scalars.
    """
    try:
        root = _parse(text)
    except (ValueError, TypeError, RecursionError):
        return None
    rows, stack = [], [(root, None, None, None)]
    while stack:  # no recursion: depth is the data's
        value, parent, label, ordinal = stack.pop()
        if label in unwrap and isinstance(value, str) and value[:1] in "[{" and value[-1:] in "]}":
            try:
                value = _parse(value)
            except (ValueError, RecursionError):
                pass
        node, kind = len(rows), _KINDS[type(value)]
        scalar = None
        if kind in ("string", "number", "boolean"):
            scalar = value if kind == "string" else json.dumps(value)
        rows.append((node, parent, label, ordinal, kind, scalar))
        if kind == "object":
            stack += [(v, node, k, None) for k, v in reversed(value.items())]
        elif kind == "array":
            stack += [(v, node, None, i) for i, v in reversed(list(enumerate(value)))]
    return rows


def adjacency(pages: DataFrame, key: str = "page_id", payload: str = "payload", keep: Sequence[str] = (), unwrap: Sequence[str] = ()) -> DataFrame:
    """(key, keep.., node, parent, label, ordinal, kind, scalar) of every valid page; other pages have no rows.

    Null and blank payloads are not valid. Node 0 is the page's root. A key repeated in an object keeps its last value.
    """
    rows = pages.select(key, *keep, F.col(payload).alias("_text")).where(F.col("_text").isNotNull())
    kinds = dict(rows.dtypes)
    head = [key, *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                nodes: list[tuple] = []
                repeats = []
                for text in part.column("_text").to_pylist():
                    found = shred_text(text, unwrap) or ()
                    nodes += found
                    repeats.append(len(found))
                if not nodes:
                    continue
                at = np.repeat(np.arange(part.num_rows), repeats)
                ids = [part.column(c).take(pa.array(at)) for c in head]
                columns = [pa.array(c, t) for c, t in zip(zip(*nodes), ARROW, strict=True)]
                yield pa.RecordBatch.from_arrays([*ids, *columns], names=[*head, "node", "parent", "label", "ordinal", "kind", "scalar"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in head) + ", " + NODES
    return rows.mapInArrow(run, schema)


def invalid_pages(pages: DataFrame, key: str = "page_id", payload: str = "payload") -> DataFrame:
    """(key): pages that are not valid JSON, by the JVM's own parser."""
    return pages.where(F.try_parse_json(payload).isNull()).select(key)


def postings(nodes: DataFrame, key: str = "page_id", envelopes: Sequence[str] = ("jobs", "content")) -> DataFrame:
    """(key, node, position) of the posting objects: elements of the page's array or of its envelope's, else the page itself."""
    root = nodes.where("parent is null").select(key, F.col("kind").alias("root_kind"))
    lists = nodes.where((F.col("parent") == 0) & F.col("label").isin(*envelopes) & (F.col("kind") == "array")).groupBy(key).agg(F.min("node").alias("box"))
    where = root.join(lists, key, "left").select(key, F.when(F.col("root_kind") == "array", F.lit(0)).otherwise(F.col("box")).alias("box"))
    objects = nodes.where("kind = 'object'").select(key, "node", "parent", "ordinal")
    inside = objects.join(where.where("box is not null"), key).where("parent = box").select(key, "node", F.col("ordinal").alias("position"))
    alone = objects.where("parent is null").join(where.where("box is null"), key).select(key, "node", F.lit(0).alias("position"))
    return inside.unionByName(alone)


def children(nodes: DataFrame, key: str, owners: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(key, node, owner, label, position): objects an owner holds under one of labels, alone (position 0) or in an array."""
    holder = nodes.where(F.col("label").isin(*labels)).select(key, F.col("node").alias("holder"), F.col("parent").alias("owner"), "label", F.col("kind").alias("holder_kind"))
    held = holder.join(owners.select(key, F.col("node").alias("owner")), [key, "owner"], "left_semi")
    alone = held.where("holder_kind = 'object'").select(key, F.col("holder").alias("node"), "owner", "label", F.lit(0).alias("position"))
    objects = nodes.where("kind = 'object' and ordinal is not null").select(key, "node", F.col("parent").alias("holder"), F.col("ordinal").alias("position"))
    listed = objects.join(held.where("holder_kind = 'array'"), [key, "holder"]).select(key, "node", "owner", "label", "position")
    return alone.unionByName(listed)


def entity(nodes: DataFrame, key: str, objects: DataFrame, fields: Sequence[str], prefix: str = "") -> DataFrame:
    """objects with one column a field: its scalar members pivoted in one aggregation. Absent and null members give null."""
    scalars = nodes.where(F.col("label").isin(*fields)).select(key, F.col("parent").alias("node"), F.col("label").alias("_field"), "scalar")
    wide = scalars.groupBy(key, "node").agg(*[F.max(F.when(F.col("_field") == f, F.col("scalar"))).alias(f"{prefix}{f}") for f in fields])
    return objects.join(wide, [key, "node"], "left")


def flat_tables(pages: DataFrame, labels: Sequence[str] = ("customField", "departments", "lists")) -> dict[str, DataFrame]:
    """pages, postings and children as tables linked by page_id and posting node.

    pages: page_id, source, board_id, postings (objects in it); postings: page_id, node, position, posting_id, title;
    children: page_id, posting_node, posting_id, child_path, child_pos, and the scalar members name, text, content,
    fieldId, fieldLabel, valueId, valueLabel. Pages fetched again are pages of their own.
    """
    nodes = materialize(adjacency(pages, unwrap=labels), "nodes")
    posts = entity(nodes, "page_id", postings(nodes), ("id", "title", "text", "name"))
    posts = posts.select("page_id", "node", "position", F.col("id").alias("posting_id"), F.coalesce("title", "text", "name").alias("title"))
    kids = entity(nodes, "page_id", children(nodes, "page_id", posts, labels), ("id", "name", "text", "content", "fieldId", "fieldLabel", "valueId", "valueLabel"), "child_")
    kids = kids.withColumnsRenamed({"node": "child_node", "owner": "node", "label": "child_path", "position": "child_pos"}).join(posts.select("page_id", "node", "posting_id"), ["page_id", "node"])
    counts = posts.groupBy("page_id").agg(F.count("*").alias("postings"))
    valid = nodes.where("parent is null").select("page_id")
    heads = pages.select("page_id", "source", "board_id").join(valid, "page_id", "left_semi").join(counts, "page_id", "left").withColumn("postings", F.coalesce("postings", F.lit(0)))
    return {"pages": heads, "postings": posts, "children": kids}


def children_found(pages: DataFrame) -> DataFrame:
    """(page_id, posting_id, child_path, child_pos) of every child object of a posting."""
    return flat_tables(pages)["children"].select("page_id", "posting_id", "child_path", "child_pos")
