"""Paths, sanitising and trimming of JSON of any depth, on the adjacency table or in Arrow batches."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, types
from pyspark.sql import functions as F

_MAIL = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]+")


def first_at(value: object, path: str) -> list:
    """[what lies at a dotted path], or [] for nothing there.

    The path's keys lead through objects. Where an array lies on the way its items are tried in their order, each with the
    keys that are left. Of the places that can be reached so, the first counts, null included.
    """
    waiting = [(value, tuple(path.split(".")))]
    while waiting:  # depth first, so the order of items is kept
        here, keys = waiting.pop()
        if not keys:
            return [here]
        if isinstance(here, list):
            waiting += [(x, keys) for x in reversed(here)]
        elif isinstance(here, dict) and keys[0] in here:
            waiting.append((here[keys[0]], keys[1:]))
    return []


def sanitised(value: object, fields: Sequence[str], text: str = "removed") -> object:
    """value with the texts under fields, at any depth, and all e-mail addresses replaced."""
    if isinstance(value, dict):
        return {k: text if k in fields and isinstance(v, str) else sanitised(v, fields, text) for k, v in value.items()}
    if isinstance(value, list):
        return [sanitised(x, fields, text) for x in value]
    return _MAIL.sub("someone@example.org", value) if isinstance(value, str) else value


def _each(change, kind: types.DataType):
    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(x):
            try:
                return change(json.loads(x))
            except (ValueError, TypeError, RecursionError):
                return None

        for batch in batches:
            yield batch.map(one)

    return run


def resolved(c: Column, path: str) -> Column:
    """The value at path as text, JSON for containers; null where it is absent, null, or the text no JSON. All of it in the JVM.

    As first_at(), but that an array within an array is not entered.
    """

    def below(v: Column, keys: list[str]) -> Column:
        if not keys:
            return v
        member = below(F.try_variant_get(v, f"$.{keys[0]}", "variant"), keys[1:])
        items = F.try_variant_get(v, "$", "array<variant>")
        inside = F.transform(items, lambda x: below_object(x, keys))
        return F.coalesce(member, F.get(F.filter(inside, lambda x: x.isNotNull()), F.lit(0)))

    def below_object(v: Column, keys: list[str]) -> Column:
        return below(F.try_variant_get(v, f"$.{keys[0]}", "variant"), keys[1:])

    found = below(F.try_parse_json(c), path.split("."))
    text = F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(found, "$", "string")).otherwise(F.to_json(found))
    return F.when(~F.is_variant_null(found), text)


def sanitise(c: Column, fields: Sequence[str]) -> Column:
    """JSON text sanitised; null for what is no JSON."""
    return _each(lambda x: json.dumps(sanitised(x, fields), ensure_ascii=False), types.StringType())(c)


def trimmed(c: Column, schema: str) -> Column:
    """JSON text with only the members of schema, in the JVM."""
    return F.to_json(F.from_json(c, schema))


def text_leaks(nodes: DataFrame, key: str, forbidden: Sequence[str], longest: int = 1000, markup: str = r"<(?:p|li|div|br|ul)\b") -> DataFrame:
    """(key, leaks, labels) of documents whose adjacency table has a text under a forbidden label, a text over longest characters, or markup."""
    leak = (F.length("scalar") > longest) | F.rlike("scalar", F.lit(markup)) | (F.col("label").isin(*forbidden) & (F.length("scalar") > 0))
    return nodes.where((F.col("kind") == "string") & leak).groupBy(key).agg(F.count("*").alias("leaks"), F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"))
