"""The best representative of each group of duplicates (problem 6).

Method: field-by-field survivorship by one aggregation, the maximum of a composite struct for each attribute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import text as T
from feedloom.llm.canonical import match_names, reference_names, segments

#: Dates before this were never real publication dates.
EARLIEST = "2000-01-01"


def completeness(rows: DataFrame, column: str, ref: DataFrame) -> DataFrame:
    """(value, named) for each distinct non-blank rows[column]: how many of city, region and country it names."""
    texts = rows.select(F.col(column).alias("value")).where(F.trim(F.col("value")) != "").distinct()
    parts = texts.select("value", F.explode(segments(F.col("value"))).alias("seg"))
    names = reference_names(ref)
    matched = match_names(parts.select("seg").distinct(), names)
    roles = names.select("name", F.when(F.col("role") == "code", "country").otherwise(F.col("role")).alias("role")).distinct()
    return parts.join(matched, "seg").join(roles, "name").groupBy("value").agg(F.count_distinct("role").alias("named"))


def members_of(groups: DataFrame, rows: DataFrame) -> DataFrame:
    """group_id and the row_id, source, location, dates of rows, one row for each distinct member of a group that rows holds."""
    listed = groups.select("group_id", F.explode("members").alias("identity")).distinct()
    return listed.join(rows.select("identity", "row_id", "source", "location", "published_at", "first_seen"), "identity")


def survivors(groups: DataFrame, rows: DataFrame, trust: DataFrame, ref: DataFrame) -> DataFrame:
    """One row a group: the surviving location and published_at, the members they come from, and the representative.

    A location counts if it names a place of ref; most of city, region and country wins, then the lowest trust_rank, then
    the latest first_seen, then the smaller row_id. A date counts from 2000 on if not after its row's first_seen; then
    trust, first_seen, row_id. The representative is the member that gives most surviving values, then trust, first_seen,
    row_id. A source without rank comes last; null first_seen counts as earliest; a date whose first_seen is null counts
    as not usable. Groups none of whose members rows holds have no row; nulls and repeats in members are ignored.
    """
    ranked = trust.groupBy("source").agg(F.min("trust_rank").alias("trust_rank"))
    named = completeness(rows, "location", ref)
    every = members_of(groups, rows).join(ranked, "source", "left").join(named.withColumnRenamed("value", "location"), "location", "left")
    trusted = -F.coalesce(F.col("trust_rank"), F.lit(2**31 - 1)).cast("long")
    seen = F.coalesce(F.unix_micros("first_seen"), F.lit(-(2**62)))

    who = [trusted.alias("trust"), seen.alias("seen"), (-F.col("row_id")).alias("id"), F.col("identity").alias("identity")]

    def best(usable: Column, value: Column, *first: Column) -> Column:
        return F.max(F.when(usable, F.struct(*[x.alias(f"k{i}") for i, x in enumerate(first)], *who, value.alias("value"))))

    dated = (F.col("published_at") >= F.lit(EARLIEST).cast("timestamp")) & (F.col("published_at") <= F.col("first_seen"))
    fields = {"location": best(F.col("named") > 0, F.col("location"), F.col("named")), "published_at": best(dated, F.col("published_at"))}
    per_group = every.groupBy("group_id").agg(*[best_.alias(f"_{f}") for f, best_ in fields.items()], F.max(F.struct(*who)).alias("_any"))
    givers = F.array_compact(F.array(*[F.when(F.col(f"_{f}").isNotNull(), F.struct(*[F.col(f"_{f}.{k}").alias(k) for k in ("trust", "seen", "id", "identity")])) for f in fields]))
    gave = F.transform(givers, lambda g: F.struct(F.size(F.filter(givers, lambda h: h["id"] == g["id"])).alias("gave"), g["trust"].alias("trust"), g["seen"].alias("seen"), g["id"].alias("id"), g["identity"].alias("identity")))
    winner = F.coalesce(F.array_max(gave), F.struct(F.lit(0).alias("gave"), "_any.*"))
    columns = [c for f in fields for c in (F.col(f"_{f}.value").alias(f), (-F.col(f"_{f}.id")).alias(f"{f}_row_id"))]
    out = per_group.select("group_id", *columns, winner.alias("_winner"))
    return out.withColumns({"representative_row_id": -F.col("_winner.id"), "representative": F.col("_winner.identity")}).drop("_winner")


def survivors_found(groups: DataFrame, rows: DataFrame, trust: DataFrame, ref: DataFrame) -> DataFrame:
    """(group_id, field, row_id) of the fields that have a surviving value."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_row_id").alias("row_id")) for f in ("location", "published_at")])
    return survivors(groups, rows, trust, ref).select("group_id", F.inline(pairs)).where("row_id is not null")
