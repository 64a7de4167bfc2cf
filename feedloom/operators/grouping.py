"""Duplicates collapsed by key: the group, its representative, its places, and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import fold


def dedupe_key(employer: Column, board_id: Column, title: Column, published_at: Column) -> Column:
    """Folded employer (else the board), folded title and the day of publication (else '')."""
    who = F.when(fold(employer) != "", fold(employer)).otherwise(F.concat(F.lit("board:"), F.coalesce(board_id, F.lit(""))))
    return F.concat_ws("|", who, fold(title), F.coalesce(F.date_format(published_at, "yyyy-MM-dd"), F.lit("")))


def groups(rows: DataFrame) -> DataFrame:
    """(group_key, representative, size, locations): the representative is the earliest published, then least identity; undated first.

    locations are the sorted distinct non-empty ones, one a line. One aggregation, combined before the shuffle.
    """
    keyed = rows.select(dedupe_key(F.col("employer"), F.col("board_id"), F.col("title_normalised"), F.col("published_at")).alias("group_key"), "identity", "published_at", "location")
    rank = F.struct(F.coalesce(F.unix_micros("published_at"), F.lit(-(2**62))).alias("at"), F.col("identity").alias("identity"))
    place = F.when(F.trim("location") != "", F.col("location"))
    return keyed.groupBy("group_key").agg(
        F.min(rank)["identity"].alias("representative"),
        F.count("*").alias("size"),
        F.array_join(F.array_sort(F.collect_set(place)), "\n").alias("locations"),
    )


def counts(grouped: DataFrame) -> DataFrame:
    """One row: postings, groups, collapsed, largest; zeros for no group."""
    return grouped.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("postings"),
        F.count("*").alias("groups"),
        (F.coalesce(F.sum("size"), F.lit(0)) - F.count("*")).alias("collapsed"),
        F.coalesce(F.max("size"), F.lit(0)).alias("largest"),
    )


def closed_on(rows: DataFrame, group: str, day: Column) -> DataFrame:
    """(group, closed_on): the latest day, null while any member has none."""
    return rows.groupBy(group).agg(F.when(F.count(day) == F.count("*"), F.max(day)).alias("closed_on"))


def shared_attributes(rows: DataFrame, accepted: DataFrame, attributes: dict[str, Column], id_col: str) -> DataFrame:
    """(id, attribute, first_id, n_accepted): for each attribute a row shares with accepted ones, the first such and their number.

    Attributes are unpivoted and accepted rows are aggregated by value before the join, so a value that many share costs
    one row. A row doesn't count as its own match.
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(n).alias("attribute"), c.cast("string").alias("value")) for n, c in attributes.items()]))
    mine = rows.select(F.col(id_col).alias("id"), pairs).where("value <> ''")
    theirs = accepted.select(F.col(id_col).alias("other"), pairs).where("value <> ''").distinct()
    by_value = theirs.groupBy("attribute", "value").agg(F.min("other").alias("low"), F.count("*").alias("n"))
    selves = theirs.select(F.col("other").alias("id"), "attribute", F.lit(1).alias("own"))
    second = theirs.join(by_value, ["attribute", "value"]).where("other > low").groupBy("attribute", "value").agg(F.min("other").alias("next"))
    joined = mine.join(by_value, ["attribute", "value"]).join(second, ["attribute", "value"], "left").join(selves, ["id", "attribute"], "left")
    n = F.col("n") - F.coalesce("own", F.lit(0))
    first = F.when(F.col("low") == F.col("id"), F.col("next")).otherwise(F.col("low"))
    return joined.where(n > 0).select("id", "attribute", first.alias("first_id"), n.alias("n_accepted"))
