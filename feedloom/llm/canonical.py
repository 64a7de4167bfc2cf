"""Free-typed values mapped to a canonical list of places (problem 5).

Method: the distinct values are normalised and cut into segments; candidates of each distinct segment come from an
inverted index of character n-grams over the reference names; they are scored by idf-weighted cosine and accepted above
a threshold and a margin, then held to one edit. The accepted names of a value are resolved together to one entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from feedloom.functions import text as T

# Words on how, or how near, one works to a place.
NEARNESS = r"\b(?:fully remote|remote|hybrid|on-?site|in-?office|work from home|wfh|home[- ]based|greater|downtown|central|near|around|close to|hq|headquarters?|metro(?:politan)?|area|region|offices?|anywhere in|based in|located in|only|flexible)\b"
SEPARATORS = r"\s*[,;/|()\[\]{}:\n·•]\s*|\s+[-–—]+\s+|^\s*[-–—]+\s+|\s+[-–—]+\s*$"


def segments(value: Column) -> Column:
    """The parts of a typed place, normalised, without numbers and words of nearness."""
    bare = F.regexp_replace(F.regexp_replace(T.plain(value), r"\bon[- ]site\b", "onsite"), NEARNESS, " ")
    parts = F.split(F.regexp_replace(bare, r"\b\d+\b", " "), SEPARATORS)
    tidy = F.transform(parts, lambda s: T.squeeze(F.regexp_replace(s, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")))
    return F.array_distinct(F.filter(tidy, lambda s: s != ""))


def reference_names(ref: DataFrame) -> DataFrame:
    """(name, role, place_id, code, region): every name of every entry; role is city, region, country or code."""
    code, region = T.plain(F.col("country_code")), T.plain(F.col("region"))
    is_city = F.col("kind") == "city"

    def named(c: Column, role: Column, ok: Column) -> Column:
        return F.when(ok & (T.plain(c) != ""), F.struct(T.plain(c).alias("name"), role.alias("role")))

    own = F.when(is_city, "city").otherwise("country")
    names = F.array_compact(
        F.array(
            named(F.col("city"), F.lit("city"), is_city),
            named(F.col("alt_name"), own, F.lit(True)),
            named(F.col("region"), F.lit("region"), is_city),
            named(F.col("country"), F.lit("country"), ~is_city),
            named(F.col("country_code"), F.lit("code"), ~is_city),
        )
    )
    return ref.select("place_id", code.alias("code"), region.alias("region"), F.explode(names).alias("n")).select("n.*", "place_id", "code", "region").distinct()


def match_names(values: DataFrame, names: DataFrame, threshold: float = 0.3, margin: float = 0.01, n: int = 2) -> DataFrame:
    """(seg, name, score) for each distinct text of column seg that has an accepted name; other texts have no row.

    values: one column seg without repeats. The index holds each n-gram of each distinct name with its idf weight, so
    work is the sum over shared n-grams, never all pairs. Names at a cosine of at least threshold are held to one edit
    (names under four characters to equality); the best is accepted if it leads the next by at least margin.
    """
    distinct = names.select("name").distinct()
    grams = distinct.select("name", F.explode(T.ngrams(F.col("name"), n)).alias("gram")).groupBy("name", "gram").agg(F.count("*").alias("tf"))
    total = F.lit(float(max(1, distinct.count())))  # of the reference list
    idf = grams.groupBy("gram").agg((1 + F.log(total / F.count("*"))).alias("idf"))
    index = grams.join(idf, "gram").select("name", "gram", (F.col("tf") * F.col("idf")).alias("w"))
    norms = index.groupBy("name").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("name_norm"))
    index = index.join(norms, "name")
    asked = values.select("seg", F.explode(T.ngrams(F.col("seg"), n)).alias("gram")).groupBy("seg", "gram").agg(F.count("*").alias("tf"))
    asked = asked.join(idf, "gram", "left").select("seg", "gram", (F.col("tf") * F.coalesce("idf", 1 + F.log(total))).alias("v"))
    seg_norm = asked.groupBy("seg").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("seg_norm"))
    dots = asked.join(index, "gram").groupBy("seg", "name").agg(F.sum(F.col("v") * F.col("w")).alias("dot"), F.first("name_norm").alias("name_norm"))
    scored = dots.join(seg_norm, "seg").select("seg", "name", (F.col("dot") / (F.col("name_norm") * F.col("seg_norm"))).alias("score")).where(F.col("score") >= threshold)
    small = F.length("name") < 4
    alike = scored.where(F.when(small, F.col("seg") == F.col("name")).otherwise(T.near(F.col("seg"), F.col("name"))))
    order = W.partitionBy("seg").orderBy(F.desc("score"), "name")
    best = alike.withColumn("rn", F.row_number().over(order)).withColumn("next", F.lead("score").over(order)).where("rn = 1")
    clear = (F.col("score") - F.coalesce("next", F.lit(0.0)) >= margin) | (F.col("seg") == F.col("name"))
    return best.where(clear).select("seg", "name", "score")


def map_places(values: DataFrame, column: str, ref: DataFrame, threshold: float = 0.3, margin: float = 0.01) -> DataFrame:
    """(value, place_id, outcome) for every distinct non-blank text of values[column].

    place_id is the entry meant: the city where one is named, else the country; 0 where none is meant. outcome says why:
    city, country, ambiguous (several entries fit alike), conflict (the city named lies in no country named), unknown.
    Null and blank texts give no row. Clashing column names don't matter: only values[column] is read.
    """
    texts = values.select(F.col(column).alias("value")).where(F.trim(F.col("value")) != "").distinct()
    texts = texts.select("value", segments(F.col("value")).alias("segs"))
    parts = texts.select("value", F.explode_outer("segs").alias("seg"))
    names = reference_names(ref)
    matched = match_names(parts.select("seg").where("seg is not null").distinct(), names, threshold, margin)
    found = parts.join(matched, "seg", "left").join(names, "name", "left")
    is_country = F.col("role").isin("country", "code")
    per_value = found.groupBy("value").agg(
        F.collect_set(F.when(F.col("role") == "city", F.struct("place_id", "code", "region"))).alias("cities"),
        F.collect_set(F.when(is_country, F.col("code"))).alias("codes"),
        F.collect_set(F.when(F.col("role") == "region", F.col("region"))).alias("regions"),
        F.collect_set(F.when(is_country, F.col("place_id"))).alias("countries"),
        F.count(F.when(F.col("name").isNull() & F.col("seg").isNotNull(), 1)).alias("unmatched"),
    )
    fits = F.transform(
        "cities",
        lambda c: F.struct(
            (F.when(F.array_contains("codes", c["code"]), 2).otherwise(0) + F.when(F.array_contains("regions", c["region"]), 1).otherwise(0)).alias("fit"),
            c["place_id"].alias("place_id"),
            (F.array_contains("codes", c["code"]) | (F.size("codes") == 0)).alias("ok"),
        ),
    )
    per_value = per_value.withColumn("fits", F.filter(fits, lambda c: c["ok"]))
    top = F.array_max(F.transform("fits", lambda c: c["fit"]))
    per_value = per_value.withColumn("best", F.array_distinct(F.transform(F.filter("fits", lambda c: c["fit"] == top), lambda c: c["place_id"])))
    outcome = (
        F.when(F.size("best") == 1, "city")
        .when(F.size("best") > 1, "ambiguous")
        .when(F.size("cities") > 0, "conflict")
        .when((F.size("countries") == 1) & (F.col("unmatched") == 0), "country")
        .otherwise("unknown")
    )
    place = F.when(outcome == "city", F.col("best")[0]).when(outcome == "country", F.col("countries")[0]).otherwise(F.lit(0))
    return per_value.select("value", place.cast("long").alias("place_id"), outcome.alias("outcome"))


def places_found(postings: DataFrame, incoming: DataFrame, ref: DataFrame) -> DataFrame:
    """(found_in, record_id, place_id) of every row with a location; the distinct texts are mapped once for both tables."""
    rows = postings.select(F.lit("postings").alias("found_in"), F.col("posting_id").alias("record_id"), F.col("location").alias("value")).unionByName(
        incoming.select(F.lit("incoming_rows").alias("found_in"), F.col("row_id").alias("record_id"), F.col("location").alias("value"))
    )
    rows = rows.where(F.trim(F.col("value")) != "")
    return rows.join(map_places(rows, "value", ref), "value").select("found_in", "record_id", "place_id")
