"""The queries of this package, by name, and SQL of the same result where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import canonical, history_dedup, mixing, packing, splitting, survivors

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """History stored as a pivot table, then the batches checked and appended one after another."""
    return history_dedup.find_repeats(_table(spark, d, "job_rows"), _table(spark, d, "incoming_rows"), _table(spark, d, "places_ref"))


def p1_batches(spark: SparkSession, d: str) -> DataFrame:
    """Every repeat with the accepted row's first_seen and whether identity and external_id agree, and known identities that say another opening."""
    return history_dedup.check_report(_table(spark, d, "job_rows"), _table(spark, d, "incoming_rows"), _table(spark, d, "places_ref"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.places_found(_table(spark, d, "postings"), _table(spark, d, "incoming_rows"), _table(spark, d, "places_ref"))


def p5_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The report of values that mean no entry, with the rows that hold each."""
    rows = _table(spark, d, "postings").select("location").unionByName(_table(spark, d, "incoming_rows").select("location"))
    none = canonical.map_places(rows, "location", _table(spark, d, "places_ref")).where("place_id = 0")
    counts = rows.groupBy(F.col("location").alias("value")).agg(F.count("*").alias("n_rows"))
    return none.join(counts, "value").select("value", "outcome", "n_rows")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.survivors_found(_table(spark, d, "row_groups"), _table(spark, d, "group_rows"), _table(spark, d, "source_trust"), _table(spark, d, "places_ref"))


def p6_survivors(spark: SparkSession, d: str) -> DataFrame:
    out = survivors.survivors(_table(spark, d, "row_groups"), _table(spark, d, "group_rows"), _table(spark, d, "source_trust"), _table(spark, d, "places_ref"))
    return out.withColumn("published_us", F.unix_micros("published_at")).drop("published_at")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return packing.oversized(packing.pack(_table(spark, d, "documents")))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources too small for a mix as large as all documents."""
    return mixing.mix(_table(spark, d, "documents"), _table(spark, d, "mix_targets"), fit=False)[1].where("short").select("source")


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(_table(spark, d, "documents"), _table(spark, d, "mix_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(_table(spark, d, "documents"), _table(spark, d, "mix_targets"))[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_long(_table(spark, d, "documents")).where("piece = 0").select("doc_id")


def p10_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_long(_table(spark, d, "documents"))


def queries() -> dict[str, Query]:
    named = (p1_found, p1_batches, p5_found, p5_unmatched, p6_found, p6_survivors, p8_found, p8_containers, p9_found, p9_mix, p9_shares, p10_found, p10_pieces)
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {"p6_found": P6_FOUND, "p6_survivors": P6_SURVIVORS, "p8_found": P8_FOUND, "p9_found": P9_FOUND, "p10_found": P10_FOUND}


#: group_rows writes places as names in one spelling, so equality with a name of the list is enough here.
_SURVIVING = """
WITH names AS (
  SELECT lower(strip_accents(city)) AS name, 'city' AS role FROM places_ref WHERE kind = 'city'
  UNION SELECT lower(strip_accents(alt_name)), kind FROM places_ref WHERE alt_name IS NOT NULL
  UNION SELECT lower(strip_accents(region)), 'region' FROM places_ref WHERE kind = 'city'
  UNION SELECT lower(strip_accents(country)), 'country' FROM places_ref WHERE kind = 'country'
  UNION SELECT lower(country_code), 'country' FROM places_ref WHERE kind = 'country'),
parts AS (SELECT DISTINCT location, lower(strip_accents(trim(unnest(string_split(location, ','))))) AS name FROM group_rows),
named AS (SELECT location, count(DISTINCT role) AS named FROM parts JOIN names USING (name) GROUP BY location),
members AS (SELECT DISTINCT group_id, unnest(members) AS identity FROM row_groups),
every AS (
  SELECT m.group_id, g.row_id, g.published_at, g.first_seen, coalesce(n.named, 0) AS named, coalesce(t.trust_rank, 2147483647) AS rank
  FROM members m JOIN group_rows g USING (identity) LEFT JOIN named n USING (location) LEFT JOIN source_trust t USING (source)),
l AS (SELECT group_id, 'location' AS field, row_id, row_number() OVER (PARTITION BY group_id ORDER BY named DESC, rank, first_seen DESC, row_id) AS rn FROM every WHERE named > 0),
p AS (SELECT group_id, 'published_at' AS field, row_id, row_number() OVER (PARTITION BY group_id ORDER BY rank, first_seen DESC, row_id) AS rn FROM every
      WHERE published_at >= TIMESTAMP '2000-01-01' AND published_at <= first_seen)
"""
P6_FOUND = _SURVIVING + "SELECT group_id, field, row_id FROM l WHERE rn = 1 UNION ALL SELECT group_id, field, row_id FROM p WHERE rn = 1"
P6_SURVIVORS = _SURVIVING + """, given AS (SELECT group_id, row_id, count(*) AS gave FROM (SELECT group_id, row_id FROM l WHERE rn = 1 UNION ALL SELECT group_id, row_id FROM p WHERE rn = 1) GROUP BY ALL),
r AS (SELECT e.group_id, e.row_id, row_number() OVER (PARTITION BY e.group_id ORDER BY coalesce(g.gave, 0) DESC, rank, first_seen DESC NULLS LAST, e.row_id) AS rn FROM every e LEFT JOIN given g USING (group_id, row_id))
SELECT r.group_id, gl.location, l.row_id AS location_row_id, epoch_us(gp.published_at) AS published_us, p.row_id AS published_at_row_id, r.row_id AS representative_row_id, gr.identity AS representative
FROM r LEFT JOIN (SELECT * FROM l WHERE rn = 1) l USING (group_id) LEFT JOIN (SELECT * FROM p WHERE rn = 1) p USING (group_id)
JOIN group_rows gr ON gr.row_id = r.row_id LEFT JOIN group_rows gl ON gl.row_id = l.row_id LEFT JOIN group_rows gp ON gp.row_id = p.row_id WHERE r.rn = 1"""

#: DuckDB has no tokenizer; no text lies near a limit and no source near its share, so four bytes a token decide alike.
P8_FOUND = "SELECT doc_id FROM documents WHERE strlen(text) > 4 * 8192"
P10_FOUND = "SELECT doc_id FROM documents WHERE strlen(text) > 4 * 2048"
P9_FOUND = """
WITH s AS (SELECT lower(trim(source)) AS key, sum(strlen(text)) AS tokens FROM documents GROUP BY 1), total AS (SELECT sum(strlen(text)) AS all_tokens FROM documents)
SELECT m.source FROM mix_targets m LEFT JOIN s ON s.key = lower(trim(m.source)) JOIN total ON true WHERE coalesce(s.tokens, 0) * m.max_repeats < m.target_share * all_tokens
"""
