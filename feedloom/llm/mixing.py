"""Sources mixed to target weights (problem 9).

Method: a low-discrepancy schedule. Slot i of the mix has the point frac(i x golden ratio), which falls into one source's
stretch of the cumulated weights; the slots of a source are ranked, and the r-th takes the source's r-th block of equally
many tokens, cut from the source's texts in shuffled order, pass after pass up to max_repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from feedloom.functions import text as T
from feedloom.operators.ranks import running
from feedloom.llm.tokens import VOCABULARY, sized
from feedloom.session import materialize

GOLDEN = (5**0.5 - 1) / 2
SHARD = 100_000  # texts or slots in a window


def source_key(c: Column) -> Column:
    return T.plain(c)


def block_tokens(total: int) -> int:
    """Tokens of a block: some 8,000 blocks of a small mix, 65,536 tokens in a large one."""
    return min(65_536, max(16, total // 8192))


def mix(docs: DataFrame, targets: DataFrame, path: str = VOCABULARY, seed: int = 17, fit: bool = True) -> tuple[DataFrame, DataFrame]:
    """(the mix, its report).

    The mix: slot, source, doc_id, pass, n_tokens; a text goes into the slot in whose block it starts. The report has a
    row for each entry of targets: source, target_share, max_repeats, tokens (of the source, once), goal_tokens (of the
    whole mix), tokens_mixed, share_of_goal, actual_share (of what was mixed), short.
    With fit, the mix is as large as all of docs or, where some source with tokens can't give its share of that with all
    its repeats, as large as the scarcest source allows, so that every source that has tokens reaches its target; the
    shares of sources without any tokens are handed on in proportion. Without fit, the mix is scheduled as large as all
    of docs, the slots of sources that run out stay empty, and short says which sources these are.
    Spellings of a source that differ in case, blanks or marks are one. Texts whose source is null or not in targets are
    counted in the size of the mix but not drawn; null and empty texts have no tokens and are drawn with their block.
    targets is configuration: it is read to the driver. Null or negative shares count as 0, null max_repeats as 1.
    """
    spark = docs.sparkSession
    items = materialize(sized(docs, path, "doc_id", "text", "source").withColumn("key", source_key(F.col("source"))).drop("source"), "sizes")
    wanted = targets.groupBy(source_key(F.col("source")).alias("key")).agg(F.min("source").alias("source"), F.greatest(F.sum(F.coalesce("target_share", F.lit(0.0))), F.lit(0.0)).alias("share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("repeats")).where("key is not null")
    entries = sorted((r["key"], r["source"], r["share"], r["repeats"]) for r in wanted.collect())
    shares = {key: share for key, _, share, _ in entries}
    sums = {r["key"]: (r["tokens"], r["n"]) for r in items.groupBy("key").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")).join(wanted.select("key"), "key", "right").collect()}
    total = items.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("t")).collect()[0]["t"]
    goal = total
    if fit:
        entries_ = [(share, repeats, (sums.get(key) or (0, 0))[0] or 0) for key, _, share, repeats in entries]
        present = sum(share for share, _, tokens in entries_ if tokens) or 1.0
        goal = int(min([total, *(tokens * max(repeats, 0) * present / share for share, repeats, tokens in entries_ if share and tokens)]))
        entries = [(key, source, share if (sums.get(key) or (0, 0))[0] else 0.0, repeats) for key, source, share, repeats in entries]
    size = block_tokens(goal)
    slots = -(-goal // size)

    ends, at, weight = [], 0.0, sum(e[2] for e in entries) or 1.0
    for _, _, share, _ in entries:
        at += share / weight
        ends.append(at)
    point = F.pmod((F.col("id") + 1) * F.lit(GOLDEN), F.lit(1.0))
    which = F.least(F.size(F.filter(F.lit(ends or [1.0]), lambda e: e <= point)), F.lit(max(0, len(entries) - 1)))
    schedule = spark.range(slots).select(F.col("id").alias("slot"), F.get(F.lit([e[0] for e in entries] or [""]), which).alias("key"))
    ranked = running(schedule, ["key"], F.floor(F.col("slot") / SHARD), ["slot"], F.lit(1), "block")

    # passes that the schedule can reach: no text is repeated more often than the target asks, nor than allowed
    rows = []
    for key, _, share, repeats in entries:
        tokens, n = sums.get(key) or (0, 0)
        asked = int(-(-(share / weight * goal + 2 * size) // tokens)) if tokens else 0
        rows.append((key, max(0, min(repeats, asked)), max(1, (n or 0) // SHARD + 1)))
    passes = spark.createDataFrame(rows, "key string, passes int, shards long")
    drawn = items.join(F.broadcast(passes), "key").where("passes > 0").withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("passes"))))
    drawn = drawn.withColumn("at", F.pmod(F.xxhash64("doc_id", "pass", F.lit(seed)), F.lit(2**40)))
    order = F.col("pass") * F.lit(2**20) + F.floor(F.col("at") * F.col("shards") / F.lit(2**40))
    placed = running(drawn, ["key"], order, ["at", "doc_id"], F.col("n_tokens"), "before").withColumn("block", F.floor(F.col("before") / size))
    mixed = placed.join(ranked, ["key", "block"]).join(F.broadcast(spark.createDataFrame([(e[0], e[1]) for e in entries], "key string, source string")), "key")
    mixed = materialize(mixed.select("slot", "source", "doc_id", "pass", "n_tokens"), "mix")

    facts = spark.createDataFrame([(source, shares[key], repeats, (sums.get(key) or (0, 0))[0] or 0) for key, source, share, repeats in entries], "source string, target_share double, max_repeats int, tokens long")
    got = mixed.groupBy("source").agg(F.sum("n_tokens").alias("tokens_mixed"))
    every = W.partitionBy()  # one row a target
    report = facts.join(got, "source", "left").withColumn("tokens_mixed", F.coalesce("tokens_mixed", F.lit(0))).withColumn("all_mixed", F.sum("tokens_mixed").over(every))
    reached = F.col("tokens_mixed") + 2 * size >= F.col("target_share") / weight * F.lit(float(goal))
    report = report.select(
        "source", "target_share", "max_repeats", "tokens", F.lit(goal).cast("long").alias("goal_tokens"), "tokens_mixed",
        F.try_divide("tokens_mixed", F.lit(float(goal))).alias("share_of_goal"),
        F.try_divide("tokens_mixed", "all_mixed").alias("actual_share"),
        # the schedule fell short, and indeed every permitted pass of the source is too little
        (~reached & (F.col("tokens") * F.col("max_repeats") < F.col("target_share") * F.lit(float(goal)))).alias("short"),
    )
    return mixed, report
