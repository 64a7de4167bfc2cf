"""Fixed-capacity containers filled with whole texts (problem 8).

Method: linear grouping. Lengths above a fraction of the capacity are cut into groups of equal cardinality and rounded
up to their group's greatest; a configuration LP over these few sizes is solved by column generation; texts then take
the places of the sizes, and the small ones go best-fit into what room is left.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.ranks import running
from feedloom.llm.tokens import VOCABULARY, sized
from feedloom.session import materialize

CAPACITY = 8192
SMALL = 8  # texts up to capacity / SMALL are small
GROUPS = 24
SHARD = 20_000  # small texts a task packs


def group_sizes(histogram: Sequence[tuple[int, int]], groups: int = GROUPS) -> list[tuple[int, int, int]]:
    """(least size, greatest size, items) of up to groups runs of sizes with about equally many items each, largest first."""
    total, out, held, top = sum(n for _, n in histogram), [], 0, None
    done = 0
    for size, n in sorted(histogram, reverse=True):
        top = size if top is None else top
        held += n
        if done + held >= total * (len(out) + 1) / groups:
            out.append((size, top, held))
            done, held, top = done + held, 0, None
    return out


def _best_pattern(sizes: Sequence[int], worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The unbounded knapsack: the multiset of sizes within capacity of most worth."""
    value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for _ in range(capacity // min(sizes)):
        best, pick = value.copy(), last.copy()
        for g, size in enumerate(sizes):
            trial = value[: capacity + 1 - size] + worth[g]
            better = trial > best[size:] + 1e-12
            best[size:][better], pick[size:][better] = trial[better], g
        if np.array_equal(best, value):
            break
        value, last = best, pick
    counts, room = np.zeros(len(sizes), int), capacity
    # rebuilt greedily from the final values: each step takes a size whose removal explains the value
    while room > 0:
        for g, size in enumerate(sizes):
            if size <= room and value[room] > 1e-12 and abs(value[room - size] + worth[g] - value[room]) < 1e-9:
                counts[g] += 1
                room -= size
                break
        else:
            break
    return float(counts @ worth), counts


def configurations(sizes: Sequence[int], demand: Sequence[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """[(items of each size, containers)] that hold at least demand: LP by column generation, rounded down, rest first-fit."""
    k = len(sizes)
    if not k:
        return []
    basis = np.diag([float(capacity // s) for s in sizes])
    x = np.array(demand, float) / basis.diagonal()
    for _ in range(40 * k):
        worth = np.linalg.solve(basis.T, np.ones(k))
        gain, column = _best_pattern(sizes, np.maximum(worth, 0), capacity)
        if gain <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, column.astype(float))
        ratios = np.where(step > 1e-12, x / np.where(step > 1e-12, step, 1), np.inf)
        out = int(np.argmin(ratios))
        if not np.isfinite(ratios[out]):
            break
        x = np.maximum(x - ratios[out] * step, 0)
        x[out], basis[:, out] = ratios[out], column
    left, chosen = np.array(demand, int), []
    for j in range(k):
        pattern, times = np.round(basis[:, j]).astype(int), int(math.floor(x[j] + 1e-9))
        while times > 0 and np.any(pattern * times > left):
            fits = [int(left[g] // pattern[g]) for g in range(k) if pattern[g]]
            if (fewer := min(min(fits), times)) == 0:
                break
            times = fewer
        if times > 0 and np.all(pattern * times <= left):
            chosen.append((pattern, times))
            left = left - pattern * times
    while left.any():  # a few containers remain: largest first, each pattern as often as it repeats
        pattern, room = np.zeros(k, int), capacity
        for g in np.argsort(-np.array(sizes)):
            pattern[g] = min(left[g], room // sizes[g])
            room -= pattern[g] * sizes[g]
        times = int(min(left[g] // pattern[g] for g in range(k) if pattern[g]))
        chosen.append((pattern, times))
        left = left - pattern * times
    return chosen


def best_fit(sizes: Sequence[int], room: Sequence[tuple[int, str]], capacity: int, name: str) -> list[str]:
    """The container of each size, in the order given: the fullest it fits into, else a new one."""
    open_ = sorted(room)
    out, made = [], 0
    for size in sizes:
        at = bisect.bisect_left(open_, (size, ""))
        if at < len(open_):
            free, box = open_.pop(at)
        else:
            free, box = capacity, f"{name}-{made}"
            made += 1
        out.append(box)
        if free > size:
            bisect.insort(open_, (free - size, box))
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str = VOCABULARY, groups: int = GROUPS, shard: int = SHARD) -> DataFrame:
    """(doc_id, piece, pieces, start_token, n_tokens, container_id): every text, in containers of at most capacity tokens.

    A text over capacity is cut at every capacity tokens: the full pieces have a container each, the rest is an item like
    any other. Null and empty texts have size 0 and lie in some container. Repeated rows are items of their own. What
    goes to the driver is a histogram of sizes, which has at most capacity + 1 rows at any input size.
    """
    items = sized(docs, path).withColumn("nth", F.monotonically_increasing_id())
    # nth numbers rows of one written table, so it is stable from here on
    items = materialize(items, "sizes")
    pieces = F.greatest(F.ceil(F.col("n_tokens") / capacity), F.lit(1)).cast("long")
    cut = items.withColumn("pieces", pieces).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    start = F.col("piece") * capacity
    cut = cut.select("doc_id", "nth", "piece", "pieces", start.alias("start_token"), F.least(F.col("n_tokens") - start, F.lit(capacity)).alias("size"))
    histogram = [(r["size"], r["n"]) for r in cut.groupBy("size").agg(F.count("*").alias("n")).collect()]
    large = [(s, n) for s, n in histogram if capacity // SMALL < s < capacity]
    runs = group_sizes(large, groups)
    plan = configurations([top for _, top, _ in runs], [n for *_, n in runs], capacity)

    full = cut.where(F.col("size") == capacity).withColumn("container_id", F.format_string("F%d-%d", "nth", "piece"))
    columns = ["doc_id", "nth", "piece", "pieces", "start_token", "size", "container_id"]
    # (run, first rank, end rank, first container, items a container): at most runs x configurations rows
    places, first_box, rank = [], 0, [0] * len(runs)
    for pattern, times in plan:
        for g, m in enumerate(pattern):
            if m:
                places.append((g, rank[g], rank[g] + int(m) * times, first_box, int(m)))
                rank[g] += int(m) * times
        first_box += times
    spark = docs.sparkSession
    run_of = F.lit(None).cast("int")
    for g, (low, top, _) in enumerate(runs):
        run_of = F.when((F.col("size") >= low) & (F.col("size") <= top), F.lit(g)).otherwise(run_of)
    big = cut.where((F.col("size") > capacity // SMALL) & (F.col("size") < capacity)).withColumn("run", run_of)
    salts = max(1, sum(n for _, n in large) // shard)
    ranked = running(big, ["run"], F.pmod(F.xxhash64("nth", "piece"), F.lit(salts)), ["nth", "piece"], F.lit(1), "rank")
    table = spark.createDataFrame(places, "run int, low long, high long, box long, each long")
    held = ranked.join(F.broadcast(table), (ranked["run"] == table["run"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    held = held.withColumn("container_id", F.format_string("L%d", F.col("box") + F.floor((F.col("rank") - F.col("low")) / F.col("each")))).select(*columns)
    held = materialize(held, "large")

    small = cut.where(F.col("size") <= capacity // SMALL).withColumn("container_id", F.lit(None).cast("string")).select(*columns)
    tasks = max(1, math.ceil(sum(n for s, n in histogram if s <= capacity // SMALL) / shard))
    room = held.groupBy("container_id").agg((capacity - F.sum("size")).cast("long").alias("room")).where("room > 0")
    room = room.withColumn("task", F.pmod(F.xxhash64("container_id"), F.lit(tasks)))

    def fill(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values(["size", "nth", "piece"], ascending=[False, True, True])
        return left.assign(container_id=best_fit(left["size"].tolist(), list(zip(right["room"].tolist(), right["container_id"].tolist(), strict=True)), capacity, f"S{key[0]}"))[columns]

    schema = small.schema
    fitted = small.withColumn("task", F.pmod(F.xxhash64("nth", "piece"), F.lit(tasks))).groupBy("task").cogroup(room.groupBy("task")).applyInPandas(fill, schema)
    every = full.select(*columns).unionByName(held).unionByName(fitted)
    return every.select("doc_id", "piece", "pieces", "start_token", F.col("size").alias("n_tokens"), "container_id")


def oversized(packed: DataFrame) -> DataFrame:
    """(doc_id): texts that had to be cut."""
    return packed.where("pieces > 1").select("doc_id").distinct()


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(containers, tokens, used_share, fewest): fewest is the least number of containers that could hold the tokens."""
    boxes = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("tokens"))
    return boxes.agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), (F.sum("tokens") / (F.count("*") * capacity)).alias("used_share"), F.ceil(F.sum("tokens") / capacity).alias("fewest"))
