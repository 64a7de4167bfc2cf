"""Timestamps of many formats and zones brought to one UTC instant (problem 4).

Method: all valid interpretations of each value are generated as an array; where there are several, a Viterbi pass over
the record order of each source chooses among them, penalising switches of format and steps back in time.
"""

from __future__ import annotations

import re
import zoneinfo

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from feedloom.operators.ranks import positions
from feedloom.session import materialize

EARLIEST = "2000-01-01"
#: Numbers are epochs in the unit that puts them between these instants, of which no number has two.
EPOCH_FROM, EPOCH_TO = 946_684_800, 4_102_444_800
SWITCH, BACKWARD = 1.0, 0.6
BLOCK = 20_000

# Zone names of RFC 822, in minutes.
OFFSETS = {"Z": 0, "UT": 0, "UTC": 0, "GMT": 0, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420}
# Months by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

# The patterns of the formats that are read.
TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,12}))?)?"
PATTERNS = {
    "iso": r"^(\d{4})-(\d{2})-(\d{2})[Tt ]" + TIME + r"\s*(.*)$",
    "basic": r"^(\d{4})(\d{2})(\d{2})[Tt](\d{2})(\d{2})(\d{2})(?:[.,](\d{1,12}))?\s*(.*)$",
    "day_first": r"^(?:[A-Za-z]{3,9},?\s+)?(\d{1,2})[\s-]+([A-Za-z]{3,9})\.?,?[\s-]+(\d{4})(?:,?\s+" + TIME + r"\s*(.*))?$",
    "month_first": r"^([A-Za-z]{3,9})\.?\s+(\d{1,2}),?\s+(\d{4})(?:,?\s+" + TIME + r"\s*([AaPp]\.?[Mm]\.?)?\s*(.*))?$",
    "day": r"^(\d{4})([-/.]?)(\d{2})\2(\d{2})$",
    "numeric": r"^(\d{1,2})([/.-])(\d{1,2})\2(\d{4})$",
    "epoch": r"^(\d{1,17})(?:\.(\d{1,9}))?$",
}


def known_zones(spark: SparkSession) -> list[str]:
    """Region/City names that both Python's and the JVM's zone tables hold."""
    names = {z for z in zoneinfo.available_timezones() if "/" in z and not z.startswith(("Etc/", "posix/", "right/"))}
    try:
        names &= set(spark._jvm.java.time.ZoneId.getAvailableZoneIds())
    except (AttributeError, TypeError):
        pass
    return sorted(names)


def in_zone(local: Column, zone: Column) -> Column:
    """The instants at which clocks of zone showed local (a timestamp whose UTC fields are the clock's): none in a gap, two in a fold."""
    day = F.expr("INTERVAL 1 DAY")
    before, after = F.to_utc_timestamp(local - day, zone) + day, F.to_utc_timestamp(local + day, zone) - day
    return F.array_distinct(F.filter(F.array(before, after), lambda t: F.coalesce(F.from_utc_timestamp(t, zone) == local, F.lit(False))))


def _int(c: Column) -> Column:
    return c.cast("int")


def with_readings(df: DataFrame, raw: str, zone: str, zones: list[str]) -> DataFrame:
    """df with readings, array<struct<format, at>>: every instant from EARLIEST on that the text may name, each instant once.

    zone is the clock's for times without zone or offset; without it they name nothing. A bare day is its midnight UTC.
    Digits beyond microseconds are cut off. Dates and times that don't exist, and any other text, have no reading.
    """
    kept = df.columns
    zone, listed = F.col(zone), F.lit(",".join(zones))
    df = df.withColumn("_text", F.regexp_replace(F.col(raw), r"^[\s\u00a0\u3000]+|[\s\u00a0\u3000]+$", ""))
    text = F.col("_text")
    # each pattern is matched once: its groups become an array
    groups = {name: "\u0001".join(f"${k}" for k in range(1, re.compile(p).groups + 1)) for name, p in PATTERNS.items()}
    df = df.withColumns({f"_{name}": F.when(F.rlike(text, F.lit(p)), F.split(F.regexp_replace(text, p, groups[name]), "\u0001")) for name, p in PATTERNS.items()})
    got = {name: (lambda n, name=name: F.get(f"_{name}", F.lit(n - 1))) for name in PATTERNS}
    is_ = {name: F.col(f"_{name}").isNotNull() for name in PATTERNS}
    month = lambda c: _int(F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(c, 1, 3))), F.lit(0)))

    def clock(y, mo, d, h, mi, s, frac) -> Column:
        seconds = F.concat(F.when(s == "", "0").otherwise(s), F.lit("."), F.rpad(F.substring(frac, 1, 6), 6, "0")).cast("decimal(16,6)")
        made = F.try_make_timestamp(y, mo, d, h, mi, seconds, F.lit("UTC"))
        return F.when((seconds < 60) & (h < 24), made)

    zero = F.lit(0)

    def day(y, mo, d) -> Column:
        return F.try_make_timestamp(y, mo, d, zero, zero, zero.cast("decimal(16,6)"), F.lit("UTC"))

    def dated(name: str, at: Column) -> Column:
        return F.array(F.struct(F.lit(name).alias("format"), at.alias("at")))

    def timed(name: str, local: Column, tail: Column) -> Column:
        tail = F.trim(F.regexp_replace(tail, r"\([^)]*\)\s*$", ""))
        named = F.regexp_extract(tail, r"^\[?([A-Za-z]+(?:/[A-Za-z_+-]+)+)\]?$", 1)
        offset = F.regexp_extract(tail, r"^([+-]\d{2}):?(\d{2})?(?:\[[^\]]*\])?$", 1)
        minutes = F.regexp_extract(tail, r"^([+-]\d{2}):?(\d{2})?(?:\[[^\]]*\])?$", 2)
        sign = F.when(F.startswith(offset, F.lit("-")), -1).otherwise(1)
        by = F.when(offset != "", _int(offset) * 60 + sign * _int(F.when(minutes == "", "0").otherwise(minutes)))
        by = F.when((F.abs(by) <= 18 * 60) & (minutes < "60"), by)
        table = F.create_map(*[F.lit(x) for kv in OFFSETS.items() for x in kv])
        by = F.coalesce(by, F.try_element_at(table, F.upper(tail)))
        safe, board = (F.when(F.find_in_set(z, listed) > 0, z) for z in (named, zone))
        exact = F.timestamp_micros(F.unix_micros(local) - by.cast("long") * 60_000_000)
        ats = F.when(tail == "", in_zone(local, board)).when(named != "", in_zone(local, safe)).when(by.isNotNull(), F.array(exact))
        kind = F.when(tail == "", f"{name} local").when(named != "", f"{name} zone").otherwise(f"{name} offset")
        return F.transform(ats, lambda t: F.struct(kind.alias("format"), t.alias("at")))

    i, b, d, m, p, n, e = (got[k] for k in ("iso", "basic", "day_first", "month_first", "day", "numeric", "epoch"))
    half = F.upper(F.substring(m(8), 1, 1))
    hour = _int(F.nullif(m(4), F.lit("")))
    hour = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "P", 12).otherwise(0))
    number = F.concat(e(1), F.lit("."), F.rpad(e(2), 9, "0")).cast("decimal(27,9)")

    def epoch(unit: str, per_second: int) -> Column:
        seconds = number / per_second
        at = F.timestamp_micros((number * 1_000_000 / per_second).cast("decimal(38,9)").cast("long"))
        return F.struct(F.lit(f"epoch {unit}").alias("format"), F.when((seconds >= EPOCH_FROM) & (seconds < EPOCH_TO), at).alias("at"))

    empty = F.array().cast("array<struct<format:string,at:timestamp>>")
    found = (
        F.when(is_["iso"], timed("iso", clock(_int(i(1)), _int(i(2)), _int(i(3)), _int(i(4)), _int(i(5)), i(6), i(7)), i(8)))
        .when(is_["basic"], timed("basic", clock(_int(b(1)), _int(b(2)), _int(b(3)), _int(b(4)), _int(b(5)), b(6), b(7)), b(8)))
        .when(is_["day_first"] & (d(4) != ""), timed("day first", clock(_int(d(3)), month(d(2)), _int(d(1)), _int(F.nullif(d(4), F.lit(""))), _int(F.nullif(d(5), F.lit(""))), d(6), d(7)), d(8)))
        .when(is_["day_first"], dated("day first", day(_int(d(3)), month(d(2)), _int(d(1)))))
        .when(is_["month_first"] & (m(4) != ""), timed("month first", clock(_int(m(3)), month(m(1)), _int(m(2)), hour, _int(F.nullif(m(5), F.lit(""))), m(6), m(7)), m(9)))
        .when(is_["month_first"], dated("month first", day(_int(m(3)), month(m(1)), _int(m(2)))))
        .when(is_["day"], dated("day", day(_int(p(1)), _int(p(3)), _int(p(4)))))
        .when(is_["numeric"], F.concat(dated("d/m/y", day(_int(n(4)), _int(n(3)), _int(n(1)))), dated("m/d/y", day(_int(n(4)), _int(n(1)), _int(n(3))))))
        .when(is_["epoch"], F.array(epoch("s", 1), epoch("ms", 1000), epoch("us", 1_000_000), epoch("ns", 1_000_000_000)))
    )
    valid = F.filter(F.coalesce(found, empty), lambda r: r["at"] >= F.lit(EARLIEST + " 00:00:00+00:00").cast("timestamp"))
    df = df.withColumn("_valid", valid)
    # one reading an instant, the first in the order above
    fresh = F.filter("_valid", lambda r, k: ~F.exists(F.slice("_valid", F.lit(1), k), lambda earlier: earlier["at"] == r["at"]))
    return df.select(*kept, F.when(F.size("_valid") > 1, fresh).otherwise(F.col("_valid")).alias("readings"))


def interpret(postings: DataFrame, boards: DataFrame, id_col: str = "posting_id", raw: str = "published_raw", order: str = "fetched_at", source: str = "source") -> DataFrame:
    """(id, source, order, readings) of every row. A board's zone is the one its snapshots name; where they differ, the greatest."""
    zones = boards.groupBy("board_id").agg(F.max("zone").alias("_zone"))
    rows = postings.select(F.col(id_col).alias("id"), F.col(source).alias("source"), F.col(order).alias("order"), F.col(raw).alias("_raw"), "board_id").join(zones, "board_id", "left")
    return with_readings(rows, "_raw", "_zone", known_zones(postings.sparkSession)).select("id", "source", "order", "readings")


def _steps(rows: pd.DataFrame) -> list[tuple[list[str], list[int]]]:
    return list(zip(rows["formats"].map(list), rows["ats"].map(list), strict=True))


def _transition(a: tuple, b: tuple) -> np.ndarray:
    """Costs from each reading of a to each of b."""
    switch = np.array([[x != y for y in b[0]] for x in a[0]], float)
    back = np.array([[y < x for y in b[1]] for x in a[1]], float)
    return SWITCH * switch + BACKWARD * back


def block_costs(steps: list[tuple]) -> np.ndarray:
    """Least cost from each reading of the first step to each of the last: min-plus products, so blocks compose exactly."""
    total = np.where(np.eye(len(steps[0][0]), dtype=bool), 0.0, np.inf)
    for a, b in zip(steps, steps[1:]):
        total = np.min(total[:, :, None] + _transition(a, b)[None, :, :], axis=1)
    return total


def best_path(steps: list[tuple], entry: int, exit_: int) -> list[int]:
    """The cheapest readings from entry of the first step to exit_ of the last; ties go to the earlier reading."""
    cost = np.full(len(steps[0][0]), np.inf)
    cost[entry] = 0
    came = []
    for a, b in zip(steps, steps[1:]):
        each = cost[:, None] + _transition(a, b)
        came.append(each.argmin(axis=0))
        cost = each.min(axis=0)
    path = [exit_]
    for step in reversed(came):
        path.append(int(step[path[-1]]))
    return path[::-1]


def chain_blocks(blocks: pd.DataFrame) -> pd.DataFrame:
    """Per source: the reading at which each block of its order is entered and left."""
    blocks = blocks.sort_values("block")
    reach, came = np.zeros(1), []
    for row in blocks.itertuples():
        costs = np.array(row.costs, float).reshape(row.entries, -1)
        if len(reach) != row.entries:  # the first block starts at its own first row
            reach = np.zeros(row.entries)
        each = reach[:, None] + costs
        came.append(each.argmin(axis=0))
        reach = each.min(axis=0)
    at, out = int(reach.argmin()), []
    for k in range(len(came) - 1, -1, -1):
        out.append((at, int(came[k][at])))
        at = int(came[k][at])
    out.reverse()
    return blocks.assign(entry=[e for _, e in out], leave=[x for x, _ in out])[["source", "block", "entry", "leave"]]


def choose(read: DataFrame, block: int = BLOCK) -> DataFrame:
    """(id, chosen): the index of the reading chosen for each row with more than one.

    The record order of a source is (order, id), a null source being one of its own. It is cut into blocks of equally
    many rows; a block's least costs between its ends are found in parallel, composed along the source, and each block
    then finds its own path, so the result is that of one pass, at any block size. Rows that have one reading and whose
    neighbours have one are left out beforehand: they add the same cost to every path.
    """
    rows = read.where(F.size("readings") > 0).select("id", F.coalesce("source", F.lit("")).alias("source"), "order", F.transform("readings", lambda r: r["format"]).alias("formats"), F.transform("readings", lambda r: F.unix_micros(r["at"])).alias("ats"))
    # shards are ranges of the order with about equally many rows each, so a bulk load within one moment is many of them
    rows = materialize(rows.repartitionByRange("source", "order", "id").withColumn("_range", F.spark_partition_id()), "ordered")
    rows = positions(rows, ["source"], F.col("_range"), ["order", "id"], "pos").drop("_range")
    rows = rows.withColumn("block", F.floor(F.col("pos") / block))
    # each block also holds the row before it, its entry
    halo = rows.where((F.col("pos") + 1) % block == 0).withColumn("block", F.col("block") + 1)
    inside = W.partitionBy("source", "block").orderBy("pos")
    many = F.size("formats") > 1
    near = many | F.coalesce(F.lag(many).over(inside), F.lit(True)) | F.coalesce(F.lead(many).over(inside), F.lit(True))
    kept = rows.unionByName(halo).withColumn("near", near).where("near").select("id", "source", "block", "pos", "formats", "ats")
    kept = materialize(kept, "readings")

    def costs(part: pd.DataFrame) -> pd.DataFrame:
        steps = _steps(part.sort_values("pos"))
        found = block_costs(steps)
        return pd.DataFrame([(part["source"].iloc[0], part["block"].iloc[0], found.ravel().tolist(), len(steps[0][0]))], columns=["source", "block", "costs", "entries"])

    ends = kept.groupBy("source", "block").applyInPandas(costs, "source string, block long, costs array<double>, entries int")
    ways = ends.groupBy("source").applyInPandas(chain_blocks, "source string, block long, entry int, leave int")

    def path(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos").reset_index(drop=True)
        picked = best_path(_steps(part), int(part["entry"].iloc[0]), int(part["leave"].iloc[0]))
        own = (part["pos"] // block == part["block"]) & (part["formats"].map(len) > 1)
        return part.assign(chosen=picked)[own][["id", "chosen"]]

    kind = dict(read.dtypes)["id"]
    return kept.join(ways, ["source", "block"]).groupBy("source", "block").applyInPandas(path, f"id {kind}, chosen int")


def normalise(postings: DataFrame, boards: DataFrame, block: int = BLOCK) -> DataFrame:
    """(posting_id, published_at, format, interpretations) of every row; published_at is null where no instant is named.

    Where several are, it is the one the Viterbi pass chooses. Repeated posting_ids are rows of their own.
    """
    read = materialize(interpret(postings, boards), "readings")
    if read.where(F.size("readings") > 1).isEmpty():
        read = read.withColumn("chosen", F.lit(0))
    else:
        picked = choose(read, block).groupBy("id").agg(F.min("chosen").alias("chosen"))
        read = read.join(picked, "id", "left")
    reading = F.get("readings", F.coalesce("chosen", F.lit(0)))
    return read.select(F.col("id").alias("posting_id"), reading["at"].alias("published_at"), reading["format"].alias("format"), F.size("readings").alias("interpretations"))


def instants_found(postings: DataFrame, boards: DataFrame) -> DataFrame:
    """(posting_id, published_utc) of rows that name exactly one instant."""
    one = normalise(postings, boards).where("interpretations = 1")
    return one.select("posting_id", F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("published_utc"))
