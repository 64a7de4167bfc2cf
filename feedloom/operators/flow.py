"""Whole flows over layers: polling with every board's own status, the plan of what to show, backfill, facts read anew, events."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from feedloom.operators import chain, grouping, stores
from feedloom.session import materialize
from feedloom.sources.fetching import Passing, Refused


# ---- polling

@dataclass(frozen=True)
class Poll:
    """What came of one board: its status and, where it answered, its payloads."""

    board_id: str
    status: str
    detail: str = ""
    payloads: tuple = ()


def poll(boards: Sequence[str], fetch: Callable[[str], Sequence], skip: Sequence[str] = ()) -> list[Poll]:
    """Each board on its own: one that fails costs no other. fetch gives a board's payloads.

    ok; skipped; 'failed' for a passing error; 'unparseable' for a payload that is no JSON; 'error' for anything else; and
    'not reached' for all boards after the budget is used up. boards is configuration, so this loop is the driver's.
    """
    out, spent = [], ""
    for board in boards:
        if board in skip:
            out.append(Poll(board, "skipped"))
        elif spent:
            out.append(Poll(board, "not reached", spent))
        else:
            try:
                out.append(Poll(board, "ok", payloads=tuple(fetch(board))))
            except Refused as error:
                spent = str(error) if "budget" in str(error) else ""
                out.append(Poll(board, "not reached" if spent else "failed", str(error)))
            except Passing as error:
                out.append(Poll(board, "failed", str(error)))
            except ValueError as error:
                out.append(Poll(board, "unparseable", str(error)))
            except Exception as error:  # noqa: BLE001 whatever a board raises is that board's
                out.append(Poll(board, "error", f"{type(error).__name__}: {error}"))
    return out


def age_floor(now: Column, days: int, unconfirmed: Column | None = None) -> Column:
    """The date before which nothing need be read: days and a second before now; null where dates are not to be trusted."""
    floor = now - F.make_dt_interval(days=F.lit(days), secs=F.lit(1))
    return floor if unconfirmed is None else F.when(~F.coalesce(unconfirmed, F.lit(False)), floor)


# ---- plan and backfill

def group_key() -> Column:
    """The key under which grouping.groups() collapses a row."""
    return grouping.dedupe_key(F.col("employer"), F.col("board_id"), F.col("title_normalised"), F.col("published_at"))


def plan(rows: DataFrame, rules: Sequence[chain.Rule], held: Sequence[str] = (), stored: DataFrame | None = None, closed: DataFrame | None = None, shown: DataFrame | None = None, fields: Sequence[str] = ("title", "location", "url"), withhold: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(groups to send, (stage, n) of every stage): from stored rows to what a target lacks.

    Rows of held sources, then of withheld ones, are left out; the chain admits rows; they are grouped; groups any of whose
    members is in stored (identity) and groups in closed (group_key) are left out; the rest is compared with shown
    (identity, fields) by its representative: state is new, changed or unchanged, and unchanged ones are not sent.
    """
    none = lambda columns: rows.sparkSession.createDataFrame([], columns)
    source = F.coalesce("source", F.lit(""))
    marked = rows.withColumn("_out", F.when(source.isin(*held), "held").when(source.isin(*withhold), "withheld"))
    judged = materialize(chain.judged(marked, rules).withColumn("_key", group_key()), "judged")
    admitted = judged.where("_out is null and drop_rule is null")
    groups = materialize(grouping.groups(admitted), "groups")
    taken = (stored if stored is not None else none("identity string")).select("identity").distinct()
    skipped = admitted.join(taken, "identity", "left_semi").select(F.col("_key").alias("group_key")).distinct()
    retired = (closed if closed is not None else none("group_key string")).select("group_key").distinct()
    state = groups.join(skipped.withColumn("_s", F.lit(True)), "group_key", "left").join(retired.withColumn("_r", F.lit(True)), "group_key", "left")
    state = state.withColumn("state", F.when(F.col("_s"), "skipped by store").when(F.col("_r"), "retired")).drop("_s", "_r")
    lead = admitted.select(F.col("identity").alias("representative"), *fields).dropDuplicates(["representative"])
    open_ = state.where("state is null").drop("state").join(lead, "representative")
    target = shown if shown is not None else none(", ".join(["identity string", *[f"`{f}` string" for f in fields]]))
    differs = stores.differs(open_.select(F.col("representative").alias("identity"), *fields), target, "identity", list(fields)).select(F.col("identity").alias("representative"), "state")
    told = materialize(state.where("state is not null").select("group_key", "representative", "state").unionByName(open_.join(differs, "representative").select("group_key", "representative", "state")), "plan")
    first = judged.agg(
        F.count("*").alias("rows"), F.count_if(F.col("_out") == "held").alias("rows held"), F.count_if(F.col("_out") == "withheld").alias("rows withheld"),
        F.count_if(F.col("_out").isNull() & F.col("drop_rule").isNull()).alias("rows admitted"),
    )
    then = told.agg(F.count("*").alias("groups"), *[F.count_if(F.col("state") == s).alias(f"groups {s}") for s in ("skipped by store", "retired", "new", "changed", "unchanged")])
    counted = lambda df: df.unpivot([], df.columns, "stage", "n")
    return told.where("state in ('new', 'changed')"), counted(first).unionByName(counted(then))


def backfill(layer: DataFrame, facts: DataFrame | None, derived: Sequence[str], rules: Sequence[chain.Rule], held: DataFrame, publishable: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows to append, (step, n)): rows of a layer that today's rules admit and the filtered layer (held) lacks.

    facts overlays derived columns beforehand. Running it again after the append gives no rows. publishable leaves the rest out.
    """
    rows = layer if facts is None else stores.overlay(layer, facts, "identity", list(derived))
    judged = materialize(chain.judged(rows, rules), "judged")
    admitted = judged.where("drop_rule is null").drop("drop_rule", "drop_detail")
    if publishable is not None:
        admitted = admitted.where(publishable)
    gap = stores.delta(admitted, held, "identity")
    counts = [("read", judged), ("admitted", admitted), ("to append", gap)]
    told = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("step"), "n") for name, df in counts]
    return gap, told[0].unionByName(told[1]).unionByName(told[2])


# ---- facts

def fingerprint_of(*parts: object) -> str:
    """Sixteen hex digits that change with any of parts (code versions, configuration): facts under another one are read anew."""
    import hashlib

    return hashlib.sha256(repr(parts).encode()).hexdigest()[:16]


def reread(raw: DataFrame, derive: Callable[[DataFrame], DataFrame], stored: DataFrame, fingerprint: str, position: Sequence[str] = ("row_id",)) -> DataFrame:
    """The facts overlay under fingerprint: stored facts that carry it, else read from raw, the first occurrence of an identity counting.

    stored: identity, the derived columns, fingerprint. Facts of identities that raw no longer holds stay as they are.
    """
    first = raw.withColumn("_rn", F.row_number().over(W.partitionBy("identity").orderBy(*position))).where("_rn = 1").drop("_rn")
    current = stored.where(F.col("fingerprint") == fingerprint)
    anew = derive(first.join(current.select("identity"), "identity", "left_anti")).withColumn("fingerprint", F.lit(fingerprint))
    kept = stored.join(anew.select("identity"), "identity", "left_anti")
    return kept.unionByName(anew.select(*stored.columns))


# ---- stores of parts

def merged_parts(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """One row a key from parts in order of precedence: the last part that holds it wins."""
    ranked = [p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)]
    every = ranked[0]
    for p in ranked[1:]:
        every = every.unionByName(p)
    columns = [c for c in parts[0].columns if c != key]
    one = every.groupBy(key).agg(F.max_by(F.struct(*columns), "_part").alias("_r"))
    return one.select(key, *[F.col(f"_r.`{c}`").alias(c) for c in columns])


def verified(written: DataFrame, read_back: DataFrame, key: str) -> DataFrame:
    """(key): what was written and reads back with the same content; only this may be marked as saved."""
    digest = lambda df: df.select(key, F.xxhash64(*[c for c in sorted(df.columns) if c != key]).alias("digest"))
    return digest(written).join(digest(read_back), [key, "digest"], "left_semi").select(key).distinct()


def mark_saved(seen: DataFrame, saved: DataFrame, now: Column) -> DataFrame:
    """seen with full_saved_at set to now for the identities of saved that have none yet."""
    told = seen.join(saved.select("identity").distinct().withColumn("_saved", F.lit(True)), "identity", "left")
    return told.withColumn("full_saved_at", F.when(F.col("full_saved_at").isNull() & F.col("_saved"), now).otherwise(F.col("full_saved_at"))).drop("_saved")


def older_than(value: Column, days: int, now: Column) -> Column:
    """Whether a time is known and at least days before now."""
    return F.coalesce(value <= now - F.make_dt_interval(days=F.lit(days)), F.lit(False))


# ---- events

EVENT = ("key", "at", "source", "subject", "status", "detail")


def events(*kinds: tuple[DataFrame, Column, Column, Column, Column, Column, Column]) -> DataFrame:
    """(key, at, source, subject, status, detail): one frame of all kinds of events. A kind is a frame and its six columns."""
    out = None
    for df, *columns in kinds:
        part = df.select(*[c.alias(n) for c, n in zip(columns, EVENT, strict=True)])
        out = part if out is None else out.unionByName(part)
    return out
