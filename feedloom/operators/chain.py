"""An ordered chain of named rules: each row keeps the first rule that drops it and why, in one column and one pass."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """name; drops: a boolean Column, null counting as 'keep'; detail: text Column shown with a drop."""

    name: str
    drops: Column
    detail: Column | None = None
    once: dict[str, Column] = field(default_factory=dict)  # columns that drops reads, worked out once a row


_REGISTRY: dict[str, Callable[..., Rule]] = {}


def register_rule(name: str) -> Callable[[Callable[..., Rule]], Callable[..., Rule]]:
    """Make a rule builder available to rule() by name; a name taken twice is refused."""

    def add(builder: Callable[..., Rule]) -> Callable[..., Rule]:
        if name in _REGISTRY:
            raise ValueError(f"rule {name!r} is registered already")
        _REGISTRY[name] = builder
        return builder

    return add


def rule(kind: str, /, **options: object) -> Rule:
    """The rule registered under kind, built with options."""
    if kind not in _REGISTRY:
        raise ValueError(f"no rule {kind!r}; known: {', '.join(sorted(_REGISTRY))}")
    return _REGISTRY[kind](**options)


def judged(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """df with drop_rule and drop_detail, null on kept rows. Later rules are not evaluated for a dropped row.

    What rules share (Rule.once) is a projection of its own below, so it is worked out once a row and not in every branch.
    """
    once = {name: c for r in rules for name, c in r.once.items()}
    columns = df.columns
    df = df.withColumns(once) if once else df
    verdict = F.coalesce(*[F.when(r.drops, F.struct(F.lit(r.name).alias("rule"), (F.lit(None) if r.detail is None else r.detail).cast("string").alias("detail"))) for r in rules])
    return df.withColumn("_verdict", verdict).withColumn("drop_rule", F.col("_verdict.rule")).withColumn("drop_detail", F.col("_verdict.detail")).select(*[F.col(f"`{c}`") for c in columns], "drop_rule", "drop_detail")


def drop_counts(judged_rows: DataFrame, rules: Sequence[Rule], *by: str) -> DataFrame:
    """(by.., drop_rule, n_dropped); without by every rule has a row, zero where it dropped none."""
    counts = judged_rows.where("drop_rule is not null").groupBy(*by, "drop_rule").agg(F.count("*").alias("n_dropped"))
    if by:
        return counts
    named = judged_rows.sparkSession.createDataFrame([(r.name,) for r in rules], "drop_rule string")
    return named.join(counts, "drop_rule", "left").select("drop_rule", F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"))


def term_pattern(term: str) -> str:
    """A whole-word pattern of a term and its plural; words end where no letter, digit or underscore follows, in any script."""
    return rf"(^|[^\p{{L}}\p{{N}}_]){re.escape(term).replace(chr(92) + ' ', ' ')}(?:e?s)?([^\p{{L}}\p{{N}}_]|$)"


def first_term(text: Column, terms: Sequence[str]) -> Column:
    """The first of terms, in their order, that text holds as a whole word; null for none. Text is searched for the term itself before its pattern is tried."""
    return F.coalesce(*[F.when(F.contains(text, F.lit(t)) & F.rlike(text, F.lit(term_pattern(t))), F.lit(t)) for t in terms])


def all_terms(text: Column, terms: Sequence[str]) -> Column:
    """All of terms that text holds, in their order."""
    return F.array_compact(F.array(*[F.when(F.contains(text, F.lit(t)) & F.rlike(text, F.lit(term_pattern(t))), F.lit(t)) for t in terms]))


def reason(rule_name: Column, detail: Column, words: dict[str, str]) -> Column:
    """A drop in words: the text of its rule with the detail in place of %s; null for a rule without text."""
    said = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, text in words.items():
        said = said.when(rule_name == name, F.format_string(text, detail))
    return said


def family_of(term: Column, families: dict[str, str]) -> Column:
    """The family of a term; null for terms of none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in families.items() for x in kv]), term)


def named_places(phrases: Column, names: dict[str, str]) -> Column:
    """The configured names of phrases, each once, in the order of configuration; unknown phrases give none."""
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    got = F.transform(F.coalesce(phrases, F.array().cast("array<string>")), lambda p: F.try_element_at(table, F.lower(F.trim(p))))
    return F.filter(F.array(*[F.lit(n) for n in dict.fromkeys(names.values())]), lambda n: F.coalesce(F.array_contains(got, n), F.lit(False)))


@register_rule("expiry")
def expiry(now: str) -> Rule:
    """Rows whose expires_at, as text, is before now; empty and null ones stay."""
    return Rule("expiry", (F.col("expires_at") != "") & (F.col("expires_at") < now), F.col("expires_at"))


@register_rule("terms")
def terms(column: Column, wanted: Sequence[str], name: str = "terms") -> Rule:
    """Rows whose text holds none of the wanted terms."""
    held = f"_text_{id(column)}"  # rules on one column share it
    return Rule(name, first_term(F.coalesce(held, F.lit("")), wanted).isNull(), F.col(held), {held: column})


@register_rule("excluded")
def excluded(column: Column, words: Sequence[str], name: str = "excluded") -> Rule:
    """Rows whose text holds one of words."""
    held = f"_text_{id(column)}"
    return Rule(name, first_term(F.col(held), words).isNotNull(), first_term(F.col(held), words), {held: column})


@register_rule("all_in")
def all_in(column: Column, values: Sequence[str], name: str = "all_in") -> Rule:
    """Rows with at least one non-blank item all of whose non-blank items, folded, are among values."""
    from feedloom.functions.text import fold

    items = F.filter(F.transform(column, fold), lambda x: x != "")
    return Rule(name, (F.size(items) > 0) & F.forall(items, lambda x: x.isin(*values)), F.array_join(column, ", "))


@register_rule("above")
def above(column: Column, limit: int, name: str = "above") -> Rule:
    """Rows any of whose numbers is above limit."""
    return Rule(name, F.array_max(column) > limit, F.array_max(column))


@register_rule("older")
def older(first: Column, dated: Column, days: int, skip: Column | None = None, name: str = "older") -> Rule:
    """Rows whose date lies more than days before first, to the microsecond; undated rows and those to skip stay."""
    drops = F.unix_micros(first) - F.unix_micros(dated) > days * 86_400_000_000
    return Rule(name, drops if skip is None else drops & ~F.coalesce(skip, F.lit(False)), F.date_format(dated, "yyyy-MM-dd"))
