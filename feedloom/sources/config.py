"""Configuration files, read on the driver and validated as a whole: one bad entry refuses the file."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

BOARDS = "board_id string, platform string, slug string, employer_alias string, zone string, poll_slots array<string>, deep_slots array<string>, normalisations array<string>"
_SLOT = re.compile(r"([01]\d|2[0-3]):[0-5]\d")


class ConfigError(ValueError):
    """All that is wrong with a file, one line a fault."""


def _texts(entry: dict, name: str, faults: list[str], where: str) -> list[str]:
    value = entry.get(name) or []
    if not isinstance(value, list) or not all(isinstance(x, str) for x in value):
        faults.append(f"{where}: {name} is no list of texts")
        return []
    return value


def board_faults(entries: object, platforms: Sequence[str]) -> tuple[list[tuple], list[str]]:
    """(rows of the boards table, faults)."""
    rows, faults, seen = [], [], set()
    if not isinstance(entries, list):
        return [], ["the file holds no list"]
    for n, entry in enumerate(entries):
        where = f"entry {n}"
        if not isinstance(entry, dict):
            faults.append(f"{where}: no object")
            continue
        platform, slug = entry.get("platform"), entry.get("slug")
        if platform not in platforms:
            faults.append(f"{where}: unknown platform {platform!r}")
        if not isinstance(slug, str) or not slug.strip():
            faults.append(f"{where}: no slug")
        board = f"{platform}:{slug}"
        if board in seen:
            faults.append(f"{where}: {board} is listed twice")
        seen.add(board)
        lists = [_texts(entry, name, faults, where) for name in ("poll_slots", "deep_slots", "normalisations")]
        faults += [f"{where}: {slot!r} is no time of day" for slot in (*lists[0], *lists[1]) if not _SLOT.fullmatch(slot)]
        if set(lists[1]) - set(lists[0]):
            faults.append(f"{where}: a deep slot that is not polled")
        rows.append((board, platform, slug, entry.get("employer_alias"), entry.get("zone"), *lists))
    return rows, faults


def load_boards(spark: SparkSession, path: str, platforms: Sequence[str]) -> DataFrame:
    """The boards of a JSON file as a table; ConfigError names every fault."""
    rows, faults = board_faults(json.loads(Path(path).read_text()), platforms)
    if faults:
        raise ConfigError("\n".join(faults))
    return spark.createDataFrame(rows, BOARDS)


def load_terms(path: str, exempt: Sequence[str] = ()) -> list[tuple[int, str, str]]:
    """[(order, term, family)] of a Markdown file: headings are families, list items are terms, lower case.

    A term of one word is refused unless exempt, since it would match too much; so is a term listed twice.
    """
    out, family, faults = [], None, []
    for number, line in enumerate(Path(path).read_text().splitlines(), 1):
        if head := re.match(r"#+\s+(.*\S)", line):
            family = head[1]
        elif item := re.match(r"\s*[-*]\s+(.*\S)", line):
            term = " ".join(item[1].lower().split())
            if family is None:
                faults.append(f"line {number}: a term before any heading")
            if " " not in term and term not in exempt:
                faults.append(f"line {number}: {term!r} is one word")
            if term in {t for _, t, _ in out}:
                faults.append(f"line {number}: {term!r} is listed twice")
            out.append((len(out), term, family))
    if faults:
        raise ConfigError("\n".join(faults))
    return out


def boards_due(boards: DataFrame, slot: str) -> DataFrame:
    """Boards to poll at slot, with deep: whether to walk them whole. Boards without slots are always due."""
    from pyspark.sql import functions as F

    has = lambda c: F.coalesce(F.array_contains(c, F.lit(slot)), F.lit(False))
    free = F.coalesce(F.size("poll_slots"), F.lit(0)) <= 0
    return boards.where(free | has("poll_slots")).withColumn("deep", has("deep_slots"))


def without_alias(boards: DataFrame) -> DataFrame:
    """(board_id): boards that name no employer to fall back on."""
    from pyspark.sql import functions as F

    named = F.max(F.nullif(F.trim("employer_alias"), F.lit("")))
    return boards.groupBy("board_id").agg(named.alias("_alias")).where("_alias is null").select("board_id")


def load_env(path: str) -> dict[str, str]:
    """The NAME=value lines of a file: blank lines and # comments left out, 'export ' and matching quotes taken off; ConfigError for any other line."""
    out, faults = {}, []
    for number, line in enumerate(Path(path).read_text().splitlines(), 1):
        bare = line.strip().removeprefix("export ").strip()
        if not bare or bare.startswith("#"):
            continue
        name, sign, value = bare.partition("=")
        if not sign or not name.strip().isidentifier():
            faults.append(f"line {number}: no NAME=value")
            continue
        value = value.strip()
        out[name.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value
    if faults:
        raise ConfigError("\n".join(faults))
    return out


def missing_names(env: dict[str, str], needed: Sequence[str]) -> list[str]:
    """Those of needed that env lacks or leaves blank."""
    return [name for name in needed if not env.get(name, "").strip()]
