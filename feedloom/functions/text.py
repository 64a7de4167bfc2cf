"""String functions on Columns; all of them stay in the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Marks and characters without width: they never tell two texts apart.
_INVISIBLE = r"[\p{M}­​-‏ -‮⁠-⁤﻿]"


def _compat_table() -> tuple[str, str]:
    """Latin letters with marks and full-width signs, each with the one ASCII character it decomposes to."""
    pairs = {}
    for code in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00), 0x3000, *range(0xFF01, 0xFF5F)):
        base = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(x))
        if len(base) == 1 and base.isascii() and base != chr(code):
            pairs[chr(code)] = base
    return "".join(pairs), "".join(pairs.values())


_FROM, _TO = _compat_table()


def squeeze(c: Column) -> Column:
    """Trim, and make each run of white space one blank. Null stays null."""
    return F.trim(F.regexp_replace(c, r"[\s 　]+", " "))


def strip_marks(c: Column) -> Column:
    """Without combining marks, invisible characters, and marks of Latin letters. Texts of one-byte characters have none."""
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(F.translate(F.regexp_replace(c, _INVISIBLE, ""), _FROM, _TO))


def plain(c: Column) -> Column:
    """Lower case, no marks, single blanks: the form in which spellings are compared."""
    return squeeze(F.lower(strip_marks(c)))


def fold(c: Column) -> Column:
    """Comparison form of a name or title: plain(), dashes, underscores and slashes as blanks, ',().:' deleted. Null gives ''."""
    return F.coalesce(squeeze(F.regexp_replace(F.regexp_replace(plain(c), r"[-‐-—_/]", " "), r"[\[\],().:]", "")), F.lit(""))


def words(c: Column) -> Column:
    """Runs of letters and digits of plain(c), in order."""
    return F.filter(F.split(plain(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def near(a: Column, b: Column) -> Column:
    """At most one insertion, deletion, substitution or swap of neighbours apart."""
    distance = F.levenshtein(a, b, 2)
    # two substitutions that keep the letters: a swap of neighbours shows as one differing pair
    i = F.length(F.regexp_extract(F.concat(a, F.lit("\u0001"), b), r"^(.*).*\x01\1", 1))
    swapped = F.concat(F.substring(a, F.lit(1), i), F.substring(a, i + 2, F.lit(1)), F.substring(a, i + 1, F.lit(1)), F.substring(a, i + 3, F.length(a)))
    return F.when(distance == -1, F.lit(False)).when(distance <= 1, F.lit(True)).otherwise((F.length(a) == F.length(b)) & (swapped == b))


def ngrams(c: Column, n: int = 2) -> Column:
    """The character n-grams of '^' + c + '$', repeats included. Shorter texts give one gram."""
    padded = F.concat(F.lit("^"), c, F.lit("$"))
    count = F.greatest(F.length(padded) - F.lit(n - 1), F.lit(1))
    return F.transform(F.sequence(F.lit(1), count), lambda i: F.substring(padded, i, F.lit(n)))


def strip_location_suffix(title: Column, location: Column) -> Column:
    """title without a final ' - ' + location."""
    tail = F.concat(F.lit(" - "), F.trim(location))
    cut = F.trim(F.substring(title, F.lit(1), F.length(title) - F.length(tail)))
    return F.when((F.trim(location) != "") & F.endswith(title, tail), cut).otherwise(title)


#: Named title normalisers, (title, location) -> title, by which a board's configuration says how its titles are read.
NORMALISERS = {"strip_location": strip_location_suffix}


def register_normaliser(name: str, build) -> None:
    """Make a normaliser known by name; a name taken twice is refused."""
    if name in NORMALISERS:
        raise ValueError(f"normaliser {name!r} is registered already")
    NORMALISERS[name] = build


def unknown_normalisers(names: Column) -> Column:
    """Those of names that nothing is registered under; a configuration that has any is refused."""
    return F.filter(names, lambda n: ~n.isin(*NORMALISERS))


def normalised(title: Column, location: Column, names: Column) -> Column:
    """title after each registered normaliser that names holds, in the order of registration. Null names change nothing."""
    for name, build in NORMALISERS.items():
        title = F.when(F.coalesce(F.array_contains(names, F.lit(name)), F.lit(False)), build(title, location)).otherwise(title)
    return title
