"""Texts over a limit cut into overlapping pieces at natural boundaries (problem 10).

Method: balanced targets. The least number of pieces gives equal-length targets, each target is snapped to the strongest
boundary near it, and a piece is added whenever a limit fails.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.tokens import VOCABULARY, encoding

LIMIT, OVERLAP = 2048, 64

#: (strength, pattern): a cut may fall at the end of a match.
BOUNDARIES = (
    (1, re.compile(r"\s+")),
    (2, re.compile(r"[,;:、，；：]+(?=\s)|[、，；]")),
    (3, re.compile(r"[.!?…]+[\"'”’»)\]]*(?=\s)|[。！？]+[」』”]*|<br\s*/?>|</(?:li|td|dd|dt)>", re.I)),
    (4, re.compile(r"[ \t]*\n(?=[^\n]|$)")),
    (5, re.compile(r"[ \t]*\n(?:[ \t]*\n)+|</(?:p|div|ul|ol|h[1-6]|table|section)>\s*", re.I)),
)


def strengths(text: str) -> np.ndarray:
    """For each character position, how natural a cut before it is: 0 inside a word, up to 5 at a paragraph's end."""
    out = np.zeros(len(text) + 1, np.int8)
    for strength, pattern in BOUNDARIES:
        for m in pattern.finditer(text):
            out[m.end()] = max(out[m.end()], strength)
            if strength in (1, 4) or (strength == 5 and text[m.start()] in " \t\n"):  # before white space is as good: tokens begin with it
                out[m.start()] = max(out[m.start()], strength)
    return out


def token_starts(text: str, ids: list[int], enc) -> np.ndarray:
    """For each token boundary its character position, -1 where it falls inside a character."""
    raw = np.frombuffer(text.encode(), np.uint8)
    ends = np.cumsum([0, *map(len, enc.decode_tokens_bytes(ids))])
    starts = np.append((raw & 0xC0) != 0x80, True)
    index = np.cumsum(np.append(0, starts[:-1].astype(np.int64)))
    return np.where(starts[ends], index[ends], -1)


def cut_points(total: int, strength: np.ndarray, limit: int, overlap: int, pieces: int, reach: float = 1 / 3) -> list[tuple[int, int]] | None:
    """[(first token, end token)] of pieces pieces, or None where a piece can't keep the limit. strength: -1 where no cut may be.

    A cut lies within reach of its target, in steps (the distance of targets).
    """
    step, out, start = (total - overlap) / pieces, [], 0
    for i in range(1, pieces):
        target = overlap + i * step
        low = max(start + overlap + 1, out[-1][1] + 1 if out else 1, int(target - step * reach), total - (pieces - i) * (limit - overlap))
        high = min(start + limit, int(target + step * reach), total - 1)
        if low > high:
            return None
        near = np.arange(low, high + 1)
        score = strength[low : high + 1] * 10.0 - np.abs(near - target) / step
        best = int(np.argmax(np.where(strength[low : high + 1] >= 0, score, -np.inf)))
        if strength[low + best] < 0:
            return None
        out.append((start, low + best))
        start = low + best - overlap
        while start > 0 and strength[start] < 0:
            start -= 1
        if start <= out[-1][0]:
            return None
    out.append((start, total))
    return out if total - start <= limit else None


def any_cuts(text: str, at: np.ndarray, enc, limit: int, overlap: int) -> list[tuple[int, int, int]]:
    """Pieces cut at the last token boundary that holds the limit and starts a character: what remains where targets can't be held.

    Pieces share overlap tokens or the nearest fewer that let the next one go on. A single character of over limit tokens
    is a piece of its own.
    """
    stops = np.flatnonzero(at >= 0)  # tokens that start a character
    out, start = [], 0
    while True:
        a = int(at[start])
        later = stops[stops > start]
        n = int(np.searchsorted(later, start + limit, "right"))
        for k in range(max(n, 1), 0, -1):
            end = int(later[k - 1])
            size = len(enc.encode_ordinary(text[a : int(at[end])]))
            if size <= limit:
                break
        out.append((a, int(at[end]), size))
        if end == len(at) - 1:
            return out
        back = stops[(stops > start) & (stops >= end - overlap) & (stops <= end)]
        start = int(back[0])


def split_text(text: str, enc, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """[(start, end, tokens)] in characters; one piece for a text within the limit.

    From the least number of pieces on, the first number is taken whose cuts are all at the end of a clause or better;
    where none of the first four that hold is, the one with the strongest weakest cut. If that cut is inside a word, cuts
    are looked for as far from their targets as the limit allows. Each piece is encoded anew to hold the limit. Where no
    number of pieces up to twice the least and eight holds it, any_cuts() does.
    """
    if not 0 <= overlap < limit:
        raise ValueError(f"an overlap of {overlap} does not leave room in pieces of {limit}")
    ids = enc.encode_ordinary(text)
    total = len(ids)
    if total <= limit:
        return [(0, len(text), total)]
    at = token_starts(text, ids, enc)
    strength = np.where(at >= 0, strengths(text)[np.maximum(at, 0)], -1)
    least = max(2, -(-(total - overlap) // (limit - overlap)))
    best = None
    for reach in (1 / 3, 2.0):
        tried = 0
        for pieces in range(least, 2 * least + 9):
            cuts = cut_points(total, strength, limit, overlap, pieces, reach)
            if not cuts:
                continue
            spans = [(int(at[a]), int(at[b])) for a, b in cuts]
            sizes = [len(enc.encode_ordinary(text[a:b])) for a, b in spans]
            if max(sizes) <= limit:
                weakest = min(int(strength[b]) for _, b in cuts[:-1])
                if best is None or weakest > best[0]:
                    best = (weakest, [(a, b, n) for (a, b), n in zip(spans, sizes, strict=True)])
                if weakest >= 2:
                    break
            tried += 1
            if tried >= 4 and best:
                break
        if best and best[0] > 0:
            break
    return best[1] if best else any_cuts(text, at, enc, limit, overlap)


def split_long(docs: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, pieces, start, end, n_tokens, text) for each text of over limit tokens; other texts have no row.

    Consecutive pieces share overlap tokens (of the whole text's encoding; more only where a token boundary lies inside a
    character). start and end count characters; text is docs.text[start:end]. Null and empty texts have no row, repeated
    rows repeat their pieces. A byte-level vocabulary has at most one token a byte, so shorter texts never reach Python.
    """
    long = docs.select("doc_id", "text").where(F.octet_length("text") > limit)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                found = split_text(text, enc, limit, overlap)
                if len(found) > 1:
                    rows += [(doc_id, i, len(found), a, b, n, text[a:b]) for i, (a, b, n) in enumerate(found)]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "pieces", "start", "end", "n_tokens", "text"])

    kind = dict(docs.dtypes)["doc_id"]
    return long.mapInPandas(run, f"doc_id {kind}, piece int, pieces int, start int, end int, n_tokens int, text string")
