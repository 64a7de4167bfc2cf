"""Packing, mixing and splitting."""

import random

import numpy as np
from pyspark.sql import functions as F

from feedloom.llm import mixing, packing, splitting, tokens

WORDS = "the quick brown fox jumps over a lazy dog while rain falls on old stone roofs".split()


def prose(rng, n):
    out = []
    while len(out) < n:
        out += [" ".join(rng.choices(WORDS, k=9)).capitalize() + rng.choice([".", "!", ".\n", ".\n\n"])]
        n -= 8
    return " ".join(out)


def docs(spark, texts, sources=None):
    sources = sources or ["s"] * len(texts)
    return spark.createDataFrame([(i, t, s, -1, "x") for i, (t, s) in enumerate(zip(texts, sources, strict=True))], "doc_id long, text string, source string, n_tokens long, container_id string")


def test_counts_whole_texts(spark):
    enc = tokens.encoding()
    texts = ["", None, " ", "héllo wörld 日本語", "a" * 30_000]
    got = [r["n"] for r in docs(spark, texts).select("doc_id", tokens.token_count(F.col("text")).alias("n")).orderBy("doc_id").collect()]
    assert got == [len(enc.encode_ordinary(t)) if t else 0 for t in texts]


def test_packing(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices(WORDS, k=rng.choice([2, 5, 20, 40, 60, 90, 150]))) for _ in range(400)] + ["", None, " ".join(WORDS * 30)]
    df = docs(spark, texts)
    capacity = 200
    packed = packing.pack(df, capacity, groups=6, shard=100)
    got = packed.toPandas()
    enc = tokens.encoding()
    size = {i: len(enc.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)}
    assert got.groupby("doc_id").n_tokens.sum().to_dict() == size  # nothing lost, nothing doubled
    assert got.groupby("container_id").n_tokens.sum().max() <= capacity
    assert set(got[got.pieces > 1].doc_id) == {i for i, n in size.items() if n > capacity} == {r[0] for r in packing.oversized(packed).collect()}
    assert got.container_id.notna().all()
    least = -(-sum(size.values()) // capacity)
    assert got.container_id.nunique() <= 1.12 * least + 5
    for one in got[got.pieces > 1].groupby("doc_id"):
        assert (one[1].sort_values("piece").start_token.to_numpy() == np.arange(len(one[1])) * capacity).all()
    assert packing.pack(df.limit(0), capacity).count() == 0
    assert packing.pack(df.unionByName(df), capacity).count() == 2 * len(got)


def test_configurations_hold_the_demand():
    rng = random.Random(1)
    for _ in range(20):
        sizes = sorted(rng.sample(range(130, 990), 8), reverse=True)
        demand = [rng.randint(1, 60) for _ in sizes]
        plan = packing.configurations(sizes, demand, 1000)
        held = sum(p * n for p, n in plan)
        assert (held >= demand).all() and all(p @ np.array(sizes) <= 1000 for p, _ in plan)
        assert sum(n for _, n in plan) <= 1.25 * np.dot(sizes, demand) / 1000 + len(sizes) or min(sizes) > 500 or sum(n for _, n in plan) <= sum(demand)


def test_best_pattern_is_the_knapsack_optimum():
    rng = random.Random(2)
    for _ in range(30):
        sizes = sorted(rng.sample(range(20, 60), 4))
        worth = np.array([rng.random() for _ in sizes])
        best = [0.0] * 121
        for c in range(121):
            best[c] = max([best[c - s] + w for s, w in zip(sizes, worth, strict=True) if s <= c], default=0.0)
        gain, counts = packing._best_pattern(sizes, worth, 120)
        assert abs(gain - best[120]) < 1e-9 and counts @ np.array(sizes) <= 120


def test_best_fit():
    assert packing.best_fit([5, 3, 2, 9], [(5, "a"), (4, "b")], 10, "n") == ["a", "b", "n-0", "n-1"]


def test_mix(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choices(WORDS, k=30)) for _ in range(600)] + [None, ""]
    sources = ["Big"] * 200 + [" big "] * 200 + ["small"] * 20 + ["other"] * 180 + [None, "small"]
    targets = spark.createDataFrame([("big", 0.5, 2), ("small", 0.3, 3), ("absent", 0.2, 1), ("zero", 0.0, 1)], "source string, target_share double, max_repeats int")
    mixed, report = mixing.mix(docs(spark, texts, sources), targets, fit=False)
    got, told = mixed.toPandas(), report.toPandas().set_index("source")
    assert got.groupby(["doc_id", "source"]).size().max() <= 3 and got[got.source == "big"].groupby("doc_id").size().max() <= 2
    assert set(told[told.short].index) == {"small", "absent"}
    assert abs(told.share_of_goal["big"] - 0.5) < 0.02 and told.tokens_mixed["small"] == 3 * told.tokens["small"]
    assert told.tokens_mixed.to_dict() == {**dict.fromkeys(told.index, 0), **got.groupby("source").n_tokens.sum().to_dict()}
    # any stretch of the mix has about its share: the schedule is even, not blocked
    half = got[got.slot < got.slot.max() / 2]
    assert abs(half[half.source == "big"].n_tokens.sum() / got[got.source == "big"].n_tokens.sum() - 0.5) < 0.05
    again = mixing.mix(docs(spark, texts, sources), targets, fit=False)[0].toPandas()
    assert sorted(again.itertuples(index=False, name=None)) == sorted(got.itertuples(index=False, name=None))
    assert mixing.mix(docs(spark, texts, sources).limit(0), targets)[0].count() == 0
    assert mixing.mix(docs(spark, texts, sources), targets.limit(0))[1].count() == 0


def check_pieces(text, pieces, limit, overlap, enc):
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for a, b, n in pieces:
        assert n == len(enc.encode_ordinary(text[a:b])) <= limit
    for (_, end, _), (start, *_) in zip(pieces, pieces[1:]):
        assert start < end
        shared = len(enc.encode_ordinary(text[start:end]))
        assert abs(shared - overlap) <= 4  # a cut may change how the edge of the shared stretch is encoded


def test_splitting():
    enc = tokens.encoding()
    rng = random.Random(9)
    for text in (prose(rng, 900), prose(rng, 4000), "日本語の長い文章です。" * 400, "x" * 9000, "".join(rng.choices("abcdefg", k=6000)), "word " * 1500, "- item one two three\n" * 300, "🚀🎉" * 900):
        pieces = splitting.split_text(text, enc, 256, 16)
        check_pieces(text, pieces, 256, 16, enc)
    assert splitting.split_text("short", enc) == [(0, 5, 1)] or len(splitting.split_text("short", enc)) == 1
    text = prose(rng, 3000)
    strength = splitting.strengths(text)
    assert min(strength[b] for _, b, _ in splitting.split_text(text, enc, 256, 16)[:-1]) >= 3  # sentences end often enough


def test_split_table(spark):
    rng = random.Random(11)
    texts = ["", None, "short", prose(rng, 4000), " " * 40_000]
    got = splitting.split_long(docs(spark, texts)).toPandas()
    enc = tokens.encoding()
    assert set(got.doc_id) == {i for i, t in enumerate(texts) if t and len(enc.encode_ordinary(t)) > splitting.LIMIT}
    for i, part in got.groupby("doc_id"):
        part = part.sort_values("piece")
        assert list(part.text) == [texts[i][a:b] for a, b in zip(part.start, part.end, strict=True)]
        assert part.pieces.nunique() == 1 and len(part) == part.pieces.iloc[0]
    assert splitting.split_long(docs(spark, texts).limit(0)).count() == 0


def test_splitting_always_ends():
    """Small limits on code points of several tokens, where a balanced cut may not exist."""
    import pytest

    enc = tokens.encoding()
    rng = random.Random(4)
    text = "".join(chr(rng.randrange(0x1D000, 0x1D7FF)) for _ in range(60)) + "ab cd"
    for limit in range(1, 12):
        for overlap in range(limit):
            pieces = splitting.split_text(text, enc, limit, overlap)
            assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
            for (a, b, n), (c, d, _) in zip(pieces, [*pieces[1:], (len(text), 0, 0)]):
                assert a < c <= b and n == len(enc.encode_ordinary(text[a:b])) and (n <= limit or b == a + 1)
    for overlap in (4, 5, -1):
        with pytest.raises(ValueError):
            splitting.split_text(text, enc, 4, overlap)


def test_the_only_natural_cut_is_found_however_far():
    enc = tokens.encoding()
    text = "lorem " * 60 + "x" * 900
    limit = len(enc.encode_ordinary("x" * 900)) + 8
    pieces = splitting.split_text(text, enc, limit, 2)
    strength = splitting.strengths(text)
    assert len(pieces) == 2 and strength[pieces[0][1]] > 0


def test_a_scarce_source_sizes_the_mix(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choices(WORDS, k=30)) for _ in range(900)]
    sources = ["big"] * 500 + ["small"] * 40 + ["mid"] * 360
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.2, 2), ("mid", 0.2, 1), ("absent", 0.1, 1)], "source string, target_share double, max_repeats int")
    mixed, report = mixing.mix(docs(spark, texts, sources), targets)
    told = report.toPandas().set_index("source")
    for source, share in (("big", 0.5), ("small", 0.2), ("mid", 0.2)):
        assert abs(told.actual_share[source] - share / 0.9) < 0.01
    assert told.actual_share["absent"] == 0 and not told.short.drop("absent").any()
    assert abs(told.goal_tokens["big"] - 2 * told.tokens["small"] * 0.9 / 0.2) < 2
    assert mixed.groupBy("doc_id", "source").count().where("count > 2 or (count > 1 and source <> 'small')").count() == 0
