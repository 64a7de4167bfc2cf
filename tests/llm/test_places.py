from pyspark.sql import functions as F

from feedloom.llm import canonical, survivors

REF = [
    (1, None, None, "Germany", "DE", "Deutschland", "country"), (2, None, None, "United Arab Emirates", "AE", "UAE", "country"), (3, None, None, "Brazil", "BR", "Brasil", "country"),
    (10, "Timbrupore", "Westmarch", "Germany", "DE", "Quelvavastad", "city"), (11, "Timbrupore", "Westridge", "Brazil", "BR", None, "city"), (12, "Lomméeira", "Ostridge", "Germany", "DE", None, "city"), (13, "Yaslobia", "Westmarsh", "United Arab Emirates", "AE", None, "city"),
]
SCHEMA = "place_id long, city string, region string, country string, country_code string, alt_name string, kind string"


def test_values(spark):
    cases = {
        "Lomméeira": 12, "LOMMEEIRA.": 12, "  lommeeira ,DE": 12, "Germany / Ostridge / Lomméeira": 12, "Remote - Lomméeira, Deutschland": 12, "Lomméeira，Germany": 12, "12345 Lomméeira": 12, "Lomméeira (Hybrid)": 12, "Lomméeira - On-site": 12, "greater Lomméeira": 12,
        "Lomémeira, Germany": 12, "Lommeira": 12, "Lommxeira; Germny": 12, "Quelvavastad": 10, "Timbrupore, BR": 11, "Timbrupore, Westmarch": 10, "Anywhere in UAE": 2, "Germany only": 1, "DE": 1, "Yaslobia HQ": 13,
        "Timbrupore": 0, "Kundoheim": 0, "Kundoheim, Germany": 0, "Lomméeira, Brazil": 0, "Remote": 0, "EMEA": 0, "n/a": 0, "?": 0, "x" * 50_000: 0,
    }
    df = spark.createDataFrame([(v, "clash") for v in [*cases, *cases, None, "", "  "]], "location string, value string")
    ref = spark.createDataFrame(REF, SCHEMA)
    mapped = canonical.map_places(df, "location", ref)
    got = {r["value"]: r["place_id"] for r in mapped.collect()}
    assert got == cases
    assert mapped.count() == len(cases)  # one row a distinct value
    assert {r["value"]: r["outcome"] for r in mapped.collect()}["Timbrupore"] == "ambiguous"
    assert canonical.map_places(df.limit(0), "location", ref).count() == 0
    assert {r["place_id"] for r in canonical.map_places(df, "location", ref.limit(0)).collect()} == {0}


def test_candidates_equal_brute_force(spark):
    """The inverted index finds what scoring every pair finds."""
    import math
    from collections import Counter

    ref = spark.createDataFrame(REF, SCHEMA)
    names = canonical.reference_names(ref)
    texts = ["lommeira", "timbrpore", "germny", "brasill", "yaslobai", "westmarhs", "quelvastad", "nowhere", "united arab emirate"]
    got = {r["seg"]: r["name"] for r in canonical.match_names(spark.createDataFrame([(x,) for x in texts], "seg string"), names).collect()}

    def grams(x):
        x = f"^{x}$"
        return Counter(x[i : i + 2] for i in range(len(x) - 1))

    all_names = sorted({r["name"] for r in names.collect()})
    df = Counter(g for n in all_names for g in grams(n))
    weight = lambda g: 1 + math.log(len(all_names) / df[g]) if g in df else 1 + math.log(len(all_names))

    def cosine(a, b):
        a, b = ({g: n * weight(g) for g, n in grams(x).items()} for x in (a, b))
        dot = sum(a[g] * b.get(g, 0) for g in a)
        return dot / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    from tests.test_text import edits

    for x in texts:
        rated = sorted(((cosine(x, n), n) for n in all_names if (edits(x, n) <= 1 if len(n) > 3 else x == n)), reverse=True)
        clear = rated and rated[0][0] >= 0.3 and (len(rated) == 1 or rated[0][0] - rated[1][0] >= 0.01)
        assert got.get(x) == (rated[0][1] if clear else None)


def test_survivors(spark):
    d = "2026-01-{:02}".format
    rows = [
        (1, "a", "s1", "Lomméeira", d(1), d(5)), (2, "b", "s2", "Lomméeira, Germany", d(2), d(5)), (3, "c", "s1", "Lomméeira, Germany", "1970-01-01", d(6)),
        (4, "d", "zz", "Lomméeira, Ostridge, Germany", d(9), d(6)), (5, "e", "s1", "n/a", None, d(6)), (6, "f", None, None, None, None), (7, "g", "s1", "?", d(3), None),
    ]
    rows = spark.createDataFrame(rows, "row_id long, identity string, source string, location string, p string, f string").select("row_id", "identity", "source", "location", F.col("p").cast("timestamp").alias("published_at"), F.col("f").cast("timestamp").alias("first_seen"), F.lit(1).alias("named"), F.lit(1).alias("trust_rank"))
    groups = spark.createDataFrame([(1, ["a", "b", "c", "a", None]), (2, ["a", "b", "c", "d"]), (3, ["e", "f", "g"]), (4, []), (5, None), (6, ["nobody"])], "group_id long, members array<string>")
    trust = spark.createDataFrame([("s1", 2), ("s2", 1)], "source string, trust_rank int")
    ref = spark.createDataFrame(REF, SCHEMA)
    assert {tuple(r) for r in survivors.survivors_found(groups, rows, trust, ref).collect()} == {(1, "location", 2), (1, "published_at", 2), (2, "location", 4), (2, "published_at", 2)}
    whole = {r["group_id"]: r["representative"] for r in survivors.survivors(groups, rows, trust, ref).collect()}
    assert whole == {1: "b", 2: "d", 3: "e"}
    # two members give a field each: of these the more trusted, then later seen one is the representative
    apart = groups.limit(0).unionByName(spark.createDataFrame([(7, ["a", "c"])], "group_id long, members array<string>"))
    assert {tuple(r) for r in survivors.survivors_found(apart, rows, trust, ref).collect()} == {(7, "location", 3), (7, "published_at", 1)}
    apart = apart.unionByName(spark.createDataFrame([(8, ["b", "d"])], "group_id long, members array<string>"))
    assert {r["group_id"]: r["representative"] for r in survivors.survivors(apart, rows, trust, ref).collect()} == {7: "c", 8: "b"}
    assert survivors.survivors_found(groups.limit(0), rows, trust, ref).count() == 0
    assert survivors.survivors_found(groups, rows.limit(0), trust, ref).count() == 0
