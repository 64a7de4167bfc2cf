import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.functions import descriptions as D
from feedloom.functions import text as T


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build(F.col("x")).alias("y")).first()["y"]


def test_fold(spark):
    cases = {None: "", "": "", "  A—B_c/d ": "a b c d", "Résumé (Sr.)": "resume sr", "Ｆｕｌｌ　Width": "full width", "Se​nior": "senior", "É" * 3: "eee"}
    for value, expected in cases.items():
        assert one(spark, value, T.fold) == expected


def test_latin_marks_go_as_in_unicode(spark):
    letters = [chr(c) for c in range(0xC0, 0x180) if len(unicodedata.normalize("NFKD", chr(c))) == 2 and unicodedata.normalize("NFKD", chr(c))[0].isascii() and unicodedata.combining(unicodedata.normalize("NFKD", chr(c))[1])]
    got = spark.createDataFrame([(x,) for x in letters], "x string").select("x", T.strip_marks(F.col("x")).alias("y")).collect()
    assert all(r["y"] == unicodedata.normalize("NFKD", r["x"])[0] for r in got)


def edits(a, b):
    """Optimal string alignment distance."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_near_is_one_edit(spark):
    pairs = []

    @settings(max_examples=300, deadline=None, database=None)
    @given(st.text("abc", max_size=7), st.text("abc", max_size=7))
    def collect(a, b):
        pairs.append((a, b))

    collect()
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", T.near(F.col("a"), F.col("b")).alias("n")).collect()
    for r in got:
        assert r["n"] == (edits(r["a"], r["b"]) <= 1), r


def test_ngrams(spark):
    assert one(spark, "abc", lambda c: T.ngrams(c, 2)) == ["^a", "ab", "bc", "c$"]
    assert one(spark, "", lambda c: T.ngrams(c, 3)) == ["^$"]


def test_suffix(spark):
    df = spark.createDataFrame([("Cook - Rome", "Rome"), ("Cook", None), ("Cook - Rome", " "), (" - Rome", "Rome")], "t string, l string")
    assert [r[0] for r in df.select(T.strip_location_suffix(F.col("t"), F.col("l"))).collect()] == ["Cook", "Cook", "Cook - Rome", ""]


def test_lines(spark):
    assert one(spark, "<p>a &amp; b</p><ul><li>c<b>d</b></li></ul>\n\n e ", D.lines_of) == ["a & b", "c d", "e"]
    assert one(spark, None, D.lines_of) == []
    assert one(spark, "  ", D.lines_of) == []


def test_years_and_places_of_work(spark):
    lines = "array<string>"
    asked = {("5+ years of experience",): [5], ("two to four years experience", "We have 20 years of experience"): [2], ("up to 3 years experience",): [], ("3 years experience", "Fresh graduates welcome"): [], (): []}
    for value, expected in asked.items():
        assert one(spark, list(value), D.years_asked, lines) == expected
    assert one(spark, ["Work on-site in Rome"], D.says_on_site, lines) is True
    assert one(spark, ["on site", "or remote"], D.says_on_site, lines) is False
    assert one(spark, ["on site, no remote work"], D.says_on_site, lines) is True


def test_emails(spark):
    assert one(spark, "Jobs@A.example, jobs@a.example; x@b.example", D.emails) == ["jobs@a.example", "x@b.example"]


def test_years_by_line_start_and_voice(spark):
    lines = "array<string>"
    asked = {
        ("We ask for 5 or more years of experience",): [5], ("Minimum of 7 years leading teams", "Requirements: 4 years"): [7, 4], ("Experience3yrs in sales",): [3], ("5yrs of Java",): [5],
        ("We have a role for a candidate with 6 years of experience",): [6], ("The firm has 30 years of experience",): [], ("We ask for 5 years of work",): [5], ("Over the next 3 years experience counts",): [],
    }
    for value, expected in asked.items():
        assert one(spark, list(value), D.years_asked, lines) == expected, value
