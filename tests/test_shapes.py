import json

from feedloom.operators import jsonwalk, shapes
from feedloom.plans import reference


def write(spark, path, *files):
    rows = [(100 * n + i, 1, n, r if r is None or isinstance(r, str) else json.dumps(r)) for n, file in files for i, r in enumerate(file)]
    spark.createDataFrame(rows, "record_id long, feed_id long, file_no int, payload string").write.parquet(f"{path}/feed_records.parquet")
    return str(path)


def test_nested_and_type_changes_are_reported(spark, tmp_path):
    one = [{"id": 1, "pay": {"currency": "EUR", "min": 1}, "offices": [{"city": None}, {"city": "A", "zip": 1}], "tags": []}, {"id": 2, "pay": None}, "{broken"]
    two = [{"id": "1", "pay": {"currency": None, "min": 1}, "offices": [{"zip": "1"}], "tags": ["x"]}, {"id": "2", "pay": {"currency": "EUR"}}]
    folder = write(spark, tmp_path, (1, one), (3, two), (7, one))
    prints = {(r["file_no"], r["path"]): (r["present"], r["nulls"], r["types"]) for r in reference.queries()["shape_fingerprint_all"](spark, folder).collect()}
    assert {f for f, _ in prints} == {1, 3, 7}
    assert prints[1, "pay"] == ("all", "some", "object") and prints[1, "pay.currency"] == ("some", "never", "string") and prints[3, "pay.currency"] == ("all", "some", "string")
    assert prints[1, "offices.city"] == ("some", "always", "") and prints[1, "offices.zip"] == ("some", "never", "number") and prints[1, "tags"] == prints[3, "tags"] == ("some", "never", "array")
    rows = reference.queries()["contract_compare_all"](spark, folder).collect()
    got = {(r["path"], r["was_shape"], r["is_shape"]) for r in rows if (r["before"], r["file_no"]) == (1, 3)}
    assert got == {
        ("id", "all/never/number", "all/never/string"), ("pay", "all/some/object", "all/never/object"), ("pay.currency", "some/never/string", "all/some/string"),
        ("offices.city", "some/always/", "absent"), ("offices.zip", "some/never/number", "some/never/string"),
    }
    assert {(r["path"], r["is_shape"], r["was_shape"]) for r in rows if (r["before"], r["file_no"]) == (3, 7)} == got
    assert len(rows) == 2 * len(got)  # the last file's shape is the first's


def test_types_equal_resolved_paths():
    record = {"a": [{"b": None}, {"b": 1, "c": [[], [{"d": True}]]}, 3], "e": {"f": {}, "g": []}}
    got = shapes.types_of(record)
    assert set(got) == {"a", "a.b", "a.c", "a.c.d", "e", "e.f", "e.g"}
    assert all(got[p] == shapes._type(jsonwalk.first_at(record, p)[0]) for p in got)
