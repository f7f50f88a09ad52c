from datetime import datetime as D

from cohortloom.operators import eav

META = "meta_id long, run_accession string, field_name string, field_value string, updated_at timestamp_ntz, canonical_field string"
MAP = "source_column string, canonical_field string, value_type string"
COLUMNS = [("age", "age", "integer"), ("Age In Days", "age", "integer"), ("rin", "rin", "decimal"), ("day", "day", "date"), ("pool", "pool", "boolean"), ("sex", "sex", "string"), ("note", None, None)]


def cells(spark, rows):
    m = spark.createDataFrame(COLUMNS, MAP)
    d = spark.createDataFrame([(i, *r, "clash") for i, r in enumerate(rows)], META)
    resolved = eav.resolve_pairs(d, m)
    wide = eav.wide_table(resolved, eav.canonical_fields(m))
    found = {(r.run_accession, r.canonical_field): r.cell_value for r in eav.filled_cells(wide, eav.canonical_fields(m)).collect()}
    return found, {r.run_accession: r.cast_failures for r in wide.collect()}


def test_written_forms(spark):
    t = D(2024, 1, 1)
    tries = {
        "age": {"007": "7", "+5": "5", "-0": "0", "-12.00": "-12", "1.5": None, "12?": None, "": None, " n/a ": None, "99999999999999999999": "99999999999999999999"},
        "rin": {"+8.7": "8.7", "9": "9.0", "7.20": "7.2", "8.25": "8.3", "RIN 8": None, ">9.1": None},
        "day": {
            "2021-02-03": "2021-02-03", "2021/2/3": "2021-02-03", "20210203": "2021-02-03", "03-FEB-2021": "2021-02-03", "3 February 2021": "2021-02-03", "February 3, 2021": "2021-02-03",
            "2021-02-03T10:00:00Z": "2021-02-03", "2021-02-03 08:30:00": "2021-02-03", "2021-02-30": None, "2021-02": None, "2021": None, "spring 2021": None, "31 Apr 2021": None,
        },
        "pool": {"Yes": "true", "0": "false", "T": "true", "maybe": None, "none": None},
        "sex": {" Male ": "male", "unknown": None},
    }
    rows = [(f"r{i}_{j}", field, text, t) for i, (field, m) in enumerate(tries.items()) for j, text in enumerate(m)]
    found, _ = cells(spark, rows)
    for (run, field, text, _), want in zip(rows, [v for m in tries.values() for v in m.values()], strict=True):
        assert found.get((run.upper(), field)) == want, (field, text)


def test_latest_usable_and_failures(spark):
    a, b, c = D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)
    rows = [("x", "age", "1", a), (" X", "AGE in-days", "2", b), ("x", "age", "abc", c), ("x", "age", "NA", c), ("x", "sex", "m", None), ("x", "sex", "f", None), ("x", "note", "z", a), (None, "age", "1", a), ("-", "age", "1", a), ("y", None, "1", a), ("y", "age", None, a)]
    found, failed = cells(spark, rows)
    assert found == {("X", "age"): "2", ("X", "sex"): "f"}
    assert failed["X"] == {"age": "abc"} and failed.get("Y") in (None, {})


def test_empty(spark):
    assert cells(spark, []) == ({}, {})
