import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from ledgerloom.operators.profile import Profile, changed_columns, mask

SCHEMA = "load string, n double, code string, kind string, day date, d0 int, `a.b` string"


def _rows(loads=12, size=60, change=None):
    r, out = random.Random(3), []
    for i in range(loads):
        for _ in range(size):
            row = {"load": f"L{i:02}", "n": r.uniform(10, 99), "code": f"{r.randint(10, 99)}-{r.randint(100, 999)}", "kind": r.choice(["x", "y", "y"]), "day": date(2024, 1, 1) + timedelta(r.randint(0, 300)), "d0": r.randint(0, 5), "a.b": "q"}
            if change and i == 5 and r.random() < 0.6:
                change(row)
            out.append(tuple(row.values()))
    return out


def _found(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    return {(r.column_name, r.batch_id) for r in changed_columns([Profile(df, "t", "load", ["n", "code", "kind", "day", "d0", "a.b"])]).collect()}


def test_quiet_loads_report_nothing(spark):
    assert _found(spark, _rows()) == set()


def test_each_kind_of_change_is_found(spark):
    changes = {
        "nulls": ("n", lambda r: r.update(n=None)), "range": ("n", lambda r: r.update(n=r["n"] * 1e4)), "constant": ("code", lambda r: r.update(code="10-100")),
        "form": ("code", lambda r: r.update(code=r["code"].replace("-", ""))), "values": ("kind", lambda r: r.update(kind="x")), "dates": ("day", lambda r: r.update(day=date(1899, 12, 30))),
    }
    for name, (column, change) in changes.items():
        assert _found(spark, _rows(change=change)) == {(column, "L05")}, name


def test_edges(spark):
    assert _found(spark, []) == set()
    assert _found(spark, _rows(loads=3)) == set()
    none = [(*r[:1], *[None] * 6) for r in _rows()] + [(None, 1.0, "a", "b", None, 1, "c")]
    assert _found(spark, none) == set()
    odd = [*_rows(), ("L01", float("nan"), "", "x" * 200_000, None, None, None), *_rows(loads=1, size=1) * 3]
    assert _found(spark, odd) == set()


def test_profile_counts(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", None), ("b", float("nan"))], "load string, n double")
    got = {r.batch_id: (r.row_count, r.nulls, r.distinct_values, r.least) for r in Profile(df, "t", "load", ["n"]).loads.collect()}
    assert got == {"a": (3, 1, 1, "1.0"), "b": (1, 1, 0, None)}


def test_masks(spark):
    cases = {"Big Old Mill": "Aa+", "23-1234567": "99-9999999", "123456": "999999", "BIG MILL": "A+", "x9": "a9", "12.50": "9+", "": ""}
    df = spark.createDataFrame([(k,) for k in cases], "v string").select("v", mask(F.col("v")).alias("m"))
    assert {r.v: r.m for r in df.collect()} == cases


def _counts(change, loads=30, size=45):
    """One column of some 90 whole numbers, uneven as counts of failing rows are; change(i, k, n) gives row k of load i."""
    r = random.Random(5)
    draw = lambda: 0 if r.random() < 0.65 else 10 * r.randint(1, 5) if r.random() < 0.5 else r.randint(0, 90)
    return [(f"L{i:02}", change(i, k, draw())) for i in range(loads) for k in range(size)]


def test_columns_of_many_values_are_compared_value_by_value(spark):
    found = lambda rows: {(r.column_name, r.batch_id) for r in changed_columns([Profile(spark.createDataFrame(rows, "load string, n long"), "t", "load", ["n"])]).collect()}
    assert found(_counts(lambda i, k, n: n)) == set()
    # 6 lies in the decile of 0 and has its mask
    assert found(_counts(lambda i, k, n: 6 if i == 7 and n == 0 else n)) == {("n", "L07")}


def test_a_few_rows_out_of_range_are_found(spark):
    def with_ends(column, value, per_load=2, load=5):
        rows = [list(r) for r in _rows()]
        for r in [r for r in rows if r[0] == f"L{load:02}"][:per_load]:
            r[column] = value
        return [tuple(r) for r in rows]

    assert _found(spark, with_ends(1, 5e6)) == {("n", "L05")}
    assert _found(spark, with_ends(1, -5e6)) == {("n", "L05")}
    assert _found(spark, with_ends(4, date(2027, 1, 1))) == {("day", "L05")}
    assert _found(spark, with_ends(4, date(2019, 1, 1))) == {("day", "L05")}


def test_small_loads_and_few_loads(spark):
    small = [*_rows(), *[("L99", 50.0, "10-100", "y", date(2024, 5, 1), 3, None)] * 1]
    assert _found(spark, small) == set()
    assert _found(spark, [*_rows(), *[("L99", 20.0 + i, f"2{i}-10{i}", "new", date(2024, 1 + i, 1), i % 6, "q") for i in range(7)]]) == {("kind", "L99")}
    for loads in (3, 4):
        rows = [(*r[:3], "z" if r[0] == "L01" else r[3], *r[4:]) for r in _rows(loads=loads)]
        assert _found(spark, rows) == {("kind", "L01")}
    assert _found(spark, _rows(loads=2)) == set()
    assert _found(spark, [(*r[:3], "z" if r[0] == "L01" else r[3], *r[4:]) for r in _rows(loads=2)]) == {("kind", "L00"), ("kind", "L01")}


def test_an_id_of_the_wrong_length_is_a_violation(spark):
    rows = [("a", f"{100000000 + i}", 1.0) for i in range(300)] + [("b", "12345", 1.0), ("b", "100000999", 2.0)]
    p = Profile(spark.createDataFrame(rows, "load string, code string, mask double"), "t", "load", ["code", "mask"])
    assert [tuple(r) for r in p.violations().collect()] == [("t", "code", "b", "99999", 1, 0.5, "12345")]


def test_bounds_are_parameters(spark):
    rows = _rows(change=lambda r: r.update(n=None))
    found = lambda **kw: {(r.column_name, r.batch_id) for r in Profile(spark.createDataFrame(rows, SCHEMA), "t", "load", ["n", "code"], **kw).changes().collect()}
    assert found() == {("n", "L05")} and found(shift=0.9) == set() and found(sigmas=1e6) == set()
