from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.operators import measures as M
from ledgerloom.operators import quality as Q


def test_a_check_that_throws_stops_no_other(spark):
    t = {"t": spark.createDataFrame([(1, "x", date(2025, 1, 2), date(2025, 1, 1)), (2, "3", None, None)], "k int, v string, a date, b date"), "p": spark.createDataFrame([(1,)], "k int")}
    variance = Q.Expectation("t.p.variance", "t", failing=lambda t: t["t"].join(t["p"], "k").filter("a > b"))
    suite = [Q.holds("throws", "t", F.assert_true(F.col("k") < 0).isNotNull()), Q.date_order("t", "a", "b"), Q.not_null("t", "nowhere"), Q.unique_key("t", ["k"]), Q.freshness("t", "a", datetime(2026, 1, 1), 1), variance]
    got = {r.expectation: (r.failing_rows, r.passed) for r in Q.run_suite(spark, t, suite).collect()}
    assert got == {"throws": (-1, False), "t.a.before_b": (1, False), "t.nowhere.not_null": (-1, False), "t.k.unique": (0, True), "t.a.freshness": (1, False), "t.p.variance": (1, False)}
    s = Q.summary(Q.run_suite(spark, t, suite)).first()
    assert (s.checks, s.passed, s.blocking, s.warnings, s.not_run) == (6, 1, 4, 1, 2)
    assert Q.run_suite(spark, t, []).count() == 0
    with pytest.raises(Q.BlockingFailure, match="throws"):
        Q.assert_no_blocking(Q.run_suite(spark, t, suite))


def test_rejects_whole_or_capped(spark):
    t = {"t": spark.range(1500).select(F.lit(None).cast("int").alias("v"))}
    suite = [Q.not_null("t", "v")]
    assert Q.rejects(t, suite).count() == 1000 and Q.rejects(t, suite, None).count() == 1500


def _model(spark):
    f = spark.createDataFrame([("a", date(2025, 1, 1), 10), ("a", date(2025, 2, 1), 30), ("a", date(2025, 4, 1), 5), ("b", date(2025, 2, 1), 7)], "g string, m date, x long")
    h = spark.createDataFrame([("a", 1, "k")], "g string, y long, only string")
    m = [
        M.total("x", "f", "x"), M.total("y", "h", "y", blank=False), M.total("y_blank", "h", "y"), M.rows_where("n", "h"), M.prior_month("before", "x"), M.running("so_far", "x"), M.trailing("two_months", "x", 2, "months"),
        M.trailing("days_31", "x", 32), M.label("size", "x", [(20, "big"), (6, "mid")], "small", "none"), M.ratio("share", "y", "x"), M.distinct_where("d", "h", "y", F.lit(True)),
    ]
    return M.Model({"f": f, "h": h}, m, {"dim": spark.createDataFrame([("a", "Alpha", 2), ("b", "Beta", 1)], "g string, name string, pos int")}, {"f": [("dim", "g", "g")]})


def test_groups_a_fact_lacks_count_as_zero(spark):
    got = {r.g: (r.x, r.y, r.y_blank, r.n, r.d, r.share) for r in _model(spark).query(["x", "y", "y_blank", "n", "d", "share"], ["g"]).collect()}
    assert got == {"a": (45, 1.0, 1, 1, 1, 1 / 45), "b": (7, 0.0, None, 0, 0, 0.0)}


def test_time_measures_under_a_filter(spark):
    q = lambda names, where=None, cols=frozenset(): {(r[0], str(r[1])[:7]): tuple(r)[2:] for r in _model(spark).query(names, ["g", "m"], where, cols, date="m").collect()}
    assert q(["before", "so_far", "two_months"]) == {("a", "2025-01"): (None, 10, 10), ("a", "2025-02"): (10, 40, 40), ("a", "2025-04"): (None, 45, 5), ("b", "2025-02"): (None, 7, 7)}
    assert q(["before", "days_31", "size"], F.col("m") >= date(2025, 2, 1), {"m"}) == {("a", "2025-02"): (10, 40, "big"), ("a", "2025-04"): (None, 5, "small"), ("b", "2025-02"): (None, 7, "mid")}
    with pytest.raises(ValueError):
        _model(spark).query(["before"], ["g"])


def test_filters_that_no_fact_has_are_refused(spark):
    with pytest.raises(ValueError):
        _model(spark).query(["x"], ["g"], F.col("zz") > 1, {"zz"})
    assert [tuple(r) for r in _model(spark).query(["x", "n"], [], F.col("only") == "k", {"only"}).collect()] == [(52, 1)]


def test_slicer_and_sort_pairs(spark):
    m = _model(spark)
    assert [r.name for r in m.slicer("name", "pos").collect()] == ["Beta", "Alpha"] and [r.name for r in m.slicer("name").collect()] == ["Alpha", "Beta"]
    m.dims["dim"] = spark.createDataFrame([("a", "Alpha", 1), ("b", "Beta", 1)], "g string, name string, pos int")
    with pytest.raises(ValueError):
        m.slicer("name", "pos")
    with pytest.raises(ValueError):
        m.slicer("nowhere")


def test_report_specs(spark):
    m = _model(spark)
    assert M.Report("r", ("g",), ("x",), sort="x").problems(m) == [] and M.Report("r", ("g",), ("x",)).publishing_problems(m) == ["no text"]
    assert len(M.Report("r", ("q",), ("w",), sort="e", text="t").publishing_problems(m)) == 3
    assert [r.g for r in M.Report("r", ("g",), ("x",), sort="x").run(m).collect()] == ["a", "b"]


def test_scalars(spark):
    df = spark.createDataFrame([("Current",), ("90+",), ("Unknown",), (None,)], "b string")
    assert [r[0] for r in df.select(C.aging_sort(F.col("b"))).collect()] == [1, 5, 9, 9]
    df = spark.createDataFrame([("12.5",), ("x",), (None,)], "m string")
    assert [r[0] for r in df.select(C.money(F.col("m"))).collect()] == [12.5, 0.0, 0.0]
    df = spark.createDataFrame([(date(2014, 1, 1),), (date(2025, 1, 1),), (None,)], "d date")
    assert [tuple(r) for r in df.select(C.out_of_range(F.col("d")), C.out_of_range(F.col("d"), True)).collect()] == [(True, True), (False, False), (False, True)]
