import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import rows as R
from ledgerloom import skew
from ledgerloom.skew import join_counted, join_salted, join_unique


def test_upsert_is_idempotent_and_null_safe(spark):
    t = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    s = spark.createDataFrame([(None, "B"), (3, "x"), (3, "y")], "k int, v string")
    once = R.upsert(t, s, ["k"], [F.desc("v")])
    want = {(1, "a"), (2, "c"), (None, "B"), (3, "y")}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in R.upsert(once, s, ["k"], [F.desc("v")]).collect()} == want
    for bad in ([], ["z"]):
        with pytest.raises(ValueError):
            R.upsert(t, s, bad, [F.desc("v")])


def test_order_of_input_does_not_matter(spark):
    data = [(1, 5, "b"), (1, 5, "a"), (1, 4, "z"), (2, None, None)]
    want = {(1, 5, "a"), (2, None, None)}
    for rows in (data, data[::-1]):
        got = R.latest_snapshot(spark.createDataFrame(rows, "k int, t int, v string"), ["k"], "t", ["v"])
        assert {tuple(r) for r in got.collect()} == want


def test_contains_pairs_against_brute_force(spark):
    words = ["abc", "abcd", "bcd", "ab", "xyz", "abcabc", "", None, "q" * 40, "q" * 39 + "r", "bcd"]
    texts = ["zzabcdzz", "abcabcabc", "xy", "", None, "bcdxyz", "a" + "q" * 41, "q" * 39 + "rr", "zzabcdzz"]
    n = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    h = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "j int, t string")
    got = {(r.i, r.j) for r in R.contains_pairs(n, "w", h, "t").collect()}
    assert got == {(i, j) for i, w in enumerate(words) for j, t in enumerate(texts) if w and len(w) >= 3 and t and w in t}
    assert R.contains_pairs(n.limit(0), "w", h, "t").count() == 0


def test_join_counted_equals_join(spark):
    rows = spark.range(5000).select((F.col("id") % 3000).alias("k"), "id")
    rows = rows.unionByName(spark.range(3000).select(F.lit(7).cast("long").alias("k"), F.col("id")))
    keyed = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("x", F.col("k") * 2)
    assert join_counted(rows, keyed, "k", "n").agg(F.sum("x"), F.count("*")).first() == rows.join(keyed, "k").agg(F.sum("x"), F.count("*")).first()
    assert join_counted(rows.limit(0), keyed.limit(0), "k", "n").count() == 0


def test_reject_split_keeps_every_row(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "k int, v string")
    good, bad = R.split_rejects(df, {"k": F.col("k").isNotNull(), "v": F.col("v") != ""}, "t")
    assert good.count() == 1 and {r.reason for r in bad.collect()} == {"k", "v"}


def test_joins_with_hot_keys_equal_joins(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    left = spark.range(3000).select((F.col("id") % 500).alias("k"), "id").unionByName(spark.range(2000).select(F.lit(7).cast("long").alias("k"), (F.col("id") + 9000).alias("id")))
    right = spark.range(600).select((F.col("id") % 550).alias("k"), (F.col("id") * 3).alias("x"))
    want = sorted(map(tuple, left.join(right, "k").collect()))
    assert sorted((r.k, r.id, r.x) for r in join_salted(left, right, "k").collect()) == want
    one = right.dropDuplicates(["k"])
    assert sorted((r.k, r.id, r.x) for r in join_unique(left, one, ["k"], 5000).collect()) == sorted(map(tuple, left.join(one, "k").collect()))
    assert join_salted(left.limit(0), right, "k").count() == 0 and join_unique(left.limit(0), one, ["k"], 0).count() == 0


def test_places_in_groups_of_any_size(spark):
    rows = [("a", i) for i in range(500)] + [("b", 3), ("b", 1), (None, 5), (None, 4)]
    got = {(r.g, r.v): (r.n_rows, r.position) for r in R.ranked_in(spark.createDataFrame(rows, "g string, v int"), "g", "v").collect()}
    assert got == {("a", i): (500, i + 1) for i in range(500)} | {("b", 1): (2, 1), ("b", 3): (2, 2), (None, 4): (2, 1), (None, 5): (2, 2)}
    assert R.ranked_in(spark.createDataFrame([], "g string, v int"), "g", "v").count() == 0


def test_a_tombstone_wins_and_blanks(spark):
    told = R.with_tombstones(spark.createDataFrame([("1", "x", False), ("2", "y", True), ("3", "z", None)], "k string, v string, active boolean"), "v", "active")
    pool = told.select("k", "v", F.lit("manual").alias("m")).unionByName(spark.createDataFrame([("1", "auto", "auto"), ("4", "auto", "auto")], "k string, v string, m string"))
    got = {r.k: (r.v, r.m) for r in R.by_precedence(pool, ["k"], "m", ["manual", "auto"], [F.asc("v")]).collect()}
    assert got == {"1": (None, "manual"), "2": ("y", "manual"), "3": (None, "manual"), "4": ("auto", "auto")}


def test_rejects_of_several_sources(spark):
    parts = [R.split_rejects(spark.createDataFrame([(None, 1)], "k int, v int"), {"k": F.col("k").isNotNull()}, t)[1] for t in ("a", "b")]
    assert {(r.source_table, r.reason) for r in R.union_rejects(*parts).collect()} == {("a", "k"), ("b", "k")}
