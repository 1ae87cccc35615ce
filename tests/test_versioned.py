import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom import runtime
from ledgerloom.operators import quality
from ledgerloom.plans.pipeline import Builder, ordered, run
from ledgerloom.sources import landing, versioned
from ledgerloom.sources.versioned import merge_table, read_table, rebuild, replace_table, vacuum

S = "k int, v string"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_merge_is_idempotent_null_safe_and_counts_its_source(spark, tmp_path):
    t, s = str(tmp_path / "t"), spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], S)
    for _ in range(2):
        assert merge_table(s, t, ["k"], [F.desc("v")]) == 3
    assert _rows(read_table(spark, t)) == [(1, "b"), (None, "c")]
    assert merge_table(spark.createDataFrame([(None, "d"), (2, "x")], S), t, ["k"], [F.desc("v")]) == 2
    assert _rows(read_table(spark, t)) == [(1, "b"), (2, "x"), (None, "d")]
    assert merge_table(spark.createDataFrame([], S), t, ["k"], [F.desc("v")]) == 0 and read_table(spark, t).count() == 3
    with pytest.raises(ValueError):
        merge_table(s, t, ["v"], [F.desc("v")])


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    t = str(tmp_path / "t")
    merge_table(spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v")), t, ["k"], [F.desc("v")])
    before = versioned._manifest(spark, t)["buckets"]
    merge_table(spark.createDataFrame([(5, "b")], S), t, ["k"], [F.desc("v")])
    after = versioned._manifest(spark, t)["buckets"]
    assert sum(before[b] != after[b] for b in before) == 1 and len(before) == versioned.BUCKETS
    assert read_table(spark, t).filter("v = 'b'").count() == 1 and read_table(spark, t).count() == 1000


def test_a_reader_during_a_merge_sees_old_or_new(spark, tmp_path):
    t, seen, stop = str(tmp_path / "t"), [], threading.Event()
    write = lambda n: merge_table(spark.range(200).select(F.col("id").cast("int").alias("k"), F.lit(str(n)).alias("v")), t, ["k"], [F.desc("v")])
    write(0)

    def read():
        while not stop.is_set():
            seen.append({(r.v, r.n) for r in read_table(spark, t).groupBy("v").agg(F.count("*").alias("n")).collect()})

    reader = threading.Thread(target=read)
    reader.start()
    held = read_table(spark, t)
    for n in (1, 2, 3):
        write(n)
    stop.set()
    reader.join()
    assert seen and all(x in ({(str(n), 200)} for n in range(4)) for x in seen)
    assert _rows(held.groupBy("v").count()) == [("0", 200)]  # whoever began with a version keeps it
    assert vacuum(spark, t, keep=1) == 3 and _rows(read_table(spark, t).groupBy("v").count()) == [("3", 200)]


def test_two_writers_of_one_version_collide(spark, tmp_path):
    t = str(tmp_path / "t")
    replace_table(spark.createDataFrame([(1, "a")], S), t, ["k"])
    m = versioned._manifest(spark, t)
    versioned._publish(spark, t, m | {"version": 2})
    with pytest.raises(versioned.Conflict):
        versioned._publish(spark, t, m | {"version": 2})


def test_schema_changes(spark, tmp_path):
    t = str(tmp_path / "t")
    merge_table(spark.createDataFrame([(1, "a")], S), t, ["k"], [F.desc("v")])
    merge_table(spark.createDataFrame([(2, "b", 0.5)], S + ", w double"), t, ["k"], [F.desc("v")])
    assert _rows(read_table(spark, t)) == [(1, "a", None), (2, "b", 0.5)]
    replace_table(spark.createDataFrame([("x",)], "other string"), t, ["other"])
    assert _rows(read_table(spark, t)) == [("x",)] and _rows(read_table(spark, t, version=1)) == [(1, "a")]
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "none"))


def test_cut_tables_are_removed(spark):
    df = runtime.cut(spark.range(10))
    fs, p = runtime.path_of(spark, df.cut_at)
    assert fs.exists(p) and df.count() == 10
    runtime.forget(df)
    assert not fs.exists(p)
    runtime.forget(spark.range(1))


def test_order_of_builders():
    b = lambda n, *needs: Builder(n, None, needs)
    assert [x.name for x in ordered([b("c", "b", "raw"), b("b", "a"), b("a")], {"raw"})] == ["a", "b", "c"]
    for bad in ([b("a"), b("a")], [b("a", "x")], [b("a", "b"), b("b", "a")]):
        with pytest.raises(ValueError):
            ordered(bad)


def test_a_run_builds_checks_and_moves_its_mark(spark, tmp_path):
    at, f = datetime(2025, 1, 1), str(tmp_path)
    raw = spark.createDataFrame([(1, "a"), (2, None)], S)
    builders = [Builder("two", lambda one: one.filter("v is not null"), ("one",)), Builder("one", lambda raw: raw, ("raw",))]
    soft = lambda _: [quality.not_null("one", "v", "warn"), quality.unique_key("one", ["k"])]
    out = run(spark, builders, {"raw": raw}, f, "b1", at, soft, [("one", "e", at)])
    assert out.log == [("one", 2, "done"), ("two", 1, "done"), ("checks", 2, "done")] and out.counts == {"one": 2, "two": 1}
    assert landing.read_mark(read_table(spark, f"{f}/_marks"), "one", "e") == at
    assert [tuple(r)[:4] for r in spark.read.parquet(f"{f}/_quality/results").filter("not passed").collect()] == [("one.v.not_null", "one", "warn", 1)]
    assert [r.row for r in spark.read.parquet(f"{f}/_quality/rejects").collect()] == ['{"k":2}']
    hard = lambda _: [quality.not_null("one", "v")]
    with pytest.raises(quality.BlockingFailure):
        run(spark, builders, {"raw": raw}, f, "b2", at, hard, [("one", "e", datetime(2025, 1, 2))])
    assert landing.read_mark(read_table(spark, f"{f}/_marks"), "one", "e") == at  # results stand, the mark didn't move
    assert spark.read.parquet(f"{f}/_quality/results").filter("batch_id = 'b2'").count() == 1 and "two" in spark.read.text(f"{f}/_diagnostics/b2").first()[0]
    broken = [Builder("one", lambda raw: raw.select("nowhere"), ("raw",))]
    with pytest.raises(Exception, match="nowhere"):
        run(spark, broken, {"raw": raw}, f, "b3", at)
    assert read_table(spark, f"{f}/one").count() == 2 and spark.read.parquet(f"{f}/_log").filter("status = 'failed'").count() == 1


def test_rebuild_counts(spark, tmp_path):
    assert rebuild(spark.range(7), str(tmp_path / "t")) == 7 and rebuild(spark.range(3), str(tmp_path / "t")) == 3
    assert read_table(spark, str(tmp_path / "t")).count() == 3
