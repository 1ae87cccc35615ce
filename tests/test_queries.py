"""Every query with SQL against that SQL on the smallest tables, and every query runs."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{DIR}/{f}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else repr(v)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, DIR)
    cols = sorted(df.columns)
    mine = sorted(tuple(map(_plain, r)) for r in df.select(*cols).collect())
    cur = db.execute(entry.oracle_sql()[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert mine == sorted(tuple(_plain(r[i]) for i in at) for r in cur.fetchall())


def _get(spark, name):
    return entry.queries()[name](spark, DIR)


def test_flat_tables_agree_with_the_whole_output(spark):
    whole = _get(spark, "p3_rows").filter("source = 'procore_budget_detail_row'").cache()
    keys = ["record_key", "record_at", "row_key", "parent_key", "id"]
    for name, at in (("p3_budget_rows", ""), ("p3_forecasts", "budget_forecast"), ("p3_segment_items", "wbs_code.segment_items")):
        mine = _get(spark, name).select(*keys)
        theirs = whole.filter(whole.table == at).select(*keys)
        assert mine.count() == theirs.count() > 0 and mine.exceptAll(theirs).count() == 0
    landed = spark.read.parquet(f"{DIR}/procore_budget_detail_row.parquet")
    read = whole.select("record_key").distinct().count()
    bad = _get(spark, "p3_rejects")
    assert {r.reason for r in bad.select("reason").distinct().collect()} <= {"no payload", "not JSON", "no record"}
    assert read + bad.count() >= landed.select("_key").distinct().count()


def test_profile_queries_agree(spark):
    found, changes = _get(spark, "p5_found"), _get(spark, "p5_changes")
    key = ["table_name", "column_name", "batch_id"]
    assert found.exceptAll(changes.select(*key).distinct()).count() == 0 and changes.filter("sigmas < 5").count() == 0
    profile = _get(spark, "p5_profile")
    assert profile.filter("nulls < 0 or nulls > row_count or distinct_values > 1.1 * (row_count - nulls) + 1").count() == 0
    rare = _get(spark, "p5_masks").filter("not dominant").select("table_name", "column_name", "mask")
    violations = _get(spark, "p5_violations")
    assert violations.select("table_name", "column_name", "mask").distinct().exceptAll(rare).count() == 0 and violations.filter("example is null or share <= 0 or share > 1").count() == 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_p3_rows_hold_every_related_table(spark):
    rows = entry.queries()["p3_rows"](spark, DIR)
    got = {(r.source, r.table) for r in rows.select("source", "table").distinct().collect()}
    below = ("", "budget_forecast", "wbs_code", "wbs_code.segment_items", "wbs_code.segment_items.segment", "wbs_code.attribute_items")
    assert got >= {("procore_budget_detail_row", t) for t in below} | {("dl_silver_qbo_customers", t) for t in ("", "customer")}
    assert rows.filter("table = 'customer'").count() == spark.read.parquet(f"{DIR}/dl_silver_qbo_customers.parquet").count()
