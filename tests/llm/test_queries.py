"""The queries of the subpackage on the smallest tables, held against each other and the tables."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import queries
from ledgerloom.llm.tokens import DEFAULT_RANKS

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
tokenizer = pytest.mark.skipif(not os.path.exists(DEFAULT_RANKS), reason="no tokenizer files")


def _get(spark, name):
    return queries.queries()[name](spark, DIR)


def _table(spark, name):
    return spark.read.parquet(f"{DIR}/{name}.parquet")


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_p1(spark):
    matches = _get(spark, "p1_matches").cache()
    assert _same(_get(spark, "p1_found"), matches.select("project_id", "qbo_customer_id"))
    jobs = _table(spark, "dl_silver_qbo_customers").filter("is_job or is_project").select(F.trim("qbo_customer_id").alias("qbo_customer_id"))
    assert matches.count() > 0 and matches.join(jobs, "qbo_customer_id", "left_anti").count() == 0
    assert matches.groupBy("qbo_customer_id").count().filter("count > 1").count() == 0 and matches.filter("confidence < 0.5 or confidence >= 1").count() == 0


def test_p2(spark):
    found, vendors = _get(spark, "p2_found"), _get(spark, "p2_vendors").cache()
    assert found.count() == vendors.agg(F.sum(F.col("copies") - 1)).first()[0] > 0
    assert found.filter("keep_id >= copy_id").count() == 0 and found.select("copy_id").join(vendors, F.col("copy_id") == F.col("keep_id")).count() == 0
    named = _table(spark, "dl_silver_vendors").select(F.trim("vendor_id").alias("keep_id"), "vendor_name").unionByName(_table(spark, "dl_silver_qbo_vendors").select(F.trim("qbo_vendor_id").alias("keep_id"), "vendor_name"))
    assert vendors.select("keep_id", "vendor_name").exceptAll(named.distinct()).count() == 0


def test_p4(spark):
    keys = ["entity", "project_id", "record_key", "field_name"]
    found, fused = _get(spark, "p4_found").cache(), _get(spark, "p4_fused").cache()
    assert found.count() > 0 and found.join(fused, keys, "left_anti").count() == 0
    assert fused.filter("posterior <= 0 or posterior > 1 or value is null").count() == 0 and fused.groupBy(*keys).count().filter("count > 1").count() == 0
    alike = found.join(fused.withColumnRenamed("batch_id", "fused"), keys).agg(F.avg((F.col("batch_id") == F.col("fused")).cast("int"))).first()[0]
    assert alike > 0.9  # a recency prior of one log unit, not certainty


def test_p6(spark):
    passages = _get(spark, "p6_passages").cache()
    assert _same(_get(spark, "p6_found"), passages.select("item_id", "doc_id")) and passages.filter("words < 20").count() == 0
    texts = _table(spark, "documents").select("doc_id", "text")
    assert passages.join(texts, "doc_id").filter("start < 0 or end > length(text) or end <= start").count() == 0


@tokenizer
def test_p7(spark):
    chosen, shares = _get(spark, "p7_mix").cache(), _get(spark, "p7_shares").cache()
    assert abs(shares.agg(F.sum("actual_share")).first()[0] - 1) < 1e-9
    assert chosen.agg(F.sum(F.col("tokens") * F.col("repeats"))).first()[0] == shares.agg(F.sum("tokens")).first()[0] > 0
    limits = _table(spark, "mix_targets").select("source", "max_repeats")
    assert chosen.join(limits, "source").filter("repeats > max_repeats").count() == 0


@tokenizer
def test_p8(spark):
    pieces = _get(spark, "p8_pieces").cache()
    assert _same(_get(spark, "p8_found"), pieces.select("doc_id").distinct()) and pieces.filter("tokens > 2048").count() == 0
    whole = pieces.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", F.expr("substring(text, new_start - start + 1)").alias("t")))), lambda p: p["t"]), "").alias("joined"))
    assert whole.join(_table(spark, "documents"), "doc_id").filter("joined != text").count() == 0
