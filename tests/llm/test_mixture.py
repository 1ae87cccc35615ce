import os

import pytest

from ledgerloom.llm import mixture
from ledgerloom.llm.tokens import DEFAULT_RANKS, encoding

pytestmark = pytest.mark.skipif(not os.path.exists(DEFAULT_RANKS), reason="no tokenizer files")
SIZES = "doc_id long, source string, tokens long"
TARGETS = "source string, target_share double, max_repeats int, pass string"


def _chosen(spark, sizes, targets, total=None, **kw):
    s = spark.createDataFrame(sizes, SIZES)
    t = spark.createDataFrame([(*x, "x") for x in targets], TARGETS)
    return mixture.schedule(s, mixture._targets(t), total, **kw).collect()


def _tokens(rows):
    out = {}
    for r in rows:
        out[r.source] = out.get(r.source, 0) + r.tokens
    return out


def test_shares_budget_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(mixture, "ROWS_PER_BUCKET", 50)
    sizes = [(i, "a", 10 + i % 7) for i in range(3000)] + [(10_000 + i, "b", 12) for i in range(100)] + [(20_000, "none", 5)]
    got = _chosen(spark, sizes, [("A ", 0.5, 1), ("b", 0.5, 3), ("missing", 0.2, 4)], 6000)
    t = _tokens(got)
    assert set(t) == {"a", "b"} and abs(t["a"] - 3000) <= 20 and abs(t["b"] - 3000) <= 20 and sum(t.values()) <= 6000
    uses = {}
    for r in got:
        uses[(r.source, r.doc_id)] = uses.get((r.source, r.doc_id), 0) + 1
    assert max(n for (s, _), n in uses.items() if s == "a") == 1 and max(n for (s, _), n in uses.items() if s == "b") <= 3
    again = _chosen(spark, sizes[::-1], [("A ", 0.5, 1), ("b", 0.5, 3), ("missing", 0.2, 4)], 6000)
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_small_source_runs_out(spark):
    got = _tokens(_chosen(spark, [(i, "a", 10) for i in range(500)] + [(900, "b", 10)], [("a", 0.5, 1), ("b", 0.5, 2)], 1000))
    assert got == {"a": 980, "b": 20}


def test_default_budget_keeps_every_share(spark):
    got = _tokens(_chosen(spark, [(i, "a", 10) for i in range(500)] + [(900 + i, "b", 10) for i in range(10)], [("a", 0.8, 1), ("b", 0.2, 2)]))
    assert got["b"] == 200 and abs(got["a"] - 800) <= 10


def test_edges(spark):
    assert _chosen(spark, [], [("a", 1.0, 1)]) == [] and _chosen(spark, [(1, "a", 5)], []) == []
    assert _chosen(spark, [(1, "a", 5)], [(None, 1.0, 1), ("a", None, 1), ("a", 0.0, 1), ("a", 0.5, 0), ("a", 0.5, None)]) == []
    assert len(_chosen(spark, [(1, "a", 5), (2, "a", 5)], [("a", 0.3, 1), ("a", 0.7, 1)])) == 2


def test_labels_and_tokens(spark):
    docs = spark.createDataFrame([(1, "Daily Log", "one two"), (2, " daily_log", "<|endoftext|>"), (3, "daily-log ", ""), (4, None, "x"), (5, "x", None), (6, " - ", "t"), (7, "DAILY  LOG", "y" * 50_000)], "doc_id long, source string, text string")
    t = spark.createDataFrame([("daily_log", 0.9, 1, "x"), ("gone", 0.1, 1, "x")], TARGETS)
    got = {r.doc_id: (r.source, r.tokens) for r in mixture.sized(docs, mixture._targets(t)).collect()}
    enc = encoding(DEFAULT_RANKS)
    assert set(got) == {1, 2, 7} and {s for s, _ in got.values()} == {"daily_log"} and got[1][1] == 2 and got[2][1] == len(enc.encode_ordinary("<|endoftext|>")) > 1
    rows = {r.source: r for r in mixture.shares(docs, t).collect()}
    assert rows["daily_log"].actual_share == 1.0 and rows["gone"].tokens == 0


def test_only_wanted_sources_are_tokenised_and_targets_are_checked(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a", "one two"), (2, "b", "three")], "doc_id long, source string, text string")
    t = spark.createDataFrame([("a", 1.0, 1, "x"), ("c", 1.0, 1, "x")], TARGETS)
    assert [r.doc_id for r in mixture.sized(docs, mixture._targets(t)).collect()] == [1]
    monkeypatch.setattr(mixture, "MAX_TARGETS", 1)
    with pytest.raises(ValueError):
        mixture.mix(docs, t)
