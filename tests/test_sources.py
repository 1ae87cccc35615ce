import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom import streaming
from ledgerloom.sources import landing, versioned
from ledgerloom.sources import registry as G
from ledgerloom.sources.registry import Call, Endpoint, QuotaSpent, Reply, TooMany, Unavailable, by_cursor, by_offset, by_page, calls, request, reserve, unwrap, validate, wait_seconds


def test_registry():
    child = Endpoint("lines", "t_lines", "/p/{project_id}/c/{parent_id}", "parent", "contracts")
    top = Endpoint("contracts", "t_contracts", "/p/{project_id}/c", "project")
    assert [e.name for e in validate([child, top])] == ["contracts", "lines"]
    assert calls(child, "c9", parents=[("7", "p1"), ("7", "p2")]) == [Call("/p/p1/c/7", {"company_id": "c9"}, "p1"), Call("/p/p2/c/7", {"company_id": "c9"}, "p2")]
    assert calls(Endpoint("x", "x", "/x", "project"), "c9", ["p1"]) == [Call("/x", {"company_id": "c9", "project_id": "p1"}, "p1")]
    assert calls(Endpoint("y", "y", "/co/{company_id}/y"), "c9") == [Call("/co/c9/y", {}, None)]
    for bad in ([child], [top, top], [Endpoint("a", "a", "/{what}", "project")], [Endpoint("a", "a", "/{parent_id}", "company")], [Endpoint("a", "a", "/{parent_id}", "parent", "b"), Endpoint("b", "b", "/{parent_id}", "parent", "a")]):
        with pytest.raises(ValueError):
            validate(bad)
    text = json.dumps([{"name": "lines", "table": "t", "path": "/{parent_id}", "scope": "parent", "parent": "top", "where": ["kind", "x"]}, {"name": "top", "table": "u", "path": "/t"}])
    assert [(e.name, e.where) for e in G.load_registry(text)] == [("top", None), ("lines", ("kind", "x"))]
    with pytest.raises(ValueError):
        G.load_registry('[{"name": "a", "table": "a", "path": "/", "color": 1}]')


def test_waits_and_quota():
    assert wait_seconds({"Retry-After": "1800"}, 1, 0) == 1800 and wait_seconds({"Retry-After": "2000"}, 1, 0, "milliseconds") == 2
    assert wait_seconds({"Retry-After": "soon"}, 2, 0) == 4
    assert wait_seconds({"X-Rate-Limit-Reset": "130"}, 1, 100) == 31 and wait_seconds({"X-Rate-Limit-Reset": "90"}, 1, 100) == 1 and wait_seconds({}, 3, 0) == 8
    assert [reserve(x) for x in (25, 3600, 3, None)] == [5, 20, 2, 20]
    slept, replies = [], [Reply(500), Reply(429, headers={"retry-after": "3"}), Reply(200, [1])]
    assert request(lambda: replies.pop(0), sleep=slept.append, clock=lambda: 0).body == [1] and slept == [2.0, 3.0]
    with pytest.raises(Unavailable):
        request(lambda: Reply(404))
    with pytest.raises(RuntimeError):
        request(lambda: Reply(400))
    with pytest.raises(QuotaSpent):
        request(lambda: Reply(429, headers={"x-rate-limit-reset": "9999"}), sleep=slept.append, clock=lambda: 0)


def _cursor(data, size):
    return lambda p: Reply(200, {"results": data[int(p.get("after", 0)) :][:size], "paging": {"next": {"after": int(p.get("after", 0)) + size}} if int(p.get("after", 0)) + size < len(data) else {}})


def test_pagers():
    data = [{"id": i} for i in range(7)]
    page = lambda p: Reply(200, {"data": data[(p["page"] - 1) * 3 : p["page"] * 3]})
    assert list(by_page(page, 3)) == data
    off = lambda p: Reply(200, {"QueryResponse": {"E": data[int(p["query"].split("STARTPOSITION ")[1].split()[0]) - 1 :][:3]}})
    assert list(by_offset(off, "E", 3)) == data
    cur = _cursor(data, 3)
    assert list(by_cursor(cur, 3)) == data and list(by_cursor(lambda p: Reply(200, {"results": []}), 3)) == []
    with pytest.raises(TooMany):
        list(by_cursor(cur, 3, most=5))
    with pytest.raises(TooMany):  # a source that stops at its cap looks complete
        list(by_cursor(cur, 3, most=7))
    assert unwrap({"id": 1}) == [{"id": 1}] and unwrap(None) == []


def test_conditions_cannot_end_their_literal():
    asked = []
    get = lambda p: asked.append(p["query"]) or Reply(200, {"QueryResponse": {}})
    at = datetime(2025, 1, 2, tzinfo=UTC)
    list(by_offset(get, "E", 3, [G.condition("Name", "=", "O'Hara \\"), G.condition("MetaData.Time", ">=", at), G.condition("n", "<", 3)]))
    assert asked == ["SELECT * FROM E WHERE Name = 'O\\'Hara \\\\' AND MetaData.Time >= '2025-01-02T00:00:00+0000' AND n < 3 STARTPOSITION 1 MAXRESULTS 3"]
    for bad in (("a b", "=", 1), ("a", "; DROP", 1)):
        with pytest.raises(ValueError):
            G.condition(*bad)


def test_incremental_sources():
    now, asked = datetime(2025, 3, 31, tzinfo=UTC), []
    cur = _cursor([{"id": 1}, {"id": 2}], 5)
    assert list(G.changed_since(lambda p: asked.append(p) or cur(p), "changed_at", datetime(2025, 1, 1, tzinfo=UTC), columns=["a"])) == [{"id": 1}, {"id": 2}]
    assert asked[0]["filterGroups"][0]["filters"][0] == {"propertyName": "changed_at", "operator": "GTE", "value": "1735689600000"} and asked[0]["sorts"][0]["direction"] == "ASCENDING" and asked[0]["properties"] == ["a"]
    feed = lambda p: asked.append(p) or Reply(200, {"CDCResponse": [{"QueryResponse": [{"Bill": [{"Id": "1"}], "startPosition": 1}, {"Vendor": [{"Id": "2"}]}]}]})
    assert list(G.change_feed(feed, ["Bill", "Vendor"], datetime(2024, 1, 1, tzinfo=UTC), now)) == [("Bill", {"Id": "1"}), ("Vendor", {"Id": "2"})]
    assert asked[-1]["changedSince"] == f"{now - timedelta(days=29):%Y-%m-%dT%H:%M:%S}-00:00"
    list(G.change_feed(feed, ["Bill"], now - timedelta(days=2), now))
    assert asked[-1]["changedSince"].startswith("2025-03-29")
    assert G.report(lambda p: Reply(200, {"Rows": p}), "Aging", {"x": 1}) == {"id": "Aging", "params": {"x": 1}, "body": {"Rows": {"report": "Aging", "x": 1}}}
    assert G.reference_set(cur) == [{"id": 1}, {"id": 2}]
    assert list(G.active_projects(lambda p: Reply(200, [p] if p["page"] == 1 else []), 5)) == [{"page": 1, "per_page": 5, "filters[by_status]": "Active"}]


def test_pull_counts_and_skips_what_is_not_offered():
    landed = []

    def read(call):
        if call.project == "p2":
            yield {"id": 9}
            raise Unavailable("403")
        yield {"id": call.project}

    e = Endpoint("x", "x", "/{project_id}", "project")
    out = G.pull(e, calls(e, "c", ["p1", "p2", "p3"]), read, lambda *a: landed.append(a[1].project))
    assert (out.records, out.unavailable, landed) == (2, {"x": 1}, ["p1", "p3"])


def test_small_helpers():
    assert G.base_url("https://host.example/42/company/home/", "d") == "https://host.example" and G.base_url(" host.example/x ", "d") == "https://host.example" and G.base_url("", "d") == "d" and G.base_url(None, "d") == "d"
    at = datetime(2025, 1, 1, 12, tzinfo=UTC)
    assert landing.parse_time("2025-01-01T12:00:00Z") == landing.parse_time("2025-01-01T14:00:00+02:00") == landing.parse_time("2025-01-01 12:00:00") == at
    assert landing.parse_time("no") is None and landing.parse_time(None) is None
    assert G.updated_range(at, at + timedelta(hours=1)) == "2025-01-01T12:00:00Z...2025-01-01T13:00:00Z"


def test_token_is_stored_before_it_is_used(spark, tmp_path):
    p, at = str(tmp_path / "tokens"), datetime(2025, 1, 1)
    spark.createDataFrame([("s", "old", at, "b0")], landing.TOKEN).write.parquet(p)
    assert landing.rotate_token(spark, p, "s", lambda old: ("access", old + "+"), "b1", at + timedelta(hours=1)) == "access"
    assert landing.newest_token(spark.read.parquet(p), "s").first().refresh_token == "old+"
    with pytest.raises(LookupError):
        landing.rotate_token(spark, p, "other", lambda old: ("a", "b"), "b1", at)


def test_landing_round_trip(spark, tmp_path):
    at, root = datetime(2025, 1, 1), str(tmp_path / "land")
    for t in ("one", "two"):
        landing.write_landing(spark.createDataFrame([landing.raw_row({"id": t}, "e", at, "b1")], landing.RAW), root, "b1", t)
    got = landing.read_landing(spark, root).collect()
    assert {(r.table_name, r._key, json.loads(r.payload)["id"], r._ingested_at) for r in got} == {("one", "one", "one", at), ("two", "two", "two", at)}


def test_landing_stream_and_marks(spark, tmp_path):
    at = datetime(2025, 1, 1)
    rows = [landing.raw_row({"id": i, "b": 1}, "e", at, "b1") for i in (1, 2)]
    for batch, extra in (("b1", []), ("b2", [landing.raw_row({"id": 1, "b": 2}, "e", datetime(2025, 1, 2), "b2")])):
        df = spark.createDataFrame(rows + extra, landing.RAW)
        landing.write_landing(df, str(tmp_path / "land"), batch, "things")
        streaming.land_available(spark, str(tmp_path / "land"), str(tmp_path / "t"), str(tmp_path / "c"))
    got = versioned.read_table(spark, str(tmp_path / "t"))
    assert {(r._key, r._batch_id) for r in got.collect()} == {("1", "b2"), ("2", "b1")}
    assert landing.newest_batch(spark, str(tmp_path / "land")) == "b2"
    m = str(tmp_path / "m")
    landing.write_mark(spark, m, "t", "e", at, "b1", at)
    landing.write_mark(spark, m, "t", "e", None, "b2", at)
    marks = versioned.read_table(spark, m)
    assert landing.read_mark(marks, "t", "e") == at and landing.read_mark(marks, "x", "e") is None
    assert landing.high_water(spark.createDataFrame([("2025-01-03T00:00:00",), ("no",), (None,)], "t string"), "t") == datetime(2025, 1, 3)
    assert landing.payload_hash({"a": 1, "b": 2}) == landing.payload_hash({"b": 2, "a": 1})


def test_jsonl_and_csv(spark, tmp_path):
    (tmp_path / "b1").mkdir()
    (tmp_path / "b1" / "things.jsonl").write_text('{"_key":"1","payload":"{}"}\nnot json\n')
    assert [(r.table_name, r._key) for r in landing.read_landing(spark, str(tmp_path)).collect()] == [("things", "1")]
    (tmp_path / "x.csv").write_text("a,b\n1,true\n2,\n")
    assert landing.read_csv(spark, str(tmp_path / "x.csv"), "a string, b boolean").filter(F.col("b")).count() == 1
    t = str(tmp_path / "map")
    landing.replace_from_csv(spark, str(tmp_path / "x.csv"), "a string, b boolean", t, ["a"])
    (tmp_path / "y.csv").write_text("a,c\n3,x\n")
    landing.replace_from_csv(spark, str(tmp_path / "y.csv"), "a string, c string", t, ["a"])  # other columns
    assert [tuple(r) for r in versioned.read_table(spark, t).collect()] == [("3", "x")]


def test_events_and_weeks(spark):
    rows = [(datetime(2025, 1, 5, 23), 1.0), (datetime(2025, 1, 6), 2.0), (datetime(2025, 1, 12), 3.0)]
    got = streaming.weekly(spark.createDataFrame(rows, "t timestamp, v double").withColumn("k", F.lit("a")), "t", "v", ["k"]).collect()
    assert {(str(r.week_start), r.amount, r.records) for r in got} == {("2024-12-30", 1.0, 1), ("2025-01-06", 5.0, 2)}


def test_distinct_events_in_a_stream(spark, tmp_path):
    rows = [("a", datetime(2025, 1, 1, 0, 1)), ("a", datetime(2025, 1, 1, 0, 2)), ("b", datetime(2025, 1, 1, 0, 3))]
    spark.createDataFrame(rows, "k string, t timestamp").write.parquet(str(tmp_path / "in"))
    events = spark.readStream.schema("k string, t timestamp").parquet(str(tmp_path / "in"))
    out = streaming.distinct_events(events, "k", "t").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    out.awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
