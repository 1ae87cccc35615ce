import json

from pyspark.sql import functions as F

from ledgerloom.operators import nested

ROW = {
    "id": 3, "Revised Budget": "10.50", "note": None,
    "budget_forecast": {"id": "4 ", "amount": 7.0},
    "wbs_code": {
        "id": 5,
        "segment_items": [{"id": 6, "code": "01", "segment": {"id": 8}}, None, {"id": 7, "code": "02", "segment": None}],
        "attribute_items": [{"id": 9, "values": [{"code": "a"}, {"code": "b"}]}],
    },
}
TIES = {("budget_forecast", "3", "4"), ("segment_item", "3", "6"), ("segment_item", "3", "7"), ("segment", "6", "8"), ("attribute_item", "3", "9")}


def _ties(spark, *payloads):
    rows = spark.createDataFrame([(f"k{i}", p, "x") for i, p in enumerate(payloads)], "_key string, payload string, id string")
    return {tuple(r) for r in nested.ties(nested.flatten(rows, "_key", "payload"), nested.BUDGET_TIES).collect()}


def test_every_wrapping_gives_the_same_ties(spark):
    text = json.dumps(ROW)
    for p in (text, f"[{text}]", json.dumps({"data": ROW}), json.dumps({"items": [ROW]}), json.dumps(text), json.dumps([text])):
        assert _ties(spark, p) == TIES


def test_object_and_list_are_one_shape(spark):
    other = ROW | {"budget_forecast": [{"id": 4}], "wbs_code": {"segment_items": {"id": 6, "segment": [{"id": 8}]}}}
    assert _ties(spark, json.dumps(other)) == {("budget_forecast", "3", "4"), ("segment_item", "3", "6"), ("segment", "6", "8")}


def test_unreadable_and_missing(spark):
    whole = json.dumps(ROW)
    assert _ties(spark, None, "", "{", whole[:90], "null", "7", "[]", "{}", "[[]]", json.dumps({"budget_forecast": {"id": 4}}), json.dumps({"id": None, "budget_forecast": {"id": 4}})) == set()
    assert _ties(spark, whole, whole) == TIES
    assert _ties(spark) == set()


def test_ids_are_trimmed_and_decimal_zeros_dropped(spark):
    assert _ties(spark, json.dumps({"id": 3.0, "budget_forecast": {"id": " 4"}})) == {("budget_forecast", "3", "4")}


def test_nested_lists_keep_distinct_positions():
    rows = nested.pivot({"id": 1, "a": [["x", "y", "z"], ["w"]]})
    assert [(r[1], r[3], r[6].get("value")) for r in rows if r[0] == "a"] == [("0_0", 0, "x"), ("0_1", 1, "y"), ("0_2", 2, "z"), ("1_0", 3, "w")]


def test_round_trip_of_links_and_values(spark):
    rows = nested.pivot(ROW)
    by = {(r[0], r[1]): r for r in rows}
    assert by[("wbs_code.segment_items", "0.2")][2] == "0" and by[("wbs_code.segment_items", "0.2")][6] == {"id": "7", "code": "02"}
    for table, key, up, *_ in rows:
        assert table == "" or (table.rpartition(".")[0], up) in by, key
    count = lambda x: sum(map(count, x.values())) if isinstance(x, dict) else sum(map(count, x)) if isinstance(x, list) else x is not None
    assert sum(len(r[6]) for r in rows) == count(ROW)


def test_table_of_casts(spark):
    df = spark.createDataFrame([("k", json.dumps(ROW))], "_key string, payload string")
    got = nested.table_of(nested.flatten(df, "_key", "payload"), "", {"Revised Budget": "double", "note": "string"}).collect()
    assert [(r.id, r.revised_budget, r.note) for r in got] == [("3", 10.5, None)]


def test_very_long_payload(spark):
    many = {"id": 1, "wbs_code": {"segment_items": [{"id": i} for i in range(2, 30_002)]}}
    assert len(_ties(spark, json.dumps(many))) == 30_000
    deep = "[" * 100_000
    assert _ties(spark, deep) == set()


def test_customer_ties(spark):
    rows = spark.createDataFrame([("2", (" 1 ", "n")), ("2", ("1", "m")), ("3", None), ("4", ("", None)), (None, ("1", None))], "qbo_customer_id string, parentref struct<value:string,name:string>")
    rows = rows.withColumn("kind", F.lit("extra"))
    assert [tuple(r) for r in nested.customer_ties(rows).collect()] == [("customer", "1", "2")]


def test_customers_go_through_flatten(spark):
    rows = spark.createDataFrame([("2", (" 1 ", "n")), ("3", None)], "qbo_customer_id string, parentref struct<value:string,name:string>")
    flat = nested.flatten_customers(rows)
    assert {(r.record_key, r.table, r.parent_key, r.id) for r in flat.collect()} == {("2", "", None, "1"), ("2", "customer", "", "2"), ("3", "", None, None), ("3", "customer", "", "3")}
    plan = nested.customer_ties(rows)._jdf.queryExecution().toString()
    assert "MapInPandas" in plan


def test_a_record_with_a_member_called_like_a_wrapper_stays(spark):
    rows = [(f"k{i}", json.dumps(x)) for i, x in enumerate(({"name": "x", "total": 5, "items": [{"id": 1}, {"id": 2}]}, {"items": [{"id": 3}], "total": 1, "page": None}))]
    flat = nested.flatten(spark.createDataFrame(rows, "_key string, payload string"), "_key", "payload").collect()
    assert {(r.record_key, r.table, r.row_key, r.parent_key, r.id) for r in flat} == {("k0", "", "", None, None), ("k0", "items", "0", "", "1"), ("k0", "items", "1", "", "2"), ("k1", "", "", None, "3")}
    assert next(r.fields for r in flat if r.record_key == "k0" and not r.table) == {"name": "x", "total": "5"}


def test_any_depth(spark):
    n = 20_000
    assert nested.deep("[" * n + "]" * n) is not None
    text = '{"id":1,"a":' * 300 + '{"id":2,"b":[[["x"]]]}' + "}" * 300
    assert nested.deep(text) == json.loads(text)
    many = '{"a":' * 3000 + '{"id":7}' + "}" * 3000
    rows = nested.pivot(nested.deep(many))
    assert len(rows) == 3001 and rows[-1][4] == "7" and rows[-1][2] == rows[-2][1]
    for value in (ROW, [], {}, [1, -2.5e3, "a\\\"\u00e9", None, True, {"x": []}], "text", 7):
        assert nested.deep(json.dumps(value, indent=1)) == value
    for bad in ("", "[", "{", "[1,]", "[1 2]", '{"a" 1}', '{"a":}', "{1:2}", "1 2", "]", "[}", "nul", '{"a":1,}', "[,1]", '{"a":1 "b":2}'):
        try:
            nested.deep(bad)
        except ValueError:
            continue
        raise AssertionError(bad)


def test_unreadable_payloads_are_kept(spark):
    rows = spark.createDataFrame([("a", None), ("b", " "), ("c", "{"), ("d", "[]"), ("e", json.dumps(ROW)), ("f", "7"), ("g", "null"), (None, "x")], "_key string, payload string")
    got = {(r.reason, json.loads(r.row)["key"]) for r in nested.unreadable(rows, "_key", "payload", "t").collect()}
    assert got == {("no payload", "a"), ("no payload", "b"), ("not JSON", "c"), ("no record", "d"), ("no record", "f"), ("no record", "g"), ("not JSON", None)}
