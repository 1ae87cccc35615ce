"""One query for each operator of the engine, with equivalent SQL.

The order and line tables stand in for contracts, budgets and ledgers: a customer is a project, its
orders are contracts (F), billings (O) and changes (1-URGENT), its lines are costs, suppliers are
vendors and events are time entries. Dates are judged as of AS_OF, never as of the day of the run.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import streaming
from ledgerloom.functions import columns as C
from ledgerloom.operators import measures as M
from ledgerloom.operators import nested, profile, quality
from ledgerloom.operators import rows as R
from ledgerloom.plans import pipeline
from ledgerloom.runtime import cut, shared_folder, table
from ledgerloom.skew import join_salted
from ledgerloom.sources import landing, registry, versioned

AS_OF = date(2000, 1, 1)
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def cents(c: Column | str) -> Column:
    """A sum of money that doesn't depend on the order of addition."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(F.sum(c.cast("decimal(18,4)")), 2).cast("double")


def _cents(x: str) -> str:
    return f"CAST(ROUND(SUM(CAST({x} AS DECIMAL(18,4))), 2) AS DOUBLE)"


def _norm(x: str) -> str:
    return f"upper(regexp_replace(coalesce({x}, ''), '[^A-Za-z0-9]', '', 'g'))"


# --- projections, filters, scalar functions ------------------------------------------------------


@query("SELECT CAST(c_custkey AS VARCHAR) AS project_id, c_name AS project_name, CAST(c_nationkey AS VARCHAR) AS office_id, CAST(c_acctbal AS DOUBLE) AS balance FROM customer")
def scan_conform(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("project_id"), F.col("c_name").alias("project_name"), F.col("c_nationkey").alias("office_id"), F.col("c_acctbal").alias("balance"))
    return R.conform(rows, "project_id string, project_name string, office_id string, balance double")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def json_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", C.json_path(F.col("props"), "k").try_cast("int").alias("k"))


@query("SELECT c_custkey, CAST(c_name AS VARCHAR) AS full_name, c_nationkey AS nation FROM customer")
def json_bracket_key(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "customer").select("c_custkey", F.to_json(F.struct(F.col("c_name").alias("Full Name"), F.col("c_nationkey").alias("Nation Key"))).alias("payload"))
    return raw.select("c_custkey", C.json_path(F.col("payload"), "Full Name").alias("full_name"), C.json_path(F.col("payload"), "Nation Key").try_cast("int").alias("nation"))


_REJECT = "CASE WHEN nullif(trim(project_name), '') IS NULL THEN 'name' WHEN nullif(trim(project_number), '') IS NULL THEN 'number' END"


@query(f"SELECT coalesce({_REJECT}, 'accepted') AS outcome, count(*) AS n FROM dl_silver_projects GROUP BY 1")
def reject_split(spark: SparkSession, d: str) -> DataFrame:
    has = lambda c: F.nullif(F.trim(c), F.lit("")).isNotNull()
    good, bad = R.split_rejects(table(spark, d, "dl_silver_projects"), {"name": has("project_name"), "number": has("project_number")}, "projects")
    return good.select(F.lit("accepted").alias("outcome")).unionByName(bad.select(F.col("reason").alias("outcome"))).groupBy("outcome").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('A','R') AND NOT l_linestatus = 'O'")
def in_list(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").filter(F.col("l_returnflag").isin("A", "R") & ~(F.col("l_linestatus") == "O")).select("l_orderkey", "l_linenumber", "l_returnflag")


_LOW, _HIGH = date(1996, 1, 1), date(1999, 12, 31)


@query("SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS month_start, NOT (CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31') AS is_out FROM orders")
def between_month_key(spark: SparkSession, d: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", C.month_key(day, _LOW, _HIGH).alias("month_start"), C.out_of_range(day, False, _LOW, _HIGH).alias("is_out"))


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%' || 'an' || '%'")
def contains_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").filter(F.contains("p_name", F.lit("an"))).select("p_partkey", "p_name")


_DUE = "CAST(o_orderdate AS DATE) + 30"
_BUCKET = f"CASE WHEN o_orderdate IS NULL THEN 'Unknown' WHEN date_diff('day', {_DUE}, DATE '2000-01-01') <= 0 THEN 'Current' WHEN date_diff('day', {_DUE}, DATE '2000-01-01') <= 30 THEN '1-30' WHEN date_diff('day', {_DUE}, DATE '2000-01-01') <= 60 THEN '31-60' WHEN date_diff('day', {_DUE}, DATE '2000-01-01') <= 90 THEN '61-90' ELSE '90+' END"


@query(f"SELECT {_BUCKET} AS bucket, count(*) AS n, {_cents('o_totalprice')} AS amount FROM orders GROUP BY 1")
def bucket_case(spark: SparkSession, d: str) -> DataFrame:
    bucket = C.aging_bucket(AS_OF, F.date_add(F.to_date("o_orderdate"), 30))
    return table(spark, d, "orders").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), cents("o_totalprice").alias("amount"))


@query("SELECT vendor_id, coalesce(nullif(regexp_replace(vendor_name, '^ +| +$', '', 'g'), ''), nullif(regexp_replace(trade_name, '^ +| +$', '', 'g'), ''), nullif(regexp_replace(vendor_abbrev, '^ +| +$', '', 'g'), ''), 'Unknown') AS shown, count(*) AS n FROM dl_silver_vendors GROUP BY 1, 2")
def coalesce_chain(spark: SparkSession, d: str) -> DataFrame:
    first = F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in ("vendor_name", "trade_name", "vendor_abbrev")], F.lit("Unknown"))
    return table(spark, d, "dl_silver_vendors").groupBy("vendor_id", first.alias("shown")).agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount <> 0 THEN round(l_tax / l_discount, 6) + 0.0 ELSE 0.0 END AS ratio FROM lineitem")
def safe_ratio(spark: SparkSession, d: str) -> DataFrame:
    ratio = F.round(C.safe_ratio(F.col("l_tax"), F.col("l_discount")), 6) + F.lit(0.0)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", ratio.alias("ratio"))


_BUILT = "coalesce(original_budget,0) + coalesce(approved_budget_changes,0) + coalesce(budget_modifications,0)"


@query(f"SELECT budget_line_id, _batch_id AS batch, round(CASE WHEN revised_budget <> 0 THEN revised_budget ELSE {_BUILT} END, 2) AS revised, count(*) AS n FROM dl_silver_budget_lines GROUP BY 1, 2, 3")
def derived_unless_present(spark: SparkSession, d: str) -> DataFrame:
    z = lambda c: F.coalesce(c, F.lit(0.0))
    built = z("original_budget") + z("approved_budget_changes") + z("budget_modifications")
    rows = table(spark, d, "dl_silver_budget_lines").select("budget_line_id", F.col("_batch_id").alias("batch"), F.round(C.unless_present(F.col("revised_budget"), built), 2).alias("revised"))
    return rows.groupBy("budget_line_id", "batch", "revised").agg(F.count("*").alias("n"))


@query(f"SELECT DISTINCT vendor_name, {_norm('vendor_name')} AS norm FROM dl_silver_vendors")
def norm_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dl_silver_vendors").select("vendor_name", C.norm_key(F.col("vendor_name")).alias("norm")).distinct()


@query("SELECT project_id, CASE WHEN start_date >= DATE '1990-01-01' THEN start_date END AS start_date, count(*) AS n FROM dl_silver_projects GROUP BY 1, 2")
def date_floor(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "dl_silver_projects").select("project_id", C.iso_date_floor(F.col("start_date").cast("string")).alias("start_date"))
    return rows.groupBy("project_id", "start_date").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT p_name, p_type, CAST(((200*least(length(p_name),length(p_type)) + greatest(length(p_name),length(p_type),1)) // (2*greatest(length(p_name),length(p_type),1))) / 100.0 AS DOUBLE) AS affinity FROM part")
def length_affinity(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_name", "p_type", C.length_affinity(F.col("p_name"), F.col("p_type")).alias("affinity")).distinct()


@query("SELECT event_id, lower(trim(CASE WHEN event_type = 'click' THEN ' TRUE ' ELSE event_type END)) = 'true' AS flag FROM events")
def json_bool(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("event_type") == "click", " TRUE ").otherwise(F.col("event_type"))
    return table(spark, d, "events").select("event_id", C.json_bool_str(raw).alias("flag"))


@query("SELECT event_id, round(floor(value) + CAST(json_extract_string(props, '$.k') AS INT) / 60.0, 6) AS hours, upper(event_type) IN ('CLICK','PURCHASE') AS billable FROM events")
def hours_minutes(spark: SparkSession, d: str) -> DataFrame:
    h = C.hours(F.floor("value"), C.json_path(F.col("props"), "k").try_cast("int"))
    return table(spark, d, "events").select("event_id", F.round(h, 6).alias("hours"), C.is_billable(_billing_status()).alias("billable"))


def _billing_status() -> Column:
    """Clicks and purchases stand for time that is billed or can be."""
    return F.when(F.col("event_type") == "click", "Billable").when(F.col("event_type") == "purchase", "HasBeenBilled").otherwise("NotBillable")


@query("SELECT c_custkey, sha256(CAST(to_json({'c_custkey': c_custkey, 'c_mktsegment': c_mktsegment, 'c_name': c_name}) AS VARCHAR)) AS hash FROM customer")
def row_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", C.row_hash("c_name", "c_custkey", "c_mktsegment").alias("hash"))


@query("""SELECT CAST(x AS DATE) AS day, CAST(year(x) AS INT) AS year, CAST(month(x) AS INT) AS month, CAST(quarter(x) AS INT) AS quarter,
  CAST(date_trunc('month', x) AS DATE) AS month_start, last_day(CAST(x AS DATE)) AS month_end, strftime(x, '%b %Y') AS month_year, CAST((year(x)*12+month(x)) - (2000*12+1) AS INT) AS month_offset,
  CAST(date_trunc('week', x) AS DATE) AS week_start FROM generate_series(DATE '2015-01-01', DATE '2035-12-31', INTERVAL 1 DAY) t(x)""")
def calendar(spark: SparkSession, d: str) -> DataFrame:
    days = spark.range(1).select(F.explode(F.sequence(F.lit(C.CALENDAR_FIRST), F.lit(C.CALENDAR_LAST))).alias("day"))
    y, m = F.year("day"), F.month("day")
    return days.select(
        "day", y.alias("year"), m.alias("month"), F.quarter("day").alias("quarter"), F.trunc("day", "MM").alias("month_start"), F.last_day("day").alias("month_end"),
        F.date_format("day", "MMM yyyy").alias("month_year"), (y * 12 + m - (AS_OF.year * 12 + AS_OF.month)).alias("month_offset"), F.to_date(F.date_trunc("week", "day")).alias("week_start"),
    )


@query("""WITH lines AS (SELECT l_orderkey, unnest(list(struct_pack(n := l_linenumber, p := l_partkey, a := l_extendedprice, s := l_linestatus))) AS l, l_returnflag FROM lineitem GROUP BY l_orderkey, l_returnflag)
SELECT l_orderkey AS txn_id, l.n AS line_id, l.p AS part, round(l.a * CASE WHEN l_returnflag = 'R' THEN -1.0 ELSE 1.0 END * CASE WHEN l.s = 'O' THEN -1.0 ELSE 1.0 END, 2) AS posted, count(*) AS copies FROM lines GROUP BY 1, 2, 3, 4""")
def gl_lines(spark: SparkSession, d: str) -> DataFrame:
    line = F.struct(F.col("l_linenumber").alias("Id"), F.col("l_partkey").alias("Part"), F.col("l_extendedprice").alias("Amount"), F.when(F.col("l_linestatus") == "O", "Credit").otherwise("Debit").alias("PostingType"))
    docs = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", F.to_json(F.struct(F.array(line).alias("Line"))).alias("payload"))
    parsed = F.from_json("payload", "Line array<struct<Id:int,Part:long,Amount:double,PostingType:string>>")
    sign = F.when(F.col("l_returnflag") == "R", -1.0).otherwise(1.0)
    each = docs.select("l_orderkey", sign.alias("sign"), F.explode(parsed["Line"]).alias("l")).filter("l.Amount is not null")
    posted = F.round(C.signed(F.col("l.Amount"), F.col("sign"), F.col("l.PostingType")), 2)
    return each.groupBy(F.col("l_orderkey").alias("txn_id"), F.col("l.Id").alias("line_id"), F.col("l.Part").alias("part"), posted.alias("posted")).agg(F.count("*").alias("copies"))


_KEYED = {"dl_silver_projects": "project_number", "dl_silver_qbo_customers": "parent_customer_id", "dl_silver_vendors": "vendor_name", "dl_silver_qbo_vendors": "vendor_name", "dl_silver_cost_codes": "cost_code", "dl_silver_budget_lines": "wbs_code_id"}


@query(" UNION ALL ".join(f"SELECT '{t}' AS source_table, '{c}' AS reason, count(*) AS n FROM {t} WHERE nullif(regexp_replace({c}, '^ +| +$', '', 'g'), '') IS NULL HAVING count(*) > 0" for t, c in _KEYED.items()))
def rejects_union(spark: SparkSession, d: str) -> DataFrame:
    """Rows of six sources that lack what they are keyed by, with whole rows kept as JSON, counted here."""
    bad = [R.split_rejects(table(spark, d, t), {c: F.nullif(F.trim(c), F.lit("")).isNotNull()}, t)[1] for t, c in _KEYED.items()]
    return R.union_rejects(*bad).groupBy("source_table", "reason").agg(F.count("*").alias("n"))


# --- joins ---------------------------------------------------------------------------------------

_PROJECT_DIM = """SELECT c_custkey AS project_key, coalesce(c_name, 'Unknown') AS project_name, coalesce(n_name, 'Unassigned') AS office, coalesce(r_name, 'Unassigned') AS region, coalesce(k.contract, 0.0) AS contract, k.project_key IS NOT NULL AS has_contract
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT o_custkey AS project_key, %s AS contract FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) k ON k.project_key = c_custkey""" % _cents("o_totalprice")


def _by_project(spark: SparkSession, d: str, status: str, name: str) -> DataFrame:
    rows = table(spark, d, "orders").filter(F.col("o_orderstatus") == status)
    return rows.groupBy(F.col("o_custkey").alias("project_key")).agg(cents("o_totalprice").alias(name))


@query(_PROJECT_DIM)
def project_dim(spark: SparkSession, d: str) -> DataFrame:
    c, n, r = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "region")
    k = _by_project(spark, d, "F", "contract").withColumn("has", F.lit(True))
    rows = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    rows = rows.withColumnRenamed("c_custkey", "project_key").join(k, "project_key", "left")
    return rows.select(
        "project_key", C.text_or(F.col("c_name"), "Unknown").alias("project_name"), C.text_or(F.col("n_name"), "Unassigned").alias("office"), C.text_or(F.col("r_name"), "Unassigned").alias("region"),
        F.coalesce("contract", F.lit(0.0)).alias("contract"), F.col("has").isNotNull().alias("has_contract"),
    )


_WIP_COST = f"""SELECT o_custkey AS project_key, {_cents("l_extendedprice * (1 - l_discount)")} AS estimate, {_cents("CASE WHEN CAST(l_shipdate AS DATE) <= DATE '2000-01-01' THEN l_extendedprice * (1 - l_discount) ELSE 0 END")} AS spent
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"""
_WIP = f"""SELECT c_custkey AS project_key, coalesce(k.contract,0.0) AS contract, coalesce(e.estimate,0.0) AS estimate, coalesce(e.spent,0.0) AS spent, coalesce(b.billed,0.0) AS billed,
  round(CASE WHEN coalesce(e.estimate,0.0) <> 0 THEN coalesce(e.spent,0.0)/e.estimate ELSE 0.0 END, 6) AS complete
FROM customer LEFT JOIN (SELECT o_custkey AS project_key, {_cents('o_totalprice')} AS contract FROM orders WHERE o_orderstatus='F' GROUP BY 1) k ON k.project_key = c_custkey
LEFT JOIN (SELECT o_custkey AS project_key, {_cents('o_totalprice')} AS billed FROM orders WHERE o_orderstatus='O' GROUP BY 1) b ON b.project_key = c_custkey
LEFT JOIN ({_WIP_COST}) e ON e.project_key = c_custkey WHERE coalesce(k.contract,0.0) <> 0 OR coalesce(e.estimate,0.0) <> 0"""


def _wip(spark: SparkSession, d: str) -> DataFrame:
    """Every input is brought to one row per project before the joins, so they all meet on one
    partitioning and can't multiply rows."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("project_key"))
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    li = table(spark, d, "lineitem").select("l_orderkey", net.alias("net"), (F.to_date("l_shipdate") <= F.lit(AS_OF)).alias("done"))
    cost = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("project_key").agg(cents("net").alias("estimate"), cents(F.when(F.col("done"), F.col("net")).otherwise(F.lit(0.0))).alias("spent"))
    base = table(spark, d, "customer").select(F.col("c_custkey").alias("project_key"))
    for part in (_by_project(spark, d, "F", "contract"), _by_project(spark, d, "O", "billed"), cost):
        base = base.join(part, "project_key", "left")
    rows = base.fillna(0.0).withColumn("complete", F.round(C.safe_ratio(F.col("spent"), F.col("estimate")), 6))
    return rows.filter("contract != 0 or estimate != 0").select("project_key", "contract", "estimate", "spent", "billed", "complete")


@query(_WIP)
def wip_schedule(spark: SparkSession, d: str) -> DataFrame:
    return _wip(spark, d)


@query("SELECT o_orderkey, o_custkey, c_custkey AS project_key FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0")
def cost_mapped_left(spark: SparkSession, d: str) -> DataFrame:
    mapped = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("project_key"))
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").join(mapped, F.col("o_custkey") == F.col("project_key"), "left")


@query("SELECT o_orderkey, c_custkey AS project_key FROM orders JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING'")
def billing_mapped_inner(spark: SparkSession, d: str) -> DataFrame:
    mapped = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("project_key"))
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").join(mapped, F.col("o_custkey") == F.col("project_key")).select("o_orderkey", "project_key")


@query(f"SELECT p_type, {_cents('l_extendedprice')} AS amount, count(*) AS n FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE p_brand IN ('Brand#11','Brand#12','Brand#13') GROUP BY 1")
def job_cost_only(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").filter(F.col("p_brand").isin("Brand#11", "Brand#12", "Brand#13")).select("p_partkey", "p_type")
    li = table(spark, d, "lineitem").select("l_partkey", "l_extendedprice")
    return li.join(p, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type").agg(cents("l_extendedprice").alias("amount"), F.count("*").alias("n"))


def _numbers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dl_silver_projects").select("project_id", C.norm_key(F.col("project_number")).alias("number")).filter("length(number) >= 3").distinct()


def _jobs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "dl_silver_qbo_customers").filter(F.coalesce("is_active", F.lit(False)) & (F.coalesce("is_job", F.lit(False)) | F.coalesce("is_project", F.lit(False))))
    return rows.select("qbo_customer_id", C.norm_key(F.col("fully_qualified_name")).alias("full_name"), C.norm_key(F.col("display_name")).alias("name")).distinct()


_SQL_NUMBERS = f"numbers AS (SELECT DISTINCT project_id, {_norm('project_number')} AS number FROM dl_silver_projects WHERE length({_norm('project_number')}) >= 3)"
_SQL_JOBS = f"jobs AS (SELECT DISTINCT qbo_customer_id, {_norm('fully_qualified_name')} AS full_name, {_norm('display_name')} AS name FROM dl_silver_qbo_customers WHERE coalesce(is_active, false) AND (coalesce(is_job, false) OR coalesce(is_project, false)))"
_SQL_EXACT = "exact AS (SELECT DISTINCT project_id, qbo_customer_id FROM numbers JOIN jobs ON contains(full_name, number) OR contains(name, number))"


def _exact(spark: SparkSession, d: str) -> DataFrame:
    jobs = _jobs(spark, d)
    texts = jobs.select("qbo_customer_id", F.explode(F.array("full_name", "name")).alias("text")).distinct()
    return R.contains_pairs(_numbers(spark, d), "number", texts, "text").select("project_id", "qbo_customer_id").distinct()


@query(f"WITH {_SQL_NUMBERS}, {_SQL_JOBS}, {_SQL_EXACT} SELECT * FROM exact")
def exact_number_match(spark: SparkSession, d: str) -> DataFrame:
    return _exact(spark, d)


_SQL_NAMES = f"names AS (SELECT DISTINCT project_id, {_norm('project_name')} AS pname FROM dl_silver_projects WHERE length({_norm('project_name')}) >= 8)"
_SQL_SCORED = """scored AS (SELECT project_id, qbo_customer_id, CAST(max(((200*least(length(pname),length(name)) + greatest(length(pname),length(name),1)) // (2*greatest(length(pname),length(name),1))) / 100.0) AS DOUBLE) AS score
  FROM names JOIN jobs ON substr(pname,1,8) = substr(name,1,8) AND length(name) >= 8 WHERE project_id NOT IN (SELECT project_id FROM exact) GROUP BY 1, 2)"""
_SQL_BEST = "best AS (SELECT project_id, max(qbo_customer_id) AS qbo_customer_id, max(score) AS score FROM scored GROUP BY 1 HAVING count(*) = 1 AND max(score) >= 0.8)"
_SQL_MATCH = f"WITH {_SQL_NUMBERS}, {_SQL_JOBS}, {_SQL_EXACT}, {_SQL_NAMES}, {_SQL_SCORED}, {_SQL_BEST}"


def _scored(spark: SparkSession, d: str, exact: DataFrame | None = None) -> DataFrame:
    """Pairs of projects and jobs whose names begin alike, of projects without an exact match; a crowded beginning is split."""
    exact = _exact(spark, d) if exact is None else exact
    names = table(spark, d, "dl_silver_projects").select("project_id", C.norm_key(F.col("project_name")).alias("pname")).filter("length(pname) >= 8").distinct()
    names = names.join(exact.select("project_id").distinct(), "project_id", "left_anti").withColumn("block", F.substring("pname", 1, 8))
    jobs = _jobs(spark, d).filter("length(name) >= 8").select("qbo_customer_id", "name", F.substring("name", 1, 8).alias("block")).distinct()
    pairs = join_salted(names, jobs, "block").withColumn("score", C.length_affinity(F.col("pname"), F.col("name")))
    return pairs.groupBy("project_id", "qbo_customer_id").agg(F.max("score").alias("score"))


def _matched(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Exact and scored pairs, each computed once for all that read them."""
    exact = cut(_exact(spark, d))
    return exact, cut(_scored(spark, d, exact))


@query(f"{_SQL_MATCH} SELECT * FROM scored")
def prefix_block_match(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d)


@query(f"{_SQL_MATCH} SELECT * FROM best")
def unambiguous_best(spark: SparkSession, d: str) -> DataFrame:
    return R.unambiguous_best(_scored(spark, d), "project_id", "qbo_customer_id", "score", 0.8)


def _crosswalk(spark: SparkSession, d: str, matched: tuple[DataFrame, DataFrame], manual: DataFrame | None = None) -> DataFrame:
    """One row per project: its mapping by precedence; an inactive manual one leaves it unmapped, whatever else matches."""
    exact = matched[0].select("project_id", "qbo_customer_id", F.lit(1.0).alias("confidence"), F.lit("exact_number").alias("method"))
    fuzzy = R.unambiguous_best(matched[1], "project_id", "qbo_customer_id", "score", 0.8).select("project_id", "qbo_customer_id", F.col("score").alias("confidence"), F.lit("fuzzy_name").alias("method"))
    pool = exact.unionByName(fuzzy)
    if manual is not None:
        told = R.with_tombstones(manual, "qbo_customer_id", "active").drop("active")
        pool = pool.unionByName(told.withColumns({"confidence": F.lit(1.0), "method": F.lit("manual")}))
    best = R.by_precedence(pool, ["project_id"], "method", ["manual", "exact_number", "fuzzy_name"], [F.desc("confidence"), F.asc("qbo_customer_id")])
    every = table(spark, d, "dl_silver_projects").select("project_id").filter("project_id is not null").distinct()
    return every.join(best, "project_id", "left").select("project_id", "qbo_customer_id", F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("method", F.lit("unmatched")).alias("method"), F.col("qbo_customer_id").isNotNull().alias("is_mapped"))


_SQL_CROSS = f"""{_SQL_MATCH}, pool AS (SELECT project_id, qbo_customer_id, 1.0::DOUBLE AS confidence, 'exact_number' AS method, 1 AS r FROM exact UNION ALL SELECT project_id, qbo_customer_id, score, 'fuzzy_name', 2 FROM best),
ranked AS (SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY r, confidence DESC, qbo_customer_id) AS rn FROM pool),
every AS (SELECT DISTINCT project_id FROM dl_silver_projects WHERE project_id IS NOT NULL),
crosswalk AS (SELECT every.project_id, ranked.qbo_customer_id, coalesce(confidence, 0.0) AS confidence, coalesce(method, 'unmatched') AS method, ranked.qbo_customer_id IS NOT NULL AS is_mapped FROM every LEFT JOIN ranked ON every.project_id = ranked.project_id AND rn = 1)"""


@query(f"{_SQL_CROSS} SELECT * FROM crosswalk")
def precedence_rank(spark: SparkSession, d: str) -> DataFrame:
    return _crosswalk(spark, d, _matched(spark, d))


_SQL_TOMB = _SQL_CROSS.replace("UNION ALL SELECT project_id, qbo_customer_id, score, 'fuzzy_name', 2 FROM best", """UNION ALL SELECT project_id, qbo_customer_id, score, 'fuzzy_name', 2 FROM best
  UNION ALL SELECT project_id, CASE WHEN bool_and(coalesce(is_active, false)) THEN '500000000' END, 1.0, 'manual', 0 FROM dl_silver_projects WHERE project_id IS NOT NULL AND stage = 'Closeout' GROUP BY 1""")


@query(f"{_SQL_TOMB} SELECT * FROM crosswalk")
def crosswalk_tombstone(spark: SparkSession, d: str) -> DataFrame:
    """Projects in closeout were mapped by hand to one client; of those no longer active the mapping is a tombstone."""
    p = table(spark, d, "dl_silver_projects").filter("project_id is not null and stage = 'Closeout'")
    manual = p.groupBy("project_id").agg(F.lit("500000000").alias("qbo_customer_id"), F.bool_and(F.coalesce("is_active", F.lit(False))).alias("active"))
    return _crosswalk(spark, d, _matched(spark, d), manual)


@query(f"{_SQL_CROSS} SELECT c.project_id, s.qbo_customer_id AS candidate, s.score, CASE WHEN s.project_id IS NULL THEN 'unmatched' ELSE 'below_confidence' END AS reason FROM crosswalk c LEFT JOIN scored s ON c.project_id = s.project_id WHERE NOT c.is_mapped")
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    matched = _matched(spark, d)
    mapped = _crosswalk(spark, d, matched).filter("is_mapped").select("project_id")
    todo = table(spark, d, "dl_silver_projects").select("project_id").filter("project_id is not null").distinct().join(mapped, "project_id", "left_anti")
    seen = matched[1].withColumnRenamed("qbo_customer_id", "candidate")
    return todo.join(seen, "project_id", "left").withColumn("reason", F.when(F.col("candidate").isNull(), "unmatched").otherwise("below_confidence"))


_CODE_ID = r"nullif(regexp_extract(trim(cost_code_id), '^0*(\d{9})(?:\.0*)?$', 1), '')"


def _code_id(c: str) -> Column:
    return F.nullif(F.regexp_extract(F.trim(c), r"^0*(\d{9})(?:\.0*)?$", 1), F.lit(""))


@query("SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL) GROUP BY 1")
def observed_not_defined(spark: SparkSession, d: str) -> DataFrame:
    """Orders that no line defines, by customer."""
    known = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).filter("o_orderkey is not null").distinct()
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").join(known, "o_orderkey", "left_anti").groupBy("o_custkey").agg(F.count("*").alias("n"))


@query("SELECT c.parent_cost_code_id, count(*) AS n FROM dl_silver_cost_codes c LEFT JOIN (SELECT DISTINCT root_cost_code_id AS k FROM dl_silver_budget_lines) b ON b.k = c.parent_cost_code_id WHERE b.k IS NULL AND c.parent_cost_code_id IS NOT NULL GROUP BY 1")
def orphans(spark: SparkSession, d: str) -> DataFrame:
    t = {"codes": table(spark, d, "dl_silver_cost_codes"), "budget": table(spark, d, "dl_silver_budget_lines")}
    return quality.referential("codes", "parent_cost_code_id", "budget", "root_cost_code_id").rows(t).groupBy("parent_cost_code_id").agg(F.count("*").alias("n"))


@query("SELECT r.expectation, r.severity, r.failing_rows, CASE WHEN r.passed THEN 3 WHEN r.severity = 'error' THEN 1 ELSE 2 END AS severity_sort, count(*) AS n FROM dl_dq_results r CROSS JOIN (SELECT max(batch_id) AS b FROM dl_dq_results) m WHERE r.batch_id = m.b GROUP BY ALL")
def latest_run_cross(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "dl_dq_results")
    newest = rows.agg(F.max("batch_id").alias("b"))  # one row
    sort = F.when(F.col("passed"), 3).when(F.col("severity") == "error", 1).otherwise(2)
    return rows.join(F.broadcast(newest), F.col("batch_id") == F.col("b")).groupBy("expectation", "severity", "failing_rows", sort.alias("severity_sort")).agg(F.count("*").alias("n"))


_FLOW = f"""flows AS (SELECT CAST(date_trunc('week', CAST(o_orderdate AS DATE) + 30) AS DATE) AS week, 'Collections' AS flow, o_totalprice AS amount FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT CAST(date_trunc('week', CAST(l_shipdate AS DATE) + 30) AS DATE), 'Payments', -l_extendedprice FROM lineitem),
weeks AS (SELECT CAST(x AS DATE) AS week_start FROM generate_series(DATE '1999-11-29', DATE '2000-06-26', INTERVAL 7 DAY) t(x)),
cash AS (SELECT week_start, coalesce(flow, 'Collections') AS flow, coalesce({_cents('amount')}, 0.0) AS amount, count(amount) AS documents FROM weeks LEFT JOIN flows ON greatest(week, DATE '1999-12-27') = week_start AND week >= DATE '1990-01-01' GROUP BY 1, 2)"""


def _cash(spark: SparkSession, d: str) -> DataFrame:
    """Open items by the week they fall due, on a spine of weeks; what is overdue falls into this week."""
    week = lambda c: F.to_date(F.date_trunc("week", F.date_add(F.to_date(c), 30)))
    ar = table(spark, d, "orders").filter("o_orderstatus = 'O'").select(week("o_orderdate").alias("week"), F.lit("Collections").alias("flow"), F.col("o_totalprice").alias("amount"))
    ap = table(spark, d, "lineitem").select(week("l_shipdate").alias("week"), F.lit("Payments").alias("flow"), (-F.col("l_extendedprice")).alias("amount"))
    due = ar.unionByName(ap).filter("week >= date '1990-01-01'").withColumn("week_start", F.greatest("week", F.lit(date(1999, 12, 27))))
    sums = due.groupBy("week_start", "flow").agg(cents("amount").alias("amount"), F.count("amount").alias("documents"))
    weeks = spark.range(1).select(F.explode(F.sequence(F.lit(date(1999, 11, 29)), F.lit(date(2000, 6, 26)), F.expr("interval 7 days"))).alias("week_start"))
    return R.spine_left(weeks, sums, ["week_start"], {"flow": "Collections", "amount": 0.0, "documents": 0})


@query(f"WITH {_FLOW} SELECT * FROM cash")
def week_spine_cash(spark: SparkSession, d: str) -> DataFrame:
    return _cash(spark, d)


@query(f"WITH {_FLOW}, net AS (SELECT week_start, {_cents('amount')} AS net FROM cash GROUP BY 1) SELECT week_start, net, round(sum(net) OVER (ORDER BY week_start ROWS UNBOUNDED PRECEDING), 2) AS running FROM net")
def cumulative_cash(spark: SparkSession, d: str) -> DataFrame:
    net = _cash(spark, d).groupBy("week_start").agg(cents("amount").alias("net"))
    return M.running_total(net, "net", "week_start").withColumn("running", F.round("running", 2))


_STAGES = [("1-URGENT", 0.9), ("2-HIGH", 0.6), ("3-MEDIUM", 0.4)]
_SQL_STAGES = "stages(stage, p) AS (VALUES ('1-URGENT', 0.9::DOUBLE), ('2-HIGH', 0.6::DOUBLE), ('3-MEDIUM', 0.4::DOUBLE))"


@query(f"WITH {_SQL_STAGES} SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'P' THEN 0.75 END, p, 0.0)::DOUBLE AS probability, CAST(round(CAST(o_totalprice AS DECIMAL(18,4)) * CAST(coalesce(CASE WHEN o_orderstatus = 'P' THEN 0.75 END, p, 0.0) AS DECIMAL(4,2)), 2) AS DOUBLE) AS weighted FROM orders LEFT JOIN stages ON o_orderpriority = stage")
def weighted_pipeline(spark: SparkSession, d: str) -> DataFrame:
    stages = spark.createDataFrame(_STAGES, "stage string, p double")
    own = F.when(F.col("o_orderstatus") == "P", F.lit(0.75))
    rows = table(spark, d, "orders").join(F.broadcast(stages), F.col("o_orderpriority") == F.col("stage"), "left").withColumn("probability", F.coalesce(own, "p", F.lit(0.0)))
    return rows.select("o_orderkey", "probability", F.round(F.col("o_totalprice").cast("decimal(18,4)") * F.col("probability").cast("decimal(4,2)"), 2).cast("double").alias("weighted"))


@query("""WITH src AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS k, max(c_name) || '*' AS name FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1),
tgt AS (SELECT CASE WHEN c_nationkey <> 0 THEN c_custkey END AS k, c_name AS name FROM customer)
SELECT tgt.k, tgt.name FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.k IS NOT DISTINCT FROM tgt.k) UNION ALL SELECT k, name FROM src""")
def null_safe_merge(spark: SparkSession, d: str) -> DataFrame:
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    src = c.filter("c_mktsegment = 'BUILDING'").select(F.when(F.col("c_acctbal") >= 0, k).alias("k"), F.concat("c_name", F.lit("*")).alias("name"))
    tgt = c.select(F.when(F.col("c_nationkey") != 0, k).alias("k"), F.col("c_name").alias("name"))
    return R.upsert(tgt, src, ["k"], [F.desc("name")])


@query("SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS parent_id, CAST(c_nationkey AS VARCHAR) AS project_id FROM customer WHERE c_mktsegment = 'BUILDING'")
def parent_expansion(spark: SparkSession, d: str) -> DataFrame:
    """The (parent, project) pairs that the calls of a child list need, from the parents as they landed."""
    raw = landing.as_raw(table(spark, d, "customer"), "c_custkey", "customer", F.lit(datetime(2000, 1, 1)), "b1", F.col("c_nationkey"))
    return registry.parent_ids(raw, ("c_mktsegment", "BUILDING"))


@query("SELECT DISTINCT _key AS parent_id, _project_id AS project_id FROM procore_budget_detail_row WHERE _key IS NOT NULL")
def landed_parents(spark: SparkSession, d: str) -> DataFrame:
    return registry.parent_ids(table(spark, d, "procore_budget_detail_row"))


# --- aggregation ---------------------------------------------------------------------------------


@query(f"SELECT o_custkey, {_cents('o_totalprice')} AS total, max(o_totalprice) AS largest, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day, max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS executed FROM orders GROUP BY 1")
def contract_rollup(spark: SparkSession, d: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").groupBy("o_custkey").agg(
        cents("o_totalprice").alias("total"), F.max("o_totalprice").alias("largest"), F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.max((F.col("o_orderstatus") == "F").cast("int")).alias("executed")
    )


@query(f"SELECT o_custkey, {_cents('CASE WHEN o_orderstatus = $$F$$ THEN o_totalprice ELSE 0 END')} AS approved, {_cents('CASE WHEN o_orderstatus = $$P$$ THEN o_totalprice ELSE 0 END')} AS pending FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '2000-01-31' GROUP BY 1")
def approved_pending_pivot(spark: SparkSession, d: str) -> DataFrame:
    of = lambda s: cents(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice")).otherwise(F.lit(0.0)))
    return table(spark, d, "orders").filter(F.to_date("o_orderdate") <= F.last_day(F.lit(AS_OF))).groupBy("o_custkey").agg(of("F").alias("approved"), of("P").alias("pending"))


@query(f"SELECT project_id, {_cents('coalesce(revised_budget,0)')} AS revised, {_cents('greatest(coalesce(estimated_cost_at_completion,0), coalesce(revised_budget,0))')} AS floored, count(*) FILTER (job_to_date_cost > estimated_cost_at_completion) AS over FROM dl_silver_budget_lines GROUP BY 1")
def budget_rollup(spark: SparkSession, d: str) -> DataFrame:
    z = lambda c: F.coalesce(c, F.lit(0.0))
    return table(spark, d, "dl_silver_budget_lines").groupBy("project_id").agg(
        cents(z("revised_budget")).alias("revised"), cents(F.greatest(z("estimated_cost_at_completion"), z("revised_budget"))).alias("floored"), F.count_if(F.col("job_to_date_cost") > F.col("estimated_cost_at_completion")).alias("over")
    )


_BOTH = f"SELECT vendor_id AS id, vendor_name, 'construction' AS system FROM dl_silver_vendors UNION ALL SELECT qbo_vendor_id, vendor_name, 'ledger' FROM dl_silver_qbo_vendors"


def _both(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "dl_silver_vendors").select(F.col("vendor_id").alias("id"), "vendor_name", F.lit("construction").alias("system"))
    return a.unionByName(table(spark, d, "dl_silver_qbo_vendors").select(F.col("qbo_vendor_id").alias("id"), "vendor_name", F.lit("ledger").alias("system")))


@query(f"SELECT {_norm('vendor_name')} AS vendor_key, max(vendor_name) AS vendor_name, max(CASE WHEN system = 'construction' THEN id END) AS construction_id, max(CASE WHEN system = 'ledger' THEN id END) AS ledger_id, CASE WHEN count(DISTINCT system) = 2 THEN 'both' ELSE max(system) END AS source FROM ({_BOTH}) WHERE {_norm('vendor_name')} <> '' GROUP BY 1")
def vendor_conform(spark: SparkSession, d: str) -> DataFrame:
    rows = _both(spark, d).withColumn("vendor_key", C.norm_key(F.col("vendor_name"))).filter("vendor_key != ''")
    of = lambda s: F.max(F.when(F.col("system") == s, F.col("id")))
    # two systems: whether both occur needs no distinct aggregate
    source = F.when(F.min("system") != F.max("system"), "both").otherwise(F.max("system"))
    return rows.groupBy("vendor_key").agg(F.max("vendor_name").alias("vendor_name"), of("construction").alias("construction_id"), of("ledger").alias("ledger_id"), source.alias("source"))


@query("SELECT batch_id, max(checked_at) AS run_at, count(*) AS checks, CAST(sum(CASE WHEN NOT passed THEN 1 ELSE 0 END) AS BIGINT) AS failed, max(CASE WHEN NOT passed AND severity = 'error' THEN 1 ELSE 0 END) = 0 AS succeeded FROM dl_dq_results GROUP BY 1")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    bad = ~F.col("passed")
    return table(spark, d, "dl_dq_results").groupBy("batch_id").agg(
        F.max("checked_at").alias("run_at"), F.count("*").alias("checks"), F.sum(F.coalesce(bad.cast("int"), F.lit(0))).alias("failed"), (F.max(F.coalesce((bad & (F.col("severity") == "error")).cast("int"), F.lit(0))) == 0).alias("succeeded")
    )


@query("SELECT project_id, count(*) AS copies FROM dl_silver_projects GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return quality.unique_key("p", ["project_id"]).rows({"p": table(spark, d, "dl_silver_projects")})


@query("SELECT max(_ingested_at) AS newest FROM dl_silver_projects HAVING max(_ingested_at) IS NULL OR max(_ingested_at) < TIMESTAMP '2026-01-01 00:00:00' - INTERVAL 30 HOUR")
def freshness(spark: SparkSession, d: str) -> DataFrame:
    return quality.freshness("p", "_ingested_at", datetime(2026, 1, 1), 30).rows({"p": table(spark, d, "dl_silver_projects")})


@query(f"SELECT coalesce(r_name, 'all') AS region, coalesce(n_name, 'all') AS office, {_cents('c_acctbal')} AS balance, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)")
def totals_rollup(spark: SparkSession, d: str) -> DataFrame:
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    rows = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    out = rows.rollup("r_name", "n_name").agg(cents("c_acctbal").alias("balance"), F.count("*").alias("n"))
    return out.select(F.coalesce("r_name", F.lit("all")).alias("region"), F.coalesce("n_name", F.lit("all")).alias("office"), "balance", "n")


# --- windows -------------------------------------------------------------------------------------

_CODE_COLS = ["project_id", "record_key", "cost_code", "cost_code_name", "_ingested_at", "_batch_id"]
_CODE_ORDER = ["_batch_id", "cost_code", "cost_code_name"]


@query(f"SELECT project_id, record_key, cost_code, cost_code_name, _ingested_at, _batch_id FROM (SELECT *, row_number() OVER (PARTITION BY project_id, record_key ORDER BY _ingested_at DESC, _batch_id NULLS FIRST, cost_code NULLS FIRST, cost_code_name NULLS FIRST) AS rn FROM (SELECT project_id, {_CODE_ID} AS record_key, cost_code, cost_code_name, _ingested_at, _batch_id FROM dl_silver_cost_codes)) WHERE rn = 1")
def latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "dl_silver_cost_codes").withColumn("record_key", _code_id("cost_code_id")).select(*_CODE_COLS)
    return R.latest_snapshot(rows, ["project_id", "record_key"], "_ingested_at", _CODE_ORDER)


@query("SELECT project_id, line_key, budget_line_id, revised_budget FROM (SELECT project_id, coalesce(wbs_code_id, cost_code_id, budget_line_id) AS line_key, budget_line_id, revised_budget, row_number() OVER (PARTITION BY project_id, coalesce(wbs_code_id, cost_code_id, budget_line_id) ORDER BY _ingested_at DESC, budget_line_id NULLS FIRST, revised_budget NULLS FIRST) AS rn FROM dl_silver_budget_lines) WHERE rn = 1")
def line_snapshot(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "dl_silver_budget_lines").withColumn("line_key", F.coalesce("wbs_code_id", "cost_code_id", "budget_line_id"))
    rows = rows.select("project_id", "line_key", "budget_line_id", "revised_budget", "_ingested_at")
    return R.latest_snapshot(rows, ["project_id", "line_key"], "_ingested_at", ["budget_line_id", "revised_budget"]).drop("_ingested_at")


@query(f"SELECT code_key, cost_code_name FROM (SELECT {_CODE_ID} AS code_key, cost_code_name, row_number() OVER (PARTITION BY {_CODE_ID} ORDER BY CASE WHEN cost_code_name IS NULL THEN 1 ELSE 0 END, cost_code_name) AS rn FROM dl_silver_cost_codes) WHERE rn = 1 AND code_key IS NOT NULL")
def prefer_named(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "dl_silver_cost_codes").select(_code_id("cost_code_id").alias("code_key"), "cost_code_name").filter("code_key is not null")
    return R.prefer_named(rows, ["code_key"], "cost_code_name", ["cost_code_name"])


_MONTHLY = f"monthly AS (SELECT c_mktsegment AS segment, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, {_cents('o_totalprice')} AS amount FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"


def _monthly(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    o = table(spark, d, "orders").select("o_custkey", "o_totalprice", F.trunc("o_orderdate", "MM").alias("month_start"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("segment", "month_start").agg(cents("o_totalprice").alias("amount"))


@query(f"WITH {_MONTHLY} SELECT a.segment, a.month_start, a.amount, round(a.amount - b.amount, 2) AS change FROM monthly a LEFT JOIN monthly b ON a.segment = b.segment AND b.month_start = a.month_start - INTERVAL 1 MONTH")
def fade_gain(spark: SparkSession, d: str) -> DataFrame:
    return M.against_prior_month(_monthly(spark, d), "amount", "month_start", ["segment"]).withColumn("change", F.round("change", 2)).select("segment", "month_start", "amount", "change")


@query(f"WITH daily AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus AS status, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DECIMAL(28,4)) AS amount FROM orders GROUP BY 1, 2) SELECT day, status, CAST(round(sum(amount) OVER (PARTITION BY status ORDER BY day RANGE BETWEEN INTERVAL 89 DAY PRECEDING AND CURRENT ROW), 2) AS DOUBLE) AS trailing FROM daily")
def trailing_revenue(spark: SparkSession, d: str) -> DataFrame:
    daily = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("status")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,4)")).alias("amount"))
    return M.trailing_sum(daily, "amount", "day", 90, ["status"]).select("day", "status", F.round("trailing", 2).cast("double").alias("trailing"))


@query("SELECT project_id, n_rows, position FROM (SELECT project_id, count(*) OVER (PARTITION BY office_name) AS n_rows, dense_rank() OVER (PARTITION BY office_name ORDER BY project_id) AS position FROM (SELECT DISTINCT project_id, office_name FROM dl_silver_projects))")
def counted_window(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "dl_silver_projects").select("project_id", "office_name").distinct()
    return R.ranked_in(rows, "office_name", "project_id").select("project_id", "n_rows", "position")


# --- sorting, limits, sets -----------------------------------------------------------------------


@query("SELECT 'events' AS source, CAST(event_id AS VARCHAR) AS refresh_token, ts AS obtained_at FROM events ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC LIMIT 1")
def newest_token(spark: SparkSession, d: str) -> DataFrame:
    tokens = table(spark, d, "events").select(F.lit("events").alias("source"), F.col("event_id").cast("string").alias("refresh_token"), F.col("ts").alias("obtained_at"), F.col("event_id").cast("string").alias("batch_id"))
    return landing.newest_token(tokens, "events").drop("batch_id")


@query(f"SELECT * FROM ({_WIP}) ORDER BY contract - estimate, project_key LIMIT 10")
def top_risks(spark: SparkSession, d: str) -> DataFrame:
    return _wip(spark, d).orderBy(F.col("contract") - F.col("estimate"), "project_key").limit(10)


@query("SELECT DISTINCT project_id FROM (SELECT project_id FROM dl_silver_projects UNION SELECT project_id FROM dl_silver_budget_lines UNION SELECT project_id FROM dl_silver_cost_codes UNION SELECT projectkey FROM dim_project) WHERE project_id IS NOT NULL")
def observed_keys_union(spark: SparkSession, d: str) -> DataFrame:
    ids = [table(spark, d, t).select("project_id") for t in ("dl_silver_projects", "dl_silver_budget_lines", "dl_silver_cost_codes")]
    return R.distinct_keys(*ids, table(spark, d, "dim_project").select("projectkey"))


@query("SELECT 'AR|' || o_orderkey AS item, 'AR' AS ledger, o_custkey AS party, o_totalprice AS open_balance FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT 'AP|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey, 'AP', l_suppkey, l_extendedprice FROM lineitem WHERE l_linestatus = 'O'")
def two_ledger_union_all(spark: SparkSession, d: str) -> DataFrame:
    ar = table(spark, d, "orders").filter("o_orderstatus = 'O'").select(F.concat(F.lit("AR|"), "o_orderkey").alias("item"), F.lit("AR").alias("ledger"), F.col("o_custkey").alias("party"), F.col("o_totalprice").alias("open_balance"))
    ap = table(spark, d, "lineitem").filter("l_linestatus = 'O'").select(F.concat_ws("|", F.lit("AP"), "l_orderkey", "l_linenumber", "l_partkey").alias("item"), F.lit("AP").alias("ledger"), F.col("l_suppkey").alias("party"), F.col("l_extendedprice").alias("open_balance"))
    return ar.unionByName(ap)


@query("SELECT s_suppkey AS vendor_key, s_name AS vendor_name, s_nationkey AS office FROM supplier UNION ALL SELECT 0, 'Unknown', NULL")
def key0_union(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("vendor_key"), F.col("s_name").alias("vendor_name"), F.col("s_nationkey").alias("office"))
    return R.with_unknown(rows, {"vendor_key": 0, "vendor_name": "Unknown"})


# --- quality, measures, streams, general problems ------------------------------------------------

_SUITE_SQL = """SELECT 'orders.o_orderkey.unique' AS expectation, 'error' AS severity, (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)) AS failing_rows
UNION ALL SELECT 'orders.o_custkey.fk_customer', 'error', (SELECT count(*) FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE c_custkey IS NULL AND o_custkey IS NOT NULL)
UNION ALL SELECT 'orders.o_totalprice.range', 'warn', (SELECT count(*) FROM orders WHERE o_totalprice < 1000 OR o_totalprice > 400000)
UNION ALL SELECT 'lineitem.l_discount.range', 'error', (SELECT count(*) FROM lineitem WHERE l_discount < 0 OR l_discount > 0.05)
UNION ALL SELECT 'lineitem.l_shipdate.not_null', 'error', (SELECT count(*) FROM lineitem WHERE l_shipdate IS NULL)
UNION ALL SELECT 'customer.negative', 'warn', (SELECT count(*) FROM customer WHERE c_acctbal < 0)
UNION ALL SELECT 'customer.nowhere.not_null', 'error', -1
UNION ALL SELECT 'customer.unreadable', 'warn', -1"""


@query(f"SELECT *, failing_rows = 0 AS passed FROM ({_SUITE_SQL})")
def dq_results(spark: SparkSession, d: str) -> DataFrame:
    t = {n: table(spark, d, n) for n in ("orders", "customer", "lineitem")}
    q = quality
    suite = [
        q.unique_key("orders", ["o_orderkey"]), q.referential("orders", "o_custkey", "customer", "c_custkey"), q.in_range("orders", "o_totalprice", 1000, 400000, "warn"),
        q.in_range("lineitem", "l_discount", 0, 0.05), q.not_null("lineitem", "l_shipdate"), q.holds("customer.negative", "customer", F.col("c_acctbal") < 0, "warn"), q.not_null("customer", "nowhere"),
        q.holds("customer.unreadable", "customer", F.assert_true(F.col("c_custkey") < 0).isNotNull(), "warn"),  # throws at every row
    ]
    return q.run_suite(spark, t, suite).select("expectation", "severity", "failing_rows", "passed")


def model(spark: SparkSession, d: str) -> M.Model:
    """Projects, costs and open items with their offices, and the measures over them."""
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    office = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("office_key"), F.col("n_name").alias("office"), F.col("r_name").alias("region"))
    who = table(spark, d, "customer").select(F.col("c_custkey").alias("project_key"), F.col("c_nationkey").alias("office_key"))
    wip = _wip(spark, d).join(who, "project_key")
    due = F.date_add(F.to_date("o_orderdate"), 30)
    items = table(spark, d, "orders").filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("project_key"), C.aging_bucket(AS_OF, due).alias("bucket"), (due < F.lit(AS_OF)).alias("overdue"), F.col("o_totalprice").cast("decimal(18,4)").alias("balance")).join(who, "project_key")
    wip = wip.select("project_key", "office_key", *[F.col(c).cast("decimal(18,4)").alias(c) for c in ("contract", "estimate", "spent", "billed")])
    m = [
        M.total("contract_value", "wip", "contract"), M.total("estimate_value", "wip", "estimate"), M.total("cost_to_date", "wip", "spent"), M.ratio("percent_complete", "cost_to_date", "estimate_value"),
        M.derived("margin", ("contract_value", "estimate_value"), F.col("contract_value") - F.col("estimate_value")), M.distinct_where("projects_at_risk", "wip", "project_key", F.col("contract") < F.col("estimate")),
        M.total("open_items", "items", "balance"), M.total("overdue_items", "items", "balance", F.col("overdue"), blank=False), M.ratio("overdue_share", "overdue_items", "open_items"), M.rows_where("documents", "items"),
    ]
    return M.Model({"wip": wip, "items": items}, m, {"office": office}, {f: [("office", "office_key", "office_key")] for f in ("wip", "items")})


_REPORT = f"""WITH w AS (SELECT r_name AS region, contract, estimate, spent, project_key FROM ({_WIP}) JOIN customer ON c_custkey = project_key JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
a AS (SELECT region, CAST(SUM(CAST(contract AS DECIMAL(18,4))) AS DOUBLE) AS contract_value, CAST(SUM(CAST(spent AS DECIMAL(18,4))) AS DOUBLE) / nullif(CAST(SUM(CAST(estimate AS DECIMAL(18,4))) AS DOUBLE), 0) AS pc, count(DISTINCT CASE WHEN contract < estimate THEN project_key END) AS projects_at_risk FROM w GROUP BY 1),
i AS (SELECT r_name AS region, count(*) AS documents, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS t, CAST(SUM(CASE WHEN {_DUE} < DATE '2000-01-01' THEN CAST(o_totalprice AS DECIMAL(18,4)) END) AS DOUBLE) AS o FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT a.region, round(contract_value, 2) AS contract_value, round(pc, 6) AS percent_complete, projects_at_risk, documents, round(coalesce(o,0) / t, 6) AS overdue_share FROM a FULL JOIN i ON a.region = i.region"""


@query(_REPORT)
def region_report(spark: SparkSession, d: str) -> DataFrame:
    report = M.Report("regions", ("region",), ("contract_value", "percent_complete", "projects_at_risk", "documents", "overdue_share"), sort="contract_value")
    out = report.run(model(spark, d))
    return out.select("region", F.round(F.col("contract_value").cast("double"), 2).alias("contract_value"), F.round(F.col("percent_complete").cast("double"), 6).alias("percent_complete"), "projects_at_risk", "documents", F.round(F.col("overdue_share").cast("double"), 6).alias("overdue_share"))


@query(f"SELECT {_BUCKET} AS bucket, {_cents('o_totalprice')} AS open_items, count(*) AS documents FROM orders WHERE o_orderstatus = 'O' GROUP BY 1")
def aging_report(spark: SparkSession, d: str) -> DataFrame:
    out = M.Report("aging", ("bucket",), ("open_items", "documents"), sort="open_items").run(model(spark, d))
    return out.select("bucket", F.round(F.col("open_items").cast("double"), 2).alias("open_items"), "documents")


@query("SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, event_type, round(CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DOUBLE), 2) AS amount, count(*) AS records FROM events GROUP BY 1, 2")
def weekly_tumbling(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("ts", "event_type", F.col("value").cast("decimal(18,4)").alias("value"))
    return streaming.weekly(rows, "ts", "value", ["event_type"]).withColumn("amount", F.round(F.col("amount").cast("double"), 2))


@query("SELECT _source_endpoint AS endpoint, count(*) AS n FROM procore_budget_detail_row GROUP BY 1")
def empty_typed(spark: SparkSession, d: str) -> DataFrame:
    """Landed rows appended to the empty relation of their layout, which fixes names and types."""
    landed = R.conform(table(spark, d, "procore_budget_detail_row"), landing.RAW)
    return landing.empty(spark, landing.RAW).unionByName(landed).groupBy(F.col("_source_endpoint").alias("endpoint")).agg(F.count("*").alias("n"))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS key, CAST(c_nationkey AS VARCHAR) AS project, CAST(c_custkey AS VARCHAR) || '|' || CAST(c_nationkey AS VARCHAR) AS merge_key, 'customer' AS endpoint, TIMESTAMP '2000-01-01 00:00:00' AS landed_at, c_name AS name, 'b1' AS batch,
  sha256(CAST(to_json({'c_custkey': c_custkey, 'c_mktsegment': c_mktsegment, 'c_name': c_name, 'c_nationkey': c_nationkey}) AS VARCHAR)) AS hash FROM customer""")
def raw_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    raw = landing.as_raw(rows, "c_custkey", "customer", F.lit(datetime(2000, 1, 1)), "b1", F.col("c_nationkey"))
    return raw.select(
        F.col("_key").alias("key"), F.col("_project_id").alias("project"), F.col("_merge_key").alias("merge_key"), F.col("_source_endpoint").alias("endpoint"), F.col("_ingested_at").cast("timestamp_ntz").alias("landed_at"),
        C.json_path(F.col("payload"), "c_name").alias("name"), F.col("_batch_id").alias("batch"), F.col("_row_hash").alias("hash"),
    )


_DATED = f"""dated AS (SELECT r_name AS region, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS v
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)"""


def _dated_model(spark: SparkSession, d: str) -> M.Model:
    n, r, c = table(spark, d, "nation"), table(spark, d, "region"), table(spark, d, "customer")
    where = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("region"))
    who = c.join(where, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("project_key"), "region")
    month = F.trunc("o_orderdate", "MM")
    sales = table(spark, d, "orders").select(F.col("o_custkey").alias("project_key"), F.to_date("o_orderdate").alias("day"), month.alias("month_start"), F.date_format(month, "MMM yyyy").alias("month_year"), F.col("o_totalprice").cast("decimal(18,4)").alias("amount"))
    m = [
        M.total("sold", "sales", "amount"), M.prior_month("sold_before", "sold"), M.derived("change", ("sold", "sold_before"), F.col("sold") - F.col("sold_before")), M.running("sold_so_far", "sold"),
        M.trailing("sold_quarter", "sold", 3, "months"), M.trailing("sold_90_days", "sold", 90), M.label("pace", "change", [(1e6, "rising"), (0, "steady")], "falling", "unknown"),
    ]
    return M.Model({"sales": sales}, m, {"projects": who}, {"sales": [("projects", "project_key", "project_key")]})


_MONEY = lambda c: F.round(F.col(c).cast("decimal(28,4)"), 2).cast("double").alias(c)


@query(f"""WITH {_DATED} SELECT a.region, a.month_start, CAST(round(a.v, 2) AS DOUBLE) AS sold, CAST(round(b.v, 2) AS DOUBLE) AS sold_before,
  CASE WHEN a.v - b.v IS NULL THEN 'unknown' WHEN a.v - b.v >= 1000000 THEN 'rising' WHEN a.v - b.v >= 0 THEN 'steady' ELSE 'falling' END AS pace
FROM dated a LEFT JOIN dated b ON a.region = b.region AND b.month_start = a.month_start - INTERVAL 1 MONTH WHERE a.month_start >= DATE '1996-01-01'""")
def measure_prior_month(spark: SparkSession, d: str) -> DataFrame:
    """A month's prior one stands outside the filter, and still counts."""
    out = _dated_model(spark, d).query(["sold", "sold_before", "pace"], ["region", "month_start"], F.col("month_start") >= date(1996, 1, 1), {"month_start"}, date="month_start")
    return out.select("region", "month_start", _MONEY("sold"), _MONEY("sold_before"), "pace")


@query(f"""WITH {_DATED}, total AS (SELECT month_start, SUM(v) AS v FROM dated WHERE region = 'ASIA' GROUP BY 1)
SELECT month_start, CAST(round(SUM(v) OVER (ORDER BY month_start ROWS UNBOUNDED PRECEDING), 2) AS DOUBLE) AS sold_so_far,
  CAST(round(SUM(v) OVER (ORDER BY month_start RANGE BETWEEN INTERVAL 2 MONTH PRECEDING AND CURRENT ROW), 2) AS DOUBLE) AS sold_quarter FROM total""")
def measure_trailing(spark: SparkSession, d: str) -> DataFrame:
    out = _dated_model(spark, d).query(["sold_so_far", "sold_quarter"], ["month_start"], F.col("region") == "ASIA", {"region"}, date="month_start")
    return out.select("month_start", _MONEY("sold_so_far"), _MONEY("sold_quarter"))


@query("SELECT CAST(o_orderdate AS DATE) AS day, CAST(round(SUM(SUM(CAST(o_totalprice AS DECIMAL(18,4)))) OVER (ORDER BY CAST(o_orderdate AS DATE) RANGE BETWEEN INTERVAL 89 DAY PRECEDING AND CURRENT ROW), 2) AS DOUBLE) AS sold_90_days FROM orders GROUP BY 1")
def measure_trailing_days(spark: SparkSession, d: str) -> DataFrame:
    return _dated_model(spark, d).query(["sold_90_days"], ["day"], date="day").select("day", _MONEY("sold_90_days"))


@query("SELECT DISTINCT strftime(date_trunc('month', o_orderdate), '%b %Y') AS month_year, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start FROM orders")
def slicer_months(spark: SparkSession, d: str) -> DataFrame:
    return _dated_model(spark, d).slicer("month_year", "month_start")


@query(f"SELECT CAST(round(SUM(CAST(o_totalprice AS DECIMAL(18,4))), 2) AS DOUBLE) AS open_items, count(*) AS documents FROM orders WHERE o_orderstatus = 'O'")
def card(spark: SparkSession, d: str) -> DataFrame:
    return model(spark, d).query(["open_items", "documents"]).select(_MONEY("open_items"), "documents")


@query(f"""SELECT 'raw_customer' AS step, count(*) AS n, 'done' AS status FROM customer UNION ALL SELECT 'projects', count(*), 'done' FROM customer
UNION ALL SELECT 'schedule', count(*), 'done' FROM ({_WIP}) UNION ALL SELECT 'checks', 3, 'done'""")
def pipeline_run(spark: SparkSession, d: str) -> DataFrame:
    """Lands customers as JSON lines, merges them, builds two tables on them, checks these and moves the mark."""
    folder, now = f"{shared_folder(spark)}/pipeline-{uuid4().hex}", datetime(2000, 1, 1)
    landing.write_landing(landing.as_raw(table(spark, d, "customer"), "c_custkey", "customer", F.lit(now), "b1"), f"{folder}/landing", "b1", "raw_customer")
    landed = landing.read_landing(spark, f"{folder}/landing").drop("table_name")
    n = versioned.merge_table(landed, f"{folder}/raw_customer", ["_merge_key", "_source_endpoint"], [F.desc("_ingested_at"), F.desc("_row_hash")])
    get = lambda name, kind: C.json_path(F.col("payload"), name).try_cast(kind)
    builders = [
        pipeline.Builder("schedule", lambda p: _wip(spark, d).join(p.select("project_key"), "project_key", "left_semi"), ("projects",)),
        pipeline.Builder("projects", lambda raw: raw.select(get("c_custkey", "bigint").alias("project_key"), get("c_name", "string").alias("name")), ("raw_customer",)),
    ]
    suite = lambda _: [quality.unique_key("projects", ["project_key"]), quality.not_null("projects", "name"), quality.referential("schedule", "project_key", "projects", "project_key")]
    out = pipeline.run(spark, builders, {"raw_customer": versioned.read_table(spark, f"{folder}/raw_customer")}, folder, "b1", now, suite, [("raw_customer", "customer", now)])
    return spark.createDataFrame([("raw_customer", n, "done"), *out.log], "step string, n long, status string")


# every readable record of a payload, whatever wraps it, and the objects of a member, be it one or a list
_RECORDS = """landed AS (SELECT _key, TRY_CAST(payload AS JSON) AS j FROM procore_budget_detail_row WHERE payload IS NOT NULL),
plain AS (SELECT _key, CASE WHEN json_type(j) = 'VARCHAR' THEN TRY_CAST(j ->> '$' AS JSON) ELSE j END AS j FROM landed WHERE j IS NOT NULL),
opened AS (SELECT _key, CASE WHEN json_type(j) = 'OBJECT' AND json_type(j -> 'id') IS NULL THEN coalesce(j -> 'data', j -> 'items', j) ELSE j END AS j FROM plain WHERE j IS NOT NULL),
listed AS (SELECT _key, CASE WHEN json_type(j) = 'ARRAY' THEN json_extract(j, '$[*]') ELSE [j] END AS l FROM opened),
record AS (SELECT _key, unnest(l) AS r, unnest(range(len(l))) AS record_at FROM listed)"""


def _each(x: str) -> str:
    return f"unnest(CASE json_type({x}) WHEN 'ARRAY' THEN json_extract({x}, '$[*]') WHEN 'OBJECT' THEN [{x}] ELSE [] END)"


def _rows_of(x: str) -> str:
    """Records with the objects of a member and their positions, be it one object or a list of them."""
    inner = f"CASE json_type({x}) WHEN 'ARRAY' THEN json_extract({x}, '$[*]') WHEN 'OBJECT' THEN [{x}] ELSE [] END"
    return f"(SELECT *, unnest({inner}) AS x, CAST(unnest(range(len({inner}))) AS INT) AS ordinal FROM record)"


def _member(x: str, name: str, kind: str) -> str:
    text = f"""CASE WHEN json_type(json_extract({x}, '$."{name}"')) NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN json_extract_string({x}, '$."{name}"') END"""
    return f"TRY_CAST({text} AS {kind}) AS {name.lower().replace(' ', '_')}"


def _sql_id(x: str) -> str:
    return f"nullif(regexp_replace(trim({x} ->> 'id'), '^([0-9]+)[.]0*$', '\\1'), '')"


_P3_FOUND = f"""WITH {_RECORDS}, item AS (SELECT r, {_each("r -> 'wbs_code' -> 'segment_items'")} AS i FROM record),
tie AS (SELECT 'budget_forecast' AS kind, {_sql_id('r')} AS parent_id, {_sql_id('f')} AS child_id FROM (SELECT r, {_each("r -> 'budget_forecast'")} AS f FROM record)
UNION SELECT 'segment_item', {_sql_id('r')}, {_sql_id('i')} FROM item
UNION SELECT 'segment', {_sql_id('i')}, {_sql_id('s')} FROM (SELECT i, {_each("i -> 'segment'")} AS s FROM item)
UNION SELECT 'attribute_item', {_sql_id('r')}, {_sql_id('a')} FROM (SELECT r, {_each("r -> 'wbs_code' -> 'attribute_items'")} AS a FROM record)
UNION SELECT 'customer', nullif(trim(parentref.value), ''), nullif(trim(qbo_customer_id), '') FROM dl_silver_qbo_customers)
SELECT DISTINCT kind, parent_id, child_id FROM tie WHERE parent_id IS NOT NULL AND child_id IS NOT NULL"""


@query(_P3_FOUND)
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.parent_child_ties(table(spark, d, "procore_budget_detail_row"), table(spark, d, "dl_silver_qbo_customers"))


def _flat(spark: SparkSession, d: str) -> DataFrame:
    return nested.flatten(table(spark, d, "procore_budget_detail_row"), "_key", "payload")


_BUDGET = {"project_id": "string", "cost_code": "string", "category": "string", "original_budget_amount": "double", "Revised Budget": "double"}
_FORECAST = {"amount": "double", "manual_amount": "double", "automatic_amount": "double", "notes": "string"}
_SEGMENT = {"code": "string", "name": "string", "is_parent": "boolean"}
_SQL_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _flat_sql(x: str, rows: str, keys: str, members: dict[str, str]) -> str:
    cols = ", ".join(_member(x, n, _SQL_TYPES[t]) for n, t in members.items())
    return f"WITH {_RECORDS} SELECT _key AS record_key, record_at, {keys}, {_sql_id(x)} AS id, {cols} FROM {rows} WHERE json_type({x}) = 'OBJECT'"


@query(_flat_sql("r", "record", "'' AS row_key, CAST(NULL AS VARCHAR) AS parent_key, CAST(0 AS INT) AS ordinal", _BUDGET))
def p3_budget_rows(spark: SparkSession, d: str) -> DataFrame:
    return nested.table_of(_flat(spark, d), "", _BUDGET)


@query(_flat_sql("x", _rows_of("r -> 'budget_forecast'"), "CAST(ordinal AS VARCHAR) AS row_key, '' AS parent_key, ordinal", _FORECAST))
def p3_forecasts(spark: SparkSession, d: str) -> DataFrame:
    return nested.table_of(_flat(spark, d), "budget_forecast", _FORECAST)


@query(_flat_sql("x", _rows_of("r -> 'wbs_code' -> 'segment_items'"), "'0.' || ordinal AS row_key, '0' AS parent_key, ordinal", _SEGMENT))
def p3_segment_items(spark: SparkSession, d: str) -> DataFrame:
    return nested.table_of(_flat(spark, d), "wbs_code.segment_items", _SEGMENT)


@query()
def p3_rows(spark: SparkSession, d: str) -> DataFrame:
    """The whole flat output: every row of every related table, with all its members."""
    customers = table(spark, d, "dl_silver_qbo_customers")
    members = [c for c in customers.columns if c not in ("qbo_customer_id", "parentref")]
    sources = {"procore_budget_detail_row": _flat(spark, d), "dl_silver_qbo_customers": nested.flatten_customers(customers, members)}
    entries = lambda c: F.array_sort(F.map_entries(c)).alias(c)
    keys = ("record_key", "record_at", "table", "row_key", "parent_key", "ordinal", "id")
    return reduce(DataFrame.unionByName, [rows.select(F.lit(name).alias("source"), *keys, entries("ids"), entries("fields")) for name, rows in sources.items()])


def _profiles(spark: SparkSession, d: str) -> list[profile.Profile]:
    return profile.load_profiles(table(spark, d, "dim_project"), table(spark, d, "dl_dq_results"))


@query("SELECT 'procore_budget_detail_row' AS source_table, CASE WHEN nullif(trim(payload), '') IS NULL THEN 'no payload' ELSE 'not JSON' END AS reason, count(*) AS n FROM procore_budget_detail_row WHERE nullif(trim(payload), '') IS NULL OR TRY_CAST(payload AS JSON) IS NULL GROUP BY 1, 2")
def p3_reject_counts(spark: SparkSession, d: str) -> DataFrame:
    return p3_rejects(spark, d).groupBy("source_table", "reason").agg(F.count("*").alias("n"))


@query()
def p3_rejects(spark: SparkSession, d: str) -> DataFrame:
    return nested.unreadable(table(spark, d, "procore_budget_detail_row"), "_key", "payload", "procore_budget_detail_row")


@query()
def p5_violations(spark: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [p.violations() for p in _profiles(spark, d)])


@query()
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return profile.changed_columns(_profiles(spark, d))


@query()
def p5_profile(spark: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [p.loads for p in _profiles(spark, d)])


@query()
def p5_changes(spark: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [p.changes() for p in _profiles(spark, d)])


def _sql_mask(x: str) -> str:
    for pattern, put in ((r"\p{Lu}+", "A"), (r"\p{Ll}+", "a"), ("[0-9]", "9"), ("9+[.]9+", "9+"), (r"\bAa(?: Aa\b)+", "Aa+"), (r"\bA(?: A\b)+", "A+"), (r"\ba(?: a\b)+", "a+")):
        x = f"regexp_replace({x}, '{pattern}', '{put}', 'g')"
    return x


_TEXTS = {"dim_project": ("_batch_id", "projectname projectnumber projectstatus projecttype office region city statecode".split()), "dl_dq_results": ("batch_id", "expectation table_name severity description failing_rows".split())}
_ALL = {"dim_project": "projectname projectnumber projectstatus projecttype office region city statecode isactive startdate completiondate originalcontract retainagepercent hasprimecontract isincrosswalk matchconfidence".split(), "dl_dq_results": "expectation table_name severity description failing_rows passed".split()}
_MASKED = " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, {_sql_mask(f'CAST({c} AS VARCHAR)')} AS mask FROM {t} WHERE {load} IS NOT NULL AND {c} IS NOT NULL" for t, (load, cs) in _TEXTS.items() for c in cs)
_MASKS = f"""SELECT table_name, column_name, mask, n AS "values", round(n / whole, 9) AS share, n / whole >= 0.01 AS dominant FROM (
SELECT table_name, column_name, mask, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY table_name, column_name) AS DOUBLE) AS whole FROM ({_MASKED}) GROUP BY 1, 2, 3)"""
_NAN = lambda c: f"count(CASE WHEN isnan({c}) THEN NULL ELSE {c} END)" if c in ("originalcontract", "retainagepercent", "matchconfidence") else f"count({c})"
_COUNTED = " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, {_TEXTS[t][0]} AS batch_id, count(*) AS row_count, count(*) - {_NAN(c)} AS nulls FROM {t} WHERE {_TEXTS[t][0]} IS NOT NULL GROUP BY 3" for t, cs in _ALL.items() for c in cs)


@query(_COUNTED)
def p5_counts(spark: SparkSession, d: str) -> DataFrame:
    """The columns of the profile that are no estimates."""
    return reduce(DataFrame.unionByName, [p.loads.select("table_name", "column_name", "batch_id", "row_count", "nulls") for p in _profiles(spark, d)])


@query(_MASKS)
def p5_masks(spark: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [p.masks() for p in _profiles(spark, d)]).withColumn("share", F.round("share", 9))


# --- facts and dimensions put together from the operators ----------------------------------------

_BLANK = "nullif(regexp_replace({}, '^ +| +$', '', 'g'), '')"


@query(f"""WITH named AS (SELECT code_key, cost_code, cost_code_name FROM (SELECT {_CODE_ID} AS code_key, {_BLANK.format('cost_code')} AS cost_code, {_BLANK.format('cost_code_name')} AS cost_code_name,
  row_number() OVER (PARTITION BY {_CODE_ID} ORDER BY CASE WHEN {_BLANK.format('cost_code_name')} IS NULL THEN 1 ELSE 0 END, {_BLANK.format('cost_code_name')}, {_BLANK.format('cost_code')} NULLS FIRST) AS rn FROM dl_silver_cost_codes) WHERE rn = 1 AND code_key IS NOT NULL),
seen AS (SELECT DISTINCT cost_code_id AS code_key FROM dl_silver_budget_lines WHERE cost_code_id IS NOT NULL)
SELECT code_key, coalesce(cost_code, 'Unknown') AS cost_code, coalesce(cost_code_name, cost_code, 'Unknown') AS cost_code_name, string_split_regex(coalesce(cost_code, 'Unknown'), '[-.]')[1] AS root_code FROM
  (SELECT * FROM named UNION ALL SELECT code_key, NULL, NULL FROM seen WHERE code_key NOT IN (SELECT code_key FROM named))
UNION ALL SELECT '0', 'Unknown', 'Unknown', 'Unknown'""")
def dim_cost_code(spark: SparkSession, d: str) -> DataFrame:
    """Declared codes, codes only seen in lines, and the row for unresolved keys."""
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    codes = table(spark, d, "dl_silver_cost_codes").select(_code_id("cost_code_id").alias("code_key"), text("cost_code").alias("cost_code"), text("cost_code_name").alias("cost_code_name"))
    named = R.prefer_named(codes.filter("code_key is not null"), ["code_key"], "cost_code_name", ["cost_code_name", "cost_code"])
    seen = table(spark, d, "dl_silver_budget_lines").select(F.col("cost_code_id").alias("code_key")).filter("code_key is not null").distinct()
    rows = named.unionByName(seen.join(named.select("code_key"), "code_key", "left_anti"), allowMissingColumns=True)
    code = F.coalesce("cost_code", F.lit("Unknown"))
    rows = rows.select("code_key", code.alias("cost_code"), F.coalesce("cost_code_name", "cost_code", F.lit("Unknown")).alias("cost_code_name"), F.split(code, "[-.]")[0].alias("root_code"))
    return R.with_unknown(rows, {"code_key": "0", "cost_code": "Unknown", "cost_code_name": "Unknown", "root_code": "Unknown"})


@query("""SELECT 'lines|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey AS cost_key, 'lines' AS source, o_custkey AS project_key, CASE WHEN CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' THEN CAST(date_trunc('month', l_shipdate) AS DATE) END AS month_start, l_extendedprice AS amount, l_suppkey AS vendor
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus <> 'P'
UNION ALL SELECT 'orders|' || o_orderkey, 'orders', o_custkey, CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' THEN CAST(date_trunc('month', o_orderdate) AS DATE) END, o_totalprice, NULL FROM orders WHERE o_orderstatus = 'P'""")
def fct_cost_transaction(spark: SparkSession, d: str) -> DataFrame:
    """Costs of two systems under one layout; lines that no project claims keep a null key."""
    o = table(spark, d, "orders")
    mapped = o.filter("o_orderstatus != 'P'").select("o_orderkey", F.col("o_custkey").alias("project_key"))
    li = table(spark, d, "lineitem").join(mapped, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    month = lambda c: C.month_key(F.to_date(c), _LOW, _HIGH).alias("month_start")
    a = li.select(F.concat_ws("|", F.lit("lines"), "l_orderkey", "l_linenumber", "l_partkey").alias("cost_key"), F.lit("lines").alias("source"), "project_key", month("l_shipdate"), F.col("l_extendedprice").alias("amount"), F.col("l_suppkey").alias("vendor"))
    b = o.filter("o_orderstatus = 'P'").select(F.concat(F.lit("orders|"), "o_orderkey").alias("cost_key"), F.lit("orders").alias("source"), F.col("o_custkey").alias("project_key"), month("o_orderdate"), F.col("o_totalprice").alias("amount"), F.lit(None).cast("bigint").alias("vendor"))
    return a.unionByName(b)


@query("""SELECT user_id AS worker, CAST(date_trunc('month', ts) AS DATE) AS month_start, count(*) AS entries, CAST(round(SUM(CAST(value AS DECIMAL(18,4))), 2) AS DOUBLE) AS hours,
  coalesce(CAST(round(SUM(CASE WHEN upper(event_type) IN ('CLICK','PURCHASE') THEN CAST(value AS DECIMAL(18,4)) END), 2) AS DOUBLE), 0.0) AS billable FROM events GROUP BY 1, 2""")
def fct_labour(spark: SparkSession, d: str) -> DataFrame:
    value = F.col("value").cast("decimal(18,4)")
    billable = F.sum(F.when(C.is_billable(_billing_status()), value))
    return table(spark, d, "events").groupBy(F.col("user_id").alias("worker"), F.trunc("ts", "MM").alias("month_start")).agg(
        F.count("*").alias("entries"), F.round(F.sum(value), 2).cast("double").alias("hours"), F.coalesce(F.round(billable, 2).cast("double"), F.lit(0.0)).alias("billable")
    )


_SNAP = "SELECT project_key, DATE '1999-12-01' AS month_start, contract FROM ({w}) UNION ALL SELECT project_key, DATE '2000-01-01', contract + 1 FROM ({w}) WHERE billed > contract"


@query(_SNAP.format(w=_WIP))
def month_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Monthly states kept by an upsert on project and month: a rerun of a month replaces it, other months stay."""
    wip = cut(_wip(spark, d))  # read four times
    open_ = wip.filter("billed > contract")
    state = lambda rows, m, x: rows.select("project_key", F.lit(m).alias("month_start"), (F.col("contract") + x).alias("contract"))
    kept = state(wip, date(1999, 12, 1), 0).unionByName(state(open_, date(2000, 1, 1), 0))
    return R.upsert(kept, state(open_, date(2000, 1, 1), 1), ["project_key", "month_start"], [F.desc("contract")])


@query("SELECT n_regionkey AS sort_key, count(DISTINCT r_name) AS labels, count(DISTINCT r_name) = 1 AS one_to_one FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def sort_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Whether a column to sort by stands for one label each."""
    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return M.sort_pairs(rows, "r_name", "n_regionkey")
