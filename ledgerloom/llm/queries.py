"""The queries of the operators in this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import entity_match, form_copies, fusion, leaks, mixture, splitter, survivor
from ledgerloom.runtime import table


def _p1(spark: SparkSession, d: str) -> DataFrame:
    return entity_match.match_projects_to_jobs(table(spark, d, "dl_silver_projects"), table(spark, d, "dl_silver_qbo_customers"))


def _p4(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, d, "dl_silver_budget_lines"), table(spark, d, "dl_silver_cost_codes")


def _p4_fused(spark: SparkSession, d: str) -> DataFrame:
    keys, (lines, codes) = ["project_id", "record_key"], _p4(spark, d)
    a = fusion.fuse(survivor.budget_line_rows(lines, survivor.BUDGET_FIELDS), keys, survivor.BUDGET_FIELDS).withColumn("entity", F.lit("budget_line"))
    b = fusion.fuse(survivor.cost_code_rows(codes, survivor.CODE_FIELDS), keys, survivor.CODE_FIELDS).withColumn("entity", F.lit("cost_code"))
    return a.unionByName(b)


def _vendors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, d, "dl_silver_vendors"), table(spark, d, "dl_silver_qbo_vendors")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    docs = lambda s, d: table(s, d, "documents")
    return {
        "p1_found": lambda s, d: _p1(s, d).select("project_id", "qbo_customer_id"),
        "p1_matches": _p1,
        "p2_found": lambda s, d: form_copies.vendor_copies(*_vendors(s, d)),
        "p2_vendors": lambda s, d: form_copies.vendor_records(*_vendors(s, d)),
        "p4_found": lambda s, d: survivor.latest_field_sources(*_p4(s, d)),
        "p4_fused": _p4_fused,
        "p4_budget_lines": lambda s, d: survivor.surviving_records(
            survivor.budget_line_rows(_p4(s, d)[0], survivor.BUDGET_FIELDS, every=True), survivor.BUDGET_FIELDS
        ),
        "p4_cost_codes": lambda s, d: survivor.surviving_records(
            survivor.cost_code_rows(_p4(s, d)[1], survivor.CODE_FIELDS), survivor.CODE_FIELDS
        ),
        "p6_found": lambda s, d: leaks.find_leaks(docs(s, d), table(s, d, "eval_items")).select("item_id", "doc_id"),
        "p6_passages": lambda s, d: leaks.find_leaks(docs(s, d), table(s, d, "eval_items")),
        "p7_mix": lambda s, d: mixture.mix(docs(s, d), table(s, d, "mix_targets")),
        "p7_shares": lambda s, d: mixture.shares(docs(s, d), table(s, d, "mix_targets")),
        "p8_found": lambda s, d: splitter.pieces(docs(s, d), with_text=False).select("doc_id").distinct(),
        "p8_pieces": lambda s, d: splitter.pieces(docs(s, d)),
    }


_NOTHING = ", ".join(f"'{w}'" for w in survivor.NOTHING)
_BLANKS = r"'[\s\p{Z}]+'"
_LINES = """lines AS (
  SELECT nullif(trim(project_id), '') AS project_id, nullif(trim(wbs_code_id), '') AS own, nullif(trim(cost_code_id), '') AS c,
         nullif(trim(category_id), '') AS g, * EXCLUDE (project_id) FROM dl_silver_budget_lines),
told AS (SELECT project_id, c, g, min(own) AS k FROM lines WHERE own IS NOT NULL GROUP BY ALL HAVING min(own) = max(own)),
budget AS (
  SELECT lines.project_id, coalesce(lines.own, told.k) AS record_key, lines.* EXCLUDE (project_id)
  FROM lines LEFT JOIN told ON lines.project_id = told.project_id AND lines.c = told.c AND lines.g = told.g)"""
_CODES = r"""codes AS (
  SELECT nullif(trim(project_id), '') AS project_id, nullif(regexp_extract(trim(cost_code_id), '^0*(\d{9})(?:\.0*)?$', 1), '') AS record_key,
         * EXCLUDE (project_id) FROM dl_silver_cost_codes)"""


def _is_filled(field: str, text: bool) -> str:
    if text:
        return f"{field} IS NOT NULL AND lower(trim(regexp_replace({field}, {_BLANKS}, ' ', 'g'))) NOT IN ({_NOTHING})"
    return f"{field} IS NOT NULL AND NOT isnan({field})"


def _sources(entity: str, rows: str, fields: list[str]) -> str:
    per = [
        f"""SELECT '{entity}' AS entity, project_id, record_key, '{f}' AS field_name,
          arg_max(_batch_id, (_ingested_at, _batch_id)) FILTER ({_is_filled(f, f not in ("revised_budget", "estimated_cost_at_completion"))}) AS batch_id
        FROM {rows} WHERE project_id IS NOT NULL AND record_key IS NOT NULL GROUP BY project_id, record_key
        HAVING min(_batch_id) <> max(_batch_id) AND count(*) FILTER ({_is_filled(f, f not in ("revised_budget", "estimated_cost_at_completion"))}) > 0"""
        for f in fields
    ]
    return " UNION ALL ".join(per)


def _merged(rows: str, fields: list[str]) -> str:
    cols = ", ".join(
        f"arg_max({f}, (_ingested_at, _batch_id, {f})) FILTER ({_is_filled(f, f not in ('revised_budget', 'estimated_cost_at_completion'))}) AS {f}" for f in fields
    )
    return f"SELECT project_id, record_key, {cols} FROM {rows} WHERE project_id IS NOT NULL AND record_key IS NOT NULL GROUP BY project_id, record_key"


# the definition, by keys that forms of one vendor share, carried over; names that differ by several joins and by order are not in it
_LOW = r"regexp_replace(lower(text), '[\s\p{Z}]+', ' ', 'g')"
_VENDORS = rf"""named AS (SELECT DISTINCT trim(id) AS id, text FROM (SELECT vendor_id AS id, vendor_name AS text FROM dl_silver_vendors UNION ALL SELECT qbo_vendor_id, vendor_name FROM dl_silver_qbo_vendors)
  WHERE nullif(trim(id), '') IS NOT NULL AND regexp_replace(lower(text), '[^\p{{L}}\p{{M}}\p{{N}}]', '', 'g') <> ''),
cleaned AS (SELECT id, regexp_replace({_LOW}, '[^\p{{L}}\p{{M}}\p{{N}}\s]', '', 'g') AS tight, regexp_replace({_LOW}, '[^\p{{L}}\p{{M}}\p{{N}}\s]', ' ', 'g') AS loose FROM named),
worded AS (SELECT id, list_filter(string_split_regex(unnest([tight, loose]), '\s+'), lambda w: w <> '') AS w FROM cleaned),
keyed AS (SELECT DISTINCT id, unnest(list_concat(['w' || array_to_string(list_sort(w), ' '), 'j' || array_to_string(w, '')],
  list_transform(range(1, len(w)), lambda i: 'w' || array_to_string(list_sort(list_concat(w[1:i-1], [w[i] || w[i+1]], w[i+2:])), ' ')))) AS k FROM worded),
hub AS (SELECT id, min(id) OVER (PARTITION BY k) AS o FROM keyed), link AS (SELECT DISTINCT id AS a, o AS b FROM hub WHERE id <> o), both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link)"""
_P2 = f"""WITH RECURSIVE {_VENDORS}, reach AS (SELECT DISTINCT id AS root, id FROM keyed UNION SELECT reach.root, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.id WHERE both_ways.b > reach.root)
SELECT min(root) AS keep_id, id AS copy_id FROM reach GROUP BY id HAVING min(root) <> id"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": _P2,
        "p4_found": f"WITH {_LINES}, {_CODES} {_sources('budget_line', 'budget', survivor.BUDGET_FIELDS)} UNION ALL {_sources('cost_code', 'codes', survivor.CODE_FIELDS)}",
        "p4_budget_lines": f"WITH {_LINES} {_merged('budget', survivor.BUDGET_FIELDS)}",
        "p4_cost_codes": f"WITH {_CODES} {_merged('codes', survivor.CODE_FIELDS)}",
    }
