"""Deeply nested semi-structured records as related flat tables (problem 3).

``flatten`` parses each payload once, inside the task that read it, into path-value-ordinal triples,
groups the triples by their repeated ancestor and pivots every group into one row of that ancestor's
table. The triples of a record never leave their task, so nothing is shuffled. An object and a list
that holds it are one shape of the same thing: every object is a row of the table its path names,
and list positions go into the row's ordinal.

Row: table (path of names from the record, '' for the record itself), row_key and parent_key
(ordinals along the path, which tie child to parent), ordinal (position among its siblings), id,
ids (the ids of all rows above, by table) and fields (scalar members by name).

A payload is one value of its column, so it is read where it stands, by the interpreter's scanner;
what is nested deeper than that one's stack goes through ``deep``, which needs none.

Defined results: a payload that is null, empty or not JSON is unreadable and gives no row here but a
reject in ``unreadable``, as does one that holds no record; a payload that is text holding JSON, a
list of records, or an object of nothing but records below wrapper names (and what belongs to
paging) counts as its records, any other object is a record with all its members; null members give
no field, null list members no row; a member missing or null gives no child row; of lists in a list
a row's key holds the position in each, joined by "_"; repeated landings give repeated rows under
their own record_key.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Member names that may wrap a payload's records, and those that may stand beside them.
WRAPPERS = ("data", "items", "results")
PAGING = ("total", "count", "page", "per_page", "limit", "offset", "next", "paging", "has_more")
ROW_SCHEMA = (
    "record_key string, record_at long, table string, row_key string, parent_key string, ordinal int, id string, "
    "ids map<string,string>, fields map<string,string>"
)

_TOKEN = re.compile(r'[ \t\r\n]*(?:([{}\[\],:])|("(?:[^"\\\x00-\x1f]|\\.)*")|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?)|(true|false|null))')
_WORD = {"true": True, "false": False, "null": None}


def deep(text: str) -> object:
    """The value of a JSON text nested to any depth, read token by token with a stack of its own; ValueError for no JSON."""
    top: list = []
    open_: list = [top]  # containers being filled
    names: list = [None]  # the member name that waits for its value, for each of them
    after, at, end = "start", 0, len(text.rstrip(" \t\r\n"))
    while at < end:
        m = _TOKEN.match(text, at, end)
        if m is None or (top and len(open_) == 1):
            raise ValueError(f"no JSON at {at}")
        at, sign = m.end(), m[1]
        held = open_[-1]
        if isinstance(held, dict) and names[-1] is None and sign is None and m[2] and after in ("{", ","):
            names[-1], after = json.loads(m[2]), "name"
        elif sign == ":" and after == "name":
            after = ":"
        elif sign == "," and after == "value" and len(open_) > 1:
            after = ","
        elif sign in ("}", "]") and isinstance(held, dict if sign == "}" else list) and len(open_) > 1 and after in ("value", "{" if sign == "}" else "["):
            open_.pop()
            names.pop()
            after = "value"
        elif sign in ("{", "[", None) and after in (("start", "[", ",") if isinstance(held, list) else (":",)):
            value = {} if sign == "{" else [] if sign == "[" else json.loads(m[2] or m[3]) if m[2] or m[3] else _WORD[m[4]]
            if isinstance(held, list):
                held.append(value)
            else:
                held[names[-1]], names[-1] = value, None
            after = "value"
            if sign:
                open_.append(value)
                names.append(None)
                after = sign
        else:
            raise ValueError(f"no JSON at {at}")
    if len(open_) != 1 or not top:
        raise ValueError("no whole JSON")
    return top[0]


def _parsed(text: str | None) -> object:
    value: object = text
    while isinstance(value, str):
        try:
            value = json.loads(value)
        except RecursionError:
            try:
                value = deep(value)
            except ValueError:
                return None
        except ValueError:
            return None
    return value


def _records(value: object, wrappers: tuple[str, ...]) -> Iterator[dict]:
    todo = [value]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            x = _parsed(x)
        if isinstance(x, list):
            todo.extend(reversed(x))
        elif isinstance(x, dict):
            inside = [x[w] for w in wrappers if isinstance(x.get(w), (dict, list))]
            if inside and all(k in wrappers or k in PAGING or v is None for k, v in x.items()):
                todo.extend(reversed(inside))
            else:
                yield x


def _scalar(x: object) -> str:
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, float) and x.is_integer() and abs(x) < 1e15:
        return f"{x:.1f}"
    return str(x)


def _spread(members: list) -> Iterator[tuple[int, str, object]]:
    """(position counted through, positions in each list, member) of a list and the lists within it."""
    todo: list[tuple[str, object]] = [(str(i), x) for i, x in reversed(list(enumerate(members)))]
    n = 0
    while todo:
        at, x = todo.pop()
        if isinstance(x, list):
            todo.extend((f"{at}_{i}", y) for i, y in reversed(list(enumerate(x))))
        else:
            if x is not None:
                yield n, at, x
            n += 1


def _id(fields: dict[str, str]) -> str | None:
    """The id, trimmed; a number that a writer turned into a decimal loses its zero decimals."""
    own = fields.get("id", "").strip()
    whole, dot, rest = own.partition(".")
    return (whole if dot and whole.isdigit() and not rest.strip("0") else own) or None


Ordinals = tuple[tuple[int, str], ...]


def triples(record: dict) -> Iterator[tuple[tuple[str, ...], Ordinals, str | None]]:
    """(path, ordinals, value) of every scalar, in document order; ordinals hold, for each name of the
    path but the last, the position of that object in its list (0 outside of one), counted and as written.
    An object itself is announced by a triple without value, its path ending in ''."""
    todo: list[tuple[tuple[str, ...], Ordinals, object]] = [((), (), record)]
    while todo:
        path, at, x = todo.pop()
        if isinstance(x, dict):
            yield (*path, ""), at, None
            for name, member in reversed(x.items()):
                if isinstance(member, dict):
                    todo.append(((*path, name), (*at, (0, "0")), member))
                elif isinstance(member, list):
                    todo.extend(((*path, name), (*at, (n, where)), m) for n, where, m in reversed(list(_spread(member))))
                elif member is not None:
                    todo.append(((*path, name), at, member))
        elif len(at) == len(path):  # scalar members of a list are rows of their own
            yield (*path, ""), at, None
            yield (*path, "value"), at, _scalar(x)
        else:
            yield path, at, _scalar(x)


def pivot(record: dict) -> list[tuple]:
    """Rows (table, row_key, parent_key, ordinal, id, ids, fields) of one record."""
    rows: dict[tuple, dict[str, str]] = {}
    for path, at, value in triples(record):
        fields = rows.setdefault((path[:-1], at), {})
        if value is not None:
            fields[path[-1]] = value
    out, above = [], {}  # a row stands after the one it lies in
    for (table, at), fields in rows.items():
        own = _id(fields)
        ids = above[table[:-1], at[:-1]] if table else {}
        above[table, at] = ids | {".".join(table): own} if own else ids
        key = ".".join(where for _, where in at)
        up = ".".join(where for _, where in at[:-1]) if at else None
        out.append((".".join(table), key, up, at[-1][0] if at else 0, own, ids, fields))
    return out


def flatten(rows: DataFrame, key: str, payload: str, wrappers: tuple[str, ...] = WRAPPERS) -> DataFrame:
    """The rows of all tables (see the module) of the records in ``payload``; record_key is the
    landing's ``key`` and record_at the record's place in its payload."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in ROW_SCHEMA.split(", ")]
        for batch in batches:
            out = []
            for k, text in zip(batch["k"], batch["p"], strict=True):
                for n, record in enumerate(_records(_parsed(text), wrappers)):
                    out.extend((k, n, *row) for row in pivot(record))
                    if len(out) >= 20_000:
                        yield pd.DataFrame(out, columns=names)
                        out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    return rows.select(F.col(key).cast("string").alias("k"), F.col(payload).alias("p")).filter("p is not null").mapInPandas(run, ROW_SCHEMA)


def unreadable(rows: DataFrame, key: str, payload: str, source: str, wrappers: tuple[str, ...] = WRAPPERS) -> DataFrame:
    """(source_table, reason, row): the payloads that gave no row to ``flatten``, whole, and why."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, text in zip(batch["k"], batch["p"], strict=True):
                if text is None or not text.strip():
                    reason = "no payload"
                elif (value := _parsed(text)) is None and text.strip() != "null":
                    reason = "not JSON"
                elif next(_records(value, wrappers), None) is None:
                    reason = "no record"
                else:
                    continue
                out.append((reason, json.dumps({"key": k, "payload": text})))
            yield pd.DataFrame(out, columns=["reason", "row"])

    found = rows.select(F.col(key).cast("string").alias("k"), F.col(payload).alias("p")).mapInPandas(run, "reason string, row string")
    return found.select(F.lit(source).alias("source_table"), "reason", "row")


def table_of(flat: DataFrame, table: str, columns: dict[str, str]) -> DataFrame:
    """One flat table: its keys, and the named members cast to the given types."""
    return flat.filter(F.col("table") == table).select(
        "record_key", "record_at", "row_key", "parent_key", "ordinal", "id",
        *[F.expr(f"try_cast(fields['{c}'] as {t})").alias(c.lower().replace(" ", "_")) for c, t in columns.items()],
    )


# Which table's id lies below which table's, by kind of tie.
BUDGET_TIES = {
    "budget_forecast": ("budget_forecast", ""),
    "segment_item": ("wbs_code.segment_items", ""),
    "segment": ("wbs_code.segment_items.segment", "wbs_code.segment_items"),
    "attribute_item": ("wbs_code.attribute_items", ""),
}


def ties(flat: DataFrame, kinds: dict[str, tuple[str, str]]) -> DataFrame:
    """(kind, parent_id, child_id), distinct, of the rows whose own id and named ancestor's id are there."""
    kind = F.coalesce(*[F.when(F.col("table") == child, F.lit(k)) for k, (child, _) in kinds.items()])
    parent = F.coalesce(*[F.when(F.col("table") == child, F.try_element_at("ids", F.lit(up))) for child, up in kinds.values()])
    out = flat.select(kind.alias("kind"), parent.alias("parent_id"), F.col("id").alias("child_id"))
    return out.filter("kind is not null and parent_id is not null and child_id is not null").distinct()


# A customer's record lies below its parent's, which is the record its parentref names.
CUSTOMER_TIES = {"customer": ("customer", "")}


def flatten_customers(customers: DataFrame, members: list[str] | None = None) -> DataFrame:
    """``flatten`` of dl_silver_qbo_customers: every row becomes a record of its parentref, with the
    reference's value as id, that holds the customer with its id and the named members."""
    own = F.struct(F.col("qbo_customer_id").alias("id"), *(members or []))
    record = F.to_json(F.struct(F.col("parentref.value").alias("id"), F.col("parentref.name").alias("name"), own.alias("customer")))
    return flatten(customers.select(F.col("qbo_customer_id").alias("_key"), record.alias("payload")), "_key", "payload", wrappers=())


def customer_ties(customers: DataFrame) -> DataFrame:
    """(kind, parent_id, child_id) of dl_silver_qbo_customers, whose parentref is a record in a record."""
    return ties(flatten_customers(customers), CUSTOMER_TIES)


def parent_child_ties(budget_rows: DataFrame, customers: DataFrame) -> DataFrame:
    return ties(flatten(budget_rows, "_key", "payload"), BUDGET_TIES).unionByName(customer_ties(customers))
