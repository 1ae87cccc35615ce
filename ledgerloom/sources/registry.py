"""Declared endpoints: checks, order of reading, expansion to paths, and the pull with its quota."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field, fields
from datetime import UTC, datetime, timedelta
from graphlib import CycleError, TopologicalSorter
from string import Formatter
from urllib.parse import urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Endpoint:
    """One source list. scope: company, project or parent; a parent endpoint reads once per record of ``parent``."""

    name: str
    table: str
    path: str
    scope: str = "company"
    parent: str | None = None
    key: str = "id"
    incremental: str | None = None
    where: tuple[str, str] | None = None
    window_days: int | None = None

    def problems(self) -> list[str]:
        allowed = {"company": set(), "project": {"project_id"}, "parent": {"project_id", "parent_id"}}
        if self.scope not in allowed:
            return [f"{self.name}: unknown scope {self.scope}"]
        held = {name for _, name, _, _ in Formatter().parse(self.path) if name}
        out = [f"{self.name}: nothing fills {{{p}}}" for p in sorted(held - allowed[self.scope] - {"company_id"})]
        if self.scope == "parent" and "parent_id" not in held:  # a company or project may go into the query instead
            out.append(f"{self.name}: path lacks {{parent_id}}")
        if (self.scope == "parent") != (self.parent is not None):
            out.append(f"{self.name}: scope and parent disagree")
        return out


def validate(endpoints: Iterable[Endpoint]) -> list[Endpoint]:
    """The endpoints, parents first; raises on doubled names or tables, unknown parents and cycles."""
    all_ = list(endpoints)
    bad = [p for e in all_ for p in e.problems()]
    for what in ("name", "table"):
        seen = [getattr(e, what) for e in all_]
        bad += [f"{what} {x} occurs twice" for x in sorted({x for x in seen if seen.count(x) > 1})]
    by = {e.name: e for e in all_}
    bad += [f"{e.name}: no endpoint {e.parent}" for e in all_ if e.parent and e.parent not in by]
    if bad:
        raise ValueError("; ".join(bad))
    try:
        order = list(TopologicalSorter({e.name: {e.parent} if e.parent else set() for e in all_}).static_order())
    except CycleError as x:
        raise ValueError(f"endpoints in a circle: {x.args[1]}") from x
    return [by[n] for n in order]


def load_registry(text: str) -> list[Endpoint]:
    """Endpoints of a JSON list of objects whose members are an endpoint's; checked as by ``validate``."""
    known = {f.name for f in fields(Endpoint)}
    rows = json.loads(text)
    if bad := sorted({k for r in rows for k in r if k not in known}):
        raise ValueError(f"unknown members {bad}")
    return validate(Endpoint(**{k: tuple(v) if isinstance(v, list) else v for k, v in r.items()}) for r in rows)


def parent_ids(records: DataFrame, where: tuple[str, str] | None = None) -> DataFrame:
    """Distinct (parent_id, project_id) of landed parent records, optionally of those with a member's value."""
    if where:
        records = records.filter(F.get_json_object("payload", f"$['{where[0]}']") == where[1])
    return records.filter("_key is not null").select(F.col("_key").alias("parent_id"), F.col("_project_id").alias("project_id")).distinct()


@dataclass(frozen=True)
class Call:
    """One request of a list: its path, query, and the project its records belong to."""

    path: str
    params: dict[str, str]
    project: str | None = None


def calls(endpoint: Endpoint, company: str, projects: Iterable[str] = (), parents: Iterable[tuple[str, str]] = ()) -> list[Call]:
    """Every request an endpoint needs. Ids that its path has no place for go into the query."""
    if endpoint.scope == "company":
        scopes = [{"company_id": company}]
    elif endpoint.scope == "project":
        scopes = [{"company_id": company, "project_id": p} for p in projects]
    else:
        scopes = [{"company_id": company, "project_id": p, "parent_id": i} for i, p in parents]
    out = []
    for scope in scopes:
        rest = {k: v for k, v in scope.items() if f"{{{k}}}" not in endpoint.path and k != "parent_id" and v is not None}
        out.append(Call(endpoint.path.format(**scope), rest, scope.get("project_id")))
    return out


def window_params(endpoint: Endpoint, now: datetime) -> dict[str, str]:
    if not endpoint.window_days:
        return {}
    return {"start_date": f"{now - timedelta(days=endpoint.window_days):%Y-%m-%d}", "end_date": f"{now:%Y-%m-%d}"}


def unwrap(payload: object, key: str | None = None) -> list[dict]:
    """Records of a reply: a list, a member that holds one, or a single record."""
    if payload is None:
        return []
    if isinstance(payload, list):
        return payload
    for k in (key, "data", "items", "results"):
        if k and isinstance(payload.get(k), list):
            return payload[k]
    return [payload]


# Replies worth another try, and limits of the pull.
RETRY = (429, 500, 502, 503, 504)
GONE = (403, 404)
ATTEMPTS, LONGEST_WAIT, MOST_PAGES = 5, 2400.0, 1000


class Unavailable(RuntimeError):
    """The source doesn't offer this list here; counted and skipped."""


class QuotaSpent(RuntimeError):
    pass


class TooMany(RuntimeError):
    """A source caps its results; reading on would lose some."""


@dataclass
class Reply:
    status: int
    body: object = None
    headers: dict[str, str] = field(default_factory=dict)


def _as_number(text: str | None) -> float | None:
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def wait_seconds(headers: dict[str, str], attempt: int, now: float, unit: str = "seconds") -> float:
    """What the reply asks for, in the unit its source uses; else the quota's reset and a second; else doubling.
    Headers that hold no number count as missing."""
    h = {k.lower(): v for k, v in headers.items()}
    asked, reset = _as_number(h.get("retry-after")), _as_number(h.get("x-rate-limit-reset"))
    if asked is not None:
        return asked / {"seconds": 1, "milliseconds": 1000}[unit]
    if reset is not None:
        return max(0.0, reset - now) + 1
    return float(2**attempt)


def reserve(limit: int | None) -> int:
    """Requests of the quota that are left for others: a fifth, two at least and twenty at most."""
    return 20 if limit is None else max(2, min(20, limit // 5))


def request(send: Callable[[], Reply], sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.time, unit: str = "seconds") -> Reply:
    for attempt in range(1, ATTEMPTS + 1):
        r = send()
        h = {k.lower(): v for k, v in r.headers.items()}
        if r.status in GONE:
            raise Unavailable(str(r.status))
        if r.status < 400:
            left = h.get("x-rate-limit-remaining")
            if left is not None and int(left) <= reserve(int(h["x-rate-limit-limit"]) if "x-rate-limit-limit" in h else None):
                wait = wait_seconds({k: v for k, v in h.items() if k == "x-rate-limit-reset"}, attempt, clock())
                if wait > LONGEST_WAIT:
                    raise QuotaSpent(f"quota comes back in {wait:.0f} s")
                sleep(wait)
            return r
        if r.status not in RETRY or attempt == ATTEMPTS:
            raise RuntimeError(f"reply {r.status} at attempt {attempt}")
        wait = wait_seconds(r.headers, attempt, clock(), unit)
        if wait > LONGEST_WAIT:
            raise QuotaSpent(f"asked to wait {wait:.0f} s")
        sleep(wait)
    raise AssertionError


def by_page(get: Callable[[dict], Reply], size: int, key: str | None = None, **io) -> Iterator[dict]:
    """Numbered pages, until an empty or short one or the total that the reply names."""
    seen = 0
    for page in range(1, MOST_PAGES + 1):
        r = request(lambda p=page: get({"page": p, "per_page": size}), **io)
        got = unwrap(r.body, key)
        yield from got
        seen += len(got)
        total = {k.lower(): v for k, v in r.headers.items()}.get("total")
        if len(got) < size or (total is not None and seen >= int(total)):
            return
    raise TooMany(f"more than {MOST_PAGES} pages")


def quoted(text: str) -> str:
    """A text as a literal of the query language: quotes and backslashes escaped."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def condition(column: str, operator: str, value: object) -> str:
    """One comparison for ``by_offset``; texts and times are quoted, so a value can't end its literal."""
    if operator not in ("=", "<", ">", "<=", ">=", "LIKE"):
        raise ValueError(f"unknown operator {operator}")
    if not column.replace(".", "").replace("_", "").isalnum():
        raise ValueError(f"no column name: {column}")
    value = f"{value:%Y-%m-%dT%H:%M:%S%z}" if isinstance(value, datetime) else value
    return f"{column} {operator} {value if isinstance(value, (int, float)) else quoted(str(value))}"


def by_offset(get: Callable[[dict], Reply], entity: str, size: int, where: Iterable[str] = (), **io) -> Iterator[dict]:
    """A query language with one-based start positions; ``where`` as made by ``condition``."""
    start, limits = 1, " AND ".join(where)
    while True:
        q = f"SELECT * FROM {entity}{' WHERE ' + limits if limits else ''} STARTPOSITION {start} MAXRESULTS {size}"
        got = unwrap((request(lambda q=q: get({"query": q}), **io).body or {}).get("QueryResponse", {}).get(entity))
        yield from got
        if len(got) < size:
            return
        start += size


def active_projects(get: Callable[[dict], Reply], size: int = 1000, **io) -> Iterator[dict]:
    """Only what the source itself calls active: the filter runs there, so closed projects cost no request."""
    return by_page(lambda p: get(p | {"filters[by_status]": "Active"}), size, **io)


def by_cursor(get: Callable[[dict], Reply], size: int, most: int | None = None, asked: dict | None = None, **io) -> Iterator[dict]:
    """Opaque cursors. Where the source caps what it returns at ``most``, reaching the cap raises: a list that
    ends there may be whole or cut off, and nothing later could tell."""
    after, seen = None, 0
    while True:
        body = request(lambda a=after: get((asked or {}) | {"limit": size} | ({"after": a} if a else {})), **io).body or {}
        got = unwrap(body) if body.get("results", body) else []
        seen += len(got)
        if most is not None and (seen >= most or (body.get("total") or 0) >= most):
            raise TooMany(f"{most} results or more; read smaller windows")
        yield from got
        after = (body.get("paging") or {}).get("next", {}).get("after")
        if not after or not got:
            return


# The longest look-back a change feed allows, less a day; the most that a search returns.
FEED_DAYS, SEARCH_CAP = 29, 10_000


def changed_since(get: Callable[[dict], Reply], changed: str, since: datetime, size: int = 200, columns: Iterable[str] = (), most: int = SEARCH_CAP, **io) -> Iterator[dict]:
    """Records changed at or after a time, oldest change first, by a search that the source caps."""
    at = str(int(since.astimezone(UTC).timestamp() * 1000))
    asked = {"filterGroups": [{"filters": [{"propertyName": changed, "operator": "GTE", "value": at}]}], "sorts": [{"propertyName": changed, "direction": "ASCENDING"}]}
    return by_cursor(get, size, most, asked | ({"properties": list(columns)} if columns else {}), **io)


def change_feed(get: Callable[[dict], Reply], entities: Iterable[str], since: datetime, now: datetime, **io) -> Iterator[tuple[str, dict]]:
    """(entity, record) of every change of several entities in one request. A look-back beyond what the source
    allows is shortened to it: what is older shows only in a full read."""
    start = max(since.astimezone(UTC), now.astimezone(UTC) - timedelta(days=FEED_DAYS))
    body = request(lambda: get({"entities": ",".join(entities), "changedSince": f"{start:%Y-%m-%dT%H:%M:%S}-00:00"}), **io).body or {}
    for part in body.get("CDCResponse") or []:
        for answer in part.get("QueryResponse") or []:
            yield from ((entity, r) for entity, rows in answer.items() if isinstance(rows, list) for r in rows)


def report(get: Callable[[dict], Reply], name: str, params: dict | None = None, **io) -> dict:
    """A report, which comes as one nested record and is landed as one: (report, params, body)."""
    return {"id": name, "params": dict(params or {}), "body": request(lambda: get({"report": name, **(params or {})}), **io).body}


def reference_set(get: Callable[[dict], Reply], size: int = 100, **io) -> list[dict]:
    """A short list read whole at every run, such as stages or owners."""
    return list(by_cursor(get, size, **io))


@dataclass
class Pull:
    """What a pull brought and what it had to leave out."""

    records: int = 0
    unavailable: dict[str, int] = field(default_factory=dict)


def pull(endpoint: Endpoint, todo: Iterable[Call], read: Callable[[Call], Iterator[dict]], land: Callable[[Endpoint, Call, list[dict]], None], so_far: Pull | None = None) -> Pull:
    """Reads every call of an endpoint and lands its records. A list that isn't offered for one project is counted
    and skipped, whatever it had brought before; any other failure ends the pull."""
    out = so_far or Pull()
    for call in todo:
        try:
            got = list(read(call))
        except Unavailable:
            out.unavailable[endpoint.name] = out.unavailable.get(endpoint.name, 0) + 1
            continue
        land(endpoint, call, got)
        out.records += len(got)
    return out


def base_url(text: str | None, default: str) -> str:
    """Scheme and host of an address as somebody copied it; ``default`` where there is none."""
    text = (text or "").strip()
    parts = urlsplit(text if "//" in text else f"https://{text}")
    return f"{parts.scheme or 'https'}://{parts.netloc}" if parts.netloc else default


def updated_range(since: datetime, until: datetime) -> str:
    return f"{since.astimezone(UTC):%Y-%m-%dT%H:%M:%SZ}...{until.astimezone(UTC):%Y-%m-%dT%H:%M:%SZ}"
