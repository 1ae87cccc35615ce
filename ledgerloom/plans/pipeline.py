"""A run from landing to checked results: builders in order of their needs, each a whole rebuild that
readers see at once, a run log, checks with their results kept, and marks that move only after success."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators import quality
from ledgerloom.sources import landing, versioned


@dataclass(frozen=True)
class Builder:
    """One table: a pure function of the tables it needs."""

    name: str
    build: Callable[..., DataFrame]
    needs: tuple[str, ...] = ()


def ordered(builders: list[Builder], given: set[str] = frozenset()) -> list[Builder]:
    """Builders after what they need; raises on doubled names, needs nobody meets, and circles."""
    by = {b.name: b for b in builders}
    if len(by) < len(builders):
        raise ValueError("two builders of one name")
    if lost := sorted({n for b in builders for n in b.needs} - by.keys() - given):
        raise ValueError(f"nothing builds {lost}")
    try:
        order = list(TopologicalSorter({b.name: [n for n in b.needs if n in by] for b in builders}).static_order())
    except CycleError as x:
        raise ValueError(f"builders in a circle: {x.args[1]}") from x
    return [by[n] for n in order]


@dataclass
class Run:
    """What a run left: rows by table, results of the checks, and its log (step, rows, status)."""

    tables: dict[str, DataFrame]
    counts: dict[str, int]
    results: DataFrame | None
    log: list[tuple[str, int, str]]


def run(
    spark: SparkSession, builders: list[Builder], given: dict[str, DataFrame], folder: str, batch: str, now: datetime,
    suite: Callable[[dict[str, DataFrame]], list[quality.Expectation]] | None = None, marks: list[tuple[str, str, datetime | None]] = (),
) -> Run:
    """Builds every table below ``folder``, checks them, and moves ``marks`` (table, endpoint, mark) if nothing blocks.

    A builder that fails ends the run with its line in the log; what stood before still stands, for a
    table only changes when its new state is whole. Row counts come from the writes themselves.
    Results, rejects and diagnostics are written before a blocking check raises.
    """
    out = Run(dict(given), {}, None, [])

    def say(step: str, table: str, rows: int, status: str, message: str = "") -> None:
        out.log.append((step, rows, status))
        landing.log_run(spark, f"{folder}/_log", batch, step, table, rows, status, message, now)

    for b in ordered(builders, set(given)):
        try:
            rows = versioned.rebuild(b.build(*[out.tables[n] for n in b.needs]), f"{folder}/{b.name}")
        except Exception as x:
            say(b.name, b.name, 0, "failed", str(x)[:500])
            raise
        out.tables[b.name] = versioned.read_table(spark, f"{folder}/{b.name}")
        out.counts[b.name] = rows
        say(b.name, b.name, rows, "done")
    if suite is not None:
        checks = suite(out.tables)
        out.results = quality.run_suite(spark, out.tables, checks)
        quality.persist(out.tables, checks, out.results, f"{folder}/_quality", batch, now)
        landing.write_diagnostics(spark, f"{folder}/_diagnostics/{batch}", {n: out.tables[n] for n in out.counts}, out.counts)
        s = quality.summary(out.results).first()
        say("checks", "", s.checks, "blocked" if s.blocking else "done", f"{s.blocking} blocking, {s.warnings} warnings")
        quality.assert_no_blocking(out.results)
    for name, endpoint, mark in marks:
        landing.write_mark(spark, f"{folder}/_marks", name, endpoint, mark, batch, now)
    return out
