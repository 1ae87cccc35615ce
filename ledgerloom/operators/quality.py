"""Expectations: each is the rows that break it; a suite counts all checks of a table in one pass."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Expectation:
    """``predicate`` marks a row of ``table`` that breaks the expectation; a check that one row can't
    decide gives ``failing``, the failing rows, instead."""

    name: str
    table: str
    severity: str = "error"
    predicate: Column | None = None
    failing: Callable[[Tables], DataFrame] | None = None
    description: str = ""

    def rows(self, tables: Tables) -> DataFrame:
        return self.failing(tables) if self.failing else tables[self.table].filter(self.predicate)


def not_null(table: str, column: str, severity: str = "error") -> Expectation:
    return Expectation(f"{table}.{column}.not_null", table, severity, F.col(column).isNull(), description=f"{column} is missing")


def in_range(table: str, column: str, low: float, high: float, severity: str = "error") -> Expectation:
    return Expectation(f"{table}.{column}.range", table, severity, (F.col(column) < low) | (F.col(column) > high), description=f"{column} outside {low}..{high}")


def date_order(table: str, earlier: str, later: str, severity: str = "error") -> Expectation:
    return Expectation(f"{table}.{earlier}.before_{later}", table, severity, F.col(later) < F.col(earlier), description=f"{later} before {earlier}")


def holds(name: str, table: str, broken: Column, severity: str = "error", description: str = "") -> Expectation:
    return Expectation(name, table, severity, broken, description=description)


def unique_key(table: str, columns: list[str], severity: str = "error") -> Expectation:
    """Failing rows are the keys that occur more than once."""
    dup = lambda t: t[table].groupBy(*columns).agg(F.count("*").alias("copies")).filter("copies > 1")
    return Expectation(f"{table}.{'_'.join(columns)}.unique", table, severity, failing=dup, description="key occurs more than once")


def referential(table: str, column: str, parent: str, parent_column: str, severity: str = "error") -> Expectation:
    """Failing rows are those whose non-null key the parent lacks."""

    def orphans(t: Tables) -> DataFrame:
        keys = t[parent].select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull()).distinct()
        return t[table].filter(F.col(column).isNotNull()).join(keys, column, "left_anti")

    return Expectation(f"{table}.{column}.fk_{parent}", table, severity, failing=orphans, description=f"{column} not in {parent}")


def freshness(table: str, column: str, now: datetime, max_hours: int, severity: str = "warn") -> Expectation:
    """Fails, with one row, if the newest time is too old or there is none at all."""
    old = lambda t: t[table].agg(F.max(column).alias("newest")).filter(F.col("newest").isNull() | (F.col("newest") < F.lit(now - timedelta(hours=max_hours))))
    return Expectation(f"{table}.{column}.freshness", table, severity, failing=old, description=f"older than {max_hours} h")


RESULTS = "expectation string, table_name string, severity string, failing_rows long, passed boolean, description string"


def _counts(tables: Tables, suite: list[Expectation]) -> DataFrame:
    """(i, failing_rows) by position in the suite: the row predicates of one table share one aggregation, the others are one count each."""
    parts, by_table = [], {}
    for i, e in enumerate(suite):
        if e.predicate is not None:
            by_table.setdefault(e.table, []).append((i, e))
        else:
            parts.append(e.rows(tables).agg(F.count("*").alias("failing_rows")).select(F.lit(i).alias("i"), "failing_rows"))
    for name, es in by_table.items():
        counts = tables[name].agg(*[F.count_if(e.predicate).alias(f"n{i}") for i, e in es])
        parts.append(counts.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"n{i}").alias("failing_rows")) for i, _ in es]))))
    return reduce(DataFrame.unionByName, parts)


def run_suite(spark: SparkSession, tables: Tables, suite: list[Expectation]) -> DataFrame:
    """(expectation, table_name, severity, failing_rows, passed, description), one row each.

    The suite runs as one plan. Whatever can't be planned, or throws while it runs, never stops the
    others: if the plan fails its checks run one by one, and those that fail alone count as failed, with -1 rows.
    """
    found: dict[int, int] = {}

    def run(positions: list[int]) -> None:
        if not positions:
            return
        try:
            for r in _counts(tables, [suite[i] for i in positions]).collect():
                found[positions[r.i]] = r.failing_rows
        except Exception:
            if len(positions) > 1:
                for i in positions:
                    run([i])
            else:
                found[positions[0]] = -1

    sound = []
    for i, e in enumerate(suite):
        try:
            e.rows(tables).schema  # noqa: B018  analysis errors surface here
            sound.append(i)
        except Exception:
            found[i] = -1
    run(sound)
    return spark.createDataFrame([(e.name, e.table, e.severity, found[i], found[i] == 0, e.description) for i, e in enumerate(suite)], RESULTS)


def rejects(tables: Tables, suite: list[Expectation], most: int | None = 1000) -> DataFrame:
    """(expectation, severity, row): failing rows of each expectation as JSON. The log holds up to ``most`` of
    each, the counts are whole; with None all rows are given out."""
    cut_off = lambda df: df if most is None else df.limit(most)
    parts = [cut_off(e.rows(tables)).select(F.lit(e.name).alias("expectation"), F.lit(e.severity).alias("severity"), F.to_json(F.struct("*")).alias("row")) for e in suite]
    return reduce(DataFrame.unionByName, parts)


def persist(tables: Tables, suite: list[Expectation], results: DataFrame, folder: str, batch: str, at: datetime, most: int | None = 1000) -> None:
    """Appends a run's results, and the rows its failed checks reject, to ``folder``/results and /rejects.
    A check that threw has no rows to keep."""
    stamp = [F.lit(batch).alias("batch_id"), F.lit(at).alias("checked_at")]
    results.select("*", *stamp).write.mode("append").parquet(f"{folder}/results")
    failed = {r.expectation for r in results.filter("failing_rows > 0").select("expectation").collect()}
    if todo := [e for e in suite if e.name in failed]:
        rejects(tables, todo, most).select("*", *stamp).write.mode("append").parquet(f"{folder}/rejects")


def summary(results: DataFrame) -> DataFrame:
    """(checks, passed, blocking, warnings, not_run) over a run's results, one row."""
    bad = ~F.col("passed")
    return results.agg(
        F.count("*").alias("checks"), F.count_if("passed").alias("passed"), F.count_if(bad & (F.col("severity") == "error")).alias("blocking"),
        F.count_if(bad & (F.col("severity") != "error")).alias("warnings"), F.count_if(F.col("failing_rows") < 0).alias("not_run"),
    )


class BlockingFailure(RuntimeError):
    pass


def assert_no_blocking(results: DataFrame) -> None:
    failed = [r.expectation for r in results.filter("not passed and severity = 'error'").select("expectation").collect()]
    if failed:
        raise BlockingFailure(", ".join(sorted(failed)))
