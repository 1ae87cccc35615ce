"""Measures under a filter context: named aggregates, evaluated at any grain, ratios of sums never means of ratios."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """Either an aggregate over ``fact`` or an expression of other measures (``needs``) after aggregation."""

    name: str
    fact: str | None = None
    agg: Column | None = None
    post: Column | None = None
    needs: tuple[str, ...] = ()
    #: Value where a fact has no row at all for a group that another fact has.
    empty: object = None
    #: Shifts the measure in time: "prior_month", "running", or ("trailing", n, "days" or "months").
    shift: object = None


def total(name: str, fact: str, column: str, where: Column | None = None, blank: bool = True) -> Measure:
    """Sum, null where nothing is there, or 0 if not ``blank``."""
    x = F.sum(F.col(column) if where is None else F.when(where, F.col(column)))
    return Measure(name, fact, x if blank else F.coalesce(x, F.lit(0.0)), empty=None if blank else 0.0)


def rows_where(name: str, fact: str, where: Column | None = None) -> Measure:
    return Measure(name, fact, F.count("*") if where is None else F.count_if(where), empty=0)


def distinct_where(name: str, fact: str, column: str, where: Column) -> Measure:
    return Measure(name, fact, F.count_distinct(F.when(where, F.col(column))), empty=0)


def mean(name: str, fact: str, column: str) -> Measure:
    return Measure(name, fact, F.avg(column))


def ratio(name: str, n: str, d: str) -> Measure:
    """Null where the denominator is zero or null."""
    return Measure(name, post=F.when(F.col(d) != 0, F.col(n) / F.col(d)), needs=(n, d))


def derived(name: str, needs: tuple[str, ...], post: Column) -> Measure:
    return Measure(name, post=post, needs=needs)


def prior_month(name: str, of: str) -> Measure:
    """``of`` one calendar month before; null where that month holds nothing."""
    return Measure(name, needs=(of,), shift="prior_month")


def trailing(name: str, of: str, n: int, unit: str = "days") -> Measure:
    """``of``, a sum, over the ``n`` days or months that end with each group's date."""
    return Measure(name, needs=(of,), shift=("trailing", n, unit))


def running(name: str, of: str) -> Measure:
    """``of``, a sum, over all of the selection's dates up to each group's."""
    return Measure(name, needs=(of,), shift="running")


def label(name: str, of: str, steps: list[tuple[float, str]], otherwise: str, none: str | None = None) -> Measure:
    """A ladder of labels: the first whose limit ``of`` reaches, limits falling; ``none`` where ``of`` is null."""
    value = F.when(F.col(of).isNull(), F.lit(none))
    for limit, text in steps:
        value = value.when(F.col(of) >= limit, F.lit(text))
    return Measure(name, post=value.otherwise(F.lit(otherwise)), needs=(of,))


class Model:
    """Facts, their lookups, and measures.

    lookups: fact to [(dimension, fact key, dimension key)], joined left and only when a grouping or
    filter column lies in that dimension.
    """

    def __init__(self, facts: dict[str, DataFrame], measures: list[Measure], dims: dict[str, DataFrame] | None = None, lookups: dict[str, list[tuple[str, str, str]]] | None = None):
        self.facts, self.dims, self.lookups = facts, dims or {}, lookups or {}
        self.measures = {m.name: m for m in measures}

    def _closure(self, names: list[str]) -> list[Measure]:
        out: dict[str, Measure] = {}

        def add(name: str) -> None:
            for n in self.measures[name].needs:
                add(n)
            out.setdefault(name, self.measures[name])

        for n in names:
            add(n)
        return list(out.values())

    def rows(self, fact: str, columns: set[str]) -> DataFrame:
        df = self.facts[fact]
        for dim, fk, dk in self.lookups.get(fact, []):
            wanted = [c for c in self.dims[dim].columns if c in columns and c not in df.columns]
            if wanted:
                df = df.join(self.dims[dim].select(F.col(dk).alias(fk), *[c for c in wanted if c != dk], *[F.col(dk).alias(c) for c in wanted if c == dk]), fk, "left")
        return df

    def query(self, names: list[str], by: list[str] | None = None, where: Column | None = None, where_columns: set[str] = frozenset(), date: str | None = None) -> DataFrame:
        """Each fact is filtered and aggregated on its own at the grain ``by``; the grains are then
        joined, so facts never meet row by row. Facts without a grouping column repeat their total,
        and a filter on columns that a fact can't reach doesn't apply to it, as in a star schema
        without that relationship; at least one fact must have them. A group that a fact lacks takes
        the measure's ``empty``. ``date`` names the grouping column along which measures are shifted;
        their groups are the others. A filter on ``date`` itself cuts after the shift, so a prior month is found outside it.
        """
        by, used = by or [], self._closure(names)
        shifted = [m for m in used if m.shift]
        if shifted and date not in by:
            raise ValueError(f"{shifted[0].name} needs a date among {by}")
        late = where is not None and date in where_columns and bool(shifted)
        grains, reached = [], False
        for fact in dict.fromkeys(m.fact for m in used if m.fact):
            df = self.rows(fact, {*by, *where_columns})
            if where is not None and where_columns <= set(df.columns):
                reached = True
                df = df if late else df.filter(where)
            keys = [c for c in by if c in df.columns]
            grains.append((keys, df.groupBy(*keys).agg(*[m.agg.alias(m.name) for m in used if m.fact == fact])))
        if where is not None and not reached:
            raise ValueError(f"no fact has {sorted(where_columns)}")
        if late and not where_columns <= set(by):
            raise ValueError("a filter on the date of shifted measures can only name grouping columns")
        grains.sort(key=lambda g: -len(g[0]))
        keys, out = grains[0]
        for k, g in grains[1:]:
            if not k:
                out = out.join(F.broadcast(g))  # one row
            else:
                g = g.withColumnsRenamed({c: f"_{c}" for c in k})
                on = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in k))
                both = out.join(g, on, "full")
                out = both.select(*[F.coalesce(c, f"_{c}").alias(c) for c in k], *[c for c in both.columns if c not in k and c not in [f"_{x}" for x in k]])
        out = out.withColumns({m.name: F.coalesce(m.name, F.lit(m.empty)) for m in used if m.empty is not None})
        for m in used:
            if m.post is not None:
                out = out.withColumn(m.name, m.post)
            elif m.shift:
                out = shift_measure(out, m, date, [c for c in by if c != date and c in out.columns])
        if late:
            out = out.filter(where)
        return out.select(*[c for c in by if c in out.columns], *names)

    def slicer(self, column: str, sort: str | None = None) -> DataFrame:
        """(column[, sort]) for a slicer: the distinct values a dimension or fact offers, in the order of ``sort``, which must stand for one value each."""
        source = next((df for df in (*self.dims.values(), *self.facts.values()) if column in df.columns and (sort is None or sort in df.columns)), None)
        if source is None:
            raise ValueError(f"nothing holds {column}{f' and {sort}' if sort else ''}")
        values = source.select(column, *([sort] if sort else [])).filter(F.col(column).isNotNull()).distinct()
        if sort and (bad := not_one_to_one(values, column, sort).limit(1).collect()):
            raise ValueError(f"{sort} does not sort {column}: {bad[0][0]}")
        return values.orderBy(sort or column)


def not_one_to_one(rows: DataFrame, column: str, sort: str) -> DataFrame:
    """Values of ``sort`` that stand for several of ``column``."""
    pairs = sort_pairs(rows, column, sort)
    return pairs.filter("not one_to_one").select("sort_key")


def sort_pairs(rows: DataFrame, column: str, sort: str) -> DataFrame:
    """(sort_key, labels, one_to_one): how many values of ``column`` each value of ``sort`` stands for."""
    return rows.groupBy(F.col(sort).alias("sort_key")).agg(F.count_distinct(column).alias("labels"), (F.min(column) == F.max(column)).alias("one_to_one"))


def shift_measure(rows: DataFrame, m: Measure, date: str, by: list[str]) -> DataFrame:
    """Adds a time measure to aggregated rows, one for each group and date."""
    (of,) = m.needs
    if m.shift == "prior_month":
        prior = rows.select(*[F.col(c).alias(f"_{c}") for c in by], F.add_months(F.col(date), 1).alias("_date"), F.col(of).alias(m.name))
        on = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by), F.col(date) == F.col("_date"))
        return rows.join(prior, on, "left").drop("_date", *[f"_{c}" for c in by])
    if m.shift == "running":
        return rows.withColumn(m.name, F.sum(of).over(Window.partitionBy(*by).orderBy(date).rangeBetween(Window.unboundedPreceding, 0)))
    _, n, unit = m.shift
    at = F.datediff(F.col(date), F.lit(_EPOCH)) if unit == "days" else F.year(date) * 12 + F.month(date)
    return rows.withColumn(m.name, F.sum(of).over(Window.partitionBy(*by).orderBy(at).rangeBetween(-(n - 1), 0)))


_EPOCH = date(1970, 1, 1)


def running_total(rows: DataFrame, value: str, order: str, by: list[str] | None = None) -> DataFrame:
    """Adds ``running``: the sum up to and with each row. Meant for report grains; ``by`` or not, the rows are aggregates."""
    w = Window.partitionBy(*(by or [])).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("running", F.sum(value).over(w))


def against_prior_month(rows: DataFrame, value: str, month: str, by: list[str]) -> DataFrame:
    """Adds ``change``: value less the value one calendar month before; null if that month is missing."""
    prior = rows.select(*by, F.add_months(F.col(month), 1).alias(month), F.col(value).alias("_prior"))
    return rows.join(prior, [*by, month], "left").withColumn("change", F.col(value) - F.col("_prior")).drop("_prior")


def trailing_sum(rows: DataFrame, value: str, day: str, days: int, by: list[str]) -> DataFrame:
    """Adds ``trailing``: the sum over the ``days`` days that end with each row's day."""
    n = F.datediff(F.col(day), F.lit(date(1970, 1, 1)))
    w = Window.partitionBy(*by).orderBy(n).rangeBetween(-(days - 1), 0)
    return rows.withColumn("trailing", F.sum(value).over(w))


@dataclass(frozen=True)
class Report:
    """A report table: grouping columns, measures, and a sort by one shown column."""

    name: str
    by: tuple[str, ...]
    measures: tuple[str, ...]
    sort: str | None = None
    descending: bool = True
    limit: int | None = None
    #: What the report shows, in words, for those who can't see it; required of every report that is published.
    text: str = ""

    def problems(self, model: Model) -> list[str]:
        known = {c for df in (*model.facts.values(), *model.dims.values()) for c in df.columns}
        out = [f"unknown column {c}" for c in self.by if c not in known]
        out += [f"unknown measure {m}" for m in self.measures if m not in model.measures]
        if self.sort and self.sort not in (*self.by, *self.measures):
            out.append(f"sorted by {self.sort}, which isn't shown")
        return out

    def publishing_problems(self, model: Model) -> list[str]:
        """As problems; a report without a text in words isn't published either."""
        return self.problems(model) + ([] if self.text.strip() else ["no text"])

    def run(self, model: Model, where: Column | None = None, where_columns: set[str] = frozenset(), date: str | None = None) -> DataFrame:
        if found := self.problems(model):
            raise ValueError(f"{self.name}: {'; '.join(found)}")
        out = model.query(list(self.measures), list(self.by), where, where_columns, date)
        if self.sort:
            out = out.orderBy(F.desc_nulls_last(self.sort) if self.descending else F.asc_nulls_last(self.sort), *self.by)
        return out.limit(self.limit) if self.limit else out
