"""Column-level data quality profile of tables that arrive in loads (problem 5).

Values are generalised to character-class masks (runs of capitals, runs of small letters, digits,
everything else as it is), the dominant masks of each column are mined from all loads, and each load
is compared with the rest of the table: the share of values that are, or whose mask is, rare elsewhere,
the distance of its mask, value and decile distributions from those of the other loads, the share of
its commonest value, and its null rate, distinct rate and range. Every column is compared value by
value, however many values it has; what a load's size alone does to its distance and distinct rate
is worked out from the table's frequencies and taken off.

Three passes with map-side combine: one for the table (a row for the driver, as wide as the table
has columns), one for each load and column, one for the (load, column, mask, value or decile cell)
counts. A load with a third of all rows shrinks to its cells before anything moves.

Defined results: rows without a load belong to none; a column null throughout has null measures and
no masks; distinct counts of ``loads`` are sketch estimates, those compared are exact; NaN counts as null; tables of
two loads are judged one against the other, and both reported if they are far apart; a single load has nothing to
stand outside of; loads of a few rows are judged by what chance allows, so one or two values that fit no other load
are reported only if out of range; columns are profiled by position-free name, so a
column that isn't named to be profiled can have any name; an empty table gives empty results.
"""

from __future__ import annotations

from functools import cached_property, reduce
from math import pi

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.runtime import cut

#: A mask with less than this share of a column's values is rare.
RARE_SHARE = 0.01
#: A measure of a load is far outside when it lies SHIFT beyond the middle of all loads, as a share
#: of the load's values (for ranges: in powers of ten, for dates: in usual spans of a load from
#: percentile 5 to 95), and SIGMAS robust deviations as well. Its least and greatest value are judged
#: against the outermost of the other loads, beyond which they must lie as far.
SHIFT = 0.2
RANGE_SHIFT = 1.0
SIGMAS = 5.0


def mask(value: Column) -> Column:
    """Character-class mask: A for capitals, a for small letters, words of them that follow one
    another as one, digits one by one, so a code of the wrong length has another mask, but as one run in decimals."""
    m = F.regexp_replace(value, r"\p{Lu}+", "A")
    m = F.regexp_replace(m, r"\p{Ll}+", "a")
    m = F.regexp_replace(m, r"[0-9]", "9")
    m = F.regexp_replace(m, r"9+\.9+", "9+")
    for word in ("Aa", "A", "a"):
        m = F.regexp_replace(m, rf"\b{word}(?: {word}\b)+", f"{word}+")
    return m


def _number(field: T.StructField) -> Column | None:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.NumericType):
        x = c.cast("double")
        return F.when(~F.isnan(x), x)
    if isinstance(field.dataType, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_seconds(c.cast("timestamp")).cast("double") / 86400
    return None


def _text(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        c = F.when(~F.isnan(c), c)
    elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        c = F.when(c.isNotNull(), F.to_json(c)) if not isinstance(field.dataType, T.ArrayType) else F.to_json(c)
    return c.cast("string")


class Profile:
    """The profile of the named columns of ``rows``, by the load that ``load`` names. rare_share, shift,
    range_shift and sigmas are the bounds that the constants above give by default."""

    def __init__(
        self, rows: DataFrame, table: str, load: str, columns: list[str], rare_share: float = RARE_SHARE, shift: float = SHIFT, range_shift: float = RANGE_SHIFT, sigmas: float = SIGMAS
    ):
        self.rare_share, self.shift, self.range_shift, self.sigmas = rare_share, shift, range_shift, sigmas
        self.table, self.load = table, "load of the row"  # a name no alias below can clash with
        self.fields = [rows.schema[c] for c in columns]
        named = [F.col(f"`{c}`") for c in columns if c != load]
        self.rows = rows.select(F.col(f"`{load}`").cast("string").alias(self.load), *named).filter(F.col(f"`{self.load}`").isNotNull())
        asked = []
        for i, f in enumerate(self.fields):
            x = _number(f)
            if x is not None:
                asked.append(F.percentile_approx(x, [k / 10 for k in range(1, 10)], 1000).alias(f"q{i}"))
        whole = self.rows.agg(*asked).first().asDict() if asked else {}
        self.edges = {f.name: sorted(set(whole.get(f"q{i}") or [])) for i, f in enumerate(self.fields)}

    @property
    def _kinds(self) -> list[tuple[str, str]]:
        """Columns with masks: texts, whole numbers and whatever is no number, date or truth value."""
        return [(f.name, "mask") for f in self.fields if _number(f) is None and not isinstance(f.dataType, T.BooleanType) or isinstance(f.dataType, T.IntegralType)]

    @cached_property
    def loads(self) -> DataFrame:
        """(table_name, column_name, batch_id, row_count, nulls, distinct_values, low, middle, high,
        least, greatest) of each column and load; low, middle and high are percentiles 5, 50, 95."""
        aggs = [F.count("*").alias("n")]
        for i, f in enumerate(self.fields):
            t, x = _text(f), _number(f)
            aggs += [F.count(t).alias(f"c{i}"), F.hll_sketch_estimate(F.hll_sketch_agg(t, 12)).alias(f"d{i}"), F.min(t).alias(f"a{i}"), F.max(t).alias(f"z{i}")]
            if x is not None:
                aggs += [F.percentile_approx(x, [0.05, 0.5, 0.95], 1000).alias(f"q{i}"), F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}")]
        wide = self.rows.groupBy(f"`{self.load}`").agg(*aggs)
        cells = []
        for i, f in enumerate(self.fields):
            num = _number(f) is not None
            q = (lambda k, i=i: F.col(f"q{i}")[k]) if num else (lambda k: F.lit(None).cast("double"))
            cells.append(
                F.struct(
                    F.lit(f.name).alias("column_name"), (F.col("n") - F.col(f"c{i}")).alias("nulls"), F.col(f"d{i}").alias("distinct_values"),
                    q(0).alias("low"), q(1).alias("middle"), q(2).alias("high"),
                    (F.col(f"l{i}").cast("string") if num else F.col(f"a{i}")).alias("least"), (F.col(f"h{i}").cast("string") if num else F.col(f"z{i}")).alias("greatest"),
                )
            )
        out = wide.select(F.lit(self.table).alias("table_name"), F.col(f"`{self.load}`").alias("batch_id"), F.col("n").alias("row_count"), F.explode(F.array(*cells)).alias("c"))
        return cut(out.select("table_name", "c.column_name", "batch_id", "row_count", *[f"c.{c}" for c in ("nulls", "distinct_values", "low", "middle", "high", "least", "greatest")]))

    @cached_property
    def cells(self) -> DataFrame:
        """(column_name, batch_id, kind, cell, n): how many values of a load have a mask, and how many
        fall on a value or between two deciles (numbers and dates). Long values go by their digest."""
        each = []
        for f in self.fields:
            t, x = _text(f), _number(f)
            if (f.name, "mask") in self._kinds:
                each.append((f.name, "mask", mask(t)))
            each.append((f.name, "value", F.when(F.length(t) > 64, F.sha2(t, 256)).otherwise(t)))
            if x is not None and self.edges[f.name]:
                above = reduce(lambda a, b: a + b, [(x >= e).cast("int") for e in self.edges[f.name]])
                each.append((f.name, "decile", above.cast("string")))
        rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("kind"), v.alias("cell")) for c, k, v in each])
        long = self.rows.select(F.col(f"`{self.load}`").alias("batch_id"), F.explode(rows).alias("c")).select("batch_id", "c.*")
        return cut(long.filter("cell is not null").groupBy("column_name", "batch_id", "kind", "cell").agg(F.count("*").alias("n")))

    def divergence(self) -> DataFrame:
        """(column_name, batch_id, kind, own, distance, rare, top, cells, chance_distance, chance_cells):
        the load's values, total variation distance of its cells from those of all other loads, share
        of its values in cells that are rare there, share of its commonest cell and number of cells;
        and the distance and number of cells that a load of its size has when its values are drawn
        from the table's by chance."""
        cells = self.cells
        pool = cells.groupBy("column_name", "kind", "cell").agg(F.sum("n").alias("pool"))
        own = cells.groupBy("column_name", "batch_id", "kind").agg(F.sum("n").alias("own"))
        whole = cells.groupBy("column_name", "kind").agg(F.sum("n").alias("whole"))
        x = cells.join(pool, ["column_name", "kind", "cell"]).join(own, ["column_name", "batch_id", "kind"]).join(whole, ["column_name", "kind"])
        here = F.col("n") / F.col("own")
        there = F.when(F.col("whole") > F.col("own"), (F.col("pool") - F.col("n")) / (F.col("whole") - F.col("own"))).otherwise(here)
        x = x.groupBy("column_name", "batch_id", "kind").agg(
            F.first("own").alias("own"), F.first("whole").alias("whole"),
            F.sum(F.greatest(here - there, F.lit(0.0))).alias("distance"),  # half the absolute differences
            F.sum(F.when(there < self.rare_share, here).otherwise(0.0)).alias("rare"),
            F.max(here).alias("top"), F.count("*").alias("cells"),
        )
        # how many cells occur how often, four steps to a doubling: some hundred numbers per column
        often = pool.groupBy("column_name", "kind", F.floor(F.log2("pool") * 4).alias("step")).agg(F.count("*").alias("c"), F.avg("pool").alias("f"))
        often = often.groupBy("column_name", "kind").agg(F.collect_list(F.struct(F.col("c").cast("double").alias("c"), "f")).alias("often"))
        part = F.col("own") / F.col("whole")

        def scatter(f: Column) -> Column:
            """Mean absolute deviation of a binomial count of f tries; exact near its ends."""
            return F.when(f * part < 1, 2 * f * part * (1 - part) ** f).when(f * (1 - part) < 1, 2 * f * (1 - part) * part**f).otherwise(F.sqrt(f * part * (1 - part) * (2 / pi)))

        add = lambda value: F.aggregate("often", F.lit(0.0), lambda sum_, o: sum_ + o["c"] * value(o["f"]))
        apart = F.when(F.col("whole") > F.col("own"), F.col("whole") / (2 * F.col("own") * (F.col("whole") - F.col("own")))).otherwise(0.0)
        return x.join(often, ["column_name", "kind"]).select(
            "column_name", "batch_id", "kind", "own", "distance", "rare", "top", "cells",
            F.least(F.lit(1.0), add(scatter) * apart).alias("chance_distance"), add(lambda f: 1 - (1 - part) ** f).alias("chance_cells"),
        )

    def masks(self) -> DataFrame:
        """(table_name, column_name, mask, values, share, dominant) of every mask of every column."""
        cells = self.cells.filter("kind = 'mask'")
        pool = cells.groupBy("column_name", F.col("cell").alias("mask")).agg(F.sum("n").alias("values"))
        whole = cells.groupBy("column_name").agg(F.sum("n").alias("whole"))
        share = F.col("values") / F.col("whole")
        return pool.join(whole, "column_name").select(F.lit(self.table).alias("table_name"), "column_name", "mask", "values", share.alias("share"), (share >= self.rare_share).alias("dominant"))

    def violations(self) -> DataFrame:
        """(table_name, column_name, batch_id, mask, values, share, example): the masks rare in their column, by
        load, with how many of the load's values have each, their share, and one of them."""
        each = [(f.name, mask(_text(f)), _text(f)) for f in self.fields if any(k == "mask" for c, k in self._kinds if c == f.name)]
        rows = F.array(*[F.struct(F.lit(c).alias("column_name"), m.alias("mask"), v.alias("v")) for c, m, v in each])
        long = self.rows.select(F.col(f"`{self.load}`").alias("batch_id"), F.explode(rows).alias("c")).select("batch_id", "c.*").filter("mask is not null")
        found = long.groupBy("column_name", "batch_id", "mask").agg(F.count("*").alias("values"), F.min(F.substring("v", 1, 200)).alias("example"))
        own = self.cells.filter("kind = 'mask'").groupBy("column_name", "batch_id").agg(F.sum("n").alias("own"))
        rare = self.masks().filter("not dominant").select("column_name", "mask")
        out = found.join(rare, ["column_name", "mask"]).join(own, ["column_name", "batch_id"])
        return out.select(F.lit(self.table).alias("table_name"), "column_name", "batch_id", "mask", "values", (F.col("values") / F.col("own")).alias("share"), "example")

    def measures(self) -> DataFrame:
        """(table_name, column_name, batch_id, measure, value, chance, n, unit) in long form; chance is
        the part of the value that the load's size alone accounts for."""
        loads = self.loads
        dated = F.col("column_name").isin(*[f.name for f in self.fields if not isinstance(f.dataType, T.NumericType)] or [""])
        spans = loads.groupBy("column_name").agg(F.percentile_approx(F.col("high") - F.col("low"), 0.5, 1000).alias("span"))
        loads = loads.join(spans, "column_name")
        # days in usual spans, numbers in powers of ten
        scaled = lambda c: F.when(dated, F.col(c).try_cast("double") / F.greatest("span", F.lit(1.0))).otherwise(F.signum(F.col(c).try_cast("double")) * F.log10(1 + F.abs(F.col(c).try_cast("double"))))
        ends = lambda c: F.when(F.col("low").isNotNull(), scaled(c))
        one = lambda name, value, unit, chance=0.0: F.struct(
            F.lit(name).alias("measure") if isinstance(name, str) else name.alias("measure"), value.alias("value"), (F.lit(chance) if isinstance(chance, float) else chance).alias("chance"), F.lit(unit).alias("unit")
        )
        kinds = F.array(
            one("nulls", F.col("nulls") / F.col("row_count"), "share"),
            one("low", scaled("low"), "range"),
            one("high", scaled("high"), "range"),
            one("least", ends("least"), "range"),
            one("greatest", ends("greatest"), "range"),
        )
        a = loads.select("table_name", "column_name", "batch_id", F.col("row_count").alias("n"), F.explode(kinds).alias("m"))
        by_value = lambda c: F.when(F.col("kind") == "value", c)
        kinds = F.array(
            one(F.concat("kind", F.lit(" distribution")), F.col("distance"), "share", F.col("chance_distance")),
            one(F.concat("kind", F.lit(" rarity")), F.col("rare"), "share"),
            one("commonest", by_value(F.col("top")), "share"),
            one("distinct", by_value(F.col("cells") / F.col("own")), "share", F.col("chance_cells") / F.col("own")),
        )
        b = self.divergence().select(F.lit(self.table).alias("table_name"), "column_name", "batch_id", F.col("own").alias("n"), F.explode(kinds).alias("m"))
        return a.unionByName(b).select("table_name", "column_name", "batch_id", "m.*", "n").filter("value is not null")

    def changes(self) -> DataFrame:
        """(table_name, column_name, batch_id, measure, value, usual, sigmas): measures of a load that
        lie far outside what the table's other loads show."""
        m = cut(self.measures().withColumn("net", F.col("value") - F.col("chance")))  # a few rows for each load and column
        key = ["table_name", "column_name", "measure"]
        # one row for each load: all that follows is one partitioning by column and measure
        loads = Window.partitionBy(*key)
        near = m.withColumns({"usual": F.percentile_approx("net", 0.5, 1000).over(loads), "loads": F.count("*").over(loads), "whole": F.sum("n").over(loads), "both": F.sum("value").over(loads)})
        near = near.withColumn("off", F.abs(F.col("net") - F.col("usual"))).withColumn("usual", F.col("usual") + F.col("chance"))
        # of two loads, each is judged by the other; both lie as far from each other as chance has it
        apart = F.col("measure").endswith("distribution")
        usual = F.when(F.col("loads") > 2, F.col("usual")).when(apart, F.col("chance")).otherwise(F.col("both") - F.col("value"))
        near = near.withColumn("usual", usual).withColumn("off", F.when(F.col("loads") > 2, F.col("off")).otherwise(F.abs(F.col("value") - usual)))
        near = near.withColumn("spread", F.when(F.col("loads") > 2, F.percentile_approx("off", 0.5, 1000).over(loads)).otherwise(0.0))
        # how far least and greatest lie beyond those of all other loads
        out = F.when(F.col("measure") == "least", -F.col("value")).when(F.col("measure") == "greatest", F.col("value"))
        near = near.withColumn("out", out).withColumn("first", F.max(F.struct("out", "batch_id")).over(loads))
        near = near.withColumn("second", F.max(F.when(F.col("batch_id") != F.col("first.batch_id"), F.col("out"))).over(loads))
        others = F.when(F.col("batch_id") == F.col("first.batch_id"), F.col("second")).otherwise(F.col("first.out"))
        near = near.withColumn("off", F.when(F.col("out").isNotNull(), F.col("out") - others).otherwise(F.col("off")))
        # for shares never more than what tells the load's own values from a draw of the usual share
        least = 1 / (F.col("whole") + 2)
        u = F.greatest(least, F.least(1 - least, F.col("usual")))
        x = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("value")))
        part = lambda p, q: F.when(p > 0, p * F.ln(p / q)).otherwise(0.0)
        drawn = F.when(F.col("unit") == "share", F.sqrt(2 * F.col("n") * F.greatest(F.lit(0.0), part(x, u) + part(1 - x, 1 - u))))
        robust = F.col("off") / F.greatest(1.4826 * F.col("spread"), F.when(F.col("unit") == "share", 1e-6).otherwise(0.02))
        out = near.withColumn("sigmas", F.least(robust, drawn)).filter(
            (F.col("loads") > 1) & (F.col("off") >= F.when(F.col("unit") == "share", self.shift).otherwise(self.range_shift)) & (F.col("sigmas") >= self.sigmas)
        )
        return out.select(*key[:2], "batch_id", "measure", "value", "usual", "sigmas")


def changed_columns(profiles: list[Profile]) -> DataFrame:
    """(table_name, column_name, batch_id), distinct, over several tables."""
    return reduce(DataFrame.unionByName, [p.changes() for p in profiles]).select("table_name", "column_name", "batch_id").distinct()


def load_profiles(projects: DataFrame, results: DataFrame) -> list[Profile]:
    """dim_project by _batch_id and dl_dq_results by batch_id, without their keys and landing times."""
    skip = ("projectkey", "_batch_id", "batch_id", "_ingested_at", "checked_at")
    named = lambda df: [c for c in df.columns if c not in skip]
    return [Profile(projects, "dim_project", "_batch_id", named(projects)), Profile(results, "dl_dq_results", "batch_id", named(results))]
