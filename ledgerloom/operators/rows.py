"""Row-choosing operators: latest snapshot, preference, precedence, ambiguity, merge, reject split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.runtime import cut
from ledgerloom.skew import join_salted


def first_by(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One whole row per key, the first by ``order``, which should end in a unique column.

    Spark turns row_number() = 1 into a partial limit per group before the shuffle, so a key with
    very many rows sends few of them.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def latest_snapshot(rows: DataFrame, keys: list[str], time: str, tiebreak: list[str]) -> DataFrame:
    return first_by(rows, keys, [F.desc(time), *[F.col(c).asc() for c in tiebreak]])


def prefer_named(rows: DataFrame, keys: list[str], name: str, tiebreak: list[str]) -> DataFrame:
    """One row per key, one with a name if there is any."""
    return first_by(rows, keys, [F.col(name).isNull().cast("int"), *[F.col(c).asc() for c in tiebreak]])


def by_precedence(rows: DataFrame, keys: list[str], kind: str, ranking: list[str], order: list[Column]) -> DataFrame:
    """One row per key: of the kind that stands first in ``ranking``, then by ``order``."""
    rank = reduce(lambda c, ik: c.when(F.col(kind) == ik[1], ik[0]), enumerate(ranking), F.when(F.lit(False), 0))
    return first_by(rows, keys, [rank.otherwise(len(ranking)), *order])


def unambiguous_best(pairs: DataFrame, key: str, other: str, score: str, floor: float) -> DataFrame:
    """Pairs of keys that have just one candidate, if it scores the floor or more."""
    one = pairs.groupBy(key).agg(F.count("*").alias("_n"), F.max(F.struct(score, other)).alias("_best"))
    return one.filter((F.col("_n") == 1) & (F.col(f"_best.{score}") >= floor)).select(key, f"_best.{other}", f"_best.{score}")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The target after a merge on null-safe keys: a key's source row, the first by ``order``, replaces
    its target row. Merging the same source again changes nothing."""
    if not keys:
        raise ValueError("a merge needs keys")
    missing = [k for k in keys if k not in source.columns or k not in target.columns]
    if missing or not source.columns:
        raise ValueError(f"keys that aren't columns: {missing}")
    new = first_by(source, keys, order)
    on = reduce(lambda a, b: a & b, (F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys))
    kept = target.alias("t").join(source.select(*keys).distinct().alias("s"), on, "left_anti")
    return kept.select(*target.columns).unionByName(new.select(*[c for c in target.columns if c in new.columns]), allowMissingColumns=True)


def split_rejects(rows: DataFrame, checks: dict[str, Column], table: str) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejects): a row that fails checks is kept as JSON with the first check's name."""
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()])
    good = rows.filter(reason.isNull())
    bad = rows.filter(reason.isNotNull()).select(F.lit(table).alias("source_table"), reason.alias("reason"), F.to_json(F.struct("*")).alias("row"))
    return good, bad


def distinct_keys(*columns: DataFrame) -> DataFrame:
    """Distinct non-null keys seen in any of the one-column inputs; each is made distinct before the union."""
    name = columns[0].columns[0]
    parts = [c.toDF(name).filter(F.col(name).isNotNull()).distinct() for c in columns]
    return reduce(DataFrame.union, parts).distinct()


def with_unknown(rows: DataFrame, unknown: dict[str, object]) -> DataFrame:
    """The dimension with its row for unresolved keys; columns not named in ``unknown`` are null there."""
    zero = rows.sparkSession.range(1).select(*[F.lit(unknown.get(f.name)).cast(f.dataType).alias(f.name) for f in rows.schema])
    return rows.unionByName(zero)


def conform(rows: DataFrame, schema: str | list[tuple[str, str]]) -> DataFrame:
    """Exactly the named columns in their types; unreadable values become null."""
    pairs = [tuple(x.split()) for x in schema.split(", ")] if isinstance(schema, str) else schema
    return rows.select(*[F.col(c).try_cast(t).alias(c) for c, t in pairs])


def spine_left(spine: DataFrame, facts: DataFrame, on: list[str], fill: dict[str, object]) -> DataFrame:
    """Facts on a gapless spine, missing ones filled."""
    return spine.join(facts, on, "left").fillna(fill)


#: Needles are looked up by no more characters than this, so texts are cut into runs of few lengths.
LONGEST_RUN = 32


def contains_pairs(needles: DataFrame, needle: str, hay: DataFrame, text: str, least: int = 3) -> DataFrame:
    """Pairs where ``text`` contains ``needle``, which has ``least`` characters or more.

    Texts are cut into all their runs of just the lengths that needles have, and meet needles by an
    equi-join on the whole needle, or on its first LONGEST_RUN characters where it is longer.
    """
    seen = needles.filter(F.length(needle) >= least).withColumn("_run", F.substring(F.col(needle), 1, LONGEST_RUN))
    lengths = [r[0] for r in seen.select(F.length("_run")).distinct().collect()]  # LONGEST_RUN at most
    if not lengths:
        return needles.limit(0).join(hay.limit(0))
    c = F.col(text)

    def runs_of(n: int) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(c, i, F.lit(n)))
        return F.when(F.length(c) >= n, every).otherwise(F.array().cast("array<string>"))

    runs = [runs_of(n) for n in lengths]
    cut_up = hay.filter(c.isNotNull()).withColumn("_run", F.explode(F.array_distinct(F.concat(*runs))))
    pairs = join_salted(seen, cut_up, "_run")
    return pairs.filter((F.length(needle) <= LONGEST_RUN) | F.contains(c, F.col(needle))).drop("_run")


def ranked_in(rows: DataFrame, by: str, order: str) -> DataFrame:
    """Adds n_rows and position: the size of each group (nulls are one) and each row's place in it by ``order``,
    which must be unique in a group.

    Rows are range-sorted by group and order, so a group of any size spreads over partitions; their
    sizes, one row for each group and partition, give every partition its offset.
    """
    part = cut(rows.repartitionByRange(F.col(by).asc_nulls_first(), F.col(order).asc_nulls_first()).withColumn("_part", F.spark_partition_id()))
    sizes = part.groupBy(by, "_part").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(by)
    sizes = sizes.select(F.col(by).alias("_by"), F.col("_part").alias("_p"), F.sum("_n").over(whole).alias("n_rows"), (F.sum("_n").over(whole.orderBy("_part")) - F.col("_n")).alias("_base"))
    own = F.row_number().over(Window.partitionBy("_part", by).orderBy(order))
    out = part.withColumn("_own", own).join(sizes, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_part") == F.col("_p")))
    return out.withColumn("position", F.col("_base") + F.col("_own")).drop("_part", "_own", "_by", "_p", "_base")


def with_tombstones(mappings: DataFrame, value: str, active: str) -> DataFrame:
    """Mappings whose inactive rows stay as tombstones: without a value, yet in their place when precedence is
    ranked, so they blank what weaker mappings say. Apply it before ``by_precedence``."""
    return mappings.withColumn(value, F.when(F.coalesce(F.col(active), F.lit(False)), F.col(value)))


def union_rejects(*rejects: DataFrame) -> DataFrame:
    """Rejects of several sources (source_table, reason, row) as one table."""
    return reduce(DataFrame.unionByName, [r.select("source_table", "reason", "row") for r in rejects])
