"""Joins that keep their balance when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_PARTS = 1000
#: Keys with no more rows than this are never worth a separate way.
HOT_ROWS = 50_000


def join_counted(rows: DataFrame, keyed: DataFrame, key: str, count: str, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``keyed``, which holds one row for each ``key`` and how many of ``rows`` carry it.

    Keys with more than a thousandth of all rows are joined by broadcast, so their rows never move:
    there can be at most HOT_PARTS such keys, whatever the input's size. The rest goes through an
    ordinary shuffle join, where no key can then exceed a thousandth of the rows. ``keyed`` should
    be cheap to read twice (cut or cached). ``how`` is inner or left.
    """
    total = keyed.agg(F.sum(count)).first()[0] or 0
    floor = max(total // HOT_PARTS, HOT_ROWS)
    hot = keyed.filter(F.col(count) > floor)
    if not hot.limit(1).count():
        return rows.join(keyed, key, how)
    near = rows.join(F.broadcast(hot), key, "inner")
    far = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(keyed.filter(F.col(count) <= floor), key, how)
    return near.unionByName(far)


def join_unique(rows: DataFrame, keyed: DataFrame, keys: list[str], total: int) -> DataFrame:
    """Inner join of ``rows`` with ``keyed``, which holds one row for each combination of ``keys``.

    ``total`` is about how many rows there are. Combinations with more than a thousandth of them are
    counted first (a partial aggregate of the keys alone) and joined by broadcast; fewer rows than
    HOT_ROWS altogether can't have one, so they aren't counted.
    """
    floor = max(total // HOT_PARTS, HOT_ROWS)
    if total <= floor:
        return rows.join(keyed, keys)
    hot = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > floor).drop("_n").limit(HOT_PARTS + 1).collect()
    if not hot:
        return rows.join(keyed, keys)
    hot = F.broadcast(rows.sparkSession.createDataFrame(hot, rows.select(*keys).schema))  # HOT_PARTS rows at most
    near = rows.join(F.broadcast(keyed.join(hot, keys, "left_semi")), keys)
    return near.unionByName(rows.join(hot, keys, "left_anti").join(keyed, keys))


def join_salted(left: DataFrame, right: DataFrame, key: str, salts: int = 32, total: int | None = None) -> DataFrame:
    """Inner join of which keys may repeat on both sides. Keys with more than a thousandth of the left rows
    are split: each of their left rows gets one of ``salts`` parts, each of their right rows goes to all. ``total``: about
    how many left rows there are, if known."""
    counts = left.groupBy(key).agg(F.count("*").alias("_n"))
    total = left.count() if total is None else total
    if total <= HOT_ROWS:
        return left.join(right, key)
    floor = max(total // HOT_PARTS, HOT_ROWS)
    hot = counts.filter(F.col("_n") > floor).select(key).limit(HOT_PARTS + 1).collect()
    if not hot:
        return left.join(right, key)
    hot = F.broadcast(left.sparkSession.createDataFrame(hot, left.select(key).schema))  # HOT_PARTS rows at most
    near = left.join(hot, key, "left_semi").withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    spread = right.join(hot, key, "left_semi").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    near = near.join(spread, [key, "_salt"]).drop("_salt")
    return near.unionByName(left.join(hot, key, "left_anti").join(right, key))
