"""Mixing sources to target weights (problem 7).

``mix`` schedules documents by weighted fair queueing. Every source queues its documents in a
seeded shuffle, once for each pass it may be repeated; a queued document's virtual finish time is
the tokens queued before it in its source, its own included, divided by the source's weight. All
queues are merged by range-sorting on that time and cut off at the total budget.

Running sums never gather a source in one task: a source's queue is cut into buckets by the leading
bits of the shuffle hash, sums run inside a bucket, and only the buckets' totals (one row for some
ROWS_PER_BUCKET documents) are summed along the source. The global cut-off needs the totals of the
range partitions and a running sum in the one partition that holds the cut.

Defined results: labels that differ in case, blanks or joining signs are one source; documents with
a null source, without a target or without tokens (null and empty texts) are not chosen; equal texts
under different ids are different documents; a target without documents, with a null or
non-positive share or no allowed use contributes nothing and its share passes to the others in
proportion; duplicate target rows add up their shares and allow the larger number of repeats;
without any usable target the result is empty; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ledgerloom.llm.tokens import DEFAULT_RANKS, count_tokens
from ledgerloom.runtime import cut

ROWS_PER_BUCKET = 20_000
#: Bounds the one range partition whose running sum finds the cut.
ROWS_PER_PART = 500_000
#: Targets are held by the driver and broadcast.
MAX_TARGETS = 100_000


def source_label(c: Column) -> Column:
    """The label without case, outer blanks and the kind of its joining signs; null if nothing is left."""
    plain = F.regexp_replace(F.lower(c), r"[\s\p{Z}_\-‐-―./]+", "_")
    return F.nullif(F.regexp_replace(plain, "^_+|_+$", ""), F.lit(""))


def sized(documents: DataFrame, wanted: list, ranks_path: str = DEFAULT_RANKS) -> DataFrame:
    """(doc_id, source, tokens) of the documents of the wanted sources that have all three. Only these are tokenised."""
    rows = documents.select("doc_id", source_label(F.col("source")).alias("source"), "text")
    rows = rows.filter("doc_id is not null and source is not null and text is not null and text != ''")
    names = documents.sparkSession.createDataFrame([(w.source,) for w in wanted], "source string")
    rows = rows.join(F.broadcast(names), "source", "left_semi")  # checked by _targets
    return rows.select("doc_id", "source", count_tokens(F.col("text"), ranks_path).cast("long").alias("tokens")).filter("tokens > 0")


def _targets(targets: DataFrame) -> list:
    """(source, share, passes) of every usable target: a declared list, whose size is checked before it goes anywhere."""
    named = targets.select(
        source_label(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("share"), F.col("max_repeats").cast("int").alias("passes")
    )
    usable = named.filter("source is not null and share > 0 and passes >= 1 and not isnan(share)")
    held = usable.groupBy("source").agg(F.sum("share").alias("share"), F.max("passes").alias("passes")).limit(MAX_TARGETS + 1).collect()
    if len(held) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets")
    return held


def queued(sizes: DataFrame, plan: DataFrame, rows: int, seed: int) -> DataFrame:
    """Every copy a source may contribute, with its virtual finish time."""
    bits = max(0, min(40, math.ceil(math.log2(max(1, rows / ROWS_PER_BUCKET)))))
    copies = sizes.join(F.broadcast(plan), "source").withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
    copies = copies.withColumn("turn", F.xxhash64("doc_id", "pass", F.lit(seed)))
    bucket = F.shiftrightunsigned(F.col("turn"), 64 - bits) if bits else F.lit(0)
    copies = copies.withColumn("bucket", bucket)
    # order by the bucket first: inside, the hash as a signed number is as good a shuffle
    queue = ["source", "pass", "bucket"]
    sums = copies.groupBy(*queue).agg(F.sum("tokens").alias("held"))
    before = Window.partitionBy("source").orderBy("pass", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("held").over(before), F.lit(0))).drop("held")
    inside = Window.partitionBy(*queue).orderBy("turn", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    copies = copies.withColumn("run", F.sum("tokens").over(inside))
    return copies.join(sums, queue).select(
        "source", "doc_id", "pass", "tokens", ((F.col("base") + F.col("run")) / F.col("weight")).alias("finish")
    )


def schedule(sizes: DataFrame, wanted: list, total_tokens: int | None = None, seed: int = 17) -> DataFrame:
    """(source, doc_id, pass, tokens) of the chosen copies.

    total_tokens: the budget. By default the largest one that lets every source with documents give
    its full share within its repeats. A larger budget is filled by the sources that still have
    documents, so their shares exceed the targets, as the report then shows.
    """
    spark = sizes.sparkSession
    sizes = cut(sizes)  # tokenised once, read several times
    by = {w.source: w for w in wanted}
    names = spark.createDataFrame([(w.source,) for w in wanted], "source string")
    sums = sizes.join(F.broadcast(names), "source", "left_semi").groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")).collect()
    held = [Row(source=r.source, tokens=r.tokens, n=r.n, share=by[r.source].share, passes=by[r.source].passes) for r in sums]  # no more than targets
    if not held:
        return spark.createDataFrame([], "source string, doc_id long, pass int, tokens long")
    whole = sum(r.share for r in held)
    most = [(r.tokens * r.passes, r.share / whole) for r in held]
    total = int(min(c / w for c, w in most)) if total_tokens is None else total_tokens
    # passes a source can need before the budget is spent: no more than fill its share of all capacity reached by then
    lo, hi = 0.0, max(c / w for c, w in most)
    for _ in range(100):  # virtual time at which the sources together have given the budget
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(c, w * mid) for c, w in most) < total else (lo, mid)
    passes = [min(r.passes, int(hi * r.share / whole / r.tokens) + 1) for r in held]
    plan = spark.createDataFrame([(r.source, r.share / whole, p) for r, p in zip(held, passes, strict=True)], "source string, weight double, passes int")
    copies = sum(r.n * p for r, p in zip(held, passes, strict=True))
    line = cut(queued(sizes, plan, copies, seed))
    order = ["finish", "source", "doc_id", "pass"]
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(copies / ROWS_PER_PART))
    line = cut(line.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    spent, last, base = 0, parts, 0
    for r in line.groupBy("part").agg(F.sum("tokens").alias("tokens")).orderBy("part").collect():  # one row a partition
        if spent + r.tokens > total:
            last, base = r.part, spent
            break
        spent += r.tokens
    run = F.sum("tokens").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    edge = line.filter(F.col("part") == last).withColumn("run", run).filter(F.col("run") <= total - base)
    cols = ["source", "doc_id", "pass", "tokens"]
    return line.filter(F.col("part") < last).select(*cols).unionByName(edge.select(*cols))


def mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, ranks_path: str = DEFAULT_RANKS, seed: int = 17) -> DataFrame:
    """(doc_id, source, repeats, tokens): the chosen documents, how often each is used, and its size."""
    wanted = _targets(targets)
    chosen = schedule(sized(documents, wanted, ranks_path), wanted, total_tokens, seed)
    return chosen.groupBy("doc_id", "source").agg(F.count("*").cast("int").alias("repeats"), F.max("tokens").alias("tokens"))


def shares(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, ranks_path: str = DEFAULT_RANKS, seed: int = 17) -> DataFrame:
    """(source, target_share, actual_share, tokens, documents, most_repeats) for every target, used or not."""
    chosen = mix(documents, targets, total_tokens, ranks_path, seed)
    got = chosen.groupBy("source").agg(
        F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("documents"), F.max("repeats").alias("most_repeats")
    )
    named = documents.sparkSession.createDataFrame([(w.source, w.share) for w in _targets(targets)], "source string, target_share double")
    out = named.join(got, "source", "left")
    return out.select(
        "source", "target_share",
        (F.coalesce("tokens", F.lit(0)) / F.sum("tokens").over(Window.partitionBy())).alias("actual_share"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("tokens", "documents", "most_repeats")],
    )
