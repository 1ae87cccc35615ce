"""Landed raw records: one schema for every endpoint, JSON lines by batch, pinned CSV, watermarks."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.runtime import path_of
from ledgerloom.sources.versioned import merge_table, replace_table

# The layouts every landed and control table has.
RAW = "_key string, _project_id string, _merge_key string, _source_endpoint string, _ingested_at timestamp, payload string, _batch_id string, _row_hash string"
WATERMARK = "table_name string, endpoint string, watermark timestamp, batch_id string, updated_at timestamp"
RUN_LOG = "batch_id string, step string, table_name string, row_count long, status string, message string, logged_at timestamp"
TOKEN = "source string, refresh_token string, obtained_at timestamp, batch_id string"
OVERLAP = timedelta(hours=1)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def payload_hash(payload: dict) -> str:
    """sha256 of the payload with sorted keys at every depth."""
    return hashlib.sha256(json.dumps(payload, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def raw_row(record: dict, endpoint: str, at: datetime, batch: str, project: str | None = None, key: str = "id") -> tuple:
    k = None if record.get(key) is None else str(record[key])
    return (k, project, f"{k or ''}|{project or ''}", endpoint, at, json.dumps(record, default=str), batch, payload_hash(record))


def as_raw(rows: DataFrame, key: str, endpoint: str, at: Column, batch: str, project: Column | None = None) -> DataFrame:
    """Rows of a table as landed records, without leaving the executors."""
    project = F.lit(None).cast("string") if project is None else project.cast("string")
    cols = rows.columns
    payload = F.to_json(F.struct(*cols))
    return rows.select(
        F.col(key).cast("string").alias("_key"), project.alias("_project_id"), F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(project, F.lit(""))).alias("_merge_key"),
        F.lit(endpoint).alias("_source_endpoint"), at.alias("_ingested_at"), payload.alias("payload"), F.lit(batch).alias("_batch_id"), F.sha2(F.to_json(F.struct(*sorted(cols))), 256).alias("_row_hash"),
    )


def newest_batch(spark: SparkSession, root: str) -> str:
    """The batch folder that sorts last; only folder names are listed."""
    fs, p = path_of(spark, root)
    names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
    if not names:
        raise FileNotFoundError(f"no batch below {root}")
    return names[-1]


def read_landing(spark: SparkSession, root: str, batch: str | None = None) -> DataFrame:
    """All records of one batch with ``table_name``: the name of a file ``<table>.jsonl``, or of a folder of
    that name as ``write_landing`` makes it. Lines that hold no payload, the unreadable ones among them, are dropped."""
    at = f"{root}/{batch or newest_batch(spark, root)}"
    rows = spark.read.schema(RAW).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).json(at)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.jsonl(?:/[^/]*)?$", 1)
    return rows.withColumn("table_name", name).filter("payload is not null and table_name != ''")


def write_landing(rows: DataFrame, root: str, batch: str, table: str) -> None:
    """One table's records of a batch as JSON lines below ``root/batch/table.jsonl``; a rerun replaces them."""
    rows.write.mode("overwrite").json(f"{root}/{batch}/{table}.jsonl")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with header and pinned schema; its rows replace what was read before."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def replace_from_csv(spark: SparkSession, path: str, schema: str, table: str, keys: list[str]) -> int:
    """Replaces a table by a CSV's rows, its columns too where they have changed; gives the version."""
    return replace_table(read_csv(spark, path, schema), table, keys)


def high_water(rows: DataFrame, time: str) -> datetime | None:
    """The newest readable time; None for none, so that the mark then stays where it is."""
    return rows.agg(F.max(F.try_to_timestamp(F.col(time)))).first()[0]


def since(mark: datetime | None, overlap: timedelta = OVERLAP) -> datetime | None:
    """From when to read: the mark less one overlap, for records that arrive late."""
    return None if mark is None else mark - overlap


def read_mark(marks: DataFrame, name: str, endpoint: str) -> datetime | None:
    got = marks.filter((F.col("table_name") == name) & (F.col("endpoint") == endpoint)).select("watermark").limit(1).collect()
    return got[0][0] if got else None


def write_mark(spark: SparkSession, path: str, name: str, endpoint: str, mark: datetime | None, batch: str, now: datetime) -> None:
    """Moves a mark forward; an empty batch (no mark) moves nothing. Call it after the load succeeded."""
    if mark is not None:
        merge_table(spark.createDataFrame([(name, endpoint, mark, batch, now)], WATERMARK), path, ["table_name", "endpoint"], [F.desc("updated_at")])


def parse_time(text: str | None) -> datetime | None:
    """A time with Z, an offset, or none (then UTC), as UTC; None for what is no time."""
    try:
        at = datetime.fromisoformat((text or "").strip().replace("Z", "+00:00"))
    except ValueError:
        return None
    return (at if at.tzinfo else at.replace(tzinfo=UTC)).astimezone(UTC)


def rotate_token(spark: SparkSession, path: str, source: str, refresh: Callable[[str], tuple[str, str]], batch: str, now: datetime) -> str:
    """The access token of a source whose refresh token changes at every use. ``refresh`` trades the newest
    stored token for (access, next refresh token); the next is stored before the access token is handed out,
    so a pull that fails can't lose it."""
    held = newest_token(spark.read.parquet(path), source).select("refresh_token").collect()
    if not held:
        raise LookupError(f"no token of {source}")
    access, following = refresh(held[0][0])
    spark.createDataFrame([(source, following, now, batch)], TOKEN).write.mode("append").parquet(path)
    return access


def write_diagnostics(spark: SparkSession, path: str, tables: dict[str, DataFrame], counts: dict[str, int] | None = None) -> dict:
    """Row counts and schemas of tables as one JSON text at ``path``; counts that are known aren't taken again."""
    counts = counts or {}
    found = {n: {"rows": counts[n] if n in counts else df.count(), "schema": df.schema.jsonValue()} for n, df in tables.items()}
    spark.createDataFrame([(json.dumps(found, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return found


def newest_token(tokens: DataFrame, source: str) -> DataFrame:
    return tokens.filter(F.col("source") == source).orderBy(F.desc("obtained_at"), F.desc("batch_id")).limit(1)


def log_run(spark: SparkSession, path: str, *row: object) -> bool:
    """Appends one line to the run log; a log that can't be written never fails the run."""
    try:
        spark.createDataFrame([row], RUN_LOG).write.mode("append").parquet(path)
    except Exception:
        return False
    return True
