"""Tables that readers see whole while they are written: versioned files under a pointer.

A table is a folder of immutable data folders and a folder of manifests, one for each version. A
manifest names the folder of every bucket of keys. A merge rewrites only the buckets its source
touches, into a new folder, and then publishes the next manifest by one rename; readers take the
newest manifest, so they see the state before or after, never between. Two writers of one version
collide on the rename and the second fails. Old versions stay until ``vacuum``.

Keys are hashed into ``buckets`` when the table is made: choose it so that a bucket is some ten GB.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators.rows import first_by, upsert
from ledgerloom.runtime import cut, forget, path_of

BUCKETS, FILES = 16, 4


class Conflict(RuntimeError):
    """Another writer published this version first."""


def _manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    fs, p = path_of(spark, f"{path}/_manifests")
    if not fs.exists(p):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    held = [n for n in (int(x[:-5]) for x in names if x.endswith(".json") and x[:-5].isdigit()) if version is None or n == version]
    if not held:
        return None
    stream = fs.open(path_of(spark, f"{path}/_manifests/{max(held)}.json")[1])
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _publish(spark: SparkSession, path: str, manifest: dict) -> None:
    fs, tmp = path_of(spark, f"{path}/_manifests/.{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    _, goal = path_of(spark, f"{path}/_manifests/{manifest['version']}.json")
    if fs.exists(goal) or not fs.rename(tmp, goal):
        fs.delete(tmp, False)
        raise Conflict(f"{path}: version {manifest['version']} exists")


def exists(spark: SparkSession, path: str) -> bool:
    return _manifest(spark, path) is not None


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest state of the table, or a version that ``vacuum`` has left."""
    m = _manifest(spark, path, version)
    if m is None:
        raise FileNotFoundError(f"no table at {path}")
    schema = StructType.fromJson(m["schema"])
    at = [f"{path}/{folder}/_bucket={b}" for b, folder in m["buckets"].items()]
    return spark.read.schema(schema).parquet(*at) if at else spark.createDataFrame([], schema)


def _write(rows: DataFrame, path: str, keys: list[str], buckets: int, files: int) -> dict[str, str]:
    """Folder by bucket of the rows written."""
    spark, folder = rows.sparkSession, f"data/{uuid.uuid4().hex}"
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(files))
    rows.withColumn("_bucket", _bucket(keys, buckets)).repartition("_bucket", spread).write.partitionBy("_bucket").parquet(f"{path}/{folder}")
    fs, p = path_of(spark, f"{path}/{folder}")
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return {n.split("=")[1]: folder for n in names if n.startswith("_bucket=")}


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def replace_table(rows: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS, files: int = FILES) -> int:
    """Replaces the whole table, its schema included; gives the version. Readers of the old state keep it."""
    spark = rows.sparkSession
    old = _manifest(spark, path)
    at = _write(rows, path, keys, buckets, files)
    version = (old["version"] if old else 0) + 1
    _publish(spark, path, {"version": version, "keys": keys, "count": buckets, "files": files, "schema": rows.schema.jsonValue(), "buckets": at})
    return version


def rebuild(rows: DataFrame, path: str) -> int:
    """Replaces the whole of a table that nothing is merged into, without a shuffle; gives its number of rows,
    counted while they are written."""
    spark, seen, folder = rows.sparkSession, Observation(), f"data/{uuid.uuid4().hex}"
    old = _manifest(spark, path)
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/{folder}/_bucket=0")
    _publish(spark, path, {"version": (old["version"] if old else 0) + 1, "keys": [], "count": 1, "files": 1, "schema": rows.schema.jsonValue(), "buckets": {"0": folder}})
    return seen.get["rows"]


def merge_table(source: DataFrame, path: str, keys: list[str], order: list[Column], buckets: int = BUCKETS, files: int = FILES) -> int:
    """Upserts by null-safe keys and gives the number of source rows, counted while they are written;
    the first run creates the table. Columns that only the source has are added. Merging the same
    source again changes nothing but the version.
    """
    spark, seen = source.sparkSession, Observation()
    source = cut(source.observe(seen, F.count(F.lit(1)).alias("rows")))
    old = _manifest(spark, path)
    if old is None:
        replace_table(first_by(source, keys, order), path, keys, buckets, files)
    else:
        if sorted(old["keys"]) != sorted(keys):  # a rebuilt table has none
            raise ValueError(f"the table's keys are {old['keys']}")
        keys, held = old["keys"], StructType.fromJson(old["schema"])
        schema = StructType([*held.fields, *[f for f in source.schema.fields if f.name not in held.names]])
        touched = [str(r[0]) for r in source.select(_bucket(keys, old["count"])).distinct().collect()]
        at = [f"{path}/{old['buckets'][b]}/_bucket={b}" for b in touched if b in old["buckets"]]
        target = spark.read.schema(schema).parquet(*at) if at else spark.createDataFrame([], schema)
        new = _write(upsert(target, source, keys, order), path, keys, old["count"], old["files"]) if touched else {}
        _publish(spark, path, old | {"version": old["version"] + 1, "schema": schema.jsonValue(), "buckets": old["buckets"] | new})
    forget(source)
    return seen.get["rows"]


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Removes all but the newest ``keep`` versions and the data only they used; gives the folders removed."""
    fs, p = path_of(spark, f"{path}/_manifests")
    versions = sorted(int(n[:-5]) for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.endswith(".json") and n[:-5].isdigit())
    for v in versions[:-keep]:
        fs.delete(path_of(spark, f"{path}/_manifests/{v}.json")[1], False)
    used = {f for v in versions[-keep:] for f in _manifest(spark, path, v)["buckets"].values()}
    _, data = path_of(spark, f"{path}/data")
    gone = [s.getPath() for s in fs.listStatus(data) if f"data/{s.getPath().getName()}" not in used]
    for g in gone:
        fs.delete(g, True)
    return len(gone)
