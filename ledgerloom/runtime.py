"""Session set-up, table access and lineage cutting shared by all operators."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "ledgerloom") -> SparkSession:
    """A session for tests and benches on one machine; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, below the one the cluster names in ``spark.checkpoint.dir``.

    Only in one process (master ``local`` or ``local[n]``), where neither the setting nor a context
    folder exists, is one made below the machine's temporary folder.
    """
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
        named = sc.getCheckpointDir()
    return f"{named.rstrip('/')}/ledgerloom-{sc.applicationId}"


def path_of(spark: SparkSession, path: str):
    """The file system a path lies on, and the path as that system has it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once, as a columnar table in the shared folder, and read it back.

    The result has no lineage but its files, so a lost executor costs no recomputation of what came
    before, later readers fetch only the columns they use, and nothing is computed twice as by an
    eager checkpoint. ``forget`` removes the files of a result that nobody reads any more,
    ``clear`` those of the whole session; what is left goes when the application ends.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    at = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(at)
    fs, p = path_of(spark, folder)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(at)
    out.cut_at = at
    return out


def forget(df: DataFrame) -> None:
    """Remove the files of a result of ``cut``; harmless for any other."""
    if at := getattr(df, "cut_at", None):
        fs, p = path_of(df.sparkSession, at)
        fs.delete(p, True)


def clear(spark: SparkSession) -> None:
    """Remove all intermediate tables of this session. Results that were not yet written need them."""
    fs, p = path_of(spark, shared_folder(spark))
    fs.delete(p, True)
