"""Scratch tables in the folder that the whole cluster shares.

Iterative operators cut their lineage by writing a Parquet table and reading it
again.  The table lives under ``spark.checkpoint.dir``; only where that setting
is missing and all of Spark is one process (tests, notebooks) a folder of this
machine takes its place.  ``clear`` removes all tables of a session before its end.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, str] = {}


def root(spark: SparkSession) -> str:
    """Folder of this application's scratch tables."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
            base = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        _roots[app] = f"{base.rstrip('/')}/tidemark-{app}"
        atexit.register(clear, spark)
    return _roots[app]


def write(df: DataFrame) -> str:
    """Write ``df`` as Parquet to a new scratch folder and return its path."""
    path = f"{root(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """``df`` as a table that no longer depends on how it was computed."""
    return df.sparkSession.read.schema(df.schema).parquet(write(df))


def drop(spark: SparkSession, path: str) -> None:
    """Remove one scratch folder."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear(spark: SparkSession) -> None:
    """Remove every scratch table of this application (at exit, or by hand)."""
    path = _roots.pop(spark.sparkContext.applicationId if spark.sparkContext._jsc else "", None)
    if path:
        try:
            drop(spark, path)
        except Exception:  # the session has ended; the folder is the cluster's to clean
            pass
