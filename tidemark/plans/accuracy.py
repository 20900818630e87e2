"""The accuracy check of a job: counts and fingerprints of every table, and of buckets if asked."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import JobConfig, TableConfig
from tidemark.operators import compare
from tidemark.sources.catalog import describe, detect_key_for_check
from tidemark.sources.readers import read_table
from tidemark.sources.snapshots import Snapshot

LOG = """run_id string, validation_time timestamp, source_table string, target_table string, load_type string, status string, source_total long,
    source_scope_count long, target_total long, target_difference long, source_incremental_null_count long, source_min_incremental string, source_max_incremental string,
    target_min_incremental string, target_max_incremental string, key_columns string, compared_columns string, source_key_hash string, target_key_hash string,
    source_row_hash string, target_row_hash string, details string"""


def sides(spark: SparkSession, job: JobConfig, table: TableConfig) -> tuple[DataFrame, DataFrame, list[str], list[str], str | None]:
    source = read_table(spark, job.source, table.source_table)
    target = Snapshot(spark, job.target["path"], table.target_table).read()
    common = [c for c in target.columns if c in source.columns]
    if not common:
        raise LookupError("no column in common")
    found = detect_key_for_check(table.business_key_columns, describe(table.source_table, source, table.source_columns, table.source_primary_key, table.source_unique), describe(table.target_table, target, table.columns, table.primary_key, table.unique))
    cursor = table.incremental_column if job.load_type(table) == "incremental" else None
    # The source's values in the target's types, so that equal values have equal texts.
    cast = source.select(*(F.col(c).cast(target.schema[c].dataType).alias(c) for c in common))
    return cast, target.select(*common), common, [k for k in found if k in common], cursor


def check_table(spark: SparkSession, job: JobConfig, table: TableConfig, run_id: str) -> dict[str, Any]:
    base = {"run_id": run_id, "validation_time": datetime.now(timezone.utc), "source_table": table.source_table, "target_table": table.target_table, "load_type": job.load_type(table)}
    try:
        source, target, common, keys, cursor = sides(spark, job, table)
        r = compare.compare_tables(source, target, common, keys, cursor).first()
        only = [c for c in read_table(spark, job.source, table.source_table).columns if c not in common]
        extra = [c for c in Snapshot(spark, job.target["path"], table.target_table).schema.names if c not in common]
        return base | {
            "status": r["status"], "source_total": r["source_total"], "source_scope_count": r["source_row_count"], "target_total": r["target_row_count"],
            "target_difference": r["target_difference"], "source_incremental_null_count": r["source_null_cursors"],
            "source_min_incremental": r["source_min_cursor"], "source_max_incremental": r["source_max_cursor"], "target_min_incremental": r["target_min_cursor"], "target_max_incremental": r["target_max_cursor"],
            "key_columns": json.dumps(keys), "compared_columns": json.dumps(common), "source_key_hash": r["source_key_hash"], "target_key_hash": r["target_key_hash"],
            "source_row_hash": r["source_row_hash"], "target_row_hash": r["target_row_hash"], "details": json.dumps({"missing_in_target_schema": only, "missing_in_source_schema": extra}),
        }
    except Exception as e:
        return base | {"status": compare.FAILED, "details": json.dumps({"error": str(e)[:2000]})}


def check_buckets(spark: SparkSession, job: JobConfig, table: TableConfig, run_id: str, column: str | None = None, granularity: str = "daily") -> DataFrame:
    source, target, common, keys, _ = sides(spark, job, table)
    column = column or table.partition_column or table.incremental_column
    if not column:
        raise ValueError(f"{table.key} has no column for buckets")
    found = compare.compare_buckets(source, target, column, granularity, common, keys)
    return found.select(F.lit(run_id).alias("run_id"), F.lit(table.source_table).alias("source_table"), F.lit(table.target_table).alias("target_table"), F.lit(column).alias("bucket_column"), F.lit(granularity).alias("bucket_granularity"), *found.columns)


def check_job(spark: SparkSession, job: JobConfig, only: str | None = None, bucket: bool = False, bucket_column: str | None = None, granularity: str = "daily", log_table: str = "migration_accuracy_log", bucket_table: str = "migration_accuracy_bucket_log") -> tuple[DataFrame, DataFrame | None]:
    """Check every enabled table (or one target), and append the results to the target's logs."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", job.timezone)
    try:
        return _check_job(spark, job, only, bucket, bucket_column, granularity, log_table, bucket_table)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def _check_job(spark: SparkSession, job: JobConfig, only: str | None, bucket: bool, bucket_column: str | None, granularity: str, log_table: str, bucket_table: str) -> tuple[DataFrame, DataFrame | None]:
    run_id = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}"
    schema = T._parse_datatype_string(LOG)
    chosen = [t for t in job.tables if job.load_type(t) != "skip" and only in (None, t.target_table)]
    rows = [check_table(spark, job, t, run_id) for t in chosen]
    out = spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)
    log = Snapshot(spark, job.target["path"], log_table, schema)
    log.commit([log.write_part(out)], None, append=True)
    buckets = None
    for t, r in zip(chosen, rows):
        if bucket and r["status"] != compare.FAILED:
            got = check_buckets(spark, job, t, run_id, bucket_column, granularity)
            buckets = got if buckets is None else buckets.unionByName(got)
    if buckets is not None:
        kept = Snapshot(spark, job.target["path"], bucket_table, buckets.schema)
        part = kept.write_part(buckets)
        kept.commit([part], None, append=True)
        buckets = spark.read.parquet(f"{kept.path}/{part}").orderBy("source_table", "bucket_value")
    return out, buckets
