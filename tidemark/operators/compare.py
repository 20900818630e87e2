"""Comparison of two tables by counts and fingerprints, whole or by bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fingerprints import multiset_hash, row_text

MATCH, COUNT_MISMATCH, CONTENT_MISMATCH, FAILED = "MATCH", "COUNT_MISMATCH", "CONTENT_MISMATCH", "VALIDATION_FAILED"


def fingerprint(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), cursor: str | None = None, scoped: bool = False) -> DataFrame:
    """One row over one scan: total and scoped counts, the cursor's bounds and nulls, key and row hashes.

    With ``scoped``, counts and hashes are of rows whose cursor isn't null."""
    scope = F.col(cursor).isNotNull() if cursor and scoped else None
    text = lambda f: f(cursor).cast("string") if cursor else F.lit(None).cast("string")
    return df.agg(
        F.count("*").alias("total_count"),
        (F.count_if(scope) if scope is not None else F.count("*")).alias("row_count"),
        text(F.min).alias("min_cursor"),
        text(F.max).alias("max_cursor"),
        (F.count_if(F.col(cursor).isNull()) if cursor else F.lit(0).cast("long")).alias("null_cursors"),
        (multiset_hash(row_text(keys), scope) if keys else F.lit("0:0")).alias("key_hash"),
        multiset_hash(row_text(columns), scope).alias("row_hash"),
    )


def bucket(column: str, granularity: str) -> Column:
    """Text of a row's bucket: its day, its month's first day, or its value."""
    if granularity == "daily":
        return F.col(column).cast("date").cast("string")
    if granularity == "monthly":
        return F.trunc(F.col(column).cast("date"), "MM").cast("string")
    if granularity == "value":
        return F.col(column).cast("string")
    raise ValueError(f"no such granularity: {granularity}")


def bucket_fingerprints(df: DataFrame, column: str, granularity: str, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """A row for each bucket that isn't null: count, key and row hash."""
    rows = df.where(F.col(column).isNotNull()).withColumn("_bucket", bucket(column, granularity))
    key = multiset_hash(row_text(keys)) if keys else F.lit("0:0")
    return rows.groupBy(F.col("_bucket").alias("bucket_value")).agg(F.count("*").alias("row_count"), key.alias("key_hash"), multiset_hash(row_text(columns)).alias("row_hash"))


def status(count_a: Column, count_b: Column, *hashes: tuple[Column, Column]) -> Column:
    same = F.lit(True)
    for a, b in hashes:
        same = same & a.eqNullSafe(b)
    return F.when(count_a != count_b, COUNT_MISMATCH).when(~same, CONTENT_MISMATCH).otherwise(MATCH)


def compare_tables(source: DataFrame, target: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), cursor: str | None = None) -> DataFrame:
    """One row: both sides' fingerprints, the difference of counts, and the status.

    The source counts in scope where its cursor isn't null; the target counts whole."""
    s = fingerprint(source, columns, keys, cursor, scoped=True)
    t = fingerprint(target, columns, keys, cursor)
    names = ("row_count", "min_cursor", "max_cursor", "key_hash", "row_hash")
    s = s.select(F.col("total_count").alias("source_total"), F.col("null_cursors").alias("source_null_cursors"), *(F.col(n).alias(f"source_{n}") for n in names))
    t = t.select(*(F.col(n).alias(f"target_{n}") for n in names))
    # One row on either side.
    both = s.crossJoin(t)
    found = status(F.col("source_row_count"), F.col("target_row_count"), (F.col("source_key_hash"), F.col("target_key_hash")), (F.col("source_row_hash"), F.col("target_row_hash")))
    return both.withColumn("target_difference", F.col("source_row_count") - F.col("target_row_count")).withColumn("status", found)


def compare_buckets(source: DataFrame, target: DataFrame, column: str, granularity: str, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """A row for each bucket of either side, with both sides' counts and hashes and the status."""
    sides = []
    for side, df in (("source", source), ("target", target)):
        made = bucket_fingerprints(df, column, granularity, columns, keys)
        sides.append(made.select("bucket_value", *(F.col(n).alias(f"{side}_{n}") for n in ("row_count", "key_hash", "row_hash"))))
    both = sides[0].join(sides[1], "bucket_value", "full_outer")
    cells = ["bucket_value"]
    for side in ("source", "target"):
        cells.append(F.coalesce(f"{side}_row_count", F.lit(0)).cast("long").alias(f"{side}_row_count"))
        cells += [F.coalesce(f"{side}_{n}", F.lit("0:0")).alias(f"{side}_{n}") for n in ("key_hash", "row_hash")]
    full = both.select(*cells)
    found = status(F.col("source_row_count"), F.col("target_row_count"), (F.col("source_key_hash"), F.col("target_key_hash")), (F.col("source_row_hash"), F.col("target_row_hash")))
    return full.withColumn("count_difference", F.col("source_row_count") - F.col("target_row_count")).withColumn("status", found).orderBy("bucket_value")


def mismatches(compared: DataFrame) -> DataFrame:
    return compared.agg(F.count("*").alias("buckets"), F.count_if(F.col("status") != MATCH).alias("mismatches"))
