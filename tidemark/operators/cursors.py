"""Windows and pages of a growing table.

A keyed table is read in the order of its cursor column and key; a table whose
rows may repeat is read in the order of its cursor column and, within one value,
by the number of rows already seen.  Predicates are written out column by column,
with a redundant leading bound, so that Parquet and JDBC scans can skip by them.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def after(columns: Sequence[str], values: Sequence[Any]) -> Column:
    """Rows that come after ``values`` in the order of ``columns`` (none of them null)."""
    if len(columns) != len(values) or not columns:
        raise ValueError("as many values as columns are needed")
    rest: Column | None = None
    for c, v in reversed(list(zip(columns, values))):
        beyond = F.col(c) > F.lit(v)
        rest = beyond if rest is None else beyond | ((F.col(c) == F.lit(v)) & rest)
    return rest if len(columns) == 1 else (F.col(columns[0]) >= F.lit(values[0])) & rest


def in_order(columns: Sequence[str]) -> list[Column]:
    """Ascending, nulls last."""
    return [F.col(c).asc_nulls_last() for c in columns]


def keyed_window(df: DataFrame, cursor: str, keys: Sequence[str], upper: Any, last: Any = None, last_keys: Sequence[Any] | None = None) -> DataFrame:
    """Rows up to ``upper`` and beyond the last row read (cursor and keys); without one, from the start."""
    found = df.where(F.col(cursor).isNotNull() & (F.col(cursor) <= F.lit(upper)))
    if last is not None and last_keys is not None:
        found = found.where(after([cursor, *keys], [last, *last_keys]))
    elif last is not None:
        found = found.where(F.col(cursor) > F.lit(last))
    return found


def keyed_page(df: DataFrame, cursor: str, keys: Sequence[str], upper: Any, limit: int, last: Any = None, last_keys: Sequence[Any] | None = None) -> DataFrame:
    return keyed_window(df, cursor, keys, upper, last, last_keys).orderBy(*in_order([cursor, *keys])).limit(limit)


def key_page(df: DataFrame, keys: Sequence[str], limit: int, last_keys: Sequence[Any] | None = None) -> DataFrame:
    """The next page of a whole table in the order of its keys."""
    found = df if last_keys is None else df.where(after(keys, last_keys))
    return found.orderBy(*in_order(keys)).limit(limit)


def offset_page(df: DataFrame, offset: int, limit: int) -> DataFrame:
    """A page of a table without a key, in the order of all columns, so that pages don't overlap."""
    return df.orderBy(*in_order(df.columns)).offset(offset).limit(limit)


def numbered(df: DataFrame, cursor: str, order: Sequence[str] | None = None, name: str = "rn") -> DataFrame:
    """Rows numbered within their cursor value, by all other columns."""
    rest = [c for c in (order or df.columns) if c != cursor]
    return df.withColumn(name, F.row_number().over(W.partitionBy(cursor).orderBy(*in_order([cursor, *rest]))))


def seen_window(df: DataFrame, cursor: str, upper: Any, last: Any = None, seen: int = 0) -> DataFrame:
    """Rows of a table with repeats beyond the ``seen`` rows of cursor value ``last``.

    The bound on the cursor reaches the scan.  Only the rows of ``last`` itself are
    numbered, by all other columns; those of other values are taken as they are."""
    bounded = df.where(F.col(cursor).isNotNull() & (F.col(cursor) <= F.lit(upper)))
    if last is None:
        return bounded
    beyond = bounded.where(F.col(cursor) > F.lit(last))
    at = bounded.where(F.col(cursor) == F.lit(last))
    rest = numbered(at, cursor, name="_rn").where(F.col("_rn") > seen).drop("_rn") if seen else at
    return beyond.union(rest)


def seen_page(df: DataFrame, cursor: str, upper: Any, limit: int, last: Any = None, seen: int = 0) -> DataFrame:
    """The next page in the order of the cursor and all other columns: top-k alone, nothing is numbered."""
    order = in_order([cursor, *(c for c in df.columns if c != cursor)])
    bounded = df.where(F.col(cursor).isNotNull() & (F.col(cursor) <= F.lit(upper)))
    if last is None:
        return bounded.orderBy(*order).limit(limit)
    bounded = bounded.where(F.col(cursor) >= F.lit(last))
    at = bounded.where(F.col(cursor) == F.lit(last)).orderBy(*order).offset(seen).limit(limit)
    beyond = bounded.where(F.col(cursor) > F.lit(last)).orderBy(*order).limit(limit)
    return at.union(beyond).orderBy(*order).limit(limit)


def seen_count_left(df: DataFrame, cursor: str, upper: Any, last: Any = None, seen: int = 0) -> DataFrame:
    """How many rows ``seen_window`` has, without numbering any: counts alone."""
    bounded = df.where(F.col(cursor).isNotNull() & (F.col(cursor) <= F.lit(upper)))
    if last is None:
        return bounded.agg(F.count("*").alias("eligible"))
    at = F.count_if(F.col(cursor) == F.lit(last))
    return bounded.where(F.col(cursor) >= F.lit(last)).agg((F.count("*") - F.least(at, F.lit(seen).cast("long"))).alias("eligible"))


def seen_at_end(page: DataFrame, cursor: str, last: Any = None, seen: int = 0) -> DataFrame:
    """The cursor after a page: its highest value and how many rows of that value have been seen in all."""
    top = page.agg(F.max(cursor).alias("last"))
    counted = page.groupBy(F.col(cursor).alias("last")).agg(F.count("*").alias("n")).join(top, "last")
    before = F.when(F.col("last") == F.lit(last), F.lit(seen)).otherwise(F.lit(0)) if last is not None else F.lit(0)
    return counted.select("last", (F.col("n") + before).cast("long").alias("seen"))


def bounds(df: DataFrame, column: str) -> DataFrame:
    """Lowest and highest non-null value."""
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
