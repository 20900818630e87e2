"""Upserts and appends as one plan.

Every staged row gets an ``action``; counts, rejected rows and the new table are
three reads of that plan.  Both sides carry a presence flag, so a null in the
data is never taken for a missing row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def last_write(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of each key; ``copies`` tells how many there were."""
    w = W.partitionBy(*keys)
    ranked = df.withColumn("_rank", F.row_number().over(w.orderBy(*order))).withColumn("copies", F.count("*").over(w))
    return ranked.where("_rank = 1").drop("_rank")


def upsert_actions(target: DataFrame, source: DataFrame, keys: Sequence[str], cursor: str | None = None) -> DataFrame:
    """Full outer join by key with ``action`` and both sides' columns (``s_`` and ``t_``).

    ``insert``: only in the source; ``keep``: only in the target; ``update``: in both,
    and the source's cursor isn't behind; ``stale``: behind, or not comparable;
    ``conflict``: in both, with nothing but the key to update.
    """
    others = [c for c in source.columns if c not in keys]
    s = source.select(*(F.col(k).alias(k) for k in keys), *(F.col(c).alias(f"s_{c}") for c in others), F.lit(True).alias("_s"))
    t = target.select(*(F.col(k).alias(k) for k in keys), *(F.col(c).alias(f"t_{c}") for c in target.columns if c not in keys), F.lit(True).alias("_t"))
    joined = t.join(s, list(keys), "full_outer")
    fresh = F.lit(True) if cursor is None or cursor in keys else F.coalesce(F.col(f"s_{cursor}") >= F.col(f"t_{cursor}"), F.lit(False))
    both = F.when(F.lit(not others), "conflict").when(fresh, "update").otherwise("stale")
    action = F.when(F.col("_t").isNull(), "insert").when(F.col("_s").isNull(), "keep").otherwise(both)
    return joined.withColumn("action", action).drop("_s", "_t")


def upserted(actions: DataFrame, columns: Sequence[str], keys: Sequence[str], source_columns: Sequence[str]) -> DataFrame:
    """The new table from its actions; columns that the source lacks keep the target's value."""
    return actions.select(*upserted_cells(columns, keys, source_columns))


def upserted_cells(columns: Sequence[str], keys: Sequence[str], source_columns: Sequence[str]) -> list[Column]:
    take = F.col("action").isin("insert", "update")
    return [F.col(c) if c in keys else F.when(take, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) if c in source_columns else F.col(f"t_{c}").alias(c) for c in columns]


def action_counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action").agg(F.count("*").alias("n"))


def unseen(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks."""
    return source.join(target.select(*keys).distinct(), list(keys), "left_anti")


def matched(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target has."""
    return source.join(target.select(*keys).distinct(), list(keys), "left_semi")


def _all_unique(unique: Sequence) -> list[tuple[str, ...]]:
    """Keys as a list of column lists; one list of names counts as one key."""
    if unique and all(isinstance(c, str) for c in unique):
        return [tuple(unique)]
    return [tuple(u) for u in unique]


def append_actions(target: DataFrame, source: DataFrame, unique: Sequence = ()) -> DataFrame:
    """Source rows with ``action``: ``insert``, or ``conflict`` where any declared unique key is taken,
    in the target or by an earlier row of the batch (by all columns, nulls last).

    ``unique`` is one key or a list of keys; a null in a key is equal to nothing."""
    keys = _all_unique(unique)
    if not keys:
        return source.withColumn("action", F.lit("insert"))
    found, marks = source, []
    for n, key in enumerate(keys):
        rank, taken = f"_rank{n}", f"_taken{n}"
        first = W.partitionBy(*key).orderBy(*(F.col(c).asc_nulls_last() for c in source.columns))
        held = target.select(*(F.col(c).alias(f"_{n}_{c}") for c in key), F.lit(True).alias(taken)).distinct()
        found = found.withColumn(rank, F.row_number().over(first)).join(held, [F.col(c) == F.col(f"_{n}_{c}") for c in key], "left")
        marks.append(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in key)) & ((F.col(rank) > 1) | F.col(taken).isNotNull()))
    action = F.when(reduce(lambda a, b: a | b, marks), "conflict").otherwise("insert")
    return found.select(*source.columns, action.alias("action"))


def clashing(target: DataFrame, source: DataFrame, keys: Sequence[str], unique: Sequence) -> DataFrame:
    """Keys of source rows that would take another row's unique key: one of the target's rows with another
    business key, or of an earlier row of the batch (by business key)."""
    out = source.select(*keys).limit(0)
    for u in _all_unique(unique):
        whole = source.dropna(subset=list(u)).select(*keys, *(c for c in u if c not in keys))
        ranked = whole.withColumn("_rank", F.row_number().over(W.partitionBy(*u).orderBy(*keys)))
        held = target.select(*(F.col(c).alias(f"_u_{c}") for c in u), *(F.col(k).alias(f"_k_{k}") for k in keys))
        other = reduce(lambda a, b: a | b, (~F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys))
        taken = whole.join(held, reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_u_{c}") for c in u] + [other]), "left_semi")
        out = out.union(ranked.where("_rank > 1").select(*keys)).union(taken.select(*keys))
    return out.distinct()


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, counting repeats; ``side`` names where they are."""
    common = list(left.columns)
    a = left.exceptAll(right.select(*common)).withColumn("side", F.lit("left"))
    return a.union(right.select(*common).exceptAll(left).withColumn("side", F.lit("right")))
