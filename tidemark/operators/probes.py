"""Probes of a business key, and the rules that they feed."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_with_null_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys)))


def has_null_key(df: DataFrame, keys: Sequence[str]) -> bool:
    return bool(keys) and not rows_with_null_key(df.select(*keys), keys).isEmpty()


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with ``copies``; nulls count as equal."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def has_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> bool:
    return bool(keys) and not duplicate_keys(df.select(*keys), keys).isEmpty()


def matches_unique_index(keys: Iterable[str], indexes: Iterable[Iterable[str]]) -> bool:
    """Whether one index covers exactly these columns, in any order."""
    return set(keys) in [set(i) for i in indexes]


@dataclass
class Verdict:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)

    @property
    def safe(self) -> bool:
        return not self.errors


def key_safety(
    keys: Sequence[str],
    source: DataFrame,
    target: DataFrame,
    incremental: bool,
    source_nullable: Iterable[str] = (),
    target_nullable: Iterable[str] = (),
    source_indexes: Iterable[Iterable[str]] = (),
    target_indexes: Iterable[Iterable[str]] = (),
    allow_without_target_index: bool = False,
) -> Verdict:
    """May these keys identify rows?  Data is scanned only where metadata can't tell."""
    v = Verdict()
    if not keys:
        return v
    listed = ", ".join(keys)
    if len(set(keys)) < len(keys):
        v.errors.append(f"business key names a column twice: {listed}")
        return v
    loose = [k for k in keys if k in set(source_nullable)]
    if loose:
        if has_null_key(source, loose):
            v.errors.append(f"source business key has nulls: {', '.join(loose)}")
            return v
        v.warnings.append(f"source business key is nullable, its data is not null: {', '.join(loose)}")
    if any(k in set(target_nullable) for k in keys):
        v.warnings.append(f"target business key is nullable: {listed}")
    if not matches_unique_index(keys, source_indexes):
        if has_duplicate_keys(source, keys):
            v.errors.append(f"source business key has duplicates: {listed}")
            return v
        v.warnings.append(f"source has no unique index on the key, its data is unique: {listed}")
    if not matches_unique_index(keys, target_indexes):
        if not incremental:
            v.warnings.append(f"target has no unique index on the key: {listed}")
        elif not allow_without_target_index:
            v.errors.append(f"an incremental load needs a unique target index on the key: {listed}")
        elif has_duplicate_keys(target, keys):
            v.errors.append(f"target business key has duplicates: {listed}")
        else:
            v.warnings.append(f"target has no unique index on the key, its data is unique: {listed}")
    return v
