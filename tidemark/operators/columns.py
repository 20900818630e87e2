"""Which columns a load writes, and what must hold before it starts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import compat
from tidemark.operators.probes import key_safety
from tidemark.sources.catalog import Table, detect_key


class PreflightError(Exception):
    """The table can't be loaded as it is configured; it is skipped."""


@dataclass
class ColumnPlan:
    common: list[str]
    loaded: list[str]
    defaults: dict[str, Any]
    keys: tuple[str, ...] = ()
    append_only: bool = False
    warnings: list[str] = field(default_factory=list)

    def project(self, df: DataFrame, target: Table) -> DataFrame:
        """Source columns in the target's order, with defaults where they are null or missing."""
        cells = []
        for c in self.loaded:
            kind = target[c].kind
            value = F.col(c) if c in self.common else F.lit(None).cast(kind)
            cells.append(F.coalesce(value, F.lit(self.defaults[c]).cast(kind)).alias(c) if c in self.defaults else value.alias(c))
        return df.select(*cells)


def plan_columns(source: Table, target: Table, defaults: dict[str, Any] | None = None) -> ColumnPlan:
    """Common columns in the target's order, then target columns that a default fills."""
    if not source.columns:
        raise PreflightError(f"source {source.name} does not exist")
    if not target.columns:
        raise PreflightError(f"target {target.name} does not exist")
    names, defaults = set(source.names), dict(defaults or {})
    shared = [c.name for c in target.columns if c.name in names]
    if not shared:
        raise PreflightError(f"{source.name} and {target.name} have no column in common")
    wrong, warnings = [], []
    for c in shared:
        ok, warn = compat.compatible(source[c].type_name, target[c].type_name)
        what = f"{c}: {source[c].type_name} to {target[c].type_name}"
        (warnings if warn else wrong if not ok else []).append(what)
    if wrong:
        raise PreflightError("incompatible types: " + "; ".join(wrong))
    if unknown := [c for c in defaults if c not in target.names]:
        raise PreflightError("defaults for columns that the target lacks: " + ", ".join(unknown))
    common = [c for c in shared if not target[c].generated_always]
    only = [c for c in target.columns if c.name not in names and not c.generated_always]
    if missing := [c.name for c in only if not c.nullable and not c.filled_by_target and c.name not in defaults]:
        raise PreflightError("NOT NULL columns that neither the source nor a default fills: " + ", ".join(missing))
    loaded = [c.name for c in target.columns if c.name in common or c in only and c.name in defaults and not c.filled_by_target]
    return ColumnPlan(common, loaded, {k: v for k, v in defaults.items() if k in loaded}, warnings=warnings)


def preflight(
    source: Table,
    target: Table,
    source_df: DataFrame,
    target_df: DataFrame,
    load_type: str,
    defaults: dict[str, Any] | None = None,
    cursor: str | None = None,
    configured_keys: Sequence[str] | None = None,
    insert_only: bool = False,
    allow_duplicates: bool = False,
    allow_without_target_index: bool = False,
    partition_column: str | None = None,
) -> ColumnPlan:
    """All checks before a load, in order; a ``PreflightError`` tells the first that fails."""
    plan = plan_columns(source, target, defaults)
    incremental = load_type == "incremental"

    def written(column: str, what: str) -> None:
        if column not in source.names or column not in target.names:
            raise PreflightError(f"{what} {column} is not a column of both tables")
        if target[column].generated_always:
            raise PreflightError(f"{what} {column} is GENERATED ALWAYS")

    if incremental:
        if not cursor:
            raise PreflightError("an incremental load needs an incremental column")
        written(cursor, "incremental column")
    plan.append_only = insert_only and (allow_duplicates or not incremental)
    if not plan.append_only:
        try:
            plan.keys = detect_key(configured_keys, source, target)
        except LookupError as e:
            if incremental:
                raise PreflightError(str(e)) from None
            plan.append_only = True
            plan.warnings.append(f"{e}; rows are appended")
    if plan.keys:
        generated = [k for k in plan.keys if k in target.names and target[k].generated_always]
        if generated and not configured_keys and not incremental:
            plan.keys, plan.append_only = (), True
            plan.warnings.append("the detected key is GENERATED ALWAYS; rows are appended")
        elif generated:
            raise PreflightError("business key is GENERATED ALWAYS: " + ", ".join(generated))
    if lost := [k for k in plan.keys if k not in plan.common]:
        raise PreflightError("business key columns that are not common: " + ", ".join(lost))
    if plan.keys:
        verdict = key_safety(plan.keys, source_df, target_df, incremental, source.nullable, target.nullable, source.indexes, target.indexes, allow_without_target_index)
        plan.warnings += verdict.warnings
        if not verdict.safe:
            raise PreflightError("; ".join(verdict.errors))
    if partition_column:
        written(partition_column, "partition column")
    return plan
