"""Reports of a run: rejected rows, reconciliation, sequences, hooks, counts."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def error_summary(log: DataFrame) -> DataFrame:
    """Bad rows by table, most first."""
    found = log.groupBy("table_name").agg(F.count("*").alias("bad_row_count"), F.min("error_time").alias("first_error_time"), F.max("error_time").alias("last_error_time"))
    return found.orderBy(F.desc("bad_row_count"), F.asc("table_name"))


def disabled_hooks(registry: DataFrame) -> DataFrame:
    return registry.where("state = 'D'").select("schema_name", "table_name", "hook_name").orderBy("schema_name", "table_name", "hook_name")


def still_disabled(registry: DataFrame, before: DataFrame) -> DataFrame:
    """Hooks that are off after a load and weren't before it, in the report's order."""
    key = ["schema_name", "table_name", "hook_name"]
    return disabled_hooks(registry).join(before.where("state = 'D'").select(*key), key, "left_anti").orderBy(*key)


def sequence_report(df: DataFrame, column: str, increment: int = 1) -> DataFrame:
    """The value a sequence must give next: beyond the largest (ascending) or smallest (descending)."""
    extreme = F.max(column) if increment > 0 else F.min(column)
    return df.agg(extreme.cast("long").alias("table_value")).select("table_value", (F.col("table_value") + increment).alias("next_value"))


def sequence_columns(columns: DataFrame) -> DataFrame:
    """Sequence-backed columns in order, from ``table_schema, table_name, column_name, sequence_name``."""
    return columns.where("sequence_name is not null").select("table_schema", "table_name", "column_name", "sequence_name").orderBy("table_schema", "table_name", "column_name")


def sequence_health(sequences: DataFrame, extremes: DataFrame) -> DataFrame:
    """Each sequence beside its column's extreme value: what it gives next, and whether that is taken.

    ``sequences`` has ``table_name, column_name, last_value, is_called, increment``; ``extremes`` has
    ``table_name, column_name, low, high``."""
    nxt = F.when(F.col("is_called"), F.col("last_value") + F.col("increment")).otherwise(F.col("last_value"))
    up = F.col("increment") > 0
    found = sequences.join(extremes, ["table_name", "column_name"], "left").withColumn("next_value", nxt).withColumn("table_value", F.when(up, F.col("high")).otherwise(F.col("low")))
    behind = F.coalesce(F.when(up, F.col("next_value") <= F.col("table_value")).otherwise(F.col("next_value") >= F.col("table_value")), F.lit(False))
    return found.select("table_name", "column_name", "table_value", "next_value", behind.alias("behind")).orderBy("table_name", "column_name")


def table_counts(counts: DataFrame) -> DataFrame:
    return counts.select("schema_name", "table_name", "live_rows").orderBy("schema_name", "table_name")


@dataclass
class Reconciliation:
    table_name: str
    source_window: int = 0
    processed: int = 0
    inserted: int = 0
    updated: int = 0
    rejected: int = 0
    conflict_skipped: int = 0
    source_total: int = 0
    target_total: int = 0

    @property
    def unaccounted(self) -> int:
        return self.processed - self.inserted - self.updated - self.rejected - self.conflict_skipped

    @property
    def window_difference(self) -> int:
        return self.source_window - self.processed

    @property
    def difference(self) -> int:
        return self.target_total - self.source_total

    def row(self) -> dict:
        return asdict(self) | {"unaccounted": self.unaccounted, "window_difference": self.window_difference, "difference": self.difference}


def reconciliation(actions: DataFrame) -> DataFrame:
    """One row from a plan of actions: what became of the source's rows."""
    n = lambda *a: F.count_if(F.col("action").isin(*a))
    got = actions.agg(n("insert", "update", "stale", "conflict").alias("processed"), n("insert").alias("inserted"), n("update").alias("updated"), n("stale", "conflict").alias("conflict_skipped"))
    return got.withColumn("unaccounted", F.col("processed") - F.col("inserted") - F.col("updated") - F.col("conflict_skipped"))
