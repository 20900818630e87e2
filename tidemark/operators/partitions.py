"""Partition planning: which children a batch needs, from the values it holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import names

REGISTRY = "table_name string, partition_name string, bound_kind string, lower_bound string, upper_bound string"


def range_periods(df: DataFrame, column: str, granularity: str) -> DataFrame:
    """``lower_bound, upper_bound`` of each period present; gaps are not filled."""
    starts = df.where(F.col(column).isNotNull()).select(names.period_column(column, granularity).alias("lower_bound")).distinct()
    return starts.select("lower_bound", names.next_period_column(F.col("lower_bound"), granularity).alias("upper_bound"))


def all_periods(df: DataFrame, column: str, granularity: str) -> DataFrame:
    """Every period from the first to the last, present or not."""
    ends = df.agg(F.min(names.period_column(column, granularity)).alias("a"), F.max(names.period_column(column, granularity)).alias("z")).where("a is not null")
    step = "interval 1 month" if granularity == "monthly" else "interval 1 day"
    starts = ends.select(F.explode(F.expr(f"sequence(a, z, {step})")).alias("lower_bound"))
    return starts.select("lower_bound", names.next_period_column(F.col("lower_bound"), granularity).alias("upper_bound"))


def list_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("value")).distinct()


def plan_ranges(df: DataFrame, table: str, column: str, granularity: str, form: str | None = None) -> DataFrame:
    """Registry rows for the periods of a batch."""
    found = range_periods(df, column, granularity)
    return found.select(F.lit(table).alias("table_name"), names.range_name_column(table, F.col("lower_bound"), granularity, form).alias("partition_name"), F.lit("RANGE").alias("bound_kind"), F.col("lower_bound").cast("string").alias("lower_bound"), F.col("upper_bound").cast("string").alias("upper_bound"))


def plan_lists(df: DataFrame, table: str, column: str, form: str | None = None) -> DataFrame:
    found = list_values(df, column)
    return found.select(F.lit(table).alias("table_name"), names.list_name_column(table, F.col("value"), form).alias("partition_name"), F.lit("LIST").alias("bound_kind"), F.col("value").alias("lower_bound"), F.lit(None).cast("string").alias("upper_bound"))


def missing(planned: DataFrame, registry: DataFrame) -> DataFrame:
    """Planned children that the registry lacks, by bounds (not by name)."""
    key = ["table_name", "bound_kind", "lower_bound"]
    return planned.join(registry.select(*key).distinct(), key, "left_anti").select(*planned.columns)


def default_partition(registry: DataFrame, table: str) -> DataFrame:
    return registry.where((F.col("table_name") == table) & (F.col("bound_kind") == "DEFAULT"))


def child_of(table: str, column: str, kind: str, granularity: str = "monthly", form: str | None = None, default_form: str | None = None) -> Column:
    """The child that a row belongs to; rows without a value belong to the default one."""
    name = names.range_name_column(table, names.period_column(column, granularity), granularity, form) if kind == "range" else names.list_name_column(table, F.col(column), form)
    return F.when(F.col(column).isNotNull(), name).otherwise(F.lit(names.default_name(table, default_form)))


class Planner:
    """Plans children for a table and its trigger targets, remembering what a run has ensured."""

    #: Children that one batch may ask for; the driver names each of them.
    MOST = 100_000

    def __init__(self) -> None:
        self.ensured: set[tuple[str, str, str]] = set()

    def plan(self, batch: DataFrame, table: str, column: str, kind: str, granularity: str = "monthly", form: str | None = None, registry: DataFrame | None = None) -> list[tuple]:
        """New registry rows for one batch; a row for each period or value, never for each row."""
        planned = plan_ranges(batch, table, column, granularity, form) if kind == "range" else plan_lists(batch, table, column, form)
        rows = (missing(planned, registry) if registry is not None else planned).orderBy("lower_bound").limit(self.MOST + 1).collect()
        if len(rows) > self.MOST:
            raise ValueError(f"{table}.{column} asks for more than {self.MOST} partitions at once; its values don't suit a partition column")
        fresh = [tuple(r) for r in rows if (r["table_name"], r["bound_kind"], r["lower_bound"]) not in self.ensured]
        self.ensured |= {(r[0], r[2], r[3]) for r in fresh}
        return fresh

    def plan_default(self, registry: DataFrame | None, table: str, form: str | None = None) -> list[tuple]:
        """The catch-all child, unless there is one or this run has made it."""
        key = (table, "DEFAULT", "")
        if key in self.ensured or registry is not None and not default_partition(registry, table).isEmpty():
            self.ensured.add(key)
            return []
        self.ensured.add(key)
        return [(table, names.default_name(table, form), "DEFAULT", None, None)]
