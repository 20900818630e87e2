"""What is known of a table's columns and keys.

Spark files carry no keys, defaults or NOT NULL, so these come from the schema's
field metadata or from declarations in the job.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    type_name: str
    kind: T.DataType
    nullable: bool = True
    max_length: int | None = None
    default: Any = None
    identity: str | None = None  # "always" or "by default"
    json: bool = False

    @property
    def generated_always(self) -> bool:
        return self.identity == "always"

    @property
    def filled_by_target(self) -> bool:
        return self.default is not None or self.identity is not None

    @property
    def limited(self) -> bool:
        return self.max_length is not None and isinstance(self.kind, T.StringType)


@dataclass(frozen=True)
class Table:
    """Columns in order, and declared keys."""

    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...] = ()
    unique: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def __getitem__(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def indexes(self) -> list[tuple[str, ...]]:
        return [*([self.primary_key] if self.primary_key else []), *self.unique.values()]

    @property
    def nullable(self) -> list[str]:
        return [c.name for c in self.columns if c.nullable]

    @property
    def smallest_unique(self) -> tuple[str, ...]:
        """The unique constraint of the fewest columns, then of the first name."""
        return min(self.unique.items(), key=lambda x: (len(x[1]), x[0]), default=("", ()))[1]


def describe(name: str, df: DataFrame, declared: dict[str, dict] | None = None, primary_key: Sequence[str] = (), unique: dict[str, Sequence[str]] | None = None) -> Table:
    """A table from a schema, its metadata and declarations by column
    (``type, nullable, max_length, default, identity, json``)."""
    columns = []
    for f in df.schema:
        own = (declared or {}).get(f.name, {})
        limited = re.match(r"(?:var)?char\((\d+)\)", f.metadata.get("__CHAR_VARCHAR_TYPE_STRING", ""))
        columns.append(
            Column(
                f.name,
                own.get("type", f.metadata.get("__CHAR_VARCHAR_TYPE_STRING", f.dataType.simpleString())),
                f.dataType,
                own.get("nullable", f.nullable) and f.name not in primary_key,
                own.get("max_length", int(limited[1]) if limited else None),
                own.get("default", f.metadata.get("CURRENT_DEFAULT")),
                own.get("identity"),
                own.get("json", False),
            )
        )
    return Table(name, tuple(columns), tuple(primary_key), {k: tuple(v) for k, v in (unique or {}).items()})


def with_key(table: Table, primary_key: Iterable[str]) -> Table:
    return replace(table, primary_key=tuple(primary_key))


def detect_key(configured: Sequence[str] | None, source: Table, target: Table) -> tuple[str, ...]:
    """Configured columns, else the target's or the source's primary key, else their smallest unique constraint."""
    for found in (configured, target.primary_key, source.primary_key, target.smallest_unique, source.smallest_unique):
        if found:
            return tuple(found)
    raise LookupError(f"no business key is known for {target.name}")


def detect_key_for_check(configured: Sequence[str] | None, source: Table, target: Table) -> tuple[str, ...]:
    """As ``detect_key``, but an empty configured list means none, and so does nothing found."""
    if configured is not None:
        return tuple(configured)
    try:
        return detect_key(None, source, target)
    except LookupError:
        return ()


def constraint_columns(constraints: DataFrame, usage: DataFrame, kind: str) -> DataFrame:
    """Columns in order of every constraint of a kind, from catalogue tables ``(schema, table, name, kind)``
    and ``(schema, table, name, column, position)``."""
    key = ["schema", "table", "name"]
    return constraints.where(F.col("kind") == kind).join(usage, key).groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "column"))), lambda x: x["column"]).alias("columns"))


def smallest_constraint(columns: DataFrame) -> DataFrame:
    """For every table its constraint of the fewest columns, ties by name."""
    best = F.min(F.struct(F.size("columns").alias("n"), "name", "columns"))
    return columns.groupBy("schema", "table").agg(best.alias("x")).select("schema", "table", "x.name", "x.columns")


def index_columns(indexes: DataFrame) -> DataFrame:
    """Key columns of usable unique indexes: ``(name, unique, valid, partial, expression, key_columns, columns)``."""
    usable = indexes.where("unique and valid and not partial and not expression")
    placed = usable.select("name", "key_columns", F.posexplode("columns").alias("place", "column")).where("place < key_columns")
    return placed.groupBy("name").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "column"))), lambda x: x["column"]).alias("columns"))


def estimated_rows(spark: SparkSession, table: str) -> int | None:
    """The row count that ANALYZE TABLE has stored, if any."""
    for r in spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Statistics'").collect():
        found = re.search(r"(\d+) rows", r["data_type"])
        return int(found[1]) if found else None
    return None
