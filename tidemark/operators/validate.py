"""Row validation as one projection: normalised values and an array of messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import array_checked, json_checked, joined_key, row_json
from tidemark.operators import compat
from tidemark.sources.catalog import Table


def checked(df: DataFrame, source: Table, target: Table, not_null: bool = True, lengths: bool = True, truncate: bool = False, rules: dict[str, Column] | None = None) -> DataFrame:
    """``df`` (columns of the target) converted to the target's types, with ``errors`` and the raw row as ``_raw``.

    Texts become arrays where the target has an array.  ``rules`` are declared conditions
    by message, over the converted values; a row breaks one where it is false, not where it is null."""
    raw = row_json(df.schema)
    messages: list[Column] = []
    cells: list[Column] = []
    staged = df.withColumn("_raw", raw)
    parsed = {c.name: json_checked(F.col(c.name)) for c in target.columns if c.json and c.name in df.columns}
    for name, struct in parsed.items():
        staged = staged.withColumn(f"_json_{name}", struct)
    for name in df.columns:
        meta, value = target[name], F.col(name)
        broken = F.lit(False)
        if name in parsed:
            messages.append(F.when(F.col(f"_json_{name}.error").isNotNull(), F.concat(F.lit(f"{name} "), F.col(f"_json_{name}.error"))))
            broken, value = F.col(f"_json_{name}.error").isNotNull(), F.col(f"_json_{name}.text")
        if isinstance(meta.kind, T.ArrayType) and isinstance(df.schema[name].dataType, T.StringType):
            made = array_checked(value, meta.kind.elementType)
            messages.append(F.when(made["error"].isNotNull(), F.concat(F.lit(f"{name} "), made["error"])))
            broken, value = made["error"].isNotNull(), made["items"]
        elif name in source.names and not isinstance(meta.kind, T.StringType) and df.schema[name].dataType != meta.kind:
            made = compat.converted(value, source[name].type_name, meta.kind)
            messages.append(F.when(value.isNotNull() & made.isNull(), F.lit(f"{name} has no value of type {meta.type_name}")))
            broken, value = broken | (value.isNotNull() & made.isNull()), made
        if not_null and not meta.nullable and not meta.filled_by_target:
            messages.append(F.when(value.isNull() & ~broken, F.lit(f"{name} must not be null")))
        if meta.limited:
            size = F.char_length(value)
            if truncate:
                value = F.substring(value, 1, meta.max_length)
            elif lengths:
                messages.append(F.when(size > meta.max_length, F.concat(F.lit(f"{name} has "), size.cast("string"), F.lit(f" characters, {meta.max_length} are allowed"))))
        cells.append(value.alias(name))
    out = staged.select(*cells, F.array(*messages).alias("_found") if messages else F.array().cast("array<string>").alias("_found"), "_raw")
    # Rules see the converted values, under their columns' names.
    broken_rules = [F.when(~F.expr(rule) if isinstance(rule, str) else ~rule, F.lit(message)) for message, rule in (rules or {}).items()]
    errors = F.array_compact(F.concat("_found", F.array(*broken_rules)) if broken_rules else F.col("_found"))
    return out.select(*df.columns, errors.alias("errors"), "_raw")


def referenced(rows: DataFrame, columns: Sequence[str], other: DataFrame, keys: Sequence[str], message: str) -> DataFrame:
    """Checked rows with ``message`` added to ``errors`` where a foreign key has no row in ``other``; a null in it refers to nothing."""
    names = [f"_ref_{k}" for k in keys]
    held = other.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), F.lit(True).alias("_held")).distinct()
    joined = rows.join(held, [F.col(c) == F.col(n) for c, n in zip(columns, names)], "left")
    lost = F.col("_held").isNull()
    for c in columns:
        lost = lost & F.col(c).isNotNull()
    errors = F.when(lost, F.array_append("errors", F.lit(message))).otherwise(F.col("errors"))
    return joined.select(*(errors.alias("errors") if c == "errors" else F.col(c) for c in rows.columns))


def accepted(checked_rows: DataFrame) -> DataFrame:
    return checked_rows.where(F.size("errors") == 0).drop("errors", "_raw")


def rejected(checked_rows: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Rows for the error log: ``table_name, business_key, error_message, row_data``."""
    bad = checked_rows.where(F.size("errors") > 0)
    key = joined_key(list(keys)) if keys else F.lit(None).cast("string")
    return bad.select(F.lit(table).alias("table_name"), key.alias("business_key"), F.array_join("errors", "; ").alias("error_message"), F.col("_raw").alias("row_data"))
