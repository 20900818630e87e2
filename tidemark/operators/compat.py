"""Which source types may feed which target types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names of one type (fixed values).
ALIASES = {
    "smallint": "smallint", "int2": "smallint", "short": "smallint",
    "integer": "integer", "int": "integer", "int4": "integer",
    "bigint": "bigint", "int8": "bigint", "long": "bigint",
    "real": "real", "float4": "real", "float": "real",
    "double": "double precision", "float8": "double precision", "double precision": "double precision",
    "varchar": "character varying", "character varying": "character varying",
    "char": "character", "bpchar": "character", "character": "character",
    "string": "text", "text": "text",
    "timestamp_ntz": "timestamp without time zone", "timestamp without time zone": "timestamp without time zone",
    "timestamp": "timestamp with time zone", "timestamptz": "timestamp with time zone", "timestamp with time zone": "timestamp with time zone",
}

#: Conversions that are allowed with a warning (fixed values).
WIDER = {
    "smallint": {"integer", "bigint", "numeric", "decimal"},
    "integer": {"bigint", "numeric", "decimal"},
    "bigint": {"numeric", "decimal", "integer", "smallint"},
    "numeric": {"integer", "bigint", "smallint"},
    "decimal": {"integer", "bigint", "smallint"},
    "real": {"double precision", "integer", "bigint", "smallint", "numeric", "decimal"},
    "double precision": {"integer", "bigint", "smallint", "numeric", "decimal"},
    "character varying": {"text", "character"},
    "character": {"text"},
    "text": {"character varying", "character"},
    "date": {"timestamp without time zone", "timestamp with time zone"},
    "timestamp without time zone": {"timestamp with time zone", "date"},
    "timestamp with time zone": {"date"},
    "json": {"jsonb"},
    "jsonb": {"json"},
}


def canonical(name: str) -> str:
    """The one name of a type, without length or precision; arrays keep their element."""
    name = name.strip().lower()
    if name.startswith("array<") and name.endswith(">"):
        return f"array<{canonical(name[6:-1])}>"
    bare = name.split("(")[0].strip()
    return ALIASES.get(bare, bare)


def of_spark(kind: T.DataType) -> str:
    return canonical(kind.simpleString())


def compatible(source: str, target: str) -> tuple[bool, bool]:
    """``(allowed, with a warning)``; arrays need equal elements."""
    a, b = canonical(source), canonical(target)
    if a == b:
        return True, False
    return (True, True) if b in WIDER.get(a, ()) else (False, False)


def converted(column: Column, source: str, target: T.DataType) -> Column:
    """The value as the target's type; null where it has no exact value there (a fraction, an overflow)."""
    if isinstance(target, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) and canonical(source) in ("real", "double precision", "numeric", "decimal"):
        whole = F.when(column == F.floor(column), column)
        return whole.try_cast(target)
    return column.try_cast(target)
