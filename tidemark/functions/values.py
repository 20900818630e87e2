"""Normal forms of values: nulls in configuration, JSON, arrays, and texts for logs."""

from __future__ import annotations

import ast
import json
import math
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of a configuration that mean null (fixed values).
NULL_WORDS = (None, "", "None", "null", "NULL")


def typed(value: Any, kind: T.DataType) -> Column | None:
    """A cursor or key value from text, as the column's own type; None for null words."""
    return None if value in NULL_WORDS else F.lit(value if isinstance(value, (str, int, float, bool)) else str(value)).cast(kind)


#: Marks of checkpoint texts that aren't a plain cast: microseconds of an instant, Base64 of bytes.
MICROS, BYTES = "us:", "b64:"


def stored(column: Column, kind: T.DataType) -> Column:
    """A value as the text that a checkpoint holds; the same whatever the session's time zone is."""
    if isinstance(kind, T.TimestampType):
        return F.concat(F.lit(MICROS), F.unix_micros(column).cast("string"))
    if isinstance(kind, T.BinaryType):
        return F.concat(F.lit(BYTES), F.base64(column))
    return column.cast("string")


def recalled(text: str | None, kind: T.DataType) -> Column | None:
    """The value of a checkpoint's text, as the column's own type."""
    if text is None:
        return None
    if isinstance(kind, T.TimestampType) and text.startswith(MICROS):
        return F.timestamp_micros(F.lit(int(text[len(MICROS) :])))
    if isinstance(kind, T.BinaryType) and text.startswith(BYTES):
        return F.unbase64(F.lit(text[len(BYTES) :]))
    return F.lit(text).cast(kind)


def _refuse(x: str) -> None:
    raise ValueError(x)


def json_text(value: str | None) -> str | None:
    """Strict JSON kept as it is (without outer blanks), Python literals as JSON, blank as null.

    Raises ValueError for anything else, and for NaN and infinities."""
    if value is None or not value.strip():
        return None
    text = value.strip()
    try:
        json.loads(text, parse_constant=_refuse)
        return text
    except ValueError:
        pass
    try:
        made = ast.literal_eval(text)
    except (ValueError, SyntaxError, MemoryError, RecursionError, TypeError):
        raise ValueError("not JSON") from None
    if not isinstance(made, (dict, list, tuple, int, float, bool, type(None))) or isinstance(made, float) and not math.isfinite(made):
        raise ValueError("not JSON")
    try:
        return json.dumps(made, allow_nan=False)
    except (TypeError, ValueError):
        raise ValueError("not JSON") from None


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("error", T.StringType())]))
def _json_slow(values: pd.Series) -> pd.DataFrame:
    out = []
    for v in values:
        try:
            out.append((json_text(v), None))
        except ValueError:
            out.append((None, "not valid JSON"))
    return pd.DataFrame(out, columns=["text", "error"])


def strict_json(text: Column) -> Column:
    """Whether a text is one JSON value with nothing behind it; null counts as false.

    The parser stops after one value, so the text is also tried as a sole array
    element and a sole member: garbage behind it can't end both."""
    return F.coalesce(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull() & F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull(), F.lit(False))


def json_checked(text: Column) -> Column:
    """A struct ``text, error``: the normal form, or why there is none.

    Valid JSON stays in generated code; only what fails goes to Python."""
    clean = F.trim(text)
    struct = lambda t, e: F.struct(t.alias("text"), e.alias("error"))
    none = F.lit(None).cast("string")
    fine = text.isNull() | (clean == "") | strict_json(clean)
    slow = _json_slow(F.when(~fine, clean))
    return F.when(text.isNull() | (clean == ""), struct(none, none)).when(fine, struct(clean, none)).otherwise(struct(slow["text"], slow["error"]))


def array_literal(items: Column) -> Column:
    """An array of texts as a braced literal, quoted, with backslashes and quotes escaped."""
    quoted = F.transform(items, lambda x: F.when(x.isNull(), "NULL").otherwise(F.concat(F.lit('"'), F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))))
    return F.when(items.isNotNull(), F.concat(F.lit("{"), F.array_join(quoted, ","), F.lit("}")))


def is_array_literal(text: Column) -> Column:
    return text.startswith("{") & text.endswith("}")


def array_items(text: str | None) -> list[str | None] | None:
    """The items of an array's text: a braced literal, or a Python literal (one that isn't a list is its only item).

    Blank is null.  Raises ValueError for anything else."""
    if text is None or not (text := text.strip()):
        return None
    if text.startswith("{") and text.endswith("}"):
        return _braced(text[1:-1])
    try:
        made = ast.literal_eval(text)
    except (ValueError, SyntaxError, MemoryError, RecursionError, TypeError):
        raise ValueError("not an array") from None
    return [None if x is None else str(x) for x in (made if isinstance(made, (list, tuple)) else [made])]


def _braced(body: str) -> list[str | None]:
    """Items parted by commas; quotes keep commas, braces and blanks, a backslash keeps the next character."""
    items: list[str | None] = []
    k, n = 0, len(body)
    if not body.strip():
        return items
    while True:
        item, quoted, inside = [], False, False
        while k < n and (inside or body[k] != ","):
            c = body[k]
            if c == "\\" and k + 1 < n:
                item.append(body[k + 1])
                k += 1
            elif c == '"':
                inside, quoted = not inside, True
            elif not inside and c in "{}":
                raise ValueError("not a one-dimensional array")
            elif inside or not c.isspace() or item:
                item.append(c)
            k += 1
        if inside:
            raise ValueError("an open quote")
        word = "".join(item) if quoted else "".join(item).rstrip()
        if not quoted and not word:
            raise ValueError("an empty item")
        items.append(None if not quoted and word.upper() == "NULL" else word)
        if k >= n:
            return items
        k += 1


@F.pandas_udf(T.StructType([T.StructField("items", T.ArrayType(T.StringType())), T.StructField("error", T.StringType())]))
def _array_slow(values: pd.Series) -> pd.DataFrame:
    out = []
    for v in values:
        try:
            out.append((array_items(v), None))
        except ValueError:
            out.append((None, "is not an array"))
    return pd.DataFrame(out, columns=["items", "error"])


def array_checked(text: Column, element: T.DataType) -> Column:
    """A struct ``items, error``: the array of a text, or why there is none.

    Literals of plain unquoted items stay in generated code; others go to Python."""
    clean = F.trim(text)
    plain = clean.rlike(r'^\{[^{}"\\\s,]+(,[^{}"\\\s,]+)*\}$')
    quick = F.transform(F.split(F.substr(clean, F.lit(2), F.length(clean) - 2), ","), lambda x: F.when(F.upper(x) != "NULL", x))
    slow = _array_slow(F.when(~plain, clean))
    items = F.when(plain, quick).otherwise(slow["items"])
    made = F.transform(items, lambda x: x.try_cast(element))
    wrong = F.exists(F.zip_with(items, made, lambda a, b: a.isNotNull() & b.isNull()), lambda x: x)
    error = F.when(~plain & slow["error"].isNotNull(), slow["error"]).when(wrong, F.lit("holds an item of another type"))
    return F.struct(F.when(error.isNull(), made).alias("items"), error.alias("error"))


def loggable(value: Column, kind: T.DataType) -> Column:
    """A value as it goes into a log: exact decimals as text, bytes in Base64, times in ISO form; so within containers."""
    if isinstance(kind, T.DecimalType):
        return value.cast("string")
    if isinstance(kind, T.BinaryType):
        return F.base64(value)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.translate(value.cast("string"), " ", "T")
    if isinstance(kind, (T.DateType, T.DayTimeIntervalType, T.YearMonthIntervalType)):
        return value.cast("string")
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: loggable(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*(loggable(value[f.name], f.dataType).alias(f.name) for f in kind)))
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(e["key"].cast("string").alias("key"), loggable(e["value"], kind.valueType).alias("value")))
        return F.map_from_entries(entries)
    return value


def row_json(schema: T.StructType) -> Column:
    return F.to_json(F.struct(*(loggable(F.col(f.name), f.dataType).alias(f.name) for f in schema)), {"ignoreNullFields": "false"})


def joined_key(keys: list[str]) -> Column:
    return F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("None")) for k in keys))
