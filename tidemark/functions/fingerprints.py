"""Order-independent fingerprints of rows and tables.

A row becomes one text (columns joined by U+001F, nulls as U+001E), its md5 two
signed 64-bit numbers, and a table the exact sums of either half.  Sums do not
depend on the order or the partitioning of rows, aggregate on the map side, and
count repeated rows as often as they occur.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELD_MARK, NULL_MARK = "\x1f", "\x1e"


def row_text(columns: Sequence[str | Column]) -> Column:
    """One text for a row, of the columns in their order."""
    cells = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws(FIELD_MARK, *(F.coalesce(c.cast("string"), F.lit(NULL_MARK)) for c in cells))


def half(digest: Column, second: bool) -> Column:
    """A half of an md5 in hex as a signed 64-bit number."""
    return F.conv(F.substring(digest, 17 if second else 1, 16), 16, -10).cast("long")


def multiset_hash(text: Column, when: Column | None = None) -> Column:
    """Aggregate: ``"<sum>:<sum>"`` over the rows (where ``when`` holds); no rows give ``0:0``.

    Each half is summed in four pieces of 16 bits, as plain longs that can't overflow
    below 2**47 rows; the exact decimal sum is put together once, at the end."""
    digest = F.md5(text) if when is None else F.when(when, F.md5(text))
    return F.concat_ws(":", *(_exact_sum(half(digest, s)).cast("string") for s in (False, True)))


def _exact_sum(number: Column) -> Column:
    pieces = [F.shiftright(number, 48), *(F.shiftright(number, bits).bitwiseAND(F.lit(0xFFFF)) for bits in (32, 16)), number.bitwiseAND(F.lit(0xFFFF))]
    total = F.lit(0).cast("decimal(38,0)")
    for p in pieces:
        total = (total * F.lit(1 << 16).cast("decimal(6,0)")).cast("decimal(38,0)") + F.coalesce(F.sum(p), F.lit(0)).cast("decimal(19,0)")
        total = total.cast("decimal(38,0)")
    return total
