"""Token counts by a dynamic program over prefixes (operator 10).

Every prefix of a text has an exact token count; a text's own count is the last
of them, and truncation or budget questions read the stored counts instead of
encoding again.  A null text counts as empty: zero bytes, zero tokens.  Rows
are neither joined nor shuffled, so repeated ids and texts keep their rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import PrefixCounter, default_path
from tidemark.llm.tables import table


@lru_cache(maxsize=2)
def counter(path: str | None) -> PrefixCounter:
    """One counter for each worker; without a path, the worker's own copy of the vocabulary."""
    return PrefixCounter(path or default_path())


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 512, path: str | None = None) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every row; other columns are left out."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for b in batches:
            tokens = pa.array([count(t.as_py() or "") for t in b.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), tokens], names=["id", "n_bytes", "n_tokens"])

    counted = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def prefix_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``id_col, prefix_tokens``: an array whose j-th entry (from 0) counts the tokens of the first j characters."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path).prefix_counts
        for b in batches:
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                tables = pa.array([counts(t.as_py() or "") for t in part.column(1)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), tables], names=["id", "prefix_tokens"])

    return rows.mapInArrow(run, f"id {kind}, prefix_tokens array<int>").withColumnRenamed("id", id_col)


def tokens_of_prefix(chars) -> F.Column:
    """Tokens of the first ``chars`` characters, from a stored prefix table."""
    return F.element_at("prefix_tokens", F.least(F.lit(chars), F.size("prefix_tokens") - 1) + 1)


def longest_prefix(budget) -> F.Column:
    """Characters of the longest prefix with at most ``budget`` tokens, from a stored prefix table."""
    return F.size("prefix_tokens") - 1 - F.coalesce(
        F.array_position(F.transform(F.reverse("prefix_tokens"), lambda n: n <= F.lit(budget)), True) - 1, F.lit(0)
    ).cast("int")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
