"""A quality classifier by compression (operator 9).

Two zstandard dictionaries are built from good and from bad labelled text.  A
text is cut into blocks, every block is compressed with either dictionary, and
the difference of the two sizes, divided by the larger one, tells which kind it
resembles.  A logistic curve over that difference and the compressed share of
the text, fitted on labelled rows that the dictionaries haven't seen, turns it
into a score.

Learning reads at most ``rows_per_class`` labelled rows of either class, those of
the least hash of their id, to their ends.  Half of them give the dictionaries, from
at most ``blocks_per_class`` blocks of a class, those of the least hash; the other
half fits the curve, each row weighted so that the classes count as they do among
all labels.  Sizes are measured where the texts are; blocks and a few numbers for
each row reach the driver.  Scoring reads every text to its end.  Labels, language,
source and id are no inputs of a score.

A null text scores as an empty one.  Rows of one id give the curve their mean.  Without rows of both classes nothing can be
learned, and every score is the share of good labels (one half without labels).
Repeated rows keep a row each; null ids are never held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import scratch
from tidemark.llm.tables import table

BLOCK, DICTIONARY, LEVEL, ROWS_PER_CLASS, BLOCKS_PER_CLASS = 2000, 112_640, 3, 2000, 6000


@dataclass(frozen=True)
class Model:
    """Dictionaries of good and bad text (empty: nothing learned), and the curve's weights."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]


class Meter:
    """Compressed sizes of texts under a model's dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard as z

        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.good, self.bad = (z.ZstdCompressor(level=LEVEL, dict_data=_loaded(d), **plain).compress for d in (good, bad))

    def features(self, text: str) -> list[float]:
        """One; the normalised size difference; the log of the compressed share, and their products."""
        raw = text.encode("utf-8", "replace")
        good = bad = 0
        for block in blocks_of(raw):
            good += len(self.good(block))
            bad += len(self.bad(block))
        if not raw:
            return [1.0, 0.0, 0.0, 0.0, 0.0]
        difference, share = (bad - good) / max(bad, good), log(min(bad, good) / len(raw))
        return [1.0, difference, share, share * share, difference * share]


def _loaded(raw: bytes):
    import zstandard as z

    made = z.ZstdCompressionDict(raw)
    made.precompute_compress(level=LEVEL)
    return made


def _dictionary(samples: list[bytes]) -> bytes:
    import zstandard as z

    try:
        return z.train_dictionary(DICTIONARY, samples).as_bytes()
    except z.ZstdError:  # too few samples: their text itself serves, as much as a dictionary holds
        return b"".join(samples)[-DICTIONARY:] or b" "


def _curve(x: np.ndarray, y: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve over rows that count as much as ``of`` says, by Newton's method, with a small penalty."""
    w, keep = np.zeros(x.shape[1]), 1e-2 * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (of * p * (1 - p) + 1e-9)) @ x + keep, x.T @ (of * (y - p)) - keep @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(id_col: str) -> F.Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def blocks_of(raw: bytes) -> list[bytes]:
    return [raw[k : k + BLOCK] for k in range(0, len(raw), BLOCK)]


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows_per_class: int = ROWS_PER_CLASS, blocks_per_class: int = BLOCKS_PER_CLASS) -> Model:
    """Dictionaries from one half of the sample, the curve from the other half."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)").where(~held_out("id"))
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    all_of = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    # A limit for each class: partial sorts, so no task gathers a class.
    order = [F.xxhash64("id"), F.col("id")]
    picked = [known.where(F.col("y") == y).orderBy(*order).limit(rows_per_class).withColumn("half", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2))) for y in (0, 1)]
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(picked[0].unionByName(picked[1])), "id")  # 2 * rows_per_class ids at most
    rows = scratch.materialise(rows)
    there = {(r["y"], r["half"]): r["n"] for r in rows.groupBy("y", "half").agg(F.count_distinct("id").alias("n")).collect()}
    n = [sum(v for (c, _), v in there.items() if c == y) for y in (0, 1)]
    if not all(n):
        p = min(0.99, max(0.01, n[1] / sum(n))) if sum(n) else 0.5
        return Model(b"", b"", (log(p / (1 - p)),))
    # Where a half lacks a class, all of its rows serve both ends.
    part = lambda y, half: (F.col("y") == y) & ((F.col("half") == half) if (y, 0) in there and (y, 1) in there else F.lit(True))
    good, bad = (_dictionary(_blocks(rows.where(part(y, 0)), blocks_per_class)) for y in (1, 0))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = Meter(good, bad)
        for b in batches:
            made = [meter.features(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made, pa.list_(pa.float64()))], names=["id", "y", "x"])

    kind = rows.schema["id"].dataType.simpleString()
    met = rows.where(part(0, 1) | part(1, 1)).select("id", "y", "text").mapInArrow(measure, f"id {kind}, y int, x array<double>")
    got = met.groupBy("id", "y").agg(*(F.avg(F.col("x")[k]).alias(f"x{k}") for k in range(5))).orderBy("y", "id").collect()
    x, y = np.array([r[2:] for r in got], float), np.array([r["y"] for r in got], float)
    share = np.array([all_of[0], all_of[1]], float) / (all_of[0] + all_of[1])
    have = np.array([(y == c).mean() for c in (0, 1)])
    return Model(good, bad, tuple(_curve(x, y, (share / have)[y.astype(int)]).tolist()))


def _blocks(rows: DataFrame, most: int) -> list[bytes]:
    """Blocks of whole texts, at most so many: those of the least hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(blocks_of(t.as_py().encode("utf-8", "replace")), pa.binary())], names=["block"])

    found = rows.select("text").mapInArrow(cut, "block binary")
    return [bytes(r["block"]) for r in found.orderBy(F.xxhash64("block"), "block").limit(most).collect()]


def scorer(model: Model):
    """A function of one text."""
    meter, w = Meter(model.good, model.bad) if model.good else None, model.weights

    def run(text: str | None) -> float:
        x = meter.features(text or "") if meter else [1.0]
        return 1 / (1 + exp(-min(30.0, max(-30.0, sum(a * c for a, c in zip(x, w))))))

    return run


def score_column(model: Model, text_col: str = "text") -> F.Column:
    """The score as a column; only the text goes to Python, and all rows stay where they are."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = scorer(model)
        for b in batches:
            yield pd.Series([of(t) for t in b], dtype="float64")

    return run(F.col(text_col))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All of ``docs`` with ``score``, from 0 to 1; higher for text more like the good one."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = scorer(model)
        for b in batches:
            made = [of(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.float64())], names=["id", "score"])

    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def op9_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
