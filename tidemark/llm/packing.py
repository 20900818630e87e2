"""Mixture-controlled packing by deficit round-robin (operator 1).

Every source has a queue of tokens and a weight.  A queue earns credit in
proportion to its weight and is served ``quantum`` tokens each time its credit
covers them; what it has earned beyond that is carried on, from window to window
and from partition to partition.  With queue totals known, the state after any
number of tokens has a closed form: after virtual time t a queue has been served
``min(total, quantum * floor(t * weight / quantum))`` tokens.  So each task finds
the state at the borders of its own windows by bisection, and no task waits for
another one.

Windows hold ``length`` tokens, only the last may hold fewer; a window's tokens
of one source stand together.  Rows are numbered within their input partition
and source while they are encoded, and a prefix sum over partitions (not over
rows) places them in the queue, so no source is ever gathered in one task.

A null text is empty and still has its end token.  A null source is a queue of
its own.  A source of weight zero is served when all others have run dry.  The
sources of most tokens have a queue each; beyond ``MOST_QUEUES`` the rarest share
one queue, whose weight is the sum of theirs.  Repeated rows are packed once each.
An empty table has no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm import scratch
from tidemark.llm.bpe import Encoder, default_path
from tidemark.llm.tables import table

LENGTH, END, QUANTUM = 2048, 1, 32
#: Sources with a queue of their own, whose totals go to every task: 16 bytes each.
MOST_QUEUES = 100_000
#: Window borders times queues that a task holds at once.
BORDERS_HELD = 200_000
#: Rows that a task turns into ids or pieces at once.
ROWS_HELD = 256
#: Names of queues: a source's own name, no name, and the rarest sources together.
OWN, NONE, RARE = "s", "n", "r"


@lru_cache(maxsize=2)
def encoder(path: str | None) -> Encoder:
    return Encoder(path or default_path())


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, ROWS_HELD):
            yield b.slice(k, ROWS_HELD)


class Mixture:
    """What each queue has been served at a window's border."""

    def __init__(self, totals: np.ndarray, weights: np.ndarray, length: int, quantum: int):
        if not (np.isfinite(weights).all() and (weights >= 0).all()):
            raise ValueError("weights must be finite and not negative")
        self.totals, self.length, self.quantum = totals.astype(np.int64), length, quantum
        self.total = int(self.totals.sum())
        self.windows = -(-self.total // length)
        idle = weights == 0
        self.weights = np.where(idle, np.maximum(self.totals, 1) / max(1, self.total), weights.astype(float))
        needed = (-(-self.totals // quantum) + 1) * quantum / self.weights
        #: Virtual time at which a queue starts: 0, or for idle ones when the others are empty.
        self.begin = np.where(idle, needed[~idle].max(initial=0), 0.0)
        self.latest = float((self.begin + needed).max(initial=0)) * 2

    def served(self, t: np.ndarray) -> np.ndarray:
        """Tokens of each queue served up to virtual time t; one row for each t."""
        rounds = np.floor(np.maximum(t[:, None] - self.begin[None, :], 0) * (self.weights / self.quantum)[None, :]).astype(np.int64)
        return np.minimum(self.totals[None, :], rounds * self.quantum)

    def border(self, windows: np.ndarray) -> np.ndarray:
        """Tokens of each queue in the windows before each of these; the rows add up to whole windows."""
        want = np.minimum(windows.astype(np.int64) * self.length, self.total)
        lo, hi = np.zeros(len(want)), np.full(len(want), self.latest)
        while True:
            mid = (lo + hi) / 2
            going = (mid > lo) & (mid < hi)
            if not going.any():
                break
            enough = self.served(mid).sum(1) >= want
            hi, lo = np.where(going & enough, mid, hi), np.where(going & ~enough, mid, lo)
        before, after = self.served(lo), self.served(hi)
        before[want == 0], after[want == 0] = 0, 0
        # Queues served at the same moment take what is left in their order.
        rest, steps = want - before.sum(1), after - before
        ahead = np.cumsum(steps, 1) - steps
        return before + np.clip(rest[:, None] - ahead, 0, steps)

    def span(self, queue: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows that can hold the tokens from first to last of a queue, ends included."""

        def around(token, slack):
            t = self.begin[queue] + (token // self.quantum + 1) * self.quantum / self.weights[queue]
            return self.served(t * (1 + slack)).sum(1)

        return np.maximum(around(first, -1e-9) // self.length - 1, 0), np.minimum(around(last, 1e-9) // self.length + 1, self.windows - 1)


def queue_of(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit(OWN), source.cast("string")), F.lit(NONE))


def tokenise(docs: DataFrame, id_col: str, text_col: str, source_col: str, end: int, path: str | None, kept: str = "<u4") -> DataFrame:
    """``doc_id, queue, part, at, n, ids``: tokens as little-endian numbers of type ``kept``, and their place
    among those of the same queue in the same partition."""
    rows = docs.select(F.col(id_col).alias("doc_id"), queue_of(F.col(source_col)).alias("queue"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, tail, wide = TaskContext.get().partitionId(), {}, np.array([end], kept).tobytes(), np.dtype(kept).itemsize
        encode = encoder(path).encode_many
        for b in slices(batches):
            ids, places, sizes = [], [], []
            for q, made in zip(b.column(1).to_pylist(), encode([t or "" for t in b.column(2).to_pylist()], kept)):
                ids.append(made + tail)
                places.append(at.get(q, 0))
                sizes.append(len(made) // wide + 1)
                at[q] = places[-1] + sizes[-1]
            n = pa.array(sizes, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([part] * len(ids), pa.int32()), pa.array(places, pa.int64()), n, pa.array(ids, pa.binary())], names=["doc_id", "queue", "part", "at", "n", "ids"])

    return rows.mapInArrow(run, f"doc_id {kind}, queue string, part int, at long, n long, ids binary")


def place(parts: DataFrame, most: int) -> tuple[DataFrame, list[tuple[str, int]]]:
    """``queue, part, own, base`` (the queue that serves these tokens, and how many it holds before them) for each
    ``queue, part, n``; and the serving queues with their totals, at most ``most`` and one more."""
    totals = scratch.materialise(parts.groupBy("queue").agg(F.sum("n").alias("n")))
    top = totals.orderBy(F.desc("n"), "queue").limit(most).collect()
    rest = totals.agg(F.count("*").alias("k"), F.sum("n").alias("n")).first()
    queues = sorted((r["queue"], r["n"]) for r in top)
    if rest["k"] > len(top):
        queues.append((RARE, rest["n"] - sum(n for _, n in queues)))
        least = (top[-1]["n"], top[-1]["queue"])
        rare = totals.where((F.col("n") < least[0]) | (F.col("n") == least[0]) & (F.col("queue") > least[1])).select("queue", F.lit(RARE).alias("own"))
        parts = parts.join(rare, "queue", "left").withColumn("own", F.coalesce("own", "queue"))
    else:
        parts = parts.withColumn("own", F.col("queue"))
    # Sums over partitions first, then over the sources within one: no task orders more than one of the two.
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    by_part = parts.groupBy("own", "part").agg(F.sum("n").alias("n"))
    by_part = by_part.select("own", "part", before(W.partitionBy("own").orderBy("part")).alias("low"))
    inner = parts.select("queue", "part", "own", before(W.partitionBy("own", "part").orderBy("queue")).alias("high"))
    return scratch.materialise(inner.join(by_part, ["own", "part"]).select("queue", "part", "own", (F.col("low") + F.col("high")).alias("base"))), queues


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: dict[str | None, float] | None = None,
    length: int = LENGTH,
    quantum: int = QUANTUM,
    end: int = END,
    path: str | None = None,
    most_queues: int = MOST_QUEUES,
) -> DataFrame:
    """Pieces of all documents: ``doc_id, source, start, length, doc_tokens, sequence_id, offset, ids``.

    ``weights`` are target token proportions by source; sources that it lacks get
    their share of all tokens, and without it all do.  When a queue runs dry, the
    others go on in proportion.  ``ids`` holds the piece's tokens as uint32.
    """
    # Most vocabularies fit two bytes, which halves what is written and read again.
    kept = "<u2" if max(end, encoder(path).tokenizer.get_vocab_size(with_added_tokens=True)) < 1 << 16 else "<u4"
    tokens = scratch.materialise(tokenise(docs, id_col, text_col, source_col, end, path, kept))
    parts = scratch.materialise(tokens.groupBy("queue", "part").agg(F.sum("n").alias("n")))
    starts, queues = place(parts, most_queues)
    totals = np.array([n for _, n in queues], np.int64)
    share = totals / max(1, totals.sum())
    given = {NONE if k is None else OWN + str(k): float(v) for k, v in (weights or {}).items()}
    shares = [given.get(q, s) for (q, _), s in zip(queues, share)]
    if queues and queues[-1][0] == RARE:
        # Of the rarest sources, those that are given a weight bring theirs instead of their share.
        named = docs.sparkSession.createDataFrame([(q, w) for q, w in given.items()] or [("", 0.0)], "queue string, w double")
        sums = parts.join(starts.where(F.col("own") == RARE).select("queue").distinct(), "queue", "left_semi").join(named, "queue", "left")
        sums = sums.groupBy("queue").agg(F.first("w").alias("w"), F.sum("n").alias("n"))
        shares[-1] = sums.agg(F.sum(F.coalesce("w", F.col("n") / int(totals.sum())))).first()[0]
    mixture = Mixture(totals, np.array(shares, float), length, quantum)
    number = {q: k for k, (q, _) in enumerate(queues)}
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            queue = np.array([number[q] for q in b.column(2).to_pylist()], np.int64)
            n, first = b.column(4).to_numpy(), b.column(3).to_numpy() + b.column(6).to_numpy()
            if len(n):
                yield from pieces(b, queue, first, n)

    def pieces(b: pa.RecordBatch, queue: np.ndarray, first: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        lo, hi = mixture.span(queue, first, first + n - 1)
        held = max(1, BORDERS_HELD // max(1, len(queues)))
        row = np.repeat(np.arange(len(n)), hi - lo + 1)
        window = np.arange(len(row)) - np.repeat(np.cumsum(hi - lo + 1) - (hi - lo + 1), hi - lo + 1) + lo[row]
        # Pieces follow each other in the rows' order and leave nothing out, so all ids in turn are the pieces in turn.
        ids, taken = b.column(5), 0
        offsets = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
        every = np.frombuffer(ids.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(kept)
        for k in range(0, len(row), held):
            d, w = row[k : k + held], window[k : k + held]
            borders, place = np.unique(np.concatenate([w, w + 1]), return_inverse=True)
            at = mixture.border(borders)
            begins, ends, q = at[place[: len(w)]], at[place[len(w) :]], queue[d]
            here = np.arange(len(d))
            a, z = np.maximum(first[d], begins[here, q]), np.minimum(first[d] + n[d], ends[here, q])
            shift = np.cumsum(ends - begins, 1) - (ends - begins)
            offset = shift[here, q] + a - begins[here, q]
            keep = np.flatnonzero(z > a)
            d, w, a, z, offset = d[keep], w[keep], a[keep], z[keep], offset[keep]
            upto = np.concatenate([[0], np.cumsum(z - a)])
            raw = every[taken : taken + upto[-1]].astype("<u4")
            taken += upto[-1]
            made = pa.Array.from_buffers(pa.binary(), len(d), [None, pa.py_buffer((4 * upto).astype(np.int32)), pa.py_buffer(raw)])
            take = pa.array(d)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), *(pa.array(x, pa.int64()) for x in (a - first[d], z - a, n[d], w, offset)), made],
                names=["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )
        assert taken == len(every)

    placed = tokens.join(starts, ["queue", "part"]).select("doc_id", "queue", "own", "at", "n", "ids", "base")
    packed = placed.mapInArrow(run, f"doc_id {kind}, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
    return packed.withColumn("source", F.when(F.col("source") != NONE, F.substr("source", F.lit(len(OWN) + 1))))


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


def op1_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents")))
