"""SimHash near-duplicates by the generalised pigeonhole principle (operator 5).

Fingerprints that differ in few bits are found exactly.  The bits are put into
groups of correlated bits.  With thresholds t_1..t_m over the groups that add up
to ``distance - m + 1``, two fingerprints within ``distance`` differ by at most
t_i bits in some group i (t_i = -1 leaves a group out).  The thresholds are
chosen by dynamic programming on estimated candidate counts, fingerprints are
probed in the Hamming ball of each group's threshold, and candidates verified.

Equal fingerprints are one node throughout.  Before probing, each bucket's
members are compared with the bucket's smallest and largest fingerprint alone
and what that links is contracted; the probes then verify only pairs from
different components.  Where many members of a bucket are of one component, its
own probes meet the bucket's other members only, so a large group of copies is
never expanded into pairs, and the rows of a component that holds a large share
of all never gather in one task.

Spark's size estimates don't count what an explode adds, so tables of buckets and
probes are never left to be broadcast: their joins are merges, and the driver holds
no row for each fingerprint.

A null text is empty; a text without words has fingerprint zero, which links
like any other.  Repeated rows and ids keep a row each; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import scratch
from tidemark.llm.components import apart, connected_components, join_hot
from tidemark.llm.tables import table

WIDTH, DISTANCE, BITS, SEED = 4, 4, 64, 42
#: What verifying a candidate weighs against shuffling a probe. Above one, as buckets
#: are uneven and the estimate is a mean.
CANDIDATE_WEIGHT = 2.0
#: Members of one component from which on a bucket is crowded.
CROWD = 16


def shingles(text: str, width: int = WIDTH) -> list[bytes]:
    """Runs of ``width`` words, lower-cased in A-Z only, words parted by ASCII white space."""
    words = text.encode("utf-8", "replace").lower().split()
    if len(words) < width:
        return [b" ".join(words)] if words else []
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = (ends - [len(w) for w in words]).tolist()
    return [whole[a:z] for a, z in zip(starts, ends[width - 1 :].tolist())]


def fingerprint(text: str, width: int = WIDTH, seed: int = SEED) -> int:
    """Majority of each bit over the shingles' XXH64, as an unsigned number."""
    import xxhash

    digest = xxhash.xxh64_digest
    parts = shingles(text, width)
    if not parts:
        return 0
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(parts), 1 << 16):
        raw = b"".join([digest(p, seed) for p in parts[k : k + (1 << 16)]])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(parts)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``id, fp``: the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = np.array([fingerprint(t.as_py() or "", width) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made.view(np.int64))], names=["id", "fp"])

    return rows.mapInArrow(run, f"id {kind}, fp long")


# --- the plan: groups of bits and their thresholds ---------------------------------------------


def co_occurrence(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and how often each two bits are set together, over all fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            raw = b.column(0).to_numpy(zero_copy_only=False).astype(">i8").view(np.uint8).reshape(-1, 8)
            for k in range(0, len(raw), 1 << 16):
                x = np.unpackbits(raw[k : k + (1 << 16)], axis=1)[:, ::-1].astype(np.float64)
                both += x.T @ x
            n += len(raw)
        cells = np.append(both.astype(np.int64).ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"])

    got = fps.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(BITS * BITS + 1, np.int64)
    for r in got:
        cells[r["cell"]] = r["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def bit_groups(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """``m`` groups of nearly equal size, each grown from its most correlated free bits."""
    p = np.diag(both) / max(1, n)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    tied = np.abs(both / max(1, n) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(tied, 0)
    free, groups = set(range(BITS)), []
    for g in range(m):
        want = BITS // m + (g < BITS % m)
        left = sorted(free)
        group = [max(left, key=lambda b: (tied[b, left].sum(), -b))]
        free.remove(group[0])
        while len(group) < want:
            best = max(sorted(free), key=lambda b: (tied[b, group].mean(), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def differing(n: int, both: np.ndarray, group: list[int], most: int) -> list[float]:
    """Estimated share of fingerprints within 0, 1, .. ``most`` bits of one in this group."""
    p = np.diag(both)[group] / max(1, n)
    by = np.zeros(most + 2)
    by[0] = 1
    for q in 2 * p * (1 - p):
        by[1:] = by[1:] * (1 - q) + by[:-1] * q
        by[0] *= 1 - q
    return np.cumsum(by)[: most + 1].tolist()


def plan(n: int, both: np.ndarray, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """Groups with their thresholds, of the least estimated cost over all numbers of groups."""
    best: tuple[float, list] = (float("inf"), [])
    for m in range(2, distance + 2):
        groups = bit_groups(n, both, m)
        total = distance - m + 1
        cost = []
        for g in groups:
            share = differing(n, both, g, distance)
            cost.append([0.0] + [sum(comb(len(g), k) for k in range(t + 1)) + CANDIDATE_WEIGHT * n * share[t] for t in range(distance + 1)])
        # state: sum of (threshold + 1) so far -> (cost, thresholds)
        states: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for c in cost:
            nxt: dict[int, tuple[float, list[int]]] = {}
            for s, (x, ts) in states.items():
                for t in range(-1, distance + 1):
                    k = s + t + 1
                    if k <= total + m and (k not in nxt or x + c[t + 1] < nxt[k][0]):
                        nxt[k] = (x + c[t + 1], [*ts, t])
            states = nxt
        x, ts = states[total + m]
        if x < best[0]:
            best = x, list(zip(groups, ts))
    return [(g, t) for g, t in best[1] if t >= 0]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def buckets(fp: str, groups: list[tuple[list[int], int]], ball: bool) -> F.Column:
    """Keys of a fingerprint: its bits in each group, or those of the whole ball around it."""
    keys = []
    for number, (g, t) in enumerate(groups):
        flips = [sum(1 << b for b in c) for k in range((t if ball else 0) + 1) for c in combinations(g, k)]
        own = F.col(fp).bitwiseAND(F.lit(signed(sum(1 << b for b in g))))
        keys.append(_keys(F.lit(number), own, F.array(*(F.lit(signed(x)).cast("long") for x in flips))))
    return F.explode(F.concat(*keys))


def _keys(number: F.Column, own: F.Column, flips: F.Column) -> F.Column:
    return F.transform(flips, lambda x: F.struct(number.alias("g"), own.bitwiseXOR(x).alias("key")))


def near(a: str, b: str, distance: int) -> F.Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def link_fingerprints(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``fp, component`` for every distinct ``fp``; components are named by one of their fingerprints."""
    n, both = co_occurrence(fps)
    if not n:
        return fps.select("fp", F.col("fp").alias("component"))
    groups = plan(n, both, distance)
    own = fps.select("fp", buckets("fp", groups, ball=False).alias("k")).select("fp", "k.g", "k.key")
    ends = own.groupBy("g", "key").agg(F.min("fp").alias("first"), F.max("fp").alias("last")).where("first <> last")
    stars = own.join(ends.hint("merge"), ["g", "key"]).select("fp", F.explode(F.array("first", "last")).alias("other"))
    stars = stars.where((F.col("fp") != F.col("other")) & near("fp", "other", distance))
    first = connected_components(stars, "fp", "other")
    known = scratch.materialise(fps.join(apart(first, n), fps["fp"] == first["node"], "left").select("fp", F.coalesce("component", "fp").alias("component")))
    index = known.select("fp", "component", buckets("fp", groups, ball=False).alias("k")).select("k.g", "k.key", F.col("fp").alias("y"), F.col("component").alias("cy"))
    probe = known.select("fp", "component", buckets("fp", groups, ball=True).alias("k")).select("k.g", "k.key", F.col("fp").alias("x"), F.col("component").alias("cx"))
    crowds = index.groupBy("g", "key", "cy").agg(F.count("*").alias("n")).where(F.col("n") >= CROWD)
    crowds = scratch.materialise(crowds.groupBy("g", "key").agg(F.max_by("cy", "n").alias("crowd")))
    n_crowds = crowds.count()
    # Side 1: probes of the crowd's component, and members of others; side 0: other probes, and all members.
    probe = probe.join(apart(crowds, n_crowds), ["g", "key"], "left").withColumn("side", F.coalesce((F.col("cx") == F.col("crowd")).cast("int"), F.lit(0)))
    sides = F.when(F.col("cy") != F.col("crowd"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    index = index.join(apart(crowds, n_crowds), ["g", "key"], "left").withColumn("side", F.explode(sides))
    same = (probe["g"] == index["g"]) & (probe["key"] == index["key"]) & (probe["side"] == index["side"])
    found = probe.join(index.hint("merge"), same & (F.col("x") < F.col("y")) & (F.col("cx") != F.col("cy")) & near("x", "y", distance))
    merged = connected_components(found, "cx", "cy").select(F.col("node").alias("component"), F.col("component").alias("above"))
    return join_hot(known, merged, "component", "left").select("fp", F.coalesce("above", "component").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, width: int = WIDTH) -> DataFrame:
    """``id_col, fp, component_id`` of every row: the smallest id reachable over linked fingerprints."""
    marks = scratch.materialise(fingerprints(docs, id_col, text_col, width))
    distinct = scratch.materialise(marks.groupBy("fp").agg(F.min("id").alias("least")))
    n = distinct.count()
    linked = scratch.materialise(distinct.join(apart(link_fingerprints(distinct.select("fp"), distance), n), "fp"))
    names = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = scratch.materialise(join_hot(linked, names, "component").select("fp", "component_id"))
    return marks.join(apart(named, n), "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
