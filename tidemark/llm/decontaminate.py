"""Benchmark decontamination by CGK embedding (operator 2).

The CGK random walk turns words into a longer string, such that a small edit
distance becomes a small Hamming distance.  Item-sized windows of a document and
the benchmark items are embedded by the same walks; samples of a few positions
are hashed, and an item and a window that agree in one sample are candidates.
Enough samples are drawn for the target recall, measured for each class of item
lengths on edited copies of the items themselves; where even the most samples miss
it (long items), every window within the bound below is a candidate.  Candidates
are verified by the exact edit distance in words.

A window is embedded only where it can match at all: within ``k`` edits of an
item of ``n`` words, it shares ``n - 2 - 3k`` of its three-word runs, at nearly
the same places.  That bound is exact and loses nothing.

Words are runs of letters and digits, case folded.  An item of n words matches
within ``min(rate * n, (n - q) / q)`` edits, where q is three or the item's words
if fewer; items without words never match.  A null text has no words.  Ties go
to the leftmost window of the fewest edits; repeated documents and items give
their own rows; an empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import table

WORD = re.compile(r"[^\W_]+")
RATE, RECALL, SAMPLED, MOST_SAMPLES, SEED = 0.2, 0.98, 3, 256, 7
#: Lengths of one class differ by this factor at most; edited copies measured in each.
CLASS_FACTOR, TRIALS = 1.25, 100
#: Benchmark words that go to the tasks at a time; a larger benchmark takes several passes.
WORDS_HELD = 1_000_000
#: Tokens of documents that a task remembers; beyond it the memory starts afresh.
TOKENS_HELD = 100_000


def words_of(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def edits_allowed(n: int, rate: float) -> int:
    q = min(3, n)
    return min(int(rate * n + 1e-9), (n - q) // q) if n else 0


def edit_distance(a: list[int], b: list[int], most: int) -> tuple[int, int, int]:
    """Fewest edits that turn ``a`` into a part of ``b``, and that part's ends; ``most + 1`` if more."""
    row = [(0, j) for j in range(len(b) + 1)]  # (edits, start in b)
    for i, x in enumerate(a, 1):
        new = [(i, 0)]
        for j, y in enumerate(b, 1):
            c = row[j - 1] if x == y else (row[j - 1][0] + 1, row[j - 1][1])
            up, left = row[j], new[j - 1]
            if up[0] + 1 < c[0]:
                c = (up[0] + 1, up[1])
            if left[0] + 1 < c[0]:
                c = (left[0] + 1, left[1])
            new.append(c)
        row = new
        if min(row)[0] > most:
            return most + 1, 0, 0
    d, start, end = min((e, s, j) for j, (e, s) in enumerate(row))
    return d, start, end


@dataclass
class Matcher:
    """Benchmark items, ready to be found. Items are (id, words)."""

    items: list[tuple[int, list[str]]]
    rate: float = RATE
    recall: float = RECALL
    seed: int = SEED

    def __post_init__(self):
        self.items = [(i, w) for i, w in self.items if w]
        self.vocabulary: dict[str, int] = {}
        self.known: dict[str, int | tuple[int, ...]] = {}
        for _, ws in self.items:
            for w in ws:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.coded = [[self.vocabulary[w] for w in ws] for _, ws in self.items]
        self.allowed = [edits_allowed(len(c), self.rate) for c in self.coded]
        #: Runs of three words (or all words of a shorter item) -> (item, place).
        self.runs: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for k, c in enumerate(self.coded):
            q = min(3, len(c))
            for o in range(len(c) - q + 1):
                self.runs.setdefault(tuple(c[o : o + q]), []).append((k, o))
        self.short = sorted({len(c) for c in self.coded if len(c) < 3})
        base = np.int64(len(self.vocabulary) + 1)
        self.base = base
        self.keys = np.array(sorted({(r[0] * base + r[1]) * base + r[2] for r in self.runs if len(r) == 3}), np.int64)

    # --- the embedding

    @cached_property
    def walks(self) -> np.ndarray:
        """Random bits of all walks: sample, step, hashed symbol."""
        longest = max((len(c) for c in self.coded), default=1)
        return np.random.default_rng(self.seed).integers(0, 2, (MOST_SAMPLES, 3 * longest, 64), dtype=np.int8)

    @cached_property
    def places(self) -> np.ndarray:
        """Sampled positions, as shares of the walk's length."""
        return np.random.default_rng(self.seed + 1).random((MOST_SAMPLES, SAMPLED))

    def embedded(self, words: list[int], n: int, samples: int) -> np.ndarray:
        """What the walks of an ``n``-word item's length read at their sampled positions: sample x position."""
        x = np.array([*words[:n], *[0] * max(0, n - len(words)), 0], np.int64)
        bits = (x * 2654435761 >> 7) & 63
        at, seen = np.zeros(samples, np.int64), np.empty((3 * n, samples), np.int64)
        rows = np.arange(samples)
        for j in range(3 * n):
            seen[j] = x[at]
            at = np.minimum(at + self.walks[rows, j, bits[at]], n)
        # Words stand in the first part of the walk; later steps are often past the end.
        where = (self.places[:samples] * (2 * n)).astype(np.int64)
        return seen[where, rows[:, None]]

    def edited(self, k: int, rng: np.random.Generator) -> list[int]:
        """A copy of item ``k`` with all edits allowed."""
        c = list(self.coded[k])
        for _ in range(self.allowed[k]):
            p, kind = int(rng.integers(0, len(c))), int(rng.integers(0, 3))
            if kind == 0:
                c[p] = -int(rng.integers(1, 1 << 30))
            elif kind == 1:
                c.insert(p, -int(rng.integers(1, 1 << 30)))
            elif len(c) > 1:
                del c[p]
        return c

    @cached_property
    def samples(self) -> dict[int, int | None]:
        """By item length: samples for the target recall, measured on edited copies; none if no number allowed reaches it."""
        rng = np.random.default_rng(self.seed + 2)
        out: dict[int, int | None] = {}
        by: dict[int, list[int]] = {}
        for k, c in enumerate(self.coded):
            by.setdefault(len(c), []).append(k)
        lengths, beyond, least = sorted(by), False, 0
        while lengths:
            own = [n for n in lengths if n <= lengths[0] * CLASS_FACTOR]
            lengths = lengths[len(own) :]
            # The longest of a class need the most samples, and longer items no fewer.
            worst = [k for k in by[own[-1]] if self.allowed[k]]
            hits: list[int] = []
            missed = 0
            while worst and not beyond and len(hits) < TRIALS:
                k = worst[len(hits) % len(worst)]
                n = len(self.coded[k])
                agree = (self.embedded(self.edited(k, rng), n, MOST_SAMPLES) == self.embedded(self.coded[k], n, MOST_SAMPLES)).all(1)
                hits.append(int(agree.argmax()) + 1 if agree.any() else MOST_SAMPLES * 2)
                missed += not agree.any()
                beyond = missed > (1 - self.recall) * TRIALS
            need = None if beyond else max(8, least, int(np.quantile(hits, self.recall, method="higher"))) if hits else 1
            if need is not None and need > MOST_SAMPLES:
                beyond, need = True, None
            least = need or 0
            out |= dict.fromkeys(own, need)
        return out

    @cached_property
    def tables(self) -> dict[int, dict[tuple, set[int]]]:
        """By item length: (sample, symbols) -> items."""
        out: dict[int, dict[tuple, set[int]]] = {}
        for k, c in enumerate(self.coded):
            if self.samples[len(c)] is None:
                continue
            got = out.setdefault(len(c), {})
            for s, symbols in enumerate(self.embedded(c, len(c), self.samples[len(c)]).tolist()):
                got.setdefault((s, *symbols), set()).add(k)
        return out

    # --- documents

    def codes(self, text: str) -> np.ndarray:
        """The numbers of the text's words, zero for words that no item has."""
        tokens = text.split()
        known = self.known
        got = list(map(known.get, tokens))
        if None in got:
            if len(known) > TOKENS_HELD:
                known.clear()
            for k, g in enumerate(got):
                if g is None:
                    made = tuple(self.vocabulary.get(w, 0) for w in words_of(tokens[k]))
                    got[k] = made[0] if len(made) == 1 else made
                    if len(tokens[k]) <= 64:
                        known[tokens[k]] = got[k]
        if any(type(g) is tuple for g in set(got)):
            got = [x for g in got for x in (g if type(g) is tuple else (g,))]
        return np.array(got, np.int64)

    def anchors(self, coded: np.ndarray) -> dict[tuple[int, int], set[int]]:
        """(item, window start) -> places of the item's runs that stand where that window has them."""
        found: dict[tuple[int, int], set[int]] = {}
        if len(coded) >= 3 and len(self.keys):
            a, b, c = coded[:-2], coded[1:-1], coded[2:]
            at = np.flatnonzero((a > 0) & (b > 0) & (c > 0))
            key = (a[at] * self.base + b[at]) * self.base + c[at]
            at = at[self.keys[np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)] == key]
            for p in at.tolist():
                for k, o in self.runs[int(coded[p]), int(coded[p + 1]), int(coded[p + 2])]:
                    found.setdefault((k, p - o), set()).add(o)
        for q in self.short:
            for p in range(len(coded) - q + 1):
                for k, o in self.runs.get(tuple(coded[p : p + q].tolist()), ()):
                    if len(self.coded[k]) == q:
                        found.setdefault((k, p - o), set()).add(o)
        return found

    def windows(self, coded: np.ndarray) -> list[tuple[int, int]]:
        """(item, start) of windows that share enough runs with the item within its edits."""
        by: dict[int, list[tuple[int, set[int]]]] = {}
        for (k, start), places in sorted(self.anchors(coded).items()):
            by.setdefault(k, []).append((start, places))
        out = []
        for k, starts in by.items():
            n, m = len(self.coded[k]), self.allowed[k]
            q = min(3, n)
            need = max(1, n - q + 1 - q * m)
            for i, (start, _) in enumerate(starts):
                near: set[int] = set()
                j = i
                while j < len(starts) and starts[j][0] - start <= 2 * m:
                    near |= starts[j][1]
                    j += 1
                if len(near) >= need:
                    out += [(k, s) for s, _ in starts[i:j]]
        return sorted(set(out))

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """``item_id, start, end, edits``: spans in characters, one for each item found."""
        coded = self.codes(text) if self.items else []
        if not len(coded):
            return []
        best: dict[int, tuple[int, int, int]] = {}
        reads: dict[tuple[int, int], set[int]] = {}
        whole: dict[int, list[list[int]]] = {}
        for k, start in self.windows(coded):
            n, m = len(self.coded[k]), self.allowed[k]
            if k in best and best[k][0] == 0 and best[k][1] <= max(0, start - 2 * m):
                continue  # windows come by their starts: none is better than an exact copy before it
            if self.samples[n] is None:  # all windows are verified, close ones together
                near = whole.setdefault(k, [])
                if near and start - near[-1][0] <= 2 * m:
                    near[-1][1] = start
                else:
                    near.append([start, start])
                continue
            at = (max(0, start), n)
            if at not in reads:
                # Words that no item has must differ from the padding and from each other's items.
                window = [int(w) or -1 for w in coded[at[0] : at[0] + n]]
                got = self.tables[n]
                reads[at] = set().union(*(got.get((s, *symbols), ()) for s, symbols in enumerate(self.embedded(window, n, self.samples[n]).tolist())))
            if k not in reads[at]:
                continue
            lo = max(0, start - 2 * m)
            d, a, z = edit_distance(self.coded[k], coded[lo : start + n + 2 * m].tolist(), m)
            if d <= m and z > a and (k not in best or (d, lo + a) < best[k][:2]):
                best[k] = d, lo + a, lo + z
        for k, near in whole.items():
            n, m = len(self.coded[k]), self.allowed[k]
            for start, last in near:
                lo = max(0, start - 2 * m)
                d, a, z = edit_distance(self.coded[k], coded[lo : last + n + 2 * m].tolist(), m)
                if d <= m and z > a and (k not in best or (d, lo + a) < best[k][:2]):
                    best[k] = d, lo + a, lo + z
        if not best:
            return []
        spans = [m.span() for m in WORD.finditer(text)]
        return sorted((self.items[k][0], spans[a][0], spans[z - 1][1], d) for k, (d, a, z) in best.items())


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", rate: float = RATE, recall: float = RECALL) -> DataFrame:
    """``id_col, item_col, start, end, edits``: each benchmark item that a document holds, with its span."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).alias("item"), F.coalesce(item_text_col, F.lit("")).alias("text"))
    chars = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    passes = 1 + chars // (4 * WORDS_HELD)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind, item_kind = rows.schema["id"].dataType.simpleString(), items.schema["item"].dataType.simpleString()
    found = None
    for k in range(passes):
        # One slice of the benchmark, of a few million characters, goes to the tasks.
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == k)
        matcher = Matcher(sorted(((r["item"], words_of(r["text"])) for r in part.collect()), key=str), rate, recall)
        matcher.samples if matcher.items else None  # measured once, here

        def run(batches: Iterator[pa.RecordBatch], m: Matcher = matcher) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out: list[tuple] = []
                for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                    out += [(i, *x) for x in m.matches(t.as_py() or "")]
                cols = list(zip(*out)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], schema=pa.schema(list(zip(names, types))))

        from pyspark.sql.pandas.types import to_arrow_type

        names = ["id", "item", "start", "end", "edits"]
        types = [to_arrow_type(rows.schema["id"].dataType), to_arrow_type(items.schema["item"].dataType), pa.int32(), pa.int32(), pa.int32()]
        got = rows.mapInArrow(run, f"id {kind}, item {item_kind}, start int, end int, edits int")
        found = got if found is None else found.unionByName(got)
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "start", "end", "edits")


def op2_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
