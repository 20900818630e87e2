"""Substring deduplication by sliding sentence spans (operator 4).

From every sentence a run of consecutive sentences is grown until it has ``width``
sentences and ``least_words`` words; a sentence of ``alone`` words is a run by itself
too.  All runs are hashed and joined over the whole corpus, and a sentence goes if any
run that covers it occurs earlier: in a document of smaller id, or earlier in the same
one.  What remains is the text without those sentences, character for character.

A sentence ends with a run of full stops, exclamation or question marks, commas,
colons, semicolons or line ends, and the white space after it: clauses count, since a
passage of some fifty words that begins and ends anywhere may not hold two whole longer
sentences.  Runs are compared after white space is made single blanks.  Hashes have 128
bits.  A repeated passage without two such ends, in a longer text, is not found.

Texts are cut and hashed once: the runs are written as a scratch table, which is
aggregated by hash and then joined with the few hashes that occur in more documents.

A null text stays null and has no sentences; a document without a run stays whole.
Rows of the same id count as one document: they don't remove each other's sentences,
and what goes from one goes from all.  Rows with a null id stay as they are.  Columns
``n_sentences`` and ``n_removed`` of the input are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import scratch
from tidemark.llm.tables import table, unused

WIDTH, LEAST_WORDS, ALONE = 2, 18, 18
SENTENCE = r"[^.!?,:;\n]*[.!?,:;\n]+\s*|[^.!?,:;\n]+"
BLANKS = r"\s+"
#: Runs that a task holds before it passes them on.
RUNS_HELD = 50_000
_CUT = re.compile(SENTENCE, re.ASCII)
#: White space of the pattern; other blanks are ordinary characters.
_WORDS = re.compile(r"[^\t\n\x0b\f\r ]+")


def spans(text: str, width: int = WIDTH, least_words: int = LEAST_WORDS, alone: int = ALONE) -> Iterator[tuple[int, int, str]]:
    """First sentence, sentences and text of each run."""
    words = [_WORDS.findall(s) for s in _CUT.findall(text)]
    sizes, parts, n = [len(w) for w in words], [" ".join(w) for w in words], len(words)
    z = held = 0
    for a in range(n):
        # The run from a never ends before the run from a - 1 does, so each sentence is added once.
        while z < n and (z - a < width or held < least_words):
            held += sizes[z]
            z += 1
        if z - a >= width and held >= least_words:
            yield a, z - a, " ".join(parts[a:z])
        if sizes[a] >= alone:
            yield a, 1, parts[a]
        held -= sizes[a]


def runs(docs: DataFrame, id_col: str, text_col: str, width: int, least_words: int, alone: int) -> DataFrame:
    """``h1, h2, id, at, size, again``: hashes and places of all runs, and whether the text has the same run earlier."""
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> pa.RecordBatch:
            h = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            take = ids.take(pa.array(np.repeat(np.array(row, np.int64), counts)))
            cols = [pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), take, pa.array(at, pa.int32()), pa.array(sizes, pa.int32()), pa.array(again, pa.bool_())]
            return pa.RecordBatch.from_arrays(cols, names=["h1", "h2", "id", "at", "size", "again"])

        digest = xxhash.xxh3_128_digest
        for b in batches:
            ids = b.column(0)
            hashes, at, sizes, again, row, counts = [], [], [], [], [], []
            for k, text in enumerate(b.column(1)):
                seen, before = set(), len(at)
                for a, m, t in spans(text.as_py(), width, least_words, alone):
                    h = digest(t)
                    hashes.append(h)
                    at.append(a)
                    sizes.append(m)
                    again.append(h in seen)
                    seen.add(h)
                row.append(k)
                counts.append(len(at) - before)
                if len(at) >= RUNS_HELD:
                    yield made()
                    hashes, at, sizes, again, row, counts = [], [], [], [], [], []
            yield made()

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"h1 long, h2 long, id {kind}, at int, size int, again boolean")


def repeated_sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, least_words: int = LEAST_WORDS, alone: int = ALONE) -> DataFrame:
    """``id, gone``: places (from 0) of the sentences that a non-first run covers."""
    found = scratch.materialise(runs(docs, id_col, text_col, width, least_words, alone))
    own = found.where("not again")
    # Of numbers two plain minima and a maximum tell what a count of distinct ids would.
    ends = own.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last")
    shared = scratch.materialise(ends.select("h1", "h2", "first"))
    later = own.join(shared, ["h1", "h2"]).where("id <> first").select("id", "at", "size")
    later = later.union(found.where("again").select("id", "at", "size"))
    # Places of one document: bounded by its own length, deduplicated on the map side.
    covered = F.flatten(F.transform(F.collect_set(F.struct("at", "size")), lambda r: F.sequence(r["at"], r["at"] + r["size"] - 1)))
    return later.groupBy("id").agg(F.array_distinct(covered).alias("gone"))


@F.udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("n", T.LongType())]), useArrow=True)
def _cut_text(text: str | None, gone: list[int] | None):
    if text is None:
        return None, 0
    cut = _CUT.findall(text)
    if not gone:
        return None, len(cut)
    lost = set(gone)
    return "".join(s for k, s in enumerate(cut) if k not in lost), len(cut)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, least_words: int = LEAST_WORDS, alone: int = ALONE) -> DataFrame:
    """All columns of ``docs`` with the text cut, and ``n_sentences``, ``n_removed``."""
    key, gone, made = unused(docs.columns, "id", "gone", "made")
    found = repeated_sentences(docs, id_col, text_col, width, least_words, alone).select(F.col("id").alias(key), F.col("gone").alias(gone))
    joined = docs.join(found, docs[id_col] == F.col(key), "left").withColumn(made, _cut_text(F.col(text_col), F.col(gone)))
    out = {
        text_col: F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(F.col(f"{made}.text")),
        "n_sentences": F.col(f"{made}.n"),
        "n_removed": F.coalesce(F.size(gone), F.lit(0)).cast("long"),
    }
    return joined.select(*(c for c in docs.columns if c not in out), *(v.alias(k) for k, v in out.items()))


def op4_sentence_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_sentences", "n_removed", "text")


ORACLE = rf"""
WITH c AS (SELECT doc_id, text, regexp_extract_all(text, '{SENTENCE}') AS s FROM documents),
w AS (SELECT doc_id, list_transform(s, lambda x: trim(regexp_replace(x, '{BLANKS}', ' ', 'g'))) AS p FROM c WHERE doc_id IS NOT NULL),
n AS (SELECT doc_id, p, list_transform(p, lambda x: CASE WHEN x = '' THEN 0 ELSE len(string_split(x, ' ')) END) AS k FROM w),
a AS (SELECT doc_id, p, k, unnest(range(1, len(p) + 1)) AS pos FROM n),
e AS (SELECT doc_id, p, pos, k[pos] AS own,
    list_filter(range(pos + {WIDTH - 1}, least(len(p), pos + {WIDTH + LEAST_WORDS}) + 1), lambda z: list_sum(k[pos:z]) >= {LEAST_WORDS})[1] AS z FROM a),
r AS (SELECT doc_id, pos, z, array_to_string(p[pos:z], ' ') AS t FROM e WHERE z IS NOT NULL
    UNION ALL SELECT doc_id, pos, pos, p[pos] FROM e WHERE own >= {ALONE}),
q AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, pos, z) AS nth FROM r),
g AS (SELECT DISTINCT doc_id, unnest(range(pos, z + 1)) AS pos FROM q WHERE nth > 1),
l AS (SELECT doc_id, list(pos) AS gone FROM g GROUP BY doc_id)
SELECT doc_id, coalesce(len(s), 0)::BIGINT AS n_sentences, coalesce(len(gone), 0)::BIGINT AS n_removed,
    CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_transform(list_filter(range(1, len(s) + 1), lambda i: NOT list_contains(gone, i)), lambda i: s[i]), '') END AS text
FROM c LEFT JOIN l USING (doc_id)
"""
