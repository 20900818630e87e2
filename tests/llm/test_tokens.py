import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import packing
from tidemark.llm.bpe import Encoder, PrefixCounter, default_path
from tidemark.llm.token_counts import count_tokens, longest_prefix, prefix_table, tokens_of_prefix

PARTS = ["a", "the", " ", "  ", "\n", "\n ", "'ll", "'", "'s", "don", "é", "ñ", "日", "!!", "%%%", "12", "<|endoftext|>", "<|end", "\t", "　", "😀", "X", "ing", "-", "\r\n", "ſ", " of", " was"]


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_counts_and_ids_are_the_librarys(library):
    counter, encoder = PrefixCounter(default_path()), Encoder(default_path())
    for t in texts(400):
        want = library.encode(t, add_special_tokens=False).ids
        assert counter.count(t) == len(want), t
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == want, t


def test_every_prefix(library):
    counter = PrefixCounter(default_path())
    for t in texts(150, 2):
        want = [len(library.encode(t[:j], add_special_tokens=False).ids) for j in range(len(t) + 1)]
        assert counter.prefix_counts(t).tolist() == want, t


def test_long_pieces_take_linear_time(library):
    t = "ab" * 5000 + " " * 3000
    assert PrefixCounter(default_path()).count(t) == len(library.encode(t, add_special_tokens=False).ids)


SHAPE = "doc_id long, text string, source string, id string, ids int"


def docs(spark, n=60):
    made = texts(n, 3)
    rows = [(k, t * (1 + k % 5), f"s{min(k % 7, 3)}", "x", 1) for k, t in enumerate(made)]
    rows += [(1000, None, None, "x", 1), (1001, "", "s0", "x", 1), (1001, "", "s0", "x", 1), (1002, "word " * 9000, "s1", "x", 1)]
    return spark.createDataFrame(rows, SHAPE).repartition(3, "doc_id")


def test_count_tokens(spark, library):
    df = docs(spark)
    want = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    got = count_tokens(df).collect()
    assert len(got) == df.count()
    for r in got:
        n = len(library.encode(want[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(want[r["doc_id"]].encode()), n, n > 512)
    assert count_tokens(df.limit(0)).count() == 0


def test_budget_questions(spark, library):
    df = spark.createDataFrame([(1, "the cat's tail, don't"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in prefix_table(df).select("doc_id", longest_prefix(4).alias("l"), tokens_of_prefix(7).alias("t"), tokens_of_prefix(999).alias("all")).collect()}
    t = "the cat's tail, don't"
    counts = [len(library.encode(t[:j], add_special_tokens=False).ids) for j in range(len(t) + 1)]
    assert got[1]["l"] == max(j for j, c in enumerate(counts) if c <= 4)
    assert got[1]["t"] == counts[7] and got[1]["all"] == counts[-1]
    assert (got[2]["l"], got[2]["t"]) == (0, 0)


@pytest.mark.parametrize("weights", [None, {"s0": 0.7, "s1": 0.1, None: 0.1}])
def test_packing_round_trip(spark, library, weights):
    df = docs(spark)
    pieces = packing.pack(df, weights=weights, length=128, quantum=8).persist()
    held = pieces.collect()
    want = sorted(tuple([*library.encode(r["text"] or "", add_special_tokens=False).ids, 1]) for r in df.collect())
    by_doc, by_seq = {}, {}
    for p in held:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"] > 0
        by_doc.setdefault((p["doc_id"]), []).append((p["start"], ids, p["doc_tokens"]))
        by_seq.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    made = []
    for k, parts in by_doc.items():
        if k == 1001:  # two equal rows of one id
            assert parts == [(0, [1], 1)] * 2
            made += [(1,), (1,)]
            continue
        parts.sort()
        at = 0
        for start, ids, n in parts:
            assert start == at
            at += len(ids)
        assert at == parts[0][2]
        made.append(tuple(x for _, ids, _ in parts for x in ids))
    assert sorted(made) == want
    sizes = []
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        sizes.append(at)
    assert sorted(sizes)[1:] == [128] * (len(sizes) - 1) and sorted(by_seq) == list(range(len(by_seq)))
    digest = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in packing.digest(pieces).collect()}
    assert all(digest[p["doc_id"], p["start"]] == zlib.crc32(p["ids"]) for p in held if p["doc_id"] != 1001)


def test_windows_hold_the_mixture(spark):
    rows = [(k, "word and word " * 40, "big" if k % 4 else "small") for k in range(200)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), length=512, quantum=16)
    share = pieces.groupBy("sequence_id").agg(F.sum(F.when(F.col("source") == "small", F.col("length")).otherwise(0)).alias("n"), F.sum("length").alias("all")).where("all = 512").collect()
    assert len(share) > 20 and all(abs(r["n"] / 512 - 0.25) < 0.07 for r in share)


def test_borders_agree_with_a_serial_round_robin():
    totals, quantum, length = np.array([100, 37, 5]), 4, 32
    m = packing.Mixture(totals, totals / totals.sum(), length, quantum)
    at = m.border(np.arange(m.windows + 1))
    assert (np.diff(at, axis=0) >= 0).all() and at[-1].tolist() == totals.tolist() and (at.sum(1)[:-1] == length * np.arange(m.windows)).all()
    # Serially: the queue whose next quantum is due first goes next.
    served, order = np.zeros(3, int), []
    while (served < totals).any():
        due = [((served[q] // quantum + 1) * quantum / (totals[q] / totals.sum()), q) if served[q] < totals[q] else (np.inf, q) for q in range(3)]
        q = min(due)[1]
        n = min(quantum, totals[q] - served[q])
        order += [q] * n
        served[q] += n
    for w in range(m.windows):
        assert np.bincount(order[: w * length], minlength=3).tolist() == at[w].tolist()


def serve(df, **options):
    """Tokens of each source by window."""
    got = packing.pack(df, **options).groupBy("sequence_id", "source").agg(F.sum("length").alias("n")).collect()
    return {(r["sequence_id"], r["source"]): r["n"] for r in got}


def test_sources_without_weight_come_last(spark):
    rows = [(k, "word and word " * 40, ("a", "b", None)[k % 3]) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    whole = packing.pack(df, length=256).agg(F.sum("length")).first()[0]
    got = serve(df, weights={"a": 1, "b": 0, None: 3}, length=256)
    assert sum(got.values()) == whole
    assert min(w for w, s in got if s == "b") >= max(w for w, s in got if s != "b")
    assert sum(serve(df, weights={"a": 0, "b": 0, None: 0}, length=256).values()) == whole
    with pytest.raises(ValueError):
        packing.pack(df, weights={"a": -1})


def test_rare_sources_share_a_queue(spark):
    rows = [(k, "word and word " * 40, "big" if k % 2 else ("\x00" if k % 10 else f"s{k}")) for k in range(200)] + [(900, "none", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    pieces = packing.pack(df, length=512, most_queues=2, weights={"s0": 0.5}).collect()
    total, windows = {}, {}
    for p in pieces:
        total.setdefault((p["doc_id"], p["source"], p["doc_tokens"]), []).append((p["start"], p["length"]))
        windows.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert {(d, s) for d, s, _ in total} == {(r[0], r[2]) for r in rows}
    for runs, whole in [(v, k[2]) for k, v in total.items()] + [(v, None) for v in windows.values()]:
        at = 0
        for start, n in sorted(runs):
            assert start == at
            at += n
        assert whole in (None, at)


def test_no_documents(spark):
    assert packing.pack(docs(spark).limit(0)).count() == 0
