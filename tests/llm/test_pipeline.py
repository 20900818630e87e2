import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import components, decontaminate, simhash
from tidemark.llm.quality import learn, scorer


@pytest.fixture(scope="module")
def stages(spark, sf):
    """What each stage returns, written as the pipeline does."""
    from tidemark.llm import scratch
    from tidemark.llm.tables import table

    out, docs = [], table(spark, sf, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = scratch.materialise(stage(spark, docs, sf))
        out.append(docs)
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_pipeline_against_brute_force(spark, sf, stages):
    from test_text import spans_by_hand

    from tidemark.llm.tables import table

    raw = table(spark, sf, "documents")
    docs = texts(raw)
    # Quality
    score = scorer(learn(raw, table(spark, sf, "labels")))
    docs = {k: t for k, t in docs.items() if score(t) >= 0.5}
    assert texts(stages[0]) == docs
    # Near duplicates
    fp = {k: simhash.fingerprint(t or "") for k, t in docs.items()}
    ids = sorted(fp)
    up = {k: k for k in ids}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fp[a] ^ fp[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    docs = {k: t for k, t in docs.items() if find(k) == k}
    assert texts(stages[1]) == docs
    # Benchmark
    items = [(r["item_id"], decontaminate.words_of(r["text"])) for r in table(spark, sf, "benchmark").collect()]
    exact = {k for k, t in docs.items() if any(" ".join(w) in " ".join(decontaminate.words_of(t)) for _, w in items)}
    kept = texts(stages[2])
    assert not exact & kept.keys()
    docs = {k: t for k, t in docs.items() if k in kept}
    # Secrets
    after = texts(stages[3])
    assert after.keys() == docs.keys()
    for k, t in docs.items():
        assert after[k] == t if not spans_by_hand(t) else "[REDACTED]" in after[k]
        assert not spans_by_hand(after[k])
    assert all(r["n_chars"] == len(r["text"]) for r in stages[3].collect())
    # Packing
    pieces = stages[4].collect()
    assert {p["doc_id"] for p in pieces} == after.keys()
    total = {}
    for p in pieces:
        total[p["doc_id"]] = total.get(p["doc_id"], 0) + p["length"]
    assert all(total[p["doc_id"]] == p["doc_tokens"] for p in pieces)
    sizes = np.bincount([p["sequence_id"] for p in pieces], [p["length"] for p in pieces])
    assert (np.sort(sizes)[1:] == 2048).all()


def test_stages_keep_the_columns(spark, sf, stages):
    for df in stages[:-1]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["drop_low_quality", "drop_near_duplicates", "drop_benchmark_leaks", "redact_secrets", "pack_sequences"]


def test_stages_take_odd_rows(spark, sf):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "token = abcdefghijklmnop", "en", "s", 24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, sf).count() >= 2
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0


def test_stages_with_clashing_names_ties_and_long_texts(spark, sf):
    leak = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first()["text"]
    secret = "token = abcdefghijklmnop"
    long = " ".join(f"word{k}" for k in range(60_000))
    rows = [(1, long + " " + secret, "x"), (2, "other words " + leak, "x"), (3, secret, "x"), (3, secret, "x"), (None, secret, "x"), (4, None, "x"), (5, long + " " + secret + "s", "x")]
    rows = [(i, t, "en", "s", len(t or ""), a, a, a, a) for i, t, a in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, path string, _findings string, blob string, component_id string")
    near = corpus_pipeline.drop_near_duplicates(spark, docs, sf)
    assert sorted((r["doc_id"] or 0) for r in near.collect()) == [0, 1, 2, 3, 3, 4] and near.columns == docs.columns
    clean = corpus_pipeline.drop_benchmark_leaks(spark, near, sf)
    assert sorted((r["doc_id"] or 0) for r in clean.collect()) == [0, 1, 3, 3, 4]
    safe = corpus_pipeline.redact_secrets(spark, clean, sf)
    assert safe.columns == docs.columns and not safe.where("text like '%abcdefghijklmnop%'").count()
    assert {(r["doc_id"], r["n_chars"]) for r in safe.collect()} >= {(3, 10), (None, 10), (1, len(long) + 11)}
    pieces = corpus_pipeline.pack_sequences(spark, safe, sf)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == {None, 1, 3, 4}
    assert corpus_pipeline.drop_low_quality(spark, docs, sf).columns == docs.columns


def test_many_ids_to_drop_are_not_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(k % 50 or None, f"t{k}", k) for k in range(100)], "doc_id long, text string, n_chars long")
    ids = spark.createDataFrame([(k,) for k in [None, *range(40), *range(40)]], "doc_id long")
    for most, join in ((0, "SortMergeJoin"), (1000, "BroadcastHashJoin")):
        monkeypatch.setattr(components, "LARGE", most)
        kept = corpus_pipeline._without(docs, ids)
        run = kept._jdf.queryExecution()
        run.executedPlan().executeCollect()
        plan = run.executedPlan().toString().split("== Initial Plan ==")[0]
        assert join in plan and ("BroadcastExchange" in plan) == (most > 0)
        assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == sorted((k % 50, f"t{k}") for k in range(100) if k % 50 in (0, *range(40, 50)))
        assert kept.columns == docs.columns
