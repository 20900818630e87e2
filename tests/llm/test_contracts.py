"""Every registered query over the sample tables, held against its contract."""

import re
import zlib

import numpy as np
import pytest

from tidemark.llm import registry, simhash
from tidemark.llm.tables import table

COLUMNS = {
    "op1_mixture_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op2_cgk_decontamination": {"doc_id": "bigint", "item_id": "bigint"},
    "op5_simhash_near_dedup": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op7_secret_scans": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op8_nn_descent": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op9_compression_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op10_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
}


@pytest.fixture(scope="module")
def results(spark, sf):
    out = {}
    for name in COLUMNS:
        df = registry.QUERIES[name](spark, sf)
        assert COLUMNS[name].items() <= dict(df.dtypes).items(), name
        out[name] = df.collect()
    return out


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r["doc_id"]: r["text"] or "" for r in table(spark, sf, "documents").collect()}


def test_packing(results, texts, library):
    pieces, sequences = {}, {}
    for p in results["op1_mixture_packing"]:
        pieces.setdefault(p["doc_id"], []).append(p)
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert pieces.keys() == texts.keys()
    for d, parts in pieces.items():
        ids = [*library.encode(texts[d], add_special_tokens=False).ids, 1]
        at = 0
        for p in sorted(parts, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    sizes = []
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        sizes.append(at)
    assert max(sizes) <= 2048 and sorted(sizes)[1:] == [2048] * (len(sizes) - 1)


def test_simhash(results, texts):
    rows = {r["doc_id"]: r for r in results["op5_simhash_near_dedup"]}
    fps = {d: simhash.fingerprint(t) for d, t in texts.items()}
    assert {d: r["fingerprint"] for d, r in rows.items()} == {d: f"{f:016x}" for d, f in fps.items()}
    up = {d: d for d in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(fps)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                up[y] = x
    assert {d: r["component_id"] for d, r in rows.items()} == {d: find(d) for d in ids}


def test_vectors_against_all(results, spark, sf):
    """Every vector whose id is divisible by 20 against all rows: recall of links; and no link that isn't one."""
    rows = {r["vec_id"]: r for r in results["op8_nn_descent"]}
    vectors = table(spark, sf, "embeddings").collect()
    ids = np.array([v["vec_id"] for v in vectors])
    x = np.array([v["embedding"] if v["embedding"] and all(e is not None for e in v["embedding"]) else [0.0] * 64 for v in vectors], float)
    size = np.linalg.norm(x, axis=1)
    x /= np.where(size > 0, size, 1)[:, None]
    labels = np.array([str(v["label"]) if v["label"] is not None else f"none {k}" for k, v in enumerate(vectors)])
    want = got = 0
    for k in np.flatnonzero(ids % 20 == 0):
        true = int(((x @ x[k] >= 0.93) & (labels == labels[k]) & (ids != ids[k])).sum())
        assert rows[int(ids[k])]["n_links"] <= true
        want, got = want + true, got + rows[int(ids[k])]["n_links"]
    assert len(rows) == len(ids) and got >= 0.95 * want
    assert all(r["kept"] == (v == r["component_id"]) and r["component_id"] <= v for v, r in rows.items())


def test_quality(results, texts):
    rows = results["op9_compression_quality"]
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_token_counts(results, texts, library):
    for r in results["op10_token_counts"]:
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 512)


def test_secrets_and_leaks(results, spark, sf, texts):
    import hashlib

    from test_text import spans_by_hand

    from tidemark.llm.decontaminate import words_of

    for r in results["op7_secret_scans"]:
        spans = spans_by_hand(texts[r["doc_id"]])
        kinds = [s.split(":")[0] for s in spans.split(",")]
        assert (r["spans"], r["base_sha256"]) == (spans, hashlib.sha256(spans.encode()).hexdigest())
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [kinds.count(k) for k in ("assign", "access", "hex")]
        assert re.fullmatch("[0-9a-f]{64}", r["base_sha256"])
    found = {(r["doc_id"], r["item_id"]) for r in results["op2_cgk_decontamination"]}
    items = {r["item_id"]: " ".join(words_of(r["text"] or "")) for r in table(spark, sf, "benchmark").collect()}
    for d, t in texts.items():
        body = f" {' '.join(words_of(t))} "
        assert all((d, i) in found for i, item in items.items() if item and f" {item} " in body)
