import numpy as np
import pytest

from tidemark.llm import components, simhash, vector_dedup
from tidemark.llm.components import connected_components


def union_find(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(k, k + 1) for k in range(40)], [(99, k) for k in range(30)], [(1, 2), (2, 1), (3, 4), (4, 5), (None, 3)]])
def test_components(spark, edges):
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    want = union_find(100, real)
    assert got == {x: want[x] for e in real for x in e}


def test_fingerprint_by_hand():
    import xxhash

    text = "One  TWO three\tfour\x0bfive É"
    parts = ["one two three four", "two three four five", "three four five É"]
    assert simhash.shingles(text) == [p.encode() for p in parts]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) > 1.5)
    assert simhash.fingerprint("") == simhash.fingerprint(" \n") == 0
    assert simhash.fingerprint("a B") == xxhash.xxh64_intdigest(b"a b", 42)


@pytest.mark.parametrize("n", [30, 400, 60_000])
def test_thresholds_satisfy_the_pigeonhole(n):
    rng = np.random.default_rng(n)
    x = rng.integers(0, 2, (500, 64))
    x[:, 10:20] = x[:, :1]  # correlated bits
    for distance in (2, 4, 6):
        plan = simhash.plan(n, (x.T @ x) * n // 500, distance)
        # Spread `distance` differences so that no group is within its threshold: it must be impossible.
        assert sum(t + 1 for _, t in plan) > distance
        bits = [b for g, _ in plan for b in g]
        assert len(bits) == len(set(bits))


def test_linking_is_exact(spark, rng):
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base[:25]:
        x = int(b)
        for _ in range(8):
            for bit in rng.choice(64, rng.integers(1, 5), replace=False):
                x ^= 1 << int(bit)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    got = {r["fp"] & (2**64 - 1): r["component"] for r in simhash.link_fingerprints(df).collect()}
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 4]
    want = union_find(len(fps), pairs)
    assert len(got) == len(fps)
    assert {(got[a] == got[b]) == (want[i] == want[j]) for i, a in enumerate(fps) for j, b in enumerate(fps)} == {True}


def test_crowded_buckets_are_not_expanded(spark, rng, monkeypatch):
    """Thousands of close fingerprints and two chains beside them: the same links, and no pairs within the crowd."""
    base = 0x0123456789ABCDEF
    fps = {base ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i + 1)}
    for start in (5, 6):
        x = base
        for step in range(start):  # by three bits, away from the crowd
            x ^= 7 << (9 * step)
            fps.add(x)
    fps |= {int(x) for x in rng.integers(0, 1 << 63, 20, dtype=np.uint64)}
    fps = sorted(fps)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long").repartition(4)
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    root = union_find(len(fps), pairs)
    want = {}
    for f, r in zip(fps, root):
        want.setdefault(r, set()).add(f)
    for crowd in (1, 16, 10**9):
        monkeypatch.setattr(simhash, "CROWD", crowd)
        got = {}
        for r in simhash.link_fingerprints(df).collect():
            got.setdefault(r["component"], set()).add(r["fp"] & (2**64 - 1))
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_exploded_tables_are_not_broadcast(spark, rng, monkeypatch):
    """Unrelated fingerprints have no crowds, and a few kilobytes of them make a million probes: none goes to the driver."""
    found = []
    monkeypatch.setattr(simhash, "connected_components", lambda edges, a, b: found.append(edges) or connected_components(edges, a, b))
    df = spark.createDataFrame([(int(x),) for x in rng.integers(-(1 << 63), 1 << 63, 3000)], "fp long")
    assert simhash.link_fingerprints(df).count() == 3000
    assert len(found) == 2
    for edges, mark in zip(found, ("", "bit_count")):  # the second one's crowds may be broadcast
        run = edges._jdf.queryExecution()
        run.executedPlan().executeCollect()
        plan = run.executedPlan().toString().split("== Initial Plan ==")[0]
        joins = [x for x in plan.splitlines() if "Join" in x and mark in x]
        assert joins and all("SortMergeJoin" in x for x in joins)


def test_many_nodes_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(components, "LARGE", 0, raising=False)
    plans = spark._jsparkSession.sharedState().statusStore()
    before = plans.executionsCount()
    got = connected_components(spark.createDataFrame([(k, k + 1) for k in range(40)], "a int, b int")).collect()
    assert {r["component"] for r in got} == {0} and len(got) == 41
    made = plans.executionsList(before, 1000)
    made = [made.apply(k).physicalPlanDescription() for k in range(made.size())]
    assert any("SortMergeJoin" in x for x in made) and not any("BroadcastExchange" in x for x in made)


@pytest.mark.parametrize("hot", [1, 200])
def test_join_of_hot_keys(spark, monkeypatch, hot):
    monkeypatch.setattr(components, "HOT", hot)
    left = spark.createDataFrame([(k, 1 if k < 900 else 2 if k < 950 else k if k < 990 else None) for k in range(1000)], "id int, c int")
    right = spark.createDataFrame([(1, "a"), (960, "b"), (-1, "c")], "c int, x string")
    for how in ("inner", "left"):
        got = sorted(map(repr, components.join_hot(left, right, "c", how).select("id", "c", "x").collect()))
        assert got == sorted(map(repr, left.join(right, "c", how).select("id", "c", "x").collect()))
    assert components.join_hot(left.limit(0), right, "c").count() == 0


def test_near_duplicates(spark):
    long = " ".join(f"w{k}" for k in range(400))
    rows = [(5, long, 1), (3, long, 1), (9, long.replace("w200", "changed"), 1), (4, "other text of its own here", 1), (7, "", 1), (8, None, 1), (8, None, 1), (6, "OTHER text of its own here", 1)]
    got = sorted((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp int")).collect())
    assert got == [(3, 3), (4, 4), (5, 3), (6, 4), (7, 7), (8, 7), (8, 7), (9, 3)]
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def brute_force(rows, threshold=0.93):
    out = {}
    ok = {k: np.array(v, float) for k, v, label in rows if label is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))}
    labels = {k: label for k, _, label in rows}
    ids = sorted(labels)
    linked = lambda a, b: a in ok and b in ok and labels[a] == labels[b] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / np.linalg.norm(ok[a]) / np.linalg.norm(ok[b]) >= threshold
    pairs = [(i, j) for i, a in enumerate(ids) for j, b in enumerate(ids[:i]) if linked(a, b)]
    comp = union_find(len(ids), pairs)
    for k, i in enumerate(ids):
        out[i] = (sum(k in p for p in pairs), ids[comp[k]])
    return out


def test_vectors(spark, rng):
    rows = [(k, rng.standard_normal(8).tolist(), k % 2) for k in range(60)]
    for k in range(60, 140):  # a dense group, larger than any list
        rows.append((k, (np.array(rows[3][1]) + 0.05 * rng.standard_normal(8)).tolist(), rows[3][2]))
    for k in range(140, 170):
        rows.append((k, rows[4][1], 0))
    rows += [(200, None, 1), (201, [0.0] * 8, 1), (202, [float("nan")] * 8, 1), (203, rows[3][1], None), (204, [], 1), (205, [1.0, None] * 4, 1), (206, rows[3][1][:4], 1), (207, [float("inf")] * 8, 1), (208, (np.array(rows[4][1]) * 7).tolist(), 0)]
    df = spark.createDataFrame([(k, v, label, "x") for k, v, label in rows], "vec_id long, embedding array<double>, label int, node string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_dedup.near_duplicates(df).collect()}
    want = brute_force(rows)
    assert got.keys() == want.keys()
    assert not [k for k in got if got[k][0] > want[k][0]]
    assert sum(n for n, _ in got.values()) >= 0.97 * sum(n for n, _ in want.values())
    assert [k for k in got if got[k] != want[k]] == []
    empty = vector_dedup.near_duplicates(df.limit(0))
    assert empty.count() == 0


def test_links_between_saturated_groups(spark, rng):
    axes = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    # Ten groups of 40, about 0.99 inside and 0.95 across: no list of 16 leaves its group.
    rows = [(40 * g + k, (axes[0] + 0.23 * axes[g + 1] + 0.01 * rng.standard_normal(64)).tolist(), 1) for g in range(10) for k in range(40)]
    rows += [(1000 + k, rng.standard_normal(64).tolist(), k % 2) for k in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_dedup.near_duplicates(df).collect()}
    assert got == brute_force(rows)
    assert {got[k][1] for k in range(400)} == {0} and min(got[k][0] for k in range(400)) > 39


def test_search_that_misses_its_target(spark, rng, monkeypatch):
    found = vector_dedup.nearest_in
    monkeypatch.setattr(vector_dedup, "nearest_in", lambda groups, k, floor: found(groups, k, 2.0))  # no tree finds anything
    rows = [(k, rng.standard_normal(16).tolist(), k % 2) for k in range(40)]
    rows += [(100 + k, (np.array(rows[k][1]) + 0.05 * rng.standard_normal(16)).tolist(), k % 2) for k in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_dedup.near_duplicates(df).collect()}
    assert got == brute_force(rows) and sum(n for n, _ in got.values()) >= 40


def test_trees_grow_with_the_label():
    kept = 1 - np.arccos(0.93) / np.pi
    for n, levels in ((90, 0), (100_000, 11), (10_000_000, 17)):
        trees = vector_dedup.trees_needed(n, 0.93)
        assert 1 - (1 - kept**levels) ** trees >= 0.95
