"""Near-duplicate embeddings by NN-descent (operator 8).

Equal vectors of a label are one node.  Random-projection trees put nodes into
small leaves, whose members' nearest neighbours start a graph; then neighbours of
neighbours are compared and better ones kept, until little changes.  A node whose
list is full of links is saturated: its whole component is compared with all nodes
of its label, block by block, and counted without writing pairs.  Components that
turn out to be linked are merged, and what they bring is compared too, until
nothing new appears.  Trees are as many as the size of the largest label asks for.
Recall is audited on a fixed number of the other nodes; if it falls short, new
trees add to the graph, and if that doesn't help, all nodes of a label are
compared.  Edges at or above the threshold remain, so no reported link is wrong.

Vectors that are null, empty, zero, or hold null or non-finite components, and
those with a null label, link with nothing.  Vectors of different lengths never
link.  Copies of a vector link with each other.  Repeated ids keep a row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm import scratch
from tidemark.llm.components import connected_components, join_hot
from tidemark.llm.tables import table

THRESHOLD, NEIGHBOURS, LEAF, TREES, DEPTH = 0.93, 16, 96, 4, 24
#: Neighbours less similar than this are not followed.
FLOOR = 0.5
ROUNDS, SETTLED, RECALL, AUDITED, ATTEMPTS, BLOCK = 4, 0.005, 0.95, 512, 3, 1024


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _edges(a, b, s) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float64())], names=["v", "u", "sim"])


def _groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[dict, pa.Array]]:
    """Rows of a collected list, one list at a time, with the other columns."""
    for b in batches:
        lists = b.column(column)
        rest = [n for n in b.schema.names if n != column]
        for k in range(b.num_rows):
            yield {n: b.column(n)[k].as_py() for n in rest}, lists[k].values


def nodes_of(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """``(node, label, dim, vec, copies)`` of distinct usable vectors, and ``(id, node)`` of every row (node null: unusable)."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vec"))
    if rows.schema["vec"].dataType.elementType.typeName() != "float":
        rows = rows.withColumn("vec", F.col("vec").cast("array<double>"))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & (F.size("vec") > 0) & sound & F.exists("vec", lambda x: x != 0), F.lit(False))
    distinct = rows.where(usable).groupBy("label", "vec").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    # Numbered as they are written, so a node has one id whatever the rows' ids are.
    nodes = scratch.materialise(distinct.select(F.monotonically_increasing_id().alias("node"), "label", F.size("vec").alias("dim"), "vec", "copies", "least"))
    return nodes, rows.join(nodes.select("label", "vec", "node"), ["label", "vec"], "left").select("id", "node")


def leaves(nodes: DataFrame, seed: int, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """``members``: lists of at most about ``2 * leaf`` nodes that some tree puts together."""
    depth = DEPTH

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            out = []
            for v, dim in zip(b.column(3), b.column(2).to_pylist()):
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, trees * depth))
                out.append((_unit(v.values.to_numpy(zero_copy_only=False).astype(np.float64)[None])[0] @ planes[dim]).astype(np.float32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(out, pa.list_(pa.float32()))], names=["node", "label", "dim", "proj"])

    label = nodes.schema["label"].dataType.simpleString()
    flat = scratch.materialise(nodes.select("node", "label", "dim", "vec").mapInArrow(project, f"node long, label {label}, dim int, proj array<float>"))
    stats = flat.groupBy("label", "dim").agg(F.count("*").alias("n"), *(F.avg(F.col("proj")[k]).alias(f"m{k}") for k in range(trees * depth)))
    stats = scratch.materialise(stats.select("label", "dim", "n", F.array(*(f"m{k}" for k in range(trees * depth))).alias("mid")))
    levels = F.least(F.lit(depth), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / leaf)).cast("int")))
    bits = F.zip_with("proj", "mid", lambda p, m: (p > m).cast("int"))
    coded = flat.join(stats, ["label", "dim"]).select("node", "label", "dim", levels.alias("levels"), bits.alias("bits"))
    code = F.array_join(F.slice("bits", F.col("tree") * depth + 1, F.col("levels")), "")
    placed = coded.withColumn("tree", F.explode(F.array(*(F.lit(t) for t in range(trees))))).select("node", "label", "dim", "tree", code.alias("code"))
    placed = scratch.materialise(placed)
    full = placed.groupBy("label", "dim", "tree", "code").agg(F.ceil(F.count("*") / (2 * leaf)).alias("parts"))
    part = F.pmod(F.xxhash64("node", "tree"), F.col("parts"))
    placed = placed.join(full, ["label", "dim", "tree", "code"]).withColumn("part", part)
    with_vec = placed.join(nodes.select("node", "vec"), "node")
    return with_vec.groupBy("label", "dim", "tree", "code", "part").agg(F.collect_list(F.struct("node", "vec")).alias("members")).select("dim", "members")


def trees_needed(n: int, threshold: float, leaf: int = LEAF, recall: float = RECALL) -> int:
    """Trees of which one at least keeps a pair at the threshold in one leaf, with a chance of ``recall``, among ``n`` nodes."""
    levels = min(DEPTH, max(0, ceil(log2(max(n, 1) / leaf))))
    together = (1 - acos(min(1.0, max(-1.0, threshold))) / pi) ** levels
    return ceil(log(1 - recall) / log(1 - together)) if 0 < together < recall else 1


def nearest_in(groups: DataFrame, k: int, floor: float) -> DataFrame:
    """``v, u, sim``: of every member its ``k`` nearest in its list, above the floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, members in _groups(batches, "members"):
            ids = members.field("node").to_numpy(zero_copy_only=False)
            x = _unit(_matrix(members.field("vec"), row["dim"]))
            s = x @ x.T
            np.fill_diagonal(s, -2)
            m = min(k, len(ids) - 1)
            if m > 0:
                best = np.argpartition(-s, m - 1, axis=1)[:, :m]
                a, b = np.repeat(np.arange(len(ids)), m), best.ravel()
                keep = s[a, b] >= floor
                yield _edges(ids[a[keep]], ids[b[keep]], s[a[keep], b[keep]])

    return groups.mapInArrow(run, "v long, u long, sim double")


def _best(v: np.ndarray, u: np.ndarray, sim: np.ndarray, k: int) -> pa.RecordBatch:
    """Of each ``v`` its ``k`` best distinct neighbours among these edges."""
    order = np.lexsort((-sim, u, v))
    v, u, sim = v[order], u[order], sim[order]
    once = np.append(True, (v[1:] != v[:-1]) | (u[1:] != u[:-1]))[: len(v)]
    v, u, sim = v[once], u[once], sim[once]
    order = np.lexsort((-sim, v))
    v, u, sim = v[order], u[order], sim[order]
    begins = np.flatnonzero(np.append(True, v[1:] != v[:-1])[: len(v)])
    rank = np.arange(len(v)) - np.repeat(begins, np.diff(np.append(begins, len(v))))
    keep = rank < k
    return _edges(v[keep], u[keep], sim[keep])


def best_lists(edges: DataFrame, k: int) -> DataFrame:
    """``v, near``: the ``k`` best distinct neighbours of every node, best first, as ``sim, u, old``; one exchange."""
    once = edges.repartition("v").groupBy("v", "u").agg(F.max("sim").alias("sim"), F.max("old").alias("old"))
    return once.groupBy("v").agg(F.slice(F.sort_array(F.collect_list(F.struct("sim", "u", "old")), asc=False), 1, k).alias("near"))


def edges_of(graph: DataFrame) -> DataFrame:
    return graph.select("v", F.explode("near").alias("e")).select("v", "e.u", "e.sim")


def local_join(graph: DataFrame, k: int, floor: float) -> DataFrame:
    """Edges between neighbours (forward, and the best backward ones) of one node that beat one of the two's lists.

    ``graph`` has ``v, dim, vec, near``."""
    edges = edges_of(graph)
    ways = edges.select("v", "u", "sim", F.lit(True).alias("own")).union(edges.select(F.col("u").alias("v"), F.col("v").alias("u"), "sim", F.lit(False)))
    # Ranks are cut before the exchange too, so a node that many others point to stays small.
    rank = F.row_number().over(W.partitionBy("v").orderBy(F.desc("own"), F.desc("sim"), "u"))
    around = ways.withColumn("rank", rank).where(F.col("rank") <= 3 * k).groupBy("v").agg(F.array_distinct(F.concat(F.collect_list("u"), F.array("v"))).alias("u"))
    full = F.size("near") >= k
    known = graph.select(F.col("v").alias("u"), "dim", "vec", F.when(full, F.element_at("near", -1)["sim"]).otherwise(F.lit(floor)).alias("worst"))
    lists = around.select("v", F.explode("u").alias("u")).join(known, "u").groupBy("v", "dim").agg(F.collect_list(F.struct(F.col("u").alias("node"), "vec", "worst")).alias("members"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row, members in _groups(iter([batch]), "members"):
                ids = members.field("node").to_numpy(zero_copy_only=False)
                worst = members.field("worst").to_numpy(zero_copy_only=False)
                x = _unit(_matrix(members.field("vec"), row["dim"]))
                s = x @ x.T
                np.fill_diagonal(s, -2)
                a, b = np.nonzero(s > worst[:, None])  # what improves a's list
                found.append((ids[a], ids[b], s[a, b]))
            if found:
                yield _best(*(np.concatenate(c) for c in zip(*found)), k)

    return lists.select("dim", "members").mapInArrow(run, "v long, u long, sim double")


def refine(start: DataFrame, nodes: DataFrame, n: int, k: int, floor: float, rounds: int) -> DataFrame:
    """``v, dim, vec, near`` of all nodes, after neighbours of neighbours were tried until little changes."""
    spark = nodes.sparkSession
    vectors = nodes.select(F.col("node").alias("v"), "dim", "vec")
    state = lambda edges: scratch.write(vectors.join(best_lists(edges, k), "v", "left").withColumn("near", F.coalesce("near", F.array())))
    path = state(start.withColumn("old", F.lit(True)))
    for _ in range(rounds):
        graph = spark.read.parquet(path)
        nxt = state(edges_of(graph).withColumn("old", F.lit(True)).union(local_join(graph, k, floor).withColumn("old", F.lit(False))))
        fresh = spark.read.parquet(nxt).agg(F.sum(F.size(F.filter("near", lambda e: ~e["old"])))).first()[0] or 0
        scratch.drop(spark, path)
        path = nxt
        if fresh <= SETTLED * n:
            break
    return spark.read.parquet(path)


def audit(both: DataFrame, sparse: DataFrame, nodes: DataFrame, threshold: float, audited: int = AUDITED) -> float:
    """Share of the links of ``audited`` nodes (least hashes) that the result has; compared with all nodes.

    ``sparse`` holds the nodes to choose from, those that weren't compared with all."""
    asked = sparse.orderBy(F.xxhash64(F.lit(1), "node")).select("node", "label", "dim", "vec").limit(audited).collect()
    spaces: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    for key in {(r["label"], r["dim"]) for r in asked}:
        own = [r for r in asked if (r["label"], r["dim"]) == key]
        spaces[key] = np.array([r["node"] for r in own]), _unit(np.array([r["vec"] for r in own], np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels, dims, ids = b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(0).to_numpy(zero_copy_only=False)
            for key, (queries, q) in spaces.items():
                at = [k for k, x in enumerate(zip(labels, dims)) if x == key]
                if at:
                    x = _unit(_matrix(b.column(3).take(pa.array(at)), key[1]))
                    i, j = np.nonzero(q @ x.T >= threshold)
                    other = ids[at][j]
                    keep = queries[i] != other
                    if keep.any():
                        yield _edges(queries[i[keep]], other[keep], np.ones(int(keep.sum())))

    true = nodes.select("node", "label", "dim", "vec").mapInArrow(run, "v long, u long, sim double").groupBy("v").agg(F.count("*").alias("links"))
    found = both.groupBy("v").agg(F.count("*").alias("got"))
    row = true.join(found, "v", "left").agg(F.sum("links").alias("links"), F.sum(F.least("links", F.coalesce("got", F.lit(0)))).alias("got")).first()
    return (row["got"] or 0) / row["links"] if row["links"] else 1.0


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect just what the edges ``a, b`` connect, at most one for each end."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    root = np.arange(len(ids))
    while True:
        low, new = np.minimum(root[i], root[j]), root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    keep = root != np.arange(len(ids))
    return ids[keep], ids[root[keep]]


def compare_in_blocks(asked: DataFrame, nodes: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """``node, weight, a, b``: copies linked to each asked node among all ``nodes`` of its label, all compared in blocks;
    and, in rows without a node, pairs of components that links join.

    Both have ``node, component, label, dim, vec, copies``."""
    key = ["label", "dim"]
    blocks = lambda df, name: df.groupBy(*key).agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    sizes = blocks(asked, "na").join(blocks(nodes, "nb"), key)
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    item = F.struct("node", "component", "vec", "copies")
    left = asked.join(F.broadcast(sizes), key).select(*key, own("na").alias("a"), spread("nb").alias("b"), F.lit(True).alias("asks"), item.alias("m"))
    right = nodes.join(F.broadcast(sizes), key).select(*key, spread("na").alias("a"), own("nb").alias("b"), F.lit(False).alias("asks"), item.alias("m"))
    groups = left.union(right).groupBy(*key, "a", "b").agg(F.collect_list(F.struct("asks", "m.node", "m.component", "m.vec", "m.copies")).alias("members"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, got in _groups(batches, "members"):
            asks = got.field("asks").to_numpy(zero_copy_only=False).astype(bool)
            if asks.all() or not asks.any():
                continue
            ids, copies, comp = (got.field(c).to_numpy(zero_copy_only=False) for c in ("node", "copies", "component"))
            x = _unit(_matrix(got.field("vec"), row["dim"]))
            linked = (x[asks] @ x[~asks].T >= threshold) & (ids[asks][:, None] != ids[~asks][None, :])
            weight = linked @ copies[~asks]
            some = weight > 0
            v = [ids[asks][some], weight[some]]
            i, j = np.nonzero(linked & (comp[asks][:, None] != comp[~asks][None, :]))
            a, b = _forest(comp[asks][i], comp[~asks][j])
            n, m = len(v[0]), len(a)
            cols = [pa.concat_arrays([pa.array(c, pa.int64()), pa.nulls(m, pa.int64())]) for c in v]
            cols += [pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(c, pa.int64())]) for c in (a, b)]
            yield pa.RecordBatch.from_arrays(cols, names=["node", "weight", "a", "b"])

    return groups.select("dim", "members").mapInArrow(run, "node long, weight long, a long, b long")


def enlarge(nodes: DataFrame, both: DataFrame, seeds: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``node, component`` of all nodes, and ``node, weight`` of those compared with all nodes of their label:
    the components of the ``seeds``, and what is found to be linked to them."""
    found = connected_components(both, "v", "u")
    placed = scratch.materialise(nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")))
    exact = scratch.materialise(nodes.select("node", F.lit(0).cast("long").alias("weight")).limit(0))
    seeds = scratch.materialise(seeds.select("node").distinct())
    while True:
        dense = placed.join(seeds, "node", "left_semi").select("component").distinct()
        asked = scratch.materialise(placed.join(dense, "component", "left_semi").join(exact, "node", "left_anti").select(*placed.columns))
        if asked.isEmpty():
            return placed, exact
        got = scratch.materialise(compare_in_blocks(asked, placed, threshold))
        weights = got.where("node is not null").groupBy("node").agg(F.sum("weight").alias("weight"))
        exact = scratch.materialise(exact.union(asked.select("node").join(weights, "node", "left").select("node", F.coalesce("weight", F.lit(0)))))
        joined = connected_components(got.where("node is null"), "a", "b").select(F.col("node").alias("component"), F.col("component").alias("above"))
        placed = scratch.materialise(placed.join(joined, "component", "left").select("node", "label", "dim", "vec", "copies", "least", F.coalesce("above", "component").alias("component")))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, k: int = NEIGHBOURS) -> DataFrame:
    """``id_col, n_links, component_id, kept`` of every row."""
    nodes, members = nodes_of(vectors, id_col, vector_col, label_col)
    n = nodes.count()
    floor = min(FLOOR, threshold)
    largest = nodes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    needed = trees_needed(largest, threshold)
    forests = ceil(needed / (2 * TREES))
    trees = max(TREES, ceil(needed / forests))
    graph = None
    for attempt in range(ATTEMPTS):
        start = graph and edges_of(graph)
        for forest in range(forests):
            more = nearest_in(leaves(nodes, attempt * forests + forest, trees), k, floor)
            start = more if start is None else start.union(more)
        graph = refine(start, nodes, n, k, floor, ROUNDS)
        links = edges_of(graph).where(F.col("sim") >= threshold)
        both = scratch.materialise(links.select("v", "u").union(links.select("u", "v")).distinct())
        saturated = graph.where((F.size("near") >= k) & (F.element_at("near", -1)["sim"] >= threshold)).select(F.col("v").alias("node"))
        placed, exact = enlarge(nodes, both, saturated, threshold)
        if audit(both, nodes.join(exact, "node", "left_anti"), nodes, threshold) >= RECALL:
            break
    else:  # the search missed its target: every node is compared with its whole label
        placed, exact = enlarge(nodes, both, nodes, threshold)
    copies = nodes.select(F.col("node").alias("u"), "copies")
    sparse = both.join(copies, "u").groupBy(F.col("v").alias("node")).agg(F.sum("copies").alias("some"))
    by_node = placed.select("node", "copies", "least", "component").join(sparse, "node", "left").join(exact, "node", "left")
    by_node = by_node.select("node", "least", "component", (F.col("copies") - 1 + F.coalesce("weight", "some", F.lit(0))).alias("n_links"))
    by_node = scratch.materialise(by_node)
    named = join_hot(by_node, by_node.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("node", "n_links", "component_id")
    out = members.join(named, "node", "left")
    out = out.select(F.col("id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
