"""Approximate nearest neighbours: NN-descent builds a graph by Spark joins, queries walk it greedily.

Equal vectors are one node. Random hyperplanes, fitted on a sample whose size follows the depth, deal the nodes to leaves, in
several trees; within a leaf, groups of at most GROUP nodes are compared, and each node's nearest START of every tree are its first
neighbours. Then rounds of NN-descent, until few neighbours change: a node's neighbours, of both directions, meet each other, and
every node keeps the nearest it has met. A query starts at its own node and in each step looks at the neighbours of all nodes of
its beam it hasn't looked at yet, until there are none; the beam widens with the logarithm of the number of nodes. What is
returned is ranked by exact distances in double precision.

Meetings and steps happen at homes: one more tree gives every node a home of about HOME nodes. The lists of a home's nodes meet in
one task, to which each vector that occurs in any of them is sent once, and which sends on only the nearest of what it found for a
node, below the farthest that the node keeps anyway. A query's candidates are measured at the homes they live at, so a query's
vector travels once a home, and homes that many queries ask are dealt out by query. So a hub's vector goes to as many homes as ask
for it, not along every edge.

Graph and walk see every vector as its column holds it, float or double, and compute in double precision around a group's
centre, so near copies are told apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelog.llm.common import discard, integral, materialise

#: Neighbours that a node keeps, neighbours of the other direction that take part, width of a query's beam at BEAM_NODES nodes.
DEGREE, BACK, BEAM, BEAM_NODES = 32, 32, 128, 10_000
#: Trees of the start, nodes of a group, neighbours that a tree gives a node, least rows of the sample that the hyperplanes are
#: fitted on, nodes of a leaf that a worker splits on, deepest tree (its sample is 16 rows a leaf).
TREES, GROUP, START, SAMPLE, LEAF, DEEPEST = 8, 1024, 12, 10_000, 8_192, 13
#: Nodes of a home, candidates that one task measures at a home.
HOME, ASKED = 2048, 500_000
#: The graph is done when a round changes less than this share of the neighbours.
SETTLED = 0.02
#: Salts that deal out one node's edges or one vector's copies before they are ranked.
SALTS = 32


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of vectors that take part: without nulls, all finite, not zero, of the most common length; one row an id."""
    v = F.col(vec_col).cast("array<double>")
    fine = v.isNotNull() & F.col(id_col).isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), fine.alias("fine")).where(F.coalesce("fine", F.lit(False))).drop("fine")
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("v") == (lengths[0].d if lengths else 0)).groupBy("id").agg(F.min("v").alias("v"))


def smallest(df: DataFrame, by: list[str], order: list, most: int) -> DataFrame:
    """The first `most` rows of each group. Salted first, so a hot group is never ranked in one task."""
    salted = Window.partitionBy(*by, "_salt").orderBy(*order)
    df = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))).withColumn("_rank", F.row_number().over(salted)).where(F.col("_rank") <= most)
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rank") <= most).drop("_salt", "_rank")


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def pack(x: np.ndarray) -> list[bytes]:
    """Each row as the width of a component and its components."""
    tag = bytes([x.itemsize])
    return [tag + r.tobytes() for r in x]


def unpack(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 1))
    rows = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    return np.ascontiguousarray(rows[:, 1:]).view(f"f{rows[0, 0]}").astype(np.float64)


def _packed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pack(matrix(batch.column(1)).astype(f"f{width}")) if batch.num_rows else [], pa.binary())], names=["u", "v"])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by the product form, around the centre of b; good enough to choose, results are measured anew."""
    centre = b.mean(-2, keepdims=True) if b.shape[-2] else 0
    a, b = a - centre, b - centre
    return np.maximum((a * a).sum(-1)[..., :, None] + (b * b).sum(-1)[..., None, :] - 2 * a @ np.swapaxes(b, -1, -2), 0)


def _planes(sample: np.ndarray, depth: int, seed: int) -> list[tuple[np.ndarray, float]]:
    """A binary tree of hyperplanes in heap order; each splits its part of the sample at the median."""
    rng = np.random.default_rng(seed)
    planes, parts = [], [np.arange(len(sample))]
    for _ in range(depth):
        below = []
        for part in parts:
            w = sample[rng.choice(part)] - sample[rng.choice(part)] if len(part) > 1 else rng.normal(size=sample.shape[1])
            w = w if np.any(w) else rng.normal(size=sample.shape[1])
            x = sample[part] @ w
            cut = float(np.median(x)) if len(part) else 0.0
            planes.append((w, cut))
            below += [part[x <= cut], part[x > cut]]
        parts = below
    return planes


def _leaves(batches: Iterator[pa.RecordBatch], trees: list[list[tuple[np.ndarray, float]]], depth: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        x = unpack(batch.column(1))
        for t, planes in enumerate(trees):
            at = np.zeros(len(x), np.int64)
            w, cut = np.array([p[0] for p in planes]) if planes else np.zeros((1, x.shape[1])), np.array([p[1] for p in planes] or [0.0])
            for _ in range(depth):
                at = 2 * at + 1 + ((x * w[at]).sum(1) > cut[at])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at * len(trees) + t)], names=["u", "v", "leaf"])


def _groups(x: np.ndarray, seed: int) -> Iterator[np.ndarray]:
    """Row numbers of x in groups of at most GROUP, halved by random hyperplanes; equal projections are halved as well."""
    rng = np.random.default_rng(seed)
    parts = [np.arange(len(x))]
    while parts:
        part = parts.pop()
        if len(part) <= GROUP:
            yield part
            continue
        w = x[rng.choice(part)] - x[rng.choice(part)]
        w = w if np.any(w) else rng.normal(size=x.shape[1])
        part = part[np.argsort(x[part] @ w, kind="stable")]
        parts += [part[: len(part) // 2], part[len(part) // 2 :]]


def _nearest_in(table: pa.Table, most: int) -> pa.Table:
    table = table.sort_by("u")
    u, x = table.column("u").to_numpy(), unpack(table.column("v"))
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for part in _groups(x, table.column("leaf")[0].as_py()):
        k = min(most, len(part) - 1)
        if k < 1:
            continue
        d = distances(x[part], x[part])
        np.fill_diagonal(d, np.inf)
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        out.append((np.repeat(u[part], k), u[part][near].ravel(), np.take_along_axis(d, near, 1).ravel()))
    return pa.table({c: np.concatenate([o[k] for o in out]) for k, c in enumerate(("u", "w", "d"))})


def _best(pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray]], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, d) with each pair once and of each a only its nearest `most`: what else is found here is not among a's nearest."""
    a, b, d = (np.concatenate([p[k] for p in pieces]) for k in range(3))
    order = np.lexsort((b, d, a))
    a, b, d = a[order], b[order], d[order]
    # a pair's distance is measured around different centres: nearly equal, so copies of it stand close together, not always side by side
    pair = np.lexsort((d, b, a))
    first = np.r_[True, (a[pair][1:] != a[pair][:-1]) | (b[pair][1:] != b[pair][:-1])] if len(a) else np.zeros(0, bool)
    kept = np.sort(pair[first])
    a, b, d = a[kept], b[kept], d[kept]
    starts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
    place = np.arange(len(a)) - np.repeat(starts, np.diff(np.r_[starts, len(a)]))
    return a[place < most], b[place < most], d[place < most]


def _meet(lists: pa.Table, told: pa.Table, degree: int) -> pa.Table:
    """One home. lists: (h, u, w, new), the neighbours of its nodes; told: of _sent(), every vector in them once. Gives pairs
    (u, w, d) of neighbours of one node that are nearer than u's farthest."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    if not len(told) or not len(lists):
        return pa.table(dict(zip(("u", "w", "d"), none, strict=True)))
    known, far = (np.frombuffer(b"".join(told.column(c).to_pylist()), k) for c, k in (("xs", np.int64), ("xfars", np.float64)))
    flat = np.frombuffer(b"".join(told.column("xvs").to_pylist()), np.uint8).reshape(len(known), -1)
    order = np.argsort(known)
    known, far = known[order], far[order]
    x = np.ascontiguousarray(flat[order, 1:]).view(f"f{flat[0, 0]}").astype(np.float64)
    owner, w, new = lists.column("u").to_numpy(), lists.column("w").to_numpy(), lists.column("new").to_numpy(zero_copy_only=False).astype(bool)
    order = np.lexsort((w, owner))
    owner, w, new = owner[order], w[order], new[order]
    once = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (w[1:] != w[:-1])]) if len(w) else np.zeros(0, np.int64)
    new = np.logical_or.reduceat(new, once) if len(once) else new  # a neighbour of both directions counts once
    owner, w = owner[once], w[once]
    at = np.searchsorted(known, w)
    cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True]) if len(owner) else np.zeros(1, np.int64)
    out, count = [none], 0
    for a, b in zip(cuts, cuts[1:], strict=False):
        i, fresh = at[a:b], new[a:b]
        if b - a < 2 or not fresh.any():
            continue
        d = distances(x[i], x[i])
        near = d < far[i][:, None]
        np.fill_diagonal(near, False)
        near[np.ix_(~fresh, ~fresh)] = False  # they have met before
        p, q = np.nonzero(near)
        out.append((known[i[p]], known[i[q]], d[p, q]))
        count += len(p)
        if count > 1_000_000:
            out = [_best(out, degree)]
            count = len(out[0][0]) // 2
    return pa.table(dict(zip(("u", "w", "d"), _best(out, degree), strict=True)))


def _sent(asks: DataFrame, vectors: DataFrame, buckets: int) -> DataFrame:
    """(at, xs, xvs, xfars): for each home what it asks for of vectors (x, xv, xfar), a row for each bucket of nodes that has any of
    it. asks: (at, asked)."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets))

    def send(asks: pa.Table, vectors: pa.Table) -> pa.Table:
        asks, vectors = asks.sort_by("at"), vectors.sort_by("x")
        x, at = vectors.column("x").to_numpy(), asks.column("at").to_numpy()
        rows = np.searchsorted(x, asks.column("asked").to_numpy())
        cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1], True]) if len(at) else np.zeros(1, np.int64)
        width = len(vectors.column("xv")[0].as_py()) if len(x) else 1
        packed, far = np.frombuffer(b"".join(vectors.column("xv").to_pylist()), np.uint8).reshape(-1, width), vectors.column("xfar").to_numpy()
        pieces = [rows[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return pa.table({"at": pa.array(at[cuts[:-1]], pa.int64()), "xs": pa.array([x[p].tobytes() for p in pieces], pa.binary()), "xvs": pa.array([packed[p].tobytes() for p in pieces], pa.binary()), "xfars": pa.array([far[p].tobytes() for p in pieces], pa.binary())})

    asked, held = asks.withColumn("b", place("asked")), vectors.withColumn("b2", place("x"))
    return asked.groupBy("b").cogroup(held.groupBy("b2")).applyInArrow(lambda a, v: send(a.drop_columns("b"), v.drop_columns("b2")), "at long, xs binary, xvs binary, xfars binary")


def _trees(nodes: DataFrame, depth: int, seeds: range) -> list[list[tuple[np.ndarray, float]]]:
    """Hyperplanes of so many trees, fitted on a sample by hash of the node."""
    rows = nodes.select("u", "v").orderBy(F.xxhash64("u"), "u").limit(max(SAMPLE, 16 << depth)).select("v").toArrow()
    sample = unpack(rows.column("v"))
    return [_planes(sample, depth, seed) for seed in seeds]


def _dealt(nodes: DataFrame, trees: list[list[tuple[np.ndarray, float]]], depth: int, most: int) -> DataFrame:
    """(u, v, leaf, part) in every tree; a leaf of more than `most` nodes is dealt out by hash, in each tree another way."""
    leaves = nodes.select("u", "v").mapInArrow(lambda it: _leaves(it, trees, depth), "u long, v binary, leaf long")
    sizes = leaves.groupBy("leaf").agg(F.ceil(F.count("*") / most).alias("parts"))  # trees * 2 ** depth rows at most
    return leaves.join(F.broadcast(sizes), "leaf").withColumn("part", F.pmod(F.xxhash64("u", "leaf"), F.col("parts")))


def at_homes(nodes: DataFrame) -> DataFrame:
    """(u, v, h): nodes with their home, of HOME nodes or a little more."""
    n = nodes.count()
    depth = min(DEEPEST, max(0, int(np.ceil(np.log2(max(n, 1) / HOME)))))
    dealt = _dealt(nodes, _trees(nodes, depth, range(1000, 1001)), depth, 2 * HOME)
    return dealt.select("u", "v", F.xxhash64("leaf", "part").alias("h"))


def build_graph(nodes: DataFrame, degree: int = DEGREE) -> DataFrame:
    """(u, w, d): each node's nearest neighbours met, at most degree; d is about the squared distance. nodes: (u, v, h), packed."""
    n = nodes.count()
    depth = _depth(n)
    dealt = _dealt(nodes, _trees(nodes, depth, range(TREES if depth else 1)), depth, 4 * LEAF)
    most = min(degree, START if depth else degree)
    found = dealt.groupBy("leaf", "part").applyInArrow(lambda t: _nearest_in(t, most), "u long, w long, d double")
    # new: the edge's two ends have not met u's others; back_new: nor those of w
    graph = materialise(_kept(found.withColumns({"new": F.lit(True), "back_new": F.lit(True)}), degree), "graph")
    while True:  # every round but the last replaces neighbours by nearer ones, so there is a last
        turned = graph.select(F.col("w").alias("u"), F.col("u").alias("w"), F.col("back_new").alias("new"), "d")
        back = materialise(smallest(turned, ["u"], [F.desc("new"), "d", "w"], BACK).drop("_rank"), "back")
        near = graph.select("u", "w", "new").unionByName(back.select("u", "w", "new"))
        lists = near.groupBy("u").agg(F.collect_list(F.struct("w", "new")).alias("l"), F.max("new").alias("any")).where("any")
        lists = materialise(lists.join(nodes.select("u", "h"), "u").select("h", "u", F.explode("l").alias("l")).select("h", "u", "l.w", "l.new"), "lists")
        far = graph.groupBy("u").agg(F.when(F.count("*") >= degree, F.max("d")).otherwise(float("inf")).alias("far"))
        told = nodes.select("u", "v").join(far, "u", "left").select(F.col("u").alias("x"), F.col("v").alias("xv"), F.coalesce("far", F.lit(float("inf"))).alias("xfar"))
        told = _sent(lists.select(F.col("h").alias("at"), F.col("w").alias("asked")).distinct(), told, -(-n // HOME))
        met = lists.groupBy("h").cogroup(told.groupBy("at")).applyInArrow(lambda a, b: _meet(a, b, degree), "u long, w long, d double")
        after = materialise(_kept(_after(graph, back, met), degree), "graph")
        moved = after.where("new").count()
        for old in (graph, back, lists):
            discard(old)
        graph = after
        if moved <= SETTLED * degree * n:
            break
    return graph.select("u", "w", "d")


def _depth(n: int) -> int:
    """Of the trees on the driver: to groups if SAMPLE allows it, else to leaves that workers split on; DEEPEST at most."""
    groups, leaves = (max(0, int(np.ceil(np.log2(max(n, 1) / x)))) for x in (0.75 * GROUP, LEAF))
    return min(DEEPEST, groups, max(leaves, int(np.log2(min(n, SAMPLE) / 16 + 1))))


def _after(graph: DataFrame, back: DataFrame, met: DataFrame) -> DataFrame:
    """All edges after a round. A reverse edge that found no room in back has met no one there and stays new."""
    held = graph.select("u", "w", "d", F.lit(False).alias("new"), "back_new")
    taken = back.select(F.col("w").alias("u"), F.col("u").alias("w"), "d", F.lit(False).alias("new"), F.lit(False).alias("back_new"))
    return held.unionByName(taken).unionByName(met.withColumns({"new": F.lit(True), "back_new": F.lit(True)}))


def _kept(edges: DataFrame, degree: int) -> DataFrame:
    """Each node's nearest `degree`, each once; an edge known before is not new."""
    once = edges.groupBy("u", "w").agg(F.min("d").alias("d"), F.min("new").alias("new"), F.min("back_new").alias("back_new"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy("d", "w"))
    return once.withColumn("_rank", rank).where(F.col("_rank") <= degree).drop("_rank")


def _approach(pairs: pa.Table, told: pa.Table) -> pa.Table:
    """One home, or a share of its queries. pairs: (g, query, node); told: (at, is_query, id, v, far), every vector once. Gives
    (query, node, d) of nodes nearer than the farthest of a full beam."""
    asks = np.array(told.column("is_query").to_numpy(zero_copy_only=False), bool)
    ids, x, far = told.column("id").to_numpy(), unpack(told.column("v")), told.column("far").to_numpy()
    query, node = pairs.column("query").to_numpy(), pairs.column("node").to_numpy()
    places = []
    for mine, wanted in ((asks, query), (~asks, node)):
        rows = np.flatnonzero(mine)
        rows = rows[np.argsort(ids[rows])]
        places.append(rows[np.searchsorted(ids[rows], wanted)] if len(rows) else np.zeros(0, np.int64))
    q, w = places
    d = np.concatenate([((x[q[k : k + 20_000]] - x[w[k : k + 20_000]]) ** 2).sum(1) for k in range(0, len(q), 20_000)] or [np.zeros(0)])
    near = d < far[q] if len(q) else np.zeros(0, bool)
    return pa.table({"query": query[near], "node": node[near], "d": d[near]})


def _measured(table: pa.Table, asked: pa.Table) -> pa.Table:
    """One query's candidates with their exact distances in double precision."""
    d = np.sqrt(((matrix(table.column("v")) - matrix(asked.column("qv"))[:1]) ** 2).sum(1)) if table.num_rows else np.zeros(0)
    return pa.table({"query": table.column("query"), "node": table.column("node"), "d": pa.array(d)})


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", beam: int | None = None, degree: int = DEGREE) -> DataFrame:
    """For each id in queries (one column, a row of vectors): its k nearest others: query_id, rank, vec_id, score.

    score is the Euclidean distance in double precision on the original vectors; ties go to the smaller id; with fewer
    candidates all are returned. Null vectors, those with null or non-finite components, zero vectors and vectors of another
    length than most take no part, neither as queries nor as candidates; nor do null ids. Rows of one id count once (the
    smallest vector). Copies of one vector are candidates each. Empty table: empty result. Other columns are not read.
    """
    integral(vectors, id_col)
    rows = materialise(usable(vectors, id_col, vec_col), "vectors")
    classes = materialise(rows.groupBy("v").agg(F.min("id").alias("u")), "classes")
    width = 4 if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else 8
    packed = materialise(classes.select("u", "v").mapInArrow(lambda it: _packed(it, width), "u long, v binary"), "packed")
    nodes = materialise(at_homes(packed), "nodes")
    discard(packed)
    beam = beam or int(BEAM * max(1.0, np.log2(max(nodes.count(), 2)) / np.log2(BEAM_NODES)))
    of_node = rows.join(classes, "v").select("u", "id")
    graph = build_graph(nodes, degree)
    turned = smallest(graph.select(F.col("w").alias("u"), F.col("u").alias("w"), "d"), ["u"], ["d", "w"], BACK)
    linked = materialise(graph.select("u", "w").unionAll(turned.select("u", "w")).groupBy("u").agg(F.collect_set("w").alias("ws")), "links")
    wanted = queries.select(F.col(queries.columns[0]).cast("long").alias("id")).distinct()
    asked = materialise(wanted.join(of_node, "id").join(nodes, "u").select(F.col("id").alias("query"), "u", F.col("v").alias("qv")), "asked")
    # the beam begins with the query's node and that node's neighbours, whose distances the graph knows
    own = asked.select("query", F.col("u").alias("node"), F.lit(0.0).alias("d"), F.lit(True).alias("seen"))
    first = asked.join(graph, "u").select("query", F.col("w").alias("node"), "d", F.lit(False).alias("seen"))
    held = materialise(own.unionAll(first), "beam")
    while not held.where("not seen").isEmpty():  # the beam only gets nearer, so it settles
        after = materialise(_step(held, linked, nodes, asked, beam), "beam")
        discard(held)
        held = after
    exact = held.select("query", "node").join(classes, F.col("node") == F.col("u")).select("query", "node", "v")
    own = asked.select("query", "u").join(classes, "u").select("query", F.col("v").alias("qv"))
    measured = exact.groupBy("query").cogroup(own.groupBy("query")).applyInArrow(_measured, "query long, node long, d double")
    copies = smallest(of_node, ["u"], ["id"], k + 1)
    found = measured.join(copies, F.col("node") == F.col("u")).where("id <> query").select("query", "id", "d")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("d", "id"))
    out = materialise(found.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), F.col("d").alias("score")), "found")
    for old in (rows, classes, nodes, graph, linked, asked, held):
        discard(old)
    return out


def _step(held: DataFrame, linked: DataFrame, nodes: DataFrame, asked: DataFrame, beam: int) -> DataFrame:
    """The beams after a look at the neighbours of all nodes that were not looked at. held: (query, node, d, seen)."""
    fresh = held.where("not seen").join(linked, F.col("node") == F.col("u")).select("query", F.explode("ws").alias("node")).distinct()
    fresh = fresh.join(held.select("query", "node"), ["query", "node"], "left_anti")
    pairs = fresh.join(nodes.select(F.col("u").alias("node"), "h"), "node").select("h", "query", "node")
    pairs = materialise(pairs, "pairs")
    load = pairs.groupBy("h").agg(F.ceil(F.count("*") / ASKED).alias("parts"))
    pairs_at = pairs.join(load, "h").select(F.xxhash64("h", F.pmod(F.xxhash64("query"), F.col("parts"))).alias("g"), "query", "node")
    worst = held.groupBy("query").agg(F.when(F.count("*") >= beam, F.max("d")).otherwise(float("inf")).alias("far"))
    minds = asked.select(F.col("query").alias("id"), F.col("qv").alias("v")).join(worst.withColumnRenamed("query", "id"), "id")
    of_queries = pairs_at.select(F.col("g").alias("at"), F.col("query").alias("q")).distinct().join(minds, F.col("q") == F.col("id")).select("at", F.lit(True).alias("is_query"), "id", "v", "far")
    of_nodes = pairs_at.select(F.col("g").alias("at"), F.col("node").alias("n")).distinct().join(nodes.select(F.col("u").alias("id"), "v"), F.col("n") == F.col("id")).select("at", F.lit(False).alias("is_query"), "id", "v", F.lit(0.0).alias("far"))
    met = pairs_at.groupBy("g").cogroup(of_queries.unionAll(of_nodes).groupBy("at")).applyInArrow(_approach, "query long, node long, d double")
    both = held.withColumn("seen", F.lit(True)).unionByName(met.withColumn("seen", F.lit(False)))
    rank = F.row_number().over(Window.partitionBy("query").orderBy("d", "node"))
    return both.withColumn("_rank", rank).where(F.col("_rank") <= beam).drop("_rank")
