"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents are summed by membership pattern (the set of sources that they belong to); a flow network routes each pattern's
words to the sources' quotas. The first repetition of a pattern costs nothing, every further one costs more (convex), so
words are repeated only where a quota can't be met otherwise. Within a pattern, a seeded order of the documents says which
of them take each source's share: they are laid out in that order, and the flows cut the line into stretches.

Scale: the running total over a pattern's line goes in two steps, over the sums of 16 ** BUCKET_DIGITS buckets of the seeded
key and within each bucket, so no task holds a source's documents, however hot the source.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.llm.common import materialise

#: Hex digits of the seeded key that name a bucket, most patterns that the driver takes, words as the contract counts them.
BUCKET_DIGITS, MAX_PATTERNS = 3, 100_000
WORDS = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of runs of characters other than blanks; 0 of null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def reshared(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Targets in proportion to weights that add up to total; none above most * size, the excess reshared by weight."""
    caps = [most * s for s in sizes]
    order = sorted(range(len(sizes)), key=lambda i: (caps[i] / weights[i], i))
    out, held, left = [0.0] * len(sizes), 0.0, sum(weights)
    for at, i in enumerate(order):
        if caps[i] * left <= (total - held) * weights[i]:
            out[i] = float(caps[i])
            held, left = held + caps[i], left - weights[i]
        else:
            for j in order[at:]:
                out[j] = (total - held) * weights[j] / left
            break
    return out


def route(patterns: dict[tuple[int, ...], int], quotas: list[int], repeats: int) -> dict[tuple[int, ...], dict[int, list[int]]]:
    """pattern -> source -> words of each repetition. Successive cheapest augmenting paths with potentials.

    Arcs: start -> pattern, one for each repetition k with capacity size and cost k * k; pattern -> its sources, free;
    source -> end with the quota. Fills as much of the quotas as can be filled, at the least cost of repeats.
    """
    keys = sorted(patterns)
    n = 2 + len(keys) + len(quotas)
    graph: list[list[list[int]]] = [[] for _ in range(n)]  # to, capacity, cost, index of the way back

    def arc(a: int, b: int, capacity: int, cost: int) -> list[int]:
        graph[a].append([b, capacity, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])
        return graph[a][-1]

    entry = {p: [arc(0, 2 + i, patterns[p], k * k) for k in range(repeats)] for i, p in enumerate(keys)}
    used = {(p, s): arc(2 + i, 2 + len(keys) + s, repeats * patterns[p], 0) for i, p in enumerate(keys) for s in p}
    for s, q in enumerate(quotas):
        arc(2 + len(keys) + s, 1, q, 0)
    potential = [0] * n
    while True:
        far, came = [float("inf")] * n, [None] * n
        far[0], heap = 0, [(0, 0)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for e in graph[a]:
                if e[1] > 0 and (x := d + e[2] + potential[a] - potential[e[0]]) < far[e[0]]:
                    far[e[0]], came[e[0]] = x, (a, e)
                    heapq.heappush(heap, (x, e[0]))
        if came[1] is None:
            break
        potential = [p + d if d < float("inf") else p for p, d in zip(potential, far, strict=True)]
        path, at = [], 1
        while at:
            at, e = came[at]
            path.append(e)
        flow = min(e[1] for e in path)
        for e in path:
            e[1] -= flow
            graph[e[0]][e[3]][1] += flow
    out: dict[tuple[int, ...], dict[int, list[int]]] = {}
    for p in keys:
        taken = [patterns[p] - e[1] for e in entry[p]]
        shares = {s: repeats * patterns[p] - used[p, s][1] for s in p}
        out[p] = {s: [0] * repeats for s in p}
        k = 0
        for s in p:
            while shares[s] and k < repeats:
                f = min(shares[s], taken[k])
                out[p][s][k] += f
                shares[s], taken[k] = shares[s] - f, taken[k] - f
                k += taken[k] == 0
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: str = "mix") -> DataFrame:
    """One row per input row: the id, size, source_size, target, taken, and the share of taken each source gets (by_source).

    source_col: a string, or an array of strings for overlapping sources. Sources ordered by code point, null last, take
    weights in turn. All quotas together are share times the words of all documents; each stops at most times its source's
    words, the excess reshared. taken is size times the number of times that the mix takes the document, at most `most`.
    source_size and target are those of the document's source (of several: their sums).

    Null or empty text has size 0 and is never taken. Null source: a source of its own, last. Null ids and repeated rows are
    documents of their own; rows that agree in id, source and size share a place in the order, which one is taken first is
    not told apart. Reruns agree: the order is md5 of seed and id. Empty table: empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    many = isinstance(docs.schema[source_col].dataType, T.ArrayType)
    of = F.array_sort(F.array_distinct(F.col(source_col))) if many else F.array(F.col(source_col))
    of = F.when(F.col(source_col).isNull() | (F.size(of) == 0), F.array(F.lit(None).cast("string"))).otherwise(of) if many else of
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    rows = docs.select(F.col(id_col), words(F.col(text_col)).alias("size"), of.alias("_of"), key.alias("_key")).withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    rows = materialise(rows, "mix")  # sizes and keys without the texts, read several times below
    sums = rows.groupBy("_of").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    names = sorted({s for r in sums for s in r._of}, key=lambda s: (s is None, s or ""))
    place = {s: i for i, s in enumerate(names)}
    sizes = [0] * len(names)
    patterns: dict[tuple[int, ...], int] = defaultdict(int)
    for r in sums:
        p = tuple(sorted(place[s] for s in r._of))
        patterns[p] += r["size"]
        for s in p:
            sizes[s] += r["size"]
    turn = [float(weights[i % len(weights)]) for i in range(len(names))]
    targets = reshared(sizes, turn, share * sum(patterns.values()), most)
    flows = route(patterns, [int(t) for t in targets], most)
    # each pattern's line of documents is laid out `most` times; a source's stretch of a repetition is [from, to)
    cuts = []
    for p, by in flows.items():
        for k in range(most):
            at = 0
            for s in p:
                if by[s][k]:
                    cuts.append(([names[i] for i in p], k, names[s], at, at + by[s][k]))
                    at += by[s][k]
    schema = "_of array<string>, k int, source string, a long, b long"
    facts = spark.createDataFrame([([names[i] for i in p], sum(sizes[i] for i in p), float(sum(targets[i] for i in p))) for p in patterns], "_of array<string>, source_size long, target double")
    stretches = spark.createDataFrame(cuts, schema).groupBy("_of").agg(F.collect_list(F.struct("k", "source", "a", "b")).alias("_cuts"))
    # nulls in _of keep arrays from joining by value: join on their JSON. Both sides are bounded by MAX_PATTERNS.
    name = F.to_json(F.struct(F.transform("_of", lambda x: F.coalesce(F.concat(F.lit("s"), x), F.lit("n"))).alias("p")))
    facts = facts.withColumn("_p", name).drop("_of").join(stretches.withColumn("_p", name).drop("_of"), "_p", "left")
    rows = rows.withColumn("_p", name)
    bucket = rows.groupBy("_p", "_bucket").agg(F.sum("size").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy("_p").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bucket = bucket.select("_p", "_bucket", before.alias("_before")).join(facts, "_p", "left")
    # the join deals rows out by pattern and bucket; the running total needs no other exchange
    line = Window.partitionBy("_p", "_bucket").orderBy("_key", "size", id_col).rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("_before") + F.coalesce(F.sum("size").over(line), F.lit(0)) + F.col("size") / 2
    got = F.filter(F.coalesce("_cuts", F.array().cast(stretches.schema["_cuts"].dataType)), lambda c: (F.col("size") > 0) & (c.a <= F.col("_mid")) & (F.col("_mid") < c.b))
    return rows.join(bucket, ["_p", "_bucket"]).withColumn("_mid", middle).withColumn("_got", got).select(
        F.col(id_col), "size", "source_size", "target", (F.size("_got") * F.col("size")).cast("long").alias("taken"), F.transform("_got", lambda c: c.source).alias("by_source")
    )
