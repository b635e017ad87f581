"""Joins, search, decontamination, mixing and the pipeline against brute force."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablelog.llm import decontaminate, jaccard_join, mixing, neighbours, quality, queries, secrets
from tablelog.llm.common import fold, table
from tablelog.llm.components import components
from tests.conftest import DATA


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_classes(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows))


def near_copies(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    base = [[rng.choice(words) for _ in range(rng.randint(8, 60))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base)) if rng.random() < 0.7 else [rng.choice(words) for _ in range(rng.randint(0, 12))]
        for _ in range(rng.randint(0, 4)):
            if w:
                w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i * 3, " ".join(w)))
    return [*rows, (10**6, None), (10**6 + 1, ""), (10**6 + 2, "a b"), (10**6 + 3, "A  B\n"), (0, rows[0][1])]


def classes(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("x")).repartition(3)
    return sorted(tuple(r) for r in jaccard_join.classes(df).collect())


def test_classes(spark):
    rows = near_copies(200, 1)
    assert classes(spark, rows) == brute_classes(rows)


def test_classes_over_blocks(spark, monkeypatch):
    for name, value in (("BLOCK", 300), ("GROUP", 8), ("LEADERS", 2), ("COUNTED", 500), ("SENT", 400)):
        monkeypatch.setattr(jaccard_join, name, value)
    rows = near_copies(150, 2)
    assert classes(spark, rows) == brute_classes(rows)


def test_classes_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, DATA, "documents").collect()]
    assert sorted(tuple(r) for r in queries.op7_jaccard_join(spark, DATA).collect()) == brute_classes(rows)


def test_classes_edges(spark):
    assert classes(spark, [(1, None)]) == [(1, 0, 1)]
    assert spark.createDataFrame([], "doc_id long, text string").transform(jaccard_join.classes).count() == 0
    df = spark.createDataFrame([(5, "a b c d e f"), (None, "a b c d e f"), (None, "q")], "doc_id long, text string")
    assert sorted((tuple(r) for r in jaccard_join.classes(df).collect()), key=str) == [(5, 2, 5), (None, 1, None), (None, 2, 5)]
    kept = jaccard_join.one_of_each(df.unionAll(df).withColumn("more", F.lit(1)))
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id is not null").collect()) == [(5, "a b c d e f")]
    with pytest.raises(TypeError):
        jaccard_join.classes(df.withColumn("doc_id", F.lit("x")))


def test_entries_that_agree_in_their_bits():
    """Two shingles of a set that an entry can't tell apart don't cost it one of its shared entries."""
    import pyarrow as pa

    low = np.uint64(7)
    text = pa.RecordBatch.from_arrays([pa.array([" ".join(f"w{k}" for k in range(30))])], names=["_text"])
    real = jaccard_join.shingle_set
    try:
        jaccard_join.shingle_set = lambda *_: np.sort(np.array([low, low + np.uint64(1 << 33), *((1 << 40) + (k << 8) for k in range(18))], np.uint64))
        sent = list(jaccard_join._prefixes(iter([text]), np.zeros(0, np.uint64), np.zeros(0, np.int64), 1, 5, 75))
    finally:
        jaccard_join.shingle_set = real
    keys = np.concatenate([np.frombuffer(k, np.uint32) for b in sent for k in b.column("keys").to_pylist()])
    assert len(np.unique(keys)) == jaccard_join.prefix_length(20) and len(keys) == len(np.unique(keys)) + 1


def test_groups_keep_nothing_for_lone_shingles():
    """The groups of a range are those of a plain count, in bounded memory: most shingles are of one set."""
    import tracemalloc
    from collections import Counter, defaultdict

    import pyarrow as pa

    r = np.random.default_rng(3)
    key = np.r_[r.permutation(1 << 20)[:90_000], np.repeat(np.arange(1 << 20, (1 << 20) + 4_000), 3)].astype(np.uint32)
    number = np.r_[r.integers(-(1 << 62), 1 << 62, 90_000), r.integers(-(1 << 62), 1 << 62, (500, 3))[np.arange(4_000) % 500].ravel()]
    key[:300] = 5  # a frequent one
    told = pa.table({"keys": pa.array([key[k::50].tobytes() for k in range(50)], pa.binary()), "sets": pa.array([number[k::50].tobytes() for k in range(50)], pa.binary())})
    tracemalloc.start()
    got = jaccard_join._groups(told)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    by_key = defaultdict(set)
    for k, n in zip(key.tolist(), number.tolist(), strict=True):
        by_key[k].add(n)
    want = Counter(tuple(sorted(x)) for x in by_key.values() if len(x) > 1)
    assert {tuple(x): k for x, k in zip(got.column("sets").to_pylist(), got.column("k").to_pylist(), strict=True)} == want and max(map(len, want)) >= 300
    assert peak < 65 * len(key)


def test_little_is_held_while_prefixes_are_made(monkeypatch):
    """Counts and prefix entries are right, and a worker holds few bytes for each: not whole sets behind their prefixes."""
    import tracemalloc
    from collections import Counter

    import pyarrow as pa

    monkeypatch.setattr(jaccard_join, "SENT", 1 << 30)
    monkeypatch.setattr(jaccard_join, "COUNTED", 1 << 30)
    r = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in r.integers(0, 300, 2_000)) for _ in range(150)]
    texts += [" ".join(texts[0].split()[:900] + texts[1].split()[:900])] * 2
    batch = pa.record_batch({"id": range(len(texts)), "text": texts})
    sets = {t: jaccard_join.shingle_set(t, jaccard_join.WordHash()) for t in texts}

    def run(rows):
        tracemalloc.start()
        out = list(rows)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, peak

    (_, told), peak = run(jaccard_join._facts(iter([batch]), 5))
    want = {h: c for h, c in Counter(h for a in sets.values() for h in a.astype(np.int64).tolist()).items() if c > 1}
    assert want and dict(zip(told.column("h").to_pylist()[0], told.column("c").to_pylist()[0], strict=True)) == want
    assert peak < 30 * sum(map(len, sets.values()))
    (sent,), peak = run(jaccard_join._prefixes(iter([batch.select(["text"])]), np.zeros(0, np.uint64), np.zeros(0, np.int64), 64, 5, 75))
    got = [(r, k, s) for r, k, s in zip(*(c.to_pylist() for c in sent.columns), strict=True) for k, s in zip(np.frombuffer(k, np.uint32).tolist(), np.frombuffer(s, np.int64).tolist(), strict=True)]
    firsts = {t: a[: jaccard_join.prefix_length(len(a))] for t, a in sets.items()}
    assert sorted(got) == sorted((int(h) >> 58, int(h) & 0xFFFFFFFF, jaccard_join.set_number(sets[t])) for t, a in firsts.items() for h in a)
    assert peak < 65 * len(got)


def test_ranges_grow_with_the_entries(spark, monkeypatch):
    """However many entries there are, a range holds RANGE of them or so; the number of ranges changes no result."""
    facts = spark.createDataFrame([(100, 1)] * 3000 + [(1, 2), (0, None)], "n long, s long").repartition(1)
    monkeypatch.setattr(jaccard_join, "RANGE", 500)
    assert jaccard_join._ranges(facts, 64, 75) == -(-(3000 * 27 + 1) // 500)
    assert jaccard_join._ranges(facts.where("s is null"), 64, 75) == 64
    docs = table(spark, DATA, "documents")
    many = sorted(map(tuple, jaccard_join.classes(docs).collect()))
    monkeypatch.setattr(jaccard_join, "RANGE", 1 << 30)
    assert many == sorted(map(tuple, jaccard_join.classes(docs).collect()))


def test_one_of_each_with_any_names(spark):
    """Extra columns named as anything, and a very long text, go through."""
    long = " ".join(f"word{k}" for k in range(60_000))
    rows = [(1, long, "a", 1, "b", "c"), (2, long + " more", "a", 2, "b", "c"), (3, "x y", "a", 3, "b", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _kept string, _row_of_id long, k string, row string").select("*", F.lit(1).alias("n"), F.lit(2).alias("i"), F.lit(3).alias("t"))
    got = jaccard_join.one_of_each(df)
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == [1, 3]
    leaks = decontaminate.find_leaks(df, spark.createDataFrame([(1, " ".join(f"word{k}" for k in range(70, 90)))], "item_id long, text string"))
    assert sorted((r.doc_id, r.n_covered) for r in leaks.collect()) == [(1, 20), (2, 20)]
    taken = mixing.mix(df.withColumn("source", F.lit("s"))).collect()
    assert sorted((r.doc_id, r["size"]) for r in taken) == [(1, 60_000), (2, 60_001), (3, 2)]


def test_trie_against_all_pairs():
    rng = random.Random(7)
    for _ in range(60):
        base = rng.sample(range(10_000), 40)
        sets = []
        for _ in range(rng.randint(2, 25)):
            s = set(rng.sample(base, rng.randint(20, 40))) | set(rng.sample(range(10_000), rng.randint(0, 8)))
            sets.append(np.array(sorted(s), np.uint64))
        n = len(sets)
        got = jaccard_join.join_block(list(range(n)), [s.tobytes() for s in sets], list(range(n)), [True] * n)
        label = list(range(n))
        for i in range(n):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((label[i], label[j]))
                    label = [a if x == b else x for x in label]
        assert got == label


def test_bitmaps_never_dismiss():
    rng = np.random.default_rng(1)
    for n in (3, 50, 700):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = a.copy()
        b[: n // 8] = rng.integers(0, 1 << 63, n // 8).astype(np.uint64)
        maps = [jaccard_join.bitmap(a), jaccard_join.bitmap(b)]
        assert jaccard_join.may_link(np.array([1, 2]), np.array([n, n]), maps) == [(1, 2)]
    far = [rng.integers(0, 1 << 63, 300).astype(np.uint64) for _ in range(2)]
    assert jaccard_join.may_link(np.array([1, 2]), np.array([300, 300]), [jaccard_join.bitmap(x) for x in far]) == []


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {x: y for x, y in label.items() if any(x in e and e[0] != e[1] for e in edges)}


def exact_neighbours(ids, x, q, k=10):
    d = np.sqrt(((x - x[list(ids).index(q)]) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
    return [(int(ids[i]), float(d[i])) for i in order]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    d = f"/root/testdata/{sf}"
    p = table(spark, d, "embeddings").toPandas()
    ids, x = p.vec_id.to_numpy(), np.array(p.embedding.tolist(), np.float64)
    rows = queries.op6_neighbours(spark, d).collect()
    hit = total = 0
    for q in ids[ids % 100 == 0]:
        want = dict(exact_neighbours(ids, x, q))
        got = sorted((r["rank"], r.vec_id, r.score) for r in rows if r.query_id == q)
        assert [g[0] for g in got] == list(range(1, 11))
        assert all(abs(s - np.sqrt(((x[list(ids).index(v)] - x[list(ids).index(q)]) ** 2).sum())) < 1e-12 for _, v, s in got)
        hit, total = hit + len({v for _, v, _ in got} & want.keys()), total + 10
    assert hit >= 0.95 * total


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [float(k), 1.0]) for k in range(6)] + [(100 + k, [3.0, 1.0]) for k in range(20)] + [(200, None), (201, [0.0, 0.0]), (202, [nan, 1.0]), (203, [inf, 1.0]), (204, [None, 1.0]), (205, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    asked = df.select("vec_id").where("vec_id in (0, 3, 200, 202)")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.search(df, asked).collect())
    assert [g[2:] for g in got if g[0] == 3] == [(100 + k, 0.0) for k in range(10)]
    assert [g[2:] for g in got if g[0] == 0] == [(1, 1.0), (2, 2.0), (3, 3.0), *((100 + k, 3.0) for k in range(7))]
    assert {g[0] for g in got} == {0, 3}
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in neighbours.search(few, few.select("vec_id").where("vec_id = 0")).collect()] == [(0, 1, 1, 1.0)]
    assert neighbours.search(few.limit(0), few.select("vec_id").limit(0)).count() == 0


def test_neighbours_of_near_copies(spark):
    """Thousands of near copies, nearer to each other than a byte a component could tell."""
    rng = np.random.default_rng(5)
    x = (lambda v: v / np.abs(v).max())(rng.normal(size=64)) + rng.normal(scale=0.001, size=(3000, 64))
    for kind in ("float", "double"):
        v = x.astype(np.float32).astype(np.float64) if kind == "float" else x * np.r_[1e9, np.ones(63)]  # one dominant component
        df = spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(v)], f"vec_id long, embedding array<{kind}>")
        got = {(r.query_id, r.vec_id) for r in neighbours.search(df, df.select("vec_id").where("vec_id % 100 = 0")).collect()}
        want = {(q, n) for q in range(0, 3000, 100) for n, _ in exact_neighbours(np.arange(3000), v, q)}
        assert len(got) == len(want) and len(got & want) >= 0.95 * len(want)


def test_neighbours_start_follows_size():
    for n in (1, 2, 500, 51_282, 10**6, 10**8):
        d = neighbours._depth(n)
        assert d == neighbours.DEEPEST or d < neighbours.DEEPEST and (n <= neighbours.LEAF << d or n <= neighbours.GROUP << d)
    x = np.random.default_rng(1).normal(size=(5000, 8))
    groups = list(neighbours._groups(x, 3))
    assert max(map(len, groups)) <= neighbours.GROUP and sorted(np.concatenate(groups)) == list(range(5000))


def test_best_of_a_home():
    """Each pair once, of each node its nearest, whatever order and copies they come in."""
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 9, 400), rng.integers(0, 30, 400)
    d = (a * 31 + b * 17) % 23 + 0.0
    got = neighbours._best([(a[:100], b[:100], d[:100]), (a[100:], b[100:], d[100:])], 5)
    want = sorted((x, y, z) for u in range(9) for x, z, y in sorted({(int(i), float(k), int(j)) for i, j, k in zip(a, b, d) if i == u})[:5])
    assert sorted(zip(*(g.tolist() for g in got))) == want


def test_meetings_give_no_loops(spark):
    import pyarrow as pa

    lists = pa.table({"h": [0] * 5, "u": [1, 1, 1, 2, 2], "w": [3, 4, 3, 4, 5], "new": [True, False, False, False, False]})
    packed = neighbours.pack(np.array([[2.0], [0.0], [1.0]]))
    rows = [(np.array([5, 3]), packed[:2]), (np.array([4]), packed[2:])]
    told = pa.table({"at": [0, 0], "xs": [x.tobytes() for x, _ in rows], "xvs": [b"".join(v) for _, v in rows], "xfars": [np.full(len(x), 9.0).tobytes() for x, _ in rows]})
    assert neighbours._meet(lists, told, 8).to_pylist() == [{"u": 3, "w": 4, "d": 1.0}, {"u": 4, "w": 3, "d": 1.0}]


def test_unmet_reverse_edges_stay_new(spark):
    """A hub takes BACK of its reverse edges in a round; the others are still to meet its neighbours."""
    many = neighbours.BACK + 7
    graph = spark.createDataFrame([(u, 1000, float(u), True, True) for u in range(many)], "u long, w long, d double, new boolean, back_new boolean")
    turned = graph.select(F.col("w").alias("u"), F.col("u").alias("w"), F.col("back_new").alias("new"), "d")
    back = neighbours.smallest(turned, ["u"], [F.desc("new"), "d", "w"], neighbours.BACK).drop("_rank")
    after = neighbours._kept(neighbours._after(graph, back, graph.select("u", "w", "d").limit(0)), neighbours.DEGREE).collect()
    assert {r.u for r in after if r.back_new} == set(range(neighbours.BACK, many)) and not any(r.new for r in after)


def brute_tiles(item, doc, shortest):
    """Greedy tiling by looking at all pairs of positions."""
    a, b, tiles = [False] * len(item), [False] * len(doc), []
    while True:
        best = []
        for p in range(len(item)):
            for t in range(len(doc)):
                n = 0
                while p + n < len(item) and t + n < len(doc) and item[p + n] == doc[t + n] and not a[p + n] and not b[t + n]:
                    n += 1
                best.append((n, p, t))
        n = max(x[0] for x in best) if best else 0
        if n < shortest:
            return tiles
        for m, p, t in best:
            if m == n and not any(a[p : p + n]) and not any(b[t : t + n]):
                a[p : p + n], b[t : t + n] = [True] * n, [True] * n
                tiles.append((p, t, n))


def test_tiles():
    rng = random.Random(4)
    for _ in range(150):
        item = [rng.randrange(30) for _ in range(rng.randint(5, 25))]
        if rng.random() < 0.3:  # many ties
            item = [x % 3 for x in item]
        doc = [rng.randrange(30) for _ in range(10)]
        for _ in range(rng.randint(1, 4)):
            k = rng.randrange(len(item))
            doc += item[k : k + rng.randint(3, 12)] + [rng.randrange(30) for _ in range(rng.randint(0, 3))]
        got, want = decontaminate.tile(item, doc, [(0, len(doc))], 4), brute_tiles(item, doc, 4)
        assert got == want
        used_p, used_t = set(), set()
        for p, t, n in got:
            assert n >= 4 and item[p : p + n] == doc[t : t + n]
            assert not used_p & set(range(p, p + n)) and not used_t & set(range(t, t + n))
            used_p |= set(range(p, p + n))
            used_t |= set(range(t, t + n))


def test_tiles_of_repetitions_and_long_texts():
    """A word said over and over, and a text far longer than the item, end soon."""
    assert sum(n for _, _, n in decontaminate.tile([1] * 200, [1] * 5000, [(0, 5000)], 5)) == 200
    rng = random.Random(2)
    item, doc = [rng.randrange(1000) for _ in range(300)], [rng.randrange(1000) for _ in range(200_000)]
    doc[150_000:150_000] = item
    assert decontaminate.tile(item, doc, [(0, len(doc))], 5)[0] == (0, 150_000, 300)


def test_leaks(spark, monkeypatch):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    turned = "Nine ten, eleven twelve thirteen fourteen fifteen sixteen. filler words here One two three four five six seven eight!"
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "tiny item"), (5, item)], "item_id long, text string")
    docs = spark.createDataFrame([(10, f"before {item} after"), (11, turned), (12, "one two three four five six other"), (13, None), (14, ""), (10, f"before {item} after"), (None, "a tiny item b"), (15, "tiny other item")], "doc_id long, text string").withColumn("item_id", F.lit("x"))
    for size in (decontaminate.BROADCAST_BYTES, 0):
        got = sorted(((r.doc_id, r.item_id, r.n_tiles) for r in decontaminate.find_leaks(docs, benchmark, broadcast_bytes=size).collect()), key=str)
        assert got == sorted([(10, 1, 1), (10, 5, 1), (10, 1, 1), (10, 5, 1), (11, 1, 2), (11, 5, 2), (None, 4, 1)], key=str)
        assert sorted(r.doc_id for r in decontaminate.without_leaks(docs, benchmark, broadcast_bytes=size).collect()) == [12, 13, 14, 15]
    assert decontaminate.find_leaks(docs.limit(0), benchmark).count() == 0 and decontaminate.find_leaks(docs, benchmark.limit(0)).count() == 0


def test_leaks_of_many_like_items(spark):
    """Items that share most of their seeds, of all lengths, odd columns: equal to tiling every document with every item."""
    rng = random.Random(8)
    stem = "which of the following is the best answer to the question".split()
    items = [(k, " ".join(stem[: rng.randint(0, 11)] + [f"w{rng.randrange(12)}" for _ in range(rng.randint(1, 12))])) for k in range(40)]
    rows = []
    for k in range(60):
        parts = [items[rng.randrange(40)][1].split() for _ in range(3)]
        parts = [p[rng.randrange(3) :] for p in parts] + [[f"x{rng.randrange(50)}" for _ in range(5)]]
        rng.shuffle(parts)
        rows.append((k, " ".join(sum(parts, [])), k, [k]))
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row0 long, _seeds0 array<int>")
    want = set()
    for d, text, _, _ in rows:
        words = decontaminate.tokens(text)
        for i, own in ((i, decontaminate.tokens(t)) for i, t in items):
            k = min(5, len(own))
            if sum(n for _, _, n in brute_tiles(own, words, k)) >= 0.6 * len(own):
                want.add((d, i))
    assert len(want) > 60
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for size in (decontaminate.BROADCAST_BYTES, 0):
        got = decontaminate.find_leaks(docs, benchmark, broadcast_bytes=size).collect()
        assert sorted((r.doc_id, r.item_id) for r in got) == sorted(want)
        kept = decontaminate.without_leaks(docs, benchmark, broadcast_bytes=size)
        assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(60)) - {d for d, _ in want}


def test_leaks_with_a_full_filter(spark, monkeypatch):
    """A filter too small for its seeds lets texts through in vain and loses none."""
    docs, benchmark = table(spark, DATA, "documents"), table(spark, DATA, "benchmark")
    want = sorted(map(tuple, decontaminate.find_leaks(docs, benchmark).collect()))
    lead = decontaminate.Lead(benchmark, "item_id", "text", 5, 0.6, decontaminate.BROADCAST_BYTES)
    monkeypatch.setattr(decontaminate.Lead, "_filter", lambda self: np.full(4, (1 << 64) - 1, np.uint64))
    assert sorted(map(tuple, decontaminate.find_leaks(docs, benchmark).collect())) == want and lead.n_seeds


def test_leaks_of_documents(spark):
    docs, items = table(spark, DATA, "documents").collect(), table(spark, DATA, "benchmark").collect()
    want = set()
    for d in docs:
        words = decontaminate.tokens(d.text)
        for b in items:
            own = decontaminate.tokens(b.text)
            runs = {tuple(own[k : k + 5]) for k in range(len(own) - 4)}
            if any(tuple(words[k : k + 5]) in runs for k in range(len(words) - 4)) and sum(n for _, _, n in brute_tiles(own, words, 5)) >= 0.6 * len(own):
                want.add((d.doc_id, b.item_id))
    assert {(r.doc_id, r.item_id) for r in queries.op8_decontaminate(spark, DATA).collect()} == want


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "conversations"):
        c.sql(f"create view {t} as select * from '/root/testdata/sf0.01/{t}.parquet'")
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.01")
    columns = sorted(df.columns)
    told = c.sql(queries.SQL[name])
    assert sorted(told.columns) == columns
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, told.select(*columns).fetchall()))


def test_route_is_cheapest():
    got = mixing.route({(0,): 10, (0, 1): 10, (1,): 4}, [15, 12], 2)
    by = [sum(x[s][k] for x in got.values() if s in x for k in range(2)) for s in (0, 1)]
    again = sum(x[s][1] for x in got.values() for s in x)
    assert by == [15, 12] and again == 27 - 24
    assert mixing.route({(0,): 3}, [10], 2) == {(0,): {0: [3, 3]}}


def test_reshared():
    assert mixing.reshared([100, 10, 100], [3, 1, 2], 315.0, 2) == [177.0, 20.0, 118.0]
    assert mixing.reshared([], [], 0.0, 2) == [] and mixing.reshared([0], [3.0], 0.0, 2) == [0.0]


def test_mix_overlapping_and_odd(spark):
    rng = random.Random(1)
    rows = [(k, "w " * rng.randint(1, 30), rng.choice([["a"], ["a", "b"], ["b"], [], None, ["c", "a"]])) for k in range(300)] + [(None, None, ["a"]), (1, "w w", ["b"]), (1, "w w", ["b"]), (400, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source array<string>").withColumn("taken", F.lit("x"))
    got = mixing.mix(df).collect()
    assert len(got) == len(rows) and all(r.taken in (0, r["size"], 2 * r["size"]) for r in got)
    assert abs(sum(r.taken for r in got) - 1.5 * sum(r["size"] for r in got)) < 120
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(7)).collect()))
    assert mixing.mix(df.limit(0)).count() == 0


def test_pipeline(spark):
    docs = table(spark, DATA, "documents")
    model = quality.fit(docs, table(spark, DATA, "labels").where(fold(F.col("doc_id")) != 1))
    good = {r.doc_id for r in quality.score(docs, model).where("predicted = 1").collect()}
    kept = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    first = {c for _, _, c in brute_classes(kept)}
    kept = [(i, t) for i, t in kept if i in first]
    bad = {r.doc_id for r in queries.op8_decontaminate(spark, DATA).collect()}
    ratio = secrets.Ratio(secrets.labelled_samples())
    kept = [(i, secrets.redact(t, secrets.scan(t, ratio))) for i, t in kept if i not in bad]
    staged = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        staged = stage(spark, staged, DATA)
        assert staged.columns == docs.columns, name
    assert sorted((r.doc_id, r.text) for r in staged.collect()) == sorted(kept)
    assert all(r.n_chars == len(r.text) for r in staged.collect())
    out = corpus_pipeline.run(spark, DATA).collect()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in kept}
    assert {r.doc_id for r in out} <= set(size) and all(r["size"] == size[r.doc_id] and r.taken in (r["size"], 2 * r["size"]) for r in out)


def test_pipeline_odd(spark, tmp_path):
    """Nulls, empty and repeated rows, extra columns, and empty tables go through all stages."""
    d = str(tmp_path)
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "s", 0, "x"), (3, "a b c d e f g", "en", "s", 13, "x"), (3, "a b c d e f g", "en", "s", 13, "x"), (None, "n o", None, "s", 3, "x"), (4, "token = abcdef1234", "en", None, 18, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, taken string")
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(3, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert corpus_pipeline.run(spark, d).count() >= 2
    e = str(tmp_path / "none")
    for t in ("documents", "labels", "benchmark"):
        table(spark, d, t).limit(0).write.parquet(f"{e}/{t}.parquet")
    assert corpus_pipeline.run(spark, e).count() == 0
