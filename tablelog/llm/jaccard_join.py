"""N-gram Jaccard self-join by prefix trees, exact.

Documents whose sets of word shingles agree to THRESHOLD are linked. Equal sets are one node, however many documents hold
it. The steps:

1. One pass gives each document's set size, set number and a parity bitmap, and the shingles repeated within a task. Their
   sums put shingles in one global order, frequent last (HEAVY of them at most; any order gives the same links).
2. A second pass emits each set's prefix in that order, one shingle longer than need be: two sets that link share two
   shingles of their prefixes. Entries go to ranges of shingle numbers as packed arrays; sets with an equal shingle there are
   a candidate group. A group of two sets that came from one shingle alone goes: if they link, a larger group has both.
3. Within a group of up to GROUP sets, bitmaps bound the symmetric difference from below; what may link is connected. The
   sets of a larger group (very frequent shingles) are all connected: a superset costs work, not results.
4. Connected candidates meet with their whole sets in blocks of BLOCK shingles. A trie holds the block's sets, ordered;
   each set walks it, sharing the overlap counted so far among all sets below a node, leaving subtrees whose remaining
   length can't reach the needed overlap, or that hold nothing but sets it is already connected with.
5. Components that span several blocks: leaders of each block's components meet; whatever is still apart is then compared
   with every block. So links between blocks are all found, and near copies by the million cost linear work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelog.llm.common import bounded_batches, discard, integral, materialise
from tablelog.llm.components import components
from tablelog.llm.shingles import WordHash, mix, set_number, shingle_set

#: Link when 100 * intersection >= PERCENT * union; words of a shingle.
PERCENT, WORDS = 75, 5
#: Most shingles in the frequency order (12 bytes each are broadcast), least count to be in it.
HEAVY, LEAST = 1_000_000, 4
#: Largest candidate group that is sifted by bitmaps; shingles of a block; shingles that a task counts at once.
GROUP, BLOCK, COUNTED = 2048, 400_000, 1_500_000
#: Prefix entries that a task sends at once; about how many a range of shingle numbers gets, however large the input.
SENT, RANGE = 500_000, 250_000
#: Sets of each component of a block that meet those of other blocks first.
LEADERS = 6


def needed(n: int, m: int, percent: int = PERCENT) -> int:
    """Least intersection of linked sets of n and m shingles: 100 i >= p (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Shingles of which linked sets share two: n less the least intersection, and two."""
    return min(n, n - -(-percent * n // 100) + 2)


def bitmap(s: np.ndarray) -> bytes:
    """Parities of the shingles' hash bits, at least two bits a shingle, folded to a power of two: 64 bits to 64 kbit."""
    bits = 64
    while bits < 3 * len(s) and bits < 1 << 16:
        bits *= 2
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def fold_to(maps: list[bytes]) -> np.ndarray:
    """The bitmaps at the size of the smallest, as words: halves are added up modulo two, which keeps the bound valid."""
    size = min(map(len, maps))
    if all(len(m) == size for m in maps):
        return np.frombuffer(b"".join(maps), np.uint64).reshape(len(maps), -1)
    return np.vstack([np.bitwise_xor.reduce(np.frombuffer(m, np.uint64).reshape(-1, size // 8), axis=0) for m in maps])


def may_link(sets: np.ndarray, sizes: np.ndarray, maps: list[bytes], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Star edges that connect all pairs whose sizes and bitmaps allow a link."""
    order = np.argsort(sizes, kind="stable")
    sets, sizes = sets[order], sizes[order].astype(np.int64)
    maps = [maps[i] for i in order]
    out: list[tuple[int, int]] = []
    left = np.arange(len(sets))
    words = fold_to(maps) if len(maps[0]) * 4 >= len(maps[-1]) else None
    while len(left):
        root, left = int(left[0]), left[1:]
        queue = [root]
        while queue and len(left):
            x = queue.pop()
            n = sizes[x]
            near = (100 * np.minimum(sizes[left], n) >= percent * np.maximum(sizes[left], n)).nonzero()[0]
            if not len(near):
                continue
            to = left[near]
            if words is not None:
                apart = np.bitwise_count(words[to] ^ words[x]).sum(1)
            else:
                pair = [fold_to([maps[x], maps[t]]) for t in to]
                apart = np.array([np.bitwise_count(p[0] ^ p[1]).sum() for p in pair])
            both = n + sizes[to]
            # the symmetric difference of linked sets is n + m - 2 i
            close = apart.astype(np.int64) <= both - 2 * (-(-percent * both // (100 + percent)))
            if close.any():
                out += [(int(sets[root]), int(sets[t])) for t in to[close]]
                queue += to[close].tolist()
                left = np.delete(left, near[close])
    return out


class Node:
    """A trie node: a run of tokens, the sets that end here, the sizes and labels of the sets below."""

    __slots__ = ("children", "end", "labels", "longest", "run", "shortest")

    def __init__(self, run: list[int], shortest: int, longest: int) -> None:
        self.run, self.children, self.end, self.labels = run, {}, -1, set()
        self.shortest, self.longest = shortest, longest


class Trie:
    """Path-compressed prefix tree of ordered sets that links each new set with what it holds, by union and find."""

    def __init__(self, sizes: list[int], parent: list[int], percent: int = PERCENT) -> None:
        self.root, self.sizes, self.parent, self.percent = Node([], 1 << 60, 0), sizes, parent, percent

    def find(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def insert(self, i: int, tokens: list[int]) -> None:
        node, at, n, label = self.root, 0, len(tokens), self.find(i)
        while True:
            node.labels.add(label)
            node.shortest, node.longest = min(node.shortest, n), max(node.longest, n)
            if at == n:
                node.end = i
                return
            child = node.children.get(tokens[at])
            if child is None:
                node.children[tokens[at]] = leaf = Node(tokens[at:], n, n)
                leaf.end = i
                leaf.labels.add(label)
                return
            run, k = child.run, 1
            most = min(len(run), n - at)
            while k < most and run[k] == tokens[at + k]:
                k += 1
            if k < len(run):  # split the run
                upper = Node(run[:k], child.shortest, child.longest)
                upper.labels = set(child.labels)
                child.run = run[k:]
                upper.children[run[k]] = child
                node.children[tokens[at]] = child = upper
            node, at = child, at + k

    def link(self, i: int, tokens: list[int]) -> None:
        """Unite i with every set here that it links with and is not yet connected with."""
        n, own, find, percent = len(tokens), set(tokens), self.find, self.percent
        least, most = -(-percent * n // 100), 100 * n // percent
        place = {t: n - k - 1 for k, t in enumerate(tokens)}  # tokens of i that follow
        mine = find(i)
        stack = [(self.root, 0, 0, n)]
        while stack:
            node, overlap, depth, after = stack.pop()
            node.labels = labels = {find(x) for x in node.labels}
            if len(labels) == 1 and mine in labels:
                continue
            if node.longest < least or node.shortest > most:
                continue
            if node.run:
                shared = own.intersection(node.run)
                if shared:
                    overlap += len(shared)
                    after = place[max(shared)]
                depth += len(node.run)
            small = max(node.shortest, least)
            if overlap + min(after, min(node.longest, most) - depth) < -(-percent * (n + small) // (100 + percent)):
                continue
            if node.end >= 0 and 100 * overlap >= percent * (n + self.sizes[node.end] - overlap) and (other := find(node.end)) != mine:
                self.parent[max(other, mine)] = mine = min(other, mine)
            first = []
            for token, child in node.children.items():
                (first if token in own else stack).append((child, overlap, depth, after))
            stack += first


def join_block(numbers: list[int], packed: list[bytes], labels: list[int], probes: list[bool], percent: int = PERCENT) -> list[int]:
    """The smallest set number that each set is connected with inside the block. labels: already connected; probes: sets
    that look for links (in a first round all)."""
    n = len(numbers)
    arrays = [np.frombuffer(p, np.uint64) for p in packed]
    tokens, at, counts = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
    place = np.empty(len(tokens), np.int64)
    place[np.lexsort((tokens, -counts))] = np.arange(len(tokens))  # the most shared first: that is what a trie can share
    ranked = np.split(place[at], np.cumsum([len(a) for a in arrays])[:-1])
    parent = list(range(n))
    trie = Trie([len(a) for a in arrays], parent, percent)
    seen: dict[int, int] = {}
    for i, x in enumerate(labels):
        parent[i] = seen.setdefault(x, i)
    lists = [np.sort(r).tolist() for r in ranked]
    if all(probes):
        for i in range(n):
            if i:
                trie.link(i, lists[i])
            trie.insert(i, lists[i])
    else:
        for i in range(n):
            trie.insert(i, lists[i])
        for i in range(n):
            if probes[i]:
                trie.link(i, lists[i])
    least: dict[int, int] = {}
    for i in range(n):
        r = trie.find(i)
        least[r] = min(least.get(r, labels[i]), labels[i])
    return [least[trie.find(i)] for i in range(n)]


def _facts(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    known, held, n_held = WordHash(), [], 0
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = ["id", "n", "s", "map", "h", "c"]

    def repeated() -> pa.RecordBatch:
        a = np.concatenate(held)
        held.clear()
        a.sort()
        h, c = np.unique(a[1:][a[1:] == a[:-1]], return_counts=True)  # all but the first of each
        h, c = h.astype(np.int64), (c + 1).astype(np.int32)
        pieces = range(0, len(h), 50_000)
        values = [[None] * len(pieces)] * 4 + [[h[i : i + 50_000] for i in pieces], [c[i : i + 50_000] for i in pieces]]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=names)

    for batch in batches:
        n, s, maps, seen = [], [], [], set()
        for x in batch.column(1):
            a = shingle_set(x.as_py() or "", known, words)
            n.append(len(a))
            s.append(set_number(a) if len(a) else None)
            maps.append(bitmap(a) if len(a) else None)
            if len(a) and s[-1] not in seen:  # equal sets count once in a batch
                seen.add(s[-1])
                held.append(a)
                n_held += len(a)
                if n_held >= COUNTED:
                    yield repeated()
                    n_held = 0
        none = [None] * len(n)
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip([batch.column(0).to_pylist(), n, s, maps, none, none], kinds, strict=True)], names=names)
    if held:
        yield repeated()


def _entry(a: np.ndarray, ranges: int) -> np.ndarray:
    """What a prefix entry is known by: its range, and its low 32 bits."""
    return ((a >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)) << np.uint64(32) | a & np.uint64(0xFFFFFFFF)


def _prefixes(batches: Iterator[pa.RecordBatch], heavy: np.ndarray, counts: np.ndarray, ranges: int, words: int, percent: int) -> Iterator[pa.RecordBatch]:
    known, seen = WordHash(), set()
    keys: list[np.ndarray] = []  # entries: range, and low 32 bits
    numbers: list[int] = []
    held = 0

    def send() -> pa.RecordBatch:
        # what is held goes as it is copied, and the columns are views: workers of an executor share its memory
        number = np.repeat(np.array(numbers, np.int64), [len(k) for k in keys])
        key = np.concatenate(keys)
        keys.clear()
        numbers.clear()
        r = (key >> np.uint64(32)).astype(np.int32)
        key = key.astype(np.uint32)
        order = np.argsort(r, kind="stable")
        key, number, r = key[order], number[order], r[order]
        at = np.r_[0, np.flatnonzero(np.diff(r)) + 1, len(r)]
        packed = (pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * x.itemsize).astype(np.int32)), pa.py_buffer(x)]) for x in (key, number))
        return pa.RecordBatch.from_arrays([pa.array(r[at[:-1]], pa.int32()), *packed], names=["r", "keys", "sets"])

    for batch in batches:
        for x in batch.column(0):
            a = shingle_set(x.as_py() or "", known, words)
            if not len(a) or (s := set_number(a)) in seen:
                continue
            seen.add(s)  # equal sets of a stretch of rows go once
            weight = np.zeros(len(a), np.int64)
            if len(heavy):
                at = np.searchsorted(heavy, a)
                at[at == len(heavy)] = 0
                weight = np.where(heavy[at] == a, counts[at], 0)
            ranked, want = a[np.lexsort((a, weight))], prefix_length(len(a), percent)
            size = want
            # entries are told apart by range and 32 bits: where two of a prefix agree in both, it takes one more for each
            while size < len(a) and (distinct := len(np.unique(_entry(ranked[:size], ranges)))) < want:
                size = min(len(a), size + want - distinct)
            keys.append(_entry(ranked[:size], ranges))
            numbers.append(s)
            held += size
            if held > SENT:
                yield send()
                held = 0
                seen.clear()
    if held:
        yield send()


def _groups(table: pa.Table) -> pa.Table:
    """Sets that share a prefix shingle: an array for each distinct group, and how many shingles it came from."""
    key = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint32)
    number = np.frombuffer(b"".join(table.column("sets").to_pylist()), np.int64)
    order = np.lexsort((number, key))
    key, number = key[order], number[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (number[1:] != number[:-1])]
    key, number = key[new], number[new]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    shared = np.flatnonzero(sizes > 1)  # most shingles are of one set: nothing is kept for them
    shared = shared[np.argsort(sizes[shared], kind="stable")]
    sets, lengths, counts = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)], [np.zeros(0, np.int64)]
    for at in np.split(shared, np.flatnonzero(np.diff(sizes[shared])) + 1) if len(shared) else []:
        size = sizes[at[0]]
        rows = number[starts[at][:, None] + np.arange(size)]
        # equal groups lie together unless others have their hash; what that leaves apart is added up later
        rows = rows[np.argsort(mix(rows.view(np.uint64)).sum(1), kind="stable")]
        first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(1)])
        sets.append(rows[first].ravel())
        lengths.append(np.full(len(first), size))
        counts.append(np.diff(np.r_[first, len(rows)]))
    offsets = pa.array(np.cumsum(np.concatenate(lengths)), pa.int32())
    return pa.table({"sets": pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets))), "k": pa.array(np.concatenate(counts))})


def _ranges(facts: DataFrame, least: int, percent: int) -> int:
    """How many ranges share out the prefix entries of these sets, RANGE or so to each; equal sets are counted singly."""
    prefix = F.least(F.col("n"), F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 2)
    entries = facts.where("s is not null").agg(F.sum(prefix)).first()[0] or 0
    return max(least, -(-int(entries) // RANGE))


def _runs(batches: Iterator[pa.RecordBatch], n_keys: int = 1) -> Iterator[pa.Table]:
    """Rows of equal first columns together; the input is sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(k).to_pylist() for k in range(n_keys)), strict=True))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == 0 and held and tuple(held[-1].column(k)[held[-1].num_rows - 1].as_py() for k in range(n_keys)) != keys[0] or a > 0:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _sift(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    out: list[tuple[int, int]] = []
    send = lambda: pa.RecordBatch.from_arrays([pa.array([e[k] for e in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
    for run in _runs(batches):
        if run.num_rows > 1:
            out += may_link(np.array(run.column("s")), np.array(run.column("n")), run.column("map").to_pylist(), percent)
        if len(out) > 50_000:
            yield send()
            out = []
    yield send()


def _bitset(keys: DataFrame) -> np.ndarray:
    """A bit for each key (longs) at its hash: 16 bits a key, 8 MB at most. Nothing that is in keys tests as absent."""
    size = 1 << min(26, max(12, int(16 * keys.count()).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _places(batch.column(0), size)
            words, to = np.unique(at >> 6, return_inverse=True)
            bits = np.zeros(len(words), np.uint64)
            np.bitwise_or.at(bits, to, np.uint64(1) << (at & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(bits.astype(np.int64))], names=["w", "b"])

    got = keys.mapInArrow(mark, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()  # size / 64 rows at most
    out = np.zeros(size // 64, np.uint64)
    out[np.array(got.column("w"), np.int64)] = np.array(got.column("b"), np.int64).astype(np.uint64)
    return out


def _places(keys: pa.Array, size: int) -> np.ndarray:
    return (mix(np.array(keys, np.int64).astype(np.uint64)) & np.uint64(size - 1)).astype(np.int64)


def _test(keys: pa.Array, bits: np.ndarray) -> np.ndarray:
    at = _places(keys, 64 * len(bits))
    return (bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def _within(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(_test(batch.column(0), bits), pa.bool_()))


def _packed(batches: Iterator[pa.RecordBatch], words: int, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(k, text) of rows whose k may be wanted -> (k, s, set)."""
    known = WordHash()
    for batch in _within(batches, bits):
        sets = [shingle_set(x.as_py() or "", known, words) for x in batch.column(1)]
        full = pa.array([len(a) > 0 for a in sets], pa.bool_())
        numbers = pa.array([set_number(a) for a in sets], pa.int64())
        out = pa.RecordBatch.from_arrays([batch.column(0), numbers, pa.array([a.tobytes() for a in sets], pa.binary())], names=["k", "s", "set"])
        yield out.filter(full)


def _joined(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(c, block, s, set, label, probe) sorted by c and block -> (c, s, label, found)."""
    for run in _runs(batches, 2):
        numbers, labels = run.column("s").to_pylist(), run.column("label").to_pylist()
        found = join_block(numbers, run.column("set").to_pylist(), labels, run.column("probe").to_pylist(), percent)
        yield pa.RecordBatch.from_arrays([pa.array(run.column("c").to_pylist(), pa.int64()), pa.array(numbers, pa.int64()), pa.array(labels, pa.int64()), pa.array(found, pa.int64())], names=["c", "s", "label", "found"])


def _in_blocks(rows: DataFrame, percent: int) -> DataFrame:
    ready = rows.select("c", "block", "s", "set", "label", "probe").repartition("c", "block").sortWithinPartitions("c", "block", "s")
    return ready.mapInArrow(lambda it: _joined(it, percent), "c long, s long, label long, found long")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: the id, n_shingles, component_id (the smallest id reachable by links).

    Words are runs of other characters than ASCII blanks, A-Z in lower case; a text of fewer than `words` words is one
    shingle. Null, empty or blank text: no shingles, linked with nothing, its component is its own id. Repeated rows have
    equal sets, so one component. A row with a null id is a document whose id is never the smallest (null if it is alone).
    Empty table: empty result. Ids must be integers; other columns, whatever their names, are not read.
    """
    integral(docs, id_col)
    spark = docs.sparkSession
    bounded_batches(spark)
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    facts = materialise(base.mapInArrow(lambda it: _facts(it, words), "id long, n long, s long, map binary, h array<long>, c array<int>"), "facts")
    told = facts.where("h is not null").select(F.explode(F.arrays_zip("h", "c")).alias("x")).groupBy(F.col("x.h").alias("h")).agg(F.sum("x.c").alias("c")).where(F.col("c") >= LEAST)
    top = told.orderBy(F.desc("c"), "h").limit(HEAVY).toArrow()
    heavy, counts = np.array(top.column("h"), np.int64).astype(np.uint64), np.array(top.column("c"), np.int64)
    order = np.argsort(heavy)
    # bounded by HEAVY entries of 12 bytes
    order_of = spark.sparkContext.broadcast((heavy[order], counts[order].astype(np.int32)))
    ranges = _ranges(facts, max(64, base.rdd.getNumPartitions()), percent)
    entries = base.select("_text").mapInArrow(lambda it: _prefixes(it, *order_of.value, ranges, words, percent), "r int, keys binary, sets binary")
    groups = materialise(entries.groupBy("r").applyInArrow(_groups, "sets array<long>, k long").groupBy("sets").agg(F.sum("k").alias("k")).where("k > 1 or size(sets) > 2").drop("k"), "groups")
    by_set = facts.where("s is not null").groupBy("s").agg(F.min("id").alias("id"), F.first("n").alias("n"))
    small = groups.where(F.size("sets") <= GROUP).select(F.xxhash64("sets").alias("g"), F.explode("sets").alias("s"))
    there = _bitset(small.select("s"))
    mapped = facts.where("s is not null").select("s", "n", "map").mapInArrow(lambda it: _within(it, there), "s long, n long, map binary").dropDuplicates(["s"])
    sifted = small.join(mapped, "s").select("g", "s", "n", "map").repartition("g").sortWithinPartitions("g", "s").mapInArrow(lambda it: _sift(it, percent), "a long, b long")
    large = groups.where(F.size("sets") > GROUP).select(F.array_min("sets").alias("a"), F.explode("sets").alias("b"))
    edges = materialise(sifted.unionAll(large), "candidates")
    discard(groups)
    near = components(edges).select(F.col("node").alias("s"), F.col("component").alias("c"))
    # one document of each candidate set brings the whole set; a set held by rows without ids is brought by any of them
    keyed = facts.where("s is not null").select("s", "id", "n").groupBy("s", "n").agg(F.min("id").alias("id"))
    wanted = near.join(keyed, "s").select("c", "s", F.col("id").alias("_id"), "n")
    wanted = materialise(wanted, "wanted")
    brought = _bring(base, wanted, words)
    sets = materialise(brought, "sets")
    per = wanted.groupBy("c").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    whole = sets.join(per, "c").withColumn("block", F.pmod(F.xxhash64("s"), F.col("blocks")).cast("int"))
    one = materialise(_in_blocks(whole.select("c", "block", "s", "set", F.col("s").alias("label"), F.lit(True).alias("probe")), percent).select("c", "s", F.col("found").alias("label")), "labels")
    labels = _across(sets, per, one, percent)
    # back to documents
    node = by_set.select("s", "id").join(labels.select("s", "label"), "s", "left").withColumn("label", F.coalesce("label", "s"))
    least = node.groupBy("label").agg(F.min("id").alias("component_id"))
    named = node.join(least, "label").select("s", "component_id")
    full = facts.where("n is not null").select("id", "n", "s")
    out = full.where("s is not null").join(named, "s").select(F.col("id"), "n", "component_id").unionAll(full.where("s is null").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), F.col("n").alias("n_shingles"), F.col("component_id").cast(docs.schema[id_col].dataType).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """docs with one document of each component, the one whose id names it; all columns stay.

    Rows of one id are one document: of those that stay, the row with the smallest text (nulls first). Rows with a null id
    can't be told apart by id and all stay.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kept = classes(plain, words=words, percent=percent).where("doc_id = component_id").select(F.col("doc_id").alias("k")).distinct()
    # the row travels as a struct, so no column of docs can clash with a name used here
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    order = F.row_number().over(Window.partitionBy("i").orderBy(F.col("t").asc_nulls_first()))
    named = rows.join(kept, F.col("i") == F.col("k"), "left_semi").withColumn("n", order).where("n = 1").select("row.*")
    return named.unionAll(docs.where(F.col(id_col).isNull()))


def _bring(base: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(c, s, set): the wanted documents shingled again. Their ids go along as a bitset of bounded size, so texts are not
    shuffled, only the sets of what passes it."""
    none = F.lit(-(1 << 63))
    keyed = wanted.select("c", "s", F.coalesce("_id", none).alias("k"))
    bits = _bitset(keyed.select("k"))
    found = base.select(F.coalesce("_id", none).alias("k"), "_text").mapInArrow(lambda it: _packed(it, words, bits), "k long, s long, set binary")
    return keyed.join(found, ["k", "s"]).select("c", "s", "set").dropDuplicates(["s"])


def _across(sets: DataFrame, per: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Labels (c, s, label) made whole over the components of more than one block."""
    wide = per.where("blocks > 1")
    if wide.isEmpty():
        return labels
    wide = materialise(wide, "wide")
    told = labels.join(wide, "c")
    held = sets.join(told, ["c", "s"])
    # leaders of every label, in blocks of their own
    ranked = told.select("c", "s", "label", F.pmod(F.xxhash64("s", F.lit(5)), F.lit(1 << 30)).alias("k"))
    picks = ranked.groupBy("c", "label").agg(*(F.min_by("s", F.xxhash64("k", F.lit(i))).alias(f"p{i}") for i in range(LEADERS)))
    picks = picks.select("c", F.explode(F.array_distinct(F.array(*(f"p{i}" for i in range(LEADERS))))).alias("s"))
    leaders = held.join(picks, ["c", "s"], "left_semi")
    count = materialise(leaders.select("c", "s", "set", "label"), "leaders")
    size = count.groupBy("c").agg(F.ceil(F.sum(F.octet_length("set") / 8) / BLOCK).cast("int").alias("blocks"))
    met = _in_blocks(count.join(size, "c").select("c", F.pmod(F.xxhash64("s", F.lit(2)), F.col("blocks")).cast("int").alias("block"), "s", "set", "label", F.lit(True).alias("probe")), percent)
    labels = _relabel(labels, met)
    # what is apart from the largest label of its component looks through every block
    told = labels.join(wide.select("c"), "c", "left_semi")
    sizes = told.groupBy("c", "label").agg(F.count("*").alias("k"))
    main = sizes.groupBy("c").agg(F.max_by("label", F.struct("k", "label")).alias("main"), F.count("*").alias("labels")).where("labels > 1")
    apart = materialise(told.join(main, "c").where("label <> main").select("c", "s", "label"), "apart")
    if apart.isEmpty():
        return labels
    held = sets.join(told.join(main.select("c"), "c", "left_semi"), ["c", "s"]).join(wide, "c")
    probes = sets.join(apart, ["c", "s"])
    pieces = probes.groupBy("c").agg(F.ceil(F.sum(F.octet_length("set") / 8) / BLOCK).cast("int").alias("pieces"))
    probes = probes.join(pieces, "c").join(wide, "c").withColumn("piece", F.pmod(F.xxhash64("s", F.lit(3)), F.col("pieces")).cast("int"))
    # block number = block * pieces + piece: every piece of probes meets every block
    left = held.join(pieces, "c").withColumn("b", F.pmod(F.xxhash64("s"), F.col("blocks")).cast("int"))
    left = left.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select("c", (F.col("b") * F.col("pieces") + F.col("piece")).alias("block"), "s", "set", "label", F.lit(False).alias("probe"))
    right = probes.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("c", (F.col("b") * F.col("pieces") + F.col("piece")).alias("block"), "s", "set", "label", F.lit(True).alias("probe"))
    both = left.unionAll(right).groupBy("c", "block", "s").agg(F.first("set").alias("set"), F.first("label").alias("label"), F.max("probe").alias("probe"))
    return _relabel(labels, _in_blocks(both, percent))


def _relabel(labels: DataFrame, met: DataFrame) -> DataFrame:
    links = materialise(met.where("found <> label").select(F.col("label").alias("a"), F.col("found").alias("b")).distinct(), "links")
    merged = components(links)
    new = labels.join(merged.withColumnRenamed("node", "label"), "label", "left").select("c", "s", F.coalesce("component", "label").alias("label"))
    return materialise(new, "labels")
