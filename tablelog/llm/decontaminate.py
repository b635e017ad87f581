"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are joined on shared seeds, runs of SEED tokens; each document and item that share one are tiled:
the longest common runs that don't overlap are marked again and again, found by running Karp-Rabin fingerprints over what is
still unmarked. The share of the item's tokens that tiles cover decides, so a passage whose sentences were put in another order
is caught as well as one left whole.

Of an item's seeds the most frequent few lead to no document: tiles that cover enough hold more of its seed places than those.
A broadcast filter of bounded size keeps documents without any leading seed out of the join.
"""

from __future__ import annotations

import heapq
import math
import string
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.llm.common import bounded_batches, materialise
from tablelog.llm.shingles import WordHash, rolled, rolling

#: Tokens of a seed and of the shortest tile, share of an item's tokens that tiles must cover.
SEED, COVERAGE = 5, 0.6
#: Bytes up to which seeds or items are broadcast to their join (beyond: shuffled, hot keys dealt over SALTS tasks); bits of the
#: filter a seed, most bits in all (32 MB; beyond some 4 million seeds more documents pass it in vain, none is lost); items tiled
#: with one copy of a document.
BROADCAST_BYTES, SALTS, BITS, MOST_BITS, CHUNK = 16 << 20, 16, 64, 1 << 28, 256
_PRIME = (1 << 61) - 1
_BASE = 0x2545F4914F6CDD1D % _PRIME
_BLANKED = bytes(32 if chr(b) in string.punctuation else b for b in range(256))


def tokens(text: str) -> list[bytes]:
    """Lower-case words; ASCII punctuation counts as a blank."""
    return text.lower().encode().translate(_BLANKED).split()


class Fingerprints:
    """Polynomial prefix sums: the fingerprint of any run of a sequence in constant time."""

    def __init__(self, seq: list[int]) -> None:
        self.sums, self.powers = [0], [1]
        for x in seq:
            self.sums.append((self.sums[-1] * _BASE + x) % _PRIME)
            self.powers.append(self.powers[-1] * _BASE % _PRIME)

    def of(self, at: int, n: int) -> int:
        return (self.sums[at + n] - self.sums[at] * self.powers[n]) % _PRIME


def free_runs(marked: bytearray, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The unmarked stretches within spans."""
    out = []
    for a, b in spans:
        while a < b:
            if marked[a]:
                a += 1
                continue
            e = marked.find(1, a, b)
            e = b if e < 0 else e
            out.append((a, e))
            a = e
    return out


def tile(item: list[int], doc: list[int], spans: list[tuple[int, int]], shortest: int) -> list[tuple[int, int, int]]:
    """Tiles (item position, document position, length) within spans of the document, none overlapping: the longest common run
    first, of equal ones that with the smaller item position, then document position; again and again, over what is unmarked.

    Runs are found once, by running fingerprints of `shortest` tokens, and wait in a heap. One that is met partly marked gives
    way to the pieces of it that are still free, which is what a new search along its diagonal would find.
    """
    prints = Fingerprints(item)
    places: dict[int, list[int]] = defaultdict(list)
    for p in range(len(item) - shortest + 1):
        places[prints.of(p, shortest)].append(p)
    heap: list[tuple[int, int, int]] = []
    for a, b in spans:
        own = Fingerprints(doc[a:b])
        for t in range(a, b - shortest + 1):
            for p in places.get(own.of(t - a, shortest), ()):
                if p and t > a and item[p - 1] == doc[t - 1]:
                    continue  # part of a longer run that starts before
                n = 0
                while p + n < len(item) and t + n < b and item[p + n] == doc[t + n]:
                    n += 1
                if n >= shortest:
                    heap.append((-n, p, t))
    heapq.heapify(heap)
    in_item, in_doc, tiles = bytearray(len(item)), bytearray(len(doc)), []
    while heap:
        n, p, t = heapq.heappop(heap)
        n = -n
        if in_item.find(1, p, p + n) < 0 and in_doc.find(1, t, t + n) < 0:
            in_item[p : p + n], in_doc[t : t + n] = b"\1" * n, b"\1" * n
            tiles.append((p, t, n))
            continue
        for a, b in free_runs(in_item, [(p, p + n)]):
            for c, d in free_runs(in_doc, [(t + a - p, t + b - p)]):
                if d - c >= shortest:
                    heapq.heappush(heap, (c - d, p + c - t, c))
    return tiles


def numbered(words: list[bytes], known: WordHash) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def needed(length: int, seed: int, coverage: float) -> int:
    """Least number of seed places of an item that tiles covering the share `coverage` of it hold: a tile of n tokens holds
    n - m + 1, m being the shortest tile, and there are at most covered / m tiles."""
    return max(1, math.ceil(coverage * length / min(seed, length) - 1e-9))


def leak(item: np.ndarray, doc: list[int], prints: np.ndarray, seed: int, coverage: float) -> tuple[float, int, int] | None:
    """(coverage, tiles, covered tokens) if tiles of the document cover enough of the item. prints: the document's seeds, each
    of min(seed, tokens of the item) tokens."""
    k = min(seed, len(item))
    spans: list[tuple[int, int]] = []
    for t in np.flatnonzero(np.isin(prints, rolled(item, k))).tolist():
        if spans and spans[-1][1] >= t:
            spans[-1] = (spans[-1][0], t + k)
        else:
            spans.append((t, t + k))
    tiles = tile(item.tolist(), doc, spans, k)
    covered = sum(n for _, _, n in tiles)
    return (covered / len(item), len(tiles), covered) if tiles and covered >= coverage * len(item) else None


class Lead:
    """The seeds of benchmark items that lead to documents, as a table and as a filter of bounded size."""

    def __init__(self, benchmark: DataFrame, item_col: str, text_col: str, seed: int, coverage: float, broadcast_bytes: int) -> None:
        self.seed, self.coverage, self.broadcast_bytes = seed, coverage, broadcast_bytes
        spark = benchmark.sparkSession
        bounded_batches(spark)
        schema = T.StructType([T.StructField("item_id", benchmark.schema[item_col].dataType), T.StructField("words", T.ArrayType(T.LongType()))])
        told = benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")).mapInArrow(_worded, schema)
        self.items = materialise(told.withColumn("i", F.monotonically_increasing_id()), "benchmark-items")
        places = materialise(self.items.select("i", "words").mapInArrow(_places(seed, coverage), "i long, h long, n long, k int, places long, spare long"), "benchmark-seeds")
        counts = places.groupBy("h").agg(F.sum("n").alias("all"))
        before = F.sum("n").over(Window.partitionBy("i").orderBy("all", "h").rowsBetween(Window.unboundedPreceding, -1))
        leading = places.join(counts, "h").withColumn("before", F.coalesce(before, F.lit(0))).where("before < places - spare")
        self.seeds = materialise(leading.select("i", "h", "k"), "benchmark-leads")
        self.lengths = sorted(r.k for r in self.seeds.select("k").distinct().collect())  # at most `seed` numbers
        self.n_seeds = self.seeds.count()
        self.item_bytes = self.items.agg(F.sum(F.size("words") * 8 + 24)).first()[0] or 0
        self.bits = spark.sparkContext.broadcast(self._filter())

    def _filter(self) -> np.ndarray:
        size = 1 << 16
        while size < min(self.n_seeds * BITS, MOST_BITS):
            size *= 2
        out = np.zeros(size // 64, np.uint64)
        at = F.explode(F.array(*(F.shiftrightunsigned("h", s).bitwiseAND(F.lit(size - 1)) for s in _SHIFTS))).alias("p")
        # at most MOST_BITS / 64 rows
        got = self.seeds.select(at).groupBy(F.shiftright("p", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("w")).toArrow()
        out[got.column("at").to_numpy()] = got.column("w").to_numpy().view(np.uint64)
        return out

    def candidates(self, docs: DataFrame, text_col: str, names: tuple[str, str]) -> DataFrame:
        """The rows whose texts pass the filter, with a row number and their distinct passing seeds under the given names."""
        row, seeds = names
        schema = T.StructType([*docs.schema.fields, T.StructField(seeds, T.ArrayType(T.LongType()))])
        return materialise(docs.mapInArrow(_sift(self, docs.columns.index(text_col), True, schema.names), schema).withColumn(row, F.monotonically_increasing_id()), "seeded-documents")

    def tiled(self, candidates: DataFrame, text_col: str, names: tuple[str, str]) -> DataFrame:
        """row, item_id, coverage, n_tiles, n_covered of every candidate and item that it covers enough of."""
        row, seeds = names
        seen = candidates.select(F.col(row).alias("row"), F.explode(seeds).alias("h"))
        pairs = self._join(seen, self.seeds.select("i", "h"), "h", self.n_seeds * 16).select("row", "i").distinct()
        pairs = self._join(pairs, self.items, "i", self.item_bytes)
        sets = pairs.groupBy("row", F.expr(f"i div {CHUNK}").alias("chunk")).agg(F.collect_list(F.struct("item_id", "words")).alias("items"))
        texts = candidates.select(F.col(row).alias("row"), F.col(text_col).alias("text"))
        schema = T.StructType([T.StructField("row", T.LongType()), self.items.schema["item_id"], T.StructField("coverage", T.DoubleType()), T.StructField("n_tiles", T.LongType()), T.StructField("n_covered", T.LongType())])
        return sets.join(texts, "row").select("row", "text", "items").mapInArrow(_tiler(self.seed, self.coverage), schema)

    def _join(self, left: DataFrame, right: DataFrame, key: str, size: int) -> DataFrame:
        """left joined with right on key: broadcast if right is small, else salted, as a third of left may have one key."""
        if size <= self.broadcast_bytes:
            return left.join(F.broadcast(right), key)
        salted = right.withColumn("salt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))
        return left.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS))).join(salted, [key, "salt"]).drop("salt")


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", seed: int = SEED, coverage: float = COVERAGE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document row and item whose tokens its tiles cover to the share `coverage`: the ids, coverage, n_tiles,
    n_covered.

    Tokens are lower-case words without ASCII punctuation. Tiles have `seed` tokens at least (an item of fewer tokens must
    occur whole). Null or empty texts, on either side, match nothing. Repeated document or item rows give repeated rows; null
    ids stay null; either table empty: empty result. Other columns, whatever their names, are not read.
    """
    lead = Lead(benchmark, item_col, item_text_col, seed, coverage, broadcast_bytes)
    names = ("row", "seeds")
    some = lead.candidates(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", names)
    found = lead.tiled(some, "text", names).join(some.select("row", "id"), "row")
    return found.select(F.col("id").alias(id_col), "item_id", "coverage", "n_tiles", "n_covered")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", seed: int = SEED, coverage: float = COVERAGE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """docs without the rows that find_leaks() reports for any item; all columns stay. Rows that pass no seed go through in a
    narrow pass, the others wait in a table for their tiles."""
    lead = Lead(benchmark, item_col, item_text_col, seed, coverage, broadcast_bytes)
    taken = {c.lower() for c in docs.columns}
    names = tuple(next(x for n in range(len(taken) + 1) if (x := f"_{name}{n}") not in taken) for name in ("row", "seeds"))
    some = lead.candidates(docs, text_col, names)
    bad = lead.tiled(some, text_col, names).select(F.col("row").alias(names[0])).distinct()
    rest = docs.mapInArrow(_sift(lead, docs.columns.index(text_col), False, docs.columns), docs.schema)
    return rest.unionAll(some.join(bad, names[0], "left_anti").select(docs.columns))


_SHIFTS = (0, 18, 36)


def _worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHash()
    for batch in batches:
        rows = [tokens(x.as_py() or "") for x in batch.column(1)]
        at = [i for i, words in enumerate(rows) if words]
        words = pa.array([numbered(rows[i], known).view(np.int64) for i in at], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), words], names=["item_id", "words"])


def _places(seed: int, coverage: float):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                w = words.values.to_numpy().view(np.uint64)
                k = min(seed, len(w))
                h, n = np.unique(rolled(w, k), return_counts=True)
                size = len(h)
                rest = (pa.array(np.full(size, x, np.int64)) for x in (len(w) - k + 1, needed(len(w), seed, coverage) - 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, i, np.int64)), pa.array(h.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(np.full(size, k, np.int32)), *rest], names=["i", "h", "n", "k", "places", "spare"])

    return f


def _sift(lead: Lead, at: int, hits: bool, names: list[str]):
    """Rows whose texts pass the filter with their passing seeds (hits), or the rows whose texts don't."""
    lengths, bits = lead.lengths, lead.bits

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, words_of = WordHash(), bits.value
        mask = np.uint64(len(words_of) * 64 - 1)
        for batch in batches:
            rows, seeds = [], []
            for r, x in enumerate(batch.column(at)):
                words, got = tokens(x.as_py() or ""), []
                w = numbered(words, known)
                for k in lengths:
                    if len(w) >= k:
                        h = rolled(w, k)
                        for s in _SHIFTS:
                            p = (h >> np.uint64(s)) & mask
                            h = h[(words_of[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1]
                        got.append(h)
                found = np.unique(np.concatenate(got)) if got else np.zeros(0, np.uint64)
                if (len(found) > 0) == hits:
                    rows.append(r)
                    seeds.append(found.view(np.int64))
            kept = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, *([pa.array(seeds, pa.list_(pa.int64()))] if hits else [])], names=names)

    return f


def _tiler(seed: int, coverage: float):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for batch in batches:
            lists = batch.column(2)
            starts, flat = lists.offsets.to_numpy(), lists.values
            ids, items = flat.field(0), flat.field(1)
            rows, at, got = [], [], []
            for r, row in enumerate(batch.column(0).to_pylist()):
                words = tokens(batch.column(1)[r].as_py())
                doc, prints = numbered(words, known).tolist(), {}
                for j in range(starts[r], starts[r + 1]):
                    item = items[j].values.to_numpy().view(np.uint64)
                    k = min(seed, len(item))
                    if k not in prints:
                        prints[k] = rolling(words, known, k)
                    if found := leak(item, doc, prints[k], seed, coverage):
                        rows.append(row)
                        at.append(j)
                        got.append(found)
            columns = (pa.array([g[n] for g in got], t) for n, t in enumerate((pa.float64(), pa.int64(), pa.int64())))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), ids.take(pa.array(at, pa.int64())), *columns], names=["row", "item_id", "coverage", "n_tiles", "n_covered"])

    return f
