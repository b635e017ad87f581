"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Each text becomes STATISTICS numbers (shares of character classes, word and line shapes, repetition). Random Fourier
features sqrt(2 / D) cos(Wx + b) approximate a Gaussian kernel over the standardised numbers. Every partition sums its part
of the normal equations (ZᵀZ, Zᵀy); the sums, D x D numbers whatever the input, meet on the driver and give the ridge
weights. Pool-adjacent-violators over the scores of labelled rows kept back from the fit (one in HELD_BACK, by hash of the id),
summed into SCORE_BINS bins, makes the scores probabilities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.llm.common import bounded_batches, edit_batches

#: Random features, ridge penalty, kernel width (in standard deviations), bins of the calibration.
D, RIDGE, WIDTH, SCORE_BINS = 256, 1.0, 3.0, 1000
#: Bound of the training sample; one row in so many is kept back for the calibration.
MAX_ROWS, HELD_BACK = 20_000, 4
_CLASSES = np.zeros((256, 10))
for _b in range(256):
    _c = chr(_b)
    _CLASSES[_b, 0] = _b < 128 and _c.islower()
    _CLASSES[_b, 1] = _b < 128 and _c.isupper()
    _CLASSES[_b, 2] = 48 <= _b < 58
    _CLASSES[_b, 3] = _b in b" "
    _CLASSES[_b, 4] = _b in b"\n\r"
    _CLASSES[_b, 5] = _b in b".,;:"
    _CLASSES[_b, 6] = _b in b"!?"
    _CLASSES[_b, 7] = _b in b"#$%&*+=@^~\\"
    _CLASSES[_b, 8] = _b in b"|<>{}[]_/"
    _CLASSES[_b, 9] = _b >= 128
STATISTICS = 10 + 10


def statistics(text: str) -> list[float]:
    """The document's numbers; of an empty text all are 0."""
    if not text:
        return [0.0] * STATISTICS
    data = text.encode()
    shares = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASSES / len(data)
    words = text.split()
    n = len(words)
    lines = [x for x in text.split("\n") if x.strip()]
    if not n:
        return [*np.sqrt(shares), *[0.0] * 9, float(np.log1p(len(data)))]
    counts = Counter(words)
    repeated = sum(k * len(x) for x, k in Counter(lines).items() if k > 1)
    ended = sum(x.rstrip()[-1] in ".!?:\"'" for x in lines)
    return [
        *np.sqrt(shares),
        np.log1p(n),
        np.log1p(len(text) / n),
        len(counts) / n**0.9,
        max(counts.values()) / n,
        repeated / len(text),
        ended / len(lines),
        np.log1p(n / len(lines)),
        sum(x.isupper() and len(x) > 1 for x in words) / n,
        sum(not x[-1].isalnum() for x in words) / n,
        np.log1p(len(data)),
    ]


class Model:
    """Everything a score needs; some hundred kB."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, b: np.ndarray, ridge: np.ndarray, steps: np.ndarray, levels: np.ndarray) -> None:
        self.mean, self.scale, self.w, self.b, self.ridge, self.steps, self.levels = mean, scale, w, b, ridge, steps, levels

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features and a constant."""
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.sqrt(2 / len(self.b)) * np.cos(x @ self.w + self.b), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.ridge

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated: between the levels of the isotonic fit it runs straight; the raw score breaks ties a little."""
        raw = self.raw(x)
        return np.clip(0.999 * np.interp(raw, self.steps, self.levels) + 0.001 * np.clip(raw, 0, 1), 0, 1)


def isotonic(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing values nearest to y in weighted squares."""
    blocks: list[list[float]] = []
    for value, w in zip(y, weight, strict=True):
        blocks.append([value, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, u, k = blocks.pop()
            p = blocks[-1]
            p[0], p[1], p[2] = (p[0] * p[1] + v * u) / (p[1] + u), p[1] + u, p[2] + k
    return np.concatenate([np.full(int(k), v) for v, _, k in blocks]) if blocks else np.zeros(0)


def _summed(df: DataFrame, rows_of, width: int) -> np.ndarray:
    """Sum over the partitions of the (i, row) pieces that rows_of makes of a partition's statistics and labels."""
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("row", T.ArrayType(T.DoubleType()))])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.array([s.as_py() for s in batch.column(0)], float)
                add = rows_of(x, np.array(batch.column(1).to_pylist(), float))
                total = add if total is None else total + add
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    def fold(key: tuple, group: pa.Table) -> pa.Table:
        total = np.sum([r.as_py() for r in group.column("row")], axis=0)
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "row": pa.array([total], pa.list_(pa.float64()))})

    got = df.mapInArrow(part, schema).groupBy("i").applyInArrow(fold, schema).collect()
    out = np.zeros((max((r.i for r in got), default=-1) + 1, width))
    for r in got:
        out[r.i] = r.row
    return out


def _with_statistics(df: DataFrame, text_at: int, kept: list[T.StructField]) -> DataFrame:
    """The columns of kept (the others than text_at, in order) and the statistics of the text."""
    schema = T.StructType([*kept, T.StructField("stats", T.ArrayType(T.DoubleType()))])

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(x.as_py() or "") for x in batch.column(text_at)]
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != text_at), pa.array(stats, pa.list_(pa.float64()))], names=schema.names)

    bounded_batches(df.sparkSession)
    return df.mapInArrow(f, schema)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_ROWS, seed: int = 11) -> Model:
    """Fit on at most max_rows labelled ids, picked by hash of the id.

    labels: id and 0/1 label of the rows to learn from; the caller leaves out what is held out. Rows with a null id or label
    are passed over; of contradictory labels the larger counts. Without labelled rows every score is 0.5.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_label")).dropna().groupBy("_id").agg(F.max("_label").alias("_label"))
    picked = known.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    # at most max_rows ids: a bounded broadcast
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(picked), "_id")
    rows = rows.select("_text", "_label", (F.pmod(F.xxhash64("_id", F.lit("calibrate")), F.lit(HELD_BACK)) == 0).alias("_back"))
    rows = _with_statistics(rows, 0, [T.StructField("_label", T.DoubleType()), T.StructField("_back", T.BooleanType())]).select("stats", "_label", "_back").persist()
    try:
        first = _summed(rows, lambda x, y: np.vstack([x.sum(0), (x * x).sum(0), np.full(STATISTICS, len(x)), np.full(STATISTICS, y.sum())]), STATISTICS)
        rng = np.random.default_rng(seed)
        w, b = rng.normal(size=(STATISTICS, D)) / (WIDTH * np.sqrt(STATISTICS / 10)), rng.uniform(0, 2 * np.pi, D)
        if not len(first):
            return Model(np.zeros(STATISTICS), np.ones(STATISTICS), w, b, np.append(np.zeros(D), 0.5), np.array([0.0]), np.array([0.5]))
        n = first[2, 0]
        mean = first[0] / n
        scale = np.sqrt(np.maximum(first[1] / n - mean**2, 0)) + 1e-3
        model = Model(mean, scale, w, b, np.zeros(D + 1), np.array([0.0]), np.array([0.5]))

        def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            z = model.features(x)
            return np.hstack([z.T @ z, (z.T @ y)[:, None]])

        fitted, back = rows.where("not _back"), rows.where("_back")
        if fitted.isEmpty() or back.isEmpty():  # too few to part
            fitted = back = rows
        sums = _summed(fitted, equations, D + 2)
        model.ridge = np.linalg.solve(sums[:, :-1] + RIDGE * np.diag([1.0] * D + [0.0]) + 1e-9 * np.eye(D + 1), sums[:, -1])

        def binned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            at = np.clip((model.raw(x) + 0.5) / 2 * SCORE_BINS, 0, SCORE_BINS - 1).astype(int)
            return np.vstack([np.bincount(at, minlength=SCORE_BINS), np.bincount(at, y, SCORE_BINS)])

        seen, good = _summed(back, binned, SCORE_BINS)
        full = np.flatnonzero(seen)
        model.steps, model.levels = (full + 0.5) / SCORE_BINS * 2 - 0.5, isotonic(good[full] / seen[full], seen[full])
        return model
    finally:
        rows.unpersist()


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per input row: the id, score (0 to 1, higher is more likely good), predicted (1 if score >= threshold).

    Null text counts as empty; empty texts are scored by their statistics, all 0. A null id stays null; repeated rows give
    repeated rows; an empty table gives an empty result; other columns are neither read nor returned. Narrow: no shuffle.
    """
    schema = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py() or "") for t in batch.column(1)], float).reshape(-1, STATISTICS)
            p = model.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))], names=schema.names)

    bounded_batches(docs.sparkSession)
    return docs.select(id_col, text_col).mapInArrow(f, schema)


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """docs without the rows whose score is below threshold; all columns stay. Null and empty texts as in score()."""
    at = docs.columns.index(text_col)

    def make():
        def edit(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = np.array([statistics(t.as_py() or "") for t in batch.column(at)], float).reshape(-1, STATISTICS)
            return batch.filter(pa.array(model.score(x) >= threshold, pa.bool_()))

        return edit

    return edit_batches(docs, make)
