"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic examples (positives) and unlabelled text train an ensemble-free linear classifier in numpy. The risk
pi * R_p(+) + max(0, R_u(-) - pi * R_p(-)) corrects the unlabelled part for the toxic documents hidden in it; pi, the class
prior, is the share of toxic rows among the labelled ones of the training folds (or a parameter). When the bracket falls
below zero, the step goes against it instead, as the non-negative estimator prescribes.

Inputs of a score are the text's distinct lower-case words and their beginnings of 3 to 5 letters, hashed. The unlabelled texts
are those of the labelled rows, their labels put aside: a bounded sample of labelled rows (MAX_POSITIVE, MAX_UNLABELLED), each
text whole. How often an input occurs in them is counted by partitions; then only the FEATURES inputs that tell most are brought
to the driver. Scoring is one narrow pass over whole texts.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.llm.common import bounded_batches

#: Hash buckets of the inputs.
BUCKETS = 1 << 20
#: Bounds of the training sample, in labelled rows: confirmed positives, and rows whose labels are put aside.
MAX_POSITIVE, MAX_UNLABELLED = 3000, 9000
#: Inputs that the model keeps: those that tell positives from unlabelled text best.
FEATURES = 300
#: Information (nats) that an input should carry: about what the best of some thousand inputs without meaning reach by chance.
#: Where none does, the FEW best are taken, with a warning.
LEAST_GAIN, FEW = 8.0, 20
#: The score of the median unlabelled text.
CLEAR = 0.002
WORD = re.compile(r"[^\W\d_]+")


class Inputs(dict):
    """word -> buckets of the word and its beginnings (only those in kept, if given); emptied when it holds many words."""

    def __init__(self, kept: set[int] | None = None) -> None:
        super().__init__()
        self.kept = kept

    def __missing__(self, w: str) -> tuple[int, ...]:
        if len(self) >= 500_000:
            self.clear()
        out = {crc32(x.encode()) % BUCKETS for x in (f"w:{w}", *(f"b:{w[:n]}" for n in (3, 4, 5) if len(w) >= n))}
        out = self[w] = tuple(out if self.kept is None else out & self.kept)
        return out


def distinct_inputs(text: str, known: Inputs) -> set[int]:
    out: set[int] = set()
    for w in set(WORD.findall(text.lower())):
        out.update(known[w])
    return out


class Model:
    """Weights over kept buckets and a bias; score = sigmoid(slope * (bias + sum of weights - centre))."""

    def __init__(self, weights: dict[int, float], bias: float, centre: float = 0.0, slope: float = 1.0) -> None:
        self.weights, self.bias, self.centre, self.slope = weights, bias, centre, slope
        self.kept = set(weights)

    def logit(self, inputs: set[int]) -> float:
        return self.bias + sum(self.weights[k] for k in sorted(inputs & self.kept))

    def score(self, inputs: set[int]) -> float:
        return float(sigmoid(np.float64(self.slope * (self.logit(inputs) - self.centre))))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def select_inputs(a: np.ndarray, b: np.ndarray, n_positive: int, n_unlabelled: int, keep: int = FEATURES) -> np.ndarray:
    """The buckets whose presence carries most information about positive against unlabelled. a, b: texts of either kind that
    have the bucket."""
    pa_, pb = (a + 0.1) / (n_positive + 0.2), (b + 0.1) / (n_unlabelled + 0.2)
    m = (pa_ * n_positive + pb * n_unlabelled) / max(n_positive + n_unlabelled, 1)
    gain = n_positive * (pa_ * np.log(pa_ / m) + (1 - pa_) * np.log((1 - pa_) / (1 - m))) + n_unlabelled * (pb * np.log(pb / m) + (1 - pb) * np.log((1 - pb) / (1 - m)))
    gain[a < 2] = 0  # in one positive only: chance
    order = np.argsort(-gain, kind="stable")[:keep]
    clear = order[gain[order] > LEAST_GAIN]
    if not len(clear):
        clear = order[gain[order] > 0][:FEW]
        warnings.warn(f"{n_positive} positive and {n_unlabelled} unlabelled texts show no input that tells them apart for sure; the best {len(clear)} are taken", stacklevel=2)
    return np.sort(clear)


def matrix(rows: list[np.ndarray], kept: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), len(kept)), np.float32)
    for i, r in enumerate(rows):
        at = np.searchsorted(kept, r)
        at[at == len(kept)] = 0
        out[i, at[kept[at] == r]] = 1
    return out


def risk(w: np.ndarray, b: float, xp: np.ndarray, xu: np.ndarray, prior: float, decay: float) -> tuple[float, float, np.ndarray]:
    """The non-negative risk with the logistic loss (and the weights' penalty), its corrected negative part before the cut at 0,
    and the direction to step against: the risk's gradient, or, where that part is below 0, minus that part's gradient."""
    sp, su = sigmoid(xp @ w + b), sigmoid(xu @ w + b)
    # logistic loss: l(+) = -log s, l(-) = -log(1 - s); d l(+)/dz = s - 1, d l(-)/dz = s
    negative = -np.log(1 - su + 1e-12).mean() + prior * np.log(1 - sp + 1e-12).mean()
    gp, gu = (prior * (sp - 1) - prior * sp, su) if negative >= 0 else (prior * sp, -su)
    value = -prior * np.log(sp + 1e-12).mean() + max(negative, 0.0) + decay * (w @ w) / 2
    return float(value), float(negative), np.append(xp.T @ gp / len(xp) + xu.T @ gu / len(xu) + decay * w, gp.mean() + gu.mean())


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, kept: np.ndarray | None = None, epochs: int = 60, batch: int = 1000, rate: float = 0.03, decay: float = 1e-4, seed: int = 7) -> Model:
    """Fit by Adam on the non-negative risk. kept: the buckets to use; None selects them here. Without positives every score is
    near 0."""
    if not positive or not unlabelled:
        return Model({}, -4.0)
    prior = float(np.clip(prior, 1e-3, 0.9))
    if kept is None:
        kept = select_inputs(*(np.bincount(np.concatenate(x).astype(np.int64), minlength=BUCKETS) for x in (positive, unlabelled)), len(positive), len(unlabelled))
    if not len(kept):
        return Model({}, float(np.log(prior / (1 - prior))))
    xp, xu = matrix(positive, kept), matrix(unlabelled, kept)
    rng = np.random.default_rng(seed)
    w, b = np.zeros(len(kept)), float(np.log(prior / (1 - prior)))
    m, v, step = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1), 0
    n_batches = max(1, -(-len(xu) // batch))
    for epoch in range(epochs):
        for iu, ip in zip(np.array_split(rng.permutation(len(xu)), n_batches), np.array_split(rng.permutation(max(len(xp), n_batches)) % len(xp), n_batches), strict=True):
            _, _, g = risk(w, b, xp[ip], xu[iu], prior, decay)
            step += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            d = rate * (1 - epoch / epochs) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            w, b = w - d[:-1], b - d[-1]
    # The prior says what share of the unlabelled text is toxic: the score is 0.5 at that quantile (but between a quarter of
    # the way from the unlabelled texts' median to the positives', and half of it), CLEAR at the unlabelled texts' median.
    z = xu @ w + b
    middle = np.median(z)
    way = max(np.median(xp @ w + b) - middle, 1e-3)
    centre = float(np.clip(np.quantile(z, 1 - prior), middle + way / 4, middle + way / 2))
    slope = -np.log(CLEAR / (1 - CLEAR)) / max(centre - middle, 1e-6)
    return Model({int(k): float(x) for k, x in zip(kept, w, strict=True)}, float(b), float(centre), float(min(slope, 50)))


def _counted(sample: DataFrame) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Positive and unlabelled texts, and of each kind the texts that have a bucket; added up by partitions."""
    schema = "k int, a long, b long"

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = Inputs(), np.zeros((2, BUCKETS + 1), np.int64)
        for batch in batches:
            for is_positive, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                row = counts[0 if is_positive else 1]
                row[list(distinct_inputs(x.as_py() or "", known))] += 1
                row[BUCKETS] += 1  # the number of texts
        at = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[0, at]), pa.array(counts[1, at])], names=["k", "a", "b"])

    bounded_batches(sample.sparkSession)
    got = sample.mapInArrow(f, schema).groupBy("k").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toArrow()  # BUCKETS + 1 rows at most
    out = np.zeros((2, BUCKETS + 1), np.int64)
    at = np.array(got.column("k"), np.int64)
    out[0, at], out[1, at] = np.array(got.column("a"), np.int64), np.array(got.column("b"), np.int64)
    return int(out[0, BUCKETS]), int(out[1, BUCKETS]), out[0, :BUCKETS], out[1, :BUCKETS]


def _inputs_of(df: DataFrame, kept: set[int]) -> DataFrame:
    """is_positive and those of the text's inputs that are in kept."""
    schema = T.StructType([T.StructField("is_positive", T.BooleanType()), T.StructField("inputs", T.ArrayType(T.IntegerType()))])

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Inputs(kept)
        for batch in batches:
            rows = [sorted(distinct_inputs(x.as_py() or "", known)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], names=schema.names)

    bounded_batches(df.sparkSession)
    return df.mapInArrow(f, schema)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", prior: float | None = None, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Train on at most max_positive confirmed rows and the texts of at most max_unlabelled labelled rows of either label, picked
    by hash of the id.

    labels: id and 0/1 label of the rows to learn from; the caller leaves out what is held out. Rows with a null id or label
    are passed over; of contradictory labels the larger counts. prior: None takes the share of toxic among labels.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).dropna().groupBy("_id").agg(F.max("_label").alias("_label"))
    if prior is None:
        prior = known.agg(F.avg("_label")).first()[0] or 0.0
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    positive = known.where("_label = 1").orderBy(F.xxhash64("_id"), "_id").limit(max_positive).select("_id")
    others = known.orderBy(F.xxhash64("_id", F.lit(1)), "_id").limit(max_unlabelled).select("_id")
    # both sides are bounded by their limits: at most max_positive and max_unlabelled ids are broadcast
    sample = base.join(F.broadcast(positive), "_id", "left_semi").select(F.lit(True), "_text").unionAll(base.join(F.broadcast(others), "_id", "left_semi").select(F.lit(False), "_text"))
    n_positive, n_unlabelled, a, b = _counted(sample)
    if not n_positive or not n_unlabelled:
        return train([], [], prior)
    kept = select_inputs(a, b, n_positive, n_unlabelled)
    got: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
    rows = []
    for batch in _inputs_of(sample, set(kept.tolist())).toArrow().to_batches():  # FEATURES inputs a row at most
        flat, cuts = batch.column(1).flatten().to_numpy(), np.cumsum([0, *pc.list_value_length(batch.column(1)).to_pylist()])
        rows += [(p, flat[i:j]) for p, i, j in zip(batch.column(0).to_pylist(), cuts, cuts[1:], strict=False)]
    for is_positive, inputs in sorted(rows, key=lambda r: (r[0], r[1].tobytes())):
        got[is_positive].append(inputs)
    return train(got[1], got[0], prior, kept)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row per input row: the id, score (0 to 1, higher is more likely toxic), predicted (1 if score >= threshold).

    Null text counts as empty; an empty text gets the score of the bias alone. A null id stays null; repeated rows give
    repeated rows with the same score; an empty table gives an empty result; other columns are neither read nor returned.
    """
    schema = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Inputs(model.kept)
        for batch in batches:
            p = [model.score(distinct_inputs(x.as_py() or "", known)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), pa.array([int(x >= threshold) for x in p], pa.int32())], names=schema.names)

    bounded_batches(docs.sparkSession)
    return docs.select(id_col, text_col).mapInArrow(f, schema)
