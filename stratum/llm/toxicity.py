"""Toxic passages by maximum-scoring segments of token log-odds.

*Weights.* Every word has a chain of features: its first 4, 5, 6 and 7 bytes, then the whole word. For each feature the
documents with and without the toxic label that hold it are counted. The share of toxic documents is a posterior
mean under a Dirichlet (two classes: beta) prior centred on the share of the next shorter feature, the shortest on
the share of all documents; the weight is the log-odds against that overall share, drawn towards zero by two
standard errors. A word takes the weight of its longest feature that the model holds, so unseen words share their
stem's weight. The k-th use of a word in a document counts 1/k of the first, as repeats are no further evidence. A constant is subtracted from all weights, which makes the expected score of clean text negative.

*Segments.* A linear scan finds all maximal scoring segments of a document (only words of positive weight are looked
at one by one; the sums between them come from one cumulative sum).

*Calibration.* Segment scores of clean text follow an extreme-value law with P(max > s) = 1 - exp(-K n exp(-l s)) for
n words: l solves sum over words of exp(l * weight) = 1 on clean training words, K is matched on the clean training
documents' maxima. A passage is significant when l*s - ln(K n) > 0; the document's statistic adds up its significant
passages (or takes the best one, if none is), and a logistic curve fitted on training rows turns it into a score.

The model is fitted on at most about ``train_rows`` labelled rows, chosen by a hash of the id (the bound that keeps
the broadcast model small); everything else covers all rows and whole texts. Null and empty texts have no words and
get the score of a text without any passage. Null labels are ignored, several labels of one id count as toxic if any
is; with no labels, or labels of one class only, every score is 0. Rows repeat as they are; an empty table gives an
empty result; columns other than the named ones are not read.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import kernel
from .tables import bounded_batches, cut

TRAIN_ROWS = 30_000
PREFIXES = (4, 5, 6, 7)
PRIOR = 10.0          # prior strength, in documents
ERRORS = 2.0          # standard errors that weights are drawn towards zero by
DRIFT = 0.05          # subtracted from every word's weight
LEAST = 2             # toxic documents that a feature must stand in to be held by the model
CUTOFF = 0.7
FLUSH_ROWS = 250_000  # feature rows that a task holds before it adds them up

PASSAGE = pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64())])


@dataclass
class Model:
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    rate: float = 1.0        # l
    log_k: float = 0.0
    slope: float = 0.0
    offset: float = 0.0
    fitted: bool = False

    def score(self, statistic: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.zeros(len(statistic))
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * statistic + self.offset, -40, 40)))


def features(w: kernel.Words) -> list[np.ndarray]:
    """Hashes of every word's features, shortest first; each level has its own hashes."""
    out = []
    for level, length in enumerate((*PREFIXES, None)):
        end = w.end if length is None else np.minimum(w.start + length, w.end)
        out.append(kernel.mix(w.hash_spans(w.start, end) + np.uint64(level + 1)))
    return out


def word_weights(model: Model, w: kernel.Words) -> np.ndarray:
    """Weight of every word, the drift taken off."""
    weight = np.zeros(len(w.start))
    if len(model.keys):
        for h in features(w):
            at = np.minimum(np.searchsorted(model.keys, h), len(model.keys) - 1)
            known = model.keys[at] == h
            weight[known] = model.weights[at[known]]
        hits = np.flatnonzero(weight > 0)
        if len(hits):   # the k-th use of a word in a document counts 1/k of the first
            order = hits[np.lexsort((hits, h[hits], w.doc[hits]))]
            same = (h[order][1:] == h[order][:-1]) & (w.doc[order][1:] == w.doc[order][:-1])
            begin = np.flatnonzero(np.r_[True, ~same])
            rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.r_[begin, len(order)]))
            weight[order] /= rank + 1
    return np.maximum(weight, -0.5) - DRIFT


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of one sequence, left to right, in linear time."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[list] = []       # [first, last, sum before, sum after, link to the last one that starts lower]
    for i in np.flatnonzero(scores > 0):
        left, right = float(total[i]), float(total[i + 1])
        first = last = int(i)
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append([first, last, left, right, j])
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(f, la, r - le) for f, la, le, r, _ in stack]


def doc_segments(model: Model, w: kernel.Words) -> tuple[list[list[tuple[int, int, float]]], np.ndarray]:
    """(segments of every document, word weights); documents without a positive word have none."""
    weight = word_weights(model, w)
    out: list[list[tuple[int, int, float]]] = [[] for _ in range(w.n_docs)]
    for d in np.unique(w.doc[weight > 0]):
        out[d] = maximal_segments(weight[w.first[d]:w.first[d + 1]])
    return out, weight


def statistic(model: Model, n_words: np.ndarray, segments: list[list[tuple[int, int, float]]]) -> np.ndarray:
    base = model.log_k + np.log(np.maximum(n_words, 1))
    out = -base
    for i, found in enumerate(segments):
        if found:
            bits = model.rate * np.array([s for _, _, s in found]) - base[i]
            out[i] = bits[bits > 0].sum() if (bits > 0).any() else bits.max()
    return np.arcsinh(out / 3)      # the logistic curve is about the border, not about how clear the clear cases are


def _count(labelled: DataFrame) -> DataFrame:
    """(feature, parent, toxic, clean): documents that hold each feature, added up inside tasks first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            key, parent, toxic = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.argsort(key)
            begin = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
            total = np.diff(np.r_[begin, len(key)])
            n1 = np.add.reduceat(toxic[order], begin, dtype=np.int64)
            first = order[begin]
            return pa.RecordBatch.from_arrays(
                [pa.array(key[first].view(np.int64)), pa.array(parent[first].view(np.int64)), pa.array(n1),
                 pa.array(total - n1)], names=["feature", "parent", "toxic", "clean"])

        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int8)
            for a, _, w in kernel.words(batch.column(0), kernel.ALNUM_WORDS):
                parent = np.zeros(len(w.start), np.uint64)
                for h in features(w):
                    # once per document: the words come document by document, a key that mixes in its number tells them apart
                    _, one = np.unique(kernel.mix(h ^ (w.doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))),
                                       return_index=True)
                    held.append((h[one], parent[one], label[a + w.doc[one]]))
                    size += len(one)
                    parent = h
                    if size > FLUSH_ROWS:
                        yield flush()
                        size = 0
        if size:
            yield flush()

    counted = labelled.select("text", "label").mapInArrow(run, "feature long, parent long, toxic long, clean long")
    return counted.groupBy("feature").agg(F.min("parent").alias("parent"), F.sum("toxic").alias("toxic"),
                                          F.sum("clean").alias("clean"))


def _weigh(table: pa.Table, share: float) -> tuple[np.ndarray, np.ndarray]:
    key = table["feature"].to_numpy().view(np.uint64)
    parent = table["parent"].to_numpy().view(np.uint64)
    n1, n0 = table["toxic"].to_numpy().astype(float), table["clean"].to_numpy().astype(float)
    order = np.argsort(key)
    key, parent, n1, n0 = key[order], parent[order], n1[order], n0[order]
    at = np.minimum(np.searchsorted(key, parent), max(0, len(key) - 1))
    has = (key[at] == parent) if len(key) else np.zeros(0, bool)
    theta = np.full(len(key), share)
    for _ in range(len(PREFIXES) + 1):        # one pass per level: each posterior becomes the next one's prior mean
        prior = np.where(has, theta[at], share)
        theta = (n1 + PRIOR * prior) / (n1 + n0 + PRIOR)
    prior = np.where(has, theta[at], share)
    a, b = n1 + PRIOR * prior + 0.5, n0 + PRIOR * (1 - prior) + 0.5
    odds = np.log(a / b) - np.log(share / (1 - share))
    return key, np.sign(odds) * np.maximum(0.0, np.abs(odds) - ERRORS * np.sqrt(1 / a + 1 / b))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps on smoothed targets, with a small ridge on the slope."""
    pos, neg = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 0.1, float(np.log(pos / neg))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -40, 40)))
        g = np.array([((target - p) * x).sum() - 1e-2 * a, (target - p).sum()])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * x * x).sum() + 1e-2, (v * x).sum()], [(v * x).sum(), v.sum()]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-7:
            break
    return float(a), float(b)


def sample_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", where=None,
                  train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(id, label) of about ``train_rows`` ids at most, chosen by a hash of the id."""
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if where is not None:
        rows = rows.where(where)
    rows = cut(rows.groupBy(F.col(id_col).alias("label_id")).agg(
        F.max((F.col(label_col) > 0).cast("int")).alias("label")), "toxicity-labels")
    share = min(1.0, train_rows / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64("label_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", where=None, train_rows: int = TRAIN_ROWS) -> Model:
    """The model from the labelled documents; ``where`` restricts the labels it may learn from."""
    bounded_batches(documents.sparkSession)
    chosen = sample_labels(labels, id_col, label_col, where, train_rows)
    labelled = documents.select(F.col(id_col).alias("label_id"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(chosen), "label_id")     # about train_rows short rows: bounded by the parameter
    totals = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return Model()
    share = totals[1] / (totals[0] + totals[1])
    table = _count(labelled).where(F.col("toxic") >= LEAST).toArrow()
    model = Model(*_weigh(table, share))
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)
    edges = np.linspace(-1.0, 15.0, 1601)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clean = np.zeros(len(edges) - 1, dtype=np.int64)
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b, w in kernel.words(batch.column(0), kernel.ALNUM_WORDS):
                segments, weight = doc_segments(shared.value, w)
                clean += np.histogram(np.clip(weight[label[a + w.doc] == 0], -0.999, 14.999), edges)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(label[a:b], pa.int32()), pa.array(np.diff(w.first), pa.int64()),
                     pa.array([[s for _, _, s in x] for x in segments], pa.list_(pa.float64())),
                     pa.nulls(b - a, pa.list_(pa.int64()))], names=["label", "n", "scores", "hist"])
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.float64())),
             pa.array([clean.tolist()], pa.list_(pa.int64()))], names=["label", "n", "scores", "hist"])

    measured = cut(labelled.select("text", "label").mapInArrow(
        measure, "label int, n long, scores array<double>, hist array<long>"), "toxicity-measured")
    bins = measured.where("hist is not null").select(F.posexplode("hist").alias("bin", "n")).groupBy("bin").agg(
        F.sum("n").alias("n")).toPandas().sort_values("bin")
    middle, weight = (edges[:-1] + edges[1:]) / 2, bins["n"].to_numpy(dtype=float)
    model.rate = _rate(middle, weight / max(1.0, weight.sum()))
    rows = measured.where("hist is null").select("label", "n", "scores").toPandas()   # bounded by train_rows
    y, n = rows["label"].to_numpy(dtype=float), rows["n"].to_numpy(dtype=float)
    segments = [[(0, 0, float(s)) for s in scores] for scores in rows["scores"]]
    best = np.array([max((s for _, _, s in x), default=0.0) for x in segments])
    calm = (y == 0) & (n > 0)
    if calm.any():   # the mean of the extreme-value law is Euler's constant
        model.log_k = float(np.mean(model.rate * best[calm] - np.log(n[calm])) - 0.5772156649)
    model.slope, model.offset = _logistic(statistic(model, n, segments), y)
    model.fitted = True
    return model


def _rate(values: np.ndarray, share: np.ndarray) -> float:
    """The positive root l of sum share * exp(l * value) = 1."""
    if not (share[values > 0] > 0).any() or (share * values).sum() >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    excess = lambda x: float((share * np.exp(np.minimum(x * values, 300))).sum()) - 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return low


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = ()
          ) -> DataFrame:
    """``keep`` columns, id, ``score`` in [0, 1], ``n_words``, ``passages`` (significant ones, word positions)."""
    spark = documents.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    names = list(dict.fromkeys([id_col, *keep]))
    rows = documents.select(*[F.col(c).alias(f"k_{c}") for c in names])
    kept = rows.schema.fields
    at = names.index(text_col) if text_col in names else len(names)
    if at == len(names) or kept[at].dataType != StringType():       # a text that is kept is not sent twice
        at = len(names)
        rows = documents.select(*[F.col(c).alias(f"k_{c}") for c in names], F.col(text_col).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for a, b, w in kernel.words(batch.column(at), kernel.ALNUM_WORDS):
                segments, _ = doc_segments(model, w)
                n = np.diff(w.first)
                base = model.log_k + np.log(np.maximum(n, 1))
                significant = [[{"first_word": f, "last_word": la, "score": model.rate * s - base[i]}
                                for f, la, s in found if model.rate * s > base[i]] for i, found in enumerate(segments)]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(kept)], pa.array(model.score(statistic(model, n.astype(float), segments))),
                     pa.array(n, pa.int64()), pa.array(significant, pa.list_(PASSAGE))],
                    names=[*part.schema.names[:len(kept)], "score", "n_words", "passages"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "score double", "n_words long",
                        "passages array<struct<first_word:long,last_word:long,score:double>>"])
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(f"k_{c}").alias(c) for c in names], "score", "n_words", "passages")


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def digest(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "toxic", cutoff: float = CUTOFF, train_rows: int = TRAIN_ROWS) -> DataFrame:
    model = fit(documents, labels, id_col, text_col, label_col, ~held_out(id_col), train_rows)
    scored = score(documents, model, id_col, text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score",
                         (F.col("score") >= cutoff).cast("int").alias("predicted"),
                         F.size("passages").cast("bigint").alias("n_passages"), "n_words")


def keep_clean(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "toxic", cutoff: float = CUTOFF, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The documents whose score is under ``cutoff``, with their own columns."""
    model = fit(documents, labels, id_col, text_col, label_col, ~held_out(id_col), train_rows)
    scored = score(documents, model, id_col, text_col, documents.columns)
    names = documents.columns
    clash = {"score", "n_words", "passages"} & set(names)
    if clash:   # own columns of those names go through untouched
        renamed = documents.withColumnsRenamed({c: f"own_{c}" for c in clash})
        return keep_clean(renamed, labels, id_col, text_col, label_col, cutoff, train_rows).withColumnsRenamed(
            {f"own_{c}": c for c in clash})
    return scored.where(F.col("score") < cutoff).select(*names)
