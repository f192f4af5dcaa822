"""LM scoring with a hashed maximum-entropy model.

*Counts.* Every training token (words, and one end per document) is counted by its 64-bit hash over the whole corpus;
the base score adds up log10((c + 0.1) / (N + 0.1 * (V + 1))). The ``HEAD_WORDS`` most frequent tokens' counts (a
bounded table) are broadcast; the rest of a document's tokens are joined with the counts by a shuffle on the hash.

*Model.* P(token | history) = P(class | history) * P(token | class, history). The ``CLASSES * CLASS_SIZE`` most
frequent tokens form classes of neighbours in frequency rank; all other tokens form ``TAILS`` classes by their form
(length, last byte, bytes beyond ASCII). Both factors are softmaxes over hashed features of the history: the last
token, the last two (n-grams), the token two back and the one three back (skips). Inside a tail class the
probability is the smoothed count share, an unseen token counting as 0. So the score is a log10 probability.

*Training.* Each round sends the weights to all tasks; a task goes through its training documents in mini-batches of
positions with Adagrad steps (of a document's positions every ``rounds``-th, from another start in each round, so
that the rounds visit each position once), and its change of weights is added up over tasks, weighted by positions:
what is gathered grows with the corpus, what the driver holds has a fixed size. Scoring runs in numpy batches that
gather the weight rows of the active features only.

Null and empty texts are one end token. Rows repeat as they are (and count in training each time); a null id is never
held out. With no training rows all counts are 0, the base score is the uniform limit of its formula and the model
scores by its start weights; an empty table gives an empty result. Only the named columns are read.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel
from .tables import ARRAY_SCHEMA, add_arrays, array_rows, cut, task_number

HEAD_WORDS = 100_000
CLASSES, CLASS_SIZE = 32, 32
TAILS = 16
ROUNDS = 2
BATCH = 8192      # positions of one gradient step
BLOCK = 2048      # positions worked on at once where the result does not depend on it
RATE = 0.15
END = np.uint64(0x5851F42D4C957F2D)      # stands for the end of a document
START = np.uint64(0x14057B7EF767814F)    # stands for what precedes it
ONE_ROWS, PAIR_ROWS, INNER_ROWS = CLASSES * CLASS_SIZE + 1024, 4096, 4096
LN10 = np.log(10.0)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 10 == 0, F.lit(False))


@dataclass
class Tokens:
    """Tokens of a chunk: hash, document, tail class (for every token), and where documents begin."""
    hash: np.ndarray
    doc: np.ndarray
    tail: np.ndarray
    first: np.ndarray


def tokens(w: kernel.Words) -> Tokens:
    """The words of each document followed by its end."""
    n = w.n_docs
    first = w.first + np.arange(n + 1)
    size = len(w.start) + n
    h = np.empty(size, dtype=np.uint64)
    tail = np.zeros(size, dtype=np.int64)
    at = np.arange(len(w.start)) + w.doc
    h[at] = w.hashes()
    h[first[1:] - 1] = END
    length = w.end - w.start
    if len(w.start):
        last = w.buf.take(w.end - 1)
        plain = ((last >= 0x61) & (last <= 0x7A)) | (last >= 0x80)
        wide = np.zeros(len(w.start), dtype=bool)      # words with bytes beyond ASCII; such a byte is always in a word
        wide[np.searchsorted(w.start, np.flatnonzero(w.buf >= 0x80), side="right") - 1] = True
        tail[at] = (np.minimum(3, length // 4) * 2 + wide) * 2 + plain
    doc = np.repeat(np.arange(n), np.diff(first))
    return Tokens(h, doc, tail, first)


@dataclass
class Vocabulary:
    head: np.ndarray          # sorted hashes of the most frequent tokens
    head_count: np.ndarray
    rank: np.ndarray          # place of each head token by frequency
    total: int                # N
    distinct: int             # V
    tail_total: np.ndarray    # training tokens and distinct tokens of each tail class outside the ranked classes
    tail_distinct: np.ndarray

    def _places(self) -> tuple[np.uint64, np.ndarray, np.ndarray]:
        """(shift, where each value of the leading bits begins in ``head``, ``head`` with a last entry that none exceeds)"""
        if "_index" not in self.__dict__:
            bits = max(1, int(len(self.head)).bit_length() + 1)
            shift = np.uint64(64 - bits)
            begin = np.searchsorted(self.head, np.arange(1 << bits, dtype=np.uint64) << shift)
            self._index = shift, begin, np.r_[self.head, np.uint64(2 ** 64 - 1)]
        return self._index

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index into ``head`` or -1. Hashes are spread evenly: of those with the same leading bits few are in ``head``."""
        if not len(self.head):
            return np.full(len(h), -1)
        shift, begin, head = self._places()
        at = begin.take(h >> shift)
        less = np.flatnonzero(head.take(at) < h)
        while len(less):
            at[less] += 1
            less = less[head.take(at[less]) < h[less]]
        return np.where((head.take(at) == h) & (at < len(self.head)), at, -1)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / (self.total + 0.1 * (self.distinct + 1)))

    def inner_tail(self, count: np.ndarray, tail: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / (self.tail_total[tail] + 0.1 * (self.tail_distinct[tail] + 1)))


class Weights:
    """All weights in one flat float32 array: class bias and feature rows, then inner bias and feature rows."""
    OUT = CLASSES + TAILS
    SHAPES = [(1, OUT), (ONE_ROWS, OUT), (PAIR_ROWS, OUT), (ONE_ROWS, OUT), (ONE_ROWS, OUT),
              (CLASSES, CLASS_SIZE), (INNER_ROWS, CLASS_SIZE), (INNER_ROWS, CLASS_SIZE)]
    SIZE = sum(a * b for a, b in SHAPES)

    def __init__(self, flat: np.ndarray):
        self.flat = flat
        self.part, at = [], 0
        for a, b in self.SHAPES:
            self.part.append(flat[at:at + a * b].reshape(a, b))
            at += a * b


def _history(ids: np.ndarray, place: np.ndarray, back: int) -> np.ndarray:
    """``ids`` of the token ``back`` places before each token; the start's id before the document."""
    out = np.full(len(ids), ONE_ROWS - 1)
    out[back:] = ids[:-back] if back else ids
    out[place < back] = ONE_ROWS - 1
    return out


def _place(t: Tokens) -> np.ndarray:
    """Each token's place in its document."""
    return np.arange(len(t.doc)) - t.first[t.doc]


def _token_ids(vocabulary: Vocabulary, t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(head index or -1, rank among class words or -1, row of the token as a feature)."""
    head = vocabulary.find(t.hash)
    rank = np.where(head >= 0, vocabulary.rank[head] if len(vocabulary.rank) else 0, -1)
    ranked = np.where((rank >= 0) & (rank < CLASSES * CLASS_SIZE), rank, -1)
    rest = CLASSES * CLASS_SIZE + t.tail * 63 + (t.hash % np.uint64(63)).astype(np.int64)
    return head, ranked, np.where(ranked >= 0, ranked, rest)


def _features(ids: np.ndarray, t: Tokens, at: np.ndarray | None = None) -> list[np.ndarray]:
    """Feature rows of all tokens, or of those ``at`` these positions of the chunk."""
    place = _place(t)
    one, two, three = (_history(ids, place, k) for k in (1, 2, 3))
    if at is not None:
        one, two, three = one[at], two[at], three[at]
    pair = kernel.mix(one.astype(np.uint64) * np.uint64(4099) + two.astype(np.uint64))
    return [one, (pair % np.uint64(PAIR_ROWS)).astype(np.int64), two, three]


def _inner_rows(feature: np.ndarray, cls: np.ndarray) -> np.ndarray:
    return (kernel.mix(feature.astype(np.uint64) * np.uint64(CLASSES + 1) + cls.astype(np.uint64))
            % np.uint64(INNER_ROWS)).astype(np.int64)


def _row_max(a: np.ndarray) -> np.ndarray:
    """Largest entry of each row, by columns: several times quicker than along short rows."""
    return np.ascontiguousarray(a.T).max(axis=0)


def _logits(tables: list[np.ndarray], rows: list[np.ndarray], start: np.ndarray | None = None) -> np.ndarray:
    """Sum of the rows of the tables, added one after the other (first to ``start``, if given)."""
    out = tables[0].take(rows[0], axis=0)
    if start is not None:
        out += start
    for table, r in zip(tables[1:], rows[1:]):
        out += table.take(r, axis=0)
    return out


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Probabilities by row, in place of the logits."""
    logits -= _row_max(logits)[:, None]
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _step(target: np.ndarray, memory: np.ndarray, rows, g: np.ndarray) -> None:
    """Adagrad step on the named rows, which are distinct."""
    seen = memory[rows] + g * g
    memory[rows] = seen
    target[rows] += RATE * g / np.sqrt(seen)


def _sums(grad: np.ndarray, order: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sum of each run of the ordered rows, as ``reduceat`` gives it to the last bit (the first row, plus the sum of the
    others). Short runs, the great part, are added up side by side: ``reduceat`` takes them one number at a time."""
    count = np.diff(np.r_[begin, len(order)])
    out = grad.take(order.take(begin), axis=0)
    few = np.flatnonzero((count > 1) & (count <= 8))
    if len(few):
        others = grad.take(order.take(begin[few] + 1), axis=0)
        k, more = 2, np.flatnonzero(count[few] > 2)
        while len(more):
            others[more] += grad.take(order.take(begin[few[more]] + k), axis=0)
            k += 1
            more = more[count[few[more]] > k]
        out[few] += others
    many = count > 8
    if many.any():
        starts = np.cumsum(count[many]) - count[many]
        out[many] = np.add.reduceat(grad.take(order[np.repeat(many, count)], axis=0), starts, axis=0)
    return out


def _add_rows(target: np.ndarray, memory: np.ndarray, rows: np.ndarray, grad: np.ndarray) -> None:
    """Adagrad step on the rows that a batch touches."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")     # tables are short; 16-bit keys are sorted by radix
    r = rows[order]
    begin = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
    _step(target, memory, r[begin], _sums(grad, order, begin))


def _train_batch(w: Weights, m: Weights, feats: list[np.ndarray], cls: np.ndarray, slot: np.ndarray) -> None:
    n = len(cls)
    p = np.empty((n, Weights.OUT), dtype=w.flat.dtype)
    for a in range(0, n, BLOCK):        # forward in blocks that stay in the processor's cache
        b = slice(a, a + BLOCK)
        p[b] = _softmax(_logits(w.part[1:5], [f[b] for f in feats], w.part[0][0]))
    np.negative(p, out=p)
    p[np.arange(n), cls] += 1.0
    _step(w.part[0], m.part[0], slice(0, 1), np.add.reduceat(p, [0], axis=0))
    for k in range(4):
        _add_rows(w.part[1 + k], m.part[1 + k], feats[k], p)
    use = slot >= 0
    if use.any():
        c, s = cls[use], slot[use]
        rows = [c, _inner_rows(feats[0][use], c), _inner_rows(feats[2][use] + ONE_ROWS, c)]
        p = _softmax(_logits(w.part[5:8], rows))
        np.negative(p, out=p)
        p[np.arange(len(c)), s] += 1.0
        for k in range(3):
            _add_rows(w.part[5 + k], m.part[5 + k], rows[k], p)


def log10_probabilities(w: Weights, feats: list[np.ndarray], cls: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """log10 of P(class) * P(slot | class) for each token; tokens of tail classes (slot -1) get the class part only."""
    def chosen(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
        top = _row_max(logits)
        picked = logits[np.arange(len(at)), at] - top
        logits -= top[:, None]
        return picked - np.log(np.exp(logits, out=logits).sum(axis=1))

    out = np.empty(len(cls))
    for a in range(0, len(cls), BLOCK):
        b = slice(a, a + BLOCK)
        f, c, s = [x[b] for x in feats], cls[b], slot[b]
        logp = chosen(_logits(w.part[1:5], f, w.part[0][0]), c)
        use = s >= 0
        if use.any():
            cu, su = c[use], s[use]
            rows = [cu, _inner_rows(f[0][use], cu), _inner_rows(f[2][use] + ONE_ROWS, cu)]
            logp[use] += chosen(_logits(w.part[5:8], rows), su)
        out[b] = logp / LN10
    return out


def _class_of(ranked: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (np.where(ranked >= 0, ranked // CLASS_SIZE, CLASSES + tail),
            np.where(ranked >= 0, ranked % CLASS_SIZE, -1))


def count_tokens(texts: DataFrame) -> DataFrame:
    """(hash, tail, count) of all tokens of column ``text``, added up inside tasks before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            h, tail, c = (np.concatenate(x) for x in zip(*held))
            h, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            return h, tail[first], np.bincount(inverse, weights=c, minlength=len(h)).astype(np.int64)

        def batch_of(h, tail, c) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(tail.astype(np.int32)),
                                               pa.array(c)], names=["hash", "tail", "count"])

        for batch in batches:
            for _, _, w in kernel.words(batch.column(0)):
                t = tokens(w)
                h, first, c = np.unique(t.hash, return_index=True, return_counts=True)
                held.append((h, t.tail[first], c))
                size += len(h)
                if size > 2_000_000:
                    one = merged()
                    held[:] = [one]
                    size = len(one[0])
                    if size > 1_000_000:        # bounded memory: pass on what does not shrink
                        yield batch_of(*one)
                        held.clear()
                        size = 0
        if held:
            yield batch_of(*merged())

    rows = texts.mapInArrow(run, "hash long, tail int, count long")
    return rows.groupBy("hash").agg(F.min("tail").alias("tail"), F.sum("count").alias("count"))


def learn_vocabulary(counts: DataFrame, head_words: int = HEAD_WORDS) -> Vocabulary:
    """Totals of the written counts and the most frequent tokens. The count from which a token is in the head comes
    from a histogram of at most 64 * 8 bins, so no more than ``head_words`` rows reach the driver."""
    scale = F.floor(F.log2(F.col("count").cast("double")) * 8)
    bins = sorted(counts.groupBy(scale.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("count").alias("least"))
                  .collect(), key=lambda r: -r["bin"])
    least, have = 1 << 62, 0
    for r in bins:
        if have + r["n"] > head_words:
            break
        least, have = r["least"], have + r["n"]
    head = counts.where(F.col("count") >= least).toArrow()
    h = head["hash"].to_numpy().view(np.uint64)
    c, tail = head["count"].to_numpy().astype(np.int64), head["tail"].to_numpy().astype(np.int64)
    order = np.argsort(h)
    h, c, tail = h[order], c[order], tail[order]
    rank = np.empty(len(h), dtype=np.int64)
    rank[np.lexsort((h, -c))] = np.arange(len(h))
    total, distinct = np.zeros(TAILS), np.zeros(TAILS)
    for r in counts.groupBy("tail").agg(F.sum("count").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        total[r["tail"]], distinct[r["tail"]] = r["c"], r["n"]
    n, v = int(total.sum()), int(distinct.sum())
    top = rank < CLASSES * CLASS_SIZE        # tokens of ranked classes are not in tail classes
    total -= np.bincount(tail[top], weights=c[top], minlength=TAILS)
    distinct -= np.bincount(tail[top], minlength=TAILS)
    return Vocabulary(h, c, rank, n, v, total, distinct)


def start_weights(v: Vocabulary) -> np.ndarray:
    """Biases of the smoothed class and slot shares; everything else 0."""
    w = Weights(np.zeros(Weights.SIZE, dtype=np.float32))
    by_rank = np.zeros(CLASSES * CLASS_SIZE)
    top = v.rank < len(by_rank)
    by_rank[v.rank[top]] = v.head_count[top]
    by_rank += 0.5
    shares = np.concatenate([by_rank.reshape(CLASSES, CLASS_SIZE).sum(axis=1), v.tail_total + 0.5])
    w.part[0][0] = np.log(shares / shares.sum())
    inner = by_rank.reshape(CLASSES, CLASS_SIZE)
    w.part[5][:] = np.log(inner / inner.sum(axis=1, keepdims=True))
    return w.flat


def train(texts: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Weights after ``rounds`` of distributed updates, which together visit every position of column ``text`` once."""
    sc = texts.sparkSession.sparkContext
    flat = start_weights(vocabulary)
    shared_vocabulary = sc.broadcast(vocabulary)
    parts = max(1, texts.rdd.getNumPartitions())
    for r in range(rounds):
        shared = sc.broadcast(flat)

        def run(batches: Iterator[pa.RecordBatch], r: int = r, shared=shared) -> Iterator[pa.RecordBatch]:
            v = shared_vocabulary.value
            w = Weights(shared.value.copy())
            m = Weights(np.full(Weights.SIZE, 1.0, dtype=np.float32))
            seen = 0
            for batch in batches:
                for _, _, words in kernel.words(batch.column(0)):
                    t = tokens(words)
                    _, ranked, ids = _token_ids(v, t)
                    at = np.flatnonzero(_place(t) % rounds == r)     # in the document, however texts are chunked
                    cls, slot = _class_of(ranked[at], t.tail[at])
                    feats = _features(ids, t, at)
                    for a in range(0, len(at), BATCH):
                        b = slice(a, a + BATCH)
                        _train_batch(w, m, [f[b] for f in feats], cls[b], slot[b])
                    seen += len(at)
            # the task's change, weighted by its positions, and that weight in the last place
            yield array_rows(np.r_[(w.flat - shared.value) * np.float32(seen), np.float32(seen)].astype(np.float32),
                             task_number())

        total = add_arrays(texts.mapInArrow(run, ARRAY_SCHEMA), np.float32, Weights.SIZE + 1, parts)
        if total[-1] > 0:
            flat = (flat + total[:-1] / total[-1]).astype(np.float32)
        shared.destroy()
    return flat


def score(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
          head_words: int = HEAD_WORDS) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = documents.sparkSession
    rows = documents.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"),
                            F.col(text_col).cast("string").alias("text"))
    training = rows.where(~F.col("held_out")).select("text")
    counts = cut(count_tokens(training), "lm-counts")
    vocabulary = learn_vocabulary(counts, head_words)
    flat = train(training, vocabulary, rounds)
    shared_vocabulary, shared = spark.sparkContext.broadcast(vocabulary), spark.sparkContext.broadcast(flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, w = shared_vocabulary.value, Weights(shared.value)
        for batch in batches:
            for a, b, words in kernel.words(batch.column(2)):
                t = tokens(words)
                n = words.n_docs
                head, ranked, ids = _token_ids(v, t)
                cls, slot = _class_of(ranked, t.tail)
                model = log10_probabilities(w, _features(ids, t), cls, slot)
                known = head >= 0
                count = v.head_count[head[known]] if known.any() else np.zeros(0)
                inner = known & (ranked < 0)
                model[inner] += v.inner_tail(v.head_count[head[inner]], t.tail[inner])
                # the rest: distinct tokens of each document with their number of uses, for the join
                rest = np.flatnonzero(~known)
                order = rest[np.lexsort((t.hash[rest], t.doc[rest]))]
                h, d = t.hash[order], t.doc[order]
                begin = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])]) if len(h) else np.zeros(0, int)
                uses = np.diff(np.r_[begin, len(h)]).astype(np.int32)
                bounds = np.searchsorted(d[begin] if len(begin) else d, np.arange(n + 1)).astype(np.int32)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(t.first), pa.int64()),
                     pa.array(np.bincount(t.doc[known], minlength=n), pa.int64()),
                     pa.array(np.bincount(t.doc[known], weights=v.base(count), minlength=n)),
                     pa.array(np.bincount(t.doc, weights=model, minlength=n)),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(h[begin].view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(uses)),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(t.tail[order][begin].astype(np.int8)))],
                    names=["id", "held_out", "n_tokens", "n_known", "base", "model", "rest", "uses", "tails"])

    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"id {kind}, held_out boolean, n_tokens long, n_known long, base double, model double, "
                                  "rest array<long>, uses array<int>, tails array<tinyint>")
    scored = cut(scored.withColumn("uid", F.monotonically_increasing_id()), "lm-scored")
    rest = scored.select("uid", F.explode(F.arrays_zip("rest", "uses", "tails")).alias("r")).select(
        "uid", F.col("r.rest").alias("hash"), F.col("r.uses").alias("uses"), F.col("r.tails").alias("t"))
    # a hash of the rest is rarer than every head token, so no key of this join is hot; counts of 0 have no row
    joined = rest.join(counts.select("hash", "count"), "hash", "left").select(
        "uid", "uses", "t", F.coalesce("count", F.lit(0)).cast("double").alias("c"))
    v = vocabulary
    inner = F.element_at(F.array(*[F.lit(float(n + 0.1 * (d + 1))) for n, d in zip(v.tail_total, v.tail_distinct)]),
                         F.col("t").cast("int") + 1)
    extra = joined.groupBy("uid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("uses")).otherwise(0)).alias("more_known"),
        F.sum(F.col("uses") * F.log10((F.col("c") + 0.1) / F.lit(v.total + 0.1 * (v.distinct + 1)))).alias("more_base"),
        F.sum(F.col("uses") * F.log10((F.col("c") + 0.1) / inner)).alias("more_model"))
    nothing = F.lit(0.0)
    return scored.drop("rest", "uses", "tails").join(extra, "uid", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(v.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", nothing)).alias("base_score"),
        (F.col("model") + F.coalesce("more_model", nothing)).alias("score"))
