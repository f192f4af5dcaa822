"""Document fingerprints by consistent weighted sampling (DataFrame functions only).

*Sampling.* For a term of weight S and a slot, three random numbers r, c (both of the gamma distribution with shape 2)
and b (uniform) are drawn from hashes of the term and the slot alone. With t = floor(ln S / r + b) the term's entry is
ln a = ln c - r * (t - b) - r, and the smallest entry of a text's terms is its sample in that slot. Two texts
agree in a slot with a probability equal to their generalised Jaccard similarity: the sum of the smaller weights of
each term over the sum of the larger ones. The sample is named by its entry, a function of (term, t) alone. The weight
of a word is the number of its uses in the text.

*Fewer logarithms.* The smallest entry a of a text is exponentially distributed with its total weight as rate. An entry
is at least c * exp(-r) / S, which products of the uniform numbers bound from below; terms that cannot come under
``ENOUGH`` / total weight are left out before any logarithm is taken. A document with a slot whose smallest entry is beyond
that is drawn anew from all of its terms, so the samples are the same in any case.

*Words* are the runs of lower-cased (A-Z) characters other than white space; a text without any counts as one term as it
stands, if it is not empty. An empty text has no terms and an empty fingerprint, equal to that of other empty texts only.

*Edited texts* (:func:`with_edits`): the last quarter of a text is replaced by the beginning of the next one in id order.
The order is made by range partitions over ids alone, only the borders of the partitions reach the driver, and the
text that follows is joined as the beginning that its neighbour needs. Texts are partitioned once, by
document; counting words and sampling then stay in the partition.

A null text counts as empty, a null id comes first. Rows of the same id are ordered by a hash of the text; a row that
repeats (same id and text) is one document in that order, and each of the rows gets its result. After the last document
comes the first, which is also the next one of a single document. Long texts: a task holds one text and its words at a time. An
empty table gives an empty result. Only the named columns are read, so that others cannot clash.
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import cut, shuffle_partitions, text_or_empty

SLOTS = 64
AT_ONCE = 4          # slots worked on in one row: enough to spare rows, few enough to compile well
ENOUGH = 28.0        # a slot's smallest entry is beyond ENOUGH / total weight with a probability of e^-28: then it is drawn anew
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text, as they stand there."""
    return F.array_remove(F.split(text, SPACE), "")


def lowered(word: Column) -> Column:
    """A-Z in lower case. Spark's translate looks up character by character; a word of ASCII alone needs none of it."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def _field(bits: Column, at: int, width: int) -> Column:
    return F.shiftrightunsigned(bits, at).bitwiseAND(F.lit((1 << width) - 1))


def _product(bits: Column, width: int) -> Column:
    """u1 * u2 of two uniform numbers of ``width`` bits each; -ln of it has the gamma distribution with shape 2."""
    u1, u2 = (_field(bits, width * k, width).cast("double") + 0.5 for k in (0, 1))
    return u1 * u2 * F.lit(0.25 ** width)


def draws(terms: DataFrame, keys: list[str], weights: list[str], term: str, slots: int, totals: list[str] | None) -> DataFrame:
    """(keys, __group, __log, __top and the random numbers): a row per term and ``AT_ONCE`` slots; with ``totals``, only
    rows in which an entry can be at most ``ENOUGH`` / total, and the numbers of those slots (null in the others)."""
    groups = -(-slots // AT_ONCE)
    of = range(len(weights))
    logs = terms.select(*keys, F.col(term).alias("__term"), *[
        F.when(F.col(w) > 0, F.log(F.col(w).cast("double"))).alias(f"__log{i}") for i, w in enumerate(weights)], *([
            (F.greatest(*[F.when(F.col(t) > 0, F.col(w) / F.col(t)).otherwise(0.0) for w, t in zip(weights, totals)], F.lit(0.0))
             * F.lit(ENOUGH * (1 + 1e-6))).alias("__most"),
            *[F.when(F.col(t) > 0, F.lit(math.log(ENOUGH)) - F.log(F.col(t).cast("double"))).alias(f"__top{i}")
              for i, t in enumerate(totals)]] if totals else []))
    rows = logs.withColumn("__group", F.explode(F.array(*[F.lit(g) for g in range(groups)])))
    hashed = rows.withColumns({f"__h{s}": F.xxhash64("__term", F.col("__group") * AT_ONCE + s) for s in range(AT_ONCE)})
    hashed = hashed.withColumns({f"__i{s}": F.xxhash64(f"__h{s}") for s in range(AT_ONCE)})
    hashed = hashed.withColumns({f"__{n}{s}": _product(F.col(f"__{bits}{s}"), 26) for s in range(AT_ONCE) for n, bits in (("p", "h"), ("q", "i"))})
    kept = [*keys, "__group", *[f"__log{i}" for i in of]]
    if totals:
        # a >= c * e^-r / S with e^-r = p, and c = -ln q >= 3 (1 - q^2) / (1 + 4 q + q^2): no logarithm is needed to tell
        kept += [f"__top{i}" for i in of]
        p, q = ([F.col(f"__{n}{s}") for s in range(AT_ONCE)] for n in "pq")
        hashed = hashed.withColumns({f"__may{s}": (3.0 - 3.0 * q[s] * q[s]) * p[s] <= F.col("__most") * (1.0 + (4.0 + q[s]) * q[s])
                                     for s in range(AT_ONCE)})
        # exploded once or not at all: a filter would be pushed below the columns that it reads, which would be worked out twice
        some = reduce(lambda x, y: x | y, [F.col(f"__may{s}") for s in range(AT_ONCE)])
        hashed = hashed.withColumn("__once", F.explode(F.when(some, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))))
    numbers = []
    for s in range(AT_ONCE):     # 128 random bits: 26 for each of four uniform numbers, 24 for the fifth
        h, i = F.col(f"__h{s}"), F.col(f"__i{s}")
        b = (_field(h, 52, 12) * 4096 + _field(i, 52, 12)).cast("double") * F.lit(0.5 ** 24)
        for n, e in (("r", -F.log(F.col(f"__p{s}"))), ("c", F.log(-F.log(F.col(f"__q{s}")))), ("b", b)):
            numbers.append((F.when(F.col(f"__may{s}"), e) if totals and n != "b" else e).alias(f"__{n}{s}"))
    found = hashed.select(*kept, *numbers)
    # ln a = (ln c - r + r * b) - r * t: what does not depend on the weight is worked out once
    return found.withColumns({n: e for s in range(AT_ONCE) for n, e in (
        (f"__base{s}", F.col(f"__c{s}") - F.col(f"__r{s}") + F.col(f"__r{s}") * F.col(f"__b{s}")),
        (f"__inverse{s}", F.lit(1.0) / F.col(f"__r{s}")))})


def samples(terms: DataFrame, keys: list[str], weights: list[str], term: str = "term", slots: int = SLOTS,
            totals: list[str] | None = None) -> DataFrame:
    """(keys, weights...): per group of ``keys`` and for each weight column the array of ``slots`` samples (empty for a
    group without a positive weight). ``terms`` holds a long ``term`` and the weights (null or 0: not in that text).
    Rows of a group are pre-aggregated in tasks, and stay where they are if ``terms`` is partitioned by the keys.

    ``totals``: columns with the sums of the weights in the group. A group's smallest entry is exponentially distributed
    with its total as rate, so it is nearly always at most ``ENOUGH`` / total, and terms whose entry must be larger
    are left out before its costly part. A sample that is not found so is null, or its array short (:func:`whole`)."""
    groups = -(-slots // AT_ONCE)
    of = range(len(weights))
    numbers = draws(terms, keys, weights, term, slots, totals)
    entries = []
    for i in of:
        for s in range(AT_ONCE):
            t = F.floor(F.col(f"__log{i}") * F.col(f"__inverse{s}") + F.col(f"__b{s}")).cast("double")
            entries.append(F.min(F.col(f"__base{s}") - F.col(f"__r{s}") * t).alias(f"__m{i}_{s}"))
    least = numbers.groupBy(*keys, "__group").agg(*entries, *[F.max(f"__top{i}").alias(f"__top{i}") for i in of if totals])
    if totals:      # beyond that, a term left out may have a smaller one
        least = least.withColumns({f"__m{i}_{s}": F.when(F.col(f"__m{i}_{s}") <= F.col(f"__top{i}"), F.col(f"__m{i}_{s}"))
                                   for i in of for s in range(AT_ONCE)})

    def named(entry: str) -> Column:
        return F.when(F.col(entry).isNull(), F.lit(None if totals else 0)).otherwise(F.xxhash64(entry).bitwiseAND(F.lit((1 << 32) - 1)))

    packed = least.select(*keys, F.struct(F.col("__group").alias("g"), *[
        F.array(*[named(f"__m{i}_{s}") for s in range(AT_ONCE)]).alias(f"m{i}") for i in range(len(weights))]).alias("part"))
    whole = packed.groupBy(*keys).agg(F.sort_array(F.collect_list("part")).alias("parts"))   # ``groups`` parts each
    out = []
    for i, w in enumerate(weights):
        found = F.slice(F.flatten(F.col("parts").getField(f"m{i}")), 1, slots)
        out.append(F.when(F.exists(found, lambda x: x != 0), found).otherwise(F.array().cast("array<bigint>")).alias(w))
    return whole.select(*keys, *out)


def likeness(a: Column, b: Column) -> Column:
    """The share of slots in which two arrays of samples agree; two empty ones agree, an empty one and another do not."""
    same = reduce(lambda x, y: x + y, [F.when(F.get(a, F.lit(s)) == F.get(b, F.lit(s)), 1).otherwise(0) for s in range(SLOTS)])
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0)).otherwise(
        same / F.size(a))


def shown(samples: Column) -> Column:
    """Samples as text: 8 hexadecimal digits each."""
    return F.array_join(F.transform(samples, lambda s: F.lower(F.lpad(F.hex(s), 8, "0"))), "")


def whole(empty: Column, samples: Column, slots: int = SLOTS) -> Column:
    """Whether every sample of a text was found (an empty text has none)."""
    return empty | F.coalesce((F.size(samples) == slots) & ~F.exists(samples, lambda x: x.isNull()), F.lit(False))


def fingerprints(documents: DataFrame, keys: list[str], texts: list[str], slots: int = SLOTS, every: bool = True) -> DataFrame:
    """(keys, texts...): the samples of several texts of each row, drawn together; ``keys`` name a row. Rows whose
    texts are all empty have no row. If ``documents`` is partitioned by its keys, nothing is shuffled. Without ``every``,
    terms that will hardly be a sample are left out (``totals`` of :func:`samples`); see :func:`whole`."""
    # in steps: what a later one reads more than once is worked out once
    split = documents.select(*keys, *texts, *[words(F.col(t)).alias(f"__words{i}") for i, t in enumerate(texts)])
    listed = split.select(*keys, F.array(*[
        F.when((F.size(f"__words{i}") == 0) & (F.col(t) != ""), F.array(t)).otherwise(F.col(f"__words{i}"))
        for i, t in enumerate(texts)]).alias("__lists"))
    sizes = listed.select(*keys, F.flatten("__lists").alias("__words"), *[
        reduce(lambda x, y: x + y, [F.size(F.col("__lists")[j]) for j in range(i + 1)]).alias(f"__end{i}")
        for i in range(len(texts))])
    # outer: else the optimiser tests size > 0 before the join, which would cut every text into words twice
    each = sizes.select(*keys, *[f"__end{i}" for i in range(len(texts))], F.posexplode_outer("__words").alias("__at", "__word")).where("__word is not null")
    counted = each.groupBy(*keys, F.xxhash64(lowered(F.col("__word"))).alias("__term")).agg(*[
        F.sum(((F.col("__at") < F.col(f"__end{i}")) & (F.col("__at") >= (F.col(f"__end{i - 1}") if i else F.lit(0))))
              .cast("int")).alias(t) for i, t in enumerate(texts)], *[
        F.max(F.col(f"__end{i}") - (F.col(f"__end{i - 1}") if i else F.lit(0))).alias(f"__total{i}") for i in range(len(texts)) if not every])
    return samples(counted, keys, texts, "__term", slots, None if every else [f"__total{i}" for i in range(len(texts))])


KEY = ["k1", "k2"]
TEXTS = ["text", "edited"]


def ordered(rows: DataFrame) -> DataFrame:
    """Distinct documents of (id, k1, k2, n) with their neighbours in id order: copies, next_k1, next_k2, prev_k1,
    prev_k2 and prev_n; the last one's next is the first. Written before it is returned."""
    spark = rows.sparkSession
    me = F.struct("id", "k1", "k2", "n")
    thin = rows.groupBy("id", "k1", "k2", "n").agg(F.count(F.lit(1)).alias("copies"))
    dealt = cut(thin.repartitionByRange(shuffle_partitions(spark), "id", "k1", "k2")
                .withColumn("part", F.spark_partition_id()), "fingerprint-order")
    borders = [r for r in dealt.groupBy("part").agg(F.min(me).alias("first"), F.max(me).alias("last"))
               .orderBy("part").collect()]          # one row per partition
    edge = "struct<id:{0},k1:long,k2:long,n:int>".format(rows.schema["id"].dataType.simpleString())
    edges = spark.createDataFrame(
        [(r["part"], borders[(k + 1) % len(borders)]["first"], borders[k - 1]["last"]) for k, r in enumerate(borders)],
        f"part int, after {edge}, before {edge}")
    w = W.partitionBy("part").orderBy("id", "k1", "k2")
    near = dealt.join(F.broadcast(edges), "part").withColumn("after", F.coalesce(F.lead(me).over(w), "after")).withColumn(
        "before", F.coalesce(F.lag(me).over(w), "before"))
    return cut(near.select("id", *KEY, "n", "copies", F.col("after.k1").alias("next_k1"), F.col("after.k2").alias("next_k2"),
                           F.col("before.k1").alias("prev_k1"), F.col("before.k2").alias("prev_k2"),
                           F.col("before.n").alias("prev_n")), "fingerprint-neighbours")


def with_edits(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(neighbours, texts): the table of :func:`ordered`, and (k1, k2, text, edited) partitioned by k1 and k2, one row
    per distinct document."""
    rows = documents.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    keyed = rows.select("id", F.xxhash64("id", "text").alias("k1"), F.xxhash64(F.lit(7), "text", "id").alias("k2"),
                        F.length("text").alias("n"), "text")
    near = ordered(keyed.select("id", *KEY, "n"))
    texts = keyed.select(*KEY, "text")
    if not near.where("copies > 1").isEmpty():
        texts = texts.dropDuplicates(KEY)
    # the merge hint keeps the partitioning by key, which counting and sampling go on with
    own = texts.join(near.select(*KEY, "n", "prev_k1", "prev_k2", "prev_n").hint("merge"), KEY)
    quarter = lambda n: F.floor(F.col(n) / 4).cast("int")
    heads = own.select(F.col("prev_k1").alias("k1"), F.col("prev_k2").alias("k2"),
                       F.substring("text", F.lit(1), quarter("prev_n")).alias("head"))
    both = own.select(*KEY, "n", "text").join(heads.hint("merge"), KEY)
    edited = F.concat(F.substring("text", F.lit(1), F.col("n") - quarter("n")), "head")
    return near, both.select(*KEY, "text", edited.alias("edited"))


def digest(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    near, texts = with_edits(documents, id_col, text_col)
    # the digest would be a wide key of every term: it is worked out beside the samples, over the same shuffled texts
    shas = texts.select(*KEY, F.sha2("edited", 256).alias("sha"), *[(F.col(t) == "").alias(f"no_{t}") for t in TEXTS])
    drawn = cut(shas.join(fingerprints(texts, KEY, TEXTS, every=False).hint("merge"), KEY, "left"), "fingerprint-samples")
    done = whole(F.col("no_text"), F.col("text")) & whole(F.col("no_edited"), F.col("edited"))
    if not drawn.where(~done).isEmpty():        # hardly ever: those documents are drawn from all of their terms
        anew = drawn.where(~done).drop(*TEXTS)
        rest = fingerprints(texts.join(anew.select(*KEY), KEY, "left_semi"), KEY, TEXTS)
        drawn = drawn.where(done).unionByName(cut(anew.join(rest, KEY, "left"), "fingerprint-samples"))
    none = F.array().cast("array<bigint>")
    own = near.select("id", "n", "copies", *KEY, "next_k1", "next_k2").join(drawn, KEY)
    after = drawn.select(F.col("k1").alias("next_k1"), F.col("k2").alias("next_k2"), F.col("text").alias("after"))
    rows = own.join(after, ["next_k1", "next_k2"], "left").select(
        "id", "n", "copies", "sha", *[F.coalesce(c, none).alias(c) for c in ("text", "edited", "after")])
    out = rows.select(
        F.col("id").alias(id_col), F.col("n").cast("bigint").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        shown(F.col("text")).alias("fingerprint"), shown(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("text"), F.col("edited")).alias("near_edited"),
        likeness(F.col("text"), F.col("after")).alias("near_next"), "copies")
    # rows that repeat: in two steps, so that no array grows beyond some thousand entries
    steps = out.withColumn("__k", F.explode(F.sequence(F.lit(0), ((F.col("copies") - 1) / 4096).cast("int"))))
    left = F.least(F.lit(4096), F.col("copies") - F.col("__k") * 4096).cast("int")
    return steps.withColumn("__k", F.explode(F.sequence(F.lit(1), left))).drop("__k", "copies")
