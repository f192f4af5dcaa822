"""N-gram Jaccard join in metric space: groups of documents whose word shingles overlap by 80 percent or more.

Jaccard distance is a metric, and the join partitions by it, first coarsely, then recursively, and always exactly.

*Regions.* Almost all pairs of documents are at distance 1, where document pivots tell nothing apart. So the first
pivots are single shingles, in one global order (rare before frequent, by a fixed-size sketch of shingle counts): a
document is nearest to the pivots it holds, and its window reaches over a little more than the first n - ceil(0.8 n) + 1 of them. Two
sets within distance 0.2 share at least ceil(0.8 n) shingles, so their windows meet: each linked pair is in a common
region. Documents that meet nobody in any region are done. Pairs whose windows share too little to reach 80 percent
are ruled out by counting; what may still hang together forms a family.

*Recursion.* A family of bounded size is joined in one task, exactly, by a product of its incidence matrix with
itself. A larger one gets document pivots: each document goes to its nearest pivot's Voronoi cell and, by the triangle
inequality, to every cell whose pivot is at most 2 * 0.2 farther (its linked partners lie in one of these cells).
Cells are split again until they are small; a cell that pivots do not shrink is joined block by block.

Only what is needed to know which documents hang together is written: in a task, links become one row per document.
Documents of equal words are handled once. Hashes have 64 bits; equal hashes of different shingles would have to meet
inside a pair to change a result.

Words are runs of other than space and controls 9 to 13, A-Z in lower case. A document of fewer than five words has
its whole word sequence as its one shingle. Null and empty texts have no shingles and link with nothing. Rows repeat
as they are: a repeated id is one vertex, whose links are those of all its rows; rows of a null id get no component.
An empty table gives an empty result. Only the named columns are read.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import kernel
from .components import connected_components
from .tables import ARRAY_SCHEMA, add_arrays, array_rows, bounded_batches, cut, small_batches, task_number

SHINGLE = 5
PERCENT = 80
SKETCH_BITS = 18
FILTER_BITS = 24
SPARE = 20            # windows are longer than needed by this part: so many shared shingles need no other region
REGION = 64           # documents of a region up to which its pairs are weighed one by one
FAMILY = 1024         # documents that one task joins at once
PIVOTS = 8
DEPTH = 4
SEEN = 2_000_000      # word sequences that a task remembers to handle equal ones once


def shingles(w: kernel.Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash) of all distinct shingles, sorted by document and hash, and a hash of each document's words."""
    h = w.hashes()
    count = np.diff(w.first)
    long = len(h) - size + 1
    if long > 0:
        mixed = np.zeros(long, dtype=np.uint64)
        for k in range(size):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + h[k:k + long]
        inside = w.doc[:long] == w.doc[size - 1:]
        doc, value = w.doc[:long][inside], kernel.mix(mixed[inside])
    else:
        doc, value = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    powers = kernel._powers(kernel._BASE, len(h) + 1)
    sums = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * powers[:len(h)], out=sums[1:])
    inverse = kernel._powers(kernel._BASE_INV, len(h) + 1)
    whole = kernel.mix((sums[w.first[1:]] - sums[w.first[:-1]]) * inverse[w.first[:-1]] + count.astype(np.uint64))
    short = np.flatnonzero((count > 0) & (count < size))
    doc = np.concatenate([doc, short])
    value = np.concatenate([value, kernel.mix(whole[short] + np.uint64(1))])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    fresh = np.r_[True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])] if len(doc) else np.zeros(0, dtype=bool)
    return doc[fresh], value[fresh], whole


def _window(n: np.ndarray) -> np.ndarray:
    """Shingles of the window: n - ceil(0.8 n) + 1, and a SPARE-th part of n more."""
    return np.where(n > 0, np.minimum(n, n - (PERCENT * n + 99) // 100 + 1 + n // SPARE), 0)


def _sketch(texts: DataFrame, size: int) -> np.ndarray:
    """Counts of shingle hashes by their upper bits, over the whole corpus (one array of fixed size)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int32)
        for batch in batches:
            for _, _, w in kernel.words(batch.column(0)):
                _, value, _ = shingles(w, size)
                total += np.bincount((value >> np.uint64(64 - SKETCH_BITS)).astype(np.int64),
                                     minlength=len(total)).astype(np.int32)
        yield array_rows(total, task_number())

    return add_arrays(texts.mapInArrow(run, ARRAY_SCHEMA), np.int32, 1 << SKETCH_BITS, texts.rdd.getNumPartitions())


def _frequency_class(counts: np.ndarray) -> np.ndarray:
    """0 for a bucket of ordinary count, else about log2 of its excess: the frequent shingles come last."""
    usual = float(np.median(counts))
    excess = (counts - usual) / (4 * np.sqrt(usual) + 4)
    return np.where(excess > 1, 1 + np.log2(np.maximum(excess, 1)), 0).astype(np.uint8)


class _Seen:
    """Hashes met before in this task; forgets them when there are too many (a repeat is only repeated work)."""

    def __init__(self) -> None:
        self.held: set[int] = set()

    def fresh(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values), dtype=bool)
        for i, v in enumerate(values.tolist()):
            if v not in self.held:
                self.held.add(v)
                out[i] = True
        if len(self.held) > SEEN:
            self.held.clear()
        return out


def _windows(documents: DataFrame, order: np.ndarray, size: int) -> DataFrame:
    """(id, n, whole, window): set size, word-sequence hash, and the shingles of the document's window in order; no
    window for a word sequence the task has met."""
    shared = documents.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        rank = shared.value
        for batch in batches:
            for a, b, w in kernel.words(batch.column(1)):
                doc, value, whole = shingles(w, size)
                n = np.bincount(doc, minlength=w.n_docs)
                cls = rank[(value >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                arranged = np.lexsort((value, cls, doc))
                begin = np.cumsum(n) - n
                place = np.arange(len(doc)) - np.repeat(begin, n)
                length = np.where(seen.fresh(whole) & (n > 0), _window(n), 0)
                keep = place < length[doc]
                bounds = np.r_[0, np.cumsum(length)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(whole.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(value[arranged][keep].view(np.int64)))],
                    names=["id", "n", "whole", "win"])

    return documents.mapInArrow(run, "id long, n long, whole long, win array<long>")


def _meetings(met: DataFrame) -> DataFrame:
    """(a, b): pairs of documents that may be linked, or that hang together through a region too large for pairs.

    ``met`` holds (shingle, whole, n, pos) of the regions with two documents or more. Let x and y share the fraction
    asked for: then at least 4/9 (|x| + |y|) shingles. If their first common one stands at pos, at most n - pos are left
    on either side. And of the common ones, those up to the end of the window that ends first lie in both windows; so
    they share at most c + max(n - window) with c common window shingles, which makes c at least n // SPARE for either.
    Regions of up to ``REGION`` documents are paired under these bounds. A document with fewer than n // SPARE window
    shingles in larger regions shares one in a small region with every partner, so it can leave the larger ones; in
    these, only the documents that consist of frequent text to that extent are tied to the first one of them."""
    sizes = met.groupBy("shingle").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least"))
    sizes = cut(sizes, "ngram-region-sizes")
    big = met.join(sizes.where(F.col("m") > REGION), "shingle")
    # the set of the smallest region mate is too large already: no partner can be first met here
    reachable = F.col("least") * 4 <= 9 * (F.col("n") - F.col("pos")) - 4 * F.col("n")
    in_big = cut(big.groupBy("whole").agg(F.count(F.lit(1)).alias("g")), "ngram-in-big")
    bound = cut(big.join(in_big, "whole").where((F.col("g") >= F.floor(F.col("n") / SPARE)) & reachable)
                .select("shingle", "whole"), "ngram-tied")
    pivot = cut(bound.groupBy("shingle").agg(F.min("whole").alias("pivot")), "ngram-pivots")
    tied = bound.join(pivot, "shingle").select(F.col("whole").alias("a"), F.col("pivot").alias("b"))
    small = cut(met.join(sizes.where(F.col("m") <= REGION).select("shingle"), "shingle"), "ngram-small")
    x = small.select("shingle", F.col("whole").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"))
    y = small.select(F.col("shingle").alias("same"), F.col("whole").alias("b"), F.col("n").alias("nb"),
                     F.col("pos").alias("pb"))
    smaller, larger = F.least("na", "nb"), F.greatest("na", "nb")
    rest = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    pairs = x.join(y, (F.col("shingle") == F.col("same")) & (F.col("a") < F.col("b"))
                   & (smaller * 100 >= PERCENT * larger)).groupBy("a", "b", "na", "nb").agg(
        F.count(F.lit(1)).alias("c"), F.max(rest).alias("rest"))
    window = lambda n: F.least(n, n - F.floor((PERCENT * n + 99) / 100) + 1 + F.floor(n / SPARE))
    pairs = pairs.join(in_big.select(F.col("whole").alias("a"), F.col("g").alias("ga")), "a", "left").join(
        in_big.select(F.col("whole").alias("b"), F.col("g").alias("gb")), "b", "left")
    unseen = F.least(F.coalesce("ga", F.lit(0)), F.coalesce("gb", F.lit(0)))    # common ones in large regions
    most = F.col("c") + unseen + F.greatest(F.col("na") - window(F.col("na")), F.col("nb") - window(F.col("nb")))
    # where no large region can hold an earlier common shingle, the first one met bounds the rest as well
    fits = (9 * most >= 4 * (F.col("na") + F.col("nb"))) & (
        (unseen > 0) | (9 * F.col("rest") >= 4 * (F.col("na") + F.col("nb"))))
    return tied.union(pairs.where(fits).select("a", "b"))


def _bits(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = kernel.mix(values.astype(np.uint64))
    limit = np.uint64((1 << FILTER_BITS) - 1)
    return (h & limit).astype(np.int64), ((h >> np.uint64(32)) & limit).astype(np.int64)


def _filter(nodes: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size (2^24 bits) over column ``node``; false positives drop out of the later join."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, dtype=bool)
        for batch in batches:
            for at in _bits(batch.column(0).to_numpy()):
                bits[at] = True
        yield array_rows(np.packbits(bits), task_number())

    size = 1 << (FILTER_BITS - 3)
    return add_arrays(nodes.select("node").mapInArrow(run, ARRAY_SCHEMA), np.uint8, size, nodes.rdd.getNumPartitions(),
                      bits=True)


def _sets(texts: DataFrame, wanted: np.ndarray, size: int) -> DataFrame:
    """(whole, n, items): the shingle sets (sorted 64-bit hashes as bytes) of the word sequences in the filter."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        bits = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            for _, _, w in kernel.words(batch.column(0)):
                doc, value, whole = shingles(w, size)
                n = np.bincount(doc, minlength=w.n_docs)
                one, two = _bits(whole)
                want = np.flatnonzero(bits[one] & bits[two] & (n > 0))
                want = want[seen.fresh(whole[want])]
                end = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(whole[want].view(np.int64)), pa.array(n[want], pa.int64()),
                     pa.array([value[end[d] - n[d]:end[d]].tobytes() for d in want], pa.binary())],
                    names=["whole", "n", "items"])

    return texts.mapInArrow(run, "whole long, n long, items binary")


def linked_roots(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """For each set, the first set it hangs together with: 100 * intersection >= percent * union, through any number
    of links. Exact: intersections are counted by a product of incidence matrices whose equal columns are merged."""
    m = len(sets)
    n = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), n)
    item, inverse, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = uses[inverse] > 1
    owner, inverse = owner[keep], inverse[keep]
    common = np.zeros((m, m), dtype=np.float64)
    if len(owner):
        mark = kernel.mix(np.arange(1, m + 1, dtype=np.uint64))
        signature = np.zeros(len(item), dtype=np.uint64)
        np.add.at(signature, inverse, mark[owner])
        used = np.unique(inverse)
        _, first, group, weight = np.unique(signature[used], return_index=True, return_inverse=True, return_counts=True)
        column = np.full(len(item), -1)
        column[used[first]] = np.arange(len(first))       # one column stands for all items of the same owners
        cols = column[inverse]
        owner, cols = owner[cols >= 0], cols[cols >= 0]
        for a in range(0, len(first), 8192):
            here = (cols >= a) & (cols < a + 8192)
            part = np.zeros((m, min(8192, len(first) - a)), dtype=np.float32)
            part[owner[here], cols[here] - a] = 1.0
            common += (part * weight[a:a + 8192].astype(np.float32)) @ part.T
    linked = 100 * common >= percent * (n[:, None] + n[None, :] - common)
    np.fill_diagonal(linked, True)
    root = np.arange(m)
    while True:
        low = np.where(linked, root[None, :], m).min(axis=1)
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _items(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(raw.as_buffer(), dtype=np.uint64) for raw in column]


def _join_groups(rows: pa.Table, key: str) -> pa.Table:
    """(a, b) from each set to the first one of its group that it hangs together with."""
    rows = rows.sort_by([(key, "ascending"), ("whole", "ascending")])
    group, whole = rows[key].to_numpy(), rows["whole"].to_numpy()
    fresh = np.r_[True, (group[1:] != group[:-1]) | (whole[1:] != whole[:-1])]
    rows = rows.filter(pa.array(fresh))
    group, whole, items = group[fresh], whole[fresh], _items(rows["items"])
    begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    a, b = [], []
    for lo, hi in zip(begin, np.r_[begin[1:], len(group)]):
        if hi - lo < 2:
            continue
        root = linked_roots(items[lo:hi])
        moved = np.flatnonzero(root != np.arange(hi - lo))
        a.append(whole[lo:hi][moved])
        b.append(whole[lo:hi][root[moved]])
    none = np.zeros(0, dtype=np.int64)
    return pa.table({"a": np.concatenate([none, *a]), "b": np.concatenate([none, *b])})


def _join_small(sets: DataFrame, key: str) -> DataFrame:
    """Joins groups of at most FAMILY sets; whole groups are dealt into tasks of about 16 MB."""
    volume = sets.agg(F.sum(F.length("items") + 64)).first()[0] or 0
    bins = max(1, -(-volume // (16 << 20)))
    return sets.select(F.col(key).alias("grp"), "whole", "items").withColumn(
        "bin", F.pmod(F.xxhash64("grp"), F.lit(bins))).groupBy("bin").applyInArrow(
        lambda t: _join_groups(t, "grp"), "a long, b long")


def _split(cells: DataFrame, sets: DataFrame, depth: int) -> DataFrame:
    """Cells (cell, whole) split by document pivots: rows (cell, whole, a, b) with the new cells and their boundary
    documents, and in a, b the links to pivots that turned up."""
    chance = F.xxhash64("whole", F.lit(depth))
    pivots = cells.withColumn("r", F.row_number().over(W.partitionBy("cell").orderBy(chance, "whole"))).where(
        F.col("r") <= PIVOTS).join(sets, "whole").groupBy("cell").agg(
        F.collect_list(F.struct("whole", "items")).alias("pivots"))
    pivots = cut(pivots, "ngram-cell-pivots")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(4)]
            for cell, whole, raw, near in zip(*[c.to_pylist() for c in batch.columns]):
                items = np.frombuffer(raw, dtype=np.uint64)
                distance = []
                for p in near:
                    other = np.frombuffer(p["items"], dtype=np.uint64)
                    at = np.minimum(np.searchsorted(other, items), len(other) - 1)
                    common = int((other[at] == items).sum())
                    distance.append(1 - common / (len(items) + len(other) - common))
                    if p["whole"] != whole and 100 * common >= PERCENT * (len(items) + len(other) - common):
                        for k, x in enumerate((None, None, whole, p["whole"])):
                            out[k].append(x)
                reach = min(distance) + 2 * (1 - PERCENT / 100) + 1e-9
                for p, d in zip(near, distance):
                    if d <= reach:
                        key = int(kernel.mix(np.array([cell, p["whole"]], dtype=np.int64).view(np.uint64))
                                  .sum(dtype=np.uint64).astype(np.int64))
                        for k, x in enumerate((key, whole, None, None)):
                            out[k].append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["cell", "whole", "a", "b"])

    return cells.join(sets, "whole").select("cell", "whole", "items").join(pivots, "cell").mapInArrow(
        run, "cell long, whole long, a long, b long")


def _join_blocks(cells: DataFrame, sizes: DataFrame, sets: DataFrame, family: int) -> DataFrame:
    """Joins cells that pivots do not separate: dealt into blocks, every two blocks meet in one task."""
    half = max(1, family // 2)
    blocks = cells.join(sizes.select("cell", F.ceil(F.col("size") / half).cast("int").alias("blocks")), "cell")
    mine = F.pmod(F.xxhash64("whole"), F.col("blocks")).cast("int")
    met = blocks.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.xxhash64("cell", F.least("mine", "other"), F.greatest("mine", "other"))
    return met.select(pair.alias("grp"), "whole").join(sets, "whole").select("grp", "whole", "items").groupBy(
        "grp").applyInArrow(lambda t: _join_groups(t, "grp"), "a long, b long")


def _join_families(cells: DataFrame, sets: DataFrame, family: int, depth_limit: int) -> DataFrame:
    """(a, b): links enough to tell which of the sets (whole, n, items) in the same cell (cell, whole) hang together.
    Cells are split by their ids alone; the sets themselves are only sent to where they are joined."""
    links = []
    for depth in range(depth_limit + 1):
        sizes = cut(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("size")), "ngram-sizes")
        small = cells.join(sizes.where((F.col("size") > 1) & (F.col("size") <= family)).select("cell"), "cell")
        links.append(cut(_join_small(small.join(sets, "whole"), "cell"), "ngram-links"))
        big = sizes.where(F.col("size") > family)
        if big.isEmpty():
            break
        large = cut(cells.join(big.select("cell"), "cell"), "ngram-large")
        grown = None
        if depth < depth_limit:
            with small_batches(sets.sparkSession, 256):     # a row carries its set and those of the pivots
                split = cut(_split(large, sets, depth), "ngram-cells")
            links.append(split.where(F.col("a").isNotNull()).select("a", "b"))
            grown = split.where(F.col("a").isNull()).select("cell", "whole")
        if grown is None or grown.count() > 2 * large.count():      # windows cover most cells: nothing is separated
            links.append(cut(_join_blocks(large, big, sets, family), "ngram-links"))
            break
        cells = grown
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    family: int = FAMILY, depth: int = DEPTH) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` (smallest id reachable by links, itself included)."""
    bounded_batches(documents.sparkSession)
    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    order = _frequency_class(_sketch(rows.select("text"), size))
    docs = cut(_windows(rows, order, size), "ngram-docs")
    windows = docs.where(F.size("win") > 0).select("whole", "n", F.posexplode("win").alias("pos", "shingle"))
    open_regions = windows.groupBy("shingle").agg(F.min("whole").alias("low"), F.max("whole").alias("high")).where(
        F.col("low") != F.col("high")).select("shingle")
    met = cut(windows.join(cut(open_regions, "ngram-regions"), "shingle").dropDuplicates(["shingle", "whole"]), "ngram-met")
    families = cut(connected_components(_meetings(met)), "ngram-family")
    sets = cut(_sets(rows.select("text"), _filter(families), size).join(families, F.col("whole") == F.col("node"))
               .select("whole", "n", "items").dropDuplicates(["whole"]), "ngram-sets")
    cells = families.select(F.col("component").alias("cell"), F.col("node").alias("whole"))
    hang = cut(connected_components(_join_families(cells, sets, family, depth)), "ngram-hang")
    # from word sequences back to ids; an id that repeats ties its rows together
    group = F.coalesce("component", "whole")
    placed = docs.where(F.col("n") > 0).select("id", "whole").join(
        hang.withColumnRenamed("node", "whole"), "whole", "left").select("id", group.alias("grp"))
    placed = cut(placed, "ngram-placed")
    first = cut(placed.where(F.col("id").isNotNull()).groupBy("grp").agg(F.min("id").alias("first")), "ngram-first")
    named = cut(placed.join(first, "grp").select("id", "first"), "ngram-named")
    several = named.groupBy("id").agg(
        F.min("first").alias("low"), F.max("first").alias("high")).where(F.col("low") != F.col("high"))
    if not several.isEmpty():     # one id in several groups: merge them
        merged = connected_components(named.select(F.col("id").alias("a"), F.col("first").alias("b")))
        named = named.join(merged, named["id"] == merged["node"], "left").select(
            "id", F.coalesce("component", "first").alias("first"))
    per_id = named.groupBy("id").agg(F.min("first").alias("first"))
    out = docs.select(F.col("id").alias("own"), "n").join(per_id, F.col("own") == F.col("id"), "left")
    return out.select(F.col("own").alias(id_col), F.col("n").alias("n_shingles"),
                      F.coalesce("first", "own").alias("component_id"))


def keep_one(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are the first of their group, with their own columns."""
    found = near_duplicates(documents, id_col, text_col).where(F.col("component_id") != F.col(id_col)).select(
        F.col(id_col).alias("__drop")).distinct()
    kept = documents.join(cut(found, "ngram-dropped"), F.col(id_col) == F.col("__drop"), "left_anti")
    return kept


ORACLE_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, hash(sh) AS sh FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')) END) AS sh
  FROM d)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  GROUP BY ALL),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n u ON u.doc_id = x JOIN n v ON v.doc_id = y
  WHERE 100 * c >= {PERCENT} * (u.n + v.n - c)),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
m AS (SELECT x, min(y) AS low FROM r GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.x = doc_id
"""
