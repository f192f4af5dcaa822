"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

*Blocks.* Vectors become whole numbers floor(256 * c). They are sorted along a Hilbert curve through the dimensions of
the largest variance (its key, then the id, range partitions, so equal vectors spread too) and written as Parquet
blocks: a row holds up to ``BLOCK_ROWS`` vectors and its zone map, the smallest and largest value of every dimension
and of the label.

*Reading lists.* An anchor's scores in a block lie within the sum of its products with the zone map's interval ends.
For each anchor the blocks are listed whose interval meets what it looks for: for positives the blocks of its label
that reach the fifth best score in the anchor's own block, for negatives the blocks of another label that meet one
of its windows. Only listed blocks meet the anchor: neighbouring blocks, a tile, are held by a task through which the
rows of some thousand anchors pass that list one of them, each anchor once per tile with its lists of blocks. The best
few per tile, anchor and window are merged by a window over the anchor. Bounds and scores are whole numbers, so the
result does not depend on the blocks.

*Sizes.* A row here holds some thousand vectors, and rows for many blocks repeat them, which Parquet's dictionary
writes once. The size of a file thus tells little of its rows, and no join is left to Spark's guess of it, which would
broadcast them by way of the driver: anchors meet the zone maps as a Cartesian product of file splits, tiles meet their
anchors in one shuffle, and anchors meet their positives in a merge join.

*Windows.* Every positive p of an anchor asks for the best negatives with 50 * p <= 100 * score <= 95 * p.

Rows with a null id, label or vector, or with a null or non-finite component take no part. Rows of the same id are
rows of their own: each is a candidate, and each an anchor if the id says so; a row is never its own positive.
Scores tie by the smaller id. Vectors of another length than the longest are padded with zeros. A whole number beyond
2^26 (less for more than 1,024 dimensions) counts as that, so that every score fits a long. A positive of zero or less
asks for scores that only zero can meet, as the inequality says. Anchors without positives or negatives have no rows;
an empty table gives an empty result. Only the named columns are read.
"""
from __future__ import annotations

import contextlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import cut, small_batches, task_number
from .whitening import integers, usable

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LEAST, MOST = 50, 95         # a negative's score in hundredths of the positive's
BLOCK_ROWS = 2048
ROW_BITS = 12                # of a row's number that tell its place in the block
ANCHOR_ROWS = 2048           # anchors that look through the zone maps together
ZONE_ROWS = 32               # blocks of a tile at most: their zone maps are looked through together
TILE_BYTES = 32 << 20        # of a tile's blocks, at most if it has several
CORE_TILES = 4               # tiles for each core at least, as far as there are blocks
TILE_ASKED = 64              # rows of anchors that stream through a tile in one task, on average
ZONES_BYTES = 32 << 20       # zone maps in one file
TASK_ROWS = 65_536           # vectors sorted in one task
SLICE = 256                  # anchors scored against a block at once
KEY_DIMS, KEY_BITS = 15, 4   # dimensions and bits of each in the Hilbert key
ROWS_AT_ONCE = 8             # rows of a batch, of Arrow or the Parquet reader, where a row holds a block

BLOCK = "block long, n int, low binary, high binary, label_low long, label_high long, ids binary, labels binary, x binary"
ANCHOR = "uid long, anchor_id long, label long, x binary, least long"
FOUND = "uid long, anchor_id long, positive int, positive_id long, positive_score long, id long, score long"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of points with whole coordinates (rows x dims) of ``bits`` bits each.

    The coordinates are turned level by level, from the highest bit down, into the frame of the sub-cube that holds the
    point (a reflection where the bit is set, a swap with the first axis where it is not); Gray decoding across the
    axes then gives the digits, which are read level by level."""
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        below = q - one
        for i in range(dims):
            is_set = (x[i] & q) != 0
            swap = np.where(is_set, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(is_set, below, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], dtype=np.uint64)
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        turn ^= np.where((x[-1] & q) != 0, q - one, np.uint64(0))
    x ^= turn
    key = np.zeros(x.shape[1], dtype=np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << one) | ((x[i] >> np.uint64(level)) & one)
    return key.astype(np.int64)


@dataclass
class Frame:
    """What the tasks share: the width, the bound of the whole numbers, the quantisation of the Hilbert key; in how many
    tasks the vectors are sorted, and how many low bits of a block's number its tile leaves out."""
    dims: int
    rows: int
    most: int
    axes: np.ndarray
    middle: np.ndarray
    width: np.ndarray
    parts: int = 1
    bits: int = 0

    def key(self, x: np.ndarray) -> np.ndarray:
        if not len(self.axes):
            return np.zeros(len(x), np.int64)
        top = 1 << KEY_BITS
        cells = np.floor((x[:, self.axes] - self.middle) / self.width * top + top / 2)
        return hilbert(np.clip(cells, 0, top - 1).astype(np.uint64), KEY_BITS)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total, square = 0, np.zeros(0), np.zeros(0)
    for batch in batches:
        x = integers(batch.column(0), scale=SCALE, most=1 << 26).astype(float)
        more = x.shape[1] - len(total)
        if more > 0:
            total, square = np.pad(total, (0, more)), np.pad(square, (0, more))
        total[:x.shape[1]] += x.sum(axis=0)
        square[:x.shape[1]] += (x * x).sum(axis=0)
        n += len(x)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, len(total), dtype=np.int32)), pa.array(np.r_[float(n), total]),
             pa.array(np.r_[0.0, square])], names=["dim", "total", "square"])


def frame(rows: DataFrame) -> Frame | None:
    """Fitted on all rows of (v); one number per dimension reaches the driver."""
    sums = rows.select("v").mapInArrow(_moments, "dim int, total double, square double").groupBy("dim").agg(
        F.sum("total").alias("total"), F.sum("square").alias("square")).orderBy("dim").toPandas()
    if not len(sums):
        return None
    n, total, square = sums["total"][0], sums["total"].to_numpy()[1:], sums["square"].to_numpy()[1:]
    dims = len(total)
    mean = total / n
    variance = np.maximum(square / n - mean ** 2, 0.0)
    axes = np.argsort(-variance, kind="stable")[:KEY_DIMS]
    axes = axes[variance[axes] > 0]
    most = 1 << min(26, (62 - max(0, dims - 1).bit_length()) // 2)
    return Frame(dims, int(n), most, axes, mean[axes], 5 * np.sqrt(variance[axes]))


def _long(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _batch(names: str, columns: list) -> pa.RecordBatch:
    """A batch of plain Python or numpy columns under a schema like ``a long, b binary``."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.strip().split() for f in names.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)],
                                      names=[n for n, _ in fields])


@contextlib.contextmanager
def large_rows(spark: SparkSession) -> Iterator[None]:
    """Batches of ``ROWS_AT_ONCE`` rows for what runs inside, also where Parquet is read: its reader holds a batch of
    every column, of 4,096 rows if nothing is set."""
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name)
    spark.conf.set(name, str(ROWS_AT_ONCE))
    try:
        with small_batches(spark, ROWS_AT_ONCE):
            yield
    finally:
        spark.conf.set(name, before)


def blocks(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label"
           ) -> tuple[DataFrame | None, Frame | None]:
    """The written table of blocks in Hilbert order, and what the tasks share; (None, None) if no row takes part."""
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    shape = frame(rows)
    if shape is None:
        return None, None
    full, cores = -(-shape.rows // BLOCK_ROWS), spark.sparkContext.defaultParallelism
    shape.parts = max(min(cores, full), -(-shape.rows // TASK_ROWS))
    held = min(ZONE_ROWS, TILE_BYTES // (BLOCK_ROWS * (4 * shape.dims + 16)), full // max(1, CORE_TILES * cores))
    shape.bits = max(1, held).bit_length() - 1
    shared = spark.sparkContext.broadcast(shape)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = shared.value
        for batch in batches:
            x = integers(batch.column(2), shape.dims, SCALE, shape.most)
            raw = x.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shape.key(x)), batch.column(0), batch.column(1),
                 pa.array([r.tobytes() for r in raw], pa.binary())], names=["key", "id", "label", "x"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape, task, made = shared.value, task_number(), 0
        held: list[pa.RecordBatch] = []

        def block(part: pa.Table) -> pa.RecordBatch:
            ids, labels = _long(part["id"]), _long(part["label"])
            x = np.frombuffer(b"".join(part["x"].to_pylist()), dtype=np.int32).reshape(len(ids), shape.dims)
            order = np.argsort(ids, kind="stable")      # inside a block by id: ties are settled by the place
            ids, labels, x = ids[order], labels[order], np.ascontiguousarray(x[order])
            return _batch(BLOCK, [[(task << 20) + made], [len(ids)], [x.min(axis=0).tobytes()],
                                  [x.max(axis=0).tobytes()], [int(labels.min())], [int(labels.max())],
                                  [ids.tobytes()], [labels.tobytes()], [x.tobytes()]])

        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            while size >= BLOCK_ROWS:
                whole = pa.Table.from_batches(held)
                yield block(whole.slice(0, BLOCK_ROWS))
                made += 1
                held = whole.slice(BLOCK_ROWS).to_batches()
                size -= BLOCK_ROWS
        if size:
            yield block(pa.Table.from_batches(held))

    placed = rows.mapInArrow(place, "key long, id long, label long, x binary")
    sorted_rows = placed.repartitionByRange(shape.parts, "key", "id", "label").sortWithinPartitions("key", "id", "label")
    return cut(sorted_rows.mapInArrow(pack, BLOCK), "negatives-blocks"), shape


def _scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: floats or doubles where they hold every sum, else longs."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 24:
        return (a.astype(np.float32) @ x.astype(np.float32).T).astype(np.int64)
    if most < 1 << 53:
        return (a.astype(float) @ x.astype(float).T).astype(np.int64)
    return a.astype(np.int64) @ x.astype(np.int64).T


NONE, MOST_LONG = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _best(scores: np.ndarray, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, k: int
          ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each range (a column of ``low`` and ``high``, one bound for each row): (row, place, score) of each row's ``k``
    largest allowed scores within it, the earlier place first among equal ones. ``low`` is raised to the k-th of these.
    Only scores that some range of the row holds are sorted, once for all ranges."""
    some = low <= high
    least = np.where(some, low, MOST_LONG).min(axis=1)
    most = np.where(some, high, NONE).max(axis=1)
    i, j = np.nonzero(allowed & (scores >= least[:, None]) & (scores <= most[:, None]))
    score = scores[i, j]
    order = np.lexsort((-score, i))         # stable: the earlier place first
    i, j, score = i[order], j[order], score[order]
    ends = np.searchsorted(i, np.arange(len(scores) + 1))
    for p in range(low.shape[1]):
        above = np.bincount(i[score > high[i, p]], minlength=len(scores))
        at = (ends[:-1] + above)[:, None] + np.arange(k)
        held = at < ends[1:, None]
        held[held] = score[at[held]] >= np.broadcast_to(low[:, p, None], at.shape)[held]
        full = np.flatnonzero(held[:, -1])
        low[full, p] = score[at[full, -1]]
        yield np.nonzero(held)[0], j[at[held]], score[at[held]]


def anchors(table: DataFrame, shape: Frame, every: int, positives: int = POSITIVES) -> DataFrame:
    """Rows of ``ANCHOR``: the rows whose id ``every`` divides, with the score that the last of their positives has at
    least, as far as their own block shows (null: fewer in there)."""
    dims = shape.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, ids, labels, x in zip(*(batch.column(c).to_pylist() for c in range(4))):
                ids, labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
                x = np.frombuffer(x, np.int32).reshape(len(ids), dims)
                for at in np.array_split(np.flatnonzero(ids % every == 0), max(1, len(ids) // SLICE)):
                    if not len(at):
                        continue
                    allowed = labels[at][:, None] == labels[None, :]
                    allowed[np.arange(len(at)), at] = False
                    held = np.where(allowed, _scores(x[at], x), NONE)
                    kth = min(positives, held.shape[1])
                    least = np.partition(held, held.shape[1] - kth, axis=1)[:, held.shape[1] - kth]
                    known = (least != NONE) & (kth == positives)
                    yield _batch(ANCHOR, [(number << ROW_BITS) + at, ids[at], labels[at], [r.tobytes() for r in x[at]],
                                          pa.array(least, mask=~known)])

    with large_rows(table.sparkSession):
        return cut(table.select("block", "ids", "labels", "x").mapInArrow(run, ANCHOR), "negatives-anchors")


#: An anchor as it looks for something: ``windows`` are (positive, positive id, its score) as longs, none when positives
#: are looked for.
ASKED = "uid binary, anchor_id binary, label binary, x binary, least binary, windows binary"
#: For a tile, its ``blocks`` that are listed, how many anchors list each (``n``) and the uid of each of these, block by
#: block; the anchors follow once, by uid.
LISTED = "tile long, blocks binary, n binary, " + ASKED


def _gather(dims: int):
    """Anchors of a task, ``ANCHOR_ROWS`` to a row of ``ASKED`` (arrays as bytes; a missing bound is the least long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ANCHOR_ROWS):
                part = batch.slice(at, ANCHOR_ROWS)
                least = np.array([NONE if v is None else v for v in part.column(4).to_pylist()], np.int64)
                windows = b"" if part.num_columns < 6 else b"".join(part.column(5).to_pylist())
                yield _batch(ASKED, [[_long(part.column(0)).tobytes()], [_long(part.column(1)).tobytes()],
                                     [_long(part.column(2)).tobytes()], [b"".join(part.column(3).to_pylist())],
                                     [least.tobytes()], [windows]])
    return run


ZONES = "tile long, block binary, low binary, high binary, label_low binary, label_high binary"


def _zones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Zone maps, those of a tile that stand together in one row."""
    for batch in batches:
        tile = _long(batch.column(0))
        for run in np.split(np.arange(len(tile)), np.flatnonzero(np.diff(tile)) + 1):
            if not len(run):
                continue
            part = batch.slice(run[0], len(run))
            yield _batch(ZONES, [[int(tile[run[0]])], [_long(part.column(1)).tobytes()],
                                 *[[b"".join(part.column(c).to_pylist())] for c in (2, 3)],
                                 [_long(part.column(4)).tobytes()], [_long(part.column(5)).tobytes()]])


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interval arithmetic: least and largest inner product that each row of ``a`` can have within each zone map."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return _scores(up, low) + _scores(down, high), _scores(up, high) + _scores(down, low)


def _limits(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest whole score of each window; where no score is allowed, the least is above the largest."""
    p = windows[..., 2].astype(object)
    least, most = -(-(LEAST * p) // 100), (MOST * p) // 100
    empty = (windows[..., 0] == 0) | (least > most)
    return (np.where(empty, np.int64(1), least).astype(np.int64), np.where(empty, np.int64(0), most).astype(np.int64))


def _arrays(values: list, dims: int) -> tuple[np.ndarray, ...]:
    uid, anchor_id, label, x, least, windows = values
    uid = np.frombuffer(uid, np.int64)
    return (uid, np.frombuffer(anchor_id, np.int64), np.frombuffer(label, np.int64),
            np.frombuffer(x, np.int32).reshape(len(uid), dims), np.frombuffer(least, np.int64),
            np.frombuffer(windows, np.int64).reshape(len(uid), -1, 3))


def reading_lists(asked: DataFrame, table: DataFrame, shape: Frame) -> DataFrame:
    """Rows of ``LISTED``: for each tile the anchors that must read one of its blocks, and which. Every gathered row of
    anchors meets the zone maps of every tile."""
    spark, dims = table.sparkSession, shape.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values in zip(*(batch.column(c).to_pylist() for c in range(12))):
                uid, anchor_id, label, x, least, windows = _arrays(values[:6], dims)
                block, first, last = (np.frombuffer(values[k], np.int64) for k in (7, 10, 11))
                low, high = (np.frombuffer(values[k], np.int32).reshape(len(block), dims) for k in (8, 9))
                under, over = bounds(x, low, high)
                if windows.shape[1]:
                    wanted = np.zeros(under.shape, dtype=bool)
                    for lo, hi in zip(*(w.T for w in _limits(windows))):
                        wanted |= (lo <= hi)[:, None] & (over >= lo[:, None]) & (under <= hi[:, None])
                    wanted &= (first != last)[None, :] | (first[None, :] != label[:, None])
                else:
                    wanted = (first[None, :] <= label[:, None]) & (label[:, None] <= last[None, :])
                    wanted &= over >= least[:, None]
                at, some = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
                if not len(at):
                    continue
                at = at[np.argsort(uid[at])]
                lists = wanted[np.ix_(at, some)].T
                yield _batch(LISTED, [[values[6]], [block[some].tobytes()], [lists.sum(axis=1, dtype=np.int64).tobytes()],
                                      [uid[at][np.nonzero(lists)[1]].tobytes()],
                                      *[[np.ascontiguousarray(c[at]).tobytes()] for c in (anchor_id, label, x, least, windows)]])

    maps = table.select(_tile(shape), "block", "low", "high", "label_low", "label_high")
    files = -(-shape.rows // BLOCK_ROWS) * (8 * dims + 24) // ZONES_BYTES + 1
    with small_batches(spark, 32 * ZONE_ROWS):
        zones = cut(maps.mapInArrow(_zones, ZONES).repartition(files), "negatives-zones")
    return asked.hint("shuffle_replicate_nl").crossJoin(zones).mapInArrow(run, LISTED)


def _tile(shape: Frame) -> Column:
    return F.shiftright("block", shape.bits).alias("tile")


def _merged(found: list[list[np.ndarray]], k: int) -> pa.RecordBatch:
    """Columns of ``FOUND`` from several blocks, the ``k`` best per anchor and window; equal scores by the smaller id."""
    uid, anchor_id, positive, positive_id, positive_score, ids, score = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((ids, -score, positive, uid))
    new = np.r_[True, (np.diff(uid[order]) != 0) | (np.diff(positive[order]) != 0)][:len(order)]
    place = np.arange(len(order))
    order = order[place - np.maximum.accumulate(np.where(new, place, 0)) < k]
    return _batch(FOUND, [uid[order], anchor_id[order], positive[order].astype(np.int32), positive_id[order],
                          positive_score[order], ids[order], score[order]])


def read(listed: DataFrame, table: DataFrame, shape: Frame, k: int, slices: int = 1) -> DataFrame:
    """Rows of ``FOUND``: the ``k`` best rows of the listed blocks, per anchor (of its label) or per window (of another
    label). A task holds a tile's blocks while the rows that list them pass; ``slices`` tasks share the rows of a tile."""
    dims = shape.dims

    def best(block: int, ids: np.ndarray, labels: np.ndarray, y: np.ndarray, own: np.ndarray, asked: tuple[np.ndarray, ...],
             low: np.ndarray, high: np.ndarray) -> Iterator[list[np.ndarray]]:
        for at in range(0, len(own), SLICE):
            rows = own[at:at + SLICE]
            uid, anchor_id, label, x, _, windows = (c[rows] for c in asked)
            allowed = (label[:, None] == labels[None, :]) ^ bool(windows.shape[1])
            if not windows.shape[1]:
                windows = np.zeros((len(rows), 1, 3), np.int64)
                itself = np.flatnonzero(uid >> ROW_BITS == block)
                allowed[itself, uid[itself] & ((1 << ROW_BITS) - 1)] = False
            least = low[rows]
            for p, (i, j, score) in enumerate(_best(_scores(x, y), allowed, least, high[rows], k)):
                w = windows[i, p]
                yield [uid[i], anchor_id[i], w[:, 0], w[:, 1], w[:, 2], ids[j], score]
            low[rows] = least       # later blocks of the tile need not show less than the k best of this one

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, {}
        for batch in batches:
            for values in zip(*(column.to_pylist() for column in batch.columns)):
                tile, block, ids, labels, y, some, n = values[0], *values[3:9]
                if tile != here:
                    here, held = tile, {}
                if block is not None:
                    ids, labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
                    held[block] = ids, labels, np.frombuffer(y, np.int32).reshape(len(ids), dims)
                    continue
                uid, at = np.unique(np.frombuffer(values[9], np.int64), return_inverse=True)
                asked = _arrays([uid.tobytes(), *values[10:]], dims)
                least, windows = asked[4:]
                if windows.shape[1]:
                    low, high = _limits(windows)
                else:
                    low, high = least[:, None].copy(), np.full((len(uid), 1), MOST_LONG)
                lists = np.split(at, np.cumsum(np.frombuffer(n, np.int64))[:-1])
                found = [f for b, own in zip(np.frombuffer(some, np.int64).tolist(), lists)
                         for f in best(b, *held[b], own, asked, low, high)]
                yield _merged(found, k)

    own = table.select(_tile(shape), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), F.lit(0).alias("kind"),
                       "block", "ids", F.col("labels").alias("row_labels"), F.col("x").alias("rows"))
    asking = listed.withColumns({"slice": F.pmod(F.xxhash64("uid"), F.lit(slices)).cast("int"), "kind": F.lit(1)})
    parts = ((-(-shape.rows // BLOCK_ROWS) >> shape.bits) + shape.parts) * slices
    rows = own.unionByName(asking, allowMissingColumns=True).repartition(parts, "tile", "slice")
    found = rows.sortWithinPartitions("tile", "slice", "kind").mapInArrow(run, FOUND)
    order = F.row_number().over(W.partitionBy("uid", "positive").orderBy(F.col("score").desc(), "id"))
    return found.withColumn("rank", order).where(F.col("rank") <= k)


def mine(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label",
         every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows whose id ``every``
    divides."""
    spark = vectors.sparkSession
    table, shape = blocks(vectors, id_col, vector_col, label)
    out = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if table is None:
        return spark.createDataFrame([], out)
    own = anchors(table, shape, every, positives)
    with small_batches(spark, ANCHOR_ROWS):
        asked = cut(own.mapInArrow(_gather(shape.dims), ASKED), "negatives-asked")
    slices = max(1, -(-asked.count() // TILE_ASKED))
    with large_rows(spark):
        near = cut(read(reading_lists(asked, table, shape), table, shape, positives, slices), "negatives-positives")
    # windows: the positives of an anchor in order, always ``positives`` triples of longs (zeros where it has fewer)
    triple = F.struct("rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    grouped = near.groupBy("uid").agg(F.sort_array(F.collect_list(triple)).alias("windows"))
    chosen = own.hint("merge").join(grouped, "uid").repartitionByRange(
        max(1, -(-shape.rows // (every * ANCHOR_ROWS))), "uid").sortWithinPartitions("uid")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.zeros((batch.num_rows, positives, 3), np.int64)
            for k, row in enumerate(batch.column(5).to_pylist()):
                for p, w in enumerate(row):
                    flat[k, p] = w["rank"], w["positive_id"], w["positive_score"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array([f.tobytes() for f in flat], pa.binary())],
                                             names=[*batch.schema.names[:5], "windows"])

    with small_batches(spark, ANCHOR_ROWS):
        again = cut(chosen.mapInArrow(windows, ANCHOR + ", windows binary").mapInArrow(_gather(shape.dims), ASKED),
                    "negatives-windows")
    with large_rows(spark):
        found = cut(read(reading_lists(again, table, shape), table, shape, negatives, slices), "negatives-found")
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                        "positive_score", F.col("score").alias("negative_score"))


def shifted_label(id_col: str = "vec_id", label_col: str = "label") -> Column:
    """The label, moved to the next of ten classes where 7 divides the id."""
    return F.when(F.col(id_col) % 7 == 0, (F.col(label_col) + 1) % 10).otherwise(F.col(label_col))


#: All rows against the anchors in DuckDB, by brute force.
ORACLE_SQL = f"""
WITH e AS (SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
           list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)) AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.x, b.x)::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND {LEAST} * positive_score <= 100 * score AND 100 * score <= {MOST} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
