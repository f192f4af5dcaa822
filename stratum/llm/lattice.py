"""Embedding near-duplicates by lattice hashing.

*Hashing.* Unit vectors are projected at random to 8 dimensions (orthonormal directions, scaled) and decoded to the
nearest point of the E8 lattice; a table's key holds ``blocks`` such points. A vector is filed under its own key
and under the keys of neighbouring cells, those across the nearest faces of its cells, in ``tables`` independent
tables. ``blocks`` grows with the logarithm of the number of vectors, so that a cell holds few unrelated vectors at
any size, and ``tables`` follows from it so that a pair at the threshold is still found with the chosen recall.

*Candidates.* Inside a cell, vectors are compared by 64 sign bits of further random projections; each is paired with
the first and with the nearest one within ``MAX_BITS`` bits (a pair at cosine 0.9 differs in 9 on average), and marked
open if it has more such mates. A cell of more than ``CELL_ROWS`` vectors is dealt into several groups for this, by id
and key, so that other tables mix the groups anew; all its vectors are open.

*Verification.* Candidate pairs are verified by their cosine in double precision and contracted to components. Then
the open vectors of each cell that are not all of one component meet with their vectors, all pairs of them, and the
links found there join the components; a cell of more than ``CELL_ROWS`` open vectors is cut into blocks by component, and
every two blocks meet but those of one and the same component. Inside a component all links are counted exactly: small ones by one matrix
product, large ones in blocks ordered by the angle to the component's first vector, where the triangle inequality of
angles settles most block pairs unseen.

Vectors that are null, zero, or hold null or non-finite components link with nothing (kept). Equal vectors are hashed
once and counted by their number; a zero-distance copy is a link like any other. Rows with a repeated id stand for
the vector that comes first in array order, and each of them gets the id's result; a null id gets no links and
component null. Vectors of another length than the longest are padded with zeros. An empty table gives an empty
result. Only the two named columns are read.
"""
from __future__ import annotations

import functools
import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel
from .components import connected_components
from .tables import cut

THRESHOLD = 0.9
SCALE = 4.0            # of the projections: a unit vector of 64 components lands about 1.4 from the origin
CELL_SHARE = 1 / 250   # share of unrelated vectors in one E8 cell at that scale (measured)
CELL_RECALL = 0.49     # chance that a pair at cosine 0.9 meets in one E8 block, neighbours probed (measured)
MISSED = 0.04          # wanted chance that such a pair meets in no table
MAX_BITS = 22
CELL_ROWS = 4096
BLOCK = 2048
SEED = 5


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps to the neighbouring lattice points."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(v) for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


ROOTS = _roots()


def _decode_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, and where the sum is odd move the worst one the other way."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(axis=1) % 2 != 0)
    d = x[odd] - r[odd]
    k = np.abs(d).argmax(axis=1)
    r[odd, k] += np.where(d[np.arange(len(odd)), k] >= 0, 1.0, -1.0)
    return r


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: E8 is D8 and D8 moved by one half in every coordinate."""
    whole, half = _decode_d8(x), _decode_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


@functools.lru_cache(maxsize=4)
def _projections(dims: int, tables: int, blocks: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(tables x blocks orthonormal projections to 8 dimensions, scaled; 64 sign directions)."""
    rng = np.random.default_rng(seed)
    wide = max(dims, 8)
    cells = np.stack([np.linalg.qr(rng.normal(size=(wide, 8)))[0][:dims] * SCALE * math.sqrt(wide / 64)
                      for _ in range(tables * blocks)])
    return cells, rng.normal(size=(dims, 64))


def _point_hash(points: np.ndarray) -> np.ndarray:
    """64-bit hash of rows of (half-)integers."""
    doubled = (2 * points).astype(np.int64).astype(np.uint64)
    powers = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(points.shape[1])], dtype=np.uint64)
    return kernel.mix((doubled * powers).sum(axis=1, dtype=np.uint64))


def cell_keys(x: np.ndarray, tables: int, blocks: int, seed: int = SEED) -> Iterator[tuple[np.ndarray, bool]]:
    """For each table: (key of every vector, True) for its own cell, then the keys of neighbouring cells."""
    cells, _ = _projections(x.shape[1], tables, blocks, seed)
    for t in range(tables):
        options: list[list[np.ndarray]] = []     # per block: own point, then the nearest neighbours
        for b in range(blocks):
            y = x @ cells[t * blocks + b]
            own = decode_e8(y)
            near = np.argsort(-((y - own) @ ROOTS.T), axis=1, kind="stable")[:, :3]
            options.append([_point_hash(own), *[_point_hash(own + ROOTS[near[:, k]]) for k in range(3)]])
        choices = [(0,) * blocks]
        choices += [tuple(k if i == b else 0 for i in range(blocks)) for b in range(blocks) for k in (1, 2, 3)]
        choices += [tuple(1 if i in pair else 0 for i in range(blocks)) for pair in itertools.combinations(range(blocks), 2)]
        for choice in choices:
            key = np.full(len(x), np.uint64(t + 1))
            for b, k in enumerate(choice):
                key = kernel.mix(key * np.uint64(0x9E3779B97F4A7C15) + options[b][k])
            yield key, not any(choice)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors from a binary column of float64 bytes."""
    if not len(column):
        return np.zeros((0, 0))
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(len(column), -1)


def unit_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec, copy) of the usable vectors: float64 bytes of the unit vector and a 128-bit digest of it."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    usable = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull()).withColumn("v", F.when(usable, v)).groupBy("id").agg(F.min("v").alias("v"))
    rows = rows.where(F.col("v").isNotNull())
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            n = np.diff(column.offsets.to_numpy())
            x = np.zeros((len(n), dims))
            x[np.arange(dims) < n[:, None]] = column.flatten().to_numpy()
            top = np.abs(x).max(axis=1, keepdims=True)
            keep = top[:, 0] > 0
            x = x[keep] / top[keep]            # first by the largest component: no overflow in the norm
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            raw = [r.tobytes() for r in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(keep)), pa.array(raw, pa.binary()),
                 pa.array([hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary())],
                names=["id", "vec", "copy"])

    return rows.mapInArrow(run, "id long, vec binary, copy binary")


def _pair_up(ids: np.ndarray, codes: np.ndarray, out: list) -> np.ndarray:
    """Pairs of one cell (at most CELL_ROWS rows): with the first and with the nearest vector within MAX_BITS bits.
    Returns the open rows: those with a mate within MAX_BITS bits that they are not paired with."""
    mates, paired = np.zeros(len(ids), dtype=np.int64), []
    for a in range(0, len(ids), 512):
        b = slice(a, a + 512)
        far = np.bitwise_count(codes[b, None] ^ codes[None, :]).astype(np.int16)
        rows = np.arange(len(ids))[b]
        far[np.arange(len(rows)), rows] = 99
        near = far <= MAX_BITS
        some = near.any(axis=1)
        first, best = near.argmax(axis=1), far.argmin(axis=1)
        out.append(np.stack([ids[rows[some]], ids[first[some]]]))
        out.append(np.stack([ids[rows[some]], ids[best[some]]]))
        mates[rows] = near.sum(axis=1)
        paired += [np.stack([rows[some], first[some]]), np.stack([rows[some], best[some]])]
    p = np.concatenate(paired, axis=1)
    p = np.unique(p.min(axis=0) * len(ids) + p.max(axis=0))
    settled = np.bincount(p // len(ids), minlength=len(ids)) + np.bincount(p % len(ids), minlength=len(ids))
    return np.flatnonzero(mates > settled)


def _cells(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) and open rows (a, key) of rows (key, salt, id, code, several) sorted by key, salt and id; streams,
    holding one cell at most (and of a larger one ``limit`` rows)."""
    held: list[tuple[np.ndarray, ...]] = []

    def work(columns: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        key, salt, ids, codes, several = columns
        change = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
        begin = np.flatnonzero(np.r_[True, change])
        size = np.diff(np.r_[begin, len(key)])
        pairs: list[np.ndarray] = []
        more: list[np.ndarray] = [np.flatnonzero(several)]
        for at, n in zip(begin[size > 1], size[size > 1]):
            for a in range(at, at + n, limit):
                b = slice(a, min(a + limit, at + n))
                left = _pair_up(ids[b], codes[b], pairs)
                if not several[at]:
                    more.append(a + left)
        p = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
        p = p[:, p[0] != p[1]]
        p = np.unique(np.stack([p.min(axis=0), p.max(axis=0)]), axis=1) if p.size else p
        left = np.concatenate(more)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[p[0], ids[left]]),
             pa.concat_arrays([pa.array(p[1]), pa.nulls(len(left), pa.int64())]),
             pa.concat_arrays([pa.nulls(p.shape[1], pa.int64()), pa.array(key[left])])],
            names=["a", "b", "key"])

    def joined() -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(x) for x in zip(*held))

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        columns[3] = columns[3].view(np.uint64)
        held.append(tuple(columns))
        key, salt = columns[0], columns[1]
        if key[0] == key[-1] and salt[0] == salt[-1] and sum(len(h[0]) for h in held) < limit:
            continue                                   # the cell may go on: hold it
        both = joined()
        last = len(both[0]) if len(both[0]) >= 8 * limit and both[0][0] == both[0][-1] else int(
            np.flatnonzero(np.r_[True, (both[0][1:] != both[0][:-1]) | (both[1][1:] != both[1][:-1])])[-1])
        if last:
            yield from work(tuple(x[:last] for x in both))
        held[:] = [tuple(x[last:] for x in both)] if last < len(both[0]) else []
    if held:
        yield from work(joined())


def candidate_pairs(units: DataFrame, seed: int = SEED, cell_rows: int = CELL_ROWS) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a < b) of ids that meet in some cell and are near by their sign bits, and the open rows (key,
    id) of the cells: those with such pairs besides, and all rows of cells of more than ``cell_rows``."""
    n = max(2, units.count())
    blocks = max(1, math.ceil(math.log(n) / -math.log(CELL_SHARE) - 0.05))
    tables = math.ceil(math.log(MISSED) / math.log(1 - CELL_RECALL ** blocks))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = _matrix(part.column(1))
                signs = (x @ _projections(x.shape[1], tables, blocks, seed)[1]) > 0
                code = np.packbits(signs, axis=1).copy().view(np.uint64)[:, 0].view(np.int64)
                for key, own in cell_keys(x, tables, blocks, seed):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), part.column(0), pa.array(code), pa.array([own] * len(x))],
                        names=["key", "id", "code", "own"])

    filed = units.select("id", "vec").mapInArrow(file, "key long, id long, code long, own boolean")
    filed = cut(filed, "lattice-cells")
    # cells of one vector, or that nobody owns, pair nothing
    cells = filed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("own")).where(
        (F.col("n") > 1) & F.col("own"))
    cells = cut(cells.select("key", F.ceil(F.col("n") / cell_rows).cast("int").alias("groups")), "lattice-used")
    rows = filed.join(cells, "key").select(
        "key", F.pmod(F.xxhash64("id", "key"), F.col("groups")).cast("int").alias("salt"), "id", "code",
        (F.col("groups") > 1).alias("several"))
    met = cut(rows.repartition("key", "salt").sortWithinPartitions("key", "salt", "id").mapInArrow(
        lambda batches: _cells(batches, cell_rows), "a long, b long, key long"), "lattice-pairs")
    return (met.where(F.col("b").isNotNull()).select("a", "b").distinct(),
            met.where(F.col("key").isNotNull()).select("key", F.col("a").alias("id")))


def verified(pairs: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose cosine reaches the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.einsum("ij,ij->i", _matrix(batch.column(2)), _matrix(batch.column(3))) >= threshold
            yield batch.select([0, 1]).filter(pa.array(good))

    left = units.select(F.col("id").alias("a"), F.col("vec").alias("va"))
    right = units.select(F.col("id").alias("b"), F.col("vec").alias("vb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb").mapInArrow(run, "a long, b long")


def _join_up(ids: np.ndarray, component: np.ndarray, x: np.ndarray, threshold: float,
             left: int | None = None) -> list[tuple[int, int]]:
    """Links that join the components of the rows as all links between them do: at most one per component. With
    ``left``, only links between the first ``left`` rows and the rest."""
    rows, begin = (len(ids), 0) if left is None else (left, left)
    label = np.unique(component, return_inverse=True)[1]
    out = []
    for a in range(0, rows, 512):
        z = min(a + 512, rows)
        linked = (x[a:z] @ x[begin:].T) >= threshold
        for i in np.flatnonzero((linked & (label[a:z, None] != label[begin:])).any(axis=1)):
            mates = begin + np.flatnonzero(linked[i])
            labels, at = np.unique(label[mates], return_index=True)
            other = labels != label[a + i]
            out += [(int(ids[a + i]), int(ids[j])) for j in mates[at[other]]]
            label[np.isin(label, labels[other])] = label[a + i]
    return out


def open_links(rows: DataFrame, components: DataFrame, units: DataFrame, threshold: float,
               cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links (a, b) between the components that open rows (key, id) of a cell belong to, all pairs verified.
    Pairs inside a component need no link: they are counted later."""
    placed = cut(rows.join(components, rows["id"] == components["node"], "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")), "lattice-open")
    cells = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                      F.count(F.lit(1)).alias("n"))
    cells = cut(cells.where(F.col("low") < F.col("high")).select("key", "n"), "lattice-open-cells")
    several = placed.join(cells, "key").join(units.select("id", "vec"), "id").select(
        "key", "id", "component", "vec", "n")
    found = _links_in_cells(several.where(F.col("n") <= cell_rows).drop("n"), threshold)
    if not cells.where(F.col("n") > cell_rows).isEmpty():
        found = found.union(_links_between_blocks(several.where(F.col("n") > cell_rows).drop("n"), threshold, cell_rows))
    return found.distinct()


def _links_between_blocks(rows: DataFrame, threshold: float, cell_rows: int) -> DataFrame:
    """:func:`open_links` of cells of more than ``cell_rows`` rows (key, id, component, vec).

    A component with many rows of a cell gets blocks of its own, the others share blocks, none is divided over two.
    So two blocks need not meet if they are of one and the same component, and a cell that one component fills costs
    its rows times the rows of the others, not their square."""
    rows = cut(rows, "lattice-crowded")
    sizes = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m")).withColumn(
        "owner", F.when(F.col("m") > cell_rows // 4, F.col("component")))
    shared = sizes.where(F.col("owner").isNull()).groupBy("key").agg(F.sum("m").alias("pool"))
    sizes = sizes.join(shared, "key", "left").select(
        "key", "component", "owner", F.ceil(F.when(F.col("owner").isNull(), F.col("pool") * 2).otherwise(
            F.col("m")) / cell_rows).cast("int").alias("parts"))
    spread = F.xxhash64(F.when(F.col("owner").isNull(), F.col("component")).otherwise(F.col("id")))
    placed = cut(rows.join(sizes, ["key", "component"]).withColumn("part", F.pmod(spread, F.col("parts"))).withColumn(
        "block", F.concat_ws(":", F.coalesce(F.col("owner").cast("string"), F.lit("shared")), F.col("part"))).select(
            "key", "block", "owner", "id", "component", "vec"), "lattice-blocks")
    blocks = cut(placed.select("key", "block", "owner").distinct(), "lattice-block-list")
    other = blocks.withColumnsRenamed({"block": "block2", "owner": "owner2"})
    pairs = cut(blocks.join(other, "key").where(
        (F.col("block") <= F.col("block2")) & F.coalesce(F.col("owner") != F.col("owner2"), F.lit(True))).select(
            "key", "block", "block2"), "lattice-block-pairs")
    base = placed.drop("owner")
    left = base.join(pairs, ["key", "block"]).select("key", "block", "block2", "id", "component", "vec")
    right = base.withColumnRenamed("block", "block2").join(pairs.where(F.col("block") < F.col("block2")), [
        "key", "block2"]).select(*[F.col(c).alias(f"right_{c}") for c in left.columns])

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        both = pa.concat_tables([a, b.rename_columns(a.column_names)]) if len(b) else a
        links = _join_up(both["id"].to_numpy(), both["component"].to_numpy(), _matrix(both["vec"].combine_chunks()),
                         threshold, len(a) if len(b) else None) if len(a) else []
        x, y = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64())})

    by = ["key", "block", "block2"]
    return left.groupBy(*by).cogroup(right.groupBy(*[f"right_{c}" for c in by])).applyInArrow(compare, "a long, b long")


def _links_in_cells(several: DataFrame, threshold: float) -> DataFrame:
    """:func:`open_links` of whole cells (key, id, component, vec), one at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def work(part: pa.Table) -> pa.RecordBatch:
            key, ids, component = (part[c].to_numpy() for c in ("key", "id", "component"))
            x = _matrix(part["vec"].combine_chunks())
            begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            links = set()
            for a, b in zip(begin, np.r_[begin[1:], len(key)]):
                links.update(_join_up(ids[a:b], component[a:b], x[a:b], threshold))
            a, b = zip(*links) if links else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            part = pa.Table.from_batches(held)
            key = part["key"].to_numpy()
            last = int(np.flatnonzero(np.r_[True, key[1:] != key[:-1]])[-1])
            if last:                                   # the last cell may go on: hold it
                yield work(part.slice(0, last))
                held[:] = part.slice(last).to_batches()
        if held:
            yield work(pa.Table.from_batches(held))

    return several.repartition("key").sortWithinPartitions("key", "id").mapInArrow(run, "a long, b long")


def _count(x: np.ndarray, weight: np.ndarray, y: np.ndarray, wy: np.ndarray, threshold: float) -> np.ndarray:
    """For each row of x, the weight of the rows of y at or over the threshold."""
    out = np.zeros(len(x), dtype=np.int64)
    for a in range(0, len(x), 512):
        out[a:a + 512] = ((x[a:a + 512] @ y.T) >= threshold) @ wy
    return out


def count_links(members: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(id, near): for rows (component, id, vec, weight), the weight of all rows of the component whose cosine with
    it reaches the threshold, itself included."""
    sizes = cut(members.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "lattice-sizes")
    small = members.join(sizes.where(F.col("size") <= block), "component")
    total = sizes.where(F.col("size") <= block).agg(F.sum("size")).first()[0] or 0
    bins = max(1, -(-total // block))

    def by_component(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("component")
        component = rows["component"].to_numpy()
        x = _matrix(rows["vec"].combine_chunks())
        weight = rows["weight"].to_numpy()
        out = np.zeros(len(component), dtype=np.int64)
        begin = np.flatnonzero(np.r_[True, component[1:] != component[:-1]])
        for a, b in zip(begin, np.r_[begin[1:], len(component)]):
            out[a:b] = _count(x[a:b], weight[a:b], x[a:b], weight[a:b], threshold)
        return pa.table({"id": rows["id"], "near": pa.array(out)})

    counted = small.withColumn("bin", F.pmod(F.xxhash64("component"), F.lit(bins))).groupBy("bin").applyInArrow(
        lambda t: by_component(t.drop_columns(["bin", "size"])), "id long, near long")
    if not sizes.where(F.col("size") > block).isEmpty():
        large = members.join(sizes.where(F.col("size") > block), "component")
        counted = counted.union(_count_large(large, threshold, block))
    return counted


def _count_large(large: DataFrame, threshold: float, block: int) -> DataFrame:
    """:func:`count_links` for components of more than ``block`` rows.

    Rows are put in order of the angle to the component's first vector and cut into blocks; for two blocks whose
    angles add up to at most the threshold's angle all pairs are linked, for two that lie further apart than it none
    are; only the remaining block pairs meet row by row."""
    pivot = large.where(F.col("id") == F.col("component")).select("component", F.col("vec").alias("pivot"))
    limit = math.acos(threshold)
    slack = 1e-6

    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, p = _matrix(batch.column(2)), _matrix(batch.column(5))
            angle = np.arccos(np.clip(np.einsum("ij,ij->i", x, p), -1, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(angle)],
                                             names=["component", "id", "vec", "weight", "size", "angle"])

    placed = cut(large.select("component", "id", "vec", "weight", "size").join(pivot, "component").mapInArrow(
        angles, "component long, id long, vec binary, weight long, size long, angle double"), "lattice-angles")
    # equal slices of the angle are cut into blocks of bounded size by a hash, so no sort over a component is needed
    slice_no = F.floor(F.col("angle") * 256).cast("int")
    per = cut(placed.groupBy("component", slice_no.alias("slice")).agg(
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts")), "lattice-slices")
    placed = cut(placed.withColumn("slice", slice_no).join(per, ["component", "slice"]).withColumn(
        "part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")), "lattice-placed")
    slices = placed.groupBy("component", "slice").agg(
        F.min("angle").alias("low"), F.max("angle").alias("high"), F.sum("weight").alias("weight"))

    def relate(rows: pa.Table) -> pa.Table:
        """Slice pairs of one component (805 slices at most); ``sure`` has no partner slice."""
        no, low, high, weight = (rows[c].to_numpy() for c in ("slice", "low", "high", "weight"))
        linked = high[:, None] + high <= limit - slack
        near = ~linked & (low - high[:, None] <= limit + slack) & (low[:, None] - high <= limit + slack)
        i, j = np.nonzero(near)
        n, k = len(no), len(i)
        return pa.table({
            "component": pa.array(np.full(n + k, rows["component"][0].as_py()), pa.int64()),
            "slice": pa.array(np.r_[no, no[i]], pa.int32()),
            "slice2": pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(no[j], pa.int32())]),
            "sure": pa.array(np.r_[linked @ weight, np.zeros(k, np.int64)], pa.int64())})

    plan = cut(slices.groupBy("component").applyInArrow(
        relate, "component long, slice int, slice2 int, sure long"), "lattice-plan")
    sure = placed.join(plan.where(F.col("slice2").isNull()), ["component", "slice"]).select(
        "id", F.col("sure").alias("near"))

    def dealt(slice_col: str, part_col: str) -> DataFrame:
        return per.select("component", F.col("slice").alias(slice_col),
                          F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias(part_col))

    meet = plan.where(F.col("slice2").isNotNull()).drop("sure").join(dealt("slice", "part"), ["component", "slice"]).join(
        dealt("slice2", "part2"), ["component", "slice2"]).withColumn("pair", F.monotonically_increasing_id())
    meet = cut(meet, "lattice-meet")
    base = placed.select("component", "slice", "part", "id", "vec", "weight")
    left = base.join(meet, ["component", "slice", "part"]).select(F.col("pair").alias("pair1"), "id", "vec", "weight")
    right = base.withColumnsRenamed({"slice": "slice2", "part": "part2"}).join(
        meet.drop("slice", "part"), ["component", "slice2", "part2"]).select(
            F.col("pair").alias("pair2"), F.col("vec").alias("vec2"), F.col("weight").alias("weight2"))

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        near = _count(_matrix(a["vec"].combine_chunks()), a["weight"].to_numpy(), _matrix(b["vec2"].combine_chunks()),
                      b["weight2"].to_numpy(), threshold) if len(a) and len(b) else np.zeros(len(a), np.int64)
        return pa.table({"id": a["id"], "near": pa.array(near, pa.int64())})

    met = left.groupBy("pair1").cogroup(right.groupBy("pair2")).applyInArrow(compare, "id long, near long")
    return sure.union(met).groupBy("id").agg(F.sum("near").alias("near"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, seed: int = SEED, block: int = BLOCK,
                    cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept."""
    named = cut(unit_vectors(vectors, id_col, vector_col), "lattice-units")
    copies = cut(named.groupBy("copy").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight")), "lattice-copies")
    units = cut(named.join(copies, "copy").where(F.col("id") == F.col("rep")).select("id", "vec", "weight"),
                "lattice-reps")
    pairs, rest = candidate_pairs(units, seed, cell_rows)
    links = cut(verified(pairs, units, threshold), "lattice-links")
    components = cut(connected_components(links), "lattice-components")
    more = cut(open_links(rest, components, units, threshold, cell_rows), "lattice-open-links")
    if not more.isEmpty():
        stars = components.select(F.col("node").alias("a"), F.col("component").alias("b"))
        components = cut(connected_components(stars.union(more)), "lattice-components")
    members = components.join(units, components["node"] == units["id"]).select("component", "id", "vec", "weight")
    near = count_links(cut(members, "lattice-members"), threshold, block)
    found = cut(components.join(near, components["node"] == near["id"]).select(
        F.col("node").alias("rep"), "component", "near"), "lattice-found")
    by_id = named.select(F.col("id").alias("one"), "copy").join(copies, "copy").join(found, "rep", "left").select(
        "one", (F.coalesce("near", "weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    own = vectors.select(F.col(id_col).cast("long").alias("id"))
    component = F.coalesce("component", "id")
    return own.join(by_id, own["id"] == by_id["one"], "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
