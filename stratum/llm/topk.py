"""Exact top-k search in Hamming space by incremental multi-index hashing.

Codes of 64 bits are cut into m segments, and each segment i has a search radius r_i. Two codes that differ in more than
r_i bits in every segment differ in at least sum(r_i + 1) bits; so once all values within r_i bits of a query's own
have been looked up in every segment i, each code within sum(r_i + 1) - 1 bits has been seen and verified. The index
maps (segment, value) to codes. Radii grow from nothing one segment after the other, and each query only grows as many
segments as its own k-th verified distance asks for; then it is finished, and provably so. The number of segments is
the one for which probes and verifications are expected to cost least for codes without structure, at the distance
where the k-th of that many codes lies: a probe is dealt, sorted and merged, a verification counts bits inside the join.

Equal codes are indexed once, with their k + 1 smallest ids (no more of them can be among the k nearest, as ties go to
the smaller id), so one code that many rows share is one index entry and, on the query side, one query.

Neighbours are ordered by (distance, id) and never include the query row itself. Null codes neither search nor are
found; a query with fewer than k other codes gets all of them; rows with a repeated id count once (their codes
ordered by value, the smallest is used); an empty table gives an empty result. Only the named columns are read.
"""
from __future__ import annotations

import itertools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import cut

K = 10
BITS = 64
PROBE_COST = 40       # what a probe costs, in verifications


def sign_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, code): bit i is set where component i (of the first 64) is above zero. Null vectors, and null or NaN
    components, give a null code."""
    v = F.col(vector_col)
    part = F.slice(v, 1, BITS)
    bad = v.isNull() | F.exists(part, lambda x: x.isNull() | F.isnan(x))
    bits = F.array_join(F.transform(part, lambda x: F.when(x > 0, "1").otherwise("0")), "")
    # two halves, as conv of 64 digits would not fit a signed long
    high = F.conv(F.substring(F.rpad(bits, BITS, "0"), 1, 32), 2, 10).cast("bigint")
    low = F.conv(F.substring(F.rpad(bits, BITS, "0"), 33, 32), 2, 10).cast("bigint")
    return vectors.select(F.col(id_col).cast("bigint").alias("id"),
                          F.when(bad, None).otherwise(F.shiftleft(high, 32).bitwiseOR(low)).alias("code"))


def _cut(m: int) -> list[tuple[int, int]]:
    """(shift, width) of m segments of nearly equal width."""
    edges = [round(i * BITS / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _segments(n: int, k: int) -> list[tuple[int, int]]:
    """The segments of least expected cost for n codes: the k-th of them is expected at distance d, and radii that add
    up to d + 1 (with one for each segment) are dealt evenly."""
    seen, d = 1.0, 0
    while d < BITS and n * seen / 2 ** BITS < k + 1:
        d += 1
        seen += math.comb(BITS, d)

    def cost(m: int) -> float:
        out = 0.0
        for i, (_, width) in enumerate(_cut(m)):
            radius = (d + 1) // m + (i < (d + 1) % m) - 1
            ball = sum(math.comb(width, r) for r in range(radius + 1))
            out += ball * (PROBE_COST + n / 2 ** width)
        return out

    return _cut(min(range(3, 17), key=cost))


def _masks(width: int, r: int) -> list[int]:
    return [sum(1 << b for b in c) for c in itertools.combinations(range(width), r)]


def _probe_keys(code: Column, segments: list[tuple[int, int]], r: int, most: Column | None = None) -> Column:
    """Array of (segment, value) at exactly r bits from the code's own values, packed as segment * 2^32 + value; of the
    first ``most`` segments only, if given."""
    def flip(own: Column, segment: int) -> Callable[[Column], Column]:
        return lambda mask: own.bitwiseXOR(mask) + F.lit(segment << 32)

    parts = []
    for segment, (shift, width) in enumerate(segments):
        own = F.shiftrightunsigned(code, shift).bitwiseAND(F.lit((1 << width) - 1))
        masks = F.from_json(F.lit(str(_masks(width, r))), "array<bigint>")
        parts.append(F.transform(masks, flip(own, segment)))
    if most is None:
        return F.concat(*parts)
    return F.concat(*[F.when(most > s, part).otherwise(F.array().cast("array<bigint>")) for s, part in enumerate(parts)])


def search(codes: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, id, distance): the k nearest codes of every query id. ``codes`` and ``queries`` hold (id,
    code); a query's own id is left out of its neighbours."""
    spark = codes.sparkSession
    clean = [df.where(F.col("id").isNotNull() & F.col("code").isNotNull()).groupBy("id").agg(F.min("code").alias("code"))
             for df in (codes, queries)]
    first = F.row_number().over(W.partitionBy("code").orderBy("id"))
    index = cut(clean[0].withColumn("r", first).where(F.col("r") <= k + 1).groupBy("code")
                .agg(F.sort_array(F.collect_list("id")).alias("ids")), "topk-index")     # at most k + 1 ids per code
    asked = cut(clean[1], "topk-queries")
    n = index.count()
    if not n or asked.isEmpty():
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, distance int")
    segments = _segments(n, k)
    m = len(segments)
    entries = index.select("code", F.size("ids").alias("n_ids"),
                           F.explode(_probe_keys(F.col("code"), segments, 0)).alias("key"))
    entries = cut(entries, "topk-entries")

    todo = asked.select(F.col("code").alias("q")).distinct().withColumn("bound", F.lit(BITS))
    done: list[DataFrame] = []
    found = None            # (q, code, distance, n_ids) kept so far of the unfinished queries
    widest = max(w for _, w in segments)
    for r in range(widest + 1):
        # so far every segment has radius r - 1, and m * r - 1 bits are covered: each further segment adds one
        needed = F.least(F.lit(m), F.col("bound") - F.lit(m * r - 1))
        covered = F.lit(m * r - 1) + F.col("needed")
        asks = todo.select("q", "bound", needed.alias("needed"))
        # probes multiply with the radius: their queries are dealt to as many tasks first as there are cores for
        if r:
            asks = asks.repartition(spark.sparkContext.defaultParallelism)
        probes = asks.select("q", "bound", F.explode(_probe_keys(F.col("q"), segments, r, F.col("needed"))).alias("key"))
        distance = F.bit_count(F.col("q").bitwiseXOR(F.col("code"))).cast("int")
        # the probes of a small written table look small enough to broadcast, and multiply with every round: deal both
        hits = probes.join(entries.hint("merge"), (probes["key"] == entries["key"]) & (distance <= F.col("bound"))).select(
            "q", "code", distance.alias("distance"), "n_ids").distinct()
        found = hits if found is None else found.unionByName(hits).distinct()
        # the codes that hold the k + 1 nearest rows (one of them may be the query itself): k + 1 codes at most
        w = W.partitionBy("q").orderBy("distance", "code")
        near = found.withColumn("r", F.dense_rank().over(W.partitionBy("q").orderBy("distance")))
        near = near.where(F.col("r") <= k + 1).drop("r")       # k + 1 distances hold k + 1 rows at least
        ahead = F.sum("n_ids").over(w.rangeBetween(W.unboundedPreceding, W.currentRow)) - F.col("n_ids")
        per = F.coalesce(F.min(F.when(F.col("ahead") + F.col("n_ids") >= k + 1, F.col("distance"))).over(
            W.partitionBy("q")), F.lit(BITS))
        near = near.withColumn("ahead", ahead).withColumn("bound", per).where(F.col("distance") <= F.col("bound"))
        near = cut(near.drop("ahead"), f"topk-round{r}")
        last = r == widest or m * (r + 1) - 1 >= BITS
        # a bound can only have shrunk: if it is covered by what its query has probed, the query is finished
        near = near.join(todo.select("q", needed.alias("needed")), "q") if not last else near
        over = F.col("bound") <= covered
        done.append((near if last else near.where(over)).select("q", "code", "distance"))
        if last:
            break
        left = todo.select("q").join(near.where(over).select("q").distinct(), "q", "left_anti")
        bounds = near.where(~over).groupBy("q").agg(F.min("bound").alias("bound"))
        todo = cut(left.join(bounds, "q", "left").select("q", F.coalesce("bound", F.lit(BITS)).alias("bound")),
                   f"topk-todo{r}")
        found = near.where(~over).drop("bound", "needed")
        if todo.isEmpty():
            break
    pairs = done[0]
    for more in done[1:]:
        pairs = pairs.unionByName(more)
    # back to rows: of every near code the smallest ids, then the k nearest rows of each query
    rows = (asked.withColumnsRenamed({"id": "query_id", "code": "q"}).join(pairs.select("q", "code", "distance"), "q")
            .join(index, "code").select("query_id", "distance", F.explode("ids").alias("id"))
            .where(F.col("id") != F.col("query_id")))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("distance", "id"))
    return (rows.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "distance"))


#: All rows against the query set in DuckDB, by brute force.
ORACLE_SQL = f"""
WITH c AS (SELECT vec_id, list_transform(embedding[1:{BITS}], lambda x: x > 0) AS bits FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding[1:{BITS}], lambda x: x IS NULL OR isnan(x))) = 0),
code AS (SELECT vec_id, bitstring(array_to_string(list_transform(bits, lambda b: CASE WHEN b THEN '1' ELSE '0' END), ''),
         {BITS}) AS code FROM c),
pairs AS (SELECT q.vec_id AS query_id, d.vec_id AS id, bit_count(xor(q.code, d.code))::INTEGER AS distance
          FROM code q JOIN code d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, id, distance FROM ranked WHERE rank <= {K}
"""
