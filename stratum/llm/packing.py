"""Best-fit packing into bins of several permitted sequence lengths.

Documents longer than the longest permitted length are cut into full bins of that length and a rest; the rests and
the shorter documents are packed by best fit, longest first. When no open bin has room, a bin is opened whose length
depends on the shortest one that holds the piece: the shard is packed with each opening length for all pieces, then
with other ones for the pieces of one length at a time, and the packing of the least total ``cost`` is kept (so the
fill that the shard's own sizes allow decides, and all permitted lengths are weighed together). At the end of each
packing every bin is downsized to the shortest permitted length that holds its contents.

Best fit needs all open bins at hand, so the pieces are dealt into shards of about ``shard_rows`` by a hash of the
document; a shard is packed in one task, and at most one bin per shard is left badly filled. The number of shards
grows with the number of pieces, so a task never holds more than a bounded number of them whatever the key or source.

Null or negative token counts count as 0, and documents of no tokens get no bin (bin columns null). Rows repeat as
they are, each with pieces of its own; ties are broken by document id and row content, so results do not depend on
the order of rows. Only the named columns are read. An empty table gives an empty result.
"""
from __future__ import annotations

import bisect
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTHS = (512, 1024, 2048, 4096, 8192)
SHARD_ROWS = 20_000
SCHEMA = "doc_id long, piece long, piece_tokens long, first_token long, bin_id string, bin_length long, bin_used long"


def linear_cost(length: int) -> float:
    """Relative cost of a training step on a bin: its tokens, plus attention that grows with the square, plus a
    fixed part per sequence (the default weighs 8192 tokens of attention like 1.5 times their other work)."""
    return 64.0 + length * (1.0 + 1.5 * length / 8192)


def _pack(sizes: list[int], lengths: list[int], opened: tuple[int, ...]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Best fit where a piece whose shortest fitting length is the k-th opens a bin of the ``opened[k]``-th."""
    free: list[tuple[int, int]] = []           # (free room, bin), sorted: the first that fits is the best fit
    where: list[int] = []
    used: list[int] = []
    for size in sizes:
        at = bisect.bisect_left(free, (size, -1))
        if at < len(free):
            room, b = free.pop(at)
        else:
            room = lengths[opened[bisect.bisect_left(lengths, size)]]
            b = len(used)
            used.append(0)
        where.append(b)
        used[b] += size
        if room > size:
            bisect.insort(free, (room - size, b))
    used_arr = np.array(used, dtype=np.int64)
    final = np.array(lengths, dtype=np.int64)[np.searchsorted(lengths, used_arr)] if used else used_arr
    return where, final, used_arr


def pack(sizes: np.ndarray, lengths: tuple[int, ...] = LENGTHS, cost: Callable[[int], float] = linear_cost
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each piece, final length of each bin, tokens in each bin) for pieces sorted from the largest down,
    none longer than the longest permitted length; of the opening rules tried, the one of the least total cost."""
    lengths = sorted(lengths)
    pieces = [int(x) for x in sizes]
    each = np.array([cost(c) for c in lengths])
    kinds = sorted(set(np.searchsorted(lengths, pieces).tolist()))
    tried: dict[tuple[int, ...], tuple] = {}

    def attempt(opened: tuple[int, ...]) -> tuple:
        rule = tuple(opened[k] for k in kinds)               # lengths that no piece asks for do not matter
        if rule not in tried:
            found = _pack(pieces, lengths, opened)
            tried[rule] = (float(each[np.searchsorted(lengths, found[1])].sum()), opened, found)
        return tried[rule]

    best = min((attempt(tuple(max(k, least) for k in range(len(lengths)))) for least in range(len(lengths))),
               key=lambda x: x[0])
    for k in kinds:
        for c in range(k, len(lengths)):
            other = attempt((*best[1][:k], c, *best[1][k + 1:]))
            best = min(best, other, key=lambda x: x[0])
    where, final, used = best[2]
    return np.array(where, dtype=np.int64), final, used


def best_fit(documents: DataFrame, id_col: str = "doc_id", tokens_col: str = "n_tokens",
             lengths: tuple[int, ...] = LENGTHS, shard_rows: int = SHARD_ROWS,
             cost: Callable[[int], float] = linear_cost) -> DataFrame:
    """One row per piece: document, piece number, its tokens and their offset in the document, bin, the bin's final
    length and the tokens it holds. Bin ids name the shard and the bin in it; ``first_token`` is the piece's offset
    in its document."""
    longest = max(lengths)
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"),
                            F.greatest(F.coalesce(F.col(tokens_col).cast("long"), F.lit(0)), F.lit(0)).alias("n"))
    full = F.floor(F.col("n") / longest).cast("long")
    rest = F.col("n") - full * longest
    pieces = docs.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(
        F.when(rest > 0, full).otherwise(full - 1), F.lit(0)))).alias("piece"))
    size = F.least(F.lit(longest).cast("long"), F.col("n") - F.col("piece") * longest)
    pieces = pieces.select("doc_id", "piece", size.alias("piece_tokens"),
                           (F.col("piece") * longest).alias("first_token"))
    whole = pieces.where(F.col("piece_tokens") == longest).withColumn(
        "bin_id", F.concat_ws("-", F.lit("full"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "piece",
                              F.hex(F.monotonically_increasing_id())))
    whole = whole.withColumn("bin_length", F.lit(longest).cast("long")).withColumn("bin_used", F.col("piece_tokens"))
    nothing = pieces.where(F.col("piece_tokens") == 0).withColumn("bin_id", F.lit(None).cast("string"))
    nothing = nothing.withColumn("bin_length", F.lit(None).cast("long")).withColumn("bin_used", F.lit(None).cast("long"))
    rests = pieces.where((F.col("piece_tokens") > 0) & (F.col("piece_tokens") < longest))
    shards = max(1, -(-rests.count() // shard_rows))

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["piece_tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        where, final, used = pack(part["piece_tokens"].to_numpy(), lengths, cost)
        part = part.assign(bin_id=[f"{key[0]}-{b}" for b in where], bin_length=final[where], bin_used=used[where])
        return part[["doc_id", "piece", "piece_tokens", "first_token", "bin_id", "bin_length", "bin_used"]]

    # the hash takes in the size, so that copies of one id with different contents do not all meet in one shard
    shard = F.pmod(F.xxhash64("doc_id", "piece", "piece_tokens"), F.lit(shards)).cast("int")
    packed = rests.withColumn("shard", shard).groupBy("shard").applyInPandas(run, SCHEMA)
    return packed.unionByName(whole).unionByName(nothing).withColumnRenamed("doc_id", id_col)
