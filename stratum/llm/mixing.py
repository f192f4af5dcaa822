"""Mixing sources to target weights by temperature (DataFrame functions only).

Source shares p are raised to an exponent a and normalised: w = p^a / sum(p^a). At a = 1 the mix is the corpus, at
a = 0 every source weighs the same. The exponent is bisected to give the mix the entropy
``(1 - lift) * H(p) + lift * log(number of sources)``; if some source would then be repeated more than
``max_repeats`` times within the token budget, the exponent is bisected again to meet that limit. Five bisection
steps are evaluated in one job over the (aggregated) source table, so the driver only sees 31 candidate values.

A source's budget w * B is realised as whole passes over its documents plus a last partial pass in a fixed random
order: its documents are dealt into blocks by a hash, blocks follow in hash order, documents inside a block too, and
the partial pass takes documents until the budget is reached. Block totals are added up first, then documents inside
a block, so a source with a third of all rows is spread over many tasks.

Token counts are words (runs of other than space and controls 9 to 13). Null sources form one source of their own;
null or empty texts have no tokens: they follow their source's whole passes and are in a partial pass if its budget is
not used up before them. Rows repeat as they are, but rows of equal id and text share their place in the order. An
empty table gives an empty result. Only the named columns are read.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import cut, text_or_empty

LIFT = 0.5
MAX_REPEATS = 4.0
STEPS = 25
BLOCK_TOKENS = 2_000_000
SEED = 17


def words(text: Column) -> Column:
    """Number of words: the pieces between separators, without the empty ones at either end."""
    pieces = F.split(text, r"[\x20\x09-\x0D]+", -1)
    return (F.size(pieces) - F.when(F.element_at(pieces, 1) == "", 1).otherwise(0)
            - F.when((F.size(pieces) > 1) & (F.element_at(pieces, -1) == ""), 1).otherwise(0)).cast("bigint")


def _bisect(sources: DataFrame, measure: Column, target: float, steps: int) -> float:
    """The largest exponent in [0, 1], to ``steps`` halvings, whose ``measure`` is at least ``target``; measures fall
    as the exponent grows. ``measure`` is an aggregate over rows with ``p``, ``pa`` (p^a) and ``z`` (sum of p^a)."""
    low, high = 0.0, 1.0
    while steps > 0:
        depth = min(5, steps)
        cells = 2 ** depth
        grid = F.explode(F.array(*[F.lit(low + (high - low) * k / cells) for k in range(1, cells)])).alias("a")
        tried = sources.select("p", "repeat", grid).withColumn("pa", F.when(F.col("p") > 0, F.pow("p", "a")).otherwise(0.0))
        totals = tried.groupBy("a").agg(F.sum("pa").alias("z"))
        rows = tried.join(F.broadcast(totals), "a").groupBy("a").agg(measure.alias("m")).collect()  # 31 rows
        value = {r["a"]: r["m"] for r in rows}
        lo, hi = 0, cells
        for _ in range(depth):                     # the same five steps a plain bisection would take
            mid = (lo + hi) // 2
            if (value.get(low + (high - low) * mid / cells) or 0.0) >= target:
                lo = mid
            else:
                hi = mid
        low, high = low + (high - low) * lo / cells, low + (high - low) * hi / cells
        steps -= depth
    return low


def source_weights(counted: DataFrame, source_col: str, budget: float = 1.0, lift: float = LIFT,
                   max_repeats: float = MAX_REPEATS, steps: int = STEPS) -> tuple[DataFrame, float, float]:
    """(table of source, tokens, p, weight, tokens to take), the exponent, the budget in tokens.

    ``counted`` has ``source_col`` and ``n_tokens``; ``budget`` is a multiple of all tokens."""
    by_source = cut(counted.groupBy(source_col).agg(F.sum("n_tokens").alias("tokens")), "mix-sources")
    total, number, raw = by_source.agg(
        F.sum("tokens"), F.sum((F.col("tokens") > 0).cast("int")),
        F.sum(F.when(F.col("tokens") > 0, F.col("tokens") * F.log("tokens")).otherwise(0.0))).first()
    if not total:
        return by_source.withColumns({"p": F.lit(0.0), "weight": F.lit(0.0), "take": F.lit(0).cast("bigint")}), 1.0, 0.0
    natural = math.log(total) - raw / total
    wanted = (1 - lift) * natural + lift * math.log(number)
    take = budget * total
    shares = by_source.withColumn("p", F.col("tokens") / F.lit(float(total)))
    ready = shares.select("p", F.lit(take / float(total)).alias("repeat"))
    weight = F.col("pa") / F.col("z")
    entropy = F.sum(F.when(weight > 0, -weight * F.log(weight)).otherwise(0.0))
    exponent = _bisect(ready, entropy, wanted, steps) if number > 1 else 1.0
    # the largest repetition falls as the exponent grows: raise the exponent until it is within the limit
    repeats = F.max(F.when(F.col("p") > 0, weight * F.col("repeat") / F.col("p")).otherwise(0.0))
    over = _bisect(ready, repeats, max_repeats * (1 + 1e-9), steps)
    if over > 0:
        exponent = min(1.0, max(exponent, over + 0.5 ** steps))
    exponent = round(exponent, 6)
    pa = F.when(F.col("p") > 0, F.pow("p", F.lit(exponent))).otherwise(0.0)
    z = shares.agg(F.sum(pa)).first()[0]
    shares = shares.withColumn("weight", F.round(pa / F.lit(z), 9))
    return shares.withColumn("take", F.floor(F.col("weight") * F.lit(take)).cast("bigint")), exponent, take


def mix(documents: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        keep: list[str] = (), budget: float = 1.0, lift: float = LIFT, max_repeats: float = MAX_REPEATS,
        steps: int = STEPS, block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """One row per input row: id, source, ``n_tokens``, the source's ``weight``, ``block`` and how often the row is
    taken (``copies``, 0 where the budget of its source ends before it), plus the ``keep`` columns as ``k_<name>``."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"),
                         F.md5(F.col("__text"))))
    rows = documents.select(
        *[F.col(c).alias(f"k_{c}") for c in keep], F.col(id_col).alias(id_col),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        text_or_empty(text_col).alias("__text"))
    counted = rows.withColumn("n_tokens", words(F.col("__text"))).withColumn("place", key).drop("__text")
    thin = cut(counted.select(id_col, "source", "n_tokens", "place"), "mix-rows")
    counted = counted if keep else thin
    shares, _, _ = source_weights(thin, "source", budget, lift, max_repeats, steps)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("bigint")
    plan = shares.select(
        "source", "weight", blocks.alias("blocks"),
        F.when(F.col("tokens") > 0, F.floor(F.col("take") / F.col("tokens"))).otherwise(1).cast("bigint").alias("passes"),
        F.when(F.col("tokens") > 0, F.pmod(F.col("take"), F.col("tokens"))).otherwise(0).cast("bigint").alias("left"))
    plan = cut(plan, "mix-plan")
    at = F.conv(F.substring("place", 1, 8), 16, 10).cast("bigint")

    def deal(df: DataFrame) -> DataFrame:
        return df.join(plan, "source").withColumn(
            "block", F.floor(at * F.col("blocks") / F.lit(2 ** 32)).cast("bigint"))

    totals = deal(thin).groupBy("source", "block").agg(F.sum("n_tokens").alias("in_block"))
    before = totals.select("source", "block", (F.sum("in_block").over(
        W.partitionBy("source").orderBy("block")) - F.col("in_block")).alias("before"))
    before = cut(before, "mix-blocks")
    inside = F.sum("n_tokens").over(W.partitionBy("source", "block").orderBy("place")
                                    .rangeBetween(W.unboundedPreceding, W.currentRow))
    ends = deal(counted).withColumn("inside", inside).join(before, ["source", "block"]).withColumn(
        "extra", (F.col("before") + F.col("inside") <= F.col("left")).cast("bigint"))
    return ends.select(*[f"k_{c}" for c in keep], id_col, "source", "n_tokens", "weight", "block",
                       (F.col("passes") + F.col("extra")).alias("copies"))


def apply_mix(documents: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
              **options) -> DataFrame:
    """The documents of the mix with their own columns: each row as often as it is taken."""
    columns = documents.columns
    mixed = mix(documents, id_col, source_col, text_col, keep=columns, **options).where("copies > 0")
    return mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select(
        *[F.col(f"k_{c}").alias(c) for c in columns])


def oracle_sql() -> str:
    """The rows of :func:`mix` with its defaults in DuckDB (plain bisection)."""
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
c AS (SELECT doc_id, source, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS n_tokens,
      md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(t)) AS place FROM d),
s AS (SELECT source, sum(n_tokens) AS tokens FROM c GROUP BY source),
g AS (SELECT sum(tokens)::DOUBLE AS total, count(*) FILTER (tokens > 0) AS number FROM s),
p AS (SELECT source, tokens, tokens / total AS p FROM s, g),
h AS (SELECT {1 - LIFT} * -sum(CASE WHEN p > 0 THEN p * ln(p) ELSE 0 END) + {LIFT} * ln(any_value(number)) AS wanted
      FROM p, g),
steps(k, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT k + 1, CASE WHEN ok THEN mid ELSE low END, CASE WHEN ok THEN high ELSE mid END FROM (
    SELECT k, low, high, (low + high) / 2 AS mid,
      (SELECT ln(sum(pow(p, (low + high) / 2))) - sum(pow(p, (low + high) / 2) * ln(p)) * (low + high) / 2
              / sum(pow(p, (low + high) / 2)) FROM p WHERE p > 0) >= (SELECT wanted FROM h) AS ok
    FROM steps WHERE k < {STEPS})),
reps(k, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT k + 1, CASE WHEN ok THEN mid ELSE low END, CASE WHEN ok THEN high ELSE mid END FROM (
    SELECT k, low, high, (low + high) / 2 AS mid,
      (SELECT max(pow(p, (low + high) / 2) / p) / sum(pow(p, (low + high) / 2)) FROM p WHERE p > 0)
        >= {MAX_REPEATS} * (1 + 1e-9) AS ok
    FROM reps WHERE k < {STEPS})),
e AS (SELECT round(CASE WHEN r.low > 0 THEN least(1.0, greatest(x.low, r.low + {0.5 ** STEPS!r})) ELSE x.low END, 6) AS a
      FROM (SELECT CASE WHEN number > 1 THEN low ELSE 1.0 END AS low FROM steps, g WHERE k = {STEPS}) x,
           (SELECT low FROM reps WHERE k = {STEPS}) r),
w AS (SELECT source, tokens, round(CASE WHEN p > 0 THEN pow(p, a) ELSE 0 END
      / (SELECT sum(pow(p, a)) FROM p, e WHERE p > 0), 9) AS weight FROM p, e),
plan AS (SELECT source, weight, greatest(1, ceil(tokens / {BLOCK_TOKENS}.0))::BIGINT AS blocks,
  CASE WHEN tokens > 0 THEN floor(weight * total)::BIGINT // tokens ELSE 1 END AS passes,
  CASE WHEN tokens > 0 THEN floor(weight * total)::BIGINT % tokens ELSE 0 END AS remainder FROM w, g),
o AS (SELECT c.*, weight, passes, remainder,
  floor(('0x' || substr(place, 1, 8))::BIGINT * blocks / 4294967296.0)::BIGINT AS block
  FROM c JOIN plan USING (source)),
b AS (SELECT *, sum(n_tokens) OVER (PARTITION BY source ORDER BY block, place RANGE BETWEEN UNBOUNDED PRECEDING
      AND CURRENT ROW) AS upto FROM (SELECT *, 0 AS one FROM o))
SELECT doc_id, source, n_tokens, weight, block, passes + (upto <= remainder)::BIGINT AS copies FROM b
"""
