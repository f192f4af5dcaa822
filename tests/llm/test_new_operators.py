"""Hard negatives, whitening and fingerprints against plain Python."""
from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stratum.llm import fingerprints, negatives, whitening

from .helpers import documents, words

VECTORS = "vec_id long, embedding array<float>, label int, score double, rank string, x int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], y, 0.5, "r", 1)
                                  for i, v, y in rows], VECTORS)


def odd_rows(dims):
    nan, inf = float("nan"), float("inf")
    return [(900, None, 1), (950, [nan] * dims, 1), (1000, [inf] + [0.0] * (dims - 1), 2), (1050, [None] + [0.1] * (dims - 1), 0),
            (1100, [0.0] * dims, 1), (1150, [0.2] * dims, None), (None, [0.3] * dims, 1)]


# -- hard negatives ------------------------------------------------------------------------------------------------

def test_hilbert_curve_visits_every_cell_once_and_moves_by_one_step():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        key = negatives.hilbert(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_score():
    rng = np.random.default_rng(0)
    a, x = rng.integers(-300, 300, (7, 9)), rng.integers(-300, 300, (40, 9))
    low, high = negatives.bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    score = a @ x.T
    assert (low[:, 0] <= score.min(axis=1)).all() and (high[:, 0] >= score.max(axis=1)).all()


def test_best_of_each_range_and_what_it_asks_of_later_blocks():
    rng = np.random.default_rng(5)
    scores, allowed = rng.integers(-9, 10, (30, 40)), rng.random((30, 40)) < 0.6
    low, high = rng.integers(-12, 8, (30, 4)), rng.integers(-8, 12, (30, 4))
    low[:, 3], high[:, 3] = negatives.NONE, negatives.MOST_LONG
    raised = low.copy()
    for p, (i, j, score) in enumerate(negatives._best(scores, allowed, raised, high, 3)):
        for row in range(30):
            held = sorted((-s, c) for c, s in enumerate(scores[row].tolist())
                          if allowed[row, c] and low[row, p] <= s <= high[row, p])[:3]
            assert [(-s, c) for s, c in zip(score[i == row].tolist(), j[i == row].tolist())] == held
            assert raised[row, p] == (-held[2][0] if len(held) == 3 else low[row, p])


@pytest.mark.parametrize("most", [300, 4000, 1 << 20, 1 << 26])
def test_scores_are_whole_numbers_of_any_size(most):
    rng = np.random.default_rng(6)
    a, x = rng.integers(-most, most + 1, (5, 64)).astype(np.int32), rng.integers(-most, most + 1, (9, 64)).astype(np.int32)
    a[0], x[0] = most, most
    assert (negatives._scores(a, x) == a.astype(object) @ x.T.astype(object)).all()


def brute_negatives(rows, every=50):
    """Rows as lists of (id, whole numbers, label); every row is a row of its own."""
    out = []
    for a, (i, x, y) in enumerate(rows):
        if i % every:
            continue
        scored = [(-sum(p * q for p, q in zip(x, v)), j, w == y) for b, (j, v, w) in enumerate(rows) if b != a]
        for s, p, _ in sorted(t for t in scored if t[2])[:5]:
            near = sorted(t for t in scored if not t[2] and -50 * s <= -100 * t[0] <= -95 * s)[:3]
            out += [(i, p, k + 1, j, -s, -n) for k, (n, j, _) in enumerate(near)]
    return Counter(out)


def clean(rows, dims):
    return [(i, [min(1 << 26, max(-(1 << 26), math.floor(256 * float(np.float32(c))))) for c in v] + [0] * (dims - len(v)), y)
            for i, v, y in rows
            if i is not None and v is not None and y is not None and all(c is not None and math.isfinite(c) for c in v)]


@pytest.mark.parametrize("block_rows", [7, 64, 2048])
def test_hard_negatives_match_brute_force(spark, monkeypatch, block_rows):
    """Ties, repeated ids and vectors, short vectors, a hot vector, null and non-finite entries; blocks of any size."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", 5)
    monkeypatch.setattr(negatives, "ZONE_ROWS", 3)
    rng = np.random.default_rng(block_rows)
    centres = rng.normal(size=(6, 5))
    rows = [(i, list(np.round(centres[i % 6] + 0.3 * rng.normal(size=5), 2)), int(rng.integers(0, 4))) for i in range(300)]
    rows += [(i, [0.5, 0.25, -0.5, 0.1, 0.3], i % 3) for i in range(300, 420)]           # a third of all rows are one vector
    rows += [(50, rows[50][1], rows[50][2]), (100, [0.1] * 5, 1), (100, [1e30] + [0.0] * 4, 2), (550, [0.4, 0.2], 3)]
    rows += odd_rows(5)
    want = brute_negatives(clean(rows, 5))
    got = Counter(tuple(r) for r in negatives.mine(vectors(spark, rows)).collect())
    assert got == want and len(want) > 20


def test_hard_negatives_of_nothing(spark):
    assert negatives.mine(vectors(spark, odd_rows(3)[:4])).count() == 0
    assert negatives.mine(vectors(spark, [(50, [1.0], 1)])).count() == 0
    assert negatives.mine(vectors(spark, [(50, [], 1), (51, [], 1), (52, [], 2)])).collect() == [(50, 51, 1, 52, 0, 0)]
    df = vectors(spark, [])
    assert negatives.mine(df).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert negatives.mine(df).count() == 0


def test_zone_maps_keep_far_blocks_off_the_reading_lists(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(1)
    centres = 2 * np.eye(4)
    rows = [(i, list(centres[i % 4] + 0.02 * rng.normal(size=4)), i % 4) for i in range(2000)]
    table, shape = negatives.blocks(vectors(spark, rows))
    own = negatives.anchors(table, shape, 50)
    asked = own.mapInArrow(negatives._gather(shape.dims), negatives.ASKED)
    pairs = sum(len(r["uid"]) // 8 for r in negatives.reading_lists(asked, table, shape).collect())
    assert 0 < pairs < 0.5 * own.count() * table.count()


def test_no_join_of_hard_negatives_goes_by_the_size_of_files(spark, monkeypatch):
    """Lists of a few blocks repeat the anchors' vectors and make tiny files: Spark would broadcast them, by way of the
    driver. Plans are looked at as they ran."""
    plans = []

    def cut(df, tag, written=negatives.cut):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, tag)

    monkeypatch.setattr(negatives, "BLOCK_ROWS", 50)
    monkeypatch.setattr(negatives, "cut", cut)
    rng = np.random.default_rng(3)
    rows = [(i, list(np.round(rng.normal(size=6), 2)), i % 3) for i in range(500)]
    got = Counter(tuple(r) for r in negatives.mine(vectors(spark, rows)).collect())
    assert got == brute_negatives(clean(rows, 6)) and got
    assert len(plans) > 5 and not [p for p in plans if "Broadcast" in p or "isFinalPlan=false" in p]


@pytest.mark.parametrize("zone_rows", [2, 32])
def test_tiles_of_several_blocks_hold_each_anchor_once(spark, monkeypatch, zone_rows):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 10)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", 3)
    monkeypatch.setattr(negatives, "ZONE_ROWS", zone_rows)
    monkeypatch.setattr(negatives, "CORE_TILES", 0)
    monkeypatch.setattr(negatives, "TILE_ASKED", 2)      # and several tasks for the anchors of a tile
    rng = np.random.default_rng(4)
    rows = [(i, list(rng.integers(-3, 4, 4) / 16), int(rng.integers(0, 3))) for i in range(900)]     # many ties
    rows += [(i, rows[100][1], i % 3) for i in range(900, 1000)]
    want = brute_negatives(clean(rows, 4))
    assert Counter(tuple(r) for r in negatives.mine(vectors(spark, rows)).collect()) == want and len(want) > 100
    table, shape = negatives.blocks(vectors(spark, rows))
    tiles = table.select(negatives._tile(shape)).distinct().count()
    asked = negatives.anchors(table, shape, 50).mapInArrow(negatives._gather(shape.dims), negatives.ASKED)
    lists = negatives.reading_lists(asked, table, shape).collect()
    pairs = sum(len(r["uid"]) // 8 for r in lists)
    assert tiles < 0.7 * table.count() and len(lists) <= 1.5 * tiles * asked.count()
    assert sum(len(r["label"]) // 8 for r in lists) <= 1.5 * 20 * tiles < pairs


# -- whitening -----------------------------------------------------------------------------------------------------

def test_bit_planes_give_exact_products_of_numbers_of_any_size():
    rng = np.random.default_rng(2)
    for top in (1, 100, 1 << 40, (1 << 62) - 1):
        y = rng.integers(-top, top + 1, (100, 5))
        y[:, 3] = y[0, 3]
        total, cross = whitening.scatter(y)
        big = y.astype(object)
        assert (total == big.sum(axis=0)).all() and (cross == big.T @ big).all()


def whitened(rows, dims):
    y = np.array([[math.floor(64 * float(np.float32(c))) for c in v] + [0] * (dims - len(v)) for _, v, _ in rows], dtype=object) + 10 ** 6
    n, total = len(y), y.sum(axis=0)
    deviation = [int(d) for d in ((n * y - total) ** 2).sum(axis=1)]
    centred = (n * y - total).astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    return n, deviation, centred @ axes[:, order], values[order], values.sum()


def test_whitening_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, list(rng.normal(size=40) * np.linspace(0.2, 3, 40)), 1) for i in range(300)]
    rows += [(i, [1.0, 2.0], 1) for i in range(300, 340)] + [(7, list(rng.normal(size=40)), 1)] + odd_rows(40)
    kept = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    n, deviation, projected, values, trace = whitened(kept, 40)
    out = whitening.whiten(vectors(spark, rows).repartition(3)).collect()
    assert len(out) == 32 * len(kept) and {r["n"] for r in out} == {n}
    assert Counter((r["vec_id"], r["deviation"]) for r in out) == Counter(
        {k: 32 * v for k, v in Counter(zip([r[0] for r in kept], deviation)).items()})
    for r in out:
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / trace, rel=1e-9)
    by = {(r["vec_id"], r["component"]): r["whitened"] for r in out if r["vec_id"] not in (7, None)}
    for c in range(1, 33):
        got = np.array([by[i, c] for i, _, _ in kept if i not in (7, None)])
        want = np.array([projected[k, c - 1] for k, row in enumerate(kept) if row[0] not in (7, None)]) / math.sqrt(values[c - 1])
        assert np.allclose(got, want, atol=1e-8) or np.allclose(got, -want, atol=1e-8)
    assert {r["identity_error"] for r in out}.pop() < 1e-9


def test_whitening_does_not_depend_on_the_partitions(spark):
    rng = np.random.default_rng(5)
    df = vectors(spark, [(i, list(rng.normal(size=6)), 1) for i in range(200)])
    one, many = (sorted(tuple(r)[:6] for r in whitening.whiten(df.repartition(k)).collect()) for k in (1, 9))
    assert one == many


def test_whitening_of_special_tables(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, odd_rows(3)[:4])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [], 1)])).count() == 0
    one = whitening.whiten(vectors(spark, [(1, [0.5, 0.25], 1)])).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [
        (1, 0, None, None, 0.0), (2, 0, None, None, 0.0)]
    flat = whitening.whiten(vectors(spark, [(1, [0.0, 1.0], 1), (2, [2.0, 1.0], 1), (None, [1.0, 1.0], 1)])).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in flat) and len(flat) == 6
    huge = whitening.whiten(vectors(spark, [(1, [3e38], 1), (2, [-3e38], 1)])).collect()
    assert [r["deviation"] for r in huge] == [None, None] and sorted(r["whitened"] for r in huge) == pytest.approx([-1, 1])


# -- fingerprints --------------------------------------------------------------------------------------------------

def edited_texts(docs):
    """Distinct documents in order with their edited texts: {(id, text): edited}."""
    def h(*parts):
        seed = 42
        for p in parts:
            if p is not None:
                raw = p.encode() if isinstance(p, str) else p.to_bytes(8, "little", signed=True)
                seed = xxhash.xxh64(raw, seed=seed).intdigest()
        return seed - (1 << 64) if seed >> 63 else seed
    order = sorted({(i, t or "") for i, t, _ in docs}, key=lambda d: (d[0] is not None, d[0] or 0, h(d[0], d[1])))
    out = {}
    for k, (i, t) in enumerate(order):
        follow = order[(k + 1) % len(order)]
        m = len(t) // 4
        out[i, t] = (t[:len(t) - m] + follow[1][:m], follow[1])
    return out


def sample(text):
    """Consistent weighted samples in plain Python: (word, t) of each slot."""
    count = Counter(words(text)) or ({text: 1} if text else {})
    out = []
    for slot in range(fingerprints.SLOTS):
        best = (math.inf, None)
        for word, weight in count.items():
            seed = xxhash.xxh64(word.encode(), seed=42).intdigest()
            h = xxhash.xxh64(slot.to_bytes(4, "little"), seed=xxhash.xxh64(seed.to_bytes(8, "little"), seed=42).intdigest()).intdigest()
            i = xxhash.xxh64(h.to_bytes(8, "little"), seed=42).intdigest()
            gamma = lambda x: -math.log(((x % 2 ** 26) + 0.5) / 2 ** 26 * (((x >> 26) % 2 ** 26) + 0.5) / 2 ** 26)
            r, c, b = gamma(h), math.log(gamma(i)), ((h >> 52) * 4096 + (i >> 52)) / 2 ** 24
            t = math.floor(math.log(weight) / r + b)
            best = min(best, (c - r * (t - b) - r, (word, t)), key=lambda e: e[0])
        out.append(best[1])
    return out if count else []


def near(a, b):
    return 1.0 if not a and not b else 0.0 if not a or not b else sum(x == y for x, y in zip(a, b)) / len(a)


def test_fingerprints_match_plain_python(spark):
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(40)] + ["Straße", "日本語", "é"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 20, 200]))) for _ in range(40)]
    docs = [(i * 3 % 41, t, "s") for i, t in enumerate(texts)]
    docs += [(100, None, "s"), (101, "", "s"), (102, " \t", "s"), (103, texts[0], "s"), (104, texts[0].upper(), "s"), (None, "n one", "s"),
             (105, "x" * 9000, "s"), (3, texts[5], "s"), docs[2], docs[2], (106, "three  words\nhere", "s")]
    want = edited_texts(docs)
    rows = fingerprints.digest(documents(spark, docs).repartition(5)).collect()
    assert Counter((r["doc_id"], r["n_chars"]) for r in rows) == Counter((i, len(t or "")) for i, t, _ in docs)
    seen: dict = {}
    for r in rows:
        text, (edited, follow) = next((t, e) for (i, t), e in want.items() if i == r["doc_id"] and len(t) == r["n_chars"]
                                      and hashlib.sha256(e[0].encode()).hexdigest() == r["edited_sha256"])
        own = sample(text)
        assert r["near_edited"] == near(own, sample(edited)) and r["near_next"] == near(own, sample(follow))
        assert len(r["fingerprint"]) == 8 * len(own) and seen.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert seen.setdefault(edited, r["edited_fingerprint"]) == r["edited_fingerprint"]
    assert fingerprints.digest(documents(spark, docs).limit(0)).count() == 0
    alone = fingerprints.digest(documents(spark, [(1, "a b c d", "s")])).collect()[0]
    assert alone["edited_sha256"] == hashlib.sha256(b"a b c a").hexdigest() and alone["near_next"] == 1.0


def test_collision_rate_is_the_generalised_jaccard_similarity(spark):
    """Weights need not be whole numbers; 2,048 slots put the estimate within four standard errors."""
    a, b = {1: 0.5, 2: 3.25, 3: 1.0, 4: 7.5}, {1: 1.5, 2: 2.0, 4: 7.5, 5: 0.01}
    rows = [("g", t, a.get(t), b.get(t)) for t in range(1, 6)]
    df = spark.createDataFrame(rows, "g string, term long, a double, b double")
    r = fingerprints.samples(df, ["g"], ["a", "b"], slots=2048).first()
    truth = sum(min(a.get(t, 0), b.get(t, 0)) for t in range(1, 6)) / sum(max(a.get(t, 0), b.get(t, 0)) for t in range(1, 6))
    got = np.mean(np.array(r["a"]) == np.array(r["b"]))
    assert len(r["a"]) == 2048 and abs(got - truth) < 4 * math.sqrt(truth * (1 - truth) / 2048)


def test_terms_that_cannot_be_a_sample_are_left_out_early(spark):
    """Two texts of 2,000 and 1,000 terms: the rows that reach the logarithms, and the same samples."""
    df = spark.range(1, 2001).select(F.lit("g").alias("g"), F.col("id").alias("term"), (F.col("id") % 3 + 0.5).alias("a"),
                                     F.when(F.col("id") % 2 == 0, F.lit(2.0)).alias("b"))
    df = df.crossJoin(df.agg(F.sum("a").alias("of_a"), F.sum("b").alias("of_b"))).cache()
    rows = [fingerprints.draws(df, ["g"], ["a", "b"], "term", 64, t).count() for t in (None, ["of_a", "of_b"])]
    assert rows[0] == 2000 * 64 // fingerprints.AT_ONCE and rows[1] < rows[0] / 3
    assert fingerprints.samples(df, ["g"], ["a", "b"], totals=["of_a", "of_b"]).collect() == fingerprints.samples(df, ["g"], ["a", "b"]).collect()


@pytest.mark.parametrize("enough", [1e-9, 0.5, 4.0])
def test_samples_that_are_not_found_early_are_drawn_anew(spark, monkeypatch, enough):
    rng = random.Random(8)
    docs = [(i, " ".join(f"W{rng.randrange(60)}" for _ in range(rng.choice([0, 1, 5, 300]))), "s") for i in range(30)]
    docs += [(50, None, "s"), (51, "", "s"), (52, " \t ", "s"), docs[3], (None, "ÄA ä ÉÈ", "s")]
    want = sorted(map(str, fingerprints.digest(documents(spark, docs)).collect()))
    monkeypatch.setattr(fingerprints, "ENOUGH", enough)
    first = fingerprints.fingerprints(documents(spark, docs).where("text != ''"), ["doc_id"], ["text"], every=False).collect()
    found = [sum(x is not None for x in r["text"]) / 64 for r in first]
    assert len(first) < 30 or np.mean(found) < 1 and (enough < 4 or np.mean(found) > 0.9)
    assert sorted(map(str, fingerprints.digest(documents(spark, docs)).collect())) == want


def test_words_are_lower_cased_one_by_one_as_whole_texts_were(spark):
    """Letters other than A-Z stay, also those whose lower case is a letter of ASCII (the Kelvin sign)."""
    texts = ["Ab CÄ\tÉx É", "K\u212a \u0130I", "x Y", "", " \n", "Z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.explode(fingerprints.words(F.col("t"))).alias("w"))
    got = Counter((r["t"], r["l"]) for r in df.select("t", fingerprints.lowered(F.col("w")).alias("l")).collect())
    assert got == Counter((t, w) for t in texts for w in words(t))


def test_fingerprints_use_no_python_workers(spark):
    df = fingerprints.digest(documents(spark, [(1, "a b", "s"), (2, "c d e f g h", "s")]))
    assert "Python" not in df._jdf.queryExecution().toString() and df.select(F.max("near_edited")).first()[0] <= 1
