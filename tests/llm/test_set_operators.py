"""Packing, search, near-duplicate joins, mixing and components against plain Python."""
from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import lattice, mixing, ngram_join, packing, topk
from stratum.llm.components import connected_components

from .helpers import components, documents, words


def test_packing_places_every_token_once_and_downsizes(spark):
    rng = random.Random(0)
    sizes = [(i, rng.choice([0, 1, 5, 100, 511, 512, 513, 3000, 8192, 20_000])) for i in range(500)]
    sizes += [(7, 100), (None, 64), (901, None), (902, -5)]
    df = spark.createDataFrame([(i, n, "x") for i, n in sizes], "doc_id long, n_tokens long, bin_id string")
    rows = packing.best_fit(df, shard_rows=100).collect()
    got = Counter()
    for r in rows:
        got[r["doc_id"]] += r["piece_tokens"]
    want = Counter()
    for i, n in sizes:
        want[i] += max(0, n or 0)
    assert +got == +want and {r["doc_id"] for r in rows} == {i for i, _ in sizes}
    bins: dict = {}
    for r in rows:
        if r["piece_tokens"]:
            bins.setdefault(r["bin_id"], []).append(r)
    for held in bins.values():
        used = sum(r["piece_tokens"] for r in held)
        assert {r["bin_used"] for r in held} == {used}
        assert {r["bin_length"] for r in held} == {min(c for c in packing.LENGTHS if c >= used)}
    assert packing.best_fit(df.limit(0)).count() == 0


def test_packing_is_best_fit_and_opens_the_cheapest_bin():
    where, final, used = packing.pack(np.array([6, 5, 4, 3, 2]), (8, 16), cost=lambda c: {8: 10, 16: 100}[c])
    assert where.tolist() == [0, 1, 2, 1, 0] and final.tolist() == [8, 8, 8] and used.tolist() == [8, 8, 4]
    where, final, _ = packing.pack(np.array([6, 5, 4]), (8, 16), cost=lambda c: {8: 10, 16: 11}[c])
    assert where.tolist() == [0, 0, 0] and final.tolist() == [16]


def test_packing_weighs_the_production_lengths_by_their_fill():
    where, final, used = packing.pack(np.full(4999, 300))
    # three to a bin of 1,024, not one to a bin of 512; the last one holds a single piece and is downsized
    assert np.bincount(where).tolist() == [3] * 1666 + [1] and final.tolist() == [1024] * 1666 + [512]
    assert sum(map(packing.linear_cost, final.tolist())) < 0.7 * 4999 * packing.linear_cost(512)
    sizes = np.array([5000] * 20 + [300] * 3000)        # here lengths differ by piece
    _, final, used = packing.pack(sizes)
    assert used.sum() == sizes.sum() and (used <= final).all() and len(set(final.tolist())) > 1


def test_topk_search_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    codes = [int(x) for x in rng.integers(-2 ** 63, 2 ** 63 - 1, 300, dtype=np.int64)]
    codes += [codes[0] ^ (1 << k) for k in range(30)] + [codes[5]] * 40 + [0, -1]
    rows = [(i, c) for i, c in enumerate(codes)] + [(9000, None), (None, 5)]
    df = spark.createDataFrame(rows, "id long, code long")
    got: dict = {}
    for r in topk.search(df, df.where("id % 7 = 0"), k=5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["distance"], r["id"]))
    mask = (1 << 64) - 1
    for q in range(0, len(codes), 7):
        near = sorted((((c ^ codes[q]) & mask).bit_count(), i) for i, c in enumerate(codes) if i != q)[:5]
        assert sorted(got[q]) == [(k + 1, d, i) for k, (d, i) in enumerate(near)]
    assert 9000 not in got and topk.search(df.limit(0), df.limit(0)).count() == 0
    few = df.where("id < 3")
    assert topk.search(few, few, k=5).count() == 6


def test_sign_codes(spark):
    v = [1.0, -1.0] * 32
    df = spark.createDataFrame([(1, v), (2, None), (3, [float("nan")] * 64), (4, [1.0])], "vec_id long, embedding array<float>")
    got = {r["id"]: r["code"] for r in topk.sign_codes(df).collect()}
    assert got[1] & ((1 << 64) - 1) == int("10" * 32, 2) and got[2] is None and got[3] is None and got[4] == -(1 << 63)


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)], [],
                                   [(random.Random(i).randint(0, 90), random.Random(-i).randint(0, 90)) for i in range(70)]])
def test_components(spark, edges):
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == components({x for e in edges if e[0] != e[1] for x in e}, [e for e in edges if e[0] != e[1]])


def plain_sets(rows):
    out = {}
    for i, t, _ in rows:
        w = words(t)
        out[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def near_copies(seed: int, group: int):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(2000)]
    line = [rng.choice(vocabulary) for _ in range(25)]
    rows = []
    for g in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 200))]
        for _ in range(group if g == 0 else rng.randint(1, 6)):
            w = list(base)
            for _ in range(rng.randint(0, 7)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                w = line + w
            rows.append((len(rows) * 3, " ".join(w), "s"))
    return rows + [(9001, None, "s"), (9002, "", "s"), (9003, "A b", "s"), (9004, "a B", "s"), (9005, rows[5][1].upper(), "s"),
                   (9006, "same " * 5000, "s"), (9007, "same " * 9, "s"), (9008, "SAME\n" * 5, "s")]


@pytest.mark.parametrize("family,depth", [(1024, 4), (8, 2), (4, 0)])
def test_jaccard_join_matches_brute_force(spark, family, depth, monkeypatch):
    monkeypatch.setattr(ngram_join, "REGION", 6)
    rows = near_copies(1, 40)
    sets = plain_sets(rows)
    ids = list(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = components(ids, links)
    got = {r["doc_id"]: r for r in ngram_join.near_duplicates(documents(spark, rows), family=family, depth=depth).collect()}
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == {i: (len(sets[i]), want[i]) for i in ids}
    if depth == 4:
        kept = ngram_join.keep_one(documents(spark, rows))
        assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(set(want.values()))
        assert ngram_join.near_duplicates(documents(spark, rows).limit(0)).count() == 0


def test_jaccard_join_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(3, text, "s"), (3, "other " + text[:50], "s"), (2, text, "s"), (None, text, "s"), (8, "other " + text[:50], "s")]
    got = sorted((r["doc_id"], r["component_id"]) for r in ngram_join.near_duplicates(documents(spark, rows)).collect()
                 if r["doc_id"] is not None)
    assert got == [(2, 2), (3, 2), (3, 2), (8, 2)]


def test_embedding_links_match_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(150, 64))
    x = np.concatenate([base, base[:40] + 0.1 * rng.normal(size=(40, 64)), base[:1] + 0.15 * rng.normal(size=(90, 64)),
                        base[3:4], 5 * base[4:5], np.zeros((1, 64))])
    rows = [(i * 2, [float(c) for c in v]) for i, v in enumerate(x)]
    bad = [(9000, None), (9001, [float("nan")] * 64), (9002, [None] * 64), (None, rows[0][1]), (9004, [float("inf")] * 64), (9005, [])]
    df = spark.createDataFrame(rows + bad + rows[:1], "vec_id long, embedding array<double>")
    u = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    linked = (u @ u.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    want = components([i * 2 for i in range(len(x))], [(2 * a, 2 * b) for a, b in zip(*np.nonzero(linked))])
    for block in (2048, 16):
        got = lattice.near_duplicates(df, block=block).collect()
        assert len(got) == len(rows) + len(bad) + 1
        by = {r["vec_id"]: r for r in got}
        right = sum((by[2 * i]["n_links"], by[2 * i]["component_id"]) == (int(linked[i].sum()), want[2 * i]) for i in range(len(x)))
        assert right >= 0.97 * len(x)
        assert all(by[i]["n_links"] == 0 and by[i]["component_id"] == i and by[i]["kept"] for i in (9000, 9001, 9002, 9004, 9005))
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got if r["vec_id"] is not None)
    assert lattice.near_duplicates(df.limit(0)).count() == 0


def test_embedding_links_of_a_dense_group_match_brute_force(spark):
    rng = np.random.default_rng(11)
    centre = rng.normal(size=64)
    centre /= np.linalg.norm(centre)
    x = centre + rng.normal(size=(2000, 64)) * 0.06       # most links lie near the threshold
    x = np.concatenate([x, rng.normal(size=(300, 64))])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (u @ u.T) >= 0.9
    np.fill_diagonal(linked, False)
    want = components(range(len(x)), [(int(a), int(b)) for a, b in zip(*np.nonzero(linked)) if a < b])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    by = {r["vec_id"]: r for r in lattice.near_duplicates(df).collect()}
    right = sum((by[i]["n_links"], by[i]["component_id"]) == (int(linked[i].sum()), want[i]) for i in range(len(x)))
    assert linked.any() and right >= 0.97 * len(x) and sum(r["n_links"] for r in by.values()) >= 0.96 * linked.sum()


def test_links_of_crowded_cells_are_found_block_against_block(spark):
    """Cells of over 64 vectors are cut into blocks here: nothing that shares a cell may be lost by that."""
    rng = np.random.default_rng(7)
    centre = rng.normal(size=64)
    centre /= np.linalg.norm(centre)
    rows = [centre + rng.normal(size=64) * 0.05 for _ in range(900)]
    for _ in range(150):                                  # pairs of cosine 0.91 beside the crowd, in its cells
        v = centre + rng.normal(size=64) * 0.09
        v /= np.linalg.norm(v)
        w = rng.normal(size=64)
        w -= (w @ v) * v
        rows += [v, 0.91 * v + math.sqrt(1 - 0.91 ** 2) * w / np.linalg.norm(w)]
    x = np.array(rows)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (u @ u.T) >= 0.9
    np.fill_diagonal(linked, False)
    want = components(range(len(x)), [(int(a), int(b)) for a, b in zip(*np.nonzero(linked)) if a < b])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")

    def wrong(cell_rows):
        by = {r["vec_id"]: r for r in lattice.near_duplicates(df, block=200, cell_rows=cell_rows).collect()}
        return {i for i in by if (by[i]["n_links"], by[i]["component_id"]) != (int(linked[i].sum()), want[i])}

    split, whole = wrong(64), wrong(4096)
    assert linked.sum() > 40_000 and split <= whole and len(split) <= 0.03 * len(x)


def test_blocks_of_a_crowded_cell_meet_in_every_pair(spark):
    """One cell of 1,000 rows, one component of 600 of them: each link between components is known afterwards."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1000, 8))
    x[:600] = rng.normal(size=8) + rng.normal(size=(600, 8)) * 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    component = np.where(np.arange(1000) < 600, 0, np.arange(1000))
    linked = (x @ x.T) >= 0.9
    pairs = [(int(a), int(b)) for a, b in zip(*np.nonzero(linked)) if a < b]
    rows = spark.createDataFrame([(1, int(i), int(component[i]), bytearray(x[i].tobytes())) for i in range(1000)],
                                 "key long, id long, component long, vec binary")
    found = [(r["a"], r["b"]) for r in lattice._links_between_blocks(rows, 0.9, 100).collect()]
    own = [(0, i) for i in range(600)]
    assert all(linked[a, b] for a, b in found) and not any(a < 600 and b < 600 for a, b in found)
    assert components(range(1000), own + found) == components(range(1000), own + pairs)


def test_lattice_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(0)
    y = rng.normal(size=(200, 8)) * 2
    p = lattice.decode_e8(y)
    assert len(lattice.ROOTS) == 240 and ((lattice.ROOTS ** 2).sum(axis=1) == 2).all()
    own = ((y - p) ** 2).sum(axis=1)
    assert all((own <= ((y - p - r) ** 2).sum(axis=1) + 1e-9).all() for r in lattice.ROOTS)


def test_mixing_meets_entropy_budget_and_repeats(spark):
    rng = random.Random(0)
    rows = []
    for source, n in (("big", 900), ("mid", 120), ("small", 30), (None, 20)):
        rows += [(len(rows) + k, "w " * rng.randint(1, 40), source) for k in range(n)]
    rows += [(5001, None, "big"), (5002, "", "mid"), (7, rows[7][1], rows[7][2])]
    docs = documents(spark, rows)
    out = mixing.mix(docs, block_tokens=500).collect()
    assert len(out) == len(rows)
    tokens, taken, weight = Counter(), Counter(), {}
    for r in out:
        tokens[r["source"]] += r["n_tokens"]
        taken[r["source"]] += r["n_tokens"] * r["copies"]
        weight[r["source"]] = r["weight"]
    total = sum(tokens.values())
    assert total == sum(len(words(t)) for _, t, _ in rows)
    p = [v / total for v in tokens.values()]
    target = 0.5 * -sum(x * math.log(x) for x in p) + 0.5 * math.log(len(p))
    repeats = max(weight[s] * total / tokens[s] for s in tokens)
    entropy = -sum(x * math.log(x) for x in weight.values())
    assert repeats <= mixing.MAX_REPEATS + 1e-3 and (abs(entropy - target) < 1e-4 or repeats > mixing.MAX_REPEATS - 1e-2)
    for s in tokens:            # each source gets its budget but for less than one document per pass
        assert 0 <= weight[s] * total - taken[s] <= 81
    mixed = mixing.apply_mix(docs)
    assert mixed.columns == docs.columns and mixed.where(F.col("score") != 0.5).isEmpty()
    assert mixing.mix(docs.limit(0)).count() == 0
    loose = {r["source"]: r["weight"] for r in mixing.mix(docs, lift=1.0, max_repeats=1.5).collect()}
    assert max(loose[s] * total / tokens[s] for s in tokens) == pytest.approx(1.5, abs=1e-2)
