"""Token counts, secrets, toxicity, licences and LM scoring against plain Python on small and awkward inputs."""
from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratum.llm import kernel, licenses, lm, ngram_join, secrets, token_counts, toxicity
from stratum.llm.tables import BATCH_BYTES

from .helpers import LOWER, documents, words

AWKWARD = [(1, None, "a"), (2, "", "a"), (3, "  \n\t ", None), (4, "word " * 30_000, "b"), (5, "é—𝄞 Straße\nzwei\n", "b"),
           (5, "é—𝄞 Straße\nzwei\n", "b"), (None, "no id here", "c"), (7, "x" * 50_000, "c")]


def test_kernel_words_and_hashes_match_regular_expressions():
    rng = random.Random(0)
    texts = ["".join(rng.choice(" \t\nabAB1,é—x") for _ in range(rng.randint(0, 30))) for _ in range(500)] + [None, ""]
    for cls, pattern in ((kernel.SPACE_WORDS, r"[^\x20\x09-\x0D]+"),
                         (kernel.ALNUM_WORDS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        seen: dict[str, int] = {}
        for a, _, w in kernel.words(pa.array(texts), cls):
            h = w.hashes()
            for d in range(w.n_docs):
                found = re.findall(pattern, (texts[a + d] or "").translate(LOWER))
                assert len(found) == w.first[d + 1] - w.first[d]
                for x, y in zip(found, h[w.first[d]:w.first[d + 1]]):
                    assert seen.setdefault(x, y) == y
        assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts_add_up_and_follow_the_rule(spark, rule):
    rows = token_counts.section_tokens(documents(spark, AWKWARD), rule=rule).collect()
    encoding, lengths = token_counts.encoder()
    for doc_id, text, _ in AWKWARD:
        mine = [r for r in rows if r["doc_id"] == doc_id]
        copies = sum(x[0] == doc_id for x in AWKWARD)
        ids = encoding.encode_ordinary(text or "")
        assert sum(r["n_tokens"] for r in mine) == copies * len(ids)
        assert {r["doc_tokens"] for r in mine} == {len(ids)}
        assert max(r["last_char"] for r in mine) == len(text or "")
        if copies == 1:
            assert "".join((text or "")[r["first_char"]:r["last_char"]] for r in sorted(mine, key=lambda r: r["section"])) == (text or "")


def test_crossing_tokens_are_allocated_by_each_rule():
    ends, sections = np.array([4, 10]), np.array([5, 7, 10])      # the second token covers 4-10: 1, 2 and 3 bytes
    assert token_counts.attribute(ends, sections, "first")[0].tolist() == [0, 0]
    assert token_counts.attribute(ends, sections, "last")[0].tolist() == [0, 2]
    assert token_counts.attribute(ends, sections, "largest")[0].tolist() == [0, 2]
    assert token_counts.attribute(ends, sections)[1].tolist() == [False, True]


def plain_spans(text: str):
    assign = re.compile(r"((?:(?i:password|passwd|secret|token|api_?key)))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def test_secret_digest_matches_a_plain_scan_and_redaction_masks(spark):
    key = "AKIA" + "Q7W9E2R5T8Y1U4I6"
    value = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2"
    texts = [f"é token = \"{value}\" end", f"a bare {value[:20]}zz9 one", f"{key}{key} x {key}", "token=token:abcdefg token=abc secret: =abcdef",
             "PassWord='hunter22x9qz7' api_key:QWERTYUIOP12 ", None, "", "token=" * 400 + "abcdefgh", f"bare hunter22x9qz7Qk8 {value}"]
    rows = [(i, t, f"o{i % 3}") for i, t in enumerate(texts)] + [(100 + i, "secret=copied0example9value8", f"o{i}") for i in range(6)]
    docs = documents(spark, rows)
    got = {r["doc_id"]: r for r in secrets.digest(docs).collect()}
    for i, t, _ in rows:
        spans = plain_spans(t or "")
        assert [got[i][c] for c in ("n_assign", "n_access", "n_hex")] == [sum(s[1] == k for s in spans) for k in range(3)]
        listed = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
    assert got[100]["n_copied"] == 1                     # six owners carry it: an example
    clean = {r["doc_id"]: r for r in secrets.redact(docs).collect()}
    assert len(clean) == len(rows) and clean[100]["text"] == rows[9][1] and clean[0]["text"] == "é [SECRET]\" end"
    assert clean[0]["n_chars"] == len(clean[0]["text"]) and clean[5]["text"] is None and clean[0]["score"] == 0.5
    assert secrets.digest(docs.limit(0)).count() == 0 and secrets.redact(docs.limit(0)).count() == 0


def test_a_value_known_elsewhere_is_found_bare(spark):
    value = "Zx81Kq07Lm33Pw92Ty65"
    docs = documents(spark, [(1, f"password={value}", "a"), (2, f"see {value} here", "b"), (3, "see Zx81Kq07Lm33Pw92Ty66 here", "b")])
    got = {r["doc_id"]: r["spans"] for r in secrets.digest(docs).collect()}
    assert got == {1: "assign:0:29", 2: "known:4:24", 3: ""}


def test_licences_match_brute_force(spark):
    text = licenses.TEMPLATES["mit-grant"]
    cut_text = " ".join(text.split()[:-3])
    rows = [*AWKWARD, (20, "Released under the MIT License.", "a"), (21, "x " * 40 + cut_text.upper() + " y" * 40, "a"),
            (22, "under the mit\nlicense, under THE mit license", "a"), (23, "mit grant permission", "b"),
            (24, "Apache License, Version 2.0 and CC BY-NC 4.0", "b")]
    got = [r.asDict() for r in licenses.scan(documents(spark, rows)).collect()]
    assert len(got) == len(rows)
    for r, (i, t, _) in zip(sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)),
                            sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        base = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        labels = {x[1] for x in base}
        share = 0.0
        for name, template in licenses.TEMPLATES.items():
            s = set(template.split())
            for k in range(0, len(w), len(s)):
                c = len(s & set(w[k:k + 2 * len(s)]))
                if c >= math.ceil(0.8 * len(s) - 1e-9):
                    labels.add(name)
                    share = max(share, c / len(s))
        assert (r["doc_id"], r["n_words"], r["n_base"]) == (i, len(w), len(base))
        assert r["labels"] == ",".join(sorted(labels)) and r["base_labels"] == ",".join(sorted({x[1] for x in base}))
        assert (r["first_word"], r["last_word"]) == ((min(base)[0], max(base)[0]) if base else (None, None))
        assert r["score"] == pytest.approx(1.0 if base else share)
    assert licenses.scan(documents(spark, rows).limit(0)).count() == 0


def test_maximal_segments_match_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        x = [rng.choice([-2, -1, -1, 1, 2, 3]) for _ in range(rng.randint(1, 25))]

        def brute(lo, hi):
            best = max(((sum(x[a:b]), -(b - a), a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0,))
            if best[0] <= 0:
                return []
            _, _, a, b = best
            return brute(lo, a) + [sum(x[a:b])] + brute(b, hi)
        got = toxicity.maximal_segments(np.array(x, dtype=float))
        assert sorted(s for _, _, s in got) == pytest.approx(sorted(brute(0, len(x))))
        assert all(sum(x[a:b + 1]) == pytest.approx(s) for a, b, s in got)


def test_toxicity_learns_only_from_training_rows_and_separates_held_out_rows(spark):
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(30, 120))]
        if i % 7 == 0:
            for k in range(4):
                text[rng.randrange(len(text))] = "zquork" + rng.choice(["ing", "ed", "s", "ly"])
        rows.append((i, " ".join(text), "s"))
        labels.append((i, int(i % 7 == 0) if zlib.crc32(str(i).encode()) % 3 != 1 else int(i % 7 != 0)))   # held-out labels lie
    docs = documents(spark, [*rows, (1001, None, "s"), (1002, "", "s")])
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.digest(docs, table).collect()}
    assert all(got[i]["predicted"] == int(i % 7 == 0) for i in range(600))
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(600))
    assert got[1001]["predicted"] == got[1002]["predicted"] == 0 and 0 <= got[1001]["score"] <= 1
    kept = toxicity.keep_clean(docs, table)
    assert kept.columns == docs.columns and kept.count() == sum(i % 7 != 0 for i in range(600)) + 2
    assert {r["score"] for r in kept.select("score").collect()} == {0.5}          # the caller's own column
    assert {r["score"] for r in toxicity.digest(docs, table.limit(0)).collect()} == {0.0}
    assert toxicity.digest(docs.limit(0), table).count() == 0


def _largest_batch(df) -> int:
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])
    return max(r["size"] for r in df.mapInArrow(run, "size long").collect())


@pytest.mark.parametrize("operator", [lambda d: toxicity.score(d, toxicity.Model()), ngram_join.near_duplicates])
def test_texts_reach_python_tasks_in_bounded_batches(spark, operator):
    own = spark.newSession()
    own.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = own.range(0, 1500, 1, 1).select(F.col("id").alias("doc_id"), F.concat(
        F.col("id").cast("string"), F.repeat(F.lit(" abcdefg"), 2000)).alias("text"))       # 24 MB in one partition
    assert operator(docs).count() == 1500
    assert _largest_batch(docs) <= 1.25 * BATCH_BYTES
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 20))             # the session's own size stays
    assert operator(docs).count() == 1500
    assert _largest_batch(docs) <= 1.25 * (1 << 20)


def test_toxicity_results_do_not_depend_on_batches_and_kept_texts_are_sent_once(spark, capsys):
    rows = [(i, None if i == 3 else "" if i == 4 else f"plain {i % 11} words {'zquorking ' * (i % 5 == 0)}here", "s")
            for i in range(200)]
    labels = [(i, int(i % 5 == 0)) for i in range(200)]
    got = []
    for size in ("64m", "1k"):
        own = spark.newSession()
        own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
        docs, table = documents(own, rows), own.createDataFrame(labels, "doc_id long, toxic int")
        model = toxicity.fit(docs, table)
        got.append([sorted(map(str, x.collect())) for x in (
            toxicity.score(docs, model, keep=["text", "n_chars"]), toxicity.score(docs, model, keep=["lang"]),
            toxicity.score(docs, model, id_col="text"), toxicity.score(docs, model, "doc_id", "n_chars", ["n_chars"]),
            toxicity.keep_clean(docs, table))])
    assert got[0] == got[1] and len(got[0][0]) == 200
    plain = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert {r["doc_id"]: (r["text"], r["score"]) for r in toxicity.score(docs, model, keep=["text"]).collect()} == {
        i: (t, plain[i]) for i, t, _ in rows}
    toxicity.score(docs, model, keep=["text"]).explain()
    assert "__text" not in capsys.readouterr().out


def test_lm_base_score_matches_brute_force_and_the_model_beats_it(spark):
    rng = random.Random(1)
    chain = {k: [rng.choice("abcdefghij") * 3 for _ in range(3)] for k in [c * 3 for c in "abcdefghij"]}
    rows = []
    for i in range(300):
        w = ["aaa"]
        for _ in range(rng.randint(5, 200)):
            w.append(rng.choice(chain[w[-1]]))
        rows.append((i, " ".join(w) + f" rare{i}", "s"))
    rows += [(1000, None, "s"), (1001, "", "s"), (1002, "rare1 unseen", "s"), (1002, "rare1 unseen", "s")]
    out = lm.score(documents(spark, rows), head_words=50).collect()
    count: Counter = Counter()
    tokens = {i: [*words(t), "\0end"] for i, t, _ in rows}
    for i, t, _ in rows:
        if zlib.crc32(str(i).encode()) % 10:
            count.update(tokens[i])
    n, v = sum(count.values()), len(count)
    assert len(out) == len(rows)
    for r in out:
        w = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(count[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
        assert r["score"] < 0
    held = [r for r in out if r["held_out"] and r["doc_id"] < 1000]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) * 0.95
    assert lm.score(documents(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_lm_training_visits_every_position(spark, rounds):
    names = [f"word{i}" for i in range(60)]
    texts = [" ".join(names[:40]), *names[40:], ""]           # each word comes once; short documents are not skipped
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    vocabulary = lm.learn_vocabulary(lm.count_tokens(df))
    w = lm.Weights(lm.train(df, vocabulary, rounds=rounds))
    moved = (w.part[1] != 0).any(axis=1)        # the row of a token moves when the position after it is visited
    assert moved[[int(r) for r in vocabulary.rank[vocabulary.head != lm.END]]].all() and moved[lm.ONE_ROWS - 1]
    assert (w.part[4] != 0).any(axis=1).sum() == 39           # of the tokens three back: 38 words and the start


def test_lm_probabilities_add_up_to_one():
    w = lm.Weights(np.random.default_rng(0).normal(size=lm.Weights.SIZE).astype(np.float32))
    feats = [np.full(lm.CLASSES * lm.CLASS_SIZE + lm.TAILS, x) for x in (3, 5, 7, 9)]
    ranked = np.r_[np.arange(lm.CLASSES * lm.CLASS_SIZE), np.full(lm.TAILS, -1)]
    cls, slot = lm._class_of(ranked, np.r_[np.zeros(lm.CLASSES * lm.CLASS_SIZE, int), np.arange(lm.TAILS)])
    assert (10 ** lm.log10_probabilities(w, feats, cls, slot)).sum() == pytest.approx(1, abs=1e-4)


@pytest.mark.parametrize("rows, values", [(1, 1), (9, 1), (300, 300), (5000, 40), (8192, 4096)])
def test_runs_are_summed_as_reduceat_sums_them(rows, values):
    rng = np.random.default_rng(rows)
    grad, key = rng.normal(size=(rows, 48)).astype(np.float32), np.minimum(rng.zipf(1.3, rows), values)
    order = np.argsort(key, kind="stable")
    begin = np.flatnonzero(np.r_[True, np.diff(key[order]) > 0])
    assert (lm._sums(grad, order, begin) == np.add.reduceat(grad[order], begin, axis=0)).all()


@pytest.mark.parametrize("size", [0, 1, 2, 1000, 70_000])
def test_vocabulary_finds_what_a_search_finds(size):
    rng = np.random.default_rng(size)
    every = np.unique(np.r_[rng.integers(0, 2 ** 64, 2 * size + 2, dtype=np.uint64), np.uint64(0), np.uint64(2 ** 64 - 1)])
    every = np.unique(np.r_[every, every[:50] + np.uint64(1)])
    for head in (np.sort(rng.permutation(every)[:size]), every[:size], every[len(every) - size:]):
        vocabulary = lm.Vocabulary(head, np.ones(size), np.arange(size), size, size, np.zeros(1), np.zeros(1))
        place = {int(h): i for i, h in enumerate(head)}
        assert vocabulary.find(every).tolist() == [place.get(int(h), -1) for h in every]


def test_words_beyond_ascii_have_tail_classes_of_their_own():
    texts = pa.array(["ab äb", None, "", "x語 yz  é q"])
    (_, _, w), = kernel.words(texts)
    wide = (lm.tokens(w).tail // 2 % 2).tolist()
    assert wide == [0, 1, 0, 0, 0, 1, 1, 1, 0, 0]
