"""License scans by an exact set-similarity join of text blocks with licence templates.

A block is a window of 2L consecutive words, one starting at every L-th word, for a template of L distinct words; so
every passage of up to L + 1 words lies whole in some block. A block matches when it holds at least
``threshold`` of the template's words. The words of the templates are counted over the whole corpus and put in one
global order, rarest first. With need = ceil(threshold * L), a matching block must hold one of the first
L - need + 1 words of the template in that order (prefix filter), have at least ``need`` template words at all
(length filter), and, when its first common word stands at place i of the order, still be able to reach ``need``
with the L - i words from there on (positional filter). What passes is verified, so the result is exact and does not
depend on the order.

Base phrases are found as consecutive words. A null text counts as empty, gives zero counts, null places and empty
labels; an empty table gives an empty result; rows repeat as they are; only the two named columns are read.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel
from .tables import ARRAY_SCHEMA, add_arrays, array_rows, task_number

#: phrase -> label, found as consecutive words
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: label -> template text; a block is compared with the set of its words
TEMPLATES = {
    "agpl": "licensed under the gnu affero general public license version 3",
    "apache-2": "licensed under the apache license version 2 0",
    "apache-2-notice": "you may not use this file except in compliance with the license you may obtain a copy of the "
                       "license at apache org",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided "
           "that the following conditions are met",
    "cc-by-nc": "licensed under the creative commons attribution noncommercial 4 0 international license",
    "cc-by-sa": "licensed under the creative commons attribution sharealike 4 0 international license",
    "gpl": "this work is licensed under the gnu general public license version 3",
    "lgpl": "licensed under the gnu lesser general public license version 3",
    "mit": "released under the terms of the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files to deal in the software without restriction",
    "mpl": "this source code form is subject to the terms of the mozilla public license",
}
THRESHOLD = 0.8
#: room for the blocks of a document and for the words of a template in one packed key
BLOCKS, WORDS = 1 << 26, 1 << 12

SCHEMA = ("row_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, matches array<struct<label:string,block:long,common:int,size:int>>")


class _Plan:
    """Templates as ids into one sorted table of word hashes."""

    def __init__(self, templates: dict[str, str], threshold: float, phrases: dict[str, str]):
        self.names = sorted(templates)
        sets = [sorted(set(templates[n].split())) for n in self.names]
        vocabulary = sorted({w for s in sets for w in s} | {w for p in phrases for w in p.split()})
        hashes = np.array([kernel.hash_word(w) for w in vocabulary], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        place = {vocabulary[k]: i for i, k in enumerate(order)}
        self.sets = [np.array([place[w] for w in s]) for s in sets]
        self.need = [math.ceil(threshold * len(s) - 1e-9) for s in sets]
        self.phrases = [(np.array([place[w] for w in p.split()]), label) for p, label in phrases.items()]

    def ids(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, -1)


def _frequencies(documents: DataFrame, text_col: str, plan: _Plan) -> np.ndarray:
    """How often each template word stands in the corpus (one fixed-size array)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(plan.hashes), dtype=np.int64)
        for batch in batches:
            for _, _, w in kernel.words(batch.column(0), kernel.ALNUM_WORDS):
                ids = plan.ids(w.hashes())
                total += np.bincount(ids[ids >= 0], minlength=len(total))
        yield array_rows(total, task_number())

    rows = documents.select(F.col(text_col).cast("string")).mapInArrow(count, ARRAY_SCHEMA)
    return add_arrays(rows, np.int64, len(plan.hashes), rows.rdd.getNumPartitions())


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD,
         phrases: dict[str, str] = PHRASES) -> DataFrame:
    """One row per input row (schema ``SCHEMA`` with ``row_id`` named ``id_col``). ``matches`` lists, per template
    and block, the number of its words found; ``score`` is 1 where a phrase stands, else the largest share of a
    template found in any matching block, else 0."""
    plan = _Plan(templates, threshold, phrases)
    rank = np.empty(len(plan.hashes), dtype=np.int64)
    frequency = _frequencies(documents, text_col, plan)
    rank[np.lexsort((plan.hashes, frequency))] = np.arange(len(rank))
    ordered = [s[np.argsort(rank[s])] for s in plan.sets]     # each template's words, rarest first

    def join(w_ids: np.ndarray, doc: np.ndarray, word: np.ndarray, t: int) -> list[tuple[int, int, int]]:
        """(doc, block, common words) of template t over the template words of a chunk."""
        tokens, need = ordered[t], plan.need[t]
        size = len(tokens)
        place = np.full(len(plan.hashes), -1)
        place[tokens] = np.arange(size)
        mine = place[w_ids]

        def blocks(use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """(doc and block, place) of the words in ``use``; a word lies in its block and in the one before it."""
            block = word[use] // size
            key, inner = doc[use] * BLOCKS + block, block > 0
            return np.concatenate([key, key[inner] - 1]), np.concatenate([mine[use], mine[use][inner]])

        prefix = (mine >= 0) & (mine <= size - need)           # prefix filter: one of the rarest words must be there
        if not prefix.any():
            return []
        wanted = np.unique(blocks(prefix)[0])
        keys, places = blocks(mine >= 0)
        at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
        keep = wanted[at] == keys
        pair = np.unique(keys[keep] * WORDS + places[keep])    # sorted by block, then by global order
        keys, places = pair // WORDS, pair % WORDS
        head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        count = np.diff(np.r_[head, len(keys)])                # length filter and positional filter, then the count
        good = (count >= need) & (size - places[head] >= need)
        return [(int(k // BLOCKS), int(k % BLOCKS), int(c)) for k, c in zip(keys[head[good]], count[good])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, w in kernel.words(batch.column(1), kernel.ALNUM_WORDS):
                n = w.n_docs
                ids = plan.ids(w.hashes())
                starts, labels_at = [], []
                for tokens, label in plan.phrases:
                    last = len(ids) - len(tokens) + 1
                    if last <= 0:
                        continue
                    hit = np.ones(last, dtype=bool)
                    for k, token in enumerate(tokens):
                        hit &= ids[k:last + k] == token
                    at = np.flatnonzero(hit)
                    at = at[w.doc[at] == w.doc[at + len(tokens) - 1]]
                    starts.append(at)
                    labels_at += [label] * len(at)
                starts = np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64)
                places: dict[int, list[tuple[int, str]]] = {}
                for at, label in zip(starts, labels_at):
                    places.setdefault(int(w.doc[at]), []).append((int(at - w.first[w.doc[at]]), label))
                known = np.flatnonzero(ids >= 0)
                doc = w.doc[known]
                word = known - w.first[doc]
                matches: dict[int, list[dict]] = {}
                for t, name in enumerate(plan.names):
                    for d, block, common in join(ids[known], doc, word, t):
                        matches.setdefault(d, []).append(
                            {"label": name, "block": block, "common": common, "size": len(ordered[t])})
                out: list[list] = [[] for _ in range(7)]
                for d in range(n):
                    base, more = places.get(d, []), matches.get(d, [])
                    base_labels = sorted({x[1] for x in base})
                    out[0].append(len(base))
                    out[1].append(min(base)[0] if base else None)
                    out[2].append(max(base)[0] if base else None)
                    out[3].append(",".join(base_labels))
                    out[4].append(",".join(sorted(set(base_labels) | {m["label"] for m in more})))
                    out[5].append(1.0 if base else max((m["common"] / m["size"] for m in more), default=0.0))
                    out[6].append(more)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(w.first), pa.int64()), pa.array(out[0], pa.int64()),
                     pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string()),
                     pa.array(out[4], pa.string()), pa.array(out[5], pa.float64()),
                     pa.array(out[6], pa.list_(pa.struct([("label", pa.string()), ("block", pa.int64()),
                                                          ("common", pa.int32()), ("size", pa.int32())])))],
                    names=["row_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
                           "matches"])

    rows = documents.select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA).withColumnRenamed("row_id", id_col)


def oracle_sql() -> str:
    """The digest in DuckDB, with every block verified and no filter."""
    values = ", ".join(f"('{name}', '{word}', {len(set(text.split()))})"
                       for name, text in sorted(TEMPLATES.items()) for word in sorted(set(text.split())))
    phrase = []
    for text, label in PHRASES.items():
        parts = text.split()
        cond = " AND ".join(f"w[i + {k}] = '{p}'" for k, p in enumerate(parts))
        phrase.append(f"SELECT rid, '{label}' AS label, i - 1 AS pos FROM "
                      f"(SELECT rid, w, unnest(range(1, len(w) - {len(parts) - 2})) AS i FROM d) WHERE {cond}")
    return f"""
WITH d AS (SELECT doc_id AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
base AS ({" UNION ALL ".join(phrase)}),
b AS (SELECT rid, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
      string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY rid),
tmpl(label, word, size) AS (VALUES {values}),
words AS (SELECT rid, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM d),
hit AS (SELECT rid, label, size, word, pos // size AS block FROM words JOIN tmpl USING (word)),
blocks AS (SELECT rid, label, size, word, block FROM hit UNION
           SELECT rid, label, size, word, block - 1 FROM hit WHERE block > 0),
m AS (SELECT rid, label, size, count(*) AS common FROM blocks GROUP BY rid, label, size, block
      HAVING count(*) >= ceil({THRESHOLD} * size - 1e-9)),
l AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM
      (SELECT rid, label FROM m UNION ALL SELECT rid, label FROM base) GROUP BY rid),
s AS (SELECT rid, max(common::DOUBLE / size) AS share FROM m GROUP BY rid)
SELECT rid AS doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN b USING (rid) LEFT JOIN l USING (rid) LEFT JOIN s USING (rid)
"""
