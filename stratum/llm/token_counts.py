"""Token counts attributed to sections by character offsets.

A document is encoded once, as a whole, so its tokens are those a model will see. The byte lengths of the tokens add
up to spans; sections are spans too; an interval join of the two (both sorted, so one ``searchsorted``) gives each
section its tokens. A token that crosses a boundary goes, by ``rule``, to the section that holds

* ``first``: its first byte,
* ``last``: its last byte,
* ``largest``: the largest part of it, the earlier section on a tie.

Every token goes to exactly one section, so the sections' counts add up to the document's. Sections are runs of whole
paragraphs: the text is cut after every line feed, so sections cover the text without gaps. A null or empty text has
one empty section of no tokens. Rows repeat as they are; only the named columns are read; an empty table gives an
empty result. Character positions in the result are code points, ends exclusive.

The vocabulary is a file of byte-level BPE ranks (parameter ``ranks``), read in every task and never copied.
"""
from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: how byte_bpe_50k cuts text before the merges (fixed value of the vocabulary)
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SECTION_SCHEMA = ("row_id long, section int, first_char long, last_char long, n_tokens long, n_crossing long, "
                  "doc_tokens long")
RULES = ("first", "last", "largest")


@functools.lru_cache(maxsize=2)
def encoder(ranks: str = RANKS):
    """(encoding, byte length of each token id) of a rank file; kept for the life of a Python worker."""
    import tiktoken
    with open(ranks, "rb") as f:
        table = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    lengths = np.zeros(max(table.values()) + 1, dtype=np.int64)
    for token, rank in table.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}), lengths


def attribute(token_ends: np.ndarray, section_ends: np.ndarray, rule: str = "first") -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, whether it crosses a boundary) for adjoining tokens and sections given by their
    exclusive ends. An empty section gets no token."""
    starts = np.r_[0, token_ends[:-1]]
    first = np.searchsorted(section_ends, starts, side="right")
    last = np.searchsorted(section_ends, token_ends - 1, side="right")
    crossing = last > first
    if rule == "first":
        return first, crossing
    if rule == "last":
        return last, crossing
    chosen = first.copy()
    for t in np.flatnonzero(crossing):
        bounds = np.r_[starts[t], section_ends[first[t]:last[t]], token_ends[t]]
        chosen[t] = first[t] + int(np.argmax(np.diff(bounds)))
    return chosen, crossing


def _sections(raw: bytes) -> np.ndarray:
    """Exclusive byte ends of the sections: after every line feed and at the end."""
    ends = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 10) + 1
    return ends if len(ends) and ends[-1] == len(raw) else np.r_[ends, len(raw)]


def section_tokens(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: str = "first",
                   ranks: str = RANKS) -> DataFrame:
    """One row per section of every document: its number, character span, tokens, how many of them cross its
    boundary, and the tokens of the whole document."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}, not {rule!r}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = encoder(ranks)
        for batch in batches:
            parts: list[list[np.ndarray]] = [[] for _ in range(6)]
            rows = 0

            def flush(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
                row, *rest = [np.concatenate(p) for p in parts]
                ids = batch.column(0).take(pa.array(row, pa.int64()))
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                numbers = np.concatenate([np.arange(len(p)) for p in parts[0]])
                return pa.RecordBatch.from_arrays(
                    [ids, *[pa.array(x, t) for x, t in zip([numbers, *rest], types)]],
                    names=["row_id", "section", "first_char", "last_char", "n_tokens", "n_crossing", "doc_tokens"])

            for i, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                raw = text.encode()
                ids = np.asarray(encoding.encode_ordinary(text), dtype=np.int64)
                ends = np.cumsum(lengths[ids])
                bounds = _sections(raw)
                n = len(bounds)
                if len(ids):
                    chosen, crossing = attribute(ends, bounds, rule)
                    counts = np.bincount(chosen, minlength=n)
                    crossed = np.bincount(chosen[crossing], minlength=n)
                else:
                    counts = crossed = np.zeros(n, dtype=np.int64)
                if len(raw) == len(text):
                    chars = bounds
                else:  # code points: bytes that do not continue one
                    chars = np.r_[0, np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)][bounds]
                for k, x in enumerate((np.full(n, i), np.r_[0, chars[:-1]], chars, counts, crossed,
                                       np.full(n, len(ids)))):
                    parts[k].append(x)
                rows += n
                if rows >= 50_000:
                    yield flush(parts)
                    parts, rows = [[] for _ in range(6)], 0
            if rows:
                yield flush(parts)

    rows = documents.select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SECTION_SCHEMA).withColumnRenamed("row_id", id_col)
