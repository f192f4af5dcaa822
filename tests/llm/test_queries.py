"""The registered queries against DuckDB where SQL can express them, the pipeline by its stages, and the guard."""
from __future__ import annotations

import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from stratum.llm import mixing, ngram_join, queries, secrets, toxicity
from stratum.llm.tables import table

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def plain(rows):
    return Counter(tuple(round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    sql = con.sql(queries.oracle_sql()[name])
    assert sorted(sql.columns) == columns
    assert plain(df.select(*columns).collect()) == plain(sql.select(*columns).fetchall())


def test_pipeline_stages_keep_what_they_should(spark):
    docs = table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard_join", "secret_scan", "source_mixing", "best_fit_packing"]
    stages = dict(corpus_pipeline.STAGES)
    scores = toxicity.digest(docs, table(spark, SF, "labels")).select("doc_id", "predicted").collect()
    clean = stages["toxicity"](spark, docs, SF).cache()
    assert clean.columns == docs.columns
    assert {r[0] for r in clean.select("doc_id").collect()} == {r[0] for r in scores if not r[1]}
    one = stages["ngram_jaccard_join"](spark, clean, SF).cache()
    firsts = ngram_join.near_duplicates(clean).where("doc_id = component_id")
    assert one.columns == docs.columns
    assert sorted(r[0] for r in one.select("doc_id").collect()) == sorted(r[0] for r in firsts.select("doc_id").collect())
    masked = stages["secret_scan"](spark, one, SF).cache()
    assert masked.columns == docs.columns and masked.count() == one.count()
    left = secrets.digest(masked).agg({"n_live": "sum"}).first()[0]
    assert left == 0
    mixed = stages["source_mixing"](spark, masked, SF).cache()
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(masked).collect() if r["copies"]}
    assert mixed.columns == docs.columns and Counter(r[0] for r in mixed.select("doc_id").collect()) == copies
    packed = stages["best_fit_packing"](spark, mixed, SF).collect()
    words = {r["doc_id"]: r["n"] for r in mixed.select("doc_id", mixing.words(mixed["text"]).alias("n")).collect()}
    got = Counter()
    for r in packed:
        got[r["doc_id"]] += r["piece_tokens"]
    assert got == {d: copies[d] * (words[d] + 1) for d in copies}


def test_nothing_else_in_the_library_imports_the_operators():
    for file in (ROOT / "stratum").rglob("*.py"):
        if "llm" not in file.parts:
            assert not re.search(r"(import|from)\s+\S*\bllm\b|\.llm\b", file.read_text()), file


def test_entry_registers_every_query():
    code = "import __spark_entry__ as e; q = e.queries(); print(sorted(k for k in q if k.startswith('op') or k == 'pipeline'))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120, check=True).stdout
    assert all(f"op{n}_" in out for n in range(1, 14)) and "pipeline" in out
