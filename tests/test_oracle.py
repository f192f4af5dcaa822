"""Every registered lake query against its DuckDB oracle on the sf0.001 tables (rows, columns, values)."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import TABLES, rows_of  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from stratum.plans import registry  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
ORACLE = registry.oracle_sql()
QUERIES = {name: query for name, query in entry.queries().items() if name in registry.QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols, srows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert rows_of(cols, srows) == rows_of(ocols, orows)


def test_entry_runs_on_the_smoke_tables(spark):
    df = entry.entry(spark)
    assert df.columns == ["purchase_date_key", "orders", "revenue", "late_share", "cancel_share", "avg_review"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["quality_report", "check_references"])
def test_a_written_lake_gives_the_same_checks(spark, con, name):
    spark.conf.set(registry.MATERIALIZE_CONF, "true")
    try:
        df = QUERIES[name](spark, SF_SMALL)
        cols, srows = df.columns, [tuple(r) for r in df.collect()]
    finally:
        spark.conf.unset(registry.MATERIALIZE_CONF)
    res = con.execute(ORACLE[name])
    assert rows_of(cols, srows) == rows_of([d[0] for d in res.description], res.fetchall())


def test_entry_pins_utc_so_results_do_not_depend_on_the_session_zone(spark, con):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    df = QUERIES["hourly_windows"](spark, SF_SMALL)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    res = con.execute(ORACLE["hourly_windows"])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in res.description],
                                                                            res.fetchall())


def test_large_inputs_are_written_once_for_their_checks(spark, monkeypatch):
    assert not registry._materializes(spark, SF_SMALL)
    monkeypatch.setattr(registry, "MATERIALIZE_BYTES", 1)
    assert registry._materializes(spark, SF_SMALL)


def test_a_report_over_written_tables_derives_each_source_once(spark, tmp_path):
    """Own rows; what the report says must not depend on whether tables are written, and over written tables no
    check derives the lines from their source again."""
    ts = "timestamp_ntz'2020-01-0{} 00:00:00'"
    rows = {"region": "SELECT 0 AS r_regionkey, 'ASIA' AS r_name", "nation": "SELECT 0 AS n_nationkey, 'N' AS n_name, 0 AS n_regionkey",
            "customer": "SELECT id AS c_custkey, concat('C', id % 3) AS c_name, 0 AS c_nationkey FROM range(4)",
            "supplier": "SELECT id AS s_suppkey, 0 AS s_nationkey FROM range(2)",
            "part": "SELECT id AS p_partkey, 'p' AS p_name, 'Brand#1' AS p_brand, 'T' AS p_type, 1 AS p_size, 1D AS p_retailprice FROM range(2)",
            "orders": f"SELECT id DIV 2 AS o_orderkey, if(id = 9, NULL, id) AS o_custkey, 'F' AS o_orderstatus, {ts.format(1)} AS o_orderdate FROM range(10)",
            "lineitem": "SELECT nullif(id DIV 3, 6) AS l_orderkey, id % 4 AS l_partkey, id % 2 AS l_suppkey, CAST(id % 2 AS INT) AS l_linenumber, "
                        "1D AS l_quantity, 20000D * id AS l_extendedprice, 0D AS l_discount, 0D AS l_tax, 'R' AS l_returnflag, "
                        f"{ts.format(2)} AS l_shipdate FROM range(20)",
            "events": f"SELECT id AS user_id, '{{\"k\": 1}}' AS props, 2D AS value, 'view' AS event_type, {ts.format(3)} AS ts FROM range(3)"}
    for name, sql in rows.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    told, plans = {}, {}
    try:
        for setting in ("true", "false"):
            spark.conf.set(registry.MATERIALIZE_CONF, setting)
            for name in ("quality_report", "gold_quality_suite", "quality_suite"):
                df = QUERIES[name](spark, str(tmp_path))
                told[name, setting] = sorted(map(tuple, df.collect()))
                plans[name, setting] = df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset(registry.MATERIALIZE_CONF)
    for name in ("quality_report", "gold_quality_suite", "quality_suite"):
        assert told[name, "true"] == told[name, "false"]
    assert "l_orderkey" in plans["quality_report", "false"] and "l_orderkey" not in plans["quality_report", "true"]


def test_tables_of_some_gigabytes_count_as_large():
    assert registry.MATERIALIZE_BYTES <= 128 * 2**20
