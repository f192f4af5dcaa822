"""End to end: every stage on the sf0.001 stand-in tables, gates, views, catalog, sample slice."""
import json
import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from stratum.contracts import SOURCES
from stratum.operators import quality
from stratum.operators.model import GOLD_TABLES
from stratum.operators.sample import sample_slice
from stratum.plans.jobs import GOLD_CHECKED, SILVER, STAGES, LakeJob
from stratum.sources import standin
from stratum.sources.files import write_csv
from stratum.sources.tables import TableStore

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    """A lake built by all stages. The stand-in sources hold lines of quarantined orders, so silver's gate must raise."""
    root = str(tmp_path_factory.mktemp("lake"))
    store = TableStore(f"file://{root}")
    job = LakeJob(spark, store, sources=standin.sources(spark, SF_SMALL))
    results, refused = {}, []
    for stage in STAGES:
        try:
            results[stage] = job.run_stage(stage)
        except quality.QualityError as error:
            refused.append((stage, str(error)))
    assert [stage for stage, _ in refused] == ["quality_silver"]
    assert "fk:order_id->orders on order_items" in refused[0][1]
    return job, store, results, root


@pytest.fixture(scope="module")
def files(ran):
    """The written lake as plain Parquet files, read by another engine than the one that wrote it."""
    con = duckdb.connect()
    yield lambda layer, name, what: con.execute(
        f"SELECT {what} FROM read_parquet('{ran[3]}/{layer}/{name}/**/*.parquet')").fetchall()
    con.close()


def test_reported_counts_are_those_of_the_files(ran, files):
    results = ran[2]
    written = {("bronze", n): rows for n, rows in results["bronze"].items()}
    written |= {("silver", n): rows for n, rows in results["silver"]["rows"].items()}
    written |= {("gold", n): rows for n, rows in results["gold"].items()}
    written["quarantine", "rejected_rows"] = results["silver"]["rejected"]
    assert len(written) == 8 + 7 + 7 + 1
    assert {t: files(*t, "count(*)")[0][0] for t in written} == written
    assert results["warehouse"] == results["gold"]


@pytest.mark.parametrize("source, distinct", [
    ("orders", "order_id"), ("payments", None), ("order_items", "(order_id, order_item_id)"), ("reviews", "(review_id, order_id)")])
def test_every_bronze_row_is_in_silver_or_quarantine(files, source, distinct):
    """Sources with a key lose repeated rows besides; what is left of every key is one row."""
    bronze, = files("bronze", source, "count(*)")[0]
    silver, keys = files("silver", source, f"count(*), count(DISTINCT {distinct or 0})")[0]
    rejected, = files("quarantine", "rejected_rows", f"count(*) FILTER (WHERE \"table\" = '{source}')")[0]
    if distinct is None:
        assert silver + rejected == bronze
    else:
        assert silver == keys and silver + rejected <= bronze


@pytest.mark.parametrize("table, key", [("fact_orders", "order_id"), ("fact_order_items", "(order_id, order_item_id)"),
                                        ("dim_customer", "customer_key"), ("dim_product", "product_key"),
                                        ("dim_seller", "seller_key"), ("dim_date", "date_key"),
                                        ("mart_daily_kpis", "purchase_date_key")])
def test_gold_grains(files, table, key):
    rows, keys = files("gold", table, f"count(*), count(DISTINCT {key})")[0]
    assert rows == keys > 0


def test_views_agree_with_the_written_facts(spark, ran, files):
    view = {r.year * 100 + r.month: r.orders for r in spark.table("v_monthly_revenue").collect()}
    days = files("gold", "fact_orders", "purchase_date_key // 100")
    assert view == Counter(month for month, in days)
    hidden = {c for contract in SOURCES.values() for c in contract.pii} - {"customer_city"}
    assert not hidden & set(spark.table("v_customers_masked").columns)


def test_catalog_follows_contracts_and_lineage(spark, ran):
    store = ran[1]
    catalog = {r.table: r for r in spark.read.json(store.path("reports", "catalog")).collect()}
    assert catalog.keys() == {f"silver.{n}" for n in SILVER} | {f"gold.{n}" for n in GOLD_TABLES}
    for name in SILVER:
        contract, entry = SOURCES[name], catalog[f"silver.{name}"]
        assert entry.owner == contract.owner and entry.upstream[0] == f"bronze.{name}"
        assert {c.name for c in entry.columns if c.pii} == contract.pii & {c.name for c in entry.columns}
        # the tags also travel in the written table's schema
        fields = store.read(spark, "silver", name).schema.fields
        assert {f.name for f in fields if f.metadata.get("pii")} == {c.name for c in entry.columns if c.pii}
    for name in GOLD_TABLES:
        assert set(catalog[f"gold.{name}"].upstream) <= catalog.keys()


def test_quality_reports_are_written(spark, ran):
    _, store, _, _ = ran
    rep = spark.read.json(store.path("reports", "quality_gold"))
    assert rep.count() == 9 and set(rep.columns) >= {"table", "name", "severity", "failed", "total", "passed"}
    assert spark.read.json(store.path("reports", "quality_silver")).count() == 13


@pytest.mark.parametrize("table, damage, check", [
    ("fact_orders", lambda df: df.union(df.orderBy("order_id").limit(3)), "unique:order_id on fact_orders: 6 of"),
    ("fact_order_items", lambda df: df.withColumn("seller_key", F.lit(-1).cast("long")), "fk:seller_key->dim_seller"),
    ("dim_date", lambda df: df.where("month <> 5"), "fk:purchase_date_key->dim_date"),
])
def test_gold_gate_stops_damaged_tables(spark, ran, tmp_root, table, damage, check):
    """A copy of the gold tables with one of them damaged; the undamaged lake passes."""
    store = TableStore(f"file://{tmp_root}/damaged")
    for n in GOLD_CHECKED:
        df = ran[1].read(spark, "gold", n)
        store.write(damage(df) if n == table else df, "gold", n)
    with pytest.raises(quality.QualityError, match=check):
        LakeJob(spark, store, sources={}).quality("gold")
    assert ran[0].quality("gold")["failed_errors"] == 0


def test_csv_sources_round_trip_through_strict_bronze(spark, ran, tmp_root):
    """Write the stand-in sources as contract CSV files, add one malformed row, and run bronze + silver."""
    src = standin.sources(spark, SF_SMALL)
    raw = f"{tmp_root}/raw"
    for name, contract in SOURCES.items():
        write_csv(src[name].coalesce(1), f"{raw}/{contract.file}")
    bad_dir = f"{raw}/{SOURCES['payments'].file}"
    with open(os.path.join(bad_dir, "part-bad.csv"), "w", encoding="utf-8") as f:
        f.write("order_id,payment_sequential,payment_type,payment_installments,payment_value\nx,notanint,boleto,1,1.0\n")
    store = TableStore(f"file://{tmp_root}/lake")
    job = LakeJob(spark, store, raw_dir=f"file://{raw}")
    counts = job.bronze()
    assert counts["payments"] == src["payments"].count() + 1
    out = job.silver()
    q = store.read(spark, "quarantine", "rejected_rows")
    assert q.filter((F.col("table") == "payments") & (F.col("_reject_reason") == "malformed row")).count() == 1
    assert out["rows"]["payments"] == src["payments"].count()


def test_sample_slice_is_referentially_consistent_and_ingests_back(spark, tmp_root):
    from stratum.operators.sample import write_slice
    src = standin.sources(spark, SF_SMALL)
    s = sample_slice(src, n=100)
    assert s["orders"].count() == 100
    ids = s["orders"].select("order_id")
    assert s["order_items"].join(ids, "order_id", "left_anti").count() == 0
    assert s["sellers"].count() == s["order_items"].select("seller_id").distinct().count()
    write_slice(s, f"{tmp_root}/raw")
    counts = LakeJob(spark, TableStore(f"file://{tmp_root}/lake"), raw_dir=f"file://{tmp_root}/raw").bronze()
    assert counts["orders"] == 100 and counts["order_items"] == s["order_items"].count()


def test_run_writes_a_summary(spark, tmp_root):
    store = TableStore(f"file://{tmp_root}/lake")
    job = LakeJob(spark, store, sources=standin.sources(spark, SF_SMALL))
    summary = job.run(["bronze", "silver", "gold", "quality_gold"])
    assert set(summary) == {"bronze", "silver", "gold", "quality_gold"}
    back = json.loads(spark.read.json(store.path("reports", "run_summary")).first().summary)
    assert back["gold"]["result"]["fact_orders"] == summary["gold"]["result"]["fact_orders"]


def test_command_line_runs_selected_stages(spark, tmp_root):
    from stratum.__main__ import main
    from stratum.session import cluster_settings
    before = {k: spark.conf.get(k, None) for k in cluster_settings(2**30)}
    try:
        summary = main(["--lake", f"file://{tmp_root}/lake", "--tables", SF_SMALL, "--input-gb", "1",
                        "bronze", "silver", "gold"])
    finally:                                        # the session is shared with the other tests
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert list(summary) == ["bronze", "silver", "gold"]
    assert summary["gold"]["result"]["fact_orders"] == summary["silver"]["result"]["rows"]["orders"]


def test_raw_file_names_can_be_mapped(spark, tmp_root):
    from stratum.operators.sample import sample_slice, write_slice
    s = sample_slice(standin.sources(spark, SF_SMALL), n=20)
    names = {n: f"export_{n}_v2.csv" for n in SOURCES}
    write_slice(s, f"{tmp_root}/raw", files=names)
    job = LakeJob(spark, TableStore(f"file://{tmp_root}/lake"), raw_dir=f"file://{tmp_root}/raw", raw_files=names,
                  csv_multi_line=False)
    assert job.bronze()["orders"] == 20


def test_machine_local_lake_is_refused_on_a_cluster():
    from stratum.plans.jobs import _require_shared_root
    _require_shared_root("file:///tmp/lake", "local[8]")
    _require_shared_root("s3a://bucket/lake", "spark://cluster:7077")
    with pytest.raises(ValueError, match="machine-local"):
        _require_shared_root("file:///tmp/lake", "spark://cluster:7077")


class OnCluster:
    """The session, as it would be with executors on other machines."""

    def __init__(self, spark):
        self._spark, self.conf = spark, self
        self.get = lambda key, *default: "spark://cluster:7077" if key == "spark.master" else spark.conf.get(key, *default)

    def __getattr__(self, name):
        return getattr(self._spark, name)


def test_lake_below_the_shared_checkpoint_folder_is_taken_on_a_cluster(spark, tmp_root):
    from stratum.plans.jobs import _require_shared_root
    from stratum.session import scratch_dir
    cluster, frames = OnCluster(spark), {n: spark.createDataFrame([], c.schema) for n, c in SOURCES.items()}
    frames["sellers"] = spark.createDataFrame([("s1", "1", "a", "b"), ("s2", None, "c", None)], SOURCES["sellers"].schema)
    raw = scratch_dir(cluster, "test-raw")
    for name, contract in SOURCES.items():
        write_csv(frames[name], f"{raw}/{contract.file}")
    counts = LakeJob(cluster, TableStore(f"{scratch_dir(cluster, 'test')}/lake"), raw_dir=raw).bronze()
    assert counts == {n: 2 if n == "sellers" else 0 for n in SOURCES}
    with pytest.raises(ValueError, match="machine-local"):
        LakeJob(cluster, TableStore(f"file://{tmp_root}/lake"), raw_dir=raw)
    for outside in ("file:/shared/folder2/lake", "file:/shared/folder/../lake", "file:/shared"):
        with pytest.raises(ValueError, match="machine-local"):
            _require_shared_root(outside, "spark://cluster:7077", "file:///shared/folder")
    _require_shared_root("file:/shared/folder/lake", "spark://cluster:7077", "/shared/folder/")


def test_contract_checks_add_warnings_to_the_silver_report(spark, tmp_root):
    job = LakeJob(spark, TableStore(f"file://{tmp_root}/lake"), sources=standin.sources(spark, SF_SMALL),
                  contract_checks=True, enforce_gates=("gold",))
    job.bronze()
    job.silver()
    out = job.quality("silver")
    names = {(r["table"], r["name"]): r for r in out["results"]}
    dup = names[("payments", "unique:order_id+payment_sequential")]
    assert out["checks"] > 13 and dup["severity"] == "warn" and dup["failed"] > 0
