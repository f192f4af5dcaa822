"""CSV ingestion (strict / permissive / failfast), all-string reads, table store."""
import os

import pytest
from pyspark.sql import functions as F

from stratum.contracts import SELLERS
from stratum.sources.files import (read_contract_csv, read_raw_strings, split_corrupt, write_csv)
from stratum.sources.tables import TableStore


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


GOOD = ("seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
        "s1,01234,\"sao\npaulo\",SP\n"
        "s2,1234,\"rio, \"\"de\"\" janeiro\",RJ\n")


def test_strict_read_keeps_types_multiline_quotes_and_metadata(spark, tmp_root):
    p = f"{tmp_root}/sellers.csv"
    _write(p, GOOD)
    df = read_contract_csv(spark, SELLERS, p, multi_line=True)
    good, bad = split_corrupt(df)
    rows = {r.seller_id: r for r in good.collect()}
    assert rows["s1"].seller_city == "sao\npaulo" and rows["s2"].seller_city == 'rio, "de" janeiro'
    assert rows["s1"].seller_zip_code_prefix == "01234" and rows["s1"]._source_file == "sellers.csv"
    assert bad.count() == 0


def test_contracts_say_which_sources_may_hold_newlines(spark, tmp_root):
    from stratum.contracts import REVIEWS, SOURCES
    assert [n for n, c in SOURCES.items() if c.multi_line] == ["reviews"]
    p = f"{tmp_root}/sellers.csv"
    _write(p, GOOD)
    good, bad = split_corrupt(read_contract_csv(spark, SELLERS, p))
    assert [r.seller_id for r in good.collect()] == ["s2"] and bad.count() == 2      # both halves of the row are kept
    lenient = read_contract_csv(spark, SELLERS, p, mode="permissive")
    assert {r.seller_city for r in lenient.collect()} == {"sao\npaulo", 'rio, "de" janeiro'}
    p = f"{tmp_root}/reviews.csv"
    _write(p, ",".join(REVIEWS.column_names) + "\nr1,o1,5,ok,\"two\nlines\",2020-01-01 00:00:00,2020-01-02 00:00:00\n")
    good, bad = split_corrupt(read_contract_csv(spark, REVIEWS, p))
    assert good.first().review_comment_message == "two\nlines" and bad.count() == 0


def test_large_single_line_files_are_split_over_tasks(spark, tmp_root):
    p = f"{tmp_root}/sellers.csv"
    _write(p, GOOD.splitlines()[0] + "\n" + "".join(f"s{i},{i % 99999},city {i},SP\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        split = read_contract_csv(spark, SELLERS, p)
        assert split.count() == 20_000 and split.rdd.getNumPartitions() > 4
        assert read_contract_csv(spark, SELLERS, p, multi_line=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_strict_read_rejects_reordered_missing_or_extra_columns(spark, tmp_root):
    for i, header in enumerate(["seller_zip_code_prefix,seller_id,seller_city,seller_state",
                                "seller_id,seller_zip_code_prefix,seller_city",
                                "seller_id,seller_zip_code_prefix,seller_city,seller_state,extra"]):
        p = f"{tmp_root}/drift{i}.csv"
        _write(p, header + "\ns1,1,a,b\n")
        with pytest.raises(Exception):
            read_contract_csv(spark, SELLERS, p).collect()
        # the lenient reader takes the same file by position without complaint
        assert read_contract_csv(spark, SELLERS, p, mode="permissive").count() == 1


def test_bad_values_and_short_rows_go_to_corrupt_record(spark, tmp_root):
    from stratum.contracts import PAYMENTS
    p = f"{tmp_root}/payments.csv"
    _write(p, "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
              "o1,1,boleto,1,10.5\n"
              "o2,x,boleto,1,3.0\n"
              "o3,1,boleto\n")
    good, bad = split_corrupt(read_contract_csv(spark, PAYMENTS, p, multi_line=False))
    assert [r.order_id for r in good.collect()] == ["o1"]
    raws = sorted(r._corrupt_record for r in bad.collect())
    assert raws == ["o2,x,boleto,1,3.0", "o3,1,boleto"] and bad.first()._reject_reason == "malformed row"
    with pytest.raises(Exception):
        read_contract_csv(spark, PAYMENTS, p, mode="failfast").collect()


def test_raw_string_read_keeps_empty_values_and_strips_bom(spark, tmp_root):
    p = f"{tmp_root}/translation.csv"
    _write(p, "﻿product_category_name,product_category_name_english\nbeleza,\n")
    df = read_raw_strings(spark, p)
    assert df.columns == ["product_category_name", "product_category_name_english"]
    r = df.first()
    assert r.product_category_name == "beleza" and r.product_category_name_english == ""


def test_csv_round_trip_and_table_store(spark, tmp_root):
    p = f"{tmp_root}/in.csv"
    _write(p, GOOD)
    df = read_contract_csv(spark, SELLERS, p, metadata=False, multi_line=True)
    write_csv(split_corrupt(df)[0], f"{tmp_root}/out")
    back = read_contract_csv(spark, SELLERS, f"{tmp_root}/out", metadata=False, multi_line=True)
    assert split_corrupt(back)[0].count() == 2
    store = TableStore(f"file://{tmp_root}/lake")
    t = spark.range(10).withColumn("part", F.col("id") % 2)
    assert store.write(t, "bronze", "t", partition_by="part") == 10
    back = store.read(spark, "bronze", "t")
    assert back.count() == 10 and "part" in back.columns
    # overwrite a table with a frame computed from itself
    assert store.rewrite(back.filter("id < 5"), "bronze", "t") == 5
    assert store.read(spark, "bronze", "t").count() == 5


def test_cluster_settings_scale_with_input_and_respect_existing_values(spark):
    from stratum.session import apply_settings, cluster_settings
    big = cluster_settings(100 * 2**40)                       # 100 TB
    # no cap: 256 MiB per partition also at this size
    assert int(big["spark.sql.shuffle.partitions"]) * 256 * 2**20 == 100 * 2**40
    assert int(cluster_settings(10 * 2**30)["spark.sql.shuffle.partitions"]) == 200   # floor for small inputs
    applied = apply_settings(spark, {"spark.sql.shuffle.partitions": "999"})
    assert applied == {} and spark.conf.get("spark.sql.shuffle.partitions") != "999"


def test_csv_sink_keeps_spaces_and_fractional_seconds(spark, tmp_root):
    from datetime import datetime
    from stratum.contracts import ORDERS
    df = spark.createDataFrame([("o1", "c1", " Delivered ", datetime(2018, 1, 1, 10, 0, 0, 500000), None, None, None,
                                 None)], ORDERS.schema)
    write_csv(df, f"{tmp_root}/orders")
    back = read_contract_csv(spark, ORDERS, f"{tmp_root}/orders", metadata=False).first()
    assert back.order_status == " Delivered " and back.order_purchase_timestamp.microsecond == 500000


def test_local_scratch_is_refused_on_a_cluster_master():
    from stratum.session import _require_local
    _require_local("local[8]")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        _require_local("spark://cluster:7077")


def test_catalog_table_of_another_lake_is_not_read(spark, tmp_root):
    a = TableStore(f"file://{tmp_root}/a", database="shared_db_test")
    b = TableStore(f"file://{tmp_root}/b", database="shared_db_test")
    t = spark.range(10).withColumn("order_id", F.col("id").cast("string"))
    a.write(t, "silver", "orders", bucket_by=["order_id"], buckets=2)
    b_rows = spark.range(3).withColumn("order_id", F.col("id").cast("string"))
    b_rows.write.mode("overwrite").parquet(b.path("silver", "orders"))
    assert b.read(spark, "silver", "orders").count() == 3          # its own files, not lake a's table
    with pytest.raises(ValueError, match="another lake"):
        b.write(b_rows, "silver", "orders", bucket_by=["order_id"], buckets=2)


def test_catalog_paths_compare_by_path_and_relative_roots_become_absolute():
    from stratum.sources.tables import _same_path
    assert _same_path("hdfs://nn:8020/lake/silver/orders", "hdfs:///lake/silver/orders/")
    assert _same_path("file:/tmp/x", "/tmp/x") and not _same_path("file:/tmp/x", "/tmp/y")
    assert TableStore("lake/rel").root.startswith("/")


def test_bucketed_write_makes_one_file_per_bucket(spark, tmp_root):
    store = TableStore(f"file://{tmp_root}/lake", database="bucket_files_test")
    t = spark.range(0, 1000, 1, 16).withColumn("order_id", F.col("id").cast("string"))
    assert store.write(t, "silver", "orders", bucket_by=["order_id"], buckets=4) == 1000
    files = [f for f in os.listdir(f"{tmp_root}/lake/silver/orders") if f.startswith("part-")]
    assert len(files) <= 4
    assert store.read(spark, "silver", "orders").count() == 1000


def test_json_sink_keeps_microseconds(spark, tmp_root):
    from datetime import datetime
    from stratum.sources.files import write_json
    at = datetime(2018, 1, 1, 10, 0, 0, 123456)
    write_json(spark.createDataFrame([(at,)], "at timestamp"), f"{tmp_root}/out")
    assert spark.read.schema("at timestamp").json(f"{tmp_root}/out").first().at == at


def test_an_explicit_partition_count_is_not_undone_by_the_initial_count(spark):
    from stratum.session import apply_settings
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert spark.conf.get("spark.sql.shuffle.partitions", None)          # the test session sets it
    assert apply_settings(spark, {key: "999"}) == {} and spark.conf.get(key, None) != "999"
