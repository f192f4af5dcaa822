"""A table rewritten from itself: the old version is readable until the new one is whole."""
import os

import pytest
from pyspark.sql import functions as F

from stratum.sources import tables
from stratum.sources.tables import TableStore


@pytest.fixture
def store(spark, tmp_root):
    store = TableStore(f"file://{tmp_root}/lake")
    store.write(spark.range(100).withColumn("part", F.col("id") % 4), "silver", "t", partition_by="part")
    return store


def ids(spark, store):
    return sorted(r.id for r in store.read(spark, "silver", "t").collect())


def test_rewrite_replaces_the_table_and_leaves_nothing_behind(spark, store, tmp_root):
    for keep in (50, 20):
        df = store.read(spark, "silver", "t")
        assert store.rewrite(df.where(F.col("id") < keep), "silver", "t", partition_by="part") == keep
        assert ids(spark, store) == list(range(keep))
    assert os.listdir(f"{tmp_root}/lake/silver") == ["t"]
    assert sorted(d for d in os.listdir(f"{tmp_root}/lake/silver/t") if d.startswith("part=")) == [
        f"part={k}" for k in range(4)]
    assert store.rewrite(spark.range(3).withColumn("part", F.lit(0)), "silver", "fresh") == 3


def test_a_failure_while_writing_leaves_the_old_table(spark, store):
    broken = store.read(spark, "silver", "t").withColumn(
        "id", F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("lost input")).cast("long")))
    with pytest.raises(Exception, match="lost input"):
        store.rewrite(broken, "silver", "t")
    assert ids(spark, store) == list(range(100))
    assert store.rewrite(store.read(spark, "silver", "t").where("id < 7"), "silver", "t") == 7
    assert ids(spark, store) == list(range(7))


@pytest.mark.parametrize("renames_done", [0, 1])
def test_a_failure_between_writing_and_the_last_rename_is_made_good(spark, store, monkeypatch, renames_done):
    done = []
    rename = tables._rename

    def failing(fs, source, target):
        if len(done) == renames_done:
            raise OSError("driver lost")
        done.append(source)
        rename(fs, source, target)
    monkeypatch.setattr(tables, "_rename", failing)
    with pytest.raises(OSError, match="driver lost"):
        store.rewrite(store.read(spark, "silver", "t").where("id < 7"), "silver", "t")
    monkeypatch.undo()
    assert ids(spark, store) == list(range(100))
    assert store.rewrite(store.read(spark, "silver", "t").where("id < 5"), "silver", "t") == 5
    assert ids(spark, store) == list(range(5))
