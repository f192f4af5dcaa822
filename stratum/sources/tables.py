"""Layered table store (S6-S11): ``<root>/<layer>/<name>`` as Parquet.

The root is any Hadoop-compatible URI (``file:/``, ``hdfs://``, ``s3a://``...). Writes report their row count
through an ``Observation`` collected while writing, so no second scan is needed to count.

With a catalog ``database`` the store can also write *bucketed* tables (registered as external tables over the same
paths). Tables bucketed on a join or grouping key are read back with that hash partitioning, so later joins and
aggregations on the key need no shuffle. Bucket specs live in the catalog, so stages that run as separate
applications need a shared metastore; without the catalog entry a table is read as plain Parquet (correct, just
not co-located).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class TableStore:
    def __init__(self, root: str, database: str | None = None):
        import os
        from urllib.parse import urlparse
        if not urlparse(root).scheme and not root.startswith("/"):
            root = os.path.abspath(root)       # catalog tables resolve relative paths elsewhere (the warehouse)
        self.root = root.rstrip("/")
        self.database = database

    def path(self, layer: str, name: str) -> str:
        """S6."""
        return f"{self.root}/{layer}/{name}"

    def table_name(self, layer: str, name: str) -> str:
        return f"{self.database}.{layer}_{name}"

    def _registered_location(self, spark: SparkSession, layer: str, name: str) -> str | None:
        """Where the catalog says ``layer.name`` lives, or None when it is not registered."""
        table = self.table_name(layer, name)
        if not (self.database and spark.catalog.tableExists(table)):
            return None
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
        return rows[0]["data_type"] if rows else None

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        """The catalog table when it is registered at this store's path (bucket-aware scan), else a Parquet
        scan of the path; Hive-style partition directories are discovered as columns."""
        if _same_path(self._registered_location(spark, layer, name), self.path(layer, name)):
            return spark.table(self.table_name(layer, name))
        self._recover(spark, layer, name)
        return spark.read.parquet(self.path(layer, name))

    def write(self, df: DataFrame, layer: str, name: str, partition_by: str | list[str] | None = None,
              mode: str = "overwrite", fmt: str = "parquet", bucket_by: list[str] | None = None,
              buckets: int | None = None) -> int:
        """Overwrite (or append) the table, optionally Hive-partitioned or bucketed; returns the rows written.

        ``fmt`` is Parquet for tables; reports use ``json`` (S15).
        """
        obs = Observation(f"{layer}.{name}")
        parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
        if bucket_by and not (self.database and buckets):
            raise ValueError("bucketed tables need a catalog database and a bucket count")
        if bucket_by:
            # one task per bucket, hashed as the buckets are: one file per bucket (and partition value) instead of
            # one per task and bucket
            df = df.repartition(buckets, *bucket_by)
        elif parts:
            # AQE rebalance: rows of one partition value meet in few tasks (few files per directory), while a
            # skewed value is split across tasks and small ones are coalesced.
            df = df.hint("rebalance", *parts)
        writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
        if parts:
            # an overwrite replaces the whole table, whatever the session's partitionOverwriteMode says
            writer = writer.partitionBy(*parts).option("partitionOverwriteMode", "static")
        if bucket_by:
            df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
            where = self._registered_location(df.sparkSession, layer, name)
            if where is not None and not _same_path(where, self.path(layer, name)):
                raise ValueError(f"{self.table_name(layer, name)} is registered at {where}, another lake; "
                                 "give each lake its own database")
            (writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by).format(fmt)
             .option("path", self.path(layer, name)).saveAsTable(self.table_name(layer, name)))
        else:
            # a plain write replaces this lake's own bucketed registration of the table (never another lake's)
            if _same_path(self._registered_location(df.sparkSession, layer, name), self.path(layer, name)):
                df.sparkSession.sql(f"DROP TABLE IF EXISTS {self.table_name(layer, name)}")
            writer.format(fmt).save(self.path(layer, name))
        return int(obs.get["rows"])

    def rewrite(self, df: DataFrame, layer: str, name: str, partition_by: str | list[str] | None = None,
                bucket_by: list[str] | None = None, buckets: int | None = None) -> int:
        """Overwrite a table with a frame that reads from it; returns the rows written.

        The new version is written whole beside the table, in a folder that Spark's readers skip, while the old one
        stays readable; then two renames put it in place (``_swap``). A failure while writing leaves the old table as it
        was, one between the renames is made good by the next ``read`` or ``rewrite``. On stores that copy to rename
        (some object stores) the swap takes as long as a copy, and readers may meet a half-moved folder.

        A bucketed table keeps its entry in the catalog, so its frame is first cut loose from the old files by a
        reliable ``checkpoint()`` (in the session's checkpoint folder) and then written over them.
        """
        from ..session import ensure_checkpoint_dir
        spark = df.sparkSession
        if bucket_by or self._registered_location(spark, layer, name):
            ensure_checkpoint_dir(spark)
            return self.write(df.checkpoint(eager=True), layer, name, partition_by, bucket_by=bucket_by, buckets=buckets)
        self._recover(spark, layer, name)
        rows = self.write(df, layer, _staged(name), partition_by)
        self._swap(spark, layer, name)
        return rows

    def _swap(self, spark: SparkSession, layer: str, name: str) -> None:
        """Put the staged version of a table in place of the old one, which goes only after that."""
        fs, new = _hadoop(spark, self.path(layer, _staged(name)))
        _, table = _hadoop(spark, self.path(layer, name))
        _, old = _hadoop(spark, self.path(layer, _previous(name)))
        fs.delete(old, True)
        if fs.exists(table):
            _rename(fs, table, old)
        _rename(fs, new, table)
        fs.delete(old, True)

    def _recover(self, spark: SparkSession, layer: str, name: str) -> None:
        """After a failure between the two renames the old version is back under the table's name."""
        fs, old = _hadoop(spark, self.path(layer, _previous(name)))
        _, table = _hadoop(spark, self.path(layer, name))
        if not fs.exists(table) and fs.exists(old):
            _rename(fs, old, table)


def _staged(name: str) -> str:
    return f"_{name}.next"


def _previous(name: str) -> str:
    return f"_{name}.previous"


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {source} to {target}")


def _plain_path(location: str) -> str:
    """A location's path, however scheme and authority are spelled (file:/x, file:///x, /x, hdfs:///x,
    hdfs://nn:8020/x), without trailing slashes."""
    from urllib.parse import urlparse
    return "/" + urlparse(location).path.strip("/")


def _same_path(a: str | None, b: str) -> bool:
    """Compare locations by their path."""
    return a is not None and _plain_path(a) == _plain_path(b)


def is_below(location: str, folder: str) -> bool:
    """Whether a location lies in ``folder`` or one of its subfolders, on the same kind of store (no scheme: file)."""
    import posixpath
    from urllib.parse import urlparse
    kind = lambda p: urlparse(p).scheme or "file"
    inside = posixpath.normpath(_plain_path(location)).startswith(posixpath.normpath(_plain_path(folder)).rstrip("/") + "/")
    return inside and kind(location) == kind(folder)
