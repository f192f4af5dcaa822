"""Shared Spark helpers of the operators: reading tables, cutting lineage, adding up arrays, scratch tables."""
from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import apply_settings, scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FILE_ROWS = 1_000_000     # rows worth a file of their own, in tables of a few numbers per row


def cut(df: DataFrame, tag: str, most_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the session's shared scratch folder and read it back: later steps do not recompute it, and a
    lost executor loses nothing of it. Where no more than ``most_rows`` short rows can come, it is written by no more
    tasks than these rows or the session's cores are worth."""
    path = scratch_dir(df.sparkSession, tag)
    if most_rows is not None:
        df = df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-most_rows // FILE_ROWS)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what runs inside (rows that carry large values)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Bytes of an Arrow batch that carries whole texts
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of about ``BATCH_BYTES``, unless the session sets a size. Texts reach Python tasks in batches; one
    batch is held by the JVM (off its heap, in buffers that double as they fill) and by the Python worker, for each task
    of an executor, and Spark alone lets it grow to 10,000 rows or 64 MB. The setting stays: the caller runs the result."""
    apply_settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)})


def text_or_empty(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


#: pieces that an array is cut into while it is added up, and how many partial sums meet in one task at first
PIECES = 16
FAN_IN = 16
ARRAY_SCHEMA = "piece int, part int, data binary"


def array_rows(array: np.ndarray, part: int) -> pa.RecordBatch:
    """An array as rows of ``ARRAY_SCHEMA``; ``part`` spreads the partial sums of different tasks over groups."""
    pieces = np.array_split(array, PIECES)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(PIECES), pa.int32()), pa.array([part] * PIECES, pa.int32()),
         pa.array([p.tobytes() for p in pieces], pa.binary())], names=["piece", "part", "data"])


def add_arrays(df: DataFrame, dtype, size: int, parts: int, bits: bool = False) -> np.ndarray:
    """Element-wise sum (or bitwise or) of the arrays that tasks emitted with :func:`array_rows`.

    The partial arrays meet in two steps of at most about sqrt(parts) per group, and only the final array, whose
    ``size`` is fixed by the caller, reaches the driver. An empty input gives zeros.
    """
    def total(rows: pa.Table) -> np.ndarray:
        acc = None
        for raw in rows.column("data"):
            a = np.frombuffer(raw.as_buffer(), dtype=dtype)
            if acc is None:
                acc = a.copy()
            elif bits:
                acc |= a
            else:
                acc += a
        return acc

    def some(rows: pa.Table) -> pa.Table:
        one = rows.slice(0, 1).select(["piece", "part"])
        return one.append_column("data", pa.array([total(rows).tobytes()], pa.binary()))

    groups = max(1, int(np.sqrt(max(1, parts))))
    first = (df.withColumn("part", F.pmod("part", F.lit(groups))).groupBy("piece", "part")
             .applyInArrow(some, ARRAY_SCHEMA))
    rows = first.groupBy("piece").applyInArrow(some, ARRAY_SCHEMA).collect()
    if not rows:
        return np.zeros(size, dtype=dtype)
    return np.concatenate([np.frombuffer(r["data"], dtype=dtype) for r in sorted(rows, key=lambda r: r["piece"])])


def task_number() -> int:
    from pyspark import TaskContext
    context = TaskContext.get()
    return context.partitionId() if context else 0


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_IMPORTABLE: set[str] = set()


def ensure_importable(spark: SparkSession) -> None:
    """Python tasks need this package. Where executors cannot import it (the session was not given it with
    ``--py-files`` or the like), ship the package's source files once per application."""
    app = spark.sparkContext.applicationId
    if app in _IMPORTABLE:
        return

    def probe(batches):
        import importlib.util
        found = importlib.util.find_spec("stratum") is not None
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([found])], names=["found"])

    probe.__module__ = "__main__"       # sent by value: the point is to find out whether the module is there
    if not spark.range(0, 1, 1, 1).mapInArrow(probe, "found boolean").first()[0]:
        import tempfile
        import zipfile
        from pathlib import Path

        import stratum
        root = Path(stratum.__file__).parent
        archive = f"{tempfile.mkdtemp(prefix='stratum-src-')}/stratum.zip"     # on the driver; Spark sends it out
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(root.rglob("*.py")):
                z.write(file, f"stratum/{file.relative_to(root)}")
        spark.sparkContext.addPyFile(archive)
    _IMPORTABLE.add(app)
