"""Session helpers.

The library never owns a global session: every operator takes DataFrames, and jobs take the caller's
``SparkSession``. ``local_session`` exists for tests, the bench and the smoke entry only.
"""
from __future__ import annotations

import os
import sys
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. AQE stays on so shuffle partitions coalesce at run time, skewed join
# partitions are split, and small join sides are broadcast only after their real size is measured.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(app: str = "stratum", cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", conf: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and benches (UI off, UTC, AQE on)."""
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="stratum-warehouse-")))
    for k, v in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Target bytes per shuffle partition and per file split: large enough to keep task overhead low, small enough that a
# partition sorts and aggregates in executor memory without heavy spilling.
TARGET_PARTITION_BYTES = 256 * 2**20


def cluster_settings(input_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Runtime SQL settings sized for ``input_bytes`` of input (e.g. 100 TB on a large cluster).

    The initial shuffle partition count covers the whole input at ``target_bytes`` per partition (shuffles carry at
    most about the input after pruning), and AQE coalesces it down to the advisory size per stage and splits
    skewed partitions; scans split files at the same size. Window state for streams goes to RocksDB so large state
    lives off-heap (set before the first stream of the session starts).
    """
    partitions = max(200, -(-input_bytes // target_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_bytes),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def apply_settings(spark: SparkSession, settings: dict[str, str], override: bool = False) -> dict[str, str]:
    """Set each value unless the session already sets it (cluster settings win unless ``override``). A partition
    count that the session sets also keeps AQE's initial count, which would take its place, unset."""
    applied = {}
    own_count = not override and spark.conf.get("spark.sql.shuffle.partitions", None) not in (None, "")
    for k, v in settings.items():
        if own_count and k == "spark.sql.adaptive.coalescePartitions.initialPartitionNum":
            continue
        if override or spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
            applied[k] = v
    return applied


def require_utc(spark: SparkSession) -> None:
    """Date keys and window bounds are computed in the session zone; the contracts assume UTC."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    if tz not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"stratum needs spark.sql.session.timeZone=UTC, the session has {tz!r}")


def sibling_session(spark: SparkSession) -> SparkSession:
    """Another session over the same context and catalog, with the caller's runtime settings but its own temporary
    views."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``; we only read it. A private
    scratch folder is set only when nothing is configured (local tests and benches).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext; the server owns checkpoints
        if configured:
            return configured
        _require_local(spark.conf.get("spark.master", ""))
        if "dir" not in _LOCAL_SCRATCH:
            _LOCAL_SCRATCH["dir"] = tempfile.mkdtemp(prefix="stratum-ckpt-")
        return _LOCAL_SCRATCH["dir"]
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    _require_local(sc.master)
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="stratum-ckpt-"))
    return sc.getCheckpointDir()


def _require_local(master: str) -> None:
    """A machine-local scratch folder is only right when driver and executors share the machine."""
    if not (master or "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: checkpoints, materialised tables and "
                           "stream scratch space must be visible to every executor")


_LOCAL_SCRATCH: dict[str, str] = {}


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the session's checkpoint directory (shared storage on a cluster), never reused."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stratum-{tag}-{uuid.uuid4().hex}"
