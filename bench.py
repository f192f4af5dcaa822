"""Bench: time every registered query and the full staged job on one sf directory.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is forced end to end with the ``noop`` sink (full computation, nothing collected). The full job runs
bronze -> silver -> quality_silver -> gold -> quality_gold -> catalog -> warehouse into a fresh scratch lake, with the
silver gate recording instead of raising (the stand-in data has order lines whose orders were quarantined); it runs
a second time with the order-keyed tables bucketed on order_id.
Prints one JSON line.
"""
from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:]]

    from stratum.plans.jobs import LakeJob
    from stratum.plans.registry import QUERIES
    from stratum.session import local_session
    from stratum.sources import standin
    from stratum.sources.tables import TableStore

    # Spark's event log (not the UI) records task metrics; it goes to a fresh scratch folder.
    event_dir = tempfile.mkdtemp(prefix="stratum-bench-events-")
    spark = local_session("stratum-bench", cores=cpus, shuffle_partitions=int(cpus) * 2, driver_memory="16g",
                          conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{event_dir}"})
    sc = spark.sparkContext
    # JVM, code-generation and file-system warm-up, not timed: the flagship query once on the smallest tables
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir):
        QUERIES["mart_daily_kpis"](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    job_sec = None
    if not only or "full_job" in only:
        root = tempfile.mkdtemp(prefix="stratum-bench-lake-")
        job = LakeJob(spark, TableStore(f"file://{root}"), sources=standin.sources(spark, sf_dir),
                      enforce_gates=("gold",))
        sc.setJobGroup("full_job", "full_job")
        t0 = time.perf_counter()
        job.run()
        job_sec = round(time.perf_counter() - t0, 3)

    bucketed_sec = None
    if not only or "full_job_bucketed" in only:
        # the same job with the order-keyed tables bucketed on order_id (co-located gold joins)
        root = tempfile.mkdtemp(prefix="stratum-bench-lake-")
        job = LakeJob(spark, TableStore(f"file://{root}", database="bench_lake"), enforce_gates=("gold",),
                      sources=standin.sources(spark, sf_dir), buckets=int(cpus) * 2,
                      schemas=("gold_bucketed", "analytics_bucketed"))
        sc.setJobGroup("full_job_bucketed", "full_job_bucketed")
        t0 = time.perf_counter()
        job.run()
        bucketed_sec = round(time.perf_counter() - t0, 3)
    spark.stop()

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "full_job_sec": job_sec, "full_job_bucketed_sec": bucketed_sec,
           "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
           "per_query_metrics": event_metrics(event_dir)}
    print(json.dumps(out))


def _open_log(path: str):
    """Event-log files are zstd-compressed by default (rolling logs in Spark 4)."""
    if path.endswith(".zstd"):
        import io

        import zstandard
        raw = open(path, "rb")
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw, closefd=True), encoding="utf-8")
    return open(path, encoding="utf-8")


def event_metrics(event_dir: str) -> dict:
    """Per job group: shuffle MB written, task seconds, stages and tasks, summed from the event log."""
    stage_group, out = {}, {}
    for path in sorted(os.path.join(d, f) for d, _, files in os.walk(event_dir) for f in files
                       if f.startswith("events_") or f.startswith("local-")):
        with _open_log(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    if not group:
                        continue
                    m = ev.get("Task Metrics") or {}
                    agg = out.setdefault(group, {"shuffle_mb": 0.0, "task_sec": 0.0, "tasks": 0, "stages": set()})
                    agg["shuffle_mb"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0) / 2**20
                    agg["task_sec"] += m.get("Executor Run Time", 0) / 1000
                    agg["tasks"] += 1
                    agg["stages"].add(ev.get("Stage ID"))
    return {g: {"shuffle_mb": round(a["shuffle_mb"], 2), "task_sec": round(a["task_sec"], 2), "tasks": a["tasks"],
                "stages": len(a["stages"])} for g, a in out.items()}


if __name__ == "__main__":
    main()
