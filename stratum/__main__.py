"""Run the batch job, or selected stages.

    python -m stratum --lake file:///data/lake --raw file:///data/raw [stage ...]
    python -m stratum --lake file:///data/lake --tables /root/testdata/sf0.1 [stage ...]

``--raw`` ingests the contract CSV files; ``--tables`` derives the sources from the TPC-H-style test tables.
Prints the run summary as JSON. On a cluster, submit with spark-submit so the session comes from the cluster.
"""
from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .plans.jobs import STAGES, LakeJob
from .session import SESSION_DEFAULTS, apply_settings, cluster_settings
from .sources import standin
from .sources.tables import TableStore


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(prog="stratum")
    ap.add_argument("--lake", required=True, help="lake root URI")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw", help="folder with the contract CSV files")
    src.add_argument("--tables", help="folder with the TPC-H-style parquet tables (stand-in sources)")
    ap.add_argument("--csv-mode", default="strict", choices=["strict", "failfast", "permissive"])
    ap.add_argument("--partition-facts", action="store_true")
    ap.add_argument("--input-gb", type=float, help="size the shuffle and scan partitions for this much input")
    ap.add_argument("--database", help="catalog database for bucketed tables (needs a shared metastore across runs)")
    ap.add_argument("--buckets", type=int, help="bucket the order-keyed tables on order_id (needs --database)")
    ap.add_argument("--schemas", default="gold,analytics", metavar="TABLES,VIEWS",
                    help="catalog schemas that the warehouse stage publishes to")
    ap.add_argument("--raw-file", action="append", default=[], metavar="SOURCE=FILE",
                    help="file name of a source under --raw (default <source>.csv); repeat per source")
    ap.add_argument("--csv-newlines", default="contract", choices=["contract", "all", "none"],
                    help="sources whose quoted fields may hold newlines (such files are read by one task each)")
    ap.add_argument("--single-line-csv", dest="csv_newlines", action="store_const", const="none",
                    help="the same as --csv-newlines none")
    ap.add_argument("stages", nargs="*", default=list(STAGES))
    args = ap.parse_args(argv)

    builder = SparkSession.builder.appName("stratum")
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if args.input_gb:
        apply_settings(spark, cluster_settings(int(args.input_gb * 2**30)))
    raw_files = dict(item.split("=", 1) for item in args.raw_file)
    job = LakeJob(spark, TableStore(args.lake, database=args.database), raw_dir=args.raw, buckets=args.buckets,
                  raw_files=raw_files or None, csv_multi_line={"contract": None, "all": True, "none": False}[args.csv_newlines],
                  sources=standin.sources(spark, args.tables) if args.tables else None,
                  csv_mode=args.csv_mode, partition_facts=args.partition_facts,
                  schemas=tuple(args.schemas.split(",", 1)))
    summary = job.run(args.stages)
    print(json.dumps(summary, indent=1, default=str))
    return summary


if __name__ == "__main__":
    main()
