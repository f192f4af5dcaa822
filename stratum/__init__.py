"""stratum — governed lakehouse operators on Spark.

Contracts, strict ingestion, rule-based quarantine, deterministic de-duplication, data-quality suites with a
blocking gate, star-schema modelling, masked analyst views, a catalog with lineage and PII tags, and watermarked
hourly windows on Structured Streaming. Everything is DataFrame / Spark SQL / Structured Streaming over tables the
caller supplies; nothing is collected to the driver except bounded metadata (check results, row counts).

    from stratum import LakeJob, TableStore
    LakeJob(spark, TableStore("s3a://bucket/lake"), raw_dir="s3a://bucket/raw").run()
"""

from .contracts import SOURCES, Contract
from .operators.quality import QualityError
from .plans.jobs import STAGES, LakeJob
from .sources.tables import TableStore

__all__ = ["SOURCES", "STAGES", "Contract", "LakeJob", "QualityError", "TableStore"]
