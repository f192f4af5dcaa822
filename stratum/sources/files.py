"""File sources and sinks.

``read_contract_csv`` reads a CSV with the contract schema, never inferred. Modes:

* ``strict`` (default): the header must match the contract (``enforceSchema=false`` rejects a re-ordered,
  missing or extra column); rows with unparsable values or too few fields are kept whole in ``_corrupt_record``
  so they can be quarantined instead of silently becoming NULLs;
* ``failfast``: header checked and the first bad row aborts the read;
* ``permissive``: read by position, bad values become NULL (the lenient behaviour, for exploration only).

``multi_line`` allows quoted fields with embedded newlines; such files cannot be split, so each file is one task. By
default the contract says whether a source needs it (those with free text); the other files are split across tasks, and
a newline in one of their fields makes malformed rows, which strict mode keeps for the quarantine (permissive mode,
which has nowhere to keep them, allows newlines in every source).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import Contract

CORRUPT = "_corrupt_record"
R_MALFORMED = "malformed row"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"       # read: seconds, fraction optional
WRITE_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"    # write: never drop fractional seconds
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _reader(spark: SparkSession, multi_line: bool):
    return (spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
            .option("timestampFormat", TIMESTAMP_FORMAT).option("encoding", "UTF-8"))


def read_contract_csv(spark: SparkSession, contract: Contract, path: str, mode: str = "strict",
                      multi_line: bool | None = None, metadata: bool = True) -> DataFrame:
    """S1/S2 (+S3/S4 when ``metadata``): a contract-typed frame from CSV."""
    # the lenient reader keeps no malformed rows: a newline that it was not told of would garble values unseen
    reader = _reader(spark, contract.multi_line or mode == "permissive" if multi_line is None else multi_line)
    schema = contract.schema
    if mode == "strict":
        schema = f"{schema}, {CORRUPT} STRING"
        # no pruning: whether a row is malformed must not depend on the columns that a query happens to need
        reader = (reader.option("enforceSchema", False).option("mode", "PERMISSIVE").option("columnPruning", False)
                  .option("columnNameOfCorruptRecord", CORRUPT))
    elif mode == "failfast":
        reader = reader.option("enforceSchema", False).option("mode", "FAILFAST")
    elif mode == "permissive":
        reader = reader.option("mode", "PERMISSIVE")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    df = reader.schema(schema).csv(path)
    return with_ingest_metadata(df) if metadata else df


def with_ingest_metadata(df: DataFrame) -> DataFrame:
    """The file each row came from (per row, multi-file safe) and the ingestion time."""
    return df.withColumns({"_source_file": F.col("_metadata.file_name"), "_ingested_at": F.current_timestamp()})


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows without the corrupt column, malformed rows with reason 'malformed row').

    Spark refuses a raw CSV/JSON scan whose only referenced column is the corrupt-record column (a pruned
    ``count()`` of either branch would be one), so both filters also reference the first data column. Jobs split the *bronze Parquet* copy instead, so the CSV is parsed once.
    """
    if CORRUPT not in df.columns:
        return df, df.limit(0).withColumn("_reject_reason", F.lit(R_MALFORMED))
    first = next(c for c in df.columns if c != CORRUPT)
    good = (df.filter(F.col(CORRUPT).isNull() & F.concat(F.col(CORRUPT), F.col(first).cast("string")).isNull())
            .drop(CORRUPT))
    bad = (df.filter(F.col(CORRUPT).isNotNull() & F.coalesce(F.col(CORRUPT), F.col(first).cast("string")).isNotNull())
           .withColumn("_reject_reason", F.lit(R_MALFORMED)))
    return good, bad


def read_raw_strings(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Every column as text, empty fields kept as empty strings, a UTF-8 byte-order mark dropped."""
    df = (_reader(spark, multi_line).option("inferSchema", False).option("nullValue", "\u0000")
          .csv(path))
    renamed = {c: c.lstrip("﻿") for c in df.columns if c.startswith("﻿")}
    df = df.withColumnsRenamed(renamed) if renamed else df
    # the parser yields NULL for an empty unquoted field; text-only reads keep it as ''
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line; values written as they are (Spark's writer trims spaces unless told not to)
    and timestamps with their fractional seconds."""
    (df.write.mode(mode).option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("timestampFormat", WRITE_TIMESTAMP_FORMAT).csv(path))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """newline-delimited JSON, timestamps with their fractional seconds and zone."""
    df.write.mode(mode).option("timestampFormat", JSON_TIMESTAMP_FORMAT).json(path)
