"""File scans and sinks: delimited text, run-record JSON, Parquet.

Paths are Hadoop URIs (``hdfs://``, ``s3a://``, ``file:``...).  Every sink
writes a directory of part files in parallel, one or more per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schemas
from ledgerlens.sources import record_store

# --- fixed values: text formats ----------------------------------------------
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType = schemas.ORDER_LINES, mode: str = "FAILFAST",
) -> DataFrame:
    """Header-row CSV with an explicit schema, bound by the header's names; an empty
    field is null.

    The first header line gives the order of the columns; columns that ``schema``
    does not name are skipped, and one that it names and the file lacks raises
    ``ValueError``.  A file of the folder with another header raises when it is read.
    ``mode`` says what a malformed row does: ``FAILFAST`` raises, ``PERMISSIVE`` nulls
    its bad fields, ``DROPMALFORMED`` drops it; ``malformed_rows`` counts them.
    """
    return _csv(spark, path, schema, mode).select(*schema.names)


def malformed_rows(spark: SparkSession, path: str, schema: T.StructType = schemas.ORDER_LINES) -> DataFrame:
    """One-row frame: rows of the file that do not parse under ``schema``."""
    rows = _csv(spark, path, schema, "PERMISSIVE", "_malformed")
    # every field takes part, so that no column is pruned from the parser
    return rows.agg(F.count(F.when(F.col("_malformed").isNotNull(), F.struct(*rows.columns))).alias("malformed_rows"))


def _csv(spark: SparkSession, path: str, schema: T.StructType, mode: str, corrupt: str | None = None) -> DataFrame:
    header = spark.read.option("header", True).csv(path).columns
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(header)}")
    bound = T.StructType([schema[name] if name in schema.names else T.StructField(name, T.StringType()) for name in header])
    if corrupt:
        bound = bound.add(corrupt, T.StringType())
    reader = (
        spark.read.schema(bound)
        .option("header", True)
        .option("enforceSchema", bool(corrupt))
        .option("mode", mode)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .option("timestampFormat", TIMESTAMP_FORMAT)
    )
    return (reader.option("columnNameOfCorruptRecord", corrupt) if corrupt else reader).csv(path)


def read_csv_inferred(
    spark: SparkSession, path: str, ntz: bool = True, sampling_ratio: float = 1.0,
) -> DataFrame:
    """Header-row CSV with inferred column types.

    Inference reads the input (or a ``sampling_ratio`` share of it) once more
    before the query runs; prefer ``read_csv`` with a schema for large inputs.
    Spark infers zone-aware ``timestamp``; with ``ntz`` those columns are read
    as wall-clock ``timestamp_ntz`` instead, like the rest of the library.  The
    file is parsed with the adjusted schema, so no session time zone is
    involved.
    """
    inferred = (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("samplingRatio", sampling_ratio)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )
    if not ntz:
        return inferred
    schema = T.StructType(
        [
            T.StructField(f.name, T.TimestampNTZType(), f.nullable)
            if isinstance(f.dataType, T.TimestampType)
            else f
            for f in inferred.schema.fields
        ]
    )
    return read_csv(spark, path, schema)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header-row CSV, no index column."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


def read_run_records(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Run records with the explicit record schema (``steps`` stays a map).

    ``multi_line`` reads one pretty-printed object per file, the job's own
    format; a glob such as ``dir/*.json`` unions any number of files.  Use
    ``multi_line=False`` for JSON-lines files such as ``write_run_records``
    output, of which the last committed version is read.  Files under
    ``experiment_id=...`` folders get the id from the path.
    """
    if not multi_line and record_store.exists(spark, path):
        return record_store.read(spark, path)
    records = spark.read.schema(schemas.RUN_RECORD).option("multiLine", multi_line).json(path)
    return records.select(*schemas.RUN_RECORD.names)


def _latest(records: DataFrame) -> DataFrame:
    """One record per id: the latest, of equal timestamps the longest, then the
    largest of the other fields, so that the choice is never arbitrary.  A missing
    timestamp is stamped with the present time."""
    stamped = records.withColumn(
        "timestamp",
        F.coalesce(F.col("timestamp"), F.date_format(F.current_timestamp(), TIMESTAMP_FORMAT)),
    )
    others = [c for c in stamped.columns if c != "experiment_id"]
    rank = F.struct("timestamp", "total_time_sec", "ram_start_mb", "ram_end_mb", "ram_delta_mb", F.to_json("steps"))
    return (
        stamped.groupBy("experiment_id")
        .agg(F.max_by(F.struct(*others), rank).alias("record"))
        .select("experiment_id", "record.*")
    )


def write_job_record(records: DataFrame, path: str) -> None:
    """The job's own record: one folder per experiment id, replaced when the id runs
    again.  For a handful of ids; ``write_run_records`` takes any number."""
    (
        _latest(records).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("experiment_id")
        .json(path)
    )


RECORD_BUCKETS = 64


def write_run_records(records: DataFrame, path: str, buckets: int = RECORD_BUCKETS) -> None:
    """Run records as JSON lines in ``buckets`` folders by a hash of the id; a record
    is replaced when its id is written again.

    Of several records for one id the latest is kept.  Only the buckets that
    ``records`` touches are rewritten, as new folders, and become visible at once with the
    commit of the next version (``record_store``): writers at the same time lose
    nothing, and readers see whole versions.  The folders do not grow with the ids;
    ``buckets`` must stay the same for a path.  Non-ASCII step names are written as UTF-8.
    """
    record_store.write(_latest(records.select(*schemas.RUN_RECORD.names)), path, buckets)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
