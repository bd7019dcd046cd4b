"""Order reports over a folder that keeps receiving order-line files.

The job's inputs arrive as files in a landing folder.  Instead of re-running
the whole job for every new file, a Structured Streaming query keeps the
per-(category, region) statistics of ``plans.single_pass.order_stats`` as
state: each micro-batch reads only the new files and merges their partial
aggregates into the state store.  The state holds one row per
(category, region), whatever the input size.  After each micro-batch the
complete statistics table is turned into the reports (mean, imputed average
rating, both summaries) and written to a folder of its epoch; a marker written
last makes that epoch the one ``latest_report`` reads, so that readers see whole
epochs only, also after a failure between the writes.  The streaming checkpoint
makes progress and state survive driver or executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlens import constants as C
from ledgerlens import schemas
from ledgerlens.plans.single_pass import order_stats, reports_from_stats
from ledgerlens.session import scratch_path


def order_stats_stream(
    spark: SparkSession,
    source_dir: str,
    threshold: float = C.EXPRESS_AMOUNT_THRESHOLD,
    schema: T.StructType = schemas.ORDER_LINES,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming statistics table over the files of ``source_dir``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return order_stats(reader.load(source_dir), threshold)


def _publish(output_dir: str):
    def write(batch: DataFrame, epoch_id: int) -> None:
        # The complete statistics table: a few rows, read by three reports.
        stats = batch.persist()
        try:
            count, summary, express = reports_from_stats(stats)
            for name, report in (("row_count", count), ("category_summary", summary),
                                 ("express_by_region", express)):
                report.write.mode("overwrite").parquet(f"{output_dir}/epoch-{epoch_id}/{name}")
            marker = batch.sparkSession.createDataFrame([(epoch_id,)], "epoch long")
            marker.write.mode("append").parquet(f"{output_dir}/complete")
        finally:
            stats.unpersist()
    return write


def latest_report(spark: SparkSession, output_dir: str, name: str) -> DataFrame:
    """``row_count``, ``category_summary`` or ``express_by_region`` of the last whole epoch."""
    epoch = spark.read.parquet(f"{output_dir}/complete").agg(F.max("epoch").alias("epoch")).first().epoch
    return spark.read.parquet(f"{output_dir}/epoch-{epoch}/{name}")


def start_order_reports(
    spark: SparkSession,
    source_dir: str,
    output_dir: str,
    threshold: float = C.EXPRESS_AMOUNT_THRESHOLD,
    checkpoint_location: str | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    **source_options,
) -> StreamingQuery:
    """Start the query; ``latest_report(spark, output_dir, name)`` reads its reports.

    ``available_now`` processes what is in the folder and stops (a catch-up
    run); otherwise micro-batches run every ``processing_time``.  Pass a
    stable ``checkpoint_location`` on shared storage to resume after a restart
    with only the new files; without one, a fresh folder below the session's
    checkpoint directory is used, so every start re-reads the whole folder.
    """
    stats = order_stats_stream(spark, source_dir, threshold, **source_options)
    writer = (
        stats.writeStream.outputMode("complete")
        .foreachBatch(_publish(output_dir))
        .option("checkpointLocation", checkpoint_location or scratch_path(spark, "order-reports-stream"))
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
