"""Tuned job: share one pruned input between the reports, if it fits.

``sharing`` decides from sizes, before anything runs:

* the bytes that the asked columns are estimated to take as cached rows are compared
  with the storage memory that the executors have free.  If they fit, the input
  is persisted; otherwise each report scans the source again;
* a persisted input is dealt out evenly when its scan's partitions are far from
  ``partition_bytes`` each: one huge file split is one task for every report.

Differences from a naive ``df.cache()`` of the raw input: only the columns that the
reports read are kept, the source is read once (the rating mean comes from
the cache too), and the same handle that was persisted is released.  For columnar
sources a re-scan is often cheaper than filling a cache; see ``single_pass`` for a plan that
needs neither.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ledgerlens import constants as C
from ledgerlens.operators.clean import impute_mean
from ledgerlens.operators.summaries import category_summary, express_by_region, row_count
from ledgerlens.session import checkpoint_root

REPORT_COLUMNS = {
    "row_count": (),
    "category_summary": ("order_id", "product_category", "quantity", "customer_rating", "total_amount"),
    "express_by_region": ("order_id", "delivery_region", "is_express", "total_amount"),
}
PARTITION_BYTES = 128 << 20


#: Cached rows take about so many times the bytes of the scanned file.
EXPANSION = 3.0
#: The share of the free storage memory that one input may take.
MEMORY_SHARE = 0.5


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the frame's size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def repartition_for(df: DataFrame, partition_bytes: int = PARTITION_BYTES) -> int:
    """A partition count for ``TunedReports``: the input's estimated bytes over ``partition_bytes``."""
    return max(1, -(-estimated_bytes(df) // partition_bytes))


def free_storage_bytes(spark: SparkSession) -> int:
    """Storage memory that is free on the executors (in local mode, on the driver)."""
    status = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator()
    free = []
    while status.hasNext():
        free.append(int(status.next()._2()))
    # the driver's block manager is listed too: leave out the largest, which errs on the safe side
    return sum(free) - max(free) if len(free) > 1 else sum(free)


@dataclass(frozen=True)
class Sharing:
    """What to do with an input that several reports read."""
    persist: bool
    partitions: int | None
    cached_bytes: int
    free_bytes: int


def sharing(df: DataFrame, partition_bytes: int = PARTITION_BYTES, free_bytes: int | None = None,
            expansion: float = EXPANSION, memory_share: float = MEMORY_SHARE) -> Sharing:
    """Persist if the estimated cached bytes fit, with a repartition if the scan's partitions
    are more than twice or less than half as many as the bytes ask for."""
    free = free_storage_bytes(df.sparkSession) if free_bytes is None else free_bytes
    cached = int(estimated_bytes(df) * expansion)
    if cached > free * memory_share:
        return Sharing(False, None, cached, free)
    wanted = repartition_for(df, partition_bytes)
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return Sharing(True, None, cached, free)  # its partitions are sized when it runs
    have = df._jdf.toJavaRDD().getNumPartitions()
    fits = have <= 2 * wanted and wanted <= 2 * have
    return Sharing(True, None if fits else wanted, cached, free)


def pruned(df: DataFrame, reports: Sequence[str]) -> DataFrame:
    """The columns that the reports read."""
    needed = {c for name in reports for c in REPORT_COLUMNS[name]}
    return df.select(*(c for c in df.columns if c in needed))


class TunedReports:
    """Context manager holding the pruned input, persisted if several reports share it
    and ``rule`` (see ``sharing``), if given, allows it."""

    def __init__(
        self,
        df: DataFrame,
        threshold: float = C.EXPRESS_AMOUNT_THRESHOLD,
        repartition: int | None = None,
        storage_level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
        reports: Sequence[str] = tuple(REPORT_COLUMNS),
        rule: Sharing | None = None,
    ) -> None:
        shared = pruned(df, reports)
        partitions = repartition or (rule.partitions if rule else None)
        if partitions:
            shared = shared.repartition(partitions)
        persist = len(reports) > 1 and (rule is None or rule.persist)
        self.shared = shared.persist(storage_level) if persist else shared
        if "row_count" in reports:
            self.row_count = row_count(self.shared)
        if "category_summary" in reports:
            self.category_summary = category_summary(impute_mean(self.shared, "customer_rating"))
        if "express_by_region" in reports:  # reads no rating, so nothing is imputed
            self.express_by_region = express_by_region(self.shared, threshold)

    def close(self) -> None:
        self.shared.unpersist()

    def __enter__(self) -> TunedReports:
        return self

    def __exit__(self, *exc) -> None:
        self.close()


SHARED = ("category_summary", "express_by_region")


def tuned_reports(
    df: DataFrame,
    threshold: float = C.EXPRESS_AMOUNT_THRESHOLD,
    repartition: int | None = None,
    partition_bytes: int = PARTITION_BYTES,
    free_bytes: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Both reports computed from one input, shared as ``sharing`` decides, then released.

    The reports are checkpointed (written to the shared checkpoint folder,
    lineage cut) before the cache is dropped, so they stay readable, and they
    survive executor loss.
    """
    checkpoint_root(df.sparkSession)
    rule = sharing(pruned(df, SHARED), partition_bytes, free_bytes)
    with TunedReports(df, threshold, repartition, reports=SHARED, rule=rule) as t:
        summary = t.category_summary.checkpoint(eager=True)
        express = t.express_by_region.checkpoint(eager=True)
    return summary, express


def tuned_report(
    df: DataFrame,
    name: str,
    threshold: float = C.EXPRESS_AMOUNT_THRESHOLD,
    repartition: int | None = None,
    partition_bytes: int = PARTITION_BYTES,
) -> DataFrame:
    """One report of the tuned job (``category_summary`` or ``express_by_region``): the whole
    job runs, both reports from the shared input, and the other one is left."""
    reports = dict(zip(SHARED, tuned_reports(df, threshold, repartition, partition_bytes), strict=True))
    return reports[name]
