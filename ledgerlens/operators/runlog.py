"""Run-record analytics: step tables, running offsets, totals and speedups.

Works on a *long* run log, one row per (run, step):
``run_id, config, step, step_pos, secs``.  ``config`` keys the configuration
lookup; for the job's own run records run_id, config and experiment_id agree.
All operators are grouped aggregates, windows or joins, so they work for any
number of runs.  Where a run's rows are collected or ordered, repeated (run, step)
rows are summed first, so that its group holds one row per step and no group grows
with the raw data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import constants as C
from ledgerlens.functions.money import money_sum, parts, stored_parts, total
from ledgerlens.functions.ordering import list_position
from ledgerlens.session import scratch_path
from ledgerlens.sources.tables import run_meta


# --- run records (nested) <-> long log ----------------------------------------

def records_from_log(log: DataFrame, run: str = "run_id", pre_aggregated: bool = False) -> DataFrame:
    """One nested record per run: ``steps`` map in step order and the total.

    Repeated (run, step) rows are first summed (partial aggregation before the
    shuffle, so a run holding a large share of a raw log is reduced inside each
    task).  ``pre_aggregated=True`` skips that for a log that is known to hold one
    row per (run, step), as ``sources.tables.run_log`` produces.
    """
    if not pre_aggregated:
        log = aggregate_steps(log, run)
    entries = F.array_sort(F.collect_list(F.struct("step_pos", "step", "secs")))
    return log.groupBy(F.col(run).alias("experiment_id")).agg(
        money_sum("secs").alias("total_time_sec"),
        F.lit(None).cast("double").alias("ram_start_mb"),
        F.lit(None).cast("double").alias("ram_end_mb"),
        F.lit(None).cast("double").alias("ram_delta_mb"),
        F.map_from_entries(F.transform(entries, lambda e: F.struct(e["step"], e["secs"]))).alias("steps"),
        F.lit(None).cast("string").alias("timestamp"),
    )


def first_record_steps(records: DataFrame, order: Sequence[str] = tuple(C.RUN_ORDER)) -> list[str]:
    """Step names of the first record in ``order``, as a chart's step list.

    Returns a short list of column names for ``step_pivot`` (a pivot's columns
    must be known before the query runs); only one row reaches the driver.
    """
    first = (
        with_custom_order(records, "experiment_id", order)
        .orderBy("sort_key", "experiment_id")
        .select(F.map_keys("steps").alias("keys"))
        .first()
    )
    return list(first.keys) if first and first.keys else []


def steps_long(records: DataFrame) -> DataFrame:
    """Records -> long log; ``step_pos`` is the step's position in its record."""
    return records.select(
        F.col("experiment_id").alias("run_id"),
        F.col("experiment_id").alias("config"),
        F.posexplode("steps").alias("pos", "step", "secs"),
    ).select("run_id", "config", "step", (F.col("pos") + 1).cast("int").alias("step_pos"), "secs")


def record_summary(records: DataFrame) -> DataFrame:
    """Per record: total seconds (2 dp) and RAM growth: the stored one, which was taken
    before the readings were rounded, else their difference (1 dp)."""
    return records.select(
        "experiment_id",
        F.round("total_time_sec", 2).alias("total_time_sec"),
        F.round("ram_start_mb", 1).alias("ram_start_mb"),
        F.round("ram_end_mb", 1).alias("ram_end_mb"),
        F.coalesce(F.col("ram_delta_mb"), F.round(F.col("ram_end_mb") - F.col("ram_start_mb"), 1)).alias("ram_delta_mb"),
        F.size("steps").alias("n_steps"),
    )


# --- ordering and lookup -------------------------------------------------------

def with_custom_order(
    df: DataFrame, key: str = "config", order: Sequence[str] = tuple(C.RUN_ORDER),
    unknown: int = C.RUN_UNKNOWN_POS, alias: str = "sort_key",
) -> DataFrame:
    """Adds the position of ``key`` in ``order`` (``unknown`` if absent) as a sort key."""
    return df.withColumn(alias, list_position(key, list(order), unknown))


def _lookup(runs: DataFrame, meta: DataFrame | None) -> DataFrame:
    """The lookup side: the built-in table (4 rows, broadcast) unless one is given;
    for that AQE picks the join from its size."""
    return F.broadcast(run_meta(runs.sparkSession)) if meta is None else meta


def enrich(
    runs: DataFrame, meta: DataFrame | None = None, key: str = "config", strict: bool = False,
) -> DataFrame:
    """Left join of the configuration lookup; unknown keys keep null labels.

    With ``strict`` an unknown key raises ``LookupError`` (this runs one job, which
    stops at the first few unknown keys).
    """
    side = _lookup(runs, meta)
    if strict:
        unknown = [r[0] for r in runs.join(side, key, "left_anti").select(key).limit(5).collect()]
        if unknown:
            raise LookupError(f"not in the lookup: {unknown}")
    return runs.join(side, key, "left")


def unknown_configs(
    runs: DataFrame, meta: DataFrame | None = None, key: str = "config", run: str = "run_id",
) -> DataFrame:
    """Runs whose configuration is missing from the lookup (anti join)."""
    return runs.join(_lookup(runs, meta), key, "left_anti").select(run, key).distinct()


# --- step tables ------------------------------------------------------------------

#: Steps that a pivot shows as columns at most.
PIVOT_STEPS = 1000


def all_steps(log: DataFrame) -> list[str]:
    """The distinct step names, by their first position and then by name.

    A pivot's columns must be known before the query runs, so the names (one row per
    step after partial aggregation) pass through the driver.  More than ``PIVOT_STEPS`` raise
    ``ValueError``: ``step_blocks`` takes any number.
    """
    rows = log.where(F.col("step").isNotNull()).groupBy("step").agg(F.min("step_pos").alias("first")).limit(PIVOT_STEPS + 1).collect()
    if len(rows) > PIVOT_STEPS:
        raise ValueError(f"more than {PIVOT_STEPS} steps: use step_blocks")
    return [r.step for r in sorted(rows, key=lambda r: (r.first is None, r.first, r.step))]


def step_pivot(log: DataFrame, steps: Sequence[str] | None = None, run: str = "run_id", scale: int = 2) -> DataFrame:
    """Run x step matrix of seconds; a missing step is 0.

    Written as one conditional aggregate per step: one shuffle with map-side
    partial sums, for any number of runs.  The columns are all distinct steps;
    ``steps`` fixes others (those of the first record reproduce a chart's step list).
    """
    steps = all_steps(log) if steps is None else steps
    if not steps:
        return log.select(run).distinct()
    secs = parts("secs", scale)

    def seconds(step: str) -> Column:
        own = F.col("step") == F.lit(step)
        return F.coalesce(total(secs.map(lambda part: F.sum(F.when(own, part))), scale), F.lit(0.0))

    cols = [seconds(s).alias(s) for s in steps]
    return log.groupBy(run).agg(*cols)


# --- step tables of any width: blocks of a numbered dictionary -----------------------

BLOCK_WIDTH = 100


def step_dictionary(log: DataFrame, width: int = BLOCK_WIDTH, partitions: int | None = None) -> DataFrame:
    """All steps numbered by their first position and then by name: ``step, place, block, slot``.

    Names never pass through the driver or one task: they are range-partitioned and
    written, numbered inside each part, and each part starts from the rows of those before.
    """
    names = log.where(F.col("step").isNotNull()).groupBy("step").agg(F.min("step_pos").alias("first"))
    order = [F.col("first").asc_nulls_last(), F.col("step")]
    dealt = names.repartitionByRange(partitions, *order) if partitions else names.repartitionByRange(*order)
    path = scratch_path(log.sparkSession, "steps")
    dealt.withColumn("part", F.spark_partition_id()).write.parquet(path)
    dealt = log.sparkSession.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    start = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("part").orderBy(*order)
    place = F.col("start") + F.row_number().over(within) - 1
    return (dealt.join(start, "part").select("step", place.alias("place"))
            .select("step", "place", F.expr(f"place div {width}").alias("block"), (F.col("place") % width).cast("int").alias("slot")))


def step_blocks(log: DataFrame, dictionary: DataFrame, width: int = BLOCK_WIDTH, run: str = "run_id", scale: int = 2) -> DataFrame:
    """Sparse run x step matrix for any number of steps: ``run, block, secs``.

    ``secs`` has the seconds of the block's ``width`` slots, 0 for a missing step; a run has rows
    of those blocks only that hold one of its steps.  Repeated (run, step) rows are summed
    before the join with ``dictionary`` (``step_dictionary``), so a step of every run meets one
    row a run.
    """
    cells = log.where(F.col("step").isNotNull()).groupBy(run, "step").agg(money_sum("secs", scale).alias("secs"))
    cells = cells.join(dictionary.select("step", "block", "slot"), "step")
    held = F.map_from_entries(F.collect_list(F.struct("slot", F.coalesce("secs", F.lit(0.0)))))  # at most ``width``
    slots = F.sequence(F.lit(0), F.lit(width - 1))
    return cells.groupBy(run, "block").agg(held.alias("held")).select(
        run, "block", F.transform(slots, lambda i: F.coalesce(F.try_element_at("held", i), F.lit(0.0))).alias("secs"))


def block_table(blocks: DataFrame, dictionary: DataFrame, block: int, run: str = "run_id") -> DataFrame:
    """One block as a table with a column per step: at most ``width`` names reach the driver."""
    names = dictionary.where(F.col("block") == block).select("step", "slot").collect()
    own = blocks.where(F.col("block") == block)
    return own.select(run, *(F.col("secs")[r.slot].alias(r.step) for r in sorted(names, key=lambda r: r.slot)))


def aggregate_steps(log: DataFrame, run: str = "run_id", key: str = "config", scale: int = 2) -> DataFrame:
    """One row per (run, step): sum of repeated rows, earliest position.

    Partial aggregation runs before the shuffle, so even a run that holds a
    large share of a raw log leaves each task as one row per step.
    """
    return log.groupBy(run, key, "step").agg(
        F.min("step_pos").alias("step_pos"), money_sum("secs", scale).alias("secs"))


def stack_offsets(
    log: DataFrame, run: str = "run_id", pos: str = "step_pos", pre_aggregated: bool = False,
    scale: int = 2,
) -> DataFrame:
    """Adds ``offset``: the sum of the run's earlier steps (0 for the first).

    The window partitions by run, so repeated (run, step) rows are first summed with
    ``aggregate_steps``; ``pre_aggregated=True`` skips that for a log that is known
    to hold one row per (run, step).
    """
    if not pre_aggregated:
        log = aggregate_steps(log, run, scale=scale)
    w = (
        Window.partitionBy(run)
        .orderBy(F.col(pos), F.col("step"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = total(parts("secs", scale).map(lambda c: F.sum(c).over(w)), scale)
    return log.withColumn("offset", F.coalesce(earlier, F.lit(0.0)))


def long_offsets(
    log: DataFrame, run: str = "run_id", pos: str = "step_pos", pre_aggregated: bool = False,
    scale: int = 2, partitions: int | None = None,
) -> DataFrame:
    """``stack_offsets`` for runs of any length: prefix sums on two levels.

    The steps are range-partitioned by run and position, so that a run may span many
    partitions, and written once.  The sums of each (run, partition), one row each, give
    what every partition of a run starts from; inside a partition a window adds up
    the rest.  Only the table of sums has all of a run in one task.

    Rows of a null run form a run, as in ``stack_offsets``.  ``partitions`` defaults to
    the session's shuffle partitions, which AQE merges where they are small.
    """
    if not pre_aggregated:
        log = aggregate_steps(log, run, scale=scale)
    spark, columns = log.sparkSession, log.columns
    order = [F.col(run), F.col(pos), F.col("step")]
    dealt = log.repartitionByRange(partitions, *order) if partitions else log.repartitionByRange(*order)
    path = scratch_path(spark, "steps")
    dealt.withColumn("_part", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)

    secs = parts("secs", scale)
    sums = dealt.groupBy(F.col(run).alias("_run"), "_part").agg(*secs.map(F.sum).columns("sum"))
    before = Window.partitionBy("_run").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = sums.select("_run", "_part", *stored_parts("sum").map(lambda c: F.sum(c).over(before)).columns("start"))
    joined = dealt.join(start.withColumnRenamed("_part", "_start_part"),
                        F.col(run).eqNullSafe(F.col("_run")) & (F.col("_part") == F.col("_start_part")))
    within = Window.partitionBy(run, "_part").orderBy(F.col(pos), F.col("step")).rowsBetween(Window.unboundedPreceding, -1)

    def added(a: Column, b: Column) -> Column:
        return F.coalesce(a + b, a, b)

    earlier = stored_parts("start").with_parts(secs.map(lambda c: F.sum(c).over(within)), added)
    return joined.withColumn("offset", F.coalesce(total(earlier, scale), F.lit(0.0))).select(*columns, "offset")


def visible_steps(log: DataFrame, min_secs: float = C.STEP_LABEL_MIN_SECS) -> DataFrame:
    """Steps long enough to carry a label: ``secs > min_secs``."""
    return log.filter(F.col("secs") > F.lit(min_secs))


# --- totals and speedups ------------------------------------------------------------

def run_totals(log: DataFrame, run: str = "run_id", key: str = "config", scale: int = 2) -> DataFrame:
    """Per run: total seconds and number of steps."""
    return log.groupBy(run, key).agg(
        money_sum("secs", scale).alias("total_time_sec"), F.count(F.lit(1)).alias("n_steps")
    )


def config_totals(log: DataFrame, key: str = "config", scale: int = 2) -> DataFrame:
    """Per configuration: total seconds over all its runs and steps."""
    return log.groupBy(key).agg(money_sum("secs", scale).alias("total_secs"))


def speedups(
    totals: DataFrame, pairs: DataFrame, key: str = "config", value: str = "total_secs",
) -> DataFrame:
    """``base / other`` for every (pair, base_config, other_config) of ``pairs``.

    A missing configuration or a zero denominator gives null (``try_divide``).
    """
    base = totals.select(F.col(key).alias("base_config"), F.col(value).alias("base_total"))
    other = totals.select(F.col(key).alias("other_config"), F.col(value).alias("other_total"))
    return (
        pairs.join(base, "base_config", "left")
        .join(other, "other_config", "left")
        .select(
            "pair", "base_config", "other_config", "base_total", "other_total",
            F.try_divide(F.col("base_total"), F.col("other_total")).alias("speedup"),
        )
    )
