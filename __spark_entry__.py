"""

``entry(spark)`` runs the flagship report on sf0.001.  ``queries()`` maps a
``oracle_sql()`` gives the same query in DuckDB SQL over the raw test tables.
Every query reads the whole test tables; round-trip queries write to a fresh
folder below the session's shared checkpoint directory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import constants as C
from ledgerlens.operators import clean, filters, profile, runlog, summaries
from ledgerlens.plans import single_pass_reports, tuned_report
from ledgerlens.session import scratch_path
from ledgerlens.sources import files, generate, inference, tables
from tools import oracle_sql as order_sql

try:
    import corpus_pipeline
    from ledgerlens.llm import queries as corpus
except ModuleNotFoundError as error:  # the corpus operators can be left out
    if error.name not in ("corpus_pipeline", "ledgerlens.llm"):
        raise
    corpus = None

SMOKE_DIR = "/root/testdata/sf0.001"

# --- fixed values: test-data parameters ----------------------------------------
# The job's amount threshold (100) and label threshold (0.3 s) drop nothing on
# the test tables (smallest amount ~900, smallest step ~115), so the
# registered queries use thresholds that split the data.
EXPRESS_THRESHOLD = 30000.0
VISIBLE_SECS = 300.0
FILL_RATING = 5.0
HEAD_ROWS = 3
TOP_ROWS = 3
TUNED_BYTES = 256 << 10  # the test tables' scans are one partition each: small ones deal them out
STEPS = tables.EVENT_STEP_ORDER
STEP_WIDTH = 2  # the test log has five steps
SEED = C.GEN_SEED


# --- order lines ---------------------------------------------------------------
# ``order_lines`` maps every lineitem row to an order line (FIXTURES.md section 3).
# Its modulo expressions derive attributes (express flag, region, missing
# ratings); they never subset rows: every query reads the whole table.

def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.order_lines(spark, sf_dir)


def _imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.impute_mean(_lines(spark, sf_dir), "customer_rating")


def q_scan_csv_typed(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    files.write_csv(_lines(spark, sf_dir), path)
    return files.read_csv(spark, path)


def q_scan_csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    files.write_csv(_lines(spark, sf_dir), path)
    return files.read_csv_inferred(spark, path)


def q_scan_csv_once(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    files.write_csv(_lines(spark, sf_dir), path)
    return inference.read_csv_once(spark, path).rows


def q_profile_shape(spark, sf_dir):
    return profile.profile_shape(_lines(spark, sf_dir))


def q_profile_dtypes(spark, sf_dir):
    return profile.profile_columns(_lines(spark, sf_dir))


def q_profile_null_counts(spark, sf_dir):
    return profile.profile_null_counts(_lines(spark, sf_dir))


def q_profile_head(spark, sf_dir):
    return profile.profile_head(tables.read_table(spark, sf_dir, "orders"), HEAD_ROWS, ["o_orderkey"])


def q_profile_file_head(spark, sf_dir):
    orders = tables.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = scratch_path(spark, "orders-in-order")
    files.write_csv(orders.orderBy("o_orderkey"), path)
    return profile.file_head(files.read_csv(spark, path, orders.schema), HEAD_ROWS)


def q_filter_express(spark, sf_dir):
    return filters.filter_flag(_lines(spark, sf_dir), "is_express")


def q_filter_amount_gt(spark, sf_dir):
    return filters.filter_amount_gt(_lines(spark, sf_dir), EXPRESS_THRESHOLD)


def q_filter_express_amount(spark, sf_dir):
    return filters.filter_express_amount(_lines(spark, sf_dir), EXPRESS_THRESHOLD)


def q_impute_mean_rating(spark, sf_dir):
    return _imputed(spark, sf_dir)


def q_fill_constant(spark, sf_dir):
    return clean.fill_constant(_lines(spark, sf_dir), {"customer_rating": FILL_RATING})


def q_row_count(spark, sf_dir):
    return summaries.row_count(_lines(spark, sf_dir))


def q_mean_rating(spark, sf_dir):
    return summaries.mean_of(_lines(spark, sf_dir), "customer_rating", "mean_rating")


def q_count_rated_by_category(spark, sf_dir):
    return summaries.count_non_null_by(
        _lines(spark, sf_dir), "product_category", "customer_rating", "rated_orders")


def q_revenue_by_category(spark, sf_dir):
    return summaries.money_sum_by(_lines(spark, sf_dir), "product_category", "total_amount", "revenue")


def q_avg_rating_by_category(spark, sf_dir):
    return summaries.avg_by(_imputed(spark, sf_dir), "product_category", "customer_rating", "avg_rating")


def q_avg_quantity_by_category(spark, sf_dir):
    return summaries.avg_by(_lines(spark, sf_dir), "product_category", "quantity", "avg_quantity")


def q_category_summary(spark, sf_dir):
    return summaries.category_summary(_imputed(spark, sf_dir))


def q_express_by_region(spark, sf_dir):
    return summaries.express_by_region(_imputed(spark, sf_dir), EXPRESS_THRESHOLD)


def q_top_categories(spark, sf_dir):
    return summaries.top_n(q_category_summary(spark, sf_dir), TOP_ROWS)


def q_result_roundtrip_parquet(spark, sf_dir):
    path = scratch_path(spark, "summary-parquet")
    files.write_parquet(q_category_summary(spark, sf_dir), path)
    return files.read_parquet(spark, path)


def q_tuned_category_summary(spark, sf_dir):
    return tuned_report(_lines(spark, sf_dir), "category_summary", EXPRESS_THRESHOLD, partition_bytes=TUNED_BYTES)


def q_tuned_express_by_region(spark, sf_dir):
    return tuned_report(_lines(spark, sf_dir), "express_by_region", EXPRESS_THRESHOLD, partition_bytes=TUNED_BYTES)


def q_single_pass_category_summary(spark, sf_dir):
    _, summary, _ = single_pass_reports(_lines(spark, sf_dir), EXPRESS_THRESHOLD)
    return summary


def q_single_pass_express_by_region(spark, sf_dir):
    _, _, express = single_pass_reports(_lines(spark, sf_dir), EXPRESS_THRESHOLD)
    return express


# --- generator (ids = the unique order keys of the orders table) -----------------

def _ids(spark, sf_dir):
    return tables.read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))


def _gen(column: Callable, alias: str):
    def run(spark, sf_dir):
        return _ids(spark, sf_dir).select("id", column("id", SEED).alias(alias))
    return run


def q_gen_order_ids(spark, sf_dir):
    return _ids(spark, sf_dir).select("id", generate.order_id("id").alias("order_id"))


def q_gen_rating_nulls(spark, sf_dir):
    rating = generate.with_missing(generate.rating("id", SEED), "id", SEED)
    return _ids(spark, sf_dir).select("id", rating.alias("customer_rating"))


def q_derive_total_amount(spark, sf_dir):
    base = _ids(spark, sf_dir).select(
        "id", generate.quantity("id", SEED).alias("quantity"),
        generate.unit_price("id", SEED).alias("unit_price"))
    return base.withColumn("total_amount", generate.total_amount(F.col("quantity"), F.col("unit_price")))


def q_format_order_date(spark, sf_dir):
    return _ids(spark, sf_dir).select(
        "id", generate.format_date(generate.order_date("id", SEED)).alias("order_date"))


def q_generate_orders(spark, sf_dir):
    return generate.order_table(_ids(spark, sf_dir), "id", SEED)


# --- run log (events folded into runs x steps) -------------------------------------

def _log(spark, sf_dir):
    return tables.run_log(spark, sf_dir)


def q_runlog_scan_json(spark, sf_dir):
    path = scratch_path(spark, "run-records")
    files.write_run_records(runlog.records_from_log(_log(spark, sf_dir), pre_aggregated=True), path)
    records = files.read_run_records(spark, path, multi_line=False)
    return records.select(
        "experiment_id", "total_time_sec", F.size("steps").alias("n_steps"))


def q_runlog_roundtrip_json(spark, sf_dir):
    path = scratch_path(spark, "run-records")
    files.write_run_records(runlog.records_from_log(_log(spark, sf_dir), pre_aggregated=True), path)
    return runlog.steps_long(files.read_run_records(spark, path, multi_line=False))


def q_runlog_enrich(spark, sf_dir):
    return runlog.enrich(_log(spark, sf_dir))


def q_runlog_unknown_ids(spark, sf_dir):
    return runlog.unknown_configs(_log(spark, sf_dir))


def q_runlog_steps_long(spark, sf_dir):
    return runlog.steps_long(runlog.records_from_log(_log(spark, sf_dir), pre_aggregated=True))


def q_runlog_step_pivot(spark, sf_dir):
    return runlog.step_pivot(_log(spark, sf_dir))


def q_runlog_step_blocks(spark, sf_dir):
    log = _log(spark, sf_dir)
    blocks = runlog.step_blocks(log, runlog.step_dictionary(log, STEP_WIDTH), STEP_WIDTH)
    return blocks.select("run_id", "block", *(F.col("secs")[i].alias(f"slot_{i}") for i in range(STEP_WIDTH)))


def q_runlog_stack_offsets(spark, sf_dir):
    return runlog.stack_offsets(_log(spark, sf_dir), pre_aggregated=True)


def q_runlog_long_offsets(spark, sf_dir):
    return runlog.long_offsets(_log(spark, sf_dir), pre_aggregated=True)


def q_runlog_visible_steps(spark, sf_dir):
    return runlog.visible_steps(_log(spark, sf_dir), VISIBLE_SECS)


def q_runlog_totals(spark, sf_dir):
    return runlog.run_totals(_log(spark, sf_dir))


def q_runlog_custom_order(spark, sf_dir):
    ordered = runlog.with_custom_order(runlog.run_totals(_log(spark, sf_dir)))
    return ordered.orderBy("sort_key", "run_id")


def q_runlog_speedups(spark, sf_dir):
    totals = runlog.config_totals(_log(spark, sf_dir))
    return runlog.speedups(totals, tables.speedup_pairs(spark))


def entry(spark: SparkSession) -> DataFrame:
    return q_category_summary(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = _order_queries()
    if corpus is not None:
        named |= corpus.QUERIES | {"pipeline": corpus_pipeline.run}
    return named


def _order_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # scans
        "scan_csv_typed": q_scan_csv_typed,
        "scan_csv_inferred": q_scan_csv_inferred,
        "scan_csv_once": q_scan_csv_once,
        "runlog_scan_json": q_runlog_scan_json,
        # generator
        "gen_order_ids": q_gen_order_ids,
        "gen_order_dates": _gen(generate.order_date, "order_date"),
        "gen_categories": _gen(generate.product_category, "product_category"),
        "gen_regions": _gen(generate.delivery_region, "delivery_region"),
        "gen_quantity": _gen(generate.quantity, "quantity"),
        "gen_unit_price": _gen(generate.unit_price, "unit_price"),
        "gen_express_flag": _gen(generate.is_express, "is_express"),
        "gen_rating": _gen(generate.rating, "customer_rating"),
        "gen_rating_nulls": q_gen_rating_nulls,
        "derive_total_amount": q_derive_total_amount,
        "format_order_date": q_format_order_date,
        "generate_orders": q_generate_orders,
        # profile
        "profile_shape": q_profile_shape,
        "profile_dtypes": q_profile_dtypes,
        "profile_null_counts": q_profile_null_counts,
        "profile_head": q_profile_head,
        "profile_file_head": q_profile_file_head,
        # filters and imputation
        "filter_express": q_filter_express,
        "filter_amount_gt": q_filter_amount_gt,
        "filter_express_amount": q_filter_express_amount,
        "impute_mean_rating": q_impute_mean_rating,
        "fill_constant": q_fill_constant,
        # aggregates
        "row_count": q_row_count,
        "mean_rating": q_mean_rating,
        "count_rated_by_category": q_count_rated_by_category,
        "revenue_by_category": q_revenue_by_category,
        "avg_rating_by_category": q_avg_rating_by_category,
        "avg_quantity_by_category": q_avg_quantity_by_category,
        "category_summary": q_category_summary,
        "express_by_region": q_express_by_region,
        # sort / limit
        "top_categories": q_top_categories,
        "runlog_custom_order": q_runlog_custom_order,
        # run-log analytics
        "runlog_enrich": q_runlog_enrich,
        "runlog_unknown_ids": q_runlog_unknown_ids,
        "runlog_steps_long": q_runlog_steps_long,
        "runlog_step_pivot": q_runlog_step_pivot,
        "runlog_step_blocks": q_runlog_step_blocks,
        "runlog_stack_offsets": q_runlog_stack_offsets,
        "runlog_long_offsets": q_runlog_long_offsets,
        "runlog_visible_steps": q_runlog_visible_steps,
        "runlog_totals": q_runlog_totals,
        "runlog_speedups": q_runlog_speedups,
        # sinks
        "runlog_roundtrip_json": q_runlog_roundtrip_json,
        "result_roundtrip_parquet": q_result_roundtrip_parquet,
        # physical controls and plans
        "tuned_category_summary": q_tuned_category_summary,
        "tuned_express_by_region": q_tuned_express_by_region,
        "single_pass_category_summary": q_single_pass_category_summary,
        "single_pass_express_by_region": q_single_pass_express_by_region,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for every query that SQL can express."""
    sql = order_sql.queries(EXPRESS_THRESHOLD, VISIBLE_SECS, FILL_RATING, HEAD_ROWS,
                            TOP_ROWS, list(STEPS), SEED)
    if corpus is not None:
        sql |= corpus.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
