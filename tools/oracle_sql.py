"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Independent of the library: it imports nothing from it, writes its parameters out,
sums plain decimals and rounds only final results.
"""

from __future__ import annotations

import math
from types import SimpleNamespace

# --- fixed values: the parameters of the registered queries, written out -----------------
C = SimpleNamespace(
    GEN_BASE_DATE="2024-01-01 00:00:00", GEN_DAYS=365, GEN_HOURS=24,
    GEN_CATEGORIES=["Electronics", "Clothing", "Home_Goods", "Books", "Sports"],
    GEN_REGIONS=["Moscow", "SPb", "Kazan", "Novosibirsk", "Remote"],
    GEN_QUANTITY_LOW=1, GEN_QUANTITY_HIGH=15,
    GEN_PRICE_MU=3.2, GEN_PRICE_SIGMA=0.9, GEN_PRICE_SCALE=2, GEN_EXPRESS_P=0.25,
    GEN_RATING_MU=4.1, GEN_RATING_SIGMA=1.0, GEN_RATING_MIN=1.0, GEN_RATING_MAX=5.0, GEN_RATING_SCALE=1, GEN_RATING_NULL_P=0.05,
    RUN_ORDER=["1dn_base", "1dn_opt", "3dn_base", "3dn_opt"], RUN_UNKNOWN_POS=99,
    RUN_META_ROWS=[("1dn_base", "1DN Базовый", 4, None), ("1dn_opt", "1DN Оптимизир.", 8, 8),
                   ("3dn_base", "3DN Базовый", 4, None), ("3dn_opt", "3DN Оптимизир.", 8, 8)],
    SPEEDUP_PAIRS=[("1DN опт. vs базовый", "1dn_base", "1dn_opt"), ("3DN опт. vs базовый", "3dn_base", "3dn_opt"),
                   ("3DN базовый vs 1DN базовый", "1dn_base", "3dn_base")],
)
#: Upper bounds of the first four of five values.
CATEGORY_BOUNDS = [0.2, 0.45, 0.65, 0.8]
REGION_BOUNDS = [0.3, 0.5, 0.65, 0.8]
#: The digest salt of each variate, and which 8 hex digits of it.
VARIATES = {"day": ("a", 0), "hour": ("a", 1), "cat": ("a", 2), "qty": ("a", 3), "p1": ("b", 0), "p2": ("b", 1),
            "reg": ("b", 2), "ex": ("b", 3), "r1": ("c", 0), "r2": ("c", 1), "nul": ("c", 2)}


def present(expr: str) -> str:
    """The value as a plain decimal, NaN as missing."""
    return f"CAST(CASE WHEN isnan({expr}) THEN NULL ELSE {expr} END AS DECIMAL(38,6))"


def mean(expr: str, scale: int = 6) -> str:
    return f"round(avg({present(expr)}), {scale})"


def money(expr: str) -> str:
    return f"round(CAST(sum({present(expr)}) AS DOUBLE), 2)"


ORDER_LINES = """order_lines AS (
  SELECT printf('ORD-%07d', l_orderkey) AS order_id,
         l_shipdate AS order_date,
         l_returnflag || l_linestatus AS product_category,
         CAST(trunc(l_quantity) AS INTEGER) AS quantity,
         l_extendedprice / nullif(l_quantity, 0) AS unit_price,
         'R' || CAST(l_suppkey % 5 AS VARCHAR) AS delivery_region,
         l_partkey % 4 = 0 AS is_express,
         CASE WHEN (l_orderkey + l_suppkey) % 20 = 7 THEN NULL
              ELSE round(1.0 + l_discount * 40.0, 1) END AS customer_rating,
         l_extendedprice AS total_amount
  FROM lineitem)"""

IMPUTED = f"""fill AS (SELECT {mean('customer_rating', 1)} AS v FROM order_lines),
imputed AS (
  SELECT * REPLACE (coalesce(CASE WHEN isnan(customer_rating) THEN NULL ELSE customer_rating END,
                             (SELECT v FROM fill)) AS customer_rating)
  FROM order_lines)"""

RUN_LOG = f"""run_log AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS run_id,
         CASE user_id % 5 WHEN 0 THEN '1dn_base' WHEN 1 THEN '1dn_opt'
              WHEN 2 THEN '3dn_base' WHEN 3 THEN '3dn_opt' ELSE 'zzz' END AS config,
         event_type AS step,
         CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3
              WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 ELSE 99 END AS INTEGER) AS step_pos,
         {money('value')} AS secs
  FROM events GROUP BY user_id, event_type)"""


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"


def category_summary_sql(source: str = "imputed") -> str:
    return f"""SELECT product_category,
       count(order_id) AS total_orders,
       {money('total_amount')} AS revenue,
       {mean('customer_rating')} AS avg_rating,
       {mean('quantity')} AS avg_quantity
FROM {source} GROUP BY product_category
ORDER BY revenue DESC NULLS LAST, product_category"""


def express_by_region_sql(threshold: float, source: str = "order_lines") -> str:
    return f"""SELECT delivery_region,
       count(order_id) AS express_orders,
       {money('total_amount')} AS express_revenue
FROM {source} WHERE is_express AND total_amount > {threshold!r}
GROUP BY delivery_region
ORDER BY express_revenue DESC NULLS LAST, delivery_region"""


# --- generator: the same hash uniforms and transforms in SQL ------------------

IDS = "ids AS (SELECT o_orderkey AS id FROM orders)"
TWO_PI = repr(2.0 * math.pi)


def uniform(variate: str, seed: int) -> str:
    salt, slot = VARIATES[variate]
    return (f"((CAST(CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || ':{seed}:{salt}'), {1 + 8 * slot}, 8))"
            f" AS BIGINT) AS DOUBLE) + 0.5) / 4294967296.0)")


def normal(s1: str, s2: str, seed: int) -> str:
    return f"(sqrt(-2.0 * ln({uniform(s1, seed)})) * cos({TWO_PI} * {uniform(s2, seed)}))"


def weighted(salt: str, values, bounds, seed: int) -> str:
    u = uniform(salt, seed)
    parts = [f"WHEN {u} < {b!r} THEN '{v}'" for v, b in zip(values[:-1], bounds)]
    return "CASE " + " ".join(parts) + f" ELSE '{values[-1]}' END"


def gen_columns(seed: int) -> dict[str, str]:
    days = f"CAST(floor({uniform('day', seed)} * {float(C.GEN_DAYS)!r}) AS INTEGER)"
    hours = f"CAST(floor({uniform('hour', seed)} * {float(C.GEN_HOURS)!r}) AS INTEGER)"
    rating = (f"round(greatest({C.GEN_RATING_MIN!r}, least({C.GEN_RATING_MAX!r}, "
              f"{C.GEN_RATING_MU!r} + {C.GEN_RATING_SIGMA!r} * {normal('r1', 'r2', seed)})), "
              f"{C.GEN_RATING_SCALE})")
    span = float(C.GEN_QUANTITY_HIGH - C.GEN_QUANTITY_LOW)
    return {
        "order_id": "printf('ORD-%07d', id)",
        "order_date": f"(TIMESTAMP '{C.GEN_BASE_DATE}' + to_days({days}) + to_hours({hours}))",
        "product_category": weighted("cat", C.GEN_CATEGORIES, CATEGORY_BOUNDS, seed),
        "quantity": f"CAST({C.GEN_QUANTITY_LOW} + floor({uniform('qty', seed)} * {span!r}) AS INTEGER)",
        "unit_price": (f"round(exp({C.GEN_PRICE_MU!r} + {C.GEN_PRICE_SIGMA!r} * "
                       f"{normal('p1', 'p2', seed)}), {C.GEN_PRICE_SCALE})"),
        "delivery_region": weighted("reg", C.GEN_REGIONS, REGION_BOUNDS, seed),
        "is_express": f"({uniform('ex', seed)} < {C.GEN_EXPRESS_P!r})",
        "rating": rating,
        "customer_rating": f"CASE WHEN {uniform('nul', seed)} >= {C.GEN_RATING_NULL_P!r} THEN {rating} END",
    }


def generated_orders_view(seed: int) -> str:
    g = gen_columns(seed)
    cols = ",\n         ".join(
        f"{g[c]} AS {c}" for c in ("order_id", "order_date", "product_category", "quantity",
                                   "unit_price", "delivery_region", "is_express", "customer_rating")
    )
    return f"""gen AS (
  SELECT {cols}
  FROM ids),
generated AS (SELECT *, quantity * unit_price AS total_amount FROM gen)"""


# --- run-log views -------------------------------------------------------------

def values_table(name: str, columns: str, rows) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"{name}({columns}) AS (VALUES {body})"


META = values_table("meta", "config, label, shuffle, repartition",
                    [(c, lab, s, r) for c, lab, s, r in C.RUN_META_ROWS])
PAIRS = values_table("pairs", "pair, base_config, other_config", C.SPEEDUP_PAIRS)
RUN_TOTALS = f"""run_totals AS (
  SELECT run_id, config, {money('secs')} AS total_time_sec, count(*) AS n_steps
  FROM run_log GROUP BY run_id, config)"""
STEPS_LONG = """SELECT run_id, run_id AS config, step,
       CAST(row_number() OVER (PARTITION BY run_id ORDER BY step_pos, step) AS INTEGER) AS step_pos,
       secs
FROM run_log"""


def order_case(col: str) -> str:
    parts = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(C.RUN_ORDER, start=1))
    return f"CAST(CASE {col} {parts} ELSE {C.RUN_UNKNOWN_POS} END AS INTEGER)"


def queries(express_threshold: float, visible_secs: float, fill_rating: float,
            head_rows: int, top_rows: int, steps: list[str], seed: int) -> dict[str, str]:
    ol = with_views(ORDER_LINES)
    imp = with_views(ORDER_LINES, IMPUTED)
    rl = with_views(RUN_LOG)
    gen = with_views(IDS, generated_orders_view(seed))
    g = gen_columns(seed)
    offsets = f"""SELECT *, round(CAST(coalesce(sum({present('secs')}) OVER (
    PARTITION BY run_id ORDER BY step_pos, step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS DOUBLE), 2) AS "offset"
FROM run_log"""
    null_checks, column_checks = [], []
    # (column, Spark SQL type name, floating)
    for i, (c, dtype, floating) in enumerate([
            ("order_id", "string", False), ("order_date", "timestamp_ntz", False),
            ("product_category", "string", False), ("quantity", "int", False),
            ("unit_price", "double", True), ("delivery_region", "string", False),
            ("is_express", "boolean", False), ("customer_rating", "double", True),
            ("total_amount", "double", True)], start=1):
        cond = f"{c} IS NULL OR isnan({c})" if floating else f"{c} IS NULL"
        null_checks.append(f"SELECT {i} AS ordinal, '{c}' AS column_name, "
                           f"count(*) FILTER (WHERE {cond}) AS null_count FROM order_lines")
        column_checks.append(f"SELECT {i} AS ordinal, '{c}' AS column_name, '{dtype}' AS data_type, "
                             f"count(*) FILTER (WHERE NOT ({cond})) AS non_null_count FROM order_lines")
    pivot_cols = ",\n       ".join(
        f"coalesce(sum(secs) FILTER (WHERE step = '{s}'), 0.0) AS {s}" for s in steps)
    by_cat = "FROM {src} GROUP BY product_category"
    return {
        # scans
        "scan_csv_typed": ol + "SELECT * FROM order_lines",
        "scan_csv_inferred": ol + "SELECT * FROM order_lines",
        "scan_csv_once": ol + "SELECT * FROM order_lines",
        "runlog_scan_json": rl + f"""SELECT run_id AS experiment_id, {money('secs')} AS total_time_sec,
       CAST(count(*) AS INTEGER) AS n_steps
FROM run_log GROUP BY run_id""",
        # generator
        "gen_order_ids": with_views(IDS) + f"SELECT id, {g['order_id']} AS order_id FROM ids",
        "gen_order_dates": with_views(IDS) + f"SELECT id, {g['order_date']} AS order_date FROM ids",
        "gen_categories": with_views(IDS) + f"SELECT id, {g['product_category']} AS product_category FROM ids",
        "gen_regions": with_views(IDS) + f"SELECT id, {g['delivery_region']} AS delivery_region FROM ids",
        "gen_quantity": with_views(IDS) + f"SELECT id, {g['quantity']} AS quantity FROM ids",
        "gen_unit_price": with_views(IDS) + f"SELECT id, {g['unit_price']} AS unit_price FROM ids",
        "gen_express_flag": with_views(IDS) + f"SELECT id, {g['is_express']} AS is_express FROM ids",
        "gen_rating": with_views(IDS) + f"SELECT id, {g['rating']} AS customer_rating FROM ids",
        "gen_rating_nulls": with_views(IDS) + f"SELECT id, {g['customer_rating']} AS customer_rating FROM ids",
        "derive_total_amount": with_views(IDS) + f"""SELECT id, q AS quantity, p AS unit_price, q * p AS total_amount
FROM (SELECT id, {g['quantity']} AS q, {g['unit_price']} AS p FROM ids)""",
        "format_order_date": with_views(IDS) + f"""SELECT id, strftime({g['order_date']}, '%Y-%m-%d %H:%M:%S') AS order_date
FROM ids""",
        "generate_orders": gen + "SELECT * FROM generated",
        # profile
        "profile_shape": ol + "SELECT count(*) AS n_rows, CAST(9 AS INTEGER) AS n_cols FROM order_lines",
        "profile_null_counts": ol + "\nUNION ALL\n".join(null_checks),
        "profile_dtypes": ol + "\nUNION ALL\n".join(column_checks),
        "profile_head": f"SELECT * FROM orders ORDER BY o_orderkey LIMIT {head_rows}",
        # filters, imputation
        "filter_express": ol + "SELECT * FROM order_lines WHERE is_express",
        "filter_amount_gt": ol + f"SELECT * FROM order_lines WHERE total_amount > {express_threshold!r}",
        "filter_express_amount": ol + (
            f"SELECT * FROM order_lines WHERE is_express AND total_amount > {express_threshold!r}"),
        "impute_mean_rating": imp + "SELECT * FROM imputed",
        "fill_constant": ol + (
            f"SELECT * REPLACE (coalesce(CASE WHEN isnan(customer_rating) THEN NULL ELSE customer_rating END,"
            f" {fill_rating!r}) AS customer_rating) FROM order_lines"),
        # aggregates
        "row_count": ol + "SELECT count(*) AS row_count FROM order_lines",
        "mean_rating": ol + f"SELECT {mean('customer_rating')} AS mean_rating FROM order_lines",
        "count_rated_by_category": ol + (
            "SELECT product_category, count(customer_rating) AS rated_orders " + by_cat.format(src="order_lines")),
        "revenue_by_category": ol + (
            f"SELECT product_category, {money('total_amount')} AS revenue " + by_cat.format(src="order_lines")),
        "avg_rating_by_category": imp + (
            f"SELECT product_category, {mean('customer_rating')} AS avg_rating " + by_cat.format(src="imputed")),
        "avg_quantity_by_category": ol + (
            f"SELECT product_category, {mean('quantity')} AS avg_quantity " + by_cat.format(src="order_lines")),
        "category_summary": imp + category_summary_sql(),
        "express_by_region": ol + express_by_region_sql(express_threshold),
        # sort / limit
        "top_categories": imp + category_summary_sql() + f" LIMIT {top_rows}",
        "runlog_custom_order": with_views(RUN_LOG, RUN_TOTALS) + f"""SELECT *, {order_case('config')} AS sort_key
FROM run_totals ORDER BY sort_key, run_id""",
        # run-log analytics
        "runlog_enrich": with_views(RUN_LOG, META) + """SELECT r.*, m.label, m.shuffle, m.repartition
FROM run_log r LEFT JOIN meta m ON r.config = m.config""",
        "runlog_unknown_ids": with_views(RUN_LOG, META) + """SELECT DISTINCT run_id, config FROM run_log
WHERE config NOT IN (SELECT config FROM meta)""",
        "runlog_steps_long": rl + STEPS_LONG,
        "runlog_step_pivot": rl + f"SELECT run_id,\n       {pivot_cols}\nFROM run_log GROUP BY run_id",
        "profile_file_head": f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT {head_rows}",
        "runlog_step_blocks": rl + """, names AS (
  SELECT step, row_number() OVER (ORDER BY min(step_pos), step) - 1 AS place FROM run_log GROUP BY step)
SELECT run_id, place // 2 AS block, coalesce(sum(CASE WHEN place % 2 = 0 THEN secs END), 0) AS slot_0,
       coalesce(sum(CASE WHEN place % 2 = 1 THEN secs END), 0) AS slot_1
FROM run_log JOIN names USING (step) GROUP BY run_id, place // 2""",
        "runlog_stack_offsets": rl + offsets,
        "runlog_long_offsets": rl + offsets,
        "runlog_visible_steps": rl + f"SELECT * FROM run_log WHERE secs > {visible_secs!r}",
        "runlog_totals": with_views(RUN_LOG, RUN_TOTALS) + "SELECT * FROM run_totals",
        "runlog_speedups": with_views(RUN_LOG, PAIRS) + f""", totals AS (
  SELECT config, {money('secs')} AS total_secs FROM run_log GROUP BY config)
SELECT p.pair, p.base_config, p.other_config, b.total_secs AS base_total, o.total_secs AS other_total,
       CASE WHEN o.total_secs = 0 THEN NULL ELSE b.total_secs / o.total_secs END AS speedup
FROM pairs p LEFT JOIN totals b ON b.config = p.base_config
             LEFT JOIN totals o ON o.config = p.other_config""",
        # sinks (round trips)
        "runlog_roundtrip_json": rl + STEPS_LONG,
        "result_roundtrip_parquet": imp + category_summary_sql(),
        # physical controls and plans: same results as the base reports
        "tuned_category_summary": imp + category_summary_sql(),
        "tuned_express_by_region": ol + express_by_region_sql(express_threshold),
        "single_pass_category_summary": imp + category_summary_sql(),
        "single_pass_express_by_region": ol + express_by_region_sql(express_threshold),
    }
