"""Fixed values that must equal the reference job's for equal results.

They are data, not logic: thresholds, category lists, weights, labels.
"""

# --- fixed values: order job -------------------------------------------------
EXPRESS_AMOUNT_THRESHOLD = 100.0     # strict ">" on total_amount
IMPUTE_SCALE = 1                     # mean rating rounded to 1 decimal
SHOW_ROWS = 20                       # rows a console `show()` prints

# --- fixed values: synthetic order generator ---------------------------------
GEN_ROWS = 120_000
GEN_SEED = 42
GEN_BASE_DATE = "2024-01-01 00:00:00"
GEN_DAYS = 365                       # day offset in [0, 365)
GEN_HOURS = 24                       # hour offset in [0, 24)
GEN_CATEGORIES = ["Electronics", "Clothing", "Home_Goods", "Books", "Sports"]
GEN_CATEGORY_WEIGHTS = [0.20, 0.25, 0.20, 0.15, 0.20]
GEN_QUANTITY_LOW = 1                 # inclusive
GEN_QUANTITY_HIGH = 15               # exclusive
GEN_PRICE_MU = 3.2                   # lognormal mean of ln(price)
GEN_PRICE_SIGMA = 0.9
GEN_PRICE_SCALE = 2
GEN_REGIONS = ["Moscow", "SPb", "Kazan", "Novosibirsk", "Remote"]
GEN_REGION_WEIGHTS = [0.30, 0.20, 0.15, 0.15, 0.20]
GEN_EXPRESS_P = 0.25
GEN_RATING_MU = 4.1
GEN_RATING_SIGMA = 1.0
GEN_RATING_MIN = 1.0
GEN_RATING_MAX = 5.0
GEN_RATING_SCALE = 1
GEN_RATING_NULL_P = 0.05
GEN_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"

# --- fixed values: run-record analytics --------------------------------------
RUN_ORDER = ["1dn_base", "1dn_opt", "3dn_base", "3dn_opt"]
RUN_UNKNOWN_POS = 99
# (config, label, shuffle partitions, repartition)
RUN_META_ROWS = [
    ("1dn_base", "1DN Базовый", 4, None),
    ("1dn_opt", "1DN Оптимизир.", 8, 8),
    ("3dn_base", "3DN Базовый", 4, None),
    ("3dn_opt", "3DN Оптимизир.", 8, 8),
]
# (pair label, base config, compared config); speedup = base / compared
SPEEDUP_PAIRS = [
    ("1DN опт. vs базовый", "1dn_base", "1dn_opt"),
    ("3DN опт. vs базовый", "3dn_base", "3dn_opt"),
    ("3DN базовый vs 1DN базовый", "1dn_base", "3dn_base"),
]
STEP_LABEL_MIN_SECS = 0.3            # segments at or below are not labelled
# Step names as written in run records, in job order.
RUN_STEP_NAMES = ["чтение", "пропуски", "группировка", "фильтрация"]
