"""Quality rules: a learned decision list as one Spark conditional expression.

Statistics of whole texts are built-in array and string functions; nothing leaves
the JVM.  Repeated 8-word windows are found per text by sorting 64-bit window
fingerprints that carry their position in the low bits, so no window leaves
its row: no shuffle, and work grows with n log n of a text's words.

The list is learned by sequential covering.  The statistics of about ``LABELLED``
labelled rows at most (the bound of the fit) are cut at their quantiles and counted per
cell with one aggregation.  Each rule is grown on two thirds of the labelled rows,
one threshold at a time by information gain, pruned from its end on the last
third, and accepted while it is precise on both; the rows it covers are set aside.
The rules are emitted in order as ``when(...).when(...).otherwise(...)``.

Defined results: a null text has no words and fails the base rule (fewer than
``MIN_WORDS``).  Rows are kept one to one.  Labels of repeated ids count once,
as the larger value; null labels are left out.  Without labels of both
kinds the list is empty and the base rule decides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import hash_fraction

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
LABELLED = 20_000
CUTS = 16
MAX_RULES = 12
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9
MIN_COVER = 5

_WORD_CHARACTER = "[^\\x20\\x09-\\x0D]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def _covered(positions: Column) -> Column:
    """Words in the union of the windows at the sorted positions."""
    whole = F.lit(WINDOW).cast("long")
    gaps = F.transform(positions, lambda p, j: F.least(whole, F.coalesce(F.get(positions, j + 1) - p, whole)))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, b: a + b)


def _paired(values: Column, apart: int) -> Column:
    """The fingerprint of each value with the one ``apart`` places on."""
    n = F.greatest(F.size(values) - apart, F.lit(0))
    return F.zip_with(F.slice(values, 1, n), F.slice(values, apart + 1, n), lambda a, b: F.xxhash64(a, b))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each text.

    Arrays that several expressions read are columns of their own, so that Spark
    computes each once and sorts and compares them as primitive arrays.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select(
        "doc_id",
        F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(_WORD_CHARACTER)).alias("lines"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit("[0-9]")).cast("long").alias("n_digits"))
    rows = rows.select(
        "doc_id", "n_symbols", "n_upper", "n_digits",
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"))
    carried = ["doc_id", "n_symbols", "n_upper", "n_digits", "word_chars", "n_dup_lines", "n_lines"]
    # windows of 2, 4 and 8 words, each from two of half its length
    n_words = F.size("hashes").cast("long").alias("n_words")
    n_distinct = F.size(F.array_distinct("hashes")).cast("long").alias("n_distinct")
    rows = rows.select(*carried, n_words, n_distinct, _paired(F.col("hashes"), 1).alias("windows"))
    carried += ["n_words", "n_distinct"]
    rows = rows.select(*carried, _paired(F.col("windows"), 2).alias("windows"))
    rows = rows.select(*carried, _paired(F.col("windows"), 4).alias("windows"))
    # codes: a fingerprint in the high bits, its position in the low ones
    low = F.coalesce(F.pow(F.lit(2.0), F.ceil(F.log2(F.size("windows") + 1.0))).cast("long") - 1, F.lit(0).cast("long"))
    rows = rows.select(*carried, "windows", low.alias("low"), F.bitwise_not(low).alias("high"))
    codes = F.sort_array(F.transform("windows", lambda h, i: h.bitwiseAND(F.col("high")).bitwiseOR(i.cast("long"))))
    rows = rows.select(*carried, "low", "high", codes.alias("codes"))

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(a.bitwiseXOR(b).bitwiseAND(F.col("high")) == 0, F.lit(False))

    found = F.filter("codes", lambda c, j: same(c, F.get(F.col("codes"), j - 1)) | same(c, F.get(F.col("codes"), j + 1)))
    rows = rows.select(*carried, "low", found.alias("found"))
    repeats = F.when(F.size("found") > 0, _let(
        F.sort_array(F.transform("found", lambda c: c.bitwiseAND(F.col("low")))), _covered)).otherwise(F.lit(0).cast("long"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", repeats.alias("n_repeat_words"),
                       "n_distinct", "n_lines", "n_upper", "n_digits")


def features() -> dict[str, Column]:
    """The quantities that the rules may compare with thresholds."""
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / n,
        "symbols": F.col("n_symbols") / n,
        "duplicate_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / n,
        "distinct": F.col("n_distinct") / n,
        "upper": F.col("n_upper") / chars,
        "digits": F.col("n_digits") / chars,
        "lines": F.col("n_lines") / n,
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.cut if self.above else value <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _cells(stats: DataFrame, labels: DataFrame) -> tuple[dict[str, list[float]], list[tuple]]:
    """The cuts of each feature, and (fold, label, bins..., count) cells."""
    names = list(features())
    table = stats.join(labels, "doc_id").select(
        (F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)) == 0).alias("prune"), "label",
        *(c.alias(f) for f, c in features().items()))
    kept = table.cache()
    try:
        table = kept.where(~base_failed_of_features())  # the list only sees what the base rule passes
        shares = [i / CUTS for i in range(1, CUTS)]
        row = table.agg(*(F.percentile_approx(f, shares, 2000).alias(f) for f in names),
                        *(F.percentile_approx(F.when(F.col("label") == 0, F.col(f)), shares, 2000).alias(f"{f}_low") for f in names)).first()
        cuts = {f: sorted({*(row[f] or []), *(row[f"{f}_low"] or [])}) for f in names}
        binned = [sum((F.when(F.col(f) > t, 1).otherwise(0) for t in cuts[f]), F.lit(0)).alias(f) for f in names]
        return cuts, [tuple(r) for r in table.select("prune", "label", *binned).groupBy("prune", "label", *names).count().collect()]
    finally:
        kept.unpersist()


def base_failed_of_features() -> Column:
    return (F.col("words") < MIN_WORDS) | (100 * F.col("repeats") > MAX_REPEAT_PERCENT)


def _counts(cells: list[tuple]) -> tuple[int, int]:
    """(low, good) rows of the cells."""
    low = sum(c[-1] for c in cells if c[1] == 0)
    return low, sum(c[-1] for c in cells) - low


def _gain(low: int, good: int, low0: int, good0: int) -> float:
    if low == 0:
        return 0.0
    return low * (log2(low / (low + good)) - log2(low0 / (low0 + good0)))


def _grow(cells: list[tuple], cuts: dict[str, list[float]]) -> list[tuple[int, bool, int]]:
    """Tests (feature, above, bin) that cover low rows and few good ones."""
    names, tests = list(cuts), []
    while len(tests) < MAX_CONDITIONS:
        low0, good0 = _counts(cells)
        if good0 == 0 or low0 == 0:
            break
        best, choice = 1e-9, None
        for f, name in enumerate(names):
            by_bin = [[0, 0] for _ in range(len(cuts[name]) + 1)]
            for c in cells:
                by_bin[c[2 + f]][c[1]] += c[-1]
            low = good = 0
            for b in range(len(cuts[name])):  # value <= cuts[b] is bin <= b
                low, good = low + by_bin[b][0], good + by_bin[b][1]
                for above, p, n in ((False, low, good), (True, low0 - low, good0 - good)):
                    if p >= MIN_COVER and (g := _gain(p, n, low0, good0)) > best:
                        best, choice = g, (f, above, b)
        if choice is None:
            break
        tests.append(choice)
        cells = [c for c in cells if _passes(c, choice)]
    return tests


def _passes(cell: tuple, test: tuple[int, bool, int]) -> bool:
    f, above, b = test
    return (cell[2 + f] > b) == above


def _covered_cells(cells: list[tuple], tests: list[tuple[int, bool, int]]) -> list[tuple]:
    return [c for c in cells if all(_passes(c, t) for t in tests)]


def sequential_covering(cells: list[tuple], cuts: dict[str, list[float]]) -> list[Rule]:
    names, rules = list(cuts), []
    while len(rules) < MAX_RULES:
        grow, prune = [c for c in cells if not c[0]], [c for c in cells if c[0]]
        tests = _grow(grow, cuts)
        if not tests:
            break

        def worth(n: int) -> float:
            low, good = _counts(_covered_cells(prune, tests[:n]))
            return (low - good + 0.0) / (low + good) if low + good else -1.0

        length = max(range(1, len(tests) + 1), key=lambda n: (worth(n), -n))
        pruned = tests[:length]
        (low, good), (low2, good2) = _counts(_covered_cells(grow, pruned)), _counts(_covered_cells(prune, pruned))
        if low + low2 < MIN_COVER or low + low2 < MIN_PRECISION * (low + low2 + good + good2) or low2 < good2:
            pruned = tests
            (low, good), (low2, good2) = _counts(_covered_cells(grow, pruned)), _counts(_covered_cells(prune, pruned))
            if low + low2 < MIN_COVER or low + low2 < MIN_PRECISION * (low + low2 + good + good2) or low2 < good2:
                break
        rules.append(tuple(Condition(names[f], above, cuts[names[f]][b]) for f, above, b in pruned))
        covered = set(map(id, _covered_cells(cells, pruned)))
        cells = [c for c in cells if id(c) not in covered]
    return rules


def learn(docs: DataFrame, labels: DataFrame) -> list[Rule]:
    """The ordered rules that reject a text, from labels (doc_id, quality)."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where("doc_id IS NOT NULL AND quality IN (0, 1)")
             .groupBy("doc_id").agg(F.max("quality").alias("label")))
    n = known.count()
    if n == 0:
        return []
    chosen = F.broadcast(known.where(hash_fraction("doc_id", 1) < min(1.0, LABELLED / n)))  # about LABELLED rows of two numbers
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen.select("doc_id"), "doc_id", "left_semi")
    cuts, cells = _cells(statistics(sample), chosen)
    return sequential_covering(cells, cuts) if len({c[1] for c in cells}) == 2 else []


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, 0 if none: one conditional expression."""
    chain = None
    for i, rule in enumerate(rules, 1):
        test = rule[0].column()
        for condition in rule[1:]:
            test = test & condition.column()
        chain = F.when(test, i) if chain is None else chain.when(test, i)
    return chain.otherwise(0) if chain is not None else F.lit(0)


def apply(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per document: its statistics, the base rule and the list's verdict."""
    return statistics(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & (verdict(rules) == 0)).alias("kept"),
        verdict(rules).alias("rule"), "n_distinct", "n_lines", "n_upper", "n_digits")


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return apply(docs, learn(docs, labels))
