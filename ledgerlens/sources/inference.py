"""CSV column types inferred in the one pass that parses the text.

The text is parsed once, as strings, into a staged Parquet table.  The same job observes,
for every column, the set of kinds that its fields have, as a bit mask merged by
``bit_or``: the join of a lattice, so neither splits, order nor retried tasks change it.
The typed table is a cast of the staged columns; the text is not read again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import scratch_path

#: The kinds of a field, narrowest first; a field has the first that fits it.
KINDS = ("int", "bigint", "decimal", "double", "date", "timestamp_ntz", "boolean", "string")
_BIT = {kind: 1 << i for i, kind in enumerate(KINDS)}
_NUMBERS = ("int", "bigint", "decimal", "double")
_INT_MOST, _BIGINT_MOST = (1 << 31) - 1, (1 << 63) - 1
# A failed try_cast raises and catches an exception, dozens of times the cost of a cast that
# succeeds; so these patterns let through little else than what the cast takes, and all of that.
_DIGITS = r"^[+-]?[0-9]+$"
_INT = r"^[+-]?[0-9]{1,9}\z"
_BIGINT = r"^[+-]?[0-9]{10,18}\z"
_PLAIN_DOUBLE = r"^[+-]?[0-9]++\.[0-9]++\z"
_DOUBLE = (r"^[\x00-\x20]*+[+-]?(?:(?:[0-9]++(?:\.[0-9]*+)?+|\.[0-9]++)(?:[eE][+-]?[0-9]++)?+[fFdD]?"
           r"|0[xX][0-9a-fA-F]*+\.?[0-9a-fA-F]*+[pP][+-]?[0-9]++[fFdD]?|(?i:nan|inf|infinity))[\x00-\x20]*+\z")
_DAY = r"[0-9]{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])"
_DATE = f"^{_DAY}$"
_TIMESTAMP = f"^{_DAY} (?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"
_WHOLE_START = [ord(c) for c in "0123456789+-"]
_NUMERIC_START = [*range(0x21), *_WHOLE_START, *map(ord, ".iInN")]  # 0 is the empty text's
_MOST_DIGITS = 38


def _precision(field: Column) -> Column:
    return F.length(F.regexp_replace(field, "^[+-]?0*", ""))


def _within(number: Column, most: int) -> Column:
    return number.between(F.lit(-most - 1), F.lit(most))


def _kind(field: Column, named: Callable[[str], object]) -> Column:
    """``named`` of the narrowest kind of a text field; null for a missing one.

    Dates and timestamps are told before numbers, and words by their first character, as
    no field fits both: each field meets few patterns."""
    medium, large = field.try_cast("bigint"), field.try_cast(f"decimal({_MOST_DIGITS}, 0)")
    numeric, dashed = F.ascii(field).isin(*_NUMERIC_START), field.substr(5, 1) == "-"
    return (
        F.when(field.isNull(), None)
        .when(~numeric, F.when(F.lower(field).isin("true", "false"), named("boolean")).otherwise(named("string")))
        .when(dashed & field.rlike(_TIMESTAMP) & field.try_cast("timestamp_ntz").isNotNull(), named("timestamp_ntz"))
        .when(dashed & field.rlike(_DATE) & field.try_cast("date").isNotNull(), named("date"))
        .when(field.rlike(_INT), named("int"))
        .when(field.rlike(_PLAIN_DOUBLE), named("double"))
        .when(field.rlike(_BIGINT), F.when(_within(medium, _INT_MOST), named("int")).otherwise(named("bigint")))
        .when(field.rlike(_DIGITS) & (_precision(field) <= _MOST_DIGITS),
              F.when(_within(large, _INT_MOST), named("int")).when(_within(large, _BIGINT_MOST), named("bigint")).otherwise(named("decimal")))
        .when(field.rlike(_DOUBLE) & field.try_cast("double").isNotNull(), named("double"))
        .otherwise(named("string"))
    )


def kind_of(field: Column) -> Column:
    """The narrowest kind of a text field; null for a missing one."""
    return _kind(field, str)


def _mask(field: Column) -> Column:
    return F.coalesce(_kind(field, _BIT.__getitem__), F.lit(0))


def _digits(field: Column) -> Column:
    return F.when(F.ascii(field).isin(*_WHOLE_START) & field.rlike(_DIGITS), _precision(field))


def kinds_in(mask: int) -> list[str]:
    return [kind for kind in KINDS if mask & _BIT[kind]]


def type_of(mask: int, precision: int | None) -> T.DataType:
    """The least type that holds every kind of the mask: numbers widen, a single other
    kind stays, any other mixture and a column without values are strings."""
    kinds = kinds_in(mask)
    if kinds and set(kinds) <= set(_NUMBERS):
        return {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType()}.get(
            kinds[-1], T.DecimalType(precision or _MOST_DIGITS, 0))
    if len(kinds) == 1:
        return {"date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(), "boolean": T.BooleanType()}.get(kinds[0], T.StringType())
    return T.StringType()


@dataclass
class Inferred:
    """``rows`` with inferred types; ``mixed`` maps the columns that became strings because
    their fields are of several kinds to those kinds; ``staged`` is the parsed text."""
    rows: DataFrame
    mixed: dict[str, list[str]]
    staged: DataFrame
    file_column: str

    def conflicts(self) -> DataFrame:
        """file, column, kind, n_fields of the mixed columns: which files hold which kind.
        Reads only those columns of the staged table."""
        schema = "file string, column string, kind string, n_fields long"
        if not self.mixed:
            return self.rows.sparkSession.createDataFrame([], schema)
        fields = F.array(*(F.struct(F.lit(c).alias("column"), kind_of(_named(c)).alias("kind")) for c in self.mixed))
        found = self.staged.select(_named(self.file_column).alias("file"), F.explode(fields).alias("field"))
        return (found.where("field.kind IS NOT NULL").groupBy("file", "field.column", "field.kind")
                .agg(F.count("*").alias("n_fields")).select("file", "column", "kind", "n_fields"))


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def _free_name(name: str, taken: list[str]) -> str:
    while name.lower() in {other.lower() for other in taken}:
        name += "_"
    return name


def read_csv_once(spark: SparkSession, path: str) -> Inferred:
    """Header-row CSV with inferred types, the text read once.

    An empty field is null and of no kind.  The first header names the columns; a file of the
    folder with another header raises.  A mixture of dates and timestamps is a string column,
    whichever comes first.  A file without rows gives string columns.  The driver receives
    two numbers a column.
    """
    names = spark.read.option("header", True).csv(path).columns  # the header alone is read
    if not names:
        empty = spark.createDataFrame([], T.StructType([]))
        return Inferred(empty, {}, empty, "")
    text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    file_column, marks = _free_name("_file", names), _free_name("_marks", names)
    parsed = spark.read.schema(text).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    parsed = parsed.select(*map(_named, names), F.col("_metadata.file_path").alias(file_column))
    # one lambda over all fields: the same expression written out for every column compiles
    # to a method that is too long for the JVM's compiler and stays interpreted
    marked = F.transform(F.array(*map(_named, names)), lambda field: F.struct(_mask(field).alias("mask"), _digits(field).alias("digits")))
    seen = Observation()
    measures = []
    for i in range(len(names)):
        measures.append(F.bit_or(F.col(marks)[i]["mask"]).alias(f"mask_{i}"))
        measures.append(F.max(F.col(marks)[i]["digits"]).alias(f"digits_{i}"))
    target = scratch_path(spark, "csv-once")
    parsed.withColumn(marks, marked).observe(seen, *measures).drop(marks).write.parquet(target)
    staged = spark.read.schema(parsed.schema).parquet(target)
    got = seen.get
    types = {name: type_of(got.get(f"mask_{i}") or 0, got.get(f"digits_{i}")) for i, name in enumerate(names)}
    mixed = {name: kinds_in(got[f"mask_{i}"]) for i, name in enumerate(names)
             if types[name] == T.StringType() and len(kinds_in(got.get(f"mask_{i}") or 0)) > 1}
    rows = staged.select(*(_named(name).cast(types[name]).alias(name) for name in names))
    return Inferred(rows, mixed, staged, file_column)
