"""Exact sums and means of doubles: no digit is lost, no row order shows, nothing overflows.

``sum(double)`` depends on the order rows are added, so the same query can differ in
the last bits between runs and partitionings.  Here a double is cut into seven signed
digits of 24 bits, from 2^59 down to 2^-108 (a fixed-width superaccumulator).  Digits of
one weight add up as ``bigint`` without overflow for 2^40 rows of a group, partial sums
merge like any sum, and the total is rounded to a double once: it equals
``math.fsum``, whatever the order, the partitioning and the magnitudes.

Amounts mean decimals: where every value of a group is a double nearest to a whole
10^-scale, the total is the double nearest to their decimal sum, e.g. 0.1 + 0.1 + 0.1 =
0.3 (``math.fsum`` gives 0.30000000000000004).  Such totals need no carrying: a plain
weighted sum of the digits is near enough to be rounded to ``scale`` decimals.

Values of 2^59 and more, infinities, and what lies below 2^-108 of values below 2^-55 are
added as plain doubles beside the digits; their sum alone is settled to ``SETTLED_DIGITS``
significant digits, so that its order cannot show.  NaN counts as missing, like null; ``profile_null_counts``
reports both.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGIT = 24
#: The exponents of the digits' weights.
WEIGHTS = tuple(range(36, -109, -DIGIT))
#: Whole numbers have no digits below 2^-12.
WHOLE_WEIGHTS = WEIGHTS[:3]
LARGEST = 2.0**59
SETTLED_DIGITS = 13


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Parts:
    """The addends of a value, or their sums: its digits, what lies outside them, and how
    many values are no whole units."""
    digits: tuple[Column, ...]
    rest: Column
    odd: Column

    def map(self, f: Callable[[Column], Column]) -> Parts:
        return Parts(tuple(f(d) for d in self.digits), f(self.rest), f(self.odd))

    def with_parts(self, other: Parts, f: Callable[[Column, Column], Column]) -> Parts:
        """Part by part; both have digits of the same weights."""
        pairs = zip(self.digits, other.digits, strict=True)
        return Parts(tuple(f(a, b) for a, b in pairs), f(self.rest, other.rest), f(self.odd, other.odd))

    def columns(self, prefix: str) -> list[Column]:
        named = [d.alias(f"{prefix}_d{i}") for i, d in enumerate(self.digits)]
        return [*named, self.rest.alias(f"{prefix}_rest"), self.odd.alias(f"{prefix}_odd")]


def stored_parts(prefix: str, whole: bool = False) -> Parts:
    """The columns that ``Parts.columns(prefix)`` made."""
    weights = WHOLE_WEIGHTS if whole else WEIGHTS
    return Parts(tuple(F.col(f"{prefix}_d{i}") for i in range(len(weights))), F.col(f"{prefix}_rest"), F.col(f"{prefix}_odd"))


def parts(c: Column | str, scale: int, whole: bool = False) -> Parts:
    """The addends of each value; all null where it is null or NaN.  ``whole`` says that
    the column is of an integer type, whose values have fewer digits.

    For a column's name the expressions are one SQL text each: a query with many sums
    is then built several times faster than from ``Column`` calls.
    """
    weights = WHOLE_WEIGHTS if whole else WEIGHTS
    if isinstance(c, str):
        x = f"nanvl(cast({'.'.join(_quoted(part) for part in c.split('.'))} as double), cast(null as double))"
        held = f"if(abs({x}) < {LARGEST!r}D, {x}, null)"
        multiples = [f"rint({held} * {2.0**-w!r}D)" for w in weights]
        digits = [multiples[0], *(f"{m} - {before} * {2.0**DIGIT!r}D" for before, m in zip(multiples, multiples[1:]))]
        unit = float(10**scale)
        return Parts(
            tuple(F.expr(f"cast({d} as bigint)") for d in digits),
            F.expr(f"{x} - coalesce({multiples[-1]} * {2.0**weights[-1]!r}D, 0D)"),
            F.expr(f"cast({x} != rint({x} * {unit!r}D) / {unit!r}D as bigint)"),
        )
    value = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    held = F.when(F.abs(value) < LARGEST, value)
    # whole multiples of each weight; a digit is what the next one has more
    multiples = [F.rint(held * 2.0**-w) for w in weights]
    digits = [multiples[0], *(m - before * 2.0**DIGIT for before, m in zip(multiples, multiples[1:]))]
    unit = float(10**scale)
    return Parts(
        tuple(d.cast("bigint") for d in digits),
        value - F.coalesce(multiples[-1] * 2.0**weights[-1], F.lit(0.0)),
        (value != F.rint(value * unit) / unit).cast("bigint"),
    )


def _quoted(name: str) -> str:
    return name if name.startswith("`") else f"`{name}`"


def _rounded(digits: Sequence[str]) -> str:
    """SQL of the exact sum of the digits, rounded once to the nearest double, ties to even.

    Carries go from the smallest weight up, so that every digit lies within +-2^23.
    Then digits are joined from the largest down to an integer of at least 80 bits; of
    those below only the sign of the first that is not 0 can matter, as a quarter
    of a unit.
    """
    carry = f"shiftright(d + a.carry + {1 << (DIGIT - 1)}L, {DIGIT})"
    ordered = f"""aggregate(array({', '.join(reversed(digits))}),
        named_struct('carry', 0L, 'digits', cast(array() as array<bigint>)),
        (a, d) -> named_struct('carry', {carry}, 'digits', concat(array(d + a.carry - {carry} * {1 << DIGIT}L), a.digits)),
        a -> concat(array(a.carry), a.digits))"""
    joined = f"cast(a.n * cast({1 << DIGIT} as decimal(8,0)) + cast(d as decimal(19,0)) as decimal(38,0))"
    return f"""aggregate({ordered},
        named_struct('n', cast(0 as decimal(38,0)), 'weight', {WEIGHTS[0] + 2 * DIGIT}, 'below', 0),
        (a, d) -> if(abs(a.n) < cast('{1 << 80}' as decimal(38,0)),
            named_struct('n', {joined}, 'weight', a.weight - {DIGIT}, 'below', a.below),
            named_struct('n', a.n, 'weight', a.weight, 'below', if(a.below != 0, a.below, cast(signum(d) as int)))),
        a -> cast(cast(a.n * cast(4 as decimal(1,0)) + cast(a.below as decimal(1,0)) as decimal(38,0)) as double)
            * power(2D, cast(a.weight - 2 as double)))"""


def total(summed: Parts, scale: int, count: Column | None = None) -> Column:
    """The sum of summed parts as a double, or with ``count`` their mean; null without values.

    The sums are bound once to a variable of a lambda, whose body is one SQL text, so
    that plans hold each aggregate once.
    """
    digits = [f"coalesce(s.d{i}, 0L)" for i in range(len(summed.digits))]
    near, size = (" + ".join(f"{f}({d}) * {2.0**w!r}D" for d, w in reversed(list(zip(digits, WEIGHTS)))) for f in ("double", "abs"))
    # the plain sum errs by at most 7 roundings of the sizes; a tenth of a unit is near enough
    plain = f"s.odd = 0 and {size} < {0.1 * 2.0**50 / 10**scale!r}D"
    value = f"if({plain}, round({near}, {scale}), {_rounded(digits)})"
    # what lies outside the digits, at SETTLED_DIGITS significant digits, so that its order cannot show
    outside = f"try_cast(format_string('%.{SETTLED_DIGITS - 1}e', s.rest) as double)"
    body = f"case when s.rest is null then null when s.rest = 0 then {value} else {value} + {outside} end"
    fields = [d.alias(f"d{i}") for i, d in enumerate(summed.digits)]
    fields += [summed.rest.alias("rest"), summed.odd.alias("odd")]
    if count is not None:
        fields.append(count.alias("n"))
        body = f"try_divide({body}, s.n)"
    return F.call_function("transform", F.array(F.struct(*fields)), F.expr(f"s -> {body}"))[0]


def money_sum(c: Column | str, scale: int = 2) -> Column:
    """Sum of an amount column: the decimal sum of amounts of at most ``scale`` decimals,
    else the exactly rounded sum of the doubles."""
    return total(parts(c, scale).map(F.sum), scale)


MEAN_SCALE = 6


def exact_mean(c: Column | str, scale: int = MEAN_SCALE, whole: bool = False) -> Column:
    """Mean of the non-missing values: their exact sum, rounded, over their number.

    A double ``avg`` adds in partition order, so a mean lying on a rounding tie can
    round either way depending on how rows are split; here it cannot.
    """
    p = parts(c, scale, whole)
    return total(p.map(F.sum), scale, F.count(p.rest))


def round_half_even(x: Column, scale: int) -> Column:
    """x rounded to ``scale`` decimals as Python's ``round`` does: by the double's binary
    value, exact ties to even.

    At scale 1 the side of the middle m = (2k + 1) / 20 is the sign of 20x - 2k - 1,
    which 16x - (2k + 1) + 4x gives without rounding: both products are exact, and
    each difference is of numbers within a factor 2.  Other scales use Spark's
    ``bround``, by the shortest decimal of the double.
    """
    if scale != 1:
        return F.bround(x, scale)
    a = F.abs(x)
    k = F.floor(a * 10.0).cast("double")
    side = (a * 16.0 - (k * 2.0 + 1.0)) + a * 4.0
    near = F.abs(side) < 0.5
    up = (side > 0) | ((side == 0) & (k % 2 == 1))
    exact = F.when(up, k + 1.0).otherwise(k) / 10.0
    # away from the middle, and past the doubles that have decimals, any rounding agrees
    return F.when((a < 1e14) & near, exact * F.signum(x)).otherwise(F.bround(x, 1))
