"""Partition-invariant random variates.

``rand(seed)`` depends on how rows fall into partitions, so the same seed gives
different data on 4 and on 400 executors.  Here every variate is a pure
function of (row id, seed, salt): a uniform from the first 32 bits of an MD5
digest.  Any engine with MD5 reproduces it, which makes generated data
checkable against SQL.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def hash_uniform(id_col: Column | str, salt: str, seed: int, slot: int = 0) -> Column:
    """Uniform in (0, 1) from 32 bits of md5("id:seed:salt").

    A digest has 128 bits, so ``slot`` 0-3 selects one of four independent
    uniforms (hex digits 8*slot+1 .. 8*slot+8): (bits + 0.5) / 2^32.  Columns
    that share a salt share the digest; Spark's subexpression elimination
    computes it once per row.
    """
    if not 0 <= slot <= 3:
        raise ValueError("slot must be 0..3")
    idc = F.col(id_col) if isinstance(id_col, str) else id_col
    key = F.concat(idc.cast("string"), F.lit(f":{seed}:{salt}"))
    bits = F.conv(F.substring(F.md5(key), 1 + 8 * slot, 8), 16, 10).cast("bigint")
    return (bits.cast("double") + 0.5) / F.lit(TWO_POW_32)


def uniform_int(u: Column, low: int, high: int) -> Column:
    """Integer uniform in [low, high) from a uniform ``u``."""
    return (F.lit(low) + F.floor(u * float(high - low))).cast("int")


def standard_normal(u1: Column, u2: Column) -> Column:
    """N(0, 1) by the Box-Muller transform of two independent uniforms."""
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def lognormal(u1: Column, u2: Column, mu: float, sigma: float) -> Column:
    return F.exp(F.lit(mu) + F.lit(sigma) * standard_normal(u1, u2))


def cumulative(weights: Sequence[float]) -> list[float]:
    """Cumulative weights, rounded so 0.2 + 0.25 is 0.45 and not 0.45000000000000007."""
    total, out = 0.0, []
    for w in weights:
        total = round(total + w, 12)
        out.append(total)
    return out


def weighted_choice(u: Column, values: Sequence[str], weights: Sequence[float]) -> Column:
    """Pick ``values[i]`` with probability ``weights[i]`` using a uniform ``u``."""
    if len(values) != len(weights) or not values:
        raise ValueError("values and weights must be non-empty and of equal length")
    bounds = cumulative(weights)
    expr = F.when(u < F.lit(bounds[0]), F.lit(values[0]))
    for value, bound in zip(values[1:-1], bounds[1:-1]):
        expr = expr.when(u < F.lit(bound), F.lit(value))
    return expr.otherwise(F.lit(values[-1]))
