"""Column-level helpers; each returns a ``Column`` of Spark built-ins."""

from ledgerlens.functions.money import exact_mean, money_sum, round_half_even
from ledgerlens.functions.ordering import list_position
from ledgerlens.functions.random import (
    hash_uniform,
    lognormal,
    standard_normal,
    uniform_int,
    weighted_choice,
)

__all__ = [
    "exact_mean",
    "hash_uniform",
    "list_position",
    "lognormal",
    "money_sum",
    "round_half_even",
    "standard_normal",
    "uniform_int",
    "weighted_choice",
]
