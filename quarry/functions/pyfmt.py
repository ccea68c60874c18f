"""Column expressions that print values the way the reference's Python code does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def py_float_str(x: Column) -> Column:
    """str(float(x)): 'nan', 'inf', '-inf'; integral values in [1e7, 1e16) printed without exponent.

    Spark prints other doubles like Python inside 1e-3 <= |x| < 1e7 (SURVEY 7.3).
    """
    d = x.cast("double")
    big_int = (F.abs(d) >= 1e7) & (F.abs(d) < 1e16) & (d == F.floor(d))
    return (F.when(F.isnan(d), F.lit("nan"))
            .when(d == float("inf"), F.lit("inf"))
            .when(d == float("-inf"), F.lit("-inf"))
            .when(big_int, F.concat(d.cast("decimal(17,0)").cast("string"), F.lit(".0")))
            .otherwise(d.cast("string")))


def py_str(x: Column, is_float: bool = False) -> Column:
    """str(v) of an optional value: None -> 'None'."""
    s = py_float_str(x) if is_float else x.cast("string")
    return F.coalesce(s, F.lit("None"))


def py_round_half_even(x: Column, digits: int) -> Column:
    """Python round() for ratios: bround (half to even on the printed decimal)."""
    return F.bround(x, digits)
