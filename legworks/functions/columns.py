"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: leading date of an on-time FL_DATE string, "M/d/yyyy[ hh:mm:ss AM]".
FL_DATE_PREFIX = r"^(\d{1,2}/\d{1,2}/\d{4})"
FL_DATE_FORMAT = "M/d/yyyy"
MINUTES_PER_DAY = 24 * 60


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_double(c: str | Column, default: float | None = None) -> Column:
    """Blank or unparsable string → NULL (or ``default``), else double.

    ``try_cast`` keeps ANSI mode on: a bad value becomes NULL instead of an error.
    Numeric inputs pass straight through the cast.
    """
    expr = F.nullif(col_(c).cast("string"), F.lit("")).try_cast("double")
    return expr if default is None else F.coalesce(expr, F.lit(float(default)))


def parse_flight_date(c: str | Column) -> Column:
    """``M/d/yyyy[ time]`` string → DATE; blank or malformed → NULL."""
    return F.try_to_date(F.regexp_extract(col_(c), FL_DATE_PREFIX, 1), FL_DATE_FORMAT)


def hhmm_to_minutes(c: str | Column) -> Column:
    """Clock time written ``hhmm`` (int) → minutes after midnight (int)."""
    t = col_(c)
    return (F.floor(t / 100) * 60 + t % 100).cast("int")


def roll_past_midnight(arr_minutes: Column, dep_minutes: Column) -> Column:
    """Arrival clock earlier than departure means the next day: add 1440."""
    return F.when(arr_minutes < dep_minutes, arr_minutes + MINUTES_PER_DAY).otherwise(arr_minutes)


def safe_div(num: Column, den: Column) -> Column:
    """ANSI-safe division: NULL when the denominator is 0 or NULL."""
    return F.try_divide(num, den)


def fraction_if(cond: Column) -> Column:
    """Mean of a 0/1 indicator (a fraction, 0..1)."""
    return F.avg(F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0)))


def row_sum(cols: Iterable[str | Column], null_as_zero: bool = False) -> Column:
    parts = [col_(c) for c in cols]
    if null_as_zero:
        parts = [F.coalesce(p, F.lit(0.0)) for p in parts]
    return reduce(add, parts)


def safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation that is NULL (not an ANSI error) for a constant column."""
    return F.try_divide(F.covar_samp(col_(x), col_(y)),
                        F.stddev_samp(col_(x)) * F.stddev_samp(col_(y)))


def path_text(path: str | Column, sep: str = " -> ") -> Column:
    """``A -> B -> C`` text of a path array; NULL stays NULL (no path)."""
    p = col_(path)
    return F.when(p.isNotNull(), F.concat_ws(sep, p))
