"""Delay propagation: how much of a departure delay is new, and how much was
inherited from the same aircraft's previous leg that day?

``EXTRA_DELAY`` of a leg is ``max(DEP_DELAY − previous same-day ARR_DELAY, 0)``
when the aircraft flew earlier that day, else ``max(DEP_DELAY, 0)``.  An early
previous arrival (negative delay) therefore *raises* the extra delay.

Scale design
------------
Only a previous leg on the *same date* changes the result, so the window is
partitioned by ``(TAIL_NUM, FL_DATE_DT)`` instead of ``TAIL_NUM``: identical
output, but a window partition holds one aircraft-day (a handful of legs).  A
tail carrying a third of all rows — or the NULL tail, which the source uses
for unknown aircraft — is spread over its days instead of one task sorting it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legworks.functions.columns import clean_double, parse_flight_date, safe_corr, safe_div
from legworks.operators.stats import top_k_per_group
from legworks.schema import PROPAGATION_CAUSES

# Numeric features of the propagation study (blank → 0).
FEATURE_COLUMNS = ["DEP_DELAY", "ARR_DELAY", "DISTANCE", "AIR_TIME"] + PROPAGATION_CAUSES
DEFAULT_YEARS = (2005, 2010, 2015, 2020, 2025)


def _numeric(df: DataFrame, name: str, default: float | None) -> F.Column:
    """Clean one input column to double; strings go through blank→NULL→try_cast."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return clean_double(name, default)
    c = F.col(name).cast("double")
    return c if default is None else F.coalesce(c, F.lit(float(default)))


def clean_legs(legs: DataFrame, date_col: str = "FL_DATE", dep_time_col: str = "DEP_TIME",
               arr_time_col: str = "ARR_TIME", features: Sequence[str] = FEATURE_COLUMNS,
               keep: Sequence[str] = ()) -> DataFrame:
    """Completed legs with numeric features cleaned (missing → 0.0), clock times
    as doubles (missing → NULL, row dropped) and ``FL_DATE_DT`` parsed from the
    ``M/d/yyyy`` text (unparsable → NULL, row kept)."""
    cols = [_numeric(legs, c, 0.0).alias(c) for c in features]
    cols += [_numeric(legs, arr_time_col, None).alias("ARR_TIME"),
             _numeric(legs, dep_time_col, None).alias("DEP_TIME"),
             F.col("CANCELLED"), F.col("DIVERTED"), F.col("TAIL_NUM"), F.col("ORIGIN"),
             parse_flight_date(date_col).alias("FL_DATE_DT")]
    cols += [F.col(k) for k in keep]
    return (legs.select(*cols)
            .where(F.col("ARR_TIME").isNotNull() & F.col("DEP_TIME").isNotNull()
                   & (F.col("CANCELLED") == 0) & (F.col("DIVERTED") == 0)))


def extra_delay(clean: DataFrame, tie_break: Sequence[str] = (), null_tail: str = "chain",
                spread_alone: bool = True) -> DataFrame:
    """Add ``PREV_ARR_DELAY`` (same-day previous leg), ``EXTRA_DELAY`` and
    ``DELAY_RECOVERY = DEP_DELAY − ARR_DELAY``.

    Legs of an aircraft-day are ordered by numeric ``DEP_TIME`` then ``tie_break``
    (give a unique key so equal times are deterministic).  ``null_tail="chain"``
    treats legs without a tail number as one aircraft, as the source analysis
    does; ``"independent"`` gives each of them no previous leg.

    Legs that can't chain (undated ones) are dealt out by a hash of their own.
    ``spread_alone=False`` leaves that out: the window's keys are then the aircraft and day alone, by
    which a bucketed table needs no shuffle (undated legs of an aircraft lie in one bucket).
    """
    if null_tail not in ("chain", "independent"):
        raise ValueError("null_tail must be 'chain' or 'independent'")
    # a leg that can't chain needs no neighbour: it is dealt out by its own hash
    alone = F.col("FL_DATE_DT").isNull()
    if null_tail == "independent":
        alone = alone | F.col("TAIL_NUM").isNull()
    spread = F.when(alone, F.xxhash64(*clean.columns))
    keys = ["TAIL_NUM", "FL_DATE_DT", *([spread] if spread_alone else [])]
    day = Window.partitionBy(*keys).orderBy(
        F.col("DEP_TIME").asc(), *[F.col(k).asc() for k in tie_break])
    prev = F.lag(F.struct(F.lit(True).alias("has"), F.col("ARR_DELAY").alias("arr"))).over(day)
    out = clean.withColumn("_prev", prev)
    chained = F.col("_prev.has").isNotNull() & F.col("FL_DATE_DT").isNotNull()
    if null_tail == "independent":
        chained = chained & F.col("TAIL_NUM").isNotNull()
    dep = F.col("DEP_DELAY")
    return (out
            .withColumn("PREV_ARR_DELAY", F.when(chained, F.col("_prev.arr")))
            .withColumn("EXTRA_DELAY", F.when(
                chained, F.greatest(dep - F.coalesce(F.col("_prev.arr"), F.lit(0.0)), F.lit(0.0)))
                .otherwise(F.greatest(dep, F.lit(0.0))))
            .withColumn("DELAY_RECOVERY", dep - F.col("ARR_DELAY"))
            .drop("_prev"))


def cascade_stats(extra: DataFrame) -> DataFrame:
    """One row: mean, sample std, max and min of ``EXTRA_DELAY``."""
    x = F.col("EXTRA_DELAY")
    return extra.agg(F.avg(x).alias("avg_extra_delay"), F.stddev_samp(x).alias("std_extra_delay"),
                     F.max(x).alias("max_extra_delay"), F.min(x).alias("min_extra_delay"))


def cluster_impact(clustered: DataFrame, propagated_above: float = 10.0) -> DataFrame:
    """Per cluster: flights, flights with ``EXTRA_DELAY > propagated_above``, mean
    extra delay and total departure+arrival delay."""
    x = F.col("EXTRA_DELAY")
    return clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("num_flights"),
        F.count_if(x > propagated_above).alias("num_propagated"),
        F.avg(x).alias("avg_extra_delay"),
        F.sum(F.col("DEP_DELAY") + F.col("ARR_DELAY")).alias("total_delay"))


def cluster_cause_correlation(clustered: DataFrame, causes: Sequence[str] = PROPAGATION_CAUSES,
                              target: str = "EXTRA_DELAY") -> DataFrame:
    """Long table ``(cluster, feature, correlation)``: Pearson correlation of each
    cause with ``target`` inside each cluster, in one aggregation pass.  NULL for
    a constant column or a one-row cluster (no ANSI divide error)."""
    wide = clustered.groupBy("cluster").agg(
        *[safe_corr(c, target).alias(c) for c in causes])
    return wide.unpivot(["cluster"], list(causes), "feature", "correlation")


def problem_airports(extra: DataFrame, above: float = 10.0) -> DataFrame:
    """Per origin: legs with ``EXTRA_DELAY > above`` and their fraction of all such legs.

    The total comes from a window over the per-airport aggregate (one row per
    airport), not from a driver round trip.
    """
    per = (extra.where(F.col("EXTRA_DELAY") > above)
           .groupBy("ORIGIN").agg(F.count(F.lit(1)).alias("num_problem_flights")))
    total = F.sum("num_problem_flights").over(Window.partitionBy())
    return per.withColumn("fraction_problem_flights",
                          safe_div(F.col("num_problem_flights"), total))


def airport_cascade_causes(extra: DataFrame, years: Sequence[int] | None = DEFAULT_YEARS,
                           causes: Sequence[str] = PROPAGATION_CAUSES) -> DataFrame:
    """Per ``(ORIGIN, Year)``: cause sums, total extra delay, each cause's share of
    it, the airport's share of the year's extra delay and its rank (ties share).

    One aggregate + two per-year windows over it; the year filter is applied to
    the legs first (shares and ranks are within a year, so this is exact).
    Legs without a parsable date have no year and drop out.
    """
    df = extra.withColumn("Year", F.year("FL_DATE_DT")).where(
        F.col("Year").isNotNull() & F.col("ORIGIN").isNotNull())
    if years is not None:
        df = df.where(F.col("Year").isin(list(years)))
    agg = df.groupBy("ORIGIN", "Year").agg(
        *[F.sum(c).alias(c) for c in causes], F.sum("EXTRA_DELAY").alias("total_extra_delay"))
    year = Window.partitionBy("Year")
    ranked = Window.partitionBy("Year").orderBy(F.col("total_extra_delay").desc())
    return agg.select(
        "ORIGIN", "Year", *causes, "total_extra_delay",
        *[safe_div(F.col(c), F.col("total_extra_delay")).alias(f"{c}_share") for c in causes],
        safe_div(F.col("total_extra_delay"), F.sum("total_extra_delay").over(year)).alias("share"),
        F.rank().over(ranked).alias("rank"))


def airport_cause_profile(cascade: DataFrame, years: Sequence[int] | None = None, top_n: int = 10,
                          causes: Sequence[str] = PROPAGATION_CAUSES) -> DataFrame:
    """Per year, the ``top_n`` airports by extra delay with their cause shares
    rescaled to sum to 1 (the raw shares need not: causes are reported minutes)."""
    shares = [f"{c}_share" for c in causes]
    df = cascade if years is None else cascade.where(F.col("Year").isin(list(years)))
    per = (df.where(F.col("ORIGIN").isNotNull())
           .groupBy("Year", "ORIGIN").agg(*[F.avg(s).alias(s) for s in shares],
                                          F.avg("total_extra_delay").alias("total_extra_delay")))
    top = top_k_per_group(per, ["Year"], [F.col("total_extra_delay").desc(), F.col("ORIGIN").asc()],
                          top_n, rank_col="rank")
    denom = sum((F.coalesce(F.col(s), F.lit(0.0)) for s in shares[1:]),
                F.coalesce(F.col(shares[0]), F.lit(0.0)))
    return top.select("Year", "ORIGIN", "total_extra_delay", "rank",
                      *[safe_div(F.col(s), denom).alias(s) for s in shares])
