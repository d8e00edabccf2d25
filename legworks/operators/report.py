"""Report tables behind the charts: wide pivots and percent-of-group mixes.

All of them aggregate the legs once at ``(key, cluster)`` grain; labelling,
top-N selection, percentages and pivots then run on that small table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legworks.operators.recovery import cluster_grain, label_grain, recovery_regimes
from legworks.schema import REGIME_ORDER


def regimes_by_year_wide(clustered: DataFrame, statuses: Sequence[str] = REGIME_ORDER,
                         fraction: float = 0.10) -> DataFrame:
    """Flights per year (rows) and regime (columns); a regime absent in a year
    stays NULL (no fill), as the stacked-area view expects."""
    long = recovery_regimes(clustered, fraction)
    return long.groupBy("YEAR").pivot("recovery_status", list(statuses)).agg(F.sum("count"))


def regime_mix(clustered: DataFrame, key: str, top_n: int = 10,
               statuses: Sequence[str] = REGIME_ORDER, fraction: float = 0.10) -> DataFrame:
    """For the ``top_n`` most frequent non-NULL ``key`` values (ties by key):
    percent of the key's flights in each regime, one column per regime (0 when
    absent)."""
    # labels come from every flight (NULL keys included), then NULL keys drop
    labelled = label_grain(cluster_grain(clustered, [key]), fraction)
    per = (labelled.where(F.col(key).isNotNull())
           .groupBy(key, "recovery_status").agg(F.sum("_n").alias("n")))
    # the top keys by a top-k over one row per key; Spark keeps n rows of each task
    totals = per.groupBy(key).agg(F.sum("n").alias("_total"))
    top = totals.orderBy(F.col("_total").desc(), F.col(key).asc()).limit(top_n)
    pct = per.join(top, key).withColumn("pct", 100 * F.col("n") / F.col("_total"))
    wide = pct.groupBy(key).pivot("recovery_status", list(statuses)).agg(F.first("pct"))
    return wide.fillna(0.0, subset=list(statuses))


def carrier_regime_mix(clustered: DataFrame, top_n: int = 10, **kw) -> DataFrame:
    return regime_mix(clustered, "OP_UNIQUE_CARRIER", top_n, **kw)


def airport_regime_mix(clustered: DataFrame, top_n: int = 10, **kw) -> DataFrame:
    return regime_mix(clustered, "ORIGIN", top_n, **kw)


def profile(df: DataFrame, flag: str, features: Sequence[str], count: str | None = None
            ) -> DataFrame:
    """Mean and sample std of each feature per value of ``flag``, and its rows as ``count`` if
    named — one aggregation pass for all groups."""
    aggs = [F.avg(f).alias(f"{f}_mean") for f in features] + [
        F.stddev_samp(f).alias(f"{f}_std") for f in features]
    return df.groupBy(flag).agg(*aggs, *([F.count(F.lit(1)).alias(count)] if count else []))
