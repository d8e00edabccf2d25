"""Delay recovery: do delayed flights make up time en route?

Pipeline: ``delayed_flights`` → a ``cluster`` column (k-means or any rule) →
regime labels per cluster → yearly / airport / cause summaries.

Scale design
------------
* The regime label depends on per-cluster means over *all* delayed flights,
  so labelled summaries first aggregate the legs at ``(key…, cluster)`` grain
  and derive the label with a per-cluster window over that small aggregate.
  The fact table is scanned once and never joined.
* Year-level distribution measures (top-decile share, Gini, median) work on a
  ``(YEAR, ARR_DELAY, n)`` histogram: delays are whole minutes bounded by the
  filter, so each year window sorts a few hundred rows instead of a year of
  flights in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legworks.functions.columns import fraction_if, row_sum, safe_div
from legworks.operators.stats import running_totals, value_histogram
from legworks.schema import (CAUSE_COLUMNS, DELAY_WORSENED, NOT_ACHIEVED,
                             RECOVERY_ACHIEVED, TAXI_COLUMNS)

# Columns kept for the recovery study.
BASE_COLUMNS = ["YEAR", "ORIGIN", "OP_UNIQUE_CARRIER", "DEP_DELAY", "ARR_DELAY",
                "TAXI_OUT", "TAXI_IN", "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY",
                "LATE_AIRCRAFT_DELAY", "SECURITY_DELAY", "CANCELLED", "DIVERTED"]
# Delay components averaged per regime: the five causes and the two taxi times.
MIX_COLUMNS = CAUSE_COLUMNS + TAXI_COLUMNS
LABELLED_COLUMNS = ["YEAR", "ORIGIN", "OP_UNIQUE_CARRIER", "DEP_DELAY", "ARR_DELAY",
                    "DELAY_CHANGE", "cluster", "recovery_status"]
DEFAULT_YEARS = (2003, 2013, 2015, 2025)

# --------------------------------------------------------------------- filter

def delayed_flights(legs: DataFrame, min_dep_delay: float = 10.0,
                    min_arr_delay: float = -15.0, max_delay: float = 360.0,
                    columns: Sequence[str] = BASE_COLUMNS) -> DataFrame:
    """Completed flights that left late (strictly > ``min_dep_delay``), trimmed.

    Keeps ``min_arr_delay <= ARR_DELAY <= max_delay`` and ``DEP_DELAY <= max_delay``
    and adds ``DELAY_CHANGE = ARR_DELAY - DEP_DELAY`` (negative = time recovered).
    """
    dep, arr = F.col("DEP_DELAY"), F.col("ARR_DELAY")
    return (legs.select(*columns)
            .where((F.col("CANCELLED") == 0) & (F.col("DIVERTED") == 0) & (dep > min_dep_delay))
            .where(arr >= min_arr_delay)
            .where((dep <= max_delay) & (arr <= max_delay))
            .dropna(subset=["DEP_DELAY", "ARR_DELAY"])
            .withColumn("DELAY_CHANGE", arr - dep))


def bucket_clusters(df: DataFrame, value: str = "DELAY_CHANGE",
                    edges: Sequence[float] = (-10.0, 10.0),
                    inclusive: Sequence[bool] = (True, False),
                    out: str = "cluster") -> DataFrame:
    """Deterministic rule clusters: bucket ``i`` holds ``x <= edges[i]`` (or ``<``
    when ``inclusive[i]`` is false) not caught by an earlier bucket; the rest get
    ``len(edges)``.

    A stand-in for k-means when results must be reproducible (oracle checks);
    every downstream operator accepts any integer ``cluster`` column.
    """
    x = F.col(value)
    expr = None
    for i, e in enumerate(edges):
        cond = (x <= e) if inclusive[i] else (x < e)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return df.withColumn(out, expr.otherwise(F.lit(len(edges))))


# --------------------------------------------------------------------- labels

def regime_label(dep_mean: Column, change_mean: Column, fraction: float = 0.10) -> Column:
    """Recovery regime of a cluster from its mean departure delay and mean change.

    The threshold is ``fraction`` of the mean departure delay; recovering at least
    that much is *achieved*, losing at least that much is *worsened*.
    """
    threshold = dep_mean * fraction
    return (F.when(change_mean <= -threshold, F.lit(RECOVERY_ACHIEVED))
            .when(change_mean >= threshold, F.lit(DELAY_WORSENED))
            .otherwise(F.lit(NOT_ACHIEVED)))


def cluster_grain(clustered: DataFrame, keys: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """Per ``(keys…, cluster)``: row count and the sums the label needs."""
    return clustered.groupBy(*keys, "cluster").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("DEP_DELAY").alias("_dep"),
        F.sum("ARR_DELAY").alias("_arr"),
        F.sum("DELAY_CHANGE").alias("_chg"),
        *extra)


def label_grain(grain: DataFrame, fraction: float) -> DataFrame:
    """Attach ``recovery_status`` to every row of a cluster-grain aggregate.

    The cluster means come from a window over the aggregate itself (one
    partition per cluster, a handful of rows each), so the legs are scanned
    once and nothing is joined.
    """
    per_cluster = Window.partitionBy("cluster")
    n = F.sum("_n").over(per_cluster)
    return grain.withColumn("recovery_status", regime_label(
        F.sum("_dep").over(per_cluster) / n, F.sum("_chg").over(per_cluster) / n, fraction))


def cluster_summary(clustered: DataFrame, fraction: float = 0.10) -> DataFrame:
    """Per cluster: mean DEP/ARR/CHANGE, the threshold and the regime label (k rows)."""
    return (clustered.groupBy("cluster").agg(
        F.avg("DEP_DELAY").alias("DEP_DELAY"),
        F.avg("ARR_DELAY").alias("ARR_DELAY"),
        F.avg("DELAY_CHANGE").alias("DELAY_CHANGE"))
        .withColumn("threshold", F.col("DEP_DELAY") * fraction)
        .withColumn("recovery_status",
                    regime_label(F.col("DEP_DELAY"), F.col("DELAY_CHANGE"), fraction)))


def label_regimes(clustered: DataFrame, summary: DataFrame | None = None,
                  fraction: float = 0.10, columns: Sequence[str] | None = LABELLED_COLUMNS
                  ) -> DataFrame:
    """Every flight with its cluster's regime (the per-flight labelled table).

    The summary has one row per cluster id; how it is joined is left to Spark's size
    statistics, which broadcast it for the few clusters of a k-means fit.
    """
    summary = cluster_summary(clustered, fraction) if summary is None else summary
    labels = summary.select("cluster", "recovery_status")
    out = clustered.join(labels, on="cluster", how="left")
    return out.select(*columns) if columns else out


def recovery_regimes(clustered: DataFrame, fraction: float = 0.10) -> DataFrame:
    """Flights per ``(YEAR, recovery_status)``: aggregate at cluster grain, then label."""
    return (label_grain(cluster_grain(clustered, ["YEAR"]), fraction)
            .groupBy("YEAR", "recovery_status").agg(F.sum("_n").alias("count")))


def cause_mix_absolute(clustered: DataFrame, min_arr_delay: float = 15.0,
                       components: Sequence[str] = MIX_COLUMNS, fraction: float = 0.10) -> DataFrame:
    """Mean minutes of each delay component per regime, over flights arriving
    ``>= min_arr_delay`` late (missing components count as 0).

    One pass: the cluster-grain aggregate carries both the label sums (all rows)
    and the component sums of the late subset.
    """
    late = F.col("ARR_DELAY") >= min_arr_delay
    extra = [F.count_if(late).alias("_late")] + [
        F.sum(F.when(late, F.coalesce(F.col(c), F.lit(0.0)))).alias(f"_s_{c}") for c in components]
    return mix_of_grain(cluster_grain(clustered, [], extra), components, fraction)


def mix_of_grain(grain: DataFrame, components: Sequence[str] = MIX_COLUMNS,
                 fraction: float = 0.10) -> DataFrame:
    """Mean components per regime from sums per cluster (``_late`` and ``_s_<component>``)."""
    return (label_grain(grain, fraction)
            .groupBy("recovery_status")
            .agg(F.sum("_late").alias("_late"),
                 *[F.try_divide(F.sum(f"_s_{c}"), F.sum("_late")).alias(c) for c in components])
            .where(F.col("_late") > 0).drop("_late"))


def cause_mix(clustered: DataFrame, min_arr_delay: float = 15.0,
              components: Sequence[str] = MIX_COLUMNS, fraction: float = 0.10) -> DataFrame:
    """Each component's mean as a percentage of the sum of the component means."""
    absolute = cause_mix_absolute(clustered, min_arr_delay, components, fraction)
    total = row_sum(components)
    return absolute.select("recovery_status", *[
        (safe_div(F.col(c), total) * 100).alias(f"{c}_pct") for c in components])


# ------------------------------------------------------------ yearly measures

def yearly_summary(delayed: DataFrame, years: Sequence[int] | None = DEFAULT_YEARS,
                   very_late: float = 60.0) -> DataFrame:
    """Per year: mean departure/arrival delay, exact median arrival delay and the
    fraction of flights more than ``very_late`` minutes late.

    One pass: the legs are aggregated to a ``(YEAR, ARR_DELAY)`` histogram that
    also carries the departure-delay sums; means, the fraction and the median
    (first value whose running count reaches ``ceil(n/2)``) come from it.
    """
    df = delayed if years is None else delayed.where(F.col("YEAR").isin(list(years)))
    h = df.groupBy("YEAR", "ARR_DELAY").agg(
        F.count(F.lit(1)).alias("c"), F.count("DEP_DELAY").alias("c_dep"),
        F.sum("DEP_DELAY").alias("s_dep"))
    return summary_of_histogram(h, very_late)


def summary_of_histogram(h: DataFrame, very_late: float = 60.0) -> DataFrame:
    """The yearly summary from rows per (YEAR, ARR_DELAY): c, c_dep and s_dep."""
    known = F.col("ARR_DELAY").isNotNull()
    run = Window.partitionBy("YEAR").orderBy(F.col("ARR_DELAY").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    year = Window.partitionBy("YEAR")
    c_arr = F.when(known, F.col("c")).otherwise(F.lit(0))
    h = (h.withColumn("_cum", F.sum(c_arr).over(run))
          .withColumn("_n", F.sum(c_arr).over(year)))
    n_arr = F.sum(c_arr)
    return h.groupBy("YEAR").agg(
        (F.sum("s_dep") / F.sum("c_dep")).alias("mean_dep"),
        F.try_divide(F.sum(F.col("ARR_DELAY") * F.col("c")), n_arr).alias("mean_arr"),
        F.min(F.when(known & (F.col("_cum") >= F.ceil(F.col("_n") * 0.5)), F.col("ARR_DELAY")))
        .alias("median_arr"),
        F.try_divide(F.sum(F.when(F.col("ARR_DELAY") > very_late, F.col("c")).otherwise(F.lit(0))),
                     n_arr).alias("pct_very_late"))


def _positive_histogram(delayed: DataFrame, value: str = "ARR_DELAY") -> DataFrame:
    return value_histogram(delayed.where(F.col(value) > 0), ["YEAR"], value).withColumnRenamed(value, "x")


def _histogram_measures(delayed: DataFrame, fraction: float, ties: str) -> DataFrame:
    """Per year, from one ``(YEAR, x, c)`` histogram of positive arrival delay:
    the top-``fraction`` share (NULL when ``n·fraction < 1``) and the Gini."""
    if ties not in ("range", "rows"):
        raise ValueError(f"ties must be 'range' or 'rows', got {ties!r}")
    h = _positive_histogram(delayed)
    x, c = F.col("x"), F.col("c")
    desc = Window.partitionBy("YEAR").orderBy(x.desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    asc = Window.partitionBy("YEAR").orderBy(x.asc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    year = Window.partitionBy("YEAR")
    h = (h.withColumn("_cum_n", F.sum(c).over(desc))
          .withColumn("_cum_x", F.sum(x * c).over(desc))
          .withColumn("_below", F.sum(c).over(asc) - c)
          .withColumn("_n", F.sum(c).over(year))
          .withColumn("_total", F.sum(x * c).over(year)))
    before = F.col("_cum_n") - c
    limit = F.col("_n") * F.lit(float(fraction))
    kept = before + 1 <= limit
    if ties == "range":
        # every flight tied with the last kept one counts (RANGE frame peers)
        top = F.max(F.when(kept, F.col("_cum_x") / F.col("_total")))
    else:
        take = F.least(c, F.floor(limit) - before)
        top = F.sum(F.when(kept, x * take)) / F.max("_total")
    # ranks C+1 … C+c of a value held by c flights sum to c·C + c(c+1)/2
    rank_sum = c * F.col("_below") + (c * (c + 1)) / 2
    agg = h.groupBy("YEAR").agg(top.alias("top10_delay_share"),
                                F.sum(x * rank_sum).alias("_s"), F.sum(c).alias("_n"),
                                F.sum(x * c).alias("_t"))
    n = F.col("_n")
    return agg.select("YEAR", "top10_delay_share",
                      ((2 * F.col("_s")) / (n * F.col("_t")) - (n + 1) / n).alias("gini_delay"))


def top_decile_share(delayed: DataFrame, fraction: float = 0.10, ties: str = "range") -> DataFrame:
    """Share of a year's positive arrival delay carried by its worst ``fraction`` of flights.

    Flights are ranked by delay, worst first, and rank ``r`` is kept when
    ``r <= n·fraction``.  ``ties="range"`` (default) counts every flight tied with the
    last kept one — a running sum over a RANGE frame, so the share can exceed the
    strict top-k share; ``ties="rows"`` is the strict share.  Years with fewer than
    ``1/fraction`` delayed flights give no row.
    """
    return (_histogram_measures(delayed, fraction, ties)
            .where(F.col("top10_delay_share").isNotNull()).select("YEAR", "top10_delay_share"))


def delay_gini(delayed: DataFrame) -> DataFrame:
    """Gini coefficient of positive arrival delay per year:
    ``G = 2·Σ(rank·x) / (n·Σx) − (n+1)/n`` with ascending ranks, computed exactly
    from the delay histogram (tied flights have equal ``x``)."""
    return _histogram_measures(delayed, 0.10, "range").select("YEAR", "gini_delay")


def delay_unevenness(delayed: DataFrame, fraction: float = 0.10, ties: str = "range") -> DataFrame:
    """Top-decile share and Gini side by side from one histogram pass (years
    with a top-decile share)."""
    return (_histogram_measures(delayed, fraction, ties)
            .where(F.col("top10_delay_share").isNotNull()))


def value_unevenness(rows: DataFrame, value: str, keys: Sequence[str] = ("YEAR",),
                     fraction: float = 0.10, ties: str = "range", tasks: int | None = None
                     ) -> DataFrame:
    """Top-``fraction`` share and Gini coefficient of any positive ``value`` per key: ``top_share``
    (NULL when ``n·fraction < 1``) and ``gini``.

    The measures of ``delay_unevenness`` for values that aren't whole minutes: with a
    distinct value per row a histogram is as long as a year, so the ranks come from
    ``running_totals`` over ranges of values, and no key's values meet in one task.
    """
    if ties not in ("range", "rows"):
        raise ValueError(f"ties must be 'range' or 'rows', got {ties!r}")
    one = F.lit(1)
    run = running_totals(rows.where(F.col(value) > 0), keys, value,
                         {"n": one, "x": F.col(value).cast("double")}, tasks)
    n, x, below = F.col("n"), F.col("x"), F.col("n_below")
    above = F.col("n_total") - below - n
    limit = F.col("n_total") * F.lit(float(fraction))
    kept = above + 1 <= limit
    if ties == "range":
        # what a value's peers and all larger ones add up to
        top = F.max(F.when(kept, (F.col("x_total") - F.col("x_below")) / F.col("x_total")))
    else:
        take = F.least(n, F.floor(limit) - above)
        top = F.sum(F.when(kept, F.col(value) * take)) / F.max("x_total")
    # the ranks of n peers sum to n·below + n(n+1)/2
    rank_sum = n * below + (n * (n + 1)) / 2
    count, total = F.max("n_total"), F.max("x_total")
    return run.groupBy(*keys).agg(
        top.alias("top_share"),
        ((2 * F.sum(F.col(value) * rank_sum)) / (count * total) - (count + 1) / count).alias("gini"))


def delay_volatility(delayed: DataFrame, two_hours: float = 120.0,
                     four_hours: float = 240.0) -> DataFrame:
    """Per year: mean, sample std, fractions beyond 2h / 4h, coefficient of variation."""
    arr = F.col("ARR_DELAY")
    return (delayed.groupBy("YEAR").agg(
        F.avg(arr).alias("mean"),
        F.stddev_samp(arr).alias("std"),
        fraction_if(arr > two_hours).alias("pct_2hr"),
        fraction_if(arr > four_hours).alias("pct_4hr"))
        .withColumn("cv", safe_div(F.col("std"), F.col("mean"))))


# ------------------------------------------------------------ airport measures

def airport_concentration(delayed: DataFrame, top_n: int = 10) -> DataFrame:
    """Share of each year's total arrival delay (early arrivals included, as
    negative minutes) produced at the ``top_n`` origins with the most delay."""
    per_airport = delayed.groupBy("YEAR", "ORIGIN").agg(F.sum("ARR_DELAY").alias("total_delay"))
    w = Window.partitionBy("YEAR").orderBy(F.col("total_delay").desc(), F.col("ORIGIN").asc())
    ranked = per_airport.withColumn("_rank", F.row_number().over(w))
    top = F.when(F.col("_rank") <= top_n, F.col("total_delay")).otherwise(F.lit(0.0))
    return ranked.groupBy("YEAR").agg(
        safe_div(F.sum(top), F.sum("total_delay")).alias("top10_airport_delay_share"))


def airport_contribution(delayed: DataFrame, top_n: int = 10,
                         years: Sequence[int] | None = None) -> DataFrame:
    """The ``top_n`` origins per year by share of the year's positive arrival delay."""
    df = delayed.where(F.col("ARR_DELAY") > 0)
    if years is not None:
        df = df.where(F.col("YEAR").isin(list(years)))
    per_airport = df.groupBy("YEAR", "ORIGIN").agg(F.sum("ARR_DELAY").alias("airport_delay"))
    year = Window.partitionBy("YEAR")
    w = Window.partitionBy("YEAR").orderBy(F.col("delay_share").desc(), F.col("ORIGIN").asc())
    return (per_airport
            .withColumn("total_delay", F.sum("airport_delay").over(year))
            .withColumn("delay_share", safe_div(F.col("airport_delay"), F.col("total_delay")))
            .withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= top_n))
