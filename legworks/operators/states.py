"""Reports kept up to date month by month: mergeable partial states of the legs.

``land_states`` writes, for every month that its legs have, the sums, histograms, day masks and
sketches from which the yearly and route reports follow.  A month that is landed again replaces
its own states and nothing else; a report merges the states of the months it covers and never
reads the legs.

States per month, each a partitioned Parquet table under one folder:

* ``regimes``: rows and sums per cluster, and the delay components of its late flights;
* ``delays``: a histogram of arrival delays with the sums of departure delays;
* ``routes``: per route the flights, sums and squares, the carriers, a mask of its days
  (days of different months never meet, so masks are or-ed within a month and their bits
  added across months: exact distinct days without a distinct aggregate) and a KLL
  sketch of its arrival delays (mergeable, for delays of any precision);
* ``route_delays``: a histogram of arrival delays per route, for exact quantiles.

Size: a month's states are bounded by clusters, distinct delays, routes and routes times distinct
delays, not by its flights.  Each state is one aggregate with map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from legworks.functions.columns import safe_div
from legworks.operators import recovery as R
from legworks.operators.routes import ROUTE_KEYS, schedule_minutes
from legworks.sources.legs import land_parquet

MONTH = ["YEAR", "MONTH"]
STATES = ("regimes", "delays", "routes", "route_delays")
SKETCH_K = 4096            # of the KLL sketches: rank errors of about 0.1 %, exact up to k values


def regime_state(clustered: DataFrame, min_arr_delay: float = 15.0,
                 components: Sequence[str] = R.MIX_COLUMNS) -> DataFrame:
    """Per month and cluster: rows and sums of all flights, and component sums of the late ones."""
    late = F.col("ARR_DELAY") >= min_arr_delay
    return R.cluster_grain(clustered, MONTH, [F.count_if(late).alias("_late")] + [
        F.sum(F.when(late, F.coalesce(F.col(c), F.lit(0.0)))).alias(f"_s_{c}")
        for c in components])


def delay_state(delayed: DataFrame) -> DataFrame:
    """Per month and arrival delay: flights, and the count and sum of their departure delays."""
    return delayed.groupBy(*MONTH, "ARR_DELAY").agg(
        F.count(F.lit(1)).alias("c"), F.count("DEP_DELAY").alias("c_dep"),
        F.sum("DEP_DELAY").alias("s_dep"))


def route_state(flights: DataFrame) -> DataFrame:
    """Per month, route and month of the service date (the landed month, unless dates are off)."""
    x = F.col("arr_delay")
    # a date that is missing counts as a flight, and as no day
    mask = F.expr("shiftleft(1, day(date) - 1)")
    return (flights.withColumn("served", F.year("date") * 12 + F.month("date"))
            .groupBy(*MONTH, *ROUTE_KEYS, "served").agg(
                F.count(F.lit(1)).alias("flight_count"), F.bit_or(mask).alias("days"),
                F.collect_set("carrier").alias("carriers"),
                F.sum("flight_time").cast("double").alias("s_time"),
                F.count("flight_time").alias("c_time"),
                F.count(x).alias("c_delay"), F.sum(x).alias("s_delay"), F.sum(x * x).alias("ss_delay"),
                F.kll_sketch_agg_double(x.cast("double"), SKETCH_K).alias("sketch")))


def route_delay_state(flights: DataFrame) -> DataFrame:
    return (flights.where(F.col("arr_delay").isNotNull())
            .groupBy(*MONTH, *ROUTE_KEYS, "arr_delay").agg(F.count(F.lit(1)).alias("c")))


def land_states(legs: DataFrame, path: str, cluster: Sequence[float] = (-10.0, 10.0),
                columns: Sequence[str] = R.BASE_COLUMNS) -> str:
    """Write the states of the months in ``legs``; other months keep theirs.  Returns ``path``.

    ``legs`` must hold whole months.  ``cluster``: edges of the rule clusters (``bucket_clusters``),
    the same for all months, so that months can be added up.  A month without a row for a
    state gets an empty one, so that what it had before is replaced, too.
    """
    months = legs.select(*MONTH).distinct()
    delayed = R.delayed_flights(legs, columns=list(dict.fromkeys([*columns, "MONTH"])))
    flights = schedule_minutes(legs, keep=MONTH)
    made = {"regimes": regime_state(R.bucket_clusters(delayed, edges=cluster)),
            "delays": delay_state(delayed), "routes": route_state(flights),
            "route_delays": route_delay_state(flights)}
    for name in STATES:
        rows = made[name].unionByName(months, allowMissingColumns=True)
        land_parquet(rows, f"{path.rstrip('/')}/{name}", MONTH, gather=True)
    return path


def read_state(spark: SparkSession, path: str, name: str, years: Sequence[int] | None = None
               ) -> DataFrame:
    """A state's rows; ``years`` prunes partitions."""
    if name not in STATES:
        raise ValueError(f"name must be one of {STATES}, not {name!r}")
    rows = spark.read.parquet(f"{path.rstrip('/')}/{name}")
    if years is not None:
        rows = rows.where(F.col("YEAR").isin(list(years)))
    filled = {"regimes": "_n", "delays": "c", "routes": "flight_count", "route_delays": "c"}
    return rows.where(F.col(filled[name]).isNotNull())


# ------------------------------------------------------------------- reports

def _added(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    sums = [c for c in state.columns if c.startswith("_")]
    return state.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def recovery_regimes(state: DataFrame, fraction: float = 0.10) -> DataFrame:
    """``recovery.recovery_regimes`` from the ``regimes`` states."""
    grain = _added(state, ["YEAR", "cluster"])
    return (R.label_grain(grain, fraction).groupBy("YEAR", "recovery_status")
            .agg(F.sum("_n").alias("count")))


def cause_mix_absolute(state: DataFrame, components: Sequence[str] = R.MIX_COLUMNS,
                       fraction: float = 0.10) -> DataFrame:
    """``recovery.cause_mix_absolute`` from the ``regimes`` states."""
    return R.mix_of_grain(_added(state, ["cluster"]), components, fraction)


def yearly_summary(state: DataFrame, very_late: float = 60.0) -> DataFrame:
    """``recovery.yearly_summary`` from the ``delays`` states."""
    return R.summary_of_histogram(state.groupBy("YEAR", "ARR_DELAY").agg(
        F.sum("c").alias("c"), F.sum("c_dep").alias("c_dep"), F.sum("s_dep").alias("s_dep")),
        very_late)


def delay_volatility(state: DataFrame, two_hours: float = 120.0, four_hours: float = 240.0
                     ) -> DataFrame:
    """``recovery.delay_volatility`` from the ``delays`` states: moments of the histogram."""
    x, c = F.col("ARR_DELAY"), F.col("c")
    year = Window.partitionBy("YEAR")
    # squares around the mean, of a row per distinct delay
    rows = state.groupBy("YEAR", "ARR_DELAY").agg(F.sum("c").alias("c")).withColumn(
        "_mean", F.sum(x * c).over(year) / F.sum(c).over(year))
    share = lambda limit: F.sum(F.when(x > limit, c).otherwise(0)) / F.sum(c)
    return (rows.groupBy("YEAR").agg(
        F.first("_mean").alias("mean"),
        F.sqrt(safe_div(F.sum(c * (x - F.col("_mean")) ** 2), F.nullif(F.sum(c) - 1, F.lit(0))))
        .alias("std"), share(two_hours).alias("pct_2hr"), share(four_hours).alias("pct_4hr"))
        .withColumn("cv", safe_div(F.col("std"), F.col("mean"))))


def _days(mask: str) -> Column:
    return F.sum(F.bit_count(mask)).cast("long")


def direct_routes(state: DataFrame, delays: DataFrame | None = None, quantile: float = 0.9
                  ) -> DataFrame:
    """``routes.direct_routes`` from the ``routes`` states.

    The quantile is exact with ``delays``, the ``route_delays`` states, and that of the merged
    sketches without them.
    """
    # a route's days: masks of one month are or-ed, the bits of different months added
    monthly = state.groupBy(*ROUTE_KEYS, "served").agg(
        F.bit_or("days").alias("days"), F.flatten(F.collect_list("carriers")).alias("carriers"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
        *[F.sum(c).alias(c) for c in ("flight_count", "s_time", "c_time", "c_delay", "s_delay",
                                      "ss_delay")])
    n, s = F.sum("c_delay"), F.sum("s_delay")
    routes = monthly.groupBy(*ROUTE_KEYS).agg(
        F.sum("flight_count").alias("flight_count"), _days("days").alias("days_with_service"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("carriers")))).alias("carriers"),
        F.try_divide(F.sum("s_time"), F.sum("c_time")).alias("avg_flight_time"),
        F.try_divide(s, n).alias("avg_delay"),
        F.when(n > 1, F.sqrt(F.greatest(F.sum("ss_delay") - s * s / n, F.lit(0.0)) / (n - 1)))
        .otherwise(0.0).alias("std_delay"),
        F.kll_sketch_get_quantile_double(F.kll_merge_agg_double("sketch"), F.lit(float(quantile)))
        .alias("p90_delay"))
    if delays is not None:
        at = Window.partitionBy(*ROUTE_KEYS)
        upto = at.orderBy("arr_delay").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counted = delays.groupBy(*ROUTE_KEYS, "arr_delay").agg(F.sum("c").alias("c"))
        exact = (counted.withColumn("upto", F.sum("c").over(upto))
                 .withColumn("n", F.sum("c").over(at))
                 .where(F.col("upto") >= F.ceil(F.col("n") * F.lit(float(quantile))))
                 .groupBy(*ROUTE_KEYS).agg(F.min("arr_delay").alias("p90_delay")))
        routes = routes.drop("p90_delay").join(exact, ROUTE_KEYS, "left")
    total = state.groupBy("served").agg(F.bit_or("days").alias("days")).select(
        _days("days")).scalar()
    return (routes.withColumn("_total", total)
            .select(*ROUTE_KEYS, "flight_count", "days_with_service",
                    F.size("carriers").cast("long").alias("num_carriers"), "carriers",
                    "avg_flight_time", "avg_delay", "std_delay", "p90_delay",
                    (F.col("avg_flight_time") + F.col("avg_delay") + F.col("std_delay"))
                    .alias("reliability_score"),
                    F.round(safe_div(F.col("days_with_service"), F.col("_total")) * 100, 1)
                    .alias("availability_pct")))


def route_quantiles(state: DataFrame, quantiles: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """Quantiles of each route's arrival delays over any span of states, from merged sketches:
    ``flight_count`` and a column ``p50``, ``p90``, … each."""
    merged = state.groupBy(*ROUTE_KEYS).agg(F.sum("flight_count").alias("flight_count"),
                                            F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(*ROUTE_KEYS, "flight_count", *[
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(f"p{round(100 * q)}")
        for q in quantiles])
