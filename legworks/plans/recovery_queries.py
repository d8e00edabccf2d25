"""Catalogue entries for the delay-recovery family, with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from legworks.operators import recovery as R
from legworks.plans.common import CONTRIBUTION_YEARS, RECOVERY_EDGES, YEARS, legs, rounded
from legworks.plans.sqltext import in_list, sql


def _delayed(spark, sf_dir):
    return R.delayed_flights(legs(spark, sf_dir))


def _clustered(spark, sf_dir):
    return R.bucket_clusters(_delayed(spark, sf_dir), "DELAY_CHANGE", RECOVERY_EDGES)


def _delay_per_hour(spark, sf_dir):
    """Minutes late per scheduled hour, unevenly spread over a year's flights: continuous values."""
    late = R.delayed_flights(legs(spark, sf_dir), columns=[*R.BASE_COLUMNS, "CRS_ELAPSED_TIME"])
    return R.value_unevenness(late.withColumn(
        "per_hour", F.col("ARR_DELAY") * 60 / F.col("CRS_ELAPSED_TIME")), "per_hour")


QUERIES = {
    "delayed_flights": lambda s, d: rounded(_delayed(s, d)),
    "cluster_summary": lambda s, d: rounded(R.cluster_summary(_clustered(s, d))),
    "label_regimes": lambda s, d: rounded(R.label_regimes(_clustered(s, d))),
    "recovery_regimes": lambda s, d: R.recovery_regimes(_clustered(s, d)),
    "cause_mix_absolute": lambda s, d: rounded(R.cause_mix_absolute(_clustered(s, d))),
    "cause_mix": lambda s, d: rounded(R.cause_mix(_clustered(s, d))),
    "yearly_summary": lambda s, d: rounded(R.yearly_summary(_delayed(s, d), YEARS)),
    "top_decile_share": lambda s, d: rounded(R.top_decile_share(_delayed(s, d))),
    "delay_gini": lambda s, d: rounded(R.delay_gini(_delayed(s, d))),
    "delay_unevenness": lambda s, d: rounded(R.delay_unevenness(_delayed(s, d))),
    "delay_per_hour_unevenness": lambda s, d: rounded(_delay_per_hour(s, d)),
    "airport_concentration": lambda s, d: rounded(R.airport_concentration(_delayed(s, d))),
    "airport_contribution": lambda s, d: rounded(R.airport_contribution(_delayed(s, d))),
    "top_airport_contribution_years": lambda s, d: rounded(
        R.airport_contribution(_delayed(s, d), years=CONTRIBUTION_YEARS)),
    "delay_volatility": lambda s, d: rounded(R.delay_volatility(_delayed(s, d))),
}

# ----------------------------------------------------------------- oracle SQL

DELAYED = """
delayed AS (
  SELECT YEAR, ORIGIN, OP_UNIQUE_CARRIER, DEP_DELAY, ARR_DELAY, TAXI_OUT, TAXI_IN,
         CARRIER_DELAY, WEATHER_DELAY, NAS_DELAY, LATE_AIRCRAFT_DELAY, SECURITY_DELAY,
         CANCELLED, DIVERTED, ARR_DELAY - DEP_DELAY AS DELAY_CHANGE
  FROM legs
  WHERE CANCELLED = 0 AND DIVERTED = 0 AND DEP_DELAY > 10 AND ARR_DELAY >= -15
    AND DEP_DELAY <= 360 AND ARR_DELAY <= 360
)"""

CLUSTERED = """
clustered AS (
  SELECT *, CASE WHEN DELAY_CHANGE <= -10 THEN 0 WHEN DELAY_CHANGE < 10 THEN 1 ELSE 2 END AS cluster
  FROM delayed
),
summary AS (
  SELECT cluster, avg(DEP_DELAY) AS DEP_DELAY, avg(ARR_DELAY) AS ARR_DELAY,
         avg(DELAY_CHANGE) AS DELAY_CHANGE, avg(DEP_DELAY) * 0.1 AS threshold,
         CASE WHEN avg(DELAY_CHANGE) <= -(avg(DEP_DELAY) * 0.1) THEN 'Recovery Achieved'
              WHEN avg(DELAY_CHANGE) >= avg(DEP_DELAY) * 0.1 THEN 'Delay Worsened'
              ELSE 'Not Achieved' END AS recovery_status
  FROM clustered GROUP BY cluster
),
labelled AS (
  SELECT c.*, s.recovery_status FROM clustered c LEFT JOIN summary s USING (cluster)
)"""

_MIX = R.MIX_COLUMNS
DELAYED_DOUBLES = [c for c in R.BASE_COLUMNS
                   if c not in ("YEAR", "ORIGIN", "OP_UNIQUE_CARRIER")] + ["DELAY_CHANGE"]

MIX_ABS = """
mix_abs AS (
  SELECT recovery_status, {cols}
  FROM labelled WHERE ARR_DELAY >= 15 GROUP BY recovery_status
)""".format(cols=", ".join(f"avg(coalesce({c}, 0)) AS {c}" for c in _MIX))

TOP10 = """
pos AS (SELECT YEAR, ARR_DELAY FROM delayed WHERE ARR_DELAY > 0),
top10 AS (
  SELECT YEAR, max(cum_delay / total_delay) AS top10_delay_share FROM (
    SELECT YEAR,
           row_number() OVER (PARTITION BY YEAR ORDER BY ARR_DELAY DESC) AS rk,
           count(*) OVER (PARTITION BY YEAR) AS total_flights,
           sum(ARR_DELAY) OVER (PARTITION BY YEAR ORDER BY ARR_DELAY DESC
                                RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_delay,
           sum(ARR_DELAY) OVER (PARTITION BY YEAR) AS total_delay
    FROM pos) t
  WHERE rk <= total_flights * 0.1
  GROUP BY YEAR
)"""

GINI = """
gini AS (
  SELECT YEAR, max(g) AS gini_delay FROM (
    SELECT YEAR,
           (2 * sum(rk * ARR_DELAY) OVER (PARTITION BY YEAR))
             / (count(*) OVER (PARTITION BY YEAR) * sum(ARR_DELAY) OVER (PARTITION BY YEAR))
             - (count(*) OVER (PARTITION BY YEAR) + 1) / count(*) OVER (PARTITION BY YEAR) AS g
    FROM (SELECT YEAR, ARR_DELAY,
                 row_number() OVER (PARTITION BY YEAR ORDER BY ARR_DELAY) AS rk
          FROM delayed WHERE ARR_DELAY > 0) r) t
  GROUP BY YEAR
)"""


def _contribution_sql(years=None) -> str:
    year_filter = f" AND YEAR IN ({in_list(years)})" if years else ""
    return sql(DELAYED, f"""
per_airport AS (
  SELECT YEAR, ORIGIN, sum(ARR_DELAY) AS airport_delay
  FROM delayed WHERE ARR_DELAY > 0{year_filter} GROUP BY YEAR, ORIGIN
),
shares AS (
  SELECT *, sum(airport_delay) OVER (PARTITION BY YEAR) AS total_delay FROM per_airport
),
ranked AS (
  SELECT *, airport_delay / nullif(total_delay, 0) AS delay_share FROM shares
)""", final="""
SELECT YEAR, ORIGIN, airport_delay, total_delay, delay_share,
       CAST(row_number() OVER (PARTITION BY YEAR ORDER BY delay_share DESC, ORIGIN) AS INTEGER) AS rank
FROM ranked QUALIFY rank <= 10""", round_cols=("airport_delay", "total_delay", "delay_share"))


ORACLE = {
    "delayed_flights": sql(DELAYED, final="SELECT * FROM delayed", round_cols=DELAYED_DOUBLES),
    "cluster_summary": sql(DELAYED, CLUSTERED, final="SELECT * FROM summary",
                           round_cols=("DEP_DELAY", "ARR_DELAY", "DELAY_CHANGE", "threshold")),
    "label_regimes": sql(DELAYED, CLUSTERED, final="""
SELECT YEAR, ORIGIN, OP_UNIQUE_CARRIER, DEP_DELAY, ARR_DELAY, DELAY_CHANGE, cluster, recovery_status
FROM labelled""", round_cols=("DEP_DELAY", "ARR_DELAY", "DELAY_CHANGE")),
    "recovery_regimes": sql(DELAYED, CLUSTERED, final="""
SELECT YEAR, recovery_status, count(*) AS count FROM labelled GROUP BY YEAR, recovery_status"""),
    "cause_mix_absolute": sql(DELAYED, CLUSTERED, MIX_ABS, final="SELECT * FROM mix_abs",
                              round_cols=_MIX),
    "cause_mix": sql(DELAYED, CLUSTERED, MIX_ABS, final="SELECT recovery_status, {} FROM mix_abs".format(
        ", ".join(f"{c} / nullif({' + '.join(_MIX)}, 0) * 100 AS {c}_pct" for c in _MIX)),
        round_cols=[f"{c}_pct" for c in _MIX]),
    "yearly_summary": sql(DELAYED, final=f"""
SELECT YEAR, avg(DEP_DELAY) AS mean_dep, avg(ARR_DELAY) AS mean_arr,
       quantile_disc(ARR_DELAY, 0.5) AS median_arr,
       avg(CASE WHEN ARR_DELAY > 60 THEN 1.0 ELSE 0.0 END)::DOUBLE AS pct_very_late
FROM delayed WHERE YEAR IN ({in_list(YEARS)}) GROUP BY YEAR""",
        round_cols=("mean_dep", "mean_arr", "median_arr", "pct_very_late")),
    "top_decile_share": sql(DELAYED, TOP10, final="SELECT * FROM top10",
                            round_cols=("top10_delay_share",)),
    "delay_gini": sql(DELAYED, GINI, final="SELECT * FROM gini", round_cols=("gini_delay",)),
    "delay_unevenness": sql(DELAYED, TOP10, GINI, final="""
SELECT t.YEAR, t.top10_delay_share, g.gini_delay FROM top10 t JOIN gini g USING (YEAR)""",
        round_cols=("top10_delay_share", "gini_delay")),
    "delay_per_hour_unevenness": sql("""
pos AS (
  SELECT YEAR, ARR_DELAY * 60 / CRS_ELAPSED_TIME AS x FROM legs
  WHERE CANCELLED = 0 AND DIVERTED = 0 AND DEP_DELAY > 10 AND ARR_DELAY > 0
    AND DEP_DELAY <= 360 AND ARR_DELAY <= 360
),
ranked AS (
  SELECT YEAR, x, row_number() OVER (PARTITION BY YEAR ORDER BY x) AS up,
         row_number() OVER (PARTITION BY YEAR ORDER BY x DESC) AS down,
         count(*) OVER (PARTITION BY YEAR) AS n, sum(x) OVER (PARTITION BY YEAR) AS total,
         sum(x) OVER (PARTITION BY YEAR ORDER BY x DESC
                      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried
  FROM pos
)""", final="""
SELECT YEAR, max(CASE WHEN down <= n * 0.1 THEN carried / total END) AS top_share,
       2 * sum(up * x) / (max(n) * max(total)) - (max(n) + 1) / max(n) AS gini
FROM ranked GROUP BY YEAR""", round_cols=("top_share", "gini")),
    "airport_concentration": sql(DELAYED, final="""
SELECT YEAR, sum(CASE WHEN rk <= 10 THEN total_delay ELSE 0 END) / nullif(sum(total_delay), 0)
         AS top10_airport_delay_share
FROM (SELECT YEAR, ORIGIN, total_delay,
             row_number() OVER (PARTITION BY YEAR ORDER BY total_delay DESC, ORIGIN) AS rk
      FROM (SELECT YEAR, ORIGIN, sum(ARR_DELAY) AS total_delay FROM delayed GROUP BY YEAR, ORIGIN) a) r
GROUP BY YEAR""", round_cols=("top10_airport_delay_share",)),
    "airport_contribution": _contribution_sql(),
    "top_airport_contribution_years": _contribution_sql(CONTRIBUTION_YEARS),
    "delay_volatility": sql(DELAYED, final="""
SELECT YEAR, avg(ARR_DELAY) AS mean, stddev_samp(ARR_DELAY) AS std,
       avg(CASE WHEN ARR_DELAY > 120 THEN 1.0 ELSE 0.0 END)::DOUBLE AS pct_2hr,
       avg(CASE WHEN ARR_DELAY > 240 THEN 1.0 ELSE 0.0 END)::DOUBLE AS pct_4hr,
       stddev_samp(ARR_DELAY) / nullif(avg(ARR_DELAY), 0) AS cv
FROM delayed GROUP BY YEAR""", round_cols=("mean", "std", "pct_2hr", "pct_4hr", "cv")),
}
