"""Catalogue entries for the delay-propagation family, with their oracle SQL."""

from __future__ import annotations

from legworks.operators import propagation as P
from legworks.operators.recovery import bucket_clusters
from legworks.plans.common import PROFILE_YEARS, PROPAGATION_EDGES, YEARS, kept, legs, rounded
from legworks.plans.sqltext import in_list, sql
from legworks.schema import PROPAGATION_CAUSES
from legworks.sources.legs import land_bucketed
from legworks.sources.star import leg_key_columns

KEYS = leg_key_columns()
CLEAN_BUCKETS = 32         # a few for the test tables; some 100 MB each on a cluster


def clean(spark, sf_dir, years=None):
    return P.clean_legs(legs(spark, sf_dir, years), date_col="FL_DATE_RAW",
                        dep_time_col="DEP_TIME_RAW", arr_time_col="ARR_TIME_RAW", keep=KEYS)


def extra(spark, sf_dir, years=None):
    """``years`` prunes the scan; a leg's chain never leaves its day, so that is exact."""
    return P.extra_delay(clean(spark, sf_dir, years), tie_break=KEYS)


def bucketed_clean(spark, sf_dir):
    """The cleaned legs in buckets of aircraft and day: the day window reads them as they lie."""
    def name(path: str) -> str:
        return "legworks_clean_" + path.rsplit("-", 1)[-1]

    path = kept(spark, sf_dir, "clean-legs", lambda p: land_bucketed(
        clean(spark, sf_dir), name(p), p, ["TAIL_NUM", "FL_DATE_DT"],
        ["TAIL_NUM", "FL_DATE_DT", "DEP_TIME", *KEYS], CLEAN_BUCKETS))
    return spark.table(name(path))


def _clustered(spark, sf_dir):
    return bucket_clusters(extra(spark, sf_dir), "EXTRA_DELAY", PROPAGATION_EDGES, (True, True))


def _cascade(spark, sf_dir):
    return P.airport_cascade_causes(extra(spark, sf_dir, YEARS), years=YEARS)


QUERIES = {
    "clean_legs": lambda s, d: clean(s, d),
    "extra_delay": lambda s, d: rounded(extra(s, d)),
    "extra_delay_bucketed": lambda s, d: rounded(P.extra_delay(
        bucketed_clean(s, d), tie_break=KEYS, spread_alone=False)),
    "cascade_stats": lambda s, d: rounded(P.cascade_stats(extra(s, d))),
    "cluster_impact": lambda s, d: rounded(P.cluster_impact(_clustered(s, d))),
    "cluster_cause_correlation": lambda s, d: rounded(P.cluster_cause_correlation(_clustered(s, d))),
    "problem_airports": lambda s, d: rounded(P.problem_airports(extra(s, d))),
    "airport_cascade_causes": lambda s, d: rounded(_cascade(s, d)),
    "airport_cause_profile": lambda s, d: rounded(
        P.airport_cause_profile(_cascade(s, d), years=PROFILE_YEARS)),
}

# ----------------------------------------------------------------- oracle SQL

_FEATURES = ["DEP_DELAY", "ARR_DELAY", "DISTANCE", "AIR_TIME"] + PROPAGATION_CAUSES
_KEYS = ", ".join(KEYS)

CLEAN = r"""
clean AS (
  SELECT {feats},
         TRY_CAST(nullif(ARR_TIME_RAW, '') AS DOUBLE) AS ARR_TIME,
         TRY_CAST(nullif(DEP_TIME_RAW, '') AS DOUBLE) AS DEP_TIME,
         CANCELLED, DIVERTED, TAIL_NUM, ORIGIN,
         CAST(try_strptime(regexp_extract(FL_DATE_RAW, '^(\d{{1,2}}/\d{{1,2}}/\d{{4}})', 1), '%m/%d/%Y')
              AS DATE) AS FL_DATE_DT,
         {keys}
  FROM legs
  WHERE nullif(ARR_TIME_RAW, '') IS NOT NULL AND nullif(DEP_TIME_RAW, '') IS NOT NULL
    AND CANCELLED = 0 AND DIVERTED = 0
)""".format(feats=", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in _FEATURES),
            keys=_KEYS)

EXTRA = f"""
chain AS (
  SELECT *, lag(ARR_DELAY) OVER w AS prev_arr, lag(FL_DATE_DT) OVER w AS prev_date
  FROM clean
  WINDOW w AS (PARTITION BY TAIL_NUM ORDER BY FL_DATE_DT ASC NULLS FIRST, DEP_TIME, {_KEYS})
),
extra AS (
  SELECT * EXCLUDE (prev_arr, prev_date),
         CASE WHEN FL_DATE_DT = prev_date THEN prev_arr END AS PREV_ARR_DELAY,
         CASE WHEN FL_DATE_DT = prev_date
              THEN greatest(DEP_DELAY - coalesce(prev_arr, 0.0), 0.0)
              ELSE greatest(DEP_DELAY, 0.0) END AS EXTRA_DELAY,
         DEP_DELAY - ARR_DELAY AS DELAY_RECOVERY
  FROM chain
)"""

CLUSTERED = """
clustered AS (
  SELECT *, CASE WHEN EXTRA_DELAY <= 10 THEN 0 WHEN EXTRA_DELAY <= 120 THEN 1 ELSE 2 END AS cluster
  FROM extra
)"""

CASCADE = f"""
cascade AS (
  SELECT ORIGIN, Year, {", ".join(PROPAGATION_CAUSES)}, total_extra_delay,
         {", ".join(f"{c} / nullif(total_extra_delay, 0) AS {c}_share" for c in PROPAGATION_CAUSES)},
         total_extra_delay / nullif(sum(total_extra_delay) OVER (PARTITION BY Year), 0) AS share,
         CAST(rank() OVER (PARTITION BY Year ORDER BY total_extra_delay DESC) AS INTEGER) AS rank
  FROM (
    SELECT ORIGIN, CAST(year(FL_DATE_DT) AS INTEGER) AS Year,
           {", ".join(f"sum({c}) AS {c}" for c in PROPAGATION_CAUSES)},
           sum(EXTRA_DELAY) AS total_extra_delay
    FROM extra
    WHERE FL_DATE_DT IS NOT NULL AND ORIGIN IS NOT NULL AND year(FL_DATE_DT) IN ({in_list(YEARS)})
    GROUP BY ORIGIN, CAST(year(FL_DATE_DT) AS INTEGER)
  ) a
)"""

_SHARES = [f"{c}_share" for c in PROPAGATION_CAUSES]
_EXTRA_DOUBLES = _FEATURES + ["ARR_TIME", "DEP_TIME", "CANCELLED", "DIVERTED",
                              "PREV_ARR_DELAY", "EXTRA_DELAY", "DELAY_RECOVERY"]

ORACLE = {
    "clean_legs": sql(CLEAN, final="SELECT * FROM clean"),
    "extra_delay": sql(CLEAN, EXTRA, final="SELECT * FROM extra", round_cols=_EXTRA_DOUBLES),
    "extra_delay_bucketed": sql(CLEAN, EXTRA, final="SELECT * FROM extra",
                                round_cols=_EXTRA_DOUBLES),
    "cascade_stats": sql(CLEAN, EXTRA, final="""
SELECT avg(EXTRA_DELAY) AS avg_extra_delay, stddev_samp(EXTRA_DELAY) AS std_extra_delay,
       max(EXTRA_DELAY) AS max_extra_delay, min(EXTRA_DELAY) AS min_extra_delay FROM extra""",
        round_cols=("avg_extra_delay", "std_extra_delay", "max_extra_delay", "min_extra_delay")),
    "cluster_impact": sql(CLEAN, EXTRA, CLUSTERED, final="""
SELECT cluster, count(*) AS num_flights,
       count(*) FILTER (WHERE EXTRA_DELAY > 10) AS num_propagated,
       avg(EXTRA_DELAY) AS avg_extra_delay, sum(DEP_DELAY + ARR_DELAY) AS total_delay
FROM clustered GROUP BY cluster""", round_cols=("avg_extra_delay", "total_delay")),
    "cluster_cause_correlation": sql(CLEAN, EXTRA, CLUSTERED, final="""
SELECT cluster, feature, correlation FROM (
  SELECT cluster, {cols} FROM clustered GROUP BY cluster
) w UNPIVOT INCLUDE NULLS (correlation FOR feature IN ({names}))""".format(
        cols=", ".join(f"covar_samp({c}, EXTRA_DELAY) / nullif(stddev_samp({c}) * "
                       f"stddev_samp(EXTRA_DELAY), 0) AS {c}" for c in PROPAGATION_CAUSES),
        names=", ".join(PROPAGATION_CAUSES)), round_cols=("correlation",)),
    "problem_airports": sql(CLEAN, EXTRA, final="""
SELECT ORIGIN, count(*) AS num_problem_flights,
       count(*) / sum(count(*)) OVER () AS fraction_problem_flights
FROM extra WHERE EXTRA_DELAY > 10 GROUP BY ORIGIN""", round_cols=("fraction_problem_flights",)),
    "airport_cascade_causes": sql(CLEAN, EXTRA, CASCADE, final="SELECT * FROM cascade",
                                  round_cols=PROPAGATION_CAUSES + ["total_extra_delay"] + _SHARES
                                  + ["share"]),
    "airport_cause_profile": sql(CLEAN, EXTRA, CASCADE, final="""
SELECT Year, ORIGIN, total_extra_delay, rank, {norm} FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY Year ORDER BY total_extra_delay DESC, ORIGIN)
                 AS INTEGER) AS rank
  FROM cascade WHERE Year IN ({years})
) t WHERE rank <= 10""".format(
        norm=", ".join(f"{s} / nullif({' + '.join(f'coalesce({x}, 0)' for x in _SHARES)}, 0) AS {s}"
                       for s in _SHARES),
        years=in_list(PROFILE_YEARS)), round_cols=["total_extra_delay"] + _SHARES),
}
