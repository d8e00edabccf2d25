"""Catalogue entries for report tables, with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from legworks.operators import report as RP
from legworks.plans.common import rounded
from legworks.plans.propagation_queries import CLEAN, EXTRA, extra
from legworks.plans.recovery_queries import CLUSTERED, DELAYED, _clustered
from legworks.plans.sqltext import sql
from legworks.schema import PROPAGATION_CAUSES, REGIME_ORDER

PROFILE_FEATURES = ["DEP_DELAY", "ARR_DELAY", "DISTANCE", "AIR_TIME"] + PROPAGATION_CAUSES + [
    "DELAY_RECOVERY"]


def _flagged(spark, sf_dir):
    """Propagated legs (EXTRA_DELAY > 10) against the rest."""
    return extra(spark, sf_dir).withColumn("flag", (F.col("EXTRA_DELAY") > 10).cast("int"))


QUERIES = {
    "regimes_by_year_wide": lambda s, d: RP.regimes_by_year_wide(_clustered(s, d)),
    "carrier_regime_mix": lambda s, d: rounded(RP.carrier_regime_mix(_clustered(s, d))),
    "airport_regime_mix": lambda s, d: rounded(RP.airport_regime_mix(_clustered(s, d))),
    "flag_profile": lambda s, d: rounded(RP.profile(_flagged(s, d), "flag", PROFILE_FEATURES)),
}


def _mix_sql(key: str) -> str:
    cols = ", ".join(
        f"""coalesce(max(pct) FILTER (WHERE recovery_status = '{st}'), 0) AS "{st}\""""
        for st in REGIME_ORDER)
    return sql(DELAYED, CLUSTERED, f"""
per AS (SELECT {key}, recovery_status, count(*) AS n FROM labelled WHERE {key} IS NOT NULL
        GROUP BY {key}, recovery_status),
top AS (SELECT {key} FROM per GROUP BY {key} ORDER BY sum(n) DESC, {key} LIMIT 10),
pct AS (SELECT {key}, recovery_status, 100 * n / sum(n) OVER (PARTITION BY {key}) AS pct
        FROM per WHERE {key} IN (SELECT {key} FROM top))""",
               final=f"SELECT {key}, {cols} FROM pct GROUP BY {key}", round_cols=REGIME_ORDER)


ORACLE = {
    "regimes_by_year_wide": sql(DELAYED, CLUSTERED, final="SELECT YEAR, {} FROM labelled GROUP BY YEAR".format(
        ", ".join(f"""nullif(count(*) FILTER (WHERE recovery_status = '{st}'), 0) AS "{st}\""""
                  for st in REGIME_ORDER))),
    "carrier_regime_mix": _mix_sql("OP_UNIQUE_CARRIER"),
    "airport_regime_mix": _mix_sql("ORIGIN"),
    "flag_profile": sql(CLEAN, EXTRA, final="SELECT flag, {} FROM (SELECT *, CAST(EXTRA_DELAY > 10 AS INTEGER) AS flag FROM extra) x GROUP BY flag".format(
        ", ".join([f"avg({f}) AS {f}_mean" for f in PROFILE_FEATURES]
                  + [f"stddev_samp({f}) AS {f}_std" for f in PROFILE_FEATURES])),
        round_cols=[f"{f}_mean" for f in PROFILE_FEATURES] + [f"{f}_std" for f in PROFILE_FEATURES]),
}
