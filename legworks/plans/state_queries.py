"""Catalogue entries of the reports that are kept up to date by month, with their oracle SQL.

One month of the states is landed once more: the reports must come out as those of a full run.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from legworks.operators import routes as N
from legworks.operators import states as S
from legworks.plans.common import RECOVERY_EDGES, YEARS, kept, legs, rounded
from legworks.plans.recovery_queries import ORACLE as _RECOVERY
from legworks.plans.route_queries import FLIGHTS, ORACLE as _ROUTES, flights
from legworks.plans.sqltext import in_list, sql


def _land(spark, sf_dir, path):
    rows = legs(spark, sf_dir)
    for part in (rows, rows.where("YEAR = 1996 AND MONTH = 3")):
        S.land_states(part, path, cluster=RECOVERY_EDGES)


def state(spark, sf_dir, name, years=None):
    path = kept(spark, sf_dir, "states", lambda p: _land(spark, sf_dir, p))
    return S.read_state(spark, path, name, years)


QUERIES = {
    "monthly_recovery_regimes": lambda s, d: S.recovery_regimes(state(s, d, "regimes")),
    "monthly_cause_mix": lambda s, d: rounded(S.cause_mix_absolute(state(s, d, "regimes"))),
    "monthly_yearly_summary": lambda s, d: rounded(S.yearly_summary(state(s, d, "delays", YEARS))),
    "monthly_delay_volatility": lambda s, d: rounded(S.delay_volatility(state(s, d, "delays"))),
    "monthly_direct_routes": lambda s, d: rounded(N.carriers_text(S.direct_routes(
        state(s, d, "routes"), state(s, d, "route_delays")))),
    # routes of up to SKETCH_K flights, whose sketches hold every delay
    "route_quantiles": lambda s, d: rounded(S.route_quantiles(state(s, d, "routes", YEARS)).where(
        F.col("flight_count") <= S.SKETCH_K)),
    "direct_routes_bitmap": lambda s, d: rounded(N.carriers_text(N.direct_routes(
        flights(s, d), days_method="bitmap"))),
}

ORACLE = {
    "monthly_recovery_regimes": _RECOVERY["recovery_regimes"],
    "monthly_cause_mix": _RECOVERY["cause_mix_absolute"],
    "monthly_yearly_summary": _RECOVERY["yearly_summary"],
    "monthly_delay_volatility": _RECOVERY["delay_volatility"],
    "monthly_direct_routes": _ROUTES["direct_routes"],
    "direct_routes_bitmap": _ROUTES["direct_routes"],
    "route_quantiles": sql(FLIGHTS, final=f"""
SELECT src, dst, count(*) AS flight_count, quantile_disc(arr_delay, 0.5) AS p50,
       quantile_disc(arr_delay, 0.9) AS p90
FROM flights WHERE year(date) IN ({in_list(YEARS)}) GROUP BY src, dst
HAVING count(*) <= {S.SKETCH_K}""", round_cols=("p50", "p90")),
}
