"""Catalogue entries for the route-network family, with their oracle SQL."""

from __future__ import annotations

from legworks.operators import routes as N
from legworks.plans.common import BUSY_FLIGHTS, MIN_FLIGHTS, kept, legs, rounded
from legworks.plans.sqltext import sql


def flights(spark, sf_dir):
    return N.schedule_minutes(legs(spark, sf_dir))


def routes(spark, sf_dir):
    """The route table, written once per application: it is small (airport pairs) but costs a
    pass over the legs, and all reports and searches read it."""
    path = kept(spark, sf_dir, "routes",
                lambda p: N.direct_routes(flights(spark, sf_dir)).write.parquet(p))
    return spark.read.parquet(path)


def analysis_routes(spark, sf_dir):
    """Routes of the network report: support threshold only, no exclusions."""
    return N.network_edges(routes(spark, sf_dir), MIN_FLIGHTS, exclude=())


QUERIES = {
    "schedule_minutes": lambda s, d: rounded(flights(s, d)),
    "service_window": lambda s, d: N.service_window(flights(s, d)),
    "direct_routes": lambda s, d: rounded(N.carriers_text(routes(s, d))),
    # threshold 1 so the pseudo-airport exclusion has rows to remove
    "network_edges": lambda s, d: rounded(N.carriers_text(N.network_edges(routes(s, d), 1))),
    "airport_nodes": lambda s, d: N.airport_nodes(N.network_edges(routes(s, d), MIN_FLIGHTS)),
    "airport_degrees": lambda s, d: N.airport_degrees(analysis_routes(s, d)),
    "top_hubs": lambda s, d: N.top_hubs(N.airport_degrees(analysis_routes(s, d))),
    "busiest_routes": lambda s, d: rounded(N.busiest_routes(analysis_routes(s, d))),
    "reliable_routes": lambda s, d: rounded(N.reliable_routes(analysis_routes(s, d), BUSY_FLIGHTS)),
    "unreliable_routes": lambda s, d: rounded(N.unreliable_routes(analysis_routes(s, d), BUSY_FLIGHTS)),
    "carrier_coverage": lambda s, d: N.carrier_coverage(analysis_routes(s, d)),
    "route_time_stats": lambda s, d: rounded(N.route_time_stats(analysis_routes(s, d))),
    "route_delay_stats": lambda s, d: rounded(N.route_delay_stats(analysis_routes(s, d))),
    "route_availability_stats": lambda s, d: rounded(N.route_availability_stats(analysis_routes(s, d))),
    "network_summary": lambda s, d: rounded(N.network_summary(analysis_routes(s, d))),
}

# ----------------------------------------------------------------- oracle SQL

FLIGHTS = """
flights AS (
  SELECT FL_DATE AS date, ORIGIN AS src, DEST AS dst, OP_CARRIER AS carrier,
         CRS_DEP_TIME AS dep_time, CRS_ARR_TIME AS arr_time,
         CAST(floor(CRS_DEP_TIME / 100) * 60 + CRS_DEP_TIME % 100 AS INTEGER) AS dep_minutes,
         CASE WHEN CAST(floor(CRS_ARR_TIME / 100) * 60 + CRS_ARR_TIME % 100 AS INTEGER)
                   < CAST(floor(CRS_DEP_TIME / 100) * 60 + CRS_DEP_TIME % 100 AS INTEGER)
              THEN CAST(floor(CRS_ARR_TIME / 100) * 60 + CRS_ARR_TIME % 100 AS INTEGER) + 1440
              ELSE CAST(floor(CRS_ARR_TIME / 100) * 60 + CRS_ARR_TIME % 100 AS INTEGER) END
           AS arr_minutes,
         CRS_ELAPSED_TIME AS flight_time, ARR_DELAY AS arr_delay
  FROM legs
  WHERE CANCELLED = 0 AND DIVERTED = 0 AND CRS_DEP_TIME IS NOT NULL
    AND CRS_ARR_TIME IS NOT NULL AND ARR_DELAY IS NOT NULL
)"""

ROUTES = """
route_stats AS (
  SELECT src, dst, count(*) AS flight_count, count(DISTINCT date) AS days_with_service,
         count(DISTINCT carrier) AS num_carriers,
         string_agg(DISTINCT carrier, ',' ORDER BY carrier) AS carriers,
         avg(flight_time) AS avg_flight_time, avg(arr_delay) AS avg_delay,
         coalesce(stddev_samp(arr_delay), 0.0) AS std_delay,
         quantile_disc(arr_delay, 0.9) AS p90_delay
  FROM flights GROUP BY src, dst
),
routes AS (
  SELECT r.*, avg_flight_time + avg_delay + std_delay AS reliability_score,
         round(days_with_service / t.total_days * 100, 1) AS availability_pct
  FROM route_stats r, (SELECT count(DISTINCT date) AS total_days FROM flights) t
)"""

AROUTES = """
aroutes AS (SELECT * FROM routes WHERE flight_count >= 10)"""

DEGREES = """
degrees AS (
  SELECT airport, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree,
         CAST(sum(dep) AS BIGINT) AS total_departures, CAST(sum(arr) AS BIGINT) AS total_arrivals,
         CAST(sum(o) + sum(i) AS BIGINT) AS total_degree,
         CAST(sum(dep) + sum(arr) AS BIGINT) AS total_flights
  FROM (SELECT src AS airport, 1 AS o, 0 AS i, flight_count AS dep, 0 AS arr FROM aroutes
        UNION ALL
        SELECT dst AS airport, 0 AS o, 1 AS i, 0 AS dep, flight_count AS arr FROM aroutes) s
  GROUP BY airport
)"""

_ROUTE_DOUBLES = ("avg_flight_time", "avg_delay", "std_delay", "p90_delay",
                  "reliability_score", "availability_pct")


def _reliable(desc: bool) -> str:
    order = "DESC" if desc else "ASC"
    return sql(FLIGHTS, ROUTES, AROUTES, final=f"""
SELECT src, dst, flight_count, avg_flight_time, round(avg_delay, 1) AS avg_delay,
       round(p90_delay, 1) AS p90_delay, round(std_delay, 1) AS std_delay,
       round(reliability_score, 1) AS rel_score
FROM aroutes WHERE flight_count >= 100
ORDER BY reliability_score {order}, src, dst LIMIT 20""",
        round_cols=("avg_flight_time", "avg_delay", "p90_delay", "std_delay", "rel_score"))


ORACLE = {
    "schedule_minutes": sql(FLIGHTS, final="SELECT * FROM flights", round_cols=("arr_delay",)),
    "service_window": sql(FLIGHTS, final="""
SELECT min(date) AS min_date, max(date) AS max_date, count(DISTINCT date) AS total_days
FROM flights"""),
    "direct_routes": sql(FLIGHTS, ROUTES, final="SELECT * FROM routes", round_cols=_ROUTE_DOUBLES),
    "network_edges": sql(FLIGHTS, ROUTES, final="""
SELECT * FROM routes WHERE flight_count >= 1 AND src NOT IN ('USA') AND dst NOT IN ('USA')""",
        round_cols=_ROUTE_DOUBLES),
    "airport_nodes": sql(FLIGHTS, ROUTES, final="""
SELECT src AS node FROM routes WHERE flight_count >= 10 AND src <> 'USA' AND dst <> 'USA'
UNION
SELECT dst AS node FROM routes WHERE flight_count >= 10 AND src <> 'USA' AND dst <> 'USA'"""),
    "airport_degrees": sql(FLIGHTS, ROUTES, AROUTES, DEGREES, final="SELECT * FROM degrees"),
    "top_hubs": sql(FLIGHTS, ROUTES, AROUTES, DEGREES, final="""
SELECT airport, out_degree, in_degree, total_degree, total_flights FROM degrees
ORDER BY total_degree DESC, airport LIMIT 15"""),
    "busiest_routes": sql(FLIGHTS, ROUTES, AROUTES, final="""
SELECT src, dst, flight_count, days_with_service, carriers, avg_flight_time FROM aroutes
ORDER BY flight_count DESC, src, dst LIMIT 20""", round_cols=("avg_flight_time",)),
    "reliable_routes": _reliable(False),
    "unreliable_routes": _reliable(True),
    "carrier_coverage": sql(FLIGHTS, ROUTES, AROUTES, final="""
SELECT carrier, count(*) AS num_routes, CAST(sum(flight_count) AS BIGINT) AS total_flights
FROM (SELECT unnest(string_split(carriers, ',')) AS carrier, flight_count FROM aroutes) e
GROUP BY carrier"""),
    "route_time_stats": sql(FLIGHTS, ROUTES, AROUTES, final="""
SELECT min(avg_flight_time) AS min, avg(avg_flight_time) AS avg, max(avg_flight_time) AS max,
       quantile_disc(avg_flight_time, 0.5) AS median, quantile_disc(avg_flight_time, 0.9) AS p90
FROM aroutes""", round_cols=("min", "avg", "max", "median", "p90")),
    "route_delay_stats": sql(FLIGHTS, ROUTES, AROUTES, final="""
SELECT avg(avg_delay) AS network_avg_delay, avg(p90_delay) AS network_avg_p90,
       avg(std_delay) AS network_avg_std, quantile_disc(avg_delay, 0.9) AS worst_10pct_avg_delay
FROM aroutes""", round_cols=("network_avg_delay", "network_avg_p90", "network_avg_std",
                              "worst_10pct_avg_delay")),
    "route_availability_stats": sql(FLIGHTS, ROUTES, AROUTES, final="""
SELECT avg(availability_pct) AS avg_avail, quantile_disc(availability_pct, 0.5) AS median_avail,
       count(*) FILTER (WHERE availability_pct >= 90) AS above_90,
       count(*) FILTER (WHERE availability_pct >= 50) AS above_50,
       count(*) FILTER (WHERE availability_pct < 10) AS below_10
FROM aroutes""", round_cols=("avg_avail", "median_avail")),
    "network_summary": sql(FLIGHTS, ROUTES, AROUTES, final="""
SELECT n.num_airports, count(*) AS num_routes, CAST(sum(flight_count) AS BIGINT) AS total_flights,
       2 * count(*) / n.num_airports AS avg_degree
FROM aroutes, (SELECT count(*) AS num_airports
               FROM (SELECT src FROM aroutes UNION SELECT dst FROM aroutes) u) n
GROUP BY n.num_airports""", round_cols=("avg_degree",)),
}
