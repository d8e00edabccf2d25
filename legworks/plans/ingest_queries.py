"""Catalogue entries for ingest, sources and sinks, with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from legworks.session import scratch_path
from legworks.sources import legs as L
from legworks.sources.star import leg_key_columns, read_star_legs
from legworks.plans.common import YEARS, legs
from legworks.plans.recovery_queries import ORACLE as _RQ_ORACLE
from legworks.plans.sqltext import in_list, sql

COVERAGE_START, COVERAGE_END, COVERAGE_UNTIL = (1994, 1), (2002, 12), (2002, 6)
KEYS = leg_key_columns()
# Columns carried through the CSV round trip, in the source layout's names.
_CSV_COLUMNS = ["YEAR", "MONTH", "FL_DATE", "OP_UNIQUE_CARRIER", "OP_CARRIER", "TAIL_NUM",
                "ORIGIN", "DEST", "CRS_DEP_TIME", "DEP_TIME", "DEP_DELAY", "TAXI_OUT", "TAXI_IN",
                "CRS_ARR_TIME", "ARR_TIME", "ARR_DELAY", "CANCELLED", "DIVERTED",
                "CRS_ELAPSED_TIME", "AIR_TIME", "DISTANCE", "CARRIER_DELAY", "WEATHER_DELAY",
                "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY"]
_RENAMES = {"FL_DATE_RAW": "FL_DATE", "DEP_TIME_RAW": "DEP_TIME", "ARR_TIME_RAW": "ARR_TIME"}


def _csv_roundtrip(spark, sf_dir):
    """Export the legs in the 77-column source layout, scan them back with the
    explicit schema.  A blank CSV field reads back as NULL (missing), as in the
    source files."""
    src = legs(spark, sf_dir).drop("FL_DATE")
    path = scratch_path(spark, "legs-csv")
    L.write_report(L.to_source_layout(src, _RENAMES), path, fmt="csv")
    return L.read_legs(spark, path).select(*_CSV_COLUMNS)


def _header_variants(spark, sf_dir):
    """Export the legs as files of three headers (the whole layout; its columns from the last to
    the first; without the taxi times and with a further column) and scan them by name."""
    src = L.to_source_layout(legs(spark, sf_dir).drop("FL_DATE"), _RENAMES)
    path = scratch_path(spark, "legs-headers-csv")
    shapes = [src, src.select(*reversed(src.columns)),
              src.drop("TAXI_OUT", "TAXI_IN").withColumn("NOTE", F.lit("x"))]
    for i, rows in enumerate(shapes):
        L.write_report(rows.where(F.col("YEAR") % 3 == i), f"{path}/{i}", fmt="csv")
    return L.read_legs(spark, f"{path}/*", headers="by_name").select(*_CSV_COLUMNS)


def _rejected_rows(spark, sf_dir):
    """Export the legs with bad fields planted (a decimal departure time in every row whose
    part key is a multiple of 97), scan them back and count the rejected lines."""
    src = L.to_source_layout(legs(spark, sf_dir).drop("FL_DATE").withColumn(
        "DISTANCE_GROUP", (F.col("l_partkey") % 97).cast("int")), _RENAMES)
    planted = src.withColumn("CRS_DEP_TIME", F.concat(
        F.col("CRS_DEP_TIME").cast("string"), F.when(F.col("DISTANCE_GROUP") == 0, ".0")
        .otherwise("")))
    path = scratch_path(spark, "legs-bad-csv")
    L.write_report(planted, path, fmt="csv")
    return L.rejected_rows(L.read_legs(spark, path, bad_rows="keep"))


def _report_csv_roundtrip(spark, sf_dir):
    """A small aggregate (the regime cause mix) exported as one CSV file and read
    back with its schema — the report hand-off.  Single-file output is only
    used for results whose size does not grow with the legs (3 rows here)."""
    from legworks.plans.recovery_queries import QUERIES as RQ
    mix = RQ["cause_mix"](spark, sf_dir)
    path = scratch_path(spark, "cause-mix-csv")
    L.write_report(mix, path, fmt="csv", single_file=True)
    return L.read_report(spark, path, mix.schema)


def _parquet_roundtrip(spark, sf_dir):
    """Land all legs partitioned by YEAR/MONTH, half of the years at a time, and read them back."""
    path = scratch_path(spark, "legs-parquet")
    rows = legs(spark, sf_dir)
    L.land_parquet(rows.where("YEAR % 2 = 0"), path)
    L.land_parquet(rows.where("YEAR % 2 = 1"), path)
    return L.read_landed(spark, path)


QUERIES = {
    "year_slice": lambda s, d: read_star_legs(s, d, years=YEARS),
    "filter_funnel": lambda s, d: L.filter_funnel(legs(s, d)),
    "month_coverage": lambda s, d: L.month_coverage(legs(s, d), COVERAGE_START, COVERAGE_END,
                                                    COVERAGE_UNTIL),
    "coverage_tally": lambda s, d: L.coverage_tally(L.month_coverage(
        legs(s, d), COVERAGE_START, COVERAGE_END, COVERAGE_UNTIL)),
    "csv_roundtrip": _csv_roundtrip,
    "header_variants": _header_variants,
    "parquet_roundtrip": _parquet_roundtrip,
    "rejected_rows": _rejected_rows,
    "report_csv_roundtrip": _report_csv_roundtrip,
    "train_split": lambda s, d: L.train_split(
        legs(s, d).select(*KEYS, "FL_DATE"), 0.3, bucket=F.col("l_orderkey") % 100),
}

_DOUBLE_CSV = ["DEP_DELAY", "TAXI_OUT", "TAXI_IN", "ARR_DELAY", "CANCELLED", "DIVERTED",
               "CRS_ELAPSED_TIME", "AIR_TIME", "DISTANCE", "CARRIER_DELAY", "WEATHER_DELAY",
               "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY"]

_SPINE = f"""
spine AS (
  SELECT CAST(year(m) AS INTEGER) AS YEAR, CAST(month(m) AS INTEGER) AS MONTH
  FROM (SELECT unnest(generate_series(DATE '{COVERAGE_START[0]:04d}-{COVERAGE_START[1]:02d}-01',
                                      DATE '{COVERAGE_END[0]:04d}-{COVERAGE_END[1]:02d}-01',
                                      INTERVAL 1 MONTH)) AS m) g
),
present AS (SELECT DISTINCT YEAR, MONTH FROM legs),
coverage AS (
  SELECT s.YEAR, s.MONTH,
         CASE WHEN s.YEAR * 100 + s.MONTH > {COVERAGE_UNTIL[0] * 100 + COVERAGE_UNTIL[1]} THEN 'future'
              WHEN p.YEAR IS NOT NULL THEN 'present' ELSE 'missing' END AS status
  FROM spine s LEFT JOIN present p ON p.YEAR = s.YEAR AND p.MONTH = s.MONTH
)"""

ORACLE = {
    "month_coverage": sql(_SPINE, final="SELECT * FROM coverage"),
    "coverage_tally": sql(_SPINE, final="SELECT status, count(*) AS months FROM coverage GROUP BY status"),
    "year_slice": sql(final=f"SELECT * FROM legs WHERE YEAR IN ({in_list(YEARS)})"),
    "filter_funnel": sql(final="""
SELECT count(*) AS raw_rows,
       count(*) FILTER (WHERE CANCELLED = 0 AND DIVERTED = 0) AS completed_rows,
       count(*) FILTER (WHERE CANCELLED = 0 AND DIVERTED = 0 AND DEP_DELAY > 10
                        AND ARR_DELAY >= -15 AND DEP_DELAY <= 360 AND ARR_DELAY <= 360) AS delayed_rows
FROM legs"""),
    "csv_roundtrip": sql(final="""
SELECT YEAR, MONTH, nullif(FL_DATE_RAW, '') AS FL_DATE, OP_UNIQUE_CARRIER, OP_CARRIER, TAIL_NUM,
       ORIGIN, DEST, CRS_DEP_TIME, nullif(DEP_TIME_RAW, '') AS DEP_TIME, DEP_DELAY, TAXI_OUT, TAXI_IN,
       CRS_ARR_TIME, nullif(ARR_TIME_RAW, '') AS ARR_TIME, ARR_DELAY, CANCELLED, DIVERTED,
       CAST(CRS_ELAPSED_TIME AS DOUBLE) AS CRS_ELAPSED_TIME, AIR_TIME, DISTANCE, CARRIER_DELAY,
       WEATHER_DELAY, NAS_DELAY, SECURITY_DELAY, LATE_AIRCRAFT_DELAY
FROM legs""", round_cols=_DOUBLE_CSV),
    "header_variants": sql(final="""
SELECT YEAR, MONTH, nullif(FL_DATE_RAW, '') AS FL_DATE, OP_UNIQUE_CARRIER, OP_CARRIER, TAIL_NUM,
       ORIGIN, DEST, CRS_DEP_TIME, nullif(DEP_TIME_RAW, '') AS DEP_TIME, DEP_DELAY,
       CASE WHEN YEAR % 3 <> 2 THEN TAXI_OUT END AS TAXI_OUT,
       CASE WHEN YEAR % 3 <> 2 THEN TAXI_IN END AS TAXI_IN,
       CRS_ARR_TIME, nullif(ARR_TIME_RAW, '') AS ARR_TIME, ARR_DELAY, CANCELLED, DIVERTED,
       CAST(CRS_ELAPSED_TIME AS DOUBLE) AS CRS_ELAPSED_TIME, AIR_TIME, DISTANCE, CARRIER_DELAY,
       WEATHER_DELAY, NAS_DELAY, SECURITY_DELAY, LATE_AIRCRAFT_DELAY
FROM legs""", round_cols=_DOUBLE_CSV),
    "parquet_roundtrip": sql(final="SELECT * FROM legs"),
    "rejected_rows": sql(final="""
SELECT YEAR, count(*) AS lines, count(*) FILTER (WHERE l_partkey % 97 = 0) AS rejected
FROM legs GROUP BY YEAR"""),
    "report_csv_roundtrip": _RQ_ORACLE["cause_mix"],
    "train_split": sql(final="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, FL_DATE,
       CASE WHEN l_orderkey % 100 < 30 THEN 'train' ELSE 'score' END AS split
FROM legs"""),
}
