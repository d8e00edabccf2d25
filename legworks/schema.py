"""Explicit schema of the legs, and the fixed names of causes and regimes."""

from __future__ import annotations

from pyspark.sql import types as T

# The 77 monthly on-time CSV columns with this project's explicit types.
# Column names and order of the public monthly on-time files.
_INT = T.IntegerType()
_DBL = T.DoubleType()
_STR = T.StringType()

LEG_COLUMNS: list[tuple[str, T.DataType]] = [
    ("YEAR", _INT), ("QUARTER", _INT), ("MONTH", _INT), ("DAY_OF_MONTH", _INT),
    ("DAY_OF_WEEK", _INT), ("FL_DATE", _STR), ("OP_UNIQUE_CARRIER", _STR),
    ("OP_CARRIER_AIRLINE_ID", _INT), ("OP_CARRIER", _STR), ("TAIL_NUM", _STR),
    ("OP_CARRIER_FL_NUM", _INT), ("ORIGIN_AIRPORT_ID", _INT), ("ORIGIN_AIRPORT_SEQ_ID", _INT),
    ("ORIGIN_CITY_MARKET_ID", _INT), ("ORIGIN", _STR), ("ORIGIN_CITY_NAME", _STR),
    ("ORIGIN_STATE_ABR", _STR), ("ORIGIN_STATE_FIPS", _INT), ("ORIGIN_STATE_NM", _STR),
    ("ORIGIN_WAC", _INT), ("DEST_AIRPORT_ID", _INT), ("DEST_AIRPORT_SEQ_ID", _INT),
    ("DEST_CITY_MARKET_ID", _INT), ("DEST", _STR), ("DEST_CITY_NAME", _STR),
    ("DEST_STATE_ABR", _STR), ("DEST_STATE_FIPS", _INT), ("DEST_STATE_NM", _STR),
    ("DEST_WAC", _INT), ("CRS_DEP_TIME", _INT), ("DEP_TIME", _STR), ("DEP_DELAY", _DBL),
    ("DEP_DELAY_NEW", _DBL), ("DEP_DEL15", _DBL), ("DEP_DELAY_GROUP", _INT),
    ("DEP_TIME_BLK", _STR), ("TAXI_OUT", _DBL), ("WHEELS_OFF", _INT), ("WHEELS_ON", _INT),
    ("TAXI_IN", _DBL), ("CRS_ARR_TIME", _INT), ("ARR_TIME", _STR), ("ARR_DELAY", _DBL),
    ("ARR_DELAY_NEW", _DBL), ("ARR_DEL15", _DBL), ("ARR_DELAY_GROUP", _INT),
    ("ARR_TIME_BLK", _STR), ("CANCELLED", _DBL), ("CANCELLATION_CODE", _STR),
    ("DIVERTED", _DBL), ("CRS_ELAPSED_TIME", _DBL), ("ACTUAL_ELAPSED_TIME", _DBL),
    ("AIR_TIME", _DBL), ("FLIGHTS", _DBL), ("DISTANCE", _DBL), ("DISTANCE_GROUP", _INT),
    ("CARRIER_DELAY", _DBL), ("WEATHER_DELAY", _DBL), ("NAS_DELAY", _DBL),
    ("SECURITY_DELAY", _DBL), ("LATE_AIRCRAFT_DELAY", _DBL), ("FIRST_DEP_TIME", _INT),
    ("TOTAL_ADD_GTIME", _DBL), ("LONGEST_ADD_GTIME", _DBL), ("DIV_AIRPORT_LANDINGS", _INT),
    ("DIV_REACHED_DEST", _DBL), ("DIV_ACTUAL_ELAPSED_TIME", _DBL), ("DIV_ARR_DELAY", _DBL),
    ("DIV_DISTANCE", _DBL), ("DIV1_AIRPORT", _STR), ("DIV1_AIRPORT_ID", _INT),
    ("DIV1_AIRPORT_SEQ_ID", _INT), ("DIV1_WHEELS_ON", _INT), ("DIV1_TOTAL_GTIME", _DBL),
    ("DIV1_LONGEST_GTIME", _DBL), ("DIV1_WHEELS_OFF", _INT), ("DIV1_TAIL_NUM", _STR),
]

# DEP_TIME / ARR_TIME stay strings at ingest: blanks are cleaned by clean_legs.
LEG_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in LEG_COLUMNS])

# The five reported delay causes and the two taxi components.
CAUSE_COLUMNS = ["CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY",
                 "LATE_AIRCRAFT_DELAY", "SECURITY_DELAY"]
TAXI_COLUMNS = ["TAXI_IN", "TAXI_OUT"]
# Propagation uses the causes in this order.
PROPAGATION_CAUSES = ["CARRIER_DELAY", "LATE_AIRCRAFT_DELAY", "NAS_DELAY",
                      "SECURITY_DELAY", "WEATHER_DELAY"]

# The three recovery regimes.
RECOVERY_ACHIEVED = "Recovery Achieved"
NOT_ACHIEVED = "Not Achieved"
DELAY_WORSENED = "Delay Worsened"
REGIME_ORDER = [RECOVERY_ACHIEVED, NOT_ACHIEVED, DELAY_WORSENED]
