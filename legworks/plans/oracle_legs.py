"""DuckDB twin of ``legworks.sources.star.legs_from_lineitem`` (oracle side).

Every oracle query starts ``WITH <LEGS_CTE>, ...``; the driver registers the
test tables as views, so ``lineitem`` is in scope.
"""

LEGS_CTE = """
li1 AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(l_shipdate AS DATE) AS d,
         CAST(l_quantity AS INTEGER) AS q,
         CAST((l_partkey % 24) * 60 + (l_orderkey % 60) AS INTEGER) AS depm,
         CAST(30 + ((l_orderkey % 60) * 17 + l_partkey % 13) % 200 AS INTEGER) AS elapsed,
         CASE WHEN l_orderkey % 41 = 0 THEN 1 ELSE 0 END AS canc,
         CASE WHEN l_partkey % 89 = 0 THEN 1 ELSE 0 END AS dvt
  FROM lineitem
),
li2 AS (
  SELECT *,
         (depm + elapsed) % 1440 AS arrm,
         q * 8 - 30 + CAST(l_partkey % 8 AS INTEGER) AS dd,
         q * 8 - 30 + CAST(l_partkey % 8 AS INTEGER)
           + CAST((l_orderkey * 7 + l_partkey * 3) % 61 AS INTEGER) - 30 AS ad
  FROM li1
),
legs AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(year(d) AS INTEGER) AS YEAR,
         CAST(month(d) AS INTEGER) AS MONTH,
         d AS FL_DATE,
         CASE WHEN l_partkey % 211 = 0 THEN ''
              ELSE concat(CAST(month(d) AS VARCHAR), '/', CAST(day(d) AS VARCHAR), '/',
                          CAST(year(d) AS VARCHAR), ' 12:00:00 AM') END AS FL_DATE_RAW,
         concat('C', CAST(l_partkey % 7 AS VARCHAR)) AS OP_CARRIER,
         concat('C', CAST(l_partkey % 7 AS VARCHAR)) AS OP_UNIQUE_CARRIER,
         CASE WHEN l_partkey % 101 = 0 THEN NULL
              ELSE concat('N', CAST(l_suppkey AS VARCHAR)) END AS TAIL_NUM,
         CASE WHEN l_partkey % 307 = 0 THEN 'USA'
              ELSE concat('A', lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0')) END AS ORIGIN,
         concat('A', lpad(CAST(((l_orderkey % 60) * 2 +
              CASE WHEN l_partkey % 500 = 0 THEN 31 WHEN l_partkey % 10 = 0 THEN 7
                   ELSE l_partkey % 2 END) % 60 AS VARCHAR), 2, '0')) AS DEST,
         CAST((l_partkey % 24) * 100 + (l_orderkey % 60) AS INTEGER) AS CRS_DEP_TIME,
         CAST(CAST(floor(arrm / 60.0) AS INTEGER) * 100 + arrm % 60 AS INTEGER) AS CRS_ARR_TIME,
         elapsed AS CRS_ELAPSED_TIME,
         CASE WHEN canc = 1 THEN ''
              ELSE CAST(CAST((l_partkey % 24) * 100 + (l_orderkey % 60) AS INTEGER) AS VARCHAR)
         END AS DEP_TIME_RAW,
         CASE WHEN canc = 1 OR dvt = 1 THEN ''
              ELSE CAST(CAST(CAST(floor(arrm / 60.0) AS INTEGER) * 100 + arrm % 60 AS INTEGER)
                        AS VARCHAR) END AS ARR_TIME_RAW,
         CASE WHEN canc = 1 THEN NULL ELSE CAST(dd AS DOUBLE) END AS DEP_DELAY,
         CASE WHEN canc = 1 OR dvt = 1 THEN NULL ELSE CAST(ad AS DOUBLE) END AS ARR_DELAY,
         CAST(canc AS DOUBLE) AS CANCELLED,
         CAST(dvt AS DOUBLE) AS DIVERTED,
         CAST(5 + l_partkey % 30 AS DOUBLE) AS TAXI_OUT,
         CAST(2 + l_orderkey % 15 AS DOUBLE) AS TAXI_IN,
         CASE WHEN ad >= 15 THEN CAST(l_linenumber * 3 AS DOUBLE) END AS CARRIER_DELAY,
         CASE WHEN ad >= 15 THEN CAST(l_partkey % 5 AS DOUBLE) END AS WEATHER_DELAY,
         CASE WHEN ad >= 15 THEN CAST(l_orderkey % 25 AS DOUBLE) END AS NAS_DELAY,
         CASE WHEN ad >= 15 THEN CASE WHEN l_partkey % 50 = 0 THEN CAST(10 AS DOUBLE)
                                      ELSE CAST(0 AS DOUBLE) END END AS SECURITY_DELAY,
         CASE WHEN ad >= 15 THEN CAST(l_suppkey % 40 AS DOUBLE) END AS LATE_AIRCRAFT_DELAY,
         CAST(100 + l_partkey % 1900 AS DOUBLE) AS DISTANCE,
         CAST(20 + l_partkey % 200 AS DOUBLE) AS AIR_TIME
  FROM li2
)"""
