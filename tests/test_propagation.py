"""Hand fixtures for propagation and cleaning (FIXTURES §3: tail_chain, raw_legs, const_cause)."""

import datetime as dt

from pyspark.sql import functions as F

from legworks.operators import propagation as P

D1, D2 = dt.date(2003, 1, 5), dt.date(2003, 1, 6)
SCHEMA = "TAIL_NUM string, FL_DATE_DT date, DEP_TIME double, DEP_DELAY double, ARR_DELAY double, key long"


def _chain(spark):
    rows = [
        ("N1", D1, 800.0, 20.0, 30.0, 1),    # first leg of the day
        ("N1", D1, 1200.0, 45.0, -10.0, 2),  # follows an arrival 30 late → 15
        ("N1", D1, 1500.0, 5.0, 0.0, 3),     # previous arrived 10 early → 15
        ("N1", D2, 700.0, 12.0, 0.0, 4),     # next day: no inheritance
        ("N2", D1, 900.0, 7.0, 7.0, 5),      # tie on time with key 6
        ("N2", D1, 900.0, 9.0, 2.0, 6),
        (None, D1, 600.0, 50.0, 40.0, 7),    # unknown tails
        (None, D1, 700.0, 60.0, 0.0, 8),
        ("N3", None, 600.0, 30.0, 30.0, 9),  # no parsable date
        ("N3", None, 700.0, 40.0, 0.0, 10),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_extra_delay_chain(spark):
    out = {r.key: r for r in P.extra_delay(_chain(spark), tie_break=["key"]).collect()}
    assert out[1].EXTRA_DELAY == 20.0 and out[1].PREV_ARR_DELAY is None
    assert out[2].EXTRA_DELAY == 15.0
    assert out[3].EXTRA_DELAY == 15.0          # early previous arrival raises it
    assert out[4].EXTRA_DELAY == 12.0          # new day
    assert out[6].EXTRA_DELAY == 2.0           # 9 - 7, tie broken by key
    assert out[8].EXTRA_DELAY == 20.0          # NULL tails chain (source behaviour)
    assert out[10].EXTRA_DELAY == 40.0         # NULL date never chains
    assert out[2].DELAY_RECOVERY == 55.0


def test_extra_delay_independent_null_tails(spark):
    out = {r.key: r for r in P.extra_delay(_chain(spark), tie_break=["key"],
                                           null_tail="independent").collect()}
    assert out[8].EXTRA_DELAY == 60.0


def test_extra_delay_matches_tail_window(spark):
    """(tail, date) partitioning gives what a whole-tail window gives."""
    from pyspark.sql import Window
    df = _chain(spark)
    w = Window.partitionBy("TAIL_NUM").orderBy("FL_DATE_DT", "DEP_TIME", "key")
    ref = (df.withColumn("pa", F.lag("ARR_DELAY").over(w)).withColumn("pd", F.lag("FL_DATE_DT").over(w))
           .withColumn("e", F.when(F.col("FL_DATE_DT") == F.col("pd"),
                                   F.greatest(F.col("DEP_DELAY") - F.coalesce("pa", F.lit(0.0)), F.lit(0.0)))
                       .otherwise(F.greatest("DEP_DELAY", F.lit(0.0)))))
    want = {r.key: r.e for r in ref.collect()}
    got = {r.key: r.EXTRA_DELAY for r in P.extra_delay(df, tie_break=["key"]).collect()}
    assert got == want


def test_clean_legs_raw_strings(spark):
    rows = [("5.00", "1/5/2003 12:00:00 AM", "830", "1045", 0.0, 0.0),
            ("", "1/5/2003", "830", "1045", 0.0, 0.0),
            ("abc", "", "830", "1045", 0.0, 0.0),
            (None, "12/31/2003", "", "1045", 0.0, 0.0),
            ("1.0", "1/6/2003", "830", None, 0.0, 0.0),
            ("1.0", "1/6/2003", "830", "1045", 1.0, 0.0),
            ("1.0", "1/6/2003", "830", "1045", 0.0, 1.0)]
    df = spark.createDataFrame(rows, "DEP_DELAY string, FL_DATE string, DEP_TIME string, ARR_TIME string, CANCELLED double, DIVERTED double")
    for c in ["ARR_DELAY", "DISTANCE", "AIR_TIME", "CARRIER_DELAY", "LATE_AIRCRAFT_DELAY",
              "NAS_DELAY", "SECURITY_DELAY", "WEATHER_DELAY"]:
        df = df.withColumn(c, F.lit(""))
    df = df.withColumn("TAIL_NUM", F.lit("N1")).withColumn("ORIGIN", F.lit("ABC"))
    out = P.clean_legs(df).orderBy("DEP_DELAY").collect()
    assert len(out) == 3                       # blank DEP_TIME, NULL ARR_TIME, cancelled, diverted out
    assert sorted(r.DEP_DELAY for r in out) == [0.0, 0.0, 5.0]
    dates = sorted((r.FL_DATE_DT is None, str(r.FL_DATE_DT)) for r in out)
    assert [d[0] for d in dates].count(True) == 1   # '' → NULL date, row kept
    assert all(r.ARR_DELAY == 0.0 for r in out)


def test_cause_correlation_null_for_constant_column(spark):
    rows = [(0, 1.0, 0.0, 2.0), (0, 2.0, 0.0, 4.1), (0, 3.0, 0.0, 5.9), (1, 5.0, 1.0, 3.0)]
    df = spark.createDataFrame(rows, "cluster int, CARRIER_DELAY double, SECURITY_DELAY double, EXTRA_DELAY double")
    out = {(r.cluster, r.feature): r.correlation for r in
           P.cluster_cause_correlation(df, ["CARRIER_DELAY", "SECURITY_DELAY"]).collect()}
    assert out[(0, "SECURITY_DELAY")] is None          # constant → NULL, not an ANSI error
    assert out[(0, "CARRIER_DELAY")] > 0.99
    assert out[(1, "CARRIER_DELAY")] is None           # one-row cluster


def test_problem_airports_fractions_sum_to_one(spark):
    rows = [(f"A{i % 5}", float(i % 30)) for i in range(200)]
    df = spark.createDataFrame(rows, "ORIGIN string, EXTRA_DELAY double")
    s = P.problem_airports(df).agg(F.sum("fraction_problem_flights")).first()[0]
    assert abs(s - 1.0) < 1e-12
