"""Hand fixtures for the recovery family (FIXTURES §3: clusters, ties_year)."""

import math

import pytest
from pyspark.sql import functions as F

from legworks.operators import recovery as R
from legworks.schema import DELAY_WORSENED, NOT_ACHIEVED, RECOVERY_ACHIEVED


def _clusters(spark, rows):
    return spark.createDataFrame(rows, "cluster int, YEAR int, DEP_DELAY double, ARR_DELAY double")\
        .withColumn("DELAY_CHANGE", F.col("ARR_DELAY") - F.col("DEP_DELAY"))


def test_regime_labels_match_worked_examples(spark):
    # cluster means dep 160 / change -3.6, dep 33.5 / -7.5, dep 48.5 / +25, and one
    # sitting exactly on its threshold (dep 50, change -5 → threshold 5 → achieved)
    rows = [(0, 2000, 160.0, 156.4), (1, 2000, 33.5, 26.0), (2, 2000, 48.5, 73.5),
            (3, 2000, 50.0, 45.0)]
    summary = {r.cluster: r for r in R.cluster_summary(_clusters(spark, rows)).collect()}
    assert summary[0].recovery_status == NOT_ACHIEVED
    assert summary[1].recovery_status == RECOVERY_ACHIEVED
    assert summary[2].recovery_status == DELAY_WORSENED
    assert summary[3].recovery_status == RECOVERY_ACHIEVED
    assert summary[0].threshold == pytest.approx(16.0)


def test_recovery_regimes_pre_aggregated_equals_row_labels(spark):
    rows = [(c, y, float(10 + i), float(10 + i + (c - 1) * 15))
            for i, (c, y) in enumerate([(0, 2001), (1, 2001), (2, 2002), (0, 2002), (2, 2002)] * 7)]
    df = _clusters(spark, rows)
    got = {(r.YEAR, r.recovery_status): r["count"] for r in R.recovery_regimes(df).collect()}
    want = {}
    for r in R.label_regimes(df, columns=None).collect():
        want[(r.YEAR, r.recovery_status)] = want.get((r.YEAR, r.recovery_status), 0) + 1
    assert got == want


def _ties_year(spark):
    # 2001: 20 positive delays, three tied at the 10 % cut (rank 2 of 20 → value 50)
    y1 = [100.0, 50.0, 50.0, 50.0] + [float(v) for v in range(1, 17)]
    # 2002: 9 rows → n·0.1 < 1, no row
    y2 = [float(v) for v in range(10, 19)]
    rows = [(2001, v) for v in y1] + [(2002, v) for v in y2] + [(2001, None), (2001, -5.0)]
    return spark.createDataFrame(rows, "YEAR int, ARR_DELAY double")


def test_top_decile_share_range_counts_tied_peers(spark):
    df = _ties_year(spark)
    total = 100 + 150 + sum(range(1, 17))
    got = {r.YEAR: r.top10_delay_share for r in R.top_decile_share(df).collect()}
    assert set(got) == {2001}
    # ranks 1..2 are kept; rank 2 is a 50 with two tied peers, all counted (RANGE)
    assert got[2001] == pytest.approx(250 / total)
    strict = {r.YEAR: r.top10_delay_share for r in R.top_decile_share(df, ties="rows").collect()}
    assert strict[2001] == pytest.approx(150 / total)


def test_gini_matches_row_formula(spark):
    df = _ties_year(spark)
    got = {r.YEAR: r.gini_delay for r in R.delay_gini(df).collect()}
    for year, values in ((2001, [100.0, 50.0, 50.0, 50.0] + [float(v) for v in range(1, 17)]),
                         (2002, [float(v) for v in range(10, 19)])):
        x = sorted(values)
        n = len(x)
        expect = 2 * sum((i + 1) * v for i, v in enumerate(x)) / (n * sum(x)) - (n + 1) / n
        assert got[year] == pytest.approx(expect)
        assert 0 <= got[year] < 1


def test_airport_contribution_shares_sum_to_one(spark):
    rows = [(2000 + (i % 3), f"A{i % 13:02d}", float(i % 17 - 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "YEAR int, ORIGIN string, ARR_DELAY double")
    full = R.airport_contribution(df, top_n=100)
    for r in full.groupBy("YEAR").agg(F.sum("delay_share").alias("s")).collect():
        assert math.isclose(r.s, 1.0, rel_tol=1e-9)
    top = R.airport_contribution(df, top_n=3)
    assert top.groupBy("YEAR").count().where("count > 3").count() == 0


def test_delayed_flights_filter_bounds(spark):
    rows = [(10.0, 0.0, 0.0, 0.0), (11.0, -15.0, 0.0, 0.0), (11.0, -16.0, 0.0, 0.0),
            (360.0, 360.0, 0.0, 0.0), (361.0, 0.0, 0.0, 0.0), (50.0, 20.0, 1.0, 0.0),
            (50.0, None, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "DEP_DELAY double, ARR_DELAY double, CANCELLED double, DIVERTED double")
    out = R.delayed_flights(df, columns=["DEP_DELAY", "ARR_DELAY", "CANCELLED", "DIVERTED"])
    assert sorted((r.DEP_DELAY, r.ARR_DELAY) for r in out.collect()) == [(11.0, -15.0), (360.0, 360.0)]
