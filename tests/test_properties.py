"""Randomised properties: histogram formulas against row-level brute force,
and results independent of the input's partitioning (SURVEY §5 layer 3)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from legworks.operators import propagation as P
from legworks.operators import recovery as R
from legworks.operators.stats import exact_percentile


def _random_years(seed: int, years: int = 40):
    rng = np.random.default_rng(seed)
    rows = []
    for y in range(years):
        n = int(rng.integers(1, 120))
        # few distinct values → many ties, some non-positive values
        vals = rng.integers(-20, 40, size=n) * int(rng.integers(1, 4))
        rows += [(2000 + y, float(v), float(abs(v) + 3)) for v in vals]
    return rows


def _row_top_share(values, fraction=0.1):
    """Row-level reference semantics: row_number by delay desc, RANGE running sum."""
    x = sorted((v for v in values if v > 0), reverse=True)
    n = len(x)
    if not x:
        return None
    total = sum(x)
    best = None
    for i, v in enumerate(x, start=1):
        if i <= n * fraction:
            cum = sum(w for w in x if w >= v)          # RANGE frame: all peers
            best = cum / total if best is None else max(best, cum / total)
    return best


def _row_gini(values):
    x = sorted(v for v in values if v > 0)
    n = len(x)
    if not x:
        return None
    return 2 * sum(i * v for i, v in enumerate(x, start=1)) / (n * sum(x)) - (n + 1) / n


def _disc_quantile(values, p):
    x = sorted(v for v in values if v is not None)
    return x[math.ceil(p * len(x)) - 1] if x else None


@pytest.mark.parametrize("seed", [1, 2])
def test_histogram_measures_match_row_formulas(spark, seed):
    rows = _random_years(seed)
    df = spark.createDataFrame(rows, "YEAR int, ARR_DELAY double, DEP_DELAY double")
    by_year = {}
    for y, a, _ in rows:
        by_year.setdefault(y, []).append(a)
    top = {r.YEAR: r.top10_delay_share for r in R.top_decile_share(df).collect()}
    gini = {r.YEAR: r.gini_delay for r in R.delay_gini(df).collect()}
    summ = {r.YEAR: r for r in R.yearly_summary(df, years=None).collect()}
    p90 = {r.YEAR: r.p for r in df.groupBy("YEAR").agg(
        exact_percentile("ARR_DELAY", 0.9).alias("p")).collect()}
    for y, vals in by_year.items():
        want_top = _row_top_share(vals)
        if want_top is None:
            assert y not in top
        else:
            assert top[y] == pytest.approx(want_top, rel=1e-12)
        want_gini = _row_gini(vals)
        if want_gini is None:
            assert y not in gini
        else:
            assert gini[y] == pytest.approx(want_gini, rel=1e-9, abs=1e-12)
            assert 0 <= gini[y] < 1
        assert summ[y].median_arr == _disc_quantile(vals, 0.5)
        assert summ[y].mean_arr == pytest.approx(float(np.mean(vals)))
        assert p90[y] == _disc_quantile(vals, 0.9)


def test_results_independent_of_partitioning(spark):
    rows = _random_years(5, years=12)
    base = spark.createDataFrame(rows, "YEAR int, ARR_DELAY double, DEP_DELAY double")
    shuffled = base.repartition(7, "DEP_DELAY")
    for op in (R.delay_unevenness, R.delay_volatility, R.airport_concentration):
        if op is R.airport_concentration:
            a = op(base.withColumn("ORIGIN", F.lit("X")))
            b = op(shuffled.withColumn("ORIGIN", F.lit("X")))
        else:
            a, b = op(base), op(shuffled)
        ra = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in a.collect())
        rb = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in b.collect())
        assert ra == rb


def test_extra_delay_independent_of_partitioning(spark):
    rng = np.random.default_rng(11)
    import datetime as dt
    rows = []
    for k in range(400):
        tail = None if k % 37 == 0 else f"N{int(rng.integers(0, 9))}"
        day = dt.date(2003, 1, 1) + dt.timedelta(days=int(rng.integers(0, 3)))
        rows.append((tail, day, float(rng.integers(500, 2300)), float(rng.integers(-10, 90)),
                     float(rng.integers(-20, 90)), k))
    df = spark.createDataFrame(rows, "TAIL_NUM string, FL_DATE_DT date, DEP_TIME double, "
                                     "DEP_DELAY double, ARR_DELAY double, key long")
    a = {r.key: r.EXTRA_DELAY for r in P.extra_delay(df, tie_break=["key"]).collect()}
    b = {r.key: r.EXTRA_DELAY for r in
         P.extra_delay(df.repartition(5, "key"), tie_break=["key"]).collect()}
    assert a == b
    assert all(v >= 0 for v in a.values())
