"""Running totals over ranges, monthly states, buckets, headers by name and stored models."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from legworks.operators import ml as M
from legworks.operators import models as SM
from legworks.operators import propagation as P
from legworks.operators import recovery as R
from legworks.operators import routes as N
from legworks.operators import states as S
from legworks.operators.stats import running_totals
from legworks.schema import LEG_COLUMNS
from legworks.session import scratch_path
from legworks.sources import legs as L

# ------------------------------------------------------------- running totals


def _values(spark, kind, n=600, seed=4):
    rnd = random.Random(seed)
    make = {"minutes": lambda: float(rnd.randint(1, 12)), "continuous": lambda: rnd.uniform(0.1, 90.0)}
    rows = [(rnd.choice([2001, 2001, 2001, 2002, None]), make[kind]()) for _ in range(n)]
    return rows + [(2003, 5.0), (2001, None)], "YEAR int, ARR_DELAY double"


@pytest.mark.parametrize("kind", ["minutes", "continuous"])
@pytest.mark.parametrize("tasks", [1, 7, 40])
def test_running_totals_over_ranges(spark, kind, tasks):
    rows, schema = _values(spark, kind)
    df = spark.createDataFrame(rows, schema).repartition(5)
    out = running_totals(df, ["YEAR"], "ARR_DELAY", {"n": F.lit(1), "x": F.col("ARR_DELAY")}, tasks)
    got = {(r.YEAR, r.ARR_DELAY): r for r in out.collect()}
    known = [(y, v) for y, v in rows if v is not None]
    assert set(got) == set(known)
    for (year, value), r in got.items():
        own = [v for y, v in known if y == year]
        assert r.n == own.count(value) and r.n_total == len(own)
        assert r.n_below == sum(v < value for v in own)
        assert r.x_below == pytest.approx(sum(v for v in own if v < value))
        assert r.x_total == pytest.approx(sum(own))


def test_a_key_is_spread_over_tasks(spark):
    df = spark.range(4000).select(F.lit(2001).alias("YEAR"), (F.col("id") + 0.5).alias("v"))
    out = running_totals(df, ["YEAR"], "v", {"n": F.lit(1)}, tasks=8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    last = out.orderBy(F.col("v").desc()).head()
    assert (last.n_below, last.n_total) == (3999, 4000)


@pytest.mark.parametrize("ties", ["range", "rows"])
def test_unevenness_equals_the_histogram_form_on_minutes(spark, ties):
    rows, schema = _values(spark, "minutes")
    df = spark.createDataFrame([r for r in rows if r[0]], schema)
    want = {r.YEAR: (r.top10_delay_share, r.gini_delay)
            for r in R.delay_unevenness(df, ties=ties).collect()}
    got = {r.YEAR: (r.top_share, r.gini) for r in R.value_unevenness(
        df, "ARR_DELAY", ties=ties, tasks=9).collect() if r.top_share is not None}
    assert got.keys() == want.keys() and len(want) == 2
    for year in want:
        assert got[year] == pytest.approx(want[year])


def test_unevenness_of_continuous_values(spark):
    rows, schema = _values(spark, "continuous")
    rows = [(y, v) for y, v in rows if y == 2001 and v is not None]
    rows += [(2001, max(v for _, v in rows))] * 90          # peers across the tenth
    out = R.value_unevenness(spark.createDataFrame(rows, schema), "ARR_DELAY", tasks=11).head()
    x = sorted((v for _, v in rows), reverse=True)
    n, total = len(x), sum(x)
    edge = x[math.floor(n * 0.1) - 1]
    assert out.top_share == pytest.approx(sum(v for v in x if v >= edge) / total)
    gini = 2 * sum((i + 1) * v for i, v in enumerate(sorted(x))) / (n * total) - (n + 1) / n
    assert out.gini == pytest.approx(gini)


# -------------------------------------------------------------------- states


def _legs(spark, n=900, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        year, month, day = rnd.choice([2001, 2002]), rnd.choice([1, 2, 3]), rnd.randint(1, 28)
        dep = float(rnd.randint(-5, 200))
        done = rnd.random() > 0.05
        rows.append((i, year, month, f"{year}-{month:02d}-{day:02d}", rnd.choice(["A", "B"]),
                     rnd.choice(["X", "Y", "Z"]), rnd.choice(["c1", "c2", "c3"]), 930, 1045,
                     float(rnd.randint(60, 75)), dep if done else None,
                     dep + rnd.randint(-20, 30) if done else None, 0.0 if done else 1.0))
    df = spark.createDataFrame(rows, "id long, YEAR int, MONTH int, day string, ORIGIN string, "
                               "DEST string, OP_CARRIER string, CRS_DEP_TIME int, CRS_ARR_TIME int, "
                               "CRS_ELAPSED_TIME double, DEP_DELAY double, ARR_DELAY double, "
                               "CANCELLED double")
    return (df.withColumn("FL_DATE", F.to_date("day")).withColumn("DIVERTED", F.lit(0.0))
            .withColumn("OP_UNIQUE_CARRIER", F.col("OP_CARRIER"))
            .withColumns({c: F.col("id") % 7 * 1.0 for c in R.MIX_COLUMNS}))


def _reports(spark, path):
    def read(name, years=None):
        return S.read_state(spark, path, name, years)
    return {"regimes": S.recovery_regimes(read("regimes")), "mix": S.cause_mix_absolute(read("regimes")),
            "year": S.yearly_summary(read("delays")), "spread": S.delay_volatility(read("delays")),
            "routes": S.direct_routes(read("routes"), read("route_delays"))}


def _full(legs):
    late = R.delayed_flights(legs)
    clustered = R.bucket_clusters(late)
    return {"regimes": R.recovery_regimes(clustered), "mix": R.cause_mix_absolute(clustered),
            "year": R.yearly_summary(late, years=None), "spread": R.delay_volatility(late),
            "routes": N.direct_routes(N.schedule_minutes(legs))}


def _plain(df):
    return sorted(([round(v, 9) if isinstance(v, float) else v for v in r]
                   for r in df.select(sorted(df.columns)).collect()), key=repr)


def test_monthly_states_give_the_reports_of_a_full_run(spark):
    legs, path = _legs(spark), scratch_path(spark, "states")
    S.land_states(legs.where("MONTH < 3"), path)
    S.land_states(legs.where("MONTH = 3"), path)
    want = {k: _plain(v) for k, v in _full(legs).items()}
    assert {k: _plain(v) for k, v in _reports(spark, path).items()} == want
    S.land_states(legs.where("YEAR = 2001 AND MONTH = 2"), path)       # the same month again
    assert {k: _plain(v) for k, v in _reports(spark, path).items()} == want


def test_a_month_landed_anew_replaces_its_own_states_only(spark):
    legs, path = _legs(spark), scratch_path(spark, "states")
    S.land_states(legs, path)
    changed = legs.where("YEAR = 2001 AND MONTH = 2 AND ORIGIN = 'A'").withColumn(
        "DEP_DELAY", F.lit(1.0))            # no leg of it is a delayed flight any more
    S.land_states(changed, path)
    whole = legs.where("NOT (YEAR = 2001 AND MONTH = 2)").unionByName(changed)
    assert {k: _plain(v) for k, v in _reports(spark, path).items()} == {
        k: _plain(v) for k, v in _full(whole).items()}
    with pytest.raises(ValueError, match="name"):
        S.read_state(spark, path, "other")


def test_states_are_read_by_year(spark):
    legs, path = _legs(spark), scratch_path(spark, "states")
    S.land_states(legs, path)
    one = S.yearly_summary(S.read_state(spark, path, "delays", [2002]))
    assert _plain(one) == _plain(R.yearly_summary(R.delayed_flights(legs), years=[2002]))


def test_merged_sketches_keep_their_error_bound(spark, monkeypatch):
    monkeypatch.setattr(S, "SKETCH_K", 200)
    rnd = random.Random(9)
    rows = [(2001 + i % 3, 1 + i % 12, rnd.gauss(0, 30)) for i in range(30_000)]
    flights = spark.createDataFrame(rows, "YEAR int, MONTH int, arr_delay double").select(
        "*", F.lit("A").alias("src"), F.lit("B").alias("dst"), F.lit("c").alias("carrier"),
        F.lit(60.0).alias("flight_time"), F.to_date(F.lit("2001-02-03")).alias("date"))
    state = S.route_state(flights)
    for years in ([2001], [2001, 2003], [2001, 2002, 2003]):
        values = sorted(v for y, _, v in rows if y in years)
        r = S.route_quantiles(state.where(F.col("YEAR").isin(years)), (0.5, 0.9)).head()
        assert r.flight_count == len(values)
        for q, got in ((0.5, r.p50), (0.9, r.p90)):
            rank = np.searchsorted(values, got) / len(values)
            assert abs(rank - q) < 0.03            # k = 200: about 1.3 % of ranks


def test_day_bitmaps_count_distinct_days(spark):
    flights = N.schedule_minutes(_legs(spark))
    assert _plain(N.direct_routes(flights, days_method="bitmap")) == _plain(N.direct_routes(flights))
    bits = N.direct_routes(flights, days_method="bitmap")._jdf.queryExecution().executedPlan()
    two = N.direct_routes(flights)._jdf.queryExecution().executedPlan()
    assert bits.toString().count("Aggregate") < two.toString().count("Aggregate")
    old = spark.createDataFrame([("1950-01-01",)], "d string").select(F.to_date("d").alias("date"))
    with pytest.raises(Exception, match="1970-01-01"):
        old.agg(N.day_bitmap("date")).collect()
    none = spark.createDataFrame([(None,)], "date date")
    assert none.agg(N.day_bitmap("date").alias("n")).head().n == 0


# ------------------------------------------------------------------- buckets


def test_the_day_window_reads_buckets_without_a_shuffle(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["N1", "N2", "N3", None]), f"2001-01-{rnd.randint(1, 5):02d}",
             float(rnd.randint(0, 2359)), float(rnd.randint(-10, 60)), float(rnd.randint(-10, 60)))
            for i in range(300)] + [(900, "N1", None, 5.0, 5.0, 5.0)]
    clean = spark.createDataFrame(rows, "id long, TAIL_NUM string, d string, DEP_TIME double, "
                                  "DEP_DELAY double, ARR_DELAY double").select(
        "*", F.to_date("d").alias("FL_DATE_DT")).drop("d")
    path = scratch_path(spark, "buckets")
    name = "buckets_" + path.rsplit("-", 1)[-1]
    table = L.land_bucketed(clean, name, path, ["TAIL_NUM", "FL_DATE_DT"],
                            ["TAIL_NUM", "FL_DATE_DT", "DEP_TIME", "id"], buckets=4)
    out = P.extra_delay(table, tie_break=["id"], spread_alone=False)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert _plain(out) == _plain(P.extra_delay(clean, tie_break=["id"]))
    with pytest.raises(ValueError, match="anew"):
        L.land_bucketed(clean, name, path, ["TAIL_NUM"], buckets=4)


# ------------------------------------------------------------------- headers


def _monthly_files(tmp_path):
    names = [n for n, _ in LEG_COLUMNS]
    row = {n: "" for n in names} | {"YEAR": "2001", "MONTH": "1", "ORIGIN": "AAA", "DEST": "BBB",
                                    "DEP_DELAY": "5.0", "ARR_DELAY": "7.0", "TAXI_OUT": "3.0"}
    swapped = names[::-1]
    fewer = [n for n in names if n not in ("TAXI_OUT", "TAXI_IN")] + ["REMARK"]
    for i, columns in enumerate((names, swapped, fewer)):
        lines = [",".join(columns)] + [",".join({**row, "MONTH": str(i + 1), "REMARK": "hm"}[c]
                                                for c in columns) for _ in range(i + 1)]
        (tmp_path / f"{i}.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "3.csv").write_text(",".join(n.lower() for n in names) + ",\n")
    (tmp_path / "4.csv").write_text("")
    return str(tmp_path)


def test_files_of_differing_headers_give_one_table(spark, tmp_path):
    folder = _monthly_files(tmp_path)
    legs = L.read_legs(spark, folder, headers="by_name")
    assert legs.columns == [n for n, _ in LEG_COLUMNS]
    rows = legs.select("MONTH", "ORIGIN", "DEST", "ARR_DELAY", "TAXI_OUT").collect()
    assert sorted(tuple(r) for r in rows if r.TAXI_OUT is not None) == [
        (1, "AAA", "BBB", 7.0, 3.0), (2, "AAA", "BBB", 7.0, 3.0), (2, "AAA", "BBB", 7.0, 3.0)]
    assert [tuple(r) for r in rows if r.TAXI_OUT is None] == [(3, "AAA", "BBB", 7.0, None)] * 3
    lack = L.missing_values(legs, ["TAXI_OUT", "ORIGIN"]).head()
    assert (lack.lines, lack.TAXI_OUT_missing, lack.ORIGIN_missing) == (6, 3, 0)
    report = {tuple(r.further): r for r in L.header_report(spark, folder).collect() if r.missing}
    assert report[("REMARK",)].missing == ["TAXI_OUT", "TAXI_IN"]
    orders = sorted((r.in_order, r.files) for r in L.header_report(spark, folder).collect())
    assert orders == [(False, 1), (True, 1), (True, 2)]
    with pytest.raises(Exception):
        L.read_legs(spark, folder).collect()
    with pytest.raises(ValueError, match="headers"):
        L.read_legs(spark, folder, headers="any")


def test_bad_rows_are_kept_by_name(spark, tmp_path):
    folder = _monthly_files(tmp_path)
    text = (tmp_path / "1.csv").read_text()
    (tmp_path / "1.csv").write_text(text.replace("2001", "20x1", 1))
    legs = L.read_legs(spark, folder, bad_rows="keep", headers="by_name")
    bad = legs.where("_rejected IS NOT NULL").collect()
    assert len(bad) == 1 and bad[0].YEAR is None and "20x1" in bad[0]["_rejected"]
    assert legs.count() == 6


def test_a_header_that_names_a_column_twice_is_refused(spark, tmp_path):
    (tmp_path / "x.csv").write_text("YEAR,MONTH,year\n1,2,3\n")
    with pytest.raises(ValueError, match="twice"):
        L.read_legs(spark, str(tmp_path), headers="by_name")


# -------------------------------------------------------------------- models


def _points(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(0, 1, (150, 2)), rng.normal(8, 1, (150, 2))])
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)],
                                 "id long, a double, b double")


def test_models_score_after_reload_as_before(spark, tmp_path):
    df = _points(spark)
    fit = M.fit_kmeans(df, ["a", "b"], k=2, scale=True)
    path = SM.save_kmeans(spark, fit, str(tmp_path / "centres"))
    other = spark.newSession()
    assert SM.load_kmeans(other, path) == fit
    assert _plain(SM.score_kmeans(df, path)) == _plain(fit.assign(df))
    forest = M.isolation_forest(df, ["a", "b"], ["id"], num_trees=8, max_samples=64)
    limit = M.score_threshold(df, forest).head()[0]
    trees = SM.save_forest(spark, forest, str(tmp_path / "trees"), limit)
    again, threshold = SM.load_forest(other, trees)
    assert threshold == limit and again.features == ["a", "b"]
    x = np.array([(r.a, r.b) for r in df.collect()])
    assert np.array_equal(again.path_lengths(x), forest.path_lengths(x))
    want = M.anomaly_scores(df, df, ["a", "b"], ["id"], num_trees=8, max_samples=64)
    assert _plain(SM.score_forest(df, trees)) == _plain(want)
    SM.save_forest(spark, forest, trees)
    assert "final_prediction" not in SM.score_forest(df, trees).columns


def test_a_model_of_another_kind_is_refused(spark, tmp_path):
    path = SM.save_kmeans(spark, M.KMeansFit(("a",), ((1.0,),), (0.0,), (1.0,)), str(tmp_path / "m"))
    with pytest.raises(ValueError, match="kind"):
        SM.load_forest(spark, path)
    spark.range(3).write.parquet(str(tmp_path / "n"))
    with pytest.raises(ValueError, match="no model"):
        SM.load_kmeans(spark, str(tmp_path / "n"))
    spark.read.parquet(path).withColumn("version", F.lit(99)).write.parquet(str(tmp_path / "v"))
    with pytest.raises(ValueError, match="version"):
        SM.load_kmeans(spark, str(tmp_path / "v"))
