"""ML, report and ingest fixtures (FIXTURES §3: outliers) and properties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from legworks.operators import ml as M
from legworks.operators import report as RP
from legworks.sources import legs as L


def _outliers(spark):
    rng = np.random.default_rng(7)
    regular = rng.normal(0, 1, size=(500, 10))
    far = rng.normal(0, 1, size=(10, 10)) + 12.0
    rows = [(i, *map(float, r)) for i, r in enumerate(np.vstack([regular, far]))]
    cols = ", ".join(f"f{j} double" for j in range(10))
    return spark.createDataFrame(rows, f"id long, {cols}"), [f"f{j}" for j in range(10)]


def test_isolation_forest_ranks_far_rows_first(spark):
    df, feats = _outliers(spark)
    scored = M.anomaly_scores(df, df, feats, ["id"], contamination=0.05, num_trees=30,
                              max_samples=128, seed=3)
    top = [r.id for r in scored.orderBy(F.col("anomaly_score").desc(), "id").limit(10).collect()]
    assert sorted(top) == list(range(500, 510))
    rate = scored.agg(F.avg("final_prediction")).first()[0]
    assert 0.02 <= rate <= 0.08                      # ≈ contamination
    assert scored.where("anomaly_score <= 0 OR anomaly_score > 1").count() == 0


def test_isolation_forest_independent_of_layout(spark):
    df, feats = _outliers(spark)
    a = M.anomaly_scores(df.repartition(3), df, feats, ["id"], num_trees=10, max_samples=64)
    b = M.anomaly_scores(df.repartition(7), df, feats, ["id"], num_trees=10, max_samples=64)
    sa = {r.id: r.anomaly_score for r in a.collect()}
    sb = {r.id: r.anomaly_score for r in b.collect()}
    assert sa == sb


def test_standardize_and_centroids(spark):
    df = spark.createDataFrame([(1.0, 10.0), (2.0, 10.0), (3.0, 10.0), (10.0, 10.0)], "x double, y double")
    z = M.standardize(df, ["x", "y"]).collect()
    xs = [r.x_z for r in z]
    assert abs(sum(xs)) < 1e-9 and np.std(xs, ddof=1) == pytest.approx(1.0)
    assert all(r.y_z == 0.0 for r in z)               # zero std → 0
    cents = spark.createDataFrame([(0, 1.5, 10.0), (1, 9.0, 10.0)], "cluster int, x double, y double")
    got = [r.assigned for r in M.assign_centroids(df, cents, ["x", "y"]).collect()]
    assert got == [0, 0, 0, 1]


def test_kmeans_relabels_by_first_feature(spark):
    rows = [(i, float(v + (i % 5) * 0.01), float(v)) for i, v in enumerate([0] * 30 + [50] * 30 + [100] * 30)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    out = M.kmeans_clusters(df, ["a", "b"], k=3, seed=42)
    means = {r.cluster: r.m for r in out.groupBy("cluster").agg(F.avg("a").alias("m")).collect()}
    assert [round(means[c]) for c in sorted(means)] == [0, 50, 100]


def test_kmeans_refuses_null_features_and_repeats(spark):
    rows = [(i, float(i % 7), float(i % 3) if i % 10 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    with pytest.raises(Exception, match="(?i)null"):
        M.fit_kmeans(df, ["a", "b"], k=3)
    whole = df.where("b IS NOT NULL")
    fit = M.fit_kmeans(whole.repartition(3), ["a", "b"], k=3, scale=True)
    again = M.fit_kmeans(whole.repartition(7), ["a", "b"], k=3, scale=True)
    assert fit == again
    out = fit.assign(df)
    assert out.count() == 100 and out.where("cluster IS NULL").count() == 10


def _delay_rows(spark, n=4000):
    rng = np.random.default_rng(11)
    centre = rng.integers(0, 3, n)
    rows = [(i, float(round(x)), float(round(y))) for i, (x, y) in enumerate(
        rng.normal(0, 12, (n, 2)) + np.array([[0, 0], [60, 20], [140, 160]])[centre])]
    return spark.createDataFrame(rows, "id long, a double, b double")


def test_weighted_points_count_every_row(spark):
    df = _delay_rows(spark)
    points = M.weighted_points(df.repartition(5), ["a", "b"])
    got = {(r.a, r.b): r[M.POINT_WEIGHT] for r in points.collect()}
    want = {(r.a, r.b): float(r["count"]) for r in df.groupBy("a", "b").count().collect()}
    assert got == want and len(got) < 4000
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "a double")
    assert sorted(tuple(r) for r in M.weighted_points(zeros, ["a"]).collect()) == [(0.0, 2.0), (1.0, 1.0)]


def test_kmeans_on_points_equals_a_fit_on_all_rows(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    df = _delay_rows(spark)
    points = M.weighted_points(df, ["a", "b"])
    fit = M.fit_kmeans(df, ["a", "b"], k=3, seed=42, points=points)
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    full = KMeans(k=3, seed=42, maxIter=20).fit(rows)
    assert M.inertia(points, fit) == pytest.approx(full.summary.trainingCost, rel=1e-3)
    # the same sum over the rows themselves
    x = np.array([(r.a, r.b) for r in df.collect()])
    away = ((x[:, None, :] - np.array(fit.centres)[None]) ** 2).sum(axis=2).min(axis=1)
    assert M.inertia(points, fit) == pytest.approx(away.sum())


def test_lloyd_is_plain_lloyd_and_improves_a_poor_start(spark):
    df = _delay_rows(spark)
    points = M.weighted_points(df, ["a", "b"])
    start = M.KMeansFit(("a", "b"), ((0.0, 0.0), (5.0, 0.0), (10.0, 0.0)), (0.0, 0.0), (1.0, 1.0))
    x = np.array([(r.a, r.b) for r in df.collect()])
    centres = np.array(start.centres)
    for _ in range(4):
        own = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([x[own == i].mean(axis=0) if (own == i).any() else centres[i]
                            for i in range(3)])
    got = M.lloyd(points, start, rounds=4)
    assert np.allclose(np.array(got.centres), centres)
    # what the catalogue's column "settled" tells apart
    assert M.inertia(points, start) > 2 * M.inertia(points, M.lloyd(points, start))
    fit = M.fit_kmeans(df, ["a", "b"], k=3, points=points)
    assert M.inertia(points, fit) <= 1.02 * M.inertia(points, M.lloyd(points, fit))


def test_lloyd_keeps_a_centre_without_points(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "a double")
    start = M.KMeansFit(("a",), ((2.0,), (900.0,)), (0.0,), (1.0,))
    assert M.lloyd(M.weighted_points(df, ["a"]), start).centres == ((2.0,), (900.0,))


def test_quantile_start_is_made_of_values(spark):
    df = spark.createDataFrame([(float(i), float(i % 10)) for i in range(100)], "a double, b double")
    assert M.quantile_start(df, ["a", "b"], 2).centres == ((24.0, 2.0), (74.0, 7.0))


def test_profile_one_pass(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 10.0)], "flag int, v double")
    out = {r.flag: r for r in RP.profile(df, "flag", ["v"]).collect()}
    assert out[0].v_mean == 2.0 and out[0].v_std == pytest.approx(2 ** 0.5)
    assert out[1].v_std is None


def test_month_coverage_statuses(spark):
    df = spark.createDataFrame([(2024, 1), (2024, 3), (2025, 11)], "YEAR int, MONTH int")
    cov = {(r.YEAR, r.MONTH): r.status for r in
           L.month_coverage(df, (2024, 1), (2025, 12), (2025, 10)).collect()}
    assert len(cov) == 24
    assert cov[(2024, 1)] == "present" and cov[(2024, 2)] == "missing"
    assert cov[(2025, 11)] == "future"                # future wins even if present
    tally = {r.status: r.months for r in L.coverage_tally(L.month_coverage(
        df, (2024, 1), (2025, 12), (2025, 10))).collect()}
    assert tally == {"present": 2, "missing": 20, "future": 2}


def test_csv_round_trip_source_layout(spark, tmp_path):
    df = spark.createDataFrame([("1/5/2003 12:00:00 AM", "ABC", "", 12.0)],
                               "FL_DATE string, ORIGIN string, DEP_TIME string, DEP_DELAY double")
    path = str(tmp_path / "legs")
    L.write_report(L.to_source_layout(df), path, fmt="csv")
    back = L.read_legs(spark, path)
    assert len(back.columns) == 77
    row = back.first()
    assert row.FL_DATE == "1/5/2003 12:00:00 AM" and row.DEP_DELAY == 12.0
    assert row.DEP_TIME is None and row.YEAR is None  # blank and absent fields are NULL


def test_train_split_is_layout_independent(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = {r.k: r.split for r in L.train_split(df.repartition(3), 0.3, ["k"]).collect()}
    b = {r.k: r.split for r in L.train_split(df.repartition(5), 0.3, ["k"]).collect()}
    assert a == b
    frac = sum(v == "train" for v in a.values()) / len(a)
    assert 0.25 < frac < 0.35


def test_filter_funnel_counts(spark):
    df = spark.createDataFrame([(0.0, 0.0, 20.0, 5.0), (1.0, 0.0, None, None), (0.0, 0.0, 5.0, 0.0)],
                               "CANCELLED double, DIVERTED double, DEP_DELAY double, ARR_DELAY double")
    r = L.filter_funnel(df).first()
    assert (r.raw_rows, r.completed_rows, r.delayed_rows) == (3, 2, 1)


def _month(spark, year, month, delays):
    rows = [(year, month, f"{month}/{i + 1}/{year}", "ABC", float(d)) for i, d in enumerate(delays)]
    return spark.createDataFrame(rows, "YEAR int, MONTH int, FL_DATE string, ORIGIN string, "
                                       "DEP_DELAY double")


def test_streaming_landing_is_incremental(spark, tmp_path):
    from legworks.streaming import land_stream

    src, out = tmp_path / "csv", str(tmp_path / "landed")
    L.write_report(L.to_source_layout(_month(spark, 2003, 1, [5, 7])), str(src / "1"), fmt="csv")
    land_stream(spark, str(src / "*"), out).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    L.write_report(L.to_source_layout(_month(spark, 2003, 2, [1])), str(src / "2"), fmt="csv")
    land_stream(spark, str(src / "*"), out).awaitTermination()   # a restart: only the new file
    landed = spark.read.parquet(out)
    assert sorted((r.MONTH, r.DEP_DELAY) for r in landed.collect()) == [(1, 5.0), (1, 7.0), (2, 1.0)]
    with pytest.raises(ValueError, match="stream"):               # one kind of writer a table
        L.land_parquet(_month(spark, 2003, 3, [1]), out)


def test_stream_refuses_a_batch_table(spark, tmp_path):
    from legworks.streaming import land_stream

    out = str(tmp_path / "batch")
    L.land_parquet(_month(spark, 2003, 1, [5]), out)
    with pytest.raises(ValueError, match="hidden"):
        land_stream(spark, str(tmp_path), out)


def test_months_land_one_by_one_and_again(spark, tmp_path):
    out = str(tmp_path / "landed")
    L.land_parquet(_month(spark, 2003, 1, [5, 7]), out)
    L.land_parquet(_month(spark, 2003, 2, [1]), out)
    L.land_parquet(_month(spark, 2003, 1, [6]), out)              # January again, corrected
    rows = sorted((r.MONTH, r.DEP_DELAY) for r in L.read_landed(spark, out).collect())
    assert rows == [(1, 6.0), (2, 1.0)]
    L.land_parquet(_month(spark, 2003, 2, [2]), out, mode="append")
    assert L.read_landed(spark, out).count() == 3
    L.land_parquet(_month(spark, 2004, 1, [9]), out, mode="overwrite")
    assert L.read_landed(spark, out).count() == 1


def test_gathered_landing_splits_a_large_year(spark, tmp_path):
    import glob
    df = spark.range(400_000).select(F.lit(2001).alias("YEAR"), F.col("id"), F.rand(3).alias("x"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        L.land_parquet(df, str(tmp_path / "t"), partition_by=("YEAR",), gather=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(str(tmp_path / "t" / "YEAR=2001" / "*.parquet"))) > 1


def test_csv_headers_are_checked_and_bad_lines_counted(spark, tmp_path):
    good = L.to_source_layout(_month(spark, 2003, 1, [5, 7]))
    swapped = good.select(*["DEST" if c == "ORIGIN" else "ORIGIN" if c == "DEST" else c
                            for c in good.columns])
    L.write_report(swapped, str(tmp_path / "swapped"))
    with pytest.raises(Exception, match="(?i)header"):
        L.read_legs(spark, str(tmp_path / "swapped")).select("ORIGIN").collect()
    bad = good.withColumn("YEAR", F.when(F.col("DEP_DELAY") == 7, "2003.5").otherwise("2003"))
    L.write_report(bad, str(tmp_path / "bad"))
    with pytest.raises(Exception, match="(?i)malformed"):
        L.read_legs(spark, str(tmp_path / "bad")).select("YEAR").collect()
    kept = L.read_legs(spark, str(tmp_path / "bad"), bad_rows="keep")
    got = {r.YEAR: (r.lines, r.rejected) for r in L.rejected_rows(kept).collect()}
    assert got == {2003: (1, 0), None: (1, 1)}
    assert kept.where("_rejected IS NOT NULL").first().ORIGIN == "ABC"


def test_scratch_tables_can_be_cleared(spark, tmp_path):
    from legworks import session as S
    path = S.scratch_path(spark, "probe")
    spark.range(3).write.parquet(path)
    before = S.file_stamp(spark, path)
    assert S.exists(spark, path) and len(before) >= 1
    spark.range(4).write.mode("overwrite").parquet(path)
    assert S.file_stamp(spark, path) != before


def test_land_parquet_layouts(spark, tmp_path):
    import glob
    df = spark.range(3000).select((F.col("id") % 3 + 2000).cast("int").alias("YEAR"),
                                  (F.col("id") % 12 + 1).cast("int").alias("MONTH"),
                                  F.col("id").alias("k")).repartition(4)
    salted = str(tmp_path / "salted")
    L.land_parquet(df, salted, partition_by=("YEAR",), files_per_partition=3)
    for year in (2000, 2001, 2002):
        files = glob.glob(f"{salted}/YEAR={year}/*.parquet")
        assert 1 <= len(files) <= 3
    plain = str(tmp_path / "plain")
    L.land_parquet(df, plain)                                   # no shuffle, YEAR/MONTH folders
    back = L.read_landed(spark, plain, years=[2001])
    assert back.count() == 1000
    assert L.read_landed(spark, salted).count() == 3000


def test_kmeans_rows_nearest_to_own_centre(spark):
    rng = np.random.default_rng(9)
    centres = [(0.0, 0.0), (30.0, 5.0), (10.0, 40.0)]
    rows = [(i, float(cx + rng.normal(0, 2)), float(cy + rng.normal(0, 2)))
            for i, (cx, cy) in enumerate(centres[j % 3] for j in range(600))]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    out = M.kmeans_clusters(df, ["a", "b"], k=3, seed=42)
    assert out.select("cluster").distinct().count() == 3
    checked = M.assign_centroids(out, M.centroid_table(out, ["a", "b"]), ["a", "b"])
    assert checked.where(F.col("assigned") != F.col("cluster")).count() == 0


def _lineitem(spark, folder, rows):
    """A source table of ``rows`` (order, part, supplier, line, quantity, date)."""
    (spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                           "l_quantity double, l_shipdate string")
     .withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))
     .write.parquet(f"{folder}/lineitem.parquet"))
    return str(folder)


def test_legs_are_read_from_the_source(spark, tmp_path):
    from legworks.plans.common import legs
    from legworks.plans.report_queries import QUERIES
    folder = _lineitem(spark, tmp_path, [
        (i, i + 3, 1, 1, 5.0 + i % 9, f"{1995 + i % 4}-0{1 + i % 9}-1{i % 9}") for i in range(300)]
        + [(7, 9, 1, 2, 9.0, None), (None, 9, None, 3, None, "1996-12-31")])
    rows = legs(spark, folder)
    # no wide copy is shuffled or written: the scan is that of the source
    assert all(f.startswith(f"file://{tmp_path}") or f.startswith(f"file:{tmp_path}")
               for f in rows.inputFiles())
    assert rows.count() == 302 and rows.where("YEAR IS NULL").count() == 1
    some = legs(spark, folder, years=[1996, 1998])
    assert (sorted(map(repr, some.collect()))
            == sorted(map(repr, rows.where("YEAR IN (1996, 1998)").collect()))) and some.count() == 151
    assert QUERIES["airport_regime_mix"](spark, folder).count() == 10


def test_weighted_points_give_the_quantiles_of_their_rows(spark):
    rng = np.random.default_rng(11)
    rows = [(float(a), float(b)) for a, b in zip(rng.integers(-9, 30, 700), rng.integers(0, 5, 700),
                                                 strict=True)] + [(-0.0, 1.0), (0.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    points = M.weighted_points(df, ["a", "b"], laid_out=False)
    same = M.weighted_points(df, ["a", "b"])
    assert sorted(points.collect()) == sorted(same.collect()) and points.count() < 250
    for k in (1, 3, 7):
        assert (M.quantile_start(points, ["a", "b"], k, M.POINT_WEIGHT)
                == M.quantile_start(df, ["a", "b"], k))
    one = spark.createDataFrame([(5.0, 3.0), (9.0, 0.0)], f"a double, {M.POINT_WEIGHT} double")
    assert M.quantile_start(one, ["a"], 2, M.POINT_WEIGHT).centres == ((5.0,), (5.0,))
