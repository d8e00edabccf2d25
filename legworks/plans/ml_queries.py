"""Catalogue entries for the ML family, with their oracle SQL.

A randomised fit leaves its centres and trees open, but the data fix a lot of what must
come out: which rows are scored, that each row is in the cluster of its nearest fitted
centre, that scores lie in (0, 1], that about the asked share is flagged, and that
groups add up to the whole.  The fitted entries return that, for every row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from legworks.operators import ml as M
from legworks.operators import models as SM
from legworks.operators import recovery as R
from legworks.operators.report import profile
from legworks.plans.common import legs, rounded
from legworks.plans.propagation_queries import CLEAN, EXTRA, KEYS, clean, extra
from legworks.plans.recovery_queries import (CLUSTERED, DELAYED, DELAYED_DOUBLES, _clustered,
                                             _delayed)
from legworks.plans.report_queries import PROFILE_FEATURES
from legworks.plans.sqltext import sql
from legworks.session import scratch_path
from legworks.sources.legs import train_split

# The features, cluster counts and seed of the two analyses.
RECOVERY_FEATURES = ["DEP_DELAY", "ARR_DELAY", "DELAY_CHANGE"]
PROPAGATION_FEATURES = ["DEP_DELAY", "ARR_DELAY", "EXTRA_DELAY", "DISTANCE"]
RECOVERY_K, PROPAGATION_K, SEED = 3, 6, 42
CONTAMINATION = 0.05
SETTLED = 1.02             # the fit's inertia over that of Lloyd's rounds from its centres
SETTLED_ROUNDS = 3
LLOYD_ROUNDS = 6


def _fit(rows, features, k, scale=False):
    """The fit, and whether it is settled: Lloyd's rounds from its centres gain next to nothing."""
    points = M.weighted_points(rows, features)
    fit = M.fit_kmeans(rows, features, k, SEED, scale=scale, points=points)
    better = M.lloyd(points, fit, SETTLED_ROUNDS)
    return fit, M.inertia(points, fit) <= SETTLED * M.inertia(points, better)


def _fit_recovery(spark, sf_dir):
    delayed = R.delayed_flights(legs(spark, sf_dir), columns=R.BASE_COLUMNS + KEYS)
    return delayed, *_fit(delayed, RECOVERY_FEATURES, RECOVERY_K, scale=True)


def _nearest(rows, fit):
    """Whether the row's cluster is one whose centre no other is nearer than."""
    away = [sum((x - F.lit(v)) * (x - F.lit(v)) for x, v in zip(fit.scaled(), c, strict=True))
            for c in fit.centres]
    own = F.get(F.array(*away), F.col("cluster"))
    return rows.withColumn("nearest", own <= F.least(*away) + F.lit(1e-9))


def _kmeans_recovery(spark, sf_dir):
    delayed, fit, settled = _fit_recovery(spark, sf_dir)
    rows = _nearest(fit.assign(delayed), fit)
    return R.label_regimes(rows, columns=None).select(
        *KEYS, "YEAR", *RECOVERY_FEATURES, "nearest", F.lit(settled).alias("settled"),
        F.col("recovery_status").isNotNull().alias("labelled"))


def _kmeans_lloyd(spark, sf_dir):
    """k-means without a draw: Lloyd's rounds from quantiles, whose centres SQL can check.

    The day window over the legs runs once, for the points; quantiles, rounds and the clusters'
    figures count each point with its legs."""
    points = M.weighted_points(extra(spark, sf_dir), PROPAGATION_FEATURES, laid_out=False)
    fit = M.lloyd(points, M.quantile_start(points, PROPAGATION_FEATURES, PROPAGATION_K,
                                           M.POINT_WEIGHT), LLOYD_ROUNDS)
    n = F.col(M.POINT_WEIGHT)
    return fit.assign(points).groupBy("cluster").agg(
        F.sum(n).cast("long").alias("legs"),
        *[(F.sum(n * F.col(f)) / F.sum(n)).alias(f"mean_{f}") for f in PROPAGATION_FEATURES])


def _fitted_regimes(spark, sf_dir):
    """Flights and mean causes over all regimes of the fitted clusters: R1 and R4 put together
    again must give the totals of the data."""
    delayed, fit, _ = _fit_recovery(spark, sf_dir)
    clustered = fit.assign(delayed)
    per_year = R.recovery_regimes(clustered).groupBy("YEAR").agg(F.sum("count").alias("flights"))
    mix = R.cause_mix(clustered)
    shares = [c for c in mix.columns if c.endswith("_pct")]
    whole = mix.agg(F.min(F.abs(sum(F.col(c) for c in shares) - 100) < 1e-6).alias("whole"))
    return per_year.withColumn("whole", whole.scalar())


def _kmeans_propagation(spark, sf_dir):
    rows = extra(spark, sf_dir)
    fit, settled = _fit(rows, PROPAGATION_FEATURES, PROPAGATION_K)
    return _nearest(fit.assign(rows), fit).select(
        *KEYS, *PROPAGATION_FEATURES, "nearest", F.lit(settled).alias("settled"))


def _stored_models(spark, sf_dir):
    """Clusters and anomaly scores of models that were written and read back: each row's
    score must be that of the model in memory."""
    delayed, fit, _ = _fit_recovery(spark, sf_dir)
    centres, trees = scratch_path(spark, "kmeans-model"), scratch_path(spark, "forest-model")
    SM.save_kmeans(spark, fit, centres)
    forest = M.isolation_forest(delayed, RECOVERY_FEATURES, KEYS, num_trees=20, seed=SEED)
    limit = M.score_threshold(delayed, forest, CONTAMINATION).head()[0]
    SM.save_forest(spark, forest, trees, limit)
    both = SM.score_forest(SM.score_kmeans(fit.assign(delayed, "own_cluster").withColumn(
        "own_score", forest.score_column()), centres), trees)
    return both.select(*KEYS, "YEAR", (F.col("cluster") == F.col("own_cluster")).alias("same_cluster"),
                       (F.col("anomaly_score") == F.col("own_score")).alias("same_score"))


def _scored(spark, sf_dir):
    """Isolation forest on the propagation features: fit on 30 % of the orders, score the rest."""
    df = clean(spark, sf_dir).withColumn("DELAY_RECOVERY", F.col("DEP_DELAY") - F.col("ARR_DELAY"))
    split = train_split(df, 0.3, bucket=F.col("l_orderkey") % 100)
    train = split.where(F.col("split") == "train")
    score = split.where(F.col("split") == "score")
    return M.anomaly_scores(train, score, PROFILE_FEATURES, KEYS, contamination=CONTAMINATION,
                            num_trees=50, max_samples=256, seed=SEED)


def _anomaly_scores(spark, sf_dir):
    score = F.col("anomaly_score")
    return _scored(spark, sf_dir).select(
        *KEYS, ((score > 0) & (score <= 1)).alias("score_valid"),
        F.col("final_prediction").isin(0, 1).alias("flag_valid"))


def _anomaly_profile(spark, sf_dir):
    """Profile of normal and flagged legs put together: rows, the flagged share near the asked
    one, and the means of all scored rows from the means of the two groups."""
    groups = profile(_scored(spark, sf_dir), "final_prediction", PROFILE_FEATURES, count="count")
    n = F.col("count")
    share = F.sum(F.when(F.col("final_prediction") == 1, n).otherwise(0)) / F.sum(n)
    return groups.agg(
        F.sum(n).alias("scored_rows"),
        share.between(CONTAMINATION - 0.03, CONTAMINATION + 0.03).alias("share_near"),
        *[(F.sum(F.col(f"{f}_mean") * n) / F.sum(n)).alias(f"{f}_mean")
          for f in PROFILE_FEATURES])


DELAYED_KEYS = """
k AS (
  SELECT {keys}, YEAR FROM legs
  WHERE CANCELLED = 0 AND DIVERTED = 0 AND DEP_DELAY > 10 AND ARR_DELAY >= -15
    AND DEP_DELAY <= 360 AND ARR_DELAY <= 360
)""".format(keys=", ".join(KEYS))


def _lloyd_sql() -> str:
    """Lloyd's rounds spelled out: a pair of steps each, from the same quantiles."""
    fs, k = PROPAGATION_FEATURES, PROPAGATION_K
    starts = " UNION ALL ".join(
        f"SELECT {i} AS id, " + ", ".join(
            f"CAST(quantile_disc({f}, {(2 * i + 1) / (2 * k)!r}::DOUBLE) AS DOUBLE) AS {f}" for f in fs)
        + " FROM extra" for i in range(k))
    away = " + ".join(f"(p.{f} - c.{f}) * (p.{f} - c.{f})" for f in fs)
    steps = [f"points AS MATERIALIZED (SELECT {', '.join(fs)}, count(*) AS w FROM extra GROUP BY ALL)",
             f"c0 AS MATERIALIZED ({starts})"]
    for i in range(LLOYD_ROUNDS + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT {', '.join(f'p.{f}' for f in fs)}, any_value(w) AS w, "
                     f"min({{'d': {away}, 'id': c.id}}).id AS id FROM points p, c{i} c GROUP BY "
                     + ", ".join(f"p.{f}" for f in fs) + ")")
        means = ", ".join(f"coalesce(sum(a.w * a.{f}) / sum(a.w), any_value(c.{f})) AS {f}" for f in fs)
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.id, {means} FROM c{i} c "
                     f"LEFT JOIN a{i} a ON a.id = c.id GROUP BY c.id)")
    last = f"a{LLOYD_ROUNDS}"
    return sql(CLEAN, EXTRA, *steps, final=f"""
SELECT CAST(id AS INTEGER) AS cluster, CAST(sum(w) AS BIGINT) AS legs,
       {', '.join(f'sum(w * {f}) / sum(w) AS mean_{f}' for f in fs)}
FROM {last} GROUP BY id""", round_cols=[f"mean_{f}" for f in fs])


QUERIES = {
    "standardize": lambda s, d: rounded(M.standardize(_delayed(s, d), RECOVERY_FEATURES)),
    "standardize_scale_only": lambda s, d: rounded(M.standardize(
        _delayed(s, d), RECOVERY_FEATURES, with_mean=False)),
    "assign_centroids": lambda s, d: rounded(M.assign_centroids(
        _clustered(s, d), M.centroid_table(_clustered(s, d), RECOVERY_FEATURES),
        RECOVERY_FEATURES).select("YEAR", "ORIGIN", "OP_UNIQUE_CARRIER", *RECOVERY_FEATURES,
                                  "cluster", "assigned", "assigned_dist2")),
    "kmeans_recovery": _kmeans_recovery,
    "kmeans_propagation": _kmeans_propagation,
    "kmeans_lloyd": lambda s, d: rounded(_kmeans_lloyd(s, d)),
    "fitted_regimes": _fitted_regimes,
    "stored_models": _stored_models,
    "anomaly_scores": _anomaly_scores,
    "anomaly_profile": lambda s, d: rounded(_anomaly_profile(s, d)),
}

ORACLE = {
    "standardize": sql(DELAYED, final="SELECT *, {} FROM delayed".format(", ".join(
        f"CASE WHEN stddev_samp({f}) OVER () = 0 THEN 0.0 "
        f"ELSE ({f} - avg({f}) OVER ()) / stddev_samp({f}) OVER () END AS {f}_z"
        for f in RECOVERY_FEATURES)),
        round_cols=DELAYED_DOUBLES + [f"{f}_z" for f in RECOVERY_FEATURES]),
    "assign_centroids": sql(DELAYED, CLUSTERED, """
cent AS (SELECT cluster AS id, avg(DEP_DELAY) AS f0, avg(ARR_DELAY) AS f1, avg(DELAY_CHANGE) AS f2
         FROM clustered GROUP BY cluster),
rows_ AS (SELECT row_number() OVER () AS rid, * FROM clustered),
best AS (
  SELECT r.rid, min({'d': (r.DEP_DELAY - c.f0) * (r.DEP_DELAY - c.f0)
                          + (r.ARR_DELAY - c.f1) * (r.ARR_DELAY - c.f1)
                          + (r.DELAY_CHANGE - c.f2) * (r.DELAY_CHANGE - c.f2), 'id': c.id}) AS b
  FROM rows_ r CROSS JOIN cent c GROUP BY r.rid
)""", final="""
SELECT r.YEAR, r.ORIGIN, r.OP_UNIQUE_CARRIER, r.DEP_DELAY, r.ARR_DELAY, r.DELAY_CHANGE, r.cluster,
       b.b.id AS assigned, b.b.d AS assigned_dist2
FROM rows_ r JOIN best b USING (rid)""",
        round_cols=("DEP_DELAY", "ARR_DELAY", "DELAY_CHANGE", "assigned_dist2")),
    "standardize_scale_only": sql(DELAYED, final="SELECT *, {} FROM delayed".format(", ".join(
        f"CASE WHEN stddev_samp({f}) OVER () = 0 THEN 0.0 "
        f"ELSE {f} / stddev_samp({f}) OVER () END AS {f}_z" for f in RECOVERY_FEATURES)),
        round_cols=DELAYED_DOUBLES + [f"{f}_z" for f in RECOVERY_FEATURES]),
    "kmeans_recovery": sql(final="""
SELECT {keys}, YEAR, DEP_DELAY, ARR_DELAY, ARR_DELAY - DEP_DELAY AS DELAY_CHANGE,
       true AS nearest, true AS settled, true AS labelled
FROM legs
WHERE CANCELLED = 0 AND DIVERTED = 0 AND DEP_DELAY > 10 AND ARR_DELAY >= -15
  AND DEP_DELAY <= 360 AND ARR_DELAY <= 360""".format(keys=", ".join(KEYS))),
    "fitted_regimes": sql(DELAYED, final="""
SELECT YEAR, count(*) AS flights, true AS whole FROM delayed GROUP BY YEAR"""),
    "kmeans_propagation": sql(CLEAN, EXTRA, final="""
SELECT {keys}, {features}, true AS nearest, true AS settled FROM extra""".format(
        keys=", ".join(KEYS), features=", ".join(PROPAGATION_FEATURES))),
    "stored_models": sql(DELAYED_KEYS, final="SELECT *, true AS same_cluster, true AS same_score FROM k"),
    "kmeans_lloyd": _lloyd_sql(),
    "anomaly_scores": sql(CLEAN, final="""
SELECT {keys}, true AS score_valid, true AS flag_valid FROM clean
WHERE l_orderkey % 100 >= 30""".format(keys=", ".join(KEYS))),
    "anomaly_profile": sql(CLEAN, final="""
SELECT count(*) AS scored_rows, true AS share_near, {means} FROM
  (SELECT *, DEP_DELAY - ARR_DELAY AS DELAY_RECOVERY FROM clean) c
WHERE l_orderkey % 100 >= 30""".format(
        means=", ".join(f"avg({f}) AS {f}_mean" for f in PROFILE_FEATURES)),
        round_cols=[f"{f}_mean" for f in PROFILE_FEATURES]),
}
