"""Machine-learning operators: standardisation, k-means with stable labels,
centroid assignment, and an isolation forest for anomaly scores.

* ``standardize`` and ``assign_centroids`` stay JVM-side: the fitted statistics
  enter the plan as one scalar subquery, the centroids (bounded by
  ``k × features``) as literals — never as a join against the rows.
* ``fit_kmeans`` fits Spark ML's distributed k-means on the distinct feature points,
  weighted by their rows (``weighted_points``: delays are whole minutes, so there are far fewer
  points than rows), and numbers the clusters by ascending centre on the first feature; the rows
  themselves are assigned by an expression, without a shuffle.
* ``lloyd`` iterates from given centres on the same points, a job and k rows a round.
* ``isolation_forest`` (Liu, Ting & Zhou, 2008) is a Spark job: every tree draws its
  own ``max_samples`` rows from all rows by hash (all randomness from hashes of the
  row key, so it does not depend on data layout), one tree grown per group in
  ``applyInPandas``, and scoring in a vectorised ``pandas_udf``.  Only the
  forest itself (``num_trees × (2·max_samples − 1)`` nodes at most) reaches the
  driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legworks.operators.stats import exact_percentile, running_totals
from legworks.session import materialize, written


# ----------------------------------------------------------- standardisation

def standardize(df: DataFrame, features: Sequence[str], with_mean: bool = True,
                with_std: bool = True, suffix: str = "_z") -> DataFrame:
    """Add ``<f><suffix>`` = ``(f − mean) / stddev_samp`` (each part optional).

    The statistics are one aggregate, referenced through a single scalar
    subquery (Spark evaluates it once and reuses it); a zero std gives 0.0, as
    Spark ML's StandardScaler does.
    """
    aggs = []
    for f in features:
        aggs += [F.avg(f).alias(f"m_{f}"), F.stddev_samp(f).alias(f"s_{f}")]
    names = [x for f in features for x in (f"m_{f}", f"s_{f}")]
    # bind the subquery to one column: every later reference reads that column,
    # so the statistics are computed once (CollapseProject keeps it un-inlined)
    stats = df.agg(*aggs).select(F.struct(*names).alias("st")).scalar()
    bound = df.withColumn("_stats", stats)
    out = []
    for f in features:
        x = F.col(f)
        if with_mean:
            x = x - F.col(f"_stats.m_{f}")
        if with_std:
            s = F.col(f"_stats.s_{f}")
            x = F.when(s == 0, F.lit(0.0)).otherwise(x / s)
        out.append(x.alias(f"{f}{suffix}"))
    return bound.select(*[F.col(f"`{c}`") for c in df.columns], *out)


# ------------------------------------------------------------------ k-means

def centroid_table(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mean feature vector per cluster — centres for ``assign_centroids``."""
    return df.groupBy(cluster).agg(*[F.avg(f).alias(f) for f in features])


def assign_centroids(df: DataFrame, centroids: DataFrame | Sequence[tuple[int, Sequence[float]]],
                     features: Sequence[str], cluster: str = "cluster", out: str = "assigned",
                     max_centroids: int = 1000) -> DataFrame:
    """Nearest centre (squared Euclidean) for every row; ties to the lower id.

    ``centroids`` is a small frame ``(cluster, *features)`` or a list of
    ``(id, coordinates)``.  The centres are model parameters (k rows, checked
    against ``max_centroids``) and enter the row expression as literals: one
    ``least`` over ``(dist², id)`` structs — no join, no Python per row.
    """
    if isinstance(centroids, DataFrame):
        rows = centroids.select(cluster, *features).limit(max_centroids + 1).collect()
        if len(rows) > max_centroids:
            raise ValueError(f"more than {max_centroids} centroids")
        centres = [(r[0], [float(v) for v in r[1:]]) for r in rows]
    else:
        centres = [(cid, [float(v) for v in coords]) for cid, coords in centroids]
    if not centres:
        raise ValueError("no centroids")
    candidates = []
    for cid, coords in sorted(centres, key=lambda c: c[0]):
        total = None
        for f, c in zip(features, coords):
            d = F.col(f) - F.lit(c)
            total = d * d if total is None else total + d * d
        candidates.append(F.struct(total.alias("d"), F.lit(cid).alias("id")))
    best = candidates[0] if len(candidates) == 1 else F.least(*candidates)
    return df.withColumn(out, best.getField("id")).withColumn(f"{out}_dist2", best.getField("d"))


@dataclass(frozen=True)
class KMeansFit:
    """Fitted centres, ids by ascending first coordinate, in the units the fit used:
    (x - mean) / std per feature (mean 0 and std 1 without scaling; a std of 0 maps to 0)."""

    features: tuple[str, ...]
    centres: tuple[tuple[float, ...], ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]

    def scaled(self) -> list[Column]:
        return [F.lit(0.0) if s == 0 else (F.col(f) - F.lit(m)) / F.lit(s)
                for f, m, s in zip(self.features, self.mean, self.std, strict=True)]

    def assign(self, df: DataFrame, out: str = "cluster") -> DataFrame:
        """``df`` with the nearest centre's id (ties to the lower); NULL for a NULL feature."""
        names = [f"_scaled_{i}" for i in range(len(self.features))]
        rows = df.select("*", *[c.alias(n) for c, n in zip(self.scaled(), names, strict=True)])
        rows = assign_centroids(rows, list(enumerate(self.centres)), names, out=out)
        missing = reduce(Column.__or__, [F.col(f).isNull() for f in self.features])
        return rows.withColumn(out, F.when(~missing, F.col(out))).drop(*names, f"{out}_dist2")


POINT_WEIGHT = "_weight"
POINTS_PER_TASK = 200_000


def weighted_points(df: DataFrame, features: Sequence[str], laid_out: bool = True) -> DataFrame:
    """The distinct points of the feature columns with their rows as ``_weight``: a written table in a
    layout that only the points decide.

    Rows are counted before the shuffle, so it is bounded by distinct points.  Points are
    dealt by their hash into as many partitions as their number asks for, in the order of their
    values: what is fitted on them is the same on any cluster and for any file layout.
    ``laid_out=False`` leaves that second shuffle out, for what only sums over the points.  A NULL
    feature raises: leave such rows out before.
    """
    missing = reduce(Column.__or__, [F.col(f).isNull() for f in features])
    known = F.when(missing, F.raise_error(F.lit("k-means: a feature is NULL"))).otherwise(True)
    # every zero is the same point
    counted = written(df.where(known).select(*[(F.col(f).cast("double") + F.lit(0.0)).alias(f)
                                               for f in features])
                      .groupBy(*features).agg(F.count(F.lit(1)).cast("double")
                                              .alias(POINT_WEIGHT)), "points")
    if not laid_out:
        return counted
    tasks = max(1, math.ceil(counted.count() / POINTS_PER_TASK))
    return materialize(counted.repartition(tasks, *features).sortWithinPartitions(*features))


def _moments(points: DataFrame, features: Sequence[str]) -> tuple[list[float], list[float]]:
    """Weighted mean and sample standard deviation of each feature (two passes)."""
    w = F.col(POINT_WEIGHT)
    first = points.agg(F.sum(w), *[F.sum(w * F.col(f)) for f in features]).head()
    n, mean = first[0], [v / first[0] for v in first[1:]]
    second = points.agg(*[F.sum(w * (F.col(f) - F.lit(m)) ** 2)
                          for f, m in zip(features, mean, strict=True)]).head()
    return mean, [math.sqrt(v / (n - 1)) if n > 1 else 0.0 for v in second]


def fit_kmeans(df: DataFrame, features: Sequence[str], k: int, seed: int = 42,
               scale: bool = False, max_iter: int = 20, points: DataFrame | None = None
               ) -> KMeansFit:
    """Fit Spark ML k-means on ``features``, z-scored first if ``scale``.

    The fit runs on ``weighted_points`` (given as ``points``, or made here): the centres
    minimise the same sum over rows, every row counted, and are the same on any layout.
    A NULL feature raises.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    points = weighted_points(df, features) if points is None else points
    n = len(features)
    if points.isEmpty():
        raise ValueError("k-means: no rows")
    mean, std = _moments(points, features) if scale else ([0.0] * n, [1.0] * n)
    empty = KMeansFit(tuple(features), (), tuple(mean), tuple(std))
    names = [f"_scaled_{i}" for i in range(n)]
    rows = points.select(POINT_WEIGHT, *[c.alias(x) for c, x in zip(empty.scaled(), names,
                                                                    strict=True)])
    rows = VectorAssembler(inputCols=names, outputCol="_x", handleInvalid="error").transform(rows)
    model = KMeans(k=k, seed=seed, featuresCol="_x", weightCol=POINT_WEIGHT,
                   maxIter=max_iter).fit(rows.select("_x", POINT_WEIGHT))
    centres = sorted(tuple(float(v) for v in c) for c in model.clusterCenters())
    return replace(empty, centres=tuple(centres))


def lloyd(points: DataFrame, start: KMeansFit, rounds: int = 20) -> KMeansFit:
    """``start`` improved by Lloyd's rounds on weighted points, until no centre moves or for
    ``rounds`` rounds.  A round is one aggregate whose result is a row per centre; a centre without
    points stays.  Centres keep their order."""
    fit = start
    for _ in range(rounds):
        sums = (fit.assign(points).groupBy("cluster").agg(
            F.sum(POINT_WEIGHT).alias("n"),
            *[F.sum(F.col(POINT_WEIGHT) * c).alias(f"s{i}") for i, c in enumerate(fit.scaled())])
            .collect())
        centres = list(fit.centres)
        for r in sums:
            centres[r["cluster"]] = tuple(r[f"s{i}"] / r["n"] for i in range(len(fit.features)))
        if centres == list(fit.centres):
            break
        fit = replace(fit, centres=tuple(centres))
    return fit


def inertia(points: DataFrame, fit: KMeansFit) -> float:
    """Sum over rows of the squared distance to the nearest centre, in the units of the fit."""
    away = [reduce(Column.__add__, [(x - F.lit(v)) ** 2 for x, v in zip(fit.scaled(), c, strict=True)])
            for c in fit.centres]
    nearest = away[0] if len(away) == 1 else F.least(*away)
    return points.agg(F.sum(F.col(POINT_WEIGHT) * nearest)).head()[0] or 0.0


def quantile_start(df: DataFrame, features: Sequence[str], k: int,
                   weight: str | None = None) -> KMeansFit:
    """Centres that the data fix without a draw: the i-th has every feature's
    (2i + 1) / 2k quantile (a value of the feature), of rows that count ``weight`` times if it is
    named (whole numbers; rows without weight are left out)."""
    at = [(2 * i + 1) / (2 * k) for i in range(k)]
    if weight is None:
        row = df.agg(*[exact_percentile(f, p).alias(f"{f}_{i}")
                       for f in features for i, p in enumerate(at)]).head()
    else:
        row = _weighted_quantiles(df, features, at, weight)
    centres = tuple(tuple(float(row[f"{f}_{i}"]) for f in features) for i in range(k))
    return KMeansFit(tuple(features), centres, (0.0,) * len(features), (1.0,) * len(features))


def _weighted_quantiles(df: DataFrame, features: Sequence[str], at: Sequence[float], weight: str
                        ) -> dict[str, float]:
    """``<feature>_<i>``: the ceil(at_i * n)-th smallest value of each feature, of n rows that
    ``weight`` counts.  Values are added up to a row each before a running total over ranges."""
    named = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"))
                                for f in features]))
    rows = (df.select(weight, named.alias("v")).select(weight, "v.*")
            .where(F.col(weight) > 0))
    totals = running_totals(rows, ["feature"], "value", {"n": F.col(weight).cast("long")})
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("p"))
                                 for i, p in enumerate(at)]))
    upto = F.col("n_below") + F.col("n")
    rank = F.greatest(F.ceil(F.col("q.p") * F.col("n_total")), F.lit(1))
    found = (totals.withColumn("q", wanted).where((F.col("n_below") < rank) & (rank <= upto))
             .select("feature", "q.i", "value").collect())  # a row per feature and quantile
    return {f"{r['feature']}_{r['i']}": r["value"] for r in found}


def kmeans_clusters(df: DataFrame, features: Sequence[str], k: int, seed: int = 42,
                    scale: bool = False, max_iter: int = 20, out: str = "cluster") -> DataFrame:
    """Fit k-means (``fit_kmeans``) and add the cluster of every row as ``out``."""
    return fit_kmeans(df, features, k, seed, scale, max_iter).assign(df, out)


# --------------------------------------------------------- isolation forest

_NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("split", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.LongType()),
])
_EULER = 0.5772156649015329


def average_path_length(n: np.ndarray | float) -> np.ndarray:
    """``c(n)``: mean path length of an unsuccessful BST search over ``n`` points."""
    n = np.asarray(n, dtype="float64")
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + _EULER) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _grow_tree(pdf: pd.DataFrame, features: Sequence[str], max_depth: int, seed: int) -> pd.DataFrame:
    """Grow one isolation tree on a pandas sample (runs inside applyInPandas)."""
    tree = int(pdf["tree"].iloc[0])
    x = pdf[list(features)].to_numpy(dtype="float64")
    rng = np.random.default_rng([seed, tree])
    rows: list[tuple] = []

    def build(idx: np.ndarray, depth: int) -> int:
        node = len(rows)
        rows.append(None)
        sub = x[idx]
        if depth >= max_depth or len(idx) <= 1:
            rows[node] = (tree, node, -1, 0.0, -1, -1, len(idx))
            return node
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            rows[node] = (tree, node, -1, 0.0, -1, -1, len(idx))
            return node
        f = int(rng.choice(usable))
        split = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < split
        left = build(idx[go_left], depth + 1)
        right = build(idx[~go_left], depth + 1)
        rows[node] = (tree, node, f, split, left, right, len(idx))
        return node

    build(np.arange(len(x)), 0)
    return pd.DataFrame(rows, columns=[f.name for f in _NODE_SCHEMA.fields])


class IsolationForestModel:
    """Fitted forest: node arrays per tree plus the sample size used."""

    def __init__(self, nodes: pd.DataFrame, features: Sequence[str], sample_size: int):
        self.features = list(features)
        self.sample_size = int(sample_size)
        self.trees = []
        for _, t in nodes.sort_values(["tree", "node"]).groupby("tree"):
            self.trees.append((t["feature"].to_numpy(), t["split"].to_numpy(),
                               t["left"].to_numpy(), t["right"].to_numpy(),
                               t["size"].to_numpy()))

    @classmethod
    def of_trees(cls, trees: Sequence[tuple], features: Sequence[str], sample_size: int
                 ) -> IsolationForestModel:
        """A forest from its node arrays (feature, split, left, right, size), one tuple a tree."""
        model = cls.__new__(cls)
        model.features, model.sample_size = list(features), int(sample_size)
        kinds = (np.int64, np.float64, np.int64, np.int64, np.int64)
        model.trees = [tuple(np.array(a, k) for a, k in zip(t, kinds, strict=True)) for t in trees]
        return model

    def path_lengths(self, x: np.ndarray) -> np.ndarray:
        """Mean isolation depth of each row over the forest (with leaf correction)."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, split, left, right, size in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            depth = np.zeros(len(x))
            active = feature[node] >= 0
            while active.any():
                n = node[active]
                go_left = x[rows[active], feature[n]] < split[n]
                node[active] = np.where(go_left, left[n], right[n])
                depth[active] += 1
                active = feature[node] >= 0
            total += depth + average_path_length(size[node])
        return total / max(len(self.trees), 1)

    def score_column(self) -> Column:
        """``pandas_udf`` column giving ``2^(−E[h]/c(ψ))`` in (0, 1]; higher = more anomalous."""
        model = self
        norm = float(average_path_length(np.array([model.sample_size]))[0]) or 1.0

        @F.pandas_udf(T.DoubleType())
        def _score(*cols: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype="float64") for c in cols])
            return pd.Series(np.power(2.0, -model.path_lengths(x) / norm))

        return _score(*[F.col(f) for f in model.features])


def isolation_forest(train: DataFrame, features: Sequence[str], key_cols: Sequence[str],
                     num_trees: int = 50, max_samples: int = 256, seed: int = 42
                     ) -> IsolationForestModel:
    """Fit an isolation forest on ``train``.

    Every tree draws its rows from all of ``train``: those with the ``max_samples``
    smallest hashes of tree and key.  A row leaves its task only for the trees whose
    hash is below a threshold that lets about twice as many pass (never fewer than needed but with
    odds below 1e-30; a tree that falls short grows on what it has), so what is
    shuffled and ranked is bounded by trees and samples, not by rows.
    """
    n = train.count()
    if n == 0:
        raise ValueError("isolation_forest: empty training data")
    keys = [F.col(k) for k in key_cols]
    share = min(1.0, (2.0 * max_samples + 64) / n)
    limit = int((share - 0.5) * 2 ** 64) if share < 1.0 else 2 ** 63 - 1
    drawn = F.filter(F.sequence(F.lit(0), F.lit(num_trees - 1)),
                     lambda t: F.xxhash64(F.lit(seed), t, *keys) <= F.lit(limit))
    trees = train.select(*key_cols, *features, F.explode(drawn).alias("tree"))
    rank = Window.partitionBy("tree").orderBy(
        F.xxhash64(F.lit(seed), F.col("tree"), *keys), *keys)
    sample = (trees.withColumn("_r", F.row_number().over(rank))
              .where(F.col("_r") <= max_samples).select("tree", *features))
    psi = min(max_samples, n)
    depth = max(1, math.ceil(math.log2(max(psi, 2))))
    feats = list(features)
    nodes = (sample.groupBy("tree")
             .applyInPandas(lambda pdf: _grow_tree(pdf, feats, depth, seed), _NODE_SCHEMA)
             .toPandas())
    return IsolationForestModel(nodes, features, psi)


def score_threshold(train: DataFrame, model: IsolationForestModel, contamination: float = 0.05
                    ) -> DataFrame:
    """One value: the ``1 − contamination`` quantile of the training scores."""
    return train.select(model.score_column().alias("s")).select(
        F.percentile_approx("s", 1.0 - contamination, 100000).alias("threshold"))


def anomaly_scores(train: DataFrame, score: DataFrame, features: Sequence[str],
                   key_cols: Sequence[str], contamination: float = 0.05, num_trees: int = 50,
                   max_samples: int = 256, seed: int = 42) -> DataFrame:
    """Fit on ``train``, score ``score``: adds ``anomaly_score`` and
    ``final_prediction`` (1 when the score reaches the ``1 − contamination``
    quantile of the training scores)."""
    model = isolation_forest(train, features, key_cols, num_trees, max_samples, seed)
    threshold = score_threshold(train, model, contamination).scalar()
    scored = score.withColumn("anomaly_score", model.score_column())
    return scored.withColumn("final_prediction",
                             (F.col("anomaly_score") >= threshold).cast("int"))
