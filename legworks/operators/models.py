"""Fitted models as tables: k-means centres with their scaling, and isolation forests.

A model is a small Parquet folder whose rows hold its numbers together with a format version, its
kind and its features.  It is read back in any session and scores as it did when it was fitted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from legworks.operators.ml import IsolationForestModel, KMeansFit

VERSION = 1
KMEANS, FOREST = "kmeans", "isolation_forest"

_HEAD = [T.StructField("version", T.IntegerType(), False),
         T.StructField("kind", T.StringType(), False),
         T.StructField("features", T.ArrayType(T.StringType(), False), False)]
# a row per centre
KMEANS_SCHEMA = T.StructType([*_HEAD, T.StructField("cluster", T.IntegerType(), False), *[
    T.StructField(n, T.ArrayType(T.DoubleType(), False), False) for n in ("centre", "mean", "std")]])
# a row per tree
FOREST_SCHEMA = T.StructType([
    *_HEAD, T.StructField("sample_size", T.IntegerType(), False),
    T.StructField("threshold", T.DoubleType()), T.StructField("tree", T.IntegerType(), False),
    *[T.StructField(n, T.ArrayType(t, False), False) for n, t in (
        ("feature", T.IntegerType()), ("split", T.DoubleType()), ("left", T.IntegerType()),
        ("right", T.IntegerType()), ("size", T.LongType()))]])


def _write(spark: SparkSession, rows: list[tuple], schema: T.StructType, path: str) -> str:
    # a model has k centres or some hundred trees
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def _read(spark: SparkSession, path: str, schema: T.StructType, kind: str, order: str) -> list:
    rows = spark.read.parquet(path)
    missing = [f.name for f in schema.fields if f.name not in rows.columns]
    if "kind" in missing or "version" in missing:
        raise ValueError(f"{path} holds no model")
    head = rows.select("kind", "version").head()
    if head is None or head["kind"] != kind:
        raise ValueError(f"{path} holds a model of kind {head and head['kind']!r}, not {kind!r}")
    if head["version"] != VERSION or missing:
        raise ValueError(f"{path} has version {head['version']}; this library reads {VERSION}")
    return rows.select(*schema.fieldNames()).orderBy(order).collect()


def save_kmeans(spark: SparkSession, fit: KMeansFit, path: str) -> str:
    """Write a fit, replacing what was at ``path``; returns ``path``."""
    return _write(spark, [(VERSION, KMEANS, list(fit.features), i, list(c), list(fit.mean),
                           list(fit.std)) for i, c in enumerate(fit.centres)], KMEANS_SCHEMA, path)


def load_kmeans(spark: SparkSession, path: str) -> KMeansFit:
    rows = _read(spark, path, KMEANS_SCHEMA, KMEANS, "cluster")
    first = rows[0]
    return KMeansFit(tuple(first["features"]), tuple(tuple(r["centre"]) for r in rows),
                     tuple(first["mean"]), tuple(first["std"]))


def save_forest(spark: SparkSession, model: IsolationForestModel, path: str,
                threshold: float | None = None) -> str:
    """Write a forest and, if given, the score from which a row is flagged; returns ``path``."""
    rows = [(VERSION, FOREST, list(model.features), model.sample_size, threshold, i,
             *[[kind(v) for v in column] for kind, column in zip(
                 (int, float, int, int, int), tree, strict=True)])
            for i, tree in enumerate(model.trees)]
    return _write(spark, rows, FOREST_SCHEMA, path)


def load_forest(spark: SparkSession, path: str) -> tuple[IsolationForestModel, float | None]:
    rows = _read(spark, path, FOREST_SCHEMA, FOREST, "tree")
    model = IsolationForestModel.of_trees(
        [(r["feature"], r["split"], r["left"], r["right"], r["size"]) for r in rows],
        rows[0]["features"], rows[0]["sample_size"])
    return model, rows[0]["threshold"]


def score_kmeans(df: DataFrame, path: str, out: str = "cluster") -> DataFrame:
    """``df`` with the clusters of a written fit; no fit takes place."""
    return load_kmeans(df.sparkSession, path).assign(df, out)


def score_forest(df: DataFrame, path: str) -> DataFrame:
    """``df`` with the ``anomaly_score`` of a written forest and, if a threshold was written with it,
    ``final_prediction``."""
    model, threshold = load_forest(df.sparkSession, path)
    scored = df.withColumn("anomaly_score", model.score_column())
    if threshold is None:
        return scored
    return scored.withColumn("final_prediction", (scored["anomaly_score"] >= threshold).cast("int"))
