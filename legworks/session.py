"""Session helpers: a local session for tests/bench, lineage cutting, scratch paths.

Operators never change session configuration.  The only state this module
touches is the checkpoint directory, and only when the session has none (local
tests); on a cluster ``spark.checkpoint.dir`` must name a shared folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "legworks", extra: dict | None = None) -> SparkSession:
    """Local session with AQE on and the UI off (used by tests and bench.py)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Generated stage methods above 8000 bytecodes are never JIT-compiled by
        # HotSpot; falling back to per-operator codegen is ~5x faster for the
        # wide leg projections than running such a method interpreted.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", "16g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from ``spark.checkpoint.dir`` (or an already-set SparkContext dir).
    Only a local-mode session without one gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder (HDFS/S3/…) for this cluster")
        configured = tempfile.mkdtemp(prefix="legworks-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Iterative operators call this once per round so the plan does not grow
    with the number of rounds and lost executors recompute at most one round.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for written tables, in the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/legworks-tables/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of ``scratch_root``."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table under ``scratch_root``: cuts lineage as ``materialize`` does, in
    columns and compressed, but read back in whatever splits the session chooses."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables this application has written under ``scratch_root``.  Frames that
    read them can't be used any more; call it when the results have been saved."""
    fs, path = _file_system(spark, scratch_root(spark))
    fs.delete(path, True)


def _file_system(spark: SparkSession, location: str):
    """The Hadoop file system and path of a location, whatever its store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def exists(spark: SparkSession, location: str) -> bool:
    fs, path = _file_system(spark, location)
    return fs.exists(path)


def file_stamp(spark: SparkSession, location: str) -> tuple[tuple[str, int, int], ...]:
    """Name, size and time of change of a file, or of each file in a folder."""
    fs, path = _file_system(spark, location)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime())
                        for f in fs.listStatus(path)))


def files_under(spark: SparkSession, location: str) -> list[str]:
    """Data files of a file, folder or glob pattern, in order of their paths, in whatever store."""
    fs, path = _file_system(spark, location)
    found = fs.globStatus(path)
    if not found:
        raise FileNotFoundError(location)
    out = []
    for status in found:
        inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        out += [f.getPath().toString() for f in inside
                if not f.isDirectory() and not f.getPath().getName().startswith(("_", "."))]
    return sorted(out)


def first_line(spark: SparkSession, file: str) -> str:
    """The first line of a text file, which may be compressed; empty for an empty file."""
    fs, path = _file_system(spark, file)
    jvm = spark._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark._jsparkSession.sessionState().newHadoopConf()).getCodec(path)
    stream = fs.open(path)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
            codec.createInputStream(stream) if codec is not None else stream, "UTF-8"))
        return (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        stream.close()
