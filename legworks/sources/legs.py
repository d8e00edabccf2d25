"""Leg ingest and sinks: explicit-schema CSV scans, partitioned Parquet landing,
month coverage and report writers."""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from legworks.schema import LEG_COLUMNS, LEG_SCHEMA
from legworks.session import exists, files_under, first_line

# Folder by which Spark's file sink marks a table that a stream writes.
STREAM_LOG = "_spark_metadata"


REJECTED = "_rejected"


def read_legs(spark: SparkSession, path: str | Sequence[str], schema=LEG_SCHEMA,
              bad_rows: str = "raise", headers: str = "same") -> DataFrame:
    """Scan on-time CSV files (a directory, glob or list) with an explicit schema.

    Every file's header must name the schema's columns in their order; another header
    raises (``headers="by_name"`` reads files of differing headers, see ``header_groups``).  So does a line with another number of fields, and a field that doesn't fit its
    column's type once a query uses it.  With ``bad_rows="keep"`` such lines stay, with
    unfit fields NULL and the line's text in the column ``_rejected`` (NULL for good
    lines; see ``rejected_rows``), whichever columns a query uses.

    No ``inferSchema`` pass: inference reads the data twice and can type the
    same column differently for different file sets.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if headers not in ("same", "by_name"):
        raise ValueError(f"headers must be 'same' or 'by_name', not {headers!r}")
    if headers == "same":
        return typed_legs(csv_reader(spark.read, schema, bad_rows).csv(paths), schema, bad_rows)
    out = None
    for names, files in header_groups(spark, paths).items():
        rows = _by_name(spark, names, files, schema, bad_rows)
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise FileNotFoundError(f"no file with a header in {paths}")
    return out


def header_groups(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """CSV files by their header: column names in upper case, in the files' order.

    Only the first line of each file is read, by the driver, for a list of files that it
    holds anyway.  Files without any line are left out.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        for file in files_under(spark, path):
            names = tuple(n.strip().upper() for n in next(csv.reader([first_line(spark, file)]), []))
            while names and not names[-1]:      # a comma at the end of the line
                names = names[:-1]
            if not names:
                continue
            if len(set(names)) < len(names):
                twice = sorted(n for n, k in Counter(names).items() if k > 1)
                raise ValueError(f"{file} names a column twice: {', '.join(twice)}")
            groups.setdefault(names, []).append(file)
    return groups


def _by_name(spark: SparkSession, names: Sequence[str], files: Sequence[str], schema: StructType,
             bad_rows: str) -> DataFrame:
    """Files of one header in the schema's order; what they don't have is NULL, what the
    schema doesn't have is left out."""
    known = {f.name.upper(): f for f in schema.fields}
    own = StructType([StructField(known[n].name if n in known else n,
                                  known[n].dataType if n in known else StringType())
                      for n in names])
    # the header has been read, in whatever case it names its columns
    reader = csv_reader(spark.read, own, bad_rows).option("enforceSchema", True)
    rows = typed_legs(reader.csv(list(files)), own, bad_rows)
    have = set(own.fieldNames())
    columns = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
               for f in schema.fields]
    return rows.select(*columns, *([REJECTED] if bad_rows == "keep" else []))


def header_report(spark: SparkSession, path: str | Sequence[str], schema=LEG_SCHEMA) -> DataFrame:
    """A row per header: files, the schema's columns that are missing (NULL when read by name), the
    further ones that are left out, and whether the common columns come in the schema's order."""
    paths = [path] if isinstance(path, str) else list(path)
    order = {f.name.upper(): i for i, f in enumerate(schema.fields)}
    rows = []
    for names, files in header_groups(spark, paths).items():
        places = [order[n] for n in names if n in order]
        rows.append((len(files), files[0].rsplit("/", 1)[-1],
                     [f.name for f in schema.fields if f.name.upper() not in names],
                     [n for n in names if n not in order], places == sorted(places)))
    return spark.createDataFrame(rows, "files int, first_file string, missing array<string>, "
                                       "further array<string>, in_order boolean")


def missing_values(legs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and NULLs of each column, per year: what files of other headers lacked."""
    return legs.groupBy("YEAR").agg(F.count(F.lit(1)).alias("lines"), *[
        F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in columns])


def csv_reader(reader, schema: StructType, bad_rows: str):
    """Schema and options of a batch or stream reader of on-time CSV files."""
    if bad_rows not in ("raise", "keep"):
        raise ValueError(f"bad_rows must be 'raise' or 'keep', not {bad_rows!r}")
    reader = reader.option("header", True).option("enforceSchema", False).option(
        "columnPruning", False)
    if bad_rows == "raise":
        return reader.option("mode", "FAILFAST").schema(schema)
    fields = [StructField(f.name, StringType()) for f in schema.fields]
    return (reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED)
            .schema(StructType([*fields, StructField(REJECTED, StringType())])))


def typed_legs(raw: DataFrame, schema: StructType, bad_rows: str) -> DataFrame:
    if bad_rows == "raise":
        return raw
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    unfit = reduce(Column.__or__, [F.col(n).isNotNull() & c.isNull() for n, c in typed.items()])
    line = F.to_csv(F.struct(*typed), {"nullValue": "", "emptyValue": ""})
    return raw.select(*[c.alias(n) for n, c in typed.items()],
                      F.coalesce(F.col(REJECTED), F.when(unfit, line)).alias(REJECTED))


def rejected_rows(legs: DataFrame) -> DataFrame:
    """Lines and rejected lines per year, of a scan with ``bad_rows="keep"``."""
    return legs.groupBy("YEAR").agg(F.count(F.lit(1)).alias("lines"),
                                    F.count(REJECTED).alias("rejected"))


def land_bucketed(legs: DataFrame, name: str, path: str, keys: Sequence[str],
                  order: Sequence[str] = (), buckets: int = 200) -> DataFrame:
    """Write ``legs`` as the table ``name`` (files at ``path``), dealt into ``buckets`` by the hash of
    ``keys`` and sorted by ``order`` within each; returns the table.

    Joins, aggregates and windows whose keys include ``keys`` then read it without a shuffle, every
    time.  Choose keys that part a hot value (tail and date, not the tail alone).  Rows are brought
    together by bucket before the write, so a bucket is one file.
    """
    if exists(legs.sparkSession, path):
        raise ValueError(f"{path} exists; bucketed tables are written anew")
    order = list(order) or list(keys)
    (legs.repartition(buckets, *keys).sortWithinPartitions(*order)
     .write.bucketBy(buckets, *keys).sortBy(*order).option("path", path)
     .format("parquet").saveAsTable(name))
    return legs.sparkSession.table(name)


def to_source_layout(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Project a frame onto the 77-column on-time layout (missing columns NULL),
    e.g. to export legs in the source format."""
    renames = renames or {}
    have = {renames.get(c, c): c for c in df.columns}
    cols: list[Column] = []
    for name, dtype in LEG_COLUMNS:
        src = have.get(name)
        cols.append((F.col(src) if src else F.lit(None)).cast(dtype).alias(name))
    return df.select(*cols)


def land_parquet(legs: DataFrame, path: str, partition_by: Sequence[str] = ("YEAR", "MONTH"),
                 mode: str = "replace_partitions", gather: bool = False,
                 files_per_partition: int | None = None,
                 max_records_per_file: int = 5_000_000) -> str:
    """Write legs as Parquet partitioned by year and month (the layout that makes
    year/month slices partition-pruned scans).  Returns ``path``.

    ``mode``: ``replace_partitions`` (the partitions that ``legs`` has are replaced, all
    others stay, so months land one by one and may be landed again), ``append``, or
    ``overwrite`` (the whole table).  A table that a stream lands into is refused.

    By default there is no shuffle: every task writes its rows straight into
    the partition folders (monthly source files already hold one month each,
    so a task writes one file and no month funnels into one writer).  For input
    whose months are scattered over many tasks, ``gather`` brings the rows of
    a partition together; adaptive execution splits a large partition over several
    tasks by its size.  ``files_per_partition=k`` does the same with a fixed number:
    a deterministic hash bucket in ``[0, k)``.  ``max_records_per_file`` bounds file size.
    """
    modes = {"replace_partitions": "overwrite", "append": "append", "overwrite": "overwrite"}
    if mode not in modes:
        raise ValueError(f"mode must be one of {sorted(modes)}, not {mode!r}")
    if exists(legs.sparkSession, f"{path.rstrip('/')}/{STREAM_LOG}"):
        raise ValueError(f"{path} is landed by a stream; batch rows would not be seen there")
    if files_per_partition:
        bucket = F.pmod(F.xxhash64(*[F.col(c) for c in legs.columns]), F.lit(files_per_partition))
        legs = legs.repartition(*[F.col(c) for c in partition_by], bucket)
    elif gather:
        legs = legs.hint("rebalance", *partition_by)
    (legs.write.mode(modes[mode]).option("maxRecordsPerFile", max_records_per_file)
     .option("partitionOverwriteMode", "dynamic" if mode == "replace_partitions" else "static")
     .partitionBy(*partition_by).parquet(path))
    return path


def read_landed(spark: SparkSession, path: str, years: Sequence[int] | None = None,
                first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """Read landed legs; year filters become partition filters (pruned at listing)."""
    df = spark.read.parquet(path)
    if years is not None:
        df = df.where(F.col("YEAR").isin(list(years)))
    if first_year is not None:
        df = df.where(F.col("YEAR") >= first_year)
    if last_year is not None:
        df = df.where(F.col("YEAR") <= last_year)
    return df


def write_report(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False,
                 mode: str = "overwrite") -> str:
    """Write a result.  ``single_file`` coalesces to one part file and is meant for
    small aggregates only; per-flight tables should stay partitioned."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return path


def read_report(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a CSV report back with the schema it was written with (no inference)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def filter_funnel(legs: DataFrame, min_dep_delay: float = 10.0, min_arr_delay: float = -15.0,
                  max_delay: float = 360.0) -> DataFrame:
    """One row, one pass: raw legs, completed legs, and legs kept by the
    delayed-flight filter (the row counts a load reports)."""
    completed = (F.col("CANCELLED") == 0) & (F.col("DIVERTED") == 0)
    dep, arr = F.col("DEP_DELAY"), F.col("ARR_DELAY")
    kept = (completed & (dep > min_dep_delay) & (arr >= min_arr_delay)
            & (dep <= max_delay) & (arr <= max_delay))
    return legs.agg(F.count(F.lit(1)).alias("raw_rows"),
                    F.count_if(completed).alias("completed_rows"),
                    F.count_if(kept).alias("delayed_rows"))


def month_coverage(legs: DataFrame, start: tuple[int, int] = (1987, 1),
                   end: tuple[int, int] = (2025, 12),
                   available_until: tuple[int, int] = (2025, 10)) -> DataFrame:
    """Status of every calendar month in ``[start, end]``: ``future`` after
    ``available_until``, else ``present`` when legs exist for it, else ``missing``.

    The month spine is generated in Spark (a few hundred rows); the present
    months are a distinct ``(YEAR, MONTH)`` aggregate with map-side combine.
    """
    spark = legs.sparkSession
    first = f"{start[0]:04d}-{start[1]:02d}-01"
    last = f"{end[0]:04d}-{end[1]:02d}-01"
    spine = spark.range(1).select(F.explode(F.sequence(
        F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("INTERVAL 1 MONTH")))
        .alias("m")).select(F.year("m").alias("YEAR"), F.month("m").alias("MONTH"))
    present = legs.select("YEAR", "MONTH").distinct().withColumn("_present", F.lit(True))
    ym = F.col("YEAR") * 100 + F.col("MONTH")
    until = available_until[0] * 100 + available_until[1]
    return (spine.join(present, ["YEAR", "MONTH"], "left")
            .select("YEAR", "MONTH",
                    F.when(ym > until, F.lit("future"))
                    .when(F.col("_present"), F.lit("present"))
                    .otherwise(F.lit("missing")).alias("status")))


def coverage_tally(coverage: DataFrame) -> DataFrame:
    """Months per status."""
    return coverage.groupBy("status").agg(F.count(F.lit(1)).alias("months"))


def train_split(df: DataFrame, fraction: float = 0.3, key_cols: Sequence[str] = (),
                bucket: Column | None = None, seed: int = 42) -> DataFrame:
    """Label rows ``train`` / ``score`` by a hash of their key (layout-independent,
    unlike ``randomSplit``).  ``bucket`` may supply an integer in ``[0, 100)``."""
    if bucket is None:
        if not key_cols:
            raise ValueError("key_cols or bucket is required")
        bucket = F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in key_cols]), F.lit(100))
    return df.withColumn("split", F.when(bucket < F.lit(round(fraction * 100)), F.lit("train"))
                         .otherwise(F.lit("score")))
