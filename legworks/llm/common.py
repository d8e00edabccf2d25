"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from legworks.session import scratch_path

# A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
FILE_ROWS = 25_000    # narrow rows that are worth a file of their own


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def in_few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more partitions than its rows (``rows`` about or at most) are worth.

    A session may keep many shuffle partitions for few rows.  Each becomes a file, and for a file Hadoop
    starts three chmod processes on a local disk, each of which for a moment has the executor's memory twice.
    """
    return df.coalesce(max(1, -(-rows // FILE_ROWS)))


def staged(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage at a Parquet table that every executor can read, so a lost
    executor costs a re-read and later reads prune columns.  With ``rows``, ``in_few_files``:
    for narrow rows with little work, as all work since the last shuffle runs in as many tasks.
    """
    if rows is not None:
        df = in_few_files(df, rows)
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows; else as it is,
    and the join shuffles both sides.  ``df`` should be staged or tiny to count."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def sample_by_hash(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """The ``rows`` rows of ``df`` with the smallest hashes of ``keys`` (which should tell rows
    apart), all of them if it has no more.

    A threshold on the hash lets about twice as many pass before anything is sorted, so
    what meets in one task is bounded by ``rows``, not by the number of partitions.
    """
    drawn, n = F.xxhash64(*keys), df.count()
    if n > 2 * rows + 1000:
        df = df.where(drawn <= int(((2 * rows + 1000) / n - 0.5) * 2 ** 64))
    return df.orderBy(drawn, *keys).limit(rows)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def map_rows(df: DataFrame, per_batch: Callable[[dict[str, list]], dict[str, list]],
             schema: StructType) -> DataFrame:
    """Apply ``per_batch`` (columns as Python lists in, columns out) to Arrow batches."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a slice at a time, so that only a part of a batch is held as Python objects
            for at in range(0, batch.num_rows, 1000):
                out = per_batch(batch.slice(at, 1000).to_pydict())
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return df.mapInArrow(run, schema)


def map_groups(df: DataFrame, key: str, per_group: Callable[[pa.Table], list[tuple]],
               schema: StructType, tasks: int | None = None, held_rows: int = 20_000) -> DataFrame:
    """Shuffle by the long column ``key`` and apply ``per_group`` to each group's rows.

    Groups stream out of a sorted partition one at a time, so only one group is
    in memory; callers bound the size of a group beforehand.  ``tasks`` fixes the number of
    tasks, for few rows with much work; at ``held_rows`` rows of the result a task hands them on.
    """
    arrow = to_arrow_schema(schema)

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) if rows else [()] * len(arrow)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch])
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            edges = [0, *cuts.tolist(), len(keys)]
            if held and held[0].column(key)[0].as_py() != keys[0]:
                rows += per_group(pa.concat_tables(held))
                held = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                piece = part.slice(lo, hi - lo)
                if hi == len(keys):
                    held.append(piece)
                elif held:
                    rows += per_group(pa.concat_tables([*held, piece]))
                    held = []
                else:
                    rows += per_group(piece)
            if len(rows) >= held_rows:
                yield emit(rows)
                rows = []
        if held:
            rows += per_group(pa.concat_tables(held))
        yield emit(rows)

    dealt = df.repartition(tasks, key) if tasks else df.repartition(key)
    return dealt.sortWithinPartitions(key).mapInArrow(run, schema)
