"""Incremental landing of monthly on-time CSV files with Structured Streaming.

The source data arrives one monthly file at a time.  Instead of re-reading the
whole CSV directory, a file stream picks up only files it has not seen (the
file source tracks them in its checkpoint), applies the explicit leg schema
and appends them to a ``YEAR``/``MONTH``-partitioned Parquet table of the layout that
``legworks.sources.legs.land_parquet`` writes.  With its checkpoint, a restarted
query (lost driver or executors) resumes without losing or repeating months; the
checkpoint therefore lives in the table's folder unless one is named.

A table has one kind of writer: readers of a streamed table see only what its log
lists, so a stream refuses a folder that holds batch rows, and a batch landing
refuses a streamed table.

This is the only streaming piece: every analysis in the library is a batch
query over the landed table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from legworks.schema import LEG_SCHEMA
from legworks.session import exists, file_stamp
from legworks.sources.legs import STREAM_LOG, csv_reader, typed_legs


def land_stream(spark: SparkSession, csv_dir: str, out_path: str,
                checkpoint: str | None = None, partition_by: Sequence[str] = ("YEAR", "MONTH"),
                max_files_per_trigger: int | None = None, available_now: bool = True,
                processing_time: str | None = None, bad_rows: str = "raise") -> StreamingQuery:
    """Start the landing stream and return its handle.

    ``available_now`` processes every file present and stops (a scheduled
    batch-style run); otherwise the query keeps running with
    ``processing_time`` triggers.  ``checkpoint`` defaults to ``_checkpoint`` in
    ``out_path``, so every call for a table resumes the last.  Headers and bad lines are treated as
    by ``read_legs``.
    """
    out_path = out_path.rstrip("/")
    if exists(spark, out_path) and not exists(spark, f"{out_path}/{STREAM_LOG}") and any(
            not name.startswith(("_", ".")) for name, *_ in file_stamp(spark, out_path)):
        raise ValueError(f"{out_path} holds rows that no stream has landed; they would be hidden")
    reader = csv_reader(spark.readStream, LEG_SCHEMA, bad_rows)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    legs = typed_legs(reader.csv(csv_dir), LEG_SCHEMA, bad_rows)
    writer = (legs.writeStream.format("parquet")
              .option("path", out_path)
              .option("checkpointLocation", checkpoint or f"{out_path}/_checkpoint")
              .partitionBy(*partition_by)
              .outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
