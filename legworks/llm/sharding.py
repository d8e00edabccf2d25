"""Contiguous, balanced shards from global byte-size prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from legworks.llm.common import staged, text_or_empty


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Cut ``docs``, in the order of ``doc_id``, into ``shards`` runs of near equal bytes.

    The narrow rows (id, size, checksum) are range-partitioned by the order key;
    per-partition totals are prefix-summed (one row per partition) and added to
    the running sums inside each partition.  A row goes to the shard that holds
    the middle of its bytes, so a shard's size is off by half a row at most on
    either end.  The text itself is never shuffled.

    Size is the UTF-8 length of the text plus 1; a null text is empty (size 1,
    checksum 0).  Null ids come first.  Rows with the same id are ordered by
    checksum and size; rows equal in all three are interchangeable, and take
    neighbouring slots.  An empty table gives no rows.  Columns other than
    ``doc_id`` and ``text`` are ignored.

    Returns doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).
    """
    raw = F.encode(text_or_empty(), "UTF-8")
    order = ["doc_id", "text_crc32", "size"]
    rows = docs.select("doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"))
    # the running id only lets equal rows fall into several ranges; they are interchangeable
    ranged = (rows.withColumn("salt", F.monotonically_increasing_id())
              .repartitionByRange(*order, "salt").drop("salt")
              .withColumn("part", F.spark_partition_id()))
    placed = staged(ranged, "shard-rows")

    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
               .select("part",
                       F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
                       F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
                       F.sum("bytes").over(everything).alias("total")))

    inside = Window.partitionBy("part").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = (placed
              .withColumn("end", F.sum("size").over(running))
              .withColumn("nth", F.row_number().over(inside))
              .join(F.broadcast(offsets), "part")  # a row per shuffle partition
              .withColumn("twice_middle",
                          2 * (F.col("bytes_before") + F.col("end")) - F.col("size"))
              .withColumn("shard", F.expr(f"(twice_middle * {shards}) div (2 * total)").cast("int"))
              .withColumn("nth", F.col("rows_before") + F.col("nth")))
    firsts = summed.groupBy("shard").agg(F.min("nth").alias("first"))
    return (summed.join(F.broadcast(firsts), "shard")  # a row per shard
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("nth") - F.col("first")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
