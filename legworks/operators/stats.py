"""Generic aggregate helpers: histograms, percentiles, distributions, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legworks.session import materialize


def value_histogram(df: DataFrame, keys: Sequence[str], value: str,
                    count_col: str = "c") -> DataFrame:
    """``(keys…, value, c)`` — rows per distinct value (NULL values dropped).

    A grouped count with map-side partial aggregation: a hot key shrinks to one
    row per distinct value before the shuffle.  Delays are whole minutes in a
    bounded range, so the histogram is tiny next to the legs it summarises.
    """
    return (df.where(F.col(value).isNotNull())
            .groupBy(*keys, value).agg(F.count(F.lit(1)).alias(count_col)))


def exact_percentile(c: str, p: float) -> Column:
    """Exact discrete percentile: the ``ceil(p·n)``-th smallest value, NULLs left out.

    An aggregate whose buffer is a count per distinct value: delays are whole
    minutes in a bounded range, so it merges before and after the shuffle like a
    small histogram, in the same pass as a group's other aggregates.
    """
    return F.expr(f"percentile_disc({float(p)}) WITHIN GROUP (ORDER BY `{c}`)")


def approx_percentile(c: str | Column, p: float, accuracy: int = 1_000_000) -> Column:
    """``percentile_approx`` with an explicit accuracy (exact below ~1/accuracy rows)."""
    return F.percentile_approx(F.col(c) if isinstance(c, str) else c, float(p), accuracy)


def running_totals(df: DataFrame, keys: Sequence[str], value: str, measures: dict[str, Column],
                   tasks: int | None = None) -> DataFrame:
    """``(keys…, value, measure…)``, a row per distinct value, with running sums over a key's values.

    For each measure ``m`` (a sum over the rows that share key and value) the result has ``m``,
    ``m_below`` (of all smaller values) and ``m_total`` (of the key); what lies above is
    ``m_total - m_below - m``.  Rows that tie are one row, so a sum up to and with ``m`` is that of a
    RANGE frame.  NULL values are left out.

    No key has to fit a task: ties are added up before the shuffle, the rest is dealt by ranges
    of (key, value), each partition sums its own part of a key, and the sums of the
    parts before it (a row per key and partition) are added.  ``tasks`` is the number of ranges
    (Spark's number of shuffle partitions by default).
    """
    sums = (df.where(F.col(value).isNotNull()).groupBy(*keys, value)
            .agg(*[F.sum(c).alias(m) for m, c in measures.items()]))
    order = [*keys, value]
    dealt = (sums.repartitionByRange(tasks, *order) if tasks else sums.repartitionByRange(*order))
    # written, so that every reader sees the same ranges
    dealt = materialize(dealt.withColumn("_part", F.spark_partition_id()))
    here = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # a key's parts: as many rows as it has ranges
    parts = dealt.groupBy(*keys, "_part").agg(*[F.sum(m).alias(f"_{m}") for m in measures])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    parts = parts.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_part").alias("_at"),
        *[(F.sum(f"_{m}").over(before) - F.col(f"_{m}")).alias(f"_{m}_before") for m in measures],
        *[F.sum(f"_{m}").over(whole).alias(f"{m}_total") for m in measures])
    same = F.col("_part") == F.col("_at")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return (dealt.select("*", *[(F.sum(m).over(here) - F.col(m)).alias(f"_{m}_here")
                                for m in measures])
            .join(parts, same)
            .select(*keys, value, *measures,
                    *[(F.col(f"_{m}_before") + F.col(f"_{m}_here")).alias(f"{m}_below")
                      for m in measures],
                    *[f"{m}_total" for m in measures]))


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str = "rank", method: str = "row_number") -> DataFrame:
    """Rows ranked ``<= k`` within each key (Spark plans a WindowGroupLimit)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    fn = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[method]
    return df.withColumn(rank_col, fn().over(w)).where(F.col(rank_col) <= k)


def distribution(df: DataFrame, measures: dict[str, tuple[str, str, float | None]],
                 accuracy: int = 1_000_000) -> DataFrame:
    """One row of summary figures over ``df``, in one pass.

    ``measures`` maps a result column to ``(column, statistic, argument)``; statistics are
    ``min``, ``max``, ``avg``, ``quantile`` (the argument is p), ``at_least`` and
    ``below`` (rows on that side of the argument).
    """
    kinds = {
        "min": lambda c, _: F.min(c), "max": lambda c, _: F.max(c), "avg": lambda c, _: F.avg(c),
        "quantile": lambda c, p: approx_percentile(c, p, accuracy),
        "at_least": lambda c, x: F.count_if(F.col(c) >= x),
        "below": lambda c, x: F.count_if(F.col(c) < x)}
    return df.agg(*[kinds[kind](column, arg).alias(name)
                    for name, (column, kind, arg) in measures.items()])


def rounded_columns(df: DataFrame, columns: Sequence[str], digits: int,
                    exact: Sequence[str] = ()) -> DataFrame:
    """``columns`` of ``df``, its double columns rounded but for those in ``exact``."""
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.select(*[F.round(c, digits).alias(c) if c in doubles - set(exact) else F.col(c)
                       for c in columns])
