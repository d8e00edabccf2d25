"""Leg table derived from the star-schema test tables (``lineitem`` only).

The driver's test data is TPC-H shaped, not on-time CSV.  This mapping gives a
deterministic leg table with every column the operators need, using only
integer arithmetic on lineitem keys so Spark and DuckDB agree row for row.
The DuckDB twin of these expressions is ``LEGS_CTE`` in ``legworks.plans.oracle_legs``.

Scale notes: only six lineitem columns are read (ReadSchema shows them), and a
``years`` slice becomes a range predicate on ``l_shipdate`` that Parquet
row-group statistics can skip on — a predicate on ``year(...)`` could not be
pushed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                  "l_quantity", "l_shipdate"]


def _s(c: Column) -> Column:
    return c.cast("string")


def legs_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Map lineitem rows to flight legs (FIXTURES §1 expressions)."""
    ok, pk, sk, ln = (F.col("l_orderkey"), F.col("l_partkey"),
                      F.col("l_suppkey"), F.col("l_linenumber"))
    step1 = lineitem.select(
        ok, pk, sk, ln,
        F.col("l_shipdate").cast("date").alias("d"),
        F.col("l_quantity").cast("int").alias("q"),
        ((pk % 24) * 60 + (ok % 60)).cast("int").alias("depm"),
        (F.lit(30) + ((ok % 60) * 17 + pk % 13) % 200).cast("int").alias("elapsed"),
        F.when(ok % 41 == 0, 1).otherwise(0).alias("canc"),
        F.when(pk % 89 == 0, 1).otherwise(0).alias("dvt"),
    )
    dd = F.col("q") * 8 - 30 + (pk % 8).cast("int")
    step2 = step1.select(
        "*",
        ((F.col("depm") + F.col("elapsed")) % 1440).alias("arrm"),
        dd.alias("dd"),
        (dd + ((ok * 7 + pk * 3) % 61).cast("int") - 30).alias("ad"),
    )
    d, ad = F.col("d"), F.col("ad")
    late = ad >= 15
    dep_hhmm = ((pk % 24) * 100 + (ok % 60)).cast("int")
    arr_hhmm = (F.col("arrm") / 60).cast("int") * 100 + F.col("arrm") % 60
    dest_idx = ((ok % 60) * 2 + F.when(pk % 500 == 0, 31).when(pk % 10 == 0, 7)
                .otherwise(pk % 2)) % 60
    cancelled = F.col("canc") == 1
    gone = cancelled | (F.col("dvt") == 1)
    return step2.select(
        ok, ln, pk, sk,
        F.year(d).cast("int").alias("YEAR"),
        F.month(d).cast("int").alias("MONTH"),
        d.alias("FL_DATE"),
        F.when(pk % 211 == 0, F.lit("")).otherwise(
            F.concat(_s(F.month(d)), F.lit("/"), _s(F.dayofmonth(d)), F.lit("/"),
                     _s(F.year(d)), F.lit(" 12:00:00 AM"))).alias("FL_DATE_RAW"),
        F.concat(F.lit("C"), _s(pk % 7)).alias("OP_CARRIER"),
        F.concat(F.lit("C"), _s(pk % 7)).alias("OP_UNIQUE_CARRIER"),
        F.when(pk % 101 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("N"), _s(sk))).alias("TAIL_NUM"),
        F.when(pk % 307 == 0, F.lit("USA"))
        .otherwise(F.concat(F.lit("A"), F.lpad(_s(ok % 60), 2, "0"))).alias("ORIGIN"),
        F.concat(F.lit("A"), F.lpad(_s(dest_idx), 2, "0")).alias("DEST"),
        dep_hhmm.alias("CRS_DEP_TIME"),
        arr_hhmm.cast("int").alias("CRS_ARR_TIME"),
        F.col("elapsed").alias("CRS_ELAPSED_TIME"),
        F.when(cancelled, F.lit("")).otherwise(_s(dep_hhmm)).alias("DEP_TIME_RAW"),
        F.when(gone, F.lit("")).otherwise(_s(arr_hhmm.cast("int"))).alias("ARR_TIME_RAW"),
        F.when(cancelled, F.lit(None)).otherwise(F.col("dd").cast("double")).alias("DEP_DELAY"),
        F.when(gone, F.lit(None)).otherwise(ad.cast("double")).alias("ARR_DELAY"),
        F.col("canc").cast("double").alias("CANCELLED"),
        F.col("dvt").cast("double").alias("DIVERTED"),
        (F.lit(5) + pk % 30).cast("double").alias("TAXI_OUT"),
        (F.lit(2) + ok % 15).cast("double").alias("TAXI_IN"),
        F.when(late, (ln * 3).cast("double")).alias("CARRIER_DELAY"),
        F.when(late, (pk % 5).cast("double")).alias("WEATHER_DELAY"),
        F.when(late, (ok % 25).cast("double")).alias("NAS_DELAY"),
        F.when(late, F.when(pk % 50 == 0, F.lit(10.0)).otherwise(F.lit(0.0))).alias("SECURITY_DELAY"),
        F.when(late, (sk % 40).cast("double")).alias("LATE_AIRCRAFT_DELAY"),
        (F.lit(100) + pk % 1900).cast("double").alias("DISTANCE"),
        (F.lit(20) + pk % 200).cast("double").alias("AIR_TIME"),
    )


def read_star_legs(spark: SparkSession, sf_dir: str,
                   years: Iterable[int] | None = None) -> DataFrame:
    """Read ``lineitem.parquet`` under ``sf_dir`` and map it to legs.

    ``years`` keeps only those calendar years, expressed as ship-date ranges so
    the predicate reaches the Parquet scan.
    """
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").select(*_LINEITEM_COLS)
    if years is not None:
        li = li.filter(year_range_predicate(F.col("l_shipdate"), years))
    return legs_from_lineitem(li)


def year_range_predicate(ts: Column, years: Iterable[int]) -> Column:
    """OR of half-open ``[y-01-01, y+1-01-01)`` ranges, merging adjacent years."""
    ys = sorted(set(int(y) for y in years))
    if not ys:
        return F.lit(False)
    spans: list[list[int]] = []
    for y in ys:
        if spans and spans[-1][1] == y:
            spans[-1][1] = y + 1
        else:
            spans.append([y, y + 1])
    pred = None
    for lo, hi in spans:
        part = (ts >= F.lit(f"{lo}-01-01").cast("timestamp_ntz")) & (
            ts < F.lit(f"{hi}-01-01").cast("timestamp_ntz"))
        pred = part if pred is None else (pred | part)
    return pred


def leg_key_columns() -> list[str]:
    """Columns that identify a mapped leg (with FL_DATE they are unique)."""
    return ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
