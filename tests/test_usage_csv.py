"""End-to-end: the README flow on on-time CSV files in the 77-column source layout
(an export of the mapped sf0.001 legs), from CSV scan to route divergence."""

import os

import pytest
from pyspark.sql import functions as F

from legworks.functions.columns import parse_flight_date
from legworks.operators import paths as G
from legworks.operators import propagation as P
from legworks.operators import recovery as R
from legworks.operators import routes as N
from legworks.session import materialize
from legworks.sources.legs import land_parquet, read_landed, read_legs, to_source_layout, write_report
from legworks.sources.star import read_star_legs

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(f"{SF}/lineitem.parquet"), reason="test tables not present")
def test_csv_to_reports(spark, tmp_path):
    mapped = read_star_legs(spark, SF)
    src = (mapped.drop("FL_DATE").withColumn("OP_CARRIER_FL_NUM", F.col("l_linenumber")))
    renames = {"FL_DATE_RAW": "FL_DATE", "DEP_TIME_RAW": "DEP_TIME", "ARR_TIME_RAW": "ARR_TIME"}
    csv, landed = str(tmp_path / "csv"), str(tmp_path / "landed")
    write_report(to_source_layout(src, renames), csv)
    land_parquet(read_legs(spark, csv), landed)
    legs = read_landed(spark, landed, first_year=1995, last_year=2001)
    assert legs.count() == mapped.count()
    legs = (legs.withColumn("FL_DATE_STR", F.col("FL_DATE"))
            .withColumn("FL_DATE", parse_flight_date("FL_DATE")))

    # recovery regimes from CSV equal those from the mapped table
    from_csv = {(r.YEAR, r.recovery_status): r["count"] for r in
                R.recovery_regimes(R.bucket_clusters(R.delayed_flights(legs))).collect()}
    from_map = {(r.YEAR, r.recovery_status): r["count"] for r in
                R.recovery_regimes(R.bucket_clusters(R.delayed_flights(mapped))).collect()}
    assert from_csv == from_map

    extra = P.extra_delay(P.clean_legs(legs, date_col="FL_DATE_STR", keep=["OP_CARRIER_FL_NUM"]),
                          tie_break=["OP_CARRIER_FL_NUM"])
    assert P.airport_cascade_causes(extra, years=[1995, 1997]).count() > 0

    routes = materialize(N.direct_routes(N.schedule_minutes(legs)))
    edges = N.network_edges(routes, min_flights=10, exclude=("USA",))
    fast, rel = G.fastest_and_reliable(edges, G.all_sources(edges))
    cmp = G.route_divergence(fast, rel, only_divergent=False)
    assert cmp.where("reliability_gain < 0").count() == 0
    assert cmp.count() == fast.where("source <> node").count()
