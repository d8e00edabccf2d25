"""Hand fixtures for routes and paths (FIXTURES §3: clock, one_route, graph)."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from legworks.functions.columns import hhmm_to_minutes, roll_past_midnight
from legworks.operators import paths as G
from legworks.operators import routes as N


def test_clock_minutes_and_overnight(spark):
    df = spark.createDataFrame([(0, 0), (5, 2359), (2350, 15), (2400, 30)], "d int, a int")
    dep, arr = hhmm_to_minutes("d"), hhmm_to_minutes("a")
    out = df.select(dep.alias("dm"), roll_past_midnight(arr, dep).alias("am")).collect()
    assert [(r.dm, r.am) for r in out] == [(0, 0), (5, 1439), (1430, 1455), (1440, 1470)]


def _flights(spark):
    d = dt.date(2003, 1, 5)
    rows = [  # date, src, dst, carrier, flight_time, arr_delay
        (d, "AAA", "BBB", "ZZ", 60, 5.0),
        (d, "AAA", "BBB", "XX", 70, 15.0),
        (d + dt.timedelta(days=1), "AAA", "BBB", "XX", None, 25.0),
        (d, "BBB", "CCC", "YY", 50, -5.0),   # one-flight route
    ]
    return spark.createDataFrame(rows, "date date, src string, dst string, carrier string, flight_time int, arr_delay double")


def test_direct_routes_one_route(spark):
    out = {(r.src, r.dst): r for r in N.direct_routes(_flights(spark)).collect()}
    ab, bc = out[("AAA", "BBB")], out[("BBB", "CCC")]
    assert ab.flight_count == 3 and ab.days_with_service == 2 and ab.num_carriers == 2
    assert ab.carriers == ["XX", "ZZ"]                 # sorted set
    assert ab.avg_flight_time == pytest.approx(65.0)    # NULL flight time ignored
    assert ab.p90_delay == 25.0
    assert ab.availability_pct == 100.0
    assert bc.std_delay == 0.0                          # one flight → 0, not NULL
    assert bc.reliability_score == pytest.approx(50.0 - 5.0)
    assert bc.availability_pct == 50.0


def _graph(spark):
    rows = [  # src, dst, flight_count, avg_flight_time, reliability_score
        ("S", "A", 20, 1.0, 5.0), ("S", "B", 20, 2.0, 1.0),   # diamond S→{A,B}→T: A fast,
        ("A", "T", 20, 1.0, 5.0), ("B", "T", 20, 2.0, 1.0),   # B reliable, equal hops
        ("T", "T", 20, 1.0, 1.0),                            # self loop
        ("S", "USA", 20, 0.1, 0.1), ("USA", "T", 20, 0.1, 0.1),
        ("S", "N", 20, None, 1.0),                           # NULL weight → 999999
        ("Q", "S", 20, 1.0, 1.0),                            # Q unreachable from S
    ] + [(f"C{i}", f"C{i + 1}", 20, 1.0, 1.0) for i in range(10)] + [("S", "C0", 20, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "src string, dst string, flight_count long, avg_flight_time double, reliability_score double")
    return N.network_edges(df, 10, exclude=("USA",))


def test_bfs_paths_and_ties(spark):
    out = {r.node: r for r in G.bfs_hops(_graph(spark), "S").collect()}
    assert out["S"].hops == 0 and out["S"].pred is None
    assert out["T"].hops == 2 and out["T"].path == ["S", "A", "T"]   # lexicographic tie-break
    assert "USA" not in out and "Q" not in out
    assert out["C10"].hops == 11                                      # to the end of the chain
    capped = {r.node: r for r in G.bfs_hops(_graph(spark), "S", max_hops=6).collect()}
    assert capped["C5"].hops == 6 and "C6" not in capped              # a limit on request


def test_bfs_stops_after_target_hop(spark):
    out = G.bfs_hops(_graph(spark), "S", target="A")
    assert out.agg(F.max("hops")).first()[0] == 1


def test_long_chain_answers_all_criteria(spark):
    rows = [(f"N{i}", f"N{i + 1}", 20, 1.0, 2.0) for i in range(12)]
    e = spark.createDataFrame(rows, "src string, dst string, flight_count long, "
                                    "avg_flight_time double, reliability_score double")
    pairs = spark.createDataFrame([("N0", "N10")], "origin string, destination string")
    out = {r.criterion: r for r in G.route_options(e, pairs).collect()}
    assert {c: (r.hops, r.value) for c, r in out.items()} == {
        "fewest_hops": (10, 10.0), "fastest": (10, 10.0), "most_reliable": (10, 20.0)}
    assert G.all_pairs_hops(e).agg(F.max("hops")).first()[0] == 12


def test_negative_weights_are_refused_and_zero_cycles_end(spark):
    schema = "src string, dst string, w double"
    bad = spark.createDataFrame([("A", "B", -5.0), ("B", "A", -5.0)], schema)
    with pytest.raises(ValueError, match="negative"):
        G.shortest_paths(bad, G.seed_frame(spark, ["A"]), "w")
    free = spark.createDataFrame([("A", "B", 0.0), ("B", "A", 0.0), ("A", "Z", 0.0)], schema)
    out = {r.node: r.path for r in G.shortest_paths(free, G.seed_frame(spark, ["A"]), "w").collect()}
    assert out == {"A": ["A"], "B": ["A", "B"], "Z": ["A", "Z"]}


def test_shortest_paths_cap_and_missing_weight(spark):
    e = _graph(spark)
    out = {r.node: r for r in G.shortest_paths(e, G.seed_frame(spark, ["S"]), "avg_flight_time",
                                               "reliability_score", max_rounds=8).collect()}
    assert out["T"].dist == 2.0 and out["T"].path == ["S", "A", "T"]
    assert out["T"].cross_dist == 10.0
    assert out["N"].dist == 999999.0
    assert out["C7"].hops == 8 and "C8" not in out                     # 8 legs at most
    rel = {r.node: r for r in G.shortest_paths(e, G.seed_frame(spark, ["S"]), "reliability_score",
                                               "avg_flight_time").collect()}
    assert rel["T"].path == ["S", "B", "T"] and rel["T"].dist == 2.0 and rel["T"].cross_dist == 4.0


def test_divergence_gain_never_negative(spark):
    e = _graph(spark)
    seeds = G.all_sources(e)
    fast = G.shortest_paths(e, seeds, "avg_flight_time", "reliability_score")
    rel = G.shortest_paths(e, seeds, "reliability_score", "avg_flight_time")
    cmp = G.route_divergence(fast, rel, only_divergent=False)
    assert cmp.where("reliability_gain < 0").count() == 0
    assert cmp.where("time_penalty < 0").count() == 0
    row = cmp.where("src = 'S' AND dst = 'T'").first()
    assert row.divergent and row.reliability_gain == 8.0 and row.time_penalty == 2.0


def test_all_pairs_hops_triangle_rule(spark):
    e = _graph(spark)
    hops = G.all_pairs_hops(e)
    # d(s, v) <= d(s, u) + 1 for every edge u→v
    h = hops.alias("h")
    viol = (h.join(e.alias("e"), F.col("h.node") == F.col("e.src"))
            .join(hops.alias("h2"), (F.col("h2.source") == F.col("h.source"))
                  & (F.col("h2.node") == F.col("e.dst")))
            .where(F.col("h2.hops") > F.col("h.hops") + 1))
    assert viol.count() == 0


def test_hub_reachability_counts(spark):
    out = {r.hub: r for r in G.hub_reachability(_graph(spark), ["S", "ZZZ"], 4).collect()}
    assert out["S"].hop_1 == 4 and out["S"].hop_2 == 2      # A B N C0 ; T C1
    assert out["S"].total == 15                              # beyond the four columns, too
    assert out["ZZZ"].total == 0


def test_path_legs_total(spark):
    e = _graph(spark)
    paths = spark.createDataFrame([("p", ["S", "A", "T"]), ("q", ["S"])], "id string, path array<string>")
    legs = G.path_legs(e, paths, ["id"]).collect()
    assert [(r.leg, r.src, r.dst) for r in sorted(legs, key=lambda r: r.leg)] == [(1, "S", "A"), (2, "A", "T")]
    assert all(r.total_flight_time == 2.0 for r in legs)


def test_airport_degrees_stacked(spark):
    e = _graph(spark)
    d = {r.airport: r for r in N.airport_degrees(e).collect()}
    assert d["Q"].in_degree == 0 and d["Q"].out_degree == 1
    assert d["T"].in_degree == 3 and d["T"].out_degree == 1


def test_route_options_agree_with_bfs(spark):
    e = _graph(spark)
    pairs = spark.createDataFrame([("S", "T"), ("S", "C5"), ("S", "C7"), ("S", "S"), ("S", "Q")],
                                  "origin string, destination string")
    out = {(r.destination, r.criterion): r for r in G.route_options(e, pairs).collect()}
    assert len(out) == 15
    bfs = {r.node: r for r in G.bfs_hops(e, "S").collect()}
    for dst in ("T", "C5", "C7", "S"):
        assert out[(dst, "fewest_hops")].hops == bfs[dst].hops
        assert out[(dst, "fewest_hops")].path == bfs[dst].path
    assert out[("C7", "fastest")].hops == 8
    few = {(r.destination, r.criterion): r for r in G.route_options(e, pairs, 6).collect()}
    assert few[("C7", "fewest_hops")].path is None            # 8 legs, 6 asked for
    assert out[("T", "fastest")].path == ["S", "A", "T"]
    assert out[("T", "most_reliable")].path == ["S", "B", "T"]
    assert out[("S", "fastest")].hops == 0                    # self pair: 0 legs
    assert out[("Q", "fastest")].path is None                 # unreachable


def test_direct_routes_approx_p90_matches_exact(spark):
    import random
    rnd = random.Random(4)
    d = dt.date(2003, 1, 5)
    rows = [(d + dt.timedelta(days=rnd.randint(0, 30)), f"A{rnd.randint(0, 3)}", f"B{rnd.randint(0, 3)}",
             "XX", 60, float(rnd.randint(-30, 200))) for _ in range(3000)]
    f = spark.createDataFrame(rows, "date date, src string, dst string, carrier string, flight_time int, arr_delay double")
    exact = {(r.src, r.dst): r.p90_delay for r in N.direct_routes(f).collect()}
    approx = {(r.src, r.dst): r.p90_delay
              for r in N.direct_routes(f, p90_method="approx", accuracy=1_000_000).collect()}
    assert exact == approx


def _random_edges(spark, seed, nodes=7, whole=False):
    import random
    rnd = random.Random(seed)
    pairs = {(f"N{rnd.randrange(nodes):02d}", f"N{rnd.randrange(nodes):02d}") for _ in range(3 * nodes)}
    # a long chain, so that best paths of many legs exist; whole weights, so that paths tie
    pairs |= {(f"L{i:02d}", f"L{i + 1:02d}") for i in range(8)} | {("N00", "L00")}
    draw = (lambda: float(rnd.randint(1, 3))) if whole else (lambda: rnd.uniform(1, 90))
    rows = [(a, b, 20, draw(), draw()) for a, b in sorted(pairs)]
    return spark.createDataFrame(rows, "src string, dst string, flight_count long, "
                                       "avg_flight_time double, reliability_score double").coalesce(1)


BOTH = {"fastest": ("avg_flight_time", "reliability_score"),
        "reliable": ("reliability_score", "avg_flight_time")}


def _plain(df):
    return sorted(([round(v, 6) if isinstance(v, float) else v for v in r]
                   for r in df.select(sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("seed,whole", [(1, False), (2, True)])
def test_doubling_gives_the_frontier_search_in_fewer_rounds(spark, seed, whole):
    e = _random_edges(spark, seed, whole=whole)
    plain, doubled = {}, {}
    want = _plain(G.shortest_paths_multi(e, G.all_sources(e), BOTH, report=plain))
    assert _plain(G.all_pairs_doubling(e, BOTH, report=doubled)) == want
    assert doubled["rounds"] <= max(plain["rounds"] / 2, 5)
    hops = {}
    assert _plain(G.all_pairs_hops_doubling(e, hops)) == _plain(G.all_pairs_hops(e))
    assert hops["rounds"] <= 5               # 16 legs at most, and a round that finds nothing


def test_doubling_refuses_negative_weights(spark):
    e = spark.createDataFrame([("A", "B", -1.0)], "src string, dst string, w double")
    with pytest.raises(ValueError, match="negative"):
        G.all_pairs_doubling(e, {"w": ("w", None)})


@pytest.mark.parametrize("seed,whole", [(3, False), (4, True)])
def test_predecessors_rebuild_the_same_paths(spark, seed, whole):
    e = _random_edges(spark, seed, whole=whole)
    searches = BOTH | {"legs": ("one", None)}
    e = e.withColumn("one", F.lit(1.0))          # unit weights: ties are the rule
    seeds = G.all_sources(e)
    table = G.predecessor_table(e, seeds, searches)
    assert not any(t.startswith("array") for _, t in table.dtypes)
    want = G.shortest_paths_multi(e, seeds, searches)
    wanted = want.select("search", "source", "node")
    assert _plain(G.rebuild_paths(table, wanted).drop("pred")) == _plain(want)
    # one pair of one search
    one = G.rebuild_paths(table, wanted.where("search = 'legs' AND source = 'N00' AND node = 'L05'"))
    assert [r.path for r in one.collect()] == [["N00", *(f"L{i:02d}" for i in range(6))]]
    assert table.where("pred IS NULL AND source <> node").isEmpty()


def test_divergence_examples_from_predecessors(spark):
    e = _graph(spark)
    fast, rel = G.fastest_and_reliable(e, G.all_sources(e))
    want = _plain(G.divergence_examples(G.route_divergence(fast, rel)))
    table = G.predecessor_table(e, G.all_sources(e), BOTH)
    parts = [table.where(F.col("search") == n) for n in BOTH]
    assert _plain(G.divergence_examples(G.route_divergence(*parts), table=table)) == want and want


def test_route_options_by_predecessors_and_with_a_cap(spark):
    e = _random_edges(spark, 6, whole=True)
    pairs = spark.createDataFrame([("N00", "L05"), ("N01", "N01"), ("N00", "none"), ("N02", "N03")],
                                  "origin string, destination string")
    assert _plain(G.route_options(e, pairs)) == _plain(G.route_options(e, pairs, max_rounds=40))
    short = {(r.origin, r.destination): r.hops for r in G.route_options(
        e, pairs, max_rounds=2).where("criterion = 'fewest_hops'").collect()}
    assert short[("N00", "L05")] is None and short[("N01", "N01")] == 0


def test_days_with_service_without_a_row_per_route_and_day(spark):
    d = dt.date(2003, 1, 5)
    rows = [(d + dt.timedelta(days=i % 7), "AAA", "BBB" if i % 2 else "CCC", "ZZ", 60, float(i))
            for i in range(70)] + [(None, "AAA", "BBB", "XX", 60, 1.0), (None, None, "DDD", "XX", 60, 2.0)]
    flights = spark.createDataFrame(rows, "date date, src string, dst string, carrier string, "
                                          "flight_time int, arr_delay double")
    table = N.direct_routes(flights)
    found = {(r.src, r.dst): (r.flight_count, r.days_with_service, r.availability_pct)
             for r in table.collect()}
    assert found == {("AAA", "BBB"): (36, 7, 100.0), ("AAA", "CCC"): (35, 7, 100.0),
                     (None, "DDD"): (1, 0, 0.0)}
    assert dict(table.dtypes)["days_with_service"] == "bigint"
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"keys=\[src#\d+, dst#\d+, date#\d+", plan)
