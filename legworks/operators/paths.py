"""Paths on the route graph: fewest hops, weighted shortest paths, itineraries,
reachability and fastest-versus-reliable divergence — for many sources at once.

The graph is an edge DataFrame ``(src, dst, …)``; search state is a distance
table ``(source, node, hops, dist, cross_dist, path)``.  Each search is a
bounded loop of DataFrame joins:

* frontier ⨝ edges on ``node = src`` extends every frontier path by one leg;
* the extended paths and the state are reduced together by
  ``min(struct(value, path, is_new))`` per ``(source, node)`` — an aggregate with
  map-side partial aggregation, and a total order, so equal-cost ties resolve the
  same way on every run and layout, and the state keeps its row in a tie;
* only rows that improved become the next frontier, and the loop ends when none
  did: searches run to their fixed point unless a limit is asked for;
* a round is one job: the new state is written with ``checkpoint()`` into the
  session's shared checkpoint folder and the number of improved rows is observed
  on the way, so the plan never grows with the number of rounds and a lost
  executor costs at most one round.

Scale: the edge table is bounded by airport pairs (a few thousand routes in the
real network), the state by ``sources × airports`` — all-pairs searches hold
airports² rows with their paths, spread over the shuffle partitions.  How the
edges are joined is left to Spark's size statistics.  No path is ever
collected to the driver: paths travel as ``array<string>`` columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legworks.functions.columns import path_text
from legworks.session import materialize

MISSING_WEIGHT = 999999.0
EXACT = "decimal(28,12)"
PAIR_KEYS = ["source", "node"]
SEARCH_KEYS = ["search", *PAIR_KEYS]


# ------------------------------------------------------------------ helpers

def seed_frame(spark: SparkSession, nodes: Iterable[str]) -> DataFrame:
    """Literal source list as a one-column ``source`` frame."""
    schema = T.StructType([T.StructField("source", T.StringType(), False)])
    return spark.createDataFrame([(n,) for n in dict.fromkeys(nodes)], schema)


def all_sources(edges: DataFrame) -> DataFrame:
    """Every airport of the graph as a search source."""
    return (edges.select(F.col("src").alias("source"))
            .union(edges.select(F.col("dst").alias("source"))).distinct())


def weighted_edges(edges: DataFrame, weight: str, cross: str | None = None,
                   missing: float = MISSING_WEIGHT) -> DataFrame:
    """``(src, dst, w, c)`` with missing weights replaced by ``missing``."""
    c = F.coalesce(F.col(cross), F.lit(missing)) if cross else F.lit(0.0)
    return edges.select("src", "dst", F.coalesce(F.col(weight), F.lit(missing)).alias("w"),
                        c.cast("double").alias("c"))


# ----------------------------------------------------------------- searches

def _settle(seed: DataFrame, extend: Callable[[DataFrame], DataFrame], keys: Sequence[str],
            value: Sequence[str], limit: int | None, done: Column | None = None,
            report: dict | None = None) -> DataFrame:
    """Relax ``seed`` until no key gets a smaller ``value``, or for ``limit`` rounds.

    ``extend`` turns the state into candidates; ``is_new`` marks the rows that improved last.
    ``done``, if given, ends the search with the round that improves such a row.  ``report`` gets
    the number of ``rounds``.
    """
    state = materialize(seed.select(*keys, *value, F.lit(True).alias("is_new")))
    rounds = 0
    while limit is None or rounds < limit:
        rounds += 1
        if report is not None:
            report["rounds"] = rounds
        found = extend(state).select(*keys, *value, F.lit(True).alias("is_new"))
        best = (state.withColumn("is_new", F.lit(False)).unionByName(found)
                .groupBy(*keys).agg(F.min(F.struct(*value, "is_new")).alias("b"))
                .select(*keys, *[f"b.{v}" for v in value], "b.is_new"))
        seen = Observation()
        hit = F.count_if(F.col("is_new") & done) if done is not None else F.lit(0)
        state = materialize(best.observe(seen, F.count_if("is_new").alias("improved"),
                                         hit.alias("hits")))
        if not seen.get["improved"] or seen.get["hits"]:
            break
    return state.drop("is_new")


def multi_source_hops(edges: DataFrame, seeds: DataFrame, max_hops: int | None = None,
                      with_path: bool = False, stop_at: str | None = None) -> DataFrame:
    """Breadth-first search from every ``seeds.source`` at once.

    Returns ``(source, node, hops[, path])`` for every node reached (the source
    itself at hop 0), up to ``max_hops`` if given.  With ``with_path`` the path is the
    lexicographically smallest of the fewest-hop paths.  ``stop_at`` ends the search
    after the hop that first reaches that node (single-target use).
    """
    e = materialize(edges.select("src", "dst"))
    value = ["hops", "path"] if with_path else ["hops"]
    start = seeds.select("source", F.col("source").alias("node"), F.lit(0).alias("hops"),
                         *([F.array("source").alias("path")] if with_path else []))

    def extend(state: DataFrame) -> DataFrame:
        path = [F.concat("path", F.array("dst")).alias("path")] if with_path else []
        return state.where("is_new").join(e, F.col("node") == F.col("src")).select(
            "source", F.col("dst").alias("node"), (F.col("hops") + 1).alias("hops"), *path)

    done = F.col("node") == stop_at if stop_at is not None else None
    return _settle(start, extend, PAIR_KEYS, value, max_hops, done)


def _reject_negative(edges: DataFrame) -> None:
    """Raise if a cycle of the edges could lower a path's cost without end."""
    bad = edges.where((F.col("w") < 0) | ((F.col("w") == 0) & (F.col("c") < 0)))
    row = bad.select("search", "src", "dst", "w", "c").head()
    if row is not None:
        raise ValueError(f"weights must not be negative: {row.search} {row.src} -> {row.dst} "
                         f"has weight {row.w}, carried {row.c}")


def _stacked(edges: DataFrame, searches: dict[str, tuple[str, str | None]], missing: float
             ) -> DataFrame:
    """``(search, src, dst, w, c)``: the edges once per search, written, none negative."""
    stacked = None
    for name, (weight, cross) in searches.items():
        part = weighted_edges(edges, weight, cross, missing).withColumn("search", F.lit(name))
        stacked = part if stacked is None else stacked.unionByName(part)
    e = materialize(stacked)
    _reject_negative(e)
    return e


def shortest_paths_multi(edges: DataFrame, seeds: DataFrame,
                         searches: dict[str, tuple[str, str | None]],
                         max_rounds: int | None = None,
                         missing: float = MISSING_WEIGHT, report: dict | None = None
                         ) -> DataFrame:
    """Several weighted searches in one loop: ``searches`` maps a search name to
    ``(weight column, carried column or None)``.

    Each search is Bellman–Ford from every ``seeds.source``, over paths of any length or
    of at most ``max_rounds`` legs.  The edge table is stacked once per search and the
    state is keyed by ``(search, source, node)``, so e.g. the fastest and the
    most reliable searches share every round's jobs.  Returns ``(search,
    source, node, hops, dist, cross_dist, path)``: ``dist`` sums the weight
    along the best path, ``cross_dist`` sums the carried column along the same
    path; best = smallest ``(dist, cross_dist, legs, path)``.  A negative weight raises
    ``ValueError``; a missing weight counts as ``missing``.
    """
    e = _stacked(edges, searches, missing)
    names = F.array(*[F.lit(n) for n in searches])
    start = seeds.select(
        F.explode(names).alias("search"), "source", F.col("source").alias("node"),
        F.lit(0.0).alias("dist"), F.lit(0.0).alias("cross_dist"), F.lit(0).alias("hops"),
        F.array("source").alias("path"))

    def extend(state: DataFrame) -> DataFrame:
        f, g = state.where("is_new").alias("f"), e.alias("g")
        return (f.join(g, (F.col("f.search") == F.col("g.search"))
                       & (F.col("node") == F.col("src")))
                .select("f.search", "source", F.col("dst").alias("node"),
                        (F.col("dist") + F.col("w")).alias("dist"),
                        (F.col("cross_dist") + F.col("c")).alias("cross_dist"),
                        (F.col("hops") + 1).alias("hops"),
                        F.concat("path", F.array("dst")).alias("path")))

    value = ["dist", "cross_dist", "hops", "path"]
    return _settle(start, extend, SEARCH_KEYS, value, max_rounds, report=report).select(
        *SEARCH_KEYS, "hops", "dist", "cross_dist", "path")


def shortest_paths(edges: DataFrame, seeds: DataFrame, weight: str, cross: str | None = None,
                   max_rounds: int | None = None, missing: float = MISSING_WEIGHT) -> DataFrame:
    """Weighted shortest paths from every ``seeds.source`` (one search of
    ``shortest_paths_multi``): ``(source, node, hops, dist, cross_dist, path)``."""
    return shortest_paths_multi(edges, seeds, {"w": (weight, cross)}, max_rounds,
                                missing).drop("search")


def all_pairs_doubling(edges: DataFrame, searches: dict[str, tuple[str, str | None]],
                       missing: float = MISSING_WEIGHT, report: dict | None = None) -> DataFrame:
    """The result of ``shortest_paths_multi`` from every airport, by min-plus squaring.

    The state is the whole distance table.  A round joins it with itself where one path ends and
    another begins, so best paths of up to 2^r legs are known after r rounds, against r legs:
    rounds grow with the logarithm of the longest best path.  Only joins with a row
    that improved last are made.  A best path is put together from best paths, and the total order
    ``(dist, cross_dist, legs, path)`` holds for its parts, so the result is the same.  Sums are
    decimals of twelve places, which don't depend on the order of adding.  A round costs up to
    airports³ rows before its aggregate, a frontier round airports × edges: for dense tables
    with long paths.
    """
    e = _stacked(edges, searches, missing).withColumns(
        {c: F.col(c).cast(EXACT) for c in ("w", "c")})
    ends = F.explode(F.array("src", "dst")).alias("node")
    still = e.select("search", ends).distinct().select(
        "search", F.col("node").alias("source"), "node", F.lit(0).cast(EXACT).alias("dist"),
        F.lit(0).cast(EXACT).alias("cross_dist"), F.lit(0).alias("hops"),
        F.array("node").alias("path"))
    legs = e.where("src <> dst").select(
        "search", F.col("src").alias("source"), F.col("dst").alias("node"),
        F.col("w").alias("dist"), F.col("c").alias("cross_dist"), F.lit(1).alias("hops"),
        F.array("src", "dst").alias("path"))
    value = ["dist", "cross_dist", "hops", "path"]
    start = (still.unionByName(legs).groupBy(*SEARCH_KEYS)
             .agg(F.min(F.struct(*value)).alias("b")).select(*SEARCH_KEYS, "b.*"))

    def extend(state: DataFrame) -> DataFrame:
        known = state.where("hops > 0")

        def joined(first: DataFrame, then: DataFrame) -> DataFrame:
            a, b = first.alias("a"), then.alias("b")
            return (a.join(b, (F.col("a.search") == F.col("b.search"))
                           & (F.col("a.node") == F.col("b.source"))
                           & (F.col("a.source") != F.col("b.node")))
                    .select("a.search", "a.source", "b.node",
                            (F.col("a.dist") + F.col("b.dist")).cast(EXACT).alias("dist"),
                            (F.col("a.cross_dist") + F.col("b.cross_dist")).cast(EXACT)
                            .alias("cross_dist"),
                            (F.col("a.hops") + F.col("b.hops")).alias("hops"),
                            F.concat("a.path", F.expr("slice(b.path, 2, b.hops)")).alias("path")))

        new, old = known.where("is_new"), known.where("NOT is_new")
        return joined(new, known).unionByName(joined(old, new))

    return _settle(start, extend, SEARCH_KEYS, value, None, report=report).select(
        *SEARCH_KEYS, "hops", F.col("dist").cast("double").alias("dist"),
        F.col("cross_dist").cast("double").alias("cross_dist"), "path")


def all_pairs_hops_doubling(edges: DataFrame, report: dict | None = None) -> DataFrame:
    """The result of ``all_pairs_hops`` by squaring the hop table."""
    start = edges.where("src <> dst").select(
        F.col("src").alias("source"), F.col("dst").alias("node"), F.lit(1).alias("hops")).distinct()

    def extend(state: DataFrame) -> DataFrame:
        def joined(first: DataFrame, then: DataFrame) -> DataFrame:
            a, b = first.alias("a"), then.alias("b")
            return (a.join(b, (F.col("a.node") == F.col("b.source"))
                           & (F.col("a.source") != F.col("b.node")))
                    .select("a.source", "b.node", (F.col("a.hops") + F.col("b.hops")).alias("hops")))

        new, old = state.where("is_new"), state.where("NOT is_new")
        return joined(new, state).unionByName(joined(old, new))

    return _settle(start, extend, PAIR_KEYS, ["hops"], None, report=report)


# -------------------------------------------------------------- predecessors

def predecessor_table(edges: DataFrame, seeds: DataFrame,
                      searches: dict[str, tuple[str, str | None]],
                      missing: float = MISSING_WEIGHT) -> DataFrame:
    """The searches of ``shortest_paths_multi`` with the last airport but one instead of the path:
    ``(search, source, node, hops, dist, cross_dist, pred)``, ``pred`` NULL at the source.

    The state holds figures only, whatever the length of paths.  At the fixed point, an edge that
    gives its end exactly the end's figures is the last leg of a best path.  Where several
    do, the one stays whose path has the smaller text order; paths are never
    compared, since a path's place among those of as many legs follows from its
    predecessor's place and its last airport, hop by hop.  ``rebuild_paths`` turns the
    table into paths.
    """
    e = _stacked(edges, searches, missing)
    names = F.array(*[F.lit(n) for n in searches])
    start = seeds.select(
        F.explode(names).alias("search"), "source", F.col("source").alias("node"),
        F.lit(0.0).alias("dist"), F.lit(0.0).alias("cross_dist"), F.lit(0).alias("hops"))

    def legs(state: DataFrame) -> DataFrame:
        f, g = state.alias("f"), e.alias("g")
        return (f.join(g, (F.col("f.search") == F.col("g.search"))
                       & (F.col("node") == F.col("src")))
                .select("f.search", "source", F.col("dst").alias("node"),
                        (F.col("dist") + F.col("w")).alias("dist"),
                        (F.col("cross_dist") + F.col("c")).alias("cross_dist"),
                        (F.col("hops") + 1).alias("hops"), F.col("src").alias("pred")))

    value = ["dist", "cross_dist", "hops"]
    found = _settle(start, lambda s: legs(s.where("is_new")), SEARCH_KEYS, value, None)
    last = materialize(legs(found).join(found, [*SEARCH_KEYS, *value], "left_semi")
                       .where("hops > 0").select(*SEARCH_KEYS, "hops", "pred").distinct())
    chosen = last.groupBy(*SEARCH_KEYS).agg(F.min("pred").alias("pred"),
                                            F.count(F.lit(1)).alias("ways"))
    if chosen.where("ways > 1").isEmpty():
        preds = chosen.drop("ways")
    else:
        preds = _first_in_text_order(found, last)
    return found.join(preds, SEARCH_KEYS, "left").select(
        *SEARCH_KEYS, "hops", *value[:2], "pred")


def _first_in_text_order(found: DataFrame, last: DataFrame) -> DataFrame:
    """``(search, source, node, pred)``: of a node's possible last legs, the one whose path
    comes first.  Ranks are taken hop by hop, among a search's nodes of a hop."""
    group = ["search", "source"]
    ranked = found.where("hops = 0").select(*SEARCH_KEYS, F.lit(1).alias("rank"))
    out = []
    for hop in range(1, last.agg(F.max("hops")).head()[0] + 1):
        before = ranked.withColumnRenamed("node", "pred").alias("r")
        step = materialize(
            last.where(F.col("hops") == hop).alias("l").join(before, [*group, "pred"])
            .groupBy(*SEARCH_KEYS).agg(F.min(F.struct("rank", "pred")).alias("b"))
            .select(*SEARCH_KEYS, "b.pred", F.row_number().over(
                Window.partitionBy(*group).orderBy("b.rank", "node")).alias("rank")))
        out.append(step.select(*SEARCH_KEYS, "pred"))
        ranked = step.select(*SEARCH_KEYS, "rank")
    return reduce(DataFrame.unionByName, out)


def rebuild_paths(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of a predecessor table that ``wanted`` (search, source, node) names, with their ``path``.

    Pointer jumping: every row of the wanted searches and sources knows the piece of path
    from an ancestor to itself; a round puts the ancestor's piece before it, so pieces
    double until all begin at the source.
    """
    group = ["search", "source"]
    wanted = materialize(wanted.select(*SEARCH_KEYS).distinct())
    rows = materialize(table.join(wanted.select(*group).distinct(), group, "left_semi"))
    state = rows.select(*SEARCH_KEYS, F.col("pred").alias("up"), F.array("node").alias("path"))
    longest = rows.agg(F.max("hops")).head()[0] or 0
    for _ in range(longest.bit_length()):
        above = state.select(*group, F.col("node").alias("up"), F.col("up").alias("further"),
                             F.col("path").alias("before"))
        state = materialize(state.join(above, [*group, "up"], "left").select(
            *SEARCH_KEYS, F.col("further").alias("up"),
            F.when(F.col("before").isNull(), F.col("path"))
            .otherwise(F.concat("before", "path")).alias("path")))
    return (rows.join(wanted, SEARCH_KEYS, "left_semi")
            .join(state.select(*SEARCH_KEYS, "path"), SEARCH_KEYS))


def fastest_and_reliable(edges: DataFrame, seeds: DataFrame, max_rounds: int | None = None,
                         time_col: str = "avg_flight_time",
                         score_col: str = "reliability_score") -> tuple[DataFrame, DataFrame]:
    """Both searches of the divergence analysis in one loop: fastest by time
    carrying the score, most reliable by score carrying the time."""
    both = shortest_paths_multi(edges, seeds, {"fastest": (time_col, score_col),
                                               "reliable": (score_col, time_col)}, max_rounds)
    return (both.where(F.col("search") == "fastest").drop("search"),
            both.where(F.col("search") == "reliable").drop("search"))


# ------------------------------------------------------------ single queries

def bfs_hops(edges: DataFrame, source: str, target: str | None = None,
             max_hops: int | None = None) -> DataFrame:
    """Fewest-hop search from one airport; with ``target``, stops after the hop
    that reaches it.  ``(source, node, hops, pred, path)``."""
    spark = edges.sparkSession
    out = multi_source_hops(edges, seed_frame(spark, [source]), max_hops, with_path=True,
                            stop_at=target)
    return out.select(*PAIR_KEYS, "hops",
                      F.when(F.col("hops") > 0, F.element_at("path", -2)).alias("pred"), "path")


def route_options(edges: DataFrame, pairs: DataFrame, max_rounds: int | None = None,
                  time_col: str = "avg_flight_time", score_col: str = "reliability_score"
                  ) -> DataFrame:
    """Three answers per ``(origin, destination)`` pair: ``fewest_hops``,
    ``fastest`` (sum of ``time_col``) and ``most_reliable`` (sum of ``score_col``).

    ``(origin, destination, criterion, hops, value, path)``; ``value`` is the hop
    count, minutes or score; NULL hops/value/path when unreachable (within
    ``max_rounds`` legs, if given).  Fewest hops is the same search with unit
    weights, so all pairs and criteria share one loop, seeded with the distinct origins.  The
    loop keeps predecessors; only the paths of the pairs are rebuilt.
    """
    edges = edges.select("src", "dst", time_col, score_col, F.lit(1.0).alias("_unit"))
    seeds = pairs.select(F.col("origin").alias("source")).distinct()
    searches = {"fewest_hops": ("_unit", None), "fastest": (time_col, None),
                "most_reliable": (score_col, None)}
    wanted = pairs.select("origin", "destination").distinct().select(
        "origin", "destination",
        F.explode(F.array(*[F.lit(c) for c in ("fewest_hops", "fastest", "most_reliable")]))
        .alias("criterion"))
    if max_rounds is None:
        found = rebuild_paths(materialize(predecessor_table(edges, seeds, searches)), wanted.select(
            F.col("criterion").alias("search"), F.col("origin").alias("source"),
            F.col("destination").alias("node")))
    else:  # a search that is cut off has no fixed point to read predecessors from
        found = shortest_paths_multi(edges, seeds, searches, max_rounds)
    found = found.select(
        *PAIR_KEYS, F.col("search").alias("criterion"), "hops", F.col("dist").alias("value"),
        "path")
    return (wanted.join(found, (wanted["origin"] == found["source"])
                        & (wanted["destination"] == found["node"])
                        & (wanted["criterion"] == found["criterion"]), "left")
            .select(wanted["origin"], wanted["destination"], wanted["criterion"],
                    found["hops"], found["value"], found["path"]))


def path_legs(routes: DataFrame, paths: DataFrame, key_cols: Sequence[str] = ()) -> DataFrame:
    """One row per leg of each path, with the route's attributes and the path's
    total flight time (legs without a route are skipped; a missing flight time
    counts as 0)."""
    legs = paths.select(*key_cols, F.posexplode(F.arrays_zip(
        F.slice("path", 1, F.greatest(F.size("path") - 1, F.lit(0))),
        F.slice("path", 2, F.greatest(F.size("path") - 1, F.lit(0))))).alias("pos", "leg_pair"))
    legs = legs.select(*key_cols, (F.col("pos") + 1).alias("leg"),
                       F.col("leg_pair.0").alias("src"), F.col("leg_pair.1").alias("dst"))
    wanted = ["carriers", "flight_count", "days_with_service", "availability_pct",
              "avg_flight_time", "p90_delay", "std_delay"]
    cols = []
    for c in wanted:
        if c not in routes.columns:
            continue
        is_array = isinstance(routes.schema[c].dataType, T.ArrayType)
        cols.append(F.concat_ws(",", c).alias(c) if is_array else F.col(c))
    attrs = routes.select("src", "dst", *cols)
    joined = legs.join(attrs, ["src", "dst"], "inner")
    time = F.col("avg_flight_time") if "avg_flight_time" in routes.columns else F.lit(None)
    total = F.sum(F.coalesce(time.cast("double"), F.lit(0.0)))
    total = total.over(Window.partitionBy(*key_cols)) if key_cols else joined.select(total).scalar()
    return joined.withColumn("total_flight_time", total)


# --------------------------------------------------------- network measures

def hub_reachability(edges: DataFrame, hubs: Sequence[str], columns: int = 4,
                     max_hops: int | None = None) -> DataFrame:
    """Per hub: airports first reached at each hop 1…``columns``, and in total at any hop."""
    seeds = seed_frame(edges.sparkSession, hubs)
    reach = multi_source_hops(edges, seeds, max_hops).where(F.col("hops") > 0)
    counts = reach.groupBy("source").agg(
        *[F.count_if(F.col("hops") == h).alias(f"hop_{h}") for h in range(1, columns + 1)],
        F.count(F.lit(1)).alias("total"))
    return seeds.join(counts, "source", "left").select(
        F.col("source").alias("hub"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts.columns[1:]])


def all_pairs_hops(edges: DataFrame, max_hops: int | None = None) -> DataFrame:
    """Fewest hops for every ordered pair of distinct, connected airports.

    The searches' state has been written once already; the network reports read it
    several times.
    """
    return multi_source_hops(edges, all_sources(edges), max_hops).where(
        F.col("source") != F.col("node"))


def network_diameter(pair_hops: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row: airports, ordered pairs, reachable/unreachable pairs, % reachable,
    diameter (max hops) and pairs at the diameter."""
    n = nodes.select(F.count(F.lit(1))).scalar()
    per_hop = pair_hops.groupBy("hops").agg(F.count(F.lit(1)).alias("c"))  # ≤ max_hops rows
    stats = (per_hop.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("reachable_pairs"),
                         F.max("hops").alias("diameter"),
                         F.max_by("c", "hops").alias("pairs_at_diameter"))
             .withColumn("num_airports", n))  # the subquery bound to one column: runs once
    n = F.col("num_airports")
    total = n * (n - 1)
    return stats.select("num_airports", total.alias("total_pairs"), "reachable_pairs",
                        (total - F.col("reachable_pairs")).alias("unreachable_pairs"),
                        F.try_divide(100 * F.col("reachable_pairs"), total).alias("pct_reachable"),
                        "diameter", "pairs_at_diameter")


def hop_distribution(pair_hops: DataFrame) -> DataFrame:
    """Pairs per hop count and their percentage of all reachable pairs."""
    per = pair_hops.groupBy("hops").agg(F.count(F.lit(1)).alias("count"))
    return per.withColumn("pct", F.try_divide(100 * F.col("count"),
                                              F.sum("count").over(Window.partitionBy())))


def far_pairs(pair_hops: DataFrame, min_hops: int = 4, n: int = 20) -> DataFrame:
    """The ``n`` pairs needing the most hops among those needing ``>= min_hops``."""
    return (pair_hops.where(F.col("hops") >= min_hops)
            .orderBy(F.col("hops").desc(), "source", "node").limit(n)
            .select("source", "node", "hops"))


def far_pair_count(pair_hops: DataFrame, min_hops: int = 4) -> DataFrame:
    """One row: how many pairs need ``>= min_hops`` hops."""
    return pair_hops.agg(F.count_if(F.col("hops") >= min_hops).alias("far_pairs"))


def diameter_pairs(pair_hops: DataFrame, n: int = 10) -> DataFrame:
    """A sample of ``n`` pairs at the network diameter (ordered by pair)."""
    diameter = pair_hops.select(F.max("hops")).scalar()
    return (pair_hops.where(F.col("hops") == diameter)
            .orderBy("source", "node").limit(n).select("source", "node", "hops"))


def route_divergence(fastest: DataFrame, reliable: DataFrame, min_gain: float = 0.1,
                     only_divergent: bool = True) -> DataFrame:
    """Compare the fastest and the most reliable path of every pair.

    ``fastest`` is a search weighted by time carrying the reliability score,
    ``reliable`` the reverse; their paths are carried along if they have them.  ``time_penalty`` = extra minutes of the reliable
    path, ``reliability_gain`` = score saved by it (both 1 dp); a pair diverges
    when ``|gain| > min_gain``.
    """
    f = fastest.where(F.col("source") != F.col("node")).select(
        F.col("source").alias("src"), F.col("node").alias("dst"),
        F.col("dist").alias("fast_time"), F.col("cross_dist").alias("fast_rel_score"),
        *([F.col("path").alias("fast_path")] if "path" in fastest.columns else []))
    r = reliable.where(F.col("source") != F.col("node")).select(
        F.col("source").alias("src"), F.col("node").alias("dst"),
        F.col("dist").alias("rel_score"), F.col("cross_dist").alias("rel_time"),
        *([F.col("path").alias("rel_path")] if "path" in reliable.columns else []))
    cmp = (f.join(r, ["src", "dst"])
           .withColumn("time_penalty", F.round(F.col("rel_time") - F.col("fast_time"), 1))
           .withColumn("reliability_gain", F.round(F.col("fast_rel_score") - F.col("rel_score"), 1))
           .withColumn("divergent", F.abs(F.col("reliability_gain")) > min_gain))
    return cmp.where(F.col("divergent")).drop("divergent") if only_divergent else cmp


def divergence_stats(comparison: DataFrame) -> DataFrame:
    """One row over a full comparison (``only_divergent=False``): pairs compared,
    same/different path counts, % different and mean/max penalty and gain over
    the divergent pairs."""
    div = F.col("divergent")
    return comparison.agg(
        F.count(F.lit(1)).alias("pairs_compared"),
        F.count_if(~div).alias("same_path"),
        F.count_if(div).alias("different_paths"),
        F.try_divide(100 * F.count_if(div), F.count(F.lit(1))).alias("pct_different"),
        F.avg(F.when(div, F.col("time_penalty"))).alias("avg_time_penalty"),
        F.avg(F.when(div, F.col("reliability_gain"))).alias("avg_reliability_gain"),
        F.max(F.when(div, F.col("time_penalty"))).alias("max_time_penalty"),
        F.max(F.when(div, F.col("reliability_gain"))).alias("max_reliability_gain"))


def divergence_top_pairs(divergent: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` divergent pairs with the largest reliability gain, in figures."""
    return (divergent.orderBy(F.col("reliability_gain").desc(), "src", "dst").limit(n)
            .select("src", "dst", "fast_time", "rel_time", "fast_rel_score", "rel_score",
                    "time_penalty", "reliability_gain"))


def divergence_examples(divergent: DataFrame, n: int = 5, table: DataFrame | None = None
                        ) -> DataFrame:
    """The ``n`` pairs with the largest reliability gain, with both paths as text.

    A comparison without paths takes them from ``table``, the predecessor table of its
    searches ``fastest`` and ``reliable``: those of the ``n`` pairs only.
    """
    if table is not None:
        divergent = materialize(divergent.orderBy(F.col("reliability_gain").desc(), "src", "dst")
                                .limit(n))
        both = F.explode(F.array(F.lit("fastest"), F.lit("reliable"))).alias("search")
        paths = rebuild_paths(table, divergent.select(
            both, F.col("src").alias("source"), F.col("dst").alias("node")))
        wide = paths.groupBy(F.col("source").alias("src"), F.col("node").alias("dst")).agg(
            F.max(F.when(F.col("search") == "fastest", F.col("path"))).alias("fast_path"),
            F.max(F.when(F.col("search") == "reliable", F.col("path"))).alias("rel_path"))
        divergent = divergent.join(wide, ["src", "dst"])
    return (divergent.orderBy(F.col("reliability_gain").desc(), "src", "dst").limit(n)
            .select("src", "dst", F.round("fast_time", 0).alias("fast_time"),
                    F.round("rel_time", 0).alias("rel_time"), "fast_rel_score", "rel_score",
                    "time_penalty", "reliability_gain",
                    path_text("fast_path").alias("fastest_route"),
                    path_text("rel_path").alias("reliable_route")))
