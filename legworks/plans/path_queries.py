"""Catalogue entries for the path family, with their oracle SQL.

The oracle expresses each search as a DuckDB recursive CTE that keeps, per
``(source, node, round)``, the best walk of exactly that many legs
(``min`` over a ``(dist, cross, path)`` struct), then takes the best round —
an exact-length dynamic programme, independent of the Spark frontier loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legworks.functions.columns import path_text
from legworks.operators import paths as G
from legworks.operators import routes as N
from legworks.plans.common import DESTINATION, HUBS, MIN_FLIGHTS, ORIGIN, rounded
from legworks.plans.route_queries import FLIGHTS, ROUTES, routes
from legworks.plans.sqltext import in_list, sql
from legworks.session import materialize

# Origin/destination pairs answered together: a 3-hop pair, two more pairs, a
# self pair (0 hops) and a pair whose end is not in the graph (no answer).
PAIRS = [(ORIGIN, DESTINATION), ("A07", "A45"), ("A30", "A02"), ("A15", "A15"), (ORIGIN, "USA")]
HUB_COLUMNS = 4
# Weight and carried column of the two searches that are compared.
BOTH_WAYS = {"fastest": ("avg_flight_time", "reliability_score"),
             "reliable": ("reliability_score", "avg_flight_time")}
# The searches run to their fixed point.  The SQL walks a number of legs that exceeds every
# best path of the test tables (8 legs at most).
ORACLE_LEGS = 14


def _texted(df: DataFrame) -> DataFrame:
    """Paths as ``A -> B -> C`` text at the report edge."""
    out = df
    for name in df.columns:
        if name == "path" or name.endswith("_path"):
            out = out.withColumn(name, path_text(name))
    return out


def edges(spark, sf_dir):
    """The search graph: a filter over the route table, which ``routes`` has
    already written once to the checkpoint folder."""
    return N.network_edges(routes(spark, sf_dir), MIN_FLIGHTS, exclude=("USA",))


def analysis_edges(spark, sf_dir):
    return N.network_edges(routes(spark, sf_dir), MIN_FLIGHTS, exclude=())


def _pairs(spark):
    return spark.createDataFrame(PAIRS, "origin string, destination string")


def _options(spark, sf_dir, e=None):
    e = edges(spark, sf_dir) if e is None else e
    return G.route_options(e, _pairs(spark))


def _option_legs(spark, sf_dir):
    e = edges(spark, sf_dir)  # one route table for the searches and the leg details
    return G.path_legs(e, _options(spark, sf_dir, e), ["origin", "destination", "criterion"])


def _pair_hops(spark, sf_dir):
    return G.all_pairs_hops(edges(spark, sf_dir))


def _fastest(spark, sf_dir, e=None):
    e = edges(spark, sf_dir) if e is None else e
    return G.shortest_paths(e, G.all_sources(e), "avg_flight_time", "reliability_score")


def _reliable(spark, sf_dir, e=None):
    e = edges(spark, sf_dir) if e is None else e
    return G.shortest_paths(e, G.all_sources(e), "reliability_score", "avg_flight_time")


def _comparison(spark, sf_dir, only_divergent):
    e = edges(spark, sf_dir)
    fast, rel = G.fastest_and_reliable(e, G.all_sources(e))
    return G.route_divergence(fast, rel, only_divergent=only_divergent)


def _examples(spark, sf_dir):
    """Searches without paths; those of the reported pairs are rebuilt."""
    e = edges(spark, sf_dir)
    table = materialize(G.predecessor_table(e, G.all_sources(e), BOTH_WAYS))
    parts = [table.where(F.col("search") == name) for name in BOTH_WAYS]
    return G.divergence_examples(G.route_divergence(*parts), table=table)


def _doubled(spark, sf_dir, name):
    found = G.all_pairs_doubling(edges(spark, sf_dir), {name: BOTH_WAYS[name]})
    return found.where("source <> node").drop("search")


def _diameter(spark, sf_dir):
    e = edges(spark, sf_dir)
    return G.network_diameter(G.all_pairs_hops(e), N.airport_nodes(e))


QUERIES = {
    "bfs_hops": lambda s, d: _texted(G.bfs_hops(edges(s, d), ORIGIN, DESTINATION)),
    "shortest_paths": lambda s, d: rounded(_texted(G.shortest_paths(
        edges(s, d), G.seed_frame(s, [ORIGIN]), "avg_flight_time"))),
    "route_options": lambda s, d: rounded(_texted(_options(s, d))),
    "path_legs": lambda s, d: rounded(_option_legs(s, d)),
    "hub_reachability": lambda s, d: G.hub_reachability(analysis_edges(s, d), HUBS, HUB_COLUMNS),
    "all_pairs_hops": lambda s, d: _pair_hops(s, d),
    "network_diameter": lambda s, d: rounded(_diameter(s, d)),
    "hop_distribution": lambda s, d: rounded(G.hop_distribution(_pair_hops(s, d))),
    "far_pairs": lambda s, d: G.far_pairs(_pair_hops(s, d)),
    "far_pair_count": lambda s, d: G.far_pair_count(_pair_hops(s, d)),
    "diameter_pairs": lambda s, d: G.diameter_pairs(_pair_hops(s, d)),
    "all_pairs_fastest": lambda s, d: rounded(_texted(
        _fastest(s, d).where(F.col("source") != F.col("node")))),
    "all_pairs_reliable": lambda s, d: rounded(_texted(
        _reliable(s, d).where(F.col("source") != F.col("node")))),
    "route_divergence": lambda s, d: rounded(_texted(_comparison(s, d, True))),
    "divergence_stats": lambda s, d: rounded(G.divergence_stats(_comparison(s, d, False))),
    "divergence_top_pairs": lambda s, d: rounded(G.divergence_top_pairs(_comparison(s, d, True))),
    "divergence_examples": lambda s, d: rounded(_examples(s, d)),
    "all_pairs_hops_doubling": lambda s, d: G.all_pairs_hops_doubling(edges(s, d)),
    "all_pairs_fastest_doubling": lambda s, d: rounded(_texted(_doubled(s, d, "fastest"))),
    "all_pairs_reliable_doubling": lambda s, d: rounded(_texted(_doubled(s, d, "reliable"))),
}

# ----------------------------------------------------------------- oracle SQL

EDGES = """
edges AS (SELECT * FROM routes WHERE flight_count >= 10 AND src NOT IN ('USA') AND dst NOT IN ('USA')),
aedges AS (SELECT * FROM routes WHERE flight_count >= 10),
nodes AS (SELECT src AS source FROM edges UNION SELECT dst FROM edges),
fedges AS (SELECT src, dst, coalesce(avg_flight_time, 999999.0) AS w,
                  coalesce(reliability_score, 999999.0) AS c FROM edges),
redges AS (SELECT src, dst, coalesce(reliability_score, 999999.0) AS w,
                  coalesce(avg_flight_time, 999999.0) AS c FROM edges),
tedges AS (SELECT src, dst, coalesce(avg_flight_time, 999999.0) AS w, 0.0::DOUBLE AS c FROM edges)"""


def _bfs(name: str, seeds: str, edge_cte: str, max_hops: int = ORACLE_LEGS) -> str:
    return f"""
{name}_walk(source, node, h, path) AS (
  SELECT source, source, 0, [source] FROM ({seeds}) s
  UNION ALL
  SELECT w.source, e.dst, w.h + 1, min(list_append(w.path, e.dst))
  FROM {name}_walk w JOIN {edge_cte} e ON w.node = e.src
  WHERE w.h < {max_hops}
  GROUP BY w.source, e.dst, w.h + 1
),
{name} AS (
  SELECT source, node, h AS hops, path FROM {name}_walk
  QUALIFY row_number() OVER (PARTITION BY source, node ORDER BY h) = 1
)"""


def _sp(name: str, seeds: str, edge_cte: str, rounds: int = ORACLE_LEGS) -> str:
    return f"""
{name}_walk(source, node, it, m) AS (
  SELECT source, source, 0, {{'d': 0.0::DOUBLE, 'c': 0.0::DOUBLE, 'p': [source]}} FROM ({seeds}) s
  UNION ALL
  SELECT w.source, e.dst, w.it + 1,
         min({{'d': w.m.d + e.w, 'c': w.m.c + e.c, 'p': list_append(w.m.p, e.dst)}})
  FROM {name}_walk w JOIN {edge_cte} e ON w.node = e.src
  WHERE w.it < {rounds}
  GROUP BY w.source, e.dst, w.it + 1
),
{name} AS (
  SELECT source, node, CAST(len(m.p) - 1 AS INTEGER) AS hops, m.d AS dist, m.c AS cross_dist,
         m.p AS path
  FROM (SELECT source, node, min(m) AS m FROM {name}_walk GROUP BY source, node) t
)"""


def _text(col: str) -> str:
    return f"array_to_string({col}, ' -> ')"


_PAIRS_SQL = "SELECT * FROM (VALUES {}) v(origin, destination)".format(
    ", ".join(f"('{a}', '{b}')" for a, b in PAIRS))
_ORIGINS = f"SELECT DISTINCT origin AS source FROM ({_PAIRS_SQL}) p"

OPTIONS = _bfs("ohops", _ORIGINS, "edges", ORACLE_LEGS) + "," + _sp(
    "ofast", _ORIGINS, "tedges") + "," + _sp(
    "orel", _ORIGINS, """(SELECT src, dst, coalesce(reliability_score, 999999.0) AS w,
                                0.0::DOUBLE AS c FROM edges)""") + f""",
found AS (
  SELECT source, node, 'fewest_hops' AS criterion, hops, CAST(hops AS DOUBLE) AS value, path FROM ohops
  UNION ALL SELECT source, node, 'fastest', hops, dist, path FROM ofast
  UNION ALL SELECT source, node, 'most_reliable', hops, dist, path FROM orel
),
options AS (
  SELECT p.origin, p.destination, c.criterion, f.hops, f.value, f.path
  FROM ({_PAIRS_SQL}) p
  CROSS JOIN (VALUES ('fewest_hops'), ('fastest'), ('most_reliable')) c(criterion)
  LEFT JOIN found f ON f.source = p.origin AND f.node = p.destination AND f.criterion = c.criterion
)"""

_NODES_SQL = "SELECT source FROM nodes"
PAIR_HOPS = _bfs("aph", _NODES_SQL, "edges", ORACLE_LEGS) + """,
pair_hops AS (SELECT source, node, hops FROM aph WHERE source <> node)"""

COMPARISON = _sp("fast", _NODES_SQL, "fedges") + "," + _sp("rel", _NODES_SQL, "redges") + """,
comparison AS (
  SELECT f.source AS src, f.node AS dst, f.dist AS fast_time, f.cross_dist AS fast_rel_score,
         f.path AS fast_path, r.dist AS rel_score, r.cross_dist AS rel_time, r.path AS rel_path,
         round(r.cross_dist - f.dist, 1) AS time_penalty,
         round(f.cross_dist - r.dist, 1) AS reliability_gain
  FROM fast f JOIN rel r ON f.source = r.source AND f.node = r.node
  WHERE f.source <> f.node
),
divergent AS (SELECT * FROM comparison WHERE abs(reliability_gain) > 0.1)"""

_DIV_DOUBLES = ("fast_time", "fast_rel_score", "rel_score", "rel_time", "time_penalty",
                "reliability_gain")
_BASE = (FLIGHTS, ROUTES, EDGES)

ORACLE = {
    "bfs_hops": sql(*_BASE, _bfs("b", f"SELECT '{ORIGIN}' AS source", "edges", ORACLE_LEGS),
                    recursive=True, final=f"""
SELECT source, node, hops, CASE WHEN hops > 0 THEN path[len(path) - 1] END AS pred,
       {_text('path')} AS path
FROM b WHERE hops <= coalesce((SELECT min(hops) FROM b WHERE node = '{DESTINATION}'), {ORACLE_LEGS})"""),
    "shortest_paths": sql(*_BASE, _sp("s", f"SELECT '{ORIGIN}' AS source", "tedges"),
                          recursive=True, final=f"""
SELECT source, node, hops, dist, cross_dist, {_text('path')} AS path FROM s""",
                          round_cols=("dist", "cross_dist")),
    "route_options": sql(*_BASE, OPTIONS, recursive=True, final=f"""
SELECT origin, destination, criterion, hops, value, {_text('path')} AS path FROM options""",
                         round_cols=("value",)),
    "path_legs": sql(*_BASE, OPTIONS, recursive=True, final="""
SELECT x.*, sum(coalesce(x.avg_flight_time, 0)) OVER (PARTITION BY origin, destination, criterion)
         AS total_flight_time
FROM (
  SELECT l.origin, l.destination, l.criterion, CAST(l.leg AS INTEGER) AS leg, l.src, l.dst,
         e.carriers, e.flight_count, e.days_with_service, e.availability_pct, e.avg_flight_time,
         e.p90_delay, e.std_delay
  FROM (SELECT origin, destination, criterion, leg, path[leg] AS src, path[leg + 1] AS dst
        FROM (SELECT *, unnest(generate_series(1, len(path) - 1)) AS leg FROM options) u) l
  JOIN edges e ON e.src = l.src AND e.dst = l.dst
) x""", round_cols=("availability_pct", "avg_flight_time", "p90_delay", "std_delay",
                    "total_flight_time")),
    "hub_reachability": sql(*_BASE, _bfs("hr", f"SELECT unnest([{in_list(HUBS)}]) AS source",
                                         "aedges", ORACLE_LEGS), recursive=True, final="""
SELECT h.hub, {cols}, count(r.node) AS total
FROM (SELECT unnest([{hubs}]) AS hub) h LEFT JOIN hr r ON r.source = h.hub AND r.hops > 0
GROUP BY h.hub""".format(hubs=in_list(HUBS), cols=", ".join(
        f"count(r.node) FILTER (WHERE r.hops = {i}) AS hop_{i}" for i in range(1, HUB_COLUMNS + 1)))),
    "all_pairs_hops": sql(*_BASE, PAIR_HOPS, recursive=True, final="SELECT * FROM pair_hops"),
    "network_diameter": sql(*_BASE, PAIR_HOPS, recursive=True, final="""
SELECT n.num_airports, n.num_airports * (n.num_airports - 1) AS total_pairs,
       p.reachable_pairs, n.num_airports * (n.num_airports - 1) - p.reachable_pairs AS unreachable_pairs,
       100 * p.reachable_pairs / (n.num_airports * (n.num_airports - 1)) AS pct_reachable,
       p.diameter,
       (SELECT count(*) FROM pair_hops WHERE hops = p.diameter) AS pairs_at_diameter
FROM (SELECT count(*) AS num_airports FROM nodes) n,
     (SELECT count(*) AS reachable_pairs, max(hops) AS diameter FROM pair_hops) p""",
        round_cols=("pct_reachable",)),
    "hop_distribution": sql(*_BASE, PAIR_HOPS, recursive=True, final="""
SELECT hops, count(*) AS count, 100 * count(*) / sum(count(*)) OVER () AS pct
FROM pair_hops GROUP BY hops""", round_cols=("pct",)),
    "far_pairs": sql(*_BASE, PAIR_HOPS, recursive=True, final="""
SELECT source, node, hops FROM pair_hops WHERE hops >= 4 ORDER BY hops DESC, source, node LIMIT 20"""),
    "far_pair_count": sql(*_BASE, PAIR_HOPS, recursive=True, final="""
SELECT count(*) FILTER (WHERE hops >= 4) AS far_pairs FROM pair_hops"""),
    "diameter_pairs": sql(*_BASE, PAIR_HOPS, recursive=True, final="""
SELECT source, node, hops FROM pair_hops WHERE hops = (SELECT max(hops) FROM pair_hops)
ORDER BY source, node LIMIT 10"""),
    "all_pairs_fastest": sql(*_BASE, _sp("fast", _NODES_SQL, "fedges"), recursive=True, final=f"""
SELECT source, node, hops, dist, cross_dist, {_text('path')} AS path FROM fast
WHERE source <> node""", round_cols=("dist", "cross_dist")),
    "all_pairs_reliable": sql(*_BASE, _sp("rel", _NODES_SQL, "redges"), recursive=True, final=f"""
SELECT source, node, hops, dist, cross_dist, {_text('path')} AS path FROM rel
WHERE source <> node""", round_cols=("dist", "cross_dist")),
    "route_divergence": sql(*_BASE, COMPARISON, recursive=True, final=f"""
SELECT src, dst, fast_time, fast_rel_score, {_text('fast_path')} AS fast_path, rel_score, rel_time,
       {_text('rel_path')} AS rel_path, time_penalty, reliability_gain FROM divergent""",
        round_cols=_DIV_DOUBLES),
    "divergence_stats": sql(*_BASE, COMPARISON, recursive=True, final="""
SELECT count(*) AS pairs_compared,
       count(*) FILTER (WHERE NOT abs(reliability_gain) > 0.1) AS same_path,
       count(*) FILTER (WHERE abs(reliability_gain) > 0.1) AS different_paths,
       100 * count(*) FILTER (WHERE abs(reliability_gain) > 0.1) / count(*) AS pct_different,
       avg(time_penalty) FILTER (WHERE abs(reliability_gain) > 0.1) AS avg_time_penalty,
       avg(reliability_gain) FILTER (WHERE abs(reliability_gain) > 0.1) AS avg_reliability_gain,
       max(time_penalty) FILTER (WHERE abs(reliability_gain) > 0.1) AS max_time_penalty,
       max(reliability_gain) FILTER (WHERE abs(reliability_gain) > 0.1) AS max_reliability_gain
FROM comparison""", round_cols=("pct_different", "avg_time_penalty", "avg_reliability_gain",
                                 "max_time_penalty", "max_reliability_gain")),
    "divergence_top_pairs": sql(*_BASE, COMPARISON, recursive=True, final="""
SELECT src, dst, fast_time, rel_time, fast_rel_score, rel_score, time_penalty, reliability_gain
FROM divergent ORDER BY reliability_gain DESC, src, dst LIMIT 20""", round_cols=_DIV_DOUBLES),
    "divergence_examples": sql(*_BASE, COMPARISON, recursive=True, final=f"""
SELECT src, dst, round(fast_time, 0) AS fast_time, round(rel_time, 0) AS rel_time, fast_rel_score,
       rel_score, time_penalty, reliability_gain, {_text('fast_path')} AS fastest_route,
       {_text('rel_path')} AS reliable_route
FROM divergent ORDER BY reliability_gain DESC, src, dst LIMIT 5""", round_cols=_DIV_DOUBLES),
}
# squaring the table gives the rows of the frontier searches
ORACLE |= {f"{name}_doubling": ORACLE[name] for name in (
    "all_pairs_hops", "all_pairs_fastest", "all_pairs_reliable")}
