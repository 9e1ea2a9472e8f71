"""Graph operators as joins and aggregations over edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexigraph.operators.sequences import numbered
from lexigraph.session import checkpointed


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node with an edge to another node; component is the smallest reachable node.

    Alternates large-star and small-star rounds until the edge set stands still. Every round is
    two aggregations and two joins, is cut by checkpoint(), and never gathers a component in one place.
    Null endpoints and self loops are ignored; nodes without edges do not appear.
    """
    pairs = edges.select(F.greatest(src, dst).alias("hi"), F.least(src, dst).alias("lo"), (F.col(src) != F.col(dst)).alias("real"))
    e = checkpointed(pairs.where("real").select("hi", "lo").distinct())
    before = None
    for _ in range(max_rounds):
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
        if now == before or not now["n"]:
            break
        before = now
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select("hi", "lo", "m")
        star = small.select("hi", F.col("m").alias("lo")).union(small.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
        e = checkpointed(star.distinct())
    else:
        raise RuntimeError(f"no fixpoint after {max_rounds} rounds")
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())


def bfs_levels(edges: DataFrame, sources: DataFrame, max_depth: int, step: Column | None = None, state: list[str] | None = None) -> DataFrame:
    """(node, parent, depth, state...): breadth-first from sources (node, state...) over edges (src, dst, ...).

    `step` is a condition over the edge's columns and the state of its start (columns state of the reached
    node come from the edge as n_<name>). Of several ways to a node in one round the smallest parent wins.
    One join and one anti-join a round, cut by checkpoint; ends when nothing new is reached.
    """
    state = state or []
    seen = checkpointed(sources.select("node", F.lit(None).cast(dict(sources.dtypes)["node"]).alias("parent"), F.lit(0).alias("depth"), *state))
    frontier = seen
    for depth in range(1, max_depth + 1):
        f = frontier.select(F.col("node").alias("src"), *state)
        met = edges.join(f, "src")
        if step is not None:
            met = met.where(step)
        met = met.join(seen.select(F.col("node").alias("dst")), "dst", "left_anti")
        new = met.groupBy("dst").agg(F.min(F.struct("src", *[F.col(f"n_{s}").alias(s) for s in state])).alias("x"))
        frontier = checkpointed(new.select(F.col("dst").alias("node"), F.col("x.src").alias("parent"), F.lit(depth).alias("depth"), *[F.col(f"x.{s}").alias(s) for s in state]))
        if frontier.isEmpty():
            break
        seen = seen.union(frontier)
    return seen


def shortest_paths(edges: DataFrame, sources: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(origin, node, km, path): least sum of weights from every source over edges (src, dst, km), with the nodes on the way.

    Relaxation in rounds: each round extends every best path by one edge and keeps the best a pair of origin
    and node (ties: the smaller path). Ends when no distance changes.
    """
    best = checkpointed(sources.select(F.col("node").alias("origin"), "node", F.lit(0.0).alias("km"), F.array(F.col("node")).alias("path")))
    for _ in range(max_rounds):
        longer = best.select("origin", F.col("node").alias("src"), F.col("km").alias("so_far"), "path").join(edges, "src")
        longer = longer.select("origin", F.col("dst").alias("node"), (F.col("so_far") + F.col("km")).alias("km"), F.concat("path", F.array("dst")).alias("path"))
        new = best.union(longer).groupBy("origin", "node").agg(F.min(F.struct("km", "path")).alias("x"))
        new = checkpointed(new.select("origin", "node", "x.km", "x.path"))
        changed = new.join(best.select("origin", "node", F.col("km").alias("old")), ["origin", "node"], "left").where("old is null or old > km").isEmpty()
        best = new
        if changed:
            return best
    raise RuntimeError(f"no fixpoint after {max_rounds} rounds")


def roots(children: DataFrame, max_hops: int = 20) -> DataFrame:
    """(node, root, hops): up the tree of (node, parent) by pointer doubling; null parents are roots. Cycles end at max_hops doublings."""
    up = checkpointed(children.select("node", F.coalesce("parent", "node").alias("root"), F.when(F.col("parent").isNull(), 0).otherwise(1).alias("hops")))
    for _ in range(max(1, max_hops.bit_length())):
        above = up.select(F.col("node").alias("root"), F.col("root").alias("next"), F.col("hops").alias("more"))
        up = checkpointed(up.join(above, "root", "left").select("node", F.coalesce("next", "root").alias("root"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops")))
    return up


def recursive_roots(children: DataFrame, max_hops: int = 40) -> DataFrame:
    """The same as roots() by a recursive common table expression, for trees that are not deep: down from the roots, a level a step.

    A cycle has no root, so its rows do not appear and nothing runs on; trees deeper than max_hops are an error.
    LIMIT ALL lifts the bound on the rows of a recursion (spark.sql.cteRecursionRowLimit, a million).
    """
    return children.sparkSession.sql(
        f"""WITH RECURSIVE r(node, root, hops) MAX RECURSION LEVEL {int(max_hops)} AS (
        SELECT node, node, 0 FROM {{c}} WHERE parent IS NULL UNION ALL SELECT c.node, r.root, r.hops + 1 FROM {{c}} c JOIN r ON c.parent = r.node)
        SELECT node, root, hops FROM r LIMIT ALL""", c=children)


def barycentre_layout(nodes: DataFrame, edges: DataFrame, sweeps: int = 24) -> DataFrame:
    """(node, layer, pos): order in layers by the mean position of neighbours, all layers at once in each sweep.

    The simultaneous (Jacobi) form of the sweep: a sweep is one join and one numbering, in which no task holds a
    layer. A sequential sweep may settle at other positions.
    """
    pos = checkpointed(_placed(nodes.select("node", "layer"), ["node"]))
    both = checkpointed(edges.select("src", "dst").union(edges.select("dst", "src")).distinct())
    for _ in range(sweeps):
        mean = both.join(pos.select(F.col("node").alias("dst"), "pos"), "dst").groupBy(F.col("src").alias("node")).agg(F.avg("pos").alias("mean"))
        pulled = pos.join(mean, "node", "left").select("node", "layer", F.coalesce("mean", "pos").alias("want"))
        pos = checkpointed(_placed(pulled, ["want", "node"]))
    return pos


def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """(node, layer, pos): numbered in each layer."""
    return numbered(nodes, [F.col(c) for c in order], "pos", ("layer",)).select("node", "layer", F.col("pos").cast("double").alias("pos"))


def impute_years(nodes: DataFrame, edges: DataFrame, step: int = 30, sweeps: int = 20) -> DataFrame:
    """(node, year, guessed): unknown years from neighbours, a teacher `step` before and a student `step` after; all at once in each sweep.

    What known years give is the same in each sweep and summed once; only links between unknown years are dealt in every sweep.
    """
    y = checkpointed(nodes.select("node", F.col("year").cast("double").alias("year"), F.col("year").isNull().alias("guessed")))
    links = edges.select(F.col("src").alias("node"), F.col("dst").alias("other"), F.lit(-step).alias("shift")).union(edges.select("dst", "src", F.lit(step)))
    links = links.join(y.where("guessed").select("node"), "node", "left_semi")
    given = lambda d: d.select(F.col("node").alias("other"), "year")
    told = lambda d: d.groupBy("node").agg(F.sum(F.col("year") + F.col("shift")).alias("s"), F.count("*").alias("n"))
    fixed = checkpointed(told(links.join(given(y.where("NOT guessed")), "other")))
    links = checkpointed(links.join(y.where("guessed").select(F.col("node").alias("other")), "other", "left_semi"))
    for _ in range(sweeps):
        moved = told(links.join(given(y.where("guessed AND year IS NOT NULL")), "other"))
        means = fixed.union(moved).groupBy("node").agg((F.sum("s") / F.sum("n")).alias("mean"))
        y = checkpointed(y.join(means, "node", "left").select("node", F.when(F.col("guessed"), F.coalesce("mean", "year")).otherwise(F.col("year")).alias("year"), "guessed"))
    return y
