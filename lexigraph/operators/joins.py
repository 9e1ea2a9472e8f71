"""Joins that Spark has no operator for, from equi-joins on derived keys."""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lexigraph.functions.numbers import EARTH_KM, haversine_km
from lexigraph.operators.sequences import numbered
from lexigraph.session import written


def range_join(points: DataFrame, ranges: DataFrame, at: str, low: str, high: str, width: float, on: list[str] | None = None) -> DataFrame:
    """Rows of points beside the rows of ranges with low <= at <= high and equal `on` columns.

    Ranges are spread over the bins of `width` they touch, points are in one bin each: an equi-join, no loop
    over all pairs. Every pair meets in one bin, so none is doubled.
    """
    on = on or []
    p = points.withColumn("_bin", F.floor(F.col(at) / width))
    r = ranges.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    return p.join(r, [*on, "_bin"]).where(F.col(at).between(F.col(low), F.col(high))).drop("_bin")


def prefix_join(left: DataFrame, right: DataFrame, text: str, prefix: str, least: int) -> DataFrame:
    """Rows whose `text` starts with a `prefix` of the right side, by equality of the first `least` characters; shorter prefixes are not joined."""
    a = left.withColumn("_head", F.substring(text, 1, least))
    b = right.where(F.length(prefix) >= least).withColumn("_head", F.substring(prefix, 1, least))
    return a.join(b, "_head").where(F.col(text).startswith(F.col(prefix))).drop("_head")


def first_of(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key: a lateral top-1."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def fallback_join(left: DataFrame, right: DataFrame, on: str, keys: list[Column], keep: list[str]) -> DataFrame:
    """left with the `keep` columns of the first of several keys that `on` of the right side has; nulls where none has."""
    ordered = F.array(*[F.struct(F.lit(i).alias("rank"), k.alias("key")) for i, k in enumerate(keys)])
    tagged = left.withColumn("_id", F.monotonically_increasing_id())
    hits = tagged.select("_id", F.explode(ordered).alias("k")).join(right, F.col("k.key") == right[on])
    best = hits.groupBy("_id").agg(*[F.min_by(c, "k.rank").alias(c) for c in keep])
    return tagged.join(best, "_id", "left").drop("_id")


def upsert(base: DataFrame, facts: DataFrame, key: list[str]) -> DataFrame:
    """base with the non-null values of facts where base has none, and the rows of facts that base lacks."""
    columns = [c for c in base.columns if c not in key]
    f = facts.select(*key, *[F.col(c).alias(f"_{c}") for c in columns])
    filled = base.join(f, key, "left").select(*key, *[F.coalesce(c, f"_{c}").alias(c) for c in columns])
    return filled.unionByName(facts.join(base, key, "left_anti").select(*key, *columns))


def nearest(points: DataFrame, nodes: DataFrame, id_col: str, node_col: str, distance: Column, cell: float, reach: int = 1, keep: float | None = None) -> DataFrame:
    """For each point (id, x, y) the nearest of nodes (node, nx, ny) in the cells around it, within `keep`.

    Both sides carry columns x, y and nx, ny. Cells of side `cell`; a node is looked for in the (2 * reach + 1)^2
    cells around the point, so `keep` must not exceed reach * cell in the measure of `distance`.
    """
    spread = F.explode(F.sequence(F.lit(-reach), F.lit(reach)))
    p = points.withColumn("_dx", spread).withColumn("_dy", spread)
    p = p.withColumn("_cx", F.floor(F.col("x") / cell) + F.col("_dx")).withColumn("_cy", F.floor(F.col("y") / cell) + F.col("_dy"))
    n = nodes.withColumn("_cx", F.floor(F.col("nx") / cell)).withColumn("_cy", F.floor(F.col("ny") / cell))
    met = p.join(n, ["_cx", "_cy"]).withColumn("km", distance)
    if keep is not None:
        met = met.where(F.col("km") <= keep)
    return met.groupBy(id_col).agg(F.min_by(node_col, F.struct("km", node_col)).alias(node_col), F.min("km").alias("km"))


def within_km(left: DataFrame, right: DataFrame, reach: float) -> DataFrame:
    """Rows of left (a, x1, y1) beside the rows of right (b, x2, y2), longitudes and latitudes, that are at most `reach` km away, with km.

    Points are in cubes of space whose side is the chord of the reach, so that all partners are in the 27 cubes
    around one: an equi-join, at the poles and across the date line too. Null coordinates meet nothing.
    """
    radius = EARTH_KM / 2
    side = 2 * radius * math.sin(min(reach / (2 * radius), math.pi / 2)) + 1e-3

    def cube(lon: str, lat: str) -> list[Column]:
        x, y = F.radians(lon), F.radians(lat)
        return [F.floor(c * (radius / side)) for c in (F.cos(y) * F.cos(x), F.cos(y) * F.sin(x), F.sin(y))]

    a = left.select("*", *[c.alias(f"_{i}") for i, c in enumerate(cube("x1", "y1"))])
    b = right.select("*", *[c.alias(f"_c{i}") for i, c in enumerate(cube("x2", "y2"))])
    for i in range(3):
        b = b.withColumn(f"_{i}", F.explode(F.sequence(F.col(f"_c{i}") - 1, F.col(f"_c{i}") + 1))).drop(f"_c{i}")
    met = a.join(b, ["_0", "_1", "_2"]).drop("_0", "_1", "_2")
    return met.withColumn("km", haversine_km(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))).where(F.col("km") <= reach)


def nearest_vectors(df: DataFrame, id_col: str, vector_col: str, is_query: Column, k: int, block: int = 2048) -> DataFrame:
    """(query, id, similarity): for each row of df that is a query the k rows of other ids with the largest cosine, by similarity to six digits and then by smaller id.

    Every query meets every row: queries travel in blocks of at most `block` vectors, each block to all
    partitions, which keep their best k and send only those. Vectors without length have similarity 0. An
    array of null or a null vector is no row. Ties go to the smaller id; repeated ids are one query each.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id is not null and v is not null")
    queries = numbered(rows.where(is_query), [F.col("id")], "n").withColumn("block", F.floor((F.col("n") - 1) / block))
    queries = written(queries.select("block", "id", "v"), "queries")
    found = []
    for b in range(1 + (queries.agg(F.max("block")).first()[0] if not queries.isEmpty() else -1)):
        held = queries.where(F.col("block") == b).collect()
        shared = spark.sparkContext.broadcast((np.array([r["id"] for r in held], np.int64), _unit(np.array([r["v"] for r in held], float))))
        found.append(written(rows.mapInArrow(_best_of(shared, k), "query long, id long, similarity double"), "nearest"))
    if not found:
        return spark.createDataFrame([], "query long, id long, similarity double")
    best = Window.partitionBy("query").orderBy(F.desc("similarity"), "id")
    return functools.reduce(DataFrame.union, found).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).drop("n")


def _unit(v: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(size > 0, size, 1.0)


def _best_of(shared, k: int):
    """The best k rows of a partition for each query of a block, batch after batch."""

    def run(batches):
        names, queries = shared.value
        ids = np.empty((len(names), 0), np.int64)
        near = np.empty((len(names), 0))
        for batch in (b.slice(i, 1024) for b in batches for i in range(0, b.num_rows, 1024)):
            mine = batch["id"].to_numpy()
            vectors = np.vstack(batch["v"].to_numpy(zero_copy_only=False))
            s = np.round(queries @ _unit(vectors).T, 6)
            s[names[:, None] == mine[None, :]] = -2.0
            ids = np.concatenate([ids, np.broadcast_to(mine, s.shape)], axis=1)
            near = np.concatenate([near, s], axis=1)
            order = np.lexsort((ids, -near), axis=1)[:, :k]
            ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
        real = near > -2.0
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names, ids.shape[1])[real.ravel()]), pa.array(ids[real]), pa.array(near[real])], names=["query", "id", "similarity"])

    return run
