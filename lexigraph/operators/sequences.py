"""Order-dependent operators: sequences, sessions, gaps, packing."""

from __future__ import annotations

import functools
import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lexigraph.session import written


def gaps(df: DataFrame, key: list[str], number: str) -> DataFrame:
    """(key, number): the integers between a key's least and greatest number that it lacks."""
    # rows are dealt once; what lies between two neighbours is spelt out where they meet, and dealt no more
    d = df.select(*key, number).where(F.col(number).isNotNull())
    before = F.lag(number).over(Window.partitionBy(*key).orderBy(number))
    # as in SQL a null key equals nothing, so it lacks its own numbers too
    lost = functools.reduce(Column.__or__, [F.col(k).isNull() for k in key])
    last = F.when(lost, F.col(number)).otherwise(F.col(number) - 1)
    first = F.coalesce(F.col("_before") + 1, F.when(lost, F.col(number)))
    missing = d.withColumn("_before", before).select(*key, first.alias("_first"), last.alias("_last")).where("_first <= _last")
    return missing.select(*key, F.explode(F.sequence("_first", "_last")).alias(number))


def consecutive_dedup(df: DataFrame, key: list[str], order: list[Column], value: str) -> DataFrame:
    """Rows whose value differs from that of the row before."""
    before = F.lag(value).over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_before", before).where(F.col("_before").isNull() | (F.col("_before") != F.col(value))).drop("_before")


def sections(df: DataFrame, key: list[str], order: list[Column], is_head: Column, name: str = "section") -> DataFrame:
    """Adds the running number of heads: rows up to the next head share a section; 0 before the first."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(is_head.cast("long")).over(w))


def carry_forward(df: DataFrame, key: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds the last non-null value up to and with each row."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def fill_pending(df: DataFrame, key: list[str], order: list[Column], number: str) -> DataFrame:
    """Numbers for unnumbered rows: k of them between numbers n1 and n2 are numbered exactly if n2 - n1 - 1 = k."""
    up = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*key).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    d = df.withColumn("_prev", F.last(number, ignorenulls=True).over(up)).withColumn("_next", F.first(number, ignorenulls=True).over(down))
    group = Window.partitionBy(*key, "_prev", "_next")
    d = d.withColumn("_open", F.sum(F.col(number).isNull().cast("long")).over(group)).withColumn("_nth", F.row_number().over(group.orderBy(*order)))
    filled = F.when(F.col(number).isNull() & (F.col("_next") - F.col("_prev") - 1 == F.col("_open")), F.col("_prev") + F.col("_nth"))
    return d.withColumn("filled", F.coalesce(number, filled).cast("long")).drop("_prev", "_next", "_open", "_nth")


def lanes(df: DataFrame, key: list[str], start: str, end: str, id_col: str) -> DataFrame:
    """Adds lane: intervals of a key, by start, each in the first lane that is free. A greedy recurrence, so it runs a key at a time; keys are rows of a chart."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([start, end, id_col], kind="stable")
        free: list = []  # lanes, the first on top
        busy: list = []  # (end, lane)
        out, n = [], 0
        for a, b in zip(rows[start], rows[end]):
            while busy and busy[0][0] <= a:
                heapq.heappush(free, heapq.heappop(busy)[1])
            # a start that is missing fits in no lane, an end that is missing frees none
            if free and a == a:
                lane = heapq.heappop(free)
            else:
                lane, n = n, n + 1
            if b == b:
                heapq.heappush(busy, (b, lane))
            out.append(lane)
        return rows.assign(lane=out)

    return df.groupBy(*key).applyInPandas(pack, T.StructType([*df.schema.fields, T.StructField("lane", T.LongType())]))


def numbered(df: DataFrame, order: list[Column], name: str, key: tuple[str, ...] = ()) -> DataFrame:
    """Adds the number of each row, from 1, in `order` over the whole table, or over the rows of its key.

    No window holds a table or a key: rows are dealt by ranges of the order and written, a range is one window,
    and the counts of the ranges before it (a row a partition) are added. Rows that `order` leaves equal are
    numbered in any order.
    """
    full = [*map(F.col, key), *order]
    dealt = written(df.repartitionByRange(*full).withColumn("_part", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    out = dealt.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(*full))).drop("_part", "_before")
    if key:
        first = out.groupBy(*[F.col(k).alias(f"_key_{k}") for k in key]).agg(F.min(name).alias("_first"))
        same = functools.reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in key])
        out = out.join(first, same).select(*df.columns, (F.col(name) - F.col("_first") + 1).alias(name))
    return out


def columns(df: DataFrame, key: list[str], order: list[Column], height: int) -> DataFrame:
    """Adds col and row: rank in the key divided by the height, and the rest."""
    return numbered(df, order, "_n", tuple(key)).withColumn("_n", F.col("_n") - 1).withColumn("col", F.floor(F.col("_n") / height).cast("long")).withColumn("row", F.col("_n") % height).drop("_n")


def running_numbers(df: DataFrame, key: list[str], order: str, numbers: str, most: int = 6) -> DataFrame:
    """Adds number: from each row's candidates the one that goes on from the last number taken (steps of 1 to `most`). A true recurrence, a key (volume) at a time."""

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, kind="stable")
        last, out = 0, []
        for candidates in rows[numbers]:
            steps = [x for x in candidates if last < x <= last + most]
            out.append(min(steps) if steps else None)
            last = out[-1] if steps else last
        return rows.assign(number=pd.array(out, dtype="Int64"))

    return df.groupBy(*key).applyInPandas(walk, T.StructType([*df.schema.fields, T.StructField("number", T.LongType())]))
