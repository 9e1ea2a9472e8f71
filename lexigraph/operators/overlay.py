"""Append-only edit logs over base tables: folds, patches, change capture, and the same as streams."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def fold_edits(log: DataFrame, key: list[str], order: Column, fields: list[str], clear: str = "-") -> DataFrame:
    """The last non-empty value of each field a key; the value `clear` empties it."""
    values = []
    for c in fields:
        some = F.col(c).isNotNull() & (F.col(c) != "")
        values.append(F.nullif(F.max_by(F.when(some, F.col(c)), F.when(some, order)), F.lit(clear)).alias(c))
    return log.groupBy(*key).agg(*values)


def apply_edits(base: DataFrame, edits: DataFrame, key: list[str]) -> DataFrame:
    """base with the non-null fields of edits."""
    fields = [c for c in edits.columns if c not in key]
    e = edits.select(*key, *[F.col(c).alias(f"_{c}") for c in fields])
    return base.join(e, key, "left").select(*[F.coalesce(f"_{c}", c).alias(c) if c in fields else F.col(c) for c in base.columns])


def fold_relations(log: DataFrame, pair: list[str], op: str, order: Column) -> DataFrame:
    """Pairs whose last operation adds them, with the evidence added since the last deletion, in order."""
    rows = log.groupBy(*pair).agg(F.array_sort(F.collect_list(F.struct(order.alias("at"), F.col(op).alias("op")))).alias("ops"))
    last_del = F.array_max(F.transform(F.filter("ops", lambda x: x["op"] == "del"), lambda x: x["at"]))
    live = F.filter("ops", lambda x: (x["op"] == "add") & (last_del.isNull() | (x["at"] > last_del)))
    return rows.select(*pair, F.size(live).alias("n"), F.transform(live, lambda x: x["at"]).alias("evidence")).where("n > 0")


def changes(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """(key, field, old, new): the fields in which two versions differ; missing rows count as nulls."""
    fields = [c for c in old.columns if c not in key]

    def long(df, name):
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias(name)) for c in fields]))
        return df.select(*key, pairs.alias("x")).select(*key, "x.field", f"x.{name}")

    both = long(old, "old").join(long(new, "new"), [*key, "field"], "full")
    return both.where(~F.col("old").eqNullSafe(F.col("new")))


def validated(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with the names of the rules that they break)."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())
    d = df.withColumn("broken", broken)
    return d.where(F.size("broken") == 0).drop("broken"), d.where(F.size("broken") > 0)


def latest_in_stream(stream: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """The running last-wins value of each key of a stream of edits: state is one value a key."""

    def step(k, batches, state):
        last = state.get if state.exists else (None, None)
        for rows in batches:
            rows = rows[(rows[value].notna()) & (rows[value] != "")]
            if len(rows):
                top = rows.loc[rows[at].idxmax()]
                if last[0] is None or top[at] > last[0]:
                    last = (int(top[at]), str(top[value]))
        state.update(last)
        yield pd.DataFrame({key: [k[0]], at: [last[0]], value: [last[1]]})

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, {at} long, {value} string", f"{at} long, {value} string", "update", "NoTimeout")
