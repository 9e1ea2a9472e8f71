"""Writers: partitioned, sharded and batched JSON, text pages, decision lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from lexigraph.operators.sequences import numbered

SHARDS = 64


def shard(id_col: Column, shards: int = SHARDS) -> Column:
    """Shard number of an id: its digits modulo the number of shards."""
    return F.pmod(F.regexp_replace(id_col, r"\D", "").try_cast("bigint"), F.lit(shards)).cast("long")


def write_sharded(df: DataFrame, id_col: str, path: str, shards: int = SHARDS) -> None:
    """JSON below path/shard=NN; rows of a shard are dealt together, so a shard is few files."""
    df.withColumn("shard", shard(F.col(id_col).cast("string"), shards)).repartition("shard").write.partitionBy("shard").mode("overwrite").json(path)


def write_entries(df: DataFrame, path: str, by: str = "book_id") -> None:
    df.write.partitionBy(by).mode("overwrite").json(path)


def write_batches(df: DataFrame, path: str, rows: int = 50) -> None:
    """Files of at most `rows` rows."""
    df.write.option("maxRecordsPerFile", rows).mode("overwrite").json(path)


def write_markdown(pages: DataFrame, path: str, key: str, order: str, title: str, body: str) -> None:
    """One text row a key: its title, then its pages in order."""
    g = pages.groupBy(key).agg(F.first(title).alias("t"), F.array_sort(F.collect_list(F.struct(order, body))).alias("p"))
    g.select(F.concat_ws("\n\n", F.concat(F.lit("# "), "t"), F.transform("p", lambda x: x[body])).alias("value")).write.mode("overwrite").text(path)


def write_pending(links: DataFrame, path: str, persons: DataFrame | None = None) -> None:
    """Open pairs for review, the likeliest first, numbered in that order over files that are sorted ranges; and the persons that they name."""
    numbered(links, [F.desc("sim"), F.desc("score"), F.asc("a"), F.asc("b")], "no").write.mode("overwrite").json(f"{path}/pairs")
    if persons is not None:
        named = links.select(F.col("a").alias("id")).union(links.select("b")).distinct()
        persons.join(named, "id", "left_semi").write.mode("overwrite").json(f"{path}/persons")


def write_parts(parts: dict[str, DataFrame], path: str) -> None:
    """Several results of one run side by side, each as JSON rows below path/name: relations, unresolved, external and estimates of a network, or places and persons' places."""
    for name, df in parts.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def write_index(index: DataFrame, path: str) -> None:
    """An index in the order of its numbers, as read_index reads it."""
    index.select("number", "name", "death", "vol", "page").repartitionByRange("number").sortWithinPartitions("number").write.mode("overwrite").json(path)


def write_panel(readings: DataFrame, path: str, key: list[str], columns: list[str]) -> None:
    """Merged readings as a panel: a row a key and a column a field with its agreed value, beside how many readings agree. CSV with a header, UTF-8."""
    value = [F.mode(c, True).alias(c) for c in columns]
    g = readings.groupBy(*key).agg(F.count("*").alias("readings"), *value)
    agree = readings.join(g.select(*key, *[F.col(c).alias(f"agreed_{c}") for c in columns]), key)
    n = agree.groupBy(*key).agg(*[F.count_if(F.col(c).eqNullSafe(F.col(f"agreed_{c}"))).alias(f"{c}_n") for c in columns])
    g.join(n, key).repartitionByRange(*key).sortWithinPartitions(*key).write.option("header", True).mode("overwrite").csv(path)


def write_counting(df: DataFrame, path: str, counters: dict[str, Column] | None = None, form: str = "parquet") -> dict[str, int]:
    """Writes df and gives `rows` and how many rows meet each counter's condition, gathered in the run that writes: nothing is read twice."""
    seen = Observation()
    marks = [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in (counters or {}).items()]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *marks).write.format(form).mode("overwrite").save(path)
    return seen.get
