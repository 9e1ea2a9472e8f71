"""Streaming extensions, against the same in batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexigraph.operators.overlay import latest_in_stream
from lexigraph.plans.registry import ORACLE_SQL, QUERIES
from lexigraph.session import scratch
from lexigraph.streaming import events as E, relations as R


def _register(name: str, sql: str | None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return put


def _newest(df: DataFrame, keys: list[str]) -> DataFrame:
    """The last state of each key of an update stream."""
    return df.groupBy(*keys).agg(*[F.max_by(c, "batch").alias(c) for c in df.columns if c not in (*keys, "batch")])


@_register("stream_tumbling", "SELECT CAST(epoch(time_bucket(INTERVAL 1 HOUR, ts)) AS BIGINT) AS start, event_type, count(*) AS n, round(sum(value), 4) AS v FROM events GROUP BY ALL")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _newest(E.run_to_end(E.tumbling(E.read_events(spark, sf_dir)), "update"), ["start", "event_type"])


@_register("stream_sliding", "SELECT CAST(epoch(s) AS BIGINT) AS start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 1 HOUR, ts), time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR]) AS s FROM events) x GROUP BY s")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _newest(E.run_to_end(E.sliding(E.read_events(spark, sf_dir)), "update"), ["start"])


@_register("stream_static_join", "SELECT event_id, c_mktsegment AS segment FROM events JOIN customer ON user_id = c_custkey")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    return E.run_to_end(E.read_events(spark, sf_dir).join(people, "user_id").select("event_id", "segment")).drop("batch")


@_register("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = E.deduplicated(E.read_events(spark, sf_dir), ["user_id", "event_type"], "10000 days")
    return E.run_to_end(d.select("user_id", "event_type")).drop("batch")


@_register("stream_last_edit", "SELECT k, max(event_id) AS at, arg_max(v, event_id) AS v FROM (SELECT user_id AS k, event_id, event_type AS v FROM events) x GROUP BY k".replace("AS at", 'AS "at"'))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = E.read_events(spark, sf_dir).select(F.col("user_id").alias("k"), F.col("event_id").alias("at"), F.col("event_type").alias("v"))
    return _newest(E.run_to_end(latest_in_stream(e, "k", "at", "v"), "update"), ["k"])


@_register("stream_sessions", None)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.run_to_end(E.sessions(E.read_events(spark, sf_dir))).drop("batch")


def _pairs(events: DataFrame) -> DataFrame:
    """Clicks and purchases add a pair of a user and a target, errors delete it."""
    op = F.when(F.col("event_type") == "error", "del").otherwise("add")
    return events.where("event_type IN ('click', 'purchase', 'error')").select((F.col("user_id") % 50).alias("source"), (F.col("event_id") % 7).alias("target"), op.alias("op"), F.col("event_id").alias("at"), "ts")


@_register("stream_relations", """WITH l AS (SELECT user_id % 50 AS source, event_id % 7 AS target, event_type = 'error' AS del, event_id FROM events WHERE event_type IN ('click', 'purchase', 'error')),
d AS (SELECT source, target, coalesce(max(event_id) FILTER (WHERE del), -1) AS deleted FROM l GROUP BY ALL)
SELECT l.source, l.target, count(*) AS n, array_to_string(list(event_id ORDER BY event_id), ' ') AS evidence FROM l JOIN d ON d.source = l.source AND d.target = l.target WHERE NOT del AND event_id > deleted GROUP BY ALL""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs folded in a map state (STM-02): what stands after the whole log."""
    live = E.run_to_end(R.folded_pairs(_pairs(E.read_events(spark, sf_dir))), "update")
    last = _newest(live.drop("at"), ["source", "target"]).where("n > 0")
    return last.select("source", "target", "n", F.array_join(F.transform("evidence", lambda x: x.cast("string")), " ").alias("evidence"))


def rules():
    return {"value": F.col("value").between(0, 100), "known type": F.col("event_type").isin("view", "click", "purchase", "error", "signup"), "props": F.get_json_object("props", "$.k").try_cast("int") > 4}


@_register("stream_validated", """WITH e AS (SELECT event_id, list_filter([CASE WHEN coalesce(value BETWEEN 0 AND 100, false) THEN NULL ELSE 'value' END, CASE WHEN coalesce(event_type IN ('view', 'click', 'purchase', 'error', 'signup'), false) THEN NULL ELSE 'known type' END,
CASE WHEN coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) > 4, false) THEN NULL ELSE 'props' END], lambda x: x IS NOT NULL) AS b FROM events) SELECT event_id, CASE WHEN len(b) = 0 THEN 'good' ELSE 'bad' END AS sink, array_to_string(b, ',') AS broken FROM e""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that break a rule go to a sink of their own with the rules' names, the others to theirs (STM-05)."""
    out, rejects = scratch(spark, "good"), scratch(spark, "bad")
    R.run_validated(E.read_events(spark, sf_dir), rules(), out, rejects)
    good = spark.read.parquet(out).select("event_id", F.lit("good").alias("sink"), F.lit("").alias("broken"))
    return good.union(spark.read.parquet(rejects).select("event_id", F.lit("bad"), F.array_join("broken", ",")))
