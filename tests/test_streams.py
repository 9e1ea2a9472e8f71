"""Streams over shuffled files against the same in batch."""

import datetime
import random

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from lexigraph.operators.overlay import fold_relations
from lexigraph.plans.streams import _pairs, rules
from lexigraph.sources.sinks import write_counting
from lexigraph.streaming import events as E, relations as R


def shuffled(spark, sf, path, files=5):
    """The events in `files` files that are each out of order and overlap in time."""
    rows = pq.read_table(f"{sf}/events.parquet")
    order = random.Random(2).sample(range(len(rows)), len(rows))
    for k in range(files):
        pq.write_table(rows.take(order[k::files]), f"{path}/events{k}.parquet")
    return spark.read.parquet(f"{sf}/events.parquet")


def test_pairs_of_shuffled_files(spark, sf, tmp_path):
    rows = shuffled(spark, sf, str(tmp_path)).withColumn("ts", F.col("ts").cast("timestamp"))
    stream = E.read_events(spark, str(tmp_path), files=1)
    live = E.run_to_end(R.folded_pairs(_pairs(stream)), "update")
    assert live.select("batch").distinct().count() == 5
    last = live.groupBy("source", "target").agg(F.max_by(F.struct("n", "evidence"), "batch").alias("x")).select("source", "target", "x.n", "x.evidence").where("n > 0")
    want = fold_relations(_pairs(rows), ["source", "target"], "op", F.col("at"))
    key = lambda r: (r[0], r[1], r[2], list(r[3]))
    assert sorted(map(key, last.collect())) == sorted(map(key, want.collect())) and want.count() > 20


def test_rejects_are_written_once(spark, sf, tmp_path):
    (tmp_path / "in").mkdir()
    rows = shuffled(spark, sf, f"{tmp_path}/in")
    counted = {}
    for _ in range(2):  # a second run without marks writes every batch again, over itself
        counted = R.run_validated(E.read_events(spark, f"{tmp_path}/in", files=1), rules(), f"{tmp_path}/good", f"{tmp_path}/bad", marks=f"{tmp_path}/marks{random.random()}")
    good, bad = spark.read.parquet(f"{tmp_path}/good"), spark.read.parquet(f"{tmp_path}/bad")
    assert good.count() + bad.count() == rows.count() and good.count() > 0 and bad.count() > 0
    assert good.select("event_id").union(bad.select("event_id")).distinct().count() == rows.count()
    assert sum(x["good"] for x in counted.values()) == good.count() and sum(x["bad"] for x in counted.values()) == bad.count() and len(counted) == 5


def test_a_timer_forgets_deletions(spark, tmp_path):
    """With a short memory a deletion is forgotten once the watermark is far behind it; what is live stays."""
    start = datetime.datetime(2024, 1, 1)
    for k in range(1, 7):  # a day apart
        kind = "error" if k % 3 == 0 else "click"
        row = {"event_id": k, "ts": start + datetime.timedelta(days=k), "user_id": 1, "event_type": kind, "value": 1.0, "props": "{}"}
        pq.write_table(pa.Table.from_pylist([row]), f"{tmp_path}/events{k}.parquet")
    live = E.run_to_end(R.folded_pairs(_pairs(E.read_events(spark, str(tmp_path), files=1)), late="1 hour", forget_ms=1000), "update")
    final = {(r.source, r.target): r.n for r in live.groupBy("source", "target").agg(F.max_by("n", "batch").alias("n")).collect()}
    assert final == {(1, 1): 1, (1, 2): 1, (1, 3): 0, (1, 4): 1, (1, 5): 1, (1, 6): 0}


def test_counters_of_the_run_that_writes(spark, sf, tmp_path):
    e = spark.read.parquet(f"{sf}/events.parquet")
    seen = write_counting(e, f"{tmp_path}/e", {"clicks": F.col("event_type") == "click", "large": F.col("value") > 10})
    assert seen == {"rows": e.count(), "clicks": e.where("event_type = 'click'").count(), "large": e.where("value > 10").count()}
    assert spark.read.parquet(f"{tmp_path}/e").count() == e.count()
