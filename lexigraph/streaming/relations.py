"""Relations as a stream: adds and deletions of pairs folded in a keyed map state, bad records beside the good ones."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from lexigraph.operators.overlay import validated
from lexigraph.session import scratch
from lexigraph.sources.sinks import write_counting

#: Milliseconds of event time after which a deletion without later adds is forgotten; later records of that age are behind the watermark.
FORGET_MS = 30 * 24 * 3600 * 1000
LIVE = "source long, target long, n long, evidence array<long>, at long"


class PairFold(StatefulProcessor):
    """For each source a map of targets to (time of the last deletion, adds behind it); a timer forgets deletions that nothing followed."""

    def __init__(self, forget_ms: int = FORGET_MS):
        self.forget_ms = forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        value = StructType([StructField("deleted", LongType()), StructField("adds", ArrayType(LongType()))])
        self.pairs = handle.getMapState("pairs", StructType([StructField("target", LongType())]), value)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        touched: dict[int, tuple[int, list[int]]] = {}
        newest = -1
        for batch in rows:
            for target, op, at, ms in zip(batch["target"].tolist(), batch["op"].tolist(), batch["at"].tolist(), batch["ms"].tolist()):
                if target not in touched:
                    known = self.pairs.getValue((target,)) if self.pairs.containsKey((target,)) else (-1, [])
                    touched[target] = (known[0], list(known[1]))
                deleted, adds = touched[target]
                if op == "del":
                    deleted = max(deleted, at)
                    adds = [x for x in adds if x > deleted]
                elif at > deleted and at not in adds:
                    adds.append(at)
                touched[target] = (deleted, adds)
                newest = max(newest, at)
                if not adds:
                    self.handle.registerTimer(int(ms) + self.forget_ms)
        for target, value in touched.items():
            self.pairs.updateValue((target,), value)
        made = [(key[0], t, len(adds), sorted(adds), max([deleted, *adds])) for t, (deleted, adds) in touched.items()]
        yield pd.DataFrame(made, columns=["source", "target", "n", "evidence", "at"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for target, (_, adds) in list(self.pairs.iterator()):
            if not adds:
                self.pairs.removeKey(target)
        yield pd.DataFrame(columns=["source", "target", "n", "evidence", "at"])

    def close(self) -> None:
        pass


def folded_pairs(log: DataFrame, late: str = "10000 days", forget_ms: int = FORGET_MS) -> DataFrame:
    """log (source, target, op add | del, at, ts) as a stream -> (source, target, n, evidence, at): each batch gives the pairs that it touched as they now stand.

    The order of records does not matter: an add counts if no deletion of its pair is later. State is a map a source,
    of which a batch reads and writes the touched targets only. Needs the RocksDB state store.
    """
    spark = log.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = log.withWatermark("ts", late).withColumn("ms", F.unix_millis("ts"))
    return rows.groupBy("source").transformWithStateInPandas(PairFold(forget_ms), LIVE, "Update", "EventTime")


def run_validated(stream: DataFrame, rules: dict[str, Column], out: str, rejects: str, marks: str | None = None, before: Callable[[DataFrame], DataFrame] | None = None) -> dict[int, dict[str, int]]:
    """Writes what is there now: good rows below `out`, rows that break a rule below `rejects` with the names of the rules. Gives the numbers of both by batch.

    Both are written by batch number, each batch over its own folder, so a batch that is run again after a lost driver
    leaves the same rows once. The numbers are gathered by observe() in the runs that write.
    """
    counted: dict[int, dict[str, int]] = {}

    def put(batch: DataFrame, n: int) -> None:
        good, bad = validated(batch, rules)
        good = before(good) if before else good
        counted[n] = {"good": write_counting(good, f"{out}/batch={n}")["rows"], "bad": write_counting(bad, f"{rejects}/batch={n}")["rows"]}

    q = stream.writeStream.queryName(f"v{uuid.uuid4().hex[:8]}").option("checkpointLocation", marks or scratch(stream.sparkSession, "stream-marks")).trigger(availableNow=True).foreachBatch(put).start()
    q.awaitTermination()
    return counted
