"""Operator 5 [native]: line dedup over levelled sorted runs of line hashes."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexigraph.llm.common import LOWER, SPACE, UPPER
from lexigraph.session import scratch

#: Lines whose key is shorter than this are never dropped.
MIN_CHARS = 10
#: Runs of a level that are compacted into one run of the next level.
FANOUT = 4
#: Batches in which a whole table is fed to the runs.
BATCHES = 4
_LAST = 2**63 - 1


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(SPACE))
    # lower() is the faster of the two, and the same for ASCII
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _keyed_lines(docs: DataFrame) -> DataFrame:
    """(doc, text_hash, pos, h1, h2) for every line whose key is long enough; two independent 64-bit hashes name a key."""
    lines = docs.select("doc", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keys = lines.select("doc", "text_hash", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= MIN_CHARS)
    return keys.select("doc", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), F.col("key")).alias("h2"))


class LineRuns:
    """Sorted runs of (h1, h2, owner) in levels, as bucketed tables whose files lie below a shared path.

    add() takes a batch, merge-anti-joins its keys with all runs, bucket by bucket, and writes what is new as a
    run of level 0. A level that holds `fanout` runs is compacted into one run of the next level, so that n
    batches leave O(fanout * log n) runs. Runs are never dealt again. A key is in one run only; its owner is the document that brought it first.
    Runs are immutable and complete before they are named, so a job that dies leaves the earlier ones valid.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = FANOUT):
        self.spark, self.path, self.fanout = spark, path or scratch(spark, "line-runs"), fanout
        self.token = uuid.uuid4().hex[:12]
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}
        self.made = 0

    def _write(self, df: DataFrame, level: int) -> str:
        """A run: a bucketed table in the shared folder, dealt by (h1, h2) and sorted in each bucket."""
        self.made += 1
        name = f"line_run_{self.token}_{self.made}"
        self.paths[name] = f"{self.path}/level-{level}/run-{self.made}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        writer = df.repartition(buckets, "h1", "h2").write.bucketBy(buckets, "h1", "h2").sortBy("h1", "h2")
        writer.format("parquet").option("path", self.paths[name]).saveAsTable(name)
        return name

    def runs(self) -> list[str]:
        """The names of all runs, the largest first."""
        return [name for level in reversed(self.levels) for name in level]

    def owners(self) -> DataFrame:
        """(h1, h2, owner) of all runs, read as files: a join with it may be dealt anew, so that adaptive execution can split a hot key."""
        return self.spark.read.schema("h1 long, h2 long, owner long").parquet(*[self.paths[name] for name in self.runs()])

    def add(self, lines: DataFrame) -> None:
        new = lines.groupBy("h1", "h2").agg(F.min("doc").alias("owner"))
        for run in self.runs():  # buckets meet buckets: only the new keys are dealt
            new = new.join(self.spark.table(run).select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        self._push(0, self._write(new, 0))

    def _push(self, level: int, run: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            parts = functools.reduce(DataFrame.union, map(self.spark.table, self.levels[level]))
            merged = self._write(parts, level + 1)
            self.levels[level] = []
            self._push(level + 1, merged)

    def close(self) -> None:
        """Forgets the names of the runs; their files stay in the shared folder as long as it does."""
        for k in range(1, self.made + 1):
            self.spark.sql(f"DROP TABLE IF EXISTS line_run_{self.token}_{k}")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES, fanout: int = FANOUT, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): every line whose key an earlier document holds is dropped.

    The documents are fed to the runs in ascending ranges of ids, so that a key's owner is the smallest id
    that holds it; a join of all lines with the runs then finds the lines to drop. Only hashes and positions
    move for that; texts are dealt once, to meet their positions. A line that very many documents share makes
    one row per task on the way into the runs, and is split by the adaptive skew join on the way back.

    Null and empty texts are one empty line. Rows with equal ids are one holder, so they keep their lines;
    null ids are one holder that comes after all others. Ties cannot arise, as ids order the holders.
    An empty table gives an empty result. `keep` columns follow the others; no more are read.
    """
    spark = docs.sparkSession
    kept_columns = F.struct(*[docs[c] for c in keep]) if keep else F.lit(None)
    d = docs.select(kept_columns.alias("rest"), docs[id_col].alias("doc_id"), F.coalesce(docs[id_col].cast("long"), F.lit(_LAST)).alias("doc"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    cuts = docs.agg(F.percentile_approx(id_col, [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    runs = LineRuns(spark, fanout=fanout)
    bounds = [None, *sorted(set(cuts)), None]
    for low, high in zip(bounds, bounds[1:]):
        # ranges of the bare column reach the scan, where they pass over files and row groups
        within = F.lit(True) if low is None else F.col("doc_id") > low
        within = within & (F.col("doc_id") <= high) if high is not None else within | F.col("doc_id").isNull()
        runs.add(_keyed_lines(d.where(within)))
    lines = _keyed_lines(d)
    again = lines.join(runs.owners().hint("merge"), ["h1", "h2"]).where(F.col("doc") > F.col("owner"))
    runs.close()
    drops = again.groupBy("doc", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("drops")).select(F.col("doc").alias("d_doc"), F.col("text_hash").alias("d_hash"), "drops")
    d = d.withColumn("text_hash", F.xxhash64("text"))
    d = d.join(drops, (F.col("doc") == F.col("d_doc")) & (F.col("text_hash") == F.col("d_hash")), "left")
    d = d.select("rest", "doc_id", F.split("text", "\n", -1).alias("lines"), F.coalesce("drops", F.array().cast("array<int>")).alias("drops"))
    # the stretches between dropped lines, as slices: linear in lines plus drops
    ends = F.concat(F.array(F.lit(-1)), F.col("drops"), F.array(F.size("lines")))
    stretch = F.transform(F.sequence(F.lit(1), F.size("drops") + 1), lambda j: F.slice(F.col("lines"), F.element_at("ends", j) + 2, F.element_at("ends", j + 1) - F.element_at("ends", j) - 1))
    d = d.withColumn("ends", ends)
    return d.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("drops").cast("long").alias("n_dropped"), F.array_join(F.flatten(stretch), "\n").alias("kept"), *[F.col("rest")[c].alias(c) for c in keep])


ORACLE_SQL = r"""
WITH l AS (
  SELECT doc_id, CAST(g.pos AS BIGINT) AS pos, x[g.pos] AS line,
         translate(trim(x[g.pos], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents) t, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS pos) g),
o AS (SELECT key, min(doc_id) AS owner FROM l WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
f AS (SELECT l.*, (o.key IS NOT NULL AND l.doc_id <> o.owner) AS dropped FROM l LEFT JOIN o ON l.key = o.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    kept = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
