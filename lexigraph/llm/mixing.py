"""Operator 10: mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexigraph.llm.common import free_name
from lexigraph.session import written

#: Weights of the sources by rank, repeating.
WEIGHTS = (5, 2, 1)
#: A source is repeated at most this often.
MAX_EPOCHS = 3
#: Hex digits of the sampling key that name a slice of a source; each slice is one window.
SLICE_DIGITS = 3


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than space and U+0009 to U+000D (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    The targets share the sum of all sizes by weight; a target above epochs * source_size is clamped and
    its excess goes to the others by weight until none is above. All unclamped targets are level * weight,
    so the sources that clamp are a prefix in the order of cap / weight, and the level follows from running
    sums. Both windows run over one row a source, never over documents.
    """
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(rank) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * epochs)
    order = [(F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = s.withColumn("level", (F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    # the first source in this order that the level does not fill fixes the level of all after it
    s = s.withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
    s = s.withColumn("level", F.min(F.when(F.col("open"), F.struct((F.col("cap") / F.col("weight")).alias("r"), F.col("level").alias("level")))).over(everything)["level"])
    return s.select("source", "source_size", F.least(F.col("cap"), F.col("level") * F.col("weight")).alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS, seed: int = 17) -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, taken (words, repeats counted), copies (whole texts).

    A source whose target is r times its size repeats every document floor(r) times. For the fraction that
    is left its documents are taken whole in a seeded order (md5 of seed and id, or text without id) until the
    target is reached; the last one counts with the words that were still missing, and as a whole copy if
    that is at least half of it. The running sums are split: words of each slice of the order first, then
    inside each slice, so that no source is in one task. Reruns agree, as the order depends on the rows alone.

    Null texts have size 0, a null source is a source of its own and comes last, null ids are sampled alike,
    repeated rows count each. An empty table gives an empty result. Other columns of docs are not read.
    """
    named = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null "), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), F.md5(F.concat(F.lit(f"mix-{seed}:"), named)).alias("key"))
    d = written(d, "mix-sizes")  # the texts are read once
    d = d.withColumn("slice", F.substring("key", 1, SLICE_DIGITS))
    slices = d.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    targets = water_fill(slices.groupBy("source").agg(F.sum("slice_size").alias("source_size")), weights, epochs)
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("offset", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0))).drop("slice_size")
    plan = slices.join(targets, slices["source"].eqNullSafe(targets["source"])).select(slices["source"].alias("p_source"), F.col("slice").alias("p_slice"), "offset", "source_size", "target")
    within = Window.partitionBy("source", "slice").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("local", F.coalesce(F.sum("size").over(within), F.lit(0)))
    d = d.join(plan, d["source"].eqNullSafe(plan["p_source"]) & (F.col("slice") == F.col("p_slice")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    d = d.withColumn("whole", whole).withColumn("part", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    d = d.withColumn("extra", F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), F.col("part") - F.col("offset") - F.col("local"))))
    copies = F.col("whole") + F.when((F.col("size") > 0) & (F.col("extra") * 2 >= F.col("size")), 1).otherwise(0)
    return d.select("doc_id", "source", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("extra")).alias("taken"), copies.alias("copies"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, each as often as the mix takes its whole text; columns of any name are kept.

    Rows with equal ids are taken as often as the one of them that is taken most; rows without id as often as
    the most taken row without id.
    """
    id_col = options.get("id_col", "doc_id")
    of, copies, copy = (free_name(n, docs) for n in ("mix_id", "mix_copies", "mix_copy"))
    taken = mix_sources(docs, **options).groupBy(F.col("doc_id").alias(of)).agg(F.max("copies").alias(copies)).where(F.col(copies) > 0)
    chosen = docs.join(taken, F.col(id_col).eqNullSafe(F.col(of)))
    return chosen.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*[docs[c] for c in docs.columns])


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-17:' || coalesce(CAST(doc_id AS VARCHAR), 'null ' || md5(coalesce(text, '')))) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST(source_size AS DOUBLE) * 3 AS cap,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s),
l AS (SELECT *, ((SELECT CAST(sum(source_size) AS DOUBLE) FROM w)
          - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(cap, weight * (SELECT arg_min(level, cap / weight) FROM l WHERE level * weight <= cap)) AS target FROM l),
r AS (SELECT d.*, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS whole,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + least(size, greatest(0, CAST(round(target - whole * source_size) AS BIGINT) - earlier)) AS BIGINT) AS taken
FROM r
"""


def op10_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")
