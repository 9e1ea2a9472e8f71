"""Operator 12: audit of how the sources of a language differ, with identical texts counted once."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lexigraph.llm.common import pieces
from lexigraph.session import written

#: A language keeps the terms that at least so many of its documents hold.
MIN_DOCS = 30
#: Added to every count before shares are taken, and the scale of a share.
SMOOTH, SCALE = 5, 1_000_000_000
#: Rows of a group's term report.
TERM_RANKS = 50
#: Bytes of distinct texts, and counts, that a task holds before it passes them on.
TEXT_BYTES, COUNTS = 16 << 20, 400_000

#: Bytes of terms: letters, A-Z lowered, and all bytes of characters beyond ASCII; all others separate.
_TERM_BYTES = bytes(ord(chr(b).lower()) if chr(b).isascii() and chr(b).isalpha() else b if b > 0x7F else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: runs of letters and of characters beyond ASCII, A-Z in lower case."""
    return text.translate(_TERM_BYTES).split()


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, text) to rows (lang, text, sources, counts); copies in one task become one row, so a hot text moves once a task."""
    groups: dict[tuple, Counter] = {}
    held = 0

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in groups], pa.string()), pa.array([k[1] for k in groups], pa.binary()), pa.array([list(c) for c in groups.values()], pa.list_(pa.string())), pa.array([list(c.values()) for c in groups.values()], pa.list_(pa.int64()))],
            names=["lang", "text", "sources", "counts"],
        )

    for batch in batches:
        for piece in pieces(batch):
            for lang, source, text in zip(*[c.to_pylist() for c in piece.columns], strict=True):
                known = groups.get((lang, text))
                if known is None:
                    known = groups[lang, text] = Counter()
                    held += len(text) + 200
                known[source] += 1
            if held >= TEXT_BYTES:
                yield out()
                groups.clear()
                held = 0
    if groups:
        yield out()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text, sources, counts), copies adjacent, to partial counts (lang, source, term, n).

    A text is tokenized once for all its copies. Rows without source count documents of the language, rows
    without term name the groups that occur.
    """
    docs: dict[str, Counter] = {}
    counts: dict[tuple[str, str], Counter] = {}

    def take(lang, text, sources: Counter) -> None:
        found = terms_of(text)
        once = None
        for source, n in sources.items():
            c = counts.setdefault((lang, source), Counter())
            if n == 1:
                c.update(found)
            else:
                once = once or Counter(found)
                for term, k in once.items():
                    c[term] += n * k
        c, n = docs.setdefault(lang, Counter()), sources.total()
        if n == 1:
            c.update(set(found))
        else:
            for term in set(found):
                c[term] += n

    def out() -> Iterator[pa.RecordBatch]:
        for key, c in [*(((lang, None), c) for lang, c in docs.items()), *counts.items()]:
            terms, n = list(c), list(c.values())
            if key[1] is not None:
                terms, n = [None, *terms], [0, *n]
            yield pa.RecordBatch.from_arrays([pa.array([key[0]] * len(n), pa.string()), pa.array([key[1]] * len(n), pa.string()), pa.array(terms, pa.binary()), pa.array(n, pa.int64())], names=["lang", "source", "term", "n"])

    last, sources = None, Counter()
    for batch in batches:
        for piece in pieces(batch):
            for lang, text, names, numbers in zip(*[c.to_pylist() for c in piece.columns], strict=True):
                if (lang, text) != last:
                    if last is not None:
                        take(*last, sources)
                    last, sources = (lang, text), Counter()
                for name, n in zip(names, numbers, strict=True):
                    sources[name] += n
            if sum(map(len, counts.values())) + sum(map(len, docs.values())) >= COUNTS:
                yield from out()
                docs.clear()
                counts.clear()
    if last is not None:
        take(*last, sources)
    yield from out()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Partial counts (lang, source, term, n) of all rows, to be summed; see _counted for rows without source or term."""
    d = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))], F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("text"))
    alike = d.mapInArrow(_copies, "lang string, text binary, sources array<string>, counts array<long>")
    alike = alike.repartition("lang", "text").withColumn("at", F.xxhash64("text")).sortWithinPartitions("at", "lang", "text").drop("at")
    made = alike.mapInArrow(_counted, "lang string, source string, term binary, n long")
    return made.withColumn("term", F.col("term").cast("string"))


def _share(n: Column, whole: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / whole), in whole numbers of any length."""
    return F.call_function("div", (n + SMOOTH).cast("decimal(28,0)") * F.lit(SCALE), whole.cast("decimal(28,0)")) + 1


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language is from each other one, and its terms above the language's share.

    Texts that are the same are dealt to one place with a count for each source, tokenized once, and add
    weighted document frequencies and counts. Terms in fewer than min_docs documents of the language go. The
    distance of two sources is a sum over all kept terms, but only terms that both hold are joined: with z the share of a
    term that a source lacks, the rest follows from the histogram of each source's shares and the number of terms it holds:
    sum |p - q| = sum over common terms (|p - q| - |p - z_q| - |q - z_p| + |z_p - z_q|)
                  + sum over own terms |p - z_q| + sum over own terms |q - z_p| + (V - own p - own q) |z_p - z_q|.

    Rows of part "pair" number the square of a language's sources by contract; nothing else does. A hot text moves once a
    task, a hot source or term is summed in tasks first. Null texts, languages and sources are empty ones; repeated rows
    count each; ties rank by item; an empty table gives an empty result; other columns are not read. A language
    without kept terms has pairs of value 0.
    """
    counts = written(term_counts(docs, text_col, lang_col, source_col), "divergence-counts")
    kept = counts.where("source IS NULL").groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term")
    kept = written(kept, "divergence-terms")
    own = counts.where("source IS NOT NULL AND term IS NOT NULL").join(kept, ["lang", "term"], "left_semi")
    own = written(own.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")), "divergence-own")
    terms = kept.groupBy("lang").agg(F.count("*").alias("v"))
    sizes = own.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count("*").alias("held"))
    groups = counts.where("source IS NOT NULL AND term IS NULL").select("lang", "source").distinct().join(terms, "lang", "left").join(sizes, ["lang", "source"], "left").na.fill(0)
    whole = F.col("size") + SMOOTH * F.col("v")
    groups = written(groups.select("lang", "source", "v", "held", whole.alias("whole"), F.when(F.col("v") > 0, _share(F.lit(0), whole)).alias("lack")), "divergence-groups")
    shares = own.join(groups, ["lang", "source"]).select("lang", "source", "term", "lack", _share(F.col("n"), F.col("whole")).alias("p"))

    one, two = (shares.select("lang", "term", *[F.col(c).alias(f"{c}{k}") for c in ("source", "lack", "p")]) for k in (1, 2))
    gap = lambda x, y: F.abs(F.col(x) - F.col(y))
    common = one.join(two, ["lang", "term"]).where("source1 < source2")
    common = common.groupBy("lang", "source1", "source2").agg(F.sum(gap("p1", "p2") - gap("p1", "lack2") - gap("p2", "lack1") + gap("lack1", "lack2")).alias("both"))
    common = common.union(common.select("lang", F.col("source2"), F.col("source1"), "both"))
    lacks = groups.where("lack IS NOT NULL").select("lang", F.col("lack").alias("other")).distinct()
    alone = shares.groupBy("lang", "source", "p").count().join(lacks, "lang").groupBy("lang", "source", "other").agg(F.sum(gap("p", "other") * F.col("count")).alias("alone"))
    sides = [groups.select("lang", *[F.col(c).alias(f"{c}{k}") for c in ("source", "held", "lack")], *(["v"] if k == 1 else [])) for k in (1, 2)]
    pairs = sides[0].join(sides[1], "lang").where("source1 <> source2").join(common, ["lang", "source1", "source2"], "left")
    for k, other in ((1, 2), (2, 1)):
        pairs = pairs.join(alone.select("lang", F.col("source").alias(f"source{k}"), F.col("other").alias(f"lack{other}"), F.col("alone").alias(f"alone{k}")), ["lang", f"source{k}", f"lack{other}"], "left")
    none = F.lit(0).cast("long")
    value = F.coalesce("both", none) + F.coalesce("alone1", none) + F.coalesce("alone2", none) + F.coalesce((F.col("v") - F.col("held1") - F.col("held2")) * gap("lack1", "lack2"), none)
    pairs = pairs.select("lang", F.col("source1").alias("source"), F.lit("pair").alias("part"), F.col("source2").alias("item"), value.alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    everywhere = own.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    totals = everywhere.groupBy("lang").agg(F.sum("n").alias("size")).join(terms, "lang").select("lang", whole.alias("whole"))
    usual = everywhere.join(totals, "lang").select("lang", "term", _share(F.col("n"), F.col("whole")).alias("q"))
    above = shares.join(usual, ["lang", "term"]).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    above = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    return pairs.union(above)


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT lang, source, term, k, count(*) AS n FROM (SELECT lang, source, k, unnest(w) AS term FROM d) GROUP BY lang, source, term, k),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(*) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT g.lang, count(DISTINCT term) AS v FROM g LEFT JOIN kept USING (lang) GROUP BY g.lang),
c AS (SELECT g.lang, g.source, kept.term, CAST(coalesce(sum(n), 0) AS HUGEINT) AS n FROM g JOIN kept USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = kept.term GROUP BY g.lang, g.source, kept.term),
s AS (SELECT c.*, CAST(1 + 1000000000 * (n + 5) // (sum(n) OVER (PARTITION BY c.lang, c.source) + 5 * v) AS BIGINT) AS p FROM c JOIN v USING (lang)),
a AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term),
q AS (SELECT a.lang, term, CAST(1 + 1000000000 * (CAST(n AS HUGEINT) + 5) // (CAST(sum(n) OVER (PARTITION BY a.lang) AS HUGEINT) + 5 * v) AS BIGINT) AS q FROM a JOIN v USING (lang)),
r AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
  FROM (SELECT g.lang, g.source, s.term, s.p FROM g LEFT JOIN s ON s.lang = g.lang AND s.source = g.source) x
  JOIN (SELECT g.lang, g.source, s.term, s.p FROM g LEFT JOIN s ON s.lang = g.lang AND s.source = g.source) y
    ON x.lang = y.lang AND x.source <> y.source AND x.term IS NOT DISTINCT FROM y.term
  GROUP BY x.lang, x.source, y.source
  UNION ALL
  SELECT s.lang, s.source, 'term', s.term, s.p - q.q FROM s JOIN q ON s.lang = q.lang AND s.term = q.term WHERE s.n > 0 AND s.p > q.q)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r)
WHERE part = 'pair' OR rank <= 50
"""


def op12_source_divergence(spark, sf_dir: str) -> DataFrame:
    return source_divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))
