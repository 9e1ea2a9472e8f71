"""Which documents are the same: terms, blocks, scores, links, clusters, canonical records."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lexigraph.functions.text import fold_latin
from lexigraph.operators import match as M
from lexigraph.operators.graph import connected_components
from lexigraph.operators.sequences import numbered
from lexigraph.plans.registry import query
from lexigraph.plans.scalars import TEXT_QUERIES
from lexigraph.session import written

#: Runs of words that make a document's set, and the similarity from which a pair is the same or is left to a person.
WORDS, AUTO, PENDING = 5, 0.8, 0.6
#: Width of a bin of agg05_name_score, which divides its reach of 500, customers of a task, and slices of the customers of a bin.
BIN, SCORED, SLICES = 50, 4096, 4


def folded(t):
    return t("documents").select("doc_id", "source", "lang", "n_chars", fold_latin(F.col("text")).alias("key"))


def sets(t):
    """(id, rep, source, items): documents beside the smallest id with the same folded text, and its set of shingles. Written once, behind the dealing."""
    d = folded(t).select("doc_id", "source", "key")
    reps = M.representatives(d, "doc_id", F.md5("key"))
    return written(d.join(reps, F.col("doc_id") == F.col("id")).select("id", "rep", "source", M.shingles(F.split("key", " "), WORDS).alias("items")), "sets")


def pairs(t, known=None):
    """Scored pairs of different folded texts, each named by its smallest id: all with a likeness of PENDING or more."""
    s = (known or sets(t)).where("id = rep")
    both = M.with_sides(M.similar_sets(s.select("id", "items"), PENDING), s, "id", ["source"])
    score = F.round(F.col("shared") / (F.col("n") + F.col("m") - F.col("shared")), 9)
    return both.select("a", "b", "a_source", "b_source", "shared", F.round(F.col("shared") / F.least("n", "m"), 9).alias("overlap"), score.alias("score"))


_CTE = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, lang, n_chars, {TEXT_QUERIES['str03_fold_latin'][1]} AS key FROM documents),
m AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY key) AS rep FROM d),
w AS (SELECT doc_id, source, string_split(key, ' ') AS w FROM d SEMI JOIN m ON m.rep = d.doc_id),
i AS (SELECT DISTINCT doc_id, array_to_string(w[k : k + {WORDS - 1}], ' ') AS item FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - {WORDS - 1}) + 1)) AS k FROM w) x),
n AS (SELECT doc_id, count(*) AS n FROM i GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM i x JOIN i y ON x.item = y.item AND x.doc_id < y.doc_id GROUP BY ALL),
s AS (SELECT a, b, x.source AS a_source, y.source AS b_source, shared, round(shared / least(u.n, v.n), 9) AS overlap, round(shared / (u.n + v.n - shared), 9) AS score
      FROM p JOIN w x ON x.doc_id = a JOIN w y ON y.doc_id = b JOIN n u ON u.doc_id = a JOIN n v ON v.doc_id = b WHERE shared >= {PENDING} * (u.n + v.n - shared) - 1e-9)
"""


@query("agg02_term_frequency", f"SELECT term, count(*) AS n FROM (SELECT unnest(list_distinct(string_split({TEXT_QUERIES['str03_fold_latin'][1]}, ' '))) AS term FROM documents) x GROUP BY term")
def _(t):
    return M.term_frequency(folded(t), F.split("key", " "))


@query("join04_block_pairs", _CTE + "SELECT a, b, shared FROM s")
def _(t):
    """Self-join on exploded keys, pairs once, with the number of keys they share."""
    return pairs(t).select("a", "b", F.col("shared").cast("long").alias("shared"))


@query("ext_members", _CTE + "SELECT doc_id, rep FROM m")
def _(t):
    """Extension: documents beside the one that stands for their folded text in the pairs."""
    return M.representatives(folded(t), "doc_id", F.md5("key")).select(F.col("id").alias("doc_id"), "rep")


@query("agg04_pair_overlap", _CTE + "SELECT a, b, overlap, score FROM s")
def _(t):
    return pairs(t).select("a", "b", "overlap", "score")


@query("flt04_pairable", _CTE + "SELECT a, b, score FROM s WHERE a_source <> b_source")
def _(t):
    """Pairs of different sources."""
    return pairs(t).where("a_source <> b_source").select("a", "b", "score")


@query("join05_pair_status", _CTE + f"SELECT a, b, CASE WHEN score >= {AUTO} THEN 'auto' ELSE 'pending' END AS status, CAST(row_number() OVER (ORDER BY score DESC, a, b) AS BIGINT) AS no FROM s")
def _(t):
    """Status by score, and the numbered list for review (WIN-05)."""
    p = pairs(t).select("a", "b", "score", F.when(F.col("score") >= AUTO, "auto").otherwise("pending").alias("status"))
    return numbered(p, [F.desc("score"), F.asc("a"), F.asc("b")], "no").select("a", "b", "status", "no")


@query("win01_top2_gap", _CTE + """, e AS (SELECT a, b, score, a AS e FROM s UNION ALL SELECT a, b, score, b FROM s),
r AS (SELECT *, row_number() OVER w AS n, lead(score) OVER w AS second FROM e WINDOW w AS (PARTITION BY e ORDER BY score DESC, a, b))
SELECT a, b, score, bool_and(n = 1 AND (second IS NULL OR score - second > 0.05)) AS clear FROM r GROUP BY a, b, score""")
def _(t):
    return M.demote_ambiguous(pairs(t).select("a", "b", "score"))


@query("win02_unique_value", "SELECT user_id, count(DISTINCT event_type) = 1 AS single FROM events GROUP BY user_id")
def _(t):
    return t("events").groupBy("user_id").agg((F.count_distinct("event_type") == 1).alias("single"))


_COMPONENTS = _CTE + f""", l AS (SELECT a, b FROM s WHERE score >= {AUTO} UNION SELECT b, a FROM s WHERE score >= {AUTO}),
g(doc_id, r) AS (SELECT doc_id, doc_id FROM w UNION SELECT l.a, g.r FROM g JOIN l ON l.b = g.doc_id),
k AS (SELECT doc_id, min(r) AS cluster_id FROM g GROUP BY doc_id),
c AS (SELECT m.doc_id, k.cluster_id FROM m JOIN k ON k.doc_id = m.rep)
"""


@query("cluster_components", _COMPONENTS + "SELECT doc_id, cluster_id FROM c")
def clusters(t):
    """Flagship: every document with its cluster (GRF-01): copies by their text, near copies by links."""
    s = sets(t)
    parts = connected_components(pairs(t, s).where(F.col("score") >= AUTO), "a", "b")
    return s.join(parts, F.col("rep") == F.col("node"), "left").select(F.col("id").alias("doc_id"), F.coalesce("component", "rep").alias("cluster_id"))


@query("grf02_constrained_clusters")
def _(t):
    """Greedy agglomeration of different texts: at most one of a source in a cluster, texts of different quality label apart."""
    s = sets(t)
    links = pairs(t, s).where(F.col("score") >= AUTO).select("a", "b", "score", F.lit(1).alias("priority"))
    marks = t("labels").select("doc_id", "quality")
    wall = M.with_sides(links.select("a", "b"), marks, "doc_id", ["quality"]).where("a_quality <> b_quality").select("a", "b")
    return M.constrained_clusters(s.where("id = rep").select("id", "source"), links, wall, exclusive="source")


@query("agg08_canonical_record", _COMPONENTS + "SELECT cluster_id, count(*) AS n_members, arg_min(c.doc_id, struct_pack(x := -n_chars, y := c.doc_id)) AS canonical, min(n_chars) AS shortest, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM c JOIN d ON d.doc_id = c.doc_id GROUP BY cluster_id")
def _(t):
    """The member that stands for a cluster: the longest, then the smallest id; anchor id is the smallest (AGG-08, AGG-10)."""
    d = clusters(t).join(t("documents").select("doc_id", "n_chars", "source"), "doc_id")
    return d.groupBy("cluster_id").agg(
        F.count("*").alias("n_members"), F.min_by("doc_id", F.struct((-F.col("n_chars")).alias("x"), "doc_id")).alias("canonical"),
        F.min("n_chars").alias("shortest"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"),
    )


@query("agg07_support_vote", """
WITH v AS (SELECT l_orderkey AS k, CAST(l_quantity AS BIGINT) AS y FROM lineitem), s AS (SELECT a.k, a.y, count(*) AS n FROM (SELECT DISTINCT k, y FROM v) a JOIN v b ON a.k = b.k AND abs(a.y - b.y) <= 1 GROUP BY a.k, a.y)
SELECT k, arg_max(y, struct_pack(n := n, y := -y)) AS voted, max(n) AS support FROM s GROUP BY k HAVING max(n) >= 2""")
def _(t):
    """The value with most support within one unit, from two on; ties go to the smaller."""
    v = t("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_quantity").cast("long").alias("y")).where("k IS NOT NULL AND y IS NOT NULL")
    # one dealing by key serves the counts, the window and the vote
    counts = v.repartition("k").groupBy("k", "y").agg(F.count("*").alias("c"))
    s = counts.select("k", "y", F.sum("c").over(Window.partitionBy("k").orderBy("y").rangeBetween(-1, 1)).alias("n"))
    best = s.groupBy("k").agg(F.max_by("y", F.struct("n", (-F.col("y")).alias("m"))).alias("voted"), F.max("n").alias("support"))
    return best.where("support >= 2")


@query("agg05_name_score", """
WITH p AS (SELECT c_custkey AS a, s_suppkey AS b, c_nationkey = s_nationkey AS place, c_acctbal AS x, s_acctbal AS y FROM customer JOIN supplier ON abs(c_acctbal - s_acctbal) <= 500)
SELECT a, b, CASE WHEN place THEN 1.0 ELSE 0.0 END + CASE WHEN abs(x - y) <= 100 THEN 2.0 WHEN abs(x - y) <= 300 THEN 1.0 WHEN abs(x - y) > 1000 THEN -4.0 WHEN abs(x - y) > 400 THEN -1.0 ELSE 0.0 END AS score FROM p""")
def _(t):
    """Score of attributes with steps by distance (AGG-05, AGG-06), of all pairs that are at most 500 apart, in one nation or in two.

    Customers in narrow bins meet suppliers in all bins in reach. Pairs are many more than rows, so tasks are as many as the rows ask
    for, and a number that is given is not merged again; a bin's customers are cut in slices, so that bins are no bound on the tasks.
    """
    c = t("customer").select(F.col("c_custkey").alias("a"), F.col("c_nationkey").alias("p"), F.col("c_acctbal").alias("x"))
    s = t("supplier").select(F.col("s_suppkey").alias("b"), F.col("s_nationkey").alias("q"), F.col("s_acctbal").alias("y"))
    n = max(int(c.sparkSession.conf.get("spark.sql.shuffle.partitions")), c.count() // SCORED)
    c = c.withColumn("bin", F.floor(F.col("x") / BIN)).withColumn("slice", F.pmod(F.xxhash64("a"), F.lit(SLICES)).cast("int")).repartition(n, "bin", "slice")
    s = s.withColumn("bin", F.explode(F.sequence(F.floor(F.col("y") / BIN) - 500 // BIN - 1, F.floor(F.col("y") / BIN) + 500 // BIN + 1)))
    s = s.withColumn("slice", F.explode(F.array(*map(F.lit, range(SLICES))))).repartition(n, "bin", "slice")
    far = F.abs(F.col("x") - F.col("y"))
    place = F.when(F.col("p") == F.col("q"), 1.0).otherwise(0.0)
    step = F.when(far <= 100, 2.0).when(far <= 300, 1.0).when(far > 1000, -4.0).when(far > 400, -1.0).otherwise(0.0)
    return c.join(s.hint("merge"), ["bin", "slice"]).where(far <= 500).select("a", "b", (place + step).alias("score"))


@query("agg03_best_variant", """
WITH v AS (SELECT l_orderkey AS k, l_linenumber AS n, length(l_returnflag || l_suppkey) AS len, l_quantity AS q FROM lineitem)
SELECT k, max(q) AS best, arg_max(n, struct_pack(q := q, n := -n)) AS variant FROM v GROUP BY k""")
def _(t):
    v = t("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("q"))
    return v.groupBy("k").agg(F.max("q").alias("best"), F.max_by("n", F.struct("q", (-F.col("n")).alias("m"))).alias("variant"))


@query("flt05_degenerate", "SELECT doc_id, len(list_distinct(string_split(text, ' '))) = 1 AS degenerate FROM documents")
def _(t):
    return t("documents").select("doc_id", (F.size(F.array_distinct(F.split("text", " "))) == 1).alias("degenerate"))


@query("set01_decisions", """
WITH e AS (SELECT user_id AS a, user_id + 1 AS b, event_type, event_id FROM events WHERE event_type IN ('click', 'purchase')),
l AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY event_id DESC) AS n FROM e)
SELECT a, b, CASE event_type WHEN 'click' THEN 'same' ELSE 'different' END AS decision FROM l WHERE n = 1""")
def decisions(t):
    """The log of decisions folded: the last one of each pair holds (SRC-13, SET-01)."""
    e = t("events").where(F.col("event_type").isin("click", "purchase")).select(F.col("user_id").alias("a"), (F.col("user_id") + 1).alias("b"), "event_type", "event_id")
    return M.last_wins(e, ["a", "b"], [F.col("event_id")]).select("a", "b", F.when(F.col("event_type") == "click", "same").otherwise("different").alias("decision"))


@query("set04_undecided", """
WITH e AS (SELECT DISTINCT user_id AS a, user_id + 1 AS b FROM events), k AS (SELECT DISTINCT user_id AS a, user_id + 1 AS b FROM events WHERE event_type IN ('click', 'purchase'))
SELECT a, b FROM e WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.a = e.a AND k.b = e.b)""")
def _(t):
    e = t("events").select(F.col("user_id").alias("a"), (F.col("user_id") + 1).alias("b")).distinct()
    return e.join(decisions(t), ["a", "b"], "left_anti")
