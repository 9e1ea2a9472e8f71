"""The serving side: index rows, shards, search, facets, collections, bundles."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lexigraph.functions.text import fold_latin, quote
from lexigraph.operators.joins import nearest_vectors
from lexigraph.operators.sequences import numbered
from lexigraph.plans.registry import ORACLE_SQL, query
from lexigraph.sources.sinks import shard


@query("snk09_shards", "SELECT o_orderkey, CAST(o_orderkey % 64 AS BIGINT) AS shard FROM orders")
def _(t):
    """Shard number from the digits of an id."""
    return t("orders").select("o_orderkey", shard(F.concat(F.lit("p"), "o_orderkey")).alias("shard"))


@query("snk14_batches", "SELECT o_orderkey, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // 50 AS BIGINT) AS batch FROM orders")
def _(t):
    n = numbered(t("orders").select("o_orderkey", "o_orderstatus"), [F.col("o_orderkey")], "n", ("o_orderstatus",))
    return n.select("o_orderkey", F.floor((F.col("n") - 1) / 50).cast("long").alias("batch"))


@query("top01_search", "SELECT c_custkey, s FROM (SELECT c_custkey, count(o_orderkey) AS s FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE contains(lower(c_name), '1') GROUP BY c_custkey) x ORDER BY s DESC, c_custkey LIMIT 30")
def _(t):
    """People whose name holds the query, by weight, thirty."""
    c = t("customer").where(F.lower("c_name").contains("1"))
    return c.join(t("orders"), F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("s")).orderBy(F.desc("s"), "c_custkey").limit(30)


@query("top02_nulls_last", "SELECT c_custkey, CAST(row_number() OVER (ORDER BY y NULLS LAST, c_custkey) AS BIGINT) AS at FROM (SELECT c_custkey, min(o_totalprice) AS y FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P' GROUP BY c_custkey) x".replace("AS at", 'AS "at"'))
def _(t):
    j = t("customer").join(t("orders").where("o_orderstatus = 'P'"), F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("c_custkey").agg(F.min("o_totalprice").alias("y"))
    return numbered(j, [F.asc_nulls_last("y"), F.asc("c_custkey")], "at").select("c_custkey", "at")


@query("top03_page", "SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 36 OFFSET 36")
def _(t):
    return t("part").select("p_partkey", "p_name").orderBy("p_name", "p_partkey").offset(36).limit(36)


@query("top04_facet_places", "SELECT c_nationkey AS place, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) >= 5")
def _(t):
    return t("customer").groupBy(F.col("c_nationkey").alias("place")).agg(F.count("*").alias("n")).where("n >= 5")


@query("top05_mixed_search", "SELECT * FROM (SELECT 'place' AS kind, CAST(n_nationkey AS BIGINT) AS id FROM nation WHERE contains(n_name, 'A') ORDER BY n_name LIMIT 6) a UNION ALL SELECT * FROM (SELECT 'person', c_custkey FROM customer WHERE contains(c_name, '2') ORDER BY c_acctbal DESC, c_custkey LIMIT 8) b")
def _(t):
    a = t("nation").where(F.col("n_name").contains("A")).orderBy("n_name").limit(6).select(F.lit("place").alias("kind"), F.col("n_nationkey").cast("long").alias("id"))
    b = t("customer").where(F.col("c_name").contains("2")).orderBy(F.desc("c_acctbal"), "c_custkey").limit(8).select(F.lit("person").alias("kind"), F.col("c_custkey").alias("id"))
    return a.union(b)


@query("top06_edge_order", "SELECT s, t, n, CAST(row_number() OVER (ORDER BY n DESC, s, t) AS BIGINT) AS no FROM (SELECT l_suppkey AS s, l_partkey AS t, count(*) AS n FROM lineitem GROUP BY ALL) x QUALIFY no <= 100")
def _(t):
    e = t("lineitem").groupBy(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("t")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "s", "t").limit(100)
    return e.withColumn("no", F.row_number().over(Window.orderBy(F.desc("n"), "s", "t")).cast("long"))


@query("top08_truncated_evidence", "SELECT l_suppkey, array_to_string(list_slice(list(l_orderkey ORDER BY l_orderkey, l_linenumber), 1, 3), ',') AS evidence FROM lineitem GROUP BY l_suppkey")
def _(t):
    w = Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber")
    top = t("lineitem").withColumn("r", F.row_number().over(w)).where("r <= 3")
    g = top.groupBy("l_suppkey").agg(F.array_sort(F.collect_list(F.struct("r", "l_orderkey"))).alias("x"))
    return g.select("l_suppkey", F.array_join(F.transform("x", lambda y: y["l_orderkey"]), ",").alias("evidence"))


@query("top09_collection", "SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_suppkey = 3 GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 50")
def _(t):
    return t("lineitem").where("l_suppkey = 3").groupBy("l_partkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l_partkey").limit(50)


@query("top10_by_period", "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1995 AND o_orderstatus = 'O'")
def _(t):
    return t("orders").where((F.year("o_orderdate") == 1995) & (F.col("o_orderstatus") == "O")).select("o_orderkey", "o_orderdate")


@query("top11_ego_network", "SELECT l_partkey AS node, min(l_quantity) AS y FROM lineitem WHERE l_suppkey = 5 GROUP BY l_partkey ORDER BY l_partkey = 7 DESC, y, node LIMIT 60")
def _(t):
    """Neighbours of one node, a marked one first, sixty."""
    g = t("lineitem").where("l_suppkey = 5").groupBy(F.col("l_partkey").alias("node")).agg(F.min("l_quantity").alias("y"))
    return g.orderBy((F.col("node") == 7).desc(), "y", "node").limit(60)


@query("top12_node_search", "SELECT p_partkey, deg FROM (SELECT p_partkey, count(l_orderkey) AS deg FROM part LEFT JOIN lineitem ON l_partkey = p_partkey WHERE contains(p_name, 'a') GROUP BY p_partkey) x ORDER BY deg DESC, p_partkey LIMIT 12")
def _(t):
    j = t("part").where(F.col("p_name").contains("a")).join(t("lineitem"), F.col("l_partkey") == F.col("p_partkey"), "left")
    return j.groupBy("p_partkey").agg(F.count("l_orderkey").alias("deg")).orderBy(F.desc("deg"), "p_partkey").limit(12)


@query("top13_sorted_grid", "SELECT c_custkey, CAST(regexp_extract(c_name, '(\\d+)$', 1) AS BIGINT) AS nr FROM customer ORDER BY nr, c_custkey LIMIT 50 OFFSET 50")
def _(t):
    nr = F.regexp_extract("c_name", r"(\d+)$", 1).cast("long")
    return t("customer").select("c_custkey", nr.alias("nr")).orderBy("nr", "c_custkey").offset(50).limit(50)


@query("top14_by_kind_rank", "SELECT user_id, array_to_string(list_slice(list(event_type ORDER BY r, m), 1, 6), ',') AS kinds FROM (SELECT user_id, event_type, list_position(['signup', 'purchase', 'click', 'view', 'error'], event_type) AS r, min(event_id) AS m FROM events GROUP BY ALL) x GROUP BY user_id")
def _(t):
    rank = F.array_position(F.array(*map(F.lit, ["signup", "purchase", "click", "view", "error"])), F.col("event_type"))
    d = t("events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("m")).withColumn("r", rank)
    g = d.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("r", "m", "event_type"))).alias("x"))
    return g.select("user_id", F.array_join(F.transform(F.slice("x", 1, 6), lambda y: y["event_type"]), ",").alias("kinds"))


@query("srv_index_rows", "SELECT c_custkey AS id, c_name AS name, count(o_orderkey) AS n, min(year(o_orderdate)) AS born, c_nationkey AS place, c_custkey % 64 AS shard FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL")
def _(t):
    """The wide index row of each person (§1.1 index row, SNK-08)."""
    o = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.min(F.year("o_orderdate")).cast("long").alias("born"))
    c = t("customer").join(o, "c_custkey", "left")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.coalesce("n", F.lit(0)).alias("n"), "born", F.col("c_nationkey").alias("place"), (F.col("c_custkey") % 64).alias("shard"))


@query("snk04_review_bundle", "SELECT DISTINCT d.doc_id, left(text, 6000) AS text FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality = 0")
def _(t):
    """Only the entries that pending pairs name, texts cut for display."""
    used = t("labels").where("quality = 0").select("doc_id")
    return t("documents").join(used, "doc_id", "left_semi").select("doc_id", F.substring("text", 1, 6000).alias("text"))


@query("snk06_doubtful_report", "SELECT event_type AS reason, user_id, count(*) AS times FROM events GROUP BY event_type, user_id HAVING count(*) >= 2")
def _(t):
    """The lines of the report: a row for each reason and person."""
    return t("events").groupBy(F.col("event_type").alias("reason"), "user_id").agg(F.count("*").alias("times")).where("times >= 2")


@query("snk18_text_bundle", "SELECT q.doc_id, coalesce(f.text, q.value) AS text, q.doc_id % 64 AS shard FROM (" + ORACLE_SQL["str23_quote"] + ") q LEFT JOIN benchmark f ON f.item_id = q.doc_id")
def _(t):
    """Quotes of texts, whole fixes of a table of fixes laid over, beside their shard."""
    fixes = t("benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("fix"))
    return t("documents").join(fixes, "doc_id", "left").select("doc_id", F.coalesce("fix", quote(F.col("text"))).alias("text"), (F.col("doc_id") % 64).alias("shard"))


@query("ext_cosine_topk", "SELECT q.vec_id AS q, arg_max(b.vec_id, struct_pack(s := round(list_cosine_similarity(q.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6), v := -b.vec_id)) AS best FROM embeddings q JOIN embeddings b ON q.vec_id <> b.vec_id WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id")
def _(t):
    """Extension: for stated query vectors the nearest of all others."""
    return nearest_vectors(t("embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0, 1).select(F.col("query").alias("q"), F.col("id").alias("best"))


@query("top04_collated_words", r"SELECT lang, strip_accents(lower(word)) AS word, count(*) AS n, count(DISTINCT word) AS forms FROM (SELECT lang, unnest(regexp_extract_all(replace(text, 'ß', 'ss'), '\p{L}+')) AS word FROM documents) w GROUP BY ALL")
def _(t):
    """Words that are the same but for case and accents, by a collation: grouped, counted, and their forms counted (TOP-04, STR-03)."""
    w = t("documents").select("lang", F.explode(F.regexp_extract_all(F.replace("text", F.lit("ß"), F.lit("ss")), F.lit(r"\p{L}+"), F.lit(0))).alias("form"))
    forms = w.groupBy("lang", "form").agg(F.count("*").alias("n"))  # by bytes first, so that few rows are collated
    g = forms.groupBy("lang", F.collate("form", "UNICODE_CI_AI").alias("word")).agg(F.sum("n").alias("n"), F.count("*").alias("forms"), F.min("form").alias("one"))
    return g.select("lang", fold_latin(F.col("one")).alias("word"), "n", "forms")
