"""Aggregations: evidence, medians, votes, histograms, pivots, coverage."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lexigraph.plans.registry import query


@query("agg11_edge_evidence", "SELECT l_suppkey AS s, l_partkey AS p, count(*) AS n, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS rels, string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS books FROM lineitem GROUP BY l_suppkey, l_partkey")
def _(t):
    """Evidence of an edge folded (AGG-11, TOP-06)."""
    rels = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return t("lineitem").groupBy(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p")).agg(F.count("*").alias("n"), rels("l_returnflag").alias("rels"), rels("l_linestatus").alias("books"))


@query("agg12_upper_median", "SELECT o_custkey, x[len(x) // 2 + 1] AS guess FROM (SELECT o_custkey, list_sort(list(o_totalprice)) AS x FROM orders GROUP BY o_custkey) y")
def upper_median(t):
    """The element at half the length of the sorted guesses; neighbours are few, so they are one array."""
    g = t("orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_totalprice")).alias("x"))
    return g.select("o_custkey", F.get("x", F.floor(F.size("x") / 2).cast("int")).alias("guess"))


@query("agg13_outliers", "SELECT o_custkey, CASE WHEN len(x) >= 2 AND abs(x[len(x) // 2 + 1] - c_acctbal * 10) > 90000 THEN x[len(x) // 2 + 1] ELSE c_acctbal * 10 END AS repaired FROM (SELECT o_custkey, list_sort(list(o_totalprice)) AS x FROM orders GROUP BY o_custkey) y JOIN customer ON c_custkey = o_custkey")
def _(t):
    g = t("orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_totalprice")).alias("x"))
    g = g.select("o_custkey", F.size("x").alias("n"), F.get("x", F.floor(F.size("x") / 2).cast("int")).alias("m")).join(t("customer"), F.col("c_custkey") == F.col("o_custkey"))
    d = F.col("c_acctbal") * 10
    return g.select("o_custkey", F.when((F.col("n") >= 2) & (F.abs(F.col("m") - d) > 90000), F.col("m")).otherwise(d).alias("repaired"))


@query("agg14_status_counts", "SELECT event_type AS status, count(*) AS n FROM events GROUP BY event_type")
def _(t):
    return t("events").groupBy(F.col("event_type").alias("status")).agg(F.count("*").alias("n"))


@query("agg15_reverse_edges", """
WITH e AS (SELECT s, t, count(*) AS n FROM (SELECT l_suppkey AS s, l_partkey AS t FROM lineitem) x WHERE s <> t GROUP BY s, t)
SELECT e.s, e.t, e.n FROM e LEFT JOIN e r ON r.s = e.t AND r.t = e.s WHERE r.n IS NULL OR e.n > r.n OR (e.n = r.n AND e.s < e.t)""")
def _(t):
    """Of two opposite edges the one with more evidence stays."""
    e = t("lineitem").select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("t")).where("s <> t")
    # both directions of an edge meet in one aggregation
    n = e.groupBy(F.least("s", "t").alias("lo"), F.greatest("s", "t").alias("hi")).agg(F.count_if(F.col("s") < F.col("t")).alias("up"), F.count_if(F.col("s") > F.col("t")).alias("down"))
    up = F.col("up") >= F.col("down")
    return n.select(F.when(up, F.col("lo")).otherwise(F.col("hi")).alias("s"), F.when(up, F.col("hi")).otherwise(F.col("lo")).alias("t"), F.greatest("up", "down").alias("n"))


@query("agg16_place_usage", """
WITH j AS (SELECT c_nationkey AS place, c_custkey, o_orderstatus AS k FROM customer JOIN orders ON o_custkey = c_custkey), h AS (SELECT place, k, count(*) AS n FROM j GROUP BY place, k)
SELECT place, (SELECT count(DISTINCT c_custkey) FROM j WHERE j.place = h.place) AS people, string_agg(k || '=' || n, ',' ORDER BY k) AS kinds FROM h GROUP BY place""")
def _(t):
    """Distinct people and a histogram of kinds for each place (AGG-16, AGG-23)."""
    j = t("customer").join(t("orders"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("place"), "c_custkey", F.col("o_orderstatus").alias("k"))
    h = j.groupBy("place", "k").agg(F.count("*").alias("n")).groupBy("place").agg(F.array_sort(F.collect_list(F.concat_ws("=", "k", "n"))).alias("h"))
    return j.groupBy("place").agg(F.count_distinct("c_custkey").alias("people")).join(h, "place").select("place", "people", F.array_join("h", ",").alias("kinds"))


@query("agg17_first_of_kind", "SELECT o_custkey, o_orderstatus, min(o_orderkey) AS first FROM orders GROUP BY ALL")
def _(t):
    w = Window.partitionBy("o_custkey", "o_orderstatus").orderBy("o_orderkey")
    return t("orders").withColumn("n", F.row_number().over(w)).where("n = 1").select("o_custkey", "o_orderstatus", F.col("o_orderkey").alias("first"))


@query("agg18_unknown_tokens", "SELECT lang, w AS token, count(*) AS n FROM (SELECT lang, unnest(regexp_extract_all(text, '[A-Z][a-z]+')) AS w FROM documents) x WHERE length(w) >= 12 GROUP BY ALL")
def _(t):
    """Frequency of tokens that a dictionary lacks, by category (AGG-18, SNK-10)."""
    w = t("documents").select("lang", F.explode(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0))).alias("token")).where(F.length("token") >= 12)
    return w.groupBy("lang", "token").agg(F.count("*").alias("n"))


@query("agg19_degrees", "SELECT k, sum(i) AS n_in, sum(o) AS n_out, sum(i + o) AS deg FROM (SELECT l_suppkey AS k, 0 AS i, 1 AS o FROM lineitem UNION ALL SELECT l_partkey, 1, 0 FROM lineitem) x GROUP BY k")
def _(t):
    e = t("lineitem")
    ends = e.select(F.col("l_suppkey").alias("k"), F.lit(0).alias("i"), F.lit(1).alias("o")).union(e.select("l_partkey", F.lit(1), F.lit(0)))
    return ends.groupBy("k").agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"), F.sum(F.col("i") + F.col("o")).alias("deg"))


@query("agg20_book_summary", "SELECT source, count(*) AS entries, max(n_chars) AS longest FROM documents GROUP BY source")
def _(t):
    return t("documents").groupBy("source").agg(F.count("*").alias("entries"), F.max("n_chars").alias("longest"))


@query("agg21_pivot", "SELECT p_brand, count(*) FILTER (WHERE p_size % 3 = 0) AS k0, count(*) FILTER (WHERE p_size % 3 = 1) AS k1, count(*) FILTER (WHERE p_size % 3 = 2) AS k2 FROM part GROUP BY p_brand")
def _(t):
    """Bucket by kind as a pivot over stated kinds."""
    p = t("part").withColumn("kind", F.concat(F.lit("k"), (F.col("p_size") % 3).cast("string"))).groupBy("p_brand").pivot("kind", ["k0", "k1", "k2"]).count()
    return p.na.fill(0)


@query("agg22_century_counts", "SELECT CAST(floor((year(o_orderdate) - 1) / 100) + 1 AS BIGINT) AS century, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return t("orders").groupBy((F.floor((F.year("o_orderdate") - 1) / 100) + 1).cast("long").alias("century")).agg(F.count("*").alias("n"))


@query("agg24_families", "SELECT p_brand, n, CAST(row_number() OVER (ORDER BY first, p_brand) AS BIGINT) AS at FROM (SELECT p_brand, count(*) AS n, min(p_partkey) AS first FROM part GROUP BY p_brand HAVING count(*) >= 3 ORDER BY count(*) DESC, p_brand LIMIT 22) x")
def _(t):
    """The largest families, shown in the order of their first member."""
    g = t("part").groupBy("p_brand").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first")).where("n >= 3").orderBy(F.desc("n"), "p_brand").limit(22)
    return g.select("p_brand", "n", F.row_number().over(Window.orderBy("first", "p_brand")).cast("long").alias("at"))


@query("agg25_consensus", "SELECT k, arg_max(q, struct_pack(n := n, q := -q)) AS agreed, string_agg(CAST(q AS VARCHAR), ',' ORDER BY q) AS values FROM (SELECT l_orderkey AS k, CAST(l_quantity AS BIGINT) AS q, count(*) AS n FROM lineitem GROUP BY ALL) x GROUP BY k HAVING count(*) > 1")
def _(t):
    """Most frequent value (ties: the smaller) and the list of those that conflict."""
    c = t("lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_quantity").cast("long").alias("q")).agg(F.count("*").alias("n"))
    g = c.groupBy("k").agg(F.max_by("q", F.struct("n", (-F.col("q")).alias("m"))).alias("agreed"), F.array_sort(F.collect_list("q")).alias("v"))
    return g.where(F.size("v") > 1).select("k", "agreed", F.array_join("v", ",").alias("values"))


@query("agg26_region_tiers", "SELECT c_custkey, coalesce(max(CASE WHEN o_orderstatus = 'F' THEN 'home' END), max(CASE WHEN o_orderstatus = 'O' THEN 'birth' END), max(CASE WHEN o_orderstatus = 'P' THEN 'travel' END), 'name') AS tier, CASE WHEN count(DISTINCT o_orderstatus) > 1 THEN 'moved' ELSE 'stayed' END AS migration FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def _(t):
    j = t("customer").join(t("orders"), F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("c_custkey")
    has = lambda s, name: F.max(F.when(F.col("o_orderstatus") == s, name))
    return j.agg(F.coalesce(has("F", "home"), has("O", "birth"), has("P", "travel"), F.lit("name")).alias("tier"), F.when(F.count_distinct("o_orderstatus") > 1, "moved").otherwise("stayed").alias("migration"))


@query("agg27_counters", "SELECT o_custkey, string_agg(k || ' ' || n, ', ' ORDER BY n DESC, k) AS forms FROM (SELECT o_custkey, o_orderpriority AS k, count(*) AS n FROM orders GROUP BY ALL) x GROUP BY o_custkey")
def _(t):
    c = t("orders").groupBy("o_custkey", F.col("o_orderpriority").alias("k")).agg(F.count("*").alias("n"))
    g = c.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "k", "n"))).alias("x"))
    return g.select("o_custkey", F.array_join(F.transform("x", lambda x: F.concat_ws(" ", x["k"], x["n"])), ", ").alias("forms"))


@query("agg28_count_deltas", "SELECT user_id, greatest(0, sum(CASE event_type WHEN 'signup' THEN 1 WHEN 'error' THEN -1 ELSE 0 END)) AS n FROM events GROUP BY user_id")
def _(t):
    d = F.sum(F.when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "error", -1).otherwise(0))
    return t("events").groupBy("user_id").agg(F.greatest(F.lit(0).cast("long"), d).alias("n"))


@query("agg29_text_frequency", "SELECT doc_id, count(*) OVER (PARTITION BY text) AS n FROM documents")
def _(t):
    """How often a document's whole text is found (null texts are one text); hashes of the texts are counted, and the counts joined back."""
    d = t("documents").select("doc_id", F.sha2("text", 256).alias("text"))
    counts = d.groupBy(F.col("text").alias("of")).agg(F.count("*").alias("n"))
    return d.join(counts, F.col("text").eqNullSafe(F.col("of"))).select("doc_id", "n")


@query("agg30_featured", "SELECT c_custkey, s FROM (SELECT c_custkey, 3 * count(DISTINCT o_orderstatus) + count(o_orderkey) AS s FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_mktsegment <> '' GROUP BY c_custkey) x ORDER BY s DESC, c_custkey LIMIT 18")
def _(t):
    """The eighteen people with the highest score (AGG-30)."""
    j = t("customer").where("c_mktsegment <> ''").join(t("orders"), F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("c_custkey").agg((3 * F.count_distinct("o_orderstatus") + F.count("o_orderkey")).alias("s")).orderBy(F.desc("s"), "c_custkey").limit(18)


@query("snk13_coverage", "SELECT count(*) AS n, count(nullif(c_mktsegment, '')) AS segment, count(CASE WHEN c_acctbal > 0 THEN 1 END) AS positive FROM customer")
def _(t):
    return t("customer").agg(F.count("*").alias("n"), F.count(F.nullif("c_mktsegment", F.lit(""))).alias("segment"), F.count_if(F.col("c_acctbal") > 0).alias("positive"))


@query("ext_rollup", "SELECT o_orderstatus AS a, o_orderpriority AS b, count(*) AS n, CAST(grouping_id(o_orderstatus, o_orderpriority) AS BIGINT) AS g FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def _(t):
    return t("orders").rollup(F.col("o_orderstatus").alias("a"), F.col("o_orderpriority").alias("b")).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))


@query("ext_cube", "SELECT o_orderstatus AS a, o_orderpriority AS b, count(*) AS n, CAST(grouping_id(o_orderstatus, o_orderpriority) AS BIGINT) AS g FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def _(t):
    return t("orders").cube(F.col("o_orderstatus").alias("a"), F.col("o_orderpriority").alias("b")).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
