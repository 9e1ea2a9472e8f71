"""Lookup, range, prefix, substring, nearest and fallback joins, and the filters that go with them."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lexigraph.functions.numbers import haversine_km
from lexigraph.operators import joins as J
from lexigraph.plans.registry import query
from lexigraph.plans.scalars import _LAT, _LON, nation_points


@query("join01_overrides", "SELECT c_custkey, coalesce(s_acctbal, c_acctbal) AS acctbal, s_suppkey IS NOT NULL AS fixed FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey")
def _(t):
    """Left join with corrections by key, the correction wins (JOIN-01, SRC-21)."""
    over = t("supplier").select(F.col("s_suppkey").alias("c_custkey"), "s_acctbal", F.lit(True).alias("hit"))
    return t("customer").join(over, "c_custkey", "left").select("c_custkey", F.coalesce("s_acctbal", "c_acctbal").alias("acctbal"), F.coalesce("hit", F.lit(False)).alias("fixed"))


_SPANS = "SELECT s_suppkey AS ref, s_suppkey * 20 AS lo, s_suppkey * 20 + 35 AS hi FROM supplier"


@query("join02_equi_then_range", f"""
WITH p AS (SELECT p_partkey AS k FROM part), s AS ({_SPANS}), e AS (SELECT k, s_suppkey AS ref FROM p JOIN supplier ON k = s_suppkey)
SELECT k, ref, 'number' AS how FROM e UNION ALL SELECT k, s.ref, 'page' FROM p JOIN s ON k BETWEEN lo AND hi WHERE k NOT IN (SELECT k FROM e)""")
def _(t):
    """Citations by number; what has none, by the page range that holds it."""
    p = t("part").select(F.col("p_partkey").alias("k"))
    s = t("supplier").select(F.col("s_suppkey").alias("ref"), (F.col("s_suppkey") * 20).alias("lo"), (F.col("s_suppkey") * 20 + 35).alias("hi"))
    exact = p.join(s.select("ref", F.col("ref").alias("k")), "k").select("k", "ref", F.lit("number").alias("how"))
    rest = p.join(exact, "k", "left_anti")
    return exact.union(J.range_join(rest, s, "k", "lo", "hi", 64).select("k", "ref", F.lit("page").alias("how")))


@query("join03_best_target", "SELECT o_custkey, arg_max(o_orderkey, struct_pack(p := o_totalprice, k := -o_orderkey)) AS target, max(o_totalprice) AS price FROM orders GROUP BY o_custkey")
def _(t):
    best = J.first_of(t("orders"), ["o_custkey"], F.desc("o_totalprice"), F.asc("o_orderkey"))
    return best.select("o_custkey", F.col("o_orderkey").alias("target"), F.col("o_totalprice").alias("price"))


@query("join06_key_map", "SELECT o_orderkey, c_nationkey AS place FROM orders JOIN customer ON o_custkey = c_custkey")
def _(t):
    return t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_nationkey").alias("place"))


@query("join07_candidates", """
SELECT c_custkey AS m, s_suppkey AS c FROM customer JOIN supplier ON c_nationkey = s_nationkey AND floor(c_acctbal / 100) = floor(s_acctbal / 100) AND c_mktsegment = 'BUILDING'
UNION SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON floor(c_acctbal) = floor(s_acctbal) AND c_mktsegment <> 'BUILDING'
UNION SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_custkey = s_suppkey""")
def _(t):
    """Union of conditional index lookups (JOIN-07, SET-03)."""
    c, s = t("customer"), t("supplier")
    ways = [
        c.where("c_mktsegment = 'BUILDING'").join(s, (F.col("c_nationkey") == F.col("s_nationkey")) & (F.floor(F.col("c_acctbal") / 100) == F.floor(F.col("s_acctbal") / 100))),
        c.where("c_mktsegment <> 'BUILDING'").join(s, F.floor("c_acctbal") == F.floor("s_acctbal")),
        c.join(s, F.col("c_custkey") == F.col("s_suppkey")),
    ]
    ways = [w.select(F.col("c_custkey").alias("m"), F.col("s_suppkey").alias("c")) for w in ways]
    return ways[0].union(ways[1]).union(ways[2]).distinct()


@query("join08_alias_flags", """
WITH a AS (SELECT n_name AS name, n_nationkey AS k, CASE WHEN n_nationkey % 3 = 0 THEN 'near' ELSE 'plain' END AS flag FROM nation)
SELECT c_custkey, CASE WHEN flag = 'plain' OR c_acctbal >= 0 THEN k END AS hit FROM customer LEFT JOIN nation n ON n_nationkey = c_nationkey LEFT JOIN a ON a.name = n.n_name""")
def _(t):
    """Alias table with flags; a near alias needs its condition (SRC-20, JOIN-08)."""
    aliases = t("nation").select(F.concat_ws("@", "n_name", F.when(F.col("n_nationkey") % 3 == 0, "near").otherwise("plain"), "n_nationkey").alias("line"))
    parts = F.split("line", "@")
    a = aliases.select(parts[0].alias("n_name"), parts[1].alias("flag"), parts[2].cast("int").alias("k"))
    named = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "c_acctbal", "n_name")
    return named.join(a, "n_name", "left").select("c_custkey", F.when((F.col("flag") == "plain") | (F.col("c_acctbal") >= 0), F.col("k")).alias("hit"))


@query("join09_suffix_match", """
WITH w AS (SELECT p_partkey AS k, string_split(p_name, ' ') AS w FROM part), s AS (SELECT k, i, array_to_string(w[i:], ' ') AS key FROM (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM w) x),
d AS (SELECT DISTINCT w[len(w)] AS key FROM w)
SELECT k, min(i) AS at FROM s JOIN d USING (key) GROUP BY k""")
def _(t):
    """Exact match of ever shorter suffixes: the first that the index has."""
    w = t("part").select(F.col("p_partkey").alias("k"), F.split("p_name", " ").alias("w"))
    s = w.select("k", "w", F.posexplode("w").alias("p", "x")).select("k", (F.col("p") + 1).cast("long").alias("i"), F.array_join(F.slice("w", F.col("p") + 1, F.size("w")), " ").alias("key"))
    d = w.select(F.element_at("w", -1).alias("key")).distinct()
    return s.join(d, "key").groupBy("k").agg(F.min("i").alias("at"))


@query("join10_prefix", "SELECT p_partkey AS k, b.brand AS brand FROM part JOIN (SELECT DISTINCT left(p_type, 8) AS brand FROM part WHERE p_size < 10) b ON starts_with(p_type, b.brand)")
def _(t):
    """Prefix join by the first characters (JOIN-10, JOIN-17)."""
    p = t("part").select(F.col("p_partkey").alias("k"), "p_type")
    b = t("part").where("p_size < 10").select(F.substring("p_type", 1, 8).alias("brand")).distinct()
    short = b.where(F.length("brand") < 3)
    long = J.prefix_join(p, b, "p_type", "brand", 3)
    return long.select("k", "brand").union(p.join(short, p["p_type"].startswith(short["brand"])).select("k", "brand"))


@query("join11_unique_in_window", """
SELECT o_orderkey, min(l_partkey) AS part FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 30 DAY GROUP BY o_orderkey HAVING count(*) = 1""")
def _(t):
    """Equi-join with a date window; only unique hits."""
    j = t("orders").join(t("lineitem"), (F.col("l_orderkey") == F.col("o_orderkey")) & F.col("l_shipdate").between(F.col("o_orderdate"), F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")))
    return j.groupBy("o_orderkey").agg(F.min("l_partkey").alias("part"), F.count("*").alias("n")).where("n = 1").drop("n")


@query("join12_contained_text", "SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def _(t):
    """Which documents hold a benchmark text: joined on its rarest start, six words, then tested as a substring."""
    words = F.split("text", r"\s+")
    b = t("benchmark").select("item_id", F.col("text").alias("needle"), F.slice(words, 2, 4).alias("w"))
    long = b.where(F.size(F.split("needle", r"\s+")) >= 6).withColumn("gram", F.array_join("w", " "))
    d = t("documents").select("doc_id", "text", words.alias("w"))
    starts = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - 3)), lambda i: F.array_join(F.slice("w", i, 4), " "))
    grams = d.select("doc_id", F.explode(F.array_distinct(starts)).alias("gram"))
    met = grams.join(long.select("item_id", "gram"), "gram").select("doc_id", "item_id").distinct()
    hits = met.join(t("documents").select("doc_id", "text"), "doc_id").join(long.select("item_id", "needle"), "item_id")
    short = b.where(F.size(F.split("needle", r"\s+")) < 6)
    rest = t("documents").select("doc_id", "text").join(short.select("item_id", "needle"), F.col("text").contains(F.col("needle")))
    return hits.where(F.col("text").contains(F.col("needle"))).select("item_id", "doc_id").union(rest.select("item_id", "doc_id"))


@query("join13_chosen", "SELECT l_orderkey, l_linenumber, p_name AS chosen FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size < 5")
def _(t):
    chosen = t("part").where("p_size < 5").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("chosen"))
    return t("lineitem").join(chosen, "l_partkey", "left").select("l_orderkey", "l_linenumber", "chosen")


@query("join14_forbidden", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size = 1 + l_suppkey % 50) AND l_partkey <> l_suppkey")
def _(t):
    """Edges that no decision forbids, without self loops (JOIN-14, FLT-10)."""
    bad = t("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").cast("long").alias("s"))
    e = t("lineitem").withColumn("s", 1 + F.col("l_suppkey") % 50)
    return e.join(bad, ["l_partkey", "s"], "left_anti").where("l_partkey <> l_suppkey").select("l_orderkey", "l_partkey", "l_suppkey")


_KM = "12742 * asin(sqrt(pow(sin(radians(n.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(n.lat)) * pow(sin(radians(n.lon - p.lon) / 2), 2)))"


@query("join16_nearest", f"""
WITH p AS (SELECT c_custkey AS id, (c_custkey * 13 % 600) / 10.0 AS lon, 10 + (c_custkey * 29 % 400) / 10.0 AS lat FROM customer), n AS (SELECT CAST(n_nationkey AS BIGINT) AS node, CAST({_LON} AS DOUBLE) AS lon, CAST({_LAT} AS DOUBLE) AS lat FROM nation),
d AS (SELECT id, node, {_KM} AS km FROM p, n)
SELECT id, arg_min(node, struct_pack(km := km, node := node)) AS node, round(min(km), 3) AS km FROM d WHERE km <= 300 GROUP BY id""")
def _(t):
    """Nearest node within 300 km, looked for in neighbouring cells."""
    p = t("customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * 13 % 600 / 10.0).alias("x"), (10 + F.col("c_custkey") * 29 % 400 / 10.0).alias("y"))
    n = nation_points(t).select(F.col("k").alias("node"), F.col("lon").alias("nx"), F.col("lat").alias("ny"))
    near = J.nearest(p, n, "id", "node", haversine_km(F.col("x"), F.col("y"), F.col("nx"), F.col("ny")), cell=5.0, keep=300.0)
    return near.select("id", "node", F.round("km", 3).alias("km"))


@query("join18_notes", "SELECT n_name AS place, r_name AS region, count(s_suppkey) AS notes FROM nation LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL")
def _(t):
    s = t("supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("c"))
    return t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").join(s, "n_nationkey", "left").select(F.col("n_name").alias("place"), F.col("r_name").alias("region"), F.coalesce("c", F.lit(0)).alias("notes"))


@query("join19_upsert", """
SELECT s_suppkey AS k, s_nationkey AS nation, coalesce(CASE WHEN s_acctbal > 0 THEN s_acctbal END, c_acctbal) AS bal FROM supplier LEFT JOIN customer ON c_custkey = s_suppkey
UNION ALL SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""")
def _(t):
    """Facts of a second source: fill what is missing, append what is new."""
    base = t("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("nation"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("bal"))
    facts = t("customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("bal"))
    return J.upsert(base, facts, ["k"])


@query("join20_dossier", """
SELECT c_custkey, n_name AS place, coalesce(o.n, 0) AS n_orders, coalesce(o.total, 0) AS total, coalesce(o.last3, '') AS last3 FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN
(SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total, array_to_string(list_slice(list(o_orderkey ORDER BY o_orderdate DESC, o_orderkey), 1, 3), ',') AS last3 FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey""")
def _(t):
    """One row a person with its related rows nested (JOIN-20, JOIN-25)."""
    key = F.struct((-F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))).alias("t"), "o_orderkey")
    o = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.transform(F.slice(F.array_sort(F.collect_list(key)), 1, 3), lambda x: x["o_orderkey"]).alias("l"))
    d = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(o, "c_custkey", "left")
    return d.select("c_custkey", F.col("n_name").alias("place"), F.coalesce("n", F.lit(0)).alias("n_orders"), F.coalesce("total", F.lit(0.0)).alias("total"), F.coalesce(F.array_join("l", ","), F.lit("")).alias("last3"))


@query("join21_used_only", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%')")
def _(t):
    used = t("orders").where("o_orderpriority LIKE '1%'").select(F.col("o_custkey").alias("c_custkey"))
    return t("customer").join(used, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("join23_lookup", "SELECT p_partkey, coalesce(n_name, 'unknown') AS place FROM part LEFT JOIN nation ON p_size = n_nationkey")
def _(t):
    return t("part").join(t("nation"), F.col("p_size") == F.col("n_nationkey"), "left").select("p_partkey", F.coalesce("n_name", F.lit("unknown")).alias("place"))


@query("join24_fallback_keys", """
SELECT p_partkey, coalesce(a.n_name, b.n_name, c.n_name) AS note FROM part LEFT JOIN nation a ON a.n_nationkey = p_size LEFT JOIN nation b ON b.n_nationkey = p_size - 20 LEFT JOIN nation c ON c.n_nationkey = p_size - 30""")
def _(t):
    """Three keys in order, the first that hits."""
    keys = [F.col("p_size"), F.col("p_size") - 20, F.col("p_size") - 30]
    n = t("nation").select("n_nationkey", F.col("n_name").alias("note"))
    return J.fallback_join(t("part").select("p_partkey", "p_size"), n, "n_nationkey", keys, ["note"]).select("p_partkey", "note")


FILTERS = {
    "flt01_not_matching": ("documents", lambda: ~F.col("text").rlike("(?i)license"), "NOT regexp_matches(text, '(?i)license')"),
    "flt03_trusted": ("orders", lambda: F.concat("o_orderstatus", F.lit(":"), F.substring("o_orderpriority", 1, 1)).isin("F:1", "O:2", "P:5"), "(o_orderstatus, left(o_orderpriority, 1)) IN (('F', '1'), ('O', '2'), ('P', '5'))"),
    "flt14_facets": ("documents", lambda: F.lower("text").contains("the") & F.lower("text").contains("an") & F.col("n_chars").between(200, 2000) & (F.col("lang") == "en"), "contains(lower(text), 'the') AND contains(lower(text), 'an') AND n_chars BETWEEN 200 AND 2000 AND lang = 'en'"),
    "flt15_map_sets": ("orders", lambda: F.col("o_orderstatus").isin("F", "O") & (F.year("o_orderdate") % 2 == 0), "o_orderstatus IN ('F', 'O') AND year(o_orderdate) % 2 = 0"),
    "flt16_works": ("part", lambda: F.col("p_type").contains("BRASS") | ((F.col("p_size") > 40) & F.lower("p_name").contains("a")), "contains(p_type, 'BRASS') OR (p_size > 40 AND contains(lower(p_name), 'a'))"),
    "flt17_scope": ("part", lambda: F.col("p_retailprice").between(950, 1050), "p_retailprice BETWEEN 950 AND 1050"),
    "flt20_short_text": ("documents", lambda: F.length("text") < 30, "length(text) < 30"),
    "flt21_guard": ("part", lambda: (F.col("p_size") >= 41) | ((F.col("p_brand") == "Brand#11") & (F.col("p_partkey") < 100)), "p_size >= 41 OR (p_brand = 'Brand#11' AND p_partkey < 100)"),
    "flt22_grid": ("customer", lambda: (F.col("c_custkey") == 7) | F.lower("c_name").contains("1") & (F.col("c_nationkey").isNull() | F.col("c_nationkey").isin(1, 5, 9)), "c_custkey = 7 OR contains(lower(c_name), '1') AND (c_nationkey IS NULL OR c_nationkey IN (1, 5, 9))"),
}
_KEYS = {"documents": "doc_id", "orders": "o_orderkey", "part": "p_partkey", "customer": "c_custkey"}
for _name, (_table, _cond, _sql) in FILTERS.items():
    query(_name, f"SELECT {_KEYS[_table]} AS id FROM {_table} WHERE {_sql}")(lambda t, table=_table, cond=_cond: t(table).where(cond()).select(F.col(_KEYS[table]).alias("id")))


@query("flt02_secondary_flag", "SELECT o_orderkey, o_orderpriority LIKE '5%' OR (bool_or(o_orderstatus = 'P') OVER (PARTITION BY o_custkey) AND o_orderstatus <> 'P') AS secondary FROM orders")
def _(t):
    some = F.max(F.col("o_orderstatus") == "P").over(Window.partitionBy("o_custkey"))
    return t("orders").select("o_orderkey", (F.col("o_orderpriority").like("5%") | (some & (F.col("o_orderstatus") != "P"))).alias("secondary"))


@query("flt06_chronology", """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 45 THEN true ELSE date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) BETWEEN -40 AND 60 END AS chrono_ok,
CASE WHEN l_quantity > 45 THEN false ELSE date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) BETWEEN -5 AND 90 END AS near, CASE WHEN l_quantity > 45 THEN '?' WHEN date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) BETWEEN -5 AND 90 THEN 'near' ELSE 'far' END AS chron FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(t):
    """Windows of years where unknown counts as true, as false, or as its own state (FLT-06 to FLT-08)."""
    j = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    gap = F.when(F.col("l_quantity") <= 45, F.datediff("l_shipdate", "o_orderdate"))
    near = gap.between(-5, 90)
    return j.select("l_orderkey", "l_linenumber", F.coalesce(gap.between(-40, 60), F.lit(True)).alias("chrono_ok"), F.coalesce(near, F.lit(False)).alias("near"), F.when(near.isNull(), "?").when(near, "near").otherwise("far").alias("chron"))


@query("flt09_name_fits", "SELECT a.p_partkey AS a, b.p_partkey AS b, len(list_intersect(string_split(a.p_name, ' '), string_split(b.p_name, ' '))) > 0 AS fits, len(string_split(a.p_name, ' ')) > len(string_split(b.p_name, ' ')) AS longer FROM part a JOIN part b ON a.p_partkey + 1 = b.p_partkey")
def _(t):
    a = t("part").select(F.col("p_partkey").alias("a"), F.split("p_name", " ").alias("x"))
    b = t("part").select((F.col("p_partkey") - 1).alias("a"), F.col("p_partkey").alias("b"), F.split("p_name", " ").alias("y"))
    return a.join(b, "a").select("a", "b", F.arrays_overlap("x", "y").alias("fits"), (F.size("x") > F.size("y")).alias("longer"))


@query("flt12_all_sources_early", "SELECT o_custkey FROM orders GROUP BY o_custkey HAVING bool_and(o_orderstatus <> 'P') UNION SELECT c_custkey FROM customer WHERE c_custkey < 10")
def _(t):
    early = t("orders").groupBy("o_custkey").agg(F.bool_and(F.col("o_orderstatus") != "P").alias("all")).where("all").select("o_custkey")
    return early.union(t("customer").where("c_custkey < 10").select("c_custkey")).distinct()


@query("flt13_weak_edge", "SELECT l_suppkey, l_partkey, bool_and(l_discount > 0.04) AS weak FROM lineitem GROUP BY l_suppkey, l_partkey")
def _(t):
    e = t("lineitem").groupBy("l_suppkey", "l_partkey").agg(F.collect_list("l_discount").alias("evidence"))
    return e.select("l_suppkey", "l_partkey", F.forall("evidence", lambda x: x > 0.04).alias("weak"))


@query("flt11_membership", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5))")
def _(t):
    late = t("supplier").where("s_nationkey < 5").select(F.col("s_suppkey").alias("l_suppkey"), F.lit(True).alias("late"))
    return t("lineitem").join(late, "l_suppkey", "left").where(~((F.col("l_returnflag") == "R") & F.coalesce("late", F.lit(False)))).select("l_orderkey", "l_linenumber")


@query("flt18_status", "SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 50 = 0 THEN 'fixed' END, CASE WHEN o_totalprice > 200000 THEN 'in' WHEN o_orderstatus = 'P' THEN 'unclear' ELSE 'out' END) AS status FROM orders")
def _(t):
    override = F.when(F.col("o_orderkey") % 50 == 0, "fixed")
    return t("orders").select("o_orderkey", F.coalesce(override, F.when(F.col("o_totalprice") > 200000, "in").when(F.col("o_orderstatus") == "P", "unclear").otherwise("out")).alias("status"))


@query("flt19_valid_records", "SELECT event_id, user_id > 0 AND value BETWEEN 0 AND 1500 AND length(event_type) <= 8 AS valid FROM events")
def _(t):
    return t("events").select("event_id", ((F.col("user_id") > 0) & F.col("value").between(0, 1500) & (F.length("event_type") <= 8)).alias("valid"))


@query("flt23_effective_value", "SELECT c_custkey, coalesce(CASE WHEN c_custkey % 7 = 0 THEN 'draft' END, CASE WHEN c_custkey % 5 = 0 THEN 'fix' END, c_mktsegment) AS value FROM customer WHERE starts_with(coalesce(CASE WHEN c_custkey % 7 = 0 THEN 'draft' END, CASE WHEN c_custkey % 5 = 0 THEN 'fix' END, c_mktsegment), 'f') OR list_contains(string_split('draft;BUILDING', ';'), coalesce(CASE WHEN c_custkey % 7 = 0 THEN 'draft' END, CASE WHEN c_custkey % 5 = 0 THEN 'fix' END, c_mktsegment))")
def _(t):
    value = F.coalesce(F.when(F.col("c_custkey") % 7 == 0, "draft"), F.when(F.col("c_custkey") % 5 == 0, "fix"), F.col("c_mktsegment"))
    v = t("customer").select("c_custkey", value.alias("value"))
    return v.where(F.col("value").startswith("f") | F.array_contains(F.split(F.lit("draft;BUILDING"), ";"), F.col("value")))
