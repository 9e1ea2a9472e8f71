"""Queries over ordered rows: gaps, sections, sequences, packing, ranking."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lexigraph.operators import sequences as S
from lexigraph.plans.registry import query


@query("agg01_gaps", "SELECT l_suppkey AS k, n FROM (SELECT l_suppkey, unnest(range(min(l_partkey), max(l_partkey) + 1)) AS n FROM lineitem GROUP BY l_suppkey) x WHERE NOT EXISTS (SELECT 1 FROM lineitem y WHERE y.l_suppkey = x.l_suppkey AND y.l_partkey = n)")
def _(t):
    """Missing numbers of each series (AGG-01, SET-05)."""
    d = t("lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_partkey").alias("n"))
    return S.gaps(d, ["k"], "n").select("k", "n")


@query("agg09_duplicates", "SELECT l_partkey AS n, count(*) AS times FROM lineitem GROUP BY l_partkey HAVING count(*) > 1")
def _(t):
    return t("lineitem").groupBy(F.col("l_partkey").alias("n")).agg(F.count("*").alias("times")).where("times > 1")


@query("win09_consecutive_dedup", "SELECT user_id, event_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events) x WHERE b IS NULL OR b <> event_type")
def _(t):
    return S.consecutive_dedup(t("events"), ["user_id"], [F.col("ts"), F.col("event_id")], "event_type").select("user_id", "event_id", "event_type")


@query("win10_adjacent_pairs", "SELECT user_id, event_type AS a, b, count(*) AS n FROM (SELECT user_id, event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events) x WHERE b IS NOT NULL GROUP BY ALL")
def _(t):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = t("events").select("user_id", F.col("event_type").alias("a"), F.lead("event_type").over(w).alias("b")).where("b is not null")
    return e.groupBy("user_id", "a", "b").agg(F.count("*").alias("n"))


@query("ext21_sections", "SELECT conv_id, turn, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS section FROM conversations")
def _(t):
    """Entries from a stream of blocks: a running number of heads (EXT-21)."""
    return S.sections(t("conversations"), ["conv_id"], [F.col("turn")], F.col("role") == "user").select("conv_id", "turn", "section")


@query("ext21_entry_text", "SELECT conv_id, section, string_agg(text, chr(10) ORDER BY turn) AS body FROM (SELECT conv_id, turn, text, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS section FROM conversations) x GROUP BY conv_id, section")
def _(t):
    s = S.sections(t("conversations"), ["conv_id"], [F.col("turn")], F.col("role") == "user")
    g = s.groupBy("conv_id", "section").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("x"))
    return g.select("conv_id", "section", F.array_join(F.transform("x", lambda y: y["text"]), "\n").alias("body"))


@query("win13_carry_forward", "SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS since FROM events")
def _(t):
    return S.carry_forward(t("events"), ["user_id"], [F.col("ts"), F.col("event_id")], F.when(F.col("event_type") == "signup", F.col("event_id")), "since").select("event_id", "since")


@query("win08_lookback", "SELECT event_id, CASE WHEN ts - pts <= INTERVAL 2 HOUR THEN prev END AS prev FROM (SELECT event_id, ts, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER w AS prev, last_value(CASE WHEN event_type = 'view' THEN ts END IGNORE NULLS) OVER w AS pts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) x")
def _(t):
    """The last matching row before this one, within a reach."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.last(F.when(F.col("event_type") == "view", F.struct("event_id", "ts")), ignorenulls=True).over(w)
    return t("events").withColumn("p", seen).select("event_id", F.when(F.col("ts") - F.col("p.ts") <= F.expr("INTERVAL 2 HOURS"), F.col("p.event_id")).alias("prev"))


@query("ext23_fill_pending", """
WITH o AS (SELECT o_custkey AS k, o_orderkey AS pos, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS r FROM orders), n AS (SELECT k, pos, r, CASE WHEN pos % 3 = 0 THEN NULL ELSE r + CASE WHEN pos % 11 = 0 THEN 1 ELSE 0 END END AS number FROM o),
p AS (SELECT *, last_value(number IGNORE NULLS) OVER (PARTITION BY k ORDER BY pos) AS p, first_value(number IGNORE NULLS) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS q FROM n),
g AS (SELECT *, sum(CASE WHEN number IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY k, p, q) AS opn, row_number() OVER (PARTITION BY k, p, q ORDER BY pos) AS nth FROM p)
SELECT k, pos, CAST(coalesce(number, CASE WHEN q - p - 1 = opn THEN p + nth END) AS BIGINT) AS filled FROM g""")
def _(t):
    o = t("orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("pos"))
    o = o.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("pos")).cast("long"))
    o = o.withColumn("number", F.when(F.col("pos") % 3 != 0, F.col("r") + F.when(F.col("pos") % 11 == 0, 1).otherwise(0)))
    return S.fill_pending(o, ["k"], [F.col("pos")], "number").select("k", "pos", "filled")


@query("win07_running_number")
def _(t):
    d = t("lineitem").groupBy("l_suppkey", "l_orderkey").agg(F.collect_list("l_partkey").alias("numbers"))
    return S.running_numbers(d, ["l_suppkey"], "l_orderkey", "numbers").select("l_suppkey", "l_orderkey", "number")


@query("win11_lanes")
def _(t):
    e = t("events").select("event_id", "event_type", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("start"))
    e = e.withColumn("end", F.col("start") + (F.col("event_id") % 7 + 1) * 3600).withColumn("day", F.floor(F.col("start") / 86400))
    return S.lanes(e, ["event_type", "day"], "start", "end", "event_id").select("event_id", "lane")


@query("win12_columns", "SELECT o_orderkey, CAST((n - 1) // 42 AS BIGINT) AS col, CAST((n - 1) % 42 AS BIGINT) AS row FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) x")
def _(t):
    return S.columns(t("orders"), ["o_orderstatus"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 42).select("o_orderkey", "col", "row")


@query("win03_ranked_candidates", "SELECT l_orderkey, array_to_string(list_slice(list(l_partkey ORDER BY l_extendedprice DESC, l_partkey), 1, 5), ',') AS top5 FROM lineitem GROUP BY l_orderkey")
def _(t):
    key = F.struct((-F.col("l_extendedprice")).alias("p"), "l_partkey")
    return t("lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.slice(F.array_sort(F.collect_list(key)), 1, 5), lambda x: x["l_partkey"]), ",").alias("top5"))


@query("win04_accept", """
WITH r AS (SELECT l_orderkey, l_linenumber, l_quantity AS s, row_number() OVER w AS n, lead(l_quantity) OVER w AS second, count(*) OVER (PARTITION BY l_orderkey, l_quantity) AS same FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber))
SELECT l_orderkey, l_linenumber, CASE WHEN s >= 40 AND same = 1 AND (second IS NULL OR s - second >= 1) THEN 'resolved' WHEN s >= 20 AND (second IS NULL OR s - second >= 2) THEN 'weak' ELSE 'ambiguous' END AS status FROM r WHERE n = 1""")
def _(t):
    """Acceptance of the best candidate by score, gap and ties (WIN-04, GRF-05)."""
    w = Window.partitionBy("l_orderkey").orderBy(F.desc("l_quantity"), "l_linenumber")
    r = t("lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("s"), F.row_number().over(w).alias("n"), F.lead("l_quantity").over(w).alias("second"), F.count("*").over(Window.partitionBy("l_orderkey", "l_quantity")).alias("same"))
    lead = lambda k: F.col("second").isNull() | (F.col("s") - F.col("second") >= k)
    status = F.when((F.col("s") >= 40) & (F.col("same") == 1) & lead(1), "resolved").when((F.col("s") >= 20) & lead(2), "weak").otherwise("ambiguous")
    return r.where("n = 1").select("l_orderkey", "l_linenumber", status.alias("status"))


@query("win06_round_robin", "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY r, o_orderpriority) AS BIGINT) AS pick FROM (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) x ORDER BY r, o_orderpriority LIMIT 30")
def _(t):
    """One of each group in turn, thirty in all."""
    r = F.row_number().over(Window.partitionBy("o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    top = t("orders").select("o_orderkey", "o_orderpriority", r.alias("r")).where("r <= 30").orderBy("r", "o_orderpriority").limit(30)
    return top.select("o_orderkey", F.row_number().over(Window.orderBy("r", "o_orderpriority")).cast("long").alias("pick"))


@query("win14_main_kind", "SELECT user_id, arg_min(event_type, struct_pack(o := list_position(['purchase', 'signup', 'click', 'view', 'error'], event_type), e := event_id)) AS main FROM events GROUP BY user_id")
def _(t):
    order = F.array_position(F.array(*map(F.lit, ["purchase", "signup", "click", "view", "error"])), F.col("event_type"))
    return t("events").groupBy("user_id").agg(F.min_by("event_type", F.struct(order.alias("o"), "event_id")).alias("main"))


@query("ext_sliding_session", "SELECT user_id, count(*) AS n, min(event_id) AS first FROM (SELECT *, sum(CASE WHEN b IS NULL OR ts - b > INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events) x) y GROUP BY user_id, s")
def _(t):
    """Extension: sessions by gaps of six hours."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    before = F.lag("ts").over(w)
    e = t("events").withColumn("head", before.isNull() | (F.col("ts") - before > F.expr("INTERVAL 6 HOURS")))
    s = S.sections(e, ["user_id"], [F.col("ts"), F.col("event_id")], F.col("head"))
    return s.groupBy("user_id", "section").agg(F.count("*").alias("n"), F.min("event_id").alias("first")).drop("section")
