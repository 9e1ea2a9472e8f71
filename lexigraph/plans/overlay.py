"""The edit log replayed over base data."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexigraph.operators import overlay as O
from lexigraph.plans.registry import query


_LOG = "l AS (SELECT user_id AS k, event_id, CASE event_type WHEN 'click' THEN 'c' || event_id WHEN 'error' THEN '-' ELSE '' END AS v FROM events)"


@query("stm01_fold_edits", f"WITH {_LOG} SELECT k, nullif(arg_max(v, event_id) FILTER (WHERE v <> ''), '-') AS v FROM l GROUP BY k")
def _(t):
    """Last non-empty value wins, a dash clears (STM-01, STM-04)."""
    v = F.when(F.col("event_type") == "click", F.concat(F.lit("c"), "event_id")).when(F.col("event_type") == "error", "-").otherwise("")
    return O.fold_edits(t("events").select(F.col("user_id").alias("k"), "event_id", v.alias("v")), ["k"], F.col("event_id"), ["v"])


@query("stm02_fold_relations", "WITH l AS (SELECT user_id AS a, CAST(json_extract_string(props, '$.k') AS BIGINT) AS b, event_id, CASE WHEN event_type = 'error' THEN 'del' ELSE 'add' END AS op FROM events), d AS (SELECT a, b, max(event_id) AS d FROM l WHERE op = 'del' GROUP BY a, b) SELECT l.a, l.b, count(*) AS n FROM l LEFT JOIN d USING (a, b) WHERE op = 'add' AND (d IS NULL OR event_id > d) GROUP BY ALL")
def _(t):
    e = t("events").select(F.col("user_id").alias("a"), F.get_json_object("props", "$.k").cast("long").alias("b"), "event_id", F.when(F.col("event_type") == "error", "del").otherwise("add").alias("op"))
    return O.fold_relations(e, ["a", "b"], "op", F.col("event_id")).select("a", "b", F.col("n").cast("long").alias("n"))


@query("stm03_works_overlay", "SELECT p_partkey AS k, CASE WHEN p_partkey % 10 = 3 THEN 'fixed' ELSE p_name END AS name FROM part WHERE p_partkey % 10 <> 0 UNION ALL SELECT -s_suppkey, s_name FROM (SELECT s_suppkey, 'added' AS s_name FROM supplier) x")
def _(t):
    """Deletions, fixes and additions over a table of works."""
    w = t("part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"))
    gone = w.where("k % 10 = 0").select("k")
    fixes = w.where("k % 10 = 3").select("k", F.lit("fixed").alias("name"))
    return O.apply_edits(w.join(gone, "k", "left_anti"), fixes, ["k"]).unionByName(t("supplier").select((-F.col("s_suppkey")).alias("k"), F.lit("added").alias("name")))


@query("stm05_validation", "SELECT event_id, array_to_string(list_filter([CASE WHEN NOT (value BETWEEN 1 AND 90) THEN 'value' END, CASE WHEN NOT (user_id % 3 <> 0) THEN 'user' END], lambda x: x IS NOT NULL), ',') AS broken FROM events WHERE NOT (value BETWEEN 1 AND 90) OR user_id % 3 = 0")
def _(t):
    """Rejected records with the rules they break (STM-05, FLT-19)."""
    _, bad = O.validated(t("events"), {"value": F.col("value").between(1, 90), "user": F.col("user_id") % 3 != 0})
    return bad.select("event_id", F.array_join("broken", ",").alias("broken"))


@query("stm06_changes", """
SELECT k, 'seg' AS field, a AS old, b AS new FROM (SELECT c_custkey AS k, c_mktsegment AS a, CASE WHEN c_custkey % 4 = 0 THEN 'NEW' ELSE c_mktsegment END AS b FROM customer WHERE c_custkey > 3) x WHERE a IS DISTINCT FROM b
UNION ALL SELECT c_custkey, 'seg', c_mktsegment, NULL FROM customer WHERE c_custkey <= 3""")
def _(t):
    """Change capture between two versions (STM-06, STM-07)."""
    old = t("customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"))
    new = old.where("k > 3").withColumn("seg", F.when(F.col("k") % 4 == 0, "NEW").otherwise(F.col("seg")))
    return O.changes(old, new, ["k"])


@query("snk19_apply_decisions", "SELECT kind, count(*) AS n, min(a) AS first FROM (SELECT user_id AS a, event_type AS kind, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) x WHERE r = 1 AND kind <> 'error' GROUP BY kind")
def _(t):
    """Choices of the interface as lists: the last one holds, an error deletes (SNK-19)."""
    last = t("events").groupBy(F.col("user_id").alias("a")).agg(F.max_by("event_type", "event_id").alias("kind"))
    return last.where("kind <> 'error'").groupBy("kind").agg(F.count("*").alias("n"), F.min("a").alias("first"))
