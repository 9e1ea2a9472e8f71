"""Queries on headings, dates in texts, footnotes, works, bundles and sets."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lexigraph.operators.sequences import numbered
from lexigraph.plans.registry import query


@query("str13_chain_words", "SELECT p_partkey, regexp_replace(p_name, '([a-z]) of ([a-z])', '\\1 o. \\2', 'g') AS value FROM part")
def _(t):
    """A word is shortened only inside a chain: not at the start and not at the end."""
    return t("part").select("p_partkey", F.regexp_replace("p_name", "([a-z]) of ([a-z])", "$1 o. $2").alias("value"))


@query("str14_tidy_heading", r"SELECT doc_id, h || CASE WHEN n_chars % 2 = 0 THEN ' [d. ' || n_chars || ']' ELSE '' END AS heading FROM (SELECT doc_id, n_chars, trim(regexp_replace(regexp_replace(text, '[\s]+', ' ', 'g'), '\s*,\s*', ', ', 'g'), ' .,:-') AS h FROM documents) x")
def _(t):
    """Tidied name with its death note (STR-14, STR-15)."""
    h = F.btrim(F.regexp_replace(F.regexp_replace("text", r"[\s]+", " "), r"\s*,\s*", ", "), F.lit(" .,:-"))
    return t("documents").select("doc_id", F.concat(h, F.when(F.col("n_chars") % 2 == 0, F.concat(F.lit(" [d. "), "n_chars", F.lit("]"))).otherwise("")).alias("heading"))


@query("str24_card_excerpt", "SELECT source, doc_id, left(text, 230) AS card FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY list_position(['en', 'de', 'fr', 'es'], lang), doc_id) AS n FROM documents WHERE n_chars >= 80 AND NOT starts_with(text, 'The')) x WHERE n = 1")
def _(t):
    """The card text of a source: the first in the order of languages that is long enough and no boilerplate."""
    rank = F.array_position(F.array(*map(F.lit, ["en", "de", "fr", "es"])), F.col("lang"))
    d = t("documents").where((F.col("n_chars") >= 80) & ~F.col("text").startswith("The"))
    return d.groupBy("source").agg(F.min_by(F.struct("doc_id", "text"), F.struct(rank.alias("r"), "doc_id")).alias("x")).select("source", "x.doc_id", F.substring("x.text", 1, 230).alias("card"))


@query("str35_citation_forms", r"SELECT l_orderkey, l_linenumber, regexp_replace(c, '^(\w) (\d+)/(\d+) no\. (\d+)$', '\1, vol. \2, p. \3, nr. \4') AS cite FROM (SELECT l_orderkey, l_linenumber, l_returnflag || ' ' || l_suppkey || '/' || l_partkey || ' no. ' || l_linenumber AS c FROM lineitem) x")
def _(t):
    """Citations of one form in another (STR-35, STR-37)."""
    c = F.concat("l_returnflag", F.lit(" "), "l_suppkey", F.lit("/"), "l_partkey", F.lit(" no. "), "l_linenumber")
    return t("lineitem").select("l_orderkey", "l_linenumber", F.regexp_replace(c, r"^(\w) (\d+)/(\d+) no\. (\d+)$", "$1, vol. $2, p. $3, nr. $4").alias("cite"))


_LIFE = "SELECT o_orderkey AS k, 'born in the year ' || (o_orderkey % 700) || ', aged ' || (o_orderkey % 90) || ', died in the year ' || (o_orderkey % 700 + o_orderkey % 140) || ' or so' AS x FROM orders"


@query("num02_life_dates", f"""
WITH l AS ({_LIFE}), y AS (SELECT k, CAST(regexp_extract(x, 'died in the year (\\d+)', 1) AS BIGINT) AS death, CAST(regexp_extract(x, 'born in the year (\\d+)', 1) AS BIGINT) AS born, CAST(regexp_extract(x, 'aged (\\d+)', 1) AS BIGINT) AS age FROM l)
SELECT k, death, CASE WHEN death - born > 0 AND death - born <= 120 THEN born WHEN age BETWEEN 15 AND 120 THEN death - age END AS birth FROM y""")
def _(t):
    """Death and birth years in a text; a birth that does not fit falls back to the age (NUM-02, NUM-03)."""
    k = F.col("o_orderkey")
    x = F.concat(F.lit("born in the year "), k % 700, F.lit(", aged "), k % 90, F.lit(", died in the year "), k % 700 + k % 140, F.lit(" or so"))
    d = t("orders").select(k.alias("k"), x.alias("x"))
    year = lambda p: F.nullif(F.regexp_extract("x", p, 1), F.lit("")).try_cast("bigint")
    d = d.select("k", year(r"died in the year (\d+)").alias("death"), year(r"born in the year (\d+)").alias("born"), year(r"aged (\d+)").alias("age"))
    span = F.col("death") - F.col("born")
    return d.select("k", "death", F.when((span > 0) & (span <= 120), F.col("born")).when(F.col("age").between(15, 120), F.col("death") - F.col("age")).alias("birth"))


@query("num14_paths", "SELECT user_id, 'M' || string_agg(CAST(n AS VARCHAR) || ' ' || CAST(event_id AS VARCHAR), 'L' ORDER BY n) AS d FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) x WHERE n % 2 = 1 GROUP BY user_id HAVING count(*) >= 3")
def _(t):
    """Every second point of a line as a path; lines of fewer than three are left out."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    d = t("events").select("user_id", "event_id", F.row_number().over(w).alias("n")).where("n % 2 = 1")
    g = d.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("n", "event_id"))).alias("p")).where(F.size("p") >= 3)
    return g.select("user_id", F.concat(F.lit("M"), F.array_join(F.transform("p", lambda x: F.concat_ws(" ", x["n"], x["event_id"])), "L")).alias("d"))


@query("ext18_heading_split", r"SELECT doc_id, array_to_string(list_slice(w, 1, least(16, coalesce(nullif(list_position(w, 'the'), 0) - 1, 16))), ' ') AS heading FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents) x")
def _(t):
    """A heading without a mark: the words before the first verb, sixteen at most."""
    w = F.split("text", " ")
    n = F.least(F.lit(16), F.coalesce(F.nullif(F.array_position(w, "the"), F.lit(0)) - 1, F.lit(16))).cast("int")
    return t("documents").select("doc_id", F.array_join(F.slice(w, F.lit(1), n), " ").alias("heading"))


@query("ext19_footnote_map", r"SELECT event_id, regexp_extract(n, '\((\d+)\) ([a-z]+)', 1) AS mark, regexp_extract(n, '\((\d+)\) ([a-z]+)', 2) AS note FROM (SELECT event_id, unnest(['(' || event_id % 9 || ') ' || event_type, '(' || (event_id % 9 + 1) || ') see above']) AS n FROM events) x")
def _(t):
    """Footnote blocks as maps from mark to note."""
    line = F.concat(F.lit("("), F.col("event_id") % 9, F.lit(") "), "event_type", F.lit("\n("), F.col("event_id") % 9 + 1, F.lit(") see above"))
    notes = F.map_from_entries(F.transform(F.split(line, "\n"), lambda x: F.struct(F.regexp_extract(x, r"\((\d+)\) ([a-z]+)", 1), F.regexp_extract(x, r"\((\d+)\) ([a-z]+)", 2))))
    return t("events").select("event_id", F.explode(notes).alias("mark", "note"))


@query("ext22_title_lines", r"SELECT doc_id, CAST(count(*) AS BIGINT) AS n, min(regexp_extract(l, '^([^.:]+)[.:]', 1)) AS first_title FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) x WHERE regexp_matches(l, '^[A-Z][^.:]{2,40}[.:]') GROUP BY doc_id")
def _(t):
    """Entries by title lines: a name up to the first stop or colon."""
    d = t("documents").select("doc_id", F.explode(F.split("text", "\n")).alias("l")).where(F.col("l").rlike("^[A-Z][^.:]{2,40}[.:]"))
    return d.groupBy("doc_id").agg(F.count("*").alias("n"), F.min(F.regexp_extract("l", "^([^.:]+)[.:]", 1)).alias("first_title"))


@query("join17_works_of_authors", "SELECT p_partkey AS work, s_suppkey AS author, s_nationkey AS place FROM part LEFT JOIN supplier ON s_suppkey = p_size")
def _(t):
    s = t("supplier").select(F.col("s_suppkey").alias("author"), F.col("s_nationkey").alias("place"))
    return t("part").join(s, F.col("p_size") == F.col("author"), "left").select(F.col("p_partkey").alias("work"), "author", "place")


@query("join25_person_page", """
SELECT c_custkey, n_name AS place, (SELECT count(DISTINCT o_orderpriority) FROM orders WHERE o_custkey = c_custkey) AS relations, (SELECT arg_max(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS last_cite FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""")
def _(t):
    """A person with place, distinct relations and the last citation of a kind (JOIN-22, JOIN-25)."""
    o = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count_distinct("o_orderpriority").alias("relations"), F.max_by(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")), F.when(F.col("o_orderstatus") == "F", F.struct("o_orderdate", "o_orderkey"))).alias("last_cite"))
    d = t("customer").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"), "left").join(o, "c_custkey", "left")
    return d.select("c_custkey", F.col("n_name").alias("place"), F.coalesce("relations", F.lit(0)).alias("relations"), "last_cite")


@query("set02_intersections", "SELECT a.p_partkey, len(list_intersect(string_split(a.p_name, ' '), string_split(a.p_type, ' '))) AS shared, array_to_string(list_sort(list_distinct(string_split(lower(a.p_type), ' '))), ',') AS kinds FROM part a")
def _(t):
    """Shared terms and the set of terms of a row (SET-02, SET-06)."""
    return t("part").select("p_partkey", F.size(F.array_intersect(F.split("p_name", " "), F.split("p_type", " "))).cast("long").alias("shared"), F.array_join(F.array_sort(F.array_distinct(F.split(F.lower("p_type"), " "))), ",").alias("kinds"))


@query("set05_difference", "SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 30")
def _(t):
    return t("part").select(F.col("p_partkey").alias("k")).subtract(t("lineitem").where("l_quantity > 30").select("l_partkey"))


@query("top07_by_name", "SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_name, c_custkey) AS BIGINT) AS no FROM customer")
def _(t):
    """People in the order of code points."""
    return numbered(t("customer").select("c_custkey", "c_name"), [F.col("c_name"), F.col("c_custkey")], "no").select("c_custkey", "no")


@query("snk07_network_review", "SELECT l_suppkey AS s, l_partkey AS p, bool_and(l_discount > 0.04) AS weak, count(*) AS n, count(*) OVER (PARTITION BY l_suppkey) AS seen FROM lineitem GROUP BY l_suppkey, l_partkey")
def _(t):
    """Edges for review, weak ones marked, with how often their start is seen."""
    e = t("lineitem").groupBy(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p")).agg(F.bool_and(F.col("l_discount") > 0.04).alias("weak"), F.count("*").alias("n"))
    return e.withColumn("seen", F.count("*").over(Window.partitionBy("s")))


@query("snk12_flat_coordinates", "SELECT n_nationkey AS k, array_to_string([CAST(n_nationkey * 700 AS BIGINT), CAST(n_nationkey * 1100 AS BIGINT)], ',') AS flat FROM nation")
def _(t):
    """Coordinates times 100 in one flat array."""
    k = F.col("n_nationkey").cast("long")
    pts = F.array(F.array(k * 7.0, k * 11.0))
    return t("nation").select(F.col("n_nationkey").alias("k"), F.array_join(F.flatten(F.transform(pts, lambda p: F.transform(p, lambda x: F.round(x * 100).cast("long")))), ",").alias("flat"))


@query("snk15_dossier_text", "SELECT o_custkey, string_agg(o_orderkey || ': ' || o_orderpriority, chr(10) ORDER BY o_orderkey) AS dossier FROM orders GROUP BY o_custkey")
def _(t):
    """The lines of a person's dossier in order."""
    g = t("orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("x"))
    return g.select("o_custkey", F.array_join(F.transform("x", lambda y: F.concat_ws(": ", y["o_orderkey"], y["o_orderpriority"])), "\n").alias("dossier"))


@query("grf06_previous_link", "SELECT conv_id, turn, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS previous, CASE WHEN role = 'user' THEN first_value(turn) OVER (PARTITION BY conv_id ORDER BY turn) END AS head FROM conversations")
def _(t):
    """Each link of a chain beside the one before it in its entry."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    return t("conversations").select("conv_id", "turn", F.lag("role").over(w).alias("previous"), F.when(F.col("role") == "user", F.first("turn").over(w)).alias("head"))
