"""Transliterated names over the words of the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexigraph.functions import names_ar, names_tr
from lexigraph.functions.text import display_name, fold_arabic
from lexigraph.operators.names import first_name_counts, name_variants, with_name_parts
from lexigraph.operators import transliterate as R, works as W
from lexigraph.plans.registry import query

#: Letters for letters, so that the first words of a document are a name in another script; none of them makes an article.
LATIN, ARABIC = "abcdefghijklmnopqrstuvwxyz", "عبتدهفغحيجكلمنوثقرستطوشصعز"


#: Beginnings and inner phrases of titles that say how they are derived.
TITLE_KINDS = [("^(?:The|An?) ", "digest"), ("^[A-I][a-z]+ ", "commentary"), (" (?:of|in) (.+)$", "gloss")]


#: Characters in which the first words of a text are looked for before the whole text is.
HEAD = 500


def _stems(t, table, id_col, letters=4, first=None, keep=()):
    """The first letters of the words that have so many, beside the columns `keep`; `first`: of so many words at the beginning.

    Where the head of a text holds more words than those, they are the text's: only the last word of a head may go on after it.
    """
    found = lambda text: F.regexp_extract_all(F.lower(text), F.lit(f"[a-z]{{{letters},}}"), F.lit(0))
    words = found(F.col("text"))
    if first:
        head = found(F.substring("text", 1, HEAD))
        words = F.slice(F.when(F.size(head) > first, head).otherwise(words), 1, first)
    return t(table).select(id_col, F.transform(words, lambda w: F.substring(w, 1, letters)).alias("w"), *keep)


def lexicon(t):
    """Names out of the benchmark's even items and nisbas out of its odd ones; nisbas that begin with t are silent."""
    w = _stems(t, "benchmark", "item_id").select((F.col("item_id") % 2).alias("odd"), F.explode("w").alias("w")).distinct()
    value = F.concat(F.upper(F.substring("w", 1, 1)), F.substring("w", 2, 3))
    arabic = F.translate("w", LATIN, ARABIC)
    names = w.where("odd = 0").select(F.lit("ism").alias("kind"), arabic.alias("term"), value.alias("value"))
    nisbas = w.where("odd = 1").select(F.lit("nisba").alias("kind"), F.concat(arabic, F.lit("ي")).alias("term"), F.when(F.col("w").startswith("t"), "-").otherwise(F.concat(value, F.lit("î"))).alias("value"))
    return names.union(nisbas).groupBy("kind", "term").agg(F.min("value").alias("value"))


def documents(t):
    """A name for every document with four such words: w1 son of w2 son of the servant of w3, the w4-ite."""
    w = [F.translate(F.col("w")[k], LATIN, ARABIC) for k in range(4)]
    name = F.concat(w[0], F.lit(" بن "), w[1], F.lit(" بن عبد ال"), w[2], F.lit("، ال"), w[3], F.lit("ي"))
    return _stems(t, "documents", "doc_id", first=4).where("size(w) >= 4").select("doc_id", name.alias("name"))


def rendered(t):
    return R.transliterated(documents(t), "doc_id", "name", lexicon(t), names_tr)


_NAMES = f"""
b AS (SELECT DISTINCT item_id % 2 AS odd, substr(unnest(regexp_extract_all(lower(text), '[a-z]{{4,}}')), 1, 4) AS w FROM benchmark),
ism AS (SELECT translate(w, '{LATIN}', '{ARABIC}') AS term, min(upper(w[1]) || w[2:4]) AS v FROM b WHERE odd = 0 GROUP BY 1),
nis AS (SELECT translate(w, '{LATIN}', '{ARABIC}') || 'ي' AS term, min(CASE WHEN starts_with(w, 't') THEN '-' ELSE upper(w[1]) || w[2:4] || 'î' END) AS v FROM b WHERE odd = 1 GROUP BY 1),
d AS (SELECT doc_id, list_transform(list_transform(regexp_extract_all(lower(text), '[a-z]{{4,}}')[1:4], lambda x: x[1:4]), lambda x: translate(x, '{LATIN}', '{ARABIC}')) AS w FROM documents),
n AS (SELECT doc_id, w, i1.v AS a, i2.v AS b, i3.v AS c, nis.v AS z FROM d LEFT JOIN ism i1 ON i1.term = w[1] LEFT JOIN ism i2 ON i2.term = w[2] LEFT JOIN ism i3 ON i3.term = w[3] LEFT JOIN nis ON nis.term = w[4] || 'ي' WHERE len(w) = 4),
s AS (SELECT *, CASE WHEN contains('{names_tr.SUN}', w[3][1]) THEN translate(w[3][1], '{names_tr.SUN}', '{names_tr.SUN_TR}') ELSE 'l' END AS art, CASE WHEN contains('{names_tr.SUN}', w[4][1]) THEN translate(w[4][1], '{names_tr.SUN}', '{names_tr.SUN_TR}') ELSE 'l' END AS nart FROM n),
r AS (SELECT doc_id, w, a, b, c, z, a || coalesce(' b. ' || b || coalesce(' b. Abdi' || art || CASE WHEN c[1] = 'I' THEN 'ı' ELSE lower(c[1]) END || c[2:4], ''), '') AS chain, CASE WHEN z <> '-' THEN 'e' || nart || '-' || z END AS nisba FROM s)"""


@query("ext31_rendered_names", f"""WITH {_NAMES}, f AS (SELECT doc_id, a, b, nisba, concat_ws(' ', chain, nisba) AS full_name, chain FROM r),
u AS (SELECT *, CASE WHEN a IS NOT NULL AND nisba IS NOT NULL THEN a || ' ' || nisba WHEN a IS NOT NULL THEN concat_ws(' b. ', a, b) ELSE full_name END AS short_name FROM f),
x AS (SELECT doc_id, CASE WHEN contains(full_name, ' ') THEN full_name ELSE regexp_replace(full_name, '^e[lstşzdrn]-', '') END AS full_name, CASE WHEN contains(short_name, ' ') THEN short_name ELSE regexp_replace(short_name, '^e[lstşzdrn]-', '') END AS short_name FROM u)
SELECT doc_id, full_name, short_name FROM x""".replace("concat_ws(' b. ', a, b)", "CASE WHEN b IS NULL THEN a ELSE a || ' b. ' || b END"))
def _(t):
    """Full and short names with case, article and compound (EXT-29, EXT-31)."""
    return rendered(t).select(F.col("id").alias("doc_id"), F.col("full").alias("full_name"), F.col("short").alias("short_name"))


@query("agg18_missing_names", f"""WITH {_NAMES}, m AS (SELECT 'ism' AS kind, w[1] AS word FROM r WHERE a IS NULL UNION ALL SELECT 'ism', w[2] FROM r WHERE a IS NOT NULL AND b IS NULL
UNION ALL SELECT 'ism', w[3] FROM r WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NULL UNION ALL SELECT 'nisba', w[4] || 'ي' FROM r WHERE z IS NULL) SELECT kind, word, count(*) AS n FROM m GROUP BY ALL""")
def _(t):
    """Words that the lexicon lacks, counted as the names are made (AGG-18, SNK-10)."""
    return R.missing_words(rendered(t))


@query("ext01_parts_of_names", f"""WITH d AS (SELECT doc_id, list_transform(list_transform(regexp_extract_all(lower(text), '[a-z]{{4,}}')[1:4], lambda x: x[1:4]), lambda x: translate(x, '{LATIN}', '{ARABIC}')) AS w FROM documents)
SELECT doc_id, w[1] || '|' || w[2] || '|عبد ال' || w[3] AS chain, 'ال' || w[4] || 'ي' AS nisbas FROM d WHERE len(w) = 4""")
def _(t):
    """Chains and nisbas of names (EXT-01, EXT-02)."""
    p = with_name_parts(documents(t).select("doc_id", fold_arabic(F.col("name")).alias("name")), "name", names_ar)
    return p.select("doc_id", F.array_join("parts.chain", "|").alias("chain"), F.array_join("parts.nisbas", "|").alias("nisbas"))


@query("src11_first_names", f"""WITH d AS (SELECT list_transform(regexp_extract_all(lower(text), '[a-z]{{4,}}')[1:4], lambda x: x[1:4]) AS w FROM documents) SELECT translate(w[1], '{LATIN}', '{ARABIC}') AS first_name, count(*) AS n FROM d WHERE len(w) = 4 GROUP BY 1""")
def _(t):
    """In how many records a first name begins a chain (SRC-11)."""
    d = documents(t).select("doc_id", fold_arabic(F.col("name")).alias("name"))
    return first_name_counts(name_variants(d, "doc_id", ["name"], names_ar)).select(F.col("first").alias("first_name"), "n")


@query("str32_display_names", f"""WITH d AS (SELECT doc_id, list_transform(list_transform(regexp_extract_all(lower(text), '[a-z]{{4,}}')[1:5], lambda x: x[1:4]), lambda x: translate(x, '{LATIN}', '{ARABIC}')) AS w FROM documents)
SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN w[5] WHEN doc_id % 5 = 1 THEN 'أبو ' || w[5] || ' ال' || w[4] || 'ي' WHEN doc_id % 5 = 2 THEN 'نجم الدين ال' || w[4] || 'ي' WHEN doc_id % 5 = 3 THEN w[1] || ' ال' || w[4] || 'ي' ELSE w[1] || ' بن ' || w[2] END AS shown FROM d WHERE len(w) = 5""")
def _(t):
    """Display names of five kinds of names (STR-32)."""
    w = [F.translate(F.col("w")[k], LATIN, ARABIC) for k in range(5)]
    chain = F.concat(w[0], F.lit(" بن "), w[1])
    nisba = F.concat(F.lit("، ال"), w[3], F.lit("ي"))
    kind = F.col("doc_id") % 5
    name = F.when(kind == 0, F.concat(chain, nisba, F.lit("، المعروف ب"), w[4])).when(kind == 1, F.concat(chain, F.lit(" أبو "), w[4], nisba, F.lit(" الحنفي"))).when(kind == 2, F.concat(chain, nisba, F.lit("، الملقب نجم الدين"))).when(kind == 3, F.concat(chain, nisba)).otherwise(chain)
    return _stems(t, "documents", "doc_id", first=5).where("size(w) >= 5").select("doc_id", name.alias("name")).select("doc_id", display_name(F.col("name"), names_tr).alias("shown"))


@query("grf14_works_graph", """
WITH RECURSIVE d AS (SELECT doc_id, source, list_transform(regexp_extract_all(lower(text), '[a-z]{3,}')[1:9], lambda x: x[1:3]) AS w, regexp_extract(text, '^[^.]*', 0) AS t FROM documents),
p AS (SELECT doc_id AS ord, source AS author, list_distinct([w[1] || ' ' || w[2], w[3] || ' ' || w[4]] || CASE WHEN doc_id % 7 = 0 THEN [w[9]] ELSE [] END) AS names,
  CASE WHEN regexp_matches(t, '^(The|An?) .{2,}$') THEN 'digest' WHEN regexp_matches(t, '^[A-I][a-z]+ .{2,}$') THEN 'commentary' WHEN regexp_matches(t, ' (?:of|in) (.+)$') THEN 'gloss' END AS kind,
  CASE WHEN doc_id % 3 > 0 THEN w[6] || ' ' || w[7] || CASE WHEN doc_id % 2 = 0 THEN '' ELSE ' ' || w[8] END END AS base_name FROM d WHERE len(w) = 9),
n AS (SELECT DISTINCT ord, author, unnest(names) AS name FROM p),
e AS (SELECT DISTINCT a.ord AS x, b.ord AS y FROM n a JOIN n b ON a.author = b.author AND a.name = b.name),
g(ord, r) AS (SELECT ord, ord FROM p UNION SELECT e.x, g.r FROM g JOIN e ON e.y = g.ord),
c AS (SELECT ord, min(r) AS work FROM g GROUP BY ord),
f AS (SELECT n.name, min(c.work) AS base FROM n JOIN c ON c.ord = n.ord GROUP BY n.name),
w AS (SELECT c.work, any_value(p.author) AS author, max(p.kind) FILTER (WHERE p.ord = c.work) AS kind, string_agg(CAST(p.ord AS VARCHAR), ' ' ORDER BY p.ord) AS items, arg_min(p.base_name, p.ord) FILTER (WHERE p.base_name IS NOT NULL) AS b FROM p JOIN c ON c.ord = p.ord GROUP BY c.work),
k AS (SELECT work, list_filter(list_transform(range(1, len(string_split(b, ' '))), lambda i: array_to_string(string_split(b, ' ')[1:i], ' ')), lambda x: length(x) >= 3) AS starts FROM w WHERE b IS NOT NULL),
s AS (SELECT work, min(f.base) AS prefix FROM (SELECT work, unnest(starts) AS start FROM k) k2 JOIN f ON f.name = k2.start AND f.base <> k2.work GROUP BY work)
SELECT w.work, w.author, w.kind, w.items, coalesce(f.base, s.prefix) AS base FROM w LEFT JOIN f ON f.name = w.b AND f.base <> w.work LEFT JOIN s ON s.work = w.work""")
def _(t):
    """Documents as works of their sources: names joined by components, bases by whole names and by their beginnings (GRF-14, EXT-17)."""
    d = _stems(t, "documents", "doc_id", 3, 9, ("source", F.regexp_extract("text", "^[^.]*", 0).alias("t"))).where("size(w) >= 9")
    w = lambda *ks: F.array_join(F.array(*[F.col("w")[k - 1] for k in ks]), " ")
    kind, _rest = W.derived_title(F.col("t"), TITLE_KINDS)
    names = F.array_distinct(F.filter(F.array(w(1, 2), w(3, 4), F.when(F.col("doc_id") % 7 == 0, w(9))), lambda x: x.isNotNull()))
    base = F.when(F.col("doc_id") % 3 > 0, F.when(F.col("doc_id") % 2 == 0, w(6, 7)).otherwise(w(6, 7, 8)))
    items = d.select(F.col("doc_id").alias("ord"), F.col("source").alias("author"), names.alias("names"), kind.alias("kind"), base.alias("base_name"))
    return W.works_graph(items, least=3).withColumn("items", F.array_join(F.transform("items", lambda x: x.cast("string")), " "))
