"""Scalar functions over documents, pages and keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexigraph.functions import numbers as N, text as X
from lexigraph.plans.registry import query

_WS = r"[\s  -  　]+"


def _sq(e: str) -> str:
    return f"trim(regexp_replace({e}, '{_WS}', ' ', 'g'))"


def _q(s: str) -> str:
    return s.replace("'", "''")


_FOLD = _sq(f"translate(regexp_replace(text, '[{X.MARKS}ـ]', '', 'g'), '{X.ALEF_FROM}', '{X.ALEF_TO}')")
_LATIN = f"translate(lower(text), '{X.LATIN_FROM}{_q(X.QUOTES)}', '{X.LATIN_TO}')"
_AR_WORDS = f"list_filter(string_split({_sq(f'''regexp_replace(translate(regexp_replace(text, '[{X.SHORT_VOWELS}]', '', 'g'), '{X.TITLE_FROM}', '{X.TITLE_TO}'), '[^ء-ي]', ' ', 'g')''')}, ' '), lambda w: w <> '' AND w NOT IN {X.TITLE_STOP_AR})"
_AR_KEY = f"array_to_string(list_transform({_AR_WORDS}, lambda w: CASE WHEN starts_with(w, 'ال') AND length(w) > 3 THEN substr(w, 3) ELSE w END), ' ')"
_TR_BARE = f"regexp_replace(regexp_replace({_LATIN}, '\\b(e[lsntdrz]|es|et)-', '', 'g'), '([a-z])[lstdrzn]-', '\\1 ', 'g')"
_TR_WORDS = f"list_filter(string_split({_sq(f'''regexp_replace({_TR_BARE}, '[^a-z]', ' ', 'g')''')}, ' '), lambda w: w <> '' AND w NOT IN {X.TITLE_STOP_LATIN})"
_TR_KEY = f"array_to_string(list_transform({_TR_WORDS}, lambda w: CASE WHEN length(w) > 3 THEN regexp_replace(w, '[iue]$', '') ELSE w END), ' ')"
_SPACED = "trim(regexp_replace(regexp_replace(regexp_replace(text, '[ \t ]+', ' ', 'g'), ' +([،,.:;؛؟?!)\\]»])', '\\1', 'g'), '([(\\[«]) +', '\\1', 'g'))"

_LEAD = r"trim(substr(regexp_extract(trim(text), '^[^.:\n]*', 0), 1, 160))"
_KNOWN_AS = r"(?:known as|el-ma''rûf bi|المعروف ب)\s*([^,،]+)"

#: name -> (Column function of the text, the same in SQL)
TEXT_QUERIES = {
    "str01_fold_arabic": (X.fold_arabic, _FOLD),
    "str02_fold_client": (X.fold_arabic_only, _sq(r"regexp_replace(translate(regexp_replace(text, '[ً-ٰٟۖ-ۭـ]', '', 'g'), 'أإآٱىئؤة', 'ااااييوه'), '[^؀-ۿ\s]', ' ', 'g')")),
    "str03_fold_latin": (X.fold_latin, _sq(f"regexp_replace({_LATIN}, '[^a-z0-9]', ' ', 'g')")),
    "str04_title_key_arabic": (X.title_key_arabic, _AR_KEY),
    "str05_title_key_latin": (X.title_key_latin, _TR_KEY),
    "str06_title_key": (X.title_key, f"CASE WHEN regexp_matches(text, '[؀-ۿ]') THEN 'ar:' || {_AR_KEY} ELSE 'tr:' || {_TR_KEY} END"),
    "str07_place_key": (X.place_key, _sq(rf"regexp_replace({_FOLD}, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')")),
    "str08_place_info_key": (X.place_info_key, _FOLD.replace("(text,", r"(regexp_replace(text, '[^\p{L}\p{N}_\s]', ' ', 'g'),")),
    "str09_strip_marks": (X.strip_marks, f"regexp_replace(text, '[{X.MARKS}]', '', 'g')"),
    "str10_heading_name": (X.heading_name, "trim(" + _sq(r"regexp_replace(regexp_replace(regexp_replace(replace(text, chr(10), ' '), '^\s*/?\s*(\[[٠-٩0-9]+\]\s*)?(\[?[٠-٩0-9]+\s*[-–.]\s*)?', ''), '[«»()\[\]]', '', 'g'), '\s*(رحمه الله( تعالى)?|رضي الله عنه|عليه السلام)\s*', ' ', 'g')") + ", ' .،:-')"),
    "str11_lead_name": (X.lead_name, r"trim(substr(regexp_extract(trim(text), '^[^.:\n]*', 0), 1, 160))"),
    "str18_spacing": (X.spacing, _SPACED),
    "str23_quote": (lambda c: X.quote(c, 320), "CASE WHEN length(t) <= 320 THEN t WHEN e <> '' THEN e || ' …' ELSE rtrim(regexp_extract(substr(t, 1, 320), '(?s)^(.*) ', 1)) || ' …' END"),
    "str28_article_off": (X.article_off, "CASE WHEN starts_with(text, 'ال') AND length(text) > 4 THEN substr(text, 3) ELSE text END"),
    "str36_digits_eastern": (X.digits_eastern, f"translate(text, '{X.WESTERN}', '{X.EASTERN}')"),
    "str38_snippet": (lambda c: X.snippet(c, F.instr(c, ".")), "substr(text, greatest(1, instr(text, '.') - 40), instr(text, '.') + 140 - greatest(1, instr(text, '.') - 40))"),
    "str32_short_name": (lambda c: X.short_name(X.lead_name(c)), f"CASE WHEN regexp_extract({_LEAD}, '{_KNOWN_AS}', 1) <> '' THEN trim(regexp_extract({_LEAD}, '{_KNOWN_AS}', 1)) WHEN len(string_split({_sq(_LEAD)}, ' ')) <= 2 THEN {_sq(_LEAD)} ELSE string_split({_sq(_LEAD)}, ' ')[1] || ' ' || string_split({_sq(_LEAD)}, ' ')[-1] END"),
}
_QUOTE_FROM = f"""(SELECT doc_id, t, regexp_extract(substr(t, 1, 321), '(?s)^(.{{105,319}}[{X.STOPS}])\\s', 1) AS e FROM
 (SELECT doc_id, {_sq("regexp_replace(string_split(text, '<hr>')[1], '\\[\\^\\w+\\]|<[^>]+>', ' ', 'g')")} AS t FROM documents) a) b"""

for _name, (_f, _sql) in TEXT_QUERIES.items():
    query(_name, _sql and f"SELECT doc_id, {_sql} AS value FROM {_QUOTE_FROM if _name == 'str23_quote' else 'documents'}")(lambda t, f=_f: t("documents").select("doc_id", f(F.col("text")).alias("value")))


@query("str19_network_text", f"SELECT doc_id, regexp_replace({_FOLD}, '{X.SEE_BELOW}\\s*XREF(\\d+)', ' XREF\\2\\1', 'g') AS value FROM (SELECT doc_id, regexp_replace(replace(replace(string_split(t, '<hr>')[1], '[^1]', ' XREF1 '), '[^3]', ' XREF3 '), '{X.NOTE_MARKS}', ' ', 'g') AS text FROM (SELECT doc_id, 'اخذ عن زيد، وياتي [^1] (٢) <b>' || text || '</b> [^2] سياتي ذكره [^3]<hr>note' AS t FROM documents) a) b")
def _(t):
    """Footnotes 1 and 3 are known, 2 is not."""
    text = F.concat(F.lit("اخذ عن زيد، وياتي [^1] (٢) <b>"), "text", F.lit("</b> [^2] سياتي ذكره [^3]<hr>note"))
    return t("documents").select("doc_id", X.network_text(text, F.create_map(F.lit("1"), F.lit("a"), F.lit("3"), F.lit("b"))).alias("value"))


@query("str12_final_letters", "SELECT doc_id, array_to_string(list_transform(string_split(text, ' '), lambda w: CASE WHEN ends_with(w, 'on') AND w NOT IN ('tion', 'on') THEN left(w, -2) || 'an' ELSE w END), ' ') AS value FROM documents")
def _(t):
    """Repair of word ends with a lexicon of exceptions."""
    words = F.transform(F.split("text", " "), lambda w: F.when(w.endswith("on") & ~w.isin("tion", "on"), F.concat(F.substring(w, F.lit(1), F.length(w) - 2), F.lit("an"))).otherwise(w))
    return t("documents").select("doc_id", F.array_join(words, " ").alias("value"))


@query("str16_clean_blocks")
def _(t):
    """Publishing clean-up: joined lines, blocks and page breaks, in order."""
    text = F.regexp_replace("text", "\n", "\n\n")
    return t("documents").select("doc_id", F.posexplode(X.clean_blocks(text)).alias("pos", "block"))


@query("str17_line_shape", r"""SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) > 0 AND len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '' AND length(x) > 110)) = 0 AS short_lines, contains(text, ' … ') AND length(text) < 160 AS couplet FROM documents""")
def _(t):
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    return t("documents").select("doc_id", ((F.size(lines) > 0) & F.forall(lines, lambda x: F.length(x) <= 110)).alias("short_lines"), X.is_couplet(F.col("text")).alias("couplet"))


_H = r"regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?is)<h1[^>]*>.*?</h1>', ' ', 'g'), '<[^>]+>', ' ', 'g')"
for _ in range(2):
    for _n, _v in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        _H = f"replace({_H}, '{_n}', '{_v}')"


@query("str21_html_plain", f"SELECT page_id, {_sq(_H)} AS plain FROM pages")
def _(t):
    """Visible text of pages, entities read (STR-20, STR-21)."""
    return t("pages").select("page_id", X.html_plain(F.col("html")).alias("plain"))


@query("str22_excerpt", """
WITH s AS (SELECT doc_id, text, substr(text, 1, 240) AS h FROM documents),
p AS (SELECT *, greatest(CASE WHEN instr(reverse(h), '.') = 0 THEN 0 ELSE 241 - instr(reverse(h), '.') END, CASE WHEN instr(reverse(h), '!') = 0 THEN 0 ELSE 241 - instr(reverse(h), '!') END,
   CASE WHEN instr(reverse(h), '?') = 0 THEN 0 ELSE 241 - instr(reverse(h), '?') END, CASE WHEN instr(reverse(h), '؟') = 0 THEN 0 ELSE 241 - instr(reverse(h), '؟') END) AS stop FROM s)
SELECT doc_id, CASE WHEN length(text) <= 240 THEN text WHEN stop > 132 THEN substr(h, 1, stop) ELSE substr(h, 1, 240 - instr(reverse(h), ' ')) || ' …' END AS value FROM p""")
def _(t):
    return t("documents").select("doc_id", X.excerpt(F.col("text")).alias("value"))


@query("str25_one_digit_off", "SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey WHERE length(CAST(a.o_orderkey AS VARCHAR)) = length(CAST(b.o_orderkey AS VARCHAR)) AND levenshtein(CAST(a.o_orderkey AS VARCHAR), CAST(b.o_orderkey AS VARCHAR)) = 1")
def _(t):
    o = t("orders").select("o_custkey", "o_orderkey")
    a, b = o.select("o_custkey", F.col("o_orderkey").alias("a")), o.select("o_custkey", F.col("o_orderkey").alias("b"))
    return a.join(b, "o_custkey").where((F.col("a") < F.col("b")) & X.one_digit_off(F.col("a").cast("string"), F.col("b").cast("string"))).select("a", "b")


@query("str27_prefix_key", r"SELECT doc_id, substr(regexp_replace(text, '^[0-9]+\s*[-.]?\s*', ''), 1, 45) AS key, substr(regexp_replace(lower(text), '^(the|der|die|das|la|le|el)\s+', ''), 1, 40) AS name_key FROM documents")
def _(t):
    return t("documents").select("doc_id", F.substring(F.regexp_replace("text", r"^[0-9]+\s*[-.]?\s*", ""), 1, 45).alias("key"), F.substring(F.regexp_replace(F.lower("text"), r"^(the|der|die|das|la|le|el)\s+", ""), 1, 40).alias("name_key"))


@query("str29_citation", "SELECT l_orderkey, l_linenumber, l_returnflag || ' ' || l_suppkey || '/' || l_partkey || ' nr. ' || l_linenumber AS cite FROM lineitem")
def _(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", X.citation(F.col("l_returnflag"), F.col("l_suppkey"), F.col("l_partkey"), F.col("l_linenumber")).alias("cite"))


NOTE_RULES = [(r"view (\d+)$", "seen $1"), (r"click (\d+)", "pressed $1"), (r"purchase.*", "bought")]


@query("str30_rewrite_notes", r"""SELECT event_id, CASE WHEN regexp_matches(n, '^view (\d+)$') THEN regexp_replace(n, '^view (\d+)$', 'seen \1') WHEN regexp_matches(n, '^click (\d+)') THEN regexp_replace(n, '^click (\d+)', 'pressed \1') WHEN regexp_matches(n, '^purchase.*') THEN 'bought' ELSE n END AS note FROM (SELECT event_id, event_type || ' ' || user_id AS n FROM events) x""")
def _(t):
    note = F.concat_ws(" ", "event_type", "user_id")
    return t("events").select("event_id", X.rewrite_first(note, NOTE_RULES).alias("note"))


@query("str31_pair_id", "SELECT l_orderkey, l_linenumber, least(CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) || '|' || greatest(CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS pair FROM lineitem")
def _(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", X.pair_id(F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("pair"))


@query("str33_capitalised", r"SELECT doc_id, pos, CASE left(w, 1) WHEN 'i' THEN 'İ' WHEN 'ı' THEN 'I' WHEN 'ß' THEN 'SS' ELSE upper(left(w, 1)) END || substr(w, 2) AS value FROM (SELECT doc_id, CAST(generate_subscripts(w, 1) - 1 AS BIGINT) AS pos, unnest(w) AS w FROM (SELECT doc_id, regexp_extract_all(regexp_replace(regexp_replace(text, '\([^)]*\)|\[[^\]]*\]', ' ', 'g'), '(Abd|abd)(al|el)-', '\1 \2-', 'g'), '[\p{L}''’-]+') AS w FROM documents) x) y")
def _(t):
    """Every word of a text without what stands in brackets, its first letter large by the rule of the dotted i (STR-33)."""
    words = F.regexp_extract_all(X.strip_name(F.col("text")), F.lit(r"[\p{L}'’-]+"), F.lit(0))
    return t("documents").select("doc_id", F.posexplode(words).alias("pos", "w")).select("doc_id", F.col("pos").cast("long").alias("pos"), X.capitalised(F.col("w")).alias("value"))


@query("str34_mention_cleanup", r"SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(replace(text, chr(10), ' '), '\([^)]*\)', '', 'g'), '[,;:.]+$', ''), '\s+(and|und|et|y)$', '')) AS value FROM documents")
def _(t):
    s = F.regexp_replace(F.regexp_replace("text", "\n", " "), r"\([^)]*\)", "")
    return t("documents").select("doc_id", F.trim(F.regexp_replace(F.regexp_replace(s, "[,;:.]+$", ""), r"\s+(and|und|et|y)$", "")).alias("value"))


@query("num05_hijri_years", """
WITH y AS (SELECT o_orderkey, CAST(o_orderkey % 1500 + 1 AS BIGINT) AS h FROM orders),
j AS (SELECT *, CAST(1948440 + 354 * (h - 1) + floor((3 + 11 * h) / 30) + 15 AS BIGINT) AS day FROM y)
SELECT o_orderkey, h, CASE WHEN day >= 2299161 THEN year(DATE '1970-01-01' + CAST(day - 2440588 AS INTEGER)) ELSE CAST(floor((4 * (day - 1721424) + 3) / 1461) + 1 AS BIGINT) END AS ce,
       CAST(floor(622.54 + (h - 1) * 0.970224 + 0.485) AS BIGINT) AS about, CAST(floor((h + 622 - 622.54) / 0.970224 + 1) AS BIGINT) AS back FROM j""")
def _(t):
    """Both calendar formulas and the inverse (NUM-05, NUM-06)."""
    h = (F.col("o_orderkey") % 1500 + 1).cast("long")
    return t("orders").select("o_orderkey", h.alias("h"), N.hijri_to_gregorian(h).alias("ce"), N.common_era(h).alias("about"), N.hijri_era(h + 622).alias("back"))


@query("num08_buckets", "SELECT o_orderkey, CAST(floor((o_orderkey - 1) / 100) + 1 AS BIGINT) AS century, CAST(floor((o_orderkey - 1) / 25) * 25 + 1 AS BIGINT) AS quarter FROM orders")
def _(t):
    k = F.col("o_orderkey")
    return t("orders").select("o_orderkey", N.century(k).alias("century"), N.quarter_century(k).alias("quarter"))


@query("num10_roman", """
WITH n AS (SELECT DISTINCT CAST(o_orderkey % 3999 + 1 AS BIGINT) AS n FROM orders),
o AS (SELECT ['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'] AS o, ['', 'X', 'XX', 'XXX', 'XL', 'L', 'LX', 'LXX', 'LXXX', 'XC'] AS t, ['', 'C', 'CC', 'CCC', 'CD', 'D', 'DC', 'DCC', 'DCCC', 'CM'] AS h)
SELECT n, repeat('M', CAST(n // 1000 AS INTEGER)) || h[n // 100 % 10 + 1] || t[n // 10 % 10 + 1] || o[n % 10 + 1] AS roman FROM n, o""")
def _(t):
    n = (F.col("o_orderkey") % 3999 + 1).cast("long").alias("n")
    return t("orders").select(n).distinct().select("n", N.roman(F.col("n")).alias("roman"))


_LON, _LAT = "(n_nationkey * 7 % 60)", "(n_nationkey * 11 % 40 + 10)"


@query("num11_distances", f"""
WITH p AS (SELECT n_nationkey AS k, CAST({_LON} AS DOUBLE) AS lon, CAST({_LAT} AS DOUBLE) AS lat FROM nation)
SELECT a.k AS a, b.k AS b, round(12742 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))), 4) AS km FROM p a JOIN p b ON a.k < b.k""")
def _(t):
    p = nation_points(t)
    a, b = p.select(F.col("k").alias("a"), F.col("lon").alias("x1"), F.col("lat").alias("y1")), p.select(F.col("k").alias("b"), F.col("lon").alias("x2"), F.col("lat").alias("y2"))
    return a.join(b, F.col("a") < F.col("b")).select("a", "b", F.round(N.haversine_km(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")), 4).alias("km"))


def nation_points(t):
    """Nations as a gazetteer of fixed size: coordinates derived from the key."""
    k = F.col("n_nationkey").cast("long")
    return t("nation").select(k.alias("k"), F.col("n_name").alias("name"), (k * 7 % 60).cast("double").alias("lon"), (k * 11 % 40 + 10).cast("double").alias("lat"))


@query("num12_projection", f"SELECT CAST(n_nationkey AS BIGINT) AS k, ({_LON} + 20.0) * 10.0 AS x, (60.0 - {_LAT}) * 10.0 AS y, {_LON} BETWEEN 7 AND 33 AND {_LAT} BETWEEN 12 AND 43 AS inside FROM nation")
def _(t):
    x, y = N.project(F.col("lon"), F.col("lat"))
    return nation_points(t).select("k", x.alias("x"), y.alias("y"), N.inside_box(F.col("lon"), F.col("lat"), (10, 15, 30, 40)).alias("inside"))


@query("num04_year_in_note", r"SELECT event_id, TRY_CAST(nullif(regexp_extract(translate('d. ' || translate(CAST(user_id + 100 AS VARCHAR), '0123456789', '٠١٢٣٤٥٦٧٨٩'), '٠١٢٣٤٥٦٧٨٩', '0123456789'), '(\d{2,4})', 1), '') AS BIGINT) AS year FROM events")
def _(t):
    note = F.concat(F.lit("d. "), X.digits_eastern((F.col("user_id") + 100).cast("string")))
    return t("events").select("event_id", N.year_from_note(note).alias("year"))


@query("num07_death_note", f"""
WITH y AS (SELECT o_orderkey, CAST(o_orderkey % 1400 + 1 AS BIGINT) AS h FROM orders), j AS (SELECT *, CAST(1948440 + 354 * (h - 1) + floor((3 + 11 * h) / 30) + 15 AS BIGINT) AS day FROM y),
c AS (SELECT *, CASE WHEN day >= 2299161 THEN year(DATE '1970-01-01' + CAST(day - 2440588 AS INTEGER)) ELSE CAST(floor((4 * (day - 1721424) + 3) / 1461) + 1 AS BIGINT) END AS ce FROM j)
SELECT o_orderkey, translate(CAST(h AS VARCHAR), '{X.WESTERN}', '{X.EASTERN}') || 'هـ/' || translate(CAST(ce AS VARCHAR), '{X.WESTERN}', '{X.EASTERN}') || 'م' AS note FROM c""")
def _(t):
    return t("orders").select("o_orderkey", N.death_note((F.col("o_orderkey") % 1400 + 1).cast("long")).alias("note"))


@query("num15_volume_page", "SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS BIGINT) AS vol, CAST(l_partkey AS BIGINT) AS page FROM lineitem")
def _(t):
    ref = F.concat(F.lit("Vol. "), "l_suppkey", F.lit(", p. "), "l_partkey")
    vol, page = N.volume_and_page(ref)
    return t("lineitem").select("l_orderkey", "l_linenumber", vol.alias("vol"), page.alias("page"))


@query("num16_pick_number", """
WITH g AS (SELECT l_orderkey, list(CAST(l_partkey AS BIGINT)) AS n FROM lineitem GROUP BY l_orderkey), l AS (SELECT *, l_orderkey % 200 AS last FROM g)
SELECT l_orderkey, coalesce((SELECT min(x) FROM (SELECT unnest(n) AS x) q WHERE x > last AND x <= last + 6),
  (SELECT min(w) FROM (SELECT unnest([last + 1, last + 2, last + 3]) AS w) q WHERE EXISTS (SELECT 1 FROM (SELECT unnest(n) AS x) r WHERE length(CAST(x AS VARCHAR)) = length(CAST(w AS VARCHAR)) AND levenshtein(CAST(x AS VARCHAR), CAST(w AS VARCHAR)) = 1))) AS number FROM l""")
def _(t):
    g = t("lineitem").groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("n"))
    return g.select("l_orderkey", N.pick_number(F.col("n"), F.col("l_orderkey") % 200).alias("number"))


@query("num01_spelled_numbers", "SELECT CAST(n_nationkey AS BIGINT) AS k, CAST(CASE n_nationkey % 4 WHEN 0 THEN 195 WHEN 1 THEN 2040 WHEN 2 THEN NULL ELSE 7 END AS BIGINT) AS value FROM nation")
def _(t):
    """Spelled numbers, stopping at the first word of another kind (NUM-01, NUM-02)."""
    k = F.col("n_nationkey").cast("long")
    phrase = F.when(k % 4 == 0, "one hundred and ninety five miles").when(k % 4 == 1, "two thousand and forty").when(k % 4 == 2, "no number").otherwise("seven of nine")
    return t("nation").select(k.alias("k"), N.spelled_number(F.split(phrase, " ")).alias("value"))
