"""Text normalisation as Column functions: everything stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Letters and marks of the scripts that the keys unify.
MARKS = "ؐ-ًؚ-ٰٟۖ-ۭ"
SHORT_VOWELS = "ً-ْٰـ"
TITLE_MARKS = "ًٌٍَُِّْٰـ"
TITLE_FROM, TITLE_TO = "إأآٱىةؤئ", "اااايهوي"
TITLE_ARTICLE, TITLE_JOINED_ARTICLE, TITLE_CASE_VOWEL = "^e[lsntdrz]$", "(?<=[a-z])[lstdrzn]$", "(?<=...)[iue]$"
ALEF_FROM, ALEF_TO = "أإآٱىئؤةکی", "ااااييوهكي"
LATIN_FROM, LATIN_TO = "âîûāīūşçğıöüḥṣṭẓḍġáàäãåéèêëíìïóòôõúùñý", "aiuaiuscgiouhstzdgaaaaaeeeeiiioooouuny"
EASTERN, WESTERN = "٠١٢٣٤٥٦٧٨٩", "0123456789"
QUOTES = "’'‘`ʿʾ“”"
TITLE_STOP_AR = ("كتاب", "في", "فى", "على", "علي")
TITLE_STOP_LATIN = ("fi", "ala", "ale", "kitabu", "kitab", "li", "ve", "d", "l", "s", "t", "r", "z", "n")
STOPS = ".؛!؟:"
NOTE_MARKS = r"\[\^\d+\]|\(\^?[\d٠-٩*]+\)|<[^>]+>"
SEE_BELOW = r"((?:\s*،)?\s*(?:و|ف)?س?(?:ياتي|تقدم)(?:\s+(?:ذكره|في بابه|قريبا|ايضا|ترجمته))*)"
#: White space, also that which plain Java patterns leave out.
WS = r"[\s  -  　]+"


def squeeze(c: Column) -> Column:
    """One space for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(c, WS, " "))


def fold_arabic(c: Column) -> Column:
    """Search key of Arabic text: no vowel marks or stretching, one letter for the variants of alef, ya, waw, ha, kaf."""
    return squeeze(F.translate(F.regexp_replace(c, f"[{MARKS}ـ]", ""), ALEF_FROM, ALEF_TO))


def fold_arabic_only(c: Column) -> Column:
    """The client's variant: everything outside the script is a space, and the signs U+0610 to U+061A stay."""
    bare = F.translate(F.regexp_replace(c, "[ً-ٰٟۖ-ۭـ]", ""), "أإآٱىئؤة", "ااااييوه")
    return squeeze(F.regexp_replace(bare, r"[^؀-ۿ\s]", " "))


def fold_latin(c: Column) -> Column:
    """Latin search key: small letters without marks, quotes dropped, the rest but letters and digits as spaces."""
    bare = F.translate(F.lower(c), LATIN_FROM + QUOTES, LATIN_TO)
    return F.trim(F.regexp_replace(bare, "[^a-z0-9]+", " "))


def title_key_arabic(c: Column) -> Column:
    """Key of an Arabic title: its words in unified letters, without stop words, each without the article before two or more letters."""
    words = F.regexp_extract_all(F.translate(c, TITLE_FROM + TITLE_MARKS, TITLE_TO), F.lit("[ء-ي]+"), F.lit(0))
    return F.array_join(F.transform(F.filter(words, lambda w: ~w.isin(*TITLE_STOP_AR)), lambda w: F.regexp_replace(w, "^ال(?=..)", "")), " ")


def title_key_latin(c: Column) -> Column:
    """Key of a transliterated title.

    What stands before a hyphen is an article, alone or as the last letter of a word that it is joined to, and
    is dropped; of the words that are left, stop words go and longer ones lose a final case vowel.
    """
    tokens = F.regexp_extract_all(F.translate(F.lower(c), LATIN_FROM + QUOTES, LATIN_TO), F.lit("[a-z0-9_-]+"), F.lit(0))

    def before_hyphen(part: Column) -> Column:
        return F.when(part.rlike(TITLE_ARTICLE), "").otherwise(F.regexp_replace(part, TITLE_JOINED_ARTICLE, ""))

    def parts(token: Column) -> Column:
        split = F.split(token, "-")
        return F.concat(F.transform(F.slice(split, F.lit(1), F.size(split) - 1), before_hyphen), F.slice(split, -1, 1))

    words = F.regexp_extract_all(F.array_join(F.flatten(F.transform(tokens, parts)), " "), F.lit("[a-z]+"), F.lit(0))
    return F.array_join(F.transform(F.filter(words, lambda w: ~w.isin(*TITLE_STOP_LATIN)), lambda w: F.regexp_replace(w, TITLE_CASE_VOWEL, "")), " ")


def title_key(c: Column) -> Column:
    """Title key tagged by its script."""
    return F.when(c.rlike("[؀-ۿ]"), F.concat(F.lit("ar:"), title_key_arabic(c))).otherwise(F.concat(F.lit("tr:"), title_key_latin(c)))


def place_key(c: Column) -> Column:
    """Gazetteer key: the folded text with everything but letters, digits and marks of words as spaces."""
    return squeeze(F.regexp_replace(fold_arabic(c), r"[^\p{L}\p{N}_\s]", " "))


def place_info_key(c: Column) -> Column:
    """Key of a title in the place texts: marks of words as spaces first, then folded."""
    return fold_arabic(F.regexp_replace(c, r"[^\p{L}\p{N}_\s]", " "))


def network_text(c: Column, xref: Column) -> Column:
    """The text that relations are sought in: cut at <hr>, footnotes that the map xref knows as tokens XREFn, other marks and tags off, folded.

    A token behind words for `see below` moves before them, so that it stays with the name it belongs to.
    """
    body = F.element_at(F.split(c, "<hr>", 2), 1)
    body = F.aggregate(F.map_keys(xref), body, lambda t, k: F.replace(t, F.concat(F.lit("[^"), k, F.lit("]")), F.concat(F.lit(" XREF"), k, F.lit(" "))))
    folded = fold_arabic(F.regexp_replace(body, NOTE_MARKS, " "))
    return F.regexp_replace(folded, SEE_BELOW + r"\s*XREF(\d+)", " XREF$2$1")


def strip_marks(c: Column) -> Column:
    return F.regexp_replace(c, f"[{MARKS}]", "")


def heading_name(c: Column) -> Column:
    """Name in a heading: entry numbers, brackets, page marks and pious formulas off."""
    s = F.regexp_replace(c, "\n", " ")
    s = F.regexp_replace(s, r"^\s*/?\s*(\[[٠-٩0-9]+\]\s*)?(\[?[٠-٩0-9]+\s*[-–.]\s*)?", "")
    s = F.regexp_replace(s, "[«»()\\[\\]]", "")
    s = F.regexp_replace(s, r"\s*(رحمه الله( تعالى)?|رضي الله عنه|عليه السلام)\s*", " ")
    return F.btrim(squeeze(s), F.lit(" .،:-"))


def lead_name(c: Column, limit: int = 160) -> Column:
    """The first sentence, at most `limit` characters of it."""
    return F.trim(F.substring(F.element_at(F.split(F.trim(c), "[.:\n]", 2), 1), 1, limit))


def spacing(c: Column) -> Column:
    """One blank between words, none before closing marks and after opening ones."""
    s = F.regexp_replace(c, r"[ \t ]+", " ")
    s = F.regexp_replace(s, r" +([،,.:;؛؟?!)\]»])", "$1")
    return F.trim(F.regexp_replace(s, r"([(\[«]) +", "$1"))


def is_verse(block: Column) -> Column:
    """Short vowelled lines: at least one line, none over 110 characters, marks over 0.3 of the letters."""
    lines = F.filter(F.split(block, "\n"), lambda x: F.trim(x) != "")
    letters = F.regexp_count(block, F.lit("[ء-ي]"))
    marks = F.regexp_count(block, F.lit("[ً-ْ]"))
    return (F.size(lines) > 0) & F.forall(lines, lambda x: F.length(x) <= 110) & (letters > 0) & (marks / F.greatest(letters, F.lit(1)) > 0.3)


def is_couplet(block: Column) -> Column:
    return block.contains(" … ") & (F.length(block) < 160)


def clean_blocks(c: Column) -> Column:
    """Blocks of a text for publishing: cut at <hr>, footnote marks off, line breaks joined outside verse, and a block
    that does not end a sentence joined with the next one, as pages break paragraphs. A fold over the array of blocks."""
    body = F.regexp_replace(F.element_at(F.split(F.regexp_replace(c, "\r", ""), r"\n*<hr>\n*", 2), 1), r"\s*\[\^[^\]]*\]\s*", " ")
    blocks = F.filter(F.transform(F.split(body, r"\n{2,}"), F.trim), lambda b: b != "")
    tagged = F.transform(blocks, lambda b: F.struct((is_verse(b) & b.contains("\n") | is_couplet(b)).alias("v"), b.alias("b")))
    tagged = F.transform(tagged, lambda t: F.struct(t["v"].alias("v"), F.when(t["v"], t["b"]).otherwise(spacing(F.regexp_replace(t["b"], r"\s*\n\s*", " "))).alias("b")))
    empty = F.array().cast("array<struct<v:boolean,b:string>>")

    def step(done, t):
        last = F.try_element_at(done, F.lit(-1))
        joins = last.isNotNull() & ~t["v"] & ~last["v"] & ~last["b"].rlike(r"^#{1,6}\s") & ~t["b"].rlike(r"^#{1,6}\s") & ~last["b"].rlike(r"[.؟?!:»\])”…]\s*$")
        merged = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.lit(False).alias("v"), F.concat_ws(" ", last["b"], t["b"]).alias("b"))))
        return F.when(F.coalesce(joins, F.lit(False)) & (F.size(done) > 0), merged).otherwise(F.concat(done, F.array(t)))

    return F.transform(F.aggregate(tagged, empty, step), lambda t: t["b"])


def html_plain(c: Column) -> Column:
    """Visible text of HTML: first headings, tags and comments off, the five entities read."""
    s = F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    s = F.regexp_replace(s, r"(?is)<h1[^>]*>.*?</h1>", " ")
    s = F.regexp_replace(s, "<[^>]+>", " ")
    return squeeze(unescape(s))


def unescape(c: Column, rounds: int = 2) -> Column:
    """The five named entities and the no-break space, over as many rounds as texts are escaped at most."""
    for _ in range(rounds):
        for name, value in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
            c = F.replace(c, F.lit(name), F.lit(value))
    return c


def excerpt(c: Column, n: int = 240) -> Column:
    """At most n characters: up to the last sentence end behind 0.55 n, else up to the last blank, with an ellipsis."""
    head = F.substring(c, 1, n)
    stop = n - F.least(*[F.when(F.instr(F.reverse(head), m) == 0, n + 1).otherwise(F.instr(F.reverse(head), m)) for m in (".", "!", "?", "؟")]) + 1
    blank = n - F.instr(F.reverse(head), " ")
    return F.when(F.length(c) <= n, c).when(stop > int(0.55 * n), F.substring(head, F.lit(1), stop)).otherwise(F.concat(F.substring(head, F.lit(1), blank), F.lit(" …")))


def quote(c: Column, n: int = 320) -> Column:
    """The first sentences: the longest prefix of at most n characters that ends a sentence behind n / 3, else up to the last blank."""
    t = squeeze(F.regexp_replace(F.element_at(F.split(c, "<hr>", 2), 1), r"\[\^\w+\]|<[^>]+>", " "))
    ended = F.regexp_extract(F.substring(t, 1, n + 1), rf"(?s)^(.{{{n // 3 - 1},{n - 1}}}[{STOPS}])\s", 1)
    cut = F.regexp_extract(F.substring(t, 1, n), r"(?s)^(.*) ", 1)
    return F.when(F.length(t) <= n, t).when(ended != "", F.concat(ended, F.lit(" …"))).otherwise(F.concat(F.rtrim(cut), F.lit(" …")))


def one_digit_off(a: Column, b: Column) -> Column:
    """Equal length and one differing digit."""
    return (F.length(a) == F.length(b)) & (F.levenshtein(a, b) == 1)


def article_off(c: Column) -> Column:
    return F.when(c.startswith("ال") & (F.length(c) > 4), c.substr(F.lit(3), F.length(c))).otherwise(c)


def strip_name(c: Column) -> Column:
    """A name without brackets and what they hold, Abdal-X in two words."""
    return F.regexp_replace(F.regexp_replace(c, r"\([^)]*\)|\[[^\]]*\]", " "), "(Abd|abd)(al|el)-", "$1 $2-")


def capitalised(c: Column) -> Column:
    """The first letter large, i and ı by the Turkish rule; the rest stays."""
    first = F.substring(c, 1, 1)
    return F.concat(F.when(first == "i", "İ").when(first == "ı", "I").otherwise(F.upper(first)), c.substr(F.lit(2), F.length(c)))


def pair_id(a: Column, b: Column) -> Column:
    """The same id for both orders of a pair."""
    return F.concat_ws("|", F.least(a, b), F.greatest(a, b))


def citation(book: Column, vol: Column, page: Column, number: Column) -> Column:
    return F.concat(book, F.when(vol.isNotNull(), F.concat(F.lit(" "), vol, F.lit("/"), F.coalesce(page.cast("string"), F.lit("?")))).otherwise(F.coalesce(F.concat(F.lit(" s. "), page), F.lit(""))), F.coalesce(F.concat(F.lit(" nr. "), number), F.lit("")))


def rewrite_first(c: Column, rules: list[tuple[str, str]]) -> Column:
    """The first rule whose pattern matches at the start rewrites the text; without one it stays. Rules are data."""
    out = c
    for pattern, replacement in reversed(rules):
        out = F.when(c.rlike("^" + pattern), F.regexp_replace(c, "^" + pattern, replacement)).otherwise(out)
    return out


def digits_western(c: Column) -> Column:
    return F.translate(c, EASTERN, WESTERN)


def digits_eastern(c: Column) -> Column:
    return F.translate(c, WESTERN, EASTERN)


def snippet(text: Column, at: Column, before: int = 40, after: int = 140) -> Column:
    """The characters around a place (counted from 1)."""
    start = F.greatest(F.lit(1), at - before)
    return F.substring(text, start, at + after - start)


def short_name(name: Column, words: int = 2) -> Column:
    """Display name: what stands behind a known-as mark, else the first and the last words."""
    known = F.regexp_extract(name, r"(?:known as|el-ma'rûf bi|المعروف ب)\s*([^,،]+)", 1)
    parts = F.split(squeeze(name), " ")
    return F.when(known != "", F.trim(known)).when(F.size(parts) <= words, F.array_join(parts, " ")).otherwise(F.concat_ws(" ", F.element_at(parts, 1), F.element_at(parts, -1)))


def display_name(name: Column, pack) -> Column:
    """The short name that lists show: a byname behind "known as"; a lone name with article; an honorific or a kunya with the last nisba; the first name with it; the first words.

    The last nisba is the last word of the pack's form that is not one of its titles and does not belong to the
    word before it. Null names give null, empty ones empty.
    """
    bare = F.trim(F.regexp_replace(name, "[\u064b-\u0652\u0670ـ]", ""))
    known = F.trim(F.regexp_extract(bare, pack.SHOWN_AS, 1))
    words = F.filter(F.split(F.regexp_replace(bare, "[،,.]", " "), r"\s+"), lambda w: w != "")
    first, second = F.try_element_at(words, F.lit(1)), F.try_element_at(words, F.lit(2))

    def nisba(w: Column, i: Column) -> Column:
        form = w.startswith("ال") & w.endswith("ي") & (F.length(w) > 4) & ~w.isin(*pack.NO_NISBA)
        return (i > 1) & form & ~F.try_element_at(words, F.greatest(i, F.lit(1))).isin(*pack.JOINS)

    last = F.try_element_at(F.filter(words, nisba), F.lit(-1))
    found = F.concat(*[F.regexp_extract_all(bare, F.lit(p), F.lit(1)) for p in pack.HONOURS])
    head = lambda x: F.element_at(F.split(x, " "), 1)
    off = lambda x: x.substr(F.lit(2), F.length(x))
    found = F.transform(found, lambda x: F.when(x.startswith("ب") & head(off(x)).isin(*pack.HONOUR_HEADS), off(x)).otherwise(x))
    honour = F.try_element_at(F.filter(found, lambda x: head(x).isin(*pack.HONOUR_HEADS)), F.lit(1))
    lead = F.coalesce(honour, F.nullif(F.regexp_extract(bare, pack.SHOWN_KUNYA, 0), F.lit("")))
    son = F.coalesce(F.nullif(F.array_position(words, "بن"), F.lit(0)) - 1, F.size(words)).cast("int")
    own = F.array_join(F.slice(words, F.lit(1), F.greatest(F.lit(1), F.least(son, F.lit(2)))), " ")
    third = F.try_element_at(words, F.lit(3))
    chain = F.array_join(F.slice(words, F.lit(1), F.when(third.isin("أبي", "ابن") & (F.size(words) > 3), 4).otherwise(3)), " ")
    return (
        F.when(name.isNull(), F.lit(None).cast("string")).when(known != "", known).when(F.size(words) == 0, "").when(first.startswith("ال") & ~F.coalesce(second == "بن", F.lit(False)), first)
        .when(lead.isNotNull() & last.isNotNull(), F.concat_ws(" ", lead, last)).when(last.isNotNull(), F.concat_ws(" ", own, last)).when((son == 1) & (F.size(words) > 2), chain).otherwise(own)
    )
