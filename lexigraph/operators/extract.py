"""Extraction of mentions, names, places, references and titles: rules are data, one text row gives many rows."""

from __future__ import annotations

import difflib
import functools
import typing
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lexigraph.session import written


def rule_hits(df: DataFrame, text: str, rules: list[tuple[str, str, str]], before: int = 70, after: int = 70) -> DataFrame:
    """Rows of df beside (rule, label, at, evidence) for each rule (name, pattern, label) that its text matches: the first place and what stands around it.

    All rules are tested in one pass over the rows, as an array of structs.
    """
    hits = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(label).alias("label"), F.regexp_instr(F.col(text), F.lit(p)).alias("at")) for n, p, label in rules])
    d = df.withColumn("_h", F.explode(F.filter(hits, lambda h: h["at"] > 0)))
    start = F.greatest(F.lit(1), F.col("_h.at") - before)
    return d.select(*df.columns, "_h.rule", "_h.label", "_h.at", F.substring(F.col(text), start, F.col("_h.at") + after - start).alias("evidence"))


def spans(text: Column, pattern: str) -> Column:
    """array<struct<start, stop, match>>: all matches of a pattern that is never empty, from the left, by characters from 0. Null without text.

    For patterns that match now and then; every word of a text is better exploded and its place summed, as place_mentions does.
    """
    match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gap = F.split(text, pattern, -1)

    def step(state, k):
        start = state["at"] + F.length(F.element_at(gap, k))
        stop = start + F.length(F.element_at(match, k))
        return F.struct(stop.alias("at"), F.concat(state["out"], F.array(F.struct(start.alias("start"), stop.alias("stop"), F.element_at(match, k).alias("match")))).alias("out"))

    none = F.array().cast("array<struct<start: int, stop: int, match: string>>")
    found = F.aggregate(F.sequence(F.lit(1), F.size(match)), F.struct(F.lit(0).alias("at"), none.alias("out")), step)["out"]
    return F.when(F.size(match) > 0, found).when(text.isNotNull(), none)


def rule_spans(text: Column, rules: list[tuple[str, str]]) -> Column:
    """array<struct<start, rule, stop, match, name>>: the matches of all rules (name, pattern), of those that overlap the leftmost, then that of the first rule.

    Every rule is matched for itself, so rules may have groups and flags of their own; what they find is then put in order and swept once.
    """
    def of_rule(k: int, name: str, pattern: str) -> Column:
        return F.transform(spans(text, pattern), lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("rule"), x["stop"].alias("stop"), x["match"].alias("match"), F.lit(name).alias("name")))

    found = F.array_sort(F.flatten(F.array(*[of_rule(k, name, pattern) for k, (name, pattern) in enumerate(rules)])))
    kind = "array<struct<start: int, rule: int, stop: int, match: string, name: string>>"
    sweep = F.aggregate(
        found, F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")),
        lambda state, x: F.when(x["start"] >= state["at"], F.struct(x["stop"].alias("at"), F.concat(state["out"], F.array(x)).cast(kind).alias("out"))).otherwise(state),
    )
    return sweep["out"]


_REFERENCE = "struct<number: int, vol: int, page: int>"


def reference_at(tail: Column, pack) -> Column:
    """struct<number, vol, page>: what a citation says behind the title of its work; null where no number stands there.

    An author and punctuation may come first. A number behind its word is the entry's; a/b is volume and page, in either order
    (a volume is at most pack.VOLUMES), and c, a/b is volume a and the smaller page, as text from right to left puts it; a bare number is a page.
    """
    t = F.regexp_replace(F.regexp_replace(tail, pack.GAP, ""), pack.PAGE_WORD, "")
    number = lambda p, k: F.translate(F.regexp_extract(t, p, k), pack.DIGITS, "0123456789").try_cast("int")
    n = pack.NUMBER
    entry = number(f"^{pack.ENTRY_WORD}\\s*({n})", 1)
    pair = rf"^(?:({n})\s*[،,]\s*)?({n})\s*/\s*({n})"
    first, a, b = (number(pair, k) for k in (1, 2, 3))
    most = F.lit(pack.VOLUMES)
    none = F.lit(None).cast("int")
    out = lambda number, vol, page: F.struct(number.alias("number"), vol.alias("vol"), page.alias("page"))
    by_pair = F.when(first.isNotNull(), out(none, a, F.least(first, b))).when(a <= most, out(none, a, b)).when(b <= most, out(none, b, a))
    page = number(f"^({n})", 1)
    return F.when(entry.isNotNull(), out(entry, none, none)).when(a.isNotNull(), by_pair).when(page.isNotNull(), out(none, none, page))


def references(df: DataFrame, text: str, pack, reach: int = 60) -> DataFrame:
    """Rows of df beside (at, target, number, vol, page, evidence) for every work of pack.WORKS that its text cites. Null texts give no rows."""
    d = df.select(*df.columns, F.explode(rule_spans(F.col(text), pack.WORKS)).alias("_x"))
    tail = F.substr(F.col(text), F.col("_x.stop") + 1, F.lit(reach))
    d = d.withColumn("_r", reference_at(tail, pack)).where("_r IS NOT NULL")
    evidence = F.substr(F.col(text), F.col("_x.start") + 1, F.col("_x.stop") - F.col("_x.start") + 40)
    return d.select(*df.columns, F.col("_x.start").alias("at"), F.col("_x.name").alias("target"), "_r.number", "_r.vol", "_r.page", evidence.alias("evidence"))


def cited_entries(refs: DataFrame, entries: DataFrame, width: int = 16) -> DataFrame:
    """refs (…, target, number, vol, page) beside the entries (book, number, vol, page_start, page_end, entry) that they may mean.

    A number is an equi-join. A page meets the entries that it lies in, or one page before, by bins of `width` pages, so
    that a book is not one key; the volume must be the entry's where the citation has one.
    """
    e = entries.select("entry", "book", F.col("number").alias("e_number"), F.col("vol").alias("e_vol"), "page_start", "page_end")
    by_number = refs.where("number IS NOT NULL").join(e, (F.col("target") == F.col("book")) & (F.col("number") == F.col("e_number")))
    bins = e.where("page_start <= page_end").withColumn("bin", F.explode(F.sequence(F.floor((F.col("page_start") - 1) / width), F.floor(F.col("page_end") / width))))
    r = refs.where("number IS NULL AND page IS NOT NULL").withColumn("r_bin", F.floor(F.col("page") / width))
    inside = F.col("page").between(F.col("page_start") - 1, F.col("page_end")) & (F.col("vol").isNull() | (F.col("vol") == F.col("e_vol")))
    by_page = r.join(bins, (F.col("target") == F.col("book")) & (F.col("r_bin") == F.col("bin")) & inside)
    return by_number.select(*refs.columns, "entry").union(by_page.select(*refs.columns, "entry"))


def first_rule(c: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The value of the first rule (pattern, value) that matches."""
    out = F.lit(default)
    for pattern, value in reversed(rules):
        out = F.when(c.rlike(pattern), value).otherwise(out)
    return out


def derive(title: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(kind, base title) of a derived title: rules (prefix pattern, kind) in order; nulls where none matches or nothing is left."""
    kind, base = F.lit(None).cast("string"), F.lit(None).cast("string")
    for pattern, name in reversed(rules):
        rest = F.regexp_extract(title, f"^(?:{pattern})(.{{2,}})$", 1)
        kind = F.when(rest != "", name).otherwise(kind)
        base = F.when(rest != "", rest).otherwise(base)
    return kind, base


def tokens(df: DataFrame, text: str, pattern: str = r"[\p{L}\p{N}]+") -> DataFrame:
    """df with (pos, token): the words of a text in order."""
    return df.select(*[c for c in df.columns if c != text], F.posexplode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).alias("pos", "token"))


def gazetteer_hits(df: DataFrame, id_col: str, text: str, names: DataFrame, most: int = 4) -> DataFrame:
    """(id, pos, n, name, place): names (name, place) found in texts, the longest of up to `most` words at each place.

    Names are keys of one to `most` words joined by blanks. They are grouped by their first word, so that a
    token meets them once, and only where it begins a name are the words behind it put together.
    """
    first = names.select(F.split("name", " ").alias("w"), "name", "place").where(F.size("w") <= most)
    heads = first.groupBy(F.col("w")[0].alias("head")).agg(F.collect_list(F.struct(F.size("w").alias("n"), "name", "place")).alias("names"))
    w = df.select(F.col(id_col).alias("id"), F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)).alias("w")).where(F.size("w") > 0)
    places = F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.struct((i - 1).alias("pos"), F.element_at("w", i).alias("head"), F.slice("w", i, most).alias("run")))
    met = w.select("id", F.explode(places).alias("p")).select("id", "p.pos", "p.head", "p.run").join(heads, "head")
    fits = F.filter("names", lambda x: F.array_join(F.slice("run", F.lit(1), x["n"]), " ") == x["name"])
    return met.select("id", "pos", F.array_max(fits).alias("x")).where("x is not null").select("id", "pos", "x.n", "x.name", "x.place")


def window_hits(triggers: DataFrame, places: DataFrame, reach: int) -> DataFrame:
    """(id, at, kind, place): for each trigger (id, at, kind) the first place (id, pos, place) behind it within `reach` tokens and before the next trigger."""
    nxt = F.lead("at").over(Window.partitionBy("id").orderBy("at"))
    t = triggers.withColumn("stop", F.least(F.col("at") + reach, F.coalesce(nxt, F.lit(2**31 - 1))))
    met = t.join(places.select("id", "pos", "place"), "id").where((F.col("pos") > F.col("at")) & (F.col("pos") <= F.col("stop")))
    return met.groupBy("id", "at", "kind").agg(F.min_by("place", "pos").alias("place"))


#: Texts whose words a task of place_mentions() sorts.
TEXTS = 2000


def place_mentions(df: DataFrame, id_col: str, text: str, names: DataFrame, pack) -> DataFrame:
    """(id, at, kind, place, word): for each trigger of a text the first place behind it, or the last place before it where a pronoun refers there.

    names (name, place) are keys of up to pack.WORDS words. A word may carry a prefix of pack.PREFIXES, which a name is looked up
    without too; a place counts if it carries one, stands behind a preposition or right behind the trigger. The window of a
    trigger is pack.WINDOW words; it ends at punctuation and at the next trigger. A pronoun stands for the last place that counts before the trigger, if that is at most pack.REACH characters before the pronoun. `at` is the trigger's place in the text.

    Texts are dealt by their ids before their words are exploded, and all windows over the words of one text stay in that
    dealing. Names are written first, so that the planner knows their size; where they are small no word is dealt. Null texts
    give no rows; rows of one id are one text, so ids must be unique.
    """
    # exploded words take many times the room of texts, so texts are dealt to as many tasks as their number asks for
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // TEXTS)
    df = df.repartition(parts, id_col)
    match = F.regexp_extract_all(F.col(text), F.lit(pack.TOKEN), F.lit(0))
    gap = F.slice(F.split(F.col(text), pack.TOKEN, -1), F.lit(1), F.size(match))
    words = df.select(F.col(id_col).alias("id"), match.alias("m"), gap.alias("g")).where(F.size("m") > 0)
    words = words.select("id", F.posexplode(F.arrays_zip(F.col("m").alias("word"), F.transform("g", F.length).alias("gap"))).alias("i", "x")).select("id", "i", "x.word", "x.gap")
    of_text = Window.partitionBy("id").orderBy("i")
    so_far = F.sum(F.col("gap") + F.length("word")).over(of_text.rowsBetween(Window.unboundedPreceding, 0))
    w = words.select("id", "i", "word", (so_far - F.length("word")).cast("int").alias("pos"), F.lag("word").over(of_text).alias("before"), *[F.lead("word", k).over(of_text).alias(f"w{k}") for k in range(1, pack.WORDS)])
    trigger = F.lit(None).cast("string")
    for kind, pattern in reversed(pack.TRIGGERS):
        trigger = F.when(F.col("word").rlike(f"^(?:{pack.JOINED})?(?:{pattern}){pack.ENDING}$"), kind).otherwise(trigger)
    w = w.withColumn("kind", trigger).withColumn("stop", F.col("word").rlike(pack.STOP)).withColumn("pronoun", F.col("word").isin(*pack.PRONOUNS))
    # names are met by their first word, with and without the prefix
    bare = F.regexp_replace("word", f"^(?:{pack.PREFIXES})(?=..)", "")
    heads = names.select("name", "place", F.split("name", " ").alias("ws")).where(F.size("ws") <= pack.WORDS).groupBy(F.col("ws")[0].alias("head")).agg(F.collect_list(F.struct(F.size("ws").alias("n"), "name", "place")).alias("names"))
    heads = written(heads, "heads")
    w = w.withColumn("bare", F.when(~F.col("stop"), bare))

    def longest(head: str, whole: Column) -> Column:
        run = F.array(F.col(head), *[F.coalesce(f"w{k}", F.lit("")) for k in range(1, pack.WORDS)])
        fits = F.filter(f"{head}_names", lambda x: F.array_join(F.slice(run, F.lit(1), x["n"]), " ") == x["name"])
        return F.array_max(F.transform(fits, lambda x: F.struct(x["n"].alias("n"), whole.alias("whole"), x["name"].alias("name"), x["place"].alias("place"))))

    for head in ("word", "bare"):
        w = w.join(heads.toDF(f"{head}_head", f"{head}_names"), (F.col(head) == F.col(f"{head}_head")) & ~F.col("stop"), "left")
    found = [longest("word", F.lit(1)), longest("bare", F.when(F.col("bare") == F.col("word"), 1).otherwise(0))]
    w = w.withColumn("hit", F.array_max(F.array(*found))).drop("word_head", "word_names", "bare_head", "bare_names", "bare")
    reach = F.max(F.col("i") + F.col("hit.n")).over(of_text.rowsBetween(1 - pack.WORDS, -1))
    w = w.withColumn("inside", F.coalesce(reach > F.col("i"), F.lit(False)))
    counts = F.col("hit").isNotNull() & ~F.col("inside") & ((F.col("hit.whole") == 0) | F.coalesce(F.col("before").rlike(pack.PREPOSITION), F.lit(False)) | F.col("behind"))
    w = w.withColumn("behind", F.lag("kind").over(of_text).isNotNull()).withColumn("counts", counts)
    place = F.struct(F.col("hit.place").alias("place"), F.col("hit.name").alias("name"), "pos")
    what = F.when(F.col("stop"), "stop").when(F.col("pronoun"), "pronoun").when(F.col("counts"), "place").when(F.col("hit").isNull() & F.col("kind").isNotNull() & ~F.col("inside"), "trigger")
    w = w.withColumn("event", F.when(what.isNotNull(), F.struct("i", what.alias("what"), place.alias("p"), "word", "pos")))
    ahead = of_text.rowsBetween(1, pack.WINDOW - 1)
    w = w.select(
        "*", F.min("event").over(ahead).alias("first"), F.min(F.when(F.col("event.what") != "pronoun", F.col("event"))).over(ahead).alias("other"),
        F.last(F.when(F.col("counts"), place), ignorenulls=True).over(of_text.rowsBetween(Window.unboundedPreceding, -1)).alias("last"),
    )
    w = w.where("kind IS NOT NULL")
    back = (F.col("first.what") == "pronoun") & (F.col("first.pos") - F.col("last.pos") <= pack.REACH)
    w = w.withColumn("took", F.when(F.coalesce(back, F.lit(False)), F.struct("last.place", "first.word")).when(F.col("other.what") == "place", F.struct("other.p.place", F.col("other.p.name").alias("word"))))
    return w.where("took IS NOT NULL").select("id", F.col("pos").alias("at"), "kind", "took.place", "took.word")


_WORDS = T.ArrayType(T.StringType())
NAME = T.StructType([T.StructField("chain", _WORDS), T.StructField("kunya", T.StringType()), T.StructField("nisbas", _WORDS), T.StructField("laqabs", _WORDS)])


@F.pandas_udf(NAME)
def parse_name(names: pd.Series) -> pd.DataFrame:
    """Parts of a transliterated name: patronymic chain (ibn, bin, b.), kunya (Abu X), nisbas (al-Xi) and laqabs (X al-Din).

    Compounds such as `Abd al-X` stay one link. Null and empty names give empty parts.
    """
    out = []
    for name in names:
        words = (name or "").replace(",", " ").split()
        chain: list[str] = []
        kunya, nisbas, laqabs = None, [], []
        link: list[str] = []
        i = 0

        def close():
            if link:
                chain.append(" ".join(link))
                link.clear()

        while i < len(words):
            w, low = words[i], words[i].lower()
            if low in ("ibn", "bin", "b.", "bint"):
                close()
            elif low in ("abu", "abi", "umm") and i + 1 < len(words):
                kunya = kunya or f"{w} {words[i + 1]}"
                i += 1
            elif i + 1 < len(words) and words[i + 1].lower() in ("al-din", "ad-din", "eddin"):
                laqabs.append(f"{w} {words[i + 1]}")
                i += 1
            elif low in ("abd", "abdu", "ubayd") and i + 1 < len(words):
                link += [w, words[i + 1]]
                i += 1
            elif low.startswith(("al-", "el-", "as-", "ash-", "at-", "an-")) and low.endswith(("i", "ī", "iyya")):
                close()
                nisbas.append(w)
            elif not link:
                link.append(w)
            i += 1
        close()
        out.append((chain, kunya, sorted(set(nisbas)), sorted(set(laqabs))))
    return pd.DataFrame(out, columns=["chain", "kunya", "nisbas", "laqabs"])


@F.pandas_udf(T.DoubleType())
def sequence_ratio(batches: typing.Iterator[typing.Tuple[pd.Series, pd.Series]]) -> typing.Iterator[pd.Series]:
    """Ratcliff-Obershelp likeness of two strings; null where one is null. A task remembers its last 65,536 pairs of short strings."""

    def ratio(x: str, y: str) -> float:
        return difflib.SequenceMatcher(None, x, y, autojunk=False).ratio()

    known = functools.lru_cache(65_536)(ratio)
    for a, b in batches:
        yield pd.Series([None if x is None or y is None else known(x, y) if len(x) + len(y) < 512 else ratio(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
def simplify(lines: pd.Series, tolerance: pd.Series) -> pd.Series:
    """Polylines with the points that lie within the tolerance of the line through their neighbours left out (Douglas-Peucker), ends kept."""

    def thin(pts, tol):
        p = np.array([list(x) for x in pts], float)
        keep = np.zeros(len(p), bool)
        if len(p):
            keep[[0, -1]] = True
        stack = [(0, len(p) - 1)]
        while stack:
            a, b = stack.pop()
            if b - a < 2:
                continue
            d = p[b] - p[a]
            off = p[a + 1 : b] - p[a]
            size = float(np.hypot(*d))
            far = np.abs(off[:, 0] * d[1] - off[:, 1] * d[0]) / size if size else np.hypot(off[:, 0], off[:, 1])
            k = int(far.argmax())
            if far[k] > tol:
                keep[a + 1 + k] = True
                stack += [(a, a + 1 + k), (a + 1 + k, b)]
        return p[keep].tolist()

    return pd.Series([thin(x, t) if x is not None else None for x, t in zip(lines, tolerance)])


#: Scores of an alignment are whole millionths, so that ties are ties on every machine.
MICRO = 1_000_000
#: Centres of a block, in which heads meet the entries in reach.
BLOCK = 64


def align(heads: DataFrame, index: DataFrame, key: str, band: int = 40, gap: float = 0.35, least: float = 0.55, likeness: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(key, head, entry, ratio): heads (key, pos, name) aligned in order with index rows (key, pos, name).

    Global alignment in a band around the diagonal: a pair gains its likeness less a half, a gap costs `gap`; pairs
    below `least` are left out; of equal ways a pair goes before a head without entry, and that before an entry without head.
    The likenesses of all pairs of the band are worked out in all tasks, where heads meet the entries in reach by blocks of
    centres, and are dealt once more, an array a head. What is sequential reads a head at a time: it holds one row of 2 * band + 1 scores and
    a byte for each cell of the band, so that a list of 100,000 heads takes some 8 MB; what it pairs finds its names and its likeness by joins. Null names are like nothing; lists that meet no other list give no rows.
    """
    like = likeness or sequence_ratio
    place = lambda d, k, n: d.select(F.col(key).alias("of"), F.col("pos").cast("long").alias(n), F.col("name").alias(f"{n}_name"), F.row_number().over(Window.partitionBy(key).orderBy("pos")).alias(k))
    h, x = place(heads, "i", "head"), place(index, "j", "entry")
    sizes = h.groupBy("of").agg(F.max("i").alias("n")).join(x.groupBy("of").agg(F.max("j").alias("m")), "of")
    centre = F.round(F.col("i").cast("double") * F.col("m") / F.col("n")).cast("int")
    sized = h.join(sizes, "of").withColumn("centre", centre)
    ratio = F.coalesce(F.round(like(F.col("head_name"), F.col("entry_name")) * MICRO), F.lit(0)).cast("int")
    block = lambda c: F.floor(c / BLOCK)
    near = x.select("*", F.explode(F.sequence(block(F.col("j") - band), block(F.col("j") + band))).alias("block"))
    # a row for each cell stays where its block is
    met = sized.withColumn("block", block(F.col("centre"))).repartition("of", "block").join(near.repartition("of", "block").hint("merge"), ["of", "block"]).where(F.abs(F.col("j") - F.col("centre")) <= band)
    cells = met.select("of", "block", "i", "j", ratio.alias("r"))
    rows = cells.groupBy("of", "block", "i").agg(F.array_sort(F.collect_list(F.struct("j", "r")))["r"].alias("r")).join(sizes, "of").select("of", "i", "n", "m", centre.alias("centre"), "r")
    cost, wide, low = round(gap * MICRO), 2 * band + 1, round(least * MICRO)
    far = -(1 << 60)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, done = None, []
        for batch in batches:
            likenesses = batch.column(5)
            ends, values = likenesses.offsets.to_numpy(), likenesses.values.to_numpy()
            for at_row, (key_, i, n, m, centre) in enumerate(zip(*[c.to_pylist() for c in batch.columns[:5]])):
                if i == 1:
                    of, back, starts = key_, np.empty((n, wide), np.int8), np.empty(n, np.int64)
                    first, last = 0, np.concatenate([-cost * np.arange(min(m, band) + 1, dtype=np.int64), np.full(max(0, wide - min(m, band) - 1), far)])
                start = max(0, centre - band)
                width = min(m, centre + band) - start + 1
                up = np.full(width + 1, far)  # the scores of the row before at columns start - 1 and on
                a, b = max(start - 1, first), min(start + width, first + len(last))
                if b > a:
                    up[a - start + 1 : b - start + 1] = last[a - first : b - first]
                # the first cell of the first columns has no entry
                gain = np.zeros(width, np.int64)
                gain[max(0, 1 - start) :] = values[ends[at_row] : ends[at_row + 1]].astype(np.int64) - MICRO // 2
                diagonal = up[:-1] + gain
                if start == 0:
                    diagonal[0] = far
                best = np.maximum(diagonal, up[1:] - cost)
                steps = cost * np.arange(width, dtype=np.int64)
                score = np.maximum.accumulate(best + steps) - steps
                back[i - 1, :width] = np.where(score == diagonal, 0, np.where(score == up[1:] - cost, 1, 2))
                starts[i - 1] = start
                first, last = start, score
                if i == n:
                    k, j, found = n, m, []
                    while k and j:
                        way = back[k - 1, j - starts[k - 1]]
                        if way == 0:
                            found.append((of, k, j))
                            j -= 1
                        elif way == 2:
                            j -= 1
                            continue
                        k -= 1
                    done += found
            yield pa.RecordBatch.from_arrays([pa.array([d[c] for d in done], f.type) for c, f in enumerate(out)], schema=out)
            done = []

    schema = T.StructType([T.StructField("of", heads.schema[key].dataType), T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType())])
    out = to_arrow_schema(schema)
    pairs = rows.repartition("of").sortWithinPartitions("of", "i").mapInArrow(run, schema)
    pairs = pairs.join(h.select("of", "i", "head", "head_name"), ["of", "i"]).join(x, ["of", "j"]).select("of", "head", "entry", ratio.alias("r"))
    return pairs.where(F.col("r") >= low).select(F.col("of").alias(key), "head", "entry", (F.col("r") / MICRO).alias("ratio"))


def greedy_assignment(pairs: DataFrame, key: str) -> DataFrame:
    """pairs (key, a, b, score): the best first, each a and each b once; a volume (key) at a time."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        used_a, used_b, keep = set(), set(), []
        for i, a, b in rows.sort_values(["score", "a", "b"], ascending=[False, True, True])[["a", "b"]].itertuples():
            if a not in used_a and b not in used_b:
                used_a.add(a)
                used_b.add(b)
                keep.append(i)
        return rows.loc[keep]

    return pairs.groupBy(key).applyInPandas(run, pairs.schema)


def kin_of(item: Column, kin: dict[str, str]) -> tuple[Column, Column]:
    """(relation, rest): the longest word of `kin` that a mention begins with, and what stands behind it; without one null and the mention."""
    relation, rest = F.lit(None).cast("string"), item
    for word in sorted(kin, key=len):
        here = F.concat(item, F.lit(" ")).startswith(word + " ")
        relation = F.when(here, kin[word]).otherwise(relation)
        rest = F.when(here, F.trim(item.substr(F.lit(len(word) + 1), F.length(item)))).otherwise(rest)
    return relation, rest


def relation_mentions(df: DataFrame, text: str, pack) -> DataFrame:
    """Rows of df beside (no, role, rel, mention, kin, name) for every mention that a trigger of a language pack opens in a folded text.

    A mention reaches to the next trigger or the end of its clause. Titles before it and formulas behind it are
    off; what begins like no person is left out. All is one pass of expressions: triggers are marked in the
    text, the pieces between marks are rows. Null and empty texts give no rows; equal rows give equal ones.
    """
    any_trigger = "|".join(pack.JOINED + p for p, _, _ in pack.TRIGGERS)
    marked = F.regexp_replace(F.col(text), f"(?U){pack.BEFORE_TRIGGER}({any_trigger})", "\u0001$1\u0002")
    pieces = df.select(*df.columns, F.posexplode(F.split(marked, "\u0001")).alias("no", "_piece")).where(F.col("no") > 0)
    trigger, rest = F.split("_piece", "\u0002")[0], F.split("_piece", "\u0002")[1]
    # a look ahead of a rule needs what stands behind the trigger
    whole = F.regexp_replace("_piece", "\u0002", "")
    role, rel = F.lit(None).cast("string"), F.lit(None).cast("string")
    for pattern, a, b in reversed(pack.TRIGGERS):
        here = F.regexp_extract(whole, f"(?U)^({pack.JOINED}{pattern})", 1) == trigger
        role, rel = F.when(here, a).otherwise(role), F.when(here, b).otherwise(rel)
    d = pieces.select(*df.columns, "no", role.alias("role"), rel.alias("rel"), F.regexp_extract(F.concat(rest, F.lit("\n")), f"(?Us)^(.*?)(?:{pack.CLAUSE_END})", 1).alias("_clause"))
    bare = F.regexp_replace(F.rtrim(F.regexp_replace(F.trim("_clause"), "[ .،؛]+$", "")), f"(?U){pack.TAIL}", "")
    d = d.withColumn("mention", F.trim(F.regexp_replace(F.trim(bare), f"(?U){pack.TITLES}", ""))).drop("_clause")
    d = d.where((F.col("mention") != "") & ~F.col("mention").rlike(f"(?U){pack.NOT_PERSON}"))
    kin, name = kin_of(F.col("mention"), pack.KIN)
    return d.select(*df.columns, "no", "role", "rel", "mention", kin.alias("kin"), name.alias("name"))
