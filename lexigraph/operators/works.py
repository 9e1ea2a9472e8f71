"""Works: titles out of texts by cues of authorship, works by their names, links to the works that they build on."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from lexigraph.operators.graph import connected_components
from lexigraph.session import written

TITLES = "no int, title string, verb string, snippet string"


def title_table(pack):
    """A table function of a text: quoted titles that a cue of authorship, or a title before them in one list, gives to the text's subject.

    State between titles: whether the last one counted, and a generic head ("a commentary") that names the kind of the next.
    """
    quoted = re.compile(pack.QUOTED)
    cue, negative, listed, bad = (re.compile(x) for x in (pack.CUE, pack.NEGATIVE, pack.LISTED, pack.BAD_TITLE))

    class Titles:
        def eval(self, text: str):
            if not text:
                return
            last_end, counted, head, no = None, False, None, 0
            for m in quoted.finditer(text):
                title = " ".join(m[1].split()).strip(" ،,")
                plain = re.sub(pack.MARKS, "", title)
                before = text[max(0, m.start() - 70) : m.start()]
                clause = re.split(pack.CLAUSE, before)[-1]
                gap = text[last_end : m.start()] if last_end is not None else None
                said = cue.search(clause.strip())
                follows = counted and gap is not None and len(gap) < 45 and not re.search(pack.SENTENCE, gap) and not negative.search(gap)
                takes = follows or bool(listed.search(before)) or (said or re.search(pack.AUTHORSHIP, clause)) and not negative.search(clause[-30:])
                if head and gap is not None and gap.strip() == pack.ON:
                    title, takes, said = f"{head} {title}", True, None
                last_end = m.end()
                head = pack.GENERIC.get(plain) if takes else None
                counted = bool(takes) and not bad.search(title) and len(title.split()) <= 12 and plain not in pack.GENERIC and plain not in pack.NO_TITLE
                if counted:
                    verb = pack.VERBS.get(re.sub(pack.MARKS, "", said[1])) if said else None
                    yield no, title, verb, " ".join(text[max(0, m.start() - 60) : m.end() + 20].split())
                    no += 1

    return F.udtf(Titles, returnType=TITLES)


def titles_of(df: DataFrame, text: str, pack) -> DataFrame:
    """Rows of df beside (no, title, verb, snippet) of every title that its text gives its subject. Null texts give no rows."""
    return df.lateralJoin(title_table(pack)(F.col(text).outer()))


def works_graph(items: DataFrame, least: int = 5) -> DataFrame:
    """items (ord, author, names array<string>, kind, base_name) -> (work, author, kind, items, base).

    Items of an author that share a name are one work, and so on through their other names: components over
    (author, name), named by the smallest ord; that item's kind is the work's. A name that several works have means
    the one with the smallest ord. A base is looked up by its whole name, then by names that it begins with (a
    single word of at least `least` letters, or several words): of these the smallest ord; never the work itself. No step
    depends on the order of rows. Base names meet names by equi-joins on their beginnings; a hot name is one row in the join.
    Null authors are one author; items without names are works of their own. Items, and items with their works, are
    written once to the shared folder, so that what makes the items (which may be whole texts) runs once.
    """
    items = written(items.select("ord", "author", "names", "kind", "base_name"), "works-items")
    names = items.select("ord", F.coalesce(F.col("author").cast("string"), F.lit("")).alias("by"), F.explode("names").alias("name")).distinct()
    firsts = names.groupBy("by", "name").agg(F.min("ord").alias("first"))
    links = names.join(firsts, ["by", "name"]).where("ord <> first").select(F.col("ord").alias("src"), F.col("first").alias("dst"))
    parts = connected_components(links).select(F.col("node").alias("ord"), F.col("component").alias("c"))
    of = written(items.join(parts, "ord", "left").withColumn("work", F.coalesce("c", "ord")).drop("c"), "works-of-items")
    works = of.groupBy("work").agg(F.min_by(F.struct("author", "kind"), "ord").alias("x"), F.array_sort(F.collect_list("ord")).alias("items"))
    alias = of.select("work", F.explode("names").alias("name")).groupBy("name").agg(F.min("work").alias("base"))
    asked = of.where("base_name IS NOT NULL").groupBy("work").agg(F.min_by("base_name", "ord").alias("base_name"))
    exact = asked.join(alias, F.col("base_name") == F.col("name")).where("base <> work").select("work", "base")
    words = F.split("base_name", " ")
    begins = F.filter(F.transform(F.sequence(F.lit(1), F.size(words)), lambda k: F.array_join(F.slice(words, F.lit(1), k), " ")), lambda x: (x != F.col("base_name")) & (F.length(x) >= least))
    prefix = asked.select("work", F.explode(begins).alias("name")).join(alias, "name").where("base <> work").groupBy("work").agg(F.min("base").alias("prefix"))
    out = works.join(exact, "work", "left").join(prefix, "work", "left")
    return out.select("work", "x.author", "x.kind", "items", F.coalesce("base", "prefix").alias("base"))


def derived_title(title: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(kind, base title): ordered rules of a prefix (?P is not needed: what follows it) or, where the pattern ends in (.+)$, of an inner phrase."""
    kind, base = F.lit(None).cast("string"), F.lit(None).cast("string")
    for pattern, name in reversed(rules):
        whole = pattern if pattern.endswith("(.+)$") else f"{pattern}(.{{2,}})$"
        rest = F.regexp_extract(title, whole, 1)
        kind, base = F.when(rest != "", name).otherwise(kind), F.when(rest != "", rest).otherwise(base)
    return kind, base
