"""Parts of names: a chain of forefathers, kunya, nisbas, honorifics, by a language pack."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lexigraph.operators.extract import NAME


class NameParts:
    """One folded name. The first part with a "son of" holds the chain; what else it and the other parts say is sorted by its form."""

    def __init__(self, text: str, pack):
        self.p, self.chain, self.kunya, self.nisbas, self.honorifics = pack, [], "", set(), set()
        parts = [x.split() for x in re.split("[،,؛]", re.sub(pack.REPEATS, " ", re.sub(r"[«»\"'()\[\]]", " ", text))) if x.strip()]
        main = next((k for k, words in enumerate(parts) if any(w in pack.SON for w in words[:-1])), 0)
        for k, words in enumerate(parts):
            if k == main:
                self.read_chain(words)
            else:
                for unit in self.units(words):
                    self.sort_out(unit)

    def nisba_like(self, u: str) -> bool:
        return u.startswith(self.p.ARTICLE) and u.endswith(self.p.NISBA_END) and " " not in u and len(u) > 4

    def honorific(self, u: str) -> bool:
        return u.rsplit(" ", 1)[-1] in self.p.HONORIFIC and " " in u and not u.startswith((self.p.SERVANT + " ", self.p.FATHER + " "))

    def father(self, u: str) -> bool:
        return u.startswith(self.p.FATHER + " ")

    def units(self, words: list[str]) -> Iterator[str]:
        """Words joined to names: servants, kunyas (also of a kunya or a servant), honorifics."""
        p, i = self.p, 0
        while i < len(words):
            w, x, y = (words[k] if k < len(words) else "" for k in (i, i + 1, i + 2))
            if w in p.COMPOUND and x:
                head = p.FATHER if w == p.GENITIVE_FATHER else w
                deep = y and x in (p.SERVANT, p.FATHER, p.GENITIVE_FATHER)
                yield f"{head} {p.GENITIVE_FATHER if x == p.FATHER and deep else x}" + (f" {y}" if deep else "")
                i += 3 if deep else 2
            elif x in p.HONORIFIC or w == p.SMALL_SERVANT and x in p.OF_GOD:
                yield f"{w} {x}"
                i += 2
            else:
                yield f"{p.SERVANT} {w[len(p.SERVANT):]}" if w.startswith(p.SERVANT + p.ARTICLE) else w
                i += 1

    def read_chain(self, words: list[str]) -> None:
        p, segments = self.p, [[]]
        for k, w in enumerate(words):
            # behind an honorific or a nisba, and at the beginning, "son of" is a byname
            byname = w == p.SON[1] and (k == 0 or words[k - 1] in p.HONORIFIC or self.nisba_like(words[k - 1]))
            if w in (*p.SON, p.DAUGHTER) and not byname:
                segments.append([])
            else:
                segments[-1].append(w)
        for k, segment in enumerate(segments):
            units = [u for u in self.units(segment) if u not in p.TITLES]
            if k == 0:
                while len(units) > 1 and (self.father(units[0]) or self.honorific(units[0])):
                    self.sort_out(units.pop(0))
                if len(segments) == 1 and units:
                    if self.father(units[0]) and not self.kunya:
                        self.kunya = units.pop(0)
                    named = bool(self.kunya or self.honorifics)
                    form = lambda u: self.nisba_like(u) or named and u.startswith(p.ARTICLE) or u.startswith(p.SON[1] + " ")
                    for u in filter(form, units):
                        self.sort_out(u)
                    units = [u for u in units if not form(u)]
            if units:
                self.chain.append(units[0])
                for u in units[1:]:
                    self.sort_out(u)

    def sort_out(self, u: str) -> None:
        p = self.p
        if self.father(u):
            self.kunya = self.kunya or u
        elif self.honorific(u):
            self.honorifics.add(u)
        elif self.nisba_like(u):
            if u not in p.TITLES and u not in p.WEAK_NISBAS:
                self.nisbas.add(u)
        elif u.startswith(p.SON[1] + " ") and u.split(" ", 1)[1] not in p.TITLES:
            self.nisbas.add(u)


def with_name_parts(df: DataFrame, name: str, pack, out: str = "parts") -> DataFrame:
    """df with `out` struct<chain, kunya, nisbas, laqabs> of a folded name; sets are sorted. Null and empty names give empty parts."""

    @F.pandas_udf(NAME)
    def parse(names: pd.Series) -> pd.DataFrame:
        made = [NameParts(n or "", pack) for n in names]
        return pd.DataFrame([(m.chain, m.kunya, sorted(m.nisbas), sorted(m.honorifics)) for m in made], columns=["chain", "kunya", "nisbas", "laqabs"])

    return df.withColumn(out, parse(F.col(name)))


def name_variants(df: DataFrame, key: str, names: list[str], pack) -> DataFrame:
    """(key, names array<NAME>): the parts of every form of a record's name (heading, lead of the text, override), each different one once, in the order of the columns; forms without parts are left out."""
    forms = df.select(key, F.posexplode(F.array(*names)).alias("at", "form")).where("form IS NOT NULL")
    parsed = with_name_parts(forms, "form", pack)
    some = (F.size("parts.chain") > 0) | (F.coalesce("parts.kunya", F.lit("")) != "") | (F.size("parts.nisbas") > 0) | (F.size("parts.laqabs") > 0)
    once = parsed.where(some).groupBy(key, "parts").agg(F.min("at").alias("at"))
    return once.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "parts")))["parts"].alias("names"))


def first_name_counts(names: DataFrame) -> DataFrame:
    """(first, n): in how many records (key, names) a first name begins a chain: the side table of frequencies that scores and vocabularies use."""
    return names.select(F.explode(F.array_distinct(F.transform(F.filter("names", lambda n: F.size(n["chain"]) > 0), lambda n: n["chain"][0]))).alias("first")).groupBy("first").agg(F.count("*").alias("n"))
