"""Transliteration of names: words looked up by a join, put together by a transducer with states for case, article and compounds."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

RENDERED = "struct<full: string, short: string, missing: array<struct<kind: string, word: string>>>"


def name_words(name: Column, pack) -> Column:
    """The words of a name, marks and brackets off, compounds apart. Null names have none."""
    for pattern, by in pack.CLEAN:
        name = F.regexp_replace(name, pattern, by)
    words = F.split(name, pack.CUT)
    return F.filter(F.coalesce(words, F.array().cast("array<string>")), lambda w: (w != "") & ~w.rlike(pack.NO_WORD))


def lookups(words: Column) -> Column:
    """All terms that the transducer may ask for a list of words: each word, with and without article or a joined letter, and with the word or two behind it."""

    def of(i):
        w, two = F.element_at(words, i), F.array_join(F.slice(words, i, 2), " ")
        off = lambda c, k: c.substr(F.lit(k + 1), F.length(c))
        return F.array(w, off(w, 1), off(w, 2), off(w, 3), two, off(two, 1), off(two, 2), F.concat(two, F.lit(" #gen")), F.concat(F.lit("أبو "), F.try_element_at(words, i + 1)), F.concat(F.lit("أبو "), F.array_join(F.slice(words, i + 1, 2), " ")))

    some = F.transform(F.sequence(F.lit(1), F.size(words)), of)
    return F.when(F.size(words) > 0, F.array_distinct(F.filter(F.flatten(some), lambda x: x.isNotNull() & (x != "")))).otherwise(F.array().cast("array<string>"))


class Transducer:
    """One name: reads its words into honorifics, kunya, chain, nisbas and bynames, and writes them out. `look` holds what the lexicon has of this name's terms."""

    def __init__(self, words: list[str], look: dict[str, str], pack):
        self.w, self.look, self.p, self.missing = words, look, pack, []
        self.honorifics, self.kunya, self.chain, self.nisbas, self.bynames, self.known = [], None, [], [], [], False
        self.read()

    # reading

    def at(self, i: int) -> str:
        return self.w[i] if 0 <= i < len(self.w) else ""

    def article(self, w: str) -> bool:
        return w.startswith("ال") and len(w) > 3

    def nisba_like(self, w: str) -> bool:
        return self.article(w) and w.endswith("ي") and w not in self.p.TITLES

    def has(self, kind: str, term: str) -> bool:
        return f"{kind}:{term}" in self.look

    def unit(self, i: int) -> list[str]:
        """The words of the personal name at i: a servant compound, a kunya, or one word; none where no name begins."""
        w, p = self.at(i), self.p
        if w in p.FATHER and self.at(i + 1):
            return [w, *(self.unit(i + 1) if self.at(i + 1) in p.SERVANT else [self.at(i + 1)])]
        if w in p.SERVANT and self.at(i + 1):
            return [w, self.at(i + 1)]
        if self.at(i + 1) == p.GOD and self.has("ism", f"{w} {p.GOD}"):
            return [f"{w} {p.GOD}"]
        return [] if not w or w in p.TITLES | p.KNOWN_AS | p.STOP or w in p.SON else [w]

    def width(self, unit: list[str]) -> int:
        return sum(len(x.split(" ")) for x in unit)

    def read(self) -> None:
        i, rest = 0, []
        while i < len(self.w):
            for rule in (self.styled, self.honorific, self.father, self.lineage, self.family, self.plain):
                step = rule(i, rest)
                if step:
                    break
            if step < 0:
                break
            i += step
        if not self.chain and not self.bynames and not self.kunya and rest:
            self.bynames.append(" ".join(rest[:3]))

    def styled(self, i: int, _) -> int:
        """Behind "known as": a byname, or an honorific."""
        w, x, p = self.at(i), self.at(i + 1), self.p
        if w not in p.KNOWN_AS or not x or not (x.startswith("ب") or w in p.STYLED):
            return 0
        j = i + 1
        if x in ("ب", "بـ") and self.at(j + 1):
            j, x = j + 1, self.at(j + 1)
        heads = lambda y: any(k.startswith(f"laqab:{y} ") for k in self.look)
        if x.startswith("ب") and len(x) > 2 and not heads(x) and (w not in p.STYLED or x[1:3] == "ال" or self.has("ism", x[1:]) or heads(x[1:])):
            x = x[1:]
        name, after = [x], self.at(j + 1)
        if after in p.HONORIFIC or after in p.BYNAME or after and (x in p.SON or x in p.FATHER):
            name.append(after)
        if name[-1] in p.HONORIFIC:
            self.honorifics.append(" ".join(name))
        else:
            self.bynames.insert(0, " ".join(name))
            self.known = True
        return j - i + len(name)

    def honorific(self, i: int, _) -> int:
        w, x = self.at(i), self.at(i + 1)
        if not (x in self.p.HONORIFIC and not self.article(w) or x and self.has("laqab", f"{w} {x}")):
            return 0
        self.honorifics.append(f"{w} {x}")
        return 2

    def father(self, i: int, _) -> int:
        w = self.at(i)
        if self.kunya or w not in (self.p.FATHER if i == 0 else self.p.FATHER[:2]):
            return 0
        self.kunya = self.unit(i)
        return self.width(self.kunya)

    def lineage(self, i: int, _) -> int:
        """The first chain: a name and the names behind each "son of"."""
        if self.chain or self.nisba_like(self.at(i)) or self.article(self.at(i)) and self.at(i).endswith("ي"):
            return 0
        unit, j = self.unit(i), i
        if not unit:
            return 0
        chain = []
        while unit:
            chain.append(unit)
            j += self.width(unit)
            unit = self.unit(j + 1) if self.at(j) in self.p.SON else []
            j += bool(unit)
        if len(chain) == 1 and self.article(self.at(i)):
            return 0
        self.chain = chain
        return j - i

    def family(self, i: int, _) -> int:
        """A later "son of": a byname; of a title, the rest describes the father."""
        x = self.at(i + 1)
        if self.at(i) != self.p.SON[1] or not x:
            return 0
        if self.chain and (x in self.p.TITLES or x in self.p.OF_A_FATHER):
            return -1
        unit = self.unit(i + 1) or [x]
        self.bynames.append(" ".join([self.p.SON[1], *unit]))
        return 1 + self.width(unit)

    def plain(self, i: int, rest: list[str]) -> int:
        w = self.at(i)
        if self.nisba_like(w):
            self.nisbas.append(w)
        elif self.at(i + 1) == "زاده":
            self.bynames.append(f"{w} زاده")
            return 2
        elif w not in self.p.TITLES and w not in self.p.STOP:
            rest.append(w)
        return 1

    # writing

    def find(self, kind: str, *terms: str) -> str:
        """The first of the terms that the lexicon has; empty where it is silent or has none, which is then missing."""
        for t in terms:
            if t and self.has(kind, t):
                v = self.look[f"{kind}:{t}"]
                return "" if v == "-" else v
        self.missing.append((kind, terms[0]))
        return ""

    def bare(self, w: str) -> str:
        return w[2:] if self.article(w) else ""

    def assimilated(self, w: str) -> str:
        k = self.p.SUN.find(w[2:3]) if self.article(w) else -1
        return self.p.SUN_TR[k] if k >= 0 else "l"

    def personal(self, unit: list[str], genitive: bool) -> str:
        head, *more = unit
        if head in self.p.FATHER and more:
            whole = "أبو " + " ".join(more)
            if self.has("kunya", whole):
                v = self.look[f"kunya:{whole}"]
                return v.replace("Ebû", "Ebî").replace("Ebü’l-", "Ebi’l-") if genitive else v
            stem = self.personal(more, True) if more[0] in self.p.SERVANT else self.find("ism", more[0], self.bare(more[0]))
            if not stem:
                return ""
            if self.article(more[0]):
                letter = self.assimilated(more[0])
                return f"{'Ebi' if genitive else 'Ebü'}’{letter}-{stem}"
            return f"{'Ebî' if genitive else 'Ebû'} {stem}"
        if head in self.p.SERVANT and more:
            whole = " ".join(unit) + (" #gen" if genitive else "")
            if self.has("ism", whole):
                return self.look[f"ism:{whole}"]
            stem = self.find("ism", self.bare(more[0]) or more[0])
            if not stem:
                return ""
            first, stem = ("Ubeyd", "u") if head == self.p.SERVANT[1] else ("Abd", "ü"), {"İ": "i", "I": "ı"}.get(stem[0], stem[0].lower()) + stem[1:]
            if self.article(more[0]):
                return f"{first[0]}{'i' if genitive else first[1]}{self.assimilated(more[0])}{stem}"
            return f"{first[0]}{'i' if genitive else 'ü'}{stem}"
        return self.find("ism", head, self.bare(head))

    def nisba(self, w: str) -> str:
        stem = self.find("nisba", self.bare(w), w)
        return stem if not stem or re.match("el?.?-", stem) else f"e{self.assimilated(w)}-{stem}"

    def byname(self, s: str) -> str:
        if self.has("laqab", s):
            return self.find("laqab", s)
        w = s.split(" ")
        if w[0] == self.p.SON[1] and len(w) > 1:
            if w[1] in self.p.FATHER or w[1] in self.p.SERVANT:
                x = self.personal(w[1:], True)
                return x and f"İbn {x}"
            if self.article(w[1]):
                stem = self.look.get(f"ism:{w[1][2:]}") or self.find("nisba", w[1][2:])
                return stem and f"İbnü’{self.assimilated(w[1])}-{stem}"
            stem = self.find("ism", w[1])
            return stem and f"İbn {stem}"
        if w[-1] == "زاده":
            stem = self.find("ism", w[0])
            return stem and f"{stem}zâde"
        out = [self.look.get(f"ism:{x}") or (self.nisba(x) if self.article(x) else self.find("ism", x)) for x in w]
        return " ".join(out) if all(out) else ""

    def write(self) -> tuple[str, str, list[tuple[str, str]]]:
        honour = next((x for x in (self.find("laqab", s, s[1:], s[2:]) for s in self.honorifics) if x), "")
        kunya = self.personal(self.kunya, False) if self.kunya else ""
        chain = []
        for k, unit in enumerate(self.chain[:3]):
            x = self.personal(unit, k > 0)
            if not x:
                break
            chain.append(x)
        nisbas = [x for x in map(self.nisba, dict.fromkeys(self.nisbas)) if x][:3]
        byname = self.byname(self.bynames[0]) if self.bynames else ""
        alone = lambda x: x if " " in x else re.sub("^e[lstşzdrn]-", "", x)
        large = lambda x: {"i": "İ", "ı": "I"}.get(x[:1], x[:1].upper()) + x[1:]
        full = large(alone(" ".join(x for x in (honour, kunya, " b. ".join(chain), *nisbas, "" if chain or kunya else byname) if x)))
        lead = honour or kunya or (chain[0] if chain else "")
        short = byname if byname and (self.known or not lead.strip() or not (chain or kunya)) else f"{lead} {nisbas[-1]}" if lead and nisbas else " b. ".join(chain[:2]) if chain else full
        short = large(alone(short))
        return full or short, short, self.missing


def transliterated(df: DataFrame, id_col: str, name_col: str, lexicon: DataFrame, pack, overrides: DataFrame | None = None) -> DataFrame:
    """(id, full, short, missing array<struct<kind, word>>) of every row; lexicon is (kind ism | nisba | laqab | kunya, term, value), value - for silent terms.

    Terms are exploded, joined with the lexicon and gathered a name at a time, so the lexicon may be of any
    size; the transducer sees the part that its name asks for. overrides (id, full, short) win where they are not null. Null and empty names give empty ones. Ids are unique.
    """
    d = df.select(F.col(id_col).alias("id"), name_words(F.col(name_col), pack).alias("words"))
    asked = d.select("id", F.explode(lookups(F.col("words"))).alias("term")).join(lexicon.select("term", F.concat("kind", F.lit(":"), "term").alias("key"), "value"), "term")
    found = asked.groupBy("id").agg(F.map_from_entries(F.collect_set(F.struct("key", "value"))).alias("look"))

    @F.pandas_udf(RENDERED)
    def write(words: pd.Series, look: pd.Series) -> pd.DataFrame:
        made = [Transducer(list(w), dict(x) if x is not None else {}, pack).write() for w, x in zip(words, look)]
        return pd.DataFrame(made, columns=["full", "short", "missing"])

    d = d.join(found, "id", "left").select("id", write("words", "look").alias("x")).select("id", "x.full", "x.short", "x.missing")
    if overrides is None:
        return d
    o = overrides.select(F.col("id"), F.col("full").alias("o_full"), F.col("short").alias("o_short"))
    return d.join(o, "id", "left").select("id", F.coalesce("o_full", "full").alias("full"), F.coalesce("o_short", "o_full", "short").alias("short"), "missing")


def missing_words(names: DataFrame) -> DataFrame:
    """(kind, word, n): the words that the lexicon lacks, most wanted first."""
    return names.select(F.explode("missing").alias("m")).groupBy("m.kind", "m.word").agg(F.count("*").alias("n"))
