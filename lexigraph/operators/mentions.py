"""Mentions of teachers and students as a table function: one text in, many mentions out, with the last teacher as running state."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

SCHEMA = "no int, role string, rel string, name string, kin string, student string, via_chain boolean, xref string, snippet string"
#: Characters of a mention where no clause ends, and the most that one may have.
OPEN, LONGEST = 160, 600


class Item(NamedTuple):
    name: str
    xref: str | None


class Reader:
    """What a language pack makes of segments: items of a list, clean names, kin."""

    def __init__(self, pack, vocabulary: frozenset[str] = frozenset()):
        self.p, self.vocabulary = pack, vocabulary
        self.rules = [(re.compile(pack.BEFORE_TRIGGER + pack.JOINED + p), role, rel) for p, role, rel in pack.TRIGGERS]
        self.trigger = re.compile(pack.BEFORE_TRIGGER + pack.JOINED + "(?:" + "|".join(p for p, *_ in pack.TRIGGERS) + ")")
        self.end, self.between = re.compile(pack.CLAUSE_END), re.compile(rf"{pack.COMMA}?\s*\b{pack.OF} ")
        self.kin_words = sorted(pack.KIN, key=len, reverse=True)

    def begins(self, text: str, words) -> str:
        return next((w for w in words if text == w or text.startswith(w + " ")), "")

    def kin(self, name: str) -> tuple[str, str]:
        word = self.begins(name, self.kin_words)
        return (self.p.KIN[word], name[len(word) :].strip()) if word else ("", name)

    def joined(self, word: str, before: list[str]) -> bool:
        """Whether a word begins the next item because it carries an "and"."""
        p = self.p
        return bool(p.AND_PREFIX) and word.startswith(p.AND_PREFIX) and len(word) > 2 and word not in p.NO_AND and bool(before) and before[-1] not in p.NAME_START

    def items(self, segment: str) -> list[Item]:
        lists, p = [[]], self.p
        for word in segment.replace(p.COMMA, f" {p.COMMA} ").split():
            if word == p.COMMA or word == p.AND_WORD:
                lists.append([])
            elif self.joined(word, lists[-1]):
                lists.append([word[len(p.AND_PREFIX) :]])
            else:
                lists[-1].append(word)
        return [self.clean(" ".join(x)) for x in lists if x]

    def clean(self, text: str) -> Item:
        """A name without its reference, prepositions, formulas behind it, descriptions and titles."""
        p = self.p
        found = list(re.finditer(p.REFERENCE, text))
        titles = re.compile(rf"(?:{p.TITLES.removeprefix('^')})?\W*$")
        xref = found[-1][1] if found and titles.match(text[found[-1].end() :].strip() + " ") else None
        s = re.sub(r"[«»\"]", "", re.sub(p.REFERENCE, " ", text)).strip(" ،,()'-[]")
        s = re.sub(p.LEAD, "", s)
        first = s.split(" ")[0]
        if p.AND_PREFIX and first.startswith(p.AND_PREFIX) and len(first) > 2 and first not in p.NO_AND:
            s = s[len(p.AND_PREFIX) :]
        s = re.sub(p.TAIL, "", s.rstrip(" .،؛")).strip()
        s = re.split(f" {p.DESCRIBES}", s)[0]
        return Item(re.sub(p.TITLES, "", s).strip(), xref)

    def person(self, name: str) -> bool:
        p, words = self.p, name.split()
        if not words or len(words) > 14 or re.search(p.NOT_PERSON, name):
            return False
        if self.begins(name, self.kin_words) or any(re.search(x, name) for x in p.NAME_LIKE):
            return True
        return len(words) <= 3 and bool(re.search(p.SHORT_NAME_LIKE, name)) or len(words) <= 2 and words[0] in self.vocabulary

    def people(self, segment: str) -> list[Item]:
        """The names of a list up to the first item that is none; a reference that stands alone belongs to the name before it."""
        out: list[Item] = []
        found = self.items(segment)
        for k, item in enumerate(found):
            if out and re.match(self.p.DESCRIBES, item.name):
                break
            if item.xref and out and out[-1].xref is None and (not item.name or re.search(self.p.LATER, item.name)):
                out[-1] = Item(out[-1].name, item.xref)
            elif self.person(item.name):
                out.append(item)
            elif out and re.search(self.p.LIST_WORD, item.name) and k + 1 < len(found) and self.person(found[k + 1].name):
                out.append(item)  # one unknown word within a list of names
            elif out or len(item.name.split()) > 3:
                break
        return out

    def clauses(self, text: str) -> Iterator[tuple[str, str, str, str, str]]:
        """(trigger, role, relation, segment, snippet) of every trigger."""
        p = self.p
        for m in self.trigger.finditer(text):
            role, rel = next((role, rel) for rule, role, rel in self.rules if rule.match(text, m.start()))
            word = m[0].strip()
            before = text[max(0, m.start() - 120) : m.start()]
            if re.match(p.APPOSITION, word) and before.rstrip().endswith(p.COMMA) and re.search(p.VERBS, re.split("[.؛:]", before)[-1]):
                continue
            rest = re.sub(rf"^\s*[:{p.COMMA}]\s*", " ", text[m.end() :])
            if word.endswith(p.UPON) and rest.split()[:1] == [p.SON]:
                rest = p.UPON + rest
            end = self.end.search(rest)
            segment = rest[: end.start()] if end else rest[:OPEN]
            if len(segment) > LONGEST:
                segment = segment[:LONGEST].rsplit(" ", 1)[0]
            around = text[max(0, m.start() - 30) : m.end() + len(segment) + 10]
            yield word, role, rel, segment, re.sub(p.REFERENCE, " ", around).strip()

    def read(self, text: str) -> Iterator[tuple]:
        """Rows of SCHEMA without their number."""
        p, teacher = self.p, None
        opening = re.match(p.OPENING, text) if p.OPENING else None
        if opening:
            for item in self.people(re.split(p.OPENING_END, opening[1])[0])[:1]:
                yield ("teacher", "companion", *self.kin(item.name)[::-1], None, False, item.xref, text[:120])
        for word, role, rel, segment, snippet in self.clauses(text):
            links = [x.strip(f" {p.COMMA}") for x in self.between.split(" " + segment)]
            after_him = role == "student" and word.endswith(p.FROM_HIM) and not links[0] and len(links) > 1
            links = [x for x in links if x]
            if after_him:
                if teacher is None:
                    continue
                role = "teacher"
            if role == "teacher" and (after_him or len(links) > 1 and rel in p.CHAIN_OF_TWO or len(links) > 2 and rel in p.CHAIN_OF_THREE):
                student = teacher if after_him else None
                for link in links:
                    found = self.people(link)
                    if not found:
                        break
                    for item in found if student is None else found[:1]:
                        yield ("teacher" if student is None else "chain", rel, *self.kin(item.name)[::-1], student, True, item.xref, snippet)
                    if student is None:
                        teacher = found[0].name
                    student = found[0].name
                continue
            for item in self.people(links[0] if role == "student" and links else segment):
                yield (role, rel, *self.kin(item.name)[::-1], None, False, item.xref, snippet)
                if role == "teacher":
                    teacher = item.name


def mention_table(pack, vocabulary: frozenset[str] = frozenset(), stop: str | None = None):
    """A table function of a folded text with rows of SCHEMA. `stop` is where an entry goes over to what is not about its subject, as the chain of a transmission."""

    class Mentions:
        def __init__(self):
            self.reader = Reader(pack, vocabulary)

        def eval(self, text: str):
            if text:
                text = re.split(stop, text)[0] if stop else text
                for no, row in enumerate(self.reader.read(text)):
                    yield (no, *row)

    return F.udtf(Mentions, returnType=SCHEMA)


def mentions_of(df: DataFrame, text: str, pack, vocabulary: frozenset[str] = frozenset(), stop: str | None = None) -> DataFrame:
    """Rows of df beside every mention in a folded text, by a lateral join; null and empty texts give no rows, equal rows equal ones. Order is `no`."""
    return df.lateralJoin(mention_table(pack, vocabulary, stop)(F.col(text).outer()))
