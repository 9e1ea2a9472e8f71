"""Operator 8: BPE encoding and decoding with a tokenization automaton.

The merges are compiled, in order, by merge gadgets: the automaton first has one state with an arc to
itself for every symbol; the gadget for a merge (u, v) splits off the state that u leads to, takes the
arc v from it, and adds an arc for the merged token beside every arc u. A sequence of tokens is what BPE
makes of its text exactly if the automaton has a path for it, so that a word is encoded by following arcs.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata

import numpy as np
import regex
from pyspark.sql import DataFrame, functions as F

from lexigraph.llm.common import map_columns

#: Words whose ids a worker remembers, in each of two generations.
REMEMBERED = 120_000
LONGEST_REMEMBERED = 60
END = "</w>"
#: The word patterns of the vocabulary file; white space is left out.
_WHITE = r"\t-\r\x20\x85\xa0  -     　"
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_WHITE}\p{{L}}\p{{N}}]+")
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r\x20a-z0-9]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary: itself where it is one, else the next from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Automaton:
    """The tokenization automaton of a vocabulary file with BPE merges and word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocab: dict[str, int] = file["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.labels = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for text, i in [*vocab.items(), *self.special.items()]:
            self.labels[i] = text
        n = len(self.labels)
        # state 0 is the start; every symbol leads to state 1 at first. A state that is split off keeps what its origin lacked by then
        self.state = [1] * n
        self.origin, self.since = [-1, -1], [0, 0]
        self.lacks: dict[int, int] = {}  # state * n + token: the merge that took the arc
        self.left, self.born = [-1] * n, [-1] * n
        self.n = n
        into = [0, n]
        for rank, merge in enumerate(file["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            old, onward = self.state[u], self.state[v]
            if not self._follows(old, v):
                continue  # earlier merges have left no such pair, so the gadget changes nothing
            if into[old] > 1 or u == v:  # a doubled symbol may still be followed by itself, so its token keeps the old state
                into[old] -= 1
                into.append(1)
                self.state[u] = len(self.origin)
                self.origin.append(old)
                self.since.append(rank)
            self.lacks[self.state[u] * n + v] = rank
            self.left[w], self.born[w] = u, rank
            into[self.state[w]] -= 1
            self.state[w] = onward
            into[onward] += 1
        symbols = byte_symbols()
        back = {c: chr(b) for b, c in enumerate(symbols)}
        reach = [t for t in vocab if self.born[vocab[t]] >= 0 or len(t.removesuffix(END)) == 1]
        self.inner = {"".join(back[c] for c in t): vocab[t] for t in reach if not t.endswith(END)}
        self.final = {"".join(back[c] for c in t.removesuffix(END)): vocab[t] for t in reach if t.endswith(END)}
        self.longest = max(map(len, self.inner), default=1)
        self.longest_final = max(map(len, self.final), default=1)
        self.table: dict[int, bool] = {}  # arcs that have been looked up: state * n + token

    def _follows(self, state: int, token: int) -> bool:
        """Whether state has an arc for token: no merge took it, nor took the arc of the token's left part before the token was made."""
        before = 1 << 62
        while state >= 0:
            t, limit = token, before
            while t >= 0:
                rank = self.lacks.get(state * self.n + t)
                if rank is not None and rank < before and rank <= limit:
                    return False
                if self.born[t] >= 0:
                    limit = min(limit, self.born[t])
                t = self.left[t]
            before = min(before, self.since[state])
            state = self.origin[state]
        return True

    def arc(self, state: int, token: int) -> bool:
        """The same from the table of arcs, which fills as words are met."""
        key = state * self.n + token
        known = self.table.get(key)
        if known is None:
            if len(self.table) >= REMEMBERED * 2:
                self.table.clear()
            known = self.table[key] = self._follows(state, token)
        return known

    def encode_word(self, word: str) -> list[int]:
        """Ids of a word whose characters are bytes: the one path of arcs that spells it. Long arcs are tried first; a place that no path leaves is not tried again."""
        inner, final, state, arc, n = self.inner, self.final, self.state, self.arc, len(word)
        path: list[tuple[int, int, int, int]] = []  # token, and where, with what length and in which state it was taken
        dead: set[int] = set()
        at, here, size = 0, 0, n
        while True:
            if size >= n - at:
                t = final.get(word[at:]) if n - at <= self.longest_final else None
                if t is not None and arc(here, t):
                    return [p[0] for p in path] + [t]
                size = n - at - 1
            for k in range(min(size, self.longest), 0, -1):
                t = inner.get(word[at : at + k])
                if t is not None and at + k not in dead and arc(here, t):
                    path.append((t, at, k, here))
                    at, here, size = at + k, state[t], n
                    break
            else:
                if not path:
                    raise ValueError(f"the vocabulary lacks a byte of {word!r}")
                dead.add(at)
                _, at, size, here = path.pop()
                size -= 1

    def decode(self, ids) -> str:
        """The labels of the arcs, joined as the vocabulary's library does without a decoder."""
        return " ".join([self.labels[i] for i in ids])


class Encoder:
    """Texts to ids: special strings, NFC, lower case, words, then the automaton."""

    def __init__(self, path: str):
        self.automaton = Automaton(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.special = re.compile("|".join(map(re.escape, sorted(self.automaton.special, key=len, reverse=True)))) if self.automaton.special else None

    def _word(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            ids = self.automaton.encode_word(word if word.isascii() else word.encode("utf-8", "surrogatepass").decode("latin-1"))
            out = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {}
            self.known[word] = out
        return out

    def _plain(self, text: str) -> bytes:
        if text.isascii():
            words = ASCII_WORDS.findall(text.lower())
        else:
            text = unicodedata.normalize("NFC", text)
            # character by character: no rule for a sigma at the end of a word
            words = WORDS.findall(text.replace("Σ", "σ").lower())
        word = self._word
        return b"".join([self.known.get(w) or word(w) for w in words])

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [self._plain(text[at : m.start()]), np.uint32(self.automaton.special[m[0]]).tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids binary): the ids of each whole text, little-endian unsigned 32-bit. Null and empty texts have none; repeated rows give equal results; an empty table gives an empty result. The file must be at `path` on every executor."""
    path = path or vocabulary()

    def run(rows, texts):
        e = encoder(path)
        return [rows, [e.encode(t) if t else b"" for t in texts]]

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_columns(picked, run, f"doc_id {picked.schema[0].dataType.simpleString()}, ids binary")


def decode_ids(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): the text that the ids stand for; null ids decode to the empty text."""
    path = path or vocabulary()

    def run(rows, ids):
        a = encoder(path).automaton
        return [rows, ids, [a.decode(np.frombuffer(i or b"", "<u4").tolist()) for i in ids]]

    picked = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return map_columns(picked, run, f"doc_id {picked.schema[0].dataType.simpleString()}, ids binary, decoded string")


def encode_and_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): encode_texts and decode_ids by one automaton, so that a task holds one and not two."""
    path = path or vocabulary()

    def run(rows, texts):
        e = encoder(path)
        ids = [e.encode(t) if t else b"" for t in texts]
        return [rows, ids, [e.automaton.decode(np.frombuffer(i, "<u4").tolist()) for i in ids]]

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_columns(picked, run, f"doc_id {picked.schema[0].dataType.simpleString()}, ids binary, decoded string", most=1 << 20)


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text."""
    both = encode_and_decode(docs, path=path)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op8_bpe(spark, sf_dir: str) -> DataFrame:
    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
