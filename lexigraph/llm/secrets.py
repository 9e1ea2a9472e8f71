"""Operator 3: secret scans. Keyword automaton first, anchored patterns at its hits, then embedded checksums."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib

import ahocorasick
from pyspark.sql import DataFrame, functions as F

from lexigraph.llm.common import map_columns

#: The kinds in their order, and what an assignment is named by.
KINDS = ("assign", "access", "hex", "checked", "wif")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
#: Tokens with an embedded checksum: a prefix, 30 random characters and the CRC-32 of those in six base-62 digits.
CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
CHECKED = re.compile(rb"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Wallet import format: base 58 with four bytes of double SHA-256 at its end.
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
WIF = re.compile(rb"(?<![A-Za-z0-9])(?:5[HJK][1-9A-HJ-NP-Za-km-z]{49}|[KL][1-9A-HJ-NP-Za-km-z]{51})(?![A-Za-z0-9])")
LEAST = {"assign": 12, "access": 18, "hex": 16}
#: Hits of the automaton for hexadecimal runs: every run of 16 begins with one of these.
HEX_GRAM = 4


def base62(n: int, digits: int = 6) -> str:
    out = ""
    for _ in range(digits):
        n, r = divmod(n, 62)
        out = BASE62[r] + out
    return out


def checksum_holds(body: bytes, check: bytes) -> bool:
    return base62(zlib.crc32(body)).encode() == check


def wif_holds(text: bytes) -> bool:
    n = 0
    for c in text.decode():
        n = n * 58 + BASE58.index(c)
    size = 37 if text[:1] == b"5" else 38
    if n >> (8 * size):
        return False
    raw = n.to_bytes(size, "big")
    return raw[0] == 0x80 and hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


_AUTOMATON: list = []


def automaton():
    """One automaton for all keywords, built once a worker. Assignment names are matched on a lower-cased copy, the others on the text."""
    if not _AUTOMATON:
        folded, exact = ahocorasick.Automaton(), ahocorasick.Automaton()
        for w in NAMES:
            folded.add_word(w, ("assign", len(w)))
        exact.add_word("AKIA", ("access", 4))
        for w in CHECKED_PREFIXES:
            exact.add_word(w, ("checked", len(w)))
        for w in map("".join, itertools.product("0123456789abcdef", repeat=HEX_GRAM)):
            exact.add_word(w, ("hex", HEX_GRAM))
        for w in ("5H", "5J", "5K"):
            exact.add_word(w, ("wif", 2))
        for w in map("".join, itertools.product("KL", BASE58[9:33])):  # capital after K or L; the others follow a digit or a small letter
            exact.add_word(w, ("wif", 2))
        for w in map("".join, itertools.product("KL", BASE58[:9] + BASE58[33:])):
            exact.add_word(w, ("wif", 2))
        folded.make_automaton()
        exact.make_automaton()
        _AUTOMATON.extend((folded, exact))
    return _AUTOMATON


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then by kind.

    Base kinds take leftmost non-overlapping matches; a match that is too short is dropped, and the scan goes
    on behind it. The automaton reports hits in the order of their ends, which is that of their starts for
    each kind, so that the first hit at or behind the last match is where the next leftmost match can begin.
    """
    data = text.encode("utf-8", "surrogatepass")
    wide = data.decode("latin-1")
    folded, exact = automaton()
    found: list[tuple[int, int, int]] = []
    done = dict.fromkeys(KINDS, 0)
    for end, (kind, size) in itertools.chain(folded.iter(data.lower().decode("latin-1")), exact.iter(wide)):
        start = end - size + 1
        if start < done[kind]:
            continue
        if kind == "assign":
            if m := ASSIGN.match(data, start):
                done[kind] = m.end()
                if m.end(1) - m.start(1) >= LEAST[kind]:
                    found.append((start, 0, m.end()))
        elif kind == "access":
            m = ACCESS.match(data, start)
            if m is not None:
                done[kind] = m.end()
                if m.end() - start >= LEAST[kind]:
                    found.append((start, 1, m.end()))
        elif kind == "hex":
            done[kind] = stop = HEX.match(data, start).end()
            if stop - start >= LEAST[kind]:
                found.append((start, 2, stop))
        elif kind == "checked":
            if (m := CHECKED.match(data, start)) and checksum_holds(m[1], m[2]):
                done[kind] = m.end()
                found.append((start, 3, m.end()))
        elif (m := WIF.match(data, start)) and wif_holds(m[0]):
            done[kind] = m.end()
            found.append((start, 4, m.end()))
    found.sort()
    if len(data) == len(text):
        return [(KINDS[k], a, b) for a, k, b in found]
    out, at, points = [], 0, 0
    for a, k, b in found:
        if a < at:
            at, points = 0, 0
        points += len(data[at:a].decode("utf-8", "surrogatepass"))
        at = a
        out.append((KINDS[k], points, points + len(data[a:b].decode("utf-8", "surrogatepass"))))
    return out


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, secrets array<struct<kind, start, end>>) for every row; offsets are code points, ends exclusive.

    Kinds assign, access and hex are found by form; checked (prefixed tokens) and wif (wallet keys) only where
    the checksum in the match holds. Null and empty texts have none; repeated rows give equal results; whole
    texts are scanned; an empty table gives an empty result. Other columns are not read.
    """

    def run(ids, texts):
        return [ids, [[{"kind": k, "start": a, "end": b} for k, a, b in scan(t)] if t else [] for t in texts]]

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_columns(picked, run, f"doc_id {picked.schema[0].dataType.simpleString()}, secrets array<struct<kind:string,start:long,end:long>>")


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    s = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind):
        return F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")

    base = F.filter("secrets", lambda x: x["kind"].isin("assign", "access", "hex"))
    return s.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
