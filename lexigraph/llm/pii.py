"""Operator 9: personal data by bootstrapped contextual extraction.

Seeds (matches of the base patterns) show which word contexts surround personal data. Spark scores the
bipartite graph of contexts and instances in rounds; contexts of high confidence mark identifiers that no
base pattern takes.
"""

from __future__ import annotations

import bisect
import re

import xxhash
from pyspark.sql import DataFrame, functions as F

from lexigraph.llm.common import map_columns
from lexigraph.session import checkpointed, written

#: The base kinds in their order and their patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a run of digits that fails at its start fails everywhere in it
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Tokens that may be identifiers: runs of letters, digits and joining marks without the marks at their ends, of so many characters, with an at sign or three digits.
TOKEN = re.compile(r"[A-Za-z0-9@._+()/#:-]+")
SHORTEST, LONGEST = 6, 64
#: Rounds of scoring; confidence and number of different instances that a context needs; score of an accepted instance.
ROUNDS, CONFIDENCE, SUPPORT, ACCEPT = 3, 0.8, 8, 0.8


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """The matches of EMAIL, in linear time: each at sign is tried with the whole run of characters before it."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        run = LOCAL.match(text[last:at][::-1])
        m = EMAIL.match(text, at - run.end()) if run else None
        if m:
            out.append((m.start(), m.end()))
        last = m.end() if m else at + 1
        at = text.find("@", last)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind and start, in code points; matches that fail their test are dropped without a retry."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(q := p.lstrip("0")) <= 3 and int(q or "0") <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


_WORD = re.compile(r"[^\W\d_]+")


class Contexts:
    """The lexical patterns of a text: the two words before a span and the mark, of at most four characters, that joins them to it."""

    def __init__(self, text: str):
        self.text = text
        self.words = [m.span() for m in _WORD.finditer(text)]
        self.ends = [b for _, b in self.words]

    def before(self, start: int) -> str | None:
        """None without a word there. Words are whole, however long."""
        k = bisect.bisect_right(self.ends, start)
        if not k or start - self.ends[k - 1] > 4:
            return None
        joint = self.text[self.ends[k - 1] : start].strip() or "_"
        return " ".join([*(self.text[a:b].lower() for a, b in self.words[max(0, k - 2) : k]), joint])


def candidates(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Whole tokens that may be identifiers and that no span touches, in one sweep over tokens and spans. Tokens outside SHORTEST to LONGEST are none."""
    taken = sorted((a, b) for _, a, b in spans)
    out, k, reach = [], 0, 0
    for m in TOKEN.finditer(text):
        s = m[0].lstrip("@._)/#:-").rstrip("@._+(/#:-")
        start = m.end() - len(m[0].lstrip("@._)/#:-"))
        end = start + len(s)
        if not SHORTEST <= len(s) <= LONGEST or not ("@" in s or sum(c.isdigit() for c in s) >= 3):
            continue
        while k < len(taken) and taken[k][0] < end:
            reach = max(reach, taken[k][1])
            k += 1
        if reach <= start:
            out.append((start, end))
    return out


_HAS_DIGIT = re.compile(r"[0-9@]")


def extract_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, base array<struct<kind, start, end>>, found array<struct<kind, start, end>>), offsets in code points.

    base: the four base kinds by kind and start. found: spans of kind `context` that no base pattern takes,
    in a context whose confidence is at least `confidence` with `support` different instances.

    Confidence of a context is the mean score of its instances; a seed scores 1, another instance the mean
    confidence of its contexts, at first 0. One scan of the texts writes what it found to the shared folder;
    the rounds are joins and aggregations over that table. Instances travel as 64-bit hashes.

    Null and empty texts have no spans; repeated rows give equal results (instances count once); an empty
    table gives an empty result. Other columns are not read.
    """

    def run(ids, texts):
        base_col, seen_col = [], []
        for t in texts:
            if not t or not _HAS_DIGIT.search(t):
                base_col.append([])
                seen_col.append([])
                continue
            spans = base_spans(t)
            base_col.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            seen = []
            open_spans = candidates(t, spans)
            contexts = Contexts(t) if spans or open_spans else None
            for known, pairs in ((True, [(a, b) for _, a, b in spans]), (False, open_spans)):
                for a, b in pairs:
                    if c := contexts.before(a):
                        seen.append({"known": known, "start": a, "end": b, "pattern": xxhash.xxh3_64_intdigest(c) >> 1, "instance": xxhash.xxh3_64_intdigest(t[a:b].lower()) >> 1})
            seen_col.append(seen)
        return [ids, base_col, seen_col]

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {picked.schema[0].dataType.simpleString()}, base array<struct<kind:string,start:long,end:long>>, seen array<struct<known:boolean,start:long,end:long,pattern:long,instance:long>>"
    scanned = written(map_columns(picked, run, schema), "pii-scan")

    rows = scanned.select(F.explode("seen").alias("s")).select("s.known", "s.pattern", "s.instance")
    edges = checkpointed(rows.groupBy("pattern", "instance").agg(F.max(F.col("known").cast("double")).alias("seed")))
    scores = edges.groupBy("instance").agg(F.max("seed").alias("score"))
    for _ in range(rounds):
        patterns = edges.join(scores, "instance").groupBy("pattern").agg(F.avg("score").alias("confidence"), F.count("*").alias("n"))
        scored = edges.join(patterns, "pattern").groupBy("instance").agg(F.max("seed").alias("seed"), F.avg(F.when(F.col("n") >= support, F.col("confidence")).otherwise(0.0)).alias("reached"))
        scores = scored.select("instance", F.greatest("seed", "reached").alias("score"))
        patterns, scores = checkpointed(patterns), checkpointed(scores)
    good = patterns.where((F.col("confidence") >= confidence) & (F.col("n") >= support)).select("pattern")
    sure = edges.where("seed = 0").join(good, "pattern", "left_semi").join(scores.where(F.col("score") >= accept), "instance", "left_semi").select("pattern", "instance")

    keyed = scanned.select("doc_id", "base", F.filter("seen", lambda x: ~x["known"]).alias("open"), F.xxhash64("base", "seen").alias("row"))
    open_rows = keyed.where(F.size("open") > 0).select("doc_id", "row", F.explode("open").alias("o")).select("doc_id", "row", "o.start", "o.end", "o.pattern", "o.instance")
    hits = open_rows.join(sure, ["pattern", "instance"], "left_semi").groupBy(F.col("doc_id").alias("h_id"), F.col("row").alias("h_row"))
    hits = hits.agg(F.sort_array(F.collect_set(F.struct(F.lit("context").alias("kind"), "start", "end"))).alias("found"))
    joined = keyed.join(hits, keyed["doc_id"].eqNullSafe(hits["h_id"]) & (keyed["row"] == hits["h_row"]), "left")
    return joined.select("doc_id", "base", F.coalesce("found", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")).alias("found"))


def op9_personal_data(spark, sf_dir: str) -> DataFrame:
    d = extract_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return d.select("doc_id", *map(count, KINDS), F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.concat("base", "found")).alias("spans"))
