"""Operator 4: document fingerprints. A Merkle tree over sections, paragraphs and pieces of sentences.

Leaves are pieces of at most six words that end with their sentence, paragraphs are lines, and a section
ends at a blank line or where a paragraph's digest says so, so that an edit moves no boundary far from it.
Every byte of a text is in one leaf: equal roots mean equal texts, and differing branches locate edits.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections import Counter

import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from lexigraph.llm.common import map_columns

LEAF = re.compile(rb"(?:[^\s.!?]+[ \t]*){1,6}[.!?\s]*|[.!?\s]+")
#: One in so many paragraphs ends a section.
SECTION = 16
#: Slices of the id range for each shuffle partition.
SLICES = 8


class Tree:
    """sections: lists of paragraphs, a paragraph being the first 32 bits of its leaf digests, of which it takes all 128; digests and spans (bytes) by section and paragraph."""

    __slots__ = ("root", "sections", "digests", "spans")

    def __init__(self, data: bytes):
        self.sections, self.digests, self.spans = [[]], [], [[]]
        at = 0
        inner: list[bytes] = []
        for line in data.split(b"\n"):
            end = at + len(line) + 1
            whole = data[at:end]
            leaves = [xxhash.xxh3_128_digest(x) for x in LEAF.findall(whole)]
            digest = xxhash.xxh3_128_digest(b"".join(leaves))
            self.sections[-1].append([x[:4] for x in leaves])
            self.spans[-1].append((at, min(end, len(data))))
            inner.append(digest)
            at = end
            if not line.strip() or not digest[0] % SECTION:
                self._close(inner)
                inner = []
        if inner or not self.digests:
            self._close(inner)
        self.sections.pop()
        self.spans.pop()
        self.root = hashlib.blake2b(b"".join(d for d, _ in self.digests), digest_size=16).hexdigest()

    def _close(self, inner: list[bytes]) -> None:
        self.digests.append((xxhash.xxh3_128_digest(b"".join(inner)), inner))
        self.sections.append([])
        self.spans.append([])

    def serialised(self) -> str:
        """root, then sections after '/', paragraphs after '.', leaves in eight hexadecimal digits."""
        return self.root + "".join("/" + ".".join(b"".join(p).hex() for p in s) for s in self.sections)


def tree(text: str | None) -> Tree:
    return Tree((text or "").encode("utf-8", "surrogatepass"))


def likeness(a: Tree, b: Tree) -> float:
    """Twice the leaves that both have, over all leaves; equal branches are not descended into. 1 if the roots are equal."""
    if a.root == b.root:
        return 1.0
    total = sum(len(p) for t in (a, b) for s in t.sections for p in s)
    same = 0
    ours, theirs = Counter(d for d, _ in a.digests), Counter(d for d, _ in b.digests)
    common = ours & theirs
    rest = []
    for t in (a, b):
        left = common.copy()
        open_paragraphs: list[tuple[bytes, list[bytes]]] = []
        for (digest, inner), section in zip(t.digests, t.sections):
            if left[digest] > 0:
                left[digest] -= 1
                same += sum(map(len, section)) if t is a else 0
            else:
                open_paragraphs += zip(inner, section)
        rest.append(open_paragraphs)
    common = Counter(d for d, _ in rest[0]) & Counter(d for d, _ in rest[1])
    leaves = []
    for k, paragraphs in enumerate(rest):
        left = common.copy()
        open_leaves: list[bytes] = []
        for digest, p in paragraphs:
            if left[digest] > 0:
                left[digest] -= 1
                same += len(p) if k == 0 else 0
            else:
                open_leaves += p
        leaves.append(Counter(open_leaves))
    same += (leaves[0] & leaves[1]).total()
    return 2 * same / total if total else 0.0


def edited_spans(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """The stretches of bytes of b that lie in paragraphs which a lacks: where b was edited."""
    if a.root == b.root:
        return []
    held = Counter(d for d, _ in a.digests)
    paragraphs = Counter(x for _, inner in a.digests for x in inner)
    out: list[tuple[int, int]] = []
    for (digest, inner), spans in zip(b.digests, b.spans):
        if held[digest] > 0:
            held[digest] -= 1
            continue
        for x, (start, end) in zip(inner, spans):
            if paragraphs[x] > 0:
                paragraphs[x] -= 1
            elif out and out[-1][1] == start:
                out[-1] = (out[-1][0], end)
            else:
                out.append((start, end))
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, root, sections array<array<array<string>>>): the tree of every whole text, leaves in hexadecimal.

    Null texts are empty: one section with one paragraph without leaves. Equal texts have equal trees, so
    repeated rows do. An empty table gives an empty result. Other columns are not read.
    """

    def run(ids, texts):
        trees = [tree(t) for t in texts]
        return [ids, [t.root for t in trees], [[[[x.hex() for x in p] for p in s] for s in t.sections] for t in trees]]

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_columns(picked, run, f"doc_id {picked.schema[0].dataType.simpleString()}, root string, sections array<array<array<string>>>")


def _literal(values: list, kind: str) -> Column:
    """An array literal of any size."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, next_text): each row beside the next one by descending id, after the last the first.

    Ids are cut into slices at their quantiles; rows are dealt by slice, and the first row of a slice also
    goes to the slice before it. Texts move once, and a slice is one window. The number of slices follows that
    of the shuffle partitions. Rows with equal ids are ordered by the hashes of their texts and share a slice;
    null ids come last, ordered and cut into slices by those hashes. A single row is next to itself.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("at"))
    d = d.withColumn("hash", F.xxhash64("text"))
    n = SLICES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(d.agg(F.percentile_approx("at", [i / n for i in range(1, n)], 10 * n)).first()[0] or []))
    # two levels of cuts, so that a row is compared with about twice the root of their number
    step = max(1, math.isqrt(len(cuts)))
    coarse = F.size(F.filter(_literal(cuts[step - 1 :: step], "array<long>"), lambda x: x < F.col("at")))
    groups = _literal([cuts[i : i + step] for i in range(0, len(cuts) + 1, step)], "array<array<long>>")
    fine = F.size(F.filter(F.element_at(groups, coarse + 1), lambda x: x < F.col("at")))
    nulls = F.floor((F.shiftright("hash", 40) + (1 << 23)) * n / (1 << 24)).cast("long")
    d = d.withColumn("slice", F.when(F.col("at").isNull(), -1 - nulls).otherwise(coarse * step + fine).cast("long"))
    d = d.withColumn("order", F.struct(F.col("at").isNull().alias("none"), F.bitwise_not("at").alias("at"), "hash")).drop("at", "hash")
    heads = d.groupBy("slice").agg(F.min("order").alias("head")).orderBy(F.desc("slice")).collect()  # one row a slice
    before = [(r["head"]["none"], r["head"]["at"], r["head"]["hash"], heads[i - 1]["slice"]) for i, r in enumerate(heads)]
    moved = spark.createDataFrame(before, "none boolean, at long, hash long, `to` long").select(F.struct("none", "at", "hash").alias("order"), "to")
    own = F.struct(F.col("slice").alias("slice"), F.lit(0).alias("help"))
    d = d.join(F.broadcast(moved), d["order"].eqNullSafe(moved["order"]), "left").select("doc_id", "text", d["order"], F.explode(F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("to").alias("slice"), F.lit(1).alias("help"))))).alias("to"))
    window = Window.partitionBy("to.slice").orderBy("to.help", "order")
    return d.withColumn("next_text", F.lead("text").over(window)).where("to.help = 0").select("doc_id", "text", "next_text")


def op4_merkle_fingerprint(spark, sf_dir: str) -> DataFrame:
    pairs = with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def run(ids, texts, following):
        out = [[] for _ in range(6)]
        last: tuple[str, Tree] | None = None
        for text, after in zip(texts, following):
            own = last[1] if last and last[0] == text else tree(text)
            last = (after, tree(after))
            third = len(text) // 3
            changed = (text[: len(text) - third] + after[:third]).encode("utf-8", "surrogatepass")
            edited = Tree(changed)
            row = (len(text), hashlib.sha256(changed).hexdigest(), own.serialised(), edited.serialised(), likeness(own, edited), likeness(own, last[1]))
            for c, v in zip(out, row):
                c.append(v)
        return [ids, *out]

    return map_columns(pairs, run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double", most=1 << 20)
