"""Operator 7: SimHash near-duplicates by pigeonring filtering.

A fingerprint of 64 bits is cut into m segments on a ring. If two fingerprints differ in at most t bits,
there is a segment from which on, round the ring, the first k segments together differ in at most
floor(k * t / m) bits, for every k. With m = t + 1 the first segment is then equal and the first two differ
in one bit at most: that is the join key. Longer chains and last the full distance are tested on what meets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from lexigraph.llm.common import free_name, map_columns
from lexigraph.operators.graph import connected_components
from lexigraph.session import checkpointed, let_go, written

WORDS, BITS, SEED = 4, 4, 42
#: Rows that a shingle may have to be worked together with others; results do not depend on it.
PART = 64
#: Documents that tell which shingles are frequent, and how many such shingles are told apart.
SAMPLE, FREQUENT = 4096, 1 << 16
#: Sets of a shingle that the others are compared with before all of them are; results do not depend on it.
HUBS = 8
#: Comparisons that a task makes at once.
BLOCK = 1 << 20
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of every shingle of `words` words (A-Z lower-cased, split at space and U+0009 to U+000D), repeats included; a shorter text is one shingle, one without words none."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.empty(0, ">u8")
    joined = b" ".join(w)
    if len(w) <= words:
        return np.frombuffer(xxhash.xxh64_digest(joined, SEED), ">u8")
    size = np.fromiter(map(len, w), np.int64, len(w))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[: len(w) - words + 1].tolist(), ends[words - 1 :].tolist())])
    return np.frombuffer(hashes, ">u8")


def simhash(text: str | None, words: int = WORDS) -> int:
    """The fingerprint as a signed 64-bit integer; a bit is set if it is in over half of the shingle hashes."""
    return _fingerprint(shingle_hashes(text or "", words))


def _fingerprint(h: np.ndarray) -> int:
    n = len(h)
    if not n:
        return 0
    count = np.zeros(64, np.int64)
    for i in range(0, n, 4096):
        bits = np.unpackbits(h[i : i + 4096].view(np.uint8), bitorder="big").reshape(-1, 64)
        count += np.add.reduce(bits, 0, dtype=np.uint32)
    return int(np.packbits(count * 2 > n, bitorder="big").view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, fp long) of every whole text; null texts are empty, with fingerprint zero."""

    def run(ids, texts):
        return [ids, [simhash(t, words) for t in texts]]

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_columns(picked, run, f"doc_id {picked.schema[0].dataType.simpleString()}, fp long")


def segments(bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of bits + 1 segments of a fingerprint."""
    m = bits + 1
    cuts = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _chain_keys(fp: Column, bits: int) -> Column:
    """array<struct<start, key, exact>>: for every start, the two segments from there on, and that with each bit of the second one turned."""
    ring = segments(bits)
    m = len(ring)
    out = []
    for i, (low, width) in enumerate(ring):
        low2, width2 = ring[(i + 1) % m]
        mask = ((1 << width) - 1) << low | ((1 << width2) - 1) << low2
        mask = mask - (1 << 64) if mask >> 63 else mask
        part = fp.bitwiseAND(F.lit(mask).cast("long"))
        second = 2 * bits // m >= 1
        for b in (None, *range(low2, low2 + width2)) if second else (None,):
            bit = 0 if b is None else 1 << b
            bit = bit - (1 << 64) if bit >> 63 else bit
            out.append(F.struct(F.lit(i).alias("start"), part.bitwiseXOR(F.lit(bit).cast("long")).alias("key"), F.lit(b is None).alias("exact")))
    return F.array(*out)


def _chain_masks(bits: int) -> list[list[tuple[np.uint64, int]]]:
    """For every start: (mask of the first k segments, bits that they may differ in) for k from 3 to all."""
    ring = segments(bits)
    m = len(ring)
    out = []
    for i in range(m):
        mask, row = 0, []
        for k in range(1, m + 1):
            low, width = ring[(i + k - 1) % m]
            mask |= ((1 << width) - 1) << low
            if k >= min(3, m):
                row.append((np.uint64(mask), k * bits // m))
        out.append(row)
    return out


def _forest(fps: np.ndarray, exact: np.ndarray, tests: list[tuple[np.uint64, int]]) -> list[tuple[int, int]]:
    """Edges that connect what is linked among the fingerprints of one key: each edge joins two groups, so they are fewer than the fingerprints, and no link is lost as a connection."""
    out: list[tuple[int, int]] = []
    own = np.flatnonzero(exact)
    group = np.arange(len(fps))
    step = max(1, BLOCK // len(fps))
    for at in range(0, len(own), step):
        rows = own[at : at + step]
        differ = fps[rows][:, None] ^ fps[None, :]
        i, j = np.nonzero((np.bitwise_count(differ & tests[0][0]) <= tests[0][1]) & (differ != 0))
        for mask, most in tests[1:]:
            near = np.bitwise_count(differ[i, j] & mask) <= most
            i, j = i[near], j[near]
        for r in np.unique(i).tolist():
            me = rows[r]
            linked = j[i == r] if len(i) > 1 else j
            other = linked[group[linked] != group[me]]
            if len(other):
                labels, first = np.unique(group[other], return_index=True)
                out += [(int(fps[me]), int(fps[k])) for k in other[first]]
                group[np.isin(group, labels)] = group[me]
    return out


def fingerprint_links(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """fps: distinct (fp long). (src, dst) edges that connect all fingerprints at `bits` or fewer differing bits, without all pairs of dense groups.

    Each fingerprint sends one row for each start of the ring and each key within its budget; rows are dealt
    and sorted by key, and a task reads them as a stream, one key at a time.
    """
    # so many rows come from each fingerprint that they are made in all tasks, however small the table
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    probes = fps.select("fp", F.explode(_chain_keys(F.col("fp"), bits)).alias("k")).select("fp", "k.start", "k.key", "k.exact")
    probes = probes.repartition("start", "key").sortWithinPartitions("start", "key", "fp")
    masks = _chain_masks(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in (batch["start"], batch["key"], batch["fp"], batch["exact"])]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            if not len(cols[0]):
                continue
            change = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0)) + 1
            last = int(change[-1]) if len(change) else 0
            rest = [c[last:] for c in cols]  # the last key may go on in the next batch
            if last:
                yield from emit([c[:last] for c in cols], change[:-1])
        if rest is not None:
            yield from emit(rest, np.empty(0, np.int64))

    def emit(cols, change):
        start, _, fp, exact = cols
        edges = []
        a = np.concatenate([[0], change]).astype(np.int64)
        b = np.append(change, len(fp)).astype(np.int64)
        some = np.add.reduceat(exact.astype(np.int64), a) > 0
        keep = (b - a > 1) & some
        u = fp.view(np.uint64)
        for i, j in zip(a[keep].tolist(), b[keep].tolist()):
            edges += _forest(u[i:j], exact[i:j], masks[int(start[i])])
        if edges:
            e = np.array(edges, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["src", "dst"])

    links = probes.mapInArrow(run, "src long, dst long")
    return links.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()


def _alike(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two sorted sets of shingles have at least that Jaccard similarity; two empty ones are equal."""
    small, large = sorted((len(a), len(b)))
    if small < least * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (small + large - both)


def _shingle_set(text: str | None, words: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of the shingles, the sorted set of them and a hash of that set."""
    h = shingle_hashes(text or "", words)
    found = np.unique(h.astype(np.uint64))
    return h, found, xxhash.xxh3_64_intdigest(found.tobytes()) - 2**63


def _frequent(docs: DataFrame, words: int) -> np.ndarray:
    """Shingles that several of SAMPLE documents share, the most frequent last: at most FREQUENT of them.

    They only say what comes last in the order of shingles, and any order gives the same links.
    """
    sample = docs.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    shingles = map_columns(sample, lambda _, texts: [np.concatenate([_shingle_set(t, words)[1] for t in texts]).view(np.int64).tolist()], "shingle long")
    often = shingles.groupBy("shingle").count().where("count > 2").orderBy(F.desc("count"), "shingle").limit(FREQUENT)
    return np.array([r["shingle"] for r in often.collect()][::-1], np.int64).view(np.uint64)


def _prefixes(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """docs (doc_id, text): (doc, fp, n, key, bitmap, BITS_256, prefix): number, hash, bits and first shingles of the set of each text.

    Of two sets of n and m shingles that are similar enough at least ceil(similarity * n) are shared; so one of
    the first n - ceil(similarity * n) + 1 of one set is among the first of the other, in any common order.
    """
    frequent = _frequent(docs, words)
    order = np.argsort(frequent)
    shared = docs.sparkSession.sparkContext.broadcast((frequent[order], order))

    def run(ids, texts):
        known, rank = shared.value
        fps, sizes, keys, bitmaps, signatures, firsts = [], [], [], [], [], []
        for t in texts:
            h, found, key = _shingle_set(t, words)
            n = len(found)
            at = np.searchsorted(known, found)
            late = known[np.minimum(at, len(known) - 1)] == found if len(known) else np.zeros(n, bool)
            last = found[late][np.argsort(rank[at[late]])] if late.any() else found[:0]
            most = n - math.ceil(similarity * n - 1e-9) + 1 if n else 0
            fps.append(_fingerprint(h))
            sizes.append(n)
            keys.append(key)
            bitmaps.append(_bitmap(found))
            signatures.append(_signature(found))
            firsts.append(np.concatenate([found[~late], last])[:most].view(np.int64))
        ends = np.cumsum([0, *map(len, firsts)]).astype(np.int32)
        words_ = np.array(signatures, np.int64).reshape(-1, len(BITS_256))
        return [ids, fps, sizes, keys, bitmaps, *[pa.array(words_[:, k]) for k in range(len(BITS_256))], pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(firsts) if firsts else np.empty(0, np.int64)))]

    return map_columns(docs, run, "doc long, fp long, n int, key long, bitmap binary, s0 long, s1 long, s2 long, s3 long, prefix array<long>")


def _bitmap(found: np.ndarray) -> bytes:
    """A bit for each shingle at its hash modulo a power of two that is at least twice their number."""
    size = 1 << max(6, int(2 * len(found) - 1).bit_length()) if len(found) else 64
    bits = np.zeros(size, bool)
    bits[(found & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _may_be_alike(n: int, x: bytes, m: int, y: bytes, similarity: float) -> bool:
    """Whether two sets may have the similarity: a bit that one of them alone has is a shingle that the other lacks, so none that has it is lost."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) != len(b):  # the larger one is folded
        if len(a) > len(b):
            a = a[: len(a) // 2] | a[len(a) // 2 :]
        else:
            b = b[: len(b) // 2] | b[len(b) // 2 :]
    both = a & b
    common = min(n - int(np.bitwise_count(a ^ both).sum()), m - int(np.bitwise_count(b ^ both).sum()))
    return common >= similarity * (n + m - common) - 1e-9


def _allowed(n, at, m, bt, similarity: float, least, ceil):
    """Whether sets of n and m shingles that share the shingle at places at and bt may be similar enough, and how many shingles their prefixes must then share.

    What is common lies before the shingle or from there on, and of common shingles those outside of what the
    prefixes share come after the prefix that ends first. For columns as for arrays, by their least and ceil.
    """
    share = similarity / (1 + similarity)
    larger = n + m - least(n, m)
    good = (least(at, bt) + least(n - at, m - bt) >= share * (n + m) - 1e-6) & (least(n, m) >= similarity * larger - 1e-6)
    return good, ceil(share * (n + m) - (ceil(similarity * larger - 1e-9) - 1) - 1e-6)


def _hub_pairs(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b): each set beside the hubs that its prefix shares most with. Hubs of a shingle are the sets that have it and come first in HUBS different orders.

    HUBS pairs a set at most, so that a dense group becomes one component without pairs of all its members. A
    hub may lack some of the shingles that are shared, so half of what must be shared is enough here.
    """
    first = [F.min(F.struct(F.xxhash64("key", F.lit(i)).alias("order"), "key", "n", "at", "component")) for i in range(HUBS)]
    hubs = rows.groupBy("shingle").agg(F.array(*first).alias("hubs"))
    hubs = hubs.select("shingle", F.array_distinct(F.transform("hubs", lambda h: h.dropFields("order"))).alias("hubs"))
    met = rows.join(hubs, "shingle").select("key", "n", "at", "component", F.explode("hubs").alias("hub")).where("component <> hub.component")
    good, need = _allowed(F.col("n"), F.col("at"), F.col("hub.n"), F.col("hub.at"), similarity, F.least, F.ceil)
    pairs = met.where(good).select(F.col("hub.key").alias("a"), F.col("key").alias("b"), need.alias("need"))
    pairs = pairs.groupBy("a", "b").agg(F.count("*").alias("shared"), F.max("need").alias("need")).where("2 * shared >= need")
    best = F.slice(F.sort_array(F.collect_list(F.struct("shared", "a")), asc=False), 1, HUBS)
    pairs = pairs.groupBy("b").agg(best.alias("best")).select("b", F.explode("best.a").alias("a"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


#: Columns of a set's bits modulo 256, which go with its rows into the last round.
BITS_256 = ("s0", "s1", "s2", "s3")


def _signature(found: np.ndarray) -> np.ndarray:
    """A bit for each shingle at its hash modulo 256, as four words."""
    bits = np.zeros(256, bool)
    bits[(found & np.uint64(255)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.int64)


def _enough(cols: list[np.ndarray], x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the rows x and y may be similar enough by their signatures; as _may_be_alike, so no pair that is gets lost."""
    n, words = cols[1], [c.view(np.uint64) for c in cols[4:]]
    both = sum(np.bitwise_count(w[x] & w[y]).astype(np.int32) for w in words)
    bits = sum(np.bitwise_count(w).astype(np.int32) for w in words)
    common = np.minimum(n[x] - (bits[x] - both), n[y] - (bits[y] - both))
    return common >= similarity / (1 + similarity) * (n[x] + n[y]) - 1e-6


def _across(cols: list[np.ndarray], similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, need) of the pairs of one shingle that are not in one component. cols: key, n, at, component and the signature's words of its rows.

    Rows of the largest component are only compared with others, so a dense group costs no pairs of its own.
    """
    key, n, at, component = cols[:4]
    names, of = np.unique(component, return_inverse=True)
    if len(names) < 2:
        return
    mine = np.flatnonzero(of != np.bincount(of).argmax())
    step = max(1, BLOCK // len(key))
    for i in range(0, len(mine), step):
        r = mine[i : i + step, None]
        good, need = _allowed(n[r], at[r], n[None, :], at[None, :], similarity, np.minimum, np.ceil)
        x, y = np.nonzero(good & (of[r] != of[None, :]))
        need = need[x, y]
        x = mine[i + x]
        # a pair of two rows that are both compared with all is met from both: it is given by the one with the smaller key
        once = (key[x] < key[y]) | ~np.isin(y, mine)
        x, y, need = x[once], y[once], need[once]
        like = _enough(cols, x, y, similarity)
        x, y, need = x[like], y[like], need[like]
        yield np.minimum(key[x], key[y]), np.maximum(key[x], key[y]), need


def _few(cols: list[np.ndarray], starts: np.ndarray, sizes: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for many shingles of few rows at once."""
    key, n, at, component = cols[:4]
    later = np.concatenate([np.arange(k - 1, -1, -1) for k in sizes]) if len(sizes) else np.empty(0, np.int64)
    rows = np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    x = np.repeat(rows, later)
    y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(later) - later, later)
    apart = component[x] != component[y]
    x, y = x[apart], y[apart]
    good, need = _allowed(n[x], at[x], n[y], at[y], similarity, np.minimum, np.ceil)
    x, y, need = x[good], y[good], need[good]
    like = _enough(cols, x, y, similarity)
    x, y, need = x[like], y[like], need[like]
    return np.minimum(key[x], key[y]), np.maximum(key[x], key[y]), need


def _pairs_across(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b): all pairs of sets in different components whose prefixes share enough. rows (shingle, key, n, at, component, BITS_256) are dealt and sorted by shingle and read as a stream."""
    rows = rows.select("shingle", "key", "n", "at", "component", *BITS_256).repartition("shingle").sortWithinPartitions("shingle", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(cols[0]):
                continue
            if cols[0][-1] == (held[0][0][0] if held else cols[0][0]):
                held.append(cols)  # one shingle may fill many batches
                continue
            cols = [np.concatenate(x) for x in zip(*held, cols)]
            last = int(np.searchsorted(cols[0], cols[0][-1]))
            yield from blocks([c[:last] for c in cols])
            held = [[c[last:] for c in cols]]
        if held:
            yield from blocks([np.concatenate(x) for x in zip(*held)])

    def blocks(cols):
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(cols[0])) + 1, [len(cols[0])]])
        starts, sizes = cuts[:-1], np.diff(cuts)
        few = (sizes > 1) & (sizes <= PART)
        made = [_few(cols[1:], starts[few], sizes[few], similarity)]
        for i, k in zip(starts[sizes > PART].tolist(), sizes[sizes > PART].tolist()):
            made += _across([c[i : i + k] for c in cols[1:]], similarity)
        for x in made:
            if len(x[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(x[1]), pa.array(x[2].astype(np.int32))], names=["a", "b", "need"])

    met = rows.mapInArrow(run, "a long, b long, need int")
    return met.groupBy("a", "b").agg(F.count("*").alias("shared"), F.max("need").alias("need")).where("shared >= need").select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """Those of pairs (a, b) of set hashes whose sets have the similarity; texts are read again for those whose bitmaps allow it."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("key").alias(side), F.struct("doc", "n", "bitmap").alias(f"{side}_set")), side)
    pairs = pairs.where(F.least("a_set.n", "b_set.n") >= F.lit(similarity) * F.greatest("a_set.n", "b_set.n") - 1e-6)

    def allowed(*cols):
        kept = [r for r in zip(*cols) if _may_be_alike(*r[4:], similarity)]
        return [[r[k] for r in kept] for k in range(4)]

    wide = pairs.select("a", "b", F.col("a_set.doc").alias("a_doc"), F.col("b_set.doc").alias("b_doc"), *[F.col(f"{s}_set.{c}").alias(f"{s}_{c}") for s in ("a", "b") for c in ("n", "bitmap")])
    pairs = written(map_columns(wide, allowed, "a long, b long, a_doc long, b_doc long"), "near-pairs")
    ends = pairs.select(F.col("a_doc").alias("doc_id")).union(pairs.select("b_doc")).distinct()
    docs = docs.join(ends, "doc_id", "left_semi")
    for side in ("b", "a"):
        pairs = pairs.join(docs.select(F.col("doc_id").alias(f"{side}_doc"), F.col("text").alias(f"{side}_text")), f"{side}_doc")

    def run(a, b, a_text, b_text):
        out, before = [], (None, None)
        for x, y, t, u in zip(a, b, a_text, b_text):
            if before[0] != t:
                before = (t, _shingle_set(t, words))
            _, one, key = before[1]
            _, two, other = _shingle_set(u, words)
            # rows with equal ids may have other texts
            if (key, other) == (x, y) and _alike(one, two, similarity):
                out.append((x, y))
        return [[x for x, _ in out], [y for _, y in out]]

    return checkpointed(map_columns(pairs.select("a", "b", "a_text", "b_text"), run, "a long, b long").distinct())


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, bits: int = BITS, similarity: float = 0.8) -> DataFrame:
    """The rows of docs that have the smallest id of their group of near-duplicates.

    Groups are the components of all pairs whose sets of shingles have a Jaccard similarity of at least
    `similarity`; the pairs are complete. Equal sets are one node. Candidates come in three rounds, each among
    what is still in different components: fingerprints at `bits` or fewer differing bits as a forest; each
    set beside one hub of every shingle of its prefix; and all pairs that share enough of their prefixes. All
    candidates are tested on their texts, as rows: no group is gathered in one task, and `bits` and the size
    of a group change the work only. Rows with equal ids stay or go together; rows without id stay; empty
    texts are copies of each other. An empty table gives an empty result; columns of any name are kept.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    prints = written(_prefixes(texts, words, similarity), "near-sets")
    sets = written(prints.groupBy("key").agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bitmap").alias("bitmap"), *[F.first(c).alias(c) for c in BITS_256]), "near-nodes")

    of_fp = sets.groupBy("fp").agg(F.min("key").alias("first"))
    near = fingerprint_links(of_fp.select("fp"), bits)
    near = near.join(of_fp.select(F.col("fp").alias("src"), F.col("first").alias("a")), "src").join(of_fp.select(F.col("fp").alias("dst"), F.col("first").alias("b")), "dst").select("a", "b")
    near = near.union(sets.join(of_fp, "fp").where("key <> first").select(F.col("first").alias("a"), F.col("key").alias("b")))
    tried = checkpointed(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    let_go(docs.sparkSession)
    links = _verified(tried, sets, texts, words, similarity)
    let_go(docs.sparkSession)

    # of copies one row sends its prefix, and a shingle of one set finds nobody; size and place of a row are one number
    rows = prints.join(sets.select("key", "doc"), ["key", "doc"]).dropDuplicates(["key", "doc"]).select("key", F.shiftleft(F.col("n").cast("long"), 32).alias("n"), F.posexplode("prefix").alias("at", "shingle"))
    rows = rows.select("shingle", "key", (F.col("n") + F.col("at")).alias("place"))
    rows = rows.withColumn("sets", F.count("*").over(Window.partitionBy("shingle"))).where("sets > 1")
    rows = written(rows.select("shingle", "key", F.shiftright("place", 32).cast("int").alias("n"), F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("at")), "near-rows")
    let_go(docs.sparkSession)
    for candidates in (_hub_pairs, _pairs_across):
        parts = connected_components(links, "a", "b").withColumnRenamed("node", "key")
        apart = rows.join(parts, "key", "left").withColumn("component", F.coalesce("component", "key"))
        let_go(docs.sparkSession)
        if candidates is _pairs_across:
            apart = apart.join(sets.select("key", *BITS_256), "key")
        met = checkpointed(candidates(apart, similarity).join(tried, ["a", "b"], "left_anti"))
        links = links.union(_verified(met, sets, texts, words, similarity))
        tried = tried.union(met)
        let_go(docs.sparkSession)

    same_id = prints.groupBy("doc").agg(F.collect_set("key").alias("keys")).where(F.size("keys") > 1)
    links = links.union(same_id.select(F.array_min("keys").alias("a"), F.explode("keys").alias("b")).where("a <> b"))
    # a set is named by its first document, so that the name of a component is its smallest id
    name = sets.select("key", F.struct("doc", "key").alias("name"))
    for end in ("a", "b"):
        links = links.join(name.select(F.col("key").alias(end), F.col("name").alias(f"{end}_name")), end)
    parts = connected_components(links, "a_name", "b_name").select(F.col("node.key").alias("key"), F.col("component.doc").alias("other"))
    least = sets.select("key", "doc").join(parts, "key", "left").select("key", F.coalesce("other", "doc").alias("least"))
    gone = free_name("gone", docs)
    lost = prints.select("doc", "key").join(least, "key").where("doc > least").select(F.col("doc").alias(gone)).distinct()
    return docs.join(lost, F.col(id_col).cast("long") == F.col(gone), "left_anti")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, bits: int = BITS) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id that is reachable over fingerprints at `bits` or fewer differing bits.

    Equal fingerprints are one node, so that groups of copies cost one row each. Null and empty texts have
    fingerprint zero and are linked like any other; null ids take part and are never a component's id unless
    all its ids are null; repeated rows give a row each. An empty table gives an empty result.
    """
    prints = checkpointed(fingerprints(docs, id_col, text_col, words))
    # a fingerprint is named by its first document, so that the name of a component is its smallest id
    name = F.struct(F.min("doc_id").isNull().alias("none"), F.min("doc_id").alias("first"), F.col("fp"))
    nodes = checkpointed(prints.groupBy("fp").agg(name.alias("node")))
    links = fingerprint_links(nodes.select("fp"), bits)
    for end in ("src", "dst"):
        links = links.join(nodes.select(F.col("fp").alias(end), F.col("node").alias(f"{end}_node")), end)
    parts = connected_components(links, "src_node", "dst_node").select(F.col("node.fp").alias("fp"), F.col("component.first").alias("other"))
    of_fp = nodes.join(parts, "fp", "left").select("fp", F.coalesce("other", "node.first").alias("component_id"))
    return prints.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def op7_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    d = simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return d.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
