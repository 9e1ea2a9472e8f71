"""Operator 6: removal of repeated byte strings by prefix-free parsing.

A rolling hash of GRAM bytes triggers the phrases: each place where a string of LENGTH bytes starts belongs
to the leftmost smallest hash inside that string, and a maximal run of places with one trigger is a phrase, up
to the end of its last string. Neighbouring phrases overlap by LENGTH - 1 bytes and equal strings always fall
into phrases with equal triggers. The parse is one row a phrase, in the order of (trigger, phrase, place): all
but the first place of a phrase repeat. The dictionary, the different phrases, falls into cells by trigger;
where a cell has several phrases, its suffix array is built from their letters, and neighbours in it that
have LENGTH letters in common are, in the order of the parse, a first string and its repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from lexigraph.llm.common import pieces
from lexigraph.session import written

LENGTH, GRAM = 100, 32
#: Bytes of text that a task hashes at once (a longer text is one piece).
PIECE = 1 << 19
#: Phrases of a trigger whose suffixes one array holds; a trigger with more has several cells, whose arrays are merged.
CELL = 512
#: Letters of the phrases whose suffixes a task sorts at once.
SORTED = 1 << 18
_LAST = 2**63 - 1
_PLACE = 28  # bits of a hash that give way to its place
#: A place is one integer that sorts like its text: byte (31 bits), bytes of the phrase (8), bytes before its trigger (7), and four
#: flags: its trigger has several cells, strings that hold the bytes right of the trigger, those left of it, repeated.
_BYTE_AT, _SIZE, _BEFORE, _SPLIT, _RIGHT, _LEFT, _KNOWN = 19, 11, 4, 8, 4, 2, 1


def _constants() -> tuple[np.ndarray, list[np.uint64]]:
    """Random 64-bit values for the bytes, and odd multipliers for the doublings."""
    r = np.random.default_rng(20240229)
    return r.integers(0, 2**64, 256, dtype=np.uint64), [np.uint64(int(x) | 1) for x in r.integers(0, 2**63, 12, dtype=np.uint64)]


_BYTE, _ODD = _constants()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    return h * _ODD[10]


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each string of `size` bytes, from doublings: linear in data times log of size."""
    n = len(data) - size + 1
    power, h, done, out, k = 1, _BYTE[data], 0, None, 0
    while True:
        if size & power:
            part = h[done : done + n]
            out = part.copy() if out is None else out * _ODD[k] + part
            done += power
        if done == size:
            return _mixed(out)
        h = h[:-power] * _ODD[k] + h[power:]
        power, k = power * 2, k + 1


def window_minima(h: np.ndarray, size: int) -> np.ndarray:
    """The minimum of each stretch of `size` values."""
    n, have = len(h) - size + 1, 1
    while have * 2 <= size:
        h = np.minimum(h[:-have], h[have:])
        have *= 2
    return np.minimum(h[:n], h[size - have : size - have + n])


def parse(buffers: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text index, first byte, bytes, bytes before the trigger, trigger, phrase hash) of the phrases of several texts.

    The lowest 16 bits of a phrase hash are those of its sides: half of what a string holds besides the
    trigger, to the left and to the right of it.
    """
    data = np.frombuffer(b"".join(buffers), np.uint8)
    sizes = np.fromiter(map(len, buffers), np.int64, len(buffers))
    offsets = np.cumsum(sizes) - sizes
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none, none
    hashes = gram_hashes(data, gram)
    # the place of a hash in its lowest bits: of equal ones the leftmost is taken, so that no phrase holds a string twice
    low = np.uint64((1 << _PLACE) - 1)
    lowest = window_minima(hashes & ~low | np.arange(len(hashes), dtype=np.uint64) & low, length - gram + 1)
    whole = np.ones(len(data), bool)
    for a, n in zip(offsets.tolist(), sizes.tolist()):
        whole[max(a, a + n - length + 1) : a + n] = False
    places = np.flatnonzero(whole)
    if not len(places):
        return none, none, none, none, none, none
    owner = places + (((lowest[places] & low).astype(np.int64) - places) & int(low))
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (np.diff(places) != 1)]))
    start = places[first]
    stop = places[np.append(first[1:], len(places)) - 1] + length
    raw = data.tobytes()
    digest = xxhash.xxh3_64_digest
    phrase = np.frombuffer(b"".join([digest(raw[a:b]) for a, b in zip(start.tolist(), stop.tolist())]), ">i8").astype(np.int64)
    side = (length - gram) // 2
    at = owner[first]
    if side:
        sides = gram_hashes(data, side)
        left = np.where(at - side >= start, sides[np.maximum(at - side, 0)] >> np.uint64(56), np.uint64(0)).astype(np.int64)
        right = np.where(at + gram + side <= stop, sides[np.minimum(at + gram, len(sides) - 1)] >> np.uint64(56), np.uint64(0)).astype(np.int64)
        phrase = phrase & ~np.int64(0xFFFF) | left << 8 | right
    text = np.searchsorted(offsets, start, "right") - 1
    # of texts that are empty several share an offset; the last of them holds the place
    return text, start - offsets[text], stop - start, at - start, hashes[at].view(np.int64), phrase


def _repeats(*keys: np.ndarray) -> np.ndarray:
    """For rows in the order of the corpus: whether an earlier row here has the same keys."""
    order = np.lexsort((np.arange(len(keys[0])), *keys))
    same = np.ones(max(0, len(order) - 1), bool)
    for k in keys:
        same &= k[order][1:] == k[order][:-1]
    out = np.zeros(len(order), bool)
    out[order[1:][same]] = True
    return out


def _new_rows(*keys: np.ndarray) -> np.ndarray:
    """For sorted rows: whether a row differs from the one before it."""
    out = np.ones(len(keys[0]), bool)
    if len(out):
        out[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return out


def _dealt(known: np.ndarray, doc: np.ndarray, *keys: np.ndarray) -> list[np.ndarray]:
    """What is known to repeat needs no keys: it is dealt by its text instead, so that no key gathers and the rows pack well."""
    return [np.where(known, doc * np.int64(-7046029254386353131) if i == 0 else np.int64(0), k) for i, k in enumerate(keys)]


def _map(df: DataFrame, func, schema: str, names: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, PIECE):
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in func(piece)], names=names)

    return df.mapInArrow(run, schema)


def _place(at):
    """First byte and number of bytes of a place, or of an array of places."""
    return at >> _BYTE_AT & (1 << 31) - 1, at >> _SIZE & 255


def _bytes(piece: pa.RecordBatch) -> list[bytes]:
    return piece["text"].cast(pa.binary()).to_pylist()


def _ramps(counts: np.ndarray) -> np.ndarray:
    """0 .. count - 1 for each count, joined."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def suffix_repeats(cells: np.ndarray, places: np.ndarray, phrases: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The suffix arrays of several cells at once. cells, places and phrases are in the order of cell and corpus.

    (phrase number, first byte in the phrase, repeated, order) of each suffix of at least `length` letters that
    the flags of its phrase leave open; order sorts them by cell, letters and corpus. Only the first `length`
    letters are looked at: that is as far as common prefixes count.
    """
    side = (length - gram) // 2
    sizes = np.fromiter(map(len, phrases), np.int64, len(phrases))
    data = np.frombuffer(b"".join(phrases), np.uint8)
    counts = sizes - length + 1
    of, at = np.repeat(np.arange(len(phrases)), counts), _ramps(counts)
    before = (places >> _BEFORE & 127)[of] - at
    held = ((before < side) | (places & _LEFT > 0)[of]) & ((length - gram - before < side) | (places & _RIGHT > 0)[of])
    of, at = of[held], at[held]
    if not len(of):
        return of, at, np.zeros(0, bool), of
    starts = (np.cumsum(sizes) - sizes)[of] + at
    letters = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, length)[starts]).view(f"S{length}").ravel()
    cell = cells[of]
    order = np.lexsort((letters, cell))
    common = (letters[order][1:] == letters[order][:-1]) & (cell[order][1:] == cell[order][:-1])
    repeated = np.zeros(len(of), bool)
    repeated[order[1:][common]] = True
    return of, at, repeated, order


def _numbered_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, row, text): row tells rows with one id apart, by the hash of their text; 0 where an id has one row."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    several = d.where("id is not null").groupBy("id").count().where("count > 1").select("id", F.lit(True).alias("several"))
    d = d.withColumn("several", F.col("id").isNull()) if several.isEmpty() else d.join(several, "id", "left")
    row = F.when(F.col("id").isNull() | F.col("several"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    return d.select(F.coalesce("id", F.lit(_LAST)).alias("doc"), row.alias("row"), "text")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary): every byte covered by a string of `length` bytes that also starts earlier.

    Earlier: in a smaller id, or before it in the same text; strings lie within one text and are judged on
    the input. Texts move once, to meet what was found in them; what travels between the steps are places of
    phrases and the letters of those phrases that a suffix array needs. Rows of equal phrases met in one piece
    are told from its first there, so a passage that is everywhere sends one row a piece, and no step forms
    pairs. A trigger with very many different phrases is sorted in cells of CELL phrases; the strings that are
    first in their cells are then merged by their letters.

    Null and empty texts have no bytes; null ids come last; different rows with one id follow each other in the
    order of their texts' hashes, and rows with the same id and text are one document: each gets its result.
    An empty table gives an empty result. Other columns are not read.
    """
    gram = min(GRAM, length)
    if not 1 <= 2 * length - gram <= 255:
        raise ValueError(f"length {length}: phrases of up to {2 * length - gram} bytes do not fit into a place")
    d = _numbered_rows(docs, id_col, text_col)

    def phrases(piece):
        text, first, size, before, trigger, phrase = parse(_bytes(piece), length, gram)
        doc, row = piece["doc"].to_numpy()[text], piece["row"].to_numpy()[text]
        at = first << _BYTE_AT | size << _SIZE | before << _BEFORE
        order = np.lexsort((at, row, doc))
        order = order[_new_rows(doc[order], row[order], at[order])]
        doc, row, at, trigger, phrase = (x[order] for x in (doc, row, at, trigger, phrase))
        known = _repeats(phrase, trigger)
        return [*_dealt(known, doc, trigger, phrase), doc, row, at | known]

    parsed = _map(d, phrases, "trigger long, phrase long, doc long, row long, at long", ["trigger", "phrase", "doc", "row", "at"])
    is_known = F.col("at").bitwiseAND(F.lit(_KNOWN).cast("long")) == _KNOWN
    place = ("doc", "row", "at")
    in_order = Window.partitionBy("trigger").orderBy("phrase", *place)
    group = Window.partitionBy("trigger")
    before = F.lag(F.struct("phrase", *place)).over(in_order)
    # equal places are the same row met again: of one document there is one parse
    parsed = parsed.withColumn("before", before).where(F.col("before").isNull() | is_known | (F.col("before") != F.struct("phrase", *place)))
    parsed = parsed.withColumn("repeated", is_known | F.coalesce(F.col("before.phrase") == F.col("phrase"), F.lit(False))).drop("before")
    parsed = parsed.withColumn("several", F.min("phrase").over(group) != F.max("phrase").over(group)).where("repeated or several")
    # strings of a phrase that hold a whole side are met only by phrases with an equal side
    byte = lambda shift: F.shiftright("phrase", shift).bitwiseAND(F.lit(255).cast("long"))
    is_open = F.when(~F.col("repeated"), 1)
    parsed = parsed.withColumn("l", byte(8)).withColumn("r", byte(0)).withColumn("cells", F.ceil(F.count(is_open).over(group) / CELL))
    met = lambda c: F.count(is_open).over(Window.partitionBy("trigger", c)) > 1
    flags = F.when(F.col("repeated"), _KNOWN).otherwise(F.when(met("l"), _LEFT).otherwise(0) + F.when(met("r"), _RIGHT).otherwise(0))
    parsed = parsed.withColumn("flags", flags).where("flags > 0")
    split = F.when(~F.col("repeated") & (F.col("cells") > 1), _SPLIT).otherwise(0)
    mark = F.col("at").bitwiseAND(F.lit(~15).cast("long")).bitwiseOR((F.col("flags") + split).cast("long"))
    cell = F.when(F.col("cells") > 1, F.xxhash64("trigger", F.pmod(F.shiftright("phrase", 16), "cells"))).otherwise(F.col("trigger"))
    marks = parsed.select("doc", "row", F.when(F.col("repeated"), mark).alias("sure"), F.when(~F.col("repeated"), F.struct(mark.alias("mark"), cell.alias("cell"))).alias("open"))
    state = written(marks.groupBy("doc", "row").agg(F.collect_list("sure").alias("sure"), F.collect_list("open").alias("open")), "repeats")

    def letters(piece):
        out: list[list] = [[] for _ in range(5)]
        for doc, row, text, marks_ in zip(piece["doc"].to_pylist(), piece["row"].to_pylist(), _bytes(piece), piece["open"].to_pylist()):
            for m in marks_:
                first, size = _place(m["mark"])
                for c, v in zip(out, (m["cell"], doc, row, m["mark"], text[first : first + size])):
                    c.append(v)
        return [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))]

    wanted = d.join(state.where(F.size("open") > 0).select("doc", "row", "open"), ["doc", "row"]).select("doc", "row", "text", "open")
    names = ["cell", "doc", "row", "at", "phrase"]
    dictionary = _map(wanted, letters, "cell long, doc long, row long, at long, phrase binary", names)
    dictionary = dictionary.repartition("cell").sortWithinPartitions("cell", "doc", "row", "at")

    def sort_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < SORTED:
                continue
            table = pa.Table.from_batches(held)
            cells = table["cell"].to_numpy()
            last = int(np.searchsorted(cells, cells[-1]))  # the last cell may go on
            if last:
                yield from sort_cell_rows(table.slice(0, last))
            held = table.slice(last).to_batches()
            size = sum(b.nbytes for b in held)
        if held:
            yield from sort_cell_rows(pa.Table.from_batches(held))

    def sort_cell_rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.filter(pa.array(_new_rows(*(table[c].to_numpy() for c in ("cell", "doc", "row", "at"))))).combine_chunks()
        cells, doc, row, places = (table[c].to_numpy() for c in ("cell", "doc", "row", "at"))
        of, at, repeated, order = suffix_repeats(cells, places, table["phrase"].to_pylist(), length, gram)
        first = _place(places)[0]
        # runs of neighbouring repeats in a phrase are one span
        r = np.flatnonzero(repeated)
        head = np.flatnonzero(np.concatenate([[True], (np.diff(of[r]) != 0) | (np.diff(at[r]) != 1)]) if len(r) else np.empty(0, bool))
        tail = np.append(head[1:], len(r))[: len(head)] - 1
        sizes = at[r[tail]] - at[r[head]] + length
        # what is first in one of several cells is told by its letters
        fresh = np.flatnonzero(~repeated & (places & _SPLIT > 0)[of])
        both = np.concatenate([r[head], fresh])
        where = first[of[both]] + at[both] << _BYTE_AT | np.concatenate([sizes, np.full(len(fresh), length)]) << _SIZE
        phrase = table["phrase"]
        strings = [None] * len(head) + [phrase[int(i)].as_py()[k : k + length] for i, k in zip(of[fresh], at[fresh].tolist())]
        if len(both):
            yield pa.RecordBatch.from_arrays([pa.array(doc[of[both]]), pa.array(row[of[both]]), pa.array(where), pa.array(strings, pa.binary())], names=["doc", "row", "at", "string"])

    checked = dictionary.mapInArrow(sort_cells, "doc long, row long, at long, string binary")
    spread = F.when(F.col("string").isNull(), F.xxhash64("doc", "row")).otherwise(F.lit(0).cast("long"))
    merged = Window.partitionBy("string", "spread").orderBy(*place)
    checked = checked.withColumn("spread", spread).withColumn("n", F.row_number().over(merged)).where("string is null or n > 1")
    fine = checked.groupBy("doc", "row").agg(F.collect_list("at").alias("places"))
    sure = state.select("doc", "row", F.col("sure").alias("spans"))
    final = d.join(sure, ["doc", "row"], "left").join(fine, ["doc", "row"], "left").select("doc", "text", "spans", "places")

    def cut(piece):
        out: list[list] = [[] for _ in range(5)]
        for doc, text, spans, places in zip(piece["doc"].to_pylist(), _bytes(piece), piece["spans"].to_pylist(), piece["places"].to_pylist()):
            kept, removed, runs = text, 0, 0
            mine = np.array([*(spans or ()), *(places or ())], np.int64)
            if len(mine):
                start, size = _place(mine)
                steps = np.zeros(len(text) + 1, np.int32)
                np.add.at(steps, start, 1)
                np.add.at(steps, start + size, -1)
                gone = np.cumsum(steps[:-1]) > 0
                removed = int(gone.sum())
                runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0])
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            for c, v in zip(out, (doc if doc != _LAST else None, len(text), removed, runs, kept)):
                c.append(v)
        return [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))]

    return _map(final, cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    d = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
