"""Operator 13: repair of conversation structure at least cost, by the auction algorithm for shortest paths."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lexigraph.llm.common import SPACE, pieces
from lexigraph.session import written

#: Rows of a conversation that are one lattice; the prices at its end come from the lattice after it.
BLOCK = 64
DELETE, INSERT, REROLE, OPEN = 2, 5, 1, 5
#: States of the role pattern (s?(ua)+)?: nothing yet, after s, after u, after a. The first and the last accept.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a user or assistant row leads to from each state, and that role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 60


def _arcs(initial: str, fault: str) -> tuple[tuple[tuple[str, int, int, int], ...], ...]:
    """For each state the arcs (label, cost, rows consumed, next state) at a row, in ASCII order of labels."""
    out = []
    for q in range(4):
        arcs = [("D", DELETE, 1, q), ("I", INSERT, 0, NEXT[q])]
        if fault not in "BD":
            more = OPEN if fault == "T" else 0
            to = {"s": SYSTEM if q == START else None, "u": USER if q != USER else None, "a": ASSISTANT if q == USER else None}.get(initial)
            if to is not None:
                arcs.append(("K", more, 1, to))
            arcs.append(("R", REROLE + more, 1, NEXT[q]))
        out.append(tuple(arcs))
    return tuple(out)


#: By initial (other roles: -) and fault (blank, duplicate, truncated, none: -).
ARCS = {i + f: _arcs(i, f) for i in "sua-" for f in "BDT-"}
LEAST = {k: min(cost for arcs in by_state for _, cost, step, _ in arcs if step) for k, by_state in ARCS.items()}


def auction(initials: str, faults: str, exits: list[int], last: bool) -> tuple[list[int], list[str], list[int]]:
    """For each entry state: the least cost of the rows and what follows, the ASCII-least cheapest edits, and the state at the end.

    Nodes are (row, state). exits are the costs from each state at the end; insertions after the last row
    belong to the last block. Prices satisfy price(i) <= cost(i, j) + price(j) for every arc: the path is
    extended along the first arc for which this is tight, and where none is, the price of its end rises to the
    least cost + price and the path is contracted. They start at the sum of each row's least cost. Prices
    hold for every entry state, as the destination is the same. On a path that arrives, prices are true
    distances; an arc that was passed over for a later label had cost + price above its node's price, and prices only
    rise, so the labels are the least of all cheapest paths.
    """
    n = len(initials)
    at = [ARCS[a + b] for a, b in zip(initials, faults, strict=True)]
    base = min(exits)
    price = [[base] * 4 for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        price[i] = [price[i + 1][0] + LEAST[initials[i] + faults[i]]] * 4
    costs, labels, ends = [], [], []
    for entry in range(4):
        path, spelt = [(0, entry)], []
        while True:
            i, q = path[-1]
            best, take = FAR, None
            if i == n:
                best, take = exits[q], ("", n + 1, q)
                if last and (c := INSERT + price[n][NEXT[q]]) < best:
                    best, take = c, ("I", n, NEXT[q])
            else:
                for label, cost, step, to in at[i][q]:
                    c = cost + price[i + step][to]
                    if c < best:
                        best, take = c, (label, i + step, to)
            if price[i][q] < best:
                price[i][q] = best
                if len(path) > 1:
                    path.pop()
                    spelt.pop()
                continue
            label, i, q = take
            if i > n:
                break
            path.append((i, q))
            spelt.append(label)
        costs.append(price[0][entry])
        labels.append("".join(spelt))
        ends.append(q)
    return costs, labels, ends


def _priced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a conversation from the last to the first -> their traces; only four prices are carried."""
    conv, prices = None, []
    for batch in batches:
        made = []
        for cid, block, initials, faults in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            last = cid != conv
            conv = cid
            prices, labels, ends = auction(initials, faults, [0, FAR, FAR, 0] if last else prices, last)
            made.append((cid, block, prices[START], labels, ends))
        yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32())))], names=["cid", "block", "cost", "labels", "ends"])


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Traces of blocks from the first to the last -> the edits of each; only the state is carried."""
    conv, state = None, START
    for batch in batches:
        made = []
        for cid, block, cost, labels, ends in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            state = START if cid != conv else state
            conv = cid
            made.append((cid, block, cost, labels[state]))
            state = ends[state]
        yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["cid", "block", "cost", "edits"])


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits (kind 0) each followed by the row that they are for (kind 1), in order -> rows (cid, role, text) of the repaired conversation."""
    conv, state, pending = None, START, None
    for batch in batches:
        for piece in pieces(batch):
            made = []
            for cid, key, edit, role, text in zip(*[c.to_pylist() for c in piece.columns], strict=True):
                if cid != conv:
                    conv, state, pending = cid, START, None
                if edit is not None:
                    pending = (key, edit)
                    if key is not None:
                        continue
                if pending is None or pending[0] != key:
                    continue
                for label in pending[1]:
                    to = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]] if label == "K" else NEXT[state] if label in "IR" else state
                    if label in "KR":
                        made.append((cid, role if label == "K" else ROLE[to], text))
                    elif label == "I":
                        made.append((cid, ROLE[to], ""))
                    state = to
                pending = None
            yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], pa.string()) for k in range(3)], names=["cid", "role", "text"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cid, role, text) in order -> (cid, sha256 of role:text joined by newlines)."""
    conv, digest, made = None, None, []
    for batch in batches:
        for cid, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if cid != conv:
                if digest:
                    made.append((conv, digest.hexdigest()))
                conv, digest = cid, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if len(made) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], pa.string()) for k in range(2)], names=["cid", "repaired_sha256"])
            made = []
    if digest:
        made.append((conv, digest.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], pa.string()) for k in range(2)], names=["cid", "repaired_sha256"])


def _cid(conv: Column) -> Column:
    """A string that is never null and tells null from every id."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with one fault in four rows, by crc32("conv_id:turn") % 20; nulls of role and text, and of either id in the checksum, are a space."""
    c = conversations
    named = F.concat(*[F.coalesce(x.cast("string"), F.lit(" ")) for x in (c["conv_id"], F.lit(":"), c["turn"])])
    d = c.select(c["conv_id"], c["turn"], F.coalesce(c["role"], F.lit(" ")).alias("role"), F.coalesce(c["text"], F.lit(" ")).alias("text"), (F.crc32(named.cast("binary")) % 20).alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    d = d.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"))
    return d.drop("copy")


def skeleton(rows: DataFrame) -> DataFrame:
    """cid, pos, turn, role, h1, h2, initial, fault, before for every row: its place, first fault and the initial before it; no texts.

    Rows are in order of turn (nulls first), role and two hashes of the text; rows that are equal in all these are copies.
    A row is a duplicate if a copy of its role and text is earlier.
    """
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    r = rows.select(_cid(F.col("conv_id")).alias("cid"), "turn", "role", *_hashes(), (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("open"))
    alike = Window.partitionBy("cid", "role", "h1", "h2").orderBy(F.col("turn").asc_nulls_first())
    r = r.withColumn("copy", F.row_number().over(alike))
    fault = F.when(F.col("blank"), "B").when(F.col("copy") > 1, "D").when(F.col("open"), "T").otherwise("-")
    r = r.select("cid", "turn", "role", "h1", "h2", "copy", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    order = Window.partitionBy("cid").orderBy(F.col("turn").asc_nulls_first(), "role", "h1", "h2", "copy")
    return r.withColumn("pos", F.row_number().over(order).cast("long") - 1).withColumn("before", F.lag("initial").over(order)).drop("copy")


def _hashes() -> list[Column]:
    return [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), F.col("text")).alias("h2")]


def solve(rows: DataFrame) -> DataFrame:
    """cid, block, cost, edits for the blocks of a skeleton: the cheapest edits of BLOCK rows each, and the least cost from the block on.

    Blocks of a conversation pass a task from the last to the first, then back; a task holds one block and four numbers.
    """
    letter = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("-")
    b = rows.groupBy("cid", F.expr("pos div " + str(BLOCK)).alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", letter.alias("i"), F.col("fault").alias("f")))).alias("x"))
    b = b.select("cid", "block", *[F.array_join(F.col("x")[c], "").alias(c) for c in ("i", "f")])
    # by a stated number: blocks are small for the work that they are, so that tasks must not be put together by bytes
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    priced = b.repartition(parts, "cid").sortWithinPartitions("cid", F.desc("block")).mapInArrow(_priced, "cid string, block long, cost long, labels array<string>, ends array<int>")
    return priced.repartition(parts, "cid").sortWithinPartitions("cid", "block").mapInArrow(_traced, "cid string, block long, cost long, edits string")


def repaired_rows(rows: DataFrame, frame: DataFrame, solved: DataFrame) -> DataFrame:
    """cid, role, text of the repaired conversations, each in one partition and in order.

    Edits meet texts in the order of rows: each text moves once, and a task holds one row.
    """
    row_edits = solved.select("cid", F.posexplode(F.regexp_extract_all("edits", F.lit("I*[KRD]"), F.lit(0))).alias("k", "edit"), "block").select("cid", (F.col("block") * BLOCK + F.col("k")).alias("pos"), "edit").where("edit <> 'D'")
    key = F.struct("turn", "role", "h1", "h2")
    none = F.lit(None).cast("string")
    edits = frame.join(row_edits, ["cid", "pos"]).select("cid", F.lit(0).alias("tail"), key.alias("key"), F.lit(0).alias("kind"), "edit", none.alias("role"), none.alias("text"))
    tails = solved.select("cid", F.regexp_extract("edits", "(I+)$", 1).alias("edit")).where("edit <> ''").select("cid", F.lit(1).alias("tail"), F.lit(None).cast(edits.schema["key"].dataType).alias("key"), F.lit(0).alias("kind"), "edit", none.alias("role"), none.alias("text"))
    texts = rows.select(_cid(F.col("conv_id")).alias("cid"), F.col("turn"), F.col("role"), F.col("text"), *_hashes())
    texts = texts.select("cid", F.lit(0).alias("tail"), key.alias("key"), F.lit(1).alias("kind"), none.alias("edit"), "role", "text")
    stream = edits.union(tails).union(texts).repartition("cid").sortWithinPartitions("cid", "tail", "key", "kind")
    return stream.select("cid", F.col("key").cast("string"), "edit", "role", "text").mapInArrow(_rebuilt, "cid string, role string, text string")


def repair_conversations(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for each conv_id of conversations, from rows (conv_id, turn, role, text).

    gaps are the turns that are missing between the first and the last, illegal the neighbours whose initials
    are not su, ua or au. Edits are K (0), R (1, to user or assistant), D (2, required for blank rows and
    copies) and I (5, an empty row); rows that end without . ! or ? add 5 unless they are deleted; the result reads (s?(ua)+)?.

    Counts are summed in tasks first. The order of a conversation and the digest of its text are sequential by
    nature: a very long conversation is one sorted stream, of which a task holds a block or a row at a time. Null ids are a
    conversation, null turns come first, rows of one turn are in the order of role and text hash, other roles and an
    empty role cannot be kept, conversations without rows have zeros, an empty audit and the hash of nothing.
    """
    frame = written(skeleton(rows), "conversation-rows")
    solved = written(solve(frame), "conversation-edits")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    lawful = F.concat("before", "initial").isin("su", "ua", "au")
    facts = frame.groupBy("cid").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[count(F.col("fault") == f).alias(n) for f, n in (("B", "blank"), ("D", "duplicate"), ("T", "truncated"))],
        count(F.col("before").isNotNull() & ~lawful).alias("illegal"),
    )
    audits = solved.groupBy("cid").agg(F.array_join(F.array_sort(F.collect_list(F.struct("block", "edits")))["edits"], "").alias("audit"), F.max(F.when(F.col("block") == 0, F.col("cost"))).alias("cost"))
    digests = repaired_rows(rows, frame, solved).mapInArrow(_digested, "cid string, repaired_sha256 string")
    ids = conversations.select("conv_id").distinct().withColumn("cid", _cid(F.col("conv_id")))
    out = ids.join(facts, "cid", "left").join(audits, "cid", "left").join(digests, "cid", "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair_conversations(damage(conversations), conversations)
