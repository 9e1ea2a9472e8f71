"""Operators over whole tables, against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lexigraph.llm import lines, mixing, queries, simhash, substrings
from tests.compare import compare, connect


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, kept string, n_lines int")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, sf, name):
    assert compare(queries.QUERIES[name](spark, sf), connect(sf), queries.ORACLE_SQL[name]) == ""


def brute_lines(rows):
    space = " \t\n\x0b\x0c\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(space).translate(lower)
    owner = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            k = key(x)
            owner[k] = min(owner.get(k, 2**63 - 1), 2**63 - 1 if i is None else i)
    out = []
    for i, t in rows:
        x = (t or "").split("\n")
        kept = [y for y in x if len(key(y)) < 10 or owner[key(y)] == (2**63 - 1 if i is None else i)]
        out.append((i, len(x), len(x) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_line_dedup(spark):
    random.seed(5)
    pool = [f"Line number {i} of the pool" for i in range(30)] + ["short", "", "ÉCOLE de lignes", "école de lignes"]
    rows = [(i, "\n".join(random.choice(pool).upper() if random.random() < 0.2 else " " * random.randint(0, 2) + random.choice(pool) + "\t" for _ in range(random.randint(0, 8)))) for i in range(80)]
    rows += [(90, None), (91, ""), (None, "Line number 1 of the pool\nonly the null id"), (5, rows[5][1]), (5, "other text of five\n" + pool[0]), (200, "\n".join(pool[0] for _ in range(3000)))]
    random.shuffle(rows)
    for batches, fanout in ((4, 4), (7, 2)):
        got = lines.dedup_lines(table(spark, rows), batches=batches, fanout=fanout).collect()
        assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got) == brute_lines(rows)
    assert lines.dedup_lines(table(spark, [])).count() == 0


def test_runs_are_compacted(spark):
    runs = lines.LineRuns(spark, fanout=2)
    for i in range(5):
        runs.add(spark.createDataFrame([(i, i, i, k, k) for k in range(i, i + 3)], "doc long, text_hash long, pos int, h1 long, h2 long"))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert sorted((r.h1, r.owner) for r in runs.owners().collect()) == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 2), (5, 3), (6, 4)]


def brute_repeats(rows, n):
    seen, out = set(), []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - n + 1):
            w = b[k : k + n]
            if w in seen:
                gone[k : k + n] = [True] * n
            seen.add(w)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone) if not g)))
    return Counter(out)


def test_substring_dedup(spark):
    random.seed(6)
    word = lambda: "".join(random.choice("abcdeé ") for _ in range(random.randint(2, 9)))
    passages = ["".join(word() for _ in range(60)) for _ in range(4)] + ["ab" * 200, "a" * 350, "xyz " * 90]
    rows = [(i, "".join(random.choice(passages)[random.randint(0, 40) :] if random.random() < 0.5 else word() * 3 for _ in range(random.randint(0, 6)))) for i in range(60)]
    rows += [(60, rows[3][1]), (61, None), (62, ""), (63, rows[4][1][:99]), (64, "q" + rows[4][1][1:]), (65, rows[5][1] * 2)]
    got = substrings.remove_repeats(table(spark, random.sample(rows, len(rows))))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()) == brute_repeats(rows, 100)
    # rows of one id and text are one document; different texts of one id follow each other
    twice = [(1, rows[4][1]), (1, rows[4][1]), (None, rows[4][1])]
    got = substrings.remove_repeats(table(spark, twice)).collect()
    assert sorted((r.doc_id or 0, r.n_removed > 0) for r in got) == [(0, True), (1, False), (1, False)]
    other = [(1, rows[4][1]), (1, rows[4][1] + "tail"), (2, rows[4][1])]
    got = substrings.remove_repeats(table(spark, other)).collect()
    assert sorted((r.doc_id, r.n_removed > 0) for r in got) == [(1, False), (1, True), (2, True)]
    assert substrings.remove_repeats(table(spark, [])).count() == 0


def test_substrings_in_several_cells(spark, monkeypatch):
    """One trigger with many different phrases: its cells are sorted apart and merged by their letters."""
    monkeypatch.setattr(substrings, "CELL", 8)
    random.seed(16)
    common = "".join(random.choice("abcdefgh ") for _ in range(90))
    tails = ["".join(random.choice("xyz") for _ in range(40)) for _ in range(12)]
    rows = [(i, random.choice(tails)[: random.randint(5, 40)] + common + random.choice(tails)[: random.randint(5, 40)]) for i in range(150)]
    got = substrings.remove_repeats(table(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_repeats(rows, 100)


def test_many_rows_of_one_id(spark):
    """20,000 rows with one id and 20,000 without: every row but the first of a kind loses its passage."""
    passage = "".join(random.Random(3).choice("abcdefgh ") for _ in range(130))
    n = 20_000
    ids = spark.range(2 * n).select(F.when(F.col("id") < n, 7).cast("long").alias("doc_id"), F.concat_ws(" ", F.col("id") % n, F.lit(passage), F.when(F.col("id") >= n, "no id")).alias("text"))
    got = substrings.remove_repeats(ids).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum((F.col("n_removed") >= 130).cast("int")).alias("cut"))
    assert {(r.doc_id, r.n, r.cut) for r in got.collect()} == {(7, n, n - 1), (None, n, n)}


def brute_components(fps, bits):
    ids = list(fps)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and bin((fps[a] ^ fps[b]) % 2**64).count("1") <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("bits", [1, 4, 7])
def test_fingerprint_links_find_all(spark, bits):
    random.seed(bits)
    base = [random.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base:
        for _ in range(12):
            x = b
            for _ in range(random.randint(1, bits + 2)):
                x ^= 1 << random.randrange(64)
            fps.add(x)
    fps |= {0, 2**64 - 1, 1 << 63}
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    links = [(r.src, r.dst) for r in simhash.fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits).collect()]
    assert all(bin((a ^ b) % 2**64).count("1") <= bits for a, b in links)
    want = brute_components({f: f for f in signed}, bits)
    parent = {f: f for f in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    groups, ours = defaultdict(set), defaultdict(set)
    for f in signed:
        groups[want[f]].add(f)
        ours[find(f)].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, ours.values()))


def test_simhash_components(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    random.seed(8)
    long = [random.choice(words) + str(random.randint(0, 99)) for _ in range(400)]
    rows = [(3, " ".join(long)), (8, " ".join(long).upper()), (5, " ".join(long[:-1] + ["changed"])), (1, "something else"), (9, None), (10, ""), (11, "\n \t"), (None, " ".join(long)), (3, " ".join(long))]
    got = simhash.simhash_components(table(spark, rows)).collect()
    fps = {i: simhash.simhash(t) for i, t in rows if i is not None}
    want = brute_components(fps, 4)
    assert len(got) == len(rows) and all(r.component_id == want[r.doc_id] for r in got if r.doc_id is not None)
    assert [r.component_id for r in got if r.doc_id is None] == [3]
    assert simhash.simhash_components(table(spark, [])).count() == 0


def test_one_of_each_group(spark, monkeypatch):
    random.seed(11)
    vocabulary = ["w" + str(i) for i in range(500)]
    rows = []
    for g in range(6):
        base = [random.choice(vocabulary) for _ in range(300)]
        for _ in range(25):
            w = list(base)
            for _ in range(random.choice([0, 1, 1, 2, 30])):
                w[random.randrange(300)] = "new" + str(random.randrange(10**6))
            rows.append(" ".join(w))
    random.shuffle(rows)
    rows = [*enumerate(rows), (900, None), (901, ""), (902, " \n"), (None, rows[0]), (3, rows[3])]
    shingles = {i: {tuple((t or "").split()[k : k + 5]) for k in range(max(0, len((t or "").split()) - 4))} for i, t in rows if i is not None}
    like = lambda a, b: 1.0 if not a and not b else len(a & b) / max(1, len(a | b))
    for part in (64, 5):
        monkeypatch.setattr(simhash, "PART", part)
        kept = [r.doc_id for r in simhash.one_of_each_group(table(spark, rows), words=5, bits=10).collect()]
        assert kept.count(3) in (0, 2) and kept.count(None) == 1
        ids = sorted({k for k in kept if k is not None})
        pairs = [(a, b) for a in ids for b in ids if a < b and like(shingles[a], shingles[b]) >= 0.8]
        assert pairs == []
        assert 900 in ids and 901 not in ids and 902 not in ids
        if part == 64:
            assert all(i in ids or any(like(shingles[i], shingles[k]) >= 0.8 for k in ids if k < i) for i in shingles)
    assert simhash.one_of_each_group(table(spark, [])).count() == 0


def test_groups_are_complete_at_all_sizes(spark, monkeypatch):
    random.seed(13)
    word = lambda: "w" + str(random.randrange(3000))
    boilerplate = [word() for _ in range(60)]
    rows = []
    for _ in range(30):
        base = [word() for _ in range(90)]
        for _ in range(4):
            w = list(base)
            at = random.randrange(0, 60)
            w[at : at + random.randint(1, 4)] = [word() for _ in range(random.randint(1, 4))]
            rows.append(" ".join(w))
    rows += [" ".join(boilerplate + [word() for _ in range(20)]) for _ in range(40)]
    chain = [word() for _ in range(100)]
    for _ in range(90):
        chain = chain[6:] + [word() for _ in range(6)]
        rows.append(" ".join(chain))
    random.shuffle(rows)
    shingles = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for b in range(len(rows)):
        for a in range(b):
            if len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    want = [i for i in range(len(rows)) if find(i) == i]
    assert 20 < len(want) < len(rows) - 90
    for part in (64, 3):
        monkeypatch.setattr(simhash, "PART", part)
        assert sorted(r.doc_id for r in simhash.one_of_each_group(table(spark, enumerate(rows)), words=5, bits=10).collect()) == want


def test_mix(spark):
    random.seed(9)
    rows = [(i, "w " * random.randint(0, 60), random.choice(["a", "b", "c", None, "É"])) for i in range(300)]
    rows += [(400, None, "a"), (None, "x y z", "b"), (7, rows[7][1], rows[7][2]), (401, "", "empty"), (402, "w " * 5000, "one")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(d).collect()
    assert len(got) == len(rows) and sum(r.size for r in got) == sum(len((t or "").split()) for _, t, _ in rows)
    total = sum(r.size for r in got)
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert 0 <= r.taken <= 3 * r.size
    order = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    cap = {s: 3 * sum(r.size for r in by[s]) for s in by}
    target, left, open_ = {}, float(total), set(by)
    while True:
        w = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / w > cap[s]]
        if not over:
            target |= {s: left * weight[s] / w for s in open_}
            break
        for s in over:
            target[s] = cap[s]
            left -= cap[s]
            open_.remove(s)
    for s, r in by.items():
        assert r[0].target == pytest.approx(target[s]) and abs(sum(x.taken for x in r) - target[s]) <= 1
    assert mixing.mix_sources(d).exceptAll(mixing.mix_sources(d)).count() == 0
    assert mixing.mix_sources(d.where("false")).count() == 0
    copies = Counter(r.doc_id for r in mixing.mixed_rows(d).collect())
    assert mixing.mixed_rows(d).columns == d.columns and all(copies[r.doc_id] == r.copies for r in got if r.doc_id is not None and r.doc_id != 7)


def test_pipeline(spark, sf):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES] == ["quality classifier", "line dedup", "near-dedup", "mixing", "bpe encoding"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    clean = p.keep_quality(spark, docs, sf)
    assert clean.columns == docs.columns and 0 < clean.count() < docs.count()
    bad = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 0").select("doc_id")
    assert clean.join(bad, "doc_id", "left_semi").count() <= 1
    out = p.run(spark, sf)
    assert out.count() > 0 and set(out.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


def test_bitmaps_lose_no_similar_pair():
    import numpy as np

    r = np.random.default_rng(4)
    refused = 0
    for n in (0, 1, 2, 5, 60, 500, 3000):
        for _ in range(40):
            base = r.integers(0, 2**63, 2 * n + 2, dtype=np.uint64)
            a, b = np.unique(base[:n]), np.unique(np.concatenate([base[: int(n * r.random())], base[n : n + int(n * r.random() * 0.4)]]))
            like = len(np.intersect1d(a, b)) / max(1, len(np.union1d(a, b))) if len(a) or len(b) else 1.0
            allowed = simhash._may_be_alike(len(a), simhash._bitmap(a), len(b), simhash._bitmap(b), 0.8)
            assert allowed or like < 0.8
            refused += not allowed
    assert refused > 100
