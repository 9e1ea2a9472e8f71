"""Operators 11 to 13 against plain code and SQL, on odd rows too."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from lexigraph.llm import conversations, divergence, urls
from lexigraph.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import compare, connect

# ---- operator 11

PAGES = [
    (1, "http://WWW.Example.com/en/1.html?x=/fr/"), (2, "https://example.com/en/2"), (3, "https://a.example.com/fr/3#top"), (4, "ftp://b.net/es/4/"), (5, "x://net/fr/5"),
    (6, None), (7, "no scheme example.com/en/7"), (8, "http://"), (9, "http://example.com"), (10, "http://bad.org/a/10?u=http://example.com/en/"), (11, "http://bad.org/b/11"),
    (12, "http://notexample.com/en/12"), (13, "http://user@bad.co.uk:80/13"), (14, "http://10.0.0.1/14"), (1, "http://WWW.Example.com/en/1.html?x=/fr/"), (None, "http://bad.org/\n/16"), (17, "http://é.org./17"), (18, "a://b://net/es/18"),
]


def plain_verdict(url, good):
    """(host, path, rule, verdict or None)."""
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host = re.sub("[A-Z]", lambda x: x[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    best = None
    for verdict, rule in urls.RULES:
        h, at = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + at) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, best


@pytest.fixture(scope="module")
def judged(spark):
    pages = spark.createDataFrame([(i, u, "<p>", "h", True) for i, u in PAGES], "page_id long, url string, html string, host string, good boolean")
    outcomes = spark.createDataFrame([(i, i not in (10, 11, 200)) for i in (1, 2, 3, 4, 9, 10, 11, 200, None)] + [(11, True), (4, None), (10, False)], "item long, good boolean")
    many = pages.union(spark.createDataFrame([(k, f"http://bad.org/{k}", "", "", False) for k in range(200, 240)], pages.schema))
    outcomes = outcomes.union(spark.createDataFrame([(k, False) for k in range(201, 240)], outcomes.schema))
    return urls.judge_urls(many, outcomes).collect()


def test_rules_and_parts(judged):
    found = defaultdict(list)
    for r in judged:
        found[r.page_id].append(r)
    assert len(judged) == len(PAGES) + 40
    for i, u in PAGES:
        host, path, rule = plain_verdict(u, None)
        for r in found[i]:
            assert (r.host, r.path, r.rule) == (host, path, rule and rule[1])
            if rule:
                assert r.verdict == rule[0]


def test_reputation(judged):
    by_host = {r.host: r for r in judged}
    assert by_host["bad.org"].verdict == "block" and by_host["bad.org"].bound < urls.LEAST_GOOD
    assert by_host["10.0.0.1"].domain == "10.0.0.1" and by_host["user@bad.co.uk:80"].domain == "bad.co.uk" and by_host["é.org."].domain == "é.org"
    # the posterior of every host again, by plain loops over the hierarchy
    suffix = {h: urls_suffix(h) for h in by_host}
    n = {h: r.n_labelled for h, r in by_host.items()}
    good = {"www.example.com": 2, "example.com": 2, "a.example.com": 1, "b.net": 1}
    k = {h: good.get(h, 0) for h in by_host}
    n_of = lambda key: {x: (sum(n[h] for h in n if key[h] == x), sum(k[h] for h in n if key[h] == x)) for x in set(key.values())}
    domain = {h: r.domain for h, r in by_host.items()}
    tops, domains = n_of(suffix), n_of(domain)
    mean = (sum(k.values()) + 1) / (sum(n.values()) + 2)

    def level(children, prior):
        s = sum(a * (b / a - prior[c]) ** 2 / (prior[c] * (1 - prior[c])) for c, (a, b) in children.items() if a)
        c, t = sum(1 for a, _ in children.values() if a), sum(a for a, _ in children.values())
        w = 1 / max(1 / 201, min(0.5, (s - c) / (t - c))) - 1 if t > c else 20
        return {x: (b + w * prior[x]) / (a + w) for x, (a, b) in children.items()}, w

    up1, _ = level(tops, dict.fromkeys(tops, mean))
    up2, _ = level(domains, {d: up1[next(suffix[h] for h in by_host if domain[h] == d)] for d in domains})
    up3, w = level({h: (n[h], k[h]) for h in n}, {h: up2[domain[h]] for h in n})
    for h, r in by_host.items():
        assert abs(r.posterior - up3[h]) < 2e-6, h
        assert abs(r.bound - min(1, up3[h] + 1.645 * math.sqrt(up3[h] * (1 - up3[h]) / (n[h] + w + 1)))) < 2e-6


def urls_suffix(host):
    bare = re.sub(r"\.$", "", re.sub(r":[0-9]*$", "", re.sub("^.*@", "", host)))
    if re.match(r"^[0-9.]+$", bare):
        return bare
    return next((s for s in urls.SUFFIXES if bare == s or bare.endswith("." + s)), bare.rsplit(".", 1)[-1])


# ---- operator 12


def plain_divergence(rows, min_docs, ranks):
    df, counts, groups = Counter(), Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        df.update((lang, t) for t in set(found))
        counts.update((lang, source, t) for t in found)
    out = []
    for lang in {x for x, _ in groups}:
        kept = sorted(t for (x, t), n in df.items() if x == lang and n >= min_docs)
        of = {s: {t: counts[lang, s, t] for t in kept} for x, s in groups if x == lang}
        share = lambda c, n: 1 + 1_000_000_000 * (c + 5) // (n + 5 * len(kept))
        p = {s: {t: share(c, sum(m.values())) for t, c in m.items()} for s, m in of.items()}
        whole = {t: sum(m[t] for m in of.values()) for t in kept}
        q = {t: share(c, sum(whole.values())) for t, c in whole.items()}
        for s in of:
            pairs = sorted(((sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in of if o != s), key=lambda x: (-x[0], x[1].encode()))
            terms = sorted(((p[s][t] - q[t], t) for t in kept if of[s][t] and p[s][t] > q[t]), key=lambda x: (-x[0], x[1].encode()))[:ranks]
            out += [(lang, s, part, item, v, k) for part, x in (("pair", pairs), ("term", terms)) for k, (v, item) in enumerate(x, 1)]
    return sorted(out)


def test_divergence_of_odd_rows(spark):
    r = random.Random(5)
    words = ["Alpha", "beta", "été", "Ünder", "gamma9delta", "漢字", "x_y", "end."]
    rows = [(r.choice(["en", "fr", None]), r.choice(["a", "b", "c", None, ""]), " ".join(r.choices(words, k=r.randint(0, 12)))) for _ in range(120)]
    rows += [("en", "a", None), ("de", None, ""), ("de", "z", "123"), *[("en", s, "Copied text é") for s in "aaabbc"], ("en", "big", "word " * 40_000)]
    docs = spark.createDataFrame([(k, t, lang, s, 1, "t", 2) for k, (lang, s, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n long, term string, rank long").repartition(5)
    for min_docs, ranks in ((3, 4), (30, 50), (10_000, 50)):
        assert sorted(map(tuple, divergence.source_divergence(docs, min_docs=min_docs, ranks=ranks).collect())) == plain_divergence(rows, min_docs, ranks)


def test_texts_are_tokenized_once(monkeypatch):
    import pyarrow as pa

    seen = []
    real = divergence.terms_of
    monkeypatch.setattr(divergence, "terms_of", lambda t: seen.append(t) or real(t))
    rows = [("en", b"a b", ["s", "t"], [3, 1]), ("en", b"a b", ["s"], [2]), ("fr", b"a b", ["s"], [1])]
    batch = pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*rows)], names=["lang", "text", "sources", "counts"])
    out = [tuple(r.values()) for b in divergence._counted(iter([batch.slice(0, 1), batch.slice(1)])) for r in b.to_pylist()]
    assert seen == [b"a b", b"a b"] and ("en", "s", b"a", 5) in out and ("en", None, b"a", 6) in out and ("fr", None, b"b", 1) in out


# ---- operator 13


def plain_repair(rows):
    """Counts, least cost, audit and digest of rows (role, text) in order; states carry (cost, audit), layer by layer."""
    faults, seen = [], set()
    for role, text in rows:
        s = text.strip(" \t\n\x0b\x0c\r")
        faults.append("B" if not s else "D" if (role, text) in seen else "T" if s[-1] not in ".!?" else "-")
        seen.add((role, text))
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    def inserted(layer):
        while True:
            more = {after[q]: (c + 5, a + "I") for q, (c, a) in layer.items() if (c + 5, a + "I") < layer.get(after[q], (math.inf,))}
            if not more:
                return layer
            layer |= more

    layer = inserted({"": (0, "")})
    for (role, _), f in zip(rows, faults):
        new = {}
        for q, (c, a) in layer.items():
            ways = [(q, c + 2, a + "D")]
            if f not in "BD":
                more = 5 if f == "T" else 0
                ways.append((after[q], c + more + 1, a + "R"))
                if role[:1] and (role[0] == after[q] or role[0] == "s" and q == ""):
                    ways.append((role[0], c + more, a + "K"))
            for to, *x in ways:
                new[to] = min(tuple(x), new.get(to, (math.inf, "")))
        layer = inserted(new)
    cost, audit = min(layer[q] for q in ("", "a") if q in layer)
    out, q, left = [], "", iter(rows)
    for label in audit:
        role, text = next(left) if label != "I" else ("", "")
        if label == "D":
            continue
        q = role[0] if label == "K" else after[q]
        out.append(f"{role if label == 'K' else {'u': 'user', 'a': 'assistant'}[q]}:{text}")
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(rows, rows[1:])]
    return *(faults.count(f) for f in "BDT"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def odd_conversations():
    r = random.Random(8)
    roles, texts = ["user", "assistant", "system", "tool", "agent", "", None], ["Yes.", "No!", "Why?", "open", "", " \t", None, "é.", "same.", "long " * 3000 + "."]
    rows = []
    for conv in [*range(60), None]:
        rows += [(conv, t if r.random() < 0.9 else None, r.choice(roles[: r.choice([2, 3, 7])]), r.choice(texts) if r.random() < 0.5 else f"text {r.random()}.") for t in range(r.randint(1, 9))]
    rows += [(1000, t, r.choice(["user", "assistant"]), f"line {t}" + r.choice([".", "!", "", ","])) for t in range(3 * conversations.BLOCK + 5)]
    rows += [(1001, t, "assistant", f"{t}.") for t in range(2 * conversations.BLOCK)]
    return [*rows, *rows[:3]]


def test_repair_of_odd_conversations(spark, tmp_path):
    rows = odd_conversations()
    spark.createDataFrame([(*x, 1, "a") for x in rows], "conv_id long, turn long, role string, text string, pos long, cid string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: tuple(r)[1:] for r in QUERIES["op13_conversation_repair"](spark, str(tmp_path)).collect()}
    kept = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        kept[conv] += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    hashes = spark.createDataFrame([(t,) for t in {x[2] for v in kept.values() for x in v}], "text string").select("text", *conversations._hashes()).collect()
    order = {h.text: (h.h1, h.h2) for h in hashes}
    assert set(found) == set(kept) and len(found) == 63
    for conv, x in kept.items():
        x.sort(key=lambda y: (y[0] is not None, y[0] or 0, y[1], order[y[2]]))
        turns = [t for t, *_ in x if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        assert found[conv] == (gaps, *plain_repair([y[1:] for y in x])), conv


def test_auction_on_random_lattices():
    r = random.Random(3)
    for _ in range(300):
        n = r.randint(0, 12)
        rows = [(r.choice(["user", "assistant", "system", "tool"]), r.choice(["a.", "b", "", "c!", str(r.random()) + "."])) for _ in range(n)]
        *_, cost, audit, _ = plain_repair(rows)
        faults, seen = "", set()
        for x in rows:
            s = x[1].strip()
            faults += "B" if not s else "D" if x in seen else "T" if s[-1] not in ".!?" else "-"
            seen.add(x)
        costs, labels, ends = conversations.auction("".join(x[0][0] if x[0][0] in "sua" else "-" for x in rows), faults, [0, conversations.FAR, conversations.FAR, 0], True)
        assert (costs[0], labels[0]) == (cost, audit) and ends[0] in (conversations.START, conversations.ASSISTANT)


@pytest.mark.parametrize("name", ["op11_url_filter", "op12_source_divergence"])
def test_given_tables(spark, sf, name):
    assert compare(QUERIES[name](spark, sf), connect(sf), ORACLE_SQL[name]) == ""


@pytest.mark.parametrize("name", ["op11_url_filter", "op12_source_divergence", "op13_conversation_repair"])
def test_empty(spark, tmp_path, name):
    spark.createDataFrame([], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0
