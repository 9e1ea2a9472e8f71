"""Operator 9 on a planted corpus: recurring contexts carry seeds and identifiers that no base pattern takes."""

import random
from collections import defaultdict

from lexigraph.llm import pii

CARRIERS = ["reach me under", "account holder id", "member contact is"]
DECOYS = ["order number", "in the year", "version tag"]


def corpus():
    r = random.Random(21)
    code = lambda: "".join(r.choice("abcdefghjk") for _ in range(3)) + "-" + "".join(r.choice("0123456789") for _ in range(6))
    seed = lambda: f"{''.join(r.choice('abcdefgh') for _ in range(7))}@mail{r.randint(1, 99)}.example.org"
    docs, planted, others = [], set(), set()
    for k in range(400):
        parts, at = [], 0

        def put(words, token=None, into=None):
            nonlocal at
            text = f"{words} {token}. " if token else f"{words}. "
            if into is not None:
                into.add((k, at + len(words) + 1, at + len(words) + 1 + len(token)))
            parts.append(text)
            at += len(text)

        put("some plain words come first")
        for _ in range(r.randint(1, 3)):
            if r.random() < 0.88:
                put(r.choice(CARRIERS), seed())
            else:
                put(r.choice(CARRIERS), code(), planted)
        put(r.choice(DECOYS), code(), others)
        if r.random() < 0.02:
            put(r.choice(DECOYS), seed())
        docs.append((k, "".join(parts)))
    return docs, planted, others


def brute(docs):
    """The same scores by plain loops over the graph of patterns and instances."""
    edges, places = defaultdict(bool), []
    for k, t in docs:
        spans = pii.base_spans(t or "")
        contexts = pii.Contexts(t or "")
        for known, pairs in ((True, [(a, b) for _, a, b in spans]), (False, pii.candidates(t or "", spans))):
            for a, b in pairs:
                c = contexts.before(a)
                if c:
                    edges[c, t[a:b].lower()] |= known
                    if not known:
                        places.append((k, a, b, c, t[a:b].lower()))
    score = defaultdict(float)
    for (_, i), known in edges.items():
        score[i] = max(score[i], float(known))
    for _ in range(pii.ROUNDS):
        of = defaultdict(list)
        for p, i in edges:
            of[p].append(score[i])
        confidence = {p: sum(x) / len(x) for p, x in of.items()}
        reached, seeds = defaultdict(list), defaultdict(float)
        for (p, i), known in edges.items():
            reached[i].append(confidence[p] if len(of[p]) >= pii.SUPPORT else 0.0)
            seeds[i] = max(seeds[i], float(known))
        score = {i: max(seeds[i], sum(x) / len(x)) for i, x in reached.items()}
    good = {p for p, x in of.items() if len(x) >= pii.SUPPORT and confidence[p] >= pii.CONFIDENCE}
    return {(k, a, b) for k, a, b, p, i in places if p in good and score[i] >= pii.ACCEPT and not edges[p, i]}


def test_planted_contexts(spark):
    docs, planted, others = corpus()
    rows = [*docs, (1000, None), (1001, "")]
    found = {(r.doc_id, s.start, s.end) for r in pii.extract_personal_data(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect() for s in r.found}
    assert found == brute(rows)
    assert len(planted) > 60 and len(found & planted) >= 0.9 * len(planted), (len(found & planted), len(planted))
    assert len(found & planted) >= 0.9 * len(found) and not found & others


def test_very_many_identifiers_under_one_context(spark):
    n = 30_000
    rows = [(k, f"reach me under {'x' * 3}{k}@mail.example.org. reach me under idq-{k:07d}." if k % 8 == 0 else f"reach me under {'x' * 3}{k}@mail.example.org.") for k in range(n)]
    found = pii.extract_personal_data(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).where("size(found) > 0")
    assert found.count() == n // 8
