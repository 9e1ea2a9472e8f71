"""Operators on single texts, against the library they follow or plain code."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lexigraph.llm import bpe, media, merkle, pii, quality, secrets, simhash

TEXTS = ["", " ", "a", "über straße\n\nzwei", "Tom's café — 12,5 €\n" * 3, "x" * 700, "中文 text \x1c\x85 end", "😀" * 50, "line\n" * 2000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "extra") for i, t in enumerate(TEXTS)] + [(90, None, "null text"), (None, "null id", "x"), (3, TEXTS[3], "extra"), (3, TEXTS[3], "extra")]
    return spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")


def test_png_round_trip_and_damage():
    r = np.random.default_rng(1)
    for shape in ((1, 64, 3), (7, 5, 1), (300, 64, 3)):
        x = r.integers(0, 256, shape, dtype=np.uint8)
        data = media.encode_png(x)
        assert (media.decode_png(data) == x).all()
        for at in (3, 20, len(data) // 2, len(data) - 5):
            bad = bytearray(data)
            bad[at] ^= 1
            with pytest.raises(media.BadImage):
                media.decode_png(bytes(bad))
    with pytest.raises(media.BadImage):
        media.decode_png(data[:-20])


def test_png_average_and_paeth_filters():
    rows = np.random.default_rng(2).integers(0, 256, (4, 12), dtype=np.uint8)
    for kind in (3, 4):
        out = media._unfilter(np.full(4, kind, np.uint8), rows, 3)
        ref = np.zeros((5, 15), int)
        for y in range(4):
            for x in range(12):
                a, b, c = ref[y + 1, x], ref[y, x + 3], ref[y, x]
                p = a + b - c
                guess = (a + b) // 2 if kind == 3 else min(((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c)))[2]
                ref[y + 1, x + 3] = (rows[y, x] + guess) % 256
        assert (out == ref[1:, 3:]).all()


def test_media_columns(spark, docs):
    rows = media.image_columns(media.text_media(docs), "image", keep=("doc_id", "n_bytes", "image")).collect()
    assert len(rows) == docs.count() and all(r.ok for r in rows)
    for r in rows:
        text = next((t for i, t in enumerate(TEXTS) if i == r.doc_id), "null id" if r.doc_id is None else "")
        data = text.encode()
        assert r.n_bytes == len(data) and bytes(r.samples) == data.ljust(max(192, -(-len(data) // 192) * 192))
    assert media.image_columns(spark.createDataFrame([(None,), (b"junk",)], "image binary")).where("ok").count() == 0


def test_bpe_equals_library(spark, docs):
    from tokenizers import Tokenizer

    path = bpe.vocabulary()
    own, library = bpe.encoder(path), Tokenizer.from_file(path)
    random.seed(3)
    letters = "aabcdeeefghiijklmnoooprstttuvwxyz'  \n\t!.?#&0123éßüİΣσς中  \x1c\x85😀²½ẽ"
    texts = TEXTS + ["".join(random.choice(letters) for _ in range(random.randint(0, 90))) for _ in range(400)]
    texts += [c * n for c in ("a", "l", "ha", "!", "ll") for n in range(1, 30)] + ["x<|endoftext|>y <|startoftext|>", "<|ENDOFTEXT|>"]
    for t in texts:
        ids = np.frombuffer(own.encode(t), "<u4").tolist()
        assert ids == library.encode(t, add_special_tokens=False).ids, t
        assert own.automaton.decode(ids) == library.decode(ids, skip_special_tokens=False)
    long = "".join(random.choice("abcdeth") for _ in range(200_000))
    assert np.frombuffer(own.encode(long), "<u4").tolist() == library.encode(long, add_special_tokens=False).ids
    rows = {r.doc_id: r for r in bpe.token_digests(docs).collect()}
    assert rows[90].n_tokens == 0 and rows[90].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert rows[4].n_tokens == len(library.encode(TEXTS[4], add_special_tokens=False).ids)


def plain_secrets(text):
    out = []
    for kind, pattern, least, group, flags in (("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, re.I | re.A), ("access", r"AKIA[A-Z0-9]+", 18, 0, 0), ("hex", r"[0-9a-f]+", 16, 0, 0)):
        out += [(m.start(), k, m.end()) for k, m in ((("assign", "access", "hex").index(kind), m) for m in re.finditer(pattern, text, flags)) if len(m[group]) >= least]
    return sorted(out)


def test_secrets_equal_plain_search(spark, docs):
    random.seed(4)
    parts = ["password", "PassWD", "token", "api_key", "apikey", "secret", ": ", "=", '"', "'", "AKIA", "ABCDEF0123456789", "deadbeef", "0123456789abcdef", "é", "ſecret", "K", " ", "\n", "Zz_.-", "toktoken", "abcd"]
    for _ in range(4000):
        t = "".join(random.choice(parts) for _ in range(random.randint(0, 14)))
        ours = [(a, secrets.KINDS.index(k), b) for k, a, b in secrets.scan(t) if k in ("assign", "access", "hex")]
        assert ours == plain_secrets(t), t
    body = "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
    good = "ghp_" + body + secrets.base62(zlib.crc32(body.encode()))
    assert ("checked", 2, 2 + len(good)) in secrets.scan("é " + good + " x")
    assert not [s for s in secrets.scan(good[:-1] + ("0" if good[-1] != "0" else "1")) if s[0] == "checked"]
    assert ("wif", 0, 51) in secrets.scan("5HueCGU8rMjxEXxiPuD5BDku4MkFqeZyd4dZ1jvhTVqvbTLvyTJ")
    rows = {r.doc_id: r for r in secrets.scan_secrets(docs).collect()}
    assert rows[90].secrets == [] and len(rows) == len(TEXTS) + 2


def test_base_patterns_equal_plain_search():
    random.seed(12)
    parts = ["a", "Z", "0", "12", "255", "256", "1.2.3.4", ".", "..", "@", "-", "_", "+", "%", " ", "(", ")", "é", "b.c", "+49 ", "1234 5678 ", "\n"]
    for _ in range(20000):
        t = "".join(random.choice(parts) for _ in range(random.randint(0, 16)))
        plain = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        plain += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
        assert [s for s in pii.base_spans(t) if s[0] in ("email", "ip")] == plain, t
    assert pii.base_spans("x" * 300_000 + " @ " + "7" * 300_000 + ".") == []
    assert pii.base_spans("0" * 5000 + "3.2.1.0 ") == [("ip", 0, 5007)]


def test_personal_data(spark):
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")
    spans = pii.base_spans("mail a.b@c.de or 10.0.0.256, 10.0.0.25; card 4539 5787 6362 1486 call +1 (499) 555-6503!")
    assert [k for k, _, _ in spans] == ["email", "ip", "card", "phone"]
    rows = [(i, f"the account number {1000 + i}@mail.example.org then") for i in range(40)] + [(100 + i, f"the account number QX{i}7788-{i} then") for i in range(3)] + [(200, None), (201, ""), (None, "no id 1.2.3.4"), (100, "the account number QX07788-0 then")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.extract_personal_data(d, support=8).collect()}
    assert len(got[0].base) == 1 and got[200].base == [] and got[None].base[0].kind == "ip"
    assert [s.kind for s in got[101].found] == ["context"] and rows[41][1][got[101].found[0].start : got[101].found[0].end] == "QX17788-1"
    assert pii.extract_personal_data(d.where("false")).count() == 0


def test_merkle(spark, docs):
    text = "\n".join(f"Paragraph {i} has some words. And more of them, here." for i in range(60))
    a, b = merkle.tree(text), merkle.tree(text.replace("Paragraph 7 has", "Paragraph 7 had"))
    assert a.root == merkle.tree(text).root != b.root and 0.95 < merkle.likeness(a, b) < 1
    (start, end), = merkle.edited_spans(a, b)
    assert "Paragraph 7 had" in text.replace("Paragraph 7 has", "Paragraph 7 had")[start:end] and end - start < 80
    assert merkle.likeness(merkle.tree(""), merkle.tree("x")) == 0 and merkle.likeness(merkle.tree(""), merkle.tree(None)) == 1
    assert all(merkle.tree(x).root != merkle.tree(y).root for x in TEXTS for y in TEXTS if x != y)
    rows = merkle.fingerprints(docs).collect()
    assert len(rows) == docs.count() and len({r.root for r in rows if r.doc_id == 3}) == 1


def test_next_documents(spark):
    rows = [(5, "five"), (9, "nine"), (1, None), (7, "seven"), (None, "none"), (7, "seven")]
    got = merkle.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text, r.next_text) for r in got) == sorted([(9, "nine", "seven"), (7, "seven", "seven"), (7, "seven", "five"), (5, "five", ""), (1, "", "none"), (0, "none", "nine")])
    assert merkle.with_next(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    big = spark.range(1000).selectExpr("id * 3 as doc_id", "string(id) as text")
    assert merkle.with_next(big).where("int(next_text) = (int(text) + 999) % 1000").count() == 1000


def test_simhash_bits():
    import xxhash

    for text in TEXTS + ["The quick Brown fox jumps over the lazy dog " * 3]:
        w = text.encode().lower().split()
        sh = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        bits = sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))
        assert simhash.simhash(text) % 2**64 == bits


def test_quality_votes(spark):
    clean = [(i, f"A calm sentence number {i} about rivers and boats, written plainly.", 1) for i in range(60)]
    junk = [(100 + i, f"BUY!!! N{i}OW *** $$$ ### " * 6, 0) for i in range(60)]
    d = spark.createDataFrame([(a, b) for a, b, _ in clean + junk] + [(500, None), (501, ""), (None, "no id")], "doc_id long, text string")
    labels = spark.createDataFrame([(a, c) for a, _, c in clean + junk if a % 3] + [(7, 1), (None, 1), (8, None)], "doc_id long, quality int")
    model = quality.fit(d, labels)
    got = {r.doc_id: r.score for r in quality.score_quality(d, model).collect()}
    assert len(got) == 123 and all(0 <= s <= 1 for s in got.values())
    assert all(got[a] > 0.7 for a, _, _ in clean) and all(got[a] < 0.3 for a, _, _ in junk)
    assert {r.score for r in quality.score_quality(d, quality.fit(d, labels.where("false"))).collect()} == {0.5}
    assert quality.score_quality(d.where("false"), model).count() == 0


def test_quality_votes_count_what_they_stand_for(spark):
    random.seed(12)
    text = lambda: " ".join(random.choice("river boat stone Cloud 12 (rain) wind; leaf".split()) for _ in range(30))
    rows = [(i, text(), 0 if i % 7 == 0 else 1) for i in range(420)]
    d = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    mean = {}
    for most in (1000, 60):
        model = quality.fit(d.select("doc_id", "text"), d.select("doc_id", "quality"), max_labelled=most)
        mean[most] = np.mean([r.score for r in quality.score_quality(d, model).collect()])
    assert abs(mean[1000] - 6 / 7) < 0.05 and abs(mean[60] - mean[1000]) < 0.05
