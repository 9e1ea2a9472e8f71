"""The relation grammar on sentences, against the same rules in plain code."""

import re

from lexigraph.functions import relations_ar as AR
from lexigraph.operators.extract import relation_mentions

TEXTS = [
    "تفقه علي الامام ابي حنيفه رحمه الله وسمع من محمد بن الحسن. وروي عنه ابنه احمد وجماعه",
    "اخذ الفقه عن الشيخ العلامه علي بن ابي بكر ثم قرا التفسير علي خاله محمود، وصحب اهل العلم. تلميذ صاحب الهدايه ببغداد",
    "وعنه حفيده",
    "تفقه بابراهيم بن موسي، مات سنه ثلاثين",
    "سمع ابا بكر بن عياش وهو ثقه",
    "لا شيء هنا",
    "",
    None,
]


def plain(text):
    trigger = re.compile("|".join(f"(?P<t{i}>{AR.BEFORE_TRIGGER}{AR.JOINED}{p})" for i, (p, _, _) in enumerate(AR.TRIGGERS)))
    hits = list(trigger.finditer(text or ""))
    out = []
    for no, (m, after) in enumerate(zip(hits, [*hits[1:], None]), 1):
        clause = text[m.end() : after.start() if after else len(text)] + "\n"
        clause = clause[: re.search(AR.CLAUSE_END, clause).start()]
        s = re.sub(AR.TITLES, "", re.sub(AR.TAIL, "", clause.strip().rstrip(" .،؛")).strip()).strip()
        if not s or re.match(AR.NOT_PERSON, s):
            continue
        _, role, rel = AR.TRIGGERS[int(m.lastgroup[1:])]
        kin = next((k for k in sorted(AR.KIN, key=len, reverse=True) if s == k or s.startswith(k + " ")), None)
        out.append((no, role, rel, s, AR.KIN.get(kin), s[len(kin) :].strip() if kin else s))
    return out


def test_relation_mentions(spark):
    d = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    got = sorted(tuple(r)[:1] + tuple(r)[2:] for r in relation_mentions(d, "text", AR).collect())
    want = sorted((i, *x) for i, t in enumerate(TEXTS) for x in plain(t))
    assert got == want and len(want) >= 8
    assert ("son", "احمد") in {(r[5], r[6]) for r in got}
