"""Citations, place mentions, relation mentions and works on literal texts of their language packs."""

import pytest
from pyspark.sql import functions as F

from lexigraph.functions import citations_ar, places_ar, text as T
from lexigraph.operators import extract as X


def table(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "id long, text string")


def test_citations(spark):
    rows = [
        "ترجمته فى: الجواهر المضية، برقم ٤٩٤.", 'و"الجواهر المضية" للقرشي (٤/ ٤١٦ - ٤١٧)', "القرشي، الجواهر المضية:٣٩٨،١/ ٣٩٩؛ التميمي",
        "تاج التراجم ٥٩ وفي كتائب أعلام الأخيار، برقم ٥٩٣", "الفوائد البهية ٢١٠ / ٣", "الطبقات السنية ١٢ / ٩", "الجواهر المضية بلا رقم", None, "",
    ]
    got = [(r.id, r.target, r.number, r.vol, r.page) for r in X.references(table(spark, rows), "text", citations_ar).orderBy("id", "at").collect()]
    assert got == [(0, "jawahir", 494, None, None), (1, "jawahir", None, 4, 416), (2, "jawahir", None, 1, 398), (3, "taj_tarajim", None, None, 59), (3, "kataib", 593, None, None), (4, "fawaid", None, 3, 210)]


def test_overlaps_go_to_the_leftmost_then_to_the_first_rule(spark):
    rules = [("long", "b(cd)e"), ("short", "(?i)AB"), ("tie", "bc"), ("end", "f$")]
    got = table(spark, ["abcdef bcde ab", "f", "", None]).select(X.rule_spans(F.col("text"), rules).alias("x")).collect()
    assert [[(s.start, s.stop, s.name, s.match) for s in r.x] if r.x is not None else None for r in got] == [[(0, 2, "short", "ab"), (7, 11, "long", "bcde"), (12, 14, "short", "ab")], [(0, 1, "end", "f")], [], None]


def test_cited_entries(spark):
    entries = spark.createDataFrame([("e1", "b", 7, 1, 10, 12), ("e2", "b", 8, 1, 12, 60), ("e3", "b", 9, 2, 10, 12), ("e4", "c", 7, 1, 10, 12)], "entry string, book string, number int, vol int, page_start int, page_end int")
    refs = spark.createDataFrame([(1, "b", 7, None, None), (2, "b", None, 1, 11), (3, "b", None, None, 12), (4, "b", None, 1, 59), (5, "b", None, 2, 9), (6, "c", None, 2, 11)], "id int, target string, number int, vol int, page int")
    got = X.cited_entries(refs, entries, width=4)
    assert sorted((r.id, r.entry) for r in got.collect()) == [(1, "e1"), (2, "e1"), (2, "e2"), (3, "e1"), (3, "e2"), (3, "e3"), (4, "e2"), (5, "e3")]


def test_places_by_kind_and_pronoun(spark):
    text = "ولد ببخارى سنة ثلاث وتسعين، وقدم بغداد وحدث بها، ثم رحل إلى مكة فجاور بها، وتوفي في رجب سنة خمس وعشرين وخمسمائة بسمرقند، ودفن بجاكرديزه."
    far = "قدم بغداد. " + "كلمه " * 40 + "وحدث بها."
    names = spark.createDataFrame([("بخاري", "BUKHARA"), ("بغداد", "BAGHDAD"), ("مكه", "MAKKA"), ("سمرقند", "SAMARQAND"), ("جاكرديزه", "SAMARQAND"), ("بيت المقدس", "QUDS")], "name string, place string")
    d = table(spark, [text, "روي عنه ابنه، وقدم عليه جده سنه ثمانين", far, "ورحل الى بيت المقدس ومات بها", "مات. بغداد", None, ""]).select("id", T.fold_arabic(F.col("text")).alias("text"))
    got = [(r.id, r.kind, r.place) for r in X.place_mentions(d, "id", "text", names, places_ar).orderBy("id", "at").collect()]
    assert got == [
        (0, "birth", "BUKHARA"), (0, "travel", "BAGHDAD"), (0, "activity", "BAGHDAD"), (0, "travel", "MAKKA"), (0, "residence", "MAKKA"), (0, "death", "SAMARQAND"), (0, "burial", "SAMARQAND"),
        (2, "travel", "BAGHDAD"), (3, "travel", "QUDS"), (3, "death", "QUDS"),
    ]


# The part of the lexicon that the names below ask for.
LEXICON = {
    "ism": "حسين=Hüseyin دلال=Dellâl أحمد=Ahmed نصر=Nasr سهل=Sehl كريم=Kerîm رحمن=Rahmân علي=Alî حجاج=Haccâc منصور=Mansûr قاسم=Kāsım قاضي=Kādî خان=Han محمد=Muhammed عزيز=Azîz حسن=Hasan",
    "nisba": "كرخي=Kerhî حلواني=Halvânî سرخسي=Serahsî سمرقندي=Semerkandî صغناقي=Sığnâkī بزدوي=Pezdevî أوزجندي=Özkendî فرغاني=Fergānî حسين=-",
}
PAIRS = {"ism": {"عبد الرحمن": "Abdurrahman", "عبد الرحمن #gen": "Abdirrahmân", "عبيد الله": "Ubeydullah"}, "laqab": {"شمس الأئمة": "Şemsüleimme", "حسام الدين": "Hüsâmeddin", "فخر الدين": "Fahreddin", "قاضي خان": "Kādîhan"}, "kunya": {"أبو بكر": "Ebû Bekr", "أبو الحسن": "Ebü’l-Hasen"}}


def test_transliterated_names(spark):
    from lexigraph.functions import names_tr
    from lexigraph.operators import transliterate as R

    rows = [(k, *x.split("=")) for k, v in LEXICON.items() for x in v.split(" ")] + [(k, *x) for k, v in PAIRS.items() for x in v.items()]
    lexicon = spark.createDataFrame(rows, "kind string, term string, value string")
    want = [
        ("عبيد الله بن الحسين بن دلال بن دلهم أبو الحسن، الكرخي", "Ebü’l-Hasen Ubeydullah b. Hüseyin b. Dellâl el-Kerhî", "Ebü’l-Hasen el-Kerhî"),
        ("عبد العزيز بن أحمد بن نصر بن صالح الحلواني، الملقب شمس الأئمة", "Şemsüleimme Abdülazîz b. Ahmed b. Nasr el-Halvânî", "Şemsüleimme el-Halvânî"),
        ("محمد بن أحمد بن أبي سهل أبو بكر، السرخسي", "Ebû Bekr Muhammed b. Ahmed b. Ebî Sehl es-Serahsî", "Ebû Bekr es-Serahsî"),
        ("أبو أحمد عبدالكريم بن عبدالرحمن السمرقندي", "Ebû Ahmed Abdülkerîm b. Abdirrahmân es-Semerkandî", "Ebû Ahmed es-Semerkandî"),
        ("الحسين بن علي بن حجاج بن علي الإمام، الملقب حسام الدين الصغناقي", "Hüsâmeddin Hüseyin b. Alî b. Haccâc es-Sığnâkī", "Hüsâmeddin es-Sığnâkī"),
        ("البزدوي", "Pezdevî", "Pezdevî"), ("", "", ""), (None, "", ""), ("النعمان بن ثابت", "Ebû Hanîfe Nu‘mân b. Sâbit", "Ebû Hanîfe"),
    ]
    names = spark.createDataFrame([(i, n) for i, (n, *_) in enumerate(want)] + [(100, "الحسن بن منصور بن أبي القاسم الأوزجندي، الفرغاني، المعروف بقاضي خان، فخر الدين"), (101, "زيد بن أحمد الغريبي"), (102, "أحمد بن الغريب")], "id long, name string")
    fixed = spark.createDataFrame([(8, "Ebû Hanîfe Nu‘mân b. Sâbit", "Ebû Hanîfe")], "id long, full string, short string")
    made = R.transliterated(names, "id", "name", lexicon, names_tr, fixed)
    got = {r.id: (r.full, r.short) for r in made.collect()}
    assert [got[i] for i in range(len(want))] == [x[1:] for x in want]
    assert got[100][1] == "Kādîhan" and got[100][0].startswith("Fahreddin Hasan b. Mansûr")
    assert {(r.kind, r.word): r.n for r in R.missing_words(made.where("id > 100")).collect()} == {("ism", "زيد"): 1, ("nisba", "غريبي"): 1, ("ism", "الغريب"): 1}


def relation_rows(spark, texts, **options):
    from lexigraph.functions import relations_ar
    from lexigraph.operators import mentions as M

    d = table(spark, texts).select("id", T.fold_arabic(T.network_text(F.col("text")) if options.pop("notes", False) else F.col("text")).alias("text"))
    return M.mentions_of(d, "text", relations_ar, **options).orderBy("id", "no").collect()


def test_relation_mentions(spark):
    rows = relation_rows(spark, [
        "تفقّه على أبى بكر الأعمش، وأبى جعفر الهندوانىّ. وتفقّه عليه ابنه أحمد، وأبو نصر.", "وتفقه على مذهب أبي حنيفة، وبرع فيه.", "قرأ على علماء عصره وبلغ رتبة الفضل والكمال",
        "أخذ عن قوام الدين الكاكي عن حسام الدين السغناقي عن حافظ الدين البخاري", "تفقه على شمس الأئمة الكردري، وأخذ العلوم عنه عن فخر الدين قاضي خان، عن ظهير الدين", None, "", "تفقه على أحمد بن حفص XREF4 الزاهد، ومحمد بن سلام، تلميذ أبي حفص",
    ])
    got = [[(r.role, r.name, r.kin, r.student) for r in rows if r.id == i] for i in range(8)]
    assert {("teacher", "ابي بكر الاعمش", "", None), ("teacher", "ابي جعفر الهندواني", "", None), ("student", "احمد", "son", None)} <= set(got[0])
    assert got[1] == got[2] == got[5] == got[6] == []
    assert got[3] == [("teacher", "قوام الدين الكاكي", "", None), ("chain", "حسام الدين السغناقي", "", "قوام الدين الكاكي"), ("chain", "حافظ الدين البخاري", "", "حسام الدين السغناقي")]
    assert [(r[0], r[3]) for r in got[4]][:2] == [("teacher", None), ("chain", "شمس الايمه الكردري")] and got[4][2][3] == "فخر الدين قاضي خان"
    assert [(r.name, r.xref) for r in rows if r.id == 7] == [("احمد بن حفص الزاهد", "4"), ("محمد بن سلام", None)]


def test_vocabulary_and_stop(spark):
    text = "روى عن سفيان، وشعبة، وأبي حنيفة. قال: أخبرنا عن محمد بن علي"
    assert [r.name for r in relation_rows(spark, [text], vocabulary=frozenset({"سفيان"}), stop="قال: ")] == ["سفيان", "شعبه", "ابي حنيفه"]


def test_mentions_of_turns(spark, sf):
    """The query against a plain reading of the same small pack."""
    import re

    from lexigraph.plans import QUERIES
    from lexigraph.plans.network import TURNS

    want = []
    name = re.compile(r"\w{2,}(?: \w{2,}){0,2}")
    for c in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        text, no = c.text.lower(), 0
        for m in re.finditer(r"(?<![^\s,.])(?:(?:with|de|der)\b|(?:by|la|die)\b)", text):
            teacher = re.match("with|der|de", m[0]) is not None
            rest = re.sub(r"^\s*[:,]\s*", " ", text[m.end() :])
            end = re.search(r"[.;:!?\n]", rest)
            segment = rest[: end.start()] if end else rest[:160]
            links = [x.strip(" ,") for x in re.split(r",?\s*\bfrom ", " " + segment)]
            links = [x for x in links if x]
            for k, link in enumerate(links if teacher and len(links) > 1 else [segment if teacher or not links else links[0]]):
                out, student = [], None if k == 0 else before
                for item in re.split(r" , | and ", " " + " ".join(link.replace(",", " , ").split()) + " "):
                    item = " ".join(x for x in item.split() if x not in (",", "and")).strip("()'-[]")
                    item = re.sub(r"(?: (?:of|it))+$", "", item).strip()
                    item = re.sub(r"^(?:(?:sir|dr) )+", "", re.split(r" who\b", item)[0]).strip()
                    if not item:
                        continue
                    kin = "brother" if re.match("with the( |$)", item) else "son" if re.match("the( |$)", item) else ""
                    ok = not re.match(r"(?:the|and|that)\b", item) and (kin or name.fullmatch(item)) and len(item.split()) <= 14
                    if ok:
                        out.append((re.sub("^(with the|the)", "", item).strip() if kin else item, kin))
                    elif out or len(item.split()) > 3:
                        break
                if teacher and len(links) > 1 and not out:
                    break
                for x, kin in out if student is None else out[:1]:
                    want.append((c.conv_id, c.turn, no, ("teacher" if teacher else "student") if student is None else "chain", x, kin, student))
                    no += 1
                before = out[0][0] if out else None
    got = [(r.conv_id, r.turn, r.no, r.role, r.name, r.kin, r.student) for r in QUERIES["ext05_relation_mentions"](spark, sf).collect()]
    key = lambda r: r[:3]
    assert len(want) > 50 and sorted(got, key=key) == sorted(want, key=key)


def test_titles_of_a_subject(spark):
    from lexigraph.functions import works_ar
    from lexigraph.operators import works as W

    rows = [
        "وصنّف «الهداية» و«كفاية المنتهى»، وشرح «الجامع الصغير». وقرأ عليه «القدورى». وذكره فى «الجواهر».", "ووضع «شرحا» على «الهداية»، وله من المصنفات: كتاب «المنتقى». قال فى «الأصل»", None, "", "لا شيء",
    ]
    got = [(r.id, r.title, r.verb) for r in W.titles_of(table(spark, rows), "text", works_ar).orderBy("id", "no").collect()]
    assert got == [(0, "الهداية", None), (0, "كفاية المنتهى", None), (0, "الجامع الصغير", "sharh"), (1, "شرح الهداية", None), (1, "المنتقى", None)]


@pytest.mark.parametrize("title, want", [
    ("شرح الهداية", ("sharh", "الهدايه")), ("حاشية على شرح الوقاية", ("hashiya", "شرح الوقايه")), ("Şerhu’l-Hidâye", ("sharh", "Hidâye")), ("Hâşiye alâ Şerhi’l-Mevâkıf", ("hashiya", "Şerhi’l-Mevâkıf")),
    ("Muhtasaru’l-Kudûrî", ("ikhtisar", "Kudûrî")), ("el-İnâye fî şerhi’l-Hidâye", ("sharh", "Hidâye")), ("el-Hidâye", (None, None)),
])
def test_kinds_of_titles(spark, title, want):
    from lexigraph.functions import works_ar
    from lexigraph.operators import works as W

    t = F.lit(title)
    small = F.concat(F.lower(F.substring(t, 1, 1)), t.substr(F.lit(2), F.length(t)))
    c = F.when(t.rlike("[ء-ي]"), T.fold_arabic(t)).otherwise(small)
    assert tuple(spark.range(1).select(*W.derived_title(c, works_ar.DERIVED)).first()) == want


def test_works_graph(spark):
    import random

    from lexigraph.operators import works as W

    r = random.Random(11)
    pool = [f"{a} {b}" for a in ("alpha", "gamma", "ab") for b in ("one", "two", "red", "blue")] + ["alpha", "gamma", "ab"]
    items = [(k, r.choice(["x", "y", "z", None]), r.sample(pool, r.choice([0, 1, 1, 2, 3])), r.choice(["base", "digest"]), r.choice([None, *pool, "alpha one more", "gamma blue and red", "ab one"])) for k in range(60)]
    group = {k: k for k, *_ in items}
    for _ in items:
        for a in items:
            for b in items:
                if a[1] == b[1] and set(a[2]) & set(b[2]):
                    group[a[0]] = group[b[0]] = min(group[a[0]], group[b[0]])
    first = {}
    for k, _, names, *_ in items:
        for n in names:
            first[n] = min(group[k], first.get(n, group[k]))
    want = {}
    for w in set(group.values()):
        members = [x for x in items if group[x[0]] == w]
        base_name = next((x[4] for x in members if x[4]), None)
        base = None
        if base_name:
            words = base_name.split()
            starts = [" ".join(words[:k]) for k in range(1, len(words))]
            found = [first[n] for n in starts if len(n) >= 5 and n in first and first[n] != w]
            base = first[base_name] if first.get(base_name, w) != w else min(found, default=None)
        want[w] = (members[0][1], members[0][3], [x[0] for x in members], base)
    for seed in (1, 2):
        rows = random.Random(seed).sample(items, len(items))
        got = W.works_graph(spark.createDataFrame(rows, "ord long, author string, names array<string>, kind string, base_name string").repartition(3))
        assert {x.work: (x.author, x.kind, list(x["items"]), x.base) for x in got.collect()} == want


def test_works_graph_makes_its_items_once(spark):
    from lexigraph.operators import works as W

    made = spark.sparkContext.accumulator(0)

    def names(k):
        made.add(1)
        return [f"name {k % 5}", f"name {k}"]

    rows = [(k, "x", "base", f"name {k % 7}") for k in range(40)]
    items = spark.createDataFrame(rows, "ord long, author string, kind string, base_name string").withColumn("names", F.udf(names, "array<string>").asNondeterministic()("ord"))
    assert sorted((x.work, len(x["items"])) for x in W.works_graph(items).collect()) == [(k, 8) for k in range(5)]
    assert made.value == 40


def test_works_graph_reads_texts_once(spark, sf, monkeypatch):
    from lexigraph.operators import works as W
    from lexigraph.plans import QUERIES

    graph, seen = W.works_graph, []
    monkeypatch.setattr(W, "works_graph", lambda items, least: seen.append(items) or graph(items, least))
    QUERIES["grf14_works_graph"](spark, sf)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and plan.count("regexp_extract_all") > 0


def test_first_stems(spark):
    import random
    import re

    from lexigraph.plans import names as N

    r = random.Random(5)
    texts = ["", None, "one", "Alpha " * 8 + "1" * (N.HEAD - 50) + " gamma delta", "1" * (N.HEAD - 2) + "abcdefg " * 12, "ab " * N.HEAD + "İst KLM nine ΟΔΟΣ abc", "слово" * N.HEAD + " one two three four"]
    texts += [" ".join("".join(r.choices("abcİ1é𝔞", k=r.randint(1, n))) for _ in range(r.randint(1, 300))) for n in range(3, 9) for _ in range(20)]
    texts += [" " * (N.HEAD - k) + "word one-two" * 9 for k in range(1, 120)]
    df = table(spark, texts).select("id", "text")
    for letters, first in ((3, 9), (4, 4), (4, None)):
        want = {k: None if x is None else [w[:letters] for w in re.findall(f"[a-z]{{{letters},}}", x.lower())][:first] for k, x in enumerate(texts)}
        assert {x.id: x.w for x in N._stems(lambda _: df, "documents", "id", letters, first).collect()} == want


def test_display_names(spark):
    from lexigraph.functions import names_tr

    want = {
        "الحسن بن منصور بن أبي القاسم الأوزجندي، الفرغاني الإمام الكبير، المعروف بقاضي خان": "قاضي خان", "عبيد الله بن الحسين بن دلال بن دلهم أبو الحسن، الكرخي": "أبو الحسن الكرخي",
        "عبد العزيز بن أحمد بن نصر بن صالح الحلواني، الملقب شمس الأئمة": "شمس الأئمة الحلواني", "الحسين بن علي بن حجاج بن علي الإمام، الملقب حسام الدين الصغناقي": "حسام الدين الصغناقي", "خطيب زاده": "خطيب زاده",
        "البزدوي": "البزدوي", "محمد بن أبي بكر": "محمد بن أبي بكر", "": "",
    }
    rows = spark.createDataFrame([*want.items(), (None, None)], "name string, want string").withColumn("got", T.display_name(F.col("name"), names_tr)).collect()
    assert [(r.got, r.name) for r in rows] == [(r.want, r.name) for r in rows]


def test_parts_of_names(spark):
    from lexigraph.functions import names_ar
    from lexigraph.operators import names as P

    texts = [
        "٦ - إبراهيم بن أحمد بن أبى الفرج ابن أبى عبد الله بن الشريد الدمشقى، أبو إسحاق، المنعوت زين الدين", "[٥٥٦ - قوام الدين الأتقاني]", "أبو عبد الله البصري", "أبو العباس أحمد بن محمد", "عبدالله بن عبيد الله الكوفي الحنفي",
        "كمال الدين ابن الهمام", "محمد بن محمد - مرتين - بن علي", None, "",
    ]
    d = table(spark, texts).select("id", T.fold_arabic(T.heading_name(F.col("text"))).alias("name"))
    got = {r.id: (list(r.parts.chain), r.parts.kunya, list(r.parts.nisbas), list(r.parts.laqabs)) for r in P.with_name_parts(d, "name", names_ar).collect()}
    assert got[0][0] == ["ابراهيم", "احمد", "ابو الفرج", "ابو عبد الله", "الشريد"] and got[0][1] == "ابو اسحاق" and "الدمشقي" in got[0][2] and got[0][3] == ["زين الدين"]
    assert got[1] == ([], "", ["الاتقاني"], ["قوام الدين"]) and got[2] == ([], "ابو عبد الله", ["البصري"], [])
    assert got[3] == (["احمد", "محمد"], "ابو العباس", [], []) and got[4] == (["عبد الله", "عبيد الله"], "", ["الكوفي"], [])
    assert got[5] == ([], "", ["ابن الهمام"], ["كمال الدين"]) and got[6][0] == ["محمد", "محمد", "علي"] and got[7] == got[8] == ([], "", [], [])


def test_name_variants_and_frequencies(spark):
    from lexigraph.functions import names_ar
    from lexigraph.operators import names as P

    d = spark.createDataFrame([("a", "احمد بن محمد", "احمد بن محمد", None), ("b", "محمد الكوفي", "ابو بكر محمد بن علي", "محمد بن علي بن عمر"), ("c", "", None, None), ("d", "محمد", None, "محمد بن علي")], "key string, heading string, lead string, fixed string")
    v = P.name_variants(d, "key", ["heading", "lead", "fixed"], names_ar)
    assert {r.key: [list(n.chain) for n in r.names] for r in v.collect()} == {"a": [["احمد", "محمد"]], "b": [["محمد"], ["محمد", "علي"], ["محمد", "علي", "عمر"]], "d": [["محمد"], ["محمد", "علي"]]}
    assert {r["first"]: r.n for r in P.first_name_counts(v).collect()} == {"احمد": 1, "محمد": 2}
