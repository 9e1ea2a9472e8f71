"""Functions and operators on literal inputs."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lexigraph.functions import numbers as N, text as X
from lexigraph.operators import extract, graph, joins, match, overlay, sequences
from lexigraph.sources import readers, sinks


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_folds(spark):
    s = F.lit("  كِتَابُ  أَحـمد إلى آل  ")
    assert one(spark, X.fold_arabic(s)) == ("كتاب احمد الي ال",)
    assert one(spark, X.fold_latin(F.lit("Éclair über"))) == ("eclair uber",)
    assert one(spark, X.digits_western(F.lit("٣٤٥")), X.digits_eastern(F.lit("345"))) == ("345", "٣٤٥")


def test_titles(spark):
    assert one(spark, X.title_key(F.lit("كتاب الهداية"))) == ("ar:هدايه",)
    assert one(spark, X.title_key(F.lit("Kenzü’d-dekāik"))) == one(spark, X.title_key(F.lit("Kenzü'd-dekāiku")))
    assert one(spark, *extract.derive(F.lit("Commentary on Kenz"), [(r"Commentary on\s+", "sharh")])) == ("sharh", "Kenz")
    assert one(spark, *extract.derive(F.lit("Kenz"), [(r"Commentary on\s+", "sharh")])) == (None, None)


def test_clean_blocks(spark):
    text = "First half of\n\nthe sentence.\n\nNext [^1] block ,here\n\n# Head\n\nbody<hr>notes"
    assert one(spark, X.clean_blocks(F.lit(text)))[0] == ["First half of the sentence.", "Next block,here", "# Head", "body"]


def test_quote_and_excerpt(spark):
    assert one(spark, X.quote(F.lit("Short text."))) == ("Short text.",)
    long = "A sentence of words. " * 30
    q, = one(spark, X.quote(F.lit(long)))
    assert q.endswith(". …") and len(q) <= 322
    e, = one(spark, X.excerpt(F.lit("word " * 100)))
    assert e.endswith("…") and len(e) <= 242


def test_calendar(spark):
    assert one(spark, N.hijri_to_gregorian(F.lit(1)), N.hijri_to_gregorian(F.lit(816)), N.hijri_to_gregorian(F.lit(1400))) == (622, 1413, 1979)
    assert one(spark, N.common_era(F.lit(150)), N.century(F.lit(700)), N.century(F.lit(701))) == (767, 7, 8)
    assert one(spark, N.roman(F.lit(1994)), N.roman(F.lit(48))) == ("MCMXCIV", "XLVIII")
    assert one(spark, N.death_note(F.lit(816))) == ("٨١٦هـ/١٤١٣م",)


def test_spelled_numbers(spark):
    assert one(spark, N.spelled_number(F.split(F.lit("five hundred and ninety five years"), " "))) == (595,)
    ar = N.spelled_number(F.transform(F.split(F.lit("خمس وتسعين وخمس مايه"), " "), lambda w: F.regexp_replace(w, "^و", "")), N.ONES_AR, N.TENS_AR, ("مايه",), ("الف",), ())
    assert one(spark, ar) == (595,)
    assert one(spark, N.spelled_number(F.split(F.lit("none here"), " "))) == (None,)


@pytest.mark.parametrize("numbers, last, want", [([5, 9], 4, 5), ([11], 4, None), ([16], 14, 16), ([19], 14, 19), ([25], 14, 15), ([], 3, None)])
def test_pick_number(spark, numbers, last, want):
    array = F.array(*map(F.lit, numbers)) if numbers else F.array().cast("array<int>")
    assert one(spark, N.pick_number(array, F.lit(last))) == (want,)


def test_names(spark):
    n = spark.createDataFrame([("Abu Bakr Muhammad ibn Abd al-Karim ibn Umar Shams al-Din al-Bukhari",), (None,)], "n string").select(extract.parse_name("n").alias("x")).collect()
    assert n[0].x.chain == ["Muhammad", "Abd al-Karim", "Umar"] and n[0].x.kunya == "Abu Bakr" and n[0].x.nisbas == ["al-Bukhari"] and n[0].x.laqabs == ["Shams al-Din"]
    assert n[1].x.chain == []


def test_components_are_partition_independent(spark):
    edges = [(i, i + 1) for i in range(0, 40) if i % 10] + [(100, 1), (7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = [sorted(map(tuple, graph.connected_components(df.repartition(n)).collect())) for n in (1, 7)]
    assert got[0] == got[1] and dict(got[0])[100] == 1 and dict(got[0])[10] == 1 and dict(got[0])[19] == 11
    assert graph.connected_components(df.where("false")).count() == 0


def test_constrained_clusters(spark):
    nodes = spark.createDataFrame([(i, "s" + str(i % 3)) for i in range(1, 7)], "id long, source string")
    links = spark.createDataFrame([(1, 2, 1, 0.9), (2, 3, 1, 0.8), (3, 4, 1, 0.95), (5, 6, 1, 0.7)], "a long, b long, priority int, score double")
    wall = spark.createDataFrame([(5, 6)], "a long, b long")
    got = dict(map(tuple, match.constrained_clusters(nodes, links, wall, exclusive="source").collect()))
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6}


def test_shortest_paths_and_roots(spark):
    e = spark.createDataFrame([(0, 1, 5.0), (1, 2, 1.0), (0, 2, 9.0)], "src long, dst long, km double")
    got = {r.node: (r.km, r.path) for r in graph.shortest_paths(e, spark.range(1).toDF("node")).collect()}
    assert got[2] == (6.0, [0, 1, 2])
    t = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3)], "node long, parent long")
    assert {r.node: (r.root, r.hops) for r in graph.roots(t).collect()}[4] == (1, 3)


def test_range_join_and_upsert(spark):
    p = spark.range(20).toDF("x")
    r = spark.createDataFrame([(1, 3, 8), (2, 8, 8), (3, 15, 40)], "id int, lo int, hi int")
    got = joins.range_join(p, r, "x", "lo", "hi", 4)
    assert sorted((a.x, a.id) for a in got.collect()) == [(x, i) for x in range(20) for i, lo, hi in ((1, 3, 8), (2, 8, 8), (3, 15, 40)) if lo <= x <= hi]
    b = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    f = spark.createDataFrame([(1, "a"), (2, "x"), (3, "c")], "k int, v string")
    assert sorted(map(tuple, joins.upsert(b, f, ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_sequences(spark):
    d = spark.createDataFrame([("b", 1, 1), ("b", 2, None), ("b", 3, None), ("b", 4, 4), ("b", 5, None), ("b", 6, 9)], "k string, pos int, n int")
    assert [r.filled for r in sequences.fill_pending(d, ["k"], [F.col("pos")], "n").orderBy("pos").collect()] == [1, 2, 3, 4, None, 9]
    assert sorted(r.n for r in sequences.gaps(d.where("n is not null"), ["k"], "n").collect()) == [2, 3, 5, 6, 7, 8]
    e = spark.createDataFrame([(1, "r", 0, 5), (2, "r", 3, 6), (3, "r", 5, 7)], "id long, k string, s long, e long")
    assert {r.id: r.lane for r in sequences.lanes(e, ["k"], "s", "e", "id").collect()} == {1: 0, 2: 1, 3: 0}


def test_alignment(spark):
    h = spark.createDataFrame([("b", i, n) for i, n in enumerate(["Ahmad son of Ali", "Bakr son of Zayd", "Umar the judge"])], "book string, pos long, name string")
    x = spark.createDataFrame([("b", i, n) for i, n in enumerate(["Ahmad son of Ali", "an extra row entirely", "Bakr son of Zaid", "Umar the judge"])], "book string, pos long, name string")
    assert sorted((r.head, r.entry) for r in extract.align(h, x, "book").collect()) == [(0, 0), (1, 2), (2, 3)]


def test_changes(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], "k int, v string, w int")
    b = spark.createDataFrame([(1, "z", 1), (3, "n", 3)], "k int, v string, w int")
    got = sorted(map(tuple, overlay.changes(a, b, ["k"]).collect()), key=str)
    assert (1, "v", "x", "z") in got and (2, "w", "2", None) in got and len(got) == 5


def test_epub_and_sections(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.epub", "w") as z:
        z.writestr("OEBPS/book.opf", '<manifest><item id="i2" href="two.xhtml"/><item id="i1" href="one.xhtml"/></manifest><spine><itemref idref="i1"/><itemref idref="i2"/></spine>')
        z.writestr("OEBPS/one.xhtml", "<h1>Part</h1><h2>First man</h2><p>text a</p><p>text b</p>")
        z.writestr("OEBPS/two.xhtml", "<h2>Second man</h2><p>text c</p><h2>Index</h2><p>x</p>")
    pages = readers.READERS["epub"](spark, str(tmp_path))
    assert [r.href for r in pages.orderBy("spine").collect()] == ["one.xhtml", "two.xhtml"]
    e = readers.segment_entries(readers.html_events(pages, ["spine"], "xhtml"), ["spine"], stop="^Index$")
    assert [(r.section, r.heading, r.body) for r in e.orderBy("spine", "entry").collect()] == [("Part", "First man", "text a\ntext b"), (None, "Second man", "text c")]


def test_ocr_lexicon_index(spark, tmp_path):
    (tmp_path / "ocr").mkdir()
    for n in (2, 10):
        (tmp_path / "ocr" / f"page-{n}.json").write_text(json.dumps({"blocks": [{"type": "text", "content": f"[{n}] name", "topLeftY": 1.0}, {"type": "text", "content": f"[{n}] name", "topLeftY": 2.0}], "dimensions": {"height": 100.0}}))
    got = readers.read_book(spark, {"book_id": "b", "parser": "ocr_pages", "first": 2, "last": 9}, str(tmp_path / "ocr")).collect()
    assert [(r.page, r.content, r.book_id) for r in got] == [(2, "[2] name", "b")]
    (tmp_path / "l.tsv").write_text("# comment\nali\tAli\nali\tAly\nzz\t-\n")
    assert sorted(map(tuple, readers.read_lexicon(spark, str(tmp_path / "l.tsv")).collect())) == [("ali", "Aly"), ("zz", None)]
    lines = spark.createDataFrame([(0, "12 | Ahmad | 350 | 7"), (1, "13 - Bakr"), (2, "12 | other | 1 | 1"), (3, "text")], "pos int, line string")
    assert sorted((r.number, r.name, r.page) for r in readers.index_rows(lines).collect()) == [(12, "Ahmad", 7), (13, "Bakr", None)]


def test_sharded_writer(spark, tmp_path):
    sinks.write_sharded(spark.range(200).select(F.concat(F.lit("p"), "id").alias("id")), "id", str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert back.count() == 200 and back.where("shard <> int(substring(id, 2, 9)) % 64").count() == 0


def test_collated_order(spark):
    words = ["Zebra", "éclair", "eclair", "Eclair", "zèbre", "apple", "Äpfel"]
    d = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r.w for r in d.orderBy(F.collate("w", "UNICODE")).collect()] == ["Äpfel", "apple", "eclair", "Eclair", "éclair", "Zebra", "zèbre"]
    assert d.where(F.collate("w", "UNICODE_CI_AI") == F.lit("ECLAIR").cast("string")).count() == 3


def test_recursive_roots(spark):
    c = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, None), (5, 6), (6, 5)], "node long, parent long")
    assert sorted(map(tuple, graph.recursive_roots(c).collect())) == [(1, 1, 0), (2, 1, 1), (3, 1, 2), (4, 4, 0)]


def test_rows_with_null_texts_stay(spark, tmp_path):
    from lexigraph.plans import QUERIES

    rows = [(1, None, "a", "en", 0), (2, "same words here and there again", "a", "en", 1), (3, None, "b", "en", 0), (4, "same words here and there again", "b", "en", 1), (5, "", "b", "en", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.cluster_id for r in QUERIES["cluster_components"](spark, str(tmp_path)).collect()} == {1: 1, 2: 2, 3: 1, 4: 2, 5: 5}
    assert {r.doc_id: r.rep for r in QUERIES["ext_members"](spark, str(tmp_path)).collect()} == {1: 1, 2: 2, 3: 1, 4: 2, 5: 5}
    assert {r.doc_id: r.n for r in QUERIES["agg29_text_frequency"](spark, str(tmp_path)).collect()} == {1: 2, 2: 2, 3: 2, 4: 2, 5: 1}


def test_long_texts_are_not_cut(spark):
    long = "x" * 250_000
    d = spark.createDataFrame([("ال" + long, "ابنه " + long, "i" + long)], "a string, k string, c string")
    rest, name, large = d.select(X.article_off(F.col("a")), extract.kin_of(F.col("k"), {"ابنه": "son"})[1], X.capitalised(F.col("c"))).first()
    assert rest == long and name == long and large == "İ" + long


def test_whole_sets_are_dealt_to_chunks_and_prefixes_are_not_written(spark, monkeypatch):
    names = []
    kept = match.written
    monkeypatch.setattr(match, "written", lambda d, name: names.append(name) or kept(d, name))
    sets = spark.range(40).select("id", F.when(F.col("id") < 39, F.concat(F.array(F.col("id") + 1000), F.sequence(F.lit(1), F.lit(30)))).otherwise(F.array(F.lit(5000))).alias("items"))
    found = match.similar_sets(sets, 0.6)
    assert {(r.a, r.b, r.shared, r.n, r.m) for r in found.collect()} == {(a, b, 30, 31, 31) for b in range(39) for a in range(b)}
    # 741 pairs of 39 sets: no row that is dealt has a pair and a set
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "prefixes" not in names and "CoGroup" in plan and "a_items" not in plan


def test_similar_sets_are_complete(spark):
    import random

    r = random.Random(9)
    common = list(range(40))
    sets = [(k, r.sample(common, 20) + r.sample(range(100, 400), r.randint(0, 30))) for k in range(60)] + [(100, []), (101, None), (102, [7]), (103, [7])]
    sets += [(200 + k, sorted(set(sets[k][1]) - {sets[k][1][0]})) for k in range(20)]
    got = {(x.a, x.b): (x.shared, x.n, x.m) for x in match.similar_sets(spark.createDataFrame(sets, "id long, items array<long>"), 0.6).collect()}
    s = {k: set(v or ()) for k, v in sets}
    want = {(a, b): (len(s[a] & s[b]), len(s[a]), len(s[b])) for a in s for b in s if a < b and s[a] and s[b] and len(s[a] & s[b]) >= 0.6 * len(s[a] | s[b])}
    assert got == want and len(want) > 20


def test_recursion_of_many_rows(spark):
    c = spark.range(1, 301).select(F.col("id").alias("node"), F.when(F.col("id") > 1, F.floor(F.col("id") / 2)).alias("parent"))
    spark.conf.set("spark.sql.cteRecursionRowLimit", "100")
    try:
        assert graph.recursive_roots(c).where("root = 1").count() == 300
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")


def test_gaps_are_dealt_once(spark):
    d = spark.createDataFrame([(1, 2), (1, 2), (1, 7), (2, 4), (None, 3), (None, 5), (3, None)], "k long, n long")
    g = sequences.gaps(d, ["k"], "n")
    assert sorted(map(tuple, g.where("k is not null").collect())) == [(1, 3), (1, 4), (1, 5), (1, 6)]
    # as in SQL a null key equals nothing
    assert sorted(r.n for r in g.where("k is null").collect()) == [3, 4, 5]
    assert "Join" not in g._jdf.queryExecution().optimizedPlan().toString()


def test_lanes_of_many_at_once(spark):
    # 20,000 intervals that all overlap, then some that fit in the first lanes again: no walk over the lanes
    d = spark.range(20_000).select(F.lit("k").alias("k"), "id", F.col("id").alias("s"), (F.col("id") + 20_000).alias("e"))
    d = d.union(spark.range(20_000, 20_005).select(F.lit("k"), "id", "id", F.col("id") + 1))
    d = d.union(spark.createDataFrame([("n", 1, None, 5), ("n", 2, 1, None), ("n", 3, 9, 10)], "k string, id long, s long, e long"))
    got = {r.id: r.lane for r in sequences.lanes(d.where("k = 'k'"), ["k"], "s", "e", "id").collect()}
    assert all(got[i] == i for i in range(20_000)) and [got[20_000 + i] for i in range(5)] == [0, 0, 0, 0, 0]
    assert {r.id: r.lane for r in sequences.lanes(d.where("k = 'n'"), ["k"], "s", "e", "id").collect()} == {2: 0, 3: 1, 1: 2}


def test_opposite_edges_meet_without_a_join(spark, tmp_path):
    from lexigraph.plans import QUERIES

    rows = [(1, 2)] * 2 + [(2, 1)] * 3 + [(3, 4), (4, 3), (5, 5), (6, 1), (None, 2), (7, None)]
    spark.createDataFrame(rows, "l_suppkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    d = QUERIES["agg15_reverse_edges"](spark, str(tmp_path))
    assert sorted(map(tuple, d.collect())) == [(2, 1, 3), (3, 4, 1), (6, 1, 1)]
    assert "Join" not in d._jdf.queryExecution().optimizedPlan().toString()


def test_votes_are_dealt_once(spark, tmp_path):
    from lexigraph.plans import QUERIES

    rows = [(1, 5.0), (1, 6.0), (1, 9.0), (1, None), (2, 3.0), (None, 4.0), (None, 4.0), (3, 8.0), (3, 8.0), (3, 2.0), (3, 2.0)]
    spark.createDataFrame(rows, "l_orderkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    d = QUERIES["agg07_support_vote"](spark, str(tmp_path))
    assert sorted(map(tuple, d.collect())) == [(1, 5, 2), (3, 2, 2)]
    assert d._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange") == 1


def test_scores_have_as_many_tasks_as_rows_ask_for(spark, tmp_path):
    from lexigraph.plans import QUERIES

    spark.range(50_000).select(F.col("id").alias("c_custkey"), F.lit(1).alias("c_nationkey"), (F.col("id") % 20_000 / 2).alias("c_acctbal")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(20).select(F.col("id").alias("s_suppkey"), F.lit(1).alias("s_nationkey"), (F.col("id") * 500.0).alias("s_acctbal")).write.parquet(f"{tmp_path}/supplier.parquet")
    d = QUERIES["agg05_name_score"](spark, str(tmp_path))
    c, s = [k % 20_000 / 2 for k in range(50_000)], [k * 500.0 for k in range(20)]
    assert d.count() == sum(abs(x - y) <= 500 for x in c for y in s) and d.rdd.getNumPartitions() >= 12


def test_name_score_of_pairs_in_different_places(spark, tmp_path):
    from lexigraph.plans import ORACLE_SQL, QUERIES
    from tests.compare import compare, connect

    spark.createDataFrame([(1, 1, 0.0), (2, 2, 450.0), (3, None, -99.5), (4, 1, None)], "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(7, 1, 50.0), (8, 3, 500.0), (9, None, 0.0)], "s_suppkey long, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    d = QUERIES["agg05_name_score"](spark, str(tmp_path))
    assert sorted(map(tuple, d.collect())) == [(1, 7, 3.0), (1, 8, -1.0), (1, 9, 2.0), (2, 7, 0.0), (2, 8, 2.0), (2, 9, -1.0), (3, 7, 1.0), (3, 9, 2.0)]
    assert compare(d, connect(str(tmp_path)), ORACLE_SQL["agg05_name_score"]) == ""


def test_likeness_of_copies_costs_no_pairs(spark, tmp_path):
    import difflib

    from lexigraph.plans import QUERIES

    names = {k: ["tide", "diet", None, "edit"][k % 4] for k in range(40)}
    spark.createDataFrame([(k, n, "b", 1) for k, n in names.items()], "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    rep = {r.p_partkey: r.rep for r in QUERIES["ext_name_members"](spark, str(tmp_path)).collect()}
    got = {(r.a, r.b): r.ratio for r in QUERIES["str26_sequence_ratio"](spark, str(tmp_path)).collect()}
    assert len(got) == 12 and rep == {k: k % 4 for k in range(40)}
    for x in names:
        for y in range(x + 1, 40):
            if names[x] != names[y]:
                known = names[x] is not None and names[y] is not None
                want = round(difflib.SequenceMatcher(None, names[x], names[y], autojunk=False).ratio(), 6) if known else None
                assert got[rep[x], rep[y]] == want


def test_bitmaps_bound_what_sets_share(spark):
    a, b = list(range(-300, 700)), list(range(0, 1000, 1)) + [4096 * 7 + 5]
    d = spark.createDataFrame([(a, b)], "a array<long>, b array<long>").select(match._bitmap("a").alias("x"), match._bitmap("b").alias("y"))
    left, right = d.select(match._alone("x", "y"), match._alone("y", "x")).first()
    assert 0 < left <= len(set(a) - set(b)) and 0 < right <= len(set(b) - set(a))


def test_layers_are_numbered_without_a_window_over_them(spark):
    placed = graph._placed(spark.range(5000).select(F.col("id").alias("node"), (F.col("id") % 2).alias("layer")), ["node"])
    assert {r.layer: (r.a, r.b) for r in placed.groupBy("layer").agg(F.min("pos").alias("a"), F.max("pos").alias("b")).collect()} == {0: (1.0, 2500.0), 1: (1.0, 2500.0)}
    assert "partitionBy" not in str(placed) and "windowspecdefinition(layer" not in placed._jdf.queryExecution().optimizedPlan().toString()
