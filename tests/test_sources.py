"""Readers and writers on small files, with the rows that they must give."""

import json

import pytest
from pyspark.sql import functions as F

from lexigraph.sources import readers as R, sinks as S


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


BOOK = [
    ("h2", "Preface"), ("p", "skipped"), ("h2", "The book begins"), ("p", "opening words"), ("h2", "1 - First Man"), ("p", "about the first"), ("p", "* see elsewhere"), ("p", "* a variant"),
    ("h3", "Letter B"), ("h2", "2 - Second"), ("h2", "3 - Third"), ("p", "of both"), ("h2", "Life of the Founder"), ("p", "born"), ("h3", "His teachers"), ("p", "many"),
    ("h2", "Chapter of Women"), ("h3", "Aisha"), ("p", "her life"), ("p", "[Fatima] was"), ("h2", "Second series"), ("h2", "1 - Again"), ("p", "anew"), ("h2", "Index"), ("p", "9"),
]


@pytest.fixture(scope="module")
def events(spark):
    rows = [("b", i, tag, text) for i, (tag, text) in enumerate(BOOK)] + [("none", 0, "p", None)]
    return spark.createDataFrame(rows, "book string, pos int, tag string, text string")


def entries(df):
    return [(r.number, r.heading, r.section, r.body) for r in df.where("book = 'b'").orderBy("entry").collect()]


def test_book_entries_with_all_options(events):
    options = dict(start_after_heading="begins$", stop_at_heading="^Index", unnumbered_entry="Founder", section_heading="^(Chapter|Second series)", entry_sections="of Women", entry_paragraph=r"^\[", series={"^Second series": "second"}, preamble_entry="Opening", star_paragraphs=True)
    got = R.book_entries(events, ["book"], **options)
    assert entries(got) == [
        (None, "Opening", None, "opening words"), (1, "First Man", None, "about the first\n\n* a variant"), (2, "Second", "Letter B", ""), (3, "Third", "Letter B", "of both"),
        (None, "Life of the Founder", "Letter B", "born\n\nHis teachers\n\nmany"), (None, "Aisha", "Chapter of Women", "her life"), (None, "[Fatima] was", "Chapter of Women", "[Fatima] was"),
        (1, "Again", "Second series", "anew"),
    ]
    assert [r.series for r in got.where("book = 'b'").orderBy("entry").collect()] == [None] * 7 + ["second"]
    together = R.book_entries(events, ["book"], co_entries=True, start_after_heading="begins$", stop_at_heading="^Life")
    assert [(r.number, r.body, r.together) for r in together.where("book = 'b'").orderBy("entry").collect()] == [(1, "about the first", 1), (2, "of both", 2), (3, "of both", 2)]
    # numbers of a series run without gaps; a book without entries gives no rows
    assert [n for n, *_ in entries(R.book_entries(events, ["book"], stop_at_heading="^Second")) if n] == [1, 2, 3]
    assert got.where("book = 'none' and heading <> 'Opening'").isEmpty() and R.book_entries(events.limit(0), ["book"]).isEmpty()


def test_column_index(spark, tmp_path):
    blocks = [(1, 0, "١\n٢\n٣"), (1, 1, "Abu X"), (1, 2, "One\nTwo\nThree"), (2, 0, "4\n5"), (2, 1, "only one"), (3, 0, "6"), (3, 1, "single")]
    cols = R.column_index(spark.createDataFrame(blocks, "page int, pos int, content string"), not_a_name="Abu .*")
    assert sorted((r.number, r.name) for r in cols.collect()) == [(1, "One"), (2, "Two"), (3, "Three")]
    lines = spark.createDataFrame([(1, "First", 9), (7, "Seven", 9)], "number long, name string, page int")
    first = R.first_of_number(lines, cols)
    assert sorted((r.number, r.name) for r in first.collect()) == [(1, "First"), (2, "Two"), (3, "Three"), (7, "Seven")]
    index = first.select("number", "name", F.lit("").alias("death"), F.lit(1).alias("vol"), "page")
    S.write_index(index, str(tmp_path / "index"))
    assert sorted(map(tuple, R.read_index(spark, str(tmp_path / "index")).collect())) == sorted(map(tuple, index.collect()))


def test_renumbered(spark):
    names = spark.createDataFrame([(1, 11, "a"), (2, 12, "b"), (3, 99, "c")], "page int, number long, name string")
    index = spark.createDataFrame([(11,), (21,)], "number long")
    entries_, report = R.renumbered(names, index, spark.createDataFrame([(12, 21)], "a long, b long"))
    assert sorted(map(tuple, entries_.select("page", "number", "name").collect())) == [(1, 11, "a"), (2, 21, "b"), (3, 99, "c")]
    assert sorted((r.old, r.number, r.note) for r in report.collect()) == [(12, 21, "mended"), (99, 99, "not in the index")]


def test_people_and_records(spark):
    persons = spark.createDataFrame([("p1", 300, None, [("k2",), ("k1",)]), ("p2", None, 450, [("k9",)]), ("p3", None, None, [])], "id string, death_h int, death_est int, sources array<struct<key:string>>")
    records = spark.createDataFrame([("k1", "x", "A", "A son of B", ["a"]), ("k2", "y", "C", "C long", ["c", "d"])], "key string, book_id string, name string, heading string, names array<string>")
    got = {r.id: (r.names, r.headings, r.death, r.sure, r.n_sources) for r in R.load_people(persons, records, ("x",)).collect()}
    assert got == {"p1": (["c", "d", "a"], ["C", "A", "A son of B"], 300, True, 2), "p2": ([], [], 450, False, 1), "p3": ([], [], None, False, 0)}
    e = spark.createDataFrame([("a", "men", "N", 100), ("b", "places", "M", 1), ("c", None, "O", 7)], "key string, section string, name string, death_h int")
    o = spark.createDataFrame([("a", "death_h", "120"), ("c", "death_h", "-"), ("zz", "name", "?")], "key string, field string, value string")
    assert sorted(map(tuple, R.load_records(e, o, "^places").collect()), key=str) == [("a", "men", "N", 120), ("c", None, "O", None)]


def test_yaml_records(spark, tmp_path):
    path = put(tmp_path / "y" / "decisions.yml", "# head\n- a: x:1\n  b: 'y:2'\n  note: two words # said\n- a: z\n  works:\n    - one\n    - \"two\"\n\n")
    got = [r.fields for r in R.read_yaml_records(spark, path).orderBy("no").collect()]
    assert got == [{"a": "x:1", "b": "y:2", "note": "two words"}, {"a": "z", "works": "one|two"}]


def test_maps_and_places(spark, tmp_path):
    square = [[0.001, 0.0], [0.002, 0.0], [1, 0], [1, 1], [0, 0]]
    put(tmp_path / "maps" / "sea.json", json.dumps({"features": [{"geometry": {"type": "Polygon", "coordinates": [square]}}, {"geometry": {"type": "MultiPolygon", "coordinates": [[square], [square[2:]]]}}, {"geometry": {"type": "Point", "coordinates": [1, 2]}}]}))
    got = R.read_geojson_areas(spark, str(tmp_path / "maps")).orderBy("feature", "ring").collect()
    assert [(r.layer, r.feature, r.ring, len(r.points)) for r in got] == [("sea", 0, 0, 4), ("sea", 1, 0, 4), ("sea", 1, 1, 3)]
    put(tmp_path / "texts" / "a.json", json.dumps({"features": [{"properties": {"title": "سَرخس والنسبة السرخسي", "text": "t"}}, {"properties": {"title": "x", "text": ""}}]}))
    assert [(r.key, r.text) for r in R.read_place_texts(spark, str(tmp_path / "texts")).collect()] == [("س رخس", "t")]
    put(tmp_path / "tr" / "ism.tsv", "محمد\tMuhammed\n")
    put(tmp_path / "tr" / "laqab.tsv", "شمس الدين\tŞemseddin\n")
    assert sorted((r.kind, r.first, r.value) for r in R.read_lexicons(spark, str(tmp_path / "tr"), ("ism", "laqab")).collect()) == [("ism", "محمد", "Muhammed"), ("laqab", "شمس", "Şemseddin")]


def test_writers(spark, tmp_path):
    links = spark.createDataFrame([("a", "b", 0.5, 1.0), ("c", "d", 0.9, 1.0)], "a string, b string, sim double, score double")
    persons = spark.createDataFrame([("a",), ("q",)], "id string")
    S.write_pending(links, str(tmp_path / "pending"), persons)
    assert {(r.a, r.no) for r in spark.read.json(str(tmp_path / "pending" / "pairs")).collect()} == {("c", 1), ("a", 2)}
    assert [r.id for r in spark.read.json(str(tmp_path / "pending" / "persons")).collect()] == ["a"]
    S.write_parts({"relations": links, "external": persons}, str(tmp_path / "net"))
    assert spark.read.json(str(tmp_path / "net" / "relations")).count() == 2 and spark.read.json(str(tmp_path / "net" / "external")).count() == 2
    readings = spark.createDataFrame([("k", "x", 1), ("k", "x", 2), ("k", "y", 2)], "id string, name string, year int")
    S.write_panel(readings, str(tmp_path / "panel"), ["id"], ["name", "year"])
    row = spark.read.option("header", True).csv(str(tmp_path / "panel")).first()
    assert (row.id, row.readings, row["name"], row.year, row.name_n, row.year_n) == ("k", "3", "x", "2", "2", "2")


def test_scratch_tables_go_when_asked(spark, monkeypatch):
    from lexigraph import session

    monkeypatch.setattr(session, "_made", [])
    first = session.written(spark.range(3), "one")
    path = first.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert first.count() == 3 and session.scratch(spark, "never-written") and session.clear_scratch(spark) == 1
    import os

    assert not os.path.exists(path) and session.clear_scratch(spark) == 0
