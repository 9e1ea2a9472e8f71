"""Books by a Python data source and their configurations."""

import zipfile

import pytest

from lexigraph.sources import books, configs

CONFIG = """
book_id: zipped
title: A book   # with a comment
author_death_h: 1014
parser: turath_epub
source: raw/zipped.epub
# the preamble has no heading
preamble_entry: {vol: 1, page: 127, title: "The Founder: a life"}
unnumbered_entry: "^(Chapter on (merits|virtue) |The last$)"
section_heading: '^(Letter|Book|Southern) #?'
series:
  "^Southern ": south
  '^Northern ': north
lists:
  - one
  - {a: 1, b: [x, "y, z"]}
  - key: v
    more:
      - 2
      - 'it''s'
empty:
stop_at_heading: "^Epilogue$"
"""


def test_nested_configuration():
    c = configs.parse(CONFIG)
    assert c["preamble_entry"] == {"vol": 1, "page": 127, "title": "The Founder: a life"} and c["author_death_h"] == 1014 and c["title"] == "A book"
    assert c["series"] == {"^Southern ": "south", "^Northern ": "north"} and c["section_heading"] == "^(Letter|Book|Southern) #?" and c["empty"] is None
    assert c["lists"] == ["one", {"a": 1, "b": ["x", "y, z"]}, {"key": "v", "more": [2, "it's"]}]
    assert configs.parse("") == {} and configs.parse("same:\n- [a, b]\n- [c, d]\n") == {"same": [["a", "b"], ["c", "d"]]}
    assert configs.parse("jawahir:1:\n  death: 150\nx:k: [[a, b], 3.5]\n") == {"jawahir:1": {"death": 150}, "x:k": [["a", "b"], 3.5]}
    assert configs.parse('a: "long \n  text"\nb: plain\n  words\n  more\nc:\n- one\n  two\n- d: x\n') == {"a": "long text", "b": "plain words more", "c": ["one two", {"d": "x"}]}
    with pytest.raises(ValueError):
        configs.parse("just words\n")


@pytest.fixture
def shelf(tmp_path):
    pages = [
        "<p>born in the year</p><h2>Letter A</h2><h3>1 - Adam</h3><p>first <b>words</b></p>", "<p>more of Adam</p><h3>2 - Aaron</h3>", "<p>of Aaron</p><h2>Letter B</h2><h3>Chapter on merits of Basil</h3><p>merits</p>",
        "<h2>Southern people</h2><h3>1 - Saul</h3><p>south</p>", "<h2>Epilogue</h2><h3>9 - Nobody</h3><p>gone</p>",
    ]
    (tmp_path / "raw").mkdir()
    (tmp_path / "books").mkdir()
    with zipfile.ZipFile(tmp_path / "raw" / "zipped.epub", "w") as z:
        items = "".join(f'<item href="p{i}.xhtml" id="i{i}"/>' for i in range(len(pages)))
        z.writestr("OEBPS/content.opf", f"<manifest>{items}</manifest><spine>{''.join(f'<itemref idref=\"i{i}\"/>' for i in range(len(pages)))}<itemref idref=\"missing\"/></spine>")
        for i in reversed(range(len(pages))):
            z.writestr(f"OEBPS/p{i}.xhtml", f"<html><body>{pages[i]}</body></html>")
    (tmp_path / "books" / "zipped.yml").write_text(CONFIG, encoding="utf-8")
    (tmp_path / "books" / "ocr.yml").write_text("book_id: other\nparser: mistral_ocr\nsource: nowhere\n", encoding="utf-8")
    return tmp_path


def test_books_as_a_source(spark, shelf):
    spark.dataSource.register(books.BookSource)
    events = spark.read.format("book").option("base", str(shelf)).option("pages", 2).load(str(shelf / "books"))
    assert events.rdd.getNumPartitions() == 3 and events.count() == 16
    assert events.schema.simpleString() == "struct<book_id:string,spine:int,href:string,pos:int,tag:string,text:string>"
    got = books.read_books(spark, str(shelf / "books"), str(shelf))
    assert [(r.number, r.heading, r.section, r.series, r.body, r.vol, r.page) for r in got.orderBy("entry").collect()] == [
        (None, "The Founder: a life", None, None, "born in the year", 1, 127), (1, "Adam", "Letter A", None, "first words\n\nmore of Adam", None, None), (2, "Aaron", "Letter A", None, "of Aaron", None, None),
        (None, "Chapter on merits of Basil", "Letter B", None, "merits", None, None), (1, "Saul", "Southern people", "south", "south", None, None),
    ]

EXTRA = """
alias:
  بخارى القديمة: B1
  قديم: nowhere
new:
  x:one: [[كاشغر, كاشغار], 39.5, 76.0, towns, Turkistan]
label:
  B1: Bukhara
nisba:
  البخاري: B1
  الخاص: x:one
ignore: [بصرى]
prefixed_only:
  - بصرى
nisba_ignore: [الحلواني]
"""


def test_gazetteer_with_additions(spark, tmp_path):
    from lexigraph.sources.gazetteer import Gazetteer, read_review

    (tmp_path / "extra.yml").write_text(EXTRA, encoding="utf-8")
    rows = [
        ("B1", "بخارى", "", 39.8, 64.4, "capitals", "Transoxiana"), ("B2", "بخارى", "", 1.0, 1.0, "villages", "Iraq"), ("S1", "سمرقند", "شمرقند, ", 39.6, 67.0, "metropoles", "Transoxiana"), ("S2", "سمرقند", "", 0.0, 0.0, "metropoles", "Yemen"),
        ("U1", "بصرى", "", 32.0, 36.0, "towns", "Sham"), ("H1", "حلوان", "", 34.0, 45.0, "towns", "Iraq"), ("W1", "نهر", "", 1.0, 1.0, "waters", "Iraq"), ("A1", "الاسكندرية", "", 31.0, 29.0, "towns", "Egypt"), ("T1", "مر", "", 1.0, 1.0, "towns", "Iraq"),
    ]
    g = Gazetteer(spark.createDataFrame(rows, "uri string, ar string, ar_other string, lat double, lon double, type string, region string"), read_review(spark, str(tmp_path / "extra.yml")))
    names = {(r.name, r["rank"]): r.place for r in g.names.collect()}
    assert names == {("بخاري", 1): "B1", ("بخاري", 2): "B2", ("سمرقند", 1): "S1", ("سمرقند", 2): "S2", ("شمرقند", 1): "S1", ("حلوان", 1): "H1", ("الاسكندريه", 1): "A1", ("كاشغر", 1): "x:one", ("كاشغار", 1): "x:one", ("بخاري القديمه", 1): "B1"}
    assert {r.place: r.label for r in g.places.collect()}["B1"] == "Bukhara" and {(r.name, r.place) for r in g.prefixed.collect()} == {("بصري", "U1")}
    nisbas = {r.nisba: r.place for r in g.nisbas.collect()}
    assert nisbas["البخاري"] == "B1" and nisbas["السمرقندي"] == "S1" and nisbas["الاسكندري"] == "A1" and nisbas["الخاص"] == "x:one" and "الحلواني" not in nisbas


def test_review_files(spark, tmp_path):
    from lexigraph.sources.gazetteer import field_overrides, outside_people, read_review

    (tmp_path / "overrides.yml").write_text("b:1:\n  ad: A Man, of Town\n  vefat: 150\nb:2:\n  vefat: null\n", encoding="utf-8")
    (tmp_path / "external.yml").write_text("early:\n  ابن عمر | ابن العمر: [73, عبد الله]\nlate:\n  x: [256, \"Y, Z\"]\n", encoding="utf-8")
    o = field_overrides(read_review(spark, str(tmp_path / "overrides.yml")), {"ad": "name", "vefat": "death_h"})
    assert sorted(map(tuple, o.collect()), key=str) == sorted([("b:1", "name", "A Man, of Town"), ("b:1", "death_h", "150"), ("b:2", "death_h", None)], key=str)
    assert sorted(map(tuple, outside_people(read_review(spark, str(tmp_path / "external.yml"))).collect())) == [("x", "Y, Z", 256), ("ابن العمر", "عبد الله", 73), ("ابن عمر", "عبد الله", 73)]
