"""Readers for the source formats: zipped books, page images' text, indexes, tables, maps. Files are dealt over tasks by Spark."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lexigraph.functions.text import digits_western, place_info_key

READERS: dict[str, Callable[..., DataFrame]] = {}


def reader(name: str):
    """Registers a reader; books name theirs in their configuration."""

    def put(f):
        READERS[name] = f
        return f

    return put


def read_book(spark: SparkSession, config: dict, path: str) -> DataFrame:
    """Entries of a book by the reader that its configuration names, with its options."""
    options = {k: v for k, v in config.items() if k not in ("book_id", "title", "author", "author_death_h", "parser", "source")}
    return READERS[config["parser"]](spark, path, **options).withColumn("book_id", F.lit(config["book_id"]))


@reader("ocr_pages")
def ocr_pages(spark: SparkSession, path: str, first: int | None = None, last: int | None = None, drop: str = r"^\s*$") -> DataFrame:
    """(page, pos, type, content): blocks of page files named by their numbers; blocks that a page repeats count once."""
    schema = "blocks array<struct<type:string,content:string,topLeftY:double>>, dimensions struct<height:double>"
    d = spark.read.schema(schema).json(path, multiLine=True, recursiveFileLookup=True)
    d = d.withColumn("page", F.regexp_extract(F.col("_metadata.file_path"), r"(\d+)[^/]*$", 1).cast("int"))
    if first is not None:
        d = d.where(F.col("page") >= first)
    if last is not None:
        d = d.where(F.col("page") <= last)
    blocks = d.select("page", F.posexplode("blocks").alias("pos", "b")).select("page", "pos", "b.type", "b.content").where(~F.col("content").rlike(drop))
    once = F.row_number().over(Window.partitionBy("page", "content").orderBy("pos"))
    return blocks.withColumn("n", once).where("n = 1").drop("n")


@reader("epub")
def epub(spark: SparkSession, path: str) -> DataFrame:
    """(file, spine, href, xhtml): the pages of zipped books in the order of their spine."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.epub").load(path).select("path", "content")

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                rows = []
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    opf = next((n for n in z.namelist() if n.endswith(".opf")), None)
                    if opf is None:
                        continue
                    text = z.read(opf).decode("utf-8", "replace")
                    items = {}
                    for tag in re.findall(r"<item\b[^>]*>", text):
                        a = dict(re.findall(r'([\w:-]+)="([^"]*)"', tag))
                        items[a.get("id")] = a.get("href")
                    base = opf.rpartition("/")[0]
                    for i, ref in enumerate(re.findall(r'<itemref\b[^>]*idref="([^"]*)"', text)):
                        href = items.get(ref)
                        full = f"{base}/{href}" if base and href else href
                        if full in z.NameToInfo:
                            rows.append((name, i, href, z.read(full).decode("utf-8", "replace")))
                yield pd.DataFrame(rows, columns=["file", "spine", "href", "xhtml"])

    return files.mapInPandas(pages, "file string, spine int, href string, xhtml string")


def html_events(pages: DataFrame, key: list[str], html: str) -> DataFrame:
    """(key, pos, tag, text): headings and paragraphs of pages in order."""
    parts = F.regexp_extract_all(F.col(html), F.lit(r"(?is)(<(?:h[1-6]|p)\b[^>]*>.*?</(?:h[1-6]|p)>)"), F.lit(1))
    d = pages.select(*key, F.posexplode(parts).alias("pos", "x"))
    return d.select(*key, "pos", F.lower(F.regexp_extract("x", r"^<(h[1-6]|p)", 1)).alias("tag"), F.trim(F.regexp_replace("x", "<[^>]+>", "")).alias("text"))


def segment_entries(events: DataFrame, key: list[str], heads: tuple[str, ...] = ("h2", "h3"), section_heads: tuple[str, ...] = ("h1",), stop: str | None = None) -> DataFrame:
    """(key, section, entry, heading, body): events cut at headings; section headings are carried forward, an entry ends at the next heading; rows behind a heading that `stop` matches are left out."""
    w = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    e = events.withColumn("entry", F.sum(F.col("tag").isin(*heads).cast("long")).over(w))
    e = e.withColumn("section", F.last(F.when(F.col("tag").isin(*section_heads), F.col("text")), ignorenulls=True).over(w))
    if stop:
        e = e.withColumn("over", F.max(F.coalesce(F.col("tag").isin(*heads) & F.col("text").rlike(stop), F.lit(False))).over(w)).where("not over").drop("over")
    g = e.where("entry > 0").groupBy(*key, "entry").agg(F.array_sort(F.collect_list(F.struct("pos", "tag", "text", "section"))).alias("x"))
    body = F.transform(F.filter("x", lambda y: ~y["tag"].isin(*heads, *section_heads)), lambda y: y["text"])
    return g.select(*key, F.col("x")[0]["section"].alias("section"), "entry", F.col("x")[0]["text"].alias("heading"), F.array_join(body, "\n").alias("body"))


def book_entries(
    events: DataFrame, key: list[str], number: str = r"^\s*(\d+)\s*[-–.]\s*(.*)$", start_after_heading: str | None = None, stop_at_heading: str | None = None,
    unnumbered_entry: str | None = None, section_heading: str | None = None, entry_sections: str | None = None, entry_paragraph: str | None = None,
    series: dict[str, str] | None = None, preamble_entry: str | None = None, co_entries: bool = False, star_paragraphs: bool = False, source_note: str = r"^\*\s*see",
) -> DataFrame:
    """(key, entry, number, heading, section, series, body, together) from events (key, pos, tag, text): a book's entries by running states, each a window.

    Headings h1 to h6 that `number` takes are entries. start_after_heading and stop_at_heading bound the part that
    is read. unnumbered_entry: headings that are entries all the same; while one is open, other headings without
    a number are text of it, and else they open a section. section_heading always opens one. In a section whose
    heading entry_sections takes every heading is an entry, and so is a paragraph that entry_paragraph takes.
    series: heading pattern -> name carried on. preamble_entry: heading of what stands before the first heading.
    co_entries: entries without text between them share the text that follows; `together` counts them.
    Paragraphs with a star are left out, with star_paragraphs only those that source_note takes.

    Rows of a book are one window, as a running state asks for. Null texts are empty; books without entries
    give no rows.
    """
    order = Window.partitionBy(*key).orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    text = F.coalesce("text", F.lit(""))
    e = events.select(*key, "pos", F.col("tag").rlike("^h[1-6]$").alias("head"), text.alias("text"))

    def takes(pattern: str | None):
        return F.col("text").rlike(pattern) if pattern else F.lit(False)

    def seen(flag):
        return F.coalesce(F.max(flag).over(so_far), F.lit(False))

    if start_after_heading:
        e = e.withColumn("here", F.col("head") & takes(start_after_heading)).withColumn("on", seen(F.col("here"))).where("on and not here")
    if stop_at_heading:
        e = e.withColumn("off", seen(F.col("head") & takes(stop_at_heading))).where("not off")
    e = e.where(F.col("head") | ~F.col("text").startswith("*") | (F.lit(star_paragraphs) & ~takes(source_note)))
    e = e.withColumn("number", F.when(F.col("head"), F.nullif(F.regexp_extract("text", number, 1), F.lit(""))).cast("long"))
    opens = F.col("head") & F.col("number").isNull() & (takes(section_heading) | takes(entry_sections))
    e = e.withColumn("opens", opens).withColumn("listing", F.coalesce(F.last(F.when(F.col("opens"), takes(entry_sections)), ignorenulls=True).over(so_far), F.lit(False)))
    named = F.col("head") & ~F.col("opens") & F.col("number").isNull() & (takes(unnumbered_entry) | F.col("listing"))
    e = e.withColumn("named", named | (~F.col("head") & F.col("listing") & takes(entry_paragraph)))
    # what a plain heading is depends on the last thing that is sure
    sure = F.when(F.col("number").isNotNull(), "numbered").when(F.col("opens"), "section").when(F.col("named"), "named")
    e = e.withColumn("open", F.last(sure, ignorenulls=True).over(so_far))
    plain = F.col("head") & F.col("number").isNull() & ~F.col("opens") & ~F.col("named")
    e = e.withColumn("opens", F.col("opens") | (plain & ~F.col("open").eqNullSafe("named")))
    e = e.withColumn("first", F.row_number().over(order) == 1)
    first = F.col("first")
    e = e.withColumn("starts", F.col("number").isNotNull() | F.col("named") | (first & F.lit(preamble_entry is not None)))
    e = e.withColumn("entry", F.sum(F.col("starts").cast("long")).over(so_far))
    e = e.withColumn("section", F.last(F.when(F.col("opens"), F.col("text")), ignorenulls=True).over(so_far))
    which = F.lit(None).cast("string")
    for pattern, name in (series or {}).items():
        which = F.when(F.col("head") & F.col("text").rlike(pattern), name).otherwise(which)
    e = e.withColumn("series", F.last(which, ignorenulls=True).over(so_far))
    begins_with_text = first & ~F.col("head") & F.lit(preamble_entry is not None)
    heading = F.when(begins_with_text, F.lit(preamble_entry)).when(F.col("number").isNotNull(), F.regexp_extract("text", number, 2)).otherwise(F.col("text"))
    is_text = ~F.col("opens") & (~F.col("starts") | begins_with_text | (F.col("named") & ~F.col("head"))) & (F.col("text") != "")
    first_of = F.min_by(F.struct("number", heading.alias("heading"), "section", "series"), "pos").alias("x")
    lines = F.array_sort(F.collect_list(F.when(is_text, F.struct("pos", "text"))))
    g = e.where("entry > 0").groupBy(*key, "entry").agg(first_of, F.array_join(F.transform(lines, lambda y: y["text"]), "\n\n").alias("body"))
    g = g.select(*key, "entry", "x.number", "x.heading", "x.section", "x.series", "body")
    if not co_entries:
        return g.withColumn("together", F.lit(1).cast("long"))
    after = Window.partitionBy(*key).orderBy("entry").rowsBetween(0, Window.unboundedFollowing)
    g = g.withColumn("last", F.min(F.when(F.col("body") != "", F.col("entry"))).over(after))
    group = Window.partitionBy(*key, "last")
    return g.withColumn("together", F.count("*").over(group)).withColumn("body", F.max("body").over(group)).drop("last")


@reader("docx_index")
def docx_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, line): the paragraphs of word-processor files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(path).select("path", "content")

    def lines(batches):
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    xml = z.read("word/document.xml").decode("utf-8", "replace")
                found = ["".join(re.findall(r"<w:t[^>]*>([^<]*)</w:t>", p)) for p in re.findall(r"(?s)<w:p\b.*?</w:p>", xml)]
                yield pd.DataFrame({"file": name, "pos": range(len(found)), "line": found})

    return files.mapInPandas(lines, "file string, pos int, line string")


def index_rows(lines: DataFrame, line: str = "line") -> DataFrame:
    """(number, name, death, page): index lines `number | name | death | page` or `number - name`; the first of a number wins."""
    parts = F.split(F.col(line), r"\s*\|\s*")
    piped = F.size(parts) >= 4
    number = F.when(piped, parts[0]).otherwise(F.regexp_extract(line, r"^(\d+)\s*[-.]", 1)).try_cast("bigint")
    name = F.when(piped, parts[1]).otherwise(F.regexp_extract(line, r"^\d+\s*[-.]\s*(.*)$", 1))
    d = lines.select("*", number.alias("number"), name.alias("name"), F.when(piped, F.get(parts, F.lit(2))).try_cast("bigint").alias("death"), F.when(piped, F.get(parts, F.lit(3))).try_cast("bigint").alias("page"))
    n = F.row_number().over(Window.partitionBy("number").orderBy("pos"))
    return d.where("number is not null").withColumn("n", n).where("n = 1").select("number", "name", "death", "page")


def column_index(blocks: DataFrame, page: str = "page", not_a_name: str | None = None) -> DataFrame:
    """(page, number, name) of index pages that were read column by column: lines that are numbers, then lines that are names, paired by position.

    blocks (page, pos, content). Only pages with as many names as numbers, at least two, can be paired; lines
    that not_a_name takes (a column that may have empty cells) are neither.
    """
    lines = F.filter(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "content"))), lambda b: F.split(b["content"], "\n"))), lambda x: F.trim(x) != "")
    d = blocks.groupBy(page).agg(F.transform(lines, lambda x: digits_western(F.trim(x))).alias("lines"))
    names = F.filter("lines", lambda x: ~x.rlike(r"^\d+(\s|$)") & (~x.rlike(f"^(?:{not_a_name})$") if not_a_name else F.lit(True)))
    d = d.select(page, F.filter("lines", lambda x: x.rlike(r"^\d+$")).alias("numbers"), names.alias("names")).where((F.size("numbers") > 1) & (F.size("numbers") == F.size("names")))
    return d.select(page, F.explode(F.arrays_zip("numbers", "names")).alias("z")).select(page, F.col("z.numbers").cast("long").alias("number"), F.col("z.names").alias("name"))


def first_of_number(*parts: DataFrame) -> DataFrame:
    """(number, name, ...): of several readings of an index the first that has a number."""
    ranked = [p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)]
    all_ = ranked[0]
    for p in ranked[1:]:
        all_ = all_.unionByName(p, allowMissingColumns=True)
    order = [c for c in ("page", "name") if c in all_.columns]
    return all_.withColumn("_n", F.row_number().over(Window.partitionBy("number").orderBy("_part", *order))).where("_n = 1").drop("_n", "_part")


INDEX = "number long, name string, death string, vol int, page int"


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """A stored index."""
    return spark.read.schema(INDEX).json(path)


def renumbered(names: DataFrame, index: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries, report): entries (page, number, name) of a book take the numbers that an assignment pairs (a: number read, b: number of the index) gives them.

    The report has a row for each number that was mended or that the index lacks.
    """
    d = names.join(pairs.select(F.col("a").alias("number"), F.col("b").alias("to")), "number", "left")
    d = d.withColumn("old", F.col("number")).withColumn("number", F.coalesce("to", "number")).drop("to")
    known = index.select("number", F.lit(True).alias("known"))
    report = d.join(known, "number", "left").where("number <> old or known is null")
    return d.drop("old"), report.select("page", "name", "old", "number", F.when(F.col("known").isNull(), "not in the index").otherwise("mended").alias("note"))


def load_people(persons: DataFrame, records: DataFrame, heading_books: tuple[str, ...] = ()) -> DataFrame:
    """(id, names, headings, death, sure, n_sources): persons (id, death_h, death_est, sources array<struct<key>>) beside the names of their records (key, book_id, name, heading, names).

    Headings are the records' names, and their full headings in heading_books. The order of sources is kept;
    a source without a record adds nothing.
    """
    s = persons.select("id", "death_h", "death_est", F.size("sources").alias("n_sources"), F.posexplode_outer("sources").alias("pos", "s"))
    r = records.select("key", "names", "name", F.when(F.col("book_id").isin(*heading_books), F.col("heading")).alias("heading"))
    j = s.join(r, F.col("s.key") == r["key"], "left")
    g = j.groupBy("id", "death_h", "death_est", "n_sources").agg(F.array_sort(F.collect_list(F.struct("pos", "names", "name", "heading"))).alias("x"))
    filled = lambda c: F.filter(c, lambda y: y.isNotNull())
    names = F.flatten(filled(F.transform("x", lambda y: y["names"])))
    heads = F.concat(filled(F.transform("x", lambda y: y["name"])), filled(F.transform("x", lambda y: y["heading"])))
    return g.select("id", names.alias("names"), heads.alias("headings"), F.coalesce("death_h", "death_est").alias("death"), F.col("death_h").isNotNull().alias("sure"), "n_sources")


def load_records(entries: DataFrame, overrides: DataFrame, not_persons: str | None = None) -> DataFrame:
    """Entries (key, section, name, death_h, ...) of persons with what overrides (key, field, value) set: the value of a field, null by a dash."""
    d = entries.where(~F.coalesce(F.col("section").rlike(not_persons), F.lit(False))) if not_persons else entries
    fields = [f for f in d.columns if f not in ("key", "section")]
    o = overrides.groupBy("key").pivot("field", fields).agg(F.max("value"))
    d = d.join(o.select(F.col("key").alias("_key"), *[F.col(f).alias(f"_{f}") for f in fields]), F.col("key") == F.col("_key"), "left")
    return d.select("key", "section", *[F.when(F.col(f"_{f}") == "-", None).otherwise(F.coalesce(F.col(f"_{f}").cast(d.schema[f].dataType), F.col(f))).alias(f) for f in fields])


def read_lexicons(spark: SparkSession, root: str, names: tuple[str, ...] = ("ism", "nisba", "laqab", "kunya", "override")) -> DataFrame:
    """(kind, term, value, first): the lexicons <root>/<kind>.tsv of a transliteration and the first word of each term."""
    parts = [read_lexicon(spark, f"{root}/{n}.tsv").withColumn("kind", F.lit(n)) for n in names]
    all_ = parts[0]
    for p in parts[1:]:
        all_ = all_.union(p)
    return all_.select("kind", "term", "value", F.split("term", " ")[0].alias("first"))


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """(term, value): tab-separated terms, comments after #, the last of a term wins, `-` suppresses it."""
    lines = spark.read.text(path).withColumn("at", F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id()))
    d = lines.where(~F.col("value").startswith("#") & F.col("value").contains("\t")).select("at", F.split("value", "\t").alias("p"))
    d = d.groupBy(F.trim(F.col("p")[0]).alias("term")).agg(F.max_by(F.trim(F.col("p")[1]), "at").alias("value"))
    return d.select("term", F.nullif("value", F.lit("-")).alias("value"))


def read_yaml_map(spark: SparkSession, path: str, key: str = "key", value: str = "value") -> DataFrame:
    """(key, value): a flat mapping of a review file, as JSON text of its values; alternatives `a|b` become rows of their own."""
    lines = spark.read.text(path).where(F.col("value").rlike(r"^\S[^:#]*:\s*\S"))
    d = lines.select(F.regexp_extract("value", r"^([^:]+):", 1).alias("k"), F.trim(F.regexp_extract("value", r"^[^:]+:\s*(.*)$", 1)).alias("v"))
    return d.select(F.explode(F.split(F.regexp_replace("k", "[\"']", ""), r"\|")).alias(key), F.regexp_replace("v", "^[\"']|[\"']$", "").alias(value))


def read_yaml_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, no, fields map<string, string>): a review file that lists flat mappings, `- a: x` and further fields indented below.

    Quotes and comments are off; a field without a value that lists `- x` lines below it is their values joined by `|`.
    """
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\n")).alias("pos", "line"))
    lines = lines.where(~F.col("line").rlike(r"^\s*(#.*)?$"))
    order = Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    pair = r"^(?:- )?\s*([^:\s][^:]*):(?:\s+(.*?))?\s*(?:\s#.*)?$"
    d = lines.withColumn("no", F.sum(F.col("line").startswith("- ").cast("long")).over(order))
    d = d.withColumn("field", F.last(F.when(F.col("line").rlike(pair), F.trim(F.regexp_extract("line", pair, 1))), ignorenulls=True).over(order))
    value = F.when(F.col("line").rlike(pair), F.regexp_extract("line", pair, 2)).otherwise(F.regexp_extract("line", r"^\s*-\s*(.*?)\s*$", 1))
    d = d.withColumn("value", F.regexp_replace(value, "^[\"']|[\"']$", ""))
    g = d.where("no > 0").groupBy("file", "no", "field").agg(F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]), lambda v: v != ""), "|").alias("value"))
    return g.groupBy("file", "no").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("fields"))


def read_entries(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Entries of all books with their keys."""
    return spark.read.schema(schema).json(path, multiLine=True).withColumn("key", F.concat_ws(":", "book_id", "seq"))


def read_gazetteer(spark: SparkSession, path: str, type_rank: list[str]) -> DataFrame:
    """(name, place): the best place of each name by the order of place types, then by id; names `a, b` of a row are rows."""
    d = spark.read.option("sep", "\t").option("header", "true").csv(path)
    names = d.select("id", "type", F.explode(F.split("names", r"\s*,\s*")).alias("name"))
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, type_rank)), F.col("type")), F.lit(0)), F.lit(len(type_rank) + 1))
    n = F.row_number().over(Window.partitionBy("name").orderBy(rank, "id"))
    return names.withColumn("n", n).where("n = 1").select("name", F.col("id").alias("place"))


def read_geojson_lines(spark: SparkSession, path: str) -> DataFrame:
    """(start, end, points): line features of route files, without self loops and empty lines."""
    schema = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:array<array<double>>>>>"
    f = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f"))
    d = f.select(F.col("f.properties")["sToponym"].alias("start"), F.col("f.properties")["eToponym"].alias("end"), F.col("f.geometry.coordinates").alias("points"))
    return d.where("start is not null and end is not null and start <> end and size(points) > 1")


def read_geojson_areas(spark: SparkSession, path: str, digits: int = 2) -> DataFrame:
    """(layer, feature, ring, points): the outer and inner rings of the polygons of map layers, rounded; neighbours that become one point count once."""
    schema = "features array<struct<geometry:struct<type:string,coordinates:string>>>"
    f = spark.read.schema(schema).json(path, multiLine=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.[^./]+$", 1).alias("layer"), F.posexplode("features").alias("feature", "f"))
    rings, many = "array<array<array<double>>>", "array<array<array<array<double>>>>"
    c = F.col("f.geometry.coordinates")
    polygons = F.when(F.col("f.geometry.type") == "MultiPolygon", F.flatten(F.from_json(c, many))).when(F.col("f.geometry.type") == "Polygon", F.from_json(c, rings))
    d = f.select("layer", "feature", F.posexplode(polygons).alias("ring", "points"))
    near = F.transform("points", lambda p: F.transform(p, lambda x: F.round(x, digits)))
    once = F.filter(near, lambda p, i: (i == 0) | (p != F.get(near, i - 1)))
    return d.select("layer", "feature", "ring", once.alias("points")).where(F.size("points") > 2)


def read_place_texts(spark: SparkSession, path: str, title_ends: str = " والنسبة") -> DataFrame:
    """(key, title, text): place texts of GeoJSON files by the key of their title, which ends where title_ends begins."""
    schema = "features array<struct<properties:struct<title:string,text:string>>>"
    p = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features.properties").alias("p")).select("p.title", "p.text")
    return p.where("title <> '' and text <> ''").select(place_info_key(F.element_at(F.split("title", title_ends), 1)).alias("key"), "title", "text")


def decisions(spark: SparkSession, path: str) -> DataFrame:
    """(a, b, decision): pairs of decision files with rows {a, b, decision, at}; the last answer of a pair holds."""
    d = spark.read.schema("a string, b string, decision string, at long").json(path)
    d = d.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "decision", "at")
    return d.groupBy("a", "b").agg(F.max_by("decision", "at").alias("decision"))
