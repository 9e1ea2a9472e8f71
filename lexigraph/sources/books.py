"""Books as a Python data source: zipped pages dealt by ranges of their spine, options from the book's own configuration."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lexigraph.sources.configs import parse
from lexigraph.sources.readers import book_entries

EVENTS = "book_id string, spine int, href string, pos int, tag string, text string"
#: Pages of a book that are one partition.
PAGES = 200
#: Keys of a configuration that are options of book_entries.
OPTIONS = ("number", "start_after_heading", "stop_at_heading", "unnumbered_entry", "section_heading", "entry_sections", "entry_paragraph", "series", "preamble_entry", "co_entries", "star_paragraphs", "source_note")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def read_bytes(path: str) -> bytes:
    system, at = _open(path)
    with system.open_input_stream(at) as f:
        return f.read()


def configs(root: str) -> dict[str, dict]:
    """Every *.yml below root by its path, nested as it is."""
    system, at = _open(root)
    found = system.get_file_info(fs.FileSelector(at, recursive=True)) if system.get_file_info(at).type == fs.FileType.Directory else [system.get_file_info(at)]
    return {f.path: parse(read_bytes(f.path).decode("utf-8")) for f in sorted(found, key=lambda f: f.path) if f.path.endswith((".yml", ".yaml"))}


def spine_of(book: zipfile.ZipFile) -> list[str]:
    """The names of a zipped book's pages in reading order; those that are missing are left out."""
    opf = next((n for n in book.namelist() if n.endswith(".opf")), None)
    if opf is None:
        return []
    text = book.read(opf).decode("utf-8", "replace")
    tags = (dict(re.findall(r'([\w:-]+)="([^"]*)"', tag)) for tag in re.findall(r"<item\b[^>]*>", text))
    hrefs = {a.get("id"): a.get("href") for a in tags}
    base = opf.rpartition("/")[0]
    names = (f"{base}/{hrefs[i]}" if base else hrefs[i] for i in re.findall(r'<itemref\b[^>]*idref="([^"]*)"', text) if i in hrefs)
    return [n for n in names if n in book.NameToInfo]


class Pages(InputPartition):
    def __init__(self, book_id: str, path: str, first: int, last: int):
        self.book_id, self.path, self.first, self.last = book_id, path, first, last


class BookReader(DataSourceReader):
    """One partition for PAGES pages of a book. Paths may be any that Arrow's file systems know."""

    def __init__(self, options: dict[str, str]):
        self.root, self.base, self.pages = options["path"], options.get("base", ""), int(options.get("pages", PAGES))

    def partitions(self) -> list[Pages]:
        out = []
        for config in configs(self.root).values():
            if config.get("parser") == "turath_epub":
                source = f"{self.base.rstrip('/')}/{config['source']}" if self.base else config["source"]
                with zipfile.ZipFile(io.BytesIO(read_bytes(source))) as z:
                    n = len(spine_of(z))
                out += [Pages(config["book_id"], source, i, min(n, i + self.pages)) for i in range(0, n, self.pages)]
        return out

    def read(self, partition: Pages) -> Iterator[tuple]:
        with zipfile.ZipFile(io.BytesIO(read_bytes(partition.path))) as z:
            for spine, name in list(enumerate(spine_of(z)))[partition.first : partition.last]:
                page = z.read(name).decode("utf-8", "replace")
                for pos, m in enumerate(re.finditer(r"(?is)<(h[1-6]|p)\b[^>]*>(.*?)</\1>", page)):
                    yield partition.book_id, spine, name, pos, m[1].lower(), re.sub("<[^>]+>", "", m[2]).strip()


class BookSource(DataSource):
    """spark.read.format("book").option("base", folder of the sources).load(folder or file of configurations): headings and paragraphs of all zipped books."""

    @classmethod
    def name(cls) -> str:
        return "book"

    def schema(self) -> str:
        return EVENTS

    def reader(self, schema) -> BookReader:
        return BookReader(self.options)


def options_of(config: dict) -> dict:
    """A configuration's options of book_entries; of a preamble the title."""
    out = {k: config[k] for k in OPTIONS if config.get(k) is not None}
    if isinstance(out.get("preamble_entry"), dict):
        out["preamble_entry"] = out["preamble_entry"].get("title")
    return out


def read_books(spark: SparkSession, root: str, base: str = "") -> DataFrame:
    """(book_id, entry, number, heading, section, series, body, together, vol, page): the entries of all zipped books, each by its own configuration.

    vol and page are those of a preamble's configuration, for the entry that it opens. Books are few and each is a plan of its own over the one source.
    """
    spark.dataSource.register(BookSource)
    events = spark.read.format("book").option("base", base).load(root)
    events = events.withColumn("pos", F.struct("spine", "pos"))
    out = None
    for config in configs(root).values():
        if config.get("parser") != "turath_epub":
            continue
        own = book_entries(events.where(F.col("book_id") == config["book_id"]), ["book_id"], **options_of(config))
        opening = config.get("preamble_entry") if isinstance(config.get("preamble_entry"), dict) else {}
        first = F.col("heading") == F.lit(opening.get("title"))
        own = own.withColumn("vol", F.when(first, F.lit(opening.get("vol")))).withColumn("page", F.when(first, F.lit(opening.get("page"))))
        own = own.withColumn("vol", F.col("vol").cast("int")).withColumn("page", F.col("page").cast("int"))
        out = own if out is None else out.unionByName(own)
    return out
