"""Review files as rows, and the gazetteer with what review adds to it."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lexigraph.functions.text import place_key
from lexigraph.sources.configs import parse

# Place types in falling rank, those whose names give nisbas, regions by how near they are to the books.
TYPE_RANK = ("metropoles", "capitals", "towns", "regions", "quarters", "villages", "sites")
NISBA_TYPES = ("metropoles", "capitals", "towns", "regions")
CITY_TYPES = ("metropoles", "capitals", "towns")
REGION_RANK = {"Transoxiana": 0, "Khurasan": 0, "Iraq": 0, "Sham": 0, "Egypt": 0, "Rum": 0, "Jibal": 1, "Jazirat al-Arab": 1, "Aqur": 1, "Hind": 1, "Daylam": 2, "Sijistan": 2, "Faris": 2, "Rihab": 2, "Khuzistan": 2}
ARTICLE, SHORTEST = "ال", 3


def read_review(spark: SparkSession, path: str) -> DataFrame:
    """(file, section, key, value): the entries of review files, a row for each, values as JSON whatever their depth.

    Of a mapping of mappings the outer key is the section; of a mapping of other values the section is null; the items of a
    list have no key. A file is one piece of a task; several are dealt.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dump = lambda x: json.dumps(x, ensure_ascii=False)
        for batch in batches:
            out = []
            for file, text in zip(batch["file"], batch["value"]):
                whole = parse(text)
                for section, inner in whole.items() if isinstance(whole, dict) else [(None, whole)]:
                    if isinstance(inner, dict):
                        out += [(file, section, str(k), dump(v)) for k, v in inner.items()]
                    elif isinstance(inner, list):
                        out += [(file, section, None, dump(v)) for v in inner]
                    else:
                        out.append((file, None, section, dump(inner)))
            yield pd.DataFrame(out, columns=["file", "section", "key", "value"])

    return files.mapInPandas(rows, "file string, section string, key string, value string")


def field_overrides(review: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """(key, field, value) of a file that maps records to fields: what load_records takes. `names` renames fields."""
    field = F.col("key")
    for old, new in (names or {}).items():
        field = F.when(F.col("key") == old, new).otherwise(field)
    return review.where("section IS NOT NULL AND key IS NOT NULL").select(F.col("section").alias("key"), field.alias("field"), _plain(F.col("value")).alias("value"))


def outside_people(review: DataFrame) -> DataFrame:
    """(key, name, death) of a file that maps groups to people: alternatives a|b are rows, a value is [death, name]."""
    v = F.from_json("value", "array<string>")
    return review.where("section IS NOT NULL").select(F.explode(F.split("key", r"\|")).alias("k"), v.alias("v")).select(F.trim("k").alias("key"), F.col("v")[1].alias("name"), F.col("v")[0].cast("int").alias("death"))


def _plain(json_value: Column) -> Column:
    return F.from_json(F.concat(F.lit('{"v":'), json_value, F.lit("}")), "v string")["v"]


def nisba_of(name: Column) -> Column:
    """The regular nisba of a folded place name of one word; null of several words or too short a stem."""
    base = F.when(name.startswith(ARTICLE), name.substr(F.lit(len(ARTICLE) + 1), F.length(name))).otherwise(name)
    stem = F.regexp_replace(F.when(F.length(base) > 5, F.regexp_replace(base, "يه$", "")).otherwise(base), "[هاي]$", "")
    return F.when(~base.contains(" ") & (F.length(base) >= 3) & (F.length(stem) >= 2), F.concat(F.lit(ARTICLE), stem, F.lit("ي")))


class Gazetteer:
    """names (name, place, rank), places (place, label, lat, lon, type, region), nisbas (nisba, place), prefixed (name, place) as DataFrames.

    rows: (uri, ar, ar_other, lat, lon, type, region); review: read_review() of the additions, with sections alias, new,
    label, nisba, ignore, prefixed_only, nisba_ignore. Of places with one name the first by type, region and id has
    rank 1; new places come before all, an alias is the only place of its name. Names to be ignored, and those of fewer than three letters behind the article,
    mean nothing alone; of them those that count behind a prefix are in `prefixed`. Nisbas are derived from the first place of a name, unless review gives or forbids them.
    """

    def __init__(self, rows: DataFrame, review: DataFrame):
        items = lambda s: review.where(F.col("section") == s)
        listed = lambda s: items(s).select(place_key(_plain(F.col("value"))).alias("name")).distinct()
        types, regions = F.array(*map(F.lit, TYPE_RANK)), F.create_map(*[F.lit(x) for kv in REGION_RANK.items() for x in kv])
        known = rows.where(F.col("type").isin(*TYPE_RANK)).select(
            F.col("uri").alias("place"), F.col("ar").alias("label"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), "type", "region",
            F.concat(F.array("ar"), F.filter(F.split(F.coalesce("ar_other", F.lit("")), ","), lambda x: F.trim(x) != "")).alias("names"), F.lit(False).alias("new"),
        )
        v = F.from_json("value", "array<string>")
        new = items("new").select(F.col("key").alias("place"), v.alias("v")).select("place", F.from_json(F.col("v")[0], "array<string>").alias("names"), "v")
        new = new.select("place", F.col("names")[0].alias("label"), F.col("v")[1].cast("double").alias("lat"), F.col("v")[2].cast("double").alias("lon"), F.col("v")[3].alias("type"), F.col("v")[4].alias("region"), "names", F.lit(True).alias("new"))
        every = known.unionByName(new)
        label = items("label").select(F.col("key").alias("place"), _plain(F.col("value")).alias("shown"))
        self.places = every.join(label, "place", "left").select("place", F.coalesce("shown", "label").alias("label"), "lat", "lon", "type", "region")
        rank = F.struct((~F.col("new")).alias("old"), F.array_position(types, F.col("type")).alias("type"), F.coalesce(regions[F.col("region")], F.lit(3)).alias("region"), "place")
        named = every.select("place", "type", "new", rank.alias("order"), F.explode(F.array_distinct(F.transform("names", place_key))).alias("name")).where("name <> ''")
        ignored, prefixed = listed("ignore"), listed("prefixed_only")
        self.prefixed = named.where(F.col("type").isin(*CITY_TYPES) & ~F.col("new")).join(prefixed, "name", "left_semi").groupBy("name").agg(F.min_by("place", "order").alias("place"))
        long = F.length(F.regexp_replace("name", f"^(.*?){ARTICLE}", "$1")) >= SHORTEST
        free = named.where(F.col("new") | long).join(ignored.withColumn("off", F.lit(True)), "name", "left").where(F.col("new") | F.col("off").isNull())
        alias = items("alias").select(place_key(F.col("key")).alias("name"), _plain(F.col("value")).alias("place")).join(self.places.select("place", "type"), "place").groupBy("name").agg(F.max(F.struct("place", "type")).alias("x")).select("name", "x.place", "x.type")
        ranked = free.join(alias.select("name"), "name", "left_anti").withColumn("rank", F.row_number().over(Window.partitionBy("name").orderBy("order")))
        ranked = ranked.select("name", "place", "type", "rank").union(alias.select("name", "place", "type", F.lit(1)))
        self.names = ranked.select("name", "place", "rank")
        derived = ranked.where((F.col("rank") == 1) & F.col("type").isin(*NISBA_TYPES)).select(nisba_of(F.col("name")).alias("nisba"), "name", "place").where("nisba IS NOT NULL")
        given = items("nisba").select(place_key(F.col("key")).alias("nisba"), _plain(F.col("value")).alias("place")).join(self.places.select("place"), "place", "left_semi").groupBy("nisba").agg(F.max("place").alias("place"))
        none = listed("nisba_ignore").select(F.col("name").alias("nisba"))
        derived = derived.groupBy("nisba").agg(F.min_by("place", "name").alias("place")).join(given.select("nisba"), "nisba", "left_anti")
        self.nisbas = derived.union(given.select("nisba", "place")).join(none, "nisba", "left_anti")
