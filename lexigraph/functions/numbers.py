"""Numbers, calendars and geometry as Column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lexigraph.functions.text import digits_eastern, digits_western

# Chronological days of 1 January 1 (Julian), of the Gregorian reform and of 1 January 1970, and the diameter of the earth in km.
JULIAN_YEAR_1, GREGORIAN_FROM, UNIX_EPOCH = 1721424, 2299161, 2440588
EARTH_KM = 12742.0
#: Spelled numbers in English, the language pack of the queries; another language is another map.
ONES = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9}
TENS = {"ten": 10, "twenty": 20, "thirty": 30, "forty": 40, "fifty": 50, "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90}
#: The same for Arabic, in the folded spelling.
ONES_AR = {"واحد": 1, "احدي": 1, "احد": 1, "اثنتين": 2, "اثنين": 2, "ثلاث": 3, "ثلاثه": 3, "اربع": 4, "اربعه": 4, "خمس": 5, "خمسه": 5, "ست": 6, "سته": 6, "سبع": 7, "سبعه": 7, "ثمان": 8, "ثماني": 8, "ثمانيه": 8, "تسع": 9, "تسعه": 9}
TENS_AR = {"عشر": 10, "عشره": 10, "عشرين": 20, "ثلاثين": 30, "اربعين": 40, "خمسين": 50, "ستين": 60, "سبعين": 70, "ثمانين": 80, "تسعين": 90}


def _div(a: Column, b: float) -> Column:
    return F.floor(a / b).cast("long")


def hijri_to_julian_day(h: Column) -> Column:
    """The chronological day on which a year of the tabular calendar begins."""
    return (F.lit(1948440) + 354 * (h - 1) + _div(3 + 11 * h, 30) + 15).cast("long")


def hijri_to_gregorian(h: Column) -> Column:
    """The year AD in which a year AH begins: Julian, four years of 365 days and a leap day, up to 1582, Gregorian from then on."""
    day = hijri_to_julian_day(h)
    julian = _div(4 * (day - JULIAN_YEAR_1) + 3, 1461) + 1
    return F.when(day < GREGORIAN_FROM, julian).otherwise(F.year(F.date_from_unix_date((day - UNIX_EPOCH).cast("int")))).cast("long")


def common_era(h: Column) -> Column:
    """The approximate year AD of the middle of a year AH."""
    return F.floor(622.54 + (h - 1) * 0.970224 + 0.485).cast("long")


def hijri_era(ce: Column) -> Column:
    """The approximate inverse of common_era."""
    return F.floor((ce - 622.54) / 0.970224 + 1).cast("long")


def century(year: Column) -> Column:
    return (F.floor((year - 1) / 100) + 1).cast("long")


def quarter_century(year: Column) -> Column:
    return (F.floor((year - 1) / 25) * 25 + 1).cast("long")


def death_note(h: Column) -> Column:
    return F.concat(digits_eastern(h.cast("string")), F.lit("هـ/"), digits_eastern(hijri_to_gregorian(h).cast("string")), F.lit("م"))


def roman(n: Column) -> Column:
    """Roman numerals from 1 to 3999: digit by digit from tables of ten."""
    ones = ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"]

    def place(digit: Column, one: str, five: str, ten: str) -> Column:
        table = [x.replace("X", ten).replace("V", five).replace("I", one) if x != "IX" else one + ten for x in ones]
        return F.element_at(F.array(*map(F.lit, table)), (digit + 1).cast("int"))

    thousands = F.repeat(F.lit("M"), (n / 1000).cast("int"))
    return F.concat(thousands, place(F.floor(n / 100) % 10, "C", "D", "M"), place(F.floor(n / 10) % 10, "X", "L", "C"), place(n % 10, "I", "V", "X"))


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    return F.asin(F.sqrt(h)) * EARTH_KM


def project(lon: Column, lat: Column, width: float = 1000.0, west: float = -20.0, north: float = 60.0, scale: float = 10.0) -> tuple[Column, Column]:
    """Equirectangular plane coordinates."""
    return (lon - west) * scale * width / 1000.0, (north - lat) * scale * width / 1000.0


def inside_box(lon: Column, lat: Column, box: tuple[float, float, float, float], pad: float = 3.0) -> Column:
    west, south, east, north = box
    return lon.between(west - pad, east + pad) & lat.between(south - pad, north + pad)


def year_from_note(note: Column) -> Column:
    """The first number of two to four digits, of either script."""
    return F.nullif(F.regexp_extract(digits_western(note), r"(\d{2,4})", 1), F.lit("")).try_cast("bigint")


def volume_and_page(ref: Column) -> tuple[Column, Column]:
    return tuple(F.nullif(F.regexp_extract(ref, p, 1), F.lit("")).try_cast("bigint") for p in (r"[Vv]ol\.\s*(\d+)", r"p\.\s*(\d+)"))


def pick_number(numbers: Column, last: Column, most: int = 6) -> Column:
    """The entry number among candidates that goes on from `last`: the smallest step from 1 to `most`; else a value one digit off last + 1 to last + 3, corrected; else null."""
    steps = F.array_sort(F.filter(numbers, lambda x: (x > last) & (x <= last + most)))
    wanted = F.transform(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda k: (last + k).cast("bigint"))
    fixed = F.filter(wanted, lambda w: F.exists(numbers, lambda x: (F.length(x.cast("string")) == F.length(w.cast("string"))) & (F.levenshtein(x.cast("string"), w.cast("string")) == 1)))
    return F.coalesce(F.get(steps, F.lit(0)).cast("bigint"), F.get(fixed, F.lit(0)).cast("bigint"))


def spelled_number(words: Column, ones: dict[str, int] = ONES, tens: dict[str, int] = TENS, hundred: tuple[str, ...] = ("hundred",), thousand: tuple[str, ...] = ("thousand",), fillers: tuple[str, ...] = ("and",)) -> Column:
    """Value of leading number words, in either order of tens and ones: a fold over the array that stops at the first word of another kind.

    Hundreds and thousands multiply the ones that stand right before them. Null without any number word.
    """

    def table(words_: dict[str, int]) -> Column:
        return F.create_map(*[F.lit(x) for pair in words_.items() for x in pair])

    one_of, ten_of = table(ones), table(tens)

    def state(total, held, used, over):
        return F.struct(total.cast("bigint").alias("total"), held.cast("bigint").alias("ones"), used.alias("used"), over.alias("over"))

    def step(a, w):
        one, ten = F.try_element_at(one_of, w), F.try_element_at(ten_of, w)
        yes, no, none = F.lit(True), F.lit(False), F.lit(0)
        times = F.greatest(a["ones"], F.lit(1))
        return (
            F.when(a["over"] | ((w.isin(*fillers) if fillers else F.lit(False)) & a["used"]), a)
            .when(one.isNotNull(), state(a["total"], one, yes, no))
            .when(ten.isNotNull(), state(a["total"] + ten + a["ones"], none, yes, no))
            .when(w.isin(*hundred), state(a["total"] + times * 100, none, yes, no))
            .when(w.isin(*thousand), state(a["total"] + times * 1000, none, yes, no))
            .otherwise(state(a["total"], a["ones"], a["used"], yes))
        )

    return F.aggregate(words, state(F.lit(0), F.lit(0), F.lit(False), F.lit(False)), step, lambda a: F.when(a["used"], a["total"] + a["ones"]))
