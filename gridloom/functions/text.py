"""Column functions on text: noise, numbers, dates, white space, safe cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that alone make a word noise, the months of textual dates, the form of a number.
NOISE_CHARACTERS = "'\"`‘’“”|¦!¡=+_~—–-.,:;\\/()[]{}<>*#"
MONTHS = {
    "января": 1, "февраля": 2, "марта": 3, "апреля": 4, "мая": 5, "июня": 6,
    "июля": 7, "августа": 8, "сентября": 9, "октября": 10, "ноября": 11, "декабря": 12,
}
NUMBER = r"\p{Nd}+(?:[,.]\p{Nd}+)?"
#: White space as Python strips it, for Java's regular expressions.
SPACE = r"[\s\x1C-\x1F\x85\p{Z}]"


def strip(c: Column) -> Column:
    """Without white space, of Unicode too, at both ends."""
    return F.regexp_replace(c, rf"\A{SPACE}+|{SPACE}+\z", "")


def collapse(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, rf"{SPACE}+", " "))


def is_noise(c: Column) -> Column:
    """Only white space and punctuation, one character at least."""
    signs = "".join("\\" + x for x in NOISE_CHARACTERS)
    return c.rlike(rf"\A[{signs}\s\x1C-\x1F\x85\p{{Z}}]+\z")


def median_or(value: Column, default: float) -> Column:
    """Exact median of a group (the mean of the middle two), or a default for no values."""
    return F.coalesce(F.median(value), F.lit(float(default)))


def numbers(c: Column) -> Column:
    """All numbers of a text, as written: digits with one optional fraction after a comma or a dot."""
    return F.regexp_extract_all(c, F.lit(rf"({NUMBER})"), 1)


def number_candidates(c: Column) -> Column:
    """array<struct<raw, value, offset>>: numbers with a decimal dot and their places in code points.

    A number's place are the lengths of all that stands before it: of the parts between numbers and of the numbers.  A null text has none.
    """
    text = F.coalesce(c, F.lit(""))
    pairs = F.arrays_zip(numbers(text).alias("raw"), F.split(text, NUMBER, -1).alias("gap"))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<raw: string, value: string, offset: int>>)").alias("found"))

    def step(state: Column, pair: Column) -> Column:
        raw, at = pair["raw"], state["at"] + F.char_length(pair["gap"])
        one = F.struct(raw.alias("raw"), F.replace(raw, F.lit(","), F.lit(".")).alias("value"), at.alias("offset"))
        return F.struct((at + F.char_length(raw)).alias("at"), F.concat(state["found"], F.array(one)).alias("found"))

    # the last part has no number behind it
    return F.aggregate(F.filter(pairs, lambda p: p["raw"].isNotNull()), start, step, lambda state: state["found"])


def ru_date(c: Column) -> Column:
    """The first "5 марта 2021" in a text as 05.03.2021; empty without one or for an unknown month.  The day isn't checked."""
    form = rf"(?iu)(\p{{Nd}}{{1,2}}){SPACE}+([а-яё]+){SPACE}+(\p{{Nd}}{{4}})"
    month = F.lit(None).cast("int")
    name = F.lower(F.regexp_extract(c, form, 2))
    for word, number in MONTHS.items():
        month = F.when(name == word, number).otherwise(month)
    day = F.regexp_extract(c, form, 1)
    return F.coalesce(F.concat(F.lpad(day, 2, "0"), F.lit("."), F.lpad(month.cast("string"), 2, "0"), F.lit("."), F.regexp_extract(c, form, 3)), F.lit(""))


def safe_cell(c: Column, most: int = 32_700) -> Column:
    """Without control characters that spreadsheets refuse, cut to what a cell holds."""
    return F.substring(F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", ""), 1, most)


def folder_uid(path: Column) -> Column:
    """Eight hexadecimal digits that tell folders of one name apart."""
    return F.substring(F.sha1(path.cast("binary")), 1, 8)
