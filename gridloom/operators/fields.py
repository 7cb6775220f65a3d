"""Labelled fields of registry texts: one projection, a status and a reason for every text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.text import SPACE, collapse, ru_date, strip

# Labels and reasons of the registry's texts.
REASONS = {
    "empty": "PDF без извлекаемого текста (вероятно скан)",
    "kind": "вид объекта недвижимости не «Помещение» и не «Машино-место»",
    "block": "не найден блок «Назначение / Наименование»",
    "purpose": "назначение не «Жилое» и не «Нежилое»: «",
    "missing": "не найдены ключевые поля: ",
}
UNITS = "кв|помещение|помещ|м/м|машиноместо"
PARKING = ("машино-место", "машиноместо")
PURPOSES = ("жилое", "нежилое")


def first(text: Column, pattern: str, group: int = 1, flags: str = "iud") -> Column:
    """A group of the first match, case ignored unless flags say otherwise; empty without one.  \\s and \\S know ASCII and NBSP."""
    return F.regexp_extract(text, f"(?{flags})" + pattern.replace(r"\d", r"\p{Nd}").replace(r"\D", r"\P{Nd}").replace(r"\s", SPACE).replace(r"\S", r"[^\s\x1C-\x1F\x85\p{Z}]"), group)


def unit_pattern(strict: bool = False) -> str:
    edge = r"(?<![\p{L}\p{N}])" if strict else ""
    return rf",?\s*{edge}(?:{UNITS})\.?\s*([0-9A-Za-zА-Яа-яЁё/_-]+)\s*\z"


def _once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed once, however often what follows reads them: as an array of one struct, taken apart."""
    return df.withColumn("_once", F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))).select("*", "_once.*").drop("_once")


def extract_fields(texts: DataFrame, text: str = "full_text", strict_units: bool = False) -> DataFrame:
    """``texts`` with the fields, status (success or skipped) and reason (empty for success).

    Fields that aren't found are empty.  Reasons are tried in a fixed order and the first that holds stands.
    A null text is an empty one.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    # The patterns of the fields.
    both = r"Назначение:\s*(\S[^\n]*)\nНаименование:\s*(\S[^\n]*)"
    right = r"регистрации\s+\d\.\d\s*(\S[^\n]*)\nправа:\s*(\S+)\n(\d{2}\.\d{2}\.\d{4})"
    alone = lambda label: first(t, rf"{label}:[ \t]*([^\n]*)")
    found = {
        "_kind": first(t, r"\n(\S[^\n]*)\nвид объекта недвижимости"),
        "_both1": first(t, both, 1), "_both2": first(t, both, 2), "_alone1": alone("Назначение"), "_alone2": alone("Наименование"),
        "cadastral_no": first(t, r"Кадастровый номер:\s*(\S+)"),
        "_day": first(t, r"\n(\d{1,2}\s+[а-яё]+\s+\d{4}\s*г?\.)"),
        "_place": first(t, r"Адрес:\s*(.*?)\nПлощадь", flags="iuds"),
        "area": first(t, r"Площадь.*?:\s*([\d.,]+)"),
        "floor": first(t, r"[Ээ]таж №\s*([-\d]+)", flags="ud"),
        "house_cadastral_no": first(t, r"Кадастровые номера иных объектов недвижимости\D+(\d\d:\d\d:\d\d\d\d\d\d\d:\d+)"),
        **{n: first(t, right, i) for i, n in ((1, "right_type"), (2, "registration_no"), (3, "ownership_date"))},
        "_blank": strip(t) == "",
    }
    df = _once(texts, found)
    df = _once(df, {"_type": strip(F.col("_kind")), "_both": F.col("_both1") != "", "extract_date": ru_date(F.col("_day")), "_address": collapse(F.col("_place"))})
    df = df.withColumns(
        {
            "_parking": F.lower("_type").isin(*PARKING),
            "purpose": strip(F.when(F.col("_both"), F.col("_both1")).otherwise(F.col("_alone1"))),
            "name": strip(F.when(F.col("_both"), F.col("_both2")).otherwise(F.col("_alone2"))),
        }
    )
    df = _once(df, {"_unit": first(F.col("_address"), unit_pattern(strict_units), 0), "object_no": first(F.col("_address"), unit_pattern(strict_units))})
    unit = F.col("_unit")
    cut = F.regexp_replace(F.substring(F.col("_address"), F.lit(1), F.char_length("_address") - F.char_length(unit)), r"\A[ ,]+|[ ,]+\z", "")
    df = df.withColumn("address", F.when(unit == "", F.col("_address")).otherwise(cut)).withColumn("kind", F.col("_type")).withColumn("right_type", strip(F.col("right_type")))
    missing = F.array_join(F.filter(F.array(F.when(F.col("cadastral_no") == "", F.lit("кадастровый номер")), F.when(F.col("address") == "", F.lit("адрес"))), lambda x: x.isNotNull()), ", ")
    reason = (
        F.when(F.col("_blank"), REASONS["empty"])
        .when(~F.lower("_type").contains("помещение") & ~F.col("_parking"), REASONS["kind"])
        .when(~F.col("_both") & ~F.col("_parking"), REASONS["block"])
        .when(~F.col("_parking") & ~F.lower("purpose").isin(*PURPOSES), F.concat(F.lit(REASONS["purpose"]), "purpose", F.lit("»")))
        .when(missing != "", F.concat(F.lit(REASONS["missing"]), missing))
        .otherwise("")
    )
    return df.withColumn("reason", reason).withColumn("status", F.when(F.col("reason") == "", "success").otherwise("skipped")).drop("_kind", "_both1", "_both2", "_alone1", "_alone2", "_day", "_place", "_blank", "_type", "_both", "_parking", "_address", "_unit")
