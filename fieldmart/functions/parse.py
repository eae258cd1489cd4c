"""Columns parsed from survey text: numbers, ids, phones, times, code labels, placeholders."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldmart import codes

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def let(value: Column, body) -> Column:
    """body(value) with value computed once: an expression that is named twice would be computed twice wherever a filter goes."""
    return F.get(F.transform(F.array(value), body), 0)


def number(text: Column) -> Column:
    """The double that the whole text spells, else null; 'nan' and '7d' are no numbers."""
    text = F.trim(text)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def plain(text: Column) -> Column:
    """Trimmed text; a whole number without its fraction, leading zeros or exponent."""
    whole = let(number(text), lambda v: F.when(v == F.floor(v), v.try_cast("bigint").cast("string")))
    return F.coalesce(whole, F.trim(text))


def known_id(text: Column, skipped: int = codes.SKIPPED) -> Column:
    """plain(text), null where there is no id: blank, skipped or 'nan'."""
    return let(plain(text), lambda v: F.when((v != "") & (v != str(skipped)) & (F.lower(v) != "nan"), v))


def phone(text: Column) -> Column:
    """Digits only, without the country code of a 12-digit or the 0 of a 10-digit number; null if none."""
    digits = F.regexp_replace(plain(text), "[^0-9]", "")
    return let(F.regexp_replace(digits, "^(254|256|0)(?=[0-9]{9}$)", ""), lambda v: F.when(v != "", v))


def stamp(text: Column, pattern: str = codes.DATE_FORMAT) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern))


def birth_date(text: Column, as_of: datetime.date) -> Column:
    """A date; one after as_of that is plausible (10 to 110 years) a century earlier is taken as that."""
    today = F.lit(as_of)
    repaired = lambda d: F.when((d > today) & F.add_months(d, -1200).between(F.add_months(today, -1320), F.add_months(today, -120)), F.add_months(d, -1200)).otherwise(d)
    return let(F.to_date(stamp(text)), repaired)


def facility_label(value: Column, country: str) -> Column:
    """'11 (Name)', with Unknown for other codes; null stays null and text that is no number stays as it is."""
    return F.coalesce(number_label(number(value), country), value)


def number_label(value: Column, country: str) -> Column:
    """The same of a number."""
    number_ = value.cast("int")
    names = F.create_map(*[F.lit(x) for pair in codes.FACILITIES[country].items() for x in pair])
    return F.concat(number_.cast("string"), F.lit(" ("), F.coalesce(F.try_element_at(names, number_), F.lit("Unknown")), F.lit(")"))


def canonical(value: Column, names: dict[str, str]) -> Column:
    """The canonical name by lower-cased value, else the value itself."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(value)), value)


def filled(message: Column, date: Column) -> Column:
    """message with every [...] replaced by the date as DD/MM/YYYY; unchanged without a date."""
    return F.when(date.isNull(), message).otherwise(F.regexp_replace(message, F.lit(r"\[.*?\]"), F.date_format(date, "dd/MM/yyyy")))
