"""Cleaning of codes, labels and figures found in administrative extracts."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ"
UNACCENTED = "aaaaaaeeeeiiiiooooouuuucnyyAAAAAAEEEEIIIIOOOOOUUUUCNY"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def normalize_code(code: Column | str) -> Column:
    """Null to empty, upper case, no dots, no outer blanks."""
    return F.trim(F.replace(F.upper(F.coalesce(col(code).cast("string"), F.lit(""))), F.lit("."), F.lit("")))


def clean_text(value: Column | str) -> Column:
    """Trimmed text without the ``.0`` that numeric readers leave behind."""
    text = F.trim(F.coalesce(col(value).cast("string"), F.lit("")))
    return F.when(text.endswith(".0"), F.substring(text, F.lit(1), F.length(text) - 2)).otherwise(text)


def optional_text(available: list[str], name: str) -> Column:
    """``clean_text`` of a field the file may lack; an absent field reads as empty text."""
    return clean_text(F.col(f"`{name}`")) if name in available else F.lit("")


def without_accents(text: Column | str) -> Column:
    """Fold accented Latin letters, precomposed or written with combining marks."""
    return F.regexp_replace(F.translate(col(text), ACCENTED, UNACCENTED), r"\p{M}", "")


def canonical_label(label: Column | str) -> Column:
    """Accent-free lower-case label, level dots dropped and blanks collapsed."""
    folded = F.replace(F.lower(without_accents(label)), F.lit(".."), F.lit(""))
    return F.trim(F.regexp_replace(folded, r"\s+", " "))


def locale_integer(figure: Column | str) -> Column:
    """``1.234`` to 1234; a lone dash is a counted zero."""
    text = col(figure)
    return F.when(text == "-", F.lit(0).cast("long")).otherwise(F.regexp_replace(text, "[.,]", "").try_cast("long"))


@F.pandas_udf(StringType())
def _unescape(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def html_unescape(text: Column | str) -> Column:
    """Entities such as ``&ccedil;`` to characters."""
    return _unescape(col(text))


def latin1_page(content: Column | str) -> Column:
    """Bytes of a Latin-1 page to text with entities resolved."""
    return html_unescape(F.decode(col(content), "ISO-8859-1"))


def pad_code7(code: Column | str) -> Column:
    text = col(code).cast("string")
    return F.when(F.length(text) >= 7, text).otherwise(F.lpad(text, 7, "0"))


def code7_to_code6(code: Column | str) -> Column:
    return F.substring(col(code), 1, 6)


def strip_leading_zeros(code: Column | str) -> Column:
    """Comparison form of a numeric code; all zeros stay ``0`` and null stays empty."""
    text = F.trim(col(code).cast("string"))
    bare = F.regexp_replace(text, r"\A0+", "")
    return F.when(text.isNull(), F.lit("")).when(bare == "", F.lit("0")).otherwise(bare)


def site_code(label: Column | str) -> Column:
    """Leading ``Cnn`` of a registry label, null when there is none."""
    found = F.regexp_extract(col(label), r"\A(C\d{2})", 1)
    return F.when(found != "", found)


def year_in_name(name: Column | str) -> Column:
    """The isolated ``20nn`` in a file name."""
    found = F.regexp_extract(col(name), r"(?<!\d)(20\d{2})(?!\d)", 1)
    return F.when(found != "", found.cast("int"))


def finite_or_null(value: Column | str) -> Column:
    number = col(value)
    return F.when(~F.isnan(number), number)


def clean_place_name(name: Column | str) -> Column:
    return F.regexp_replace(col(name), r" - RJ| \(RJ\)", "")


def csv_safe_cell(value: Column | str) -> Column:
    """Text cell that a spreadsheet cannot take for a formula, quoted where needed."""
    text = F.coalesce(col(value).cast("string"), F.lit(""))
    text = F.when(text.rlike(r"\A[=+\-@]"), F.concat(F.lit("'"), text)).otherwise(text)
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike(r'[",\r\n]'), quoted).otherwise(text)


def round_coordinates(rings: Column | str, depth: int, places: int = 5) -> Column:
    """Round every number of an array nested ``depth`` levels deep."""
    if depth == 0:
        return F.round(col(rings).cast("double"), places)
    return F.transform(col(rings), lambda inner: round_coordinates(inner, depth - 1, places))
