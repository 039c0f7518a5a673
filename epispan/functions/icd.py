"""Diagnosis-code range predicates."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import Outcome
from ..session import dimension
from .text import col

_BOUND = re.compile(r"\A([A-Z])(\d{2})(\d?)\Z")


def _bounds(expression: str) -> tuple[re.Match, re.Match]:
    low, high = (_BOUND.match(part) for part in expression.split("-", 1))
    if not low or not high or low[1] != high[1]:
        raise ValueError(f"unsupported diagnosis range: {expression}")
    return low, high


def _clean(expression: str) -> str:
    return expression.upper().replace(".", "").replace(" ", "")


def _single(code: Column, expression: str, strict: bool) -> Column:
    if "-" not in expression:
        return code.startswith(expression) if len(expression) == 3 else code == expression
    low, high = _bounds(expression)
    same_letter = F.substring(code, 1, 1) == low[1]
    if strict and low[3] and high[3]:
        digits = F.substring(code, 2, 3).try_cast("int")
        return same_letter & (F.length(code) == 4) & digits.between(int(low[2] + low[3]), int(high[2] + high[3]))
    return same_letter & F.substring(code, 2, 2).try_cast("int").between(int(low[2]), int(high[2]))


def icd_match(code: Column | str, ranges: list[str] | tuple[str, ...], strict: bool = True) -> Column:
    """Whether a normalised code falls in any of ``ranges``.

    Three characters mean a whole category, longer single codes are exact, and
    ``A00-A99`` compares the two category digits. When both bounds carry a
    fourth character the third digit counts too; ``strict=False`` ignores it.
    """
    tests = [_single(col(code), _clean(r), strict) for r in ranges]
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False)) if tests else F.lit(False)


def category_lookup(definitions: list[Outcome], strict: bool = True) -> list[tuple[str, str, bool, bool, list[str]]]:
    """Definitions unrolled to one row per (category, outcome).

    A row says whether the outcome takes every code of the category by number, by
    its first three characters, or only the listed codes. A letter has a hundred
    categories, so the table is bounded by the definitions and never by the data.
    """
    rows: dict[tuple[str, str], tuple[set[str], set[str]]] = {}

    def add(category: str, outcome: str, kind: str, code: str | None = None) -> None:
        kinds, codes = rows.setdefault((category, outcome), (set(), set()))
        kinds.add(kind)
        if code:
            codes.add(code)

    for outcome in definitions:
        for expression in map(_clean, outcome.ranges):
            if "-" not in expression:
                whole = len(expression) == 3
                add(expression[:3], outcome.id, "prefix" if whole else "codes", None if whole else expression)
                continue
            low, high = _bounds(expression)
            if strict and low[3] and high[3]:
                for number in range(int(low[2] + low[3]), int(high[2] + high[3]) + 1):
                    code = f"{low[1]}{number:03d}"
                    add(code[:3], outcome.id, "codes", code)
            else:
                for number in range(int(low[2]), int(high[2]) + 1):
                    add(f"{low[1]}{number:02d}", outcome.id, "number")
    return [(c, o, "number" in kinds, "prefix" in kinds, sorted(codes)) for (c, o), (kinds, codes) in rows.items()]


def with_outcomes(df: DataFrame, code: str, definitions: list[Outcome], strict: bool = True) -> DataFrame:
    """One row per outcome the code counts in; outcomes may overlap, unmatched codes drop out.

    The category of a code is an equality key, so dozens of range tests become one
    hash join with the unrolled definitions.
    """
    lookup = dimension(
        df.sparkSession, category_lookup(definitions, strict),
        "_category string, outcome_id string, _by_number boolean, _by_prefix boolean, _codes array<string>",
    )
    number = F.substring(F.col(code), 2, 2).try_cast("int")
    category = F.concat(F.substring(F.col(code), 1, 1), F.lpad(number.cast("string"), 2, "0"))
    counts_in = (
        F.col("_by_number")
        | (F.col("_by_prefix") & (F.substring(F.col(code), 1, 3) == F.col("_category")))
        | F.array_contains("_codes", F.col(code))
    )
    matched = df.withColumn("_category", category).join(lookup, "_category").where(counts_in)
    return matched.drop("_category", "_by_number", "_by_prefix", "_codes")
