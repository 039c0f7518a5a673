"""Published result tables: registry CSV, HTML pages and admission windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import ADMISSION_LABEL_EXCLUDED, ADMISSION_LABELS, DEMENTIA_LABELS
from ..functions.text import canonical_label, col, latin1_page, locale_integer
from ..session import dimension
from .microdata import number_rows

_LINE = r'(?m)^\s*("[^"]+";\s*[0-9.,-]+)'
_FIELDS = r'\A"([^"]+)";\s*([0-9.,-]+)\z'


def scan_registry_csv(spark: SparkSession, path: str) -> DataFrame:
    """Two-column semicolon table to (label, cases); anything but an integer raises."""
    raw = spark.read.csv(path, sep=";", encoding="ISO-8859-1", header=True, inferSchema=False)
    if len(raw.columns) != 2:
        raise ValueError(f"unexpected registry layout: {raw.columns}")
    label, cases = raw.columns
    return raw.select(F.col(f"`{label}`").alias("label"), F.col(f"`{cases}`").cast("long").alias("cases"))


def registry_years(rows: DataFrame) -> DataFrame:
    """Only the year rows of a registry series; totals and notes drop out."""
    is_year = F.col("label").rlike(r"\A\d{4}\z")
    return rows.where(is_year).select(F.col("label").cast("int").alias("year"), "cases")


def page_rows(pages: DataFrame, content: str = "content", keep: list[str] | None = None) -> DataFrame:
    """``"label";figure`` lines inside the ``<PRE>`` block of each page, entities resolved."""
    keep = keep or []
    body = F.regexp_extract(latin1_page(content), r"(?is)<PRE>(.*?)</PRE>", 1)
    return table_lines(pages.select(*keep, body.alias("_body")), "_body", keep)


def table_lines(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    lines = F.explode(F.regexp_extract_all(F.col(text), F.lit(_LINE), F.lit(1)))
    cells = df.select(*keep, lines.alias("_line"))
    return cells.select(
        *keep,
        F.trim(F.regexp_extract("_line", _FIELDS, 1)).alias("label"),
        locale_integer(F.regexp_extract("_line", _FIELDS, 2)).alias("value"),
    )


def label_component(label: Column | str) -> Column:
    """Outcome component a table label stands for: first matching rule, null when none applies."""
    text = canonical_label(label)
    found = F.lit(None).cast("string")
    for wanted, kind, target in reversed(ADMISSION_LABELS):
        test = text == wanted if kind == "equal" else text.startswith(wanted)
        found = F.when(test, F.lit(target)).otherwise(found)
    for excluded in ADMISSION_LABEL_EXCLUDED:
        found = F.when(~F.contains(text, F.lit(excluded)), found)
    return found


def admission_components(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Label rows to component totals; labels outside the rules and table totals drop out."""
    labelled = rows.withColumn("component_id", label_component("label")).where(F.col("component_id").isNotNull())
    return labelled.groupBy(*keep, "component_id").agg(F.sum("value").alias("value"))


def municipal_rows(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Rows labelled ``nnnnnn NAME`` to (six-digit code, value)."""
    code = F.regexp_extract("label", r"\A(\d{6})\s+\S", 1)
    return rows.select(*keep, code.alias("municipality_code_datasus"), "value").where(
        F.col("municipality_code_datasus") != ""
    )


def dementia_counts(rows: DataFrame, keep: list[str]) -> DataFrame:
    """National monthly table to the two dementia outcomes; Alzheimer's counts in both."""
    targets = dimension(rows.sparkSession, DEMENTIA_LABELS, "_label string, outcome_id string")
    plain = F.lower(F.trim(F.regexp_replace(col("label"), r"\A\.+\s*", "")))
    return rows.withColumn("_label", plain).join(targets, "_label").groupBy(*keep, "outcome_id").agg(
        F.sum("value").alias("count")
    )


def scan_admission_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All admission windows with file name and row number, which order overlapping windows and repeats."""
    fields = (
        "year int, month int, period string, geography string, municipality_code_datasus string, outcome_id string, "
        "outcome_label string, value long, unit string, source_paths string, source_sha256s string"
    )
    return number_rows(spark.read.schema(fields).csv(path, header=True))
