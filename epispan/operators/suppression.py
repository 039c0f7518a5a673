"""Small-cell protection of published figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import PROTECTED_FIELDS, SEX_NOT_APPLICABLE, SMALL_CELL, SUPPRESSION_REASON
from ..functions.text import col


def is_small(count: Column | str, threshold: int = SMALL_CELL) -> Column:
    """Below the threshold, zero included; unknown counts are not small."""
    return F.coalesce(col(count) < threshold, F.lit(False))


def suppress_observations(df: DataFrame, threshold: int = SMALL_CELL) -> DataFrame:
    """Hide value, count and limits of small cells, keep the denominator and say why."""
    small = is_small("count", threshold)
    hidden = {f: F.when(~F.col("_small"), F.col(f)) for f in PROTECTED_FIELDS if f in df.columns}
    status = F.when(F.col("_small"), F.lit("suppressed")).when(F.col("value").isNotNull(), F.lit("published"))
    return (
        df.withColumn("_small", small)
        .withColumns(hidden)
        .withColumns({
            "suppressed": F.col("_small"),
            "suppressionReason": F.when(F.col("_small"), F.lit(SUPPRESSION_REASON)),
            "suppressionStatus": status.otherwise(F.lit("unavailable")),
        })
        .drop("_small")
    )


def complementary_suppression(
    df: DataFrame, strata: list[str], tie_break: str = "municipality_code_ibge", threshold: int = SMALL_CELL
) -> DataFrame:
    """Where exactly one cell of a stratum is small, hide the smallest other cell as well.

    Otherwise the lone hidden count follows from the total. A stratum holds one
    row per area, so its window stays small however many events there were.
    """
    stratum = Window.partitionBy(*strata)
    ordered = stratum.orderBy(F.col("_small").cast("int"), "count", tie_break)
    status = (
        F.when(F.col("_small"), F.lit("suppressed"))
        .when((F.col("_n_small") == 1) & (F.col("_order") == 1), F.lit("suppressed_complementary"))
        .otherwise(F.lit("published"))
    )
    return (
        df.withColumn("_small", is_small("count", threshold))
        .withColumn("_n_small", F.sum(F.col("_small").cast("int")).over(stratum))
        .withColumn("_order", F.row_number().over(ordered))
        .withColumn("suppression_status", status)
        .drop("_small", "_n_small", "_order")
    )


def mark_not_applicable(df: DataFrame, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Sex-specific outcomes do not apply to the other sex, whatever their count."""
    test = F.lit(False)
    for outcome, sex in pairs or SEX_NOT_APPLICABLE:
        test = test | ((F.col("outcome_id") == outcome) & (F.col("sex") == sex))
    status = F.when(test, F.lit("not_applicable")).otherwise(F.col("suppression_status"))
    return df.withColumn("suppression_status", status)


def protect_profile(df: DataFrame, fields: list[str], denominator: str = "population") -> DataFrame:
    """Null the figures of every cell that is not published; inapplicable cells lose the denominator too."""
    state = F.col("suppression_status")
    public = F.when(state.isin("published", "not_applicable"), state).otherwise(F.lit("suppressed"))
    shown = {f: F.when(state == "published", F.col(f)) for f in fields}
    shown[denominator] = F.when(state != "not_applicable", F.col(denominator))
    return df.withColumns(shown).withColumn("suppression_status", public)


def display_text(count: Column | str, shown: Column | None = None, threshold: int = SMALL_CELL) -> Column:
    """Table text of a figure, ``<5`` for small cells."""
    text = col(count).cast("string") if shown is None else shown
    return F.when(is_small(count, threshold), F.lit(f"<{threshold}")).otherwise(text)


def protected_leaks(df: DataFrame, is_suppressed: Column, fields: list[str], count: str = "count") -> DataFrame:
    """Suppressed rows that still show a protected field, and small counts nobody suppressed."""
    leaked = F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.lit(f)) for f in fields]))
    exposed = F.when(is_suppressed, leaked).otherwise(
        F.when(is_small(count), F.array(F.lit("unsuppressed_small_cell"))).otherwise(F.array().cast("array<string>"))
    )
    return df.withColumn("leaked_fields", exposed).where(F.size("leaked_fields") > 0)
