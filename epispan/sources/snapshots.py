"""Choosing among yearly snapshots by the status their manifest records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import RECONCILED, VALIDATED_DEATHS
from ..operators.series import keep_last


def validated_rows(rows: DataFrame, manifest: DataFrame, is_valid: Column) -> DataFrame:
    """Rows of snapshots whose manifest entry is valid."""
    accepted = manifest.where(is_valid).select("source", "year").distinct()
    return rows.join(accepted, ["source", "year"], "left_semi")


def valid_status() -> Column:
    """Death snapshots must be validated; admission snapshots must be reconciled."""
    return F.when(F.col("source") == "SIM", F.col("status").startswith(VALIDATED_DEATHS)).otherwise(
        F.col("status") == RECONCILED
    )


def latest_snapshot(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the latest year of each outcome."""
    latest = rows.groupBy(*keys).agg(F.max("year").alias("year"))
    return rows.join(latest, [*keys, "year"], "left_semi")


def latest_names(population: DataFrame) -> DataFrame:
    """Municipality names as of their last year."""
    named = population.select("municipality_code_ibge", "municipality_name", "year")
    return keep_last(named, ["municipality_code_ibge"], ["year", "municipality_name"])
