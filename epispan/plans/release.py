"""Release audit: counters over the public package and the rules that may block it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import COUNTRY_TOTAL, RELEASE_FINDINGS, SMALL_CELL
from ..operators.suppression import is_small


@dataclass(frozen=True)
class Rule:
    """A finding raised when ``test`` holds over the release metrics."""

    id: str
    severity: str
    test: Column


def release_counters(series: DataFrame) -> DataFrame:
    """Observations, suppressed ones and small-cell leaks per source and data status."""
    leak = is_small("count", SMALL_CELL) & ~F.col("suppressed")
    return series.groupBy("source", "dataStatus").agg(
        F.count(F.lit(1)).alias("observations"),
        F.count(F.when(F.col("suppressed"), F.lit(1))).alias("suppressedObservations"),
        F.count(F.when(leak, F.lit(1))).alias("unsuppressedSmallCells"),
    )


def indicator_presence(series: DataFrame, maps: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per indicator: does it have a map, a profile and a country comparator?"""
    base = series.groupBy("indicatorId", "source").agg(
        F.max((F.col("geographyId") == COUNTRY_TOTAL).cast("int")).alias("has_country")
    )
    with_map = maps.select("indicatorId").distinct().withColumn("has_map", F.lit(1))
    with_profile = profiles.select("indicatorId").distinct().withColumn("has_profile", F.lit(1))
    joined = base.join(with_map, "indicatorId", "left").join(with_profile, "indicatorId", "left")
    return joined.fillna(0, subset=["has_map", "has_profile"])


def release_metrics(
    series: DataFrame, presence: DataFrame, profiles: DataFrame, missing_years: DataFrame, sources: DataFrame,
    profile_leaks: DataFrame, download_leaks: DataFrame, contract: DataFrame, gate: dict[str, str], status: str,
    expected_municipalities: int,
) -> DataFrame:
    """One row with every figure the rules test; each input is aggregated once."""
    hospital = F.col("source") == "SIH"
    death = F.col("source") == "SIM"
    totals = release_counters(series).agg(
        F.sum("observations").alias("observations"),
        F.sum("suppressedObservations").alias("suppressed"),
        F.sum("unsuppressedSmallCells").alias("small_cell_leaks"),
        F.coalesce(F.sum(F.when(F.col("dataStatus") == "provisional", F.col("observations"))), F.lit(0)).alias("provisional"),
    )
    indicators = presence.agg(
        F.count(F.lit(1)).alias("indicators"),
        F.count(F.when(F.col("has_map") == 0, F.lit(1))).alias("without_map"),
        F.count(F.when(hospital & (F.col("has_country") == 0), F.lit(1))).alias("hospital_without_country"),
        F.count(F.when(death & (F.col("has_profile") == 0), F.lit(1))).alias("death_without_profile"),
        F.count(F.when(death, F.lit(1))).alias("claiming_profiles"),
    )
    scalars = {
        "profile_municipalities": profiles.agg(F.countDistinct("municipalityCode")),
        "missing_denominator_years": missing_years.agg(F.count(F.lit(1))),
        "open_sources": sources.agg(F.count(F.lit(1))),
        "profile_leaks": profile_leaks.agg(F.count(F.lit(1))),
        "download_leaks": download_leaks.agg(F.count(F.lit(1))),
        "contract_gaps": contract.agg(F.count(F.lit(1))),
    }
    scalars |= {name: indicators.select(name) for name in indicators.columns}
    pending = sum(1 for value in gate.values() if value in ("pending", "blocked"))
    return totals.select("*", *[frame.scalar().alias(name) for name, frame in scalars.items()]).withColumns({
        "pending_gates": F.lit(pending),
        "release_status": F.lit(status),
        "expected_municipalities": F.lit(expected_municipalities),
    })


def release_rules() -> list[Rule]:
    def positive(name: str) -> Column:
        return F.col(name) > 0

    # Every death indicator claims profiles, so none at all is a gap as well.
    uncovered = positive("claiming_profiles") & (F.col("profile_municipalities") != F.col("expected_municipalities"))
    tests = {
        "release-not-public": F.col("release_status") != "public_release_ready",
        "review-gates-pending": positive("pending_gates"),
        "municipal-map-not-publishable": positive("without_map"),
        "sih-brazil-comparator-missing": positive("hospital_without_country"),
        "profiles-incomplete": positive("death_without_profile"),
        "denominator-gaps": positive("missing_denominator_years"),
        "contract-incomplete": positive("contract_gaps"),
        "small-cell-leak": positive("small_cell_leaks"),
        "download-suppression-leak": positive("download_leaks"),
        "profile-suppression-leak": positive("profile_leaks"),
        "profile-municipality-coverage": uncovered,
        "source-catalog-open-items": positive("open_sources"),
        "provisional-observations": positive("provisional"),
    }
    return [Rule(name, severity, tests[name]) for name, severity in RELEASE_FINDINGS.items()]


def release_findings(metrics: DataFrame) -> DataFrame:
    """Rules that fire on the release metrics."""
    fired = F.array_compact(F.array(*[
        F.when(rule.test, F.struct(F.lit(rule.id).alias("finding_id"), F.lit(rule.severity).alias("severity")))
        for rule in release_rules()
    ]))
    return metrics.select(F.explode(fired).alias("_f")).select("_f.*")


def release_gate(findings: DataFrame) -> DataFrame:
    """Publication is allowed exactly when nothing blocks."""
    blockers = F.count(F.when(F.col("severity") == "blocker", F.lit(1)))
    return findings.agg(
        blockers.alias("blocker_count"),
        F.count(F.when(F.col("severity") == "warning", F.lit(1))).alias("warning_count"),
        (blockers == 0).alias("publication_allowed"),
    )
