"""Territory totals, complements, denominators and other aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import (
    ADMISSION_COMPONENTS, ADMISSION_OUTCOME_LABELS, COUNTRY_TOTAL, INTEGRATED_OUTCOME, INTEGRATED_PARTS,
    REST_OF_STATE, SELECTED, SITE_GROUPS, STATE_TOTAL, TABLE_TOTAL, Territory,
)
from ..functions.labels import outcome_label
from ..functions.rates import share_pct
from ..functions.territory import in_state, territory_membership
from ..functions.text import site_code
from .checks import require
from ..session import dimension


def sums(values: list[str]) -> list[Column]:
    return [F.sum(v).alias(v) for v in values]


def with_territory_totals(
    counts: DataFrame, keys: list[str], values: list[str], national: bool = True, geography: str = "geography"
) -> DataFrame:
    """Counts per area plus the state and country totals, in one aggregation.

    Each row unrolls to the areas it belongs to. Pass ``national=False`` when the
    input covers the state only: its sum is not a country total.
    """
    areas = F.explode(territory_membership(geography, national))
    return counts.withColumn(geography, areas).groupBy(*keys, geography).agg(*sums(values))


def complement_totals(df: DataFrame, keys: list[str], value: str, is_selected: Column) -> DataFrame:
    """Total, selected part and the rest per key."""
    picked = F.coalesce(F.sum(F.when(is_selected, F.col(value))), F.lit(0))
    return df.groupBy(*keys).agg(
        F.sum(value).alias("total"), picked.alias("selected"), (F.sum(value) - picked).alias("rest")
    )


def _sorted_texts(name: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(name)), ";")


def state_denominators(municipal: DataFrame, territory: Territory, expected: int) -> DataFrame:
    """Per year: state total, selected city and the rest, with provenance and coverage flags.

    Years where the selected city is absent give no row; years whose number of
    municipalities differs from ``expected`` are marked incomplete.
    """
    picked = F.max(F.when(F.col("municipality_code_ibge") == territory.selected_code7, F.col("population")))
    yearly = municipal.groupBy("year").agg(
        F.sum("population").alias("total"),
        picked.alias("city"),
        F.countDistinct("municipality_code_ibge").alias("municipality_count"),
        _sorted_texts("source_status").alias("source_status"),
        _sorted_texts("source_file").alias("source_files"),
    )
    rows = F.explode(F.array(
        F.struct(F.lit(STATE_TOTAL).alias("geography"), F.col("total").alias("population")),
        F.struct(F.lit(SELECTED).alias("geography"), F.col("city").alias("population")),
        F.struct(F.lit(REST_OF_STATE).alias("geography"), (F.col("total") - F.col("city")).alias("population")),
    ))
    return (
        yearly.where(F.col("city").isNotNull())
        .withColumn("_row", rows)
        .select(
            "year", "_row.geography", "_row.population",
            F.lit(territory.selected_code7).alias("municipality_code_ibge_vr"), F.lit("pessoas").alias("unit"),
            "source_status", "source_files", "municipality_count",
            (F.col("municipality_count") != expected).alias("incomplete"),
        )
    )


def national_denominators(municipal: DataFrame) -> DataFrame:
    return municipal.groupBy("year").agg(
        F.sum("population").alias("population"), F.countDistinct("municipality_code_ibge").alias("municipality_count")
    ).withColumn("geography", F.lit(COUNTRY_TOTAL))


def age_sex_denominators(municipal: DataFrame, territory: Territory) -> DataFrame:
    """State total, selected city and rest per age group and sex."""
    label = F.when(F.col("municipality_code_ibge") == territory.selected_code7, F.lit(SELECTED)).otherwise(F.lit(REST_OF_STATE))
    return with_territory_totals(
        municipal.withColumn("geography", label), ["age_group", "sex"], ["population"], national=False
    )


def conditional_counts(events: DataFrame, keys: list[str], tests: dict[str, Column]) -> DataFrame:
    """One pass, one counter per named condition."""
    return events.groupBy(*keys).agg(
        *[F.count(F.when(test, F.lit(1))).alias(name) for name, test in tests.items()]
    )


def union_totals(counts: DataFrame, keys: list[str], values: list[str], territory: Territory) -> DataFrame:
    """Municipal rows plus state, country and rest-of-state rows."""
    area = F.col("geography")
    state = in_state(area, territory, digits=7)
    areas = F.array_compact(F.array(
        area,
        F.when(state, F.lit(STATE_TOTAL)),
        F.when(state & (area != territory.selected_code7), F.lit(REST_OF_STATE)),
        F.lit(COUNTRY_TOTAL),
    ))
    return counts.withColumn("geography", F.explode(areas)).groupBy(*keys, "geography").agg(*sums(values))


def status_pivot(counts: DataFrame, keys: list[str], statuses: dict[str, str]) -> DataFrame:
    """Wide counts per outcome status; statuses that never occur still give a zero column."""
    return counts.groupBy(*keys).agg(
        F.sum("count").alias("notification_count"),
        *[
            F.coalesce(F.sum(F.when(F.col("outcome_status") == s, F.col("count"))), F.lit(0)).alias(name)
            for name, s in statuses.items()
        ],
    )


def months_per_year(df: DataFrame) -> DataFrame:
    return df.groupBy("year").agg(F.countDistinct("month").alias("month_count"))


def complete_years(df: DataFrame, population: DataFrame) -> DataFrame:
    """Rows of years with all twelve months and a denominator."""
    full = months_per_year(df).where("month_count = 12").select("year")
    covered = full.join(population.select("year").distinct(), "year", "left_semi")
    return df.join(covered, "year", "left_semi")


def component_sums(components: DataFrame, keys: list[str]) -> DataFrame:
    """Table components to outcomes; the integrated outcome needs both chapter totals."""
    spark = components.sparkSession
    targets = dimension(spark, ADMISSION_COMPONENTS, "component_id string, outcome_id string")
    summed = components.join(targets, "component_id").groupBy(*keys, "outcome_id").agg(
        F.sum("value").alias("value"), F.countDistinct("component_id").alias("_parts")
    )
    whole = (F.col("outcome_id") != INTEGRATED_OUTCOME) | (F.col("_parts") == len(INTEGRATED_PARTS))
    return summed.where(whole).drop("_parts").withColumn(
        "outcome_label", outcome_label("outcome_id", ADMISSION_OUTCOME_LABELS)
    )


def profile_share(counts: DataFrame, keys: list[str], cell: list[str]) -> DataFrame:
    """Count, stratum total and percentage share of each cell."""
    cells = counts.groupBy(*keys, *cell).agg(F.sum("count").alias("count"))
    total = F.sum("count").over(Window.partitionBy(*keys))
    return cells.withColumn("total_count", total).withColumn("share_pct", share_pct("count", "total_count"))


def mean_annual_rate(rates: DataFrame, keys: list[str], rate: str) -> DataFrame:
    """Unweighted mean of the yearly rates; years without a rate do not count."""
    return rates.groupBy(*keys).agg(F.round(F.avg(rate), 2).alias("mean_annual_rate"))


def site_group_summary(detail: DataFrame, label: str = "diagnosis_label", cases: str = "cases") -> DataFrame:
    """Cases and shares of the configured site groups; groups do not cover every site.

    The table's own total row is no site: it counts neither as cases nor in the whole.
    """
    groups = dimension(
        detail.sparkSession, [(g, c) for g, codes in SITE_GROUPS for c in codes], "site_group string, code string"
    )
    sites = detail.where(F.coalesce(F.trim(label), F.lit("")) != TABLE_TOTAL)
    per_code = sites.groupBy(site_code(label).alias("code")).agg(F.sum(cases).alias("cases"))
    whole = per_code.agg(F.sum("cases").alias("total"))
    names = dimension(detail.sparkSession, [(g,) for g, _ in SITE_GROUPS], "site_group string")
    grouped = per_code.join(groups, "code").groupBy("site_group").agg(F.sum("cases").alias("cases"))
    filled = names.join(grouped, "site_group", "left").fillna(0, subset=["cases"])
    return filled.withColumn("total", whole.scalar()).select(
        "site_group", "cases", share_pct("cases", "total").alias("share_pct")
    )


def pooled_blocks(df: DataFrame, blocks: list[tuple[str, int, int]], keys: list[str]) -> DataFrame:
    """Events and denominators summed over multi-year blocks."""
    return _in_blocks(df, blocks).groupBy("block", *keys).agg(*sums(["count", "population"]))


def block_means(df: DataFrame, blocks: list[tuple[str, int, int]], keys: list[str], rate: str) -> DataFrame:
    return _in_blocks(df, blocks).groupBy("block", *keys).agg(F.avg(rate).alias("mean_rate"))


def _in_blocks(df: DataFrame, blocks: list[tuple[str, int, int]]) -> DataFrame:
    years = [(name, year) for name, first, last in blocks for year in range(first, last + 1)]
    return df.join(dimension(df.sparkSession, years, "block string, year int"), "year")


def two_source_ratio(df: DataFrame, keys: list[str], numerator: str, denominator: str) -> DataFrame:
    """Events of one source per event of another, same outcome, year and area."""
    wide = df.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.when(F.col("source") == s, F.col("count"))), F.lit(0)).alias(f"count_{s.lower()}")
        for s in (numerator, denominator)
    ])
    ratio = F.try_divide(F.col(f"count_{numerator.lower()}").cast("double"), F.col(f"count_{denominator.lower()}"))
    return wide.withColumn("ratio", ratio)


def premature_share(counts: DataFrame, keys: list[str], young: list[str]) -> DataFrame:
    """Percentage of events with known age in the younger groups."""
    early = F.coalesce(F.sum(F.when(F.col("age_group").isin(young), F.col("count"))), F.lit(0))
    return counts.groupBy(*keys).agg(early.alias("young_count"), F.sum("count").alias("count")).withColumn(
        "premature_pct", share_pct("young_count", "count")
    )


def establishment_production(rows: DataFrame, outcomes: list[str]) -> DataFrame:
    """Production per establishment municipality; any other basis raises."""
    chosen = rows.where(F.col("outcome_id").isin(outcomes))
    chosen = require(chosen, F.col("geography_basis") == "establishment", "production rows must count by establishment")
    return (
        require(chosen, F.col("count") >= 0, "production counts below zero")
        .groupBy("year", F.lpad(F.col("municipality_code_ibge").cast("string"), 7, "0").alias("geography"),
                 "outcome_id", "geography_basis")
        .agg(F.sum("count").alias("count"))
    )


def observed_end_month(df: DataFrame, onset: str, default: str) -> Column:
    """Last observed month as a scalar column, or the default for an empty input."""
    last = df.agg(F.trunc(F.max(F.col(onset).cast("date")), "month").alias("m")).scalar()
    return F.coalesce(last, F.lit(default).cast("date"))
