"""Rates and series products, from harmonised events to published figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import (
    ADMISSION_OUTCOME_LABELS, ADMISSION_UNIT, AGE_GROUPS, COUNTRY_TOTAL, DEATH_UNIT, NOT_RECONCILED, NOTIFICATION_OUTCOMES, NOTIFICATION_UNIT,
    OUTSIDE_STATE, RECONCILED, REST_OF_COUNTRY, REST_OF_STATE, SELECTED, SEXES, SMALL_CELL, STATE_TOTAL, Outcome, Territory, outcome_definitions,
)
from ..functions.dates import in_observation_window, month_from_text, month_start, months_between, year_month
from ..functions.demographics import (
    age_bucket, death_age_years, notification_age_years, outcome_status_label, sex_label,
)
from ..functions.icd import icd_match
from ..functions.labels import outcome_label
from ..functions.periods import death_period_status, product_period_status
from ..functions.rates import crude_rate, monthly_rate, rate_ratio, share_pct
from ..functions.territory import (
    classify_geography, classify_state_geography, eligible_code, in_state,
)
from ..functions.text import clean_text, code7_to_code6, normalize_code
from ..operators.checks import at_key, require
from ..operators.classify import classified_counts, notification_counts
from ..operators.joins import (
    dense_counts, dense_grid, fill_grid, full_outer_series, join_denominator, known_members, manifest_lookup, municipality_with_fallback,
    unique_rows, wide_comparators,
)
from ..operators.quality import reconcile
from ..operators.rates import add_comparison, add_rates
from ..operators.rollup import complete_years, conditional_counts, status_pivot, union_totals, with_territory_totals
from ..operators.series import interruption_variables, keep_last, month_spine, union_all
from ..operators.suppression import complementary_suppression, mark_not_applicable

AREAS = [COUNTRY_TOTAL, STATE_TOTAL, SELECTED, REST_OF_STATE]
STATE_AREAS = [STATE_TOTAL, SELECTED, REST_OF_STATE]
ADMISSION_KEYS = ["year", "month", "geography", "outcome_id"]


def death_dimensions(deaths: DataFrame, territory: Territory) -> DataFrame:
    """Eligible deaths with decoded dimensions, reduced to the columns counting needs.

    Cleaning, decoding and labelling are separate projections, so each raw field
    is parsed once per row although the labels test it many times.
    """
    cleaned = deaths.where(eligible_code("municipality_code_datasus", "SIM", territory)).select(
        "source_year",
        normalize_code("municipality_code_datasus").alias("code"),
        normalize_code("sex_raw").alias("sex_code"),
        F.col("age_raw").try_cast("double").alias("age_code"),
        normalize_code("underlying_cause").alias("cause"),
    )
    decoded = cleaned.withColumn("years", death_age_years("age_code"))
    return decoded.select(
        "source_year",
        classify_geography("code", territory).alias("geography"),
        sex_label("sex_code", "SIM").alias("sex"),
        age_bucket("years").alias("age_group"),
        "cause",
    )


def notification_dimensions(events: DataFrame, territory: Territory) -> DataFrame:
    cleaned = events.where(eligible_code("municipality_code_datasus", "SIVEP-SRAG", territory)).select(
        "source_year",
        normalize_code("municipality_code_datasus").alias("code"),
        sex_label("sex_raw", "SIVEP-SRAG").alias("sex"),
        F.col("age_raw").try_cast("double").alias("age_value"),
        normalize_code("age_unit_raw").alias("unit"),
        outcome_status_label("outcome_raw").alias("outcome_status"),
        "final_classification_raw",
    )
    decoded = cleaned.withColumn("years", notification_age_years("age_value", "unit"))
    return decoded.select(
        "source_year",
        classify_geography("code", territory).alias("geography"),
        "sex", age_bucket("years").alias("age_group"), "outcome_status", "final_classification_raw",
    )


def with_provenance(counts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Counts with the source file and digest of their year, from (source_year, source_path, source_sha256).

    A year without an entry, or with two, raises.
    """
    return manifest_lookup(counts, manifest.select("source_year", "source_path", "source_sha256"), "source_year")


def death_outcome_counts(
    deaths: DataFrame, territory: Territory, definitions: list[Outcome] | None = None, strict: bool = True,
    manifest: DataFrame | None = None,
) -> DataFrame:
    """Deaths per outcome, year, age and sex for each area and the totals that contain it.

    With a manifest every row also names the file its year came from and that file's digest.
    """
    keys = ["source_year", "sex", "age_group"]
    counted = classified_counts(
        death_dimensions(deaths, territory), "cause", definitions or outcome_definitions("SIM"),
        [*keys, "geography"], strict,
    )
    rolled = with_territory_totals(counted, [*keys, "outcome_id", "outcome_label"], ["count"])
    named = rolled.withColumns({"source": F.lit("SIM"), "outcome_status": F.lit("óbito"), "unit": F.lit(DEATH_UNIT)})
    return with_provenance(named, manifest) if manifest is not None else named


def notification_outcome_counts(events: DataFrame, territory: Territory, manifest: DataFrame | None = None) -> DataFrame:
    """Notifications per outcome, year, age, sex and evolution. State input gives no country total."""
    keys = ["source_year", "sex", "age_group", "outcome_status"]
    counted = notification_counts(
        notification_dimensions(events, territory), "final_classification_raw", [*keys, "geography"]
    )
    rolled = with_territory_totals(counted, [*keys, "outcome_id", "outcome_label"], ["count"], national=False)
    named = rolled.withColumns({"source": F.lit("SIVEP-SRAG"), "unit": F.lit(NOTIFICATION_UNIT)})
    return with_provenance(named, manifest) if manifest is not None else named


def deduplicated_admissions(windows: DataFrame) -> DataFrame:
    """One row per month, area and outcome: the last row of the last file wins."""
    order = ["source_file", "source_row_number"]
    return keep_last(windows.select(*ADMISSION_KEYS, "outcome_label", "value", *order), ADMISSION_KEYS, order)


def annual_admission_rates(windows: DataFrame, population: DataFrame) -> DataFrame:
    """Annual admission rates of complete years with a denominator, against the rest of the state."""
    monthly = deduplicated_admissions(windows)
    counts = complete_years(monthly, population).groupBy("year", "geography", "outcome_id", "outcome_label").agg(
        F.sum("value").alias("count")
    )
    people = population.select("year", "geography", F.col("population").alias("denominator"), "source_status")
    joined = join_denominator(counts, people, ["year", "geography"], "denominator", strict=True)
    rated = add_rates(joined, population="denominator").withColumn(
        "period_status", product_period_status("annual_admissions", "year")
    )
    return add_comparison(rated, ["year", "outcome_id"], STATE_AREAS, "denominator")


def mortality_rates(counts: DataFrame, population: DataFrame, areas: list[str] | None = None) -> DataFrame:
    """Annual death rates on the full (year, outcome, area) grid, years without population left out."""
    areas = areas or AREAS
    dated = counts.withColumn("year", F.col("source_year").cast("int"))
    grid = dense_counts(dated, ["year", "outcome_id", "outcome_label"], "geography", areas)
    covered = grid.join(population.select("year").distinct(), "year", "left_semi")
    people = population.select("year", "geography", "population", F.col("source_status").alias("population_source_status"))
    rated = add_rates(join_denominator(covered, people, ["year", "geography"], strict=True))
    labelled = rated.withColumn("period_status", death_period_status("year", "outcome_id"))
    return add_comparison(labelled, ["year", "outcome_id"], areas)


def age_sex_rates(counts: DataFrame, denominators: DataFrame, year: int) -> DataFrame:
    """Rates per area, age group and sex of one census year."""
    cell = ["geography", "age_group", "sex"]
    known = F.col("age_group").isin(AGE_GROUPS) & F.col("sex").isin(SEXES) & F.col("geography").isin(STATE_AREAS)
    chosen = counts.where((F.col("source_year") == year) & known)
    totals = chosen.groupBy("outcome_id", "outcome_label", *cell).agg(F.sum("count").alias("count"))
    outcomes = totals.select("outcome_id", "outcome_label").distinct()
    cells = dense_grid(outcomes, geography=STATE_AREAS, age_group=AGE_GROUPS, sex=SEXES)
    grid = cells.join(unique_rows(denominators.where(known).select(*cell, "population"), cell, "denominator"), cell)
    filled = fill_grid(grid, totals, ["outcome_id", "outcome_label", *cell], ["count"])
    rated = add_rates(filled).withColumn("year", F.lit(year)).withColumn(
        "period_status", death_period_status("year", "outcome_id")
    )
    return add_comparison(rated, ["year", "outcome_id", "age_group", "sex"], STATE_AREAS)


def municipal_profile_counts(
    deaths: DataFrame, population: DataFrame, territory: Territory, definitions: list[Outcome], year: int
) -> DataFrame:
    """Deaths of the year per known municipality, outcome, age group and sex, unknown labels included."""
    counted = _profile_counts(deaths, territory, definitions, year)
    return known_members(counted, _known_municipalities(population), "municipality_code_datasus")


def municipal_profile_exclusions(
    deaths: DataFrame, population: DataFrame, territory: Territory, definitions: list[Outcome], year: int
) -> DataFrame:
    """Per outcome: deaths classified, and those left out for a code no municipality has or an unknown age or sex."""
    counted = _profile_counts(deaths, territory, definitions, year)
    known = _known_municipalities(population).withColumn("_known", F.lit(True))
    joined = counted.join(known, "municipality_code_datasus", "left")
    historical = F.col("_known").isNull()
    unlabelled = ~(F.col("age_group").isin(AGE_GROUPS) & F.col("sex").isin(SEXES))
    def total(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("count"))), F.lit(0))

    return joined.groupBy("outcome_id").agg(
        F.sum("count").alias("classified"), total(historical).alias("excluded_historical_code"),
        total(~historical & unlabelled).alias("excluded_unknown_label"), total(~historical & ~unlabelled).alias("published"),
    )


def _known_municipalities(population: DataFrame) -> DataFrame:
    return population.select(code7_to_code6("municipality_code_ibge").alias("municipality_code_datasus")).distinct()


def _profile_counts(deaths: DataFrame, territory: Territory, definitions: list[Outcome], year: int) -> DataFrame:
    code = F.trim(F.col("municipality_code_datasus"))
    state = deaths.where((F.col("source_year") == year) & F.col("residence_code_valid") & in_state(code, territory))
    cleaned = state.select(
        code.alias("municipality_code_datasus"),
        sex_label("sex_raw", "SIM").alias("sex"),
        F.col("age_raw").try_cast("double").alias("age_code"),
        "underlying_cause",
    )
    dimensions = cleaned.withColumn("years", death_age_years("age_code")).withColumn("age_group", age_bucket("years"))
    return classified_counts(dimensions, "underlying_cause", definitions, ["municipality_code_datasus", "age_group", "sex"])


def municipal_profiles(
    deaths: DataFrame, population: DataFrame, territory: Territory, definitions: list[Outcome], year: int
) -> DataFrame:
    """Age-sex death rates of every municipality with small and complementary cells marked.

    The cells of an outcome must add up to its classified deaths of known age and sex.
    """
    counts = municipal_profile_counts(deaths, population, territory, definitions, year)
    cell = ["municipality_code_datasus", "age_group", "sex"]
    people = population.where(F.col("age_group").isin(AGE_GROUPS) & F.col("sex").isin(SEXES)).select(
        "municipality_code_ibge", code7_to_code6("municipality_code_ibge").alias("municipality_code_datasus"),
        "age_group", "sex", "population",
    )
    grid = dense_grid(people, outcome_id=[d.id for d in definitions])
    # Each count carries its outcome's total into the grid, so checking costs no second scan.
    outcome = Window.partitionBy("outcome_id")
    known = counts.where(F.col("age_group").isin(AGE_GROUPS) & F.col("sex").isin(SEXES)).withColumn("_expected", F.sum("count").over(outcome))
    filled = fill_grid(grid, known, [*cell, "outcome_id"], ["count", "_expected"])
    shown = filled.withColumns({"_shown": F.sum("count").over(outcome), "_expected": F.max("_expected").over(outcome)})
    agreed = require(
        shown, F.col("_shown") == F.col("_expected"), at_key("profile cells do not add up for", ["outcome_id"])
    ).drop("_shown", "_expected")
    rated = add_rates(agreed).withColumn("year", F.lit(year)).withColumn(
        "period_status", death_period_status("year", "outcome_id")
    )
    return mark_not_applicable(complementary_suppression(rated, ["outcome_id", "age_group", "sex"]))


def municipal_map_rates(
    deaths: DataFrame, population: DataFrame, territory: Territory, definitions: list[Outcome]
) -> DataFrame:
    """Crude death rates per municipality, year and outcome."""
    keys = ["year", "municipality_code_datasus"]
    code = F.trim(F.coalesce(F.col("municipality_code_datasus"), F.lit("")))
    state = deaths.where(F.col("residence_code_valid") & in_state(code, territory)).select(
        F.col("source_year").cast("int").alias("year"), code.alias("municipality_code_datasus"), "underlying_cause"
    )
    counts = classified_counts(state, "underlying_cause", definitions, keys)
    people = population.select(
        "year", "municipality_code_ibge", code7_to_code6("municipality_code_ibge").alias("municipality_code_datasus"),
        "population",
    )
    grid = dense_grid(people, outcome_id=[d.id for d in definitions])
    filled = fill_grid(grid, counts, [*keys, "outcome_id"], ["count"])
    return add_rates(filled).withColumn("period_status", death_period_status("year", "outcome_id"))


def municipal_admission_rates(counts: DataFrame, population: DataFrame) -> DataFrame:
    """Crude admission rates per municipality, every municipality listed for every outcome present."""
    keys = ["year", "municipality_code_datasus"]
    joined = join_denominator(counts, population.select(
        "year", "municipality_code_ibge", code7_to_code6("municipality_code_ibge").alias("municipality_code_datasus"),
        "population",
    ), keys)
    return add_rates(joined.where(F.col("population").isNotNull())).withColumn(
        "period_status", product_period_status("municipal_admissions", "year")
    )


def admission_map_manifest(rates: DataFrame, annual: DataFrame) -> DataFrame:
    """One entry per year of municipal admission rates: what it holds and whether it adds up to the annual series.

    ``annual`` has year, geography, outcome_id and count. An outcome whose municipalities do not sum to
    the state's figure is listed with both, and the year's status says so; outcomes the annual series
    lacks are not judged. Snapshots are later chosen by this status.
    """
    totals = annual.where(F.col("geography") == STATE_TOTAL)
    off = reconcile(rates, totals.join(rates.select("year").distinct(), "year", "left_semi"), ["year", "outcome_id"], absent_totals_pass=True)
    gaps = off.groupBy("year").agg(F.array_sort(F.collect_list(F.struct(
        "outcome_id", F.col("observed").alias("municipal_total"), F.col("expected").alias("annual_total"),
    ))).alias("reconciliation"))
    held = rates.groupBy("year").agg(
        F.countDistinct("municipality_code_ibge").alias("municipalities"), F.array_sort(F.collect_set("outcome_id")).alias("outcome_ids"),
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("count") < SMALL_CELL, F.lit(1))).alias("suppressed_cells"),
    )
    state = F.when(F.col("reconciliation").isNull(), F.lit(RECONCILED)).otherwise(F.lit(NOT_RECONCILED))
    return held.join(gaps, "year", "left").withColumns({"source": F.lit("SIH"), "status": state})


def neurological_counts(deaths: DataFrame, municipalities: DataFrame, territory: Territory) -> DataFrame:
    """Deaths of the two dementia outcomes per municipality, plus state, country and rest totals."""
    definitions = {d.id: d for d in outcome_definitions("SIM") if d.section == "neurological"}
    base = deaths.select(
        F.col("source_year").cast("int").alias("year"),
        F.trim("municipality_code_datasus").alias("municipality_code_datasus"),
        normalize_code("underlying_cause").alias("cause"),
    )
    tests: dict[str, Column] = {i: icd_match("cause", d.ranges) for i, d in definitions.items()}
    per_code = conditional_counts(base, ["year", "municipality_code_datasus"], tests)
    codes = municipalities.select(
        "year", "municipality_code_ibge", code7_to_code6("municipality_code_ibge").alias("municipality_code_datasus")
    )
    placed = municipality_with_fallback(per_code, codes, "municipality_code_datasus", "year", REST_OF_COUNTRY)
    return union_totals(placed, ["year"], list(tests), territory)


def neurological_rates(
    deaths: DataFrame, municipalities: DataFrame, population: DataFrame, territory: Territory
) -> DataFrame:
    """Annual dementia death rates of municipalities and aggregates; areas without population drop out."""
    wide = neurological_counts(deaths, municipalities, territory)
    outcomes = ["alzheimer", "dementias_all"]
    areas = municipalities.select("year", F.col("municipality_code_ibge").alias("geography"), "population")
    people = areas.unionByName(population.select("year", "geography", "population"))
    years = wide.select("year").distinct()
    dense = people.join(years, "year", "left_semi").join(wide, ["year", "geography"], "left").fillna(0, subset=outcomes)
    long = dense.unpivot(["year", "geography", "population"], outcomes, "outcome_id", "count")
    return add_rates(long.where(F.col("population").isNotNull())).withColumns({
        "outcome_label": outcome_label("outcome_id"),
        "period_status": product_period_status("neurological", "year"),
    })


def notification_summary(counts: DataFrame, population: DataFrame) -> DataFrame:
    """Annual notifications with deaths by cause, rate, and deaths among notified."""
    keys = ["year", "geography", "outcome_id", "outcome_label"]
    renamed = counts.withColumn("year", F.col("source_year").cast("int"))
    wide = status_pivot(
        renamed, keys, {"death_srag_count": "óbito por SRAG", "death_other_count": "óbito por outra causa"}
    ).withColumn("death_any_count", F.col("death_srag_count") + F.col("death_other_count"))
    joined = join_denominator(wide, population.select("year", "geography", "population"), ["year", "geography"])
    return joined.withColumns({
        "notification_rate_per_100k": crude_rate("notification_count", "population"),
        "death_any_pct": share_pct("death_any_count", "notification_count"),
    })


def monthly_event_counts(events: DataFrame, territory: Territory, first: Column, last_month: Column) -> DataFrame:
    """Notifications and deaths per onset month, state area and outcome, inside the window."""
    placed = events.select(
        month_start("symptom_onset_date").alias("period"),
        classify_state_geography("municipality_code_datasus", territory).alias("geography"),
        "symptom_onset_date", "final_classification_raw",
        clean_text("outcome_raw").isin("2", "3").alias("died"),
    )
    inside = placed.where(
        (F.col("geography") != OUTSIDE_STATE) & in_observation_window("symptom_onset_date", first, last_month)
    )
    counted = notification_counts(inside, "final_classification_raw", ["period", "geography"], F.col("died"))
    return with_territory_totals(
        counted.drop("outcome_label"), ["period", "outcome_id"], ["count", "death_any_count"], national=False
    )


def monthly_notifications(
    events: DataFrame, population: DataFrame, territory: Territory, start: str, last_month: Column
) -> DataFrame:
    """Monthly series on the full calendar grid, with rates where a population exists."""
    keys = ["period", "geography", "outcome_id"]
    first = F.lit(start).cast("date")
    counted = monthly_event_counts(events, territory, first, last_month)
    one_row = events.sparkSession.range(1).select()
    grid = dense_grid(
        month_spine(first, last_month, one_row), geography=STATE_AREAS, outcome_id=[i for i, _, _ in NOTIFICATION_OUTCOMES]
    )
    filled = fill_grid(grid, counted, keys, ["count", "death_any_count"]).withColumns(
        {"year": F.year("period"), "month": F.month("period")}
    )
    joined = join_denominator(filled, population.select("year", "geography", "population"), ["year", "geography"])
    return joined.withColumnRenamed("count", "notification_count").withColumns({
        "notification_rate_per_100k": monthly_rate("notification_count", "population"),
        "death_any_pct": share_pct("death_any_count", "notification_count"),
        "period_status": product_period_status("monthly_notifications", "year"),
    })


def registry_rates(series: dict[str, DataFrame], population: DataFrame) -> DataFrame:
    """Registered cases per 100 000 of country, city and rest of state, with ratios.

    ``series`` holds yearly cases of the country, the selected city and the state.
    """
    wide = full_outer_series(series, "year", "cases")
    city, state = F.col(f"cases_{SELECTED}"), F.col(f"cases_{STATE_TOTAL}")
    wide = require(wide, F.coalesce(state >= city, F.lit(True)), at_key("state total below the selected city in", ["year"]))
    rest = state - city
    long = wide.withColumn(f"cases_{REST_OF_STATE}", rest).select("year", F.explode(F.array(*[
        F.struct(F.lit(place).alias("geography"), F.col(f"cases_{place}").alias("cases"))
        for place in (COUNTRY_TOTAL, SELECTED, REST_OF_STATE)
    ])).alias("_r")).select("year", "_r.*")
    joined = join_denominator(long, population.select("year", "geography", "population", "source_status"), ["year", "geography"])
    rated = joined.withColumn("registration_rate_per_100k", crude_rate("cases", "population"))
    rate = "registration_rate_per_100k"
    places = [COUNTRY_TOTAL, SELECTED, REST_OF_STATE]
    compared = wide_comparators(rated, ["year"], places, [rate])
    return compared.withColumns({
        "registration_rate_ratio_vr_vs_rest": rate_ratio(f"{rate}_{SELECTED}", f"{rate}_{REST_OF_STATE}"),
        "registration_rate_ratio_vr_vs_brazil": rate_ratio(f"{rate}_{SELECTED}", f"{rate}_{COUNTRY_TOTAL}"),
        "population_source_status": F.coalesce(F.col("source_status"), F.lit("missing")),
        "period_status": product_period_status("registry", "year"),
    }).drop("source_status", *[f"{rate}_{p}" for p in places])


def interruption_input(
    windows: DataFrame, population: DataFrame, outcomes: list[str], areas: list[str], start: str, origin_year: int
) -> DataFrame:
    """Monthly counts of complete years with their interruption variables."""
    monthly = deduplicated_admissions(windows).where(F.col("outcome_id").isin(outcomes) & F.col("geography").isin(areas))
    people = population.where(F.col("geography").isin(areas)).select("year", "geography", "population")
    joined = join_denominator(complete_years(monthly, people), people, ["year", "geography"], strict=True)
    dated = joined.withColumn("period", F.make_date("year", "month", F.lit(1))).withColumnRenamed("value", "count")
    return interruption_variables(dated, origin_year, start).withColumn(
        "period_status", product_period_status("interrupted_series", "year")
    )


def derived_admissions(state: DataFrame, city: DataFrame) -> DataFrame:
    """State and city tables of the same months to three areas per outcome, with what they were read from.

    Both have year, month, outcome_id, value, source_path and source_sha256; the state table also has
    municipality_code_datasus, which names the query. A state month without any city table raises;
    an outcome that either table of a month lacks gives no rows.
    """
    months, keys = ["year", "month"], ["year", "month", "outcome_id"]
    read = city.select(*months).distinct().withColumn("_read", F.lit(True))
    complete = require(state.join(read, months, "left"), F.col("_read"), at_key("no city table for", months))
    left = unique_rows(
        complete.select(*keys, "municipality_code_datasus", *[F.col(c).alias(f"_s_{c}") for c in ("value", "source_path", "source_sha256")]), keys, "state table",
    )
    right = unique_rows(city.select(*keys, *[F.col(c).alias(f"_c_{c}") for c in ("value", "source_path", "source_sha256")]), keys, "city table")

    def row(area: str, value: Column, sides: list[str]) -> Column:
        sources = [F.concat_ws(";", *[F.col(f"_{s}_{c}") for s in sides]).alias(n) for c, n in (("source_path", "source_paths"), ("source_sha256", "source_sha256s"))]
        return F.struct(F.lit(area).alias("geography"), value.alias("value"), *sources)

    whole, part = F.col("_s_value"), F.col("_c_value")
    rows = F.array(row(STATE_TOTAL, whole, ["s"]), row(SELECTED, part, ["c"]), row(REST_OF_STATE, whole - part, ["s", "c"]))
    spread = left.join(right, keys).select(*keys, "municipality_code_datasus", F.explode(rows).alias("_r"))
    return spread.select(
        *months, year_month("year", "month").alias("period"), "_r.geography", "municipality_code_datasus", "outcome_id",
        outcome_label("outcome_id", ADMISSION_OUTCOME_LABELS).alias("outcome_label"), "_r.value", F.lit(ADMISSION_UNIT).alias("unit"),
        "_r.source_paths", "_r.source_sha256s",
    )


def _counted_admissions(windows: DataFrame) -> DataFrame:
    """The row that counts of each month, area and outcome, its period, and how many rows it stands for."""
    last = F.max_by(F.struct("outcome_label", "value"), F.struct("source_file", "source_row_number")).alias("_last")
    counted = windows.groupBy(*ADMISSION_KEYS).agg(last, F.count(F.lit(1)).alias("_rows"))
    return counted.select(*ADMISSION_KEYS, "_last.outcome_label", "_last.value", "_rows", year_month("year", "month").alias("period"))


def _missing_periods(first: Column, last: Column, present: Column) -> Column:
    months = F.transform(months_between(month_from_text(first), month_from_text(last)), lambda m: F.date_format(m, "yyyy-MM"))
    return F.array_except(months, present)


def admission_summary(windows: DataFrame) -> DataFrame:
    """Deduplicated totals per outcome and area, with the label and the coverage behind them.

    ``missing_periods`` are the months between the group's first and last that it lacks.
    """
    grouped = _counted_admissions(windows).groupBy("outcome_id", "geography").agg(
        F.max("outcome_label").alias("outcome_label"), F.sum("value").alias("total"), F.count(F.lit(1)).alias("months"),
        F.count(F.when(F.col("value") < 0, F.lit(1))).alias("negatives"), (F.sum("_rows") - F.count(F.lit(1))).alias("duplicates_removed"),
        F.min("period").alias("first_period"), F.max("period").alias("last_period"), F.collect_set("period").alias("_present"),
    )
    return grouped.withColumn("missing_periods", _missing_periods(F.col("first_period"), F.col("last_period"), F.col("_present"))).drop("_present")


def admission_coverage(windows: DataFrame) -> DataFrame:
    """One row on the whole input: rows read and removed as duplicates, span, missing months and negative figures."""
    counted = _counted_admissions(windows).agg(
        F.sum("_rows").alias("rows_read"), (F.sum("_rows") - F.count(F.lit(1))).alias("duplicates_removed"),
        F.count(F.when(F.col("value") < 0, F.lit(1))).alias("negatives"), F.min("period").alias("first_period"),
        F.max("period").alias("last_period"), F.collect_set("period").alias("_present"),
    )
    return counted.withColumn("missing_periods", _missing_periods(F.col("first_period"), F.col("last_period"), F.col("_present"))).drop("_present")


def death_counts_by_area(deaths: DataFrame, definitions: list[Outcome] | None = None, strict: bool = True) -> DataFrame:
    """Deaths per year, outcome and six-digit area of residence, for comparators that name areas."""
    events = deaths.where("residence_code_valid").select(
        F.col("source_year").cast("int").alias("year"), normalize_code("municipality_code_datasus").alias("code"), "underlying_cause",
    )
    return classified_counts(events, "underlying_cause", definitions or outcome_definitions("SIM"), ["year", "code"], strict)


def population_product(municipal: DataFrame, state: DataFrame, national: DataFrame) -> DataFrame:
    """The one denominator table every rate product joins: state areas plus the country."""
    country = national.select("year", "geography", "population", F.lit("all").alias("source_status"))
    return union_all([state.select("year", "geography", "population", "source_status"), country])
