"""Public documents: observations, catalogue, maps, profiles, summaries, geometry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import (
    ALLOWED_CONCLUSION, AVAILABLE, AVAILABLE_PROFILE, CRUDE_KIND, CRUDE_METRIC, GEOGRAPHY_BASIS, MANIFEST_REFS, MAP_NOTES, MAP_PENDING,
    MAP_SCHEMA, MAP_STATUS, NO_PROFILE, NO_STANDARDIZATION, NOT_AVAILABLE, PROTECTED_PROFILE_FIELDS, RATE_MULTIPLIER, RELEASE_COMPARATORS, SMALL_CELL, SOURCE_ATTRIBUTES,
    SOURCE_TEXTS, STANDARD_POPULATION_LABEL, STANDARDIZATION, STANDARDIZED_KIND, STANDARDIZED_MANIFEST, STANDARDIZED_MAP_SCHEMA,
    STANDARDIZED_METRIC, STATE_TOTAL, outcome_definitions,
)
from ..functions.demographics import lookup
from ..functions.labels import indicator_id, outcome_theme, synonym_array
from ..functions.periods import data_status
from ..functions.text import clean_place_name, finite_or_null, round_coordinates
from ..operators.joins import reference_values
from ..operators.series import latest_period, leave_one_out
from ..operators.suppression import protect_profile, suppress_observations
from ..session import materialize

CRUDE, STANDARDIZED = CRUDE_METRIC, STANDARDIZED_METRIC


def manifest_reference(source: str, outcome: Column | str) -> Column:
    """The manifest that documents a source's rates of an outcome; null for a source without one."""
    for name, own, apart, common in MANIFEST_REFS:
        if name == source:
            return F.when(F.col(outcome).isin(own), F.lit(apart)).otherwise(F.lit(common))
    return F.lit(None).cast("string")


def municipal_manifest_reference(source: str, outcome: Column | str, year: Column | str) -> Column:
    """The manifest of the municipal map of a source's year; outcomes with a manifest of their own keep that."""
    of_map = F.concat(F.lit(f"reports/quality/{source.lower()}_municipal_map_"), F.col(year).cast("string"), F.lit("_manifest.json"))
    for name, own, apart, _ in MANIFEST_REFS:
        if name == source == "SIM":
            return F.when(F.col(outcome).isin(own), F.lit(apart)).otherwise(of_map)
    return of_map


def observations(rates: DataFrame, source: str, population: str, manifest: str | Column | None = None, area: str = "geography") -> DataFrame:
    """Rates to the public observation contract, small cells protected.

    ``manifest`` is a reference or an expression for one; without it each row names the manifest of its
    source and outcome, or of its municipal map.
    """
    if manifest is None:
        municipal = area != "geography"
        manifest = municipal_manifest_reference(source, "outcome_id", "year") if municipal else manifest_reference(source, "outcome_id")
    public = rates.select(
        indicator_id(F.lit(source), "outcome_id").alias("indicatorId"),
        F.lit(source).alias("source"),
        F.col("outcome_id").alias("outcomeId"),
        F.col(area).alias("geographyId"),
        F.col("year").cast("string").alias("period"),
        F.lit(CRUDE).alias("metricKind"),
        finite_or_null("rate_per_100k").alias("value"),
        F.col("count").cast("long").alias("count"),
        F.col(population).cast("long").alias("denominator"),
        finite_or_null("rate_ci_lower_per_100k").alias("ciLow"),
        finite_or_null("rate_ci_upper_per_100k").alias("ciHigh"),
        data_status(F.lit(source), F.col("year"), F.col("period_status")).alias("dataStatus"),
        F.col("period_status").alias("periodStatus"),
        F.lit(manifest).alias("manifestRef"),
        F.lit(GEOGRAPHY_BASIS).alias("geographyBasis"),
    )
    return suppress_observations(public)


def standardized_observations(rates: DataFrame, source: str, year: int, manifest: str = STANDARDIZED_MANIFEST) -> DataFrame:
    public = rates.select(
        indicator_id(F.lit(source), "outcome_id").alias("indicatorId"),
        F.lit(source).alias("source"),
        F.col("outcome_id").alias("outcomeId"),
        F.col("municipality_code_ibge").alias("geographyId"),
        F.lit(str(year)).alias("period"),
        F.lit(STANDARDIZED).alias("metricKind"),
        finite_or_null("standardized_rate_per_100k").alias("value"),
        F.col("count").cast("long").alias("count"),
        F.col("denominator").cast("long").alias("denominator"),
        finite_or_null("standardized_ci_low_per_100k").alias("ciLow"),
        finite_or_null("standardized_ci_high_per_100k").alias("ciHigh"),
        F.lit("source_observed").alias("dataStatus"),
        F.lit("source_year_observed").alias("periodStatus"),
        F.lit(manifest).alias("manifestRef"),
        F.lit(GEOGRAPHY_BASIS).alias("geographyBasis"),
    )
    return suppress_observations(public)


def catalog(series: DataFrame, municipal_series: DataFrame, labels: DataFrame) -> DataFrame:
    """One record per indicator: what it measures, how, where and when, and what may be concluded.

    ``labels`` maps outcomeId to its label. Whether an indicator is standardised, and for which
    year, is read from its municipal series; nested lists come out as sorted arrays.
    """
    areas = series.groupBy("indicatorId", "source", "outcomeId").agg(
        F.array_sort(F.collect_set("geographyId")).alias("geographyIds"),
        F.min(F.col("period").cast("int")).alias("yearStart"),
        F.max(F.col("period").cast("int")).alias("yearEnd"),
    )
    metrics = municipal_series.groupBy("indicatorId").agg(
        F.max(F.when(F.col("metricKind") == STANDARDIZED, F.col("period"))).alias("_standard"),
        F.max(F.when(F.col("metricKind") == CRUDE, F.col("period"))).alias("_mapped"),
    )
    known = areas.join(labels, "outcomeId").join(metrics, "indicatorId", "left")
    described = known.withColumns(_source_columns() | _metric_columns()).drop("_standard", "_mapped")
    return described.join(coverage_summary(municipal_series), "indicatorId", "left")


def _source_columns() -> dict[str, Column]:
    """Fields that follow from source and outcome alone."""
    source = F.col("source")
    attributes = {s: (measure, label, unit) for s, measure, label, unit in SOURCE_ATTRIBUTES}
    texts = {s: (name, definition, limits) for s, name, definition, limits in SOURCE_TEXTS}

    def of(table: dict[str, tuple], place: int) -> Column:
        return lookup({s: values[place] for s, values in table.items()}, source)

    ranges = F.lit(None).cast("array<string>")
    for outcome in outcome_definitions():
        ranges = F.when(F.col("outcomeId") == outcome.id, F.array(*[F.lit(r) for r in outcome.ranges])).otherwise(ranges)
    return {
        "theme": outcome_theme("outcomeId"), "measure": of(attributes, 0), "measureLabel": of(attributes, 1), "unit": of(attributes, 2),
        "sourceLabel": of(texts, 0), "definition": of(texts, 1), "doesNotAllowConclusion": of(texts, 2),
        "allowsConclusion": F.lit(ALLOWED_CONCLUSION), "cidRanges": ranges, "synonyms": synonym_array("outcomeId", "label"),
        "geographyBasis": F.lit(GEOGRAPHY_BASIS), "methodologyUrl": F.concat(F.lit("/indicadores/"), "indicatorId"),
        "profileAvailability": F.when(source == "SIM", F.lit(AVAILABLE_PROFILE)).otherwise(F.lit(NO_PROFILE)),
    }


def _map_status(period: Column, kind: Column) -> Column:
    return F.concat(F.lit(MAP_STATUS[0]), F.lower("source"), F.lit("_"), period, F.lit(MAP_STATUS[1]), kind)


def _metric_columns() -> dict[str, Column]:
    """Fields that follow from the metrics an indicator has."""
    year, has = F.col("_standard"), F.col("_standard").isNotNull()
    none = F.array().cast("array<string>")
    shown = _map_status(F.col("_mapped"), F.lit(CRUDE_KIND))
    return {
        "availableMetrics": F.array_compact(F.array(F.when(has, F.lit(STANDARDIZED)), F.lit(CRUDE), F.lit("count"))),
        "standardization": F.when(has, F.concat(F.lit(STANDARDIZATION[0]), year, F.lit(STANDARDIZATION[1]))).otherwise(F.lit(NO_STANDARDIZATION)),
        "standardPopulation": F.when(has, F.lit(STANDARD_POPULATION_LABEL)),
        "standardizationDimensions": F.when(has, F.array(F.lit("age_group"), F.lit("sex"))).otherwise(none),
        "standardizedRateAvailability": F.when(has, F.concat(F.lit(AVAILABLE), year)).otherwise(F.lit(NOT_AVAILABLE)),
        "metricPeriod": F.when(has, F.create_map(F.lit(STANDARDIZED), year)).otherwise(F.create_map().cast("map<string,string>")),
        "mapStatus": F.coalesce(shown, F.lit(MAP_PENDING)),
    }


def coverage_summary(municipal: DataFrame) -> DataFrame:
    """Publishable areas and first, last, missing and provisional periods per indicator."""
    year = F.col("period").cast("int")
    shown = F.col("value").isNotNull() & ~F.col("suppressed")
    span = F.sequence(F.min(year), F.max(year))
    return municipal.groupBy("indicatorId").agg(
        F.countDistinct(F.when(shown, F.col("geographyId"))).alias("publishableMunicipalityCount"),
        F.min("period").alias("firstPeriod"),
        F.max("period").alias("lastPeriod"),
        F.array_sort(F.collect_set("period")).alias("periods"),
        F.array_sort(F.transform(F.array_except(span, F.collect_set(year)), lambda y: y.cast("string"))).alias("missingPeriods"),
        F.array_sort(F.collect_set(F.when(F.col("dataStatus") == "provisional", F.col("period")))).alias("provisionalPeriods"),
    )


def municipal_map(series: DataFrame) -> DataFrame:
    """Values of the latest year of each indicator, or of its standardised year where it has one."""
    standard = (F.col("metricKind") == STANDARDIZED).cast("int")
    best = F.max(F.struct(standard.alias("standard"), F.col("period"), F.col("metricKind"))).alias("_best")
    choice = series.groupBy("indicatorId").agg(best).select("indicatorId", "_best.metricKind", "_best.period")
    return series.join(choice, ["indicatorId", "metricKind", "period"], "left_semi")


def alternative_map(series: DataFrame) -> DataFrame:
    """Latest crude values of indicators whose map shows the standardised rate."""
    has_standard = series.where(F.col("metricKind") == STANDARDIZED).select("indicatorId").distinct()
    crude = series.where(F.col("metricKind") == CRUDE).join(has_standard, "indicatorId", "left_semi")
    latest = crude.groupBy("indicatorId").agg(F.max("period").alias("period"))
    return crude.join(latest, ["indicatorId", "period"], "left_semi")


_VALUE_FIELDS = [
    "source", "outcomeId", "geographyId", "period", "metricKind", "value", "count", "denominator", "ciLow", "ciHigh", "dataStatus",
    "periodStatus", "suppressed", "manifestRef",
]


def _sorted_values(fields: list[str], first: str) -> Column:
    """A group's records as an array in a stable order; groups here are an indicator's areas in one period."""
    return F.array_sort(F.collect_list(F.struct(first, *[f for f in fields if f != first])))


def map_documents(series: DataFrame, indicators: DataFrame) -> DataFrame:
    """One nested map document per indicator of ``indicators`` (indicatorId), shown values first, alternative beside them.

    A document holds one record per municipality. An indicator without municipal values gets an
    empty one that says so.
    """
    shown = municipal_map(series).groupBy("indicatorId", "source", "metricKind", "period").agg(_sorted_values(_VALUE_FIELDS, "geographyId").alias("values"))
    crude = alternative_map(series).groupBy("indicatorId", "metricKind", "period").agg(_sorted_values(_VALUE_FIELDS, "geographyId").alias("values"))
    alternatives = crude.select("indicatorId", F.array(F.struct("metricKind", "period", "values")).alias("alternatives"))
    joined = indicators.select("indicatorId").join(shown, "indicatorId", "left").join(alternatives, "indicatorId", "left")
    standard, pending = F.col("metricKind") == STANDARDIZED, F.col("period").isNull()
    kind = F.when(standard, F.lit(STANDARDIZED_KIND)).otherwise(F.lit(CRUDE_KIND))
    note = F.lit(None).cast("string")
    for source, text in MAP_NOTES.items():
        before, _, behind = text.partition("{}")
        note = F.when(F.col("source") == source, F.concat(F.lit(before), "period", F.lit(behind))).otherwise(note)
    return joined.select(
        "indicatorId", F.when(standard, F.lit(STANDARDIZED_MAP_SCHEMA)).otherwise(F.lit(MAP_SCHEMA)).alias("schemaVersion"),
        F.when(pending, F.lit(MAP_PENDING)).otherwise(
            _map_status(F.col("period"), kind)
        ).alias("status"),
        F.col("period").cast("int").alias("period"), "metricKind", F.coalesce("values", F.array()).alias("values"),
        F.coalesce("alternatives", F.array()).alias("alternatives"), F.when(standard, F.lit(MAP_NOTES["standardized"])).otherwise(note).alias("note"),
    )


def comparison_documents(rates: DataFrame, manifest: str) -> DataFrame:
    """One record per indicator, city and period: the protected rest of the state nested, the country left open."""
    rest = comparisons(rates, manifest)
    fields = [c for c in rest.columns if c not in ("indicatorId", "municipalityCode")]
    return rest.select(
        "indicatorId", "municipalityCode", "period", F.struct(*fields).alias("restOfState"), F.lit(None).cast("double").alias("brazil")
    )


def publication_gate(signoff: dict, release_id: str, accessibility_revalidated: bool) -> dict[str, str]:
    """Review states. A sign-off counts only for the release it names, the accessibility one only after a new audit."""
    valid = signoff if signoff.get("releaseId") == release_id else {}

    def state(name: str) -> str:
        return valid.get(name, {}).get("status", "pending")

    return {
        "epidemiologyReview": state("epidemiologyReview"),
        "accessibilityReview": state("accessibilityReview") if accessibility_revalidated else "pending",
        "provenanceReview": "generated",
    }


def release_manifest(
    artifacts: DataFrame, records: DataFrame, missing_years: DataFrame, signoff: dict, release_id: str, accessibility_revalidated: bool
) -> DataFrame:
    """The release record: gate, comparators, coverage, and the written files with their checksums.

    ``artifacts`` has path, bytes, sha256 of the files as they lie in the package, one per document;
    ``records`` is the catalogue and ``missing_years`` the years without denominator.
    """
    gate = publication_gate(signoff, release_id, accessibility_revalidated)
    first = {s: F.min(F.when(F.col("theme") == s, F.col("yearStart"))).alias(f"{s}Start") for s in ("respiratory", "cardiovascular", "cardiorespiratory", "cancer")}
    coverage = records.agg(F.count(F.lit(1)).alias("indicatorCount"), *first.values(), F.max("yearEnd").alias("latestObservedYear"))
    files = artifacts.agg(F.array_sort(F.collect_list(F.struct("path", "bytes", "sha256"))).alias("artifacts"))
    gaps = missing_years.agg(F.array_sort(F.collect_set("year")).alias("missingDenominatorYears"))
    primary, secondary = RELEASE_COMPARATORS
    return coverage.select(
        F.lit(release_id).alias("releaseId"), F.lit(release_status(gate)).alias("status"), F.lit(SMALL_CELL).alias("smallCellThreshold"),
        F.lit(primary).alias("primaryComparator"), F.lit(secondary).alias("secondaryComparator"),
        F.struct(*[F.lit(v).alias(k) for k, v in gate.items()]).alias("publicationGate"),
        F.struct(*coverage.columns, gaps.scalar().alias("missingDenominatorYears")).alias("coverage"), files.scalar().alias("artifacts"),
    )


def map_scale(series: DataFrame, metric: Column) -> DataFrame:
    """Fixed colour domain of an indicator: its published range over every year."""
    return series.where(F.col("value").isNotNull() & (F.col("metricKind") == metric)).groupBy("indicatorId").agg(
        F.min("value").alias("domain_min"), F.max("value").alias("domain_max")
    )


def profiles(cells: DataFrame, year: int, manifest: str) -> DataFrame:
    """Age-sex cells to the public profile contract."""
    public = cells.select(
        F.col("municipality_code_ibge").alias("municipalityCode"),
        indicator_id(F.lit("SIM"), "outcome_id").alias("indicatorId"),
        F.lit(str(year)).alias("period"),
        F.col("age_group").alias("ageGroup"),
        "sex", F.col("count").cast("long").alias("count"),
        F.col("population").cast("long").alias("denominator"),
        finite_or_null("rate_per_100k").alias("ratePer100k"),
        finite_or_null("rate_ci_lower_per_100k").alias("ciLow"),
        finite_or_null("rate_ci_upper_per_100k").alias("ciHigh"),
        "suppression_status",
        F.lit("source_observed").alias("dataStatus"),
        F.lit(manifest).alias("manifestRef"),
    )
    return protect_profile(public, PROTECTED_PROFILE_FIELDS, "denominator").withColumnRenamed(
        "suppression_status", "suppressionStatus"
    )


def profile_table(public: DataFrame, municipality: str) -> DataFrame:
    """Age rows by sex columns of one municipality."""
    chosen = public.where(F.col("municipalityCode") == municipality)
    return chosen.groupBy("indicatorId", "ageGroup").pivot("sex", ["feminino", "masculino"]).agg(F.first("ratePer100k"))


def comparisons(rates: DataFrame, manifest: str) -> DataFrame:
    """For each city and period, the protected figures of the state without it."""
    rest = leave_one_out(rates, ["year", "outcome_id"])
    public = rest.select(
        indicator_id(F.lit("SIM"), "outcome_id").alias("indicatorId"),
        F.col("municipality_code_ibge").alias("municipalityCode"),
        F.col("year").cast("string").alias("period"),
        F.concat(F.lit("rest_of_rj_excluding_"), F.col("municipality_code_ibge")).alias("geographyId"),
        (F.col("rest_count").cast("double") / F.col("rest_population") * RATE_MULTIPLIER).alias("value"),
        F.col("rest_count").cast("long").alias("count"),
        F.col("rest_population").cast("long").alias("denominator"),
        F.lit(None).cast("double").alias("ciLow"),
        F.lit(None).cast("double").alias("ciHigh"),
        F.lit(manifest).alias("manifestRef"),
        F.lit(GEOGRAPHY_BASIS).alias("geographyBasis"),
    )
    return suppress_observations(public)


def municipality_summaries(
    municipal: DataFrame, aggregate: DataFrame, standardized_rest: DataFrame, country: str = "brazil_total"
) -> DataFrame:
    """Latest value of every municipality and indicator beside the rest of its state and the country.

    A standardised value compares with the standardised rest and with no country figure.
    """
    keyed = municipal.withColumn("year", F.col("period").cast("int"))
    latest = latest_period(keyed, ["indicatorId", "geographyId"], STANDARDIZED)
    keys = ["indicatorId", "period"]
    reference = aggregate.withColumnRenamed("geographyId", "geography")
    joined = reference_values(latest, reference, keys, {"stateCount": STATE_TOTAL}, "count")
    joined = reference_values(joined, reference, keys, {"statePopulation": STATE_TOTAL}, "denominator")
    joined = reference_values(joined, reference.where(~F.col("suppressed")), keys, {"countryValue": country}, "value")
    joined = joined.join(standardized_rest, ["outcomeId", "geographyId"], "left")
    rest_count = F.col("stateCount") - F.col("count")
    rest_people = F.col("statePopulation") - F.col("denominator")
    is_standard = F.col("metricKind") == STANDARDIZED
    crude_rest = F.when((rest_people > 0) & (rest_count >= 0), rest_count / F.when(rest_people > 0, rest_people) * RATE_MULTIPLIER)
    rest = F.when(~F.col("suppressed"), F.when(is_standard, F.col("standardized_rest")).otherwise(crude_rest))
    return joined.select(
        "indicatorId", F.col("geographyId").alias("municipalityCode"), "period", "metricKind", "value", "count",
        "dataStatus",
        F.when(F.col("suppressed"), F.lit("suppressed")).otherwise(F.lit("published")).alias("suppressionStatus"),
        rest.alias("restOfStateValue"),
        F.when(~is_standard, F.col("countryValue")).alias("brazilValue"),
        rest.isNotNull().alias("comparisonAvailable"),
    )


def polygon_rings(features: DataFrame) -> DataFrame:
    """Polygon and multi-polygon features to one numbered ring per row, coordinates rounded.

    ``features`` has code, geometry_type, and coordinates as polygons of rings of points.
    """
    window = Window.partitionBy("code").orderBy("polygon", "ring")
    rings = features.select("code", F.posexplode("coordinates").alias("polygon", "_rings")).select(
        "code", "polygon", F.posexplode("_rings").alias("ring", "points")
    )
    numbered = rings.withColumn("arc_in_area", F.row_number().over(window) - 1)
    return numbered.withColumn("points", round_coordinates("points", 2))


def number_arcs(rings: DataFrame) -> DataFrame:
    """Running ring number over all areas in code order.

    Areas are sorted into ranges of codes. A ring's number is the rings of earlier ranges, of
    earlier areas in its range, and of its own area before it; only one row per range is summed
    by a single task, however the codes are spelt.
    """
    per_area = rings.groupBy("code").agg(F.count(F.lit(1)).alias("_rings"))
    placed = materialize(
        per_area.repartitionByRange("code").sortWithinPartitions("code").withColumn("_range", F.spark_partition_id()), "ring-ranges",
    )
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy("_range").agg(F.sum("_rings").alias("_in_range")).select(
        "_range", F.coalesce(F.sum("_in_range").over(earlier.orderBy("_range")), F.lit(0)).alias("_base")
    )
    inside = F.coalesce(F.sum("_rings").over(earlier.partitionBy("_range").orderBy("code")), F.lit(0))
    offsets = placed.withColumn("_before", inside).join(ranges, "_range").select("code", (F.col("_base") + F.col("_before")).alias("_first"))
    return rings.join(offsets, "code").withColumn("arc", F.col("_first") + F.col("arc_in_area")).drop("_first")


def geometry_table(rings: DataFrame, names: DataFrame, selected: str) -> DataFrame:
    """One record per area with its name and ring references."""
    references = rings.groupBy("code").agg(F.array_sort(F.collect_set("arc")).alias("arcs"))
    named = references.join(names.withColumnRenamed("municipality_code_ibge", "code"), "code", "left")
    return named.select(
        "code", clean_place_name(F.coalesce("municipality_name", "code")).alias("name"),
        (F.col("code") == selected).alias("isSelected"), "arcs",
    )


def filtered_download(
    series: DataFrame, geographies: list[str], first: int, last: int, metric: str = "rate"
) -> DataFrame:
    """Observations of chosen areas and years with the selected metric as its own column."""
    year = F.col("period").cast("int")
    chosen = series.where(F.col("geographyId").isin(geographies) & year.between(first, last))
    shown = F.col("count").cast("double") if metric == "count" else F.col("value")
    return chosen.withColumn("selectedValue", shown).orderBy("period", "geographyId", "indicatorId")


def release_status(gate: dict[str, str]) -> str:
    """Public only once both human reviews are approved."""
    approved = all(gate.get(name) == "approved" for name in ("epidemiologyReview", "accessibilityReview"))
    return "public_release_ready" if approved else "technical_beta_not_for_public_release"
