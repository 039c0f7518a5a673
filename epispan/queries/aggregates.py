"""Aggregations (A01-A29)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import AGE_GROUPS, REST_OF_STATE, SELECTED, SITE_GROUPS, ComparatorSet
from ..functions.dates import in_observation_window
from ..functions.rates import crude_rate, log_ratio_interval, monthly_rate
from ..functions.territory import classify_geography
from ..functions.text import code7_to_code6
from ..functions.icd import icd_match
from ..operators import rollup
from ..operators.classify import classified_counts
from ..operators.comparators import compare_with_sets, membership, set_totals
from ..operators.joins import join_denominator, wide_comparators
from ..operators.quality import code_length_profile, column_profile, source_stats
from ..operators.series import annual_totals
from ..plans.products import (
    death_counts_by_area, death_dimensions, death_outcome_counts, deduplicated_admissions, monthly_event_counts, neurological_counts,
    notification_outcome_counts,
)
from ..plans.publish import coverage_summary, map_scale, observations
from ..plans.release import release_counters
from ..session import table
from .registry import query
from .standins import (
    MUNICIPALITIES, SIM, TERRITORY, admission_windows, death_counts, death_rates, deaths, map_rates, monthly_admissions,
    municipal_population, notification_totals, notifications, population, state_age_sex,
    state_municipal_population,
)


def year_of(name: str = "source_year"):
    return F.col(name).cast("int").alias("year")


@query("a01_classified_counts", """
    SELECT year, geography, outcome_id, outcome_label, sex, age_group, n AS count FROM death_base JOIN outcomes USING (outcome_id)""")
def _(spark, folder):
    keys = ["source_year", "geography", "sex", "age_group"]
    counted = classified_counts(death_dimensions(deaths(spark, folder), TERRITORY), "cause", SIM, keys)
    return counted.select(year_of(), "geography", "outcome_id", "outcome_label", "sex", "age_group", "count")


@query("a01_notification_counts", """
    SELECT year, geography, outcome_id, sex, age_group, outcome_status, n AS count FROM notif_counts""")
def _(spark, folder):
    """State-only input: the roll-up adds the state total and no country total."""
    return notification_outcome_counts(notifications(spark, folder), TERRITORY).select(
        year_of(), "geography", "outcome_id", "sex", "age_group", "outcome_status", "count"
    )


@query("a02_territory_rollup", "SELECT year, geography, sex, age_group, outcome_id, n AS count FROM death_counts")
def _(spark, folder):
    counts = death_outcome_counts(deaths(spark, folder), TERRITORY)
    return counts.select(year_of(), "geography", "sex", "age_group", "outcome_id", "count")


SETS = [
    ComparatorSet("rest_of_state", prefixes=("33",)), ComparatorSet("country", prefixes=("",), own_included=True),
    ComparatorSet("region", prefixes=("33001",), codes=("330000", "330005", "330010", "339999")), ComparatorSet("listed", codes=("330005", "350002", "350007")),
]
COMPARED = ["330000", "330005"]
SETS_SQL = """
    areas AS (SELECT DISTINCT substr(code7, 1, 6) AS code FROM munipop UNION SELECT DISTINCT code6 FROM death WHERE regexp_full_match(code6, '[0-9]{6}')),
    bridge AS (SELECT code, 'rest_of_state' AS comparator_id, false AS own FROM areas WHERE starts_with(code, '33') UNION ALL SELECT code, 'country', true FROM areas
      UNION ALL SELECT code, 'region', false FROM areas WHERE starts_with(code, '33001') OR code IN ('330000', '330005', '330010', '339999')
      UNION ALL SELECT code, 'listed', false FROM areas WHERE code IN ('330005', '350002', '350007')),
    by_area AS (SELECT year, code6 AS code, outcome_id, count(*) AS n FROM death_dim JOIN causes USING (cause) WHERE regexp_full_match(code6, '[0-9]{6}') GROUP BY ALL),
    people AS (SELECT year, substr(code7, 1, 6) AS code, sum(population)::BIGINT AS population FROM munipop GROUP BY ALL)"""


@query("a02_comparator_sets", f"WITH {SETS_SQL} SELECT year, outcome_id, comparator_id, sum(n)::BIGINT AS count FROM by_area JOIN bridge USING (code) GROUP BY ALL")
def _(spark, folder):
    """Deaths of four overlapping sets of areas, each area counted once in every set that names it."""
    counts = death_counts_by_area(deaths(spark, folder), SIM)
    return set_totals(counts, membership(counts, SETS), ["year", "outcome_id"], ["count"])


@query("s11_comparator_bridge", f"WITH {SETS_SQL} SELECT comparator_id, code, own AS own_included, population FROM bridge JOIN people USING (code) WHERE year = 2000")
def _(spark, folder):
    """Every area of the population table with the sets that name it."""
    people = _area_people(spark, folder).where("year = 2000")
    return membership(people, SETS).join(people, "code").select("comparator_id", "code", "own_included", "population")


def _area_people(spark, folder):
    return municipal_population(spark, folder).select("year", code7_to_code6("municipality_code_ibge").alias("code"), "population")


@query("w06_comparator_sets", f"""
    WITH {SETS_SQL},
    grid AS (SELECT p.year, p.code, p.population, o.outcome_id, s.comparator_id FROM people p, outcomes o, (SELECT DISTINCT comparator_id FROM bridge) s WHERE p.code IN ('330000', '330005')),
    own AS (SELECT g.*, coalesce(b.n, 0) AS n FROM grid g LEFT JOIN by_area b USING (year, code, outcome_id)),
    rest AS (SELECT o.year, o.code, o.outcome_id, o.comparator_id, o.n, o.population,
        (SELECT coalesce(sum(p.population), 0) FROM people p JOIN bridge b USING (code) WHERE b.comparator_id = o.comparator_id AND p.year = o.year AND (b.own OR p.code <> o.code)) AS rp,
        (SELECT coalesce(sum(a.n), 0) FROM by_area a JOIN bridge b USING (code) WHERE b.comparator_id = o.comparator_id AND a.year = o.year AND a.outcome_id = o.outcome_id AND (b.own OR a.code <> o.code)) AS rn
      FROM own o)
    SELECT year, outcome_id, code, comparator_id, n AS count, population, rn::BIGINT AS comparator_count, rp::BIGINT AS comparator_population, round(n / population * 100000.0, 6) AS rate,
      round(rn / rp * 100000.0, 6) AS comparator_rate, CASE WHEN rn > 0 THEN round((n / population * 100000.0) / (rn / rp * 100000.0), 6) END AS ratio,
      CASE WHEN n > 0 AND rn > 0 THEN round(exp(ln(n / population) - ln(rn / rp) - 1.959963984540054 * sqrt(1.0 / n + 1.0 / rn)), 6) END AS ratio_lower FROM rest""")
def _(spark, folder):
    """Two areas, one of them in two listed sets, against four comparators in one plan."""
    counts = death_counts_by_area(deaths(spark, folder), SIM)
    compared = compare_with_sets(counts, _area_people(spark, folder), SETS, COMPARED, {"outcome_id": [o.id for o in SIM]})
    figures = {"rate": "rate_per_100k", "comparator_rate": "comparator_rate_per_100k", "ratio": "rate_ratio", "ratio_lower": "rate_ratio_ci_lower"}
    return compared.select(
        "year", "outcome_id", "code", "comparator_id", "count", "population", "comparator_count", "comparator_population",
        *[F.round(c, 6).alias(n) for n, c in figures.items()],
    )


@query("a03_complement_total", """
    SELECT year, outcome_id, sum(n)::BIGINT AS total, coalesce(sum(n) FILTER (WHERE code7 = '3300000'), 0)::BIGINT AS selected,
      coalesce(sum(n) FILTER (WHERE code7 <> '3300000'), 0)::BIGINT AS rest FROM munimap GROUP BY ALL""")
def _(spark, folder):
    chosen = F.col("municipality_code_ibge") == TERRITORY.selected_code7
    return rollup.complement_totals(map_rates(spark, folder), ["year", "outcome_id"], "count", chosen)


@query("a04_population_denominators", """
    SELECT p.year, p.geography, p.population, m.source_status, m.source_files, m.municipality_count, m.municipality_count <> 10 AS incomplete
    FROM pop p JOIN (SELECT year, string_agg(DISTINCT source_status, ';') AS source_status, string_agg(DISTINCT source_file, ';') AS source_files,
      count(DISTINCT code7) AS municipality_count FROM statepop GROUP BY 1) m USING (year) WHERE p.geography <> 'brazil_total'""")
def _(spark, folder):
    state = rollup.state_denominators(state_municipal_population(spark, folder), TERRITORY, MUNICIPALITIES)
    return state.drop("municipality_code_ibge_vr", "unit")


@query("a05_national_denominator", """
    SELECT year, 'brazil_total' AS geography, sum(population)::BIGINT AS population, count(DISTINCT code7) AS municipality_count FROM munipop GROUP BY 1""")
def _(spark, folder):
    return rollup.national_denominators(municipal_population(spark, folder))


@query("a06_age_sex_denominators", """
    SELECT g AS geography, age_group, sex, sum(population)::BIGINT AS population FROM state_agesex,
      (VALUES ('rj_total'), ('volta_redonda'), ('rest_of_rj_excluding_vr')) v(g)
    WHERE g = 'rj_total' OR (g = 'volta_redonda') = (code7 = '3300000') GROUP BY ALL""")
def _(spark, folder):
    return rollup.age_sex_denominators(state_age_sex(spark, folder), TERRITORY)


@query("a07_conditional_counts", """
    SELECT year, geography, count(*) FILTER (WHERE starts_with(cause, 'G30') OR cause IN ('F000', 'F001', 'F002')) AS alzheimer,
      count(*) FILTER (WHERE starts_with(cause, 'G30') OR substr(cause, 1, 3) IN ('F00', 'F01', 'F02', 'F03')) AS dementias_all
    FROM death_dim WHERE geography <> 'outside_brazil' GROUP BY ALL""")
def _(spark, folder):
    placed = death_dimensions(deaths(spark, folder), TERRITORY).withColumn("year", F.col("source_year").cast("int"))
    definitions = {d.id: d.ranges for d in SIM if d.section == "neurological"}
    return rollup.conditional_counts(placed, ["year", "geography"], {i: icd_match("cause", r) for i, r in definitions.items()})


NEUROLOGICAL_SQL = """
    nd AS (SELECT year, code6, count(*) FILTER (WHERE starts_with(cause, 'G30') OR cause IN ('F000', 'F001', 'F002')) AS a,
        count(*) FILTER (WHERE starts_with(cause, 'G30') OR substr(cause, 1, 3) IN ('F00', 'F01', 'F02', 'F03')) AS b FROM death GROUP BY ALL),
    nb AS (SELECT d.year, coalesce(p.code7, 'rest_of_brazil_excluding_rj') AS geography, sum(a)::BIGINT AS alzheimer, sum(b)::BIGINT AS dementias_all
      FROM nd d LEFT JOIN statepop p ON p.year = d.year AND substr(p.code7, 1, 6) = d.code6
      WHERE p.code7 IS NOT NULL OR regexp_full_match(d.code6, '[0-9]{6}') GROUP BY ALL),
    nu AS (SELECT * FROM nb UNION ALL SELECT year, 'rj_total', sum(alzheimer)::BIGINT, sum(dementias_all)::BIGINT FROM nb WHERE starts_with(geography, '33') GROUP BY 1
      UNION ALL SELECT year, 'brazil_total', sum(alzheimer)::BIGINT, sum(dementias_all)::BIGINT FROM nb GROUP BY 1
      UNION ALL SELECT year, 'rest_of_rj_excluding_vr', sum(alzheimer)::BIGINT, sum(dementias_all)::BIGINT FROM nb WHERE starts_with(geography, '33') AND geography <> '3300000' GROUP BY 1)"""


@query("a08_union_totals", f"WITH {NEUROLOGICAL_SQL} SELECT year, geography, alzheimer, dementias_all FROM nu")
def _(spark, folder):
    return neurological_counts(deaths(spark, folder), state_municipal_population(spark, folder), TERRITORY)


@query("a09_monthly_surveillance", """
    SELECT CAST(date_trunc('month', onset) AS DATE) AS period, g AS geography, outcome_id, count(*) AS count, count(*) FILTER (WHERE outcome_code IN ('2', '3')) AS death_any_count
    FROM notif_dim d JOIN notif_outcomes o ON o.class_code IS NULL OR o.class_code = d.class_code,
      (VALUES ('rj_total'), ('volta_redonda'), ('rest_of_rj_excluding_vr')) v(g)
    WHERE starts_with(code6, '33') AND (g = 'rj_total' OR g = geography) AND onset >= DATE '1996-01-01' AND onset <= DATE '2001-06-30' GROUP BY ALL""")
def _(spark, folder):
    first, last = F.lit("1996-01-01").cast("date"), F.lit("2001-06-01").cast("date")
    return monthly_event_counts(notifications(spark, folder), TERRITORY, first, last)


@query("a10_status_pivot", """
    SELECT year, geography, outcome_id, sum(n)::BIGINT AS notification_count, coalesce(sum(n) FILTER (WHERE outcome_status = 'óbito por SRAG'), 0)::BIGINT AS death_srag_count,
      coalesce(sum(n) FILTER (WHERE outcome_status = 'óbito por outra causa'), 0)::BIGINT AS death_other_count, 0::BIGINT AS never_seen_count
    FROM notif_counts GROUP BY ALL""")
def _(spark, folder):
    counts = notification_totals(spark, folder).withColumn("year", F.col("source_year").cast("int"))
    return rollup.status_pivot(counts, ["year", "geography", "outcome_id"], {
        "death_srag_count": "óbito por SRAG", "death_other_count": "óbito por outra causa", "never_seen_count": "inexistente",
    })


@query("a11_month_coverage", "SELECT year, count(DISTINCT month) AS month_count FROM adm GROUP BY 1")
def _(spark, folder):
    return rollup.months_per_year(deduplicated_admissions(admission_windows(spark, folder)))


_COMPONENTS = [
    "resp_all", "cardio_all", "pneumonia", "hypertension_essential", "hypertension_other", "acute_myocardial_infarction",
    "ischemic_heart_disease_other", "cerebrovascular_hemorrhage", "cerebrovascular_infarction", "heart_failure",
]
_COMPONENT_EXPR = "CASE CAST(l_partkey % 11 AS INT) " + " ".join(
    f"WHEN {i} THEN '{c}'" for i, c in enumerate(_COMPONENTS)
) + " END"


@query("a12_component_sums", f"""
    WITH c AS (SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(l_suppkey % 25 AS INT) AS area, {_COMPONENT_EXPR} AS component_id, count(*) AS value FROM lineitem
      WHERE {_COMPONENT_EXPR} IS NOT NULL GROUP BY ALL)
    SELECT year, area, outcome_id, sum(value)::BIGINT AS value FROM c JOIN (VALUES ('resp_all', 'resp_all'), ('cardio_all', 'cardio_all'), ('pneumonia', 'pneumonia'),
      ('hypertension_essential', 'hypertension'), ('hypertension_other', 'hypertension'), ('acute_myocardial_infarction', 'acute_myocardial_infarction'),
      ('acute_myocardial_infarction', 'ischemic_heart_disease'), ('ischemic_heart_disease_other', 'ischemic_heart_disease'),
      ('cerebrovascular_hemorrhage', 'cerebrovascular'), ('cerebrovascular_infarction', 'cerebrovascular'), ('heart_failure', 'heart_failure')) v(component_id, outcome_id)
      USING (component_id) GROUP BY ALL
    UNION ALL SELECT year, area, 'cardiorespiratory_all', sum(value)::BIGINT FROM c WHERE component_id IN ('resp_all', 'cardio_all')
      GROUP BY ALL HAVING count(DISTINCT component_id) = 2""")
def _(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        F.year("l_shipdate").alias("year"), (F.col("l_suppkey") % 25).cast("int").alias("area"),
        F.expr(_COMPONENT_EXPR).alias("component_id"),
    ).where("component_id IS NOT NULL")
    components = rows.groupBy("year", "area", "component_id").agg(F.count(F.lit(1)).alias("value"))
    return rollup.component_sums(components, ["year", "area"]).drop("outcome_label")


@query("a13_profile_share", """
    SELECT year, geography, outcome_id, age_group, sex, n AS count, sum(n) OVER (PARTITION BY year, geography, outcome_id)::BIGINT AS total_count,
      round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY year, geography, outcome_id) * 100, 6) AS share_pct FROM death_counts""")
def _(spark, folder):
    counts = death_counts(spark, folder).withColumn("year", F.col("source_year").cast("int"))
    shares = rollup.profile_share(counts, ["year", "geography", "outcome_id"], ["age_group", "sex"])
    return shares.withColumn("share_pct", F.round("share_pct", 6))


@query("a14_mean_annual_rate", "SELECT geography, outcome_id, round(avg(rate), 2) AS mean_annual_rate FROM mort GROUP BY ALL")
def _(spark, folder):
    return rollup.mean_annual_rate(death_rates(spark, folder), ["geography", "outcome_id"], "rate_per_100k")


_GROUPS_SQL = ", ".join(f"('{g}', '{c}')" for g, codes in SITE_GROUPS for c in codes)


@query("a15_site_groups", f"""
    WITH s AS (SELECT substr(cause, 1, 3) AS code, count(*) AS n FROM death WHERE cause LIKE 'C%' GROUP BY 1),
      g AS (SELECT * FROM (VALUES {_GROUPS_SQL}) v(site_group, code))
    SELECT site_group, coalesce(sum(n), 0)::BIGINT AS cases, round(coalesce(sum(n), 0) / (SELECT sum(n) FROM s) * 100, 6) AS share_pct
    FROM g LEFT JOIN s USING (code) GROUP BY 1""")
def _(spark, folder):
    detail = deaths(spark, folder).select(F.upper(F.replace("underlying_cause", F.lit("."), F.lit(""))).alias("diagnosis_label"))
    cancers = detail.where(F.col("diagnosis_label").startswith("C")).withColumn("cases", F.lit(1).cast("long"))
    total = cancers.agg(F.lit("Total").alias("diagnosis_label"), F.sum("cases").alias("cases"))
    return rollup.site_group_summary(cancers.unionByName(total)).withColumn("share_pct", F.round("share_pct", 6))


def profile_sql(checks: dict[tuple[str, str], str], source: str) -> str:
    """Failures of every (check, column) per year: a count of the rows its condition names."""
    numbered = list(enumerate(checks.items()))
    counts = ", ".join(f"count(*) FILTER (WHERE {test}) AS c{i}" for i, (_, test) in numbered)
    names = ", ".join(f"('c{i}', '{check}', '{column}')" for i, ((check, column), _) in numbered)
    return (
        f"SELECT year, chk AS check, col AS column_name, failures, rows FROM (SELECT year, count(*) AS rows, {counts} FROM {source} GROUP BY 1) "
        f"UNPIVOT (failures FOR k IN ({', '.join(f'c{i}' for i, _ in numbered)})) JOIN (VALUES {names}) v(k, chk, col) USING (k)"
    )


_NOTIFICATION_CHECKS = {
    **{("missing", c): "false" for c in ("source", "source_file", "source_row_number", "residence_code_valid", "residence_is_vr")},
    **{("missing", c): "true" for c in ("municipality_code_notification", "notification_date", "outcome_date", "race_raw", "gestation_raw")},
    ("missing", "municipality_code_datasus"): "coalesce(code6, '') = ''", ("missing", "sex_raw"): "coalesce(sex_code, '') = ''",
    ("missing", "age_raw"): "age IS NULL", ("missing", "age_unit_raw"): "coalesce(unit, '') = ''", ("missing", "symptom_onset_date"): "onset IS NULL",
    ("missing", "final_classification_raw"): "class_code = ''", ("missing", "outcome_raw"): "outcome_code = ''",
    ("invalid_residence", "residence_code_valid"): "NOT regexp_full_match(code6, '[0-9]{6}')",
}


@query("a16_column_quality_profile", profile_sql(_NOTIFICATION_CHECKS, "notif"))
def _(spark, folder):
    profile = column_profile(notifications(spark, folder), ["source_year"])
    return profile.select(year_of(), "check", F.col("column").alias("column_name"), "failures", "rows")


@query("a17_code_length_profile", """
    SELECT year, length(ltrim(code6, '0')) AS code_length, count(*) AS rows, count(*) FILTER (WHERE code6 = '330000') AS target_rows FROM death GROUP BY ALL""")
def _(spark, folder):
    profile = code_length_profile(deaths(spark, folder), ["source_year"], "municipality_code_datasus", TERRITORY.selected_code6)
    return profile.select(year_of(), F.col("code_length").cast("long"), "rows", "target_rows")


@query("a18_source_stats", """
    SELECT year, count(*) AS rows, count(*) FILTER (WHERE s) AS state_rows, count(*) FILTER (WHERE s AND onset IS NULL) AS missing_onset_state_rows,
      count(*) FILTER (WHERE s AND onset IS NOT NULL AND NOT (onset >= DATE '1996-01-01' AND onset <= DATE '2001-06-30')) AS outside_window_state_rows
    FROM (SELECT *, starts_with(code6, '33') AS s FROM notif) GROUP BY 1""")
def _(spark, folder):
    inside = in_observation_window("symptom_onset_date", F.lit("1996-01-01").cast("date"), F.lit("2001-06-01").cast("date"))
    stats = source_stats(notifications(spark, folder), ["source_year"], "municipality_code_datasus", "symptom_onset_date", inside, TERRITORY)
    return stats.withColumn("year", F.col("source_year").cast("int")).drop("source_year")


@query("a19_annual_totals", """
    SELECT year, geography, sum(value)::BIGINT AS value, count(DISTINCT month) AS months, count(*) - count(DISTINCT month) AS duplicate_periods FROM adm_monthly GROUP BY ALL""")
def _(spark, folder):
    return annual_totals(monthly_admissions(spark, folder), ["geography"], ["value"])


def _municipal_observations(spark, folder):
    return observations(map_rates(spark, folder), "SIM", "population", "manifest.json", "municipality_code_ibge")


@query("a20_coverage_summary", """
    WITH s AS (SELECT outcome_id, count(DISTINCT code7) FILTER (WHERE n >= 5) AS publishable, min(year) AS y0, max(year) AS y1, list(DISTINCT year) AS years FROM munimap GROUP BY 1)
    SELECT 'sim-' || replace(outcome_id, '_', '-') AS indicator, publishable, CAST(y0 AS STRING) AS first_period, CAST(y1 AS STRING) AS last_period,
      array_to_string([CAST(y AS STRING) for y in range(y0, y1 + 1) if NOT list_contains(years, y)], '|') AS missing,
      array_to_string([CAST(y AS STRING) for y in list_sort(years)], '|') AS periods,
      array_to_string([CAST(y AS STRING) for y in list_sort(years) if y >= 2001], '|') AS provisional FROM s""")
def _(spark, folder):
    """The last year is marked provisional."""
    status = F.when(F.col("period") >= "2001", F.lit("provisional")).otherwise(F.col("dataStatus"))
    summary = coverage_summary(_municipal_observations(spark, folder).withColumn("dataStatus", status))
    return summary.select(
        F.col("indicatorId").alias("indicator"), F.col("publishableMunicipalityCount").alias("publishable"),
        F.col("firstPeriod").alias("first_period"), F.col("lastPeriod").alias("last_period"),
        F.array_join("missingPeriods", "|").alias("missing"), F.array_join("periods", "|").alias("periods"),
        F.array_join("provisionalPeriods", "|").alias("provisional"),
    )


@query("a21_map_scale_domain", """
    SELECT 'sim-' || replace(outcome_id, '_', '-') AS indicator, round(min(rate), 6) AS domain_min, round(max(rate), 6) AS domain_max FROM munimap WHERE n >= 5 GROUP BY 1""")
def _(spark, folder):
    scale = map_scale(_municipal_observations(spark, folder), F.lit("crude_rate_per_100k"))
    return scale.select(
        F.col("indicatorId").alias("indicator"), F.round("domain_min", 6).alias("domain_min"), F.round("domain_max", 6).alias("domain_max")
    )


@query("a22_release_counters", """
    SELECT 'SIM' AS source, CASE WHEN year >= 2001 THEN 'provisional' ELSE 'source_observed' END AS status, count(*) AS observations, count(*) FILTER (WHERE n < 5 AND year <> 1996) AS suppressed,
      count(*) FILTER (WHERE n < 5 AND year = 1996) AS leaks FROM munimap GROUP BY 2""")
def _(spark, folder):
    """One year forgot to hide its small cells, the last one is provisional."""
    public, shown = _municipal_observations(spark, folder), F.col("suppressed") & (F.col("period") == "1996")
    broken = public.withColumns({
        "count": F.when(shown, F.lit(1).cast("long")).otherwise(F.col("count")), "suppressed": F.col("suppressed") & (F.col("period") != "1996"),
        "dataStatus": F.when(F.col("period") >= "2001", F.lit("provisional")).otherwise(F.col("dataStatus")),
    })
    return release_counters(broken).select(
        "source", F.col("dataStatus").alias("status"), "observations", F.col("suppressedObservations").alias("suppressed"),
        F.col("unsuppressedSmallCells").alias("leaks"),
    )


_BLOCKS = [("1995-1997", 1995, 1997), ("1999-2001", 1999, 2001)]
_BLOCK_SQL = "(VALUES ('1995-1997', 1995, 1997), ('1999-2001', 1999, 2001)) v(block, y0, y1)"


@query("a23_pooled_block_rates", f"""
    WITH b AS (SELECT block, geography, outcome_id, sum(n)::BIGINT AS count, sum(population)::BIGINT AS population FROM mort JOIN {_BLOCK_SQL} ON year BETWEEN y0 AND y1 GROUP BY ALL)
    SELECT v.block, v.outcome_id, round(v.count / v.population * 100000.0, 6) AS city_rate, round(r.count / r.population * 100000.0, 6) AS rest_rate,
      CASE WHEN v.count > 0 AND r.count > 0 THEN round(exp(ln(v.count / v.population) - ln(r.count / r.population) - 1.959963984540054 * sqrt(1.0 / v.count + 1.0 / r.count)), 6) END AS ratio_ci_lower,
      CASE WHEN v.count > 0 AND r.count > 0 THEN round(exp(ln(v.count / v.population) - ln(r.count / r.population) + 1.959963984540054 * sqrt(1.0 / v.count + 1.0 / r.count)), 6) END AS ratio_ci_upper
    FROM b v JOIN b r USING (block, outcome_id) WHERE v.geography = 'volta_redonda' AND r.geography = 'rest_of_rj_excluding_vr'""")
def _(spark, folder):
    pooled = rollup.pooled_blocks(death_rates(spark, folder), _BLOCKS, ["geography", "outcome_id"])
    wide = wide_comparators(pooled, ["block", "outcome_id"], [SELECTED, REST_OF_STATE], ["count", "population"])
    city = wide.where(F.col("geography") == SELECTED)
    limits = log_ratio_interval(
        F.col("count"), F.col(f"count_{REST_OF_STATE}"), F.col("population"), F.col(f"population_{REST_OF_STATE}")
    )
    return city.withColumn("_l", limits).select(
        "block", "outcome_id", F.round(crude_rate("count", "population"), 6).alias("city_rate"),
        F.round(crude_rate(f"count_{REST_OF_STATE}", f"population_{REST_OF_STATE}"), 6).alias("rest_rate"),
        F.round("_l.lower", 6).alias("ratio_ci_lower"), F.round("_l.upper", 6).alias("ratio_ci_upper"),
    )


@query("a24_event_bridge_ratio", """
    WITH a AS (SELECT year, geography, outcome_id, sum(value)::BIGINT AS n FROM adm GROUP BY ALL), d AS (SELECT * FROM death_year WHERE geography <> 'rest_of_brazil_excluding_rj')
    SELECT year, geography, outcome_id, coalesce(a.n, 0) AS count_sih, coalesce(d.n, 0) AS count_sim, CASE WHEN d.n > 0 THEN round(coalesce(a.n, 0) / d.n, 6) END AS ratio
    FROM a FULL JOIN d USING (year, geography, outcome_id)""")
def _(spark, folder):
    hospital = deduplicated_admissions(admission_windows(spark, folder)).select(
        F.lit("SIH").alias("source"), "year", "geography", "outcome_id", F.col("value").alias("count")
    )
    died = death_counts(spark, folder).where("geography <> 'rest_of_brazil_excluding_rj'").select(
        "source", year_of(), "geography", "outcome_id", "count"
    )
    bridge = rollup.two_source_ratio(hospital.unionByName(died), ["year", "geography", "outcome_id"], "SIH", "SIM")
    return bridge.withColumn("ratio", F.round("ratio", 6))


@query("a25_block_mean_rates", f"""
    SELECT block, geography, outcome_id, round(avg(rate), 6) AS mean_rate FROM mort JOIN {_BLOCK_SQL} ON year BETWEEN y0 AND y1 GROUP BY ALL""")
def _(spark, folder):
    means = rollup.block_means(death_rates(spark, folder), _BLOCKS, ["geography", "outcome_id"], "rate_per_100k")
    return means.withColumn("mean_rate", F.round("mean_rate", 6))


@query("a26_establishment_production", """
    SELECT CAST(year(o_orderdate) AS INT) AS year, lpad(CAST(o_custkey % 500 AS STRING), 7, '0') AS geography,
      CASE o_orderstatus WHEN 'F' THEN 'alzheimer' ELSE 'dementias_all' END AS outcome_id, 'establishment' AS geography_basis, count(*) AS count
    FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY ALL""")
def _(spark, folder):
    rows = table(spark, folder, "orders").selectExpr(
        "year(o_orderdate) AS year", "o_custkey % 500 AS municipality_code_ibge",
        "CASE o_orderstatus WHEN 'F' THEN 'alzheimer' WHEN 'O' THEN 'dementias_all' ELSE 'other' END AS outcome_id",
        "'establishment' AS geography_basis", "1L AS count",
    )
    return rollup.establishment_production(rows, ["alzheimer", "dementias_all"])


@query("a27_premature_share", """
    SELECT year, geography, outcome_id, coalesce(sum(n) FILTER (WHERE age_group NOT IN ('65-74', '75+')), 0)::BIGINT AS young_count, sum(n)::BIGINT AS count,
      round(CAST(coalesce(sum(n) FILTER (WHERE age_group NOT IN ('65-74', '75+')), 0) AS DOUBLE) / sum(n) * 100, 6) AS premature_pct
    FROM death_counts WHERE age_group <> 'ignorado' GROUP BY ALL""")
def _(spark, folder):
    known = death_counts(spark, folder).where("age_group <> 'ignorado'").withColumn("year", F.col("source_year").cast("int"))
    share = rollup.premature_share(known, ["year", "geography", "outcome_id"], AGE_GROUPS[:6])
    return share.withColumn("premature_pct", F.round("premature_pct", 6))


@query("a28_monthly_ratio_audit", """
    WITH m AS (SELECT a.year, a.month, a.outcome_id, a.geography, a.value / (p.population / 12.0) AS rate FROM adm a JOIN pop p USING (year, geography)),
      w AS (SELECT year, month, outcome_id, max(rate) FILTER (WHERE geography = 'volta_redonda') / max(rate) FILTER (WHERE geography = 'rest_of_rj_excluding_vr') AS ratio FROM m GROUP BY ALL)
    SELECT year, outcome_id, count(*) FILTER (WHERE ratio > 1) AS months_above, round(min(ratio), 6) AS lowest, round(max(ratio), 6) AS highest FROM w GROUP BY ALL""")
def _(spark, folder):
    monthly = deduplicated_admissions(admission_windows(spark, folder))
    people = population(spark, folder).select("year", "geography", "population")
    rated = join_denominator(monthly, people, ["year", "geography"]).where("population IS NOT NULL").withColumn(
        "rate", monthly_rate("value", "population")
    )
    wide = rated.groupBy("year", "month", "outcome_id").agg(*[
        F.max(F.when(F.col("geography") == g, F.col("rate"))).alias(g) for g in (SELECTED, REST_OF_STATE)
    ]).withColumn("ratio", F.try_divide(SELECTED, REST_OF_STATE))
    return wide.groupBy("year", "outcome_id").agg(
        F.count(F.when(F.col("ratio") > 1, F.lit(1))).alias("months_above"),
        F.round(F.min("ratio"), 6).alias("lowest"), F.round(F.max("ratio"), 6).alias("highest"),
    )


@query("a29_observed_end_month", """
    SELECT geography, count(*) AS n, (SELECT CAST(date_trunc('month', max(onset)) AS DATE) FROM notif) AS end_month FROM notif_dim GROUP BY 1""")
def _(spark, folder):
    events = notifications(spark, folder)
    end = rollup.observed_end_month(events, "symptom_onset_date", "2025-12-01")
    label = classify_geography("municipality_code_datasus", TERRITORY)
    counted = events.groupBy(label.alias("geography")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("*", end.alias("end_month"))
