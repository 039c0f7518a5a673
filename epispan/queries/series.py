"""Window operators (W01-W12) and sorting, limits and set operations (T01-T08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import REST_OF_STATE, SELECTED
from ..functions.demographics import age_order, sex_order
from ..functions.dates import year_month
from ..functions.text import site_code
from ..operators import series
from ..plans.products import interruption_input, neurological_counts
from ..plans.publish import profile_table, profiles
from ..operators.suppression import complementary_suppression
from ..session import table
from ..sources.snapshots import latest_names
from .registry import query
from .standins import (
    ADMISSION_OUTCOMES, TERRITORY, admission_windows, city_series, death_counts, deaths, map_rates, monthly_admissions,
    municipal_population, notifications, population, profile_cells, state_municipal_population,
)

def area_code():
    return F.col("municipality_code_ibge").alias("code7")


def r6(*names):
    return {n: F.round(n, 6) for n in names}


def year_of(name: str = "source_year"):
    return F.col(name).cast("int").alias("year")


@query("w01_dedup_keep_last", "SELECT year, month, geography, outcome_id, value FROM adm")
def _(spark, folder):
    keys = ["year", "month", "geography", "outcome_id"]
    return series.keep_last(admission_windows(spark, folder), keys, ["source_file", "source_row_number"]).select(*keys, "value")


@query("w01_dedup_hot_key", """
    SELECT o_orderpriority AS priority, arg_max(o_orderkey, o_orderkey) AS last_key, arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY 1""")
def _(spark, folder):
    """Five keys over every order: each key holds a fifth of all rows, none is gathered whole."""
    rows = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("priority"), F.col("o_orderkey").alias("last_key"), F.col("o_totalprice").alias("price")
    )
    return series.keep_last(rows, ["priority"], ["last_key"])


@query("w02_duplicate_key_count", "SELECT (count(*) - count(DISTINCT (l_orderkey, l_linenumber)))::BIGINT AS duplicate_rows FROM lineitem")
def _(spark, folder):
    return series.duplicate_rows(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("w03_complementary_suppression", """
    SELECT code7, outcome_id, age_group, sex, n AS count, CASE WHEN n < 5 THEN 'suppressed' WHEN n_small = 1 AND pos = 1 THEN 'suppressed_complementary' ELSE 'published' END AS status
    FROM (SELECT *, count(*) FILTER (WHERE n < 5) OVER (PARTITION BY outcome_id, age_group, sex) AS n_small,
      row_number() OVER (PARTITION BY outcome_id, age_group, sex ORDER BY n < 5, n, code7) AS pos FROM
      (SELECT code7, outcome_id, age_group, sex, n * 4 AS n FROM profile))""")
def _(spark, folder):
    """Counts times four, so that strata with exactly one small cell occur."""

    cells = profile_cells(spark, folder).withColumn("count", F.col("count") * 4)
    marked = complementary_suppression(cells, ["outcome_id", "age_group", "sex"])
    return marked.select(area_code(), "outcome_id", "age_group", "sex", "count", F.col("suppression_status").alias("status"))


@query("w04_latest_period_per_key", """
    SELECT code7, outcome_id, year, metric, n AS count FROM (SELECT *, CASE WHEN year = 1999 AND n % 2 = 0 THEN 'standardized' ELSE 'crude' END AS metric,
      row_number() OVER (PARTITION BY code7, outcome_id ORDER BY CASE WHEN year = 1999 AND n % 2 = 0 THEN 0 ELSE 1 END, year DESC) AS pos FROM munimap) WHERE pos = 1""")
def _(spark, folder):
    metric = F.when((F.col("year") == 1999) & (F.col("count") % 2 == 0), F.lit("standardized")).otherwise(F.lit("crude"))
    rows = map_rates(spark, folder).withColumn("metricKind", metric)
    latest = series.latest_period(rows, ["municipality_code_ibge", "outcome_id"], "standardized")
    return latest.select(area_code(), "outcome_id", "year", F.col("metricKind").alias("metric"), "count")


@query("w04_latest_names", "SELECT code7, arg_max(municipality_name, year) AS name FROM munipop GROUP BY 1")
def _(spark, folder):

    return latest_names(municipal_population(spark, folder)).select(area_code(), F.col("municipality_name").alias("name"))


@query("w05_competition_rank", """
    SELECT year, outcome_id, code7, rank() OVER (PARTITION BY year, outcome_id ORDER BY n DESC) AS rank FROM munimap WHERE n >= 5""")
def _(spark, folder):
    ranked = series.competition_rank(city_series(spark, folder), ["year", "outcome_id"], "shown_count")
    return ranked.select("year", "outcome_id", area_code(), F.col("rank").cast("long"))


@query("w06_leave_one_out_rate", """
    SELECT year, outcome_id, code7, rest_count, rest_population, round(rest, 6) AS rest_rate FROM cityseries""")
def _(spark, folder):
    return city_series(spark, folder).select(
        "year", "outcome_id", area_code(), "rest_count", "rest_population", F.round("rest_rate_per_100k", 6).alias("rest_rate")
    )


@query("w07_comparison_series", """
    SELECT code7, outcome_id, year, 'selected_municipality' AS place, round(value, 6) AS value, CASE WHEN NOT suppressed THEN n END AS count, population AS denominator, suppressed FROM cityseries
    UNION ALL SELECT code7, outcome_id, year, 'rest_of_rj_excluding_selected', round(rest, 6), CASE WHEN NOT suppressed THEN rest_count END,
      CASE WHEN suppressed THEN rest_population + population ELSE rest_population END, suppressed FROM cityseries
    UNION ALL SELECT code7, outcome_id, year, 'brazil_total', round(country_value, 6), country_count, country_population, false FROM cityseries WHERE country_value IS NOT NULL""")
def _(spark, folder):
    rows = series.comparison_rows(city_series(spark, folder))
    return rows.select(
        area_code(), "outcome_id", "year", F.col("comparisonId").alias("place"), F.round("value", 6).alias("value"), "count",
        "denominator", "suppressed",
    )


_CHANGE = "CASE WHEN {b} > 0 THEN ({a} / {b} - 1) * 100 WHEN {b} IS NOT NULL THEN 0 END"


def _change(a: str, b: str) -> str:
    return _CHANGE.format(a=a, b=b)


@query("w08_series_summary", f"""
    WITH s AS (SELECT *, lag(value) OVER (PARTITION BY code7, outcome_id ORDER BY year) AS prev, row_number() OVER (PARTITION BY code7, outcome_id ORDER BY year DESC) AS back,
        count(*) OVER (PARTITION BY code7, outcome_id) AS periods, min(year) OVER (PARTITION BY code7, outcome_id) AS first_year,
        first_value(value) OVER (PARTITION BY code7, outcome_id ORDER BY year) AS first_v FROM cityseries WHERE value IS NOT NULL)
    SELECT code7, outcome_id, periods, first_year, round(first_v, 6) AS first_value, year AS latest_year, round(value, 6) AS latest_value, round(prev, 6) AS previous_value,
      round({_change('value', 'prev')}, 6) AS period_change, CASE WHEN rest <> 0 THEN round({_change('value', 'rest')}, 6) END AS rest_difference,
      CASE WHEN country_value <> 0 THEN round({_change('value', 'country_value')}, 6) END AS country_difference
    FROM s WHERE back = 1 AND periods >= 2""")
def _(spark, folder):
    summary = series.series_summary(
        city_series(spark, folder), ["municipality_code_ibge", "outcome_id"], "value", "rest_rate_per_100k", "country_value"
    )
    return summary.withColumnRenamed("municipality_code_ibge", "code7").withColumns(
        r6("first_value", "latest_value", "previous_value", "period_change", "rest_difference", "country_difference")
    )


@query("w09_series_insight", f"""
    WITH s AS (SELECT * FROM cityseries WHERE value IS NOT NULL),
      g AS (SELECT code7, outcome_id, avg(value) FILTER (WHERE year IN (1995, 1996)) AS baseline, avg(value) FILTER (WHERE year IN (1997, 1999)) AS pandemic,
        arg_max(year, year) FILTER (WHERE NOT provisional) AS latest_year, arg_max(value, year) FILTER (WHERE NOT provisional) AS latest_value,
        arg_max(rest, year) FILTER (WHERE NOT provisional) AS rest, arg_max(country_value, year) FILTER (WHERE NOT provisional) AS country,
        arg_min(value, year) FILTER (WHERE NOT provisional) AS first_value, min(year) FILTER (WHERE provisional) AS provisional_year
        FROM s GROUP BY ALL HAVING count(*) FILTER (WHERE year IN (1995, 1996)) = 2 AND count(*) FILTER (WHERE year IN (1997, 1999)) = 2)
    SELECT code7, outcome_id, round(baseline, 6) AS baseline, round(pandemic, 6) AS pandemic, latest_year, round(latest_value, 6) AS latest_value, round(first_value, 6) AS first_value,
      round({_change('pandemic', 'baseline')}, 6) AS pandemic_change, round({_change('latest_value', 'pandemic')}, 6) AS recovery_change, round({_change('latest_value', 'first_value')}, 6) AS long_term_change,
      CASE WHEN rest <> 0 THEN round({_change('latest_value', 'rest')}, 6) END AS rest_difference, CASE WHEN country <> 0 THEN round({_change('latest_value', 'country')}, 6) END AS country_difference, provisional_year
    FROM g""")
def _(spark, folder):
    insight = series.series_insight(
        city_series(spark, folder), ["municipality_code_ibge", "outcome_id"], "value", [1995, 1996], [1997, 1999],
        "rest_rate_per_100k", "country_value",
    )
    return insight.withColumnRenamed("municipality_code_ibge", "code7").withColumns(r6(
        "baseline", "pandemic", "latest_value", "first_value", "pandemic_change", "recovery_change", "long_term_change",
        "rest_difference", "country_difference",
    ))


@query("w10_contiguous_segments", """
    SELECT code7, outcome_id, year, (sum(gap) OVER (PARTITION BY code7, outcome_id ORDER BY year))::BIGINT AS segment FROM
      (SELECT *, CASE WHEN year - lag(year) OVER (PARTITION BY code7, outcome_id ORDER BY year) > 1 THEN 1 ELSE 0 END AS gap FROM munimap WHERE n >= 5)""")
def _(spark, folder):
    shown = city_series(spark, folder).where("NOT suppressed")
    return series.contiguous_segments(shown, ["municipality_code_ibge", "outcome_id"]).select(area_code(), "outcome_id", "year", "segment")


@query("w11_missing_periods", """
    WITH s AS (SELECT code7, outcome_id, min(year) AS y0, max(year) AS y1, list(year) AS years FROM munimap WHERE n >= 5 GROUP BY ALL)
    SELECT code7, outcome_id, CAST(y AS INT) AS missing_year FROM (SELECT *, unnest(range(y0, y1 + 1)) AS y FROM s) WHERE NOT list_contains(years, y)""")
def _(spark, folder):
    shown = city_series(spark, folder).where("NOT suppressed")
    missing = series.missing_years(shown, ["municipality_code_ibge", "outcome_id"])
    return missing.select(area_code(), "outcome_id", "missing_year")


@query("w11_missing_months", """
    WITH s AS (SELECT geography, outcome_id, list(DISTINCT make_date(year, month, 1)) AS months, min(make_date(year, month, 1)) AS m0, max(make_date(year, month, 1)) AS m1 FROM adm_monthly GROUP BY ALL)
    SELECT geography, outcome_id, strftime(m, '%Y-%m') AS missing_period FROM
      (SELECT *, unnest(generate_series(m0, m1, INTERVAL 1 MONTH))::DATE AS m FROM s) WHERE NOT list_contains(months, m)""")
def _(spark, folder):
    rows = monthly_admissions(spark, folder).withColumn("period", year_month("year", "month"))
    return series.missing_months(rows, ["geography", "outcome_id"])


@query("w12_interruption_variables", """
    SELECT a.year, a.month, a.geography, a.outcome_id, a.value AS count, CAST((a.year - 1995) * 12 + a.month - 1 AS INT) AS time_index,
      CAST(make_date(a.year, a.month, 1) >= DATE '1999-03-01' AS INT) AS pandemic_step, CAST(greatest((a.year - 1995) * 12 + a.month - 1 - 50, 0) AS INT) AS post_pandemic_time,
      round(p.population / 12.0, 6) AS monthly_population, round(ln(p.population / 12.0), 6) AS offset_log_population
    FROM adm a JOIN pop p USING (year, geography) WHERE a.year IN (SELECT year FROM adm_years) AND a.geography IN ('volta_redonda', 'rest_of_rj_excluding_vr')""")
def _(spark, folder):
    rows = interruption_input(
        admission_windows(spark, folder), population(spark, folder), list(ADMISSION_OUTCOMES.values()),
        [SELECTED, REST_OF_STATE], "1999-03-01", 1995,
    )
    return rows.select(
        "year", "month", "geography", "outcome_id", "count", "time_index", "pandemic_step", "post_pandemic_time",
        F.round("monthly_population", 6).alias("monthly_population"), F.round("offset_log_population", 6).alias("offset_log_population"),
    )


@query("t01_stable_output_sort", "SELECT year, outcome_id, geography, n AS count FROM death_year ORDER BY year, outcome_id, geography")
def _(spark, folder):
    totals = death_counts(spark, folder).groupBy(year_of(), "outcome_id", "geography").agg(F.sum("count").alias("count"))
    return totals.orderBy("year", "outcome_id", "geography")


@query("t02_ordinal_sort", """
    SELECT age_group, sex, CAST(coalesce(a.age_order, 8) AS INT) AS age_position, CASE sex WHEN 'masculino' THEN 0 WHEN 'feminino' THEN 1 ELSE 2 END AS sex_position, sum(n)::BIGINT AS count
    FROM death_base LEFT JOIN ages a USING (age_group) GROUP BY ALL""")
def _(spark, folder):
    totals = death_counts(spark, folder).where("geography = 'brazil_total'").groupBy("age_group", "sex").agg(F.sum("count").alias("count"))
    placed = totals.withColumns({"age_position": age_order("age_group"), "sex_position": sex_order("sex")})
    return placed.orderBy("age_position", "sex_position")


@query("t03_top_k", """
    SELECT substr(cause, 1, 3) AS code, count(*) AS cases FROM death WHERE regexp_matches(cause, '^C[0-9]{2}') GROUP BY 1 HAVING count(*) >= 5
    ORDER BY cases DESC, code LIMIT 12""")
def _(spark, folder):
    code = site_code(F.upper("underlying_cause"))
    sites = deaths(spark, folder).groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("cases"))
    return sites.where("code IS NOT NULL AND cases >= 5").orderBy(F.desc("cases"), "code").limit(12)


@query("t04_union_all", """
    SELECT 'SIM' AS source, year, code6 AS code, count(*) AS n FROM death GROUP BY ALL UNION ALL SELECT 'SIVEP-SRAG', year, code6, count(*) FROM notif GROUP BY ALL""")
def _(spark, folder):
    keys = ["source", year_of(), F.col("municipality_code_datasus").alias("code")]
    parts = [read(spark, folder).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) for read in (deaths, notifications)]
    return series.union_all(parts)


@query("t05_distinct_rows", "SELECT DISTINCT year, outcome_id, outcome_label FROM death_base JOIN outcomes USING (outcome_id)")
def _(spark, folder):
    return death_counts(spark, folder).select(year_of(), "outcome_id", "outcome_label").dropDuplicates()


@query("t06_set_difference", """
    SELECT DISTINCT year FROM death WHERE year NOT IN (SELECT year FROM pop)""")
def _(spark, folder):
    return deaths(spark, folder).select(year_of()).distinct().exceptAll(population(spark, folder).select("year").distinct())


@query("t07_unpivot", """
    WITH n AS (SELECT d.year, p.code7 AS geography, count(*) FILTER (WHERE starts_with(cause, 'G30') OR cause IN ('F000', 'F001', 'F002')) AS alzheimer,
        count(*) FILTER (WHERE starts_with(cause, 'G30') OR substr(cause, 1, 3) IN ('F00', 'F01', 'F02', 'F03')) AS dementias_all
      FROM death d JOIN statepop p ON p.year = d.year AND substr(p.code7, 1, 6) = d.code6 GROUP BY ALL)
    SELECT year, geography, outcome_id, count FROM n UNPIVOT (count FOR outcome_id IN (alzheimer, dementias_all))""")
def _(spark, folder):
    wide = neurological_counts(deaths(spark, folder), state_municipal_population(spark, folder), TERRITORY)
    city = wide.where(F.col("geography").rlike("^33[0-9]{5}$"))
    return city.unpivot(["year", "geography"], ["alzheimer", "dementias_all"], "outcome_id", "count")


@query("t08_pivot_profile", """
    SELECT 'sim-' || replace(outcome_id, '_', '-') AS indicator, age_group, round(max(CASE WHEN status = 'published' THEN rate END) FILTER (WHERE sex = 'feminino'), 6) AS feminino,
      round(max(CASE WHEN status = 'published' THEN rate END) FILTER (WHERE sex = 'masculino'), 6) AS masculino FROM profile_status WHERE code7 = '3300011' GROUP BY ALL""")
def _(spark, folder):
    public = profiles(profile_cells(spark, folder), 2000, "manifest.json")
    wide = profile_table(public, "3300011")
    return wide.select(
        F.col("indicatorId").alias("indicator"), F.col("ageGroup").alias("age_group"), F.round("feminino", 6).alias("feminino"),
        F.round("masculino", 6).alias("masculino"),
    )
