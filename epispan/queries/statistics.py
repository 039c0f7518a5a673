"""Statistical operators (ST01-ST19) and disclosure control (PV01-PV05)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..fixed_values import (
    PROTECTED_FIELDS, PROTECTED_PROFILE_FIELDS, REST_OF_STATE, SELECTED, COUNTRY_TOTAL, STATE_TOTAL,
)
from ..functions.labels import indicator_id, percent_change, ratio_guarded
from ..functions.poisson import with_poisson_interval
from ..functions.rates import crude_rate, rate_difference, rate_ratio
from ..operators.its import fit_interrupted_series, fit_level_change, fitted_moments
from ..operators.joins import join_denominator
from ..operators.rollup import age_sex_denominators, observed_end_month
from ..operators.rates import add_rates
from ..operators.standardize import direct_standardized_rate, standardized_rest_of_state
from ..operators.suppression import (
    display_text, mark_not_applicable, protect_profile, protected_leaks,
)
from ..plans import products
from ..plans.publish import observations, profiles
from ..session import table
from ..sources.snapshots import valid_status, validated_rows
from .aggregates import NEUROLOGICAL_SQL
from .registry import query
from .standins import (
    ADMISSION_OUTCOMES, PROFILE, SIM, STANDARD_YEAR, TERRITORY, admission_windows, city_series, death_counts, death_rates, deaths,
    map_rates, monthly_admissions, notification_totals, notifications, population, population_age_sex, profile_cells,
    state_age_sex, state_municipal_population,
)

def area_code():
    return F.col("municipality_code_ibge").alias("code7")
_INTERVAL = """
    ks AS (SELECT DISTINCT n AS k FROM {source}),
    bis AS (
      SELECT k, side, 0 AS it, CAST(0 AS DOUBLE) AS lo, k + 12 * sqrt(k + 1.0) + 25 AS hi FROM ks, (VALUES ('lower'), ('upper')) s(side) WHERE k > 0 OR side = 'upper'
      UNION ALL
      SELECT k, side, it + 1, CASE WHEN tail > goal THEN mid ELSE lo END, CASE WHEN tail > goal THEN hi ELSE mid END FROM (
        SELECT *, CASE side WHEN 'lower' THEN 0.975 ELSE 0.025 END AS goal,
          list_sum([exp(i * ln(mid) - mid - lgamma(i + 1)) for i in range(CASE side WHEN 'lower' THEN k ELSE k + 1 END)]) AS tail
        FROM (SELECT *, (lo + hi) / 2 AS mid FROM bis WHERE it < 60))),
    lim AS (SELECT k, coalesce(max(lo) FILTER (WHERE side = 'lower'), 0) AS lower, max(lo) FILTER (WHERE side = 'upper') AS upper FROM bis WHERE it = 60 GROUP BY k)"""


def interval_sql(source: str) -> str:
    """Poisson limits by bisection of their defining tail sums."""
    return _INTERVAL.format(source=source)


def rounded(df, places, *names):
    return df.withColumns({n: F.round(n, places) for n in names})


def year_of(name: str = "source_year"):
    return F.col(name).cast("int").alias("year")


@query("entry_outcome_rate_vs_rest", """
    SELECT v.outcome_id, v.year, v.geography, CASE WHEN v.n >= 5 THEN v.n END AS count, v.population,
      CASE WHEN v.n >= 5 THEN round(v.rate, 6) END AS rate_per_100k, CASE WHEN r.rate > 0 THEN round(c.rate / r.rate, 6) END AS rate_ratio_vr_vs_rest, v.n < 5 AS suppressed
    FROM mort v JOIN mort c ON c.geography = 'volta_redonda' AND c.year = v.year AND c.outcome_id = v.outcome_id
    JOIN mort r ON r.geography = 'rest_of_rj_excluding_vr' AND r.year = v.year AND r.outcome_id = v.outcome_id""")
def _(spark, folder):
    """Flagship: classify, count, roll up, rate, compare and protect, in one plan."""
    small = F.col("count") < 5
    counts = products.death_outcome_counts(deaths(spark, folder), TERRITORY)
    return products.mortality_rates(counts, population(spark, folder)).select(
        "outcome_id", "year", "geography", F.when(~small, F.col("count")).alias("count"), "population",
        F.when(~small, F.round("rate_per_100k", 6)).alias("rate_per_100k"),
        F.round("rate_ratio_vr_vs_rest", 6).alias("rate_ratio_vr_vs_rest"), small.alias("suppressed"),
    )


@query("st01_crude_rate", "SELECT code7, year, outcome_id, n AS count, round(rate, 6) AS rate FROM munimap")
def _(spark, folder):
    rated = map_rates(spark, folder).withColumn("rate", F.round(crude_rate("count", "population"), 6))
    return rated.select(area_code(), "year", "outcome_id", "count", "rate")


@query("st02_poisson_exact_ci", f"""
    WITH RECURSIVE {interval_sql('death_year')}
    SELECT year, geography, outcome_id, n AS count, round(lower, 5) AS lower, round(upper, 5) AS upper FROM death_year JOIN lim ON k = n""")
def _(spark, folder):
    totals = death_counts(spark, folder).groupBy(year_of(), "geography", "outcome_id").agg(F.sum("count").alias("count"))
    limits = with_poisson_interval(totals, "count", "_l")
    return limits.select(
        "year", "geography", "outcome_id", "count", F.round("_l.lower", 5).alias("lower"), F.round("_l.upper", 5).alias("upper")
    )


_PAIR = """
    p AS (SELECT v.year, v.outcome_id, v.n AS a, r.n AS b, v.population AS pa, r.population AS pb, v.rate AS ra, r.rate AS rb
      FROM mort v JOIN mort r USING (year, outcome_id) WHERE v.geography = 'volta_redonda' AND r.geography = 'rest_of_rj_excluding_vr')"""


@query("st03_rate_ratio_difference", f"""
    WITH {_PAIR} SELECT year, outcome_id, CASE WHEN rb > 0 THEN round(ra / rb, 6) END AS ratio, round(ra - rb, 6) AS difference FROM p""")
def _(spark, folder):
    city = death_rates(spark, folder).where(F.col("geography") == SELECTED)
    rest = f"rate_per_100k_{REST_OF_STATE}"
    return city.select(
        "year", "outcome_id", F.round(rate_ratio("rate_per_100k", rest), 6).alias("ratio"),
        F.round(rate_difference("rate_per_100k", rest), 6).alias("difference"),
    )


@query("st04_rate_ratio_ci", f"""
    WITH {_PAIR} SELECT year, outcome_id, CASE WHEN a > 0 AND b > 0 THEN round(exp(ln(a / pa) - ln(b / pb) - 1.959963984540054 * sqrt(1.0 / a + 1.0 / b)), 6) END AS lower,
      CASE WHEN a > 0 AND b > 0 THEN round(exp(ln(a / pa) - ln(b / pb) + 1.959963984540054 * sqrt(1.0 / a + 1.0 / b)), 6) END AS upper FROM p""")
def _(spark, folder):
    city = death_rates(spark, folder).where(F.col("geography") == SELECTED)
    return city.select(
        "year", "outcome_id", F.round("rate_ratio_ci_lower", 6).alias("lower"), F.round("rate_ratio_ci_upper", 6).alias("upper")
    )


@query("st05_annual_rates", f"""
    WITH RECURSIVE an AS (SELECT year, geography, outcome_id, sum(value)::BIGINT AS n FROM adm WHERE year IN (SELECT year FROM adm_years) GROUP BY ALL), {interval_sql('an')},
      r AS (SELECT an.*, p.population, n / p.population * 100000.0 AS rate, lower / p.population * 100000.0 AS lo, upper / p.population * 100000.0 AS hi
        FROM an JOIN lim ON k = n JOIN pop p USING (year, geography))
    SELECT r.year, r.geography, r.outcome_id, r.n AS count, r.population AS denominator, round(r.rate, 6) AS rate, round(r.lo, 5) AS ci_lower, round(r.hi, 5) AS ci_upper,
      CASE WHEN b.rate > 0 THEN round(a.rate / b.rate, 6) END AS ratio, 'complete_annual' AS period_status
    FROM r LEFT JOIN r a ON a.geography = 'volta_redonda' AND a.year = r.year AND a.outcome_id = r.outcome_id
    LEFT JOIN r b ON b.geography = 'rest_of_rj_excluding_vr' AND b.year = r.year AND b.outcome_id = r.outcome_id""")
def _(spark, folder):
    rates = products.annual_admission_rates(admission_windows(spark, folder), population(spark, folder))
    return rates.select(
        "year", "geography", "outcome_id", "count", "denominator", F.round("rate_per_100k", 6).alias("rate"),
        F.round("rate_ci_lower_per_100k", 5).alias("ci_lower"), F.round("rate_ci_upper_per_100k", 5).alias("ci_upper"),
        F.round("rate_ratio_vr_vs_rest", 6).alias("ratio"), "period_status",
    )


@query("st06_mortality_rates", f"""
    WITH RECURSIVE {interval_sql('mort')}
    SELECT m.year, m.geography, m.outcome_id, m.n AS count, m.population, round(rate, 6) AS rate, round(lower / population * 100000.0, 4) AS ci_lower,
      round(upper / population * 100000.0, 4) AS ci_upper, s.period_status FROM mort m JOIN lim ON k = n JOIN death_status s USING (year, outcome_id)""")
def _(spark, folder):
    rates = products.mortality_rates(death_counts(spark, folder), population(spark, folder))
    return rates.select(
        "year", "geography", "outcome_id", "count", "population", F.round("rate_per_100k", 6).alias("rate"),
        F.round("rate_ci_lower_per_100k", 4).alias("ci_lower"), F.round("rate_ci_upper_per_100k", 4).alias("ci_upper"),
        "period_status",
    )


_AGE_SEX = """
    den AS (SELECT g AS geography, age_group, sex, sum(population)::BIGINT AS population FROM state_agesex, (VALUES ('rj_total'), ('volta_redonda'), ('rest_of_rj_excluding_vr')) v(g)
      WHERE g = 'rj_total' OR (g = 'volta_redonda') = (code7 = '3300000') GROUP BY ALL),
    dc AS (SELECT geography, age_group, sex, outcome_id, sum(n)::BIGINT AS n FROM death_counts WHERE year = 2000 GROUP BY ALL),
    oc AS (SELECT DISTINCT outcome_id FROM dc WHERE geography <> 'brazil_total' AND geography <> 'rest_of_brazil_excluding_rj' AND age_group <> 'ignorado' AND sex <> 'ignorado'),
    ar AS (SELECT d.*, o.outcome_id, coalesce(c.n, 0) AS n, coalesce(c.n, 0) / d.population * 100000.0 AS rate FROM den d CROSS JOIN oc o
      LEFT JOIN dc c ON c.geography = d.geography AND c.age_group = d.age_group AND c.sex = d.sex AND c.outcome_id = o.outcome_id)"""


@query("st07_age_sex_specific_rates", f"""
    WITH {_AGE_SEX}
    SELECT r.geography, r.age_group, r.sex, r.outcome_id, r.n AS count, r.population, round(r.rate, 6) AS rate, CASE WHEN b.rate > 0 THEN round(a.rate / b.rate, 6) END AS ratio
    FROM ar r JOIN ar a ON a.geography = 'volta_redonda' AND a.age_group = r.age_group AND a.sex = r.sex AND a.outcome_id = r.outcome_id
    JOIN ar b ON b.geography = 'rest_of_rj_excluding_vr' AND b.age_group = r.age_group AND b.sex = r.sex AND b.outcome_id = r.outcome_id""")
def _(spark, folder):
    denominators = age_sex_denominators(state_age_sex(spark, folder), TERRITORY)
    rates = products.age_sex_rates(death_counts(spark, folder), denominators, STANDARD_YEAR)
    return rates.select(
        "geography", "age_group", "sex", "outcome_id", "count", "population", F.round("rate_per_100k", 6).alias("rate"),
        F.round("rate_ratio_vr_vs_rest", 6).alias("ratio"),
    )


@query("st08_municipal_specific_rates", f"""
    WITH RECURSIVE {interval_sql('profile')}
    SELECT code7, outcome_id, age_group, sex, n AS count, population, round(rate, 6) AS rate, round(lower / population * 100000.0, 3) AS ci_lower,
      round(upper / population * 100000.0, 3) AS ci_upper, status FROM profile_status JOIN lim ON k = n""")
def _(spark, folder):
    cells = products.municipal_profiles(
        deaths(spark, folder), state_age_sex(spark, folder), TERRITORY, PROFILE, STANDARD_YEAR
    )
    return cells.select(
        area_code(), "outcome_id", "age_group", "sex", "count", "population", F.round("rate_per_100k", 6).alias("rate"),
        F.round("rate_ci_lower_per_100k", 3).alias("ci_lower"), F.round("rate_ci_upper_per_100k", 3).alias("ci_upper"),
        F.col("suppression_status").alias("status"),
    )


@query("st09_municipal_map_rates", f"""
    WITH RECURSIVE {interval_sql('munimap')}
    SELECT m.year, m.code7, m.outcome_id, n AS count, m.population, round(rate, 6) AS rate, round(lower / population * 100000.0, 4) AS ci_lower,
      round(upper / population * 100000.0, 4) AS ci_upper, s.period_status FROM munimap m JOIN lim ON k = n JOIN death_status s USING (year, outcome_id)""")
def _(spark, folder):
    rates = products.municipal_map_rates(deaths(spark, folder), state_municipal_population(spark, folder), TERRITORY, SIM)
    return rates.select(
        "year", area_code(), "outcome_id", "count", "population", F.round("rate_per_100k", 6).alias("rate"),
        F.round("rate_ci_lower_per_100k", 4).alias("ci_lower"), F.round("rate_ci_upper_per_100k", 4).alias("ci_upper"), "period_status",
    )


@query("st09_municipal_admission_map", f"""
    WITH RECURSIVE ma AS (SELECT p.year, p.code7, a.outcome_id, a.n, p.population FROM statepop p JOIN
        (SELECT CAST(year(o_orderdate) AS INT) AS year, substr(code, 1, 6) AS code6, outcome_id, count(*) AS n FROM
          (SELECT o_orderdate, '33' || lpad(CAST(o_custkey % 25 AS STRING), 4, '0') AS code, o_orderpriority AS outcome_id FROM orders) GROUP BY ALL) a
        ON a.year = p.year AND a.code6 = substr(p.code7, 1, 6)), {interval_sql('ma')}
    SELECT year, code7, outcome_id, n AS count, population, round(n / population * 100000.0, 6) AS rate, round(lower / population * 100000.0, 4) AS ci_lower,
      round(upper / population * 100000.0, 4) AS ci_upper, 'source_year_observed' AS period_status FROM ma JOIN lim ON k = n""")
def _(spark, folder):
    counts = table(spark, folder, "orders").groupBy(
        F.year("o_orderdate").alias("year"),
        F.expr("'33' || lpad(CAST(o_custkey % 25 AS STRING), 4, '0')").alias("municipality_code_datasus"),
        F.col("o_orderpriority").alias("outcome_id"),
    ).agg(F.count(F.lit(1)).alias("count"))
    rates = products.municipal_admission_rates(counts, state_municipal_population(spark, folder))
    return rates.select(
        "year", area_code(), "outcome_id", "count", "population", F.round("rate_per_100k", 6).alias("rate"),
        F.round("rate_ci_lower_per_100k", 4).alias("ci_lower"), F.round("rate_ci_upper_per_100k", 4).alias("ci_upper"), "period_status",
    )


@query("st09_admission_map_manifest", """
    WITH m AS (SELECT p.year, p.code7, a.outcome_id, a.n FROM statepop p JOIN (SELECT CAST(year(o_orderdate) AS INT) AS year, '33' || lpad(CAST(o_custkey % 25 AS STRING), 4, '0') AS code6,
        o_orderpriority AS outcome_id, count(*) AS n FROM orders GROUP BY ALL) a ON a.year = p.year AND a.code6 = substr(p.code7, 1, 6)),
    t AS (SELECT year, outcome_id, n + CASE WHEN year % 2 = 1 AND outcome_id <> '5-LOW' THEN 3 ELSE 0 END AS n FROM (SELECT CAST(year(o_orderdate) AS INT) AS year, o_orderpriority AS outcome_id, count(*) AS n
      FROM orders WHERE o_custkey % 5 IN (0, 1) AND o_orderpriority <> '2-HIGH' GROUP BY ALL)),
    o AS (SELECT year, outcome_id, sum(n)::BIGINT AS n FROM m GROUP BY ALL),
    off AS (SELECT year, string_agg(outcome_id || ':' || coalesce(o.n, 0) || ':' || t.n, '|' ORDER BY outcome_id) AS gaps FROM t LEFT JOIN o USING (year, outcome_id) WHERE year IN (SELECT year FROM m) AND coalesce(o.n, 0) <> t.n GROUP BY 1)
    SELECT year, count(DISTINCT code7) AS municipalities, count(*) AS rows, count(*) FILTER (WHERE n < 5) AS suppressed_cells, coalesce(any_value(gaps), '') AS reconciliation,
      CASE WHEN any_value(gaps) IS NULL THEN 'reconciled_with_annual_series' ELSE 'reconciliation_failed' END AS status, CASE WHEN any_value(gaps) IS NULL THEN count(*) ELSE 0 END AS usable_rows
    FROM m LEFT JOIN off USING (year) GROUP BY year""")
def _(spark, folder):
    """Entries of yearly admission maps against an annual series revised in odd years, and the rows their status lets through."""
    orders = table(spark, folder, "orders").withColumns({"year": F.year("o_orderdate"), "outcome_id": F.col("o_orderpriority")})
    counts = orders.groupBy("year", F.expr("'33' || lpad(CAST(o_custkey % 25 AS STRING), 4, '0')").alias("municipality_code_datasus"), "outcome_id").agg(F.count(F.lit(1)).alias("count"))
    rates = products.municipal_admission_rates(counts, state_municipal_population(spark, folder))
    revised = F.when((F.col("year") % 2 == 1) & (F.col("outcome_id") != "5-LOW"), 3).otherwise(0)
    annual = orders.where("o_custkey % 5 IN (0, 1) AND o_orderpriority <> '2-HIGH'").groupBy("year", "outcome_id").agg(F.count(F.lit(1)).alias("count"))
    annual = annual.withColumns({"count": F.col("count") + revised, "geography": F.lit(STATE_TOTAL)})
    manifest = products.admission_map_manifest(rates, annual)
    usable = validated_rows(rates.withColumn("source", F.lit("SIH")), manifest, valid_status()).groupBy("year").agg(F.count(F.lit(1)).alias("usable_rows"))
    listed = F.transform("reconciliation", lambda r: F.concat_ws(":", r["outcome_id"], r["municipal_total"], r["annual_total"]))
    return manifest.join(usable, "year", "left").fillna(0, subset=["usable_rows"]).select(
        "year", "municipalities", "rows", "suppressed_cells", F.coalesce(F.array_join(listed, "|"), F.lit("")).alias("reconciliation"), "status", "usable_rows",
    )


@query("st10_neurological_rates", f"""
    WITH {NEUROLOGICAL_SQL},
      ap AS (SELECT year, code7 AS geography, population FROM statepop UNION ALL SELECT year, geography, population FROM pop),
      g AS (SELECT ap.*, 'alzheimer' AS outcome_id, coalesce(nu.alzheimer, 0) AS n FROM ap LEFT JOIN nu ON nu.year = ap.year AND nu.geography = ap.geography
        UNION ALL SELECT ap.*, 'dementias_all', coalesce(nu.dementias_all, 0) FROM ap LEFT JOIN nu ON nu.year = ap.year AND nu.geography = ap.geography)
    SELECT year, geography, outcome_id, n AS count, population, round(n / population * 100000.0, 6) AS rate, 'source_year_observed' AS period_status FROM g""")
def _(spark, folder):
    rates = products.neurological_rates(
        deaths(spark, folder), state_municipal_population(spark, folder), population(spark, folder), TERRITORY
    )
    return rates.select("year", "geography", "outcome_id", "count", "population", F.round("rate_per_100k", 6).alias("rate"), "period_status")


@query("st10_neurological_admission_rates", """
    WITH a AS (SELECT year, geography, CASE outcome_id WHEN 'asthma' THEN 'alzheimer' ELSE 'dementias_all' END AS outcome_id, sum(value)::BIGINT AS n FROM adm_monthly
      WHERE outcome_id IN ('asthma', 'copd') GROUP BY ALL)
    SELECT year, geography, outcome_id, n AS count, p.population, round(n / p.population * 100000.0, 6) AS rate FROM a JOIN pop p USING (year, geography)""")
def _(spark, folder):
    """Admission twin: aggregates rated against the same denominators."""
    names = F.when(F.col("outcome_id") == "asthma", F.lit("alzheimer")).otherwise(F.lit("dementias_all"))
    yearly = monthly_admissions(spark, folder).where(F.col("outcome_id").isin("asthma", "copd")).groupBy(
        "year", "geography", names.alias("outcome_id")
    ).agg(F.sum("value").alias("count"))
    people = population(spark, folder).select("year", "geography", "population")
    rated = add_rates(join_denominator(yearly, people, ["year", "geography"]).where("population IS NOT NULL"))
    return rated.select("year", "geography", "outcome_id", "count", "population", F.round("rate_per_100k", 6).alias("rate"))


_ADJUSTED = """
    adj AS (SELECT p.{area}, p.outcome_id, sum(s.weight * p.n / p.population * 100000.0) AS rate, sum(s.weight * s.weight * p.n / (CAST(p.population AS DOUBLE) * p.population) * 1e10) AS var,
        sum(p.n)::BIGINT AS n, sum(p.population)::BIGINT AS population FROM {source} p JOIN standard s USING (age_group, sex) GROUP BY ALL)"""


@query("st11_direct_standardized_rate", f"""
    WITH {_ADJUSTED.format(area='code7', source='profile')}
    SELECT code7, outcome_id, round(rate, 5) AS rate, round(greatest(0, rate - 1.959963984540054 * sqrt(var)), 5) AS ci_low, round(rate + 1.959963984540054 * sqrt(var), 5) AS ci_high,
      n AS count, population AS denominator FROM adj""")
def _(spark, folder):
    cells = profile_cells(spark, folder).select("municipality_code_ibge", "outcome_id", "age_group", "sex", "count", "population")
    rates = direct_standardized_rate(cells, population_age_sex(spark, folder), ["municipality_code_ibge", "outcome_id"])
    return rates.select(
        area_code(), "outcome_id", F.round("standardized_rate_per_100k", 5).alias("rate"),
        F.round("standardized_ci_low_per_100k", 5).alias("ci_low"), F.round("standardized_ci_high_per_100k", 5).alias("ci_high"),
        "count", "denominator",
    )


@query("st12_standardized_leave_one_out", f"""
    WITH rest AS (SELECT code7, outcome_id, age_group, sex, (sum(n) OVER w - n)::BIGINT AS n, (sum(population) OVER w - population)::BIGINT AS population FROM profile
      WINDOW w AS (PARTITION BY outcome_id, age_group, sex)), {_ADJUSTED.format(area='code7', source='rest')}
    SELECT code7, outcome_id, round(rate, 5) AS rate, n AS count, population AS denominator FROM adj""")
def _(spark, folder):
    rates = standardized_rest_of_state(
        profile_cells(spark, folder), population_age_sex(spark, folder), "municipality_code_ibge", ["outcome_id"]
    )
    return rates.select(area_code(), "outcome_id", F.round("standardized_rate_per_100k", 5).alias("rate"), "count", "denominator")


@query("st13_notification_rates", """
    WITH s AS (SELECT year, geography, outcome_id, sum(n)::BIGINT AS n, coalesce(sum(n) FILTER (WHERE outcome_status IN ('óbito por SRAG', 'óbito por outra causa')), 0)::BIGINT AS d FROM notif_counts GROUP BY ALL)
    SELECT year, geography, outcome_id, n AS notification_count, d AS death_any_count, p.population, round(n / p.population * 100000.0, 6) AS rate, round(CAST(d AS DOUBLE) / n * 100, 6) AS death_pct
    FROM s LEFT JOIN pop p USING (year, geography)""")
def _(spark, folder):
    summary = products.notification_summary(notification_totals(spark, folder), population(spark, folder))
    return summary.select(
        "year", "geography", "outcome_id", "notification_count", "death_any_count", "population",
        F.round("notification_rate_per_100k", 6).alias("rate"), F.round("death_any_pct", 6).alias("death_pct"),
    )


@query("st14_monthly_notification_rate", """
    WITH m AS (SELECT CAST(date_trunc('month', onset) AS DATE) AS period, g AS geography, outcome_id, count(*) AS n, count(*) FILTER (WHERE outcome_code IN ('2', '3')) AS d
        FROM notif_dim x JOIN notif_outcomes o ON o.class_code IS NULL OR o.class_code = x.class_code, (VALUES ('rj_total'), ('volta_redonda'), ('rest_of_rj_excluding_vr')) v(g)
        WHERE starts_with(code6, '33') AND (g = 'rj_total' OR g = geography) AND onset >= DATE '1996-01-01' GROUP BY ALL),
      g AS (SELECT CAST(t AS DATE) AS period, a.geography, o.outcome_id FROM generate_series(TIMESTAMP '1996-01-01', (SELECT date_trunc('month', max(onset)) FROM notif), INTERVAL 1 MONTH) s(t)
        CROSS JOIN areas3 a CROSS JOIN notif_outcomes o)
    SELECT g.period, g.geography, g.outcome_id, coalesce(n, 0) AS notification_count, coalesce(d, 0) AS death_any_count,
      CASE WHEN p.population IS NOT NULL THEN round(coalesce(n, 0) / (p.population / 12.0) * 100000.0, 6) END AS rate,
      CASE WHEN n > 0 THEN round(CAST(d AS DOUBLE) / n * 100, 6) END AS death_pct, 'surveillance_versioned' AS period_status
    FROM g LEFT JOIN m USING (period, geography, outcome_id) LEFT JOIN pop p ON p.year = year(g.period) AND p.geography = g.geography""")
def _(spark, folder):
    events = notifications(spark, folder)
    end = observed_end_month(events, "symptom_onset_date", "2025-12-01")
    monthly = products.monthly_notifications(events, population(spark, folder), TERRITORY, "1996-01-01", end)
    return monthly.select(
        "period", "geography", "outcome_id", "notification_count", "death_any_count",
        F.round("notification_rate_per_100k", 6).alias("rate"), F.round("death_any_pct", 6).alias("death_pct"), "period_status",
    )


@query("st15_registry_rates", """
    WITH c AS (SELECT year, count(*) AS br, count(*) FILTER (WHERE code6 = '330000') AS vr, count(*) FILTER (WHERE starts_with(code6, '33')) AS rj FROM notif GROUP BY 1),
      l AS (SELECT year, 'brazil_total' AS geography, br AS cases FROM c UNION ALL SELECT year, 'volta_redonda', vr FROM c UNION ALL SELECT year, 'rest_of_rj_excluding_vr', rj - vr FROM c),
      r AS (SELECT l.*, p.population, cases / p.population * 100000.0 AS rate FROM l LEFT JOIN pop p USING (year, geography))
    SELECT r.year, r.geography, r.cases, r.population, round(r.rate, 6) AS rate, round(a.rate / b.rate, 6) AS vs_rest, round(a.rate / t.rate, 6) AS vs_country, 'source_year_observed' AS period_status
    FROM r JOIN r a ON a.year = r.year AND a.geography = 'volta_redonda' JOIN r b ON b.year = r.year AND b.geography = 'rest_of_rj_excluding_vr'
    JOIN r t ON t.year = r.year AND t.geography = 'brazil_total'""")
def _(spark, folder):
    events = notifications(spark, folder)
    code = F.col("municipality_code_datasus")

    def yearly(rows):
        return rows.groupBy(year_of()).agg(F.count(F.lit(1)).alias("cases"))

    series = {
        COUNTRY_TOTAL: yearly(events), SELECTED: yearly(events.where(code == TERRITORY.selected_code6)),
        STATE_TOTAL: yearly(events.where(code.startswith("33"))),
    }
    rates = products.registry_rates(series, population(spark, folder))
    return rates.select(
        "year", "geography", "cases", "population", F.round("registration_rate_per_100k", 6).alias("rate"),
        F.round("registration_rate_ratio_vr_vs_rest", 6).alias("vs_rest"),
        F.round("registration_rate_ratio_vr_vs_brazil", 6).alias("vs_country"), "period_status",
    )


def _interrupted(spark, folder):
    return products.interruption_input(
        admission_windows(spark, folder), population(spark, folder), list(ADMISSION_OUTCOMES.values()),
        [SELECTED, REST_OF_STATE], "1999-03-01", 1995,
    )


_ITS_ROWS = """
    s AS (SELECT a.outcome_id, a.geography, a.year, a.month, a.value AS y, p.population / 12.0 AS people, (a.year - 1995) * 12 + a.month - 1 AS t
      FROM adm a JOIN pop p USING (year, geography) WHERE a.year IN (SELECT year FROM adm_years) AND a.geography IN ('volta_redonda', 'rest_of_rj_excluding_vr')),
    fits AS (SELECT outcome_id, geography FROM s GROUP BY ALL HAVING count(*) >= 24 AND sum(y) >= 5)"""


@query("st16_interrupted_time_series", f"""
    WITH {_ITS_ROWS}, m AS (
      SELECT outcome_id, geography, 'month_' || CAST(month AS STRING) AS moment, sum(y) AS v FROM s GROUP BY ALL
      UNION ALL SELECT outcome_id, geography, 'time_index', sum(y * t) FROM s GROUP BY ALL
      UNION ALL SELECT outcome_id, geography, 'pandemic_step', coalesce(sum(y) FILTER (WHERE t >= 50), 0) FROM s GROUP BY ALL
      UNION ALL SELECT outcome_id, geography, 'post_pandemic_time', sum(y * greatest(t - 50, 0)) FROM s GROUP BY ALL)
    SELECT outcome_id, geography, moment, round(CAST(v AS DOUBLE), 2) AS fitted FROM m JOIN fits USING (outcome_id, geography)""")
def _(spark, folder):
    """A Poisson fit solves its score equations: the fitted sums are the observed ones."""
    return rounded(fitted_moments(_interrupted(spark, folder)), 2, "fitted")


@query("st16_model_eligibility", """
    WITH m AS (SELECT outcome_id, geography, count(*) AS n_obs, sum(value)::BIGINT AS total_events FROM adm WHERE year IN (SELECT year FROM adm_years)
      AND geography IN ('volta_redonda', 'rest_of_rj_excluding_vr') GROUP BY ALL)
    SELECT *, upper(outcome_id) AS outcome_label, CASE WHEN n_obs < 24 OR total_events < 5 THEN 'suppressed_insufficient_events' ELSE 'fitted_descriptive_its' END AS model_status,
      CASE WHEN n_obs >= 24 AND total_events >= 5 THEN true END AS converged FROM m""")
def _(spark, folder):
    fitted = fit_interrupted_series(_interrupted(spark, folder))
    return fitted.select("outcome_id", "outcome_label", "geography", "n_obs", "total_events", "model_status", "converged")


@query("st17_linear_combination_rr", f"""
    WITH {_ITS_ROWS}, g AS (SELECT *, t >= 50 AS post, sum(y) OVER k AS events, sum(people) OVER k AS persons, row_number() OVER (PARTITION BY outcome_id, geography ORDER BY t) AS i,
        count(*) OVER (PARTITION BY outcome_id, geography) AS n FROM s WINDOW k AS (PARTITION BY outcome_id, geography, t >= 50)),
      u AS (SELECT *, CASE WHEN post THEN 1 ELSE -1 END * (y - people * events / persons) / nullif(events, 0) AS u FROM g),
      v AS (SELECT a.outcome_id, a.geography, sum(CASE WHEN a.i = b.i THEN 1 ELSE 2 * (1 - (a.i - b.i) / 13.0) END * a.u * b.u) AS variance
        FROM u a JOIN u b ON a.outcome_id = b.outcome_id AND a.geography = b.geography AND a.i - b.i BETWEEN 0 AND 12 GROUP BY ALL),
      r AS (SELECT outcome_id, geography, max(n) AS n, coalesce(max(events) FILTER (WHERE post), 0) AS e1, coalesce(max(events) FILTER (WHERE NOT post), 0) AS e0,
        max(persons) FILTER (WHERE post) AS p1, max(persons) FILTER (WHERE NOT post) AS p0 FROM g GROUP BY ALL),
      l AS (SELECT outcome_id, geography, ln((e1 / p1) / (e0 / p0)) AS b, sqrt(variance) AS se FROM r JOIN v USING (outcome_id, geography) WHERE n >= 24 AND e0 > 0 AND e1 > 0)
    SELECT outcome_id, geography, l.b IS NOT NULL AS estimated, round(exp(b), 5) AS rr, round(exp(b - 1.959963984540054 * se), 5) AS ci_lower, round(exp(b + 1.959963984540054 * se), 5) AS ci_upper
    FROM r LEFT JOIN l USING (outcome_id, geography)""")
def _(spark, folder):
    """The intercept-and-step design, whose estimate and Bartlett-weighted variance have a closed form."""
    fitted = fit_level_change(_interrupted(spark, folder))
    names = {"rr": "immediate_level_rr", "ci_lower": "immediate_level_rr_ci_lower", "ci_upper": "immediate_level_rr_ci_upper"}
    return fitted.select(
        "outcome_id", "geography", F.col("immediate_level_rr").isNotNull().alias("estimated"), *[F.round(c, 5).alias(n) for n, c in names.items()],
    )


@query("st18_percent_change", """
    SELECT code7, outcome_id, year, round(CASE WHEN prev > 0 THEN (rate / prev - 1) * 100 WHEN prev IS NOT NULL THEN 0 END, 6) AS change FROM
      (SELECT *, lag(rate) OVER (PARTITION BY code7, outcome_id ORDER BY year) AS prev FROM munimap)""")
def _(spark, folder):
    window = Window.partitionBy("municipality_code_ibge", "outcome_id").orderBy("year")
    change = percent_change(F.col("rate_per_100k"), F.lag("rate_per_100k").over(window))
    return map_rates(spark, folder).select(area_code(), "outcome_id", "year", F.round(change, 6).alias("change"))


@query("st19_ratio_guarded", "SELECT code7, outcome_id, year, CASE WHEN rest > 0 THEN round(value / rest, 6) END AS ratio FROM cityseries")
def _(spark, folder):
    ratio = ratio_guarded("value", "rest_rate_per_100k")
    return city_series(spark, folder).select(area_code(), "outcome_id", "year", F.round(ratio, 6).alias("ratio"))


@query("pv01_primary_suppression", """
    SELECT year, geography, outcome_id, CASE WHEN n >= 5 THEN n END AS count, CASE WHEN n >= 5 THEN round(rate, 6) END AS value, population AS denominator, n < 5 AS suppressed,
      CASE WHEN n < 5 THEN 'small_cell_lt_5' END AS reason, CASE WHEN n < 5 THEN 'suppressed' ELSE 'published' END AS status FROM mort""")
def _(spark, folder):
    public = observations(death_rates(spark, folder), "SIM", "population", "manifest.json")
    return public.select(
        F.col("period").cast("int").alias("year"), F.col("geographyId").alias("geography"), F.col("outcomeId").alias("outcome_id"),
        "count", F.round("value", 6).alias("value"), "denominator", "suppressed", F.col("suppressionReason").alias("reason"),
        F.col("suppressionStatus").alias("status"),
    )


@query("pv02_profile_suppression", """
    SELECT code7, outcome_id, age_group, sex, CASE WHEN status = 'published' THEN n END AS count, CASE WHEN status <> 'not_applicable' THEN population END AS population,
      CASE WHEN status = 'suppressed_complementary' THEN 'suppressed' ELSE status END AS status FROM profile_status""")
def _(spark, folder):
    public = protect_profile(profile_cells(spark, folder), ["count", "rate_per_100k"])
    return public.select(area_code(), "outcome_id", "age_group", "sex", "count", "population", F.col("suppression_status").alias("status"))


@query("pv03_applicability", """
    SELECT outcome_id, sex, CASE WHEN (outcome_id = 'cervix' AND sex = 'masculino') OR (outcome_id = 'prostate' AND sex = 'feminino') THEN 'not_applicable' ELSE 'published' END AS status,
      sum(n)::BIGINT AS deaths FROM profile GROUP BY ALL""")
def _(spark, folder):
    totals = profile_cells(spark, folder).groupBy("outcome_id", "sex").agg(F.sum("count").alias("deaths"))
    marked = mark_not_applicable(totals.withColumn("suppression_status", F.lit("published")))
    return marked.withColumnRenamed("suppression_status", "status")


@query("pv04_display_suppression", """
    SELECT year, geography, outcome_id, CASE WHEN n < 5 THEN '<5' ELSE CAST(n AS STRING) END AS count_text, CASE WHEN n < 5 THEN '<5' ELSE printf('%.2f', round(rate, 2)) END AS rate_text FROM mort""")
def _(spark, folder):
    shown = F.format_string("%.2f", F.round("rate_per_100k", 2))
    return death_rates(spark, folder).select(
        "year", "geography", "outcome_id", display_text("count").alias("count_text"), display_text("count", shown).alias("rate_text")
    )


@query("pv05_leak_audit", """
    SELECT 'tampered' AS package, 'sim-' || replace(outcome_id, '_', '-') AS indicator, code7, year, CASE WHEN year % 2 = 0 THEN 'value|count' ELSE 'unsuppressed_small_cell' END AS leaked
    FROM munimap WHERE n < 5""")
def _(spark, folder):
    """A sound package has no leaks; one that shows even years' cells and forgets odd years' flags has them all."""
    public = observations(map_rates(spark, folder), "SIM", "population", "m.json", "municipality_code_ibge")
    raw = map_rates(spark, folder).select(
        indicator_id(F.lit("SIM"), "outcome_id").alias("indicatorId"), F.col("municipality_code_ibge").alias("geographyId"),
        F.col("year").cast("string").alias("period"), F.col("rate_per_100k").alias("value"), "count",
        F.lit(None).cast("double").alias("ciLow"), F.lit(None).cast("double").alias("ciHigh"),
        ((F.col("count") < 5) & (F.col("year") % 2 == 0)).alias("suppressed"),
    )
    sound = protected_leaks(public, F.col("suppressed"), PROTECTED_FIELDS).withColumn("package", F.lit("sound"))
    tampered = protected_leaks(raw, F.col("suppressed"), PROTECTED_FIELDS).withColumn("package", F.lit("tampered"))
    fields = ["package", "indicatorId", "geographyId", "period", "leaked_fields"]
    both = sound.select(*fields).unionByName(tampered.select(*fields))
    return both.select(
        "package", F.col("indicatorId").alias("indicator"), F.col("geographyId").alias("code7"),
        F.col("period").cast("int").alias("year"), F.array_join("leaked_fields", "|").alias("leaked"),
    )


@query("pv05_profile_leak_audit", """
    SELECT outcome_id, count(*) AS cells, count(*) FILTER (WHERE starts_with(status, 'suppressed') AND age_group = '15-24') AS leaks FROM profile_status GROUP BY 1""")
def _(spark, folder):
    """Hidden cells of one age group get their counts back: each is a leak, no other cell is."""
    sound = profiles(profile_cells(spark, folder), STANDARD_YEAR, "m.json")
    shown = (F.col("suppressionStatus") == "suppressed") & (F.col("ageGroup") == "15-24")
    public = sound.withColumn("count", F.when(shown, F.lit(1).cast("long")).otherwise(F.col("count")))
    protected = F.col("suppressionStatus") == "suppressed"
    leaks = protected_leaks(public, protected, PROTECTED_PROFILE_FIELDS).groupBy("indicatorId").agg(F.count(F.lit(1)).alias("leaks"))
    outcome = F.translate(F.replace("indicatorId", F.lit("sim-"), F.lit("")), "-", "_")
    cells = public.groupBy("indicatorId").agg(F.count(F.lit(1)).alias("cells"))
    return cells.join(leaks, "indicatorId", "left").fillna(0).select(outcome.alias("outcome_id"), "cells", "leaks")
