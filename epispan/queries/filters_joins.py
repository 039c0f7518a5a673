"""Filters (F01-F09) and joins (J01-J12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import AGE_GROUPS, COUNTRY_TOTAL, REST_OF_COUNTRY, REST_OF_STATE, SELECTED, SEXES, STATE_TOTAL
from ..functions.dates import in_observation_window
from ..functions.territory import classify_geography, eligible_residence, in_state
from ..functions.text import code7_to_code6, without_accents
from ..operators import joins
from ..operators.classify import cause_map, classified_counts, classified_events
from ..operators.filters import find_by_name, search_text
from ..operators.rollup import complete_years
from ..plans.publish import filtered_download, observations
from ..plans.products import AREAS, deduplicated_admissions, municipal_profile_counts
from ..session import table
from .registry import query
from .standins import (
    PROFILE, SIM, STANDARD_YEAR, TERRITORY, admission_windows, death_counts, death_rates, deaths, map_rates,
    municipal_population, notifications, population, profile_cells, state_age_sex,
)


def tally(df, *columns):
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def year_of(name: str = "source_year"):
    return F.col(name).cast("int").alias("year")


@query("f01_eligible_residence", """
    SELECT 'SIM' AS source, year, geography, count(*) AS n FROM death_dim WHERE geography <> 'outside_brazil' GROUP BY ALL
    UNION ALL SELECT 'SIVEP-SRAG', year, geography, count(*) FROM notif_dim
      WHERE geography IN ('volta_redonda', 'rest_of_rj_excluding_vr') GROUP BY ALL""")
def _(spark, folder):
    def part(read, source):
        label = classify_geography("municipality_code_datasus", TERRITORY)
        placed = read(spark, folder).select(year_of(), label.alias("geography"))
        return tally(placed.where(eligible_residence("geography", source)), F.lit(source).alias("source"), "year", "geography")

    return part(deaths, "SIM").unionByName(part(notifications, "SIVEP-SRAG"))


@query("f02_state_municipalities", "SELECT year, code7, population FROM munipop WHERE regexp_full_match(code7, '33[0-9]{5}')")
def _(spark, folder):
    code = F.col("municipality_code_ibge")
    return municipal_population(spark, folder).where(in_state(code, TERRITORY, 7)).select("year", code.alias("code7"), "population")


@query("f03_observation_window", """
    SELECT CAST(date_trunc('month', onset) AS DATE) AS month, count(*) AS n FROM notif
    WHERE onset >= DATE '1996-03-01' AND onset <= DATE '2000-11-30' GROUP BY 1""")
def _(spark, folder):
    first, last = F.lit("1996-03-01").cast("date"), F.lit("2000-11-01").cast("date")
    inside = notifications(spark, folder).where(in_observation_window("symptom_onset_date", first, last))
    return tally(inside, F.trunc("symptom_onset_date", "month").alias("month"))


@query("f04_complete_years_only", """
    SELECT year, geography, outcome_id, sum(value)::BIGINT AS count FROM adm WHERE year IN (SELECT year FROM adm_years) GROUP BY ALL""")
def _(spark, folder):
    monthly = deduplicated_admissions(admission_windows(spark, folder))
    full = complete_years(monthly, population(spark, folder))
    return full.groupBy("year", "geography", "outcome_id").agg(F.sum("value").alias("count"))


@query("f05_known_dimensions", """
    SELECT outcome_id, sum(n)::BIGINT AS count, sum(CASE WHEN age_group = 'ignorado' OR sex = 'ignorado' THEN n ELSE 0 END)::BIGINT AS dropped
    FROM profile_base GROUP BY 1""")
def _(spark, folder):
    counts = municipal_profile_counts(deaths(spark, folder), state_age_sex(spark, folder), TERRITORY, PROFILE, STANDARD_YEAR)
    known = F.col("age_group").isin(AGE_GROUPS) & F.col("sex").isin(SEXES)
    return counts.groupBy("outcome_id").agg(
        F.sum("count").alias("count"), F.coalesce(F.sum(F.when(~known, F.col("count"))), F.lit(0)).alias("dropped")
    )


@query("f06_outcome_subset", """
    SELECT year, geography, outcome_id, age_group, sex, n AS count FROM death_counts
    WHERE year = 2000 AND outcome_id IN ('resp_all', 'lung') AND geography IN ('volta_redonda', 'rj_total') AND age_group <> 'ignorado' AND sex <> 'ignorado'""")
def _(spark, folder):
    chosen = (
        (F.col("source_year") == 2000) & F.col("outcome_id").isin("resp_all", "lung")
        & F.col("geography").isin(SELECTED, STATE_TOTAL) & F.col("age_group").isin(AGE_GROUPS) & F.col("sex").isin(SEXES)
    )
    return death_counts(spark, folder).where(chosen).select(year_of(), "geography", "outcome_id", "age_group", "sex", "count")


@query("f07_public_series_filter", """
    SELECT 'sim-' || replace(outcome_id, '_', '-') AS indicator, geography, CAST(year AS STRING) AS period,
      CASE WHEN n >= 5 THEN round(rate, 6) END AS selected_value FROM mort
    WHERE geography IN ('volta_redonda', 'brazil_total') AND year BETWEEN 1996 AND 2000""")
def _(spark, folder):
    series = observations(death_rates(spark, folder), "SIM", "population", "manifest.json")
    chosen = filtered_download(series, [SELECTED, COUNTRY_TOTAL], 1996, 2000)
    return chosen.select(
        F.col("indicatorId").alias("indicator"), F.col("geographyId").alias("geography"), "period",
        F.round("selectedValue", 6).alias("selected_value"),
    )


@query("f08_text_search", """
    SELECT doc_id, contains(lower(strip_accents(text)), 'reaux') AS match_long, lang FROM documents
    WHERE contains(lower(strip_accents(concat_ws(' ', text, lang, source))), 'reaux')""")
def _(spark, folder):
    hits = search_text(table(spark, folder, "documents"), ["text", "lang", "source"], "RÉAUX")
    return hits.select("doc_id", F.contains(F.lower(without_accents("text")), F.lit("reaux")).alias("match_long"), "lang")


@query("f08_text_search_top", """
    SELECT doc_id, lang FROM documents WHERE contains(lower(strip_accents(concat_ws(' ', text, lang, source))), 'reaux')
    ORDER BY doc_id LIMIT 6""")
def _(spark, folder):
    """The finder's short list: the first six matches in catalogue order."""
    hits = search_text(table(spark, folder, "documents"), ["text", "lang", "source"], "réaux")
    return hits.orderBy("doc_id").limit(6).select("doc_id", "lang")


@query("f08_search_decomposed", """
    SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'e')""")
def _(spark, folder):
    """Letters written with combining accents, or precomposed ones, are found alike."""
    spelled = F.when(F.col("p_partkey") % 2 == 0, F.replace("p_name", F.lit("e"), F.lit("e\u0301"))).otherwise(F.replace("p_name", F.lit("e"), F.lit("\u00c9")))
    hits = search_text(table(spark, folder, "part").withColumn("spelled", spelled), ["spelled"], "\u00e8")
    return hits.select("p_partkey", "p_name")


@query("f09_name_lookup_table", """
    WITH g AS (SELECT p_partkey, lower(p_name) AS nm FROM part), q AS (SELECT DISTINCT lower(substr(s_name, 1 + CAST(s_suppkey % 3 AS INT), 2 + CAST(s_suppkey % 9 AS INT))) AS q FROM supplier
      UNION SELECT lower(substr(p_name, 1, 1 + CAST(p_partkey % 12 AS INT))) FROM part WHERE p_partkey % 3 = 0)
    SELECT q AS query, p_partkey FROM (SELECT q, p_partkey, row_number() OVER (PARTITION BY q ORDER BY CASE WHEN nm = q THEN 0 WHEN starts_with(nm, q) THEN 1 ELSE 2 END, p_partkey) AS pos
      FROM q JOIN g ON contains(nm, q) WHERE trim(q) = q AND q <> '') WHERE pos = 1""")
def _(spark, folder):
    """Queries as a table: pieces of part and supplier names of many lengths."""
    piece = F.lower(F.expr("substr(s_name, 1 + CAST(s_suppkey % 3 AS INT), 2 + CAST(s_suppkey % 9 AS INT))"))
    other = F.lower(F.expr("substr(p_name, 1, 1 + CAST(p_partkey % 12 AS INT))"))
    queries = table(spark, folder, "supplier").select(piece.alias("query")).unionAll(table(spark, folder, "part").where("p_partkey % 3 = 0").select(other.alias("query")))
    found = find_by_name(table(spark, folder, "part").select("p_partkey", "p_name"), "p_name", "p_partkey", queries.where("trim(query) = query"))
    return found.select("query", "p_partkey")


@query("f09_name_lookup", """
    SELECT q AS query, code7 FROM (SELECT q, code7, row_number() OVER (PARTITION BY q ORDER BY
        CASE WHEN nm = lq THEN 0 WHEN starts_with(nm, lq) THEN 1 ELSE 2 END, code7) AS pos FROM
      (SELECT DISTINCT code7, lower(municipality_name) AS nm FROM munipop),
      (SELECT q, lower(q) AS lq FROM (VALUES ('Nation_1'), ('TION_20'), ('nation_5 (rj)'), ('Nação')) v(q)) WHERE contains(nm, lq)) WHERE pos = 1""")
def _(spark, folder):
    names = municipal_population(spark, folder).select("municipality_code_ibge", "municipality_name").distinct()
    found = find_by_name(names, "municipality_name", "municipality_code_ibge", ["Nation_1", "TION_20", "nation_5 (rj)", "Nação"])
    return found.select("query", F.col("municipality_code_ibge").alias("code7"))


@query("j01_join_denominator", """
    SELECT d.year, d.geography, d.outcome_id, d.n AS count, p.population FROM death_year d LEFT JOIN pop p USING (year, geography)""")
def _(spark, folder):
    counts = death_counts(spark, folder).groupBy(year_of(), "geography", "outcome_id").agg(F.sum("count").alias("count"))
    people = population(spark, folder).select("year", "geography", "population")
    return joins.join_denominator(counts, people, ["year", "geography"])


@query("j02_join_one_to_one", """
    SELECT year, geography, outcome_id, sum(n)::BIGINT AS count, coalesce(sum(n) FILTER (WHERE sex = 'feminino'), 0)::BIGINT AS women
    FROM death_counts GROUP BY ALL""")
def _(spark, folder):
    keys = ["year", "geography", "outcome_id"]
    counts = death_counts(spark, folder).withColumn("year", F.col("source_year").cast("int"))
    totals = counts.groupBy(*keys).agg(F.sum("count").alias("count"))
    women = counts.where("sex = 'feminino'").groupBy(*keys).agg(F.sum("count").alias("women"))
    return joins.join_one_to_one(totals, women, keys).fillna(0, subset=["women"])


@query("j03_cross_grid", """
    SELECT y.year, y.outcome_id, a.geography, coalesce(d.n, 0) AS count FROM (SELECT DISTINCT year, outcome_id FROM death_year) y
    CROSS JOIN areas4 a LEFT JOIN death_year d ON d.year = y.year AND d.outcome_id = y.outcome_id AND d.geography = a.geography""")
def _(spark, folder):
    keys = ["year", "outcome_id", "geography"]
    counts = death_counts(spark, folder).groupBy(year_of(), "outcome_id", "geography").agg(F.sum("count").alias("count"))
    grid = joins.dense_grid(counts.select("year", "outcome_id").distinct(), geography=AREAS)
    return joins.fill_grid(grid, counts, keys, ["count"])


@query("j04_classify_theta_join", "SELECT cause, outcome_id FROM causes")
def _(spark, folder):
    return cause_map(deaths(spark, folder), "underlying_cause", SIM)


@query("j05_classified_equi_join", """
    SELECT code6 AS code, outcome_id, year, count(*) AS n FROM death JOIN causes USING (cause) GROUP BY ALL""")
def _(spark, folder):
    facts = deaths(spark, folder)
    classified = classified_events(facts, "underlying_cause", SIM)
    return tally(classified, F.col("municipality_code_datasus").alias("code"), "outcome_id", year_of())


@query("j06_municipality_with_fallback", """
    SELECT d.year, coalesce(p.code7, 'rest_of_brazil_excluding_rj') AS geography, count(*) AS n FROM death d
      LEFT JOIN statepop p ON p.year = d.year AND substr(p.code7, 1, 6) = d.code6
      WHERE p.code7 IS NOT NULL OR regexp_full_match(d.code6, '[0-9]{6}') GROUP BY ALL""")
def _(spark, folder):
    codes = municipal_population(spark, folder).where(F.col("municipality_code_ibge").startswith("33")).select(
        "year", "municipality_code_ibge", code7_to_code6("municipality_code_ibge").alias("code")
    )
    events = tally(deaths(spark, folder), year_of(), F.col("municipality_code_datasus").alias("code"))
    placed = joins.municipality_with_fallback(events, codes, "code", "year", REST_OF_COUNTRY)
    return placed.groupBy("year", "geography").agg(F.sum("n").alias("n"))


@query("j07_full_outer_series", """
    SELECT coalesce(a.year, b.year, c.year) AS year, a.n AS cases_deaths, b.n AS cases_notifications, c.n AS cases_population FROM
      (SELECT year, count(*) AS n FROM death GROUP BY 1) a FULL JOIN (SELECT year, count(*) AS n FROM notif WHERE year > 1996 GROUP BY 1) b ON a.year = b.year
      FULL JOIN (SELECT year, count(*) AS n FROM munipop GROUP BY 1) c ON c.year = coalesce(a.year, b.year)""")
def _(spark, folder):
    def cases(df, year):
        return df.groupBy(year).agg(F.count(F.lit(1)).alias("cases"))

    late = notifications(spark, folder).where("source_year > 1996")
    return joins.full_outer_series({
        "deaths": cases(deaths(spark, folder), year_of()),
        "notifications": cases(late, year_of()),
        "population": cases(municipal_population(spark, folder), "year"),
    }, "year", "cases")


@query("j08_comparator_wide_self_join", """
    SELECT m.year, m.outcome_id, m.geography, m.n AS count, w.* EXCLUDE (year, outcome_id) FROM mort m JOIN (
      SELECT year, outcome_id, max(n) FILTER (WHERE geography = 'volta_redonda') AS count_volta_redonda,
        max(n) FILTER (WHERE geography = 'rest_of_rj_excluding_vr') AS count_rest_of_rj_excluding_vr,
        round(max(rate) FILTER (WHERE geography = 'volta_redonda'), 6) AS rate_volta_redonda,
        round(max(rate) FILTER (WHERE geography = 'rest_of_rj_excluding_vr'), 6) AS rate_rest_of_rj_excluding_vr
      FROM mort GROUP BY ALL) w ON w.year = m.year AND w.outcome_id = m.outcome_id""")
def _(spark, folder):
    base = death_rates(spark, folder).select("year", "outcome_id", "geography", "count", F.col("rate_per_100k").alias("rate"))
    wide = joins.wide_comparators(base, ["year", "outcome_id"], [SELECTED, REST_OF_STATE], ["count", "rate"])
    return wide.drop("rate").withColumns({f"rate_{g}": F.round(f"rate_{g}", 6) for g in (SELECTED, REST_OF_STATE)})


@query("j09_semi_anti_membership", """
    SELECT outcome_id, code6 IN (SELECT substr(code7, 1, 6) FROM statepop) AS known, count(*) AS n FROM death JOIN causes USING (cause)
    WHERE regexp_full_match(code6, '33[0-9]{4}') GROUP BY ALL""")
def _(spark, folder):
    state = deaths(spark, folder).where(in_state("municipality_code_datasus", TERRITORY))
    counts = classified_counts(state, "underlying_cause", SIM, ["municipality_code_datasus"])
    valid = municipal_population(spark, folder).select(code7_to_code6("municipality_code_ibge").alias("municipality_code_datasus"))
    kept = joins.known_members(counts, valid, "municipality_code_datasus").groupBy("outcome_id").agg(F.sum("count").alias("n"))
    left_out = joins.unknown_member_tally(counts, valid, "municipality_code_datasus", ["outcome_id"], "count")
    return kept.withColumn("known", F.lit(True)).unionByName(
        left_out.withColumnRenamed("count", "n").withColumn("known", F.lit(False))
    )


@query("j11_reference_period_lookup", """
    SELECT m.year, m.code7, m.outcome_id, round(s.rate, 6) AS state_rate, round(b.rate, 6) AS country_rate FROM munimap m
    LEFT JOIN mort s ON s.year = m.year AND s.outcome_id = m.outcome_id AND s.geography = 'rj_total'
    LEFT JOIN mort b ON b.year = m.year AND b.outcome_id = m.outcome_id AND b.geography = 'brazil_total'""")
def _(spark, folder):
    rows = map_rates(spark, folder).select("year", F.col("municipality_code_ibge").alias("code7"), "outcome_id")
    joined = joins.reference_values(
        rows, death_rates(spark, folder), ["year", "outcome_id"],
        {"state_rate": STATE_TOTAL, "country_rate": COUNTRY_TOTAL}, "rate_per_100k",
    )
    return joined.withColumns({c: F.round(c, 6) for c in ("state_rate", "country_rate")})


@query("j12_state_city_cell_join", """
    SELECT p.code7, p.outcome_id, p.age_group, p.sex, s.n - p.n AS rest_count, s.population - p.population AS rest_population FROM profile p JOIN
      (SELECT outcome_id, age_group, sex, sum(n)::BIGINT AS n, sum(population)::BIGINT AS population FROM profile GROUP BY ALL) s USING (outcome_id, age_group, sex)""")
def _(spark, folder):
    rest = joins.rest_of_state_cells(profile_cells(spark, folder), ["outcome_id", "age_group", "sex"], ["count", "population"])
    return rest.select(
        F.col("municipality_code_ibge").alias("code7"), "outcome_id", "age_group", "sex", "rest_count", "rest_population"
    )
