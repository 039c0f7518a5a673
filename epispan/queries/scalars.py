"""Projections and scalar functions (P01-P38)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import BREAKS, PERIODS
from ..functions import dates, demographics, labels, periods, text
from ..functions.icd import icd_match
from ..functions.territory import (
    classify_geography, classify_state_geography, residence_code_valid,
)
from ..operators.series import min_max_intensity, month_spine
from ..plans.publish import number_arcs, polygon_rings
from ..session import table
from ..sources.tables import label_component
from .registry import query
from .standins import (
    TERRITORY, death_counts, deaths, map_rates, municipal_population, notifications, raw_deaths,
)


def tally(df, *columns):
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


@query("p01_normalize_code", """
    SELECT CAUSABAS AS raw, trim(replace(upper(coalesce(CAUSABAS, '')), '.', '')) AS code, count(*) AS n
    FROM raw_d GROUP BY ALL""")
def _(spark, folder):
    return tally(raw_deaths(spark, folder), F.col("CAUSABAS").alias("raw"), text.normalize_code("CAUSABAS").alias("code"))


@query("p02_clean_text", """
    SELECT CODMUNRES AS raw, regexp_replace(trim(coalesce(CODMUNRES, '')), '\\.0$', '') AS clean, '' AS absent, count(*) AS n
    FROM raw_d GROUP BY ALL""")
def _(spark, folder):
    raw = raw_deaths(spark, folder)
    absent = text.optional_text(raw.columns, "TIPOBITO")
    return tally(raw, F.col("CODMUNRES").alias("raw"), text.clean_text("CODMUNRES").alias("clean"), absent.alias("absent"))


@query("p03_parse_compact_date", """
    SELECT DTOBITO AS raw, CAST(try_strptime(DTOBITO, '%d%m%Y') AS DATE) AS day, count(*) AS n FROM raw_d GROUP BY ALL""")
def _(spark, folder):
    return tally(raw_deaths(spark, folder), F.col("DTOBITO").alias("raw"), dates.compact_date(text.clean_text("DTOBITO")).alias("day"))


@query("p04_parse_date_lenient", """
    SELECT CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN event_id % 3 = 2 THEN 'sem data' WHEN event_id % 2 = 0 AND day(ts) > 12 THEN strftime(ts, '%d/%m/%Y')
             ELSE strftime(ts, '%m/%d/%Y') END AS raw,
           CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%d') || ' 00:00:00' END AS moment,
           count(*) AS n
    FROM events GROUP BY ALL""")
def _(spark, folder):
    raw = (
        F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_id") % 3 == 2, F.lit("sem data"))
        .when((F.col("event_id") % 2 == 0) & (F.dayofmonth("ts") > 12), F.date_format("ts", "dd/MM/yyyy"))
        .otherwise(F.date_format("ts", "MM/dd/yyyy"))
    )
    events = table(spark, folder, "events").select(raw.alias("raw"))
    moment = F.date_format(dates.lenient_timestamp("raw"), "yyyy-MM-dd HH:mm:ss")
    return tally(events, F.col("raw"), moment.alias("moment"))


@query("p05_residence_flags", """
    SELECT code6 AS code, regexp_full_match(code6, '[0-9]{6}') AS valid, code6 = '330000' AS is_selected, count(*) AS n
    FROM death GROUP BY ALL""")
def _(spark, folder):
    code = text.clean_text("CODMUNRES")
    return tally(
        raw_deaths(spark, folder), code.alias("code"), residence_code_valid(code).alias("valid"),
        (code == TERRITORY.selected_code6).alias("is_selected"),
    )


@query("p06_year_from_filename", """
    SELECT name, TRY_CAST(nullif(regexp_extract('_' || name, '[^0-9](20[0-9]{2})[^0-9]', 1), '') AS INT) AS year, count(*) AS n FROM
      (SELECT 'sim_' || CAST(l_orderkey % 40 + 1980 AS STRING) || CASE WHEN l_linenumber = 1 THEN '9' ELSE '' END || '_v' || CAST(l_linenumber AS STRING) || '.csv' AS name
       FROM lineitem) GROUP BY ALL""")
def _(spark, folder):
    name = F.expr(
        "'sim_' || CAST(l_orderkey % 40 + 1980 AS STRING) || CASE WHEN l_linenumber = 1 THEN '9' ELSE '' END"
        " || '_v' || CAST(l_linenumber AS STRING) || '.csv'"
    )
    named = table(spark, folder, "lineitem").select(name.alias("name"))
    return tally(named, F.col("name"), text.year_in_name("name").alias("year"))


@query("p08_icd_match", """
    SELECT cause,
      substr(cause, 1, 1) = 'J' AND coalesce(TRY_CAST(substr(cause, 2, 2) AS INT) BETWEEN 12 AND 18, false) AS pneumonia,
      starts_with(cause, 'C50') AS breast,
      cause IN ('U071', 'U072') AS covid,
      starts_with(cause, 'G30') OR cause IN ('F000', 'F001', 'F002') AS alzheimer,
      starts_with(cause, 'G30') OR starts_with(cause, 'F00') AS alzheimer_two_digits, count(*) AS n
    FROM death GROUP BY ALL""")
def _(spark, folder):
    cause = text.normalize_code("underlying_cause")
    dementia = ["G30", "F00.0-F00.2"]
    return tally(
        deaths(spark, folder), cause.alias("cause"),
        icd_match(cause, ["J12-J18"]).alias("pneumonia"), icd_match(cause, ["C50"]).alias("breast"),
        icd_match(cause, ["U071", "U072"]).alias("covid"), icd_match(cause, dementia).alias("alzheimer"),
        icd_match(cause, dementia, strict=False).alias("alzheimer_two_digits"),
    )


@query("p09_age_bucket", """
    SELECT CAST(years AS DOUBLE) AS years, CASE WHEN years < 1 THEN '<1' WHEN years < 5 THEN '1-4' WHEN years < 15 THEN '5-14' WHEN years < 25 THEN '15-24'
      WHEN years < 45 THEN '25-44' WHEN years < 65 THEN '45-64' WHEN years < 75 THEN '65-74' WHEN years >= 75 THEN '75+'
      ELSE 'ignorado' END AS age_group, count(*) AS n
    FROM (SELECT CASE WHEN p_size < 48 THEN (p_size - 1) * 2.5 END AS years FROM part) GROUP BY ALL""")
def _(spark, folder):
    years = F.when(F.col("p_size") < 48, (F.col("p_size") - 1) * 2.5)
    part = table(spark, folder, "part").select(years.alias("years"))
    return tally(part, F.col("years"), demographics.age_bucket("years").alias("age_group"))


@query("p10_age_decode_death", "SELECT age_raw, age_group, count(*) AS n FROM death_dim GROUP BY ALL")
def _(spark, folder):
    return tally(deaths(spark, folder), F.col("age_raw"), demographics.death_age_group("age_raw").alias("age_group"))


@query("p11_age_decode_notification", """
    SELECT CAST(CAST(age AS INT) AS STRING) AS age_raw, unit AS age_unit_raw, age_group, count(*) AS n FROM notif_dim GROUP BY ALL""")
def _(spark, folder):
    group = demographics.notification_age_group("age_raw", "age_unit_raw")
    return tally(notifications(spark, folder), F.col("age_raw"), F.col("age_unit_raw"), group.alias("age_group"))


@query("p12_sex_label", """
    SELECT 'SIM' AS source, sex, count(*) AS n FROM death_dim GROUP BY ALL
    UNION ALL SELECT 'SIVEP-SRAG', sex, count(*) FROM notif_dim GROUP BY ALL""")
def _(spark, folder):
    frames = [(deaths, "SIM"), (notifications, "SIVEP-SRAG")]
    parts = [
        tally(read(spark, folder), F.lit(s).alias("source"), demographics.sex_label("sex_raw", s).alias("sex"))
        for read, s in frames
    ]
    return parts[0].unionByName(parts[1])


@query("p13_outcome_status_label", "SELECT outcome_code AS raw, outcome_status, count(*) AS n FROM notif_dim GROUP BY ALL")
def _(spark, folder):
    status = demographics.outcome_status_label("outcome_raw")
    return tally(notifications(spark, folder), F.col("outcome_raw").alias("raw"), status.alias("outcome_status"))


@query("p14_classify_geography", "SELECT code6 AS code, geography, count(*) AS n FROM death_dim GROUP BY ALL")
def _(spark, folder):
    code = F.col("municipality_code_datasus")
    return tally(deaths(spark, folder), code.alias("code"), classify_geography(code, TERRITORY).alias("geography"))


@query("p15_classify_geography_state_only", """
    SELECT code6 AS code, CASE WHEN code6 = '330000' THEN 'volta_redonda' WHEN starts_with(code6, '33') THEN 'rest_of_rj_excluding_vr'
      ELSE 'outside_rj' END AS geography, count(*) AS n FROM notif GROUP BY ALL""")
def _(spark, folder):
    code = F.col("municipality_code_datasus")
    return tally(
        notifications(spark, folder), code.alias("code"), classify_state_geography(code, TERRITORY).alias("geography")
    )


@query("p16_period_status", """
    SELECT d.year, outcome_id, CASE
        WHEN section = 'cancer' AND y BETWEEN 2020 AND 2022 THEN 'cancer_care_disruption'
        WHEN section = 'cancer' AND y >= 2025 THEN 'cancer_provisional_prevenir_50_plus'
        WHEN section IN ('respiratory', 'cardiovascular', 'cardiorespiratory') AND y >= 2025 THEN section || '_provisional'
        WHEN section = 'respiratory' AND y BETWEEN 2020 AND 2021 THEN 'respiratory_pandemic'
        WHEN section IN ('cardiovascular', 'cardiorespiratory') AND y BETWEEN 2020 AND 2021 THEN section || '_pandemic_context'
        ELSE 'source_year_observed' END AS period_status, n
    FROM (SELECT year, year + 24 AS y, outcome_id, sum(n)::BIGINT AS n FROM death_base GROUP BY ALL) d JOIN outcomes USING (outcome_id)""")
def _(spark, folder):
    base = death_counts(spark, folder).where("geography = 'brazil_total'")
    counted = base.groupBy(F.col("source_year").cast("int").alias("year"), "outcome_id").agg(F.sum("count").alias("n"))
    return counted.withColumn("period_status", periods.death_period_status(F.col("year") + 24, "outcome_id"))


@query("p17_period_status_variants", """
    SELECT y AS year, count(*) AS n,
      CASE WHEN y = 2025 THEN 'provisional_2025' ELSE 'complete_annual' END AS annual_admissions,
      CASE WHEN y = 2026 THEN 'provisional_partial_2026' WHEN y = 2025 THEN 'provisional_2025' ELSE 'surveillance_versioned' END AS monthly_notifications,
      CASE WHEN y = 2025 THEN 'provisional_2025' ELSE 'eligible_complete_year' END AS interrupted_series,
      CASE WHEN y BETWEEN 2013 AND 2019 THEN 'observed_pre_disruption' WHEN y BETWEEN 2020 AND 2022 THEN 'cancer_care_disruption'
           WHEN y IN (2023, 2024) THEN 'observed_post_disruption' ELSE 'source_year_observed' END AS registry,
      CASE WHEN y >= 2025 THEN 'neurological_provisional' ELSE 'source_year_observed' END AS neurological,
      CASE WHEN y >= 2025 THEN 'provisional' ELSE 'source_year_observed' END AS municipal_admissions,
      CASE WHEN y >= 2025 THEN 'provisional' ELSE 'source_year_observed' END AS ambulatory
    FROM (SELECT CAST(2008 + o_orderkey % 20 AS INT) AS y FROM orders) GROUP BY ALL""")
def _(spark, folder):
    year = (F.lit(2008) + F.col("o_orderkey") % 20).cast("int")
    base = tally(table(spark, folder, "orders"), year.alias("year"))
    return base.withColumns({p: periods.product_period_status(p, "year") for p in periods.PRODUCT_PERIOD_DEFAULT})


_PERIOD_VALUES = ", ".join(f"('{s}', '{i}', {a[:4]}, {b[:4]}, '{t}')" for s, i, a, b, t in PERIODS)


@query("p18_period_dimension", f"""
    SELECT section, period_id, status, count(*) AS n FROM
      (SELECT CAST(2008 + o_orderkey % 19 AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month FROM orders) e
    JOIN (SELECT * FROM (VALUES {_PERIOD_VALUES}) AS v(section, period_id, y0, y1, status)) p
      ON e.year BETWEEN p.y0 AND p.y1 GROUP BY ALL""")
def _(spark, folder):
    year = (F.lit(2008) + F.col("o_orderkey") % 19).cast("int")
    per_year = tally(table(spark, folder, "orders"), year.alias("year"))
    return per_year.join(periods.period_years(spark), "year").groupBy("section", "period_id", "status").agg(F.sum("n").alias("n"))


_MONTHS_SQL = """
    e AS (SELECT CAST(2005 + o_orderkey % 23 AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, count(*) AS n FROM orders GROUP BY ALL),
    m AS (SELECT *, year * 12 + month - 1 AS number FROM e)"""
_INTERVALS = [*PERIODS, ("admissions", "until_february", "2000-01", "2010-02", "early"), ("admissions", "from_march", "2010-03", "2012-11", "late"), ("admissions", "open", "2014-06", None, "open")]
_INTERVAL_VALUES = ", ".join(
    f"('{s}', '{i}', {periods.month_number(a)}, {periods.month_number(b) if b else 'NULL'}, '{t}')" for s, i, a, b, t in _INTERVALS
)


def _months(spark, folder):
    date = F.make_date((F.lit(2005) + F.col("o_orderkey") % 23).cast("int"), F.month("o_orderdate"), F.lit(28))
    return tally(table(spark, folder, "orders"), date.alias("date"))


@query("p18_period_months", f"""
    WITH {_MONTHS_SQL}, p AS (SELECT * FROM (VALUES {_INTERVAL_VALUES}) v(section, period_id, lo, hi, status))
    SELECT s.section, p.period_id, p.status AS period_status, sum(n)::BIGINT AS n FROM m CROSS JOIN (SELECT DISTINCT section FROM p) s
    LEFT JOIN p ON p.section = s.section AND m.number >= p.lo AND (p.hi IS NULL OR m.number <= p.hi) GROUP BY ALL""")
def _(spark, folder):
    """Months in half-open periods: some start inside a year, one never ends, and there are gaps."""
    sections = F.explode(F.array(*[F.lit(s) for s in dict.fromkeys(r[0] for r in _INTERVALS)]))
    placed = periods.with_period(_months(spark, folder).withColumn("section", sections), "date", _INTERVALS)
    return placed.groupBy("section", "period_id", "period_status").agg(F.sum("n").alias("n"))


@query("p18_break_sides", f"""
    WITH {_MONTHS_SQL}, b AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {periods.month_number(at)})" for n, at in BREAKS)}) v(break_id, begins))
    SELECT break_id, number >= begins AS after, sum(n)::BIGINT AS n FROM m, b GROUP BY ALL""")
def _(spark, folder):
    """Months before and from each configured break on."""
    sides = _months(spark, folder).select("n", F.explode(periods.break_sides("date")).alias("_b")).select("n", "_b.*")
    known = periods.break_dimension(spark).select("break_id")
    return sides.join(known, "break_id").groupBy("break_id", "after").agg(F.sum("n").alias("n"))


@query("p19_code_pad_truncate", """
    SELECT raw, lpad(raw, 7, '0') AS code7, substr(lpad(raw, 7, '0'), 1, 6) AS code6,
      CASE WHEN ltrim(raw, '0') = '' THEN '0' ELSE ltrim(raw, '0') END AS bare, count(*) AS n
    FROM (SELECT CASE WHEN o_orderkey % 9 = 0 THEN '000' ELSE '0' || CAST(o_orderkey % 4000 AS STRING) END AS raw FROM orders) GROUP BY ALL""")
def _(spark, folder):
    raw = F.expr("CASE WHEN o_orderkey % 9 = 0 THEN '000' ELSE '0' || CAST(o_orderkey % 4000 AS STRING) END")
    orders = table(spark, folder, "orders").select(raw.alias("raw"))
    code7 = text.pad_code7("raw")
    return tally(
        orders, F.col("raw"), code7.alias("code7"), text.code7_to_code6(code7).alias("code6"),
        text.strip_leading_zeros("raw").alias("bare"),
    )


@query("p20_canonical_label", """
    SELECT doc_id, trim(regexp_replace(replace(lower(strip_accents(text)), '..', ''), '\\s+', ' ', 'g')) AS label
    FROM documents""")
def _(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.canonical_label("text").alias("label"))


_LABELS = (
    "CASE l_partkey % 12 WHEN 0 THEN '10 Doenças do aparelho respiratório' WHEN 1 THEN '.. Pneumonia' "
    "WHEN 2 THEN '..Asma' WHEN 3 THEN '.. Pneumoconiose' WHEN 4 THEN '09 Doenças do aparelho circulatório' "
    "WHEN 5 THEN '.. Hipertensão essencial (primária)' WHEN 6 THEN '.. Infarto agudo do miocárdio' "
    "WHEN 7 THEN '.. Infarto cerebral' WHEN 8 THEN 'Acid vascular cerebr isquêm transit e síndr correl' "
    "WHEN 9 THEN '.. Acid vascular cerebr não espec hemorrág ou isq' WHEN 10 THEN '.. Pneumonia bacteriana' "
    "ELSE 'Total' END"
)


@query("p21_label_to_outcome", f"""
    SELECT label, CASE canon WHEN '10 doencas do aparelho respiratorio' THEN 'resp_all' WHEN 'pneumonia' THEN 'pneumonia'
      WHEN 'asma' THEN 'asthma' WHEN 'pneumoconiose' THEN 'pneumoconiosis' WHEN '09 doencas do aparelho circulatorio' THEN 'cardio_all'
      WHEN 'hipertensao essencial (primaria)' THEN 'hypertension_essential' WHEN 'infarto agudo do miocardio' THEN 'acute_myocardial_infarction'
      WHEN 'infarto cerebral' THEN 'cerebrovascular_infarction'
      WHEN 'acid vascular cerebr nao espec hemorrag ou isq' THEN 'cerebrovascular_unspecified' END AS component_id, count(*) AS n
    FROM (SELECT label, trim(replace(lower(strip_accents(label)), '..', '')) AS canon FROM (SELECT {_LABELS} AS label FROM lineitem))
    GROUP BY ALL""")
def _(spark, folder):
    labelled = tally(table(spark, folder, "lineitem").select(F.expr(_LABELS).alias("label")), F.col("label"))
    return labelled.withColumn("component_id", label_component("label"))


@query("p22_locale_integer", """
    SELECT raw, CASE WHEN raw = '-' THEN 0 ELSE CAST(replace(replace(raw, '.', ''), ',', '') AS BIGINT) END AS figure, count(*) AS n FROM
      (SELECT CASE WHEN p_partkey % 7 = 0 THEN '-' WHEN p_partkey > 999 THEN CAST(p_partkey // 1000 AS STRING) || '.' || lpad(CAST(p_partkey % 1000 AS STRING), 3, '0')
         ELSE CAST(p_partkey AS STRING) END AS raw FROM part) GROUP BY ALL""")
def _(spark, folder):
    raw = F.expr(
        "CASE WHEN p_partkey % 7 = 0 THEN '-' WHEN p_partkey > 999 THEN CAST(p_partkey div 1000 AS STRING) || '.' || "
        "lpad(CAST(p_partkey % 1000 AS STRING), 3, '0') ELSE CAST(p_partkey AS STRING) END"
    )
    part = table(spark, folder, "part").select(raw.alias("raw"))
    return tally(part, F.col("raw"), text.locale_integer("raw").alias("figure"))


@query("p23_html_unescape_decode", "SELECT doc_id, text FROM documents")
def _(spark, folder):
    """Document texts as Latin-1 pages, everything beyond as entities; decoding must give the text back."""
    latin = F.col("text")
    for plain, entity in [("&", "&amp;"), ("<", "&lt;"), ("ç", "&ccedil;"), ("é", "&#233;"), ("ã", "&atilde;")]:
        latin = F.replace(latin, F.lit(plain), F.lit(entity))
    # Each character beyond Latin-1 becomes a numeric reference.
    letters = F.transform(F.split(latin, ""), lambda c: F.when(F.ascii(c) > 255, F.concat(F.lit("&#"), F.ascii(c), F.lit(";"))).otherwise(c))
    pages = table(spark, folder, "documents").select("doc_id", F.encode(F.array_join(letters, ""), "ISO-8859-1").alias("content"))
    return pages.select("doc_id", text.latin1_page("content").alias("text"))


@query("p24_year_month_string", """
    SELECT strftime(o_orderdate, '%Y-%m') AS period, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n
    FROM orders GROUP BY ALL""")
def _(spark, folder):
    period = dates.year_month(F.year("o_orderdate"), F.month("o_orderdate"))
    return tally(table(spark, folder, "orders"), period.alias("period"), dates.month_from_text(period).alias("month"))


@query("p25_extract_code_prefix", """
    SELECT label, nullif(regexp_extract(label, '^(C[0-9]{2})', 1), '') AS code, count(*) AS n
    FROM (SELECT cause || ' neoplasia' AS label FROM death) GROUP BY ALL""")
def _(spark, folder):
    label = F.concat(text.normalize_code("underlying_cause"), F.lit(" neoplasia"))
    return tally(deaths(spark, folder), label.alias("label"), text.site_code(label).alias("code"))


@query("p26_indicator_id_theme", """
    SELECT 'sim-' || replace(outcome_id, '_', '-') AS indicator_id, section AS theme, 'mortality' AS measure,
      sum(n)::BIGINT AS n FROM death_base JOIN outcomes USING (outcome_id) GROUP BY ALL""")
def _(spark, folder):
    from ..fixed_values import SOURCE_ATTRIBUTES
    base = death_counts(spark, folder).where("geography = 'brazil_total'").groupBy("outcome_id").agg(F.sum("count").alias("n"))
    measure = demographics.lookup({s: m for s, m, _, _ in SOURCE_ATTRIBUTES}, F.lit("SIM"))
    return base.select(
        labels.indicator_id(F.lit("SIM"), "outcome_id").alias("indicator_id"),
        labels.outcome_theme("outcome_id").alias("theme"), measure.alias("measure"), "n",
    )


@query("p27_data_status", """
    SELECT source, y AS year, label, CASE WHEN contains(label, 'provisional') OR (source = 'SIH' AND y >= 2025) THEN 'provisional'
      ELSE 'source_observed' END AS data_status, count(*) AS n
    FROM (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'SIH' ELSE 'SIM' END AS source, CAST(2015 + o_orderkey % 13 AS INT) AS y,
      CASE WHEN o_orderstatus = 'F' THEN 'provisional_2025' ELSE 'complete_annual' END AS label FROM orders) GROUP BY ALL""")
def _(spark, folder):
    rows = table(spark, folder, "orders").selectExpr(
        "CASE WHEN o_orderkey % 2 = 0 THEN 'SIH' ELSE 'SIM' END AS source", "CAST(2015 + o_orderkey % 13 AS INT) AS year",
        "CASE WHEN o_orderstatus = 'F' THEN 'provisional_2025' ELSE 'complete_annual' END AS label",
    )
    status = periods.data_status("source", "year", "label")
    return tally(rows, F.col("source"), F.col("year"), F.col("label"), status.alias("data_status"))


@query("p28_finite_or_null", """
    SELECT l_quantity AS quantity, CASE WHEN l_quantity % 5 <> 0 THEN l_quantity / 2 END AS half, count(*) AS n FROM lineitem GROUP BY ALL""")
def _(spark, folder):
    half = F.when(F.col("l_quantity") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("l_quantity") / 2)
    return tally(table(spark, folder, "lineitem"), F.col("l_quantity").alias("quantity"), text.finite_or_null(half).alias("half"))


@query("p29_synonym_array", """
    SELECT outcome_id, lower(outcome_label) AS label_text, array_to_string(list_sort(list_distinct([lower(outcome_label)] ||
      CASE outcome_id WHEN 'lung' THEN ['pulmão', 'câncer de pulmão', 'bronquios', 'traqueia'] WHEN 'pneumonia' THEN ['pneumonia', 'infecção pulmonar']
        WHEN 'acute_myocardial_infarction' THEN ['infarto', 'ataque cardíaco', 'iam'] WHEN 'all_malignant_neoplasms' THEN ['câncer', 'cancer', 'neoplasias']
        WHEN 'alzheimer' THEN ['alzheimer', 'demência de alzheimer', 'perda de memória']
        WHEN 'dementias_all' THEN ['demência', 'demências', 'alzheimer', 'perda de memória'] ELSE [] END)), '|') AS synonyms
    FROM (SELECT DISTINCT outcome_id FROM death_base) JOIN outcomes USING (outcome_id)""")
def _(spark, folder):
    present = death_counts(spark, folder).select("outcome_id", "outcome_label").distinct()
    words = labels.synonym_array("outcome_id", "outcome_label")
    return present.select(
        "outcome_id", F.lower("outcome_label").alias("label_text"), F.array_join(words, "|").alias("synonyms")
    )


@query("p30_clean_place_name", """
    SELECT code7 AS code, municipality_name AS raw, replace(replace(municipality_name, ' - RJ', ''), ' (RJ)', '') AS name, count(*) AS n
    FROM munipop GROUP BY ALL""")
def _(spark, folder):
    return tally(
        municipal_population(spark, folder), F.col("municipality_code_ibge").alias("code"),
        F.col("municipality_name").alias("raw"), text.clean_place_name("municipality_name").alias("name"),
    )


@query("p31_round_nested_arrays", """
    SELECT vec_id, i AS position, round(CAST(embedding[i + 1] AS DOUBLE), 5) AS coordinate FROM embeddings, range(64) AS t(i)""")
def _(spark, folder):
    """Vectors folded to an array of points, rounded two levels deep."""
    points = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.slice("embedding", i * 2 + 1, 2))
    rounded = table(spark, folder, "embeddings").select("vec_id", text.round_coordinates(points, 2).alias("points"))
    flat = rounded.select("vec_id", F.posexplode(F.flatten("points")).alias("position", "coordinate"))
    return flat.withColumn("position", F.col("position").cast("long"))


@query("p32_explode_rings", """
    SELECT code, polygon, ring, row_number() OVER (ORDER BY code, polygon, ring) - 1 AS arc,
      round(CAST(embedding[polygon * 32 + ring * 8 + 1] AS DOUBLE), 5) AS first_x
    FROM (SELECT lpad(CAST(vec_id AS STRING), 7, '0') AS code, p AS polygon, r AS ring, embedding
          FROM embeddings, range(2) AS t(p), range(4) AS u(r))""")
def _(spark, folder):
    """Vectors as two polygons of four rings of four points each."""
    def point(p, r, k):
        return F.slice("embedding", p * 32 + r * 8 + k * 2 + 1, 2)

    shape = F.transform(F.sequence(F.lit(0), F.lit(1)), lambda p: F.transform(
        F.sequence(F.lit(0), F.lit(3)), lambda r: F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: point(p, r, k))
    ))
    features = table(spark, folder, "embeddings").select(
        F.lpad(F.col("vec_id").cast("string"), 7, "0").alias("code"), shape.alias("coordinates")
    )
    arcs = number_arcs(polygon_rings(features))
    return arcs.select(
        "code", F.col("polygon").cast("long"), F.col("ring").cast("long"), "arc", F.col("points")[0][0].alias("first_x")
    )


_CELLS = (
    "CASE event_id % 6 WHEN 0 THEN '=' || props WHEN 1 THEN '-' || event_type WHEN 2 THEN event_type || ', ' || event_type "
    "WHEN 3 THEN '@' || event_type WHEN 4 THEN event_type END"
)


@query("p33_csv_safe_cell", f"""
    SELECT raw, CASE WHEN regexp_matches(t, '[",\\r\\n]') THEN '"' || replace(t, '"', '""') || '"' ELSE t END AS cell, n FROM
      (SELECT raw, CASE WHEN regexp_matches(coalesce(raw, ''), '^[=+@-]') THEN '''' || raw ELSE coalesce(raw, '') END AS t, count(*) AS n
       FROM (SELECT {_CELLS} AS raw FROM events) GROUP BY ALL)""")
def _(spark, folder):
    rows = tally(table(spark, folder, "events").select(F.expr(_CELLS).alias("raw")), F.col("raw"))
    return rows.withColumn("cell", text.csv_safe_cell("raw"))


@query("p34_relative_difference_label", """
    SELECT code7, year, outcome_id, CASE WHEN ratio IS NULL THEN 'Comparação indisponível'
      WHEN floor(abs((ratio - 1) * 100) + 0.5) = 0 THEN 'Taxa semelhante'
      ELSE CAST(CAST(floor(abs((ratio - 1) * 100) + 0.5) AS BIGINT) AS STRING) || '% ' || CASE WHEN ratio > 1 THEN 'acima' ELSE 'abaixo' END END AS label
    FROM (SELECT a.code7, a.year, a.outcome_id, CASE WHEN b.rate > 0 THEN a.rate / b.rate END AS ratio FROM munimap a
      JOIN munimap b ON b.code7 = '3300000' AND a.year = b.year AND a.outcome_id = b.outcome_id)""")
def _(spark, folder):
    from ..fixed_values import SELECTED
    from ..operators.joins import wide_comparators
    marked = map_rates(spark, folder).withColumn(
        "place", F.when(F.col("municipality_code_ibge") == TERRITORY.selected_code7, F.lit(SELECTED))
    )
    wide = wide_comparators(marked, ["year", "outcome_id"], [SELECTED], ["rate_per_100k"], "place")
    ratio = labels.ratio_guarded("rate_per_100k", f"rate_per_100k_{SELECTED}")
    return wide.select(
        F.col("municipality_code_ibge").alias("code7"), "year", "outcome_id",
        labels.relative_difference_label(ratio).alias("label"),
    )


@query("p35_direction_label", """
    SELECT code7, year, outcome_id, CASE WHEN abs(change) < 5 THEN 'estável em relação a' WHEN change > 0 THEN 'acima de' ELSE 'abaixo de' END AS direction
    FROM (SELECT code7, year, outcome_id, CASE WHEN prev > 0 THEN (rate / prev - 1) * 100 ELSE 0 END AS change FROM
      (SELECT *, lag(rate) OVER (PARTITION BY code7, outcome_id ORDER BY year) AS prev FROM munimap) WHERE prev IS NOT NULL)""")
def _(spark, folder):
    from pyspark.sql import Window
    window = Window.partitionBy("municipality_code_ibge", "outcome_id").orderBy("year")
    steps = map_rates(spark, folder).withColumn("previous", F.lag("rate_per_100k").over(window)).where("previous IS NOT NULL")
    change = labels.percent_change("rate_per_100k", "previous")
    return steps.select(
        F.col("municipality_code_ibge").alias("code7"), "year", "outcome_id", labels.direction_label(change).alias("direction")
    )


@query("p36_calendar_spine", """
    SELECT o_orderpriority AS series, CAST(unnest(generate_series(min(date_trunc('month', o_orderdate)), max(date_trunc('month', o_orderdate)),
      INTERVAL 1 MONTH)) AS DATE) AS period FROM orders GROUP BY 1""")
def _(spark, folder):
    spans = table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("series")).agg(
        F.min(dates.month_start("o_orderdate")).alias("first"), F.max(dates.month_start("o_orderdate")).alias("last")
    )
    return month_spine(F.col("first"), F.col("last"), spans).select("series", "period")


@query("p37_min_max_intensity", """
    SELECT code7, year, outcome_id, round(CASE WHEN hi > lo THEN (rate - lo) / (hi - lo) ELSE 0.5 END, 6) AS intensity FROM
      (SELECT *, min(rate) OVER (PARTITION BY outcome_id) AS lo, max(rate) OVER (PARTITION BY outcome_id) AS hi FROM munimap)""")
def _(spark, folder):
    scaled = min_max_intensity(map_rates(spark, folder), ["outcome_id"], "rate_per_100k")
    return scaled.select(
        F.col("municipality_code_ibge").alias("code7"), "year", "outcome_id", F.round("intensity", 6).alias("intensity")
    )


@query("p38_synthetic_columns", """
    SELECT year, outcome_id, outcome_label, 'SIM' AS source, 'óbito' AS outcome_status, 'óbito de residente no SIM; causa básica' AS unit, sum(n)::BIGINT AS n
    FROM death_base JOIN outcomes USING (outcome_id) GROUP BY ALL""")
def _(spark, folder):
    return death_counts(spark, folder).where("geography = 'brazil_total'").groupBy(
        F.col("source_year").cast("int").alias("year"), "outcome_id", "outcome_label", "source", "outcome_status", "unit"
    ).agg(F.sum("count").alias("n"))
