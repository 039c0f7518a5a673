"""Publication products (PB01-PB15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import ADMISSION_OUTCOME_LABELS, COUNTRY_TOTAL, SELECTED, STATE_TOTAL, outcome_definitions
from ..functions.dates import year_month
from ..functions.demographics import literal_map
from ..operators.rollup import age_sex_denominators, national_denominators, state_denominators
from ..operators.series import union_all
from ..operators.standardize import direct_standardized_rate, standardized_rest_of_state
from ..plans import products, publish
from ..session import fresh_path, table
from ..sources import provenance, sinks
from .registry import query
from .standins import (
    MUNICIPALITIES, SIM, STANDARD_YEAR, TERRITORY, admission_windows, death_counts, death_rates, deaths, map_rates, monthly_admissions,
    municipal_population, notification_totals, population, population_age_sex, profile_cells, state_age_sex,
    state_municipal_population,
)

MANIFEST = "manifest.json"
NEURO = ["alzheimer", "dementias_all"]


def _aggregate(spark, folder):
    return publish.observations(death_rates(spark, folder), "SIM", "population", MANIFEST)


def _standardized(spark, folder):
    cells = profile_cells(spark, folder).where(F.col("outcome_id").isin(NEURO))
    slim = cells.select("municipality_code_ibge", "outcome_id", "age_group", "sex", "count", "population")
    rates = direct_standardized_rate(slim, population_age_sex(spark, folder), ["municipality_code_ibge", "outcome_id"])
    return publish.standardized_observations(rates, "SIM", STANDARD_YEAR, MANIFEST)


def _municipal(spark, folder):
    crude = publish.observations(map_rates(spark, folder), "SIM", "population", MANIFEST, "municipality_code_ibge")
    return union_all([crude, _standardized(spark, folder)])


_STD = """
    adj AS (SELECT p.code7, p.outcome_id, sum(s.weight * p.n / p.population * 100000.0) AS rate, sum(p.n)::BIGINT AS n, sum(p.population)::BIGINT AS population
      FROM profile p JOIN standard s USING (age_group, sex) WHERE outcome_id IN ('alzheimer', 'dementias_all') GROUP BY ALL),
    ms AS (SELECT code7, outcome_id, year, 'crude_rate_per_100k' AS metric, rate, n, population FROM munimap
      UNION ALL SELECT code7, outcome_id, 2000, 'age_sex_standardized_rate_per_100k', rate, n, population FROM adj)"""
_IND = "'sim-' || replace(outcome_id, '_', '-')"
_SHOWN = "CASE WHEN n >= 5 THEN n END AS count, CASE WHEN n >= 5 THEN round(rate, 5) END AS value"


def _shown(df, *extra):
    return df.select(
        F.col("indicatorId").alias("indicator"), *extra, "period", "count", F.round("value", 5).alias("value"),
    )


_RANGES = {o.id: "|".join(o.ranges) for o in outcome_definitions("SIM")}
_RANGES_SQL = ", ".join(f"('{k}', '{v}')" for k, v in _RANGES.items())


@query("pb01_catalog", f"""
    WITH a AS (SELECT outcome_id, CAST(min(year) AS INT) AS y0, CAST(max(year) AS INT) AS y1, string_agg(DISTINCT geography, '|' ORDER BY geography) AS geographies FROM mort GROUP BY 1),
      y AS (SELECT outcome_id, min(year) AS first, max(year) AS last, count(DISTINCT code7) FILTER (WHERE n >= 5) AS publishable, list(DISTINCT year) AS years FROM munimap GROUP BY 1),
      c AS (SELECT *, outcome_id IN ('alzheimer', 'dementias_all') AS standard FROM a JOIN y USING (outcome_id) JOIN (SELECT DISTINCT outcome_id, outcome_label, section FROM outcomes) USING (outcome_id)
        JOIN (VALUES {_RANGES_SQL}) v(outcome_id, ranges) USING (outcome_id))
    SELECT {_IND} AS indicator, section AS theme, outcome_label AS label, 'mortality' AS measure, 'Mortalidade' AS measure_label, geographies, y0 AS year_start, y1 AS year_end, publishable,
      (SELECT coalesce(string_agg(CAST(i AS STRING), '|' ORDER BY i), '') FROM range(first, last + 1) r(i) WHERE NOT list_contains(years, i)) AS missing, ranges,
      CASE WHEN standard THEN 'age_sex_standardized_rate_per_100k|' ELSE '' END || 'crude_rate_per_100k|count' AS metrics,
      CASE WHEN standard THEN 'age_sex_standardized_2000_and_crude_annual' ELSE 'crude_only' END AS standardization, CASE WHEN standard THEN 'age_group|sex' ELSE '' END AS dimensions,
      CASE WHEN standard THEN 'available_2000' ELSE 'not_available' END AS availability, CASE WHEN standard THEN '2000' END AS standard_period,
      'validated_sim_' || CAST(last AS STRING) || '_municipal_residence_rates_crude' AS map_status, '/indicadores/' || {_IND} AS url, 'residence' AS basis FROM c""")
def _(spark, folder):
    labels = literal_map({o.id: o.label for o in outcome_definitions()})
    aggregate = _aggregate(spark, folder)
    named = aggregate.select("outcomeId").distinct().withColumn("label", labels[F.col("outcomeId")])
    records = publish.catalog(aggregate, _municipal(spark, folder), named)
    lists = {
        "geographies": "geographyIds", "missing": "missingPeriods", "ranges": "cidRanges", "metrics": "availableMetrics", "dimensions": "standardizationDimensions",
    }
    plain = {
        "indicator": "indicatorId", "theme": "theme", "label": "label", "measure": "measure", "measure_label": "measureLabel", "year_start": "yearStart",
        "year_end": "yearEnd", "publishable": "publishableMunicipalityCount", "standardization": "standardization", "availability": "standardizedRateAvailability",
        "map_status": "mapStatus", "url": "methodologyUrl", "basis": "geographyBasis",
    }
    return records.select(
        *[F.col(c).alias(n) for n, c in plain.items()], *[F.array_join(c, "|").alias(n) for n, c in lists.items()],
        F.col("metricPeriod")[publish.STANDARDIZED].alias("standard_period"),
    )


@query("pb02_series", f"SELECT {_IND} AS indicator, geography, CAST(year AS STRING) AS period, {_SHOWN} FROM mort")
def _(spark, folder):
    return _shown(_aggregate(spark, folder), F.col("geographyId").alias("geography"))


@query("pb02_admission_series", """
    WITH a AS (SELECT year, geography, outcome_id, sum(value)::BIGINT AS n FROM adm WHERE year IN (SELECT year FROM adm_years) GROUP BY ALL)
    SELECT 'sih-' || replace(outcome_id, '_', '-') AS indicator, geography, CAST(year AS STRING) AS period, CASE WHEN n >= 5 THEN n END AS count,
      CASE WHEN n >= 5 THEN round(n / population * 100000.0, 5) END AS value FROM a JOIN pop USING (year, geography)""")
def _(spark, folder):
    rates = products.annual_admission_rates(admission_windows(spark, folder), population(spark, folder))
    return _shown(publish.observations(rates, "SIH", "denominator", MANIFEST), F.col("geographyId").alias("geography"))


_NEURO_SQL = "outcome_id IN ('alzheimer', 'dementias_all')"


@query("pb02_provenance", f"""
    WITH a AS (SELECT year, outcome_id, count(DISTINCT geography) AS areas FROM adm WHERE year IN (SELECT year FROM adm_years) GROUP BY ALL)
    SELECT 'SIM' AS source, outcome_id, CAST(year AS STRING) AS period, 'residence' AS basis, 'reports/quality/' || CASE WHEN {_NEURO_SQL} THEN 'sim_neurological' ELSE 'sim_mortality' END || '_rates_manifest.json' AS manifest,
      count(*) AS rows FROM mort GROUP BY ALL
    UNION ALL SELECT 'SIH', outcome_id, CAST(year AS STRING), 'residence', 'reports/quality/respiratory_rates_manifest.json', areas FROM a
    UNION ALL SELECT 'municipal', outcome_id, CAST(year AS STRING), 'residence',
      CASE WHEN {_NEURO_SQL} THEN 'reports/quality/sim_neurological_rates_manifest.json' ELSE 'reports/quality/sim_municipal_map_' || CAST(year AS STRING) || '_manifest.json' END, count(*) FROM munimap GROUP BY ALL""")
def _(spark, folder):
    """Basis of the area and the manifest behind every public row, by source, outcome and map year."""
    admissions = products.annual_admission_rates(admission_windows(spark, folder), population(spark, folder))
    parts = [
        publish.observations(death_rates(spark, folder), "SIM", "population"), publish.observations(admissions, "SIH", "denominator"),
        publish.observations(map_rates(spark, folder), "SIM", "population", area="municipality_code_ibge").withColumn("source", F.lit("municipal")),
    ]
    return union_all(parts).groupBy(
        "source", F.col("outcomeId").alias("outcome_id"), "period", F.col("geographyBasis").alias("basis"), F.col("manifestRef").alias("manifest"),
    ).agg(F.count(F.lit(1)).alias("rows"))


@query("pb03_municipal_map", f"""
    WITH {_STD} SELECT {_IND} AS indicator, code7, CAST(year AS STRING) AS period, metric, {_SHOWN} FROM ms
    WHERE CASE WHEN outcome_id IN ('alzheimer', 'dementias_all') THEN metric <> 'crude_rate_per_100k' ELSE year = 2001 END""")
def _(spark, folder):
    chosen = publish.municipal_map(_municipal(spark, folder))
    return _shown(chosen, F.col("geographyId").alias("code7"), F.col("metricKind").alias("metric"))


@query("pb03_alternative_map", f"""
    SELECT {_IND} AS indicator, code7, CAST(year AS STRING) AS period, {_SHOWN} FROM munimap WHERE outcome_id IN ('alzheimer', 'dementias_all') AND year = 2001""")
def _(spark, folder):
    return _shown(publish.alternative_map(_municipal(spark, folder)), F.col("geographyId").alias("code7"))


@query("pb03_map_documents", f"""
    WITH {_STD}, v AS (SELECT *, outcome_id IN ('alzheimer', 'dementias_all') AS standard, metric <> 'crude_rate_per_100k' AS adjusted FROM ms),
      s AS (SELECT outcome_id, standard, max(year) AS year, count(*) AS areas, sum(CASE WHEN n >= 5 THEN n ELSE 0 END)::BIGINT AS shown FROM v
        WHERE CASE WHEN standard THEN adjusted ELSE year = 2001 END GROUP BY ALL),
      a AS (SELECT outcome_id, count(*) AS areas, sum(CASE WHEN n >= 5 THEN n ELSE 0 END)::BIGINT AS shown FROM v WHERE standard AND NOT adjusted AND year = 2001 GROUP BY 1)
    SELECT {_IND.replace('outcome_id', 's.outcome_id')} AS indicator, CASE WHEN standard THEN '1.1.0' ELSE '1.0.0' END AS version, CAST(year AS INT) AS period, s.areas, s.shown,
      'validated_sim_' || CAST(year AS STRING) || '_municipal_residence_rates_' || CASE WHEN standard THEN 'age_sex_standardized' ELSE 'crude' END AS status,
      CASE WHEN a.areas IS NULL THEN 0 ELSE 1 END AS alternatives, coalesce(a.areas, 0) AS other_areas, coalesce(a.shown, 0) AS other_shown FROM s LEFT JOIN a USING (outcome_id)
    UNION ALL SELECT 'sih-none', '1.0.0', NULL, 0, 0, 'context_only_pending_validated_municipal_rates', 0, 0, 0""")
def _(spark, folder):
    """Nested documents written one per indicator and read back; one indicator has no municipal values."""
    series = _municipal(spark, folder)
    wanted = series.select("indicatorId").distinct().unionByName(spark.createDataFrame([("sih-none",)], "indicatorId string"))
    back = sinks.write_documents(publish.map_documents(series, wanted), fresh_path(spark, "maps"), "indicatorId")

    def shown(values):
        return F.aggregate(values, F.lit(0).cast("long"), lambda total, v: total + F.coalesce(v["count"], F.lit(0)))

    other = F.flatten(F.transform(F.coalesce("alternatives", F.array()), lambda a: a["values"]))
    return back.select(
        F.col("indicatorId").alias("indicator"), F.col("schemaVersion").alias("version"), "period", F.size("values").cast("long").alias("areas"),
        shown(F.col("values")).alias("shown"), "status", F.size("alternatives").alias("alternatives"), F.size(other).cast("long").alias("other_areas"), shown(other).alias("other_shown"),
    )


@query("pb04_municipal_series", f"WITH {_STD} SELECT {_IND} AS indicator, code7, CAST(year AS STRING) AS period, metric, {_SHOWN} FROM ms")
def _(spark, folder):
    return _shown(_municipal(spark, folder), F.col("geographyId").alias("code7"), F.col("metricKind").alias("metric"))


@query("pb05_profiles", f"""
    SELECT code7, {_IND} AS indicator, age_group, sex, CASE WHEN status = 'published' THEN n END AS count, CASE WHEN status <> 'not_applicable' THEN population END AS denominator,
      CASE WHEN status = 'published' THEN round(rate, 6) END AS rate, CASE WHEN status = 'suppressed_complementary' THEN 'suppressed' ELSE status END AS status FROM profile_status""")
def _(spark, folder):
    public = publish.profiles(profile_cells(spark, folder), STANDARD_YEAR, MANIFEST)
    return public.select(
        F.col("municipalityCode").alias("code7"), F.col("indicatorId").alias("indicator"), F.col("ageGroup").alias("age_group"), "sex",
        "count", "denominator", F.round("ratePer100k", 6).alias("rate"), F.col("suppressionStatus").alias("status"),
    )


@query("pb06_comparisons", f"""
    WITH r AS (SELECT year, code7, outcome_id, (sum(n) OVER w - n)::BIGINT AS n, (sum(population) OVER w - population)::BIGINT AS population FROM munimap
      WHERE outcome_id IN ('alzheimer', 'dementias_all') WINDOW w AS (PARTITION BY year, outcome_id))
    SELECT {_IND} AS indicator, code7, CAST(year AS STRING) AS period, population AS denominator, CASE WHEN n >= 5 THEN n END AS count,
      CASE WHEN n >= 5 THEN round(n / population * 100000.0, 5) END AS value FROM r""")
def _(spark, folder):
    rates = map_rates(spark, folder).where(F.col("outcome_id").isin(NEURO))
    rows = publish.comparison_documents(rates, MANIFEST)
    return rows.select(
        F.col("indicatorId").alias("indicator"), F.col("municipalityCode").alias("code7"), "period", F.col("restOfState.denominator").alias("denominator"),
        F.col("restOfState.count").alias("count"), F.round("restOfState.value", 5).alias("value"),
    )


@query("pb07_municipality_summaries", f"""
    WITH {_STD}, sr AS (SELECT code7, outcome_id, sum(s.weight * r.n / r.population * 100000.0) AS rate FROM
        (SELECT code7, outcome_id, age_group, sex, sum(n) OVER w - n AS n, sum(population) OVER w - population AS population FROM profile WHERE outcome_id IN ('alzheimer', 'dementias_all')
         WINDOW w AS (PARTITION BY outcome_id, age_group, sex)) r JOIN standard s USING (age_group, sex) GROUP BY ALL),
      l AS (SELECT * FROM ms WHERE CASE WHEN outcome_id IN ('alzheimer', 'dementias_all') THEN metric <> 'crude_rate_per_100k' ELSE year = 2001 END)
    SELECT 'sim-' || replace(l.outcome_id, '_', '-') AS indicator, l.code7, CAST(l.year AS STRING) AS period, CASE WHEN l.n >= 5 THEN l.n END AS count, CASE WHEN l.n >= 5 THEN round(l.rate, 5) END AS value,
      CASE WHEN l.n < 5 THEN NULL WHEN sr.rate IS NOT NULL THEN round(sr.rate, 5) WHEN st.n >= 5 AND st.n >= l.n THEN round((st.n - l.n) / (st.population - l.population) * 100000.0, 5) END AS rest_value,
      CASE WHEN sr.rate IS NULL AND b.n >= 5 THEN round(b.rate, 5) END AS country_value
    FROM l LEFT JOIN sr USING (code7, outcome_id) LEFT JOIN mort st ON st.year = l.year AND st.outcome_id = l.outcome_id AND st.geography = 'rj_total'
    LEFT JOIN mort b ON b.year = l.year AND b.outcome_id = l.outcome_id AND b.geography = 'brazil_total'""")
def _(spark, folder):
    rest = standardized_rest_of_state(
        profile_cells(spark, folder).where(F.col("outcome_id").isin(NEURO)), population_age_sex(spark, folder),
        "municipality_code_ibge", ["outcome_id"],
    ).select(
        F.col("outcome_id").alias("outcomeId"), F.col("municipality_code_ibge").alias("geographyId"),
        F.col("standardized_rate_per_100k").alias("standardized_rest"),
    )
    rows = publish.municipality_summaries(_municipal(spark, folder), _aggregate(spark, folder), rest)
    return _shown(
        rows, F.col("municipalityCode").alias("code7"), F.round("restOfStateValue", 5).alias("rest_value"),
        F.round("brazilValue", 5).alias("country_value"),
    )


@query("pb08_public_csv", f"""
    SELECT {_IND} AS indicator, geography, CAST(year AS STRING) AS period, n < 5 AS suppressed, {_SHOWN} FROM mort""")
def _(spark, folder):
    path = fresh_path(spark, "public-download")
    sinks.write_public_download(_aggregate(spark, folder), path)
    schema = ", ".join(f"`{f}` string" for f in sinks.DOWNLOAD_FIELDS)
    back = spark.read.schema(schema).csv(path, header=True, enforceSchema=True)
    typed = back.withColumns({"count": F.col("count").cast("long"), "value": F.col("value").cast("double")})
    return _shown(typed, F.col("geographyId").alias("geography"), F.col("suppressed").cast("boolean").alias("suppressed"))


_FILES_SQL = f"""
    files AS (SELECT {_IND} AS indicator, string_agg(geography || ';' || CAST(year AS STRING) || ';' || coalesce(CAST(CASE WHEN n >= 5 THEN n END AS STRING), ''), chr(10) ORDER BY geography, year) || chr(10) AS body
      FROM mort GROUP BY 1)"""


def _written_files(spark, folder):
    """One text file per indicator, its lines in order; then the files as they lie there."""
    path = fresh_path(spark, "release-files")
    line = F.concat_ws(";", "geographyId", "period", F.coalesce(F.col("count").cast("string"), F.lit("")))
    rows = _aggregate(spark, folder).select("indicatorId", "geographyId", "period", line.alias("line"))
    ordered = rows.repartition("indicatorId").sortWithinPartitions("indicatorId", "geographyId", "period")
    ordered.select("indicatorId", "line").write.partitionBy("indicatorId").text(path)
    return provenance.artifact_manifest(spark, {"series": path})


@query("pb09_artifact_manifest", f"WITH {_FILES_SQL} SELECT indicator, 'series' AS \"group\", strlen(body) AS bytes, sha256(body) AS sha256 FROM files")
def _(spark, folder):
    """Checksums of the files written, one per indicator."""
    name = F.regexp_extract("path", r"indicatorId=([^/]+)/", 1)
    return _written_files(spark, folder).select(name.alias("indicator"), "group", "bytes", "sha256")


@query("pb09_release_manifest", f"""
    WITH {_FILES_SQL}, c AS (SELECT section, min(year) AS y0, max(year) AS y1, count(DISTINCT outcome_id) AS k FROM mort JOIN (SELECT DISTINCT outcome_id, section FROM outcomes) USING (outcome_id) GROUP BY 1)
    SELECT release, CASE WHEN release = 'r1' THEN 'public_release_ready' ELSE 'technical_beta_not_for_public_release' END AS status, CASE WHEN release = 'r1' THEN 'approved' ELSE 'pending' END AS epidemiology,
      (SELECT sum(k)::BIGINT FROM c) AS indicators, (SELECT CAST(min(y0) AS INT) FROM c WHERE section = 'cancer') AS cancer_start, (SELECT CAST(max(y1) AS INT) FROM c) AS latest,
      (SELECT string_agg(CAST(year AS STRING), '|' ORDER BY year) FROM (SELECT DISTINCT year FROM death WHERE year NOT IN (SELECT year FROM pop))) AS missing_years,
      (SELECT count(*) FROM files) AS artifacts, (SELECT sum(strlen(body))::BIGINT FROM files) AS bytes, (SELECT sha256(string_agg(sha256(body), '' ORDER BY indicator)) FROM files) AS digest
    FROM (VALUES ('r1'), ('r2')) v(release)""")
def _(spark, folder):
    """A sign-off for r1 opens r1 and leaves r2 waiting."""
    signoff = {"releaseId": "r1", "epidemiologyReview": {"status": "approved"}, "accessibilityReview": {"status": "approved"}}
    name = F.concat(F.regexp_extract("path", r"indicatorId=([^/]+)/", 1), F.lit(".txt"))
    artifacts = _written_files(spark, folder).select(name.alias("path"), "bytes", "sha256")
    labels = literal_map({o.id: o.label for o in outcome_definitions()})
    aggregate = _aggregate(spark, folder)
    records = publish.catalog(aggregate, _municipal(spark, folder), aggregate.select("outcomeId").distinct().withColumn("label", labels[F.col("outcomeId")]))
    years = deaths(spark, folder).select(F.col("source_year").cast("int").alias("year")).distinct()
    missing = years.exceptAll(population(spark, folder).select("year").distinct())
    both = union_all([publish.release_manifest(artifacts, records, missing, signoff, release, True) for release in ("r1", "r2")])
    total = F.aggregate("artifacts", F.lit(0).cast("long"), lambda acc, a: acc + a["bytes"])
    return both.select(
        F.col("releaseId").alias("release"), "status", F.col("publicationGate.epidemiologyReview").alias("epidemiology"), F.col("coverage.indicatorCount").alias("indicators"),
        F.col("coverage.cancerStart").alias("cancer_start"), F.col("coverage.latestObservedYear").alias("latest"), F.array_join("coverage.missingDenominatorYears", "|").alias("missing_years"),
        F.size("artifacts").cast("long").alias("artifacts"), total.alias("bytes"), F.sha2(F.array_join(F.transform("artifacts", lambda a: a["sha256"]), ""), 256).alias("digest"),
    )


@query("pb10_geometry_table", """
    SELECT lpad(CAST(vec_id AS STRING), 7, '0') AS code, 'NATION_' || CAST(vec_id % 25 AS STRING) AS name, vec_id = 7 AS selected,
      array_to_string([CAST((row_number() OVER (ORDER BY vec_id) - 1) * 8 + i AS STRING) for i in range(8)], '|') AS arcs FROM embeddings""")
def _(spark, folder):
    """Vectors as outlines: two polygons of four rings each, named from the nation table."""
    vectors = table(spark, folder, "embeddings").select(F.lpad(F.col("vec_id").cast("string"), 7, "0").alias("code"), "vec_id", "embedding")
    rings = F.transform(F.sequence(F.lit(0), F.lit(1)), lambda p: F.transform(
        F.sequence(F.lit(0), F.lit(3)), lambda r: F.array(F.slice("embedding", p * 32 + r * 8 + 1, 8))
    ))
    nations = table(spark, folder, "nation").select("n_nationkey", F.concat("n_name", F.lit(" - RJ")).alias("municipality_name"))
    names = vectors.join(nations, F.col("vec_id") % 25 == F.col("n_nationkey")).select(
        F.col("code").alias("municipality_code_ibge"), "municipality_name"
    )
    arcs = publish.number_arcs(publish.polygon_rings(vectors.select("code", rings.alias("coordinates"))))
    places = publish.geometry_table(arcs, names, "0000007")
    return places.select("code", "name", F.col("isSelected").alias("selected"), F.array_join("arcs", "|").alias("arcs"))


@query("pb11_monthly_admission_derivation", """
    WITH s AS (SELECT year, month, outcome_id, value AS s, (SELECT v.value FROM adm_monthly v WHERE v.geography = 'volta_redonda' AND v.year = a.year AND v.month = a.month AND v.outcome_id = a.outcome_id) AS c
      FROM adm_monthly a WHERE geography = 'rj_total')
    SELECT year, month, outcome_id, g AS geography, CASE g WHEN 'rj_total' THEN s WHEN 'volta_redonda' THEN c ELSE s - c END AS value FROM s,
      (VALUES ('rj_total'), ('volta_redonda'), ('rest_of_rj_excluding_vr')) v(g) WHERE c IS NOT NULL""")
def _(spark, folder):
    state, city = _admission_tables(spark, folder)
    read = state.join(city.select("year", "month").distinct(), ["year", "month"], "left_semi")
    return products.derived_admissions(read, city).select("year", "month", "outcome_id", "geography", "value")


def _admission_tables(spark, folder):
    """Monthly tables of the state and the city as they are read from pages, with the page and its digest."""
    monthly, keys = monthly_admissions(spark, folder), ["year", "month", "outcome_id", "value"]

    def read(geography, name):
        path = F.concat(F.lit(f"raw/{name}_"), year_month("year", "month"), F.lit(".html"))
        chosen = monthly.where(F.col("geography") == geography).select(*keys, F.lit("33").alias("municipality_code_datasus"), path.alias("source_path"))
        return chosen.withColumn("source_sha256", F.sha2("source_path", 256))

    return read(STATE_TOTAL, "rj_total"), read(SELECTED, "volta_redonda")


_DERIVED_LABELS = ", ".join(f"('{k}', '{v}')" for k, v in ADMISSION_OUTCOME_LABELS.items())


@query("pb11_derived_admission_rows", f"""
    WITH c AS (SELECT *, printf('%04d-%02d', year, month) AS period FROM adm_monthly),
    b AS (SELECT s.year, s.month, s.period, s.outcome_id, s.value AS sv, v.value AS cv, 'raw/rj_total_' || s.period || '.html' AS sp, 'raw/volta_redonda_' || s.period || '.html' AS cp
      FROM c s JOIN c v ON s.geography = 'rj_total' AND v.geography = 'volta_redonda' AND s.period = v.period AND s.outcome_id = v.outcome_id)
    SELECT year, month, period, g AS geography, '33' AS municipality_code_datasus, outcome_id, label AS outcome_label,
      CASE g WHEN 'rj_total' THEN sv WHEN 'volta_redonda' THEN cv ELSE sv - cv END AS value, 'internações agregadas pelo SIH' AS unit,
      CASE g WHEN 'rj_total' THEN sp WHEN 'volta_redonda' THEN cp ELSE sp || ';' || cp END AS source_paths,
      CASE g WHEN 'rj_total' THEN sha256(sp) WHEN 'volta_redonda' THEN sha256(cp) ELSE sha256(sp) || ';' || sha256(cp) END AS source_sha256s
    FROM b JOIN (VALUES {_DERIVED_LABELS}) l(outcome_id, label) USING (outcome_id), (VALUES ('rj_total'), ('volta_redonda'), ('rest_of_rj_excluding_vr')) v(g)""")
def _(spark, folder):
    """Every field of the derived series: period, label, unit, pages and their digests."""
    state, city = _admission_tables(spark, folder)
    return products.derived_admissions(state.join(city.select("year", "month").distinct(), ["year", "month"], "left_semi"), city)


@query("pb13_outcome_counts", """
    SELECT 'SIM' AS source, year, geography, outcome_id, 'óbito' AS outcome_status, 'raw/sim_' || CAST(year AS STRING) || '.csv' AS source_path,
      sha256('SIM' || CAST(year AS STRING)) AS source_sha256, sum(n)::BIGINT AS count FROM death_counts GROUP BY ALL
    UNION ALL SELECT 'SIVEP-SRAG', year, geography, outcome_id, outcome_status, 'raw/sivep_' || CAST(year AS STRING) || '.parquet', sha256('SIVEP-SRAG' || CAST(year AS STRING)), sum(n)::BIGINT FROM notif_counts GROUP BY ALL""")
def _(spark, folder):
    """Counts under all their keys, the file each year came from and its digest among them."""
    def manifest(events, source, prefix, suffix):
        return events.select(F.col("source_year")).distinct().select(
            "source_year", F.concat(F.lit(prefix), "source_year", F.lit(suffix)).alias("source_path"), F.sha2(F.concat(F.lit(source), "source_year"), 256).alias("source_sha256"),
        )

    dead, notified = death_counts(spark, folder), notification_totals(spark, folder)
    counted = [
        products.with_provenance(dead, manifest(dead, "SIM", "raw/sim_", ".csv")),
        products.with_provenance(notified, manifest(notified, "SIVEP-SRAG", "raw/sivep_", ".parquet")),
    ]
    return union_all(counted).groupBy(
        "source", F.col("source_year").cast("int").alias("year"), "geography", "outcome_id", "outcome_status", "source_path", "source_sha256",
    ).agg(F.sum("count").alias("count"))


@query("pb14_population_products", """
    SELECT 'annual' AS product, CAST(year AS STRING) AS part, geography, population FROM pop
    UNION ALL SELECT 'age_sex', age_group || '|' || sex, g, sum(population)::BIGINT FROM state_agesex, (VALUES ('rj_total'), ('volta_redonda'), ('rest_of_rj_excluding_vr')) v(g)
      WHERE g = 'rj_total' OR (g = 'volta_redonda') = (code7 = '3300000') GROUP BY ALL
    UNION ALL SELECT 'standard', age_group || '|' || sex, 'brazil_total', CAST(cell AS BIGINT) FROM standard""")
def _(spark, folder):
    municipal = municipal_population(spark, folder)
    state = state_denominators(state_municipal_population(spark, folder), TERRITORY, MUNICIPALITIES)
    annual = products.population_product(municipal, state, national_denominators(municipal)).select(
        F.lit("annual").alias("product"), F.col("year").cast("string").alias("part"), "geography", "population"
    )
    cell = F.concat_ws("|", "age_group", "sex").alias("part")
    age_sex = age_sex_denominators(state_age_sex(spark, folder), TERRITORY).select(
        F.lit("age_sex").alias("product"), cell, "geography", "population"
    )
    standard = population_age_sex(spark, folder).groupBy("age_group", "sex").agg(F.sum("population").alias("population")).select(
        F.lit("standard").alias("product"), cell, F.lit(COUNTRY_TOTAL).alias("geography"), "population"
    )
    return union_all([annual, age_sex, standard])


@query("pb15_admission_summary", """
    SELECT outcome_id, geography, sum(value)::BIGINT AS total, count(*) AS months, 0::BIGINT AS negatives, min(printf('%04d-%02d', year, month)) AS first_period,
      max(printf('%04d-%02d', year, month)) AS last_period FROM adm GROUP BY ALL""")
def _(spark, folder):
    summary = products.admission_summary(admission_windows(spark, folder))
    return summary.select("outcome_id", "geography", "total", "months", "negatives", "first_period", "last_period")


_COVERAGE_SQL = """
    WITH reported AS (SELECT *, printf('%04d-%02d', year, month) AS period, CASE WHEN month % 3 = 0 THEN 2 ELSE 1 END * CASE WHEN year = 1998 THEN 2 ELSE 1 END AS times FROM adm),
    kept AS (SELECT * FROM reported WHERE month <> 5 OR year <> 1997),
    spans AS (SELECT {keys} min(period) AS first_period, max(period) AS last_period, list(DISTINCT period) AS present, sum(times)::BIGINT AS rows_read, (sum(times) - count(*))::BIGINT AS duplicates_removed,
      count(*) AS months, sum(value)::BIGINT AS total FROM kept GROUP BY ALL)
    SELECT {columns} first_period, last_period, duplicates_removed, 0::BIGINT AS negatives,
      (SELECT coalesce(string_agg(strftime(m, '%Y-%m'), '|' ORDER BY m), '') FROM generate_series(strptime(first_period || '-01', '%Y-%m-%d'), strptime(last_period || '-01', '%Y-%m-%d'), INTERVAL 1 MONTH) g(m)
        WHERE NOT list_contains(present, strftime(m, '%Y-%m'))) AS missing FROM spans"""


def _without_a_month(spark, folder):
    return admission_windows(spark, folder).where("month <> 5 OR year <> 1997")


@query("pb15_admission_summary_coverage", _COVERAGE_SQL.format(keys="outcome_id, geography,", columns="outcome_id, geography, upper(outcome_id) AS outcome_label, total, months,"))
def _(spark, folder):
    """Per outcome and area: label, removed duplicates and missing months; one month was never read."""
    summary = products.admission_summary(_without_a_month(spark, folder))
    return summary.withColumn("missing", F.array_join("missing_periods", "|")).drop("missing_periods")


@query("pb15_admission_coverage", _COVERAGE_SQL.format(keys="", columns="rows_read,"))
def _(spark, folder):
    coverage = products.admission_coverage(_without_a_month(spark, folder))
    return coverage.withColumn("missing", F.array_join("missing_periods", "|")).drop("missing_periods")
