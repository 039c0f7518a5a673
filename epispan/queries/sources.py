"""Sources and sinks (S01-S17, P07, PB12): files derived from the tables, read back and compared."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..fixed_values import CENSUS_AGE, CENSUS_SEX
from ..functions.text import year_in_name
from ..operators.joins import manifest_lookup
from ..operators.quality import column_profile, row_sequence_ok
from ..operators.rollup import component_sums
from ..plans.harmonize import harmonize_death_files, harmonize_folder
from ..plans.publish import observations
from ..session import fresh_path, table
from ..sources import provenance, sinks, snapshots
from ..sources.config import outcome_dimension
from ..sources.files import create_file, file_digests, list_files
from ..sources.microdata import (
    harmonize_deaths, harmonize_notifications, scan_death_csv, scan_harmonized, scan_notification_parquet, scan_zipped_csv,
)
from ..sources.population import scan_population_age_sex_json, scan_population_json
from ..sources.tables import (
    admission_components, dementia_counts, municipal_rows, page_rows, registry_years, scan_admission_csv,
    scan_registry_csv,
)
from .aggregates import profile_sql
from .registry import query
from .standins import (
    RAW_DEATH, TERRITORY, YEAR_SHIFT, admission_windows, death_counts, death_rates, deaths, map_rates, monthly_admissions,
    municipal_population, population_age_sex, raw_deaths, raw_notifications, spread_folder, write_year_files,
)

_DEATH_KEYS = ["year", "code", "sex_raw", "age_raw", "cause_raw", "death_date"]
_DEATH_SQL = """
    SELECT year, code6 AS code, sex_raw, age_raw, cause_raw, CAST(try_strptime(date_raw, '%d%m%Y') AS DATE) AS death_date, count(*) AS n
    FROM death GROUP BY ALL"""


def _death_csv(spark, folder, numbered=False):
    path = fresh_path(spark, "raw-deaths")
    raw_deaths(spark, folder).write.csv(path, sep=";", encoding="ISO-8859-1", header=True)
    return scan_death_csv(spark, path, numbered)


def _death_tally(harmonized, *extra):
    return harmonized.groupBy(
        *extra,
        F.col("source_year").cast("int").alias("year"), F.col("municipality_code_datasus").alias("code"), "sex_raw",
        "age_raw", F.col("underlying_cause").alias("cause_raw"), "death_date",
    ).agg(F.count(F.lit(1)).alias("n"))


@query("s01_scan_death_csv", _DEATH_SQL)
def _(spark, folder):
    raw = _death_csv(spark, folder)
    return _death_tally(harmonize_deaths(raw, TERRITORY, F.col("year").cast("int")))


@query("s02_scan_zipped_csv", _DEATH_SQL)
def _(spark, folder):
    """Archives written from the table by its tasks, a CSV member and a note in each, streamed back."""
    path, fields = fresh_path(spark, "raw-archives"), [c for c in RAW_DEATH if c != "year"]
    write_year_files(raw_deaths(spark, folder), path, "year", lambda _: {"deaths.CSV": fields, "note.txt": None})
    harmonized = harmonize_deaths(scan_zipped_csv(spark, path, fields), TERRITORY)
    return _death_tally(harmonized.withColumn("source_year", F.col("source_year") - YEAR_SHIFT))


@query("s02_archive_row_numbers", "SELECT year, count(*) AS rows, true AS sequence_ok FROM death GROUP BY 1")
def _(spark, folder):
    """Rows of every archive are numbered from one without a gap."""
    path, fields = fresh_path(spark, "numbered-archives"), [c for c in RAW_DEATH if c != "year"]
    write_year_files(raw_deaths(spark, folder), path, "year", lambda _: {"deaths.CSV": fields})
    scanned = scan_zipped_csv(spark, path, ["CODMUNRES"])
    per_file = row_sequence_ok(scanned, ["source_file"])
    rows = scanned.groupBy("source_file").agg(F.count("source_row_number").alias("rows"))
    year = (year_in_name(F.element_at(F.split("source_file", "/"), -1)) - YEAR_SHIFT).alias("year")
    return rows.join(per_file, "source_file").groupBy(year).agg(F.sum("rows").alias("rows"), F.min("source_row_sequence_ok").alias("sequence_ok"))


@query("s03_scan_notification_parquet", """
    SELECT CAST(coalesce(year(onset), 1900) AS INT) AS year, code6 AS code, upper(sex_code) AS sex_code, CAST(onset AS DATE) AS onset, class_code, outcome_code,
      CASE WHEN year > 1995 THEN unit END AS unit, count(*) AS n FROM notif GROUP BY ALL""")
def _(spark, folder):
    """The first file lacks the age unit, which must not hide it in the second."""
    path = fresh_path(spark, "raw-notifications")
    raw = raw_notifications(spark, folder).withColumn("NOT_WANTED", F.lit("x"))
    raw.where("year <= 1995").drop("TP_IDADE").write.parquet(f"{path}/a")
    raw.where("year > 1995").write.parquet(f"{path}/b")
    scanned = scan_notification_parquet(spark, [f"{path}/a", f"{path}/b"])
    harmonized = harmonize_notifications(scanned, TERRITORY, F.year(F.coalesce("DT_SIN_PRI", F.lit("1900-01-01").cast("date"))))
    return harmonized.groupBy(
        F.col("source_year").cast("int").alias("year"), F.col("municipality_code_datasus").alias("code"),
        F.upper("sex_raw").alias("sex_code"), F.to_date("symptom_onset_date").alias("onset"),
        F.col("final_classification_raw").alias("class_code"), F.col("outcome_raw").alias("outcome_code"),
        F.nullif("age_unit_raw", F.lit("")).alias("unit"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("s03_mixed_layouts", """
    SELECT CAST(coalesce(year(onset), 1900) AS INT) AS year, code6 AS code, CAST(onset AS DATE) AS onset, CAST(CAST(age AS INT) AS STRING) AS age, class_code,
      CASE WHEN year > 1995 THEN unit END AS unit, count(*) AS n FROM notif GROUP BY ALL""")
def _(spark, folder):
    """One glob over files of three layouts: fields absent, in another order, and as numbers, dates or text."""
    path = fresh_path(spark, "mixed-notifications")
    raw = raw_notifications(spark, folder)
    raw.where("year <= 1995").drop("TP_IDADE").write.parquet(f"{path}/a")
    typed = raw.withColumns({
        "NU_IDADE_N": F.col("NU_IDADE_N").cast("int"), "TP_IDADE": F.col("TP_IDADE").cast("double"), "CLASSI_FIN": F.trim("CLASSI_FIN").try_cast("double"),
        "DT_SIN_PRI": F.col("DT_SIN_PRI").cast("date"),
    })
    typed.where("year BETWEEN 1996 AND 1998").select(*reversed(typed.columns)).write.parquet(f"{path}/b")
    raw.where("year > 1998").withColumn("DT_SIN_PRI", F.date_format("DT_SIN_PRI", "yyyyMMdd")).write.parquet(f"{path}/c")
    scanned = scan_notification_parquet(spark, f"{path}/*")
    harmonized = harmonize_notifications(scanned, TERRITORY, F.lit(2000)).withColumn("year", F.year(F.coalesce("symptom_onset_date", F.lit("1900-01-01").cast("date"))))
    return harmonized.groupBy(
        "year", F.col("municipality_code_datasus").alias("code"), F.to_date("symptom_onset_date").alias("onset"), F.col("age_raw").alias("age"),
        F.col("final_classification_raw").alias("class_code"), F.nullif("age_unit_raw", F.lit("")).alias("unit"),
    ).agg(F.count(F.lit(1)).alias("n"))


_SIDRA_HEADER = "Município (Código)"


@query("s04_scan_population_json", """
    SELECT year, code7 AS municipality_code_ibge, municipality_name, population FROM munipop""")
def _(spark, folder):
    path = fresh_path(spark, "population-json")
    entry = F.struct(
        F.col("municipality_code_ibge").cast("int").cast("string").alias("D1C"), F.col("municipality_name").alias("D1N"),
        F.col("year").cast("string").alias("D2C"), F.col("population").cast("string").alias("V"),
    )
    header = F.struct(*[F.lit(x).alias(n) for n, x in [("D1C", _SIDRA_HEADER), ("D1N", "Município"), ("D2C", "Ano (Código)"), ("V", "Valor")]])
    unknown = F.struct(*[F.lit(x).alias(n) for n, x in [("D1C", "3399999"), ("D1N", "?"), ("D2C", "2000"), ("V", "...")]])
    payload = municipal_population(spark, folder).groupBy("year").agg(F.collect_list(entry).alias("rows"))
    lists = payload.select("year", F.to_json(F.concat(F.array(header, unknown), "rows")).alias("value"))
    lists.repartition("year").write.partitionBy("year").text(path)
    return scan_population_json(spark, f"{path}/*/").select(
        "year", "municipality_code_ibge", "municipality_name", "population"
    )


@query("s05_scan_population_age_sex_json", """
    SELECT code7 AS municipality_code_ibge, age_group, sex, CASE WHEN population = 100 THEN 0 ELSE population END AS population,
      CASE WHEN population = 100 THEN 1 ELSE 0 END::BIGINT AS zero_markers FROM agesex""")
def _(spark, folder):
    path = fresh_path(spark, "age-sex-json")
    first_code = {}
    for code, group in CENSUS_AGE.items():
        first_code.setdefault(group, code)
    ages = F.create_map(*[F.lit(x) for g, c in first_code.items() for x in (g, c)])
    sexes = F.create_map(*[F.lit(x) for c, s in CENSUS_SEX.items() for x in (s, c)])
    figure = F.when(F.col("population") == 100, F.lit("-")).otherwise(F.col("population").cast("string"))

    def entry(declaration):
        return F.struct(
            F.col("municipality_code_ibge").alias("D1C"), F.col("municipality_name").alias("D1N"), F.lit("2022").alias("D2C"),
            F.lit("93").alias("D3C"), sexes[F.col("sex")].alias("D4C"), F.lit(declaration).alias("D5C"),
            ages[F.col("age_group")].alias("D6C"), figure.alias("V"),
        )

    both = F.explode(F.array(entry("113635"), entry("0")))
    rows = population_age_sex(spark, folder).select(F.substring("municipality_code_ibge", 1, 3).alias("part"), both.alias("r"))
    lists = rows.groupBy("part").agg(F.to_json(F.collect_list("r")).alias("value"))
    lists.repartition("part").write.partitionBy("part").text(path)
    return scan_population_age_sex_json(spark, f"{path}/*/").select(
        "municipality_code_ibge", "age_group", "sex", "population", F.col("sidra_zero_marker_count").alias("zero_markers")
    )


@query("s06_scan_registry_csv", "SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS cases FROM orders GROUP BY 1")
def _(spark, folder):
    path = fresh_path(spark, "registry")
    per_year = table(spark, folder, "orders").groupBy(F.year("o_orderdate").cast("string").alias("label")).count()
    total = table(spark, folder, "orders").select(F.lit("Total").alias("label")).groupBy("label").count()
    both = per_year.unionByName(total).toDF("Ano do diagnóstico", "Casos")
    both.write.csv(path, sep=";", encoding="ISO-8859-1", header=True, quoteAll=True)
    return registry_years(scan_registry_csv(spark, path))


_PAGE_LABELS = {
    "resp_all": "10 Doen&ccedil;as do aparelho respirat&oacute;rio", "pneumonia": ".. Pneumonia",
    "copd": ".. Bronquite enfisema e outr doen&ccedil; pulm obstr cr&ocirc;n", "asthma": ".. Asma",
    "pneumoconiosis": ".. Pneumoconiose",
}


def _pages(rows, keys, label):
    """One Latin-1 result page per key from (label, value) rows; figures use dots and dashes."""
    figure = F.when(F.col("value") == 0, F.lit("-")).otherwise(F.translate(F.format_number("value", 0), ",", "."))
    lines = F.concat_ws("", F.lit('"'), label, F.lit('";'), figure)
    body = F.array_join(F.array_sort(F.collect_list(lines)), "\n")
    page = F.concat(F.lit("<HTML><TITLE>TabNet</TITLE>\n<PRE>\n"), body, F.lit('\n"Total";1.463\n</PRE></HTML>'))
    return rows.groupBy(*keys).agg(F.encode(page, "ISO-8859-1").alias("content"))


@query("s07_scan_html_table", "SELECT year, month, geography, outcome_id, value FROM adm_monthly")
def _(spark, folder):
    keys = ["year", "month", "geography"]
    labels = F.create_map(*[F.lit(x) for pair in _PAGE_LABELS.items() for x in pair])
    pages = _pages(monthly_admissions(spark, folder), keys, labels[F.col("outcome_id")])
    components = admission_components(page_rows(pages, keep=keys), keys)
    return component_sums(components, keys).select(*keys, "outcome_id", "value")


@query("s07_scan_html_municipal_table", """
    SELECT year, substr(code7, 1, 6) AS municipality_code_datasus, population AS value FROM statepop""")
def _(spark, folder):
    rows = municipal_population(spark, folder).where(F.col("municipality_code_ibge").startswith("33"))
    label = F.concat(F.substring("municipality_code_ibge", 1, 6), F.lit(" MUNIC&Iacute;PIO"))
    pages = _pages(rows.withColumn("value", F.col("population")), ["year"], label)
    return municipal_rows(page_rows(pages, keep=["year"]), ["year"])


@query("s07_scan_html_national_month", """
    SELECT year, outcome_id, sum(value)::BIGINT AS count FROM (
      SELECT year, month, CASE outcome_id WHEN 'asthma' THEN 'alzheimer' ELSE 'dementias_all' END AS outcome_id, value
      FROM adm_base WHERE outcome_id IN ('asthma', 'copd')
      UNION ALL SELECT year, month, 'dementias_all', value FROM adm_base WHERE outcome_id = 'asthma') GROUP BY ALL""")
def _(spark, folder):
    labels = {"asthma": ".. Doen&ccedil;a de Alzheimer", "copd": ".. Dem&ecirc;ncia"}
    keys = ["year", "month"]
    national = monthly_admissions(spark, folder).where("geography <> 'rj_total'").groupBy(*keys, "outcome_id").agg(
        F.sum("value").alias("value")
    )
    label = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])[F.col("outcome_id")]
    pages = _pages(national.where(F.col("outcome_id").isin(list(labels))), keys, label)
    return dementia_counts(page_rows(pages, keep=keys), ["year"])


@query("s08_scan_admission_csv_glob", """
    WITH rows AS (SELECT year, month, geography, outcome_id, value, 1995 AS window_start FROM adm_monthly WHERE year <= 1998
      UNION ALL SELECT year, month, geography, outcome_id, value + CASE WHEN year = 1998 THEN 1 ELSE 0 END, 1998 FROM adm_monthly WHERE year >= 1998)
    SELECT year, month, geography, outcome_id, value, window_start, CASE WHEN month % 3 = 0 THEN 2 ELSE 1 END AS place FROM rows
    UNION ALL SELECT year, month, geography, outcome_id, value * 2 + 9, window_start, 1 FROM rows WHERE month % 3 = 0""")
def _(spark, folder):
    path = fresh_path(spark, "admission-windows")
    rows = admission_windows(spark, folder).select(
        "year", "month", F.format_string("%04d-%02d", "year", "month").alias("period"), "geography",
        F.lit("330000").alias("municipality_code_datasus"), "outcome_id", "outcome_label", "value", F.lit("AIH").alias("unit"),
        F.lit("").alias("source_paths"), F.lit("").alias("source_sha256s"), "source_file", "source_row_number",
    )
    keys = ["year", "month", "geography", "outcome_id"]
    for name in ("window_1995_1998", "window_1998_2001"):
        window = rows.where(F.col("source_file") == name).repartition(*keys).sortWithinPartitions(*keys, "source_row_number")
        window.drop("source_file", "source_row_number").write.csv(f"{path}/{name}", header=True)
    start = F.regexp_extract("source_file", r"window_(\d{4})", 1).cast("int")
    scanned = scan_admission_csv(spark, f"{path}/window_*")
    place = F.row_number().over(Window.partitionBy(*keys, "window_start").orderBy("source_row_number"))
    return scanned.withColumn("window_start", start).select(*keys, "value", "window_start", place.alias("place"))


@query("s09_scan_parquet_glob_years", """
    SELECT year, code6 AS code, count(*) AS n FROM death WHERE year IN (1996, 1999, 2001) GROUP BY ALL""")
def _(spark, folder):
    path = fresh_path(spark, "harmonized-years")
    sinks.write_table(deaths(spark, folder), path, ["source", "source_year"])
    chosen = scan_harmonized(spark, path, [1996, 1999, 2001])
    return chosen.groupBy(
        F.col("source_year").cast("int").alias("year"), F.col("municipality_code_datasus").alias("code")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("s10_latest_validated_snapshot", """
    SELECT year, code7, outcome_id, n AS count FROM munimap WHERE year = 2000""")
def _(spark, folder):
    """Odd years failed validation, so 2000 is the latest usable snapshot."""
    rows = map_rates(spark, folder).withColumn("source", F.lit("SIM"))
    state = F.when(F.col("year") % 2 == 0, F.lit("validated_sim_municipal")).otherwise(F.lit("failed"))
    manifest = rows.select("source", "year").distinct().withColumn("status", state)
    valid = snapshots.validated_rows(rows, manifest, snapshots.valid_status())
    latest = snapshots.latest_snapshot(valid, ["outcome_id"])
    return latest.select("year", F.col("municipality_code_ibge").alias("code7"), "outcome_id", "count")


@query("s11_config_dimensions", """
    SELECT section, outcome_id, outcome_label, count(*) AS ranges, max(n)::BIGINT AS deaths FROM defs
    JOIN outcomes USING (outcome_id) JOIN (SELECT outcome_id, sum(n) AS n FROM death_base GROUP BY 1) USING (outcome_id) GROUP BY ALL""")
def _(spark, folder):
    totals = death_counts(spark, folder).where("geography = 'brazil_total'").groupBy("outcome_id").agg(F.sum("count").alias("deaths"))
    ranges = outcome_dimension(spark, "SIM").groupBy("section", "outcome_id", "outcome_label").agg(F.count(F.lit(1)).alias("ranges"))
    return totals.join(ranges, "outcome_id")


@query("s12_sink_parquet", """
    SELECT CAST(year AS INT) AS source_year, outcome_id, geography, sum(n)::BIGINT AS count FROM death_counts GROUP BY ALL""")
def _(spark, folder):
    path = fresh_path(spark, "outcome-counts")
    written = sinks.write_table(death_counts(spark, folder), path, ["source", "source_year"])
    return written.groupBy("source_year", "outcome_id", "geography").agg(F.sum("count").alias("count"))


_RATES_SQL = """
    SELECT 'sim-' || replace(outcome_id, '_', '-') AS indicator, geography, CAST(year AS STRING) AS period,
      CASE WHEN n >= 5 THEN n END AS count, CASE WHEN n >= 5 THEN round(rate, 6) END AS value, n < 5 AS suppressed FROM mort"""


def _observed(spark, folder):
    return observations(death_rates(spark, folder), "SIM", "population", "manifest.json")


@query("s13_sink_csv", _RATES_SQL)
def _(spark, folder):
    path = fresh_path(spark, "download")
    sinks.write_public_download(_observed(spark, folder), path)
    back = spark.read.csv(path, header=True)
    first = next(c for c in back.columns if c.endswith("indicatorId"))
    return back.select(
        F.col(f"`{first}`").alias("indicator"), F.col("geographyId").alias("geography"), "period",
        F.col("count").cast("long"), F.round(F.col("value").cast("double"), 6).alias("value"),
        F.col("suppressed").cast("boolean"),
    )


@query("s14_sink_json_per_key", _RATES_SQL)
def _(spark, folder):
    path = fresh_path(spark, "series-json")
    rows = _observed(spark, folder)
    sinks.write_json_per_key(rows, path, "indicatorId", ["geographyId", "period"])
    schema = "geographyId string, period string, count long, value double, suppressed boolean, indicatorId string"
    back = spark.read.schema(schema).json(path)
    return back.select(
        F.col("indicatorId").alias("indicator"), F.col("geographyId").alias("geography"), "period", "count",
        F.round("value", 6).alias("value"), "suppressed",
    )


@query("s14_nested_documents", """
    SELECT 'sim-' || replace(outcome_id, '_', '-') AS indicator, CAST(year AS STRING) AS period, 4::BIGINT AS areas, sum(CASE WHEN n >= 5 THEN n ELSE 0 END)::BIGINT AS shown
    FROM mort GROUP BY ALL""")
def _(spark, folder):
    slim = _observed(spark, folder).select("indicatorId", "period", "geographyId", "count")
    nested = sinks.nested_documents(slim, ["indicatorId", "period"], ["geographyId"])
    shown = F.aggregate("observations", F.lit(0).cast("long"), lambda acc, o: acc + F.coalesce(o["count"], F.lit(0)))
    return nested.select(
        F.col("indicatorId").alias("indicator"), "period", F.size("observations").cast("long").alias("areas"), shown.alias("shown")
    )


def _document_files(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select(F.concat(F.lit("/raw/"), F.col("doc_id")).alias("path"), F.col("text").cast("binary").alias("content"))


@query("s15_file_checksum_manifest", """
    SELECT '/raw/' || CAST(doc_id AS STRING) AS path, strlen(text) AS bytes, sha256(text) AS sha256, doc_id % 10 <> 3 AND doc_id % 10 <> 7 AS hash_ok,
      CASE WHEN doc_id % 10 = 3 THEN 'missing_sha256_sidecar' WHEN doc_id % 10 = 7 THEN 'sha256_mismatch' ELSE 'ok' END AS hash_status FROM documents""")
def _(spark, folder):
    """Every document as one file; some sidecars are absent and some declare a wrong digest."""
    manifest = provenance.checksum_manifest(_document_files(spark, folder))
    declared = F.when(F.col("doc_id") % 10 == 7, F.lit("0" * 64)).otherwise(F.sha2("text", 256))
    sidecars = table(spark, folder, "documents").where("doc_id % 10 <> 3").select(
        F.concat(F.lit("/raw/"), F.col("doc_id")).alias("path"), declared.alias("declared")
    )
    return provenance.sidecar_status(manifest, sidecars).drop("declared")


def _written_documents(spark, folder, name):
    """Every document as a file of its own, written by the tasks that hold it; returns a glob of their folders."""
    path = fresh_path(spark, name)

    def write(batches):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with create_file(f"{path}/{spread_folder(key)}/{key}.txt") as handle:
                    handle.write((text or "").encode())
            yield batch.select([0])

    table(spark, folder, "documents").select("doc_id", "text").mapInArrow(write, "doc_id bigint").agg(F.count("doc_id")).collect()
    return f"{path}/*"


@query("s15_streamed_digests", """
    SELECT doc_id, strlen(text) AS bytes, sha256(text) AS sha256 FROM documents""")
def _(spark, folder):
    """Files written, listed, and digested as streams."""
    path = _written_documents(spark, folder, "document-files")
    number = F.regexp_extract("path", r"/(\d+)\.txt", 1).cast("long").alias("doc_id")
    return file_digests(list_files(spark, path)).select(number, "bytes", "sha256")


@query("s16_append_extraction_log", """
    SELECT CASE WHEN o_orderstatus = 'P' THEN 'empty' ELSE lower(o_orderstatus) END AS status, count(*) * 2 AS entries FROM orders GROUP BY 1""")
def _(spark, folder):
    """Two appends of the same entries: the log keeps both."""
    path = fresh_path(spark, "extraction-log")
    state = F.when(F.col("o_orderstatus") != "P", F.lower("o_orderstatus"))
    entries = table(spark, folder, "orders").select(F.col("o_orderkey").alias("extraction_id"), state.alias("status"))
    for _ in range(2):
        provenance.append_extraction_log(entries, path)
    return provenance.status_histogram(spark.read.csv(path, header=True))


@query("s17_manifest_upsert", """
    SELECT CAST(year AS INT) AS year, CASE WHEN year >= 2000 THEN 'rerun' ELSE 'first' END AS run, count(*) AS rows FROM death GROUP BY ALL""")
def _(spark, folder):
    entries = deaths(spark, folder).groupBy(F.col("source_year").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("rows"))
    first = entries.withColumn("run", F.lit("first"))
    rerun = entries.where("year >= 2000").withColumn("run", F.lit("rerun"))
    return provenance.upsert_manifest(first, rerun, "year")


@query("s17_run_years", f"""
    WITH entries AS (SELECT year, count(*) AS rows, count(*) FILTER (WHERE code6 = '{TERRITORY.selected_code6}') AS city_rows FROM death
      WHERE NOT (year IN (1997, 2000) AND sex_raw = '1') GROUP BY 1)
    SELECT year, rows, city_rows, rows AS table_rows, CASE WHEN year IN (1997, 2000) THEN 'zip' ELSE 'csv' END AS kind FROM entries""")
def _(spark, folder):
    """A folder harmonised once, then two years again from new archives: their entries and rows change, the others stay."""
    path, target, manifest = (fresh_path(spark, n) for n in ("yearly-raw", "yearly-table", "yearly-manifest"))
    raw, fields = raw_deaths(spark, folder), [c for c in RAW_DEATH if c != "year"]
    write_year_files(raw, f"{path}/first", "year")
    harmonize_folder(spark, f"{path}/first", TERRITORY, target, manifest)
    again = raw.where("year IN (1997, 2000) AND trim(replace(SEXO, '.', '')) <> '1'")
    write_year_files(again, f"{path}/again", "year", lambda _: {"deaths.csv": fields})
    entries = harmonize_folder(spark, f"{path}/again", TERRITORY, target, manifest, years=[2017, 2020])
    held = spark.read.parquet(target).groupBy("source_year").agg(F.count(F.lit(1)).alias("table_rows"))
    kind = F.element_at(F.split(F.element_at("source_files", 1), r"\."), -1)
    return entries.join(held, "source_year").select((F.col("source_year") - YEAR_SHIFT).cast("int").alias("year"), "rows", "city_rows", "table_rows", kind.alias("kind"))


@query("p07_source_row_number", "SELECT count(*) AS rows, true AS sequence_ok FROM lineitem")
def _(spark, folder):
    numbered = _death_csv(spark, folder, numbered=True)
    per_file = row_sequence_ok(numbered, ["source_file"])
    rows = numbered.agg(F.count("source_row_number").alias("rows"))
    return per_file.agg(F.min("source_row_sequence_ok").alias("sequence_ok")).select(rows.scalar().alias("rows"), "sequence_ok")


_DEATH_CHECKS = {
    **{("missing", c): "false" for c in ("source", "source_file", "source_row_number", "residence_code_valid", "residence_is_vr")},
    **{("missing", c): "true" for c in ("multiple_cause_raw", "birth_date_raw", "birth_date", "death_type_raw", "status_raw")},
    ("missing", "municipality_code_datasus"): "code6 = ''", ("missing", "municipality_code_occurrence"): "false", ("missing", "sex_raw"): "sex_raw = ''",
    ("missing", "age_raw"): "age_raw = ''", ("missing", "underlying_cause"): "cause_raw = ''", ("missing", "death_date_raw"): "date_raw = ''",
    ("missing", "death_date"): "try_strptime(date_raw, '%d%m%Y') IS NULL", ("date_parse_failure", "death_date_raw"): "try_strptime(date_raw, '%d%m%Y') IS NULL",
    ("invalid_residence", "residence_code_valid"): "NOT regexp_full_match(code6, '[0-9]{6}')",
}


@query("pb12_harmonize", profile_sql(_DEATH_CHECKS, "death"))
def _(spark, folder):
    """CSV to harmonised table with row numbers, then the quality profile of every column."""
    harmonized = harmonize_deaths(_death_csv(spark, folder, numbered=True), TERRITORY, F.col("year").cast("int"))
    profile = column_profile(harmonized, ["source_year"], {"death_date_raw": "death_date"})
    return profile.select(F.col("source_year").cast("int").alias("year"), "check", F.col("column").alias("column_name"), "failures", "rows")


@query("pb12_harmonize_folder", """
    SELECT CASE WHEN year <= 1995 THEN 1 WHEN year <= 1998 THEN 2 ELSE 3 END AS layout, year, code6 AS code, sex_raw, age_raw, cause_raw,
      CASE WHEN year > 1995 THEN CAST(try_strptime(date_raw, '%d%m%Y') AS DATE) END AS death_date, count(*) AS n
    FROM death GROUP BY ALL""")
def _(spark, folder):
    """A folder of files with three layouts: the first lacks optional fields, the second is reordered, the third has one more."""
    path = fresh_path(spark, "raw-folder")
    raw = raw_deaths(spark, folder)
    layouts = [
        raw.where("year <= 1995").select("CODMUNRES", "SEXO", "IDADE", "CAUSABAS", "year"),
        raw.where("year BETWEEN 1996 AND 1998").select(*reversed(raw.columns)),
        raw.where("year >= 1999").withColumn("EXTRA", F.lit("x")),
    ]
    for number, rows in enumerate(layouts, 1):
        rows.write.csv(f"{path}/layout_{number}", sep=";", encoding="ISO-8859-1", header=True)
    harmonized = harmonize_death_files(spark, f"{path}/*/", TERRITORY, F.col("year").cast("int"))
    layout = F.regexp_extract("source_file", r"layout_(\d)", 1).cast("int")
    return _death_tally(harmonized.withColumn("layout", layout), layout.alias("layout"))


@query("pb12_harmonize_mixed_folder", """
    SELECT year, code6 AS code, sex_raw, age_raw, cause_raw, CASE WHEN year % 2 = 0 THEN CAST(try_strptime(date_raw, '%d%m%Y') AS DATE) END AS death_date, count(*) AS n
    FROM death GROUP BY ALL""")
def _(spark, folder):
    """One call over a folder of plain files (odd years, without optional fields) and archives (even years)."""
    path, raw = fresh_path(spark, "mixed-raw"), raw_deaths(spark, folder)
    write_year_files(raw.where("year % 2 = 1").select("CODMUNRES", "SEXO", "IDADE", "CAUSABAS", "year"), path, "year")
    fields = [c for c in RAW_DEATH if c != "year"]
    write_year_files(raw.where("year % 2 = 0"), path, "year", lambda _: {"deaths.csv": fields, "note.txt": None})
    harmonized = harmonize_death_files(spark, path, TERRITORY)
    return _death_tally(harmonized.withColumn("source_year", F.col("source_year") - YEAR_SHIFT))


@query("j10_manifest_lookup", """
    SELECT code6 AS code, year, count(*) AS n, 'sha-' || CAST(year AS STRING) AS source_sha256 FROM death GROUP BY ALL""")
def _(spark, folder):
    counted = deaths(spark, folder).groupBy(
        F.col("municipality_code_datasus").alias("code"), F.col("source_year").cast("int").alias("year"),
        F.concat(F.lit("out_"), F.col("source_year")).alias("output_path"),
    ).agg(F.count(F.lit(1)).alias("n"))
    manifest = counted.select("output_path").distinct().withColumn(
        "source_sha256", F.concat(F.lit("sha-"), F.substring("output_path", 5, 4))
    )
    return manifest_lookup(counted, manifest, "output_path").drop("output_path")
