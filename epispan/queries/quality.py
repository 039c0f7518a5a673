"""Data-quality operators (DQ01-DQ11)."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ..fixed_values import (
    AGE_GROUPS, DEATH_REQUIRED, NOTIFICATION_OPTIONAL, NOTIFICATION_REQUIRED, OBSERVATION_FIELDS, PROFILE_FIELDS, PROTECTED_FIELDS, PROTECTED_PROFILE_FIELDS, SEXES,
)
from ..operators import quality
from ..operators.standardize import coverage_gaps
from ..plans import release
from ..plans.products import annual_admission_rates, municipal_profile_counts, municipal_profile_exclusions
from ..plans.publish import municipal_map, observations, profiles, release_status
from ..operators.suppression import protected_leaks
from ..session import fresh_path, materialize, table
from ..sources.files import create_file, list_files
from ..sources.provenance import archive_layout, file_format_check, layout_audit, parquet_layout, raw_file_verdict
from .registry import query
from .standins import (
    MUNICIPALITIES, PROFILE, STANDARD_YEAR, TERRITORY, YEAR_SHIFT, admission_windows, death_rates, deaths, map_rates, monthly_admissions,
    municipal_population, population, population_age_sex, profile_cells, raw_deaths, raw_notifications, spread_folder, state_age_sex,
    write_year_files,
)

def area_code():
    return F.col("municipality_code_ibge").alias("code7")


@query("dq01_layout_audit", """
    SELECT 'full' AS layout, 7 AS columns, '' AS missing, count(*) AS rows FROM lineitem UNION ALL SELECT 'short', 2, 'CAUSABAS|IDADE', count(*) FROM lineitem""")
def _(spark, folder):
    """Two layouts of the death files, one without two required fields."""
    path = fresh_path(spark, "layouts")
    raw_deaths(spark, folder).write.csv(f"{path}/full", sep=";", encoding="ISO-8859-1", header=True)
    raw_deaths(spark, folder).select("CODMUNRES", "SEXO").write.csv(f"{path}/short", sep=";", encoding="ISO-8859-1", header=True)
    audit = layout_audit(spark, f"{path}/*/", DEATH_REQUIRED).withColumn("layout", F.regexp_extract("source_file", r"/(full|short)/", 1))
    return audit.groupBy("layout", "columns", F.array_join("missing", "|").alias("missing")).agg(F.sum("rows").alias("rows"))


def _members(year):
    """The first year has a note only; later ones a sound member, and one that lacks a field in even years."""
    full = ["CODMUNRES", "SEXO", "IDADE", "CAUSABAS", "DTOBITO"]
    if year <= 1995:
        return {"readme.txt": None}
    return {"readme.txt": None, "deaths.CSV": full, "extra.csv": ["CODMUNRES", "SEXO", "CAUSABAS"] if year % 2 == 0 else full[:4]}


@query("dq01_archive_layout", """
    WITH y AS (SELECT DISTINCT year FROM death)
    SELECT year, NULL AS member, NULL AS columns, '' AS missing, 'no_csv_member' AS error FROM y WHERE year <= 1995
    UNION ALL SELECT year, 'deaths.CSV', 5, '', NULL FROM y WHERE year > 1995
    UNION ALL SELECT year, 'extra.csv', CASE WHEN year % 2 = 0 THEN 3 ELSE 4 END, CASE WHEN year % 2 = 0 THEN 'IDADE' ELSE '' END,
      CASE WHEN year % 2 = 0 THEN 'extra.csv:missing:IDADE' END FROM y WHERE year > 1995""")
def _(spark, folder):
    """Archives that hold every row of their year."""
    path = fresh_path(spark, "audited-archives")
    write_year_files(raw_deaths(spark, folder), path, "year", _members)
    audit = archive_layout(list_files(spark, path), DEATH_REQUIRED)
    year = (F.regexp_extract("path", r"sim_(\d{4})", 1).cast("int") - YEAR_SHIFT).alias("year")
    return audit.select(year, "member", "columns", F.coalesce(F.array_join("missing", "|"), F.lit("")).alias("missing"), "error").distinct()


@query("dq01_parquet_layout", """
    SELECT CASE WHEN year <= 1997 THEN 'early' ELSE 'late' END AS layout, CASE WHEN year <= 1997 THEN 6 ELSE 9 END AS columns,
      CASE WHEN year <= 1997 THEN 'EVOLUCAO' ELSE '' END AS missing,
      CASE WHEN year <= 1997 THEN 'CO_MUN_NOT|CS_GESTANT|CS_RACA|DT_EVOLUCA|DT_NOTIFIC|TP_IDADE' ELSE 'CO_MUN_NOT|CS_GESTANT|CS_RACA|DT_EVOLUCA|DT_NOTIFIC' END AS missing_optional,
      count(*) AS rows FROM notif GROUP BY ALL""")
def _(spark, folder):
    """Footers of notification files of two layouts, one without a required field."""
    path, raw = fresh_path(spark, "parquet-layouts"), raw_notifications(spark, folder)
    raw.where("year <= 1997").drop("EVOLUCAO", "TP_IDADE").write.parquet(f"{path}/early")
    raw.where("year > 1997").withColumn("MORE", F.lit(1)).write.parquet(f"{path}/late")
    audit = parquet_layout(spark, f"{path}/*", NOTIFICATION_REQUIRED, NOTIFICATION_OPTIONAL)
    layout = F.regexp_extract("source_file", r"/(early|late)/", 1).alias("layout")
    texts = [F.array_join(c, "|").alias(c) for c in ("missing", "missing_optional")]
    return audit.where("rows > 0").groupBy(layout, "columns", *texts).agg(F.sum("rows").alias("rows"))


@query("dq02_non_negative", "SELECT c_custkey AS id, c_acctbal AS balance FROM customer WHERE c_acctbal < 0")
def _(spark, folder):
    rows = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    return quality.negative_rows(rows, "balance")


@query("dq03_unique_key", """
    SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def _(spark, folder):
    return quality.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq04_grid_completeness", """
    SELECT c_nationkey AS area, count(*) AS rows, count(DISTINCT (c_mktsegment, CAST(floor(c_acctbal / 2000) AS INT))) AS cells FROM customer GROUP BY 1
    HAVING count(*) <> 30 OR count(DISTINCT (c_mktsegment, CAST(floor(c_acctbal / 2000) AS INT))) <> 30""")
def _(spark, folder):
    """Nations whose customers do not fill segment by balance band exactly once."""
    band = F.floor(F.col("c_acctbal") / 2000).cast("int")
    rows = table(spark, folder, "customer").select(F.col("c_nationkey").alias("area"), "c_mktsegment", band.alias("band"))
    return quality.grid_gaps(rows, "area", ["c_mktsegment", "band"], 30)


@query("dq04_area_set_mismatch", """
    SELECT code6, 'only_left' AS side FROM (SELECT DISTINCT code6 FROM death WHERE starts_with(code6, '33')) WHERE code6 NOT IN (SELECT substr(code7, 1, 6) FROM munipop)
    UNION ALL SELECT DISTINCT substr(code7, 1, 6), 'only_right' FROM munipop WHERE substr(code7, 1, 6) NOT IN (SELECT code6 FROM death WHERE starts_with(code6, '33'))""")
def _(spark, folder):
    left = deaths(spark, folder).select(F.col("municipality_code_datasus").alias("code6")).where("code6 LIKE '33%'")
    right = municipal_population(spark, folder).select(F.substring("municipality_code_ibge", 1, 6).alias("code6"))
    return quality.set_mismatch(left, right, "code6")


@query("dq05_standard_cell_coverage", """
    SELECT code7, 16 - count(*) FILTER (WHERE NOT (code7 < '3300055' AND age_group = '75+')) AS missing_cells, 0::BIGINT AS extra_cells FROM state_agesex GROUP BY 1""")
def _(spark, folder):
    """Some areas lose their oldest cells: the check names each of them."""
    cells = state_age_sex(spark, folder).where("NOT (municipality_code_ibge < '3300055' AND age_group = '75+')")
    gaps = coverage_gaps(cells, population_age_sex(spark, folder), ["municipality_code_ibge"])
    return gaps.select(area_code(), "missing_cells", "extra_cells")


@query("dq06_reconciliation", """
    SELECT outcome_id, age_group, sum(n) FILTER (WHERE sex <> 'ignorado')::BIGINT AS expected, 0::BIGINT AS observed FROM profile_base WHERE age_group = '75+'
    GROUP BY ALL HAVING sum(n) FILTER (WHERE sex <> 'ignorado') > 0
    UNION ALL SELECT outcome_id, age_group, 0, sum(n)::BIGINT FROM profile WHERE age_group = '<1' GROUP BY ALL HAVING sum(n) > 0""")
def _(spark, folder):
    """Published cells against classified deaths of known age and sex, each side missing one age group."""
    counts = municipal_profile_counts(deaths(spark, folder), state_age_sex(spark, folder), TERRITORY, PROFILE, STANDARD_YEAR)
    known = counts.where(F.col("age_group").isin(AGE_GROUPS) & F.col("sex").isin(SEXES))
    cells = profile_cells(spark, folder)
    return quality.reconcile(cells.where("age_group <> '75+'"), known.where("age_group <> '<1'"), ["outcome_id", "age_group"])


@query("st08_profile_exclusions", f"""
    WITH d AS (SELECT outcome_id, code6 IN (SELECT substr(code7, 1, 6) FROM state_agesex) AS known, age_group <> 'ignorado' AND sex <> 'ignorado' AS labelled
      FROM death_dim JOIN causes USING (cause) WHERE year = {STANDARD_YEAR} AND outcome_id <> 'covid19' AND regexp_full_match(code6, '33[0-9]{{4}}'))
    SELECT outcome_id, count(*) AS classified, count(*) FILTER (WHERE NOT known) AS excluded_historical_code,
      count(*) FILTER (WHERE known AND NOT labelled) AS excluded_unknown_label, count(*) FILTER (WHERE known AND labelled) AS published FROM d GROUP BY 1""")
def _(spark, folder):
    return municipal_profile_exclusions(deaths(spark, folder), state_age_sex(spark, folder), TERRITORY, PROFILE, STANDARD_YEAR)


_SUFFIX = "CASE doc_id % 5 WHEN 0 THEN 'json' WHEN 1 THEN 'csv' WHEN 2 THEN 'pdf' WHEN 3 THEN 'html' ELSE 'xls' END"


@query("dq07_file_format_check", f"""
    SELECT doc_id, doc_id % 2 = 0 AND doc_id % 5 <> 4 AS format_ok FROM documents""")
def _(spark, folder):
    """Documents wrapped as raw files of several formats; odd ones are left unwrapped and so malformed."""
    wrapped = (
        F.when(F.col("doc_id") % 5 == 0, F.to_json(F.array(F.struct("text"))))
        .when(F.col("doc_id") % 5 == 1, F.concat(F.lit("CODMUNRES;SEXO;IDADE;CAUSABAS\n"), "text"))
        .when(F.col("doc_id") % 5 == 2, F.concat(F.lit("%PDF-1.4\n"), "text"))
        .otherwise(F.concat(F.lit('TabNet Win32 "Total" Sistema de Informações Hospitalares '), "text"))
    )
    body = F.when(F.col("doc_id") % 2 == 0, wrapped).otherwise(F.concat(F.lit("x"), "text"))
    encoded = F.when(F.expr(_SUFFIX) == "html", F.encode(F.regexp_replace(body, r"[^\x{0}-\x{ff}]", "?"), "ISO-8859-1"))
    files = table(spark, folder, "documents").select(
        F.concat(F.lit("/raw/"), "doc_id", F.lit("."), F.expr(_SUFFIX)).alias("path"),
        F.coalesce(encoded, body.cast("binary")).alias("content"),
    )
    number = F.regexp_extract("path", r"/raw/(\d+)\.", 1).cast("long")
    return file_format_check(files).select(number.alias("doc_id"), "format_ok")


_VERDICT_SQL = """
    WITH kinds AS (SELECT doc_id, text, doc_id % 6 AS kind, doc_id % 2 = 0 AS sound, doc_id % 7 <> 3 AS sidecar FROM documents),
    judged AS (SELECT *, CASE kind WHEN 0 THEN '{"json_type": "list"}'
        WHEN 1 THEN '{"columns": 4, "delimiter": ";", "missing_required_fields": ["IDADE"], "required_fields_present": ["CAUSABAS", "CODMUNRES", "SEXO"]}'
        WHEN 2 THEN '{"features": 2, "geojson_type": "FeatureCollection", "json_type": "dict"}'
        WHEN 3 THEN '{"first_members": ["text.txt"], "members": 1}' WHEN 4 THEN '{"columns": 2, "row_groups": 1, "rows": 1}' ELSE '{}' END AS details,
      CASE kind WHEN 1 THEN 'missing_required_fields:IDADE' WHEN 5 THEN 'unsupported_format:.txt' END AS error FROM kinds)
    SELECT doc_id, kind NOT IN (1, 5) AS format_ok, details AS format_details,
      concat_ws('|', CASE WHEN NOT sidecar THEN 'missing_sha256_sidecar' WHEN doc_id % 7 = 4 THEN 'sha256_mismatch' END, error) AS errors,
      sidecar AND doc_id % 7 <> 4 AND kind NOT IN (1, 5) AS ok FROM judged"""


def _raw_file(key, text):
    """A document as a raw file: JSON, CSV without a required field, shapes, an archive, a Parquet table, or a kind without a test."""
    kind = key % 6
    if kind == 0:
        return "json", json.dumps([{"text": text}] * 3).encode()
    if kind == 1:
        return "csv", f"CODMUNRES;SEXO;CAUSABAS;NOTE\n1;2;3;{key}\n{text}".encode("latin1", "replace")
    if kind == 2:
        body = json.dumps({"features": [{"text": text}, {}], "type": "FeatureCollection"}).encode()
        return "geojson", gzip.compress(body, mtime=0) if key % 4 == 0 else body
    out = io.BytesIO()
    if kind == 3:
        with zipfile.ZipFile(out, "w") as archive:
            archive.writestr(zipfile.ZipInfo("text.txt"), text)
        return "zip", out.getvalue()
    if kind == 4:
        pq.write_table(pa.table({"doc_id": [key], "text": [text]}), out)
        return "parquet", out.getvalue()
    return "txt", text.encode()


@query("dq07_raw_file_verdict", _VERDICT_SQL)
def _(spark, folder):
    """Every document written as a raw file of some format, some without a sidecar and some with a wrong one."""
    path = fresh_path(spark, "raw-files")

    def write(batches):
        for batch in batches:
            keys, paths, digests = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                suffix, content = _raw_file(key, text or "")
                keys.append(key)
                paths.append(f"{path}/{spread_folder(key)}/{key}.{suffix}")
                digests.append(hashlib.sha256(content).hexdigest() if key % 7 != 4 else "0" * 64)
                with create_file(paths[-1]) as handle:
                    handle.write(content)
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(keys, pa.int64()), "path": paths, "declared": digests})

    written = materialize(table(spark, folder, "documents").select("doc_id", "text").mapInArrow(write, "doc_id bigint, path string, declared string"), "sidecars")
    name = F.element_at(F.split("path", "/"), -1)
    files = list_files(spark, f"{path}/*")
    sidecars = written.where("doc_id % 7 <> 3").select(name.alias("name"), "declared").join(files.select(name.alias("name"), "path"), "name").drop("name")
    verdict = raw_file_verdict(files, sidecars)
    number = F.regexp_extract("path", r"/(\d+)\.\w+\z", 1).cast("long").alias("doc_id")
    return verdict.select(number, "format_ok", "format_details", F.array_join("errors", "|").alias("errors"), "ok")


@query("dq08_contract_check", """
    SELECT 'sim-' || replace(outcome_id, '_', '-') AS indicator, 'manifestRef' AS missing_field, 'absent' AS breach, count(*) AS records FROM mort GROUP BY 1
    UNION ALL SELECT 'sim-' || replace(outcome_id, '_', '-'), 'dataStatus', 'null', count(*) FROM mort WHERE year = 1999 GROUP BY 1""")
def _(spark, folder):
    """No manifest reference and one year without status break the contract; hidden figures do not."""
    public = observations(death_rates(spark, folder), "SIM", "population", "m.json").drop("manifestRef")
    public = public.withColumn("dataStatus", F.when(F.col("period") != "1999", F.col("dataStatus")))
    gaps = quality.contract_violations(public, OBSERVATION_FIELDS, ["indicatorId"], PROTECTED_FIELDS)
    return gaps.groupBy(F.col("indicatorId").alias("indicator"), "missing_field", "breach").agg(F.count(F.lit(1)).alias("records"))


def _release(spark, folder, tampered: bool):
    """Metrics of the package as written, the way readers will see it; or of one with every rule broken."""
    municipal = materialize(
        observations(map_rates(spark, folder), "SIM", "population", "m.json", "municipality_code_ibge"), "package-municipal"
    )
    national = observations(death_rates(spark, folder), "SIM", "population", "m.json")
    cells = profiles(profile_cells(spark, folder), STANDARD_YEAR, "m.json")
    maps = municipal_map(municipal)
    hidden = F.col("suppressionStatus") == "suppressed"
    if tampered:
        admissions = annual_admission_rates(admission_windows(spark, folder), population(spark, folder))
        year, small = F.col("period").cast("int"), F.col("suppressed")
        broken = national.withColumns({
            "count": F.when(small & (year == 1996), F.lit(1).cast("long")).otherwise(F.col("count")),
            "value": F.when(small & (year == 1997), F.lit(0.5)).otherwise(F.col("value")),
            "suppressed": small & (year != 1996),
            "dataStatus": F.when(year >= 2001, F.lit("provisional")).when(year != 1999, F.col("dataStatus")),
        })
        national = broken.unionByName(observations(admissions, "SIH", "denominator", "m.json"))
        cells = cells.where("municipalityCode <> '3300000'").withColumn(
            "count", F.when(hidden & (F.col("ageGroup") == "<1"), F.lit(3).cast("long")).otherwise(F.col("count"))
        )
        maps = maps.where("indicatorId <> 'sim-asthma'")
    national, cells = materialize(national, "package-series"), materialize(cells, "package-profiles")
    presence = release.indicator_presence(national, maps, cells)
    years = deaths(spark, folder).select(F.col("source_year").cast("int").alias("year")).distinct()
    gaps = years.exceptAll(population(spark, folder).select("year").distinct())
    pending = (F.col("n_nationkey") % 5 == 4) & F.lit(tampered)
    catalog = table(spark, folder, "nation").select(
        F.col("n_name").alias("source_id"), F.when(pending, F.lit("pending")).otherwise(F.lit("verified")).alias("status")
    )
    contract = quality.contract_violations(national, OBSERVATION_FIELDS, ["indicatorId"], PROTECTED_FIELDS).unionByName(
        quality.contract_violations(cells, PROFILE_FIELDS, ["indicatorId"], [*PROTECTED_PROFILE_FIELDS, "denominator"])
    )
    reviews = {"epidemiologyReview": "approved", "accessibilityReview": "pending" if tampered else "approved"}
    return release.release_metrics(
        national, presence, cells, gaps, quality.unverified_sources(catalog), protected_leaks(cells, hidden, PROTECTED_PROFILE_FIELDS),
        protected_leaks(national, F.col("suppressed"), PROTECTED_FIELDS), contract, reviews, release_status(reviews), MUNICIPALITIES,
    )


_METRICS_SQL = """
    sih AS (SELECT year, geography, outcome_id, sum(value) AS n FROM adm WHERE year IN (SELECT year FROM adm_years) GROUP BY ALL),
    m AS (SELECT
      (SELECT count(*) FROM mort) + (SELECT count(*) FROM sih) AS observations,
      (SELECT count(*) FROM mort WHERE n < 5 AND year <> 1996) + (SELECT count(*) FROM sih WHERE n < 5) AS suppressed,
      (SELECT count(*) FROM mort WHERE n < 5 AND year = 1996) AS small_cell_leaks,
      (SELECT count(*) FROM mort WHERE year >= 2001) AS provisional,
      (SELECT count(DISTINCT outcome_id) FROM mort) + (SELECT count(DISTINCT outcome_id) FROM sih) AS indicators,
      (SELECT count(DISTINCT outcome_id) FROM mort WHERE outcome_id = 'asthma') + (SELECT count(DISTINCT outcome_id) FROM sih) AS without_map,
      (SELECT count(DISTINCT outcome_id) FROM sih) AS hospital_without_country,
      (SELECT count(DISTINCT outcome_id) FROM mort WHERE outcome_id = 'covid19') AS death_without_profile,
      (SELECT count(DISTINCT outcome_id) FROM mort) AS claiming_profiles,
      (SELECT count(DISTINCT code7) FROM profile WHERE code7 <> '3300000') AS profile_municipalities,
      (SELECT count(*) FROM (SELECT DISTINCT year FROM death WHERE year NOT IN (SELECT year FROM pop))) AS missing_denominator_years,
      (SELECT count(*) FROM nation WHERE n_nationkey % 5 = 4) AS open_sources,
      (SELECT count(*) FROM profile_status WHERE starts_with(status, 'suppressed') AND age_group = '<1' AND code7 <> '3300000') AS profile_leaks,
      (SELECT count(*) FROM mort WHERE n < 5 AND year IN (1996, 1997)) AS download_leaks,
      (SELECT count(*) FROM mort WHERE year = 1999) AS contract_gaps)"""
_METRIC_NAMES = [
    "observations", "suppressed", "small_cell_leaks", "provisional", "indicators", "without_map", "hospital_without_country", "death_without_profile",
    "claiming_profiles", "profile_municipalities", "missing_denominator_years", "open_sources", "profile_leaks", "download_leaks", "contract_gaps",
]
_FINDINGS_SQL = f"""
    f AS (SELECT * FROM (VALUES ('release-not-public', 'blocker', true), ('review-gates-pending', 'blocker', true)) v(finding_id, severity, fires)
      UNION ALL SELECT v.* FROM m, LATERAL (VALUES ('municipal-map-not-publishable', 'blocker', without_map > 0), ('sih-brazil-comparator-missing', 'blocker', hospital_without_country > 0),
        ('profiles-incomplete', 'blocker', death_without_profile > 0), ('denominator-gaps', 'warning', missing_denominator_years > 0), ('contract-incomplete', 'blocker', contract_gaps > 0),
        ('small-cell-leak', 'blocker', small_cell_leaks > 0), ('download-suppression-leak', 'blocker', download_leaks > 0), ('profile-suppression-leak', 'blocker', profile_leaks > 0),
        ('profile-municipality-coverage', 'blocker', claiming_profiles > 0 AND profile_municipalities <> {MUNICIPALITIES}), ('source-catalog-open-items', 'warning', open_sources > 0),
        ('provisional-observations', 'warning', provisional > 0)) v(finding_id, severity, fires))"""


@query("dq09_release_metrics", f"""
    WITH {_METRICS_SQL} SELECT metric, CAST(amount AS BIGINT) AS amount FROM m UNPIVOT (amount FOR metric IN ({", ".join(_METRIC_NAMES)}))""")
def _(spark, folder):
    """Every figure the rules test, over a package that breaks each of them."""
    metrics = _release(spark, folder, True)
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("long").alias("amount")) for n in _METRIC_NAMES])
    return metrics.select(F.explode(rows).alias("_m")).select("_m.*")


@query("dq09_release_gate", f"WITH {_METRICS_SQL}, {_FINDINGS_SQL} SELECT finding_id, severity FROM f WHERE fires")
def _(spark, folder):
    return release.release_findings(_release(spark, folder, True))


@query("dq09_release_verdict", f"""
    WITH {_METRICS_SQL}, {_FINDINGS_SQL} SELECT 'tampered' AS package, count(*) FILTER (WHERE severity = 'blocker') AS blocker_count, count(*) FILTER (WHERE severity = 'warning') AS warning_count,
      count(*) FILTER (WHERE severity = 'blocker') = 0 AS publication_allowed FROM f WHERE fires
    UNION ALL SELECT 'sound', (death_without_profile > 0)::BIGINT, (missing_denominator_years > 0)::BIGINT, death_without_profile = 0 FROM m""")
def _(spark, folder):
    """Verdicts on the broken package and on the sound one, whose only flaws are those of its sources."""
    verdicts = [
        release.release_gate(release.release_findings(_release(spark, folder, tampered))).withColumn("package", F.lit(name))
        for name, tampered in (("tampered", True), ("sound", False))
    ]
    return verdicts[0].unionByName(verdicts[1])


@query("dq10_source_catalog_status", """
    SELECT n_name AS source_id, 'pending' AS status FROM nation WHERE n_nationkey % 5 = 4""")
def _(spark, folder):
    state = F.when(F.col("n_nationkey") % 5 == 4, F.lit("pending")).when(F.col("n_nationkey") % 5 == 3, F.lit("")).otherwise(F.lit("verified"))
    return quality.unverified_sources(table(spark, folder, "nation").select(F.col("n_name").alias("source_id"), state.alias("status")))


@query("dq11_series_structure_check", """
    WITH e AS (SELECT (datediff('month', min(o_orderdate), max(o_orderdate)) + 1) * 5 * 3 AS expected_rows FROM orders)
    SELECT count(*) AS rows, count(*) FILTER (WHERE value < 0) AS negatives, max(expected_rows)::BIGINT AS expected_rows, CASE WHEN count(*) = max(expected_rows) AND count(*) FILTER (WHERE value < 0) = 0
      THEN 'validated_structure_only_no_epidemiological_estimate' ELSE 'incomplete_or_inconsistent_series' END AS status FROM adm_monthly, e""")
def _(spark, folder):
    span = table(spark, folder, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    months = (span["b"].year - span["a"].year) * 12 + span["b"].month - span["a"].month + 1
    return quality.series_structure(monthly_admissions(spark, folder), months * 5 * 3)
