import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from epispan.fixed_values import Territory, outcome_definitions
from epispan.plans import products, publish, release
from epispan.streaming.incremental import count_new_files, merged_counts

DATA = "/root/testdata/sf0.001"
CITY = Territory("33", "330000", "3300000")


def test_every_statement_has_a_query_and_columns_agree():
    queries, statements = contract.queries(), contract.oracle_sql()
    assert set(statements) <= set(queries)
    own = contract.all_queries()
    assert set(own) == set(contract.all_sql()) and set(own) <= set(queries)
    con = duckdb.connect()
    for name in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    for sql in statements.values():
        con.execute(f"EXPLAIN {sql}")


@pytest.mark.parametrize("name", ["entry_outcome_rate_vs_rest", "a02_territory_rollup", "w08_series_summary", "pb07_municipality_summaries"])
def test_query_matches_its_statement(spark, name):
    con = duckdb.connect()
    for view in ("nation", "customer", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{DATA}/{view}.parquet'")
    df = contract.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(repr([r[c] for c in columns]) for r in df.collect())
    want = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert got == sorted(repr([row[names.index(c)] for c in columns]) for row in want.fetchall())


def _deaths(spark):
    rows = [(2020, "330000", "1", "480", "C349")] * 6 + [(2020, "330010", "2", "401", "J189")] * 3 + [(2020, "355030", "1", "430", "C34")]
    return spark.createDataFrame(rows, "source_year int, municipality_code_datasus string, sex_raw string, age_raw string, underlying_cause string")


def _population(spark):
    rows = [(2020, "rj_total", 3000), (2020, "volta_redonda", 1000), (2020, "rest_of_rj_excluding_vr", 2000), (2020, "brazil_total", 9000)]
    return spark.createDataFrame(rows, "year int, geography string, population long").withColumn("source_status", F.lit("census"))


def test_death_rates_fill_the_grid_and_compare_with_the_rest(spark):
    counts = products.death_outcome_counts(_deaths(spark), CITY)
    rates = products.mortality_rates(counts, _population(spark))
    got = {(r["outcome_id"], r["geography"]): r for r in rates.collect()}
    assert got["lung", "volta_redonda"]["rate_per_100k"] == 600.0
    assert got["lung", "rest_of_rj_excluding_vr"]["count"] == 0
    assert got["lung", "brazil_total"]["count"] == 7
    assert got["pneumonia", "volta_redonda"]["rate_ratio_vr_vs_rest"] == 0.0
    assert got["lung", "volta_redonda"]["rate_ratio_vr_vs_rest"] is None
    assert len(got) == 4 * 5  # lung, all cancers, pneumonia, all respiratory, cardiorespiratory


def test_map_counts_keep_only_the_state(spark):
    people = spark.createDataFrame([(2020, "3300000", 1000), (2020, "3300101", 500)], "year int, municipality_code_ibge string, population long")
    deaths = _deaths(spark).withColumn("residence_code_valid", F.lit(True))
    definitions = [d for d in outcome_definitions("SIM") if d.id == "lung"]
    got = products.municipal_map_rates(deaths, people, CITY, definitions).collect()
    assert {r["municipality_code_ibge"]: r["count"] for r in got} == {"3300000": 6, "3300101": 0}


def test_overlapping_windows_and_incomplete_years(spark):
    months = [(y, m, "rj_total", "resp_all", 10, "w1") for y in (2019, 2020) for m in range(1, 13)][:-1]
    months += [(2019, m, "rj_total", "resp_all", 20, "w2") for m in range(1, 13)]
    windows = spark.createDataFrame(
        [(y, m, g, o, v, f, "L", i) for i, (y, m, g, o, v, f) in enumerate(months)],
        "year int, month int, geography string, outcome_id string, value long, source_file string, outcome_label string, source_row_number long",
    )
    people = spark.createDataFrame([(y, "rj_total", 1000, "e") for y in (2019, 2020)], "year int, geography string, population long, source_status string")
    got = products.annual_admission_rates(windows, people).collect()
    assert [(r["year"], r["count"]) for r in got] == [(2019, 240)]


def _observation(spark, rows):
    schema = "indicatorId string, source string, outcomeId string, geographyId string, period string, metricKind string, value double, count long, denominator long, dataStatus string, suppressed boolean"
    return spark.createDataFrame(rows, schema)


def test_summary_compares_with_the_state_without_the_city(spark):
    city = _observation(spark, [("sim-x", "SIM", "x", "3300000", "2022", "crude_rate_per_100k", 10.0, 10, 100000, "source_observed", False)])
    state = _observation(spark, [
        ("sim-x", "SIM", "x", "rj_total", "2022", "crude_rate_per_100k", 20.0, 200, 1000000, "source_observed", False),
        ("sim-x", "SIM", "x", "brazil_total", "2022", "crude_rate_per_100k", 30.0, 3000, 10000000, "source_observed", False),
    ])
    none = spark.createDataFrame([], "outcomeId string, geographyId string, standardized_rest double")
    row = publish.municipality_summaries(city, state, none).collect()[0]
    assert row["restOfStateValue"] == pytest.approx(190 / 900000 * 100000) and row["brazilValue"] == 30.0


def test_coordinates_round_and_rings_number_across_areas(spark):
    shapes = [("b", [[[[1.1234567, 2.0]], [[3.0, 4.0]]]]), ("a", [[[[5.0, 6.0]]], [[[7.0, 8.0]]]])]
    features = spark.createDataFrame(shapes, "code string, coordinates array<array<array<array<double>>>>")
    got = {(r["code"], r["polygon"], r["ring"]): (r["arc"], r["points"]) for r in publish.number_arcs(publish.polygon_rings(features)).collect()}
    assert [got["a", 0, 0][0], got["a", 1, 0][0], got["b", 0, 0][0], got["b", 0, 1][0]] == [0, 1, 2, 3]
    assert got["b", 0, 0][1] == [[1.12346, 2.0]]


def test_release_rules_fire_one_by_one(spark):
    clean = {
        "release_status": "public_release_ready", "pending_gates": 0, "without_map": 0, "hospital_without_country": 0,
        "death_without_profile": 0, "missing_denominator_years": 0, "contract_gaps": 0, "small_cell_leaks": 0,
        "download_leaks": 0, "profile_leaks": 0, "profile_municipalities": 92, "expected_municipalities": 92, "open_sources": 0,
        "provisional": 0, "claiming_profiles": 3,
    }
    def findings(**change):
        frame = spark.createDataFrame([tuple((clean | change).values())], list(clean))
        found = release.release_findings(frame)
        return {r["finding_id"] for r in found.collect()}, release.release_gate(found).collect()[0]["publication_allowed"]

    assert findings() == (set(), True)
    assert findings(profile_leaks=1) == ({"profile-suppression-leak"}, False)
    assert findings(provisional=3) == ({"provisional-observations"}, True)
    assert findings(profile_municipalities=0) == ({"profile-municipality-coverage"}, False)
    assert findings(profile_municipalities=0, claiming_profiles=0) == (set(), True)
    assert findings(profile_municipalities=91) == ({"profile-municipality-coverage"}, False)
    assert findings(release_status="technical_beta", pending_gates=2)[0] == {"release-not-public", "review-gates-pending"}


def test_new_files_add_to_the_monthly_totals_once(spark, tmp_path):
    source, output, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    events = spark.createDataFrame([("2020-01", 1), ("2020-01", 2), ("2020-02", 3)], "period string, id int")
    def count(batch):
        return batch.groupBy("period").agg(F.count(F.lit(1)).alias("count"))

    for _ in range(2):
        events.write.mode("append").parquet(source)
        count_new_files(spark, source, events.schema, count, output, marks).awaitTermination()
    got = {r["period"]: r["count"] for r in merged_counts(spark, output, ["period"], ["count"]).collect()}
    assert got == {"2020-01": 4, "2020-02": 2}


def test_contract_loads_before_any_session_exists():
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = str(Path(contract.__file__).parent)
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert [int(n) for n in done.stdout.split()] == [len(contract.queries()), len(contract.oracle_sql())]


def test_derived_admissions_need_every_city_month(spark):
    columns = "year int, month int, outcome_id string, value long, municipality_code_datasus string, source_path string, source_sha256 string"
    state = spark.createDataFrame([(2020, 1, "asthma", 9, "33", "s1", "h1"), (2020, 1, "copd", 4, "33", "s1", "h1"), (2020, 2, "asthma", 3, "33", "s2", "h2")], columns)
    city = spark.createDataFrame([(2020, 1, "asthma", 2, "33", "c1", "g1"), (2020, 3, "asthma", 1, "33", "c3", "g3")], columns)
    with pytest.raises(Exception, match="no city table for.*\"month\":2"):
        products.derived_admissions(state, city).collect()
    rows = products.derived_admissions(state.where("month = 1"), city).collect()
    assert {(r["geography"], r["outcome_id"], r["value"], r["period"], r["source_paths"], r["source_sha256s"]) for r in rows} == {
        ("rj_total", "asthma", 9, "2020-01", "s1", "h1"), ("volta_redonda", "asthma", 2, "2020-01", "c1", "g1"),
        ("rest_of_rj_excluding_vr", "asthma", 7, "2020-01", "s1;c1", "h1;g1"),
    }
    assert {(r["unit"], r["municipality_code_datasus"]) for r in rows} == {("internações agregadas pelo SIH", "33")}


def test_admission_summary_counts_duplicates_and_names_gaps(spark):
    def row(month, value, line, outcome="asthma"):
        return 2020, month, "rj_total", outcome, outcome.upper(), value, "f", line

    columns = "year int, month int, geography string, outcome_id string, outcome_label string, value long, source_file string, source_row_number long"
    windows = spark.createDataFrame([row(1, 5, 1), row(1, 7, 2), row(4, -1, 3), row(2, 1, 4, "copd"), row(2, 1, 5, "copd"), row(2, 1, 6, "copd")], columns)
    got = {r["outcome_id"]: r for r in products.admission_summary(windows).collect()}
    assert (got["asthma"]["total"], got["asthma"]["duplicates_removed"], got["asthma"]["missing_periods"], got["asthma"]["negatives"]) == (6, 1, ["2020-02", "2020-03"], 1)
    assert (got["copd"]["outcome_label"], got["copd"]["duplicates_removed"], got["copd"]["missing_periods"]) == ("COPD", 2, [])
    whole = products.admission_coverage(windows).collect()[0]
    assert (whole["rows_read"], whole["duplicates_removed"], whole["first_period"], whole["last_period"], whole["missing_periods"]) == (6, 3, "2020-01", "2020-04", ["2020-03"])


def test_public_rows_name_basis_and_manifest(spark):
    columns = "outcome_id string, geography string, year int, count long, population long, rate_per_100k double, rate_ci_lower_per_100k double, rate_ci_upper_per_100k double, period_status string"
    rates = spark.createDataFrame([(o, "g", 2024, 9, 100, 1.0, 0.5, 2.0, "x") for o in ("alzheimer", "lung")], columns)

    def refs(source, area="geography", manifest=None):
        renamed = rates.withColumnRenamed("geography", area)
        return {r["outcomeId"]: (r["manifestRef"], r["geographyBasis"]) for r in publish.observations(renamed, source, "population", manifest, area).collect()}

    assert refs("SIM") == {"alzheimer": ("reports/quality/sim_neurological_rates_manifest.json", "residence"), "lung": ("reports/quality/sim_mortality_rates_manifest.json", "residence")}
    assert refs("SIH")["lung"][0] == "reports/quality/respiratory_rates_manifest.json" and refs("SIH")["alzheimer"][0] == "reports/quality/sih_neurological_rates_manifest.json"
    assert refs("SIH", "municipality_code_ibge")["alzheimer"][0] == "reports/quality/sih_municipal_map_2024_manifest.json"
    assert refs("SIM", "municipality_code_ibge")["lung"][0] == "reports/quality/sim_municipal_map_2024_manifest.json"
    assert refs("SIM", manifest="m.json")["lung"][0] == "m.json"
