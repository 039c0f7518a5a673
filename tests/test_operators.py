import random

import pytest
from pyspark.sql import functions as F

from epispan.fixed_values import PROTECTED_FIELDS, ComparatorSet, Territory, comparator_sets, outcome_definitions
from epispan.functions import periods
from epispan.functions.text import normalize_code
from epispan.operators import joins, quality, rollup, series
from epispan.operators.classify import cause_map, classified_counts, classified_events
from epispan.operators.comparators import compare_with_sets, membership
from epispan.operators.filters import find_by_name, search_text
from epispan.operators.suppression import (
    complementary_suppression, mark_not_applicable, protect_profile, protected_leaks, suppress_observations,
)
from epispan.sources.config import load_comparators

DEFS = outcome_definitions("SIM")


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_an_event_counts_in_every_outcome_it_matches(spark):
    events = spark.createDataFrame([("J18.9",), ("j189",), ("I219",), ("X99",), (None,)], "cause_raw string")
    counts = as_dict(classified_counts(events, "cause_raw", DEFS, []), "outcome_id", "count")
    assert counts == {
        "resp_all": 2, "pneumonia": 2, "cardiorespiratory_all": 3, "cardio_all": 1, "ischemic_heart_disease": 1,
        "acute_myocardial_infarction": 1,
    }


def test_cause_map_join_equals_direct_counts_under_a_hot_code(spark):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "J189").otherwise(F.concat(F.lit("C"), F.col("id") % 97)).alias("c"))
    direct = as_dict(classified_counts(hot, "c", DEFS, []), "outcome_id", "count")
    joined = classified_events(hot, "c", DEFS).groupBy("outcome_id").count()
    assert as_dict(joined, "outcome_id", "count") == direct
    mapped = hot.join(cause_map(hot, "c", DEFS), hot["c"] == F.col("cause")).groupBy("outcome_id").count()
    assert as_dict(mapped, "outcome_id", "count") == direct
    assert direct["pneumonia"] == 1000


def test_totals_equal_the_sum_of_their_parts(spark):
    counts = spark.createDataFrame(
        [("volta_redonda", 3), ("rest_of_rj_excluding_vr", 7), ("rest_of_brazil_excluding_rj", 20)], "geography string, count long"
    ).withColumn("k", F.lit(1))
    national = as_dict(rollup.with_territory_totals(counts, ["k"], ["count"]), "geography", "count")
    assert national["rj_total"] == 10 and national["brazil_total"] == 30
    state = as_dict(rollup.with_territory_totals(counts.limit(2), ["k"], ["count"], national=False), "geography", "count")
    assert "brazil_total" not in state


def test_repeated_population_key_raises(spark):
    counts = spark.createDataFrame([(2020, 1)], "year int, count long")
    people = spark.createDataFrame([(2020, 10), (2020, 11)], "year int, population long")
    with pytest.raises(Exception, match="repeated key"):
        joins.join_denominator(counts, people, ["year"]).collect()


def test_missing_population_is_a_gap_or_an_error(spark):
    counts = spark.createDataFrame([(2020, 1), (2021, 2)], "year int, count long")
    people = spark.createDataFrame([(2020, 10)], "year int, population long")
    assert as_dict(joins.join_denominator(counts, people, ["year"]), "year", "population") == {2020: 10, 2021: None}
    with pytest.raises(Exception, match="no population"):
        joins.join_denominator(counts, people, ["year"], strict=True).collect()


def test_grid_needs_no_join(spark):
    base = spark.createDataFrame([(2020,)], "year int")
    grid = joins.dense_grid(base, geography=["a", "b"], sex=["m", "f"])
    assert grid.count() == 4
    assert "Join" not in grid._jdf.queryExecution().executedPlan().toString()


def test_complementary_suppression_protects_a_lone_small_cell(spark):
    rows = [("x", "1-4", "f", c, n) for c, n in [("1", 3), ("2", 5), ("3", 8)]]
    rows += [("y", "1-4", "f", c, n) for c, n in [("1", 0), ("2", 4), ("3", 8)]]
    rows += [("z", "1-4", "f", c, n) for c, n in [("1", 3), ("2", 6), ("3", 6)]]
    df = spark.createDataFrame(rows, "outcome_id string, age_group string, sex string, municipality_code_ibge string, count long")
    got = {(r["outcome_id"], r["municipality_code_ibge"]): r["suppression_status"]
           for r in complementary_suppression(df, ["outcome_id", "age_group", "sex"]).collect()}
    assert [got["x", c] for c in "123"] == ["suppressed", "suppressed_complementary", "published"]
    assert [got["y", c] for c in "123"] == ["suppressed", "suppressed", "published"]
    assert [got["z", c] for c in "123"] == ["suppressed", "suppressed_complementary", "published"]


def test_profile_protection_follows_status(spark):
    df = spark.createDataFrame(
        [("cervix", "masculino", "published", 9, 10), ("cervix", "feminino", "suppressed_complementary", 9, 10)],
        "outcome_id string, sex string, suppression_status string, count long, population long",
    )
    got = {r["sex"]: r for r in protect_profile(mark_not_applicable(df), ["count"]).collect()}
    assert got["masculino"]["suppression_status"] == "not_applicable" and got["masculino"]["population"] is None
    assert got["feminino"]["suppression_status"] == "suppressed" and got["feminino"]["population"] == 10
    assert got["feminino"]["count"] is None


def test_small_observations_lose_four_fields_and_keep_the_denominator(spark):
    df = spark.createDataFrame([(4, 1.0, 0.5, 2.0, 100), (5, 1.0, 0.5, 2.0, 100), (None, None, None, None, 100)],
                               "count long, value double, ciLow double, ciHigh double, denominator long")
    small, shown, unknown = suppress_observations(df).collect()
    assert all(small[f] is None for f in PROTECTED_FIELDS) and small["denominator"] == 100 and small["suppressed"]
    assert shown["count"] == 5 and shown["suppressionStatus"] == "published"
    assert unknown["suppressionStatus"] == "unavailable"
    leaks = protected_leaks(df.withColumn("suppressed", F.lit(False)), F.col("suppressed"), PROTECTED_FIELDS)
    assert [r["leaked_fields"] for r in leaks.collect()] == [["unsuppressed_small_cell"]]


def test_leave_one_out_sums_back_to_the_total(spark):
    df = spark.createDataFrame([(1, "a", 10, 100), (1, "b", 20, 300), (1, "c", 30, 600)], "year int, area string, count long, population long")
    got = series.leave_one_out(df, ["year"]).collect()
    assert all(r["rest_count"] + r["count"] == 60 and r["rest_population"] + r["population"] == 1000 for r in got)
    by_area = {r["area"]: r["rest_rate_per_100k"] for r in got}
    assert by_area["a"] == pytest.approx(50 / 900 * 100000)


def test_last_row_wins_by_explicit_order_even_for_a_hot_key(spark):
    rows = spark.range(9000).select(F.lit("k").alias("key"), F.col("id").alias("file"), (F.col("id") * 2).alias("value"))
    kept = series.keep_last(rows, ["key"], ["file"])
    assert [tuple(r) for r in kept.collect()] == [("k", 8999, 17998)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max_by" in plan
    assert series.duplicate_rows(rows, ["key"]).collect()[0][0] == 8999


def test_segments_and_gaps(spark):
    df = spark.createDataFrame([("s", y) for y in (2010, 2011, 2013, 2016)], "k string, year int")
    assert [r["segment"] for r in series.contiguous_segments(df, ["k"]).orderBy("year").collect()] == [0, 0, 1, 2]
    assert sorted(r["missing_year"] for r in series.missing_years(df, ["k"]).collect()) == [2012, 2014, 2015]


def test_series_insight_needs_every_baseline_year(spark):
    schema = "k string, year int, value double, rest double, country double, dataStatus string"
    full = [("a", y, v, 50.0, None, "final") for y, v in [(2018, 100.0), (2019, 120.0), (2020, 80.0), (2021, 60.0), (2022, 99.0)]]
    full.append(("a", 2023, 500.0, 50.0, None, "provisional"))
    partial = [("b", *row[1:]) for row in full if row[1] != 2019]
    got = series.series_insight(
        spark.createDataFrame(full + partial, schema), ["k"], "value", [2018, 2019], [2020, 2021], "rest", "country"
    ).collect()
    assert [r["k"] for r in got] == ["a"]
    assert got[0]["baseline"] == 110 and got[0]["pandemic"] == 70 and got[0]["latest_year"] == 2022
    assert got[0]["rest_difference"] == pytest.approx(98.0) and got[0]["country_difference"] is None
    assert got[0]["provisional_year"] == 2023


def test_integrated_admissions_need_both_chapters(spark):
    rows = [("m1", "resp_all", 117), ("m1", "cardio_all", 293), ("m1", "hypertension_essential", 4), ("m1", "hypertension_other", 3),
            ("m1", "acute_myocardial_infarction", 49), ("m1", "ischemic_heart_disease_other", 38), ("m2", "resp_all", 5)]
    got = {(r["m"], r["outcome_id"]): r["value"] for r in rollup.component_sums(
        spark.createDataFrame(rows, "m string, component_id string, value long"), ["m"]).collect()}
    assert got["m1", "cardiorespiratory_all"] == 410 and got["m1", "hypertension"] == 7 and got["m1", "ischemic_heart_disease"] == 87
    assert ("m2", "cardiorespiratory_all") not in got


def test_search_and_lookup_ignore_accents_and_case(spark):
    df = spark.createDataFrame([("1", "Niterói"), ("2", "São Gonçalo"), ("3", "Gonçalo Velho")], "code string, name string")
    assert {r["code"] for r in search_text(df, ["name"], "GONCALO").collect()} == {"2", "3"}
    assert search_text(df, ["name"], " ").count() == 0
    found = as_dict(find_by_name(df, "name", "code", ["niteroi", "goncalo", "ção"]), "query", "code")
    assert found == {"niteroi": "1", "goncalo": "3"}


def test_audits_name_what_is_wrong(spark):
    headers = spark.createDataFrame([("f1", "CODMUNRES"), ("f1", "SEXO"), ("f2", "SEXO")], "source_file string, field string")
    missing = quality.required_fields_missing(headers, ["CODMUNRES", "SEXO"]).collect()
    assert [tuple(r) for r in missing] == [("f2", "CODMUNRES")]
    left = spark.createDataFrame([("a", 3), ("b", 4)], "k string, count long")
    right = spark.createDataFrame([("a", 3), ("b", 5)], "k string, count long")
    assert [r["k"] for r in quality.reconcile(left, right, ["k"]).collect()] == ["b"]
    sides = {tuple(r) for r in quality.set_mismatch(left.where("k = 'a'"), right, "k").collect()}
    assert sides == {("b", "only_right")}


def test_production_must_declare_its_basis(spark):
    good = spark.createDataFrame([(2020, "330", "alzheimer", "establishment", 2)], "year int, municipality_code_ibge string, outcome_id string, geography_basis string, count long")
    assert rollup.establishment_production(good, ["alzheimer"]).collect()[0]["geography"] == "0000330"
    bad = good.withColumn("geography_basis", F.lit("residence"))
    with pytest.raises(Exception, match="establishment"):
        rollup.establishment_production(bad, ["alzheimer"]).collect()


def test_normalised_null_is_empty(spark):
    assert spark.createDataFrame([(None,)], "c string").select(normalize_code("c")).collect()[0][0] == ""


def test_rules_hold_whatever_is_selected(spark):
    counts = spark.createDataFrame([(2000, 5), (2001, 6)], "year int, count int")
    doubled = spark.createDataFrame([(2000, 10), (2000, 11), (2001, 7)], "year int, population int")
    gap = doubled.where("year = 2001")
    for broken in (
        joins.join_denominator(counts, doubled, ["year"]), joins.join_denominator(counts, gap, ["year"], strict=True),
        joins.join_one_to_one(counts, doubled, ["year"]), joins.manifest_lookup(counts, gap, "year"), joins.unique_rows(doubled, ["year"], "x"),
    ):
        with pytest.raises(Exception, match="USER_RAISED"):
            broken.select("year").collect()
        with pytest.raises(Exception, match="USER_RAISED"):
            broken.count()
    assert joins.join_denominator(counts, gap, ["year"]).where("population is null").count() == 1


def test_reconciliation_sees_both_sides(spark):
    detail = spark.createDataFrame([("a", 3), ("b", 4), ("c", 5)], "k string, count int")
    totals = spark.createDataFrame([("a", 3), ("b", 9), ("d", 7)], "k string, count int")
    found = {r["k"]: (r["observed"], r["expected"]) for r in quality.reconcile(detail, totals, ["k"]).collect()}
    assert found == {"b": (4, 9), "c": (5, 0), "d": (0, 7)}
    assert {r["k"] for r in quality.reconcile(detail, totals, ["k"], absent_totals_pass=True).collect()} == {"b", "d"}


def test_a_hidden_figure_is_no_breach(spark):
    frame = spark.createDataFrame([("i", None, "ok"), ("j", 3.0, None)], "id string, value double, status string")
    found = {(r["id"], r["missing_field"], r["breach"]) for r in quality.contract_violations(frame, ["value", "status", "source"], ["id"], ["value"]).collect()}
    assert found == {("i", "source", "absent"), ("j", "source", "absent"), ("j", "status", "null")}


def test_row_sequence(spark):
    rows = {"good": [1, 2, 3], "gap": [1, 3], "twice": [1, 2, 2, 4, 6], "swap": [1, 2, 4, 4, 4], "low": [0, 1]}
    frame = spark.createDataFrame([(k, n) for k, v in rows.items() for n in v], "f string, source_row_number long")
    assert {r["f"]: r["source_row_sequence_ok"] for r in quality.row_sequence_ok(frame, ["f"]).collect()} == {k: k == "good" for k in rows}


def test_table_total_is_no_site(spark):
    rows = spark.createDataFrame([("C50 x", 60), ("C61 y", 40), ("Total", 100)], "diagnosis_label string, cases long")
    shares = {r["site_group"]: r["share_pct"] for r in rollup.site_group_summary(rows).collect() if r["cases"]}
    assert set(shares.values()) == {60.0, 40.0}


def test_last_row_of_the_last_file_wins(spark):
    from epispan.plans.products import deduplicated_admissions

    rows = [(2020, 1, "g", "o", "O", v, f, n) for v, f, n in ((9, "a", 1), (5, "a", 2), (4, "b", 7), (3, "b", 12))]
    frame = spark.createDataFrame(rows, "year int, month int, geography string, outcome_id string, outcome_label string, value long, source_file string, source_row_number long")
    assert [r["value"] for r in deduplicated_admissions(frame).collect()] == [3]
    assert [r["value"] for r in deduplicated_admissions(frame.where("source_file = 'a'")).collect()] == [5]


def test_name_lookup_against_every_pair(spark):
    pick = random.Random(4)
    names = ["".join(pick.choice("abçé ") for _ in range(pick.randint(1, 9))) for _ in range(120)]
    asked = ["".join(pick.choice("abceÁ ") for _ in range(pick.randint(0, 5))) for _ in range(80)] + names[:5] + ["zzz", ""]
    plain = lambda t: t.strip(" ").lower().translate(str.maketrans("áçé", "ace"))
    want = {}
    for q in set(asked):
        ranked = [(0 if plain(n) == plain(q) else 1 if plain(n).startswith(plain(q)) else 2, i) for i, n in enumerate(names) if plain(q) and plain(q) in plain(n)]
        if ranked:
            want[q] = min(ranked)[1]
    places = spark.createDataFrame([*enumerate(names), (999, None)], "code int, name string")
    queries = spark.createDataFrame([(q,) for q in asked] + [(None,)], "query string")
    found = find_by_name(places, "name", "code", queries)
    assert found.columns == ["code", "name", "query"] and {r["query"]: r["code"] for r in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert find_by_name(places.limit(0), "name", "code", ["a"]).count() == 0


def test_name_lookup_keeps_names_off_the_driver(spark, tmp_path):
    """A small file of names makes many posted rows, so its size says nothing about them."""
    rows = [(i, f"place {i % 5}") for i in range(40)] + [(None, "place 3"), (7, "PLACE 2 ")]
    spark.createDataFrame(rows, "code int, name string").write.parquet(f"{tmp_path}/places")
    spark.createDataFrame([("place 2",), ("lace 3",), ("e",), ("none",)], "query string").write.parquet(f"{tmp_path}/queries")
    found = find_by_name(spark.read.parquet(f"{tmp_path}/places"), "name", "code", spark.read.parquet(f"{tmp_path}/queries"))
    assert {r["query"]: (r["code"], r["name"]) for r in found.collect()} == {"place 2": (2, "place 2"), "lace 3": (None, "place 3"), "e": (None, "place 3")}
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_search_reads_every_way_of_composition(spark):
    df = spark.createDataFrame([("1", "Sa\u0303o Jose\u0301"), ("2", "São José"), ("3", "SAO JOSE"), ("4", None)], "code string, name string")
    for term in ("são josé", "Sa\u0303o jose", " SAO "):
        assert {r["code"] for r in search_text(df, ["name"], term).collect()} == {"1", "2", "3"}


SETS = [
    ComparatorSet("state", prefixes=("33",)), ComparatorSet("country", prefixes=("",), own_included=True),
    ComparatorSet("region", prefixes=("3301",), codes=("330100", "330200")), ComparatorSet("nobody", codes=("999999",)),
]


def test_an_area_counts_once_in_each_set_that_names_it(spark):
    areas = spark.createDataFrame([("330100",), ("330100",), ("330200",), ("350000",)], "code string")
    assert {(r["code"], r["comparator_id"]) for r in membership(areas, SETS).collect()} == {
        ("330100", "state"), ("330100", "country"), ("330100", "region"), ("330200", "state"), ("330200", "country"), ("330200", "region"), ("350000", "country"),
    }


def test_comparison_takes_the_area_off_its_own_sets_only(spark):
    counts = spark.createDataFrame([(2020, "330100", "x", 5), (2020, "330200", "x", 7), (2020, "350000", "x", 11), (2021, "330100", "x", 1)], "year int, code string, outcome_id string, count long")
    people = spark.createDataFrame([(2020, "330100", 100), (2020, "330200", 200), (2020, "350000", 400)], "year int, code string, population long")
    rows = compare_with_sets(counts, people, SETS, ["330100", "350000"], {"outcome_id": ["x", "y"]}).collect()
    got = {(r["code"], r["outcome_id"], r["comparator_id"]): (r["count"], r["comparator_count"], r["comparator_population"]) for r in rows}
    assert len(rows) == 2 * 2 * 4 and {r["year"] for r in rows} == {2020}
    assert got["330100", "x", "state"] == (5, 7, 200) and got["330100", "x", "country"] == (5, 23, 700) and got["330100", "x", "region"] == (5, 7, 200)
    assert got["350000", "x", "state"] == (11, 12, 300) and got["350000", "x", "country"] == (11, 23, 700)
    assert got["330100", "x", "nobody"] == (5, None, None) and got["330100", "y", "state"] == (0, 0, 200)
    ratio = next(r for r in rows if (r["code"], r["outcome_id"], r["comparator_id"]) == ("350000", "x", "state"))
    assert ratio["rate_ratio"] == pytest.approx((11 / 400) / (12 / 300)) and ratio["rate_ratio_ci_lower"] < ratio["rate_ratio"] < ratio["rate_ratio_ci_upper"]


def test_configured_comparators(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "t.yml"
    path.write_text(
        "comparators:\n  primary:\n    id: rest\n    prefixes: ['33']\n  secondary:\n    - id: all\n      prefixes: ['']\n      include_selected: true\n"
        "    - id: region\n      municipalities: [330040, '330420']\n    - id: later\n"
    )
    assert load_comparators(path) == [
        ComparatorSet("rest", prefixes=("33",)), ComparatorSet("all", prefixes=("",), own_included=True), ComparatorSet("region", codes=("330040", "330420")),
    ]
    assert [s.id for s in comparator_sets(Territory(), listed=("330040",))][-1] == "pre_specified_comparable_municipalities" and len(comparator_sets(Territory())) == 3


def test_periods_start_inside_years_and_may_stay_open(spark):
    rows = [("s", "a", "2019-03", "2020-02", "old"), ("s", "b", "2020-03", "2021-12", "new"), ("s", "c", "2022-06", None, "open"), ("t", "d", "2020-01", "2020-12", "x")]
    dates = ["2019-02-28", "2019-03-01", "2020-01-31", "2020-02-29", "2020-03-01", "2021-12-31", "2022-01-01", "2150-01-01"]
    frame = spark.createDataFrame([("s", d) for d in dates] + [("t", "2020-05-05"), ("u", "2020-05-05"), ("s", None)], "section string, d string")
    got = {(r["section"], r["d"]): r["period_id"] for r in periods.with_period(frame.withColumn("date", F.col("d").cast("date")), "date", rows).collect()}
    assert [got["s", d] for d in dates] == [None, "a", "a", "a", "b", "b", None, "c"]
    assert got["t", "2020-05-05"] == "d" and got["u", "2020-05-05"] is None and got["s", None] is None
    with pytest.raises(ValueError, match="overlap"):
        periods.period_intervals(spark, [("s", "a", "2019-01", "2020-03", ""), ("s", "b", "2020-03", "2020-05", "")])
    sides = spark.sql("SELECT DATE'2020-02-29' AS d UNION ALL SELECT DATE'2020-03-01'").select("d", F.explode(periods.break_sides("d")).alias("b")).select("d", "b.*")
    assert [r["after"] for r in sides.where("break_id = 'respiratory_pandemic_start'").orderBy("d").collect()] == [False, True]
    assert periods.break_dimension(spark).count() == 5
