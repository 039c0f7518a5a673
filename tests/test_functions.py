import datetime as dt

import pytest
from pyspark.sql import functions as F

from epispan.fixed_values import Territory, outcome_definitions
from epispan.functions import dates, demographics, labels, periods, text
from epispan.functions.icd import icd_match, with_outcomes
from epispan.functions.territory import classify_geography, classify_state_geography, territory_membership
from epispan.sources.tables import label_component

CITY = Territory()


def _matched(rows, ranges, codes):
    return {c for c, hit in zip(codes, rows(codes, "c string", icd_match("c", ranges)), strict=True) if hit}


def test_ranges_stay_inside_their_letter(rows):
    codes = [f"{letter}{number:02d}{last}" for letter in "DEK" for number in range(0, 100, 7) for last in ("", "4")]
    for low, high in ((7, 28), (0, 99), (49, 49)):
        wanted = {c for c in codes if c[0] == "E" and low <= int(c[1:3]) <= high}
        assert _matched(rows, [f"E{low:02d}-E{high:02d}"], codes) == wanted and wanted
    assert _matched(rows, ["D00-D20", "K91-K99"], codes) == {c for c in codes if (c[0] == "D" and int(c[1:3]) <= 20) or (c[0] == "K" and int(c[1:3]) >= 91)}


def test_three_characters_cover_subcategories_and_longer_codes_are_exact(rows):
    assert _matched(rows, ["M17"], ["M17", "M170", "M179", "M16", "M71"]) == {"M17", "M170", "M179"}
    assert _matched(rows, ["R572", "R651"], ["R572", "R57", "R5720", "R651"]) == {"R572", "R651"}


def test_four_character_bounds_have_a_strict_and_a_two_digit_reading(rows):
    codes = ["G300", "F000", "F002", "F003", "F00", "F019", "G310"]
    dementia = ["G30", "F00.0-F00.2"]
    assert rows(codes, "c string", icd_match("c", dementia)) == [True, True, True, False, False, False, False]
    assert rows(codes, "c string", icd_match("c", dementia, strict=False)) == [True, True, True, True, True, False, False]


@pytest.mark.parametrize("strict", [True, False])
def test_lookup_join_agrees_with_the_predicates(spark, strict):
    definitions = outcome_definitions("SIM")
    letters = F.explode(F.split(F.lit("ACDFGIJU"), ""))
    codes = spark.range(1000).withColumn("l", letters).where("l <> ''").select(F.format_string("%s%03d", "l", "id").alias("c"))
    odd = spark.createDataFrame([("J9",), ("J 9",), ("C5",), ("",), ("F00",), ("G30",), ("J1",), ("JX1",), ("F0001",), ("C501X",)], "c string")
    every = codes.union(odd)
    joined = {tuple(r) for r in with_outcomes(every, "c", definitions, strict).collect()}
    direct = every.select("c", F.explode(F.array_compact(F.array(*[
        F.when(icd_match("c", d.ranges, strict), F.lit(d.id)) for d in definitions
    ]))))
    assert joined == {tuple(r) for r in direct.collect()}
    assert ("J9", "influenza") in joined and ("C5", "breast") not in joined


def test_range_across_letters_is_refused():
    with pytest.raises(ValueError):
        icd_match(F.lit("A00"), ["A00-B99"])


def test_odd_and_missing_codes_never_match(rows):
    assert rows(["", "J", "JXX", None], "c string", icd_match("c", ["J00-J99"])) == [False, False, False, False]


def test_death_ages(rows):
    ages = ["000", "364", "365", "399", "400", "404", "474", "475", "499", "500", "x", None]
    expected = ["<1", "<1", "1-4", "1-4", "<1", "1-4", "65-74", "75+", "75+", "ignorado", "ignorado", "ignorado"]
    assert rows(ages, "a string", demographics.death_age_group("a")) == expected


def test_notification_ages_use_their_unit(rows):
    pairs = [("2", "2"), ("6", "3"), ("40", "3"), ("200", "1"), ("5", "9")]
    assert rows(pairs, "a string, u string", demographics.notification_age_group("a", "u")) == [
        "<1", "5-14", "25-44", "<1", "ignorado",
    ]


def test_geography_labels(rows):
    codes = ["330630", "330455", "355030", "invalid", None]
    assert rows(codes, "c string", classify_geography("c", CITY)) == [
        "volta_redonda", "rest_of_rj_excluding_vr", "rest_of_brazil_excluding_rj", "outside_brazil", "outside_brazil",
    ]
    assert rows(codes, "c string", classify_state_geography("c", CITY)) == [
        "volta_redonda", "rest_of_rj_excluding_vr", "outside_rj", "outside_rj", "outside_rj",
    ]


def test_state_only_input_has_no_country_total(rows):
    assert rows(["volta_redonda"], "g string", territory_membership("g", national=False)) == [["volta_redonda", "rj_total"]]
    assert rows(["rest_of_brazil_excluding_rj"], "g string", territory_membership("g")) == [
        ["rest_of_brazil_excluding_rj", "brazil_total"]
    ]


def test_text_cleaning(rows):
    assert rows([" 330630.0 ", None, "12.05", "7.00"], "v string", text.clean_text("v")) == ["330630", "", "12.05", "7.00"]
    assert rows([" j18.9 ", None], "v string", text.normalize_code("v")) == ["J189", ""]
    assert rows(["1.234", "-", "5,678", "12"], "v string", text.locale_integer("v")) == [1234, 0, 5678, 12]
    assert rows(["00012", "000", None, "330630"], "v string", text.strip_leading_zeros("v")) == ["12", "0", "", "330630"]
    assert rows(["=1+1", 'a"b', "x,y", "ok", None], "v string", text.csv_safe_cell("v")) == ["'=1+1", '"a""b"', '"x,y"', "ok", ""]
    assert rows(["sim_2021.csv", "v20211.zip", "f_2019_x"], "v string", text.year_in_name("v")) == [2021, None, 2019]


def test_canonical_label_folds_composed_and_combining_accents(rows):
    assert rows([".. Pneumonia", "Doenças  do  coração", "ção"], "v string", text.canonical_label("v")) == [
        "pneumonia", "doencas do coracao", "cao",
    ]


def test_dates(rows):
    assert rows(["01022020", "31022020", "2020", ""], "v string", dates.compact_date("v")) == [dt.date(2020, 2, 1), None, None, None]
    assert rows(["2020-05", "x"], "v string", dates.month_from_text("v")) == [dt.date(2020, 5, 1), None]
    months = rows(["2020-11"], "v string", dates.months_between(dates.month_from_text("v"), F.lit("2021-02-01").cast("date")))
    assert [m.strftime("%Y-%m") for m in months[0]] == ["2020-11", "2020-12", "2021-01", "2021-02"]


def test_label_rules_exclude_transient_ischaemia(rows):
    found = rows(
        [".. Acid vascular cerebr não espec hemorrág ou isq", "Acid isquêm transit e síndr correl", ".. Pneumonia bacteriana", ".. Asma"],
        "v string", label_component("v"),
    )
    assert found == ["cerebrovascular_unspecified", None, None, "asthma"]


def test_period_labels(rows):
    pairs = [(2021, "lung"), (2021, "resp_all"), (2022, "resp_all"), (2025, "cardio_all"), (2021, "alzheimer")]
    assert rows(pairs, "y int, o string", periods.death_period_status("y", "o")) == [
        "cancer_care_disruption", "respiratory_pandemic", "source_year_observed", "cardiovascular_provisional", "source_year_observed",
    ]


def test_short_texts(rows):
    assert rows([1.124, 0.9, 1.001, None], "r double", labels.relative_difference_label("r")) == [
        "12% acima", "10% abaixo", "Taxa semelhante", "Comparação indisponível",
    ]
    assert rows([(2.0, 0.0), (3.0, 2.0)], "v double, r double", labels.percent_change("v", "r")) == [0.0, 50.0]
    assert rows([4.9, 6.0, -7.0], "c double", labels.direction_label("c")) == ["estável em relação a", "acima de", "abaixo de"]


def test_outcome_counts_per_source():
    assert len(outcome_definitions("SIM")) == 33
    assert len(outcome_definitions("SIM", exclude=("covid19",))) == 32
