import gzip
import hashlib
import io
import json
import os
import subprocess
import sys
import tempfile
import zipfile

import pandas as pd
import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from epispan.fixed_values import Territory
from epispan.operators.quality import row_sequence_ok
from epispan.operators.rollup import component_sums
from epispan.plans import harmonize
from epispan.sources import provenance, sinks
from epispan.sources.config import load_outcomes
from epispan.sources.files import JsonStream, file_digests, first_line, list_files
from epispan.sources.microdata import (
    harmonize_deaths, harmonize_notifications, number_rows, scan_death_csv, scan_harmonized, scan_notification_parquet,
    scan_zipped_csv,
)
from epispan.sources.population import scan_population_age_sex_json, scan_population_json
from epispan.sources.tables import (
    admission_components, dementia_counts, municipal_rows, page_rows, registry_years, scan_registry_csv,
)

CITY = Territory()
HEAD = "CAUSABAS;IDADE;SEXO;CODMUNOCOR;CODMUNRES;DTOBITO;DTNASC\n"


def test_plain_csv_keeps_residence_and_fills_absent_fields(spark, tmp_path):
    (tmp_path / "sim_2019.csv").write_bytes("CAUSABAS;IDADE;SEXO;CODMUNRES\nJ18.9;480;1;330630\nC34;401;2;ação\n".encode("latin1"))
    first, second = harmonize_deaths(scan_death_csv(spark, str(tmp_path), numbered=True), CITY).orderBy("source_row_number").collect()
    assert first["source_year"] == 2019 and first["residence_is_vr"] and first["municipality_code_occurrence"] == ""
    assert second["municipality_code_datasus"] == "ação" and not second["residence_code_valid"]
    assert [first["source_row_number"], second["source_row_number"]] == [1, 2]


def test_missing_required_field_is_an_error(spark, tmp_path):
    (tmp_path / "sim_2019.csv").write_text("IDADE;SEXO;CODMUNRES\n480;1;330630\n")
    with pytest.raises(ValueError, match="CAUSABAS"):
        scan_death_csv(spark, str(tmp_path))


def test_zip_needs_exactly_one_csv(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "sim_2021.zip", "w") as archive:
        archive.writestr("DO21.csv", HEAD + "J189;480;1;330455;330630;01022021;03041941\n")
        archive.writestr("readme.txt", "x")
    fields = ["CAUSABAS", "IDADE", "SEXO", "CODMUNOCOR", "CODMUNRES", "DTOBITO", "DTNASC"]
    row = harmonize_deaths(scan_zipped_csv(spark, str(tmp_path / "sim_2021.zip"), fields), CITY).collect()[0]
    assert (row["municipality_code_datasus"], row["municipality_code_occurrence"]) == ("330630", "330455")
    assert str(row["death_date"]) == "2021-02-01" and row["source_year"] == 2021
    with zipfile.ZipFile(tmp_path / "sim_2022.zip", "w") as archive:
        archive.writestr("a.csv", HEAD)
        archive.writestr("b.csv", HEAD)
    with pytest.raises(Exception, match="expected one CSV member"):
        scan_zipped_csv(spark, str(tmp_path / "sim_2022.zip"), fields).collect()


def test_row_numbers_run_through_every_split_of_a_file(spark, tmp_path):
    for name, rows in (("sim_2001.csv", 20000), ("sim_2002.csv", 7)):
        lines = "\n".join(f"J189;480;1;330630;{i}" for i in range(1, rows + 1))
        (tmp_path / name).write_text("CAUSABAS;IDADE;SEXO;CODMUNRES;LINE\n" + lines + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        raw = scan_death_csv(spark, str(tmp_path), numbered=True)
        assert raw.where(F.col("source_row_number") != F.col("LINE").cast("long")).count() == 0
        assert raw.count() == 20007
        assert all(r["source_row_sequence_ok"] for r in row_sequence_ok(raw, ["source_file"]).collect())
        assert spark.read.csv(str(tmp_path), sep=";", header=True).rdd.getNumPartitions() > 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_notifications_read_only_the_needed_columns(spark, tmp_path):
    frame = spark.createDataFrame(
        [("330630", "M", "6", None, "5.0", "2", "zz")],
        "CO_MUN_RES string, CS_SEXO string, NU_IDADE_N string, DT_SIN_PRI date, CLASSI_FIN string, EVOLUCAO string, EXTRA string",
    )
    path = str(tmp_path / "sivep_2020.parquet")
    frame.coalesce(1).write.parquet(path)
    raw = scan_notification_parquet(spark, path)
    assert "EXTRA" not in raw._jdf.queryExecution().executedPlan().toString()
    row = harmonize_notifications(raw, CITY, F.lit(2020)).collect()[0]
    assert row["final_classification_raw"] == "5" and row["race_raw"] == "" and row["source_row_number"] == 1


def test_population_header_and_unknown_figures_drop_out(spark, tmp_path):
    rows = [{"D1C": "Código", "D1N": "Município", "D2C": "Ano", "V": "Valor"},
            {"D1C": "3306305", "D1N": "Volta Redonda", "D2C": "2022", "V": "261563"},
            {"D1C": "3300100", "D1N": "Angra", "D2C": "2022", "V": "..."}]
    (tmp_path / "p.json").write_text(json.dumps(rows), encoding="utf-8")
    got = scan_population_json(spark, str(tmp_path / "p.json")).collect()
    assert [(r["municipality_code_ibge"], r["year"], r["population"]) for r in got] == [("3306305", 2022, 261563)]


def test_census_cells_group_to_broad_ages_and_count_dashes_as_zero(spark, tmp_path):
    def cell(age, value, sex="4", declaration="113635"):
        return {"D1C": "3306305", "D1N": "VR", "D2C": "2022", "D3C": "93", "D4C": sex, "D5C": declaration, "D6C": age, "V": value}

    rows = [cell("Grupo", "Valor"), cell("6558", "10"), cell("6559", "-"), cell("6560", "5"), cell("6558", "9", declaration="1")]
    (tmp_path / "a.json").write_text(json.dumps(rows), encoding="utf-8")
    got = scan_population_age_sex_json(spark, str(tmp_path / "a.json")).collect()
    assert [(r["age_group"], r["sex"], r["population"], r["sidra_zero_marker_count"]) for r in got] == [("1-4", "masculino", 15, 1)]


def test_registry_keeps_year_rows_only(spark, tmp_path):
    (tmp_path / "r.csv").write_bytes('"Ano do diagnóstico";"Casos"\n"1987";"41"\n"1991";"8"\n"Total";"49"\n'.encode("latin1"))
    assert [tuple(r) for r in registry_years(scan_registry_csv(spark, str(tmp_path / "r.csv"))).collect()] == [(1987, 41), (1991, 8)]


PAGE = """<HTML><PRE>
"10 Doen&ccedil;as do aparelho respirat&oacute;rio";117
".. Pneumonia";68
".. Bronquite enfisema e outr doen&ccedil; pulm obstr cr&ocirc;n";1.009
".. Pneumoconiose";-
"09 Doen&ccedil;as do aparelho circulat&oacute;rio";293
"Total";1463
</PRE>"""


def test_html_page_to_outcomes(spark):
    pages = spark.createDataFrame([("2020-01", bytearray(PAGE.encode("latin1")))], "period string, content binary")
    components = admission_components(page_rows(pages, keep=["period"]), ["period"])
    got = {r["outcome_id"]: r["value"] for r in component_sums(components, ["period"]).collect()}
    assert got == {"resp_all": 117, "pneumonia": 68, "copd": 1009, "pneumoconiosis": 0, "cardio_all": 293, "cardiorespiratory_all": 410}


def test_municipal_and_national_pages(spark):
    text = '<PRE>\n"330001 ANGRA";12\n"330630 VOLTA REDONDA";1.200\n"Doen&ccedil;a de Alzheimer";7\n".. Dem&ecirc;ncia";5\n</PRE>'
    rows = page_rows(spark.createDataFrame([(bytearray(text.encode("latin1")),)], "content binary"))
    assert {tuple(r) for r in municipal_rows(rows, []).collect()} == {("330001", 12), ("330630", 1200)}
    assert {tuple(r) for r in dementia_counts(rows, []).collect()} == {("alzheimer", 7), ("dementias_all", 12)}


def test_checksums_meet_their_sidecars(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"alpha")
    (tmp_path / "b.txt").write_bytes(b"beta")
    (tmp_path / "a.txt.sha256").write_text(hashlib.sha256(b"alpha").hexdigest() + "  a.txt\n")
    manifest = provenance.checksum_manifest(provenance.scan_files(spark, str(tmp_path / "*.txt")))
    status = provenance.sidecar_status(manifest, provenance.scan_sidecars(spark, str(tmp_path / "*.sha256")))
    assert {r["path"][-5:]: r["hash_status"] for r in status.collect()} == {"a.txt": "ok", "b.txt": "missing_sha256_sidecar"}


def test_format_verdicts(spark, tmp_path):
    shape = json.dumps({"type": "FeatureCollection", "features": []}).encode()
    files = [
        ("a.json", b"[1]"), ("b.json", b"{"), ("c.geojson", gzip.compress(shape)), ("d.geojson", b"{}"), ("e.pdf", b"%PDF-1"),
        ("f.csv", "Ano;Casos\n1;2".encode("latin1")), ("g.csv", b"A;B;C\n"), ("h.zip", b"nope"), ("i.exe", b"x"),
        ("j.parquet", b"PAR1....PAR1"), ("k.parquet", _parquet_bytes()), ("l.csv", b"IDADE;SEXO;CODMUNRES;CAUSABAS\r\n1;2;3;4\r\n"), ("m.zip", _zip_bytes()),
    ]
    frame = spark.createDataFrame([(p, bytearray(c)) for p, c in files], "path string, content binary")
    verdicts = {r["path"]: r for r in provenance.file_format_check(frame).collect()}
    assert {p for p, r in verdicts.items() if r["format_ok"]} == {"a.json", "c.geojson", "e.pdf", "f.csv", "k.parquet", "l.csv", "m.zip"}
    assert verdicts["k.parquet"]["format_details"] == "3 rows, 1 columns" and verdicts["m.zip"]["format_details"] == "inner.csv"
    assert "CAUSABAS" in verdicts["g.csv"]["problem"]
    hashes = frame.select("path", F.sha2("content", 256).alias("declared")).where("path <> 'e.pdf'")
    for name, content in files:
        (tmp_path / name).write_bytes(content)
    listed = list_files(spark, str(tmp_path))
    name = F.element_at(F.split("path", "/"), -1)
    sidecars = listed.join(hashes.withColumnRenamed("path", "_name"), name == F.col("_name")).select("path", "declared")
    both = {r["path"].rpartition("/")[2]: r for r in provenance.raw_file_verdict(listed, sidecars).collect()}
    assert {p for p, r in both.items() if r["format_ok"]} == {p for p, r in verdicts.items() if r["format_ok"]}
    assert both["a.json"]["ok"] and not both["e.pdf"]["ok"] and not both["b.json"]["ok"]
    assert both["e.pdf"]["errors"] == ["missing_sha256_sidecar"] and both["g.csv"]["errors"] == ["missing_required_fields:CAUSABAS,CODMUNRES,IDADE,SEXO"]
    assert json.loads(both["k.parquet"]["format_details"]) == {"columns": 1, "row_groups": 1, "rows": 3}
    assert json.loads(both["m.zip"]["format_details"]) == {"first_members": ["inner.csv"], "members": 1} and both["h.zip"]["errors"] == ["BadZipFile"]
    assert json.loads(both["d.geojson"]["format_details"]) == {"features": 0, "geojson_type": None, "json_type": "dict"}


def _parquet_bytes() -> bytes:
    out = io.BytesIO()
    pd.DataFrame({"n": [1, 2, 3]}).to_parquet(out)
    return out.getvalue()


def _zip_bytes() -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("inner.csv", "x")
    return out.getvalue()


def test_a_quoted_line_break_is_no_row(spark, tmp_path):
    (tmp_path / "sim_2018.csv").write_text('CODMUNRES;SEXO;IDADE;CAUSABAS\n330630;1;450;"J1\n89"\n330630;2;450;J18\n')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        scan_death_csv(spark, str(tmp_path)).select("SEXO").collect()
    rows = scan_death_csv(spark, str(tmp_path), multi_line=True).collect()
    assert [r["CAUSABAS"] for r in rows] == ["J1\n89", "J18"]


def test_folder_of_layouts(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "sim_2016.csv").write_text("SEXO;IDADE;CODMUNRES;CAUSABAS\n1;450;330630;J10\n2;451;330630;J11\n")
    (raw / "sim_2017.csv").write_text("CAUSABAS;CODMUNRES;DTOBITO;IDADE;SEXO;NEW\nJ12;330100;05032017;410;1;z\n")
    rows = {(r["source_year"], r["underlying_cause"]): r for r in harmonize.harmonize_death_files(spark, str(raw), CITY).collect()}
    assert set(rows) == {(2016, "J10"), (2016, "J11"), (2017, "J12")}
    assert rows[2016, "J10"]["death_date"] is None and str(rows[2017, "J12"]["death_date"]) == "2017-03-05"
    assert harmonize.harmonize_death_files(spark, str(raw), CITY, years=[2017]).count() == 1
    with pytest.raises(FileNotFoundError):
        harmonize.harmonize_death_files(spark, str(raw), CITY, years=[1990])
    target = str(tmp_path / "out")
    first = harmonize.run_years(harmonize.harmonize_death_files(spark, str(raw), CITY), target, None)
    kept = spark.createDataFrame(first.collect(), first.schema)
    (raw / "sim_2017.csv").write_text("CAUSABAS;CODMUNRES;IDADE;SEXO\nJ13;330630;410;1\nJ14;330630;410;1\n")
    again = harmonize.run_years(harmonize.harmonize_death_files(spark, str(raw), CITY, years=[2017]), target, kept)
    assert {r["source_year"]: (r["rows"], r["city_rows"]) for r in again.collect()} == {2016: (2, 2), 2017: (2, 2)}
    (raw / "sim_2015.csv").write_text("SEXO;IDADE;CODMUNRES\n1;450;330630\n")
    with pytest.raises(ValueError, match="CAUSABAS"):
        harmonize.harmonize_death_files(spark, str(raw), CITY)


def test_notification_field_missing_in_the_first_file(spark, tmp_path):
    columns = "CO_MUN_RES string, CS_SEXO string, NU_IDADE_N string, DT_SIN_PRI date, CLASSI_FIN string, EVOLUCAO string"
    row = ("330630", "M", "6", None, "5", "2")
    spark.createDataFrame([row], columns).write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([(*row, "3")], columns + ", TP_IDADE string").write.parquet(str(tmp_path / "b"))
    raw = scan_notification_parquet(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert sorted(r["TP_IDADE"] or "" for r in raw.collect()) == ["", "3"]
    spark.createDataFrame([("1",)], "CO_MUN_RES string").write.parquet(str(tmp_path / "c"))
    with pytest.raises(ValueError, match="missing fields"):
        scan_notification_parquet(spark, [str(tmp_path / "a"), str(tmp_path / "c")])


def test_rerun_replaces_only_its_own_partitions_and_entries(spark, tmp_path):
    path = str(tmp_path / "table")
    both = spark.createDataFrame([(2020, 1), (2021, 2)], "source_year int, v int")
    sinks.write_table(both, path, ["source_year"])
    sinks.write_table(spark.createDataFrame([(2021, 9)], "source_year int, v int"), path, ["source_year"])
    assert {(r["source_year"], r["v"]) for r in spark.read.parquet(path).collect()} == {(2020, 1), (2021, 9)}
    merged = provenance.upsert_manifest(both, spark.createDataFrame([(2021, 5)], "source_year int, v int"), "source_year")
    assert {tuple(r) for r in merged.collect()} == {(2020, 1), (2021, 5)}


def test_year_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "years")
    sinks.write_table(spark.createDataFrame([("SIM", y, y) for y in (2019, 2020, 2021)], "source string, source_year int, v int"), path, ["source", "source_year"])
    chosen = scan_harmonized(spark, path, [2020])
    assert [r["v"] for r in chosen.collect()] == [2020]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_year" in plan or "PartitionFilters: [(source_year" in plan


def test_public_csv_starts_with_a_byte_order_mark(spark, tmp_path):
    sinks.write_csv(spark.createDataFrame([("é", 1)], "a string, b int").coalesce(1), str(tmp_path / "c"), ["a", "b"], public=True)
    part = next((tmp_path / "c").glob("part-*.csv")).read_bytes()
    assert part.startswith("﻿a,b".encode()) and "é,1".encode() in part


def test_yaml_configuration(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "o.yml"
    path.write_text('cancer:\n  - id: lung\n    label: L\n    code_ranges: ["C33-C34"]\n    source: ["SIM"]\nversion: "1"\n')
    assert [(o.section, o.id, o.ranges) for o in load_outcomes(path)] == [("cancer", "lung", ("C33-C34",))]


def test_number_rows_is_a_plain_function(spark, tmp_path):
    (tmp_path / "x.csv").write_text("A\n1\n2\n3\n")
    numbered = number_rows(spark.read.csv(str(tmp_path), header=True))
    assert sorted((r["A"], r["source_row_number"]) for r in numbered.collect()) == [("1", 1), ("2", 2), ("3", 3)]


def test_archive_and_parquet_layouts(spark, tmp_path):
    def packed(members):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as archive:
            for name, text in members.items():
                archive.writestr(name, text)
        return bytearray(out.getvalue())

    for name, content in {
        "a.zip": packed({"x.csv": HEAD}), "b.zip": packed({"y.CSV": "SEXO;IDADE\n1;2\n", "z.csv": ""}), "c.zip": packed({"t.txt": "x"}), "d.zip": b"no",
    }.items():
        (tmp_path / name).write_bytes(content)
    audit = provenance.archive_layout(list_files(spark, str(tmp_path / "*.zip")), ["CODMUNRES", "SEXO"])
    got = {(r["path"].rpartition("/")[2], r["member"]): (r["columns"], r["missing"], r["error"]) for r in audit.collect()}
    assert got == {
        ("a.zip", "x.csv"): (7, [], None), ("b.zip", "y.CSV"): (2, ["CODMUNRES"], "y.CSV:missing:CODMUNRES"),
        ("b.zip", "z.csv"): (0, ["CODMUNRES", "SEXO"], "z.csv:missing:CODMUNRES,SEXO"), ("c.zip", None): (None, None, "no_csv_member"), ("d.zip", None): (None, None, "BadZipFile"),
    }
    spark.createDataFrame([(1, 2)], "a int, b int").write.parquet(str(tmp_path / "p"))
    rows = provenance.parquet_layout(spark, str(tmp_path / "p"), ["a", "c"], ["d"]).collect()
    assert sum(r["rows"] for r in rows) == 1 and {(r["columns"], *r["missing"], *r["missing_optional"], r["error"]) for r in rows} == {(2, "c", "d", None)}


def test_a_file_of_a_glob_without_a_required_field_is_named(spark, tmp_path):
    columns = "CO_MUN_RES string, CS_SEXO string, NU_IDADE_N string, DT_SIN_PRI date, CLASSI_FIN string, EVOLUCAO string"
    full = spark.createDataFrame([("330630", "M", "6", None, "5", "2")], columns)
    full.coalesce(1).write.parquet(str(tmp_path / "good"))
    full.drop("EVOLUCAO").coalesce(1).write.parquet(str(tmp_path / "lacks"))
    for path in (f"{tmp_path}/*", [f"{tmp_path}/good", f"{tmp_path}/lacks"]):
        with pytest.raises(ValueError, match=r"lacks/part.*missing fields \['EVOLUCAO'\]"):
            scan_notification_parquet(spark, path)
    (tmp_path / "good" / "broken.parquet").write_bytes(b"PAR1 no footer")
    with pytest.raises(ValueError, match="broken.parquet: cannot be read"):
        scan_notification_parquet(spark, f"{tmp_path}/good")


def test_one_field_as_number_and_as_text(spark, tmp_path):
    columns = "CO_MUN_RES {}, CS_SEXO string, NU_IDADE_N {}, DT_SIN_PRI {}, CLASSI_FIN string, EVOLUCAO string"
    rows = [((330630, "M", 6, "2020-03-04", "5", "2"), ("int", "bigint", "string")), (("330630", "M", "6", "20200304", "5", "2"), ("string", "string", "string")),
            ((330630.0, "M", 6.0, None, "5", "2"), ("double", "double", "date")), ((float("nan"), "M", 12345678.0, None, "5", "2"), ("double", "double", "timestamp"))]
    for number, (row, kinds) in enumerate(rows):
        spark.createDataFrame([row], columns.format(*kinds)).coalesce(1).write.parquet(f"{tmp_path}/{number}")
    got = harmonize_notifications(scan_notification_parquet(spark, f"{tmp_path}/*"), CITY, F.lit(2020)).collect()
    assert sorted((r["municipality_code_datasus"], r["age_raw"], str(r["symptom_onset_date"])[:10]) for r in got) == [
        ("", "12345678", "None"), ("330630", "6", "2020-03-04"), ("330630", "6", "2020-03-04"), ("330630", "6", "None"),
    ]


def test_archives_raise_on_ragged_rows_and_stream_more_than_a_batch(spark, tmp_path):
    fields = ["CODMUNRES", "SEXO", "IDADE", "CAUSABAS"]
    lines = "".join(f"330630;1;{i};J18\n" for i in range(45_001))
    with zipfile.ZipFile(tmp_path / "sim_2020.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("d.csv", ";".join(fields) + "\n" + lines)
    rows = scan_zipped_csv(spark, str(tmp_path / "sim_2020.zip"), [*fields, "DTOBITO"])
    assert rows.count() == 45_001 and rows.where(F.col("IDADE").cast("long") != F.col("source_row_number") - 1).count() == 0
    assert rows.where("DTOBITO <> ''").count() == 0
    for name, line in (("short", "330630;1"), ("long", "330630;1;400;J18;x")):
        with zipfile.ZipFile(tmp_path / f"{name}_2021.zip", "w") as archive:
            archive.writestr("d.csv", ";".join(fields) + "\n\n330630;1;400;J18\n" + line + "\n")
        with pytest.raises(Exception, match="row 2 has"):
            scan_zipped_csv(spark, str(tmp_path / f"{name}_2021.zip"), fields).collect()
    with zipfile.ZipFile(tmp_path / "lacks_2021.zip", "w") as archive:
        archive.writestr("d.csv", "CODMUNRES;SEXO\n")
    with pytest.raises(Exception, match="missing fields"):
        scan_zipped_csv(spark, str(tmp_path / "lacks_2021.zip"), fields).collect()


def test_one_folder_of_archives_and_plain_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    with zipfile.ZipFile(raw / "sim_2021.ZIP", "w") as archive:
        archive.writestr("DO21.csv", HEAD + "J189;480;1;330455;330630;01022021;03041941\n")
    (raw / "sim_2020.csv").write_text("CAUSABAS;IDADE;SEXO;CODMUNRES\nJ18;480;1;330630\nJ18;480;1;330100\n")
    target, manifest = str(tmp_path / "table"), str(tmp_path / "manifest")
    first = harmonize.harmonize_folder(spark, str(raw), CITY, target, manifest).collect()
    assert {(r["source_year"], r["rows"], r["city_rows"], len(r["source_files"])) for r in first} == {(2020, 2, 1, 1), (2021, 1, 1, 1)}
    kept = {p: p.read_bytes() for p in (tmp_path / "table").rglob("source_year=2021/*.parquet")}
    (raw / "sim_2020.csv").write_text("CAUSABAS;IDADE;SEXO;CODMUNRES\nJ18;480;1;330630\n")
    again = harmonize.harmonize_folder(spark, str(raw), CITY, target, manifest, years=[2020]).collect()
    assert {(r["source_year"], r["rows"], r["city_rows"]) for r in again} == {(2020, 1, 1), (2021, 1, 1)}
    assert kept and {p: p.read_bytes() for p in (tmp_path / "table").rglob("source_year=2021/*.parquet")} == kept


def test_plan_does_not_grow_with_the_files(spark, tmp_path):
    def size(n):
        for i in range(n):
            (tmp_path / f"sim_20{10 + i}.csv").write_text("CAUSABAS;IDADE;SEXO;CODMUNRES\nJ18;480;1;330630\n")
        plans = [harmonize.harmonize_death_files(spark, str(tmp_path), CITY), provenance.layout_audit(spark, str(tmp_path), ["SEXO"])]
        return [p._jdf.queryExecution().optimizedPlan().toString().count("Relation") for p in plans]

    assert size(2) == size(20)


@pytest.mark.parametrize("step", [1, 7, 1000])
def test_json_outline_in_pieces(step):
    def outline(text, lists=()):
        return JsonStream(text[i:i + step] for i in range(0, len(text), step)).outline(lists)

    assert outline(' [1, -2.5e3, "a\\"]b", [2], {"x": [3]}, null ] ') == ("list", 6) and outline("[]") == ("list", 0)
    assert outline('{"type": "T", "n": 12, "features": [{"a": 1}, {"b": []}], "o": {"features": [1]}}', ("features",)) == (
        "dict", {"type": "T", "n": 12, "features": [2], "o": None},
    )
    assert outline("1234567") == ("int", 1234567) and outline("{}") == ("dict", {}) and outline(json.dumps("x" * 3000)) == ("str", "x" * 3000)
    for bad in ("", "[1", "[1,]", "{1: 2}", '{"a" 1}', "[1] 2", "nul", "[01]", '{"a": 1,}'):
        with pytest.raises(ValueError):
            outline(bad)


def test_first_line_of_a_file_without_line_breaks():
    assert first_line(io.BytesIO(b"A;B\r\n1;2")) == b"A;B" and first_line(io.BytesIO(b"A;B")) == b"A;B" and first_line(io.BytesIO(b"")) == b""


def test_shared_folder_of_a_plain_local_session():
    """A session without the setting: the folder is made once and staged queries run."""
    code = (
        "from pyspark.sql import SparkSession\n"
        "from epispan.session import materialize, shared_folder\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "spark.sparkContext._conf.get('spark.checkpoint.dir') is None or print('set', end=' ')\n"
        "assert shared_folder(spark) == shared_folder(spark)\n"
        "print(materialize(spark.range(3), 'x').count())\n"
    )
    with tempfile.TemporaryDirectory() as empty:
        env = {**os.environ, "SPARK_CONF_DIR": empty, "PYTHONPATH": os.getcwd()}
        done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.split() == ["3"], done.stderr[-2000:]


def test_staged_years_are_gathered_before_they_are_written(spark, tmp_path):
    """Tasks that scan all years would each sort their rows by year and write a file of every year."""
    from datetime import date

    from epispan.queries.standins import deaths, notifications

    rows = [(i, i % 9, i % 7, i % 4, "ANR"[i % 3], date(1996 + i % 3, 5, 6)) for i in range(120)]
    fields = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_shipdate date"
    spark.createDataFrame(rows, fields).repartition(4).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(i, i % 9, date(1996 + i % 3, 5, 6), "1-URGENT", "F") for i in range(120)]
    fields = "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string, o_orderstatus string"
    spark.createDataFrame(orders, fields).repartition(4).write.parquet(f"{tmp_path}/orders.parquet")
    for staged in (deaths(spark, str(tmp_path)), notifications(spark, str(tmp_path))):
        assert sorted(r["source_year"] for r in staged.collect()) == sorted([1996, 1997, 1998] * 40)
        assert len(staged.inputFiles()) == 3


def test_small_files_are_read_by_few_tasks(spark, tmp_path):
    """Spark alone would start a task for every 32 files."""
    for i in range(660):
        (tmp_path / f"{i % 3}").mkdir(exist_ok=True)
        (tmp_path / f"{i % 3}" / f"{i}.txt").write_text(str(i))
    listed = list_files(spark, f"{tmp_path}/*")
    assert listed.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    found = {int(r["path"].rpartition("/")[2][:-4]): r["bytes"] for r in file_digests(listed).collect()}
    assert found == {i: len(str(i)) for i in range(660)}


def test_documents_written_as_files_are_spread_over_folders(spark, tmp_path):
    from epispan.queries.sources import _written_documents

    spark.createDataFrame([(i, f"text {i}") for i in range(300)] + [(None, "no key")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    listed = list_files(spark, _written_documents(spark, str(tmp_path), "spread-files"))
    folders = [r["path"].split("/")[-2] for r in listed.collect()]
    assert len(folders) == 301 and max(folders.count(f) for f in set(folders)) <= 4


def test_files_are_listed_by_tasks_as_spark_would(spark, tmp_path, monkeypatch):
    """Every kind of path gives the files Spark's reader takes, and nothing but the tables the tasks wrote is scanned."""
    for name in ("top.txt", "x.csv", "_hidden.txt", ".dot.txt", "a b/1.txt", "b/2.txt", "b/c/3.txt", "_no/4.txt", "k/year=1/5.txt", "k/year=2/deep/6.txt", "k/7.txt", "b/y.csv", "m/p=1/q=2/8.txt", "m/p=1/q=3/9.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    (tmp_path / "b" / "empty.txt").write_text("")
    (tmp_path / "b" / "nowhere.txt").symlink_to(tmp_path / "gone")
    given = [
        "", "top.txt", "*", "*.txt", "b/", "b/*", "*/*.txt", "[ab]*/?.txt", "{top,b/2}.txt", "{a b,b}/*.{txt,csv}", "k", "k/*", "k/year=1", "*/c", "m", "m/p=1", "m/*", "m/*/*", ["m", "k"], ["b", "k/7.txt"], ["*.csv", "b/c"],
        "_hidden.txt", "_no", "_n*", "b/empty.txt",
    ]
    for path in given:
        paths = f"{tmp_path}/{path}" if isinstance(path, str) else [f"file://{tmp_path}/{p}" for p in path]
        for recursive in (False, True) if path in ("", "top.txt", "b/*", "k") else (False,):
            reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
            try:
                want = sorted((r["path"], r["length"]) for r in reader.load(paths).select("path", "length").collect())
            except SparkRuntimeException as error:
                assert "CONFLICTING_DIRECTORY_STRUCTURES" in str(error)
                with pytest.raises(ValueError, match="beside others"):
                    list_files(spark, paths, recursive)
                continue
            assert sorted(tuple(r) for r in list_files(spark, paths, recursive).collect()) == want, path
    assert not any(f.startswith(f"file://{tmp_path}") for f in list_files(spark, str(tmp_path), True).inputFiles())
    for path in ("none", "none/*", "*.none", ["b", "*.none"]):
        with pytest.raises(FileNotFoundError):
            list_files(spark, f"{tmp_path}/{path}" if isinstance(path, str) else [f"{tmp_path}/{p}" for p in path])
    # A store that pyarrow does not know is left to Spark.
    monkeypatch.setattr("epispan.sources.files._reachable", lambda path: False)
    assert {r["bytes"] for r in list_files(spark, f"{tmp_path}/k").collect()} == {len("k/year=1/5.txt"), len("k/year=2/deep/6.txt")}


def test_listed_files_are_dealt_by_size(spark, tmp_path):
    for i in range(64):
        (tmp_path / f"{i}.txt").write_bytes(b"x" * (5000 + i if i % 16 == 0 else 1 + i % 7))
    parts = list_files(spark, str(tmp_path)).rdd.mapPartitions(lambda rows: [[r["bytes"] for r in rows]]).collect()
    assert sum(map(len, parts)) == 64 and max(sum(b >= 5000 for b in p) for p in parts) == 1
