"""Template scan, flatten, last-wins struct and cross-template discrepancy."""

import json
import os
import tempfile

import pytest

from lakestrata.schemas import TemplateError
from lakestrata.sources import templates as tp

# Invented fixture set (FIXTURES.md section 3) with one deliberate discrepancy.
FILES = {
    "Compressors.json": [
        {"@id": "i1", "contents": [
            {"name": "RUNNINGHR", "schema": "double"}, {"name": "PRESSURE", "schema": "float"},
            {"name": "ON", "schema": "boolean"}, {"name": "reboot", "@type": "Command"}]},
        {"@id": "i2", "contents": [{"name": "STARTS", "schema": "integer"}, {"name": "PRESSURE", "schema": "double"}]},
    ],
    "LNG Tank.json": [
        {"@id": "i1", "contents": [
            {"name": "LEVEL", "schema": "float"}, {"name": "PRESSURE", "schema": "integer"},
            {"name": "ON", "schema": "boolean"}]},
    ],
    "Dryers.json": [
        {"@id": "i1", "contents": [
            {"name": "RUNNINGHR", "schema": "double"}, {"name": "DEWPOINT", "schema": "float"},
            {"name": "MODE", "schema": {"@type": "Enum", "valueSchema": "integer"}}]},
    ],
    "1. Note": "not a template",
}
MAPPING = {"Compressors": "./Devices/Compressors.json", "LNG Tank 1": "./Devices/LNG Tank.json",
           "Dryers": "./Devices/Dryers.json"}


@pytest.fixture(scope="module")
def template_dir():
    d = tempfile.mkdtemp(prefix="lakestrata-templates-")
    for name, content in FILES.items():
        with open(os.path.join(d, name), "w") as f:
            f.write(content if isinstance(content, str) else json.dumps(content))
    return d


def brute_force_flat():
    rows = set()
    for asset, path in MAPPING.items():
        for iface in FILES[os.path.basename(path)]:
            for entry in iface["contents"]:
                if "schema" in entry:
                    schema = entry["schema"]
                    text = schema if isinstance(schema, str) else json.dumps(schema, separators=(",", ":"))
                    rows.add((asset, entry["name"], text))
    return rows


def brute_force_discrepancy(flat):
    types = {}
    for _asset, tel, dtype in flat:
        types.setdefault(tel, set()).add(dtype)
    return {(tel, asset, dtype) for asset, tel, dtype in flat if len(types[tel]) > 1}


def test_list_files_skips_note(spark, template_dir):
    names = sorted(r["file"] for r in tp.list_files(spark, template_dir).collect())
    assert names == ["Compressors.json", "Dryers.json", "LNG Tank.json"]


def test_last_declaration_wins(spark, template_dir):
    tele = tp.telemetry_of(spark, os.path.join(template_dir, "Compressors.json"))
    assert [(f.name, f.dataType.simpleString()) for f in tele.fields] == [
        ("ON", "boolean"), ("PRESSURE", "double"), ("RUNNINGHR", "double"), ("STARTS", "int")]


def test_unsupported_type_reported(spark, template_dir):
    with pytest.raises(TemplateError):
        tp.telemetry_of(spark, os.path.join(template_dir, "Dryers.json"))
    diag = tp.diagnostics(tp.read_entries(spark, os.path.join(template_dir, "*.json"))).collect()
    problems = {(r["name"], r["problem"]) for r in diag}
    assert ("MODE", "unsupported type") in problems and ("reboot", "entry without a schema") in problems


def test_flatten_and_discrepancy(spark, template_dir):
    entries = tp.read_entries(spark, os.path.join(template_dir, "*.json"))
    flat = tp.flatten(entries, tp.dictionary(spark, MAPPING))
    got_flat = {(r["Asset"], r["Telemetry"], r["DataType"]) for r in flat.collect()}
    expected_flat = brute_force_flat()
    assert ("LNG Tank 1", "PRESSURE", "integer") in got_flat
    assert got_flat == expected_flat
    disc = tp.type_discrepancy(flat).collect()
    got = {(r["Telemetry"], r["Asset"], r["DataType"]) for r in disc}
    assert got == brute_force_discrepancy(got_flat)
    assert {t for t, _a, _d in got} == {"PRESSURE"}


def test_telemetry_by_type(spark, template_dir):
    mapping = {k: v for k, v in MAPPING.items() if k != "Dryers"}
    structs = tp.telemetry_by_type(spark, template_dir, mapping)
    assert [f.name for f in structs["LNG Tank 1"].fields] == ["LEVEL", "ON", "PRESSURE"]
    assert structs["Compressors"]["PRESSURE"].dataType.simpleString() == "double"


def test_unsupported_field_stops_neither_its_template_nor_the_others(spark, template_dir):
    left_out = {}
    structs = tp.telemetry_by_type(spark, template_dir, MAPPING, left_out)
    assert [f.name for f in structs["Dryers"].fields] == ["DEWPOINT", "RUNNINGHR"]
    assert set(left_out) == {"Dryers"} and set(left_out["Dryers"]) == {"MODE"}
    assert "PRESSURE" in structs["Compressors"].names


def test_names_that_differ_in_case_only_are_refused():
    from lakestrata.schemas import telemetry_struct
    with pytest.raises(TemplateError):
        telemetry_struct({"Level": "double", "LEVEL": "float"})


def test_cli_daily_from_templates(spark, template_dir):
    """The command line builds device types from template files and runs the batch."""
    from pyspark.sql import functions as F

    from lakestrata.plans.cli import main
    from lakestrata.session import scratch_path
    from lakestrata.sources.envelope import read_envelope

    log = scratch_path(spark, "test-cli-log")
    # messages typed "Compressors" (RUNNINGHR is declared double in that template)
    read_envelope(spark, "/root/testdata/sf0.001").withColumn(
        "body", F.regexp_replace("body", '"templateName":"[a-z]+"', '"templateName":"Compressors"')
    ).write.parquet(log)
    root = scratch_path(spark, "test-cli") + "/lake"
    assert main(["daily", "--root", root, "--database", "test_cli", "--log", log, "--templates", template_dir,
                 "--type", "Compressors=Compressors.json", "--minutes", "44640", "--as-of", "2024-01-31T00:00:00Z",
                 "--buckets", "4"], spark) == 0
    gold = spark.table("test_cli.gold_Compressors")
    assert gold.agg(F.sum("TotalCount")).first()[0] == spark.table("test_cli.silver_Compressors").count() > 0
    assert main(["discrepancy", "--templates", template_dir, "--type", "Compressors=Compressors.json",
                 "--type", "LNG Tank 1=LNG Tank.json"], spark) == 0
    assert main(["investigate", "--root", root, "--database", "test_cli", "--templates", template_dir,
                 "--type", "Compressors=Compressors.json", "--only", "Compressors"], spark) == 0
    found = spark.table("test_cli.silver_Compressors_investigation")
    assert {r["Reason"] for r in found.collect()} == {"type mismatch", "no telemetry object"}
    before = spark.table("test_cli.silver_Compressors").count()
    assert main(["daily", "--root", root, "--database", "test_cli", "--log", log, "--templates", template_dir,
                 "--type", "Compressors=Compressors.json", "--type", "Dryers=Dryers.json", "--minutes", "1",
                 "--as-of", "2024-03-31T00:00:00Z", "--buckets", "4", "--full-refresh"], spark) == 0
    assert spark.table("test_cli.silver_Compressors").count() == before
    out = scratch_path(spark, "test-discrepancy")
    assert main(["discrepancy", "--templates", template_dir, "--type", "Compressors=Compressors.json",
                 "--type", "LNG Tank 1=LNG Tank.json", "--out", out], spark) == 0
    assert {r["Telemetry"] for r in spark.read.parquet(out).collect()} == {"PRESSURE"}
