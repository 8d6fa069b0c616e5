"""Flag rule and field diagnosis on the edge-case bodies of FIXTURES.md section 5."""

import pytest
from pyspark.sql import functions as F

from lakestrata.functions.expressions import parse_failed
from lakestrata.operators import diagnosis, silver
from lakestrata.schemas import TemplateError, message_schema, telemetry_struct

TELE = telemetry_struct({"D": "double", "I": "integer", "B": "boolean"})


def body(telemetry_part):
    head = '{"deviceId":"d1","templateName":"T","enqueuedTime":"2024-05-01T23:59:59-05:00"'
    return head + ("}" if telemetry_part is None else f',"telemetry":{telemetry_part}}}')


# (name, body, flagged, offending fields, reason)
CASES = [
    ("good", body('{"D":1.5,"I":2,"B":true}'), 0, set(), None),
    ("wrong double", body('{"D":"x","I":2}'), 1, {"D"}, "type mismatch"),
    ("number in a string", body('{"D":"1.5"}'), 1, {"D"}, "type mismatch"),
    ("fraction in integer", body('{"I":1.5}'), 1, {"I"}, "type mismatch"),
    ("whole float in integer", body('{"I":2.0}'), 1, {"I"}, "type mismatch"),
    ("integer overflow", body('{"I":3000000000}'), 1, {"I"}, "type mismatch"),
    ("number in boolean", body('{"B":1}'), 1, {"B"}, "type mismatch"),
    ("three bad fields", body('{"D":"x","I":1.5,"B":"true"}'), 1, {"D", "I", "B"}, "type mismatch"),
    ("not-a-number", body('{"D":NaN}'), 0, set(), None),
    ("empty object", body("{}"), 0, set(), None),
    ("telemetry absent", body(None), 1, set(), "no telemetry object"),
    ("telemetry null", body("null"), 1, set(), "no telemetry object"),
    ("telemetry string", body('"abc"'), 1, set(), "no telemetry object"),
    ("telemetry number", body("5"), 1, set(), "no telemetry object"),
    ("telemetry array", body('[{"D":1}]'), 1, set(), "no telemetry object"),
    ("body not JSON", "not json", 1, set(), "unreadable body"),
    ("body truncated", '{"deviceId":"d1","telemetry":{"D":1', 1, set(), "unreadable body"),
    ("body empty", "", 1, set(), "unreadable body"),
    ("body null", None, 1, set(), "unreadable body"),
    ("duplicate key bad then good", body('{"D":"x","D":1}'), 1, set(), "type mismatch"),
    ("duplicate key good then bad", body('{"D":1,"D":"x"}'), 1, set(), "type mismatch"),
    ("field outside the template", body('{"Z":9}'), 0, set(), None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(i, name, b, "T", "d1") for i, (name, b, *_rest) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id int, case string, body string, templateName string, deviceId string")
    df = df.withColumn("loadDatetime", F.lit("2024-05-02 00:00:00").cast("timestamp"))
    df = df.withColumn("enqueuedTime", F.lit("2024-05-02 00:00:00").cast("timestamp"))
    df = df.withColumn("rowhash", F.sha2("body", 256))
    return silver.parse(df, TELE).cache()


def test_flags(parsed):
    got = {r["case"]: r["flagged"] for r in parsed.select("case", "flagged").collect()}
    assert got == {name: flag for name, _b, flag, *_ in CASES}


def test_diagnosis(spark, parsed):
    per_case = {}
    for r in parsed.select("id", "case").collect():
        one = diagnosis.diagnose(parsed.filter(F.col("id") == r["id"]), TELE).collect()
        per_case[r["case"]] = ({x["FlaggedField"] for x in one if x["FlaggedField"]}, {x["Reason"] for x in one})
    for name, _b, flag, fields, reason in CASES:
        got_fields, got_reasons = per_case[name]
        assert got_fields == fields, name
        assert got_reasons == ({reason} if reason else set()), name


def test_one_pass_equals_strict_parse(spark, parsed):
    """The flag equals a whole-record (strict) parse, whatever the partial-results setting."""
    key = "spark.sql.json.enablePartialResults"
    spark.conf.set(key, "false")
    try:
        strict = parsed.select(
            "case", parse_failed(F.from_json("body", message_schema(TELE)), F.col("body")).alias("strict")
        ).collect()
        strict = {r["case"]: int(bool(r["strict"])) for r in strict}
    finally:
        spark.conf.set(key, "true")
    ours = {r["case"]: r["flagged"] for r in parsed.select("case", "flagged").collect()}
    assert ours == strict


def test_each_body_is_parsed_once(spark):
    columns = "body string, templateName string, deviceId string, loadDatetime timestamp, enqueuedTime timestamp, rowhash string"
    plan = silver.rows(silver.parse(spark.range(1).selectExpr(*[f"cast(cast(id as string) as {c.split()[1]}) as {c.split()[0]}" for c in columns.split(", ")]), TELE))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1, plan


def test_silver_rows_layout(parsed):
    out = silver.rows(parsed)
    assert out.columns == ["Eventhub_enqueuedTime", "Device_enqueuedTime", "Device_Date", "templateName",
                           "DeviceId", "B", "D", "I", "loaddatetime", "rowhash"]
    good = out.filter(F.col("D") == 1.5).first()
    # the date is taken as written, ignoring the offset; the timestamp is the instant in UTC
    assert str(good["Device_Date"]) == "2024-05-01"
    assert str(good["Device_enqueuedTime"]) == "2024-05-02 04:59:59"


def test_flags_distinct(parsed):
    fl = silver.flags(parsed).collect()
    assert len(fl) == 1 and fl[0]["TemplateName"] == "T" and str(fl[0]["load_date"]) == "2024-05-02"


def test_template_rejects_bad_types():
    with pytest.raises(TemplateError):
        telemetry_struct({"X": "string"})
    with pytest.raises(TemplateError):
        telemetry_struct({"rowhash": "double"})
    assert [f.name for f in telemetry_struct({"b": "float", "a": "integer"}).fields] == ["a", "b"]


def test_diagnosis_equals_per_field_strict_parses(spark, parsed):
    """Q2 parity: field f is named iff a strict parse with only f in the template fails."""
    from pyspark.sql import types as T
    key = "spark.sql.json.enablePartialResults"
    ours = {}
    for r in parsed.select("case").collect():
        one = diagnosis.diagnose(parsed.filter(F.col("case") == r["case"]), TELE).collect()
        ours[r["case"]] = {x["FlaggedField"] for x in one if x["Reason"] == "type mismatch" and x["FlaggedField"]}
    spark.conf.set(key, "false")
    try:
        for field in TELE.fields:
            only = T.StructType([field])
            rows = parsed.select(
                "case",
                F.from_json("body", message_schema(only)).getField("telemetry").isNull().alias("bad_alone"),
                F.from_json("body", message_schema(T.StructType([]))).getField("telemetry").isNull().alias("bad_empty"),
            ).collect()
            for r in rows:
                if r["case"].startswith("duplicate key"):
                    continue  # flagged, but a good value of the same key hides the bad one: no field is named
                strict_blames = bool(r["bad_alone"]) and not bool(r["bad_empty"])
                assert strict_blames == (field.name in ours[r["case"]]), (r["case"], field.name)
    finally:
        spark.conf.set(key, "true")


def test_empty_findings_schema(spark, parsed):
    empty = diagnosis.empty_findings(spark)
    assert empty.count() == 0
    assert empty.schema.names == diagnosis.diagnose(parsed, TELE).schema.names
