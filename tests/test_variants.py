"""Payloads as variants: whole, shredded, read path by path."""

import glob
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_jobs import EXPORTS
from usagelens import constants as C
from usagelens.functions.json_scalar import json_scalars
from usagelens.operators.adoption import adoption_by_period
from usagelens.operators.reshape import reshape_audit
from usagelens.operators.turns import audit_turns, normalize_events
from usagelens.plans import jobs
from usagelens.sources import logs, variants
from usagelens.sources.sample_logs import SampleLogs

TINY = "/root/testdata/sf0.001"
NAME = f"p/logs/{C.AUDIT_DATA_LOG}"


def entry(number, payload):
    return {"timestamp": f"2024-01-0{number}T10:00:00Z", "logName": NAME, "insertId": str(number), "severity": "INFO", "protoPayload": payload}


def written(tmp_path, entries):
    path = tmp_path / "entries"
    path.mkdir()
    (path / "part.json").write_text("\n".join(json.dumps(e) for e in entries))
    return str(path)


def nested(depth):
    inner = {"@deep": 1, "kept": 2}
    for _ in range(depth):
        inner = {"@x": 0, "list": [inner, [{"@y": 1}]]}
    return inner


def cleaned(value):
    if isinstance(value, dict):
        return {k: cleaned(v) for k, v in value.items() if not k.startswith("@")}
    return [cleaned(v) for v in value] if isinstance(value, list) else value


PAYLOADS = [
    {"@type": "t", "serviceName": C.SERVICE_NAME, "new": {"a": [1, {"b": None}]}, "request": {"@type": "q", "z": 1, "a": [True]}, "response": {"x": 1}},
    {"serviceName": C.SERVICE_NAME, "new": "now text", "status": {"code": 5, "details": [1], "@z": 1, "more": {"@a": 1, "b": 2}}, "request": None},
    {"serviceName": C.SERVICE_NAME, "new": 7, "status": "text", "ünïcode": "@ is fine in values: \"@x\"", "empty": {}, "none": []},
    {"serviceName": C.SERVICE_NAME, "grants": nested(3), "request": "plain text"},
]


def test_unknown_and_changing_fields_stay(spark, tmp_path):
    path = written(tmp_path, [entry(i + 1, p) for i, p in enumerate(PAYLOADS)])
    got = variants.reshape_audit(variants.read_entries(spark, path)).select("insertId", F.to_json("protopayload_auditlog").alias("p"))
    for number, text in rows(got):
        payload = PAYLOADS[int(number) - 1]
        expected = cleaned({k: v for k, v in payload.items() if k not in ("request", "response")})
        if isinstance(expected.get("status"), dict):
            expected["status"].pop("details")
        found = json.loads(text)
        if payload.get("request") is not None:
            assert json.loads(found.pop("requestJson")) == payload["request"]
        assert found == expected


def test_payloads_that_are_no_objects(spark, tmp_path):
    entries = [entry(1, [1, {"@a": 1}]), entry(2, "text"), entry(3, None), {k: v for k, v in entry(4, 0).items() if k != "protoPayload"}]
    got = variants.reshape_audit(variants.read_entries(spark, written(tmp_path, entries)))
    assert rows(got.select("insertId", F.to_json("protopayload_auditlog"))) == [("1", '[1,{"@a":1}]'), ("2", '"text"'), ("3", "null"), ("4", None)]


def test_keys_go_at_depth_and_not_beyond(spark):
    text = json.dumps(nested(5))
    frame = spark.createDataFrame([(text,)], "t string").select(F.parse_json("t").alias("v"))
    assert json.loads(frame.select(F.to_json(variants.without_keys(F.col("v")))).first()[0]) == cleaned(nested(5))
    one = json.loads(frame.select(F.to_json(variants.without_keys(F.col("v"), depth=1))).first()[0])
    assert "@x" not in one and "@x" in one["list"][0]


def test_same_rows_as_the_record_form(spark, tmp_path):
    sample = SampleLogs(spark, TINY)
    path = str(tmp_path / "audit")
    sample.audit_entries.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    record = reshape_audit(logs.read_audit_log(spark, path, "2024-01-31"))
    variant = variants.reshape_audit(logs.select_audit_log(variants.read_entries(spark, path), "2024-01-31"))

    def parsed(df, text):
        found = {r[0]: json.loads(r[1]) for r in df.select("insertId", text).collect()}
        for payload in found.values():
            if "requestJson" in payload:
                payload["requestJson"] = json.loads(payload["requestJson"])
        return found

    assert parsed(variant, F.to_json("protopayload_auditlog")) == parsed(record, "protopayload_auditlog")


@pytest.fixture
def landed(spark, warehouse):
    warehouse.ensure_tables("log_variants")
    variants.append(warehouse, SampleLogs(spark, TINY).audit_branches, "audit_access", "first")
    return warehouse


def test_paths_reach_the_scan_of_shredded_files(spark, landed):
    rows_ = variants.read(landed, "audit_access")
    plan = audit_turns(rows_)._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "parse_json" not in plan and plan.count("FileScan") == 1
    assert "ReadSchema: struct<" in plan and "payload:struct<0:" in plan
    files = glob.glob(f"{landed.path('log_variants')}/table=audit_access/**/*.parquet", recursive=True)
    assert files and all("typed_value" in str(pq.ParquetFile(f).schema) for f in files)
    assert spark.conf.get("spark.sql.variant.writeShredding.enabled", "false") == "false"


def test_turns_equal_those_of_text(spark, landed):
    sample = SampleLogs(spark, TINY)
    empty = (sample.assistant_activity.limit(0), sample.notebook_activity.limit(0))
    for decode in (False, True):
        from_text = normalize_events(sample.audit_branches, *empty, decode)
        assert rows(normalize_events(variants.read(landed, "audit_access"), *empty, decode)) == rows(from_text)


def test_text_that_is_no_json_is_kept(spark, warehouse):
    warehouse.ensure_tables("log_variants")
    columns = "timestamp timestamp, logName string, insertId string, severity string, jsonPayload string"
    data = [(None, "l", "1", None, "{torn"), (None, None, "2", None, None), (None, "l", "3", None, '{"userIamPrincipal":"u"}')]
    variants.append(warehouse, spark.createDataFrame(data, columns), "assistant_activity", "one")
    variants.append(warehouse, spark.createDataFrame(data, columns), "assistant_activity", "one")  # a repeated load replaces itself
    got = variants.read(warehouse, "assistant_activity")
    assert rows(got.select("insertId", F.to_json("jsonPayload"))) == [("1", '"{torn"'), ("2", None), ("3", '{"userIamPrincipal":"u"}')]
    found = json_scalars(got, "jsonPayload", {"who": "$.userIamPrincipal"}, ["insertId"])
    assert rows(found) == [("1", None), ("2", None), ("3", "u")]


def test_backfill_with_variants(spark, warehouse, tmp_path):
    for name, entries in EXPORTS.items():
        folder = tmp_path / "landing" / name
        folder.mkdir(parents=True)
        (folder / "part.json").write_text("\n".join(json.dumps(e) for e in entries))
    landing = jobs.Landing(str(tmp_path / "landing"))
    for _ in range(2):  # may be repeated
        jobs.backfill(spark, landing, warehouse, "2024-01-31", as_variants=True)
    audit, activity = (variants.read(warehouse, t) for t in ("audit_access", "assistant_activity"))
    assert (audit.count(), activity.count(), warehouse.read("audit_access").count()) == (2, 3, 0)
    assert rows(warehouse.read("agent_directory"), "agent_id", "display_name") == [("1", "HR Agent"), ("2", "Two"), ("3", "Three")]
    # spiffeId is no declared field
    assert rows(activity.select(F.try_variant_get("jsonPayload", "$.response.agentInfo.spiffeId", "string"))) == [("s",), ("s",), (None,)]
    summary = {r.time_period.day: r for r in adoption_by_period(warehouse.read("usage_events").withColumnRenamed("event_date", "activity_date")).collect()}
    assert (summary[1].total_active_users, summary[1].chat_users, summary[1].agent_users) == (2, 2, 1)
