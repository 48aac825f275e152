import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from usagelens import constants as C
from usagelens import schemas
from usagelens.functions.columns import engine_of, last_segment
from usagelens.sources import logs
from usagelens.operators.reshape import reshape_audit
from usagelens.session import is_one_process
from usagelens.sources.tables import ConcurrentReplace, TooManyBadRecords, align_schema, load_with_bad_budget


def entry(log, when, method="x.CreateAgent", service=C.SERVICE_NAME, number="1"):
    return {
        "timestamp": when,
        "logName": f"projects/p/logs/{log}",
        "insertId": number,
        "protoPayload": {"serviceName": service, "methodName": method, "request": {"a": 1}},
        "jsonPayload": {"userIamPrincipal": "u"},
    }


def landed(tmp_path, entries, as_array=False):
    path = tmp_path / "landed.json"
    path.write_text(json.dumps(entries) if as_array else "\n".join(json.dumps(e) for e in entries))
    return str(path)


@pytest.mark.parametrize("as_array", [False, True])
def test_creation_scan(spark, tmp_path, as_array):
    entries = [
        entry(C.AUDIT_ADMIN_LOG, "2024-01-31T23:59:59Z", number="in"),
        entry(C.AUDIT_ADMIN_LOG, "2023-01-31T00:00:00Z", number="first day"),
        entry(C.AUDIT_ADMIN_LOG, "2023-01-30T23:59:59Z", number="too old"),
        entry(C.AUDIT_ADMIN_LOG, "2024-02-01T00:00:00Z", number="too new"),
        entry(C.AUDIT_ADMIN_LOG, "2024-01-01T00:00:00Z", method="x.DeleteAgent", number="method"),
        entry(C.AUDIT_ADMIN_LOG, "2024-01-01T00:00:00Z", service="other", number="service"),
        entry(C.AUDIT_DATA_LOG, "2024-01-01T00:00:00Z", number="log"),
    ]
    path = landed(tmp_path, entries, as_array)
    found = logs.read_creation_log(spark, path, "2024-01-31", multi_line=as_array)
    assert rows(found, "insertId") == [("first day",), ("in",)]


def test_scans_of_the_other_logs_and_cap(spark, tmp_path):
    entries = [
        entry(C.AUDIT_DATA_LOG, "2024-01-30T00:00:00Z", number="a"),
        entry(C.AUDIT_DATA_LOG, "2024-01-29T00:00:00Z", number="b"),
        entry(C.AUDIT_DATA_LOG, "2024-01-29T00:00:00Z", service="other", number="c"),
        entry(C.ASSISTANT_LOG, "2024-01-28T00:00:00Z", number="d"),
        entry(C.NOTEBOOK_LOG, "2024-01-28T00:00:00Z", number="e"),
    ]
    path = landed(tmp_path, entries)
    audit = logs.read_audit_log(spark, path, "2024-01-31")
    assert rows(audit, "insertId") == [("a",), ("b",)]
    assert audit.filter("insertId = 'a'").first()["protoPayload"]["request"].toJson() == '{"a":1}'
    assert rows(logs.read_audit_log(spark, path, "2024-01-31", cap=1), "insertId") == [("a",)]
    assert rows(logs.read_audit_log(spark, path, "2024-01-31", lookback_days=1), "insertId") == [("a",)]
    assert rows(logs.read_activity_log(spark, path, "2024-01-31"), "insertId") == [("d",)]


@pytest.mark.parametrize("bad_lines", [0, 3, 4])
def test_bad_record_budget(spark, tmp_path, bad_lines):
    good = [json.dumps(entry(C.ASSISTANT_LOG, "2024-01-01T00:00:00Z", number=str(i))) for i in range(20)]
    path = tmp_path / "torn.json"
    path.write_text("\n".join(good + ['{"timestamp": "2024-01-01T0'] * bad_lines))
    if bad_lines > 3:
        with pytest.raises(TooManyBadRecords, match="4 malformed"):
            load_with_bad_budget(spark, str(path), schemas.ACTIVITY_ENTRY, max_bad=3)
        return
    loaded, bad = load_with_bad_budget(spark, str(path), schemas.ACTIVITY_ENTRY, max_bad=3)
    assert (loaded.count(), bad.count()) == (20, bad_lines)


def test_default_budget_is_exact(spark, tmp_path):
    path = tmp_path / "torn.json"
    path.write_text("\n".join(["{torn"] * C.BAD_RECORD_BUDGET))
    assert load_with_bad_budget(spark, str(path), schemas.ACTIVITY_ENTRY)[1].count() == 1000
    path.write_text("\n".join(["{torn"] * (C.BAD_RECORD_BUDGET + 1)))
    with pytest.raises(TooManyBadRecords):
        load_with_bad_budget(spark, str(path), schemas.ACTIVITY_ENTRY)


@pytest.mark.parametrize(
    "spec, kept",
    [
        ("a, b ,,c", ["a", "b", "c"]),
        ("b", ["b"]),
        ("all", ["a", "b", "c", "d"]),
        ("Auto", ["a", "b", "c", "d"]),
        ("*", ["a", "b", "c", "d"]),
        ("", ["a", "b", "c", "d"]),
        (None, ["a", "b", "c", "d"]),
    ],
)
def test_engine_selection(spark, spec, kept):
    df = spark.createDataFrame([(e,) for e in "abcd"], "engine string")
    assert [r[0] for r in rows(logs.filter_engines(df, spec, F.col("engine")))] == kept


def test_a_list_without_engines_is_an_error(spark):
    with pytest.raises(ValueError, match="no engine"):
        logs.filter_engines(spark.createDataFrame([("a",)], "engine string"), " , ", F.col("engine"))


def test_backfilled_payloads_keep_undeclared_fields(spark, tmp_path):
    one = entry(C.AUDIT_DATA_LOG, "2024-01-30T00:00:00Z", number="a")
    one["protoPayload"] |= {
        "metadata": {"kind": "m", "@x": 1}, "request": {"b": 1, "c": [1, {"d": None}]}, "response": {"r": 1},
        "authenticationInfo": {"principalEmail": "u", "thirdParty": {"z": 2}}, "status": {"code": 5, "details": [1]},
    }
    got = reshape_audit(logs.read_audit_log(spark, landed(tmp_path, [one]), "2024-01-31")).first()
    payload = json.loads(got["protopayload_auditlog"])
    assert payload["metadata"] == {"kind": "m"} and "response" not in payload and payload["status"] == {"code": 5}
    assert payload["authenticationInfo"] == {"principalEmail": "u", "thirdParty": {"z": 2}}
    assert payload["requestJson"] == '{"b":1,"c":[1,{"d":null}]}'


def test_rejected_lines_are_kept_and_a_share_is_allowed(spark, warehouse, tmp_path):
    path = tmp_path / "lines"
    path.mkdir()
    good = json.dumps(entry(C.ASSISTANT_LOG, "2024-01-28T00:00:00Z", number="d"))
    (path / "a.json").write_text("\n".join([good] * 8 + ["{torn"] * 2))
    with pytest.raises(TooManyBadRecords):
        load_with_bad_budget(spark, str(path), schemas.ACTIVITY_ENTRY, max_bad=1, max_share=0.1)
    loaded, bad = load_with_bad_budget(spark, str(path), schemas.ACTIVITY_ENTRY, max_bad=1, max_share=0.2)
    warehouse.reject(bad, "activity_log", "one")
    assert loaded.count() == 8
    assert rows(warehouse.read("rejected_lines"), "line", "source") == [("{torn", "activity_log")] * 2


def test_interleaved_writers_do_not_lose_rows(spark, warehouse):
    first = spark.createDataFrame([("1", "a")], "agent_id string, display_name string")
    second = spark.createDataFrame([("2", "b")], "agent_id string, display_name string")
    warehouse.replace(first, "agent_directory")
    number = warehouse.current("agent_directory")[0]
    warehouse.replace(first.union(second), "agent_directory", base=number)
    with pytest.raises(ConcurrentReplace):
        warehouse.replace(first, "agent_directory", base=number)
    turns = []

    def add(current):
        if not turns:  # another writer comes in between
            turns.append(1)
            warehouse.replace(second, "agent_directory")
        return current.select("agent_id", "display_name").union(spark.createDataFrame([("3", "c")], second.schema))

    warehouse.update("agent_directory", add)
    assert rows(warehouse.read("agent_directory"), "agent_id") == [("2",), ("3",)]


def test_only_days_of_several_loads_are_aggregated(spark, warehouse):
    def load(load_id, *entries):
        df = spark.createDataFrame([("l", day, key, text) for day, key, text in entries],
                                   "logName string, day string, insertId string, jsonPayload string")
        df = df.withColumn("timestamp", F.to_timestamp("day")).withColumn("severity", F.lit("INFO"))
        warehouse.append(df, "assistant_activity", load_id)

    load("stream", ("2024-01-01", "1", "long"), ("2024-01-01", None, "x"), ("2024-01-02", "2", "y"), ("2024-01-02", "2", "y"))
    load("backfill", ("2024-01-01", "1", "s"), ("2024-01-01", None, "x"))
    got = rows(warehouse.read_once("assistant_activity"), "insertId", "jsonPayload")
    assert sorted(got, key=str) == sorted([("1", "long"), (None, "x"), (None, "x"), ("2", "y"), ("2", "y")], key=str)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    for master, alone in {"local": True, "local[4]": True, "local[*]": True, "local-cluster[2,1,1024]": False, "yarn": False}.items():
        assert is_one_process(master) == alone


def test_paths(spark):
    df = spark.createDataFrame(
        [("p/engines/e1/agents/7",), ("agents/7",), ("7",), ("",), (None,), ("engines//x",)], "path string"
    )
    got = [tuple(r) for r in df.select(last_segment(F.col("path")), engine_of(F.col("path"))).collect()]
    assert got == [("7", "e1"), ("7", None), ("7", None), ("", None), (None, None), ("x", None)]


def test_missing_columns_are_added(spark):
    old = spark.createDataFrame([("1", "One", 5)], "agent_id string, display_name string, other int")
    aligned = align_schema(old, schemas.AGENT_DIRECTORY)
    assert aligned.columns == [f.name for f in schemas.parsed(schemas.AGENT_DIRECTORY).fields]
    assert tuple(aligned.first())[:3] == ("1", "One", None)


def test_inferred_updates_are_aligned(spark, tmp_path):
    path = tmp_path / "updates.json"
    path.write_text('{"agent_id": 7, "display_name": "Seven", "unknown": [1]}\n{"agent_id": 8}')
    assert rows(logs.read_directory_updates(spark, str(path))) == [
        ("7", "Seven", None, None, None),
        ("8", None, None, None, None),
    ]


def log_rows(spark, *times):
    data = [(t, "l", str(i), "INFO", "{}") for i, t in enumerate(times)]
    return spark.createDataFrame(
        data, "timestamp timestamp, logName string, insertId string, severity string, jsonPayload string"
    )


def test_appends_accumulate_and_repeats_replace(spark, warehouse):
    day1, day2 = dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 2, 5)
    warehouse.append(log_rows(spark, day1, day2), "assistant_activity", "a")
    warehouse.append(log_rows(spark, day2), "assistant_activity", "b")
    warehouse.append(log_rows(spark, day2), "assistant_activity", "b")
    table = warehouse.read("assistant_activity")
    assert rows(table, "event_date") == [(day1.date(),), (day2.date(),), (day2.date(),)]
    assert warehouse.read("notebook_activity").isEmpty()


def test_ensure_keeps_existing_tables(spark, warehouse):
    warehouse.append(log_rows(spark, dt.datetime(2024, 1, 1)), "assistant_activity", "a")
    warehouse.ensure_tables()
    assert warehouse.read("assistant_activity").count() == 1


def test_days_prune_partitions(spark, warehouse):
    times = [dt.datetime(2024, 1, d) for d in range(1, 6)]
    warehouse.append(log_rows(spark, *times), "assistant_activity", "a")
    day = warehouse.read("assistant_activity").filter("event_date = DATE '2024-01-03'")
    assert len(day.inputFiles()) >= 1 and day.count() == 1
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_snapshots_are_replaced_from_themselves(spark, warehouse):
    assert warehouse.read("agent_directory").isEmpty()
    first = spark.createDataFrame([("1", "One")], "agent_id string, display_name string")
    old_path = warehouse.replace(first, "agent_directory")
    grown = warehouse.read("agent_directory").unionByName(
        spark.createDataFrame([("2",)], "agent_id string"), allowMissingColumns=True
    )
    warehouse.replace(grown, "agent_directory")
    assert rows(warehouse.read("agent_directory"), "agent_id", "display_name") == [("1", "One"), ("2", None)]
    # the version a reader may still hold is untouched
    assert spark.read.parquet(old_path).count() == 1
    assert not warehouse.replace_if_any(grown.limit(0), "agent_directory")
    assert warehouse.read("agent_directory").count() == 2


def test_session_metrics_formats(spark, tmp_path):
    df = spark.sql(
        "SELECT DATE '2024-01-01' AS date, 'a' AS agent_name, 1L AS agent_session_count,"
        " 2L AS monthly_agent_active_user_count"
    )
    df.write.json(str(tmp_path / "json"))
    df.write.parquet(str(tmp_path / "parquet"))
    expected = [(dt.date(2024, 1, 1), "a", 1, 2)]
    assert rows(logs.read_session_metrics(spark, str(tmp_path / "json"))) == expected
    assert rows(logs.read_session_metrics(spark, str(tmp_path / "parquet"), "parquet")) == expected
