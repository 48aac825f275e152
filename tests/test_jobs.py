"""The two jobs end to end over landed JSON files."""

import datetime as dt
import json

import pytest

from tests.conftest import rows
from usagelens import constants as C
from usagelens.operators.adoption import adoption_by_period
from usagelens.operators.turns import audit_turns, normalize_events
from usagelens.plans import jobs, views
from usagelens.sources.tables import TooManyBadRecords

ENGINE = "projects/p/locations/l/collections/c/engines/e1"
AGENT = f"{ENGINE}/assistants/default_assistant/agents"


def audit(number, method, email, **request):
    return {
        "timestamp": f"2024-01-0{number}T10:00:00Z",
        "logName": f"projects/p/logs/{C.AUDIT_DATA_LOG}",
        "insertId": f"a{number}",
        "severity": "INFO",
        "protoPayload": {
            "@type": "t",
            "serviceName": C.SERVICE_NAME,
            "methodName": method,
            "authenticationInfo": {"principalEmail": email},
            "request": request,
            "response": {"x": 1},
        },
    }


def turn(number, email, agent=None, name=None):
    return {
        "timestamp": f"2024-01-0{number}T11:00:00Z",
        "logName": f"projects/p/logs/{C.ASSISTANT_LOG}",
        "insertId": f"t{number}{email}",
        "severity": "INFO",
        "jsonPayload": {
            "userIamPrincipal": email,
            "request": {"agentsSpec": {"agentSpecs": [{"agentId": agent}]}} if agent else {},
            "response": {"agentInfo": {"agent": agent, "displayName": name, "spiffeId": "s"}} if name else {},
        },
    }


EXPORTS = {
    "engines": [{"name": ENGINE, "dataStoreIds": ["d2", "d1"]}],
    "assistants": [{"name": f"{ENGINE}/assistants/default_assistant"}],
    "agents": [{"name": f"{AGENT}/1", "displayName": "My Agent"}, {"name": f"{AGENT}/2", "displayName": "Two"}],
    "agent_details": [
        {"name": f"{AGENT}/1", "displayName": "My Agent", "description": "d", "adkAgentDefinition": {}},
        {"name": "p/engines/e2/agents/9", "displayName": "Nine"},
    ],
    "data_stores": [{"id": "d1", "displayName": "Docs"}],
    "creation_log": [
        {
            "timestamp": "2024-01-01T09:00:00Z",
            "logName": f"projects/p/logs/{C.AUDIT_ADMIN_LOG}",
            "protoPayload": {
                "serviceName": C.SERVICE_NAME,
                "methodName": "x.AgentService.CreateAgent",
                "authenticationInfo": {"principalEmail": "maker@d.com"},
                "response": {"name": f"{AGENT}/1"},
            },
        }
    ],
    "audit_log": [
        audit(1, "v1.AssistantService.StreamAssist", "u1", agent_info={"agent": "1"}),
        audit(2, "v1.NotebookService.GetNotebook", "u2"),
    ],
    "activity_log": [turn(1, "u1", "1", "HR Agent"), turn(1, "u3"), turn(2, "u1", "3", "Three")],
    "session_metrics": [
        {"date": "2024-01-01", "agent_name": f"{AGENT}/1", "agent_session_count": 3,
         "monthly_agent_active_user_count": 2},
        {"date": "2024-01-02", "agent_name": "p/engines/e2/agents/9", "agent_session_count": 4,
         "monthly_agent_active_user_count": 1},
    ],
}


@pytest.fixture
def landing(tmp_path):
    for name, entries in EXPORTS.items():
        folder = tmp_path / "landing" / name
        folder.mkdir(parents=True)
        (folder / "part.json").write_text("\n".join(json.dumps(e) for e in entries))
    return jobs.Landing(str(tmp_path / "landing"))


def test_backfill(spark, landing, warehouse):
    jobs.backfill(spark, landing, warehouse, "2024-01-31")
    directory = warehouse.read("agent_directory")
    assert rows(directory, "agent_id", "display_name", "agent_type", "engine_id", "datastore_names") == [
        ("1", "HR Agent", "Agent Designer", "e1", "d2,Docs"),
        ("2", "Two", "Unknown", "e1", "d2,Docs"),
        ("3", "Three", "Agent Designer", None, None),
    ]
    assert rows(warehouse.read("agent_creators"), "creator_email", "agent_id", "engine_id") == [
        ("maker@d.com", "1", "e1")
    ]
    payload = json.loads(warehouse.read("audit_access").filter("insertId = 'a1'").first()["protopayload_auditlog"])
    assert json.loads(payload["requestJson"]) == {"agent_info": {"agent": "1"}}
    tables = warehouse.read_all()
    # a backfilled request is a string, so its agent does not resolve and the call counts as chat
    events = normalize_events(
        tables["audit_access"], tables["assistant_activity"], tables["notebook_activity"]
    )
    summary = {r.time_period.day: r for r in adoption_by_period(events).collect()}
    assert (summary[1].total_active_users, summary[1].chat_users, summary[1].agent_users) == (2, 2, 1)
    assert (summary[2].total_active_users, summary[2].notebooklm_users) == (2, 1)

    views.register_views(tables)
    assert spark.table("vw_unified_metrics").count() == 2
    assert spark.sql("SELECT max(all_three_pct) FROM vw_feature_adoption_summary").first()[0] == 0.0
    assert spark.table("vw_agent_creators").first()["display_name"] == "HR Agent"
    assert spark.table("vw_user_feature_adoption").count() == 4

    jobs.backfill(spark, landing, warehouse, "2024-01-31")  # may be repeated
    assert warehouse.read("audit_access").count() == 2
    assert warehouse.read("agent_session_metrics").count() == 2


def test_backfill_stops_at_too_many_bad_records(spark, landing, warehouse):
    with open(landing.path("audit_log/torn.json"), "w") as torn:
        torn.write("{torn\n" * 3)
    with pytest.raises(TooManyBadRecords):
        jobs.backfill(spark, landing, warehouse, "2024-01-31", max_bad=2)
    assert warehouse.read("assistant_activity").isEmpty()


def test_nightly(spark, landing, warehouse):
    jobs.backfill(spark, landing, warehouse, "2024-01-31")
    status = jobs.nightly(spark, landing, warehouse, "night-1", engine_spec="e1").first()
    # definitions and metrics of the other engine are left alone
    assert (status.agents_synced, status.names_reconciled, status.metric_rows) == (1, 2, 1)
    # the definition puts the placeholder back, the logged name fills it again
    assert rows(warehouse.read("agent_directory"), "agent_id", "display_name", "description") == [
        ("1", "HR Agent", "d"),
        ("2", "Two", ""),
        ("3", "Three", None),
    ]
    status = jobs.nightly(spark, landing, warehouse, "night-2").first()
    assert (status.agents_synced, status.metric_rows) == (2, 2)
    assert warehouse.read("agent_directory").filter("agent_id = '9'").count() == 1


def test_typed_turns_replace_the_raw_tables(spark, landing, warehouse, tmp_path):
    jobs.backfill(spark, landing, warehouse, "2024-01-31")
    typed = jobs.refresh_turns(warehouse, str(tmp_path / "typed"))
    names = ("audit_access", "assistant_activity", "notebook_activity")
    raw = normalize_events(*[warehouse.read(n) for n in names])
    from_typed = normalize_events(*[typed[n] for n in names])
    assert rows(from_typed) == rows(raw)
    # one day is parsed again without touching the other
    before = set(typed["audit_access"].inputFiles())
    again = jobs.refresh_turns(warehouse, str(tmp_path / "typed"), [dt.date(2024, 1, 1)])
    kept = before & set(again["audit_access"].inputFiles())
    assert len(kept) == 1 and "event_date=2024-01-02" in kept.pop()
    columns = again["audit_access"].columns
    assert rows(again["audit_access"]) == rows(audit_turns(warehouse.read("audit_access")), *columns)
    from_typed = normalize_events(*[again[n] for n in names])
    plan = from_typed._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "IsNotNull(principal)" in plan


def test_exports_are_small_and_many_tasks_can_read_them(spark, monkeypatch):
    import os

    from usagelens import catalogue
    from usagelens.sources.sample_logs import SampleLogs

    monkeypatch.setattr(catalogue, "EXPORT_RECORDS", 100, raising=False)
    sample = SampleLogs(spark, "/root/testdata/sf0.001")
    root = catalogue._exports(sample).root.removeprefix("file:")
    for name, entries in (("creation_log", sample.creation_entries), ("audit_log", sample.audit_entries)):
        plain = sum(len(r[0].encode()) + 1 for r in entries.selectExpr("to_json(struct(*))").collect())
        files = [f for f in os.listdir(f"{root}/{name}") if f.startswith("part-")]
        assert 2 * sum(os.path.getsize(f"{root}/{name}/{f}") for f in files) < plain
        assert len(files) >= entries.count() / 100
        assert spark.read.json(f"{root}/{name}").count() == entries.count()
