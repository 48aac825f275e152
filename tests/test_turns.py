"""Normalisation rules, one small log row per rule."""

import datetime as dt
import json

import pytest

from tests.conftest import rows
from usagelens import constants as C
from usagelens.operators.adoption import adoption_by_period, adoption_from_ledger, user_ledger
from usagelens.operators.turns import (
    agent_turns,
    assistant_turns,
    audit_turns,
    engine_turns,
    normalize_base_events,
    normalize_events,
    notebook_turns,
)

DAY = dt.datetime(2024, 1, 5, 23, 59, 59)
ASSIST = "google.cloud.discoveryengine.v1.AssistantService.StreamAssist"


def assistant(spark, *payloads, log="projects/p/logs/" + C.ASSISTANT_LOG):
    data = [(DAY, log, str(i), "INFO", json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(
        data, "timestamp timestamp, logName string, insertId string, severity string, jsonPayload string"
    )


def audit(spark, *payloads, log="projects/p/logs/" + C.AUDIT_DATA_LOG):
    return assistant(spark, *payloads, log=log).withColumnRenamed("jsonPayload", "protopayload_auditlog")


def call(method=ASSIST, service=C.SERVICE_NAME, email="u@d.com", **request):
    payload = {"serviceName": service, "methodName": method, "authenticationInfo": {"principalEmail": email}}
    return payload | request


def flags(spark, *, audits=(), turns=(), notes=(), **options):
    events = normalize_events(
        audit(spark, *audits), assistant(spark, *turns), assistant(spark, *notes), **options
    )
    return rows(events, "is_chat", "is_agent", "is_nblm", "agent_id")


SPEC = {"agentsSpec": {"agentSpecs": [{"agentId": "111"}]}}

TURNS = {
    "plain chat": ({"request": {}}, (True, False, False, None)),
    "agent answered": (
        {"request": SPEC, "response": {"agentInfo": {"agent": "111", "displayName": "HR"}}},
        (False, True, False, "111"),
    ),
    # the spec is an object, hence no scalar, hence chat; the id is still recorded
    "agent requested, none answered": ({"request": SPEC}, (True, False, False, "111")),
    "spec as a scalar": ({"request": {"agentsSpec": "x"}}, (False, None, False, None)),
    "system agent answered": (
        {"response": {"agentInfo": {"agent": "default_assistant"}}},
        (False, False, False, None),
    ),
    "answering agent wins": (
        {"request": SPEC, "response": {"agentInfo": {"agent": "222"}}},
        (False, True, False, "222"),
    ),
}


@pytest.mark.parametrize("case", TURNS)
def test_assistant_turns(spark, case):
    payload, expected = TURNS[case]
    assert flags(spark, turns=[{"userIamPrincipal": "u@d.com"} | payload]) == [expected]


AUDITS = {
    "core assistant": (call(request={"agent_info": {"core_assistant": True}}), (True, False, False, None)),
    # whether the core assistant was meant is unknown, and stays unknown
    "agent": (call(request={"agent_info": {"agent": "5"}}), (None, True, False, "5")),
    "agent, not core": (
        call(request={"agent_info": {"core_assistant": False, "agent": "5"}}),
        (False, True, False, "5"),
    ),
    "core assistant with an agent is both": (
        call(request={"agent_info": {"core_assistant": True, "agent": "5"}}),
        (True, True, False, "5"),
    ),
    "spec object only": (
        call(request={"agents_spec": {"agent_specs": [{"agent_id": "6"}]}}),
        (True, False, False, "6"),
    ),
    "system agent": (
        call(request={"agent_info": {"agent": "workflow_summary_agent"}}),
        (None, False, False, None),
    ),
    "embedded record": (call(requestJson={"agent_info": {"agent": "7"}}), (None, True, False, "7")),
    "embedded string": (call(requestJson='{"agent_info":{"agent":"7"}}'), (True, False, False, None)),
    "notebook": (call("x.NotebookService.Get"), (False, False, True, None)),
    "sources": (call("x.SourceService.Create"), (False, False, True, None)),
    "audio": (call("x.AudioOverviewService.Create"), (False, False, True, None)),
    "other service": (call(service="other"), (False, False, False, None)),
    # unknown stays unknown: service NULL, method NULL
    "no service and method": (
        {"authenticationInfo": {"principalEmail": "u"}, "request": {"agent_info": {"agent": "7"}}},
        (None, None, None, "7"),
    ),
}


@pytest.mark.parametrize("case", AUDITS)
def test_audit_turns(spark, case):
    payload, expected = AUDITS[case]
    assert flags(spark, audits=[payload]) == [expected]


def test_embedded_string_can_be_decoded(spark):
    payloads = [call(requestJson='{"agent_info":{"agent":"7"}}'), call(request={"agent_info": {"agent": "8"}})]
    assert flags(spark, audits=payloads, decode_embedded_json=True) == [
        (None, True, False, "7"),
        (None, True, False, "8"),
    ]


def test_notebook_principal_in_both_spellings_and_nobody(spark):
    notes = [{"userIamPrincipal": "A"}, {"useriamprincipal": "b"}, {"servicelabel": "x"}]
    events = normalize_events(audit(spark), assistant(spark), assistant(spark, *notes))
    assert rows(events, "user_email", "is_nblm") == [("A", True), ("b", True)]


def test_day_is_utc(spark):
    events = normalize_events(audit(spark), assistant(spark, {"userIamPrincipal": "u"}), assistant(spark))
    assert events.first()["activity_date"] == dt.date(2024, 1, 5)


def test_base_events_lower_case_and_classify_by_requested_agent(spark):
    turns = [
        {"userIamPrincipal": "U@D.com", "request": SPEC},
        {"useriamprincipal": "U@D.com"},
        {"userIamPrincipal": "u@d.com", "request": {"agentsSpec": {"agentSpecs": [{"agentId": "default_assistant"}]}}},
    ]
    events = normalize_base_events(assistant(spark, *turns), assistant(spark, {"useriamprincipal": "N"}))
    assert rows(events, "user_email", "is_chat", "is_agent", "is_nblm") == [
        ("n", False, False, True),
        ("u@d.com", False, True, False),
        ("u@d.com", True, False, False),
        ("u@d.com", True, False, False),
    ]


def test_turns_without_principal_count_for_agents(spark):
    turns = assistant(spark, {"request": SPEC}, {"userIamPrincipal": "U", "request": SPEC})
    assert rows(agent_turns(turns), "agent_id", "user_email") == [("111", "u"), ("111", None)]


def test_engine_falls_back_along_the_paths(spark):
    turns = assistant(
        spark,
        {"userIamPrincipal": "a", "response": {"agentInfo": {"spiffeId": "x/engines/e1/y"}}},
        {"userIamPrincipal": "b", "request": {"assistantsSpec": {"assistant": "p/engines/e2/assistants/z"}}},
        {"userIamPrincipal": "c"},
    )
    assert rows(engine_turns(turns), "user_email", "engine_id") == [
        ("a", "e1"),
        ("b", "e2"),
        ("c", "default_engine"),
    ]


def test_typed_tables_give_the_same_events(spark):
    audits = audit(spark, *[payload for payload, _ in AUDITS.values()])
    turns = assistant(spark, *[{"userIamPrincipal": "u"} | payload for payload, _ in TURNS.values()])
    notes = assistant(spark, {"useriamprincipal": "b"})
    raw = normalize_events(audits, turns, notes)
    typed = normalize_events(audit_turns(audits), assistant_turns(turns), notebook_turns(notes))
    assert rows(raw) == rows(typed)


def test_ledger_and_summary_keep_flagless_users(spark):
    turns = [
        {"userIamPrincipal": "a", "response": {"agentInfo": {"agent": "default_assistant"}}},
        {"userIamPrincipal": "b", "response": {"agentInfo": {"agent": "9"}}},
        {"userIamPrincipal": "b", "response": {"agentInfo": {"agent": "10"}}},
        {"userIamPrincipal": "b", "response": {"agentInfo": {"agent": "9"}}},
    ]
    events = normalize_events(audit(spark), assistant(spark, *turns), assistant(spark))
    ledger = user_ledger(events)
    assert rows(ledger, "user_email", "used_chat", "used_agents", "agent_ids_used") == [
        ("a", False, False, []),
        ("b", False, True, ["10", "9"]),
    ]
    direct, stored = adoption_by_period(events), adoption_from_ledger(ledger)
    assert rows(direct) == rows(stored)
    row = direct.first()
    assert (row["total_active_users"], row["agent_users"], row["agent_pct"]) == (2, 1, 50.0)
    assert row["distinct_agents_used"] == 2
