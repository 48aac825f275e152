import json

from tests.conftest import rows
from usagelens import schemas
from usagelens.operators.reshape import extract_creators, project_activity, reshape_audit


def read(spark, tmp_path, entries, schema):
    path = tmp_path / "entries.json"
    path.write_text("\n".join(json.dumps(e) for e in entries))
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(str(path))


def creation(**payload):
    return {"timestamp": "2024-01-01T00:00:00.123456Z", "protoPayload": payload}


def test_creator_fallbacks(spark, tmp_path):
    entries = [
        creation(
            authenticationInfo={"principalEmail": "a@d.com"},
            request={"agent": {"name": "p/engines/e1/assistants/x/agents/1", "displayName": "One"}},
            response={"name": "ignored/engines/e9/2", "displayName": "Ignored"},
        ),
        creation(
            authenticationInfo={"principalSubject": "user:pool/b@d.com"},
            response={"name": "p/engines/e2/agents/2", "displayName": "Two"},
        ),
        creation(authenticationInfo={}, resourceName="projects/p/agents/3"),
        creation(),
        creation(authenticationInfo={"principalSubject": ""}, resourceName="a/engines/x/engines/e4"),
        creation(resourceName=""),
    ]
    df = extract_creators(read(spark, tmp_path, entries, schemas.CREATION_ENTRY))
    assert rows(df, "creator_email", "agent_id", "engine_id", "display_name") == sorted(
        [
            ("a@d.com", "1", "e1", "One"),
            ("b@d.com", "2", "e2", "Two"),
            # a path without engines yields its first segment
            ("unknown_email", "3", "projects", "Unknown Name"),
            ("unknown_email", "unknown_id", "default_engine", "Unknown Name"),
            ("unknown_email", "e4", "e4", "Unknown Name"),
            ("unknown_email", "null", "default_engine", "Unknown Name"),
        ],
        key=repr,
    )
    assert df.first()["timestamp"].microsecond == 123456


AUDIT = {
    "timestamp": "2024-01-01T00:00:00Z",
    "logName": "l",
    "insertId": "1",
    "severity": "INFO",
    "protoPayload": {
        "@type": "t",
        "serviceName": "s",
        "authenticationInfo": {"principalEmail": "e", "@x": 1},
        "authorizationInfo": [{"permission": "p", "@y": {"z": 1}}],
        "request": {"@type": "r", "agent_info": {"agent": "7"}},
        "response": {"big": "x"},
        "status": {"code": 5, "details": [{"@type": "d"}]},
        "extra": {"kept": {"deep": [{"@a": 1, "b": [{"@c": 2, "d": 3}]}]}},
    },
}


def test_audit_with_declared_schema(spark, tmp_path):
    df = reshape_audit(read(spark, tmp_path, [AUDIT], schemas.AUDIT_ENTRY))
    payload = json.loads(df.first()["protopayload_auditlog"])
    request = json.loads(payload.pop("requestJson"))
    assert request == {"@type": "r", "agent_info": {"agent": "7"}}
    assert payload == {
        "serviceName": "s",
        "authenticationInfo": {"principalEmail": "e"},
        "authorizationInfo": [{"permission": "p"}],
        "status": {"code": 5},
    }


def test_audit_with_inferred_schema_keeps_every_other_field(spark, tmp_path):
    bare = {"timestamp": "2024-01-01T00:00:00Z", "logName": "l", "insertId": "2", "severity": "INFO",
            "protoPayload": {"serviceName": "bare"}}
    df = reshape_audit(read(spark, tmp_path, [AUDIT, bare], None)).orderBy("insertId")
    first, second = (json.loads(r["protopayload_auditlog"]) for r in df.collect())
    assert first["extra"] == {"kept": {"deep": [{"b": [{"d": 3}]}]}}
    assert first["status"] == {"code": 5}
    assert "response" not in first and "@type" not in first
    # the request is text before the keys are removed
    assert json.loads(first["requestJson"])["@type"] == "r"
    assert second == {"serviceName": "bare"}


def test_activity_projection(spark, tmp_path):
    def entry(**payload):
        return {"timestamp": "2024-01-01T00:00:00Z", "insertId": "1", "jsonPayload": payload}

    entries = [
        entry(
            userIamPrincipal="u",
            request={"agentsSpec": {"agentSpecs": [{"agentId": "1", "more": 2}, {"agentId": "3"}]}, "query": "q"},
            response={"agentInfo": {"agent": "1", "displayName": "One", "spiffeId": "s"}, "text": "t"},
        ),
        entry(request={"agentsSpec": {}}),
        entry(userIamPrincipal="v", request={"query": "q"}, response={"text": "t"}),
    ]
    df = project_activity(read(spark, tmp_path, entries, schemas.ACTIVITY_ENTRY))
    got = sorted((r["jsonPayload"] for r in df.collect()), key=len)
    assert [json.loads(text) for text in got] == [
        {"userIamPrincipal": "v"},
        {"request": {"agentsSpec": {"agentSpecs": []}}},
        {
            "userIamPrincipal": "u",
            "request": {"agentsSpec": {"agentSpecs": [{"agentId": "1"}, {"agentId": "3"}]}},
            "response": {"agentInfo": {"agent": "1", "displayName": "One"}},
        },
    ]
