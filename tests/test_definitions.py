import json

import pytest

from tests.conftest import rows
from usagelens import schemas
from usagelens.operators.definitions import (
    attach_datastores,
    flatten_definitions,
    flatten_definitions_light,
    list_agents,
)

ROOT = {"id": "root_agent", "displayName": "Root", "llmAgentNode": {"instruction": "Lead"}}
HELPER = {"id": "h", "displayName": "Helper", "llmAgentNode": {"instruction": "Help"}}
SILENT = {"id": "s"}


def documents(spark, tmp_path, *docs, schema=schemas.AGENT_DEFINITION):
    path = tmp_path / f"docs{len(list(tmp_path.iterdir()))}.json"
    path.write_text("\n".join(json.dumps(d) for d in docs))
    return spark.read.schema(schema).json(str(path))


FULL = {
    "code": ({"adkAgentDefinition": {}, "lowCodeAgentDefinition": {"nodes": [ROOT]}}, ("ADK Agent", "", "")),
    "root and sub-agents": (
        {"lowCodeAgentDefinition": {"nodes": [HELPER, ROOT, SILENT]}},
        ("Agent Builder (UI)", "Lead\n\n\nSub-Agent Instructions:\n[Helper] Help", "Helper, Sub-Agent"),
    ),
    "later root in front": (
        {"lowCodeAgentDefinition": {"nodes": [ROOT, ROOT | {"llmAgentNode": {"instruction": "Last"}}]}},
        ("Agent Builder (UI)", "Last\n\nLead\n\n", ""),
    ),
    "own root id": (
        {"lowCodeAgentDefinition": {"nodes": [HELPER], "rootAgentId": "h"}},
        ("Agent Builder (UI)", "Help\n\n", ""),
    ),
    "empty list is present": (
        {
            "lowCodeAgentDefinition": {"deployedNodes": [], "nodes": [ROOT]},
            "instructions": {"systemInstructions": [{"instruction": "A"}, {}, {"instruction": "B"}]},
        },
        ("Agent Builder (UI)", "A\nB", ""),
    ),
    "managed": ({"managedAgentDefinition": {}}, ("Managed Agent", "", "")),
    "unknown": ({}, ("Unknown", "", "")),
}


@pytest.mark.parametrize("case", FULL)
def test_types_instructions_and_sub_agents(spark, tmp_path, case):
    document, expected = FULL[case]
    df = flatten_definitions(documents(spark, tmp_path, {"name": "p/agents/1"} | document))
    assert rows(df, "agent_type", "system_instructions", "sub_agents") == [expected]


def test_names_fall_back_from_detail_to_list(spark, tmp_path):
    listed = documents(
        spark,
        tmp_path,
        {"name": "a/1", "displayName": "List one"},
        {"name": "a/2", "draftDisplayName": "List two"},
        {"name": "a/3"},
        {"name": ""},
        {"displayName": "nameless"},
        schema=schemas.AGENT_LISTING,
    )
    details = documents(
        spark,
        tmp_path,
        {"name": "a/1", "draftDisplayName": "Draft one", "draftDescription": "d"},
        {"name": "a/2", "description": "text", "managedAgentDefinition": {}},
    )
    df = flatten_definitions(listed, details)
    assert df.columns == [f.name for f in schemas.parsed(schemas.AGENT_DIRECTORY).fields]
    assert rows(df, "agent_id", "display_name", "description", "agent_type", "engine_id") == [
        ("1", "Draft one", "d", "Unknown", "default_engine"),
        ("2", "List two", "text", "Managed Agent", "default_engine"),
        ("3", "Unknown", "", "Unknown", "default_engine"),
    ]


def test_light_rows(spark, tmp_path):
    df = flatten_definitions_light(
        documents(
            spark,
            tmp_path,
            {"name": "a/default_assistant"},
            {"name": ""},
            {"name": "a/1", "lowCodeAgentDefinition": {"nodes": [], "deployedNodes": [HELPER, ROOT]}},
            {"name": "a/2", "lowCodeAgentDefinition": {"nodes": [ROOT], "deployedNodes": [HELPER]}},
            {"name": "a/3", "adkAgentDefinition": {}, "displayName": "Three", "description": "d"},
            {"name": "a/4", "managedAgentDefinition": {}},
        )
    )
    assert rows(df) == [
        ("1", "", "Agent Designer", "", "Help"),
        ("2", "", "Agent Designer", "", "Lead"),
        ("3", "Three", "ADK Agent", "d", ""),
        ("4", "", "Managed Agent", "", ""),
    ]


def test_datastores_keep_order_and_unknown_ids(spark):
    engines = spark.createDataFrame(
        [("p/e1", ["b", "a", "x"]), ("p/e2", []), ("p/e3", None)], schemas.ENGINE
    )
    stores = spark.createDataFrame([("a", "Store A"), ("b", "Store B"), ("c", "Unused")], schemas.DATA_STORE)
    assert rows(attach_datastores(engines, stores)) == [
        ("p/e1", "b,a,x", "Store B,Store A,x"),
        ("p/e2", "", ""),
        ("p/e3", "", ""),
    ]


def test_agents_are_listed_below_known_engines(spark):
    engines = spark.createDataFrame([("p/engines/e1", []), (None, [])], schemas.ENGINE)
    assistants = spark.createDataFrame(
        [("p/engines/e1/assistants/d",), ("p/engines/gone/assistants/d",), ("",)], schemas.ASSISTANT
    )
    agents = spark.createDataFrame(
        [
            ("p/engines/e1/assistants/d/agents/1", "One", None),
            ("p/engines/gone/assistants/d/agents/2", "Two", None),
            ("", None, None),
        ],
        schemas.AGENT_LISTING,
    )
    df = list_agents(engines, assistants, agents)
    assert rows(df, "name", "engine_id") == [("p/engines/e1/assistants/d/agents/1", "e1")]
