"""Upsert truth tables."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from tests.conftest import rows
from usagelens import schemas
from usagelens.operators.directory import (
    harvest_names,
    one_row_per_agent,
    reconcile_names,
    unresolved_names,
    upsert_definitions,
    with_standard_type,
)
from usagelens.operators.quality import duplicate_agents, view_recipe_difference

COLUMNS = ("agent_id", "display_name", "engine_id", "description", "system_instructions", "agent_type")


def directory(spark, *agents):
    """Agents as (id, name); the other columns are marked as old."""
    data = [(i, n, f"e{i}", "old", "old", "ds", "ds", "Old", "sub") for i, n in agents]
    return spark.createDataFrame(data, schemas.AGENT_DIRECTORY)


def names(spark, *pairs):
    return spark.createDataFrame(
        [(i, n, "Agent Designer", dt.datetime(2024, 1, day)) for i, n, day in pairs],
        "agent_id string, display_name string, agent_type string, last_logged timestamp",
    )


def updates(spark, *agents):
    return spark.createDataFrame(agents, schemas.DIRECTORY_UPDATE)


def test_definitions_overwrite_insert_and_keep(spark):
    table = directory(spark, ("1", "One"), ("2", "Two"), (None, "No id"))
    merged = upsert_definitions(
        table, updates(spark, ("1", "", "ADK Agent", "", "new"), ("3", "Three", "ADK Agent", "d", "i"))
    )
    assert merged.columns == table.columns
    assert rows(merged, *COLUMNS) == sorted(
        [
            ("1", "", "e1", "", "new", "ADK Agent"),
            ("2", "Two", "e2", "old", "old", "Old"),
            ("3", "Three", None, "d", "i", "ADK Agent"),
            (None, "No id", "eNone", "old", "old", "Old"),
        ],
        key=repr,
    )
    kept = merged.filter("agent_id = '1'").first()
    assert (kept["datastore_ids"], kept["sub_agents"]) == ("ds", "sub")


@pytest.mark.parametrize("placeholder", [None, "", "My Agent", "Unknown Name"])
def test_names_fill_placeholders(spark, placeholder):
    table = directory(spark, ("1", placeholder))
    merged = reconcile_names(table, names(spark, ("1", "HR", 1)))
    assert rows(merged, *COLUMNS) == [("1", "HR", "e1", "old", "old", "Agent Designer")]
    assert rows(reconcile_names(merged, names(spark, ("1", "Other", 2)))) == rows(merged)


def test_names_leave_named_agents_and_add_unknown_ones(spark):
    table = directory(spark, ("1", "One"), ("2", "Two"))
    offered = names(spark, ("1", "HR", 1), ("3", "Three", 1))
    merged = reconcile_names(table, offered)
    assert rows(merged, *COLUMNS) == [
        ("1", "One", "e1", "old", "old", "Old"),
        ("2", "Two", "e2", "old", "old", "Old"),
        ("3", "Three", None, None, None, "Agent Designer"),
    ]
    assert rows(unresolved_names(table, offered), "agent_id") == [("3",)]
    assert unresolved_names(merged, offered).isEmpty()


def test_repeated_target_rows_are_all_updated(spark):
    table = directory(spark, ("1", None), ("1", None), ("1", "One"))
    merged = reconcile_names(table, names(spark, ("1", "HR", 1)))
    assert rows(merged, "display_name") == [("HR",), ("HR",), ("One",)]


def test_latest_name_wins_whatever_the_order(spark):
    offered = names(spark, ("1", "Zed", 1), ("1", "Abe", 3), ("1", "Mid", 2))
    merged = reconcile_names(directory(spark, ("1", "")), offered)
    assert rows(merged, "display_name") == [("Abe",)]


def test_conflicts_can_be_errors(spark):
    same = updates(spark, ("1", "A", "t", "d", "i"), ("1", "A", "t", "d", "i"))
    assert one_row_per_agent(same, "error").count() == 1
    different = updates(spark, ("1", "A", "t", "d", "i"), ("1", "B", "t", "d", "i"))
    with pytest.raises(PySparkException, match="several update rows for agent 1"):
        one_row_per_agent(different, "error").collect()
    with pytest.raises(ValueError, match="on_conflict"):
        one_row_per_agent(different, "sometimes")


def test_harvest_is_distinct_and_skips_system_agents(spark):
    def payload(agent, name):
        info = f'"response":{{"agentInfo":{{"displayName":"{name}"}}}}' if name else '"x":1'
        spec = f'"request":{{"agentsSpec":{{"agentSpecs":[{{"agentId":"{agent}"}}]}}}}' if agent else '"y":1'
        return f"{{{info},{spec}}}"

    cases = [("1", "A"), ("1", "A"), ("1", "B"), ("2", None), (None, "C"), ("default_assistant", "D")]
    data = [(dt.datetime(2024, 1, i + 1), payload(*case)) for i, case in enumerate(cases)]
    log = spark.createDataFrame(data, "timestamp timestamp, jsonPayload string")
    assert rows(harvest_names(log)) == [
        ("1", "A", "Agent Designer", dt.datetime(2024, 1, 2)),
        ("1", "B", "Agent Designer", dt.datetime(2024, 1, 3)),
    ]


def test_one_label_for_the_visual_designer(spark):
    table = spark.createDataFrame([("Agent Designer",), ("ADK Agent",), (None,)], "agent_type string")
    assert rows(with_standard_type(table), "agent_type_norm") == [
        ("ADK Agent",),
        ("Agent Builder (UI)",),
        (None,),
    ]


def test_duplicates_are_reported(spark):
    table = directory(spark, ("1", "a"), ("1", "b"), ("2", "c"))
    assert rows(duplicate_agents(table)) == [("1", 2)]


def test_difference_covers_days_of_either_side(spark):
    names_ = ["total_active_users", "chat_users", "notebooklm_users", "agent_users"]
    schema = ", ".join(f"{n} bigint" for n in names_)
    day1, day2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    summary = spark.createDataFrame([(day1, 5, 4, 3, 2)], f"time_period date, {schema}")
    recipe = spark.createDataFrame([(day1, 1, 1, 1, 1), (day2, 1, 1, 0, 0)], f"activity_date date, {schema}")
    assert rows(view_recipe_difference(summary, recipe)) == [
        (day1, 4, 3, 2, 1),
        (day2, -1, -1, 0, 0),
    ]
