"""Bitmaps, the registry of landed parts, views stored by day and SQL table functions."""

import datetime as dt
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from usagelens import schemas
from usagelens.operators.adoption import adoption_by_period, user_ledger
from usagelens.operators.bitmaps import adoption_from_bitmaps, period_users, rolling_adoption
from usagelens.plans import jobs, rollup, views
from usagelens.sources.tables import ConcurrentReplace, Warehouse

EVENTS = "user_email string, activity_date date, is_chat boolean, is_agent boolean, is_nblm boolean, agent_id string"
DAY = dt.date(2024, 1, 1)


def some_events(spark, seed: int, n: int = 400, users: int = 40, days: int = 45):
    draw = random.Random(seed)
    flag = lambda: draw.choice([True, False, None])
    data = [
        (f"u{draw.randrange(users)}", DAY + dt.timedelta(days=draw.randrange(days)), flag(), flag(), flag(), draw.choice([None, None, "a1", "a2", f"a{seed}"]))
        for _ in range(n)
    ]
    return spark.createDataFrame(data, EVENTS)


def files(warehouse: Warehouse, table: str) -> set[str]:
    return {os.path.join(d, f) for d, _, names in os.walk(warehouse.path(table)) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("grain", ["day", "week", "month"])
def test_bitmaps_over_loads_equal_events(spark, warehouse, grain):
    loads = [some_events(spark, seed) for seed in range(3)]
    for i, events in enumerate(loads):
        rollup.store_bitmaps(warehouse, events, f"load-{i}")
    everything = loads[0].union(loads[1]).union(loads[2])
    stored = warehouse.read("usage_bitmaps")
    assert rows(adoption_from_bitmaps(stored, grain)) == rows(adoption_by_period(everything, grain))
    read = adoption_from_bitmaps(stored, grain).inputFiles()
    assert read and all("/usage_bitmaps/" in path for path in read)


def test_rolling_windows_and_periods(spark, warehouse):
    events = some_events(spark, 7)
    rollup.store_bitmaps(warehouse, events, "only")
    users, both = defaultdict(set), defaultdict(lambda: [set(), set()])
    data = events.collect()
    ends = {e.activity_date for e in data}
    for e in data:
        for end in ends:
            if end - dt.timedelta(days=6) <= e.activity_date <= end:
                users[end].add(e.user_email)
                if e.is_chat:
                    both[end][0].add(e.user_email)
                if e.is_nblm:
                    both[end][1].add(e.user_email)
    got = {r.time_period: r for r in rolling_adoption(warehouse.read("usage_bitmaps"), 7).collect()}
    assert {d: r.total_active_users for d, r in got.items()} == {d: len(u) for d, u in users.items()}
    assert {d: r.chat_and_notebooklm_users for d, r in got.items()} == {d: len(both[d][0] & both[d][1]) for d in ends}
    assert period_users(warehouse.read("usage_bitmaps")).first().total_active_users == len({e.user_email for e in data})


def test_late_rows_and_repeated_loads_touch_their_own_parts(spark, warehouse):
    events = some_events(spark, 1)
    rollup.store_bitmaps(warehouse, events, "first")
    before, numbers = files(warehouse, "usage_bitmaps"), rows(warehouse.read("entity_numbers"))
    late = spark.createDataFrame([("newcomer", DAY, True, None, None, None), ("u1", DAY, None, None, True, "a9")], EVENTS)
    rollup.store_bitmaps(warehouse, late, "late")
    added = files(warehouse, "usage_bitmaps") - before
    assert before <= files(warehouse, "usage_bitmaps") and added and all("activity_date=2024-01-01/load_id=late" in path for path in added)
    assert set(numbers) < set(rows(warehouse.read("entity_numbers")))
    both = rows(adoption_by_period(events.union(late), "month"))
    assert rows(adoption_from_bitmaps(warehouse.read("usage_bitmaps"), "month")) == both
    numbers = rows(warehouse.read("entity_numbers"))
    for load, part in (("first", events), ("late", late)):
        rollup.store_bitmaps(warehouse, part, load)
    assert rows(warehouse.read("entity_numbers")) == numbers
    assert rows(adoption_from_bitmaps(warehouse.read("usage_bitmaps"), "month")) == both
    assert sorted(r.number for r in warehouse.read("entity_numbers").collect()) == list(range(1, len(numbers) + 1))


def test_more_users_than_a_bucket_holds(spark, warehouse):
    made = spark.range(70_000).repartition(5).selectExpr(
        "concat('user', id) AS user_email", "date_add(DATE '2024-01-01', CAST(id % 3 AS INT)) AS activity_date",
        "id % 2 = 0 AS is_chat", "id % 5 = 0 AS is_agent", "id % 7 = 0 AS is_nblm", "CAST(NULL AS STRING) AS agent_id",
    )
    rollup.store_bitmaps(warehouse, made, "many")
    assert warehouse.read("usage_bitmaps").select("bucket").distinct().count() == 3
    assert rows(adoption_from_bitmaps(warehouse.read("usage_bitmaps"), "week")) == rows(adoption_by_period(made, "week"))


def test_numbers_taken_by_another_writer(spark, warehouse, monkeypatch):
    values = spark.createDataFrame([("user", "a"), ("user", "b")], "space string, value string")
    rollup.add_numbers(warehouse, values)
    stale = warehouse.parts("entity_numbers").filter("number IS NULL")
    monkeypatch.setattr(Warehouse, "parts", lambda self, table: stale)
    with pytest.raises(ConcurrentReplace):
        rollup.add_numbers(warehouse, values.limit(1), attempts=2)


# ---- landed parts and stored views ------------------------------------------------------
def append(warehouse, events, load_id):
    warehouse.append(events.withColumnRenamed("activity_date", "event_date"), "usage_events", load_id)


def test_parts_come_from_folder_names(spark, warehouse):
    append(warehouse, some_events(spark, 1, days=2), "one")
    for path in files(warehouse, "usage_events"):
        os.truncate(path, 0)  # an opened file would be an error
    landed = rollup.landed_parts(warehouse, "usage_events").filter("load_id <> 'seed'")
    assert rows(landed) == [(DAY, "one"), (DAY + dt.timedelta(days=1), "one")]
    assert spark.conf.get("spark.sql.optimizer.metadataOnly") == "false"


def test_stored_views_follow_touched_days(spark, warehouse):
    first = some_events(spark, 1)
    append(warehouse, first, "one")
    assert rollup.refresh_daily(warehouse, "r1").count() == first.select("activity_date").distinct().count()
    before = files(warehouse, "daily_adoption")
    late = spark.createDataFrame([("late", DAY, True, None, None, "a7"), ("timeless", None, None, True, None, None)], EVENTS)
    append(warehouse, late, "two")
    assert rows(rollup.refresh_daily(warehouse, "r2")) == sorted([(DAY,), (None,)], key=repr)
    rewritten = files(warehouse, "daily_adoption") ^ before
    assert {path.split("activity_date=")[1].split("/")[0] for path in rewritten} == {"2024-01-01", "__HIVE_DEFAULT_PARTITION__"}
    whole = first.union(late)
    columns = adoption_by_period(whole).columns
    assert rows(warehouse.read("daily_adoption").withColumnRenamed("activity_date", "time_period"), *columns) == rows(adoption_by_period(whole))
    ledger = user_ledger(whole)
    assert rows(warehouse.read("daily_ledger"), *ledger.columns) == rows(ledger)
    # nothing is new: nothing is read or written
    kept = files(warehouse, "daily_adoption")
    assert rollup.refresh_daily(warehouse, "r3").isEmpty() and files(warehouse, "daily_adoption") == kept


def test_refresh_that_stopped_before_its_mark_is_repeated(spark, warehouse, monkeypatch):
    append(warehouse, some_events(spark, 3), "one")
    with monkeypatch.context() as patch:
        patch.setattr(rollup, "mark_parts", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            rollup.refresh_daily(warehouse, "r1")
    assert not rollup.refresh_daily(warehouse, "r1").isEmpty()
    assert warehouse.read("daily_adoption").agg(F.sum("total_active_users")).first()[0] == some_events(spark, 3).select(
        "user_email", "activity_date"
    ).distinct().count()


def test_few_names_become_literals_and_many_are_joined(spark, warehouse, monkeypatch):
    append(warehouse, some_events(spark, 1, days=5), "one")
    append(warehouse, spark.createDataFrame([("x", None, True, None, None, None)], EVENTS), "two")
    parts = warehouse.parts("usage_events")
    wanted = spark.createDataFrame([(DAY,), (None,), (DAY,), (DAY + dt.timedelta(days=3),)], "event_date date")
    few = rollup.rows_in(parts, "event_date", wanted)
    assert "PartitionFilters: [(event_date" in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(rollup, "LITERALS", 1)
    many = rollup.rows_in(parts, "event_date", wanted)
    assert rows(few) == rows(many) and "x" in {r.user_email for r in few.collect()}
    assert rows(rollup.rows_in(parts, "event_date", wanted.limit(0))) == []


def test_second_night_reads_its_own_loads(spark, warehouse, monkeypatch):
    columns = "timestamp timestamp, logName string, insertId string, severity string, jsonPayload string"

    def log(number, agent, name):
        payload = f'{{"request":{{"agentsSpec":{{"agentSpecs":[{{"agentId":"{agent}"}}]}}}},"response":{{"agentInfo":{{"displayName":"{name}"}}}}}}'
        return spark.createDataFrame([(dt.datetime(2024, 1, number, 12), "l", str(number), "INFO", payload)], columns)

    warehouse.append(log(1, "a", "First"), "assistant_activity", "load-1")
    jobs.reconcile_directory(warehouse, "night-1")
    warehouse.append(log(2, "b", "Second"), "assistant_activity", "load-2")
    first = next(p for p in files(warehouse, "assistant_activity") if "load_id=load-1" in p)
    os.truncate(first, 0)  # reading it again would fail
    jobs.reconcile_directory(warehouse, "night-2")
    assert rows(warehouse.read("agent_directory"), "agent_id", "display_name") == [("a", "First"), ("b", "Second")]
    assert set(schemas.DERIVED_TABLES) <= set(schemas.APPEND_TABLES)


# ---- SQL table functions ----------------------------------------------------------------
def test_questions_in_sql_prune_days(spark, warehouse):
    views.register_live(warehouse)
    views.register_questions(warehouse)
    append(warehouse, some_events(spark, 5), "one")
    text = "SELECT * FROM usage_dau_trend(DATE '2024-01-10', 3)"
    plan = spark.sql(text)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-07" in plan and "jsonPayload" not in plan
    data = some_events(spark, 5).collect()
    days = [dt.date(2024, 1, d) for d in (8, 9, 10)]
    expected = {d: len({e.user_email for e in data if e.activity_date == d}) for d in days}
    assert {r.time_period: r.total_active_users for r in spark.sql(text).collect()} == {d: n for d, n in expected.items() if n}
    used = {e.user_email for e in data if e.is_chat}
    assert {r.user_email for r in spark.sql("SELECT * FROM usage_feature_users('chat')").collect()} == used
    assert spark.sql("SELECT * FROM usage_feature_users('nothing')").isEmpty()
    assert spark.sql("SELECT * FROM usage_power_users(DATE '2030-01-01')").first().active_users == 0
    assert spark.sql("SELECT * FROM usage_top_agents(3)").isEmpty()
    # functions follow what lands later
    append(warehouse, spark.createDataFrame([("later", DAY, True, None, None, "z")], EVENTS), "two")
    agents = {e.agent_id for e in data if e.activity_date == DAY and e.agent_id} | {"z"}
    assert spark.sql("SELECT * FROM usage_agents_on(DATE '2024-01-01')").first()[0] == len(agents)
