"""Views, recipes and questions against brute force, and the shape of their plans."""

import datetime as dt
import re
from collections import Counter, defaultdict

import pytest

from tests.conftest import rows
from usagelens import catalogue, schemas
from usagelens.operators.adoption import FEATURES, adoption_by_period, user_ledger
from usagelens.operators.dedup import without_repeats
from usagelens.operators.turns import normalize_events
from usagelens.plans import questions, recipes, views
from usagelens.sources.sample_logs import SampleLogs

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sample(spark):
    return SampleLogs(spark, TINY)


@pytest.fixture(scope="module")
def events(spark, sample):
    df = normalize_events(sample.audit_access, sample.assistant_activity, sample.notebook_activity)
    return spark.createDataFrame([tuple(r) for r in df.collect()], df.schema)


def plan(df) -> str:
    df.collect()  # the adaptive plan is final after execution
    return df._jdf.queryExecution().executedPlan().toString()


def adaptive(text: str) -> str:
    """The executed part of an adaptive plan."""
    return text.split("== Initial Plan ==")[0]


# ---- brute force ---------------------------------------------------------------
@pytest.mark.parametrize("grain", ["day", "week", "month"])
def test_adoption_recounts_users_per_period(events, grain):
    start = {
        "day": lambda d: d,
        "week": lambda d: d - dt.timedelta(days=d.weekday()),
        "month": lambda d: d.replace(day=1),
    }[grain]
    users = defaultdict(lambda: [False, False, False])
    agents = defaultdict(set)
    for e in events.collect():
        period = start(e.activity_date)
        flags = users[period, e.user_email]
        for i, flag in enumerate((e.is_chat, e.is_agent, e.is_nblm)):
            flags[i] |= bool(flag)
        if e.agent_id is not None:
            agents[period].add(e.agent_id)
    expected = defaultdict(Counter)
    names = ("used_chat", "used_agents", "used_notebooklm")
    for (period, _), flags in users.items():
        expected[period]["total_active_users"] += 1
        on = {name for name, flag in zip(names, flags) if flag}
        for feature, needed in FEATURES.items():
            expected[period][f"{feature}_users"] += set(needed) <= on
    got = adoption_by_period(events, grain).collect()
    assert len(got) == len(expected)
    for row in got:
        counts = expected[row.time_period]
        assert all(row[name] == counts[name] for name in counts)
        assert row.distinct_agents_used == len(agents[row.time_period])


def test_shares_nest(events):
    for row in adoption_by_period(events).collect():
        assert all(0 <= row[f"{name}_pct"] <= 100 for name in FEATURES)
        pair = min(
            row.chat_and_notebooklm_users, row.chat_and_agents_users, row.notebooklm_and_agents_users
        )
        assert row.all_three_users <= pair
        assert row.chat_and_agents_users <= min(row.chat_users, row.agent_users)
        assert max(row.chat_users, row.agent_users, row.notebooklm_users) <= row.total_active_users


def test_summary_counts_the_ledger(events):
    per_day = Counter(r.activity_date for r in user_ledger(events).collect())
    got = {r.time_period: r.total_active_users for r in views.adoption_summary(events).collect()}
    assert got == dict(per_day)


def test_unknown_grain(events):
    with pytest.raises(ValueError, match="grain"):
        adoption_by_period(events, "year")


def metrics(spark, *data):
    return spark.createDataFrame(
        [(dt.date(2024, 1, d), name, n, m) for d, name, n, m in data], schemas.SESSION_METRICS
    )


def test_leaderboard_resolves_names_and_fans_out_over_repeats(spark):
    directory = spark.createDataFrame(
        [("1", "One", ""), ("1", "Uno", None), ("2", "", "e9"), ("3", None, None)],
        "agent_id string, display_name string, engine_id string",
    )
    table = metrics(
        spark,
        (1, "p/engines/e1/agents/1", 5, 2),
        (2, "p/engines/e1/agents/1", 6, 1),
        (3, "agents/2", 7, 3),
        (4, "p/engines/e3/agents/3", 1, 1),
        (5, "agents/3", 2, 4),
        (6, "agents/4", 1, 1),
    )
    d = dt.date
    assert rows(views.agent_leaderboard(table, directory)) == [
        ("1", "One", "e1", 11, 2, d(2024, 1, 1), d(2024, 1, 2)),
        ("1", "Uno", "e1", 11, 2, d(2024, 1, 1), d(2024, 1, 2)),
        ("2", "2", "e9", 7, 3, d(2024, 1, 3), d(2024, 1, 3)),
        ("3", "3", "default_engine", 2, 4, d(2024, 1, 5), d(2024, 1, 5)),
        ("3", "3", "e3", 1, 1, d(2024, 1, 4), d(2024, 1, 4)),
        ("4", "4", "default_engine", 1, 1, d(2024, 1, 6), d(2024, 1, 6)),
    ]


def test_empty_and_missing_names_are_one_group(spark):
    # grouping by the source column would keep '' and NULL apart
    directory = spark.createDataFrame(
        [("1", "", "e"), ("1", None, "e")], "agent_id string, display_name string, engine_id string"
    )
    got = views.agent_leaderboard(metrics(spark, (1, "agents/1", 5, 2)), directory)
    assert rows(got, "display_name", "total_sessions") == [("1", 10)]


def test_popularity_equals_joining_first(spark, sample):
    directory = sample.agent_directory.unionByName(sample.agent_directory.filter("crc32(agent_id) % 2 = 0"))
    got = recipes.agent_popularity(sample.assistant_activity, directory)
    from usagelens.operators.turns import agent_turns

    agent_turns(sample.assistant_activity).createOrReplaceTempView("pop_turns")
    directory.createOrReplaceTempView("pop_directory")
    joined = spark.sql(
        """
        SELECT display_name, agent_id, agent_type, count(*), count(DISTINCT user_email),
               min(interaction_date), max(interaction_date)
        FROM (SELECT t.*, coalesce(nullif(d.display_name, ''), t.agent_id) AS display_name, d.agent_type
              FROM pop_turns t LEFT JOIN pop_directory d ON t.agent_id = d.agent_id)
        GROUP BY display_name, agent_id, agent_type
        """
    )
    assert rows(got) == rows(joined)


def test_engagement_equals_direct_counts(spark, sample):
    from usagelens.operators.turns import normalize_base_events

    base = normalize_base_events(sample.assistant_activity, sample.notebook_activity)
    days, counts = defaultdict(set), defaultdict(Counter)
    for e in base.collect():
        days[e.user_email].add(e.activity_date)
        counts[e.user_email].update({k for k in ("is_chat", "is_nblm", "is_agent") if e[k]})
    expected = sorted(
        (u, len(d), counts[u]["is_chat"], counts[u]["is_nblm"], counts[u]["is_agent"], min(d), max(d))
        for u, d in days.items()
    )
    assert rows(recipes.user_engagement(base)) == sorted(expected, key=repr)


def test_segments_partition_the_users(events):
    got = {r.segment: r.users for r in questions.exclusive_segments(events).collect()}
    assert sum(got.values()) == events.select("user_email").distinct().count()
    assert set(got) <= {
        "none", "chat only", "notebooks only", "agents only", "chat+notebooks", "chat+agents",
        "notebooks+agents", "chat+notebooks+agents",
    }


def test_bars(spark):
    summary = spark.sql("SELECT 1 AS time_period, 80.0D AS chat_pct, 0.0D AS notebooklm_pct, 100.0D AS agent_pct")
    assert tuple(questions.adoption_bars(summary).first())[1:] == (
        "[████████████████░░░░] 80.0%",
        "[░░░░░░░░░░░░░░░░░░░░] 0.0%",
        "[████████████████████] 100.0%",
    )


def test_periods_end_with_as_of(events):
    trend = questions.dau_trend(events, "2024-01-10", 3)
    assert [r.time_period.day for r in trend.collect()] == [8, 9, 10]


def test_history_of_one_user(events, sample):
    user = events.filter("agent_id IS NOT NULL").first().user_email
    got = questions.user_agent_history(events, sample.agent_directory, user).collect()
    used = {(e.agent_id, e.activity_date) for e in events.collect() if e.user_email == user and e.agent_id}
    assert {r.user_email for r in got} == {user}
    assert {r.agent_id: r.active_days for r in got} == Counter(agent for agent, _ in used)


def test_profile_hides_data_stores(sample):
    attribution = views.creator_attribution(sample.agent_creators, sample.agent_directory)
    assert not [c for c in questions.agent_profile(attribution, "x").columns if "datastore" in c]


# ---- plans ------------------------------------------------------------------------
def test_adoption_scans_each_log_once_and_never_joins(sample):
    df = adoption_by_period(
        normalize_events(sample.audit_access, sample.assistant_activity, sample.notebook_activity)
    )
    text = adaptive(plan(df))
    assert text.count("FileScan parquet") == 3
    assert text.count("from_json") == 3
    assert "Join" not in text
    assert len(re.findall(r"\bExchange hashpartitioning", text)) == 2


def test_scans_read_only_needed_columns(sample):
    text = plan(recipes.engine_adoption(sample.assistant_activity))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in text
    assert "value" not in re.search(r"ReadSchema: (\S+)", text).group(1)


@pytest.mark.parametrize("name", ["v1_agent_leaderboard", "r3_agent_popularity"])
def test_facts_are_folded_before_the_directory_is_joined(spark, name):
    text = adaptive(plan(catalogue.queries()[name](spark, TINY)))
    join = text.index("Join")
    # plans print top-down: an aggregate below the join comes later in the text
    assert "HashAggregate" in text[join:]


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_no_query_multiplies_rows_or_runs_python(spark, name):
    # queries that load or stream first have run their writes when they return; the status store has those plans
    store = spark._jsparkSession.sharedState().statusStore()

    def newest(n):
        run = store.executionsList(max(0, int(store.executionsCount()) - n), n)
        return [run.apply(i) for i in range(run.size())]

    before = max((e.executionId() for e in newest(1)), default=-1)
    texts = [catalogue.queries()[name](spark, TINY)._jdf.queryExecution().executedPlan().toString()]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    texts += [e.physicalPlanDescription() for e in newest(200) if e.executionId() > before]
    assert len(texts) > 1 or not name.startswith(("w1", "w3", "w6", "m3", "j"))
    for text in texts:
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
            assert operator not in text


# ---- a third of everything under one key ----------------------------------------------
def test_hot_user_day_and_agent_stay_exact(spark):
    hot = spark.range(30000).selectExpr(
        "'hot@d.com' AS user_email", "DATE '2024-01-01' AS activity_date", "id % 3 = 0 AS is_chat",
        "false AS is_agent", "false AS is_nblm", "CAST(id % 7 AS STRING) AS agent_id",
    )
    rest = spark.range(60000).selectExpr(
        "concat('u', id % 5000) AS user_email", "date_add(DATE '2024-01-01', CAST(id % 3 AS INT)) AS activity_date",
        "false AS is_chat", "true AS is_agent", "id % 2 = 0 AS is_nblm", "'hot' AS agent_id",
    )
    got = {r.time_period.day: r for r in adoption_by_period(hot.unionByName(rest)).collect()}
    assert (got[1].total_active_users, got[1].distinct_agents_used, got[1].chat_users) == (5001, 8, 1)
    ledger = user_ledger(hot.unionByName(rest)).filter("user_email = 'hot@d.com'").first()
    assert ledger.agent_ids_used == [str(i) for i in range(7)]


def test_hot_copies_leave_one_row(spark):
    logs = spark.range(9000).selectExpr(
        "IF(id % 3 = 0, 'same', IF(id % 3 = 1, CAST(id AS STRING), NULL)) AS insertId",
        "'l' AS logName",
        "TIMESTAMP '2024-01-01' AS timestamp",
        "repeat('x', CAST(id % 5 AS INT)) AS jsonPayload",
    )
    got = without_repeats(logs, "jsonPayload")
    assert got.filter("insertId IS NULL").count() == 3000
    assert got.filter("insertId <> 'same'").count() == 3000
    assert rows(got.filter("insertId = 'same'"), "jsonPayload") == [("xxxx",)]
