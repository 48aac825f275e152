"""Events kept by user: same answers, no shuffle."""

from tests.conftest import rows
from tests.test_rollup import some_events
from usagelens.operators.adoption import user_ledger
from usagelens.plans import bucketed, questions


def exchanges(df) -> int:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange")


def test_questions_about_users_need_no_exchange(spark, tmp_path):
    events = some_events(spark, 11)
    for table, kept in (
        ("kept_by_user", bucketed.store(events, str(tmp_path / "kept"), "kept_by_user", 4)),
        ("kept_again", bucketed.register(spark, str(tmp_path / "kept"), "kept_again", 4)),
    ):
        assert rows(user_ledger(kept)) == rows(user_ledger(events))
        assert rows(questions.users_of(kept, ("chat",))) == rows(questions.users_of(events, ("chat",)))
        assert exchanges(user_ledger(kept)) == 0 and exchanges(questions.users_of(kept, ("chat",))) == 0
        assert exchanges(user_ledger(events)) > 0
        spark.sql(f"DROP TABLE {table}")


def test_a_second_store_replaces_the_first(spark, tmp_path):
    path = str(tmp_path / "kept")
    bucketed.store(some_events(spark, 1), path, "kept_twice", 4)
    kept = bucketed.store(some_events(spark, 2), path, "kept_twice", 4)
    assert kept.agg({"events": "sum"}).first()[0] == 400
    hot = some_events(spark, 3).selectExpr("'hot' AS user_email", "activity_date", "is_chat", "is_agent", "is_nblm", "agent_id")
    assert rows(user_ledger(bucketed.store(hot, path, "kept_twice", 4))) == rows(user_ledger(hot))
    spark.sql("DROP TABLE kept_twice")
