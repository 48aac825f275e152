"""The recipes that answer from the base tables, and the example queries on the views."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.columns import non_empty
from usagelens.operators.adoption import feature_counts, user_flags, with_shares
from usagelens.operators.turns import agent_turns, engine_turns


def base_adoption(base_events: DataFrame, rows: int | None = None) -> DataFrame:
    """Daily adoption from the activity logs, newest first; only the newest ``rows`` days if given."""
    counts = (
        user_flags(base_events, "activity_date")
        .groupBy("activity_date")
        .agg(F.count("user_email").alias("total_active_users"), *feature_counts())
    )
    ordered = with_shares(counts, "activity_date", distinct_agents=False).orderBy(F.desc("activity_date"))
    return ordered if rows is None else ordered.limit(rows)


def user_engagement(base_events: DataFrame) -> DataFrame:
    """Active days and interactions per user, folded per day first so that a hot user is split."""
    daily = base_events.groupBy("user_email", "activity_date").agg(
        F.count_if("is_chat").alias("chat"),
        F.count_if("is_nblm").alias("notebook"),
        F.count_if("is_agent").alias("agent"),
    )
    return (
        daily.groupBy("user_email")
        .agg(
            F.count("*").alias("total_active_days"),
            F.sum("chat").alias("chat_interaction_count"),
            F.sum("notebook").alias("notebooklm_interaction_count"),
            F.sum("agent").alias("custom_agent_interaction_count"),
            F.min("activity_date").alias("first_seen_date"),
            F.max("activity_date").alias("last_seen_date"),
        )
        .orderBy(F.desc("total_active_days"), "user_email")
    )


def agent_popularity(assistant: DataFrame, directory: DataFrame) -> DataFrame:
    """Turns and users per agent, folded to agents before the directory is joined.

    A repeated directory row doubles the turns (as a row-level join would) but not the users, who
    are distinct per agent.
    """
    folded = (
        agent_turns(assistant)
        .groupBy("agent_id")
        .agg(
            F.count("*").alias("turns"),
            F.count_distinct("user_email").alias("users"),
            F.min("interaction_date").alias("first_date"),
            F.max("interaction_date").alias("last_date"),
        )
    )
    names = directory.select(
        F.col("agent_id").alias("known_id"), non_empty(F.col("display_name")).alias("known_name"), "agent_type"
    )
    return (
        folded.join(names, F.col("agent_id") == F.col("known_id"), "left")
        .withColumn("display_name", F.coalesce("known_name", "agent_id"))
        .groupBy("display_name", "agent_id", "agent_type")
        .agg(
            F.sum("turns").alias("total_turns"),
            F.max("users").alias("unique_active_users"),
            F.min("first_date").alias("first_active_date"),
            F.max("last_date").alias("last_active_date"),
        )
        .orderBy(F.desc("total_turns"), "agent_id", "display_name", "agent_type")
    )


def engine_adoption(assistant: DataFrame) -> DataFrame:
    """Users and turns per engine."""
    return (
        engine_turns(assistant)
        .groupBy("engine_id")
        .agg(
            F.count_distinct("user_email").alias("total_active_users"),
            F.count("*").alias("total_turns"),
            F.min("activity_date").alias("first_active_date"),
            F.max("activity_date").alias("last_active_date"),
        )
        .orderBy(F.desc("total_active_users"), "engine_id")
    )


def latest_adoption(summary: DataFrame, rows: int | None = None) -> DataFrame:
    """The summary view in the columns reports show, newest first; only ``rows`` periods if given."""
    ordered = (
        summary.select(
            "time_period",
            "total_active_users",
            "chat_users",
            "chat_pct",
            "notebooklm_users",
            "notebooklm_pct",
            "agent_users",
            "agent_pct",
            "distinct_agents_used",
            "chat_and_notebooklm_pct",
            "chat_and_agents_pct",
            "notebooklm_and_agents_pct",
            "all_three_pct",
        )
        .orderBy(F.desc("time_period"))
    )
    return ordered if rows is None else ordered.limit(rows)


def user_active_days(ledger: DataFrame) -> DataFrame:
    """Active days per user and feature; the ledger has one row per user and day."""
    return (
        ledger.groupBy("user_email")
        .agg(
            F.count("activity_date").alias("total_active_days"),
            F.count_if("used_chat").alias("chat_active_days"),
            F.count_if("used_notebooklm").alias("notebooklm_active_days"),
            F.count_if("used_agents").alias("agent_active_days"),
        )
        .orderBy(F.desc("total_active_days"), "user_email")
    )


def leaderboard_by_name(leaderboard: DataFrame) -> DataFrame:
    """Sessions and monthly users per display name."""
    return leaderboard.groupBy("display_name").agg(
        F.sum("total_sessions").alias("total_sessions"), F.max("monthly_users").alias("monthly_users")
    ).orderBy(F.desc("total_sessions"), "display_name")
