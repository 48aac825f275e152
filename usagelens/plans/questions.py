"""The catalogue of questions, as parameterised queries.

Every question about "now" takes an explicit ``as_of`` date. Period filters go onto the events,
where they reach the landing partitions, and users are always recounted per period.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.columns import adoption_bar, in_last_days, non_empty, share
from usagelens.operators.adoption import FEATURES, adoption_by_period, user_flags
from usagelens.operators.directory import with_standard_type


def _recent(events: DataFrame, as_of: str, days: int) -> DataFrame:
    return events.filter(in_last_days(F.col("activity_date"), as_of, days))


def dau_trend(events: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Daily active users over the last ``days`` days."""
    return (
        _recent(events, as_of, days)
        .groupBy(F.col("activity_date").alias("time_period"))
        .agg(F.count_distinct("user_email").alias("total_active_users"))
        .orderBy("time_period")
    )


def adoption(events: DataFrame, grain: str = "day") -> DataFrame:
    """Adoption per day, week or month, newest period first."""
    return adoption_by_period(events, grain).orderBy(F.desc("time_period"))


def power_users(events: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """How many users used both agents and notebooks in the period."""
    flags = user_flags(_recent(events, as_of, days))
    counted = flags.agg(
        F.count("*").alias("active_users"),
        F.count_if(F.col("used_agents") & F.col("used_notebooklm")).alias("power_users"),
    )
    return counted.selectExpr("*", f"{share('power_users', 'active_users')} AS power_pct")


def users_of(events: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """Users who ever used each of the features, with active days per feature.

    ``features`` are names out of ``chat``, ``agent`` and ``notebooklm``.
    """
    daily = user_flags(events, "activity_date")
    totals = daily.groupBy("user_email").agg(
        F.count("*").alias("active_days"),
        *[
            F.count_if(F.col(flag)).alias(f"{name}_days")
            for name, (flag, *more) in FEATURES.items()
            if not more
        ],
    )
    for name in features:
        totals = totals.filter(F.col(f"{name}_days") > 0)
    return totals


def exclusive_segments(events: DataFrame) -> DataFrame:
    """Users by the exact set of features they ever used, e.g. chat only."""
    used = F.array_compact(
        F.array(
            F.when(F.col("used_chat"), "chat"),
            F.when(F.col("used_notebooklm"), "notebooks"),
            F.when(F.col("used_agents"), "agents"),
        )
    )
    label = F.when(F.size(used) == 0, "none").when(
        F.size(used) == 1, F.concat(F.array_join(used, "+"), F.lit(" only"))
    )
    return (
        user_flags(events)
        .select(F.coalesce(label, F.array_join(used, "+")).alias("segment"))
        .groupBy("segment")
        .agg(F.count("*").alias("users"))
        .orderBy(F.desc("users"), "segment")
    )


def creator_agents(attribution: DataFrame) -> DataFrame:
    """Creators and the agents they built, one row per creator and agent."""
    return attribution.groupBy("creator_email", "agent_id", "display_name").agg(
        F.min("creation_time").alias("first_created")
    )


def top_creators(attribution: DataFrame, k: int = 5) -> DataFrame:
    """Creators with the most distinct agents."""
    return (
        attribution.groupBy("creator_email")
        .agg(
            F.count_distinct("agent_id").alias("agents_created"),
            F.count("*").alias("creations"),
            F.max("creation_time").alias("last_created"),
        )
        .orderBy(F.desc("agents_created"), F.desc("creations"), "creator_email")
        .limit(k)
    )


def agents_by_architecture(directory: DataFrame) -> DataFrame:
    """Agents per type, with the two labels of the visual designer counted as one."""
    return (
        with_standard_type(directory)
        .groupBy("agent_type_norm")
        .agg(F.count("*").alias("agents"))
        .orderBy(F.desc("agents"), "agent_type_norm")
    )


def agent_profile(attribution: DataFrame, name: str) -> DataFrame:
    """Creator, time and instructions of the agents with this name; no data-store columns."""
    return attribution.filter(F.col("display_name") == name)


def recent_agents(attribution: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Agents created in the last ``days`` days; a range of instants, which Parquet can skip by."""
    last = F.lit(as_of).cast("date")
    created = F.col("creation_time")
    return attribution.filter(
        (created >= F.date_sub(last, days - 1).cast("timestamp")) & (created < F.date_add(last, 1).cast("timestamp"))
    )


def top_agents(leaderboard: DataFrame, k: int = 5) -> DataFrame:
    """Agents with the most sessions."""
    return leaderboard.orderBy(
        F.desc("total_sessions"), F.desc("monthly_users"), "agent_id", "engine_id"
    ).limit(k)


def idle_agents(directory: DataFrame, turns: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Directory agents without a turn in the last ``days`` days.

    Turns are reduced to the active ids before the anti-join.
    """
    active = (
        turns.filter(in_last_days(F.col("interaction_date"), as_of, days)).select("agent_id").distinct()
    )
    return (
        directory.join(active, "agent_id", "left_anti")
        .select(
            "agent_id",
            F.coalesce(non_empty(F.col("display_name")), F.col("agent_id")).alias("display_name"),
            "agent_type",
        )
    )


def distinct_agents_on(events: DataFrame, day: str) -> DataFrame:
    """Distinct custom agents used on one day."""
    return events.filter(F.col("activity_date") == F.lit(day).cast("date")).agg(
        F.count_distinct("agent_id").alias("distinct_agents_used")
    )


def engine_sessions(leaderboard: DataFrame) -> DataFrame:
    """Agents and sessions per engine."""
    return (
        leaderboard.groupBy("engine_id")
        .agg(
            F.count_distinct("agent_id").alias("agents"),
            F.sum("total_sessions").alias("total_sessions"),
            F.min("first_active_date").alias("first_active_date"),
            F.max("last_active_date").alias("last_active_date"),
        )
        .orderBy(F.desc("total_sessions"), "engine_id")
    )


def busiest_engine(engine_adoption: DataFrame) -> DataFrame:
    """The engine with the most active users."""
    return engine_adoption.orderBy(F.desc("total_active_users"), "engine_id").limit(1)


def user_agent_history(events: DataFrame, directory: DataFrame, user_email: str | None = None) -> DataFrame:
    """Which agents each user (or one user) used, on how many days, with names."""
    used = events.filter(F.col("agent_id").isNotNull())
    if user_email is not None:
        used = used.filter(F.col("user_email") == user_email)
    history = used.groupBy("user_email", "agent_id").agg(
        F.count_distinct("activity_date").alias("active_days"),
        F.min("activity_date").alias("first_used"),
        F.max("activity_date").alias("last_used"),
    )
    names = directory.select(
        F.col("agent_id").alias("known_id"), non_empty(F.col("display_name")).alias("known_name")
    )
    return (
        history.join(names, F.col("agent_id") == F.col("known_id"), "left")
        .select(
            "user_email",
            "agent_id",
            F.coalesce("known_name", "agent_id").alias("display_name"),
            "active_days",
            "first_used",
            "last_used",
        )
    )


def adoption_bars(summary: DataFrame) -> DataFrame:
    """Adoption shares as text bars."""
    features = ("chat", "notebooklm", "agent")
    return summary.selectExpr(
        "time_period", *[f"{adoption_bar(f'{name}_pct')} AS {name}_bar" for name in features]
    )
