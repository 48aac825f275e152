"""User ledger and adoption counts over normalised events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions.columns import period_start, share

# fixed values: output names and the flags each of them counts
FEATURES = {
    "chat": ("used_chat",),
    "notebooklm": ("used_notebooklm",),
    "agent": ("used_agents",),
    "chat_and_notebooklm": ("used_chat", "used_notebooklm"),
    "chat_and_agents": ("used_chat", "used_agents"),
    "notebooklm_and_agents": ("used_notebooklm", "used_agents"),
    "all_three": ("used_chat", "used_notebooklm", "used_agents"),
}


_FLAGS = {"used_chat": "is_chat", "used_agents": "is_agent", "used_notebooklm": "is_nblm"}


def _flags() -> list[Column]:
    return [F.expr(f"bool_or({event}) AS {flag}") for flag, event in _FLAGS.items()]


def user_ledger(events: DataFrame) -> DataFrame:
    """One row per user and day: three flags and the sorted custom agents used.

    Events are first folded to (user, day, agent), which runs as a plain hash aggregate with
    map-side combining; a user-day that holds most of the log has shrunk to its distinct agents
    before the arrays are built.
    """
    folded = events.groupBy("user_email", "activity_date", "agent_id").agg(*_flags())
    return folded.groupBy("user_email", "activity_date").agg(
        *[F.expr(f"bool_or({flag}) AS {flag}") for flag in _FLAGS],
        F.expr("array_sort(collect_list(agent_id)) AS agent_ids_used"),
    )


def ledger_events(ledger: DataFrame) -> DataFrame:
    """A stored ledger as events again, one per agent used (at least one per row)."""
    return ledger.selectExpr(
        "user_email",
        "activity_date",
        *[f"{flag} AS {event}" for flag, event in _FLAGS.items()],
        # the flags of a row without agents must survive as well
        "explode_outer(agent_ids_used) AS agent_id",
    )


def user_flags(events: DataFrame, *by: str) -> DataFrame:
    """Flags per user (and per extra column), without the agents."""
    return events.groupBy("user_email", *by).agg(*_flags())


def feature_counts() -> list[Column]:
    """User counts per feature and overlap, over rows of which each user has one."""
    return [
        F.expr(f"count_if(user_email IS NOT NULL AND {' AND '.join(flags)}) AS {name}_users")
        for name, flags in FEATURES.items()
    ]


def with_shares(counts: DataFrame, period: str, distinct_agents: bool = True) -> DataFrame:
    """Period, total, then count and percentage per feature in the published order."""
    columns = [period, "total_active_users"]
    for name in FEATURES:
        columns += [f"{name}_users", f"{share(f'{name}_users', 'total_active_users')} AS {name}_pct"]
        if name == "agent" and distinct_agents:
            columns.append("distinct_agents_used")
    return counts.selectExpr(*columns)


def adoption_by_period(events: DataFrame, grain: str = "day") -> DataFrame:
    """Adoption per day, week or month in one pass over the events.

    Two distinct counts are needed per period, of users and of agents. Grouping sets give both from
    one scan and one shuffle: rows per (period, user) and rows per (period, agent), combined
    map-side, so the final aggregation by period receives at most one row per period and task. No
    self-join, no second scan, and users are recounted per period instead of summing days.
    """
    periods = events.selectExpr(
        f"{period_start('activity_date', grain)} AS time_period",
        "user_email",
        "agent_id",
        *_FLAGS.values(),
    )
    folded = periods.groupingSets(
        [["time_period", "user_email"], ["time_period", "agent_id"]],
        "time_period",
        "user_email",
        "agent_id",
    ).agg(*_flags())
    counts = folded.groupBy("time_period").agg(
        F.expr("count(user_email) AS total_active_users"),
        *feature_counts(),
        F.expr("count(agent_id) AS distinct_agents_used"),
    )
    return with_shares(counts, "time_period")


def adoption_from_ledger(ledger: DataFrame, grain: str = "day") -> DataFrame:
    """The same answer from a stored ledger (one row per user and day)."""
    return adoption_by_period(ledger_events(ledger), grain)
