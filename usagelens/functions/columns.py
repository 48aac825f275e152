"""Column expressions shared by the operators and the plans."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from usagelens import constants as C


def last_segment(path: Column) -> Column:
    """Text after the last ``/`` of a resource path."""
    return F.substring_index(path, "/", -1)


def engine_of(path: Column) -> Column:
    """Engine id inside a resource path, NULL when the path names none."""
    return F.nullif(F.regexp_extract(path, "engines/([^/]+)", 1), F.lit(""))


def sql_in(values: tuple[str, ...]) -> str:
    """A tuple of plain names as an SQL list."""
    return "(" + ", ".join(f"'{value}'" for value in values) + ")"


def non_empty(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def is_system_agent(agent_id: Column) -> Column:
    """NULL stays NULL."""
    return agent_id.isin(*C.SYSTEM_AGENTS)


def is_placeholder_name(name: Column) -> Column:
    return name.isNull() | name.isin(*C.PLACEHOLDER_NAMES)


def share(count: str, total: str) -> str:
    """SQL for a percentage with two decimals, NULL for an empty total."""
    return f"round({count} * 100.0D / nullif({total}, 0), 2)"


def adoption_bar(percent: str, cells: int = 20) -> str:
    """SQL for ``[████░░] 80.0%`` with ``cells`` cells."""
    filled = f"CAST(round({percent} * {cells} / 100.0D) AS INT)"
    return f"concat('[', repeat('█', {filled}), repeat('░', {cells} - {filled}), '] ', {percent}, '%')"


def period_start(day: str, grain: str) -> str:
    """SQL for the first day of the day, ISO week or month that holds ``day``."""
    if grain == "day":
        return day
    if grain not in ("week", "month"):
        raise ValueError(f"grain must be day, week or month, not {grain!r}")
    return f"trunc({day}, '{grain}')"


def in_last_days(day: Column, as_of: str, days: int) -> Column:
    """``day`` is one of the ``days`` days that end with ``as_of``."""
    end = F.lit(as_of).cast("date")
    return (day > F.date_sub(end, days)) & (day <= end)
