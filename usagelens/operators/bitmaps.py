"""Exact distinct counts from stored bitmaps of user and agent numbers.

A day is kept as one bitmap per kind and bucket of 32,768 numbers. Weeks, months and rolling windows are ORs of
days, so events are never read again; counts of overlaps follow from counts of unions. Numbers start at one.
"""

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.columns import period_start
from usagelens.operators.adoption import FEATURES, with_shares

USER, AGENT = "user", "agent_id"
# kind of bitmap per flag
_KINDS = {"used_chat": "chat", "used_agents": "agent", "used_notebooklm": "notebooklm"}


def day_members(events: DataFrame) -> DataFrame:
    """(activity_date, space, value, kinds): each user and each agent of a day once, from one scan."""
    folded = events.groupingSets(
        [["activity_date", "user_email"], ["activity_date", "agent_id"]], "activity_date", "user_email", "agent_id"
    ).agg(F.bool_or("is_chat").alias("used_chat"), F.bool_or("is_agent").alias("used_agents"), F.bool_or("is_nblm").alias("used_notebooklm"))
    used = ", ".join(f"IF({flag}, '{kind}', NULL)" for flag, kind in _KINDS.items())
    return folded.selectExpr(
        "activity_date",
        f"IF(user_email IS NOT NULL, '{USER}', '{AGENT}') AS space",
        "coalesce(user_email, agent_id) AS value",
        f"IF(user_email IS NOT NULL, array_compact(array('{USER}', {used})), array('{AGENT}')) AS kinds",
    ).filter("value IS NOT NULL")


def day_bitmaps(members: DataFrame, numbers: DataFrame) -> DataFrame:
    """(activity_date, kind, bucket, bitmap) of ``day_members``, with ``numbers`` (space, value, number)."""
    rows = members.join(numbers, ["space", "value"]).selectExpr("activity_date", "number", "explode(kinds) AS kind")
    return rows.groupBy("activity_date", "kind", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
    )


def _union(kinds) -> str:
    return "n_" + "_".join(sorted(kinds))


def _unions() -> list[tuple[str, ...]]:
    flags = sorted(_KINDS.values())
    return [(USER,), (AGENT,), *(kinds for size in (1, 2, 3) for kinds in combinations(flags, size))]


def union_counts(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Members of each kind, and of at least one of several features, per ``by``.

    Bitmaps are combined map-side; a group receives at most one of 4 kB per task, bucket and union.
    """
    merged = bitmaps.groupBy(*by, "bucket").agg(
        *[
            F.expr(f"bitmap_or_agg(bitmap) FILTER (WHERE kind IN ({', '.join(repr(k) for k in kinds)})) AS {_union(kinds)}")
            for kinds in _unions()
        ]
    )
    return merged.groupBy(*by).agg(*[F.sum(F.bitmap_count(_union(kinds))).alias(_union(kinds)) for kinds in _unions()])


def _overlap(flags: tuple[str, ...]) -> str:
    """SQL for the number of users of all features, by inclusion and exclusion over unions."""
    kinds = [_KINDS[flag] for flag in flags]
    terms = [("+" if size % 2 else "-") + _union(some) for size in range(1, len(kinds) + 1) for some in combinations(kinds, size)]
    return " ".join(terms)


def feature_users(counts: DataFrame, *by: str) -> DataFrame:
    """The adoption counts out of ``union_counts``."""
    return counts.selectExpr(
        *by,
        f"{_union((USER,))} AS total_active_users",
        *[f"{_overlap(flags)} AS {name}_users" for name, flags in FEATURES.items()],
        f"{_union((AGENT,))} AS distinct_agents_used",
    )


def adoption_from_bitmaps(bitmaps: DataFrame, grain: str = "day") -> DataFrame:
    """Adoption per day, week or month; the same rows as ``adoption_by_period`` gives from events."""
    periods = bitmaps.selectExpr(f"{period_start('activity_date', grain)} AS time_period", "kind", "bucket", "bitmap")
    return with_shares(feature_users(union_counts(periods, "time_period"), "time_period"), "time_period")


def rolling_adoption(bitmaps: DataFrame, days: int) -> DataFrame:
    """Adoption over the ``days`` days that end with each day that has bitmaps.

    A day's parts are merged first; then its bitmap enters the windows of the following days.
    """
    merged = bitmaps.groupBy("activity_date", "kind", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    ends = bitmaps.select(F.col("activity_date").alias("time_period")).distinct()
    spread = merged.selectExpr(
        f"explode(sequence(activity_date, date_add(activity_date, {int(days) - 1}))) AS time_period", "kind", "bucket", "bitmap"
    )
    windows = spread.join(ends, "time_period", "left_semi")
    return with_shares(feature_users(union_counts(windows, "time_period"), "time_period"), "time_period")


def period_users(bitmaps: DataFrame) -> DataFrame:
    """One row of feature counts over all given days; filter the days before."""
    return feature_users(union_counts(bitmaps))

