"""Upkeep of the agent directory: harvested names and conditional upserts.

File tables have no MERGE, so each upsert is a new version of the table: the target left-joined
with the (unique) source, plus the source rows the target lacks. Compared with a full outer join,
the target's wide rows are not shuffled when the source is small enough for Spark's own broadcast
limit, and a key that fills a large part of the target (NULL ids, duplicates) stays splittable by
the adaptive skew join, which does not apply to full outer joins.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens import constants as C
from usagelens.functions.columns import is_placeholder_name, is_system_agent
from usagelens.operators.turns import assistant_turns


def harvest_names(assistant: DataFrame) -> DataFrame:
    """Distinct (agent_id, display_name, agent_type) seen in the assistant log, with the last time."""
    turns = assistant_turns(assistant, ("requested_agent", "agent_label"))
    named = turns.filter(F.col("agent_label").isNotNull() & ~is_system_agent(F.col("requested_agent")))
    return (
        named.groupBy(
            F.col("requested_agent").alias("agent_id"), F.col("agent_label").alias("display_name")
        )
        .agg(F.max("timestamp").alias("last_logged"))
        .select("agent_id", "display_name", F.lit(C.TYPE_DESIGNER).alias("agent_type"), "last_logged")
    )


def one_row_per_agent(updates: DataFrame, on_conflict: str = "latest", order: str | None = None) -> DataFrame:
    """Make ``agent_id`` unique in an upsert source.

    ``latest`` keeps the row that is greatest by (``order``, other columns); ``error`` makes the
    query fail when an agent has two different rows. Exact repeats are one row in both cases.
    """
    values = [c for c in updates.columns if c not in ("agent_id", order)]
    rank = F.struct(*([order] if order else []), *values)
    grouped = updates.groupBy("agent_id")
    if on_conflict == "latest":
        best = grouped.agg(F.max(rank).alias("best"))
    elif on_conflict == "error":
        # minimum and maximum differ exactly when there are two different rows
        pair = F.struct(*values)
        best = grouped.agg(F.max(rank).alias("best"), F.min(pair).alias("lo"), F.max(pair).alias("hi"))
        clash = F.raise_error(F.concat(F.lit("several update rows for agent "), F.col("agent_id")))
        best = best.withColumn(
            "best", F.when(F.col("lo").eqNullSafe(F.col("hi")), F.col("best")).otherwise(clash)
        )
    else:
        raise ValueError(f"on_conflict must be latest or error, not {on_conflict!r}")
    return best.select("agent_id", *[F.col(f"best.{name}").alias(name) for name in values])


def _upsert(
    target: DataFrame, source: DataFrame, columns: Sequence[str], when_matched: Column | None = None
) -> DataFrame:
    """New table version; ``source`` has one row per agent_id, ``when_matched`` sees the target row."""
    # Spark splits a skewed join only between two plain shuffles; the rebalance keeps the grouping
    # that made the source unique from standing in for one of them.
    incoming = source.hint("rebalance").select(
        F.col("agent_id").alias("new_id"), *[F.col(c).alias(f"new_{c}") for c in columns]
    )
    applies = F.col("new_id").isNotNull()
    if when_matched is not None:
        applies = applies & when_matched
    updated = target.join(incoming, F.col("agent_id") == F.col("new_id"), "left").select(
        *[
            F.when(applies, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )
    inserted = source.select("agent_id", *columns).join(
        target.select("agent_id"), "agent_id", "left_anti"
    )
    return updated.unionByName(inserted, allowMissingColumns=True).select(*target.columns)


def upsert_definitions(directory: DataFrame, updates: DataFrame, on_conflict: str = "latest") -> DataFrame:
    """Definitions win unconditionally over the four descriptive columns; new agents are added."""
    columns = ["display_name", "agent_type", "description", "system_instructions"]
    source = one_row_per_agent(updates.select("agent_id", *columns), on_conflict)
    return _upsert(directory, source, columns)


def reconcile_names(directory: DataFrame, harvested: DataFrame, on_conflict: str = "latest") -> DataFrame:
    """Logged names fill in for placeholders only; unknown agents are added."""
    order = "last_logged" if "last_logged" in harvested.columns else None
    source = one_row_per_agent(harvested, on_conflict, order)
    return _upsert(
        directory, source, ["display_name", "agent_type"], is_placeholder_name(F.col("display_name"))
    )


def unresolved_names(directory: DataFrame, harvested: DataFrame) -> DataFrame:
    """Harvested agents that ``reconcile_names`` would add or rename."""
    unnamed = directory.filter(is_placeholder_name(F.col("display_name"))).select("agent_id")
    added = harvested.join(directory.select("agent_id"), "agent_id", "left_anti")
    return added.unionByName(harvested.join(unnamed, "agent_id", "left_semi"))


def with_standard_type(directory: DataFrame, labels: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``agent_type_norm``: one label for agents built in the visual designer."""
    labels = {C.TYPE_DESIGNER: C.TYPE_BUILDER} if labels is None else labels
    norm = F.col("agent_type")
    for old, new in labels.items():
        norm = F.when(F.col("agent_type") == old, F.lit(new)).otherwise(norm)
    return directory.withColumn("agent_type_norm", norm)
