"""Typed events kept by user, so that questions about users need no shuffle.

Events are folded to one row per user, day and agent, dealt into buckets by user and sorted. Grouping by user, or by user and
day, then finds its rows together; Spark plans it without an exchange. A user with most of the log has shrunk to the agents of
each day before rows meet in a bucket.

The table's files lie in a folder of the caller's; its entry in the session's catalog is only a description of them, made
again by ``register`` in a new session.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
_COLUMNS = "user_email STRING, activity_date DATE, agent_id STRING, is_chat BOOLEAN, is_agent BOOLEAN, is_nblm BOOLEAN, events BIGINT"


def folded_events(events: DataFrame) -> DataFrame:
    """One row per user, day and agent; flags as of normalised events, so every consumer of those accepts it."""
    return events.groupBy("user_email", "activity_date", "agent_id").agg(
        *[F.bool_or(flag).alias(flag) for flag in ("is_chat", "is_agent", "is_nblm")], F.count("*").alias("events")
    )


def store(events: DataFrame, path: str, table: str, buckets: int = BUCKETS) -> DataFrame:
    """Write the folded events to ``path`` and describe them as ``table``; an earlier content is replaced."""
    rows = folded_events(events).repartition(buckets, "user_email")
    writer = rows.write.bucketBy(buckets, "user_email").sortBy("user_email", "activity_date").mode("overwrite")
    writer.option("path", path).saveAsTable(table)
    return events.sparkSession.table(table)


def register(spark: SparkSession, path: str, table: str, buckets: int = BUCKETS) -> DataFrame:
    """Describe stored files again, e.g. in a new session."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({_COLUMNS}) USING parquet"
        f" CLUSTERED BY (user_email) SORTED BY (user_email, activity_date) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)
