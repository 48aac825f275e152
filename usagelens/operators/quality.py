"""Checks for known weak spots of the data."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_agents(directory: DataFrame) -> DataFrame:
    """Agent ids that occur more than once; each would multiply the joined metrics."""
    return (
        directory.groupBy("agent_id").agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)
    )


def view_recipe_difference(summary: DataFrame, recipe: DataFrame) -> DataFrame:
    """Per day, what the summary view reports beyond the base-table recipe (and the reverse)."""
    names = ["total_active_users", "chat_users", "notebooklm_users", "agent_users"]
    left = summary.select(F.col("time_period").alias("activity_date"), *[F.col(n).alias(f"v_{n}") for n in names])
    right = recipe.select("activity_date", *[F.col(n).alias(f"r_{n}") for n in names])
    joined = left.join(right, "activity_date", "full")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "activity_date",
        *[
            (F.coalesce(f"v_{n}", zero) - F.coalesce(f"r_{n}", zero)).alias(f"{n}_diff")
            for n in names
        ],
    )
