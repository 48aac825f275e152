"""What is kept up to date behind the landed events: numbers, day bitmaps, stored views by touched day.

Two consumers of ``usage_events`` remember which landed parts (day and load) they have seen. Parts are listed from
folder names, so finding what is new opens no file; only the days of new parts are read and rewritten.
"""

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.operators.adoption import adoption_by_period, user_ledger
from usagelens.operators.bitmaps import day_bitmaps, day_members
from usagelens.session import materialized
from usagelens.sources.tables import ConcurrentReplace, Warehouse, has_condition

_METADATA_ONLY = "spark.sql.optimizer.metadataOnly"
LITERALS = 2_000  # up to as many folder names go into the plan as literals; more are joined


@contextmanager
def _folder_names(spark):
    before = spark.conf.get(_METADATA_ONLY)
    spark.conf.set(_METADATA_ONLY, "true")
    try:
        yield
    finally:
        spark.conf.set(_METADATA_ONLY, before)


def landed_parts(warehouse: Warehouse, table: str) -> DataFrame:
    """Distinct (event_date, load_id) of a table, from the names of its folders; no file is opened."""
    with _folder_names(warehouse.spark):
        return materialized(warehouse.parts(table).select("event_date", "load_id").distinct(), "parts")


def new_parts(warehouse: Warehouse, table: str, consumer: str) -> DataFrame:
    """The landed parts that ``consumer`` has not marked."""
    warehouse.ensure_tables("consumed_parts")
    seen = warehouse.parts("consumed_parts").filter((F.col("consumer") == consumer) & (F.col("table") == table))
    landed = landed_parts(warehouse, table).filter("load_id <> 'seed'")
    same = landed["event_date"].eqNullSafe(seen["event_date"]) & (landed["load_id"] == seen["part"])
    return materialized(landed.join(seen, same, "left_anti"), "new-parts")


def mark_parts(warehouse: Warehouse, parts: DataFrame, table: str, consumer: str, load_id: str) -> None:
    """Remember parts; to be called after their effect is stored, so that a crash only repeats work."""
    rows = parts.select(F.lit(table).alias("table"), "event_date", F.col("load_id").alias("part"), F.lit(consumer).alias("consumer"))
    warehouse.append(rows, "consumed_parts", load_id)


def rows_in(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows whose partition ``column`` is in the one-column table ``values``, null included; other folders are not read.

    Names become literals, which prune when the query is planned. Beyond ``LITERALS`` names they are joined.
    """
    few = [r[0] for r in values.distinct().limit(LITERALS + 1).collect()]
    if len(few) > LITERALS:
        other = values.distinct().withColumnRenamed(values.columns[0], "_wanted")
        named = df.join(other, F.col(column) == F.col("_wanted"), "left_semi")
        has_null = not values.filter(F.col(values.columns[0]).isNull()).isEmpty()
        return named.unionByName(df.filter(F.col(column).isNull())) if has_null else named
    named = F.col(column).isin([v for v in few if v is not None])
    return df.filter(named | F.col(column).isNull() if None in few else named)


# ---- numbers and bitmaps ----------------------------------------------------------------
def add_numbers(warehouse: Warehouse, values: DataFrame, attempts: int = 5) -> DataFrame:
    """Give dense numbers to the (space, value) that have none; returns all (space, value, number).

    Numbers never change once given, so stored bitmaps stay valid and a repeated load finds its own. New values are
    counted per task and shifted by the counts before; the tasks' counts are all that meets in one place. A part's
    folder is named by its first number: two writers cannot take the same one.
    """
    warehouse.ensure_tables("entity_numbers")
    for _ in range(attempts):
        known = warehouse.parts("entity_numbers")
        fresh = values.distinct().join(known.select("space", "value"), ["space", "value"], "left_anti")
        fresh = materialized(fresh.withColumn("spot", F.monotonically_increasing_id()), "fresh-values")
        task = F.shiftright("spot", 33)
        before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
        counts = fresh.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
        if counts.isEmpty():
            return known.select("space", "value", "number")
        shifts = counts.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
        last = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
        numbered = fresh.withColumn("task", task).join(shifts, "task").select(
            "space", "value", (F.col("spot").bitwiseAND((1 << 33) - 1) + F.col("shift") + last + 1).alias("number")
        )
        try:
            numbered.write.mode("errorifexists").parquet(f"{warehouse.path('entity_numbers')}/start={last + 1}")
            return warehouse.parts("entity_numbers").select("space", "value", "number")
        except AnalysisException as error:
            if not has_condition(error, "PATH_ALREADY_EXISTS"):
                raise
    raise ConcurrentReplace(f"numbers were taken by other writers in {attempts} attempts")


def store_bitmaps(warehouse: Warehouse, events: DataFrame, load_id: str) -> None:
    """The bitmaps of the days that ``events`` touch, as parts of the load; readers OR the parts of a day."""
    warehouse.ensure_tables("usage_bitmaps")
    members = materialized(day_members(events), "members")
    numbers = add_numbers(warehouse, members.select("space", "value"))
    warehouse.append(day_bitmaps(members, numbers), "usage_bitmaps", load_id)


# ---- stored views -----------------------------------------------------------------------
def refresh_daily(warehouse: Warehouse, load_id: str) -> DataFrame:
    """Recompute the stored ledger and adoption of the days that new loads have touched; returns those days."""
    warehouse.ensure_tables("daily_ledger", "daily_adoption")
    parts = new_parts(warehouse, "usage_events", "daily")
    days = parts.select("event_date").distinct()
    events = rows_in(warehouse.parts("usage_events"), "event_date", days)
    events = events.drop("load_id").withColumnRenamed("event_date", "activity_date")
    warehouse.overwrite_days(user_ledger(events), "daily_ledger")
    warehouse.overwrite_days(adoption_by_period(events).withColumnRenamed("time_period", "activity_date"), "daily_adoption")
    mark_parts(warehouse, parts, "usage_events", "daily", load_id)
    return days
