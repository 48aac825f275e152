"""The two scheduled jobs and the typed-turn refresh."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens import constants as C
from usagelens import schemas
from usagelens.functions.columns import engine_of
from usagelens.operators.definitions import (
    attach_datastores,
    flatten_definitions,
    flatten_definitions_light,
    list_agents,
)
from usagelens.operators.directory import harvest_names, upsert_definitions
from usagelens.operators.reshape import extract_creators, project_activity, reshape_audit
from usagelens.operators.turns import assistant_turns, audit_turns, normalize_events, notebook_turns
from usagelens.plans.rollup import landed_parts, rows_in
from usagelens.session import materialized
from usagelens.sources import logs, variants
from usagelens.sources.tables import Warehouse, load_with_bad_budget


@dataclass(frozen=True)
class Landing:
    """Folders of landed exports, all JSON lines."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def full_directory(spark: SparkSession, landing: Landing) -> DataFrame:
    """Directory rows from the landed engine, assistant, agent and data-store documents."""

    def read(name, schema):
        return logs.read_json(spark, landing.path(name), schema)

    engines = read("engines", schemas.ENGINE)
    listed = list_agents(engines, read("assistants", schemas.ASSISTANT), read("agents", schemas.AGENT_LISTING))
    stores = attach_datastores(engines, read("data_stores", schemas.DATA_STORE))
    return flatten_definitions(
        listed.join(stores, "engine_name", "left"), read("agent_details", schemas.AGENT_DEFINITION)
    )


def reconcile_directory(warehouse: Warehouse, load_id: str, turns: DataFrame | None = None) -> int:
    """Harvest the names of loads that have not been harvested; returns the number of agents offered.

    ``turns`` are the rows to read instead, e.g. typed ones. Names lie beside the directory and are
    resolved when it is read. A load is remembered by a row without agent that carries its id. Loads are
    known from folder names, and only the folders of new ones are read.
    """
    seen = warehouse.parts("agent_names_seen")
    if turns is None:
        done = seen.selectExpr("load_id").union(seen.filter("agent_id IS NULL").selectExpr("display_name AS load_id"))
        landed = landed_parts(warehouse, "assistant_activity").select("load_id").distinct()
        loads = materialized(landed.join(done.distinct(), "load_id", "left_anti"), "loads")
        fresh = rows_in(warehouse.parts("assistant_activity"), "load_id", loads)
        marks = loads.selectExpr(
            "CAST(NULL AS STRING) AS agent_id", "load_id AS display_name", "CAST(NULL AS STRING) AS agent_type",
            "CAST(NULL AS TIMESTAMP) AS last_logged",
        )
        names = harvest_names(fresh.drop("load_id")).unionByName(marks)
    else:
        names = harvest_names(turns)
    names = materialized(names, "names")
    warehouse.append(names, "agent_names_seen", load_id)
    return warehouse.parts("agent_names_seen").select("agent_id").filter("agent_id IS NOT NULL").distinct().count()


def append_metrics(
    spark: SparkSession, landing: Landing, warehouse: Warehouse, engine_spec: str, load_id: str
) -> int:
    """Exported session metrics of the selected engines into the metrics table."""
    exported = logs.read_session_metrics(spark, landing.path("session_metrics"))
    rows = logs.filter_engines(exported, engine_spec, engine_of(F.col("agent_name")))
    warehouse.append(rows, "agent_session_metrics", load_id)
    return warehouse.count_load("agent_session_metrics", load_id)


def backfill(
    spark: SparkSession,
    landing: Landing,
    warehouse: Warehouse,
    as_of: str,
    engine_spec: str = "ALL",
    lookback_days: int = C.LOOKBACK_DAYS,
    max_bad: int = C.BAD_RECORD_BUDGET,
    max_bad_share: float = 0.0,
    load_id: str = "backfill",
    gather: bool = True,
    as_variants: bool = False,
) -> None:
    """First load: definitions, creators, a year of activity, names, metrics.

    Stages run in order and stop at the first failure; each may be repeated. ``gather=False`` skips
    the shuffle by day for exports that are in time order. ``as_variants`` lands the logs with variant
    payloads (``variants.read``) in place of text, without a pass that infers their fields.
    """
    warehouse.ensure_tables()
    warehouse.replace_if_any(full_directory(spark, landing), "agent_directory")

    creations = logs.read_creation_log(
        spark, landing.path("creation_log"), as_of, lookback_days=lookback_days
    )
    warehouse.replace_if_any(extract_creators(creations), "agent_creators")

    path = landing.path("audit_log")
    schema = variants.AUDIT_VARIANTS if as_variants else logs.audit_schema(spark, path)
    audit, torn = load_with_bad_budget(spark, path, schema, max_bad, max_bad_share)
    warehouse.reject(torn, "audit_log", load_id)
    audit = logs.select_audit_log(audit, as_of, lookback_days)
    audit = variants.reshape_audit(audit) if as_variants else reshape_audit(audit)

    path = landing.path("activity_log")
    schema = variants.ACTIVITY_VARIANTS if as_variants else schemas.ACTIVITY_ENTRY
    activity, torn = load_with_bad_budget(spark, path, schema, max_bad, max_bad_share)
    warehouse.reject(torn, "activity_log", load_id)
    activity = logs.select_activity_log(activity, as_of, lookback_days)
    if as_variants:
        warehouse.ensure_tables("log_variants")
        for table, rows in (("audit_access", audit), ("assistant_activity", activity)):
            variants.append(warehouse, rows, table, load_id)
        audit, activity = variants.read(warehouse, "audit_access"), variants.read(warehouse, "assistant_activity")
    else:
        activity = project_activity(activity)
        warehouse.append(audit, "audit_access", load_id, gather)
        warehouse.append(activity, "assistant_activity", load_id, gather)

    # what has just been landed, parsed once more into the columns that views read
    events = normalize_events(audit, activity, activity.limit(0))
    warehouse.append(events.withColumnRenamed("activity_date", "event_date"), "usage_events", load_id, gather)
    warehouse.append(harvest_names(activity), "agent_names_seen", load_id)
    append_metrics(spark, landing, warehouse, engine_spec, load_id)


def nightly(
    spark: SparkSession,
    landing: Landing,
    warehouse: Warehouse,
    load_id: str,
    engine_spec: str = "ALL",
    turns: DataFrame | None = None,
) -> DataFrame:
    """Definitions, then logged names, then metrics; one row of counts.

    ``load_id`` names the night, so that a repeated run does not add its metrics twice. Agents
    outside ``engine_spec`` are left alone, in the definitions and in the metrics. ``turns`` replaces
    the loads that have not been harvested as the source of names, see ``reconcile_directory``.
    """
    warehouse.ensure_tables()
    documents = logs.read_json(spark, landing.path("agent_details"), schemas.AGENT_DEFINITION)
    selected = logs.filter_engines(documents, engine_spec, engine_of(F.col("name")))
    updates = materialized(flatten_definitions_light(selected), "definitions")
    synced = updates.count()
    if synced:
        warehouse.update("agent_directory", lambda current: upsert_definitions(current, updates))
    reconciled = reconcile_directory(warehouse, f"{load_id}-names", turns)
    metric_rows = append_metrics(spark, landing, warehouse, engine_spec, load_id)
    counts = {"agents_synced": synced, "names_reconciled": reconciled, "metric_rows": metric_rows}
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()])


def refresh_turns(warehouse: Warehouse, root: str, days: list | None = None) -> dict[str, DataFrame]:
    """Parse the log tables once into typed Parquet (all days, or only ``days``).

    Views and recipes accept the result in place of the raw tables and then read a few narrow
    columns instead of parsing payloads.
    """
    parsers = {
        "audit_access": audit_turns,
        "assistant_activity": assistant_turns,
        "notebook_activity": notebook_turns,
    }
    typed = {}
    for table, parse in parsers.items():
        raw = warehouse.read(table) if days is None else warehouse.read_days(table, days)
        path = f"{root.rstrip('/')}/{table}"
        parsed = parse(raw)
        writer = parsed.hint("rebalance", "event_date").write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)
        typed[table] = warehouse.spark.read.schema(parsed.schema).parquet(path)
    return typed
