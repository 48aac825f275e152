"""Every operator as a named query over the given tables."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens import constants as C
from usagelens import schemas
from usagelens.functions.columns import engine_of, in_last_days, last_segment, share
from usagelens.functions.json_scalar import json_scalars
from usagelens.operators import definitions, directory, quality, reshape, turns
from usagelens.operators.adoption import adoption_by_period, adoption_from_ledger, user_flags, user_ledger
from usagelens.operators.bitmaps import adoption_from_bitmaps, period_users, rolling_adoption
from usagelens.operators.dedup import without_repeats
from usagelens.plans import bucketed, jobs, questions, recipes, rollup, views
from usagelens.session import configure, scratch_path
from usagelens.sources import logs, variants
from usagelens.sources.sample_logs import SampleLogs
from usagelens.sources.tables import Warehouse, load_with_bad_budget
from usagelens.streaming import landing

ACTIVITY_AS_OF = "2024-01-31"
ORDERS_AS_OF = "2001-08-02"
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
EXPORT_CODEC = "lz4"  # a fourteenth of the text and less, and no slower to write or read
EXPORT_RECORDS = 25_000  # a compressed file is read by one task

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(SampleLogs(configure(spark), sf_dir))

    _QUERIES[function.__name__] = run
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def _events(s):
    return turns.normalize_events(
        s.audit_access, s.assistant_activity, s.notebook_activity
    )


def _base_events(s):
    return turns.normalize_base_events(s.assistant_activity, s.notebook_activity)


def _leaderboard(s):
    return views.agent_leaderboard(s.session_metrics, s.agent_directory)


def _attribution(s):
    return views.creator_attribution(s.agent_creators, s.agent_directory)


def _plain_times(df: DataFrame) -> DataFrame:
    """UTC instants as plain timestamps, as the oracle has them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else f.name
            for f in df.schema.fields
        ]
    )


# ---- views ------------------------------------------------------------------
@query
def v1_agent_leaderboard(s):
    return _leaderboard(s)


@query
def v2_user_ledger(s):
    return user_ledger(_events(s)).withColumn("agent_ids_used", F.array_join("agent_ids_used", ","))


@query
def v3_adoption_summary(s):
    return views.adoption_summary(_events(s))


@query
def v4_creator_attribution(s):
    return _plain_times(_attribution(s))


# ---- recipes ------------------------------------------------------------------
@query
def r1_adoption_base(s):
    return recipes.base_adoption(_base_events(s), rows=C.ADOPTION_ROWS)


@query
def r2_user_engagement(s):
    return recipes.user_engagement(_base_events(s))


@query
def r3_agent_popularity(s):
    return recipes.agent_popularity(s.assistant_activity, s.agent_directory)


@query
def r5_engine_adoption(s):
    return recipes.engine_adoption(s.assistant_activity)


@query
def r4_governance(s):
    return _plain_times(_attribution(s))


# ---- example queries on the views ---------------------------------------------
@query
def b1_adoption_latest(s):
    return recipes.latest_adoption(views.adoption_summary(_events(s)), rows=C.ADOPTION_ROWS)


@query
def b2_user_active_days(s):
    return recipes.user_active_days(user_flags(_events(s), "activity_date"))


@query
def b3_leaderboard_by_name(s):
    return recipes.leaderboard_by_name(_leaderboard(s))


# ---- reshaping ------------------------------------------------------------------
@query
def t1_creators(s):
    return _plain_times(reshape.extract_creators(s.creation_entries))


@query
def t2_audit_reshape(s):
    return _plain_times(reshape.reshape_audit(s.audit_entries))


@query
def t3_activity_projection(s):
    return _plain_times(reshape.project_activity(s.activity_entries))


@query
def t4_definitions(s):
    return definitions.flatten_definitions(s.agent_definitions)


@query
def t5_definitions_light(s):
    return definitions.flatten_definitions_light(s.agent_definitions)


@query
def t6_datastores(s):
    return definitions.attach_datastores(s.engines, s.data_stores)


@query
def t7_agent_listing(s):
    agents = s.agent_definitions.select("name")
    listed = definitions.list_agents(s.engines, s.assistants, agents)
    return listed.select(last_segment(F.col("name")).alias("agent_id"), "engine_id")


@query
def t8_name_harvest(s):
    return directory.harvest_names(s.assistant_activity).drop("last_logged")


@query
def t11_normalized_events(s):
    return _events(s)


@query
def t11_audit_branches(s):
    """All shapes of audit payloads, as text; requests inside text stay closed."""
    return turns.normalize_events(s.audit_branches, s.assistant_activity.limit(0), s.notebook_activity.limit(0))


@query
def t11_embedded_requests(s):
    """The same with requests inside text opened."""
    return turns.normalize_events(s.audit_branches, s.assistant_activity.limit(0), s.notebook_activity.limit(0), decode_embedded_json=True)


@query
def t12_base_events(s):
    return _base_events(s)


# ---- directory upkeep -------------------------------------------------------------
@query
def m1_upsert(s):
    updates = definitions.flatten_definitions_light(s.agent_definitions)
    return directory.upsert_definitions(s.agent_directory, updates)


@query
def m4_strict_upsert(s):
    """Every update arrives twice; ``error`` accepts exact repeats and would fail on two different rows of an agent."""
    updates = definitions.flatten_definitions_light(s.agent_definitions)
    return directory.upsert_definitions(s.agent_directory, updates.unionByName(updates), on_conflict="error")


@query
def m2_reconcile(s):
    names = directory.harvest_names(s.assistant_activity)
    return directory.reconcile_names(s.agent_directory, names)


@query
def m3_replace(s):
    warehouse = _warehouse(s.spark, "replace")
    warehouse.replace(s.agent_directory, "agent_directory")
    stores = definitions.attach_datastores(s.engines, s.data_stores)
    documents = s.agent_definitions.join(stores, "engine_name", "left")
    warehouse.replace_if_any(definitions.flatten_definitions(documents), "agent_directory")
    return warehouse.read("agent_directory")


# ---- sources and sinks --------------------------------------------------------------
def _warehouse(spark, label: str, *tables: str) -> Warehouse:
    warehouse = Warehouse(spark, scratch_path(spark, label))
    if tables:
        warehouse.ensure_tables(*tables)
    return warehouse


def _write_json(df: DataFrame, path: str) -> None:
    """Landed exports as they usually come: compressed, in files small enough for one task each."""
    options = {"timestampFormat": MICROS, "compression": EXPORT_CODEC, "maxRecordsPerFile": EXPORT_RECORDS}
    df.write.options(**options).json(path)


def _landed_json(spark, df: DataFrame, label: str) -> str:
    path = scratch_path(spark, label)
    _write_json(df, path)
    return path


@query
def s1_log_scan_lookback(s):
    path = _landed_json(s.spark, s.creation_entries, "creations")
    return _plain_times(reshape.extract_creators(logs.read_creation_log(s.spark, path, ORDERS_AS_OF)))


@query
def s2_audit_scan(s):
    path = _landed_json(s.spark, s.audit_entries, "audit")
    entries = logs.read_audit_log(s.spark, path, ACTIVITY_AS_OF, lookback_days=10)
    return _plain_times(reshape.reshape_audit(entries).select("insertId", "timestamp", "protopayload_auditlog"))


@query
def s3_activity_scan(s):
    path = _landed_json(s.spark, s.activity_entries, "activity")
    entries = logs.read_activity_log(s.spark, path, ACTIVITY_AS_OF, lookback_days=10)
    return _plain_times(reshape.project_activity(entries).select("insertId", "timestamp", "jsonPayload"))


@query
def s6_bad_record_budget(s):
    entries = s.activity_entries
    line = F.to_json(F.struct(*entries.columns))
    is_torn = F.bit_count(F.col("insertId").cast("bigint")) == 1
    path = scratch_path(s.spark, "torn")
    torn = F.when(is_torn, line.substr(F.lit(1), F.length(line) - 3)).otherwise(line)
    entries.select(torn.alias("value")).write.text(path)
    good, bad = load_with_bad_budget(s.spark, path, schemas.ACTIVITY_ENTRY)
    return (
        good.select(F.to_date("timestamp").alias("event_date"))
        .unionByName(bad.select(F.lit(None).cast("date").alias("event_date")))
        .groupBy("event_date")
        .agg(F.count("*").alias("records"))
    )


@query
def s6_rejected_lines(s):
    entries = s.activity_entries
    line = F.to_json(F.struct(*entries.columns))
    torn = F.when(F.bit_count(F.col("insertId").cast("bigint")) == 1, line.substr(F.lit(1), F.length(line) - 3))
    path = scratch_path(s.spark, "torn")
    entries.select(F.coalesce(torn, line).alias("value")).write.text(path)
    _, bad = load_with_bad_budget(s.spark, path, schemas.ACTIVITY_ENTRY)
    warehouse = _warehouse(s.spark, "rejected")
    warehouse.reject(bad, "activity_log", "first")
    return warehouse.read("rejected_lines").groupBy("source").agg(F.count("line").alias("lines"))


@query
def s4_empty_keeps_table(s):
    warehouse = _warehouse(s.spark, "empty")
    warehouse.replace(s.agent_directory, "agent_directory")
    warehouse.replace_if_any(s.agent_directory.filter("agent_id = 'nobody'"), "agent_directory")
    return warehouse.read("agent_directory")


@query
def s11_old_files(s):
    """A version whose files were partly written before two columns existed."""
    warehouse = _warehouse(s.spark, "old")
    path = warehouse.replace(s.agent_directory.filter("length(agent_id) % 2 = 1"), "agent_directory")
    old = s.agent_directory.filter("length(agent_id) % 2 = 0").drop("sub_agents", "datastore_ids")
    old.write.mode("append").parquet(path)
    return warehouse.read("agent_directory")


@query
def o5_newest(s):
    path = _landed_json(s.spark, s.creation_entries, "creations")
    newest = logs.read_creation_log(s.spark, path, ORDERS_AS_OF, cap=25)
    return _plain_times(reshape.extract_creators(newest))


@query
def s8_inferred_updates(s):
    updates = definitions.flatten_definitions_light(s.agent_definitions)
    return logs.read_directory_updates(s.spark, _landed_json(s.spark, updates, "updates"))


@query
def s9_metrics_append(s):
    path = _landed_json(s.spark, s.session_metrics, "metrics")
    warehouse = _warehouse(s.spark, "metrics")
    warehouse.append(logs.read_session_metrics(s.spark, path), "agent_session_metrics", "first")
    # a repeated load replaces its own rows
    warehouse.append(logs.read_session_metrics(s.spark, path), "agent_session_metrics", "first")
    return warehouse.read("agent_session_metrics")


# ---- payloads as variants --------------------------------------------------------------
def _variants(s, **logs_: DataFrame) -> Warehouse:
    warehouse = _warehouse(s.spark, "variants", "log_variants")
    for table, rows in logs_.items():
        variants.append(warehouse, rows, table, "first")
    return warehouse


@query
def s2_variant_scan(s):
    """Raw audit entries to landed variants: one read, no inference; the fields that matter come back typed."""
    path = _landed_json(s.spark, s.audit_entries, "audit")
    entries = logs.select_audit_log(variants.read_entries(s.spark, path), ACTIVITY_AS_OF, lookback_days=10)
    warehouse = _variants(s, audit_access=variants.reshape_audit(entries))
    landed = variants.read(warehouse, "audit_access")
    paths = {
        "method_name": "$.methodName", "principal": "$.authenticationInfo.principalEmail", "via": "$.authenticationInfo.@via",
        "request_json": "$.requestJson", "response": "$.response.ok", "status_code": "$.status.code", "details": "$.status.details[0]",
        "permission": "$.authorizationInfo[0].permission", "granted": "$.authorizationInfo[0].@grant", "kind": "$.metadata.kind", "k": "$.metadata.k",
    }
    return _plain_times(json_scalars(landed, "protopayload_auditlog", paths, ["timestamp", "insertId"]))


@query
def t11_variant_events(s):
    warehouse = _variants(s, audit_access=s.audit_access, assistant_activity=s.assistant_activity, notebook_activity=s.notebook_activity)
    return turns.normalize_events(*[variants.read(warehouse, t) for t in ("audit_access", "assistant_activity", "notebook_activity")])


@query
def t11_variant_branches(s):
    warehouse = _variants(s, audit_access=s.audit_branches)
    landed = variants.read(warehouse, "audit_access")
    return turns.normalize_events(landed, s.assistant_activity.limit(0), s.notebook_activity.limit(0), decode_embedded_json=True)


@query
def j1_variant_backfill(s):
    warehouse = _warehouse(s.spark, "backfill")
    jobs.backfill(s.spark, _exports(s), warehouse, ACTIVITY_AS_OF, as_variants=True)
    return adoption_by_period(warehouse.read("usage_events").withColumnRenamed("event_date", "activity_date"))


def _tables(s: SampleLogs) -> dict[str, DataFrame]:
    return {
        "audit_access": s.audit_access,
        "assistant_activity": s.assistant_activity,
        "notebook_activity": s.notebook_activity,
        "agent_directory": s.agent_directory,
        "agent_creators": s.agent_creators,
        "agent_session_metrics": s.session_metrics,
    }


@query
def s10_sql_tables(s):
    views.register_tables(_tables(s))
    return s.spark.sql(
        """
        SELECT n.agent_type, count(*) AS turns,
               count(DISTINCT lower(json_value(a.jsonPayload, '$.userIamPrincipal'))) AS users
        FROM discoveryengine_googleapis_com_gemini_enterprise_user_activity a
        JOIN agent_names n
          ON json_value(a.jsonPayload, '$.request.agentsSpec.agentSpecs[0].agentId') = n.agent_id
        WHERE json_value(a.jsonPayload, '$.request.agentsSpec') IS NULL
        GROUP BY n.agent_type
        """
    )


@query
def s12_sql_views(s):
    views.register_views(_tables(s))
    return s.spark.sql(
        """
        SELECT s.time_period, s.total_active_users, s.distinct_agents_used, u.chat_days
        FROM vw_feature_adoption_summary s
        JOIN (SELECT activity_date, count_if(used_chat) AS chat_days
              FROM vw_user_feature_adoption GROUP BY activity_date) u
          ON s.time_period = u.activity_date
        """
    )


@query
def s13_day_partitions(s):
    warehouse = _warehouse(s.spark, "days")
    warehouse.append(s.audit_access, "audit_access", "first")
    warehouse.append(s.notebook_activity, "notebook_activity", "first")
    landed = warehouse.read("audit_access").filter(F.col("event_date") >= F.lit("2024-01-20").cast("date"))
    return landed.groupBy("event_date").agg(F.count("*").alias("records"))


@query
def s14_engine_filter(s):
    engine = engine_of(F.col("agent_name"))
    kept = logs.filter_engines(s.session_metrics, "engine-1, engine-3,,", engine)
    return kept.groupBy(engine.alias("engine_id")).agg(
        F.count("*").alias("metric_rows"), F.sum("agent_session_count").alias("total_sessions")
    )


# ---- questions ------------------------------------------------------------------------
@query
def n1_dau_trend(s):
    return questions.dau_trend(_events(s), ACTIVITY_AS_OF, 14)


@query
def n2_adoption_weekly(s):
    return questions.adoption(_events(s), "week")


@query
def n2_adoption_monthly(s):
    return questions.adoption(_events(s), "month")


@query
def n3_power_users(s):
    return questions.power_users(_events(s), ACTIVITY_AS_OF, 7)


@query
def n4_all_three_users(s):
    return questions.users_of(_events(s), ("chat", "notebooklm", "agent"))


@query
def n5_feature_users(s):
    return questions.users_of(_events(s), ("notebooklm",))


@query
def n6_exclusive_segments(s):
    return questions.exclusive_segments(_events(s))


@query
def n7_creator_agents(s):
    return _plain_times(questions.creator_agents(_attribution(s)))


@query
def n7_top_creators(s):
    return _plain_times(questions.top_creators(_attribution(s), 10))


@query
def n8_agents_by_architecture(s):
    return questions.agents_by_architecture(s.agent_directory)


@query
def n9_agent_profile(s):
    return _plain_times(questions.agent_profile(_attribution(s), "Customer#000000009"))


@query
def n10_recent_agents(s):
    return _plain_times(questions.recent_agents(_attribution(s), ORDERS_AS_OF, 30))


@query
def n11_top_agents(s):
    return questions.top_agents(_leaderboard(s), 5)


@query
def n12_idle_agents(s):
    turns_ = turns.agent_turns(s.assistant_activity)
    return questions.idle_agents(s.agent_directory, turns_, ACTIVITY_AS_OF, 30)


@query
def n13_distinct_agents_on_day(s):
    return questions.distinct_agents_on(_events(s), "2024-01-30")


@query
def n14_engine_sessions(s):
    return questions.engine_sessions(_leaderboard(s))


@query
def n14_busiest_engine(s):
    return questions.busiest_engine(recipes.engine_adoption(s.assistant_activity))


@query
def n15_user_agent_history(s):
    return questions.user_agent_history(_events(s), s.agent_directory)


@query
def n16_adoption_bars(s):
    return questions.adoption_bars(views.adoption_summary(_events(s)))


# ---- questions out of stored bitmaps ----------------------------------------------------
def _in_loads(s, loads: int, store) -> Warehouse:
    """A warehouse into which the logs come in several loads; all but the first bring late rows for all days."""
    warehouse = _warehouse(s.spark, "loads")
    for load in range(loads):
        mine = F.col("insertId").cast("bigint") % loads == load
        logs_ = (s.audit_access, s.assistant_activity, s.notebook_activity)
        store(warehouse, turns.normalize_events(*[log.filter(mine) for log in logs_]), f"load-{load}")
    return warehouse


def _bitmaps(s) -> DataFrame:
    return _in_loads(s, 2, rollup.store_bitmaps).read("usage_bitmaps")


@query
def n2_bitmap_weekly(s):
    return adoption_from_bitmaps(_bitmaps(s), "week")


@query
def n2_bitmap_monthly(s):
    return adoption_from_bitmaps(_bitmaps(s), "month")


@query
def n3_bitmap_power_users(s):
    recent = _bitmaps(s).filter(in_last_days(F.col("activity_date"), ACTIVITY_AS_OF, 7))
    counts = period_users(recent).select(
        F.col("total_active_users").alias("active_users"), F.col("notebooklm_and_agents_users").alias("power_users")
    )
    return counts.selectExpr("*", f"{share('power_users', 'active_users')} AS power_pct")


@query
def a3_rolling_week(s):
    return rolling_adoption(_bitmaps(s), 7)


# ---- views stored by day ------------------------------------------------------------------
def _append_events(warehouse: Warehouse, events: DataFrame, load_id: str) -> None:
    warehouse.append(events.withColumnRenamed("activity_date", "event_date"), "usage_events", load_id)


def _daily(s) -> Warehouse:
    """The stored views follow two loads; the second one brings late rows."""

    def store(warehouse, events, load_id):
        _append_events(warehouse, events, load_id)
        rollup.refresh_daily(warehouse, f"after-{load_id}")

    return _in_loads(s, 2, store)


@query
def v2_daily_ledger(s):
    return _daily(s).read("daily_ledger").withColumn("agent_ids_used", F.array_join("agent_ids_used", ","))


@query
def v3_daily_adoption(s):
    return _daily(s).read("daily_adoption").withColumnRenamed("activity_date", "time_period")


# ---- events kept by user -------------------------------------------------------------------
def _bucketed(s) -> DataFrame:
    """A name of its own per run: an earlier run's result may still be read."""
    path = scratch_path(s.spark, "bucketed")
    return bucketed.store(_events(s), path, path.rsplit("/", 1)[-1].replace("-", "_"), buckets=8)


@query
def v2_bucketed_ledger(s):
    return user_ledger(_bucketed(s)).withColumn("agent_ids_used", F.array_join("agent_ids_used", ","))


@query
def n5_bucketed_users(s):
    return questions.users_of(_bucketed(s), ("notebooklm",))


# ---- questions as SQL ---------------------------------------------------------------------
def _asked(s, text: str) -> DataFrame:
    """Ask a question in SQL over a warehouse with landed events and metrics."""
    warehouse = _warehouse(s.spark, "asked", "usage_events", "agent_session_metrics", "agent_names_seen", *schemas.SNAPSHOT_TABLES)
    views.register_live(warehouse)
    views.register_questions(warehouse)
    if "usage_top_agents" in text:
        warehouse.append(s.session_metrics, "agent_session_metrics", "first")
        warehouse.replace(s.agent_directory, "agent_directory")
    else:
        _append_events(warehouse, _events(s), "first")
    return s.spark.sql(text)


@query
def n1_sql_dau_trend(s):
    return _asked(s, f"SELECT * FROM usage_dau_trend(DATE '{ACTIVITY_AS_OF}', 14)")


@query
def n3_sql_power_users(s):
    return _asked(s, f"SELECT * FROM usage_power_users(DATE '{ACTIVITY_AS_OF}', days => 7)")


@query
def n5_sql_feature_users(s):
    return _asked(s, "SELECT * FROM usage_feature_users('notebooklm')")


@query
def n11_sql_top_agents(s):
    return _asked(s, "SELECT * FROM usage_top_agents()")


@query
def n13_sql_agents_on_day(s):
    return _asked(s, "SELECT * FROM usage_agents_on(DATE '2024-01-30')")


# ---- streams -----------------------------------------------------------------------------
def _run_stream(s, warehouse: Warehouse, after_batch=(), halves: int = 1, typed: bool = False, apart: bool = False) -> None:
    """Land the entries in ``halves`` arrivals; every later one brings late rows for all days.

    ``apart``: every arrival has a folder, a checkpoint and so a stream of its own.
    """
    arrivals, checkpoint = scratch_path(s.spark, "arrivals"), scratch_path(s.spark, "checkpoint")
    for half in range(halves):
        if apart:
            arrivals, checkpoint = scratch_path(s.spark, "arrivals"), scratch_path(s.spark, "checkpoint")
        part = s.stream_entries.filter(F.col("insertId").cast("bigint") % halves == half)
        _land(s, part, warehouse, arrivals, checkpoint, after_batch=after_batch, typed=typed)


def _land(s, entries: DataFrame, warehouse: Warehouse, arrivals: str, checkpoint: str, **options) -> None:
    entries.write.mode("append").option("timestampFormat", MICROS).json(arrivals)
    stream = landing.read_entries(s.spark, arrivals)
    landing.land_activity(stream, warehouse, checkpoint, once=True, **options).awaitTermination()


def _landed_per_day(warehouse: Warehouse) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            warehouse.read(name).groupBy("event_date").agg(F.count("*").alias("records")).withColumn(
                "landed_in", F.lit(name)
            )
            for name in schemas.LOG_TABLES
        ],
    )


@query
def w1_stream_routing(s):
    warehouse = _warehouse(s.spark, "stream", *schemas.LOG_TABLES)
    _run_stream(s, warehouse)
    return _landed_per_day(warehouse)


@query
def w6_two_streams(s):
    """Two streams with checkpoints of their own, hence equal batch numbers, into one warehouse."""
    warehouse = _warehouse(s.spark, "streams", *schemas.LOG_TABLES)
    _run_stream(s, warehouse, halves=2, apart=True)
    return _landed_per_day(warehouse)


@query
def w7_view_follows_landing(s):
    """Views are registered before anything lands."""
    warehouse = _warehouse(s.spark, "live")
    warehouse.ensure_tables()
    views.register_live(warehouse)
    _run_stream(s, warehouse, halves=2, typed=True)
    return s.spark.sql(
        "SELECT time_period, total_active_users, distinct_agents_used, agent_pct FROM vw_feature_adoption_summary"
    )


@query
def w8_stream_dedup(s):
    """Everything arrives twice; the span of the data is shorter than the delay."""
    warehouse = _warehouse(s.spark, "repeats", *schemas.LOG_TABLES)
    arrivals, checkpoint = scratch_path(s.spark, "arrivals"), scratch_path(s.spark, "checkpoint")
    for _ in range(2):
        _land(s, s.stream_entries, warehouse, arrivals, checkpoint, typed=False, repeats_within="60 days")
    return _landed_per_day(warehouse)


@query
def w8_late_repeats(s):
    """Half of the entries arrive, then all of them: repeats and new rows of every day, later than any delay."""
    warehouse = _warehouse(s.spark, "once", *schemas.LOG_TABLES)
    arrivals, checkpoint = scratch_path(s.spark, "arrivals"), scratch_path(s.spark, "checkpoint")
    for part in (s.stream_entries.filter("CAST(insertId AS BIGINT) % 2 = 0"), s.stream_entries):
        _land(s, part, warehouse, arrivals, checkpoint, typed=False, only_new=True)
    return _landed_per_day(warehouse)


@query
def s15_typed_landing(s):
    warehouse = _warehouse(s.spark, "typed", "usage_events")
    _run_stream(s, warehouse, halves=2, typed=True)
    return warehouse.read("usage_events").groupBy("event_date").agg(
        F.count("*").alias("events"),
        F.count_if("is_chat").alias("chats"),
        F.count_if("is_agent").alias("agent_turns"),
        F.count_if("is_nblm").alias("notebook_turns"),
        F.count_distinct("agent_id").alias("agents"),
    )


@query
def w2_stream_creations(s):
    entries = s.creation_entries
    arrivals, checkpoint = _landed_json(s.spark, entries, "arrivals"), scratch_path(s.spark, "checkpoint")
    warehouse = _warehouse(s.spark, "creations")
    stream = landing.read_entries(s.spark, arrivals)
    landing.land_creations(stream, warehouse, checkpoint, once=True).awaitTermination()
    return _plain_times(warehouse.read("creation_events").drop("event_date"))


@query
def w3_incremental_adoption(s):
    warehouse = _warehouse(s.spark, "incremental", "user_ledger")
    _run_stream(s, warehouse, after_batch=[landing.refresh_ledger], halves=2)
    return adoption_from_ledger(warehouse.read("user_ledger"))


@query
def w4_dedup(s):
    rows = s.assistant_activity
    number = F.col("insertId").cast("bigint")
    copies = rows.filter(number % 3 == 0).withColumn("jsonPayload", F.lit("{}"))
    repeated = rows.unionByName(copies).withColumn("insertId", F.when(number % 10 != 1, F.col("insertId")))
    return (
        without_repeats(repeated, "jsonPayload")
        .groupBy(F.to_date("timestamp").alias("event_date"))
        .agg(F.count("*").alias("records"), F.count_if(F.col("jsonPayload") == "{}").alias("reduced"))
    )


@query
def w5_stream_names(s):
    warehouse = _warehouse(s.spark, "names")
    warehouse.replace(s.agent_directory, "agent_directory")
    _run_stream(s, warehouse, after_batch=[landing.refresh_names], halves=2)
    return warehouse.read("agent_directory")


# ---- jobs ---------------------------------------------------------------------------------
def _exports(s) -> jobs.Landing:
    root = scratch_path(s.spark, "exports")
    frames = {
        "engines": s.engines,
        "assistants": s.assistants,
        "agents": s.agent_definitions.select("name", "displayName", "draftDisplayName"),
        "agent_details": s.agent_definitions.drop("engine_name"),
        "data_stores": s.data_stores,
        "creation_log": s.creation_entries,
        "audit_log": s.audit_entries,
        "activity_log": s.activity_entries,
        "session_metrics": s.session_metrics,
    }
    for name, frame in frames.items():
        _write_json(frame, f"{root}/{name}")
    return jobs.Landing(root)


@query
def j1_backfill(s):
    warehouse = _warehouse(s.spark, "backfill")
    jobs.backfill(s.spark, _exports(s), warehouse, ACTIVITY_AS_OF)
    return adoption_by_period(warehouse.read("usage_events").withColumnRenamed("event_date", "activity_date"))


@query
def j2_nightly(s):
    warehouse = _warehouse(s.spark, "nightly")
    warehouse.ensure_tables()
    warehouse.append(s.assistant_activity, "assistant_activity", "first")
    return jobs.nightly(s.spark, _exports(s), warehouse, "night")


@query
def j2_nightly_names(s):
    """Two nights; the second one harvests the loads of its day only, the directory shows the names of both."""
    warehouse = _warehouse(s.spark, "nights")
    warehouse.ensure_tables()
    warehouse.replace(s.agent_directory, "agent_directory")
    early = F.col("timestamp") < F.lit("2024-01-16").cast("timestamp")
    for night, part in enumerate((early, ~early)):
        warehouse.append(s.assistant_activity.filter(part), "assistant_activity", f"day-{night}")
        jobs.reconcile_directory(warehouse, f"night-{night}")
    return warehouse.read("agent_directory")


# ---- quality ------------------------------------------------------------------------------
@query
def x1_duplicate_agents(s):
    updates = definitions.flatten_definitions_light(s.agent_definitions)
    both = s.agent_directory.unionByName(updates, allowMissingColumns=True)
    return quality.duplicate_agents(both)


@query
def x3_view_recipe_diff(s):
    return quality.view_recipe_difference(
        views.adoption_summary(_events(s)), recipes.base_adoption(_base_events(s), rows=None)
    )
