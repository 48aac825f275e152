"""The four published views."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens import constants as C
from usagelens.functions.columns import engine_of, last_segment, non_empty, share, sql_in
from usagelens.functions.json_scalar import scalar_text
from usagelens.operators.adoption import FEATURES, adoption_by_period, user_ledger
from usagelens.operators.turns import normalize_events
from usagelens.sources.tables import Warehouse

# flags of a user and the event flags they fold
_EVENT_FLAGS = {"used_chat": "is_chat", "used_agents": "is_agent", "used_notebooklm": "is_nblm"}


def agent_leaderboard(metrics: DataFrame, directory: DataFrame) -> DataFrame:
    """Sessions, peak monthly users and active range per agent.

    Metrics are folded to one row per (agent, engine in the path) before the join, so the join and
    its shuffle see agents instead of agent-days. Sums and extremes fold the same way again when a
    directory row repeats or renames an agent, hence the result equals joining first.
    """
    folded = (
        metrics.groupBy(
            last_segment(F.col("agent_name")).alias("agent_id"),
            engine_of(F.col("agent_name")).alias("path_engine"),
        )
        .agg(
            F.sum("agent_session_count").alias("total_sessions"),
            F.max("monthly_agent_active_user_count").alias("monthly_users"),
            F.min("date").alias("first_active_date"),
            F.max("date").alias("last_active_date"),
        )
    )
    names = directory.select(
        F.col("agent_id").alias("known_id"),
        non_empty(F.col("display_name")).alias("known_name"),
        non_empty(F.col("engine_id")).alias("known_engine"),
    )
    # names are resolved before grouping: the source columns share the output names
    resolved = folded.join(names, F.col("agent_id") == F.col("known_id"), "left").select(
        "agent_id",
        F.coalesce("known_name", "agent_id").alias("display_name"),
        F.coalesce("known_engine", "path_engine", F.lit(C.DEFAULT_ENGINE)).alias("engine_id"),
        "total_sessions",
        "monthly_users",
        "first_active_date",
        "last_active_date",
    )
    return resolved.groupBy("agent_id", "display_name", "engine_id").agg(
        F.sum("total_sessions").alias("total_sessions"),
        F.max("monthly_users").alias("monthly_users"),
        F.min("first_active_date").alias("first_active_date"),
        F.max("last_active_date").alias("last_active_date"),
    )


def adoption_summary(events: DataFrame) -> DataFrame:
    """Daily adoption, newest day first."""
    return adoption_by_period(events).orderBy(F.desc("time_period"))


def creator_attribution(creators: DataFrame, directory: DataFrame) -> DataFrame:
    """Who created which agent, with the directory's current metadata, newest first.

    The sort continues over agent and creator: creations that share one instant are spread over
    the range partitions instead of landing in one.
    """
    known = directory.select(
        F.col("agent_id").alias("known_id"),
        non_empty(F.col("display_name")).alias("known_name"),
        non_empty(F.col("engine_id")).alias("known_engine"),
        "agent_type",
        "description",
        "system_instructions",
    )
    return (
        creators.select(
            "creator_email",
            F.col("timestamp").alias("creation_time"),
            "agent_id",
            non_empty(F.col("engine_id")).alias("created_engine"),
        )
        .join(known, F.col("agent_id") == F.col("known_id"), "left")
        .select(
            "creator_email",
            "creation_time",
            "agent_id",
            F.coalesce("known_engine", "created_engine", F.lit(C.DEFAULT_ENGINE)).alias("engine_id"),
            F.coalesce("known_name", "agent_id").alias("display_name"),
            "agent_type",
            "description",
            "system_instructions",
        )
        .orderBy(F.desc("creation_time"), "agent_id", "creator_email")
    )


def register_views(tables: dict[str, DataFrame], decode_embedded_json: bool = False) -> None:
    """Register (or replace) the four views over given DataFrames, as they are now.

    For views that follow a warehouse see ``register_live``.
    """
    events = normalize_events(
        tables["audit_access"],
        tables["assistant_activity"],
        tables["notebook_activity"],
        decode_embedded_json,
    )
    directory = tables["agent_directory"]
    published = {
        "agent_leaderboard": agent_leaderboard(tables["agent_session_metrics"], directory),
        "user_ledger": user_ledger(events),
        "adoption_summary": adoption_summary(events),
        "creator_attribution": creator_attribution(tables["agent_creators"], directory),
    }
    for name, view in published.items():
        view.createOrReplaceTempView(C.VIEW_NAMES[name])


def register_live(warehouse: Warehouse) -> None:
    """Register the four views over a warehouse once; every query sees what has landed by then.

    The views are SQL text over the folders. Spark resolves the text, and with it the list of files,
    each time a view is used, in contrast to a registered DataFrame, which keeps the files of the moment
    it was made. Events come from the typed columns that loads write, so no payload is parsed, and a
    range of days reads only its partitions. Needs ``ensure_tables``.
    """
    spark, root = warehouse.spark, warehouse.root.rstrip("/")

    def view(name: str, text: str) -> None:
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {text}")

    def snapshot(table: str) -> str:
        newest = f"SELECT max_by(version, number) FROM parquet.`{root}/snapshot_pointers/table={table}`"
        return f"SELECT * FROM parquet.`{root}/{table}` WHERE CAST(version AS STRING) = ({newest})"

    view(
        "usagelens_events",
        "SELECT user_email, CAST(event_date AS DATE) AS activity_date, is_chat, is_agent, is_nblm, agent_id"
        f" FROM parquet.`{root}/usage_events`",
    )
    placeholders = f"(display_name IS NULL OR display_name IN {sql_in(C.PLACEHOLDER_NAMES)})"
    view(
        "usagelens_directory",
        f"""
        WITH stored AS ({snapshot("agent_directory")}), names AS (
          SELECT agent_id, max(struct(last_logged, display_name, agent_type)) AS best
          FROM parquet.`{root}/agent_names_seen` WHERE agent_id IS NOT NULL GROUP BY agent_id)
        SELECT s.agent_id, IF(n.agent_id IS NOT NULL AND {placeholders}, n.best.display_name, s.display_name) AS display_name,
               engine_id, description, system_instructions,
               IF(n.agent_id IS NOT NULL AND {placeholders}, n.best.agent_type, s.agent_type) AS agent_type
        FROM stored s LEFT JOIN names n ON s.agent_id = n.agent_id
        UNION ALL
        SELECT n.agent_id, n.best.display_name, NULL, NULL, NULL, n.best.agent_type
        FROM names n LEFT ANTI JOIN stored s ON s.agent_id = n.agent_id""",
    )
    flags = _EVENT_FLAGS
    folded = ", ".join(f"bool_or({event}) AS {flag}" for flag, event in flags.items())
    refolded = ", ".join(f"bool_or({flag}) AS {flag}" for flag in flags)
    view(
        C.VIEW_NAMES["user_ledger"],
        f"""
        SELECT user_email, activity_date, {refolded}, array_sort(collect_list(agent_id)) AS agent_ids_used
        FROM (SELECT user_email, activity_date, agent_id, {folded} FROM usagelens_events GROUP BY ALL)
        GROUP BY user_email, activity_date""",
    )
    counts = ", ".join(
        f"count_if(user_email IS NOT NULL AND {' AND '.join(needed)}) AS {name}_users" for name, needed in FEATURES.items()
    )
    shares = ", ".join(
        f"{name}_users, {share(f'{name}_users', 'total_active_users')} AS {name}_pct"
        + (", distinct_agents_used" if name == "agent" else "")
        for name in FEATURES
    )
    view(
        C.VIEW_NAMES["adoption_summary"],
        f"""
        SELECT time_period, total_active_users, {shares} FROM (
          SELECT activity_date AS time_period, count(user_email) AS total_active_users, {counts},
                 count(agent_id) AS distinct_agents_used
          FROM (SELECT activity_date, user_email, agent_id, {folded} FROM usagelens_events
                GROUP BY GROUPING SETS ((activity_date, user_email), (activity_date, agent_id)))
          GROUP BY activity_date)
        ORDER BY time_period DESC""",
    )
    view(
        C.VIEW_NAMES["agent_leaderboard"],
        f"""
        WITH folded AS (
          SELECT substring_index(agent_name, '/', -1) AS agent_id,
                 nullif(regexp_extract(agent_name, 'engines/([^/]+)', 1), '') AS path_engine,
                 sum(agent_session_count) AS total_sessions, max(monthly_agent_active_user_count) AS monthly_users,
                 min(date) AS first_active_date, max(date) AS last_active_date
          FROM parquet.`{root}/agent_session_metrics` GROUP BY 1, 2)
        SELECT f.agent_id, coalesce(nullif(d.display_name, ''), f.agent_id) AS display_name,
               coalesce(nullif(d.engine_id, ''), path_engine, '{C.DEFAULT_ENGINE}') AS engine_id,
               sum(total_sessions) AS total_sessions, max(monthly_users) AS monthly_users,
               min(first_active_date) AS first_active_date, max(last_active_date) AS last_active_date
        FROM folded f LEFT JOIN usagelens_directory d ON f.agent_id = d.agent_id
        GROUP BY 1, 2, 3""",
    )
    view(
        C.VIEW_NAMES["creator_attribution"],
        f"""
        SELECT c.creator_email, c.timestamp AS creation_time, c.agent_id,
               coalesce(nullif(d.engine_id, ''), nullif(c.engine_id, ''), '{C.DEFAULT_ENGINE}') AS engine_id,
               coalesce(nullif(d.display_name, ''), c.agent_id) AS display_name,
               d.agent_type, d.description, d.system_instructions
        FROM ({snapshot("agent_creators")}) c LEFT JOIN usagelens_directory d ON c.agent_id = d.agent_id
        ORDER BY creation_time DESC, agent_id, creator_email""",
    )


def register_questions(warehouse: Warehouse) -> None:
    """Five questions as SQL table functions over the live views, which ``register_live`` must have registered.

    Spark inlines a function's text into the query, so a day range given as an argument still prunes folders.
    """
    flags = ", ".join(f"bool_or({event}) AS {flag}" for flag, event in _EVENT_FLAGS.items())
    span = "activity_date > date_sub(as_of, days) AND activity_date <= as_of"
    functions = {
        "usage_dau_trend(as_of DATE, days INT DEFAULT 30)": (
            "time_period DATE, total_active_users BIGINT",
            f"SELECT activity_date, count(DISTINCT user_email) FROM usagelens_events WHERE {span} GROUP BY activity_date",
        ),
        "usage_power_users(as_of DATE, days INT DEFAULT 30)": (
            "active_users BIGINT, power_users BIGINT, power_pct DOUBLE",
            f"""SELECT active, power, {share('power', 'active')} FROM (
                  SELECT count(*) AS active, count_if(used_agents AND used_notebooklm) AS power
                  FROM (SELECT user_email, {flags} FROM usagelens_events WHERE {span} GROUP BY user_email))""",
        ),
        "usage_feature_users(feature STRING)": (
            "user_email STRING, active_days BIGINT, feature_days BIGINT",
            f"""SELECT user_email, count(*), count_if(used) FROM (
                  SELECT user_email, CASE feature WHEN 'chat' THEN used_chat WHEN 'agent' THEN used_agents
                                                  WHEN 'notebooklm' THEN used_notebooklm END AS used
                  FROM (SELECT user_email, activity_date, {flags} FROM usagelens_events GROUP BY user_email, activity_date))
                GROUP BY user_email HAVING bool_or(used)""",
        ),
        "usage_agents_on(day DATE)": (
            "distinct_agents_used BIGINT",
            "SELECT count(DISTINCT agent_id) FROM usagelens_events WHERE activity_date = day",
        ),
        "usage_top_agents(k INT DEFAULT 5)": (
            "agent_id STRING, display_name STRING, engine_id STRING, total_sessions BIGINT, monthly_users BIGINT,"
            " first_active_date DATE, last_active_date DATE",
            f"""SELECT agent_id, display_name, engine_id, total_sessions, monthly_users, first_active_date, last_active_date FROM (
                  SELECT *, row_number() OVER (ORDER BY total_sessions DESC, monthly_users DESC, agent_id, engine_id) AS place
                  FROM {C.VIEW_NAMES["agent_leaderboard"]}) WHERE place <= k""",
        ),
    }
    for head, (columns, text) in functions.items():
        warehouse.spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS TABLE({columns}) RETURN {text}")


def register_tables(tables: dict[str, DataFrame]) -> None:
    """Register the base tables under the names existing queries use, and ``json_value``.

    ``json_value(document, path)`` is an SQL function that Spark inlines: the text of a scalar, NULL
    for objects and arrays. Queries over many rows and paths are better served by the typed turns.
    """
    for name, published in C.TABLE_NAMES.items():
        tables[name].createOrReplaceTempView(published)
    found = "try_variant_get(try_parse_json(document), path, 'variant')"
    tables["agent_directory"].sparkSession.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION json_value(document STRING, path STRING)"
        f" RETURNS STRING RETURN {scalar_text(found)}"
    )
