"""Oracle SQL over the flat columns of the given tables."""

_EVENTS = """
ev0 AS (
  SELECT event_id, user_id, event_type, ts, CAST(ts AS DATE) AS day,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k
  FROM events
),
ev1 AS (
  SELECT *,
    CASE WHEN event_id % 13 = 0 THEN NULL
         WHEN event_id % 5 = 0 THEN 'USER' || user_id || '@EXAMPLE.COM'
         ELSE 'user' || user_id || '@example.com' END AS principal,
    CASE WHEN k < 30 THEN NULL WHEN k < 35 THEN 'workflow_summary_agent'
         WHEN k < 40 THEN 'default_assistant'
         ELSE CAST((user_id * 7 + k) % 140 AS VARCHAR) END AS agent
  FROM ev0
),
ev AS (
  SELECT *,
    CASE WHEN k % 2 = 0 THEN agent END AS resp,
    CASE WHEN k % 2 = 0 AND agent IS NOT NULL
         THEN 'Agent ' || agent || CASE WHEN event_id % 50 = 0 THEN ' v2' ELSE '' END END AS resp_name,
    CASE WHEN agent IS NOT NULL AND k % 6 = 0 THEN 'engine-' || (user_id % 4) END AS spiffe_engine,
    CASE WHEN k % 5 <> 0 THEN 'engine-' || (user_id % 4) END AS path_engine
  FROM ev1
)"""

_SYSTEM = "('workflow_summary_agent', 'default_assistant')"

_NORMALIZED = f"""
norm AS (
  SELECT principal AS user_email, day AS activity_date,
    event_type = 'signup' AND (k < 10 OR agent IS NULL) AS is_chat,
    event_type = 'signup' AND agent IS NOT NULL AND agent NOT IN {_SYSTEM} AS is_agent,
    event_type = 'error' AS is_nblm,
    CASE WHEN agent IN {_SYSTEM} THEN NULL ELSE agent END AS agent_id
  FROM ev WHERE event_type IN ('error', 'signup') AND principal IS NOT NULL
  UNION ALL
  SELECT principal, day, resp IS NULL,
    resp IS NOT NULL AND resp NOT IN {_SYSTEM}, FALSE,
    CASE WHEN agent IN {_SYSTEM} THEN NULL ELSE agent END
  FROM ev WHERE event_type IN ('view', 'click') AND principal IS NOT NULL
  UNION ALL
  SELECT principal, day, FALSE, FALSE, TRUE, NULL
  FROM ev WHERE event_type = 'purchase' AND principal IS NOT NULL
)"""

_BASE = f"""
norm AS (
  SELECT lower(principal) AS user_email, day AS activity_date,
    agent IS NULL OR agent IN {_SYSTEM} AS is_chat,
    agent IS NOT NULL AND agent NOT IN {_SYSTEM} AS is_agent,
    FALSE AS is_nblm, agent AS agent_id
  FROM ev WHERE event_type IN ('view', 'click') AND principal IS NOT NULL
  UNION ALL
  SELECT lower(principal), day, FALSE, FALSE, TRUE, NULL
  FROM ev WHERE event_type = 'purchase' AND principal IS NOT NULL
)"""

_LEDGER = """
ledger AS (
  SELECT user_email, activity_date, bool_or(is_chat) AS used_chat, bool_or(is_agent) AS used_agents,
         bool_or(is_nblm) AS used_notebooklm
  FROM norm GROUP BY user_email, activity_date
)"""

_PREFIX = "projects/p1/locations/global/collections/default_collection/"

_DIRECTORY = """
dir AS (
  SELECT CASE WHEN c_custkey % 11 = 0 THEN 'legacy-' ELSE '' END || c_custkey AS agent_id,
    CASE c_custkey % 10 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'My Agent'
         WHEN 3 THEN 'Unknown Name' ELSE c_name END AS display_name,
    CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'engine-' || (c_custkey % 4) END AS engine_id,
    'Agent for ' || c_mktsegment AS description,
    'You are ' || c_name AS system_instructions,
    '' AS datastore_ids, '' AS datastore_names,
    CASE c_mktsegment WHEN 'MACHINERY' THEN 'ADK Agent' WHEN 'BUILDING' THEN 'Agent Builder (UI)'
         WHEN 'AUTOMOBILE' THEN 'Managed Agent' WHEN 'FURNITURE' THEN 'Agent Designer'
         ELSE 'Unknown' END AS agent_type,
    '' AS sub_agents
  FROM customer
)"""

_CREATORS = """
creators AS (
  SELECT o_orderdate AS creation_time, 'maker' || (o_custkey % 97) || '@example.com' AS creator_email,
    CAST(o_custkey AS VARCHAR) AS agent_id,
    CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'engine-' || (o_custkey % 4) END AS engine_id
  FROM orders
),
attribution AS (
  SELECT c.creator_email, c.creation_time, c.agent_id,
    COALESCE(NULLIF(d.engine_id, ''), NULLIF(c.engine_id, ''), 'default_engine') AS engine_id,
    COALESCE(NULLIF(d.display_name, ''), c.agent_id) AS display_name,
    d.agent_type, d.description, d.system_instructions
  FROM creators c LEFT JOIN dir d ON c.agent_id = d.agent_id
)"""

_LEADERBOARD = """
leaderboard AS (
  SELECT m.agent_id, COALESCE(NULLIF(d.display_name, ''), m.agent_id) AS display_name,
    COALESCE(NULLIF(d.engine_id, ''), m.path_engine, 'default_engine') AS engine_id,
    CAST(sum(m.sessions) AS BIGINT) AS total_sessions, max(m.monthly) AS monthly_users,
    min(m.day) AS first_active_date, max(m.day) AS last_active_date
  FROM (
    SELECT CAST(o_custkey AS VARCHAR) AS agent_id, CAST(o_orderdate AS DATE) AS day,
      CASE WHEN o_orderkey % 20 <> 0 THEN 'engine-' || (o_custkey % 4) END AS path_engine,
      1 + o_orderkey % 17 AS sessions, o_orderkey % 50 AS monthly
    FROM orders
  ) m LEFT JOIN dir d ON m.agent_id = d.agent_id
  GROUP BY 1, 2, 3
)"""

_FEATURES = {
    "chat": "used_chat",
    "notebooklm": "used_notebooklm",
    "agent": "used_agents",
    "chat_and_notebooklm": "used_chat AND used_notebooklm",
    "chat_and_agents": "used_chat AND used_agents",
    "notebooklm_and_agents": "used_notebooklm AND used_agents",
    "all_three": "used_chat AND used_notebooklm AND used_agents",
}


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _shares() -> str:
    count = "CAST(count(*) FILTER (WHERE {0}) AS BIGINT)"
    columns = []
    for name, flags in _FEATURES.items():
        users = count.format(flags)
        columns.append(f"{users} AS {name}_users")
        columns.append(f"round({users} * CAST(100.0 AS DOUBLE) / NULLIF(count(*), 0), 2) AS {name}_pct")
    return ", ".join(columns)


def _adoption(grain: str = "day") -> str:
    period = "activity_date" if grain == "day" else f"CAST(date_trunc('{grain}', activity_date) AS DATE)"
    return (
        f"users AS (SELECT {period} AS time_period, user_email, bool_or(is_chat) AS used_chat,"
        " bool_or(is_agent) AS used_agents, bool_or(is_nblm) AS used_notebooklm FROM norm GROUP BY 1, 2),\n"
        f"agents AS (SELECT {period} AS time_period, count(DISTINCT agent_id) AS n FROM norm GROUP BY 1),\n"
        "summary AS (SELECT time_period, count(*) AS total_active_users, "
        f"{_shares()}, CAST(coalesce(max(n), 0) AS BIGINT) AS distinct_agents_used"
        " FROM users LEFT JOIN agents USING (time_period) GROUP BY time_period)"
    )


_SUMMARY = _with(_EVENTS, _NORMALIZED, _adoption())


def _base_adoption() -> str:
    return (
        _with(_EVENTS, _BASE, _LEDGER)
        + f"SELECT activity_date, count(*) AS total_active_users, {_shares()} FROM ledger"
        " GROUP BY activity_date ORDER BY activity_date DESC LIMIT 30"
    )


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["v1_agent_leaderboard"] = _with(_DIRECTORY, _LEADERBOARD) + "SELECT * FROM leaderboard"
    sql["v2_user_ledger"] = (
        _with(_EVENTS, _NORMALIZED)
        + "SELECT user_email, activity_date, bool_or(is_chat) AS used_chat, bool_or(is_agent) AS used_agents,"
        " bool_or(is_nblm) AS used_notebooklm,"
        " coalesce(string_agg(DISTINCT agent_id, ',' ORDER BY agent_id), '') AS agent_ids_used"
        " FROM norm GROUP BY user_email, activity_date"
    )
    sql["v3_adoption_summary"] = _SUMMARY + "SELECT * FROM summary ORDER BY time_period DESC"
    sql["v4_creator_attribution"] = _with(_DIRECTORY, _CREATORS) + "SELECT * FROM attribution"
    sql["r1_adoption_base"] = _base_adoption()
    sql["r2_user_engagement"] = (
        _with(_EVENTS, _BASE)
        + "SELECT user_email, count(DISTINCT activity_date) AS total_active_days,"
        " count(*) FILTER (WHERE is_chat) AS chat_interaction_count,"
        " count(*) FILTER (WHERE is_nblm) AS notebooklm_interaction_count,"
        " count(*) FILTER (WHERE is_agent) AS custom_agent_interaction_count,"
        " min(activity_date) AS first_seen_date, max(activity_date) AS last_seen_date"
        " FROM norm GROUP BY user_email"
    )
    sql["r3_agent_popularity"] = (
        _with(_EVENTS, _DIRECTORY)
        + "SELECT COALESCE(NULLIF(d.display_name, ''), e.agent) AS display_name, e.agent AS agent_id, d.agent_type,"
        " count(*) AS total_turns, count(DISTINCT lower(principal)) AS unique_active_users,"
        " min(day) AS first_active_date, max(day) AS last_active_date"
        " FROM ev e LEFT JOIN dir d ON e.agent = d.agent_id"
        f" WHERE event_type IN ('view', 'click') AND agent NOT IN {_SYSTEM} GROUP BY 1, 2, 3"
    )
    sql["r5_engine_adoption"] = (
        _with(_EVENTS)
        + "SELECT COALESCE(spiffe_engine, path_engine, 'default_engine') AS engine_id,"
        " count(DISTINCT lower(principal)) AS total_active_users, count(*) AS total_turns,"
        " min(day) AS first_active_date, max(day) AS last_active_date"
        " FROM ev WHERE event_type IN ('view', 'click') AND principal IS NOT NULL GROUP BY 1"
    )
    sql.update(_view_examples())
    sql.update(_reshaping())
    sql.update(_upkeep())
    sql.update(_sources())
    sql.update(_questions())
    sql.update(_streams())
    sql.update(_checks())
    sql.update(_jobs())
    sql.update(_kept_up(sql))
    return sql


def _branches(opened: bool) -> str:
    """Audit events in eleven shapes (event_id % 11); text inside of a payload is looked into if ``opened``."""
    text = "b = 4" if opened else "FALSE"
    listed = "b IN (2, 9)" if opened else "b = 2"
    return _with(_EVENTS) + f"""SELECT principal AS user_email, day AS activity_date,
        assist AND (core = 'true' OR NOT target) AS is_chat, assist AND target AND id NOT IN {_SYSTEM} AS is_agent,
        CASE WHEN b IN (5, 6) THEN TRUE WHEN b <> 8 THEN FALSE END AS is_nblm,
        CASE WHEN id IN {_SYSTEM} THEN NULL ELSE id END AS agent_id
      FROM (SELECT *, direct IS NOT NULL OR b = 10 AS target, coalesce(direct, CASE WHEN {listed} THEN agent END) AS id FROM (
        SELECT *, CASE WHEN b IN (1, 3, 5, 6, 7, 8) OR {text} THEN agent END AS direct,
          CASE WHEN b = 0 THEN CASE WHEN k < 10 THEN 'true' ELSE 'false' END END AS core,
          CASE WHEN b IN (5, 6) THEN FALSE WHEN b NOT IN (7, 8) THEN TRUE END AS assist
        FROM (SELECT *, event_id % 11 AS b FROM ev) WHERE event_type IN ('error', 'signup') AND principal IS NOT NULL))"""


def _kept_up(sql: dict[str, str]) -> dict[str, str]:
    """Queries that answer an earlier question in another way have its SQL."""
    same = {
        "v2_daily_ledger": "v2_user_ledger",
        "v3_daily_adoption": "v3_adoption_summary",
        "v2_bucketed_ledger": "v2_user_ledger",
        "n5_bucketed_users": "n5_feature_users",
        "n1_sql_dau_trend": "n1_dau_trend",
        "n2_bitmap_weekly": "n2_adoption_weekly",
        "n2_bitmap_monthly": "n2_adoption_monthly",
        "n3_bitmap_power_users": "n3_power_users",
        "n3_sql_power_users": "n3_power_users",
        "n11_sql_top_agents": "n11_top_agents",
        "n13_sql_agents_on_day": "n13_distinct_agents_on_day",
        "j2_nightly_names": "m2_reconcile",
        "m4_strict_upsert": "m1_upsert",
        "j1_variant_backfill": "j1_backfill",
        "t11_variant_events": "t11_normalized_events",
    }
    # every window is put together from single events
    windows = (
        "windows AS (SELECT d.day AS activity_date, user_email, is_chat, is_agent, is_nblm, agent_id FROM norm n"
        " JOIN (SELECT DISTINCT activity_date AS day FROM norm) d"
        " ON n.activity_date <= d.day AND n.activity_date > d.day - INTERVAL 7 DAY)"
    )
    return {
        **{name: sql[other] for name, other in same.items()},
        "t11_audit_branches": _branches(opened=False),
        "t11_embedded_requests": _branches(opened=True),
        "t11_variant_branches": _branches(opened=True),
        "s2_variant_scan": _with(_EVENTS)
        + "SELECT ts AS timestamp, CAST(event_id AS VARCHAR) AS \"insertId\", 'google.cloud.discoveryengine.v1.'"
        " || CASE WHEN event_type = 'error' THEN 'NotebookService.GetNotebook' ELSE 'AssistantService.StreamAssist' END AS method_name,"
        " principal, NULL::VARCHAR AS via, NULL::VARCHAR AS response, NULL::VARCHAR AS details, NULL::VARCHAR AS granted,"
        " CASE WHEN k % 3 <> 0 THEN '{\"@type\":\"type.example.com/Assist\",\"agent_info\":{'"
        " || coalesce('\"agent\":\"' || agent || '\",', '') || '\"core_assistant\":' || (k < 10) || '}}' END AS request_json,"
        " CASE WHEN event_type = 'error' THEN '5' END AS status_code, 'run' AS permission, 'm' AS kind, CAST(k AS VARCHAR) AS k"
        " FROM ev WHERE event_type IN ('error', 'signup') AND ts >= DATE '2024-01-31' - INTERVAL 10 DAY AND ts < DATE '2024-02-01'",
        "n5_sql_feature_users": f"SELECT user_email, active_days, notebooklm_days AS feature_days FROM ({sql['n5_feature_users']})",
        "a3_rolling_week": _with(_EVENTS, _NORMALIZED, windows, _adoption().replace("FROM norm", "FROM windows")) + "SELECT * FROM summary",
    }


def _view_examples() -> dict[str, str]:
    return {
        "r4_governance": _with(_DIRECTORY, _CREATORS) + "SELECT * FROM attribution",
        "b1_adoption_latest": _SUMMARY
        + "SELECT time_period, total_active_users, chat_users, chat_pct, notebooklm_users, notebooklm_pct,"
        " agent_users, agent_pct, distinct_agents_used, chat_and_notebooklm_pct, chat_and_agents_pct,"
        " notebooklm_and_agents_pct, all_three_pct FROM summary ORDER BY time_period DESC LIMIT 30",
        "b2_user_active_days": _with(_EVENTS, _NORMALIZED, _LEDGER)
        + "SELECT user_email, count(DISTINCT activity_date) AS total_active_days,"
        " count(*) FILTER (WHERE used_chat) AS chat_active_days,"
        " count(*) FILTER (WHERE used_notebooklm) AS notebooklm_active_days,"
        " count(*) FILTER (WHERE used_agents) AS agent_active_days FROM ledger GROUP BY user_email",
        "b3_leaderboard_by_name": _with(_DIRECTORY, _LEADERBOARD)
        + "SELECT display_name, CAST(sum(total_sessions) AS BIGINT) AS total_sessions,"
        " max(monthly_users) AS monthly_users FROM leaderboard GROUP BY display_name",
    }


# who created what, from the columns the sample entries are made of
_CREATIONS = """
creations AS (
  SELECT o_orderkey, o_orderdate AS timestamp,
    CASE WHEN o_orderkey % 3 <> 0 OR o_orderkey % 6 <> 0
         THEN 'maker' || (o_custkey % 97) || '@example.com' ELSE 'unknown_email' END AS creator_email,
    CASE WHEN o_orderkey % 7 <= 3 THEN CAST(o_custkey AS VARCHAR) ELSE 'unknown_id' END AS agent_id,
    CASE WHEN o_orderkey % 7 <= 2 THEN 'engine-' || (o_custkey % 4)
         WHEN o_orderkey % 7 = 3 THEN 'agents' ELSE 'default_engine' END AS engine_id,
    CASE o_orderkey % 4 WHEN 0 THEN 'Request ' || o_custkey WHEN 1 THEN 'Response ' || o_custkey
         ELSE 'Unknown Name' END AS display_name
  FROM orders
)"""

_AUDIT_TEXT = """
audit_text AS (
  SELECT event_id, ts, day,
    '{"serviceName":"discoveryengine.googleapis.com","methodName":"google.cloud.discoveryengine.v1.'
    || CASE WHEN event_type = 'error' THEN 'NotebookService.GetNotebook' ELSE 'AssistantService.StreamAssist' END
    || '","authenticationInfo":{' || coalesce('"principalEmail":"' || principal || '"', '') || '}' AS head,
    CASE WHEN k % 3 <> 0 THEN
      ',"requestJson":"{\\"@type\\":\\"type.example.com/Assist\\",\\"agent_info\\":{\\"core_assistant\\":'
      || CASE WHEN k < 10 THEN 'true' ELSE 'false' END
      || coalesce(',\\"agent\\":\\"' || agent || '\\"', '') || '}}"' ELSE '' END AS request,
    CASE WHEN event_type = 'error' THEN ',"status":{"code":5,"message":"not found"}' ELSE '' END AS status,
    CASE WHEN k % 3 <> 0 THEN
      ',"requestJson":"{\\"@type\\":\\"type.example.com/Assist\\",\\"agent_info\\":{'
      || coalesce('\\"agent\\":\\"' || agent || '\\",', '') || '\\"core_assistant\\":'
      || CASE WHEN k < 10 THEN 'true' ELSE 'false' END || '}}"' ELSE '' END AS sorted_request,
    ',"authorizationInfo":[{"permission":"run"}]' AS grants,
    ',"metadata":{"k":' || k || ',"kind":"m"}' AS more
  FROM ev WHERE event_type IN ('error', 'signup')
)"""

_ACTIVITY_TEXT = """
activity_text AS (
  SELECT event_id, ts, day, '{' || concat_ws(',',
      '"userIamPrincipal":"' || principal || '"',
      '"request":{"agentsSpec":{"agentSpecs":[{"agentId":"' || agent || '"}]}}',
      CASE WHEN resp IS NOT NULL OR spiffe_engine IS NOT NULL THEN
        '"response":{"agentInfo":{' || concat_ws(',', '"agent":"' || resp || '"',
          '"displayName":"' || resp_name || '"') || '}}' END) || '}' AS payload
  FROM ev WHERE event_type IN ('view', 'click')
)"""

_DEFINITIONS = """
docs AS (
  SELECT *, c_mktsegment IN ('BUILDING', 'FURNITURE') AS low_code,
    c_custkey % 2 = 0 AS even, c_custkey % 6 = 0 AS first_is_root,
    CASE WHEN c_custkey % 19 = 3 THEN 'default_assistant' ELSE CAST(c_custkey AS VARCHAR) END AS agent_id,
    CASE WHEN c_custkey % 3 <> 0 THEN 'Helper ' || c_custkey ELSE 'Sub-Agent' END AS first_label
  FROM customer WHERE c_custkey % 17 <> 5
),
flattened AS (
  SELECT agent_id,
    CASE WHEN c_custkey % 10 < 7 THEN c_name WHEN c_custkey % 10 < 9 THEN 'Draft ' || c_name
         ELSE 'Unknown' END AS display_name,
    'engine-' || (c_custkey % 100) AS engine_id,
    CASE c_custkey % 3 WHEN 0 THEN 'Agent for ' || c_mktsegment WHEN 1 THEN 'Draft for ' || c_mktsegment
         ELSE '' END AS description,
    CASE
      WHEN low_code AND c_custkey % 4 <> 1 AND first_is_root THEN
        'Help' || chr(10) || chr(10) || chr(10) || 'Sub-Agent Instructions:' || chr(10)
        || concat_ws(chr(10), '[Root ' || c_custkey || '] You are ' || c_name,
             CASE WHEN c_custkey % 5 <> 0 THEN '[Checker ' || c_custkey || '] Check' END)
      WHEN low_code AND c_custkey % 4 <> 1 THEN
        'You are ' || c_name || chr(10) || chr(10)
        || CASE WHEN even OR c_custkey % 5 <> 0 THEN chr(10) || 'Sub-Agent Instructions:' || chr(10)
             || concat_ws(chr(10), CASE WHEN even THEN '[' || first_label || '] Help' END,
                  CASE WHEN c_custkey % 5 <> 0 THEN '[Checker ' || c_custkey || '] Check' END)
           ELSE '' END
      ELSE concat_ws(chr(10), CASE WHEN even THEN 'Rule for ' || c_name END, 'Be brief') END AS system_instructions,
    CASE c_mktsegment WHEN 'MACHINERY' THEN 'ADK Agent' WHEN 'AUTOMOBILE' THEN 'Managed Agent'
         WHEN 'HOUSEHOLD' THEN 'Unknown' ELSE 'Agent Builder (UI)' END AS agent_type,
    CASE WHEN NOT low_code OR c_custkey % 4 = 1 THEN ''
         WHEN first_is_root THEN 'Root ' || c_custkey || ', Checker ' || c_custkey
         ELSE first_label || ', Checker ' || c_custkey END AS sub_agents
  FROM docs
),
light AS (
  SELECT agent_id, CASE WHEN c_custkey % 10 < 7 THEN c_name ELSE '' END AS display_name,
    CASE c_mktsegment WHEN 'MACHINERY' THEN 'ADK Agent' WHEN 'AUTOMOBILE' THEN 'Managed Agent'
         ELSE 'Agent Designer' END AS agent_type,
    CASE WHEN c_custkey % 3 = 0 THEN 'Agent for ' || c_mktsegment ELSE '' END AS description,
    CASE WHEN low_code AND (NOT even OR c_custkey % 4 = 0) THEN 'You are ' || c_name
         ELSE '' END AS system_instructions
  FROM docs WHERE agent_id <> 'default_assistant'
)"""

_STORES = f"""
listed AS (
  SELECT s_suppkey, p.pos, 'ds-' || CASE p.pos WHEN 1 THEN s_suppkey + 2 WHEN 2 THEN s_suppkey * 7
    WHEN 3 THEN s_suppkey ELSE s_suppkey + 1 END AS id
  FROM supplier CROSS JOIN (VALUES (1), (2), (3), (4)) AS p(pos)
  WHERE s_suppkey % 11 <> 0 AND p.pos <= s_suppkey % 5
),
known AS (SELECT CASE WHEN s_suppkey % 5 = 0 THEN 'old-' ELSE 'ds-' END || s_suppkey AS id, s_name FROM supplier),
stores AS (
  SELECT '{_PREFIX}engines/' || CASE WHEN s.s_suppkey % 6 = 5 THEN 'retired-' ELSE 'engine-' END
      || s.s_suppkey AS engine_name,
    coalesce(string_agg(l.id, ',' ORDER BY l.pos), '') AS datastore_ids,
    coalesce(string_agg(coalesce(n.s_name, l.id), ',' ORDER BY l.pos), '') AS datastore_names
  FROM supplier s LEFT JOIN listed l ON s.s_suppkey = l.s_suppkey LEFT JOIN known n ON l.id = n.id
  GROUP BY 1
)"""

_LOG = "ts AS timestamp, CAST(event_id AS VARCHAR) AS \"insertId\", 'INFO' AS severity"


def _reshaping() -> dict[str, str]:
    return {
        "t1_creators": _with(_CREATIONS) + "SELECT * EXCLUDE (o_orderkey) FROM creations",
        "t2_audit_reshape": _with(_EVENTS, _AUDIT_TEXT)
        + f"SELECT {_LOG}, 'projects/p1/logs/cloudaudit.googleapis.com%2Fdata_access' AS \"logName\","
        " head || request || status || grants || more || '}' AS protopayload_auditlog FROM audit_text",
        "t3_activity_projection": _with(_EVENTS, _ACTIVITY_TEXT)
        + f"SELECT {_LOG}, 'projects/p1/logs/discoveryengine.googleapis.com%2Fgemini_enterprise_user_activity'"
        " AS \"logName\", payload AS \"jsonPayload\" FROM activity_text",
        "t4_definitions": _with(_DEFINITIONS)
        + "SELECT *, '' AS datastore_ids, '' AS datastore_names FROM flattened",
        "t5_definitions_light": _with(_DEFINITIONS) + "SELECT * FROM light",
        "t6_datastores": _with(_STORES) + "SELECT engine_name, datastore_ids, datastore_names FROM stores",
        "t7_agent_listing": _with(_DEFINITIONS)
        + "SELECT agent_id, 'engine-' || (c_custkey % 100) AS engine_id FROM docs"
        " WHERE c_custkey % 100 IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 6 <> 5)",
        "t8_name_harvest": _with(_EVENTS)
        + "SELECT DISTINCT agent AS agent_id, resp_name AS display_name, 'Agent Designer' AS agent_type FROM ev"
        f" WHERE event_type IN ('view', 'click') AND resp_name IS NOT NULL AND agent NOT IN {_SYSTEM}",
        "t11_normalized_events": _with(_EVENTS, _NORMALIZED) + "SELECT * FROM norm",
        "t12_base_events": _with(_EVENTS, _BASE) + "SELECT * FROM norm",
    }


_DIRECTORY_COLUMNS = (
    "agent_id display_name engine_id description system_instructions datastore_ids datastore_names"
    " agent_type sub_agents"
).split()


def _merged(source: str, columns: list[str], condition: str = "TRUE") -> str:
    """Upsert of ``source`` into the directory as a full join."""
    parts = ["coalesce(d.agent_id, s.agent_id) AS agent_id"]
    for name in _DIRECTORY_COLUMNS[1:]:
        if name in columns:
            applies = f"s.agent_id IS NOT NULL AND (d.agent_id IS NULL OR {condition})"
            parts.append(f"CASE WHEN {applies} THEN s.{name} ELSE d.{name} END AS {name}")
        else:
            parts.append(f"d.{name} AS {name}")
    return f"SELECT {', '.join(parts)} FROM dir d FULL JOIN {source} s ON d.agent_id = s.agent_id"


_LATEST = f"""
latest AS (
  SELECT agent AS agent_id, resp_name AS display_name, 'Agent Designer' AS agent_type FROM (
    SELECT *, row_number() OVER (PARTITION BY agent ORDER BY ts DESC, resp_name DESC) AS place FROM ev
    WHERE event_type IN ('view', 'click') AND resp_name IS NOT NULL AND agent NOT IN {_SYSTEM}
  ) WHERE place = 1
)"""
_PLACEHOLDER = "(d.display_name IS NULL OR d.display_name IN ('', 'My Agent', 'Unknown Name'))"


def _upkeep() -> dict[str, str]:
    descriptive = ["display_name", "agent_type", "description", "system_instructions"]
    return {
        "m1_upsert": _with(_DIRECTORY, _DEFINITIONS) + _merged("light", descriptive),
        "m2_reconcile": _with(_EVENTS, _DIRECTORY, _LATEST)
        + _merged("latest", ["display_name", "agent_type"], _PLACEHOLDER),
        "m3_replace": _with(_DEFINITIONS, _STORES)
        + "SELECT f.*, coalesce(s.datastore_ids, '') AS datastore_ids,"
        " coalesce(s.datastore_names, '') AS datastore_names"
        f" FROM flattened f LEFT JOIN stores s ON '{_PREFIX}engines/' || f.engine_id = s.engine_name",
    }


def _sources() -> dict[str, str]:
    return {
        "s1_log_scan_lookback": _with(_CREATIONS)
        + "SELECT * EXCLUDE (o_orderkey) FROM creations WHERE o_orderkey % 8 <> 0"
        " AND timestamp >= DATE '2001-08-02' - INTERVAL 365 DAY AND timestamp < DATE '2001-08-03'",
        "s2_audit_scan": _with(_EVENTS, _AUDIT_TEXT)
        # the declared payload schema puts the grants first, undeclared fields follow
        + "SELECT ts AS timestamp, CAST(event_id AS VARCHAR) AS \"insertId\","
        " head || grants || status || sorted_request || more || '}' AS protopayload_auditlog FROM audit_text"
        " WHERE day >= DATE '2024-01-21'",
        "s3_activity_scan": _with(_EVENTS, _ACTIVITY_TEXT)
        + "SELECT ts AS timestamp, CAST(event_id AS VARCHAR) AS \"insertId\", payload AS \"jsonPayload\""
        " FROM activity_text WHERE day >= DATE '2024-01-21'",
        "s6_bad_record_budget": _with(_EVENTS)
        + "SELECT CASE WHEN bit_count(event_id) <> 1 THEN day END AS event_date, count(*) AS records"
        " FROM ev WHERE event_type IN ('view', 'click') GROUP BY 1",
        "s8_inferred_updates": _with(_DEFINITIONS) + "SELECT * FROM light",
        "s9_metrics_append": "SELECT CAST(o_orderdate AS DATE) AS date,"
        f" CASE WHEN o_orderkey % 20 <> 0 THEN '{_PREFIX}engines/engine-' || (o_custkey % 4) || '/' ELSE '' END"
        " || 'assistants/default_assistant/agents/' || o_custkey AS agent_name,"
        " 1 + o_orderkey % 17 AS agent_session_count, o_orderkey % 50 AS monthly_agent_active_user_count"
        " FROM orders",
        "s10_sql_tables": _with(_EVENTS, _DIRECTORY)
        + "SELECT d.agent_type, count(*) AS turns, count(DISTINCT lower(principal)) AS users"
        " FROM ev JOIN dir d ON ev.agent = d.agent_id WHERE event_type IN ('view', 'click') GROUP BY 1",
        "s12_sql_views": _SUMMARY
        + "SELECT time_period, total_active_users, distinct_agents_used, chat_users AS chat_days FROM summary",
        "s13_day_partitions": _with(_EVENTS)
        + "SELECT day AS event_date, count(*) AS records FROM ev"
        " WHERE event_type IN ('error', 'signup') AND day >= DATE '2024-01-20' GROUP BY 1",
        "s14_engine_filter": "SELECT 'engine-' || (o_custkey % 4) AS engine_id, count(*) AS metric_rows,"
        " CAST(sum(1 + o_orderkey % 17) AS BIGINT) AS total_sessions FROM orders"
        " WHERE o_orderkey % 20 <> 0 AND o_custkey % 4 IN (1, 3) GROUP BY 1",
    }


def _questions() -> dict[str, str]:
    ledger = _with(_EVENTS, _NORMALIZED, _LEDGER)
    totals = (
        "SELECT user_email, count(*) AS active_days, count(*) FILTER (WHERE used_chat) AS chat_days,"
        " count(*) FILTER (WHERE used_notebooklm) AS notebooklm_days,"
        " count(*) FILTER (WHERE used_agents) AS agent_days FROM ledger GROUP BY user_email"
    )
    attribution = _with(_DIRECTORY, _CREATORS)
    leaderboard = _with(_DIRECTORY, _LEADERBOARD)
    bars = ", ".join(
        f"'[' || repeat('█', CAST(round({name}_pct * 20 / 100) AS INTEGER))"
        f" || repeat('░', 20 - CAST(round({name}_pct * 20 / 100) AS INTEGER)) || '] ' || {name}_pct || '%'"
        f" AS {name}_bar"
        for name in ("chat", "notebooklm", "agent")
    )
    periods = {
        grain: _with(_EVENTS, _NORMALIZED, _adoption(grain)) + "SELECT * FROM summary" for grain in ("week", "month")
    }
    return {
        "n1_dau_trend": ledger
        + "SELECT activity_date AS time_period, count(*) AS total_active_users FROM ledger"
        " WHERE activity_date > DATE '2024-01-17' AND activity_date <= DATE '2024-01-31' GROUP BY 1",
        "n2_adoption_weekly": periods["week"],
        "n2_adoption_monthly": periods["month"],
        "n3_power_users": ledger
        + "SELECT count(*) AS active_users, count(*) FILTER (WHERE a AND n) AS power_users,"
        " round(count(*) FILTER (WHERE a AND n) * CAST(100.0 AS DOUBLE) / count(*), 2) AS power_pct FROM ("
        "SELECT user_email, bool_or(used_agents) AS a, bool_or(used_notebooklm) AS n FROM ledger"
        " WHERE activity_date > DATE '2024-01-24' GROUP BY 1)",
        "n4_all_three_users": ledger
        + f"SELECT * FROM ({totals}) WHERE chat_days > 0 AND notebooklm_days > 0 AND agent_days > 0",
        "n5_feature_users": ledger + f"SELECT * FROM ({totals}) WHERE notebooklm_days > 0",
        "n6_exclusive_segments": ledger
        + "SELECT CASE WHEN c AND n AND a THEN 'chat+notebooks+agents' WHEN c AND n THEN 'chat+notebooks'"
        " WHEN c AND a THEN 'chat+agents' WHEN n AND a THEN 'notebooks+agents' WHEN c THEN 'chat only'"
        " WHEN n THEN 'notebooks only' WHEN a THEN 'agents only' ELSE 'none' END AS segment,"
        " count(*) AS users FROM (SELECT user_email, bool_or(used_chat) AS c, bool_or(used_notebooklm) AS n,"
        " bool_or(used_agents) AS a FROM ledger GROUP BY 1) GROUP BY 1",
        "n7_creator_agents": attribution
        + "SELECT creator_email, agent_id, display_name, min(creation_time) AS first_created"
        " FROM attribution GROUP BY 1, 2, 3",
        "n7_top_creators": attribution
        + "SELECT creator_email, count(DISTINCT agent_id) AS agents_created, count(*) AS creations,"
        " max(creation_time) AS last_created FROM attribution GROUP BY 1"
        " ORDER BY agents_created DESC, creations DESC, creator_email LIMIT 10",
        "n8_agents_by_architecture": _with(_DIRECTORY)
        + "SELECT CASE WHEN agent_type = 'Agent Designer' THEN 'Agent Builder (UI)' ELSE agent_type END"
        " AS agent_type_norm, count(*) AS agents FROM dir GROUP BY 1",
        "n9_agent_profile": attribution + "SELECT * FROM attribution WHERE display_name = 'Customer#000000009'",
        "n10_recent_agents": attribution
        + "SELECT * FROM attribution WHERE CAST(creation_time AS DATE) > DATE '2001-07-03'"
        " AND CAST(creation_time AS DATE) <= DATE '2001-08-02'",
        "n11_top_agents": leaderboard
        + "SELECT * FROM leaderboard ORDER BY total_sessions DESC, monthly_users DESC, agent_id, engine_id LIMIT 5",
        "n12_idle_agents": _with(_EVENTS, _DIRECTORY)
        + "SELECT agent_id, coalesce(nullif(display_name, ''), agent_id) AS display_name, agent_type FROM dir"
        " WHERE agent_id NOT IN (SELECT agent FROM ev WHERE event_type IN ('view', 'click')"
        f" AND agent NOT IN {_SYSTEM} AND day > DATE '2024-01-01')",
        "n13_distinct_agents_on_day": _with(_EVENTS, _NORMALIZED)
        + "SELECT count(DISTINCT agent_id) AS distinct_agents_used FROM norm WHERE activity_date = DATE '2024-01-30'",
        "n14_engine_sessions": leaderboard
        + "SELECT engine_id, count(DISTINCT agent_id) AS agents, CAST(sum(total_sessions) AS BIGINT)"
        " AS total_sessions, min(first_active_date) AS first_active_date, max(last_active_date)"
        " AS last_active_date FROM leaderboard GROUP BY 1",
        "n14_busiest_engine": _with(_EVENTS)
        + "SELECT COALESCE(spiffe_engine, path_engine, 'default_engine') AS engine_id,"
        " count(DISTINCT lower(principal)) AS total_active_users, count(*) AS total_turns,"
        " min(day) AS first_active_date, max(day) AS last_active_date"
        " FROM ev WHERE event_type IN ('view', 'click') AND principal IS NOT NULL GROUP BY 1"
        " ORDER BY total_active_users DESC, engine_id LIMIT 1",
        "n15_user_agent_history": _with(_EVENTS, _NORMALIZED, _DIRECTORY)
        + "SELECT n.user_email, n.agent_id, COALESCE(NULLIF(d.display_name, ''), n.agent_id) AS display_name,"
        " count(DISTINCT activity_date) AS active_days, min(activity_date) AS first_used,"
        " max(activity_date) AS last_used FROM norm n LEFT JOIN dir d ON n.agent_id = d.agent_id"
        " WHERE n.agent_id IS NOT NULL GROUP BY 1, 2, 3",
        "n16_adoption_bars": _SUMMARY + f"SELECT time_period, {bars} FROM summary",
    }


def _streams() -> dict[str, str]:
    routed = "routed AS (SELECT * FROM ev WHERE event_type NOT IN ('error', 'signup') OR event_id % 9 <> 0)"
    # audit calls of the admin log are landed, but no view reads them
    viewed = "routed AS (SELECT * FROM ev WHERE event_type NOT IN ('error', 'signup') OR event_id % 9 > 1)"
    from_routed = _NORMALIZED.replace("FROM ev ", "FROM routed ")
    landed = _with(_EVENTS, routed) + (
        "SELECT day AS event_date, count(*) AS records, CASE WHEN event_type IN ('error', 'signup')"
        " THEN CASE WHEN event_id % 9 = 1 THEN 'audit_other' ELSE 'audit_access' END"
        " WHEN event_type = 'purchase' THEN 'notebook_activity'"
        " ELSE 'assistant_activity' END AS landed_in FROM routed GROUP BY 1, 3"
    )
    return {
        "w1_stream_routing": landed,
        "w6_two_streams": landed,
        "w8_stream_dedup": landed,
        "w8_late_repeats": landed,
        "w7_view_follows_landing": _with(_EVENTS, viewed, from_routed, _adoption())
        + "SELECT time_period, total_active_users, distinct_agents_used, agent_pct FROM summary",
        "s15_typed_landing": _with(_EVENTS, viewed, from_routed)
        + "SELECT activity_date AS event_date, count(*) AS events, count(*) FILTER (WHERE is_chat) AS chats,"
        " count(*) FILTER (WHERE is_agent) AS agent_turns, count(*) FILTER (WHERE is_nblm) AS notebook_turns,"
        " count(DISTINCT agent_id) AS agents FROM norm GROUP BY 1",
        "w2_stream_creations": _with(_CREATIONS)
        + "SELECT c.timestamp, CASE WHEN engine_call THEN 'google.cloud.discoveryengine.v1.EngineService.CreateEngine'"
        " ELSE 'google.cloud.discoveryengine.v1main.AgentService.CreateAgent' END AS method_name,"
        " CASE WHEN o_orderkey % 7 = 3 THEN 'agents/' || agent_id END AS resource_name,"
        " CASE WHEN NOT engine_call THEN creator_email END AS creator_email,"
        " CASE WHEN NOT engine_call THEN agent_id END AS agent_id,"
        " CASE WHEN NOT engine_call THEN engine_id END AS engine_id,"
        " CASE WHEN NOT engine_call THEN display_name END AS display_name"
        " FROM (SELECT *, o_orderkey % 8 = 0 AS engine_call FROM creations) c",
        "w3_incremental_adoption": _with(_EVENTS, viewed, from_routed, _adoption()) + "SELECT * FROM summary",
        "w4_dedup": _with(_EVENTS)
        + "SELECT day AS event_date,"
        " count(*) + count(*) FILTER (WHERE event_id % 3 = 0 AND event_id % 10 = 1) AS records,"
        " count(*) FILTER (WHERE event_id % 3 = 0 AND event_id % 10 = 1) AS reduced"
        " FROM ev WHERE event_type IN ('view', 'click') GROUP BY 1",
        "w5_stream_names": _with(_EVENTS, _DIRECTORY, _LATEST)
        + _merged("latest", ["display_name", "agent_type"], _PLACEHOLDER),
    }


def _jobs() -> dict[str, str]:
    # a backfilled request is text, so an assistant call of the audit log names no agent
    backfilled = f"""
norm AS (
  SELECT principal AS user_email, day AS activity_date, event_type = 'signup' AS is_chat, FALSE AS is_agent,
    event_type = 'error' AS is_nblm, NULL AS agent_id
  FROM ev WHERE event_type IN ('error', 'signup') AND principal IS NOT NULL
  UNION ALL
  SELECT principal, day, resp IS NULL, resp IS NOT NULL AND resp NOT IN {_SYSTEM}, FALSE,
    CASE WHEN agent IN {_SYSTEM} THEN NULL ELSE agent END
  FROM ev WHERE event_type IN ('view', 'click') AND principal IS NOT NULL
)"""
    return {
        "j1_backfill": _with(_EVENTS, backfilled, _adoption()) + "SELECT * FROM summary",
        "j2_nightly": _with(_EVENTS, _DEFINITIONS)
        + "SELECT (SELECT count(*) FROM light) AS agents_synced, (SELECT count(DISTINCT agent) FROM ev"
        f" WHERE event_type IN ('view', 'click') AND resp_name IS NOT NULL AND agent NOT IN {_SYSTEM})"
        " AS names_reconciled, (SELECT count(*) FROM orders) AS metric_rows",
        "s4_empty_keeps_table": _with(_DIRECTORY) + "SELECT * FROM dir",
        "s6_rejected_lines": "SELECT 'activity_log' AS source, count(*) AS lines FROM events"
        " WHERE event_type IN ('view', 'click') AND bit_count(event_id) = 1",
        "s11_old_files": _with(_DIRECTORY)
        + "SELECT * REPLACE (CASE WHEN length(agent_id) % 2 = 0 THEN NULL ELSE sub_agents END AS sub_agents,"
        " CASE WHEN length(agent_id) % 2 = 0 THEN NULL ELSE datastore_ids END AS datastore_ids) FROM dir",
        "o5_newest": _with(_CREATIONS)
        + "SELECT * EXCLUDE (o_orderkey) FROM creations WHERE o_orderkey % 8 <> 0"
        " AND timestamp >= DATE '2001-08-02' - INTERVAL 365 DAY AND timestamp < DATE '2001-08-03'"
        " ORDER BY timestamp DESC, CAST(o_orderkey AS VARCHAR) LIMIT 25",
    }


def _checks() -> dict[str, str]:
    diffs = ", ".join(
        f"coalesce(s.{name}, 0) - coalesce(b.{name}, 0) AS {name}_diff"
        for name in ("total_active_users", "chat_users", "notebooklm_users", "agent_users")
    )
    base = _BASE.replace("norm AS (", "base_norm AS (")
    base_ledger = _LEDGER.replace("ledger AS (", "base_ledger AS (").replace("FROM norm", "FROM base_norm")
    return {
        "x1_duplicate_agents": _with(_DIRECTORY, _DEFINITIONS)
        + "SELECT agent_id, count(*) AS copies FROM (SELECT agent_id FROM dir UNION ALL SELECT agent_id FROM light)"
        " GROUP BY 1 HAVING count(*) > 1",
        "x3_view_recipe_diff": _with(_EVENTS, _NORMALIZED, _adoption(), base, base_ledger)
        + f"SELECT coalesce(s.time_period, b.activity_date) AS activity_date, {diffs} FROM summary s FULL JOIN ("
        f"SELECT activity_date, count(*) AS total_active_users, {_shares()} FROM base_ledger GROUP BY 1) b"
        " ON s.time_period = b.activity_date",
    }
