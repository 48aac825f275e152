"""Log-shaped inputs derived from the given star-schema tables.

``events`` become the three activity logs, ``customer`` the agent directory and definitions,
``orders`` creations and session metrics, ``supplier`` engines with data stores. All of it is
computed by Spark, over whole tables, with payloads as JSON text.
"""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from usagelens import constants as C

COLLECTION = "projects/p1/locations/global/collections/default_collection/"
LOG_PREFIX = "projects/p1/logs/"

_ASSISTANT_PAYLOAD = """
    struct(
      principal AS userIamPrincipal,
      struct(
        IF(assistant_path IS NOT NULL, struct(assistant_path AS assistant), NULL) AS assistantsSpec,
        IF(agent IS NOT NULL, struct(array(struct(agent AS agentId)) AS agentSpecs), NULL) AS agentsSpec
      ) AS request,
      struct(
        IF(resp IS NOT NULL OR spiffe IS NOT NULL,
           struct(resp AS agent, resp_name AS displayName, spiffe AS spiffeId), NULL) AS agentInfo
      ) AS response)"""
_NOTEBOOK_PAYLOAD = "struct(principal AS useriamprincipal, 'NOTEBOOKLM_ENTERPRISE' AS servicelabel)"
_AUDIT_METHOD = f"IF(event_type = 'error', '{C.STREAMED_METHODS[3]}', '{C.STREAMED_METHODS[1]}')"
_IS_ASSISTANT = "event_type IN ('view', 'click')"
_IS_NOTEBOOK = "event_type = 'purchase'"
_IS_AUDIT = "event_type IN ('error', 'signup')"


def _audit_payload(method: str) -> str:
    return f"""
    struct(
      '{C.SERVICE_NAME}' AS serviceName,
      {method} AS methodName,
      struct(principal AS principalEmail) AS authenticationInfo,
      struct(struct(k < 10 AS core_assistant, agent AS agent) AS agent_info) AS request)"""


def _log_columns(log: str) -> list[str]:
    return [
        "timestamp",
        f"'{LOG_PREFIX}{log}' AS logName",
        "CAST(event_id AS STRING) AS insertId",
        "'INFO' AS severity",
    ]


@dataclass
class SampleLogs:
    """The inputs over one folder of tables; every property is a lazy DataFrame."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def flat_events(self) -> DataFrame:
        return (
            self.table("events")
            .selectExpr(
                "event_id",
                "user_id",
                "event_type",
                "CAST(ts AS TIMESTAMP) AS timestamp",
                "CAST(get_json_object(props, '$.k') AS INT) AS k",
            )
            .selectExpr(
                "*",
                """CASE WHEN k < 30 THEN NULL WHEN k < 35 THEN 'workflow_summary_agent'
                        WHEN k < 40 THEN 'default_assistant'
                        ELSE CAST((user_id * 7 + k) % 140 AS STRING) END AS agent""",
            )
            .selectExpr(
                "*",
                """CASE WHEN event_id % 13 = 0 THEN NULL
                        WHEN event_id % 5 = 0 THEN concat('USER', user_id, '@EXAMPLE.COM')
                        ELSE concat('user', user_id, '@example.com') END AS principal""",
                "IF(k % 2 = 0, agent, NULL) AS resp",
                """IF(k % 2 = 0, concat('Agent ', agent, IF(event_id % 50 = 0, ' v2', '')), NULL)
                   AS resp_name""",
                """IF(k % 6 = 0, concat('spiffe://x/engines/engine-', user_id % 4, '/agents/', agent), NULL)
                   AS spiffe""",
                f"""IF(k % 5 <> 0, concat('{COLLECTION}engines/engine-', user_id % 4,
                                          '/assistants/default_assistant'), NULL) AS assistant_path""",
            )
        )

    # ---- the three logs -------------------------------------------------------
    @property
    def assistant_activity(self) -> DataFrame:
        return self.flat_events.filter(_IS_ASSISTANT).selectExpr(
            *_log_columns(C.ASSISTANT_LOG), f"to_json({_ASSISTANT_PAYLOAD}) AS jsonPayload"
        )

    @property
    def notebook_activity(self) -> DataFrame:
        return self.flat_events.filter(_IS_NOTEBOOK).selectExpr(
            *_log_columns(C.NOTEBOOK_LOG), f"to_json({_NOTEBOOK_PAYLOAD}) AS jsonPayload"
        )

    @property
    def audit_access(self) -> DataFrame:
        return self.flat_events.filter(_IS_AUDIT).selectExpr(
            *_log_columns(C.AUDIT_DATA_LOG),
            f"to_json({_audit_payload(_AUDIT_METHOD)}) AS protopayload_auditlog",
        )

    @property
    def audit_branches(self) -> DataFrame:
        """Every audit event in one of eleven shapes, so that all branches of the audit parser occur.

        0 to 2 carry a request with a core flag, an agent, an agents spec; 3, 4 and 9 the same inside ``requestJson``, as
        object or text; 5 and 6 are source and audio calls; 7 and 8 lack service or method; 10 has a scalar spec.
        """
        named = "struct(struct(agent AS agent) AS agent_info)"
        listed = "struct(struct(array(struct(agent AS agent_id)) AS agent_specs) AS agents_spec)"
        shapes = [
            "struct(struct(k < 10 AS core_assistant) AS agent_info) AS request", f"{named} AS request", f"{listed} AS request",
            f"{named} AS requestJson", f"to_json({named}) AS requestJson", *[f"{named} AS request"] * 4,
            f"to_json({listed}) AS requestJson", "struct('legacy' AS agents_spec) AS request",
        ]
        calls = "google.cloud.discoveryengine.v1"
        common = f"""IF(b = 7, NULL, '{C.SERVICE_NAME}') AS serviceName,
          CASE b WHEN 5 THEN '{calls}.SourceService.CreateSource' WHEN 6 THEN '{calls}.AudioOverviewService.CreateAudioOverview'
                 WHEN 8 THEN NULL ELSE '{C.STREAMED_METHODS[1]}' END AS methodName,
          struct(principal AS principalEmail) AS authenticationInfo"""
        cases = " ".join(f"WHEN {b} THEN to_json(struct({common}, {shape}))" for b, shape in enumerate(shapes))
        payload = f"CASE b {cases} END"
        rows = self.flat_events.filter(_IS_AUDIT).selectExpr("*", "event_id % 11 AS b")
        return rows.selectExpr(*_log_columns(C.AUDIT_DATA_LOG), f"{payload} AS protopayload_auditlog")

    @property
    def stream_entries(self) -> DataFrame:
        """All logs as entries of one stream.

        Of nine audit entries, one calls an unrouted method and one comes from the admin log.
        """
        method = (
            "IF(event_id % 9 = 0, 'google.cloud.discoveryengine.v1.SourceService.CreateSource',"
            f" {_AUDIT_METHOD})"
        )
        return self.flat_events.selectExpr(
            "timestamp",
            f"""CASE WHEN {_IS_AUDIT} AND event_id % 9 = 1 THEN '{LOG_PREFIX}{C.AUDIT_ADMIN_LOG}'
                     WHEN {_IS_AUDIT} THEN '{LOG_PREFIX}{C.AUDIT_DATA_LOG}'
                     WHEN {_IS_NOTEBOOK} THEN '{LOG_PREFIX}{C.NOTEBOOK_LOG}'
                     ELSE '{LOG_PREFIX}{C.ASSISTANT_LOG}' END AS logName""",
            "CAST(event_id AS STRING) AS insertId",
            "'INFO' AS severity",
            f"""CASE WHEN {_IS_NOTEBOOK} THEN to_json({_NOTEBOOK_PAYLOAD})
                     WHEN {_IS_ASSISTANT} THEN to_json({_ASSISTANT_PAYLOAD}) END AS jsonPayload""",
            f"IF({_IS_AUDIT}, to_json({_audit_payload(method)}), NULL) AS protoPayload",
        )

    # ---- dimension tables -----------------------------------------------------
    @property
    def agent_directory(self) -> DataFrame:
        """One agent per customer; every eleventh has an id that no log mentions."""
        return self.table("customer").selectExpr(
            "IF(c_custkey % 11 = 0, concat('legacy-', c_custkey), CAST(c_custkey AS STRING)) AS agent_id",
            """CASE c_custkey % 10 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'My Agent'
                    WHEN 3 THEN 'Unknown Name' ELSE c_name END AS display_name""",
            """CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN NULL
                    ELSE concat('engine-', c_custkey % 4) END AS engine_id""",
            "concat('Agent for ', c_mktsegment) AS description",
            "concat('You are ', c_name) AS system_instructions",
            "'' AS datastore_ids",
            "'' AS datastore_names",
            f"""CASE c_mktsegment WHEN 'MACHINERY' THEN '{C.TYPE_CODE}'
                    WHEN 'BUILDING' THEN '{C.TYPE_BUILDER}' WHEN 'AUTOMOBILE' THEN '{C.TYPE_MANAGED}'
                    WHEN 'FURNITURE' THEN '{C.TYPE_DESIGNER}' ELSE '{C.TYPE_UNKNOWN}' END AS agent_type""",
            "'' AS sub_agents",
        )

    @property
    def agent_creators(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "CAST(o_orderdate AS TIMESTAMP) AS timestamp",
            "concat('maker', o_custkey % 97, '@example.com') AS creator_email",
            "CAST(o_custkey AS STRING) AS agent_id",
            "IF(o_orderkey % 3 = 0, '', concat('engine-', o_custkey % 4)) AS engine_id",
            "concat('Created ', o_custkey) AS display_name",
        )

    @property
    def session_metrics(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "to_date(o_orderdate) AS date",
            f"""concat(IF(o_orderkey % 20 = 0, '', concat('{COLLECTION}engines/engine-', o_custkey % 4, '/')),
                       'assistants/default_assistant/agents/', o_custkey) AS agent_name""",
            "1 + o_orderkey % 17 AS agent_session_count",
            "o_orderkey % 50 AS monthly_agent_active_user_count",
        )

    # ---- raw entries and documents ----------------------------------------------
    @property
    def creation_entries(self) -> DataFrame:
        """Creation audit entries with every fallback exercised, one per order."""
        path = (
            f"concat('{COLLECTION}engines/engine-', o_custkey % 4,"
            " '/assistants/default_assistant/agents/', o_custkey)"
        )
        return self.table("orders").selectExpr(
            "CAST(o_orderdate AS TIMESTAMP) AS timestamp",
            f"'{LOG_PREFIX}{C.AUDIT_ADMIN_LOG}' AS logName",
            "CAST(o_orderkey AS STRING) AS insertId",
            "'NOTICE' AS severity",
            f"""struct(
              '{C.SERVICE_NAME}' AS serviceName,
              IF(o_orderkey % 8 = 0, '{C.CREATE_ENGINE_METHOD}',
                 'google.cloud.discoveryengine.v1main.AgentService.CreateAgent') AS methodName,
              IF(o_orderkey % 7 = 3, concat('agents/', o_custkey), NULL) AS resourceName,
              struct(
                IF(o_orderkey % 3 <> 0, concat('maker', o_custkey % 97, '@example.com'), NULL)
                  AS principalEmail,
                IF(o_orderkey % 6 <> 0, concat('user:pool/people/maker', o_custkey % 97, '@example.com'), NULL)
                  AS principalSubject) AS authenticationInfo,
              struct(struct(
                IF(o_orderkey % 7 < 2, {path}, NULL) AS name,
                IF(o_orderkey % 4 = 0, concat('Request ', o_custkey), NULL) AS displayName) AS agent)
                AS request,
              struct(
                IF(o_orderkey % 7 = 2, {path}, NULL) AS name,
                IF(o_orderkey % 4 = 1, concat('Response ', o_custkey), NULL) AS displayName)
                AS response) AS protoPayload""",
        )

    @property
    def audit_entries(self) -> DataFrame:
        """Raw data-access entries with ``@`` keys, a response and status details that must go."""
        return self.flat_events.filter(_IS_AUDIT).selectExpr(
            *_log_columns(C.AUDIT_DATA_LOG),
            f"""struct(
              'type.example.com/AuditLog' AS `@type`,
              '{C.SERVICE_NAME}' AS serviceName,
              {_AUDIT_METHOD} AS methodName,
              struct(principal AS principalEmail, 'x' AS `@via`) AS authenticationInfo,
              IF(k % 3 <> 0, struct('type.example.com/Assist' AS `@type`,
                 struct(k < 10 AS core_assistant, agent AS agent) AS agent_info), NULL) AS request,
              struct(true AS ok) AS response,
              IF(event_type = 'error',
                 struct(5 AS code, 'not found' AS message, array('detail') AS details), NULL) AS status,
              array(struct('run' AS permission, 'y' AS `@grant`)) AS authorizationInfo,
              struct(k AS k, 'm' AS kind) AS metadata
            ) AS protoPayload""",
        )

    @property
    def activity_entries(self) -> DataFrame:
        """Raw user-activity entries, payload as a record with more branches than are kept."""
        return self.flat_events.filter(_IS_ASSISTANT).selectExpr(
            *_log_columns(C.ASSISTANT_LOG), f"{_ASSISTANT_PAYLOAD} AS jsonPayload"
        )

    @property
    def agent_definitions(self) -> DataFrame:
        """Agent documents in all variants, one per customer."""
        nodes = """array(
            struct('root_agent' AS id, concat('Root ', c_custkey) AS displayName,
                   struct(concat('You are ', c_name) AS instruction) AS llmAgentNode),
            struct('first' AS id, IF(c_custkey % 3 <> 0, concat('Helper ', c_custkey), NULL) AS displayName,
                   struct(IF(c_custkey % 2 = 0, 'Help', NULL) AS instruction) AS llmAgentNode),
            struct('second' AS id, concat('Checker ', c_custkey) AS displayName,
                   struct(IF(c_custkey % 5 <> 0, 'Check', NULL) AS instruction) AS llmAgentNode))"""
        engine = f"concat('{COLLECTION}engines/engine-', c_custkey % 100)"
        return (
            self.table("customer")
            .selectExpr("*", f"{nodes} AS node_list")
            .selectExpr(
                f"""IF(c_custkey % 17 = 5, '', concat({engine}, '/assistants/default_assistant/agents/',
                       IF(c_custkey % 19 = 3, 'default_assistant', CAST(c_custkey AS STRING)))) AS name""",
                "IF(c_custkey % 10 < 7, c_name, NULL) AS displayName",
                "IF(c_custkey % 10 < 9, concat('Draft ', c_name), NULL) AS draftDisplayName",
                "IF(c_custkey % 3 = 0, concat('Agent for ', c_mktsegment), NULL) AS description",
                "IF(c_custkey % 3 = 1, concat('Draft for ', c_mktsegment), NULL) AS draftDescription",
                "IF(c_mktsegment = 'MACHINERY', struct('x' AS raw), NULL) AS adkAgentDefinition",
                "IF(c_mktsegment = 'AUTOMOBILE', struct('x' AS raw), NULL) AS managedAgentDefinition",
                """IF(c_mktsegment IN ('BUILDING', 'FURNITURE'), struct(
                     CASE c_custkey % 4 WHEN 0 THEN node_list WHEN 1 THEN slice(node_list, 1, 0) END
                       AS deployedNodes,
                     IF(c_custkey % 4 = 2, node_list, NULL) AS draftAgents,
                     IF(c_custkey % 2 = 1, node_list, NULL) AS nodes,
                     IF(false, node_list, NULL) AS agents,
                     IF(c_custkey % 6 = 0, 'first', NULL) AS deployedRootAgentId,
                     CAST(NULL AS STRING) AS rootAgentId,
                     CAST(NULL AS STRING) AS draftRootAgentId), NULL) AS lowCodeAgentDefinition""",
                """struct(array(
                     struct(IF(c_custkey % 2 = 0, concat('Rule for ', c_name), NULL) AS instruction),
                     struct('' AS instruction),
                     struct('Be brief' AS instruction)) AS systemInstructions) AS instructions""",
                f"{engine} AS engine_name",
            )
        )

    @property
    def engines(self) -> DataFrame:
        """One engine per supplier, every sixth without agents, with up to four data stores."""
        return self.table("supplier").selectExpr(
            f"""concat('{COLLECTION}engines/', IF(s_suppkey % 6 = 5, 'retired-', 'engine-'), s_suppkey)
                AS name""",
            """IF(s_suppkey % 11 <> 0, slice(array(
                 concat('ds-', s_suppkey + 2), concat('ds-', s_suppkey * 7), concat('ds-', s_suppkey),
                 concat('ds-', s_suppkey + 1)), 1, CAST(s_suppkey % 5 AS INT)), NULL) AS dataStoreIds""",
        )

    @property
    def assistants(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            f"concat('{COLLECTION}engines/engine-', s_suppkey, '/assistants/default_assistant') AS name"
        )

    @property
    def data_stores(self) -> DataFrame:
        """One store per supplier; every fifth has an id that no engine lists."""
        return self.table("supplier").selectExpr(
            "concat(IF(s_suppkey % 5 = 0, 'old-', 'ds-'), s_suppkey) AS id", "s_name AS displayName"
        )
