"""Declared schemas of the tables and of the raw inputs, as DDL text."""

from functools import cache

from pyspark.sql import types as T


@cache
def parsed(ddl: str) -> T.StructType:
    """The DDL as a type; parsing needs a running session, hence not done at import."""
    return T.StructType.fromDDL(ddl)


# ---- tables ---------------------------------------------------------------
# fixed values: column and payload field names are those of the published logs and definitions
# Log payloads rest as JSON text; event_date and load_id are landing partitions.
_LOG = "timestamp timestamp, logName string, insertId string, severity string"
_LANDING = "event_date date, load_id string"
ASSISTANT_ACTIVITY = f"{_LOG}, jsonPayload string, {_LANDING}"
NOTEBOOK_ACTIVITY = ASSISTANT_ACTIVITY
AUDIT_ACCESS = f"{_LOG}, protopayload_auditlog string, {_LANDING}"
# normalised events, written with the load that brought them
USAGE_EVENTS = (
    "user_email string, is_chat boolean, is_agent boolean, is_nblm boolean, agent_id string,"
    f" {_LANDING}"
)
# names that the assistant log has offered for agents, one row per load and name
AGENT_NAMES_SEEN = (
    "agent_id string, display_name string, agent_type string, last_logged timestamp, load_id string"
)
REJECTED_LINES = "line string, source string, load_id string"
# all log tables share one landing folder, so that a mixed batch is one write
LANDED_LOG = (
    f"{_LOG}, jsonPayload string, protopayload_auditlog string, table string, {_LANDING}"
)
AGENT_DIRECTORY = (
    "agent_id string, display_name string, engine_id string, description string,"
    " system_instructions string, datastore_ids string, datastore_names string,"
    " agent_type string, sub_agents string"
)
AGENT_CREATORS = (
    "timestamp timestamp, creator_email string, agent_id string, engine_id string,"
    " display_name string"
)
SESSION_METRICS = (
    "date date, agent_name string, agent_session_count bigint,"
    " monthly_agent_active_user_count bigint"
)
DIRECTORY_UPDATE = (
    "agent_id string, display_name string, agent_type string, description string,"
    " system_instructions string"
)

CREATION_EVENTS = (
    "timestamp timestamp, method_name string, resource_name string, creator_email string,"
    " agent_id string, engine_id string, display_name string, event_date date, load_id string"
)
USER_LEDGER = (
    "user_email string, used_chat boolean, used_agents boolean, used_notebooklm boolean,"
    " agent_ids_used array<string>, activity_date date, load_id string"
)

# log entries with the payload as a variant, all log tables in one folder
LOG_VARIANTS = f"{_LOG}, payload variant, table string, {_LANDING}"
# identities of landed entries, and a filter of them
ENTRY_KEYS = f"low bigint, high bigint, {_LANDING}"
ENTRY_FILTERS = f"bucket bigint, bitmap binary, {_LANDING}"
# users and agents by number, and the days' bitmaps of those numbers
ENTITY_NUMBERS = "space string, value string, number bigint, start bigint"
USAGE_BITMAPS = "kind string, bucket bigint, bitmap binary, activity_date date, load_id string"
# landed parts that a consumer has worked in
CONSUMED_PARTS = "table string, event_date date, part string, consumer string, load_id string"
DAILY_LEDGER = (
    "user_email string, used_chat boolean, used_agents boolean, used_notebooklm boolean,"
    " agent_ids_used array<string>, activity_date date"
)
DAILY_ADOPTION = (
    "total_active_users bigint, chat_users bigint, chat_pct double, notebooklm_users bigint, notebooklm_pct double,"
    " agent_users bigint, agent_pct double, distinct_agents_used bigint,"
    " chat_and_notebooklm_users bigint, chat_and_notebooklm_pct double, chat_and_agents_users bigint,"
    " chat_and_agents_pct double, notebooklm_and_agents_users bigint, notebooklm_and_agents_pct double,"
    " all_three_users bigint, all_three_pct double, activity_date date"
)

LOG_TABLES = ("assistant_activity", "notebook_activity", "audit_access", "audit_other")
APPEND_TABLES = {
    "assistant_activity": ASSISTANT_ACTIVITY,
    "notebook_activity": NOTEBOOK_ACTIVITY,
    "audit_access": AUDIT_ACCESS,
    "audit_other": AUDIT_ACCESS,
    "usage_events": USAGE_EVENTS,
    "agent_names_seen": AGENT_NAMES_SEEN,
    "rejected_lines": REJECTED_LINES,
    "agent_session_metrics": f"{SESSION_METRICS}, load_id string",
    "creation_events": CREATION_EVENTS,
    "user_ledger": USER_LEDGER,
    "log_variants": LOG_VARIANTS,
    "entry_keys": ENTRY_KEYS,
    "entry_filters": ENTRY_FILTERS,
    "entity_numbers": ENTITY_NUMBERS,
    "usage_bitmaps": USAGE_BITMAPS,
    "consumed_parts": CONSUMED_PARTS,
    "daily_ledger": DAILY_LEDGER,
    "daily_adoption": DAILY_ADOPTION,
}
PARTITIONS = {
    "assistant_activity": ["event_date", "load_id"],
    "notebook_activity": ["event_date", "load_id"],
    "audit_access": ["event_date", "load_id"],
    "audit_other": ["event_date", "load_id"],
    "usage_events": ["event_date", "load_id"],
    "agent_names_seen": ["load_id"],
    "rejected_lines": ["source", "load_id"],
    "agent_session_metrics": ["load_id"],
    # creations are few per day; day folders would hold next to nothing
    "creation_events": ["load_id"],
    "user_ledger": ["activity_date", "load_id"],
    "log_variants": ["table", "event_date", "load_id"],
    "entry_keys": ["event_date", "load_id"],
    "entry_filters": ["event_date", "load_id"],
    "entity_numbers": ["start"],
    "usage_bitmaps": ["activity_date", "load_id"],
    "consumed_parts": ["consumer", "load_id"],
    "daily_ledger": ["activity_date"],
    "daily_adoption": ["activity_date"],
}
# kept up behind the landed tables, created when first used
DERIVED_TABLES = ("log_variants", "entry_keys", "entry_filters", "entity_numbers", "usage_bitmaps", "consumed_parts", "daily_ledger", "daily_adoption")
SNAPSHOT_TABLES = {
    "agent_directory": AGENT_DIRECTORY,
    "agent_creators": AGENT_CREATORS,
}

# ---- raw inputs -----------------------------------------------------------
# A nested object declared as string keeps its JSON text.
CREATION_ENTRY = (
    "timestamp timestamp, logName string, insertId string, severity string,"
    " protoPayload struct<"
    "serviceName:string, methodName:string, resourceName:string,"
    " authenticationInfo:struct<principalEmail:string, principalSubject:string>,"
    " request:struct<agent:struct<name:string, displayName:string>>,"
    " response:struct<name:string, displayName:string>>"
)
AUDIT_PAYLOAD_DDL = (
    "struct<serviceName:string, methodName:string, resourceName:string,"
    " authenticationInfo:struct<principalEmail:string, principalSubject:string,"
    " authoritySelector:string, serviceAccountKeyName:string>,"
    " authorizationInfo:array<struct<resource:string, permission:string, granted:boolean,"
    " permissionType:string>>,"
    " requestMetadata:struct<callerIp:string, callerSuppliedUserAgent:string,"
    " callerNetwork:string>,"
    " numResponseItems:string, status:struct<code:int, message:string, details:string>,"
    " request:string, response:string>"
)
AUDIT_ENTRY = f"{_LOG}, protoPayload {AUDIT_PAYLOAD_DDL}"
ACTIVITY_ENTRY = (
    f"{_LOG}, jsonPayload struct<userIamPrincipal:string,"
    " request:struct<agentsSpec:struct<agentSpecs:array<struct<agentId:string>>>>,"
    " response:struct<agentInfo:struct<agent:string, displayName:string>>>"
)
# One log entry as it arrives on the stream: either payload may be absent.
STREAM_ENTRY = f"{_LOG}, jsonPayload string, protoPayload string"

_NODES = "array<struct<id:string, displayName:string, llmAgentNode:struct<instruction:string>>>"
AGENT_DEFINITION = (
    "name string, displayName string, draftDisplayName string, description string,"
    " draftDescription string, adkAgentDefinition struct<raw:string>,"
    " managedAgentDefinition struct<raw:string>,"
    f" lowCodeAgentDefinition struct<deployedNodes:{_NODES}, draftAgents:{_NODES},"
    f" nodes:{_NODES}, agents:{_NODES},"
    " deployedRootAgentId:string, rootAgentId:string, draftRootAgentId:string>,"
    " instructions struct<systemInstructions:array<struct<instruction:string>>>"
)
AGENT_LISTING = "name string, displayName string, draftDisplayName string"
ENGINE = "name string, dataStoreIds array<string>"
ASSISTANT = "name string"
DATA_STORE = "id string, displayName string"
