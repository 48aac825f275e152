"""Fixed values that decide results. They are data, not logic."""

# fixed values: service, logs and methods the telemetry is recognised by
SERVICE_NAME = "discoveryengine.googleapis.com"
ASSISTANT_LOG = "discoveryengine.googleapis.com%2Fgemini_enterprise_user_activity"
NOTEBOOK_LOG = "discoveryengine.googleapis.com%2Fnotebooklm_enterprise_user_activity"
AUDIT_DATA_LOG = "cloudaudit.googleapis.com%2Fdata_access"
AUDIT_ADMIN_LOG = "cloudaudit.googleapis.com%2Factivity"
STREAMED_METHODS = (
    "google.cloud.discoveryengine.v1.AssistantService.Assist",
    "google.cloud.discoveryengine.v1.AssistantService.StreamAssist",
    "google.cloud.discoveryengine.v1.NotebookService.CreateNotebook",
    "google.cloud.discoveryengine.v1.NotebookService.GetNotebook",
    "google.cloud.discoveryengine.v1.NotebookService.InteractSources",
    "google.cloud.discoveryengine.v1.NotebookService.GenerateFreeFormStreamed",
)
CREATE_ENGINE_METHOD = "google.cloud.discoveryengine.v1.EngineService.CreateEngine"
CREATE_AGENT_PATTERN = "CreateAgent"
ASSISTANT_METHOD_PART = "AssistantService"
NOTEBOOK_METHOD_PARTS = ("NotebookService", "SourceService", "AudioOverviewService")
NOTEBOOK_LOG_PART = "notebooklm"

# fixed values: agents that belong to the product itself
SYSTEM_AGENTS = ("workflow_summary_agent", "default_assistant")

# fixed values: names that count as "not named yet" (next to NULL)
PLACEHOLDER_NAMES = ("", "My Agent", "Unknown Name")

# fixed values: defaults and labels
DEFAULT_ENGINE = "default_engine"
UNKNOWN_EMAIL = "unknown_email"
UNKNOWN_AGENT_ID = "unknown_id"
UNKNOWN_AGENT_NAME = "Unknown Name"
TYPE_CODE = "ADK Agent"
TYPE_BUILDER = "Agent Builder (UI)"
TYPE_MANAGED = "Managed Agent"
TYPE_DESIGNER = "Agent Designer"
TYPE_UNKNOWN = "Unknown"
UNKNOWN_DISPLAY_NAME = "Unknown"
DEFAULT_ROOT_NODE = "root_agent"
DEFAULT_NODE_NAME = "Sub-Agent"
SUB_AGENT_HEADING = "\nSub-Agent Instructions:\n"

# fixed values: engine specifications that mean "every engine"
ALL_ENGINES = ("ALL", "AUTO", "*")

# fixed values: operating limits
LOOKBACK_DAYS = 365
BAD_RECORD_BUDGET = 1000
ADOPTION_ROWS = 30

# fixed values: names under which the base tables are queried
TABLE_NAMES = {
    "assistant_activity": "discoveryengine_googleapis_com_gemini_enterprise_user_activity",
    "notebook_activity": "discoveryengine_googleapis_com_notebooklm_enterprise_user_activity",
    "audit_access": "cloudaudit_googleapis_com_data_access",
    "agent_directory": "agent_names",
    "agent_creators": "historical_creators",
    "agent_session_metrics": "agent_session_metrics",
}

# fixed values: names under which the views are queried
VIEW_NAMES = {
    "agent_leaderboard": "vw_unified_metrics",
    "user_ledger": "vw_user_feature_adoption",
    "adoption_summary": "vw_feature_adoption_summary",
    "creator_attribution": "vw_agent_creators",
}
