"""Log rows -> typed turns -> normalised events.

The parsing functions read each JSON document once and only the branches asked for. Their output,
written as Parquet by ``jobs.refresh_turns``, is the typed table the heavy queries should run on;
every consumer below accepts either that table or the raw log table.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from usagelens import constants as C
from usagelens.functions.columns import sql_in
from usagelens.functions.json_scalar import json_scalars

# fixed values: where the payloads keep what the queries need
ASSISTANT_PATHS = {
    "principal": "$.userIamPrincipal",
    "principal_alt": "$.useriamprincipal",
    "spec_value": "$.request.agentsSpec",
    "requested_agent": "$.request.agentsSpec.agentSpecs[0].agentId",
    "answering_agent": "$.response.agentInfo.agent",
    "agent_label": "$.response.agentInfo.displayName",
    "spiffe_path": "$.response.agentInfo.spiffeId",
    "assistant_path": "$.request.assistantsSpec.assistant",
}
NOTEBOOK_PATHS = {
    "principal": "$.userIamPrincipal",
    "principal_alt": "$.useriamprincipal",
    "service_label": "$.servicelabel",
    "method_name": "$.methodname",
}
_REQUEST_PATHS = {
    "core_assistant": "agent_info.core_assistant",
    "agent": "agent_info.agent",
    "spec_value": "agents_spec",
    "spec_agent": "agents_spec.agent_specs[0].agent_id",
}
AUDIT_PATHS = {
    "principal": "$.authenticationInfo.principalEmail",
    "service_name": "$.serviceName",
    "method_name": "$.methodName",
    **{f"request_{name}": f"$.request.{path}" for name, path in _REQUEST_PATHS.items()},
    **{f"embedded_{name}": f"$.requestJson.{path}" for name, path in _REQUEST_PATHS.items()},
}
_LOG_COLUMNS = ("timestamp", "logName", "insertId", "severity", "event_date")


def _turns(df: DataFrame, document: str, paths: dict[str, str], wanted: Sequence[str]) -> DataFrame:
    columns = set(df.columns)
    if columns.issuperset(wanted):
        return df
    keep = [name for name in _LOG_COLUMNS if name in columns]
    return json_scalars(df, document, {name: paths[name] for name in wanted}, keep)


def assistant_turns(df: DataFrame, wanted: Sequence[str] = tuple(ASSISTANT_PATHS)) -> DataFrame:
    return _turns(df, "jsonPayload", ASSISTANT_PATHS, wanted)


def notebook_turns(df: DataFrame, wanted: Sequence[str] = tuple(NOTEBOOK_PATHS)) -> DataFrame:
    return _turns(df, "jsonPayload", NOTEBOOK_PATHS, wanted)


def audit_turns(df: DataFrame, decode_embedded_json: bool = False) -> DataFrame:
    """Typed audit rows.

    A backfilled row carries its request as a JSON *string* in ``requestJson``; the paths below that
    string resolve to nothing unless ``decode_embedded_json`` parses it as well.
    """
    wanted = tuple(AUDIT_PATHS)
    if not decode_embedded_json or set(df.columns).issuperset(wanted):
        return _turns(df, "protopayload_auditlog", AUDIT_PATHS, wanted)
    keep = [name for name in _LOG_COLUMNS if name in df.columns]
    outer = json_scalars(
        df, "protopayload_auditlog", AUDIT_PATHS | {"embedded_text": "$.requestJson"}, keep
    )
    decoded = json_scalars(
        outer,
        "embedded_text",
        {f"decoded_{name}": f"$.{path}" for name, path in _REQUEST_PATHS.items()},
        [*keep, *wanted],
    )
    plain = [name for name in wanted if not name.startswith("embedded_")]
    filled = [
        f"coalesce(embedded_{name}, decoded_{name}) AS embedded_{name}" for name in _REQUEST_PATHS
    ]
    return decoded.selectExpr(*keep, *plain, *filled)


def activity_day(df: DataFrame) -> str:
    """SQL for the day; the landing partition where there is one, so that date ranges prune."""
    return "event_date" if "event_date" in df.columns else "to_date(timestamp)"


def _events(df: DataFrame, email: str, chat: str, agent: str, notebook: str, agent_id: str) -> DataFrame:
    return df.filter(f"{email} IS NOT NULL").selectExpr(
        f"{email} AS user_email",
        f"{activity_day(df)} AS activity_date",
        f"{chat} AS is_chat",
        f"{agent} AS is_agent",
        f"{notebook} AS is_nblm",
        f"{agent_id} AS agent_id",
    )


_SYSTEM = sql_in(C.SYSTEM_AGENTS)


def _custom_only(agent_id: str) -> str:
    return f"IF({agent_id} IN {_SYSTEM}, NULL, {agent_id})"


def _from_audit(df: DataFrame, decode_embedded_json: bool) -> DataFrame:
    agent = "coalesce(request_agent, embedded_agent)"
    spec = "coalesce(request_spec_value, embedded_spec_value)"
    core = "coalesce(request_core_assistant, embedded_core_assistant)"
    agent_id = "coalesce(request_agent, embedded_agent, request_spec_agent, embedded_spec_agent)"
    is_assistant = (
        f"service_name = '{C.SERVICE_NAME}' AND contains(method_name, '{C.ASSISTANT_METHOD_PART}')"
    )
    has_target = f"({agent} IS NOT NULL OR {spec} IS NOT NULL)"
    in_notebook = " OR ".join(f"contains(method_name, '{part}')" for part in C.NOTEBOOK_METHOD_PARTS)
    return _events(
        audit_turns(df, decode_embedded_json),
        email="principal",
        chat=f"({is_assistant} AND ({core} = 'true' OR NOT {has_target}))",
        agent=f"({is_assistant} AND {has_target} AND {agent_id} NOT IN {_SYSTEM})",
        notebook=f"(contains(logName, '{C.NOTEBOOK_LOG_PART}') OR {in_notebook})",
        agent_id=_custom_only(agent_id),
    )


def _from_assistant(df: DataFrame) -> DataFrame:
    # spec_value is NULL for an agentsSpec *object*, so a turn whose answer names no agent is chat
    has_target = "(spec_value IS NOT NULL OR answering_agent IS NOT NULL)"
    agent_id = "coalesce(answering_agent, requested_agent)"
    return _events(
        assistant_turns(df, ("principal", "spec_value", "requested_agent", "answering_agent")),
        email="principal",
        chat=f"NOT {has_target}",
        agent=f"({has_target} AND {agent_id} NOT IN {_SYSTEM})",
        notebook=f"contains(logName, '{C.NOTEBOOK_LOG_PART}')",
        agent_id=_custom_only(agent_id),
    )


def _from_notebook(df: DataFrame, email: str) -> DataFrame:
    return _events(
        notebook_turns(df, ("principal", "principal_alt")),
        email=email,
        chat="false",
        agent="false",
        notebook="true",
        agent_id="CAST(NULL AS STRING)",
    )


def normalize_events(
    audit: DataFrame, assistant: DataFrame, notebook: DataFrame, decode_embedded_json: bool = False
) -> DataFrame:
    """The three logs as one relation of user, day, three flags and custom agent id.

    Flags are three-valued on purpose; ``bool_or`` later ignores the NULLs.
    """
    return (
        _from_audit(audit, decode_embedded_json)
        .unionByName(_from_assistant(assistant))
        .unionByName(_from_notebook(notebook, "coalesce(principal, principal_alt)"))
    )


LOWER_EMAIL = "lower(coalesce(principal, principal_alt))"


def normalize_base_events(assistant: DataFrame, notebook: DataFrame) -> DataFrame:
    """Recipe view of the two activity logs: lower-cased email, chat or agent by requested agent."""
    is_agent = f"coalesce(requested_agent NOT IN {_SYSTEM}, false)"
    talk = _events(
        assistant_turns(assistant, ("principal", "principal_alt", "requested_agent")),
        email=LOWER_EMAIL,
        chat=f"NOT {is_agent}",
        agent=is_agent,
        notebook="false",
        agent_id="requested_agent",
    )
    return talk.unionByName(_from_notebook(notebook, LOWER_EMAIL))


def agent_turns(assistant: DataFrame) -> DataFrame:
    """Turns addressed to a custom agent; the user may be unknown."""
    turns = assistant_turns(assistant, ("principal", "principal_alt", "requested_agent"))
    return turns.filter(f"requested_agent NOT IN {_SYSTEM}").selectExpr(
        "requested_agent AS agent_id",
        f"{activity_day(turns)} AS interaction_date",
        f"{LOWER_EMAIL} AS user_email",
    )


def engine_turns(assistant: DataFrame) -> DataFrame:
    """Turns of known users with the engine that served them."""
    turns = assistant_turns(assistant, ("principal", "principal_alt", "spiffe_path", "assistant_path"))
    engines = ", ".join(
        f"nullif(regexp_extract({path}, 'engines/([^/]+)', 1), '')" for path in ("spiffe_path", "assistant_path")
    )
    return turns.filter(f"{LOWER_EMAIL} IS NOT NULL").selectExpr(
        f"coalesce({engines}, '{C.DEFAULT_ENGINE}') AS engine_id",
        f"{LOWER_EMAIL} AS user_email",
        f"{activity_day(turns)} AS activity_date",
    )
