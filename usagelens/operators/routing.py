"""Which log entries are landed, and where."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens import constants as C
from usagelens.functions.json_scalar import json_scalars
from usagelens.operators.reshape import extract_creators

_ENTRY = ("timestamp", "logName", "insertId", "severity", "jsonPayload", "protoPayload")


def _audit_call(df: DataFrame) -> DataFrame:
    paths = {"service_name": "$.serviceName", "method_name": "$.methodName"}
    return json_scalars(df, "protoPayload", paths, keep=_ENTRY)


def target_table(methods: Sequence[str] = C.STREAMED_METHODS) -> Column:
    """Table of an entry by its log; NULL for entries that are not landed.

    Matching audit calls are landed whatever log they come from; the views read those of the
    data-access log, the others keep their log name in a table of their own.
    """
    log = F.col("logName")
    is_call = (F.col("service_name") == C.SERVICE_NAME) & F.col("method_name").isin(*methods)
    return (
        F.when(log.endswith("/logs/" + C.ASSISTANT_LOG), "assistant_activity")
        .when(log.endswith("/logs/" + C.NOTEBOOK_LOG), "notebook_activity")
        .when(log.endswith("/logs/" + C.AUDIT_DATA_LOG) & is_call, "audit_access")
        .when(is_call, "audit_other")
    )


def route(entries: DataFrame, methods: Sequence[str] = C.STREAMED_METHODS) -> DataFrame:
    """Entries to be landed, in the shape of the shared log folder, with their ``table``."""
    return (
        _audit_call(entries)
        .withColumn("table", target_table(methods))
        .filter(F.col("table").isNotNull())
        .select(
            "timestamp",
            "logName",
            "insertId",
            "severity",
            "jsonPayload",
            F.col("protoPayload").alias("protopayload_auditlog"),
            "table",
        )
    )


def creation_events(entries: DataFrame) -> DataFrame:
    """Engine and agent creations, with the creator columns of agent creations."""
    paths = {
        "service_name": "$.serviceName",
        "method_name": "$.methodName",
        "resource_name": "$.resourceName",
        "email": "$.authenticationInfo.principalEmail",
        "subject": "$.authenticationInfo.principalSubject",
        "requested_name": "$.request.agent.name",
        "requested_label": "$.request.agent.displayName",
        "created_name": "$.response.name",
        "created_label": "$.response.displayName",
    }
    calls = json_scalars(entries, "protoPayload", paths, keep=("timestamp",))
    is_agent = F.col("method_name").rlike(C.CREATE_AGENT_PATTERN)
    kept = calls.filter(
        (F.col("service_name") == C.SERVICE_NAME)
        & ((F.col("method_name") == C.CREATE_ENGINE_METHOD) | is_agent)
    )
    payload = F.struct(
        F.col("resource_name").alias("resourceName"),
        F.struct(
            F.col("email").alias("principalEmail"), F.col("subject").alias("principalSubject")
        ).alias("authenticationInfo"),
        F.struct(
            F.struct(
                F.col("requested_name").alias("name"), F.col("requested_label").alias("displayName")
            ).alias("agent")
        ).alias("request"),
        F.struct(
            F.col("created_name").alias("name"), F.col("created_label").alias("displayName")
        ).alias("response"),
    )
    creators = ("creator_email", "agent_id", "engine_id", "display_name")
    shaped = kept.select(
        "timestamp", "method_name", "resource_name", payload.alias("protoPayload")
    )
    return extract_creators(shaped, keep=("method_name", "resource_name")).select(
        "timestamp",
        "method_name",
        "resource_name",
        *[F.when(is_agent, F.col(c)).alias(c) for c in creators],
    )
