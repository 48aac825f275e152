"""Raw log entries -> rows of the log and creator tables."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens import constants as C
from usagelens.functions.columns import last_segment, non_empty


def extract_creators(entries: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Who created which agent, from creation audit entries; ``keep`` passes more columns on."""
    payload = F.col("protoPayload")
    auth = payload["authenticationInfo"]
    subject = last_segment(F.regexp_replace(auth["principalSubject"], "^user:", ""))
    path = F.coalesce(
        payload["request"]["agent"]["name"], payload["response"]["name"], payload["resourceName"]
    )
    # an empty path has no segments at all; its id renders as the text "null"
    agent_id = (
        F.when(path.isNull(), F.lit(C.UNKNOWN_AGENT_ID))
        .when(path == "", F.lit("null"))
        .otherwise(last_segment(path))
    )
    # a path without an engines part yields its own first segment
    after_engines = F.substring_index(path, "/engines/", -1)
    engine = F.when(non_empty(after_engines).isNotNull(), F.substring_index(after_engines, "/", 1))
    return entries.select(
        "timestamp",
        *keep,
        F.coalesce(
            auth["principalEmail"], non_empty(subject), F.lit(C.UNKNOWN_EMAIL)
        ).alias("creator_email"),
        agent_id.alias("agent_id"),
        F.coalesce(engine, F.lit(C.DEFAULT_ENGINE)).alias("engine_id"),
        F.coalesce(
            payload["request"]["agent"]["displayName"],
            payload["response"]["displayName"],
            F.lit(C.UNKNOWN_AGENT_NAME),
        ).alias("display_name"),
    )


def without_keys(value: Column, data_type: T.DataType, prefix: str = "@") -> Column:
    """Rebuild a nested value without the object keys that start with ``prefix``, at any depth.

    The walk is over the *schema*; the data is touched by one projection.
    """
    if not _has_keys(data_type, prefix):
        return value
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda item: without_keys(item, data_type.elementType, prefix))
    if isinstance(data_type, T.MapType):
        kept = F.map_filter(value, lambda key, _: ~key.startswith(prefix))
        return F.transform_values(kept, lambda _, item: without_keys(item, data_type.valueType, prefix))
    fields = [
        without_keys(value.getField(f.name), f.dataType, prefix).alias(f.name)
        for f in data_type.fields
        if not f.name.startswith(prefix)
    ]
    rebuilt = F.struct(*fields) if fields else F.lit(None)
    return F.when(value.isNotNull(), rebuilt)


def _has_keys(data_type: T.DataType, prefix: str) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _has_keys(data_type.elementType, prefix)
    if isinstance(data_type, T.MapType):
        return True
    if isinstance(data_type, T.StructType):
        return any(f.name.startswith(prefix) or _has_keys(f.dataType, prefix) for f in data_type.fields)
    return False


def reshape_audit(entries: DataFrame) -> DataFrame:
    """Data-access entries as rows of ``audit_access``.

    ``request`` becomes the JSON string ``requestJson``, ``response`` and ``status.details`` are
    dropped, and so is every key that starts with ``@``. Works for any payload record: with the
    declared schema, or with one inferred by ``spark.read.json`` when all other fields are wanted.
    """
    payload_type = entries.schema["protoPayload"].dataType
    payload = F.col("protoPayload")
    parts = []
    for field in payload_type.fields:
        value, kind = payload.getField(field.name), field.dataType
        if field.name == "response" or field.name.startswith("@"):
            continue
        if field.name == "request":
            if isinstance(kind, T.VariantType):
                value = F.when(~F.is_variant_null(value), value)
            text = value if isinstance(kind, T.StringType) else F.to_json(value)
            parts.append(text.alias("requestJson"))
            continue
        if field.name == "status" and isinstance(kind, T.StructType) and "details" in kind.fieldNames():
            kind = T.StructType([f for f in kind.fields if f.name != "details"])
            value = F.when(value.isNotNull(), value.dropFields("details"))
        parts.append(without_keys(value, kind).alias(field.name))
    row = F.when(payload.isNotNull(), F.to_json(F.struct(*parts)))
    return entries.select(
        "timestamp", "logName", "insertId", "severity", row.alias("protopayload_auditlog")
    )


def project_activity(entries: DataFrame) -> DataFrame:
    """User-activity entries reduced to principal, requested agents and answering agent."""
    payload = F.col("jsonPayload")
    specs = payload["request"]["agentsSpec"]["agentSpecs"]
    spec = payload["request"]["agentsSpec"]
    info = payload["response"]["agentInfo"]
    slim = F.struct(
        payload["userIamPrincipal"].alias("userIamPrincipal"),
        F.when(
            spec.isNotNull(),
            F.struct(
                F.struct(
                    F.coalesce(
                        F.transform(specs, lambda s: F.struct(s["agentId"].alias("agentId"))), F.array()
                    ).alias("agentSpecs")
                ).alias("agentsSpec")
            ),
        ).alias("request"),
        F.when(
            info.isNotNull(),
            F.struct(
                F.struct(
                    info["agent"].alias("agent"), info["displayName"].alias("displayName")
                ).alias("agentInfo")
            ),
        ).alias("response"),
    )
    return entries.select(
        "timestamp", "logName", "insertId", "severity", F.to_json(slim).alias("jsonPayload")
    )
