"""Log scans, engine selection and landed files."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType, VariantType

from usagelens import constants as C
from usagelens import schemas
from usagelens.sources.tables import align_schema


def in_lookback(as_of: str, days: int = C.LOOKBACK_DAYS) -> Column:
    """``timestamp`` lies in the ``days`` days before the end of ``as_of``."""
    end = F.date_add(F.lit(as_of).cast("date"), 1).cast("timestamp")
    start = F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp")
    return (F.col("timestamp") >= start) & (F.col("timestamp") < end)


def newest(entries: DataFrame, cap: int | None) -> DataFrame:
    """The ``cap`` newest entries, or all of them (the default everywhere)."""
    if cap is None:
        return entries
    return entries.orderBy(F.desc("timestamp"), "insertId").limit(cap)


def select_creation_log(
    entries: DataFrame, as_of: str, lookback_days: int = C.LOOKBACK_DAYS, cap: int | None = None
) -> DataFrame:
    """Agent creations: admin-activity log, our service, method matching the creation pattern."""
    payload = F.col("protoPayload")
    return newest(
        entries.filter(
            F.col("logName").endswith(C.AUDIT_ADMIN_LOG)
            & (payload["serviceName"] == C.SERVICE_NAME)
            & payload["methodName"].rlike(C.CREATE_AGENT_PATTERN)
            & in_lookback(as_of, lookback_days)
        ),
        cap,
    )


def select_audit_log(
    entries: DataFrame, as_of: str, lookback_days: int = C.LOOKBACK_DAYS, cap: int | None = None
) -> DataFrame:
    """Data-access entries of our service; the payload is a record or a variant."""
    is_variant = isinstance(entries.schema["protoPayload"].dataType, VariantType)
    service = F.try_variant_get("protoPayload", "$.serviceName", "string") if is_variant else F.col("protoPayload")["serviceName"]
    return newest(
        entries.filter(
            F.col("logName").endswith(C.AUDIT_DATA_LOG)
            & (service == C.SERVICE_NAME)
            & in_lookback(as_of, lookback_days)
        ),
        cap,
    )


def select_activity_log(
    entries: DataFrame, as_of: str, lookback_days: int = C.LOOKBACK_DAYS, cap: int | None = None
) -> DataFrame:
    """Assistant activity entries."""
    return newest(
        entries.filter(F.col("logName").endswith(C.ASSISTANT_LOG) & in_lookback(as_of, lookback_days)),
        cap,
    )


def read_json(
    spark: SparkSession, path: str, schema: str | StructType | None, multi_line: bool = False
) -> DataFrame:
    """Landed JSON: one entry per line (splittable), or arrays with ``multi_line``.

    Without a schema Spark infers one, which costs a pass over the files.
    """
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_creation_log(spark: SparkSession, path: str, as_of: str, multi_line: bool = False, **limits):
    return select_creation_log(read_json(spark, path, schemas.CREATION_ENTRY, multi_line), as_of, **limits)


def audit_schema(spark: SparkSession, path: str, multi_line: bool = False) -> StructType:
    """Entry schema with every payload field that the files hold, declared or not.

    Declared fields come first and keep their types; what else occurs is inferred, in one pass over the
    files. ``request`` is read as a variant: it is passed on as text, in compact form.
    """
    declared = schemas.parsed(schemas.AUDIT_ENTRY)
    seen = read_json(spark, path, None, multi_line).schema
    payload = declared["protoPayload"].dataType
    if "protoPayload" in seen.fieldNames():
        payload = _widened(payload, seen["protoPayload"].dataType)
    fields = [StructField(f.name, VariantType()) if f.name == "request" else f for f in payload.fields]
    return StructType([StructField(f.name, StructType(fields)) if f.name == "protoPayload" else f for f in declared.fields])


def _widened(declared: DataType, seen: DataType) -> DataType:
    """The declared type plus the record fields that only the data has, at any depth."""
    if isinstance(declared, ArrayType) and isinstance(seen, ArrayType):
        return ArrayType(_widened(declared.elementType, seen.elementType))
    if not (isinstance(declared, StructType) and isinstance(seen, StructType)):
        return declared
    known = declared.fieldNames()
    found = {f.name: f for f in seen.fields}
    kept = [StructField(f.name, _widened(f.dataType, found[f.name].dataType) if f.name in found else f.dataType) for f in declared.fields]
    return StructType(kept + [f for f in seen.fields if f.name not in known])


def read_audit_log(
    spark: SparkSession,
    path: str,
    as_of: str,
    multi_line: bool = False,
    schema: str | StructType | None = None,
    **limits,
):
    """Without a schema the whole payload is read, see ``audit_schema``."""
    schema = audit_schema(spark, path, multi_line) if schema is None else schema
    return select_audit_log(read_json(spark, path, schema, multi_line), as_of, **limits)


def read_activity_log(spark: SparkSession, path: str, as_of: str, multi_line: bool = False, **limits):
    return select_activity_log(read_json(spark, path, schemas.ACTIVITY_ENTRY, multi_line), as_of, **limits)


def read_session_metrics(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    """Exported session metrics, JSON lines or Parquet."""
    return spark.read.schema(schemas.SESSION_METRICS).format(file_format).load(path)


def filter_engines(df: DataFrame, spec: str | None, engine: Column) -> DataFrame:
    """Keep the engines of a comma list; ``ALL``, ``AUTO``, ``*`` and an empty text keep everything.

    A list without any name in it is an error, not every engine.
    """
    text = (spec or "").strip()
    if not text or text.upper() in C.ALL_ENGINES:
        return df
    names = [name.strip() for name in text.split(",") if name.strip()]
    if not names:
        raise ValueError(f"no engine in {spec!r}")
    return df.filter(engine.isin(names))


def read_directory_updates(spark: SparkSession, path: str) -> DataFrame:
    """Directory updates from JSON lines of unknown shape: inferred, then aligned by name."""
    return align_schema(read_json(spark, path, None), schemas.DIRECTORY_UPDATE)
