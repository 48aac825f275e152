"""Log payloads as VARIANT: parsed once at landing, shredded in Parquet, read path by path.

Reading needs neither an inferred schema nor a declared payload: one pass keeps every field, whatever its type is in
which entry. Shredding gives fields that most rows of a file share columns of their own; Spark pushes the paths of a
query into the scan, so a query reads those columns and never the text.
"""

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.sources.tables import Warehouse

AUDIT_VARIANTS = "timestamp timestamp, logName string, insertId string, severity string, protoPayload variant"
ACTIVITY_VARIANTS = "timestamp timestamp, logName string, insertId string, severity string, jsonPayload variant"
DEPTH = 12  # levels of nesting at which keys are removed
_SHREDDING = "spark.sql.variant.writeShredding.enabled"
_OBJECT, _ARRAY = "map<string,variant>", "array<variant>"


@contextmanager
def shredded(spark: SparkSession):
    """Writes shred their variant columns, by a schema inferred from the rows of each file."""
    before = spark.conf.get(_SHREDDING, "false")
    spark.conf.set(_SHREDDING, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHREDDING, before)


def read_entries(spark: SparkSession, path: str, schema: str = AUDIT_VARIANTS) -> DataFrame:
    """Landed JSON lines with the payload as a variant."""
    return spark.read.schema(schema).json(path)


def _as(value: Column, kind: str) -> Column:
    """The variant as an object or array, NULL if it is something else."""
    return F.try_variant_get(value, "$", kind)


def _let(value: Column, body) -> Column:
    """``body`` of a value that it uses several times; the expression is built once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _without_keys(value: Column, prefix: str, depth: int) -> Column:
    if depth == 0:
        return value
    kept = F.map_filter(_as(value, _OBJECT), lambda key, _: ~key.startswith(prefix))

    def rebuilt(parts: Column) -> Column:
        # keys, or NULL for an array, and the values
        return F.when(
            parts["keys"].isNotNull(), F.to_variant_object(F.map_from_arrays(parts["keys"], parts["items"]))
        ).otherwise(F.to_variant_object(parts["items"]))

    def of(held: Column) -> Column:
        items = F.coalesce(F.map_values(held), _as(value, _ARRAY))
        cleaned = F.transform(items, lambda item: _without_keys(item, prefix, depth - 1))
        return F.when(items.isNull(), value).otherwise(_let(F.struct(F.map_keys(held).alias("keys"), cleaned.alias("items")), rebuilt))

    return _let(kept, of)


def without_keys(value: Column, prefix: str = "@", depth: int = DEPTH) -> Column:
    """A variant without the object keys that start with ``prefix``, down to ``depth`` levels.

    Values that hold no such key are passed on as they are.
    """
    return F.when(F.to_json(value).contains(f'"{prefix}'), _without_keys(value, prefix, depth)).otherwise(value)


def reshape_audit(entries: DataFrame) -> DataFrame:
    """Data-access entries as rows of the audit log with a variant payload.

    As in the text form: ``request`` becomes the JSON string ``requestJson``, ``response``, ``status.details`` and
    keys that start with ``@`` go. A payload that is not an object stays as it is.
    """
    payload = F.col("protoPayload")
    fields = F.map_filter(
        _as(payload, _OBJECT),
        lambda key, item: ~key.startswith("@") & (key != "response") & ~((key == "request") & F.is_variant_null(item)),
    )

    def field(key: Column, item: Column) -> Column:
        plain = F.map_filter(_as(item, _OBJECT), lambda name, _: name != "details")
        status = F.when(plain.isNotNull(), without_keys(F.to_variant_object(plain))).otherwise(item)
        return F.when(key == "request", F.to_json(item).cast("variant")).when(key == "status", status).otherwise(without_keys(item))

    named = F.transform_keys(
        F.transform_values(fields, field), lambda key, _: F.when(key == "request", F.lit("requestJson")).otherwise(key)
    )
    row = F.when(fields.isNotNull(), F.to_variant_object(named)).otherwise(payload)
    return entries.select("timestamp", "logName", "insertId", "severity", row.alias("protopayload_auditlog"))


def append(warehouse: Warehouse, rows: DataFrame, table: str, load_id: str) -> None:
    """Land rows of a log table with a variant payload; text payloads are parsed here, once.

    A text that is no JSON becomes a variant string, so nothing is lost.
    """
    name = payload_column(table)
    if dict(rows.dtypes)[name] == "string":
        rows = rows.withColumn(name, F.coalesce(F.try_parse_json(name), F.col(name).cast("variant")))
    rows = rows.withColumns({"payload": F.col(name), "table": F.lit(table), "event_date": F.to_date("timestamp")})
    with shredded(warehouse.spark):
        warehouse.append(rows, "log_variants", load_id)


def payload_column(table: str) -> str:
    return "protopayload_auditlog" if table.startswith("audit") else "jsonPayload"


def read(warehouse: Warehouse, table: str) -> DataFrame:
    """A log table as ``Warehouse.read`` gives it, but for the type of its payload."""
    rows = warehouse.parts("log_variants").filter(F.col("table") == table)
    return rows.withColumnRenamed("payload", payload_column(table)).drop("table", "load_id")

