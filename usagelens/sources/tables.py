"""Tables of the warehouse folder: appended logs, replaced snapshots, guarded loads."""

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from usagelens import constants as C
from usagelens import schemas
from usagelens.operators.adoption import ledger_events, user_ledger
from usagelens.operators.dedup import without_repeats
from usagelens.operators.directory import reconcile_names
from usagelens.session import scratch_path

_POINTERS = "table string, number bigint, version string"
_SEED = "seed"
_BAD = "_corrupt_record"


def align_schema(df: DataFrame, ddl: str) -> DataFrame:
    """Exactly the columns of the schema: missing ones are NULL, others are left out."""
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f'`{f.name}`' if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in schemas.parsed(ddl).fields
        ]
    )


class ConcurrentReplace(RuntimeError):
    """A table moved on while a new version of it was computed."""


def has_condition(error: AnalysisException, *conditions: str) -> bool:
    return (error.getCondition() or "").split(".")[0] in conditions


@dataclass(frozen=True)
class Warehouse:
    """A folder of Parquet tables.

    Logs and metrics grow by appends. Logs are partitioned by day and by the load or micro-batch
    that wrote them, so that repeating a load or a batch overwrites its own files and nothing else.
    The directory and the creators are replaced as a whole: a new version is written to its own
    folder and becomes current by a numbered pointer, so readers never see a half-written table and
    the version being read is never overwritten. Only one writer can take a number: a version that
    was computed from an older one than the current is not published.

    The ledger is kept as parts, one per load and day, which readers fold; harvested names likewise
    lie beside the directory and are resolved when it is read, always to the latest name.

    Dynamic partition overwrite needs an output committer that supports it. The default one does, on
    file systems with renames; on object stores, use a committer that stages there and allows it.
    """

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        root = self.root.rstrip("/")
        return f"{root}/logs/table={table}" if table in schemas.LOG_TABLES else f"{root}/{table}"

    def ensure_tables(self, *tables: str) -> None:
        """Create what is missing (of ``tables``, or of all but derived ones); existing tables are left alone."""
        base = [t for t in (*schemas.APPEND_TABLES, *schemas.SNAPSHOT_TABLES) if t not in schemas.DERIVED_TABLES]
        for table in tables or base:
            # an empty file per table carries its columns, so that SQL over the folder always resolves
            if table in schemas.SNAPSHOT_TABLES:
                self._write_new(self._empty(schemas.SNAPSHOT_TABLES[table]), f"{self.path(table)}/version={_SEED}")
                self._write_new(self._empty("version string"), f"{self._pointers(table)}/number=0")
                continue
            partitions = schemas.PARTITIONS[table]
            empty = self._empty(schemas.APPEND_TABLES[table]).drop(*partitions)
            named = ("load_id", "source", "consumer", "table")
            seed = "/".join(f"{p}={_SEED if p in named else '__HIVE_DEFAULT_PARTITION__'}" for p in partitions)
            self._write_new(empty, f"{self.path(table)}/{seed}")

    def _empty(self, schema: str) -> DataFrame:
        return align_schema(self.spark.range(0), schema)

    @staticmethod
    def _write_new(df: DataFrame, path: str) -> None:
        df.coalesce(1).write.mode("ignore").parquet(path)

    def _pointers(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/snapshot_pointers/table={table}"

    def append(self, df: DataFrame, table: str, load_id: str, gather: bool = True) -> None:
        """Add rows under a load id; a repeated load id replaces what it wrote on the same days.

        ``gather`` brings the rows of a day together before writing. Without it nothing is
        shuffled, which is the better choice for large exports in time order, whose tasks meet one
        or two days each.
        """
        if table in schemas.LOG_TABLES:
            self.append_logs(df.withColumn("table", F.lit(table)), load_id, gather)
            return
        partitions = schemas.PARTITIONS[table]
        rows = df.withColumn("load_id", F.lit(load_id))
        if "event_date" in schemas.APPEND_TABLES[table] and "event_date" not in rows.columns:
            rows = rows.withColumn("event_date", F.to_date("timestamp"))
        self._overwrite_partitions(
            align_schema(rows, schemas.APPEND_TABLES[table]), self.path(table), partitions, gather
        )

    def overwrite_days(self, df: DataFrame, table: str) -> None:
        """Rewrite the days that ``df`` has rows of; the other days of the table stay."""
        self._overwrite_partitions(align_schema(df, schemas.APPEND_TABLES[table]), self.path(table), ["activity_date"])

    def append_logs(self, df: DataFrame, load_id: str, gather: bool = True) -> None:
        """Add rows of several log tables, told apart by a ``table`` column, in one job."""
        rows = df.withColumns({"load_id": F.lit(load_id), "event_date": F.to_date("timestamp")})
        self._overwrite_partitions(
            align_schema(rows, schemas.LANDED_LOG),
            f"{self.root.rstrip('/')}/logs",
            ["table", "event_date", "load_id"],
            gather,
        )

    @staticmethod
    def _overwrite_partitions(df: DataFrame, path: str, partitions: list[str], gather: bool = True) -> None:
        # Gathered, a partition is written by one task instead of by all of them; the rebalance
        # splits a partition that is too large for one task.
        rows = df.hint("rebalance", *partitions) if gather else df
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partitions).parquet(path)

    def current(self, table: str) -> tuple[int, str | None]:
        """Number and folder name of the current version; (0, None) before the first one."""
        try:
            pointers = self.spark.read.schema("version string, number bigint").parquet(self._pointers(table))
            newest = pointers.agg(F.max_by("version", "number"), F.max("number")).first()
        except AnalysisException as error:
            if not has_condition(error, "PATH_NOT_FOUND"):
                raise
            return 0, None
        return newest[1] or 0, newest[0]

    def replace(self, df: DataFrame, table: str, base: int | None = None) -> str:
        """Write a new version of a snapshot table and make it current.

        ``base`` is the number of the version that ``df`` was computed from; if another one has become
        current since, nothing changes and ``ConcurrentReplace`` is raised.
        """
        base, version = self.current(table)[0] if base is None else base, uuid.uuid4().hex
        path = f"{self.path(table)}/version={version}"
        align_schema(df, schemas.SNAPSHOT_TABLES[table]).write.parquet(path)
        self._publish(table, version, base)
        return path

    def _publish(self, table: str, version: str, base: int) -> None:
        if self.current(table)[0] != base:
            raise ConcurrentReplace(f"{table} is not at version {base} any more")
        pointer = self.spark.range(1).select(F.lit(version).alias("version")).coalesce(1)
        try:
            pointer.write.mode("errorifexists").parquet(f"{self._pointers(table)}/number={base + 1}")
        except AnalysisException as error:
            if not has_condition(error, "PATH_ALREADY_EXISTS"):
                raise
            raise ConcurrentReplace(f"version {base + 1} of {table} was taken by another writer") from error

    def update(self, table: str, change: Callable[[DataFrame], DataFrame], attempts: int = 5) -> None:
        """Replace a snapshot by a function of its current version, again if another writer was faster."""
        for attempt in range(attempts):
            number, version = self.current(table)
            try:
                self.replace(change(self._version(table, version)), table, number)
                return
            except ConcurrentReplace:
                if attempt == attempts - 1:
                    raise

    def replace_if_any(self, df: DataFrame, table: str) -> bool:
        """Replace unless ``df`` is empty; then the table stays as it is.

        The rows are computed once: they are written first, and the written files tell whether there
        are any.
        """
        base, version = self.current(table)[0], uuid.uuid4().hex
        path = f"{self.path(table)}/version={version}"
        rows = align_schema(df, schemas.SNAPSHOT_TABLES[table])
        rows.write.parquet(path)
        if self.spark.read.schema(rows.schema).parquet(path).isEmpty():
            return False
        self._publish(table, version, base)
        return True

    def _version(self, table: str, version: str | None) -> DataFrame:
        schema = schemas.SNAPSHOT_TABLES[table]
        if version is None:
            return self._empty(schema)
        return self.spark.read.schema(schema).parquet(f"{self.path(table)}/version={version}")

    def read(self, table: str) -> DataFrame:
        """Current content; columns added to the schema since a file was written read as NULL."""
        if table in schemas.APPEND_TABLES:
            rows = self.parts(table).drop("load_id", "start")
            return user_ledger(ledger_events(rows)) if table == "user_ledger" else rows
        rows = self._version(table, self.current(table)[1])
        if table != "agent_directory":
            return rows
        try:
            names = self.parts("agent_names_seen").filter("agent_id IS NOT NULL")
        except AnalysisException as error:
            if not has_condition(error, "PATH_NOT_FOUND"):
                raise
            return rows
        return reconcile_names(rows, names.drop("load_id"))

    def parts(self, table: str) -> DataFrame:
        """An appended table as it was written, with the load of each row."""
        return self.spark.read.schema(schemas.APPEND_TABLES[table]).parquet(self.path(table))

    def read_once(self, table: str) -> DataFrame:
        """A log table without the copies that several loads have brought.

        Copies of an entry have its timestamp, hence its day; so only days that more than one load has
        written, and entries without a time, are aggregated. Finding them reads partition values, no payload.
        """
        rows = self.parts(table)
        payload = "protopayload_auditlog" if table.startswith("audit") else "jsonPayload"
        loads = rows.groupBy(F.col("event_date").alias("day")).agg(F.count_distinct("load_id").alias("loads"))
        shared = loads.filter("loads > 1 AND day IS NOT NULL").select("day")
        same, timeless = F.col("event_date") == F.col("day"), F.col("event_date").isNull()
        single = rows.filter(~timeless).join(shared, same, "left_anti")
        several = rows.filter(~timeless).join(shared, same, "left_semi").unionByName(rows.filter(timeless))
        return single.drop("load_id").unionByName(without_repeats(several.drop("load_id"), payload))

    def read_days(self, table: str, days: Sequence[date]) -> DataFrame:
        """Some days of a log table; only their folders are listed, however many there are."""
        schema = schemas.APPEND_TABLES[table]
        folders = "{" + ",".join(day.isoformat() for day in days) + "}"
        reader = self.spark.read.schema(schema).option("basePath", self.path(table))
        try:
            rows = reader.parquet(f"{self.path(table)}/event_date={folders}")
        except AnalysisException as error:
            if not has_condition(error, "PATH_NOT_FOUND"):
                raise
            rows = align_schema(self.spark.range(0), schema)  # nothing has landed on these days
        return rows.drop("load_id")

    def reject(self, lines: DataFrame, source: str, load_id: str) -> None:
        """Keep the malformed lines of a load (one text column)."""
        named = lines.select(F.col(lines.columns[0]).alias("line"), F.lit(source).alias("source"))
        self.append(named, "rejected_lines", load_id)

    def count_load(self, table: str, load_id: str) -> int:
        """Rows a load has written, counted from the file footers."""
        rows = self.spark.read.schema(schemas.APPEND_TABLES[table]).parquet(self.path(table))
        return rows.filter(F.col("load_id") == load_id).count()

    def read_all(self) -> dict[str, DataFrame]:
        """Every base table by name."""
        names = [*schemas.LOG_TABLES, "usage_events", "agent_session_metrics", *schemas.SNAPSHOT_TABLES]
        return {name: self.read(name) for name in names}


class TooManyBadRecords(RuntimeError):
    """A load met more malformed records than it may skip."""


def load_with_bad_budget(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    max_bad: int = C.BAD_RECORD_BUDGET,
    max_share: float = 0.0,
) -> tuple[DataFrame, DataFrame]:
    """JSON lines -> (good rows, malformed lines), or an error beyond the budget of malformed lines.

    The budget is ``max_bad`` lines or the share ``max_share`` of all lines, whichever is more. The
    lines are the caller's to keep, see ``Warehouse.reject``.

    The text is read once, into a staged Parquet copy in the shared scratch folder, and counted by that very
    write: a load beyond the budget is known before anything is published, and the caller loads the same
    copy, so count and rows agree even if files arrive or executors are lost in between.
    """
    good = schemas.parsed(schema) if isinstance(schema, str) else schema
    flagged = StructType([*good.fields, StructField(_BAD, StringType())])
    raw = (
        spark.read.schema(flagged)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD)
        .json(path)
    )
    staged_path = scratch_path(spark, "load")
    lines = Observation()
    raw.observe(lines, F.count("*").alias("all"), F.count(_BAD).alias("bad")).write.parquet(staged_path)
    staged = spark.read.schema(flagged).parquet(staged_path)
    bad = staged.filter(F.col(_BAD).isNotNull()).select(_BAD)
    bad_count = lines.get["bad"]
    if bad_count > max_bad and bad_count > max_share * lines.get["all"]:
        raise TooManyBadRecords(f"{bad_count} malformed records, allowed are {max_bad}: {path}")
    return staged.filter(F.col(_BAD).isNull()).drop(_BAD), bad
