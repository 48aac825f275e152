"""Continuous landing of log entries, and what is kept up to date behind it."""

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from usagelens import constants as C
from usagelens import schemas
from usagelens.operators.adoption import user_ledger
from usagelens.operators.dedup import without_stream_repeats
from usagelens.operators.directory import harvest_names
from usagelens.operators.routing import creation_events, route
from usagelens.operators.turns import normalize_events
from usagelens.plans.rollup import store_bitmaps
from usagelens.sources import entry_keys
from usagelens.sources.tables import Warehouse, has_condition

# a step after landing: warehouse, rows of the batch, the batch's load id
Step = Callable[[Warehouse, DataFrame, str], None]


def read_entries(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A stream of log entries from JSON lines that keep arriving in a folder."""
    reader = spark.readStream.schema(schemas.STREAM_ENTRY)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def _start(
    stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, once: bool, every: str
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The name under which a checkpoint's batches are landed, kept in the checkpoint itself.

    Streams with checkpoints of their own number their batches alike; the identity keeps them apart.
    """
    path = f"{checkpoint.rstrip('/')}/landing-identity"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException as error:
        if not has_condition(error, "PATH_NOT_FOUND"):
            raise
    identity = uuid.uuid4().hex[:16]
    spark.range(1).select(F.lit(identity).alias("value")).coalesce(1).write.text(path)
    return identity


def land_activity(
    entries: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    methods: Sequence[str] = C.STREAMED_METHODS,
    after_batch: Sequence[Step] = (),
    once: bool = False,
    every: str = "5 minutes",
    name: str = "stream",
    identity: str | None = None,
    typed: bool = True,
    repeats_within: str | None = None,
    only_new: bool = False,
) -> StreamingQuery:
    """Route entries to the log tables, each micro-batch in one partitioned write.

    The load id, a part of the partition, consists of ``name``, the checkpoint's identity and the batch
    number: a repeated batch overwrites its own files, and no other stream's. It is exactly-once without a
    transactional table format, next to loads by other jobs. After a *lost* checkpoint, give the new one
    the old ``identity`` to write the same batches again.

    With ``typed``, the normalised events of the batch are written under the same load id, so that views
    never parse payloads. ``after_batch`` steps run after that; each gives the same result when it is
    repeated. ``repeats_within`` drops repeated entries, see ``without_stream_repeats``. ``only_new`` drops
    entries that another load or batch has landed, however late they are, see ``entry_keys``.
    """
    identity = identity or stream_identity(warehouse.spark, checkpoint)

    def batch(rows: DataFrame, number: int) -> None:
        load_id = f"{name}-{identity}-{number}"
        if not (after_batch or typed or only_new):
            warehouse.append_logs(rows, load_id)
            return
        shared = entry_keys.unseen(warehouse, rows, load_id) if only_new else rows.persist()
        try:
            warehouse.append_logs(shared, load_id)
            if only_new:
                entry_keys.remember(warehouse, shared, load_id)
            for step in ((land_events,) if typed else ()) + tuple(after_batch):
                step(warehouse, shared, load_id)
        finally:
            shared.unpersist()

    if repeats_within is not None:
        entries = without_stream_repeats(entries, repeats_within)
    return _start(route(entries, methods), batch, checkpoint, once, every)


def land_creations(
    entries: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    once: bool = False,
    every: str = "5 minutes",
    name: str = "creations",
    identity: str | None = None,
) -> StreamingQuery:
    """Land engine and agent creations with their creator columns."""
    identity = identity or stream_identity(warehouse.spark, checkpoint)

    def batch(rows: DataFrame, number: int) -> None:
        warehouse.append(rows, "creation_events", f"{name}-{identity}-{number}")

    return _start(creation_events(entries), batch, checkpoint, once, every)


def batch_events(batch: DataFrame) -> DataFrame:
    """Normalised events of routed rows."""
    tables = ("audit_access", "assistant_activity", "notebook_activity")
    return normalize_events(*[batch.filter(F.col("table") == table) for table in tables])


def land_events(warehouse: Warehouse, batch: DataFrame, load_id: str) -> None:
    """The batch's normalised events."""
    warehouse.append(batch_events(batch).withColumnRenamed("activity_date", "event_date"), "usage_events", load_id)


def refresh_ledger(warehouse: Warehouse, batch: DataFrame, load_id: str) -> None:
    """The batch's own user ledger, as a part that readers fold with the others.

    Flags only ever turn on and agents are only ever added, so folding parts gives the ledger of all
    rows. Nothing is read back and nothing of another batch is rewritten: a late row costs one small
    file, and a batch lost halfway leaves the other parts as they were.
    """
    warehouse.append(user_ledger(batch_events(batch)), "user_ledger", load_id)


def refresh_bitmaps(warehouse: Warehouse, batch: DataFrame, load_id: str) -> None:
    """The batch's users and agents as day bitmaps; a late row adds a part to its own day only."""
    store_bitmaps(warehouse, batch_events(batch), load_id)


def refresh_names(warehouse: Warehouse, batch: DataFrame, load_id: str) -> None:
    """The names that the batch offers for agents, kept beside the directory until it is read."""
    names = harvest_names(batch.filter(F.col("table") == "assistant_activity"))
    warehouse.append(names, "agent_names_seen", load_id)
