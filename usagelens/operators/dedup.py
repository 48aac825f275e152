"""Repeated log entries: a backfill appends over rows the stream has already written."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: what identifies a log entry
ENTRY_KEY = ["logName", "timestamp", "insertId"]


def without_repeats(logs: DataFrame, payload: str) -> DataFrame:
    """One row per log entry; entries without an insertId are all kept.

    Copies may differ (a backfilled payload is a reduced one), so the survivor is fixed: the longest
    payload, then the greatest text. One aggregation, combined map-side, and two reads of the log. A
    log that lies in day partitions needs it only on the days that several loads have written: see
    ``Warehouse.read_once``.
    """
    identified = logs.filter(F.col("insertId").isNotNull())
    anonymous = logs.filter(F.col("insertId").isNull())
    others = [c for c in logs.columns if c not in (*ENTRY_KEY, payload)]
    rank = F.struct(F.length(payload).alias("size"), payload, *others)
    kept = (
        identified.groupBy(*ENTRY_KEY)
        .agg(F.max(rank).alias("best"))
        .select(*ENTRY_KEY, *[F.col(f"best.{c}").alias(c) for c in (payload, *others)])
    )
    return kept.unionByName(anonymous)


def without_stream_repeats(logs: DataFrame, delay: str = "1 day") -> DataFrame:
    """The same on a stream: the first copy within ``delay`` of event time wins.

    State is freed once the watermark has passed an entry by ``delay``. The price: identified entries
    that arrive later than ``delay`` behind the newest one are dropped here. Where they must be kept,
    land everything and read the landed table through ``Warehouse.read_once``.
    """
    # one watermark for both branches: with one each, the slower (often empty) one would hold it back
    marked = logs.withWatermark("timestamp", delay)
    identified = marked.filter(F.col("insertId").isNotNull()).dropDuplicatesWithinWatermark(ENTRY_KEY)
    return identified.unionByName(marked.filter(F.col("insertId").isNull()))
