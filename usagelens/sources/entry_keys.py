"""Entries that have landed before, told by key files beside the logs; no streaming state, no late row lost.

Every load leaves, per day, the identities of its entries (128 bits each) and a filter of them: bitmaps over a hash of
the identity. A batch looks at its own days only. An entry whose bit is not set has not landed; the few others are
compared with the identities themselves. Entries without an ``insertId`` have no identity and are always new.

A repeated batch does not see its own earlier traces, so it gives the same rows again. Two loads that run at the same
time may both land an entry; ``Warehouse.read_once`` settles that.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.operators.dedup import ENTRY_KEY
from usagelens.plans.rollup import rows_in
from usagelens.session import materialized
from usagelens.sources.tables import Warehouse

BUCKETS = 1024  # bitmaps of 32,768 bits per day: 8 bits an entry at four million entries a day
_BITS = 32_768
TABLES = ("entry_keys", "entry_filters")


def with_identity(rows: DataFrame) -> DataFrame:
    """Add event_date, two halves of the identity's hash, and its place in the filter; NULL without ``insertId``."""
    named = F.col("insertId").isNotNull()
    halves = {name: F.when(named, F.xxhash64(F.lit(name), *ENTRY_KEY)) for name in ("low", "high")}
    placed = rows.withColumns({"event_date": F.to_date("timestamp"), **halves})
    return placed.withColumns(
        {"bucket": F.pmod("low", F.lit(BUCKETS)), "position": F.pmod(F.shiftright("low", 20), F.lit(_BITS))}
    )


def unseen(warehouse: Warehouse, rows: DataFrame, load_id: str) -> DataFrame:
    """The entries that no other load has landed, once each, with their identity; stored.

    Of copies within the batch the one with the longest payload stays, then the greatest.
    """
    warehouse.ensure_tables(*TABLES)
    columns = rows.columns
    keyed = with_identity(rows)
    payload = F.coalesce(*[c for c in ("jsonPayload", "protopayload_auditlog") if c in columns])
    best = (
        keyed.filter("low IS NOT NULL")
        .groupBy("event_date", "low", "high", "bucket", "position")
        .agg(F.max(F.struct(F.length(payload).alias("size"), payload.alias("text"), F.struct(*columns).alias("entry"))).alias("best"))
        .select("event_date", "low", "high", "bucket", "position", "best.entry.*")
    )
    others = F.col("load_id") != load_id
    days = materialized(keyed.filter("low IS NOT NULL").select("event_date").distinct(), "days")
    filters = rows_in(warehouse.parts("entry_filters"), "event_date", days).filter(others)
    filters = filters.groupBy(F.col("event_date").alias("day"), F.col("bucket").alias("slot")).agg(F.bitmap_or_agg("bitmap").alias("bits"))
    byte = "CAST(conv(hex(substring(bits, CAST(position DIV 8 + 1 AS INT), 1)), 16, 10) AS INT)"
    tested = best.join(filters, F.col("event_date").eqNullSafe(F.col("day")) & (F.col("bucket") == F.col("slot")), "left")
    tested = tested.withColumn("maybe", F.expr(f"bits IS NOT NULL AND getbit({byte}, CAST(position % 8 AS INT)) = 1"))
    tested = materialized(tested.drop("day", "slot", "bits"), "tested")
    asked = tested.filter("maybe")
    keys = rows_in(warehouse.parts("entry_keys"), "event_date", asked.select("event_date")).filter(others).select("low", "high")
    fresh = tested.filter("NOT maybe").unionByName(asked.join(keys, ["low", "high"], "left_anti")).drop("maybe")
    return materialized(fresh.unionByName(keyed.filter("low IS NULL")), "fresh")


def remember(warehouse: Warehouse, fresh: DataFrame, load_id: str) -> None:
    """Leave the traces of landed entries, for the loads to come."""
    named = fresh.filter("low IS NOT NULL")
    warehouse.append(named.select("low", "high", "event_date"), "entry_keys", load_id)
    bits = named.groupBy("event_date", "bucket").agg(F.bitmap_construct_agg("position").alias("bitmap"))
    warehouse.append(bits, "entry_filters", load_id)
