"""Sharding by jump consistent hashing: a key and a shard count decide, no table of shards is kept.

Going from n to n + 1 shards moves about one key in n + 1, and only into the new shard. Null keys share
one shard. Repeated rows and repeated keys share a shard and get different slots. Extra columns are kept;
columns named like the results are replaced. An empty table gives an empty table.
"""

from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.common import stored

_FACTOR = "2862933555777941757"  # fixed value of the published algorithm
_WHOLE = "18446744073709551616"  # 2**64


def unsigned_key(key: Column, kind: str) -> Column:
    """The key as an unsigned 64-bit number: integers as they are, anything else by its hash."""
    number = key.cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(key)
    number = F.coalesce(number, F.lit(0)).cast("decimal(20,0)")
    return F.when(number < 0, number + F.lit(_WHOLE).cast("decimal(20,0)")).otherwise(number).cast("decimal(20,0)")


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 .. shards - 1 of an unsigned 64-bit key.

    Each step draws the next bucket from the key's own generator, until it lies beyond the last shard.
    The number of steps is about ln(shards); the sequence below leaves so much room that running out of
    it never happens in practice, and would raise an error instead of giving a wrong shard.
    """
    steps = min(shards, 64 + 4 * ceil(log(shards + 1)))

    def step(state, _):
        drawn = ((state["k"] * F.lit(_FACTOR).cast("decimal(19,0)") + 1) % F.lit(_WHOLE).cast("decimal(20,0)")).cast("decimal(20,0)")
        high = F.floor(drawn / F.lit("8589934592").cast("decimal(10,0)")).cast("double") + 1
        after = F.floor((state["j"] + 1).cast("double") * (F.lit(2147483648.0) / high)).cast("long")
        return F.when(state["j"] < shards, F.struct(drawn.alias("k"), state["j"].alias("b"), after.alias("j"))).otherwise(state)

    start = F.struct(key.alias("k"), F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))
    last = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)
    done = F.when(last["j"] >= shards, last["b"])
    return F.coalesce(done, F.raise_error(F.lit("jump hash needs more steps")).cast("long")).cast("int")


def with_shard(rows: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """The rows with their shard; no shuffle."""
    return rows.withColumn(name, jump_shard(unsigned_key(F.col(key), dict(rows.dtypes)[key]), shards))


def with_slots(rows: DataFrame, key: str, shard: str = "shard", ties: tuple[str, ...] = ()) -> DataFrame:
    """Numbers 0, 1, 2, ... for the rows of each shard, in key order (equal keys by ``ties``).

    One range shuffle by shard and key lays the rows out; a number is the place within the partition plus
    what stands before it in the shard, and that comes from one count per shard and partition. The last
    sort key is the row's place in its input file, so that equal rows, however many, can be split over
    partitions. ``rows`` must be re-readable (files, or a stored table). Slots of equal rows are
    interchangeable; the result is the same for every layout.
    """
    order = [F.col(shard), F.col(key), *(F.col(c) for c in ties), F.col("_ul_row")]
    placed = (
        rows.withColumn("_ul_row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_ul_at", F.monotonically_increasing_id())
        .withColumn("_ul_part", F.spark_partition_id())
    )
    placed = stored(placed, "slots")
    parts = placed.groupBy(shard, "_ul_part").agg(F.count("*").alias("_ul_n"), F.min("_ul_at").alias("_ul_first"))
    # one row per shard and partition: a partition is a range, so there are fewer than shards + partitions
    before = Window.partitionBy(shard).orderBy("_ul_part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select(
        shard, "_ul_part", (F.coalesce(F.sum("_ul_n").over(before), F.lit(0)) - F.col("_ul_first")).alias("_ul_base")
    )
    return (
        placed.join(base, [shard, "_ul_part"])
        .withColumn("slot", F.col("_ul_at") + F.col("_ul_base"))
        .drop("_ul_row", "_ul_at", "_ul_part", "_ul_base")
    )


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Digest of all documents: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = with_shard(with_shard(rows, "doc_id", shards), "doc_id", shards + 1, "grown_shard")
    return with_slots(rows, "doc_id", ties=("text_crc32", "size"))
