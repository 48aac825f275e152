"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a fixed 64-bit hash. For a source with a budget, the documents whose hash lies below
a threshold are taken. The threshold comes from histograms: sizes are summed by source and hash bucket,
the running sum shows the bucket in which the budget ends, and only that bucket is cut finer, level by
level, until what is left in it cannot be told apart by size. No sort of documents, no Python in tasks.

A larger budget takes a superset. A target above the source's size takes every document once and the rest
of the target by the same threshold. A whole document is taken or not, so a source misses its target by
at most half of its boundary document. Equal rows are split by their place in the input, which of them is
taken does not change the result. Null sources are a source of their own, null texts have size 0, an
empty table gives an empty table, extra columns are kept, those named like the results are replaced.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.common import stored

BITS = 10  # a histogram has 2**BITS buckets per source
LEVELS = 6  # levels on the document's hash, and as many again on the place of equal rows

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size) to (source, source_size, target): one row per source throughout.

    Resharing the excess by weight until none is above its limit ends at one common level: each source
    gets level x weight, or its limit if that is less. Sources reach their limits in the order of limit
    per weight, so running sums over that order give the level without a loop.
    """
    spot = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (spot % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("_ul_weight", weight).withColumn("_ul_limit", F.col("source_size") * float(most))
    everything = Window.partitionBy()
    rows = rows.withColumn("_ul_ratio", F.col("_ul_limit") / F.col("_ul_weight"))
    before = Window.orderBy("_ul_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        rows.withColumn("_ul_budget", F.sum("source_size").over(everything) * float(share))
        .withColumn("_ul_full", F.coalesce(F.sum("_ul_limit").over(before), F.lit(0.0)))
        .withColumn("_ul_open", F.sum("_ul_weight").over(everything) - F.coalesce(F.sum("_ul_weight").over(before), F.lit(0.0)))
        .withColumn("_ul_level", (F.col("_ul_budget") - F.col("_ul_full")) / F.col("_ul_open"))
        # the level is the one at the first source that stays below its limit; after it, levels only fall
        .withColumn("_ul_common", F.max(F.when(F.col("_ul_level") < F.col("_ul_ratio"), F.col("_ul_level"))).over(everything))
    )
    level = F.col("_ul_common")
    target = F.when(level.isNull(), F.col("_ul_limit")).otherwise(F.least(F.col("_ul_limit"), level * F.col("_ul_weight")))
    return rows.select("source", "source_size", target.alias("target"))


def _bucket(level: int) -> Column:
    """The level's BITS of the document's hash; after LEVELS of them, those of the row's place."""
    word = F.col("_ul_hash") if level < LEVELS else F.col("_ul_place")
    return F.shiftrightunsigned(word, 64 - BITS * (level % LEVELS + 1)).bitwiseAND((1 << BITS) - 1).cast("int")


def mixed(docs: DataFrame, size: Column, weights=WEIGHTS, share: float = SHARE, most: float = MOST, salt: int = 0) -> DataFrame:
    """The documents with size, source_size, target and taken (a multiple of size).

    ``docs`` has doc_id, text and source, and must be re-readable; it is read once here, and the narrow
    columns that the levels need are stored. Callers that need the texts join on doc_id.
    """
    narrow = docs.select(
        "doc_id",
        "source",
        size.alias("size"),
        F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit("")), F.lit(salt)).alias("_ul_hash"),
        F.xxhash64(F.monotonically_increasing_id(), F.lit(salt)).alias("_ul_place"),
    )
    narrow = stored(narrow, "mix")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = source_targets(sizes, weights, share, most).withColumn("_ul_whole", whole)
    # budget left for the threshold; path: the bucket chosen on each level; open: still being refined
    state = state.withColumn("_ul_left", F.col("target") - F.col("_ul_whole") * F.col("source_size"))
    state = stored(state.withColumn("_ul_open", F.col("_ul_left") > 0), "mix-level")
    path: list[str] = []
    for level in range(2 * LEVELS):
        here = [F.col(f"_ul_cut{i}") == _bucket(i) for i in range(level)]
        rows = _inside(narrow, state, here)
        histogram = rows.groupBy(narrow["source"].alias("source"), _bucket(level).alias("_ul_bucket")).agg(
            F.sum("size").alias("_ul_sum"), F.count("*").alias("_ul_rows")
        )
        cut = _boundary(histogram, state, level)
        state = stored(cut, "mix-level")
        path.append(f"_ul_cut{level}")
        if state.where("_ul_open").limit(1).count() == 0:
            break
    return _decided(narrow, state, path)


def _same_source(rows: DataFrame, state: DataFrame) -> Column:
    return rows["source"].eqNullSafe(state["source"])


def _inside(narrow: DataFrame, state: DataFrame, here: list[Column]) -> DataFrame:
    """Rows of the boundary bucket of each source that is still open."""
    condition = _same_source(narrow, state)
    for same in here:
        condition = condition & same
    return narrow.join(state.where("_ul_open"), condition, "inner")


def _boundary(histogram: DataFrame, state: DataFrame, level: int) -> DataFrame:
    """Add this level's cut: buckets below it are taken whole, the cut itself is refined further.

    Closed when the boundary bucket holds one row: it is taken if that brings the source nearer to its
    target, by moving the cut behind it.
    """
    upto = Window.partitionBy("source").orderBy("_ul_bucket")
    joined = histogram.withColumn("_ul_upto", F.sum("_ul_sum").over(upto))
    state_left = state.select("source", "_ul_left")
    joined = joined.join(state_left.withColumnRenamed("source", "_ul_source"), F.col("source").eqNullSafe(F.col("_ul_source")))
    boundary = (
        joined.where(F.col("_ul_upto") > F.col("_ul_left"))
        .groupBy(F.col("source").alias("_ul_source"))
        .agg(F.min(F.struct("_ul_bucket", "_ul_upto", "_ul_sum", "_ul_rows")).alias("_ul_at"))
    )
    out = state.join(boundary, state["source"].eqNullSafe(boundary["_ul_source"]), "left")
    at = F.col("_ul_at")
    left = F.col("_ul_left") - (at["_ul_upto"] - at["_ul_sum"])  # budget inside the boundary bucket
    single = (at["_ul_rows"] == 1) | F.lit(level == 2 * LEVELS - 1)
    nearer = (left * 2 > at["_ul_sum"]).cast("int")
    cut = (
        F.when(~F.col("_ul_open"), F.lit(-1))
        .when(at.isNull(), F.lit(1 << BITS))  # the budget takes the whole bucket
        .when(single, at["_ul_bucket"] + nearer)
        .otherwise(at["_ul_bucket"])
    )
    # a closed cut that ends between buckets has nothing left inside
    return out.select(
        *[c for c in state.columns if c not in ("_ul_left", "_ul_open")],
        cut.cast("int").alias(f"_ul_cut{level}"),
        F.when(F.col("_ul_open") & at.isNotNull() & ~single, left).otherwise(F.col("_ul_left")).alias("_ul_left"),
        (F.col("_ul_open") & at.isNotNull() & ~single).alias("_ul_open"),
    )


def _decided(narrow: DataFrame, state: DataFrame, path: list[str]) -> DataFrame:
    """Compare each row's buckets with its source's cuts, first difference decides."""
    below = F.lit(False)
    for level in reversed(range(len(path))):
        cut, bucket = F.col(path[level]), _bucket(level)
        below = F.when(bucket < cut, True).when(bucket > cut, False).otherwise(below)
    copies = F.col("_ul_whole") + (below & (F.col("target") > F.col("_ul_whole") * F.col("source_size"))).cast("int")
    return narrow.join(state, _same_source(narrow, state)).select(
        "doc_id", narrow["source"], "_ul_hash", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies")
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """Digest of the mix of all documents: doc_id, size, source_size, target, taken."""
    return mixed(docs, word_count(F.col("text"))).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """Whole rows, each as often as the mix takes it; rows that it does not take are gone.

    Decisions belong to a document, so equal rows (id, source and text) get the number of copies that the
    mix takes of them together, dealt out evenly.
    """
    key = F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit("")), F.lit(0))
    plan = mixed(docs, word_count(F.col("text"))).groupBy("_ul_hash", F.col("source").alias("_ul_source")).agg(
        F.count("*").alias("_ul_rows"), F.sum("copies").alias("_ul_copies")
    )
    plan = stored(plan.where("_ul_copies > 0"), "mix-plan")
    rows = docs.withColumn("_ul_key", key)
    joined = rows.join(plan, (F.col("_ul_key") == F.col("_ul_hash")) & F.col("source").eqNullSafe(F.col("_ul_source")))
    base, rest = F.floor(F.col("_ul_copies") / F.col("_ul_rows")), F.col("_ul_copies") % F.col("_ul_rows")
    # of n equal rows, the first ones get one more; equal rows are told apart only where that matters
    first = F.when(rest == 0, F.lit(False)).otherwise(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_ul_rows")) < rest)
    times = (base + first.cast("int")).cast("int")
    repeated = joined.withColumn("_ul_times", times).where("_ul_times > 0")
    return repeated.withColumn("_ul_turn", F.explode(F.array_repeat(F.lit(0), F.col("_ul_times")))).select(*docs.columns)
