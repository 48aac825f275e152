"""What five document filters remove in every order, from one count per part and set of failed filters.

A document is reduced to the set of filters that it fails, and documents to counts per part and set. A
filter removes, from the state in which a set S of filters has been applied, the documents that fail it
and none of S; hence orders are paths through the lattice of sets and need no documents.

*Forward-backward counting*: the number of orders that reach a state is the sum over its incoming edges, the
number that leave it for the full set is the sum over its outgoing ones. An edge lies on reach x leave
orders, so the removals of a filter over all orders, its Shapley value times the number of orders, are a
weighted sum over its 16 edges. The steps of every order are read from the same 80 edges.

Filters: A under 200 words; B fewer than half of the words distinct; C more than 2% of the code points are
A-Z; D holds one of ``#$%&*|``; E the text also belongs to a smaller doc_id. Null texts are empty texts.
Null ids are never smaller nor larger than another, carry no label, and do not fail E. A repeated row is
one more document; the rows of the smallest id all pass E. Labels are a document's if any label row of its
id has the value 1. Null and empty sources are one part. No document, no part, hence no row. Very long texts
are taken whole. Extra columns are ignored.

On Spark: one scan computes the four local filters and a SHA-256 of the text. Copies are counted per text,
part and id, which spreads a hot text by its ids, and are folded map-side before a text's ids meet: then it
has one row per part. What remains, 32 sets per part, is exploded over a constant table of edges.
"""

from functools import cache
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 2
SYMBOLS = "#$%&*|"
SALTS = 1024  # rows without id are dealt over as many join keys
_FULL = (1 << len(FILTERS)) - 1


@cache
def lattice() -> tuple[tuple[int, int, int], ...]:
    """(state, filter, orders through the edge from state to state with filter), states as bit sets."""
    bits = range(len(FILTERS))
    reach, leave = {0: 1}, {_FULL: 1}
    for state in range(1, _FULL + 1):
        reach[state] = sum(reach[state ^ 1 << i] for i in bits if state >> i & 1)
    for state in range(_FULL - 1, -1, -1):
        leave[state] = sum(leave[state | 1 << i] for i in bits if not state >> i & 1)
    return tuple(
        (state, i, reach[state] * leave[state | 1 << i]) for state in range(_FULL) for i in bits if not state >> i & 1
    )


def order_steps() -> list[tuple[str, int, int, int]]:
    """(order, step, state before it, filter) of all orders."""
    steps = []
    for order in permutations(range(len(FILTERS))):
        state, name = 0, "".join(FILTERS[i] for i in order)
        for at, i in enumerate(order):
            steps.append((name, at + 1, state, i))
            state |= 1 << i
    return steps


def local_failures(text: Column) -> Column:
    """Bit set of the failed filters A to D of a text that is not null."""
    bare = F.trim(text, F.lit(" \t\n\x0b\f\r"))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
    n = F.size(words)
    fails = (
        n < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * n,
        100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > CAPITAL_PERCENT * F.length(text),
        text.rlike(f"[{SYMBOLS}]"),
    )
    return sum((F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(fails)), F.lit(0))


def failure_counts(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, failed, n, good, toxic): documents per part and set of failed filters."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("key"),
        local_failures(text).alias("failed"),
    )
    # rows without id match no label; a salt keeps them from meeting in one task
    rows = rows.withColumn("salt", F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).otherwise(0))
    marked = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    rows = rows.join(marked.withColumn("salt", F.lit(0)), ["doc_id", "salt"], "left")
    by_id = rows.groupBy("doc_id", "salt", "key", "part", "failed").agg(
        F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    sums = ("n", "good", "toxic")
    first = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", *sums))
    unnamed = [F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col(c))), F.lit(0)).alias(f"{c}_unnamed") for c in sums]
    by_text = by_id.groupBy("key", "part", "failed").agg(F.min(first).alias("first"), *[F.sum(c).alias(c) for c in sums], *unnamed)
    least = F.min("first.doc_id").over(Window.partitionBy("key"))
    by_text = by_text.withColumn("least", least)
    # of a text's documents in a part, those of the smallest id and those without id pass E
    pure = [
        (F.col(f"{c}_unnamed") + F.when(F.col("first.doc_id") == F.col("least"), F.col(f"first.{c}")).otherwise(0)).alias(c) for c in sums
    ]
    copies = F.struct((F.col("failed") + (1 << FILTERS.index("E"))).alias("failed"), *[(F.col(c) - passing).alias(c) for c, passing in zip(sums, pure, strict=True)])
    both = by_text.select("part", F.inline(F.array(F.struct("failed", *pure), copies)))
    return both.where("n > 0").groupBy("part", "failed").agg(*[F.sum(c).alias(c) for c in sums])


def interactions(counts: DataFrame) -> DataFrame:
    """All orders of all parts from (part, failed, n, good, toxic); see the module."""
    edges = F.expr(
        "inline(array(" + ", ".join(f"named_struct('state', {s}, 'filter', {i}, 'orders', {o}L)" for s, i, o in lattice()) + "))"
    )
    rows = counts.select("part", "failed", "n", "good", "toxic", edges)
    bit = F.expr("shiftleft(1, filter)")
    fails, before = F.col("failed").bitwiseAND(bit) != 0, F.col("failed").bitwiseAND(F.col("state")) != 0

    def total(condition, column="n"):
        return F.sum(F.when(condition, F.col(column)).otherwise(0))

    per_edge = rows.groupBy("part", "state", "filter", "orders").agg(
        total(~fails & ~before).alias("kept"),
        total(fails & ~before).alias("removed"),
        total(fails & before).alias("redundant"),
        total(F.col("failed") == bit).alias("unique_fails"),
        total(fails & ~before, "good").alias("good_lost"),
        total(fails & ~before, "toxic").alias("toxic_lost"),
    )
    weighted = F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "filter"))
    per_edge = per_edge.withColumn("shapley", weighted)
    steps = counts.sparkSession.createDataFrame(order_steps(), "filter_order string, step int, state int, filter int")
    return per_edge.join(F.broadcast(steps), ["state", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per source, order and step."""
    return interactions(failure_counts(docs, labels))


# independent SQL: every document walks through every order
ORACLE = r"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
f AS (
    SELECT r, part,
           [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
            regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails,
           EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND l.quality = 1) AS good,
           EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND l.toxic = 1) AS toxic
    FROM w
), o AS (
    SELECT '' AS filter_order UNION ALL
    SELECT filter_order || c FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c) WHERE NOT contains(filter_order, c)
), s AS (SELECT filter_order, unnest(generate_series(1, 5)) AS step FROM o WHERE length(filter_order) = 5),
walk AS (
    SELECT part, filter_order, step, good, toxic, fails[strpos('ABCDE', filter_order[step])] AS now,
           list_bool_or([false] || list_transform(generate_series(1, step - 1), lambda k: fails[strpos('ABCDE', filter_order[k])])) AS gone,
           len(list_filter(fails, lambda x: x)) AS n_fails
    FROM f, s
), e AS (
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, count(*) FILTER (NOT now AND NOT gone) AS kept, count(*) FILTER (now AND NOT gone) AS removed,
           count(*) FILTER (now AND gone) AS redundant, count(*) FILTER (now AND n_fails = 1) AS unique_fails,
           count(*) FILTER (now AND NOT gone AND good) AS good_lost, count(*) FILTER (now AND NOT gone AND toxic) AS toxic_lost
    FROM walk GROUP BY ALL
)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley FROM e
"""
