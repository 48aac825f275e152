"""Near-duplicate classes from DartMinHash signatures.

A text is the weighted set of its five-word shingles (words: runs of anything but ASCII white space; a
text of fewer words is one shingle; weight: number of occurrences). Two texts are linked when their
weighted Jaccard similarity is at least the threshold, or when they are equal; classes are the connected
components of the links.

1. *Signatures.* Each element owns a region, its weight times the ranks from 0 upwards. Hashed darts fall
   on unit cells of that region, one per cell on average, each with a place in the cell, a rank and a
   coordinate of the signature. A dart counts if it lies below the element's weight; the earliest rank of
   a coordinate is the signature's value there. Two texts agree in a coordinate with a probability equal
   to their similarity. Only about max(weight, k ln k) darts are thrown per text.
2. *Banded joining.* Bands of the signature are bucket keys. In a bucket, texts are compared with the
   bucket's first text in a random order that all buckets share, hence with few different partners, never
   in all pairs. Buckets that still hold several classes go through further rounds with other orders.
3. *Exact check* of every such pair on the full shingle sets, then components by contraction of edges.
4. *The rest.* Rounds end without having compared all texts of a bucket. Texts of buckets that still hold
   untested pairs of different classes are joined on the rarest elements of their sets: of two texts at the
   threshold, the prefixes must share an element at places that leave room for the common ones. A pair
   meets at its first common element only, as far as the ``HEAD`` elements before tell, and if the parities of
   512 hash classes of elements allow enough common ones. What the join leaves out cannot reach the
   threshold, the rest is checked exactly. So every pair that shares a bucket is linked, in one class by
   other links, or known to be below the threshold.

Equal texts share their signature and are one node. Null texts are alone; empty texts are equal texts.
Repeated rows are copies. Null ids sort behind others within a class. Other columns are ignored. The
class id is the smallest id of the class. An empty table gives an empty table.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import ByteHasher, mix, seeded, stored, text_chunks, word_spans

WORDS = 5
THRESHOLD = 0.8
COORDINATES = 128
BANDS = 32
ROUNDS = 4
CHUNK = 1 << 20  # bytes of text at a time
CELLS = 1 << 18  # cells of the regions at a time
PARITY_WORDS = 8  # 64-bit words of a set's parities, a power of two
HEAD = 16  # elements before a shared one that are looked at to see whether the pair has met already

_PARITIES = [f"odd{i}" for i in range(PARITY_WORDS)]
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(buf: np.ndarray, offsets: np.ndarray, hasher: ByteHasher, words: int = WORDS):
    """(row, hash) of every shingle occurrence, rows ascending."""
    start, end, row = word_spans(buf, offsets)
    hasher.load(buf)
    word = hasher.between(start, end)
    counts = np.bincount(row, minlength=len(offsets) - 1)
    factors = seeded(words, 7)
    full = np.zeros(max(0, len(word) - words + 1), np.uint64)
    for i in range(words):
        full += mix(word[i : i + len(full)] + factors[i])  * (factors[i] | np.uint64(1))
    same = row[: len(full)] == row[words - 1 : words - 1 + len(full)]
    rows, values = row[: len(full)][same], mix(full[same])
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        first = np.searchsorted(row, short)
        extra = np.zeros(len(short), np.uint64)
        for i in range(words - 1):
            has = counts[short] > i
            extra[has] += mix(word[first[has] + i] + factors[i]) * (factors[i] | np.uint64(1))
        rows, values = np.concatenate([rows, short]), np.concatenate([values, mix(extra + counts[short].astype(np.uint64))])
        order = np.argsort(rows, kind="stable")
        rows, values = rows[order], values[order]
    return rows, values


def counted(rows: np.ndarray, values: np.ndarray):
    """Distinct (row, value) with their number of occurrences, sorted."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(new)
    return rows[at], values[at], np.diff(np.append(at, len(rows)))


def _poisson_steps() -> np.ndarray:
    """Cumulated Poisson(1) probabilities on the scale of 53-bit integers."""
    terms = [math.exp(-1.0) / math.factorial(i) for i in range(19)]
    return (np.cumsum(terms) * 2.0**53).astype(np.uint64)


def dart_signatures(rows, values, weights, n: int, k: int = COORDINATES) -> np.ndarray:
    """n x k matrix of the earliest ranks; a row without elements keeps the largest number.

    ``weights`` may be any positive numbers, best around one. Rows of cells are added for the texts
    that still have an empty coordinate.
    """
    steps = _poisson_steps()
    never = np.uint64(2**64 - 1)
    out = np.full(n * k, never, np.uint64)
    total = np.bincount(rows, weights=weights, minlength=n)
    wanted = k * math.log(k) + 2 * k
    with np.errstate(divide="ignore"):
        upto = np.where(total > 0, np.ceil(wanted / np.maximum(total, 1e-9)), 0).astype(np.int64)
    done = np.zeros(n, np.int64)
    elements = np.arange(len(rows))
    while len(elements):
        columns = np.ceil(weights[elements]).astype(np.int64)
        lines = upto[rows[elements]] - done[rows[elements]]
        for part in _pieces(columns * lines):
            which = np.repeat(elements[part], (columns * lines)[part])
            if not len(which):
                continue
            size = (columns * lines)[part]
            cell = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
            column, line = cell // np.repeat(lines[part], size), cell % np.repeat(lines[part], size)
            line += done[rows[which]]
            seed = mix(values[which] + column.astype(np.uint64) * _ODD) + line.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
            number = np.searchsorted(steps, mix(seed) >> np.uint64(11), "right")
            hit = np.flatnonzero(number)
            number = number[hit]
            dart = np.repeat(hit, number)
            turn = np.arange(len(dart)) - np.repeat(np.cumsum(number) - number, number)
            h = mix(seed[dart] + (turn.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
            h2 = mix(h + _ODD)
            inside = column[dart] + (h2 >> np.uint64(11)).astype(np.float64) * 2.0**-53 < weights[which[dart]]
            dart, h = dart[inside], h[inside]
            # the rank's whole part is the cell's line, the rest comes from the hash
            rank = (line[dart].astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24))
            slot = rows[which[dart]] * k + (h & np.uint64(0xFFFFFF)).astype(np.int64) % k
            np.minimum.at(out, slot, rank)
        empty = (out.reshape(n, k) == never).any(axis=1) & (total > 0)
        done = upto.copy()
        upto[empty] *= 2
        elements = elements[empty[rows[elements]]]
    return out.reshape(n, k)


def _pieces(sizes: np.ndarray, limit: int = CELLS):
    """Slices of about ``limit`` cells."""
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield slice(first, last)
        first = last


def band_keys(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    n, k = signatures.shape
    parts = signatures.reshape(n, bands, k // bands)
    keys = np.repeat(seeded(bands, 11)[None, :], n, axis=0)
    for i in range(k // bands):
        keys = mix(keys * _ODD + parts[:, :, i])
    return keys


def _signed(bands: int, k: int, words: int):
    def run(batches):
        hasher = ByteHasher()
        for batch in batches:
            for first, last, buf, offsets in text_chunks(batch.column("_ul_body"), CHUNK):
                n = last - first
                rows, values, weights = counted(*shingles(buf, offsets, hasher, words))
                keys = band_keys(dart_signatures(rows, values, weights.astype(np.float64), n, k), bands)
                some = np.bincount(rows, minlength=n) > 0
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)),
                    pa.array(keys[some].ravel().view(np.int64)),
                )
                cut = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays([cut.column("id"), cut.column("text_id"), lists], ["id", "text_id", "bands"])

    return run


def parities(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """n x PARITY_WORDS integers: per text, whether each hash class of elements has an odd number of them.

    A class of odd and even number differs by at least one element, so two sets have no fewer elements apart
    than their parities have different bits.
    """
    spot = mix(values ^ _ODD)
    out = np.zeros((n, PARITY_WORDS), np.uint64)
    np.bitwise_xor.at(out, (rows, (spot & np.uint64(PARITY_WORDS - 1)).astype(np.int64)), np.uint64(1) << (spot >> np.uint64(58)))
    return out


def _shingle_sets(words: int):
    """Every text as distinct hashes of (shingle, number of the occurrence): set sizes are weights; with parities."""

    def run(batches):
        hasher = ByteHasher()
        for batch in batches:
            for first, last, buf, offsets in text_chunks(batch.column("_ul_body"), CHUNK):
                n = last - first
                rows, values, weights = counted(*shingles(buf, offsets, hasher, words))
                turn = np.arange(int(weights.sum())) - np.repeat(np.cumsum(weights) - weights, weights)
                each = mix(np.repeat(values, weights) + turn.astype(np.uint64) * _ODD)
                owner = np.repeat(rows, weights)
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(each.view(np.int64)))
                odd = [pa.array(column) for column in parities(owner, each, n).view(np.int64).T]
                cut = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays([cut.column("text_id"), lists, *odd], ["text_id", "elements", *_PARITIES])

    return run


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(a, b) edges to (node, root), root = smallest node of the component; nodes without edges are absent.

    Every round hooks each node that has a smaller neighbour to the smallest one, and contracts: a hooked
    node leaves the edge table. The hooks form a forest, which pointer jumping flattens. Each round is a
    stored table, and only row counts reach the driver.
    """
    forest = None
    left = stored(_tidy(edges), label)
    while not left.isEmpty():
        # flat hooks: no hooked node is the root of another, so it never comes back into the edges
        hooks = _flattened(left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), label)
        forest = hooks if forest is None else forest.unionByName(hooks)
        by_a = left.join(hooks.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
        both = by_a.select(F.coalesce("ra", "a").alias("a"), "b").join(
            hooks.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left"
        )
        left = stored(_tidy(both.select("a", F.coalesce("rb", "b").alias("b"))), label)
    if forest is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    forest = _flattened(forest, label)
    # the roots themselves
    return forest.unionByName(forest.select(F.col("root").alias("node"), "root").distinct())


def _flattened(forest: DataFrame, label: str) -> DataFrame:
    """(node, root) with every root followed to its end, by pointer jumping: two jumps to a stored table."""
    forest = stored(forest, label)
    while True:
        above = forest.select(F.col("node").alias("root"), F.col("root").alias("up"))
        further = forest.select(F.col("node").alias("up"), F.col("root").alias("top"))
        jumped = stored(forest.join(above, "root", "left").join(further, "up", "left"), label)
        forest = jumped.select("node", F.coalesce("top", "up", "root").alias("root"))
        if jumped.where("top IS NOT NULL").isEmpty():
            return forest


def _joined(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) after more links: only their contracted edges are walked, known classes move as a whole."""
    if roots is None:
        return stored(components(links), "roots")
    over = links
    for end in ("a", "b"):
        over = over.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    over = over.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    moved = stored(components(over), "moved")
    known = roots.join(moved.select(F.col("node").alias("root"), F.col("root").alias("up")), "root", "left")
    # nodes of the contracted edges that had no class before
    fresh = moved.join(roots.select("node"), "node", "left_anti")
    return stored(known.select("node", F.coalesce("up", "root").alias("root")).unionByName(fresh), "roots")


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    words: int = WORDS,
    k: int = COORDINATES,
    bands: int = BANDS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per row of ``docs``: id, text_id (hash of the text), class_id (smallest id), kept.

    ``kept`` marks the rows of the class's chosen text that have the class's smallest id: one row, unless
    the row itself is repeated. ``docs`` must be re-readable.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_id"), F.col(text_col).alias("_ul_body"))
    kind = dict(rows.dtypes)["id"]
    signed = stored(
        rows.where("_ul_body IS NOT NULL").mapInArrow(_signed(bands, k, words), f"id {kind}, text_id bigint, bands array<bigint>"), "signatures"
    )
    texts = stored(signed.groupBy("text_id").agg(F.min("id").alias("first_id")), "texts")
    spread = signed.select("text_id", F.explode("bands").alias("bucket"))
    tested, sets, roots = None, None, None
    for turn in range(rounds):
        order = F.xxhash64("text_id", F.lit(turn))
        if turn == 0:
            shared = spread.groupBy("bucket").agg(
                F.min("text_id").alias("lo"), F.max("text_id").alias("hi"), F.min_by("text_id", order).alias("centre")
            ).where("lo < hi").select("bucket", "centre")
            members = stored(spread.join(shared, "bucket").distinct(), "buckets")
            pairs = members.where("text_id <> centre")
        else:
            known = members.select("text_id", "bucket").join(roots.withColumnRenamed("node", "text_id"), "text_id", "left")
            known = known.select("bucket", "text_id", F.coalesce("root", "text_id").alias("root"))
            shared = known.groupBy("bucket").agg(
                F.min("root").alias("lo"), F.max("root").alias("hi"), F.min_by(F.struct("text_id", "root"), order).alias("centre")
            ).where("lo < hi").select("bucket", F.col("centre.text_id").alias("centre"), F.col("centre.root").alias("centre_root"))
            pairs = known.join(shared, "bucket").where("root <> centre_root")
        pairs = _tidy(pairs.select(F.col("text_id").alias("a"), F.col("centre").alias("b")))
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        if turn == 0:
            sets = _sets_of(rows, texts, members, words)
        elif pairs.isEmpty():
            break
        found = stored(_verified(pairs, sets, threshold), "links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        if turn and found.isEmpty():
            break
        roots = _joined(roots, found)
    rest = _rest(members, roots, sets, tested, threshold)
    if not rest.isEmpty():
        found = stored(_verified(rest, sets, threshold), "links")
        if not found.isEmpty():
            roots = _joined(roots, found)
    named = texts.join(roots.withColumnRenamed("node", "text_id"), "text_id", "left")
    named = stored(named.select("text_id", "first_id", F.coalesce("root", "text_id").alias("root")), "named")
    best = named.groupBy("root").agg(
        F.min("first_id").alias("class_id"), F.min(F.struct(F.col("first_id").isNull().alias("no_id"), "first_id", "text_id")).alias("best")
    )
    classes = stored(named.join(best, "root").select("text_id", "class_id", F.col("best.text_id").alias("chosen"), F.col("best.first_id").alias("chosen_id")), "classes")
    with_class = signed.select("id", "text_id").join(classes, "text_id").select(
        "id", "text_id", "class_id", ((F.col("text_id") == F.col("chosen")) & F.col("id").eqNullSafe(F.col("chosen_id"))).alias("kept")
    )
    alone = rows.where("_ul_body IS NULL").select("id", "text_id", F.col("id").alias("class_id"), F.lit(True).alias("kept"))
    return with_class.unionByName(alone)


def _rest(members: DataFrame, roots: DataFrame, sets: DataFrame, tested: DataFrame, threshold: float) -> DataFrame:
    """Untested pairs (a, b) of different classes that could reach the threshold, of all texts in open buckets.

    A bucket is open if it holds several classes and more than two texts; two were compared in the first round.
    """
    known = members.select("text_id", "bucket").join(roots.withColumnRenamed("node", "text_id"), "text_id", "left")
    known = known.select("bucket", "text_id", F.coalesce("root", "text_id").alias("root"))
    several = known.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n")).where("lo < hi AND n > 2")
    texts = stored(known.join(several.select("bucket"), "bucket").select("text_id", "root").distinct(), "open")
    each = sets.join(texts, "text_id").select("text_id", "root", *_PARITIES, F.size("elements").alias("size"), F.explode("elements").alias("element"))
    # an element of one class makes no pair; such elements come first in every text's order
    counts = each.groupBy("element", "root").agg(F.count("*").alias("n"))
    shared = counts.groupBy("element").agg(F.sum("n").alias("texts"), F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("classes"))
    shared = stored(shared.where("classes > 1").drop("classes"), "shared-elements")
    t = float(threshold)
    lists = each.join(shared, "element").groupBy("text_id", "root", "size", *_PARITIES).agg(
        F.array_sort(F.collect_list(F.struct("texts", "element", "main"))).alias("order")
    )
    lists = lists.withColumn("alone", F.col("size") - F.size("order")).withColumn("names", F.transform("order", lambda e: e["element"]))
    # elements that may be the first common one: enough others follow
    most = F.least(F.size("order"), F.floor(F.col("size") * F.lit(1 - t) - F.col("alone") + 1e-6).cast("int") + 1)
    places = F.transform(
        F.slice("order", 1, F.greatest(most, F.lit(0))),
        lambda e, at: F.struct(
            (F.col("alone") + at).alias("place"), e["element"].alias("element"), (F.col("root") != e["main"]).alias("minor"),
            F.slice("names", F.greatest(at - HEAD, F.lit(0)) + 1, F.least(at, F.lit(HEAD))).alias("head"),
        ),
    )
    rows = lists.select("text_id", "root", "size", *_PARITIES, F.inline(places))
    left = F.col("size") - F.col("place")  # elements from this place on
    rows = stored(rows, "prefixes")
    # the smaller text of a pair shares one of even fewer elements; one of the two is outside of the element's main class
    small = rows.where(left >= F.col("size") * F.lit(2 * t / (1 + t)) - 1e-6).withColumn("side", F.when(F.col("minor"), 0).otherwise(1))
    large = rows.withColumn("side", F.explode(F.when(F.col("minor"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    busy = small.groupBy("element", "side").agg(F.ceil(F.count("*") / FAN).cast("int").alias("salts"))
    busy = stored(busy, "busy")
    small = small.join(busy, ["element", "side"]).withColumn("salt", F.pmod(F.xxhash64("text_id"), F.col("salts")).cast("int")).drop("salts")
    large = large.join(busy, ["element", "side"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    for name in ("text_id", "root", "size", "place", "head", *_PARITIES):
        small, large = small.withColumnRenamed(name, f"{name}_a"), large.withColumnRenamed(name, f"{name}_b")
    both = F.col("size_a") + F.col("size_b")
    apart = sum((F.bit_count(F.col(f"{p}_a").bitwiseXOR(F.col(f"{p}_b"))) for p in _PARITIES), F.lit(0))
    pairs = small.drop("minor").join(large.drop("minor"), ["element", "side", "salt"]).where(
        (F.col("root_a") != F.col("root_b"))
        & (F.struct("size_a", "text_id_a") < F.struct("size_b", "text_id_b"))
        & (F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b")) >= both * F.lit(t / (1 + t)) - 1e-6)
        & (apart <= both * F.lit((1 - t) / (1 + t)) + 1e-6)
        & ~F.arrays_overlap("head_a", "head_b")
    )
    pairs = _tidy(pairs.select(F.col("text_id_a").alias("a"), F.col("text_id_b").alias("b")))
    return stored(pairs.join(tested, ["a", "b"], "left_anti"), "rest")


def _sets_of(rows: DataFrame, texts: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """Shingle sets of the texts that share a bucket with another text, one row per text."""
    wanted = texts.join(members.select("text_id").distinct(), "text_id", "left_semi")
    bodies = rows.join(
        wanted.withColumnRenamed("text_id", "_ul_text"),
        (F.col("text_id") == F.col("_ul_text")) & F.col("id").eqNullSafe(F.col("first_id")),
    ).select("text_id", "_ul_body")
    schema = "text_id bigint, elements array<bigint>, " + ", ".join(f"{name} bigint" for name in _PARITIES)
    sets = bodies.mapInArrow(_shingle_sets(words), schema)
    # rows repeated with their id give the same set again
    return stored(sets.dropDuplicates(["text_id"]), "sets")


FAN = 256  # partners of a text that are compared in one group


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs at or above the threshold. A text with many partners is dealt out under several salts."""
    busy = pairs.select(F.col("a").alias("text_id")).unionByName(pairs.select(F.col("b").alias("text_id")))
    busy = stored(busy.groupBy("text_id").agg(F.ceil(F.count("*") / FAN).cast("int").alias("salts")), "busy")
    salted = sets.select("text_id", "elements").join(busy, "text_id").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    sides = []
    for one, other in (("a", "b"), ("b", "a")):
        sides.append(salted.select(F.col("text_id").alias(one), F.col("salt").alias(f"salt_{one}"), F.col("elements").alias(f"elements_{one}")))
        pairs = pairs.join(busy.select(F.col("text_id").alias(one), F.col("salts").alias(f"salts_{one}")), one)
        pairs = pairs.withColumn(f"salt_{one}", F.pmod(F.xxhash64(other), F.col(f"salts_{one}")).cast("int"))
    both = pairs.join(sides[0], ["a", "salt_a"]).join(sides[1], ["b", "salt_b"])
    shared = F.size(F.array_intersect("elements_a", "elements_b"))
    union = F.size("elements_a") + F.size("elements_b") - shared
    return both.where(shared >= union * F.lit(float(threshold)) - 1e-9).select("a", "b")


def unique_documents(docs: DataFrame) -> DataFrame:
    """One document of each class, whole rows; a repeated row stays once."""
    classes = near_duplicates(docs)
    chosen = classes.where("kept").select(F.col("id").alias("_ul_id"), F.col("text_id").alias("_ul_text")).distinct()
    chosen = stored(chosen, "chosen")
    keyed = docs.withColumn("_ul_key", F.xxhash64("text"))
    kept = keyed.join(chosen, F.col("doc_id").eqNullSafe(F.col("_ul_id")) & (F.col("_ul_key") == F.col("_ul_text")), "left_semi")
    return kept.dropDuplicates(["doc_id", "_ul_key"]).drop("_ul_key")


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """Digest of all documents: doc_id, class_id, kept."""
    return near_duplicates(docs).select(F.col("id").alias("doc_id"), "class_id", "kept")
