"""Repeated passages by interval trees of sparse enhanced suffix arrays.

Two texts share a passage of ``span`` bytes exactly if some ``span``-byte string starts in both. A suffix
array of all suffixes of the corpus would hold them side by side; here the suffixes are dealt out by
content, so that equal strings meet, and most of them are settled before any is moved.

1. *Anchors.* Among the 24-byte grams of a ``span``-byte string, the one with the least hash (the leftmost
   of equals) is its anchor: equal strings have equal anchors. Neighbouring strings mostly share theirs, so
   a text falls into short *runs* of string starts with one anchor; a run's context is the text from its
   first start to the end of its last string. Only runs travel, about one per 14 bytes, as two hashes. They
   do so in ``ROUNDS`` shares of the anchors, one after the other, so that never all of them are on disk.
2. *Equal contexts.* Each task first settles runs that recur within it: of equal contexts only those of the
   smallest document go on, so a hot passage reaches its reducer once per task. Runs then meet by anchor.
   A context that also occurs in a smaller document is repeated as a whole.
3. *Suffix arrays.* Anchors with several different contexts remain, and of those contexts only the first
   occurrence. Two of them that share a string agree on half of its other bytes in front of the anchor or
   behind it; those that agree with no other document's on either side (by hash) share none and go, too.
   Their bytes are fetched, all string starts are sorted (by anchor, then text) with common
   prefix lengths, and a stack scan builds the tree of common-prefix intervals: each node is a repeat with
   all its occurrences, right-maximal by construction, and maximal if the bytes in front of them differ.
   An occurrence is repeated as far as the deepest node that reaches a smaller document.
   An anchor with very many contexts is split by salt; what a part cannot settle meets again by the hash
   of its string, at most once per part.

The outcome is exact: a byte is marked if and only if some ``span``-byte string over it also starts in a
document with a smaller id. Contexts are compared by a 64-bit hash beside the 64-bit hash of their anchor.

Null texts are empty; texts shorter than ``span`` have no repeats. Rows with equal ids are not smaller
than each other; null ids are smaller than all others. Extra columns are ignored. Empty tables give empty
tables.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import ByteHasher, mix, stored, text_chunks

SPAN = 50
GRAM = 24
ROUNDS = 2  # shares of the anchors; each costs a scan of the texts, and the disk holds one share at a time
SCAN_BYTES = 256 << 10  # bytes of text that are scanned at a time: their hashes stay in the processor's cache
SEND_BYTES = 4 << 20  # bytes of packed runs in one batch
FLUSH_RUNS = 1_500_000  # runs that a task gathers before it settles and sends them
CONTEXTS = 2048  # different contexts of an anchor in one suffix array

_NULL_ID = -(2**63)


# ---------------------------------------------------------------- anchors and runs


def text_runs(buf: np.ndarray, offsets: np.ndarray, hasher: ByteHasher, span: int = SPAN, share=None):
    """(row, first start, last start, anchor hash, context hash, sides) of every run; starts are places in ``buf``.

    ``share`` tells which anchors are wanted, all without it. ``sides`` are hashes in 1 ... 65535 of the anchor
    with half of a string's other bytes in front of it and behind it, 0 where the context ends before.
    """
    none = np.empty(0, np.int64)
    long = np.diff(offsets) >= span
    if not long.any():
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), np.empty((0, 2), np.uint16)
    hasher.load(buf)
    place = np.arange(len(buf) - GRAM + 1)
    gram = hasher.between(place, place + GRAM)
    ranked = (gram & np.uint64(0xFFFFFFFF00000000)) | place.astype(np.uint64)
    # minimum over a sliding window by doubling
    window, least, size = span - GRAM + 1, ranked, 1
    while size * 2 <= window:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if window > size:
        least = np.minimum(least[: len(least) - (window - size)], least[window - size :])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edge = np.zeros(len(buf) + 1, np.int8)
    edge[offsets[:-1][long]] += 1
    edge[offsets[1:][long] - span + 1] -= 1
    start = np.flatnonzero(np.cumsum(edge[: len(anchor)], dtype=np.int8))
    mine = anchor[start]
    new = np.ones(len(start), bool)
    new[1:] = (mine[1:] != mine[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(new)
    first, last = start[at], start[np.append(at[1:], len(start)) - 1]
    mine = mine[at]
    if share is not None:
        wanted = share(gram[mine])
        first, last, mine = first[wanted], last[wanted], mine[wanted]
    context = mix(hasher.between(first, last + span) + (mine - first).astype(np.uint64))
    half = (span - GRAM + 1) // 2
    begin, end = np.maximum(mine - half, first), np.minimum(mine + GRAM + half, last + span)
    sides = np.stack([hasher.between(begin, mine + GRAM), hasher.between(mine, end)], axis=1) % np.uint64(65535) + np.uint64(1)
    sides[np.stack([mine - begin < half, end - mine < GRAM + half], axis=1)] = 0
    return np.searchsorted(offsets, first, "right") - 1, first, last, gram[mine], context, sides.astype(np.uint16)


RUN = np.dtype([("anchor", "<u8"), ("context", "<u8"), ("doc", "<u4"), ("first", "<u4"), ("more", "<u2"), ("sides", "<u2", 2)])


def _settled(runs: np.ndarray, rank: np.ndarray):
    """Sort runs by anchor, context, document; tell which also occur in a smaller document."""
    anchor = np.ascontiguousarray(runs["anchor"])
    order = np.argsort(anchor)
    again = np.diff(anchor[order]) == 0
    at = np.flatnonzero(np.append(again, False) | np.append(False, again))  # most anchors occur once
    several = runs[order[at]]
    order[at] = order[at][np.lexsort((rank[several["doc"]], several["context"], several["anchor"]))]
    runs = runs[order]
    ranks = rank[runs["doc"]]
    new = np.ones(len(runs), bool)
    new[1:] = (runs["anchor"][1:] != runs["anchor"][:-1]) | (runs["context"][1:] != runs["context"][:-1])
    smallest = ranks[np.flatnonzero(new)][np.cumsum(new) - 1]
    return runs, ranks, new, ranks > smallest


def _planes(rows: np.ndarray) -> bytes:
    """First bytes of all rows, then second bytes, and so on: compresses well."""
    return rows.view(np.uint8).reshape(len(rows), -1).T.tobytes()


def _from_planes(data: bytes, kind: np.dtype) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _span_rows(docs: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Merge spans per document: (documents, list offsets, starts, ends)."""
    order = np.lexsort((start, docs))
    docs, start, end = docs[order], start[order], end[order]
    # documents are set apart, so that one running maximum serves all of them
    apart = docs.astype(np.int64) << 34
    reach = np.maximum.accumulate(end + apart)
    new = np.ones(len(docs), bool)
    new[1:] = start[1:] + apart[1:] > reach[:-1]
    at = np.flatnonzero(new)
    start, end = start[at], (reach - apart)[np.append(at[1:], len(docs)) - 1]
    who, counts = np.unique(docs[at], return_counts=True)
    return who, np.concatenate([[0], np.cumsum(counts)]), start, end


def _spans_batch(part, docs, start, end, ids, ties, names):
    who, lists, start, end = _span_rows(docs, start, end)
    lists = pa.array(lists, pa.int32())
    n = len(who)
    columns = {
        "part": pa.array(part(n) if part else [None] * n, pa.int32()),
        "payload": pa.nulls(n, pa.binary()),
        "doc_ids": pa.nulls(n, pa.binary()),
        "doc_id": pa.array([ids[i] for i in who], pa.int64()),
        "tie": pa.array(ties[who], pa.int64()),
        "anchor": pa.nulls(n, pa.int64()),
        "salt": pa.nulls(n, pa.int32()),
        "salts": pa.nulls(n, pa.int32()),
        "starts": pa.ListArray.from_arrays(lists, pa.array(start, pa.int64())),
        "ends": pa.ListArray.from_arrays(lists, pa.array(end, pa.int64())),
    }
    return pa.RecordBatch.from_arrays([columns[c] for c in names], names)


_MAPPED = ["part", "payload", "doc_ids", "doc_id", "tie", "starts", "ends"]
_MAPPED_SCHEMA = "part int, payload binary, doc_ids binary, doc_id bigint, tie bigint, starts array<bigint>, ends array<bigint>"
_FOUND = ["doc_id", "tie", "anchor", "salt", "salts", "starts", "ends"]
_FOUND_SCHEMA = "doc_id bigint, tie bigint, anchor bigint, salt int, salts int, starts array<bigint>, ends array<bigint>"


def _ranks(ids) -> np.ndarray:
    return np.array([_NULL_ID if i is None else i for i in ids], np.int64)


def _packed_batch(packed):
    part, payload, docs = zip(*packed, strict=True)
    n = len(packed)
    row = {
        "part": pa.array(part, pa.int32()),
        "payload": pa.array(payload, pa.binary()),
        "doc_ids": pa.array(docs, pa.binary()),
        "doc_id": pa.nulls(n, pa.int64()),
        "tie": pa.nulls(n, pa.int64()),
        "starts": pa.nulls(n, pa.list_(pa.int64())),
        "ends": pa.nulls(n, pa.list_(pa.int64())),
    }
    return pa.RecordBatch.from_arrays([row[c] for c in _MAPPED], _MAPPED)


DOC = np.dtype([("rank", "<i8"), ("tie", "<i8"), ("null", "u1")])  # null tells null ids apart from the smallest number


def _map_runs(parts: int, span: int, rounds: int, turn: int):
    """Runs of a task's documents, one share of the anchors: settled where the task can, the rest sent by anchor."""
    shares = np.uint64(rounds)

    def place(anchor):
        return anchor % np.uint64(parts * rounds)

    def share(anchor):
        return place(anchor) % shares == turn

    def sent(held, ids, ties):
        runs = np.concatenate(held)
        rank = _ranks(ids)
        ties = np.array(ties, np.int64)
        runs, _, _, known = _settled(runs, rank)
        spans, runs = runs[known], runs[~known]
        if len(spans):
            start = spans["first"].astype(np.int64)
            yield _spans_batch(
                lambda n: np.arange(n) % parts, spans["doc"], start, start + spans["more"] + span, ids, ties, _MAPPED
            )
        table = np.empty(len(ids), DOC)
        table["rank"], table["tie"], table["null"] = rank, ties, [i is None for i in ids]
        part = (place(runs["anchor"]) // shares).astype(np.int64)
        order = np.argsort(part, kind="stable")
        runs, part = runs[order], part[order]
        cuts = np.searchsorted(part, np.arange(parts + 1))
        # every part numbers its own documents
        pairs, index = np.unique(part * len(ids) + runs["doc"], return_inverse=True)
        heads = np.searchsorted(pairs, np.arange(parts + 1) * len(ids))
        table = table[pairs % len(ids)]
        runs["doc"] = index - heads[part]
        packed, size = [], 0
        for p in np.flatnonzero(np.diff(cuts)).tolist():
            packed.append((p, _planes(runs[cuts[p] : cuts[p + 1]]), _planes(table[heads[p] : heads[p + 1]])))
            size += len(packed[-1][1]) + len(packed[-1][2])
            if size >= SEND_BYTES:
                yield _packed_batch(packed)
                packed, size = [], 0
        if packed:
            yield _packed_batch(packed)

    def run(batches):
        hasher = ByteHasher()
        held, ids, ties, n = [], [], [], 0
        for batch in batches:
            for first, last, buf, offsets in text_chunks(batch.column("_ul_body"), SCAN_BYTES):
                row, start, end, anchor, context, sides = text_runs(buf, offsets, hasher, span, share)
                runs = np.empty(len(row), RUN)
                runs["anchor"], runs["context"], runs["sides"] = anchor, context, sides
                runs["doc"], runs["first"], runs["more"] = row + len(ids), start - offsets[row], end - start
                held.append(runs)
                cut = batch.slice(first, last - first)
                ids += cut.column("doc_id").to_pylist()
                ties += cut.column("tie").to_pylist()
                n += len(runs)
                if n >= FLUSH_RUNS:
                    yield from sent(held, ids, ties)
                    held, ids, ties, n = [], [], [], 0
        if n:
            yield from sent(held, ids, ties)

    return run


def _may_share(group: np.ndarray, sides: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Contexts that agree with one of another rank in their group on a side of the anchor."""
    out = np.zeros(len(group), bool)
    for side in sides.T:
        at = np.flatnonzero(side)
        if len(at):
            key = group[at] << 16 | side[at]
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            heads = np.flatnonzero(np.diff(key, prepend=-1))
            differ = np.minimum.reduceat(ranks[at], heads) < np.maximum.reduceat(ranks[at], heads)
            out[at[np.repeat(differ, np.diff(heads, append=len(at)))]] = True
    return out


def _meet(span: int):
    """All runs of some anchors: settle equal contexts, pass on anchors with several of them."""

    def run(batches):
        blobs, tables, offset = [], [], 0
        for batch in batches:
            ready = batch.filter(batch.column("payload").is_null())
            if ready.num_rows:
                n = ready.num_rows
                columns = [ready.column("doc_id"), ready.column("tie"), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, ready.column("starts"), ready.column("ends")], _FOUND)
            for payload, docs in zip(batch.column("payload"), batch.column("doc_ids"), strict=True):
                if payload.is_valid:
                    runs = _from_planes(payload.as_py(), RUN)
                    runs["doc"] += offset
                    blobs.append(runs)
                    tables.append(_from_planes(docs.as_py(), DOC))
                    offset += len(tables[-1])
        if not blobs:
            return
        runs = np.concatenate(blobs)
        blobs.clear()
        table = np.concatenate(tables)
        rank, ties = np.ascontiguousarray(table["rank"]), np.ascontiguousarray(table["tie"])
        ids = [None if n else r for r, n in zip(rank.tolist(), table["null"].tolist(), strict=True)]
        runs, ranks, new, known = _settled(runs, rank)
        spans = runs[known]
        if len(spans):
            # the same document can have come in several pieces; they are merged later
            start = spans["first"].astype(np.int64)
            yield _spans_batch(None, spans["doc"], start, start + spans["more"] + span, ids, ties, _FOUND)
        group = np.ones(len(runs), bool)
        group[1:] = runs["anchor"][1:] != runs["anchor"][:-1]
        at, number = np.flatnonzero(group), np.cumsum(group) - 1
        contexts = np.add.reduceat(new, at) if len(at) else np.empty(0, np.int64)
        smallest = np.minimum.reduceat(ranks, at) if len(at) else ranks
        asks = ~known & (ranks > smallest[number])
        open_groups = np.zeros(len(at), bool)
        open_groups[number[asks]] = True
        left = np.flatnonzero(~known & open_groups[number] & (contexts[number] > 1))
        left = left[_may_share(number[left], runs["sides"][left], ranks[left])]
        if len(left):
            turn = (np.cumsum(new) - 1)[left]
            first = np.diff(turn, prepend=-1) > 0
            contexts = np.bincount(number[left], first)
            salts = -(-contexts[number[left]].astype(np.int64) // CONTEXTS)
            turn = np.cumsum(first) - 1
            start = runs["first"][left].astype(np.int64)
            lists = pa.array(np.arange(len(left) + 1), pa.int32())
            doc = runs["doc"][left]
            columns = [
                pa.array([ids[i] for i in doc], pa.int64()),
                pa.array(ties[doc], pa.int64()),
                pa.array(runs["anchor"][left].view(np.int64)),
                pa.array(turn % salts, pa.int32()),
                pa.array(salts, pa.int32()),
                pa.ListArray.from_arrays(lists, pa.array(start)),
                pa.ListArray.from_arrays(lists, pa.array(start + runs["more"][left] + span)),
            ]
            yield pa.RecordBatch.from_arrays(columns, _FOUND)

    return run


# ---------------------------------------------------------------- suffix arrays


def interval_tree(lcp: list[int], rank: list[int], left: list[int], least: int):
    """Stack scan over an enhanced suffix array.

    ``lcp[i]`` is the common prefix length of suffixes i - 1 and i. Yields each interval with a common
    prefix of at least ``least``, inner ones first: (length, first, last, maximal, open leaves with a
    smaller rank inside, the smallest rank). ``maximal``: the letters in front of the occurrences differ,
    or some occurrence has none (negative). An open leaf is listed in its deepest such interval only.
    """
    stack: list[list] = []  # length, first, smallest rank, letter in front (None: different), open leaves

    def absorb(top, low, letter, leaves):
        top[2] = min(top[2], low)
        if top[3] != letter:
            top[3] = None
        top[4] += leaves

    n = len(rank)
    for i in range(1, n + 1):
        depth = lcp[i] if i < n else 0
        first, low, letter, leaves = i - 1, rank[i - 1], (left[i - 1] if left[i - 1] >= 0 else None), [i - 1]
        while stack and stack[-1][0] > depth:
            absorb(stack[-1], low, letter, leaves)
            length, first, low, letter, leaves = stack.pop()
            yield length, first, i - 1, letter is None, [j for j in leaves if rank[j] > low], low
            leaves = [j for j in leaves if rank[j] == low]
        if stack and stack[-1][0] == depth:
            absorb(stack[-1], low, letter, leaves)
        elif depth >= least:
            stack.append([depth, first, low, letter, leaves])


def suffix_array(anchors: np.ndarray, bodies: list[bytes], starts: np.ndarray, lengths: np.ndarray, width: int):
    """Sort string starts by anchor and text: (order, common prefix lengths of neighbours).

    ``bodies`` is one buffer; a start's text is at most ``width`` bytes and ends with its context.
    """
    n = len(starts)
    matrix = np.zeros((n, 8 + width), np.uint8)
    matrix[:, :8] = anchors.astype(">u8").view(np.uint8).reshape(n, 8)
    column = np.arange(width)
    for a in range(0, n, 1 << 16):
        b = slice(a, a + (1 << 16))
        inside = column[None, :] < lengths[b, None]
        matrix[b, 8:] = np.where(inside, bodies[np.where(inside, starts[b, None] + column, 0)], 0)
    order = np.argsort(matrix.view(f"S{8 + width}").ravel(), kind="stable")
    lcp = np.zeros(n, np.int64)
    for a in range(1, n, 1 << 16):
        rows = np.arange(a, min(n, a + (1 << 16)))
        differ = matrix[order[rows]] != matrix[order[rows - 1]]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), 8 + width)
        lcp[rows] = np.minimum(np.maximum(first - 8, 0), np.minimum(lengths[order[rows]], lengths[order[rows - 1]]))
        lcp[rows[first < 8]] = 0
    return order, lcp


_SEGMENTS = ["anchor", "salt", "salts", "doc_id", "tie", "start", "front", "body"]
_SEGMENTS_SCHEMA = "anchor bigint, salt int, salts int, doc_id bigint, tie bigint, start bigint, front int, body binary"


def _cut_segments(batches):
    """Contexts of the listed runs, each with the byte in front."""
    for batch in batches:
        for row in range(batch.num_rows):
            data = batch.column("_ul_body")[row].as_py() or b""
            listed = batch.column("asked")[row].as_py()
            out = {name: [] for name in _SEGMENTS}
            for ask in listed:
                start, end = ask["start"], ask["end"]
                for name, value in (("anchor", ask["anchor"]), ("salt", ask["salt"]), ("salts", ask["salts"]), ("start", start)):
                    out[name].append(value)
                out["front"].append(data[start - 1] if start else -1)
                out["body"].append(data[start:end])
            n = len(listed)
            out["doc_id"], out["tie"] = [batch.column("doc_id")[row].as_py()] * n, [batch.column("tie")[row].as_py()] * n
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in zip(_SEGMENTS, kinds, strict=True)], _SEGMENTS)


_LEAVES = ["doc_id", "tie", "start", "end", "string", "maximal"]
_LEAVES_SCHEMA = "doc_id bigint, tie bigint, start bigint, end bigint, string bigint, maximal boolean"


def _scan_segments(span: int):
    """Suffix array and interval tree of a partition's contexts: repeated occurrences, and open ones of
    anchors that were split (``string`` is then the hash of the start's string)."""

    def run(batches):
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        sizes = np.array([len(x.as_buffer()) for c in table.column("body").chunks for x in c])
        bodies = np.frombuffer(b"".join(x.as_py() for c in table.column("body").chunks for x in c), np.uint8)
        base = np.cumsum(sizes) - sizes
        starts_each = sizes - span + 1
        which = np.repeat(np.arange(len(sizes)), starts_each)
        turn = np.arange(len(which)) - np.repeat(np.cumsum(starts_each) - starts_each, starts_each)
        at, length = base[which] + turn, sizes[which] - turn
        anchor = np.array(table.column("anchor").to_numpy(), np.int64).view(np.uint64)
        salt, salts = table.column("salt").to_numpy(), table.column("salts").to_numpy()
        ids, ties = table.column("doc_id").to_pylist(), np.array(table.column("tie").to_numpy())
        rank, front, start = _ranks(ids), table.column("front").to_numpy(), table.column("start").to_numpy()
        key = mix(anchor + salt.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) if salts.max() > 1 else anchor
        order, lcp = suffix_array(key[which], bodies, at, length, int(sizes.max()))
        fronts = np.where(turn == 0, front[which], bodies[np.maximum(at - 1, 0)])
        ranks = rank[which]
        rows = {name: [] for name in ("at", "end", "maximal")}
        open_leaf = np.ones(len(order), bool)
        # stretches of suffixes with long common prefixes are trees of their own
        deep = np.concatenate([lcp >= span, [False]])
        begins = np.flatnonzero(deep[1:] & ~deep[:-1])
        ends = np.flatnonzero(~deep[1:] & deep[:-1])
        for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
            mine = order[a : b + 1]
            low = ranks[mine]
            if low.min() == low.max():
                continue
            for depth, _, _, maximal, done, _ in interval_tree(lcp[a : b + 1].tolist(), low.tolist(), fronts[mine].tolist(), span):
                for j in done:
                    leaf = int(mine[j])
                    rows["at"].append(leaf)
                    rows["end"].append(depth)
                    rows["maximal"].append(maximal)
                    open_leaf[leaf] = False
        leaf = np.array(rows["at"], np.int64)
        split = np.flatnonzero(open_leaf & (salts[which] > 1))
        string = np.full(len(leaf) + len(split), 0, np.int64)
        if len(split):
            hasher = ByteHasher(2)
            hasher.load(bodies)
            string[len(leaf) :] = mix(hasher.between(at[split], at[split] + span) ^ anchor[which[split]]).view(np.int64)
        everything = np.concatenate([leaf, split])
        place = start[which[everything]] + turn[everything]
        depth = np.concatenate([np.array(rows["end"], np.int64), np.full(len(split), span)])
        is_open = np.arange(len(everything)) >= len(leaf)
        columns = [
            pa.array([ids[i] for i in which[everything]], pa.int64()),
            pa.array(ties[which[everything]], pa.int64()),
            pa.array(place, pa.int64()),
            pa.array(place + depth, pa.int64()),
            pa.array(string, pa.int64(), mask=~is_open),
            pa.array([*rows["maximal"], *([False] * len(split))], pa.bool_()),
        ]
        yield pa.RecordBatch.from_arrays(columns, _LEAVES)

    return run


# ---------------------------------------------------------------- operator


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _keyed(docs: DataFrame) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(body).alias("tie"), body.cast("binary").alias("_ul_body"))


def repeated_spans(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id, tie (hash of the text), starts, ends: bytes that repeat a smaller document, unmerged spans.

    Documents without any do not appear. ``docs`` must be re-readable.
    """
    rows, parts = _keyed(docs), _parts(docs)
    each = -(-parts // ROUNDS)
    found = None
    for turn in range(ROUNDS):
        sent = rows.mapInArrow(_map_runs(each, span, ROUNDS, turn), _MAPPED_SCHEMA)
        met = stored(sent.repartitionById(each, "part").mapInArrow(_meet(span), _FOUND_SCHEMA), "runs")
        found = met if found is None else found.unionByName(met)
    asked = found.where("anchor IS NOT NULL").select(
        F.col("doc_id").alias("_ul_id"),
        F.col("tie").alias("_ul_tie"),
        F.struct("anchor", "salt", "salts", F.col("starts")[0].alias("start"), F.col("ends")[0].alias("end")).alias("ask"),
    )
    asked = asked.groupBy("_ul_id", "_ul_tie").agg(F.array_distinct(F.collect_list("ask")).alias("asked"))
    # a repeated row asks the same twice; one copy answers for all
    joined = rows.join(asked, F.col("doc_id").eqNullSafe(F.col("_ul_id")) & (F.col("tie") == F.col("_ul_tie")))
    segments = joined.select("doc_id", "tie", "asked", "_ul_body").mapInArrow(_cut_segments, _SEGMENTS_SCHEMA)
    leaves = stored(segments.repartition(parts, "anchor", "salt").mapInArrow(_scan_segments(span), _LEAVES_SCHEMA), "leaves")
    rank = F.coalesce(F.col("doc_id"), F.lit(_NULL_ID))
    waiting = leaves.where("string IS NOT NULL")
    lowest = waiting.groupBy(F.col("string").alias("_ul_string")).agg(F.min(rank).alias("_ul_rank"), F.max(rank).alias("_ul_top")).where("_ul_rank < _ul_top")
    late = waiting.join(lowest, F.col("string") == F.col("_ul_string")).where(rank > F.col("_ul_rank"))
    spans = leaves.where("string IS NULL").select("doc_id", "tie", "start", "end").unionByName(late.select("doc_id", "tie", "start", "end"))
    spans = spans.select("doc_id", "tie", F.array("start").alias("starts"), F.array("end").alias("ends"))
    return found.where("anchor IS NULL").select("doc_id", "tie", "starts", "ends").unionByName(spans)


def _removed(batches):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        out = {name: [] for name in names[1:]}
        for i in range(batch.num_rows):
            data = batch.column("_ul_body")[i].as_py() or b""
            starts, ends = batch.column("starts")[i].as_py(), batch.column("ends")[i].as_py()
            kept, removed, spans, at = [], 0, 0, 0
            if starts:
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, starts, 1)
                np.add.at(edge, ends, -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed = int(gone.sum())
                turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                for s, e in turns.reshape(-1, 2).tolist():
                    kept.append(data[at:s])
                    spans, at = spans + 1, e
            kept.append(data[at:])
            values = (len(data), removed, spans, hashlib.sha256(b"".join(kept)).hexdigest())
            for name, value in zip(names[1:], values, strict=True):
                out[name].append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(out[n], k) for n, k in zip(names[1:], kinds, strict=True))], names
        )


def without_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """Digest of all documents: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spans = repeated_spans(docs, span)
    lists = spans.groupBy(F.col("doc_id").alias("_ul_id"), F.col("tie").alias("_ul_tie")).agg(
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends")
    )
    lists = stored(lists, "spans")
    rows = _keyed(docs)
    joined = rows.join(lists, F.col("doc_id").eqNullSafe(F.col("_ul_id")) & (F.col("tie") == F.col("_ul_tie")), "left")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return joined.select("doc_id", "_ul_body", "starts", "ends").mapInArrow(_removed, schema)
