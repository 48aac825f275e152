"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Patterns are the windows of the benchmark: every ``width`` consecutive words of an item, or all words of a
shorter item. Words are runs of ASCII letters (lower-cased), digits and characters beyond ASCII. Patterns
of equal length are searched together:

* a *shift table*, indexed by the hash of the last one or two words under the search position, tells how
  far the position can move without missing an occurrence; blocks of no pattern allow the longest step;
* where the shift is zero, the hash of the pattern's last words selects a *bucket* of patterns;
* each pattern of the bucket is compared with the text, first by word hashes, then by its bytes.

A task searches all texts of a batch in lockstep: texts are cut into lanes of equal length that overlap by
a pattern less one word, and each step moves every lane by its own shift.

The patterns are collected slice by slice, at most ``MAX_PATTERNS`` windows each, and shipped with the
task; a larger benchmark means more passes over the documents, nothing is left out. Null and empty texts
have no words, null items no windows; repeated items and windows count once, repeated documents are
searched like any other. A null item id is written as an empty string. Extra columns are ignored by the
digest and kept by ``clean_documents``. Empty tables on either side give documents without hits.
"""

import hashlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import ByteHasher, byte_class, mix, text_chunks, word_spans

WIDTH = 10
LANE = 512  # words
MAX_PATTERNS = 200_000
TABLE_BITS = 20
CHUNK = 1 << 20  # bytes of text at a time; every byte takes part in several arrays of numbers

_WORD = byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """The words of one text, for building patterns."""
    buf = _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    start, end, _ = word_spans(buf, np.array([0, len(buf)]), _WORD)
    data = buf.tobytes()
    return [data[s:e] for s, e in zip(start.tolist(), end.tolist(), strict=True)]


@dataclass
class Patterns:
    """All windows of one length: tables for the search, and the items that each window belongs to."""

    length: int
    block: int
    shift: np.ndarray
    bucket_keys: np.ndarray
    bucket_first: np.ndarray
    hashes: np.ndarray
    texts: list[bytes]
    items: list[list[str]]


def _blocks(words: np.ndarray, block: int) -> np.ndarray:
    """Hash of the block that ends at each word; entry i belongs to words[i : i + block]."""
    n = len(words) - block + 1
    key = np.zeros(max(n, 0), np.uint64)
    for i in range(block):
        key = key * _ODD + words[i : i + len(key)]
    return mix(key)


def compile_patterns(windows: dict[tuple[bytes, ...], list[str]]) -> list[Patterns]:
    """Tables for every window length that occurs."""
    by_length = defaultdict(list)
    for words, items in windows.items():
        by_length[len(words)].append((words, items))
    return [_tables(length, found) for length, found in sorted(by_length.items())]


def _tables(length: int, found) -> Patterns:
    hasher = ByteHasher()
    flat = b" ".join(w for words, _ in found for w in words)
    sizes = np.array([len(w) for words, _ in found for w in words])
    end = np.cumsum(sizes + 1) - 1
    hasher.load(np.frombuffer(flat, np.uint8))
    hashes = hasher.between(end - sizes, end).reshape(len(found), length)
    block = min(2, length)
    shift = np.full(1 << TABLE_BITS, length - block + 1, np.int64)
    mask = np.uint64((1 << TABLE_BITS) - 1)
    suffix = None
    for at in range(length - block + 1):  # block hashes[:, at : at + block], so far from the end
        key = np.zeros(len(found), np.uint64)
        for i in range(block):
            key = key * _ODD + hashes[:, at + i]
        suffix = mix(key)
        np.minimum.at(shift, (suffix & mask).astype(np.int64), length - block - at)
    order = np.argsort(suffix, kind="stable")
    keys, first = np.unique(suffix[order], return_index=True)
    return Patterns(
        length,
        block,
        shift,
        keys,
        np.append(first, len(order)),
        hashes[order],
        [b" ".join(found[i][0]) for i in order],
        [found[i][1] for i in order],
    )


def search(words: np.ndarray, counts: np.ndarray, patterns: Patterns):
    """(first word, pattern) of every agreement by word hashes; ``counts`` are the words of each text."""
    length, block = patterns.length, patterns.block
    begin = np.cumsum(counts) - counts
    lanes = np.where(counts >= length, -(-np.maximum(counts - length + 1, 0) // LANE), 0)
    text = np.repeat(np.arange(len(counts)), lanes)
    turn = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    # a lane's position is the last word of the window under search
    at = begin[text] + turn * LANE + length - 1
    stop = np.minimum(at + LANE, begin[text] + counts[text])
    keys = _blocks(words, block)
    jump = patterns.shift[(keys & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)]
    spots = []
    while len(at):
        step = jump[at - block + 1]
        zero = step == 0
        spots.append(at[zero])
        at = at + np.where(zero, 1, step)
        live = at < stop
        if not live.all():
            at, stop = at[live], stop[live]
    ends = np.concatenate(spots) if spots else np.empty(0, np.int64)
    if not len(ends):
        return ends, ends
    suffix = keys[ends - block + 1]
    bucket = np.minimum(np.searchsorted(patterns.bucket_keys, suffix), len(patterns.bucket_keys) - 1)
    same = patterns.bucket_keys[bucket] == suffix
    ends, bucket = ends[same], bucket[same]
    size = patterns.bucket_first[bucket + 1] - patterns.bucket_first[bucket]
    starts, found = [], []
    for piece in np.array_split(np.arange(len(ends)), max(1, int(size.sum()) // 500_000)):
        n = size[piece]
        which = np.repeat(patterns.bucket_first[bucket[piece]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(ends[piece] - length + 1, n)
        for i in range(length):
            agree = words[start + i] == patterns.hashes[which, i]
            start, which = start[agree], which[agree]
        starts.append(start)
        found.append(which)
    return np.concatenate(starts), np.concatenate(found)


def find(buf: np.ndarray, offsets: np.ndarray, compiled: list[Patterns], hasher: ByteHasher):
    """For each text: words, hit words, sorted item ids, and (first byte, end byte) runs of hit words."""
    n = len(offsets) - 1
    buf = _LOWER[buf]
    start, end, row = word_spans(buf, offsets, _WORD)
    hasher.load(buf)
    words = hasher.between(start, end)
    counts = np.bincount(row, minlength=n)
    cover = np.zeros(len(words) + 1, np.int64)
    items: list[set[str]] = [set() for _ in range(n)]
    for patterns in compiled:
        first, which = search(words, counts, patterns)
        for s, p in zip(first.tolist(), which.tolist(), strict=True):
            e = s + patterns.length
            # direct comparison: the bytes of the words
            if b" ".join(buf[a:b].tobytes() for a, b in zip(start[s:e].tolist(), end[s:e].tolist(), strict=True)) == patterns.texts[p]:
                cover[s] += 1
                cover[e] -= 1
                items[row[s]].update(patterns.items[p])
    hit = np.cumsum(cover[:-1]) > 0
    hits = np.bincount(row[hit], minlength=n)
    return counts, hits, items, (start, end, row, hit)


def windows_of(items, width: int = WIDTH) -> dict[tuple[bytes, ...], list[str]]:
    """Distinct windows of (item id, text) rows, each with the ids it occurs in."""
    windows: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for item, text in items:
        words = words_of(text or "")
        for i in range(max(1, len(words) - width + 1) if words else 0):
            windows[tuple(words[i : i + width])].add("" if item is None else str(item))
    return {w: sorted(ids) for w, ids in windows.items()}


def pattern_slices(benchmark: DataFrame, width: int = WIDTH, most: int = MAX_PATTERNS):
    """The benchmark's windows in slices of at most about ``most``, read one slice at a time.

    A window has at least as many letters as words, so the texts' lengths bound the number of windows.
    Only the count and one slice at a time are on the driver.
    """
    total = benchmark.select(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-total // (most * 2)))
    for turn in range(slices):
        part = benchmark if slices == 1 else benchmark.where(F.pmod(F.xxhash64("text"), F.lit(slices)) == turn)
        yield compile_patterns(windows_of(part.select("item_id", "text").distinct().collect(), width))


def _searcher(compiled: list[Patterns]):
    def run(batches):
        hasher = ByteHasher()
        for batch in batches:
            for first, last, buf, offsets in text_chunks(batch.column("_ul_body"), CHUNK):
                counts, hits, items, (_, _, row, hit) = find(buf, offsets, compiled, hasher)
                begin = np.cumsum(counts) - counts
                places = defaultdict(list)
                for at in np.flatnonzero(hit).tolist():
                    places[int(row[at])].append(at - int(begin[row[at]]))
                cut = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [
                        cut.column("doc_id"),
                        cut.column("_ul_key"),
                        pa.array(counts, pa.int64()),
                        pa.array([places.get(i, []) for i in range(len(counts))], pa.list_(pa.int64())),
                        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    ],
                    ["doc_id", "_ul_key", "n_words", "hits", "items"],
                )

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, most: int = MAX_PATTERNS) -> DataFrame:
    """doc_id, n_words, hits (places of the hit words), items (sorted ids), one row per document row."""
    kind = dict(docs.dtypes)["doc_id"]
    # the key only serves to bring the passes of several slices together
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("_ul_key"), F.col("text").alias("_ul_body"))
    schema = f"doc_id {kind}, _ul_key bigint, n_words bigint, hits array<bigint>, items array<string>"
    passes = [rows.mapInArrow(_searcher(compiled), schema) for compiled in pattern_slices(benchmark, width, most)]
    if len(passes) == 1:
        return passes[0].drop("_ul_key")
    merged = passes[0]
    for other in passes[1:]:
        merged = merged.unionByName(other)
    together = merged.groupBy("doc_id", "_ul_key").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return together.drop("_ul_key")


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest of all documents: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = contamination(docs, benchmark)
    n_hit = F.size("hits").cast("long")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def _dropper(compiled: list[Patterns], names: list[str]):
    def run(batches):
        hasher = ByteHasher()
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for first, last, buf, offsets in text_chunks(batch.column("_ul_body"), CHUNK):
                keep[first:last] = find(buf, offsets, compiled, hasher)[1] == 0
            yield batch.select(names).filter(pa.array(keep))

    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no window occurs, with their columns; no shuffle."""
    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes)
    names, kept = docs.columns, docs
    for compiled in pattern_slices(benchmark):
        kept = kept.withColumn("_ul_body", F.col("text")).mapInArrow(_dropper(compiled, names), schema)
    return kept


def sorted_items_digest(items: list[str]) -> str:
    """What ``items_sha256`` holds, for one document."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
