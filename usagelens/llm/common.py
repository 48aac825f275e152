"""Helpers that several operators share: stored intermediates, text buffers, hashes of bytes and words."""

from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from usagelens.session import materialized

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession):
    """Shuffle files of a finished action are removed at once instead of at some later collection."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, safe when executors are lost."""
    with released_shuffles(df.sparkSession):
        return materialized(df, label)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- inside tasks

CHUNK_BYTES = 4 << 20  # bytes of text that a task works on at a time; a longer document is taken alone

_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BASE = 0xD1342543DE82EF95  # odd, hence invertible modulo 2**64


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers, one to one."""
    x = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def seeded(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit integers."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(_STEP))


class ByteHasher:
    """Hashes of arbitrary substrings of a byte buffer, from one running sum."""

    def __init__(self, seed: int = 1):
        self.letters = seeded(256, seed)
        self.powers = self.inverses = np.empty(0, np.uint64)

    def load(self, buf: np.ndarray) -> None:
        n = len(buf) + 1
        if n > len(self.powers):
            size = max(n, CHUNK_BYTES)
            for name, base in (("powers", _BASE), ("inverses", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(self.letters[buf] * self.powers[: n - 1], out=self.sums[1:])

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Scrambled hashes of buf[start:end]; the lengths take part."""
        raw = (self.sums[end] - self.sums[start]) * self.inverses[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(_STEP))


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow text column as its UTF-8 bytes and the n + 1 offsets of its rows; nulls are empty."""
    import pyarrow as pa

    column = column.cast(pa.large_binary()).fill_null(b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def text_chunks(column, limit: int = CHUNK_BYTES):
    """(first row, last row + 1, bytes, offsets) of consecutive rows with about ``limit`` bytes each."""
    buf, offsets = text_buffer(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last, buf[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


SPACES = b" \t\n\r\x0b\x0c"


def byte_class(members) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(members)] = True
    return flags


NOT_SPACE = ~byte_class(SPACES)


def word_spans(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_SPACE):
    """Start, end and row of every maximal run of ``inside`` bytes that stays in one row."""
    flag = inside[buf]
    begins = np.zeros(len(buf) + 1, bool)
    begins[offsets] = True
    first = flag.copy()
    first[1:] &= ~flag[:-1] | begins[1:-1]
    last = flag.copy()
    last[:-1] &= ~flag[1:] | begins[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1
