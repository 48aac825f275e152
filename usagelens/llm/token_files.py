"""Token ids of documents in compact binary form: canonical, length-limited Huffman codes.

Writing: every text is tokenized once and its ids are stored; ids are counted over all documents; package
merge turns the counts into code lengths of at most ``LONGEST`` bits, and the lengths alone define the
canonical codes. Documents are laid out in id order, packed into blocks, and written.

Format: a folder with two Parquet tables, which Spark writes and commits, so that lost executors leave
nothing half written and readers split the work.

* ``codes`` (id, length): the code lengths of the ids that occur. Codes ascend by length, then id.
* ``blocks``: one row per block, readable without any other. ``part`` and ``block`` give the order;
  ``before`` counts the ids of the part in front of the block; ``doc_ids`` and ``sizes`` list the whole
  documents in it; ``payload`` holds the codes, most significant bit first, without gaps between
  documents; ``checkpoints`` holds the bit offset of every ``STRIDE``-th id.

Reading: between two checkpoints codes depend on nothing before, so a reader walks all stretches of many
blocks in lockstep, one table look-up per id: the next ``LONGEST`` bits give the id and its code's length.

Null and empty texts are documents with the end id only. Documents with equal ids keep any order among
themselves, by a hash of the text; null ids come first. A very long document is one block. Extra columns
are ignored. An empty table gives an empty one.
"""

import re
import sys
import zlib
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.common import byte_class, mix, released_shuffles, stored, text_chunks, word_spans
from usagelens.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
LONGEST = 16
STRIDE = 256
BLOCK_IDS = 1 << 15
CACHED_WORDS = 2_000_000  # in one Python worker, about 40 bytes each
WORDS_AT_A_TIME = 10_000


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ---------------------------------------------------------------- ids


class WordTokens:
    """Ids of texts, word by word.

    The vocabulary never joins characters across white space, so a text's ids are those of its words, one
    after another; words recur, and the ids of recent ones are kept (``KnownWords``). New words are encoded many at
    a time, as lines of one text; the places of the tokens tell which line they belong to. Words of letters that the
    normalizer would leave alone skip it. A text that holds one of the vocabulary's added tokens, which are
    found before anything else is done to a text, is encoded whole.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # lowering would make added tokens of others
        self.added = [token.content.encode().lower() for token in self.tokenizer.get_added_tokens_decoder().values()]
        # for lines of plain lower-case letters: they are in normal form and one piece each
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split("\n", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.end = np.array([end_id], "<u2")
        self.known = KnownWords(self.end)

    def learnt(self, words: list[bytes]):
        """(places in ``words``, their ids one after another, ids per word), group by group."""
        for first in range(0, len(words), WORDS_AT_A_TIME):
            lines = b"\n".join(words[first : first + WORDS_AT_A_TIME]).decode("utf-8", "replace").split("\n")
            bare = [i for i, line in enumerate(lines) if _in_normal_form(line)]
            rest = sorted(set(range(len(lines))) - set(bare))
            letters = [i for i in rest if lines[i].isalpha() and lines[i].lower().isalpha()]
            others = sorted(set(rest) - set(letters))
            for chosen, lengths in ((bare, self._bare), (letters, self._one_piece_each), (others, self._any)):
                if chosen:
                    yield np.array(chosen) + first, *lengths([lines[i] for i in chosen])

    def _bare(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self._one_piece_each(lines, self.letters)

    def _one_piece_each(self, lines: list[str], tokenizer=None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number per line for lines of letters: each ends with the one token that ends a word."""
        tokenizer = tokenizer or self.tokenizer
        ids = np.array(tokenizer.encode_batch_fast(["\n".join(lines)], add_special_tokens=False)[0].ids, np.int64)
        ends = np.flatnonzero(self.ends_word[ids])
        if len(ends) != len(lines):
            return self._any(lines)
        return ids.astype("<u2"), np.diff(ends, prepend=-1)

    def _any(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for any lines, by the places of the tokens."""
        found = self.tokenizer.encode("\n".join(lines), add_special_tokens=False)
        line = np.searchsorted(np.cumsum([len(x) + 1 for x in lines]), [o[0] for o in found.offsets], "right")
        return np.array(found.ids, "<u2"), np.bincount(line, minlength=len(lines))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, without an end id."""
        offsets = np.cumsum([0, *(len(text) for text in texts)])
        ids, ends = self.encode_rows(b"".join(texts), offsets)
        at = ends.tolist()
        return [ids[a : b - 1].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]

    def encode_rows(self, data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows of a text buffer, each with the end id, and the n + 1 places where they begin and end."""
        n = len(offsets) - 1
        lowered = data.lower()
        whole = sorted({row for token in self.added for row in _rows_with(token, lowered, offsets)})
        # capitals are lowered anyway, but after characters are composed: not where a combining mark could follow
        buf = np.frombuffer(lowered + bytes(WINDOW), np.uint8).copy()
        given = np.frombuffer(data, np.uint8)
        if b"\xcc" in data or b"\xcd" in data:
            for row in np.unique(np.searchsorted(offsets, np.flatnonzero((given == 0xCC) | (given == 0xCD)), "right") - 1).tolist():
                buf[offsets[row] : offsets[row + 1]] = given[offsets[row] : offsets[row + 1]]
        for row in whole:
            buf[offsets[row] : offsets[row + 1]] = ord(" ")
        start, end, row = word_spans(buf[: len(given)], offsets)
        # a mark behind a letter is a piece of its own: with it, there would be one word more to be kept
        marked = (end - start > 1) & _MARK[buf[end - 1]] & _LETTER[buf[end - 2]]
        # pieces: words, marks, and the end of each row
        extra = np.cumsum(marked)
        at = np.arange(len(start)) + extra - marked + row
        before = np.searchsorted(row, np.arange(n), "right")
        ends = before + np.concatenate([[0], extra])[before] + np.arange(n)
        pieces = np.ones(len(start) + int(marked.sum()) + n, np.int64)
        from_, to = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        from_[at], to[at] = start, end - marked
        from_[at[marked] + 1], to[at[marked] + 1] = end[marked] - 1, end[marked]
        is_word = np.ones(len(pieces), bool)
        is_word[ends] = False
        pieces[is_word] = self.known.entries(buf, from_[is_word], to[is_word], self.learnt)
        ids, after = self.known.ids(pieces)
        bounds = np.concatenate([[0], after[ends]])
        return self._with_whole(ids, bounds, whole, data, offsets) if whole else (ids, bounds)

    def _with_whole(self, ids, bounds, whole: list[int], data: bytes, offsets):
        parts = np.split(ids, bounds[1:-1])
        for row in whole:
            text = data[offsets[row] : offsets[row + 1]].decode("utf-8", "replace")
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
            parts[row] = np.concatenate([np.array(found, "<u2"), self.end])
        return np.concatenate(parts), np.cumsum([0, *(len(part) for part in parts)])


WINDOW = 8  # bytes of a word that are hashed at a time
LONGEST_WORD = 64  # bytes; longer ones are not kept


class KnownWords:
    """Ids of words by 128 bits of hash: an open-addressing table over flat arrays, which costs about 40 bytes a word.

    Entry 0 is nothing, entry 1 the end of a text. Beyond ``CACHED_WORDS`` all is forgotten and learnt again.
    """

    def __init__(self, end: np.ndarray):
        self.end = end
        self.clear()

    def clear(self) -> None:
        self.slots = np.zeros(1 << 12, np.int32)
        self.keys = np.zeros((2, 1 << 11), np.uint64)
        self.starts, self.sizes = np.zeros(1 << 11, np.int64), np.zeros(1 << 11, np.int32)
        self.flat = np.zeros(1 << 13, "<u2")
        self.n, self.used = 1, 0
        self._append(self.end, np.ones(1, np.int64))

    def entries(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray, learnt) -> np.ndarray:
        """The entry of every word ``buf[start:end]``; ``learnt`` encodes those that have none."""
        long = end - start > LONGEST_WORD
        out = np.zeros(len(start), np.int64)
        short = np.flatnonzero(~long)
        keys = word_keys(buf, start[short], end[short])
        found = self._find(keys)
        new = np.flatnonzero(found == 0)
        if len(new):
            new = new[_firsts(keys[:, new])]
            if self.n + len(new) > CACHED_WORDS:
                self.clear()
                new = _firsts(keys)
            self._learn(buf, start[short[new]], end[short[new]], learnt, keys[:, new])
            found = self._find(keys)
        out[short] = found
        if long.any():
            # for this call only: later entries take their places
            n, used = self.n, self.used
            out[long] = self._learn(buf, start[long], end[long], learnt)
            self.n, self.used = n, used
        return out

    def _learn(self, buf, start, end, learnt, keys: np.ndarray | None = None) -> np.ndarray:
        words = [buf[a:b].tobytes() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        out = np.zeros(len(words), np.int64)
        for places, ids, counts in learnt(words):
            out[places] = np.arange(self.n, self.n + len(places))
            self._append(ids, counts)
            if keys is not None:
                self.keys[:, out[places]] = keys[:, places]
                self._insert(out[places])
        return out

    def _append(self, ids: np.ndarray, counts: np.ndarray) -> None:
        n, used = self.n + len(counts), self.used + len(ids)
        while n > len(self.starts):
            self.starts, self.sizes = _doubled(self.starts), _doubled(self.sizes)
            self.keys = np.concatenate([self.keys, np.zeros_like(self.keys)], axis=1)
        while used > len(self.flat):
            self.flat = _doubled(self.flat)
        ends = np.cumsum(counts)
        self.starts[self.n : n], self.sizes[self.n : n] = self.used + ends - counts, counts
        self.flat[self.used : used] = ids
        self.n, self.used = n, used

    def _insert(self, entries: np.ndarray) -> None:
        if 2 * self.n > len(self.slots):
            while 2 * self.n > len(self.slots):
                self.slots = _doubled(self.slots)
            self.slots[:] = 0
            entries = np.arange(2, self.n)
        mask = len(self.slots) - 1
        place = (self.keys[0, entries] & np.uint64(mask)).astype(np.int64)
        while len(entries):
            free = self.slots[place] == 0
            self.slots[place[free]] = entries[free]  # of several, one stays
            left = self.slots[place] != entries
            entries, place = entries[left], (place[left] + 1) & mask

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The entries of the keys, 0 for unknown ones."""
        out = np.zeros(keys.shape[1], np.int64)
        mask = len(self.slots) - 1
        left = np.arange(len(out))
        place = (keys[0] & np.uint64(mask)).astype(np.int64)
        while len(left):
            entry = self.slots[place]
            same = (self.keys[0, entry] == keys[0, left]) & (self.keys[1, entry] == keys[1, left]) & (entry > 0)
            out[left[same]] = entry[same]
            on = ~same & (entry > 0)
            left, place = left[on], (place[on] + 1) & mask
        return out

    def ids(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the entries, one after another, and the place after each entry's."""
        sizes = self.sizes[entries].astype(np.int64)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[entries] - (ends - sizes), sizes) + np.arange(total)], ends


def _doubled(values: np.ndarray) -> np.ndarray:
    return np.concatenate([values, np.zeros_like(values)])


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where each distinct key stands first."""
    order = np.lexsort((keys[1], keys[0]))
    new = np.ones(len(order), bool)
    new[1:] = (keys[:, order[1:]] != keys[:, order[:-1]]).any(axis=0)
    return order[new]


def word_keys(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of every ``buf[start:end]``; ``WINDOW`` bytes follow the last word in ``buf``."""
    windows = np.ndarray((max(0, len(buf) - WINDOW + 1),), "<u8", buf, strides=(1,))
    size = (end - start).astype(np.uint64)
    first, second = size * _ODD, size + _ODD
    left, at, size = np.arange(len(start)), start, end - start
    while len(left):
        # bytes behind the word's end are shifted out
        cut = (8 * np.maximum(WINDOW - size, 0)).astype(np.uint64)
        value = (windows[at] << cut) >> cut
        first[left] = mix(first[left] + value)
        second[left] = mix((second[left] ^ value) * _ODD)
        on = size > WINDOW
        left, at, size = left[on], at[on] + WINDOW, size[on] - WINDOW
    return np.stack([first, second])


def _rows_with(token: bytes, data: bytes, offsets: np.ndarray):
    """Rows that a match of the token begins in."""
    at = data.find(token)
    while at >= 0:
        row = int(np.searchsorted(offsets, at, "right")) - 1
        yield row
        at = data.find(token, int(offsets[row + 1]))


_ODD = np.uint64(0x9E3779B97F4A7C15)
_MARK = byte_class(b",.")
_LETTER = byte_class(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_PLAIN_LETTERS = re.compile("[a-zß-öø-ÿ]+")


def _in_normal_form(word: str) -> bool:
    """Lower-case letters of Latin-1, none of which composing or lowering would change."""
    return _PLAIN_LETTERS.fullmatch(word) is not None


def _word_tokens(path: str, end_id: int) -> WordTokens:
    """One for each Python worker: a worker serves many tasks, and what it has learnt helps the next."""
    kept = sys.modules.setdefault("_usagelens_word_tokens", ModuleType("_usagelens_word_tokens")).__dict__
    name = f"{end_id} {path}"
    if name not in kept:
        kept[name] = WordTokens(path, end_id)
    return kept[name]


def _tokenized(path: str, end_id: int):
    def run(batches):
        tokens = None
        for batch in batches:
            tokens = tokens or _word_tokens(path, end_id)
            for first, last, buf, offsets in text_chunks(batch.column("_ul_body"), 1 << 20):
                ids, bounds = tokens.encode_rows(buf.tobytes(), offsets)
                places = pa.py_buffer((2 * bounds).astype(np.int32))
                packed = pa.Array.from_buffers(pa.binary(), last - first, [None, places, pa.py_buffer(ids)])
                cut = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([cut.column("doc_id"), cut.column("tie"), packed], ["doc_id", "tie", "ids"])

    return run


def token_ids(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, tie (hash of the text), ids (little-endian 16-bit numbers, with the end id)."""
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), F.col("text").alias("_ul_body"))
    return rows.mapInArrow(_tokenized(path, end_id), f"doc_id {kind}, tie bigint, ids binary")


def id_counts(ids: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents; one row per id of the vocabulary reaches the driver."""
    rows = ids.select("ids").mapInArrow(_tallied, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 << 16, np.int64)
    for row in rows:
        counts[row["id"]] = row["n"]
    return counts


def _tallied(batches):
    """Counts of a whole task: one row per id that occurs in it."""
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        column = batch.column("ids")
        for first, last, buf, _ in text_chunks(column, 8 << 20):
            total += np.bincount(buf.view("<u2"), minlength=1 << 16)
    on = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(on, pa.int32()), pa.array(total[on])], ["id", "n"])


# ---------------------------------------------------------------- codes


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most ``longest`` bits by package merge; 0 for ids that do not occur.

    From the deepest level up, neighbours of the sorted list are packaged in pairs and merged with the
    single ids. Going down again, the cheapest items of a level contain a prefix of the sorted ids, which
    gain one bit, and packages, which open into twice as many items of the next level.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    n = len(used)
    if n == 0:
        return lengths
    if n == 1:
        lengths[used] = 1
        return lengths
    if n > 1 << longest:
        raise ValueError(f"{n} ids need codes of more than {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    single = counts[order].astype(np.int64)
    levels = [np.ones(n, bool)]  # whether an item is a single id, in ascending order of weight
    weights = single
    for _ in range(longest - 1):
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([single, pairs])
        sort = np.argsort(merged, kind="stable")
        weights = merged[sort]
        levels.append(sort < n)
    bits, take = np.zeros(n, np.int64), 2 * n - 2
    for is_single in reversed(levels):
        singles = int(is_single[:take].sum())
        bits[:singles] += 1
        take = 2 * (take - singles)
    lengths[order] = bits
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes from lengths: ascending by length, then id."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes = np.zeros(len(lengths), np.int64)
    code, last = 0, 0
    sizes = lengths[order].tolist()
    for at, size in zip(order.tolist(), sizes, strict=True):
        code <<= size - last
        codes[at] = code
        code, last = code + 1, size
    return codes


def decode_table(lengths: np.ndarray, longest: int = LONGEST):
    """For every value of the next ``longest`` bits: the id and the length of its code."""
    codes = canonical_codes(lengths)
    ids, sizes = np.zeros(1 << longest, np.int32), np.ones(1 << longest, np.int64)
    for at in np.flatnonzero(lengths).tolist():
        room = longest - int(lengths[at])
        first = int(codes[at]) << room
        ids[first : first + (1 << room)] = at
        sizes[first : first + (1 << room)] = lengths[at]
    return ids, sizes


def encode_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of the ids without gaps, and the bit offset of every STRIDE-th one."""
    size = lengths[ids]
    ends = np.cumsum(size)
    starts = ends - size
    total = int(ends[-1]) if len(ends) else 0
    # a code of at most 16 bits touches at most three bytes; bits of different codes never overlap
    window = codes[ids] << (24 - size - (starts & 7))
    byte = starts >> 3
    n = (total + 7) // 8 + 2
    out = np.zeros(n, np.float64)
    for i, shift in enumerate((16, 8, 0)):
        out += np.bincount(byte + i, weights=(window >> shift) & 255, minlength=n)
    return out[: (total + 7) // 8].astype(np.uint8).tobytes(), starts[::STRIDE]


def decode_bits(payloads: list[bytes], checkpoints: list[np.ndarray], counts: list[int], table) -> np.ndarray:
    """The ids of several blocks, one after another."""
    ids, sizes = table
    data = np.frombuffer(b"".join(payloads) + b"\0\0\0\0", np.uint8).astype(np.int64)
    words = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    starts = np.cumsum([0, *(len(p) for p in payloads)])[:-1] * 8
    at = np.concatenate([s + c for s, c in zip(starts, checkpoints, strict=True)]).astype(np.int64)
    room = np.concatenate([np.minimum(STRIDE, n - np.arange(len(c)) * STRIDE) for n, c in zip(counts, checkpoints, strict=True)])
    out = np.zeros((STRIDE, len(at)), np.int32)
    most = len(words) - 1
    for i in range(int(room.max()) if len(room) else 0):
        bits = (words[np.minimum(at >> 3, most)] >> (8 - (at & 7))) & 0xFFFF
        out[i] = ids[bits]
        at += sizes[bits]
    return out.T[np.arange(STRIDE)[None, :] < room[:, None]]


# ---------------------------------------------------------------- files

BLOCK_SCHEMA = (
    "part int, block int, before bigint, doc_ids array<{kind}>, sizes array<bigint>, payload binary, checkpoints array<bigint>"
)


def _packed(lengths: np.ndarray, id_type: str):
    codes = canonical_codes(lengths)

    def block(part, number, before, doc_ids, parts):
        sizes = np.array([len(p) // 2 for p in parts], np.int64)
        payload, checkpoints = encode_bits(np.frombuffer(b"".join(parts), "<u2").astype(np.int64), lengths, codes)
        columns = [
            pa.array([part], pa.int32()),
            pa.array([number], pa.int32()),
            pa.array([before], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(parts)], pa.int32()), doc_ids),
            pa.array([sizes], pa.list_(pa.int64())),
            pa.array([payload], pa.binary()),
            pa.array([checkpoints], pa.list_(pa.int64())),
        ]
        names = ["part", "block", "before", "doc_ids", "sizes", "payload", "checkpoints"]
        return pa.RecordBatch.from_arrays(columns, names), int(sizes.sum())

    def run(batches):
        part, number, before = TaskContext.get().partitionId(), 0, 0
        names, parts, held = [], [], 0
        for batch in batches:
            ids = batch.column("doc_id")
            for i, x in enumerate(batch.column("ids")):
                value = x.as_py()
                names.append(ids[i])
                parts.append(value)
                held += len(value) // 2
                if held >= BLOCK_IDS:
                    row, n = block(part, number, before, pa.array([v.as_py() for v in names], ids.type), parts)
                    yield row
                    number, before, names, parts, held = number + 1, before + n, [], [], 0
        if parts:
            yield block(part, number, before, pa.array([v.as_py() for v in names], ids.type), parts)[0]

    return run


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Tokenize, count, encode and write all documents below ``folder``, in ascending doc_id order."""
    spark = docs.sparkSession
    ids = stored(token_ids(docs, path or tokenizer_path(), end_id), "token-ids")
    lengths = code_lengths(id_counts(ids))
    used = np.flatnonzero(lengths)
    table = pa.table({"id": pa.array(used, pa.int32()), "length": pa.array(lengths[used], pa.int32())})
    kind = dict(docs.dtypes)["doc_id"]
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("_ul_row")]
    laid = ids.withColumn("_ul_row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    with released_shuffles(spark):
        spark.createDataFrame(table).coalesce(1).write.parquet(f"{folder}/codes")
        laid.select("doc_id", "ids").mapInArrow(_packed(lengths, kind), BLOCK_SCHEMA.format(kind=kind)).write.parquet(f"{folder}/blocks")


def _unpacked(lengths: np.ndarray):
    def run(batches):
        table = None
        for batch in batches:
            table = table or decode_table(lengths)
            for first in range(0, batch.num_rows, 16):
                rows = batch.slice(first, 16)
                sizes = [np.array(x, np.int64) for x in rows.column("sizes").to_pylist()]
                flat = decode_bits(
                    rows.column("payload").to_pylist(),
                    [np.array(x, np.int64) for x in rows.column("checkpoints").to_pylist()],
                    [int(s.sum()) for s in sizes],
                    table,
                )
                n = np.concatenate(sizes)
                docs = np.array([len(s) for s in sizes])
                data = memoryview(flat.astype("<u4").tobytes())
                ends = np.cumsum(n).tolist()
                ids = [bytes(data[4 * (e - k) : 4 * e]) for e, k in zip(ends, n.tolist(), strict=True)]
                inside = np.concatenate([np.cumsum(s) - s for s in sizes])
                before = np.repeat(np.array(rows.column("before").to_pylist(), np.int64), docs) + inside
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.array(rows.column("part").to_pylist(), np.int32), docs)),
                        rows.column("doc_ids").flatten(),
                        pa.array(before),
                        pa.array(n),
                        pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["part", "doc_id", "before", "n_tokens", "ids_crc32", "ids"],
                )

    return run


def _without_ids(run):
    """The same without the ids themselves, for callers that only need their checksum."""

    def narrow(batches):
        for batch in run(batches):
            yield batch.select(["part", "doc_id", "before", "n_tokens", "ids_crc32"])

    return narrow


def read_token_files(spark, folder: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, ids (little-endian 32-bit) of every document."""
    codes = spark.read.parquet(f"{folder}/codes").collect()  # at most one row per id of the vocabulary
    lengths = np.zeros(1 << 16, np.int64)
    for row in codes:
        lengths[row["id"]] = row["length"]
    blocks = spark.read.parquet(f"{folder}/blocks")
    kind = dict(blocks.dtypes)["doc_ids"].removeprefix("array<").removesuffix(">")
    schema = f"part int, doc_id {kind}, before bigint, n_tokens bigint, ids_crc32 bigint"
    run = _unpacked(lengths)
    rows = blocks.mapInArrow(run, schema + ", ids binary") if with_ids else blocks.mapInArrow(_without_ids(run), schema)
    # one row per part
    size = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)
    parts = blocks.select("part", size.alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select(F.col("part").alias("_ul_part"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_ul_base"))
    joined = rows.join(base, F.col("part") == F.col("_ul_part"))
    names = ["n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    return joined.select("doc_id", (F.col("before") + F.col("_ul_base")).alias("start"), *names)


def tokenized_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write all documents, read the files back: doc_id, start, n_tokens, ids_crc32."""
    folder = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, folder, path)
    return read_token_files(docs.sparkSession, folder, with_ids=False)
