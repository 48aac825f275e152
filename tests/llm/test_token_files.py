import heapq
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.cases import rows, stored_documents
from usagelens.llm import token_files as tf

pytest.importorskip("tokenizers")


def whole_text_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tf.tokenizer_path())
    return [e.ids + [1] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def checksum(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_hold_the_ids_of_whole_texts(spark, tmp_path):
    docs = stored_documents(spark, tmp_path).withColumn("ids", F.lit("x")).withColumn("part", F.lit("y"))
    got = sorted(tf.tokenized_documents(docs).collect(), key=lambda r: r["start"])
    data = rows()
    ids = whole_text_ids([t or "" for _, t, *_ in data])
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(
        (d, len(x), checksum(x)) for (d, *_), x in zip(data, ids, strict=True)
    )
    assert [r["doc_id"] for r in got] == sorted((d for d, *_ in data), key=lambda d: (d is not None, d or 0))
    assert [r["start"] for r in got] == list(np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1])


def test_ids_come_back(spark, tmp_path):
    docs = stored_documents(spark, tmp_path)
    tf.write_token_files(docs, str(tmp_path / "files"))
    back = tf.read_token_files(spark, str(tmp_path / "files")).collect()
    ids = whole_text_ids([t or "" for _, t, *_ in rows()])
    assert Counter(bytes(r["ids"]) for r in back) == Counter(np.array(x, "<u4").tobytes() for x in ids)


def test_empty_table(spark, tmp_path):
    assert tf.tokenized_documents(stored_documents(spark, tmp_path, [])).count() == 0


ODD = "áé J̌ x\x1cy 'S don't İ İ 12a3 !!?? 　k​z\nΑΣ ́ <|endoftext|> 'LL"


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'sLl \n\t12!?é́̌J  \x1c\x85ΣİK<|>")), max_size=60))
def test_words_give_the_ids_of_the_text(text):
    check_words([text, ODD])


def check_words(texts):
    tokens = check_words.__dict__.setdefault("tokens", tf.WordTokens(tf.tokenizer_path()))
    got = [np.frombuffer(x, "<u2").tolist() + [1] for x in tokens.encode([t.encode() for t in texts])]
    assert got == whole_text_ids(texts)


@pytest.mark.parametrize(
    "text",
    ["ab <|endoftext|> cd", "<|startoftext|>", "x<|endoftext|>y z", "<|endoftext|><|endoftext|>", "A <|ENDOFTEXT|> b", "<|endoftext", "é́ <|startoftext|>, İ don't"],
)
def test_added_tokens_count_as_the_plain_tokenizer_counts_them(text):
    check_words([text, "plain words", text + " " + ODD, ""])


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abzßàöøÿéñçµªºŉſ÷×")), min_size=1, max_size=9), max_size=8))
def test_plain_letters_skip_the_normalizer(words):
    check_words([" ".join(words), " ".join(words).upper()])


def test_forgotten_words_are_learnt_again(monkeypatch):
    monkeypatch.setattr(tf, "CACHED_WORDS", 5)
    tokens = tf.WordTokens(tf.tokenizer_path())
    texts = ["a b c d", "e f g h i j k", "a b a"]
    for text in texts * 2:
        assert np.frombuffer(tokens.encode([text.encode()])[0], "<u2").tolist() + [1] == whole_text_ids([text])[0]


def test_a_million_words_stay_known_in_little_memory():
    import tracemalloc

    tokens = tf.WordTokens(tf.tokenizer_path())
    parts = [" ".join("".join(chr(97 + x // 26**i % 26) for i in range(5)) for x in range(k, 1_000_000, 5)).encode() for k in range(5)]
    tracemalloc.start()
    first = [tokens.encode([part]) for part in parts]
    kept = tracemalloc.get_traced_memory()[0] - sum(len(x[0]) for x in first)
    tracemalloc.stop()
    assert kept < 120_000_000
    # nothing is tokenized again
    tokens.tokenizer = tokens.letters = tokens.learn = tokens.learnt = None
    assert [tokens.encode([part]) for part in parts] == first


def test_long_words_and_marks():
    long = "ab1" * 40
    check_words([f"{long} {long}x x. y, a., 1. é. {long}. ,", "", " ", "." , f"a{long} a. a", "x" * 64 + " " + "x" * 65 + " " + "x" * 64 + ","])
    tokens = check_words.tokens
    assert tokens.encode([]) == [] and tokens.encode([b"", b""]) == [b"", b""]
    n = tokens.known.n
    tokens.encode([("q" * 100).encode()])
    assert tokens.known.n == n


def huffman_cost(counts):
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


def best_limited(counts, longest):
    """Least cost of a code with lengths up to ``longest``, by trying all ascending length lists."""
    used = sorted((c for c in counts if c), reverse=True)
    best = [float("inf")]

    def go(i, low, room, cost):
        if i == len(used):
            best[0] = min(best[0], cost)
            return
        for length in range(low, longest + 1):
            share = 2 ** (longest - length)
            if share * (len(used) - i) < 0 or share > room:
                continue
            go(i + 1, length, room - share, cost + used[i] * length)

    go(0, 1, 2**longest, 0)
    return best[0]


def test_code_lengths_are_optimal():
    draw = random.Random(5)
    for _ in range(20):
        counts = np.array([draw.choice([0, 1, 2, 3, 5, 8, 100, 1000]) for _ in range(7)])
        if (counts > 0).sum() < 2:
            continue
        for longest in (3, 4):
            lengths = tf.code_lengths(counts, longest)
            assert (lengths * counts).sum() == best_limited(counts, longest) and lengths.max() <= longest
    counts = np.array([draw.choice([0, draw.randint(10**5, 10**6)]) for _ in range(3000)])  # no code would be longer
    lengths = tf.code_lengths(counts)
    assert (lengths * counts).sum() == huffman_cost(counts.tolist())
    assert abs(sum(2.0 ** -int(x) for x in lengths if x) - 1) < 1e-9


def test_long_codes_are_limited():
    counts = np.array([2**i for i in range(40)])
    lengths = tf.code_lengths(counts)
    assert lengths.max() == tf.LONGEST and sum(2.0 ** -int(x) for x in lengths) <= 1
    with pytest.raises(ValueError):
        tf.code_lengths(np.ones(9, np.int64), 3)


@pytest.mark.parametrize("kinds", [1, 2, 300, 40_000])
def test_bits_come_back_in_blocks(kinds):
    draw = np.random.default_rng(kinds)
    blocks = [draw.integers(0, kinds, n) ** 2 % kinds for n in (1, 255, 256, 257, 5000)]
    counts = np.bincount(np.concatenate(blocks), minlength=1 << 16)
    lengths = tf.code_lengths(counts)
    codes, table = tf.canonical_codes(lengths), tf.decode_table(lengths)
    parts = [tf.encode_bits(b, lengths, codes) for b in blocks]
    back = tf.decode_bits([p for p, _ in parts], [c for _, c in parts], [len(b) for b in blocks], table)
    assert back.tolist() == np.concatenate(blocks).tolist()
    assert len(parts[4][1]) == -(-5000 // tf.STRIDE)
