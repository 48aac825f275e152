import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import prose, rows, stored_documents, words
from usagelens.llm import repeats


def brute_force(data, span=50):
    owners = defaultdict(set)
    texts = [(doc, (text or "").encode()) for doc, text, *_ in data]
    rank = {d: -(2**63) if d is None else d for d, _ in texts}
    for doc, text in texts:
        for i in range(len(text) - span + 1):
            owners[text[i : i + span]].add(rank[doc])
    least = {s: min(d) for s, d in owners.items()}
    out = []
    for doc, text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - span + 1):
            if least[text[i : i + span]] < rank[doc]:
                gone[i : i + span] = b"\1" * span
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        out.append((doc, len(text), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def check(spark, tmp_path, data):
    got = repeats.without_repeats(stored_documents(spark, tmp_path, data)).collect()
    assert Counter(map(tuple, got)) == brute_force(data)


def test_odd_documents(spark, tmp_path):
    docs = stored_documents(spark, tmp_path).withColumn("starts", F.lit(1)).withColumn("tie", F.lit("t"))
    assert Counter(map(tuple, repeats.without_repeats(docs).collect())) == brute_force(rows())


def passages(seed=1):
    """Shared passages, overlaps, borders one byte off the span, repeats within a document, periods."""
    draw = random.Random(seed)
    shared = [prose(500 + i, draw.randint(8, 40)) for i in range(8)]
    data = []
    for doc in range(60):
        parts = [prose(1000 + doc * 7 + j, draw.randint(0, 30)) for j in range(4)]
        for _ in range(draw.randint(0, 3)):
            text = draw.choice(shared)
            a = draw.randint(0, 20)
            parts.insert(draw.randint(0, 4), text[a : a + draw.choice([48, 49, 50, 51, 75, 90, 400])])
        data.append((doc, " ".join(parts), "en", "s", 0))
    data += [(100, "ab" * 80, "en", "s", 0), (101, "x" + "ab" * 60, "en", "s", 0), (102, "é" * 40, "en", "s", 0), (103, "zé" * 40, "en", "s", 0)]
    draw.shuffle(data)
    return data


def test_passages(spark, tmp_path):
    check(spark, tmp_path, passages())


def test_anchors_with_many_contexts_are_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repeats, "CONTEXTS", 3)
    monkeypatch.setattr(repeats, "FLUSH_RUNS", 200)
    line = prose(77, 12)
    data = [(i, f"{words(i, 3)[0]}{i} {line} {words(i + 500, 5)}", "en", "s", 0) for i in range(120)]
    check(spark, tmp_path, data + passages(3))


def test_a_share_of_the_runs_travels_at_a_time():
    bodies = [prose(i, 400).encode() for i in range(150)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(150)), "tie": list(range(150)), "_ul_body": bodies})
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in bodies])])
    everything = repeats.text_runs(np.frombuffer(b"".join(bodies), np.uint8), offsets, repeats.ByteHasher())
    anchors, sizes = [], []
    for turn in range(repeats.ROUNDS):
        sent = pa.Table.from_batches(list(repeats._map_runs(200, 50, repeats.ROUNDS, turn)([batch]))).to_pylist()
        packed = [row for row in sent if row["payload"]]
        anchors += [repeats._from_planes(row["payload"], repeats.RUN)["anchor"] for row in packed]
        sizes.append(sum(len(row["payload"]) + len(row["doc_ids"]) for row in packed))
    known, n = set(everything[3].tolist()), len(everything[3])
    assert set(np.concatenate(anchors).tolist()) == known  # none is left out
    assert max(sizes) < 25 * n  # over 41 bytes a run when all travelled at once


def test_contexts_that_share_no_string_are_not_fetched(spark, tmp_path, monkeypatch):
    met, store = [], repeats.stored
    monkeypatch.setattr(repeats, "stored", lambda df, label: met.append((label, out := store(df, label))) or out)
    phrase = "Jpq vxzk wq-zzv kqj vvw 77 xqz"  # 30 bytes
    data = [(i, f"{prose(3000 + i, 12)} {phrase} {prose(5000 + i, 12)}", "en", "s", 0) for i in range(150)]
    check(spark, tmp_path, data)
    asked = sum(df.where("anchor IS NOT NULL").count() for label, df in met if label == "runs")
    assert asked < 30  # 233 before contexts were compared on both sides of the anchor


def test_empty_table(spark, tmp_path):
    assert repeats.without_repeats(stored_documents(spark, tmp_path, [])).count() == 0


def naive_intervals(strings, least):
    """All groups of suffixes with a maximal common prefix of at least ``least``, by definition."""
    prefixes = defaultdict(set)
    for i, s in enumerate(strings):
        for n in range(least, len(s) + 1):
            prefixes[s[:n]].add(i)
    groups = {}
    for prefix, members in prefixes.items():
        if len(members) > 1:
            key = frozenset(members)
            groups[key] = max(groups.get(key, 0), len(prefix))
    return {(n, members) for members, n in groups.items()}


@pytest.mark.parametrize("seed", range(6))
def test_interval_tree_equals_definition(seed):
    draw = random.Random(seed)
    text = "".join(draw.choice("ab") for _ in range(60)) + "$"
    order = sorted(range(len(text)), key=lambda i: text[i:])
    strings = [text[i:] for i in order]
    lcp = [0] * len(order)
    for i in range(1, len(order)):
        a, b = strings[i - 1], strings[i]
        while lcp[i] < min(len(a), len(b)) and a[lcp[i]] == b[lcp[i]]:
            lcp[i] += 1
    left = [ord(text[i - 1]) if i else -1 for i in order]
    rank = [draw.randint(0, 4) for _ in order]
    found, resolved = set(), {}
    for length, first, last, maximal, done, low in repeats.interval_tree(lcp, rank, left, 2):
        members = range(first, last + 1)
        found.add((length, frozenset(members)))
        assert low == min(rank[i] for i in members)
        letters = {left[i] for i in members}
        assert maximal == (len(letters) > 1 or -1 in letters)
        for leaf in done:
            assert leaf not in resolved and rank[leaf] > low
            resolved[leaf] = length
    assert found == naive_intervals(strings, 2)
    for i, s in enumerate(strings):  # the longest prefix that a smaller rank shares
        best = max((n for n, members in found if i in members and min(rank[j] for j in members) < rank[i]), default=None)
        assert resolved.get(i) == best


def test_suffix_array_is_sorted():
    bodies = np.frombuffer(b"banana_bandana_ban", np.uint8)
    starts = np.arange(len(bodies))
    lengths = len(bodies) - starts
    order, lcp = repeats.suffix_array(np.zeros(len(starts), np.uint64), bodies, starts, lengths, len(bodies))
    texts = [bodies[i:].tobytes() for i in order]
    assert texts == sorted(texts)
    for i in range(1, len(texts)):
        n = int(lcp[i])
        assert texts[i][:n] == texts[i - 1][:n] and texts[i][n : n + 1] != texts[i - 1][n : n + 1]
