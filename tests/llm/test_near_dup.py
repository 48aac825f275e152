import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import rows, stored_documents, words
from usagelens.llm import near_dup


def shingled(text):
    w = [x.decode() for x in text.encode().split()]
    if not w:
        return Counter()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)])


def classes(data, threshold=0.8):
    """Class of each row by comparing all pairs of texts."""
    texts = sorted({t for _, t, *_ in data if t is not None})
    sets = {t: shingled(t) for t in texts}
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            union = sum((sets[a] | sets[b]).values())
            if union and sum((sets[a] & sets[b]).values()) >= threshold * union:
                parent[find(a)] = find(b)
    least = {}
    for doc, text, *_ in data:
        if text is not None and doc is not None:
            root = find(text)
            least[root] = min(least.get(root, doc), doc)
    return Counter((doc, doc if text is None else least.get(find(text))) for doc, text, *_ in data)


def edited(base, rate, draw):
    return " ".join(draw.choice(words(draw.randint(0, 9999), 3)) if draw.random() < rate else w for w in base)


def test_classes_equal_brute_force(spark, tmp_path):
    docs = stored_documents(spark, tmp_path).withColumn("class_id", F.lit("x")).withColumn("text_id", F.lit("y"))
    got = near_dup.near_duplicate_classes(docs).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == classes(rows())


def test_chains_and_groups_equal_brute_force(spark, tmp_path):
    draw = random.Random(4)
    data, n = [], 100
    for group in range(12):
        base = words(1000 + group, draw.randint(60, 200))
        for _ in range(draw.randint(2, 25)):
            data.append((n, edited(base, draw.choice([0, 0.005, 0.01, 0.02, 0.05]), draw), "en", "s", 0))
            n += 1
    # a chain: each text is near its neighbours only
    chain = words(77, 150)
    for _ in range(10):
        chain = chain[4:] + words(n, 4)
        data.append((n, " ".join(chain), "en", "s", 0))
        n += 1
    draw.shuffle(data)
    got = near_dup.near_duplicate_classes(stored_documents(spark, tmp_path, data)).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == classes(data)


def test_pairs_in_a_family_below_the_threshold_equal_brute_force(spark, tmp_path):
    # all texts share a passage and lie at 0.77; some pairs share more and lie above 0.8
    draw = random.Random(6)
    passage, data = words(500, 187), []
    for pair in range(250):
        common = words(3000 + pair, 7)
        for side in (0, 1):
            text = passage + common + words(10_000 + 2 * pair + side, 21)
            data.append((2 * pair + side, " ".join(text), "en", "s", 0))
    draw.shuffle(data)
    expected = classes(data)
    assert Counter(Counter(c for _, c in expected).values()) == {2: 250}
    got = near_dup.near_duplicate_classes(stored_documents(spark, tmp_path, data)).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == expected


@pytest.mark.parametrize("texts", [50, 400])
def test_candidates_of_a_family_grow_with_its_texts(spark, tmp_path, monkeypatch, texts):
    # all texts of the family lie at 0.70; planted pairs share more and lie above 0.8
    draw = random.Random(texts)
    passage, data = words(501, 178), []
    for pair in range(texts // 2):
        common = words(5000 + pair, 20)
        for side in (0, 1):
            data.append((2 * pair + side, " ".join(passage + common + words(20_000 + 2 * pair + side, 17)), "en", "s", 0))
    draw.shuffle(data)
    found, rest = [], near_dup._rest

    def counted(*args):
        pairs = rest(*args)
        found.append(pairs.count())
        return pairs

    monkeypatch.setattr(near_dup, "_rest", counted)
    got = near_dup.near_duplicate_classes(stored_documents(spark, tmp_path, data)).collect()
    expected = classes(data)
    assert Counter(Counter(c for _, c in expected).values()) == {2: texts // 2}
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == expected
    assert len(found) == 1 and found[0] <= 3 * texts


def test_parities_never_exceed_the_difference():
    draw = random.Random(8)
    for n in (3, 60, 900):
        a = {draw.getrandbits(64) for _ in range(n)}
        b = set(draw.sample(sorted(a), n // 2)) | {draw.getrandbits(64) for _ in range(n // 3)}
        rows_ = np.repeat([0, 1], [len(a), len(b)])
        odd = near_dup.parities(rows_, np.array([*a, *b], np.uint64), 3)
        bits = sum(int(x).bit_count() for x in odd[0] ^ odd[1])
        assert 0 < bits <= len(a ^ b) and not odd[2].any()


def test_one_document_of_each_class_stays(spark, tmp_path):
    docs = stored_documents(spark, tmp_path)
    kept = near_dup.unique_documents(docs).collect()
    assert kept and set(kept[0].asDict()) == set(docs.columns)
    by_class = defaultdict(list)
    for r in kept:
        by_class["null" if r["text"] is None else r["text"]].append(r)
    assert all(len(v) == 1 for text, v in by_class.items() if text != "null")
    assert {r["doc_id"] for r in kept} >= {0, 1, 2, 3, 4, 5, 24, 25, 26, 28, 29, 30, 31, 32, 33}
    assert not {r["doc_id"] for r in kept} & {20, 21, 22, 23, 27}


def test_empty_table(spark, tmp_path):
    docs = stored_documents(spark, tmp_path, [])
    assert near_dup.near_duplicate_classes(docs).count() == 0
    assert near_dup.unique_documents(docs).count() == 0


def signature(weights: dict, k=512):
    values = np.array(list(weights), np.uint64)
    w = np.array(list(weights.values()), float)
    return near_dup.dart_signatures(np.zeros(len(values), np.int64), near_dup.mix(values), w, 1, k)[0]


def test_signatures_estimate_weighted_similarity():
    draw = random.Random(1)
    for spread in (1.0, 0.3, 5.0):
        a = {i: draw.random() * spread + 0.1 for i in range(200)}
        b = {i: (w if draw.random() < 0.7 else draw.random() * spread + 0.1) for i, w in a.items() if i < 170} | {i: 0.5 for i in range(300, 320)}
        keys = a.keys() | b.keys()
        true = sum(min(a.get(i, 0), b.get(i, 0)) for i in keys) / sum(max(a.get(i, 0), b.get(i, 0)) for i in keys)
        assert abs(float((signature(a) == signature(b)).mean()) - true) < 0.09


def test_signatures_do_not_depend_on_the_batch():
    rows_, values = np.array([0, 0, 1, 1, 1, 2]), near_dup.mix(np.array([1, 2, 2, 3, 4, 9], np.uint64))
    together = near_dup.dart_signatures(rows_, values, np.array([1.0, 2, 2, 1, 1, 1]), 4)
    alone = near_dup.dart_signatures(np.zeros(3, np.int64), values[2:5], np.array([2.0, 1, 1]), 1)
    assert (together[1] == alone[0]).all() and (together[3] == np.uint64(2**64 - 1)).all()
    assert (together[:3] != np.uint64(2**64 - 1)).all()


def test_components_of_long_paths(spark):
    draw = random.Random(3)
    nodes = list(range(60))
    draw.shuffle(nodes)
    edges = list(zip(nodes, nodes[1:], strict=False)) + [(100, 101), (103, 101)]
    got = near_dup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["root"] for r in got} == {n: 0 for n in nodes} | {100: 100, 101: 100, 103: 100}


def test_known_classes_move_as_a_whole(spark, monkeypatch):
    import itertools

    draw = random.Random(4)
    tables = []
    monkeypatch.setattr(near_dup, "stored", lambda df, label, real=near_dup.stored: (tables.append(label), real(df, label))[1])
    edges, roots = [], None
    for _ in range(3):
        more = [(draw.randrange(60), draw.randrange(60)) for _ in range(14)] + [(100 + i, 101 + i) for i in range(6)]
        edges += more
        roots = near_dup._joined(roots, spark.createDataFrame(more, "a bigint, b bigint"))
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    want = {x: top(x) for x in itertools.chain(*edges)}
    got = {r["node"]: r["root"] for r in roots.collect()}
    assert got == {x: r for x, r in want.items() if x in got} and {x for x, r in want.items() if list(want.values()).count(r) > 1} <= set(got)
    # a chain of seven nodes is followed in few steps
    tables.clear()
    near_dup._flattened(spark.createDataFrame([(i + 1, i) for i in range(7)], "node bigint, root bigint"), "x")
    assert len(tables) <= 4
