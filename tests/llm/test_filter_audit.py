import re
from collections import Counter
from itertools import permutations
from math import factorial

from tests.llm.cases import prose, rows, stored_documents
from usagelens.llm import filter_audit as A

LABELS = "doc_id bigint, quality int, toxic int"


def brute(data, labels):
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    least = {}
    for doc, text, *_ in data:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    out = {}
    for doc, text, _, source, _ in data:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": doc is not None and doc > least[t],
        }
        only = [k for k, failed in fails.items() if failed]
        for order in permutations("ABCDE"):
            gone = False
            for step, name in enumerate(order, 1):
                row = out.setdefault((source or "", "".join(order), step), [0] * 6)
                failed = fails[name]
                row[0] += not failed and not gone
                row[1] += failed and not gone
                row[2] += failed and gone
                row[3] += only == [name]
                row[4] += failed and not gone and doc in good
                row[5] += failed and not gone and doc in toxic
                gone = gone or failed
    shapley = Counter()
    for (part, order, step), row in out.items():
        shapley[(part, order[step - 1])] += row[1]
    return {(*k, *row, shapley[(k[0], k[1][k[2] - 1])]) for k, row in out.items()}


def test_every_order_against_single_documents(spark, tmp_path):
    long = prose(70, 260)
    data = rows() + [
        (700, long, "en", "s0", 0), (701, long, "en", "s1", 0), (702, long, "en", None, 0), (703, long + " |", "en", "", 0), (700, long, "en", "s0", 0),
        (704, long.upper(), "en", "s1", 0), (705, "AAA BBB " * 120, "en", "s2", 0), (None, long, "en", "s0", 0), (706, "same $ " * 300, "en", "s2", 0),
        (707, "same $ " * 300, "en", "s0", 0), (9, long, "en", "s1", 0),
    ]
    labels = [(700, 1, 0), (700, 0, 1), (701, 1, None), (9, None, 1), (9, 1, 1), (703, 0, 0), (None, 1, 1), (12345, 1, 1), (706, 1, 1), (5, 1, 0), (24, 1, 1)]
    docs = stored_documents(spark, tmp_path, data).selectExpr("*", "1 AS part", "2 AS failed", "3 AS n", "'k' AS key", "4 AS good")
    marks = spark.createDataFrame(labels, LABELS).selectExpr("*", "1 AS salt")
    got = A.filter_interactions(docs, marks).collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == brute(data, labels)


def test_hot_text_with_and_without_ids(spark, tmp_path):
    data = [(i if i % 3 else None, "hot text here", "en", f"s{i % 4}", 0) for i in range(400)] + [(1000 + i, f"other {i}", "en", "s0", 0) for i in range(50)]
    got = A.filter_interactions(stored_documents(spark, tmp_path, data), spark.createDataFrame([(4, 1, 1)], LABELS)).collect()
    assert set(map(tuple, got)) == brute(data, [(4, 1, 1)])


def test_paths_are_products_of_factorials():
    edges = A.lattice()
    assert len(edges) == 80 and len(A.order_steps()) == 600
    for state, i, orders in edges:
        size = bin(state).count("1")
        assert not state >> i & 1 and orders == factorial(size) * factorial(4 - size)


def test_no_rows(spark, tmp_path):
    assert A.filter_interactions(stored_documents(spark, tmp_path, []), spark.createDataFrame([], LABELS)).count() == 0


def test_texts_stay_behind(spark, tmp_path):
    docs = stored_documents(spark, tmp_path)
    plan = A.failure_counts(docs, spark.createDataFrame([], LABELS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
