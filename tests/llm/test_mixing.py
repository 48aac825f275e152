import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.llm.cases import rows, stored_documents
from usagelens.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, out, open_names = sum(sizes.values()) * share, {}, set(names)
    while open_names:
        total = sum(weight[s] for s in open_names)
        level = {s: budget * weight[s] / total for s in open_names}
        above = {s for s in open_names if level[s] > sizes[s] * most + 1e-9}
        if not above:
            return out | level
        for s in above:
            out[s] = sizes[s] * most
            budget -= out[s]
        open_names -= above
    return out


def check(got, data):
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, text, _, source, _ in data:
        sizes[source] += size(text)
        largest[source] = max(largest[source], size(text))
    wanted = targets(sizes)
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, size(t)) for i, t, *_ in data)
    for r in got:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - wanted[r["source"]]) < 1e-6
    for source in sizes:
        assert abs(taken[source] - wanted[source]) <= largest[source] / 2 + 1e-6


def test_mix_meets_targets(spark, tmp_path):
    docs = stored_documents(spark, tmp_path).withColumn("taken", F.lit("x")).withColumn("target", F.lit("y"))
    got = mixing.mixed(docs, mixing.word_count(F.col("text"))).collect()
    check(got, rows())
    again = mixing.mixed(docs, mixing.word_count(F.col("text"))).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_hot_source_of_equal_rows(spark, tmp_path):
    data = [(1, "a b c d", "en", "hot", 7)] * 600 + [(i, f"w{i} x y", "en", f"s{i % 4}", 5) for i in range(2, 400)]
    docs = stored_documents(spark, tmp_path, data)
    got = mixing.mixed(docs, mixing.word_count(F.col("text"))).collect()
    check(got, data)


def test_source_order_is_by_code_point(spark):
    sizes = {"b": 100, "B": 100, "é": 100, None: 100, "": 100, "\U0001f600": 100, "￮": 100}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    wanted = targets(sizes)
    assert all(abs(got[s] - wanted[s]) < 1e-9 for s in sizes)


def test_larger_budget_takes_a_superset(spark, tmp_path):
    data = [(i, f"w{i} x y", "en", "s", 5) for i in range(300)]
    docs = stored_documents(spark, tmp_path, data)
    few, many = (
        {r["doc_id"] for r in mixing.mixed(docs, mixing.word_count(F.col("text")), share=share, most=1).collect() if r["taken"]}
        for share in (0.2, 0.6)
    )
    assert few < many


def test_only_empty_texts_and_no_rows(spark, tmp_path):
    data = [(1, None, None, "a", 0), (2, "", None, None, 0)]
    assert {(r["doc_id"], r["size"], r["taken"]) for r in mixing.mix_documents(stored_documents(spark, tmp_path, data)).collect()} == {(1, 0, 0), (2, 0, 0)}
    assert mixing.mix_documents(stored_documents(spark, tmp_path, [], "none")).count() == 0
