import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.cases import prose, rows, stored_documents, words
from usagelens.llm import quality

LABELS = "doc_id bigint, quality int, toxic int"


def labelled(spark, tmp_path, n=260):
    draw, data, marks = random.Random(8), [], []
    for i in range(n):
        bad = i % 3 == 0
        w = words(i, draw.randint(20, 150))
        kind = draw.randint(0, 2)
        junk = [" ".join(x.upper() + "!!" for x in w), " | ".join(w), " ".join(x for y in w[:9] for x in [y] * 9)][kind]
        data.append((i, junk if bad else " ".join(w), "en", "s", 0))
        marks.append((i, 0 if bad else 1, 0))
    return stored_documents(spark, tmp_path, data + rows()[12:16]), spark.createDataFrame(marks, LABELS), dict((a, b) for a, b, _ in marks)


def test_held_out_accuracy(spark, tmp_path):
    docs, labels, truth = labelled(spark, tmp_path)
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == 264 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    out = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(out) > 30 and np.mean([truth[r["doc_id"]] == r["predicted"] for r in out]) > 0.95


def test_held_out_labels_change_nothing(spark, tmp_path):
    docs, labels, _ = labelled(spark, tmp_path, 150)
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (Counter((r["doc_id"], r["score"]) for r in quality.quality_scores(docs, x).collect()) for x in (labels, flipped))
    assert one == two


def test_odd_documents_and_clashing_columns(spark, tmp_path):
    docs = stored_documents(spark, tmp_path).withColumn("score", F.lit("mine")).withColumn("predicted", F.lit("mine")).withColumn("label", F.lit(3))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(None, 1, 0), (3, None, 0), (5, 0, 1), (5, 1, 1), (999, 1, 0)], LABELS)
    got = quality.quality_scores(docs, labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, *_ in rows())
    same = {}
    texts = Counter((d, t) for d, t, *_ in rows())
    assert sum(texts.values()) == len(got)
    for r in got:
        same.setdefault(r["doc_id"], set()).add(r["score"])
    assert same[22] == same[23] and len(same[26] | same[27] | same[24]) == 1
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns and all(r["score"] == "mine" for r in kept.collect())
    assert kept.count() == sum(r["predicted"] for r in got)


def test_labels_without_documents_and_odd_labels_take_no_places(spark, tmp_path):
    docs, labels, _ = labelled(spark, tmp_path, 120)
    odd = [(10_000 + i, i % 2, 0) for i in range(3000)] + [(0, 2, 0), (1, -1, 0), (2, 7, 1)]
    one, two = (
        Counter((r["doc_id"], r["score"]) for r in quality.scored(docs, quality.fit(docs, marks, most=60)).collect())
        for marks in (labels, labels.union(spark.createDataFrame(odd, LABELS)))
    )
    assert one == two


def test_no_labels_one_class_and_no_documents(spark, tmp_path):
    docs = stored_documents(spark, tmp_path)
    assert {r["score"] for r in quality.quality_scores(docs, spark.createDataFrame([], LABELS)).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i in range(12)], LABELS)
    scores = {r["score"] for r in quality.quality_scores(docs, ones).collect()}
    assert len(scores) == 1 and 0.8 < scores.pop() < 1
    assert quality.quality_scores(stored_documents(spark, tmp_path, [], "none"), ones).count() == 0


def test_hot_labelled_id_stays_bounded(spark, tmp_path):
    data = [(1, prose(i, 30), "en", "s", 0) for i in range(300)] + [(i, prose(i, 30), "en", "s", 0) for i in range(2, 40)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 40)], LABELS)
    model = quality.fit(stored_documents(spark, tmp_path, data), labels, most=20)
    assert np.isfinite(model.weights).all()


def test_dual_coordinate_descent_meets_the_primal():
    draw = np.random.default_rng(3)
    rows_ = [np.sort(draw.choice(40, 12, replace=False)) for _ in range(80)]
    values = [draw.normal(size=12) for _ in rows_]
    signs = np.where(draw.random(80) < 0.5, 1.0, -1.0)
    costs = np.full(80, 0.7)
    old = quality.PASSES
    quality.PASSES = 400
    try:
        weights, bias = quality._hinge(rows_, values, signs, costs)
    finally:
        quality.PASSES = old

    def primal(w, b):
        return 0.5 * (w @ w + b * b) + sum(c * max(0, 1 - s * (w[r] @ v + b)) for r, v, s, c in zip(rows_, values, signs, costs, strict=True))

    best = primal(weights, bias)
    for _ in range(200):
        step = draw.normal(size=len(weights)) * 0.02
        assert primal(weights + step, bias + draw.normal() * 0.02) >= best - 1e-6


def test_the_fit_holds_little_more_than_the_features():
    import tracemalloc

    draw = np.random.default_rng(2)
    rows_ = [np.unique(draw.integers(0, quality.FEATURES, 1500)).astype(np.uint16) for _ in range(1200)]
    labels = draw.integers(0, 2, len(rows_))
    tracemalloc.start()
    quality.fit_rows(rows_, labels)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 2 * sum(row.nbytes for row in rows_)
