import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import prose, rows, stored_documents, words
from usagelens.llm import decontaminate

BENCHMARK = [
    (1, prose(8, 60)),  # inside document 33
    (2, prose(3, 61)),
    (3, "word"),
    (4, None),
    (5, ""),
    (6, "Same SAME same, same"),
    (7, prose(8, 60)),
    (10, "x. Y!"),
    (None, " ".join(words(31, 12))),
]


def found_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(data, benchmark, width=10):
    windows = {}
    for item, text in benchmark:
        w = found_words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text, *_ in data:
        w, hit, items = found_words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found:
                    hit |= set(range(i, i + n))
                    items |= found
        out.append((doc, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def table(spark, benchmark):
    return spark.createDataFrame(benchmark, "item_id bigint, text string")


@pytest.mark.parametrize("most", [200_000, 20])
def test_digest_equals_brute_force(spark, tmp_path, most, monkeypatch):
    monkeypatch.setattr(decontaminate.pattern_slices, "__defaults__", (decontaminate.WIDTH, most))
    docs = stored_documents(spark, tmp_path).withColumn("items", F.lit(1)).withColumn("hits", F.lit(2))
    found = decontaminate.contamination(docs, table(spark, BENCHMARK), most=most)
    got = Counter(
        (r["doc_id"], r["n_words"], len(r["hits"]), len(r["items"]), decontaminate.sorted_items_digest(r["items"]), bool(r["hits"]))
        for r in found.collect()
    )
    assert got == brute_force(rows(), BENCHMARK)
    if most > 1000:
        digest = decontaminate.contaminated_documents(docs, table(spark, BENCHMARK)).collect()
        assert Counter(map(tuple, digest)) == got


def test_many_patterns_over_few_words(spark, tmp_path):
    draw = random.Random(2)
    data = [(i, " ".join(draw.choice("abc") for _ in range(draw.randint(0, 1500))), "en", "s", 0) for i in range(30)]
    benchmark = [(i, " ".join(draw.choice("abc") for _ in range(draw.randint(1, 30)))) for i in range(40)]
    docs = stored_documents(spark, tmp_path, data)
    got = decontaminate.contaminated_documents(docs, table(spark, benchmark)).collect()
    assert Counter(map(tuple, got)) == brute_force(data, benchmark)


def test_clean_documents_keep_their_columns(spark, tmp_path):
    docs = stored_documents(spark, tmp_path)
    kept = decontaminate.clean_documents(docs, table(spark, BENCHMARK))
    hit = {k[0]: k[5] for k in brute_force(rows(), BENCHMARK)}
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(d for d, *_ in rows() if not hit[d])


def test_empty_tables(spark, tmp_path):
    docs, none = stored_documents(spark, tmp_path), stored_documents(spark, tmp_path, [], "none")
    assert decontaminate.contaminated_documents(docs, table(spark, [])).filter("contaminated").count() == 0
    assert decontaminate.contaminated_documents(docs, table(spark, [])).count() == len(rows())
    assert decontaminate.contaminated_documents(none, table(spark, BENCHMARK)).count() == 0
    assert decontaminate.clean_documents(docs, table(spark, [])).count() == len(rows())
