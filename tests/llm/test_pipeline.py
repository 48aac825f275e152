from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry_point
from tests.llm.cases import prose, rows, stored_documents
from usagelens.llm import queries

TINY = "/root/testdata/sf0.001"


def test_stages_in_order_on_the_smallest_tables(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "near-duplicates", "benchmark decontamination", "mixing", "token ids"]
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, TINY)
        assert docs.columns == columns
        kept = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert set(kept) <= ids
        ids = set(kept)
        counts.append(len(kept))
    assert counts[0] > counts[1] > counts[2] > counts[3] > 0
    result = corpus_pipeline.run(spark, TINY).collect()
    assert len(result) == counts[4] and {r["doc_id"] for r in result} == ids
    starts = sorted((r["start"], r["n_tokens"]) for r in result)
    assert all(a[0] + a[1] == b[0] for a, b in zip(starts, starts[1:], strict=False))


def test_mixed_rows_repeat_as_taken(spark, tmp_path):
    from pyspark.sql import functions as F

    from usagelens.llm import mixing

    data = rows() + [(900, prose(1, 9), "en", "hot", 1)] * 90 + [(901 + i, prose(i, 9), "en", "s9", 1) for i in range(40)]
    docs = stored_documents(spark, tmp_path, data)
    taken = Counter()
    for r in mixing.mixed(docs, mixing.word_count(F.col("text"))).collect():
        taken[(r["doc_id"], r["source"], r["size"])] += r["copies"]
    got = Counter((r["doc_id"], r["source"], len((r["text"] or "").split(" ")) if r["text"] else 0) for r in mixing.mixed_documents(docs).collect())
    sized = Counter()
    for (doc, source, _), n in got.items():
        sized[(doc, source)] += n
    wanted = Counter()
    for (doc, source, _), n in taken.items():
        wanted[(doc, source)] += n
    assert all(sized[k] == n for k, n in wanted.items() if k[0] not in (None, 5, 6, 900))
    assert abs(sized[(900, "hot")] - wanted[(900, "hot")]) <= 25
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_every_operator_has_one_registered_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(entry_point.queries())
    assert set(queries.ORACLES) <= set(entry_point.oracle_sql())
