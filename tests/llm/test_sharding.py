import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import rows, stored_documents
from usagelens.llm import sharding


def jump(key: int, shards: int) -> int:
    key, b, j = key & (2**64 - 1), -1, 0
    while j < shards:
        b, key = j, (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 24, 25, 1000])
def test_shard_equals_the_published_algorithm(spark, shards):
    keys = [0, 1, -1, 7, 2**63 - 1, -(2**63), *range(100, 160)]
    df = sharding.with_shard(spark.createDataFrame([(k,) for k in keys], "k bigint"), "k", shards)
    assert {r["k"]: r["shard"] for r in df.collect()} == {k: jump(k, shards) for k in keys}


def test_digest(spark, tmp_path):
    docs = stored_documents(spark, tmp_path).withColumn("shard", F.lit("x")).withColumn("slot", F.lit("y"))
    got = sharding.shard_documents(docs).collect()
    assert len(got) == len(rows())
    expected = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expected
    for r in got:
        if r["doc_id"] is not None:
            assert (r["shard"], r["grown_shard"]) == (jump(r["doc_id"], 24), jump(r["doc_id"], 25))
        assert r["grown_shard"] in (r["shard"], 24) and r["law"] == "key"
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_slots_of_many_equal_rows(spark, tmp_path):
    docs = stored_documents(spark, tmp_path, [(7, "copy", "en", "a", 4)] * 500 + [(i, "t", "en", "a", 1) for i in range(200)])
    got = sharding.shard_documents(docs).collect()
    hot = {r["slot"] for r in got if r["doc_id"] == 7}
    assert len(got) == 700 and len(hot) >= 500


def test_slots_follow_the_key(spark, tmp_path):
    docs = stored_documents(spark, tmp_path, [(i, "t", "en", "a", 1) for i in range(300)])
    got = sharding.shard_documents(docs).orderBy("shard", "slot").collect()
    for a, b in zip(got, got[1:], strict=False):
        assert a["shard"] != b["shard"] or a["doc_id"] < b["doc_id"]


def test_text_keys_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("b",), (None,), (None,)], "k string")
    got = sharding.with_shard(df, "k", 10).collect()
    assert len({r["shard"] for r in got if r["k"] is None}) == 1
    assert sharding.shard_documents(stored_documents(spark, tmp_path, [])).count() == 0


def test_no_python_in_the_plan(spark, tmp_path):
    plan = sharding.shard_documents(stored_documents(spark, tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
