"""Entries that have landed before are dropped, late ones are not."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from tests.conftest import rows
from usagelens import schemas
from usagelens.sources import entry_keys
from usagelens.sources.sample_logs import SampleLogs
from usagelens.streaming import landing

TINY = "/root/testdata/sf0.001"
ROUTED = "timestamp timestamp, logName string, insertId string, severity string, jsonPayload string, protopayload_auditlog string, table string"


def batch(spark, data):
    return spark.createDataFrame([(t, "l", i, "INFO", p, None, "assistant_activity") for t, i, p in data], ROUTED)


def land(warehouse, df, load_id):
    fresh = entry_keys.unseen(warehouse, df, load_id)
    warehouse.append_logs(fresh, load_id)
    entry_keys.remember(warehouse, fresh, load_id)
    return fresh


def test_random_batches_equal_brute_force(spark, warehouse, monkeypatch):
    monkeypatch.setattr(entry_keys, "BUCKETS", 2)  # the few bits collide, the identities decide
    monkeypatch.setattr(entry_keys, "_BITS", 8)
    draw = random.Random(3)
    known, nameless = set(), Counter()
    for number in range(4):
        data = [
            (draw.choice([None, dt.datetime(2024, 1, draw.randint(1, 5), 3)]), draw.choice([None, *map(str, range(25))]), draw.choice([None, "a", "bb", "bbb"]))
            for _ in range(120)
        ]
        got = land(warehouse, batch(spark, data), f"load-{number}").collect()
        named = {(t, i) for t, i, _ in data if i is not None}
        assert Counter((r.timestamp, r.insertId) for r in got if r.insertId is not None) == Counter(named - known)
        longest = {}
        for t, i, p in data:
            longest[t, i] = max(longest.get((t, i), (-1, "")), (len(p), p) if p else (-1, ""))
        assert all((r.jsonPayload or "") == longest[r.timestamp, r.insertId][1] for r in got if r.insertId is not None)
        known |= named
        nameless += Counter((t, p) for t, i, p in data if i is None)
    landed = warehouse.read("assistant_activity")
    assert landed.filter("insertId IS NOT NULL").count() == len(known)
    assert Counter((r.timestamp, r.jsonPayload) for r in landed.filter("insertId IS NULL").collect()) == nameless


def test_repeated_batch_gives_its_rows_again(spark, warehouse):
    day = dt.datetime(2024, 1, 1)
    land(warehouse, batch(spark, [(day, "1", "x"), (day, "2", "x")]), "one")
    second = batch(spark, [(day, "2", "x"), (day, "3", "x"), (day + dt.timedelta(days=400), "1", "x")])
    for _ in range(2):
        assert rows(land(warehouse, second, "two"), "insertId") == [("1",), ("3",)]
    assert warehouse.read("assistant_activity").count() == 4


def test_only_the_days_of_the_batch_are_asked(spark, warehouse):
    for number in range(1, 4):
        land(warehouse, batch(spark, [(dt.datetime(2024, 1, number), str(number), "x")]), f"load-{number}")
    days = spark.createDataFrame([(dt.date(2024, 1, 2),)], "event_date date")
    plan = entry_keys.rows_in(warehouse.parts("entry_keys"), "event_date", days)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-02" in plan


def test_rows_later_than_the_delay_are_not_lost(spark, warehouse, tmp_path):
    entries = SampleLogs(spark, TINY).stream_entries
    arrivals, micros = str(tmp_path / "in"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    late = F.col("timestamp") < F.lit("2024-01-08").cast("timestamp")
    counts = {}
    for part in (entries.filter(~late), entries):
        part.write.mode("append").option("timestampFormat", micros).json(arrivals)
        stream = landing.read_entries(spark, arrivals)
        query = landing.land_activity(stream, warehouse, str(tmp_path / "checkpoint"), once=True, typed=False, only_new=True)
        query.awaitTermination()
        assert all(not progress["stateOperators"] for progress in query.recentProgress)
        counts[len(counts)] = sum(warehouse.read(t).count() for t in schemas.LOG_TABLES)
    assert 0 < counts[0] < counts[1]
    landed = warehouse.read("assistant_activity").select("insertId").unionByName(warehouse.read("notebook_activity").select("insertId"))
    wanted = entries.filter("protoPayload IS NULL").select("insertId")
    assert rows(landed) == rows(wanted)
