import json
from functools import reduce

import pytest
from pyspark.sql import DataFrame

from tests.conftest import rows
from usagelens import schemas
from usagelens.operators.adoption import adoption_by_period, adoption_from_ledger, user_ledger
from usagelens.operators.dedup import without_stream_repeats
from usagelens.operators.directory import harvest_names, reconcile_names
from usagelens.operators.routing import route
from usagelens.operators.turns import normalize_events
from usagelens.sources.sample_logs import SampleLogs
from usagelens.streaming import landing

TINY = "/root/testdata/sf0.001"
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


@pytest.fixture
def sample(spark):
    return SampleLogs(spark, TINY)


def arrive(df: DataFrame, folder: str, files: int) -> None:
    df.repartition(files).write.mode("append").option("timestampFormat", MICROS).json(folder)


def events_of(warehouse):
    return normalize_events(*[
        warehouse.read(t) for t in ("audit_access", "assistant_activity", "notebook_activity")
    ])


def test_stream_equals_batch_over_several_batches(spark, sample, warehouse, tmp_path):
    arrivals, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    arrive(sample.stream_entries, arrivals, 3)
    stream = landing.read_entries(spark, arrivals, max_files=1)
    after = [landing.refresh_ledger, landing.refresh_names]
    warehouse.replace(sample.agent_directory, "agent_directory")
    landing.land_activity(stream, warehouse, checkpoint, after_batch=after, once=True).awaitTermination()

    routed = route(sample.stream_entries)
    for table in schemas.LOG_TABLES:
        assert rows(warehouse.read(table), "insertId", "timestamp") == rows(
            routed.filter(f"table = '{table}'"), "insertId", "timestamp"
        )
    events = events_of(warehouse)
    assert rows(warehouse.read("user_ledger"), "user_email", "activity_date", "agent_ids_used") == rows(
        user_ledger(events), "user_email", "activity_date", "agent_ids_used"
    )
    assert rows(adoption_from_ledger(warehouse.read("user_ledger"))) == rows(adoption_by_period(events))
    # one rule for names, however the stream is cut: the latest
    batch = reconcile_names(sample.agent_directory, harvest_names(warehouse.read("assistant_activity")))
    columns = ("agent_id", "display_name", "agent_type")
    assert rows(warehouse.read("agent_directory"), *columns) == rows(batch, *columns)
    assert rows(warehouse.read("usage_events"), "user_email", "agent_id") == rows(events, "user_email", "agent_id")


def test_late_rows_change_only_their_days(spark, sample, warehouse, tmp_path):
    arrivals, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    late_day = "to_date(timestamp) = DATE '2024-01-10'"

    def land():
        stream = landing.read_entries(spark, arrivals)
        landing.land_activity(
            stream, warehouse, checkpoint, after_batch=[landing.refresh_ledger], once=True
        ).awaitTermination()

    arrive(sample.stream_entries.filter(f"NOT ({late_day} AND insertId % 2 = 0)"), arrivals, 1)
    land()
    before = {f for f in warehouse.read("user_ledger").inputFiles()}
    arrive(sample.stream_entries.filter(f"{late_day} AND insertId % 2 = 0"), arrivals, 1)
    land()
    changed = {f for f in warehouse.read("user_ledger").inputFiles()} - before
    assert changed and all("activity_date=2024-01-10" in f for f in changed)
    assert rows(warehouse.read("user_ledger"), "user_email", "activity_date") == rows(
        user_ledger(events_of(warehouse)), "user_email", "activity_date"
    )


def test_a_repeated_batch_is_not_doubled(spark, sample, warehouse, tmp_path):
    arrivals = str(tmp_path / "in")
    arrive(sample.stream_entries, arrivals, 1)
    for attempt in range(2):  # a lost checkpoint replays the same batches under the old identity
        stream = landing.read_entries(spark, arrivals)
        landing.land_activity(
            stream, warehouse, str(tmp_path / f"c{attempt}"), once=True, identity="main"
        ).awaitTermination()
    landed = reduce(DataFrame.unionByName, [warehouse.read(t).select("insertId") for t in schemas.LOG_TABLES])
    assert landed.count() == route(sample.stream_entries).count()


def test_method_list_is_a_parameter(spark):
    entry = {"serviceName": "discoveryengine.googleapis.com", "methodName": "x.SourceService.Create"}
    log = "projects/p/logs/cloudaudit.googleapis.com%2Fdata_access"
    df = spark.createDataFrame(
        [(None, log, "1", "INFO", None, json.dumps(entry))], schemas.STREAM_ENTRY
    )
    assert route(df).isEmpty()
    assert rows(route(df, ["x.SourceService.Create"]), "table") == [("audit_access",)]


def test_stream_repeats(spark, tmp_path):
    arrivals = str(tmp_path / "in")
    same = {"timestamp": "2024-01-01T00:00:00Z", "logName": "l", "insertId": "1", "jsonPayload": {"a": 1}}
    other_day = same | {"timestamp": "2024-01-02T00:00:00Z"}
    anonymous = same | {"insertId": None}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(
        "\n".join(json.dumps(e) for e in (same, same, other_day, anonymous, anonymous))
    )
    stream = without_stream_repeats(landing.read_entries(spark, arrivals))
    query = stream.writeStream.format("memory").queryName("kept").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.table("kept"), "insertId") == [("1",), ("1",), (None,), (None,)]


def land(spark, warehouse, arrivals, checkpoint, **options):
    landing.land_activity(
        landing.read_entries(spark, arrivals), warehouse, checkpoint, once=True, **options
    ).awaitTermination()


def test_streams_of_one_warehouse_keep_apart(spark, sample, warehouse, tmp_path):
    even, odd = (sample.stream_entries.filter(f"insertId % 2 = {i}") for i in (0, 1))
    for name, part in (("a", even), ("b", odd)):
        arrive(part, str(tmp_path / name), 1)
        land(spark, warehouse, str(tmp_path / name), str(tmp_path / f"checkpoint-{name}"))
    landed = reduce(DataFrame.unionByName, [warehouse.read(t).select("insertId") for t in schemas.LOG_TABLES])
    assert rows(landed) == rows(route(sample.stream_entries), "insertId")


def test_a_half_committed_batch_is_replayed(spark, sample, warehouse, tmp_path):
    import shutil

    arrivals, after = str(tmp_path / "in"), [landing.refresh_ledger]
    arrive(sample.stream_entries.filter("insertId % 3 > 0"), arrivals, 1)
    land(spark, warehouse, arrivals, str(tmp_path / "c"), after_batch=after, identity="s")
    arrive(sample.stream_entries.filter("insertId % 3 = 0"), arrivals, 1)
    land(spark, warehouse, arrivals, str(tmp_path / "c"), after_batch=after, identity="s")
    expected = rows(warehouse.read("user_ledger"), "user_email", "activity_date", "agent_ids_used")
    # the second batch's ledger is lost with its commit: the same batch runs again
    (tmp_path / "c" / "commits" / "1").unlink()
    for crc in (tmp_path / "c" / "commits").glob(".1.crc"):
        crc.unlink()
    for part in (tmp_path / "warehouse" / "user_ledger").glob("activity_date=*/load_id=stream-s-1"):
        shutil.rmtree(part)
    land(spark, warehouse, arrivals, str(tmp_path / "c"), after_batch=after, identity="s")
    assert rows(warehouse.read("user_ledger"), "user_email", "activity_date", "agent_ids_used") == expected


def test_views_follow_what_lands(spark, sample, warehouse, tmp_path):
    from usagelens.plans import views

    views.register_live(warehouse)
    assert spark.table("vw_feature_adoption_summary").count() == 0
    assert spark.table("vw_agent_creators").count() == spark.table("vw_unified_metrics").count() == 0
    arrivals = str(tmp_path / "in")
    for turn in range(2):
        arrive(sample.stream_entries.filter(f"insertId % 2 = {turn}"), arrivals, 1)
        land(spark, warehouse, arrivals, str(tmp_path / "c"), after_batch=[landing.refresh_names])
        expected = adoption_by_period(events_of(warehouse))
        assert rows(spark.table("vw_feature_adoption_summary")) == rows(expected)
    warehouse.replace(sample.agent_directory, "agent_directory")
    warehouse.replace(sample.agent_creators, "agent_creators")
    warehouse.append(sample.session_metrics, "agent_session_metrics", "one")
    tables = warehouse.read_all()
    assert rows(spark.table("vw_agent_creators")) == rows(
        views.creator_attribution(tables["agent_creators"], tables["agent_directory"])
    )
    assert rows(spark.table("vw_unified_metrics")) == rows(
        views.agent_leaderboard(tables["agent_session_metrics"], tables["agent_directory"])
    )
    plan = spark.sql("SELECT * FROM vw_feature_adoption_summary WHERE time_period = DATE '2024-01-10'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in text and "PartitionFilters: [" in text and "2024-01-10" in text


def test_stream_repeats_free_their_state(spark, tmp_path):
    arrivals, checkpoint, out = (str(tmp_path / name) for name in ("in", "c", "out"))
    kept = []
    for day in range(1, 7):
        entry = {"timestamp": f"2024-01-{day * 4:02d}T00:00:00Z", "logName": "l", "insertId": str(day), "jsonPayload": {}}
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{day}.json").write_text("\n".join(json.dumps(entry) for _ in range(2)))
        stream = without_stream_repeats(landing.read_entries(spark, arrivals))
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        query = query.trigger(availableNow=True).start()
        query.awaitTermination()
        kept.append(sum(o["numRowsTotal"] for o in query.lastProgress["stateOperators"]))
    assert rows(spark.read.parquet(out), "insertId") == [(str(day),) for day in range(1, 7)]
    assert kept[-1] < 4
