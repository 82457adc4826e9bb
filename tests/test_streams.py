"""Streams: late data against the watermark, replay idempotence, stream == batch."""

import datetime as dt

from hexflow.session import scratch_path
from hexflow.sources.tables import SILVER_SCHEMA
from hexflow.streaming import jobs as S


def _silver(spark, times):
    rows = [("c1", 5, 25, None, "1", "Main", dt.datetime(2024, 1, 1, *t)) for t in times]
    return spark.createDataFrame(rows, SILVER_SCHEMA)


def test_late_rows_dropped_from_the_next_run(spark):
    base = scratch_path(spark, "t-late")
    silver, gold, ckpt = f"{base}/silver", f"{base}/gold", f"{base}/ckpt"
    _silver(spark, [(10, 0, 10), (9, 0, 0), (10, 0, 50)]).write.mode("append").parquet(silver)
    S.run_gold(spark, silver, gold, ckpt)
    first = {(r.window_start.hour, r.total_observations) for r in spark.read.parquet(gold).collect()}
    assert first == {(9, 1), (10, 2)}
    _silver(spark, [(10, 0, 55), (9, 0, 30)]).write.mode("append").parquet(silver)
    S.run_gold(spark, silver, gold, ckpt)
    second = {(r.window_start.hour, r.total_observations) for r in spark.read.parquet(gold).collect()}
    assert second == {(9, 1), (10, 3)}      # 09:00:30 is behind the 1 s watermark


def test_gold_replay_with_new_checkpoint_is_idempotent(spark):
    base = scratch_path(spark, "t-replay")
    silver, gold = f"{base}/silver", f"{base}/gold"
    _silver(spark, [(10, 0, 10), (10, 1, 0), (11, 0, 0)]).write.parquet(silver)
    S.run_gold(spark, silver, gold, f"{base}/ckpt1", f"{base}/alerts")
    once = sorted(tuple(r) for r in spark.read.parquet(gold).collect())
    S.run_gold(spark, silver, gold, f"{base}/ckpt2", f"{base}/alerts")   # checkpoint reset: full replay
    assert sorted(tuple(r) for r in spark.read.parquet(gold).collect()) == once


def test_landing_schema_widens(spark):
    base = scratch_path(spark, "t-schema")
    spark.createDataFrame([('{"currentSpeed": 4, "pulled_at": "x"}',)], "v string").write.text(f"{base}/l1")
    s1 = S.infer_landing_schema(spark, f"{base}/l1", f"{base}/schema")
    spark.createDataFrame([('{"newField": {"a": 1}}',)], "v string").write.text(f"{base}/l2")
    s2 = S.infer_landing_schema(spark, f"{base}/l2", f"{base}/schema")
    assert "newField" not in s1.fieldNames() and "newField" in s2.fieldNames()
    assert set(s1.fieldNames()) <= set(s2.fieldNames())
    assert all(f.dataType.simpleString() == "string" for f in s2.fields)


def test_one_pass_silver_equals_two_queries(spark):
    from hexflow.plans import medallion as M
    from hexflow.sources.fixtures import FIXTURE_AS_OF, bronze_view
    from hexflow.sources.tables import QUARANTINE_SCHEMA
    sf = "/root/testdata/sf0.001"
    base = scratch_path(spark, "t-onepass")
    bronze = bronze_view(spark, sf).drop("event_id")
    bronze.repartition(4).write.parquet(f"{base}/bronze")
    xw = M.crosswalk_of(spark, sf)
    S.run_silver(spark, f"{base}/bronze", bronze.schema, xw, f"{base}/s2", f"{base}/q2", f"{base}/c2",
                 as_of=FIXTURE_AS_OF)
    S.run_silver_one_pass(spark, f"{base}/bronze", bronze.schema, xw, f"{base}/s1", f"{base}/q1", f"{base}/c1",
                          as_of=FIXTURE_AS_OF, max_files=2)
    for one, two, schema in (("s1", "s2", SILVER_SCHEMA), ("q1", "q2", QUARANTINE_SCHEMA)):
        a = spark.read.parquet(f"{base}/{one}").drop("batch_id")
        b = spark.read.schema(schema).parquet(f"{base}/{two}")
        assert a.count() == b.count() > 0
        assert a.select(*b.columns).exceptAll(b).count() == 0


def test_scheduled_run_twice_without_new_files_changes_nothing(spark):
    from hexflow.plans import medallion as M
    from hexflow.sources.fixtures import FIXTURE_AS_OF, bronze_view, landing_records
    sf = "/root/testdata/sf0.001"
    base = scratch_path(spark, "t-sched")
    p = S.scheduled_paths(base)
    landing_records(bronze_view(spark, sf)).repartition(3).write.text(p["landing"])
    idx = M.road_index_of(spark, sf)
    S.run_scheduled(spark, base, idx, as_of=FIXTURE_AS_OF)
    first = sorted(tuple(r) for r in spark.read.parquet(p["gold"]).collect())
    silver_n = spark.read.parquet(p["silver"]).count()
    S.run_scheduled(spark, base, idx, as_of=FIXTURE_AS_OF)
    assert sorted(tuple(r) for r in spark.read.parquet(p["gold"]).collect()) == first
    assert spark.read.parquet(p["silver"]).count() == silver_n > 0


def test_scheduled_run_one_pass_matches_two_queries(spark):
    from hexflow.plans import medallion as M
    from hexflow.sources.fixtures import FIXTURE_AS_OF, bronze_view, landing_records
    sf = "/root/testdata/sf0.001"
    idx = M.road_index_of(spark, sf)
    golds = []
    for one_pass in (False, True):
        base = scratch_path(spark, "t-sched-1p")
        p = S.scheduled_paths(base)
        landing_records(bronze_view(spark, sf)).repartition(3).write.text(p["landing"])
        S.run_scheduled(spark, base, idx, as_of=FIXTURE_AS_OF, one_pass=one_pass)
        golds.append(sorted(tuple(r) for r in spark.read.parquet(p["gold"]).collect()))
    assert golds[0] == golds[1] and len(golds[0]) > 0


def test_new_checkpoint_on_written_table_is_refused(spark):
    import pytest
    base = scratch_path(spark, "t-refuse")
    spark.createDataFrame([('{"currentSpeed": 4}',)], "v string").write.text(f"{base}/landing")
    S.run_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/c1")
    S.run_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/c1")
    with pytest.raises(RuntimeError):
        S.run_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/c2")


def test_malformed_line_keeps_its_text_and_options_reach_the_reader(spark):
    base = scratch_path(spark, "t-corrupt")
    spark.createDataFrame([('{"currentSpeed": 27.5}',), ('{"currentSpeed": ',)], "v string").coalesce(1).write.text(f"{base}/landing/day=1")
    S.run_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/c1", None, 1, pathGlobFilter="*.txt")
    rows = spark.read.parquet(f"{base}/bronze").collect()
    assert sorted(str(r._corrupt_record) for r in rows) == ["None", '{"currentSpeed": ']


def test_scheduled_run_removes_its_scratch(spark):
    import os
    from hexflow.plans import medallion as M
    from hexflow.session import checkpoint_root
    from hexflow.sources.fixtures import FIXTURE_AS_OF, bronze_view, landing_records
    sf = "/root/testdata/sf0.001"
    base = scratch_path(spark, "t-own")
    landing_records(bronze_view(spark, sf)).repartition(3).write.text(S.scheduled_paths(base)["landing"])
    idx = M.road_index_of(spark, sf)
    root = f"{checkpoint_root(spark).removeprefix('file://')}/hexflow"
    before = set(os.listdir(root))
    S.run_scheduled(spark, base, idx, as_of=FIXTURE_AS_OF)
    assert set(os.listdir(root)) == before


def test_alert_log_survives_a_new_checkpoint(spark):
    base = scratch_path(spark, "t-alerts")
    silver, gold = f"{base}/silver", f"{base}/gold"
    rows = [("c1", 1, 50, None, "1", "Main", dt.datetime(2024, 1, 1, 10, 5, 0))]
    spark.createDataFrame(rows, SILVER_SCHEMA).write.parquet(silver)
    S.run_gold(spark, silver, gold, f"{base}/c1", f"{base}/alerts", as_of="2024-01-01 10:06:00")
    first = {(r.road_name, r.alerted_at) for r in spark.read.parquet(f"{base}/alerts").collect()}
    S.run_gold(spark, silver, gold, f"{base}/c2", f"{base}/alerts", as_of="2024-01-01 10:10:00")
    assert {(r.road_name, r.alerted_at) for r in spark.read.parquet(f"{base}/alerts").collect()} == first and len(first) == 1
