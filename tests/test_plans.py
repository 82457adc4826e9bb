"""Physical plan checks: join strategies, pushdown, no fan-out in the gold plan."""

from hexflow.operators.enrich import enrich
from hexflow.operators.joins import small_side
from hexflow.plans import medallion as M

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_enrich_strategies(spark):
    reads = M.readings_of(spark, SF)
    xw = M.crosswalk_of(spark, SF)
    assert "BroadcastHashJoin" in _plan(enrich(reads, xw, "auto", crosswalk_checked=True))
    assert "SortMergeJoin" in _plan(enrich(reads, xw, "merge"))
    assert "ShuffledHashJoin" in _plan(enrich(reads, xw, "shuffle_hash"))


def test_broadcast_only_within_the_bound(spark):
    df = spark.range(100)
    _, how = small_side(df, "auto", max_rows=1000)
    assert how == "broadcast"
    _, how = small_side(df, "broadcast", max_rows=10)
    assert how == "shuffle"     # a broadcast request is never honoured past the bound


def test_scan_prunes_columns(spark):
    import re
    plan = M.readings_of(spark, SF)._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(f.split(":")[0] for f in schema.split(",")) == ["event_id", "ts", "user_id", "value"]


def test_gold_plan_aggregates_before_the_join(spark):
    plan = _plan(M.gold_of(spark, SF))
    # partial aggregation of readings per (window, cell) happens below the join
    join_at = plan.find("BroadcastHashJoin")
    assert join_at > 0
    assert plan.count("HashAggregate") >= 3



def test_broadcast_refused_past_the_byte_bound(spark):
    from pyspark.sql import functions as F
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("name"))
    _, how = small_side(df, "auto", max_rows=1000, max_bytes=50_000)
    assert how == "shuffle"           # 100 rows but ~100 KB
    _, how = small_side(df, "auto", max_rows=1000, max_bytes=1_000_000)
    assert how == "broadcast"
