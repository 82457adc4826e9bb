"""Round 3: what streams send to the driver, work done once, sums before windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from hexflow.operators import enrich as EN
from hexflow.operators import joins as J
from hexflow.operators.enrich import enrich, join_crosswalk, join_crosswalk_salted, readings, silver_rows
from hexflow.operators.roads import traffic_cells
from hexflow.operators.windows import congestion_windows, gold_from_readings
from hexflow.plans import medallion as M
from hexflow.plans import registry as R
from hexflow.session import scratch_path
from hexflow.sources import tables as TB
from hexflow.sources.tables import upsert
from hexflow.streaming import jobs as S
from hexflow.streaming import table_jobs as TJ
from tests.oracle_check import duck

AS_OF = "2024-01-31 00:00:00"
CELLS = ("10:1:1", "10:2:2", "10:3:3")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def crosswalk(spark):
    return spark.createDataFrame([(c, str(10 * i + j), None if j == 3 else f"R{j}") for i, c in enumerate(CELLS) for j in range(4)],
                                 "h3_id string, osm_id string, full_road_name string")


@pytest.fixture
def reads(spark):
    start = dt.datetime(2024, 1, 2, 3, 0, 10)
    return spark.createDataFrame([(CELLS[i % 3] if i % 7 else None, i % 170, 20 + i % 2 * 10, start + dt.timedelta(seconds=37 * i)) for i in range(300)],
                                 "h3_id string, currentSpeed int, freeFlowSpeed int, ingest_time timestamp")


@pytest.fixture
def bronze(spark):
    point = '{"coordinate":[{"latitude":40.%d,"longitude":-74.11}]}'
    return spark.createDataFrame([(None if i % 5 == 0 else str(i), "30", None if i % 6 == 0 else point % (10000 + 200 * (i % 4)), None,
                                   "Tue Jan  2 03:04:05 2024") for i in range(24)],
                                 "currentSpeed string, freeFlowSpeed string, coordinates string, flowSegmentData string, pulled_at string")


# ---------------------------------------------------------------- what a stream sends

def test_a_stream_broadcasts_few_bytes_only(spark, crosswalk, reads, monkeypatch):
    small = join_crosswalk(reads, J.stream_side(crosswalk))
    assert "BroadcastHashJoin" in plan(small)
    monkeypatch.setattr(J, "STREAM_BROADCAST_BYTES", 10)
    large = join_crosswalk(reads, J.stream_side(crosswalk))
    assert "Broadcast" not in plan(large) and "SortMergeJoin" in plan(large)
    assert rows(large) == rows(small)


@pytest.mark.parametrize("run", ["run_silver", "run_silver_one_pass"])
def test_silver_without_broadcast(spark, crosswalk, bronze, monkeypatch, run):
    """Both sinks get the batch's rows, and no side is broadcast, when the crosswalk is over the bound."""
    monkeypatch.setattr(J, "STREAM_BROADCAST_BYTES", 10)
    xw = crosswalk.withColumn("h3_id", F.lit(readings(bronze, as_of=AS_OF).first()["h3_id"]))
    sides = []
    joined = S.join_crosswalk
    monkeypatch.setattr(S, "join_crosswalk", lambda r, s: sides.append(s) or joined(r, s))
    base = scratch_path(spark, "silver-sides")
    bronze.repartition(3).write.parquet(f"{base}/bronze")
    getattr(S, run)(spark, f"{base}/bronze", bronze.schema, xw, f"{base}/silver", f"{base}/bad", f"{base}/ckpt", as_of=AS_OF, max_files=1, keep_unparsed=True)
    want = enrich(readings(bronze, as_of=AS_OF, keep_unparsed=True), xw)
    silver, bad = (spark.read.parquet(f"{base}/{t}").drop("batch_id") for t in ("silver", "bad"))
    assert rows(silver) == rows(silver_rows(want))
    assert rows(bad) == rows(EN.quarantine_rows(want, unparsed=True))
    assert sides and all("Broadcast" not in plan(joined(readings(bronze, as_of=AS_OF), s)) for s in sides)


# ---------------------------------------------------------------- work done once

@pytest.mark.parametrize("keep", [False, True])
def test_a_payload_is_parsed_and_its_cell_computed_once(spark, bronze, crosswalk, keep):
    text = plan(silver_rows(join_crosswalk(readings(bronze, as_of=AS_OF, keep_unparsed=keep), F.broadcast(crosswalk))))
    assert text.count("$.coordinate[0].latitude") == 1 and text.count("transform(") == 1


def test_readings_keep_unparsed_rows_and_other_columns(spark, bronze):
    r = readings(bronze.withColumn("id", F.lit(7)), as_of=AS_OF, keep_unparsed=True, keep=("id",))
    assert r.columns == ["h3_id", "currentSpeed", "freeFlowSpeed", "ingest_time", "id"] and r.count() == 24
    assert rows(r.where("h3_id IS NOT NULL AND currentSpeed IS NOT NULL").drop("id")) == rows(readings(bronze, as_of=AS_OF))


def test_a_filter_on_cells_does_not_parse_again(spark, bronze):
    cells = traffic_cells(bronze)
    assert plan(cells.where("h3_id IS NOT NULL")).count("$.coordinate[0].latitude") == 1
    assert cells.count() == 5 and cells.where("h3_id IS NULL").count() == 1


def test_salted_join_counts_and_joins_stored_reads(spark, crosswalk, reads, monkeypatch):
    seen, count = [], EN.hot_cells
    monkeypatch.setattr(EN, "hot_cells", lambda r, slots: seen.append(r.inputFiles()) or count(r, slots))
    assert rows(join_crosswalk_salted(reads, crosswalk, 8)) == rows(join_crosswalk(reads, crosswalk))
    assert seen[0]


def test_a_batch_without_new_cells_leaves_the_roads_alone(spark, bronze, monkeypatch):
    cells = traffic_cells(bronze)
    index = cells.where("h3_id IS NOT NULL").select("h3_id", F.lit("1").alias("osm_id"), F.lit("R").alias("full_road_name"))
    built, build = [], S.build_crosswalk
    monkeypatch.setattr(S, "build_crosswalk", lambda *a, **k: built.append(1) or build(*a, **k))
    base = scratch_path(spark, "no-new-cells")
    write = S.crosswalk_batch_writer(index, f"{base}/xw", f"{base}/seen")
    write(bronze, 0)
    write(bronze, 1)
    assert len(built) == 1 and rows(S.read_crosswalk(spark, f"{base}/xw")) == rows(index)
    write(bronze, 0)                                    # a batch that is repeated replaces its own rows
    assert len(built) == 2 and rows(S.read_crosswalk(spark, f"{base}/xw")) == rows(index)
    more = bronze.withColumn("coordinates", F.lit('{"coordinate":[{"latitude":41.5,"longitude":-74.11}]}'))
    write(more, 2)
    assert len(built) == 3 and spark.read.parquet(f"{base}/seen").count() == 5


def test_the_road_index_is_computed_once_a_run(spark, monkeypatch):
    class Seen(Exception):
        pass

    def refresh(spark, index, *paths):
        raise Seen(index.inputFiles())
    monkeypatch.setattr(S, "infer_landing_schema", lambda *a: None)
    monkeypatch.setattr(S, "run_bronze", lambda *a, **k: None)
    monkeypatch.setattr(S, "refresh_crosswalk", refresh)
    index = spark.createDataFrame([("c", "1", "R")], "h3_id string, osm_id string, full_road_name string")
    with pytest.raises(Seen) as e:
        S.run_scheduled(spark, scratch_path(spark, "once"), index)
    assert e.value.args[0]


def test_gold_batches_are_stored_once(spark, reads, crosswalk, monkeypatch):
    seen, put = [], S.upsert
    monkeypatch.setattr(S, "upsert", lambda sp, path, rows, **k: seen.append(rows.inputFiles()) or put(sp, path, rows, **k))
    silver = silver_rows(join_crosswalk(reads, crosswalk))
    target = scratch_path(spark, "gold-once")
    S.gold_batch_writer(target, None)(congestion_windows(silver, keep_window=True), 0)
    assert seen[0] and rows(spark.read.parquet(target).drop("window_date")) == rows(congestion_windows(silver))


def test_upsert_of_staged_unique_rows(spark, monkeypatch):
    target = scratch_path(spark, "staged")
    schema = "road_name string, window_start timestamp, v int"
    t = lambda d: dt.datetime(2024, 1, d)
    first = J.materialize(spark.createDataFrame([("a", t(1), 1), (None, t(2), 2), ("c", None, 3)], schema))
    made, keep = [], TB.materialize
    monkeypatch.setattr(TB, "materialize", lambda df, name, **k: made.append(name) or keep(df, name, **k))
    assert upsert(spark, target, first, unique=True, staged=True) == 3 and made == []        # nothing to merge with
    second = J.materialize(spark.createDataFrame([("b", t(1), 9), (None, t(2), 8), ("c", None, 7)], schema))
    assert upsert(spark, target, second, unique=True, staged=True) == 3 and made == ["upsert-merged"]
    got = spark.read.parquet(target).select("road_name", "window_start", "v")
    assert rows(got) == rows(spark.createDataFrame([("a", t(1), 1), ("b", t(1), 9), (None, t(2), 8), ("c", None, 7)], schema))


def test_table_runs_join_without_broadcast_beyond_the_bound():
    assert TJ.stream_side is J.stream_side


@pytest.fixture
def own_tables(spark, tmp_path):
    start = dt.datetime(2024, 1, 5, 1, 0, 0)
    spark.createDataFrame([(i, start + dt.timedelta(minutes=i % 90), i % 30, "x", float(i % 60), "{}") for i in range(400)],
                          "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(i, f"c{i}", i % 25, 0.0, "S") for i in range(200)],
                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_table_sizes_derives_crosswalk_and_readings_once(spark, own_tables, monkeypatch):
    made = []
    for name in ("crosswalk_of", "readings_of"):
        monkeypatch.setattr(M, name, lambda *a, _f=getattr(M, name), _n=name, **k: made.append(_n) or _f(*a, **k))
    got = {r["table_name"]: r["num_rows"] for r in R.QUERIES["table_sizes"](spark, own_tables).collect()}
    assert sorted(made) == ["crosswalk_of", "readings_of"]
    assert got == {"crosswalk": M.crosswalk_of(spark, own_tables).count(), "silver": M.silver_of(spark, own_tables).count(),
                   "quarantine": M.quarantine_of(spark, own_tables).count(), "gold": M.gold_of(spark, own_tables).count()}


def test_merged_duplicates_are_derived_once(spark, own_tables, monkeypatch):
    seen, put = [], R.upsert
    monkeypatch.setattr(R, "upsert", lambda sp, path, rows, **k: seen.append((rows.inputFiles(), rows.count())) or put(sp, path, rows, **k))
    got = R.QUERIES["gold_merge_duplicates"](spark, own_tables)
    (both, n2), (one, n1) = seen
    assert set(both) == set(one) and "merge-batch" in one[0] and n2 == 2 * n1 == 2 * got.count()


# ---------------------------------------------------------------- sums before windows

def test_sliding_windows_copy_sums_of_roads_not_of_cells(spark, reads, crosswalk):
    gold = gold_from_readings(reads, crosswalk, "10 minutes", "1 minute")
    text = gold._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Expand") < text.index("Join")                  # windows above the join with the weights
    want = congestion_windows(silver_rows(join_crosswalk(reads, crosswalk)), "10 minutes", "1 minute")
    six = lambda df: rows(df.withColumn("avg_congestion_index", F.round("avg_congestion_index", 6)))
    assert six(gold) == six(want)


@pytest.mark.parametrize("name", ["table_detail", "layout_on_write", "table_sizes", "compact_reduction"])
def test_boolean_results_match_duckdb(spark, name):
    sf = "/root/testdata/sf0.001"
    got = E.queries()[name](spark, sf)
    assert "NestedLoop" not in plan(got) and rows(got) == sorted(duck(sf).sql(E.oracle_sql()[name]).fetchall(), key=repr)
