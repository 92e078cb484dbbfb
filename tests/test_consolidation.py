from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridpulse.functions.calendar import local_time
from gridpulse.functions.scalars import clip_at_zero, human_bytes, id_from_label, is_finite
from gridpulse.operators import areas, series
from gridpulse.plans.consolidate import build_matrix, stage_raw
from gridpulse.session import scratch_path
from gridpulse.sources import raw, tables
from gridpulse.streaming.ingest import ingest_new_files, read_ingested

STUDY = ("2013-11-01", "2013-12-31")
DAYS = {
    "day1": ["1\t1383260400000\t39\t\t\t\t\t1.5", "1\t1383260400000\t33\t\t\t\t\t0.5", "1\t1383260400000\t0\t\t\t\t\t",
             "1\t1383261000000\t39\t\t\t\t\t2.0", "2\t1383260400000\t39\t\t\t\t\t"],
    "day2": ["3\t1383260400000\t39\t\t\t\t\t9.9", "3\t1383346800000\t39\t\t\t\t\t4.0"],
    "day3": ["4\t1388530800000\t39\t\t\t\t\t7.0"],
}


@pytest.fixture
def raw_dir(tmp_path):
    for name, lines in DAYS.items():
        folder = tmp_path / "raw" / name
        folder.mkdir(parents=True)
        (folder / f"{name}.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "raw" / "notes.csv").write_text("not a raw file\n")
    return str(tmp_path / "raw")


def cells(frame):
    return {(r.area_id, r.ts): r.value for r in frame.collect()}


def test_consolidation_of_hand_made_files(spark, raw_dir):
    staged = stage_raw(spark, [raw_dir], scratch_path(spark, "staged"))
    matrix = build_matrix(staged, STUDY)
    got = cells(matrix)
    assert len(got) == 12
    assert {k: v for k, v in got.items() if v} == {
        (1, datetime(2013, 11, 1)): 2.0, (1, datetime(2013, 11, 1, 0, 10)): 2.0, (3, datetime(2013, 11, 2)): 4.0,
    }
    totals = areas.totals(matrix)
    direct = areas.totals_of_records(staged.where("source NOT LIKE '%day2%'"), STUDY)
    assert {r.area_id: r.total_traffic for r in direct.collect()} == {1: 4.0, 2: 0.0, 4: 0.0}
    assert {r.area_id: r.total_traffic for r in totals.collect()} == {1: 4.0, 2: 0.0, 3: 4.0, 4: 0.0}
    assert areas.busiest(totals).first().area_id == 1


def test_duplicate_timestamps_can_be_added_up(spark, raw_dir):
    staged = stage_raw(spark, [raw_dir], scratch_path(spark, "staged"))
    got = cells(build_matrix(staged, STUDY, duplicates="sum"))
    assert got[(3, datetime(2013, 11, 1))] == 9.9
    with pytest.raises(ValueError):
        build_matrix(staged, STUDY, duplicates="last")


def test_keep_first_file(spark, raw_dir):
    kept = series.keep_first_file(raw.activity(raw.scan(spark, raw_dir)), "source")
    assert {(r.area_id, r.ts.day, r.ts.month) for r in kept.collect()} == {(1, 1, 11), (2, 1, 11), (3, 2, 11), (4, 1, 1)}


def test_empty_window_gives_no_rows(spark, raw_dir):
    records = raw.activity(raw.scan(spark, raw_dir))
    assert series.dense_series(records, ("2020-01-01", "2020-01-02")).count() == 0


def test_raw_files(spark, raw_dir, tmp_path):
    files = raw.discover(spark, raw_dir)
    assert [r.path.rsplit("/", 1)[1] for r in files.collect()] == ["day1.txt", "day2.txt", "day3.txt"]
    size = sum(len("\n".join(lines)) + 1 for lines in DAYS.values())
    assert raw.total_bytes(files).first().asDict() == {"files": 3, "bytes": size}
    first = raw.first_sources(files, 2)
    assert raw.scan(spark, *first).count() == 7
    assert [p.rsplit("/", 1)[1] for p in raw.first_sources(files, 1, "folder")] == ["day1"]
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        raw.discover(spark, str(tmp_path / "empty"))


def test_pruned_scan_reads_three_columns(spark, raw_dir):
    records = raw.activity(raw.scan(spark, raw_dir)).groupBy("area_id", "ts").agg(F.sum("value"))
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<square_id:int,time_ms:bigint,internet:double>" in plan


def test_volume_report_reproduces_published_sizes(spark):
    # 4,842,625 records in 1,439,982 cells, each cell once and one of them many times.
    cells_ = spark.range(1_439_982).select(F.col("id").cast("int").alias("area_id"), F.lit(0).alias("ts"))
    more = spark.range(4_842_625 - 1_439_982).select(F.lit(0).alias("area_id"), F.lit(0).alias("ts"))
    naive, optimised = raw.volume_report(cells_.union(more)).orderBy("variant").collect()
    assert (naive.memory_bytes, naive.memory_human, naive.columns) == (309_928_132, "295.57 MB", 8)
    assert (optimised.memory_bytes, optimised.memory_human, optimised.columns) == (20_159_880, "19.23 MB", 3)
    assert round(float(optimised.reduction_pct), 1) == 93.5


def test_local_time_does_not_depend_on_the_session_zone(spark):
    frame = spark.createDataFrame([(1383260400123,)], "ms long").select(local_time("ms", 1).alias("ts"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert frame.select(F.col("ts").cast("string")).first()[0] == "2013-11-01 00:00:00.123"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_incremental_ingest_equals_batch(spark, tmp_path):
    folder, store, checkpoint = tmp_path / "raw", str(tmp_path / "store"), str(tmp_path / "checkpoint")
    folder.mkdir()

    def lines(day):
        return "".join(
            f"{square}\t{1383260400000 + day * 86400000 + i * 600000}\t{country}\t\t\t\t\t{square + i + country / 10}\n"
            for square in (1, 2) for i in range(4) for country in (39, 33)
        )

    for day in range(2):
        (folder / f"day{day}.txt").write_text(lines(day))
        ingest_new_files(spark, str(folder), store, checkpoint)
    batch = cells(series.rollup(raw.activity(raw.scan(spark, str(folder)))))
    assert len(batch) == 16 and cells(read_ingested(spark, store)) == batch
    assert max(ts for _, ts in batch) == datetime(2013, 11, 2, 0, 30)
    ingest_new_files(spark, str(folder), store, checkpoint)
    assert cells(read_ingested(spark, store)) == batch
    # As after a driver lost between writing the last batch and noting it: the batch is replayed, nothing doubles.
    commits = tmp_path / "checkpoint" / "commits"
    for note in (commits / "1", commits / ".1.crc"):
        note.unlink()
    ingest_new_files(spark, str(folder), store, checkpoint)
    assert (commits / "1").exists() and cells(read_ingested(spark, store)) == batch
    sourced = read_ingested(spark, store, keep_source=True)
    assert cells(series.dense_series(sourced, source="source")) == batch


def test_dense_series_with_hot_area(spark):
    """One area holds most of the records; every cell still comes out once with its full sum."""
    hot = spark.range(20_000).selectExpr("1 AS area_id", "id % 50 AS k", "1.0D AS value")
    cold = spark.range(300).selectExpr("CAST(2 + id AS INT) AS area_id", "id % 70 AS k", "2.0D AS value")
    records = hot.union(cold).select(
        F.col("area_id").cast("int"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, CAST(k AS INT))").alias("ts"), "value"
    )
    dense = series.dense_series(records)
    assert dense.count() == 301 * 70 == dense.select("area_id", "ts").distinct().count()
    sums = {r.area_id: r.total_traffic for r in areas.totals(dense).where("area_id < 4").collect()}
    assert sums == {1: 20_000.0, 2: 2.0, 3: 2.0}


def test_dense_series_joins_cells_never_records(spark, daily, tmp_path, monkeypatch):
    """Without broadcasts: the joins on time read kept cells, and the records are scanned once."""
    records = daily({1: [1, 2, 3, 4], 5: [7]}).union(daily({2: [9, 9]}, start=datetime(2024, 1, 3)))
    want = cells(series.dense_series(records))
    records.write.parquet(f"{tmp_path}/records")
    stored, kept = spark.read.parquet(f"{tmp_path}/records"), []
    keep = series.materialize
    monkeypatch.setattr("gridpulse.session.BROADCAST_MAX_BYTES", 1)
    monkeypatch.setattr(series, "materialize", lambda df: kept.append(df) or keep(df))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    held = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        dense = series.dense_series(stored)
        assert cells(dense) == want and len(want) == 12
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (*kept, dense)]
        assert "HashAggregate" in plans[0] and "Join" not in plans[0]
        assert "FileScan" in plans[0] and not any("FileScan" in plan for plan in plans[1:])  # one kept plan reads the records
        assert "SortMergeJoin" in plans[-1]
    finally:
        spark.conf.set(threshold, held)


def test_windows_reuse_the_partitioning_of_a_dense_series(spark, daily):
    from gridpulse.operators import anomaly, temporal

    dense = series.dense_series(daily({1: [1, 2, 3], 2: [1, None, 3]}))
    exchanges = [
        frame._jdf.queryExecution().executedPlan().toString() for frame in (dense, temporal.rolling(dense, 2), anomaly.anomalies(dense))
    ]
    assert len({plan.count("Exchange hashpartitioning(area_id") for plan in exchanges}) == 1
    assert not any("CartesianProduct" in plan or "NestedLoop" in plan for plan in exchanges)


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from gridpulse import session

    assert session.is_local("local") and session.is_local("local[4]")
    assert not session.is_local("local-cluster[2,1,512]") and not session.is_local("yarn")
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake)
    assert spark.sparkContext.getConf().get("spark.cleaner.referenceTracking.cleanCheckpoints") == "true"


def test_targets(spark):
    def chosen(totals, fixed):
        frame = spark.createDataFrame(list(totals.items()), "area_id int, total_traffic double")
        return {r.label: r.area_id for r in areas.target_areas(frame, fixed).collect()}

    assert chosen({1: 40.0, 2: 30.0, 3: 20.0, 4: 10.0}, [3, 99]) == {"highest": 1, "fixed_1": 3, "fixed_2": 2}
    with pytest.raises(ValueError):
        chosen({1: 2.0, 2: 1.0}, [98, 99])


def test_global_rank_with_long_ties(spark):
    frame = spark.range(1000).selectExpr("CAST(999 - id AS INT) AS area_id", "CASE WHEN id < 600 THEN 0D ELSE CAST(id AS DOUBLE) END AS total_traffic")
    ranked = areas.ranked_by_total(frame).orderBy("rank").collect()
    assert [r.rank for r in ranked] == list(range(1000)) and {r.n for r in ranked} == {1000}
    want = sorted(((r.area_id, r.total_traffic) for r in frame.collect()), key=lambda r: (-r[1], r[0]))
    assert [(r.area_id, r.total_traffic) for r in ranked] == want
    picks = {r.pick: r.area_id for r in areas.substitutes(frame).collect()}
    assert picks == {0: want[333][0], 1: want[666][0]}


def test_global_rank_over_several_sort_tasks(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    held = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        frame = spark.range(5000).selectExpr("CAST(id AS INT) AS area_id", "CAST(id % 3 AS DOUBLE) AS total_traffic")
        ranked = areas.ranked_by_total(frame)
        assert ranked.select(F.spark_partition_id()).distinct().count() > 1
        got = [(r.area_id, r.rank) for r in ranked.orderBy("rank").collect()]
    finally:
        spark.conf.set(key, held)
    want = sorted(range(5000), key=lambda i: (-(i % 3), i))
    assert got == [(a, i) for i, a in enumerate(want)]


def test_one_area(daily):
    frame = daily({1: [1, 2], 7: [3, 4]})
    assert {r.series for r in series.one_area(frame, 7).collect()} == {"area_7"}
    with pytest.raises(KeyError):
        series.one_area(frame, 3)


def test_wide_frames_with_different_columns(daily):
    one, two = series.wide_matrix(daily({1: [1, 2]}), [1]), series.wide_matrix(daily({2: [5]}), [2])
    rows = {tuple(r[1:]) for r in series.append_days(one, two).collect()}
    assert rows == {(1.0, None), (2.0, None), (None, 5.0)}
    with pytest.raises(ValueError):
        series.wide_matrix(daily({1: [1]}), [])


def test_stored_tables(spark, daily, tmp_path):
    frame = daily({1: [1.5, 2], 4: [3, 4]})
    path = str(tmp_path / "matrix")
    tables.write_matrix(series.narrowed(frame), path)
    stored = tables.read_matrix(spark, path)
    assert dict(stored.dtypes)["value"] == "float"
    assert cells(stored) == cells(frame)
    clipped = series.clip_to_dates(stored, "2024-01-02", "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in clipped and "LessThan(ts,2024-01-03T00:00)" in clipped
    plan = stored.where("day = DATE'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    with pytest.raises(FileNotFoundError):
        tables.read_matrix(spark, str(tmp_path / "absent"))


def test_sample_labels(spark, daily, tmp_path):
    path = str(tmp_path / "sample")
    tables.write_sample(series.wide_matrix(daily({5: [1, 1], 8: [9, 9]}), [5, 8]), path)
    got = tables.read_sample(spark, path, fixed=[7, 5])
    assert {(r.label, r.area_id, r.value) for r in got.collect()} == {("highest", 8, 9.0), ("fixed_1", 5, 1.0)}


def test_report_text(spark, tmp_path):
    path = str(tmp_path / "report")
    tables.write_report(spark.createDataFrame([("a", 1.23456, 3), ("b", float("nan"), 4), ("c", None, 5)], "k string, v double, n int"), path)
    got = {r.k: (r.v, r.n) for r in tables.read_report(spark, path, "k string, v string, n int").collect()}
    assert got == {"a": ("1.2346", 3), "b": (None, 4), "c": (None, 5)}


def test_scalars(spark):
    frame = spark.createDataFrame([("area_12", -1.0, 0), ("area", float("nan"), 1023), ("x_y", None, 1536)], "s string, v double, b long")
    got = frame.select(id_from_label(F.col("s")), is_finite(F.col("v")), clip_at_zero(F.col("v")), human_bytes(F.col("b"))).collect()
    assert [r[0] for r in got] == [12, -1, -1]
    assert [r[1] for r in got] == [True, False, False]
    assert got[0][2] == 0.0 and got[2][2] is None
    assert [r[3] for r in got] == ["0.00 B", "1023.00 B", "1.50 KB"]
