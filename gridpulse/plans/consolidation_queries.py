"""Queries on scans, sinks, consolidation, selection and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridpulse.functions.scalars import area_label, human_bytes, id_from_label, is_finite, rounded
from gridpulse.operators import areas, distribution, series
from gridpulse.plans import views
from gridpulse.plans.consolidate import build_matrix, stage_raw
from gridpulse.plans.oracle_views import (
    BY_TYPE, BY_USER, IN_FIRST_WEEKS, IN_STUDY, IN_TEST, PART_TOTALS, SUPPLIER_DENSE, TYPE_DENSE, USER_DENSE,
    USER_DENSE_ALL,
)
from gridpulse.plans.registry import query
from gridpulse.session import scratch_path
from gridpulse.sources import raw, tables
from gridpulse.streaming.ingest import compact, ingest_new_files, read_ingested

FIXED = (3, 99_999_999)  # the second id is never present, so a substitute is drawn
SAMPLE_AREAS = (3, 20, 61)


def _shown(series_table: DataFrame, *columns: str) -> DataFrame:
    return series_table.select(*(columns or ("area_id", "ts")), rounded(F.col("value")).alias("value"))


def user_series(spark: SparkSession, sf: str) -> DataFrame:
    return series.dense_series(views.by_user(spark, sf), views.STUDY)


def type_series(spark: SparkSession, sf: str) -> DataFrame:
    return series.dense_series(views.by_type(spark, sf), views.STUDY)


def supplier_series(spark: SparkSession, sf: str) -> DataFrame:
    return series.dense_series(views.by_supplier(spark, sf))


# --- raw files ---------------------------------------------------------------------------------

_UTC_DAY = "CAST(date_trunc('hour', ts) - INTERVAL 1 HOUR AS DATE)"


@query(f"SELECT DISTINCT CAST({_UTC_DAY} AS VARCHAR) AS day, true AS has_bytes FROM events")
def raw_discover(spark: SparkSession, sf: str) -> DataFrame:
    files = raw.discover(spark, views.raw_folder(spark, sf))
    return files.groupBy(F.regexp_extract("path", "day=([0-9-]+)", 1).alias("day")).agg(
        (F.sum("length") > 0).alias("has_bytes")
    )


@query(f"""
WITH days AS (SELECT DISTINCT {_UTC_DAY} AS day FROM events ORDER BY day LIMIT 7)
SELECT CAST(user_id + 1 AS INT) AS area_id, date_trunc('hour', ts) AS ts, round(sum(value), 6) AS value
FROM events WHERE {_UTC_DAY} IN (SELECT day FROM days) GROUP BY 1, 2
""")
def raw_first_days(spark: SparkSession, sf: str) -> DataFrame:
    """The trial-run feature: only the first seven daily deliveries."""
    files = raw.discover(spark, views.raw_folder(spark, sf))
    first = raw.first_sources(files, 7, "folder")
    return _shown(series.rollup(raw.activity(raw.scan(spark, *first), 1, "folder")))


@query(f"""
SELECT CAST(sum(length(concat_ws(chr(9), user_id + 1, epoch_ms(date_trunc('hour', ts) - INTERVAL 1 HOUR),
  list_position([{", ".join(f"'{t}'" for t in views.EVENT_TYPES)}], event_type), '', '', '', '', value)) + 1) AS BIGINT) AS bytes
FROM events
""")
def raw_bytes(spark: SparkSession, sf: str) -> DataFrame:
    return raw.total_bytes(raw.discover(spark, views.raw_folder(spark, sf))).select("bytes")


@query(f"""
SELECT CAST(user_id + 1 AS INT) AS square_id, epoch_ms(date_trunc('hour', ts) - INTERVAL 1 HOUR) AS time_ms,
  CAST(list_position([{", ".join(f"'{t}'" for t in views.EVENT_TYPES)}], event_type) AS INT) AS country_code,
  CAST(NULL AS DOUBLE) AS sms_in, CAST(NULL AS DOUBLE) AS sms_out, CAST(NULL AS DOUBLE) AS call_in,
  CAST(NULL AS DOUBLE) AS call_out, value AS internet
FROM events
""")
def raw_scan_all_columns(spark: SparkSession, sf: str) -> DataFrame:
    return raw.scan(spark, views.raw_folder(spark, sf))


@query(BY_USER)
def raw_scan_pruned(spark: SparkSession, sf: str) -> DataFrame:
    records = raw.activity(raw.scan(spark, views.raw_folder(spark, sf)))
    return records.select("area_id", "ts", "value")


@query("""
WITH c AS (SELECT count(*) AS naive, count(DISTINCT (user_id, date_trunc('hour', ts))) AS optimised FROM events),
s AS (SELECT 'naive' AS variant, naive AS "rows", 8 AS "columns", naive * 64 + 132 AS b, naive * 64 + 132 AS nb FROM c
UNION ALL SELECT 'optimised', optimised, 3, optimised * 14 + 132, naive * 64 + 132 FROM c)
SELECT variant, "rows", CAST("columns" AS INT) AS "columns", CAST(b AS BIGINT) AS memory_bytes,
  CASE WHEN b < 1024 THEN printf('%.2f B', b::DOUBLE) WHEN b < 1048576 THEN printf('%.2f KB', b / 1024.0::DOUBLE)
       WHEN b < 1073741824 THEN printf('%.2f MB', b / 1048576.0::DOUBLE) ELSE printf('%.2f GB', b / 1073741824.0::DOUBLE) END AS memory_human,
  round(b * 100.0::DOUBLE / nb, 6) AS pct_of_naive, round(100.0 - b * 100.0::DOUBLE / nb, 6) AS reduction_pct
FROM s
""")
def volume_report(spark: SparkSession, sf: str) -> DataFrame:
    records = raw.activity(raw.scan(spark, views.raw_folder(spark, sf)))
    report = raw.volume_report(records)
    return report.select(
        "variant", "rows", "columns", F.col("memory_bytes").cast("long").alias("memory_bytes"), "memory_human",
        rounded(F.col("pct_of_naive").cast("double")).alias("pct_of_naive"),
        rounded(F.col("reduction_pct").cast("double")).alias("reduction_pct"),
    )


@query(f"{USER_DENSE} SELECT area_id, ts, round(value, 6) AS value FROM dense")
def consolidated_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Raw text to dense matrix: staged once, then filled per area."""
    staged = stage_raw(spark, [views.raw_folder(spark, sf)], scratch_path(spark, "staged"), 1, "folder")
    return _shown(build_matrix(staged, views.STUDY))


@query(f"SELECT area_id, ts, round(sum(value), 6) AS value FROM ({BY_USER}) GROUP BY area_id, ts")
def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    store = scratch_path(spark, "ingested")
    ingest_new_files(spark, views.raw_folder(spark, sf), store, scratch_path(spark, "ingest-checkpoint"), 1, "folder")
    return _shown(read_ingested(spark, store))


@query(f"SELECT area_id, ts, round(sum(value), 6) AS value FROM ({BY_USER}) GROUP BY area_id, ts")
def ingest_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """The same through many small batches, merged and read from the merged table."""
    folder, store, checkpoint = views.raw_folder(spark, sf), scratch_path(spark, "ingested"), scratch_path(spark, "ingest-checkpoint")
    parts = max(1, raw.discover(spark, folder).count() // 5)
    ingest_new_files(spark, folder, store, checkpoint, 1, "folder", files_per_batch=parts)
    compact(spark, store, checkpoint)
    return _shown(read_ingested(spark, store))


# --- sinks and stored tables -------------------------------------------------------------------

@query(f"{USER_DENSE} SELECT area_id, ts, round(CAST(CAST(round(value, 2) AS FLOAT) AS DOUBLE), 3) AS value FROM dense")
def matrix_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "matrix")
    exact = user_series(spark, sf).withColumn("value", F.round("value", 2))
    tables.write_matrix(series.narrowed(exact), path)
    stored = tables.read_matrix(spark, path)
    return stored.select("area_id", "ts", rounded(F.col("value").cast("double"), 3).alias("value"))


@query(f"""{USER_DENSE} SELECT area_id, round(sum(value), 4) AS value FROM dense
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13' GROUP BY area_id""")
def matrix_pruned_days(spark: SparkSession, sf: str) -> DataFrame:
    """A date predicate on the stored matrix only opens the folders of those days."""
    path = scratch_path(spark, "matrix")
    tables.write_matrix(user_series(spark, sf), path)
    days = tables.read_matrix(spark, path).where("day BETWEEN DATE'2024-01-10' AND DATE'2024-01-12'")
    return days.groupBy("area_id").agg(rounded(F.sum("value"), 4).alias("value"))


@query(f"{USER_DENSE} SELECT area_id, round(sum(value), 4) AS total_traffic FROM dense GROUP BY area_id")
def totals_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "totals")
    tables.write_totals(areas.totals(user_series(spark, sf)), path)
    return tables.read_stored(spark, path).select("area_id", rounded(F.col("total_traffic"), 4).alias("total_traffic"))


_TARGETS = """
ranked AS (SELECT area_id, row_number() OVER (ORDER BY total DESC, area_id) - 1 AS place, count(*) OVER () AS n
           FROM (SELECT area_id, round(sum(value), 6) AS total FROM dense GROUP BY area_id)),
highest AS (SELECT area_id FROM ranked WHERE place = 0),
targets AS (
  SELECT 'highest' AS label, area_id FROM highest
  UNION ALL SELECT 'fixed_1', 3
  UNION ALL SELECT 'fixed_2', (SELECT area_id FROM ranked WHERE (place = n // 3 OR place = 2 * n // 3)
    AND area_id <> 3 AND area_id NOT IN (SELECT area_id FROM highest) ORDER BY place LIMIT 1)
)"""


def target_ids(spark: SparkSession, sf: str) -> DataFrame:
    totals = areas.totals_of_records(views.by_user(spark, sf), views.STUDY).withColumn("total_traffic", F.round("total_traffic", 6))
    return areas.target_areas(totals, FIXED)


@query(f"{USER_DENSE}, {_TARGETS} SELECT label, CAST(area_id AS INT) AS area_id FROM targets")
def target_areas(spark: SparkSession, sf: str) -> DataFrame:
    return target_ids(spark, sf)


@query(f"{USER_DENSE}, {_TARGETS} SELECT label, CAST(area_id AS INT) AS area_id FROM targets")
def targets_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "targets")
    tables.write_targets(target_ids(spark, sf), path)
    return tables.read_targets(spark, path)


@query(f"""{USER_DENSE}, sample AS (SELECT * FROM dense WHERE area_id IN {SAMPLE_AREAS}),
top AS (SELECT area_id FROM sample GROUP BY area_id ORDER BY round(sum(value), 6) DESC, area_id LIMIT 1),
labels AS (SELECT 'highest' AS label, area_id FROM top UNION ALL SELECT 'fixed_1', 3)
SELECT label, sample.area_id, ts, round(value, 2) AS value FROM sample JOIN labels ON labels.area_id = sample.area_id
""")
def sample_series(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "sample")
    tables.write_sample(series.wide_matrix(user_series(spark, sf), SAMPLE_AREAS), path)
    return tables.read_sample(spark, path, FIXED).select("label", "area_id", "ts", rounded(F.col("value"), 2).alias("value"))


@query(f"""WITH t AS ({PART_TOTALS}), c AS (SELECT avg(total_traffic) AS m FROM t),
s AS (SELECT count(*)::DOUBLE AS n_areas, avg(total_traffic) AS mean, quantile_cont(total_traffic, 0.5) AS median,
  stddev_pop(total_traffic) AS std, min(total_traffic) AS min, max(total_traffic) AS max,
  avg(pow(total_traffic - m, 3)) / pow(avg(pow(total_traffic - m, 2)), 1.5) AS skewness,
  avg(pow(total_traffic - m, 4)) / pow(avg(pow(total_traffic - m, 2)), 2) - 3 AS kurtosis,
  quantile_cont(total_traffic, 0.95) / greatest(quantile_cont(total_traffic, 0.5), 1e-9) AS ratio FROM t, c)
SELECT unnest(['n_areas', 'mean', 'median', 'std', 'min', 'max', 'skewness', 'kurtosis', 'p95 / median ratio']) AS metric,
  unnest([printf('%.4f', v) FOR v IN [n_areas, mean, median, std, min, max, skewness, kurtosis, ratio]]) AS value FROM s""")
def report_csv(spark: SparkSession, sf: str) -> DataFrame:
    """All rows of the summary as written to the result table."""
    path = scratch_path(spark, "report")
    tables.write_report(distribution.summary(views.part_totals(spark, sf)), path)
    return tables.read_report(spark, path, "metric string, value string")


# --- projections and filters -------------------------------------------------------------------

@query(f"""SELECT area_id, ts, round(sum(CASE WHEN value > 400 THEN 0 ELSE value END), 6) AS value
FROM ({BY_USER}) GROUP BY area_id, ts""")
def missing_as_zero(spark: SparkSession, sf: str) -> DataFrame:
    """Values above a plausible limit are blanked first, so that there is something missing."""
    records = views.by_user(spark, sf).withColumn("value", F.when(F.col("value") <= 400, F.col("value")))
    return _shown(series.rollup(records))


@query(f"SELECT area_id, ts, value FROM ({BY_USER}) WHERE {IN_STUDY}")
def study_window(spark: SparkSession, sf: str) -> DataFrame:
    return views.by_user(spark, sf, views.STUDY)


@query(f"""{USER_DENSE}, {_TARGETS} SELECT label, CAST(t.area_id AS INT) AS area_id, ts, round(value, 6) AS value
FROM targets t JOIN dense d ON d.area_id = t.area_id WHERE {IN_FIRST_WEEKS}""")
def first_two_weeks(spark: SparkSession, sf: str) -> DataFrame:
    rows = series.of_targets(user_series(spark, sf), target_ids(spark, sf), *views.FIRST_WEEKS)
    return _shown(rows, "label", "area_id", "ts")


@query(f"{TYPE_DENSE} SELECT area_id, ts, {IN_TEST} AS is_test FROM dense")
def test_week_flag(spark: SparkSession, sf: str) -> DataFrame:
    from gridpulse.operators.preparation import Split

    split = Split(*views.TEST_WEEK)
    return type_series(spark, sf).select("area_id", "ts", split.is_test(F.col("ts")).alias("is_test"))


@query(f"{USER_DENSE} SELECT area_id, 'area_' || area_id AS series, ts, round(value, 6) AS value FROM dense WHERE area_id = 3")
def one_area_series(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(series.one_area(user_series(spark, sf), 3), "area_id", "series", "ts")


@query(f"""{USER_DENSE_ALL}, r AS (SELECT area_id, CASE WHEN sum(value) = 0 THEN NULL
  ELSE sum(CASE WHEN hour(ts) < 12 THEN value ELSE 0 END) / nullif(sum(value), 0) END AS share FROM dense GROUP BY area_id)
SELECT area_id, round(share, 6) AS share FROM r WHERE share IS NOT NULL AND share > 0""")
def finite_and_positive(spark: SparkSession, sf: str) -> DataFrame:
    """Share of the morning per area, without undefined and without zero shares."""
    dense = series.dense_series(views.by_user(spark, sf))
    morning = F.sum(F.when(F.hour("ts") < 12, F.col("value")).otherwise(0.0))
    shares = dense.groupBy("area_id").agg(F.try_divide(morning, F.sum("value")).alias("share"))
    return shares.where(is_finite(F.col("share")) & (F.col("share") > 0)).select(
        "area_id", rounded(F.col("share")).alias("share")
    )


@query(f"""SELECT area_id, ts, value FROM ({BY_TYPE}) WHERE value <= 400""")
def missing_dropped(spark: SparkSession, sf: str) -> DataFrame:
    records = views.by_type(spark, sf).withColumn("value", F.when(F.col("value") <= 400, F.col("value")))
    return records.dropna(subset=["value"])


@query("""SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, 'area_' || o_custkey AS series, CAST(o_custkey AS INT) AS area_id,
  CAST(-1 AS INT) AS unnamed_id FROM orders""")
def ids_from_labels(spark: SparkSession, sf: str) -> DataFrame:
    labelled = views.table(spark, sf, "orders").select("o_orderkey", area_label(F.col("o_custkey")).alias("series"))
    return labelled.select(
        "o_orderkey", "series", id_from_label(F.col("series")).alias("area_id"),
        id_from_label(F.regexp_replace("series", "_", "-")).alias("unnamed_id"),
    )


@query("""WITH c AS (SELECT o_orderkey, round(o_totalprice * 100) AS b FROM orders)
SELECT o_orderkey, CASE WHEN b < 1024 THEN printf('%.2f B', b) WHEN b < 1048576 THEN printf('%.2f KB', b / 1024)
 WHEN b < 1073741824 THEN printf('%.2f MB', b / 1048576) ELSE printf('%.2f GB', b / 1073741824) END AS size FROM c""")
def readable_sizes(spark: SparkSession, sf: str) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return views.table(spark, sf, "orders").select("o_orderkey", human_bytes(cents).alias("size"))


# --- roll-up, densify, set operations ----------------------------------------------------------

@query(f"SELECT area_id, ts, round(sum(value), 6) AS value FROM ({BY_USER}) GROUP BY area_id, ts")
def country_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(series.rollup(views.by_user(spark, sf)))


@query(f"{USER_DENSE} SELECT area_id, ts, round(value, 6) AS value FROM dense")
def dense_by_user(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(user_series(spark, sf))


@query(f"{SUPPLIER_DENSE} SELECT area_id, ts, round(value, 6) AS value FROM dense")
def dense_by_supplier(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(supplier_series(spark, sf))


_SOURCED = f"""SELECT *, CASE WHEN area_id % 2 = 0 THEN 'a' ELSE 'b' END AS source FROM ({BY_USER})"""
_OWNERS = f"WITH s AS ({_SOURCED}), o AS (SELECT ts, min(source) AS owner FROM s GROUP BY ts)"


def _sourced(spark: SparkSession, sf: str) -> DataFrame:
    """Even and odd areas arrive in two files whose timestamps overlap."""
    return views.by_user(spark, sf).withColumn("source", F.when(F.col("area_id") % 2 == 0, "a").otherwise("b"))


@query(f"{_OWNERS} SELECT s.area_id, s.ts, round(sum(s.value), 6) AS value FROM s JOIN o ON s.ts = o.ts AND s.source = o.owner GROUP BY 1, 2")
def first_file_wins(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(series.rollup(series.keep_first_file(_sourced(spark, sf), "source")))


@query(f"""{_OWNERS}, d AS (
  SELECT a.area_id, x.ts, coalesce(sum(CASE WHEN s.source = o.owner THEN s.value END), 0) AS value
  FROM (SELECT DISTINCT area_id FROM s) a CROSS JOIN (SELECT DISTINCT ts FROM s WHERE {IN_STUDY}) x
  JOIN o ON o.ts = x.ts LEFT JOIN s ON s.area_id = a.area_id AND s.ts = x.ts GROUP BY a.area_id, x.ts)
SELECT area_id, ts, round(value, 6) AS value FROM d""")
def dense_first_file(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(series.dense_series(_sourced(spark, sf), views.STUDY, "source", "first"))


@query(f"{USER_DENSE} SELECT area_id, ts, round(value, 6) AS value FROM dense")
def dense_sum_of_files(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(series.dense_series(_sourced(spark, sf), views.STUDY, "source", "sum"))


@query(f"""SELECT ts, {", ".join(f"round(sum(value) FILTER (area_id = {a}), 6) AS area_{a}" for a in SAMPLE_AREAS)}
FROM ({BY_USER}) WHERE area_id IN {SAMPLE_AREAS} GROUP BY ts""")
def wide_pivot(spark: SparkSession, sf: str) -> DataFrame:
    wide = series.wide_matrix(views.by_user(spark, sf), SAMPLE_AREAS)
    return wide.select("ts", *[rounded(F.col(f"area_{a}")).alias(f"area_{a}") for a in SAMPLE_AREAS])


@query(f"""SELECT ts, {", ".join(f"round(sum(value) FILTER (area_id = {a}), 6) AS area_{a}" for a in SAMPLE_AREAS)}
FROM ({BY_USER}) WHERE area_id IN {SAMPLE_AREAS} GROUP BY ts, CASE WHEN area_id = {SAMPLE_AREAS[-1]} THEN 1 ELSE 0 END""")
def append_days(spark: SparkSession, sf: str) -> DataFrame:
    """Two wide frames with different columns, stacked."""
    records = views.by_user(spark, sf)
    wide = series.append_days(series.wide_matrix(records, SAMPLE_AREAS[:2]), series.wide_matrix(records, SAMPLE_AREAS[2:]))
    return wide.select("ts", *[rounded(F.col(f"area_{a}")).alias(f"area_{a}") for a in SAMPLE_AREAS])


@query(f"""{TYPE_DENSE}, u AS ({USER_DENSE} SELECT area_id, sum(value) AS total FROM dense GROUP BY area_id)
SELECT 'type' AS kind, area_id, round(sum(value), 4) AS total_traffic FROM dense GROUP BY area_id
UNION ALL SELECT 'user', area_id, round(total, 4) FROM u""")
def append_results(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        areas.totals(frame).select(F.lit(kind).alias("kind"), "area_id", rounded(F.col("total_traffic"), 4).alias("total_traffic"))
        for kind, frame in (("type", type_series(spark, sf)), ("user", user_series(spark, sf)))
    ]
    return reduce(DataFrame.unionByName, parts)


@query(f"{TYPE_DENSE} SELECT area_id, ts, round(value, 6) AS value FROM dense ORDER BY area_id, ts")
def chronological(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(series.in_time_order(type_series(spark, sf)))


@query(f"{USER_DENSE} SELECT count(DISTINCT ts) AS steps, count(DISTINCT area_id) AS areas FROM dense")
def matrix_shape(spark: SparkSession, sf: str) -> DataFrame:
    return series.shape(user_series(spark, sf))


# --- totals, ranking, selection ----------------------------------------------------------------

@query(f"{USER_DENSE} SELECT area_id, round(sum(value), 4) AS total_traffic FROM dense GROUP BY area_id")
def area_totals(spark: SparkSession, sf: str) -> DataFrame:
    return areas.totals(user_series(spark, sf)).select("area_id", rounded(F.col("total_traffic"), 4).alias("total_traffic"))


@query(f"""{USER_DENSE_ALL} SELECT area_id, round(sum(value), 4) AS total_traffic FROM dense GROUP BY area_id
ORDER BY total_traffic DESC, area_id""")
def totals_busiest_first(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: total per area on the dense grid, busiest first. The grid itself need not be built for it."""
    totals = areas.by_total(areas.totals_of_records(views.by_user(spark, sf)))
    return totals.select("area_id", rounded(F.col("total_traffic"), 4).alias("total_traffic"))


@query(f"""WITH t AS ({PART_TOTALS}) SELECT area_id, total_traffic,
row_number() OVER (ORDER BY total_traffic DESC, area_id) - 1 AS rank, count(*) OVER () AS n FROM t""")
def ranked_totals(spark: SparkSession, sf: str) -> DataFrame:
    return areas.ranked_by_total(views.part_totals(spark, sf))


@query(f"WITH t AS ({PART_TOTALS}) SELECT area_id, total_traffic FROM t ORDER BY total_traffic DESC, area_id LIMIT 1")
def busiest_area(spark: SparkSession, sf: str) -> DataFrame:
    return areas.busiest(views.part_totals(spark, sf))


@query(f"""WITH r AS (SELECT area_id, row_number() OVER (ORDER BY total_traffic DESC, area_id) - 1 AS place,
  count(*) OVER () AS n FROM ({PART_TOTALS}))
SELECT CASE WHEN place = n // 3 THEN 0 ELSE 1 END AS pick, area_id FROM r WHERE place = n // 3 OR place = 2 * n // 3""")
def substitute_areas(spark: SparkSession, sf: str) -> DataFrame:
    return areas.substitutes(views.part_totals(spark, sf))


@query(f"""WITH t AS ({PART_TOTALS}), w AS (SELECT CAST(p_partkey * 2 AS INT) AS area_id FROM part)
SELECT area_id, area_id IN (SELECT area_id FROM t) AS found FROM w""")
def fixed_areas_found(spark: SparkSession, sf: str) -> DataFrame:
    """Wanted ids that exist (semi join) and that do not (anti join)."""
    totals = views.part_totals(spark, sf)
    wanted = views.table(spark, sf, "part").select((F.col("p_partkey") * 2).cast("int").alias("area_id"))
    return areas.present(totals, wanted).withColumn("found", F.lit(True)).unionByName(
        areas.absent(totals, wanted).withColumn("found", F.lit(False))
    )
