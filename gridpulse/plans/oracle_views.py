"""SQL common table expressions that mirror the views of ``views.py``."""

from __future__ import annotations

from gridpulse.plans.views import EVENT_TYPES, FIRST_WEEKS, STUDY, TEST_WEEK

_TYPES = ", ".join(f"'{t}'" for t in EVENT_TYPES)


def between(days: tuple[str, str], column: str = "ts") -> str:
    return f"{column} >= TIMESTAMP '{days[0]}' AND {column} < TIMESTAMP '{days[1]}' + INTERVAL 1 DAY"


BY_TYPE = f"SELECT CAST(list_position([{_TYPES}], event_type) AS INT) AS area_id, date_trunc('hour', ts) AS ts, value FROM events"
BY_USER = "SELECT CAST(user_id + 1 AS INT) AS area_id, date_trunc('hour', ts) AS ts, value FROM events"
BY_SUPPLIER = "SELECT CAST(l_suppkey + 1 AS INT) AS area_id, l_shipdate AS ts, l_extendedprice AS value FROM lineitem"
PART_TOTALS = "SELECT CAST(l_partkey + 1 AS INT) AS area_id, sum(l_quantity) AS total_traffic FROM lineitem GROUP BY 1"
IN_STUDY = between(STUDY)
IN_FIRST_WEEKS = between(FIRST_WEEKS)
IN_TEST = between(TEST_WEEK)
BEFORE_TEST = f"ts < TIMESTAMP '{TEST_WEEK[0]}'"


def dense(records: str, condition: str = "true") -> str:
    """CTEs ``recs``, ``cells`` and ``dense``; starts with WITH and ends without a comma."""
    return f"""WITH recs AS ({records}),
cells AS (SELECT area_id, ts, sum(coalesce(value, 0)) AS value FROM recs GROUP BY area_id, ts),
dense AS (
  SELECT a.area_id, x.ts, coalesce(c.value, 0) AS value
  FROM (SELECT DISTINCT area_id FROM recs) a
  CROSS JOIN (SELECT DISTINCT ts FROM recs WHERE {condition}) x
  LEFT JOIN cells c ON c.area_id = a.area_id AND c.ts = x.ts
)"""


TYPE_DENSE = dense(BY_TYPE, IN_STUDY)
USER_DENSE = dense(BY_USER, IN_STUDY)
USER_DENSE_ALL = dense(BY_USER)
SUPPLIER_DENSE = dense(BY_SUPPLIER)
