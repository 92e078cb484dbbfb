import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) >= 80


@pytest.mark.parametrize("name", [
    "dense_by_user", "target_areas", "anomalies_by_type", "rolling_statistics", "forecasting_data_outside", "arima_100_fitted",
])
def test_query_agrees_with_sql(spark, name):
    from check_oracles import TABLES, difference

    duck = duckdb.connect()
    for table in TABLES.split():
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = contract.queries()[name](spark, SF).toPandas()
    assert difference(got, duck.sql(contract.oracle_sql()[name]).df()) is None


def test_entry_without_the_optional_part():
    """The contract still imports, with all other queries, where the text operators are not installed."""
    import subprocess
    import sys
    from pathlib import Path

    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "gridpulse.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as contract
names = set(contract.queries())
assert len(names) >= 80 and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert set(contract.oracle_sql()) <= names
"""
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
