"""Raw daily files to the stored dense matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridpulse.operators.series import dense_series, narrowed, rollup
from gridpulse.sources import raw
from gridpulse.sources.tables import read_stored, write_matrix


def stage_raw(spark: SparkSession, paths: list[str], store: str, offset_hours: int = 1, by: str = "file") -> DataFrame:
    """Parse the text once: partial sums per area, interval and delivery as Parquet."""
    root = paths[0] if len(paths) == 1 else ""
    records = raw.activity(raw.scan(spark, *paths), offset_hours, by, root)
    rollup(records, "area_id", "ts", "source").write.mode("overwrite").parquet(store)
    return read_stored(spark, store)


def build_matrix(staged: DataFrame, study: tuple[str, str] | None, duplicates: str = "first",
                 save_to: str | None = None) -> DataFrame:
    """The dense matrix of staged partial sums, optionally stored with narrowed types."""
    matrix = dense_series(staged, study, "source", duplicates)
    if save_to:
        write_matrix(narrowed(matrix), save_to)
    return matrix
