"""Step log of a run: row counts, messages and durations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree.operators.windows import running

SCHEMA = "step_number int, step_name string, status string, row_count bigint, message string, execution_time timestamp"


class RunLog:
    """Collects steps on the driver, a handful per run, and hands them out as a frame."""

    def __init__(self) -> None:
        self._rows: list[tuple] = []

    def add(self, name: str, rows: int | None = None, message: str = "", status: str = "COMPLETE") -> None:
        """Log a step; steps are numbered in the order they are added, so no number repeats."""
        self._rows.append((len(self._rows), name, status, rows, message, datetime.now(timezone.utc)))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self._rows, SCHEMA)


def step_durations(
    log: DataFrame, order: Sequence[str] = ("step_number",), time: str = "execution_time", run: Sequence[str] = ()
) -> DataFrame:
    """Seconds since the previous step of the same run; null for the first."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    timed = log.withColumns({"_us": micros, "_all": F.lit(1)})
    # ``running`` splits a run that holds most of the log.
    placed = running(timed, [*run] or ["_all"], order, "_us", "_at")
    return placed.select(*log.columns, ((F.col("_us") - F.col("previous")) / F.lit(1e6)).alias("step_seconds"))
