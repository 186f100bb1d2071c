"""What the steps of a run did, measured while they write: rows attempted and processed, time, throughput.

Counts come from observations on the very writes, so no row is read again to be counted. A step is attempted with the rows that
enter it and processed with those that are written; where nothing is said of the former, both are the same. Both can be told apart by
a kind, as edges are by their type.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "operation string, kind string, total_items long, processed_items long, failed_items long, success_rate double, duration_seconds double, throughput_per_second double"


@dataclass
class Step:
    operation: str
    kind: str | None
    total: int
    processed: int
    seconds: float

    def row(self) -> tuple:
        rate = self.processed / self.total * 100 if self.total else 0.0
        speed = self.processed / self.seconds if self.seconds else 0.0
        return self.operation, self.kind, self.total, self.processed, self.total - self.processed, rate, self.seconds, speed


class RunMetrics:
    """The steps of one run. A step's time is that of its write; its kinds share it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.steps: list[Step] = []
        self._attempts: dict[str, tuple[Observation, str | None, Sequence]] = {}

    @staticmethod
    def _counted(df: DataFrame, by: str | None, kinds: Sequence) -> tuple[DataFrame, Observation]:
        seen = Observation()
        counts = [F.count_if(F.col(by) == k).alias(f"k{i}") for i, k in enumerate(kinds)] if by else [F.count(F.lit(1)).alias("k0")]
        return df.observe(seen, *counts), seen

    def attempted(self, operation: str, df: DataFrame, by: str | None = None, kinds: Sequence = ()) -> DataFrame:
        """The rows that enter a step, counted as they pass; the step's write must come of them."""
        out, seen = self._counted(df, by, kinds)
        self._attempts[operation] = seen, by, kinds
        return out

    def measured(self, operation: str, df: DataFrame, write: Callable[[DataFrame], None], by: str | None = None, kinds: Sequence = ()) -> None:
        """Writes a step's rows and records what it did."""
        entered, by, kinds = self._attempts.pop(operation, (None, by, kinds))
        out, seen = self._counted(df, by, kinds)
        began = time.perf_counter()
        write(out)
        seconds = time.perf_counter() - began
        # A plan that is found to be empty beforehand observes nothing.
        processed = seen.get
        total = entered.get if entered is not None else processed
        for i, kind in enumerate(kinds if by else (None,)):
            self.steps.append(Step(operation, kind, total.get(f"k{i}", 0), processed.get(f"k{i}", 0), seconds))

    def frame(self) -> DataFrame:
        """A row per step and kind."""
        return self.spark.createDataFrame([s.row() for s in self.steps], SCHEMA)

    def summary(self) -> DataFrame:
        """One row over all steps: a step's time counts once, whatever its kinds."""
        rows = self.frame()
        seconds = rows.groupBy("operation").agg(F.max("duration_seconds").alias("s")).agg(F.coalesce(F.sum("s"), F.lit(0.0)).alias("total_duration_seconds"))
        sums = rows.agg(
            F.count_distinct("operation").alias("operations_count"), F.coalesce(F.sum("total_items"), F.lit(0)).alias("total_items"), F.coalesce(F.sum("processed_items"), F.lit(0)).alias("total_processed")
        )
        share = F.when(F.col("total_items") > 0, F.col("total_processed") / F.col("total_items") * 100).otherwise(0.0)
        speed = F.when(F.col("total_duration_seconds") > 0, F.col("total_processed") / F.col("total_duration_seconds")).otherwise(0.0)
        return sums.crossJoin(seconds).withColumns({"overall_success_rate": share, "average_throughput": speed})

    def save(self, path: str) -> None:
        """Both as JSON."""
        self.frame().write.mode("overwrite").json(f"{path}/operations")
        self.summary().write.mode("overwrite").json(f"{path}/summary")
