"""The state of repeated runs: failures in a row, kept by the engine over batches and restarts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StructField, StructType

FAILED, RESETTING, LIMIT = "failed", ("published", "skipped"), 2
_PROVIDER, _ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FailureStreak(StatefulProcessor):
    """For each run of a job: how many have failed in a row, and whether that stops the job. Other outcomes than failed, published and skipped change nothing."""

    def __init__(self, order: str, outcome: str, limit: int):
        self.order, self.outcome, self.limit = order, outcome, limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.failures = handle.getValueState("failures", StructType([StructField("failures", IntegerType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        failures, out = self.failures.get()[0] if self.failures.exists() else 0, []
        for outcome in held[self.outcome]:
            failures = failures + 1 if outcome == FAILED else 0 if outcome in RESETTING else failures
            out.append((failures, outcome == FAILED and failures >= self.limit))
        self.failures.update((failures,))
        streak, tripped = zip(*out, strict=True)
        yield pd.DataFrame({"job": key[0], "run": held[self.order].to_numpy(), "failures": list(streak), "tripped": list(tripped)})

    def close(self) -> None:
        pass


def failure_streaks(runs: DataFrame, job: str, order: str, outcome: str, limit: int = LIMIT) -> DataFrame:
    """job, run, failures, tripped for every run of a stream, in the order of each job's runs; a job's runs come in batches in that order.

    The number of failures is a value state of the job, so it goes on over batches and restarts. In memory is what one batch has of one job: a stream with a hot job takes smaller batches
    (maxFilesPerTrigger). The state is kept in RocksDB, which the session is set to.
    """
    runs.sparkSession.conf.set(_PROVIDER, _ROCKS)
    types = dict(runs.dtypes)
    processor = FailureStreak(order, outcome, limit)
    return runs.groupBy(job).transformWithStateInPandas(processor, f"job {types[job]}, run {types[order]}, failures int, tripped boolean", "append", "none")
