"""Answers of an outside lookup, kept across days with a log of failures.

``<path>/answers`` holds the newest answer a key, ``<path>/failures`` the day a key last failed; both are stores of
``keyed_store``. A batch of lookups is folded in as one numbered run, so work that stops between batches goes on where it
was, and a batch that is repeated overwrites itself. Answers appear before failures do: a run that stops between the
two leaves its failed keys pending, never an answer lost.

A key is pending while it has no answer and has not failed within the last days. A key that fails keeps an earlier answer.
Null keys are never pending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import cooled_down, pending_keys
from . import keyed_store

ANSWERED, FAILED = "answered_on", "failed_on"


class LookupCache:
    """The cache below ``path``; ``key`` names the column of looked-up names."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def _read(self, part: str, version: str) -> DataFrame | None:
        store = f"{self.path}/{part}"
        return keyed_store.read(self.spark, store, [self.key], [version]) if keyed_store.runs(self.spark, store) else None

    def answers(self) -> DataFrame | None:
        """Newest answer of each key with its day; None before the first run."""
        return self._read("answers", ANSWERED)

    def failures(self) -> DataFrame | None:
        """Rows (key, failed_on): the last failure of each key; None before the first run."""
        return self._read("failures", FAILED)

    def pending(self, wanted: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
        """Distinct wanted keys to look up on day ``as_of``."""
        todo = wanted.select(self.key).filter(F.col(self.key).isNotNull()).distinct()
        answers, failures = self.answers(), self.failures()
        if answers is not None:
            todo = pending_keys(todo, answers, self.key)
        return todo if failures is None else cooled_down(todo, failures, self.key, as_of, FAILED, days)

    def record(self, number: int, tried: DataFrame, answers: DataFrame, as_of: Column) -> None:
        """Fold a batch in as run ``number``: its answers, and as failures the tried keys without one."""
        found = answers.filter(F.col(self.key).isNotNull()).withColumn(ANSWERED, as_of)
        keyed_store.fold(found, f"{self.path}/answers", number, [self.key], [ANSWERED])
        failed = pending_keys(tried, answers, self.key).filter(F.col(self.key).isNotNull()).withColumn(FAILED, as_of)
        keyed_store.fold(failed, f"{self.path}/failures", number, [self.key], [FAILED])
