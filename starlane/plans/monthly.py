"""Sums of earlier files, kept, so that a new month costs only its own rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.plans.graph import fingerprint
from starlane.sources.sinks import write_stage
from starlane.sources.versions import names_below


class MonthlySums:
    """Rows of :func:`starlane.operators.profile.presum`, a batch for each delivery of files.

    A batch is known by its label, say the path of the delivered files. Giving one again
    replaces it, so a rerun or a corrected delivery counts once.
    """

    def __init__(self, spark: SparkSession, folder: str, by: Sequence[str]):
        self.spark, self.folder, self.by = spark, folder.rstrip("/"), list(by)

    def add(self, label: str, summed: DataFrame) -> None:
        write_stage(summed, f"{self.folder}/batch-{fingerprint(label)}", mode="overwrite", compact=True)

    def batches(self) -> list[str]:
        return [f"{self.folder}/{n}" for n in names_below(self.spark, self.folder) if n.startswith("batch-")]

    def total(self) -> DataFrame:
        """All batches added up, one row per key."""
        rows = self.spark.read.parquet(*self.batches())
        return rows.groupBy(*self.by).agg(*[F.sum(f"`{c}`").alias(c) for c in rows.columns if c not in self.by])
