"""A stored audit that grows by batches, without reading earlier rows again.

A store is a folder of versions. Each holds the cells (``fairness.audit_cells``) of one
batch, or the same cells with the opposite sign where a batch was taken back. Cells are
sums, so the state at a version is the sum of all versions up to it, whatever their
order; sums of scores are exact decimals, so a batch taken back leaves no trace.

    store = AuditStore(spark, "/shared/audit-state")
    store.add(audit_cells(monday, roles, exact=True), batch="monday")
    store.add(audit_cells(tuesday, roles, exact=True), batch="tuesday")
    store.report()                      # as bias_report of both days
    store.remove("monday")
    store.report(version=1)             # as it was after the first batch

A version counts once its write has ended, so a failed writer leaves no half batch; of two
writers of one version the second fails. A batch that is already there is not added again,
so a job that is run again does no harm. ``compact`` writes the state as a snapshot, from
which later reads start.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parityscope.operators.fairness import report_from_cells

_SUMS = ("n", "scored", "score_sum")
_SCHEMA = (
    "attribute string, `group` string, label double, prediction double, bin int, n bigint, scored bigint, "
    "score_sum decimal(38,18), batch string"
)


def merge(cells: DataFrame) -> DataFrame:
    """Cells of equal keys summed; those that nothing is left of are gone."""
    keys = [c for c in cells.columns if c not in (*_SUMS, "batch")]
    sums = [F.sum(c).cast(cells.schema[c].dataType).alias(c) for c in _SUMS if c in cells.columns]
    merged = cells.groupBy(*keys).agg(*sums)
    return merged.filter("n <> 0").select(*[c for c in cells.columns if c != "batch"])


def negative(cells: DataFrame) -> DataFrame:
    """The cells that take others back."""
    return cells.withColumns({c: (-F.col(c)).cast(cells.schema[c].dataType) for c in _SUMS if c in cells.columns})


class AuditStore:
    """Versions of an audit's cells in a folder that the driver and all executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path.rstrip("/")
        self._schema = T.StructType.fromDDL(_SCHEMA)

    def _numbers(self, kind: str, ended: bool = True) -> list[int]:
        """Numbers of the versions or snapshots, by default of those whose write has ended."""
        root = self._spark._jvm.org.apache.hadoop.fs.Path(self._path)
        store = root.getFileSystem(self._spark._jsc.hadoopConfiguration())
        if not store.exists(root):
            return []
        found = []
        for status in store.listStatus(root):
            match = re.fullmatch(rf"{kind}=(\d+)", status.getPath().getName())
            if match and (not ended or store.exists(self._spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))):
                found.append(int(match[1]))
        return sorted(found)

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(*paths)

    def versions(self) -> list[int]:
        return self._numbers("version")

    def _deltas(self, after: int = 0, until: int | None = None) -> DataFrame:
        chosen = [v for v in self.versions() if v > after and (until is None or v <= until)]
        return self._read([f"{self._path}/version={v}" for v in chosen])

    def _of_batch(self, batch: str) -> DataFrame:
        return merge(self._deltas().filter(F.col("batch") == batch))

    def _write(self, cells: DataFrame, batch: str) -> int:
        """The cells as the next version, which is also the next of those that failed."""
        version = max(self._numbers("version", ended=False), default=0) + 1
        fields = [F.lit(batch).alias("batch") if f.name == "batch" else _field(cells, f) for f in self._schema]
        # Cells are few: one file, behind a shuffle, so that no single task counts them all.
        cells.select(*fields).repartition(1).write.parquet(f"{self._path}/version={version}")
        return version

    def add(self, cells: DataFrame, batch: str) -> int | None:
        """Add a batch's cells; the new version, or None if the batch is there already."""
        if not self._of_batch(batch).isEmpty():
            return None
        return self._write(cells, batch)

    def remove(self, batch: str) -> int | None:
        """Take a batch back, from its own cells; None if there is no such batch."""
        cells = self._of_batch(batch)
        return None if cells.isEmpty() else self._write(negative(cells), batch)

    def compact(self) -> int | None:
        """Write the state of the newest version as a snapshot. Versions stay readable."""
        versions = self.versions()
        if not versions:
            return None
        if versions[-1] not in self._numbers("snapshot"):
            cells = self.cells()
            fields = [F.lit(None).cast("string").alias("batch") if f.name == "batch" else F.col(f"`{f.name}`") for f in self._schema]
            cells.select(*fields).repartition(1).write.mode("overwrite").parquet(f"{self._path}/snapshot={versions[-1]}")
        return versions[-1]

    def cells(self, version: int | None = None) -> DataFrame:
        """The state at a version, by default the newest: the last snapshot before it, and
        what was written since."""
        snapshots = [s for s in self._numbers("snapshot") if version is None or s <= version]
        start = snapshots[-1:] or [0]
        parts = [self._deltas(start[0], version)]
        if snapshots:
            parts.append(self._read([f"{self._path}/snapshot={start[0]}"]))
        return merge(reduce(DataFrame.unionAll, parts))

    def report(self, version: int | None = None, null_group: str = "exclude") -> DataFrame:
        """The bias report of all rows of the state."""
        return report_from_cells(self.cells(version), null_group)


def _field(cells: DataFrame, field: T.StructField):
    """A column of the store from the cells, null where the roles had no score."""
    if field.name in cells.columns:
        return F.col(f"`{field.name}`").cast(field.dataType).alias(field.name)
    return F.lit(None).cast(field.dataType).alias(field.name)
