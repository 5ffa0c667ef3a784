"""Continuous audit of a stream of predictions.

The state that Spark keeps is the cells of each event-time window: rows per attribute,
group, label, prediction and score bin, with exact sums of scores. It grows with the
number of open windows and groups, not with the rows. A window is open until the watermark,
the latest event time less ``delay``, passes its end; rows that come later than that are
dropped by Spark and counted (``late_rows``), rows within the delay change their window.
Spark judges lateness by the watermark that the trigger before began with.

Every trigger writes the cells that changed, with their totals so far, as one folder of
the sink, in at most ``files`` files; each partition of the state stays a task of its own.
A trigger that is run again after a failure overwrites its own folder, so each row counts
once. The newest totals of all cells are a table of cells like any other:
``report_from_cells`` gives the report of the whole stream or of some windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from parityscope.functions.scores import score_bin, usable_score
from parityscope.operators.fairness import stacked_attributes
from parityscope.roles import AuditRoles, require_columns

_KEYS = ("window_start", "attribute", "group", "label", "prediction", "bin")
_SUMS = ("n", "scored", "score_sum")
_SCHEMA = (
    "window_start timestamp, attribute string, `group` string, label double, prediction double, bin int, "
    "n bigint, scored bigint, score_sum decimal(38,18), trigger bigint"
)


def window_cells(
    stream: DataFrame, roles: AuditRoles, time: str, width: str, delay: str, bins: int = 10, include_lowest: bool = False
) -> DataFrame:
    """Cells per event-time window of ``width``, for rows up to ``delay`` late.

    ``time`` is a timestamp; rows without one are in no window. A table that is no stream
    gives the cells of all its rows.
    """
    require_columns(stream, [c for c in roles.columns() if c != roles.id] + [time])
    score = F.lit(None).cast("double") if roles.score is None else usable_score(stream, roles.score)
    values = {
        "__time": F.col(time),
        "__label": F.col(roles.label).cast("double"),
        "__prediction": F.col(roles.prediction).cast("double"),
        "__bin": score_bin(score, bins, include_lowest),
        "__score": score.cast("decimal(38,18)"),
    }
    rows = stacked_attributes(stream, roles, values).withWatermark("__time", delay)
    keys = [F.window("__time", width).alias("window"), "attribute", "group", "__label", "__prediction", "__bin"]
    cells = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count("__score").alias("scored"), F.sum("__score").alias("score_sum"))
    return cells.select(
        F.col("window.start").alias("window_start"), "attribute", "group", F.col("__label").alias("label"),
        F.col("__prediction").alias("prediction"), F.col("__bin").alias("bin"), *_SUMS,
    )


def start_audit_stream(
    stream: DataFrame,
    roles: AuditRoles,
    time: str,
    path: str,
    checkpoint: str,
    width: str = "1 day",
    delay: str = "1 day",
    bins: int = 10,
    include_lowest: bool = False,
    files: int = 8,
    **trigger: object,
) -> StreamingQuery:
    """Start the audit; ``trigger`` as in ``DataStreamWriter.trigger`` (``availableNow=True``)."""

    def write(cells: DataFrame, number: int) -> None:
        # A shuffle: coalescing would load the state's partitions in as few tasks.
        changed = cells.withColumn("trigger", F.lit(number).cast("long")).repartition(files, *_KEYS)
        changed.write.mode("overwrite").parquet(f"{path}/trigger={number}")

    cells = window_cells(stream, roles, time, width, delay, bins, include_lowest)
    writer = cells.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def latest_cells(spark: SparkSession, path: str) -> DataFrame:
    """The newest totals of every cell that the stream has written, with ``window_start``."""
    written = spark.read.schema(_SCHEMA).option("recursiveFileLookup", True).parquet(path)
    newest = F.max(F.struct("trigger", *_SUMS)).alias("newest")
    return written.groupBy(*_KEYS).agg(newest).select(*_KEYS, *[F.col(f"newest.{c}").alias(c) for c in _SUMS])


def late_rows(query: StreamingQuery) -> int:
    """Rows so far that came after their window was closed (after partial counts: cells)."""
    return sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
