"""Rows that a stream drops behind the watermark, published per micro-batch.

The engine reports the drops with each micro-batch's progress.  A listener (for running
jobs) or ``flush`` (for queries that have ended) writes one small file a batch below the
ledger; a batch that is reported again keeps its first file, so counting is idempotent.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..storage import children, publish

LATE_ROWS = "batch_id long, n long, rows long"


def dropped(progress: dict) -> int:
    return sum(op.get("numRowsDroppedByWatermark", 0) for op in progress.get("stateOperators", []))


class LateRows:
    """Late rows by micro-batch below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def record(self, progress: dict) -> None:
        """Publish what one progress report says of its batch (a report without input says nothing)."""
        if not progress.get("numInputRows"):
            return
        batch_id = int(progress["batchId"])
        name = f"batch-{batch_id:020d}.json"
        if name in children(self.spark, self.folder):
            return
        row = {"batch_id": batch_id, "n": dropped(progress), "rows": int(progress["numInputRows"])}
        try:
            publish(self.spark, f"{self.folder}/{name}", json.dumps(row) + "\n")
        except FileExistsError:
            pass  # reported twice at once

    def flush(self, query: StreamingQuery) -> None:
        """Publish all progress that a query still holds."""
        for progress in query.recentProgress:
            self.record(progress if isinstance(progress, dict) else json.loads(progress.json))

    def read(self) -> DataFrame:
        """batch_id, n (rows dropped as late), rows (rows the batch read)."""
        if not children(self.spark, self.folder):
            return self.spark.createDataFrame([], LATE_ROWS)
        return self.spark.read.schema(LATE_ROWS).json(self.folder)

    def listener(self, query_id: str) -> StreamingQueryListener:
        """For ``spark.streams.addListener``: publishes the query's batches as they end."""
        return _Listener(self, query_id)


class _Listener(StreamingQueryListener):
    def __init__(self, late: LateRows, query_id: str):
        self.late, self.query_id = late, query_id

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) == self.query_id:
            self.late.record(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
