"""Per-batch metrics: the volume check (input rows against the admission
limit), and what a query observed as a table."""

from __future__ import annotations

import logging
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger("txlake.volume")

METRICS = "batch_id long, rows_in long, rejected long, unrouted long, rows_out long, dropped_late long, state_rows long"


def batch_metrics_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """A row per micro-batch that read something, from the query's own progress
    (the latest ``spark.sql.streaming.numRecentProgressUpdates`` batches): what
    ``collector_plan`` observed on its way, so no data is read for it."""
    rows = []
    for p in query.recentProgress:
        seen = {k: v.asDict() for k, v in (p.observedMetrics or {}).items()}
        got, out = seen.get("collector_input"), seen.get("collector_output")
        if not got or not got["input_rows"]:
            continue
        rows.append((p.batchId, got["input_rows"], got["rejected_rows"], got["unrouted_rows"],
                     out["rows_out"] if out else None,
                     sum(int(s.numRowsDroppedByWatermark or 0) for s in p.stateOperators),
                     sum(int(s.numRowsTotal or 0) for s in p.stateOperators)))
    return spark.createDataFrame(rows, METRICS)


class VolumeCheck(StreamingQueryListener):
    """Records every micro-batch's progress and warns when a batch read a
    number of input rows (before dedup) that is off the admission limit by
    more than ``tolerance`` rows (the split count: the source may round the
    limit down once per split)."""

    def __init__(self, limit: int | None = None, tolerance: int = 0, history: int = 10_000):
        self.limit = limit
        self.tolerance = tolerance
        # the latest batches only: a live query runs for ever
        self.batches: deque[dict] = deque(maxlen=history)

    def onQueryStarted(self, event):  # noqa: N802 (listener API)
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        dropped = sum(int(s.numRowsDroppedByWatermark or 0)
                      for s in p.stateOperators)
        state_rows = sum(int(s.numRowsTotal or 0) for s in p.stateOperators)
        observed = {k: v.asDict() for k, v in (p.observedMetrics or {}).items()}
        # the collector reads its input once for the dedup and once for what
        # passes beside it; its observed count is of one reading
        rows = int(next((o["input_rows"] for o in observed.values() if "input_rows" in o),
                        p.numInputRows))
        self.batches.append({"id": str(p.id), "batch_id": p.batchId,
                             "input_rows": rows, "dropped_late": dropped,
                             "state_rows": state_rows, "observed": observed})
        if self.limit is not None and rows > 0 \
                and abs(rows - self.limit) > self.tolerance:
            log.warning("batch %s read %d rows; admission limit is %d",
                        p.batchId, rows, self.limit)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass
