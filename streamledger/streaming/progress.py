"""O1 from query progress: what each batch's source reported, as a table."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = ("run_id string, batch_id bigint, topic string, partition int, "
            "from_offset bigint, until_offset bigint, latest_offset bigint")


def _flat(text: str | None) -> dict[tuple[str, int], int]:
    """Offsets by partition, of a source that reports them as Kafka's does."""
    found = json.loads(text) if text and text.startswith("{") else {}       # "None" before the first batch
    return {(t, int(p)): int(o) for t, parts in found.items() for p, o in parts.items()}


class ProgressLog(StreamingQueryListener):
    """Keeps the ranges of the last ``batches`` batches of every query that is
    started while it is registered (``spark.streams.addListener``): where each
    began and ended, and how far the log went by then.  Partitions that a batch
    did not advance are left out.

    Progress arrives after a batch, so it serves monitoring (``lag``) and checks
    against the commits; ``sinks.guarded`` needs a batch's ranges before.
    """

    def __init__(self, batches: int = 1000):
        self.batches, self._rows, self._done = batches, {}, set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = []
        for source in p.sources:
            start, end, latest = (_flat(x) for x in (source.startOffset, source.endOffset, source.latestOffset))
            rows += [(str(p.runId), p.batchId, t, n, start.get((t, n)), o, latest.get((t, n)))
                     for (t, n), o in sorted(end.items()) if o != start.get((t, n))]
        if rows or (str(p.runId), p.batchId) not in self._rows:     # an idle trigger repeats the last batch's number
            self._rows[str(p.runId), p.batchId] = rows
        while len(self._rows) > self.batches:
            del self._rows[next(iter(self._rows))]

    def onQueryTerminated(self, event) -> None:
        self._done.add(str(event.runId))

    def wait_for(self, query, seconds: float = 30.0) -> None:
        """Until the end of a stopped query has been heard of: events lag behind."""
        until = time.time() + seconds
        while str(query.runId) not in self._done:
            if time.time() > until:
                raise TimeoutError(f"no end of query {query.runId} after {seconds} seconds")
            time.sleep(0.05)

    def ranges(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([r for rows in self._rows.values() for r in rows], PROGRESS)
