"""Watching running queries: statistics and lag from their progress reports."""

from __future__ import annotations

import json
import logging
import time

from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)


def summarize(progress: dict) -> dict[str, object]:
    """Counters of the last batch from one progress report."""
    counts = (progress.get("observedMetrics") or {}).get("ingest") or {}
    lags = [
        int((source.get("metrics") or {}).get("maxOffsetsBehindLatest") or 0)
        for source in progress.get("sources") or []
    ]
    return {
        "batch_id": progress.get("batchId"),
        "messages_processed": counts.get("messages_processed", 0),
        "valid_messages": counts.get("valid_messages", 0),
        "invalid_messages": counts.get("invalid_messages", 0),
        "input_rows": progress.get("numInputRows", 0),
        "rows_per_second": progress.get("processedRowsPerSecond"),
        "lag": max(lags, default=0),
    }


class StatisticsListener(StreamingQueryListener):
    """Adds up batch counters and logs the totals at most every ``seconds``.

    ``failed`` counts queries that ended with an error, each of which left one batch
    to be stored again.
    """

    def __init__(self, seconds: float = 30.0) -> None:
        self.seconds = seconds
        self.totals = {"messages_processed": 0, "valid_messages": 0, "invalid_messages": 0}
        self.flushes = 0
        self.failed = 0
        self.lag = 0
        self._logged_at = 0.0

    def onQueryStarted(self, event) -> None:
        log.info("query %s started", event.id)

    def onQueryProgress(self, event) -> None:
        summary = summarize(json.loads(event.progress.json))
        for name in self.totals:
            self.totals[name] += summary[name] or 0
        self.flushes += 1
        self.lag = summary["lag"]
        now = time.monotonic()
        if now - self._logged_at >= self.seconds:
            self._logged_at = now
            log.info("flushes=%d lag=%d %s", self.flushes, self.lag, self.totals)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception is not None:  # the batch it was at is not stored
            self.failed += 1
            log.error("query %s failed: %s", event.id, event.exception)
        log.info("query %s ended, flushes=%d failed=%d %s", event.id, self.flushes, self.failed, self.totals)
