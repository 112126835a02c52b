"""Triggered runs: take in everything that is there, then stop."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress

POLL_SECONDS = 1.0


def run_together(writers: Mapping[str, DataStreamWriter]) -> dict[str, list[StreamingQueryProgress]]:
    """Run all streams side by side to their end and return the progress of all their batches.

    A session keeps only a query's latest progress reports, so they are gathered during the run.
    Should one stream fail, the others are stopped; their checkpoints let the next run go on.
    """
    running: dict[str, StreamingQuery] = {}
    seen: dict[str, dict[int, StreamingQueryProgress]] = {name: {} for name in writers}
    try:
        for name, writer in writers.items():
            running[name] = writer.trigger(availableNow=True).start()
        while running:
            for name, query in list(running.items()):
                ended = query.awaitTermination(POLL_SECONDS / len(running))
                seen[name].update((progress.batchId, progress) for progress in query.recentProgress)
                if ended:
                    del running[name]
    finally:
        for query in running.values():
            query.stop()
    return {name: [batches[i] for i in sorted(batches)] for name, batches in seen.items()}


def run_available(writer: DataStreamWriter) -> list[StreamingQueryProgress]:
    return run_together({"only": writer})["only"]


def rule_totals(progress: Iterable[StreamingQueryProgress], metrics: str) -> dict[str, int]:
    """Rows and violations per rule, added up over the batches of a run."""
    totals: dict[str, int] = {}
    for report in progress:
        counted = report.observedMetrics.get(metrics)
        for name, value in (counted.asDict() if counted else {}).items():
            totals[name] = totals.get(name, 0) + (value or 0)
    return totals
