"""Click-stream windows and alerts on a stream of log lines.

Windows are updated with every micro-batch and written to its folder;
``sinks.batches.latest`` gives the current row of each. Counts are combined in each task
before they meet their state, so a busy client or second is not one task's work. The
watermark bounds the state: lines later than it are not counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lakejobs.plans import clicks
from lakejobs.streaming import jobs

LATENESS = "10 minutes"


def status_windows(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    window: str = "5 minutes",
    lateness: str = LATENESS,
    interval: str | None = None,
) -> StreamingQuery:
    """Failures, successes and category hits per window."""
    parsed, _ = clicks.parse_log(lines)
    counts = clicks.windowed_status(parsed, window, lateness)
    return jobs.start(counts, jobs.into_batches(path), checkpoint, interval, "update")


def failure_alerts(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    limit: int = clicks.FAILURE_LIMIT,
    window: str = "5 minutes",
    lateness: str = LATENESS,
    interval: str | None = None,
) -> StreamingQuery:
    """Windows with more than ``limit`` failed responses."""
    parsed, _ = clicks.parse_log(lines)
    found = clicks.alerts(clicks.windowed_status(parsed, window, lateness), "failures", limit)
    return jobs.start(found, jobs.into_batches(path), checkpoint, interval, "update")


def rate_alerts(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    limit: int = clicks.REQUEST_LIMIT,
    window: str = "1 second",
    by: Sequence[str] = (),
    lateness: str = LATENESS,
    interval: str | None = None,
) -> StreamingQuery:
    """Windows with more than ``limit`` requests, also when they come in several batches."""
    parsed, _ = clicks.parse_log(lines)
    counts = clicks.request_rate(parsed, window, by, lateness)
    found = clicks.alerts(counts, "n_requests", limit)
    return jobs.start(found, jobs.into_batches(path), checkpoint, interval, "update")


def crowded_buckets(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    limit: int = clicks.REQUEST_LIMIT,
    window: str = "1 second",
    client: str = "ip",
    buckets: int = clicks.BUCKETS,
    lateness: str = LATENESS,
    interval: str | None = None,
) -> StreamingQuery:
    """Windows and buckets of clients that may hold one with more than ``limit`` requests.

    The state of a window is bounded by ``buckets``. With the lines that ``jobs.land_raw``
    has landed, ``plans.clicks.heavy_clients`` counts the clients of these buckets exactly.
    """
    parsed, _ = clicks.parse_log(lines)
    found = clicks.crowded_buckets(parsed, limit, window, client, buckets, lateness)
    return jobs.start(found, jobs.into_batches(path), checkpoint, interval, "update")


def rejects(
    lines: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Lines that the other queries cannot count, with the reason."""
    _, rejected = clicks.parse_log(lines)
    return jobs.start(rejected, jobs.into_batches(path), checkpoint, interval)


def monitor(
    lines: DataFrame, root: str, for_good: bool = False, lateness: str = LATENESS
) -> list[StreamingQuery]:
    """Rate alerts, failure alerts, status windows and rejected lines side by side.

    Each is a query of its own, with its own checkpoint and folder under ``root``.
    ``for_good`` keeps them running; otherwise they take what there is and stop.
    """
    rate = jobs.RATE_INTERVAL if for_good else None
    status = jobs.STATUS_INTERVAL if for_good else None

    def folders(name: str) -> tuple[str, str]:
        return f"{root}/{name}", f"{root}/checkpoints/{name}"

    return [
        rate_alerts(lines, *folders("rate_alerts"), lateness=lateness, interval=rate),
        failure_alerts(lines, *folders("failure_alerts"), lateness=lateness, interval=status),
        status_windows(lines, *folders("status_windows"), lateness=lateness, interval=status),
        rejects(lines, *folders("rejected"), interval=status),
    ]
