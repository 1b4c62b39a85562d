"""Click-stream monitoring. Every function takes a batch or a streaming frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.functions import logs

# Alert limits and the watched category.
REQUEST_LIMIT = 100
FAILURE_LIMIT = 500
CATEGORY = "digital-cameras"
OK_STATUS = 200
# Counters of a window, in place of one for every client.
BUCKETS = 65_536


def parse_log(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Access-log lines as typed columns, and all other lines with the reason.

    Lines that are not in the format are ``malformed``; those with a time that no calendar
    has are rejected as ``impossible time``.
    """
    line = F.col(column)
    field = {name: F.col("_f")[i] for i, name in enumerate(logs.FIELDS)}
    parsed = (
        lines.where(~F.coalesce(logs.has_separator(line), F.lit(True)))
        .select(F.explode(logs.log_fields(line)).alias("_f"))
        .select(
            field["ip"].alias("ip"),
            F.try_to_timestamp(field["time"], F.lit(logs.LOG_TIME_FORMAT)).alias("ts"),
            field["method"].alias("method"),
            field["path"].alias("path"),
            field["status"].cast("int").alias("status"),
            field["bytes"].try_cast("long").alias("bytes"),
            field["referer"].alias("referer"),
            field["agent"].alias("agent"),
        )
        .where("ts is not null")
    )
    # One exploded row per line, so that the pattern runs once and not per use of its result.
    told = lines.select(line.alias("record"), F.explode(F.array(logs.stamp(line))).alias("_t"))
    reason = F.when(F.col("_t").isNull(), "malformed").when(
        F.try_to_timestamp("_t", F.lit(logs.LOG_TIME_FORMAT)).isNull(), "impossible time"
    )
    rejected = told.select("record", reason.alias("reject_reason"))
    return parsed, rejected.where("reject_reason is not null")


def _windowed(parsed: DataFrame, window: str, watermark: str | None, by: Sequence[str] = ()):
    events = parsed.withWatermark("ts", watermark) if watermark else parsed
    return events.groupBy(F.window("ts", window).alias("_w"), *by)


def _start(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "_w"]
    return df.select(F.col("_w.start").alias("window_start"), *rest)


def request_rate(
    parsed: DataFrame,
    window: str = "1 second",
    by: Sequence[str] = (),
    watermark: str | None = None,
) -> DataFrame:
    """Requests per window, over all clients or ``by`` some columns (such as ``ip``)."""
    counts = _windowed(parsed, window, watermark, by).agg(F.count(F.lit(1)).alias("n_requests"))
    return _start(counts)


def _bucket(client: str, buckets: int):
    return F.pmod(F.xxhash64(client), F.lit(buckets)).alias("bucket")


def crowded_buckets(
    parsed: DataFrame,
    limit: int = REQUEST_LIMIT,
    window: str = "1 second",
    client: str = "ip",
    buckets: int = BUCKETS,
    watermark: str | None = None,
) -> DataFrame:
    """Windows and buckets of clients, by hash, that passed ``limit`` together.

    A client over the limit is in one of them, so that a window needs ``buckets`` counters
    however many clients it has.
    """
    numbered = parsed.withColumn("bucket", _bucket(client, buckets))
    return request_rate(numbered, window, ("bucket",), watermark).where(F.col("n_requests") > limit)


def heavy_clients(
    parsed: DataFrame,
    limit: int = REQUEST_LIMIT,
    window: str = "1 second",
    client: str = "ip",
    buckets: int = BUCKETS,
    crowded: DataFrame | None = None,
) -> DataFrame:
    """Clients with more than ``limit`` requests in a window, counted exactly.

    Only requests in ``crowded_buckets`` are counted by client; ``crowded`` may hold those
    that a stream has found, some of them several times. The more buckets, the fewer clients
    share one with a heavy client or pass the limit together.
    """
    if crowded is None:
        crowded = crowded_buckets(parsed, limit, window, client, buckets)
    marked = parsed.where("ts is not null").select(
        F.window("ts", window).start.alias("window_start"), client, _bucket(client, buckets)
    )
    asked = marked.join(crowded.select("window_start", "bucket"), ["window_start", "bucket"], "left_semi")
    counts = asked.groupBy("window_start", client).agg(F.count(F.lit(1)).alias("n_requests"))
    return counts.where(F.col("n_requests") > limit)


def windowed_status(
    parsed: DataFrame, window: str = "5 minutes", watermark: str | None = None
) -> DataFrame:
    """Failed and successful responses, and requests of the watched category, per window."""
    counts = _windowed(parsed, window, watermark).agg(
        F.count_if(F.col("status") != OK_STATUS).alias("failures"),
        F.count_if(F.col("status") == OK_STATUS).alias("successes"),
        F.count_if(logs.category(F.col("path")) == CATEGORY).alias("category_hits"),
    )
    return _start(counts)


def category_counts(
    parsed: DataFrame,
    category: str = CATEGORY,
    window: str = "5 minutes",
    watermark: str | None = None,
) -> DataFrame:
    """Requests of one category per window; windows without one are left out."""
    wanted = parsed.where(logs.category(F.col("path")) == category.lower())
    counts = _windowed(wanted, window, watermark).agg(F.count(F.lit(1)).alias("category_hits"))
    return _start(counts)


def alerts(counts: DataFrame, column: str, limit: int = REQUEST_LIMIT) -> DataFrame:
    """The windows in which ``column`` passed ``limit``, for any sink to deliver."""
    return counts.where(F.col(column) > limit).withColumns(
        {"alert": F.lit(f"{column} > {limit}"), "observed": F.col(column).cast("long")}
    )
