"""Search requests as rows: validation, and statistics over the request log."""

from __future__ import annotations

import functools

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from simsearch.functions.text import abstract_link, is_blank, pdf_link, preview
from simsearch.session import checkpoint

# Request limits and defaults.
DEFAULT_K = 10
MAX_K = 100
MAX_NPROBE = 1024

PERCENTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}
QUANTILE_BUCKETS = 512
QUANTILE_ERROR = 1 / 4096
SKETCH_SIZE = 200
RANK_ERROR = 0.02  # of a sketch of this size, merged or not
SORT_VALUES = 1_000_000  # distinct values that one task orders


def validate(requests: DataFrame, index_loaded: bool = True) -> DataFrame:
    """Add ``status_code`` and the defaulted ``k``; a bad request is marked, never an error.

    A wrong shape or range is found first (422), then a missing index (503), then a blank text
    (400).
    """
    k = F.coalesce(F.col("k"), F.lit(DEFAULT_K))
    nprobe = F.col("nprobe")
    malformed = (
        F.col("abstract").isNull()
        | ~k.between(1, MAX_K)
        | F.coalesce(~nprobe.between(1, MAX_NPROBE), F.lit(False))
    )
    status = (
        F.when(malformed, 422)
        .when(F.lit(not index_loaded), 503)
        .when(is_blank(F.col("abstract")), 400)
        .otherwise(200)
    )
    return requests.withColumn("status_code", status).withColumn("k", k)


def validate_texts(requests: DataFrame) -> DataFrame:
    """The same for embedding requests, which carry a text only and need no index."""
    missing = F.col("abstract").isNull()
    status = F.when(missing, 422).when(is_blank(F.col("abstract")), 400).otherwise(200)
    return requests.withColumn("status_code", status)


def request_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("endpoint", "method", "status_code").agg(F.count("*").alias("n"))


def values_at_ranks(values: DataFrame, column: str, shares: dict[str, float]) -> DataFrame:
    """``(name, value)``: the element at 0-based index ``int(n * share)`` of the sorted values.

    Exact. Equal values are counted first, so repeats cost nothing. While more distinct values are left than one task
    should order, approximate quantiles cut them into even buckets, exact counts tell which bucket holds the
    wanted rank, and only that bucket is kept. NaN is the largest value.
    """
    counted = values.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count("*").alias("c"))
    distinct = checkpoint(counted)
    total, n = distinct.agg(F.sum("c"), F.count("*")).first()
    near = []
    for name, share in shares.items():
        rows, offset = _bucket_of(distinct, n, int((total or 0) * share))
        near.append(rows.select(F.lit(name).alias("name"), "v", "c", F.lit(offset).alias("offset")))
    upto = F.sum("c").over(W.partitionBy("name").orderBy("v"))  # at most SORT_VALUES rows a name
    inside = functools.reduce(DataFrame.unionByName, near).withColumn("upto", upto)
    return inside.where(F.col("upto") > F.col("offset")).groupBy("name").agg(F.min("v").alias("value"))


def _bucket_of(distinct: DataFrame, n: int, at: int) -> tuple[DataFrame, int]:
    """The few distinct values around index ``at``, and the index among them."""
    rows = distinct
    while n > SORT_VALUES:
        cuts = rows.approxQuantile("v", [i / QUANTILE_BUCKETS for i in range(1, QUANTILE_BUCKETS)], QUANTILE_ERROR)
        edges = [-float("inf"), *sorted(set(cuts)), float("inf")]
        if len(edges) < 4:
            break
        cut = Bucketizer(splits=edges, inputCol="v", outputCol="bucket", handleInvalid="keep").transform(rows)
        sizes = sorted(cut.groupBy("bucket").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect())
        for size in sizes:  # one row a bucket
            if at < size["c"]:
                break
            at -= size["c"]
        rows, n, before = checkpoint(cut.where(F.col("bucket") == size["bucket"]).drop("bucket")), size["n"], n
        if n == before:
            break
    return rows, at


def latency_stats(log: DataFrame, percentiles: dict[str, float] = PERCENTILES) -> DataFrame:
    """One row over the whole log: totals, rate, and the latency of successful requests.

    ``log(ts, latency, success)``. The wall time is the span of the log's timestamps.
    """
    ok = F.col("success")
    latency = F.when(ok, F.col("latency"))
    seconds = F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))
    summary = log.withColumn("ts", F.col("ts").cast("timestamp")).agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        (seconds / 1e6).alias("wall_seconds"),
        F.min(latency).alias("latency_min"),
        F.max(latency).alias("latency_max"),
        F.avg(latency).alias("latency_avg"),
    )
    at = values_at_ranks(log.where(ok), "latency", percentiles)
    pivoted = at.agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in percentiles])
    points = pivoted.select(F.struct(*percentiles)).scalar()
    return (
        summary.withColumn("success_percent", F.lit(100.0) * F.col("successful") / F.col("total"))
        .withColumn("requests_per_second", F.try_divide(F.col("total"), F.col("wall_seconds")))
        .withColumn("_p", points)
        .select("*", *[F.col("_p").getField(n).alias(n) for n in percentiles])
        .drop("_p")
    )


def latency_sketches(log: DataFrame, window: str = "1 hour") -> DataFrame:
    """``(window_start, sketch, n)``: one mergeable quantile sketch of the successful requests' latency a window, to be stored."""
    timed = log.where(F.col("success") & F.col("latency").isNotNull()).groupBy(F.window("ts", window).alias("w"))
    made = timed.agg(F.kll_sketch_agg_double(F.col("latency"), F.lit(SKETCH_SIZE)).alias("sketch"), F.count("*").alias("n"))
    return made.select(F.col("w.start").alias("window_start"), "sketch", "n")


def merge_sketches(sketches: DataFrame, window: str | None = None) -> DataFrame:
    """Stored sketches of small windows merged into wider ones (or all into one): ``(window_start, sketch, n, merged)``."""
    start = F.min("window_start") if window is None else F.window("window_start", window)["start"]
    grouped = sketches.groupBy() if window is None else sketches.groupBy(start.alias("window_start"))
    own = [start.alias("window_start")] if window is None else []
    merged = grouped.agg(*own, F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"), F.count("*").alias("merged"))
    return merged.select("window_start", "sketch", "n", "merged")


def sketch_percentiles(sketches: DataFrame, percentiles: dict[str, float] = PERCENTILES) -> DataFrame:
    """``(window_start, n, p50, ...)``: each percentile's rank is within ``RANK_ERROR`` of the asked one (99 of 100 times)."""
    return sketches.select("window_start", "n", *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(n) for n, p in percentiles.items()])


def rank_errors(log: DataFrame, found: DataFrame, window: str, percentiles: dict[str, float] = PERCENTILES) -> DataFrame:
    """``(window_start, name, error)``: how far the share of requests at or below a percentile's value is from the asked one.

    A value that many requests share covers a range of ranks; the distance to that range counts. One row a window is broadcast.
    """
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("share"), F.col(n).alias("value")) for n, p in percentiles.items()]))
    asked = found.select("window_start", named.alias("q")).select("window_start", "q.*")
    timed = log.where(F.col("success") & F.col("latency").isNotNull()).select(F.window("ts", window)["start"].alias("window_start"), "latency")
    counted = timed.join(F.broadcast(asked), "window_start").groupBy("window_start", "name", "share")
    ranks = counted.agg((F.count_if(F.col("latency") < F.col("value")) / F.count("*")).alias("low"), (F.count_if(F.col("latency") <= F.col("value")) / F.count("*")).alias("high"))
    return ranks.select("window_start", "name", F.greatest(F.lit(0.0), F.col("low") - F.col("share"), F.col("share") - F.col("high")).alias("error"))


def error_samples(log: DataFrame, n: int = 5) -> DataFrame:
    """The first n failed requests."""
    return log.where(~F.col("success")).orderBy("ts", "request_id").limit(n)


def rate_windows(log: DataFrame, window: str = "1 hour") -> DataFrame:
    """Requests per tumbling window, endpoint and status; a repeated request id counts once, at
    its earliest time."""
    first = F.min(F.struct("ts", "endpoint", "status_code")).alias("f")
    once = log.groupBy("request_id").agg(first).select("f.*")
    return count_windows(once, window)


def count_windows(log: DataFrame, window: str) -> DataFrame:
    counted = log.groupBy(F.window("ts", window).alias("w"), "endpoint", "status_code").agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "endpoint", "status_code", "n")


def alerts(windows: DataFrame, threshold: int) -> DataFrame:
    """Windows with more requests than the threshold."""
    return windows.where(F.col("n") > threshold)


def present_hits(hits: DataFrame) -> DataFrame:
    """Response rows: score with four decimals, a preview of the abstract, links when known."""
    return hits.select(
        "query_id",
        "rank",
        F.format_string("%.4f", "score").alias("score"),
        "title",
        preview(F.col("abstract")).alias("preview"),
        "primary_subject",
        "subjects",
        "arxiv_id",
        abstract_link(F.col("arxiv_id")).alias("abstract_url"),
        pdf_link(F.col("arxiv_id")).alias("pdf_url"),
    )


def as_responses(hits: DataFrame) -> DataFrame:
    """One row per query with its hits as a list in rank order, at most k (<= 100) long."""
    columns = [c for c in hits.columns if c not in ("query_id", "rank")]
    items = F.array_sort(F.collect_list(F.struct("rank", *columns)))
    return hits.groupBy("query_id").agg(items.alias("results"))
