"""Queries over search requests and the request log."""

from __future__ import annotations

from pyspark.sql import functions as F

from simsearch.operators import requests as req
from simsearch.operators.encode import HashingEncoder, encode_column
from simsearch.operators.ivf import build_index, mean_centroids
from simsearch.plans import searching
from simsearch.registry import sql as q
from simsearch.session import checkpoint, shared_folder
from simsearch.sources.tables import documents_as_papers, events_as_log

DIM = 64
NPROBE = 4
WINDOW = "1 hour"
THRESHOLD = 4


def _timestamps(df, *columns):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


def requests(spark, folder):
    """One request per document; ids spread over good, blank, missing and out-of-range fields."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    i = F.col("doc_id")
    return docs.select(
        i.alias("query_id"),
        F.when(i % 13 == 0, F.lit(None)).when(i % 7 == 0, F.lit(" \t\n")).otherwise(F.col("text")).alias("abstract"),
        F.when(i % 5 != 0, (i % 113).cast("int")).alias("k"),
        F.when(i % 3 != 0, (i * 7 % 1031).cast("int")).alias("nprobe"),
    )


def search_table(spark, folder):
    """Benchmark passages as search requests, some with their own k and nprobe."""
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    i = F.col("item_id")
    return items.select(
        i.alias("query_id"),
        F.col("text").alias("abstract"),
        F.when(i % 2 == 0, (i % 21).cast("int")).alias("k"),
        F.when(i % 3 == 0, (i % 9 + 1).cast("int")).alias("nprobe"),
    )


def validate_requests(spark, folder):
    return req.validate(requests(spark, folder)).select("query_id", "k", "nprobe", "status_code")


def validate_without_index(spark, folder):
    return req.validate(requests(spark, folder), index_loaded=False).select("query_id", "status_code")


def embed_requests(spark, folder):
    embedded = searching.embed_requests(requests(spark, folder), HashingEncoder(DIM)).where("embedding is not null")
    return embedded.select("query_id", "embedding_dim", F.posexplode("embedding").alias("pos", "x")).select(
        "query_id", "embedding_dim", "pos", F.round(F.col("x").cast("double"), 6).alias("value")
    )


def _papers(spark, folder):
    papers = documents_as_papers(spark, folder)
    numbered = F.concat(F.lit("2401."), F.lpad(F.col("paper_id").cast("string"), 5, "0"))
    return papers.withColumn("arxiv_id", F.when(F.col("paper_id") % 2 == 0, numbered)).withColumn(
        "subjects", F.split("joined_subjects", "; ")
    )


def text_index(spark, folder):
    """The documents, encoded, with the mean vector of each source as a list."""
    number = F.regexp_extract("primary_subject", r"^src(\d+)", 1).cast("int")
    papers = _papers(spark, folder).withColumn("list_no", number)
    vectors = encode_column(papers, HashingEncoder(DIM), "paper_id", keep=("list_no",))
    # encoded once, then read by the centroids and by the index
    vectors = checkpoint(vectors.where("embedding is not null"))
    return build_index(vectors, nprobe=NPROBE, centroids=mean_centroids(vectors, "list_no"))


def _answer(spark, folder):
    index = text_index(spark, folder)
    return searching.search_requests(search_table(spark, folder), index, _papers(spark, folder), HashingEncoder(DIM))


def search_requests(spark, folder):
    hits = _answer(spark, folder).hits
    return hits.select("query_id", "rank", "score", "paper_id", "title", "abstract", "primary_subject", "arxiv_id")


def format_hits(spark, folder):
    return req.present_hits(_answer(spark, folder).hits).withColumn("subjects", F.concat_ws("; ", "subjects"))


def request_counts(spark, folder):
    return req.request_counts(events_as_log(spark, folder))


def latency_stats(spark, folder):
    stats = req.latency_stats(events_as_log(spark, folder))
    rounded = ("wall_seconds", "latency_avg", "success_percent", "requests_per_second")
    return stats.withColumns({c: F.round(c, 6) for c in rounded})


def latency_sketches(spark, folder):
    """Hourly sketches, stored, read again and merged by day; whether every percentile is within the stated error of its exact rank."""
    log = events_as_log(spark, folder)
    path = shared_folder(spark, "sketches")
    req.latency_sketches(log, WINDOW).write.parquet(path)
    days = checkpoint(req.merge_sketches(spark.read.parquet(path), "1 day"))
    errors = req.rank_errors(log, req.sketch_percentiles(days), "1 day").groupBy("window_start").agg(F.max("error").alias("error"))
    shown = days.join(errors, "window_start").select("window_start", "n", F.col("merged").alias("n_hours"), (F.col("error") <= req.RANK_ERROR).alias("within_error"))
    return _timestamps(shown, "window_start")


def error_samples(spark, folder):
    errors = req.error_samples(events_as_log(spark, folder))
    return _timestamps(errors, "ts").select("request_id", "ts", "endpoint", "status_code")


def request_rate_windows(spark, folder):
    return _timestamps(req.rate_windows(events_as_log(spark, folder), WINDOW), "window_start", "window_end")


def request_alerts(spark, folder):
    windows = req.rate_windows(events_as_log(spark, folder), WINDOW)
    return _timestamps(req.alerts(windows, THRESHOLD), "window_start", "window_end")


QUERIES = {
    f.__name__: f
    for f in (
        validate_requests, validate_without_index, embed_requests, search_requests, format_hits, request_counts,
        latency_stats, latency_sketches, error_samples, request_rate_windows, request_alerts,
    )
}

_REQUESTS = """requests AS (
  SELECT doc_id AS query_id,
    CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN ' ' || chr(9) || chr(10) ELSE text END AS abstract,
    CASE WHEN doc_id % 5 <> 0 THEN (doc_id % 113)::INTEGER END AS k,
    CASE WHEN doc_id % 3 <> 0 THEN (doc_id * 7 % 1031)::INTEGER END AS nprobe FROM documents)"""


def _checked(index_loaded: bool) -> str:
    return f"""checked AS (
  SELECT query_id, abstract, coalesce(k, 10) AS k, nprobe,
    CASE WHEN abstract IS NULL OR NOT coalesce(k, 10) BETWEEN 1 AND 100
           OR coalesce(NOT nprobe BETWEEN 1 AND 1024, false) THEN 422
         WHEN {not index_loaded} THEN 503
         WHEN regexp_full_match(abstract, '\\s*') THEN 400 ELSE 200 END::INTEGER AS status_code
  FROM requests)"""


_SEARCH = q.with_(
    q.PAPERS.replace("source, lang\n", "substr(source, 4)::INTEGER AS list_no,\n"
                     "         CASE WHEN doc_id % 2 = 0 THEN '2401.' || lpad(doc_id::VARCHAR, 5, '0') END AS arxiv_id\n"),
    """requests AS (
  SELECT item_id AS query_id, text AS abstract, CASE WHEN item_id % 2 = 0 THEN (item_id % 21)::INTEGER END AS k,
    CASE WHEN item_id % 3 = 0 THEN (item_id % 9 + 1)::INTEGER END AS nprobe FROM benchmark)""",
    _checked(True),
    "good AS (SELECT * FROM checked WHERE status_code = 200)",
    q.encoded("doc_vecs", "papers", "paper_id", "abstract"),
    q.encoded("req_vecs", "good", "query_id", "abstract"),
    "stored AS (SELECT paper_id, embedding, list_no FROM doc_vecs JOIN papers USING (paper_id))",
    q.centroids("stored", "list_no"),
    q.assigned("stored"),
    f"asked AS (SELECT query_id, embedding, k, coalesce(nprobe, {NPROBE}) AS nprobe FROM req_vecs JOIN good USING (query_id))",
    q.ivf_hits("asked", "k", "nprobe"),
)

_WINDOWS = """windows AS (
  SELECT date_trunc('hour', ts) AS s, endpoint, status_code, count(*) AS n FROM (
    SELECT request_id, min(ts) AS ts, arg_min(endpoint, ts) AS endpoint, arg_min(status_code, ts) AS status_code
    FROM log GROUP BY request_id) GROUP BY ALL)"""
_WINDOW_ROWS = """SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(s + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, endpoint, status_code, n FROM windows"""

ORACLE = {
    "validate_requests": q.with_(_REQUESTS, _checked(True)) + "SELECT query_id, k, nprobe, status_code FROM checked",
    "validate_without_index": q.with_(_REQUESTS, _checked(False)) + "SELECT query_id, status_code FROM checked",
    "embed_requests": q.with_(
        _REQUESTS,
        r"""good AS (SELECT query_id, abstract FROM requests
  WHERE abstract IS NOT NULL AND NOT regexp_full_match(abstract, '\s*'))""",
        q.encoded("vecs", "good", "query_id", "abstract"),
    )
    + """SELECT query_id, 64::INTEGER AS embedding_dim, (i - 1)::INTEGER AS pos, round(embedding[i], 6) AS value
FROM (SELECT query_id, embedding, unnest(range(1, 65)) AS i FROM vecs)""",
    "search_requests": _SEARCH
    + """SELECT query_id, rank, score, paper_id, title, abstract, primary_subject, arxiv_id
FROM hits JOIN papers USING (paper_id)""",
    "format_hits": _SEARCH
    + """SELECT query_id, rank, round(score::DECIMAL(18, 6), 4)::DECIMAL(18, 4)::VARCHAR AS score, title,
  CASE WHEN length(abstract) > 300 THEN substr(abstract, 1, 300) || '...' ELSE abstract END AS preview,
  primary_subject, joined_subjects AS subjects, arxiv_id, 'https://arxiv.org/abs/' || arxiv_id AS abstract_url,
  'https://arxiv.org/pdf/' || arxiv_id || '.pdf' AS pdf_url
FROM hits JOIN papers USING (paper_id)""",
    "request_counts": q.with_(q.LOG)
    + "SELECT endpoint, method, status_code, count(*) AS n FROM log GROUP BY ALL",
    "latency_stats": q.with_(
        q.LOG,
        "good AS (SELECT latency, row_number() OVER (ORDER BY latency) - 1 AS i, count(*) OVER () AS n FROM log WHERE success)",
    )
    + """SELECT count(*) AS total, count(*) FILTER (success) AS successful, count(*) FILTER (NOT success) AS failed,
  round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::DOUBLE, 6) AS wall_seconds,
  min(latency) FILTER (success) AS latency_min, max(latency) FILTER (success) AS latency_max,
  round(avg(latency) FILTER (success), 6) AS latency_avg,
  round(100::DOUBLE * count(*) FILTER (success) / count(*), 6) AS success_percent,
  round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::DOUBLE), 6) AS requests_per_second,
  (SELECT latency FROM good WHERE i = floor(n * 0.5::DOUBLE)) AS p50,
  (SELECT latency FROM good WHERE i = floor(n * 0.95::DOUBLE)) AS p95,
  (SELECT latency FROM good WHERE i = floor(n * 0.99::DOUBLE)) AS p99
FROM log""",
    "latency_sketches": q.with_(q.LOG)
    + """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n,
  count(DISTINCT date_trunc('hour', ts)) AS n_hours, true AS within_error FROM log WHERE success GROUP BY date_trunc('day', ts)""",
    "error_samples": q.with_(q.LOG)
    + """SELECT request_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, endpoint, status_code
FROM log WHERE NOT success ORDER BY log.ts, request_id LIMIT 5""",
    "request_rate_windows": q.with_(q.LOG, _WINDOWS) + _WINDOW_ROWS,
    "request_alerts": q.with_(q.LOG, _WINDOWS) + _WINDOW_ROWS + f" WHERE n > {THRESHOLD}",
}
