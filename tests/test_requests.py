import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsearch.functions import text
from simsearch.operators import profile
from simsearch.operators import requests as req
from simsearch.operators.encode import HashingEncoder, encode_papers
from simsearch.operators.ivf import build_index
from simsearch.plans import searching

CASES = [
    ("a fine text", None, None, 200),
    ("a fine text", 5, 16, 200),
    ("", None, None, 400),
    (" \t\n ", None, None, 400),
    (None, 5, None, 422),
    ("x", 0, None, 422),
    ("x", 101, None, 422),
    ("x", 100, 1024, 200),
    ("x", 10, 1025, 422),
    ("", 0, None, 422),
]


@pytest.fixture(scope="module")
def requests(spark):
    rows = [(i, a, k, n) for i, (a, k, n, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "query_id bigint, abstract string, k int, nprobe int")


def test_status_codes_and_defaults(requests):
    got = {r["query_id"]: r for r in req.validate(requests).collect()}
    assert [got[i]["status_code"] for i in range(len(CASES))] == [c[3] for c in CASES]
    assert got[0]["k"] == 10 and got[1]["k"] == 5


def test_missing_index_is_noticed_before_a_blank_text(requests):
    got = {r["query_id"]: r["status_code"] for r in req.validate(requests, index_loaded=False).collect()}
    assert [got[i] for i in range(len(CASES))] == [422 if c[3] == 422 else 503 for c in CASES]


def test_embedding_requests_need_a_text_only(requests):
    got = {r["query_id"]: r["status_code"] for r in req.validate_texts(requests).collect()}
    assert (got[2], got[3], got[4], got[5]) == (400, 400, 422, 200)


@pytest.fixture(scope="module")
def answered(spark, papers, requests):
    encoder = HashingEncoder(32)
    index = build_index(encode_papers(papers, encoder), nlist=4, nprobe=4)
    stored = papers.withColumn("arxiv_id", F.lit(None).cast("string"))
    return index, stored, encoder, searching.search_requests(requests, index, stored, encoder)


def test_only_valid_requests_are_answered(answered, requests):
    index, papers, encoder, answer = answered
    hits = answer.hits.collect()
    counts = {}
    for r in hits:
        counts[r["query_id"]] = counts.get(r["query_id"], 0) + 1
    assert counts == {0: 10, 1: 5, 7: 100}
    assert answer.statuses.count() == len(CASES)
    assert searching.search_requests(requests, None, papers, encoder).hits.count() == 0


def test_a_paper_finds_itself(answered, papers):
    index, stored, encoder, _ = answered
    ask = papers.where("paper_id in (3, 77)").select(
        F.col("paper_id").alias("query_id"), "abstract", F.lit(3).alias("k"), F.lit(None).cast("int").alias("nprobe")
    )
    hits = searching.search_requests(ask, index, stored, encoder).hits.where("rank = 1").collect()
    assert all(r["score"] > 0.99 for r in hits) and len(hits) == 2


def test_embedded_requests(requests):
    got = searching.embed_requests(requests, HashingEncoder(32)).collect()
    assert {r["query_id"] for r in got} == {0, 1, 5, 6, 7, 8}
    assert all(r["embedding_dim"] == 32 for r in got)


def test_presented_hits(spark):
    long = "x" * 301
    rows = [(1, 1, 0.98765432, 4, "T", long, "S", ["S"], "2401.1"), (1, 2, 0.5, 5, "U", "x" * 300, "S", [], None)]
    hits = spark.createDataFrame(
        rows, "query_id bigint, rank int, score double, paper_id bigint, title string, abstract string, "
        "primary_subject string, subjects array<string>, arxiv_id string",
    )
    first, second = req.present_hits(hits).orderBy("rank").collect()
    assert first["score"] == "0.9877" and first["preview"] == "x" * 300 + "..."
    assert first["abstract_url"].endswith("/abs/2401.1") and first["pdf_url"].endswith("/pdf/2401.1.pdf")
    assert second["preview"] == "x" * 300 and second["abstract_url"] is None
    response = req.as_responses(hits).first()
    assert [h["rank"] for h in response["results"]] == [1, 2]


def test_text_functions(spark):
    rows = [("Machine Learning (cs.LG)", "a; b"), ("Plain", ""), ("Odd (a) (b) ", None)]
    df = spark.createDataFrame(rows, "s string, j string")
    got = df.select(text.clean_label(F.col("s")), text.split_subjects(F.col("j"))).collect()
    assert [r[0] for r in got] == ["Machine Learning", "Plain", "Odd (a)"]
    assert [r[1] for r in got] == [["a", "b"], [], []]
    numbers = spark.createDataFrame([(n,) for n in (0, 999, 1000, 1999, 999_999, 1_500_000)], "n bigint")
    assert [r[0] for r in numbers.select(text.compact_count(F.col("n"))).collect()] == ["0", "999", "1k", "1k", "999k", "1M"]


def test_profile(papers):
    counts = profile.value_counts(papers)
    top = profile.most_common(counts, "primary_subject", 1).first()
    assert (top["primary_subject"], top["n"]) == ("Physics", 334)
    assert profile.least_common(counts, "primary_subject", 1).first()["primary_subject"] == "Mathematics"
    assert [r[0] for r in profile.never_primary(papers).collect()] == ["General Science"]
    assert tuple(profile.cardinality(papers).first()) == (3, 4)
    assert tuple(profile.cardinality(papers, approximate=True).first()) == (3, 4)


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(3)
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = []
    for i in range(2000):
        latency = 0.25 if rng.random() < 0.4 else round(rng.expovariate(3), 3)
        ok = rng.random() > 0.1
        rows.append((i, start + timedelta(seconds=i * 5), "/search", "POST", 200 if ok else 500, latency, ok))
    schema = "request_id bigint, ts timestamp, endpoint string, method string, status_code int, latency double, success boolean"
    return rows, spark.createDataFrame(rows, schema)


def test_latency_statistics_by_hand(log):
    rows, df = log
    good = sorted(r[5] for r in rows if r[6])
    got = req.latency_stats(df).first()
    n = len(good)
    assert (got["p50"], got["p95"], got["p99"]) == (good[n // 2], good[int(n * 0.95)], good[int(n * 0.99)])
    assert (got["total"], got["successful"], got["failed"]) == (2000, n, 2000 - n)
    assert got["latency_avg"] == pytest.approx(sum(good) / n) and got["latency_max"] == good[-1]
    assert got["wall_seconds"] == 1999 * 5 and got["requests_per_second"] == pytest.approx(2000 / (1999 * 5))


def test_sketches_merge_and_stay_within_their_error(spark, log, tmp_path):
    rows, df = log
    req.latency_sketches(df, "10 minutes").write.parquet(f"{tmp_path}/sketches")
    stored = spark.read.parquet(f"{tmp_path}/sketches")
    whole = req.merge_sketches(stored)
    found = whole.first()
    assert found["n"] == sum(r[6] for r in rows) and found["merged"] == stored.count() > 10
    hours = req.merge_sketches(stored, "1 hour")
    errors = req.rank_errors(df, req.sketch_percentiles(hours), "1 hour").collect()
    assert len(errors) == 3 * hours.count() and all(r["error"] <= req.RANK_ERROR for r in errors)
    assert req.merge_sketches(req.latency_sketches(df.limit(0))).first()["merged"] == 0


@pytest.mark.parametrize("shares", [{"a": 0.0, "b": 0.25, "c": 0.999}])
def test_any_rank_of_any_distribution(spark, shares):
    for values in ([1.0] * 50, [float(v) for v in range(10)], [0.0] * 30 + [5.0, -2.0, 7.5]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        got = {r["name"]: r["value"] for r in req.values_at_ranks(df, "v", shares).collect()}
        assert got == {n: sorted(values)[int(len(values) * s)] for n, s in shares.items()}


def test_log_summaries(log):
    rows, df = log
    assert req.request_counts(df).agg(F.sum("n")).first()[0] == 2000
    assert [r["request_id"] for r in req.error_samples(df).collect()] == [r[0] for r in rows if not r[6]][:5]
    twice = df.unionByName(df)
    assert req.rate_windows(twice).exceptAll(req.rate_windows(df)).count() == 0
    windows = req.rate_windows(df)
    assert req.alerts(windows, 600).count() == windows.where("n > 600").count() > 0


def test_log_schema_is_explicit():
    from simsearch.sources.tables import REQUEST_LOG

    assert REQUEST_LOG["ts"].dataType == T.TimestampType()


def test_nan_is_the_largest_latency(spark):
    values = spark.createDataFrame([(float(i),) for i in range(9)] + [(float("nan"),), (None,)], "latency double")
    got = {r["name"]: r["value"] for r in req.values_at_ranks(values, "latency", {"mid": 0.5, "top": 0.95}).collect()}
    assert got["mid"] == 5.0 and got["top"] != got["top"]


def test_buckets_are_cut_again_until_few_values_are_left(spark, monkeypatch):
    monkeypatch.setattr(req, "SORT_VALUES", 10)
    monkeypatch.setattr(req, "QUANTILE_BUCKETS", 4)
    numbers = [float(i * i % 997) for i in range(700)] + [5.0] * 300 + [float("nan")] * 5
    shares = {f"p{i}": i / 20 for i in range(20)} | {"last": 0.9999}
    got = {r["name"]: r["value"] for r in req.values_at_ranks(spark.createDataFrame([(x,) for x in numbers], "v double"), "v", shares).collect()}
    ordered = sorted(x for x in numbers if x == x) + [float("nan")] * 5
    assert {n: repr(v) for n, v in got.items()} == {n: repr(ordered[int(len(ordered) * s)]) for n, s in shares.items()}
