import numpy as np
import pytest
from pyspark.sql import functions as F

from simsearch.operators import ivf, skew
from simsearch.operators.topk import BestHits, SearchLimits, exact_topk
from simsearch.sources import store

TINY = SearchLimits(block_bytes=60_000, broadcast_hits=0)


def brute(queries, vectors, k):
    out = {}
    x = vectors.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for q in queries:
        scores = np.round(x @ x[q], 6)
        out[q] = [(int(i), float(scores[i])) for i in np.lexsort((np.arange(len(x)), -scores))[:k]]
    return out


def as_dict(hits):
    out = {}
    for r in sorted(hits.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["paper_id"], r["score"]))
    return out


def asked(embeddings, ids):
    return embeddings.where(F.col("paper_id").isin(ids)).select(F.col("paper_id").alias("query_id"), "embedding")


IDS = [0, 7, 8, 100, 361, 399]


@pytest.mark.parametrize("limits", [SearchLimits(), TINY])
def test_exact_search_equals_brute_force_with_ties(embeddings, matrix, limits):
    hits = exact_topk(asked(embeddings, IDS), embeddings, 16, 12, limits)
    assert as_dict(hits) == brute(IDS, matrix, 12)


@pytest.mark.parametrize("limits", [SearchLimits(), TINY])
def test_every_row_may_be_a_query(embeddings, matrix, limits):
    hits = exact_topk(asked(embeddings, list(range(400))), embeddings, 16, 3, limits)
    assert as_dict(hits) == brute(range(400), matrix, 3)


def test_each_query_may_have_its_own_k(embeddings, index):
    queries = asked(embeddings, [1, 2, 15]).withColumn("k", F.col("query_id").cast("int") + 1)
    for got in (as_dict(exact_topk(queries, embeddings, 16, 10)), as_dict(ivf.search(queries, index, 10, nprobe=8))):
        assert [len(got[q]) for q in (1, 2, 15)] == [2, 3, 16]


def test_vectors_without_direction_are_left_out_and_counted(spark, embeddings):
    extra = spark.createDataFrame([(900, None), (901, [0.0] * 16)], "paper_id bigint, embedding array<float>")
    both = embeddings.unionByName(extra)
    assert exact_topk(asked(embeddings, [3]), both, 16, 1000).count() == 400
    assert ivf.misfits(both, 16).first()["misfits"] == 2


def test_a_vector_of_another_length_is_an_error(spark, embeddings):
    extra = spark.createDataFrame([(901, [1.0, 2.0])], "paper_id bigint, embedding array<float>")
    both = embeddings.unionByName(extra)
    assert ivf.misfits(both, 16).first()["misfits"] == 1
    with pytest.raises(ValueError, match="one fixed dimension"):
        ivf.embedding_dim(both, check_all=True)
    with pytest.raises(Exception, match="one fixed dimension"):
        exact_topk(asked(embeddings, [3]), both, 16, 10).collect()


def test_scores_are_cosines_whatever_the_length(spark, embeddings):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [5.0, 5.0]), (3, [-3.0, 0.0])], "paper_id bigint, embedding array<float>")
    queries = spark.createDataFrame([(9, [2.0, 0.0])], "query_id bigint, embedding array<float>")
    got = [(r["paper_id"], r["score"]) for r in exact_topk(queries, rows, 2, 3).orderBy("rank").collect()]
    assert got == [(1, 1.0), (2, 0.707107), (3, -1.0)]
    scaled = embeddings.withColumn("embedding", F.transform("embedding", lambda x: x * (F.col("paper_id") % 7 + 1).cast("float")))
    assert as_dict(exact_topk(asked(scaled, IDS), scaled, 16, 5)).keys() == as_dict(exact_topk(asked(embeddings, IDS), embeddings, 16, 5)).keys()


def test_best_hits_leave_in_bounded_batches(monkeypatch, matrix):
    monkeypatch.setattr("simsearch.operators.topk.BATCH_HITS", 60)
    best = BestHits(matrix.astype(np.float64), 5)
    best.add(np.arange(400), np.arange(400), matrix.astype(np.float64))
    batches = list(best.to_batches(np.arange(400), np.full(400, 4)))
    assert max(b.num_rows for b in batches) <= 60 and sum(b.num_rows for b in batches) == 1600
    got = {}
    for row in (r for b in batches for r in b.to_pylist()):
        got.setdefault(row["query_id"], []).append((row["paper_id"], row["score"]))
    assert got == {i: list(zip(best.ids[i, :4].tolist(), best.scores[i, :4].tolist(), strict=True)) for i in range(400)}


def test_blocks_do_not_change_the_best(monkeypatch, matrix):
    x = matrix.astype(np.float64)
    whole, parts = BestHits(x[:20], 5), BestHits(x[:20], 5)
    whole.add(np.arange(20), np.arange(400), x)
    monkeypatch.setattr("simsearch.operators.topk.BLOCK_CELLS", 50)
    for start in range(0, 400, 33):
        parts.add(np.arange(20), np.arange(start, min(400, start + 33)), x[start : start + 33])
    assert (whole.ids == parts.ids).all() and (whole.scores == parts.scores).all()


@pytest.fixture(scope="module")
def index(embeddings):
    return ivf.build_index(embeddings, nlist=8, nprobe=3)


def test_index_holds_every_vector_once(index):
    sizes = ivf.list_sizes(index).collect()
    assert sum(r["n_vectors"] for r in sizes) == 400 and len(sizes) == index.nlist
    assert (index.dim, index.nprobe) == (16, 3)


@pytest.mark.parametrize("limits", [SearchLimits(), TINY])
def test_probing_every_list_is_exact(embeddings, matrix, index, limits):
    from dataclasses import replace

    hits = ivf.search(asked(embeddings, IDS), replace(index, limits=limits), k=12, nprobe=index.nlist)
    assert as_dict(hits) == brute(IDS, matrix, 12)


def test_both_ways_of_probing_agree_and_recall_grows(embeddings, matrix, index):
    from dataclasses import replace

    exact = brute(range(400), matrix, 10)
    queries = asked(embeddings, list(range(400)))
    found = []
    for nprobe in (1, 3, 8):
        got = as_dict(ivf.search(queries, index, 10, nprobe))
        if nprobe == 3:
            assert got == as_dict(ivf.search(queries, replace(index, limits=TINY), 10, nprobe))
        found.append(sum(len({i for i, _ in got[q]} & {i for i, _ in exact[q]}) for q in exact))
    assert found[0] <= found[1] <= found[2] == 4000


def test_a_vector_finds_itself_first(embeddings, index):
    for query, hits in as_dict(ivf.search(asked(embeddings, [3, 50, 200]), index, 10)).items():
        assert hits[0][0] == query and hits[0][1] > 0.99
        scores = [s for _, s in hits]
        assert scores == sorted(scores, reverse=True) and len(hits) <= 10


def test_nprobe_order_of_precedence(embeddings, index):
    queries = asked(embeddings, [5]).withColumn("nprobe", F.lit(8))
    own = as_dict(ivf.search(queries, index, 400))
    assert len(own[5]) == 400
    assert len(as_dict(ivf.search(asked(embeddings, [5]), index, 400, nprobe=1))[5]) < 400
    unset = asked(embeddings, [5]).withColumn("nprobe", F.lit(None).cast("int"))
    assert as_dict(ivf.search(unset, index, 400)) == as_dict(ivf.search(asked(embeddings, [5]), index, 400))


def test_save_and_load_give_the_same_hits(spark, embeddings, index, tmp_path):
    store.save_index(index, str(tmp_path))
    loaded = store.load_index(spark, str(tmp_path))
    assert (loaded.nprobe, loaded.nlist, loaded.dim) == (3, index.nlist, 16)
    queries = asked(embeddings, IDS)
    assert as_dict(ivf.search(queries, loaded, 10)) == as_dict(ivf.search(queries, index, 10))
    assert store.load_index(spark, str(tmp_path), nprobe=6).nprobe == 6
    smaller = ivf.build_index(embeddings.where("paper_id < 100"), nlist=2, nprobe=1)
    store.save_index(smaller, str(tmp_path))
    again = store.load_index(spark, str(tmp_path))
    assert again.postings.count() == 100 and loaded.postings.count() == 400


def test_search_opens_only_the_probed_lists(spark, embeddings, index, tmp_path):
    store.save_index(index, str(tmp_path))
    loaded = store.load_index(spark, str(tmp_path))
    hits = ivf.search(asked(embeddings, [5]), loaded, 10, nprobe=2)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.splitlines() if "PartitionFilters" in x and "list_id" in x)
    assert "list_group" in line.split("PartitionFilters: [")[1].split("]")[0] and "In(list_id" in line.split("PushedFilters")[1]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_large_lists_are_written_by_several_tasks(spark, embeddings, index, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "VECTORS_PER_FILE", 20)
    # a test's few kilobytes would be merged into one task
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.save_index(index, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = list(tmp_path.glob("build-*/postings/**/*.parquet"))
    assert len(files) > index.nlist
    assert store.load_index(spark, str(tmp_path)).postings.count() == 400


def test_missing_index_and_bad_arguments(spark, embeddings, tmp_path):
    with pytest.raises(FileNotFoundError, match="index not found"):
        store.load_index(spark, str(tmp_path / "none"))
    with pytest.raises(RuntimeError, match="not loaded"):
        ivf.search(asked(embeddings, [1]), None)
    with pytest.raises(ValueError, match="nlist"):
        ivf.build_index(embeddings, nlist=401)


def test_vectors_and_papers_must_match(spark, embeddings, papers):
    with pytest.raises(ValueError, match="papers_without_vector': 600"):
        ivf.require_match(embeddings, papers)
    ivf.require_match(embeddings, papers.where("paper_id < 400"))


def test_hits_join_their_paper_and_lost_ones_are_known(embeddings, papers, index):
    hits = ivf.search(asked(embeddings, [5, 390]), index, 10)
    half = papers.where("paper_id < 200")
    joined, lost = ivf.hydrate(hits, half), ivf.lost_hits(hits, half)
    assert joined.count() + lost.count() == 20
    assert all(r["title"] == f"Paper {r['paper_id']}" and r["subjects"][1] == "General Science" for r in joined.collect())


def test_fetching_vectors_by_id(embeddings, papers, matrix):
    got = ivf.fetch_vectors(embeddings, papers.where("paper_id % 100 = 0")).collect()
    assert {r["paper_id"] for r in got} == {0, 100, 200, 300}
    assert all(np.allclose(r["embedding"], matrix[r["paper_id"]]) for r in got)


def test_hot_groups_join_like_any_other(skewed, monkeypatch):
    groups = skewed.groupBy("primary_subject").agg(F.count("*").alias("n"))
    expected = sorted(map(tuple, skewed.join(groups, "primary_subject").collect()))
    monkeypatch.setattr(skew, "MAX_BROADCAST_GROUPS", 2)
    monkeypatch.setattr(skew, "MAX_HEAVY_GROUPS", 3)
    joined = skew.join_group(skewed, groups, "primary_subject", "n")
    assert sorted(map(tuple, joined.collect())) == expected
