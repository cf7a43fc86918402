"""Search by list, papers by id, the centroid tree, drawn positions and the pair stream."""

import time
from dataclasses import replace

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import unit_vectors
from metrics import rows_of
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_search import as_dict, asked, brute

from simsearch.operators import centroid_tree, ivf, pairs, topk
from simsearch.operators.positions import index_subjects
from simsearch.operators.topk import SearchLimits, exact_topk
from simsearch.sources import paper_store
from simsearch.streaming.pair_stream import EpochReader, start_pairs

JOINED = SearchLimits(block_bytes=60_000, most_scans=0, part_rows=30)


# ---- search by list


def test_joined_search_equals_brute_force_with_ties(embeddings, matrix):
    hits = exact_topk(asked(embeddings, list(range(400))), embeddings, 16, 12, JOINED)
    assert as_dict(hits) == brute(range(400), matrix, 12)


@pytest.mark.parametrize("nprobe", [1, 3, 8])
def test_joined_search_equals_scanned_search(embeddings, nprobe):
    index = ivf.build_index(embeddings, nlist=8, nprobe=3)
    queries = asked(embeddings, list(range(0, 400, 3))).withColumn("k", (F.col("query_id") % 9 + 1).cast("int"))
    scanned = as_dict(ivf.search(queries, index, nprobe=nprobe))
    assert as_dict(ivf.search(queries, replace(index, limits=JOINED), nprobe=nprobe)) == scanned


def test_vectors_are_read_once_however_many_blocks_ask(spark, embeddings, tmp_path):
    embeddings.write.parquet(f"{tmp_path}/v")
    stored = spark.read.parquet(f"{tmp_path}/v")
    limits = SearchLimits(block_bytes=(8 * 16 + 8 + 16 * 10 + 32) * 100, most_scans=1)  # 400 queries are four blocks
    hits = exact_topk(asked(embeddings, list(range(400))), stored, 16, 10, limits)
    hits.collect()
    assert rows_of(hits, "Scan parquet") == [400]


def test_copies_of_joined_search_grow_with_the_rows(spark):
    """Four times the rows of both sides, in as many blocks, are dealt out as four times the copies."""
    copies = []
    for n in (4_000, 16_000):
        postings = spark.range(n).select((F.col("id") % 2).alias("list_id"))
        asked = spark.range(n // 5).select((F.col("id") % 2).alias("list_id"))
        units = topk._units(asked, postings, n // 40, 40).collect()
        assert all(u["blocks"] == 4 and u["parts"] >= 2 for u in units) and len(units) == 2
        copies.append(sum(n // 10 * u["parts"] + n // 2 * u["blocks"] for u in units))
    assert copies[1] <= 4 * copies[0] and copies[1] <= 2 * 4 * 16_000


def test_joined_search_of_nothing(embeddings):
    none = asked(embeddings, []).limit(0)
    assert exact_topk(none, embeddings, 16, 5, JOINED).count() == 0
    assert exact_topk(asked(embeddings, [1]), embeddings.limit(0), 16, 5, JOINED).count() == 0


def test_a_query_without_direction_has_no_hits_in_joined_search(spark, embeddings):
    zero = spark.createDataFrame([(900, [0.0] * 16)], "query_id bigint, embedding array<float>")
    got = as_dict(exact_topk(asked(embeddings, [5]).unionByName(zero), embeddings, 16, 4, JOINED))
    assert list(got) == [5] and len(got[5]) == 4


# ---- papers by id


@pytest.fixture(scope="module")
def store(spark, papers, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("papers"))
    paper_store.save_papers(papers.where("paper_id % 3 <> 1"), path, rows_per_file=50)  # ids with gaps
    return paper_store.load_papers(spark, path)


def test_papers_are_fetched_by_id(store):
    got = store.fetch([0, 999, 500, 500, 501, 502, 4000, -3])
    assert sorted(r["paper_id"] for r in got.collect()) == [0, 500, 501, 999]
    assert got.columns == ["paper_id", "title", "abstract", "primary_subject", "subjects"]
    assert store.fetch([]).count() == 0 and store.fetch([-1, 5000]).count() == 0


def test_a_lookup_reads_a_fraction_of_the_rows(store):
    got = store.fetch([10 * 3, 600])
    assert got.count() == 2
    got.collect()
    assert rows_of(got, "Scan parquet")[0] <= 2 * 60
    hits = store.papers.sparkSession.createDataFrame([(1, 1, 0.5, 600), (1, 2, 0.4, 30), (2, 1, 0.3, 600), (2, 2, 0.1, 601)], "query_id bigint, rank int, score double, paper_id bigint")
    full = ivf.hydrate(hits, store)
    assert sorted((r["query_id"], r["paper_id"], r["title"]) for r in full.collect()) == [(1, 30, "Paper 30"), (1, 600, "Paper 600"), (2, 600, "Paper 600")]
    assert max(n for n in rows_of(full, "Scan parquet") if n is not None) <= 2 * 60


def test_many_ids_are_one_join(store, monkeypatch):
    monkeypatch.setattr(paper_store, "FEW_IDS", 20)
    ids = store.papers.sparkSession.range(0, 400).withColumnRenamed("id", "paper_id")
    assert store.lookup(ids.unionByName(ids)).count() == len([i for i in range(400) if i % 3 != 1])
    with pytest.raises(ValueError, match="at most 20"):
        store.fetch(list(range(30)))


def test_rows_by_place(store):
    ids = [i for i in range(1000) if i % 3 != 1]
    assert len(store) == len(ids)
    places = [0, 1, 49, 50, 51, 333, len(ids) - 1]
    got = {r["place"]: r["paper_id"] for r in store.rows_at(places).collect()}
    assert got == {p: ids[p] for p in places}
    for wrong in (-1, len(ids)):
        with pytest.raises(IndexError):
            store.rows_at([wrong])


def test_a_store_of_nothing_and_one_that_is_not_there(spark, papers, tmp_path):
    paper_store.save_papers(papers.limit(0), f"{tmp_path}/none")
    empty = paper_store.load_papers(spark, f"{tmp_path}/none")
    assert len(empty) == 0 and empty.fetch([1]).count() == 0 and empty.rows_at([]).count() == 0
    with pytest.raises(FileNotFoundError):
        paper_store.load_papers(spark, f"{tmp_path}/nowhere")


def test_repeated_and_missing_ids(spark, tmp_path):
    rows = [(5, "a"), (5, "b"), (5, "c"), (None, "d"), (7, "e")]
    paper_store.save_papers(spark.createDataFrame(rows, "paper_id int, title string"), f"{tmp_path}/p", rows_per_file=1)
    stored = paper_store.load_papers(spark, f"{tmp_path}/p")
    assert sorted(r["title"] for r in stored.fetch([5]).collect()) == ["a", "b", "c"] and len(stored) == 4


# ---- the centroid tree


@pytest.mark.parametrize("group_bytes", [1, 1 << 20])
def test_every_vector_is_in_the_nearest_leaf_of_its_nearest_branch(embeddings, matrix, group_bytes):
    index = centroid_tree.build_tree(embeddings, 4, 5, nprobe=20, beam=4, group_bytes=group_bytes, iterations=3)
    assert index.tree.groups == (4 if group_bytes == 1 else 1)
    leaves = {}
    for r in index.tree.leaves.collect():
        leaves.setdefault(r["branch"], []).append((r["list_id"], r["centroid"]))
    stored = {r["paper_id"]: r["list_id"] for r in index.postings.collect()}
    assert sorted(stored) == list(range(400)) and index.postings.count() == 400
    for i, x in enumerate(matrix.astype(float)):
        x = x / np.linalg.norm(x)
        branch = int(np.argmax(np.round(index.tree.root @ x, 6)))
        own = sorted(leaves[branch])
        assert stored[i] == own[int(np.argmax(np.round(np.array([c for _, c in own]) @ x, 6)))][0]


def test_probing_every_leaf_is_exact_and_recall_grows(embeddings, matrix):
    index = centroid_tree.build_tree(embeddings, 4, 4, nprobe=4, beam=4, iterations=3, group_bytes=1)
    queries, exact = asked(embeddings, list(range(0, 400, 4))), brute(range(0, 400, 4), matrix, 10)
    found = []
    for nprobe in (1, 4, 16):
        got = as_dict(centroid_tree.search_tree(queries, index, nprobe=nprobe))
        found.append(sum(len({i for i, _ in got[q]} & {i for i, _ in exact[q]}) for q in exact))
        if nprobe == 16:
            assert got == exact
    assert found[0] <= found[1] <= found[2] == 1000


def test_a_tree_bears_copies_zero_vectors_and_more_branches_than_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(100, [0.0, 0.0]), (101, [0.0, 1.0]), (102, None)]
    vectors = spark.createDataFrame(rows, "paper_id bigint, embedding array<float>")
    index = centroid_tree.build_tree(vectors, 40, 3, nprobe=2, beam=2, iterations=2)
    assert sorted(r["paper_id"] for r in index.postings.collect()) == [*range(30), 101]
    hits = centroid_tree.search_tree(vectors.where("paper_id = 101").withColumnRenamed("paper_id", "query_id"), index, k=1)
    assert [r["paper_id"] for r in hits.collect()] == [101]
    with pytest.raises(ValueError, match="exceed"):
        centroid_tree.train_root(vectors, 1 << 40, 2)


def test_more_lists_than_one_matrix_may_hold(spark, monkeypatch):
    """Groups of one branch: no step sees more centroids than those of a branch."""
    seen = []
    whole = centroid_tree.CentroidTree.group_leaves
    monkeypatch.setattr(centroid_tree.CentroidTree, "group_leaves", lambda tree, g: (lambda found: (seen.append(len(found)), found)[1])(whole(tree, g)))
    x = unit_vectors(200, 8, 3)
    vectors = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "paper_id bigint, embedding array<float>")
    index = centroid_tree.build_tree(vectors, 6, 4, nprobe=24, beam=6, iterations=2, group_bytes=1)
    assert index.postings.count() == 200 and seen and max(seen) == 1


# ---- drawn positions


def test_slices_of_a_hot_subject_stay_small_and_only_drawn_ones_are_ranked(spark):
    i = F.col("id")
    rows = spark.range(60_000).select(i.alias("paper_id"), F.when(i < 40_000, "hot").otherwise(F.concat(F.lit("s"), i % 50)).alias("primary_subject"))
    index = index_subjects(rows, 3)
    sizes = index.slices.agg(F.max("rows"), F.sum("rows")).first()
    assert sizes[0] <= 400 and sizes[1] == 60_000
    every = {r["pos"]: r["paper_id"] for r in index.positions.collect()}
    assert sorted(every) == list(range(60_000)) and len(set(every.values())) == 60_000
    wanted = [0, 17, 39_999, 40_000, 59_999]
    for few in (True, False):
        got = index.rows_at(spark.createDataFrame([(w,) for w in [*wanted, 17]], "pos bigint"), few)
        found = {r["pos"]: r["paper_id"] for r in got.collect()}
        assert len(found) <= len(wanted) * 400 and all(found[w] == every[w] for w in wanted)
        assert max(n for n in rows_of(got, "BroadcastHashJoin" if few else "SortMergeJoin") + [0] if n is not None) <= 60_000


# ---- the pair stream


def test_epochs_go_on_where_a_stopped_stream_ended(spark, papers, tmp_path):
    config = pairs.PairConfig(num_pairs=40, seed=5)
    drawn = []

    def counting(source, cfg, index=None):
        drawn.append(cfg.epoch)
        return pairs.positive_pairs(source, cfg, index)

    for last in (1, 2, 2):
        query = start_pairs(papers, config, f"{tmp_path}/out", f"{tmp_path}/checkpoint", counting, last=last)
        query.processAllAvailable()
        query.stop()
    assert drawn == [0, 1, 2]
    for epoch in range(3):
        batch = pairs.positive_pairs(papers, replace(config, epoch=epoch))
        stored = spark.read.parquet(f"{tmp_path}/out/epoch={epoch}").select(batch.columns)
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, batch.collect()))


def test_epochs_are_stored_in_the_smaller_codec(papers, tmp_path):
    query = start_pairs(papers, pairs.PairConfig(num_pairs=20, seed=5), f"{tmp_path}/out", f"{tmp_path}/checkpoint", last=0)
    query.processAllAvailable()
    query.stop()
    files = [pq.ParquetFile(f).metadata for f in tmp_path.glob("out/epoch=0/*.parquet")]
    assert sum(f.num_rows for f in files) == 20
    assert {f.row_group(g).column(c).compression for f in files for g in range(f.num_row_groups) for c in range(f.num_columns)} == {"ZSTD"}


def _exchange_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = (blocks.apply(i).toString() for i in range(blocks.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_an_epoch_leaves_no_exchange_behind(spark, papers, tmp_path):
    before, made = [], []

    def watched(source, cfg, index=None):
        before.append(_exchange_files(spark))
        made.append(pairs.positive_pairs(source, cfg, index))  # held, as a driver that collects no garbage would
        return made[-1]

    query = start_pairs(papers, pairs.PairConfig(num_pairs=300, seed=5), f"{tmp_path}/out", f"{tmp_path}/checkpoint", watched, last=2)
    query.processAllAvailable()
    query.stop()
    for _ in range(50):  # files are removed a moment later
        if not (left := _exchange_files(spark) - before[0]):
            break
        time.sleep(0.2)
    assert len(made) == 3 and not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_an_epoch_in_parts_is_seen_when_it_is_whole(spark, papers, tmp_path, monkeypatch):
    config = pairs.PairConfig(num_pairs=300, seed=5)
    whole, attached = pairs._attach, []

    def attach(*args):
        attached.append(args)
        if len(attached) == 2:
            raise RuntimeError("lost after the first part")
        return whole(*args)

    monkeypatch.setattr(pairs, "MIN_PART_PAIRS", 100)
    monkeypatch.setattr(pairs, "_attach", attach)
    query = start_pairs(papers, config, f"{tmp_path}/out", f"{tmp_path}/checkpoint", last=1)
    with pytest.raises(StreamingQueryException, match="lost after"):
        query.processAllAvailable()
    assert not list(tmp_path.glob("out/epoch=*")) and len(attached) == 2
    query = start_pairs(papers, config, f"{tmp_path}/out", f"{tmp_path}/checkpoint", last=1)
    query.processAllAvailable()
    query.stop()
    assert sorted(p.name for p in tmp_path.glob("out/*")) == ["epoch=0", "epoch=1"] and len(attached) >= 6
    monkeypatch.undo()
    for epoch in (0, 1):
        batch = pairs.positive_pairs(papers, replace(config, epoch=epoch))
        assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out/epoch={epoch}").collect())) == sorted(map(tuple, batch.collect()))


def test_the_reader_advances_one_epoch_and_replays_any_range():
    reader = EpochReader(0, 4)
    rows, end = reader.read({"epoch": 3})
    assert list(rows) == [(3,)] and end == {"epoch": 4}
    rows, end = reader.read({"epoch": 5})
    assert list(rows) == [] and end == {"epoch": 5}
    assert list(reader.readBetweenOffsets({"epoch": 1}, {"epoch": 4})) == [(1,), (2,), (3,)]
