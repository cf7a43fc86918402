import pytest
from pyspark.sql import functions as F

from simsearch.operators.encode import HashingEncoder
from simsearch.operators.ivf import list_sizes
from simsearch.operators.pairs import PairConfig, contrastive_pairs, positive_pairs
from simsearch.plans.indexing import index_splits
from simsearch.plans.preprocess import Prepared, PreprocessConfig, ensure_data
from simsearch.sources import store
from simsearch.sources.tables import count_unusable, read_papers
from simsearch.streaming.request_rates import start_rates
from simsearch.streaming.search_stream import start_search


def config(path, **changes):
    base = dict(source=str(path), number_of_pairs=100, number_of_eval_pairs=10, columns=("primary_subject", "abstract", "title"))
    return PreprocessConfig(**(base | changes))


@pytest.fixture(scope="module")
def source(papers, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "papers"
    papers.write.parquet(str(path))
    return path


@pytest.mark.parametrize("loss", ["ContrastiveLoss", "MultipleNegativesRankingLoss"])
def test_preprocessing_writes_splits_and_pairs(spark, source, tmp_path, loss):
    made = ensure_data(spark, str(tmp_path / "deep" / "er"), config(source, loss=loss))
    sizes = {s: store.read_split(spark, made.splits, s).count() for s in store.SPLITS}
    assert sizes == {"train": 640, "eval": 160, "test": 200}
    train = store.load_pairs(spark, made.train_pairs)
    assert train.count() == 100 and store.load_pairs(spark, made.eval_pairs).count() == 10
    assert ("label" in train.columns) == (loss == "ContrastiveLoss")
    ids = {r[0] for r in store.read_split(spark, made.splits, "train").select("paper_id").collect()}
    first = "id1" if loss == "ContrastiveLoss" else "anchor_id"
    assert {r[0] for r in train.select(first).collect()} <= ids


def test_data_is_rebuilt_only_when_needed(spark, source, tmp_path):
    base = str(tmp_path)
    first = ensure_data(spark, base, config(source))
    assert first.rebuilt
    again = ensure_data(spark, base, config(source))
    assert not again.rebuilt and again.root == first.root
    changed = ensure_data(spark, base, config(source, seed=99))
    assert changed.rebuilt and changed.root != first.root
    assert store.load_pairs(spark, first.train_pairs).count() == 100
    (tmp_path / "_manifest").rename(tmp_path / "gone")
    assert ensure_data(spark, base, config(source, seed=99)).rebuilt
    assert store.read_manifest(spark, f"{base}/_manifest")["config"]["seed"] == 99


def test_a_missing_output_is_rebuilt(spark, source, tmp_path):
    made = ensure_data(spark, str(tmp_path), config(source))
    (tmp_path / made.root.rsplit("/", 1)[1] / "eval_pairs").rename(tmp_path / "moved")
    assert ensure_data(spark, str(tmp_path), config(source)).rebuilt


def test_joined_subjects_become_lists(spark, papers, tmp_path):
    joined = papers.withColumn("subjects", F.concat_ws("; ", "subjects"))
    made = ensure_data(spark, str(tmp_path), config("given", columns=("primary_subject", "subjects", "abstract")), joined)
    row = store.read_split(spark, made.splits, "test").first()
    assert row["subjects"] == [row["primary_subject"], "General Science"]


def test_tables_are_brought_to_their_schema(spark):
    from simsearch.sources.tables import REQUESTS, conform

    asked = spark.createDataFrame([(1, "text", 5)], "query_id int, abstract string, k bigint")
    assert conform(asked, REQUESTS, optional=("nprobe",)).schema == REQUESTS
    with pytest.raises(ValueError, match="missing columns"):
        conform(asked.drop("abstract"), REQUESTS, optional=("nprobe",))


def test_unknown_loss_or_column_is_an_error(spark, source, tmp_path):
    with pytest.raises(ValueError, match="unsupported loss"):
        ensure_data(spark, str(tmp_path), config(source, loss="Other"))
    with pytest.raises(ValueError, match="missing columns"):
        ensure_data(spark, str(tmp_path), config(source, columns=("abstract", "nothing")))


def test_missing_tables_are_file_errors(spark, tmp_path):
    for read in (
        lambda: store.load_pairs(spark, str(tmp_path / "x")),
        lambda: store.read_split(spark, str(tmp_path / "x"), "train"),
        lambda: read_papers(spark, str(tmp_path / "x")),
    ):
        with pytest.raises(FileNotFoundError):
            read()


def test_cached_pairs_are_reused(spark, papers, tmp_path):
    path = str(tmp_path / "pairs")
    first = store.load_or_create_pairs(papers, positive_pairs, path, PairConfig(20, seed=1)).collect()
    assert store.load_or_create_pairs(papers, positive_pairs, path, PairConfig(20, seed=1)).collect() == first
    other = store.load_or_create_pairs(papers, positive_pairs, path, PairConfig(30, seed=2)).collect()
    assert len(other) == 30
    assert "label" in store.load_or_create_pairs(papers, contrastive_pairs, path, PairConfig(30, seed=2)).columns


def test_a_build_that_broke_off_is_made_again(spark, papers, tmp_path):
    path = str(tmp_path / "pairs")
    (tmp_path / "pairs" / "_temporary").mkdir(parents=True)
    (tmp_path / "pairs" / "_manifest" / "_temporary").mkdir(parents=True)
    assert not store.exists(spark, path)
    assert store.load_or_create_pairs(papers, positive_pairs, path, PairConfig(20, seed=1)).count() == 20


def test_missing_splits_are_skipped_unless_all_are(spark, papers, tmp_path, caplog):
    store.write_splits(papers.withColumn("split", F.lit("train")), str(tmp_path / "s"))
    assert store.read_splits(spark, str(tmp_path / "s"), ("train", "eval")).count() == 1000
    assert "eval" in caplog.text
    with pytest.raises(ValueError, match="none of the splits"):
        store.read_splits(spark, str(tmp_path / "s"), ("test",))


def test_reading_one_split_opens_only_its_files(spark, papers, tmp_path):
    store.write_splits(papers.withColumn("split", F.when(F.col("paper_id") < 10, "a").otherwise("b")), str(tmp_path / "s"))
    assert all("split=a" in f for f in store.read_split(spark, str(tmp_path / "s"), "a").inputFiles())


def test_rows_without_text_are_left_out_and_counted(spark, papers, tmp_path):
    holes = papers.withColumn("abstract", F.when(F.col("paper_id") % 10 > 0, F.col("abstract")))
    assert count_unusable(holes).first()["without_text"] == 100
    made = ensure_data(spark, str(tmp_path), config("given"), holes.select("paper_id", "primary_subject", "abstract", "title"))
    assert store.read_splits(spark, made.splits).count() == 900


def test_index_over_stored_splits(spark, source, tmp_path):
    made = ensure_data(spark, str(tmp_path / "data"), config(source))
    index = index_splits(spark, made.splits, str(tmp_path / "index"), HashingEncoder(16), ("train", "test"), nlist=4, nprobe=2)
    assert list_sizes(index).agg(F.sum("n_vectors")).first()[0] == 840
    assert isinstance(made, Prepared) and index.nprobe == 2


def test_streamed_search_equals_batch_search(spark, source, papers, tmp_path):
    from simsearch.plans.searching import search_requests
    from simsearch.sources.tables import REQUESTS

    made = ensure_data(spark, str(tmp_path / "data"), config(source))
    encoder = HashingEncoder(16)
    index = index_splits(spark, made.splits, str(tmp_path / "index"), encoder, nlist=4, nprobe=2)
    asked = papers.limit(30).select(
        F.col("paper_id").alias("query_id"),
        F.when(F.col("paper_id") % 7 > 0, F.col("abstract")).otherwise(" ").alias("abstract"),
        F.lit(4).alias("k"),
        F.lit(None).cast("int").alias("nprobe"),
    )
    asked.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(REQUESTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    start_search(stream, index, papers, encoder, out, str(tmp_path / "cp")).awaitTermination(120)

    def rows(df):
        return sorted((r["query_id"], r["rank"], r["paper_id"], r["score"]) for r in df.collect())

    batch = search_requests(asked, index, papers, encoder)
    assert rows(spark.read.parquet(f"{out}/hits")) == rows(batch.hits)
    assert spark.read.parquet(f"{out}/statuses").groupBy("status_code").count().count() == 2


def test_streamed_rates_equal_batch_rates_on_closed_windows(spark, tmp_path):
    from simsearch.operators.requests import rate_windows
    from simsearch.registry.service import events_as_log

    log = events_as_log(spark, "/root/testdata/sf0.001").drop("success")
    log.unionByName(log).repartition(1).sortWithinPartitions("ts").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "in"))
    start_rates(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    closed_by = log.agg(F.max("ts") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = rate_windows(log)
    assert got.exceptAll(batch).count() == 0
    assert batch.where(F.col("window_end") <= F.lit(closed_by)).exceptAll(got).count() == 0
    start_rates(stream, str(tmp_path / "o2"), str(tmp_path / "c2"), threshold=2).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "o2")).where("n <= 2").count() == 0
