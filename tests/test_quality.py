import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from simsearch.operators import classify, losses, project
from simsearch.operators import relevance as rel
from simsearch.plans import evaluation, landscape


@pytest.fixture(scope="module")
def labelled(spark, embeddings):
    return embeddings.withColumn("primary_subject", F.concat(F.lit("s"), F.col("paper_id") % 4))


def by_hand(ranks, n_rel):
    """All metrics of one query from the ranks of its relevant hits."""
    out = {f"accuracy@{k}": float(any(r <= k for r in ranks)) for k in (1, 3, 5, 10)}
    out |= {f"precision@{k}": sum(r <= k for r in ranks) / k for k in (1, 5, 10)}
    out |= {f"recall@{k}": sum(r <= k for r in ranks) / n_rel for k in (1, 5, 10)}
    first = min(ranks, default=99)
    out["mrr@10"] = 1 / first if first <= 10 else 0.0
    ideal = sum(1 / math.log2(r + 1) for r in range(1, min(n_rel, 10) + 1))
    out["ndcg@10"] = sum(1 / math.log2(r + 1) for r in ranks if r <= 10) / ideal
    out["map@100"] = sum((i + 1) / r for i, r in enumerate(sorted(ranks)) if r <= 100) / min(n_rel, 100)
    return out


def test_metrics_of_known_rankings(spark):
    cases = {1: ([1, 3, 12], 5), 2: ([], 2), 3: ([2], 1), 4: (list(range(1, 101)), 300), 5: ([11], 4)}
    hits, corpus, queries = [], [(0, "none")], []
    for q, (ranks, n_rel) in cases.items():
        queries.append((q, f"s{q}", n_rel))
        for rank in range(1, 101):
            doc = q * 1000 + rank
            hits.append((q, rank, 1.0 - rank / 200, doc))
            corpus.append((doc, f"s{q}" if rank in ranks else "other"))
    judged = rel.judge(
        spark.createDataFrame(hits, "query_id bigint, rank int, score double, paper_id bigint"),
        spark.createDataFrame(queries, "query_id bigint, subject string, n_rel bigint"),
        spark.createDataFrame(corpus, "paper_id bigint, primary_subject string"),
    )
    got = rel.query_metrics(judged)
    for row in got.collect():
        expected = by_hand(*cases[row["query_id"]])
        assert {k: row[k] for k in expected} == pytest.approx(expected)
    means = {r["metric"]: r["value"] for r in rel.mean_metrics(got).collect()}
    assert means["mrr@10"] == pytest.approx(np.mean([by_hand(*c)["mrr@10"] for c in cases.values()]))


def test_queries_without_hits_count_as_zero(spark):
    none = spark.createDataFrame([], "query_id bigint, rank int, score double, paper_id bigint")
    queries = spark.createDataFrame([(1, "a", 3)], "query_id bigint, subject string, n_rel bigint")
    corpus = spark.createDataFrame([(9, "a")], "paper_id bigint, primary_subject string")
    row = rel.query_metrics(rel.judge(none, queries, corpus)).first().asDict()
    assert row.pop("query_id") == 1 and row.pop("subject") == "a" and set(row.values()) == {0.0}


def test_queries_without_a_relevant_paper_drop_out(spark):
    queries = spark.createDataFrame([(1, "a"), (2, "b")], "query_id bigint, primary_subject string")
    corpus = spark.createDataFrame([(5, "a"), (6, "a"), (7, "c")], "paper_id bigint, primary_subject string")
    assert [tuple(r) for r in rel.qrels_counts(queries, corpus).collect()] == [(1, "a", 2)]


def test_evaluation_of_perfect_and_of_random_labels(embeddings, labelled):
    same = labelled.withColumn("primary_subject", F.lit("one"))
    perfect = {r["metric"]: r["value"] for r in evaluation.evaluate(same, 200, 1, "actual").collect()}
    assert perfect["precision@10"] == perfect["ndcg@10"] == perfect["map@100"] == 1.0
    random = {r["metric"]: r["value"] for r in evaluation.evaluate(labelled, 400, 1, "actual").collect()}
    assert 0 < random["precision@10"] < 0.6 and len(random) == 13


def test_report_per_subject_is_sorted_and_complete(labelled):
    rows = evaluation.evaluate_per_subject(labelled, per_subject=20, seed=1).collect()
    assert {r["subject"] for r in rows} == {"s0", "s1", "s2", "s3"}
    assert all(r["n_queries"] == 4 for r in rows)
    values = [r["ndcg_at_10"] for r in rows]
    assert values == sorted(values, reverse=True)


def test_delta_keeps_precision_and_ndcg(spark):
    def table(x):
        rows = [("precision@1", x), ("ndcg@10", x / 2), ("recall@1", x)]
        return spark.createDataFrame(rows, "metric string, value double")

    got = {r["metric"]: r["delta"] for r in rel.metric_delta(table(0.2), table(0.6)).collect()}
    assert got == pytest.approx({"precision@1": 0.4, "ndcg@10": 0.2})


@pytest.fixture(scope="module")
def pair_table(spark, embeddings):
    rng = np.random.default_rng(5)
    rows = []
    for pair in range(70):
        for side, paper in ((1, rng.integers(400)), (2, rng.integers(400))):
            rows.append((pair, side, int(paper), float(pair % 3 == 0)))
    ids = spark.createDataFrame(rows, "pair_id bigint, side int, paper_id bigint, label double")
    return rows, losses.pair_vectors(ids, embeddings, 70)


def test_losses_equal_their_formulas(pair_table, matrix):
    rows, vectors = pair_table
    x = matrix.astype(float)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    a = np.array([r[2] for r in rows if r[1] == 1])
    b = np.array([r[2] for r in rows if r[1] == 2])
    y = np.array([r[3] for r in rows if r[1] == 1])
    d = 1 - (x[a] * x[b]).sum(axis=1)
    distances = losses.pair_distances(vectors)
    expected = np.mean(0.5 * (y * d**2 + (1 - y) * np.maximum(0, 0.5 - d) ** 2))
    assert losses.contrastive_loss(distances).first()["loss"] == pytest.approx(expected)

    total = []
    for start in range(0, 70, 32):
        s = 20 * x[a[start : start + 32]] @ x[b[start : start + 32]].T
        total += list(np.log(np.exp(s).sum(axis=1)) - np.diagonal(s))
    got = losses.in_batch_loss(vectors, 32).first()
    assert got["n_pairs"] == 70 and got["loss"] == pytest.approx(np.mean(total))

    hard = set()
    for start in range(0, 70, 32):
        i = np.arange(start, min(70, start + 32))
        pos, neg = d[i][y[i] == 1], d[i][y[i] == 0]
        hard |= {int(j) for j in i if (d[j] < pos.max() if y[j] == 0 else d[j] > neg.min())}
    assert {r["pair_id"] for r in losses.hard_pairs(distances, 32).collect()} == hard and hard


def test_projection_is_centred_on_the_widest_directions(embeddings, matrix):
    got = {r["paper_id"]: (r["x"], r["y"]) for r in project.project_2d(embeddings).collect()}
    xy = np.array([got[i] for i in range(400)])
    x = matrix.astype(float)
    variances = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert np.var(xy, axis=0, ddof=1) == pytest.approx(variances[:2], rel=1e-6)


def test_landscape_of_a_sample(spark, labelled):
    made = landscape.landscape(labelled, labelled.select("paper_id", "embedding"), 200, 1, min_points=40)
    points = made.points.collect()
    counts = Counter(r["primary_subject"] for r in points)
    assert 190 <= len(points) <= 200
    assert {r["primary_subject"]: r["n_points"] for r in made.order.collect()} == counts
    assert {r["primary_subject"] for r in made.labels.collect()} == {s for s, n in counts.items() if n >= 40}
    extent = made.extent.first()
    assert extent["x_min"] < min(r["x"] for r in points) and extent["y_max"] > max(r["y"] for r in points)


def test_classification_report_by_hand(spark):
    pairs = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")]
    predicted = spark.createDataFrame(pairs, "label string, predicted string")
    report = classify.classification_report(classify.confusion(predicted))
    got = {r["label"]: r for r in report.collect()}
    assert (got["a"]["precision"], got["a"]["recall"], got["a"]["support"]) == (5 / 6, 5 / 7, 7)
    assert (got["b"]["precision"], got["b"]["recall"]) == (3 / 5, 1.0)
    assert (got["c"]["precision"], got["c"]["recall"], got["c"]["f1"]) == (0.0, 0.0, 0.0)
    total = classify.summary(report).first()
    assert total["accuracy"] == 8 / 11


def test_classifiers_learn_what_separates_the_classes(spark):
    words = {0: "apple pear plum", 1: "gear wheel motor"}
    rows = [(i, f"{words[i % 2]} text {i}", i % 2) for i in range(60)]
    papers = spark.createDataFrame(rows, "paper_id bigint, abstract string, label int")
    model = classify.fit_on_text(papers, "label", num_features=256)
    report = classify.classification_report(classify.confusion(model.transform(papers)))
    assert classify.summary(report).first()["accuracy"] == 1.0


def test_tfidf_weights(spark):
    papers = spark.createDataFrame([(1, "a b b"), (2, "A c"), (3, "a")], "paper_id bigint, abstract string")
    got = defaultdict(dict)
    for r in classify.tfidf(papers).collect():
        got[r["paper_id"]][r["word"]] = (r["tf"], r["df"], r["weight"])
    assert got[1]["b"] == (2, 1, pytest.approx(2 * math.log(4 / 2)))
    assert got[2]["a"] == (1, 3, pytest.approx(0.0)) and set(got[3]) == {"a"}


def test_term_counts_hold_few_words_at_once(spark):
    import pyarrow as pa

    lists = [[f"w{i % 7}"] * 60_000 for i in range(12)] + [[], ["last"], ["w"] * 700_000, ["one"]]
    batch = pa.RecordBatch.from_pydict({"paper_id": list(range(16)), "words": lists})
    pieces = list(classify._pieces(batch))
    assert pa.Table.from_batches(pieces).equals(pa.Table.from_batches([batch])) and len(pieces) > 3
    sizes = [piece.column("words").value_lengths().to_pylist() for piece in pieces]
    assert all(sum(own) <= classify.PIECE_WORDS + max(own) for own in sizes)
    rows = [(i, f"common w{i} " * 30_000) for i in range(12)]
    papers = spark.createDataFrame(rows, "paper_id bigint, abstract string").coalesce(1)
    got = {(r["paper_id"], r["word"]): r["tf"] for r in classify.term_counts(papers).collect()}
    assert got == {(i, w): 30_000 for i in range(12) for w in ("common", f"w{i}")}


def test_no_test_row_is_lost_for_its_label(spark):
    rows = [(i, [float(i % 2), 1.0 - i % 2], "ab"[i % 2]) for i in range(20)]
    train = classify.features(spark.createDataFrame(rows, "paper_id bigint, embedding array<float>, label string"))
    odd = [(90, [1.0, 0.0], "b"), (91, [1.0, 0.0], "unseen"), (92, [0.0, 1.0], None)]
    test = classify.features(spark.createDataFrame(odd, "paper_id bigint, embedding array<float>, label string"))
    scored = classify.fit_on_embeddings(train, "label").transform(test)
    assert {r["paper_id"]: r["predicted"] for r in scored.collect()} == {90: "b", 91: "b", 92: "a"}
    assert classify.summary(classify.classification_report(classify.confusion(scored))).first()["accuracy"] == pytest.approx(1 / 3)
