"""Queries over stored vectors: scores, search, evaluation, losses."""

from __future__ import annotations

import functools
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.functions import vectors as vec
from simsearch.operators import classify, ivf, losses, pairs, project, relevance, sampling
from simsearch.operators.cutoff import mark_smallest
from simsearch.operators.skew import join_group
from simsearch.operators.topk import SearchLimits, exact_topk
from simsearch.plans import evaluation
from simsearch.registry import sql as q
from simsearch.session import checkpoint
from simsearch.sources.tables import documents_as_papers, vectors_as_papers

SEED = 42
SAMPLE = evaluation.DEFAULT_SAMPLE
PER_SUBJECT = 50
NPROBE = 3
RECALL_PROBES = (1, 3, 1000)  # the last asks for every list
BATCH = 32
MIN_POINTS = 50
POINTS = 200


def papers(spark, folder):
    return vectors_as_papers(spark, folder)


def _mean_index(source, nprobe=NPROBE):
    """An index whose centroids are the label means, which SQL can compute too."""
    return ivf.build_index(source, nprobe=nprobe, centroids=ivf.mean_centroids(source, "label"))


def _roles(source):
    """The evaluation's query sample; every other sampled vector is the corpus."""
    return sampling.ir_sample(source, SAMPLE, SEED, "actual")


def _requests(source):
    """A fifth of the table as queries, and every other vector."""
    count = {"_asked": lambda n: F.floor(n / 5)}
    marked = mark_smallest(source, "paper_id", (SEED, "ir"), count)
    asked = marked.where("_asked").select(F.col("paper_id").alias("query_id"), "embedding")
    return asked, marked.where(~F.col("_asked")).drop("_asked")


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def l2_normalize(spark, folder):
    scaled = F.transform(vec.as_double(F.col("embedding")), lambda x: x * (F.col("label") + 1))
    unit = papers(spark, folder).select("paper_id", F.posexplode(vec.l2_normalize(scaled)).alias("pos", "x"))
    return unit.select("paper_id", "pos", F.round("x", 6).alias("value"))


def embedding_stats(spark, folder):
    return papers(spark, folder).agg(
        F.count("*").alias("n_vectors"),
        F.min(F.size("embedding")).alias("min_dim"),
        F.max(F.size("embedding")).alias("max_dim"),
        F.round(F.min(vec.norm(F.col("embedding"))), 5).alias("min_norm"),
        F.round(F.max(vec.norm(F.col("embedding"))), 5).alias("max_norm"),
    )


def cosine_scores(spark, folder):
    source = papers(spark, folder).withColumnRenamed("label", "list_id")
    scored = join_group(source, ivf.mean_centroids(source, "list_id"), "list_id", "n_vectors")
    return scored.select("paper_id", "list_id", F.round(vec.cosine(F.col("embedding"), F.col("centroid")), 6).alias("score"))


def exact_knn(spark, folder):
    source = papers(spark, folder)
    queries, others = _requests(source)
    return exact_topk(queries, others, ivf.embedding_dim(source))


def ivf_assign(spark, folder):
    return _mean_index(papers(spark, folder)).postings.select("paper_id", "list_id")


def ivf_list_sizes(spark, folder):
    return ivf.list_sizes(_mean_index(papers(spark, folder)))


def ivf_search(spark, folder):
    source = papers(spark, folder)
    queries, _ = _requests(source)
    return ivf.search(queries, _mean_index(source))


def ivf_search_joined(spark, folder):
    """The search of ``ivf_search`` with queries of about four blocks, which meet the postings by list, in parts of 40 vectors."""
    source = papers(spark, folder)
    queries, _ = _requests(source)
    index = _mean_index(source)
    block = (8 * index.dim + 8 * NPROBE + 200) * max(1, queries.count() // 4)
    return ivf.search(queries, replace(index, limits=SearchLimits(block_bytes=block, most_scans=1, part_rows=40)))


def ivf_recall(spark, folder):
    """Of the ten nearest vectors of each query, how many the index finds, by the number of lists probed."""
    source = papers(spark, folder)
    queries, _ = _requests(source)
    queries, index = checkpoint(queries), _mean_index(source)
    wanted = checkpoint(exact_topk(queries, source, index.dim))
    found = [ivf.search(queries, index, nprobe=n).select(F.lit(n).alias("nprobe"), "query_id", "paper_id") for n in RECALL_PROBES]
    hits = functools.reduce(DataFrame.unionByName, found).join(wanted.select("query_id", "paper_id"), ["query_id", "paper_id"])
    return hits.groupBy("nprobe").agg(F.round(F.count("*") / wanted.count(), 6).alias("recall_at_10"))


def search_with_metadata(spark, folder):
    hits = ivf_search(spark, folder)
    return ivf.hydrate(hits, documents_as_papers(spark, folder)).select(
        "query_id", "rank", "score", "paper_id", "title", "primary_subject"
    )


def index_subjects(spark, folder):
    return papers(spark, folder).select("paper_id", "primary_subject")


def index_metadata_mismatch(spark, folder):
    return ivf.size_mismatch(papers(spark, folder), documents_as_papers(spark, folder))


def reconstruct_sample(spark, folder):
    source = papers(spark, folder)
    sample = sampling.stratified_sample(source.select("paper_id", "primary_subject"), POINTS, SEED)
    found = ivf.fetch_vectors(source.select("paper_id", "embedding"), sample)
    return found.select("paper_id", F.posexplode("embedding").alias("pos", "x")).select(
        "paper_id", "pos", F.round(F.col("x").cast("double"), 6).alias("value")
    )


def _points(spark, folder):
    """The first two components stand in for stored coordinates."""
    e = vec.as_double(F.col("embedding"))
    return papers(spark, folder).select("paper_id", "primary_subject", e[0].alias("x"), e[1].alias("y"))


def subject_centroids(spark, folder):
    return _rounded(project.subject_centroids(_points(spark, folder), MIN_POINTS), "x", "y")


def draw_order(spark, folder):
    return project.draw_order(_points(spark, folder))


def plot_extent(spark, folder):
    return _rounded(project.plot_extent(_points(spark, folder)), "x_min", "x_max", "y_min", "y_max")


def ir_sample(spark, folder):
    return _roles(papers(spark, folder)).select("paper_id", "primary_subject", "role")


def stratified_ir_split(spark, folder):
    source = papers(spark, folder).select("paper_id", "primary_subject")
    return sampling.stratified_ir_split(source, PER_SUBJECT, SEED)


def qrels_counts(spark, folder):
    source = papers(spark, folder).select("paper_id", "primary_subject")
    queries, corpus = evaluation.roles(_roles(source))
    return relevance.qrels_counts(queries, corpus)


def ir_metrics(spark, folder):
    return _rounded(evaluation.evaluate(papers(spark, folder), SAMPLE, SEED, "actual"), "value")


def subject_metrics(spark, folder):
    report = evaluation.evaluate_per_subject(papers(spark, folder), PER_SUBJECT, SEED)
    return _rounded(report, "p_at_10", "r_at_10", "mrr", "ndcg_at_10")


def metric_delta(spark, folder):
    """Exact search against the index with one list per query."""
    queries, corpus = evaluation.roles(checkpoint(_roles(papers(spark, folder))))
    index = _mean_index(corpus, nprobe=1)

    def metrics(used):
        return relevance.mean_metrics(relevance.query_metrics(evaluation.judged_search(queries, corpus, 10, used)))

    return _rounded(relevance.metric_delta(metrics(None), metrics(index)), "before", "after", "delta")


def _contrastive(spark, folder):
    source = papers(spark, folder)
    count = source.count()
    ids = pairs.contrastive_pair_ids(source, pairs.PairConfig(num_pairs=count, seed=SEED))
    return losses.pair_distances(losses.pair_vectors(ids, source, count))


def contrastive_loss(spark, folder):
    return _rounded(losses.contrastive_loss(_contrastive(spark, folder)), "loss")


def hard_pairs(spark, folder):
    return _rounded(losses.hard_pairs(_contrastive(spark, folder), BATCH), "distance")


def in_batch_loss(spark, folder):
    source = papers(spark, folder)
    count = source.count()
    ids = pairs.positive_pair_ids(source, pairs.PairConfig(num_pairs=count, seed=SEED))
    return _rounded(losses.in_batch_loss(losses.pair_vectors(ids, source, count), BATCH), "loss")


def _centroid_predictions(spark, folder):
    source = papers(spark, folder)
    given = _mean_index(source).postings.select("paper_id", F.col("list_id").alias("predicted"))
    return source.select("paper_id", "label").join(given, "paper_id")


def confusion_counts(spark, folder):
    return classify.confusion(_centroid_predictions(spark, folder))


def classification_report(spark, folder):
    report = classify.classification_report(confusion_counts(spark, folder))
    return _rounded(report, "precision", "recall", "f1").drop("hits")


def classification_summary(spark, folder):
    report = classify.classification_report(confusion_counts(spark, folder))
    return _rounded(classify.summary(report), "accuracy", "macro_f1")


QUERIES = {
    f.__name__: f
    for f in (
        l2_normalize, embedding_stats, cosine_scores, exact_knn, ivf_assign, ivf_list_sizes, ivf_search,
        ivf_search_joined, ivf_recall, search_with_metadata, index_subjects, index_metadata_mismatch, reconstruct_sample, subject_centroids,
        draw_order, plot_extent, ir_sample, stratified_ir_split, qrels_counts, ir_metrics, subject_metrics,
        metric_delta, contrastive_loss, hard_pairs, in_batch_loss, confusion_counts, classification_report,
        classification_summary,
    )
}

_V = q.VECTORS
_ROLES = q.sample_roles(SAMPLE, "actual")
_REQUESTS = q.request_roles()
_INDEX = f"{q.centroids('papers', 'label')},\n{q.assigned('papers')}"
_ASKED = "asked AS (SELECT paper_id AS query_id, embedding FROM roles WHERE role = 'query')"
_IVF = q.with_(_V, _REQUESTS, _ASKED, _INDEX, q.ivf_hits("asked", "10", str(NPROBE)))
_POINTS = """points AS (SELECT paper_id, primary_subject, embedding[1] AS x, embedding[2] AS y FROM papers)"""
_CORPUS_INDEX = f"""corpus AS (SELECT * FROM roles WHERE role = 'corpus'),
{q.centroids('corpus', 'label')},
{q.assigned('corpus')}"""
_DISTANCES = f"""{q.contrastive_ids()},
distances AS (
  SELECT pair_id, b.label, 1 - list_inner_product(x.embedding, y.embedding)
    / (sqrt(list_inner_product(x.embedding, x.embedding)) * sqrt(list_inner_product(y.embedding, y.embedding))) AS distance
  FROM (SELECT pair_id, id1, id2, label FROM both_ids) b
  JOIN papers x ON x.paper_id = id1 JOIN papers y ON y.paper_id = id2)"""
_CONFUSION = f"""{_INDEX},
confusion AS (
  SELECT p.label::VARCHAR AS label, a.list_id::VARCHAR AS predicted, count(*) AS n
  FROM papers p JOIN assigned a USING (paper_id) GROUP BY ALL),
per_class AS (
  SELECT label, sum(actual) AS support, sum(given) AS given, sum(hit) AS hits FROM (
    SELECT label, n AS actual, 0 AS given, CASE WHEN label = predicted THEN n ELSE 0 END AS hit FROM confusion
    UNION ALL SELECT predicted, 0, n, 0 FROM confusion) GROUP BY label),
scored AS (
  SELECT label, CASE WHEN given > 0 THEN hits::DOUBLE / given ELSE 0 END AS precision,
         CASE WHEN support > 0 THEN hits::DOUBLE / support ELSE 0 END AS recall,
         support::BIGINT AS support, hits::BIGINT AS hits FROM per_class),
report AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
  FROM scored)"""

ORACLE = {
    "l2_normalize": q.with_(
        _V,
        "scaled AS (SELECT paper_id, [x * (label + 1) FOR x IN embedding] AS e FROM papers)",
        "lens AS (SELECT paper_id, e, sqrt(list_inner_product(e, e)) AS len FROM scaled)",
    )
    + """SELECT paper_id, (i - 1)::INTEGER AS pos, round(e[i] / len, 6) AS value
FROM (SELECT *, unnest(range(1, len(e) + 1)) AS i FROM lens)""",
    "embedding_stats": q.with_(_V)
    + """SELECT count(*) AS n_vectors, min(len(embedding))::INTEGER AS min_dim, max(len(embedding))::INTEGER AS max_dim,
  round(min(sqrt(list_inner_product(embedding, embedding))), 5) AS min_norm,
  round(max(sqrt(list_inner_product(embedding, embedding))), 5) AS max_norm FROM papers""",
    "cosine_scores": q.with_(_V, q.centroids("papers", "label"))
    + """SELECT paper_id, list_id, round(list_inner_product(embedding, centroid)
  / (sqrt(list_inner_product(embedding, embedding)) * sqrt(list_inner_product(centroid, centroid))), 6) AS score
FROM papers JOIN cent ON list_id = label""",
    "exact_knn": q.with_(_V, _REQUESTS, q.exact_hits()) + "SELECT query_id, rank, score, paper_id FROM hits",
    "ivf_assign": q.with_(_V, _INDEX) + "SELECT paper_id, list_id FROM assigned",
    "ivf_list_sizes": q.with_(_V, _INDEX)
    + """SELECT list_id, count(a.paper_id) AS n_vectors FROM cent LEFT JOIN assigned a USING (list_id) GROUP BY list_id""",
    "ivf_search": _IVF + "SELECT query_id, rank, score, paper_id FROM hits",
    "ivf_search_joined": _IVF + "SELECT query_id, rank, score, paper_id FROM hits",
    "ivf_recall": q.with_(
        _V, _REQUESTS, _ASKED, _INDEX,
        f"""probed AS (SELECT query_id, embedding, list_id, nth FROM (
    SELECT q.*, c.list_id, row_number() OVER (PARTITION BY q.query_id ORDER BY round(list_inner_product(q.embedding, c.centroid), 6) DESC, c.list_id) AS nth
    FROM asked q CROSS JOIN cent c))""",
        """scored AS (SELECT query_id, nth, paper_id, round(list_cosine_similarity(p.embedding, a.embedding), 6) AS score
    FROM probed p JOIN assigned a USING (list_id))""",
        f"probes AS (SELECT unnest([{', '.join(map(str, RECALL_PROBES))}])::INTEGER AS nprobe)",
        """found AS (SELECT nprobe, query_id, paper_id, row_number() OVER (PARTITION BY nprobe, query_id ORDER BY score DESC, paper_id) AS rank
    FROM scored JOIN probes ON nth <= nprobe)""",
        "exact AS (SELECT query_id, paper_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, paper_id) AS rank FROM scored)",
    )
    + """SELECT nprobe, round(count(*) / (SELECT count(*) FROM exact WHERE rank <= 10), 6) AS recall_at_10
FROM found JOIN exact USING (query_id, paper_id) WHERE found.rank <= 10 AND exact.rank <= 10 GROUP BY nprobe""",
    "search_with_metadata": _IVF
    + """SELECT query_id, rank, score, paper_id, split_part(text, chr(10), 1) AS title,
  source || ' (' || lang || ')' AS primary_subject FROM hits JOIN documents ON doc_id = paper_id""",
    "index_subjects": q.with_(_V) + "SELECT paper_id, primary_subject FROM papers",
    "index_metadata_mismatch": """WITH per_id AS (
  SELECT id, sum(v) AS v, sum(p) AS p FROM (
    SELECT vec_id AS id, 1 AS v, 0 AS p FROM embeddings UNION ALL SELECT doc_id, 0, 1 FROM documents) GROUP BY id)
SELECT count(*) FILTER (v > 0 AND p = 0) AS vectors_without_paper,
  count(*) FILTER (p > 0 AND v = 0) AS papers_without_vector,
  count(*) FILTER (v > 1 OR p > 1) AS duplicate_ids FROM per_id""",
    "reconstruct_sample": q.with_(_V, q.stratified_sample(POINTS))
    + """SELECT paper_id, (i - 1)::INTEGER AS pos, round(embedding[i], 6) AS value
FROM (SELECT paper_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM sampled)""",
    "subject_centroids": q.with_(_V, _POINTS)
    + f"""SELECT primary_subject, count(*) AS n_points, round(avg(x), 6) AS x, round(avg(y), 6) AS y
FROM points GROUP BY 1 HAVING count(*) >= {MIN_POINTS}""",
    "draw_order": q.with_(_V)
    + "SELECT primary_subject, count(*) AS n_points FROM papers GROUP BY 1 ORDER BY 2 DESC, 1",
    "plot_extent": q.with_(_V, _POINTS)
    + """SELECT round(min(x) - (max(x) - min(x)) * 0.02::DOUBLE, 6) AS x_min,
  round(max(x) + (max(x) - min(x)) * 0.02::DOUBLE, 6) AS x_max,
  round(min(y) - (max(y) - min(y)) * 0.02::DOUBLE, 6) AS y_min,
  round(max(y) + (max(y) - min(y)) * 0.02::DOUBLE, 6) AS y_max FROM points""",
    "ir_sample": q.with_(_V, _ROLES) + "SELECT paper_id, primary_subject, role FROM roles",
    "stratified_ir_split": q.with_(_V, q.capped_roles(PER_SUBJECT)) + "SELECT paper_id, primary_subject, role FROM roles",
    "qrels_counts": q.with_(_V, _ROLES, q.QRELS) + "SELECT query_id, subject, n_rel FROM qrels",
    "ir_metrics": q.with_(_V, _ROLES, q.QRELS, q.exact_hits(100), q.query_metrics())
    + f"SELECT metric, round(value, 6) AS value FROM ({q.metric_rows('per_query')})",
    "subject_metrics": q.with_(_V, q.capped_roles(PER_SUBJECT), q.QRELS, q.exact_hits(10), q.query_metrics())
    + """SELECT subject, count(*) AS n_queries, round(avg("precision@10"), 6) AS p_at_10,
  round(avg("recall@10"), 6) AS r_at_10, round(avg("mrr@10"), 6) AS mrr, round(avg("ndcg@10"), 6) AS ndcg_at_10
FROM per_query GROUP BY subject ORDER BY ndcg_at_10 DESC, subject""",
    "metric_delta": q.with_(
        _V, _ROLES, q.QRELS, q.exact_hits(10).replace("hits AS", "exact_hits AS"), q.query_metrics("exact_hits", "exact"),
        _CORPUS_INDEX, _ASKED, q.ivf_hits("asked", "10", "1"), q.query_metrics("hits", "listed"),
        f"before AS ({q.metric_rows('exact')})", f"after AS ({q.metric_rows('listed')})",
    )
    + """SELECT metric, round(b.value, 6) AS before, round(a.value, 6) AS after, round(a.value - b.value, 6) AS delta
FROM before b JOIN after a USING (metric) WHERE metric LIKE '%precision%' OR metric LIKE '%ndcg%'""",
    "contrastive_loss": q.with_(_V, _DISTANCES)
    + """SELECT count(*) AS n_pairs, round(avg(0.5::DOUBLE * (label * distance * distance
  + (1 - label) * greatest(0, 0.5::DOUBLE - distance) * greatest(0, 0.5::DOUBLE - distance))), 6) AS loss FROM distances""",
    "hard_pairs": q.with_(
        _V,
        _DISTANCES,
        f"""batched AS (
  SELECT *, pair_id // {BATCH} AS batch,
    count(*) FILTER (label = 1) OVER w AS n_pos, count(*) FILTER (label = 0) OVER w AS n_neg,
    max(distance) FILTER (label = 1) OVER w AS far, avg(distance) FILTER (label = 0) OVER w AS neg_mean,
    min(distance) FILTER (label = 0) OVER w AS near, avg(distance) FILTER (label = 1) OVER w AS pos_mean
  FROM distances WINDOW w AS (PARTITION BY pair_id // {BATCH}))""",
    )
    + """SELECT batch, pair_id, label, round(distance, 6) AS distance FROM batched
WHERE (label = 0 AND distance < CASE WHEN n_pos > 1 THEN far ELSE neg_mean END)
   OR (label = 1 AND distance > CASE WHEN n_neg > 1 THEN near ELSE pos_mean END)""",
    "in_batch_loss": q.with_(
        _V,
        q.positive_ids(True),
        f"""sides AS (
  SELECT pair_id, pair_id // {BATCH} AS batch, x.embedding AS a, y.embedding AS p
  FROM same JOIN positions x ON x.pos = pos1 JOIN positions y ON y.pos = pos2)""",
        """scores AS (
  SELECT i.pair_id AS i, j.pair_id AS j, 20 * list_inner_product(i.a, j.p)
    / (sqrt(list_inner_product(i.a, i.a)) * sqrt(list_inner_product(j.p, j.p))) AS s
  FROM sides i JOIN sides j USING (batch))""",
        "tops AS (SELECT i, max(s) AS top FROM scores GROUP BY i)",
    )
    + """SELECT count(*) AS n_pairs, round(avg(loss), 6) AS loss FROM (
  SELECT i, ln(sum(exp(s - top))) + max(top) - max(s) FILTER (i = j) AS loss FROM scores JOIN tops USING (i) GROUP BY i)""",
    "confusion_counts": q.with_(_V, _CONFUSION) + "SELECT label, predicted, n FROM confusion",
    "classification_report": q.with_(_V, _CONFUSION)
    + "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report",
    "classification_summary": q.with_(_V, _CONFUSION)
    + "SELECT round(sum(hits)::DOUBLE / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1 FROM report",
}
