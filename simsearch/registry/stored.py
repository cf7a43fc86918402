"""Queries over whole chains: stored tables read again, evaluation from texts, and what a fitted model must satisfy."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from simsearch.functions import vectors as vec
from simsearch.operators import centroid_tree, classify, ivf, pairs, project, relevance, sampling
from simsearch.operators.encode import HashingEncoder
from simsearch.operators.topk import SearchLimits, exact_topk
from simsearch.plans import evaluation
from simsearch.registry import corpus, vectors
from simsearch.registry import sql as q
from simsearch.session import checkpoint, shared_folder
from simsearch.sources import paper_store, store

SEED, SAMPLE, PER_SUBJECT, DIM = 42, evaluation.DEFAULT_SAMPLE, 10, 64
LISTS, MIN_POINTS = 16, 5
GRADIENT_LEFT = 0.02
TREE_BRANCHES, TREE_LEAVES, TREE_NPROBE = 4, 4, 12


def exact_knn_scaled(spark, folder):
    """Cosine on vectors of many lengths."""
    source = vectors.papers(spark, folder)
    scaled = F.transform(vec.as_double(F.col("embedding")), lambda x: x * (F.col("label") + 1)).cast("array<float>")
    queries, others = vectors._requests(source.withColumn("embedding", scaled))
    return exact_topk(queries, others, ivf.embedding_dim(source))


def search_own_k(spark, folder):
    """Every query asks for its own number of hits, from one to 37."""
    source = vectors.papers(spark, folder)
    queries, others = vectors._requests(source)
    asked = queries.withColumn("k", (F.col("query_id") % 37 + 1).cast("int"))
    return exact_topk(asked, others, ivf.embedding_dim(source))


def exact_knn_blocks(spark, folder):
    """The search of ``exact_knn`` with queries in about four blocks."""
    source = vectors.papers(spark, folder)
    queries, others = vectors._requests(source)
    dim = ivf.embedding_dim(source)
    limits = SearchLimits(block_bytes=(8 * dim + 200) * max(1, queries.count() // 4))
    return exact_topk(queries, others, dim, limits=limits)


def stored_index_search(spark, folder):
    """An index that was saved and loaded again."""
    source = vectors.papers(spark, folder)
    path = shared_folder(spark, "index")
    store.save_index(vectors._mean_index(source), path)
    return ivf.search(vectors._requests(source)[0], store.load_index(spark, path))


def _paper_store(spark, folder):
    """The documents as papers in 32 ranges at most, so that a lookup has something to leave out."""
    source = corpus.papers(spark, folder)
    path = shared_folder(spark, "papers")
    paper_store.save_papers(source, path, rows_per_file=max(1, source.count() // 32))
    return paper_store.load_papers(spark, path)


def paper_lookup(spark, folder):
    """The papers that a search found, fetched by id."""
    hits = vectors.ivf_search(spark, folder)
    return _paper_store(spark, folder).lookup(hits).select("paper_id", "title", "abstract", "primary_subject")


def paper_at(spark, folder):
    """The papers at every hundredth place, from the first to the last."""
    papers = _paper_store(spark, folder)
    last = len(papers) - 1
    return papers.rows_at(sorted({0, last, *range(0, last, 100)})).select("place", "paper_id", "title")


def search_with_stored_metadata(spark, folder):
    hits = ivf.hydrate(vectors.ivf_search(spark, folder), _paper_store(spark, folder))
    return hits.select("query_id", "rank", "score", "paper_id", "title", "primary_subject")


def stored_pairs(spark, folder):
    """Pairs of another configuration lie in the cache first; then the wanted ones are built, and read from there."""
    source = corpus.papers(spark, folder)
    path = shared_folder(spark, "pairs")
    wanted = pairs.PairConfig(num_pairs=source.count(), seed=SEED)
    store.load_or_create_pairs(source, pairs.positive_pairs, path, pairs.PairConfig(num_pairs=5, seed=SEED + 1))
    store.load_or_create_pairs(source, pairs.positive_pairs, path, wanted)
    return store.load_or_create_pairs(source, pairs.positive_pairs, path, wanted)


def text_ir_metrics(spark, folder):
    report = evaluation.evaluate_texts(corpus.papers(spark, folder), HashingEncoder(DIM), SAMPLE, SEED, "actual")
    return report.withColumn("value", F.round("value", 6))


def text_subject_metrics(spark, folder):
    report = evaluation.evaluate_texts_per_subject(corpus.papers(spark, folder), HashingEncoder(DIM), PER_SUBJECT, SEED)
    return report.withColumns({c: F.round(c, 6) for c in ("p_at_10", "r_at_10", "mrr", "ndcg_at_10")})


def text_metric_delta(spark, folder):
    """A smaller and a larger encoder on the same texts."""
    papers = corpus.papers(spark, folder)
    before, after = (evaluation.evaluate_texts(papers, HashingEncoder(dim), SAMPLE, SEED, "actual") for dim in (DIM // 2, DIM))
    return relevance.metric_delta(before, after).withColumns({c: F.round(c, 6) for c in ("before", "after", "delta")})


def landscape_labels(spark, folder):
    """Sample, fetch and label on stored coordinates."""
    points = checkpoint(vectors._points(spark, folder))
    sample = sampling.stratified_sample(points.select("paper_id", "primary_subject"), vectors.POINTS, SEED)
    found = points.join(sample.select("paper_id"), "paper_id", "left_semi")
    return project.subject_centroids(found, MIN_POINTS).withColumns({c: F.round(c, 6) for c in ("x", "y")})


def ivf_train(spark, folder):
    """What a trained index must satisfy: every vector stored once, in its nearest list, and centroids of unit length."""
    source = vectors.papers(spark, folder)
    index = ivf.build_index(source, nlist=LISTS, seed=SEED)
    postings = checkpoint(index.postings)
    centroids = {r["list_id"]: list(r["centroid"]) for r in index.centroids.collect()}
    scores = [F.round(vec.dot(F.col("embedding"), F.lit(c)), vec.SCORE_DIGITS) for c in centroids.values()]
    own = F.element_at(F.create_map(*[x for i, s in zip(centroids, scores, strict=True) for x in (F.lit(i), s)]), F.col("list_id"))
    unit = all(abs(sum(x * x for x in c) - 1) < 1e-9 for c in centroids.values())
    return postings.agg(
        F.count("*").alias("n_stored"),
        F.count_distinct("paper_id").alias("n_papers"),
        F.count_if(own < F.greatest(*scores)).alias("n_misplaced"),
        F.lit(unit and 1 <= len(centroids) <= LISTS).alias("unit_centroids"),
    )


def ivf_tree(spark, folder):
    """What a two-level index must satisfy: every vector stored once, in the nearest leaf of its nearest branch, and of the ten nearest
    vectors of each query nine found on average with ``TREE_NPROBE`` of ``TREE_BRANCHES * TREE_LEAVES`` lists. Two groups of branches."""
    source = vectors.papers(spark, folder)
    dim = ivf.embedding_dim(source)
    group = 8 * TREE_LEAVES * dim * (TREE_BRANCHES // 2)
    index = centroid_tree.build_tree(source, TREE_BRANCHES, TREE_LEAVES, TREE_NPROBE, TREE_BRANCHES, seed=SEED, group_bytes=group)
    postings = checkpoint(index.postings)
    unit = vec.l2_normalize(vec.as_double(F.col("embedding")))
    near = lambda c: F.round(vec.dot(unit, c), vec.SCORE_DIGITS)
    # of the few branches, the one with the best score and of equals the smaller number
    ranked = [F.struct(near(F.lit(c.tolist())).alias("s"), F.lit(-i).alias("b")) for i, c in enumerate(index.tree.root)]
    leaves = index.tree.leaves.select("branch", F.col("list_id").alias("leaf"), "centroid")
    own = postings.select("paper_id", "embedding", "list_id", (-F.greatest(*ranked)["b"]).alias("branch"))
    scores = own.join(F.broadcast(leaves), "branch").select("paper_id", "list_id", "leaf", near(F.col("centroid")).alias("s"))
    best = scores.groupBy("paper_id", "list_id").agg(F.max_by("leaf", F.struct("s", -F.col("leaf"))).alias("leaf"))
    queries, _ = vectors._requests(source)
    queries = checkpoint(queries)
    exact = checkpoint(exact_topk(queries, source, dim)).select("query_id", "paper_id")
    hits = centroid_tree.search_tree(queries, replace(index, postings=postings)).join(exact, ["query_id", "paper_id"]).count()
    wrong = best.where("list_id <> leaf").count()
    return postings.agg(
        F.count("*").alias("n_stored"),
        F.count_distinct("paper_id").alias("n_papers"),
        F.lit(wrong).cast("bigint").alias("n_misplaced"),
        F.lit(hits >= 0.9 * exact.count()).alias("finds_nine_of_ten"),
    )


def pca_2d(spark, folder):
    """What the two directions must satisfy: centred, uncorrelated, ordered, within the total variance, and eigenvectors of the covariance
    that sums over all pairs of components give (one row a pair, not the library's)."""
    source = vectors.papers(spark, folder)
    values = source.select("paper_id", F.posexplode(vec.as_double(F.col("embedding"))).alias("pos", "v"))
    total = values.groupBy("pos").agg(F.var_samp("v").alias("s")).agg(F.round(F.sum("s"), 6)).first()[0]
    residual = project.eigen_residual(source, project.directions(source))
    xy = project.project_2d(source).agg(
        F.count("*").alias("n_points"), F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy"), F.covar_samp("x", "y").alias("c")
    )
    return xy.select(
        "n_points",
        F.lit(total).alias("total_variance"),
        (F.abs("c") < 1e-9).alias("uncorrelated"),
        ((F.col("vx") >= F.col("vy")) & (F.col("vy") > 0)).alias("ordered"),
        ((F.col("vx") + F.col("vy")) <= total + 1e-6).alias("within_total"),
        F.lit(residual <= 1e-9 * total).alias("eigenvectors"),
    )


def _facts(model, rows, label):
    """Per class of the test rows: how many there are and how many got a prediction; whether the model tells the rows
    it was fitted on at least as well as naming their largest class would; and whether the fit ended near the minimum of its loss. (The table's labels need not follow from its
    vectors, so nothing is promised for the test rows.)"""
    scored = checkpoint(model.transform(rows).select("split", F.col(label).cast("string").alias("label"), "predicted"))
    fitted = scored.where("split = 'train'").groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.expr("label = predicted")).alias("h"))
    most, hits = fitted.agg(F.max("n"), F.sum("h")).first()
    per_class = scored.where("split = 'test'").groupBy("label").agg(F.count("*").alias("support"), F.count("predicted").alias("n_predicted"))
    share = classify.gradient_share(model, rows.where("split = 'train'"), label)
    return per_class.select("*", F.lit(hits >= most).alias("fitted_beats_guessing"), F.lit(share <= GRADIENT_LEFT).alias("near_the_minimum"))


def embedding_classifier(spark, folder):
    rows = sampling.train_test_split(vectors.papers(spark, folder), 0.2, SEED).withColumn("features", array_to_vector("embedding"))
    model = classify.fit_on_embeddings(rows.where("split = 'train'"), "label")
    return _facts(model, rows, "label")


def tfidf_classifier(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet").select(F.col("doc_id").alias("paper_id"), "quality")
    labelled = sampling.train_test_split(corpus.papers(spark, folder).join(labels, "paper_id"), corpus.TEST_SIZE, SEED)
    model = classify.fit_on_text(labelled.where("split = 'train'"), "quality")
    return _facts(model, labelled, "quality")


QUERIES = {
    f.__name__: f
    for f in (
        exact_knn_scaled, search_own_k, exact_knn_blocks, stored_index_search, paper_lookup, paper_at,
        search_with_stored_metadata, stored_pairs, text_ir_metrics,
        text_subject_metrics, text_metric_delta, landscape_labels, ivf_train, ivf_tree, pca_2d, embedding_classifier, tfidf_classifier,
    )
}

_RAW = q.PAPERS.replace("papers AS", "raw AS", 1)


def _encoded(name: str = "papers", dim: int = DIM) -> str:
    vecs = f"vecs_{dim}"
    return f"""{q.encoded(vecs, "raw", "paper_id", "abstract", dim)},
{name} AS (SELECT paper_id, embedding, primary_subject FROM {vecs} JOIN raw USING (paper_id))"""


def _evaluated(dim: int) -> str:
    parts = q.with_(_RAW, _encoded(dim=dim), q.sample_roles(SAMPLE, "actual"), q.QRELS, q.exact_hits(100), q.query_metrics())
    return f"{parts}{q.metric_rows('per_query')}"


def _classes(source: str, label: str) -> str:
    return f"""{q.ranked("by_test", source, SEED, "test")}
SELECT {label}::VARCHAR AS label, count(*) AS support, count(*) AS n_predicted, true AS fitted_beats_guessing, true AS near_the_minimum
FROM by_test WHERE rk <= ceil(n * 0.2::DOUBLE) GROUP BY 1"""


ORACLE = {
    "exact_knn_scaled": q.with_(
        """papers AS (SELECT vec_id AS paper_id, [(x * (label + 1))::FLOAT::DOUBLE FOR x IN embedding::DOUBLE[]] AS embedding,
  label::VARCHAR AS primary_subject FROM embeddings)""",
        q.request_roles(),
        q.exact_hits(),
    )
    + "SELECT query_id, rank, score, paper_id FROM hits",
    "search_own_k": q.with_(q.VECTORS, q.request_roles(), q.exact_hits(37))
    + "SELECT query_id, rank, score, paper_id FROM hits WHERE rank <= query_id % 37 + 1",
    "exact_knn_blocks": vectors.ORACLE["exact_knn"],
    "stored_index_search": vectors.ORACLE["ivf_search"],
    "paper_lookup": vectors._IVF.rstrip() + f""",
{_RAW} SELECT paper_id, title, abstract, primary_subject FROM raw WHERE paper_id IN (SELECT paper_id FROM hits)""",
    "paper_at": f"""WITH {_RAW}, placed AS (SELECT row_number() OVER (ORDER BY paper_id) - 1 AS place, paper_id, title, count(*) OVER () AS n FROM raw)
SELECT place, paper_id, title FROM placed WHERE place % 100 = 0 OR place = n - 1""",
    "search_with_stored_metadata": vectors.ORACLE["search_with_metadata"],
    "stored_pairs": corpus.ORACLE["positive_pairs_balanced"],
    "text_ir_metrics": f"SELECT metric, round(value, 6) AS value FROM ({_evaluated(DIM)})",
    "text_subject_metrics": q.with_(_RAW, _encoded(), q.capped_roles(PER_SUBJECT), q.QRELS, q.exact_hits(10), q.query_metrics())
    + """SELECT subject, count(*) AS n_queries, round(avg("precision@10"), 6) AS p_at_10,
  round(avg("recall@10"), 6) AS r_at_10, round(avg("mrr@10"), 6) AS mrr, round(avg("ndcg@10"), 6) AS ndcg_at_10
FROM per_query GROUP BY subject""",
    "text_metric_delta": f"""SELECT metric, round(b.value, 6) AS before, round(a.value, 6) AS after, round(a.value - b.value, 6) AS delta
FROM ({_evaluated(DIM // 2)}) b JOIN ({_evaluated(DIM)}) a USING (metric) WHERE metric LIKE '%precision%' OR metric LIKE '%ndcg%'""",
    "landscape_labels": q.with_(q.VECTORS, q.stratified_sample(vectors.POINTS))
    + f"""SELECT primary_subject, count(*) AS n_points, round(avg(embedding[1]), 6) AS x, round(avg(embedding[2]), 6) AS y
FROM sampled GROUP BY 1 HAVING count(*) >= {MIN_POINTS}""",
    "ivf_train": "SELECT count(*) AS n_stored, count(*) AS n_papers, 0::BIGINT AS n_misplaced, true AS unit_centroids FROM embeddings",
    "ivf_tree": "SELECT count(*) AS n_stored, count(*) AS n_papers, 0::BIGINT AS n_misplaced, true AS finds_nine_of_ten FROM embeddings",
    "pca_2d": """SELECT (SELECT count(*) FROM embeddings) AS n_points, round(sum(s), 6) AS total_variance, true AS uncorrelated,
  true AS ordered, true AS within_total, true AS eigenvectors FROM (
  SELECT pos, var_samp(v) AS s FROM (
    SELECT unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY pos)""",
    "embedding_classifier": q.with_(q.VECTORS)[:-1] + ", " + _classes("papers", "label"),
    "tfidf_classifier": "WITH papers AS (SELECT doc_id AS paper_id, quality FROM documents JOIN labels USING (doc_id)), "
    + _classes("papers", "quality"),
}
