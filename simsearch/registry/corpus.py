"""Queries over the text corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simsearch.functions import text
from simsearch.operators import classify, pairs, positions, profile, sampling
from simsearch.operators.encode import HashingEncoder, encode_papers
from simsearch.plans.preprocess import split_sizes
from simsearch.registry import sql as q
from simsearch.sources.tables import documents_as_papers

SEED = 42
TEST_SIZE = 0.2
SAMPLE = 250
DIM = 64


def papers(spark: SparkSession, folder: str) -> DataFrame:
    return documents_as_papers(spark, folder)


def with_subjects(spark: SparkSession, folder: str) -> DataFrame:
    return papers(spark, folder).withColumn("subjects", text.split_subjects(F.col("joined_subjects")))


def scan_papers(spark, folder):
    return papers(spark, folder).select("paper_id", "title", "abstract", "primary_subject")


def train_test_split(spark, folder):
    return sampling.train_test_split(papers(spark, folder), TEST_SIZE, SEED).select("paper_id", "split")


def nested_split(spark, folder):
    return sampling.nested_split(papers(spark, folder), TEST_SIZE, SEED).select("paper_id", "split")


def split_row_counts(spark, folder):
    return split_sizes(nested_split(spark, folder))


def union_splits(spark, folder):
    splits = sampling.nested_split(papers(spark, folder).select("paper_id", "primary_subject"), TEST_SIZE, SEED)
    return splits.where(F.col("split").isin("train", "eval", "test"))


def eligible_subjects(spark, folder):
    return positions.subject_counts(papers(spark, folder))


def _pairs(spark, folder, balanced, epoch=0):
    source = papers(spark, folder)
    config = pairs.PairConfig(num_pairs=source.count(), seed=SEED, balanced=balanced, epoch=epoch)
    return pairs.positive_pairs(source, config)


def positive_pairs_balanced(spark, folder):
    return _pairs(spark, folder, True)


def positive_pairs_weighted(spark, folder):
    return _pairs(spark, folder, False)


def positive_pairs_next_epoch(spark, folder):
    return _pairs(spark, folder, True, epoch=1)


def contrastive_pairs(spark, folder):
    source = papers(spark, folder)
    return pairs.contrastive_pairs(source, pairs.PairConfig(num_pairs=source.count(), seed=SEED))


def subject_positions(spark, folder):
    return positions.index_subjects(papers(spark, folder), SEED).positions


def stratified_sample(spark, folder):
    source = papers(spark, folder).select("paper_id", "primary_subject")
    return sampling.stratified_sample(source, SAMPLE, SEED)


def ir_sample_requested(spark, folder):
    source = papers(spark, folder).select("paper_id", "primary_subject")
    return sampling.ir_sample(source, SAMPLE, SEED)


def subject_counts(spark, folder):
    return profile.value_counts(papers(spark, folder))


def subject_cardinality(spark, folder):
    return profile.cardinality(with_subjects(spark, folder))


def top_bottom_subjects(spark, folder):
    counts = subject_counts(spark, folder)
    top = profile.most_common(counts, "primary_subject", 10).withColumn("side", F.lit("top"))
    return top.unionByName(profile.least_common(counts, "primary_subject", 10).withColumn("side", F.lit("bottom")))


def subject_label_counts(spark, folder):
    return profile.label_counts(with_subjects(spark, folder))


def never_primary(spark, folder):
    return profile.never_primary(with_subjects(spark, folder))


def subjects_array(spark, folder):
    return with_subjects(spark, folder).select("paper_id", F.posexplode("subjects").alias("pos", "subject"))


def clean_label(spark, folder):
    """Labels with tabs, newlines and no-break spaces around their parts."""
    around = [("\t", "\n"), ("\u00a0", "\u2003 "), ("", "\u00a0(x)\t")]
    kind = F.pmod("paper_id", F.lit(len(around)))
    padded = F.concat(F.lit(around[0][0]), "primary_subject", F.lit(around[0][1]))
    for i, (before, after) in enumerate(around[1:], 1):
        padded = F.when(kind == i, F.concat(F.lit(before), "primary_subject", F.lit(after))).otherwise(padded)
    return papers(spark, folder).select("paper_id", text.clean_label(padded).alias("label"))


def format_count(spark, folder):
    sizes = papers(spark, folder).groupBy("primary_subject").agg(F.sum(F.length("abstract")).alias("n_chars"))
    return sizes.withColumn("compact", text.compact_count(F.col("n_chars")))


def tfidf(spark, folder):
    weights = classify.tfidf(papers(spark, folder))
    return weights.withColumn("weight", F.round("weight", 6))


def encode_documents(spark, folder):
    vectors = encode_papers(papers(spark, folder), HashingEncoder(DIM)).where("embedding is not null")
    return vectors.select("paper_id", F.posexplode("embedding").alias("pos", "x")).select(
        "paper_id", "pos", F.round(F.col("x").cast("double"), 6).alias("value")
    )


QUERIES = {
    f.__name__: f
    for f in (
        scan_papers, train_test_split, nested_split, split_row_counts, union_splits, eligible_subjects,
        positive_pairs_balanced, positive_pairs_weighted, positive_pairs_next_epoch, contrastive_pairs,
        subject_positions, stratified_sample,
        ir_sample_requested, subject_counts, subject_cardinality, top_bottom_subjects, subject_label_counts,
        never_primary, subjects_array, clean_label, format_count, tfidf, encode_documents,
    )
}

_P = q.PAPERS
_POSITIVE = """SELECT pair_id, same.subject, p.paper_id AS anchor_id, r.paper_id AS positive_id,
  p.abstract AS anchor, r.abstract AS positive
FROM same JOIN positions p ON p.pos = pos1 JOIN positions r ON r.pos = pos2"""
_LABELS = "labels_of AS (SELECT unnest(string_split(joined_subjects, '; ')) AS label FROM papers)"

ORACLE = {
    "scan_papers": q.with_(_P) + "SELECT paper_id, title, abstract, primary_subject FROM papers",
    "train_test_split": q.with_(_P, q.ranked("by_test", "papers", 42, "test"))
    + "SELECT paper_id, CASE WHEN rk <= ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM by_test",
    "nested_split": q.with_(_P, q.NESTED) + "SELECT paper_id, split FROM splits",
    "split_row_counts": q.with_(_P, q.NESTED) + "SELECT split, count(*) AS n FROM splits GROUP BY split",
    "union_splits": q.with_(_P, q.NESTED)
    + "SELECT paper_id, primary_subject, split FROM papers JOIN splits USING (paper_id)",
    "eligible_subjects": q.with_(_P)
    + "SELECT primary_subject AS subject, count(*) AS n FROM papers GROUP BY 1 HAVING count(*) >= 2",
    "positive_pairs_balanced": q.with_(_P, q.positive_ids(True)) + _POSITIVE,
    "positive_pairs_weighted": q.with_(_P, q.positive_ids(False)) + _POSITIVE,
    "positive_pairs_next_epoch": q.with_(_P, q.positive_ids(True, epoch=1)) + _POSITIVE,
    "contrastive_pairs": q.with_(_P, q.contrastive_ids())
    + """SELECT pair_id, id1, id2, x.abstract AS sentence1, y.abstract AS sentence2, label
FROM both_ids JOIN papers x ON x.paper_id = id1 JOIN papers y ON y.paper_id = id2""",
    "subject_positions": q.with_(_P, q.SUBJECT_INDEX) + "SELECT pos::BIGINT AS pos, paper_id FROM positions",
    "stratified_sample": q.with_(_P, q.stratified_sample(SAMPLE)) + "SELECT paper_id, primary_subject FROM sampled",
    "ir_sample_requested": q.with_(_P, q.sample_roles(SAMPLE, "requested"))
    + "SELECT paper_id, primary_subject, role FROM roles",
    "subject_counts": q.with_(_P) + "SELECT primary_subject, count(*) AS n FROM papers GROUP BY 1",
    "subject_cardinality": q.with_(_P, _LABELS)
    + """SELECT (SELECT count(DISTINCT primary_subject) FROM papers) AS n_subjects,
  (SELECT count(DISTINCT label) FROM labels_of) AS n_labels""",
    "top_bottom_subjects": q.with_(_P, "c AS (SELECT primary_subject, count(*) AS n FROM papers GROUP BY 1)")
    + """SELECT * FROM (SELECT *, 'top' AS side FROM c ORDER BY n DESC, primary_subject LIMIT 10)
UNION ALL SELECT * FROM (SELECT *, 'bottom' AS side FROM c ORDER BY n, primary_subject DESC LIMIT 10)""",
    "subject_label_counts": q.with_(_P, _LABELS) + "SELECT label, count(*) AS n FROM labels_of GROUP BY label",
    "never_primary": q.with_(_P, _LABELS)
    + "SELECT label FROM labels_of EXCEPT SELECT primary_subject FROM papers",
    "subjects_array": q.with_(_P)
    + """SELECT paper_id, (i - 1)::INTEGER AS pos, s[i] AS subject FROM (
  SELECT paper_id, s, unnest(range(1, len(s) + 1)) AS i FROM (
    SELECT paper_id, string_split(joined_subjects, '; ') AS s FROM papers))""",
    "clean_label": q.with_(_P)
    + r"""SELECT paper_id, regexp_replace(regexp_replace(s, '[\pZ\t-\r\x1c-\x1f\x{85}]*\([^)]+\)[\pZ\t-\r\x1c-\x1f\x{85}]*$', ''),
  '^[\pZ\t-\r\x1c-\x1f\x{85}]+|[\pZ\t-\r\x1c-\x1f\x{85}]+$', '', 'g') AS label
FROM (SELECT paper_id, CASE paper_id % 3 WHEN 0 THEN chr(9) || primary_subject || chr(10)
  WHEN 1 THEN chr(160) || primary_subject || chr(8195) || ' ' ELSE primary_subject || chr(160) || '(x)' || chr(9) END AS s FROM papers)""",
    "format_count": q.with_(_P)
    + """SELECT *, CASE WHEN n_chars >= 1000000 THEN (n_chars // 1000000)::VARCHAR || 'M'
  WHEN n_chars >= 1000 THEN (n_chars // 1000)::VARCHAR || 'k' ELSE n_chars::VARCHAR END AS compact
FROM (SELECT primary_subject, sum(length(abstract))::BIGINT AS n_chars FROM papers GROUP BY 1)""",
    "tfidf": q.with_(
        _P,
        r"""words AS (SELECT paper_id, unnest(regexp_extract_all(lower(abstract), '[\p{L}\p{N}]+')) AS word FROM papers)""",
        "counts AS (SELECT paper_id, word, count(*) AS tf FROM words GROUP BY ALL)",
        "freq AS (SELECT word, count(*) AS df FROM counts GROUP BY word)",
    )
    + """SELECT paper_id, word, tf, df,
  round(tf * ln(((SELECT count(*) FROM papers) + 1)::DOUBLE / (df + 1)), 6) AS weight
FROM counts JOIN freq USING (word)""",
    "encode_documents": q.with_(_P, q.encoded("vecs", "papers", "paper_id", "abstract"))
    + """SELECT paper_id, (i - 1)::INTEGER AS pos, round(embedding[i], 6) AS value
FROM (SELECT paper_id, embedding, unnest(range(1, 65)) AS i FROM vecs)""",
}
