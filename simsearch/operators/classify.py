"""Classification baselines on embeddings and on TF-IDF, and their report."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.operators.layout import spread_small
from simsearch.operators.skew import join_group
from simsearch.session import checkpoint

WORD = r"[\p{L}\p{N}]+"
# the words that are counted at once; a text with more is a piece of its own
PIECE_WORDS = 1 << 18


def _with_labels(stages: list, train: DataFrame, label_col: str) -> PipelineModel:
    """Labels are numbered for fitting only: the model scores every row, whatever its label."""
    indexer = StringIndexer(inputCol=label_col, outputCol="label_ix", handleInvalid="skip").fit(train)
    classifier = LogisticRegression(featuresCol="features", labelCol="label_ix", predictionCol="predicted_ix", maxIter=50)
    names = IndexToString(inputCol="predicted_ix", outputCol="predicted", labels=indexer.labels)
    return Pipeline(stages=[*stages, classifier, names]).fit(indexer.transform(train))


def fit_on_embeddings(train: DataFrame, label_col: str) -> PipelineModel:
    """Logistic regression on frozen embeddings; the frame needs ``features`` (see ``features``)."""
    return _with_labels([], train, label_col)


def gradient_share(model: PipelineModel, train: DataFrame, label_col: str) -> float:
    """How much of the loss's gradient the fit has left: the largest entry of the gradient at the returned weights, over all rows,
    against the largest at zero weights. The loss is convex, so a share near zero says that the weights are near its minimum.

    The gradient for class c is the mean of (p_c - [label is c]) x. Weights of a summary must not be negative, so it is taken as
    the sum with weights p_c - [label is c] + 1 less the plain sum. One pass; a vector a class reaches the driver.
    """
    names = model.stages[-1].getLabels()
    scored = model.transform(train).where(F.col(label_col).cast("string").isin(names))
    p = vector_to_array("probability")
    weights = {}
    for c, name in enumerate(names):
        hit = F.when(F.col(label_col).cast("string") == name, 1.0).otherwise(0.0)
        weights[f"now{c}"], weights[f"zero{c}"] = p[c] - hit + 1.0, 1.0 / len(names) - hit + 1.0
    rows = scored.select("features", *[w.alias(n) for n, w in weights.items()])
    means = [Summarizer.mean(F.col("features"), F.col(n)).alias(n) for n in weights]
    total = rows.agg(F.count("*").alias("n"), Summarizer.mean(F.col("features")).alias("mean"), *means, *[F.sum(n).alias(f"sum_{n}") for n in weights]).first()
    plain = total["n"] * total["mean"].toArray()
    largest = lambda kind: max(abs(total[f"sum_{kind}{c}"] * total[f"{kind}{c}"].toArray() - plain).max() for c in range(len(names)))
    return float(largest("now") / largest("zero"))


def features(embeddings: DataFrame) -> DataFrame:
    return embeddings.withColumn("features", array_to_vector("embedding"))


def fit_on_text(train: DataFrame, label_col: str, text_col: str = "abstract", num_features: int = 1 << 14) -> PipelineModel:
    """TF-IDF (hashed term counts) and logistic regression on the whole text."""
    stages = [
        RegexTokenizer(inputCol=text_col, outputCol="words", pattern=WORD, gaps=False),
        HashingTF(inputCol="words", outputCol="tf", numFeatures=num_features),
        IDF(inputCol="tf", outputCol="features"),
    ]
    return _with_labels(stages, train, label_col)


def _lengths(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("words").value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch cut after every text with which ``PIECE_WORDS`` more words are reached."""
    filled = np.cumsum(_lengths(batch)) // PIECE_WORDS
    borders = (np.flatnonzero(filled[1:] != filled[:-1]) + 1).tolist()
    for lo, hi in zip([0, *borders], [*borders, batch.num_rows], strict=True):
        yield batch.slice(lo, hi - lo)


def term_counts(papers: DataFrame, text_col: str = "abstract") -> DataFrame:
    """``(paper_id, word, tf)``: each text is counted inside its batch, by word numbers; nothing is shuffled.

    A batch is counted in pieces of whole texts with about ``PIECE_WORDS`` words, so that what a worker holds beside its batch
    does not grow with the batch's words.
    """
    words = F.regexp_extract_all(F.lower(text_col), F.lit(WORD), F.lit(0)).alias("words")
    rows = spread_small(papers.select(F.col("paper_id").cast("bigint").alias("paper_id"), text_col)).select("paper_id", words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch):
                lists = piece.column("words")
                encoded = lists.flatten().dictionary_encode()
                known = max(1, len(encoded.dictionary))
                owner = np.repeat(np.arange(len(lists)), _lengths(piece))
                found, times = np.unique(owner * known + encoded.indices.to_numpy(zero_copy_only=False), return_counts=True)
                columns = [piece.column("paper_id").take(pa.array(found // known)), encoded.dictionary.take(pa.array(found % known)), pa.array(times)]
                yield pa.RecordBatch.from_arrays(columns, ["paper_id", "word", "tf"])

    return rows.where(F.size("words") > 0).mapInArrow(count, "paper_id bigint, word string, tf bigint")


def tfidf(papers: DataFrame, text_col: str = "abstract") -> DataFrame:
    """``(paper_id, word, tf, df, weight)``: weight = tf * ln((n + 1) / (df + 1)).

    The texts are read once; the counts are stored and then joined to the words' document counts. A
    word found in every paper is counted by partial sums, and its rows get the count from a
    broadcast of the few frequent words instead of meeting in one task.
    """
    total = papers.agg(F.count("*").alias("n")).scalar()
    counts = checkpoint(term_counts(papers, text_col))
    frequency = counts.groupBy("word").agg(F.count("*").alias("df"))
    weight = F.col("tf") * F.log((total + 1) / (F.col("df") + 1))
    return join_group(counts, frequency, "word", "df").select("paper_id", "word", "tf", "df", weight.alias("weight"))


def confusion(predictions: DataFrame, label_col: str = "label", predicted_col: str = "predicted") -> DataFrame:
    return predictions.groupBy(
        F.col(label_col).cast("string").alias("label"), F.col(predicted_col).cast("string").alias("predicted")
    ).agg(F.count("*").alias("n"))


def classification_report(confusions: DataFrame) -> DataFrame:
    """``(label, precision, recall, f1, support)`` per class."""
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("given")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("given")),
    )
    hit = F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)
    per_class = (
        confusions.select(hit.alias("hit"), F.inline(sides))
        # a correct prediction appears on both sides; count it once, with the actual class
        .groupBy(F.col("class").alias("label"))
        .agg(
            F.sum(F.when(F.col("actual") > 0, F.col("hit")).otherwise(0)).alias("hits"),
            F.sum("actual").alias("support"),
            F.sum("given").alias("given"),
        )
    )
    precision = F.when(F.col("given") > 0, F.col("hits") / F.col("given")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("hits") / F.col("support")).otherwise(0.0)
    scored = per_class.withColumn("precision", precision).withColumn("recall", recall)
    both = F.col("precision") + F.col("recall")
    f1 = F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0)
    return scored.select("label", "precision", "recall", f1.alias("f1"), "support", "hits")


def summary(report: DataFrame) -> DataFrame:
    """One row: accuracy and macro F1."""
    return report.agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"), F.avg("f1").alias("macro_f1")
    )
