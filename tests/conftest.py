import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from simsearch.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def papers(spark):
    """1,000 papers over three even subjects, with unique abstracts."""
    subject = F.element_at(F.array(*[F.lit(s) for s in ("Physics", "Biology", "Mathematics")]), (F.col("id") % 3 + 1).cast("int"))
    return spark.range(1000).select(
        F.col("id").alias("paper_id"),
        F.concat(F.lit("Paper "), "id").alias("title"),
        F.concat(F.lit("abstract number "), "id", F.lit(" about things")).alias("abstract"),
        subject.alias("primary_subject"),
        F.array(subject, F.lit("General Science")).alias("subjects"),
    )


@pytest.fixture(scope="session")
def skewed(spark):
    """One subject holds two thirds of the rows, many hold a few, two hold one row."""
    i = F.col("id")
    return spark.range(900).select(
        i.alias("paper_id"),
        F.concat(F.lit("text "), i).alias("abstract"),
        F.when(i < 600, "hot").when(i < 898, F.concat(F.lit("s"), i % 60)).otherwise(F.concat(F.lit("single"), i)).alias(
            "primary_subject"
        ),
    )


def unit_vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


@pytest.fixture(scope="session")
def matrix():
    """400 unit vectors, the last 40 being copies of vector 7."""
    x = unit_vectors(400, 16, 42)
    x[360:] = x[7]
    return x


@pytest.fixture(scope="session")
def embeddings(spark, matrix):
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "paper_id bigint, embedding array<float>").repartition(5)
