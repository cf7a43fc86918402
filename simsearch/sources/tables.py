"""Tables the jobs read: their schemas, and how the given parquet files map onto them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsearch.functions.text import split_subjects

PAPERS = T.StructType(
    [
        T.StructField("paper_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract", T.StringType()),
        T.StructField("primary_subject", T.StringType()),
        T.StructField("subjects", T.ArrayType(T.StringType())),
        T.StructField("arxiv_id", T.StringType()),
    ]
)
EMBEDDINGS = T.StructType(
    [T.StructField("paper_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))]
)
REQUESTS = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("abstract", T.StringType()),
        T.StructField("k", T.IntegerType()),
        T.StructField("nprobe", T.IntegerType()),
    ]
)
REQUEST_LOG = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("latency", T.DoubleType()),
    ]
)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A parquet table; a missing path is a ``FileNotFoundError``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            raise FileNotFoundError(f"no table at {path}") from e
        raise


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")
    return df.select(*columns)


def conform(df: DataFrame, schema: T.StructType, optional: tuple[str, ...] = ()) -> DataFrame:
    """The schema's columns in its types; an absent optional one is null, any other is an error."""
    missing = [f.name for f in schema if f.name not in df.columns and f.name not in optional]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")
    return df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def select_papers(papers: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """The configured columns and the id; joined subjects become a list here, once and for all."""
    chosen = require_columns(papers, list(dict.fromkeys(["paper_id", *columns])))
    if "subjects" in chosen.columns and chosen.schema["subjects"].dataType == T.StringType():
        chosen = chosen.withColumn("subjects", split_subjects(F.col("subjects")))
    known = {f.name: f.dataType for f in PAPERS}
    return chosen.select(*[F.col(c).cast(known[c]).alias(c) if c in known else F.col(c) for c in chosen.columns])


def read_papers(spark: SparkSession, path: str, columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """The raw corpus with the configured columns only; the id always comes along."""
    papers = read_table(spark, path)
    return papers if columns is None else select_papers(papers, columns)


def usable(papers: DataFrame, text_field: str = "abstract") -> DataFrame:
    """Rows that can be sampled and indexed."""
    return papers.where(
        F.col("paper_id").isNotNull() & F.col(text_field).isNotNull() & F.col("primary_subject").isNotNull()
    )


def count_unusable(papers: DataFrame, text_field: str = "abstract") -> DataFrame:
    """One row: how many papers lack an id, a text or a subject."""
    return papers.agg(
        F.count_if(F.col("paper_id").isNull()).alias("without_id"),
        F.count_if(F.col(text_field).isNull()).alias("without_text"),
        F.count_if(F.col("primary_subject").isNull()).alias("without_subject"),
    )


# The given parquet files


def documents_as_papers(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as papers: the subject is the source with its language in brackets."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    subject = F.concat(F.col("source"), F.lit(" ("), F.col("lang"), F.lit(")"))
    return docs.select(
        F.col("doc_id").alias("paper_id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("abstract"),
        subject.alias("primary_subject"),
        F.concat_ws("; ", subject, F.col("lang")).alias("joined_subjects"),
        F.lit(None).cast("string").alias("arxiv_id"),
    )


def vectors_as_papers(spark: SparkSession, folder: str) -> DataFrame:
    """Stored vectors with their label as the subject."""
    return spark.read.parquet(f"{folder}/embeddings.parquet").select(
        F.col("vec_id").alias("paper_id"), "embedding", F.col("label").cast("string").alias("primary_subject"), "label"
    )


def events_as_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a request log: the type is the endpoint, an error is a failed request."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    failed = F.col("event_type") == "error"
    return events.select(
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("endpoint"),
        F.lit("POST").alias("method"),
        F.when(failed, 500).otherwise(200).alias("status_code"),
        F.col("value").alias("latency"),
        (~failed).alias("success"),
    )
