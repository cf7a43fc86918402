"""Streams run for real, stopped and started again from their checkpoints, and compared with batch SQL."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from simsearch.operators.encode import HashingEncoder
from simsearch.operators.pairs import PairConfig
from simsearch.registry import corpus, service
from simsearch.registry import sql as q
from simsearch.session import checkpoint, shared_folder
from simsearch.sources import paper_store
from simsearch.sources.tables import events_as_log
from simsearch.streaming.pair_stream import start_pairs
from simsearch.streaming.request_rates import start_rates
from simsearch.streaming.search_stream import start_search

ARRIVALS = 4
DELAY, DELAY_SQL = "1 day", "INTERVAL 1 DAY"
WINDOW = "1 hour"
EPOCHS = 3


def _arrive(rows, path: str, number: int) -> None:
    """One file of the stream's input."""
    rows.where(F.col("arrival") == number).drop("arrival").coalesce(1).write.mode("append").parquet(path)


def stream_search(spark, folder):
    """The requests arrive in three files. The second batch's answers are written, then the batch fails; the stream is started
    again from its checkpoint, replays that batch and goes on."""
    base = shared_folder(spark, "stream-search")
    requests = checkpoint(service.search_table(spark, folder).withColumn("arrival", F.pmod("query_id", F.lit(3))))
    for number in range(3):
        _arrive(requests, f"{base}/in", number)
    index = service.text_index(spark, folder)
    paper_store.save_papers(service._papers(spark, folder), f"{base}/papers", rows_per_file=100)
    papers = paper_store.load_papers(spark, f"{base}/papers")
    incoming = spark.readStream.schema(requests.drop("arrival").schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")

    def fail(batch_id: int) -> None:
        if batch_id == 1:
            raise RuntimeError("the driver is lost after the answers were written")

    for written in (fail, None):
        query = start_search(incoming, index, papers, HashingEncoder(service.DIM), f"{base}/out", f"{base}/checkpoint", written=written)
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if written is None:
                raise
    hits = spark.read.parquet(f"{base}/out/hits")
    return hits.select("query_id", "rank", "score", "paper_id", "title", "abstract", "primary_subject", "arxiv_id")


def _arrivals(log):
    """In time order in four parts, but every tenth row comes one part late, every twenty-fifth with the last part, and every seventh
    is sent again with the part after its own."""
    i = F.col("request_id")
    low, high = log.agg(F.min("request_id"), F.max("request_id")).first()
    part = F.floor((i - low) * ARRIVALS / F.lit(high - low + 1)).cast("int")
    late = F.when(i % 25 == 0, ARRIVALS).when(i % 10 == 0, 1).otherwise(0)
    own = F.least(F.lit(ARRIVALS - 1), part + late)
    again = F.when(i % 7 == 0, F.array(own, F.least(F.lit(ARRIVALS - 1), own + 1))).otherwise(F.array(own))
    return log.withColumn("arrival", F.explode(again))


def stream_request_rates(spark, folder):
    """Windows that the watermark closed, after repeats and late rows. The stream is stopped after each arrival and started again."""
    base = shared_folder(spark, "stream-rates")
    log = checkpoint(_arrivals(events_as_log(spark, folder)))
    schema = log.drop("arrival").schema
    for number in range(ARRIVALS):
        _arrive(log, f"{base}/in", number)
        incoming = spark.readStream.schema(schema).parquet(f"{base}/in")
        start_rates(incoming, f"{base}/out", f"{base}/checkpoint", WINDOW, DELAY).awaitTermination()
    return service._timestamps(spark.read.parquet(f"{base}/out"), "window_start", "window_end")


def pair_stream(spark, folder):
    """Three epochs of pairs: two in a first run, the third by a run that is started again from the checkpoint."""
    base = shared_folder(spark, "stream-pairs")
    source = corpus.papers(spark, folder)
    config = PairConfig(num_pairs=source.count(), seed=corpus.SEED)
    for last in (EPOCHS - 2, EPOCHS - 1):
        query = start_pairs(source, config, f"{base}/out", f"{base}/checkpoint", last=last)
        query.processAllAvailable()
        query.stop()
    return spark.read.parquet(f"{base}/out").select(F.col("epoch").cast("int").alias("epoch"), "pair_id", "subject", "anchor_id", "positive_id", "anchor", "positive")


QUERIES = {f.__name__: f for f in (stream_search, stream_request_rates, pair_stream)}


def _epoch(number: int) -> str:
    own = corpus.ORACLE["positive_pairs_balanced"].replace("'42.0'", f"'42.{number}'")
    return f"SELECT {number}::INTEGER AS epoch, * FROM ({own})"


ORACLE = {
    "stream_search": service.ORACLE["search_requests"],
    # a row counts unless its time is at or before the watermark of its arrival: the newest time of all earlier arrivals, less the delay
    "stream_request_rates": q.with_(
        q.LOG,
        "ends AS (SELECT min(request_id) AS low, max(request_id) AS high FROM log)",
        f"""arrived AS (SELECT log.*, least({ARRIVALS - 1}, floor((request_id - low) * {ARRIVALS}::DOUBLE / (high - low + 1))::INTEGER
    + CASE WHEN request_id % 25 = 0 THEN {ARRIVALS} WHEN request_id % 10 = 0 THEN 1 ELSE 0 END) AS arrival FROM log CROSS JOIN ends)""",
        "newest AS (SELECT arrival, date_trunc('millisecond', max(ts)) AS top FROM arrived GROUP BY arrival)",
        f"""marks AS (SELECT a.arrival, max(b.top) - {DELAY_SQL} AS mark FROM (SELECT unnest(range(0, {ARRIVALS + 1})) AS arrival) a
    LEFT JOIN newest b ON b.arrival < a.arrival GROUP BY a.arrival)""",
        f"""counted AS (SELECT date_trunc('hour', ts) AS s, endpoint, status_code, count(*) AS n FROM arrived JOIN marks USING (arrival)
    WHERE mark IS NULL OR ts > mark GROUP BY ALL)""",
        f"windows AS (SELECT * FROM counted WHERE s + INTERVAL 1 HOUR <= (SELECT mark FROM marks WHERE arrival = {ARRIVALS}))",
    )
    + service._WINDOW_ROWS,
    "pair_stream": " UNION ALL ".join(_epoch(e) for e in range(EPOCHS)),
}
