"""Continuous search: a stream of requests answered against a fixed index."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from simsearch.operators.encode import Encoder
from simsearch.operators.ivf import IvfIndex
from simsearch.plans.searching import search_requests
from simsearch.sources.paper_store import PaperStore


def start_search(
    requests: DataFrame,
    index: IvfIndex,
    papers: DataFrame | PaperStore,
    encoder: Encoder,
    output: str,
    checkpoint: str,
    trigger: dict | None = None,
    written: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Answer each micro-batch into ``output/hits`` and ``output/statuses``.

    A batch owns the folder of its number and overwrites it, so replaying a batch after a failure
    leaves one copy of its answers. With papers in a ``PaperStore`` a batch reads only the places of its hits. ``written`` is told
    the number of each batch whose answers are on disk; what it raises fails the batch, which is then replayed.
    """

    def answer(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            result = search_requests(batch, index, papers, encoder)
            result.hits.write.mode("overwrite").parquet(f"{output}/hits/batch_id={batch_id}")
            result.statuses.write.mode("overwrite").parquet(f"{output}/statuses/batch_id={batch_id}")
            if written is not None:
                written(batch_id)
        finally:
            batch.unpersist()

    writer = requests.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
