"""Ready buckets as a stream: each micro-batch is one load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.load import LoadJob
from tidemark.sources.manifest import read_ready, stream_ready


def start_load_stream(
    job: LoadJob, manifest: str, checkpoint: str, every: str | None = None, archive: str | None = None
) -> StreamingQuery:
    """Load buckets as they are announced; without ``every``, those there now.

    The checkpoint remembers which entries were handed out, the ledger which buckets
    were loaded. A micro-batch that is replayed after a failure finds its finished
    buckets in the ledger and loads only the others. There is no watermark: an old
    bucket that is announced late is loaded like any other. A bucket that can't be loaded is set aside and
    tried again by later loads. With ``archive`` handled entries are moved there, and the backlog metrics count
    what is still listed.
    """

    def load(entries: DataFrame, _epoch: int) -> None:
        job.run(lambda: entries, None if archive else read_ready(job.spark, manifest))

    writer = (
        stream_ready(job.spark, manifest, job.settings.buckets_per_load, archive)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
    )
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()
