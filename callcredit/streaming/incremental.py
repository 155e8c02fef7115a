"""The incremental merge as a Structured Streaming query.

New bronze run folders are a file stream; each micro-batch is time-normalised
and upserted into the silver snapshot (``foreachBatch``).  The stream's
checkpoint records which files were merged, so a restarted query continues
where it stopped, and a batch that is replayed after a failure upserts the
same rows again, which leaves rows with a key unchanged (a row with a NULL
key matches nothing and is inserted again, so such rows are refused).  ``Trigger.AvailableNow`` processes what has arrived and stops,
which is how a scheduled load runs; a long-running query uses a processing
time trigger instead.

This is a file-arrival stream with a batch high-water mark, like the batch
loads: there is no event-time watermark or windowed state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..config import TimeSpec
from ..functions.timezone import normalise_times
from ..operators import mutate
from ..sources import snapshot
from ..sources.buckets import is_bucketed, upsert_bucketed


def merge_stream(spark: SparkSession, bronze_dir: str, schema: StructType, keys: list[str],
                 silver_root: str, checkpoint: str, spec: TimeSpec | None = None,
                 newest_by: str | None = None, available_now: bool = True,
                 processing_time: str = "1 minute", max_files_per_trigger: int | None = None,
                 archive_dir: str | None = None, keep_versions: int = 2) -> StreamingQuery:
    """Start the merge stream.  A silver table in key buckets
    (``sources.buckets``) has only the buckets rewritten that a micro-batch
    touches; otherwise each batch writes the next snapshot version and all
    but the newest ``keep_versions`` go.  With ``archive_dir`` merged bronze files are moved
    there, so the source listing does not grow with the run history."""
    reader = (spark.readStream.schema(schema)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    changes = reader.parquet(bronze_dir)
    in_buckets = is_bucketed(spark, silver_root)

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        batch = normalise_times(batch, spec)
        for k in keys:  # fails the batch before anything is written
            batch = batch.withColumn(k, F.coalesce(F.col(k), F.raise_error(F.lit(f"NULL key {k}")).cast(batch.schema[k].dataType)))
        if in_buckets:
            upsert_bucketed(spark, silver_root, batch, keys, newest_by=newest_by)
            return
        current = snapshot.read_snapshot(spark, silver_root)
        merged = mutate.upsert(current, batch, keys, newest_by=newest_by)
        snapshot.write_snapshot(merged, silver_root)
        snapshot.vacuum(spark, silver_root, keep_versions)

    writer = changes.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time)
    return writer.start()
