"""Load newly landed batch files once each, then stop.

The stream's checkpoint remembers which files were read, so a scheduled run
does not list the landing folder's past to find what is new. The rule that a
loaded file is skipped stays: a run that was cut off after its append and is
repeated adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.sources.batches import BATCH_GLOB, batch_files
from stayledger.sources.history import create_history, load_files


def _load_new(names: DataFrame, path: str) -> None:
    # The file names of one run; the stream's own log holds the same list.
    paths = [row[0] for row in names.distinct().collect()]
    if paths:
        load_files(batch_files(names.sparkSession, paths), path)


def ingest_available(
    spark: SparkSession, root: str, path: str, checkpoint: str, pattern: str = BATCH_GLOB
) -> None:
    """Append all files under ``root`` that earlier runs with this checkpoint have not read."""
    create_history(spark, path)
    # As whole lines: an empty CSV file, which has a header only, is noticed too.
    names = (
        spark.readStream.format("text")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(root)
        .select(F.col("_metadata.file_path").alias("source_object_path"))
    )
    query = (
        names.writeStream.foreachBatch(lambda batch, _: _load_new(batch, path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
