"""Archives as they arrive: a file stream that wakes the batch refresh.

A stream of files sees what arrives and not what has gone, so it only tells when to work; every micro-batch
runs the complete refresh, which marks absent archives and makes exactly what is missing.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lodestrata.functions import paths


def arrivals(spark: SparkSession, root: str) -> DataFrame:
    """Path, size and time of each new archive; contents aren't read."""
    glob = "*[tT][rR][aA][nN][sS][pP][oO][rR][tT][rR][sS][mM].[fF][pP][kK][gG].[eE]2[dD].[zZ][iI][pP]"
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return files.select("path", "length", "modificationTime").filter(paths.archive_key(files["path"]).isNotNull())


def watch(spark: SparkSession, root: str, checkpoint: str, refresh: Callable[[], object], every: str | None = "1 minute") -> StreamingQuery:
    """Calls ``refresh`` for each micro-batch with arrivals; with ``every`` None once for all there is."""

    def work(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            refresh()

    writer = arrivals(spark, root).writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()
