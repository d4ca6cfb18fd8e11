"""Archives as they arrive: extraction and classification are stateless and stream as they are."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from evalspark.operators.classify import flag_outliers_and_ambiguous
from evalspark.operators.extract import extract_reports
from evalspark.sources.archives import ENTRY_SUFFIX, ZIP_GLOB, TextDecoder, decode_entries, expand_archives

#: The schema of Spark's binary files, which a stream has to be given.
BINARY_FILES = "path string, modificationTime timestamp, length long, content binary"


def stream_reports(spark: SparkSession, folder: str, decoder: TextDecoder, suffix: str = ENTRY_SUFFIX, files_per_trigger: int = 64) -> DataFrame:
    """A stream of report rows from the archives that arrive in a folder."""
    files = spark.readStream.format("binaryFile").schema(BINARY_FILES).option("pathGlobFilter", ZIP_GLOB).option("maxFilesPerTrigger", files_per_trigger).load(folder)
    return extract_reports(decode_entries(expand_archives(files, suffix), decoder), "text", "pdf_ok")


def to_table(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Appends a stream to a Parquet table, each file exactly once; ``once`` ends with what is there now."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()


def flags_by_batch(stream: DataFrame, history: str, publish: Callable[[DataFrame], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Classified sentences to ``history``, and their flags over all of it after each batch.

    Outliers depend on exact quartiles of whole topics, so they are computed
    anew; a batch that is repeated replaces its own part of the history.
    """

    def flag(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{history}/epoch={epoch}")
        publish(flag_outliers_and_ambiguous(batch.sparkSession.read.parquet(history).drop("epoch")))

    writer = stream.writeStream.foreachBatch(flag).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
