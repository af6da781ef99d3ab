"""Documents that arrive in a folder, as a stream: an extension over the batch reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.sources.reader import MAX_BYTES, parse_documents

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def stream_documents(spark: SparkSession, folder: str, form: str = "auto", max_files: int = 1000, max_bytes: int = MAX_BYTES) -> DataFrame:
    """A streaming DataFrame of result rows; each file is read once, ``max_files`` a trigger."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", max_files).load(folder)
    return parse_documents(files, form, max_bytes=max_bytes)
