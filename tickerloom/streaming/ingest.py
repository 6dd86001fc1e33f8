"""File streams: each new price file is read once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickerloom.functions.names import snake
from tickerloom.sources.delimited import CORRUPT, file_age_rank, read_tape
from tickerloom.sources.routing import route

TAPE_HEADER = ["Date", "Ticker", "Adj Close", "Dividends"]


def tape_stream(spark: SparkSession, folder: str, header: list[str] | None = None,
                files_per_batch: int = 1000, archive: str | None = None) -> DataFrame:
    """New `*.csv` files under `folder` as raw text rows, for stateful streams.

    `header` lists the columns of the files; a file with another one stops the stream.
    Where headers may differ, `start_ingest` over `new_files` matches them by name, and
    its output can be streamed on. With `archive` the files of a
    committed batch move there when the next one starts.
    """
    names = header or TAPE_HEADER
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnPruning", False)  # a pruned read does not count the fields of a line
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(folder).select(
        *[F.col(f"`{n}`").alias(snake(n)) for n in names], CORRUPT,
        file_age_rank().alias("source_rank"),
    )


def new_files(spark: SparkSession, folder: str, files_per_batch: int = 1000,
              archive: str | None = None) -> DataFrame:
    """Paths of the new `*.csv` files under `folder`; their content is not read here.

    With `archive` the files of a committed batch move there when the next one starts.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(folder).select("path")


def ingest_files(files: DataFrame, batch_id: int, path: str) -> None:
    """Route the rows of one batch of files into the batch's own folder under `path`.

    The files are read as a batch reads them: columns by name, and a file without the
    needed columns is quarantined line by line while the others go on. The driver holds
    the batch's paths, at most `files_per_batch`. A batch that runs twice replaces itself.
    """
    paths = [row["path"] for row in files.select("path").collect()]
    if not paths:
        return
    (
        route(read_tape(files.sparkSession, paths))
        .write.partitionBy("route")
        .mode("overwrite")
        .parquet(batch_folder(path, batch_id))
    )


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch={batch_id}"


def start_ingest(files: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Route the rows of `new_files` to `path` until all present files are done."""
    return (
        files.writeStream.foreachBatch(lambda batch, n: ingest_files(batch, n, path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
