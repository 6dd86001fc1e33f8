"""The curated tape kept up to date from deliveries, the newest of each row counting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickerloom.sources import ledger
from tickerloom.sources.files import child_folders
from tickerloom.sources.routing import ACCEPTED, read_route
from tickerloom.streaming.ingest import batch_folder, ingest_files, new_files


def append_commit(batch_id: int) -> int:
    """Number of the commit that adds a batch; the next is its compaction."""
    return 2 * batch_id


def take_delivery(rows: DataFrame, batch_id: int, path: str,
                  folders: int = ledger.FOLDERS) -> list[str]:
    """Add one batch of rows to the ledger at `path`; the months it touches.

    Months that thereby hold `folders` deliveries are compacted, so a batch writes its
    own rows, and now and then a month.
    """
    months = ledger.append(rows, path, append_commit(batch_id))
    ledger.compact(rows.sparkSession, path, append_commit(batch_id) + 1, folders)
    return months


def merge_files(files: DataFrame, batch_id: int, routed_path: str, curated_path: str) -> None:
    """Route the files of a batch and add their good rows to the ledger.

    A batch that fails leaves the table as it was, and does the same when run again.
    """
    spark = files.sparkSession
    ingest_files(files, batch_id, routed_path)
    routed = batch_folder(routed_path, batch_id)
    if any(name.startswith("route=") for name in child_folders(spark, routed)):
        take_delivery(read_route(spark, routed, ACCEPTED), batch_id, curated_path)


def start_curation(spark: SparkSession, folder: str, routed_path: str, curated_path: str,
                   checkpoint: str, files_per_batch: int = 1000,
                   archive: str | None = None) -> StreamingQuery:
    """Add the new files under `folder` to the ledger `curated_path` until all are done.

    Columns are matched by name, file by file. `ledger.read_current` reads the result. One
    checkpoint belongs to one `curated_path`, for batches number the commits.
    """
    return (
        new_files(spark, folder, files_per_batch, archive)
        .writeStream.foreachBatch(
            lambda batch, n: merge_files(batch, n, routed_path, curated_path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_newest(tape: DataFrame, curated_path: str, checkpoint: str) -> StreamingQuery:
    """Keep the newest delivery of each (ticker, date) of a stream of typed tape rows with
    `source_rank`, in the ledger at `curated_path`.

    No state and no watermark: a correction counts however late it comes, and memory does
    not grow with the history.
    """
    return (
        tape.writeStream.foreachBatch(lambda batch, n: _keep(batch, n, curated_path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _keep(batch: DataFrame, batch_id: int, path: str) -> None:
    take_delivery(batch, batch_id, path)
