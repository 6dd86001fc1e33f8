"""A table that grows by commits, with a log of the folders that count.

    <path>/data/commit=<n>/<part>=<value>/    rows, written once and never changed
    <path>/log/<n>                            text: every (part, folder) that counts

A commit writes its rows first and its log file last, and that file appears by one rename:
until then readers see the log before it, and a commit that failed in between is run again
under its number. A reader opens the newest log and the folders it names, so neither older
versions nor the leftovers of failed commits are listed. A log has a row for each folder,
so its size depends on the parts and on how often they are compacted, not on the rows.

One writer at a time; a number belongs to one set of rows, so a commit that is complete is
not run again.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from tickerloom.sources.files import child_folders, delete, file_names, read_text, write_text

#: (part, folder under the table's path)
Entries = list[tuple[str, str]]


def _logged(spark: SparkSession, path: str, n: int) -> Entries:
    """What log `n` names."""
    lines = read_text(spark, f"{path}/log/{n}").splitlines()
    return sorted((part, folder) for part, folder in (x.split("\t") for x in lines))


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Complete commits: a log that is still being written has another name."""
    return sorted(int(name) for name in file_names(spark, f"{path}/log") if name.isdigit())


def entries(spark: SparkSession, path: str, before: int | None = None) -> Entries:
    """What the newest complete commit names, of those numbered below `before`."""
    complete = [n for n in _numbers(spark, path) if before is None or n < before]
    return _logged(spark, path, complete[-1]) if complete else []


def is_committed(spark: SparkSession, path: str, n: int) -> bool:
    return n in _numbers(spark, path)


def folders_of(spark: SparkSession, path: str, n: int) -> Entries:
    """Parts and folders that commit `n` wrote."""
    names = [x for x in child_folders(spark, f"{path}/data/commit={n}") if "=" in x]
    return [(name.split("=", 1)[1], f"data/commit={n}/{name}") for name in names]


def write_rows(rows: DataFrame, path: str, n: int, part: str, order: list[str]) -> Entries:
    """Write the rows of commit `n` into a folder for each value of `part`."""
    (
        rows.hint("rebalance", part)
        .sortWithinPartitions(part, *order)
        .write.partitionBy(part).mode("overwrite").parquet(f"{path}/data/commit={n}")
    )
    return folders_of(rows.sparkSession, path, n)


def write_log(spark: SparkSession, path: str, n: int, current: Entries) -> None:
    """Complete commit `n`: from now on `current` is the table."""
    write_text(spark, f"{path}/log/{n}", "".join(f"{part}\t{folder}\n" for part, folder in current))


def open_folders(spark: SparkSession, path: str, named: Entries, schema: str) -> DataFrame:
    """Rows of the folders as they lie there; `schema` has the part's column too."""
    if not named:
        return spark.createDataFrame([], schema)
    of_commit: dict[int, list[str]] = {}
    for _, folder in named:
        of_commit.setdefault(int(folder.split("/")[1].split("=")[1]), []).append(folder)
    places = []
    for n, folders in of_commit.items():
        # A commit of which all counts is one place to list instead of many.
        whole = len(folders) > 1 and len(folders) == len(folders_of(spark, path, n))
        places += [f"data/commit={n}"] if whole else folders
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(
        *[f"{path}/{place}" for place in places]).drop("commit")


def split_by_folders(named: Entries, folders: int = 2) -> tuple[Entries, Entries]:
    """The entries of parts with fewer than `folders` folders, and those of the others."""
    held = Counter(part for part, _ in named)
    return ([e for e in named if held[e[0]] < folders],
            [e for e in named if held[e[0]] >= folders])


def expire(spark: SparkSession, path: str, keep: int = 4) -> list[str]:
    """Delete all but the `keep` newest complete logs, and the folders that none of these
    names. Returns the folders.

    A reader that opened an older log may fail. Data of commits after the newest log,
    which may be in the making, stays.
    """
    complete = _numbers(spark, path)
    kept = complete[-keep:]
    if not kept:
        return []
    named = {folder for n in kept for _, folder in _logged(spark, path, n)}
    # Logs go first: none that is left names a folder that is gone.
    for n in complete[:-keep]:
        delete(spark, f"{path}/log/{n}")
    gone = []
    for commit in child_folders(spark, f"{path}/data"):
        n = int(commit.split("=")[1])
        if n > kept[-1]:
            continue
        written = [folder for _, folder in folders_of(spark, path, n)]
        unused = [folder for folder in written if folder not in named]
        for folder in [f"data/{commit}"] if len(unused) == len(written) else unused:
            delete(spark, f"{path}/{folder}")
        gone += unused
    return gone
