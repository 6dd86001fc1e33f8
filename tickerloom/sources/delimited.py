"""Delimited text: price tapes, membership snapshots, and any folder of such files."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.functions.names import normalise_names, snake

CORRUPT = "_corrupt_record"
TAPE_COLUMNS = ("ticker", "date", "adj_close", "dividends")


def first_lines(lines: DataFrame) -> DataFrame:
    """file and line: the first of the lines that each file has in its first block.

    `min_by` alone would sort all lines by their file. Beside a collected set it is a hash
    aggregate: a task holds one line for each of its files, and sorts only when it has more
    of them than `spark.sql.objectHashAggregate.sortBased.fallbackThreshold`.
    """
    numbered = lines.select(
        F.col("_metadata.file_path").alias("file"), "value",
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))  # grows along a file
    return (
        numbered.filter("block = 0")
        .groupBy("file")
        .agg(F.min_by("value", "at").alias("line"), F.collect_set("block").alias("blocks"))
        .filter(F.size("blocks") == 1)  # keeps the set, which else would be left out
        .drop("blocks")
    )


def files_by_header(spark: SparkSession, path: str | list[str]) -> list[list[str]]:
    """Files under `path` that share their first line, largest group first.

    The first block of each file is read for it. The driver holds one path for each
    file, as its own listing of the folder does.
    """
    first = first_lines(spark.read.text(path))
    groups = first.groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files"))
    found = [[unquote(f) for f in row["files"]] for row in groups.collect()]
    return sorted(found, key=lambda files: (-len(files), files))


def read_text_columns(spark: SparkSession, path: str | list[str], sep: str = ",",
                      header: list[str] | None = None,
                      needed: tuple[str, ...] = ()) -> DataFrame:
    """All columns as text under normalised names, malformed lines kept aside, and the
    rank of each row's file.

    Columns are matched by name: files may order them differently, have more, or lack
    some, which are null there. A file without a column of `needed` is put aside whole:
    its lines come as malformed ones. With `header` all files have that one header, and
    another one stops the read.
    """
    groups = [] if header else files_by_header(spark, path)
    if len(groups) < 2:
        names = header or spark.read.csv(path, sep=sep, header=True).columns
        return _one_header(spark, path, sep, names, needed)
    parts = [_one_header(spark, files, sep,
                         spark.read.csv(files[0], sep=sep, header=True).columns, needed)
             for files in groups]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def _one_header(spark: SparkSession, path: str | list[str], sep: str, names: list[str],
                needed: tuple[str, ...]) -> DataFrame:
    rank = file_age_rank().alias("source_rank")
    if not set(needed) <= {snake(n) for n in names}:
        missing = [F.lit(None).cast("string").alias(n) for n in needed]
        return spark.read.text(path).select(*missing, F.col("value").alias(CORRUPT), rank)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    raw = (
        spark.read.schema(schema)
        .option("enforceSchema", False)
        .option("columnPruning", False)  # a pruned read does not count the fields of a line
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path, sep=sep, header=True)
    )
    return raw.select(*[F.col(f"`{n}`").alias(snake(n)) for n in names], CORRUPT, rank)


def file_age_rank() -> F.Column:
    """Rank that prefers rows of newer files."""
    return -F.unix_micros(F.col("_metadata.file_modification_time"))


def read_tape(spark: SparkSession, path: str | list[str],
              header: list[str] | None = None) -> DataFrame:
    """Raw text tape: ticker, date, adj_close, dividends, rank of its file."""
    return read_text_columns(spark, path, header=header, needed=TAPE_COLUMNS).select(
        *TAPE_COLUMNS, CORRUPT, "source_rank")


def _snapshot_lines(spark: SparkSession, path: str) -> DataFrame:
    columns = ("symbol", "security", "gics_sector", "gics_sub_industry", "updatedat")
    return read_text_columns(spark, path, sep="|", needed=columns).select(
        *columns[:-1], F.col("updatedat").try_cast("timestamp").alias("updated_at"),
        "updatedat", CORRUPT)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Membership snapshots: pipe-separated, one file per collection run."""
    return _snapshot_lines(spark, path).drop("updatedat", CORRUPT)


def refused_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """reason and raw_row of the snapshot lines that belong to no collection run."""
    lines = _snapshot_lines(spark, path)
    fields = F.to_json(F.struct("symbol", "security", "gics_sector", "gics_sub_industry",
                                F.col("updatedat").alias("updated_at")))
    reason = (F.when(F.col(CORRUPT).isNotNull(), "malformed line")
              .when(F.col("updated_at").isNull(), "bad time"))
    return lines.select(reason.alias("reason"), F.coalesce(F.col(CORRUPT), fields).alias(
        "raw_row")).filter("reason IS NOT NULL")


def write_snapshots(universe: DataFrame, path: str) -> None:
    """Write a collection run as pipe-separated files in a folder named by its time.

    A run written again replaces its own folder only. Column names in the files are
    the ones that the reader expects.
    """
    (
        universe.select(
            F.col("symbol").alias("Symbol"),
            F.col("security").alias("Security"),
            F.col("gics_sector").alias("GICS Sector"),
            F.col("gics_sub_industry").alias("GICS Sub-Industry"),
            F.col("updated_at").cast("string").alias("updatedAt"),
            F.date_format("updated_at", "yyyy-MM-dd-HH-mm-ss").alias("run"),
        )
        .hint("rebalance", "run")  # few files per run, and several tasks for a large one
        .write.partitionBy("run")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .csv(path, sep="|", header=True)
    )


def write_tape(tape: DataFrame, path: str) -> None:
    """Write tape rows as comma-separated files with the collector's headers.

    With an `output_key` column each key has its own folder, and a key written again
    replaces it. Without one the rows are appended.
    """
    columns = [
        F.col("date").cast("string").alias("Date"),
        F.col("ticker").alias("Ticker"),
        F.col("adj_close").alias("Adj Close"),
        F.col("dividends").alias("Dividends"),
    ]
    if "output_key" in tape.columns:
        writer = (
            tape.select(*columns, "output_key")
            .hint("rebalance", "output_key")
            .write.partitionBy("output_key")
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
        )
    else:
        writer = tape.select(*columns).write.mode("append")
    writer.csv(path, header=True)


def register_folder(spark: SparkSession, path: str, name: str, sep: str = ",") -> DataFrame:
    """Infer the columns of a folder of files and register it as a temporary view.

    All rows are looked at for the types. Columns are matched by name; a column whose
    type differs between files of different headers stays text.
    """
    groups = files_by_header(spark, path)
    sources = groups if len(groups) > 1 else [path]
    found = [spark.read.csv(s, sep=sep, header=True, inferSchema=True) for s in sources]
    if len(found) > 1:
        kinds: dict[str, set[T.DataType]] = {}
        for part in found:
            for field in part.schema:
                kinds.setdefault(snake(field.name), set()).add(field.dataType)
        for i, part in enumerate(found):
            schema = T.StructType([
                f if len(kinds[snake(f.name)]) == 1 else T.StructField(f.name, T.StringType())
                for f in part.schema])
            found[i] = spark.read.schema(schema).csv(sources[i], sep=sep, header=True)
    named = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True),
                   [normalise_names(part) for part in found])
    named.createOrReplaceTempView(name)
    return named
