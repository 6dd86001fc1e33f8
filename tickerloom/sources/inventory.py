"""The files of a folder as a table, and reads that join it instead of planning by file.

Each version of the inventory adds the files that are new since the one before: their path,
size, time, rank among copies, first line, and whether they hold anything. First lines are
read of new files only. A read is one scan of lines for any number of files and headers: the
inventory is joined to the lines, and tells how many fields a line of the file must have and
where each column stands. The driver holds a row for each different header, never a path.

Stored under the inventory's path by commits. A file that was changed since is another one,
that the next version takes up; until then reads leave it out, as they do later files.
"""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.functions.names import snake
from tickerloom.sources import commits
from tickerloom.sources.delimited import CORRUPT, TAPE_COLUMNS, file_age_rank, first_lines
from tickerloom.sources.workspace import materialise, shared_folder

FILES = ("file string, size long, modified timestamp, source_rank long, header string, "
         "state string")
#: Up to so many files (a path, a time and a list of places each) the inventory is broadcast.
BROADCAST_FILES = 100_000
FILE, MODIFIED = "_metadata.file_path", "_metadata.file_modification_time"


def stored_files(spark: SparkSession, path: str, before: int | None = None,
                 version: int | None = None) -> DataFrame:
    """The inventory as its newest version, or that before `before`, left it; or the files
    that `version` added alone."""
    named = (commits.entries(spark, path, before) if version is None
             else commits.folders_of(spark, path, version))
    if not named:
        return spark.createDataFrame([], FILES)
    return spark.read.schema(FILES).parquet(*[f"{path}/{folder}" for _, folder in named])


def take_stock(spark: SparkSession, folder: str, path: str, n: int,
               pattern: str = "*.csv") -> DataFrame:
    """Version `n` of the inventory at `path`: the files under `folder` that it lacks.

    Returns these. Without any there is no version. Spark lists no file without bytes; one
    with blank lines alone is `empty`. Of new files the first block is read for
    the first line; files older than the oldest new one are not opened.
    """
    if commits.is_committed(spark, path, n):
        return stored_files(spark, path, version=n)
    options = {"pathGlobFilter": pattern, "recursiveFileLookup": True}
    listed = spark.read.format("binaryFile").options(**options).load(folder).select(
        F.col(FILE).alias("file"), F.col("length").alias("size"),
        F.col(MODIFIED).alias("modified"), file_age_rank().alias("source_rank"))
    key = ["file", "size", "modified"]
    new = materialise(listed.join(stored_files(spark, path, before=n), key, "left_anti"),
                      shared_folder(spark, "new-files"))
    oldest = new.agg(F.unix_micros(F.min("modified"))).first()[0]
    if oldest is None:
        return spark.createDataFrame([], FILES)
    lines = spark.read.options(**options).text(folder).filter(
        (F.col(MODIFIED) >= F.timestamp_micros(F.lit(oldest))) & (F.trim("value") != ""))
    first = first_lines(lines).withColumnRenamed("line", "header")
    rows = new.join(first, "file", "left").withColumn(
        "state", F.when(F.col("header").isNull(), "empty").otherwise("data"))
    made = f"data/commit={n}/part=files"
    rows.select([c.split(" ")[0] for c in FILES.split(", ")]).write.mode("overwrite").parquet(
        f"{path}/{made}")
    commits.write_log(spark, path, n, commits.entries(spark, path, before=n) + [("files", made)])
    return stored_files(spark, path, version=n)


def names_of(header: str, sep: str) -> list[str]:
    """The columns of a first line, normalised. One without a name is called by its place, as
    are names that occur twice."""
    raw = [x or f"_c{i}" for i, x in enumerate(next(csv.reader([header], delimiter=sep)))]
    held = Counter(x.lower() for x in raw)
    return [snake(f"{x}{i}" if held[x.lower()] > 1 else x) for i, x in enumerate(raw)]


def read_listed(spark: SparkSession, folder: str, path: str, sep: str = ",",
                needed: tuple[str, ...] = (), version: int | None = None,
                pattern: str = "*.csv") -> DataFrame:
    """The rows of the listed files under `folder` as `read_text_columns` gives them: text by
    name, malformed lines kept aside, the rank of each row's file.

    With `version` only the files that it added, and of the others no file is opened whose
    time is not among theirs. The lines of files without a column of `needed`, the first one
    too, come as malformed ones.
    """
    files = stored_files(spark, path, version=version).filter("state = 'data'")
    found = files.groupBy("header").agg(
        F.count("*").alias("n"), F.unix_micros(F.min("modified")).alias("oldest"),
        F.unix_micros(F.max("modified")).alias("newest")).collect()
    found.sort(key=lambda r: (-r["n"], r["header"]))
    heads = {r["header"]: names_of(r["header"], sep) for r in found}
    usable = {h: names for h, names in heads.items() if set(needed) <= set(names)}
    columns = list(dict.fromkeys(c for names in usable.values() for c in names)) or list(needed)
    if not found:
        return spark.createDataFrame([], T.StructType(
            [T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]]
            + [T.StructField("source_rank", T.LongType())]))
    places = spark.createDataFrame(
        [(h, len(names) if h in usable else None,
          [names.index(c) if c in names else None for c in columns])
         for h, names in heads.items()], "header string, width int, places array<int>")
    placed = files.join(F.broadcast(places), "header")
    listed = placed.select(F.col("file").alias("_file"), F.col("modified").alias("_modified"),
                           "width", "places", "source_rank")
    if sum(r["n"] for r in found) <= BROADCAST_FILES:
        listed = F.broadcast(listed)
    lines = _lines(spark, folder, pattern).filter(F.col("_modified").between(
        F.timestamp_micros(F.lit(min(r["oldest"] for r in found))),
        F.timestamp_micros(F.lit(max(r["newest"] for r in found)))))
    rows = lines.join(listed, ["_file", "_modified"])
    parsed = rows.select("line", "places", "source_rank", _fields(usable, sep).alias("fields"))
    good = F.col("fields.bad").isNull() & F.col("fields").isNotNull()
    read = parsed.select(
        *[F.get("fields.values", F.get("places", F.lit(i))).alias(c)
          for i, c in enumerate(columns)],
        F.when(~good, F.col("line")).alias(CORRUPT), "source_rank")
    if len(usable) == len(heads):
        return read
    first = placed.filter("width IS NULL").select(
        *[F.lit(None).cast("string").alias(c) for c in columns],
        F.col("header").alias(CORRUPT), "source_rank")
    return read.unionByName(first)


def _lines(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Lines less the first of each file, with the file and its time.

    Read as one field up to a separator that no text has, or else as a malformed line."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("_line", CORRUPT)])
    reader = (
        spark.read.schema(schema)
        .option("header", True).option("enforceSchema", True).option("columnPruning", False)
        .option("sep", "\u0001").option("quote", "").option("escape", "")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    )
    return reader.csv(folder).select(
        F.coalesce(CORRUPT, "_line").alias("line"), F.col(FILE).alias("_file"),
        F.col(MODIFIED).alias("_modified"))


def _fields(usable: dict[str, list[str]], sep: str) -> Column:
    """values and bad of a line: its fields, and the line if they are not `width`; null for
    lines of other files. One parser for each width, however many headers have it."""
    found = F.lit(None).cast("struct<values: array<string>, bad: string>")
    for width in sorted({len(names) for names in usable.values()}):
        fields = [f"f{i}" for i in range(width)]
        schema = ", ".join(f"{f} string" for f in [*fields, CORRUPT])
        parsed = F.from_csv("line", schema, {
            "sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
        # a lambda names the parsed line, which then is parsed once
        split = F.transform(F.array(parsed), _values_and_bad(fields))
        found = F.when(F.col("width") == width, F.get(split, F.lit(0))).otherwise(found)
    return found


def _values_and_bad(fields: list[str]) -> Callable[[Column], Column]:
    return lambda parsed: F.struct(F.array(*[parsed[f] for f in fields]).alias("values"),
                                   parsed[CORRUPT].alias("bad"))


def read_listed_tape(spark: SparkSession, folder: str, path: str,
                     version: int | None = None) -> DataFrame:
    """As `read_tape` over the listed files, or those of one version."""
    return read_listed(spark, folder, path, needed=TAPE_COLUMNS, version=version).select(
        *TAPE_COLUMNS, CORRUPT, "source_rank")
