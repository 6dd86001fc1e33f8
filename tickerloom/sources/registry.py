"""A stored schema of a folder of delimited files, brought up to date by its new files.

The type of a column is the least of a lattice that holds all its values. A value has a
bit for each type that can hold it, so a column's bits are those that all values share, and
the bits of two sets of files merge by `and`. One aggregate over the new files gives the
bits of all columns; files that were looked at before are not opened again.

Stored under the registry's path, by commits: the files looked at (path, size, time), added
to by every version, and the columns with their bits, as of each version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.sources import commits
from tickerloom.sources.delimited import CORRUPT, read_text_columns

#: From the narrowest; a column without values is a string.
TYPES = ["boolean", "int", "bigint", "double", "date", "timestamp", "string"]
BITS = {name: 1 << i for i, name in enumerate(TYPES)}
ALL = sum(BITS.values())

FILES = "path string, size long, modified timestamp"
COLUMNS = "column string, position int, bits int, filled long"
CHANGES = "column string, change string, was string, now string, example string"


def value_bits(text: Column) -> Column:
    """The types that hold a value, as bits; all of them for a missing one."""
    value = F.trim(text)
    whole = value.rlike(r"^[+-]?\d+$")
    number = value.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    real = value.try_cast("double")
    holds = {
        "boolean": F.lower(value).isin("true", "false"),
        "int": whole & value.try_cast("int").isNotNull(),
        "bigint": whole & value.try_cast("bigint").isNotNull(),
        "double": number & real.isNotNull() & (F.abs(real) < float("inf")),
        "date": value.rlike(r"^\d{4}-\d{2}-\d{2}$") & value.try_cast("date").isNotNull(),
        "timestamp": value.rlike(r"^\d{4}-\d{2}-\d{2}([ T].+)?$")
        & value.try_cast("timestamp").isNotNull(),
    }
    bits = F.lit(BITS["string"])
    for name, held in holds.items():
        bits = bits.bitwiseOR(F.when(held, BITS[name]).otherwise(0))
    return F.when(value.isNull() | (value == ""), ALL).otherwise(bits)


def type_of(bits: int, filled: int) -> str:
    """The narrowest type of the bits."""
    return next(name for name in TYPES if bits & BITS[name]) if filled else "string"


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder; their content is not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
             .option("recursiveFileLookup", True).load(folder))
    return files.select("path", F.col("length").alias("size"),
                        F.col("modificationTime").alias("modified"))


def _part(spark: SparkSession, path: str, which: str, schema: str,
          before: int | None = None) -> DataFrame:
    named = [e for e in commits.entries(spark, path, before) if e[0] == which]
    if not named:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{folder}" for _, folder in named])


def new_files(spark: SparkSession, folder: str, path: str,
              before: int | None = None) -> DataFrame:
    """Files under `folder` that the registry at `path` has not looked at in this form."""
    return _listed(spark, folder).join(
        _part(spark, path, "files", FILES, before), ["path", "size", "modified"], "left_anti")


def _stored(spark: SparkSession, path: str, before: int | None = None) -> dict[str, tuple]:
    """column: (position, bits, filled), in the order of the columns."""
    rows = _part(spark, path, "columns", COLUMNS, before).collect()
    return {r["column"]: (r["position"], r["bits"], r["filled"])
            for r in sorted(rows, key=lambda r: r["position"])}


def discover(spark: SparkSession, folder: str, path: str, n: int,
             sep: str = ",") -> DataFrame:
    """Version `n` of the registry at `path`: take the new files of `folder` into account.

    Returns what changed: columns `added` (with their type), `widened` (the type before,
    the type now and a value that the one before does not hold) and `missing` (in no new
    file). Without new files nothing is read and nothing changes. The driver holds the
    paths of the new files and a row per column.
    """
    was = _stored(spark, path, before=n)
    found = new_files(spark, folder, path, before=n).collect()
    if not found or commits.is_committed(spark, path, n):
        return spark.createDataFrame([], CHANGES)
    rows = read_text_columns(spark, [r["path"] for r in found], sep)
    names = [c for c in rows.columns if c not in (CORRUPT, "source_rank")]
    wanted = []
    for i, name in enumerate(names):
        value = F.col(f"`{name}`")
        held = BITS[type_of(*was[name][1:])] if name in was else ALL
        short = value_bits(value).bitwiseAND(F.lit(held)) == 0
        wanted += [F.bit_and(value_bits(value)).alias(f"bits{i}"),
                   F.count(F.nullif(F.trim(value), F.lit(""))).alias(f"filled{i}"),
                   F.min(F.when(short, value)).alias(f"example{i}")]
    seen = rows.agg(*wanted).first()
    now, changes = dict(was), []
    for i, name in enumerate(names):
        bits = seen[f"bits{i}"]
        bits, filled = ALL if bits is None else bits, seen[f"filled{i}"]
        if name not in was:
            now[name] = (len(now), bits, filled)
            changes.append((name, "added", None, type_of(bits, filled), None))
            continue
        position, old_bits, old_filled = was[name]
        now[name] = (position, old_bits & bits, old_filled + filled)
        before, after = type_of(old_bits, old_filled), type_of(*now[name][1:])
        if before != after and old_filled:
            changes.append((name, "widened", before, after, seen[f"example{i}"]))
        elif before != after:
            changes.append((name, "typed", before, after, None))
    changes += [(name, "missing", type_of(*was[name][1:]), type_of(*was[name][1:]), None)
                for name in was if name not in names]
    _write(spark, path, n, spark.createDataFrame(
        [(r["path"], r["size"], r["modified"]) for r in found], FILES), now)
    return spark.createDataFrame(changes, CHANGES)


def _write(spark: SparkSession, path: str, n: int, files: DataFrame,
           columns: dict[str, tuple]) -> None:
    known = [e for e in commits.entries(spark, path, before=n) if e[0] == "files"]
    table = spark.createDataFrame([(name, *found) for name, found in columns.items()], COLUMNS)
    made = []
    for part, rows in (("files", files), ("columns", table)):
        folder = f"data/commit={n}/part={part}"
        rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/{folder}")
        made.append((part, folder))
    commits.write_log(spark, path, n, known + made)


def schema_of(spark: SparkSession, path: str) -> T.StructType:
    """The columns and types of the newest version."""
    return T.StructType([T.StructField(name, T._parse_datatype_string(type_of(bits, filled)))
                         for name, (_, bits, filled) in _stored(spark, path).items()])


def read_registered(spark: SparkSession, folder: str, path: str, sep: str = ",") -> DataFrame:
    """Rows under the registered schema, without a look at their types. `folder` may be a
    pattern, and should name every level that `discover` went through.

    Columns are matched by name. A value of a file not yet registered that its column's
    type does not hold is null; `discover` tells of it.
    """
    rows = read_text_columns(spark, folder, sep)
    columns = []
    for field in schema_of(spark, path):
        text = F.col(f"`{field.name}`") if field.name in rows.columns else F.lit(None)
        kept = text if field.dataType == T.StringType() else F.trim(text)
        columns.append(kept.try_cast(field.dataType).alias(field.name))
    return rows.select(*columns)
