"""File sources and sinks.

Readers take explicit schemas so that no inference pass runs and types are
stable; Parquet scans keep Spark's column pruning and filter pushdown (the
caller selects/filters after the read, Catalyst pushes both into the scan).
"""

from __future__ import annotations

import csv
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import bounded_broadcast


def read_parquet(spark: SparkSession, path: str | list[str],
                 schema: T.StructType | None = None) -> DataFrame:
    """Parquet file, directory or list of paths."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_parquet_glob(spark: SparkSession, pattern: str, base_path: str | None = None,
                      schema: T.StructType | None = None) -> DataFrame:
    """All Parquet files matching a glob (e.g. every monthly file of a year).

    ``base_path`` keeps ``key=value`` directory names as partition columns
    when the glob reaches below the table root.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.parquet(pattern)


# What a scan knows of every row: its file (resolved path, length, time) and its place there.
PLACE = {"_file": "_metadata.file_path", "_length": "_metadata.file_size",
         "_modified": "_metadata.file_modification_time", "_row": "_metadata.row_index"}
ROWS_OF_A_FILE = 33  # bits of an id; file numbers take the 30 above


def with_place(df: DataFrame) -> DataFrame:
    """A Parquet scan (batch or stream) with the columns of ``PLACE``."""
    return df.select("*", *[F.expr(v).alias(k) for k, v in PLACE.items()])


def files_of(placed: DataFrame) -> DataFrame:
    """``path, length, modified`` of the files that the rows of a scan lie in: one row per file,
    whatever way the folder was spelled."""
    files = placed.select("_file", "_length", "_modified").distinct()  # first, as rows are many
    return files.select(F.regexp_replace("_file", "^file:/+", "file:/").alias("path"),
                        F.col("_length").alias("length"),
                        F.col("_modified").alias("modified")).distinct()


def numbered_files(files: DataFrame, first: int = 0) -> DataFrame:
    """``files`` with ``file_no``, counted from ``first`` in the order of paths. One task sees a
    row per file, as the driver does when it plans the scan."""
    place = F.row_number().over(Window.orderBy("path"))
    return files.withColumn("file_no", (place + F.lit(first - 1)).cast("long"))


def with_row_ids(placed: DataFrame, numbered: DataFrame, name: str = "_id") -> DataFrame:
    """Rows of the ``numbered`` files with an id made of the file's number and the row's place
    in it, so that another run over the same files gives the same ids."""
    path = F.regexp_replace("_file", "^file:/+", "file:/")
    lookup = bounded_broadcast(numbered.select(F.col("path").alias("_path"), "file_no"))
    row_id = F.shiftleft(F.col("file_no"), ROWS_OF_A_FILE) + F.col("_row")
    return (placed.withColumn(name, path).join(lookup, F.col(name) == F.col("_path"))
            .withColumn(name, row_id).drop("_path", "file_no", *PLACE))


def read_csv(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
             schema: T.StructType | None = None, infer: bool = False,
             quote: str = '"', escape: str = '"', encoding: str = "UTF-8") -> DataFrame:
    """Delimited text with a declared schema (``infer=True`` for exploration)."""
    reader = (spark.read.option("sep", sep).option("header", header)
              .option("quote", quote).option("escape", escape).option("encoding", encoding))
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


class CsvRows(NamedTuple):
    """What :func:`read_csv_by_name` found."""
    rows: DataFrame      # the declared columns
    rejected: DataFrame  # file, block, row (place), record, reason


REJECTED = "file string, block long, row long, record string, reason string"


def read_csv_by_name(spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = ",",
                     multiline: bool = False, quote: str = '"', escape: str = '"',
                     encoding: str = "UTF-8") -> CsvRows:
    """Delimited text with a header in every file, bound to ``schema`` by the header's names.

    Files may order their columns differently and have more of them; a declared column
    that a header lacks, or a name that it holds twice, is an error. Records with too few or too
    many fields, and records with a value that is not of the declared type, go to ``rejected``
    with their place; an empty field is NULL. With ``multiline`` quoted fields may hold line
    breaks, and a file is then read by one task.
    """
    options = {"sep": sep, "quote": quote, "escape": escape, "encoding": encoding}
    groups: dict[tuple, list[str]] = {}
    for file, header in _headers(spark, path, options):
        groups.setdefault(header, []).append(file)
    found: list[tuple[DataFrame, DataFrame]] = []
    for header, files in groups.items():
        missing = [c for c in schema.fieldNames() if c not in header]
        twice = sorted({c for c in header if header.count(c) > 1})
        if missing or twice:
            raise ValueError(f"header of {files[0]}: columns missing {missing}, repeated {twice}")
        found.append(_bound(spark, files, header, schema, options, multiline))
    if not found:  # no file, or empty ones
        return CsvRows(spark.createDataFrame([], schema), spark.createDataFrame([], REJECTED))
    return CsvRows(*[reduce(DataFrame.unionByName, parts) for parts in zip(*found)])


def _headers(spark: SparkSession, path: str | list[str], options: dict) -> list[tuple[str, tuple]]:
    """(file, names of its first line), one per file, as the driver plans files too."""
    lines = read_text_lines(spark, path, options["encoding"]).where("block = 0 and value <> ''")
    first = lines.groupBy("file").agg(F.min_by("value", "row").alias("line"))
    out = []
    for r in sorted(first.toLocalIterator(), key=lambda r: r.file):
        names = next(csv.reader([r.line.lstrip("\ufeff")], delimiter=options["sep"],
                                quotechar=options["quote"]))
        out.append((r.file, tuple(n.strip() for n in names)))
    return out


def _bound(spark: SparkSession, files: list[str], header: tuple, schema: T.StructType, options: dict,
           multiline: bool) -> tuple[DataFrame, DataFrame]:
    """Good and rejected records of files with one header."""
    raw = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))]
                       + [T.StructField("torn", T.StringType())])
    read = (spark.read.schema(raw).options(**options, header=True, multiLine=multiline,
                                           mode="PERMISSIVE", columnNameOfCorruptRecord="torn")
            .csv(files))
    cells = {name: F.col(f"c{i}") for i, name in enumerate(header)}
    typed = {f.name: _typed(cells[f.name], f.dataType) for f in schema.fields}
    wrong = [F.when(cells[f.name].isNotNull() & typed[f.name].isNull(),
                    F.lit(f"{f.name}: not {f.dataType.simpleString()}")) for f in schema.fields]
    reason = F.when(F.col("torn").isNotNull(), F.lit("number of fields")).otherwise(
        F.nullif(F.concat_ws("; ", *wrong), F.lit("")))
    record = F.coalesce("torn", F.to_csv(F.struct(*raw.fieldNames()[:-1]), {"sep": options["sep"]}))
    judged = read.withColumns({
        "reason": reason, "record": record, "file": F.col("_metadata.file_path"),
        "block": F.col("_metadata.file_block_start"), "row": F.monotonically_increasing_id()})
    good = judged.where("reason is null").select(*[v.alias(k) for k, v in typed.items()])
    return good, judged.where("reason is not null").select("file", "block", "row", "record", "reason")


def _typed(cell: Column, kind: T.DataType) -> Column:
    """The value of a field, NULL if it is not of the type (a fraction is not an integer)."""
    if isinstance(kind, T.StringType):
        return cell
    cell = F.trim(cell)
    if isinstance(kind, T.IntegralType):
        cell = F.when(cell.rlike(r"^[+-]?[0-9]+$"), cell)
    return cell.try_cast(kind)


def read_text_lines(spark: SparkSession, path: str | list[str],
                    encoding: str | None = None) -> DataFrame:
    """Lines of text files with a position that preserves file order.

    Columns: ``value``, ``file`` (path), ``block`` (byte offset of the split
    the line was read from) and ``row`` (increasing within a split). Sorting
    by ``(file, block, row)`` restores the order of the text without putting
    the file through one task: splits are read in parallel and each line
    keeps its place by its split offset and its rank inside the split.
    """
    paths = [path] if isinstance(path, str) else path
    reader = spark.read.option("encoding", encoding) if encoding else spark.read
    return (reader.text(paths)
            .select("value",
                    F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row")))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None, row_group_bytes: int | None = None) -> str:
    """Parquet write; full overwrite by default, as for the star tables. A scan can split a file
    between row groups only: smaller ones (``row_group_bytes``) let more tasks read few files.

    An overwrite replaces the whole table, whatever ``partitionOverwriteMode``
    the session has (the streaming refresh asks for dynamic overwrite itself).
    """
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
    return path


def write_bucketed_table(df: DataFrame, table: str, path: str, buckets: int,
                         keys: list[str], partition_by: list[str] | None = None) -> str:
    """Write ``df`` as a catalog table bucketed and sorted by ``keys``.

    Two tables bucketed the same way on their join key join without a
    shuffle on either side (read them with ``spark.table``). The data lives
    at ``path``; the catalog entry records the bucketing.
    """
    writer = (df.write.mode("overwrite").option("path", path)
              .option("partitionOverwriteMode", "static"))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return path


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True,
              mode: str = "overwrite") -> str:
    """Delimited text with a header; quotes doubled inside quoted fields."""
    (df.write.mode(mode).option("sep", sep).option("header", header)
     .option("quote", '"').option("escape", '"').csv(path))
    return path


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One string column as text lines."""
    df.write.mode(mode).text(path)
    return path
