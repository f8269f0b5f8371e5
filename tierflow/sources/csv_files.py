"""CSV folders. Every value is read as text; the conform step casts."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import null_if_token
from .csv_split import line_records, records

SEQ = "_seq"
_BOM = "﻿"
_SEPARATORS = (",", ";", "\t", "|")
#: Bytes from which a file with line breaks in cells is read by many tasks; the rows are the same.
SPLIT_BYTES = 64 << 20


@dataclass(frozen=True)
class CsvFile:
    path: str
    modified: object
    header: str
    length: int = 0

    @property
    def stem(self) -> str:
        return self.path.rsplit("/", 1)[-1].rsplit(".", 1)[0]

    @property
    def table_name(self) -> str:
        return self.stem.replace("%20", "_").replace(" ", "_").lower()

    @property
    def separator(self) -> str:
        return guess_separator(self.header)

    @property
    def columns(self) -> list[str]:
        return header_cells(self.header, self.separator)


def header_cells(header: str, separator: str) -> list[str]:
    """Header cells by the rules of quoted CSV: a separator inside quotes belongs to its cell."""
    return [clean_name(c) for c in next(csv.reader([header], delimiter=separator), [])]


def clean_name(name: str) -> str:
    return name.strip().replace(_BOM, "").strip()


def guess_separator(header: str) -> str:
    """The candidate that occurs most outside quotes in the header line."""
    bare = "".join(part for i, part in enumerate(header.split('"')) if i % 2 == 0)
    return max(_SEPARATORS, key=bare.count)


def literal_path(path: str) -> str:
    """The path with glob characters escaped, so that Spark reads this file and no other."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def list_csv_files(spark: SparkSession, folder: str, filter_text: str = "") -> list[CsvFile]:
    """Files with their header line, oldest first.

    Only file names and one line per file come to the driver; no file content is listed or scanned.
    """
    found = _first_lines(spark, spark.read.option("pathGlobFilter", "*.csv").text(folder))
    return [f for f in found if filter_text in f.path.rsplit("/", 1)[-1]]


def csv_files_at(spark: SparkSession, found: list[tuple[str, object]]) -> list[CsvFile]:
    """Files by path and time, with their header line, in the given order; empty ones are left out."""
    if not found:
        return []
    by_path = {f.path: f for f in _first_lines(spark, spark.read.text([literal_path(path) for path, _ in found]))}
    return [replace(by_path[path], modified=modified) for path, modified in found if path in by_path]


def _first_lines(spark: SparkSession, lines: DataFrame) -> list[CsvFile]:
    """The first line of each file that has one, by one read in which every task opens one slice of one file and stops after a line."""
    fields = {"path": "file_path", "modified": "file_modification_time", "length": "file_size", "block": "file_block_start"}

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    open_cost, slice_bytes = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(open_cost)
    spark.conf.set(open_cost, spark.conf.get(slice_bytes))  # a slice that seems this dear to open gets a task of its own
    try:
        told = lines.select(*[F.col(f"_metadata.{c}").alias(n) for n, c in fields.items()], "value")
        rows = told.mapInArrow(first, told.schema).filter("block = 0").collect()
    finally:
        spark.conf.set(open_cost, before)
    files = [CsvFile(_address(r["path"]), r["modified"], r["value"].lstrip(_BOM), r["length"]) for r in rows]
    return sorted(files, key=lambda f: (f.modified, f.path))


def _address(path: str) -> str:
    """A path from file metadata, where blanks and other characters are escaped, as readers take it."""
    return unquote(path)


def read_csv(
    spark: SparkSession,
    paths: list[str] | str,
    separator: str = ",",
    encoding: str = "ISO-8859-1",
    multi_line: bool | str = True,
) -> DataFrame:
    """Files with one and the same header as text columns plus the ``_seq`` order.

    ``multi_line`` allows line breaks inside quotes: ``True`` reads a file in one task, ``"split"`` large files in many, with the same rows,
    after a job that looks at their quotes; ``False`` is for files without such line breaks. ``_seq`` compares by file time, file name, position of the split and row.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    first = spark.read.text(literal_path(paths[0])).first()
    names = [] if first is None else header_cells(first["value"].lstrip(_BOM), separator)
    # The header gives the schema: inferring it would read a path with glob characters as a pattern.
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if multi_line == "split":
        if not line_records(spark, [literal_path(p) for p in paths]):
            return _read_split(spark, paths, schema, separator, encoding)
        multi_line = False
    reader = spark.read.schema(schema).options(
        header=True, sep=separator, encoding=encoding, quote='"', escape='"', multiLine=multi_line, mode="PERMISSIVE"
    )
    df = reader.csv([literal_path(p) for p in paths])
    sequence = F.struct(
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select(*[f"`{c}`" for c in df.columns], sequence.alias(SEQ))


def way(files: list[CsvFile]) -> bool | str:
    """How to read files whose cells may hold line breaks."""
    return "split" if max(f.length for f in files) > SPLIT_BYTES else True


def _read_split(spark: SparkSession, paths: list[str], schema: T.StructType, separator: str, encoding: str) -> DataFrame:
    found = records(spark, [literal_path(p) for p in paths], encoding).filter(~F.col("first") & (F.trim("record") != ""))
    options = {"sep": separator, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    places = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema))])
    cells = found.select("*", F.from_csv("record", places.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("cells"))
    sequence = F.struct("modified", F.col("name").alias("file"), "block", F.col("pos").alias("row"))
    return cells.select(*[F.col(f"cells.c{i}").alias(f.name) for i, f in enumerate(schema)], sequence.alias(SEQ))


def load_csv_folder(spark: SparkSession, folder: str, encoding: str = "ISO-8859-1") -> dict[str, DataFrame]:
    """One table per file, named after the file."""
    tables: dict[str, DataFrame] = {}
    for f in list_csv_files(spark, folder):
        if f.table_name in tables:
            raise ValueError(f"two files give table {f.table_name!r}")
        tables[f.table_name] = read_csv(spark, f.path, f.separator, encoding, way([f])).drop(SEQ)
    return tables


# Header columns that tell the kind of a feed, in the order they are tried.
QUIZ_COLUMNS = ["user_id", "data_fields", "value"]
SESSION_MARKS = ["email", "session_code"]
SESSION_COLUMNS = ["Email", "Session_Code", "Duration_in_hrs", "Duration_in_secs", "watched_on"]
ASSIGNMENT_COLUMNS = ["assignment_id", "submitted_at", "Email"]


def feed_kind(columns: list[str]) -> str | None:
    """Quiz first, then session (any case), then assignment; else unknown."""
    lowered = {c.lower() for c in columns}
    if not missing_columns(columns, QUIZ_COLUMNS):
        return "quiz"
    if not missing_columns(list(lowered), SESSION_MARKS):
        return "session"
    if not missing_columns(columns, ASSIGNMENT_COLUMNS):
        return "assignment"
    return None


def missing_columns(columns: list[str], required: list[str]) -> list[str]:
    return [c for c in required if c not in set(columns)]


@dataclass(frozen=True)
class Feed:
    """All files of one kind with one header."""

    kind: str
    rows: DataFrame
    files: tuple[str, ...]


#: Text that stands for a missing key, so that such a row meets itself when it is landed again.
MISSING_KEY = "NaN"


def route_by_header(
    spark: SparkSession, folder: str, filter_text: str = "", encoding: str = "ISO-8859-1", multi_line: bool = True,
    keys: dict[str, list[str]] | None = None,
) -> tuple[list[Feed], list[str]]:
    """One feed per kind and header, and the skipped files (unknown kind or missing columns).

    Files join one read only if their header is the same, so a column never lands under another column's
    name; ``_seq`` keeps the order of all files. ``keys``: key columns per kind; a missing value there becomes
    the text ``NaN``, elsewhere missing-value words become NULL.
    """
    return route_files(spark, list_csv_files(spark, folder, filter_text), encoding, multi_line, keys)


def route_files(
    spark: SparkSession, found: list[CsvFile], encoding: str = "ISO-8859-1", multi_line: bool = True,
    keys: dict[str, list[str]] | None = None,
) -> tuple[list[Feed], list[str]]:
    groups: dict[tuple[str, str], list[CsvFile]] = {}
    skipped = []
    for f in found:
        kind = feed_kind(f.columns)
        if kind is None or (kind == "session" and missing_columns(f.columns, SESSION_COLUMNS)):
            skipped.append(f.path)
        else:
            groups.setdefault((kind, f.header), []).append(f)
    feeds = []
    for (kind, _), files in sorted(groups.items(), key=lambda g: g[0][0]):
        rows = read_csv(spark, [f.path for f in files], files[0].separator, encoding, way(files) if multi_line is True else multi_line)
        feeds.append(Feed(kind, landed(rows, (keys or {}).get(kind, [])), tuple(f.path for f in files)))
    return feeds, skipped


def landed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Missing-value words as NULL outside the keys, and as one text inside them."""
    texts = [f.name for f in rows.schema if f.dataType.typeName() == "string" and f.name not in keys]
    cleaned = null_tokens(rows, texts)
    missing = {k: F.when(null_if_token(F.col(f"`{k}`"), ("NaN", "nan", "")).isNull(), MISSING_KEY).otherwise(F.col(f"`{k}`")) for k in keys if k in rows.columns}
    return cleaned.withColumns(missing) if missing else cleaned


def null_tokens(df: DataFrame, cols: list[str] | None = None, tokens: tuple[str, ...] = ("NaN", "nan", "")) -> DataFrame:
    """Turn missing-value words into NULL, in all text columns unless some are named."""
    texts = [f.name for f in df.schema if f.dataType.typeName() == "string"]
    named = texts if cols is None else cols
    return df.select(
        *[null_if_token(F.col(f"`{c}`"), tokens).alias(c) if c in named else F.col(f"`{c}`") for c in df.columns]
    )


def rows_source(spark: SparkSession, data: list[tuple], schema: str) -> DataFrame:
    """A few literal rows as a table."""
    return spark.createDataFrame(data, schema)
