"""What several operators share: word patterns, batch sizes and reads of text columns."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.session import scratch_path, stored  # noqa: F401  (operators cut lineage with `stored`)

#: Characters between words, and the pattern of a word.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: Rows and bytes of an Arrow batch; texts may be long, so rows alone bound nothing.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20


def filesystem_of(path: str):
    """The file system of a path or address, for code that runs in tasks, and the path inside it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound what one Arrow batch holds, by rows and by bytes; give workers this package once."""
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Return freed memory of this process to the system; a worker that goes on to other tasks would keep its peak."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _ship(spark: SparkSession) -> None:
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(context, "_ships_package", False):
        return
    path, data = scratch_path(spark, "code") + f"/{package.name}.zip", io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    filesystem, inner = filesystem_of(path)
    filesystem.create_dir(inner.rpartition("/")[0], recursive=True)
    with filesystem.open_output_stream(inner) as f:
        f.write(data.getvalue())
    context.addPyFile(path)
    context._ships_package = True


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def let(value: Column, body) -> Column:
    """``body`` with ``value`` computed once a row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]
