"""Large CSV files with line breaks inside quotes, read by many tasks.

Spark cuts a text file into blocks at line ends, but whether a line end also ends a record depends on all quotes before it. So the
blocks are read twice. First each block tells how it changes the state of the reader: whether it holds an odd number of quotes, and how
many records of several lines it opens, for either state it may begin in. A running sum over the blocks of a file gives the state each block
begins in. Then each block marks its lines, starting from that state: lines that are a record by themselves go on alone, the lines of a
longer record get its number and are brought together by it. Only these are shuffled, and no task reads more than its block.

Quotes are doubled inside quoted cells (two quotes don't change the state). A record that is never closed reaches to the end of its file;
one longer than ``limit`` bytes fails the job with the file named, in place of filling a task.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of the longest record.
RECORD_BYTES = 64 << 20
_PLACE = ["path", "modified", "name", "block"]


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, modified, name, block, pos, raw): lines without their end, as bytes; ``pos`` orders the lines of a block."""
    # As binary text in one-byte form: the parity of quotes needs no decoding, and any encoding with ASCII quotes and line ends works.
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"), F.col("value").cast("binary").alias("raw"),
    )
    return lines


def line_records(spark: SparkSession, paths: list[str]) -> bool:
    """Whether Spark's own reader of lines finds the records of ``records``. Reads the files once, without decoding or moving their lines.

    It does if no line opens or closes a record of several lines, no carriage return stands inside a line, where Spark would end it too, and
    no line is of control characters only, which Spark takes for an empty one.
    """
    line = F.rtrim(F.col("value"), F.lit("\r"))
    quotes = F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))
    odd = line.contains('"') & (quotes % 2 == 1)
    bare = line.rlike("^[\\x00-\\x20]+$") & (F.trim(line) != "")
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.filter(odd | line.contains("\r") | bare).isEmpty()


def _block_states(lines: DataFrame) -> DataFrame:
    """(path, block, odd, opened): the state each block begins in, and how many long records were opened before it."""
    slim = lines.select("path", "block", F.regexp_count(F.decode("raw", "ISO-8859-1"), F.lit('"')).alias("quotes"))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held: dict[tuple, list[int]] = {}
        for batch in batches:
            paths, blocks = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
            place = paths.indices.to_numpy().astype(np.int64)
            odd = batch.column(2).to_numpy() & 1
            cuts = np.flatnonzero((np.diff(place) != 0) | (np.diff(blocks) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(odd)]):
                if a == b:
                    continue
                state = held.setdefault((paths.dictionary[int(place[a])].as_py(), int(blocks[a])), [0, 0, 0])
                after = (state[0] + np.cumsum(odd[a:b])) & 1  # as if the block began outside of quotes
                before = np.concatenate(([state[0]], after[:-1]))
                state[1] += int(((before == 0) & (after == 1)).sum())
                state[2] += int(((before == 1) & (after == 0)).sum())
                state[0] = int(after[-1])
        keys, states = list(held), list(held.values())
        arrays = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64())]
        arrays += [pa.array([s[i] for s in states], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays(arrays, ["path", "block", "odd", "opens", "opens_inside"])

    told = slim.mapInArrow(run, "path string, block long, odd long, opens long, opens_inside long")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = told.withColumn("begins", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    opened = F.when(F.col("begins") == 1, F.col("opens_inside")).otherwise(F.col("opens"))
    return begun.withColumn("n", opened).select("path", "block", "begins", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("opened"))


def records(spark: SparkSession, paths: list[str], encoding: str = "ISO-8859-1", limit: int = RECORD_BYTES) -> DataFrame:
    """(path, modified, name, block, pos, first, record): the CSV records of the files, one text each; ``first`` ones are headers."""
    lines = _lines(spark, paths)
    placed = lines.join(F.broadcast(_block_states(lines)), ["path", "block"])  # a row for each block of 128 MB

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        current, state, number = None, 0, 0
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            paths, blocks = columns["path"].dictionary_encode(), columns["block"].to_numpy()
            place, quotes = paths.indices.to_numpy().astype(np.int64), columns["quotes"].to_numpy() & 1
            cuts = np.flatnonzero((np.diff(place) != 0) | (np.diff(blocks) != 0)) + 1
            own, first = np.full(len(quotes), -1, np.int64), np.zeros(len(quotes), bool)
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(quotes)]):
                if a == b:
                    continue
                here = (paths.dictionary[int(place[a])].as_py(), int(blocks[a]))
                if here != current:
                    current, state, number = here, int(columns["begins"][a].as_py()), int(columns["opened"][a].as_py())
                    first[a] = here[1] == 0
                after = (state + np.cumsum(quotes[a:b])) & 1
                before = np.concatenate(([state], after[:-1]))
                opened = number + np.cumsum((before == 0) & (after == 1))
                own[a:b] = np.where((before == 1) | (after == 1), opened, -1)
                state, number = int(after[-1]), int(opened[-1])
            numbers = pa.array(own, pa.int64(), mask=own < 0)
            kept = [columns[n] for n in ("path", "modified", "name", "block", "pos", "raw")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(first), numbers], ["path", "modified", "name", "block", "pos", "raw", "first", "number"])

    counted = placed.withColumn("quotes", F.regexp_count(F.decode("raw", "ISO-8859-1"), F.lit('"')).cast("long"))
    kinds = {f.name: f.dataType for f in counted.schema}
    schema = T.StructType([T.StructField(n, kinds[n]) for n in ("path", "modified", "name", "block", "pos", "raw")] + [T.StructField("first", T.BooleanType()), T.StructField("number", T.LongType())])
    marked = counted.select("path", "modified", "name", "block", "pos", "raw", "quotes", "begins", "opened").mapInArrow(run, schema)

    def text(raw: Column) -> Column:
        return F.rtrim(F.decode(raw, encoding), F.lit("\r"))

    single = marked.filter("number is null").select(*_PLACE, "pos", "first", text(F.col("raw")).alias("record"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "pos", "raw"))), lambda r: F.decode(r["raw"], encoding)), "\n")
    long = marked.filter("number is not null").groupBy("path", "modified", "name", "number").agg(
        F.min(F.struct("block", "pos")).alias("at"), F.max("first").alias("first"), F.sum(F.octet_length("raw") + 1).alias("bytes"), joined.alias("record")
    )
    message = F.concat(F.lit("a quoted cell is not closed, or a record is too long: "), F.col("path"))
    whole = F.when(F.col("bytes") > limit, F.raise_error(message).cast("string")).otherwise(F.rtrim(F.col("record"), F.lit("\r")))
    return single.unionByName(long.select("path", "modified", "name", F.col("at.block").alias("block"), F.col("at.pos").alias("pos"), "first", whole.alias("record")))
