"""Layer tables as immutable Parquet versions, and report folders.

A table lives in folders ``<root>/<layer>/<name>/v=<n>-<attempt>``; every attempt writes a fresh folder, and it
counts once the append-only log of the table names it. A failed write therefore leaves the current version
untouched and nothing of it can come back; a job may read a table it replaces, an append adds one folder,
and a rollback is one more log row.

``merge`` deals rows into a fixed number of hash buckets of the merge key. It rewrites only the buckets the
source touches; rows with a NULL key match nothing, so they go to a bucket of their own that is only added to.
The log lists, per earlier folder, the buckets that a later folder holds; both lists are bounded, since a table of
more than ``MAX_FOLDERS`` folders is folded into one by its next merge. One writer per table is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import LAYERS
from ..operators.keyspace import any_null
from ..operators.merge import CHANGE, upsert

_LOG_SCHEMA = (
    "entry long, version long, rows long, bucket_keys array<string>, buckets int, "
    "schema_json string, folders array<struct<path: string, replaced: array<int>>>"
)
_BUCKET = "_bucket"
#: Column of ``LayerStore.changes``: how often a row came (above zero) or went.
SIGN = "_sign"
#: Hash buckets of a merged table, and folders of a version after which a merge folds them.
BUCKETS, MAX_FOLDERS = 64, 16


@dataclass(frozen=True)
class Published:
    """A new version; a merge counts the rows it inserted and updated, other writes the rows they wrote."""

    version: int
    rows: int
    inserted: int | None = None
    updated: int | None = None


def counted_write(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: str | None = None) -> dict:
    """Write Parquet and return the counts seen on the way, without a second pass."""
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows")]
    if CHANGE in df.columns:
        counts += [F.count_if(F.col(CHANGE) == kind).alias(kind) for kind in ("inserted", "updated")]
    writer = df.observe(seen, *counts).drop(CHANGE).write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return seen.get


def key_bucket(keys: list[str], buckets: int, schema: T.StructType) -> Column:
    """Bucket of a row by its key as the table types it; -1 with a NULL in the key."""
    typed = [F.col(k).cast(schema[k].dataType) for k in keys]
    return F.when(any_null(keys), -1).otherwise(F.pmod(F.xxhash64(*typed), F.lit(buckets)).cast("int"))


def clustered(df: DataFrame, by: list[str]) -> DataFrame:
    """Files that hold ascending key ranges: what a table-wide ORDER BY is for."""
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


class LayerStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, layer: str, name: str, version: int) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root}/{layer}/{name}/v={version}-{uuid.uuid4().hex[:12]}"

    def _log_rows(self, layer: str, name: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(_LOG_SCHEMA).parquet(f"{self.root}/version_log/{layer}.{name}")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":  # nothing was ever published
                return None
            raise

    def _latest(self, layer: str, name: str):
        """The current log row: one row comes to the driver, however long the history."""
        log = self._log_rows(layer, name)
        return None if log is None else log.orderBy(F.desc("entry")).first()

    def _current(self, layer: str, name: str):
        current = self._latest(layer, name)
        if current is None:
            raise LookupError(f"no published version of {layer}.{name}")
        return current

    def _log(self, layer: str, name: str, row: tuple) -> None:
        out = self.spark.createDataFrame([row], _LOG_SCHEMA)
        out.coalesce(1).write.mode("append").parquet(f"{self.root}/version_log/{layer}.{name}")

    def exists(self, layer: str, name: str) -> bool:
        return self._latest(layer, name) is not None

    def _load(self, entry, only: list[int] | None = None) -> DataFrame:
        """Folders of one version; buckets replaced later, or not asked for, are pruned as whole partitions."""
        schema = T.StructType.fromJson(json.loads(entry["schema_json"]))
        physical = T.StructType([*schema, T.StructField(_BUCKET, T.IntegerType())]) if entry["buckets"] else schema
        parts = []
        for path, replaced in entry["folders"]:
            df = self.spark.read.schema(physical).parquet(path)
            if replaced:
                df = df.filter(~F.col(_BUCKET).isin(list(replaced)))
            if only is not None:
                df = df.filter(F.col(_BUCKET).isin(only))
            parts.append(df.select(*[c for c in physical.names if c != _BUCKET]))
        return reduce(DataFrame.unionByName, parts)

    def read(self, layer: str, name: str, columns: list[str] | None = None) -> DataFrame:
        df = self._load(self._current(layer, name))
        return df if columns is None else df.select(*columns)

    def _stage(
        self, layer: str, name: str, df: DataFrame, earlier: list, bucket_keys: list[str] | None = None, buckets: int | None = None,
        in_place: bool = False,
    ) -> tuple[list, Published]:
        """Write the folder of a new version; its log row makes it current once it is logged.

        Rows that come ``in_place``, from the files of few buckets for each task, are not dealt to their buckets by a shuffle.
        """
        log = self._log_rows(layer, name)
        last = None if log is None else log.agg(F.max("version").alias("version"), F.max("entry").alias("entry")).first()
        version, entry = (1, 1) if last is None else (last["version"] + 1, last["entry"] + 1)
        path = self._folder(layer, name, version)
        schema = df.drop(CHANGE).schema
        if bucket_keys:
            df = df.withColumn(_BUCKET, key_bucket(bucket_keys, buckets, schema))
            df = df if in_place else df.hint("rebalance", _BUCKET)
        seen = counted_write(df, path, partition_by=_BUCKET if bucket_keys else None)
        folders = [*[[p, list(r)] for p, r in earlier], [path, []]]
        inserted, updated = seen.get("inserted"), seen.get("updated")
        rows = seen["rows"] if inserted is None else inserted + updated
        return [entry, version, rows, bucket_keys, buckets, schema.json(), folders], Published(version, rows, inserted, updated)

    def _write(
        self, layer: str, name: str, df: DataFrame, earlier: list, bucket_keys: list[str] | None = None, buckets: int | None = None
    ) -> Published:
        row, published = self._stage(layer, name, df, earlier, bucket_keys, buckets)
        self._log(layer, name, tuple(row))
        return published

    def stage_delete(self, layer: str, name: str, kept: DataFrame, lost: DataFrame, in_place: bool = False) -> list:
        """Write the table without the ``lost`` rows and return the log row that ``switch`` makes current.

        ``kept`` and ``lost`` are the current version. The layout stays; of a table in buckets only those that lose rows are written.
        ``in_place``: ``kept`` is a filter of the version, so its rows are written by the tasks that read them.
        """
        current = self._current(layer, name)
        keys, buckets, earlier = current["bucket_keys"], current["buckets"], []
        if keys and len(current["folders"]) < MAX_FOLDERS:
            bucket = key_bucket(keys, buckets, kept.schema)
            touched = sorted(r["b"] for r in lost.select(bucket.alias("b")).distinct().collect())  # at most ``buckets`` + 1 numbers
            kept = kept.filter(bucket.isin(touched))
            earlier = [(path, sorted({*replaced, *touched})) for path, replaced in current["folders"]]
        return self._stage(layer, name, kept, earlier, keys, buckets, in_place)[0]

    def switch(self, layer: str, name: str, staged: list) -> bool:
        """Make a staged version current; nothing happens if it was made so before. Whether something did."""
        entry, path = staged[0], staged[-1][-1][0]
        log = self._log_rows(layer, name)
        if not log.filter(F.exists("folders", lambda f: f["path"] == path)).isEmpty():
            return False
        if log.agg(F.max("entry")).first()[0] != entry - 1:
            raise ValueError(f"{layer}.{name} was written after this version was staged")
        self._log(layer, name, tuple(staged))
        return True

    def publish(
        self, layer: str, name: str, df: DataFrame, cluster_by: list[str] | None = None,
        bucket_keys: list[str] | None = None, buckets: int = BUCKETS,
    ) -> Published:
        """Write a new version, then make it current; ``bucket_keys`` lays it out for merges by that key."""
        if cluster_by and bucket_keys:
            raise ValueError("a table is either clustered or laid out in buckets")
        out = clustered(df, cluster_by) if cluster_by else df
        return self._write(layer, name, out, [], bucket_keys, buckets if bucket_keys else None)

    def merge(
        self,
        layer: str,
        name: str,
        source: DataFrame,
        keys: list[str],
        finish: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
        buckets: int = BUCKETS,
        prepare: Callable[[DataFrame], DataFrame] | None = None,
        merged_by: Callable[..., DataFrame] = upsert,
        **options,
    ) -> Published:
        """Upsert by key; only the buckets the source touches are read and rewritten.

        ``prepare(rows)`` may clean the affected rows of the table first, ``finish(merged, table)`` complete the
        merged rows with a look at the whole table. A table with another layout is rewritten once.
        """
        current = self._current(layer, name)
        table = self._load(current)
        known = current["bucket_keys"] == keys and current["buckets"]
        new_columns = set(source.columns) - set(table.columns) - {"_has", "_gone", *(options.get("order_by") or [])}
        if not known or new_columns or len(current["folders"]) >= MAX_FOLDERS:
            affected, earlier, buckets = table, [], known or buckets
        else:
            buckets = known
            dealt = source.select(key_bucket(keys, buckets, table.schema).alias("b")).distinct()
            touched = sorted(r["b"] for r in dealt.collect() if r["b"] >= 0)  # at most ``buckets`` numbers
            affected = self._load(current, touched) if touched else table.limit(0)
            earlier = [(path, sorted({*replaced, *touched})) for path, replaced in current["folders"]]
        if prepare is not None:
            affected = prepare(affected)
        merged = merged_by(affected, source, keys, mark_changes=True, **options)
        if finish is not None:
            merged = finish(merged, table)
        return self._write(layer, name, merged, earlier, keys, buckets)

    def version(self, layer: str, name: str) -> int:
        """The current version; 0 for a table that does not exist."""
        current = self._latest(layer, name)
        return 0 if current is None else current["version"]

    def changes(self, layer: str, name: str, since: int) -> DataFrame:
        """Signed rows between a version and the current one: +1 for a row that came, -1 for one that went.

        Folders and buckets that both versions have are not read. A column that one version lacks is NULL there.
        """
        new, log = self._current(layer, name), self._log_rows(layer, name)
        old = log.filter(F.col("version") == since).orderBy(F.desc("entry")).first()
        if old is None and since:
            raise LookupError(f"no version {since} of {layer}.{name}")
        folders = [{} if entry is None else {path: set(replaced) for path, replaced in entry["folders"]} for entry in (old, new)]
        parts = []
        for entry, mine, other, sign in ((old, *folders, -1), (new, *folders[::-1], 1)):
            for path, replaced in mine.items():
                if path in other and not other[path] - replaced:
                    continue  # the other version has all of it
                one = dict(entry.asDict(), folders=[(path, sorted(replaced))])
                rows = self._load(one, sorted(other[path] - replaced) if path in other else None)
                parts.append(rows.withColumn(SIGN, F.lit(sign).cast("long")))
        schema = T.StructType.fromJson(json.loads(new["schema_json"]))
        if not parts:
            return self.spark.createDataFrame([], T.StructType([*schema, T.StructField(SIGN, T.LongType())]))
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        columns = [c for c in rows.columns if c != SIGN]
        return rows.groupBy(*columns).agg(F.sum(SIGN).alias(SIGN)).filter(F.col(SIGN) != 0)

    def rollback(self, layer: str, name: str) -> int:
        """Make the version before the current one current again."""
        current, log = self._latest(layer, name), self._log_rows(layer, name)
        back = None
        if current is not None:
            back = log.filter(F.col("version") < current["version"]).orderBy(F.desc("version"), F.desc("entry")).first()
        if back is None:
            raise LookupError(f"no earlier version of {layer}.{name}")
        row = back.asDict(recursive=True)
        folders = [(f["path"], f["replaced"]) for f in row["folders"]]
        last = log.agg(F.max("entry").alias("entry")).first()["entry"]
        self._log(layer, name, (
            last + 1, row["version"], row["rows"], row["bucket_keys"], row["buckets"], row["schema_json"], folders
        ))
        return back["version"]

    def materialise(self, layer: str, name: str, df: DataFrame, if_exists: str = "ignore") -> Published | None:
        """Create a table from a query: leave, replace or refuse one that exists."""
        if if_exists not in ("ignore", "replace", "error"):
            raise ValueError(f"if_exists must be 'ignore', 'replace' or 'error', not {if_exists!r}")
        if if_exists != "replace" and self.exists(layer, name):
            if if_exists == "error":
                raise ValueError(f"{layer}.{name} exists")
            return None
        return self.publish(layer, name, df)

    def append(self, layer: str, name: str, df: DataFrame) -> Published:
        """Add rows: only they are written. Missing columns are NULL, types follow the table."""
        current = self._latest(layer, name)
        if current is None:
            return self.publish(layer, name, df)
        rows = conform_to(df, self._load(current).schema)
        return self._write(layer, name, rows, current["folders"], current["bucket_keys"], current["buckets"])


def conform_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    extra = [c for c in df.columns if c not in schema.names]
    if extra:
        raise ValueError(f"columns the table lacks: {extra}")
    return df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def append(df: DataFrame, path: str) -> int:
    """Bulk append to a Parquet folder; partitions take the place of insert chunks."""
    return counted_write(df, path, mode="append")["rows"]


def write_audit(df: DataFrame, root: str, run_id: str, label: str, file_format: str = "parquet") -> str:
    """Keep report or backup rows below ``<root>/<label>/run_id=<run_id>``; a repeated run replaces its own.

    Without rows nothing is written.
    """
    path = f"{root.rstrip('/')}/{label}"
    writer = (
        df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("run_id")
    )
    if file_format == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return path


def audited(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Audit rows of one run; none if it wrote none."""
    try:
        return spark.read.parquet(f"{path}/run_id={run_id}")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], "run_id string")
        raise
