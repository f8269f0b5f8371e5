"""CSV exports into landing tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_month_name
from ..functions.text import cohort_code_from_label
from ..operators.dedupe import dedupe_keep_last, require_unique
from ..operators.merge import CHANGE, add_column, upsert, upsert_in_order
from ..sources.csv_files import SEQ, CsvFile, Feed, list_csv_files, load_csv_folder, route_files, rows_source
from ..sources.schemas import MERGE_KEYS
from ..sources.tables import LayerStore, Published

# The landing table of each kind of feed, and how long a live session counts.
FEED_TABLES = {
    "quiz": "incubator_quiz_monitoring",
    "session": "student_session_information",
    "assignment": "assignment_monitoring_data",
}
FEED_UPDATES = {
    "quiz": ["value"],
    "session": ["Duration_in_hrs", "Duration_in_secs", "watched_on"],
}
LIVE_SESSION_SECONDS = 3600
#: Feeds whose bits one whole number holds.
_BITS = 63


def feed_columns(feed: Feed) -> list[str]:
    """Columns a feed brings to its table: fixed ones, or for assignments all of the file."""
    keys = MERGE_KEYS[FEED_TABLES[feed.kind]]
    updates = FEED_UPDATES.get(feed.kind, [c for c in feed.rows.columns if c not in (*keys, SEQ)])
    return [*keys, *updates]


def merge_feed(target: DataFrame | None, feed: Feed) -> DataFrame:
    """The landing table after every row of the feed was upserted in file order."""
    keys = MERGE_KEYS[FEED_TABLES[feed.kind]]
    columns = feed_columns(feed)
    rows = feed.rows.select(*columns, SEQ)
    if target is None:
        return dedupe_keep_last(rows, keys, [SEQ]).select(*columns)
    for c in columns:
        target = add_column(target, c, T.StringType())
    return upsert_in_order(target, rows, keys, [SEQ], update_cols=[c for c in columns if c not in keys])


def combined_feed(feeds: list[Feed]) -> DataFrame:
    """All feeds of one table as one row per key: per column the last value among the files that have it.

    ``_has`` lists the columns that some file of the key brought, so a merge leaves the others alone.
    """
    keys = MERGE_KEYS[FEED_TABLES[feeds[0].kind]]
    owned = [[c for c in feed_columns(feed) if c not in keys] for feed in feeds]
    columns = list(dict.fromkeys(c for own in owned for c in own))
    # A row names its feed by number, and bits of a whole number tell which feeds brought a key: plain sums that map tasks combine.
    parts = [feed.rows.select(*keys, *own, SEQ, F.lit(n).alias("_feed")) for n, (feed, own) in enumerate(zip(feeds, owned))]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    # Columns that the same feeds bring have their last values in the same row.
    groups: dict[tuple[int, ...], list[str]] = {}
    for c in columns:
        groups.setdefault(tuple(n for n, own in enumerate(owned) if c in own), []).append(c)
    last = [
        F.max_by(F.struct(*together), F.col(SEQ) if len(having) == len(feeds) else F.when(F.col("_feed").isin(*having), F.col(SEQ))).alias(f"_last{i}")
        for i, (having, together) in enumerate(groups.items())
    ]
    words = range(0, len(feeds), _BITS)
    bits = [F.bit_or(F.when(F.col("_feed").between(w, w + _BITS - 1), F.expr(f"shiftleft(1L, _feed - {w})")).otherwise(0)).alias(f"_bits{w}") for w in words]
    found = rows.groupBy(*keys).agg(*last, *bits)
    place = {c: f"_last{i}" for i, together in enumerate(groups.values()) for c in together}

    def brought(having: tuple[int, ...]) -> Column:
        masks = {w: sum(1 << n - w for n in having if w <= n < w + _BITS) for w in words}
        return reduce(lambda a, b: a | b, [F.col(f"_bits{w}").bitwiseAND(F.lit(m)) != 0 for w, m in masks.items() if m])

    has = [F.when(brought(having), F.array(*map(F.lit, together))).otherwise(F.array().cast("array<string>")) for having, together in groups.items()]
    return found.select(*keys, *[F.col(place[c])[c].alias(c) for c in columns], (F.concat(*has) if has else F.array().cast("array<string>")).alias("_has"))


def merge_combined(target: DataFrame, rows: DataFrame, keys: list[str], mark_changes: bool = False) -> DataFrame:
    """Upsert rows of ``combined_feed``; a column changes only where ``_has`` names it."""
    columns = [c for c in rows.columns if c not in (*keys, "_has")]
    for c in columns:
        target = add_column(target, c, T.StringType())
    packed = rows.select(*keys, F.struct(*columns, "_has").alias("_new"))
    held = target.select(*keys, F.struct(*target.columns).alias("_old"))
    merged = upsert(
        held.withColumn("_new", F.lit(None).cast(packed.schema["_new"].dataType)), packed, keys, on_dup="unique", mark_changes=mark_changes
    )
    def value(c: str):
        old = F.col(f"_old.{c}")
        return F.when(F.array_contains("_new._has", c), F.col(f"_new.{c}")).otherwise(old).alias(c) if c in columns else old.alias(c)

    return merged.select(*keys, *[value(c) for c in target.columns if c not in keys], *([CHANGE] if mark_changes else [])).select(
        *target.columns, *([CHANGE] if mark_changes else [])
    )


@dataclass(frozen=True)
class LandingRun:
    published: dict[str, Published]
    skipped: list[str]


def run_landing(
    spark: SparkSession, folder: str, store: LayerStore, filter_text: str = "", multi_line: bool = True
) -> LandingRun:
    """Detect, clean and merge all feeds of a folder: one merge and one published version per table."""
    return land_files(spark, list_csv_files(spark, folder, filter_text), store, multi_line)


def land_files(spark: SparkSession, files: list[CsvFile], store: LayerStore, multi_line: bool = True) -> LandingRun:
    keys = {kind: MERGE_KEYS[name] for kind, name in FEED_TABLES.items()}
    feeds, skipped = route_files(spark, files, multi_line=multi_line, keys=keys)
    published = {}
    for kind in sorted({f.kind for f in feeds}):
        name, own = FEED_TABLES[kind], keys[kind]
        rows = combined_feed([f for f in feeds if f.kind == kind])
        if store.exists("landing", name):
            merged_by = lambda target, source, k, mark_changes: merge_combined(target, source, k, mark_changes)
            published[name] = store.merge("landing", name, rows, own, merged_by=merged_by)
        else:
            published[name] = store.publish("landing", name, rows.drop("_has"), bucket_keys=own)
    return LandingRun(published, skipped)


def load_folder(spark: SparkSession, folder: str, store: LayerStore) -> dict[str, Published]:
    """First load: one landing table per file; a table that exists is an error."""
    return {
        name: store.materialise("landing", name, df, "error") for name, df in load_csv_folder(spark, folder).items()
    }


def append_registrations(store: LayerStore, rows: DataFrame) -> Published:
    """Add registration rows to the info sheet as they are."""
    return store.append("landing", "general_information_sheet", rows.drop(SEQ))


def live_sessions_from_csv(rows: DataFrame) -> DataFrame:
    """Live sessions in table form: code from the batch label, date from the month-name form."""
    return rows.select(
        cohort_code_from_label(F.col("Batch")).alias("cohort_code"),
        F.col("Topic").alias("session_name"),
        F.col("`Session Type`").alias("type"),
        F.col("`Session Code`").alias("code"),
        F.lit(LIVE_SESSION_SECONDS).alias("duration_in_sec"),
        date_month_name(F.col("Date")).cast("timestamp_ntz").alias("conducted_on"),
        *([SEQ] if SEQ in rows.columns else []),
    )


def merge_live_sessions(target: DataFrame, rows: DataFrame, target_order: list[str], rows_order: list[str]) -> DataFrame:
    """Drop repeated sessions of the table, then upsert the new rows in order."""
    keys = MERGE_KEYS["live_session"]
    clean = dedupe_keep_last(target, keys, target_order)
    updates = ["session_name", "type", "duration_in_sec"]
    return upsert_in_order(clean, live_sessions_from_csv(rows), keys, rows_order, update_cols=updates)


def append_cohorts(cohorts: DataFrame, data: list[tuple], schema: str) -> DataFrame:
    """Add entered cohort rows; a code that exists or repeats is an error."""
    entered = rows_source(cohorts.sparkSession, data, schema)
    both = cohorts.unionByName(entered, allowMissingColumns=True)
    return require_unique(both, ["cohort_code"])
