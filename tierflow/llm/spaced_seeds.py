"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

A seed is a fixed mask over neighbouring words: the words under its ones are hashed, those under its zeros may
be anything. All seeds of the benchmark form a table that training positions meet by an equi-join. Around each
hit the two word rows are laid side by side, and the pair counts if some window of ``WINDOW`` neighbouring
places (the whole item, if shorter) has at most ``MISSES`` differing words. Substituted words therefore break
neither the search nor the verdict: a mask compares every ``MISSES + 1``-th word, which cuts a window into ``MISSES + 1``
classes of places, and so many substitutions leave one class intact wherever they fall.

The word hashes of a text are computed once; its positions are generated, hashed and looked up without being
written anywhere, and only hits go on. The seed table is broadcast if its measured size is within a limit,
else it is joined by its hash like any table.

Edge cases: NULL texts have no words. Letters A-Z count as lower case and the punctuation in ``IGNORED`` is
not looked at. Items too short for two words in each class (fewer than eight) are found only without substitutions. Repeated items and documents give one row
per pair of ids; a NULL id is a value of its own. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import let, lower_ascii, stored, words

WINDOW, MISSES = 13, 3
IGNORED = ".,;:!?\"'()[]{}"
#: Rows of the seed table up to which it is broadcast: about 100 bytes and an item's words each.
BROADCAST_ROWS, BROADCAST_WORDS = 200_000, 8_000_000


def word_hashes(text: Column) -> Column:
    plain = F.translate(lower_ascii(F.coalesce(text, F.lit(""))), IGNORED, "")
    return F.transform(words(plain), lambda w: F.xxhash64(w))


def mask(words: int, window: int = WINDOW, misses: int = MISSES) -> str:
    """The mask over neighbouring words (1: compared, 0: free) of items with so many words: the whole item if too short for two classes' words."""
    compared = min(words, window) // (misses + 1)
    return "1" + ("0" * misses + "1") * (compared - 1) if compared >= 2 else "1" * words


def _seeds(hashes: str, at: Column, masks: list[str], wanted: Column | None = None) -> Column:
    """One hash per mask at a position; the mask is part of it. NULL where it leaves the text or is not ``wanted``."""
    row = F.col(hashes)
    return F.array(*[
        F.when(
            (at + len(mask) <= F.size(row)) & (F.lit(True) if wanted is None else wanted == mask),
            F.xxhash64(F.lit(mask), *[F.get(row, at + i) for i, bit in enumerate(mask) if bit == "1"]),
        )
        for mask in masks
    ])


def _positions(df: DataFrame, hashes: str, masks: list[str], wanted: Column | None = None) -> DataFrame:
    """Rows with ``at`` and ``seed`` for every position that holds a mask."""
    shortest = min(map(len, masks))
    starts = F.when(F.size(hashes) >= shortest, F.sequence(F.lit(0), F.size(hashes) - shortest))
    placed = df.select("*", F.explode(starts).alias("at"))
    return placed.select("*", F.explode(_seeds(hashes, F.col("at"), masks, wanted)).alias("seed")).where("seed IS NOT NULL")


def seed_table(benchmark: DataFrame, id_col: str, text_col: str, window: int = WINDOW, misses: int = MISSES) -> tuple[DataFrame, list[str]]:
    """The seeds of all items, each by the mask of its length, and the masks in use. Runs a job."""
    items = benchmark.select(F.col(id_col).alias("item_id"), word_hashes(F.col(text_col)).alias("item")).distinct()
    # Items of a window or more share one mask, so there are ``window`` lengths at most.
    lengths = items.where(F.size("item") > 0).select(F.least(F.size("item"), F.lit(window)).alias("n")).distinct()
    by_length = {r["n"]: mask(r["n"], window, misses) for r in lengths.collect()}
    masks = sorted(set(by_length.values())) or ["1"]
    wanted = F.coalesce(*[F.when(F.least(F.size("item"), F.lit(window)) == n, F.lit(m)) for n, m in by_length.items()], F.lit(""))
    seeds = _positions(items, "item", masks, wanted)
    return seeds.select("item_id", "item", F.col("at").alias("item_at"), "seed"), masks


def _fit(segment: Column, item: Column, before: Column, window: int) -> Column:
    """Words that agree, and the fewest that differ in one window, of an item and the words it lies on.

    ``before``: words of the item that lie before the text's begin; those and the ones past its end differ.
    """
    differs = F.transform(
        item, lambda w, i: F.when((i >= before) & F.get(segment, i - before).eqNullSafe(w), 0).otherwise(1)
    )

    def fewest(d: Column) -> Column:
        size = F.least(F.size(d), F.lit(window))
        sums = F.transform(
            F.sequence(F.lit(1), F.size(d) - size + 1),
            lambda a: F.aggregate(F.slice(d, a, size), F.lit(0), lambda s, v: s + v),
        )
        return F.struct(F.array_min(sums).alias("misses"), (F.size(d) - F.aggregate(d, F.lit(0), lambda s, v: s + v)).alias("matched"))

    return let(differs, fewest)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, misses: int = MISSES,
) -> DataFrame:
    """(id, item_id, item_words, matched_words, window_misses): pairs with a verified overlap, best alignment. Runs a job."""
    seeds, masks = seed_table(benchmark, item_id_col, item_text_col, window, misses)
    seeds = stored(seeds, "seeds")
    size = seeds.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("item")), F.lit(0)).alias("words")).first()
    if size["n"] <= BROADCAST_ROWS and size["words"] <= BROADCAST_WORDS:
        seeds = F.broadcast(seeds)
    texts = docs.select(F.col(id_col), word_hashes(F.col(text_col)).alias("row"))
    # Only the words under the item leave this step, so a long text is not copied for each of its hits.
    start = F.col("at") - F.col("item_at")
    hits = _positions(texts, "row", masks).join(seeds, "seed").select(
        id_col, "item_id", start.alias("start"), "item",
        F.slice("row", F.greatest(start, F.lit(0)) + 1, F.size("item") + F.least(start, F.lit(0))).alias("segment"),
    )
    laid = hits.groupBy(id_col, "item_id", "start", F.xxhash64("segment").alias("print")).agg(F.first("item").alias("item"), F.first("segment").alias("segment"))
    fitted = laid.select(
        id_col, "item_id", F.size("item").alias("item_words"),
        _fit(F.col("segment"), F.col("item"), F.greatest(-F.col("start"), F.lit(0)), window).alias("fit"),
    )
    return (
        fitted.where(F.col("fit.misses") <= F.when(F.least("item_words", F.lit(window)) >= 2 * (misses + 1), misses).otherwise(0))
        .groupBy(id_col, "item_id", "item_words")
        .agg(F.max("fit.matched").alias("matched_words"), F.min("fit.misses").alias("window_misses"))
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Documents without a verified overlap; rows whose id is NULL are judged together."""
    found = contaminated(docs, benchmark, id_col, **options).select(F.col(id_col).alias("__found")).distinct()
    return docs.join(stored(found, "contaminated"), docs[id_col].eqNullSafe(F.col("__found")), "left_anti")
