"""Quality rules whose cutoffs come with a bound on false rejections, with DataFrame functions only.

Counts of a text (words, symbols, repeated lines, repeated three-word windows) give one value per rule, where
more is worse. Labelled holdouts decide the cutoffs: for every stratum and rule, cutoffs are tried from the
loosest to the strictest, and one is certified if its number of rejected good holdouts would be that small
with probability ``delta / (strata * rules)`` at most were the true false-rejection rate above
``alpha / rules``. That is the exact binomial tail; the order of trials is fixed in advance and ends at the
first failure, and the division corrects for all strata and rules. So, with probability ``1 - delta``, in
every stratum at most the share ``alpha`` of good documents is rejected. Of the certified cutoffs that reject the
most bad holdouts the loosest is taken; a rule without a certified cutoff that rejects any rejects nothing.

Counts are made inside a row by sorting window hashes, so they take O(n log n) for any text length and no shuffle.

Edge cases: a NULL text has no words and fails the base rule. A NULL stratum is a stratum of its own, as is one
without holdouts (no rule applies there). A document with several labels counts as good only if all are good;
NULL labels are none. Repeated rows are judged alike. Other columns pass through if asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierflow.llm.common import let, stored, words

SYMBOLS = r"[#*$%&|<>]"
WINDOW_WORDS = 3
#: Cutoffs of each rule, from the loosest to the strictest.
CUTOFFS = {
    "symbols": [2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.075, 0.05],
    "dup_lines": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2],
    "repeats": [0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1],
    "capitals": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2],
    "word_length": [20.0, 15.0, 12.0, 10.0, 9.5, 9.0, 8.5, 8.0, 7.5, 7.0],
}
ALPHA, DELTA = 0.10, 0.05


def _covered(hashes: Column, words_per_window: int) -> Column:
    """Places inside windows whose hash occurs twice or more, each place once."""

    def spread(pairs: Column) -> Column:
        again = F.filter(
            pairs, lambda p, i: F.coalesce(F.get(pairs, i - 1)["h"] == p["h"], F.lit(False)) | F.coalesce(F.get(pairs, i + 1)["h"] == p["h"], F.lit(False))
        )
        return let(F.sort_array(F.transform(again, lambda p: p["i"])), lambda at: F.aggregate(
            F.transform(at, lambda p, k: F.least(F.lit(words_per_window), F.coalesce(F.get(at, k + 1) - p, F.lit(words_per_window)))),
            F.lit(0), lambda total, n: total + n,
        ))

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(pairs, spread))


def _word_counts(w: Column) -> Column:
    n, k = F.size(w), WINDOW_WORDS
    hashes = F.when(
        n >= k, F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
    ).otherwise(F.array().cast("array<bigint>"))
    return F.struct(
        n.cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda total, x: total + F.char_length(x)).alias("word_chars"),
        let(hashes, lambda h: _covered(h, k)).cast("long").alias("n_repeat_words"),
    )


def with_counts(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_capitals, n_lines, n_dup_lines, n_repeat_words."""
    kept = df.columns if keep is None else keep
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    line_counts = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")
    ))
    counted = df.select(
        *kept, let(words(F.col(text_col)), _word_counts).alias("__w"), line_counts.alias("__l"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
    )
    return counted.select(
        *kept, "__w.n_words", "__w.word_chars", "n_symbols", "n_capitals", "__l.n_lines", "__l.n_dup_lines", "__w.n_repeat_words"
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rule_values() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") / n,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / n,
        "capitals": F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1)),
        "word_length": F.col("word_chars") / n,
    }


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), summed in logarithms."""
    odds = F.lit(p / (1 - p))
    first = n * F.log1p(F.lit(-p))

    def step(s: Column, j: Column) -> Column:
        term = s["term"] + F.log((n - j + 1) / j * odds)
        total = F.greatest(s["total"], term) + F.log1p(F.exp(-F.abs(s["total"] - term)))
        return F.struct(term.alias("term"), total.alias("total"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    start = F.struct(first.alias("term"), first.alias("total"))
    return F.aggregate(steps, start, step, lambda s: F.exp(s["total"]))


def certified_cutoffs(
    counted: DataFrame, labels: DataFrame, id_col: str, stratum_col: str, label_col: str, alpha: float = ALPHA,
    delta: float = DELTA, cutoffs: dict[str, list[float]] | None = None,
) -> DataFrame:
    """(stratum, rule, cutoff, holdouts, rejected_good, rejected_bad, p_value) of the cutoffs taken.

    ``counted`` has the counts; rows that fail the base rule are judged by it and are no holdouts.
    """
    cutoffs = cutoffs or CUTOFFS
    share = alpha / len(cutoffs)
    judged = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).alias("__good"))
    values = rule_values()
    cells = F.array(*[
        F.struct(F.lit(rule).alias("rule"), sum(((values[rule] > c).cast("int") for c in steps), F.lit(0)).alias("passed"))
        for rule, steps in cutoffs.items()
    ])
    holdouts = (
        counted.where(~base_failed()).join(judged, F.col(id_col) == F.col("__id"))
        .select(F.col(stratum_col).alias("stratum"), (F.col("__good") >= 1).alias("good"), F.explode(cells).alias("cell"))
        .groupBy("stratum", "cell.rule", "cell.passed")
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    )
    # A value passes the strictest cutoffs first, so of m cutoffs number c (from 0) rejects those that passed m - c or more.
    grid = F.create_map(*[x for r, steps in cutoffs.items() for x in (F.lit(r), F.array(*map(F.lit, steps)))])
    by_rule = holdouts.groupBy("stratum", "rule").agg(
        F.sum("good").alias("holdouts"), F.collect_list(F.struct("passed", "good", "bad")).alias("cells")
    )
    strata = F.size(F.collect_set(F.struct("stratum")).over(Window.partitionBy(F.lit(0))))
    def hit(cell: Column) -> Column:
        return cell["passed"] + F.col("step") >= F.size(grid[F.col("rule")])

    tried = by_rule.select("*", F.posexplode(grid[F.col("rule")]).alias("step", "cutoff")).select(
        "stratum", "rule", "holdouts", "step", "cutoff",
        F.aggregate(F.filter("cells", hit), F.lit(0).cast("long"), lambda s, c: s + c["good"]).alias("rejected_good"),
        F.aggregate(F.filter("cells", hit), F.lit(0).cast("long"), lambda s, c: s + c["bad"]).alias("rejected_bad"),
    )
    few = F.col("rejected_good") < share * F.col("holdouts")
    tail = F.when(few, binomial_tail(F.col("rejected_good"), F.col("holdouts"), share)).otherwise(1.0)
    certified = tried.withColumn("strata", strata).withColumn("p_value", tail).withColumn(
        "ok", F.col("p_value") <= delta / (len(cutoffs) * F.col("strata"))
    )
    so_far = Window.partitionBy("stratum", "rule").orderBy("step")
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc("rejected_bad"), "step")
    return (
        certified.withColumn("ok", F.min("ok").over(so_far)).where(F.col("ok") & (F.col("rejected_bad") > 0))
        .withColumn("__place", F.row_number().over(best)).where("__place = 1")
        .select("stratum", "rule", "cutoff", "holdouts", "rejected_good", "rejected_bad", "p_value")
    )


def judged(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
    label_col: str = "quality", **options,
) -> DataFrame:
    """Counts, base_failed and kept for every row. Runs jobs: counts and cutoffs are written once."""
    counted = stored(with_counts(df.select(id_col, text_col, stratum_col), text_col, [id_col, stratum_col]), "counts")
    cuts = certified_cutoffs(counted, labels, id_col, stratum_col, label_col, **options)
    per_stratum = stored(
        cuts.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"__{r}") for r in CUTOFFS]), "cutoffs"
    )
    values = rule_values()
    passed = [F.coalesce(values[r] <= F.col(f"__{r}"), F.lit(True)) for r in CUTOFFS]
    kept = ~base_failed()
    for p in passed:
        kept = kept & p
    joined = counted.join(per_stratum, counted[stratum_col].eqNullSafe(per_stratum["stratum"]), "left")
    return joined.select(*counted.columns, base_failed().alias("base_failed"), kept.alias("kept"))
