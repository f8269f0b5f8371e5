"""One query for each operator, applied to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierflow.llm import (
    backoff_automaton,
    hard_negatives,
    language_families,
    phrase_trie,
    private_spans,
    quality_rules,
    quotation_links,
    sentence_pieces,
    severity_grades,
    shingle_join,
    simhash_trees,
    spaced_seeds,
    warc_bundles,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies; the operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_warc_bundles", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    d AS (
        SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS hex,
            min(page_id) OVER (PARTITION BY body) AS first_id
        FROM p
    ),
    v AS (SELECT *, first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id AS again FROM d)
    SELECT page_id, payload_bytes,
        array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '')
            AS payload_digest,
        CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN again THEN first_id END AS refers_to
    FROM v
""")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    catalogue = warc_bundles.write_bundles(warc_bundles.planned_records(pages, "page_id", "url", "html"))
    return warc_bundles.read_bundles(spark, catalogue).select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query("op8_sentence_pieces")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    pieces = sentence_pieces.with_pieces(
        table(spark, folder, "documents").select("doc_id", "text"), tokenizer_path("piece_bpe_32k.model"), keep=["doc_id"]
    )
    return pieces.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("piece_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op3_simhash_trees")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash_trees.near_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def remainder(id_col: str, of: int):
    """crc32 of the id as text, modulo ``of``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % of


@query("op6_language_families")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    machines = language_families.fit(docs.where(remainder("doc_id", 3) != 1), "doc_id", "text", "lang")
    return language_families.with_language(docs, machines, keep=["doc_id"]).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score"
    )


@query("op5_private_spans")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = private_spans.with_spans(docs, private_spans.fit(docs), keep=["doc_id"])

    def joined(name: str):
        return F.array_join(F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in private_spans.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("all_spans").alias("spans"))


@query("op10_spaced_seeds")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return spaced_seeds.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op2_quality_rules", """
    WITH d AS (
        SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t,
            list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
        FROM documents
    ),
    grams AS (
        SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)
    ),
    again AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1),
    covered AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY rid),
    lines AS (
        SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines
        FROM (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY rid
    ),
    counts AS (
        SELECT doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
            CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
            CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
            length(t) - length(regexp_replace(t, '\\p{Lu}', '', 'g')) AS n_capitals,
            coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
        FROM d LEFT JOIN lines USING (rid) LEFT JOIN covered USING (rid)
    ),
    based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
    valued AS (
        SELECT *, [n_symbols / greatest(n_words, 1), n_dup_lines / greatest(n_lines, 1), n_repeat_words / greatest(n_words, 1),
            n_capitals / greatest(word_chars, 1), word_chars / greatest(n_words, 1)] AS vals
        FROM based
    ),
    grid AS (
        SELECT r, s, cuts[s] AS cutoff FROM (
            SELECT 1 AS r, [2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.075, 0.05]::DOUBLE[] AS cuts
            UNION ALL SELECT 2, [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2]::DOUBLE[]
            UNION ALL SELECT 3, [0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1]::DOUBLE[]
            UNION ALL SELECT 4, [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2]::DOUBLE[]
            UNION ALL SELECT 5, [20.0, 15.0, 12.0, 10.0, 9.5, 9.0, 8.5, 8.0, 7.5, 7.0]::DOUBLE[]
        ), unnest(range(1, len(cuts) + 1)) AS u(s)
    ),
    good AS (SELECT doc_id, min(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
    held AS (SELECT lang, vals, q >= 1 AS good FROM valued JOIN good USING (doc_id) WHERE NOT base_failed),
    cells AS (
        SELECT lang, r, s, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (good AND vals[r] > cutoff) AS k,
            count(*) FILTER (NOT good AND vals[r] > cutoff) AS bad
        FROM held, grid GROUP BY ALL
    ),
    tails AS (
        SELECT *, CASE WHEN k < 0.02 * n THEN list_sum(list_transform(range(0, k + 1), lambda j: exp(
            lgamma(n + 1) - CASE WHEN j = 0 THEN 0 ELSE lgamma(j + 1) END - lgamma(n - j + 1) + j * ln(0.02) + (n - j) * ln(0.98)))) ELSE 1 END AS p
        FROM cells
    ),
    sure AS (
        SELECT *, bool_and(p <= 0.05 / (5 * (SELECT count(*) FROM (SELECT DISTINCT lang FROM held))))
            OVER (PARTITION BY lang, r ORDER BY s) AS ok
        FROM tails
    ),
    taken AS (
        SELECT lang, r, cutoff FROM sure WHERE ok AND bad > 0
        QUALIFY row_number() OVER (PARTITION BY lang, r ORDER BY bad DESC, s) = 1
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND NOT EXISTS (
            SELECT 1 FROM taken WHERE taken.lang IS NOT DISTINCT FROM valued.lang AND valued.vals[taken.r] > taken.cutoff
        ) AS kept
    FROM valued
""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(table(spark, folder, "documents"), table(spark, folder, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op9_backoff_automaton")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 7) == 2
    scored = backoff_automaton.scored(docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op7_severity_grades")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    sample = severity_grades.sampled(table(spark, folder, "labels"), "doc_id", "toxic")
    model = severity_grades.fit(severity_grades.texts_of(docs, sample, "doc_id", "text"), severity_grades.halves)
    graded = severity_grades.with_severity(docs, model, keep=["doc_id"])
    return graded.select("doc_id", "grade", "expected_severity", "p_toxic", (F.col("grade") >= 1).alias("toxic"))


def mails(conversations: DataFrame) -> DataFrame:
    """The conversations as mails: a reply begins with the turn before it, quoted, and that turn's own quotation."""
    order = Window.partitionBy("conv_id").orderBy("turn")

    def quoted(text, mark: str):
        return F.regexp_replace(text, r"(?m)^", mark)

    before, earlier = F.lag("text").over(order), F.lag("text", 2).over(order)
    return conversations.select(
        "conv_id", "turn", "role", F.concat_ws("\n", quoted(earlier, ">> "), quoted(before, "> "), "text").alias("text")
    )


@query("op4_quotation_links")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return quotation_links.reply_ordered(mails(table(spark, folder, "conversations")), keep=["role"])


@query("op11_threshold_negatives", """
    WITH r AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same,
            CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * r.v[i])) AS BIGINT) AS score
        FROM r AS a JOIN r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
    ),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    )
    return hard_negatives.mined(rows, lambda vec_id: vec_id % 100 == 0)


@query("op12_shingle_join", """
    WITH RECURSIVE w AS (
        SELECT row_number() OVER () AS rid, doc_id,
            list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
        FROM documents
    ),
    s AS (
        SELECT rid, doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) AS s
        FROM w WHERE len(w) > 0
    ),
    nodes AS (SELECT s, row_number() OVER () AS node, len(s) AS n FROM (SELECT DISTINCT s FROM s)),
    grams AS (SELECT node, n, unnest(s) AS g FROM nodes),
    links AS (
        SELECT a.node AS u, b.node AS v FROM grams AS a JOIN grams AS b ON a.g = b.g AND a.node < b.node AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
        GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
    ),
    ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links UNION ALL SELECT node, node FROM nodes),
    reach AS (
        SELECT node AS u, node AS v FROM nodes WHERE node IN (SELECT u FROM ways)
        UNION
        SELECT reach.u, ways.v FROM reach JOIN ways ON reach.v = ways.u
    ),
    members AS (SELECT rid, doc_id, node, n FROM s JOIN nodes USING (s)),
    firsts AS (SELECT node, min(doc_id) AS first_id FROM members GROUP BY node),
    component AS (SELECT reach.u AS node, min(first_id) AS component_id FROM reach JOIN firsts ON reach.v = firsts.node GROUP BY reach.u)
    SELECT w.doc_id, CAST(coalesce(members.n, 0) AS BIGINT) AS n_shingles, CASE WHEN members.n IS NULL THEN w.doc_id ELSE component_id END AS component_id
    FROM w LEFT JOIN members USING (rid) LEFT JOIN component ON members.node = component.node
""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return shingle_join.jaccard_components(table(spark, folder, "documents"))


@query("op13_phrase_trie", """
    WITH d AS (
        SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
            regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS pieces
        FROM documents
    ),
    p AS (
        SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w
        FROM (SELECT lang, unnest(pieces) AS piece FROM d)
    ),
    f AS (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)
        GROUP BY ALL
    ),
    totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 100),
    cuts AS (
        SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS lead, array_to_string(w[cut + 1:], ' ') AS rest
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)
    ),
    scored AS (
        SELECT cuts.lang, cuts.phrase, a, cut, x.f AS l, y.f AS r, n,
            CAST(1000 * CAST(a AS HUGEINT) * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
        FROM cuts JOIN f AS x ON x.lang = cuts.lang AND x.phrase = lead JOIN f AS y ON y.lang = cuts.lang AND y.phrase = rest
            JOIN totals ON totals.lang = cuts.lang
    ),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    inner_ones AS (
        SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
        FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest(range(2, 5)) AS m) WHERE m < k)
        GROUP BY ALL
    )
    SELECT best.lang, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.phrase) AS rank, best.phrase, a, l, r, n, score
    FROM best LEFT JOIN inner_ones ON inner_ones.lang = best.lang AND inner_ones.phrase = best.phrase
    WHERE longer IS NULL OR 100 * longer < 100 * a
    QUALIFY rank <= 2000
""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_trie.mined(table(spark, folder, "documents"))
