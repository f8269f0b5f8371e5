"""The registered queries and the pipeline on the smallest driver tables."""

import hashlib
import zlib
from pathlib import Path

import duckdb
import pytest
from conftest import values

import corpus_pipeline
from check_queries import compare
from tierflow.llm import private_spans, queries

FOLDER = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="driver tables are not here")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_with_a_statement(spark, name):
    con = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")

    import __spark_entry__ as spark_entry

    assert spark_entry.oracle_sql()[name] == queries.ORACLES[name]
    result = compare(spark, con, str(FOLDER), name)
    assert result.startswith("ok") and " type " not in result, result


def documents(spark):
    return {r["doc_id"]: r for r in queries.table(spark, str(FOLDER), "documents").collect()}


def test_held_out_languages_are_right(spark):
    docs = documents(spark)
    got = queries.QUERIES["op6_language_families"](spark, str(FOLDER)).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(docs) and {r["doc_id"] for r in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.97 * len(held)


def test_private_spans_of_documents(spark):
    docs = documents(spark)
    for r in queries.QUERIES["op5_private_spans"](spark, str(FOLDER)).collect():
        base = private_spans.base_spans(docs[r["doc_id"]]["text"] or "")
        joined = [f"{k}:{a}:{b}" for k, a, b in sorted(base, key=lambda s: (private_spans.KINDS.index(s[0]), s[1]))]
        assert r["base_sha256"] == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(r["spans"].split(",")) or not joined


def test_every_row_comes_back(spark):
    n = len(documents(spark))
    for name in ("op3_simhash_trees", "op7_severity_grades", "op8_sentence_pieces", "op9_backoff_automaton"):
        assert queries.QUERIES[name](spark, str(FOLDER)).count() == n, name
    talk = queries.table(spark, str(FOLDER), "conversations").count()
    replies = queries.QUERIES["op4_quotation_links"](spark, str(FOLDER))
    assert replies.count() == talk and replies.filter("turn > 0 and parent_turn is null").count() == 0


def test_pipeline(spark):
    docs, out, kept = queries.table(spark, str(FOLDER), "documents"), corpus_pipeline.run(spark, str(FOLDER)), None
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and out.columns[0] == "doc_id"
    kept = {r["doc_id"] for r in out.collect()}
    leaks = {r["doc_id"] for r in queries.QUERIES["op10_spaced_seeds"](spark, str(FOLDER)).collect()}
    assert kept and not kept & leaks and kept < {r[0] for r in values(docs, "doc_id")}
    texts = [r["text"] for r in docs.collect() if r["doc_id"] in kept]
    assert len(texts) == len(set(texts))


def test_pipeline_of_an_empty_table(spark):
    docs = queries.table(spark, str(FOLDER), "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(FOLDER))
    assert docs.count() == 0
