import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from helpers import canonical
from salesloom.llm import queries

ROOT = "/root/testdata/sf0.001"


def test_registered_queries():
    jobs = driver.queries()
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in jobs) == 1
    assert jobs["pipeline"] is corpus_pipeline.run and len(corpus_pipeline.STAGES) == 5
    assert set(queries.ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{ROOT}/{table}.parquet')")
    df = queries.QUERIES[name](spark, ROOT)
    expected = duck.execute(queries.ORACLES[name])
    columns = [column[0] for column in expected.description]
    assert canonical(df.columns, df.collect()) == canonical(columns, expected.fetchall())


def test_stages_one_after_the_other(spark):
    documents = spark.read.parquet(f"{ROOT}/documents.parquet")
    found = corpus_pipeline.run(spark, ROOT)
    assert {"doc_id", "ids", "sequence_id", "offset"} <= set(found.columns)
    kept = {r.doc_id for r in found.select("doc_id").distinct().collect()}
    assert 0.7 * documents.count() < len(kept) < documents.count()
    texts = {}
    for r in documents.collect():
        texts.setdefault("".join((r.text or "").split()), []).append(r.doc_id)
    assert all(len(kept & set(group)) <= 1 for group in texts.values())


ODD = "doc_id long, text string, lang string, source string, TOXICITY double, _id int, _digest int, _base int, _tokens int"


@pytest.mark.parametrize("number", range(4))
def test_stages_on_odd_tables(spark, number):
    """Nulls, empty and long texts, repeated rows, clashing names, no n_chars, and no rows at all."""
    long_text = " ".join(f"word{i % 700}x{i}" for i in range(20_000))
    plain = "The river runs past the old stone house and the green meadow behind it every single day."
    rows = [(1, None), (2, ""), (3, long_text), (4, plain), (4, plain), (5, plain), (None, plain + " More of it."), (6, "Hi.")]
    docs = spark.createDataFrame([(i, t, None, "s", 0.5, 1, 2, 3, 4) for i, t in rows], ODD)
    stage = corpus_pipeline.STAGES[number][1]
    found = stage(spark, docs, ROOT)
    assert found.columns == docs.columns
    kept = sorted((r.doc_id or 0 for r in found.collect()))
    assert {1, 3, 6} <= set(kept) or number == 1 and {2, 3, 6} & set(kept)
    assert kept.count(4) == (1 if number in (1, 2) else 2) and kept.count(5) == (0 if number in (1, 2) else 1)
    assert stage(spark, docs.limit(0), ROOT).collect() == []


def test_packing_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, 5), (None, "a b", 6), (1, "c", 7)], "doc_id long, text string, tier int")
    found = corpus_pipeline.pack_sequences(spark, docs, ROOT)
    assert {r.doc_id for r in found.collect()} == {1, None}
    assert corpus_pipeline.pack_sequences(spark, docs.limit(0), ROOT).collect() == []
