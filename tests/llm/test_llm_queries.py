import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from wattloom.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_all_are_registered():
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(["pipeline", *(f"op{i}" for i in range(1, 14))])


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == want


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        rows = docs.collect()
        left = {r.doc_id for r in rows}
        assert left <= ids and (name != "mixing" or left == ids), name
        ids = left
        docs = spark.createDataFrame(rows, docs.schema)
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert placed.count() == len(rows) and {r.doc_id for r in placed.collect()} == ids


def test_near_copies_by_five_words(spark):
    """One word of 49 changed leaves 40 of 50 runs of five words, and 42 of 50 of four (84 %)."""
    words = [f"w{i}" for i in range(49)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:24], "new", *words[25:]]))]
    rows += [(3, " ".join([*words[:12], "x", *words[13:36], "y", *words[37:]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, SF).collect()) == [1, 3]


def test_pipeline_on_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
