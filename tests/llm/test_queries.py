"""Registered queries against their SQL, and the pipeline's stages on the smallest table."""

import duckdb
import pytest

import corpus_pipeline
from conftest import SF
from pairgrid.llm import load
from pairgrid.llm.common import QUERIES, SQL
from pairgrid.session import staged

load()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    found = sorted((tuple(map(str, r)) for r in got.select(*columns).collect()))
    assert found == sorted(tuple(map(str, r)) for r in result.fetchall())


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(staged(stage(spark, kept[-1], SF), name))
        assert kept[-1].columns == docs.columns
    ids = [[r.doc_id for r in d.select("doc_id").collect()] for d in kept]
    for before, after in zip(ids, ids[1:]):
        assert set(after) <= set(before)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()}
    assert len(clean & set(ids[2])) >= 0.95 * len(clean)
    poor = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert len(poor & set(ids[2])) <= 0.3 * len(poor)
    assert len(ids[3]) == len(set(ids[3]))
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(ids[4])


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_awkward_rows(spark, name):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "Some words to keep here", "en", "a", 5), (3, "Some words to keep here", "en", "a", 5), (None, "More words stand here", None, "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, docs, SF).count() > 0
    assert stage(spark, docs.limit(0), SF).count() == 0
