"""Queries that SQL can express agree with DuckDB; the others run and return
one row per row of their table."""

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from tallyhawk.llm import catalog
from tests.conftest import SF_SMALL

catalog.load_all()
TABLES = ("documents", "embeddings", "pages", "labels", "conversations")
PER_ROW = {"op2_toxicity": "documents", "op3_simhash": "documents", "op5_bpe": "documents", "op7_quality": "documents",
           "op10_suffix": "documents", "op11_substring": "documents"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def rows_of(pdf):
    cols = sorted(pdf.columns)
    def norm(v):
        if pd.isna(v):
            return None
        return (int(v) if v.is_integer() else round(v, 6)) if isinstance(v, float) else v
    return cols, sorted((tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False)),
                        key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_matches_duckdb(spark, con, name):
    assert rows_of(catalog.QUERIES[name](spark, SF_SMALL).toPandas()) == rows_of(con.execute(catalog.ORACLE[name]).df())


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_one_row_per_row(spark, con, name):
    n = con.execute(f"select count(*) from {PER_ROW[name]}").fetchone()[0]
    out = catalog.QUERIES[name](spark, SF_SMALL)
    assert out.count() == n == out.select("doc_id").distinct().count()


BY_COMPONENT = {"op13_whitening"}  # 32 rows per vector; against brute force in test_whitening


def test_every_query_is_covered():
    assert set(catalog.QUERIES) == set(catalog.ORACLE) | set(PER_ROW) | BY_COMPONENT


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "suffix-array dedup", "source mix", "BPE tokens"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == columns
        docs = docs.cache()
        assert 0 < docs.count() <= before
        before = docs.count()
    assert docs.where("length(text) <> n_chars").count() == 0
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert {"doc_id", "source", "ids", "n_tokens", "text"} <= set(out.columns)
    assert out.where("size(ids) <> n_tokens").count() == 0
    assert set(r[0] for r in out.select("doc_id").distinct().collect()) <= {r[0] for r in docs.select("doc_id").collect()}
