"""Registered queries against their DuckDB twins on the smallest scale factor."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from tessera.sources.tables import TABLE_NAMES

SAMPLE = ["top_items_decay", "user_item_decay", "time_split_test", "ab_assignment", "feed_content",
          "tag_cosine", "similar_parts", "user_cf_topn", "bias_baseline", "clean_news", "tfidf_weights",
          "classification_report", "roc_auc", "context_followup", "extractive_summary", "rouge_n",
          "embedding_topk", "upsert_latest"]


def _canon(df):
    cols = sorted(df.columns)
    rows = []
    for r in df[cols].itertuples(index=False, name=None):
        rows.append(tuple(None if (isinstance(x, float) and math.isnan(x)) else
                          (round(x, 6) if isinstance(x, float) else x) for x in r))
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_every_query_has_sql_or_is_rows_only():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 80


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_duckdb(spark, sf, con, name):
    got = E.queries()[name](spark, sf).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert _canon(got) == _canon(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["user_id", "item_id", "score", "rank"]
