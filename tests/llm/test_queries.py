"""The registered queries against their DuckDB twins."""
import duckdb
import pytest

import __spark_entry__ as E
from tessera.sources.tables import TABLE_NAMES


@pytest.mark.parametrize("name", [n for n in E.oracle_sql() if n.startswith("op")])
def test_query_matches_duckdb(spark, sf, name):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(E.oracle_sql()[name]).df()
    got = E.queries()[name](spark, sf).toPandas()[list(want.columns)]
    rows = lambda d: sorted(tuple(str(round(x, 9)) if isinstance(x, float) else str(x) for x in r)
                            for r in d.itertuples(index=False, name=None))
    assert rows(got) == rows(want) and len(want)


def test_all_thirteen_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)} and "pipeline" in names
