import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest

OPS = {n.split("_")[0]: n for n in E.queries() if n.startswith("op")}


def test_every_operator_has_one_query():
    assert sorted(OPS, key=lambda x: int(x[2:])) == [f"op{n}" for n in range(1, 14)]
    assert "pipeline" in E.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "near-duplicates", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if n.startswith("op")))
def test_sql(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(OPS.values()))
def test_empty_tables(spark, empty, name):
    folder, _ = empty
    assert E.queries()[name](spark, folder).collect() == []
