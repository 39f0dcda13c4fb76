import duckdb

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest


def test_contract_shapes():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 60


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["package", "count", "percentage"]


def _oracle(name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rel = con.sql(E.oracle_sql()[name])
    return rel.columns, rel.fetchall()


FAST = ["install_pairs", "user_ids", "country_share", "interaction_weights", "eval_list_dcg",
        "eval_basket_summary", "coverage_stats", "clean_text", "tfidf_topk_by_category", "knn_exact",
        "knn_same_category", "item_cosine", "metadata_parse", "work_slices", "duplicate_keys"]


def test_oracle_subset_small_sf(spark):
    for name in FAST:
        df = E.queries()[name](spark, SF_SMALL)
        cols, rows = df.columns, [tuple(r) for r in df.collect()]
        ocols, orows = _oracle(name)
        assert sorted(cols) == sorted(ocols), name
        assert digest(cols, rows)[0] == digest(ocols, orows)[0], name
