"""Plan-shape checks: the physical plans are the intended ones."""

import numpy as np

from recspark.operators import evaluate as ev
from recspark.operators.knn import knn
from recspark.operators.tfidf import similar_documents, tfidf
from recspark.plans import fixtures as fx
from tests.conftest import SF_SMALL


def _plan(df):
    df.write.format("noop").mode("overwrite").save()   # run once so AQE shows the final plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_topk_uses_window_group_limit(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(50)], "id long, features array<double>")
    plan = knn(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_similarity_and_basket_plans_have_no_pair_products(spark):
    docs = fx.table(spark, SF_SMALL, "documents")
    _, _, w = tfidf(docs, "doc_id", "text", ["lang", "source"])
    plan = _plan(similar_documents(w, 5, ["lang", "source"]))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    recs = fx.recs(spark, SF_SMALL)
    plan = _plan(ev.evaluate_baskets(recs, fx.baskets(spark, SF_SMALL), 10, fx.test_keys(spark, SF_SMALL, 50)))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_scans_are_pruned(spark):
    plan = fx.install_log(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "l_extendedprice" not in plan
