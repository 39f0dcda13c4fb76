"""Queries that read one derived input several times write it once (findings F25, F27, F28)."""

from recspark.operators import evaluate as ev
from recspark.operators import prepare as prep
from recspark.plans import file_queries as fq
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_runs_are_parsed_once(spark):
    lines = spark.createDataFrame([("a,b:1", 1, "r"), ("b,a:2", 2, "r")], "value string, line_order long, run string")
    truth = spark.createDataFrame([("a", "b")], "key string, item string")
    out = ev.evaluate_runs(lines, truth, 10)
    assert "LogicalRDD" not in _plan(out) and "LocalRelation" not in _plan(out)
    assert [r.number_lines for r in out.collect()] == [2]


def _sources(monkeypatch):
    found = []
    real = prep.ratings_or_build
    monkeypatch.setattr(prep, "ratings_or_build", lambda s, path, build, source: (
        found.append((source, build())), real(s, path, build, source))[1])
    return found


def test_reused_ratings_are_prepared_once(spark, monkeypatch):
    found = _sources(monkeypatch)
    fq.q_ratings_reused(spark, SF_SMALL)
    assert len(found) == 2 and all("lineitem" not in _plan(s) and "Join" not in _plan(s) for s, _ in found)


def test_rebuilt_ratings_are_prepared_once(spark, monkeypatch):
    found = _sources(monkeypatch)
    fq.q_ratings_rebuilt(spark, SF_SMALL)
    assert len(found) == 2 and all("Join" not in _plan(x) for both in found for x in both)
