import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.operators import als as A
from recspark.operators import als_fit as L
from recspark.session import checkpoint_dir


def _sides(model):
    return [{r.id: np.array(r.features, dtype=np.float64) for r in f.collect()} for f in (model.userFactors, model.itemFactors)]


def _closed_form(rows, users, items, rank, reg, alpha):
    """The users' vectors for these items: what Spark's implicit ALS solves, one user at a time."""
    y = np.array(list(items.values()))
    own, out = {}, {}
    for u, i, r in rows:
        own.setdefault(u, []).append((i, r))
    for u, rated in own.items():
        x, r = np.array([items[i] for i, _ in rated]), np.array([r for _, r in rated])
        c = alpha * np.abs(r)
        left = y.T @ y + (x * c[:, None]).T @ x + reg * (r > 0).sum() * np.eye(rank)
        out[u] = np.linalg.solve(left, np.where(r > 0, 1 + c, 0.0) @ x)
    assert out.keys() == users.keys()
    return out


@pytest.mark.parametrize("blocks", [None, 7])
def test_last_half_step_is_the_closed_form(spark, blocks):
    """Findings F1, F2: rows of few and many ratings, beyond HOT too, negative and zero ratings, pairs that come twice."""
    rng = np.random.default_rng(3)
    rows = [(int(u) - 20, int(i), float(r)) for u, i, r in zip(rng.integers(0, 90, 2000), rng.integers(0, 60, 2000),
                                                                   rng.choice([1.0, 2.0, 5.0, -10.0, 0.0], 2000))]
    rows += [(1000 + n, n % 60, 1.0) for n in range(40)] + [(1000 + n, n % 60, 1.0) for n in range(40)]
    rows += [(5000, n, 1.0 if n % 3 else -2.0) for n in range(L.HOT + 500)]
    df = spark.createDataFrame(rows, "user int, item int, rating double").repartition(3)
    model = A.fit_als(df, A.Preset(rank=9, iterations=4, reg=0.1, alpha=5.0), num_blocks=blocks)
    users, items = _sides(model)
    want = _closed_form(rows, users, items, 9, 0.1, 5.0)
    assert {i for _, i, _ in rows} == items.keys()
    for u, x in want.items():
        assert np.allclose(users[u], x, atol=1e-5 * max(1.0, np.abs(x).max()))


def test_factors_of_earlier_steps_are_removed(spark):
    """Finding F2: disk holds the model and not each step's factors, and no step shuffles factors."""
    rows = [(u, i, 1.0) for u in range(30) for i in range(20) if (u + i) % 3]
    df = spark.createDataFrame(rows, "user int, item int, rating double")
    scratch = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "scratch")
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    model = A.fit_als(df, rank=4, iterations=5)
    made = sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(scratch)) - before if os.listdir(f"{scratch}/{x}"))
    assert made == ["als-item-factors", "als-user-factors"]
    assert A.training_mse(model, df).first().n == len(rows)
    assert "ShuffleQueryStage" not in model.userFactors._jdf.queryExecution().executedPlan().toString()


def test_ids_and_ratings_that_do_not_fit_are_errors(spark):
    for bad in ((None, 1, 1.0), (1, None, 1.0), (1, 1, None), (1, 1, float("nan"))):
        df = spark.createDataFrame([(1, 1, 1.0), bad], "user int, item int, rating double")
        with pytest.raises(Exception, match="whole numbers|must not be null"):
            A.fit_als(df, rank=2, iterations=1)
    big = spark.createDataFrame([(1, 1, 1.0)], "user int, item int, rating double").select((F.col("user") + F.lit(1 << 40)).alias("user"), "item", "rating")
    with pytest.raises(Exception, match="whole numbers"):
        A.fit_als(big, rank=2, iterations=1)
