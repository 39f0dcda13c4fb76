import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.operators import als as A
from recspark.operators.knn import item_cosine, knn, knn_lsh, knn_same_category
from recspark.operators.similarity import sparse_topk


def _brute(vecs, k, metric="cosine"):
    ids = sorted(vecs)
    M = np.array([vecs[i] for i in ids], dtype=float)
    N = M / np.linalg.norm(M, axis=1, keepdims=True)
    S = N @ N.T
    out = {}
    for a, i in enumerate(ids):
        cand = [(round(S[a, b], 9), j) for b, j in enumerate(ids) if j != i]
        cand.sort(key=lambda t: (-t[0], t[1]))
        out[i] = [j for _, j in cand[:k]]
    return out


def test_dense_knn_matches_brute_force_with_many_blocks(spark):
    rng = np.random.default_rng(3)
    vecs = {i: rng.normal(size=8).tolist() for i in range(120)}
    df = spark.createDataFrame([(i, v) for i, v in vecs.items()], "id long, features array<double>")
    got = {}
    for r in knn(df, 5, block_rows=16).collect():
        got.setdefault(r.key, []).append((r.rank, r.other))
    got = {k: [o for _, o in sorted(v)] for k, v in got.items()}
    assert got == _brute(vecs, 5)


def test_sparse_topk_matches_dense(spark):
    rng = np.random.default_rng(5)
    rows, dense = [], {}
    for d in range(60):
        v = np.zeros(30)
        for t in rng.choice(30, size=6, replace=False):
            v[t] = rng.random()
        v /= np.linalg.norm(v)
        dense[d] = v
        rows += [(d, f"t{t}", float(v[t])) for t in np.nonzero(v)[0]]
    df = spark.createDataFrame(rows, "doc long, term string, w double")
    got = {}
    for r in sparse_topk(df, 4, "doc", "term", "w", block_rows=8, block_entries=50).collect():
        got.setdefault(r.key, []).append((r.rank, r.other, r.score))
    ids = sorted(dense)
    M = np.array([dense[i] for i in ids])
    S = M @ M.T
    for a in ids:
        cand = sorted([(round(S[a, b], 9), b) for b in ids if b != a and round(S[a, b], 9) > 0],
                      key=lambda t: (-t[0], t[1]))[:4]
        assert [o for _, o, _ in sorted(got.get(a, []))] == [b for _, b in cand]


def test_same_category_and_null_category(spark):
    rows = [(1, [1.0, 0.0], "x"), (2, [0.9, 0.1], "y"), (3, [0.8, 0.2], "x"), (4, [1.0, 0.01], None)]
    df = spark.createDataFrame(rows, "id long, features array<double>, category string")
    got = {(r.key, r.other) for r in knn_same_category(df, 3).collect()}
    assert (1, 3) in got and (1, 2) not in got and (1, 4) not in got
    assert {o for k, o in got if k == 4} == {1, 2, 3}


def test_lsh_recall_on_planted_clusters(spark):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(20, 16))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    vecs = {}
    for c in range(20):
        for j in range(10):
            vecs[c * 10 + j] = (centres[c] + 0.02 * rng.normal(size=16)).tolist()
    df = spark.createDataFrame([(i, v) for i, v in vecs.items()], "id long, features array<double>")
    exact = _brute(vecs, 5)
    approx = {}
    for r in knn_lsh(df, 5).collect():
        approx.setdefault(r.key, set()).add(r.other)
    hits = sum(len(set(exact[i]) & approx.get(i, set())) for i in exact)
    assert hits / (5 * len(exact)) >= 0.95


def test_item_cosine(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a"), (3, "c")], "user long, item string")
    df = df.withColumn("item", F.when(F.col("item") == "a", 1).when(F.col("item") == "b", 2).otherwise(3))
    got = {(r.key, r.other): round(r.score, 6) for r in item_cosine(df, 2).collect()}
    assert got[(2, 1)] == round(2 / np.sqrt(3 * 2), 6) and got[(3, 1)] == round(1 / np.sqrt(3), 6)


def test_als_fit_and_recommend(spark):
    rows = [(u, i, 1.0) for u in range(1, 21) for i in range(1, 16) if (u * i) % 3 != 0]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double")
    model = A.fit_als(ratings, A.Preset(rank=4, iterations=5, reg=0.1, alpha=10.0))
    mse = A.training_mse(model, ratings).first()
    assert mse.n == len(rows) and mse.mse < 1.0
    recs = A.items_for_users(model, 3)
    per_user = recs.groupBy("user").count().collect()
    n_users = len({u for u, _, _ in rows})
    assert len(per_user) == n_users and all(r["count"] == 3 for r in per_user)
    targets = spark.createDataFrame([(1,), (999,)], "item int")
    got, unknown = A.users_for_targets(model, targets, 2)
    assert [r.item for r in unknown.collect()] == [999]
    assert got.select("item").distinct().count() == 1


def test_als_save_load_and_exclude_seen(spark, tmp_path):
    rows = [(u, i, 1.0) for u in range(1, 9) for i in range(1, 7) if (u + i) % 2 == 0]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double")
    model = A.fit_als(ratings, A.Preset(rank=3, iterations=3, reg=0.1, alpha=5.0))
    back = A.load_model(A.save_model(model, str(tmp_path / "m")))
    a = sorted(tuple(r) for r in A.items_for_users(model, 2).collect())
    b = sorted(tuple(r) for r in A.items_for_users(back, 2).collect())
    assert a == b
    fresh = A.exclude_seen(A.items_for_users(model, 6), ratings)
    seen = {(u, i) for u, i, _ in rows}
    assert all((r.user, r.item) not in seen for r in fresh.collect())


def test_ratings_reuse_or_build(spark, tmp_path):
    from recspark.operators.prepare import ratings_or_build
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([(1, 2, 1.0)], "user int, item int, rating double")
    p = str(tmp_path / "r")
    assert ratings_or_build(spark, p, build).count() == 1
    assert ratings_or_build(spark, p, build).count() == 1
    assert len(calls) == 1
    # other input, and a folder that has lost files, are built anew
    other = spark.range(3)
    assert ratings_or_build(spark, p, build, other).count() == 1 and len(calls) == 2
    assert ratings_or_build(spark, p, build, other).count() == 1 and len(calls) == 2
    for f in glob.glob(f"{p}/data-*/part-*.parquet"):
        os.remove(f)
    assert ratings_or_build(spark, p, build, other).count() == 1 and len(calls) == 3


def test_an_unfinished_write_is_not_reused(spark, tmp_path):
    from recspark.operators.prepare import ratings_or_build

    whole = spark.range(100).select(F.col("id").cast("int").alias("user"), F.lit(1).alias("item"), F.lit(1.0).alias("rating"))
    p = str(tmp_path / "r")
    whole.repartition(4).write.parquet(p)                       # files without a record, two of them lost
    for f in sorted(glob.glob(f"{p}/part-*.parquet"))[:2] + [f"{p}/_SUCCESS"]:
        os.remove(f)
    assert ratings_or_build(spark, p, lambda: whole).count() == 100
    assert ratings_or_build(spark, p, lambda: whole.limit(1)).count() == 100


def test_ann_recall_without_clusters(spark):
    """The registered index finds nine tenths of the exact neighbours and scores under a tenth of all pairs exactly."""
    from recspark.plans import model_queries as M

    for sf, share in (("/root/testdata/sf0.01", 1.0), ("/root/testdata/sf0.1", 0.1)):
        row = M.q_knn_ann(spark, sf).collect()[0]
        assert M.ANN_RECALL >= 0.9 and row.recall_ok and row.scores_ok
        assert M.ANN_INDEX.probes * M.ANN_INDEX.rerank <= share * row.vectors


def test_every_vector_asks_the_index(spark, tmp_path, monkeypatch):
    """The recall of the registered query is that of all vectors, whatever their ids (no id here is divisible by 50)."""
    from recspark.operators import ann
    from recspark.plans import model_queries as M

    asked = []
    seen = ann.recall_of
    monkeypatch.setattr(ann, "recall_of", lambda a, e: (asked.append((a.select("key").distinct().count(), e.count())), seen(a, e))[1])
    rows = [(50 * i + 1, v, 0) for i, (_, v) in enumerate(_clustered(4, 3, 20, 4))]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    row = M.q_knn_ann(spark, str(tmp_path)).first()
    assert asked == [(60, 600)] and row.asDict() == {"vectors": 60, "recall_ok": True, "scores_ok": True}


def test_top_lists_come_from_large_factor_blocks(spark):
    """A row leaves k records for every block of the other side, so blocks are far larger than Spark's default."""
    rows = [(u, i, 1.0) for u in range(30) for i in range(20) if (u + i) % 3]
    model = A.fit_als(spark.createDataFrame(rows, "user int, item int, rating double"), rank=4, iterations=2)
    assert model.getBlockSize() == A.FACTOR_BLOCK >= 16 * 4096
    assert A.items_for_users(model, 3).count() == 90


def _clustered(seed, clusters=20, each=40, dims=16):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(clusters, dims)) * 4
    return [(int(c * each + i), (centre[c] + rng.normal(size=dims) * 0.2).tolist()) for c in range(clusters) for i in range(each)]


@pytest.mark.parametrize("list_rows", [8192, 7])
def test_index_on_clusters(spark, list_rows):
    """On clusters a few lists hold all neighbours; hot lists are cut into parts and lose nothing."""
    from recspark.operators import ann

    rows = _clustered(3) + [(5000 + i, [1.0] * 16) for i in range(60)] + [(9999, None)]
    df = spark.createDataFrame(rows, "id long, features array<double>")
    exact = knn(df.where("features is not null"), 5)
    near = ann.knn_index(df, 5, index=ann.Index(lists=24, probes=3, rerank=60, list_rows=list_rows)).cache()
    assert ann.recall_of(near, exact).first().recall > 0.95
    got = near.groupBy("key").count().collect()
    assert len(got) == 860 and all(r["count"] == 5 for r in got)
    assert near.where("key = other").count() == 0


def test_index_of_named_vectors_and_few(spark):
    from recspark.operators import ann

    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.1]), ("c", [0.0, 1.0]), ("d", [0.0, 0.0])], "id string, features array<double>")
    near = {(r.key, r["rank"]): r.other for r in knn(df, 2, index=ann.Index(lists=2, probes=2)).collect()}
    assert near["a", 1] == "b" and near["c", 1] == "b" and ("d", 1) in near
    assert ann.knn_index(df.limit(0), 2).collect() == []
