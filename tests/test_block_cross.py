import numpy as np

from recspark.operators import block_cross as C


def test_a_task_holds_a_bounded_number_of_candidates(monkeypatch):
    """Findings F8, F12, F20, F21: lists leave a task when there are many, their bars stay, and none of the best is lost."""
    monkeypatch.setattr(C, "HELD", 500)
    rng = np.random.default_rng(5)
    k, scores = 4, np.round(rng.normal(size=(6, 30, 400)), 3)
    best, got, most, left = C.Best(k), {}, 0, 0

    def take(found):
        n = 0
        for key, ids, others, s in found:
            n += len(ids)
            for i, o, v in zip(ids, others, s):
                got.setdefault((key, i), []).append((-v, o))
        return n
    for at in range(0, 400, 50):
        for key in range(6):
            best.bars(key, np.arange(30), np.full(30, -np.inf))
            best.offer(key, np.arange(30), scores[key][:, at:at + 50], np.arange(at, at + 50))
            left += take(best.overflow())
            most = max(most, best._held)
    assert left and most <= 500
    take(best.rows())
    for key in range(6):
        for i in range(30):
            want = sorted((-v, o) for o, v in enumerate(scores[key, i]))[:k]
            assert sorted(got[key, i])[:k] == want


def test_categories_are_crossed_without_copies_of_the_vectors(spark):
    """Finding F9: neighbours of one category, any for vectors without one, by blocks of a category and no shuffled copies."""
    from recspark.operators import knn as K

    rng = np.random.default_rng(8)
    x, cats = rng.normal(size=(160, 5)), [None if n % 9 == 0 else "abc"[n % 3] if n % 31 else "solo" + str(n) for n in range(160)]
    x[7], x[20] = 0, x[21]
    df = spark.createDataFrame([(n, x[n].tolist(), cats[n]) for n in range(160)], "id int, features array<double>, category string")
    got = K.knn_same_category(df, 4, block_rows=8)
    lists = {}
    for r in got.collect():
        lists.setdefault(r.key, []).append((r.rank, r.other, r.score))
    norm = np.linalg.norm(x, axis=1)
    for n in range(160):
        cos = {o: 0.0 if not norm[n] * norm[o] else float(x[n] @ x[o] / norm[n] / norm[o])
               for o in range(160) if o != n and (cats[n] is None or cats[o] == cats[n])}
        want = sorted((-round(c, 9), o) for o, c in cos.items())[:4]
        mine = sorted(lists.get(n, []))
        assert [(r, o) for r, o, _ in mine] == [(i + 1, o) for i, (_, o) in enumerate(want)]
        assert np.allclose([s for _, _, s in mine], [-c for c, _ in want], atol=2e-9)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "FlatMapGroupsInPandas" not in plan
