"""The evaluation grid against a plain Python evaluation of each of its runs."""

import random

import pytest

from recspark.operators.evaluate import basket_grid, basket_summary


def _plain(recs, baskets, n, keys):
    held = {}
    for basket, item in set(baskets):
        held.setdefault(basket, set()).add(item)
    first = {}
    for key, pos, other in recs:
        if key in keys and pos < n:
            first[key, other] = min(pos, first.get((key, other), pos))
    of_key = {}
    for (key, other), pos in first.items():
        of_key.setdefault(key, {})[other] = pos
    scores = []
    for key in {k for k, _, _ in recs} & set(keys):
        gains = [sum(1 - pos / n for other, pos in of_key.get(key, {}).items() if other in b) / (len(b) - 1) if len(b) > 1 else 0
                 for b in held.values() if key in b]
        if gains:
            scores.append(sum(gains) / (((n + 1) / 2) / n) / len(gains))
    return len(held), len({k for k, _, _ in recs} & set(keys)), len(set(keys)), sum(scores), len(scores)


def test_grid_of_all_sets(spark):
    rng = random.Random(5)
    items = [f"i{k}" for k in range(12)]
    recs = [(run, k, pos, rng.choice(items)) for run in ("a", "b") for k in items[:9] if not (run == "b" and k == "i0")
            for pos in range(rng.randrange(1, 8))]
    recs += [("a", "i1", 3, "i1")]                                    # a key in its own list
    baskets = [(v, basket, rng.choice(items)) for v in ("x", "y") for basket in range(15) for _ in range(rng.randrange(1, 5))]
    baskets += [("y", 99, "i1"), ("y", 99, "i1")]                     # a repeated row, a basket of one
    keysets = [("s", k) for k in items[:4]] + [("t", k) for k in items[3:]] + [("u", "unknown"), ("s", "i0")]
    got = basket_grid(spark.createDataFrame(recs, "run string, key string, pos int, other string"),
                      spark.createDataFrame(baskets, "vset string, basket long, item string"), (2, 5, 5),
                      spark.createDataFrame(keysets, "keyset string, key string")).collect()
    assert len(got) == 2 * 2 * 3 * 2
    for r in got:
        want = _plain([x[1:] for x in recs if x[0] == r.run], [x[1:] for x in baskets if x[0] == r.vset], r.n,
                      [k for s, k in keysets if s == r.keyset])
        assert (r.users, r.recs, r["keys"], r.n_keys) == (want[0], want[1], want[2], want[4])
        assert r.sum_dcg == pytest.approx(want[3])
        assert r.avg_dcg == (pytest.approx(want[3] / want[4]) if want[4] else None)


def test_grid_without_sets_equals_single_evaluations(spark):
    recs = spark.createDataFrame([("a", 0, "b"), ("a", 1, "c"), ("b", 0, "c")], "key string, pos int, other string")
    baskets = spark.createDataFrame([(1, "a"), (1, "c"), (2, "b"), (2, "c"), (3, "a")], "basket long, item string")
    keys = spark.createDataFrame([("a",), ("b",)], "key string")
    for r in basket_grid(recs, baskets, (1, 2), keys.selectExpr("'all' AS keyset", "key")).collect():
        one = basket_summary(recs, baskets, r.n, keys).first()
        assert (r.users, r.recs, r["keys"], r.n_keys) == (one.users, one.recs, one["keys"], one.n_keys)
        assert r.sum_dcg == pytest.approx(one.sum_dcg)
    none = basket_grid(recs.where("false"), baskets.where("false"), (1,), keys.selectExpr("'all' AS keyset", "key")).collect()
    assert [(r.users, r.recs, r["keys"], r.sum_dcg, r.n_keys, r.avg_dcg) for r in none] == [(0, 0, 2, 0.0, 0, None)]
