import datetime as dt

from pyspark.sql import functions as F

from recspark.operators import prepare as prep
from recspark.operators.affinity import country_share, drop_negative_only, interaction_weights
from recspark.operators.ids import assign_ids, continue_ids, work_slices


def test_month_window_crosses_year(spark):
    start, end = prep.month_bounds("2000-02-15", 3)
    assert (start, end) == (dt.date(1999, 11, 1), dt.date(2000, 2, 1))
    rows = [(1999, m) for m in range(9, 13)] + [(2000, 1), (2000, 2)]
    df = spark.createDataFrame(rows, "year int, month int")
    got = sorted(tuple(r) for r in prep.month_window(df, "2000-02-15", 3).collect())
    assert got == [(1999, 11), (1999, 12), (2000, 1)]


def test_month_window_prunes_partitions(spark, tmp_path):
    df = spark.createDataFrame([("u", "com.a.b", 1999, 12), ("u", "com.a.c", 2000, 2)],
                               "hash string, pkg string, year int, month int")
    df.write.partitionBy("year", "month").parquet(str(tmp_path / "log"))
    out = prep.read_install_log(spark, str(tmp_path / "log"), "2000-02-15", 3)
    assert [r.pkg for r in out.collect()] == ["com.a.b"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan


def test_wellformed_and_array_items(spark):
    df = spark.createDataFrame([("u", ["android", "com.a"]), ("v", ["com.a"])], "hash string, pkg array<string>")
    pairs = prep.install_pairs(df)
    assert pairs.count() == 3
    assert sorted(r.package for r in prep.wellformed_items(pairs).collect()) == ["com.a", "com.a"]


def test_blacklist_exact_vs_regex(spark):
    df = spark.createDataFrame([("u", "com.a"), ("u", "comXa"), ("u", "x.promo.y"), ("u", "com.b")],
                               "hash string, package string")
    exact = {r.package for r in prep.filter_blacklist(df, names=["com.a"], patterns=["promo"]).collect()}
    assert exact == {"comXa", "com.b"}
    regex = {r.package for r in prep.filter_blacklist(df, names=["com.a"], patterns=["promo"], mode="regex").collect()}
    assert regex == {"com.b"}
    assert prep.filter_blacklist(df, names=[], patterns=[]).count() == 4


def test_min_downloads_strict(spark):
    pairs = spark.createDataFrame([("u", "p500"), ("u", "p501")], "hash string, package string")
    idmap = spark.createDataFrame([(1, "p500"), (2, "p501")], "id long, data string")
    dl = spark.createDataFrame([(1, 500.0), (2, 501.0)], "app_package long, downloads double")
    out = prep.filter_min_downloads(pairs, idmap, dl)
    assert [r.package for r in out.collect()] == ["p501"]


def test_assign_ids_dense_in_key_order(spark):
    df = spark.createDataFrame([(k,) for k in ["d", "b", "a", "c", "b", "e"] * 3], "k string")
    ids = {r.k: r.id for r in assign_ids(df, "k", "id", num_partitions=3).collect()}
    assert ids == {"a": 1, "b": 2, "c": 3, "d": 4, "e": 5}
    more = spark.createDataFrame([("e",), ("f",), ("g",)], "k string")
    cont = {r.k: r.id for r in continue_ids(assign_ids(df, "k", "id", id_type="long"), more, "k").collect()}
    assert cont == {"f": 6, "g": 7}
    sl = work_slices(assign_ids(df, "k", "line", id_type="long"), "line", 2).collect()
    assert {r.k: r.slice for r in sl} == {"a": 0, "b": 0, "c": 0, "d": 1, "e": 1}


def test_encode_and_histogram(spark):
    pairs = spark.createDataFrame([("u1", "com.a"), ("u2", "com.a"), ("u2", "com.b")], "hash string, package string")
    _, users, items, ratings = prep.prepare_ratings(pairs)
    h = {r.package: (r["count"], round(r.percentage, 4)) for r in prep.item_histogram(ratings, items).collect()}
    assert h == {"com.a": (2, 66.6667), "com.b": (1, 33.3333)}


def test_country_share_null_country(spark):
    pairs = spark.createDataFrame([("u1", "a"), ("u2", "a"), ("u3", "b")], "hash string, package string")
    ret = spark.createDataFrame([("u1", "PT"), ("u3", "PT")], "hash string, country string")
    rows = {(r.package, r.country): r for r in country_share(pairs, ret).collect()}
    assert rows[("a", None)].per_country is None and rows[("a", None)].quo == 0.5
    assert rows[("a", "PT")].per_country == 2 and rows[("a", "PT")].per_app == 2


def test_interaction_weights_and_negative_only(spark):
    df = spark.createDataFrame([(1, 10, c) for c in [0, 1, 2, 3, 4, 5, 7]] + [(2, 11, 4)],
                               "user int, item int, code int")
    w = [r.rating for r in interaction_weights(df).orderBy("user", "code").collect()]
    assert w == [1.0, 2.0, 5.0, 5.0, -10.0, 20.0, 7.0, -10.0]
    kept, removed = drop_negative_only(interaction_weights(df))
    assert {(r.side, r.id) for r in removed.collect()} == {("user", 2), ("item", 11)}
    assert kept.where(F.col("user") == 2).count() == 0


def test_assign_ids_independent_of_partitioning(spark):
    keys = [f"k{i:05d}" for i in range(0, 3000, 7)]
    df = spark.createDataFrame([(k,) for k in keys * 2], "k string")
    a = {r.k: r.id for r in assign_ids(df.repartition(7), "k", "id", num_partitions=5).collect()}
    b = {r.k: r.id for r in assign_ids(df.repartition(3), "k", "id", num_partitions=11).collect()}
    assert a == b == {k: i + 1 for i, k in enumerate(sorted(keys))}
