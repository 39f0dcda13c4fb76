"""Registered queries of the neighbour and ALS families."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import als as A
from ..operators import ann
from ..operators import knn as K
from ..operators import prepare as prep
from ..operators.ids import assign_ids
from ..session import written
from . import fixtures as fx
from .fixtures import with_
from .prep_queries import _prepared

TOPK = 10
NO_LABEL_ABOVE = 0.16
ALS_K = 10
UNSEEN_K = 10
PREFILTER_K = 50
ANN_RECALL = 0.9      # of the exact lists, on vectors without clusters; on clusters it is tested to be above 0.95
# what that recall takes on vectors without clusters: most lists are looked into, few vectors are scored exactly
ANN_INDEX = ann.Index(lists=32, probes=22, rerank=8)


def _vectors(spark, d):
    """Vectors; those whose first coordinate is large have no category."""
    label = F.when(F.col("embedding")[0] <= NO_LABEL_ABOVE, F.col("label"))
    return fx.table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features"), label.alias("category"))


def _r6(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.round(c, 6))
    return df


def q_knn_exact(spark, d):
    return _r6(K.knn(_vectors(spark, d), TOPK), "score")


def q_knn_euclidean(spark, d):
    return _r6(K.knn(_vectors(spark, d), TOPK, metric="sq_euclidean_unit"), "score")


def q_knn_same_category(spark, d):
    return K.rank_score(K.knn_same_category(_vectors(spark, d), TOPK), TOPK)


def q_knn_ann(spark, d):
    """Vectors, whether the lists of all of them hold enough of the exact ones, and whether scores are true cosines."""
    v = _vectors(spark, d)
    approx = written(K.knn(v, TOPK, index=ANN_INDEX), "knn-approximate")
    exact = written(K.knn(v, TOPK), "knn-exact")
    wrong = (exact.select("key", "other", "score").join(approx.select("key", "other", F.col("score").alias("approx")), ["key", "other"])
             .agg(F.coalesce(F.max(F.abs(F.col("approx") - F.col("score"))), F.lit(0.0)).alias("wrong")))
    n = v.agg(F.count(F.lit(1)).alias("vectors"))
    return n.crossJoin(ann.recall_of(approx, exact)).crossJoin(wrong).select(
        "vectors", (F.col("recall") >= ANN_RECALL).alias("recall_ok"), (F.col("wrong") < 1e-6).alias("scores_ok"))


def q_knn_prefiltered(spark, d):
    nb = K.knn_same_category(_vectors(spark, d), TOPK, prefilter_k=PREFILTER_K)
    return K.rank_score(nb, TOPK)


def _installs(spark, d):
    li = fx.table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    o = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")).distinct()


def q_item_cosine(spark, d):
    return _r6(K.item_cosine(_installs(spark, d), TOPK), "score")


# ------------------------------------------------------------------ ALS
# A fitted model has no SQL form.  The registered queries state properties that
# any right model has, key by key, so that the oracle can list them.
def _fit(spark, d, preset):
    """Users, items, ratings of the prepared install matrix, and the model fitted to them."""
    _, users, items, ratings = prep.prepare_ratings(_prepared(spark, d))
    return users, items, ratings, A.fit_als(ratings, preset)


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def _list_properties(recs, key, other, model):
    """Per key: list length, whether ranks are 1..n, scores fall, and each score is the product of its factors."""
    k = A.factors(model, key).select(F.col("id").alias(key), F.col("features").alias("fk"))
    o = A.factors(model, other).select(F.col("id").alias(other), F.col("features").alias("fo"))
    scored = recs.join(k, key).join(o, other).select(
        key, "rank", "score", (F.abs(_dot(F.col("fk"), F.col("fo")) - F.col("score")) < 1e-3).alias("dot_ok"))
    falls = F.lag("score").over(Window.partitionBy(key).orderBy("rank"))
    scored = scored.withColumn("falls", F.coalesce(falls >= F.col("score") - 1e-6, F.lit(True)))
    return scored.groupBy(F.col(key).cast("long").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), ((F.min("rank") == 1) & (F.max("rank") == F.count(F.lit(1)))).alias("ranks_ok"),
        F.every("falls").alias("falls"), F.every("dot_ok").alias("dot_ok"))


def q_als_train_mse(spark, d):
    """Training pairs, and whether the squared error is below that of predicting nothing (1)."""
    _, _, ratings, model = _fit(spark, d, "users_for_items")
    return A.training_mse(model, ratings).select("n", (F.col("mse") < 1.0).alias("below_one"))


def q_als_factors(spark, d):
    """Every trained id with the length of its factor and whether that is a finite vector."""
    model = _fit(spark, d, "users_for_items")[3]

    def side(name):
        ok = F.forall("features", lambda x: ~F.isnan(x) & (F.abs(x) < 1e6))
        return A.factors(model, name).select(F.lit(name).alias("side"), F.col("id").cast("long").alias("id"),
                                             F.size("features").alias("dims"), ok.alias("finite"))
    return side("item").unionByName(side("user"))


def q_als_items_for_users(spark, d):
    model = _fit(spark, d, "items_for_users")[3]
    return _list_properties(A.items_for_users(model, ALS_K), "user", "item", model)


def q_als_users_for_items(spark, d):
    model = _fit(spark, d, "users_for_items")[3]
    return _list_properties(A.users_for_items(model, ALS_K), "item", "user", model)


def _targets(spark, d, items):
    keys = fx.test_keys(spark, d, 1000)
    return keys.join(items, keys.key == items.package, "left").select(F.col("key").alias("package"), "app_id")


def q_als_users_for_targets(spark, d):
    _, items, _, model = _fit(spark, d, "challenge")
    t = _targets(spark, d, items).where(F.col("app_id").isNotNull()).select(F.col("app_id").alias("item"))
    recs, _ = A.users_for_targets(model, t, ALS_K)
    return _list_properties(recs, "item", "user", model)


def q_als_unknown_targets(spark, d):
    """Targets without an id in the training data: listed, not dropped silently (no model is needed to tell)."""
    items = assign_ids(_prepared(spark, d), "package", "app_id")
    return _targets(spark, d, items).where(F.col("app_id").isNull()).select("package")


def q_exclude_seen(spark, d):
    """Lists of the brand's best sellers without the items of the key's first order, filled to 10."""
    recs = fx.recs(spark, d).select("key", "other", "score")
    seen = fx.truth(spark, d).select("key", F.col("item").alias("other"))
    out = A.exclude_seen(recs, seen, "key", "other", k=UNSEEN_K)
    return out.select("key", F.col("rank").cast("int").alias("rank"), "other", "score")


def _interactions(spark, d):
    """Events as weighted interactions with the negative-only guard (P6, hard item 2); an entity is a user's day."""
    from ..operators.affinity import drop_negative_only
    from .prep_queries import weighted_events
    day = F.col("user_id") * 1000 + F.dayofyear("ts")
    w = weighted_events(spark, d, day).select(F.col("user").cast("int").alias("user"),
                                              F.col("item").cast("int").alias("item"), "rating")
    return drop_negative_only(w)


def q_negative_only_removed(spark, d):
    return _interactions(spark, d)[1]


def q_als_interactions_mse(spark, d):
    """Challenge preset on the weighted interactions; entities with only negative weights removed first."""
    kept, _ = _interactions(spark, d)
    kept = kept.checkpoint()
    # many users of two or three ratings: their solutions are nearly all of the work, so they are cut for all cores
    model = A.fit_als(kept, "challenge", user_blocks=max(10, 3 * spark.sparkContext.defaultParallelism))
    return A.training_mse(model, kept).select("n", (F.col("mse") < 100.0).alias("below_hundred"))


def item_to_item(spark, d, index=None):
    """E1 end to end: ALS item factors -> cosine kNN in the same category -> names; exact unless an index is given."""
    _, items, _, model = _fit(spark, d, "item_to_item")
    cats = fx.categories(spark, d)
    vec = (A.factors(model, "item").join(items, F.col("id") == F.col("app_id"))
           .join(cats, "package", "left").select("id", "features", "category"))
    prefilter = PREFILTER_K if index else None
    nb = K.rank_score(K.knn_same_category(vec, TOPK, prefilter_k=prefilter, index=index), TOPK)
    return _named(nb, items.select(F.col("app_id").alias("id"), F.col("package").alias("name")))


def user_to_user(spark, d, index=None):
    """User factors on both sides (R5) -> cosine kNN, exact unless an index is given -> W6 scores."""
    users, _, _, model = _fit(spark, d, "user_to_user")
    nb = K.rank_score(K.knn(A.factors(model, "user"), TOPK, index=index), TOPK)
    return _named(nb, users.select(F.col("user_id").alias("id"), F.col("hash").alias("name")))


def _named(nb, names):
    return (nb.join(names.withColumnsRenamed({"id": "key", "name": "key_name"}), "key")
            .join(names.withColumnsRenamed({"id": "other", "name": "other_name"}), "other")
            .select(F.col("key_name").alias("key"), "rank", F.col("other_name").alias("other"), "score"))


def _neighbour_properties(nb):
    """Per key: list length, ranks 1..n, scores k..k-n+1, no neighbour twice or the key itself."""
    n = F.count(F.lit(1))
    return nb.groupBy("key").agg(
        n.alias("n"), ((F.min("rank") == 1) & (F.max("rank") == n)).alias("ranks_ok"),
        F.every(F.col("score") == TOPK - F.col("rank") + 1).alias("scores_ok"),
        ((F.countDistinct("other") == n) & F.every(F.col("other") != F.col("key"))).alias("others_ok"))


def q_item_to_item(spark, d):
    """Properties of the item lists; items without category choose among all, others within theirs."""
    return _neighbour_properties(item_to_item(spark, d))


def q_user_to_user(spark, d):
    return _neighbour_properties(user_to_user(spark, d))


def q_user_to_user_ann(spark, d):
    """The same from the fitted index; a list may be shorter, so its length is not among the properties."""
    return _neighbour_properties(user_to_user(spark, d, ann.Index())).drop("n")


def q_unseen_items_for_users(spark, d):
    """A real model's items per user without those the user has: list length, order, and that none is a rated one."""
    _, _, ratings, model = _fit(spark, d, "items_for_users")
    recs = A.unseen_items_for_users(model, ratings, UNSEEN_K)
    rated = ratings.select("user", "item", F.lit(True).alias("rated"))
    n = F.count(F.lit(1))
    return recs.join(rated, ["user", "item"], "left").groupBy(F.col("user").cast("long").alias("key")).agg(
        n.alias("n"), ((F.min("rank") == 1) & (F.max("rank") == n)).alias("ranks_ok"),
        (F.countDistinct("item") == n).alias("items_ok"), F.every(F.col("rated").isNull()).alias("unseen"))


QUERIES = {
    "knn_exact": q_knn_exact,
    "knn_euclidean": q_knn_euclidean,
    "knn_same_category": q_knn_same_category,
    "knn_ann": q_knn_ann,
    "knn_prefiltered": q_knn_prefiltered,
    "item_cosine": q_item_cosine,
    "als_train_mse": q_als_train_mse,
    "als_factors": q_als_factors,
    "als_items_for_users": q_als_items_for_users,
    "als_users_for_items": q_als_users_for_items,
    "als_users_for_targets": q_als_users_for_targets,
    "als_unknown_targets": q_als_unknown_targets,
    "exclude_seen": q_exclude_seen,
    "negative_only_removed": q_negative_only_removed,
    "als_interactions_mse": q_als_interactions_mse,
    "item_to_item": q_item_to_item,
    "user_to_user": q_user_to_user,
    "user_to_user_ann": q_user_to_user_ann,
    "unseen_items_for_users": q_unseen_items_for_users,
}

_V = f"""WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e,
                    CASE WHEN embedding[1] <= {NO_LABEL_ABOVE} THEN label END AS category,
                    sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS nrm
             FROM embeddings),
p AS (SELECT a.id AS key, b.id AS other, a.category AS ca, b.category AS cb,
             list_dot_product(a.e, b.e) / (a.nrm * b.nrm) AS cos FROM v a JOIN v b ON a.id <> b.id)
"""

SQL = {
    "knn_exact": _V + f"""
        SELECT key, CAST(rk AS INTEGER) AS rank, other, round(cos, 6) AS score FROM (
            SELECT *, row_number() OVER (PARTITION BY key ORDER BY round(cos, 9) DESC, other) AS rk FROM p)
        WHERE rk <= {TOPK}""",
    "knn_euclidean": _V + f"""
        SELECT key, CAST(rk AS INTEGER) AS rank, other, round(d, 6) AS score FROM (
            SELECT *, greatest(2.0 - 2.0 * cos, 0.0) AS d,
                   row_number() OVER (PARTITION BY key ORDER BY round(greatest(2.0 - 2.0 * cos, 0.0), 9), other) AS rk
            FROM p)
        WHERE rk <= {TOPK}""",
    "knn_same_category": _V + f"""
        SELECT key, CAST(rk AS INTEGER) AS rank, other, CAST({TOPK} - rk + 1 AS INTEGER) AS score FROM (
            SELECT *, row_number() OVER (PARTITION BY key ORDER BY round(cos, 9) DESC, other) AS rk
            FROM p WHERE ca = cb OR ca IS NULL)
        WHERE rk <= {TOPK}""",
    "knn_prefiltered": _V + f"""
        , n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY round(cos, 9) DESC, other) AS nr FROM p)
        SELECT key, CAST(rk AS INTEGER) AS rank, other, CAST({TOPK} - rk + 1 AS INTEGER) AS score FROM (
            SELECT *, row_number() OVER (PARTITION BY key ORDER BY nr) AS rk FROM n
            WHERE nr <= {PREFILTER_K} AND (ca = cb OR ca IS NULL))
        WHERE rk <= {TOPK}""",
    "knn_ann": "SELECT count(*) AS vectors, true AS recall_ok, true AS scores_ok FROM embeddings",
    "item_cosine": f"""
        WITH i AS (SELECT DISTINCT o.o_custkey AS u, l.l_partkey AS item
                   FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
        n AS (SELECT item, count(*) AS c FROM i GROUP BY item),
        co AS (SELECT a.item AS key, b.item AS other, count(*) AS c FROM i a JOIN i b ON a.u = b.u AND a.item <> b.item
               GROUP BY a.item, b.item),
        s AS (SELECT co.key, co.other, co.c / (sqrt(na.c) * sqrt(nb.c)) AS cos
              FROM co JOIN n na ON co.key = na.item JOIN n nb ON co.other = nb.item)
        SELECT key, CAST(rk AS INTEGER) AS rank, other, round(cos, 6) AS score FROM (
            SELECT *, row_number() OVER (PARTITION BY key ORDER BY round(cos, 9) DESC, other) AS rk FROM s)
        WHERE rk <= {TOPK}""",
    "negative_only_removed": """
        WITH w AS (SELECT user_id * 1000 + dayofyear(ts) AS u, CAST(json_extract(props, '$.k') AS BIGINT) AS item,
                          CASE event_type WHEN 'error' THEN -10.0 ELSE 1.0 END AS rating FROM events)
        SELECT 'user' AS side, CAST(u AS BIGINT) AS id FROM (SELECT DISTINCT u FROM w)
        WHERE u NOT IN (SELECT u FROM w WHERE rating > 0)
        UNION ALL
        SELECT 'item', CAST(item AS BIGINT) FROM (SELECT DISTINCT item FROM w)
        WHERE item NOT IN (SELECT item FROM w WHERE rating > 0)""",
    "als_unknown_targets": with_("keys1000", "item_ids") + """
        SELECT key AS package FROM keys1000 WHERE key NOT IN (SELECT package FROM item_ids)""",
    "exclude_seen": with_("recs", "truth") + f"""
        SELECT key, CAST(rk AS INTEGER) AS rank, other, score FROM (
            SELECT r.key, r.other, r.score, row_number() OVER (PARTITION BY r.key ORDER BY r.score DESC, r.other) AS rk
            FROM recs r ANTI JOIN truth t ON r.key = t.key AND r.other = t.item)
        WHERE rk <= {UNSEEN_K}""",
    "als_interactions_mse": """
        WITH w AS (SELECT user_id * 1000 + dayofyear(ts) AS u, CAST(json_extract(props, '$.k') AS BIGINT) AS item,
                          CASE event_type WHEN 'error' THEN -10.0 ELSE 1.0 END AS rating FROM events)
        SELECT count(*) AS n, true AS below_hundred FROM w
        WHERE u IN (SELECT u FROM w WHERE rating > 0) AND item IN (SELECT item FROM w WHERE rating > 0)""",
    "als_train_mse": with_("ratings") + "SELECT count(*) AS n, true AS below_one FROM ratings",
    "als_factors": with_("user_ids", "item_ids") + f"""
        SELECT 'item' AS side, CAST(app_id AS BIGINT) AS id, {A.PRESETS['users_for_items'].rank} AS dims, true AS finite
        FROM item_ids UNION ALL
        SELECT 'user', CAST(user_id AS BIGINT), {A.PRESETS['users_for_items'].rank}, true FROM user_ids""",
    "als_items_for_users": with_("user_ids", "item_ids") + f"""
        SELECT CAST(user_id AS BIGINT) AS key, least({ALS_K}, (SELECT count(*) FROM item_ids)) AS n, true AS ranks_ok,
               true AS falls, true AS dot_ok FROM user_ids""",
    "als_users_for_items": with_("user_ids", "item_ids") + f"""
        SELECT CAST(app_id AS BIGINT) AS key, least({ALS_K}, (SELECT count(*) FROM user_ids)) AS n, true AS ranks_ok,
               true AS falls, true AS dot_ok FROM item_ids""",
    "als_users_for_targets": with_("user_ids", "item_ids", "keys1000") + f"""
        SELECT CAST(app_id AS BIGINT) AS key, least({ALS_K}, (SELECT count(*) FROM user_ids)) AS n, true AS ranks_ok,
               true AS falls, true AS dot_ok FROM item_ids WHERE package IN (SELECT key FROM keys1000)""",
    "item_to_item": with_("item_ids", "categories") + f""",
        c AS (SELECT i.package, c.category FROM item_ids i LEFT JOIN categories c ON c.package = i.package),
        s AS (SELECT category, count(*) AS n FROM c GROUP BY category)
        SELECT c.package AS key,
               least({TOPK}, CASE WHEN c.category IS NULL THEN (SELECT count(*) FROM c) ELSE s.n END - 1) AS n,
               true AS ranks_ok, true AS scores_ok, true AS others_ok
        FROM c LEFT JOIN s ON c.category = s.category
        WHERE CASE WHEN c.category IS NULL THEN (SELECT count(*) FROM c) ELSE s.n END > 1""",
    "user_to_user": with_("user_ids") + f"""
        SELECT hash AS key, least({TOPK}, (SELECT count(*) FROM user_ids) - 1) AS n, true AS ranks_ok,
               true AS scores_ok, true AS others_ok FROM user_ids""",
    "user_to_user_ann": with_("user_ids") + """
        SELECT hash AS key, true AS ranks_ok, true AS scores_ok, true AS others_ok FROM user_ids""",
    "unseen_items_for_users": with_("ratings", "item_ids") + f"""
        SELECT CAST(user AS BIGINT) AS key, least({UNSEEN_K}, (SELECT count(*) FROM item_ids) - count(DISTINCT item)) AS n,
               true AS ranks_ok, true AS items_ok, true AS unseen
        FROM ratings GROUP BY user HAVING count(DISTINCT item) < (SELECT count(*) FROM item_ids)""",
}
