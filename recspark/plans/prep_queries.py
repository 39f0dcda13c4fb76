"""Registered queries of the preparation family."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prepare as prep
from ..operators.ids import assign_ids
from ..operators.affinity import country_share, interaction_weights
from ..sinks.files import write_csv
from ..sources.files import RATINGS_SCHEMA, read_csv
from ..session import scratch_path
from . import fixtures as fx
from .fixtures import with_


def _top_items(pairs, n=fx.BLACKLIST_TOP):
    """The n items with most distinct users (ties by name) - the top-n blacklist."""
    counts = pairs.groupBy("package").agg(F.count(F.lit(1)).alias("c"))
    return counts.orderBy(F.desc("c"), "package").limit(n).select("package")


def _wellformed(spark, d):
    return prep.wellformed_items(prep.install_pairs(fx.install_log(spark, d)))


def _with_malformed(spark, d):
    """The install pairs and, for each, a pair whose item name has no dot."""
    pairs = prep.install_pairs(fx.install_log(spark, d))
    return pairs.unionByName(pairs.withColumn("package", F.translate("package", ".", "_")))


def _blacklisted(spark, d):
    wf = _wellformed(spark, d)
    return prep.filter_blacklist(wf, "package", names=_top_items(wf), patterns=fx.BLACKLIST_PATTERNS)


def _prepared(spark, d):
    return prep.filter_min_downloads(_blacklisted(spark, d), fx.id_map(spark, d), fx.downloads(spark, d),
                                     min_exclusive=fx.MIN_DOWNLOADS)


def _ids(spark, d):
    pairs, users, items, _ = prep.prepare_ratings(_prepared(spark, d))
    return pairs, users, items


def q_scan_month_window(spark, d):
    return prep.month_window(fx.install_log(spark, d), fx.AS_OF, fx.WINDOW_MONTHS)


def q_install_pairs(spark, d):
    return prep.install_pairs(fx.install_log(spark, d))


def q_wellformed_items(spark, d):
    return prep.wellformed_items(_with_malformed(spark, d))


def q_blacklist_items(spark, d):
    return _blacklisted(spark, d)


def q_min_downloads_filter(spark, d):
    return _prepared(spark, d)


def q_user_ids(spark, d):
    return assign_ids(_prepared(spark, d), "hash", "user_id")


def q_item_ids(spark, d):
    return assign_ids(_prepared(spark, d), "package", "app_id")


def q_ratings_encoded(spark, d):
    pairs, users, items = _ids(spark, d)
    return prep.encode(pairs, users, items)


def q_id_decode(spark, d):
    pairs, users, items = _ids(spark, d)
    r = prep.encode(pairs, users, items)
    r = prep.decode(r, users, "user", "user_id", "hash", "hash")
    r = prep.decode(r, items, "item", "app_id", "package", "package")
    return r.select("user", "hash", "item", "package")


def q_item_histogram(spark, d):
    h = prep.package_histogram(_prepared(spark, d))
    return h.select("package", "count", F.round("percentage", 6).alias("percentage"))


def q_ratings_csv_roundtrip(spark, d):
    pairs, users, items = _ids(spark, d)
    path = scratch_path(spark, "ratings")
    write_csv(prep.encode(pairs, users, items), path)
    return read_csv(spark, path, RATINGS_SCHEMA)


def q_category_lookup(spark, d):
    items = q_item_ids(spark, d)
    return items.join(fx.categories(spark, d), "package", "left").select("package", "category")


def q_country_share(spark, d):
    out = country_share(_prepared(spark, d), fx.retention(spark, d))
    return out.withColumn("quo", F.round("quo", 6))


def weighted_events(spark, d, user):
    ev = fx.table(spark, d, "events")
    code = None
    for name, c in fx.EVENT_CODES.items():
        code = F.when(F.col("event_type") == name, F.lit(c)) if code is None else code.when(
            F.col("event_type") == name, F.lit(c))
    df = ev.select(user.alias("user"), F.get_json_object("props", "$.k").cast("long").alias("item"),
                   code.alias("code"))
    return interaction_weights(df, "code", "rating").select("user", "item", "code", "rating")


def q_interaction_weights(spark, d):
    return weighted_events(spark, d, F.col("user_id"))


def q_prediction_mse(spark, d):
    from ..operators.als import prediction_mse
    li = fx.table(spark, d, "lineitem")
    o = fx.table(spark, d, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"), "l_quantity")
    ratings = j.select("user", "item").distinct().withColumn("rating", F.lit(1.0))
    preds = j.groupBy("user", "item").agg((F.avg("l_quantity") / 50.0).alias("prediction"))
    return prediction_mse(ratings, preds).select(F.round("mse", 6).alias("mse"), "n")


QUERIES = {
    "scan_month_window": q_scan_month_window,
    "install_pairs": q_install_pairs,
    "wellformed_items": q_wellformed_items,
    "blacklist_items": q_blacklist_items,
    "min_downloads_filter": q_min_downloads_filter,
    "user_ids": q_user_ids,
    "item_ids": q_item_ids,
    "ratings_encoded": q_ratings_encoded,
    "id_decode": q_id_decode,
    "item_histogram": q_item_histogram,
    "ratings_csv_roundtrip": q_ratings_csv_roundtrip,
    "category_lookup": q_category_lookup,
    "country_share": q_country_share,
    "interaction_weights": q_interaction_weights,
    "prediction_mse": q_prediction_mse,
}

_EVENT_CASE = "CASE " + " ".join(f"WHEN event_type = '{k}' THEN {v}" for k, v in fx.EVENT_CODES.items()) + " END"

SQL = {
    "scan_month_window": with_("install_log") + """
        SELECT * FROM install_log
        WHERE year * 12 + month >= 1999 * 12 + 11 AND year * 12 + month < 2000 * 12 + 2""",
    "install_pairs": with_("pairs") + "SELECT * FROM pairs",
    "wellformed_items": with_("wellformed") + "SELECT * FROM wellformed",
    "blacklist_items": with_("blacklisted") + "SELECT * FROM blacklisted",
    "min_downloads_filter": with_("prepared") + "SELECT * FROM prepared",
    "user_ids": with_("user_ids") + "SELECT * FROM user_ids",
    "item_ids": with_("item_ids") + "SELECT * FROM item_ids",
    "ratings_encoded": with_("ratings") + "SELECT * FROM ratings",
    "id_decode": with_("ratings") + """
        SELECT r."user", u.hash, r.item, i.package FROM ratings r
        LEFT JOIN user_ids u ON r."user" = u.user_id LEFT JOIN item_ids i ON r.item = i.app_id""",
    "item_histogram": with_("ratings") + """
        SELECT i.package, c.count, round(c.count / (SELECT count(*) FROM ratings) * 100.0, 6) AS percentage
        FROM (SELECT item, count(*) AS count FROM ratings GROUP BY item) c
        LEFT JOIN item_ids i ON c.item = i.app_id""",
    "ratings_csv_roundtrip": with_("ratings") + "SELECT * FROM ratings",
    "category_lookup": with_("item_ids", "categories") + """
        SELECT i.package, c.category FROM item_ids i LEFT JOIN categories c ON i.package = c.package""",
    "country_share": with_("prepared", "retention") + """,
        j AS (SELECT p.package, r.country FROM prepared p LEFT JOIN retention r ON p.hash = r.hash),
        pp AS (SELECT package, country, count(*) AS per_pair FROM j GROUP BY package, country),
        pc AS (SELECT country, CAST(sum(per_pair) AS BIGINT) AS per_country FROM pp GROUP BY country),
        pa AS (SELECT package, CAST(sum(per_pair) AS BIGINT) AS per_app FROM pp GROUP BY package)
        SELECT pp.package, pp.country, pp.per_pair, pc.per_country, pa.per_app,
               round(pp.per_pair / pa.per_app, 6) AS quo
        FROM pp LEFT JOIN pc ON pp.country = pc.country LEFT JOIN pa ON pp.package = pa.package""",
    "interaction_weights": f"""
        SELECT user_id AS "user", CAST(json_extract(props, '$.k') AS BIGINT) AS item,
               CAST({_EVENT_CASE} AS INTEGER) AS code,
               CASE CAST({_EVENT_CASE} AS DOUBLE) WHEN 0 THEN 1.0 WHEN 1 THEN 2.0 WHEN 2 THEN 5.0
                    WHEN 3 THEN 5.0 WHEN 4 THEN -10.0 WHEN 5 THEN 20.0
                    ELSE CAST({_EVENT_CASE} AS DOUBLE) END AS rating
        FROM events""",
    "prediction_mse": """
        WITH j AS (SELECT o.o_custkey AS "user", l.l_partkey AS item, l.l_quantity
                   FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
        p AS (SELECT "user", item, avg(l_quantity) / 50.0 AS prediction FROM j GROUP BY "user", item)
        SELECT round(avg(power(1.0 - prediction, 2)), 6) AS mse, count(*) AS n FROM p""",
}
