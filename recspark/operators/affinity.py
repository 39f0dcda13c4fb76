"""Country affinity of items (A3 / J5 / J6) and interaction weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def country_share(pairs: DataFrame, retention: DataFrame, user_col: str = "hash",
                  item_col: str = "package", country_col: str = "country") -> DataFrame:
    """Per (item, country): pair count, country total, item total and pair/item.

    Users without a retention row get a NULL country.  The NULL country is its
    own group in the counts, but the country totals are re-attached by an
    equi-join, which never matches NULL - so ``per_country`` stays NULL there
    (the reference behaviour, kept on purpose).

    Plan: one partial/final aggregation to (item, country); the two totals are
    re-aggregations of that much smaller table, not new scans of the pairs.
    """
    users = retention.select(F.col(user_col), F.col(country_col).alias("country"))
    joined = pairs.select(user_col, F.col(item_col).alias("package")).join(users, user_col, "left")
    per_pair = joined.groupBy("package", "country").agg(F.count(F.lit(1)).alias("per_pair"))
    per_country = per_pair.groupBy("country").agg(F.sum("per_pair").cast("long").alias("per_country"))
    per_app = per_pair.groupBy("package").agg(F.sum("per_pair").cast("long").alias("per_app"))
    out = (per_pair.join(per_country, per_pair["country"] == per_country["country"], "left")
           .drop(per_country["country"])
           .join(per_app, "package", "left"))
    return out.select("package", "country", "per_pair", "per_country", "per_app",
                      (F.col("per_pair") / F.col("per_app")).alias("quo"))


# Interaction code -> implicit weight (printed, clicked,
# bookmarked, replied, deleted, strong interest); other codes keep their value.
INTERACTION_WEIGHTS = {0: 1.0, 1: 2.0, 2: 5.0, 3: 5.0, 4: -10.0, 5: 20.0}


def interaction_weights(df: DataFrame, code_col: str = "code", out_col: str = "rating",
                        weights: dict | None = None) -> DataFrame:
    """Replace an interaction code by its weight with a native CASE chain."""
    weights = INTERACTION_WEIGHTS if weights is None else weights
    code = F.col(code_col).cast("double")
    expr = None
    for k, w in weights.items():
        expr = (F.when(code == float(k), F.lit(float(w))) if expr is None
                else expr.when(code == float(k), F.lit(float(w))))
    expr = code if expr is None else expr.otherwise(code)
    return df.withColumn(out_col, expr)


def drop_negative_only(ratings: DataFrame, user_col: str = "user", item_col: str = "item",
                       rating_col: str = "rating"):
    """Remove users and items that have no positive rating (ALS cannot fit them).

    Returns ``(kept_ratings, removed)`` where ``removed`` lists (side, id).
    """
    pos_users = ratings.where(F.col(rating_col) > 0).select(user_col).distinct()
    pos_items = ratings.where(F.col(rating_col) > 0).select(item_col).distinct()
    kept = ratings.join(pos_users, user_col, "left_semi").join(pos_items, item_col, "left_semi")
    removed_users = (ratings.select(user_col).distinct().join(pos_users, user_col, "left_anti")
                     .select(F.lit("user").alias("side"), F.col(user_col).cast("long").alias("id")))
    removed_items = (ratings.select(item_col).distinct().join(pos_items, item_col, "left_anti")
                     .select(F.lit("item").alias("side"), F.col(item_col).cast("long").alias("id")))
    return kept, removed_users.unionByName(removed_items)
