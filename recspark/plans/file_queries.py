"""Registered queries of the readers and writers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.lists import format_rec_line
from ..operators import evaluate as ev
from ..operators import prepare as prep
from ..operators import tfidf as tfo
from ..operators.catalog import package_categories
from ..operators.ids import assign_ids
from ..session import scratch_path, written
from ..sinks.files import write_csv, write_table, write_text
from ..sources.files import read_categories, read_csv, read_descriptions, read_lines, read_names, read_retention
from . import fixtures as fx
from .eval_queries import N_EVAL, _rec_lines
from .fixtures import PACKAGE_SQL, with_
from .prep_queries import _prepared
from .text_queries import CLEAN, TOPK, _scored_lines, _tfidf_ctes

SHORT_CHARS = 1000       # descriptions shorter than this have no category
CATEGORY_SIZE = fx.CATEGORY_MAX_SIZE


def q_names_layouts(spark, d):
    """The id/name dimension written and read in its three layouts."""
    dim = fx.id_map(spark, d).select(F.col("id").cast("int").alias("id"), F.col("data").alias("name"))
    path, out = scratch_path(spark, "names"), None
    layouts = {"id,name": dim, "name,id": dim.select("name", "id"), "header:id,app": dim.withColumnRenamed("name", "app")}
    for k, (layout, rows) in enumerate(layouts.items()):
        write_csv(rows, f"{path}/{k}", header=layout.startswith("header"))
        back = read_names(spark, f"{path}/{k}", layout).select(F.lit(layout).alias("layout"), "id", "name")
        out = back if out is None else out.unionByName(back)
    return out


def q_categories_csv(spark, d):
    return read_categories(spark, write_csv(fx.categories(spark, d), scratch_path(spark, "categories")))


def q_retention_parquet(spark, d):
    """The stored table has more columns than the reader takes."""
    stored = fx.retention(spark, d).withColumn("days", F.length("country"))
    return read_retention(spark, write_table(stored, scratch_path(spark, "retention"), partition_by="days"))


def q_id_dictionaries(spark, d):
    """K1: both id maps written as CSV and read again."""
    path, out = scratch_path(spark, "dictionaries"), None
    pairs = _prepared(spark, d)
    for side, key in (("user", "hash"), ("item", "package")):
        write_csv(assign_ids(pairs, key, "id").select(key, "id"), f"{path}/{side}")
        back = read_names(spark, f"{path}/{side}", "name,id").select(F.lit(side).alias("side"), "id", "name")
        out = back if out is None else out.unionByName(back)
    return out


def q_format_float_scores(spark, d):
    """Lists with real scores, as the factor models give them."""
    r = fx.recs(spark, d).withColumn("score", F.col("score") / F.lit(7.0))
    items = F.sort_array(F.collect_list(F.struct("pos", "other", "score")))
    return r.groupBy("key").agg(items.alias("i")).select("key", format_rec_line(F.col("key"), F.col("i"), "%.6f").alias("line"))


def q_table_load(spark, d):
    """K4: load into a partitioned table, replacing what was there."""
    path = scratch_path(spark, "table")
    rows = fx.categories(spark, d)
    write_table(rows.limit(1), path, partition_by="category")
    write_table(rows, path, partition_by="category")
    return spark.read.schema("package string, category string").parquet(path)


def _ratings(spark, d):
    return prep.prepare_ratings(_prepared(spark, d))[3]


def q_ratings_reused(spark, d):
    """Stored once, then reused; the second build would give other ratings."""
    # written once: the marks of both calls and the build read the pairs
    path, pairs = scratch_path(spark, "stored-ratings"), written(_prepared(spark, d), "pairs")
    prep.ratings_or_build(spark, path, lambda: prep.prepare_ratings(pairs)[3], pairs)
    return prep.ratings_or_build(spark, path, lambda: prep.prepare_ratings(pairs)[3].limit(1), pairs)


def q_ratings_rebuilt(spark, d):
    """A folder of an unfinished write, and one made from other input, are built anew."""
    # written once: two marks and three builds read the ratings
    path, ratings = scratch_path(spark, "stored-ratings"), written(_ratings(spark, d), "ratings")
    ratings.where(F.col("item") % 2 == 0).write.parquet(f"{path}/data-unfinished")
    prep.ratings_or_build(spark, path, lambda: ratings.limit(1), ratings.where(F.col("user") % 2 == 0))
    return prep.ratings_or_build(spark, path, lambda: ratings, ratings)


def q_apk_categories(spark, d):
    """Package -> category id -> category name; unknown packages and ids keep NULL."""
    part = fx.table(spark, d, "part")
    names = assign_ids(part.where(F.col("p_size") <= CATEGORY_SIZE), "p_type", "category_id")
    # parts of the largest size have an id that no category has
    ids = part.join(names, "p_type", "left").where(F.col("p_size") > 5).select(
        fx.package_col().alias("package"),
        F.when(F.col("p_size") > CATEGORY_SIZE, F.lit(-1)).otherwise(F.col("category_id")).alias("category_id"))
    return package_categories(part.select(fx.package_col().alias("package")), ids, names.withColumnRenamed("p_type", "category"))


def _described(spark, d):
    """Descriptions by package name (S7) and their categories (S5), both through CSV; short ones have no category."""
    docs = fx.table(spark, d, "documents").select(
        F.concat(F.lit("com.doc.d"), F.col("doc_id").cast("string")).alias("id"), "text", "source", "n_chars")
    path = scratch_path(spark, "descriptions")
    write_csv(docs.select("id", F.col("text").alias("description")), f"{path}/d", header=True)
    write_csv(docs.where(F.col("n_chars") >= SHORT_CHARS).select(F.col("id").alias("package"), F.col("source").alias("category")),
              f"{path}/c")
    return read_descriptions(spark, f"{path}/d").join(
        read_categories(spark, f"{path}/c").withColumnRenamed("package", "id"), "id", "left")


def q_descriptions_topk_formatted(spark, d):
    """Descriptions by name, categories with NULL, TF-IDF neighbours per category, K3c lines."""
    docs = _described(spark, d)
    return _scored_lines(docs, tfo.similar_texts(docs, "id", "description", TOPK, ["category"]), "id")


def _runs(spark, d):
    path = scratch_path(spark, "runs")
    write_text(_rec_lines(fx.recs(spark, d)), f"{path}/brand_top")
    write_text(_rec_lines(fx.recs_by_type(spark, d)), f"{path}/type_top")
    return ev.evaluate_runs(read_lines(spark, f"{path}/*", with_run="dir"), fx.truth(spark, d), N_EVAL)


def q_eval_summary_appended(spark, d):
    """K6: a row a run appended to one CSV, read back."""
    s = _runs(spark, d).select("name", "total_recs", "number_lines", "unique_apps", "total_occurrences", "unique_occurrences")
    path, s = scratch_path(spark, "summary"), written(s, "summaries")
    for run in ("brand_top", "type_top"):
        write_csv(s.where(F.col("name") == run), path, mode="append")
    return read_csv(spark, path, s.schema)


def q_eval_summary_lines(spark, d):
    return ev.summary_line(_runs(spark, d))


QUERIES = {
    "names_layouts": q_names_layouts,
    "categories_csv": q_categories_csv,
    "retention_parquet": q_retention_parquet,
    "id_dictionaries": q_id_dictionaries,
    "format_float_scores": q_format_float_scores,
    "table_load": q_table_load,
    "apk_categories": q_apk_categories,
    "ratings_reused": q_ratings_reused,
    "ratings_rebuilt": q_ratings_rebuilt,
    "descriptions_topk_formatted": q_descriptions_topk_formatted,
    "eval_summary_appended": q_eval_summary_appended,
    "eval_summary_lines": q_eval_summary_lines,
}

_NAMED = f"""WITH documents AS (
    SELECT 'com.doc.d' || CAST(doc_id AS VARCHAR) AS doc_id, text,
           CASE WHEN n_chars >= {SHORT_CHARS} THEN source ELSE '(none)' END AS category FROM main.documents), """

_SUMMARY = "(SELECT * FROM (SELECT * FROM ({a}) UNION ALL SELECT * FROM ({b})))"


def _summaries() -> str:
    from .eval_queries import _content_summary_sql
    return _SUMMARY.format(a=_content_summary_sql("recs", "brand_top", N_EVAL),
                           b=_content_summary_sql("recs_type", "type_top", N_EVAL))


SQL = {
    "ratings_reused": with_("ratings") + "SELECT * FROM ratings",
    "ratings_rebuilt": with_("ratings") + "SELECT * FROM ratings",
    "names_layouts": " UNION ALL ".join(
        f"SELECT '{x}' AS layout, CAST(p_partkey AS INTEGER) AS id, {PACKAGE_SQL} AS name FROM part"
        for x in ("id,name", "name,id", "header:id,app")),
    "categories_csv": with_("categories") + "SELECT package, category FROM categories",
    "retention_parquet": with_("retention") + "SELECT hash, country FROM retention",
    "id_dictionaries": with_("user_ids", "item_ids") + """
        SELECT 'user' AS side, user_id AS id, hash AS name FROM user_ids
        UNION ALL SELECT 'item', app_id, package FROM item_ids""",
    "format_float_scores": with_("recs") + """
        SELECT key, '"' || key || '",' || string_agg('("' || other || '",' || printf('%.6f', score / 7.0) || ')', ','
               ORDER BY pos) AS line FROM recs GROUP BY key""",
    "table_load": with_("categories") + "SELECT package, category FROM categories",
    "apk_categories": f"""
        WITH n AS (SELECT p_type, CAST(row_number() OVER (ORDER BY p_type) AS INTEGER) AS cid
                   FROM (SELECT DISTINCT p_type FROM part WHERE p_size <= {CATEGORY_SIZE})),
        i AS (SELECT {PACKAGE_SQL} AS package,
                     CASE WHEN p_size > {CATEGORY_SIZE} THEN -1 ELSE cid END AS category_id
              FROM part LEFT JOIN n USING (p_type) WHERE p_size > 5)
        SELECT p.package, i.category_id, n.p_type AS category
        FROM (SELECT {PACKAGE_SQL} AS package FROM part) p LEFT JOIN i USING (package) LEFT JOIN n ON n.cid = i.category_id""",
    "descriptions_topk_formatted": _NAMED + _tfidf_ctes(["category"], CLEAN) + f""",
        top AS (SELECT key, other, rk, round(s, 6) AS s FROM ranked WHERE rk <= {TOPK})
        SELECT d.doc_id AS key, '"' || d.doc_id || '"' || coalesce(',' || (
            SELECT string_agg(printf('("%s",%.6f)', other, s), ',' ORDER BY rk) FROM top WHERE top.key = d.doc_id),
            '') AS line
        FROM documents d""",
    "eval_summary_appended": "SELECT name, total_recs, number_lines, unique_apps, total_occurrences, unique_occurrences FROM "
                             + _summaries(),
    "eval_summary_lines": """SELECT name, printf('%s: dcg=%.6f hits=%d unique_hits=%d unique_apps=%d total_recs=%d', name,
        coalesce(dcg, 0.0), total_occurrences, unique_occurrences, unique_apps, total_recs) AS line FROM """ + _summaries(),
}
