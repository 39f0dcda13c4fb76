"""Registered queries of the list formats and the offline evaluators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.lists import format_rec_line, format_tsv_line
from ..operators import evaluate as ev
from ..session import scratch_path
from ..sinks.files import write_text
from ..sources.files import read_key_list, read_lines
from . import fixtures as fx
from .fixtures import with_

N_EVAL = 10
GRID_N = (5, 10, 20)
BARE_SIZE = 50
#: First order date of the second validation set of the grid.
GRID_RECENT = "1997-01-01"
GRID_KEYS = {"top50": 50, "top1000": 1000, "top10k": 10_000}


def _r6(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.round(c, 6))
    return df


def _rec_lines(recs):
    """K3a lines (key, value) from the long list."""
    items = F.sort_array(F.collect_list(F.struct("pos", "other", "score")))
    return recs.groupBy("key").agg(items.alias("items")).select(
        "key", format_rec_line(F.col("key"), F.col("items")).alias("value"))


def _written_recs(spark, d, duplicates=False):
    path = scratch_path(spark, "recs")
    write_text(_rec_lines(fx.recs(spark, d)), f"{path}/a")
    paths = [f"{path}/a"]
    if duplicates:
        # a second file repeating the test keys with their validation lists
        t = fx.truth(spark, d).join(fx.test_keys(spark, d, 50), "key", "left_semi")
        w = F.row_number().over(Window.partitionBy("key").orderBy("item")) - 1
        t = t.withColumn("pos", w.cast("int")).withColumn("score", (F.lit(fx.RECS_PER_KEY) - F.col("pos")).cast("int"))
        write_text(_rec_lines(t.select("key", "pos", F.col("item").alias("other"), "score")), f"{path}/b")
        paths.append(f"{path}/b")
    return ev.parse_recommendations(read_lines(spark, paths))


def _parsed(spark, d):
    return ev.lists_from_long(fx.recs(spark, d))


def q_format_recommendations(spark, d):
    return _rec_lines(fx.recs(spark, d)).select("key", F.col("value").alias("line"))


def q_format_recommendations_tsv(spark, d):
    r = fx.recs(spark, d)
    arr = F.sort_array(F.collect_list(F.struct("pos", "other")))
    return (r.groupBy("key").agg(arr.alias("a"))
            .select("key", format_tsv_line(F.col("key"), F.col("a.other")).alias("line")))


def q_parse_recommendations(spark, d):
    return _written_recs(spark, d).long().select("key", F.col("pos").cast("int").alias("pos"), "other")


def q_duplicate_keys(spark, d):
    return ev.duplicate_keys(_written_recs(spark, d, duplicates=True))


def _validation_lines(spark, d):
    """Lines ``key,a; b`` of the validation sets; a second file repeats the test keys with one item."""
    t = fx.truth(spark, d)

    def lines(rows, items):
        return rows.groupBy("key").agg(items.alias("v")).select(F.concat(F.col("key"), F.lit(","), F.col("v")).alias("value"))
    path = scratch_path(spark, "validation")
    write_text(lines(t, F.array_join(F.sort_array(F.collect_list("item")), "; ")), f"{path}/a")
    again = t.join(fx.test_keys(spark, d, 50), "key", "left_semi")
    bare = fx.test_keys(spark, d, 50).select(F.concat(F.lit("no comma "), F.col("key")).alias("value"))
    write_text(lines(again, F.min("item")).unionByName(bare), f"{path}/b")
    return read_lines(spark, [f"{path}/a", f"{path}/b"])


def q_parse_validation(spark, d):
    return ev.parse_validation(_validation_lines(spark, d))


def q_validation_rejects(spark, d):
    return ev.validation_rejects(_validation_lines(spark, d))


def q_parse_baskets(spark, d):
    b = fx.baskets(spark, d)
    lines = b.groupBy("basket").agg(F.array_join(F.collect_list("item"), "  ").alias("value"))
    path = write_text(lines, scratch_path(spark, "baskets"))
    parsed = ev.parse_baskets(spark.read.text(path))
    return (parsed.groupBy("basket").agg(F.sort_array(F.collect_list("item")).alias("items"))
            .select(F.array_join("items", " ").alias("basket"), F.size("items").alias("n_items")))


def q_target_keys(spark, d):
    k = fx.test_keys(spark, d, 50)
    lines = k.select(F.concat(F.lit('"'), F.col("key"), F.lit('";')).alias("value")).unionByName(
        spark.createDataFrame([("   ",), ("",)], "value string"))
    path = write_text(lines, scratch_path(spark, "keys"))
    return read_key_list(spark, path)


def q_eval_hits(spark, d):
    h = ev.first_hits(fx.recs(spark, d), fx.truth(spark, d), N_EVAL)
    return _r6(h.select("key", "other", F.col("idx").cast("int").alias("idx"), "gain"), "gain")


def q_eval_unique_hits(spark, d):
    p = _parsed(spark, d)
    return ev.list_hit_stats(p.long(), p.lists, fx.truth(spark, d), N_EVAL)


def q_eval_list_dcg(spark, d):
    p = _parsed(spark, d)
    return _r6(ev.evaluate_lists(p.long(), p.lists, fx.truth(spark, d), N_EVAL), "gain_sum", "score")


def q_eval_content_summary(spark, d):
    s = ev.content_summary(_parsed(spark, d), fx.truth(spark, d), N_EVAL, name="brand_top")
    return _r6(s, "unique_ratio", "dcg", "dcg_variation", "occurrences_norm", "total_recs_norm",
               "product", "diversity", "diversity_max", "equability")


def q_eval_keys_missing(spark, d):
    """Parts of the largest size have a line without a list; unsold parts have no validation set."""
    part = fx.table(spark, d, "part").select(fx.package_col().alias("key"), (F.col("p_size") == BARE_SIZE).alias("bare"))
    lines = _rec_lines(fx.recs(spark, d)).join(part, "key").select(
        F.when(F.col("bare"), F.concat(F.lit('"'), "key", F.lit('"'))).otherwise(F.col("value")).alias("value"))
    sold = fx.truth(spark, d).join(fx.test_keys(spark, d, 50), "key", "left_anti")
    parsed = ev.parse_recommendations(read_lines(spark, write_text(lines, scratch_path(spark, "bare"))))
    return ev.key_coverage(parsed, sold)


def q_coverage_stats(spark, d):
    return ev.coverage_stats(_parsed(spark, d), fx.truth(spark, d))


def q_rec_frequency(spark, d):
    return ev.rec_frequency(_parsed(spark, d))


def q_diversity_index(spark, d):
    return _r6(ev.diversity_index(_parsed(spark, d)), "diversity", "diversity_max", "equability")


def q_shannon_entropy(spark, d):
    return _r6(ev.shannon_entropy(_parsed(spark, d)), "entropy")


def q_eval_basket_dcg(spark, d):
    s = ev.evaluate_baskets(fx.recs(spark, d), fx.baskets(spark, d), N_EVAL, fx.test_keys(spark, d, 50))
    return _r6(s, "g_sum", "score")


def q_eval_basket_summary(spark, d):
    s = ev.basket_summary(fx.recs(spark, d), fx.baskets(spark, d), N_EVAL, fx.test_keys(spark, d, 50))
    return _r6(s, "sum_dcg", "avg_dcg")


def _keysets(spark, d):
    keysets = None
    for kname, kn in GRID_KEYS.items():
        k = fx.test_keys(spark, d, kn).select(F.lit(kname).alias("keyset"), "key")
        keysets = k if keysets is None else keysets.unionByName(k)
    return keysets


def q_eval_grid(spark, d):
    """Every (list length, key set) combination in one plan."""
    out = ev.basket_grid(fx.recs(spark, d), fx.baskets(spark, d), GRID_N, _keysets(spark, d))
    return _r6(out, "sum_dcg", "avg_dcg")


def q_eval_grid_sets(spark, d):
    """The full grid, two result sets by two validation sets by key sets by list lengths."""
    recs = (fx.recs(spark, d).withColumn("run", F.lit("brand_top"))
            .unionByName(fx.recs_by_type(spark, d).withColumn("run", F.lit("type_top"))))
    recent = fx.table(spark, d, "orders").where(F.col("o_orderdate") >= F.lit(GRID_RECENT)).select(
        F.col("o_orderkey").alias("basket"))
    every = fx.baskets(spark, d)
    sets = (every.withColumn("vset", F.lit("all"))
            .unionByName(every.join(recent, "basket", "left_semi").withColumn("vset", F.lit("recent"))))
    return _r6(ev.basket_grid(recs, sets, GRID_N, _keysets(spark, d)), "sum_dcg", "avg_dcg")


def q_eval_runs(spark, d):
    """A folder of result sets, each evaluated under its own run name."""
    path = scratch_path(spark, "runs")
    write_text(_rec_lines(fx.recs(spark, d)), f"{path}/brand_top")
    write_text(_rec_lines(fx.recs_by_type(spark, d)), f"{path}/type_top")
    s = ev.evaluate_runs(read_lines(spark, f"{path}/*", with_run="dir"), fx.truth(spark, d), N_EVAL)
    return _r6(s, "unique_ratio", "dcg", "dcg_variation", "occurrences_norm", "total_recs_norm",
               "product", "diversity", "diversity_max", "equability")


QUERIES = {
    "eval_runs": q_eval_runs,
    "format_recommendations": q_format_recommendations,
    "format_recommendations_tsv": q_format_recommendations_tsv,
    "parse_recommendations": q_parse_recommendations,
    "duplicate_keys": q_duplicate_keys,
    "parse_validation": q_parse_validation,
    "validation_rejects": q_validation_rejects,
    "parse_baskets": q_parse_baskets,
    "target_keys": q_target_keys,
    "eval_hits": q_eval_hits,
    "eval_unique_hits": q_eval_unique_hits,
    "eval_list_dcg": q_eval_list_dcg,
    "eval_content_summary": q_eval_content_summary,
    "eval_keys_missing": q_eval_keys_missing,
    "coverage_stats": q_coverage_stats,
    "rec_frequency": q_rec_frequency,
    "diversity_index": q_diversity_index,
    "shannon_entropy": q_shannon_entropy,
    "eval_basket_dcg": q_eval_basket_dcg,
    "eval_basket_summary": q_eval_basket_summary,
    "eval_grid": q_eval_grid,
    "eval_grid_sets": q_eval_grid_sets,
}


# ------------------------------------------------------------------ oracle SQL
def _list_eval_ctes(n: int) -> str:
    return f""",
    top AS (SELECT key, other, min(pos) AS idx FROM recs WHERE pos < {n} GROUP BY key, other),
    hits AS (SELECT t.key, t.other, t.idx, 1.0 - t.idx / {float(n)} AS gain
             FROM top t JOIN (SELECT DISTINCT key, item FROM truth) v ON t.key = v.key AND t.other = v.item),
    t_size AS (SELECT key, count(DISTINCT item) AS n_truth FROM truth GROUP BY key),
    per_key AS (
        SELECT k.key, s.n_truth, coalesce(h.n_hits, 0) AS n_hits, coalesce(h.gain_sum, 0.0) AS gain_sum,
               coalesce(h.gain_sum, 0.0) / s.n_truth / {(n + 1) / 2.0} / s.n_truth AS score
        FROM (SELECT DISTINCT key FROM recs) k JOIN t_size s ON k.key = s.key
        LEFT JOIN (SELECT key, count(*) AS n_hits, sum(gain) AS gain_sum FROM hits GROUP BY key) h
          ON k.key = h.key),
    totals AS (SELECT (SELECT count(DISTINCT key) FROM recs) + (SELECT count(*) FROM recs) AS total_recs,
                      (SELECT count(DISTINCT key) FROM recs) AS number_lines,
                      (SELECT count(DISTINCT other) FROM recs) AS unique_apps),
    freq AS (SELECT other, count(*) AS cnt FROM recs GROUP BY other),
    div AS (SELECT coalesce(sum((cnt / t.total_recs) * ln(1 + cnt / t.total_recs)), 0.0) AS diversity,
                   ln(1 + any_value(t.total_recs)) AS diversity_max
            FROM freq, totals t)
    """


def _content_summary_sql(recs_cte: str, name: str, n: int) -> str:
    body = with_("recs", "recs_type", "truth") + _list_eval_ctes(n).replace("FROM recs", f"FROM {recs_cte}")
    return body + f""",
    s AS (SELECT sum(score) AS sum_dcg, count(*) AS apps_scored, CAST(sum(n_hits) AS BIGINT) AS total_occurrences
          FROM per_key),
    u AS (SELECT count(DISTINCT other) AS unique_hits FROM hits WHERE key IN (SELECT key FROM per_key))
    SELECT '{name}' AS name, t.total_recs, t.number_lines, t.unique_apps,
           CAST(coalesce(s.total_occurrences, 0) AS BIGINT) AS total_occurrences,
           u.unique_hits AS unique_occurrences,
           round(u.unique_hits / s.total_occurrences, 6) AS unique_ratio,
           s.apps_scored, round(s.sum_dcg / s.apps_scored, 6) AS dcg,
           round(10000.0 * (s.sum_dcg / s.apps_scored) + t.unique_apps / t.total_recs, 6) AS dcg_variation,
           round(s.total_occurrences / s.apps_scored, 6) AS occurrences_norm,
           round(t.total_recs / (t.number_lines * {float(n)}), 6) AS total_recs_norm,
           round((s.total_occurrences / s.apps_scored) * (t.total_recs / (t.number_lines * {float(n)})), 6)
               AS product,
           round(dv.diversity, 6) AS diversity, round(dv.diversity_max, 6) AS diversity_max,
           round(dv.diversity / dv.diversity_max, 6) AS equability
    FROM s, u, totals t, div dv"""


def _basket_sql(n: int, keys_cte: str, x: str = "", recs: str = "recs", baskets: str = "baskets") -> str:
    """CTEs of one basket evaluation; every CTE name carries the suffix ``x``."""
    coef = ((n + 1) / 2.0) / n
    return f"""
    b{x} AS (SELECT DISTINCT basket, item FROM {baskets}),
    bs{x} AS (SELECT basket, count(*) AS b_size FROM b{x} GROUP BY basket),
    rk{x} AS (SELECT DISTINCT key FROM {recs} WHERE key IN (SELECT key FROM {keys_cte})),
    member{x} AS (SELECT b.basket, bs.b_size, b.item AS key FROM b{x} b JOIN bs{x} bs ON b.basket = bs.basket
               WHERE b.item IN (SELECT key FROM rk{x})),
    top{x} AS (SELECT key, other, min(pos) AS idx FROM {recs} WHERE pos < {n} AND key IN (SELECT key FROM rk{x})
            GROUP BY key, other),
    hit{x} AS (SELECT m.key, m.basket, sum(1.0 - t.idx / {float(n)}) AS gain
            FROM member{x} m JOIN top{x} t ON m.key = t.key JOIN b{x} b ON b.basket = m.basket AND b.item = t.other
            GROUP BY m.key, m.basket),
    g{x} AS (SELECT m.key, m.basket,
                 CASE WHEN m.b_size > 1 THEN coalesce(h.gain, 0.0) / (m.b_size - 1) ELSE 0.0 END AS g
          FROM member{x} m LEFT JOIN hit{x} h ON m.key = h.key AND m.basket = h.basket),
    per_key{x} AS (SELECT key, count(*) AS n_baskets, sum(g) AS g_sum, sum(g) / {coef} / count(*) AS score
                FROM g{x} GROUP BY key),
    summary{x} AS (SELECT (SELECT count(DISTINCT basket) FROM {baskets}) AS users,
                       (SELECT count(*) FROM rk{x}) AS recs,
                       (SELECT count(DISTINCT key) FROM {keys_cte}) AS keys,
                       coalesce((SELECT sum(score) FROM per_key{x}), 0.0) AS sum_dcg,
                       (SELECT count(*) FROM per_key{x}) AS n_keys)
    """


_LIST = with_("recs", "truth") + _list_eval_ctes(N_EVAL)

SQL = {
    "format_recommendations": with_("recs") + """
        SELECT key, '"' || key || '",' || string_agg('("' || other || '",' || CAST(score AS VARCHAR) || ')', ','
               ORDER BY pos) AS line FROM recs GROUP BY key""",
    "format_recommendations_tsv": with_("recs") + """
        SELECT key, key || chr(9) || string_agg(other, ',' ORDER BY pos) AS line FROM recs GROUP BY key""",
    "parse_recommendations": with_("recs") + "SELECT key, pos, other FROM recs",
    "duplicate_keys": with_("recs", "truth", "keys50") + """,
        t AS (SELECT * FROM truth WHERE key IN (SELECT key FROM keys50)),
        l AS (SELECT DISTINCT key, 'a' AS f FROM recs UNION ALL SELECT DISTINCT key, 'b' FROM t)
        SELECT key, count(*) AS n_lines, CAST((SELECT count(*) FROM t WHERE t.key = l.key) AS INTEGER) AS kept_recs
        FROM l GROUP BY key HAVING count(*) > 1""",
    "parse_validation": with_("truth", "keys50") + """
        SELECT key, item FROM truth WHERE key NOT IN (SELECT key FROM keys50)
        UNION ALL SELECT key, min(item) FROM truth WHERE key IN (SELECT key FROM keys50) GROUP BY key""",
    "validation_rejects": with_("keys50") + "SELECT 'no comma ' || key AS value FROM keys50",
    "parse_baskets": with_("baskets") + """
        SELECT string_agg(item, ' ' ORDER BY item) AS basket, CAST(count(*) AS INTEGER) AS n_items
        FROM baskets GROUP BY basket""",
    "target_keys": with_("keys50") + "SELECT key FROM keys50",
    "eval_hits": _LIST + "SELECT key, other, CAST(idx AS INTEGER) AS idx, round(gain, 6) AS gain FROM hits",
    "eval_unique_hits": _LIST + """
        SELECT count(DISTINCT other) AS unique_hits, count(*) AS total_hits, count(DISTINCT key) AS keys_with_hit
        FROM hits WHERE key IN (SELECT key FROM per_key)""",
    "eval_list_dcg": _LIST + """
        SELECT key, n_truth, n_hits, round(gain_sum, 6) AS gain_sum, round(score, 6) AS score FROM per_key""",
    "eval_content_summary": _LIST + f""",
    s AS (SELECT sum(score) AS sum_dcg, count(*) AS apps_scored, CAST(sum(n_hits) AS BIGINT) AS total_occurrences
          FROM per_key),
    u AS (SELECT count(DISTINCT other) AS unique_hits FROM hits WHERE key IN (SELECT key FROM per_key))
    SELECT 'brand_top' AS name, t.total_recs, t.number_lines, t.unique_apps,
           CAST(coalesce(s.total_occurrences, 0) AS BIGINT) AS total_occurrences,
           u.unique_hits AS unique_occurrences,
           round(u.unique_hits / s.total_occurrences, 6) AS unique_ratio,
           s.apps_scored, round(s.sum_dcg / s.apps_scored, 6) AS dcg,
           round(10000.0 * (s.sum_dcg / s.apps_scored) + t.unique_apps / t.total_recs, 6) AS dcg_variation,
           round(s.total_occurrences / s.apps_scored, 6) AS occurrences_norm,
           round(t.total_recs / (t.number_lines * {float(N_EVAL)}), 6) AS total_recs_norm,
           round((s.total_occurrences / s.apps_scored) * (t.total_recs / (t.number_lines * {float(N_EVAL)})), 6)
               AS product,
           round(dv.diversity, 6) AS diversity, round(dv.diversity_max, 6) AS diversity_max,
           round(dv.diversity / dv.diversity_max, 6) AS equability
    FROM s, u, totals t, div dv""",
    "eval_keys_missing": with_("recs", "truth", "keys50") + f""",
        t AS (SELECT DISTINCT key FROM truth WHERE key NOT IN (SELECT key FROM keys50)),
        k AS (SELECT DISTINCT key FROM recs),
        b AS (SELECT {fx.PACKAGE_SQL} AS key FROM part WHERE p_size = {BARE_SIZE})
        SELECT count(*) FILTER (WHERE key IN (SELECT key FROM t)) AS keys_scored,
               count(*) FILTER (WHERE key NOT IN (SELECT key FROM t)) AS keys_not_in_truth,
               count(*) FILTER (WHERE key IN (SELECT key FROM b)) AS keys_without_list FROM k""",
    "coverage_stats": _LIST + """
        SELECT 'results' AS side, unique_apps AS "unique", total_recs AS total,
               CAST(floor(unique_apps * 100.0 / total_recs) AS BIGINT) AS percent FROM totals
        UNION ALL
        SELECT 'truth', (SELECT count(DISTINCT a) FROM (SELECT key AS a FROM truth UNION ALL SELECT item FROM truth)),
               (SELECT count(DISTINCT key) FROM truth) + (SELECT count(*) FROM truth),
               CAST(floor((SELECT count(DISTINCT a) FROM (SELECT key AS a FROM truth UNION ALL SELECT item FROM truth))
                    * 100.0 / ((SELECT count(DISTINCT key) FROM truth) + (SELECT count(*) FROM truth))) AS BIGINT)""",
    "rec_frequency": with_("recs") + "SELECT other, count(*) AS count FROM recs GROUP BY other",
    "diversity_index": _LIST + """
        SELECT round(diversity, 6) AS diversity, round(diversity_max, 6) AS diversity_max,
               round(diversity / diversity_max, 6) AS equability FROM div""",
    "shannon_entropy": with_("recs") + """,
        f AS (SELECT other, count(*) AS c FROM recs GROUP BY other)
        SELECT round(coalesce(-sum((c / (SELECT sum(c) FROM f)) * ln(c / (SELECT sum(c) FROM f))), 0.0), 6) AS entropy,
               count(*) AS n_items FROM f""",
    "eval_basket_dcg": with_("recs", "baskets", "keys50") + "," + _basket_sql(N_EVAL, "keys50") + """
        SELECT key, n_baskets, round(g_sum, 6) AS g_sum, round(score, 6) AS score FROM per_key""",
    "eval_basket_summary": with_("recs", "baskets", "keys50") + "," + _basket_sql(N_EVAL, "keys50") + """
        SELECT users, recs, keys, round(sum_dcg, 6) AS sum_dcg, n_keys,
               round(CASE WHEN n_keys = 0 THEN NULL ELSE sum_dcg / n_keys END, 6) AS avg_dcg FROM summary""",
}


_KEY_CTES = {"top50": "keys50", "top1000": "keys1000", "top10k": "keys10k"}


def _run_sql(x: str, n: int, k: str, more: str = "") -> str:
    return (f"SELECT {more}{n} AS n, '{k}' AS keyset, users, recs, keys, round(sum_dcg, 6) AS sum_dcg, n_keys, "
            f"round(CASE WHEN n_keys = 0 THEN NULL ELSE sum_dcg / n_keys END, 6) AS avg_dcg FROM summary{x}")


def _grid_sql() -> str:
    base = with_("recs", "baskets", "keys50", "keys1000", "keys10k")
    runs = [(f"_{k}_{n}", n, k) for k in GRID_KEYS for n in GRID_N]
    ctes = ",".join(_basket_sql(n, _KEY_CTES[k], x) for x, n, k in runs)
    return base + "," + ctes + "\n" + "\nUNION ALL\n".join(_run_sql(x, n, k) for x, n, k in runs)


def _grid_sets_sql() -> str:
    base = with_("recs", "recs_type", "baskets", "keys50", "keys1000", "keys10k")
    recent = f""", baskets_recent AS (SELECT * FROM baskets WHERE basket IN (
        SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '{GRID_RECENT}'))"""
    runs = [(f"_{r}_{v}_{k}_{n}", n, k, r, v, rt, vt) for r, rt in (("brand_top", "recs"), ("type_top", "recs_type"))
            for v, vt in (("all", "baskets"), ("recent", "baskets_recent")) for k in GRID_KEYS for n in GRID_N]
    ctes = ",".join(_basket_sql(n, _KEY_CTES[k], x, rt, vt) for x, n, k, _, _, rt, vt in runs)
    return base + recent + "," + ctes + "\n" + "\nUNION ALL\n".join(
        _run_sql(x, n, k, f"'{r}' AS run, '{v}' AS vset, ") for x, n, k, r, v, *_ in runs)


SQL["eval_grid"] = _grid_sql()
SQL["eval_grid_sets"] = _grid_sets_sql()
SQL["eval_runs"] = ("SELECT * FROM (" + _content_summary_sql("recs", "brand_top", N_EVAL) + ") UNION ALL SELECT * FROM ("
                    + _content_summary_sql("recs_type", "type_top", N_EVAL) + ")")
