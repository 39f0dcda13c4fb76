"""Inputs of the registered queries, derived from the driver's tables.

Each fixture exists twice: as a Spark DataFrame builder and as a DuckDB CTE
body of the same meaning (used only by the oracle SQL).  Fixtures are
derived from whole tables; where a fixture needs rows "left out" or "broken"
it uses a data attribute (size, balance) rather than an id subset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values shared by the Spark builders and the SQL fixtures.
AS_OF = "2000-02-15"
WINDOW_MONTHS = 3
BLACKLIST_TOP = 50
BLACKLIST_PATTERNS = ["small"]
MIN_DOWNLOADS = 500
CATEGORY_MAX_SIZE = 45        # parts above this size have no category row
RECS_PER_KEY = 20             # co-popular list length of the evaluation fixture
EVENT_CODES = {"view": 0, "click": 1, "signup": 2, "error": 4, "purchase": 5}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def package_col(partkey="p_partkey", ptype="p_type"):
    return F.concat(F.lit("com."), F.lower(F.col(ptype)), F.lit(".p"), F.col(partkey).cast("string"))


def install_log(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = table(spark, d, "part").select("p_partkey", "p_type")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(F.col("o_custkey").cast("string").alias("hash"), package_col().alias("pkg"),
                    F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


def id_map(spark, d) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), package_col().alias("data"))


def downloads(spark, d) -> DataFrame:
    return (table(spark, d, "lineitem").groupBy("l_partkey")
            .agg(F.sum("l_quantity").alias("downloads"))
            .select(F.col("l_partkey").alias("app_package"), "downloads"))


def categories(spark, d) -> DataFrame:
    return (table(spark, d, "part").where(F.col("p_size") <= CATEGORY_MAX_SIZE)
            .select(package_col().alias("package"), F.col("p_type").alias("category")))


def retention(spark, d) -> DataFrame:
    c = table(spark, d, "customer").where(F.col("c_acctbal") >= 0)
    n = table(spark, d, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").cast("string").alias("hash"), F.col("n_name").alias("country"))


def part_sales(spark, d) -> DataFrame:
    """Per part: package, type, brand and total quantity sold (0 if never sold)."""
    p = table(spark, d, "part")
    q = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("qty"))
    return (p.join(q, p.p_partkey == q.l_partkey, "left")
            .select(package_col().alias("package"), "p_partkey", "p_type", "p_brand",
                    F.coalesce("qty", F.lit(0.0)).alias("qty")))


def _group_top_list(spark, d, group, per_key):
    """For every part, the best-selling ``per_key`` other parts of its group.

    Only the top ``per_key + 1`` of each group is joined back to the group's
    parts, so a part meets at most ``per_key + 1`` rows - never its whole
    group, whatever the group size.
    """
    ps = part_sales(spark, d)
    w = Window.partitionBy(*group).orderBy(F.desc("qty"), "package")
    top = (ps.withColumn("r", F.row_number().over(w)).where(F.col("r") <= per_key + 1)
           .select(*group, F.col("package").alias("other"), F.col("qty").alias("oqty")))
    cand = ps.select(F.col("package").alias("key"), *group).join(top, list(group)).where(
        F.col("key") != F.col("other"))
    w2 = Window.partitionBy("key").orderBy(F.desc("oqty"), "other")
    return (cand.withColumn("pos", (F.row_number().over(w2) - 1).cast("int"))
            .where(F.col("pos") < per_key).select("key", "pos", "other"))


def recs(spark, d) -> DataFrame:
    """Evaluation lists: per part, the best sellers of its brand (score = N - pos)."""
    r = _group_top_list(spark, d, ["p_brand"], RECS_PER_KEY)
    return r.withColumn("score", (F.lit(RECS_PER_KEY) - F.col("pos")).cast("int"))


def recs_by_type(spark, d) -> DataFrame:
    """A second result set: per part, the best sellers of its type."""
    r = _group_top_list(spark, d, ["p_type"], RECS_PER_KEY)
    return r.withColumn("score", (F.lit(RECS_PER_KEY) - F.col("pos")).cast("int"))


def truth(spark, d) -> DataFrame:
    """Validation sets: per sold part, all other parts of its first order (linear in the order lines)."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey").distinct()
    first = li.groupBy("l_partkey").agg(F.min("l_orderkey").alias("l_orderkey")).select(
        F.col("l_partkey").alias("kp"), "l_orderkey")
    pairs = first.join(li, "l_orderkey").where(F.col("kp") != F.col("l_partkey"))
    p = table(spark, d, "part").select("p_partkey", package_col().alias("name"))
    return (pairs.join(p.select(F.col("p_partkey").alias("kp"), F.col("name").alias("key")), "kp")
            .join(p.select(F.col("p_partkey").alias("l_partkey"), F.col("name").alias("item")), "l_partkey")
            .select("key", "item"))


def baskets(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, d, "part").select("p_partkey", "p_type")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .select(F.col("l_orderkey").alias("basket"), package_col().alias("item")).distinct())


def test_keys(spark, d, n: int) -> DataFrame:
    """Top-n parts by quantity sold (a top-n list is the feature here)."""
    return part_sales(spark, d).orderBy(F.desc("qty"), "package").limit(n).select(F.col("package").alias("key"))


# ----------------------------------------------------------------- SQL fixtures
PACKAGE_SQL = "'com.' || lower(p_type) || '.p' || CAST(p_partkey AS VARCHAR)"

CTE = {
    "install_log": ([], f"""
        SELECT CAST(o.o_custkey AS VARCHAR) AS hash,
               'com.' || lower(p.p_type) || '.p' || CAST(p.p_partkey AS VARCHAR) AS pkg,
               CAST(year(o.o_orderdate) AS INTEGER) AS year,
               CAST(month(o.o_orderdate) AS INTEGER) AS month
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN part p ON l.l_partkey = p.p_partkey"""),
    "pairs": (["install_log"], "SELECT DISTINCT hash, pkg AS package FROM install_log"),
    "wellformed": (["pairs"], r"SELECT * FROM pairs WHERE regexp_matches(package, '.+\..+')"),
    "top_items": (["wellformed"], f"""
        SELECT package FROM (SELECT package, count(*) AS c FROM wellformed GROUP BY package)
        ORDER BY c DESC, package LIMIT {BLACKLIST_TOP}"""),
    "blacklisted": (["wellformed", "top_items"], r"""
        SELECT * FROM wellformed
        WHERE package NOT IN (SELECT package FROM top_items)
          AND NOT regexp_matches(package, '.+\.(?:small)')"""),
    "idmap": ([], f"SELECT p_partkey AS id, {PACKAGE_SQL} AS data FROM part"),
    "downloads": ([], "SELECT l_partkey AS app_package, sum(l_quantity) AS downloads FROM lineitem GROUP BY l_partkey"),
    "prepared": (["blacklisted", "idmap", "downloads"], f"""
        SELECT * FROM blacklisted WHERE package IN (
            SELECT i.data FROM idmap i JOIN downloads d ON d.app_package = i.id
            WHERE d.downloads > {MIN_DOWNLOADS})"""),
    "user_ids": (["prepared"], """
        SELECT hash, CAST(row_number() OVER (ORDER BY hash) AS INTEGER) AS user_id
        FROM (SELECT DISTINCT hash FROM prepared)"""),
    "item_ids": (["prepared"], """
        SELECT package, CAST(row_number() OVER (ORDER BY package) AS INTEGER) AS app_id
        FROM (SELECT DISTINCT package FROM prepared)"""),
    "ratings": (["prepared", "user_ids", "item_ids"], """
        SELECT u.user_id AS "user", i.app_id AS item, 1.0::DOUBLE AS rating
        FROM prepared p JOIN user_ids u ON p.hash = u.hash JOIN item_ids i ON p.package = i.package"""),
    "categories": ([], f"SELECT {PACKAGE_SQL} AS package, p_type AS category FROM part WHERE p_size <= {CATEGORY_MAX_SIZE}"),
    "retention": ([], """
        SELECT CAST(c.c_custkey AS VARCHAR) AS hash, n.n_name AS country
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE c.c_acctbal >= 0"""),
    "brand_top": (["part_sales"], """
        SELECT package AS other, p_brand, qty AS oqty,
               row_number() OVER (PARTITION BY p_brand ORDER BY qty DESC, package) AS r FROM part_sales"""),
    "recs": (["part_sales", "brand_top"], f"""
        SELECT key, CAST(pos AS INTEGER) AS pos, other, CAST({RECS_PER_KEY} - pos AS INTEGER) AS score FROM (
            SELECT k.package AS key, t.other,
                   row_number() OVER (PARTITION BY k.package ORDER BY t.oqty DESC, t.other) - 1 AS pos
            FROM part_sales k JOIN brand_top t
              ON k.p_brand = t.p_brand AND t.r <= {RECS_PER_KEY + 1} AND t.other <> k.package)
        WHERE pos < {RECS_PER_KEY}"""),
    "type_top": (["part_sales"], """
        SELECT package AS other, p_type, qty AS oqty,
               row_number() OVER (PARTITION BY p_type ORDER BY qty DESC, package) AS r FROM part_sales"""),
    "recs_type": (["part_sales", "type_top"], f"""
        SELECT key, CAST(pos AS INTEGER) AS pos, other FROM (
            SELECT k.package AS key, t.other,
                   row_number() OVER (PARTITION BY k.package ORDER BY t.oqty DESC, t.other) - 1 AS pos
            FROM part_sales k JOIN type_top t
              ON k.p_type = t.p_type AND t.r <= {RECS_PER_KEY + 1} AND t.other <> k.package)
        WHERE pos < {RECS_PER_KEY}"""),
    "truth": ([], """
        SELECT k.name AS key, o.name AS item
        FROM (SELECT l_partkey AS kp, min(l_orderkey) AS l_orderkey FROM lineitem GROUP BY l_partkey) f
        JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) l
          ON f.l_orderkey = l.l_orderkey AND f.kp <> l.l_partkey
        JOIN (SELECT p_partkey, """ + PACKAGE_SQL + """ AS name FROM part) k ON k.p_partkey = f.kp
        JOIN (SELECT p_partkey, """ + PACKAGE_SQL + """ AS name FROM part) o ON o.p_partkey = l.l_partkey"""),
    "baskets": ([], f"""
        SELECT DISTINCT l.l_orderkey AS basket, {PACKAGE_SQL} AS item
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""),
    "keys50": (["part_sales"], "SELECT package AS key FROM part_sales ORDER BY qty DESC, package LIMIT 50"),
    "keys1000": (["part_sales"], "SELECT package AS key FROM part_sales ORDER BY qty DESC, package LIMIT 1000"),
    "keys10k": (["part_sales"], "SELECT package AS key FROM part_sales ORDER BY qty DESC, package LIMIT 10000"),
    "part_sales": ([], f"""
        SELECT {PACKAGE_SQL} AS package, p_partkey, p_type, p_brand, coalesce(q.qty, 0.0) AS qty
        FROM part LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY l_partkey) q
        ON part.p_partkey = q.l_partkey"""),
}


def with_(*names: str, extra: dict | None = None) -> str:
    """``WITH`` clause holding the named fixtures and everything they depend on."""
    table_ = dict(CTE)
    table_.update(extra or {})
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for dep in table_[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({table_[n][1]})" for n in order) + "\n"
