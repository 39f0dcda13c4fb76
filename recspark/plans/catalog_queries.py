"""Registered queries of the catalog family."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as C
from ..operators.ids import assign_ids, continue_ids, work_slices
from ..session import scratch_path
from ..sinks.files import export_by_category, write_text
from ..sources.files import read_csv
from . import fixtures as fx
from .fixtures import PACKAGE_SQL

BROKEN_SIZE = 1          # catalog lines of parts of this size are cut (unparsable)
META_BROKEN_SIZE = 2     # metadata lines of parts of this size are cut
META_FAIL_SIZE = 48      # parts above this size answer with status FAIL
EXISTING_MAX_SIZE = 25   # parts up to this size already have ids
WORKERS = 16
CUT = 80                 # characters kept of a cut line (after the package field)


def _catalog_rows(spark, d):
    p = fx.table(spark, d, "part")
    docs = fx.table(spark, d, "documents").select("doc_id", "text")
    dl = fx.downloads(spark, d)
    j = (p.join(docs, p.p_partkey == docs.doc_id, "left")
         .join(dl, p.p_partkey == dl.app_package, "left"))
    rec = F.to_json(F.struct(fx.package_col().alias("package"), F.col("p_type").alias("category"),
                             F.col("downloads").cast("long").alias("downloads"),
                             F.col("text").alias("description"), F.col("p_brand").alias("developer")))
    return j.select(F.when(F.col("p_size") == BROKEN_SIZE, F.substring(rec, 1, CUT)).otherwise(rec).alias("value"))


def _ingested(spark, d):
    path = write_text(_catalog_rows(spark, d), scratch_path(spark, "catalog"))
    return C.ingest_catalog(spark, path)


def q_catalog_ingest(spark, d):
    return _ingested(spark, d)[0]


def q_catalog_rejects(spark, d):
    return _ingested(spark, d)[1]


def q_category_list(spark, d):
    return C.category_list(_ingested(spark, d)[0])


def q_category_export(spark, d):
    path = export_by_category(_ingested(spark, d)[0], scratch_path(spark, "export"))
    back = read_csv(spark, path, C.StructType([C.StructField("package", C.StringType()),
                                               C.StructField("description", C.StringType())]), multiLine=True)
    return back.select(F.col("category_dir").cast("string").alias("category"), "package", "description")


def _metadata_lines(spark, d):
    p = fx.table(spark, d, "part")
    docs = fx.table(spark, d, "documents").select("doc_id", "text")
    dl = fx.downloads(spark, d)
    j = (p.join(docs, p.p_partkey == docs.doc_id, "left")
         .join(dl, p.p_partkey == dl.app_package, "left"))
    pkg = fx.package_col()
    data = F.struct(
        pkg.alias("package"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.concat(F.lit("icon/"), pkg).alias("icon"),
        F.when(F.col("p_retailprice") >= 1500, F.concat(F.lit("icon_hd/"), pkg)).alias("icon_hd"),
        F.struct(F.col("p_brand").alias("name")).alias("store"),
        F.struct(F.md5(pkg).alias("md5sum"),
                 F.struct(F.when(F.col("p_size") < 25, "TRUSTED").otherwise("UNKNOWN").alias("rank")).alias("malware")
                 ).alias("file"),
        F.struct(F.coalesce(F.col("text"), F.lit("")).alias("description")).alias("media"),
        F.struct(F.concat(F.lit("w/"), pkg).alias("w")).alias("urls"),
        F.struct(F.col("downloads").cast("long").alias("pdownloads")).alias("stats"))
    status = F.when(F.col("p_size") > META_FAIL_SIZE, "FAIL").otherwise("OK")
    rec = F.to_json(F.struct(F.struct(status.alias("status")).alias("info"), data.alias("data")))
    return j.select(F.when(F.col("p_size") == META_BROKEN_SIZE, F.substring(rec, 1, CUT)).otherwise(rec).alias("value"))


def _metadata(spark, d):
    path = write_text(_metadata_lines(spark, d), scratch_path(spark, "metadata"))
    return C.parse_metadata(spark, path, fx.AS_OF)


def q_metadata_parse(spark, d):
    return _metadata(spark, d)[0]


def q_metadata_rejects(spark, d):
    return _metadata(spark, d)[1]


def q_metadata_status_counts(spark, d):
    return _metadata(spark, d)[2]


def _packages(spark, d):
    return fx.table(spark, d, "part").select(fx.package_col().alias("package"), "p_size")


def q_append_ids(spark, d):
    allp = _packages(spark, d)
    existing = assign_ids(allp.where(F.col("p_size") <= EXISTING_MAX_SIZE), "package", "id", id_type="long")
    return continue_ids(existing, allp, "package", "id")


def q_work_slices(spark, d):
    lines = assign_ids(_packages(spark, d), "package", "line", id_type="long")
    return work_slices(lines, "line", WORKERS)


QUERIES = {
    "catalog_ingest": q_catalog_ingest,
    "catalog_rejects": q_catalog_rejects,
    "category_list": q_category_list,
    "category_export": q_category_export,
    "metadata_parse": q_metadata_parse,
    "metadata_rejects": q_metadata_rejects,
    "metadata_status_counts": q_metadata_status_counts,
    "append_ids": q_append_ids,
    "work_slices": q_work_slices,
}

_CAT = f"""WITH dl AS (SELECT l_partkey, sum(l_quantity) AS downloads FROM lineitem GROUP BY l_partkey),
cat AS (SELECT {PACKAGE_SQL} AS package, p_type AS category, CAST(dl.downloads AS BIGINT) AS downloads,
               d.text AS description, p_brand AS developer, p_size
        FROM part LEFT JOIN documents d ON part.p_partkey = d.doc_id
        LEFT JOIN dl ON part.p_partkey = dl.l_partkey),
ok AS (SELECT package, category, downloads, description, developer FROM cat
       WHERE p_size <> {BROKEN_SIZE} AND package IS NOT NULL AND category IS NOT NULL AND downloads IS NOT NULL
         AND description IS NOT NULL AND developer IS NOT NULL)
"""

_META = f"""WITH dl AS (SELECT l_partkey, sum(l_quantity) AS downloads FROM lineitem GROUP BY l_partkey),
m AS (SELECT {PACKAGE_SQL} AS package, p_partkey, p_name, p_brand, p_size, p_retailprice, d.text,
             CAST(dl.downloads AS BIGINT) AS downloads
      FROM part LEFT JOIN documents d ON part.p_partkey = d.doc_id LEFT JOIN dl ON part.p_partkey = dl.l_partkey)
"""

SQL = {
    "catalog_ingest": _CAT + "SELECT * FROM ok",
    "catalog_rejects": _CAT + f"""
        SELECT package, CASE WHEN p_size = {BROKEN_SIZE} THEN 'parse' ELSE 'null' END AS reason FROM cat
        WHERE p_size = {BROKEN_SIZE} OR downloads IS NULL OR description IS NULL""",
    "category_list": _CAT + "SELECT DISTINCT category FROM ok",
    "category_export": _CAT + "SELECT regexp_replace(category, '[(),]', '', 'g') AS category, package, description FROM ok",
    "metadata_parse": _META + f"""
        SELECT row_number() OVER (ORDER BY package) AS id, p_partkey AS "appID", md5(package) AS "MD5",
               CASE WHEN p_size < 25 THEN 'TRUSTED' ELSE 'UNKNOWN' END AS malware, p_name AS title,
               package AS "packageName", coalesce(text, '') AS description, 'w/' || package AS "wUrl",
               'icon/' || package AS icon,
               CASE WHEN p_retailprice >= 1500 THEN 'icon_hd/' || package ELSE '' END AS icon_hd,
               downloads AS "downloadNo", p_brand AS store, '{fx.AS_OF}T00:00:00' AS "crawlDate"
        FROM m WHERE p_size <> {META_BROKEN_SIZE} AND p_size <= {META_FAIL_SIZE}""",
    "metadata_rejects": _META + f"""
        SELECT package, CASE WHEN p_size = {META_BROKEN_SIZE} THEN 'PARSE_ERROR' ELSE 'FAIL' END AS reason
        FROM m WHERE p_size = {META_BROKEN_SIZE} OR p_size > {META_FAIL_SIZE}""",
    "metadata_status_counts": _META + f"""
        SELECT CASE WHEN p_size = {META_BROKEN_SIZE} THEN 'PARSE_ERROR' WHEN p_size > {META_FAIL_SIZE} THEN 'FAIL'
                    ELSE 'OK' END AS status, count(*) AS n FROM m GROUP BY status""",
    "append_ids": f"""
        WITH p AS (SELECT {PACKAGE_SQL} AS package, p_size FROM part),
        mx AS (SELECT count(DISTINCT package) AS m FROM p WHERE p_size <= {EXISTING_MAX_SIZE})
        SELECT package, (SELECT m FROM mx) + row_number() OVER (ORDER BY package) AS id
        FROM (SELECT DISTINCT package FROM p WHERE package NOT IN
              (SELECT package FROM p WHERE p_size <= {EXISTING_MAX_SIZE}))""",
    "work_slices": f"""
        WITH p AS (SELECT {PACKAGE_SQL} AS package FROM part),
        l AS (SELECT package, row_number() OVER (ORDER BY package) AS line FROM p),
        t AS (SELECT count(*) // {WORKERS} + 1 AS step FROM p)
        SELECT package, line, CAST(floor((line - 1) / (SELECT step FROM t)) AS INTEGER) AS slice FROM l""",
}
